"""CSV sources: permissive scan, quarantine of malformed rows, inference.

DROPMALFORMED is not used: its ``count()`` prunes every column, so nothing is
parsed and nothing is found malformed (the count over-reports), while
``collect()`` on the same reader drops rows. A PERMISSIVE scan with a corrupt
record column gives one consistent answer and keeps the bad rows for review.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def as_schema(schema: T.StructType | str) -> T.StructType:
    if isinstance(schema, T.StructType):
        return schema
    return T._parse_datatype_string(schema)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, *,
             header: bool = True, infer_schema: bool = False, sampling_ratio: float = 1.0,
             mode: str = "PERMISSIVE", multi_line: bool = False, **options) -> DataFrame:
    """Plain CSV read. Prefer an explicit schema: inference costs a full pass."""
    reader = spark.read.option("header", header).option("mode", mode).option("multiLine", multi_line)
    for k, v in options.items():
        reader = reader.option(k, v)
    if schema is not None:
        return reader.schema(as_schema(schema)).csv(path)
    return reader.option("inferSchema", infer_schema).option("samplingRatio", sampling_ratio).csv(path)


def scan_with_quarantine(spark: SparkSession, path: str, schema: T.StructType | str, *,
                         header: bool = True, multi_line: bool = False,
                         land_to: str | None = None, **options) -> DataFrame:
    """Parse the CSV once, flag malformed rows, land the result as Parquet.

    A row is malformed when its cell count differs from the schema or a cell
    does not cast to its type. Both checks need *every* column parsed, and
    Spark's CSV column pruning parses only the columns a query references, so
    the parsed rows are written out (all columns, partitioned by
    ``is_malformed``) to the shared checkpoint folder or ``land_to``. Readers
    of good rows then get partition pruning and a columnar scan, and the landed
    table doubles as a lineage cut: a lost executor re-reads Parquet instead of
    re-parsing text.

    Returns the schema's columns plus ``_corrupt_record`` (the raw record of a bad
    row, NULL for a good one) and ``is_malformed``; :func:`malformed_reasons`
    says what is wrong with a record.
    """
    from plumage.session import scratch_path

    fields = as_schema(schema).fields + [T.StructField(CORRUPT, T.StringType(), True)]
    parsed = read_csv(spark, path, T.StructType(fields), header=header, multi_line=multi_line,
                      columnNameOfCorruptRecord=CORRUPT, **options)
    out = land_to or scratch_path(spark, "csv-landing")
    (parsed.withColumn("is_malformed", F.col(CORRUPT).isNotNull())
     .write.mode("errorifexists").partitionBy("is_malformed").parquet(out))
    # Partition values come back as strings; the cast keeps partition pruning.
    landed = spark.read.parquet(out)
    return landed.withColumn("is_malformed", F.col("is_malformed").cast("boolean"))


def good_rows(scanned: DataFrame) -> DataFrame:
    return scanned.where(~F.col("is_malformed")).drop(CORRUPT, "is_malformed")


def bad_rows(scanned: DataFrame) -> DataFrame:
    return scanned.where(F.col("is_malformed")).select(CORRUPT)


def _outside_quotes(record: Column, quote: str) -> Column:
    """The parts of a raw record before, between and after its quoted stretches.

    A doubled quote inside a cell gives an empty part between two stretches.
    """
    return F.filter(F.split(record, quote, -1), lambda _, i: i % 2 == 0)


def record_problem(record: Column | str, schema: T.StructType | str, delimiter: str = ",", quote: str = '"') -> Column:
    """(reason, column) of a raw record that a permissive read found malformed.

    * ``broken_quote``: a quoted cell that does not end, or a quote that neither
      begins nor ends a cell;
    * ``too_short`` / ``too_long``: fewer or more cells than the schema has;
    * ``bad_cell``: ``column`` is the first one whose cell does not cast to its type;
    * ``other``: none of these.

    Cells are told apart on the whole record: delimiters and line breaks inside
    quotes are text. Native expressions only.
    """
    fields = as_schema(schema).fields
    record = F.col(record) if isinstance(record, str) else record
    record = F.regexp_replace(record, r"[\r\n]+\z", "")
    parts = F.split(record, quote, -1)
    outside = _outside_quotes(record, quote)
    last = F.size(outside) - 1
    # after a stretch comes a delimiter, before one as well; nothing at all inside a cell is a doubled quote
    misplaced = F.exists(
        F.transform(outside, lambda x, i: (x != "") & (
            ((i > 0) & ~x.startswith(delimiter)) | ((i < last) & ~x.endswith(delimiter)))), lambda bad: bad)
    cells = F.aggregate(outside, F.lit(1), lambda n, x: n + F.length(x) - F.length(F.replace(x, F.lit(delimiter), F.lit(""))))
    texts = ", ".join(f"`c{i}` string" for i in range(len(fields)))
    options = {"sep": delimiter, "quote": quote, "escape": quote, "multiLine": "true"}
    as_text = F.from_csv(record, texts, options)
    bad = F.coalesce(*[F.when(as_text[f"c{i}"].isNotNull() & as_text[f"c{i}"].try_cast(f.dataType).isNull(), F.lit(f.name))
                       for i, f in enumerate(fields)])
    reason = (F.when((F.size(parts) % 2 == 0) | misplaced, "broken_quote")
              .when(cells < len(fields), "too_short").when(cells > len(fields), "too_long")
              .when(bad.isNotNull(), "bad_cell").otherwise("other"))
    return F.struct(reason.alias("reason"), F.when(reason == "bad_cell", bad).alias("column"))


def malformed_records(scanned: DataFrame, schema: T.StructType | str, delimiter: str = ",", quote: str = '"') -> DataFrame:
    """(record, reason, column) of every quarantined record (see :func:`record_problem`)."""
    return bad_rows(scanned).select(F.col(CORRUPT).alias("record"),
                                    record_problem(CORRUPT, schema, delimiter, quote).alias("p")).select("record", "p.*")


def malformed_reasons(scanned: DataFrame, schema: T.StructType | str, delimiter: str = ",", quote: str = '"') -> DataFrame:
    """(reason, column, n): quarantined records by what is wrong with them."""
    found = malformed_records(scanned, schema, delimiter, quote)
    return found.groupBy("reason", "column").agg(F.count(F.lit(1)).alias("n"))


def malformed_report(scanned: DataFrame) -> DataFrame:
    """Rows read, good and quarantined, in one aggregate pass."""
    return scanned.agg(
        F.count(F.lit(1)).cast("long").alias("rows_read"),
        F.sum(F.when(F.col("is_malformed"), 0).otherwise(1)).cast("long").alias("rows_good"),
        F.sum(F.when(F.col("is_malformed"), 1).otherwise(0)).cast("long").alias("rows_malformed"),
    )
