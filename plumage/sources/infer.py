"""Type inference over text that is landed already.

Spark's ``inferSchema`` parses the file once for the types and once more for
the rows. Here the file is parsed once, as text, into Parquet; one aggregate
collects for each column the set of types its cells have, as bits that merge by
OR, and a small lattice turns the set into the column's type. The rows are then
casts of the landed text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumage.session import cut_lineage
from plumage.sources.csv import read_csv

# One bit per type a cell can have, in the order in which they are tried.
INT, LONG, DECIMAL, DOUBLE, DATE, TIMESTAMP, BOOLEAN, STRING = (1 << i for i in range(8))
_MAX_DIGITS = 38


def cell_type(cell: Column) -> Column:
    """The bit of the first type that a text cell has; NULL for a NULL cell."""
    whole = cell.rlike(r"^[+-]?\d+\z")
    digits = F.length(F.regexp_replace(cell, r"^[+-]?0*", ""))
    return (F.when(whole & cell.try_cast("int").isNotNull(), INT)
            .when(whole & cell.try_cast("bigint").isNotNull(), LONG)
            .when(whole & (digits <= _MAX_DIGITS), DECIMAL)
            .when(cell.try_cast("double").isNotNull(), DOUBLE)
            .when(cell.rlike(r"^\d{4}(-\d{1,2}){0,2}\z") & cell.try_cast("date").isNotNull(), DATE)
            .when(cell.rlike("^[^:]*\\d[T ]\\d{1,2}:") & cell.try_cast("timestamp").isNotNull(), TIMESTAMP)
            .when(F.lower(cell).isin("true", "false"), BOOLEAN)
            .when(cell.isNotNull(), STRING))


def column_type(bits: int | None, digits: int = _MAX_DIGITS) -> str:
    """The narrowest type that holds all cells of a set of bits; text if there is none."""
    bits = bits or STRING
    if not bits & ~(INT | LONG):
        return "bigint" if bits & LONG else "int"
    if not bits & ~(INT | LONG | DECIMAL):
        return f"decimal({max(digits, 20) if bits & (INT | LONG) else digits},0)"
    if not bits & ~(INT | LONG | DECIMAL | DOUBLE):
        return "double"
    if not bits & ~(DATE | TIMESTAMP):
        return "timestamp" if bits & TIMESTAMP else "date"
    return "boolean" if bits == BOOLEAN else "string"


def infer_types(texts: DataFrame) -> dict[str, str]:
    """Type of each text column: one aggregate with one small integer per column and task."""
    names = texts.columns
    cells = [F.col(f"`{c}`") for c in names]
    digits = [F.max(F.when(c.rlike(r"^[+-]?\d+\z"), F.length(F.regexp_replace(c, r"^[+-]?0*", "")))) for c in cells]
    found = texts.agg(*[F.bit_or(cell_type(c)).alias(f"t{i}") for i, c in enumerate(cells)],
                      *[d.alias(f"d{i}") for i, d in enumerate(digits)]).first()
    return {c: column_type(found[f"t{i}"], min(found[f"d{i}"] or 1, _MAX_DIGITS)) for i, c in enumerate(names)}


def read_inferred(spark: SparkSession, path: str, *, header: bool = True, multi_line: bool = False, **options) -> DataFrame:
    """Rows of a CSV file with inferred types, the file being parsed once."""
    texts = cut_lineage(read_csv(spark, path, header=header, multi_line=multi_line, **options), "csv-text")
    types = infer_types(texts)
    return texts.select(*[F.col(f"`{c}`").try_cast(t).alias(c) for c, t in types.items()])
