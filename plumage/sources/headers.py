"""CSV files whose header lines differ: columns are taken by name.

With an explicit schema Spark takes columns by position, whatever the header
says. Here each file's header line is read first (a few bytes per file, on the
driver), files with the same header are read together in one scan with the
columns in that header's order, and the parts are put together by name.
"""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumage.sources.csv import as_schema, read_csv

_READERS = 16


class HeaderError(ValueError):
    """A file's header has columns that the schema does not have, lacks some, or names one twice."""


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The files that a read of ``path`` would read."""
    return list(spark.read.text(path).inputFiles())


def header_of(spark: SparkSession, file: str, delimiter: str = ",", quote: str = '"') -> tuple[str, ...]:
    """The cells of a file's first line (a header cell has no line break): one small read."""
    line = spark.read.text(file).first()
    return tuple(next(csv.reader([line["value"]], delimiter=delimiter, quotechar=quote), ())) if line else ()


def header_groups(spark: SparkSession, path: str, **kinds) -> dict[tuple[str, ...], list[str]]:
    """Files by their header."""
    files = data_files(spark, path)
    groups: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(_READERS) as pool:
        for file, names in zip(files, pool.map(lambda f: header_of(spark, f, **kinds), files)):
            if names:  # a file without a line has no rows
                groups.setdefault(names, []).append(file)
    return groups


def header_report(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """(header, files, unknown, missing, repeated): each header found and what is wrong with it."""
    known = as_schema(schema).names
    rows = []
    for names, files in header_groups(spark, path).items():
        rows.append((list(names), len(files), [c for c in names if c not in known], [c for c in known if c not in names],
                     sorted({c for c in names if names.count(c) > 1})))
    return spark.createDataFrame(
        rows, "header array<string>, files int, unknown array<string>, missing array<string>, repeated array<string>")


def read_by_name(spark: SparkSession, path: str, schema: T.StructType | str, *, multi_line: bool = False,
                 **options) -> DataFrame:
    """Rows of all files with the columns of ``schema``, each taken by its name in the file's header.

    The order of a header's columns does not matter; any other difference is a
    :class:`HeaderError`, raised before a row is read.
    """
    wanted = as_schema(schema)
    parts = []
    for names, files in sorted(header_groups(spark, path).items()):
        if sorted(names) != sorted(wanted.names):
            unknown = [c for c in names if c not in wanted.names]
            missing = [c for c in wanted.names if c not in names]
            raise HeaderError(f"{len(files)} files, {files[0]} first: unknown columns {unknown}, missing {missing}, "
                              f"header {list(names)}")
        in_file = T.StructType([wanted[c] for c in names])
        part = read_csv(spark, files, in_file, header=True, multi_line=multi_line, **options)
        parts.append(part.select(*[F.col(f"`{c}`") for c in wanted.names]))
    if not parts:
        return spark.createDataFrame([], wanted)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
