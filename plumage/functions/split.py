"""Deterministic train/test assignment from a row key.

``randomSplit`` depends on the physical layout (row order inside partitions),
so the same seed gives a different split after a repartition. Hashing a stable
key gives the same split on any layout, any cluster size, and in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0


def split_fraction(key: Column | str, seed: int = 46) -> Column:
    """A value in [0, 1): first 8 hex digits of md5('<seed>:<key>') / 2^32."""
    k = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(F.lit(f"{seed}:"), k.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(TWO_POW_32)


def split_label(key: Column | str, train_fraction: float = 0.7, seed: int = 46) -> Column:
    """``train`` or ``test``; NULL for a NULL key, which no split may claim."""
    fraction = split_fraction(key, seed)
    return F.when(fraction < train_fraction, F.lit("train")).when(fraction.isNotNull(), F.lit("test"))


def split_label_sql(key: str, train_fraction: float = 0.7, seed: int = 46) -> str:
    frac = f"(('0x' || substr(md5('{seed}:' || cast({key} as varchar)), 1, 8))::bigint / {TWO_POW_32})"
    return f"(case when {frac} < {train_fraction} then 'train' when {frac} is not null then 'test' end)"
