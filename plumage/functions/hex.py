"""Hex colour string -> 32-bit signed integer, as a native Column expression.

Contract: the value a strict base-16 ``int`` parse would give (optional sign,
any number of leading zeros, no whitespace, must fit a signed 32-bit int), and
0 for every input that does not parse, NULL included. Built from ``regexp_extract`` +
``conv`` so it stays inside whole-stage codegen instead of a row-at-a-time UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted shape of a hex integer. ``\z`` (not ``$``) so a
# trailing newline is rejected.
HEX_INT_PATTERN = r"^([+-]?)0*([0-9A-Fa-f]{1,8})\z"
INT_MIN = -(2**31)
INT_MAX = 2**31 - 1


def hex_to_int(col: Column | str) -> Column:
    s = F.col(col) if isinstance(col, str) else col
    digits = F.regexp_extract(s, HEX_INT_PATTERN, 2)  # '' when the input does not parse: conv gives NULL
    magnitude = F.conv(digits, 16, 10).cast("bigint")
    signed = magnitude * F.when(s.startswith("-"), -1).otherwise(1)
    return F.coalesce(signed.try_cast("int"), F.lit(0))  # NULL beyond 32 bits


def hex_to_int_sql(expr: str) -> str:
    """The same rule in DuckDB SQL, for oracle queries."""
    pat = "'([+-]?)0*([0-9A-Fa-f]{1,8})'"
    val = (
        f"(case when regexp_extract({expr}, {pat}, 1) = '-' then -1 else 1 end"
        f" * ('0x' || regexp_extract({expr}, {pat}, 2))::bigint)"
    )
    return (
        f"(case when {expr} is not null and regexp_full_match({expr}, {pat})"
        f" and {val} between {INT_MIN} and {INT_MAX} then {val} else 0 end)::integer"
    )
