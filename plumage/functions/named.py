"""Functions that SQL text can call by name.

They are SQL functions with an expression as their body: the optimiser puts the
expression in their place, so a call is as good as the native column expression
and no user-defined function is in the plan.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from plumage.functions.hex import HEX_INT_PATTERN
from plumage.functions.text import NON_WORD


def _literal(text: str) -> str:
    return "r'" + text + "'"


# name -> (parameters, type of the result, body)
FUNCTIONS = {
    # the same rule as functions.hex.hex_to_int
    "toInteger": ("hex string", "int", f"""coalesce(try_cast(
        cast(conv(regexp_extract(hex, {_literal(HEX_INT_PATTERN)}, 2), 16, 10) as bigint)
        * if(startswith(hex, '-'), -1, 1) as int), 0)"""),
    # the same rule as functions.text.normalize_text
    "cleanText": ("text string", "string", f"lower(regexp_replace(text, {_literal(NON_WORD)}, ' '))"),
}


def register_functions(spark: SparkSession, names: tuple[str, ...] = tuple(FUNCTIONS)) -> None:
    """Make ``names`` known to the session's SQL text, ``expr`` and ``call_function``."""
    for name in names:
        parameters, result, body = FUNCTIONS[name]
        spark.sql(f"create or replace temporary function {name}({parameters}) returns {result} return {body}")
