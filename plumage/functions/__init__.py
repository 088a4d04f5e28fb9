"""Column-expression functions (all JVM-side, no Python UDFs)."""

from plumage.functions.hex import hex_to_int
from plumage.functions.rounding import percent
from plumage.functions.split import split_fraction, split_label
from plumage.functions.text import (
    ENGLISH_STOP_WORDS,
    normalize_text,
    remove_stop_words,
    tokenize,
)

__all__ = [
    "ENGLISH_STOP_WORDS",
    "hex_to_int",
    "normalize_text",
    "percent",
    "remove_stop_words",
    "split_fraction",
    "split_label",
    "tokenize",
]
