"""Text cleaning and tokenising as native Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: every ASCII non-word character becomes one space (no collapsing). A space would
# become itself, so it is no match: most non-word characters of a text are spaces.
NON_WORD = r"[^\w ]"
# Unicode-aware variant (optional): accented letters stay letters.
NON_WORD_UNICODE = r"(?U)[^\w ]"

# The default English stop-word list of Spark ML's
# StopWordsRemover (181 words), in its natural order. Needed as text so the
# DuckDB oracle and the relational twin filter exactly the same words;
# tests assert it equals StopWordsRemover.loadDefaultStopWords("english").
ENGLISH_STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves "
    "he him his himself she her hers herself it its itself they them their "
    "theirs themselves what which who whom this that these those am is are was "
    "were be been being have has had having do does did doing a an the and but "
    "if or because as until while of at by for with about against between into "
    "through during before after above below to from up down in out on off over "
    "under again further then once here there when where why how all any both "
    "each few more most other some such no nor not only own same so than too "
    "very s t can will just don should now i'll you'll he'll she'll we'll "
    "they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're "
    "they're i've we've you've they've isn't aren't wasn't weren't haven't "
    "hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't "
    "can't couldn't cannot could here's how's let's ought that's there's what's "
    "when's where's who's why's would"
).split()


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def normalize_text(col: Column | str, unicode_words: bool = False) -> Column:
    """Replace each non-word character by a space, then lower-case."""
    pattern = NON_WORD_UNICODE if unicode_words else NON_WORD
    return F.lower(F.regexp_replace(_c(col), pattern, " "))


# Fixed value: Java's ``\s`` class (space, tab, newline, vertical tab, form feed, return).
JAVA_WHITESPACE = " \t\n\u000b\f\r"


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` (a lambda binding).

    A CASE expression that names its input in several branches would otherwise
    re-evaluate it per branch (generators get no common-subexpression
    elimination), which for a regex over a whole document costs 3x.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def tokenize(col: Column | str) -> Column:
    """Relational twin of ``ml.feature.Tokenizer``.

    Lower-case, split on every single whitespace character; leading and inner
    empty tokens are kept, trailing ones dropped; ``''`` gives ``['']`` and an
    all-blank string gives ``[]`` (Java ``String.split`` semantics).
    """
    def on_text(s):
        def on_body(body):
            return (F.when(s == "", F.array(F.lit("")))
                    .when(body == "", F.array().cast("array<string>"))
                    .otherwise(F.split(body, r"\s")))
        return let(F.rtrim(s, F.lit(JAVA_WHITESPACE)), on_body)
    return let(F.lower(_c(col)), on_text)


def remove_stop_words(tokens: Column | str, stop_words: list[str] | None = None) -> Column:
    """Relational twin of ``StopWordsRemover`` (case-insensitive)."""
    # ``isin`` over literals becomes a hash-set lookup (InSet), not a scan of
    # the 181-word list per token.
    words = stop_words or ENGLISH_STOP_WORDS
    return F.filter(_c(tokens), lambda t: ~F.lower(t).isin(*words))


def sql_string_list(words: list[str]) -> str:
    """Render words as a SQL string list literal body: 'a', 'b', ..."""
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)
