"""Cleaning, tokens, n-grams and display forms of short texts. All linear, all inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters, digits and underscore of any script; a token has at least two of them.
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"
PUNCTUATION_PATTERN = r"[^\p{L}\p{N}_\s\x0B\x1C-\x1F\x{85}\p{Z}]"

# Common English function words. The list is a parameter wherever it is used: pass another one to
# reproduce a particular vectorizer.
STOP_WORDS = tuple(
    """
    about above after again all also am an and any are as at be because been before being below between both
    but by can could did do does doing down during each few for from further had has have having he her here
    hers him his how if in into is it its itself just me more most my no nor not now of off on once only or
    other our ours out over own same she should so some such than that the their theirs them then there these
    they this those through to too under until up very was we were what when where which while who whom why
    will with you your yours
    """.split()
)


def clean(text: Column) -> Column:
    """Lower case without punctuation; white space stays."""
    return F.regexp_replace(F.lower(text), PUNCTUATION_PATTERN, "")


def tokens(text: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    found = F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))
    return F.filter(found, lambda word: ~word.isin(list(stop_words))) if stop_words else found


def with_bigrams(words: Column) -> Column:
    """The words followed by every pair of neighbours. ``words`` should be a column, not an expression."""
    n = F.size(words)
    pairs = F.when(
        n >= 2,
        F.zip_with(F.slice(words, F.lit(1), n - 1), F.slice(words, F.lit(2), n - 1), lambda a, b: F.concat_ws(" ", a, b)),
    ).otherwise(F.array().cast("array<string>"))
    return F.concat(words, pairs)


def truncated(text: Column, limit: int) -> Column:
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("..."))).otherwise(text)


def title_words(snake: Column) -> Column:
    """``deep_orange`` -> ``Deep Orange``."""
    return F.initcap(F.replace(snake, F.lit("_"), F.lit(" ")))


def title_parts(snake: Column) -> Column:
    """``power_substation`` -> ``Power_Substation``."""
    return F.replace(F.initcap(F.replace(snake, F.lit("_"), F.lit(" "))), F.lit(" "), F.lit("_"))
