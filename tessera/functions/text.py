"""Text cleaning and tokenizing as column expressions.

These reproduce ``ml.feature.Tokenizer`` (lower-case, split on single white
space characters) and a case-insensitive ``ml.feature.StopWordsRemover`` with
higher-order functions, so the work stays inside whole-stage code generation
and needs no Python.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.stopwords import reference_stop_words

# Java's \s: space, tab, newline, vertical tab, form feed, carriage return.
WHITESPACE_PATTERN = r"\s"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip_double_quotes(text_col) -> Column:
    """remove every ``"``; null stays null (the reference raised on null)."""
    return F.replace(_c(text_col), F.lit('"'), F.lit(""))


def tokenize(text_col) -> Column:
    """lower-case and split on each white-space character.

    Consecutive blanks give empty tokens, as the ML Tokenizer does; the stop
    list removes them.
    """
    return F.split(F.lower(_c(text_col)), WHITESPACE_PATTERN)


def remove_stop_words(tokens_col, stop_words: Iterable[str] | None = None) -> Column:
    """drop tokens found in ``stop_words``, ignoring case.

    The list becomes an ``InSet`` (hash lookup) inside the lambda; it is a
    literal of the plan, shipped once with the task, not a join.
    """
    lowered = stop_word_set(stop_words)
    return F.filter(_c(tokens_col), lambda t: ~F.lower(t).isin(lowered))


def clean_tokens(text_col, stop_words: Iterable[str] | None = None) -> Column:
    """F1 -> F3 -> F4 in one expression: the cleaned token list of each row."""
    return remove_stop_words(tokenize(strip_double_quotes(text_col)), stop_words)


def stop_word_set(stop_words: Iterable[str] | None = None) -> list[str]:
    words = reference_stop_words() if stop_words is None else list(stop_words)
    return sorted({w.lower() for w in words})


def exploded_terms(df, text_col, stop_words: Iterable[str] | DataFrame | None = None, keep=()):
    """F1 -> F3 -> explode -> F4: one row per kept token.

    Same tokens as ``explode(clean_tokens(...))``, but the stop-word test is
    a plain ``NOT IN`` set predicate on the exploded column, which whole-stage
    code generation compiles; inside a lambda it would be interpreted per
    element.  Tokens are already lower case (the text is lowered before the
    split), so the case-insensitive test needs no second ``lower``.  A stop
    list given as a DataFrame (column ``word``) is an anti join, whatever its
    length.
    """
    terms = df.select(*keep, F.explode(tokenize(strip_double_quotes(text_col))).alias("term"))
    if isinstance(stop_words, DataFrame):
        return terms.join(stop_words.select(F.lower("word").alias("term")).distinct(), "term", "left_anti")
    return terms.where(~F.col("term").isin(stop_word_set(stop_words)))
