"""Column-expression helpers (no Python UDFs)."""

from tessera.functions.stopwords import ENGLISH, EXTRA, POLISH, reference_stop_words
from tessera.functions.text import clean_tokens, remove_stop_words, strip_double_quotes, tokenize
from tessera.functions.timeuuid import (
    created_before,
    made_on_or_after_day,
    make_timeuuid,
    midnight_micros,
    midnight_millis,
    timeuuid_micros,
    timeuuid_ticks,
    timeuuid_timestamp,
)
from tessera.functions.vectors import (
    dense_cosine,
    dense_dot,
    dense_norm,
    dense_normalize,
    dot,
    long_dot,
    sparse,
    sparse_dense_dot,
    sparse_dot,
    sparse_normalize,
)

__all__ = [
    "ENGLISH", "EXTRA", "POLISH", "reference_stop_words",
    "clean_tokens", "remove_stop_words", "strip_double_quotes", "tokenize",
    "created_before", "made_on_or_after_day", "make_timeuuid", "midnight_micros",
    "midnight_millis", "timeuuid_micros", "timeuuid_ticks", "timeuuid_timestamp",
    "dense_cosine", "dense_dot", "dense_norm", "dense_normalize", "dot", "long_dot",
    "sparse", "sparse_dense_dot", "sparse_dot", "sparse_normalize",
]
