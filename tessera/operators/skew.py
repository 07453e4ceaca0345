"""A join for keys that may hold a large share of the rows.

Hashing sends all rows of a key to one task.  :func:`skew_join` measures the
left side's keys first; each heavy one is split over several salts, the right rows of
that key are copied to each of them, and everything else is joined as usual - in
one plan with one join, by key and salt.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys with more than 1/HEAVY_SHARE of the left rows are heavy: fewer than HEAVY_SHARE of them, whatever the size.
HEAVY_SHARE = 1000


def heavy_keys(df: DataFrame, keys: Sequence[str], parts: int, heavy_share: int = HEAVY_SHARE) -> DataFrame:
    """``keys`` with ``_parts``: how many parts of 1/``parts`` of all rows a heavy key has, rounded up.

    A count per key, partially aggregated in each task, so a hot key is one
    row per task.  Keys with a null never match and are not heavy.
    """
    known = df.dropna(subset=list(keys))
    counts = known.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = df.select(F.count(F.lit(1))).scalar()
    heavy = counts.where(F.col("_n") * F.lit(heavy_share) > total)
    return heavy.select(*keys, F.ceil(F.col("_n") * F.lit(parts) / total).cast("int").alias("_parts"))


def skew_join(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner", *, parts: int,
              spread: Sequence[str] | None = None, heavy_share: int = HEAVY_SHARE) -> DataFrame:
    """``left.join(right, on, how)`` whose heavy left keys are split into parts of about 1/``parts`` of the left rows.

    ``parts`` is about the number of join tasks.  ``how``: inner, left,
    left_semi or left_anti; each left row meets all right rows of its key
    exactly once, in its own salt.  A left row's salt is a hash of ``spread`` (default: the
    whole row), a pure function of the row, so a recomputed task agrees.
    Right rows are copied only for heavy keys, at most ``parts`` times; those are
    the keys' dimension rows and few where a join like this is used.  The heavy keys (fewer than
    ``heavy_share`` by definition) are broadcast.
    """
    keys = [on] if isinstance(on, str) else list(on)
    kind = how.lower().replace("leftouter", "left").replace("left_outer", "left")
    if kind not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("the right side is copied for heavy keys: how must be inner, left, left_semi or left_anti")
    heavy = F.broadcast(heavy_keys(left, keys, parts, heavy_share))
    mixed = F.xxhash64(F.lit("salt"), *(spread or left.columns))
    salt = F.when(F.col("_parts").isNotNull(), F.pmod(mixed, F.col("_parts"))).otherwise(F.lit(0)).cast("int")
    salted = left.join(heavy, keys, "left").withColumn("_salt", salt).drop("_parts")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))
    copied = right.join(heavy, keys, "left").withColumn("_salt", copies).drop("_parts")
    return salted.join(copied, [*keys, "_salt"], kind).drop("_salt")
