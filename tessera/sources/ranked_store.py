"""Ranked per-user lists: write and read back.

The reference kept each user's top list in a sorted set under the key
``cfr:movie:<user>`` (score = predicted rating, member = JSON of the film),
flushing the *whole* store before each write.  Here the store is an
append-only Parquet table:

* rows ``(buckets, bucket, user_id, key, score, member, batch, movie_id, replaces)``,
  directory-partitioned by ``buckets``, the writer's bucket count, and ``bucket
  = pmod(xxhash64(user_id), buckets)`` - bounded directory count however many
  users there are.  The count is stored with the data, so a reader needs no
  setting and writes with different counts may share a store;
* ``scope="user"`` appends a new ``batch`` that replaces the lists of the users in it;
* ``scope="merge"`` appends a batch that adds to the users' lists: a film already
  there gets the new score, others join it;
* ``scope="all"`` overwrites everything (the reference's flush).

A list is a set, as a sorted set is: every film once, with its last score.  A
write keeps a film's best score where its rows repeat one; a read takes the
user's latest replacing batch and the merged ones after it, and of each film
the latest batch's row.  Both are first-row windows; in a write Spark limits
them to one row per key and task before the shuffle.
"""

from __future__ import annotations

import time
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.keyed import dedupe_by_key, top_k_per_group
from tessera.session import shuffle_partitions

# --- fixed values -------------------------------------------------------------
KEY_PREFIX = "cfr:movie:"
MEMBER_SCHEMA = "movieId int, title string, rating double"
STORE_SCHEMA = "user_id int, key string, score double, member string, batch bigint, movie_id int, replaces boolean, buckets int, bucket int"
# -------------------------------------------------------------------------------
DEFAULT_BUCKETS = 64
# as a sorted set's reverse range: score, then member text, both descending

def _bucket(user, buckets):
    return F.pmod(F.xxhash64(user.cast("int")), buckets).cast("int")


def _best() -> list:
    """The order of a sorted set's reverse range: score, then member text, both descending."""
    return [F.col("score").desc(), F.col("member").desc()]


def write_ranked(
    df: DataFrame,
    path: str,
    scope: str = "user",
    batch: int | None = None,
    user_col: str = "user_id",
    num_buckets: int = DEFAULT_BUCKETS,
    keep: int | None = None,
) -> str:
    """Store each user's ``(movieId, title, rating)`` rows as a ranked list.

    The member is the JSON of the film (F14) and the score its rating.  A
    film's rows collapse to the one of highest score.  With ``keep`` only each
    user's ``keep`` best films are written: enough for reads of up to that many as long as
    later batches only add films or raise scores.
    """
    if scope not in ("user", "merge", "all"):
        raise ValueError("scope must be 'user', 'merge' or 'all'")
    batch = time.time_ns() if batch is None else batch
    rows = df.select(
        F.col(user_col).cast("int").alias("user_id"),
        F.concat(F.lit(KEY_PREFIX), F.col(user_col).cast("string")).alias("key"),
        F.col("rating").cast("double").alias("score"),
        F.to_json(
            F.struct(
                F.col("movieId").cast("int").alias("movieId"),
                F.col("title").cast("string").alias("title"),
                F.col("rating").cast("double").alias("rating"),
            )
        ).alias("member"),
        F.col("movieId").cast("int").alias("movie_id"),
    )
    if dict(df.dtypes)[user_col] == "int":  # the key follows from the id, so it need not be shuffled
        rows = rows.withColumn("key", F.lit(None))
    rows = dedupe_by_key(rows, ["user_id", "movie_id"], _best())
    if keep is not None:
        rows = top_k_per_group(rows, "user_id", _best(), keep, None)
    # each bucket is cut into `slices` by a second, independent hash, so there
    # are about as many writer tasks as shuffle partitions (not just one per
    # bucket), each task writes about one file, and no sampling pass
    # re-evaluates the (possibly expensive) input as range partitioning would;
    # rows sorted by user let min/max statistics prune reads
    slices = max(1, shuffle_partitions(df.sparkSession) // num_buckets)
    bucket = _bucket(F.col("user_id"), F.lit(num_buckets))
    rows = rows.repartition(num_buckets * slices, bucket, F.pmod(F.xxhash64(F.col("user_id"), F.lit("slice")), F.lit(slices)))
    rows = rows.select(
        F.lit(num_buckets).alias("buckets"),
        bucket.alias("bucket"),
        "user_id",
        F.coalesce("key", F.concat(F.lit(KEY_PREFIX), F.col("user_id").cast("string"))).alias("key"),
        "score",
        "member",
        F.lit(batch).cast("bigint").alias("batch"),
        "movie_id",
        F.lit(scope != "merge").alias("replaces"),
    ).sortWithinPartitions("bucket", "user_id")
    mode = "overwrite" if scope == "all" else "append"
    rows.write.mode(mode).option("partitionOverwriteMode", "static").partitionBy("buckets", "bucket").parquet(path)
    return path


def read_ranked(
    spark: SparkSession,
    path: str,
    users,
    k: int = 10,
    user_col: str = "user_id",
) -> DataFrame:
    """Each requested user's ``k`` best films, highest score first, with their rank.

    ``users`` is an id, a list of ids, or a DataFrame with a ``user_id``
    column.  Ties are ordered by member text, descending, as a sorted set's
    reverse range does.  Unknown users give no rows.
    """
    stored, wanted = spark.read.schema(STORE_SCHEMA).parquet(path), None
    if isinstance(users, DataFrame):
        wanted = users.select(F.col(user_col).cast("int").alias("user_id")).distinct()
    else:
        ids = [int(users)] if isinstance(users, int) else [int(u) for u in users]
        # a bucket predicate over the directory columns alone: partition pruning
        places = [F.col("bucket") == _bucket(F.lit(u), F.col("buckets")) for u in ids]
        stored = stored.where(F.col("user_id").isin(ids) & reduce(lambda a, b: a | b, places, F.lit(False)))
    current = _latest_lists(stored, wanted).select("user_id", "score", "member")
    top = top_k_per_group(current, "user_id", _best(), k)
    parsed = top.select("user_id", "rank", F.from_json("member", MEMBER_SCHEMA).alias("m"))
    return parsed.select("user_id", "rank", "m.movieId", "m.title", "m.rating")


def _latest_lists(stored: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """The current rows of each user: every film once, from the latest batch that names it.

    A user's live batches are the latest replacing one and those after it: a
    grouped max per user, partially aggregated, so a user rewritten many times
    is a row per task there.  ``wanted`` (user_id, distinct) asks for some users
    and comes in by the same join, which drops the old batches.  The rows are
    thus brought together by user once, and the windows by (user, film) and by user
    that follow need no further shuffle; when the users are few Spark broadcasts
    them and the windows shuffle the rows found.
    """
    replaces = F.coalesce("replaces", F.lit(True))
    since = stored.groupBy("user_id").agg(F.max(F.when(replaces, F.col("batch"))).alias("_since"))
    if wanted is not None:
        since = since.join(wanted, "user_id", "left_semi")
    rows = stored.join(since, "user_id").where(F.col("batch") >= F.coalesce("_since", "batch"))
    film = F.coalesce("movie_id", F.from_json("member", MEMBER_SCHEMA)["movieId"])
    found = rows.select("user_id", "score", "member", "batch", film.alias("_film"))
    return dedupe_by_key(found, ["user_id", "_film"], [F.col("batch").desc(), *_best()]).drop("_film")


def compact_ranked(spark: SparkSession, path: str, out_path: str, num_buckets: int = DEFAULT_BUCKETS,
                   batch: int | None = None, keep: int | None = None) -> str:
    """Rewrite the store at ``path`` into ``out_path`` keeping only each user's current list, ``keep`` films of it.

    ``scope="user"`` and ``"merge"`` writes append a batch per write; compaction bounds what a
    read has to merge.  Readers switch to ``out_path`` afterwards (a path the
    plan reads cannot be overwritten by the same plan).
    """
    current = _latest_lists(spark.read.schema(STORE_SCHEMA).parquet(path))
    films = current.select(
        "user_id", F.from_json("member", MEMBER_SCHEMA).alias("m")
    ).select("user_id", "m.movieId", "m.title", "m.rating")
    return write_ranked(films, out_path, scope="all", batch=batch, num_buckets=num_buckets, keep=keep)
