"""Small helpers the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.session import fresh_path

#: Groups with more than 1/HEAVY_SHARE of all weight are "heavy": by definition there are
#: fewer than HEAVY_SHARE of them, whatever the size of the input, so they may be broadcast.
HEAVY_SHARE = 1000
#: Copies of one row that stay in one task when repeated rows are counted.
COPIES = 4096


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def attach(rows: DataFrame, groups: DataFrame, keys: list[str], weight: str, total: float, spread: Column) -> DataFrame:
    """``rows`` with the columns of their group (one row of ``groups`` for each value of ``keys``).

    Groups holding more than 1/HEAVY_SHARE of ``total`` are broadcast (fewer than HEAVY_SHARE
    rows by definition) and their rows are spread by the hash of ``spread``; the rest meet in an
    ordinary join.  Every row of ``rows`` must have a group.
    """
    extra = [c for c in groups.columns if c not in keys]
    heavy = groups.where(F.col(weight) * HEAVY_SHARE > total)
    heavy = heavy.select(*keys, *[F.col(c).alias(f"_hv_{c}") for c in extra], F.lit(True).alias("_hv"))
    light = groups.where(F.col(weight) * HEAVY_SHARE <= total)
    # always 0, but no constant: the optimizer would take a constant out of the join's keys, and heavy rows would meet in one task
    zero = F.pmod(F.xxhash64(*keys), F.lit(1)).cast("long").alias("_salt")
    light = light.select(*keys, *[F.col(c).alias(f"_lt_{c}") for c in extra], zero)
    met = rows.join(F.broadcast(heavy), keys, "left")
    met = met.withColumn("_salt", F.when(F.col("_hv"), F.pmod(F.xxhash64(spread), F.lit(100003)) + 1).otherwise(F.lit(0)).cast("long"))
    met = met.join(light, [*keys, "_salt"], "left")
    picked = [F.when(F.col("_hv"), F.col(f"_hv_{c}")).otherwise(F.col(f"_lt_{c}")).alias(c) for c in extra]
    return met.select(*rows.columns, *picked)


def counted(df: DataFrame) -> DataFrame:
    """The distinct rows of ``df`` with _copies, how often each occurs; a row with more than COPIES
    copies is several rows, told apart by _chunk, so copies of one row can spread over tasks."""
    whole = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    cut = whole.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_n - 1) div {COPIES}"))))
    return cut.withColumn("_copies", F.least(F.lit(COPIES), F.col("_n") - F.col("_chunk") * COPIES)).drop("_n")


def numbered(df: DataFrame, part: Column, order: list[str], group: str, alias: str) -> DataFrame:
    """Rows of ``counted`` with the number of their first copy, gapless from 0 within each value of ``group``.

    Rows are numbered inside small parts (``part``: a hash bucket, or a range) by ``order``; the
    parts' counts, one row each, are summed up in the order of the parts.  No task sees more than
    one part, or the counts of one group.
    """
    by = [group, "_part"]
    parted = df.withColumn("_part", part)
    counts = parted.groupBy(*by).agg(F.sum("_copies").alias("_held"))
    before = W.partitionBy(group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(*by, F.coalesce(F.sum("_held").over(before), F.lit(0)).alias("_start"))
    inside = W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    ranked = parted.withColumn("_rank", F.coalesce(F.sum("_copies").over(inside), F.lit(0)))
    return ranked.join(starts, by).withColumn(alias, F.col("_start") + F.col("_rank")).drop("_part", "_rank", "_start")


def each_copy(df: DataFrame, first: str) -> DataFrame:
    """Every copy of the rows of ``counted``, numbered on from the column ``first``."""
    numbers = F.explode(F.sequence(F.col(first), F.col(first) + F.col("_copies") - 1))
    return df.withColumn(first, numbers).drop("_chunk", "_copies")


def masked(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its columns renamed c0_, c1_, ..., so none clashes with an operator's own; and the names."""
    names = {c: f"c{k}_" for k, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def unmasked(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(n).alias(c) for c, n in names.items()])


def row_hash(df: DataFrame) -> Column:
    """A hash of the whole row (columns that hold maps or variants have none)."""
    return F.xxhash64(*[df[c] for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind])


def keep_rows(docs: DataFrame, keepers: DataFrame, id_col: str, key: str, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` named by ``keepers`` (_kid and _kkey: id and ``key``); of rows equal in both one,
    that with the least row hash.  ``key`` is "hash" (the row's) or "digest" (the text's SHA-256).

    The null id is told apart by a column of its own, so join and window share one shuffle of the rows.
    """
    hidden, names = masked(docs)
    text = F.coalesce(F.col(names[text_col]).cast("string"), F.lit(""))
    rows = hidden.select("*", F.col(names[id_col]).cast("long").alias("_i"), row_hash(hidden).alias("_tie"))
    rows = rows.withColumn("_key", F.unhex(F.sha2(text, 256)) if key == "digest" else F.col("_tie"))
    keys = ["_key", "_known", "_none"]
    rows = rows.select("*", F.coalesce("_i", F.lit(0)).alias("_known"), F.col("_i").isNull().alias("_none"))
    kept = keepers.select(F.col("_kkey").alias("_key"), F.coalesce("_kid", F.lit(0)).alias("_known"), F.col("_kid").isNull().alias("_none"))
    met = rows.join(kept, keys, "left_semi")
    first = W.partitionBy(*keys).orderBy("_tie")
    return unmasked(met.withColumn("_rn", F.row_number().over(first)).where("_rn = 1"), names)
