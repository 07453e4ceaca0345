"""The labelled rows a classifier may learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEED = 42


def held_out(doc_id: Column) -> Column:
    """True for the rows no classifier learns from: crc32 of the id as text, mod 3, is 1.  A null id counts as empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 3 == 1


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, bound: int) -> DataFrame:
    """(text, y, weight) of labelled documents that aren't held out, about ``bound`` / 2 of each class.

    The draw is by a hash of the id, so it is the same on every cluster; ``weight`` restores the
    classes' shares.  Ids whose labels contradict each other are left out.  The drawn ids (about
    ``bound`` rows) are broadcast, and of the rows of one id the text of least hash stays: one row
    an id, found in every task before the drawn texts are shuffled.  Other documents are not shuffled.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
    one = usable.groupBy("doc_id").agg(F.min(label).alias("y"), F.max(label).alias("_most")).where("y = _most").select(F.col("doc_id").cast("long").alias("_lid"), F.col("y").cast("int").alias("y"))
    counts = {r["y"]: r["n"] for r in one.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = {y: min(1.0, bound / 2 / n) for y, n in counts.items()}
    unit = F.shiftrightunsigned(F.xxhash64("_lid", F.lit(SEED)), 11) / float(1 << 53)
    chance = F.when(F.col("y") == 1, F.lit(share.get(1, 0.0))).otherwise(F.lit(share.get(0, 0.0)))
    weight = F.when(F.col("y") == 1, F.lit(1 / share.get(1, 1.0))).otherwise(F.lit(1 / share.get(0, 1.0)))
    drawn = one.where(unit < chance).withColumn("weight", weight)
    text = F.coalesce(documents["text"].cast("string"), F.lit("")).alias("text")
    given = documents.select(documents["doc_id"].cast("long").alias("_lid"), text)
    met = given.join(F.broadcast(drawn), "_lid")
    least = F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("least")
    return met.groupBy("_lid", "y", "weight").agg(least).select(F.col("_lid").alias("doc"), F.col("least.text").alias("text"), "y", "weight")
