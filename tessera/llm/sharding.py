"""Sharding by sampled splitters.

Records are ordered by a hash of their text (equal texts stand together), which is independent of
hot sources, languages and ids.  Unit: the rows of one text; a text with more than 1/OVERFULL of
all rows or bytes is subdivided, each of its ids being a unit.

1. A sample of units is drawn, weighted by their share of bytes and rows (about ``SAMPLE`` draws).
2. Its weighted quantiles split the order into ``RANGES`` ranges; ranges found overfull are
   subdivided by a denser sample of their own, until they are small or one unit.
3. Inside each range, running sums place every unit exactly; the ranges' own totals (a bounded
   table) give where each range starts.  Rows repeating id and text are counted, not carried.
4. A unit goes to the shard in which the middle of its bytes falls.  So shards differ from equal
   size by at most the units at their two ends, half of each.

The driver sees the sample, the splitters and the ranges' totals only: bounded by constants.

Defined results: a null text has size 1 and stands with the empty text; a null id ranks first; rows
repeating id and text get different slots of one shard; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import itertools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import counted, each_copy, masked, numbered, stored, unmasked

SHARDS = 16
RANGES = 1024
SAMPLE = 8 * RANGES
OVERFULL = 256
#: A range with more than so many times the mean weight is subdivided.
TOO_HEAVY = 8
SEED = 42
MAX_SUBDIVISIONS = 16
#: Slots of one shard that one task numbers when rows are written.
PART_SLOTS = 1 << 16

Splitters = list[tuple[int, int]]


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"), (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"), F.xxhash64(text).alias("h"),
    )


def _units(rows: DataFrame) -> tuple[DataFrame, DataFrame, int, int]:
    """Rows with their unit (h, sub), the units with rows n and bytes b, and all rows and bytes."""
    groups = stored(rows.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("b")), "shard-groups")
    total = groups.agg(F.sum("n").alias("n"), F.sum("b").alias("b")).first()
    n, b = total["n"] or 0, total["b"] or 0
    overfull = groups.where((F.col("n") * OVERFULL > n) | (F.col("b") * OVERFULL > b))  # under 2 * OVERFULL rows
    marked = rows.join(F.broadcast(overfull.select("h", F.lit(True).alias("over"))), "h", "left")
    first = F.coalesce("doc_id", F.lit(-(1 << 63)))
    rows = marked.withColumn("sub", F.when(F.col("over"), first).otherwise(F.lit(0).cast("long"))).drop("over")
    units = rows.groupBy("h", "sub").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("b"))
    return rows, stored(units, "shard-units"), n, b


def _draw(units: DataFrame, share: str, draws: float, seed: int) -> list[tuple[tuple[int, int], float]]:
    """About ``draws`` units for each 1 of summed share, weighted by it: (key, weight), in key order."""
    chance = F.shiftrightunsigned(F.xxhash64("h", "sub", F.lit(seed)), 11) / float(1 << 53)
    drawn = units.where(chance < F.col(share) * draws).select("h", "sub", F.greatest(F.lit(1.0), F.col(share) * draws).alias("w"))
    return sorted(((r["h"], r["sub"]), r["w"]) for r in drawn.collect())


def _quantiles(drawn: list[tuple[tuple[int, int], float]], parts: int) -> Splitters:
    """At most ``parts`` - 1 keys that cut the drawn weight into equal parts; a range starts at its splitter."""
    total = sum(w for _, w in drawn)
    out, before = [], 0.0
    for key, w in drawn:
        if before and before * parts >= total * (len(out) + 1):
            out.append(key)
        before += w
    return out


def _range_of(splitters: Splitters):
    keys = np.array([k for k, _ in splitters], np.int64)
    exact = set(keys.tolist())

    @F.pandas_udf("int")
    def find(h: pd.Series, sub: pd.Series) -> pd.Series:
        at = np.searchsorted(keys, h.to_numpy(np.int64), "right")
        for k in np.nonzero(h.isin(exact).to_numpy())[0].tolist():
            at[k] = bisect.bisect_right(splitters, (int(h.iat[k]), int(sub.iat[k])))
        return pd.Series(at.astype(np.int32))

    return find


def split(units: DataFrame, n: int, b: int) -> tuple[DataFrame, list[tuple[int, int, int, int]]]:
    """``units`` with their range, and of every range (number, units, rows, bytes)."""
    weighed = units.withColumn("share", (F.col("n") / n + F.col("b") / b) / 2)
    splitters = _quantiles(_draw(weighed, "share", SAMPLE, SEED), RANGES)
    for turn in range(1, MAX_SUBDIVISIONS + 1):
        ranged = weighed.withColumn("range", _range_of(splitters)("h", "sub"))
        found = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("u"), F.sum("n").alias("n"), F.sum("b").alias("b"), F.sum("share").alias("w"))
        totals = sorted((r["range"], r["u"], r["n"], r["b"], r["w"]) for r in found.collect())
        heavy = [r[0] for r in totals if r[1] > 1 and r[4] * RANGES > TOO_HEAVY]
        if not heavy:
            break
        again = _draw(ranged.where(F.col("range").isin(heavy)), "share", SAMPLE * 8 * turn, SEED + turn)
        find = {r: [] for r in heavy}
        for key, w in again:
            find[bisect.bisect_right(splitters, key)].append((key, w))
        more = itertools.chain.from_iterable(_quantiles(d, 2 * TOO_HEAVY) for d in find.values())
        splitters = sorted({*splitters, *more})
    return ranged, [r[:4] for r in totals]


def sharded(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, h (the text's hash), shard and slot of every row: sizes near equal."""
    spark = docs.sparkSession
    rows, units, n, b = _units(stored(_rows(docs, id_col, text_col), "shard-rows"))
    if not n:
        return rows.select("doc_id", "size", "text_crc32", "h", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    ranged, totals = split(units, n, b)
    starts, row_start, byte_start = [], 0, 0
    for number, _, range_rows, range_bytes in totals:
        starts.append((number, row_start, byte_start))
        row_start += range_rows
        byte_start += range_bytes
    start = spark.createDataFrame(starts, "range int, row_start long, byte_start long")
    before = W.partitionBy("range").orderBy("h", "sub").rowsBetween(W.unboundedPreceding, -1)
    placed = ranged.withColumn("_r", F.coalesce(F.sum("n").over(before), F.lit(0))).withColumn("_b", F.coalesce(F.sum("b").over(before), F.lit(0)))
    placed = placed.join(F.broadcast(start), "range").withColumn("first_row", F.col("row_start") + F.col("_r"))
    middle = 2 * (F.col("byte_start") + F.col("_b")) + F.col("b")
    placed = placed.withColumn("shard", F.least(F.lit(shards - 1), F.floor(middle * shards / (2 * b)).cast("int")))
    placed = stored(placed.select("h", "sub", "first_row", "shard"), "shard-places")
    firsts = placed.groupBy("shard").agg(F.min("first_row").alias("shard_row"))  # one row a shard
    placed = placed.join(F.broadcast(firsts), "shard").select("h", "sub", "shard", (F.col("first_row") - F.col("shard_row")).alias("at"))
    # rows repeating id and text are counted, spread in chunks, and only then rows again
    inside = W.partitionBy("h", "sub").orderBy("doc_id", "size", "text_crc32", "_chunk").rowsBetween(W.unboundedPreceding, -1)
    ranked = counted(rows).withColumn("_k", F.coalesce(F.sum("_copies").over(inside), F.lit(0)))
    out = ranked.join(placed, ["h", "sub"]).withColumn("slot", F.col("at") + F.col("_k"))
    out = each_copy(out.repartition("h", "sub", "doc_id", "_chunk"), "slot")
    return out.select("doc_id", "size", "text_crc32", "h", "shard", F.col("slot").cast("long").alias("slot"))


def _nth(df: DataFrame, part: Column, order: list[str]) -> DataFrame:
    """``df`` with _same (id and text, columns _i and _h) and _k, a row's number among those with the same; one task
    numbers the rows of one ``part`` only."""
    same = F.struct(F.coalesce("_i", F.lit(0)).alias("i"), F.col("_i").isNull().alias("none"), F.col("_h").alias("h"))
    return numbered(df.select("*", same.alias("_same"), F.lit(1).cast("long").alias("_copies")), part, order, "_same", "_k")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> None:
    """``docs`` as Parquet, one folder a shard (``_shard=k``), with ``_slot``.

    The rows are stored once under a number; only the numbers meet the slots.  Rows that repeat id and text are
    told apart by their place in the stored parts, so however many they are, no task numbers all of them.
    """
    hidden, names = masked(docs)
    text = F.coalesce(F.col(names[text_col]).cast("string"), F.lit(""))
    keys = [F.col(names[id_col]).cast("long").alias("_i"), F.xxhash64(text).alias("_h"), F.monotonically_increasing_id().alias("_u")]
    rows = stored(hidden.select("*", *keys), "shard-input")
    places = sharded(unmasked(rows, names), shards, id_col, text_col)
    places = stored(places.select(F.col("doc_id").alias("_i"), F.col("h").alias("_h"), F.col("shard").alias("_shard"), F.col("slot").alias("_slot")), "shard-slots")
    given = _nth(rows.select("_i", "_h", "_u"), F.shiftright("_u", 33), ["_u"]).select("_same", "_k", "_u")
    part = F.col("_shard").cast("long") * (1 << 40) + F.expr(f"_slot div {PART_SLOTS}")
    to = _nth(places, part, ["_shard", "_slot"]).select("_same", "_k", "_shard", "_slot")
    met = rows.join(given.join(to, ["_same", "_k"]).select("_u", "_shard", "_slot"), "_u")
    met.select(*[F.col(n).alias(c) for c, n in names.items()], "_shard", "_slot").write.partitionBy("_shard").parquet(path)


def op5_sharding(documents: DataFrame) -> DataFrame:
    found = sharded(documents)
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
