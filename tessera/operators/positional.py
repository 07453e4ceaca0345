"""Positional operators: a distributed global row number and the cycled zip.

``row_number().over(Window.orderBy(...))`` without a partition moves every
row into one task.  :func:`global_row_number` instead cuts the order into
ranges at splitters drawn once and kept as constants of the plan.  The range of
a row is then a pure function of its key, so the counts per range and the
numbering inside a range agree whoever evaluates them and however often: no
copy of the rows is written.  The counts are one number per range: a scalar
subquery bounded by the number of ranges, not by the data.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import shuffle_partitions

#: Sampled keys for each range: more make the ranges more even.
SAMPLE_PER_RANGE = 32

_INTEGERS = {"bigint", "int", "smallint", "tinyint"}
# types whose values JSON keeps exactly
_JSON_KINDS = {"string", "boolean", "double", *_INTEGERS}

Order = list[tuple[str, bool]]


def _order(order_by) -> Order:
    """(column, descending) for each of ``order_by``: a name, or a list of names and (name, "asc" | "desc")."""
    given = [order_by] if isinstance(order_by, str) else list(order_by)
    pairs = [(c, "asc") if isinstance(c, str) else c for c in given]
    if any(d not in ("asc", "desc") for _, d in pairs):
        raise ValueError("an order is a column's name or (name, 'asc' | 'desc')")
    return [(c, d == "desc") for c, d in pairs]


def _sorting(order: Order) -> list[Column]:
    return [F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_first() for c, down in order]


def range_splitters(df: DataFrame, order_by, ranges: int) -> list:
    """At most ``ranges`` - 1 keys (rows of the order's columns) that cut ``df`` into about equal ranges.

    One integer column has a quantile sketch, one pass over it.  For other keys
    a sample of about ``SAMPLE_PER_RANGE`` of them for each range, drawn by a
    hash of the key, is sorted by Spark.  The driver sees the sketch's or the sample's keys only.
    """
    order = _order(order_by)
    (name, down), *more = order
    if not more and dict(df.dtypes)[name] in _INTEGERS:
        shares = [k / ranges for k in range(1, ranges)]
        cuts = df.agg(F.percentile_approx(name, shares, SAMPLE_PER_RANGE * ranges)).first()[0] if shares else None
        return [(c,) for c in sorted(set(cuts or ()), reverse=down)]
    keys = df.select(*[c for c, _ in order])
    total = keys.count()
    unit = F.shiftrightunsigned(F.xxhash64(*keys.columns), 11) / float(1 << 53)
    wanted = ranges * SAMPLE_PER_RANGE
    sample = keys if total <= wanted else keys.where(unit < wanted / total)
    # equal keys share a hash, so a repeated key could exceed the bound: it is one candidate
    candidates = sample.groupBy(*keys.columns).agg(F.count(F.lit(1)).alias("_w"))
    drawn = candidates.coalesce(1).sortWithinPartitions(*_sorting(order)).collect()
    weight, out, before = sum(r["_w"] for r in drawn), [], 0
    for r in drawn:
        if before and before * ranges >= weight * (len(out) + 1):
            out.append(tuple(r)[:-1])
        before += r["_w"]
    return out


def _at_or_after(order: Order, splitter: Column) -> Column:
    """Whether a row's key is not before ``splitter`` (a struct of the key), nulls first in ascending columns."""
    result = F.lit(True)
    for c, down in reversed(order):
        mine, its = F.col(c), splitter[c]
        later = F.coalesce(mine < its, mine.isNull() & its.isNotNull()) if down else F.coalesce(mine > its, mine.isNotNull() & its.isNull())
        result = later | (mine.eqNullSafe(its) & result)
    return result


def with_range(df: DataFrame, order_by, splitters: list, name: str) -> DataFrame:
    """``df`` with the number of the range each row falls in: a binary search over constant splitters."""
    if not splitters:
        return df.withColumn(name, F.lit(0))
    order = _order(order_by)
    schema = df.select(*[c for c, _ in order]).schema
    struct = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in schema.fields)
    kind = f"array<struct<{struct}>>"
    if all(f.dataType.simpleString() in _JSON_KINDS for f in schema.fields):
        text = json.dumps([{f.name: v for f, v in zip(schema.fields, key, strict=True)} for key in splitters])
        constant = F.from_json(F.lit(text), kind)  # folded to a constant of the plan
    else:
        constant = df.sparkSession.createDataFrame([(splitters,)], f"s {kind}").select("s").scalar()
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(splitters).bit_length()))])

    def halve(at: Column, step: Column) -> Column:
        reached = at + step
        after = (reached <= len(splitters)) & _at_or_after(order, F.get(F.col("_splitters"), reached - 1))
        return F.when(after, reached).otherwise(at)

    # one expression: a chain of projections would make the optimizer slow
    return df.withColumn("_splitters", constant).withColumn(name, F.aggregate(steps, F.lit(0), halve)).drop("_splitters")


def global_row_number(df: DataFrame, order_by, name: str = "rn", num_partitions: int | None = None) -> DataFrame:
    """1-based position of each row under ``order_by`` (names or (name, "asc" | "desc"); must be a total order).

    Equivalent to ``row_number() over (order by ...)`` but never funnels the
    data through one task, and writes nothing: reads of the order's columns
    (for the splitters and the counts) and one shuffle of the rows.  Drawing the
    splitters runs a small job or two when called; the numbering itself is lazy.
    ``df`` is evaluated for each of these reads, so an input that is costly to
    compute should be stored first.
    Rows with equal keys fall into one range, as only a total order has a
    defined numbering.
    """
    order = _order(order_by)
    splitters = range_splitters(df, order_by, num_partitions or shuffle_partitions(df.sparkSession))
    ranged = with_range(df, order_by, splitters, "_range")
    counts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    # one number per range, added up to the rows before each: a constant of the plan, looked up and not joined (from a join
    # of the rows with counts of the same rows Spark can infer a filter that names the other side's columns)
    known = F.map_from_entries(F.collect_list(F.struct("_range", "_n")))
    before = F.aggregate(
        F.sequence(F.lit(0), F.lit(len(splitters))),
        F.array(F.lit(0).cast("bigint")),
        lambda sums, r: F.concat(sums, F.array(F.element_at(sums, -1) + F.coalesce(F.col("_known")[r], F.lit(0).cast("bigint")))),
    )
    offsets = counts.agg(known.alias("_known")).select(before).scalar()
    inside = Window.partitionBy("_range").orderBy(*_sorting(order))
    numbered = ranged.withColumn("_local", F.row_number().over(inside))
    return numbered.withColumn(name, F.get(offsets, F.col("_range")) + F.col("_local")).drop("_range", "_local")


def cycled_zip(
    left: DataFrame,
    left_pos: str,
    right: DataFrame,
    right_pos: str,
    repeats: int | None,
) -> DataFrame:
    """Zip ``left`` with ``right`` repeated ``repeats`` times (None: without end), by position.

    Both positions are 1-based.  Left row ``p`` pairs with right row
    ``((p - 1) mod c) + 1`` where ``c`` is the number of right rows, and the
    zip stops at the shorter list: only ``p <= repeats * c`` survive, which the
    caller has to ask for.  ``c`` is a scalar subquery, evaluated once; the
    pairing is an equi-join that spreads the left rows evenly over the right.
    """
    c = right.select(F.count(F.lit(1))).scalar()
    lp = F.col(left_pos)
    kept = left if repeats is None else left.where(lp <= F.lit(repeats) * c)
    keyed = kept.withColumn("_slot", F.when(c > 0, F.pmod(lp - 1, F.nullif(c, F.lit(0))) + 1))
    return keyed.join(right, keyed["_slot"] == right[right_pos]).drop("_slot")
