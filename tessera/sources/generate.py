"""Seeded data generation on Spark.

The programme drew customers and transactions on the driver from a random
generator and zipped them together.  Here each draw is a row of a Spark
DataFrame with a draw number ``i`` (``spark.range(n)`` or a key column of
any table), and every drawn field is a pure function of ``(seed, field, i)``:

    value in [0, n) = int(first 8 hex digits of md5("seed:field:i"), 16) mod n

so generation is parallel, repeatable and independent per column (a linear
congruence with a per-column salt would make the columns functions of each
other).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.timeuuid import as_ticks, make_timeuuid
from tessera.operators.keyed import dedupe_by_key
from tessera.operators.positional import cycled_zip, global_row_number

# --- fixed values -------------------------------------------------------------
FIRST_NAMES = ["Daniela", "John", "Martin", "Marco", "Tom", "Kevin", "Jack"]
LAST_NAMES = [
    "Archer", "Baker", "Brewer", "Butcher", "Carter", "Clark", "Cooper", "Cook", "Dyer",
    "Farmer", "Faulkner", "Fisher", "Fuller", "Gardener", "Glover", "Head", "Hunt", "Hunter",
    "Judge", "Mason", "Page", "Parker", "Potter", "Sawyer", "Slater", "Smith", "Taylor", "Thatcher",
    "Turner", "Weaver", "Woodman", "Wright",
]
COUNTIES = ["Cheshire", "Cleveland", "Dorset", "London", "Middlesex", "Norfolk"]
# one entry per equally likely draw: COMPLETED 5/8, the others 1/8 each
STATUS_DRAWS = ["PENDING", "COMPLETED", "COMPLETED", "COMPLETED", "COMPLETED", "COMPLETED", "FAILED", "REPAID"]
YEAR_RANGE = (2000, 2017)
MONTH_RANGE = (1, 12)
AMOUNT_RANGE = (-200, 3000)
CARD_GROUP_RANGES = [(1000, 2000), (2000, 3000), (3000, 4000), (4000, 5000)]  # bounds inclusive
CUSTOMER_REPEATS = 10  # the customer list is repeated ten times before the zip
PLANTED_AMOUNT = 123
PLANTED_YEAR, PLANTED_MONTH = 2017, 11
# -------------------------------------------------------------------------------


def seeded_value(seed: int, field: str, i: Column, n) -> Column:
    """A repeatable value in ``[0, n)`` for draw ``i`` of ``field``."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(field), i.cast("string")))
    n_col = n if isinstance(n, Column) else F.lit(n)
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % n_col


def seeded_between(seed: int, field: str, i: Column, lo: int, hi: int) -> Column:
    """Uniform integer in ``[lo, hi]`` (inclusive)."""
    return (F.lit(lo) + seeded_value(seed, field, i, hi - lo + 1)).cast("int")


def seeded_choice(seed: int, field: str, i: Column, values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (seeded_value(seed, field, i, len(values)) + 1).cast("int"))


def _draws(spark_or_draws, n: int | None) -> DataFrame:
    if isinstance(spark_or_draws, DataFrame):
        return spark_or_draws.select(F.col("i").cast("bigint").alias("i"))
    if n is None:
        raise ValueError("give n draws or a DataFrame with a column i")
    return spark_or_draws.range(n).select(F.col("id").alias("i"))


def draw_customers(spark_or_draws, n: int | None = None, seed: int = 42, id_max=None) -> DataFrame:
    """S15, before the distinct: one drawn (draw_no, id, name, county) per draw.

    Ids are uniform in ``[1, id_max]``; by default ``id_max`` is the number of
    draws (the programme drew 100 ids from 1..100), evaluated as a scalar
    subquery.
    """
    d = _draws(spark_or_draws, n)
    if id_max is None:
        # n draws from spark.range: the count is known; otherwise one scalar subquery
        id_max = n if not isinstance(spark_or_draws, DataFrame) else d.select(F.count(F.lit(1))).scalar()
    i = F.col("i")
    return d.select(
        i.alias("draw_no"),
        (F.lit(1) + seeded_value(seed, "id", i, id_max)).cast("int").alias("id"),
        F.concat(
            seeded_choice(seed, "first", i, FIRST_NAMES), F.lit(" "), seeded_choice(seed, "last", i, LAST_NAMES)
        ).alias("name"),
        seeded_choice(seed, "county", i, COUNTIES).alias("county"),
    )


def distinct_customers(drawn: DataFrame) -> DataFrame:
    """A5 + K4: sort by id, keep the first draw of each id (equality is on id only)."""
    return dedupe_by_key(drawn, "id", "draw_no").select("id", "name", "county")


def gen_customers(spark_or_draws, n: int | None = None, seed: int = 42, id_max=None) -> DataFrame:
    """Distinct generated customers (id, name, county)."""
    return distinct_customers(draw_customers(spark_or_draws, n, seed, id_max))


def draw_transactions(spark_or_draws, n: int | None = None, seed: int = 42, as_of="2017-11-01") -> DataFrame:
    """S16, before customers are attached: (i, year, month, id, amount, card, status).

    The id is a time UUID ``i`` ticks after ``as_of`` (the programme used the
    clock at generation time, unrelated to year and month).
    """
    d = _draws(spark_or_draws, n)
    i = F.col("i")
    groups = [seeded_between(seed, f"card{k + 1}", i, lo, hi).cast("string") for k, (lo, hi) in enumerate(CARD_GROUP_RANGES)]
    return d.select(
        i,
        seeded_between(seed, "year", i, *YEAR_RANGE).alias("year"),
        seeded_between(seed, "month", i, *MONTH_RANGE).alias("month"),
        make_timeuuid(F.lit(as_ticks(as_of)) + i).alias("id"),
        seeded_between(seed, "amount", i, *AMOUNT_RANGE).alias("amount"),
        F.concat_ws(" ", *groups).alias("card"),
        seeded_choice(seed, "status", i, STATUS_DRAWS).alias("status"),
    )


def attach_customers(drawn_tx: DataFrame, customers: DataFrame, repeats: int | None, dense: bool = False) -> DataFrame:
    """Transaction ``p`` (in draw order) gets customer ``(p-1) mod c`` (in id order).

    With ``repeats`` it stops at ``min(n, repeats * c)`` rows, as the
    programme's zip of the list repeated ``CUSTOMER_REPEATS`` times did; None
    keeps every draw.  ``dense=True`` is the caller's word that the draw
    numbers are exactly ``0..n-1`` and saves numbering them.
    """
    tx = drawn_tx.withColumn("_p", F.col("i") + 1) if dense else global_row_number(drawn_tx, "i", "_p")
    cust = global_row_number(customers.select(F.col("id").alias("_cid")), "_cid", "_cp")
    zipped = cycled_zip(tx, "_p", cust, "_cp", repeats)
    return zipped.select(
        F.col("_cid").cast("string").alias("customerid"),
        "year", "month", "id", "amount", "card", "status",
    )


def gen_transactions(
    spark_or_draws, customers: DataFrame, n: int | None = None, seed: int = 42, as_of="2017-11-01", *,
    repeats: int | None,
) -> DataFrame:
    """Generated transactions with customers attached by the cycled zip (``repeats``: see there)."""
    dense = not isinstance(spark_or_draws, DataFrame)  # spark.range counts from 0
    return attach_customers(draw_transactions(spark_or_draws, n, seed, as_of), customers, repeats, dense)


def plant_suspicious(customers: DataFrame, lost: DataFrame, as_of="2017-11-15") -> DataFrame:
    """Four known-answer transactions on lost cards.

    The three customers with the lowest ids get one transaction each on the
    first, second and third lost card (in card order); the third customer
    gets a second one on the same card.  Ids are time UUIDs 0..3 ticks after
    ``as_of``.  Only three rows of each side are ever touched (top-k).
    """
    first = customers.select("id").orderBy("id").limit(3)
    cards = lost.select("card").orderBy("card").limit(3)
    # numbering the three rows left after each top-3 (a window over 3 rows)
    c = first.withColumn("_k", F.row_number().over(Window.orderBy("id")))
    k = cards.withColumn("_k", F.row_number().over(Window.orderBy("card")))
    pairs = c.join(k, "_k")
    # sequence numbers 0, 1, 2 - and 3 for the third customer's second hit
    seqs = F.when(F.col("_k") == 3, F.array(F.lit(2), F.lit(3))).otherwise(F.array(F.col("_k") - 1))
    slots = pairs.withColumn("_seq", F.explode(seqs))
    return slots.select(
        F.col("id").cast("string").alias("customerid"),
        F.lit(PLANTED_YEAR).alias("year"),
        F.lit(PLANTED_MONTH).alias("month"),
        make_timeuuid(F.lit(as_ticks(as_of)) + F.col("_seq")).alias("id"),
        F.lit(PLANTED_AMOUNT).alias("amount"),
        "card",
        F.lit("COMPLETED").alias("status"),
    )
