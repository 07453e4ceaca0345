"""Reference-shaped inputs derived from the benchmark tables.

The programs read a ratings file, a movies file, a documents file, a lost
card file and generated customers/transactions.  These functions derive the
same shapes from the TPC-H-style tables with column expressions only, so
every query's work grows with the tables it reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.timeuuid import GREGORIAN_OFFSET_TICKS, make_timeuuid, ntz_micros

# --- fixed values -------------------------------------------------------------
# The new user's ten (movieId, rating) pairs from the recommender programme.
NEW_USER_RATINGS = [(260, 4), (1, 3), (16, 3), (25, 4), (32, 4), (335, 1), (379, 1), (296, 3), (858, 5), (50, 4)]
# Customer keys start at 0 here, so the programme's default new user id (0)
# would collide with a real customer; use an id no table holds.
NEW_USER_ID = 2_000_000_000
# order status -> transaction status
STATUS_OF_ORDER = {"F": "COMPLETED", "O": "REPAID", "P": "PENDING"}
LOST_REPORTED_AT = "1998-01-01"
LOST_CARD_MODULUS = 97
# -------------------------------------------------------------------------------

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _card_no() -> F.Column:
    return F.col("o_custkey") * 3 + F.col("o_orderkey") % 3


def _card_text(card_no: F.Column) -> F.Column:
    """Four-group card number; the first two groups identify the card."""
    g1 = (F.lit(1000) + card_no % 1000).cast("string")
    g2 = (F.lit(2000) + F.floor(card_no / 1000) % 1000).cast("string")
    return F.concat(g1, F.lit(" "), g2, F.lit(" 3000 4000"))


def transactions_from_orders(orders: DataFrame) -> DataFrame:
    """Transactions (customerid, year, month, id, amount, card, status) from orders.

    The id is a version-1 UUID whose time is the order date plus
    ``o_orderkey`` ticks of 100 ns, so ids are unique and time-ordered.
    """
    ticks = ntz_micros("o_orderdate") * 10 + F.lit(GREGORIAN_OFFSET_TICKS) + F.col("o_orderkey")
    status = F.coalesce(
        *[F.when(F.col("o_orderstatus") == k, F.lit(v)) for k, v in STATUS_OF_ORDER.items() if v != "PENDING"],
        F.lit("PENDING"),
    )
    return orders.select(
        F.col("o_custkey").cast("string").alias("customerid"),
        F.year("o_orderdate").cast("int").alias("year"),
        F.month("o_orderdate").cast("int").alias("month"),
        make_timeuuid(ticks).alias("id"),
        F.floor("o_totalprice").cast("int").alias("amount"),
        _card_text(_card_no()).alias("card"),
        status.alias("status"),
    )


def lost_cards_from_orders(orders: DataFrame, reported_at: str = LOST_REPORTED_AT) -> DataFrame:
    """Lost cards (card, status, reported_at): every card number divisible by 97."""
    return (
        orders.where(_card_no() % LOST_CARD_MODULUS == 0)
        .select(
            _card_text(_card_no()).alias("card"),
            F.lit("LOST").alias("status"),
            F.lit(reported_at).alias("reported_at"),
        )
        .distinct()
    )


def customers_from_tables(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Customers (id int, name, county) with the nation name as county."""
    return customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"]).select(
        F.col("c_custkey").cast("int").alias("id"),
        F.col("c_name").alias("name"),
        F.col("n_name").alias("county"),
    )


def ratings_from_tables(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Star ratings (user_id int, item int, rating double), one per (customer, part).

    1 to 5 stars from the average quantity the customer bought of the part.
    """
    joined = lineitem.select("l_orderkey", "l_partkey", "l_quantity").join(
        orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    return joined.groupBy("o_custkey", "l_partkey").agg(
        (F.lit(1) + F.floor((F.avg("l_quantity") - 1) / 10)).cast("double").alias("rating")
    ).select(
        F.col("o_custkey").cast("int").alias("user_id"),
        F.col("l_partkey").cast("int").alias("item"),
        "rating",
    )


def movies_from_part(part: DataFrame) -> DataFrame:
    """Movies (movieId, title, genre) from parts."""
    return part.select(
        F.col("p_partkey").cast("int").alias("movieId"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("genre"),
    )


def docs_from_documents(documents: DataFrame) -> DataFrame:
    """Documents as the content recommender reads them: ``id`` and ``description``."""
    return documents.select(
        F.col("doc_id").alias("id"),
        F.col("text").alias("description"),
        "lang",
        "source",
        "n_chars",
    )


def new_user_ratings(spark: SparkSession, user_id: int = NEW_USER_ID) -> DataFrame:
    """The new user's ten ratings as a (tiny, literal) DataFrame."""
    rows = [(user_id, item, float(r)) for item, r in NEW_USER_RATINGS]
    return spark.createDataFrame(rows, "user_id int, item int, rating double")
