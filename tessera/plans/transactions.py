"""Transaction analytics: balances, county statistics, lost-card use.

Inputs are reference-shaped DataFrames:

* transactions ``(customerid string, year, month, id time-UUID string, amount, card, status)``
* customers    ``(id int, name, county)``
* lost cards   ``(card, status, reported_at 'yyyy-MM-dd')``

Plans are column expressions, equi-joins and partial aggregates; the time
tests compare integer times derived from the UUID, so they do not depend on
the session time zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.timeuuid import (
    created_before,
    made_on_or_after_day,
    micros_before,
    ntz_literal,
    timeuuid_ticks,
)
from tessera.operators.keyed import dedupe_by_key
from tessera.operators.skew import skew_join
from tessera.sources import tables

# --- fixed values -------------------------------------------------------------
BALANCE_STATUSES = ("COMPLETED", "REPAID")  # counted in the balance
COUNTY_STATUS = "COMPLETED"  # counted in the county totals
# -------------------------------------------------------------------------------


def _customer_key(col_name: str, dirty_ids: str):
    """Customer ids are text in transactions and int in customers; compare as bigint.

    ``dirty_ids="raise"`` fails on a non-numeric id (ANSI cast);
    ``"drop"`` lets such rows fall out of the join.
    """
    c = F.col(col_name)
    if dirty_ids == "raise":
        return c.cast("bigint")
    if dirty_ids == "drop":
        return c.try_cast("bigint")
    raise ValueError("dirty_ids must be 'raise' or 'drop'")


def current_balance(tx: DataFrame, as_of, statuses=BALANCE_STATUSES) -> DataFrame:
    """Sum of amounts per (customerid, card) over settled transactions made before ``as_of``.

    ``updated_at`` is ``as_of`` on every row (P9).  The sum is bigint (the
    store's int wrapped silently).  Partial aggregation before the shuffle
    makes a hot card cost one row per task.
    """
    # a stored transactions table carries the UUID's time as event_us; rows
    # without it fall back to parsing the UUID text.  The first conjunct only
    # uses event_us, so it reaches the Parquet scan (LessThan OR IsNull) and
    # row groups outside the bound are skipped.
    if "event_us" in tx.columns:
        t = F.col("event_us")
        pushable = micros_before(t, as_of) | t.isNull()
        exact = F.when(t.isNull(), created_before("id", as_of)).otherwise(micros_before(t, as_of))
        before = pushable & exact
    else:
        before = created_before("id", as_of)
    kept = tx.where(before & F.col("status").isin(list(statuses)))
    return (
        kept.groupBy("customerid", "card")
        .agg(F.sum(F.col("amount").cast("bigint")).alias("balance"))
        .withColumn("updated_at", ntz_literal(as_of))
    )


def county_statistics(
    customers: DataFrame, tx: DataFrame, status: str = COUNTY_STATUS, dirty_ids: str = "raise"
) -> DataFrame:
    """R2: negated total of completed amounts per (county, year, month), as int.

    Equivalent to joining customers and transactions and then grouping, but
    the transactions are first summed per (customer, year, month): a customer
    with a third of all rows reaches the join as at most one row per month,
    and the raw rows are shuffled once, already partially aggregated.  The
    final cast to int raises on overflow (ANSI) instead of wrapping.
    """
    per_customer = (
        tx.where(F.col("status") == status)
        .select(
            _customer_key("customerid", dirty_ids).alias("_cid"),
            "year",
            "month",
            F.col("amount").cast("bigint").alias("amount"),
        )
        .groupBy("_cid", "year", "month")
        .agg(F.sum("amount").alias("amount"))
    )
    cust = customers.select(F.col("id").cast("bigint").alias("_cid"), "county")
    return (
        per_customer.join(cust, "_cid")
        .groupBy("county", "year", "month")
        .agg((-F.sum("amount")).cast("int").alias("total_amount"))
    )


def suspicious_transactions(tx: DataFrame, lost: DataFrame, compat: str = "correct", parts: int | None = None) -> DataFrame:
    """Transactions on a lost card made on or after the day it was reported.

    The join is on ``card`` (USING: one card column); both inputs carry a
    ``status`` that is not kept.  A card listed twice as lost doubles its
    rows.  The time test becomes part of the join condition.  With
    ``compat="raw_units"`` the reference's unit mix-up (Q1) is reproduced.
    With ``parts`` (about the number of join tasks) cards that hold a large
    share of the transactions are split between tasks: see :func:`skew_join`.
    """
    t = tx.select("customerid", "card", "id", "amount")
    lost_cards = lost.select("card", "reported_at")
    joined = t.join(lost_cards, "card") if parts is None else skew_join(t, lost_cards, "card", parts=parts, spread=["id"])
    return (
        joined
        .where(made_on_or_after_day("id", "reported_at", compat))
        .select("customerid", "card", "id", "amount", "reported_at")
    )


def latest_per_customer(suspicious: DataFrame) -> DataFrame:
    """S9 for the suspicious table, keyed by customer only (Q2).

    The latest transaction by UUID *time* wins; the UUID text breaks ties
    (text order of a time UUID is not time order).
    """
    order = [timeuuid_ticks("id").desc(), F.col("id").desc()]
    return dedupe_by_key(suspicious, "customerid", order)


def suspicious_with_customer(stored: DataFrame, customers: DataFrame, dirty_ids: str = "raise") -> DataFrame:
    """Stored suspicious rows with the customer's county and name."""
    s = stored.select(_customer_key("customerid", dirty_ids).alias("_cid"), "customerid", "card", "amount")
    c = customers.select(F.col("id").cast("bigint").alias("_cid"), "county", "name")
    return s.join(c, "_cid").select("customerid", "card", "amount", "county", "name")


def run_reports(tx: DataFrame, customers: DataFrame, lost: DataFrame, out_dir: str, as_of) -> dict[str, str]:
    """The whole programme: compute R1-R3, store each as a keyed table, then R4.

    Each result is computed once and written (the programme showed and
    stored each one, computing it twice).  R4 reads the *stored* suspicious
    table, so the key rule (one row per customer) applies to it.
    """
    out = out_dir.rstrip("/")
    paths = {
        "balance": tables.replace_table(current_balance(tx, as_of), tables.BALANCE, f"{out}/balance"),
        "county_statistics": tables.replace_table(
            county_statistics(customers, tx), tables.COUNTY_STATISTICS, f"{out}/county_statistics"
        ),
        "suspicious": tables.replace_table(
            suspicious_transactions(tx, lost),
            tables.SUSPICIOUS,
            f"{out}/suspicious",
            order_by=[timeuuid_ticks("id").desc(), F.col("id").desc()],
        ),
    }
    stored = tables.read_keyed(tx.sparkSession, tables.SUSPICIOUS, paths["suspicious"])
    paths["suspicious_with_customer"] = f"{out}/suspicious_with_customer"
    suspicious_with_customer(stored, customers).write.mode("overwrite").parquet(paths["suspicious_with_customer"])
    return paths


COUNTY_STATISTICS_SQL = """
WITH per_customer AS (
  SELECT CAST(customerid AS BIGINT) AS cid, year, month, SUM(CAST(amount AS BIGINT)) AS amount
  FROM {tx}
  WHERE status = '{status}'
  GROUP BY CAST(customerid AS BIGINT), year, month
)
SELECT c.county AS county, p.year AS year, p.month AS month, CAST(-SUM(p.amount) AS INT) AS total_amount
FROM per_customer p JOIN {customers} c ON CAST(c.id AS BIGINT) = p.cid
GROUP BY c.county, p.year, p.month
"""


def county_statistics_sql(customers: DataFrame, tx: DataFrame, status: str = COUNTY_STATUS,
                          views: tuple[str, str] = ("tessera_customers", "tessera_transactions")) -> DataFrame:
    """R2 through the SQL API (S7): the inputs become temp views and one SQL text runs.

    Same plan as :func:`county_statistics` - Catalyst compiles both to the
    same pre-aggregate, join and aggregate.
    """
    from tessera.sources.files import register_view

    cust_view, tx_view = views
    register_view(customers, cust_view)
    register_view(tx, tx_view)
    return tx.sparkSession.sql(COUNTY_STATISTICS_SQL.format(tx=tx_view, customers=cust_view, status=status))
