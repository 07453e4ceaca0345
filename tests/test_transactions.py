"""Known-answer and edge-case tests for the transaction reports."""

import pytest
from pyspark.sql import functions as F

from tessera.functions.timeuuid import as_ticks, make_timeuuid
from tessera.plans import transactions as T
from tessera.sources import files, generate, tables

# --- fixed values: the three rows of the programme's lost-card file ------------
LOST_ROWS = [
    ("1565 2509 3791 4667", "LOST", "2017-10-12"),
    ("1033 2444 3221 4861", "LOST", "2017-10-12"),
    ("1416 2498 3103 4822", "LOST", "2017-10-12"),
]
# -------------------------------------------------------------------------------


@pytest.fixture()
def lost_csv(tmp_path):
    p = tmp_path / "lost_cards.csv"
    p.write_text("card,status,reported_at\n" + "\n".join(",".join(r) for r in LOST_ROWS) + "\n")
    return str(p)


def _tx(spark, rows):
    """rows: (customerid, year, month, ticks, amount, card, status)"""
    df = spark.createDataFrame(rows, "customerid string, year int, month int, t long, amount int, card string, status string")
    return df.select("customerid", "year", "month", make_timeuuid("t").alias("id"), "amount", "card", "status")


def test_planted_known_answer(spark, lost_csv):
    customers = generate.gen_customers(spark, n=100, seed=7)
    tx = generate.gen_transactions(spark, customers, n=1000, seed=7, as_of="2017-11-01", repeats=10)
    lost = files.read_lost_cards(spark, lost_csv)
    planted = generate.plant_suspicious(customers, lost, as_of="2017-11-15")
    assert planted.count() == 4
    all_tx = tx.unionByName(planted)

    susp = T.suspicious_transactions(all_tx, lost)
    planted_ids = {r.id for r in planted.collect()}
    hit_ids = {r.id for r in susp.collect()}
    assert planted_ids <= hit_ids  # every planted row is found
    assert susp.where(F.col("id").isin(list(planted_ids))).count() == 4

    stored = T.latest_per_customer(susp.where(F.col("id").isin(list(planted_ids))))
    assert stored.count() == 3  # keyed by customer: the third customer's second hit wins
    report = T.suspicious_with_customer(stored, customers)
    assert report.count() == 3
    first3 = [r.id for r in customers.orderBy("id").limit(3).collect()]
    assert sorted(int(r.customerid) for r in report.collect()) == sorted(first3)


def test_correct_time_test_drops_row_before_report(spark, lost_csv):
    lost = files.read_lost_cards(spark, lost_csv)
    before = as_ticks("2017-10-11 23:59:59")
    after = as_ticks("2017-10-12 00:00:00")
    tx = _tx(spark, [("1", 2017, 10, before, 5, LOST_ROWS[0][0], "COMPLETED"),
                     ("2", 2017, 10, after, 6, LOST_ROWS[1][0], "COMPLETED")])
    assert {r.customerid for r in T.suspicious_transactions(tx, lost).collect()} == {"2"}
    assert T.suspicious_transactions(tx, lost, compat="raw_units").count() == 2


def test_duplicate_lost_card_doubles_rows(spark):
    lost = spark.createDataFrame([("c1", "LOST", "2000-01-01"), ("c1", "LOST", "2000-01-01")], files.LOST_CARDS_SCHEMA)
    tx = _tx(spark, [("1", 2017, 1, as_ticks("2017-01-01"), 1, "c1", "COMPLETED")])
    assert T.suspicious_transactions(tx, lost).count() == 2


def test_latest_per_customer_uses_time_not_text(spark):
    # time_low = ffffffff, then wraps to 00000001: the later UUID's text sorts lower
    early = ((as_ticks("2017-01-01") >> 32) << 32) | 0xFFFFFFFF
    late = early + 2
    tx = _tx(spark, [("9", 2017, 1, early, 1, "a", "COMPLETED"), ("9", 2017, 1, late, 2, "b", "COMPLETED")])
    rows = tx.select("id", "amount").collect()
    assert max(rows, key=lambda r: r.id).amount == 1  # by text the earlier one would win
    susp = tx.select("customerid", "card", "id", "amount", F.lit("2000-01-01").alias("reported_at"))
    kept = T.latest_per_customer(susp).collect()
    assert [r.amount for r in kept] == [2]


def test_balance_statuses_and_bound(spark):
    t0 = as_ticks("2016-06-01")
    tx = _tx(spark, [
        ("1", 2016, 6, t0, 100, "c", "COMPLETED"),
        ("1", 2016, 6, t0 + 1, 50, "c", "REPAID"),
        ("1", 2016, 6, t0 + 2, 1000, "c", "PENDING"),
        ("1", 2016, 6, t0 + 3, 1000, "c", "FAILED"),
        ("1", 2016, 6, as_ticks("2019-01-01"), 7, "c", "COMPLETED"),  # after as_of
        ("2", 2016, 6, t0, -30, "d", "COMPLETED"),
    ])
    out = {(r.customerid, r.card): r for r in T.current_balance(tx, "2018-01-01").collect()}
    assert out[("1", "c")].balance == 150
    assert out[("2", "d")].balance == -30
    assert str(out[("1", "c")].updated_at) == "2018-01-01 00:00:00"


def test_balance_sums_beyond_int(spark):
    t0 = as_ticks("2016-06-01")
    rows = [("1", 2016, 6, t0 + k, 2_000_000_000, "c", "COMPLETED") for k in range(3)]
    assert T.current_balance(_tx(spark, rows), "2018-01-01").first().balance == 6_000_000_000


def test_county_statistics_negated_completed_only(spark):
    t0 = as_ticks("2016-06-01")
    tx = _tx(spark, [
        ("1", 2016, 6, t0, 100, "c", "COMPLETED"),
        ("1", 2016, 6, t0 + 1, 50, "c", "REPAID"),
        ("2", 2016, 6, t0 + 2, 10, "d", "COMPLETED"),
        ("3", 2016, 7, t0 + 3, 5, "e", "COMPLETED"),
    ])
    cust = spark.createDataFrame([(1, "A", "London"), (2, "B", "London"), (3, "C", "Dorset")], "id int, name string, county string")
    got = {(r.county, r.year, r.month): r.total_amount for r in T.county_statistics(cust, tx).collect()}
    assert got == {("London", 2016, 6): -110, ("Dorset", 2016, 7): -5}


def test_dirty_customer_ids(spark):
    tx = _tx(spark, [("x1", 2016, 6, as_ticks("2016-06-01"), 1, "c", "COMPLETED"),
                     ("1", 2016, 6, as_ticks("2016-06-01") + 1, 2, "c", "COMPLETED")])
    cust = spark.createDataFrame([(1, "A", "London")], "id int, name string, county string")
    with pytest.raises(Exception):
        T.county_statistics(cust, tx).collect()
    assert T.county_statistics(cust, tx, dirty_ids="drop").first().total_amount == -2


def test_run_reports_writes_keyed_tables(spark, lost_csv, tmp_path):
    customers = generate.gen_customers(spark, n=50, seed=3)
    lost = files.read_lost_cards(spark, lost_csv)
    tx = generate.gen_transactions(spark, customers, n=300, seed=3, repeats=10).unionByName(
        generate.plant_suspicious(customers, lost))
    paths = T.run_reports(tx, customers, lost, str(tmp_path / "out"), as_of="2018-01-01")
    susp = tables.read_keyed(spark, tables.SUSPICIOUS, paths["suspicious"])
    assert susp.count() == susp.select("customerid").distinct().count() == 3
    assert spark.read.parquet(paths["suspicious_with_customer"]).count() == 3
    bal = tables.read_keyed(spark, tables.BALANCE, paths["balance"])
    assert bal.columns == tables.BALANCE.column_names
    tables.truncate_table(spark, tables.BALANCE, paths["balance"])
    assert tables.read_keyed(spark, tables.BALANCE, paths["balance"]).count() == 0


def test_replace_table_keeps_first_per_key(spark, tmp_path):
    df = spark.createDataFrame(
        [("1", "c", 5, "2020-01-01 00:00:00"), ("1", "c", 9, "2020-01-02 00:00:00")],
        "customerid string, card string, balance long, updated_at string",
    ).withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz"))
    path = tables.replace_table(df, tables.BALANCE, str(tmp_path / "b"), order_by=[F.col("updated_at").desc()])
    assert [r.balance for r in tables.read_keyed(spark, tables.BALANCE, path).collect()] == [9]


def test_bad_reported_at_raises(spark):
    lost = spark.createDataFrame([("c1", "LOST", "2017-13-45")], files.LOST_CARDS_SCHEMA)
    tx = _tx(spark, [("1", 2017, 1, as_ticks("2017-01-01"), 1, "c1", "COMPLETED")])
    with pytest.raises(Exception):
        T.suspicious_transactions(tx, lost).collect()


def _hot_tx(spark, n=3000):
    """A third of all transactions belong to customer 0 on one card."""
    base = as_ticks("2016-01-01")
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("0")).otherwise((F.col("id") % 50).cast("string")).alias("customerid"),
        F.lit(2016).alias("year"),
        (F.col("id") % 12 + 1).cast("int").alias("month"),
        make_timeuuid(F.lit(base) + F.col("id")).alias("id"),
        (F.col("id") % 100).cast("int").alias("amount"),
        F.when(F.col("id") % 3 == 0, F.lit("hot card")).otherwise(F.concat(F.lit("c"), (F.col("id") % 50).cast("string"))).alias("card"),
        F.lit("COMPLETED").alias("status"),
    )


def test_hot_customer_results_exact(spark):
    tx = _hot_tx(spark)
    cust = spark.range(50).select(F.col("id").cast("int").alias("id"), F.lit("n").alias("name"),
                                  F.when(F.col("id") == 0, "Hot").otherwise("Cold").alias("county"))
    rows = [r.asDict() for r in tx.collect()]
    want = {}
    for r in rows:
        county = "Hot" if r["customerid"] == "0" else "Cold"
        key = (county, r["year"], r["month"])
        want[key] = want.get(key, 0) - r["amount"]
    got = {(r.county, r.year, r.month): r.total_amount for r in T.county_statistics(cust, tx).collect()}
    assert got == want
    bal = {(r.customerid, r.card): r.balance for r in T.current_balance(tx, "2030-01-01").collect()}
    assert bal[("0", "hot card")] == sum(r["amount"] for r in rows if r["card"] == "hot card")


def test_county_statistics_aggregates_before_the_join(spark):
    tx = _hot_tx(spark)
    cust = spark.range(50).select(F.col("id").cast("int").alias("id"), F.lit("n").alias("name"), F.lit("X").alias("county"))
    plan = T.county_statistics(cust, tx)._jdf.queryExecution().executedPlan().toString()
    # the transactions side of the join is the per-customer aggregate, not raw rows
    join_at = min(i for i in (plan.find("BroadcastHashJoin"), plan.find("SortMergeJoin")) if i >= 0)
    below = plan[join_at:]
    assert "partial_sum" in below and "HashAggregate(keys=[_cid" in below


def test_stored_transactions_prune_on_event_time(spark, tmp_path):
    from tessera.functions.timeuuid import as_micros

    customers = generate.gen_customers(spark, n=60, seed=8)
    tx = generate.gen_transactions(spark, customers, n=500, seed=8, as_of="2017-11-01", repeats=10)
    # event_us is derived from the id while writing
    path = tables.replace_table(tx, tables.TRANSACTIONS, str(tmp_path / "tx"))
    stored = tables.read_keyed(spark, tables.TRANSACTIONS, path)
    from tessera.functions.timeuuid import timeuuid_micros

    assert stored.where(F.col("event_us") != timeuuid_micros("id")).count() == 0
    bound = "2017-11-01 00:00:00.000250"  # between generated ids (1 tick apart)
    got = {(r.customerid, r.card): r.balance for r in T.current_balance(stored, bound).collect()}
    want = {(r.customerid, r.card): r.balance for r in T.current_balance(tx, bound).collect()}
    assert got == want
    plan = T.current_balance(stored, bound)._jdf.queryExecution().executedPlan().toString()
    assert f"LessThan(event_us,{(as_micros(bound) // 1000) * 1000})" in plan
    # rows stored without the derived time still count, via the UUID text
    no_time = stored.withColumn("event_us", F.lit(None).cast("bigint"))
    got = {(r.customerid, r.card): r.balance for r in T.current_balance(no_time, bound).collect()}
    assert got == want


def test_county_statistics_sql_equals_dataframe_form(spark):
    tx = _hot_tx(spark)
    cust = spark.range(50).select(F.col("id").cast("int").alias("id"), F.lit("n").alias("name"),
                                  (F.col("id") % 4).cast("string").alias("county"))
    a = sorted(tuple(r) for r in T.county_statistics(cust, tx).collect())
    b = sorted(tuple(r) for r in T.county_statistics_sql(cust, tx).collect())
    assert a == b and a


def test_replace_table_bounds_files_per_directory(spark, tmp_path):
    import glob

    customers = generate.gen_customers(spark, n=60, seed=8)
    tx = generate.gen_transactions(spark, customers, n=600, seed=8, repeats=10).repartition(16)
    path = tables.replace_table(tx, tables.TRANSACTIONS, str(tmp_path / "tx"), files_per_directory=2)
    dirs = glob.glob(f"{path}/year=*/month=*")
    assert dirs and all(len(glob.glob(f"{d}/*.parquet")) <= 2 for d in dirs)
    back = tables.read_keyed(spark, tables.TRANSACTIONS, path).drop("event_us")
    assert back.exceptAll(tx).count() == 0 and tx.exceptAll(back).count() == 0


@pytest.mark.parametrize("spec", [tables.CUSTOMERS, tables.TRANSACTIONS, tables.BALANCE, tables.COUNTY_STATISTICS, tables.SUSPICIOUS], ids=lambda s: s.name)
def test_every_table_survives_truncation_and_repeated_keys(spark, tmp_path, spec):
    path = str(tmp_path / spec.name)
    one = spark.range(1).select(*[F.lit("2016-01-01").cast("date").cast(t).alias(c) if "timestamp" in t else F.lit("1").cast(t).alias(c) for c, t in spec.columns])
    tables.replace_table(one.unionByName(one), spec, path)
    assert tables.read_keyed(spark, spec, path).count() == 1
    tables.truncate_table(spark, spec, path)
    empty = tables.read_keyed(spark, spec, path)
    assert empty.count() == 0 and empty.columns == spec.column_names
    tables.replace_table(one.limit(0), spec, path)
    assert tables.read_keyed(spark, spec, path).count() == 0
    tables.replace_table(one, spec, path, unique=True)
    assert tables.read_keyed(spark, spec, path).count() == 1
