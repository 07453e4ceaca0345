"""Positional operators, keyed selection, generators and readers."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators.keyed import dedupe_by_key, top_k_per_group
from tessera.operators.positional import cycled_zip, global_row_number
from tessera.sources import files, generate


def test_global_row_number_equals_single_window(spark):
    df = spark.range(0, 5000).select(
        (F.col("id") * 7919 % 5003).alias("a"), (F.col("id") % 3).alias("b")
    ).repartition(13)
    ours = global_row_number(df, ["a", "b"], "rn")
    ref = df.withColumn("rn2", F.row_number().over(Window.orderBy("a", "b")))
    joined = ours.join(ref, ["a", "b"])
    assert joined.count() == 5000
    assert joined.where(F.col("rn") != F.col("rn2")).count() == 0
    assert sorted(r.rn for r in ours.select("rn").collect()) == list(range(1, 5001))


@pytest.mark.parametrize("n,c", [(25, 3), (30, 3), (31, 3), (5, 10), (5, 0)])
def test_cycled_zip_counts(spark, n, c):
    left = spark.range(1, n + 1).select(F.col("id").alias("p"))
    right = spark.range(1, c + 1).select(F.col("id").alias("cp"), (F.col("id") * 100).alias("val"))
    out = cycled_zip(left, "p", right, "cp", repeats=10).collect()
    assert len(out) == min(n, 10 * c)
    assert all(r.val == ((r.p - 1) % c + 1) * 100 for r in out)  # empty when c == 0


def test_dedupe_keeps_first_under_order(spark):
    df = spark.createDataFrame([(1, 3, "x"), (1, 1, "y"), (2, 5, "z")], "k int, o int, v string")
    got = {r.k: r.v for r in dedupe_by_key(df, "k", "o").collect()}
    assert got == {1: "y", 2: "z"}


def test_top_k_per_group_skewed_key(spark):
    # one key holds most rows: the partial group limit keeps it cheap, the result exact
    df = spark.range(0, 20000).select(
        F.when(F.col("id") % 10 < 8, F.lit(0)).otherwise(F.col("id") % 50).alias("g"), F.col("id").alias("v")
    )
    out = top_k_per_group(df, "g", F.col("v").desc(), 3)
    rows = out.collect()
    hot = [r.v for r in sorted((r for r in rows if r.g == 0), key=lambda r: r["rank"])]
    assert hot == [19997, 19996, 19995]
    assert len(rows) == 3 * 11  # the hot group 0 plus ten groups with ids ending in 8 or 9
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_generated_customers_first_draw_wins(spark):
    drawn = generate.draw_customers(spark, n=200, seed=5)
    distinct = generate.distinct_customers(drawn)
    assert distinct.count() == drawn.select("id").distinct().count()
    first = drawn.withColumn("rn", F.row_number().over(Window.partitionBy("id").orderBy("draw_no"))).where("rn = 1")
    assert distinct.exceptAll(first.select("id", "name", "county")).count() == 0
    r = drawn.agg(F.min("id"), F.max("id")).first()
    assert 1 <= r[0] and r[1] <= 200


def test_generated_transactions_ranges(spark):
    cust = generate.gen_customers(spark, n=100, seed=9)
    tx = generate.gen_transactions(spark, cust, n=2000, seed=9, repeats=10)
    c = cust.count()
    assert tx.count() == min(2000, 10 * c)
    s = tx.agg(F.min("year"), F.max("year"), F.min("amount"), F.max("amount"), F.min("month"), F.max("month")).first()
    assert 2000 <= s[0] and s[1] <= 2017 and -200 <= s[2] and s[3] <= 3000 and 1 <= s[4] and s[5] <= 12
    groups = tx.select(F.split("card", " ").alias("g")).select(*[F.col("g")[i].cast("int").alias(f"g{i}") for i in range(4)])
    b = groups.agg(*[F.min(f"g{i}") for i in range(4)], *[F.max(f"g{i}") for i in range(4)]).first()
    assert b[0] >= 1000 and b[4] <= 2000 and b[3] >= 4000 and b[7] <= 5000
    share = tx.where("status = 'COMPLETED'").count() / tx.count()
    assert 0.55 < share < 0.70  # 5/8
    again = generate.gen_transactions(spark, cust, n=2000, seed=9, repeats=10)
    assert tx.exceptAll(again).count() == 0


def test_read_ratings_field_count(spark, tmp_path):
    good = tmp_path / "r.csv"
    good.write_text("1,10,4.5,999\n2,11,3,1000\n")
    rows = files.read_ratings(spark, str(good)).collect()
    assert [(r.user_id, r.item, r.rating) for r in rows] == [(1, 10, 4.5), (2, 11, 3.0)]
    bad = tmp_path / "bad.csv"
    bad.write_text("1,10,4.5\n")
    with pytest.raises(Exception, match="4 fields"):
        files.read_ratings(spark, str(bad)).collect()
    with_header = tmp_path / "h.csv"
    with_header.write_text("user,item,rating,ts\n1,10,4.5,999\n")
    assert files.read_ratings(spark, str(with_header), header="user,item,rating,ts").count() == 1


def test_read_movies_keeps_quoted_comma(spark, tmp_path):
    p = tmp_path / "m.csv"
    p.write_text('1,"American President, The (1995)",Comedy|Drama\n2,Heat (1995),Action\n')
    rows = files.read_movies(spark, str(p)).orderBy("movieId").collect()
    assert rows[0].title == "American President, The (1995)" and rows[0].genre == "Comedy|Drama"


def test_word_list_lines_kept_whole(spark, tmp_path):
    p = tmp_path / "w.txt"
    p.write_text("a\njeżeli\tjuż\nmm,\n")
    assert [r.word for r in files.read_word_list(spark, str(p)).collect()] == ["a", "jeżeli\tjuż", "mm,"]


@pytest.mark.parametrize("line", ["x,Bad,G", "2,Good", "2,Good,G,more", "2"])
def test_bad_movie_lines_raise_or_are_dropped(spark, tmp_path, line):
    p = tmp_path / "m.csv"
    p.write_text(f"1,Heat,Action\n{line}\n")
    with pytest.raises(Exception):
        files.read_movies(spark, str(p)).select("title").collect()
    assert [r.title for r in files.read_movies(spark, str(p), drop_malformed=True).collect()] == ["Heat"]


@pytest.mark.parametrize("line", ["c,LOST", "c,LOST,2017-10-12,more"])
def test_bad_lost_card_lines_raise(spark, tmp_path, line):
    p = tmp_path / "l.csv"
    p.write_text(f"card,status,reported_at\nc0,LOST,2017-10-12\n{line}\n")
    with pytest.raises(Exception):
        files.read_lost_cards(spark, str(p)).select("card").collect()


@pytest.mark.parametrize("line", ["1,1,3", "1,1,3,", "1,,3,0", "1,1,3,0,0", ""])
def test_bad_rating_lines_raise(spark, tmp_path, line):
    p = tmp_path / "r.txt"
    p.write_text(f"1,2,3.0,0\n{line}\n2,2,4.0,0\n")
    with pytest.raises(Exception, match="needs 4 fields"):
        files.read_ratings(spark, str(p)).collect()


def test_only_header_lines_are_skipped(spark, tmp_path):
    p = tmp_path / "r.txt"
    p.write_text("1,1,3,0\n1,1,3,0\n2,1,3,0\n")
    assert files.read_ratings(spark, str(p), header="user,item,rating,ts").count() == 3
    p.write_text("user,item,rating,ts\n1,1,3,0\nuser,item,rating,ts\n")
    assert files.read_ratings(spark, str(p), header="user,item,rating,ts").count() == 1


def test_global_row_number_wide_rows_sampled_bounds(spark):
    # enough rows that range bounds come from a sample, and extra columns the
    # count branch does not need: the numbering must still be exact
    df = spark.range(0, 200_000, numPartitions=16).select(
        (F.col("id") * 48271 % 200_003).alias("k"),
        F.col("id").cast("string").alias("payload"),
        (F.col("id") % 7).alias("x"),
    )
    ours = global_row_number(df, ["k"], "rn")
    assert ours.agg(F.min("rn"), F.max("rn"), F.countDistinct("rn")).first() == (1, 200_000, 200_000)
    ref = df.select("k", F.row_number().over(Window.orderBy("k")).alias("rn2"))
    assert ours.join(ref, "k").where(F.col("rn") != F.col("rn2")).count() == 0


def test_attach_customers_with_sparse_draw_numbers(spark):
    # draw numbers with gaps take the general numbering path; same pairing rule
    cust = generate.gen_customers(spark, n=30, seed=2)
    drawn = generate.draw_transactions(spark.range(0, 400, 7).select(F.col("id").alias("i")), seed=2)
    tx = generate.attach_customers(drawn, cust, repeats=10).collect()
    c = cust.count()
    assert len(tx) == min(drawn.count(), 10 * c)
    ids = sorted(r.id for r in cust.collect())
    by_draw = sorted(drawn.select("i", "id").collect())
    got = {r.id: int(r.customerid) for r in tx}
    for p, row in enumerate(by_draw[: 10 * c]):
        assert got[row.id] == ids[p % c]


def test_global_row_number_property(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    @settings(max_examples=6, deadline=None)
    @given(
        st.lists(st.integers(min_value=0, max_value=3), min_size=1, max_size=300),  # hot first key
        st.integers(min_value=1, max_value=9),
    )
    def check(firsts, parts):
        rows = [(f, i) for i, f in enumerate(firsts)]  # (hot key, unique tie-break)
        df = spark.createDataFrame(rows, "f int, u int").repartition(parts)
        got = {(r.f, r.u): r.rn for r in global_row_number(df, ["f", "u"], "rn", num_partitions=4).collect()}
        want = {key: k + 1 for k, key in enumerate(sorted(rows))}
        assert got == want

    check()


def test_read_documents_inferred_and_read_table(spark, tmp_path):
    p = tmp_path / "docs.csv"
    p.write_text('id,description,extra\n1,"first, with a comma",x\n2,"a ""quoted"" word",y\n')
    docs = files.read_documents(spark, str(p), escape='"')
    assert dict(docs.dtypes)["id"] == "int"
    rows = {r.id: r.description for r in docs.collect()}
    assert rows == {1: "first, with a comma", 2: 'a "quoted" word'}

    out = str(tmp_path / "t")
    docs.write.parquet(out)
    only = files.read_table(spark, out, ["id"])
    assert only.columns == ["id"]
    assert "ReadSchema: struct<id:int>" in only._jdf.queryExecution().executedPlan().toString()
    view = files.register_view(docs, "tessera_docs_view")
    assert spark.sql("select count(*) from tessera_docs_view").first()[0] == 2 and view is docs


def test_global_row_number_orders_nulls_and_strings(spark):
    rows = [(None if k % 7 == 0 else k % 5, f"s{k:04d}", float("nan") if k == 3 else k / 3) for k in range(600)]
    df = spark.createDataFrame(rows, "a int, b string, c double").repartition(5)
    order = [("a", "desc"), ("b", "asc")]
    ours = global_row_number(df, order, "rn", num_partitions=4)
    w = Window.orderBy(F.col("a").desc_nulls_last(), F.col("b").asc_nulls_first())
    theirs = df.withColumn("rn", F.row_number().over(w))
    assert sorted((r.b, r.rn) for r in ours.collect()) == sorted((r.b, r.rn) for r in theirs.collect())
    by_float = global_row_number(df, ["c"], "rn", num_partitions=4)
    assert by_float.orderBy("rn").first().b == "s0000" and by_float.where("rn = 600").first().b == "s0003"
    with pytest.raises(ValueError):
        global_row_number(df, [("a", "up")])


def test_ranges_are_even_and_pure(spark):
    from tessera.operators.positional import range_splitters, with_range

    df = spark.range(40_000).select((F.col("id") * 7919 % 40_009).alias("k"))
    splitters = range_splitters(df, "k", 16)
    assert 12 <= len(splitters) <= 15
    sizes = [r["count"] for r in with_range(df, "k", splitters, "r").groupBy("r").count().collect()]
    assert max(sizes) < 2.5 * 40_000 / 16
    a = {r.k: r.r for r in with_range(df.repartition(3), "k", splitters, "r").collect()}
    b = {r.k: r.r for r in with_range(df.repartition(7, "k"), "k", splitters, "r").collect()}
    assert a == b


def test_global_row_number_writes_nothing(spark):
    from pathlib import Path

    shared = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    before = len(list(shared.rglob("*")))
    df = spark.range(1000).withColumnRenamed("id", "k")
    assert global_row_number(df, "k").agg(F.max("rn")).first()[0] == 1000
    assert global_row_number(df.where("k < 0"), "k").count() == 0
    assert len(list(shared.rglob("*"))) == before


def test_numbering_of_derived_keys_joins_nothing(spark, tmp_path):
    """the ranges' counts were joined to the rows, and a filter inferred from it could name the other side's columns."""
    spark.range(3000).select(F.col("id").alias("k")).repartition(3).write.parquet(str(tmp_path / "k"))
    drawn = spark.read.parquet(str(tmp_path / "k")).select(F.col("k").alias("i"))
    customers = generate.gen_customers(drawn, seed=42).select(F.col("id").alias("_cid"))
    numbered = global_row_number(customers, "_cid", "_cp")
    assert "Join" not in numbered._jdf.queryExecution().optimizedPlan().toString()
    assert numbered.select(F.count(F.lit(1))).first()[0] == customers.count()
    ids = [r["_cid"] for r in numbered.orderBy("_cp").collect()]
    assert ids == sorted(r["_cid"] for r in customers.collect())
    assert [r["_cp"] for r in numbered.select("_cp").orderBy("_cp").collect()] == list(range(1, len(ids) + 1))
