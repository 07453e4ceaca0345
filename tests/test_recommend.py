"""Recommender: splits, RMSE, candidate choice, ALS structure, ranked store."""

import math

import pytest
from pyspark.sql import functions as F

from tessera.operators.metrics import best_candidate, rmse
from tessera.plans import recommend as R
from tessera.sources import fixtures, ranked_store

from paths import SF001


@pytest.fixture(scope="module")
def ratings(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    od = spark.read.parquet(f"{SF001}/orders.parquet")
    return fixtures.ratings_from_tables(li, od).cache()


@pytest.fixture(scope="module")
def movies(spark):
    return fixtures.movies_from_part(spark.read.parquet(f"{SF001}/part.parquet"))


def test_rmse_of_identity_is_zero(spark):
    df = spark.createDataFrame([(1.0, 1.0), (3.0, 3.0)], "rating double, prediction double")
    assert rmse(df).first().rmse == 0.0


def test_rmse_empty_is_null(spark):
    df = spark.createDataFrame([], "rating double, prediction double")
    assert rmse(df).first().rmse is None


def test_best_candidate_first_wins_tie_and_skips_nan(spark):
    res = spark.createDataFrame(
        [(4, 1.5), (6, 1.2), (8, 1.2), (10, float("nan")), (12, None)], "rank int, rmse double"
    )
    assert best_candidate(res).first()["rank"] == 6
    only_bad = spark.createDataFrame([(4, float("nan")), (6, None)], "rank int, rmse double")
    assert best_candidate(only_bad).first() is None


def test_deterministic_split_partitions(ratings):
    train, test = R.deterministic_split(ratings)
    assert train.count() + test.count() == ratings.count()
    assert train.join(test, ["user_id", "item"]).count() == 0


def test_duplicate_pairs_multiply_in_join(spark):
    actual = spark.createDataFrame([(1, 1, 3.0), (1, 1, 3.0)], "user_id int, item int, rating double")
    pred = spark.createDataFrame([(1, 1, 2.0)], "user_id int, item int, prediction double")
    from tessera.operators.metrics import join_actual_predicted

    assert join_actual_predicted(actual, pred).count() == 2


def test_mean_predictions_drop_unseen(spark):
    train = spark.createDataFrame([(1, 1, 2.0), (2, 1, 4.0)], "user_id int, item int, rating double")
    test = spark.createDataFrame([(3, 1, 5.0), (3, 2, 1.0)], "user_id int, item int, rating double")
    rows = R.mean_predictions(train, test, ["item"]).collect()
    assert [(r.item, r.prediction) for r in rows] == [(1, 3.0)]
    assert R.mean_predictions(train, test, []).count() == 2


def test_als_rank_selection_structure(ratings):
    best, results = R.select_best_rank(ratings, ranks=(4, 6), seed=1)
    rows = results.collect()
    assert [r["rank"] for r in rows] == [4, 6]
    assert all(r.rmse is not None and r.rmse >= 0 for r in rows)
    assert best in (4, 6)
    assert best == min(rows, key=lambda r: (r.rmse, r["rank"]))["rank"]


def test_new_user_top_n(spark, ratings, movies):
    new = fixtures.new_user_ratings(spark)
    top = R.recommend_for_new_user(ratings, new, movies, rank=4, n=10, seed=3).collect()
    assert 0 < len(top) <= 10
    assert all(r.user_id == fixtures.NEW_USER_ID for r in top)
    assert [r["rank"] for r in top] == sorted(r["rank"] for r in top)
    assert [r.rating for r in sorted(top, key=lambda r: r["rank"])] == sorted((r.rating for r in top), reverse=True)
    again = R.recommend_for_new_user(ratings, new, movies, rank=4, n=10, seed=3).collect()
    assert [r.movieId for r in sorted(top, key=lambda r: r["rank"])] == [
        r.movieId for r in sorted(again, key=lambda r: r["rank"])
    ]


def test_unknown_user_gets_nothing(spark, ratings, movies):
    model = R.fit_als(ratings, 4, seed=1)
    users = spark.createDataFrame([(1_999_999_999,)], "user_id int")
    assert R.top_n_for_users(model, users, movies).count() == 0


def test_exclude_seen(spark, ratings, movies):
    model = R.fit_als(ratings, 4, seed=1)
    users = ratings.select("user_id").distinct().limit(5)
    recs = R.top_n_for_users(model, users, movies, n=10, exclude_seen=ratings)
    seen = recs.join(ratings.select("user_id", F.col("item").alias("movieId")), ["user_id", "movieId"])
    assert seen.count() == 0
    per_user = recs.groupBy("user_id").count().collect()
    assert all(r["count"] <= 10 for r in per_user)


def _lists(spark):
    rows = [
        (1, 10, "a", 4.0), (1, 11, "b", 5.0), (1, 12, "c", 4.0),
        (2, 20, "d", 1.0),
    ]
    return spark.createDataFrame(rows, "user_id int, movieId int, title string, rating double")


def test_ranked_store_roundtrip(spark, tmp_path):
    path = str(tmp_path / "ranked")
    ranked_store.write_ranked(_lists(spark), path, scope="all", batch=1)
    back = ranked_store.read_ranked(spark, path, 1).collect()
    assert [r.movieId for r in back] == [11, 12, 10]  # score desc, then member text desc
    assert [r["rank"] for r in back] == [1, 2, 3]
    assert ranked_store.read_ranked(spark, path, 1, k=2).count() == 2
    assert ranked_store.read_ranked(spark, path, 999).count() == 0
    users = spark.createDataFrame([(1,), (2,)], "user_id int")
    assert ranked_store.read_ranked(spark, path, users).count() == 4


def test_ranked_store_user_scope_replaces_only_that_user(spark, tmp_path):
    path = str(tmp_path / "ranked")
    ranked_store.write_ranked(_lists(spark), path, scope="all", batch=1)
    newer = spark.createDataFrame([(1, 99, "z", 3.0)], "user_id int, movieId int, title string, rating double")
    ranked_store.write_ranked(newer, path, scope="user", batch=2)
    assert [r.movieId for r in ranked_store.read_ranked(spark, path, 1).collect()] == [99]
    assert [r.movieId for r in ranked_store.read_ranked(spark, path, 2).collect()] == [20]
    ranked_store.write_ranked(newer, path, scope="all", batch=3)  # flush: other users gone
    assert ranked_store.read_ranked(spark, path, 2).count() == 0


def test_top_rated_titles_order(spark, ratings, movies):
    top = R.top_rated_titles(ratings, fixtures.new_user_ratings(spark), movies).collect()
    assert len(top) == 10
    keys = [(-r.rating, r.movieId) for r in top]
    assert keys == sorted(keys)
    assert all(1.0 <= r.rating <= 5.0 and not math.isnan(r.rating) for r in top)


def test_empty_test_split_is_not_comparable(spark, ratings):
    empty = ratings.limit(0)
    res = R.evaluate_ranks(ratings, empty, ranks=(4,), seed=1).collect()
    assert res[0].rmse is None
    assert best_candidate(R.evaluate_ranks(ratings, empty, ranks=(4,), seed=1)).first() is None


def test_equal_scores_break_ties_by_film(spark):
    ratings = spark.createDataFrame([(1, 5, 3.0), (1, 3, 3.0), (1, 4, 3.0)], "user_id int, item int, rating double")
    movies = spark.createDataFrame([(3, "c", "g"), (4, "d", "g"), (5, "e", "g")], "movieId int, title string, genre string")
    new = spark.createDataFrame([], "user_id int, item int, rating double")
    assert [r.movieId for r in R.top_rated_titles(ratings, new, movies, n=2).collect()] == [3, 4]


def test_exclude_seen_still_returns_n(spark, ratings, movies):
    # a user who rated many films still gets a full list of unseen ones
    heavy = ratings.groupBy("user_id").count().orderBy(F.desc("count"), "user_id").first()
    model = R.fit_als(ratings, 4, seed=1)
    users = spark.createDataFrame([(heavy.user_id,)], "user_id int")
    n_items = ratings.select("item").distinct().join(movies.select(F.col("movieId").alias("item")), "item").count()
    recs = R.top_n_for_users(model, users, movies, n=10, exclude_seen=ratings).collect()
    assert len(recs) == min(10, n_items - heavy["count"])


def test_random_split_is_exact_partition(ratings):
    train, test = R.random_split(ratings, 0.75, seed=5)
    n, a, b = ratings.count(), train.count(), test.count()
    assert a + b == n and train.join(test, ["user_id", "item"]).count() == 0
    assert 0.7 < a / n < 0.8
    again, _ = R.random_split(ratings.repartition(3), 0.75, seed=5)
    assert again.exceptAll(train).count() == 0 and train.exceptAll(again).count() == 0


def test_compact_ranked_keeps_latest_lists(spark, tmp_path):
    path, out = str(tmp_path / "ranked"), str(tmp_path / "compacted")
    ranked_store.write_ranked(_lists(spark), path, scope="all", batch=1)
    newer = spark.createDataFrame([(1, 99, "z", 3.0)], "user_id int, movieId int, title string, rating double")
    ranked_store.write_ranked(newer, path, scope="user", batch=2)
    ranked_store.compact_ranked(spark, path, out, batch=3)
    assert spark.read.parquet(out).count() == 2  # user 1: one film; user 2: one film
    users = spark.createDataFrame([(1,), (2,)], "user_id int")
    before = sorted(tuple(r) for r in ranked_store.read_ranked(spark, path, users).collect())
    after = sorted(tuple(r) for r in ranked_store.read_ranked(spark, out, users).collect())
    assert before == after


def test_same_model_on_any_parallelism(spark, ratings):
    def factors(n):
        model = R.fit_als(ratings.repartition(n, "user_id").sortWithinPartitions("user_id", "item"), 4, seed=2)
        return {r.id: r.features for r in model.itemFactors.collect()}

    one, other = factors(1), factors(7)
    assert max(abs(a - b) for k in one for a, b in zip(one[k], other[k])) < 1e-3
    assert R.als(4).getNumUserBlocks() == R.USER_BLOCKS and R.als(4, item_blocks=3).getNumItemBlocks() == 3


def test_the_callers_cache_survives(spark, ratings):
    kept = ratings.where("user_id % 3 = 0").cache()
    R.select_best_rank(kept, ranks=(4,), seed=1)
    assert kept.is_cached
    kept.unpersist()
    other = ratings.where("user_id % 3 = 1")
    R.select_best_rank(other, ranks=(4,), seed=1)
    assert not other.is_cached


def test_store_keeps_its_bucket_count(spark, tmp_path):
    path = str(tmp_path / "ranked")
    lists = spark.createDataFrame([(u, f, "t", float(f)) for u in range(50) for f in range(3)], "user_id int, movieId int, title string, rating double")
    ranked_store.write_ranked(lists, path, scope="all", batch=1, num_buckets=8)
    ranked_store.write_ranked(lists.where("user_id < 5"), path, scope="user", batch=2, num_buckets=64)
    users = lists.select("user_id").distinct()
    assert ranked_store.read_ranked(spark, path, users).count() == 150
    assert ranked_store.read_ranked(spark, path, [3, 49]).count() == 6
    assert ranked_store.read_ranked(spark, path, []).count() == 0


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_flush_leaves_the_new_users_only(spark, tmp_path, mode):
    path = str(tmp_path / "ranked")
    lists = spark.createDataFrame([(u, 1, "t", 1.0) for u in range(50)], "user_id int, movieId int, title string, rating double")
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        ranked_store.write_ranked(lists, path, scope="all", batch=1)
        ranked_store.write_ranked(lists.where("user_id = 7"), path, scope="all", batch=2)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)
    assert [r.user_id for r in ranked_store.read_ranked(spark, path, lists.select("user_id")).collect()] == [7]


def test_rank_search_keeps_the_halves_of_the_split(ratings, monkeypatch):
    """every fit and both sides of its check drew each pair's random number again."""
    seen = []
    evaluate = R.evaluate_ranks

    def watched(train, test, *args, **named):
        seen.extend([train, test])
        assert train.is_cached and test.is_cached
        return evaluate(train, test, *args, **named)

    monkeypatch.setattr(R, "evaluate_ranks", watched)
    best, results = R.select_best_rank(ratings, ranks=(2, 3), seed=5)
    assert best in (2, 3) and results.count() == 2
    assert len(seen) == 2 and not any(df.is_cached for df in seen)


def test_fits_and_search_keep_nothing_on_the_heap(spark, ratings, monkeypatch):
    """kept blocks, factors and halves took the heap that the tasks building the blocks need."""
    seen = []
    evaluate, fit = R.evaluate_ranks, R.fit_als

    def stored():
        kept = spark.sparkContext._jsc.sc().getPersistentRDDs().values().toList()
        return {kept.apply(i).id(): kept.apply(i).getStorageLevel() for i in range(kept.size())}

    def watched(train, test, *args, **named):
        seen.extend([train.storageLevel, test.storageLevel])
        return evaluate(train, test, *args, **named)

    def fitted(*args, **named):
        model = fit(*args, **named)
        assert model.userFactors.count() and model.itemFactors.count()
        return model

    monkeypatch.setattr(R, "evaluate_ranks", watched)
    monkeypatch.setattr(R, "fit_als", fitted)
    before = stored()
    R.select_best_rank(ratings.where("user_id > 0"), ranks=(2, 3), seed=5)
    model = fitted(ratings, 2)
    new = [level for rdd, level in stored().items() if rdd not in before]
    assert model.rank == 2 and new and not any(level.useMemory() for level in new)
    assert [(level.useDisk, level.useMemory) for level in seen] == [(True, False)] * 2
    settings = R.als(4)
    assert settings.getIntermediateStorageLevel() == settings.getFinalStorageLevel() == "DISK_ONLY"
