"""Ranked lists as sets (S11, S12): unique films, last score, merged batches."""

import random

import pytest

from tessera.sources import ranked_store


def films(spark, rows):
    return spark.createDataFrame(rows, "user_id int, movieId int, title string, rating double")


def lists(spark, path, users, k=10):
    out = {}
    for r in ranked_store.read_ranked(spark, path, users, k).orderBy("user_id", "rank").collect():
        out.setdefault(r.user_id, []).append((r.movieId, r.rating))
    return out


def test_repeated_film_takes_one_place(spark, scratch):
    path = f"{scratch}/r"
    rows = [(1, m, f"t{m}", float(m)) for m in range(12)] + [(1, 11, "t11", 3.0), (1, 11, "t11", 11.0), (1, 10, "other", 2.0)]
    ranked_store.write_ranked(films(spark, rows), path, batch=1)
    assert lists(spark, path, 1) == {1: [(m, float(m)) for m in range(11, 1, -1)]}


def test_rescored_film_keeps_its_last_score(spark, scratch):
    path = f"{scratch}/r"
    ranked_store.write_ranked(films(spark, [(1, m, "t", 5.0 + m) for m in range(3)] + [(2, 0, "t", 1.0)]), path, batch=1)
    ranked_store.write_ranked(films(spark, [(1, 2, "t", 0.5), (1, 9, "t", 6.0)]), path, scope="merge", batch=2)
    assert lists(spark, path, [1, 2]) == {1: [(9, 6.0), (1, 6.0), (0, 5.0), (2, 0.5)], 2: [(0, 1.0)]}
    ranked_store.write_ranked(films(spark, [(1, 7, "t", 1.0)]), path, scope="user", batch=3)
    ranked_store.write_ranked(films(spark, [(3, 7, "t", 1.0)]), path, scope="merge", batch=3)
    assert lists(spark, path, [1, 2, 3]) == {1: [(7, 1.0)], 2: [(0, 1.0)], 3: [(7, 1.0)]}


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_against_plain_sets(spark, scratch, seed):
    rng, path, expected = random.Random(seed), f"{scratch}/r", {}
    for batch in range(1, 6):
        scope = rng.choice(["merge", "merge", "user"])
        rows = [(rng.randrange(4), rng.randrange(15), "t", float(rng.randrange(50))) for _ in range(25)]
        ranked_store.write_ranked(films(spark, rows), path, scope=scope, batch=batch, num_buckets=rng.choice([2, 8]))
        if scope == "user":
            for user in {r[0] for r in rows}:
                expected[user] = {}
        best = {}
        for user, film, _, score in rows:
            best[user, film] = max(score, best.get((user, film), 0.0))
        for (user, film), score in best.items():
            expected.setdefault(user, {})[film] = score
    found = lists(spark, path, list(range(5)), k=100)
    assert {u: dict(x) for u, x in found.items()} == expected and all(len(dict(x)) == len(x) for x in found.values())
    out = f"{scratch}/compact"
    ranked_store.compact_ranked(spark, path, out, keep=3)
    assert lists(spark, out, list(range(5)), k=100) == {u: x[:3] for u, x in found.items()}


def test_keep_bounds_what_is_written(spark, scratch):
    path = f"{scratch}/r"
    ranked_store.write_ranked(films(spark, [(u, m, "t", float(m)) for u in range(5) for m in range(30)]), path, keep=10)
    assert spark.read.parquet(path).count() == 50


def test_a_read_brings_the_rows_together_once(spark, tmp_path):
    """the stored rows were shuffled for each of two joins and two windows."""
    path = str(tmp_path / "store")
    ranked_store.write_ranked(films(spark, [(u, m, f"t{m}", float(u * m % 7)) for u in range(9) for m in range(12)]), path, batch=1)
    ranked_store.write_ranked(films(spark, [(u, m, "new", 9.0) for u in (1, 2) for m in (3, 40)]), path, scope="merge", batch=2)
    ranked_store.write_ranked(films(spark, [(2, 5, "only", 1.0)]), path, batch=3)
    users, kept = spark.range(1, 4).selectExpr("cast(id as int) user_id"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    found = {}
    for threshold in ("-1", "10m"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            back = ranked_store.read_ranked(spark, path, users, k=4)
            if threshold == "-1":  # the rows, their users' batches and the wanted users
                assert back._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 3
            found[threshold] = sorted(tuple(r) for r in back.collect())
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert found["-1"] == found["10m"]
    lists = {u: [(m, t, s) for v, _, m, t, s in found["-1"] if v == u] for u in (1, 2, 3)}
    assert lists[1][:2] == [(40, "new", 9.0), (3, "new", 9.0)] and lists[2] == [(5, "only", 1.0)] and len(lists[3]) == 4
