import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from tessera.llm import resampling as X

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, target):
    """The multiset of (doc_id, n_features, weight, score, rank), from the contract's words."""
    bucket = lambda w: zlib.crc32(w.encode()) % X.BUCKETS
    source, wanted = Counter(), Counter()
    for _, text in docs:
        source.update(map(bucket, words(text)))
    for (text,) in target:
        wanted.update(map(bucket, words(text)))
    s_all, t_all = sum(source.values()), sum(wanted.values())
    gain = {b: math.floor(1000 * math.log((wanted[b] + 1.0) * (s_all + 10000.0) / ((source[b] + 1.0) * (t_all + 10000.0)))) for b in source}
    rows = []
    for doc, text in docs:
        found = [bucket(w) for w in words(text)]
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        rows.append((doc, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fit = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    drawn = Counter((*r, k + 1) for k, r in enumerate(fit[:len(fit) * 10 // 100]))
    left = Counter((*r, None) for r in rows)
    for r in drawn:
        left[(*r[:4], None)] -= 1
    return drawn + left


def check(docs, target):
    found = Counter(tuple(r) for r in X.op13_importance_resampling(docs, target).collect())
    given = [tuple(r) for r in docs.select(docs["doc_id"], docs["text"]).collect()]
    assert found == brute(given, [tuple(r) for r in target.select("text").collect()])
    return found


def test_query_against_brute_force_and_sql(spark, documents, table):
    found = check(documents, table("benchmark"))
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from read_parquet('/root/testdata/sf0.001/{name}.parquet')")
    res = con.execute(X.ORACLE_SQL)
    assert [d[0] for d in res.description] == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(res.fetchall()) == found


def test_awkward_rows(spark, awkward, no_documents, table):
    check(awkward, table("benchmark"))
    check(awkward, spark.createDataFrame([], "text string"))
    assert X.op13_importance_resampling(no_documents, table("benchmark")).count() == 0


def test_ties_at_the_cutoff(spark):
    """A third of all rows are one repeated row, and the cutoff falls among them."""
    long = " ".join(f"w{k}" for k in range(30))
    rows = [(5, long, "a")] * 200 + [(k, f"{long} x{k}", "b") for k in range(400)] + [(None, long, None)] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string, extra string").repartition(4)
    check(docs, spark.createDataFrame([(long,)], "text string"))


def test_bracket_is_widened(spark, monkeypatch):
    """A sketch that is off must not matter: the counts outside the bracket show it."""
    monkeypatch.setattr(X, "SKETCH", 4)
    scores = spark.range(5000).select((X.F.col("id") * 7919 % 5003).alias("score"))
    for wanted in (1, 500, 4999):
        low, high, above = X.bracket(scores, wanted, 5000)
        values = sorted((r.score for r in scores.collect()), reverse=True)
        assert low <= values[wanted - 1] <= high and above == sum(v > high for v in values) < wanted
    same = spark.range(100).select(X.F.lit(7).cast("long").alias("score"))
    assert X.bracket(same, 10, 100) == (7, 7, 0)


def test_drawn_rows_are_whole(spark, awkward, documents, table):
    drawn = X.resampled(documents, table("benchmark"))
    assert drawn.columns == documents.columns
    kept = {r.doc_id for r in X.op13_importance_resampling(documents, table("benchmark")).where("rank is not null").collect()}
    assert {r.doc_id for r in drawn.collect()} == kept
    assert X.resampled(awkward, table("benchmark"), percent=100).columns == awkward.columns


@pytest.mark.parametrize("grams", [1, 3])
def test_word_runs(grams):
    n, found = X.features("A b, C! d".encode(), grams, lambda f: f)
    assert n == 4 and found == [b"a", b"b", b"c", b"d", *([b"a b", b"b c", b"c d", b"a b c", b"b c d"] if grams == 3 else [])]
    assert X.features(None, grams, lambda f: f) == (0, [])


def test_gains_follow_the_target():
    gain = X.gains(np.array([100, 100, 0]), np.array([0, 70, 30]))
    assert gain[0] < 0 < gain[1] < gain[2]
