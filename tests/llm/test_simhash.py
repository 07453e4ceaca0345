import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import simhash as X
from tessera.llm.components import components


def plain_fingerprint(text):
    data = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    words = re.findall(rb"[^\x20\x09-\x0D]+", data)
    if not words:
        return 0
    shingles = [b" ".join(words[k:k + 3]) for k in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, docs, bits=3):
    """component id of each row, by comparing all pairs"""
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    all_ = np.array(prints, np.uint64)
    for k in range(len(prints)):
        for j in np.nonzero(np.bitwise_count(all_ ^ all_[k]) <= bits)[0].tolist():
            a, b = find(k), find(j)
            parent[max(a, b)] = min(a, b)
    least = {}
    for k, d in enumerate(docs):
        r = find(k)
        least[r] = min((x for x in (least.get(r), d) if x is not None), default=None)
    return [least[find(k)] for k in range(len(prints))]


def check(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    prints = [plain_fingerprint(t) for _, t in rows]
    found = plain_components(prints, [d for d, _ in rows])
    expected = Counter((d, f"{p:016x}", c) for (d, _), p, c in zip(rows, prints, found))
    assert Counter(tuple(r) for r in X.op6_simhash_dedup(docs).collect()) == expected


def test_query_against_brute_force(documents):
    check(documents)


def test_awkward_rows(awkward, no_documents):
    check(awkward)
    assert X.op6_simhash_dedup(no_documents).count() == 0
    kept = X.deduplicated(awkward)
    assert kept.columns == awkward.columns
    classes = X.near_classes(awkward)
    assert kept.count() == classes.select("root", "component_id").distinct().count()
    assert X.deduplicated(no_documents).count() == 0


def near(n, seed, spread=5):
    """fingerprints around a few centres, many within three bits of each other"""
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 2**63, 4, np.int64)
    out = set()
    while len(out) < n:
        x = int(rng.choice(centres))
        for b in rng.integers(0, 64, rng.integers(0, spread)).tolist():
            x ^= -(1 << 63) if b == 63 else 1 << b
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize("crowd", [2048, 4])
def test_links_connect_what_the_distance_connects(spark, monkeypatch, crowd):
    monkeypatch.setattr(X, "CROWD", crowd)
    prints = near(500, 3)
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    links = X.links(df).cache()
    assert links.where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) > 3).isEmpty()
    roots = {r["node"]: r["root"] for r in components(links).collect()}
    unsigned = [p & 0xFFFFFFFFFFFFFFFF for p in prints]
    expected = plain_components(unsigned, prints)
    assert [roots.get(p, p) for p in prints] == expected
    links.unpersist()


def test_a_bucket_gives_no_more_links_than_a_forest():
    found = near(300, 5, 3)
    assert len(X._forest(found, 64)) == len(found) - 1
    assert X._forest([1, 1 << 62], 1) == [] and X._forest([7, 6], 1) == [(7, 6)]


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(k, k + 1) for k in range(1000, 1200)]
    star = [(5, k) for k in range(6, 300)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain + star + [(1, 1)], "u long, v long")).collect()}
    assert found == {**{k: 1000 for k in range(1000, 1201)}, **{k: 5 for k in range(5, 300)}}


def test_other_distances_are_refused(spark):
    with pytest.raises(ValueError):
        X.links(spark.createDataFrame([(1,)], "fp long"), 4)
