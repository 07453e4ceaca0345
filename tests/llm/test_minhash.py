import random
from collections import Counter

import numpy as np
import pytest

from tessera.llm import minhash as X


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[k:k + 4]) for k in range(max(1, len(w) - 3))) if w else frozenset()


def brute(docs):
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(docs)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for k, (doc, _) in enumerate(docs):
        if doc is not None:
            r = find(k)
            least[r] = min(least.get(r, doc), doc)
    out = Counter()
    for k, (doc, _) in enumerate(docs):
        component = least.get(find(k))
        out[(doc, len(sets[k]), component, doc == component)] += 1
    return out


def check(docs):
    rows = [tuple(r) for r in docs.select(docs["doc_id"], docs["text"]).collect()]
    found = Counter(tuple(r) for r in X.op11_minhash_dedup(docs).collect())
    assert found == brute(rows)
    return found


def mutants(rng, base, count, changes):
    out = []
    for _ in range(count):
        words = list(base)
        for _ in range(rng.randint(0, changes)):
            words[rng.randrange(len(words))] = f"new{rng.randrange(10 ** 6)}"
        out.append(" ".join(words))
    return out


@pytest.fixture(scope="module")
def families(spark):
    rng = random.Random(3)
    texts = []
    for f in range(4):
        base = [f"f{f}w{rng.randrange(400)}" for _ in range(120)]
        texts += mutants(rng, base, 60, 6)
    passage = [f"shared{k}" for k in range(60)]
    texts += [" ".join(passage + [f"own{d}x{k}" for k in range(60)]) for d in range(60)]
    rng.shuffle(texts)
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)


def test_query_against_brute_force(documents):
    found = check(documents)
    assert any(doc != component for doc, _, component, _ in found)


def test_families(families):
    check(families)


@pytest.mark.parametrize("crowd, group, probes", [(10, 4_000_000, 32), (4096, 2000, 4), (10, 3000, 2), (10, 500, 1)])
def test_crowds_and_large_groups(families, monkeypatch, crowd, group, probes):
    monkeypatch.setattr(X, "CROWD", crowd)
    monkeypatch.setattr(X, "GROUP_SHINGLES", group)
    monkeypatch.setattr(X, "PROBES", probes)
    check(families)


def test_awkward_rows(awkward, no_documents):
    check(awkward)
    assert X.op11_minhash_dedup(no_documents).count() == 0


def test_exactly_eighty_percent(spark):
    """9 of 11 words' sets: shingle sets built so that the overlap is 80 % and just under it."""
    common = [f"c{k}" for k in range(83)]  # 80 shingles
    a = " ".join(common + [f"a{k}" for k in range(10)])
    b = " ".join(common + [f"b{k}" for k in range(10)])
    c = " ".join([f"c{k}" for k in range(200, 283)] + [f"d{k}" for k in range(10)])
    d = " ".join([f"c{k}" for k in range(200, 283)] + [f"e{k}" for k in range(11)])
    found = check(spark.createDataFrame([(1, a), (2, b), (3, c), (4, d), (5, "one two"), (6, "One two"), (7, "one two three")], "doc_id long, text string"))
    assert (2, 90, 1, False) in found and (4, 91, 4, True) in found and (6, 1, 5, False) in found


def test_deduplicated(spark, awkward, no_documents):
    kept = X.deduplicated(awkward)
    assert kept.columns == awkward.columns
    expected = {(doc, component) for doc, _, component, own in brute([tuple(r) for r in awkward.select("doc_id", "text").collect()]) if own}
    assert {r.doc_id for r in kept.collect()} == {doc for doc, _ in expected} | {None}
    assert X.deduplicated(no_documents).count() == 0


def test_sketch_distance_follows_similarity():
    rng = np.random.default_rng(5)
    means = []
    for share in (1.0, 0.95, 0.8, 0.5):
        seen = []
        for _ in range(60):
            both = rng.integers(0, 1 << 63, 600, np.uint64)
            cut = int(600 * share)
            x, y = np.concatenate([both[:cut], rng.integers(0, 1 << 63, (600 - cut) // 2, np.uint64)]), np.concatenate([both[:cut], rng.integers(0, 1 << 63, (600 - cut) // 2, np.uint64)])
            seen.append(int(X.ones(X.odd_sketch(X.samples(x))[None], X.odd_sketch(X.samples(y)))[0]))
        means.append(np.mean(seen))
        if share == 0.8:
            assert max(seen) <= X.MAX_ONES
    assert means[0] == 0 and means == sorted(means) and means[-1] > X.MAX_ONES


def test_no_wanted_text_is_left_out(spark, monkeypatch):
    monkeypatch.setattr(X, "MARKS", 1 << 17)
    rows = [(7919 * k - (1 << 62) + k * k * (1 << 33), k) for k in range(20_000)]
    given = spark.createDataFrame(rows, "th long, k int").repartition(4)
    wanted = given.where("k % 10 = 3").select("th")
    kept = {r.k for r in X._likely(given, wanted).collect()}
    assert {k for k in range(3, 20_000, 10)} <= kept and len(kept) < 4500
    assert X._likely(given, wanted.where("false")).count() == 0
