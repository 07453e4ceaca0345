import hashlib
import random
from collections import Counter, defaultdict

from tessera.llm import exact_dedup as X


def brute(rows):
    groups = defaultdict(list)
    for doc, text in rows:
        groups[text or ""].append(doc)
    out = Counter()
    for doc, text in rows:
        ids = [d for d in groups[text or ""] if d is not None]
        keep = max(ids, default=None)
        out[(doc, keep, len(groups[text or ""]), doc == keep, hashlib.sha256((text or "").encode()).hexdigest())] += 1
    return out


def result(docs):
    return Counter(tuple(r) for r in X.op7_exact_dedup(docs).collect())


def rows_of(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def test_index_against_a_dictionary():
    rng, index, live = random.Random(1), X.CuckooIndex(2), {}
    keys = [hashlib.sha256(str(k).encode()).digest() for k in range(3000)]
    for _ in range(20_000):
        key, doc = rng.choice(keys), rng.randrange(1000)
        if rng.random() < 0.3:
            assert index.delete(key) == (live.pop(key, None) is not None)
        else:
            assert index.add(key, doc) == (key not in live)
            old = live.setdefault(key, [doc, 0, 0])
            old[1] += 1
            old[2] = old[2] + 1 if doc == old[0] else 1 if doc > old[0] else old[2]
            old[0] = max(old[0], doc)
    assert len(index) == len(live) and all((k in index) == (k in live) for k in keys)
    found = {d: [k, s, n] for b in index.batches(100) for d, k, s, n in zip(*(b.column(i).to_pylist() for i in range(4)))}
    assert found == live


def test_equal_tags_are_verified():
    # same tag and buckets, different digests: neither may be taken for the other
    a, b = b"\x07\x00" + bytes(30), b"\x07\x00" + bytes(8) + b"\x01" * 22
    index = X.CuckooIndex(2)
    assert index.add(a, 1) and b not in index and not index.delete(b) and a in index
    many = [b"\x07\x00" + bytes(8) + k.to_bytes(22, "big") for k in range(1, 9)]
    index = X.CuckooIndex(2)
    assert all(index.add(m, 1) for m in many) and all(m in index for m in many) and len(index) == 8


def test_query_against_brute_force(documents):
    assert result(documents) == brute(rows_of(documents))


def test_awkward_rows(awkward, no_documents):
    assert result(awkward) == brute(rows_of(awkward))
    assert result(no_documents) == Counter()


def test_folding_in_pieces(documents, monkeypatch):
    monkeypatch.setattr(X, "FLUSH_ENTRIES", 7)
    assert result(documents) == brute(rows_of(documents))


def test_deduplicated(awkward, no_documents):
    kept = X.deduplicated(awkward)
    assert kept.columns == awkward.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    expected = {(k[1], k[4]) for k in brute(rows_of(awkward))}
    assert Counter((d, hashlib.sha256((t or "").encode()).hexdigest()) for d, t in rows) == Counter(expected)
    assert X.deduplicated(no_documents).count() == 0


def test_live_index(spark):
    schema = "doc_id long, text string"
    one = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], schema)
    two = spark.createDataFrame([(9, "a"), (4, "c")], schema)
    index = X.insert(X.build_index(one), two)
    assert sorted((r.keep_id, r.group_size) for r in index.collect()) == [(2, 1), (4, 1), (9, 3)]
    left = X.delete(index, spark.createDataFrame([("a",), ("never seen",), (None,)], "text string"))
    assert sorted((r.keep_id, r.group_size) for r in left.collect()) == [(2, 1), (4, 1)]


def test_index_of_bounded_size(spark, documents, monkeypatch):
    """A task's index starts anew between digests; insertion and deletion stay whole."""
    monkeypatch.setattr(X, "FLUSH_ENTRIES", 5)
    more = documents.unionByName(documents.limit(30))
    expected = Counter((r.doc_id, r.text or "") for r in more.collect())
    rows = Counter(tuple(r) for r in X.build_index(more).select("keep_id", "group_size").collect())
    sizes, keep = Counter(), {}
    for (doc, text), n in expected.items():
        sizes[text] += n
        keep[text] = max(doc, keep.get(text, doc))
    assert rows == Counter((keep[t], sizes[t]) for t in sizes)
    index = X.stored(X.build_index(more), "bounded-index")
    left = X.delete(index, documents.where("doc_id % 2 = 0"))
    gone = {r.text or "" for r in documents.where("doc_id % 2 = 0").collect()}
    assert left.count() == len(set(sizes) - gone)
