import hashlib
import random
import zlib
from collections import Counter
from fractions import Fraction

import pytest

from tessera.llm import periodic_runs as X


def smallest_period(w):
    fail, k = [0] * len(w), 0
    for i in range(1, len(w)):
        while k and w[i] != w[k]:
            k = fail[k - 1]
        k += w[i] == w[k]
        fail[i] = k
    return len(w) - fail[-1]


def brute_runs(w):
    """Every maximal stretch whose smallest period q fits at least three times, 24 words at least."""
    out = set()
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(24, 3 * q) and smallest_period(w[i:j + q]) == q:
                out.add((i, j - i + q, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute(doc, text):
    w = (text or "").encode().split()
    if doc is not None and w and zlib.crc32(str(doc).encode()) % 10 == 0:
        g = zlib.crc32(str(doc).encode()) // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(len(w))]
    runs = brute_runs(w)
    drop = set()
    for s, length, q in runs:
        drop.update(range(s + q, s + length))
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = b" ".join(x for k, x in enumerate(w) if k not in drop)
    four = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    return (doc, len(runs), *four, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def check(docs):
    found = Counter(tuple(r) for r in X.op12_periodic_runs(docs).collect())
    assert found == Counter(brute(*r) for r in docs.select(docs["doc_id"], docs["text"]).collect())
    return found


def test_query_against_brute_force(documents):
    found = check(documents.where("length(text) < 30000"))
    assert sum(r[1] > 0 for r in found) > 10
    assert X.op12_periodic_runs(documents).count() == documents.count()


def test_awkward_rows(spark, awkward, no_documents):
    check(awkward.where("length(text) < 30000 or text is null"))
    assert X.op12_periodic_runs(awkward).count() == awkward.count()
    assert X.op12_periodic_runs(no_documents).count() == 0


def found_runs(words):
    number = {}
    ids = [number.setdefault(w, len(number)) for w in words]
    fragments = {}
    for size, first, blocks in X.suspects(X.np.array(ids, X.np.int32)):
        start = max(0, (first - 1) * size)
        for q, a, b in X.solve(size, start, first, blocks, ids[start:(first + blocks + 3) * size]):
            fragments.setdefault(q, []).append((a, b))
    out = []
    for q, parts in fragments.items():
        whole = []
        for a, b in sorted(parts):
            if whole and a <= whole[-1][1]:
                whole[-1][1] = max(b, whole[-1][1])
            else:
                whole.append([a, b])
        out += [(a, b - a + q, q) for a, b in whole if b - a + q >= max(24, 3 * q)]
    return sorted(out, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("seed", range(6))
def test_tiles_find_every_run(seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(X, "TILE_BLOCKS", rng.choice([1, 2, 64]))
    for _ in range(60):
        words = []
        while len(words) < rng.randint(0, 700):
            unit = [rng.choice("ab") for _ in range(rng.choice([1, 2, 3, 5, 8, 13, 16, 17, 31, 40, 64, 90]))]
            if rng.random() < 0.3:
                unit = unit[:2] * rng.randint(1, 20) + ["c"]
            words += (unit * rng.randint(1, 9))[:rng.randint(1, 600)]
            words += [rng.choice("abcdef") for _ in range(rng.randint(0, 30))]
        assert found_runs(words) == brute_runs(words)


@pytest.mark.parametrize("n", [23, 24, 25, 100, 1000])
def test_one_word_only(n):
    assert found_runs(["a"] * n) == ([(0, n, 1)] if n >= 24 else [])
    words = [f"w{k}" for k in range(n)]
    assert found_runs(words * 3) == ([(0, 3 * n, n)] if 3 * n >= 24 else [])
    assert found_runs(words * 2 + words[:-1]) == []


def test_z_function():
    rng = random.Random(1)
    for _ in range(200):
        x = [rng.randint(0, 1) for _ in range(rng.randint(0, 40))]
        assert X.z_function(x) == [next((k for k in range(len(x) - i) if x[k] != x[i + k]), len(x) - i) for i in range(len(x))]


def test_runs_and_collapsed_texts(spark):
    line = " ".join(f"l{k}" for k in range(10))
    rows = [(1, f"start {line} {line} {line} end", 1), (1, f"start {line} {line} {line} end", 1), (2, "  clean\n text ", 2), (None, "a " * 24, 3), (4, None, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tie long")
    assert sorted(map(tuple, X.periodic_runs(docs).collect()), key=str) == [(1, 1, 30, 10), (1, 1, 30, 10), (None, 0, 24, 1)]
    out = X.collapsed(docs)
    assert out.columns == docs.columns
    assert sorted((tuple(r) for r in out.collect()), key=str) == sorted(
        [(1, f"start {line} end", 1), (1, f"start {line} end", 1), (2, "  clean\n text ", 2), (None, "a", 3), (4, None, 4)], key=str)
