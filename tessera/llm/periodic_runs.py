"""Periodic run detection, distributed by tiles that grow with the period.

A run is a stretch of consecutive words with smallest period q, at least max(24, 3q) long, that no
neighbour extends keeping q.  Words at i and i + q match for all i of an interval of at least
max(24 - q, 2q) words; such intervals are looked for one period octave [P, 2P) at a time (the first
octave, P = 8, takes all q below 16).  Every such interval holds a whole aligned block of P words, so:

1. A document is cut into blocks of P words for each octave.  A block can only lie in a run if an equal
   stretch of P words starts q after it; rolling hashes of all stretches of P words (from those of
   P / 2) find those blocks in a few array operations.  Hashes only sift: unequal hashes prove a
   block free, equal ones are verified.
2. Blocks that stay, with their neighbourhood (one block before, three after), are written as tiles,
   neighbours in one tile up to ``TILE_BLOCKS``; so tiles overlap, and a long document is many rows.
3. Each tile is solved by itself: for a block at c the Z-function of the words from c on gives
   how far c and c + q agree to the right, that of the reversed words how far to the left.  A q
   whose first q words have a shorter period dividing q is no smallest period, wherever the run ends.
4. Fragments are shuffled by document and period, touching ones are stitched, and short ones dropped.

Everything is linear in the text but for the number of octaves (the logarithm of the length).  A task
holds one document while it cuts tiles, then one tile; documents without a suspicious block
are finished in the first pass and never shuffled.

Defined results: null, empty and short texts have no runs; repeated rows are analysed each by itself; a
null id is kept as it is.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import masked, row_hash, stored, unmasked

MIN_LENGTH = 24
MIN_EXPONENT = 3
#: Blocks of the first octave: the shortest interval, max(24 - q, 2q) = 16 words, holds a whole aligned block of 8.
FIRST = 8
TILE_BLOCKS = 64
#: A batch of results is given out once it holds so many bytes.
BATCH_BYTES = 1 << 23

Rewrite = Callable[[int | None, list[bytes]], list[bytes]]


def planted(doc: int | None, words: list[bytes]) -> list[bytes]:
    """The query's rule that gives a tenth of the documents a periodic tail.  A null id has no number: no tail."""
    n = len(words)
    h = 1 if doc is None else zlib.crc32(str(doc).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    tail = words[a:a + p]
    return words[:a] + (tail * ((n - a) // p + 1))[:n - a]


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = a * np.uint64(0x9E3779B97F4A7C15) + b
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out


def octaves(n: int) -> Iterator[tuple[int, int, int]]:
    """(P, least q, end of q) of every octave with a period that fits ``n`` words."""
    size, low = FIRST, 1
    while MIN_EXPONENT * low <= n and n >= MIN_LENGTH:
        yield size, low, 2 * size
        size, low = 2 * size, 2 * size


def suspects(ids: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(P, first block, number of blocks): neighbouring blocks that may lie in a run."""
    n = len(ids)
    if n < MIN_LENGTH:
        return
    hashes, width = _mixed(ids.astype(np.uint64) + np.uint64(1), np.uint64(0)), 1
    for size, low, end in octaves(n):
        while width < size:
            hashes = _mixed(hashes[:-width], hashes[width:]) if len(hashes) > width else hashes[:0]
            width *= 2
        blocks = (len(hashes) - low + size - 1) // size
        if blocks <= 0:
            return
        # padding is told apart from every hash of a block by a second condition below: places past the end don't count
        at = np.arange(blocks) * size
        if low == 1:
            places = at[:, None] + np.arange(low, end)
            same = (hashes[np.minimum(places, len(hashes) - 1)] == hashes[at][:, None]) & (places < len(hashes))
        else:
            reached = hashes[size:size + blocks * size]
            full = len(reached) // size
            same = np.zeros((blocks, size), bool)
            same[:full] = reached[:full * size].reshape(full, size) == hashes[at[:full]][:, None]
            if full < blocks:
                rest = reached[full * size:]
                same[full, :len(rest)] = rest == hashes[at[full]]
        hit = np.nonzero(same.any(axis=1))[0]
        if hit.size:
            for group in np.split(hit, np.nonzero(np.diff(hit) > 1)[0] + 1):
                for k in range(0, len(group), TILE_BLOCKS):
                    yield size, int(group[k]), len(group[k:k + TILE_BLOCKS])


def z_function(x: list[int]) -> list[int]:
    """z[i]: how many symbols the text from i on shares with its start; z[0] is the length."""
    n = len(x)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        while i + k < n and x[k] == x[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def _primes(q: int) -> list[int]:
    out, p = [], 2
    while p * p <= q:
        if q % p == 0:
            out.append(p)
            while q % p == 0:
                q //= p
        p += 1
    return [*out, q] if q > 1 else out


def solve(size: int, start: int, first: int, blocks: int, words: list[int]) -> Iterator[tuple[int, int, int]]:
    """(q, begin, end): fragments of the intervals in which words q apart agree, for the blocks of one tile.

    ``words`` are the document's from ``start`` on; the fragments have the document's places.
    """
    low = 1 if size == FIRST else size
    before: set[int] = set()
    for k in range(first, first + blocks):
        c = k * size - start
        z = z_function(words[c:c + 4 * size])
        found = {q for q in range(low, min(2 * size, len(z))) if z[q] >= size}
        found = {q for q in found if not any(z[q // p] >= q - q // p for p in _primes(q))}
        back = None
        if found - before:
            behind, reach = words[max(0, c - size):c][::-1], words[max(0, c - size):c + 2 * size][::-1]
            joined = z_function([*behind, -1, *reach])
            back, ahead = joined[len(behind) + 1:], len(reach) - len(behind)
        for q in found:
            # the word before c + q stands, reversed, at ahead - q; blocks already in a fragment of q reach back by it
            left = 0 if q in before or back is None else back[ahead - q] if q <= ahead else 0
            yield q, start + c - left, start + c + z[q]
        before = found


def _first_pass(rewrite: Rewrite | None):
    names = ("key", "doc", "tie", "words", "n", "sha", "octave", "start", "first", "blocks", "tile")
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary())

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, held = TaskContext.get().partitionId() << 33, [], 0

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=list(names))
            rows.clear()
            return made

        for batch in batches:
            for doc, tie, text in zip(batch.column("doc").to_pylist(), batch.column("tie").to_pylist(), batch.column("text"), strict=True):
                words = (text.as_py() or b"").split()
                if rewrite:
                    words = rewrite(doc, words)
                number = defaultdict(count().__next__)
                ids = np.fromiter((number[w] for w in words), np.int32, len(words))
                joined, tiled = b" ".join(words), False
                for size, first, blocks in suspects(ids):
                    start = max(0, (first - 1) * size)
                    tile = ids[start:(first + blocks + 3) * size].tobytes()
                    rows.append((key, None, None, None, None, None, size, start, first, blocks, tile))
                    held, tiled = held + len(tile), True
                    if held > BATCH_BYTES:
                        yield out()
                        held = 0
                rows.append((key, doc, tie, joined if tiled else None, len(words), hashlib.sha256(joined).hexdigest(), None, None, None, None, None))
                held += 100 + (len(joined) if tiled else 0)
                key += 1
                if held > BATCH_BYTES:
                    yield out()
                    held = 0
        yield out()

    return work


_FIRST_DDL = "key long, doc long, tie long, words binary, n long, sha string, octave int, start long, first long, blocks int, tile binary"


def _solved(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for key, size, start, first, blocks, tile in zip(*(batch.column(c).to_pylist() for c in ("key", "octave", "start", "first", "blocks", "tile")), strict=True):
            found += [(key, *f) for f in solve(size, start, first, blocks, np.frombuffer(tile, np.int32).tolist())]
        yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in range(4)], names=["key", "period", "begin", "end"])


def _finished(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = []
        for words, runs in zip(batch.column("words"), batch.column("runs").to_pylist(), strict=True):
            made.append(collapse(words.as_py().split(), [(r["start"], r["length"], r["period"]) for r in runs or []]))
        yield pa.RecordBatch.from_arrays([
            batch.column("doc"), batch.column("tie"), batch.column("n"), batch.column("runs"),
            pa.array([None if m is None else b" ".join(m) for m in made], pa.binary()), batch.column("words"),
        ], names=["doc", "tie", "n", "runs", "collapsed", "words"])


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes] | None:
    """The words left when every run keeps its first period only; None if there is no run."""
    if not runs:
        return None
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, [s + q for s, _, q in runs], 1)
    np.add.at(change, [s + length for s, length, _ in runs], -1)
    covered = np.cumsum(change[:-1])
    return [words[k] for k in np.nonzero(covered == 0)[0].tolist()]


def stitched(fragments: DataFrame) -> DataFrame:
    """(key, period, start, length) of the runs: touching fragments of one document and period are one interval."""
    order = W.partitionBy("key", "period").orderBy("begin", "end")
    reached = F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1))
    parts = fragments.withColumn("_new", F.when(F.coalesce(F.col("begin") <= reached, F.lit(False)), 0).otherwise(1))
    parts = parts.withColumn("_part", F.sum("_new").over(order.rowsBetween(W.unboundedPreceding, 0)))
    whole = parts.groupBy("key", "period", "_part").agg(F.min("begin").alias("start"), F.max("end").alias("_end"))
    length = F.col("_end") - F.col("start") + F.col("period")
    return whole.select("key", "period", "start", length.alias("length")) \
        .where((F.col("length") >= MIN_LENGTH) & (F.col("length") >= MIN_EXPONENT * F.col("period")))


def analysed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rewrite: Rewrite | None = None) -> DataFrame:
    """doc, tie (the row's hash), n (words), runs (array of start, length, period by start, period), collapsed (the
    text whose runs keep their first period only, words joined by one space; null without runs), sha (of the result)."""
    given = docs.select(docs[id_col].cast("long").alias("doc"), row_hash(docs).alias("tie"), docs[text_col].cast("string").cast("binary").alias("text"))
    first = stored(given.mapInArrow(_first_pass(rewrite), _FIRST_DDL), "run-tiles")
    tiles = first.where("octave is not null").select("key", "octave", "start", "first", "blocks", "tile")
    fragments = tiles.repartition("key", "octave", "first").mapInArrow(_solved, "key long, period long, begin long, end long")
    found = stitched(fragments)
    runs = found.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("_r"))
    kind = "array<struct<start:bigint,length:bigint,period:bigint>>"
    runs = runs.select("key", F.transform("_r", lambda r: F.struct(r["start"].alias("start"), r["length"].alias("length"), r["period"].alias("period"))).cast(kind).alias("runs"))
    rows = first.where("octave is null")
    held = rows.where("words is not null").select("key", "doc", "tie", "n", "words").join(runs, "key", "left")
    held = held.select("doc", "tie", "n", "runs", "words").mapInArrow(
        _finished, f"doc long, tie long, n long, runs {kind}, collapsed binary, words binary")
    sha = F.sha2(F.coalesce("collapsed", "words"), 256)
    held = held.select("doc", "tie", "n", F.coalesce("runs", F.array().cast(kind)).alias("runs"), F.col("collapsed").cast("string").alias("collapsed"), sha.alias("sha"))
    free = rows.where("words is null").select("doc", "tie", "n", F.array().cast(kind).alias("runs"), F.lit(None).cast("string").alias("collapsed"), "sha")
    return held.unionByName(free)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a run: doc_id, start, length, period (repeated rows give their runs each)."""
    found = analysed(docs, id_col, text_col).select(F.col("doc").alias("doc_id"), F.explode("runs").alias("r"))
    return found.select("doc_id", "r.start", "r.length", "r.period")


def collapsed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with runs cut to their first period in the texts that have any; other rows stay as they are."""
    hidden, names = masked(docs)
    rows = hidden.withColumn("_tie", row_hash(hidden)).withColumn("_doc", F.col(names[id_col]).cast("long"))
    cut = analysed(hidden, names[id_col], names[text_col]).where("collapsed is not null").select(F.col("doc").alias("_cdoc"), F.col("tie").alias("_ctie"), "collapsed")
    cut = cut.groupBy("_cdoc", "_ctie").agg(F.first("collapsed").alias("_new"))
    met = rows.join(cut, (F.col("_tie") == F.col("_ctie")) & F.col("_doc").eqNullSafe(F.col("_cdoc")), "left")
    met = met.withColumn(names[text_col], F.coalesce("_new", names[text_col]))
    return unmasked(met, names)


def op12_periodic_runs(documents: DataFrame) -> DataFrame:
    found = analysed(documents, rewrite=planted)

    def heavier(a, b):
        """Greatest length / period, compared without division; then the smallest start, then period."""
        mine, its = b["length"] * a["period"], a["length"] * b["period"]
        later = (b["start"] < a["start"]) | ((b["start"] == a["start"]) & (b["period"] < a["period"]))
        return F.when((mine > its) | ((mine == its) & later), b).otherwise(a)

    first = F.get("runs", F.lit(0))
    best = F.when(F.size("runs") > 0, F.aggregate("runs", first, heavier))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = found.withColumn("best", best)
    return rows.select(
        F.col("doc").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.col("sha").alias("collapsed_sha256"))
