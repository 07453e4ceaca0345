"""Benchmark decontamination with an FM-index for each shard of the training text.

Words: A-Z in lower case, then runs of characters other than ASCII punctuation, blanks and
controls.  A test phrase is any ten consecutive words of a benchmark item (an item of fewer words
is one phrase).  Every word of a document inside any occurrence of a phrase is hit.

Each task cuts its documents into shards.  Words that no phrase holds become separators, and runs
of known words that are too short for any phrase are left out: neither can be part of an
occurrence.  Over what remains the shard gets an FM-index: suffix array (prefix doubling), Burrows-
Wheeler transform in a wavelet matrix, and sampled suffix positions (every eighth and each run's
start, so that walks back never cross a separator).  All phrases are searched backward at once,
one word a step, by wavelet ranks; the intervals' positions are located by walking to the next
sample; overlapping occurrences merge into removal spans.

The phrases are the stated query set.  They are sent to the tasks in blocks of about
``BLOCK_PHRASES`` (phrase, item) pairs; with more than one block the documents pass the blocks one
after the other inside the same task.  Nothing is shuffled, a hot document or source is never
gathered, and a lost task is simply run again.

Defined results: null and empty texts have no words; items without words have no phrase; items
whose id is null are one item, whose phrases hit like any other's: it counts in n_items and is left
out of the digest; an empty benchmark hits nothing; repeated rows are judged alike; other columns, whatever their names, are
passed through by ``decontaminated``, which drops a document only if it was hit and no word is left.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import masked, stored

PHRASE = 10
BLOCK_PHRASES = 100_000
#: A shard is closed when it has so many words that may be part of a phrase, or so many bytes of text.
SHARD_WORDS, SHARD_BYTES = 1_000_000, 32_000_000
SAMPLE = 8

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_WORD_BYTE = [48 <= c <= 57 or 97 <= c <= 122 or c >= 128 for c in range(256)]
#: A-Z in lower case, everything that is no part of a word as a blank.
_FOLD = bytes(_LOWER[c] if _WORD_BYTE[_LOWER[c]] else 32 for c in range(256))
_WORDS = re.compile(rb"[^ ]+")


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_FOLD).split()


def in_order(items: Iterable[int | None]) -> list[int | None]:
    """The null item comes last."""
    return sorted(items, key=lambda i: (i is None, i or 0))


class Phrases(NamedTuple):
    """A block of phrases as word numbers (from 1), right-aligned, and the items of each."""

    vocabulary: dict[bytes, int]
    symbols: np.ndarray
    lengths: np.ndarray
    items: list[list[int | None]]

    @classmethod
    def of(cls, pairs: Iterable[tuple[bytes, int]]) -> Phrases:
        by: dict[bytes, set[int | None]] = {}
        for phrase, item in pairs:
            by.setdefault(bytes(phrase), set()).add(item)
        vocabulary: dict[bytes, int] = {}
        split = [[vocabulary.setdefault(w, len(vocabulary) + 1) for w in p.split()] for p in sorted(by)]
        symbols = np.zeros((len(split), PHRASE), np.int64)
        for k, s in enumerate(split):
            symbols[k, PHRASE - len(s):] = s
        return cls(vocabulary, symbols, np.array([len(s) for s in split], np.int64), [in_order(by[p]) for p in sorted(by)])


class WaveletMatrix:
    """Rank and access over symbols, one bit a level; all operations take arrays."""

    def __init__(self, symbols: np.ndarray, largest: int):
        self.bits = max(1, int(largest).bit_length())
        self.zeros: list[int] = []
        self.before: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        s = symbols
        for level in range(self.bits - 1, -1, -1):
            high = (s >> level & 1).astype(bool)
            self.high.append(high)
            self.before.append(np.concatenate(([0], np.cumsum(~high))))
            self.zeros.append(int(self.before[-1][-1]))
            s = np.concatenate((s[~high], s[high]))
        self.first = self._down(np.arange(largest + 1), np.zeros(largest + 1, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k in range(self.bits):
            low = self.before[k][at]
            at = np.where(symbol >> (self.bits - 1 - k) & 1, self.zeros[k] + at - low, low)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position."""
        return self._down(symbol, at) - self.first[symbol]

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each position's symbol, and how often it occurs before it."""
        symbol = np.zeros(len(at), np.int64)
        for k in range(self.bits):
            low, high = self.before[k][at], self.high[k][at]
            symbol = symbol << 1 | high
            at = np.where(high, self.zeros[k] + at - low, low)
        return symbol, at - self.first[symbol]


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes by prefix doubling; zeros count as different symbols, in text order."""
    n = len(text)
    rank = text + n
    gaps = np.nonzero(text == 0)[0]
    rank[gaps] = np.arange(len(gaps))
    rank = np.unique(rank, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        after = np.zeros(n, np.int64)
        after[:max(0, n - step)] = rank[step:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        fresh = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        if fresh[-1] == n - 1:
            return order
        step *= 2


class FmIndex:
    """Over runs of symbols from 1, each run preceded by a zero."""

    def __init__(self, text: np.ndarray, largest: int):
        order = suffix_array(text)
        self.size = len(text)
        bwt = text[order - 1]
        self.wavelet = WaveletMatrix(bwt, largest)
        self.smaller = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=largest + 1))))
        after_gap = np.concatenate(([False], text[:-1] == 0))
        kept = (order % SAMPLE == 0) | after_gap[order] | (text[order] == 0)
        self.kept = kept
        self.kept_before = np.concatenate(([0], np.cumsum(kept)))
        self.samples = order[kept]

    def search(self, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
        """The suffix interval of each phrase, searched backward, all phrases at once."""
        low = np.zeros(len(phrases.lengths), np.int64)
        high = np.full(len(low), self.size)
        for k in range(PHRASE):
            at = np.nonzero((phrases.lengths > k) & (low < high))[0]
            c = phrases.symbols[at, PHRASE - 1 - k]
            low[at] = self.smaller[c] + self.wavelet.rank(c, low[at])
            high[at] = self.smaller[c] + self.wavelet.rank(c, high[at])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix-array rows."""
        rows, found, walked = rows.copy(), np.empty(len(rows), np.int64), np.zeros(len(rows), np.int64)
        todo = np.arange(len(rows))
        while todo.size:
            done = self.kept[rows[todo]]
            at = todo[done]
            found[at] = self.samples[self.kept_before[rows[at]]] + walked[at]
            todo = todo[~done]
            symbol, before = self.wavelet.access(rows[todo])
            rows[todo] = self.smaller[symbol] + before
            walked[todo] += 1
        return found


class Shard:
    """Documents added one by one; then each one's hit words and items."""

    def __init__(self, phrases: Phrases):
        self.phrases = phrases
        self.shortest = int(phrases.lengths.min()) if len(phrases.lengths) else 0
        self.runs: list[np.ndarray] = []
        self.where: list[tuple[int, int]] = []
        self.words = 0

    def add(self, doc: int, words: list[bytes]) -> None:
        if not self.shortest or len(words) < self.shortest:
            return
        get = self.phrases.vocabulary.get
        known = np.fromiter([get(w, 0) for w in words], np.int64, len(words))
        edge = np.diff(np.concatenate(([0], known > 0, [0])).astype(np.int8))
        starts, ends = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]
        for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
            if b - a >= self.shortest:
                self.runs.append(known[a:b])
                self.where.append((doc, a))
                self.words += b - a

    def hits(self) -> dict[int, tuple[list[list[int]], set[int]]]:
        """Document -> merged [first, end) word spans, and items."""
        if not self.runs:
            return {}
        lengths = np.array([len(r) + 1 for r in self.runs])
        begins = np.cumsum(lengths) - lengths
        text = np.concatenate([part for r in self.runs for part in (np.zeros(1, np.int64), r)])
        index = FmIndex(text, len(self.phrases.vocabulary))
        low, high = index.search(self.phrases)
        counts = high - low
        phrase = np.repeat(np.arange(len(low)), counts)
        rows = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(low, counts)
        place = index.locate(rows)
        run = np.searchsorted(begins, place, "right") - 1
        order = np.argsort(place, kind="stable")
        found: dict[int, tuple[list[list[int]], set[int]]] = {}
        inside = place - begins[run] - 1
        for p, r, a in zip(phrase[order].tolist(), run[order].tolist(), inside[order].tolist(), strict=True):
            doc, base = self.where[r]
            spans, items = found.setdefault(doc, ([], set()))
            items.update(self.phrases.items[p])
            first, end = base + a, base + a + int(self.phrases.lengths[p])
            if spans and first <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], end)
            else:
                spans.append([first, end])
        return found


def merged(spans: Iterable[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for first, end in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([first, end])
    return out


def _phrase_blocks(benchmark: DataFrame, id_col: str, text_col: str) -> list[DataFrame]:
    """(phrase, item) pairs in blocks of about BLOCK_PHRASES."""
    given = benchmark.select(benchmark[id_col].cast("long").alias("item"), benchmark[text_col].cast("string").cast("binary").alias("text"))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            phrases, items = [], []
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = words_of(text)
                for k in range(max(1, len(words) - PHRASE + 1) if words else 0):
                    phrases.append(b" ".join(words[k:k + PHRASE]))
                    items.append(item)
            yield pa.RecordBatch.from_arrays([pa.array(phrases, pa.binary()), pa.array(items, pa.int64())], names=["phrase", "item"])

    pairs = stored(given.mapInArrow(cut, "phrase binary, item long").distinct(), "phrases")
    blocks = max(1, -(-pairs.count() // BLOCK_PHRASES))
    return [pairs.where(F.pmod(F.xxhash64("phrase", "item"), F.lit(blocks)) == k) for k in range(blocks)]


_SPANS = pa.list_(pa.list_(pa.int64()))
_ITEMS = pa.list_(pa.int64())


def _searched(docs: DataFrame, benchmark: DataFrame, carried: list[str], text_col: str, bench_id: str, bench_text: str,
              clean: bool = False) -> DataFrame:
    """``carried`` columns of ``docs``, and _text (bytes; without the spans if ``clean``), _words, _spans, _items of every row."""
    given = docs.select(
        *[docs[c] for c in carried], docs[text_col].cast("string").cast("binary").alias("_text"), F.lit(0).cast("long").alias("_words"),
        F.array().cast("array<array<bigint>>").alias("_spans"), F.array().cast("array<bigint>").alias("_items"),
    )
    ddl = T.StructType([T.StructField(f.name, f.dataType) for f in given.schema.fields])
    context = docs.sparkSession.sparkContext
    blocks = _phrase_blocks(benchmark, bench_id, bench_text)
    for block in blocks:
        sent = context.broadcast(Phrases.of((r["phrase"], r["item"]) for r in block.collect()))

        def search(batches: Iterable[pa.RecordBatch], sent=sent, cut=clean and block is blocks[-1]) -> Iterator[pa.RecordBatch]:
            shard, held, number, size, counts = Shard(sent.value), [], 0, 0, []

            def close() -> Iterator[pa.RecordBatch]:
                hits, at = shard.hits(), 0
                for batch in held:
                    spans, items = batch.column("_spans").to_pylist(), batch.column("_items").to_pylist()
                    for k in range(batch.num_rows):
                        if at + k in hits:
                            new, which = hits[at + k]
                            spans[k] = merged([*spans[k], *new])
                            items[k] = in_order({*items[k], *which})
                    fixed = {"_words": pa.array(counts[at:at + batch.num_rows], pa.int64()), "_spans": pa.array(spans, _SPANS), "_items": pa.array(items, _ITEMS)}
                    if cut and any(spans):
                        texts = batch.column("_text").to_pylist()
                        fixed["_text"] = pa.array([without_spans(t, s) if s else t for t, s in zip(texts, spans, strict=True)], pa.binary())
                    at += batch.num_rows
                    columns = [fixed.get(n, batch.column(i)) for i, n in enumerate(batch.schema.names)]
                    yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

            for batch in batches:
                text = batch.column("_text")
                for k in range(batch.num_rows):
                    words = words_of(text[k].as_py())
                    shard.add(number, words)
                    counts.append(len(words))
                    number += 1
                held.append(batch)
                size += text.nbytes
                if shard.words >= SHARD_WORDS or size >= SHARD_BYTES:
                    yield from close()
                    shard, held, number, size, counts = Shard(sent.value), [], 0, 0, []
            yield from close()

        given = given.mapInArrow(search, ddl)
    return given


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  bench_id: str = "item_id", bench_text: str = "text") -> DataFrame:
    """doc_id, n_words, spans (hit words, [first, end)) and items of every row."""
    renamed = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    found = _searched(renamed, benchmark, ["doc_id"], "text", bench_id, bench_text)
    return found.select("doc_id", F.col("_words").alias("n_words"), F.col("_spans").alias("spans"), F.col("_items").alias("items"))


def without_spans(text: bytes, spans: list[list[int]]) -> bytes:
    """``text`` without the words of ``spans`` and what stands between them."""
    places = [m.span() for m in _WORDS.finditer(text.translate(_FOLD))]
    out, at = [], 0
    for first, end in spans:
        out.append(text[at:places[first][0]])
        at = places[end - 1][1]
    return b"".join([*out, text[at:]])


def decontaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", bench_id: str = "item_id", bench_text: str = "text",
                   chars_col: str = "n_chars") -> DataFrame:
    """``docs`` without their removal spans (and with ``chars_col``, if there is one, counted anew)."""
    hidden, names = masked(docs)
    carried = [n for c, n in names.items() if c != text_col]
    found = _searched(hidden, benchmark, carried, names[text_col], bench_id, bench_text, clean=True)
    hit = F.size("_spans") > 0
    spanned = F.aggregate("_spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    found = found.where(~hit | (spanned < F.col("_words"))).withColumn("_new", F.col("_text").cast("string"))
    out = []
    for old, new in names.items():
        if old == text_col:
            out.append(F.col("_new").alias(old))
        elif old == chars_col:
            out.append(F.when(hit, F.length("_new")).otherwise(F.col(new)).cast(docs.schema[old].dataType).alias(old))
        else:
            out.append(F.col(new).alias(old))
    return found.select(*out)


def op10_decontamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = contamination(documents, benchmark)
    joined = F.concat_ws(",", F.array_sort(F.transform("items", lambda i: i.cast("string"))))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(joined, 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


_SQL_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
ORACLE_SQL = f"""
with d as (select doc_id, {_SQL_WORDS} as w from documents),
b as (select item_id, {_SQL_WORDS} as w from benchmark),
phrases as (
  select distinct item_id, least(len(w), {PHRASE}) as n, array_to_string(w[k:k + least(len(w), {PHRASE}) - 1], ' ') as phrase
  from (select item_id, w, unnest(range(1, greatest(len(w) - {PHRASE - 1}, 1) + 1)) as k from b where len(w) > 0) x),
windows as (
  select doc_id, k, n, array_to_string(w[k:k + n - 1], ' ') as phrase
  from (select doc_id, w, unnest(range(1, len(w) + 1)) as k from d) x, (select distinct n from phrases) s
  where k + n - 1 <= len(w)),
found as (select doc_id, k, n, item_id from windows join phrases using (n, phrase)),
hits as (
  select doc_id, count(distinct p) as n_hit
  from (select doc_id, unnest(range(k, k + n)) as p from (select distinct doc_id, k, n from found) y) z group by doc_id),
items as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as joined
  from (select distinct doc_id, cast(item_id as varchar) as item from found) y group by doc_id)
select d.doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(joined, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hits using (doc_id) left join items using (doc_id)
"""
