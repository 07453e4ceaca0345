"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

    score = sigmoid(b + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j)

Features: the different words (lower case, hashed into ``BUCKETS`` buckets; damped counts, scaled
to length one), standardised statistics of the text's structure (shares of capitals, digits,
symbols and pipes, repetition of words and lines, lengths, ...), and its length as metadata.  The
pairwise term costs linear time by the sum-of-squares identity

    sum_{i<j} <v_i, v_j> x_i x_j = 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2].

The machine is fitted by Adagrad on a bounded sample of labelled rows (``SAMPLE`` at most by
expectation) that aren't held out.  Scoring is one pass over the whole texts with the parameters
sent to the tasks: BUCKETS x (RANK + 1) numbers.

Defined results: a null or empty text has statistics of zero and still scores; without labels of
both classes every score is the share of label 1 (0.5 without labels); repeated rows score alike;
labels, lang, source and doc_id are never read for a score.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.labelled import held_out, labelled_sample

SAMPLE = 8000
BUCKETS = 1 << 14
RANK = 8
EPOCHS = 12
BATCH = 128
RATE = 0.05
L2_WEIGHT, L2_FACTOR = 1e-4, 1e-3
SEED = 42
REMEMBERED = 300_000
CLIP = 4.0

STATISTICS = (
    "log_chars", "log_words", "log_lines", "capitals", "digits", "symbols", "punctuation", "pipes", "exclamations", "blanks", "non_ascii",
    "word_length", "different_words", "top_word", "repeats_previous", "capital_words", "symbol_words", "different_lines",
    "words_per_line", "top_line", "entropy",
)


class _Buckets(dict):
    """Word -> bucket; bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        bucket = self[word] = zlib.crc32(word.lower().strip(b".,;:!?\"'()")) % BUCKETS
        return bucket


def _share(counts: np.ndarray, of: bytes, n: int) -> float:
    return float(counts[np.frombuffer(of, np.uint8)].sum()) / n


def described(text: bytes, buckets: _Buckets) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Statistics, buckets and their values of one UTF-8 text."""
    stats = np.zeros(len(STATISTICS))
    words = text.split()
    if not words:
        stats[0] = math.log1p(len(text))
        return stats, np.zeros(0, np.int64), np.zeros(0)
    n = len(text)
    chars = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    seen = Counter(words)
    lines = text.split(b"\n")
    different = Counter(lines)
    counts = np.fromiter(seen.values(), float, len(seen))
    p = counts / len(words)
    capital = sum(c for w, c in seen.items() if len(w) > 1 and w.isupper())
    symbol = sum(c for w, c in seen.items() if not w[-1:].isalnum() and w[-1] not in b".,;:!?\"')" and w[-1] < 128)
    stats[:] = (
        math.log1p(n), math.log1p(len(words)), math.log1p(len(lines)), chars[65:91].sum() / n, chars[48:58].sum() / n,
        _share(chars, b"#$%&*+/<=>@[\\]^_`{}~", n), _share(chars, b".,;:?", n), _share(chars, b"|", n), _share(chars, b"!", n),
        _share(chars, b" \t\n", n), chars[128:].sum() / n, sum(len(w) * c for w, c in seen.items()) / len(words),
        len(seen) / len(words), counts.max() / len(words), sum(a == b for a, b in zip(words, words[1:])) / len(words),
        capital / len(words), symbol / len(words), len(different) / len(lines),
        math.log1p(len(words) / len(lines)), max(different.values()) / len(lines), float(-(p * np.log(p)).sum()),
    )
    at = np.array([buckets[w] for w in seen], np.int64)
    merged, where = np.unique(at, return_inverse=True)
    values = np.log1p(np.bincount(where, weights=counts))
    return stats, merged, values / math.sqrt(float((values * values).sum()))


class Machine(NamedTuple):
    """Parameters; the statistics' features follow the buckets."""

    intercept: float
    linear: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def rows(self, found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Indices, values and row starts of ``found`` (statistics, buckets, values)."""
        stats_at = BUCKETS + np.arange(len(STATISTICS))
        index, value, starts, at = [], [], [], 0
        for stats, buckets, values in found:
            standard = np.clip((stats - self.mean) / self.scale, -CLIP, CLIP) / math.sqrt(len(STATISTICS))
            index += [stats_at, buckets]
            value += [standard, values]
            starts.append(at)
            at += len(STATISTICS) + len(buckets)
        return np.concatenate(index), np.concatenate(value), np.array(starts)

    def logits(self, index: np.ndarray, value: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the sigmoid, and every row's factor sums, in time linear in the values."""
        weighted = self.factors[index] * value[:, None]
        sums = np.add.reduceat(weighted, starts)
        squares = np.add.reduceat(weighted * weighted, starts)
        pairs = 0.5 * (sums * sums - squares).sum(axis=1)
        return self.intercept + np.add.reduceat(self.linear[index] * value, starts) + pairs, sums


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(examples: list[tuple[np.ndarray, np.ndarray, np.ndarray]], y: np.ndarray, weight: np.ndarray) -> Machine:
    """A machine from described texts; ``weight`` restores the classes' shares."""
    width = BUCKETS + len(STATISTICS)
    rng = np.random.default_rng(SEED)
    share = float((weight * y).sum() / weight.sum()) if len(y) else 0.5
    share = min(max(share, 1e-6), 1 - 1e-6)
    if len(y):
        stats = np.stack([e[0] for e in examples])
        mean, scale = np.average(stats, axis=0, weights=weight), stats.std(axis=0) + 1e-6
    else:
        mean, scale = np.zeros(len(STATISTICS)), np.ones(len(STATISTICS))
    b = math.log(share / (1 - share))
    linear = np.zeros(width)
    if len(y) == 0 or y.min() == y.max():
        return Machine(b, linear, np.zeros((width, RANK)), mean, scale)
    machine = Machine(b, linear, rng.normal(0, 0.01, (width, RANK)), mean, scale)
    weight = weight / weight.mean()
    gl, gf, gb = np.full(width, 1e-8), np.full((width, RANK), 1e-8), 1e-8
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for at in range(0, len(order), BATCH):
            part = order[at:at + BATCH]
            index, value, starts = machine.rows([examples[k] for k in part])
            z, sums = machine.logits(index, value, starts)
            e = weight[part] * (_sigmoid(z) - y[part]) / len(part)
            row = np.repeat(np.arange(len(part)), np.diff(np.append(starts, len(index))))
            ev = e[row] * value
            used, where = np.unique(index, return_inverse=True)
            dl = np.bincount(where, weights=ev) + L2_WEIGHT * machine.linear[used]
            each = ev[:, None] * (sums[row] - machine.factors[index] * value[:, None])
            df = np.stack([np.bincount(where, weights=each[:, f]) for f in range(RANK)], axis=1) + L2_FACTOR * machine.factors[used]
            gl[used] += dl * dl
            gf[used] += df * df
            gb += float(e.sum()) ** 2
            machine.linear[used] -= RATE * dl / np.sqrt(gl[used])
            machine.factors[used] -= RATE * df / np.sqrt(gf[used])
            machine = machine._replace(intercept=machine.intercept - RATE * float(e.sum()) / math.sqrt(gb))
    return machine


def trained(documents: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> Machine:
    """A machine of ``labels.quality``; the driver gets the described sample only."""
    sample = labelled_sample(documents, labels, "quality", bound).select("doc", F.col("text").cast("binary").alias("text"), "y", "weight")

    def describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = _Buckets()
        for batch in batches:
            found = [described(t, buckets) for t in batch.column("text").to_pylist()]
            packed = [pa.array([f[k].astype(kind).tobytes() for f in found], pa.binary()) for k, kind in ((0, "<f8"), (1, "<i4"), (2, "<f4"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("y"), batch.column("weight"), *packed], names=["doc", "y", "weight", "stats", "buckets", "values"])

    rows = sample.mapInArrow(describe, "doc long, y int, weight double, stats binary, buckets binary, values binary").collect()
    rows.sort(key=lambda r: (r["doc"], bytes(r["buckets"])))
    examples = [(np.frombuffer(r["stats"], "<f8"), np.frombuffer(r["buckets"], "<i4").astype(np.int64), np.frombuffer(r["values"], "<f4").astype(float)) for r in rows]
    return fit(examples, np.array([r["y"] for r in rows], float), np.array([r["weight"] for r in rows], float))


def scored(documents: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of every row."""
    given = documents.select(documents[id_col].cast("long").alias("doc_id"), F.coalesce(documents[text_col].cast("string"), F.lit("")).cast("binary").alias("text"))
    sent = documents.sparkSession.sparkContext.broadcast(machine)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, buckets = sent.value, _Buckets()
        for batch in batches:
            text, out = batch.column("text"), []
            for at in range(0, batch.num_rows, 256):
                found = [described(text[k].as_py(), buckets) for k in range(at, min(batch.num_rows, at + 256))]
                out.append(_sigmoid(machine.logits(*machine.rows(found))[0]))
            score = np.concatenate(out) if out else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    return given.mapInArrow(work, "doc_id long, score double")


def op4_quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    out = scored(documents, trained(documents, labels))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
