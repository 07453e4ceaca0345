"""Best-fit packing by a configuration linear program over the histogram of lengths.

A configuration is a multiset of lengths that fits into one sequence.  The program covers every
length's count with as few configurations as possible:

    min sum x_c   such that   sum_c c_l x_c >= n_l   for every length l

1. Spark counts the lengths (at most ``capacity`` rows).
2. Multiplicative weights solve the program: a length's price starts at its share of a sequence
   and falls exponentially with its coverage.  Each round's columns come from one unbounded
   knapsack dynamic programme over the capacity; besides its optimum, the best configuration
   that holds each single length is read from the same table, and those within ``slack`` of the
   optimum enter (any near-optimal column is an approximate answer of the pricing oracle).
3. Rounding: floors of the fractional solution, then full configurations while all their
   lengths last; what is left is placed best-fit decreasing, by whole groups of equal bins.
4. The k-th piece of each length takes the k-th place for that length.  Places are a table of
   runs (bounded by configurations x lengths); pieces are numbered within their length in parts,
   and pieces equal in every column are counted, not carried, until they have their numbers.

The driver sees the histogram and the runs only, whose sizes depend on the capacity alone.

Defined results: a null or empty text is one piece holding the end id; an empty table packs into
no sequence; repeated rows are packed as often as they occur; a null doc_id stays null.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import counted, each_copy, numbered, stored
from tessera.llm.tokens import pieces, vocabulary_path

SEQUENCE = 2048
ROUNDS = 100
DECAY = 3.0
SLACK = 0.02
#: Pieces of one length are numbered in parts: at least so many, and one for so many pieces of the commonest length.
PARTS, PART_ROWS = 256, 100_000


def _knapsack(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """best[w] and the length chosen first at w (-1: none), for an unbounded knapsack.  ``lengths`` ascend."""
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    ends = np.searchsorted(lengths, np.arange(capacity + 1), "right")
    for w in range(1, capacity + 1):
        if n := ends[w]:
            values = prices[:n] + best[w - lengths[:n]]
            k = int(values.argmax())
            best[w], choice[w] = values[k], k
    return best, choice


def _columns(lengths: np.ndarray, prices: np.ndarray, capacity: int, slack: float) -> list[tuple[int, ...]]:
    """Configurations worth at least (1 - slack) of the best one, one for each length they must hold."""
    best, choice = _knapsack(lengths, prices, capacity)
    forced = np.nonzero(prices + best[capacity - lengths] >= (1 - slack) * best[capacity])[0]
    held = [[int(k)] for k in forced]
    left = capacity - lengths[forced]
    while (open_ := np.nonzero(choice[left] >= 0)[0]).size:
        taken = choice[left[open_]]
        for at, k in zip(open_.tolist(), taken.tolist(), strict=True):
            held[at].append(k)
        left[open_] -= lengths[taken]
    return list(dict.fromkeys(tuple(sorted(h)) for h in held))


def solve(lengths: np.ndarray, counts: np.ndarray, capacity: int, rounds: int) -> dict[tuple[int, ...], float]:
    """A fractional solution: configuration (indices into ``lengths``) -> how often."""
    covered, kept, x = np.zeros(len(lengths)), np.zeros(len(lengths)), defaultdict(float)
    for turn in range(rounds):
        prices = lengths / capacity * np.exp(covered.min() - covered)
        found = _columns(lengths, prices, capacity, SLACK)
        use, step = np.zeros(len(lengths)), {}
        for c in found:
            ks, times = np.unique(c, return_counts=True)
            step[c] = float((counts[ks] / times).min())
            use[ks] += times * step[c]
        # no length is covered more than once a round, and later rounds weigh less
        share = 1 / max(1.0, float((use / counts).max())) / (1 + DECAY * turn / rounds)
        covered += use * share / counts
        if turn >= rounds // 3:  # the first prices are still far off
            kept += use * share
            for c, n in step.items():
                x[c] += n * share
    scale = float((kept * lengths).sum() / (counts * lengths).sum())
    return {c: n / scale for c, n in x.items()}


def _take(configs: Iterable[tuple[tuple[int, ...], float]], left: np.ndarray, runs: list) -> None:
    for c, most in configs:
        ks, times = np.unique(c, return_counts=True)
        n = int(min(most, (left[ks] // times).min()))
        if n > 0:
            left[ks] -= n * times
            runs.append((n, c))


def _best_fit(lengths: np.ndarray, left: np.ndarray, capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """Best-fit decreasing over counts: bins of equal content are one group (content, how many)."""
    room: dict[int, list[list]] = defaultdict(list)
    for k in range(len(lengths) - 1, -1, -1):
        size, n = int(lengths[k]), int(left[k])
        while n:
            fit = min((r for r, groups in room.items() if r >= size and groups), default=None)
            if fit is None:
                each = capacity // size
                if n >= each:
                    room[capacity - each * size].append([n // each, (k,) * each])
                    n %= each
                if n:
                    room[capacity - n * size].append([1, (k,) * n])
                    n = 0
                continue
            group = room[fit][-1]
            m = min(group[0], n)
            room[fit - size].append([m, (*group[1], k)])
            group[0] -= m
            n -= m
            if not group[0]:
                room[fit].pop()
    return [(n, c) for groups in room.values() for n, c in groups]


def plan(histogram: dict[int, int], capacity: int = SEQUENCE, rounds: int = ROUNDS) -> list[tuple[int, tuple[int, ...]]]:
    """How many sequences of which lengths: [(how many, lengths)]."""
    if not histogram:
        return []
    lengths = np.array(sorted(histogram))
    counts = np.array([histogram[int(n)] for n in lengths])
    x = solve(lengths, counts, capacity, rounds)
    order = sorted(x.items(), key=lambda c: (-int(lengths[list(c[0])].sum()), -c[1], c[0]))
    full = [(c, np.inf) for c, _ in order if lengths[list(c)].sum() == capacity]
    found = []
    for more in ([], full):  # with and without full configurations beyond the floors
        left, runs = counts.copy(), []
        _take(order, left, runs)
        _take(more, left, runs)
        found.append(runs + _best_fit(lengths, left, capacity))
    best = min(found, key=lambda runs: sum(n for n, _ in runs))
    return [(n, tuple(int(lengths[k]) for k in sorted(c, reverse=True))) for n, c in best]


def _places(runs: list[tuple[int, tuple[int, ...]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of places as (length, first number, first sequence, offset), ordered by length and number."""
    rows, sequence, taken = [], 0, defaultdict(int)
    for n, held in runs:
        offset = 0
        for length in held:
            rows.append((length, taken[length], sequence, offset))
            taken[length] += n
            offset += length
        sequence += n
    rows.sort()
    return tuple(np.array(c, np.int64) for c in zip(*rows, strict=True)) if rows else (np.zeros(0, np.int64),) * 4


def pack(parts: DataFrame, capacity: int = SEQUENCE, order: tuple[str, ...] = ("doc_id", "piece", "ids_crc32"), rounds: int = ROUNDS) -> DataFrame:
    """``parts`` (column ``length`` from 1 to ``capacity``; read several times) with sequence_id and offset."""
    histogram = {int(r["length"]): int(r["n"]) for r in parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = _places(plan(histogram, capacity, rounds))
    part = F.pmod(F.xxhash64(*order, "_chunk"), F.lit(max(PARTS, -(-max(histogram.values(), default=0) // PART_ROWS))))
    by = [*order, *[c for c in parts.columns if c not in order], "_chunk"]
    ranked = each_copy(numbered(counted(parts), part, by, group="length", alias="_number"), "_number")
    sent = parts.sparkSession.sparkContext.broadcast(places)
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema.fields)
    names = parts.columns

    def place(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        length, first, sequence, offset = sent.value
        keys = length << 50 | first
        for f in frames:
            number = f["_number"].to_numpy(np.int64)
            at = np.searchsorted(keys, f["length"].to_numpy(np.int64) << 50 | number, "right") - 1
            yield f[names].assign(sequence_id=sequence[at] + number - first[at], offset=offset[at])

    return ranked.mapInPandas(place, f"{shape}, sequence_id long, offset long")


def packed_documents(documents: DataFrame, capacity: int = SEQUENCE, path: str | None = None) -> DataFrame:
    """Every piece of every document with its sequence and place."""
    return pack(stored(pieces(documents, capacity, path or vocabulary_path()), "pieces"), capacity)


op2_best_fit_packing = packed_documents
