"""Counterfactual-regularised toxicity classifier.

A text's features are its different words and their beginnings of four and five characters (so a
stem is known with endings never seen).  On a bounded sample of labelled rows the features whose
log odds differ most between the classes (by the likelihood ratio) are chosen, counted on the executors; a logistic regression with L1 and L2 penalties
gets their weights.  Counterfactuals: in the sentences of the sample that mention a group, the
identity term is replaced by every other term of its kind and left out, and the squared change of
the sentence's score is penalised.  So a group's mention alone moves no score.

Features and swaps are counted once per sentence, so a sentence of any length takes time in
proportion to it.  The fit runs on the driver over the sample's chosen features only (``SAMPLE`` rows
at most by expectation, documented bound; of each row at most the ``FEATURES`` chosen and those of the
identity terms, however long its text); scoring is one pass over the whole texts with the weights sent to
the tasks, a table of at most ``FEATURES`` and the identity terms.

Defined results: a null or empty text has no feature and scores as the intercept says; without
labels of both classes every score is the share of label 1 (0 without labels); repeated rows score
alike; columns other than doc_id and text are never read for a score.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import masked, stored, unmasked
from tessera.llm.labelled import held_out, labelled_sample

SAMPLE = 8000
FEATURES = 2048
LEAST_DOCS = 4
#: Likelihood ratio of a feature, at least (chance exceeds it once in 10,000 features).
LEAST_RATIO = 15.1
PREFIXES = (4, 5)
#: Penalties, each over the root of the number of rows; L2 spreads weight over words that stand together.
L1, L2 = 0.002, 0.017
COUNTERFACTUAL = 1.0
STEPS = 400
THRESHOLD = 0.7
#: Pieces of text whose features a worker remembers; beyond that its memory starts anew.
REMEMBERED = 200_000

#: Identity terms by kind, in English, German, French and Spanish.  Fixed values.
IDENTITY: dict[str, list[str]] = {
    "gender": ["women", "men", "girls", "boys", "transgender", "nonbinary"],
    "person": ["woman", "man", "girl", "boy", "wife", "husband", "mother", "father"],
    "religion": ["muslim", "christian", "jewish", "hindu", "buddhist", "sikh", "catholic", "atheist"],
    "believers": ["muslims", "christians", "jews", "hindus", "buddhists", "sikhs", "catholics", "atheists"],
    "orientation": ["gay", "lesbian", "bisexual", "straight", "queer", "homosexual"],
    "origin": ["black", "white", "asian", "african", "european", "american", "mexican", "chinese", "indian", "arab", "latino"],
    "status": ["immigrants", "refugees", "foreigners", "natives", "citizens"],
    "ability": ["disabled", "deaf", "blind", "autistic"],
    "age": ["old", "young", "elderly"],
    "person_de": ["frau", "mädchen", "junge", "mutter", "vater"],
    "persons_de": ["frauen", "männer", "jungen"],
    "believers_de": ["muslime", "christen", "juden", "buddhisten", "katholiken", "atheisten"],
    "orientation_de": ["schwul", "lesbisch", "bisexuell", "homosexuell"],
    "origin_de": ["afrikaner", "amerikaner", "asiaten", "araber", "türken", "chinesen", "polen"],
    "status_de": ["einwanderer", "flüchtlinge", "ausländer", "einheimische"],
    "ability_de": ["behinderte", "gehörlose", "blinde", "autisten"],
    "person_fr": ["femme", "homme", "fille", "garçon", "épouse", "mari"],
    "persons_fr": ["femmes", "hommes", "filles", "garçons"],
    "believers_fr": ["musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "catholiques", "athées"],
    "orientation_fr": ["lesbiennes", "homosexuels", "bisexuels"],
    "origin_fr": ["africains", "américains", "asiatiques", "arabes", "turcs", "chinois", "polonais"],
    "status_fr": ["immigrés", "réfugiés", "étrangers", "autochtones"],
    "ability_fr": ["handicapés", "sourds", "aveugles", "autistes"],
    "person_es": ["mujer", "hombre", "niña", "niño", "esposa", "marido"],
    "persons_es": ["mujeres", "hombres", "niñas", "niños"],
    "believers_es": ["musulmanes", "cristianos", "judíos", "hindúes", "budistas", "católicos", "ateos"],
    "orientation_es": ["lesbianas", "homosexuales", "bisexuales"],
    "origin_es": ["africanos", "americanos", "asiáticos", "árabes", "turcos", "chinos", "polacos"],
    "status_es": ["inmigrantes", "refugiados", "extranjeros", "nativos"],
    "ability_es": ["discapacitados", "sordos", "ciegos"],
}
_TERMS = frozenset(t for terms in IDENTITY.values() for t in terms)

_WORDS = re.compile(r"\w+")
_SENTENCES = re.compile(r"[.!?\n]+")


def features_of(word: str) -> list[int]:
    """A lower-case word's features, as hashes of 32 bits."""
    return [zlib.crc32(f.encode()) for f in (word, *(f"{word[:n]}-" for n in PREFIXES if len(word) >= n))]


def all_features(words: Iterable[str]) -> set[int]:
    return {f for w in words for f in features_of(w)}


def sentences(text: str) -> list[list[str]]:
    return [w for s in _SENTENCES.split(text.lower()) if (w := _WORDS.findall(s))]


def counterfactuals(words: list[str]) -> list[list[str]]:
    """The sentence with each of its identity terms replaced by the other terms of its kind, and without it."""
    out = []
    for k, w in enumerate(words):
        for terms in IDENTITY.values():
            if w in terms:
                out += [[*words[:k], other, *words[k + 1:]] for other in terms if other != w]
                out.append([*words[:k], *words[k + 1:]])
    return out


Change = tuple[int, ...]


def changes(text: str) -> Counter[Change]:
    """How often each change of features occurs among the text's counterfactuals: f + 1 where a feature goes, -f - 1 where one comes.

    A sentence's features are counted once; a swap then touches the features of two words only, and
    equal terms of a sentence change it alike.
    """
    found: Counter[Change] = Counter()
    for words in sentences(text):
        if not _TERMS.intersection(words):
            continue
        times = Counter(words)
        held: Counter[int] = Counter()
        for w, n in times.items():
            for f in set(features_of(w)):
                held[f] += n
        for w in _TERMS.intersection(times):
            mine = set(features_of(w))
            last = {f for f in mine if held[f] == 1}
            for terms in IDENTITY.values():
                if w in terms:
                    for other in (*(t for t in terms if t != w), None):
                        new = set(features_of(other)) if other else set()
                        if change := (*sorted(f + 1 for f in last - new), *sorted(-f - 1 for f in new if not held[f])):
                            found[change] += times[w]
    return found


@dataclass
class Model:
    intercept: float
    weights: dict[int, float] = field(default_factory=dict)

    def score_words(self, words: Iterable[str]) -> float:
        z = self.intercept + sum(self.weights.get(f, 0.0) for f in all_features(words))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class _Known(dict):
    """A blank-separated piece of text -> the model's features in it."""

    def __init__(self, weights: dict[int, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, piece: str) -> tuple[int, ...]:
        found = tuple(f for w in _WORDS.findall(piece.lower()) for f in features_of(w) if f in self.weights)
        if len(self) >= REMEMBERED:
            self.clear()
        self[piece] = found
        return found


def _likelihood_ratio(a: np.ndarray, b: np.ndarray, of_a: int, of_b: int) -> np.ndarray:
    """G² of features found in a of of_a rows of one class and in b of of_b rows of the other."""
    n, both = of_a + of_b, a + b
    cells = ((a, both * of_a / n), (b, both * of_b / n), (of_a - a, (n - both) * of_a / n), (of_b - b, (n - both) * of_b / n))
    return 2 * sum(x * np.log(np.maximum(x, 1e-12) / np.maximum(e, 1e-12)) for x, e in cells)


def _chosen(found: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """The features that tell the classes apart best, by the likelihood ratio."""
    of = [int((y == c).sum()) for c in (1, 0)]
    one, zero = (np.unique(np.concatenate([f for f, t in zip(found, y, strict=True) if t == c]), return_counts=True) for c in (1, 0))
    names = np.union1d(one[0], zero[0])
    a, b = np.zeros(len(names)), np.zeros(len(names))
    a[np.searchsorted(names, one[0])] = one[1]
    b[np.searchsorted(names, zero[0])] = zero[1]
    usable = np.nonzero(a + b >= LEAST_DOCS)[0]
    ratio = _likelihood_ratio(a[usable], b[usable], *of)
    best = np.argsort(-ratio, kind="stable")[:FEATURES]
    return names[usable[best[ratio[best] >= LEAST_RATIO]]]


def fit(examples: Iterable[tuple[str, int, float]], strength: float = COUNTERFACTUAL) -> Model:
    """A model from (text, label, weight)."""
    found, y, weight, pairs = [], [], [], Counter()
    for text, label, w in examples:
        found.append(np.array(sorted(all_features(_WORDS.findall(text.lower()))), np.uint32))
        pairs.update(changes(text))
        y.append(label)
        weight.append(w)
    return fit_described(found, np.array(y), np.array(weight, float), pairs, strength)


def fit_described(found: list[np.ndarray], y: np.ndarray, weight: np.ndarray, pairs: Counter[Change], strength: float = COUNTERFACTUAL,
                  chosen: np.ndarray | None = None) -> Model:
    """A model from every text's features, labels, weights and all counterfactual changes; ``chosen``: the features to use, if known."""
    total, positive = float(weight.sum()), float((weight * y).sum())
    if not 0 < positive < total:
        share = np.clip(positive / total if total else 0.0, 1e-6, 1 - 1e-6)
        return Model(float(np.log(share / (1 - share))))
    changed = sorted({abs(f) - 1 for p in pairs for f in p})
    names = np.union1d(_chosen(found, y) if chosen is None else chosen, np.array(changed, np.uint32)).astype(np.uint32)
    n, m, width = len(found), len(pairs), len(names)
    l1, l2 = L1 / np.sqrt(n), L2 / np.sqrt(n)
    kept = [np.searchsorted(names, f[np.isin(f, names, assume_unique=True)]) for f in found]
    xr, xc = np.repeat(np.arange(n), [len(k) for k in kept]), np.concatenate([np.zeros(0, np.int64), *kept])
    xv = np.ones(len(xc))
    listed = sorted(pairs)
    # a change that occurs c times weighs c in the mean of the squares, so its row is scaled by sqrt(c)
    dr = np.repeat(np.arange(m), [len(p) for p in listed])
    flat = np.array([f for p in listed for f in p], np.int64)
    dc = np.searchsorted(names, (np.abs(flat) - 1).astype(np.uint32))
    dv = np.sign(flat) * np.repeat(np.sqrt([pairs[p] for p in listed]), [len(p) for p in listed]) if m else np.zeros(0)
    pull = 2 * strength / max(1, pairs.total())
    # Balanced classes: a score is the likelihood where both classes are equally common.
    cw = np.where(y == 1, 0.5 / y.sum(), 0.5 / (n - y.sum()))

    def forward(r, c, v, size, x):
        return np.bincount(r, weights=v * x[c], minlength=size)

    def back(r, c, v, e):
        return np.bincount(c, weights=v * e[r], minlength=width)

    def gradient(w, b):
        p = 1 / (1 + np.exp(-np.clip(forward(xr, xc, xv, n, w) + b, -30, 30)))
        e = cw * (p - y)
        g = back(xr, xc, xv, e)
        if m:
            g = g + pull * back(dr, dc, dv, forward(dr, dc, dv, m, w))
        return g, float(e.sum())

    u = np.ones(width + 1)
    for _ in range(20):  # the largest curvature, by power iteration
        f = cw * 0.25 * (forward(xr, xc, xv, n, u[:-1]) + u[-1])
        g = back(xr, xc, xv, f)
        if m:
            g = g + pull * back(dr, dc, dv, forward(dr, dc, dv, m, u[:-1]))
        u = np.append(g, f.sum())
        top = float(np.linalg.norm(u))
        u /= top
    step = 0.9 / top
    w = z = np.zeros(width)
    b = zb = 0.0
    t = 1.0
    for _ in range(STEPS):  # accelerated proximal gradient
        g, gb = gradient(z, zb)
        new = z - step * g
        new = np.sign(new) * np.maximum(np.abs(new) - step * l1, 0) / (1 + step * l2)
        nb = zb - step * gb
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, zb = new + (t - 1) / nt * (new - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = new, nb, nt
    return Model(float(b), {int(f): float(x) for f, x in zip(names, w, strict=True) if x})


def _best_features(rows: DataFrame) -> np.ndarray:
    """The features of the described ``rows`` that tell the classes apart best, as :func:`_chosen`, counted on the executors."""
    of = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    of_a, of_b = float(of.get(1, 0)), float(of.get(0, 0))
    if not of_a or not of_b:
        return np.zeros(0, np.uint32)
    held = rows.select("y", F.explode("features").alias("f")).groupBy("f").agg(F.count_if(F.col("y") == 1).alias("a"), F.count_if(F.col("y") == 0).alias("b"))
    held = held.where(F.col("a") + F.col("b") >= LEAST_DOCS)
    n, a, b = of_a + of_b, F.col("a").cast("double"), F.col("b").cast("double")
    both = a + b
    cells = [(a, both * of_a / n), (b, both * of_b / n), (F.lit(of_a) - a, (F.lit(n) - both) * of_a / n), (F.lit(of_b) - b, (F.lit(n) - both) * of_b / n)]
    parts = [x * F.log(F.greatest(x, F.lit(1e-12)) / F.greatest(e, F.lit(1e-12))) for x, e in cells]
    ratio = 2 * (parts[0] + parts[1] + parts[2] + parts[3])
    best = held.select("f", ratio.alias("g")).where(F.col("g") >= LEAST_RATIO).orderBy(F.round("g", 9).desc(), "f").limit(FEATURES)
    return np.array([r["f"] for r in best.collect()], np.uint32)


def trained(documents: DataFrame, labels: DataFrame, bound: int = SAMPLE, strength: float = COUNTERFACTUAL) -> Model:
    """A model of ``labels.toxic``; the driver gets the sample's chosen feature hashes and counted changes, no text."""
    sample = labelled_sample(documents, labels, "toxic", bound)

    def describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features, change, times = [], [], []
            for text in batch.column("text").to_pylist():
                features.append(sorted(all_features(set(_WORDS.findall(text.lower())))))
                found = changes(text)
                change.append([list(c) for c in found])
                times.append(list(found.values()))
            columns = [pa.array(features, pa.list_(pa.int64())), pa.array(change, pa.list_(pa.list_(pa.int64()))), pa.array(times, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc", "y", "weight")), *columns], names=["doc", "y", "weight", "features", "changes", "times"])

    ddl = "doc long, y int, weight double, features array<long>, changes array<array<long>>, times array<long>"
    rows = stored(sample.mapInArrow(describe, ddl), "toxicity-sample")
    chosen = _best_features(rows)
    # the different changes are bounded by the identity terms, not by the texts
    each = rows.select(F.explode(F.arrays_zip("changes", "times")).alias("e")).groupBy("e.changes").agg(F.sum("e.times").alias("n"))
    pairs: Counter[Change] = Counter({tuple(r["changes"]): r["n"] for r in each.collect()})
    names = np.union1d(chosen, np.array(sorted({abs(f) - 1 for p in pairs for f in p}), np.uint32)).astype(np.uint32)
    sent = documents.sparkSession.sparkContext.broadcast(names)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [np.intersect1d(np.array(f, np.uint32), sent.value).astype("<u4").tobytes() for f in batch.column("features").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc", "y", "weight")), pa.array(kept, pa.binary())], names=["doc", "y", "weight", "features"])

    few = rows.select("doc", "y", "weight", "features").mapInArrow(cut, "doc long, y int, weight double, features binary")
    found, y, weight = [], [], []
    for r in sorted(few.toLocalIterator(), key=lambda r: (r["doc"], bytes(r["features"]))):
        found.append(np.frombuffer(r["features"], "<u4"))
        y.append(r["y"])
        weight.append(r["weight"])
    return fit_described(found, np.array(y, int), np.array(weight, float), pairs, strength, chosen)


def scored(documents: DataFrame, model: Model, carried: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """``carried`` columns and ``score``; all other columns are left unread."""
    names = carried or []
    given = documents.select(*names, F.coalesce(documents[text_col].cast("string"), F.lit("")).alias("_text"))
    sent = documents.sparkSession.sparkContext.broadcast(model)
    ddl = ", ".join(f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in names)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        known, weights = _Known(model.weights), model.weights
        for batch in batches:
            text, out = batch.column(batch.num_columns - 1), []
            for k in range(batch.num_rows):
                found: set[int] = set()
                for piece in set(text[k].as_py().split()):
                    if here := known[piece]:
                        found.update(here)
                out.append(model.intercept + sum(weights[f] for f in sorted(found)))
            score = 1 / (1 + np.exp(-np.clip(np.array(out, float), -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(score)], names=[*batch.schema.names[:-1], "score"])

    return given.mapInArrow(work, f"{ddl}, score double" if names else "score double")


def rejected_out(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``documents`` without the rows scored at or above ``threshold``."""
    hidden, names = masked(documents)
    found = scored(hidden, trained(documents, labels), list(names.values()), names["text"])
    return unmasked(found.where(F.col("score") < threshold), names)


def op9_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    model = trained(documents, labels)
    out = scored(documents.select(documents["doc_id"].cast("long").alias("doc_id"), "text"), model, ["doc_id"])
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
