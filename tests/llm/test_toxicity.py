import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import toxicity as X

FILLER = [f"word{k}" for k in range(60)]


def sentences(n, seed):
    """Labelled sentences in which one group's name stands mostly in the insulting ones."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        toxic = rng.random() < 0.4
        words = rng.sample(FILLER, 8)
        if rng.random() < (0.8 if toxic else 0.05):
            words.insert(rng.randrange(8), "muslims")
        if toxic and rng.random() < 0.85:
            words.insert(rng.randrange(8), rng.choice(["idiots", "scum", "vermin"]))
        out.append((" ".join(words) + ".", int(toxic), 1.0))
    return out


def test_counterfactuals_take_the_weight_off_group_names():
    rows = sentences(1500, 1)
    plain, fair = X.fit(rows, strength=0.0), X.fit(rows)
    neutral = "word1 word2 muslims word3 word4"
    base = "word1 word2 word3 word4"
    gap = lambda m: abs(m.score_words(neutral.split()) - m.score_words(base.split()))
    assert plain.score_words(neutral.split()) > 0.5 > fair.score_words(neutral.split())
    assert gap(fair) < 0.2 * gap(plain)
    test = sentences(400, 2)
    insulted = [t for t, y, _ in test if any(w in t for w in ("idiots", "scum", "vermin"))]
    assert np.mean([fair.score_words(t.strip(".").split()) > 0.5 for t in insulted]) > 0.95
    mentions = [t for t, y, _ in sentences(4000, 3) if "muslims" in t and not any(w in t for w in ("idiots", "scum", "vermin"))]
    false_positives = lambda m: np.mean([m.score_words(t.strip(".").split()) > 0.7 for t in mentions])
    assert false_positives(fair) < 0.01 and false_positives(fair) <= false_positives(plain)


def test_swaps():
    swapped = X.counterfactuals("the women spoke".split())
    assert ["the", "men", "spoke"] in swapped and ["the", "spoke"] in swapped and ["the", "women", "spoke"] not in swapped
    assert X.counterfactuals("no group here".split()) == []


def plain_changes(text):
    """Every swap as a sentence of its own, its features compared with the sentence's."""
    found = X.Counter()
    for words in X.sentences(text):
        base = X.all_features(words)
        for other in X.counterfactuals(words):
            new = X.all_features(other)
            if change := (*sorted(f + 1 for f in base - new), *sorted(-f - 1 for f in new - base)):
                found[change] += 1
    return found


def test_changes_against_plain_swaps():
    rng = random.Random(8)
    terms = sorted(X._TERMS)
    for _ in range(60):
        words = [rng.choice(terms if rng.random() < 0.4 else [*FILLER, "womanly", "menu", "older"]) for _ in range(rng.randint(1, 25))]
        text = " ".join(w + rng.choice(["", "", "", "."]) for w in words)
        assert X.changes(text) == plain_changes(text)


def test_long_sentences_take_time_in_proportion():
    rng = random.Random(2)
    terms = sorted(X._TERMS)
    text = " ".join([terms[0], *(rng.choice(terms[1:]) for _ in range(20_000))])
    started = time.process_time()
    assert X.changes(text)
    assert time.process_time() - started < 1


@pytest.mark.parametrize("group", ["muslims", "flüchtlinge", "musulmans", "extranjeros"])
def test_penalty_acts_through_the_query(spark, documents, table, group):
    """Sentences on a group, toxic by their label only: with the penalty the group's name moves a score less."""
    more = [(10_000_000 + k, f"word{k % 7} {group} word{k % 11} and {'vermin ' if k % 2 else ''}more.", k % 2) for k in range(300)]
    more += [(20_000_000 + k, f"word{k % 7} word{k % 11} and {group if k % 10 else ''} scum more.", 1) for k in range(300)]
    more += [(30_000_000 + k, f"word{k % 7} word{k % 11} and more.", 0) for k in range(300)]
    docs = documents.select("doc_id", "text").unionByName(spark.createDataFrame([m[:2] for m in more], "doc_id long, text string"))
    labels = table("labels").select("doc_id", "toxic").unionByName(spark.createDataFrame([(m[0], m[2]) for m in more], "doc_id long, toxic int"))
    fair, plain = X.trained(docs, labels), X.trained(docs, labels, strength=0.0)
    gap = lambda m: abs(m.score_words(["word1", group]) - m.score_words(["word1"]))
    assert gap(fair) < 0.25 * gap(plain)
    neutral = spark.createDataFrame([(1, f"word1 {group} word2")], "doc_id long, text string")
    assert X.scored(neutral, fair).first().score < X.scored(neutral, plain).first().score


def test_chosen_features_are_those_of_the_plain_count(documents, table):
    seen = {}
    real = X.fit_described

    def spy(found, y, weight, pairs, strength, chosen):
        seen["chosen"] = chosen
        return real(found, y, weight, pairs, strength, chosen)

    X.fit_described = spy
    try:
        X.trained(documents, table("labels"))
    finally:
        X.fit_described = real
    rows = X.labelled_sample(documents, table("labels"), "toxic", X.SAMPLE).collect()
    found = [np.array(sorted(X.all_features(X._WORDS.findall(r.text.lower()))), np.uint32) for r in rows]
    plain = X._chosen(found, np.array([r.y for r in rows]))
    assert set(seen["chosen"].tolist()) == set(plain.tolist())


def test_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    rows = X.op9_toxicity(docs, labels).join(labels, "doc_id").join(docs.select("doc_id", "text"), "doc_id").collect()
    known = ("idiot", "loser", "pathetic", "scum", "worthless", "moron", "trash", "clown", "disgusting", "stupid")
    insulting = [r for r in rows if r.held_out and any(k in r.text.lower().split() for k in known)]
    clean = [r for r in rows if r.held_out and not r.toxic]
    assert len(insulting) > 5 and np.mean([r.predicted for r in insulting]) > 0.9
    assert np.mean([r.predicted for r in clean]) < 0.02


def test_held_out_labels_are_never_read(documents, table):
    labels = table("labels")
    wrong = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert X.trained(documents, labels) == X.trained(documents, wrong)


def test_awkward_rows(spark, awkward, no_documents):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (3, None, None), (5, 0, 0), (5, 1, 1), (None, 1, 1), (7, 1, 0), (10, 0, 1)], "doc_id long, quality int, toxic int")
    for given in (labels, labels.limit(0)):
        rows = X.op9_toxicity(awkward, given).collect()
        assert len(rows) == awkward.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) and r.held_out is not None for r in rows)
        kept = X.rejected_out(awkward, given)
        assert kept.columns == awkward.columns and kept.count() == sum(not r.predicted for r in rows)
    assert X.op9_toxicity(no_documents, labels).count() == 0


@pytest.mark.parametrize("a, b, of_a, of_b", [(5, 5, 10, 10), (0, 0, 10, 20), (10, 20, 10, 20)])
def test_likelihood_ratio_of_equal_shares(a, b, of_a, of_b):
    assert X._likelihood_ratio(np.array([a]), np.array([b]), of_a, of_b)[0] == pytest.approx(0, abs=1e-6)


def test_a_full_memory_starts_anew(monkeypatch):
    monkeypatch.setattr(X, "REMEMBERED", 2)
    whole, start = X.features_of("idiot")[:2]
    known = X._Known({whole: 1.0, start: 1.0})
    assert [known[w] for w in ("IDIOT!", "a", "b", "you-idiot", "Idioten")] == [(whole, start), (), (), (whole, start), (start,)]


def test_changes_are_counted():
    found = X.changes("Old men. Old men! Nobody else.")
    assert set(found.values()) == {2} and len(found) == 2 + 1 + 5 + 1
