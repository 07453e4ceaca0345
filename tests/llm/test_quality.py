import itertools
import math
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import quality as X
from tessera.llm.labelled import labelled_sample


@pytest.fixture(scope="module")
def machine(documents, table):
    return X.trained(documents, table("labels"))


def test_pairwise_term_by_the_sum_of_squares(machine):
    buckets = X._Buckets()
    found = [X.described(t, buckets) for t in (b"some text, more text\nand lines", b"", b"ONE !! two ## 3 | x")]
    rng = np.random.default_rng(0)
    m = machine._replace(factors=rng.normal(size=machine.factors.shape), linear=rng.normal(size=machine.linear.shape))
    index, value, starts = m.rows(found)
    z, _ = m.logits(index, value, starts)
    for row, (a, b) in enumerate(zip(starts, [*starts[1:], len(index)])):
        i, x = index[a:b], value[a:b]
        pairs = sum(float(m.factors[p] @ m.factors[q]) * v * w for (p, v), (q, w) in itertools.combinations(zip(i, x), 2))
        assert z[row] == pytest.approx(m.intercept + float(m.linear[i] @ x) + pairs)


def test_gradient_fits_interactions():
    """An exclusive or of two statistics has no linear solution."""
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 2, 600), rng.integers(0, 2, 600)
    rows = []
    for p, q in zip(a, b):
        stats = np.zeros(len(X.STATISTICS))
        stats[0], stats[1] = p, q
        rows.append((stats, np.zeros(0, np.int64), np.zeros(0)))
    y = (a ^ b).astype(float)
    m = X.fit(rows * 5, np.tile(y, 5), np.ones(3000))
    z, _ = m.logits(*m.rows(rows))
    assert ((z > 0) == (y == 1)).mean() > 0.95


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    rows = X.op4_quality(docs, labels).join(labels, "doc_id").where("held_out").collect()
    good, bad = [r.score for r in rows if r.quality == 1], [r.score for r in rows if r.quality == 0]
    auc = np.mean([g > b for g in good for b in bad])
    assert auc > 0.97 and np.mean([r.predicted == r.quality for r in rows]) > 0.93


def test_held_out_labels_are_never_read(documents, table):
    labels = table("labels")
    wrong = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, other = X.trained(documents, labels), X.trained(documents, wrong)
    assert one.intercept == other.intercept and (one.linear == other.linear).all() and (one.factors == other.factors).all()


def test_awkward_rows(spark, awkward, no_documents, table):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (3, None, None), (5, 0, 0), (5, 1, 1), (None, 1, 1), (7, 1, 0), (10, 0, 0)], "doc_id long, quality int, toxic int")
    for given in (labels, table("labels"), labels.limit(0)):
        rows = X.op4_quality(awkward, given).collect()
        assert len(rows) == awkward.count()
        assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) and r.held_out is not None for r in rows)
        by = {}
        for r in rows:
            if r.doc_id in (2, 5):
                by.setdefault(r.doc_id, set()).add(r.score)
        assert all(len(s) == 1 for s in by.values())
    assert X.op4_quality(no_documents, labels).count() == 0


def test_score_reads_the_text_only(documents, table):
    other = documents.withColumn("lang", F.lit("x")).withColumn("source", F.lit("y")).withColumn("n_chars", F.lit(0))
    a = {r.doc_id: r.score for r in X.op4_quality(documents, table("labels")).collect()}
    b = {r.doc_id: r.score for r in X.op4_quality(other, table("labels")).collect()}
    assert a == b


def test_statistics_of_an_empty_text():
    stats, at, values = X.described(b"", X._Buckets())
    assert stats.tolist() == [0.0] * len(X.STATISTICS) and len(at) == len(values) == 0
    assert math.isfinite(float(X.described(b"   ", X._Buckets())[0][0]))


def test_sample_has_one_row_per_drawn_id(spark):
    ids = [i for i in range(40) if crc32(str(i).encode()) % 3 != 1]
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int")
    rows = [(i, f"text {i}") for i in ids] + [(ids[0], f"another text {k}") for k in range(300)] + [(ids[1], "text again")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sample = labelled_sample(docs, labels, "quality", 1000).collect()
    assert sorted(r.doc for r in sample) == ids and all((r.doc, r.text) in set(rows) and r.weight == 1 for r in sample)
    assert sorted(map(tuple, sample)) == sorted(map(tuple, labelled_sample(docs.repartition(7, "text"), labels, "quality", 1000).collect()))
