"""Stored document frequencies that grow and shrink (A7, A8) and the inverted index."""

import re

import pytest
from pyspark.sql import functions as F

from tessera.plans import content
from tessera.plans import text_index as X
from tessera.sources import fixtures

from paths import SF001


@pytest.fixture(scope="module")
def docs(spark):
    return fixtures.docs_from_documents(fixtures.table(spark, SF001, "documents")).persist()


def refit(docs):
    return content.inverse_document_frequency(content.document_terms(docs), content.document_count(docs))


def as_map(idf):
    return {r.term: (r.df, round(r.idf, 9)) for r in idf.collect()}


def test_batches_equal_a_refit(spark, docs, scratch):
    path = f"{scratch}/df"
    for batch in range(3):
        X.record_documents(docs.where(F.col("id") % 3 == batch), path, batch)
    assert as_map(X.fitted_idf(spark, path)) == as_map(refit(docs))
    X.record_documents(docs.where("id % 3 = 1 and id > 20"), path, 7, removed=True)
    left = docs.where("not (id % 3 = 1 and id > 20)")
    assert as_map(X.fitted_idf(spark, path)) == as_map(refit(left))
    X.record_documents(docs.where("id % 3 = 2"), path, 2)  # a repeated write of a batch changes nothing
    assert as_map(X.fitted_idf(spark, path)) == as_map(refit(left))
    X.compact_frequencies(spark, path, f"{scratch}/one")
    assert as_map(X.fitted_idf(spark, f"{scratch}/one")) == as_map(refit(left))
    X.record_documents(left, path, 9, removed=True)
    assert X.fitted_idf(spark, path).count() == 0


def test_index_gives_the_same_similarities(spark, docs, scratch):
    path, frequencies = f"{scratch}/index", X.record_documents(docs, f"{scratch}/df", 1)
    idf = X.fitted_idf(spark, frequencies)
    X.write_index(docs, path, idf, buckets=32)
    for given in (1, 5, 17):
        found = {r.id: round(r.similarity, 9) for r in X.indexed_similarity(spark, path, docs.where(F.col("id") == given), idf, k=None, buckets=32).collect()}
        plain = {r.id: round(r.similarity, 9) for r in content.similar_documents(docs, given, k=None).collect()}
        assert found == plain
    top = X.indexed_similarity(spark, path, docs.where("id = 1"), idf, k=5, buckets=32).collect()
    assert [r.id for r in top] == [r.id for r in content.similar_documents(docs, 1, k=5).collect()]


def test_scan_reads_the_touched_directories_only(spark, docs, scratch):
    path = f"{scratch}/index"
    idf = X.fitted_idf(spark, X.record_documents(docs, f"{scratch}/df", 1))
    X.write_index(docs, path, idf, buckets=64)
    terms = [r.term for r in idf.where("idf <> 0").orderBy("term").limit(3).collect()]
    plan = X.postings_of(spark, path, terms, 64)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", text) and "PushedFilters: [In(term" in text
    assert len({f.split("bucket=")[1].split("/")[0] for f in plan.where("true").select(F.input_file_name()).distinct().toPandas().iloc[:, 0]}) <= 3
    assert {r.term for r in plan.select("term").distinct().collect()} == set(terms)


def test_given_documents_outside_the_index(spark, docs, scratch):
    path = f"{scratch}/index"
    idf = X.fitted_idf(spark, X.record_documents(docs, f"{scratch}/df", 1))
    X.write_index(docs, path, idf, buckets=8)
    text = docs.where("id = 3").first().description
    new = spark.createDataFrame([(10 ** 6, text), (10 ** 6 + 1, "zzzz qqqq"), (10 ** 6 + 2, None)], "id bigint, description string")
    same = X.indexed_similarity(spark, path, new.where("id = 1000000"), idf, k=None, buckets=8)
    assert same.where("id = 3").first().similarity == pytest.approx(1.0)
    for other in (10 ** 6 + 1, 10 ** 6 + 2):
        none = X.indexed_similarity(spark, path, new.where(F.col("id") == other), idf, k=None, buckets=8)
        assert none.count() == docs.count() and none.agg(F.max("similarity")).first()[0] == 0
