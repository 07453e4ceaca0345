"""Stored text statistics: mergeable document frequencies and an inverted index.

:mod:`tessera.plans.content` computes frequencies, weights and similarities from the
documents each time.  Here they are tables:

* document frequencies are counts, so batches of documents add to them and removed
  documents subtract; the fitted state after any number of batches equals a refit over what is left;
* postings (term, document, weight) lie in directories by a hash of the term, with the
  documents' norms beside them, so the documents similar to a given one come from the
  directories of its own terms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.plans.content import MIN_DOC_FREQ, TIE_DECIMALS, document_terms, tfidf_norms

# --- fixed values -------------------------------------------------------------
FREQUENCY_SCHEMA = "term string, n bigint, batch bigint"
POSTING_SCHEMA = "term string, id bigint, weight double, bucket int"
NORM_SCHEMA = "id bigint, norm double"
# -------------------------------------------------------------------------------
#: Directories of an index.  A given document of k terms reads at most k of them.
INDEX_BUCKETS = 256
#: Files a directory may get; a bucket with a very frequent term is written by that many tasks.
FILES_PER_BUCKET = 4


# --- A7, A8: document frequencies that grow ---------------------------------------

def count_documents(docs: DataFrame, id_col: str = "id", text_col: str = "description", stop_words=None,
                    num_partitions: int | None = None) -> DataFrame:
    """(term, n): the documents that hold each term, and under the null term all documents with an id."""
    terms = document_terms(docs, id_col, text_col, stop_words, num_partitions=num_partitions)
    held = terms.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    every = docs.agg(F.count(F.col(id_col)).alias("n")).select(F.lit(None).cast("string").alias("term"), "n")
    return held.unionByName(every)


def record_documents(docs: DataFrame, path: str, batch: int, removed: bool = False, **how) -> str:
    """Add ``docs`` to the frequencies stored at ``path``; with ``removed`` subtract them.

    A batch is a directory of its own and only changes counts, so it costs its own documents,
    whatever was fitted before.  Recording a batch number again replaces that batch, so a failed write
    can be repeated.  The documents removed must be ones recorded before.
    """
    counts = count_documents(docs, **how)
    n = -F.col("n") if removed else F.col("n")
    rows = counts.select("term", n.alias("n"), F.lit(batch).cast("bigint").alias("batch"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)
    return path


def compact_frequencies(spark: SparkSession, path: str, out_path: str, batch: int = 0) -> str:
    """The frequencies at ``path`` as one batch in ``out_path``: a read then adds nothing up."""
    rows = _summed(spark, path).select("term", "n", F.lit(batch).cast("bigint").alias("batch"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("batch").parquet(out_path)
    return out_path


def _summed(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema(FREQUENCY_SCHEMA).parquet(path)
    return rows.groupBy("term").agg(F.sum("n").alias("n")).where("n <> 0")


def fitted_idf(spark: SparkSession, path: str, min_doc_freq: int = MIN_DOC_FREQ) -> DataFrame:
    """A7 from stored counts: (term, df, idf), as :func:`content.inverse_document_frequency` gives for all documents."""
    counts = _summed(spark, path)
    n = F.coalesce(_summed(spark, path).where("term is null").select("n").scalar(), F.lit(0))
    df = counts.where("term is not null").select("term", F.col("n").alias("df"))
    idf = F.when(F.col("df") >= min_doc_freq, F.log((n + 1) / (F.col("df") + 1))).otherwise(F.lit(0.0))
    return df.withColumn("idf", idf)


def weighted_terms(docs: DataFrame, idf: DataFrame, id_col: str = "id", text_col: str = "description", stop_words=None,
                   num_partitions: int | None = None) -> DataFrame:
    """M8 with a stored fit: (id, term, weight) of the terms whose weight is not 0."""
    terms = document_terms(docs, id_col, text_col, stop_words, num_partitions=num_partitions)
    return terms.join(idf.where("idf <> 0"), "term").select("id", "term", (F.col("tf") * F.col("idf")).alias("weight"))


# --- J9, M9: the inverted index -----------------------------------------------------

def _bucket(term: Column | str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def write_index(docs: DataFrame, path: str, idf: DataFrame, id_col: str = "id", text_col: str = "description",
                stop_words=None, num_partitions: int | None = None, buckets: int = INDEX_BUCKETS) -> str:
    """Store the weighted terms of ``docs`` under ``path``: postings by term bucket, sorted by term, and norms.

    A bucket is written by up to ``FILES_PER_BUCKET`` tasks, told apart by the
    document, so a term of very many documents isn't one task's work.
    """
    weights = weighted_terms(docs, idf, id_col, text_col, stop_words, num_partitions)
    rows = weights.select("term", F.col("id").cast("bigint").alias("id"), "weight", _bucket(F.col("term"), buckets).alias("bucket"))
    spread = F.pmod(F.xxhash64("id", F.lit("file")), F.lit(FILES_PER_BUCKET))
    placed = rows.repartition(F.col("bucket"), spread).sortWithinPartitions("bucket", "term", "id")
    placed.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(f"{path}/postings")
    spark = docs.sparkSession
    norms = tfidf_norms(docs, spark.read.schema(POSTING_SCHEMA).parquet(f"{path}/postings"), id_col)
    norms.select(F.col("id").cast("bigint").alias("id"), "norm").write.mode("overwrite").parquet(f"{path}/norms")
    return path


def postings_of(spark: SparkSession, path: str, terms: list[str], buckets: int = INDEX_BUCKETS) -> DataFrame:
    """The postings of ``terms``: their directories only, and in them the row groups that may hold a term."""
    rows = spark.read.schema(POSTING_SCHEMA).parquet(f"{path}/postings")
    if not terms:
        return rows.where(F.lit(False))
    # the buckets are numbers the scan can prune directories with
    named = spark.createDataFrame([(t,) for t in terms], "term string").select(_bucket(F.col("term"), buckets).alias("b")).distinct()
    touched = sorted(r["b"] for r in named.collect())
    return rows.where(F.col("bucket").isin(touched) & F.col("term").isin(terms))


def indexed_similarity(spark: SparkSession, path: str, given: DataFrame, idf: DataFrame, k: int | None = 20, id_col: str = "id",
                       text_col: str = "description", stop_words=None, buckets: int = INDEX_BUCKETS) -> DataFrame:
    """M9 from the index: (id, similarity) of every indexed document against the one document in ``given``.

    Only the postings of the given document's terms are read; a document that
    shares none has similarity 0.  ``given`` needn't be in the index.  Its
    terms and weights (one document's) are on the driver and become constants of the scan.
    """
    mine = {r["term"]: r["weight"] for r in weighted_terms(given, idf, id_col, text_col, stop_words).select("term", "weight").collect()}
    norms = spark.read.schema(NORM_SCHEMA).parquet(f"{path}/norms")
    if not mine:
        out = norms.select("id", F.lit(0.0).alias("similarity"))
    else:
        size = sum(w * w for w in mine.values()) ** 0.5
        query = F.broadcast(spark.createDataFrame(list(mine.items()), "term string, qw double"))  # one document's terms
        met = postings_of(spark, path, sorted(mine), buckets).join(query, "term")
        dots = met.groupBy("id").agg(F.sum(F.col("weight") * F.col("qw")).alias("_dot"))
        similarity = F.when(F.col("norm") > 0, F.coalesce("_dot", F.lit(0.0)) / (F.col("norm") * size)).otherwise(0.0)
        out = norms.join(dots, "id", "left").select("id", similarity.alias("similarity"))
    if k is None:
        return out
    return out.orderBy(F.round("similarity", TIE_DECIMALS).desc(), F.col("id").asc()).limit(k)
