"""Content-based recommendation: TF-IDF and cosine similarity.

The reference collected the whole TF-IDF matrix to the driver and shipped
one row back in a closure.  Here every step is a distributed relation in
*long form*, one row per (document, term):

    docs --tokens--> (id, term) --count--> tf --join idf--> weight
    weight LEFT JOIN the given document's weights ON term
           --group by id--> (norm^2, dot) --> cosine

``idf = ln((N + 1) / (df + 1))``, set to 0 when ``df < min_doc_freq`` (2), as
MLlib's IDF.  Terms whose idf is 0 (seen in fewer than two documents, or in
every document) are dropped on the idf side before the join: they add
nothing to a norm or a dot product, and they are most of the vocabulary.
The corpus is tokenized once; the tf and df branches share that shuffle.

``method="hashed"`` replaces each term by ``pmod(hash(term), 2^20)`` - Spark
SQL's 32-bit Murmur3 with seed 42, the hash MLlib's term hashing used in the
Spark 2 line - and then runs the same plan on buckets, so colliding terms
merge as in a hashed term-frequency vector.  The idf table then has at most
2^20 rows whatever the corpus size.
"""

from __future__ import annotations

import math

from pyspark.ml import Pipeline
from pyspark.ml.feature import StopWordsRemover, Tokenizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.stopwords import reference_stop_words
from tessera.functions.text import exploded_terms

# --- fixed values -------------------------------------------------------------
MIN_DOC_FREQ = 2
NUM_FEATURES = 1 << 20  # MLlib HashingTF default size
# similarities equal to this many decimals are ties (summation-order noise)
TIE_DECIMALS = 12
# text one task tokenizes and counts: its hash maps hold all (document, term) pairs of it
TEXT_BYTES_A_PARTITION = 8 << 20
# -------------------------------------------------------------------------------


def document_terms(
    docs: DataFrame,
    id_col: str = "id",
    text_col: str = "description",
    stop_words=None,
    num_features: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Term counts per document, ``(id, term, tf)``.

    With ``num_features`` the term is its hash bucket (an int) instead.  A
    document is one row, so the map-side partial count is already final and
    only distinct (document, term) pairs cross the shuffle.  Rows without an
    id cannot be matched to anything and are skipped.  The scan's splits give
    the tasks; an input in few splits (one unsplittable file) can be spread by
    document id over ``num_partitions`` (:func:`text_partitions` says how many).  ``stop_words`` may be a DataFrame
    with a column ``word`` of any length.
    """
    docs = docs.where(F.col(id_col).isNotNull())
    if num_partitions:
        docs = docs.repartition(num_partitions, id_col)
    tokens = exploded_terms(docs, text_col, stop_words, keep=[F.col(id_col).alias("id")])
    if num_features:
        tokens = tokens.select("id", F.pmod(F.hash("term"), F.lit(num_features)).alias("term"))
    return tokens.groupBy("id", "term").agg(F.count(F.lit(1)).alias("tf"))


def text_partitions(docs: DataFrame, text_col: str = "description", least: int = 1) -> int:
    """Partitions to spread ``docs`` over before they are tokenized: as many as their text needs, at least ``least``.

    One pass over the text column adds up its bytes, so a task's share is bounded
    however large the corpus is and however well its files are compressed.
    """
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return max(least, math.ceil(size / TEXT_BYTES_A_PARTITION))


def document_count(docs: DataFrame, id_col: str = "id") -> Column:
    """N for the IDF, as a scalar subquery (evaluated once, no join): the documents with an id, as in the terms."""
    return docs.select(F.count(F.col(id_col))).scalar()


def inverse_document_frequency(terms: DataFrame, n_docs, min_doc_freq: int = MIN_DOC_FREQ) -> DataFrame:
    """``(term, df, idf)`` from ``(id, term, tf)`` rows (one per document and term).

    ``df`` is the number of documents whose ``tf`` is positive.  Reading
    ``tf`` keeps this branch's input plan identical to the term-frequency
    branch, so Spark tokenizes the corpus once and both branches read the
    same shuffle (a plain row count would let the optimizer prune ``tf`` and
    make the two plans differ).
    """
    n = n_docs if isinstance(n_docs, Column) else F.lit(n_docs)
    df = terms.groupBy("term").agg(F.count_if(F.col("tf") > 0).alias("df"))
    idf = F.when(F.col("df") >= min_doc_freq, F.log((n + 1) / (F.col("df") + 1))).otherwise(F.lit(0.0))
    return df.withColumn("idf", idf)


def tfidf_terms(
    docs: DataFrame,
    id_col: str = "id",
    text_col: str = "description",
    stop_words=None,
    method: str = "exact",
    min_doc_freq: int = MIN_DOC_FREQ,
    num_features: int = NUM_FEATURES,
    nonzero: bool = False,
    num_partitions: int | None = None,
) -> DataFrame:
    """M8 (exact) / M7 (hashed) in long form: ``(id, term, tf, df, idf, weight)``.

    With ``nonzero=True`` terms whose idf is 0 are dropped on the (smaller)
    idf side before the join; they add nothing to a norm or a dot product.
    """
    if method not in ("exact", "hashed"):
        raise ValueError("method must be 'exact' or 'hashed'")
    buckets = num_features if method == "hashed" else None
    terms = document_terms(docs, id_col, text_col, stop_words, buckets, num_partitions)
    idf = inverse_document_frequency(terms, document_count(docs, id_col), min_doc_freq)
    if nonzero:
        idf = idf.where(F.col("idf") != 0)
    if buckets:
        idf = F.broadcast(idf)  # at most num_features rows, a parameter: some tens of MB for the default
    return terms.join(idf, "term").withColumn("weight", F.col("tf") * F.col("idf"))


def tfidf_norms(docs: DataFrame, weights: DataFrame, id_col: str = "id") -> DataFrame:
    """L2 norm of every document's TF-IDF vector, ``(id, norm)``; 0 for an empty one."""
    norms = weights.groupBy("id").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    ids = docs.select(F.col(id_col).alias("id"))
    return ids.join(norms, "id", "left").select("id", F.coalesce("norm", F.lit(0.0)).alias("norm"))


def similarity_scores(weights: DataFrame, given_id) -> DataFrame:
    """J9 + F18 + F23: cosine against ``given_id`` for every document with a weighted term.

    ``weights`` are non-zero ``(id, term, weight)`` rows.  Each document's
    norm and its dot with the given document come out of one grouped
    aggregate over a left join with the given document's terms - the small
    side: Spark broadcasts it when its measured size allows, otherwise it
    shuffles on the term and AQE splits skewed terms.  The given document's
    own terms are read through a pushed-down id filter.  Result
    ``(id, similarity)``; documents without weighted terms are absent.
    """
    w = weights.select("id", "term", "weight")
    query = w.where(F.col("id") == F.lit(given_id)).select("term", F.col("weight").alias("qw"))
    q_norm = query.select(F.sqrt(F.sum(F.col("qw") * F.col("qw")))).scalar()
    per_doc = (
        w.join(query, "term", "left")
        .groupBy("id")
        .agg(
            F.sum(F.col("weight") * F.col("weight")).alias("_n2"),
            F.sum(F.col("weight") * F.coalesce(F.col("qw"), F.lit(0.0))).alias("_dot"),
        )
    )
    # every grouped document has a non-zero weight, so no norm here is 0; an
    # empty given document makes q_norm NULL and every similarity NULL (-> 0)
    return per_doc.select("id", (F.col("_dot") / (F.sqrt("_n2") * q_norm)).alias("similarity"))


def similar_documents(
    docs: DataFrame,
    given_id,
    k: int | None = 20,
    id_col: str = "id",
    text_col: str = "description",
    stop_words=None,
    method: str = "exact",
    num_features: int = NUM_FEATURES,
    num_partitions: int | None = None,
) -> DataFrame:
    """M9: documents with their cosine similarity to ``given_id``.

    Every document appears (0.0 when nothing is shared), with all its
    columns.  With ``k`` only the ``k`` most similar are kept (values equal
    to ``TIE_DECIMALS`` places are ties, broken by id, so the given document
    precedes its duplicates whatever the rounding noise): the top-k runs on
    ``(id, similarity)`` and joins the documents afterwards, so it decides
    before any text moves.  ``k=None`` returns every row, unsorted.  The given
    document has similarity 1 (exact duplicates of it too).
    """
    weights = tfidf_terms(docs, id_col, text_col, stop_words, method, num_features=num_features, nonzero=True, num_partitions=num_partitions)
    scores = similarity_scores(weights, given_id)
    sim = F.coalesce(F.col("similarity"), F.lit(0.0)).alias("similarity")
    named = docs.withColumnRenamed(id_col, "id") if id_col != "id" else docs
    if k is None:
        return named.join(scores, "id", "left").select("id", sim, *[c for c in named.columns if c != "id"])
    order = [F.round("similarity", TIE_DECIMALS).desc(), F.col("id").asc()]
    best = named.select("id").join(scores, "id", "left").select("id", sim).orderBy(*order).limit(k)
    return best.join(named, "id").orderBy(*order)


# --- pyspark.ml form (M10) ----------------------------------------------------

def preprocessing_pipeline(input_col: str = "description", stop_words=None) -> Pipeline:
    """Tokenizer + case-insensitive StopWordsRemover as one ML Pipeline."""
    words = reference_stop_words() if stop_words is None else list(stop_words)
    return Pipeline(
        stages=[
            Tokenizer(inputCol=input_col, outputCol="rawDesc"),
            StopWordsRemover(inputCol="rawDesc", outputCol="tokens", stopWords=words, caseSensitive=False),
        ]
    )
