"""Readers for the programs' input files and stored tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.sources.tables import TableSpec, read_keyed

MOVIES_SCHEMA = "movieId int, title string, genre string"
LOST_CARDS_SCHEMA = "card string, status string, reported_at string"


def read_ratings(spark: SparkSession, path: str, header: str | None = None) -> DataFrame:
    """``user,item,rating,timestamp`` lines -> (user_id int, item int, rating double).

    Exactly four non-empty comma-separated fields per line, otherwise the read
    raises (the reference's pattern match fails).  The CSV reader cannot
    enforce this once the timestamp column is pruned, so the line is split
    here.  ``header`` is the header line's text where files have one; lines
    equal to it are skipped.
    """
    lines = spark.read.text(path)
    if header is not None:
        lines = lines.where(F.trim("value") != header.strip())
    fields = F.split(F.col("value"), ",")
    checked = F.when(
        (F.size(fields) != 4) | F.exists(fields, lambda f: F.trim(f) == ""),
        F.raise_error(F.concat(F.lit("ratings line needs 4 fields: "), F.col("value"))),
    ).otherwise(fields)
    return lines.select(checked.alias("_f")).select(
        F.trim(F.col("_f")[0]).cast("int").alias("user_id"),
        F.trim(F.col("_f")[1]).cast("int").alias("item"),
        F.trim(F.col("_f")[2]).cast("double").alias("rating"),
    )


def _strict_csv(spark: SparkSession, path: str, schema: str | StructType, drop_malformed: bool, **options) -> DataFrame:
    """CSV whose bad lines (a value of another type, fields missing or left over) raise, or are dropped on request.

    Column pruning is off: the parser would not look at fields nobody reads.
    """
    reader = spark.read.schema(schema).option("mode", "DROPMALFORMED" if drop_malformed else "FAILFAST").option("columnPruning", False)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.csv(path)


def read_movies(spark: SparkSession, path: str, drop_malformed: bool = False) -> DataFrame:
    """``movieId,title,genre`` without header; a bad line (also one without an id) raises unless ``drop_malformed``.

    The CSV reader keeps a quoted title that contains a comma in one field;
    the reference's naive split cut it in two (quirk Q5).
    """
    films = _strict_csv(spark, path, MOVIES_SCHEMA, drop_malformed)
    has_id = F.col("movieId").isNotNull()  # also makes the reader look at the id when nobody selects it
    return films.where(has_id if drop_malformed else has_id | F.raise_error(F.lit("film line without an id")).cast("boolean"))


def read_documents(spark: SparkSession, path: str, schema: str | None = None, drop_malformed: bool = False, **options) -> DataFrame:
    """S3: documents CSV with a header; a bad line (a value of another type, fields missing or left over) raises
    unless ``drop_malformed``.  Pass ``schema`` to avoid an inference pass; ``options`` go to the CSV reader."""
    if schema is None:
        reader = spark.read.option("header", True).option("inferSchema", True)
        for k, v in options.items():
            reader = reader.option(k, v)
        schema = reader.csv(path).schema
    docs = _strict_csv(spark, path, schema, drop_malformed, header=True, **options)
    typed = [c for c, kind in docs.dtypes if kind != "string"]
    # true of every row; makes the reader look at the typed fields also when nobody selects them
    return docs.where(F.xxhash64(*typed) >= F.lit(-(1 << 63))) if typed else docs


def read_lost_cards(spark: SparkSession, path: str, drop_malformed: bool = False) -> DataFrame:
    """``card,status,reported_at`` with a header, every field a string; a bad line raises unless ``drop_malformed``."""
    return _strict_csv(spark, path, LOST_CARDS_SCHEMA, drop_malformed, header=True)


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    """One word per line as ``word``; lines are kept whole (quirk Q8).  Stays a DataFrame: see ``exploded_terms``."""
    return spark.read.text(path).select(F.col("value").alias("word"))


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None, spec: TableSpec | str | None = None) -> DataFrame:
    """Scan a stored table; only the named columns are read.

    ``spec`` is a :class:`TableSpec` or a DDL schema.  With it nothing is
    inferred, so an empty table reads too, and the columns have the declared
    order and types; without it the schema comes from the files.
    """
    if isinstance(spec, TableSpec):
        return read_keyed(spark, spec, path, columns)
    if spec:
        declared = spark.read.schema(spec)
        return declared.parquet(path).select(*(columns or StructType.fromDDL(spec).names))
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Temp view, replaced if present."""
    df.createOrReplaceTempView(name)
    return df
