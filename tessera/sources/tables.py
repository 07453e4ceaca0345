"""Keyed tables: declared schema, primary key, full replacement and upsert.

The programs kept their results in a wide-column store whose primary key
makes a write replace an earlier row with the same key.  Here a table is a
Parquet directory plus a :class:`TableSpec`; :func:`replace_table` applies the
key (keeping one row per key under an explicit order) and overwrites the
directory; :func:`upsert_table` merges rows into the directories they belong
to and leaves the others alone.  Directory partitioning is chosen for scans, not copied from the
store's partition key: partitioning by customer would make one directory per
customer.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.timeuuid import timeuuid_micros, timeuuid_ticks
from tessera.operators.keyed import dedupe_by_key


# files that a write makes in one directory, at most
FILES_PER_DIRECTORY = 8
# directory column of tables with ``storage_buckets``
BUCKET = "store_bucket"


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[tuple[str, str], ...]  # (column, Spark SQL type), in order
    partition_key: tuple[str, ...]
    clustering_key: tuple[str, ...] = ()
    storage_partitions: tuple[str, ...] = ()  # directory partitioning on disk
    storage_buckets: int = 0  # further directories, by a hash of the partition key: what an upsert rewrites
    # which of the rows with one key stays: the first in this order (default: the other columns, ascending)
    order: Callable[[], list[Column]] | None = field(default=None, compare=False)
    # columns computed from the others when the input lacks them
    derived: dict[str, Callable[[], Column]] = field(default_factory=dict, compare=False)

    @property
    def primary_key(self) -> tuple[str, ...]:
        return self.partition_key + self.clustering_key

    @property
    def column_names(self) -> list[str]:
        return [c for c, _ in self.columns]

    @property
    def directories(self) -> tuple[str, ...]:
        """The directory columns on disk."""
        return self.storage_partitions + ((BUCKET,) if self.storage_buckets else ())

    def placed(self, df: DataFrame) -> DataFrame:
        """``df`` with its directory columns."""
        if not self.storage_buckets:
            return df
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(*[F.col(c) for c in self.partition_key]), F.lit(self.storage_buckets)).cast("int"))

    @property
    def key_order(self) -> list[Column]:
        if self.order:
            return self.order()
        return [F.col(c).asc_nulls_last() for c in self.column_names if c not in self.primary_key]

    @property
    def ddl(self) -> str:
        return ", ".join(f"{c} {t}" for c, t in self.columns)

    @property
    def source_ddl(self) -> str:
        """Schema of incoming rows: the declared columns without the derived ones."""
        return ", ".join(f"{c} {t}" for c, t in self.columns if c not in self.derived)

    def conform(self, df: DataFrame) -> DataFrame:
        """Select the declared columns in order, cast to the declared types.

        A declared column missing from ``df`` is computed from its rule in
        ``derived`` (e.g. the time of a transaction's UUID).
        """
        def col(c: str) -> Column:
            if c not in df.columns and c in self.derived:
                return self.derived[c]()
            return F.col(c)

        return df.select(*[col(c).cast(t).alias(c) for c, t in self.columns])


# --- fixed values: the five tables of the transaction programme --------------
CUSTOMERS = TableSpec(
    "customers",
    (("id", "int"), ("name", "string"), ("county", "string")),
    partition_key=("id",),
)
TRANSACTIONS = TableSpec(
    "transactions",
    (("customerid", "string"), ("year", "int"), ("month", "int"), ("id", "string"),
     ("amount", "int"), ("card", "string"), ("status", "string"), ("event_us", "bigint")),
    partition_key=("customerid", "year", "month"),
    clustering_key=("id",),
    storage_partitions=("year", "month"),
    # the UUID's time as a number: Parquet min/max statistics can prune on it,
    # which they cannot on the UUID text
    derived={"event_us": lambda: timeuuid_micros("id")},
)
BALANCE = TableSpec(
    "balance",
    (("customerid", "string"), ("card", "string"), ("balance", "bigint"), ("updated_at", "timestamp_ntz")),
    partition_key=("customerid", "card"),
)
COUNTY_STATISTICS = TableSpec(
    "county_statistics",
    (("county", "string"), ("year", "int"), ("month", "int"), ("total_amount", "int")),
    partition_key=("county", "year", "month"),
    storage_partitions=("year",),
)
SUSPICIOUS = TableSpec(
    "suspicious",
    (("customerid", "string"), ("card", "string"), ("id", "string"), ("amount", "int"),
     ("reported_at", "string")),
    partition_key=("customerid",),
    # the latest transaction, and of its reports the first
    order=lambda: [timeuuid_ticks("id").desc_nulls_last(), F.col("id").desc_nulls_last(), F.col("card"), F.col("amount"), F.col("reported_at")],
)
# -----------------------------------------------------------------------------


def replace_table(df: DataFrame, spec: TableSpec, path: str, order_by=None, unique: bool = False,
                  files_per_directory: int | None = FILES_PER_DIRECTORY) -> str:
    """S8 (+S9, S10): replace the whole table at ``path`` with ``df``.

    Rows sharing a primary key collapse to the first under ``order_by``
    (default: the table's declared order) - the store's "last write wins",
    made deterministic.  ``unique=True`` is the caller's word that no key
    repeats and saves that shuffle.  Writing to a path the same plan reads
    fails in Spark; stage through another path first.

    In a directory-partitioned write each task writes one file per directory
    it touches.  So rows are first hashed on the directory columns plus a salt
    from the primary key: each directory gets at most ``files_per_directory``
    files, and one holding a third of the rows is still written by that many
    tasks.  ``None`` writes the input as it is clustered.
    """
    rows = spec.conform(df)
    if not unique:
        rows = dedupe_by_key(rows, list(spec.primary_key), spec.key_order if order_by is None else order_by)
    rows = spec.placed(rows)
    if files_per_directory and spec.directories:
        rows = rows.repartition(*[F.col(c) for c in spec.directories], _salt(spec, files_per_directory))
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if spec.directories:
        writer = writer.partitionBy(*spec.directories)
    writer.parquet(path)
    return path


def _salt(spec: TableSpec, parts: int) -> Column:
    # a second hash: the first decides the bucket, and rows of one bucket share its remainders
    return F.pmod(F.xxhash64(F.lit("salt"), *[F.col(c) for c in spec.primary_key]), F.lit(parts))


def upsert_table(df: DataFrame, spec: TableSpec, path: str, by_order: bool = False, order_by=None,
                 files_per_directory: int = FILES_PER_DIRECTORY) -> int:
    """Merge ``df`` into the table at ``path``; returns the number of directories rewritten.

    A row replaces the stored row with its primary key, others are added.
    Rows of ``df`` that share a key collapse to the first under ``order_by``
    (default: the table's declared order); with ``by_order`` the stored row
    takes part in that contest instead of losing it.

    Only the directories that ``df`` touches are read, merged and replaced:
    rows and stored rows meet in one shuffle by directory and a salt of the
    primary key, which is also how the files are written, so a directory
    holding a third of the rows is merged by ``files_per_directory`` tasks.
    Spark stages the new files beside the table and swaps the touched
    directories when the job commits; a failed job leaves the table as it was.
    The driver holds the touched directories' values, one per directory.  A
    table may be upserted into before it exists.
    """
    if not spec.directories:
        raise ValueError(f"{spec.name} has one directory; declare storage_partitions or storage_buckets to upsert into it")
    if not set(spec.storage_partitions) <= set(spec.primary_key):
        raise ValueError(f"{spec.name}: a row's directory must follow from its primary key")
    spark = df.sparkSession
    incoming = spec.placed(spec.conform(df))
    touched = incoming.select(*spec.directories).distinct().collect()
    if not touched:
        return 0
    # directories of nulls have no equality test; eqNullSafe is pruned like =
    places = [reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(r[c])) for c in spec.directories]) for r in touched]
    both = incoming.withColumn("_stored", F.lit(False))
    if _has_files(spark, path):
        stored = _placed_rows(spark, spec, path).where(reduce(lambda a, b: a | b, places))
        both = both.unionByName(stored.withColumn("_stored", F.lit(True)))
    order = list(spec.key_order if order_by is None else [order_by] if isinstance(order_by, (str, Column)) else order_by)
    order = [*order, F.col("_stored")] if by_order else [F.col("_stored"), *order]
    salted = both.withColumn("_salt", _salt(spec, files_per_directory)).repartition(*spec.directories, "_salt")
    # the key decides directory and salt, so grouping by all three needs no second shuffle
    keys = list(dict.fromkeys([*spec.directories, "_salt", *spec.primary_key]))
    merged = dedupe_by_key(salted, keys, order).drop("_salt", "_stored")
    writer = merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*spec.directories).parquet(path)
    return len(touched)


def _has_files(spark: SparkSession, path: str) -> bool:
    try:
        return bool(spark.read.parquet(path).inputFiles())
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def _placed_rows(spark: SparkSession, spec: TableSpec, path: str) -> DataFrame:
    bucket = f", {BUCKET} int" if spec.storage_buckets else ""
    rows = spark.read.schema(spec.ddl + bucket).parquet(path)
    return rows.select(*spec.column_names, *((BUCKET,) if spec.storage_buckets else ()))


def truncate_table(spark: SparkSession, spec: TableSpec, path: str) -> str:
    """Delete every row, keeping the declared schema."""
    empty = spark.createDataFrame([], spec.ddl)
    return replace_table(empty, spec, path, unique=True, files_per_directory=None)


def read_keyed(spark: SparkSession, spec: TableSpec, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A table written by :func:`replace_table` or :func:`upsert_table`, or only ``columns`` of it, in declared order."""
    # with the declared schema nothing is inferred, so a table without rows (and without files) reads too
    rows = spec.conform(spark.read.schema(spec.ddl).parquet(path))
    unknown = [c for c in columns or () if c not in spec.column_names]
    if unknown:
        raise ValueError(f"{spec.name} has no column {', '.join(unknown)}")
    return rows.select(*[c for c in spec.column_names if c in columns]) if columns else rows
