"""Keyed tables: upsert (S9), scans with a declared schema (S6), strict document files (S3)."""

import os
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tessera.sources import files, tables

SPEC = tables.TableSpec(
    "things", (("k", "int"), ("part", "string"), ("v", "string"), ("at", "int")),
    partition_key=("part",), clustering_key=("k",), storage_partitions=("part",),
    order=lambda: [F.col("at").desc_nulls_last(), F.col("v")])
BUCKETED = replace(SPEC, storage_partitions=(), storage_buckets=4)


def rows(spark, data):
    return spark.createDataFrame(data, "k int, part string, v string, at int")


def times(path):
    return {str(f.relative_to(path)): os.stat(f).st_mtime_ns for f in Path(path).rglob("*.parquet")}


def content(spark, spec, path):
    return {(r.part, r.k): r.v for r in tables.read_keyed(spark, spec, path).collect()}


@pytest.mark.parametrize("spec", [SPEC, BUCKETED])
def test_upsert_replaces_and_adds(spark, scratch, spec):
    path = f"{scratch}/t"
    first = [(k, p, f"old-{p}{k}", 5) for k in range(20) for p in ("a", "b", "c", None)]
    tables.replace_table(rows(spark, first), spec, path)
    before = times(path)
    second = [(3, "a", "new", 1), (3, "a", "newer", 2), (99, "a", "added", 1), (7, None, "none", 0)]
    touched = tables.upsert_table(rows(spark, second), spec, path)
    expected = {(p, k): v for k, p, v, _ in first} | {("a", 3): "newer", ("a", 99): "added", (None, 7): "none"}
    assert content(spark, spec, path) == expected
    after = times(path)
    kept = {f: t for f, t in before.items() if f in after}
    assert touched <= 2 and kept and all(after[f] == t for f, t in kept.items())
    if spec is SPEC:
        assert {f.split("/")[0] for f in before if f not in after} == {"part=a", "part=__HIVE_DEFAULT_PARTITION__"}
        assert {f for f in before if f.startswith(("part=b", "part=c"))} == set(kept)


def test_upsert_by_order_keeps_the_better_row(spark, scratch):
    path = f"{scratch}/t"
    tables.upsert_table(rows(spark, [(1, "a", "x", 5), (2, "a", "x", 5)]), BUCKETED, path, by_order=True)
    tables.upsert_table(rows(spark, [(1, "a", "late", 9), (2, "a", "early", 1)]), BUCKETED, path, by_order=True)
    assert content(spark, BUCKETED, path) == {("a", 1): "late", ("a", 2): "x"}


def test_upsert_into_nothing_and_of_nothing(spark, scratch):
    path = f"{scratch}/t"
    assert tables.upsert_table(rows(spark, []), SPEC, path) == 0
    assert tables.upsert_table(rows(spark, [(1, "a", "x", 5)]), SPEC, path) == 1
    tables.truncate_table(spark, SPEC, path)
    assert tables.read_keyed(spark, SPEC, path).count() == 0
    assert tables.upsert_table(rows(spark, [(1, "b", "y", 5)]), SPEC, path) == 1
    assert content(spark, SPEC, path) == {("b", 1): "y"}


def test_upsert_needs_directories_that_follow_from_the_key(spark, scratch):
    with pytest.raises(ValueError, match="one directory"):
        tables.upsert_table(rows(spark, []), replace(SPEC, storage_partitions=()), f"{scratch}/t")
    with pytest.raises(ValueError, match="primary key"):
        tables.upsert_table(rows(spark, []), replace(SPEC, storage_partitions=("v",)), f"{scratch}/t")


def test_hot_directory_is_merged_by_several_tasks(spark, scratch):
    path = f"{scratch}/t"
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small partitions would be put together
    try:
        tables.upsert_table(rows(spark, [(k, "hot", "x", 1) for k in range(4000)]), SPEC, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]
    assert 4 <= len(sizes) <= 8 and max(sizes) < 2000


def test_scan_with_declared_schema(spark, scratch):
    path = f"{scratch}/t"
    tables.replace_table(rows(spark, [(1, "a", "x", 5)]), SPEC, path)
    assert files.read_table(spark, path, spec=SPEC).columns == ["k", "part", "v", "at"]
    some = files.read_table(spark, path, spec=SPEC, columns=["v", "k"])
    assert some.columns == ["k", "v"] and tuple(some.first()) == (1, "x")
    assert "ReadSchema: struct<k:int,v:string>" in some._jdf.queryExecution().executedPlan().toString()
    assert files.read_table(spark, path, spec="k int, v string").columns == ["k", "v"]
    tables.truncate_table(spark, SPEC, path)
    assert files.read_table(spark, path, spec=SPEC).count() == 0
    with pytest.raises(ValueError, match="no column nope"):
        files.read_table(spark, path, spec=SPEC, columns=["nope"])


def test_bad_document_lines(spark, scratch):
    good, bad = Path(scratch) / "good.csv", Path(scratch) / "bad.csv"
    good.write_text('id,description\n1,"a, b"\n2,two\n')
    assert [tuple(r) for r in files.read_documents(spark, str(good)).collect()] == [(1, "a, b"), (2, "two")]
    for line in ("x,three", "3", "3,a,b"):
        bad.write_text(f"id,description\n1,one\n{line}\n")
        with pytest.raises(Exception, match="MALFORMED"):
            files.read_documents(spark, str(bad), schema="id bigint, description string").select("description").collect()
        dropped = files.read_documents(spark, str(bad), schema="id bigint, description string", drop_malformed=True)
        assert [tuple(r) for r in dropped.collect()] == [(1, "one")]
