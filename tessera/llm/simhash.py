"""SimHash near-dedup with multi-index hashing.

Fingerprint: A-Z in lower case, words between blanks, shingles of three words (repeats count;
fewer words: the whole sequence), XXH64 (seed 42) of each; a bit is set if it is set in more than
half of the hashes.  A text without words has fingerprint zero and links like any other.

Links: two fingerprints that differ in at most ``r`` of 64 bits differ in at most ``r // m`` bits
in one of ``m`` segments.  Each distinct fingerprint enters, for each segment, the table under
its own segment value, and probes the values of the ball around it that clear one set bit (of two
values one bit apart, one has the bit set, so one of the two probes finds the other).  Probes whose
table place is empty drop out.  All fingerprints that meet under one value are compared by their
complete distance.

Only distinct fingerprints are compared, so a group of copies is one entry.  Under one value only
a spanning forest of the verified links is given out, never all pairs.  A value shared by more
than ``CROWD`` fingerprints is looked up again, among them alone, by the halves of the other bits
(the same pigeonhole rule), so no comparison is lost and no task gets an unbounded group: what
then still shares a value differs in at most 16 free bits and a few flips.

Defined results: null and empty texts have no words; a null doc_id never becomes a component's id
unless the component has no other; repeated rows are members each.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import attach, keep_rows, row_hash, stored
from tessera.llm.components import components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
#: Fingerprints that are compared directly under one segment value.
CROWD = 2048


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit fingerprint of a UTF-8 text."""
    from xxhash import xxh64_intdigest

    words = (text or b"").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    last = ends[min(shingle, len(words)) - 1:]
    hashes = [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), last.tolist(), strict=True)]
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        part = np.array(hashes[at:at + (1 << 16)], "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc, tie, fp) of every row; fp is the fingerprint as a signed long, tie the row's hash."""
    given = docs.select(docs[id_col].cast("long").alias("doc"), row_hash(docs).alias("tie"), docs[text_col].cast("string").cast("binary").alias("text"))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            found = np.array([fingerprint(text[k].as_py(), shingle) for k in range(batch.num_rows)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("tie"), pa.array(found)], names=["doc", "tie", "fp"])

    return given.mapInArrow(work, "doc long, tie long, fp long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _forest(found: list[int], max_bits: int) -> list[tuple[int, int]]:
    """Links that connect what the complete distance connects."""
    if len(found) == 2:
        a, b = found
        return [(a, b)] if ((a ^ b) & 0xFFFFFFFFFFFFFFFF).bit_count() <= max_bits else []
    rest = np.unique(np.array(found, np.int64)).view(np.uint64)  # bitwise_count takes absolute values of signed numbers
    links = []
    while rest.size > 1:
        todo, rest = [int(rest[0])], rest[1:]
        while todo and rest.size:
            a = todo.pop()
            near = np.bitwise_count(rest ^ np.uint64(a)) <= max_bits
            if near.any():
                new = rest[near].tolist()
                links += [(_signed(a), _signed(b)) for b in new]
                todo += new
                rest = rest[~near]
    return links


def _meet(max_bits: int):
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Batches ordered by key: the links under each key."""
        key, run, links = None, [], []

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["u", "v"])
            links.clear()
            return made

        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in batch.schema.names[:-1]), strict=True))
            for k, fp in zip(keys, batch.column(batch.num_columns - 1).to_pylist(), strict=True):
                if k != key:
                    if len(run) > 1:
                        links.extend(_forest(run, max_bits))
                    key, run = k, []
                run.append(fp)
            if len(links) > 100_000:
                yield out()
        if len(run) > 1:
            links.extend(_forest(run, max_bits))
        yield out()

    return work


def _segments(rows: DataFrame, of: str, bits: int, low: int, parts: int, names: tuple[str, str]) -> DataFrame:
    """``rows`` once for each of ``parts`` segments of the ``bits`` bits from ``low`` on: its number and value."""
    width = bits // parts
    each = [F.struct(F.lit(s).alias("s"), F.shiftrightunsigned(F.col(of), low + s * width).bitwiseAND((1 << width) - 1).alias("v")) for s in range(parts)]
    return rows.withColumn("_e", F.explode(F.array(*each))).select("*", F.col("_e.s").alias(names[0]), F.col("_e.v").alias(names[1])).drop("_e")


def _probes(rows: DataFrame, value: str, width: int) -> DataFrame:
    """``rows`` once for each set bit of ``value``, with that bit cleared."""
    flips = F.expr(f"filter(transform(sequence(0, {width - 1}), i -> shiftleft(1L, i)), b -> ({value} & b) <> 0)")
    return rows.withColumn("_b", F.explode(flips)).withColumn(value, F.col(value).bitwiseXOR(F.col("_b"))).drop("_b")


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (u, v) that connect what distances of at most ``max_bits`` connect.  ``distinct``: column fp, each once."""
    if not 2 <= max_bits <= 3:
        raise ValueError("two segments and balls of one bit serve distances of 2 or 3 bits")
    table = _segments(distinct.select("fp"), "fp", 64, 0, 2, ("s", "v")).select("s", "v", "fp")
    places = table.groupBy("s", "v").agg(F.count(F.lit(1)).alias("n"))
    probes = _probes(table, "v", 32).join(places.select("s", "v"), ["s", "v"], "left_semi")
    met = stored(table.unionByName(probes.select("s", "v", "fp")), "segment-table")
    crowds = stored(met.groupBy("s", "v").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "segment-counts")
    total = crowds.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    crowded = crowds.where(F.col("n") > CROWD)
    few = met.join(crowds.where(F.col("n") <= CROWD).select("s", "v"), ["s", "v"], "left_semi").select("s", "v", "fp")
    ddl = "u long, v long"
    out = few.repartition("s", "v").sortWithinPartitions("s", "v").mapInArrow(_meet(max_bits), ddl)
    if crowded.isEmpty():
        return out
    # the crowded values: the same lookup by the halves of the other 32 bits
    many = _attach_crowd(met, crowded, total)
    other = many.withColumn("o", F.when(F.col("s") == 0, F.shiftrightunsigned("fp", 32)).otherwise(F.col("fp").bitwiseAND(0xFFFFFFFF)))
    inner = _segments(other, "o", 32, 0, 2, ("s2", "v2")).select("s", "v", "s2", "v2", "fp")
    inner_places = inner.select("s", "v", "s2", "v2").distinct()
    inner_probes = _probes(inner, "v2", 16).join(inner_places, ["s", "v", "s2", "v2"], "left_semi")
    again = inner.unionByName(inner_probes.select(*inner.columns)).distinct()
    keys = ["s", "v", "s2", "v2"]
    return out.unionByName(again.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_meet(max_bits), ddl))


def _attach_crowd(met: DataFrame, crowded: DataFrame, total: int) -> DataFrame:
    """The rows of ``met`` under a crowded value.  Crowds with over 1/1000 of all rows are broadcast (under 1000 rows)."""
    heavy = crowded.where(F.col("n") * 1000 > total).select("s", "v")
    light = crowded.where(F.col("n") * 1000 <= total).select("s", "v")
    return met.join(F.broadcast(heavy), ["s", "v"], "left_semi").unionByName(met.join(light, ["s", "v"], "left_semi"))


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc, tie, fp, root, component_id) of every row.  root: the component's least fingerprint."""
    rows = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = stored(rows.groupBy("fp").agg(F.min("doc").alias("least"), F.count(F.lit(1)).alias("n")), "distinct-fingerprints")
    roots = components(links(distinct, max_bits))
    rooted = stored(distinct.join(roots, distinct["fp"] == roots["node"], "left")
                    .select("fp", "least", "n", F.coalesce("root", "fp").alias("root")), "roots")
    least = stored(rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("n").alias("n")), "components")
    total = least.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    named = attach(rooted.select("fp", "root", F.col("n").alias("w")), least, ["root"], "n", total, F.col("fp"))
    named = stored(named.select("fp", "root", "component_id", F.col("w").alias("n")), "named")
    return attach(rows, named, ["fp"], "n", total, F.col("tie")).drop("n")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component: the one with the component's id (of several, the least row hash)."""
    classes = near_classes(docs, id_col, text_col, shingle, max_bits)
    own = classes.where(F.col("doc").eqNullSafe(F.col("component_id")))
    keepers = own.groupBy("root").agg(F.first("doc").alias("_kid"), F.min("tie").alias("_kkey")).select("_kid", "_kkey")
    return keep_rows(docs, keepers, id_col, "hash", text_col)


def op6_simhash_dedup(documents: DataFrame) -> DataFrame:
    found = near_classes(documents)
    return found.select(F.col("doc").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
