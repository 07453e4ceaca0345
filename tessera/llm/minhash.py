"""MinHash near-dedup with odd sketches.

A document's set: the XXH64 (seed 42) of its distinct four-word shingles (A-Z in lower case, words between
blanks; with fewer words the whole sequence).  Documents whose sets overlap to at least 80 % are linked,
decided on the full sets.

1. Equal sets are one node, however many rows have them.  ``SAMPLES`` MinHash samples of each set are
   banded by ``ROWS`` into buckets, and folded into an odd sketch: a bitmap of ``SKETCH_BITS`` bits in
   which every sample flips one bit.  Samples that two sets share cancel out, so the number of ones in
   the XOR of two sketches grows with the samples that differ; it is the more precise the fewer those are.
2. Nodes under one bucket value are compared by sketch (XOR and population count); those near enough get
   links, a spanning forest of them.  The bound lies more than five standard deviations beyond what
   a pair at the threshold shows.  A value with more than ``CROWD`` nodes links all of them to its least,
   by aggregation: coarser groups cost time in step 3, never a link.
3. Connected candidates form groups (star contraction).  Within a group the sets are compared in
   full where the sketches don't rule it out, each node until it is linked: groups of up to
   ``GROUP_SHINGLES`` shingles in one task.  Larger groups are compared block by block: first with a
   spread sample, whose mean distances show the central nodes; then with the central nodes; then every
   node outside the group's largest class with all others, in a grid of blocks of bounded size.
4. Components of the verified links, written as one class per node and carried to all its rows.

A pair at exactly 80 % shares no band with probability (1 - 0.8^4)^32 = 5e-8.

Defined results: null, empty and blank texts have empty sets and are linked with nothing; a null id never
becomes a component's id unless the component has no other; repeated rows are members each.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import attach, keep_rows, row_hash, stored
from tessera.llm.components import components
from tessera.operators.keyed import top_k_per_group

SHINGLE = 4
PERCENT = 80
SEED = 42
ROWS = 4
BANDS = 32
SAMPLES = ROWS * BANDS
SKETCH_BITS = 512
#: Ones in the XOR of two sketches: 46 expected at the threshold, standard deviation 8.
MAX_ONES = 92
#: Nodes compared directly under one bucket value.
CROWD = 4096
#: Shingles of a group, or of a block of a larger group, that one task compares.
GROUP_SHINGLES = 4_000_000
#: Nodes of a large group that are compared with all others at first: a spread sample, then the central ones.
PROBES = 32
#: Bits that mark the texts wanted again (at most 8 MB to every executor, whatever the input), and bits of one stored piece.
MARKS, MARKED = 1 << 26, 1 << 15

_RNG = np.random.default_rng(SEED)
_MULTIPLY = _RNG.integers(0, 1 << 63, SAMPLES, np.uint64) * np.uint64(2) + np.uint64(1)
_FLIP = _RNG.integers(0, 1 << 63, SAMPLES, np.uint64)


def shingle_set(text: bytes | None, shingle: int = SHINGLE) -> np.ndarray:
    """The sorted hashes of a UTF-8 text's distinct shingles."""
    from xxhash import xxh64_intdigest

    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    last = ends[min(shingle, len(words)) - 1:].tolist()
    hashes = [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, last, strict=False)]
    return np.unique(np.array(hashes, np.uint64))


def samples(members: np.ndarray) -> np.ndarray:
    """The least value of every one of ``SAMPLES`` hash functions over a set."""
    least = np.full(SAMPLES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(members), 1024):
        values = members[at:at + 1024, None] ^ _FLIP
        values *= _MULTIPLY
        np.minimum(least, values.min(axis=0), out=least)
    return least


def _stir(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def odd_sketch(least: np.ndarray) -> np.ndarray:
    """The parity bitmap of the samples, as eight 64-bit words."""
    places = _stir(least + _FLIP) % np.uint64(SKETCH_BITS)
    odd = np.bincount(places.astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<u8")


def band_values(least: np.ndarray) -> np.ndarray:
    """One 64-bit value for each band; equal values of different bands are told apart by the band's number."""
    grouped = least.reshape(BANDS, ROWS)
    out = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(ROWS):
        out = _stir(out ^ grouped[:, k]) * np.uint64(0x94D049BB133111EB)
    return out.view(np.int64)


def ones(sketches: np.ndarray, one: np.ndarray) -> np.ndarray:
    return np.bitwise_count(sketches ^ one).sum(axis=1, dtype=np.int64)


def _given(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    return docs.select(docs[id_col].cast("long").alias("doc"), row_hash(docs).alias("tie"), F.xxhash64(text).alias("th"), text.cast("binary").alias("text"))


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(key, doc, tie, th, n, high, low, bands, sketch) of every row; (high, low) is the digest of its set."""
    from xxhash import xxh3_128_intdigest

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = TaskContext.get().partitionId() << 33
        for batch in batches:
            made = []
            for text in batch.column("text"):
                found = shingle_set(text.as_py(), shingle)
                if not found.size:
                    made.append((key, 0, 0, 0, None, None))
                else:
                    digest, least = xxh3_128_intdigest(found.tobytes()), samples(found)
                    high, low = np.array([digest >> 64, digest & 0xFFFFFFFFFFFFFFFF], np.uint64).view(np.int64).tolist()
                    made.append((key, len(found), high, low, band_values(least).tolist(), odd_sketch(least).tobytes()))
                key += 1
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary())
            new = [pa.array([m[k] for m in made], t) for k, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([new[0], *batch.columns[:3], *new[1:]], names=["key", "doc", "tie", "th", "n", "high", "low", "bands", "sketch"])

    return _given(docs, id_col, text_col).mapInArrow(
        work, "key long, doc long, tie long, th long, n long, high long, low long, bands array<long>, sketch binary")


def _sketch_links(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches (value, node, n, sketch) ordered by value: a forest of the pairs under one value whose sketches are near."""
    value, nodes, sizes, held, links = None, [], [], [], []

    def forest() -> None:
        if len(nodes) < 2:
            return
        ids, n, sketches = np.array(nodes, np.int64), np.array(sizes, np.int64), np.frombuffer(b"".join(held), "<u8").reshape(len(held), -1)
        rest = np.arange(len(ids))
        while rest.size > 1:
            todo, rest = [int(rest[0])], rest[1:]
            while todo and rest.size:
                a = todo.pop()
                near = (ones(sketches[rest], sketches[a]) <= MAX_ONES) & (100 * np.minimum(n[rest], n[a]) >= PERCENT * np.maximum(n[rest], n[a]))
                links.extend((int(ids[a]), int(ids[b])) for b in rest[near])
                todo += rest[near].tolist()
                rest = rest[~near]

    def out() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["u", "v"])
        links.clear()
        return made

    for batch in batches:
        for v, node, n, sketch in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if v != value:
                forest()
                value, nodes, sizes, held = v, [], [], []
            nodes.append(node)
            sizes.append(n)
            held.append(sketch)
        if len(links) > 100_000:
            yield out()
    forest()
    yield out()


def candidates(nodes: DataFrame) -> DataFrame:
    """Links (u, v) that connect every pair that shares a bucket and has near sketches.  ``nodes``: (node, n, bands, sketch)."""
    table = stored(nodes.select("node", F.explode("bands").alias("value")), "band-table")
    values = stored(table.groupBy("value").agg(F.count(F.lit(1)).alias("w"), F.min("node").alias("least")).where("w > 1"), "band-values")
    total = values.agg(F.coalesce(F.sum("w"), F.lit(0))).first()[0]
    # values with over 1/1000 of these rows are fewer than 1000, whatever the input: only they are broadcast
    crowded, heavy = F.col("w") > CROWD, F.col("w") * 1000 > total
    few = table.join(F.broadcast(values.where(crowded & heavy).select("value")), "value", "left_anti")
    few = few.join(values.where(~crowded).select("value"), "value", "left_semi")
    met = few.join(nodes.select("node", "n", "sketch"), "node").select("value", "node", "n", "sketch")
    near = met.repartition("value").sortWithinPartitions("value", "node").mapInArrow(_sketch_links, "u long, v long")
    star = table.join(F.broadcast(values.where(crowded & heavy).select("value", "least")), "value")
    star = star.unionByName(table.join(values.where(crowded & ~heavy).select("value", "least"), "value"))
    return near.unionByName(star.where("node <> least").select(F.col("least").alias("u"), F.col("node").alias("v")))


class _Sets:
    """Some nodes with their sets."""

    def __init__(self, rows: list[tuple[int, bytes, bytes]]):
        self.ids = [r[0] for r in rows]
        self.sets = [np.frombuffer(r[1], "<u8") for r in rows]
        self.n = np.array([len(s) for s in self.sets], np.int64)
        self.sketches = np.frombuffer(b"".join(r[2] for r in rows), "<u8").reshape(len(rows), -1)

    def near(self, members: np.ndarray, sketch: np.ndarray, among: np.ndarray) -> np.ndarray:
        """Of the places ``among`` those whose sets overlap enough with ``members``."""
        n = len(members)
        sizes = self.n[among]
        fit = (100 * np.minimum(sizes, n) >= PERCENT * np.maximum(sizes, n)) & (ones(self.sketches[among], sketch) <= MAX_ONES)
        left = among[fit]
        if not left.size:
            return left
        every = np.concatenate([self.sets[k] for k in left.tolist()])
        at = np.minimum(np.searchsorted(members, every), n - 1)
        shared = np.add.reduceat((members[at] == every).astype(np.int64), np.concatenate([[0], np.cumsum(self.n[left])[:-1]]))
        return left[100 * shared >= PERCENT * (self.n[left] + n - shared)]


def _verified(rows: list[tuple[int, bytes, bytes]]) -> Iterator[tuple[int, int]]:
    """A forest of the pairs of one group that overlap enough; central nodes first, as they link most."""
    found = _Sets(rows)
    bits = np.unpackbits(found.sketches.view(np.uint8), axis=1, bitorder="little").mean(axis=0) > 0.5
    centre = np.packbits(bits, bitorder="little").view("<u8")
    rest = np.argsort(ones(found.sketches, centre), kind="stable")
    while rest.size > 1:
        todo, rest = [int(rest[0])], rest[1:]
        while todo and rest.size:
            a = todo.pop()
            linked = found.near(found.sets[a], found.sketches[a], rest)
            yield from ((found.ids[a], found.ids[b]) for b in linked.tolist())
            todo += linked.tolist()
            rest = rest[~np.isin(rest, linked)] if linked.size else rest


def _verify_groups(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches (root, node, members, sketch) ordered by root."""
    root, rows, links = None, [], []

    def out() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["u", "v"])
        links.clear()
        return made

    for batch in batches:
        for r, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if r != root:
                if len(rows) > 1:
                    links.extend(_verified(rows))
                root, rows = r, []
            rows.append(tuple(row))
        if len(links) > 100_000:
            yield out()
    if len(rows) > 1:
        links.extend(_verified(rows))
    yield out()


def _compare_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches (part, probe, node, members, sketch, class) ordered by part, probes first: each other node against the
    probes of its part.  Gives (u, v, far): verified links; or null and the node with its summed sketch distance."""
    part, probes, held, classes = None, [], None, None
    for batch in batches:
        found = []
        for p, probe, node, members, sketch, cls in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if p != part:
                part, probes, held = p, [], None
            if probe:
                probes.append((node, members, sketch, cls))
                continue
            if not probes:
                continue
            if held is None:
                held, classes = _Sets([x[:3] for x in probes]), np.array([x[3] for x in probes], np.int64)
            sketch = np.frombuffer(sketch, "<u8")
            among = np.nonzero(classes != cls)[0]
            linked = held.near(np.frombuffer(members, "<u8"), sketch, among) if among.size else among
            found += [(held.ids[k], node, None) for k in linked.tolist() if held.ids[k] != node]
            found.append((None, node, int(ones(held.sketches, sketch).sum())))
        yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in range(3)], names=["u", "v", "far"])


def _against(probes: DataFrame, others: DataFrame, blocks: DataFrame) -> DataFrame:
    """Every node of ``others`` against the ``probes`` of its group, in parts of bounded size: (u, v, far).

    ``blocks``: (root, salts), one row a group; broadcast only where Spark's size check allows.  The probes have a block
    number; each meets every part of the others.
    """
    cols = ["node", "members", "sketch", "cls"]
    salt = F.pmod(F.xxhash64("node", F.lit("salt")), F.col("salts"))
    count = probes.groupBy("root").agg((F.max("block") + 1).alias("n_blocks"))
    left = probes.join(blocks, "root").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)))
    left = left.select(F.xxhash64("root", "block", "salt").alias("part"), F.lit(True).alias("probe"), *cols, "root", "block", "salt")
    right = others.join(blocks, "root").join(count, "root").withColumn("salt", salt)
    right = right.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)))
    right = right.select(F.xxhash64("root", "block", "salt").alias("part"), F.lit(False).alias("probe"), *cols, "root", "block", "salt")
    both = left.unionByName(right).repartition("root", "block", "salt").sortWithinPartitions("root", "block", "salt", F.desc("probe"), "node")
    return both.select("part", "probe", *cols).mapInArrow(_compare_blocks, "u long, v long, far long")


def _large_groups(members: DataFrame) -> DataFrame:
    """Verified links of groups too large for a task.  ``members``: (root, node, n, members, sketch), stored."""
    blocks = stored(members.groupBy("root").agg(F.ceil(F.sum("n") / GROUP_SHINGLES).cast("long").alias("salts")), "large-groups")
    plain = members.withColumn("cls", F.col("node"))
    zero = F.lit(0).cast("long").alias("block")
    spread = top_k_per_group(plain, "root", [F.xxhash64("node", F.lit(SEED)), "node"], PROBES, None).select("*", zero)
    first = stored(_against(spread, plain, blocks), "large-first")
    far = first.where("far is not null").select(F.col("v").alias("node"), "far")
    middle = top_k_per_group(plain.join(far, "node"), "root", ["far", "node"], PROBES, None).drop("far").select("*", zero)
    second = _against(middle, plain, blocks)
    links = stored(first.where("u is not null").select("u", "v").unionByName(second.where("u is not null").select("u", "v")).distinct(), "large-links")
    classes = stored(_classes(members, links), "large-classes")
    sizes = classes.groupBy("root", "cls").agg(F.count(F.lit(1)).alias("size"))
    largest = top_k_per_group(sizes, "root", [F.desc("size"), "cls"], 1, None).select("root", F.col("cls").alias("main"))
    outside = stored(classes.join(largest, "root").where("cls <> main").select("root", "node", "cls", "n"), "large-outside")
    if outside.isEmpty():
        return links
    # blocks of the outside nodes by running sums of their sizes within hashed parts of their group, so no task sorts a whole group
    salted = outside.join(blocks, "root").withColumn("piece", F.pmod(F.xxhash64("node", F.lit("piece")), F.col("salts")))
    running = F.sum("n").over(W.partitionBy("root", "piece").orderBy("node").rowsBetween(W.unboundedPreceding, -1))
    placed = salted.withColumn("_b", F.floor(F.coalesce(running, F.lit(0)) / GROUP_SHINGLES)).withColumn("block", (F.col("_b") * F.col("salts") + F.col("piece")).cast("long"))
    probes = members.join(placed.select("node", "cls", "block"), "node")
    others = members.join(classes.select("node", "cls"), "node")
    third = _against(probes, others, blocks).where("u is not null").select("u", "v")
    return links.unionByName(third)


def _classes(members: DataFrame, links: DataFrame) -> DataFrame:
    """(root, node, n, cls): each node's class by ``links``; a node without one is its own."""
    found = components(links).select("node", F.col("root").alias("_cls"))
    return members.select("root", "node", "n").join(found, "node", "left").select("root", "node", "n", F.coalesce("_cls", "node").alias("cls"))


def _likely(given: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of ``given`` whose text may be wanted (column th of both), so the other texts are not shuffled.

    Each wanted hash marks one of MARKS bits; a row goes whose bit is not marked.  Rows marked by chance
    stay until the join: with very many wanted texts all do, and nothing but time is lost.
    """
    bit = F.pmod("th", F.lit(MARKS))
    piece, place = F.floor(bit / MARKED).cast("int").alias("_piece"), (bit % MARKED).alias("_place")
    marks = wanted.select(piece, place).groupBy("_piece").agg(F.bitmap_construct_agg("_place").alias("_marks"))
    met = given.select("*", piece, place).join(F.broadcast(marks), "_piece")  # at most MARKS / MARKED rows of 4 KB
    marked = "shiftright(cast(conv(hex(substring(_marks, cast(_place div 8 as int) + 1, 1)), 16, 10) as int), cast(_place % 8 as int)) & 1 = 1"
    return met.where(marked).select(*given.columns)


def _group_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(root, node, n, members, sketch) of the nodes in ``wanted`` (th, root, node, w: rows of the node), from one text each."""
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(t.as_py(), shingle) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([
                batch.column("root"), batch.column("node"), pa.array([len(f) for f in found], pa.int64()),
                pa.array([f.tobytes() for f in found], pa.binary()), pa.array([odd_sketch(samples(f)).tobytes() for f in found], pa.binary()),
            ], names=["root", "node", "n", "members", "sketch"])

    total = wanted.agg(F.coalesce(F.sum("w"), F.lit(0))).first()[0]
    given = _likely(_given(docs, id_col, text_col).select("th", "tie", "text"), wanted)
    met = attach(given, wanted, ["th"], "w", total, F.col("tie")).where("node is not null")
    # copies of a text are one row a task before the shuffle
    once = met.groupBy("th", "root", "node").agg(F.first("text").alias("text")).select("root", "node", "text")
    return once.mapInArrow(work, "root long, node long, n long, members binary, sketch binary")


def verified_links(docs: DataFrame, nodes: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Links (u, v) between nodes, confirmed on full sets, that connect what the threshold connects."""
    roots = components(candidates(nodes.select("node", "n", "bands", "sketch")))
    wanted = stored(nodes.select("node", "th", "w").join(roots, "node").select("th", "root", "node", "w"), "wanted-texts")
    members = stored(_group_sets(docs, wanted, id_col, text_col, shingle), "group-sets")
    sizes = members.groupBy("root").agg(F.sum("n").alias("_all"))
    large = stored(sizes.where(F.col("_all") > GROUP_SHINGLES).select("root"), "large-roots")
    total = members.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # groups with over 1/1000 of all shingles are fewer than 1000; they leave before the others are shuffled by group
    heavy = sizes.where((F.col("_all") * 1000 > total) & (F.col("_all") > GROUP_SHINGLES)).select("root")
    small = members.join(F.broadcast(heavy), "root", "left_anti").join(large, "root", "left_anti")
    small = small.select("root", "node", "members", "sketch").repartition("root").sortWithinPartitions("root", "node")
    links = small.mapInArrow(_verify_groups, "u long, v long")
    if large.isEmpty():
        return links
    light = large.join(heavy, "root", "left_anti")
    big = members.join(F.broadcast(heavy), "root", "left_semi").unionByName(members.join(light, "root", "left_semi"))
    return links.unionByName(_large_groups(stored(big, "large-sets")))


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc, tie, n, component_id, root) of every row; root is null for empty sets."""
    rows = stored(signatures(docs, id_col, text_col, shingle), "signatures")
    full = rows.where("n > 0")
    sets = stored(full.groupBy("high", "low").agg(F.min("key").alias("node"), F.min("doc").alias("least"), F.count(F.lit(1)).alias("w")), "distinct-sets")
    one = full.select(F.col("key").alias("node"), "th", "n", "bands", "sketch")
    nodes = stored(one.join(sets.select("node", "w"), "node"), "set-nodes")
    roots = components(verified_links(docs, nodes, id_col, text_col, shingle))
    rooted = stored(sets.join(roots, "node", "left").select("high", "low", "least", "w", F.coalesce("root", "node").alias("root")), "set-roots")
    least = stored(rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("w").alias("_all")), "set-components")
    total = least.agg(F.coalesce(F.sum("_all"), F.lit(0))).first()[0]
    named = attach(rooted.select("high", "low", "root", "w"), least, ["root"], "_all", total, F.col("low"))
    named = stored(named.select("high", "low", "root", "component_id", "w"), "set-names")
    met = attach(full.select("key", "doc", "tie", "n", "high", "low"), named, ["high", "low"], "w", total, F.col("key"))
    empty = rows.where("n = 0").select("doc", "tie", "n", F.col("doc").alias("component_id"), F.lit(None).cast("long").alias("root"))
    return met.select("doc", "tie", "n", "component_id", "root").unionByName(empty)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with one row of each component: the one with the component's id (of several, the least row hash).

    Rows with empty sets are linked with nothing, so all of them stay but repeats of the whole row.
    """
    classes = near_classes(docs, id_col, text_col, shingle).where(F.col("doc").eqNullSafe(F.col("component_id")))
    linked = classes.where("root is not null").groupBy("root").agg(F.min(F.struct("tie", "doc")).alias("k")).select(F.col("k.doc").alias("_kid"), F.col("k.tie").alias("_kkey"))
    empty = classes.where("root is null").select(F.col("doc").alias("_kid"), F.col("tie").alias("_kkey")).distinct()
    return keep_rows(docs, linked.unionByName(empty), id_col, "hash", text_col)


def op11_minhash_dedup(documents: DataFrame) -> DataFrame:
    found = near_classes(documents)
    return found.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id", F.col("doc").eqNullSafe(F.col("component_id")).alias("kept"))
