"""Exact deduplication with a cuckoo-filter index.

Texts are compared by the SHA-256 of their bytes.  A digest's 16-bit fingerprint lives in one of
two buckets of four slots (partial-key cuckoo hashing).  A lookup that finds no fingerprint proves
the digest new; a hit is only a candidate and is verified against the whole 32-byte digest stored
with the slot.  Live digests can be deleted.  When an insertion finds no place the table doubles
and is rebuilt from the stored keys, so nothing is ever dropped.

On Spark the index is sharded by digest.  Each map task first folds its own rows through an index
(a group holding a third of all rows leaves one entry per task), then each shard folds the entries
of its digests.

Defined results: a null text counts as empty; empty texts are equal to each other; a null id ranks
below every id, a class with null ids only has keep_id null; rows repeating id and text are members
of the class each (``group_size`` counts them) and carry the same flags, and ``deduplicated`` leaves
one of them; an empty table gives an empty result.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import attach, keep_rows, stored

SLOTS = 4
MAX_KICKS = 200
#: A map task hands on its entries when it has this many: its memory stays bounded.
FLUSH_ENTRIES = 500_000
ENTRY_DDL = "digest binary, keep_id long, group_size long, n_keep long"
_ARROW = pa.schema([("digest", pa.binary()), ("keep_id", pa.int64()), ("group_size", pa.int64()), ("n_keep", pa.int64())])


class CuckooIndex:
    """Live digests with, for each, the largest id, the number of rows and the rows with that id."""

    def __init__(self, buckets: int = 1024):
        self.digest: list[bytes | None] = []
        self.keep_id: list[int | None] = []
        self.size: list[int] = []
        self.n_keep: list[int] = []
        self.free: list[int] = []
        self._clear(buckets)

    def _clear(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.tag = array("H", bytes(2 * SLOTS * buckets))
        self.entry = array("i", bytes(4 * SLOTS * buckets))

    def __len__(self) -> int:
        return len(self.digest) - len(self.free)

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        tag = int.from_bytes(digest[:2], "little") or 1
        first = int.from_bytes(digest[2:10], "little") & self.mask
        return tag, first, self._other(first, tag)

    def _other(self, bucket: int, tag: int) -> int:
        return (bucket ^ (tag * 0x9E3779B1)) & self.mask

    def _slot(self, digest: bytes) -> int:
        """The slot that holds ``digest``; -1 if it isn't live.  Tag hits are verified."""
        tag, first, second = self._places(digest)
        for bucket in (first, second):
            at = bucket * SLOTS
            for slot in range(at, at + SLOTS):
                if self.tag[slot] == tag and self.digest[self.entry[slot]] == digest:
                    return slot
        return -1

    def __contains__(self, digest: bytes) -> bool:
        return self._slot(digest) >= 0

    def _place(self, tag: int, first: int, second: int, entry: int) -> bool:
        tags, entries = self.tag, self.entry
        for bucket in (first, second):
            at = bucket * SLOTS
            for slot in range(at, at + SLOTS):
                if not tags[slot]:
                    tags[slot], entries[slot] = tag, entry
                    return True
        bucket = second
        for kick in range(MAX_KICKS):
            slot = bucket * SLOTS + (entry + kick) % SLOTS
            tags[slot], tag = tag, tags[slot]
            entries[slot], entry = entry, entries[slot]
            bucket = self._other(bucket, tag)
            at = bucket * SLOTS
            for slot in range(at, at + SLOTS):
                if not tags[slot]:
                    tags[slot], entries[slot] = tag, entry
                    return True
        return False

    def _resize(self) -> None:
        """Double the table until every stored key finds a place."""
        buckets = self.mask + 1
        while True:
            buckets *= 2
            self._clear(buckets)
            if all(self._place(*self._places(d), e) for e, d in enumerate(self.digest) if d is not None):
                return

    def add(self, digest: bytes, keep_id: int | None, size: int = 1, n_keep: int = 1) -> bool:
        """Insert, or fold into the live digest; True if it was new."""
        slot = self._slot(digest)
        if slot >= 0:
            e = self.entry[slot]
            self.size[e] += size
            old = self.keep_id[e]
            if keep_id == old:
                self.n_keep[e] += n_keep
            elif old is None or (keep_id is not None and keep_id > old):
                self.keep_id[e], self.n_keep[e] = keep_id, n_keep
            return False
        if self.free:
            e = self.free.pop()
            self.digest[e], self.keep_id[e], self.size[e], self.n_keep[e] = digest, keep_id, size, n_keep
        else:
            e = len(self.digest)
            self.digest.append(digest)
            self.keep_id.append(keep_id)
            self.size.append(size)
            self.n_keep.append(n_keep)
        if not self._place(*self._places(digest), e):
            self._resize()  # the evicted key is still stored, so the rebuild places it too
        return True

    def delete(self, digest: bytes) -> bool:
        """Remove a live digest; False if it isn't live (a mere tag hit deletes nothing)."""
        slot = self._slot(digest)
        if slot < 0:
            return False
        e = self.entry[slot]
        self.tag[slot] = 0
        self.digest[e] = None
        self.free.append(e)
        return True

    def batches(self, rows: int = 50_000) -> Iterator[pa.RecordBatch]:
        live = [e for e, d in enumerate(self.digest) if d is not None]
        for at in range(0, len(live), rows):
            part = live[at:at + rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array([col[e] for e in part], kind) for col, kind in zip(
                    (self.digest, self.keep_id, self.size, self.n_keep), _ARROW.types, strict=True)],
                schema=_ARROW,
            )


def _fold_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    index = CuckooIndex()
    for batch in batches:
        for digest, doc in zip(batch.column("digest").to_pylist(), batch.column("doc").to_pylist(), strict=True):
            index.add(digest, doc)
        if len(index) >= FLUSH_ENTRIES:
            yield from index.batches()
            index = CuckooIndex()
    yield from index.batches()


def _fold_entries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries ordered by digest: inserted, then those without a size deleted.  All rows of a digest stand together, so an
    index of ``FLUSH_ENTRIES`` entries is given out and started anew at the next digest: memory stays bounded."""
    index, retired, last = CuckooIndex(), [], None
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in _ARROW.names), strict=True):
            if row[0] != last and len(index) + len(retired) >= FLUSH_ENTRIES:
                for digest in retired:
                    index.delete(digest)
                yield from index.batches()
                index, retired = CuckooIndex(), []
            last = row[0]
            if row[2] is None:
                retired.append(row[0])
            else:
                index.add(*row)
    for digest in retired:
        index.delete(digest)
    yield from index.batches()


def _folded(entries: DataFrame) -> DataFrame:
    return entries.repartition("digest").sortWithinPartitions("digest").mapInArrow(_fold_entries, ENTRY_DDL)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, digest) of every row."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    return docs.select(docs[id_col].cast("long").alias("doc"), F.unhex(F.sha2(text, 256)).alias("digest"))


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index of ``docs``: one row per live digest (digest, keep_id, group_size, n_keep)."""
    partial = digests(docs, id_col, text_col).mapInArrow(_fold_rows, ENTRY_DDL)
    return _folded(partial)


def insert(index: DataFrame, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``index`` with the rows of ``docs`` folded in."""
    new = digests(docs, id_col, text_col).mapInArrow(_fold_rows, ENTRY_DDL)
    return _folded(index.unionByName(new))


def delete(index: DataFrame, docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``index`` without the digests of the texts in ``docs``; unknown texts change nothing."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    gone = docs.select(F.unhex(F.sha2(text, 256)).alias("digest")).distinct()
    none = [F.lit(None).cast("long").alias(c) for c in ("keep_id", "group_size", "n_keep")]

    return _folded(index.unionByName(gone.select("digest", *none)))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc, keep_id, group_size, kept, text_sha256."""
    index = stored(build_index(docs, id_col, text_col), "cuckoo-index")
    total = index.agg(F.coalesce(F.sum("group_size"), F.lit(0))).first()[0]
    rows = attach(digests(docs, id_col, text_col), index, ["digest"], "group_size", total, F.col("doc"))
    return rows.select(
        "doc", "keep_id", "group_size",
        F.col("doc").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class of equal texts: the one with the largest id.

    Of rows that repeat id and text, the one whose whole row hashes lowest stays.
    """
    index = stored(build_index(docs, id_col, text_col), "cuckoo-index")
    keepers = index.select(F.col("keep_id").alias("_kid"), F.col("digest").alias("_kkey"))
    return keep_rows(docs, keepers, id_col, "digest", text_col)


def op7_exact_dedup(documents: DataFrame) -> DataFrame:
    out = classes(documents)
    return out.select(F.col("doc").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


ORACLE_SQL = """
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
       doc_id is not distinct from max(doc_id) over w as kept, sha256(coalesce(text, '')) as text_sha256
from documents
window w as (partition by coalesce(text, ''))
"""
