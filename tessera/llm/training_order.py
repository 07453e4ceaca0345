"""Training-order materialisation: token sequences in a keyed order, in fixed-stride binary shards.

1. Documents become sequences of at most ``length`` token ids (each document ends with the end id).
   A sequence's number is (doc_id - least id) * PIECES and a hash of its piece and token ids below
   PIECES, so rows of one doc_id spread: known to its task alone, the same on every cluster, with gaps.
2. A keyed Feistel network permutes the smallest even power of two that holds all numbers; a value
   beyond the last number walks on along its cycle.  So every sequence has its place in one keyed
   order of all numbers, without a sort or a counting pass.
3. Equal ranges of that order are the shards, counted by the bytes of text or, if that is more, of
   one record a row.  One task a range sorts its sequences and writes them
   as records of a fixed stride: header (doc_id i64, piece i32, length i32) and ids (u16, zeros
   behind the last).  A shard is written under an attempt's own name and then renamed, so a retried
   or duplicated task leaves whole files only.
4. The shards' counts (one row each) close the gaps: a sequence's global slot is its shard's first
   slot plus its record's number.  They are kept beside the shards.

Slot s is at byte (s - first slot) * stride of its shard: readers start and resume anywhere by
seeking.  The order is a function of the key and the ids.  Tokens are shuffled once; no copy of
them is kept besides.

Defined results: null and empty texts give one sequence with the end id; a null doc_id comes before
the least id in number, is written as the least long and read as null; sequences of equal number
stand next to each other, ordered by their ids (equal copies under one doc_id always do, in one
shard); an empty table writes no shard.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.tokens import pieces, vocabulary_path
from tessera.session import fresh_path

LENGTH = 512
#: Bytes of text, or of the rows' first records, for each shard.
SHARD_TEXT = 16_000_000
#: Numbers kept for each document's sequences.
PIECES = 1 << 20
#: Numbers stay below this; ids that spread wider are hashed into fewer.
MOST_NUMBERS = 1 << 61
KEY = 0x5EED
ROUNDS = 6
#: Records read at once, and bytes of records for each reading task.
READ_RECORDS, READ_TASK = 8192, 64_000_000
HEADER = struct.Struct("<qii")
NO_ID = -(1 << 63)


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    """A 64-bit finaliser (multiplications and shifts) of x and a round key."""
    x = (x + np.uint64(key)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(32)


def round_keys(key: int) -> list[int]:
    return [(key * 0x9E3779B97F4A7C15 + (k + 1) * 0xD1B54A32D192ED03) & 0xFFFFFFFFFFFFFFFF for k in range(ROUNDS)]


def permute(numbers: np.ndarray, n: int, key: int) -> np.ndarray:
    """The slots of ``numbers`` (each in 0..n-1) under the keyed permutation of 0..n-1."""
    half = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)
    bits, mask = np.uint64(half), np.uint64((1 << half) - 1)
    out = numbers.astype(np.uint64)
    todo = np.arange(len(out))
    while todo.size:
        x = out[todo]
        left, right = x >> bits, x & mask
        for k in round_keys(key):
            left, right = right, left ^ (_mix(right, k) & mask)
        out[todo] = left << bits | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def _record(doc: int | None, piece: int, ids: bytes, size: int) -> bytes:
    return HEADER.pack(NO_ID if doc is None else doc, piece, len(ids) // 2) + ids.ljust(size, b"\0")


def _parsed(content: bytes, at: int) -> tuple[int | None, int, np.ndarray]:
    doc, piece, used = HEADER.unpack_from(content, at)
    return None if doc == NO_ID else doc, piece, np.frombuffer(content, "<u2", used, at + HEADER.size)


def stride(length: int) -> int:
    return HEADER.size + 2 * length


def _shard_name(shard: int) -> str:
    return f"shard-{shard:08d}.bin"


def write_shards(docs: DataFrame, path: str, length: int = LENGTH, key: int = KEY, shard_text: int = SHARD_TEXT, vocabulary: str | None = None,
                 id_col: str = "doc_id", text_col: str = "text") -> list[tuple[int, int]]:
    """Write the sequences of ``docs`` into ``path``: (shard, records) of every shard, ordered."""
    doc = F.col("doc_id")
    least, most, size, rows = docs.select(docs[id_col].cast("long").alias("doc_id"), F.octet_length(docs[text_col].cast("string")).alias("n")).agg(
        F.coalesce(F.min(doc), F.lit(0)), F.coalesce(F.max(doc), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    wide = (most - least + 2) * PIECES > MOST_NUMBERS
    documents = MOST_NUMBERS // PIECES if wide else most - least + 2
    n = documents * PIECES
    shards = max(1, -(-max(size, rows * stride(length)) // shard_text))
    width = -(-n // shards)

    def places(docs: list, pieces: list, crcs: list) -> np.ndarray:
        if wide:
            given = np.array([NO_ID if d is None else d for d in docs], np.int64)
            ordinal = (_mix(given.view(np.uint64), key) % np.uint64(documents)).astype(np.int64)
        else:
            ordinal = np.array([0 if d is None else d - least + 1 for d in docs], np.int64)
        spread = _mix(np.array(pieces, np.uint64) << np.uint64(32) | np.array(crcs, np.uint64), key) % np.uint64(PIECES)
        return permute(ordinal * PIECES + spread.astype(np.int64), n, key)

    made = pieces(docs, length, vocabulary or vocabulary_path(), with_ids=True, place=places, id_col=id_col, text_col=text_col)
    placed = made.select("doc_id", "piece", "ids", "place", F.expr(f"cast(place div {width} as int)").alias("shard"))
    ordered = placed.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "place", "doc_id", "piece", "ids").drop("place")
    record_size = 2 * length

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(path)
        store.create_dir(base, recursive=True)
        attempt, now, sink, counts = uuid.uuid4().hex, None, None, {}

        def close() -> None:
            if sink is not None:
                sink.close()
                store.move(f"{base}/_{attempt}-{now}", f"{base}/{_shard_name(now)}")

        for batch in batches:
            for shard, doc, piece, ids in zip(*(batch.column(c).to_pylist() for c in ("shard", "doc_id", "piece", "ids")), strict=True):
                if shard != now:
                    close()
                    now, sink = shard, store.open_output_stream(f"{base}/_{attempt}-{shard}")
                sink.write(_record(doc, piece, ids, record_size))
                counts[shard] = counts.get(shard, 0) + 1
        close()
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in (counts.keys(), counts.values())], names=["shard", "records"])

    return sorted((r["shard"], r["records"]) for r in ordered.mapInArrow(write, "shard long, records long").collect())


def first_slots(written: list[tuple[int, int]]) -> dict[int, int]:
    """The global slot of each shard's first record."""
    out, at = {}, 0
    for shard, records in written:
        out[shard] = at
        at += records
    return out


def read_shards(spark: SparkSession, path: str, written: list[tuple[int, int]], length: int = LENGTH) -> DataFrame:
    """Every record of the shards: doc_id, piece, n_tokens, slot, shard, byte_offset, ids_crc32 (of 32-bit ids)."""
    size, first = stride(length), first_slots(written)
    ranges = [(shard, at, min(READ_RECORDS, records - at), first[shard] + at) for shard, records in written for at in range(0, records, READ_RECORDS)]
    tasks = max(1, min(len(ranges), max(spark.sparkContext.defaultParallelism, -(-sum(r[2] for r in ranges) * size // READ_TASK))))
    given = spark.createDataFrame([(k % tasks, *r) for k, r in enumerate(ranges)], "task int, shard long, first long, records long, slot long")
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    names = ["doc_id", "piece", "n_tokens", "slot", "shard", "byte_offset", "ids_crc32"]

    def parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(path)
        for batch in batches:
            for shard, at, records, slot in zip(*(batch.column(c).to_pylist() for c in ("shard", "first", "records", "slot")), strict=True):
                with store.open_input_file(f"{base}/{_shard_name(shard)}") as f:
                    f.seek(at * size)
                    content = f.read(records * size)
                if len(content) != records * size:
                    raise ValueError(f"shard {shard}: {len(content)} bytes from record {at} on are no {records} records")
                found = []
                for k in range(records):
                    doc, piece, ids = _parsed(content, k * size)
                    found.append((doc, piece, len(ids), slot + k, shard, (at + k) * size, zlib.crc32(ids.astype("<u4").tobytes())))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)], names=names)

    return given.repartitionById(tasks, F.col("task")).mapInArrow(parse, "doc_id long, piece int, n_tokens int, slot long, shard long, byte_offset long, ids_crc32 long")


def resume(path: str, written: list[tuple[int, int]], slot: int, length: int = LENGTH) -> Iterator[tuple[int, int | None, int, np.ndarray]]:
    """(slot, doc_id, piece, ids) from ``slot`` on, reading sequentially: what a training job does."""
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(path)
    size, first = stride(length), first_slots(written)
    for shard, records in written:
        if slot >= first[shard] + records:
            continue
        with store.open_input_file(f"{base}/{_shard_name(shard)}") as f:
            f.seek((slot - first[shard]) * size)
            while record := f.read(size):
                yield slot, *_parsed(record, 0)
                slot += 1


def materialised(docs: DataFrame, length: int = LENGTH, key: int = KEY, shard_text: int = SHARD_TEXT, vocabulary: str | None = None) -> tuple[str, list[tuple[int, int]]]:
    """Write ``docs`` in training order; the shards' folder and (shard, records), also kept in its folder ``counts``."""
    spark = docs.sparkSession
    path = fresh_path(spark, "training-order")
    written = write_shards(docs, path, length, key, shard_text, vocabulary)
    spark.createDataFrame(written, "shard long, records long").coalesce(1).write.json(f"{path}/counts")
    return path, written


def op3_training_order(documents: DataFrame) -> DataFrame:
    """The sequences as read back from the written shards."""
    spark = documents.sparkSession
    path, written = materialised(documents)
    if not written:
        return spark.createDataFrame([], "doc_id long, piece int, n_tokens int, slot long, shard long, byte_offset long, ids_crc32 long")
    return read_shards(spark, path, written)
