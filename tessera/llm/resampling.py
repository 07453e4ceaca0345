"""Target-distribution importance resampling.

Features are runs of 1 to ``grams`` consecutive words, hashed into ``buckets`` buckets.  Counting all
documents and all target texts gives each bucket a gain, the log ratio of its smoothed shares; the
gains are an array of ``buckets`` numbers, so every task holds it and a document's weight is a sum of
array places.  A Gumbel term drawn from the id makes the highest scores a draw without replacement in
proportion to the weights.

The cutoff: a mergeable quantile sketch brackets the score of the last document drawn.  Exact counts
outside the bracket say whether it holds the cutoff; if not it is widened and counted again, up to
all scores.  Only the bracket is sorted to find the cutoff.  Those above it are drawn anyway and are
numbered by ranges for their ranks.

Driver and tasks hold the ``buckets`` counts, the sketch and the splitters of the numbering.  Scored
rows are written once, so ranks refer to fixed rows.

Defined results: null texts have no features, weight 0, and are not drawn (too few words); a null id
is drawn by the hash of the seed alone and ranks after all ids of its score; rows equal in score and id
are ordered by their number of features, then by their place in the scored table; every repeated row
is drawn or left by itself; with an empty target all gains come from the smoothing.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tessera.llm.common import masked, stored
from tessera.operators.positional import global_row_number

BUCKETS = 10_000
GRAMS = 1
MIN_WORDS = 20
PERCENT = 10
SEED = 2024
SCALE = 1000
#: Relative accuracy of the quantile sketch is 1 / SKETCH; the first bracket is twice as wide on each side.
SKETCH = 10_000
#: Words whose bucket a task remembers; the memory starts anew when full.
REMEMBERED = 1 << 19

# words: bytes 0-9, a-z and all above 7F, after A-Z in lower case; everything else parts them
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


class _Buckets(dict):
    def __init__(self, buckets: int):
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[feature] = zlib.crc32(feature) % self.buckets
        return found


def features(text: bytes | None, grams: int, bucket_of) -> tuple[int, list[int]]:
    """The number of words of a UTF-8 text and the buckets of its features, repeats included."""
    words = (text or b"").translate(_FOLD).split()
    found = [bucket_of(w) for w in words]
    for n in range(2, grams + 1):
        found += [bucket_of(b" ".join(words[k:k + n])) for k in range(len(words) - n + 1)]
    return len(words), found


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS, grams: int = GRAMS) -> np.ndarray:
    """How many features of all texts fall in each bucket.  Each task adds up its own before the shuffle."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket_of, total = _Buckets(buckets).__getitem__, np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0):
                found = features(text.as_py(), grams, bucket_of)[1]
                if found:
                    total += np.bincount(found, minlength=buckets)
        held = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int64)), pa.array(total[held])], names=["bucket", "n"])

    given = texts.select(texts[text_col].cast("string").cast("binary").alias("text"))
    rows = given.mapInArrow(work, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(buckets, np.int64)
    for r in rows:
        counts[r["bucket"]] = r["n"]
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(SCALE * ln) of each bucket's smoothed share in the target over that in the source."""
    size, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    ratio = [(t + 1.0) * (s_all + float(size)) / ((s + 1.0) * (t_all + float(size))) for s, t in zip(source.tolist(), target.tolist(), strict=True)]
    return np.array([math.floor(SCALE * math.log(r)) for r in ratio], np.int64)


def gumbel(doc: int | None, seed: int) -> int:
    """floor(-SCALE * ln(-ln(u))), u from the first 8 hex digits of SHA-256 of ``seed:doc``."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
    return math.floor(-SCALE * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (),
           buckets: int = BUCKETS, grams: int = GRAMS, seed: int = SEED) -> DataFrame:
    """``carry`` columns of every row and doc, words, n_features, weight, score and row (a number of its own); stored."""
    gain = gains(bucket_counts(docs, text_col, buckets, grams), bucket_counts(target, text_col, buckets, grams))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket_of, row = _Buckets(buckets).__getitem__, TaskContext.get().partitionId() << 33
        for batch in batches:
            docs_, made = batch.column("doc").to_pylist(), []
            for doc, text in zip(docs_, batch.column("text"), strict=True):
                words, found = features(text.as_py(), grams, bucket_of)
                weight = int(gain[found].sum()) if found else 0
                made.append((words, len(found), weight, weight + gumbel(doc, seed), row))
                row += 1
            new = [pa.array([m[k] for m in made], pa.int64()) for k in range(5)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *new], names=[*batch.schema.names[:-1], *_MADE])

    given = docs.select(*[docs[c] for c in carry], docs[id_col].cast("long").alias("doc"), docs[text_col].cast("string").cast("binary").alias("text"))
    schema = StructType([*given.schema.fields[:-1], *[StructField(c, LongType()) for c in _MADE]])
    return stored(given.mapInArrow(work, schema), "resampling-scores")


_MADE = ("words", "n_features", "weight", "score", "row")


def bracket(scores: DataFrame, wanted: int, total: int) -> tuple[int, int, int]:
    """(low, high, above): the ``wanted``-th highest score lies in [low, high]; ``above`` scores are higher than it."""
    margin = 2 / SKETCH
    while True:
        at = 1 - wanted / total
        low, high = scores.agg(F.percentile_approx("score", [max(0.0, at - margin), min(1.0, at + margin)], SKETCH)).first()[0]
        if margin >= 1:
            low, high = scores.agg(F.min("score"), F.max("score")).first()
        above, reach = scores.agg(F.count_if(F.col("score") > high), F.count_if(F.col("score") >= low)).first()
        if above < wanted <= reach:
            return low, high, above
        margin *= 8


def ranked(rows: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """``rows`` (of :func:`scored`) with rank: 1, 2, ... for those drawn, null for the others."""
    fits = F.col("words") >= min_words
    fit = rows.where(fits)
    total = fit.count()
    wanted = total * percent // 100
    none = F.lit(None).cast("long").alias("rank")
    if not wanted:
        return rows.select("*", none)
    low, high, above = bracket(fit, wanted, total)
    order = [("score", "desc"), "_no_id", "doc", "n_features", "row"]
    marked = fit.withColumn("_no_id", F.col("doc").isNull())
    inside = global_row_number(marked.where(F.col("score").between(low, high)), order, "rank")
    rank = (F.col("rank") + above).cast("long")
    inside = inside.withColumn("rank", F.when(rank <= wanted, rank)).drop("_no_id")
    out = rows.where(~fits | (F.col("score") < low)).select("*", none).unionByName(inside)
    if above:
        top = global_row_number(marked.where(F.col("score") > high), order, "rank")
        out = out.unionByName(top.withColumn("rank", F.col("rank").cast("long")).drop("_no_id"))
    return out


def resampled(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT,
              min_words: int = MIN_WORDS, buckets: int = BUCKETS, grams: int = GRAMS, seed: int = SEED) -> DataFrame:
    """The drawn rows of ``docs``, ``percent`` of those with at least ``min_words`` words, closest to ``target``."""
    hidden, names = masked(docs)
    rows = scored(hidden, target.select(target[text_col].alias(names[text_col])), names[id_col], names[text_col], tuple(hidden.columns), buckets, grams, seed)
    drawn = ranked(rows, percent, min_words).where("rank is not null")
    return drawn.select(*[F.col(n).alias(c) for c, n in names.items()])


def op13_importance_resampling(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = ranked(scored(documents, benchmark))
    return found.select(F.col("doc").alias("doc_id"), "n_features", "weight", "score", "rank")


_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: CRC-32 bit by bit: a byte is mixed in, then eight shifts (-1) follow.
ORACLE_SQL = f"""with dw as (
  select row_number() over () as r, doc_id, regexp_extract_all({_LOWER}, '{_WORD}') as ws from documents),
bw as (select unnest(regexp_extract_all({_LOWER}, '{_WORD}')) as w from benchmark),
words as (select r, unnest(ws) as w from dw),
vocabulary as (select distinct w from (select w from words union all select w from bw)),
steps as (select w, flatten(list_transform(range(1, cast(length(hex(encode(w))) / 2 as bigint) + 1),
    lambda i: [cast(concat('0x', substr(hex(encode(w)), cast(2 * i - 1 as bigint), 2)) as bigint), -1, -1, -1, -1, -1, -1, -1, -1])) as bs from vocabulary),
crc as (select w, xor(list_reduce(list_prepend(cast(4294967295 as bigint), bs),
    lambda a, x: case when x >= 0 then xor(a, x) else xor(a >> 1, (a & 1) * 3988292384) end), 4294967295) % {BUCKETS} as b from steps),
s as (select b, count(*) as s from words join crc using (w) group by b),
t as (select b, count(*) as t from bw join crc using (w) group by b),
sizes as (select cast((select count(*) from words) as double) as s_all, cast((select count(*) from bw) as double) as t_all),
gain as (select b, cast(floor({SCALE} * ln((coalesce(t, 0) + 1.0::double) * (s_all + {BUCKETS}) / ((s + 1.0::double) * (t_all + {BUCKETS})))) as bigint) as g
  from s left join t using (b), sizes),
weights as (select r, cast(sum(g) as bigint) as weight from words join crc using (w) join gain using (b) group by r),
scored as (select dw.r, doc_id, cast(len(ws) as bigint) as n_features, coalesce(weight, 0) as weight,
    cast(concat('0x', substr(sha256(concat('{SEED}:', coalesce(cast(doc_id as varchar), ''))), 1, 8)) as bigint) as h
  from dw left join weights using (r)),
final as (select *, weight + cast(floor(-{SCALE} * ln(-ln((h + 0.5::double) / 4294967296::double))) as bigint) as score from scored),
fit as (select r, row_number() over (order by score desc, doc_id nulls last, n_features, r) as rank, count(*) over () as n from final where n_features >= {MIN_WORDS})
select doc_id, n_features, weight, score, cast(case when rank <= n * {PERCENT} // 100 then rank end as bigint) as rank
from final left join fit using (r)"""
