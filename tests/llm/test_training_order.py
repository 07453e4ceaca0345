import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from tessera.llm import training_order as X
from tessera.llm.tokens import vocabulary_path


def expected(rows):
    tokenizer, out = Tokenizer.from_file(vocabulary_path()), Counter()
    for doc, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), X.LENGTH):
            part = ids[k:k + X.LENGTH]
            out[(doc, k // X.LENGTH, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
    return out


def check(docs):
    rows = X.op3_training_order(docs).collect()
    given = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert Counter((r.doc_id, r.piece, r.n_tokens, r.ids_crc32) for r in rows) == expected(given)
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    first = {}
    for r in rows:
        first[r.shard] = min(r.slot, first.get(r.shard, r.slot))
    assert all(r.byte_offset == (r.slot - first[r.shard]) * X.stride(X.LENGTH) for r in rows)
    return rows


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 16, 17, 255, 1000, 65_537])
def test_permutation(n):
    slots = X.permute(np.arange(n), n, 7)
    assert sorted(slots.tolist()) == list(range(n))
    if n > 200:
        assert (slots != X.permute(np.arange(n), n, 8)).mean() > 0.9
        assert (slots == np.arange(n)).mean() < 0.05
        assert slots[100] == X.permute(np.array([100]), n, 7)[0]  # one number alone


def test_query_round_trip(documents):
    check(documents)


def test_awkward_rows(awkward, no_documents):
    check(awkward)
    assert X.op3_training_order(no_documents).count() == 0


def test_shards_are_read_from_any_slot(documents):
    path, written = X.materialised(documents.limit(40), length=64, key=3, shard_text=9000)
    whole = list(X.resume(path, written, 0, 64))
    n = sum(records for _, records in written)
    assert len(written) > 3 and [s for s, *_ in whole] == list(range(n)) and n > 150
    for start in (0, written[0][1] - 1, written[0][1], n // 2, n - 1):
        for got, want in zip(X.resume(path, written, start, 64), whole[start:], strict=True):
            assert got[:3] == want[:3] and got[3].tolist() == want[3].tolist()
    assert list(X.resume(path, written, n, 64)) == []


def test_order_depends_on_key_and_ids_only(documents):
    def order(docs, key):
        return [(d, p) for _, d, p, _ in X.resume(*X.materialised(docs, key=key), 0)]

    one = order(documents.repartition(1), 1)
    assert one == order(documents.repartition(5, "text"), 1) != order(documents, 2)


def test_ids_spread_over_all_longs(spark):
    check(spark.createDataFrame([(-(1 << 62), "a"), (1 << 62, "b c"), (0, "d"), (None, "e")], "doc_id long, text string"))


@pytest.mark.parametrize("doc", [None, 5])
def test_rows_of_one_id_spread_over_shards(spark, doc, monkeypatch):
    monkeypatch.setattr(X, "READ_RECORDS", 7)
    docs = spark.createDataFrame([(doc, f"w {k}") for k in range(300)] + [(k, "") for k in range(100)], "doc_id long, text string")
    path, written = X.materialised(docs, length=64, shard_text=4000)
    assert len(written) > 10 and max(n for _, n in written) < 100
    rows = X.read_shards(spark, path, written, 64).collect()
    assert sorted(r.slot for r in rows) == list(range(400)) and sum(r.doc_id == doc for r in rows) == 300 + (doc == 5)
    assert {(r.slot, r.doc_id, r.piece) for r in rows} == {(s, d, p) for s, d, p, _ in X.resume(path, written, 0, 64)}
