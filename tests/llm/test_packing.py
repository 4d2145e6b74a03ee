import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from docrank.llm import packing
from docrank.llm.queries import vocabulary

SF001 = "/root/testdata/sf0.001"


def ids_of(rows):
    t = Tokenizer.from_file(vocabulary())
    return [t.encode(x or "", add_special_tokens=False).ids + [0] for _, x in rows]


def check(rows, got, length):
    """Exact round trip: pieces give back every document, sequences have no gaps or overlaps."""
    left = sorted(zip([r[0] for r in rows], ids_of(rows)), key=repr)
    pieces = {}
    for g in got:
        assert len(g["token_ids"]) == g["length"] <= length
        assert zlib.crc32(np.array(g["token_ids"], "<u4").tobytes()) == g["ids_crc32"]
        pieces.setdefault(g["sequence_id"], []).append(g)
    for own in pieces.values():
        at = 0
        for g in sorted(own, key=lambda g: g["offset"]):
            assert g["offset"] == at
            at += g["length"]
        assert at <= length
    docs = {}
    for g in sorted(got, key=lambda g: g["piece"]):
        docs.setdefault((g["doc_id"], g["piece"]), []).append(g)
    whole = []
    for (i, p), first in docs.items():
        if p == 0:
            assert all(g["start"] == 0 for g in first)
    for i, ids in left:
        cut = packing.cut(len(ids), length)
        assert [n for _, n in cut[1:]] == [length] * (len(cut) - 1)
        for k, (s, n) in enumerate(cut):
            same = [g for g in docs[i, k] if g["start"] == s and list(g["token_ids"]) == ids[s: s + n]]
            assert same
            docs[i, k].remove(same[0])
        whole.append(i)
    assert not any(docs.values())
    return len(pieces)


def test_documents_round_trip(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    for options in ({}, {"group_rows": 20, "rule": "norm"}):
        got = [r.asDict() for r in packing.best_fit_packing(docs, vocabulary(), keep_ids=True, **options).collect()]
        n = check(rows, got, 2048)
        assert n <= 1.1 * sum(g["length"] for g in got) / 2048 + 10


def test_small_sequences_nulls_and_repeats(spark):
    rows = [(1, None), (1, None), (2, ""), (3, "a b c d e f g h i j k l m n o p q r s t"), (3, "x"), (None, "null id"),
            (4, "tab\t \n  <|endoftext|> 中文 é "), (5, "word " * 400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [r.asDict() for r in packing.best_fit_packing(df, vocabulary(), length=16, keep_ids=True).collect()]
    check(rows, got, 16)
    empty = packing.best_fit_packing(df.where("false"), vocabulary())
    assert empty.collect() == [] and empty.columns[-2:] == ["sequence_id", "offset"]


def test_every_capacity_holds():
    rng = np.random.default_rng(2)
    size = rng.integers(1, 60, 400).astype(float)
    items = np.stack([size, np.ones(400), size * size], 1)
    for rule in ("dot", "norm"):
        for capacity in ([100.0, 4.0, 5000.0], [100.0, 100.0, 10000.0]):
            where, n = packing.vector_best_fit(items, np.array(capacity), np.array([1.0, 0.1, 0.1]), rule)
            for d in range(3):
                assert np.bincount(where, weights=items[:, d], minlength=n).max() <= capacity[d]
            assert set(where) == set(range(n))


def test_best_fit_takes_the_tightest_bin():
    items = np.array([[6.0], [5.0], [4.0], [5.0]])
    where, n = packing.vector_best_fit(items, np.array([10.0]), np.array([1.0]))
    assert n == 2 and where[0] == where[2] and where[1] == where[3]


def test_bad_arguments(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(ValueError):
        packing.best_fit_packing(df, vocabulary(), rule="first")
    for bad in ({"max_attention": 0.5}, {"max_docs": 0}):
        with pytest.raises(ValueError):
            packing.best_fit_packing(df, vocabulary(), **bad)


def test_attention_and_documents_bind(spark):
    """A limit on attention cost cuts pieces to its root and keeps sequences under it; so does one on documents."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    plain = len({r.sequence_id for r in packing.best_fit_packing(docs, vocabulary(), length=512).collect()})
    for options, longest in (({"max_attention": 60_000.0}, 244), ({"max_docs": 2}, 512)):
        got = packing.best_fit_packing(docs, vocabulary(), length=512, **options).collect()
        cost, pieces = {}, {}
        for r in got:
            cost[r.sequence_id] = cost.get(r.sequence_id, 0) + r.length ** 2
            pieces[r.sequence_id] = pieces.get(r.sequence_id, 0) + 1
        assert max(cost.values()) <= options.get("max_attention", 512 ** 2) and max(pieces.values()) <= options.get("max_docs", 512)
        assert len(cost) > plain and max(r.length for r in got) == longest
        assert sum(r.length for r in got) == sum(map(len, ids_of(rows)))


def test_equal_rows_are_spread(spark):
    df = spark.createDataFrame([(1, "the same text of a document")] * 400, "doc_id long, text string").repartition(4)
    got = packing.best_fit_packing(df, vocabulary(), length=64, group_rows=100).collect()
    assert len(got) == 400 and len({r.sequence_id >> 40 for r in got}) > 1
