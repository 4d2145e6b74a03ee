"""Searches that skip document blocks: the same rows as the full sums, ties included, with fewer postings scored."""

import random

import pytest
from pyspark.sql import functions as F

from docrank import build_index, fulltext_lexemes, fulltext_search_batch, read_index, search_batch, write_fulltext, write_index
from docrank.operators.blockmax import block_of, pruned_top_k
from docrank.operators.fulltext import fulltext_search_pruned
from docrank.operators.search import search_pruned
from docrank.sources import rangetable


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(11)
    texts = [" ".join(["common"] * rng.randint(1, 3) + rng.choices([f"w{i}" for i in range(80)], k=rng.randint(1, 25))) for _ in range(600)]
    texts += [texts[5]] * 40 + ["rare common", "rare rare w1", ""]  # exact copies tie
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").cache()


@pytest.mark.parametrize("k,block_docs", [(1, 1), (5, 4), (30, 16), (1000, 4)])
def test_same_rows_as_full_sums(spark, docs, tmp_path, k, block_docs):
    idx = write_index(build_index(docs), str(tmp_path / "i"), block_docs=block_docs)
    assert idx.blocks == -(-docs.count() // block_docs) == read_index(spark, str(tmp_path / "i")).blocks
    asked = spark.createDataFrame([(0, "common rare"), (1, "w3 w4 common"), (2, docs.where("doc_id = 5").first().text), (3, "nothing here")],
                                  "query_id long, text string")
    found, told = search_pruned(idx, asked, k, digits=6)
    assert rows(found) == rows(search_batch(idx, asked, k, digits=6))
    counts = {r.query_id: r for r in told.collect()}
    assert set(counts) == {0, 1, 2} and all(r.read <= r.blocks and r.scored <= r.postings for r in counts.values())
    if k <= 5:  # what cannot reach the k-th score is not scored
        assert counts[0].read < counts[0].blocks / 2 and counts[0].scored < counts[0].postings / 2


def test_weighted_ranker(spark, docs, tmp_path):
    fields = (("text", "B"),)
    lex = fulltext_lexemes(docs, "doc_id", fields)
    idx = write_fulltext(lex, str(tmp_path / "w"), block_docs=8)
    asked = spark.createDataFrame([(0, "common"), (1, "rare w7 w8"), (2, "the")], "query_id long, text string")
    found, told = fulltext_search_pruned(idx, asked, 7, digits=6)
    assert rows(found) == rows(fulltext_search_batch(lex, asked, 7, digits=6))
    assert {r.query_id for r in told.where("read < blocks").collect()} >= {1}


def test_rounds_and_ties(spark):
    """Scores that tie after rounding go by id, also across blocks whose bounds differ by less than the rounding."""
    postings = spark.createDataFrame([("t", i, 0.5 + (i % 3) * 1e-9) for i in range(60)] + [("s", 59, 0.1)], "term string, doc_id long, w8 double")
    blocks = postings.groupBy("term", block_of("doc_id", 20).alias("block")).agg(F.max("w8").alias("most"), F.count("*").alias("n"))
    asked = spark.createDataFrame([("q", "t", 1.0), ("q", "s", 1.0)], "query_id string, term string, w double")
    for rounds, first in ((0, 1), (1, 1), (3, 2)):
        found, _ = pruned_top_k(postings, blocks, 20, asked, "w8", 4, 6, rounds, first)
        assert [(r["rank"], r.doc_id, r.similarity) for r in found.orderBy("rank").collect()] == [(1, 59, 0.6), (2, 0, 0.5), (3, 1, 0.5), (4, 2, 0.5)]


def test_refuses_what_it_cannot_do(spark, docs, tmp_path, monkeypatch):
    asked = spark.createDataFrame([(0, "common rare")], "query_id long, text string")
    plain = write_index(build_index(docs.limit(5)), str(tmp_path / "p"))
    with pytest.raises(ValueError):
        search_pruned(plain, asked)
    blocked = write_index(build_index(docs.limit(5)), str(tmp_path / "b"), block_docs=2)
    monkeypatch.setattr(rangetable, "FEW", 1)
    with pytest.raises(ValueError):
        search_pruned(blocked, asked)
