import math
import uuid

import pytest
from pyspark.sql import functions as F

from docrank.operators.index import build_index, normalized_postings, posting_lists, read_index, write_index
from docrank.operators.merge import merge_index
from docrank.operators.search import search, search_batch
from docrank.session import scratch_path

IDF2 = 0.916291
IDF1 = 1.609438


def _norms(idx):
    return {r["doc_id"]: round(r["norm"], 6) for r in idx.norms.collect()}


def _hits(df):
    return [(r["doc_id"], round(r["similarity"], 6)) for r in df.orderBy("rank").collect()]


def test_golden_idf_and_norms(golden):
    idx = build_index(golden, stem=False)
    idf = {r["term"]: round(r["idf"], 6) for r in idx.terms.collect()}
    assert idf["moon"] == IDF2 and idf["rocket"] == IDF2
    assert all(idf[t] == IDF1 for t in "the fuel orbit law court engine".split())
    assert _norms(idx) == {"d1": 2.066269, "d2": 2.754536, "d3": 3.164806, "d4": 1.851993, "d5": 0.0}
    assert idx.spark.range(1).select(idx.n_docs.alias("n")).first()["n"] == 5
    idx.release()


def test_golden_norms_case_insensitive(golden):
    idx = build_index(golden, stem=False, stop_case_sensitive=False)
    assert _norms(idx) == {"d1": 2.066269, "d2": 2.235437, "d3": 3.164806, "d4": 1.851993, "d5": 0.0}


@pytest.mark.parametrize("query,default,insensitive", [
    ("fly me to the moon", [("d2", 0.563222), ("d1", 0.443452)], [("d2", 0.694010), ("d1", 0.443452)]),
    ("moon rocket", [("d1", 0.627136), ("d2", 0.398258), ("d4", 0.349848)],
     [("d1", 0.627136), ("d2", 0.490739), ("d4", 0.349848)]),
    ("law law moon", [("d3", 0.816134), ("d2", 0.179508), ("d1", 0.141335)],
     [("d3", 0.816134), ("d2", 0.221192), ("d1", 0.141335)]),
])
def test_golden_queries(golden, query, default, insensitive):
    assert _hits(search(build_index(golden, stem=False), query, 5)) == default
    assert _hits(search(build_index(golden, stem=False, stop_case_sensitive=False), query, 5)) == insensitive


def test_batch_equals_singles(spark, golden):
    idx = build_index(golden, stem=False)
    qs = ["fly me to the moon", "moon rocket", "law law moon", "engine fuel court"]
    batch = search_batch(idx, spark.createDataFrame(list(enumerate(qs)), "query_id long, text string"), 3)
    for i, q in enumerate(qs):
        single = _hits(search(idx, q, 3))
        assert _hits(batch.where(F.col("query_id") == i)) == single


def test_edge_cases(spark, golden):
    idx = build_index(golden, stem=False)
    assert search(idx, "zebra unicorn", 5).count() == 0          # only unknown terms
    assert search(idx, "the a in to me", 5).count() == 0          # only stop words
    with pytest.raises(ValueError):
        search(idx, "moon", 0)                                     # k <= 0 (D7)
    with pytest.raises(ValueError):
        search_batch(idx, spark.createDataFrame([(0, "moon")], "query_id long, text string"), -1)


def test_idf_zero_candidates(spark):
    docs = spark.createDataFrame([("a", "x"), ("b", "x")], "doc_id string, text string")
    idx = build_index(docs)
    # every document has x: idf 0, norms 0, still candidates with similarity 0.0 (D6)
    assert _hits(search(idx, "x", 5)) == [("a", 0.0), ("b", 0.0)]


def test_empty_corpus(spark):
    docs = spark.createDataFrame([], "doc_id string, text string")
    idx = build_index(docs)
    assert search(idx, "moon", 5).count() == 0
    assert idx.postings.count() == 0 and idx.norms.count() == 0


def test_duplicate_ids_add(spark):
    docs = spark.createDataFrame([("a", "moon moon"), ("a", "moon"), ("b", "sun")], "doc_id string, text string")
    idx = build_index(docs)
    tf = {(r["doc_id"], r["term"]): r["tf"] for r in idx.tf().collect()}
    assert tf == {("a", "moon"): 3, ("b", "sun"): 1}
    assert idx.norms.count() == 2
    assert idx.spark.range(1).select(idx.n_docs.alias("n")).first()["n"] == 3  # N counts both rows (D12)


def test_long_and_unicode_terms(spark):
    word = "a" * 40
    docs = spark.createDataFrame([("a", f"{word} über"), ("b", "plain text")], "doc_id string, text string")
    idx = build_index(docs)
    assert _hits(search(idx, word, 5))[0][0] == "a"       # D9: full-length terms are findable
    assert _hits(search(idx, "über", 5))[0][0] == "a"     # D8: non-ASCII terms allowed


def test_similarity_bounds_and_self_match(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    queries = docs.select(F.col("doc_id").alias("query_id"), "text")
    rows = search_batch(build_index(docs), queries, 1).collect()
    assert all(-1e-9 <= r["similarity"] <= 1 + 1e-9 for r in rows)
    # with the same stop rule on both sides, a document is its own best match
    # (score 1, or an exact copy ties with it)
    same = search_batch(build_index(docs, stop_case_sensitive=False), queries, 1).collect()
    norms = {r["doc_id"]: r["norm"] for r in build_index(docs, stop_case_sensitive=False).norms.collect()}
    checked = [r for r in same if norms[r["query_id"]] > 0]
    assert len(checked) > 100
    for r in checked:
        assert math.isclose(r["similarity"], 1.0, abs_tol=1e-9)


def test_partition_count_does_not_change_results(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    a = sorted(tuple(r) for r in search_batch(build_index(docs), bench, 5, "item_id", digits=9).collect())
    b = sorted(tuple(r) for r in search_batch(build_index(docs.repartition(7)), bench.repartition(3), 5, "item_id",
                                              digits=9).collect())
    assert a == b


def test_merge_equals_rebuild(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    a, b = docs.where(F.col("lang") == "en"), docs.where(F.col("lang") != "en")
    merged = merge_index(build_index(a), b)
    full = build_index(docs)

    def rows(idx):
        return sorted((r["term"], r["doc_id"], r["tf"], round(r["weight"], 9), round(r["nweight"], 9))
                      for r in normalized_postings(idx).collect())
    assert rows(merged) == rows(full)
    assert sorted((r["doc_id"], round(r["norm"], 9)) for r in merged.norms.collect()) == \
        sorted((r["doc_id"], round(r["norm"], 9)) for r in full.norms.collect())


def test_write_read_round_trip(spark, golden):
    path = scratch_path(spark, f"test-index-golden-{uuid.uuid4().hex}")
    idx = write_index(build_index(golden, stem=False), path)
    again = read_index(spark, path)
    assert _hits(search(again, "moon rocket", 5)) == [("d1", 0.627136), ("d2", 0.398258), ("d4", 0.349848)]
    assert _hits(search(idx, "moon rocket", 5)) == _hits(search(again, "moon rocket", 5))
    assert {r["doc_id"] for r in idx.docs.collect()} == {"d1", "d2", "d3", "d4", "d5"}
    lists = {r["term"]: r["size"] for r in posting_lists(again).collect()}
    assert lists["moon"] == 2 and lists["law"] == 1


def test_hydrate_one_row_per_id(spark):
    from docrank.operators.search import hydrate
    results = spark.createDataFrame([(0, 1, "a", 0.9), (0, 2, "b", 0.5)], "query_id long, rank long, doc_id string, similarity double")
    store = spark.createDataFrame([("a", "x2"), ("a", "x1"), ("a", "x3"), ("c", "z")], "doc_id string, title string")
    out = sorted((r["doc_id"], r["title"]) for r in hydrate(results, store).collect())
    assert out == [("a", "x1"), ("b", None)]


def test_stemmed_single_equals_batch(spark):
    from docrank.plans.catalog import part_papers
    from docrank.sources.papers import SEARCH_FIELDS
    papers = part_papers(spark, "/root/testdata/sf0.001")
    idx = build_index(papers, "doc_id", SEARCH_FIELDS, stem=True)
    qs = ["small rings and large plates", "Cold widgets", "economy bolts 7"]
    batch = search_batch(idx, spark.createDataFrame(list(enumerate(qs)), "query_id long, text string"), 5)
    for i, q in enumerate(qs):
        assert _hits(batch.where(F.col("query_id") == i)) == _hits(search(idx, q, 5))


def test_posting_list_blocks_are_bounded(spark):
    from collections import defaultdict
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    idx = build_index(docs, stem=False)
    df = {r["term"]: r["df"] for r in idx.terms.collect()}
    per = defaultdict(list)
    for r in posting_lists(idx, block_size=10).collect():
        assert r["size"] == len(r["papers"])
        per[r["term"]].append(r["size"])
    assert set(per) == set(df)
    for term, sizes in per.items():
        assert sum(sizes) == df[term]
        assert len(sizes) <= max(1, math.ceil(df[term] / 10))
    assert max(df.values()) > 10 and max(len(v) for v in per.values()) > 1   # a frequent term is split
