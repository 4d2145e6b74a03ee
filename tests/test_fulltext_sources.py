import json
import os

from pyspark.sql import functions as F

from docrank.operators.compare import compare
from docrank.operators.fulltext import build_fulltext, fulltext_lexemes, fulltext_search
from docrank.operators.index import build_index
from docrank.plans.catalog import part_papers
from docrank.sources import papers as P

FIXTURE = os.path.join(os.path.dirname(__file__), "fixtures", "papers.jsonl")


def test_weighted_golden_unstemmed(spark):
    lex = fulltext_lexemes(part_papers(spark, "/root/testdata/sf0.01"), "doc_id", stem=False)
    res = [(r["doc_id"], round(r["similarity"], 6)) for r in fulltext_search(lex, "small ring 7", 5, stem=False)
           .orderBy("rank").collect()]
    assert res == [(7, 1.2), (137, 1.0), (156, 1.0), (627, 1.0), (780, 1.0)]


def test_weighted_rank_counts_document_repeats_not_query_repeats(spark):
    df = spark.createDataFrame([(1, "ring ring", "x"), (2, "ring", "ring")], "doc_id long, title string, categories string")
    lex = fulltext_lexemes(df.withColumn("id", F.lit("z")), "doc_id", stem=False)
    res = {r["doc_id"]: round(r["similarity"], 6) for r in fulltext_search(lex, "ring ring", 5, stem=False).collect()}
    assert res == {1: 0.8, 2: 0.6}


def test_fulltext_query_edge_cases(spark):
    lex = fulltext_lexemes(part_papers(spark, "/root/testdata/sf0.001"), "doc_id")
    assert fulltext_search(lex, "the and !!", 5).count() == 0   # empty OR query matches nothing


def test_build_fulltext_only_when_missing(spark):
    df = part_papers(spark, "/root/testdata/sf0.001")
    ext = build_fulltext(df, "doc_id")
    assert "search_txt" in ext.columns and ext.count() == df.count()
    assert build_fulltext(ext, "doc_id") is ext


def test_compare_has_both_rankers(spark):
    df = part_papers(spark, "/root/testdata/sf0.001")
    out = compare(build_index(df, "doc_id", P.SEARCH_FIELDS, stem=True), fulltext_lexemes(df, "doc_id"), "small ring", 3)
    assert {r["ranker"] for r in out.collect()} == {"cosine", "fulltext"}


def test_read_papers_missing_vs_null(spark):
    df = P.read_papers(spark, FIXTURE)
    rows = {r["id"]: r for r in df.collect() if r["id"] != "0704.0007"}
    assert df.columns == list(P.PAPER_COLUMNS)
    assert rows["0704.0002"]["doi"] == " " and rows["0704.0002"]["comments"] == " "   # missing keys
    assert rows["0704.0003"]["journal_ref"] is None                                    # JSON null
    assert rows["0704.0004"]["authors"] is None
    assert json.loads(rows["0704.0001"]["versions"])[0]["version"] == "v1"
    assert "Λ_α" in rows["0704.0005"]["title"]
    loose = P.read_papers(spark, FIXTURE, strict=False)
    assert loose.where(F.col("id") == "0704.0002").first()["doi"] is None


def test_papers_index_and_catalog(spark):
    papers = P.read_papers(spark, FIXTURE)
    idx = build_index(papers, "id", P.SEARCH_FIELDS)
    from docrank.operators.search import search
    top = search(idx, "antidisestablishmentarianismsupercharged", 3).collect()
    assert [r["doc_id"] for r in top] == ["0704.0006"]
    assert [r["doc_id"] for r in search(idx, "0704 0003", 1).collect()] == ["0704.0003"]  # ids are searchable
    # duplicate id 0704.0007: one result row, counts added
    assert search(idx, "polymer quantum", 5).where(F.col("doc_id") == "0704.0007").count() == 1
    titles = [r["title"] for r in P.list_papers(papers).collect()]
    assert titles == sorted(titles)
    assert P.get_paper(papers, "0704.0003").count() == 1 and P.get_paper(papers, "nope").count() == 0
    ids = spark.createDataFrame([("0704.0001",), ("0704.0005",)], "id string")
    assert P.get_papers(papers, ids).count() == 2
    js = json.loads(P.to_json_rows(papers.where(F.col("id") == "0704.0003")).first()["json"])
    assert js["journal_ref"] is None and set(js) == set(P.PAPER_COLUMNS)


def test_read_table_and_limit(spark, tmp_path):
    papers = P.read_papers(spark, FIXTURE)
    out = str(tmp_path / "papers_tbl")
    P.write_documents(papers, out)
    back = P.read_table(spark, out)
    assert back.count() == papers.count()
    assert [r["id"] for r in P.limit_corpus(back, 2).collect()] == ["0704.0001", "0704.0002"]


def test_result_rows_placeholders(spark):
    from docrank.operators.search import hydrate, result_rows
    df = part_papers(spark, "/root/testdata/sf0.001")
    res = fulltext_search(fulltext_lexemes(df, "doc_id"), "small ring", 3)
    rows = result_rows(hydrate(res, df), ["id", "submitter", "title", "abstract"], {"submitter": "-"}, as_json=True)
    out = rows.orderBy("rank").collect()
    assert len(out) == 3
    info = json.loads(out[0]["info"])
    assert list(info) == ["id", "submitter", "title", "abstract"]
    assert info["submitter"] == "-" and info["abstract"] is None
    assert out[0]["val"] >= out[-1]["val"]


def test_build_fulltext_content(spark):
    df = spark.createDataFrame([("7", "small rings", "SMALL"), ("7", "", None)], "id string, title string, categories string")
    out = build_fulltext(df, "id").collect()
    assert len(out) == 2                                   # one row per record, duplicates kept apart
    lex = sorted((e["field"], e["pos"], e["term"], e["label"]) for e in max(out, key=lambda r: len(r["search_txt"]))["search_txt"])
    assert lex == [("categories", 0, "small", "C"), ("id", 0, "7", "A"), ("title", 0, "small", "B"), ("title", 1, "ring", "B")]
    assert [len(r["search_txt"]) for r in out if r["title"] == ""] == [1]
