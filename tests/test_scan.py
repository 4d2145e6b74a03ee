"""Typed tokens, rejected lines and planned ranges."""

import random

import pytest
from pyspark.sql import functions as F

from docrank.functions import text as T
from docrank.operators.fulltext import build_fulltext, fulltext_lexemes, fulltext_search, stored_lexemes
from docrank.sources import papers as P

TOKENS = [
    ("Física cuántica", [("word", "física"), ("word", "cuántica")]),
    ("state-of-the-art x", [("compound", "state-of-the-art"), ("word", "state"), ("word", "of"), ("word", "the"), ("word", "art"), ("word", "x")]),
    ("hep-th cs.AI math.CO", [("compound", "hep-th"), ("word", "hep"), ("word", "th"), ("host", "cs.ai"), ("host", "math.co")]),
    ("see http://www.Example-site.org/a_b?c", [("word", "see"), ("word", "http"), ("host", "www.example-site.org"), ("word", "a"), ("word", "b"), ("word", "c")]),
    ("mail Jane.Doe+x@uni-köln.de!", [("word", "mail"), ("email", "jane.doe+x@uni-köln.de")]),
    ("0704.0001 -3.5e10", [("number", "0704"), ("number", "0001"), ("number", "3"), ("numword", "5e10")]),
    ("covid-19 19-covid u.s.a", [("compound", "covid-19"), ("word", "covid"), ("number", "19"), ("number", "19"), ("word", "covid"),
                                 ("word", "u"), ("word", "s"), ("word", "a")]),
    ("東京 и मराठी", [("word", "東京"), ("word", "и"), ("word", "मराठी")]),
    ("a--b -x- '' @ . -", [("word", "a"), ("word", "b"), ("word", "x")]),
    ("", []), (None, None),
]


def test_token_types(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(TOKENS)], "id long, text string")
    got = {r.id: r.x for r in df.select("id", T.scan_tokens("text").alias("x")).collect()}
    for i, (text, want) in enumerate(TOKENS):
        assert got[i] == want or [tuple(x) for x in got[i]] == want, text


def test_long_tokens(spark):
    texts = ["a." * 20_000 + "com", "x-" * 20_000 + "y", "m" * 200_000, "a@" * 5000]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert df.select(F.size(T.lexeme_tokens("text")).alias("n")).where("n >= 1").count() == 4


def test_words_of_any_script_are_one_lexeme(spark):
    df = spark.createDataFrame([("a", "La física del café", "hep-ths"), ("b", "f sica", "cs.AI")], "id string, title string, categories string")
    lex = fulltext_lexemes(df, "id")
    words = {(r.doc_id, r.term) for r in lex.collect()}
    assert ("a", "física") in words and ("a", "sica") not in words and ("a", "hep-th") in words and ("b", "cs.ai") in words
    assert [r.doc_id for r in fulltext_search(lex, "sica", 5).collect()] == ["b"]
    cols = ["doc_id", "field", "label", "weight", "pos", "term"]
    assert sorted(map(tuple, stored_lexemes(build_fulltext(df)).select(cols).collect())) == sorted(map(tuple, lex.select(cols).collect()))


def test_bad_lines_are_rejected(spark, tmp_path):
    lines = ['{"id": "1", "title": "good", "versions": [1]}', '{"id": "2", "title":', "", "   ", "[1]", '"text"', "7", "null",
             '{"id": "3", "title": null}', '{"id": "4"} trailing', '{"id": "5", "id": "6"}', "{}"]
    src, out = tmp_path / "in.jsonl", str(tmp_path / "out")
    src.write_text("\n".join(lines) + "\n", encoding="utf-8")
    scan = P.scan_papers(spark, str(src), out)
    got = {(r.id, r.title, r.versions, r.doi) for r in scan.records.collect()}
    assert got == {("1", "good", "[1]", " "), ("3", None, " ", " "), (" ", " ", " ", " ")}
    bad = sorted((r.line, r.reason, r.file) for r in scan.rejects.collect())
    assert bad == sorted([(x, "empty line", "in.jsonl") for x in ("", "   ")] + [(x, "not an object", "in.jsonl") for x in ("[1]", '"text"', "7", "null")]
                         + [(lines[i], "not JSON", "in.jsonl") for i in (1, 9, 10)])
    assert {r.reason: r.n for r in scan.counts.collect()} == {None: 3, "empty line": 2, "not an object": 4, "not JSON": 3}
    strict = P.project_json(spark.createDataFrame([(lines[0],)], "value string")).collect()
    assert tuple(strict[0]) == tuple(scan.records.where("id = '1'").first())


@pytest.mark.parametrize("low,high,parts", [(1, 100, 7), (-5, -5, 3), (0, 2, 9), (-10 ** 18, 10 ** 18, 4), (None, None, 3), (5, 9, 1)])
def test_ranges_cover_every_row_once(spark, low, high, parts):
    rng = random.Random(parts)
    values = [None, None] + ([] if low is None else [low, high, low - 3, high + 3] + [rng.randint(low, high) for _ in range(50)])
    plan = P.plan_ranges("v", low, high, parts)
    assert len(plan) <= parts + 1 and plan[-1] == "v IS NULL"
    df = spark.createDataFrame([(v,) for v in values], "v long")
    met = df.select(sum((F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in plan), F.lit(0)).alias("n"), P.range_of(plan).alias("part")).collect()
    assert {r.n for r in met} == {1} and all(r.part is not None for r in met)
    with pytest.raises(ValueError):
        P.plan_ranges("v", 1, 2, 0)


def test_ranges_are_of_equal_width():
    plan = P.plan_ranges("c", 0, 99, 4)
    assert plan == ["c < 25", "c >= 25 AND c < 50", "c >= 50 AND c < 75", "c >= 75", "c IS NULL"]
