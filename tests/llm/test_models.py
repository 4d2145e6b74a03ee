"""Held-out accuracy of the trained operators, and their edge cases."""

import math
import random

import pytest
from pyspark.sql import functions as F

from docrank.llm import langid, quality, toxicity
from docrank.llm.queries import QUERIES
from docrank.llm.tables import held_out

SF01 = "/root/testdata/sf0.01"
SF1 = "/root/testdata/sf0.1"


def documents(spark):
    return spark.read.parquet(f"{SF01}/documents.parquet")


def test_language_held_out_accuracy(spark):
    got = QUERIES["op2_language_id"](spark, SF01).where("held_out").join(
        documents(spark).select("doc_id", "lang"), "doc_id").select("lang", "lang_pred", "score").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_edge_cases(spark):
    rng = random.Random(1)
    make = lambda words, n: " ".join(rng.choice(words) for _ in range(n))
    a, b = ["alpha", "beta", "gamma", "delta"], ["uno", "dos", "tres", "cuatro"]
    rows = [(i, make(a if i % 3 else b, 60), "aa" if i % 3 else "bb") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    models = langid.train(df, ~held_out("doc_id"))
    assert [m[0] for m in models] == ["aa", "bb"]
    long = " ".join([make(b, 20000)])
    test = spark.createDataFrame([(None, "1 2 ² ½ !"), (None, None), (1, ""), (2, make(a, 40)), (3, long), (3, long), (4, "x")],
                                 "Score long, text string")
    out, names = langid.identify(test, models)
    assert names["score"] == "_score" and out.columns[:2] == ["Score", "text"]
    got = [(r[names["lang_pred"]], r[names["rejected"]], r[names["score"]]) for r in out.collect()]
    assert got[:3] == [("und", True, 0.0)] * 3 and got[3][:2] == ("aa", False) and got[4] == got[5] and got[4][0] == "bb"
    assert got[6][0] in ("aa", "bb") and not got[6][1]
    nothing, names = langid.identify(test, langid.train(df.where("false"), F.lit(True)))
    assert {r[names["lang_pred"]] for r in nothing.collect()} == {"und"}
    assert langid.identify(test.where("false"), models)[0].collect() == []


def test_narrow_margins_are_rejected(spark):
    models = [("aa", b"shared words of one text that both languages have " * 20), ("bb", b"shared words of one text that both languages have " * 20)]
    df = spark.createDataFrame([("shared words of one text that both languages have and more of them here",)], "text string")
    out, names = langid.identify(df, models)
    assert out.first()[names["rejected"]] is True


def test_toxicity_held_out(spark):
    """At this size only English toxic words occur in several documents, so only those can be learnt."""
    labels = spark.read.parquet(f"{SF1}/labels.parquet").select("doc_id", "toxic")
    english = spark.read.parquet(f"{SF1}/documents.parquet").where("lang = 'en'").select("doc_id")
    got = QUERIES["op10_toxicity"](spark, SF1).join(labels, "doc_id").join(english, "doc_id").collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    ranks = sorted((r.score, r.toxic) for r in got if r.held_out)
    pos, neg = [s for s, t in ranks if t], [s for s, t in ranks if not t]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert auc > 0.95
    assert sum(r.predicted for r in got if r.held_out and not r.toxic) <= 0.01 * len(neg)
    assert sum(r.predicted for r in got if r.held_out and r.toxic) >= 0.8 * len(pos)


def test_toxicity_edge_cases(spark):
    rng = random.Random(4)
    words = [f"{c}{v}{d}" for c in "bcdfgl" for v in "aeiou" for d in ("na", "ro", "te")]
    text = lambda bad: " ".join(rng.choice(words) if rng.random() > bad else rng.choice(["stinkword", "uglyterm"]) for _ in range(80))
    docs = spark.createDataFrame([(i, text(0.15 if i % 4 == 0 else 0)) for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)] + [(0, 0), (None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, ~held_out("doc_id"))
    tests = spark.createDataFrame([(None,), ("",), ("123 !!",), (text(0.3),), (text(0),), (text(0) + " " + text(0.2) + " " + text(0) * 50,)],
                                  "text string").withColumn("score", F.lit("mine"))
    out, names = toxicity.score_toxicity(tests, model)
    got = [(r[names["score"]], r[names["predicted"]]) for r in out.collect()]
    assert names["score"] == "_score" and got[0] == got[1] == got[2] and [g[1] for g in got] == [0, 0, 0, 1, 0, 1]
    one = toxicity.train(docs, labels.where("toxic = 0"), ~held_out("doc_id"))
    assert toxicity.score_toxicity(tests, one)[0].where("predicted = 1").count() == 0
    assert toxicity.score_toxicity(tests.where("false"), model)[0].collect() == []


def brute_logp(counts, gram):
    """Interpolated modified Kneser-Ney from plain dictionaries of counts by order."""

    def d(n):
        of = [sum(c == k for c in counts[n].values()) for k in (1, 2, 3, 4)]
        return quality.discounts(of)

    def p(n, g):
        if n == 0:
            return 1 / 256
        own = {x: c for x, c in counts[n].items() if x[:-1] == g[:-1]}
        if not own:
            return p(n - 1, g[1:])
        cut = lambda c: d(n)[min(c, 3) - 1]
        c = own.get(g, 0)
        return ((c - cut(c) if c else 0) + sum(map(cut, own.values())) * p(n - 1, g[1:])) / sum(own.values())

    return math.log(p(4, gram))


def test_kneser_ney_against_brute_force(spark):
    texts = ["abracadabra abracadabra", "a cab, a bad cab", "barbara", None, "abc"]
    df = spark.createDataFrame([(i, t, "xx") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    model = quality.train(df, df.select("doc_id"))
    counts = {4: {}}
    for t in texts:
        b = (t or "").encode()
        for j in range(len(b) - 3):
            counts[4][b[j: j + 4]] = counts[4].get(b[j: j + 4], 0) + 1
    for n in (3, 2, 1):
        counts[n] = {}
        for g in counts[n + 1]:
            counts[n][g[1:]] = counts[n].get(g[1:], 0) + 1
    asked = [b"abra", b"cab,", b"zabr", b"qqqq", b"dabz", b" cab"]
    number = {int.from_bytes(g, "big"): g for g in asked}
    got = model.log_probabilities(spark.createDataFrame([(k,) for k in number], "gram long")).collect()
    for r in got:
        assert r.logp == pytest.approx(brute_logp(counts, number[r.gram]), rel=1e-9)
    out, names = quality.perplexity(df, model, block_bytes=10)
    for r in out.collect():
        b = (r.text or "").encode()
        g = [b[j: j + 4] for j in range(len(b) - 3)]
        assert r[names["n_grams"]] == len(g)
        want = math.exp(-sum(brute_logp(counts, x) for x in g) / len(g)) if g else None
        assert r[names["perplexity"]] == (pytest.approx(want, rel=1e-9) if g else None)


@pytest.mark.parametrize("ids", [4_000_000, 0])
def test_quality_keeps_good_text(spark, ids):
    docs = documents(spark).select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    out, names = quality.quality_filter(docs, labels, broadcast_ids=ids, block_bytes=300_000)
    got = out.join(labels, "doc_id").collect()
    good, bad = ([r[names["keep"]] for r in got if r.quality == q] for q in (1, 0))
    assert sum(good) >= 0.95 * len(good) and sum(bad) <= 0.3 * len(bad)


def test_quality_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, None), (2, "", "xx"), (3, "some words", "xx"), (3, "some words", "xx"), (None, "some text", None)],
                                 "doc_id long, text string, lang string").withColumn("perplexity", F.lit(0))
    none = spark.createDataFrame([], "doc_id long, quality int")
    out, names = quality.quality_filter(docs, none)
    rows = out.collect()
    assert len(rows) == 5 and all(r[names["keep"]] for r in rows) and names["perplexity"] == "_perplexity"
    assert quality.quality_filter(docs.where("false"), none)[0].collect() == []


def test_toxic_words_of_rare_languages(spark):
    """Their n-grams weigh little beside those of the frequent language, and copies of one text make none."""
    rng = random.Random(5)
    frequent = [f"{c}{v}{d}" for c in "bcdfgl" for v in "aeiou" for d in ("na", "ro", "te")]
    rare = [f"{c}{v}{d}" for c in "hjkpst" for v in "äöü" for d in ("schen", "lich")]
    # Language, words, toxic words, toxic and ordinary documents.
    kinds = {"aa": (frequent, ["stinkword", "uglyterm"], 2000, 2400), "bb": (rare, ["zwackelmuff"], 25, 300)}
    rows = [(lang, int(k < n1), " ".join(rng.choice(toxic if k < n1 and rng.random() < 0.15 else words) for _ in range(60)))
            for lang, (words, toxic, n1, n0) in kinds.items() for k in range(n1 + n0)]
    rows += [("aa", 1, "stinkword " + " ".join(f"copied{chr(97 + k)}word" for k in range(26)))] * 30
    table = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, lang string, toxic int, text string")
    model = toxicity.train(table.drop("lang", "toxic"), table.select("doc_id", "toxic"), ~held_out("doc_id"))
    assert b"zwackelmuff" in model.toxic and b"copied" not in model.toxic
    out, names = toxicity.score_toxicity(table.where(held_out("doc_id")), model)
    got = out.select("lang", "toxic", F.col(names["predicted"]).alias("predicted")).collect()
    for lang in kinds:
        for toxic in (0, 1):
            own = [r.predicted for r in got if r.lang == lang and r.toxic == toxic]
            assert own and sum(p == toxic for p in own) >= 0.9 * len(own), (lang, toxic)
