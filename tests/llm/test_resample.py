"""Importance resampling against a plain-Python version."""

import hashlib
import math
import random
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docrank.llm.queries import QUERIES
from docrank.llm.resample import features, importance_resample
from tests.llm import brute

SF001 = "/root/testdata/sf0.001"


def plain(docs, target, n=1, buckets=10_000, percent=10, least=20):
    """Sorted (id, features, weight, score, rank) of every row."""
    split = lambda t: brute.OP3_WORD.findall((t or "").translate(brute.UPPER))
    grams = lambda w: [zlib.crc32(" ".join(w[i: i + k]).encode()) % buckets for k in range(1, n + 1) for i in range(len(w) - k + 1)]
    s, t = [0] * buckets, [0] * buckets
    for texts, total in ((docs, s), (target, t)):
        for _, text in texts:
            for b in grams(split(text)):
                total[b] += 1
    a, b = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((t[i] + 1.0) * (a + buckets) / ((s[i] + 1.0) * (b + buckets)))) for i in range(buckets)]
    rows = []
    for i, text in docs:
        own = grams(split(text))
        weight = sum(gain[x] for x in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(split(text))])
    able = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1]))
    for place, r in enumerate(able[: percent * len(able) // 100], 1):
        r[4] = place
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def drawn(df, target, **options):
    out, names = importance_resample(df, target, **options)
    return sorted((tuple(r) for r in out.select("doc_id", *(names[c] for c in ("n_features", "weight", "score", "rank"))).collect()), key=repr)


def test_query_equals_plain_python(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    target = [tuple(r) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").select("item_id", "text").collect()]
    got = sorted(map(tuple, QUERIES["op13_importance_resampling"](spark, SF001).collect()), key=repr)
    want = plain(docs, target)
    assert got == want and sum(r[4] is not None for r in want) > 5


def corpus(rng):
    text = lambda n: " ".join(rng.choice(["aa", "Bb", "c1", "é", "dd-dd", "Ä", "zz\x00y"]) for _ in range(n))
    rows = [(i, text(rng.randint(0, 40))) for i in range(150)]
    # A third of the rows repeat one row; nulls, empty texts, no words, one id with two texts, a very long text.
    return rows + [(7000, rows[3][1])] * 80 + [(None, text(30)), (None, text(25)), (None, None), (901, None), (902, ""), (903, " .,- "),
                                               (904, text(30)), (904, text(50)), (905, text(60_000))]


@pytest.mark.parametrize("options", [{}, {"n": 2}, {"n": 3, "buckets": 50}, {"percent": 100, "least": 0}, {"percent": 0}])
def test_edge_cases(spark, options):
    rng = random.Random(4)
    docs, target = corpus(rng), [(1, "aa Bb aa"), (2, None), (3, "c1 é É")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    aim = spark.createDataFrame(target, "item_id long, text string")
    call = {("least_words" if k == "least" else k): v for k, v in options.items()}
    assert drawn(df, aim, **({"n": 1} | call)) == plain(docs, target, **options)
    empty = aim.where("false")
    assert drawn(df, empty, **({"n": 1} | call)) == plain(docs, [], **options)
    assert drawn(df.where("false"), aim, **call) == []


def test_columns(spark):
    rows = [(i, f"word{i} " * 30, "kept", 7) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, RANK string, weight int")
    out, names = importance_resample(df, df.select("text"), least_words=1)
    assert out.columns[:4] == df.columns and names["rank"] == "_rank" and names["weight"] == "_weight"
    assert out.where(F.col("RANK") != "kept").count() == 0 and out.where(names["rank"] + " is not null").count() == 4
    for bad in ({"percent": 101}, {"n": 0}, {"columns": ["text"]}):
        with pytest.raises(ValueError):
            importance_resample(df, df, **bad)


def test_features_name_joined_words():
    bucket, text, words = features(pa.array(["A b, c", None, "b"]), 3, 1 << 31)
    code = lambda x: zlib.crc32(x.encode()) % (1 << 31)
    assert sorted(zip(text.tolist(), bucket.tolist())) == sorted(
        [(0, code(x)) for x in ("a", "b", "c", "a b", "b c", "a b c")] + [(2, code("b"))])
    assert words.tolist() == [3, 0, 1]
