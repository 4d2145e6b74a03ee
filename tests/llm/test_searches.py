"""Decontamination, vector search, URL filter and license scan against brute force."""

import hashlib
import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from docrank.llm import decontam, licenses, topk, urls
from docrank.llm.queries import ORACLE_SQL, QUERIES
from tests.llm import brute

SF001 = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    df = QUERIES[name](spark, SF001)
    want = con.execute(ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(repr, map(tuple, df.select(*columns).collect()))) == sorted(map(repr, want.fetchall()))


def hits(df, items, **options):
    out, names = decontam.decontaminate(df, items, **options)
    rows = out.select("doc_id", names["n_words"], decontam.hit_words(names["spans"]), names["items"], names["near_items"]).collect()
    return {r[0]: (r[1], r[2], list(r[3])) for r in rows}, {r[0]: list(r[4]) for r in rows}


def test_decontamination_of_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{SF001}/benchmark.parquet")
    want = brute.phrases([tuple(r) for r in docs.collect()], [tuple(r) for r in items.select("item_id", "text").collect()])
    assert any(v[1] for v in want.values())
    for options in ({}, {"block_words": 50}):
        assert hits(docs, items, **options)[0] == want
    got = QUERIES["op3_benchmark_decontamination"](spark, SF001).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got} == {
        i: (n, h, len(f), hashlib.sha256(",".join(f).encode()).hexdigest(), h > 0) for i, (n, h, f) in want.items()}


def test_decontamination_edge_cases(spark):
    rng = random.Random(2)
    w = lambda n: " ".join(rng.choice(["aa", "bb", "Cc", "d1", "é"]) for _ in range(n))
    docs = [(i, w(rng.randint(0, 80))) for i in range(50)] + [(90, None), (91, ""), (92, "..."), (93, "short Item"), (94, "short\x0bitem, " * 30)]
    items = [(1, w(12)), (2, docs[3][1]), (3, "SHORT item"), (4, None), (5, ""), (None, w(10)), (1, w(3)), (7, "aa bb")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute.phrases(docs, [x for x in items if x[0] is not None], window=4)
    assert hits(df, bench, window=4)[0] == want
    assert hits(df, bench, window=4, block_words=3)[0] == want
    extra = df.withColumn("SPANS", F.lit("kept"))
    out, names = decontam.decontaminate(extra, bench.where("false"))
    assert out.where(F.size(names["spans"]) > 0).count() == 0 and out.columns[:3] == extra.columns and names["spans"] == "_spans"
    assert decontam.decontaminate(df.where("false"), bench)[0].collect() == []


def test_proximity(spark):
    df = spark.createDataFrame([(1, "red x x fish x blue"), (2, "fish red"), (3, "red blue x x x x x x x fish")], "doc_id long, text string")
    bench = spark.createDataFrame([(9, "blue red fish")], "item_id long, text string")
    assert hits(df, bench, near=5)[1] == {1: ["9"], 2: [], 3: []}


def brute_topk(rows, k):
    ok = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    first = {}
    for i, v in ok:
        if i % 20 == 0:
            first[i] = min(first.get(i, (len(v), v)), (len(v), v))
    out = set()
    for q, (n, v) in first.items():
        scores = sorted((-sum(a * b for a, b in zip(v, c)), i) for i, c in ok if i != q and len(c) == n)
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])}
    return out


def test_topk_edge_cases(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, 0.3]) for _ in range(4)]) for i in range(120)]
    rows += [(200, None), (201, [1.0, None, 0.0, 0.0]), (202, [float("nan")] * 4), (203, [float("inf"), 0.0, 0.0, 0.0]),
             (None, [1.0] * 4), (20, [0.1, 0.2, 0.3, 0.4]), (204, [1.0, 2.0]), (220, [3.0, 1.0]), (240, []), (205, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    import numpy as np
    exact = [(i, v and [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    for options in ({}, {"block_rows": 3, "shard_rows": 7, "fan_in": 2}):
        got = {tuple(r) for r in topk.exact_topk(df.where("vec_id % 20 = 0"), df, 5, **options).collect()}
        assert got == brute_topk(exact, 5)
    assert topk.exact_topk(df.where("false"), df, 5).collect() == [] == topk.exact_topk(df, df.where("false"), 5).collect()
    with pytest.raises(ValueError):
        topk.exact_topk(df, df, 0)


def test_topk_large_values(spark):
    rows = [(0, [3e9, -2e9]), (1, [2e9, 1.0]), (2, [2e9, 0.5]), (3, [1e30, -1e30]), (20, [1.0, 0.0])]
    got = topk.exact_topk(*[spark.createDataFrame(rows, "vec_id long, embedding array<double>")] * 2, 2).collect()
    assert [r.vec_id for r in sorted(got) if r.query_id == 20] == [3, 0]


def test_url_parts_and_rules(spark):
    rows = [(1, "HTTP://A.Example.NET/en/x?q=/de/"), (2, None), (3, "no scheme"), (4, "http://net"), (5, "x://org/fr/#a"),
            (6, "http://sub.example.com/de/1"), (7, "http://notexample.com/de/1"), (8, "http://a.b://c"), (9, "http:///p"), (9, "http://q.net/fr/")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("bad", F.lit(1))
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
    got = [tuple(r)[:5] for r in urls.url_filter(pages, spark.createDataFrame([], "doc_id long, bad int"), rules).collect()]
    want = [(1, "a.example.net", "/en/x", "example.net/en/", "allow"), (2, "", "", None, "allow"), (3, "", "", None, "allow"),
            (4, "net", "", None, "allow"), (5, "org", "/fr/", "org/fr/", "allow"), (6, "sub.example.com", "/de/1", "example.com/de/", "block"),
            (7, "notexample.com", "/de/1", None, "allow"), (8, "a.b:", "//c", None, "allow"), (9, "", "/p", None, "allow"),
            (9, "q.net", "/fr/", "net/", "block")]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_reputation_shrinks_hosts(spark):
    rows = [(i, f"http://bad.evil.com/{i}") for i in range(40)] + [(100 + i, f"http://h{i % 9}.fine.org/{i}") for i in range(200)]
    rows += [(400, "http://new.evil.com/"), (401, "http://new.fine.org/"), (402, "http://x.co.uk/")]
    labels = [(i, 1) for i in range(40)] + [(100 + i, int(i % 50 == 0)) for i in range(200)] + [(0, 0), (3, None), (9999, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    marks = spark.createDataFrame(labels, "doc_id long, bad int")
    got = {r.page_id: r for r in urls.url_filter(pages, marks, []).collect()}
    assert got[1].verdict == "block" and got[150].verdict == "allow" and got[401].verdict == "allow"
    assert got[401].mean < got[402].mean < got[400].mean < got[1].mean
    assert urls.url_filter(pages.where("false"), marks, []).collect() == []


def test_suffix_levels(spark):
    hosts = ["a.site1.com.sg", "site2.com.sg", "com.sg", "x.shop.co.uk:8080", "me.github.io", "you.github.io", "plain", "", "h.example.org"]
    want = {"a.site1.com.sg": ("com.sg", "site1.com.sg"), "site2.com.sg": ("com.sg", "site2.com.sg"), "com.sg": ("com.sg", "com.sg"),
            "x.shop.co.uk:8080": ("co.uk", "shop.co.uk"), "me.github.io": ("github.io", "me.github.io"), "you.github.io": ("github.io", "you.github.io"),
            "plain": ("plain", "plain"), "": ("", ""), "h.example.org": ("org", "example.org")}
    df = spark.createDataFrame([(h,) for h in hosts], "host string")
    listed = ["com.sg", "co.uk", "github.io"]
    table = spark.createDataFrame([(x,) for x in ("COM.SG", "co.uk", "github.io", "io", None, "com.sg")], "suffix string")
    for suffixes in (listed, table):
        got = {r.host: (r.suffix, r.domain) for r in urls._levels(df, suffixes).collect()}
        assert got == want


def found(df, **options):
    out, name = licenses.scan_licenses(df, **options)
    return [{(x["license"], x["template"]): (x["word"], round(x["containment"], 3)) for x in r[name]} for r in out.collect()]


def test_license_scan(spark):
    rng = random.Random(6)
    fill = lambda n: " ".join(f"w{rng.randint(0, 9999)}" for _ in range(n))
    t = [x for _, x in licenses.TEMPLATES]
    long = t[9].split()
    near = " ".join(long[:20] + ["changed"] + long[21:])
    texts = [fill(300) + "\n" + x.upper() + " " + fill(rng.randint(0, 50)) for x in t]
    texts += [fill(500), None, "", "too short", near, " ".join(long[: len(long) // 2]), fill(3000) + t[4] + fill(2) + " " + t[4], t[4]]
    got = found(spark.createDataFrame([(x,) for x in texts], "text string"))
    for i, g in enumerate(got[: len(t)]):
        assert g[licenses.TEMPLATES[i][0], i][0] in (300, 299) and g[licenses.TEMPLATES[i][0], i][1] == 1.0
    rest = got[len(t):]
    assert rest[:4] == [{}] * 4 and ("MIT", 9) in rest[4] and 0.8 <= rest[4]["MIT", 9][1] < 1 and ("MIT", 9) not in rest[5]
    assert list(rest[6]) == [("CC-BY-NC-4.0", 4)] and rest[7] == {("CC-BY-NC-4.0", 4): (0, 1.0)}


def test_license_columns_and_empty(spark):
    df = spark.createDataFrame([("MIT", "Mine own")], "licenses string, text string")
    out, name = licenses.scan_licenses(df, [("short", "mine OWN"), ("none", "!!"), ("MIT", "a b c d e f")])
    assert name == "_licenses" and [x["license"] for x in out.first()[name]] == ["short"]
    assert licenses.scan_licenses(df.where("false"))[0].collect() == []
    assert licenses.bands(0.3, 1e-6)[0] >= 30


def test_license_scan_signs_only_windows_near_statements(spark, monkeypatch):
    rng = random.Random(7)
    texts = [" ".join(f"w{rng.randint(0, 9999)}" for _ in range(300)) for _ in range(100)]
    texts[5] += " " + licenses.TEMPLATES[8][1]
    texts[50] = licenses.TEMPLATES[9][1] + " " + texts[50]
    texts += [licenses.TEMPLATES[1][1][:40] + " " + texts[0], None]
    df = spark.createDataFrame([(x,) for x in texts], "text string").coalesce(1)
    want = found(df)
    assert want[5] == {("MIT", 8): (300, 1.0)} and want[50] == {("MIT", 9): (0, 1.0)} and sum(map(bool, want)) == 2
    sign = licenses.smallest_hashes

    def few(shingle, *rest):
        if len(shingle) > 500:  # of about 30,000
            raise ValueError(f"{len(shingle)} shingles signed")
        return sign(shingle, *rest)

    monkeypatch.setattr(licenses, "smallest_hashes", few)
    assert found(df) == want


@pytest.mark.parametrize("options", [{}, {"containment": 0.5}, {"k": 2, "containment": 1.0}])
def test_license_scan_equals_plain_containment(spark, options):
    k, least = options.get("k", 5), options.get("containment", 0.8)
    rng = random.Random(8)
    statements = [x for _, x in licenses.TEMPLATES]

    def text():
        w = rng.choice(statements).split()
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = rng.choice(["the", "license", "other"])
        parts = [" ".join(w[rng.randint(0, 2):])] * rng.randint(0, 2) + [" ".join(f"w{rng.randint(0, 9)}" for _ in range(rng.randint(0, 40)))]
        return " ".join(rng.sample(parts, len(parts)))

    def sets(x):
        w = "".join(c if c.isalnum() else " " for c in (x or "").lower()).split()
        return [tuple(w[i:i + k]) for i in range(len(w) - k + 1)]

    texts = [*(text() for _ in range(200)), None, "", "MIT", *statements, " ".join(statements)]
    got = found(spark.createDataFrame([(x,) for x in texts], "text string").coalesce(1), **options)
    assert any(got)
    for x, g in zip(texts, got, strict=True):
        own = sets(x)
        for number, statement in enumerate(statements):
            want = set(sets(statement))
            share = max((len(want & set(own[i: i + len(want)])) / len(want) for i in range(len(own))), default=0)
            hit = {t: h for (_, t), h in g.items()}.get(number)
            if share >= least:  # a whole statement's length holds enough
                assert hit and hit[1] >= round(share, 3)
            if hit:  # what is found holds as much within the longest window and its neighbours
                near = own[hit[0]: hit[0] + 4 * len(want) + 8]
                assert hit[1] >= least and own[hit[0]] in want and round(len(want & set(near)) / len(want), 3) >= hit[1]


def test_license_query_finds_every_statement(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id for r in QUERIES["op8_license_scans"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = {r.doc_id for r in docs.where("text rlike '(Licensed under|licensed under the|Released under the MIT)'").collect()}
    assert got >= want and len(got - want) == 0


WITHOUT_PACKAGE = """
import sys
sys.path.insert(0, sys.argv[1])
from docrank.session import local_session
from docrank.llm.queries import QUERIES
spark = local_session(2, 2)
for name in sys.argv[2:]:
    print(name, QUERIES[name](spark, "/root/testdata/sf0.001").count())
"""


def test_workers_need_no_package(tmp_path):
    """Started outside the repository, workers can't import the package: what is sent to them must hold all they need."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    script = tmp_path / "run.py"
    script.write_text(WITHOUT_PACKAGE)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    names = [n for n in QUERIES if n not in ("op7_exact_topk_search", "op9_url_filter")]
    done = subprocess.run([sys.executable, str(script), root, *names], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-3000:]
    assert [x.split()[0] for x in done.stdout.splitlines() if x.startswith("op")] == names
