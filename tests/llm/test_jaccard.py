import random

import numpy as np
import pyarrow as pa
import pytest

from docrank.llm import arrays, graph, jaccard
from tests.llm import brute

SF001 = "/root/testdata/sf0.001"


def check(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out, names = jaccard.near_copies(df, **options)
    got = sorted((r.doc_id, r[names["n_shingles"]], r[names["component"]], r[names["n_links"]]) for r in out.collect())
    assert got == sorted(brute.components(rows, options.get("percent", 90), options.get("k", 3)))


def copies(rng, n, words, changes):
    vocabulary = [f"w{i}" for i in range(5000)]
    base = [rng.choice(vocabulary) for _ in range(words)]
    out = []
    for _ in range(n):
        t = list(base)
        for _ in range(rng.randint(0, changes)):
            t[rng.randrange(words)] = rng.choice(vocabulary)
        out.append(" ".join(t))
    return out


def test_shingles_match_plain_python():
    texts = ["A b c d", "x\ty", "", None, "one", "a b c a b c a b", "É b\x0bc\x1cd é", "  lead  trail "]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    h, at = jaccard.sets(batch, "text", 3)
    want = brute.word_sets(list(enumerate(texts)))
    assert [int(n) for n in np.diff(at)] == [len(s) for s in want]
    table = {}
    for i, s in enumerate(want):
        for x in h[at[i]: at[i + 1]]:
            table.setdefault(int(x), []).append(i)
    shared = {frozenset(v) for v in table.values() if len(v) > 1}
    assert shared == {frozenset(i for i, s in enumerate(want) if x in s) for s in want for x in s
                      if sum(x in t for t in want) > 1}


def test_overlaps_are_the_matrix_product(monkeypatch):
    rng = np.random.default_rng(1)
    monkeypatch.setattr(jaccard, "PAIRS", 50)
    monkeypatch.setattr(jaccard, "COLUMNS", 3)
    rows = [np.unique(rng.integers(0, 60, rng.integers(0, 40))).astype(np.uint64) for _ in range(40)]
    at = np.r_[0, np.cumsum([len(r) for r in rows])]
    got = jaccard.overlaps(np.concatenate(rows), at)
    want = [[len(np.intersect1d(a, b)) for b in rows] for a in rows]
    off = ~np.eye(40, dtype=bool)
    assert np.array_equal(got[off], np.array(want)[off])


@pytest.mark.parametrize("part_rows", [512, 7])
def test_near_copy_groups(spark, part_rows):
    rng = random.Random(part_rows)
    texts = copies(rng, 40, 90, 4) + copies(rng, 25, 30, 2) + copies(rng, 10, 400, 25) + copies(rng, 5, 6, 1)
    texts += ["", None, "a", "a", "A", "a b", "a b c", "a b c", "a  b\nc d", "a b c d e f"] + [texts[0]] * 4
    rng.shuffle(texts)
    check(spark, [(i * 3, t) for i, t in enumerate(texts)], part_rows=part_rows, shard_bytes=3000, max_frequent=50 if part_rows > 100 else 5000)


def test_documents_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    check(spark, rows)
    check(spark, rows, percent=70, shard_bytes=50_000)


def test_repeated_and_null_ids(spark):
    t = " ".join(f"w{i}" for i in range(50))
    rows = [(5, t), (5, t), (5, t + " x"), (None, t + " y"), (7, t), (8, None), (8, None), (9, "other words here now")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out, names = jaccard.near_copies(df)
    got = [(r.doc_id, r[names["n_shingles"]], r[names["component"]], r[names["n_links"]]) for r in out.collect()]
    assert len(got) == len(rows)
    assert {g[2:] for g in got if g[1] in (48, 49)} == {(None, 3)}
    assert [g for g in got if g[0] in (8, 9)] and all(g[2] == g[0] and g[3] == 0 for g in got if g[0] in (8, 9))


def test_empty_table_and_columns(spark):
    df = spark.createDataFrame([], "doc_id long, text string, component string, row_key int")
    out, names = jaccard.near_copies(df)
    assert out.collect() == [] and names["component"] == "_component" and out.columns[:4] == df.columns
    with pytest.raises(ValueError):
        jaccard.near_copies(df, percent=10)


def test_components_of_a_long_path(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 99), (7, 7)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(links, "u long, v long").repartition(5)).collect()}
    assert got == {**{i: 0 for i in range(61)}, 99: 99, 100: 99, 101: 99}


@pytest.mark.parametrize("percent", [60, 80, 90])
@pytest.mark.parametrize("max_frequent", [0, 40, 5000])
def test_candidates_lose_no_pair(spark, percent, max_frequent):
    """Links equal brute force, whatever shingles count as frequent and however many shards there are."""
    rng = random.Random(percent)
    texts = []
    for words in (3, 8, 12, 30, 90, 300):
        texts += copies(rng, 12, words, max(1, words // 12))
    rng.shuffle(texts)
    check(spark, list(enumerate(texts)), percent=percent, k=1, shard_bytes=700, max_frequent=max_frequent)


def chained(rng, n):
    """Texts that share passages with their neighbours, each with a near copy: chains of candidates by single shingles."""
    word = lambda: f"w{rng.randint(0, 10 ** 6)}"
    passages = [[word() for _ in range(60)] for _ in range(n // 8 + 2)]
    texts = []
    for i in range(n):
        own = [word() for _ in range(150)]
        t = own[:50] + passages[i // 8] + own[50:100] + passages[i // 8 + 1] + own[100:]
        texts.append(" ".join(t))
        if i % 3 == 0:
            for _ in range(2):
                t = list(t)
                t[rng.randrange(len(t))] = word()
                texts.append(" ".join(t))
    return texts


def test_shared_passages_do_not_chain(spark):
    """At 80 %, blocks hold near copies, not the texts that only share a passage; links equal brute force."""
    rng = random.Random(9)
    texts = chained(rng, 90)
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    check(spark, rows, percent=80, k=5)
    check(spark, rows, percent=80, k=5, part_rows=2, shard_bytes=2000, max_frequent=300)
    src = spark.createDataFrame(rows, "key long, text string").repartition(4)
    blocks = jaccard._blocks(src, 5, 80, 1 << 20, 1 << 16).groupBy("component").count().collect()
    assert {r["count"] for r in blocks} == {3} and len(blocks) == 30


def test_forest_keeps_reach():
    u, v = arrays.forest(np.array([5, 3, 9, 8]), np.array([3, 1, 8, 9]))
    assert dict(zip(u.tolist(), v.tolist())) == {5: 1, 3: 1, 9: 8}
