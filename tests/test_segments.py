"""Indexes that grow by segments equal rebuilds; what an addition writes grows with the addition."""

import os
import random

import pytest
from pyspark.sql import functions as F

from docrank import build_index, search_batch
from docrank.operators import util
from docrank.operators.index import IndexOptions
from docrank.operators.segments import add_records, create_segments, open_segments
from docrank.sources import rangetable


def corpus(rng, lo, hi):
    words = [f"word{i}" for i in range(50)]
    return [(i, " ".join(["common"] + rng.choices(words, k=rng.randint(0, 20)))) for i in range(lo, hi)] + [(hi, ""), (hi + 1, None)]


def equal(spark, segments, records):
    docs = spark.createDataFrame(records, "doc_id long, text string")
    want = build_index(docs, stem=segments.options.stem)
    got = segments.index()
    rounded = lambda df, *cols: sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.select(*cols).collect())
    assert segments.n_docs == len(records)
    assert rounded(got.terms, "term", "df", "idf") == rounded(want.terms, "term", "df", "idf")
    assert rounded(got.postings, "term", "doc_id", "tf", "weight") == rounded(want.postings, "term", "doc_id", "tf", "weight")
    norms = lambda i: {r.doc_id: r.norm for r in i.norms.collect()}
    a, b = norms(got), norms(want)
    assert a.keys() == b.keys() and all(abs(a[i] ** 2 - b[i] ** 2) < 1e-9 * max(1.0, b[i] ** 2) for i in a)
    asked = spark.createDataFrame([(i, f"common word{i} word{i + 9} unknown") for i in range(6)], "query_id long, text string")
    found = lambda i: sorted(map(tuple, search_batch(i, asked, 4, digits=6).collect()))
    assert found(got) == found(want) != []


@pytest.mark.parametrize("fanout,far", [(2, False), (4, True)])
def test_equals_a_rebuild(spark, tmp_path, monkeypatch, fanout, far):
    if far:  # no table is broadcast, no query side held on the driver
        monkeypatch.setattr(util, "MAX_BROADCAST_BYTES", -1)
        monkeypatch.setattr(rangetable, "FEW", 3)
    rng = random.Random(fanout)
    s, records, path = create_segments(spark, str(tmp_path / "s"), IndexOptions(stem=False)), [], str(tmp_path / "s")
    for lo in range(0, 150, 30):
        batch = corpus(rng, lo, lo + 25)
        s = add_records(s, spark.createDataFrame(batch, "doc_id long, text string"), fanout=fanout)
        records += batch
        if lo == 60:  # ids that come again, with new and with old terms, and an id repeated within the batch
            batch = [(3, "common word1 fresh"), (3, "word1"), (30, ""), (95, "new alone"), (31, "word2 " * 9)]
            s = add_records(s, spark.createDataFrame(batch, "doc_id long, text string"), fanout=fanout)
            records += batch
            equal(spark, s, records)
    equal(spark, s, records)
    again = open_segments(spark, path)
    assert again.parts == s.parts and again.version == s.version == 7
    levels = [level for _, level in s.parts]
    assert all(levels.count(x) < fanout for x in levels)


def written_bytes(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def test_additions_write_in_proportion(spark, tmp_path):
    rng = random.Random(7)
    path = str(tmp_path / "s")
    text = lambda: " ".join(f"w{int(rng.paretovariate(0.6)) % 4000}" for _ in range(200))
    s = create_segments(spark, path, IndexOptions(stem=False))
    s = add_records(s, spark.createDataFrame([(i, text()) for i in range(1500)], "doc_id long, text string"))
    whole = written_bytes(path)
    before = {f for f in os.listdir(path + "/segments")}
    s = add_records(s, spark.createDataFrame([(5000 + i, text()) for i in range(15)], "doc_id long, text string"))
    new = set(os.listdir(path + "/segments")) - before
    own = sum(written_bytes(f"{path}/segments/{n}/{kind}") for n in new for kind in ("counts", "terms", "docs"))
    assert len(new) == 1 and own < whole / 15  # counts and df of the new records only; no posting is rewritten
    sums = s.table(new.pop(), "sums").rows()
    touched = build_index(spark.createDataFrame([(i, "") for i in range(1)], "doc_id long, text string"))
    assert touched.postings.count() == 0 and sums.count() <= 1515  # a row for each document that holds a changed term


def test_empty_and_errors(spark, tmp_path):
    path = str(tmp_path / "s")
    with pytest.raises(FileNotFoundError):
        open_segments(spark, path)
    s = create_segments(spark, path, IndexOptions(), "string")
    with pytest.raises(FileExistsError):
        create_segments(spark, path)
    none = spark.createDataFrame([], "doc_id string, text string")
    assert add_records(s, none).parts == ()
    asked = spark.createDataFrame([(0, "ring")], "query_id long, text string")
    assert search_batch(s.index(), asked).collect() == []
    s = add_records(s, spark.createDataFrame([("a", "rings"), ("b", "")], "doc_id string, text string"))
    assert [tuple(r) for r in search_batch(s.index(), asked).select("doc_id").collect()] == [("a",)]
    assert s.norms().where(F.col("norm") >= 0).count() == 2
