"""The pipeline against the same steps in plain Python, and its stages on awkward tables."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from docrank.llm import langid, zdict
from docrank.llm.queries import QUERIES
from docrank.llm.tables import held_out
from tests.llm import brute
from tests.llm.test_packing import ids_of

SF001 = "/root/testdata/sf0.001"


def removed(rows):
    """Rows without repeated strings, characters that a cut splits, and texts of which only space is left."""
    seen, out = set(), []
    for i, text in sorted(rows):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for j in range(len(data) - 99):
            s = data[j: j + 100]
            if s in seen:
                gone[j: j + 100] = True
            seen.add(s)
        left = bytes(np.frombuffer(data, np.uint8)[~gone]).decode("utf-8", "ignore") if gone.any() else text
        if not gone.any() or left.strip():
            out.append((i, left))
    return out


def test_run_equals_plain_python(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    models = [zdict.primed(c, **langid.PARAMETERS) for _, c in langid.train(docs, ~held_out("doc_id"))]

    def told(text):
        sizes = sorted(langid.sizes(text, models)) if langid.sizes(text, models) else None
        return sizes and not ((sizes[1] - sizes[0]) / sizes[0] < 0.002 and len(zdict.letters(text)) >= 40)

    rows = [r for r in rows if told(r[1])]
    rows = [r for r, c in zip(rows, brute.components(rows, 80, 5)) if c[0] == c[2]]
    rows = removed(rows)
    items = [tuple(r) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").select("item_id", "text").collect()]
    hit = brute.phrases(rows, items)
    rows = [r for r in rows if not hit[r[0]][1]]
    want = {}
    for (i, _), ids in zip(rows, ids_of(rows)):
        first = len(ids) % 2048 or min(len(ids), 2048)
        for k, (s, n) in enumerate([(0, first)] + [(s, 2048) for s in range(first, len(ids), 2048)]):
            want[i, k] = (s, n, zlib.crc32(np.array(ids[s: s + n], "<u4").tobytes()))
    got = QUERIES.get("pipeline", pipeline.run)(spark, SF001).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == want and len(got) == len(want)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) <= 2048


def awkward(spark):
    long = " ".join(f"word{i} and" for i in range(400))
    rows = [(1, long, "en", "s", 1), (1, long, "en", "s", 1), (2, long + " more", None, None, None), (3, None, None, None, None),
            (4, "", "en", "s", 0), (None, "a text without an id that has some words of its own here", "en", "s", 3), (5, "12 34", "en", "s", 5),
            (6, "kurz", "de", "s", 4)] + [(10 + i, f"der und die das nicht {i} " * 12, "de", "s", 9) for i in range(6)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.mark.parametrize("kind", ["awkward", "empty", "extra"])
def test_stages_on_awkward_tables(spark, kind):
    docs = awkward(spark)
    if kind == "empty":
        docs = docs.where("false")
    if kind == "extra":
        for c in ("score", "spans", "kept", "component", "row_key", "SIZE"):
            docs = docs.withColumn(c, F.lit(c))
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF001)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert kind != "empty" or rows == []
        ids = [r.doc_id for r in rows]
        if kind != "empty":
            assert set(ids) >= {4, 6} or name == "language ID", name
            assert ids.count(1) == (1 if name == "n-gram Jaccard join" else ids.count(1))
    packed = pipeline.STAGES[-1][1](spark, docs, SF001)
    assert packed.where("piece = 0").count() == docs.count()
