"""The filter audit against a plain-Python run of every order, over many micro-batches."""

import random
import re
from itertools import permutations

import duckdb
import pandas as pd
import pytest

from docrank.llm import audit
from docrank.llm.queries import ORACLE_SQL
from tests.llm import brute


def plain(docs, labels):
    """Rows of the report: every order is run document by document."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    texts = {}
    for i, text, _ in docs:
        if i is not None:
            texts[text or ""] = min(texts.get(text or "", i), i)
    rows = []
    for i, text, part in docs:
        text = text or ""
        w = brute.OP5_WORD.findall(text)
        fails = {f for f, x in zip("ABCDE", (len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
                                             bool(re.search("[#$%&*|]", text)), i is not None and texts[text] < i)) if x}
        rows.append((part or "", fails, i in good, i in toxic))
    out = {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone, before = [r for r in left if f in r[1]], set(order[: step - 1])
                left = [r for r in left if f not in r[1]]
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in r[1] and bool(r[1] & before) for r in own), sum(r[1] == {f} for r in own),
                    sum(r[2] for r in gone), sum(r[3] for r in gone)]
    shares = {}
    for (part, order, step), v in out.items():
        shares[part, order[step - 1]] = shares.get((part, order[step - 1]), 0) + v[1]
    return sorted((*k, *v, shares[k[0], k[1][k[2] - 1]]) for k, v in out.items())


def corpus(rng):
    word = lambda: rng.choice(["red", "Blue", "green", "X", "a|b", "é", "long-word"]) + str(rng.randint(0, 60))
    texts = [" ".join(word() for _ in range(rng.choice([5, 49, 50, 51, 120]))) for _ in range(25)] + ["", "AAA", "x\x0by\tz", "word " * 4000]
    rows = [(i, rng.choice(texts), rng.choice(["s1", "s2", None])) for i in range(160)]
    rows += [(1000 + i, texts[0], "s1") for i in range(90)]  # a third of all rows are one text
    rows += [(500, texts[0], "s2"), (500, texts[0], "s2"), (500, texts[1], "s1"), (None, texts[0], "s1"), (None, None, "only"), (None, texts[2], None)]
    rows += [(2 ** 60 + 1, texts[3], "big"), (2 ** 60, texts[3], "big"), (2 ** 60 + 1, "alone", "big"), (-5, None, "s1"), (7, None, "s2")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 160, 3)] + [(500, 0, 1), (500, 1, 0), (None, 1, 1), (99999, 1, 1)]
    return rows, labels


@pytest.mark.parametrize("options", [{}, {"batch_files": 1, "texts_a_key": 1}, {"batch_files": 2, "texts_a_key": 1000}])
def test_equals_every_order_run(spark, tmp_path, options):
    """Files in an order in which smaller ids arrive late, one or two a micro-batch: masks are retracted."""
    docs, labels = corpus(random.Random(2))
    path = str(tmp_path / "documents.parquet")
    order = sorted(docs, key=lambda r: -(r[0] or 0))
    for lo in range(0, len(order), 70):
        spark.createDataFrame(order[lo: lo + 70], "doc_id long, text string, source string").coalesce(1).write.mode("append").parquet(path)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    settings = [*audit.STATE, audit.PARTITIONS]
    before = [spark.conf.get(k, None) for k in settings]
    got = sorted(map(tuple, audit.audit_filters(spark, path, marks, **options).collect()))
    assert got == plain(docs, labels) and [spark.conf.get(k, None) for k in settings] == before
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(docs, columns=["doc_id", "text", "source"]).astype({"doc_id": "Int64"}))
    con.register("labels", pd.DataFrame(labels, columns=["doc_id", "quality", "toxic"]).astype("Int64"))
    assert sorted(con.execute(ORACLE_SQL["op12_filter_audit"]).fetchall()) == got


def test_clashing_columns_and_empty(spark, tmp_path):
    path = str(tmp_path / "one")
    rows = [(1, "x", "a", 5), (0, "x", "b", 6)]
    spark.createDataFrame(rows, "doc_id long, text string, source string, MASK int").withColumnRenamed("text", "key").write.parquet(path)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r.part: r.n for r in audit.mask_counts(spark, path, none, text_col="key").where("mask >= 16").collect()}
    assert got == {"a": 1}
    spark.createDataFrame([], "doc_id long, text string, source string").write.parquet(str(tmp_path / "empty"))
    assert audit.audit_filters(spark, str(tmp_path / "empty"), none).collect() == []


class Held:
    """A state as the stream passes it."""

    def __init__(self):
        self.value, self.exists = None, False

    @property
    def get(self):
        return self.value

    def update(self, value):
        self.value, self.exists = value, True


def test_smaller_ids_retract():
    state, total = Held(), {}
    frame = lambda *rows: pd.DataFrame(rows, columns=["key", "id", *audit.COUNTER, "n"])
    calls = [frame((b"t", 9, "p", 1, False, False, 2)), frame((b"t", 12, "q", 1, True, False, 1)), frame((b"t", 3, "q", 1, False, True, 1)),
             frame((b"t", 3, "r", 1, False, True, 1), (None, 0, "p", 2, False, False, 4))]
    seen = []
    for rows in calls:
        change = {tuple(r[:4]): r[4] for out in audit.update((0,), iter([rows]), state) for r in out.itertuples(index=False)}
        seen.append(change)
        for k, n in change.items():
            total[k] = total.get(k, 0) + n
    assert seen[2] == {("p", 1, False, False): -2, ("p", 17, False, False): 2, ("q", 1, False, True): 1}
    assert {k: n for k, n in total.items() if n} == {
        ("p", 17, False, False): 2, ("q", 17, True, False): 1, ("q", 1, False, True): 1, ("r", 1, False, True): 1, ("p", 2, False, False): 4}


def test_labels_are_not_broadcast(spark):
    """Their rows, eight times, would be held on the driver, however small their files are."""
    docs = spark.createDataFrame([(1, "x", "a"), (2, "y", None)], "doc_id long, text string, source string")
    marks = spark.createDataFrame([(1, True, False)], "id long, good boolean, toxic boolean")
    rows = audit.described(docs, marks, "doc_id", "text", "source", 3)
    assert "BroadcastHashJoin" not in rows._jdf.queryExecution().sparkPlan().toString()
    assert sorted((r.id, r.good, r.toxic) for r in rows.collect()) == [(1, True, False), (2, False, False)]
