"""Written indexes: versions, publishing, pruning, frequent terms, byte bounds."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from docrank import (build_fulltext, build_index, compare, drop_old_versions, fulltext_lexemes, fulltext_search_batch, hydrate,
                     merge_index, read_fulltext, read_index, search, search_batch, stored_lexemes, write_fulltext, write_index)
from docrank.operators import index as IX
from docrank.operators import util
from docrank.session import checkpoint_dir
from docrank.sources import rangetable


def corpus(spark, n=120, seed=1):
    rng = random.Random(seed)
    words = [f"word{i}" for i in range(60)]
    rows = [(f"d{i:03d}", " ".join(["common"] + rng.choices(words, k=rng.randint(1, 30))), "en") for i in range(n)]
    return spark.createDataFrame(rows, "doc_id string, text string, lang string")


def queries(spark, n=8):
    return spark.createDataFrame([(i, f"common word{i} word{i + 7} unknown{i}") for i in range(n)], "query_id long, text string")


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_far_sides_give_the_same_rows(spark, monkeypatch, tmp_path):
    docs, asked = corpus(spark), queries(spark)
    idx = build_index(docs, stem=True)
    near = rows(search_batch(idx, asked, 5, digits=9))
    written = write_index(idx, str(tmp_path / "near"))
    lex = fulltext_lexemes(docs, "doc_id", (("text", "B"), ("lang", "C")))
    near_text = rows(fulltext_search_batch(lex, asked, 5))
    near_docs = rows(hydrate(search_batch(idx, asked, 5, digits=9), docs))
    monkeypatch.setattr(util, "MAX_BROADCAST_BYTES", -1)
    monkeypatch.setattr(util, "HEAVY_SHARE", 1 / 50)
    far = build_index(docs, stem=True)
    assert rows(search_batch(far, asked, 5, digits=9)) == near
    assert rows(search_batch(written, asked, 5, digits=9)) == near
    assert rows(search_batch(write_index(far, str(tmp_path / "far")), asked, 5, digits=9)) == near
    assert rows(fulltext_search_batch(lex, asked, 5)) == near_text
    assert rows(fulltext_search_batch(write_fulltext(lex, str(tmp_path / "w")), asked, 5)) == near_text
    assert rows(hydrate(search_batch(far, asked, 5, digits=9), docs)) == near_docs


def test_frequent_keys_are_split(spark, monkeypatch):
    monkeypatch.setattr(util, "HEAVY_SHARE", 1 / 100)
    large = spark.range(2000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 4 > 0, "hot").otherwise(
        F.concat(F.lit("t"), (F.col("id") % 80).cast("string"))).alias("term"))
    sizes = large.groupBy("term").agg(F.count("*").alias("df"))
    small = sizes.select("term", (F.col("df") * 2).alias("v"))
    conf = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        joined = util.split_join(large, small, sizes, "term", "df", "doc_id")
        parts = joined.where("term = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
        assert joined.count() == 2000 and rows(joined) == rows(large.join(small, "term"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", conf)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert parts > 8


def scans(plan, column):
    """(files, rows) read by the scans of an executed plan that read ``column``."""
    out, todo = [], [plan._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        if kind == "FileSourceScanExec" and column in node.toString():
            value = lambda name: node.metrics().apply(name).value()
            out.append((value("numFiles"), value("numOutputRows")))
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return out


def many_terms(spark, n=30_000):
    """Documents of 20 words each from a vocabulary of 5,000, written with small row groups and files."""
    word = lambda i: F.concat(F.lit("t"), F.lpad(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(5000)).cast("string"), 4, "0"))
    return spark.range(n).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *(word(i) for i in range(20))).alias("text"))


def test_search_reads_only_the_row_groups_of_its_terms(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(rangetable, "LEAST_FILE_ROWS", 1000)
    monkeypatch.setattr(rangetable, "ROW_GROUP_BYTES", 1 << 16)
    docs = many_terms(spark)
    built = build_index(docs, stem=False)
    total = built.postings.count()
    idx = write_index(built, str(tmp_path / "i"))
    files = idx.tables["postings"].directory().collect()
    assert len(files) == spark.sparkContext.defaultParallelism and sum(f.n for f in files) == total
    asked = [f"t{i:04d}" for i in (7, 1500, 4999)]
    found = search(idx, " ".join(asked) + " nosuchterm", 10)
    got = rows(found)
    assert got == rows(search(built, " ".join(asked) + " nosuchterm", 10)) and got
    matching = built.postings.where(F.col("term").isin(asked)).count()
    (opened, read), = scans(found, "nweight")
    assert opened <= 3 < len(files) and matching <= read < total / 20
    text = found._jdf.queryExecution().executedPlan().toString()
    assert all(t in text.split("PushedFilters: [")[1].split("]")[0] for t in asked)
    # All terms of a large batch at once: the same rows by the whole tables.
    queries = docs.where("doc_id % 1000 = 0").select(F.col("doc_id").alias("query_id"), "text")
    few_rows = rows(search_batch(idx, queries, 3, digits=9))
    monkeypatch.setattr(rangetable, "FEW", 5)
    assert rows(search_batch(idx, queries, 3, digits=9)) == few_rows == rows(search_batch(built, queries, 3, digits=9))
    assert rows(search(idx, "nosuchword")) == []


def test_range_table_lookup(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(rangetable, "LEAST_FILE_ROWS", 50)
    keys = ["", "a", "a\u0000", "b", "é", "z", "\U0001F600", "\uFFFD"]
    df = spark.range(2000).select(F.element_at(F.array(*map(F.lit, keys), F.lit(None)), (F.col("id") % 9 + 1).cast("int")).alias("k"), "id")
    table = rangetable.write_ranges(df, str(tmp_path / "t"), "k", ("id",))
    assert rows(table.rows().groupBy().count()) == [(2000,)] and sum(r.nulls for r in table.directory().collect()) == 222
    for asked in (["b"], keys, ["nope"], [], [None], [None, "z", "zz"], [f"x{i}" for i in range(1000)] + ["é"]):
        want = rows(df.where(F.col("k").isin([k for k in asked if k is not None] or ["nope"])))
        assert rows(table.lookup(asked)) == want
    order = [(r.file_, r.place, r.k, r.id) for r in table.placed().collect()]
    assert [x[2:] for x in sorted(order)] == sorted((x[2:] for x in order), key=lambda x: (x[0] is not None, (x[0] or "").encode(), x[1]))
    empty = rangetable.write_ranges(df.where("false"), str(tmp_path / "e"), "k")
    assert empty.lookup(["a"]).collect() == [] and empty.rows().count() == 0


def test_versions_are_published_last(spark, tmp_path):
    path = str(tmp_path / "i")
    with pytest.raises(FileNotFoundError):
        read_index(spark, path)
    first = write_index(build_index(corpus(spark, 30)), path)
    before = rows(first.postings)
    # A write that stops before its row is published leaves the version before it.
    first.terms.write.parquet(f"{path}/data/version=2/terms/rows")
    assert rows(read_index(spark, path).postings) == before
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        write_index(build_index(corpus(spark, 5)), path)
    assert rows(read_index(spark, path).postings) == before
    with pytest.raises(FileExistsError):
        write_index(first, path, mode="error")
    with pytest.raises(ValueError):
        write_index(first, path, mode="append")


def test_write_to_the_path_that_is_read(spark, tmp_path):
    path, docs = str(tmp_path / "i"), corpus(spark, 60)
    write_index(build_index(docs.where("doc_id < 'd030'")), path)
    for materialize in (False, True):
        grown = merge_index(read_index(spark, path, 1), docs.where("doc_id >= 'd030'"), materialize=materialize)
        idx = write_index(grown, path)
        assert idx.n_docs is not None and rows(idx.terms) == rows(build_index(docs).terms)
        assert read_index(spark, path, 1).norms.count() == 30
    assert IX.published_versions(spark, path) == [1, 2, 3]
    drop_old_versions(spark, path)
    assert IX.published_versions(spark, path) == [3] and rows(read_index(spark, path).terms) == rows(build_index(docs).terms)


def test_unreadable_pointer_raises(spark, tmp_path):
    path = str(tmp_path / "i")
    write_index(build_index(corpus(spark, 10)), path)
    for f in glob.glob(f"{path}/published/version=1/*.parquet"):
        with open(f, "wb") as out:
            out.write(b"not parquet")
        for crc in glob.glob(os.path.dirname(f) + "/.*.crc"):
            os.remove(crc)
    for call in (lambda: read_index(spark, path), lambda: write_index(build_index(corpus(spark, 5)), path)):
        with pytest.raises(Exception) as e:
            call()
        assert not isinstance(e.value, FileNotFoundError)


def test_written_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(rangetable, "LEAST_FILE_ROWS", 20)
    idx = write_index(build_index(corpus(spark)), str(tmp_path / "i"))
    for name, key in (("postings", ("term", "doc_id")), ("terms", ("term",)), ("norms", ("doc_id",)), ("docs", ("doc_id",))):
        placed = [(r.file_, r.place, *(r[c] for c in key)) for r in idx.tables[name].placed().collect()]
        assert len({x[0] for x in placed}) > 1
        assert [x[2:] for x in sorted(placed)] == sorted(x[2:] for x in placed)


def test_hydration_reads_only_files_of_its_ids(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(rangetable, "LEAST_FILE_ROWS", 1000)
    monkeypatch.setattr(rangetable, "ROW_GROUP_BYTES", 1 << 16)
    docs = many_terms(spark, 20_000)
    idx = write_index(build_index(docs, stem=False), str(tmp_path / "i"))
    ranked = spark.createDataFrame([(1, 17, 0.5), (2, 40_000, 0.4)], "rank long, doc_id long, similarity double")
    full = hydrate(ranked, idx.tables["docs"]).select("rank", "doc_id", "text")
    got = rows(full)
    assert got == rows(hydrate(ranked, docs).select("rank", "doc_id", "text")) and got[1][2] is None
    (opened, read), = scans(full, "text")
    assert opened == 1 and read < 5000
    monkeypatch.setattr(rangetable, "FEW", 1)
    assert rows(hydrate(ranked, idx.tables["docs"]).select("rank", "doc_id", "text")) == got


def test_merge_carries_stored_columns(spark):
    docs = corpus(spark, 20)
    idx = build_index(docs.where("doc_id < 'd010'"), store_cols=["doc_id", "text", "lang"])
    grown = merge_index(idx, docs.where("doc_id >= 'd010'").withColumn("lang", F.lit("fr")))
    assert {(r.doc_id < "d010", r.lang) for r in grown.docs.collect()} == {(True, "en"), (False, "fr")}
    with pytest.raises(ValueError, match="lang"):
        merge_index(idx, docs.drop("lang"))


def test_string_ids_with_an_empty_side(spark):
    docs = spark.createDataFrame([("x1", "aqui ring"), ("x2", "plate")], "doc_id string, text string")
    idx, lex = build_index(docs), fulltext_lexemes(docs, "doc_id", (("text", "B"),))
    got = compare(idx, lex, "aqui")
    assert got.schema["doc_id"].dataType.simpleString() == "string"
    assert rows(got.select("ranker", "doc_id")) == [("fulltext", "x1")]
    assert rows(compare(idx, lex, "the")) == [] and rows(search(idx, "")) == []


def test_builds_do_not_share_or_keep_anything(spark):
    docs = corpus(spark, 20)
    held = len(spark.sparkContext._jsc.getPersistentRDDs())
    a, b = build_index(docs), build_index(docs)
    want = rows(b.postings)
    rows(search_batch(a, queries(spark)))
    a.release()
    assert rows(b.postings) == want
    b.release()
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == held


def test_stored_lexemes_equal_fresh_ones(spark, tmp_path):
    p = spark.createDataFrame([("a1", "The Running rings 7x", "cs.AI and"), ("a1", "The Running rings 7x", "cs.AI and"), ("b", None, "")],
                              "id string, title string, categories string")
    built = build_fulltext(p, stem=True)
    assert build_fulltext(built) is built and built.columns == [*p.columns, "search_txt"] and built.count() == 3
    cols = ["doc_id", "field", "label", "weight", "pos", "term"]
    assert rows(stored_lexemes(built).select(cols)) == rows(fulltext_lexemes(p, "id").select(cols))
    path = str(tmp_path / "w")
    write_fulltext(fulltext_lexemes(p, "id"), path)
    again = write_fulltext(fulltext_lexemes(p.where("id = 'b'"), "id"), path)
    assert rows(again.lexemes.select("term", "doc_id")) == [("b", "b")] == rows(read_fulltext(spark, path).lexemes.select("term", "doc_id"))
    with pytest.raises(FileNotFoundError):
        read_fulltext(spark, path + "x")


def test_size_bytes(spark):
    df = spark.createDataFrame([("abc", 1), (None, 2)], "a string, b long")
    assert util.size_bytes(df) == 2 * 40 + 3 and util.size_bytes(df.where("false")) == 0
    assert util.fits(df, 83) and not util.fits(df, 82)


def test_no_local_scratch_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, *a):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())
