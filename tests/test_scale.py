"""Work that must not grow faster than the tables: what is shuffled, and into how many tasks."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from docrank import build_index, fulltext_lexemes, fulltext_search_batch, merge_index, search_batch, write_index
from docrank.operators import index as IX
from docrank.operators import util
from docrank.operators.fulltext import fulltext_query_terms, fulltext_scores
from docrank.operators.search import dot_products, query_terms, query_weights, search_pruned
from docrank.operators.segments import add_records, create_segments
from docrank.sources import rangetable


def texts(n=200, seed=3):
    rng = random.Random(seed)
    words = [f"word{i}" for i in range(80)]
    return [" ".join(["common"] + rng.choices(words, k=rng.randint(1, 40)) + [f"rare{i}"]) for i in range(n)]


def table(spark, ids=None, schema="doc_id long, text string"):
    t = texts()
    return spark.createDataFrame(list(zip(ids or range(len(t)), t)), schema).repartition(4)


def shuffled(df):
    """What the exchanges of a plan are dealt by."""
    plan = df._jdf.queryExecution().sparkPlan().toString() + df._jdf.queryExecution().executedPlan().toString()
    return [line.split("Exchange ")[1] for line in plan.splitlines() if "Exchange " in line and "Broadcast" not in line]


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def test_words_of_a_record_are_counted_without_a_shuffle(spark):
    docs = table(spark)
    tf = IX.term_frequency(docs, IX.IndexOptions(stem=False))
    assert not [x for x in shuffled(tf) if "term" in x]
    want = Counter((i, w) for i, t in enumerate(texts()) for w in t.split())
    assert {(r.doc_id, r.term): r.tf for r in tf.collect()} == want and tf.count() == len(want)


@pytest.mark.parametrize("few", [20_000, 1])
def test_counts_of_ids_that_come_again_add(spark, monkeypatch, few):
    monkeypatch.setattr(rangetable, "FEW", few)
    ids = [None if i % 50 == 0 else 7 if i % 9 == 0 else 8 if i % 31 == 0 else i for i in range(200)]
    docs = table(spark, ids)
    want = Counter()
    for i, t in zip(ids, texts()):
        want.update((i, w) for w in t.split())
    tf = IX.term_frequency(docs, IX.IndexOptions(stem=False))
    assert {(r.doc_id, r.term): r.tf for r in tf.collect()} == want and tf.count() == len(want)


def test_long_lists_are_counted_in_parts(spark, monkeypatch):
    docs = table(spark)
    whole = rows(IX.term_frequency(docs))
    monkeypatch.setattr(IX, "COUNTED_WORDS", 30)
    monkeypatch.setattr(IX, "KNOWN_STEMS", 5)
    assert rows(IX.term_frequency(docs)) == whole


def test_rows_of_frequent_keys_stay_where_they_are(spark, monkeypatch):
    tf = IX.record_counts(table(spark), IX.IndexOptions(stem=False))
    terms = IX.document_frequency(tf, F.lit(200)).cache()
    whole = rows(tf.join(terms.select("term", "df", "idf"), "term").select("doc_id", "term", "tf", "df", "idf"))
    monkeypatch.setattr(util, "MAX_BROADCAST_BYTES", util.size_bytes(terms.where("df > 1").select("term", "df", "idf")))
    assert not util.fits(terms.select("term", "df", "idf"))
    joined = util.dictionary_join(tf, terms.select("term", "df", "idf"), "term", "df", "doc_id")
    assert rows(joined.select("doc_id", "term", "tf", "df", "idf")) == whole
    where = joined.withColumn("p", F.spark_partition_id())
    # Every map partition keeps its rows of the most frequent term.
    assert where.where("term = 'common'").select("p").distinct().count() == tf.rdd.getNumPartitions()
    terms.unpersist()


def test_scores_of_a_document_are_summed_in_its_task(spark, monkeypatch, tmp_path):
    docs = table(spark)
    asked = spark.createDataFrame([(i, f"common word{i} word{i + 9}") for i in range(70)], "query_id long, text string")
    built = build_index(docs, stem=False)
    found = dot_products(built, query_weights(built, query_terms(asked)))
    assert not [x for x in shuffled(found) if "query_id" in x and "doc_id" in x]
    near = rows(search_batch(built, asked, 5, digits=9))
    monkeypatch.setattr(util, "SLICE_ROWS", 500)
    assert rows(search_batch(built, asked, 5, digits=9)) == near
    matches = 70 * 200
    scores = dot_products(built, query_weights(built, query_terms(asked)))
    most = max(r["count"] for r in scores.groupBy(F.spark_partition_id()).count().collect())
    assert most < matches / 10
    idx = write_index(built, str(tmp_path / "i"), block_docs=8)
    assert rows(search_batch(idx, asked, 5, digits=9)) == near
    assert rows(search_pruned(idx, asked, 5, digits=9)[0]) == near  # more queries than a word has bits
    monkeypatch.setattr(util, "MAX_BROADCAST_BYTES", -1)
    assert rows(search_pruned(idx, asked, 5, digits=9)[0]) == near


def test_weighted_scores_are_summed_in_their_tasks(spark, monkeypatch):
    docs = table(spark)
    asked = spark.createDataFrame([(i, f"common word{i} word{i + 9}") for i in range(70)], "query_id long, text string")
    lex = fulltext_lexemes(docs, "doc_id", (("text", "B"),))
    near = rows(fulltext_search_batch(lex, asked, 5, digits=9))
    scores = fulltext_scores(lex, fulltext_query_terms(asked))
    assert not [x for x in shuffled(scores) if "query_id" in x and "doc_id" in x]
    monkeypatch.setattr(util, "SLICE_ROWS", 500)
    assert rows(fulltext_search_batch(lex, asked, 5, digits=9)) == near
    scores = fulltext_scores(lex, fulltext_query_terms(asked))
    assert max(r["count"] for r in scores.groupBy(F.spark_partition_id()).count().collect()) < 70 * 200 / 10


def test_long_texts_are_written_in_files_of_bounded_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(rangetable, "FILE_BYTES", 100_000)
    docs = spark.range(100).select("id", F.repeat(F.lit("x"), 10_000).alias("text"))
    assert rangetable.write_ranges(docs, str(tmp_path / "t"), "id").directory().count() >= 8


def test_merging_other_ids_sums_nothing_again(spark):
    docs = table(spark)
    a, b = docs.where("doc_id < 120"), docs.where("doc_id >= 120")
    whole = build_index(docs, stem=False)
    grown = merge_index(build_index(a, stem=False), b)
    assert rows(grown.postings) == rows(whole.postings)
    again = merge_index(build_index(docs.where("doc_id < 150"), stem=False), b)
    both = build_index(docs.where("doc_id < 150").unionByName(b), stem=False)
    assert rows(again.postings) == rows(both.postings) and rows(again.norms.select("doc_id", F.round("norm", 9))) == rows(both.norms.select("doc_id", F.round("norm", 9)))


def test_segments_where_the_dictionary_does_not_fit(spark, tmp_path, monkeypatch):
    docs = table(spark)
    want = rows(build_index(docs, stem=False).norms.select("doc_id", F.round("norm", 9)))
    monkeypatch.setattr(util, "MAX_BROADCAST_BYTES", 5000)
    s = create_segments(spark, str(tmp_path / "s"), IX.IndexOptions(stem=False))
    for part in (docs.where("doc_id < 120"), docs.where("doc_id >= 120")):
        s = add_records(s, part)
    assert rows(s.norms().select("doc_id", F.round("norm", 9))) == want


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}


def test_a_write_frees_its_shuffles(spark, tmp_path):
    before = shuffle_files(spark)
    util.written(table(spark).repartition(3, "doc_id"), "docrank-test")
    assert not shuffle_files(spark) - before


@pytest.mark.parametrize("kind", ["string", "long"])
def test_ranges_are_written_in_passes(spark, tmp_path, monkeypatch, kind):
    """The files' order is that of the keys, nulls first, also where one key has many rows; no pass takes all of them."""
    monkeypatch.setattr(rangetable, "FILE_ROWS", 100)
    sizes, write = [], rangetable.write_parquet
    monkeypatch.setattr(rangetable, "write_parquet", lambda df, *a, **b: (sizes.append(df.count()), write(df, *a, **b)))
    key = F.when(F.col("n") % 50 != 0, F.when(F.col("n") % 3 == 0, 500).otherwise(F.col("n") * 7919 % 900)).cast(kind)
    df = spark.range(1200).withColumnRenamed("id", "n").select(key.alias("k"), "n")
    t = rangetable.write_ranges(df, str(tmp_path / "t"), "k", ("n",))
    placed = [(r.k, r.n) for r in t.numbered().orderBy("place").collect()]
    assert placed == sorted(map(tuple, df.collect()), key=lambda r: (r[0] is not None, r[0] or 0 if kind == "long" else r[0] or "", r[1]))
    assert len(sizes) > 1 and sum(sizes) == 1200 and max(sizes) < 800
    one = "500" if kind == "string" else 500
    assert t.lookup([one]).count() == sum(k == one for k, _ in placed)
    alone = rangetable.write_ranges(df.where("k IS NULL OR k = 500"), str(tmp_path / "a"), "k", ("n",))
    assert [(r.k, r.n) for r in alone.numbered().orderBy("place").collect()] == [x for x in placed if x[0] in (None, one)]


def test_merging_a_written_index_writes_new_counts_only(spark, tmp_path):
    docs = table(spark)
    new = docs.where("doc_id >= 150")
    built = build_index(docs.where("doc_id < 150"), stem=False)
    grown = merge_index(write_index(built, str(tmp_path / "i")), new)
    built.release()
    want = build_index(docs, stem=False)
    kept = sum(spark.read.parquet(p).count() for p in grown.scratch if "docrank-tf" in p)
    assert kept == IX.term_frequency(new, IX.IndexOptions(stem=False)).count() < want.tf().count()
    idx = write_index(grown, str(tmp_path / "i"))
    grown.release()
    columns = ["term", "doc_id", "tf", F.round("idf", 9), F.round("weight", 9)]
    assert rows(idx.postings.select(*columns)) == rows(want.postings.select(*columns))


def test_only_first_blocks_are_put_in_order(spark, tmp_path, monkeypatch):
    from docrank.operators import blockmax

    made, write = {}, blockmax.written
    monkeypatch.setattr(blockmax, "written", lambda df, name: (made.setdefault(name, []).append(df.count()), write(df, name))[1])
    docs = table(spark)
    idx = write_index(build_index(docs, stem=False), str(tmp_path / "i"), block_docs=1)
    asked = spark.createDataFrame([(0, "common word3"), (1, "word5 word7 common")], "query_id long, text string")
    assert rows(search_pruned(idx, asked, 5, digits=6)[0]) == rows(search_batch(idx, asked, 5, digits=6))
    assert made["docrank-heads"] == [2 * 18] and made["docrank-bounds"][0] > 100
