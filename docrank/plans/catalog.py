"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame
computed over whole given tables.

Corpora:
  documents   doc_id, text                  (cosine corpus)
  benchmark   item_id, text                 (query batch)
  part        as a paper table: id = p_partkey, authors = p_brand,
              title = p_name, categories = p_type (both rankers)
Scores are rounded to 6 decimals before ranking (ties then go to the
smaller doc_id), so summation order cannot change a result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docrank.functions import text as T
from docrank.functions.stem import stem_vocabulary
from docrank.operators import fulltext as FT
from docrank.operators import index as IX
from docrank.operators import search as SR
from docrank.operators import segments as SG
from docrank.operators.compare import compare, compare_batch, compare_results
from docrank.operators.merge import merge_counts, merge_index
from docrank.session import scratch_path
from docrank.sources import papers as P
from docrank.sources.rangetable import write_ranges

K = 5
DIGITS = 6
# The single free-text query run on the part table (fixed value of the check).
PART_QUERY = "small ring 7"
PART_STEM_QUERY = "small rings and large plates"
# Literal appended to page URLs for the link-removal check.
URL_SUFFIX = " https://t.co/AbCdEf1234 and https://tXco/QwErTy5678"
CORPUS_LIMIT = 100


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def documents(spark, sf) -> DataFrame:
    return table(spark, sf, "documents")


def benchmark(spark, sf) -> DataFrame:
    return table(spark, sf, "benchmark")


def part_papers(spark, sf) -> DataFrame:
    """The part table in the paper layout (ten paper columns + doc_id)."""
    p = table(spark, sf, "part")
    none = F.lit(None).cast("string")
    return p.select(
        F.col("p_partkey").cast("string").alias("id"), none.alias("submitter"), F.col("p_brand").alias("authors"),
        F.col("p_name").alias("title"), none.alias("comments"), none.alias("journal_ref"), none.alias("doi"),
        none.alias("abstract"), F.col("p_type").alias("categories"), none.alias("versions"),
        F.col("p_partkey").alias("doc_id"),
    )


def doc_index(spark, sf, stem=False) -> IX.Index:
    return IX.build_index(documents(spark, sf), "doc_id", ("text",), stem=stem)


def part_index(spark, sf, stem=True) -> IX.Index:
    return IX.build_index(part_papers(spark, sf), "doc_id", P.SEARCH_FIELDS, stem=stem)


def part_lexemes(spark, sf, stem=True) -> DataFrame:
    return FT.fulltext_lexemes(part_papers(spark, sf), "doc_id", FT.PAPER_FIELD_LABELS, stem=stem)


def first_benchmark_text(spark, sf) -> str:
    """Text of the benchmark item with the smallest id (one scalar)."""
    return benchmark(spark, sf).orderBy("item_id").select("text").first()["text"]


def r6(c: str):
    return F.round(F.col(c), DIGITS).alias(c)


# ------------------------------------------------------------------ text --

def q_remove_special_characters(spark, sf):
    return documents(spark, sf).select("doc_id", T.remove_special_characters("text").alias("cleaned"))


def q_remove_punctuation(spark, sf):
    return documents(spark, sf).select("doc_id", T.remove_punctuation("text").alias("cleaned"))


def q_remove_url(spark, sf):
    pages = table(spark, sf, "pages")
    return pages.select("page_id", T.remove_url(F.concat(F.col("url"), F.lit(URL_SUFFIX))).alias("cleaned"),
                        T.remove_url("html").alias("cleaned_html"))


def q_clean_tokens(spark, sf):
    d = documents(spark, sf)
    return d.select("doc_id", F.posexplode(T.clean_text(F.col("text"))).alias("pos", "token"))


def q_stopword_filter_doc(spark, sf):
    docs = IX.corpus(documents(spark, sf), "doc_id", ("text",))
    return IX.document_tokens(docs)


def q_stopword_filter_query(spark, sf):
    b = benchmark(spark, sf)
    toks = b.select(F.col("item_id").alias("query_id"),
                    F.posexplode(T.lowercase_tokens(T.clean_text(F.col("text")))).alias("pos", "token"))
    return toks.where(~T.is_stopword(F.col("token")))


def q_search_text(spark, sf):
    p = part_papers(spark, sf)
    return p.select("doc_id", T.search_text(*P.SEARCH_FIELDS).alias("text"))


def q_sanitize_query(spark, sf):
    return benchmark(spark, sf).select("item_id", T.sanitize_query("text").alias("query"))


def q_truncate_display(spark, sf):
    return documents(spark, sf).select("doc_id", T.truncate_display("text").alias("short_text"))


def q_scan_lexemes(spark, sf):
    """Typed tokens of every document."""
    return _scanned(documents(spark, sf).select(F.col("doc_id").alias("id"), "text"))


def q_scan_lexemes_pages(spark, sf):
    """Typed tokens of every page's address and raw text: hosts, e-mail addresses, compounds."""
    pages = table(spark, sf, "pages")
    return _scanned(pages.select(F.col("page_id").alias("id"), F.concat_ws(" ", "url", "html").alias("text")))


def _scanned(rows: DataFrame) -> DataFrame:
    return rows.select("id", F.posexplode(T.scan_tokens("text")).alias("pos", "x")).select("id", "pos", "x.kind", "x.token")


# --------------------------------------------------------------- sources --

def q_project_paper(spark, sf):
    ev = table(spark, sf, "events")
    v = F.parse_json(F.col("props"))
    return ev.select("event_id", P.project_value(v, "k").alias("k"), P.project_value(v, "missing").alias("missing"))


def q_json_round_trip(spark, sf):
    return P.to_json_rows(table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"))


def q_limit_corpus(spark, sf):
    return P.limit_corpus(documents(spark, sf).select("doc_id", "lang", "n_chars"), CORPUS_LIMIT, "doc_id")


def q_list_papers(spark, sf):
    return P.list_papers(part_papers(spark, sf))


def q_get_paper(spark, sf):
    return P.get_paper(part_papers(spark, sf), "7")


def paper_lines(spark, sf) -> DataFrame:
    """The part papers as JSON lines, some of them spoilt: cut off, blank, or no object."""
    json = P.to_json_rows(part_papers(spark, sf).select("id", "title", "categories", "doc_id"), ["id", "title", "categories"]).select("json")
    key = F.get_json_object("json", "$.id").cast("long")
    return json.select(F.when(key % 7 == 0, F.expr("left(json, length(json) - 5)")).when(key % 11 == 0, F.lit("[1, 2]")).when(
        key % 13 == 0, F.lit("  ")).otherwise(F.col("json")).alias("value"))


def q_paper_rejects(spark, sf):
    """Records and rejects of a corpus with bad lines, from one scan."""
    path, out = (scratch_path(spark, f"docrank-{x}-{uuid.uuid4().hex}") for x in ("lines", "scan"))
    paper_lines(spark, sf).write.text(path)
    scan = P.scan_papers(spark, path, out)
    none = F.lit(None).cast("string")
    return scan.records.select(F.lit("record").alias("kind"), "id", "title", "doi", none.alias("reason"), none.alias("line")).unionByName(
        scan.rejects.select(F.lit("reject").alias("kind"), none.alias("id"), none.alias("title"), none.alias("doi"), "reason", "line"))


RANGES = 7


def q_table_ranges(spark, sf):
    """Orders by the ranges of their keys that a parallel read would take, some keys made null."""
    orders = table(spark, sf, "orders").select(F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderkey")).alias("key"), "o_custkey")
    low, high = orders.agg(F.min("key"), F.max("key")).first()
    return orders.groupBy(P.range_of(P.plan_ranges("key", low, high, RANGES)).alias("part")).agg(
        F.count("*").alias("n"), F.min("key").alias("first"), F.max("key").alias("last"), F.sum("o_custkey").alias("customers"))


# ----------------------------------------------------------------- index --

def q_corpus_size(spark, sf):
    docs = IX.corpus(documents(spark, sf), "doc_id", ("text",))
    return spark.range(1).select(IX.corpus_size(docs).alias("n_docs"))


def q_term_frequency(spark, sf):
    return doc_index(spark, sf).tf()


def q_document_frequency(spark, sf):
    return doc_index(spark, sf).terms.select("term", "df")


def q_idf(spark, sf):
    return doc_index(spark, sf).terms.select("term", "df", r6("idf"))


def q_posting_weights(spark, sf):
    return doc_index(spark, sf).postings.select("term", "doc_id", "tf", r6("idf"), r6("weight"))


def q_document_norms(spark, sf):
    return doc_index(spark, sf).norms.select("doc_id", r6("norm"))


def q_posting_lists(spark, sf):
    """Every entry of every exported map."""
    blocks = IX.posting_lists(doc_index(spark, sf), block_size=50)
    return blocks.select("term", r6("idf"), F.explode("papers").alias("doc_id", "weight")).select(
        "term", "idf", "doc_id", r6("weight"))


def written_doc_index(spark, sf, path, stem=False) -> IX.Index:
    built = doc_index(spark, sf, stem)
    idx = IX.write_index(built, path)
    built.release()
    return idx


def q_index_write_read(spark, sf):
    """All five written tables as rows (kind, name, doc_id, a, b)."""
    idx = written_doc_index(spark, sf, scratch_path(spark, f"docrank-index-{uuid.uuid4().hex}"))
    no = lambda kind: F.lit(None).cast(kind)

    def rows(df, kind, name, doc, a, b):
        return df.select(F.lit(kind).alias("kind"), name.alias("name"), doc.cast("long").alias("doc_id"),
                         F.round(a.cast("double"), DIGITS).alias("a"), F.round(b.cast("double"), DIGITS).alias("b"))

    c = F.col
    return (rows(idx.postings, "posting", c("term"), c("doc_id"), c("tf"), c("weight"))
            .unionByName(rows(idx.postings, "normalised", c("term"), c("doc_id"), c("idf"), c("nweight")))
            .unionByName(rows(idx.terms, "term", c("term"), no("long"), c("df"), c("idf")))
            .unionByName(rows(idx.norms, "norm", no("string"), c("doc_id"), c("norm"), no("double")))
            .unionByName(rows(idx.docs, "document", c("text"), c("doc_id"), no("double"), no("double")))
            .unionByName(rows(spark.range(1), "size", no("string"), no("long"), idx.n_docs, no("double"))))


def q_index_order(spark, sf):
    """Place of every row of the four sorted tables over all their files."""
    idx = written_doc_index(spark, sf, scratch_path(spark, f"docrank-index-{uuid.uuid4().hex}"))
    no = lambda kind: F.lit(None).cast(kind)

    def rows(kind, name, doc):
        return idx.tables[kind].numbered().select(F.lit(kind).alias("kind"), "place", name.alias("name"), doc.cast("long").alias("doc_id"))

    return rows("postings", F.col("term"), F.col("doc_id")).unionByName(rows("terms", F.col("term"), no("long"))).unionByName(
        rows("norms", no("string"), F.col("doc_id"))).unionByName(rows("docs", no("string"), F.col("doc_id")))


def q_index_overwrite(spark, sf):
    """An index of some documents, read, merged with the rest and written to the path it was read from."""
    path = scratch_path(spark, f"docrank-index-{uuid.uuid4().hex}")
    a, b = _halves(spark, sf)
    first = IX.build_index(a, "doc_id", ("text",), stem=False)
    IX.write_index(first, path)
    first.release()
    grown = merge_index(IX.read_index(spark, path), b, "doc_id", ("text",))
    idx = IX.write_index(grown, path)
    grown.release()
    return idx.postings.select("term", "doc_id", "tf", r6("idf"), r6("weight"), r6("nweight"))


# ---------------------------------------------------------------- search --

def q_query_weights(spark, sf):
    idx = doc_index(spark, sf)
    qtf = SR.query_terms(benchmark(spark, sf), "item_id", "text")
    qw = SR.query_weights(idx, qtf)
    return qw.select("query_id", "term", "qtf", r6("qweight"), r6("qnorm"))


def q_dot_products(spark, sf):
    idx = doc_index(spark, sf)
    qtf = SR.query_terms(benchmark(spark, sf), "item_id", "text")
    return SR.dot_products(idx, SR.query_weights(idx, qtf)).select("query_id", "doc_id", r6("dot"))


def q_cosine_topk(spark, sf):
    return SR.search(doc_index(spark, sf), first_benchmark_text(spark, sf), K, digits=DIGITS)


def q_cosine_topk_batch(spark, sf):
    return SR.search_batch(doc_index(spark, sf), benchmark(spark, sf), K, "item_id", "text", digits=DIGITS)


def q_cosine_topk_batch_written(spark, sf):
    """The batch on a written index, read in the folders of its terms."""
    idx = written_doc_index(spark, sf, scratch_path(spark, f"docrank-index-{uuid.uuid4().hex}"))
    return SR.search_batch(idx, benchmark(spark, sf), K, "item_id", "text", digits=DIGITS)


def q_cosine_topk_batch_conversations(spark, sf):
    """Conversation turns as records keyed by conv_id: the turns of one
    conversation add their counts under one id, N counts every turn."""
    conv = table(spark, sf, "conversations")
    idx = IX.build_index(conv, "conv_id", ("text",), stem=False)
    return SR.search_batch(idx, benchmark(spark, sf), K, "item_id", "text", digits=DIGITS)


def q_cosine_topk_batch_pages(spark, sf):
    """Raw web pages (long HTML text) as the corpus."""
    idx = IX.build_index(table(spark, sf, "pages"), "page_id", ("html",), stem=False)
    return SR.search_batch(idx, benchmark(spark, sf), K, "item_id", "text", digits=DIGITS)


def q_cosine_topk_hydrated(spark, sf):
    idx = doc_index(spark, sf)
    res = SR.search_batch(idx, benchmark(spark, sf), K, "item_id", "text", digits=DIGITS)
    store = documents(spark, sf).select("doc_id", "lang", "source", "n_chars")
    return SR.hydrate(res, store)


def q_cosine_topk_hydrated_store(spark, sf):
    """Batch results with columns from a stored document table, looked up by id."""
    idx = doc_index(spark, sf)
    res = SR.search_batch(idx, benchmark(spark, sf), K, "item_id", "text", digits=DIGITS)
    store = write_ranges(documents(spark, sf).select("doc_id", "lang", "source", "n_chars", "text"),
                         scratch_path(spark, f"docrank-store-{uuid.uuid4().hex}"), "doc_id")
    return SR.hydrate(res, store).drop("text")


def q_cosine_topk_written(spark, sf):
    """One query on a written index, by term lookup."""
    idx = written_doc_index(spark, sf, scratch_path(spark, f"docrank-index-{uuid.uuid4().hex}"))
    return SR.search(idx, first_benchmark_text(spark, sf), K, digits=DIGITS)


def q_cosine_topk_pruned(spark, sf):
    """The batch on a written index with document blocks skipped by their bounds."""
    built = doc_index(spark, sf)
    idx = IX.write_index(built, scratch_path(spark, f"docrank-index-{uuid.uuid4().hex}"), block_docs=BLOCK_DOCS)
    built.release()
    return SR.search_pruned(idx, benchmark(spark, sf), K, "item_id", "text", digits=DIGITS)[0]


BLOCK_DOCS = 8


def grown_segments(spark, sf) -> SG.Segments:
    """Segments of the documents, added by language in three parts and merged at the third."""
    d = documents(spark, sf)
    s = SG.create_segments(spark, scratch_path(spark, f"docrank-segments-{uuid.uuid4().hex}"), IX.IndexOptions(stem=False))
    for part in ("lang = 'en'", "lang IN ('de', 'fr')", "lang IS NULL OR lang NOT IN ('en', 'de', 'fr')"):
        s = SG.add_records(s, d.where(part), fanout=3)
    return s


def q_segments_topk(spark, sf):
    """The batch on an index grown by three segments, merged once."""
    return SR.search_batch(grown_segments(spark, sf).index(), benchmark(spark, sf), K, "item_id", "text", digits=DIGITS)


def q_segments_norms(spark, sf):
    """Norms from the sums that three segments keep of each document."""
    return grown_segments(spark, sf).norms().select("doc_id", r6("norm"))


def q_segments_terms(spark, sf):
    """The dictionary of an index grown by three segments."""
    return grown_segments(spark, sf).terms().select("term", "df", r6("idf"))


def q_stem_vocabulary(spark, sf):
    p = table(spark, sf, "part")
    words = p.select(F.explode(F.split(F.lower(F.concat_ws(" ", "p_name", "p_type")), " ")).alias("term"))
    return stem_vocabulary(words.where(F.col("term") != ""), "term")


def q_stem_documents(spark, sf):
    """Stem of every distinct word that the documents' index would hold."""
    docs = IX.corpus(documents(spark, sf), "doc_id", ("text",))
    words = IX.document_tokens(docs).select(F.lower("token").alias("term"))
    return stem_vocabulary(words, "term")


def q_cosine_topk_stemmed(spark, sf):
    return SR.search(part_index(spark, sf, stem=True), PART_STEM_QUERY, K, digits=DIGITS)


def q_cosine_topk_batch_stemmed(spark, sf):
    return SR.search_batch(doc_index(spark, sf, stem=True), benchmark(spark, sf), K, "item_id", "text",
                           digits=DIGITS)


# -------------------------------------------------------------- fulltext --

def q_fulltext_lexemes(spark, sf):
    return part_lexemes(spark, sf)


def part_name_queries(spark, sf) -> DataFrame:
    """Every distinct part name used as a query (query_id = the name)."""
    p = table(spark, sf, "part")
    return p.select(F.col("p_name").alias("query_id"), F.col("p_name").alias("text")).distinct()


def q_fulltext_topk(spark, sf):
    return FT.fulltext_search(part_lexemes(spark, sf), PART_QUERY, K, digits=DIGITS)


def q_fulltext_topk_batch(spark, sf):
    return FT.fulltext_search_batch(part_lexemes(spark, sf), part_name_queries(spark, sf), K, digits=DIGITS)


def q_compare_rankers(spark, sf):
    return compare(part_index(spark, sf, stem=True), part_lexemes(spark, sf), PART_QUERY, K, digits=DIGITS)


def q_compare_rankers_batch(spark, sf):
    return compare_batch(part_index(spark, sf, stem=True), part_lexemes(spark, sf), part_name_queries(spark, sf), K,
                         digits=DIGITS)


def string_papers(spark, sf) -> DataFrame:
    """The part papers under string ids."""
    return part_papers(spark, sf).withColumn("doc_id", F.concat(F.lit("p"), F.col("id")))


def _compared_strings(spark, sf) -> DataFrame:
    p = string_papers(spark, sf)
    idx = IX.build_index(p, "doc_id", P.SEARCH_FIELDS, stem=True)
    return compare(idx, FT.fulltext_lexemes(p, "doc_id", FT.PAPER_FIELD_LABELS), PART_QUERY, K, digits=DIGITS)


def q_compare_rankers_string_ids(spark, sf):
    return _compared_strings(spark, sf)


def q_compare_results(spark, sf):
    """Both rankers' result objects on string ids."""
    store = string_papers(spark, sf).withColumnRenamed("journal_ref", "journal-ref")
    return compare_results(_compared_strings(spark, sf), store, RESULT_FIELDS, FULLTEXT_ABSENT, as_json=True)


def q_fulltext_write_read(spark, sf):
    """The name batch on a written weighted index."""
    path = scratch_path(spark, f"docrank-weighted-{uuid.uuid4().hex}")
    return FT.fulltext_search_batch(FT.write_fulltext(part_lexemes(spark, sf), path), part_name_queries(spark, sf), K, digits=DIGITS)


def q_fulltext_topk_pruned(spark, sf):
    """The name batch on a written weighted index with document blocks skipped by their bounds."""
    path = scratch_path(spark, f"docrank-weighted-{uuid.uuid4().hex}")
    idx = FT.write_fulltext(part_lexemes(spark, sf), path, block_docs=BLOCK_DOCS)
    return FT.fulltext_search_pruned(idx, part_name_queries(spark, sf), K, digits=DIGITS)[0]


def q_build_fulltext_search(spark, sf):
    """The name batch on the stored lexeme column."""
    built = FT.build_fulltext(part_papers(spark, sf), "doc_id")
    return FT.fulltext_search_batch(FT.stored_lexemes(built, "doc_id"), part_name_queries(spark, sf), K, digits=DIGITS)


def q_paper_corpus(spark, sf):
    """A JSON-lines corpus end to end: lines written from the part table, scanned, indexed (stemmed), searched, as result objects."""
    path = scratch_path(spark, f"docrank-papers-{uuid.uuid4().hex}")
    lines = part_papers(spark, sf).select("id", "authors", "title", "categories", "abstract")
    P.to_json_rows(lines).write.text(path)
    papers = P.read_papers(spark, path)
    idx = IX.build_index(papers, "id", P.SEARCH_FIELDS)
    found = SR.search(idx, PART_STEM_QUERY, K, digits=DIGITS)
    store = papers.withColumn("doc_id", F.col("id")).withColumnRenamed("journal_ref", "journal-ref")
    return SR.result_rows(SR.hydrate(found, store), RESULT_FIELDS, as_json=True)


# Result object fields in order; the weighted ranker reads five of them.
RESULT_FIELDS = ("id", "submitter", "authors", "title", "comments", "journal-ref", "doi", "abstract", "categories",
                 "versions")
FULLTEXT_ABSENT = {"submitter": "-", "comments": "-", "journal-ref": "-", "doi": "-", "versions": "-"}


def q_result_rows(spark, sf):
    res = FT.fulltext_search(part_lexemes(spark, sf), PART_QUERY, K, digits=DIGITS)
    store = part_papers(spark, sf).select("doc_id", "id", "authors", "abstract", "categories", "title")
    return SR.result_rows(SR.hydrate(res, store), RESULT_FIELDS, FULLTEXT_ABSENT, as_json=True)


# ----------------------------------------------------------------- merge --

def _halves(spark, sf):
    d = documents(spark, sf)
    return d.where(F.col("lang") == "en"), d.where(~(F.col("lang") == "en") | F.col("lang").isNull())


def q_merge_counts(spark, sf):
    a, b = _halves(spark, sf)
    plain = IX.IndexOptions(stem=False)
    ta = IX.term_frequency(IX.corpus(a, "doc_id", ("text",)), plain)
    tb = IX.term_frequency(IX.corpus(b, "doc_id", ("text",)), plain)
    return merge_counts(ta, tb)


def q_merge_index(spark, sf):
    a, b = _halves(spark, sf)
    idx = merge_index(IX.build_index(a, "doc_id", ("text",), stem=False), b, "doc_id", ("text",))
    return idx.postings.select("term", "doc_id", "tf", r6("idf"), r6("weight"))


QUERIES = {
    "remove_special_characters": q_remove_special_characters,
    "remove_punctuation": q_remove_punctuation,
    "remove_url": q_remove_url,
    "clean_tokens": q_clean_tokens,
    "stopword_filter_doc": q_stopword_filter_doc,
    "stopword_filter_query": q_stopword_filter_query,
    "search_text": q_search_text,
    "sanitize_query": q_sanitize_query,
    "truncate_display": q_truncate_display,
    "scan_lexemes": q_scan_lexemes,
    "scan_lexemes_pages": q_scan_lexemes_pages,
    "project_paper": q_project_paper,
    "json_round_trip": q_json_round_trip,
    "limit_corpus": q_limit_corpus,
    "list_papers": q_list_papers,
    "get_paper": q_get_paper,
    "paper_rejects": q_paper_rejects,
    "table_ranges": q_table_ranges,
    "corpus_size": q_corpus_size,
    "term_frequency": q_term_frequency,
    "document_frequency": q_document_frequency,
    "idf": q_idf,
    "posting_weights": q_posting_weights,
    "document_norms": q_document_norms,
    "posting_lists": q_posting_lists,
    "index_write_read": q_index_write_read,
    "index_overwrite": q_index_overwrite,
    "index_order": q_index_order,
    "query_weights": q_query_weights,
    "dot_products": q_dot_products,
    "cosine_topk": q_cosine_topk,
    "cosine_topk_batch": q_cosine_topk_batch,
    "cosine_topk_batch_written": q_cosine_topk_batch_written,
    "cosine_topk_hydrated": q_cosine_topk_hydrated,
    "cosine_topk_hydrated_store": q_cosine_topk_hydrated_store,
    "cosine_topk_written": q_cosine_topk_written,
    "cosine_topk_pruned": q_cosine_topk_pruned,
    "segments_topk": q_segments_topk,
    "segments_norms": q_segments_norms,
    "segments_terms": q_segments_terms,
    "cosine_topk_batch_conversations": q_cosine_topk_batch_conversations,
    "cosine_topk_batch_pages": q_cosine_topk_batch_pages,
    "stem_vocabulary": q_stem_vocabulary,
    "stem_documents": q_stem_documents,
    "cosine_topk_stemmed": q_cosine_topk_stemmed,
    "cosine_topk_batch_stemmed": q_cosine_topk_batch_stemmed,
    "fulltext_lexemes": q_fulltext_lexemes,
    "fulltext_topk": q_fulltext_topk,
    "fulltext_topk_batch": q_fulltext_topk_batch,
    "compare_rankers": q_compare_rankers,
    "compare_rankers_batch": q_compare_rankers_batch,
    "compare_rankers_string_ids": q_compare_rankers_string_ids,
    "compare_results": q_compare_results,
    "fulltext_write_read": q_fulltext_write_read,
    "fulltext_topk_pruned": q_fulltext_topk_pruned,
    "build_fulltext_search": q_build_fulltext_search,
    "paper_corpus": q_paper_corpus,
    "result_rows": q_result_rows,
    "merge_counts": q_merge_counts,
    "merge_index": q_merge_index,
}
