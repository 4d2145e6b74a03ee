"""Cosine-ranked retrieval over an ``Index``: one query or a table of queries.

Batch plan (``search_batch``):
  queries -> clean/tokenise -> lower -> stop test -> (stem) -> count by
  (query_id, term)                                   = query_tf
  query_tf JOIN terms on term (unknown terms drop out) -> qweight, and |q| by
  a window over query_id (small data)                 = query weights
  postings of the query terms, dealt by doc_id, JOIN query weights on term ->
  sum by (query_id, doc_id) of qweight/|q| * weight/|d| in place  = cosine
  row_number over (query_id order by score desc, doc_id) <= k; Spark plans a
  WindowGroupLimit below the exchange, so only k rows per query and map task
  are shuffled for the final ranking.

A query side of few rows is tokenised once and held as literal rows; a larger one
is written once and broadcast only after its bytes were summed, and beyond the
bound the joins are sort-merge joins, with frequent terms split. A written
index carries ``nweight`` = weight/|d| in its postings, so no norms join is
needed at query time, and the terms of few query rows are looked up: only the
files and row groups that can hold them are read, of the dictionary and of the
postings. An unwritten index divides by |d| after the aggregation. One query is a
batch of one.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docrank.functions import scoring
from docrank.functions import text as T
from docrank.functions.stem import stem_terms
from docrank.operators.blockmax import pruned_top_k
from docrank.operators.index import Index
from docrank.operators.util import fits, maybe_broadcast, require_positive_k, slices, split_join, written
from docrank.sources.rangetable import RangeTable, few

# Default rounding of scores before ranking: scores equal to 12 decimals are
# ties, ordered by doc_id, whatever the summation order of the partitions.
DEFAULT_DIGITS = 12


def query_terms(queries: DataFrame, id_col: str = "query_id", text_col: str = "text",
                stem: bool = False) -> DataFrame:
    """(query_id, term, qtf): tokens lower-cased first, then the stop test."""
    # the stop test stays inside the (small) token array: as a row filter on
    # `term` Catalyst would copy it onto the postings scan through the join
    kept = T.remove_stopwords(T.lowercase_tokens(T.clean_text(F.col(text_col))))
    words = queries.select(F.col(id_col).alias("query_id"), F.explode(kept).alias("term"))
    qtf = words.groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("qtf"))
    if stem:
        qtf = stem_terms(qtf, ["query_id"], "term", "qtf")
    return qtf


def query_weights(index: Index, qtf: DataFrame, small: bool | None = None, keys: list[str] | None = None) -> DataFrame:
    """(query_id, term, qtf, idf, qweight, qnorm, qnweight) for query terms
    present in the index; |q| covers only those terms. ``small``: the caller
    proved the query side small; None proves it here. ``keys``: its terms, looked
    up in the dictionary of a written index."""
    if small is None:
        small = fits(qtf)
    terms = index.tables["terms"].lookup(keys) if keys is not None and index.tables else index.terms
    j = maybe_broadcast(qtf, small).join(terms.select("term", "idf"), "term")
    j = j.withColumn("qweight", scoring.tfidf("qtf", "idf"))
    by_query = Window.partitionBy("query_id")
    j = j.withColumn("qnorm", F.sqrt(F.sum(F.col("qweight") * F.col("qweight")).over(by_query)))
    return j.withColumn("qnweight", scoring.safe_ratio("qweight", "qnorm"))


def dot_products(index: Index, qweights: DataFrame, small: bool | None = None, keys: list[str] | None = None) -> DataFrame:
    """(query_id, doc_id, dot, similarity): every document sharing at least one
    indexed term with the query is a candidate (idf 0 terms included).

    On a written index the postings carry nweight = weight/|d| and the cosine
    is one sum. On an unwritten one the sum of qweight/|q| * weight is divided
    by |d| after aggregation (norms broadcast when proven small). Of few query
    rows only the postings of their terms are dealt to tasks by document, as many
    as the sum of df asks for, and meet the queries there: the scores of a
    document are summed in its task and never shuffled. A query side
    too large to broadcast is joined by merging, with each frequent term's
    postings and query rows split by a hash of the document. ``keys``: the query
    side's terms, looked up in the postings of a written index."""
    q = qweights.select("query_id", "term", "idf", "qweight", "qnweight")
    found = few(q) if small is not False else None
    if small is None and found is None:
        small = fits(q)
    lookup = keys is not None and bool(index.tables)
    if found is not None:
        q = index.spark.createDataFrame(found)
        p = index.tables["postings"].lookup(keys) if lookup else index.postings
        if not lookup:
            asked = F.broadcast(q.select("term").distinct())
            p = (p if index.counts is None else index.counts).join(asked, "term", "left_semi")
        normalized = "nweight" in p.columns
        if "weight" in p.columns:
            p = p.select("term", "doc_id", "weight", *(["nweight"] if normalized else []))
        # The sum of df over the query rows, as df = N / exp(idf).
        n = index.spark.range(1).select(index.n_docs.cast("long")).first()[0]
        matches = n * float(np.exp(-np.asarray(found["idf"], float)).sum())
        m = F.broadcast(q).join(p.repartition(slices(index.spark, matches), "doc_id"), "term")
        if "weight" not in p.columns:  # counts of a build; the query side has the idf
            m = m.withColumn("weight", scoring.tfidf("tf", "idf"))
    else:
        p = index.tables["postings"].lookup(keys) if lookup else index.postings
        normalized = "nweight" in p.columns
        p = p.select("term", "doc_id", "weight", *(["nweight"] if normalized else []))
        m = F.broadcast(q).join(p, "term") if small else split_join(p, q, index.terms.select("term", "df"), "term", "df", "doc_id")
    dot = F.sum(F.col("qweight") * F.col("weight")).alias("dot")
    if normalized:
        return m.groupBy("query_id", "doc_id").agg(
            dot, F.sum(F.col("qnweight") * F.col("nweight")).alias("similarity"))
    scores = m.groupBy("query_id", "doc_id").agg(dot, F.sum(F.col("qnweight") * F.col("weight")).alias("qdot"))
    small_norms = index.small_norms if index.small_norms is not None else fits(index.norms)
    norms = maybe_broadcast(index.norms, small_norms)
    return scores.join(norms, "doc_id").select(
        "query_id", "doc_id", "dot", scoring.safe_ratio("qdot", "norm").alias("similarity"))


def top_k(scores: DataFrame, k: int, score_col: str = "similarity", group_col: str = "query_id",
          id_col: str = "doc_id", digits: int | None = DEFAULT_DIGITS) -> DataFrame:
    """Best ``k`` rows per group: score descending, then id ascending.

    ``rank`` is a long. With ``digits`` the score is rounded first, so equal
    scores tie exactly and the smaller id wins."""
    require_positive_k(k)
    score = F.round(F.col(score_col), digits) if digits is not None else F.col(score_col)
    s = scores.withColumn(score_col, score)
    w = Window.partitionBy(group_col).orderBy(F.col(score_col).desc(), F.col(id_col).asc())
    return s.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k)


def cosine_scores(index: Index, queries: DataFrame, id_col: str = "query_id", text_col: str = "text",
                  small: bool | None = None) -> DataFrame:
    qtf = query_terms(queries, id_col, text_col, stem=index.options.stem)
    if index.tables and (found := few(qtf)) is not None:
        keys = sorted(set(found["term"].to_pylist()))
        weights = few(query_weights(index, index.spark.createDataFrame(found), True, keys))
        keys = sorted(set(weights["term"].to_pylist()))
        return dot_products(index, index.spark.createDataFrame(weights), True, keys)
    if small is None:
        qtf, _ = written(qtf, "docrank-query")
        small = fits(qtf)
    return dot_products(index, query_weights(index, qtf, small), small)


def search_batch(index: Index, queries: DataFrame, k: int = 5, id_col: str = "query_id",
                 text_col: str = "text", digits: int | None = DEFAULT_DIGITS) -> DataFrame:
    """Top-k documents for every query: (query_id, rank, doc_id, similarity)."""
    require_positive_k(k)
    scores = cosine_scores(index, queries, id_col, text_col)
    return top_k(scores, k, digits=digits).select("query_id", "rank", "doc_id", "similarity")


def search_pruned(index: Index, queries: DataFrame, k: int = 5, id_col: str = "query_id", text_col: str = "text",
                  digits: int = DEFAULT_DIGITS) -> tuple[DataFrame, DataFrame]:
    """The rows of ``search_batch`` with blocks of documents skipped by their bounds, and what was read.

    For few query rows on an index written with blocks; other calls raise ``ValueError``."""
    require_positive_k(k)
    found = few(query_terms(queries, id_col, text_col, stem=index.options.stem)) if index.blocks else None
    if found is None:
        raise ValueError("pruned search takes few query terms and an index written with blocks")
    weights = few(query_weights(index, index.spark.createDataFrame(found), True, sorted(set(found["term"].to_pylist()))))
    keys = sorted(set(weights["term"].to_pylist()))
    asked = index.spark.createDataFrame(weights).select("query_id", "term", F.col("qnweight").alias("w"))
    return pruned_top_k(index.tables["postings"].lookup(keys), index.tables["blocks"].lookup(keys), index.blocks, asked, "nweight", k, digits)


def one_query(spark, query: str) -> DataFrame:
    """A query table of one row."""
    return spark.createDataFrame([(0, query)], "query_id long, text string")


def search(index: Index, query: str, k: int = 5, digits: int | None = DEFAULT_DIGITS) -> DataFrame:
    """Top-k documents for one free-text query: (rank, doc_id, similarity).

    A batch of one query, so ids have the index's type whatever it finds, and a
    written index is read only in the folders of the query's terms."""
    return search_batch(index, one_query(index.spark, query), k, digits=digits).select("rank", "doc_id", "similarity")


def hydrate(results: DataFrame, docs: DataFrame | RangeTable, id_col: str = "doc_id") -> DataFrame:
    """Attach stored document columns to ranked rows, after ranking (late
    materialisation: documents are read for the top k only).

    The ranked rows (k a query) are written to the scratch folder once. From a
    stored table sorted by id, the documents of few rows are looked up: only files
    and row groups that can hold them are read. Else the ids, never document text,
    are broadcast to a semi join if they fit, so the store is filtered map-side;
    the few documents found then meet the ranked rows in a shuffle join. An id
    stored several times yields one row: the matching copies collapse to the
    smallest record by a partial ``min(struct)`` aggregation, so a result row is
    never multiplied."""
    results, _ = written(results, "docrank-results")
    ids = results.select(id_col).distinct()
    matched = None
    if isinstance(docs, RangeTable):
        if docs.key == id_col and (found := few(ids)) is not None:
            matched = docs.lookup(found[id_col].to_pylist())
        docs = docs.rows()
    if matched is None:
        matched = docs.join(maybe_broadcast(ids, fits(ids)), id_col, "left_semi")
    cols = [c for c in docs.columns if c != id_col]
    if cols:
        one = matched.groupBy(id_col).agg(F.min(F.struct(*cols)).alias("_doc")).select(id_col, "_doc.*")
    else:
        one = matched.distinct()
    return results.hint("shuffle_merge").join(one, id_col, "left")


def result_rows(results: DataFrame, fields, absent: dict[str, str] | None = None, score_col: str = "similarity",
                as_json: bool = False) -> DataFrame:
    """(…keys, val, info): a ranked row as the result object, ``info`` holding
    ``fields`` in order; a field named in ``absent`` gets its placeholder
    (the weighted ranker fills fields it does not read with "-").
    ``as_json`` renders ``info`` as one JSON object with nulls kept."""
    absent = absent or {}
    info = F.struct(*[(F.lit(absent[c]) if c in absent else F.col(c)).alias(c) for c in fields])
    if as_json:
        info = F.to_json(info, {"ignoreNullFields": "false"})
    keys = [c for c in ("ranker", "query_id", "rank") if c in results.columns]
    return results.select(*keys, F.col(score_col).alias("val"), info.alias("info"))
