"""Both rankers on the same queries, as one labelled table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docrank.operators.fulltext import fulltext_search, fulltext_search_batch
from docrank.operators.index import Index
from docrank.operators.search import hydrate, result_rows, search, search_batch

RANKERS = ("cosine", "fulltext")


def compare(index: Index, lexemes: DataFrame, query: str, k: int = 5, digits: int | None = 12) -> DataFrame:
    """(ranker, rank, doc_id, similarity) for one query."""
    a = search(index, query, k, digits=digits).withColumn("ranker", F.lit(RANKERS[0]))
    b = fulltext_search(lexemes, query, k, digits=digits).withColumn("ranker", F.lit(RANKERS[1]))
    return a.unionByName(b).select("ranker", "rank", "doc_id", "similarity")


def compare_batch(index: Index, lexemes: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "query_id",
                  text_col: str = "text", digits: int | None = 12) -> DataFrame:
    """(ranker, query_id, rank, doc_id, similarity) for every query."""
    a = search_batch(index, queries, k, id_col, text_col, digits).withColumn("ranker", F.lit(RANKERS[0]))
    b = fulltext_search_batch(lexemes, queries, k, id_col, text_col, digits=digits).withColumn(
        "ranker", F.lit(RANKERS[1]))
    return a.unionByName(b).select("ranker", "query_id", "rank", "doc_id", "similarity")


def compare_results(ranked: DataFrame, docs: DataFrame, fields, absent: dict[str, str] | None = None,
                    as_json: bool = False) -> DataFrame:
    """Both rankers' rows as result objects: (ranker, [query_id,] rank, val, info). ``ranked``: rows of
    ``compare`` or ``compare_batch``; the weighted ranker's ``absent`` fields are placeholders."""
    full = hydrate(ranked, docs)
    parts = [result_rows(full.where(F.col("ranker") == r), fields, absent if r == RANKERS[1] else None, as_json=as_json) for r in RANKERS]
    return parts[0].unionByName(parts[1])
