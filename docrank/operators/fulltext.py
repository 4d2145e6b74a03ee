"""Weighted full-text ranker: field-labelled lexemes, OR matching, and a
cover-density score.

For an OR query every matched position is a cover of length one, so the
score of a document is the sum of the label weights of its positions whose
lexeme is one of the query's (distinct) lexemes; document repeats count,
query repeats do not. Fields are scanned for typed tokens (``functions/text.py``), a
query is split on everything but ASCII letters and digits.

Plan: lexemes are a long table (doc_id, field, label, weight, pos, term),
made in one pass over the records: stop words and stems are decided per
token, without a vocabulary table or a join. A written weighted index holds
one row per (term, doc_id) with the summed weight, sorted with a directory
like the postings of the cosine index. Query lexemes (distinct per
query) are broadcast once their bytes are known to be few; a partial+final
sum by (query_id, doc_id) gives the score; WindowGroupLimit cuts to k per
query before the ranking exchange. One query is a batch of one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docrank.functions import text as T
from docrank.functions.stem import stem, stem_words_udf
from docrank.operators.blockmax import BLOCK_SCHEMA, pruned_top_k, write_blocks
from docrank.operators.index import published_versions
from docrank.operators.search import one_query, top_k
from docrank.operators.util import fits, remove_folder, require_positive_k, slices, split_join, written
from docrank.sources.rangetable import RangeTable, few, write_ranges

# Default label weights of the cover-density rank.
LABEL_WEIGHTS = {"A": 1.0, "B": 0.4, "C": 0.2, "D": 0.1}
# Field labels of the paper table: id A, title B, categories C.
PAPER_FIELD_LABELS = (("id", "A"), ("title", "B"), ("categories", "C"))


def _is_word(term: Column) -> Column:
    """Letters of any script, hyphens between them: such tokens go through the stop list
    and the stemmer; tokens with digits, hosts and addresses are kept lower-cased as they are."""
    return term.rlike("^\\p{L}+(-\\p{L}+)*$")


def _normalise(rows: DataFrame, stemmed: bool) -> DataFrame:
    """Drop stop words among words and stem the rest in Arrow batches; other tokens pass unchanged."""
    rows = rows.where(~(_is_word(F.col("term")) & T.is_stopword(F.col("term"), T.FULLTEXT_STOPWORDS)))
    if not stemmed:
        return rows
    return rows.withColumn("term", F.when(_is_word(F.col("term")), stem("term")).otherwise(F.col("term")))


def fulltext_lexemes(df: DataFrame, id_col: str, fields=PAPER_FIELD_LABELS, stem: bool = True) -> DataFrame:
    """(doc_id, field, label, weight, pos, term): one row per kept lexeme
    position; positions count every token of the field, stop words too."""
    entries = F.array(*[
        F.struct(F.lit(name).alias("field"), F.lit(label).alias("label"),
                 F.coalesce(F.col(name).cast("string"), F.lit("")).alias("text"))
        for name, label in fields
    ])
    per_field = df.select(F.col(id_col).alias("doc_id"), F.explode(entries).alias("f"))
    toks = per_field.select(
        "doc_id", F.col("f.field").alias("field"), F.col("f.label").alias("label"),
        F.posexplode(T.lexeme_tokens(F.col("f.text"))).alias("pos", "term"),
    )
    lex = _normalise(toks, stem)
    return lex.select("doc_id", "field", "label", _weight(F.col("label")).alias("weight"),
                      F.col("pos").cast("int").alias("pos"), "term")


def _weight(label: Column) -> Column:
    return F.element_at(F.create_map(*[x for k, v in LABEL_WEIGHTS.items() for x in (F.lit(k), F.lit(v))]), label)


def build_fulltext(df: DataFrame, id_col: str = "id", fields=PAPER_FIELD_LABELS, stem: bool = True,
                   column: str = "search_txt") -> DataFrame:
    """Add the weighted lexeme list as column ``column`` unless the table
    already has it: array<struct<field, pos, term, label, weight>> per record.

    A projection of each record: tokens of a field are numbered, stop words
    dropped, the rest stemmed as one list; no shuffle, whatever ids repeat."""
    if column in df.columns:
        return df
    lists = []
    for name, label in fields:
        tokens = F.transform(T.lexeme_tokens(F.coalesce(F.col(name).cast("string"), F.lit(""))),
                             lambda t, i: F.struct(t.alias("t"), i.cast("int").alias("i")))
        kept = F.filter(tokens, lambda x: ~(_is_word(x["t"]) & T.is_stopword(x["t"], T.FULLTEXT_STOPWORDS)))
        words = F.transform(kept, lambda x: x["t"])
        words = stem_words_udf(words) if stem else words
        lists.append(F.zip_with(kept, words, _entry(name, label)))
    return df.withColumn(column, F.sort_array(F.concat(*lists)))


def _entry(name: str, label: str):
    return lambda x, word: F.struct(F.lit(name).alias("field"), x["i"].alias("pos"), word.alias("term"),
                                    F.lit(label).alias("label"), F.lit(LABEL_WEIGHTS[label]).alias("weight"))


def stored_lexemes(df: DataFrame, id_col: str = "id", column: str = "search_txt") -> DataFrame:
    """The lexeme rows of a table that has the column ``build_fulltext`` adds; texts are not read."""
    return df.select(F.col(id_col).alias("doc_id"), F.explode(column).alias("x")).select(
        "doc_id", "x.field", "x.label", "x.weight", "x.pos", "x.term")


@dataclass
class WeightedIndex:
    """One row per (term, doc_id) with the summed ``weight``, sorted by them; ``sizes``: term, n."""

    table: RangeTable
    sizes: DataFrame
    # largest weight by term and block of documents, and the number of blocks (0: not written)
    maxima: RangeTable | None = None
    blocks: int = 0

    @property
    def lexemes(self) -> DataFrame:
        return self.table.rows()


def write_fulltext(lexemes: DataFrame, path: str, block_docs: int = 0) -> WeightedIndex:
    """Write lexemes as a new version at ``path``; the version before it stays until the new one is published.

    ``block_docs``: documents of a block for ``fulltext_search_pruned``; 0 writes no blocks."""
    spark, base = lexemes.sparkSession, path.rstrip("/")
    version = max(published_versions(spark, base), default=0) + 1
    data = f"{base}/data/version={version}"
    sums, scratch = written(lexemes.groupBy("term", "doc_id").agg(F.sum("weight").alias("weight")), "docrank-sums")
    table = write_ranges(sums, data + "/lexemes", "term", ("doc_id",))
    remove_folder(spark, scratch)
    table.rows().groupBy("term").agg(F.count("*").alias("n")).write.parquet(data + "/sizes")
    blocks = 0
    if block_docs:
        blocks = max(1, -(-table.rows().select("doc_id").distinct().count() // block_docs))
        write_blocks(table.rows(), "weight", blocks, data + "/blocks")
    spark.range(1).select(F.lit(0).cast("long").alias("n_docs"), F.lit(sums.schema["doc_id"].dataType.simpleString()).alias("options"), F.lit(False).alias("has_docs"),
                          F.lit(blocks).alias("blocks")).coalesce(1).write.parquet(f"{base}/published/version={version}")
    return read_fulltext(spark, path)


def read_fulltext(spark: SparkSession, path: str) -> WeightedIndex:
    """The last published version at ``path``."""
    base = path.rstrip("/")
    known = published_versions(spark, base)
    if not known:
        raise FileNotFoundError(f"no weighted index at {path}")
    data = f"{base}/data/version={known[-1]}"
    row = spark.read.parquet(f"{base}/published/version={known[-1]}").first()
    schema = StructType.fromDDL(f"term string, doc_id {row['options']}, weight double")
    return WeightedIndex(RangeTable(spark, data + "/lexemes", schema, "term"), spark.read.schema("term string, n long").parquet(data + "/sizes"),
                         RangeTable(spark, data + "/blocks", BLOCK_SCHEMA, "term") if row["blocks"] else None, row["blocks"])


def fulltext_query_terms(queries: DataFrame, id_col: str = "query_id", text_col: str = "text",
                         stem: bool = True) -> DataFrame:
    """(query_id, term) distinct: the OR-query lexemes of each query."""
    words = queries.select(F.col(id_col).alias("query_id"), F.explode(T.query_words(F.col(text_col))).alias("w"))
    toks = words.select("query_id", F.lower("w").alias("term"))
    return _normalise(toks, stem).select("query_id", "term").distinct()


def fulltext_scores(lexemes: DataFrame | WeightedIndex, qterms: DataFrame, small: bool | None = None) -> DataFrame:
    """(query_id, doc_id, similarity) for documents matching any query lexeme."""
    sizes = None
    found = few(qterms) if small is not False else None
    spark = qterms.sparkSession
    if isinstance(lexemes, WeightedIndex):
        sizes = lexemes.sizes
        if found is not None:  # few query rows: their terms are looked up
            lexemes = lexemes.table.lookup(sorted(set(found["term"].to_pylist())))
        else:
            lexemes = lexemes.lexemes
    rows = lexemes.select("doc_id", "term", "weight")
    if found is not None:
        qterms = spark.createDataFrame(found)
        if len(set(found["query_id"].to_pylist())) > 1:
            rows = _dealt(rows, qterms, write=sizes is None)
        m = F.broadcast(qterms).join(rows, "term")
    elif small or (small is None and fits(qterms)):
        m = F.broadcast(qterms).join(rows, "term")
    else:
        rows = rows.groupBy("doc_id", "term").agg(F.sum("weight").alias("weight"))
        sizes = rows.groupBy("term").agg(F.count("*").alias("n")) if sizes is None else sizes
        m = split_join(rows, qterms, sizes, "term", "n", "doc_id")
    return m.groupBy("query_id", "doc_id").agg(F.sum("weight").alias("similarity"))


def _dealt(rows: DataFrame, qterms: DataFrame, write: bool) -> DataFrame:
    """Rows with a query lexeme, one for each lexeme of a document, dealt to tasks by document, as many as the rows
    that the queries make of them ask for: scores of a document are summed in its task and never shuffled."""
    asked = F.broadcast(qterms.groupBy("term").agg(F.count("*").alias("_queries")))
    rows = rows.join(asked, "term")
    if write:  # scanned texts; counted and read again
        rows, _ = written(rows, "docrank-lexemes")
    n = rows.agg(F.sum("_queries").alias("n")).first()["n"] or 0
    return rows.repartition(slices(rows.sparkSession, n), "doc_id").groupBy("doc_id", "term").agg(F.sum("weight").alias("weight"))


def fulltext_search_batch(lexemes: DataFrame | WeightedIndex, queries: DataFrame, k: int = 5, id_col: str = "query_id",
                          text_col: str = "text", stem: bool = True, digits: int | None = 12) -> DataFrame:
    """(query_id, rank, doc_id, similarity): top-k by score desc, doc_id asc.

    ``lexemes``: rows of ``fulltext_lexemes`` or ``stored_lexemes``, or a written index."""
    require_positive_k(k)
    qterms = fulltext_query_terms(queries, id_col, text_col, stem)
    return top_k(fulltext_scores(lexemes, qterms), k, digits=digits).select("query_id", "rank", "doc_id", "similarity")


def fulltext_search(lexemes: DataFrame | WeightedIndex, query: str, k: int = 5, stem: bool = True,
                    digits: int | None = 12) -> DataFrame:
    """(rank, doc_id, similarity) for one query: a batch of one."""
    spark = (lexemes.lexemes if isinstance(lexemes, WeightedIndex) else lexemes).sparkSession
    return fulltext_search_batch(lexemes, one_query(spark, query), k, stem=stem, digits=digits).select("rank", "doc_id", "similarity")


def fulltext_search_pruned(index: WeightedIndex, queries: DataFrame, k: int = 5, id_col: str = "query_id", text_col: str = "text",
                           stem: bool = True, digits: int = 12) -> tuple[DataFrame, DataFrame]:
    """The rows of ``fulltext_search_batch`` with blocks of documents skipped by their bounds, and what was read.

    For few query rows on an index written with blocks; other calls raise ``ValueError``."""
    require_positive_k(k)
    found = few(fulltext_query_terms(queries, id_col, text_col, stem))
    if found is None or not index.blocks:
        raise ValueError("pruned search takes few query terms and an index written with blocks")
    keys = sorted(set(found["term"].to_pylist()))
    asked = index.sizes.sparkSession.createDataFrame(found).withColumn("w", F.lit(1.0))
    return pruned_top_k(index.table.lookup(keys), index.maxima.lookup(keys), index.blocks, asked, "weight", k, digits)
