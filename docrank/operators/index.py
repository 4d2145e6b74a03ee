"""The tf-idf inverted index as DataFrame jobs.

Tables (long form, one row per posting, never one huge row per term):

  tf        doc_id, term, tf long
  terms     term, df long, idf double             (the term dictionary)
  postings  term, doc_id, tf, idf, weight [, nweight = weight / |d| once written]
  norms     doc_id, norm double                   (0.0 for documents without terms)

Plan shape of a build (see README "Plans"):
  scan(id, text) -> clean/tokenise (regex), stop test -> count by record in
  Arrow batches, where the record is read; only ids that come again are summed
  in a shuffle
  tf is written once to the shared scratch folder: the dictionary, the weights
  and the norms all read it, and a lost executor costs no second tokenising
  -> partial+final count by term -> idf                        [small shuffle]
  -> postings = tf JOIN terms on term (the dictionary is broadcast after its
     bytes are summed; beyond the bound its frequent terms are, and only rows of
     the rare ones are shuffled)
  -> norms: narrow (doc_id, w^2) rows, partial sums, one small shuffle
  Writing joins postings with norms to store nweight = weight/|d| and sorts the
  postings by (term, doc_id) over range-partitioned files with a sparse
  directory (``sources/rangetable.py``), so a search opens only the files and row
  groups of its query's terms, and a frequent term is spread over files. The
  dictionary, the norms and the stored documents are written the same way, by
  term and by id.

N (corpus size) is a scalar subquery (``DataFrame.scalar()``); a
materialised build evaluates it once and carries the count as a literal.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from docrank.functions import scoring
from docrank.functions import text as T
from docrank.functions.stem import porter2
from docrank.operators.blockmax import BLOCK_SCHEMA, write_blocks
from docrank.operators.util import dictionary_join, fits, maybe_broadcast, remove_folder, written
from docrank.sources.rangetable import RangeTable, few, write_ranges


@dataclass(frozen=True)
class IndexOptions:
    stem: bool = True
    stop_case_sensitive: bool = True

    def to_json(self) -> str:
        return json.dumps({"stem": self.stem, "stop_case_sensitive": self.stop_case_sensitive})

    @staticmethod
    def from_json(s: str) -> "IndexOptions":
        d = json.loads(s)
        return IndexOptions(stem=bool(d["stem"]), stop_case_sensitive=bool(d["stop_case_sensitive"]))


@dataclass
class Index:
    postings: DataFrame
    terms: DataFrame
    norms: DataFrame
    n_docs: Column
    options: IndexOptions = field(default_factory=IndexOptions)
    docs: DataFrame | None = None
    # True when the norms table was proven small enough to broadcast
    small_norms: bool | None = None
    # the sorted tables of a written index: postings, terms, norms and, if stored, docs
    tables: dict[str, RangeTable] = field(default_factory=dict)
    # document blocks of a written index with the table ``blocks``; 0: none
    blocks: int = 0
    # (doc_id, term, tf) of a build, where reading the postings would join them with the dictionary
    counts: DataFrame | None = None
    # scratch folders this index reads; ``release`` removes them
    scratch: tuple[str, ...] = ()

    @property
    def spark(self) -> SparkSession:
        return self.postings.sparkSession

    def tf(self) -> DataFrame:
        return (self.postings if self.counts is None else self.counts).select("doc_id", "term", "tf")

    def release(self) -> None:
        """Remove the scratch files of a build. Its frames can't be read afterwards; a written index has none."""
        for path in self.scratch:
            remove_folder(self.spark, path)


# ---------------------------------------------------------------- corpus --

def spread(df: DataFrame) -> DataFrame:
    """Round-robin the rows over all cores when the input is too small to be
    split by itself (e.g. one large row group). Tokenising is CPU-bound per
    row; an input of many splits is left as it is (no shuffle). The size is
    the planner's estimate, so no job runs."""
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < cores * (128 << 20) else df


def corpus(df: DataFrame, id_col: str = "doc_id", text_cols=("text",), spread_rows: bool = True) -> DataFrame:
    """(doc_id, text): the indexed text of each record; a null or missing
    field counts as one space, fields joined by one space."""
    if isinstance(text_cols, str):
        text_cols = (text_cols,)
    out = df.select(F.col(id_col).alias("doc_id"), T.search_text(*text_cols).alias("text"))
    return spread(out) if spread_rows else out


def _stop(token: Column, case_sensitive: bool) -> Column:
    return T.is_stopword(token if case_sensitive else F.lower(token))


def document_tokens(docs: DataFrame, options: IndexOptions = IndexOptions()) -> DataFrame:
    """(doc_id, pos, token): tokens kept by the stop test, with their position
    in the cleaned token list."""
    toks = docs.select("doc_id", F.posexplode(T.clean_text(F.col("text"))).alias("pos", "token"))
    return toks.where(~_stop(F.col("token"), options.stop_case_sensitive))


# Words that are counted at once, and stems that a task remembers.
COUNTED_WORDS = 500_000
KNOWN_STEMS = 200_000


def _counter(stemmed: bool):
    """Arrow function that counts the words of each row's list: (doc_id, term, tf), the terms of a row together."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stems: dict[str, str] = {}
        for batch in batches:
            sizes = np.asarray(pc.fill_null(pc.list_value_length(batch.column("words")), 0), np.int64)
            ends = np.cumsum(sizes)
            lo = 0
            while lo < batch.num_rows:
                before = int(ends[lo - 1]) if lo else 0
                hi = max(lo + 1, int(np.searchsorted(ends, before + COUNTED_WORDS, side="right")))
                part, size = batch.slice(lo, hi - lo), sizes[lo:hi]
                lo = hi
                found = pa.table({"row": np.repeat(np.arange(len(size)), size), "term": part.column("words").flatten()}).group_by(
                    ["row", "term"], use_threads=False).aggregate([([], "count_all")]).rename_columns({"count_all": "tf"})
                if stemmed and found.num_rows:
                    words = found["term"].combine_chunks().dictionary_encode()
                    distinct = words.dictionary.to_pylist()
                    if len(stems) > KNOWN_STEMS:
                        stems.clear()
                    for w in distinct:
                        if w not in stems:
                            stems[w] = porter2(w)
                    terms = pa.array([stems[w] for w in distinct], pa.string()).take(words.indices)
                    found = pa.table({"row": found["row"], "term": terms, "tf": found["tf"]}).group_by(
                        ["row", "term"], use_threads=False).aggregate([("tf", "sum")]).rename_columns({"tf_sum": "tf"})
                out = pa.table({"doc_id": part.column("doc_id").take(found["row"].combine_chunks()), "term": found["term"].cast(pa.string()),
                                "tf": found["tf"].cast(pa.int64())}).combine_chunks()
                yield from out.to_batches()

    return count


def record_counts(docs: DataFrame, options: IndexOptions = IndexOptions()) -> DataFrame:
    """(doc_id, term, tf) of each record by itself, without a shuffle. Stop test on the original token, then
    lower-case, count, and stem the counted words."""
    kept = F.filter(T.clean_text(F.col("text")), lambda x: ~_stop(x, options.stop_case_sensitive))
    schema = StructType([StructField("doc_id", docs.schema["doc_id"].dataType), StructField("term", StringType()), StructField("tf", LongType())])
    return docs.select("doc_id", T.lowercase_tokens(kept).alias("words")).mapInArrow(_counter(options.stem), schema)


def term_frequency(docs: DataFrame, options: IndexOptions = IndexOptions()) -> DataFrame:
    """(doc_id, term, tf). All words of a record are in one row, so they are counted where it is read. Only records
    whose id comes again (or several without one) are summed by (doc_id, term) in a shuffle, all of them where many ids do."""
    many = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("_again"))
    found = few(many)
    add = lambda rows: rows.groupBy("doc_id", "term").agg(F.sum("tf").alias("tf"))
    if found is None:
        return add(record_counts(docs, options))
    if not found.num_rows:
        return record_counts(docs, options)
    again = F.broadcast(docs.sparkSession.createDataFrame(found).select(F.col("_again").cast(docs.schema["doc_id"].dataType).alias("_again")))
    same = F.col("doc_id").eqNullSafe(F.col("_again"))
    return record_counts(docs.join(again, same, "left_anti"), options).unionByName(add(record_counts(docs.join(again, same, "left_semi"), options)))


def corpus_size(docs: DataFrame) -> Column:
    """N as a lazy scalar subquery: every record counts, with or without terms."""
    return docs.select(F.count(F.lit(1))).scalar()


def document_frequency(tf: DataFrame, n_docs: Column) -> DataFrame:
    """(term, df, idf). Partial aggregation collapses frequent terms map-side."""
    # count(tf) (never null) keeps the tf column, so this branch and the
    # weights branch share one tf exchange (ReuseExchange) in a single plan
    return tf.groupBy("term").agg(F.count("tf").alias("df")).withColumn(
        "idf", scoring.idf(n_docs, F.col("df"))
    )


def posting_weights(tf: DataFrame, terms: DataFrame, small_dictionary: bool | None = None) -> DataFrame:
    """(term, doc_id, tf, idf, weight).

    ``small_dictionary`` True: the dictionary is broadcast (the caller summed
    its bytes). False: its frequent terms are, and only postings of the others
    are shuffled. None: leave the choice to the planner."""
    if small_dictionary is False:
        joined = dictionary_join(tf, terms.select("term", "df", "idf"), "term", "df", "doc_id")
    else:
        d = terms.select("term", "idf")
        joined = tf.join(F.broadcast(d) if small_dictionary else d, "term")
    return joined.select("term", "doc_id", "tf", "idf", scoring.tfidf("tf", "idf").alias("weight"))


def document_norms(weights: DataFrame, doc_ids: DataFrame) -> DataFrame:
    """(doc_id, norm) on its own: narrow (doc_id, w^2) rows, partial sums,
    one shuffle; documents without terms get 0.0."""
    sq = weights.select("doc_id", (F.col("weight") * F.col("weight")).alias("w2"))
    zeros = doc_ids.select("doc_id", F.lit(0.0).alias("w2"))
    return sq.unionByName(zeros).groupBy("doc_id").agg(F.sqrt(F.sum("w2")).alias("norm"))


# The terms of a row group are told apart by numbers, not only those of the first megabyte.
COUNT_FILES = {"parquet__dictionary__page__size": str(8 << 20)}


def index_from_tf(tf: DataFrame, doc_ids: DataFrame, n_docs: Column, options: IndexOptions,
                  docs: DataFrame | None = None, materialize: bool = True, kept: tuple[str, ...] | None = None) -> Index:
    """Dictionary, weights, norms from term counts.

    ``materialize``: write tf, the dictionary and the norms to the shared
    scratch folder (tf feeds all of them, and would otherwise be tokenised for
    each) and sum their bytes before choosing joins. The index owns the folders;
    ``release`` removes them. Without it the whole index stays one lazy plan.
    ``kept``: scratch folders that hold what of tf isn't in a written index, where the caller wrote it.
    """
    scratch: list[str] = list(kept or ())
    small = small_norms = None

    def keep(df: DataFrame, name: str, **options: str) -> DataFrame:
        if not materialize:
            return df
        df, path = written(df, f"docrank-{name}", **options)
        scratch.append(path)
        return df

    if materialize:
        # N once, as a literal: the dictionary must not scan the corpus ids for it again
        n_docs = F.lit(tf.sparkSession.range(1).select(n_docs.cast("long")).first()[0]).cast("long")
    tf = keep(tf, "tf", **COUNT_FILES) if kept is None else tf
    terms = keep(document_frequency(tf, n_docs), "terms")
    small = fits(terms.select("term", "idf")) if materialize else None
    weights = posting_weights(tf, terms, small)
    norms = keep(document_norms(weights, doc_ids), "norms")
    small_norms = fits(norms) if materialize else None
    return Index(postings=weights, terms=terms, norms=norms, n_docs=n_docs, options=options, docs=docs,
                 small_norms=small_norms, scratch=tuple(scratch), counts=tf)


def build_index(df: DataFrame, id_col: str = "doc_id", text_cols=("text",), stem: bool = True,
                stop_case_sensitive: bool = True, store_cols=None, materialize: bool = True) -> Index:
    """Index over ``df``. Stemming is on by default, as in the reference
    pipeline; ``stem=False`` indexes lower-cased words.

    With ``materialize`` (default) the tokenise-and-count job runs once here
    and its counts are written to the shared scratch folder; postings are a
    lazy frame on top. ``release()`` removes the scratch files.
    ``store_cols``: columns kept in the document store for hydration
    (default: id and text columns).
    """
    options = IndexOptions(stem=stem, stop_case_sensitive=stop_case_sensitive)
    docs = corpus(df, id_col, text_cols)
    ids = df.select(F.col(id_col).alias("doc_id"))  # counting needs no spreading
    tf = term_frequency(docs, options)
    if store_cols is None:
        store_cols = [id_col] + [c for c in ([text_cols] if isinstance(text_cols, str) else text_cols) if c != id_col]
    store = df.select(F.col(id_col).alias("doc_id"), *[c for c in store_cols if c != id_col])
    return index_from_tf(tf, ids, corpus_size(ids), options, docs=store, materialize=materialize)


# Postings per exported map entry block.
POSTING_BLOCK = 100_000


def posting_lists(index: Index, block_size: int = POSTING_BLOCK) -> DataFrame:
    """Export view of the index in map form: (term, block, idf, papers
    map<doc_id, weight>, size).

    A term with df postings is split into ceil(df / block_size) blocks by a
    hash of doc_id, so no group collected into one row grows with the corpus
    (a term in every document becomes many bounded rows). Search never uses
    this view; it works on the long postings."""
    # Only terms with more than one block need their number of blocks; at most one for ``block_size`` postings.
    blocks = index.terms.where(F.col("df") > block_size).select(
        "term", F.ceil(F.col("df") / F.lit(block_size)).cast("long").alias("nblocks"))
    p = index.postings.select("term", "doc_id", "tf", "idf").join(F.broadcast(blocks) if fits(blocks) else blocks, "term", "left").select(
        "term", F.pmod(F.xxhash64("doc_id"), F.coalesce("nblocks", F.lit(1))).alias("block"), "doc_id", "tf", "idf")
    # Dealt once, as whole rows: the weights are formed behind the shuffle, and no partial lists are built before it.
    p = p.repartition("term", "block").withColumn("weight", scoring.tfidf("tf", "idf"))
    return p.groupBy("term", "block").agg(
        F.first("idf").alias("idf"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("doc_id", "weight")))).alias("papers"),
        F.count(F.lit(1)).alias("size"),
    )


# ------------------------------------------------------------ persistence --

POSTING_COLUMNS = ("term", "doc_id", "tf", "idf", "weight", "nweight")


def _with_norms(postings: DataFrame, norms: DataFrame) -> DataFrame:
    """The columns of a written index for rows with term, doc_id, tf and idf."""
    weighted = postings.select("term", "doc_id", "tf", "idf", scoring.tfidf("tf", "idf").alias("weight"))
    return weighted.join(norms, "doc_id").select(*POSTING_COLUMNS[:-1], scoring.safe_ratio("weight", "norm").alias("nweight"))


def normalized_postings(index: Index) -> DataFrame:
    """Postings with nweight = weight / |d| (0.0 when |d| is 0), so a search
    on them needs no norms join."""
    if "nweight" in index.postings.columns:
        return index.postings.select(*POSTING_COLUMNS)
    small = index.small_norms if index.small_norms is not None else fits(index.norms)
    return _with_norms(index.postings, maybe_broadcast(index.norms, small))


def _write_postings(index: Index, path: str, rows: int) -> RangeTable:
    """The normalised postings as a range table. Weights are formed where the sorted rows are, unless that takes a shuffle."""
    if "nweight" not in index.postings.columns and (index.small_norms if index.small_norms is not None else fits(index.norms)):
        # an inner join, as in normalized_postings: ids without a norm (null) have no postings
        return write_ranges(index.postings.select("term", "doc_id", "tf", "idf").where("doc_id IS NOT NULL"), path, "term", ("doc_id",), rows=rows,
                            finish=lambda dealt: _with_norms(dealt, F.broadcast(index.norms)), keys=index.tf())
    return write_ranges(normalized_postings(index), path, "term", ("doc_id",), rows=rows, keys=index.tf())


# A written index: ``published/version=n`` names the complete ones, ``data/version=n`` holds them.
PUBLISHED = "n_docs long, options string, has_docs boolean, blocks int, version int"


def published_versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete versions at ``path``, in order; none where the path doesn't exist.

    Anything else that keeps them from being read is raised."""
    try:
        rows = spark.read.schema(PUBLISHED).parquet(path.rstrip("/") + "/published").select("version").collect()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    return sorted(r["version"] for r in rows)


def write_index(index: Index, path: str, mode: str = "overwrite", block_docs: int = 0) -> Index:
    """Write a new version of the index at ``path`` and return it, read back.

    The tables of a version are written first, the row that publishes it last,
    and nothing that exists is written over: an interrupted write leaves the
    version before it in place, and an index may be written to the path it was
    read from. Two writers of one version fail on its folder. ``mode``:
    ``overwrite`` makes the new version the current one, ``error`` raises if
    there is any. ``block_docs``: documents of a block for ``search_pruned``; 0 writes
    no blocks. ``drop_old_versions`` frees the space of earlier ones."""
    spark, base = index.spark, path.rstrip("/")
    known = published_versions(spark, base)
    if mode not in ("overwrite", "error"):
        raise ValueError("mode is overwrite or error")
    if known and mode == "error":
        raise FileExistsError(path)
    version = (known[-1] if known else 0) + 1
    data = f"{base}/data/version={version}"
    write_ranges(index.terms.select("term", "df", "idf"), data + "/terms", "term")
    write_ranges(index.norms.select("doc_id", "norm"), data + "/norms", "doc_id")
    total = index.terms.agg(F.sum("df").alias("n")).first()["n"] or 0
    postings = _write_postings(index, data + "/postings", total)
    blocks = 0
    if block_docs:
        blocks = max(1, -(-spark.read.parquet(data + "/norms/rows").count() // block_docs))
        write_blocks(postings.rows(), "nweight", blocks, data + "/blocks")
    if index.docs is not None:
        write_ranges(index.docs, data + "/docs", "doc_id")
    spark.range(1).select(
        index.n_docs.cast("long").alias("n_docs"), F.lit(index.options.to_json()).alias("options"),
        F.lit(index.docs is not None).alias("has_docs"), F.lit(blocks).alias("blocks"),
    ).coalesce(1).write.parquet(f"{base}/published/version={version}")
    return read_index(spark, path, version)


def read_index(spark: SparkSession, path: str, version: int | None = None) -> Index:
    """The index at ``path``: its last published version, or the one asked for."""
    base = path.rstrip("/")
    known = published_versions(spark, base)
    if not known or (version is not None and version not in known):
        raise FileNotFoundError(f"no index version {version or ''} at {path}")
    version = known[-1] if version is None else version
    row = spark.read.schema(PUBLISHED).parquet(base + "/published").where(F.col("version") == version).first()
    data = f"{base}/data/version={version}"
    # The directories have rows of the id's type even where an index without terms has no postings.
    id_type = spark.read.parquet(data + "/norms/directory").schema["first"].dataType.simpleString()
    schemas = {"postings": f"term string, doc_id {id_type}, tf long, idf double, weight double, nweight double",
               "terms": "term string, df long, idf double", "norms": f"doc_id {id_type}, norm double"}
    keys = {"postings": "term", "terms": "term", "norms": "doc_id"}
    tables = {k: RangeTable(spark, f"{data}/{k}", StructType.fromDDL(ddl), keys[k]) for k, ddl in schemas.items()}
    if row["blocks"]:
        tables["blocks"] = RangeTable(spark, data + "/blocks", BLOCK_SCHEMA, "term")
    if row["has_docs"]:
        tables["docs"] = RangeTable(spark, data + "/docs", spark.read.parquet(data + "/docs/rows").schema, "doc_id")
    return Index(
        postings=tables["postings"].rows(), terms=tables["terms"].rows(), norms=tables["norms"].rows(),
        n_docs=F.lit(row["n_docs"]).cast("long"), options=IndexOptions.from_json(row["options"]),
        docs=tables["docs"].rows() if row["has_docs"] else None, tables=tables, blocks=row["blocks"])


def drop_old_versions(spark: SparkSession, path: str) -> None:
    """Remove all versions but the last published one; readers of the others fail afterwards."""
    base = path.rstrip("/")
    for version in published_versions(spark, base)[:-1]:
        remove_folder(spark, f"{base}/published/version={version}")
        remove_folder(spark, f"{base}/data/version={version}")
