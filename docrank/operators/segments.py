"""An index that grows by immutable segments of term counts.

Each addition writes one segment; nothing that exists is rewritten. A segment holds

  counts  term, doc_id, tf      counts of the added records
  terms   term, df              documents that the segment adds to each term
  docs    doc_id, n             records of each id
  sums    doc_id, a, b, c       what the segment adds to the sums of each document

Weights are formed when a search runs: N and df are sums over segments. With
u = 1 + ln tf, a document's norm follows from three sums over its terms,

  a = sum u^2,  b = sum u^2 ln df,  c = sum u^2 (ln df)^2,   |d|^2 = a (ln N)^2 - 2 b ln N + c,

so a change of N costs nothing, and a change of df adds a row only for documents
that hold the term; their postings are read, not written. Segments of one level are merged
into one of the next when there are ``FANOUT`` of them, so each posting is rewritten
as often as there are levels: the logarithm of the number of additions.

Ids that are added again add their counts, as in a rebuild; their sums are formed
anew. A version names its segments and is published last, like a written index.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docrank.functions import scoring
from docrank.operators.index import Index, IndexOptions, corpus, posting_weights, published_versions, term_frequency
from docrank.operators.util import dictionary_join, fits, maybe_broadcast, written
from docrank.sources.rangetable import RangeTable, few, write_ranges

FANOUT = 4
KEYS = {"counts": ("term", ("doc_id",)), "terms": ("term", ()), "docs": ("doc_id", ()), "sums": ("doc_id", ())}
SUMS = ("a", "b", "c")


@dataclass(frozen=True)
class Lookup:
    """A table that can be read for few keys."""

    lookup: Callable[[list], DataFrame]


@dataclass(frozen=True)
class Segments:
    """A version of the index at ``path``: its segments (name, level), N, and whether ids were added again."""

    spark: SparkSession
    path: str
    version: int
    options: IndexOptions
    parts: tuple[tuple[str, int], ...]
    n_docs: int
    again: bool
    id_type: str

    def table(self, name: str, kind: str) -> RangeTable:
        schema = {"counts": f"term string, doc_id {self.id_type}, tf long", "terms": "term string, df long",
                  "docs": f"doc_id {self.id_type}, n long", "sums": f"doc_id {self.id_type}, a double, b double, c double"}[kind]
        return RangeTable(self.spark, f"{self.path}/segments/{name}/{kind}", T.StructType.fromDDL(schema), KEYS[kind][0])

    def rows(self, kind: str, names=None, keys: list | None = None) -> DataFrame:
        """Rows of all segments (or of ``names``), of ``keys`` only if these are given."""
        tables = [self.table(n, kind) for n, _ in self.parts if names is None or n in names]
        frames = [t.rows() if keys is None else t.lookup(keys) for t in tables]
        none = self.spark.createDataFrame([], self.table("", kind).schema)
        return reduce(DataFrame.unionByName, frames, none) if len(frames) != 1 else frames[0]

    def counts(self, names=None, keys: list | None = None) -> DataFrame:
        """(term, doc_id, tf), one row for each term of a document."""
        rows = self.rows("counts", names, keys)
        return rows.groupBy("term", "doc_id").agg(F.sum("tf").alias("tf")) if self.again and len(self.parts) > 1 else rows

    def terms(self, keys: list | None = None) -> DataFrame:
        """(term, df, idf)."""
        return self.rows("terms", keys=keys).groupBy("term").agg(F.sum("df").alias("df")).withColumn("idf", scoring.idf(F.lit(self.n_docs), "df"))

    def norms(self) -> DataFrame:
        """(doc_id, norm) of every document from its sums."""
        zeros = self.rows("docs").select("doc_id", *(F.lit(0.0).alias(c) for c in SUMS))
        total = self.rows("sums").unionByName(zeros).groupBy("doc_id").agg(*(F.sum(c).alias(c) for c in SUMS))
        ln = math.log(self.n_docs) if self.n_docs else 0.0
        square = F.lit(ln * ln) * F.col("a") - F.lit(2 * ln) * F.col("b") + F.col("c")
        return total.select("doc_id", F.sqrt(F.greatest(square, F.lit(0.0))).alias("norm"))

    def index(self) -> Index:
        """The index that a build over all added records gives, for all functions that take one; nothing is written."""
        def postings(keys: list | None = None) -> DataFrame:
            terms = self.terms(keys)
            return posting_weights(self.counts(keys=keys), terms, True if keys is not None else None)

        return Index(postings=postings(), terms=self.terms(), norms=self.norms(), n_docs=F.lit(self.n_docs).cast("long"),
                     options=self.options, tables={"terms": Lookup(self.terms), "postings": Lookup(postings)})


def _publish(s: Segments) -> Segments:
    row = [(s.n_docs, s.options.to_json(), s.id_type, s.again, [n for n, _ in s.parts], [level for _, level in s.parts])]
    schema = "n_docs long, options string, id_type string, again boolean, segments array<string>, levels array<int>"
    s.spark.createDataFrame(row, schema).coalesce(1).write.parquet(f"{s.path}/published/version={s.version}")
    return s


def open_segments(spark: SparkSession, path: str) -> Segments:
    """The last published version at ``path``."""
    base = path.rstrip("/")
    known = published_versions(spark, base)
    if not known:
        raise FileNotFoundError(f"no segments at {path}")
    r = spark.read.parquet(f"{base}/published/version={known[-1]}").first()
    return Segments(spark, base, known[-1], IndexOptions.from_json(r["options"]), tuple(zip(r["segments"], r["levels"])), r["n_docs"], r["again"],
                    r["id_type"])


def create_segments(spark: SparkSession, path: str, options: IndexOptions = IndexOptions(), id_type: str = "bigint") -> Segments:
    """A new index without records at ``path``; ``id_type`` is the type of its ids."""
    if published_versions(spark, path.rstrip("/")):
        raise FileExistsError(path)
    return _publish(Segments(spark, path.rstrip("/"), 1, options, (), 0, False, id_type))


def _write(s: Segments, tables: dict[str, DataFrame]) -> str:
    name = f"segment-{uuid.uuid4().hex}"
    for kind, df in tables.items():
        key, then = KEYS[kind]
        write_ranges(df, f"{s.path}/segments/{name}/{kind}", key, then)
    return name


def _on_term(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """Counts joined with a table of terms (column n: documents of the term): broadcast as far as it fits, its
    most frequent terms first."""
    if fits(terms):
        return rows.join(F.broadcast(terms), "term")
    return dictionary_join(rows, terms, "term", "n", "doc_id")


def _sums(rows: DataFrame, a: Column, b: Column, c: Column) -> DataFrame:
    return rows.groupBy("doc_id").agg(F.sum(a).alias("a"), F.sum(b).alias("b"), F.sum(c).alias("c"))


def add_records(s: Segments, df: DataFrame, id_col: str = "doc_id", text_cols=("text",), fanout: int = FANOUT) -> Segments:
    """The index with the records of ``df``: a new version with one more segment, merged where a level is full."""
    new, _ = written(term_frequency(corpus(df, id_col, text_cols), s.options).select("term", F.col("doc_id").cast(s.id_type).alias("doc_id"), "tf"),
                     "docrank-counts")
    ids, _ = written(df.groupBy(F.col(id_col).cast(s.id_type).alias("doc_id")).agg(F.count("*").alias("n")), "docrank-ids")
    total = ids.agg(F.sum("n").alias("n")).first()["n"] or 0
    if not total:
        return s
    # Ids that the index has already.
    repeated, _ = written(ids.select("doc_id").join(s.rows("docs").select("doc_id"), "doc_id", "left_semi").distinct(), "docrank-again")
    again = repeated.count() > 0
    mark = maybe_broadcast(repeated, fits(repeated)) if again else repeated
    moved = None
    if again:
        moved, _ = written(s.counts().join(mark, "doc_id", "left_semi"), "docrank-moved")
    added = new.join(moved, ["doc_id", "term"], "left_anti") if again else new
    delta, _ = written(added.groupBy("term").agg(F.count("*").alias("df")), "docrank-delta")

    # df of the changed terms before and after; few of them are looked up, with their postings.
    found = few(delta.select("term"))
    keys = None if found is None else found["term"].to_pylist()
    before = s.rows("terms", keys=keys).groupBy("term").agg(F.sum("df").alias("df0"))
    changed, _ = written(delta.join(before, "term", "left").select(
        "term", (F.coalesce("df0", F.lit(0)) + F.col("df")).alias("n"), F.log(F.coalesce("df0", F.lit(1)).cast("double")).alias("l0"), F.log((F.coalesce("df0", F.lit(0)) + F.col("df")).cast("double")).alias("l1")),
        "docrank-changed")
    u = scoring.tf_weight("tf") * scoring.tf_weight("tf")
    l0, l1 = F.col("l0"), F.col("l1")
    without = lambda rows: rows.join(mark, "doc_id", "left_anti") if again else rows
    sums = [_sums(_on_term(without(new), changed), u, u * l1, u * l1 * l1)]
    if s.parts:
        old = _on_term(without(s.counts(keys=keys)), changed.where("l0 <> l1"))
        sums.append(_sums(old, F.lit(0.0), u * (l1 - l0), u * (l1 * l1 - l0 * l0)))
    if again:  # these documents' terms may not have changed, only their counts
        whole, _ = written(moved.unionByName(new.join(mark, "doc_id", "left_semi").select(*moved.columns)).groupBy("term", "doc_id").agg(
            F.sum("tf").alias("tf")), "docrank-whole")
        now = s.rows("terms").unionByName(delta).join(whole.select("term").distinct(), "term", "left_semi").groupBy("term").agg(
            F.sum("df").alias("n"), F.log(F.sum("df").cast("double")).alias("l1"))
        sums.append(_sums(_on_term(whole, written(now, "docrank-now")[0]), u, u * l1, u * l1 * l1))
        sums.append(s.rows("sums").join(mark, "doc_id", "left_semi").select("doc_id", *((-F.col(c)).alias(c) for c in SUMS)))
    added_sums = reduce(DataFrame.unionByName, sums).groupBy("doc_id").agg(*(F.sum(c).alias(c) for c in SUMS))
    name = _write(s, {"counts": new, "terms": delta, "docs": ids, "sums": written(added_sums, "docrank-sums")[0]})
    grown = Segments(s.spark, s.path, s.version + 1, s.options, (*s.parts, (name, 0)), s.n_docs + total, s.again or again, s.id_type)
    return _publish(_tiered(grown, fanout))


def _tiered(s: Segments, fanout: int) -> Segments:
    """Levels with ``fanout`` segments merged into one segment of the next level."""
    level = 0
    while any(own >= level for _, own in s.parts):
        full = [n for n, own in s.parts if own == level]
        if len(full) >= fanout:
            counts = s.rows("counts", full)
            if s.again:
                counts = counts.groupBy("term", "doc_id").agg(F.sum("tf").alias("tf"))
            total = lambda kind, key, cols: s.rows(kind, full).groupBy(key).agg(*(F.sum(c).alias(c) for c in cols))
            name = _write(s, {"counts": counts, "terms": total("terms", "term", ["df"]), "docs": total("docs", "doc_id", ["n"]),
                              "sums": total("sums", "doc_id", SUMS)})
            parts = tuple(p for p in s.parts if p[0] not in full) + ((name, level + 1),)
            s = Segments(s.spark, s.path, s.version, s.options, parts, s.n_docs, s.again, s.id_type)
        level += 1
    return s
