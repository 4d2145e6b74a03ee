"""Quality by perplexity under an interpolated modified Kneser-Ney n-gram model.

The model's symbols are bytes, its order is 4. It is trained on trusted text:
documents labelled good. N-grams are counted in the map tasks and summed by
n-gram over the cluster; continuation counts, context totals and the counts of
counts that give the three discounts of each order are aggregations of those
tables. Probabilities come from joins on n-gram and context, sharded by their
hash: every task asks for the distinct n-grams of its documents, each asked
n-gram is joined once with the count tables of all orders, and the answers go
to the block of documents that asked. A document's perplexity is
exp(-mean log probability of its n-grams). It is kept unless its perplexity is
above its language's threshold, a quantile of the trusted documents' values.

Blocks are ranges of ids cut at quantiles, so that documents stored together
ask together; texts are shuffled once, to their block. Trusted ids reach the
texts by a broadcast only while their number is at most ``broadcast_ids``
(8 bytes each), by a join beyond.

Defined cases: null and short texts (under 4 bytes) have no n-grams, a null
perplexity, and are kept; without trusted text all documents are kept; a null
language is one of its own; a language without trusted documents has the
threshold of all; labels that are null or without a document are ignored, a
document with several counts as trusted if its lowest is good; equal rows are
judged equally; all columns are kept, new ones get free names.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docrank.llm import arrays
from docrank.llm.tables import fresh, saved

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ORDER = 4


def grams(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram as a number, text) of every place where ``ORDER`` bytes of a text begin."""
    n = len(data) - ORDER + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    value = np.zeros(n, np.int64)
    for j in range(ORDER):
        value = (value << 8) | data[j: n + j]
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    inside = text[:n] == text[ORDER - 1:]
    return value[inside], text[:n][inside]


def count_grams(texts: DataFrame) -> DataFrame:
    """(gram, c) over a table with a text column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for whole in batches:
            for batch in arrays.slices(whole, "text"):
                g, c = np.unique(grams(*arrays.text_buffer(batch.column("text")))[0], return_counts=True)
                if total:  # sums of a whole partition; as many rows as it has different n-grams
                    g = np.concatenate([total["g"], g])
                    c = np.concatenate([total["c"], c])
                    g, place = np.unique(g, return_inverse=True)
                    c = np.bincount(place, weights=c).astype(np.int64)
                total = {"g": g, "c": c}
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(total["g"], pa.int64()), pa.array(total["c"], pa.int64())], ["gram", "c"])

    return texts.select("text").mapInArrow(run, "gram long, c long").groupBy("gram").agg(F.sum("c").alias("c"))


class Model:
    """Count tables of all orders: ``grams[n]`` (gram, c) and ``contexts[n]`` (context, total, back), and discounts."""

    def __init__(self, counts: DataFrame):
        self.grams: dict[int, DataFrame] = {}
        self.contexts: dict[int, DataFrame] = {}
        self.discounts: dict[int, list[float]] = {}
        table = saved(counts, "ngrams")
        for n in range(ORDER, 0, -1):
            self.grams[n] = table
            seen = {r["k"]: r["rows"] for r in table.where("c <= 4").groupBy(F.col("c").alias("k")).agg(F.count("*").alias("rows")).collect()}
            d = self.discounts[n] = discounts([seen.get(k, 0) for k in (1, 2, 3, 4)])
            back = sum((F.sum((F.col("c") == k).cast("long") if k < 3 else (F.col("c") >= 3).cast("long")) * d[k - 1] for k in (1, 2, 3)), F.lit(0.0))
            self.contexts[n] = table.groupBy(F.shiftright("gram", 8).alias("context")).agg(
                F.sum("c").alias("total"), back.alias("back"))
            if n > 1:  # an n-gram's lower-order count: how many different bytes come before it
                table = saved(table.groupBy(F.col("gram").bitwiseAND((1 << 8 * (n - 1)) - 1).alias("gram")).agg(
                    F.count("*").alias("c")), "ngrams")

    def log_probabilities(self, asked: DataFrame) -> DataFrame:
        """(gram, logp) for each distinct ``gram`` asked."""
        out, p = asked.select("gram"), F.lit(1.0 / 256)
        for n in range(1, ORDER + 1):
            d = self.discounts[n]
            c, total, back = f"c{n}", f"total{n}", f"back{n}"
            part = F.col("gram").bitwiseAND((1 << 8 * n) - 1) if n < ORDER else F.col("gram")
            out = out.withColumn("part", part).join(self.grams[n].select(F.col("gram").alias("part"), F.col("c").alias(c)), "part", "left")
            out = out.withColumn("context", F.shiftright("part", 8)).join(self.contexts[n].select(
                "context", F.col("total").alias(total), F.col("back").alias(back)), "context", "left").drop("part", "context")
            cut = F.when(F.col(c) == 1, d[0]).when(F.col(c) == 2, d[1]).when(F.col(c) >= 3, d[2]).otherwise(0.0)
            own = F.coalesce(F.col(c) - cut, F.lit(0.0))
            p = F.when(F.col(total).isNull(), p).otherwise((own + F.col(back) * p) / F.col(total))
            out = out.withColumn(f"p{n}", p).drop(c, total, back)
            p = F.col(f"p{n}")
        return out.select("gram", F.log(f"p{ORDER}").alias("logp"))


def discounts(n: list[int]) -> list[float]:
    """The discounts for counts 1, 2 and 3 or more, from the numbers of n-grams with counts 1 to 4."""
    n1, n2, n3, n4 = n
    if not n1 or not n2:
        return [0.5, 0.75, 0.9]
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.0]
    return [min(max(x, 0.01), k - 0.01) for k, x in enumerate(d, 1)]


def train(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          broadcast_ids: int = 4_000_000) -> Model:
    """Model of the texts whose id is in ``trusted`` (column doc_id)."""
    ids = trusted.select(F.col("doc_id").cast("long").alias("_id")).where("_id IS NOT NULL").distinct()
    ids = F.broadcast(ids) if ids.count() <= broadcast_ids else ids.hint("shuffle_merge")
    texts = docs.join(ids, F.col(id_col).cast("long") == F.col("_id"), "left_semi")
    return Model(count_grams(texts.select(F.col(text_col).cast("string").alias("text"))))


def perplexity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
               block_bytes: int = 16 << 20, columns: list[str] | None = None) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with n_grams and perplexity, and the names these got. ``columns``: those of ``docs`` to keep (default: all)."""
    names = {k: fresh(docs, k) for k in ("n_grams", "perplexity")}
    columns = docs.columns if columns is None else columns
    block, packed = fresh(docs, "block"), fresh(docs, "packed")
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    cuts = docs.agg(F.percentile_approx(F.col(id_col).cast("long"), [i / blocks for i in range(1, blocks)], 10 * blocks)
                    ).first()[0] if blocks > 1 else []
    cuts = np.unique(np.array(cuts or [], np.int64))

    def block_of(ids: pa.Array) -> np.ndarray:
        return np.searchsorted(cuts, np.asarray(pc.fill_null(ids.cast(pa.int64()), 0)), side="right").astype(np.int32)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in arrays.slices(whole, "text"):
                g, text = grams(*arrays.text_buffer(batch.column("text")))
                of = block_of(batch.column("id")).astype(np.int64)[text]
                both = np.unique((of << 32) | g)
                yield pa.RecordBatch.from_arrays([pa.array((both >> 32).astype(np.int32)), pa.array(both & 0xFFFFFFFF)], ["block", "gram"])

    # Texts travel compressed to their block.
    sent = StructType([*(docs.schema[c] for c in columns if c != text_col)]).add(block, "integer").add(packed, "binary")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            text = [None if t is None else squeeze.compress(t.encode()) for t in batch.column(text_col).to_pylist()]
            own = [c for c in columns if c != text_col]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), pa.array(block_of(batch.column(id_col))), pa.array(text, pa.binary())],
                                             [*own, block, packed])

    asked = saved(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        ask, "block int, gram long").distinct(), "asked")
    answers = asked.join(model.log_probabilities(asked.select("gram").distinct()), "gram").select(F.col("block").alias(block), "gram", "logp")
    schema = StructType([docs.schema[c] for c in columns]).add(names["n_grams"], "long").add(names["perplexity"], "double")

    def score(rows: pa.Table, known: pa.Table) -> pa.Table:
        known = known.sort_by("gram")
        table, logp = np.asarray(known["gram"]), np.asarray(known["logp"])
        unpack = zstandard.ZstdDecompressor()
        count, mean, texts = [np.zeros(0, np.int64)], [np.zeros(0)], []
        for whole in rows.to_batches(max_chunksize=1000):
            text = pa.array([None if z is None else unpack.decompress(z).decode() for z in whole.column(packed).to_pylist()], pa.string())
            for batch in arrays.slices(pa.RecordBatch.from_arrays([text], ["text"]), "text"):
                g, of = grams(*arrays.text_buffer(batch.column("text")))
                n = np.bincount(of, minlength=batch.num_rows)
                s = np.bincount(of, weights=logp[np.searchsorted(table, g)] if len(g) else None, minlength=batch.num_rows)
                count.append(n)
                mean.append(np.exp(-s / np.maximum(n, 1)))
            texts.append(text)
        count, mean = np.concatenate(count), np.concatenate(mean)
        own = [pa.chunked_array(texts, pa.string()) if c == text_col else rows[c] for c in columns]
        return pa.table([*own, pa.array(count), pa.array(mean, mask=count == 0)], [*columns, *names.values()])

    return docs.mapInArrow(send, sent).groupBy(block).cogroup(answers.groupBy(block)).applyInArrow(score, schema), names


def quality_filter(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   lang_col: str = "lang", quantile: float = 0.99, block_bytes: int = 16 << 20,
                   broadcast_ids: int = 4_000_000, columns: list[str] | None = None) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with n_grams, perplexity, threshold and keep, and the names these got.

    ``columns``: those of ``docs`` to keep (default: all); they are written once with the scores, so leaving the
    text out saves as much disk as it takes. ``id_col`` and ``lang_col`` must be among them.

    ``labels``: doc_id and quality (1: good). Thresholds: the ``quantile`` of each language's trusted documents.
    """
    trusted = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min("quality").alias("quality")).where("quality >= 1").select("doc_id")
    scored, names = perplexity(docs, train(docs, trusted, id_col, text_col, broadcast_ids), id_col, text_col, block_bytes, columns)
    scored = saved(scored, "perplexity")
    names = names | {k: fresh(docs, k) for k in ("threshold", "keep")}
    value = F.col(names["perplexity"])
    marks = scored.join(trusted.withColumnRenamed("doc_id", "_id"), F.col(id_col).cast("long") == F.col("_id"), "left_semi")
    limit = F.percentile_approx(value, quantile, 10_000)
    whole = marks.agg(limit.alias("t")).first()["t"]
    # A row for each language, of which there are a few hundred at most.
    limits = marks.groupBy(F.col(lang_col).alias("_lang")).agg(limit.alias("_limit"))
    found: Column = F.coalesce("_limit", F.lit(whole).cast("double"))
    return scored.join(limits, F.col(lang_col).eqNullSafe(F.col("_lang")), "left").withColumn(names["threshold"], found).withColumn(
        names["keep"], F.coalesce(value <= F.col(names["threshold"]), F.lit(True))).drop("_lang", "_limit"), names
