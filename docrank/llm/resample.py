"""Importance resampling of documents towards a target distribution of hashed word n-grams.

Texts are turned into n-grams by Arrow kernels: ``ascii_lower``,
``split_pattern_regex``, ``list_flatten`` and ``dictionary_encode`` give word
indices; n-grams are distinct tuples of shifted indices, the CRC-32 of each
distinct one is taken once a slice and names its bucket.

1. Bucket counts of the corpus and of the target: one row of counts a task and
   bucket, summed. There are at most ``buckets`` of them, so they fit the driver.
2. A bucket's gain is floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))) for t of T
   target and s of S corpus features and B buckets. A document's weight is the
   floored mean of the gains of its features, taken by bucket and summed by segment.
3. Gumbel noise from a hash of the id turns weights into scores, so that the
   highest scores are a draw without replacement in proportion to exp(weight / 1000).
4. Ranks. A score is a whole number within some 10^5 of 0, so the counts by score
   are bounded and give the score of the last draw. Only documents from that
   score on are range-partitioned, sorted and numbered across partitions.

Defined cases: null and empty texts, and texts without words, have no features
and weight 0; a null id is hashed as empty text and comes before others in ties;
rows with equal score and id are drawn by fewer features first, else in any order;
an empty corpus gives no rows, an empty target counts 0 in every bucket; carried
columns keep their names, new ones get free names.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docrank.llm import arrays
from docrank.llm.tables import fresh, saved

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# What separates words once A-Z are lower-cased, and the prefix of the hashed id.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NOISE_PREFIX = "2024:"


def word_codes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(code, text, words): the word ``words[code[i]]`` at each place, and the number of its text."""
    parts = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(column, "")), SEPARATORS)
    flat, text = pc.list_flatten(parts), pc.list_parent_indices(parts)
    real = pc.not_equal(flat, "")  # a separator at either end leaves an empty word
    encoded = flat.filter(real).dictionary_encode()
    words = encoded.dictionary.cast(pa.binary()).to_pylist()
    return np.asarray(encoded.indices, np.int64), np.asarray(text.filter(real), np.int64), words


def features(column: pa.Array, n: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, text, words): bucket and text number of each run of 1 to ``n`` words, and the words of each text."""
    code, text, words = word_codes(column)
    crc = np.fromiter((zlib.crc32(w) for w in words), np.int64, len(words))
    out, owner, gram = [crc[code] % buckets], [text], code
    for k in range(1, min(n, len(text))):
        whole = text[: len(text) - k] == text[k:]
        first, last = gram[: len(text) - k][whole], code[k:][whole]
        pairs, gram_of = np.unique(first * len(words) + last, return_inverse=True)
        crc = np.fromiter((zlib.crc32(b" " + words[p % len(words)], int(crc[p // len(words)])) for p in pairs.tolist()), np.int64, len(pairs))
        out.append(crc[gram_of] % buckets)
        owner.append(text[: len(text) - k][whole])
        gram = np.zeros(len(text) - k, np.int64)
        gram[whole] = gram_of
    return np.concatenate(out), np.concatenate(owner), np.bincount(text, minlength=len(column))


def bucket_counts(docs: DataFrame, text_col: str, n: int, buckets: int) -> np.ndarray:
    """Features of all texts in each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for whole in batches:
            for batch in arrays.slices(whole, "text"):
                total += np.bincount(features(batch.column("text"), n, buckets)[0], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    rows = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(count, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most ``buckets`` rows
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket, in thousandths."""
    s, t = corpus.astype(np.float64), target.astype(np.float64)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + len(s)) / ((s + 1) * (t.sum() + len(t))))).astype(np.int64)


def noise(id_col: str) -> Column:
    """floor(1000 g) for a Gumbel variate g from the first 32 bits of a hash of the id."""
    text = F.concat(F.lit(NOISE_PREFIX), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, gain: np.ndarray, n: int, text_col: str, columns: list[str]) -> tuple[DataFrame, dict[str, str]]:
    """``columns`` of ``docs`` with n_words, n_features and weight, and the names these got."""
    text = fresh(docs, "text_")
    kept = docs.select(*columns)
    names = {c: fresh(kept, c) for c in ("n_words", "n_features", "weight")}
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for whole in batches:
            for batch in arrays.slices(whole, text):
                rows = batch.num_rows
                bucket, owner, n_words = features(batch.column(text), n, len(gain))
                count = np.bincount(owner, minlength=rows)
                total = np.zeros(rows, np.int64)
                by = np.argsort(owner, kind="stable") if n > 1 else slice(None)
                some = np.flatnonzero(count)
                if len(some):
                    total[some] = np.add.reduceat(gain[bucket[by]], (np.cumsum(count) - count)[some])
                weight = total // np.maximum(count, 1)
                own = [batch.column(c) for c in columns]
                yield pa.RecordBatch.from_arrays([*own, pa.array(n_words), pa.array(count), pa.array(weight)],
                                                 [*columns, *names.values()])

    schema = T.StructType([*kept.schema.fields, *(T.StructField(c, T.LongType()) for c in names.values())])
    return docs.select(*columns, F.col(text_col).cast("string").alias(text)).mapInArrow(run, schema), names


def importance_resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 2,
                        buckets: int = 10_000, percent: int = 10, least_words: int = 20,
                        columns: list[str] | None = None) -> tuple[DataFrame, dict[str, str]]:
    """``columns`` (all by default) of ``docs`` with n_words, n_features, weight, score and rank, and the names these got.

    ``rank`` numbers the drawn documents, the highest scores of those with ``least_words`` words or more; it is
    null for the others. ``target`` needs the column ``text_col``; features are runs of 1 to ``n`` words."""
    if not 0 <= percent <= 100 or n < 1 or buckets < 1:
        raise ValueError("percent is 0 to 100; n and buckets are 1 or more")
    columns = list(docs.columns if columns is None else columns)
    if id_col not in columns:
        raise ValueError("columns must hold the id")
    gain = gains(bucket_counts(docs, text_col, n, buckets), bucket_counts(target, text_col, n, buckets))
    weighed, names = weigh(docs, gain, n, text_col, columns)
    names |= {c: fresh(weighed, c) for c in ("score", "rank")}
    score, rank, words = names["score"], names["rank"], names["n_words"]
    scored = saved(weighed.withColumn(score, F.col(names["weight"]) + noise(id_col)), "scores")

    # One row a score: a bounded number, whatever the corpus.
    able = F.col(words) >= least_words
    counts = sorted(((r[0], r[1]) for r in scored.where(able).groupBy(score).agg(F.count("*").alias("n")).collect()), reverse=True)
    most = percent * sum(c for _, c in counts) // 100
    last, above = None, 0
    for value, count in counts:
        if above >= most:
            break
        last, above = value, above + count
    none = F.lit(None).cast("long").alias(rank)
    if last is None:
        return scored.select("*", none), names

    reach = able & (F.col(score) >= last)
    row, place = fresh(scored, "row"), fresh(scored, "place")
    order = [F.col(score).desc(), F.col(id_col).asc_nulls_first(), F.col(names["n_features"]).asc(), F.col(row).asc()]
    ranged = scored.where(reach).withColumn(row, F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = saved(ranged.drop(row).withColumn(place, F.monotonically_increasing_id()), "draws")
    part = F.shiftright(place, 33)
    before, offsets = 0, []
    for r in sorted(placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()):  # one row a partition
        offsets.append((r["part"], before))
        before += r["n"]
    at, skip = fresh(placed, "at"), fresh(placed, "skip")
    offset = docs.sparkSession.createDataFrame(offsets, f"{at} long, {skip} long")
    number = F.col(skip) + F.col(place).bitwiseAND((1 << 33) - 1) + 1
    drawn = placed.join(F.broadcast(offset), part == F.col(at)).withColumn(rank, F.when(number <= most, number))
    rest = scored.where(~reach).select("*", none)
    return drawn.select(*rest.columns).unionByName(rest), names
