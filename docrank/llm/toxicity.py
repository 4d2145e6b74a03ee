"""Toxicity by compression distance.

Two zstandard dictionaries share the prose of a few hundred ordinary documents;
the toxic one also has the words that mark toxic documents, the other digits in
their place, so neither is trained on whole toxic texts. The words are chosen one by one
for the character n-grams in them that occur in toxic rather than ordinary
documents and that no chosen word has, until all such n-grams are covered or the
words fill ``ROOM`` bytes. Near copies count as one document there. A window of text that holds a toxic
word, or an unseen word on the same stem, is shorter under the toxic dictionary;
other windows come out alike, because the prose and the distances to it are the
same in both. A document's features
are drawn from the length differences of all its windows (largest, sum of the
three largest, mean, share over a threshold, number of windows); a logistic
regression on the training sample calibrates them to a probability.

Training sample: of the labelled rows that are not held out, about ``samples`` of
each class, chosen by hash, each with at most ``most`` characters from a
hashed place. It is written once; n-gram and word counts are Spark
aggregations over it, of which the significant n-grams and one word for each set
of them come to the driver, as do the sample's MinHash bands and features. Scoring is one narrow pass over whole
texts.

Defined cases: null and empty texts, and texts without letters, have no
windows and get the calibrated score of features 0; labels that are null or
without a document are ignored, of several labels of a document the highest
counts; with one class only, every score is that class's share; equal texts
get equal scores; all columns are kept, new ones get free names.
"""

from __future__ import annotations

import heapq
import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docrank.llm import zdict
from docrank.llm.tables import fresh, hashed_sample, saved

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 120
GRAM = 5
PARAMETERS = dict(window_log=17, hash_log=16, chain_log=16, search_log=6, min_match=4, strategy=zstandard.STRATEGY_LAZY2)
SURE = 9.0
BANDS = 8
MIX = np.random.default_rng(7).integers(1, 1 << 63, 2 * BANDS, dtype=np.uint64) | np.uint64(1)
ROOM = 48 << 10  # bytes of class words in the toxic dictionary
FLOOR = 2  # bytes that a window must gain to count as marked


@dataclass
class Model:
    toxic: bytes
    ordinary: bytes
    weights: np.ndarray  # of the standardised features, then the intercept
    mean: np.ndarray
    scale: np.ndarray

    def score(self, features: np.ndarray) -> np.ndarray:
        # Row by row: a matrix product may round equal rows differently.
        z = ((features - self.mean) / self.scale * self.weights[:-1]).sum(axis=1) + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Meter:
    """Features of a text under the two dictionaries."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.toxic, self.ordinary = zdict.primed(toxic, **PARAMETERS), zdict.primed(ordinary, **PARAMETERS)

    def features(self, text: str | None) -> list[float]:
        data = zdict.letters(text) if text else ""
        if not data:
            return [0.0] * 5
        gains = np.array([len(self.ordinary.compress(w)) - len(self.toxic.compress(w))
                          for w in zdict.windows(b" " + data.encode() + b" ", WINDOW)], float)
        top = np.sort(gains)[::-1]
        return [max(top[0], 0.0), max(top[:3].sum(), 0.0), gains.mean(), (gains >= FLOOR).mean(), np.log1p(len(gains))]


def grams(word: str) -> set[str]:
    padded = f" {word} "
    return {padded[i: i + GRAM] for i in range(len(padded) - GRAM + 1)}


def training_sample(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str, text_col: str, samples: int,
                    most: int) -> tuple[DataFrame, dict[int, int]]:
    """(text, toxic) of the sample, written once, and the labelled rows of each class."""
    marks = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & usable).groupBy("doc_id").agg(
        F.max(F.col("toxic").cast("int")).alias("toxic"))
    totals = {r["toxic"]: r["n"] for r in marks.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    chosen = hashed_sample(marks, "toxic", [F.xxhash64("doc_id"), F.col("doc_id")], samples).select(
        F.col("doc_id").alias("_id"), "toxic")
    text, n = F.col(text_col), F.length(text_col)
    part = F.substring(text, F.pmod(F.xxhash64(text), F.greatest(n - most, F.lit(0)) + 1).cast("int") + 1, F.lit(most))
    # At most ``samples`` rows for each label value, pairs of a number and a flag: a proven bound for the broadcast.
    rows = docs.join(F.broadcast(chosen), F.col(id_col) == F.col("_id")).where(text.isNotNull()).select(
        part.alias("text"), "toxic")
    return saved(rows.withColumn("row", F.monotonically_increasing_id()), "toxicity"), totals


def bands(text: str) -> list[int]:
    """``BANDS`` hashes of two MinHash values each over three-word shingles: near copies share one, others rarely do."""
    words = zdict.letters(text).split()
    of = np.array([zlib.crc32(" ".join(words[i: i + 3]).encode()) for i in range(max(1, len(words) - 2))], np.uint64)
    value = (of[:, None] + np.uint64(1)) * MIX[None]
    least = ((value ^ (value >> np.uint64(29))) * MIX[::-1][None]).min(axis=0)
    return (least[::2] * MIX[0] + least[1::2]).astype(np.int64).tolist()


def independent(sample: DataFrame) -> tuple[set[int], int, int]:
    """Rows that are the first of their class with each of their bands, and their number in each class.

    The copies of one text would make all its words look significant.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(
                [bands(t) for t in batch.column(3).to_pylist()], pa.list_(pa.int64()))], ["row", "toxic", "print", "bands"])

    # The driver holds ``BANDS`` numbers for each row of the bounded sample.
    rows = sample.select("row", "toxic", F.xxhash64("text").alias("print"), "text").mapInArrow(
        run, "row long, toxic int, print long, bands array<long>").collect()
    seen: set[tuple[bool, int, int]] = set()
    out: tuple[set[int], set[int]] = (set(), set())
    for r in sorted(rows, key=lambda r: (r["print"], r["row"])):
        keys = {(r["toxic"] > 0, i, b) for i, b in enumerate(r["bands"])}
        if seen.isdisjoint(keys):
            out[r["toxic"] > 0].add(r["row"])
        seen |= keys
    return out[0] | out[1], len(out[0]), len(out[1])


def _counts(sample: DataFrame, of, rows: Broadcast) -> DataFrame:
    """(item, n0, n1): documents of each class among ``rows`` that hold each of the items ``of(set of words)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: list[dict[str, int]] = [{}, {}]
        for batch in batches:
            for text, y, row in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if row not in rows.value:
                    continue
                own = count[1 if y else 0]
                for item in of(set(zdict.letters(text).split())):
                    own[item] = own.get(item, 0) + 1
        items = list({*count[0], *count[1]})
        yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), *(pa.array([c.get(i, 0) for i in items], pa.int64()) for c in count)],
                                         ["item", "n0", "n1"])

    return sample.select("text", "toxic", "row").mapInArrow(run, "item string, n0 long, n1 long").groupBy("item").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def choose_words(words: list[str], worth: dict[str, float], room: int = ROOM) -> list[str]:
    """Words in turn, each the one with most worth in grams that no earlier one has, by the square root of its length.

    Ends when no gram of ``worth`` is left that a word has, or the next word does not fit in ``room`` bytes.
    """
    left, of, out = set(worth), {w: sorted(g for g in grams(w) if g in worth) for w in words}, []

    def entry(w: str) -> tuple[float, int]:
        return -sum(worth[g] for g in of[w] if g in left) / len(w) ** 0.5, rank[w]

    # Gains only fall, so an entry that is still right when it comes up is the best.
    order = sorted(of, reverse=True)
    rank = {w: i for i, w in enumerate(order)}
    heap = [entry(w) for w in order]
    heapq.heapify(heap)
    while heap:
        best = order[heap[0][1]]
        now = entry(best)
        if now[0] >= 0:
            heapq.heappop(heap)
        elif now != heap[0]:
            heapq.heapreplace(heap, now)
        else:
            room -= len(best.encode()) + 1
            if room < 0:
                break
            out.append(best)
            left.difference_update(of[best])
            heapq.heappop(heap)
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, steps: int = 60) -> np.ndarray:
    """Newton steps on the weighted log-loss; the last weight is the intercept."""
    a = np.c_[x, np.ones(len(x))]
    w = np.zeros(a.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (weight * (p - y)) + ridge * weight.sum() * np.r_[w[:-1], 0]
        hess = (a * (weight * p * (1 - p))[:, None]).T @ a + ridge * weight.sum() * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text",
          samples: int = 6000, most: int = 8000, prose: int = 48 << 10) -> Model:
    """Dictionaries and calibration from the bounded sample. ``usable``: on ``labels``, rows to learn from."""
    sample, totals = training_sample(docs, labels, usable, id_col, text_col, samples, most)
    n = {r["toxic"]: r["n"] for r in sample.groupBy((F.col("toxic") > 0).cast("int").alias("toxic")).agg(F.count("*").alias("n")).collect()}
    n0, n1 = n.get(0, 0), n.get(1, 0)
    if not n0 or not n1:
        share = 0.0 if not n1 else 1.0
        return Model(b"ordinary", b"ordinary", np.r_[np.zeros(5), 30.0 if share else -30.0], np.zeros(5), np.ones(5))
    rows, n0, n1 = independent(sample)
    counted = docs.sparkSession.sparkContext.broadcast(rows)
    odds = F.log((F.col("n1") + 0.5) / (n1 + 1)) - F.log((F.col("n0") + 0.5) / (n0 + 1))
    # Divergence of the n-gram's class shares from the sample's, times its documents: chance alone rarely passes SURE.
    of, base = F.col("n1") + F.col("n0"), n1 / (n0 + n1)
    sure = F.col("n1") * F.log(F.col("n1") / of / base) + F.when(F.col("n0") > 0, F.col("n0") * F.log(F.col("n0") / of / (1 - base))).otherwise(0.0)
    marked = _counts(sample, lambda ws: {g for w in ws for g in grams(w)}, counted).where(
        (odds > 1.5) & (F.col("n1") >= 3) & (sure > SURE)).withColumn("worth", F.col("n1") * odds)
    worth = {r["item"]: r["worth"] for r in marked.collect()}
    words = _counts(sample, lambda ws: ws, counted)
    shared = docs.sparkSession.sparkContext.broadcast(set(worth))

    def holding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [(w, " ".join(sorted(f"{g!r}" for g in grams(w) if g in shared.value))) for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in held if x[1]], pa.string()) for k in (0, 1)], ["item", "held"])

    # Of words with the same marked n-grams only the shortest can be chosen.
    holders = words.where("n1 > 0").select("item").mapInArrow(holding, "item string, held string").groupBy("held").agg(
        F.max(F.struct(-F.length("item"), "item"))["item"].alias("item"))
    candidates = [r["item"] for r in holders.collect()]
    chosen = choose_words(candidates, worth)
    text = " ".join(zdict.letters(r["text"][:400]) for r in sample.where("toxic = 0").orderBy(F.xxhash64("text"), "text").limit(prose // 200).collect())
    tail = text.encode()[:prose]
    marks = " ".join(reversed(chosen)).encode() + b" "
    # Digits never occur in normal text: they only keep the distances to the prose alike.
    toxic, ordinary = tail + b" " + marks, tail + b" " + (b"0123456789" * (len(marks) // 10 + 1))[: len(marks)]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        meter = Meter(toxic, ordinary)
        for batch in batches:
            got = [meter.features(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(got, pa.list_(pa.float64())), batch.column(1)], ["x", "y"])

    rows = sample.select("text", "toxic").mapInArrow(measure, "x array<double>, y int").collect()
    x, y = np.array([r["x"] for r in rows]), np.array([float(r["y"] > 0) for r in rows])
    whole = {0: sum(v for k, v in totals.items() if k <= 0), 1: sum(v for k, v in totals.items() if k > 0)}
    weight = np.where(y > 0, whole[1] / y.sum(), whole[0] / (len(y) - y.sum()))
    weight /= weight.mean()
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    return Model(toxic, ordinary, fit_logistic((x - mean) / scale, y, weight), mean, scale)


def score_toxicity(docs: DataFrame, model: Model, text_col: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with score, predicted and gain (the largest window difference in bytes), and the names these got."""
    names = {k: fresh(docs, k) for k in ("score", "predicted", "gain")}
    schema = StructType(list(docs.schema.fields)).add(names["score"], "double").add(names["predicted"], "integer").add(names["gain"], "double")
    # Plain values: a worker may lack this package.
    shared = docs.sparkSession.sparkContext.broadcast((model.toxic, model.ordinary, model.weights, model.mean, model.scale))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        meter = Meter(model.toxic, model.ordinary)
        for batch in batches:
            x = np.array([meter.features(t.as_py()) for t in batch.column(text_col)]).reshape(-1, 5)
            score = model.score(x)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(score), pa.array((score >= 0.5).astype(np.int32)), pa.array(x[:, 0])],
                [*batch.schema.names, *names.values()])

    return docs.mapInArrow(run, schema), names
