"""Near-copy components of SimHash fingerprints by the generalised pigeonhole principle.

A fingerprint has a bit set where over half the XXH64 hashes (seed 42) of a text's
``k``-word shingles have it, repeats counted. Documents whose fingerprints differ
in at most ``distance`` bits link; the result is each document's component.

1. Equal fingerprints are one class with its smallest id; from here on only classes go on.
2. Layout. Bits are put into partitions by their correlation over all classes, so that
   skewed and dependent bits share one. If partition i may differ in t_i bits and the sum of
   t_i + 1 is ``distance`` + 1, two fingerprints within the distance agree so far in some
   partition; t_i = -1 leaves a partition out. The thresholds come from dynamic programming
   over estimated costs: rows sent, and candidates from the exact number of classes with
   equal values (all classes counted) carried on to t_i bits by the bits' frequencies.
   Layouts of different numbers of partitions are compared by the same cost.
3. Probes. Every class is indexed under its value of each partition and sent to the
   values that differ by up to t_i bits, from the smaller value to the larger only.
4. Verification. Rows with one value meet; values with more than ``part_rows`` rows are cut
   into parts, each pair of parts a task. A task compares whole fingerprints and returns
   a spanning forest of its links, never a list of pairs. Components of the forests follow.

Defined cases: null and empty texts, and texts without words, have fingerprint 0, which
links like any other; texts of fewer than ``k`` words have one shingle, their words; null ids
are never a component's smallest id, a component of null ids only has a null one; repeated
rows and ids are all kept; carried columns keep their names, new ones get free names.
"""

from __future__ import annotations

import math
import re
import sys
from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docrank.llm import arrays
from docrank.llm.graph import components
from docrank.llm.tables import fresh, saved
from docrank.operators.util import fits, maybe_broadcast, split_join

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The seed, and words as runs of bytes other than the space and 0x09 to 0x0D.
SEED = 42
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SPACE = re.compile(rb"[\x20\x09-\x0D]")
STEP_BYTES = 1 << 20  # text cut into words at a time
PAIRS = 1 << 20  # fingerprints compared at a time
LAYOUTS = (2, 3, 4, 5)  # numbers of partitions compared
PAIR_COST = 0.02  # a comparison, in rows sent


def fingerprint(raw: bytes, k: int) -> int:
    """Fingerprint of a text with A-Z lower-cased; long texts a bounded piece at a time."""
    ones, n, tail, at = np.zeros(64, np.int64), 0, [], 0

    def add(shingles: list[bytes]) -> None:
        h = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64, len(shingles))
        np.add(ones, np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64), out=ones)

    while at < len(raw):
        cut = SPACE.search(raw, min(at + STEP_BYTES, len(raw)))
        end = cut.start() if cut else len(raw)
        words = tail + WORD.findall(raw, at, end)
        if len(words) >= k:
            whole, ends = b" ".join(words), list(accumulate(len(w) + 1 for w in words))
            add([whole[a: b - 1] for a, b in zip([0, *ends], ends[k - 1:])])
            n += len(words) - k + 1
        tail, at = words[max(0, len(words) - k + 1):], cut.end() if cut else len(raw)
    if not n and tail:
        add([b" ".join(tail)])
        n = 1
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def _described(docs: DataFrame, text_col: str, k: int, columns: list[str]) -> tuple[DataFrame, str]:
    """``columns`` of ``docs`` with the fingerprint as a long, and its name."""
    text, name = fresh(docs, "text_"), fresh(docs, "print_")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in arrays.slices(whole, text):
                data, at = arrays.text_buffer(batch.column(text))
                raw = data.tobytes().lower()
                prints = np.fromiter((fingerprint(raw[a:b], k) for a, b in zip(at.tolist(), at[1:].tolist())), np.uint64, batch.num_rows)
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(prints.view(np.int64))], [*columns, name])

    schema = T.StructType([*docs.select(*columns).schema.fields, T.StructField(name, T.LongType())])
    return docs.select(*columns, F.col(text_col).cast("string").alias(text)).mapInArrow(run, schema), name


def bits_of(prints: np.ndarray) -> np.ndarray:
    """A row of 64 zeros and ones for each fingerprint."""
    return np.unpackbits(np.ascontiguousarray(prints).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _bit_counts(classes: DataFrame) -> np.ndarray:
    """How many classes have bits i and j set, for all i and j."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((64, 64))
        for batch in batches:
            own = bits_of(np.asarray(batch.column("print"), np.int64)).astype(np.float64)
            total += own.T @ own
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(64 * 64)), pa.array(total.ravel().astype(np.int64))], ["at", "n"])

    out = np.zeros(64 * 64, np.int64)
    for r in classes.select("print").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        out[r["at"]] = r["n"]
    return out.reshape(64, 64)


def partitions(both: np.ndarray, n: int, m: int) -> list[list[int]]:
    """The 64 bits in ``m`` groups of like size: correlated bits together, skewed ones too."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(np.outer(p * (1 - p), p * (1 - p)), 1e-12))
    skew = np.abs(2 * p - 1)
    like = np.maximum(np.abs(both / max(n, 1) - np.outer(p, p)) / spread, np.minimum.outer(skew, skew))
    left, out = list(range(64)), []
    for i in range(m):
        group = [max(left, key=lambda b: (like[b, left].sum(), -b))]
        left.remove(group[0])
        while len(group) < 64 // m + (i < 64 % m):
            group.append(max(left, key=lambda b: (like[b, group].mean(), -b)))
            left.remove(group[-1])
        out.append(sorted(group))
    return out


def values(prints: np.ndarray, bits: list[int]) -> np.ndarray:
    """The given bits of each fingerprint as one number."""
    p, out = prints.view(np.uint64), np.zeros(len(prints), np.uint64)
    for place, bit in enumerate(bits):
        out |= (p >> np.uint64(bit) & np.uint64(1)) << np.uint64(place)
    return out


def _equal_pairs(classes: DataFrame, layouts: list[list[list[int]]]) -> dict[tuple[int, int], int]:
    """Ordered pairs of classes with equal values, for each (layout, partition); all classes count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.asarray(batch.column("print"), np.int64)
            for a, groups in enumerate(layouts):
                for b, bits in enumerate(groups):
                    v, n = np.unique(values(prints, bits).view(np.int64), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), a)), pa.array(np.full(len(v), b)), pa.array(v), pa.array(n)],
                                                     ["layout", "part", "value", "n"])

    rows = classes.select("print").mapInArrow(run, "layout long, part long, value long, n long")
    same = rows.groupBy("layout", "part", "value").agg(F.sum("n").alias("n"))
    return {(r[0], r[1]): int(r[2]) for r in same.groupBy("layout", "part").agg(F.sum(F.col("n").cast("decimal(38,0)") * F.col("n"))).collect()}


def within(q: np.ndarray, most: int) -> np.ndarray:
    """Chance that at most 0, 1, ... ``most`` bits differ, for independent bits that differ with chances ``q``."""
    p = np.zeros(most + 2)
    p[0] = 1
    for x in q:
        p = p * (1 - x) + np.r_[0, p[:-1]] * x
    return np.cumsum(p)[: most + 1]


def thresholds(cost: list[list[float]], distance: int) -> tuple[float, list[int]]:
    """Least total cost and the partitions' thresholds; ``cost[i][t]`` is that of threshold t (-1: nothing)."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for own in cost:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (total, chosen) in best.items():
            for t in range(-1, min(len(own), distance + 1 - used)):
                new = (total + (own[t] if t >= 0 else 0.0), [*chosen, t])
                if used + t + 1 not in step or new < step[used + t + 1]:
                    step[used + t + 1] = new
        best = step
    return best[distance + 1]


def layout(classes: DataFrame, n: int, distance: int) -> list[tuple[list[int], int]]:
    """Partitions (bits, threshold) of the cheapest layout; those with threshold -1 are left out."""
    both = _bit_counts(classes)
    layouts = [partitions(both, n, m) for m in LAYOUTS]
    equal = _equal_pairs(classes, layouts)
    p = np.diag(both) / max(n, 1)
    options = []
    for a, groups in enumerate(layouts):
        cost = []
        for b, bits in enumerate(groups):
            near = within(2 * p[bits] * (1 - p[bits]), min(distance, len(bits)))
            sent = np.cumsum([1, *(math.comb(len(bits), d) / 2 for d in range(1, len(near)))])
            found = np.minimum(equal.get((a, b), 0) * near / max(near[0], 1e-300), float(n) * n) / 2
            cost.append([float(n * s + PAIR_COST * c) for s, c in zip(sent, found)])
        options.append((*thresholds(cost, distance), groups))
    _, chosen, groups = min(options, key=lambda o: o[0])
    return [(bits, t) for bits, t in zip(groups, chosen) if t >= 0]


def _probes(classes: DataFrame, scheme: list[tuple[list[int], int]]) -> DataFrame:
    """(value, print, probe): every class under its own values, and under the larger ones in reach as a probe."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 4096):
                prints = np.asarray(whole.column("print").slice(lo, 4096), np.int64)
                for i, (bits, t) in enumerate(scheme):
                    own = values(prints, bits)
                    salt = np.uint64(i + 1) * arrays.ODD
                    yield _rows(arrays.mix(own + salt), prints, False)
                    for d in range(1, t + 1):
                        for flips in combinations(range(len(bits)), d):
                            mask = np.uint64(sum(1 << f for f in flips))
                            up = own >> np.uint64(flips[-1]) & np.uint64(1) == 0
                            yield _rows(arrays.mix((own[up] ^ mask) + salt), prints[up], True)

    return classes.select("print").mapInArrow(run, "value long, print long, probe boolean")


def _rows(value: np.ndarray, prints: np.ndarray, probe: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(prints), pa.array(np.full(len(prints), probe))],
                                      ["value", "print", "probe"])


def _verify(distance: int):
    """Spanning forest of the links in a task: rows with one value, a probe only against indexed ones."""

    def run(table: pa.Table) -> pa.Table:
        value, prints = np.asarray(table["value"], np.int64), np.asarray(table["print"], np.int64).view(np.uint64)
        probe, part = np.asarray(table["probe"], bool), np.asarray(table["part"], np.int64)
        across = table["one"][0].as_py() != table["two"][0].as_py()
        order = np.lexsort((probe, value))
        value, prints, probe, part = value[order], prints[order], probe[order], part[order]
        first = np.flatnonzero(np.r_[True, value[1:] != value[:-1]])
        of = np.cumsum(np.r_[False, value[1:] != value[:-1]])
        indexed = first + np.bincount(of, weights=~probe, minlength=len(first)).astype(np.int64)
        begin = np.where(probe, first[of], np.arange(len(value)) + 1)
        size = np.maximum(indexed[of] - begin, 0)
        us, vs = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        chunk = (np.cumsum(size) - 1) // PAIRS
        for rows in np.split(np.arange(len(size)), np.flatnonzero(np.diff(chunk)) + 1):
            a, b = np.repeat(rows, size[rows]), arrays.ranges(begin[rows], size[rows])
            near = np.bitwise_count(prints[a] ^ prints[b]) <= distance
            if across:  # two parts of one value: each part has a task of its own
                near &= part[a] != part[b]
            a, b = prints[a[near]], prints[b[near]]
            us, vs = arrays.forest(np.r_[us, a], np.r_[vs, b])
        return pa.table({"u": us.view(np.int64), "v": vs.view(np.int64)})

    return run


def links(classes: DataFrame, n: int, distance: int, part_rows: int, bin_rows: int) -> DataFrame:
    """(u, v): links of fingerprints whose components are those of all pairs within ``distance``."""
    rows = saved(_probes(classes, layout(classes, n, distance)), "probes")
    sizes = rows.groupBy("value").agg(F.count("*").alias("n")).where(F.col("n") > part_rows)
    heavy = saved(sizes.select("value", F.ceil(F.col("n") / part_rows).cast("int").alias("parts")), "heavy")
    bins = max(1, math.ceil(rows.count() / bin_rows))
    parts = F.coalesce("parts", F.lit(1))
    dealt = rows.join(maybe_broadcast(heavy, fits(heavy)), "value", "left").withColumns(
        {"parts": parts, "part": F.pmod(F.xxhash64("print"), parts).cast("int")})
    tiled = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "value", "print", "probe", "part", F.least("part", "other").alias("one"), F.greatest("part", "other").alias("two"),
        F.when(F.col("parts") > 1, F.col("value")).otherwise(F.pmod("value", F.lit(bins))).alias("bin"), (F.col("parts") > 1).alias("wide"))
    return saved(tiled.groupBy("bin", "wide", "one", "two").applyInArrow(_verify(distance), "u long, v long"), "links")


def near_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, distance: int = 4,
                      columns: list[str] | None = None, part_rows: int = 8192, bin_rows: int = 1 << 18) -> tuple[DataFrame, dict[str, str]]:
    """``columns`` (all by default) of ``docs`` with fingerprint (16 hex digits) and component (its smallest id), and the names these got."""
    if not 0 <= distance <= 16 or k < 1:
        raise ValueError("distance is 0 to 16; k is 1 or more")
    columns = list(docs.columns if columns is None else columns)
    if id_col not in columns:
        raise ValueError("columns must hold the id")
    described, name = _described(docs, text_col, k, columns)
    known = saved(described, "prints")
    names = {c: fresh(known, c) for c in ("fingerprint", "component")}
    classes = saved(known.groupBy(F.col(name).alias("print")).agg(F.min(id_col).alias("least"), F.count("*").alias("n")), "classes")

    of = components(links(classes, classes.count(), distance, part_rows, bin_rows))
    inside = saved(classes.join(of, F.col("print") == F.col("node")).select("print", "least", F.col("component").alias("root")), "inside")
    lowest = inside.groupBy("root").agg(F.min("least").alias("lowest"))
    found = split_join(inside, lowest, inside.groupBy("root").agg(F.count("*").alias("n")), "root", "n", "print").select("print", "lowest")
    linked = fresh(known, "lowest_")
    table = saved(classes.join(found, "print", "left").select(
        F.col("print").alias(name), F.when(F.col("lowest").isNull(), F.col("least")).otherwise(F.col("lowest")).alias(linked)), "of-print")
    row = fresh(known, "row_")
    joined = split_join(known.withColumn(row, F.monotonically_increasing_id()), table, classes.select(F.col("print").alias(name), "n"), name, "n", row)
    return joined.select(*columns, F.lpad(F.lower(F.hex(name)), 16, "0").alias(names["fingerprint"]), F.col(linked).alias(names["component"])), names
