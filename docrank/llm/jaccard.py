"""Near-copy components by a blocked sparse product of documents and n-grams.

Two documents link when the Jaccard similarity of their sets of ``k``-word
shingles is at least ``percent`` / 100. The result is each document's component
and the number of documents it links with; links are found exactly.

1. Documents with equal sets are one row of the incidence matrix, with a weight.
2. Candidates. Two sets that link share at least t times the larger one's shingles, t
   being the threshold. So a set of which fewer than that are in any other set links with
   nothing, and if shingles are ordered by the number of sets that hold them, the first
   (1 - t) s + 1 of each of the two sets have one in common. The columns of the incidence
   matrix are dealt to shards by a hash; a shard counts each column and returns
   the shared ones to the slices they came from, where the first shingles of each remaining set
   are chosen. They are the rarest ones, so documents that share a passage, but
   not most of their text, don't meet. Sets with a first shingle in common are linked as a star;
   components of these candidate links are the blocks in which all similar documents are together.
   Equal sets of a slice go on once. Shingles that are frequent in some slice are
   not dealt (their columns would make hot shards): they count as shared by the most sets,
   in the order of their hashes, and the slice itself chooses among them.
3. Product. A block is cut into parts of bounded size; each pair of parts is a
   tile, small blocks share tiles. In a tile the matrix product is summed over
   shingle columns: dense products for columns that many documents share, pair
   counts for the rest; pairs whose sizes alone rule the bound out are masked,
   pairs under the bound are dropped. A tile gives a spanning forest of its links
   and counts of links per document, never a list of pairs.
4. Components of the links, then of all documents through their sets.

Defined cases: null or empty texts, and texts without words, have no shingles
and link with nothing; texts of fewer words than ``k`` have one shingle, their
words; rows with the same id and text are one document, rows with one id (or
none) and different texts are different ones, and null ids sort first; all
columns are kept, new ones get free names.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docrank.llm import arrays
from docrank.llm.graph import components
from docrank.llm.tables import fresh, row_keys, saved

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# All bytes but the space and 0x09 to 0x0D are word bytes; A-Z are folded.
WORD_BYTES = np.ones(256, bool)
WORD_BYTES[[0x20, *range(0x09, 0x0E)]] = False
COLUMNS = 2048  # shingles multiplied at a time
PAIRS = 1 << 20  # pair counts summed at a time


def sets(batch: pa.RecordBatch, text: str, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, borders): the sorted distinct shingles of row i are ``hashes[borders[i]:borders[i + 1]]``."""
    h, owner = arrays.shingles(arrays.Words(*arrays.text_buffer(batch.column(text)), WORD_BYTES), k)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return h[new], np.searchsorted(owner[new], np.arange(batch.num_rows + 1))


def set_prints(h: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit hashes of each set, 0 for the empty one."""
    size = np.diff(at)
    out = []
    for seed in (1, 2):
        total = np.r_[np.uint64(0), np.cumsum(arrays.mix(h * np.uint64(2 * seed + 1) + np.uint64(seed)))]
        part = arrays.mix(total[at[1:]] - total[at[:-1]] + size.astype(np.uint64) * arrays.ODD)
        out.append(np.where(size > 0, part, np.uint64(0)).view(np.int64))
    return out


def _describe(docs: DataFrame, k: int) -> DataFrame:
    """(key, n, a, b): set size and set hashes of every row of (key, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in arrays.slices(whole, "text"):
                h, at = sets(batch, "text", k)
                a, b = set_prints(h, at)
                yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(np.diff(at)), pa.array(a), pa.array(b)], ["key", "n", "a", "b"])

    return docs.select("key", "text").mapInArrow(lambda batches: arrays.tidied(run(batches)), "key long, n long, a long, b long")


def _frequent(docs: DataFrame, k: int, most: int, share: int) -> np.ndarray:
    """Up to ``most`` shingles that more than one in ``share`` texts of some slice hold, sorted. They only shape the order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in arrays.slices(whole, "text"):
                h, n = np.unique(sets(batch, "text", k)[0], return_counts=True)
                often = n >= max(6, batch.num_rows // share)
                yield pa.RecordBatch.from_arrays([pa.array(h[often].view(np.int64)), pa.array(n[often])], ["h", "n"])

    rows = docs.select("text").mapInArrow(lambda batches: arrays.tidied(run(batches)), "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).orderBy(
        F.desc("n"), "h").limit(most).collect()
    return np.sort(np.array([r["h"] for r in rows], np.int64).view(np.uint64))


def _stars(print_: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, ...]:
    """Rows of equal prints: (order, first) and links of all but the first key to the first."""
    order = np.lexsort((key, print_))
    s, k = print_[order], key[order]
    first = np.ones(len(order), bool)
    first[1:] = s[1:] != s[:-1]
    head = k[first][np.cumsum(first) - 1] if len(k) else k
    other = head != k
    return order, first, k[other], head[other]


def least_shared(size: np.ndarray, percent: int) -> np.ndarray:
    """How many of its shingles a set shares at least with any that it links with."""
    return -(-percent * size // 100)


def _ranked(row: np.ndarray) -> np.ndarray:
    """The place of each entry among those of its row, rows being in order."""
    return np.arange(len(row)) - np.searchsorted(row, row)


def _numbers(n: np.ndarray) -> bytes:
    return n.astype(np.uint16 if not len(n) or n.max() < 1 << 16 else np.uint32).tobytes()


def _numbered(packed: bytes, size: int) -> np.ndarray:
    return np.frombuffer(packed, np.uint16 if len(packed) == 2 * size else np.uint32).astype(np.int64)


def _batch(rows: list[list], columns: str) -> pa.RecordBatch:
    """Rows as a batch; ``columns`` as Spark writes them, of long and binary."""
    names = [c.split() for c in columns.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64() if kind == "long" else pa.binary()) for i, (_, kind) in enumerate(names)],
                                      [n for n, _ in names])


DEALT = "shard long, slice long, print binary, text binary, key binary, need binary, token binary, owner binary, u binary, v binary"
SHARED = "slice long, shard long, print binary, n binary, text binary, key binary, need binary, token binary, owner binary, u binary, v binary"
TOKENS = "token long, u long, v long"


def _candidates(reps: DataFrame, k: int, percent: int, frequent: np.ndarray, shards: int) -> DataFrame:
    """(u, v): candidate links whose components hold all similar pairs of (key, text).

    A shard gets four bytes of each shingle and the text's number in its slice: shingles that
    happen to agree only add candidates."""
    shared = reps.sparkSession.sparkContext.broadcast(frequent)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often_of = shared.value
        for whole in batches:
            for batch in arrays.slices(whole, "text"):
                keys = np.asarray(batch.column("key"), np.int64)
                h, at = sets(batch, "text", k)
                size = np.diff(at)
                # The first of equal sets.
                prints = np.stack([*set_prints(h, at), keys])
                by = np.lexsort(prints[::-1])
                new = np.r_[True, (prints[:2, by[1:]] != prints[:2, by[:-1]]).any(axis=0)]
                own = np.zeros(len(size), bool)
                own[by[new]] = True
                row = np.repeat(np.arange(len(size)), size)
                h, row = h[own[row]], row[own[row]]
                often = often_of[np.minimum(np.searchsorted(often_of, h), len(often_of) - 1)] == h if len(often_of) else np.zeros(len(h), bool)
                need = least_shared(size, percent) - np.bincount(row[often], minlength=len(size))
                tokens, owner = h[often], row[often]
                first = _ranked(owner) < 1 - need[owner]
                order, heads, u, v = _stars(tokens[first], keys[owner[first]])
                u, v = arrays.forest(u, v)
                tokens, owner = tokens[first][order[heads]], keys[owner[first][order[heads]]]
                h, row = h[~often], row[~often]
                shard = (h % np.uint64(shards)).astype(np.int64)
                by = np.argsort(shard, kind="stable")
                border = np.searchsorted(shard[by], np.arange(shards + 1))
                name, out = int(keys[0]), []
                for i in np.unique(shard).tolist():
                    at_shard = by[border[i]: border[i + 1]]
                    texts, number = np.unique(row[at_shard], return_inverse=True)
                    out.append([i, name, (h[at_shard] >> np.uint64(32)).astype(np.uint32).tobytes(), _numbers(number), keys[texts].tobytes(),
                                need[texts].astype(np.int32).tobytes(), b"", b"", b"", b""])
                if len(tokens) or len(u):
                    out.append([name % shards, name, b"", b"", b"", b"", tokens.tobytes(), owner.tobytes(), u.tobytes(), v.tobytes()])
                yield _batch(out, DEALT)

    def count(table: pa.Table) -> pa.Table:
        """Shingles that several sets hold, and how many, back to their slices."""
        rows = table.to_pylist()
        out = [[r["slice"], 0, b"", b"", b"", b"", b"", r["token"], r["owner"], r["u"], r["v"]] for r in rows if r["token"] or r["u"]]
        rows = [r for r in rows if r["print"]]
        if rows:
            prints = [np.frombuffer(r["print"], np.uint32) for r in rows]
            source = np.repeat(np.arange(len(rows)), [len(p) for p in prints])
            text = np.concatenate([_numbered(r["text"], len(p)) for r, p in zip(rows, prints)])
            prints = np.concatenate(prints)
            by = np.argsort(prints, kind="stable")
            ends = np.flatnonzero(np.r_[prints[by[1:]] != prints[by[:-1]], True]) + 1
            n = np.zeros(len(prints), np.int64)
            n[by] = np.repeat(np.diff(np.r_[0, ends]), np.diff(np.r_[0, ends]))
            border = np.searchsorted(source, np.arange(len(rows) + 1))
            for i, r in enumerate(rows):
                lo, hi = border[i], border[i + 1]
                some = np.flatnonzero(n[lo:hi] > 1) + lo
                if len(some):
                    texts, number = np.unique(text[some], return_inverse=True)
                    key, need = np.frombuffer(r["key"], np.int64)[texts], np.frombuffer(r["need"], np.int32)[texts]
                    out.append([r["slice"], r["shard"], prints[some].tobytes(), np.minimum(n[some], 65535).astype(np.uint16).tobytes(),
                                _numbers(number), key.tobytes(), need.tobytes(), b"", b"", b"", b""])
            del prints, source, text, by, ends, n
        arrays.give_back()
        return pa.Table.from_batches([_batch(out, SHARED)])

    def choose(table: pa.Table) -> pa.Table:
        """The first shingles of each set of a slice that shares enough, as (token, key, null) and links (null, u, v)."""
        rows = table.to_pylist()
        flat = lambda name, kind: np.frombuffer(b"".join(r[name] for r in rows), kind)
        tokens, owners, us, vs = [flat("token", np.uint64)], [flat("owner", np.int64)], flat("u", np.int64), flat("v", np.int64)
        rows = [r for r in rows if r["print"]]
        if rows:
            token, key, need, n = [], [], [], []
            for r in rows:
                p = np.frombuffer(r["print"], np.uint32).astype(np.uint64)
                number = _numbered(r["text"], len(p))
                token.append(p << np.uint64(24) | np.uint64(r["shard"]))
                key.append(np.frombuffer(r["key"], np.int64)[number])
                need.append(np.frombuffer(r["need"], np.int32)[number].astype(np.int64))
                n.append(np.frombuffer(r["n"], np.uint16))
            token, key, need, n = (np.concatenate(x) for x in (token, key, need, n))
            by = np.lexsort((token, n, key))
            token, key, need = token[by], key[by], need[by]
            held = np.searchsorted(key, key, side="right") - np.searchsorted(key, key)
            first = _ranked(key) < held - need + 1
            order, heads, u, v = _stars(token[first], key[first])
            tokens.append(token[first][order[heads]])
            owners.append(key[first][order[heads]])
            us, vs = np.r_[us, u], np.r_[vs, v]
        us, vs = arrays.forest(us, vs)
        token, owner = np.concatenate(tokens).view(np.int64), np.concatenate(owners)
        arrays.give_back()
        none = np.zeros(len(us), np.int64)
        return pa.table({"token": pa.array(np.r_[token, none], mask=np.r_[np.zeros(len(token), bool), np.ones(len(us), bool)]),
                         "u": np.r_[owner, us], "v": pa.array(np.r_[np.zeros(len(token), np.int64), vs], mask=np.r_[np.ones(len(token), bool), np.zeros(len(us), bool)])})

    def meet(table: pa.Table) -> pa.Table:
        _, _, u, v = _stars(np.asarray(table["token"], np.int64), np.asarray(table["u"], np.int64))
        u, v = arrays.forest(u, v)
        return pa.table({"u": u, "v": v})

    dealt = reps.mapInArrow(lambda batches: arrays.tidied(deal(batches)), DEALT)
    back = dealt.groupBy("shard").applyInArrow(count, SHARED)
    chosen = saved(back.groupBy("slice").applyInArrow(choose, TOKENS), "tokens")
    bins = max(1, math.ceil(chosen.count() / (1 << 18)))
    met = chosen.where("token IS NOT NULL").withColumn("bin", F.pmod(F.xxhash64("token"), F.lit(bins))).groupBy("bin").applyInArrow(meet, "u long, v long")
    return met.union(chosen.where("token IS NULL").select("u", "v"))


def _blocks(src: DataFrame, k: int, percent: int, shard_bytes: int, max_frequent: int) -> DataFrame:
    """(node, component): blocks of (key, text) that hold all similar pairs."""
    total = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return components(_candidates(src, k, percent, _frequent(src, k, max_frequent, 200), max(1, math.ceil(total / shard_bytes))))


def overlaps(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Matrix of the shingles that each two of the sets share, summed over blocks of columns."""
    n = len(at) - 1
    row = np.repeat(np.arange(n), np.diff(at))
    order = np.argsort(h, kind="stable")
    h, row = h[order], row[order]
    first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
    count = np.diff(np.r_[first, len(h)])
    out = np.zeros((n, n), np.float32)
    dense = count > max(8, n // 32)
    at_dense = np.flatnonzero(dense)
    for lo in range(0, len(at_dense), COLUMNS):
        part = at_dense[lo: lo + COLUMNS]
        block = np.zeros((n, len(part)), np.float32)
        block[row[arrays.ranges(first[part], count[part])], np.repeat(np.arange(len(part)), count[part])] = 1
        out += block @ block.T
    sparse = np.flatnonzero(~dense & (count > 1))
    chunk = (np.cumsum(count[sparse] ** 2) - 1) // PAIRS
    for part in np.split(sparse, np.flatnonzero(np.diff(chunk)) + 1):
        at_part, size = arrays.ranges(first[part], count[part]), np.repeat(count[part], count[part])
        left = np.repeat(row[at_part], size)
        right = row[arrays.ranges(np.repeat(first[part], count[part]), size)]
        out += np.bincount(left * n + right, minlength=n * n).reshape(n, n).astype(np.float32)
    return out


def linked(h: np.ndarray, at: np.ndarray, percent: int) -> np.ndarray:
    """Boolean matrix of the pairs of sets that link (not with themselves)."""
    size = np.diff(at)
    low, high = np.minimum.outer(size, size), np.maximum.outer(size, size)
    able = (100 * low >= percent * high) & (low > 0)
    np.fill_diagonal(able, False)
    if not able.any():
        return able
    shared = overlaps(h, at).astype(np.int64)
    return able & (100 * shared >= percent * (size[:, None] + size[None, :] - shared))


def _tile(percent: int):
    """Links of a tile: a spanning forest as (u, v, 0) and the weight each row links with as (u, null, weight)."""

    def run(table: pa.Table) -> pa.Table:
        block, key = np.asarray(table["block"], np.int64), np.asarray(table["key"], np.int64)
        part, weight = np.asarray(table["part"], np.int64), np.asarray(table["weight"], np.int64)
        one, two = int(table["one"][0].as_py()), int(table["two"][0].as_py())
        values, borders = arrays.text_buffer(table["shingles"])
        values = np.frombuffer(values.tobytes(), np.uint64)
        borders = borders // 8
        us, vs, ws = [], [], []
        order = np.argsort(block, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(block[order])) + 1):
            if len(rows) < 2:
                continue
            size = (borders[1:] - borders[:-1])[rows]
            h = values[arrays.ranges(borders[rows], size)]
            pairs = linked(h, np.r_[0, np.cumsum(size)], percent)
            if one != two:  # parts of one block: only pairs across
                pairs &= part[rows][:, None] != part[rows][None, :]
            a, b = np.nonzero(np.triu(pairs))
            if len(a):
                total = pairs @ weight[rows]
                u, v = arrays.forest(key[rows][a], key[rows][b])
                us += [u, key[rows][total > 0]]
                vs += [v, np.full(int((total > 0).sum()), -1)]
                ws += [np.zeros(len(u), np.int64), total[total > 0]]
        flat = lambda x: np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64)
        arrays.give_back()
        v, w = flat(vs), flat(ws)
        return pa.table({"u": flat(us), "v": pa.array(v, mask=w > 0), "weight": w})

    return run


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, percent: int = 90,
                part_rows: int = 512, part_shingles: int = 1 << 20, shard_bytes: int = 8 << 20,
                max_frequent: int = 1 << 16) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with n_shingles, component (the id of its first document), n_links and first (it is that document), and the names these got."""
    if not 50 <= percent <= 100:
        raise ValueError("percent is 50 to 100")
    names = {c: fresh(docs, c) for c in ("n_shingles", "component", "n_links", "first")}
    key = fresh(docs, "row_key")
    keyed, unique = row_keys(docs, id_col, text_col, key)
    src = keyed.select(F.col(key).alias("key"), F.col(text_col).cast("string").alias("text"))
    src = src if unique else src.dropDuplicates(["key"])
    known = saved(_describe(src, k), "sets")
    groups = saved(known.where("n > 0").groupBy("a", "b", "n").agg(F.min("key").alias("rep"), F.count("*").alias("weight")), "groups")

    block = _blocks(src, k, percent, shard_bytes, max_frequent)
    # Documents with equal sets are candidates of each other; from here on only the first of them goes on.
    block = block.join(groups.select(F.col("rep").alias("node"), "weight", "n"), "node")
    sizes = block.groupBy("component").agg(F.count("*").alias("rows"), F.sum("n").alias("shingles")).where("rows > 1")
    parts = F.greatest(F.ceil(F.col("rows") / part_rows), F.ceil(F.col("shingles") / part_shingles)).cast("int")
    placed = saved(block.join(sizes, "component").select(
        F.col("node").alias("key"), "weight", F.col("component").alias("block"), parts.alias("parts"), "n",
        F.pmod(F.xxhash64("node"), parts).cast("int").alias("part")), "blocks")
    small = placed.where("parts = 1").agg(F.count("*").alias("rows"), F.sum("n").alias("shingles")).first()
    bins = max(1, math.ceil(small["rows"] / part_rows), math.ceil((small["shingles"] or 0) / part_shingles))

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in arrays.slices(whole, "text"):
                h, at = sets(batch, "text", k)
                packed = [h[at[i]: at[i + 1]].tobytes() for i in range(batch.num_rows)]
                own = [c for c in batch.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), pa.array(packed, pa.binary())], [*own, "shingles"])

    # Blocked texts grow with the corpus: the same join at every size.
    member = src.join(placed.hint("shuffle_merge"), "key").select("key", "text", "block", "parts", "part", "weight").mapInArrow(
        load, "key long, block long, parts int, part int, weight long, shingles binary")
    tiled = member.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "key", "block", "part", "weight", "shingles", F.least("part", "other").alias("one"), F.greatest("part", "other").alias("two"),
        F.when(F.col("parts") > 1, F.col("block")).otherwise(F.pmod(F.xxhash64("block"), F.lit(bins))).alias("bin"),
        (F.col("parts") > 1).alias("wide"))
    found = saved(tiled.groupBy("bin", "wide", "one", "two").applyInArrow(_tile(percent), "u long, v long, weight long"), "tiles")

    linked_reps = components(found.where("v IS NOT NULL").select("u", "v"))
    degree = found.where("v IS NULL").groupBy(F.col("u").alias("rep")).agg(F.sum("weight").alias("links"))
    of_set = groups.join(linked_reps.withColumnRenamed("node", "rep"), "rep", "left").join(degree, "rep", "left").select(
        "a", "b", "n", F.coalesce("component", "rep").alias("component"),
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"))
    of_row = known.join(of_set, ["a", "b", "n"], "left").select(
        F.col("key").alias(key), F.col("n").alias(names["n_shingles"]),
        F.coalesce("component", "key").alias(names["component"]), F.coalesce("links", F.lit(0)).cast("long").alias(names["n_links"]),
        (F.coalesce("component", "key") == F.col("key")).alias(names["first"]))
    if not unique:
        ids = keyed.select(F.col(key).alias(names["component"]), F.col(id_col).alias("first_id")).distinct()
        of_row = of_row.join(ids, names["component"]).withColumn(names["component"], F.col("first_id")).drop("first_id")
    return keyed.join(of_row, key).select(*docs.columns, *names.values()), names
