"""Best-fit packing of tokenised documents into training sequences.

A document's tokens (byte-level BPE ids, then the separator id 0) are one
piece, or, where they exceed the sequence length, several: every piece but the
first then fills a sequence, the first may be shorter. Pieces are vectors
(tokens, documents, attention cost = tokens squared); sequences are bins with
a capacity in each. Vector best-fit: pieces in falling order of size; a piece
goes to the open bin that has room for it in every dimension and scores best,
by the weighted dot product of piece and residual capacities (the smallest, so
the tightest bin) or by the norm of what would be left; a new bin opens only
if none has room.

Spark tokenises in one narrow pass and deals pieces to bin groups by a hash of
piece, content and partition, so a group holds a bounded number of pieces whatever a
source or id does. Groups pack independently; each leaves a few bins partly
full out of thousands. Counts come from the rows themselves, so there is no
cap on rows.

Defined cases: a null text is empty and gives one piece, the separator; equal
rows give equal pieces, each packed; an empty table gives no rows; columns
other than id and text are ignored.
"""

from __future__ import annotations

import math
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docrank.llm import arrays

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PIECE = "doc_id {id}, piece int, start long, length long, ids_crc32 long"
# Below it both libraries sort characters into the same classes; other parts go to the first one.
LATIN_END = "\u0250"


class _Ids:
    """Token ids of a text as little-endian bytes.

    The rank file beside the vocabulary holds the same merges for a library
    that is several times faster; texts with a special token's string or with
    characters from ``LATIN_END`` on go to the vocabulary's own library.
    """

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self._slow = Tokenizer.from_file(vocabulary)
        self._special = tuple(t.content for t in self._slow.get_added_tokens_decoder().values())
        self._fast = None
        try:
            lines = open(vocabulary.removesuffix(".json") + ".tiktoken", "rb").read().splitlines()
        except OSError:
            return
        import base64

        import public_tokenizers
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    def text(self, text: str) -> bytes:
        if self._fast is not None and max(text) < LATIN_END and not any(s in text for s in self._special):
            return array("I", self._fast.encode_ordinary(text)).tobytes()
        return array("I", self._slow.encode(text, add_special_tokens=False).ids).tobytes()


def cut(n: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: all but the first are ``most`` long."""
    first = n % most or min(n, most)
    return [(0, first)] + [(s, most) for s in range(first, n, most)]


def token_pieces(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                 length: int = 2048, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and token_ids if ``keep_ids``)."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = PIECE.format(id=src.schema["doc_id"].dataType.simpleString()) + (", token_ids array<int>" if keep_ids else "")

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = _Ids(vocabulary), np.zeros(1, "<u4").tobytes()
        for batch in batches:
            row, num, start, size, crc, kept = [], [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                ids = (words.text(t) if (t := text.as_py()) else b"") + end
                for k, (s, n) in enumerate(cut(len(ids) // 4, length)):
                    part = ids[4 * s: 4 * (s + n)]
                    row.append(i), num.append(k), start.append(s), size.append(n), crc.append(zlib.crc32(part))
                    if keep_ids:
                        kept.append(np.frombuffer(part, "<u4").astype(np.int32))
            columns = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(num, pa.int32()), pa.array(start, pa.int64()),
                       pa.array(size, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("token_ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return src.mapInArrow(lambda batches: arrays.tidied(tokenise(batches)), schema)


def vector_best_fit(sizes: np.ndarray, capacity: np.ndarray, weights: np.ndarray, rule: str = "dot") -> tuple[np.ndarray, int]:
    """Bin of each item and the number of bins. ``sizes``: items by dimensions.

    Bins with equal residuals are interchangeable, so open bins are kept as
    residual kinds with counts of bins; a score is computed once per kind.
    """
    order = np.lexsort(tuple(-sizes[:, d] for d in range(sizes.shape[1] - 1, -1, -1)))
    bin_of, bins = np.empty(len(sizes), np.int64), 0
    kinds: dict[tuple, list[int]] = {}  # residual capacities -> bins that have them
    table, keys, alive = np.empty((1024, sizes.shape[1])), [None] * 1024, np.zeros(1024, bool)
    slot: dict[tuple, int] = {}
    used, scale = 0, weights / capacity
    floor = sizes.min(axis=0) if len(sizes) else None
    for item in order:
        need = sizes[item]
        room = table[:used]
        fits = alive[:used] & (room >= need).all(axis=1)
        if fits.any():
            at = np.flatnonzero(fits)
            rest = room[at]
            if rule == "dot":
                score = (rest * scale) @ (need * scale)
            else:
                score = np.linalg.norm((rest - need) * scale, axis=1)
            k = at[int(np.argmin(score))]
            key = keys[k]
            target = kinds[key].pop()
            left = tuple((table[k] - need).tolist())
            if not kinds[key]:
                del kinds[key], slot[key]
                alive[k] = False
        else:
            target, bins = bins, bins + 1
            left = tuple((capacity - need).tolist())
        bin_of[item] = target
        if all(a >= b for a, b in zip(left, floor, strict=True)):
            if left in kinds:
                kinds[left].append(target)
            else:
                if used == len(table):
                    live = np.flatnonzero(alive)
                    if len(live) > len(table) // 2:
                        grow = len(table)
                        table = np.vstack([table, np.empty_like(table)])
                        keys += [None] * grow
                        alive = np.concatenate([alive, np.zeros(grow, bool)])
                    else:
                        table[: len(live)] = table[live]
                        keys[: len(live)] = [keys[j] for j in live]
                        alive[:] = False
                        alive[: len(live)] = True
                        used = len(live)
                        slot = {keys[j]: j for j in range(used)}
                kinds[left] = [target]
                table[used], keys[used], alive[used] = left, left, True
                slot[left] = used
                used += 1
    return bin_of, bins


def best_fit_packing(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                     length: int = 2048, max_docs: int | None = None, max_attention: float | None = None,
                     weights: tuple[float, float, float] = (1.0, 0.05, 0.05), rule: str = "dot",
                     group_rows: int = 16_000, keep_ids: bool = False) -> DataFrame:
    """Pieces with the sequence and offset that each got.

    ``max_docs`` and ``max_attention`` bound the pieces and the summed squared
    lengths of a sequence (default: what ``length`` implies, so they never bind).
    Pieces are cut to the longest that either capacity takes: ``length`` tokens, or the root of ``max_attention``.
    ``rule``: ``dot`` or ``norm``. ``group_rows``: documents, and full pieces, per bin group.
    """
    if rule not in ("dot", "norm"):
        raise ValueError("rule is dot or norm")
    if (max_attention is not None and max_attention < 1) or (max_docs is not None and max_docs < 1):
        raise ValueError("a sequence must have room for one token")
    capacity = np.array([length, max_docs or length, max_attention or float(length) ** 2], float)
    weigh = np.array(weights, float)
    longest = length if max_attention is None else min(length, math.isqrt(int(max_attention)))
    pieces = token_pieces(docs, vocabulary, id_col, text_col, longest, keep_ids)
    size = docs.agg(F.count("*").alias("rows"), F.sum(F.octet_length(text_col)).alias("bytes")).first()
    # A token has a byte at least, so a group has a bounded number of pieces, however long the documents are.
    groups = max(1, math.ceil(max(size["rows"], (size["bytes"] or 0) / longest) / group_rows))
    # Equal rows of different partitions are dealt apart.
    deal = F.pmod(F.xxhash64("doc_id", "piece", "start", "length", "ids_crc32", F.spark_partition_id()), F.lit(groups)).cast("long")

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "piece", "length", "ids_crc32"], kind="stable").reset_index(drop=True)
        size = rows["length"].to_numpy(np.float64)
        vectors = np.stack([size, np.ones(len(size)), size * size], axis=1)
        full = size >= length
        bin_of = np.empty(len(rows), np.int64)
        part, bins = vector_best_fit(vectors[~full], capacity, weigh, rule)
        bin_of[~full] = part
        bin_of[full] = bins + np.arange(int(full.sum()))
        order = np.argsort(bin_of, kind="stable")
        before = np.cumsum(size[order]) - size[order]
        first = np.r_[True, bin_of[order][1:] != bin_of[order][:-1]]
        offset = np.empty(len(rows), np.int64)
        offset[order] = before - np.maximum.accumulate(np.where(first, before, 0))
        return rows.drop(columns="deal").assign(sequence_id=key[0] * (1 << 40) + bin_of, offset=offset)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"
    return pieces.withColumn("deal", deal).groupBy("deal").applyInPandas(pack, schema)
