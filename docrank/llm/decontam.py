"""Benchmark decontamination with a positional inverted index.

Every task indexes the texts of its own batch: the places of each word that
occurs in a benchmark item, in order. Windows of consecutive item words are
looked up from their rarest word: its places, shifted to the window's start,
are intersected with the shifted places of the next rarest word, and so on;
what is left are the exact occurrences. For proximity, the rarest word's places
are kept where each other word of the item has a place within ``near`` words.
Words are 64-bit hashes of their bytes, A-Z as a-z.

The index is split by documents, so a frequent word's list is never gathered
in one task, and no posting is shuffled. The windows are sent to all tasks in
blocks of at most ``block_words`` words; each further block is another pass
over the documents, with what was found so far kept on the row.

Defined cases: null texts and null items have no words; an item of fewer
words than a window is one window; equal windows of several items count for
each; items without an id are ignored; an empty benchmark hits nothing; all
columns of the documents are kept, found columns get a free name.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docrank.llm import arrays
from docrank.llm.tables import fresh, saved

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Word bytes are 0-9, a-z, A-Z (folded) and all bytes from 0x80 on.
WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
GAP = 1 << 40  # between the word numbers of one text and the next
SLICE = 2 << 20  # bytes of text that are indexed at once


def block_of(ids: list, texts: list, window: int) -> dict:
    """Windows of some items, as plain arrays and lists, which every worker can read without this package.

    ``vocabulary``: sorted word hashes; ``items``: the word numbers of each item; ``table``: a row of word
    numbers for each window, -1 after short ones; ``size``: its words; ``owners``: its items; ``ids``: the items' ids."""
    data, at = arrays.text_buffer(pa.array(texts, pa.large_string()))
    words = arrays.Words(data, at, WORD_BYTES)
    vocabulary, number = np.unique(words.hash, return_inverse=True)
    owners: dict[tuple, list[int]] = {}
    items = []
    for i in range(len(texts)):
        own = number[words.begin[i]: words.begin[i + 1]].astype(np.int32)
        items.append(own)
        for j in range(max(0, len(own) - window) + 1 if len(own) else 0):
            owners.setdefault(tuple(own[j: j + window].tolist()), []).append(i)
    size = np.array([len(w) for w in owners], np.int32)
    table = np.full((len(size), max(size, default=1)), -1, np.int32)
    for k, w in enumerate(owners):
        table[k, : len(w)] = w
    return {"vocabulary": vocabulary, "items": items, "table": table, "size": size, "owners": [sorted(set(o)) for o in owners.values()], "ids": ids}


class Index:
    """Places of the vocabulary's words in some texts: word w has ``places[first[w]:first[w + 1]]``, ascending."""

    def __init__(self, words: arrays.Words, vocabulary: np.ndarray):
        at = np.searchsorted(vocabulary, words.hash)
        known = at < len(vocabulary)
        known[known] = vocabulary[at[known]] == words.hash[known]
        here = np.flatnonzero(known)
        term = at[here]
        order = np.argsort(term, kind="stable")
        self.places = (here + words.text[here] * GAP)[order]
        self.first = np.searchsorted(term[order], np.arange(len(vocabulary) + 1))
        self.size = np.diff(self.first)

    def of(self, term: int) -> np.ndarray:
        return self.places[self.first[term]: self.first[term + 1]]

    def phrase(self, window: np.ndarray) -> np.ndarray:
        """Starts of the window's exact occurrences, from its rarest word on."""
        order = np.argsort(self.size[window], kind="stable")
        found = self.of(window[order[0]]) - order[0]
        for j in order[1:]:
            if not len(found):
                break
            other = self.of(window[j])
            k = np.minimum(np.searchsorted(other, found + j), len(other) - 1)
            found = found[other[k] == found + j]
        return found

    def near(self, terms: np.ndarray, within: int) -> np.ndarray:
        """Places of the rarest term with every other term at most ``within`` words away."""
        terms = np.unique(terms)
        order = np.argsort(self.size[terms], kind="stable")
        found = self.of(terms[order[0]])
        for j in order[1:]:
            other = self.of(terms[j])
            if not len(found) or not len(other):
                return found[:0]
            k = np.searchsorted(other, found)
            after = np.abs(other[np.minimum(k, len(other) - 1)] - found)
            before = np.abs(found - other[np.maximum(k - 1, 0)])
            found = found[np.minimum(after, before) <= within]
        return found


def _blocks(items: DataFrame, id_col: str, text_col: str, window: int, block_words: int) -> Iterator[dict]:
    ids, texts, size = [], [], 0
    for row in items.select(F.col(id_col).alias("i"), F.col(text_col).cast("string").alias("t")).where(
            F.col("i").isNotNull()).toLocalIterator():
        ids.append(str(row.i)), texts.append(row.t or "")
        size += 1 + len(texts[-1]) // 2
        if size >= block_words:
            yield block_of(ids, texts, window)
            ids, texts, size = [], [], 0
    yield block_of(ids, texts, window)


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = 10, near: int | None = None,
                  block_words: int = 4_000_000) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with what was found, and the names of the four columns added.

    ``n_words``: long; ``spans``: array of struct(first, last) of hit word numbers, disjoint and in order;
    ``items``: ids of the items with exact windows; ``near_items``: ids with all words within ``near`` words.
    """
    names = {k: fresh(docs, k) for k in ("n_words", "spans", "items", "near_items")}
    span = "array<struct<first:bigint,last:bigint>>"
    out = docs.withColumns({names["n_words"]: F.lit(0).cast("long"), names["spans"]: F.array().cast(span),
                            names["items"]: F.array().cast("array<string>"), names["near_items"]: F.array().cast("array<string>")})
    sc, first = docs.sparkSession.sparkContext, True
    for block in _blocks(items, item_id, item_text, window, block_words):
        out = out if first else saved(out, "decontam")
        out, first = _search(out, sc.broadcast(block), text_col, names, near), False
    return out, names


def _search(docs: DataFrame, shared, text_col: str, names: dict[str, str], near: int | None) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for whole in batches:
            for batch in arrays.slices(whole, text_col, SLICE):
                yield find(batch, block)

    def find(batch: pa.RecordBatch, block: dict) -> pa.RecordBatch:
        words = arrays.Words(*arrays.text_buffer(batch.column(text_col)), WORD_BYTES)
        index = Index(words, block["vocabulary"])
        hits: dict[int, list[tuple[int, int]]] = {}
        found: list[set[str]] = [set() for _ in range(batch.num_rows)]
        close: list[set[str]] = [set() for _ in range(batch.num_rows)]
        table, ids = block["table"], block["ids"]
        if len(table) and len(index.places):
            present = np.append(index.size > 0, True)  # -1 fills short windows
            able = np.flatnonzero(present[table[:, 0]])
            for column in table.T[1:]:
                able = able[present[column[able]]]
            for k in able:
                size = int(block["size"][k])
                for place in index.phrase(table[k, :size]).tolist():
                    text, word = _split(place, words)
                    hits.setdefault(text, []).append((word, word + size - 1))
                    found[text].update(ids[o] for o in block["owners"][k])
            if near is not None:
                for k, own in enumerate(block["items"]):
                    if len(own) and (index.size[own] > 0).all():
                        for place in index.near(own, near).tolist():
                            close[_split(place, words)[0]].add(ids[k])
        columns = {n: batch.column(n) for n in batch.schema.names}
        columns[names["n_words"]] = pa.array(words.count, pa.int64())
        columns[names["spans"]] = pa.array(
            [merge(old + hits.get(i, [])) for i, old in enumerate(_spans(batch.column(names["spans"])))],
            pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])))
        for name, new in (("items", found), ("near_items", close)):
            old = batch.column(names[name]).to_pylist()
            columns[names[name]] = pa.array([sorted({*o, *s}) for o, s in zip(old, new, strict=True)], pa.list_(pa.string()))
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return docs.mapInArrow(lambda batches: arrays.tidied(run(batches)), docs.schema)


def _split(place: int, words: arrays.Words) -> tuple[int, int]:
    """(text, word number in it) of a place."""
    text, word = divmod(place, GAP)
    return text, int(word - words.begin[text])


def _spans(column: pa.Array) -> list[list[tuple[int, int]]]:
    return [[(s["first"], s["last"]) for s in row] for row in column.to_pylist()]


def merge(spans: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Disjoint spans in order that cover the same words."""
    out: list[dict[str, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1]["last"] + 1:
            out[-1]["last"] = max(out[-1]["last"], b)
        else:
            out.append({"first": a, "last": b})
    return out


def hit_words(spans: str):
    """Number of words that the spans cover."""
    return F.aggregate(F.col(spans), F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
