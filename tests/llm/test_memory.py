"""Memory of the tasks: what hashing words takes, and that workers hand memory back at a task's end."""

import tracemalloc
import weakref

import numpy as np
import pyarrow as pa
import pytest

from docrank.llm import arrays, decontam, langid, packing
from docrank.llm.decontam import WORD_BYTES
from docrank.llm.queries import vocabulary


def buffer(texts):
    return arrays.text_buffer(pa.array(texts, pa.string()))


def test_words_take_little_memory():
    data, at = buffer([f"{i} word and others of text {i % 7} " * 12 for i in range(6000)])
    assert len(data) > 2 << 20
    arrays.Words(data, at, WORD_BYTES)
    tracemalloc.start()
    arrays.Words(data, at, WORD_BYTES)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 * len(data)  # places and codes of all bytes at once took 33 bytes a byte


def test_words_are_hashed_alike_in_any_pieces(monkeypatch):
    texts = ["", None, "One two  two", "x" * 5000, "é ü-ab", " " * 3000 + "two" + " " * 3000, "one", "...", "two one"]
    hashes = []
    for size in (1, 7, 4000, 1 << 30):
        monkeypatch.setattr(arrays, "HASH_BYTES", size)
        hashes.append(arrays.Words(*buffer(texts), WORD_BYTES).hash)
    assert all(np.array_equal(hashes[0], h) for h in hashes)
    one, two = hashes[0][:2]
    assert hashes[0][-3:].tolist() == [one, two, one] and len(set(hashes[0].tolist())) == 6
    assert len(arrays.Words(*buffer([None, ""]), WORD_BYTES).hash) == 0


def test_memory_goes_back_after_the_task_let_go(monkeypatch):
    held, seen = [], []

    def task():
        own = np.zeros(10)
        held.append(weakref.ref(own))
        yield 1
        yield 2
        assert own is not None

    monkeypatch.setattr(arrays, "give_back", lambda: seen.append(held[0]() is None))
    assert list(arrays.tidied(task())) == [1, 2] and seen == [True]


@pytest.mark.parametrize("stage", ["decontamination", "language", "pieces"])
def test_stages_hand_memory_back(spark, monkeypatch, tmp_path, stage):
    mark = str(tmp_path / "given")

    def note():
        with open(mark, "a") as f:
            f.write("x")

    monkeypatch.setattr(arrays, "give_back", note)
    docs = spark.createDataFrame([(1, "one two three"), (2, None)], "doc_id long, text string").coalesce(1)
    if stage == "decontamination":
        items = spark.createDataFrame([("a", "two three")], "item_id string, text string")
        out, names = decontam.decontaminate(docs, items)
        assert {r.doc_id: r[names["items"]] for r in out.collect()} == {1: ["a"], 2: []}
    elif stage == "language":
        out, _ = langid.identify(docs, [("en", b"one two three four")])
        assert len(out.collect()) == 2
    else:
        assert len(packing.token_pieces(docs, vocabulary()).collect()) == 2
    assert open(mark).read()
