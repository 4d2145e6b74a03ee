"""SimHash components against a plain-Python version that compares all pairs."""

import random

import numpy as np
import pytest
import xxhash

from docrank.llm import simhash
from docrank.llm.queries import QUERIES
from docrank.llm.simhash import near_fingerprints
from tests.llm import brute

SF001 = "/root/testdata/sf0.001"


def plain_print(text, k=4):
    w = brute.OP5_WORD.findall((text or "").translate(brute.UPPER))
    shingles = [" ".join(w[i: i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain(rows, distance=4, k=4, prints=None):
    """Sorted (id, fingerprint, component)."""
    prints = prints or [plain_print(t, k) for _, t in rows]
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    distinct = sorted(root)
    for a in distinct:
        for b in distinct:
            if a < b and bin(a ^ b).count("1") <= distance:
                root[find(a)] = find(b)
    least = {}
    for (i, _), p in zip(rows, prints):
        known = least.get(find(p))
        least[find(p)] = i if known is None else known if i is None else min(known, i)
    return sorted(((i, f"{p:016x}", least[find(p)]) for (i, _), p in zip(rows, prints)), key=repr)


def result(df, **options):
    out, names = near_fingerprints(df, **options)
    return sorted((tuple(r) for r in out.select("doc_id", names["fingerprint"], names["component"]).collect()), key=repr)


def test_query_equals_all_pairs(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    want = plain(rows)
    assert sorted(map(tuple, QUERIES["op11_simhash_near_dedup"](spark, SF001).collect()), key=repr) == want
    assert any(i != c for i, _, c in want)


def corpus(rng):
    words = [f"w{i}" for i in range(300)] + ["Ünï", "ABC"]
    base = [" ".join(rng.choices(words, k=rng.randint(1, 200))) for _ in range(60)]
    near = []
    for t in base[:30]:
        w = t.split()
        for _ in range(6):
            w = w[:]
            w[rng.randrange(len(w))] = rng.choice(words)
            near.append(" ".join(w))
    texts = base + near + [base[0]] * 150 + [None, "", " \t\r\n", "one", "one two  THREE", "one\x0btwo three", " ".join(rng.choices(words, k=30_000))]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    return rows + rows[:5] + [(None, base[1]), (None, "only a null id here says so"), (None, None)]


@pytest.mark.parametrize("options", [{}, {"part_rows": 3, "bin_rows": 10}, {"distance": 0}, {"distance": 9, "k": 2}])
def test_edge_cases(spark, options):
    rows = corpus(random.Random(5))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    own = {k: v for k, v in options.items() if k in ("distance", "k")}
    assert result(df, **options) == plain(rows, **own)


def test_long_text_in_pieces(monkeypatch):
    text = " ".join(random.Random(1).choices(["a", "bb", "ccc", "dddd", "  e"], k=500))
    for step in (1, 7, 100):
        monkeypatch.setattr(simhash, "STEP_BYTES", step)
        for k in (1, 2, 4):
            assert simhash.fingerprint(text.encode(), k) == plain_print(text, k)
            assert simhash.fingerprint(b"  one two ", k) == plain_print("one two", k)


def test_columns_and_empty(spark):
    df = spark.createDataFrame([("b", "x y z", 1.5), ("a", "x y z", 2.5)], "doc_id string, text string, COMPONENT double")
    out, names = near_fingerprints(df)
    assert out.columns[:3] == df.columns and names["component"] == "_component"
    assert {r["_component"] for r in out.collect()} == {"a"}
    assert near_fingerprints(df.where("false"))[0].collect() == []
    for bad in ({"distance": -1}, {"k": 0}, {"columns": ["text"]}):
        with pytest.raises(ValueError):
            near_fingerprints(df, **bad)


@pytest.mark.parametrize("kind", ["even", "skewed", "correlated"])
def test_layouts_lose_no_pair(kind):
    """Every pair within the distance agrees up to the threshold in some partition, whatever the bits look like."""
    rng = np.random.default_rng(3)
    bits = rng.random((400, 64)) < {"even": 0.5, "skewed": 0.03, "correlated": 0.5}[kind]
    if kind == "correlated":
        bits[:, 20:40] = bits[:, :1]
    prints = np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()
    own = simhash.bits_of(prints).astype(float)
    for m in simhash.LAYOUTS:
        groups = simhash.partitions(own.T @ own, len(prints), m)
        assert sorted(b for g in groups for b in g) == list(range(64))
        cost = [[rng.random() * 10 ** t for t in range(5)] for _ in groups]
        total, chosen = simhash.thresholds(cost, 4)
        assert sum(t + 1 for t in chosen) == 5 and abs(total - sum(c[t] for c, t in zip(cost, chosen) if t >= 0)) < 1e-9
        x = prints[:, None] ^ prints[None, :]
        near = np.bitwise_count(x) <= 4
        hit = np.zeros_like(near)
        for g, t in zip(groups, chosen):
            v = simhash.values(prints, g)
            hit |= np.bitwise_count(v[:, None] ^ v[None, :]).astype(int) <= t
        assert not (near & ~hit).any()
    if kind == "correlated":
        home = [i for i, g in enumerate(simhash.partitions(own.T @ own, len(prints), 3)) for b in g if 20 <= b < 40 or b == 0]
        assert len(set(home)) == 1


def test_thresholds_are_least():
    rng = random.Random(8)
    for _ in range(20):
        cost = [[rng.random() for _ in range(5)] for _ in range(3)]
        want = min(sum(c[t] if t >= 0 else 0 for c, t in zip(cost, (a, b, 5 - 3 - a - b)))
                   for a in range(-1, 5) for b in range(-1, 5) if -1 <= 2 - a - b < 5)
        assert abs(simhash.thresholds(cost, 4)[0] - want) < 1e-12
