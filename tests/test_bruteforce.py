"""Stemmed batch cosine search (the query without a SQL oracle) against a
brute-force pure-Python computation on the sf0.001 tables."""

import math
from collections import Counter

from docrank.functions import text as T
from docrank.functions.stem import porter2
from docrank.operators.index import build_index
from docrank.operators.search import search_batch
from tests.test_tokenizer_model import model_tokens

SF = "/root/testdata/sf0.001"
STOP = set(T.STOPWORDS)


def brute_force(docs, queries, k=5):
    tfs = {}
    for doc_id, text in docs:
        toks = [porter2(t.lower()) for t in model_tokens(text or " ") if t not in STOP]
        tfs.setdefault(doc_id, Counter()).update(toks)
    n = len(docs)
    df = Counter(t for c in tfs.values() for t in c)
    idf = {t: math.log(n / d) for t, d in df.items()}
    w = {d: {t: (1 + math.log(c)) * idf[t] for t, c in cs.items()} for d, cs in tfs.items()}
    norm = {d: math.sqrt(sum(x * x for x in ws.values())) for d, ws in w.items()}
    out = []
    for qid, text in queries:
        q = Counter(porter2(t) for t in (x.lower() for x in model_tokens(text)) if t not in STOP)
        qw = {t: (1 + math.log(c)) * idf[t] for t, c in q.items() if t in idf}
        qn = math.sqrt(sum(x * x for x in qw.values()))
        sims = []
        for d, ws in w.items():
            shared = [t for t in qw if t in ws]
            if not shared:
                continue
            dot = sum(qw[t] * ws[t] for t in shared)
            den = qn * norm[d]
            sims.append((round(dot / den, 6) if den else 0.0, d))
        sims.sort(key=lambda x: (-x[0], x[1]))
        out += [(qid, r + 1, d, s) for r, (s, d) in enumerate(sims[:k])]
    return sorted(out)


def test_stemmed_batch_equals_brute_force(spark):
    docs_df = spark.read.parquet(f"{SF}/documents.parquet")
    bench_df = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = sorted(tuple(r) for r in search_batch(build_index(docs_df, stem=True), bench_df, 5, "item_id",
                                                digits=6).collect())
    docs = [(r["doc_id"], r["text"]) for r in docs_df.collect()]
    queries = [(r["item_id"], r["text"]) for r in bench_df.collect()]
    assert got == brute_force(docs, queries)
