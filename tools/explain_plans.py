"""Write the physical plans of the headline jobs to PLANS.md.

usage: python tools/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from docrank.operators import fulltext as FT  # noqa: E402
from docrank.operators import index as IX  # noqa: E402
from docrank.operators import search as SR  # noqa: E402
from docrank.plans import catalog as C  # noqa: E402
from docrank.session import checkpoint_dir, local_session, scratch_path  # noqa: E402


def plan_text(df, mode="simple") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    text = buf.getvalue()
    text = re.sub(r"INSET \([^)]{200,}?\)", "INSET (<stop list>)", text)
    text = re.sub(r"(regexp_replace\(|split\()[^\n]{160,}", lambda m: m.group(0)[:160] + " …", text)
    text = re.sub(r"file:[^\],]+", "file:<path>", text)
    return text.strip()


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    checkpoint_dir(spark)
    out = ["# Physical plans of the headline jobs",
           "",
           f"Generated by `tools/explain_plans.py` on `{os.path.basename(sf)}` with `local[8]`, AQE on. Long literals",
           "(stop list, regex patterns, paths) are abridged. Plans before execution show the static choice; AQE may",
           "coalesce partitions at run time.", ""]
    built = C.doc_index(spark, sf)
    sections = [
        ("Term counts (tokenise, stop test, partial + final count)",
         IX.term_frequency(IX.corpus(C.documents(spark, sf), "doc_id", ("text",)), IX.IndexOptions(stem=False))),
        ("Postings written: tf ⋈ dictionary (broadcast, bytes summed) ⋈ norms (broadcast, bytes summed), sorted by (term, doc_id) over ranges",
         IX.normalized_postings(built).repartitionByRange(8, "term", "doc_id").sortWithinPartitions("term", "doc_id")),
        ("Norms: narrow partial sums, one zero row per record",
         IX.document_norms(built.postings, C.documents(spark, sf).select("doc_id"))),
    ]
    path = scratch_path(spark, f"plans-{uuid.uuid4().hex}")
    idx = IX.write_index(built, path)
    built.release()
    bench = C.benchmark(spark, sf)
    sections += [
        ("Batch search on the written index (query side broadcast, WindowGroupLimit before the exchange)",
         SR.search_batch(idx, bench, C.K, "item_id", "text")),
        ("Single search on the written index (a batch of one; its terms reach files and row groups)",
         SR.search(idx, C.first_benchmark_text(spark, sf), C.K)),
        ("Stemmed term counts (Arrow batches over counted words, re-sum by stem)",
         IX.term_frequency(IX.corpus(C.documents(spark, sf), "doc_id", ("text",)), IX.IndexOptions(stem=True))),
        ("Weighted full-text batch", FT.fulltext_search_batch(C.part_lexemes(spark, sf), C.part_name_queries(spark, sf),
                                                             C.K)),
        ("Posting-list export in bounded blocks", IX.posting_lists(idx).select("term", "block", F.col("size"))),
    ]
    for title, df in sections:
        out += [f"## {title}", "", "```", plan_text(df), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
