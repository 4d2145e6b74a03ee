"""Language identification by compression.

One zstandard compressor per language is primed with raw text of that language;
a text gets the language whose compressor makes it smallest, summed over
windows of the whole text. The margin is how much larger the next language's
size is, relative to the best. A text is rejected if it has no letters, or if
its margin is below ``min_margin``; texts of fewer than ``min_letters`` letters
are not rejected for that, since a byte is too coarse for them. Equal sizes go
to the language with more training documents.

Training: of the rows with text and language that are not held out, about
``samples`` for each language, chosen by hash, give a snippet of
``snippet`` characters from a hashed place, up to ``dictionary`` bytes a
language. This bounded sample is all that is collected; scoring is one narrow
pass over all rows.

Defined cases: null text and text without letters: ``und``, score 0, rejected;
null language: never a label; no labelled rows: everything is ``und``; equal
texts get equal results; all columns are kept, new ones get free names.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docrank.llm import arrays, zdict
from docrank.llm.tables import fresh, hashed_sample

cloudpickle.register_pickle_by_value(sys.modules[__name__])

UNKNOWN = "und"
WINDOW = 4096
PARAMETERS = dict(window_log=18, hash_log=15, chain_log=15, search_log=4, min_match=4, strategy=zstandard.STRATEGY_LAZY)


def train(docs: DataFrame, usable: Column, text_col: str = "text", lang_col: str = "lang", samples: int = 1500,
          snippet: int = 400, dictionary: int = 96 << 10) -> list[tuple[str, bytes]]:
    """(language, dictionary) for each language, the most frequent first."""
    text, n = F.col(text_col), F.length(text_col)
    rows = docs.where(usable & text.isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.xxhash64(text_col).alias("h"),
        F.substring(text, F.pmod(F.xxhash64(text), F.greatest(n - snippet, F.lit(0)) + 1).cast("int") + 1, F.lit(snippet)).alias("part"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    parts: dict[str, list[bytes]] = {lang: [] for lang in counts}
    for r in hashed_sample(rows, "lang", [F.col("h"), F.col("part")], samples).sort("lang", "h", "part").toLocalIterator():
        if (t := zdict.letters(r["part"]).encode()) and t not in parts[r["lang"]][-1:]:
            parts[r["lang"]].append(t)
    out = []
    for lang in sorted(counts, key=lambda x: (-counts[x], x)):
        content = b" ".join(parts[lang])[:dictionary]
        if len(content) >= 8:
            out.append((lang, content))
    return out


def sizes(text: str, models: list[zstandard.ZstdCompressor]) -> list[int] | None:
    """Compressed size of the whole text under each model; None without letters."""
    data = zdict.letters(text)
    if not any(map(str.isalpha, data)):  # other word characters, such as superscript digits, are no letters
        return None
    parts = zdict.windows(b" " + data.encode() + b" ", WINDOW)
    return [sum(len(m.compress(p)) for p in parts) for m in models]


def identify(docs: DataFrame, models: list[tuple[str, bytes]], text_col: str = "text", min_margin: float = 0.002,
             min_letters: int = 40) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with lang_pred, score, margin and rejected, and the names these columns got."""
    names = {k: fresh(docs, k) for k in ("lang_pred", "score", "margin", "rejected")}
    schema = StructType(list(docs.schema.fields))
    for k, kind in (("lang_pred", "string"), ("score", "double"), ("margin", "double"), ("rejected", "boolean")):
        schema = schema.add(names[k], kind)
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def judge(text: str | None, langs: list[str], primed: list) -> tuple[str, float, float, bool]:
        found = sizes(text, primed) if text else None
        if found is None or not langs:
            return UNKNOWN, 0.0, 0.0, True
        order = sorted(range(len(langs)), key=found.__getitem__)
        best = found[order[0]]
        margin = (found[order[1]] - best) / best if len(order) > 1 else 1.0
        narrow = margin < min_margin and len(zdict.letters(text)) >= min_letters
        return langs[order[0]], 1.0 - 0.5 * math.exp(-margin / 0.02), margin, narrow

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs = [lang for lang, _ in shared.value]
        primed = [zdict.primed(content, **PARAMETERS) for _, content in shared.value]
        for batch in batches:
            got = [judge(t.as_py(), langs, primed) for t in batch.column(text_col)]
            columns = [pa.array([g[i] for g in got], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *names.values()])

    return docs.mapInArrow(lambda batches: arrays.tidied(run(batches)), schema), names
