"""Registered queries of the numbered operators, each over its whole table.

The operators keep their own columns; these functions derive the digest
columns (hashes, counts, flags) that the queries return.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docrank.llm.tables import held_out


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of ``documents`` with its sequence and offset, 2048 tokens a sequence."""
    from docrank.llm.packing import best_fit_packing

    return best_fit_packing(_read(spark, sf_dir, "documents"), vocabulary()).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learnt from the rows that are not held out."""
    from docrank.llm import langid

    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    models = langid.train(docs, ~held_out("doc_id"))
    out, names = langid.identify(docs.select("doc_id", "text"), models)
    return out.select("doc_id", held_out("doc_id").alias("held_out"), F.col(names["lang_pred"]).alias("lang_pred"),
                      F.col(names["score"]).alias("score"), F.col(names["margin"]).alias("margin"),
                      F.col(names["rejected"]).alias("rejected"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in a 10-word window of ``benchmark``."""
    from docrank.llm.decontam import decontaminate, hit_words

    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    out, names = decontaminate(docs, _read(spark, sf_dir, "benchmark"))
    hit = hit_words(names["spans"])
    return out.select("doc_id", F.col(names["n_words"]).alias("n_words"), hit.alias("n_hit"),
                      F.size(names["items"]).cast("long").alias("n_items"),
                      F.sha2(F.array_join(names["items"], ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of every document under the model of well labelled text, and whether its language keeps it."""
    from docrank.llm.quality import quality_filter

    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out, names = quality_filter(docs, _read(spark, sf_dir, "labels").select("doc_id", "quality"), columns=["doc_id", "lang"])
    return out.select("doc_id", "lang", *(F.col(names[k]).alias(k) for k in ("n_grams", "perplexity", "threshold", "keep")))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under links of 90 % Jaccard similarity of 3-word shingles."""
    from docrank.llm.jaccard import near_copies

    out, names = near_copies(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col(names["n_shingles"]).alias("n_shingles"), F.col(names["component"]).alias("component_id"),
                      F.col(names["n_links"]).alias("n_links"))


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document left after removal of 100-byte strings that also start earlier."""
    from docrank.llm.repeats import remove_repeats

    out, names = remove_repeats(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", *(F.col(names[k]).alias(k) for k in ("n_bytes", "n_removed", "n_spans")),
                      F.sha2(names["kept"], 256).alias("kept_sha256"))


def op7_exact_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best vectors for every vector whose id is divisible by 20."""
    from docrank.llm.topk import exact_topk

    vectors = _read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return exact_topk(vectors.where("vec_id % 20 = 0"), vectors, 20)


def op8_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License statements of every document: a row per document and template found."""
    from docrank.llm.licenses import scan_licenses

    out, name = scan_licenses(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.explode(name).alias("found")).select("doc_id", "found.*")


# The listed rules (host, path, verdict).
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict for every page: a listed rule's, else the host reputation's. Bad: quality 0 or toxic 1."""
    from docrank.llm.urls import url_filter

    labels = _read(spark, sf_dir, "labels").select("doc_id", F.when(
        F.col("quality").isNotNull() | F.col("toxic").isNotNull(),
        (F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))).cast("int")).alias("bad"))
    return url_filter(_read(spark, sf_dir, "pages").select("page_id", "url"), labels, URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; labels learnt from the rows that are not held out."""
    from docrank.llm import toxicity

    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, _read(spark, sf_dir, "labels").select("doc_id", "toxic"), ~held_out("doc_id"))
    out, names = toxicity.score_toxicity(docs, model)
    return out.select("doc_id", held_out("doc_id").alias("held_out"), F.col(names["score"]).alias("score"),
                      F.col(names["predicted"]).alias("predicted"))


def op11_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document under links of 4 or fewer differing bits."""
    from docrank.llm.simhash import near_fingerprints

    out, names = near_fingerprints(_read(spark, sf_dir, "documents").select("doc_id", "text"), columns=["doc_id"])
    return out.select("doc_id", F.col(names["fingerprint"]).alias("fingerprint"), F.col(names["component"]).alias("component_id"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters keep, remove and lose in all 120 orders, for each source of ``documents``."""
    from docrank.llm.audit import audit_filters

    return audit_filters(spark, f"{sf_dir}/documents.parquet", _read(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and draw of every document towards the words of ``benchmark``: 10 % of those with 20 words or more."""
    from docrank.llm.resample import importance_resample

    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    out, names = importance_resample(docs, _read(spark, sf_dir, "benchmark").select("text"), n=1, columns=["doc_id"])
    return out.select("doc_id", *(F.col(names[k]).alias(k) for k in ("n_features", "weight", "score", "rank")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_language_id": op2_language_id,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_suffix_array_dedup": op6_suffix_array_dedup,
    "op7_exact_topk_search": op7_exact_topk_search,
    "op8_license_scans": op8_license_scans,
    "op9_url_filter": op9_url_filter,
    "op10_toxicity": op10_toxicity,
    "op11_simhash_near_dedup": op11_simhash_near_dedup,
    "op12_filter_audit": op12_filter_audit,
    "op13_importance_resampling": op13_importance_resampling,
}

# SQL for DuckDB where it states the operator; the others are tested against brute force, round trips or held-out accuracy.
_RULES = """CASE
  WHEN (host = 'example.net' OR suffix(host, '.example.net')) AND prefix(path, '/en/') THEN 'example.net/en/'
  WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND prefix(path, '/de/') THEN 'example.com/de/'
  WHEN (host = 'org' OR suffix(host, '.org')) AND prefix(path, '/fr/') THEN 'org/fr/'
  WHEN (host = 'net' OR suffix(host, '.net')) AND prefix(path, '/') THEN 'net/' END"""


def _strength_sql(level: str) -> str:
    """Prior strength of a level table with n, bad and prior, as one row (k)."""
    return f"""SELECT CASE WHEN count(*) = 0 OR sum(n) <= count(*) THEN 1.0 ELSE (1 - r) / r END AS k FROM (
      SELECT n, greatest(least((sum(n * (bad / n - prior) ** 2 / (prior * (1 - prior))) OVER () - count(*) OVER ()) / (sum(n) OVER () - count(*) OVER ()), 0.999), 1e-4) AS r
      FROM {level} WHERE n > 0) GROUP BY r"""


ORACLE_SQL: dict[str, str] = {
    "op3_benchmark_decontamination": r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL),
windows AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, w[j:j + 9] AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS j FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(win) AS n FROM windows),
places AS (
  SELECT doc_id, j, n, w[j:j + n - 1] AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS j FROM words, sizes WHERE len(w) >= n)),
found AS (SELECT p.doc_id, p.j, p.n, x.item_id FROM places p JOIN windows x ON p.win = x.win),
hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(j, j + n)) AS k FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM found GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op7_exact_topk_search": """
WITH v AS (
  SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE) for x in embedding] AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 20""",
    "op9_url_filter": f"""
WITH cut AS (
  SELECT page_id, CASE WHEN contains(coalesce(url, ''), '://') THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
base AS (
  SELECT page_id, translate(coalesce(regexp_extract(rest, '^([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM cut),
marks AS (
  SELECT doc_id AS page_id, max(CAST(coalesce(quality = 0, false) OR coalesce(toxic = 1, false) AS INTEGER)) AS bad FROM labels
  WHERE doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL) GROUP BY doc_id),
h0 AS (
  SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS bad, string_split(regexp_replace(host, ':[0-9]*$', ''), '.') AS p FROM base LEFT JOIN marks USING (page_id) GROUP BY host),
h1 AS (
  SELECT *, CASE WHEN len(p) >= 2 AND array_to_string(p[greatest(len(p) - 1, 1):], '.') IN ({", ".join(f"'{s}'" for s in
      ["ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "com.ar", "com.au", "com.br", "com.cn",
       "com.mx", "com.tr", "gov.uk", "ne.jp", "net.au", "or.jp", "org.au", "org.uk"])}) THEN 2 ELSE 1 END AS labels FROM h0),
h2 AS (
  SELECT host, n, bad, array_to_string(p[greatest(len(p) - labels + 1, 1):], '.') AS suf,
         array_to_string(p[greatest(len(p) - labels, 1):], '.') AS dom FROM h1),
s AS (SELECT suf, sum(n) AS n, sum(bad) AS bad, (SELECT (sum(bad) + 0.5) / (sum(n) + 1.0) FROM h2) AS prior FROM h2 GROUP BY suf),
sk AS ({_strength_sql("s")}),
sm AS (SELECT suf, (bad + k * prior) / (n + k) AS mean FROM s, sk),
d AS (SELECT suf, dom, sum(n) AS n, sum(bad) AS bad, any_value(mean) AS prior FROM h2 JOIN sm USING (suf) GROUP BY suf, dom),
dk AS ({_strength_sql("d")}),
dm AS (SELECT suf, dom, (bad + k * prior) / (n + k) AS mean FROM d, dk),
h AS (SELECT host, n, bad, mean AS prior FROM h2 JOIN dm USING (suf, dom)),
hk AS ({_strength_sql("h")}),
hm AS (SELECT host, n, k, (bad + k * prior) / (n + k) AS mean FROM h, hk),
judged AS (SELECT host, mean - 1.645 * sqrt(mean * (1 - mean) / (n + k + 1)) > 0.5 AS bad_host FROM hm),
ruled AS (SELECT page_id, host, path, {_RULES} AS rule FROM base)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
  WHEN bad_host THEN 'block' ELSE 'allow' END AS verdict FROM ruled JOIN judged USING (host)""",
    "op12_filter_audit": r"""
WITH marks AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
doc AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least FROM documents),
masked AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         CASE WHEN len(w) < 50 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * len(text) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN doc_id > least THEN 'E' ELSE '' END AS fails
  FROM doc LEFT JOIN marks USING (doc_id)),
counts AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM masked GROUP BY part, fails),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS f, substr(filter_order, 1, step - 1) AS before
  FROM orders, (SELECT unnest(range(1, 6)) AS step)),
placed AS (
  SELECT *, contains(fails, f) AS own, len(translate(fails, before, '')) < len(fails) AS gone FROM counts, steps),
told AS (
  SELECT part, filter_order, step, f, sum(n) FILTER (NOT own AND NOT gone) AS kept, sum(n) FILTER (own AND NOT gone) AS removed,
         sum(n) FILTER (own AND gone) AS redundant, sum(n) FILTER (fails = f) AS unique_fails,
         sum(good) FILTER (own AND NOT gone) AS good_lost, sum(toxic) FILTER (own AND NOT gone) AS toxic_lost
  FROM placed GROUP BY part, filter_order, step, f)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
       CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM told""",
    # The CRC-32 of each distinct word, bit by bit: a byte is followed by seven zeros, one shift each.
    "op13_importance_resampling": r"""
WITH doc AS (
  SELECT doc_id, list_filter(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+'), lambda x: x <> '') AS w FROM documents),
item AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS w FROM benchmark),
used AS MATERIALIZED (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(w) AS w FROM doc) GROUP BY ALL),
coded AS MATERIALIZED (
  SELECT w, xor(list_reduce([CASE WHEN i % 8 = 0 THEN CAST('0x' || substr(hex(encode(w)), CAST(i // 4 + 1 AS BIGINT), 2) AS BIGINT) ELSE 0 END
                             for i in range(8 * octet_length(encode(w)))],
                            lambda c, x: xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1)), CAST(4294967295 AS BIGINT)), 4294967295) % 10000 AS bucket
  FROM (SELECT w FROM used UNION SELECT w FROM item)),
s AS (SELECT bucket, CAST(sum(n) AS DOUBLE) AS s FROM used JOIN coded USING (w) GROUP BY bucket),
t AS (SELECT bucket, CAST(count(*) AS DOUBLE) AS t FROM item JOIN coded USING (w) GROUP BY bucket),
total AS (SELECT coalesce((SELECT sum(s) FROM s), 0) AS a, coalesce((SELECT sum(t) FROM t), 0) AS b),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1) * (a + 10000) / ((coalesce(s, 0) + 1) * (b + 10000)))) AS BIGINT) AS g
  FROM s FULL JOIN t USING (bucket), total),
weighed AS (
  SELECT doc_id, CAST(floor(CAST(sum(n * g) AS DOUBLE) / sum(n)) AS BIGINT) AS weight FROM used JOIN coded USING (w) JOIN gain USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
    (CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM doc LEFT JOIN weighed USING (doc_id)),
placed AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, 10 * count(*) OVER () // 100 AS most FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= most THEN place END AS rank FROM scored LEFT JOIN placed USING (doc_id)""",
}
