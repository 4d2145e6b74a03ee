"""DuckDB SQL restating every checkable registered query.

Stems over free text come from the published rules restated as SQL
(``sqltext.porter2_ctes``); the part vocabulary is small and fixed, so its
stems are literal VALUES derived by hand.
"""

from __future__ import annotations

import re

from docrank.functions import text as T
from docrank.plans import catalog as C
from docrank.plans.sqltext import (clean_tokens_sql, lower_list_sql, porter2_ctes, punct_sql, special_sql, sql_list,
                                   sql_str, url_sql)

STOP = sql_list(T.STOPWORDS)
PG_STOP = sql_list(T.FULLTEXT_STOPWORDS)

# Hand-derived English stems of every letter-only word of the
# part table (names, types, brand prefix) and of the stemmed query words.
PART_STEMS = (
    ("anvil", "anvil"), ("blue", "blue"), ("bolt", "bolt"), ("brand", "brand"), ("cold", "cold"),
    ("economy", "economi"), ("gear", "gear"), ("gizmo", "gizmo"), ("hot", "hot"), ("large", "larg"),
    ("medium", "medium"), ("new", "new"), ("old", "old"), ("plate", "plate"), ("plates", "plate"),
    ("promo", "promo"), ("red", "red"), ("ring", "ring"), ("rings", "ring"), ("rod", "rod"),
    ("small", "small"), ("standard", "standard"), ("widget", "widget"),
)
STEMS_CTE = "stems(word, stem) AS (VALUES " + ", ".join(f"({sql_str(a)}, {sql_str(b)})" for a, b in PART_STEMS) + ")"


def _tf_ctes(table: str, id_expr: str, text_expr: str, stemmed: bool = False) -> str:
    """CTEs toks, tf, nd, df, w, norms over one corpus table."""
    tf = (f"tf AS (SELECT doc_id, lower(tok) AS term, count(*) AS tf FROM toks "
          f"WHERE NOT list_contains({STOP}, tok) GROUP BY ALL)")
    if stemmed:
        tf = (f"tf0 AS (SELECT doc_id, lower(tok) AS word, count(*) AS c FROM toks "
              f"WHERE NOT list_contains({STOP}, tok) GROUP BY ALL), "
              f"tf AS (SELECT doc_id, CASE WHEN regexp_full_match(word, '[a-z]+') THEN s.stem ELSE word END AS term, "
              f"CAST(sum(c) AS BIGINT) AS tf FROM tf0 LEFT JOIN stems s USING (word) GROUP BY ALL)")
    return f"""
toks AS (SELECT {id_expr} AS doc_id, unnest({clean_tokens_sql(text_expr)}) AS tok FROM {table}),
{tf},
nd AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM {table}),
df AS (SELECT term, count(*) AS df, ln((SELECT n FROM nd) / count(*)) AS idf FROM tf GROUP BY term),
w AS (SELECT term, doc_id, tf, idf, (1 + ln(tf)) * idf AS weight FROM tf JOIN df USING (term)),
norms AS (SELECT d.doc_id, coalesce(sqrt(sum(w.weight * w.weight)), 0.0) AS norm
          FROM (SELECT DISTINCT {id_expr} AS doc_id FROM {table}) d LEFT JOIN w USING (doc_id) GROUP BY d.doc_id)"""


DOC_INDEX = _tf_ctes("documents", "doc_id", "text")


def _query_ctes(queries_sql: str) -> str:
    """CTEs qtf, qw, qn, dot, sim over ``queries_sql`` (query_id, text)."""
    return f"""
qsrc AS ({queries_sql}),
qt AS (SELECT query_id, unnest({lower_list_sql(clean_tokens_sql('text'))}) AS term FROM qsrc),
qtf AS (SELECT query_id, term, count(*) AS qtf FROM qt WHERE NOT list_contains({STOP}, term) GROUP BY ALL),
qw AS (SELECT query_id, term, qtf, idf, (1 + ln(qtf)) * idf AS qweight FROM qtf JOIN df USING (term)),
qn AS (SELECT query_id, sqrt(sum(qweight * qweight)) AS qnorm FROM qw GROUP BY query_id),
dot AS (SELECT query_id, doc_id, sum(qweight * weight) AS dot FROM qw JOIN w USING (term) GROUP BY ALL),
sim AS (SELECT query_id, doc_id, round(CASE WHEN qnorm * norm = 0 THEN 0.0 ELSE dot / (qnorm * norm) END, 6)
               AS similarity FROM dot JOIN qn USING (query_id) JOIN norms USING (doc_id)),
ranked AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, doc_id)
                  AS BIGINT) AS rank, doc_id, similarity FROM sim)"""


def _weights_ctes(table: str, id_expr: str) -> str:
    """CTEs nd, df, w, norms over a CTE tf."""
    return f"""
nd AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM {table}),
df AS (SELECT term, count(*) AS df, ln((SELECT n FROM nd) / count(*)) AS idf FROM tf GROUP BY term),
w AS (SELECT term, doc_id, tf, idf, (1 + ln(tf)) * idf AS weight FROM tf JOIN df USING (term)),
norms AS (SELECT d.doc_id, coalesce(sqrt(sum(w.weight * w.weight)), 0.0) AS norm
          FROM (SELECT DISTINCT {id_expr} AS doc_id FROM {table}) d LEFT JOIN w USING (doc_id) GROUP BY d.doc_id)"""


def _stemmed_ranking(queries_sql: str) -> str:
    """CTEs up to ranked over the stemmed documents, every stem from the rules in SQL."""
    return f"""
toks AS (SELECT doc_id, unnest({clean_tokens_sql('text')}) AS tok FROM documents),
tf0 AS (SELECT doc_id, lower(tok) AS word, count(*) AS c FROM toks WHERE NOT list_contains({STOP}, tok) GROUP BY ALL),
qsrc AS ({queries_sql}),
q0 AS (SELECT query_id, unnest({lower_list_sql(clean_tokens_sql('text'))}) AS word FROM qsrc),
qt0 AS (SELECT query_id, word FROM q0 WHERE NOT list_contains({STOP}, word)),
{porter2_ctes("SELECT word FROM tf0 UNION SELECT word FROM qt0")},
tf AS (SELECT doc_id, stem AS term, CAST(sum(c) AS BIGINT) AS tf FROM tf0 JOIN stems USING (word) GROUP BY ALL),
{_weights_ctes("documents", "doc_id")},
qtf AS (SELECT query_id, stem AS term, count(*) AS qtf FROM qt0 JOIN stems USING (word) GROUP BY ALL),
qw AS (SELECT query_id, term, qtf, idf, (1 + ln(qtf)) * idf AS qweight FROM qtf JOIN df USING (term)),
qn AS (SELECT query_id, sqrt(sum(qweight * qweight)) AS qnorm FROM qw GROUP BY query_id),
dot AS (SELECT query_id, doc_id, sum(qweight * weight) AS dot FROM qw JOIN w USING (term) GROUP BY ALL),
sim AS (SELECT query_id, doc_id, round(CASE WHEN qnorm * norm = 0 THEN 0.0 ELSE dot / (qnorm * norm) END, 6)
               AS similarity FROM dot JOIN qn USING (query_id) JOIN norms USING (doc_id)),
ranked AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, doc_id)
                  AS BIGINT) AS rank, doc_id, similarity FROM sim)"""


BENCH_QUERIES = "SELECT item_id AS query_id, text FROM benchmark"
FIRST_BENCH = "SELECT CAST(0 AS BIGINT) AS query_id, text FROM benchmark ORDER BY item_id LIMIT 1"

PART_PAPERS = """part_papers AS (SELECT CAST(p_partkey AS VARCHAR) AS id, CAST(NULL AS VARCHAR) AS submitter,
  p_brand AS authors, p_name AS title, CAST(NULL AS VARCHAR) AS comments, CAST(NULL AS VARCHAR) AS journal_ref,
  CAST(NULL AS VARCHAR) AS doi, CAST(NULL AS VARCHAR) AS abstract, p_type AS categories,
  CAST(NULL AS VARCHAR) AS versions, p_partkey AS doc_id FROM part)"""
PART_TEXT = "concat_ws(' ', coalesce(id, ' '), coalesce(authors, ' '), coalesce(abstract, ' '), coalesce(categories, ' '), coalesce(title, ' '))"
PART_INDEX = _tf_ctes("part_papers", "doc_id", PART_TEXT, stemmed=True)

ALPHA = "regexp_full_match({0}, '[a-z]+')"


def _lexeme_ctes() -> str:
    return f"""
f AS (SELECT doc_id, 'id' AS field, 'A' AS label, id AS txt FROM part_papers
      UNION ALL SELECT doc_id, 'title', 'B', title FROM part_papers
      UNION ALL SELECT doc_id, 'categories', 'C', categories FROM part_papers),
ft AS (SELECT doc_id, field, label, list_filter(string_split_regex(lower(coalesce(txt, '')), '[^a-z0-9]+'),
              lambda x: x <> '') AS tk FROM f),
t AS (SELECT doc_id, field, label, unnest(generate_series(0, len(tk) - 1)) AS pos, unnest(tk) AS term FROM ft),
lex AS (SELECT doc_id, field, label,
               CAST(CASE label WHEN 'A' THEN 1.0 WHEN 'B' THEN 0.4 WHEN 'C' THEN 0.2 ELSE 0.1 END AS DOUBLE) AS weight,
               CAST(pos AS INTEGER) AS pos,
               CASE WHEN {ALPHA.format('t.term')} THEN s.stem ELSE t.term END AS term
        FROM t LEFT JOIN stems s ON s.word = t.term
        WHERE NOT ({ALPHA.format('t.term')} AND list_contains({PG_STOP}, t.term)))"""


def _ft_query_ctes(queries_sql: str) -> str:
    return f"""
fq AS ({queries_sql}),
fw AS (SELECT query_id, lower(unnest(list_filter(string_split_regex(regexp_replace(text, '[^A-Za-z0-9 ]+', ' ', 'g'),
              ' +'), lambda x: x <> ''))) AS w FROM fq),
fqt AS (SELECT DISTINCT query_id, CASE WHEN {ALPHA.format('w')} THEN s.stem ELSE w END AS term
        FROM fw LEFT JOIN stems s ON s.word = fw.w
        WHERE NOT ({ALPHA.format('w')} AND list_contains({PG_STOP}, w))),
fs AS (SELECT query_id, doc_id, round(sum(weight), 6) AS similarity FROM fqt JOIN lex USING (term) GROUP BY ALL),
franked AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, doc_id) AS BIGINT)
                   AS rank, doc_id, similarity FROM fs)"""


def _cos_part_ctes(queries_sql: str) -> str:
    """Cosine ranking over the stemmed part index for (query_id, text) rows."""
    return f"""{PART_INDEX},
qsrc AS ({queries_sql}),
qt AS (SELECT query_id, unnest({lower_list_sql(clean_tokens_sql('text'))}) AS word FROM qsrc),
qt2 AS (SELECT query_id, CASE WHEN {ALPHA.format('word')} THEN s.stem ELSE word END AS term
        FROM qt LEFT JOIN stems s USING (word) WHERE NOT list_contains({STOP}, word)),
qtf AS (SELECT query_id, term, count(*) AS qtf FROM qt2 GROUP BY ALL),
qw AS (SELECT query_id, term, qtf, idf, (1 + ln(qtf)) * idf AS qweight FROM qtf JOIN df USING (term)),
qn AS (SELECT query_id, sqrt(sum(qweight * qweight)) AS qnorm FROM qw GROUP BY query_id),
dot AS (SELECT query_id, doc_id, sum(qweight * weight) AS dot FROM qw JOIN w USING (term) GROUP BY ALL),
sim AS (SELECT query_id, doc_id, round(CASE WHEN qnorm * norm = 0 THEN 0.0 ELSE dot / (qnorm * norm) END, 6)
               AS similarity FROM dot JOIN qn USING (query_id) JOIN norms USING (doc_id)),
ranked AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, doc_id)
                  AS BIGINT) AS rank, doc_id, similarity FROM sim)"""


def _one_query(text: str) -> str:
    return f"SELECT CAST(0 AS BIGINT) AS query_id, {sql_str(text)} AS text"


def _sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["remove_special_characters"] = f"SELECT doc_id, {special_sql('text')} AS cleaned FROM documents"
    q["remove_punctuation"] = f"SELECT doc_id, {punct_sql('text')} AS cleaned FROM documents"
    q["remove_url"] = (f"SELECT page_id, {url_sql('url_x')} AS cleaned, "
                       f"{url_sql('html')} AS cleaned_html FROM "
                       f"(SELECT page_id, html, concat(url, {sql_str(C.URL_SUFFIX)}) AS url_x FROM pages)")
    clean_pos = (f"SELECT doc_id, CAST(unnest(generate_series(0, len(tk) - 1)) AS INTEGER) AS pos, unnest(tk) AS token "
                 f"FROM (SELECT doc_id, {clean_tokens_sql('text')} AS tk FROM documents)")
    q["clean_tokens"] = clean_pos
    q["stopword_filter_doc"] = f"SELECT * FROM ({clean_pos}) WHERE NOT list_contains({STOP}, token)"
    q["stopword_filter_query"] = (
        f"SELECT * FROM (SELECT item_id AS query_id, CAST(unnest(generate_series(0, len(tk) - 1)) AS INTEGER) AS pos, "
        f"unnest(tk) AS token FROM (SELECT item_id, {lower_list_sql(clean_tokens_sql('text'))} AS tk FROM benchmark)) "
        f"WHERE NOT list_contains({STOP}, token)")
    q["search_text"] = f"WITH {PART_PAPERS} SELECT doc_id, {PART_TEXT} AS text FROM part_papers"
    q["sanitize_query"] = ("SELECT item_id, array_to_string(list_filter(string_split_regex(regexp_replace(text, "
                           "'[^A-Za-z0-9 ]+', ' ', 'g'), ' +'), lambda x: x <> ''), ' | ') AS query FROM benchmark")
    q["truncate_display"] = "SELECT doc_id, substring(text, 1, 40) AS short_text FROM documents"
    proj = ("CASE WHEN NOT json_exists(props, '$.{0}') THEN ' ' WHEN json_type(props, '$.{0}') = 'NULL' THEN NULL "
            "WHEN json_type(props, '$.{0}') = 'VARCHAR' THEN json_extract_string(props, '$.{0}') "
            "ELSE CAST(json_extract(props, '$.{0}') AS VARCHAR) END")
    q["project_paper"] = f"SELECT event_id, {proj.format('k')} AS k, {proj.format('missing')} AS missing FROM events"
    q["json_round_trip"] = ("SELECT CAST(to_json(struct_pack(p_partkey := p_partkey, p_name := p_name, "
                            "p_brand := p_brand, p_type := p_type, p_size := p_size, p_retailprice := p_retailprice)) AS VARCHAR) AS json FROM part")
    q["limit_corpus"] = f"SELECT doc_id, lang, n_chars FROM documents ORDER BY doc_id LIMIT {C.CORPUS_LIMIT}"
    cols = "id, submitter, authors, title, comments, journal_ref, doi, abstract, categories, versions"
    q["list_papers"] = f"WITH {PART_PAPERS} SELECT {cols} FROM part_papers ORDER BY title, id"
    q["get_paper"] = f"WITH {PART_PAPERS} SELECT {cols} FROM part_papers WHERE id = '7'"
    token = "|".join(T.TOKEN_SHAPES)
    sign = "[\\p{N}]"
    kind = (f"CASE WHEN contains(token, '@') THEN 'email' WHEN contains(token, '.') THEN 'host' WHEN contains(token, '-') THEN 'compound' "
            f"WHEN regexp_full_match(token, '{sign}+') THEN 'number' WHEN regexp_matches(token, '{sign}') THEN 'numword' ELSE 'word' END")
    scan = (f"SELECT id, CAST(pos AS INTEGER) AS pos, {kind} AS kind, token FROM (SELECT id, unnest(generate_series(0, len(tk) - 1)) AS pos, unnest(tk) AS token "
            f"FROM (SELECT id, flatten([CASE WHEN contains(t, '@') OR contains(t, '.') OR NOT contains(t, '-') THEN [t] "
            f"ELSE list_concat([t], string_split(t, '-')) END for t in regexp_extract_all(lower(text), '{token}')]) AS tk FROM source))")
    q["scan_lexemes"] = f"WITH source AS (SELECT doc_id AS id, text FROM documents) {scan}"
    q["scan_lexemes_pages"] = f"WITH source AS (SELECT page_id AS id, concat_ws(' ', url, html) AS text FROM pages) {scan}"
    bad = "p_partkey % 7 = 0 OR p_partkey % 11 = 0 OR p_partkey % 13 = 0"
    line = "CAST(to_json(struct_pack(id := CAST(p_partkey AS VARCHAR), title := p_name, categories := p_type)) AS VARCHAR)"
    q["paper_rejects"] = (
        f"SELECT 'record' AS kind, CAST(p_partkey AS VARCHAR) AS id, p_name AS title, ' ' AS doi, CAST(NULL AS VARCHAR) AS reason, "
        f"CAST(NULL AS VARCHAR) AS line FROM part WHERE NOT ({bad}) UNION ALL SELECT 'reject', NULL, NULL, NULL, "
        f"CASE WHEN p_partkey % 7 = 0 THEN 'not JSON' WHEN p_partkey % 11 = 0 THEN 'not an object' ELSE 'empty line' END, "
        f"CASE WHEN p_partkey % 7 = 0 THEN substr({line}, 1, length({line}) - 5) WHEN p_partkey % 11 = 0 THEN '[1, 2]' ELSE '  ' END "
        f"FROM part WHERE {bad}")
    q["table_ranges"] = (
        f"WITH o AS (SELECT CASE WHEN o_orderkey % 10 <> 0 THEN o_orderkey END AS key, o_custkey FROM orders), "
        f"b AS (SELECT min(key) AS low, max(key) AS high FROM o), "
        f"dealt AS (SELECT o.*, CASE WHEN key IS NULL THEN {C.RANGES} ELSE (SELECT max(i) FROM range({C.RANGES}) r(i) "
        f"WHERE key >= low + (high - low + 1) * i // {C.RANGES}) END AS part FROM o, b) "
        f"SELECT CAST(part AS INTEGER) AS part, count(*) AS n, min(key) AS first, max(key) AS last, CAST(sum(o_custkey) AS BIGINT) AS customers "
        f"FROM dealt GROUP BY part")
    q["corpus_size"] = "SELECT count(*) AS n_docs FROM documents"
    q["term_frequency"] = f"WITH {DOC_INDEX} SELECT doc_id, term, tf FROM tf"
    q["document_frequency"] = f"WITH {DOC_INDEX} SELECT term, df FROM df"
    q["idf"] = f"WITH {DOC_INDEX} SELECT term, df, round(idf, 6) AS idf FROM df"
    postings = (f"WITH {DOC_INDEX} SELECT term, doc_id, tf, round(idf, 6) AS idf, round(weight, 6) AS weight FROM w")
    q["posting_weights"] = postings
    q["document_norms"] = f"WITH {DOC_INDEX} SELECT doc_id, round(norm, 6) AS norm FROM norms"
    q["posting_lists"] = f"WITH {DOC_INDEX} SELECT term, round(idf, 6) AS idf, doc_id, round(weight, 6) AS weight FROM w"
    normal = "round(CASE WHEN norm = 0 THEN 0.0 ELSE weight / norm END, 6)"
    none = "CAST(NULL AS {0})"
    # Read once for each written table: every step is computed once.
    stored = re.sub(r"\b(tf|nd|df|w|norms) AS \(", r"\1 AS MATERIALIZED (", DOC_INDEX)
    q["index_write_read"] = (
        f"WITH {stored} SELECT 'posting' AS kind, term AS name, doc_id, CAST(tf AS DOUBLE) AS a, round(weight, 6) AS b FROM w "
        f"UNION ALL SELECT 'normalised', term, doc_id, round(idf, 6), {normal} FROM w JOIN norms USING (doc_id) "
        f"UNION ALL SELECT 'term', term, {none.format('BIGINT')}, CAST(df AS DOUBLE), round(idf, 6) FROM df "
        f"UNION ALL SELECT 'norm', {none.format('VARCHAR')}, doc_id, round(norm, 6), {none.format('DOUBLE')} FROM norms "
        f"UNION ALL SELECT 'document', text, doc_id, {none.format('DOUBLE')}, {none.format('DOUBLE')} FROM documents "
        f"UNION ALL SELECT 'size', {none.format('VARCHAR')}, {none.format('BIGINT')}, n, {none.format('DOUBLE')} FROM nd")
    q["index_overwrite"] = (f"WITH {DOC_INDEX} SELECT term, doc_id, tf, round(idf, 6) AS idf, round(weight, 6) AS weight, "
                            f"{normal} AS nweight FROM w JOIN norms USING (doc_id)")
    place = "row_number() OVER (ORDER BY {0}) - 1 AS place"
    q["index_order"] = (
        f"WITH {stored} SELECT 'postings' AS kind, {place.format('term, doc_id')}, term AS name, doc_id FROM w "
        f"UNION ALL SELECT 'terms', {place.format('term')}, term, {none.format('BIGINT')} FROM df "
        f"UNION ALL SELECT 'norms', {place.format('doc_id')}, {none.format('VARCHAR')}, doc_id FROM norms "
        f"UNION ALL SELECT 'docs', {place.format('doc_id')}, {none.format('VARCHAR')}, doc_id FROM documents")
    bench_q = _query_ctes(BENCH_QUERIES)
    q["query_weights"] = (f"WITH {DOC_INDEX}, {bench_q} SELECT query_id, term, qtf, round(qweight, 6) AS qweight, "
                          f"round(qnorm, 6) AS qnorm FROM qw JOIN qn USING (query_id)")
    q["dot_products"] = f"WITH {DOC_INDEX}, {bench_q} SELECT query_id, doc_id, round(dot, 6) AS dot FROM dot"
    q["cosine_topk"] = (f"WITH {DOC_INDEX}, {_query_ctes(FIRST_BENCH)} "
                        f"SELECT rank, doc_id, similarity FROM ranked WHERE rank <= {C.K}")
    q["cosine_topk_batch"] = f"WITH {DOC_INDEX}, {bench_q} SELECT query_id, rank, doc_id, similarity FROM ranked WHERE rank <= {C.K}"
    for same in ("cosine_topk_batch_written", "cosine_topk_pruned", "segments_topk"):
        q[same] = q["cosine_topk_batch"]
    q["cosine_topk_written"], q["segments_norms"], q["segments_terms"] = q["cosine_topk"], q["document_norms"], q["idf"]
    q["cosine_topk_batch_stemmed"] = (f"WITH {_stemmed_ranking(BENCH_QUERIES)} "
                                      f"SELECT query_id, rank, doc_id, similarity FROM ranked WHERE rank <= {C.K}")
    vocabulary = (f"SELECT DISTINCT lower(tok) AS word FROM (SELECT unnest({clean_tokens_sql('text')}) AS tok FROM documents) "
                  f"WHERE NOT list_contains({STOP}, tok)")
    q["stem_documents"] = f"WITH {porter2_ctes(vocabulary)} SELECT word, stem FROM stems"
    q["cosine_topk_hydrated"] = (f"WITH {DOC_INDEX}, {bench_q} SELECT r.doc_id, r.query_id, r.rank, r.similarity, "
                                 f"d.lang, d.source, d.n_chars FROM ranked r LEFT JOIN documents d USING (doc_id) "
                                 f"WHERE r.rank <= {C.K}")
    q["cosine_topk_hydrated_store"] = q["cosine_topk_hydrated"]
    q["cosine_topk_batch_conversations"] = (
        f"WITH {_tf_ctes('conversations', 'conv_id', 'text')}, {bench_q} "
        f"SELECT query_id, rank, doc_id, similarity FROM ranked WHERE rank <= {C.K}")
    q["cosine_topk_batch_pages"] = (
        f"WITH {_tf_ctes('pages', 'page_id', 'html')}, {bench_q} "
        f"SELECT query_id, rank, doc_id, similarity FROM ranked WHERE rank <= {C.K}")
    q["stem_vocabulary"] = (f"WITH {STEMS_CTE}, words AS (SELECT DISTINCT unnest(string_split(lower(concat_ws(' ', "
                            f"p_name, p_type)), ' ')) AS word FROM part) "
                            f"SELECT word, stem FROM words JOIN stems USING (word) WHERE word <> ''")
    q["cosine_topk_stemmed"] = (f"WITH {STEMS_CTE}, {PART_PAPERS}, {_cos_part_ctes(_one_query(C.PART_STEM_QUERY))} "
                                f"SELECT rank, doc_id, similarity FROM ranked WHERE rank <= {C.K}")
    ft_base = f"WITH {STEMS_CTE}, {PART_PAPERS}, {_lexeme_ctes()}"
    q["fulltext_lexemes"] = f"{ft_base} SELECT doc_id, field, label, weight, pos, term FROM lex"
    one = f"SELECT CAST(0 AS BIGINT) AS query_id, {sql_str(C.PART_QUERY)} AS text"
    q["fulltext_topk"] = f"{ft_base}, {_ft_query_ctes(one)} SELECT rank, doc_id, similarity FROM franked WHERE rank <= {C.K}"
    names = "SELECT DISTINCT p_name AS query_id, p_name AS text FROM part"
    q["fulltext_topk_batch"] = (f"{ft_base}, {_ft_query_ctes(names)} SELECT query_id, rank, doc_id, similarity "
                                f"FROM franked WHERE rank <= {C.K}")
    # compare: cosine (stemmed part index) and fulltext on the same queries
    q["compare_rankers"] = (
        f"WITH {STEMS_CTE}, {PART_PAPERS}, {_cos_part_ctes(_one_query(C.PART_QUERY))}, {_lexeme_ctes()}, "
        f"{_ft_query_ctes(one)} "
        f"SELECT 'cosine' AS ranker, rank, doc_id, similarity FROM ranked WHERE rank <= {C.K} "
        f"UNION ALL SELECT 'fulltext' AS ranker, rank, doc_id, similarity FROM franked WHERE rank <= {C.K}")
    q["compare_rankers_batch"] = (
        f"WITH {STEMS_CTE}, {PART_PAPERS}, {_cos_part_ctes(names)}, {_lexeme_ctes()}, {_ft_query_ctes(names)} "
        f"SELECT 'cosine' AS ranker, query_id, rank, doc_id, similarity FROM ranked WHERE rank <= {C.K} "
        f"UNION ALL SELECT 'fulltext' AS ranker, query_id, rank, doc_id, similarity FROM franked WHERE rank <= {C.K}")
    info = ", ".join(
        f'"{f}" := ' + (sql_str(C.FULLTEXT_ABSENT[f]) if f in C.FULLTEXT_ABSENT else f"p.{f}")
        for f in C.RESULT_FIELDS)
    q["result_rows"] = (
        f"{ft_base}, {_ft_query_ctes(one)} SELECT r.rank, r.similarity AS val, "
        f"CAST(to_json(struct_pack({info})) AS VARCHAR) AS info "
        f"FROM franked r JOIN part_papers p USING (doc_id) WHERE r.rank <= {C.K}")
    strings = (f"WITH {STEMS_CTE}, {PART_PAPERS.replace('p_partkey AS doc_id', chr(39) + 'p' + chr(39) + ' || p_partkey AS doc_id')}, "
               f"{_cos_part_ctes(_one_query(C.PART_QUERY))}, {_lexeme_ctes()}, {_ft_query_ctes(one)}, "
               f"both_ AS (SELECT 'cosine' AS ranker, rank, doc_id, similarity FROM ranked WHERE rank <= {C.K} "
               f"UNION ALL SELECT 'fulltext', rank, doc_id, similarity FROM franked WHERE rank <= {C.K})")
    q["compare_rankers_string_ids"] = f"{strings} SELECT ranker, rank, doc_id, similarity FROM both_"
    own = ", ".join(f'"{f}" := p.{f.replace("-", "_")}' for f in C.RESULT_FIELDS)
    q["compare_results"] = (f"{strings} SELECT ranker, rank, similarity AS val, CASE ranker WHEN 'cosine' "
                            f"THEN CAST(to_json(struct_pack({own})) AS VARCHAR) ELSE CAST(to_json(struct_pack({info})) AS VARCHAR) END AS info "
                            f"FROM both_ JOIN part_papers p USING (doc_id)")
    q["fulltext_write_read"] = q["build_fulltext_search"] = q["fulltext_topk_pruned"] = q["fulltext_topk_batch"]
    scanned = PART_PAPERS.replace("p_partkey AS doc_id", "CAST(p_partkey AS VARCHAR) AS doc_id")
    blank = ", ".join(f'"{f}" := ' + (f"p.{f}" if f in ("id", "authors", "title", "categories", "abstract") else "' '") for f in C.RESULT_FIELDS)
    q["paper_corpus"] = (f"WITH {STEMS_CTE}, {scanned}, {_cos_part_ctes(_one_query(C.PART_STEM_QUERY))} "
                         f"SELECT rank, similarity AS val, CAST(to_json(struct_pack({blank})) AS VARCHAR) AS info "
                         f"FROM ranked JOIN part_papers p USING (doc_id) WHERE rank <= {C.K}")
    q["merge_counts"] = f"WITH {DOC_INDEX} SELECT doc_id, term, tf FROM tf"
    q["merge_index"] = postings
    return q


ORACLE_SQL = _sql()
