"""DuckDB SQL fragments that restate the text rules independently of Spark.

Used only by the oracle queries: the same fixed values (stop lists, character
lists) are rendered as SQL literals, and the tokenizer is re-expressed with
RE2 (no look-around), so a wrong Spark expression cannot hide behind a
shared one.
"""

from __future__ import annotations

from docrank.functions import stem as S
from docrank.functions import text as T


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_list(items) -> str:
    return "[" + ", ".join(sql_str(x) for x in items) + "]"


def special_sql(x: str) -> str:
    # one deletion per listed string, in the listed order
    out = x
    for s in T.SPECIAL_CHARACTERS:
        out = f"replace({out}, {sql_str(s)}, '')"
    return out


def punct_sql(x: str) -> str:
    return f"regexp_replace({x}, {sql_str(T.PUNCTUATION_PATTERN)}, ' ', 'g')"


def url_sql(x: str) -> str:
    return (f"CASE WHEN strpos({x}, 'https://t.co/') > 0 THEN "
            f"regexp_replace({x}, {sql_str(T.URL_PATTERN)}, '', 'g') ELSE {x} END")


W = T.WORD_CLASS.replace("[", "[^", 1)  # non-word class


def tokenize_sql(x: str) -> str:
    s = f"regexp_replace({x}, {sql_str(T.QUOTE_PATTERN)}, ' \\0 ', 'g')"
    for a, b in T.SPLIT_CONTRACTIONS:
        pat = f"(^|{W})({a})({b})({W}|$)"
        for _ in range(2):  # a boundary character can serve two neighbours
            s = f"regexp_replace({s}, {sql_str(pat)}, '\\1\\2 \\3\\4', 'gi')"
    for a, b in T.SPLIT_BEFORE_SPACE:
        pat = f"(^|{W})({a})({b})({T.WHITESPACE_CLASS}|$)"
        for _ in range(2):
            s = f"regexp_replace({s}, {sql_str(pat)}, '\\1\\2 \\3\\4', 'gi')"
    return f"list_filter(regexp_split_to_array({s}, {sql_str(T.WHITESPACE_CLASS + '+')}), lambda t: t <> '')"


def clean_tokens_sql(x: str) -> str:
    return tokenize_sql(url_sql(punct_sql(special_sql(x))))


def stop_filter_sql(tokens: str, words=T.STOPWORDS, lower: bool = False) -> str:
    tok = "lower(t)" if lower else "t"
    return f"list_filter({tokens}, lambda t: NOT list_contains({sql_list(words)}, {tok}))"


def lower_list_sql(tokens: str) -> str:
    return f"list_transform({tokens}, lambda t: lower(t))"


def search_text_sql(*cols: str) -> str:
    return "concat_ws(' ', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), ' ')" for c in cols) + ")"


def porter2_ctes(vocabulary_sql: str) -> str:
    """CTEs ending in stems(word, stem): the published stemming rules, step by step, over the words (column
    ``word``, lower case) of ``vocabulary_sql``. ``r1`` and ``r2`` are region starts; ``done`` ends a word early."""
    region = ("CASE WHEN regexp_matches(substr(w, {0} + 1), '[aeiouy][^aeiouy]') THEN {0} + "
              "length(regexp_extract(substr(w, {0} + 1), '(?s)^.*?[aeiouy][^aeiouy]')) ELSE length(w) END")
    cut = "left(w, greatest(length(w) - {0}, 0))"
    ends = "suffix({0}, {1})"
    short = ("(CASE WHEN length({0}) >= 3 THEN regexp_matches({0}, '[^aeiouy][aeiouy][^aeiouywxY]$') "
             "ELSE regexp_matches({0}, '^[aeiouy][^aeiouy]$') END)")
    vowel = "regexp_matches({0}, '[aeiouy]')"

    def first(rules: list[tuple[str, str]]) -> str:
        return "CASE " + " ".join(f"WHEN {ends.format('w', sql_str(s))} THEN {then}" for s, then in rules) + " ELSE w END"

    def swap(suffix: str, new: str, region_start: str, extra: str = "true") -> tuple[str, str]:
        n = len(suffix)
        return suffix, f"CASE WHEN length(w) - {n} >= {region_start} AND {extra} THEN {cut.format(n)} || {sql_str(new)} ELSE w END"

    def before(n: int, letters: str) -> str:
        return f"length(w) > {n} AND contains({sql_str(letters)}, substr(w, length(w) - {n}, 1))"

    exceptions = " ".join(f"WHEN word = {sql_str(a)} THEN {sql_str(b)}" for a, b in S.EXCEPTIONS.items())
    prefixes = " ".join(f"WHEN prefix(w, {sql_str(p)}) THEN {len(p)}" for p in S.R1_PREFIXES)
    step1b = " ".join(f"WHEN {ends.format('w', sql_str(s))} THEN {sql_str(s)}" for s in ("eedly", "ingly", "edly", "eed", "ing", "ed"))
    after = (f"CASE WHEN regexp_matches(x, '(at|bl|iz)$') THEN x || 'e' "
             f"WHEN right(x, 2) IN ({', '.join(map(sql_str, S.DOUBLES))}) THEN left(x, length(x) - 1) "
             f"WHEN r1 >= length(x) AND {short.format('x')} THEN x || 'e' ELSE x END")
    step2 = [swap(s, r, "r1", before(3, "l") if s == "ogi" else before(2, S.LI_ENDINGS) if s == "li" else "true") for s, r in S.STEP2]
    step3 = [swap(s, r, "r1", f"length(w) - {len(s)} >= r2" if s == "ative" else "true") for s, r in S.STEP3]
    step4 = [swap(s, "", "r2", before(3, "st") if s == "ion" else "true") for s in S.STEP4]
    keep = "word, done, r1, r2"
    return f"""
v0 AS ({vocabulary_sql}),
v1 AS (SELECT word, CASE WHEN length(word) <= 2 THEN word {exceptions} END AS done,
  regexp_replace(replace(replace(replace(word, '’', ''''), '‘', ''''), '‛', ''''), '^''', '') AS w FROM v0),
v2 AS (SELECT word, CASE WHEN done IS NULL AND w = '' THEN '' ELSE done END AS done,
  regexp_replace(regexp_replace(w, '^y', 'Y'), '([aeiouy])y', '\\1Y', 'g') AS w FROM v1),
v3 AS (SELECT word, done, w, CASE {prefixes} ELSE {region.format('0')} END AS r1 FROM v2),
v4 AS (SELECT word, done, w, r1, {region.format('r1')} AS r2 FROM v3),
v5 AS (SELECT {keep}, {first([("'s'", cut.format(3)), ("'s", cut.format(2)), ("'", cut.format(1))])} AS w FROM v4),
v6 AS (SELECT {keep}, CASE WHEN suffix(w, 'sses') THEN {cut.format(2)}
  WHEN suffix(w, 'ied') OR suffix(w, 'ies') THEN (CASE WHEN length(w) > 4 THEN {cut.format(2)} ELSE {cut.format(1)} END)
  WHEN suffix(w, 'us') OR suffix(w, 'ss') THEN w
  WHEN suffix(w, 's') AND {vowel.format(cut.format(2))} THEN {cut.format(1)} ELSE w END AS w FROM v5),
v7 AS (SELECT word, CASE WHEN done IS NULL AND w IN ({', '.join(map(sql_str, S.AFTER_1A_INVARIANT))}) THEN w ELSE done END AS done, r1, r2, w,
  CASE {step1b} ELSE '' END AS suf FROM v6),
v8 AS (SELECT {keep}, w, suf, left(w, length(w) - length(suf)) AS x FROM v7),
v9 AS (SELECT {keep}, CASE WHEN suf = '' THEN w
  WHEN suf IN ('eed', 'eedly') THEN (CASE WHEN length(x) >= r1 THEN x || 'ee' ELSE w END)
  WHEN {vowel.format('x')} THEN {after} ELSE w END AS w FROM v8),
v10 AS (SELECT {keep}, CASE WHEN length(w) > 2 AND regexp_matches(w, '[^aeiouy][yY]$') THEN {cut.format(1)} || 'i' ELSE w END AS w FROM v9),
v11 AS (SELECT {keep}, {first(step2)} AS w FROM v10),
v12 AS (SELECT {keep}, {first(step3)} AS w FROM v11),
v13 AS (SELECT {keep}, {first(step4)} AS w FROM v12),
v14 AS (SELECT {keep}, w, {cut.format(1)} AS x FROM v13),
v15 AS (SELECT {keep}, CASE WHEN suffix(w, 'e') THEN (CASE WHEN length(x) >= r2 OR (length(x) >= r1 AND NOT {short.format('x')}) THEN x ELSE w END)
  WHEN suffix(w, 'l') AND length(x) >= r2 AND suffix(x, 'l') THEN x ELSE w END AS w FROM v14),
stems AS (SELECT word, coalesce(done, replace(w, 'Y', 'y')) AS stem FROM v15)"""
