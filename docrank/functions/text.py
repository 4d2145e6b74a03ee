"""Text cleaning, tokenising and stop-word filtering as Spark Column
expressions (JVM-side, inside whole-stage codegen where Spark allows it).

Every function takes and returns a ``Column`` so callers compose them inside
``select``/``withColumn``; nothing here touches Python per row.

Order of the cleaning steps (all deciding the final tokens):
  1. delete the special strings (``remove_special_characters``),
  2. replace every ASCII punctuation character by a space,
  3. delete short t.co links (a no-op after step 2: no '/' is left),
  4. tokenise: isolate curly/angle quotes, split six fused contractions,
     split on whitespace.
Each step is one regex pass over the text (each pass converts the text
between Spark's UTF-8 form and a Java string, so passes are kept few).
"""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# --------------------------------------------------------------------------
# Fixed values that must equal the reference for identical results.
# --------------------------------------------------------------------------

# Strings deleted from the text, applied one after another in this order.
SPECIAL_CHARACTERS = (
    '"', "'", "º", "&", "¿", "?", "¡", "!", " “", "…", "👏",
    "-", "—", "‘", "•", "›", "‼", "€", "£", "↑", "→", "↓", "↔",
    "↘", "↪", "√", "∧", "⊃", "⌒", "⌛", "⏬", "⏯", "⏰", "⏹",
)

# English stop words of the NLTK corpus, in the corpus order.
ENGLISH_STOPWORDS = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "you're",
    "you've", "you'll", "you'd", "your", "yours", "yourself", "yourselves", "he",
    "him", "his", "himself", "she", "she's", "her", "hers", "herself", "it", "it's",
    "its", "itself", "they", "them", "their", "theirs", "themselves", "what", "which",
    "who", "whom", "this", "that", "that'll", "these", "those", "am", "is", "are",
    "was", "were", "be", "been", "being", "have", "has", "had", "having", "do",
    "does", "did", "doing", "a", "an", "the", "and", "but", "if", "or", "because",
    "as", "until", "while", "of", "at", "by", "for", "with", "about", "against",
    "between", "into", "through", "during", "before", "after", "above", "below",
    "to", "from", "up", "down", "in", "out", "on", "off", "over", "under", "again",
    "further", "then", "once", "here", "there", "when", "where", "why", "how", "all",
    "any", "both", "each", "few", "more", "most", "other", "some", "such", "no",
    "nor", "not", "only", "own", "same", "so", "than", "too", "very", "s", "t", "can",
    "will", "just", "don", "don't", "should", "should've", "now", "d", "ll", "m", "o",
    "re", "ve", "y", "ain", "aren", "aren't", "couldn", "couldn't", "didn", "didn't",
    "doesn", "doesn't", "hadn", "hadn't", "hasn", "hasn't", "haven", "haven't", "isn",
    "isn't", "ma", "mightn", "mightn't", "mustn", "mustn't", "needn", "needn't",
    "shan", "shan't", "shouldn", "shouldn't", "wasn", "wasn't", "weren", "weren't",
    "won", "won't", "wouldn", "wouldn't",
)

# Extra stop tokens added on top of the English list.
EXTRA_STOPWORDS = ("?", "aqui", ".", ",", "»", "«", "â", "ã", ">", "<", "(", ")", "º", "u")

# Quote characters the word tokenizer always puts in tokens of their own.
ISOLATED_QUOTES = ("«", "“", "‘", "„", "»", "”", "’")

# Fused words the word tokenizer splits in two (case-insensitive); the last
# one only when followed by whitespace.
SPLIT_CONTRACTIONS = (("can", "not"), ("gim", "me"), ("gon", "na"), ("got", "ta"), ("lem", "me"))
SPLIT_BEFORE_SPACE = (("wan", "na"),)

# Short-link pattern removed by remove_url; the dot is deliberately a
# wildcard, as in the original expression.
URL_PREFIX = "https://t.co/"
URL_PATTERN_BODY_LEN = 10

# --------------------------------------------------------------------------

STOPWORDS = ENGLISH_STOPWORDS + EXTRA_STOPWORDS

# PostgreSQL's english stop file is the NLTK list up to "now" without the
# apostrophe forms (127 words); used by the weighted full-text ranker.
FULLTEXT_STOPWORDS = tuple(
    w for w in ENGLISH_STOPWORDS[: ENGLISH_STOPWORDS.index("now") + 1] if "'" not in w
)

# Python's str.split() whitespace, spelled out so Spark (Java regex) and
# DuckDB (RE2) split exactly alike.
WHITESPACE_CLASS = (
    "[\\x{9}-\\x{D}\\x{1C}-\\x{20}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}"
    "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"
)
# Python's \w for str patterns: letters, numbers, underscore.
WORD_CLASS = "[\\p{L}\\p{N}_]"


def char_class(chars) -> str:
    """A regex character class listing ``chars`` by code point (Java and RE2)."""
    return "[" + "".join("\\x{%X}" % ord(c) for c in chars) + "]"


def literal_pattern(s: str) -> str:
    return "".join("\\x{%X}" % ord(c) for c in s)


def deletion_patterns(strings) -> list[str]:
    """Turn an ordered list of strings to delete into the fewest regexes that
    delete exactly the same text: runs of single characters commute, so each
    run becomes one character class; a longer string keeps its own step."""
    out: list[str] = []
    run: list[str] = []
    for s in strings:
        if len(s) == 1:
            run.append(s)
            continue
        if run:
            out.append(char_class(run))
            run = []
        out.append(literal_pattern(s))
    if run:
        out.append(char_class(run))
    return out


PUNCTUATION_PATTERN = char_class(string.punctuation)
QUOTE_PATTERN = char_class(ISOLATED_QUOTES)
URL_PATTERN = "https://t.co/" + WORD_CLASS + "{%d}" % URL_PATTERN_BODY_LEN


def _one_pass_deletion(strings) -> str:
    """One regex deleting exactly what the ordered deletions delete, for the
    shape of SPECIAL_CHARACTERS: single characters (class c1), one space +
    quote string, single characters (class c2). Deleting c1 first can join a
    space and the quote, so that step becomes "space, any c1, quote"."""
    steps = deletion_patterns(strings)
    if len(steps) != 3 or not steps[0].startswith("[") or not steps[2].startswith("["):
        raise ValueError("unexpected deletion list shape")
    multi = [x for x in strings if len(x) > 1][0]
    head, tail = literal_pattern(multi[:-1]), literal_pattern(multi[-1])
    return f"{steps[0]}|{head}{steps[0]}*{tail}|{steps[2]}"


SPECIAL_ONE_PASS = _one_pass_deletion(SPECIAL_CHARACTERS)


def _tokenizer_pattern() -> str:
    """One pass isolating quote characters and the first half of fused words;
    both become " match " and the text is then split on whitespace. A fused
    word counts only at word boundaries; the before-space form also splits
    before a quote character or at the end (the tokenizer pads the text with
    spaces and isolates quotes before splitting fused words)."""
    alts = [f"{a}(?={b}(?!{WORD_CLASS}))" for a, b in SPLIT_CONTRACTIONS] + [
        f"{a}(?={b}(?:{WHITESPACE_CLASS}|{QUOTE_PATTERN}|$))" for a, b in SPLIT_BEFORE_SPACE
    ]
    return f"(?i){QUOTE_PATTERN}|(?<!{WORD_CLASS})(?:" + "|".join(alts) + ")"


TOKENIZER_PATTERN = _tokenizer_pattern()


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def remove_special_characters(col) -> Column:
    return F.regexp_replace(_c(col), SPECIAL_ONE_PASS, "")


def remove_punctuation(col) -> Column:
    return F.regexp_replace(_c(col), PUNCTUATION_PATTERN, " ")


def remove_url(col) -> Column:
    c = _c(col)
    return F.when(F.instr(c, URL_PREFIX) > 0, F.regexp_replace(c, URL_PATTERN, "")).otherwise(c)


def tokenize(col) -> Column:
    """Word tokens of already-cleaned text (no ASCII punctuation left)."""
    c = F.regexp_replace(_c(col), TOKENIZER_PATTERN, " $0 ")
    return F.array_remove(F.split(c, WHITESPACE_CLASS + "+"), "")


def clean_text(col) -> Column:
    """special characters -> punctuation -> url -> tokens (array<string>).

    After the punctuation step no '/' is left, so the short-link pattern can
    never match: the URL step is a proven no-op here and is not evaluated
    (``remove_url`` alone keeps it)."""
    return tokenize(remove_punctuation(remove_special_characters(col)))


def is_stopword(x: Column, words=STOPWORDS) -> Column:
    return x.isin(list(words))


def remove_stopwords(tokens: Column, case_sensitive: bool = True, words=STOPWORDS) -> Column:
    """Drop stop tokens from an array. ``case_sensitive`` tests the token as it
    is (document rule); otherwise its lower-case form is tested. Jobs that
    explode tokens anyway filter rows with ``is_stopword`` instead (codegen)."""
    if case_sensitive:
        return F.filter(tokens, lambda x: ~is_stopword(x, words))
    return F.filter(tokens, lambda x: ~is_stopword(F.lower(x), words))


def lowercase_tokens(tokens: Column) -> Column:
    return F.transform(tokens, lambda x: F.lower(x))


def search_text(*cols) -> Column:
    """Fields joined by one space; a missing or null field counts as ' '."""
    return F.concat_ws(" ", *[F.coalesce(_c(c).cast("string"), F.lit(" ")) for c in cols])


def query_words(col) -> Column:
    """Words of a free-text query for the weighted ranker: every run of
    characters other than ASCII letters, digits and space becomes a space."""
    s = F.regexp_replace(_c(col), "[^A-Za-z0-9 ]+", " ")
    return F.filter(F.split(s, " +"), lambda x: x != "")


def sanitize_query(col) -> Column:
    """The OR query string: words joined with ' | '."""
    return F.array_join(query_words(col), " | ")


def truncate_display(col, n: int = 40) -> Column:
    return F.substring(_c(col), 1, n)


# Token types of a field: what each looks like in lower-cased text, the first that fits from the left.
# A host or a compound has up to MOST_PARTS parts, so that no text exhausts the regex engine's stack.
_LETTER, _SIGN = "[\\p{L}\\p{M}]", "[\\p{L}\\p{M}\\p{N}]"
MOST_PARTS = "{1,64}"
TOKEN_SHAPES = (
    f"{_SIGN}[\\p{{L}}\\p{{M}}\\p{{N}}._+-]*@(?:{_SIGN}+(?:-{_SIGN}+)*\\.)+{_LETTER}{{2,}}",  # e-mail address
    f"(?:{_SIGN}+(?:-{_SIGN}+)*\\.)+{_LETTER}{{2,}}",  # host
    f"{_LETTER}{_SIGN}*(?:-{_SIGN}+)+",  # hyphenated compound
    f"{_SIGN}+",  # word or number
)
TOKEN_PATTERN = "|".join(x.replace(")+", ")" + MOST_PARTS).replace(")*", ")" + MOST_PARTS.replace("1", "0", 1)) for x in TOKEN_SHAPES)


def token_kind(token: Column) -> Column:
    """email, host, compound, number (digits only), numword (with digits) or word."""
    return (F.when(F.contains(token, F.lit("@")), "email").when(F.contains(token, F.lit(".")), "host")
            .when(F.contains(token, F.lit("-")), "compound").when(~token.rlike("[^\\p{N}]"), "number")
            .when(token.rlike("\\p{N}"), "numword").otherwise("word"))


def scan_tokens(col) -> Column:
    """Typed tokens of a field in order, array<struct<kind, token>>; a compound is followed by its parts.

    Words have letters of any script. Numbers are split at signs and points, so that the
    words of a query, which is split there too, find dotted ids."""
    tokens = F.regexp_extract_all(F.lower(_c(col)), F.lit(TOKEN_PATTERN), F.lit(0))
    with_parts = F.flatten(F.transform(tokens, lambda t: F.when(
        token_kind(t) == "compound", F.concat(F.array(t), F.split(t, "-"))).otherwise(F.array(t))))
    return F.transform(with_parts, lambda t: F.struct(token_kind(t).alias("kind"), t.alias("token")))


def lexeme_tokens(col) -> Column:
    """The scanned tokens of a field, in order."""
    return F.transform(scan_tokens(col), lambda x: x["token"])
