"""English (Porter2 / Snowball) stemming in Arrow batches.

``porter2`` is a small per-word helper written from the published algorithm.
The batch functions call it once per distinct word of an Arrow batch, on
counts that are already aggregated by (doc, word), and the counts are summed
again by (doc, stem). See ``stem_terms``.
"""

from __future__ import annotations

import re
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Fixed values of the published English Snowball algorithm.
# --------------------------------------------------------------------------
VOWELS = "aeiouy"
DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
LI_ENDINGS = "cdeghkmnrt"
R1_PREFIXES = ("gener", "commun", "arsen")
EXCEPTIONS = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli",
    "singly": "singl", "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas",
    "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
AFTER_1A_INVARIANT = ("inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed")
STEP2 = (
    ("ization", "ize"), ("ational", "ate"), ("fulness", "ful"), ("ousness", "ous"),
    ("iveness", "ive"), ("tional", "tion"), ("biliti", "ble"), ("lessli", "less"),
    ("entli", "ent"), ("ation", "ate"), ("alism", "al"), ("aliti", "al"), ("ousli", "ous"),
    ("iviti", "ive"), ("fulli", "ful"), ("enci", "ence"), ("anci", "ance"), ("abli", "able"),
    ("izer", "ize"), ("ator", "ate"), ("alli", "al"), ("bli", "ble"), ("ogi", "og"), ("li", ""),
)
STEP3 = (
    ("ational", "ate"), ("tional", "tion"), ("alize", "al"), ("icate", "ic"), ("iciti", "ic"),
    ("ative", ""), ("ical", "ic"), ("ness", ""), ("ful", ""),
)
STEP4 = (
    "ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ism", "ate", "iti",
    "ous", "ive", "ize", "ion", "al", "er", "ic",
)
# --------------------------------------------------------------------------


def _region_start(w: str, start: int) -> int:
    """Index after the first non-vowel that follows a vowel, from ``start``."""
    for i in range(start + 1, len(w)):
        if w[i] not in VOWELS and w[i - 1] in VOWELS:
            return i + 1
    return len(w)


def _short_syllable_at_end(w: str) -> bool:
    n = len(w)
    if n >= 3:
        return w[-3] not in VOWELS and w[-2] in VOWELS and w[-1] not in VOWELS and w[-1] not in "wxY"
    return n == 2 and w[0] in VOWELS and w[1] not in VOWELS


def _has_vowel(s: str) -> bool:
    return any(ch in VOWELS for ch in s)


def porter2(word: str) -> str:
    """Stem one word (the word is lower-cased first)."""
    w = word.lower()
    if len(w) <= 2:
        return w
    if w in EXCEPTIONS:
        return EXCEPTIONS[w]
    w = w.replace("’", "'").replace("‘", "'").replace("‛", "'")
    if w.startswith("'"):
        w = w[1:]
    if not w:
        return w
    # mark consonant y
    chars = list(w)
    if chars[0] == "y":
        chars[0] = "Y"
    for i in range(1, len(chars)):
        if chars[i] == "y" and chars[i - 1] in VOWELS:
            chars[i] = "Y"
    w = "".join(chars)

    r1 = None
    for p in R1_PREFIXES:
        if w.startswith(p):
            r1 = len(p)
            break
    if r1 is None:
        r1 = _region_start(w, 0)
    r2 = _region_start(w, r1)

    # step 0
    for suf in ("'s'", "'s", "'"):
        if w.endswith(suf):
            w = w[: -len(suf)]
            break

    # step 1a
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith("ied") or w.endswith("ies"):
        w = w[:-2] if len(w) > 4 else w[:-1]
    elif w.endswith("us") or w.endswith("ss"):
        pass
    elif w.endswith("s"):
        if _has_vowel(w[:-2]):
            w = w[:-1]

    if w in AFTER_1A_INVARIANT:
        return w

    # step 1b
    for suf in ("eedly", "ingly", "edly", "eed", "ing", "ed"):
        if w.endswith(suf):
            if suf in ("eed", "eedly"):
                if len(w) - len(suf) >= r1:
                    w = w[: -len(suf)] + "ee"
            else:
                stem = w[: -len(suf)]
                if _has_vowel(stem):
                    w = stem
                    if w.endswith(("at", "bl", "iz")):
                        w += "e"
                    elif w.endswith(DOUBLES):
                        w = w[:-1]
                    elif r1 >= len(w) and _short_syllable_at_end(w):
                        w += "e"
            break

    # step 1c
    if len(w) > 2 and w[-1] in "yY" and w[-2] not in VOWELS:
        w = w[:-1] + "i"

    # step 2
    for suf, rep in STEP2:
        if w.endswith(suf):
            if len(w) - len(suf) >= r1:
                if suf == "ogi":
                    if len(w) >= 4 and w[-4] == "l":
                        w = w[:-3] + rep
                elif suf == "li":
                    if len(w) >= 3 and w[-3] in LI_ENDINGS:
                        w = w[:-2]
                else:
                    w = w[: -len(suf)] + rep
            break

    # step 3
    for suf, rep in STEP3:
        if w.endswith(suf):
            if len(w) - len(suf) >= r1:
                if suf == "ative":
                    if len(w) - len(suf) >= r2:
                        w = w[: -len(suf)]
                else:
                    w = w[: -len(suf)] + rep
            break

    # step 4
    for suf in STEP4:
        if w.endswith(suf):
            if len(w) - len(suf) >= r2:
                if suf == "ion":
                    if len(w) >= 4 and w[-4] in "st":
                        w = w[:-3]
                else:
                    w = w[: -len(suf)]
            break

    # step 5
    if w.endswith("e"):
        if len(w) - 1 >= r2 or (len(w) - 1 >= r1 and not _short_syllable_at_end(w[:-1])):
            w = w[:-1]
    elif w.endswith("l"):
        if len(w) - 1 >= r2 and len(w) >= 2 and w[-2] == "l":
            w = w[:-1]

    return w.replace("Y", "y")


# Ship this module's code with the UDF, so executors need no installed copy
# of the package (a cluster may still install it; both work).
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@F.pandas_udf(T.StringType())
def stem_udf(words: pd.Series) -> pd.Series:
    """Stems of a batch of words, one lookup per distinct word."""
    table = {w: porter2(w) for w in words.dropna().unique()}
    return words.map(table)


def stem(col) -> Column:
    return stem_udf(F.col(col) if isinstance(col, str) else col)


def stem_vocabulary(words: DataFrame, word_col: str = "term") -> DataFrame:
    """(word, stem) for every distinct word of ``words``."""
    vocab = words.select(F.col(word_col).alias("word")).where(F.col("word").isNotNull()).distinct()
    return vocab.select("word", stem("word").alias("stem"))


@F.pandas_udf(T.ArrayType(T.StringType()))
def stem_words_udf(lists: pd.Series) -> pd.Series:
    """Words and hyphenated words of each list stemmed, others unchanged; one lookup per distinct word of a batch."""
    words = {w for ws in lists if ws is not None for w in ws}
    table = {w: porter2(w) if re.fullmatch("[^\\W\\d_]+(?:-[^\\W\\d_]+)*", w) else w for w in words}
    return lists.map(lambda ws: None if ws is None else [table[w] for w in ws])


def stem_terms(counts: DataFrame, key_cols: list[str], term_col: str = "term", count_col: str = "tf") -> DataFrame:
    """Replace each term of an aggregated count table by its stem and re-sum.

    The stemmer runs on Arrow batches of the counts, once per distinct word of a
    batch: no vocabulary table, no join, so no word gathers its rows anywhere.
    The re-aggregation sums counts of words that share a stem.
    """
    return counts.withColumn(term_col, stem(term_col)).groupBy(*key_cols, term_col).agg(
        F.sum(count_col).cast("long").alias(count_col))
