"""The Spark cleaning/tokenising expressions against a plain-Python model of
the same rules, on random strings built from the tricky pieces."""

import random
import re
import string

from pyspark.sql import functions as F

from docrank.functions import text as T

PUNCT = re.compile("[%s]" % re.escape(string.punctuation))


def model_tokens(text: str) -> list[str]:
    for s in T.SPECIAL_CHARACTERS:          # ordered deletions
        text = text.replace(s, "")
    text = PUNCT.sub(" ", text)
    text = re.sub(r"([«“‘„])", r" \1 ", text)       # starting quotes
    text = " " + text + " "                       # padding before ending quotes and contractions
    text = re.sub(r"([»”’])", r" \1 ", text)       # ending quotes
    for a, b in T.SPLIT_CONTRACTIONS:
        text = re.sub(rf"(?i)\b({a})({b})\b", r" \1 \2 ", text)
    for a, b in T.SPLIT_BEFORE_SPACE:
        text = re.sub(rf"(?i)\b({a})({b})(?=\s)", r" \1 \2 ", text)
    return text.split()


PIECES = ["can", "not", "Can", "NOT", "wan", "na", "gim", "me", "gon", "got", "ta", "lem", "x", "é", "2", "_",
          " ", " ", "\n", "\t", " ", " ", "«", "“", "‘", "„", "»", "”", "’", "'", '"', "-", "—", "!", "?",
          "😀", "👏", "€", "ü", "ß", ".", ",", "/", ":"]


def test_spark_tokenizer_equals_model(spark):
    rnd = random.Random(11)
    samples = ["".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 14))) for _ in range(3000)]
    samples += ["cannot", "wanna", "wanna’", "Gimme”", "“gotta", "lemme go", "x-cannot", "cannot_", "wanna\n"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(samples)], "i long, t string")
    got = {r["i"]: r["x"] for r in df.select("i", T.clean_text("t").alias("x")).collect()}
    bad = [(s, got[i], model_tokens(s)) for i, s in enumerate(samples) if got[i] != model_tokens(s)]
    assert not bad, bad[:5]
