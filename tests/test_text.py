import pytest
from pyspark.sql import functions as F

from docrank.functions import text as T

CLEAN_GOLDENS = [
    ("state-of-the-art", "stateoftheart"),
    ("don't", "dont"),
    ("don’t", "don’t"),
    ("foo “bar”", "foobar”"),
    ("a👏b", "ab"),
    ("‘z’", "z’"),
    ("10€", "10"),
    ("[k]{j}~", "k j"),
    ("q😀_w", "q😀 w"),
]


def _one(spark, value, expr):
    df = spark.createDataFrame([(value,)], "t string")
    return df.select(expr(F.col("t")).alias("x")).first()["x"]


@pytest.mark.parametrize("raw,expected", CLEAN_GOLDENS)
def test_special_then_punctuation(spark, raw, expected):
    out = _one(spark, raw, lambda c: T.remove_punctuation(T.remove_special_characters(c)))
    assert " ".join(out.split()) == expected


def test_special_characters_sequential_quirk(spark):
    # deleting '"' first creates ' “', which the next step then deletes
    assert _one(spark, 'x "“y', T.remove_special_characters) == "xy"
    # a space, then a later-class character, then the quote: the quote stays
    assert _one(spark, "x -“y", T.remove_special_characters) == "x “y"


def _sequential(text):
    for s in T.SPECIAL_CHARACTERS:
        text = text.replace(s, "")
    return text


def test_one_pass_deletion_equals_sequential(spark):
    import random
    rnd = random.Random(7)
    alphabet = list("ab “\"'&?-—€‘") + ["👏", "😀"]
    samples = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 12))) for _ in range(400)]
    df = spark.createDataFrame([(s,) for s in samples], "t string")
    got = [r["x"] for r in df.select(T.remove_special_characters("t").alias("x")).collect()]
    assert got == [_sequential(s) for s in samples]


def test_remove_url_alone(spark):
    assert _one(spark, "see https://t.co/AbCdEf1234 now", T.remove_url) == "see  now"
    assert _one(spark, "https://example.org/x", T.remove_url) == "https://example.org/x"
    # the dot is a wildcard once a true prefix occurs
    assert _one(spark, "https://t.co/AbCdEf1234 https://tXco/QwErTy5678", T.remove_url) == " "
    # without a true prefix nothing is removed
    assert _one(spark, "https://tXco/QwErTy5678", T.remove_url) == "https://tXco/QwErTy5678"


def test_remove_url_is_noop_inside_clean_text(spark):
    toks = _one(spark, "see https://t.co/AbCdEf1234 now", T.clean_text)
    assert toks == ["see", "https", "t", "co", "AbCdEf1234", "now"]


def test_tokenizer_contractions_and_quotes(spark):
    assert _one(spark, "cannot wanna go", T.clean_text) == ["can", "not", "wan", "na", "go"]
    assert _one(spark, "don’t", T.clean_text) == ["don", "’", "t"]
    assert _one(spark, "Gimme gonna gotta lemme", T.clean_text) == ["Gim", "me", "gon", "na", "got", "ta", "lem", "me"]
    # wanna splits before whitespace, a quote or the end; cannot needs word boundaries
    assert _one(spark, "wanna", T.clean_text) == ["wan", "na"]
    assert _one(spark, "wanna’", T.clean_text) == ["wan", "na", "’"]
    assert _one(spark, "wannax wanna😀", T.clean_text) == ["wannax", "wanna😀"]
    assert _one(spark, "xcannot cannotx", T.clean_text) == ["xcannot", "cannotx"]
    assert _one(spark, "«a» „b“", T.clean_text) == ["«", "a", "»", "„", "b", "“"]


def test_stopword_case_rule(spark):
    df = spark.createDataFrame([(["The", "the", "moon", "aqui", "u"],)], "a array<string>")
    sens = df.select(T.remove_stopwords(F.col("a"), True).alias("x")).first()["x"]
    insens = df.select(T.remove_stopwords(F.col("a"), False).alias("x")).first()["x"]
    assert sens == ["The", "moon"]
    assert insens == ["moon"]


def test_stop_lists():
    assert len(T.ENGLISH_STOPWORDS) == 179
    assert len([w for w in T.ENGLISH_STOPWORDS if "'" not in w]) == 153
    assert len(T.FULLTEXT_STOPWORDS) == 127 and T.FULLTEXT_STOPWORDS[-1] == "now"


def test_sanitize_and_truncate(spark):
    assert _one(spark, "fly me-to the moon!", T.sanitize_query) == "fly | me | to | the | moon"
    assert _one(spark, "x" * 50, T.truncate_display) == "x" * 40


def test_search_text_missing_fields(spark):
    df = spark.createDataFrame([("id1", None, "title")], "id string, a string, t string")
    assert df.select(T.search_text("id", "a", "t").alias("x")).first()["x"] == "id1   title"
