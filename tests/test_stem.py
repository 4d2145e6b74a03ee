import pytest
from pyspark.sql import functions as F

from docrank.functions.stem import porter2, stem_terms, stem_vocabulary

PUBLISHED = {
    "caresses": "caress", "ponies": "poni", "ties": "tie", "cats": "cat", "feed": "feed", "agreed": "agre",
    "plastered": "plaster", "motoring": "motor", "sing": "sing", "conflated": "conflat", "troubled": "troubl",
    "sized": "size", "hopping": "hop", "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail",
    "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat", "conditional": "condit",
    "generously": "generous", "communication": "communic", "consignment": "consign", "knackeries": "knackeri",
    "abilities": "abil", "absolutely": "absolut", "dying": "die", "news": "news", "innings": "inning",
    "proceeded": "proceed", "cried": "cri", "flies": "fli", "syzygy": "syzygi", "yesterday": "yesterday",
    "hopeful": "hope", "goodness": "good", "allowance": "allow", "effective": "effect", "controll": "control",
}
PART_WORDS = {"large": "larg", "ECONOMY": "economi", "rings": "ring", "plates": "plate", "widgets": "widget",
              "bolts": "bolt"}
UNCHANGED = "anvil blue bolt cold gear gizmo hot new old plate red ring rod small widget medium promo standard".split()


@pytest.mark.parametrize("word,stem", sorted({**PUBLISHED, **PART_WORDS}.items()))
def test_porter2(word, stem):
    assert porter2(word) == stem


@pytest.mark.parametrize("word", UNCHANGED)
def test_unchanged(word):
    assert porter2(word) == word


def test_short_and_quotes():
    assert porter2("’") == "’"
    assert porter2("The") == "the"


def test_vocabulary_job(spark):
    df = spark.createDataFrame([("a", "rings", 2), ("a", "ring", 1), ("b", "plates", 1)], "doc_id string, term string, tf long")
    vocab = {r["word"]: r["stem"] for r in stem_vocabulary(df).collect()}
    assert vocab == {"rings": "ring", "ring": "ring", "plates": "plate"}
    out = {(r["doc_id"], r["term"]): r["tf"] for r in stem_terms(df, ["doc_id"]).collect()}
    assert out == {("a", "ring"): 3, ("b", "plate"): 1}


SAMPLE_WORDS = ("consign consigned consigning consignment consist consisted consistency consistent consistently "
                "consisting consists consolation consolations consolatory console consoled consoles consolidate "
                "consolidated consolidating consoling consolingly consols consonant consort consorted consorting "
                "conspicuous conspicuously conspiracy conspirator conspirators conspire conspired conspiring constable "
                "constables constance constancy constant knack knackeries knacks knag knave knaves knavish kneaded "
                "kneading knee kneel kneeling kneels knees knell knelt knew knick knif knife knight knightly knights "
                "knit knits knitted knitting knives knob knobs knock knocked knocker knockers knocking knocks knopp "
                "knot knots").split()
SAMPLE_STEMS = ("consign consign consign consign consist consist consist consist consist consist consist consol "
                "consol consolatori consol consol consol consolid consolid consolid consol consol consol conson "
                "consort consort consort conspicu conspicu conspiraci conspir conspir conspir conspir conspir "
                "constabl constabl constanc constanc constant knack knackeri knack knag knave knave knavish knead "
                "knead knee kneel kneel kneel knee knell knelt knew knick knif knife knight knight knight knit knit "
                "knit knit knive knob knob knock knock knocker knocker knock knock knopp knot knot").split()


def test_published_sample_vocabulary():
    assert len(SAMPLE_WORDS) == len(SAMPLE_STEMS)
    assert [porter2(w) for w in SAMPLE_WORDS] == SAMPLE_STEMS
