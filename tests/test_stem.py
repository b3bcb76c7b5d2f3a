
import pytest

from lexigram.functions.stem import stem_columns
from lexigram.operators import stemming
from lexigram.operators.stemming import stem_vocabulary, stemmed_counts, with_stems

# Published examples of the Porter algorithm and words that probe its edges: word -> stem.
STEMS = {
    "caresses": "caress", "ponies": "poni", "ties": "ti", "caress": "caress", "cats": "cat", "feed": "feed",
    "agreed": "agre", "disabled": "disabl", "matting": "mat", "mating": "mate", "meeting": "meet", "milling": "mill",
    "messing": "mess", "meetings": "meet", "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing",
    "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop", "tanned": "tan",
    "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail", "filing": "file", "happy": "happi",
    "sky": "sky", "relational": "relat", "conditional": "condit", "rational": "ration", "valenci": "valenc",
    "hesitanci": "hesit", "digitizer": "digit", "conformabli": "conform", "radicalli": "radic",
    "differentli": "differ", "vileli": "vile", "analogousli": "analog", "vietnamization": "vietnam",
    "predication": "predic", "operator": "oper", "feudalism": "feudal", "decisiveness": "decis",
    "hopefulness": "hope", "callousness": "callous", "formaliti": "formal", "sensitiviti": "sensit",
    "sensibiliti": "sensibl", "triplicate": "triplic", "formative": "form", "formalize": "formal",
    "electriciti": "electr", "electrical": "electr", "hopeful": "hope", "goodness": "good", "revival": "reviv",
    "allowance": "allow", "inference": "infer", "airliner": "airlin", "gyroscopic": "gyroscop",
    "adjustable": "adjust", "defensible": "defens", "irritant": "irrit", "replacement": "replac",
    "adjustment": "adjust", "dependent": "depend", "adoption": "adopt", "homologou": "homolog",
    "communism": "commun", "activate": "activ", "angulariti": "angular", "homologous": "homolog",
    "effective": "effect", "bowdlerize": "bowdler", "probate": "probat", "rate": "rate", "cease": "ceas",
    "controll": "control", "roll": "roll", "apologies": "apolog", "element": "element", "ion": "ion", "as": "as",
    "is": "is", "y": "y", "eed": "eed", "yes": "ye", "toy": "toi", "toys": "toi", "Cats": "Cat", "activity": "activ",
    "adaptation": "adapt", "boundaries": "boundari", "occupational": "occup", "syzygy": "syzygi", "sayings": "sai",
}


def test_known_stems(spark):
    words = spark.createDataFrame([(w,) for w in STEMS], "word string")
    assert {r.word: r.stem for r in stem_vocabulary(words).collect()} == STEMS


def test_several_columns_at_once(spark):
    pairs = spark.createDataFrame([("cats", "running", 1), ("is", None, 2)], "a string, b string, n int")
    out = stem_columns(pairs, "a", "b")
    assert out.columns == ["a", "b", "n"]
    assert [tuple(r) for r in out.orderBy("n").collect()] == [("cat", "run", 1), ("is", None, 2)]


def test_counts_roll_up(spark):
    words = spark.createDataFrame([("connected", 2), ("connecting", 3), ("it", 1)], "word string, n bigint")
    assert {r.stem: r.n for r in stemmed_counts(words).collect()} == {"connect": 5, "it": 1}


@pytest.mark.parametrize("small", [True, False])
def test_only_words_that_differ_from_their_stem_are_joined(spark, monkeypatch, small):
    kept, store = [], stemming.stored
    monkeypatch.setattr(stemming, "stored", lambda df, purpose: kept.append(store(df, purpose)) or kept[-1])
    if not small:
        monkeypatch.setattr(stemming, "broadcast_if_small", lambda df: df)
    rows = spark.createDataFrame([("cats", "running", 1), ("is", "cats", 2), ("sky", None, 3), ("it", "is", 4)], "a string, b string, n int")
    got = sorted(tuple(r) for r in with_stems(rows, "a", "b").select("a", "b", "n").collect())
    assert got == [("cat", "run", 1), ("is", "cat", 2), ("it", "is", 4)]
    assert {r.word for r in kept[0].collect()} == {"cats", "running"}
