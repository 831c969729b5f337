import os
import random
import sys

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from termlight.functions import text as T
from termlight.functions.porter import IRREGULAR, STEP_2, STEP_3, STEP_4, stem_word
from termlight.operators.analyze import analyze, plain_tokens, stem_table

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from plain_porter import porter_stem as plain_stem  # noqa: E402


def normalized(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    out = rows.select("i", T.normalize(F.col("text")).alias("n")).orderBy("i").collect()
    return [r.n for r in out]


def tokens_of(spark, texts, **options):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    out = analyze(rows, ["doc_id"], **options).orderBy("doc_id").collect()
    return [r.tokens for r in out]


def test_normalize_goldens(spark):
    cases = {
        None: "",
        "  ": "",
        "Café <b>x</b> &amp; 42 a1": "cafe x a1",
        "see https://a.b/c now": "see now",
        "don't_stop": "don t stop",
        "Straße": "strae",
        "&#39;": "",
        "½ oﬃce №5 … Ⅷ": "office No5 viii",
    }
    assert normalized(spark, list(cases)) == list(cases.values())


@settings(max_examples=3, deadline=None, phases=[Phase.generate], suppress_health_check=list(HealthCheck))
@given(st.lists(st.sampled_from(["apple", "Pear", "x1", "<b>", "&amp;", "42", "http://a.b/c", "...", "É", "don't"]), min_size=1, max_size=12))
def test_normal_form_is_word_by_word(spark, words):
    known = {"apple": "apple", "Pear": "pear", "x1": "x1", "É": "e", "don't": "don t"}
    assert normalized(spark, [" ".join(words)]) == [" ".join(known[w] for w in words if w in known)]


def test_stop_word_fallback(spark):
    found = tokens_of(spark, ["Side A", "The two dogs of 12 cats", "of the", "two 3", "", None])
    assert found == [["side"], ["dogs", "cats"], ["of", "the"], [], [], []]


def test_tokenizer_takes_fused_words_apart(spark):
    rows = spark.createDataFrame([("we cannot gonna cannots",)], "text string")
    assert rows.select(T.tokenize(F.col("text"))).first()[0] == ["we", "can", "not", "gon", "na", "cannots"]


def test_punctuation_tokens(spark):
    rows = spark.createDataFrame([(["a", "--", "", "a-b", "."],)], "t array<string>")
    assert rows.select(T.remove_punctuation_tokens(F.col("t"))).first()[0] == ["a", "a-b"]


def stems(spark, words):
    table = spark.createDataFrame([(w,) for w in words], "word string")
    return [r[0] for r in table.select(stem_word(F.col("word"))).collect()]


def test_stems_word_by_word(spark):
    """The expression against the rules in plain Python: real endings, runs of y and every table entry."""
    r = random.Random(1)
    starts = ["", "a", "cr", "rel", "oper", "vall", "yy", "syzyg", "bey", "controll", "hop", "fil", "x", "agre", "ou"]
    ends = [*(e for t in (STEP_2, STEP_3) for pair in t for e in pair), *STEP_4, *IRREGULAR, "ies", "ied", "eed", "ed", "ing", "sses", "y", "e", "ll"]
    words = [s + e + f for s in starts for e in ends for f in ("", "s", "ed", "ly")]
    words += ["".join(r.choice("aeiouybcdlstz") for _ in range(r.randint(0, 12))) for _ in range(4000)]
    words += ["Ünïcödeing", "x1ing", "a\nbing", "y" * 41 + "ing", "A" * 3000 + "ational"]
    assert stems(spark, words) == [plain_stem(w) for w in words]
    assert stems(spark, [None, ""]) == [None, ""]


def test_porter_goldens(spark):
    assert stems(spark, ["running", "leaves", "falling"]) == ["run", "leav", "fall"]
    pairs = {
        "caresses": "caress", "ponies": "poni", "ties": "tie", "cats": "cat", "feed": "feed",
        "agreed": "agre", "plastered": "plaster", "motoring": "motor", "sing": "sing",
        "conflated": "conflat", "hopping": "hop", "falling": "fall", "hissing": "hiss",
        "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat",
        "conditional": "condit", "vietnamization": "vietnam", "operator": "oper",
        "triplicate": "triplic", "hopeful": "hope", "goodness": "good", "revival": "reviv",
        "adjustment": "adjust", "adoption": "adopt", "probate": "probat", "controll": "control",
    }
    assert dict(zip(pairs, stems(spark, pairs), strict=True)) == pairs


def test_stem_and_lemma_modes(spark):
    texts = ["Running leaves, falling", "", "the boys"]
    assert tokens_of(spark, texts, mode="stem") == [["run", "leav", "fall"], [], ["boy"]]
    lemmas = spark.createDataFrame([("leaves", "Leaf"), ("boys", "boy")], "form string, term string")
    assert tokens_of(spark, texts, lemmas=lemmas) == [["running", "leaf", "falling"], [], ["boy"]]
    assert tokens_of(spark, texts, mode="lemma", lemmas=lemmas)[2] == ["boy"]


def test_unknown_mode_is_an_error(spark):
    with pytest.raises(ValueError):
        plain_tokens(spark.createDataFrame([("a",)], "text string"), mode="other")


def test_sentiment_label(spark):
    rows = spark.createDataFrame([(0.05,), (0.049,), (-0.05,)], "c double")
    found = [r[0] for r in rows.select(T.sentiment_label(F.col("c"))).collect()]
    assert found == ["POSITIVE", "NEUTRAL", "NEGATIVE"]


def test_stems_analyse_every_text_once_and_every_word_once(spark):
    """However often a word comes and however many parts the join has."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        seen.add(1)
        return text

    rows = spark.createDataFrame([(i, "running dogs barked at running cats") for i in range(40)], "doc_id int, text string")
    out = analyze(rows.repartition(2).select("doc_id", counted("text").alias("text")), ["doc_id"], mode="stem")
    found = out.collect()
    assert {tuple(r.tokens) for r in found} == {("run", "dog", "bark", "run", "cat")} and len(found) == 40
    assert seen.value == 40
    words = stem_table(rows.select(F.explode(F.split("text", " ")).alias("term")))
    assert words.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
