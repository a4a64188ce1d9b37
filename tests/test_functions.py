import pytest
from pyspark.sql import functions as F

from quillspark.functions import language, links, prompt, text, timecode
from quillspark.functions.patterns import DEICTIC_WORDS, java, whole_words


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "v string").select(expr(F.col("v")).alias("x")).first().x


@pytest.mark.parametrize(
    "given, wanted",
    [("oder?!elf!?!?update", "oder?! elf!?!? update"), ("2011", "201 1"), ("2010", "2010"), ("1111", "111 1"), ("16:30", "1 6: 30"), ("www.foo.de", "www. foo. de")],
)
def test_sentence_gaps(spark, given, wanted):
    assert one(spark, text.open_sentence_gaps, given) == wanted


def test_text_scalars(spark):
    assert one(spark, text.clean_token, "foo_bar-baz²") == "foobarbaz²"
    assert one(spark, text.normalize_whitespace, " a \n b\x1c") == "a b"
    assert one(spark, text.normalize_whitespace, None) == ""
    assert one(spark, text.strip_marker, "[l] a [l]b") == "a [l]b"
    assert one(spark, text.token_count, "[l] Text das hier ist toll.") == 5
    assert one(spark, text.tokens, "") == []
    assert one(spark, lambda v: text.truncate(v, 2), "😀äb") == "😀ä"
    assert one(spark, text.first_sentence, ".a") == ""
    assert spark.range(1).select(text.join_context(F.lit("T"), F.lit("d. e")).alias("x")).first().x == "T | d"
    assert spark.range(1).select(text.join_context(F.lit(""), F.lit(None).cast("string")).alias("x")).first().x == ""


@pytest.mark.parametrize(
    "given, wanted",
    [
        ("http://www.heise.de/x", "heise.de"), ("https://www2.foo.de", "foo.de"), ("http://awww.de/", "ade"), ("http://a.de?x=//b.c/d", "b.c"), ("/foo", ""),
        ("mailto:x@y.z", "mailto:x@y.z"), ("#", "#"), ("?ts=ab", "self"), ("/?ts=ab", "self"),
    ],
)
def test_domain(spark, given, wanted):
    assert one(spark, links.domain, given) == wanted


@pytest.mark.parametrize("given, wanted", [("b1b2c3d4", "2012-02-27 22:26:18"), ("4a&css=1", None), ("", None), (None, None), ("zz", None), ("123456789", None)])
def test_decode(spark, given, wanted):
    assert one(spark, timecode.decode, given) == wanted


def test_code_is_an_involution(spark):
    for s in (0, 1_330_381_578, 4_000_000_000):
        row = spark.range(1).select(timecode.decode_seconds(timecode.encode(F.lit(s))).alias("x")).first()
        assert row.x == s


def test_months(spark):
    got = [r.month for r in timecode.months(spark, "2023-11-30", "2024-02-01").orderBy("month").collect()]
    assert got == ["202311", "202312", "202401", "202402"]
    assert timecode.months(spark, "2024-02-01", "2024-01-31").count() == 0
    assert timecode.months(spark, "2023-11-30", "2024-02-01", 2).count() == 2
    done = spark.createDataFrame([("202311",)], "month string")
    every = timecode.months(spark, "2023-11-30", "2023-12-01")
    assert [r.month for r in timecode.unprocessed(every, done).collect()] == ["202312"]
    assert timecode.unprocessed(every, done, True).count() == 2


@pytest.mark.parametrize("given, wanted", [("hier", True), ("hier.", True), ("Das Hier", True), ("a hier b", True), ("éhier", False), ("hieré", False), ("x_hier", False), ("hier²", False), ("dieser", False)])
def test_deictic_words(spark, given, wanted):
    assert one(spark, lambda v: v.rlike(java(whole_words(DEICTIC_WORDS), True)), given) is wanted


def test_prompt(spark):
    rows = spark.createDataFrame([("a  b", "", None, "x  y"), ("t", "c", "u", "z")], "topic string, context string, url string, target string").select(
        prompt.prompt_text(F.col("topic"), F.col("context"), F.col("url")).alias("p"), prompt.messages(F.col("topic"), F.col("context"), F.col("url"), F.col("target"), F.lit("final"), F.lit("")).alias("m")
    ).collect()
    assert rows[0].p.endswith("### Input\nTopic: a b\n\n### Response")
    assert "Context: c\nURL: u\n\n### Response" in rows[1].p
    assert [m.role for m in rows[0].m] == ["system", "user", "assistant"] and rows[0].m[2].content == "x y"
    assert "Topic: final\nContext: c" in rows[1].m[1].content


def test_language_seam(spark):
    assert one(spark, language.stopword_language, "kurz") == "de"
    assert one(spark, language.stopword_language, "The court of the city is not to blame for that") == "en"
    assert spark.range(1).select(language.with_prefix(F.lit(""), F.lit("en")).alias("x")).first().x == "[Quelle: EN]"
    assert spark.range(1).select(language.with_prefix(F.lit("c"), F.lit("de")).alias("x")).first().x == "c"
    assert one(spark, language.is_non_german, "[Quelle: EN] x") and not one(spark, language.is_non_german, "[Quelle: DE] x") and not one(spark, language.is_non_german, None)
