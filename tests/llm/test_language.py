import math
import os

import pytest
from pyspark.sql import functions as F

from quillspark.llm.language import LANGUAGES, VOCABULARY, detect, fit, judge, label_issues, label_language, sample_texts

pytestmark = pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="no vocabulary")
D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return fit(sample_texts(docs.where("doc_id % 2 = 0"), "doc_id", "text", "lang", 60))


def test_held_out_accuracy(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id % 2 = 1 and lang is not null").select("text", "lang").collect()
    right = sum(judge(r.text, model)[0] in (r.lang, "mixed") for r in docs)
    assert right >= 0.97 * len(docs)


def test_forward_sums_all_segmentations(model):
    def brute(s):
        if not s:
            return [1.0] * len(LANGUAGES)
        out = [0.0] * len(LANGUAGES)
        for n in range(1, len(s) + 1):
            p = model.pieces.get(s[:n]) or (model.floor if s[:n] in model.vocabulary or n == 1 else None)
            if p:
                out = [o + a * b for o, a, b in zip(out, p, brute(s[n:]))]
        return out

    import math

    for w in ("haus", "the", "über", "x"):
        assert [round(v, 6) for v in model.forward(w)] == [round(math.log(v), 6) for v in brute("▁" + w)]


def test_mixed_and_slogans(model):
    de, en = "Der Gemeinderat stimmte gestern gegen das neue Verfahren der Stadt.", "The council voted for the second time to keep the router scheme."
    assert judge(de + " " + en, model)[0] == "mixed" and judge(de + ' Motto: "Think Big Again".', model)[0] == "de"
    assert judge(en.encode().decode("cp1252"), model)[0] == "en" and judge("", model)[0] is None and judge("12 % – ?", model)[0] is None
    assert judge(de * 3_000, model)[0] == "de"


def test_labels(spark):
    given = {"de-DE": "de", "de_DE": "de", "deu": "de", "EN": "en", "x-default": None, "und": None, "": None, "fra": "fr", "Deutsch": "de", " nl ": "nl", "pt-BR": "pt", None: None, "12": None}
    rows = spark.createDataFrame([(k,) for k in given], "l string").select("l", label_language(F.col("l")).alias("x")).collect()
    assert {r.l: r.x for r in rows} == given


def test_issues(spark, model):
    de, en = "Der Gemeinderat stimmte gestern gegen das neue Verfahren der Stadt.", "The council voted for the second time to keep the router scheme."
    rows = [("a", 1, de, "de"), ("a", 2, en, "de"), ("a", 3, en, None), ("b", 4, de, None), ("b", 5, en, None), ("a", 6, f"{de} / {en}", "de"), ("a", 7, None, "de"), ("a", 8, "", None), ("a", 3, en, None), ("a", None, en, None)]
    df = spark.createDataFrame([(*r, "k", "lang") for r in rows], "name string, id long, text string, label string, issue string, language string")
    got = label_issues(detect(df, model), F.col("name") == "b", "de").collect()
    assert sorted((r.id or 0, r.issue, r.lang) for r in got) == [(0, "missing", "en"), (2, "wrong", "en"), (3, "missing", "en"), (3, "missing", "en"), (5, "missing", "en"), (6, "mixed", "de"), (6, "mixed", "en")]
    assert detect(df.limit(0), model).count() == 0


def test_long_words_are_read_whole():
    from fractions import Fraction

    from quillspark.llm.language import PieceModel, _expected

    pieces, least = frozenset({"ab", "abc", "a", "ca"}), 1e-7
    prob = {"ab": 0.01, "a": 0.003, "ca": 1e-5}
    for word in ("abca" * 3, "abca" * 100 + "xyz" * 60 + "abc"):
        s = "▁" + word
        n = len(s)
        arcs = [(i, j, s[i:j], Fraction(prob.get(s[i:j], least))) for i in range(n) for j in range(i + 1, min(n, i + 3) + 1) if s[i:j] in pieces or j == i + 1]
        f, b = [Fraction(0)] * (n + 1), [Fraction(0)] * (n + 1)
        f[0] = b[n] = Fraction(1)
        for i, j, _, q in arcs:
            f[j] += f[i] * q
        for i, j, _, q in reversed(arcs):
            b[i] += q * b[j]
        want = {}
        for i, j, p, q in arcs:
            if (x := f[i] * q * b[j] / f[n]) > 1e-6:
                want[p] = want.get(p, 0) + float(x)
        assert _expected(word, prob, least, pieces, 3) == pytest.approx(want)
    model = PieceModel({"a": (0.1, 0.2), "b": (0.2, 0.1)}, (1e-7, 1e-7), frozenset("ab"))
    assert model.forward("a" * 300 + "b" * 50) != model.forward("a" * 300 + "a" * 50) and model.forward("a" * 5000)[0] == pytest.approx(5000 * math.log(0.1) + math.log(1e-7))
