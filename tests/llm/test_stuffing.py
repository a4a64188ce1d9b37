import numpy as np
import pytest

from quillspark.llm.stuffing import Counts, Scorer, _Ids, _pairs, corpus_counts, find_stuffed

NEWS = "Der Gemeinderat von Altbach stimmte gestern mit knapper Mehrheit gegen das neue Verfahren. Ein Sprecher erklärte, die Stadt habe davon nichts gewusst. Die Kosten steigen nach Berechnungen aus dem Rathaus auf zwei Millionen Euro."
SPAM = [
    "Treppenlift kaufen Treppenlift kaufen Treppenlift kaufen Dachrinne Luftfilter Rohrreiniger Bettgestell Winterreifen Tintenpatrone Luftfilter Gartenschlauch",
    "https://a.test/x-1\nhttps://b.test/y-2\nhttps://c.test/z-3",
    "* [dog food](https://a.test/1)\n* [car cover best](https://b.test/2)\n* [locksmith](https://c.test/3)",
    "Altbach: Treppenlift » www.a.test\nNeubach: Dachrinne » www.b.test\nObersee: Luftfilter » www.c.test",
    "#dogfoodbest #carcoverbuy #locksmithsale #hearingaidtop #airfiltercheap",
    "Wer Preis Zahnbürste sucht, findet Preis Zahnbürste hier. Unser Preis Zahnbürste ist Preis Zahnbürste. Preis Zahnbürste? Bei uns Preis Zahnbürste und Preis Zahnbürste!",
    "Startseite - http://a.test\nWeiter » - http://b.test\nImpressum - http://c.test\nPartner - http://d.test",
]
HAM = [
    NEWS, NEWS + "\n\nTags: Rathaus, Kosten, Verfahren", NEWS + "\n\nQuellen:\n[1] https://a.test/a\n[2] https://b.test/b", "https://a.test/1 - Die Stadt hat den Antrag gestern Abend mit knapper Mehrheit abgelehnt.\nhttps://b.test/2 - Der Landrat wollte sich dazu am Montag nicht mehr äußern.",
    "Quantalith hat das Portal verkauft. Bei Quantalith heißt es, das sei nicht wahr. Wenn Quantalith so etwas sagt, dann glaube ich denen das sofort.", "", None,
]


def test_spam_and_ham(spark):
    rows = [(i, t, "x", 0.5) for i, t in enumerate([*SPAM, *HAM, SPAM[0], *[NEWS] * 40])]
    df = spark.createDataFrame(rows, "id long, text string, kind string, share double")
    got = {r.id for r in find_stuffed(df, "id", "text").collect()}
    assert got == {*range(len(SPAM)), len(SPAM) + len(HAM)}


def test_counts_are_exact(spark):
    texts = [("a b a b c",), ("a b\nb c",), (None,), ("x " * 70_000,)]
    rows = corpus_counts(spark.createDataFrame(texts, "t string").repartition(3)).collect()
    c = Counts(np.array([r.hash for r in rows], np.int64).view(np.uint64), np.array([r.n for r in rows]))
    ids = _Ids()
    h = ids(["a", "b", "c", "x", "unseen"])
    assert list(c(np.array([0], np.uint64))) == [70_009] and list(c(h)) == [3, 4, 2, 70_000, 0]
    assert list(c(_pairs(h[:2], h[1:3]))) == [3, 2] and list(c(_pairs(h[1:2], h[:1]))) == [0]  # "b a" occurs once


def test_joined_counts_give_the_same(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*SPAM, *HAM, *[NEWS] * 20, *SPAM])], "id long, text string").repartition(4)
    rows = lambda **k: sorted((r.id, r.kind, r.share, round(r.mean_pmi, 9), round(r.mean_gain, 9)) for r in find_stuffed(df, "id", "text", **k).collect())
    assert rows() == rows(broadcast_entries=0) and len(rows()) == 2 * len(SPAM)


POLISH = (
    "Rada miasta przyjęła wczoraj nowy plan budowy mostu. Mieszkańcy czekali na tę decyzję od trzech lat. Burmistrz podziękował wszystkim za cierpliwość. Koszty wyniosą około dwóch milionów złotych. "
    "Prace mają ruszyć jeszcze tej jesieni. Most zostanie otwarty najpóźniej za dwa lata. Opozycja uważa projekt za zbyt drogi. Następne posiedzenie odbędzie się w poniedziałek."
)


@pytest.mark.parametrize("copies", [1, 300])
def test_prose_of_any_language_is_no_spam(spark, copies):
    df = spark.createDataFrame([(i, t) for i, t in enumerate([POLISH] * copies + [NEWS] * 40)], "id long, text string")
    assert find_stuffed(df, "id", "text").count() == 0


def test_only_the_information_of_neighbours_decides(spark):
    import random

    r = random.Random(5)
    names = "dachrinne luftfilter rohrreiniger bettgestell winterreifen tintenpatrone gartenschlauch treppenlift kaffeemaschine zahnbürste".split()
    salad = [" ".join(r.choice(names) for _ in range(60)) + "." for _ in range(30)]  # no separators, no repeated phrase, a sentence end
    df = spark.createDataFrame([(i, t) for i, t in enumerate(salad + [NEWS] * 40)], "id long, text string")
    assert {x.id for x in find_stuffed(df, "id", "text").collect()} == set(range(30))


@pytest.mark.parametrize("text", ["wort " * 100_000, "\n\n\n", "äöü", "a", "."])
def test_odd_texts(text):
    none = Counts(np.zeros(0, np.uint64), np.zeros(0, np.int64))
    assert 0 <= Scorer(0).judge([text], none)[0]["share"] <= 1


def test_empty_table(spark):
    assert find_stuffed(spark.createDataFrame([], "id long, text string"), "id", "text").count() == 0
