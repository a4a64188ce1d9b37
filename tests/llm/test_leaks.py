import random

import pytest

from quillspark.llm.leaks import clean_leaks, find_leaks, fold, readings, traced_readings, words

ITEM = "Offiziell ist die Straßenprüfung nur ein Test, aber Größenwahn baut überall schon die Masten auf und niemand fragt."


def found(spark, texts, items, n=12, **kw):
    a = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "id long, text string, item string, n int")
    b = spark.createDataFrame([(i, t, "y") for i, t in enumerate(items)], "item long, target string, text string")
    return sorted((r.id, r.item) for r in find_leaks(a, "id", "text", b, "item", "target", n, **kw).collect())


@pytest.mark.parametrize(
    "text, hit",
    [
        (ITEM, True), (ITEM.upper().replace("ß", "SS"), True), (ITEM.replace("ß", "ss").replace("ö", "oe").replace("ü", "ue"), True), ("vorher " + " ".join(ITEM.split()[:12]) + " nachher", True), (" ".join(ITEM.split()[:11]), False),
        (ITEM.replace("Straßenprüfung", "Straßen-\nprüfung"), True), (ITEM.replace("Test", "<b>Te</b>st").replace("Masten", "[Masten](https://a.test/b)"), True), (ITEM.replace("Test", "**Test**").replace(" ", "  \n"), True),
        (ITEM.replace("ü", "&uuml;"), True), (ITEM.replace("Test", "Versuch").replace("niemand", "keiner"), False), (None, False), ("", False), ("wort " * 100_000 + ITEM, True), (ITEM.replace("baut", "[[Bau|baut]]"), True), (ITEM.replace("ö", "o\u0308"), True),
    ],
)
def test_spellings(spark, text, hit):
    assert found(spark, [text], [ITEM]) == ([(0, 0)] if hit else [])


def test_equals_brute_force_in_blocks(spark):
    r = random.Random(5)
    word = lambda: r.choice(["aa", "bb", "cc"])
    items = [" ".join(word() for _ in range(r.randrange(0, 9))) for _ in range(8)]
    texts = [" ".join(word() for _ in range(r.randrange(0, 14))) for _ in range(30)] + [None]
    grams = lambda t: {tuple(words(t)[i : i + 4]) for i in range(len(words(t)) - 3)}
    want = sorted((i, j) for i, t in enumerate(texts) if t for j, u in enumerate(items) if grams(t) & grams(u))
    assert found(spark, texts, items, 4) == want == found(spark, texts, items, 4, block_words=20)


def test_empty_tables(spark):
    assert found(spark, [], [ITEM]) == [] == found(spark, [ITEM], []) == found(spark, [ITEM], [None, ""])


def test_removal(spark):
    a = spark.createDataFrame([(1, "Davor steht viel eigener Text, " * 5 + ITEM + " Danach auch."), (2, ITEM), (3, "Nichts."), (4, None)], "id long, text string")
    b = spark.createDataFrame([(1, ITEM)], "item long, target string")
    got = {r.id: r for r in clean_leaks(a, "id", "text", b, "item", "target").collect()}
    assert got[1].action == "trimmed" and "Masten" not in got[1].text and got[1].text.endswith("Danach auch.") and got[1].removed_words == len(words(ITEM))
    assert (got[2].action, got[2].text, got[3].action, got[4].text) == ("dropped", None, "kept", None)


def test_folding_is_idempotent():
    for t in ("Größe", "Groesse", "GRÖSSE", "groſse"):
        assert fold(fold(t)) == fold(t)
    assert fold("Größe") == fold("Groesse") == fold("GRÖSSE") and readings("a-\nb")[0] == ["ab"]


OWN = "Davor steht viel eigener Text mit anderem Inhalt. " * 8
HIDDEN = [
    ITEM.replace("Straßenprüfung", "Straßen-\nprüfung").replace("Größenwahn", "Größen-\nwahn"), ITEM.replace("Test", "**Te**st").replace("baut", "ba**ut**"), ITEM.replace("Test", "<b>Te</b>st").replace("Masten", "[Masten](https://a.test/b)"),
    ITEM.replace("ö", "o\u0308").replace("ü", "u\u0308"), ITEM.replace("ü", "&uuml;").replace("ö", "&ouml;"), ITEM.replace("Test", "Te\u00adst"), ITEM.replace("baut", "[[Bau|baut]]"), ITEM.replace("ß", '\\ss{}').replace("ö", '\\"{o}'),
]


def cleaned(spark, texts, items, **kw):
    a = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    b = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item long, target string")
    out = clean_leaks(a, "id", "text", b, "item", "target", **kw)
    assert find_leaks(out, "id", "text", b, "item", "target", kw.get("n", 12)).count() == 0
    return {r.id: r for r in out.collect()}


def test_removal_sees_what_detection_sees(spark):
    texts = [OWN + h + " Danach auch." for h in HIDDEN] + [OWN + ITEM + " Mitte. " + h + " Danach auch." for h in HIDDEN]
    assert {i for i, _ in found(spark, texts, [ITEM])} == set(range(len(texts)))
    for i, r in cleaned(spark, texts, [ITEM]).items():
        assert r.action == "trimmed" and r.text.startswith(OWN) and r.text.endswith(" Danach auch."), texts[i]
        assert "niemand" not in r.text and "Offiziell" not in r.text and ("Mitte" in r.text) == (i >= len(HIDDEN)) and r.removed_words >= 12


def test_words_that_meet_are_looked_at_again(spark):
    own = "x y z w u v t o " * 2
    for blocks in (1_000, 1):
        got = cleaned(spark, [own + "p q a b c d r s", own + "a b p q r s c d"], ["a b c d", "p q r s"], n=4, block_words=blocks)
        assert all(r.text is None or r.text.split() == own.split() for r in got.values())


def test_traced_words_are_the_words(spark, small):
    texts = [r.text for r in spark.read.parquet(f"{small}/documents.parquet").select("text").collect() if r.text] + HIDDEN
    for t in texts:
        traced = traced_readings(t)
        assert {tuple(w for w, _ in ws) for ws in traced} == {tuple(ws) for ws in readings(t)}
        assert all(0 <= a < b <= len(t) for ws in traced for _, spans in ws for a, b in spans)
