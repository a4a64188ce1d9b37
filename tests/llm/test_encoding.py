import pytest

from quillspark.llm.encoding import decode_utf8, find_damage, viterbi

TEXT = "Später hieß es, man höre für die Bürger zu – „naïve“"


@pytest.mark.parametrize("wrong", ["cp1252", "latin-1", "cp1250", "cp1251", "mac_roman", "cp437"])
def test_round_trip(wrong):
    data = TEXT.encode("utf-8")
    read = "".join(bytes([b]).decode(wrong, "ignore") or chr(b) for b in data)
    assert decode_utf8(read)[0] == TEXT


def test_twice_lowered_and_entities():
    twice = "für Öl".encode().decode("cp1252").encode().decode("cp1252")
    assert decode_utf8(twice)[0] == "für Öl"
    assert decode_utf8("künftig fällt".encode().decode("cp1252").lower())[0] == "künftig fällt"
    assert decode_utf8("F&Atilde;&frac14;r &#195;&#182;l")[0] == "Für öl"
    assert decode_utf8("La cittÃ non Ã¨ piÃ¹")[0] == "La città non è più"


@pytest.mark.parametrize("clean", ["CHÂTEAU À L’ÂNE: le débat", "INFORMAÇÃO E LIBERDADE: São", "Größe 3½ m² ± 2 %", "Παράξενη πινακίδα", "Смешной перевод", "Konﬂikt", "naïve Façade – déjà-vu", "Gru\u0308ße", "", "Preis £ 20 – egal ©", "Гірський"])
def test_clean_text_stays(clean):
    assert decode_utf8(clean) is None


def test_damage_by_words(spark):
    clean = ["Für die Bürger gilt es überall", "Die Maßnahme gilt", "La città è bella", "Die Summe Σ über alle", "Konﬂikt um 5 €"] * 30
    bad = ["FГјr", "Die Maﬂnahme gilt ¸berall", "Bⁿrger", "La cittа и bella", "Die Ma\ufffdnahme", "Sp\ufffdt"]
    rows = [(i, t, None, "x") for i, t in enumerate(clean)] + [(1000 + i, None, t, "y") for i, t in enumerate(bad)] + [(None, "fÃ¼r", "", "z"), (1, "fÃ¼r", None, "z"), (1, "fÃ¼r", None, "z")]
    got = find_damage(spark.createDataFrame(rows, "id long, a string, b string, value string"), "id", ["a", "b"]).collect()
    back = {r.id: r.restored for r in got if r.field_name == "b"}
    assert back == {1000: "Für", 1001: "Die Maßnahme gilt überall", 1002: "Bürger", 1003: "La città è bella", 1004: "Die Maßnahme", 1005: "Sp\ufffdt"}
    assert sorted((r.id is None, r.restored) for r in got if r.field_name == "a") == [(False, "für"), (False, "für"), (True, "für")]


def test_empty_table(spark):
    assert find_damage(spark.createDataFrame([], "id long, a string"), "id", ["a"]).count() == 0


def test_viterbi_prefers_frequent_words():
    assert viterbi([("fьr", -4.6, [("c", "für", 5.0)])]) == ["für"]
    assert viterbi([("na", 5.0, [("c", "nä", -1.0)])]) == [None]
