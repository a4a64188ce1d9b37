import random

import pytest

from quillspark.llm.pairs import Judge, SuffixAutomaton, find_broken

GERMAN = "Das Beste daran: die Kontolücke läuft seit 2008 ohne jede Prüfung."


@pytest.mark.parametrize(
    "comment, topic, context, defect",
    [
        (None, "t", "c", "empty"), ("[l] ", "t", "c", "empty"), ("...", "t", "c", "empty"), ("n/a", "", "", "empty"), ("\u200b", None, None, "empty"), ("(kein Text)", "t", "c", "empty"), (":-)", "t", "c", "empty"),
        ("As an AI assistant, I am not able to comment on this topic.", "t", "c", "refusal"), ("[l] Leider muss ich diese Aufgabe ablehnen.", "t", "c", "refusal"), ("Je suis désolé, je ne peux pas écrire ce texte.", "t", "c", "refusal"),
        ('Der Sprecher sagt: "Dazu kann ich leider nichts sagen." ' + GERMAN, "t", "c", None),
        ("STREIT UM DIE RECHNERLÜCKE IN GROSSROTTFELD", "Streit um die Rechnerlücke in Großrottfeld", "", "copy"), ("Topic: Ein Titel hier Context: der Rest davon", "Ein Titel hier", "[Quelle: EN] der Rest davon", "copy"), ("[l]  Streit  um  das Kameraverfahren ...", "Streit um das Kameraverfahren", None, "copy"),
        (GERMAN + " Von 70 Geräten für das Z", "t", "c", "truncated"), (GERMAN + ' Er sagte: "Wir haben', "t", "c", "truncated"), (GERMAN + " Und weiter: https://münzbla", "t", "c", "truncated"), (GERMAN + " Das ist nett (wie immer", "t", "c", "truncated"), (GERMAN + " Ein Leser schreibt mir,", "t", "c", "truncated"),
        (GERMAN + " :-)", "t", "c", None), (GERMAN + " m(", "t", "c", None), (GERMAN + " ¯\\_(ツ)_/¯", "t", "c", None), (GERMAN + " (Danke, an alle!)", "t", "c", None), (GERMAN + " Tja...", "t", "c", None), (GERMAN + " Update: Es geht weiter.", "t", "c", None),
        ("The council of Grayford voted to keep the router platform for another year.", "t", "c", "other_language"), ("Nessuno a Castelnero vuole pagare per questo, anche se il consiglio insiste.", None, None, "other_language"),
        ("Ich möchte zu diesem Thema keinen satirischen Text verfassen.", "t", "c", "refusal"), ("Das kann ich so nicht schreiben, denn es könnte jemanden verletzen.", "t", "c", "refusal"), ("Dazu liegen mir keine Informationen vor, daher kann ich keinen Kommentar schreiben.", "t", "c", "refusal"),
        ("Als Assistent möchte ich dazu keinen Text erzeugen.", "t", "c", "refusal"), ("Unfortunately I must decline to produce satire about that.", "t", "c", "refusal"), ("Aus Gründen der Neutralität ist es mir nicht möglich, einen Kommentar zu liefern.", "t", "c", "refusal"),
        ("Das verkauft Microsoft jetzt als KI, aber das ist nicht neu.", "t", "c", None), ("Leider kann ich den Artikel nicht mehr finden, aber lest selbst.", "t", "c", None), ("Als Assistent taugt das Ding übrigens nicht.", "t", "c", None),
        ("Meine Regeln sind einfach: kein Windows, kein Outlook.", "t", "c", None), ("Ich bedaure das überhaupt nicht.", "t", "c", None), ("Ich kann nicht glauben, dass die nichts schreiben.", "t", "c", None), ("Ich kann mir nicht helfen, das ist lustig.", "t", "c", None),
        (GERMAN + ' Zitat: "The council of the city voted to keep it."', "t", "c", None), (GERMAN, GERMAN + " Und mehr davon.", "", "copy"), (GERMAN, None, None, None),
    ],
)
def test_defects(comment, topic, context, defect):
    assert Judge().defect(comment, topic, context) == defect


@pytest.fixture(scope="module")
def pieces():
    import duckdb

    from quillspark.llm.language import LANGUAGES, fit

    rows = duckdb.sql("select lower(trim(lang))[1:2], text from '/root/testdata/sf0.01/documents.parquet' where lang is not null").fetchall()
    return fit({one: [t for lang, t in rows if lang == one] for one in LANGUAGES})


@pytest.mark.parametrize("comment", ["Qué vergüenza.", "Typical nonsense again.", "Belachelijk gewoon."])
def test_short_foreign_answers(pieces, comment):
    assert Judge(pieces).defect(comment, "t", "c") == "other_language"


@pytest.mark.parametrize("comment", ["Finde ich super.", "Kannste dir nicht ausdenken.", "Na toll.", "Tolle Wurst.", "Popcorn!"])
def test_short_german_answers(pieces, comment):
    assert Judge(pieces).defect(comment, "t", "c") is None


def test_automaton_equals_brute_force():
    r = random.Random(3)
    for _ in range(60):
        prompt = [r.choice("abcd") for _ in range(r.randrange(1, 12))]
        response = [r.choice("abcde") for _ in range(r.randrange(1, 10))]
        subs = {tuple(prompt[i:j]) for i in range(len(prompt)) for j in range(i + 1, len(prompt) + 1)}
        for least in (1, 2, 3):
            covered = [any(tuple(response[i:j]) in subs for i in range(k + 1) for j in range(k + 1, len(response) + 1) if j - i >= least) for k in range(len(response))]
            assert SuffixAutomaton(prompt).coverage(response, least) == sum(covered) / len(covered)


def test_tables(spark):
    schema = "id long, topic string, context string, answer string, response string, k string"
    rows = [(1, None, None, None, "x", "y"), (1, None, None, None, "x", "y"), (None, "", "", GERMAN[:-9], "x", "y"), (2, "a", "b", GERMAN * 5_000, "x", "y")]
    got = find_broken(spark.createDataFrame(rows, schema), "id", "topic", "context", "answer").collect()
    assert sorted((r.id or 0, r.defect) for r in got) == [(0, "truncated"), (1, "empty"), (1, "empty")]
    assert find_broken(spark.createDataFrame([], schema), "id", "topic", "context", "answer").count() == 0


def test_long_ends_are_seen_whole():
    from quillspark.llm.pairs import truncated

    remark = "eine lange Bemerkung ohne Punkt, " * 20
    for end in (f"({remark})", f"[{remark}]", "Hier steht es: https://www.example.org/" + "x" * 500):
        assert not truncated("Das ist ein ganzer Satz. " + end)
    assert truncated("Das ist ein ganzer Satz. (" + remark) and truncated("Das ist ein ganzer Satz. " + remark + "und")
