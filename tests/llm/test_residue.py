import pytest
from pyspark.sql import functions as F

from quillspark.llm.residue import _MARKS, _PLACEHOLDERS, find_residue, is_placeholder, residue_rules, tied_to, values_of

CASES = [
    "{{ title }}", "Streit um %DESCRIPTION% in Bad", "Die [TITLE] kommt", "Bericht: X {0} Daten", "<TITLE HERE>", "@@title@@", "{% block x %}{% endblock %}", "__TEASER__ x", "${page.title}",
    "Bitte aktivieren Sie JavaScript in Ihrem Browser, um fortzufahren", "[615] Diese Seite benötigt aktivierte Skripte und kann sonst nicht angezeigt werden", "Notice: You need to enable scripts to run this app. (ID 12)",
    "404 - Seite nicht gefunden >>", "HTTP 500 - Internal Server Error", "Access denied. Reference #157811", "502 Bad Gateway (proxy-86)", "Wartungsarbeiten: wir sind gleich wieder für Sie da", "Page introuvable - erreur 404",
    "Lorem ipsum dolor sit amet", "Tempor lorem voluptua accusam lorem aliquyam erat", "asdf jklö asdf asdf", "xxxxxxxx xxxx", "TODO: write description before launch", "Insert meta description", "Neue Seite 1 (unbenannt)", "Votre titre ici - texte à remplacer | Kurierblatt",
]
CLEAN = [
    "Bauamt Mühlbach druckt {Name} auf 400 Bescheide", "Nexdaware protokolliert ${env:KEY} im Klartext", "503 Menschen in Unterau ohne Strom", "Wie Lorem ipsum in die Broschüre kam", "Kommentar: bitte JavaScript abschalten, sagt X",
    "Access denied: Gericht in Großtannau sperrt Zorvisoft aus", "Seite nicht gefunden: wie Lumrolith das Archiv verlor", "Platzhalter im Gesetz: Ministerium vergisst Zahlen", "Wartungsarbeiten an der Brücke dauern länger", "The plan would replace the badge",
    "Los técnicos tardaron en encontrar el error.", "", "   ", "In Bad Kaltau kostet es 40 %",
]


@pytest.mark.parametrize("texts, wanted", [(CASES, True), (CLEAN, False)])
def test_rules(spark, texts, wanted):
    rows = spark.createDataFrame([(t,) for t in texts], "v string").select("v", residue_rules(F.col("v")).alias("r")).collect()
    assert [r.v for r in rows if bool(r.r) is not wanted] == []


def test_tables(spark):
    schema = "id long, title string, text string, url string, value string, form string"
    rows = [(1, "{{ t }}", None, "https://a.test/x", "", ""), (1, "{{ t }}", None, "https://a.test/x", "", ""), (None, "404 Not Found", "ok " * 20_000, None, None, None), (3, None, "", " ", "", "")]
    rows += [(10 + i, None, f"Server neu laden: Browser Fehler, bitte erneut versuchen {i}", f"https://h{i}.test/", "", "") for i in range(4)]
    df = spark.createDataFrame(rows, schema)
    got = find_residue(values_of(df, "t", "id", ["title", "text"], F.col("url"))).collect()
    assert sorted((r.record_id or 0, r.field_name, r.rule) for r in got) == [(0, "title", "message"), (1, "title", "placeholder"), (1, "title", "placeholder")] + [(10 + i, "text", "recurring") for i in range(4)]
    none = spark.createDataFrame([], schema)
    assert find_residue(values_of(none, "t", "id", ["title", "text"], F.col("url"))).count() == 0


@pytest.mark.parametrize("text", ["Ohne Titel", "ohne titel (1)", "The article could not be found", "Die Artikel existiert nicht", "404 Not  Found", "404 Not\u00a0Found", "404\u00a0Not \n Found", "Seite  nicht\u00a0gefunden"])
def test_no_listed_message_is_passed_over(spark, text):
    assert spark.range(1).select(residue_rules(F.lit(text)).alias("r")).first().r
    value = spark.createDataFrame([(1, text, "https://a.test/")], "id long, title string, url string")
    assert [r.rule for r in find_residue(values_of(value, "t", "id", ["title"], F.col("url"))).collect()] == ["message"]


UNLISTED = [
    "Dieses Angebot ist in Ihrem Land nicht verfügbar", "This video is no longer available", "Página não encontrada", "Vous devez vous connecter pour lire cet article", "404. That's an error.",
    "Este contenido ya no está disponible", "You are being redirected to the login page", "Accedi per continuare a leggere questo articolo", "Loading, please wait",
]
HEADLINES = ["Perché la nuova anagrafe è fallito a Castelnero", "Der Bürgermeister von Bad Kaltau tritt zurück", "Kommentar: bitte JavaScript abschalten, sagt Octdamont", "Naïve façade – déjà-vu"]


def test_unlisted_notices_that_recur(spark):
    rows = [(100 * k + i, t, f"https://h{i}.example/netz/ein-ganz-anderer-titel-{i}.html") for k, t in enumerate(UNLISTED + HEADLINES) for i in range(30)]
    rows.append((9_999, UNLISTED[0] + ", oder vielleicht doch?", "https://x.test/"))  # recurs nowhere
    got = find_residue(values_of(spark.createDataFrame(rows, "id long, title string, url string"), "t", "id", ["title"], F.col("url"))).collect()
    assert sorted((r.record_id, r.rule) for r in got) == [(100 * k + i, "recurring") for k in range(len(UNLISTED)) for i in range(30)]


def test_forms_that_an_address_spells_are_headlines(spark):
    text = "Dieser Server ist nicht mehr erreichbar: die Seite fehlt"
    rows = [(i, text, f"https://h{i}.example/netz/dieser-server-ist-nicht-mehr-erreichbar-{i}.html") for i in range(5)]
    assert find_residue(values_of(spark.createDataFrame(rows, "id long, title string, url string"), "t", "id", ["title"], F.col("url"))).count() == 0
    near = spark.createDataFrame([("Größe der Brücke in Köln", "https://a.test/x/groesse-der-bruecke-12.html"), ("Ganz anders", "https://a.test/groesse-der-bruecke"), ("Ganz anders", None), ("ab", "https://a.test/ab")], "v string, u string")
    assert [r.t for r in near.select(tied_to(F.col("v"), F.col("u")).alias("t")).collect()] == [True, False, False, False]


def test_marks_are_in_every_placeholder(spark):
    made = ["{{ a }}", "{% a %}", "<%= a %>", "[% a %]", "${a}", "%{a}", "@@a@@", "%%a%%", "__ABC__", "%ABC%", "[[a]]", "[ABCD]", "<ABC HERE>", "{0}", "%s", "[object Object]", "$ABC_DEF", "undefined", "#REF!"]
    for form, text in zip(_PLACEHOLDERS, made, strict=True):
        r = spark.range(1).select(F.lit(text).rlike(form).alias("form"), F.lit(text).rlike(_MARKS).alias("mark"), is_placeholder(F.lit(text)).alias("both")).first()
        assert r.form and r.mark and r.both, text
