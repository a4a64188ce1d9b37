import random

import pytest
from pyspark.sql import functions as F

from quillspark.operators import audit, counts, curate, html, sampling
from quillspark.plans import curation
from quillspark.runtime import ranked_in_groups

CASES = [
    ("", "too_short", "empty"), ("Kurz", "too_short", "very-short-topic"), ("exactly 18 chars!!", "keep", "very-short-topic"), ("Was ist denn hier los?", "url_ish", "ok"), ("Siehe www.example.org heute", "url_ish", "url-ish"),
    ("View Maps und Wegbeschreibung", "maps_boilerplate", "maps-link"), ("Nummer 123456 und 7890", "digit_heavy", "digit-heavy"), ("Der Ort 12345 im Norden liegt", "keep", "ok"), ("12345 Musterstadt am Wasser", "digit_heavy", "postal-code-lead"),
    ("washingtonpost.com", "brand_domain", "very-short-topic"), ('"Ein zitierter Satz ohne Rest"', "keep", "quoted-fragment"), ("A | B | C lange Beschreibung", "keep", "metadata-heavy"), ("Karte auf Maps ansehen bitte", "keep", "maps-link"),
]


def test_rules(spark):
    rows = spark.createDataFrame([(c[0],) for c in CASES], "topic string").select("topic", F.coalesce(curate.drop_reason(F.col("topic")), F.lit("keep")).alias("reason"), audit.topic_label(F.col("topic")).alias("label"))
    assert {tuple(r) for r in rows.collect()} == set(CASES)


@pytest.mark.parametrize(
    "topic, context, points",
    [
        ("Innenministerium plant neue Chatkontrolle", "", 65), ('Die "Firma": CVE-2024 Microsoft Azure down 12 GB', "x" * 40, 100), ("a | b | c x", "", 25), ("Startseite | Home - Nachrichten aus Berlin", "[Quelle: EN] " + "y" * 30, 45),
        ("Home | index | a b", "", 0), ("Er sagt ² 5 € pro Ärger Öl Übung", "", 85),
    ],
)
def test_points(spark, topic, context, points):
    assert spark.range(1).select(curate.quality_points(F.lit(topic), F.lit(context)).alias("p")).first().p == points


def test_repair(spark):
    page = 'a <a href="x">b\nc</a>\n<article>d'
    row = spark.createDataFrame([(page,)], "h string").select(html.repair_anchors(F.col("h")).alias("r"), html.invalid_anchor_lines(F.col("h")).alias("n")).first()
    assert row.r == 'a <a href="x">b</a>c</a><article>d</a>' and row.n == 3


def test_nodes_are_lenient():
    nodes = html.parse("<ul><li>a<li>b</ul>c</b><br>d")
    assert [(n["kind"], n["tag"] or n["text"], n["depth"]) for n in nodes] == [("tag", "ul", 0), ("tag", "li", 1), ("text", "a", 2), ("tag", "li", 2), ("text", "b", 3), ("text", "c", 0), ("tag", "br", 0), ("text", "d", 0)]
    assert nodes[0]["stop"] == 4 and html.parse(None) == [] and html.parse("<a") is not None


def topic(spark, page, title=None, desc=None):
    rows = spark.createDataFrame([(page, title, desc)], "h string, title string, d string").withColumn("n", html.nodes_of(F.col("h")))
    r = html.with_topic(rows, "n", F.col("title"), F.col("d")).first()
    return r.topic, r.context, r.topic_source


def test_topics(spark):
    quoted = '<li><a href="?ts=b1b2c3d4">[l]</a> Text <a href="https://www.example.org/a">das hier</a>{} <blockquote>A quoted line of some length.</blockquote>'
    assert topic(spark, quoted.format(" ist toll.")) == ("das hier: A quoted line of some length.", "", "html_anchor+blockquote")
    assert topic(spark, quoted.format(" ist wirklich toll.")) == ("das hier das hier ist wirklich toll.", "", "html_text")
    two = '<a href="http://a.b/">hier</a>. <a href="http://c.d/">eine zweite lange Zeile</a>'
    assert topic(spark, two) == ("hier (eine zweite lange Zeile)", "", "html_text")
    assert topic(spark, '<a href="http://a.b/">Ein Titel</a>', "Seite", "Erster. Zweiter") == ("Ein Titel", "Seite | Erster", "html_anchor")
    assert topic(spark, "<p>nichts</p>", "Ein Titel, der lang genug ist", "d") == ("Ein Titel, der lang genug ist", "d", "external_title")
    assert topic(spark, "<p>nichts</p>", "kurz", "Eine Beschreibung. Rest") == ("Eine Beschreibung", "", "external_desc")
    assert topic(spark, None) == ("", "", "none")
    assert topic(spark, '<a href="http://a.b/"></a>', "Ein Titel, der lang genug ist")[0] == ""


def test_quotations_and_text(spark):
    page = "<li>a <blockquote>b <blockquote>c</blockquote></blockquote> d<!-- e --><script>f</script>"
    rows = spark.createDataFrame([(page,)], "h string").withColumn("n", html.nodes_of(F.col("h")))
    r = rows.select(html.quote_count(F.col("n")).alias("q"), html.inner_text(html.without_quotations(F.col("n"))).alias("t")).first()
    assert r.q == 2 and r.t == "a  d"


def test_lookup(spark):
    links = spark.createDataFrame([("p", 0, "http://a/"), ("p", 1, "?ts=1"), ("p", 2, "http://b/"), ("p", 3, "http://a/")], "post_id string, pos int, href string")
    pages = spark.createDataFrame([("http://a/", "A", None, None, None, None)], "url string, title string, description string, author string, published string, site_name string")
    assert [s.title for s in html.linked_sources(links, pages).first().sources] == ["A", "A"]


def test_word_counts_add_up(spark):
    rows = spark.createDataFrame([("m1", "Haus haus 1abc abc"), ("m2", "Haus"), ("m2", None)], "m string, t string")
    got = {(r.bucket, r.word): r.cnt for r in counts.word_counts(rows, F.col("m"), "t").collect()}
    assert got == {("m1", "haus"): 2, ("m2", "haus"): 1, ("sum", "haus"): 3}


def quota_by_lists(pools, k, m):
    carry, out = 0, {}
    for b in ("high", "mid", "low"):
        n, d = pools.get(b, (0, 0))
        take = min(n, max(0, m - carry), k // 2)
        german = min(d, k - take)
        extra = min(n - take, k - take - german)
        carry += take + extra
        out[b] = (take + extra, german)
    return out


def test_quotas(spark):
    r = random.Random(1)
    for _ in range(6):
        pools = {b: (r.randrange(120), r.randrange(120)) for b in ("high", "mid", "low") if r.random() < 0.9}
        df = spark.createDataFrame([(b, *v) for b, v in pools.items()] or [("high", 0, 0)], "bucket string, foreign long, german long")
        got = {x.bucket: (x.foreign_quota, x.german_quota) for x in sampling.quotas(df, 100, 50).collect()}
        assert got == quota_by_lists(pools, 100, 50)


def test_sampling(spark):
    rows = spark.createDataFrame([(i, ("high", "mid", "low", "drop")[i % 4], "x") for i in range(400)], "id long, b string, bucket string")
    got = sampling.weighted_sample(rows, "id", "b", 42)
    by = {r.b: r["count"] for r in got.groupBy("b").count().collect()}
    assert by["high"] == 300 and by["mid"] == 100 and 30 < by["low"] < 70 and "drop" not in by
    assert sampling.weighted_sample(rows, "id", "b", 42, False).count() == 400
    assert sampling.stratified(rows.withColumn("c", F.lit("[Quelle: EN] x")), "id", "b", "c", 1, 10, 5).count() == 30
    once = sampling.first_of(rows, [F.col("b")], [F.col("id")])
    assert sorted(r.id for r in once.collect()) == [0, 1, 2, 3]
    assert sorted(r.id for r in sampling.first_of(once, [F.col("b")], [F.col("id")]).collect()) == [0, 1, 2, 3]


def test_ranks_in_groups(spark):
    r = random.Random(2)
    data = [("hot" if r.random() < 0.7 else f"g{r.randrange(5)}", r.randrange(3), i, r.randrange(9)) for i in range(500)]
    got = ranked_in_groups(spark.createDataFrame(data, "g string, s int, id long, v long"), ["g"], [F.col("s").desc(), F.col("id").asc()], "v").collect()
    want = {}
    for g in {d[0] for d in data}:
        total = 0
        for n, d in enumerate(sorted((d for d in data if d[0] == g), key=lambda d: (-d[1], d[2])), 1):
            total += d[3]
            want[d[2]] = (n, total)
    assert {x.id: (x.rank_in_group, x.running_total) for x in got} == want


def test_pack(spark):
    rows = spark.createDataFrame([(i, "w " * n) for i, n in enumerate((3, 3, 5, 9, 1))], "id long, t string").coalesce(1)
    got = [(r.pack_no, r.tokens) for r in curation.pack(rows, "id", "t", 6).collect()]
    assert got == [(0, 3), (0, 3), (1, 5), (2, 6), (3, 1)]
    assert len({r.pack_no for r in curation.pack(rows, "id", "t", 6, False).collect()}) == 5


def test_generate_isolates_faults(spark):
    rows = spark.createDataFrame([("a",), ("b",)], "prompt string")

    def predict(batch):
        raise ValueError

    assert {(r.model, r.generated) for r in curation.generate(rows, predict, ("x", "y")).collect()} == {("x", None), ("y", None)}
    assert {r.error for r in curation.generate(rows, predict).collect()} == {"ValueError: "}
    assert curation.generate(rows, lambda b: [s.upper() for s in b]).where("generated = 'A'").count() == 1


def test_curation_statuses(spark):
    data = [("kurz", "t" * 20, ""), ("k" * 40, "", ""), ("k" * 40, "Startseite | Home | x y z", ""), ("k" * 40, "Innenministerium plant neue Chatkontrolle", "")]
    rows = spark.createDataFrame(data, "target_comment string, topic string, context string").withColumn("topic_source", F.lit("s"))
    got = curate.judged(rows)
    assert [r.status for r in got.collect()] == ["short_comment", "no_topic", "quality_drop", "kept"]
    stats = {(r.metric, r.key): r.cnt for r in curate.stats(got).collect()}
    assert stats[("total", "")] == 4 and stats[("bucket", "mid")] == 1 and stats[("source", "s")] == 1
