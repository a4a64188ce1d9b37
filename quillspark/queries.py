"""Queries over the archive's tables, one for each operator or group of operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import language, links, prompt, text, timecode
from quillspark.operators import audit, counts, curate, html, sampling
from quillspark.plans import curation, ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: Literal topics for the rules that no generated topic breaks.
TOPICS = [
    "", "Kurz", "Startseite", "exactly 18 chars!!", "Was ist denn hier los?", "Siehe www.example.org heute", "Bericht unter example.de/artikel", "View Maps und Wegbeschreibung",
    "Postleitzahl | Quelle des Ortes", "Nummer 123456 und 7890", "Jahre 2010, 2011 und folgende im Text", "Der Ort 12345 im Norden liegt", "12345 Musterstadt am Wasser", "washingtonpost.com",
    '"Ein zitierter Satz ohne Rest"', "Ein Artikel bei Wikipedia heute", "JavaScript is not available today", "A | B | C lange Beschreibung", "Karte auf Maps ansehen bitte", "Innenministerium plant neue Maßnahme",
]
#: A literal page with header, list, permalink, link and quotation, and one with page metadata.
PAGE = '<h3>Day one</h3><ul><li><a href="?ts=b1b2c3d4">[l]</a> Text <a href="https://www.example.org/a">das hier</a> ist toll. <blockquote>A quoted line of some length.</blockquote></ul><h3>Day two</h3><ul><li><a href="?ts=b1b2c3d5">[l]</a> Mehr <a href="http://foo.test/b">das hier</a> ist wirklich toll.</ul>'
HEAD = '<html><head><meta property="og:title" content=" "><meta name="twitter:title" content="Zweiter Titel"><title>Dritter</title><meta name="description" content="Worum es geht"><meta property="og:site_name" content=""></head><body><time datetime="2024-05-06">gestern</time></body></html>'


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _t(s: SparkSession, d: str, name: str) -> DataFrame:
    return s.read.parquet(f"{d}/{name}.parquet")


def _month() -> F.Column:
    return F.coalesce(timecode.month_of(F.col("hextimestamp")), F.lit("unknown"))


@query
def word_counts(s: SparkSession, d: str) -> DataFrame:
    return counts.word_counts(_t(s, d, "messages"), _month(), "content")


@query
def normalize_text(s: SparkSession, d: str) -> DataFrame:
    return _t(s, d, "documents").select("doc_id", text.normalize_whitespace(F.col("text")).alias("normalized"))


@query
def token_count(s: SparkSession, d: str) -> DataFrame:
    return _t(s, d, "messages").select("message_id", text.token_count(F.col("content")).alias("tokens"))


@query
def marker_strip(s: SparkSession, d: str) -> DataFrame:
    return _t(s, d, "messages").select("message_id", text.open_sentence_gaps(text.strip_marker(F.col("content"))).alias("opened"))


@query
def clean_tokens(s: SparkSession, d: str) -> DataFrame:
    words = _t(s, d, "documents").select("doc_id", F.posexplode(text.tokens(F.col("text"))).alias("pos", "t"))
    words = words.select("doc_id", F.col("pos").cast("bigint").alias("pos"), text.clean_token(F.col("t")).alias("word"))
    return words.where(text.is_counted_word(F.col("word")))


@query
def first_sentence(s: SparkSession, d: str) -> DataFrame:
    return _t(s, d, "externalsources").select("source_id", text.truncate(text.first_sentence(text.normalize_whitespace(F.col("description"))), 160).alias("sentence"))


@query
def truncate_180(s: SparkSession, d: str) -> DataFrame:
    return _t(s, d, "documents").select("doc_id", text.truncate(text.normalize_whitespace(F.col("text")), 180).alias("topic"))


@query
def context_join(s: SparkSession, d: str) -> DataFrame:
    return _t(s, d, "externalsources").select("source_id", text.join_context(F.col("title"), F.col("description")).alias("context"))


@query
def field_defaults(s: SparkSession, d: str) -> DataFrame:
    default = lambda c, v: F.coalesce(F.col(c), F.lit(v)).alias(c)
    return _t(s, d, "fefe_training_data").select("row_id", default("topic", ""), default("quality_bucket", "unknown"), default("topic_source", "unknown"))


def _hrefs(s: SparkSession, d: str) -> DataFrame:
    h = links.hrefs(links.without_quotes(F.col("contenthtml")))
    return _t(s, d, "messages").select("message_id", "hextimestamp", h.alias("hrefs"))


@query
def domain_counts(s: SparkSession, d: str) -> DataFrame:
    rest = F.slice("hrefs", 2, F.greatest(F.size("hrefs"), F.lit(1)))
    return counts.domain_counts(_hrefs(s, d), _month(), rest)


@query
def self_links(s: SparkSession, d: str) -> DataFrame:
    return _hrefs(s, d).select("message_id", F.size(F.filter("hrefs", links.is_self)).cast("bigint").alias("self_links"), F.size("hrefs").cast("bigint").alias("all_links"))


@query
def external_links(s: SparkSession, d: str) -> DataFrame:
    found = _hrefs(s, d).select("message_id", F.posexplode("hrefs").alias("pos", "href"))
    return found.where(links.is_external(F.col("href"))).select("message_id", F.col("pos").cast("bigint").alias("pos"), "href")


@query
def timecode_roundtrip(s: SparkSession, d: str) -> DataFrame:
    seconds = timecode.decode_seconds(F.col("hextimestamp"))
    return _t(s, d, "messages").select("message_id", timecode.decode(F.col("hextimestamp")).alias("decoded"), timecode.encode(seconds).alias("encoded"))


@query
def permalinks(s: SparkSession, d: str) -> DataFrame:
    first = F.try_element_at("hrefs", F.lit(1))
    found = _hrefs(s, d).select("message_id", links.code(first).alias("code"), links.permalink(first, "https://blog.linkstube.example/").alias("url"))
    return found.where(timecode.decode_seconds(F.col("code")).isNotNull())


def _order_months(s: SparkSession, d: str) -> DataFrame:
    return _t(s, d, "orders").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))


@query
def month_sequence(s: SparkSession, d: str) -> DataFrame:
    return timecode.month_rows(_order_months(s, d), "a", "b").withColumn("url", timecode.page_url(F.col("month"), "https://blog.linkstube.example/?mon="))


@query
def months_unprocessed(s: SparkSession, d: str) -> DataFrame:
    """The months of the archive in which no post quotes: those with a quotation stand for the processed ones."""
    posts = _t(s, d, "messages").select(timecode.decode(F.col("hextimestamp")).alias("at"), _month().alias("month"), "quotecount")
    bounds = posts.agg(F.min("at").alias("a"), F.max("at").alias("b"))
    return timecode.unprocessed(timecode.month_rows(bounds, "a", "b"), posts.where("quotecount > 2").select("month").distinct())


@query
def month_limit(s: SparkSession, d: str) -> DataFrame:
    return timecode.month_rows(_order_months(s, d), "a", "b", 24)


@query
def month_delta(s: SparkSession, d: str) -> DataFrame:
    return _order_months(s, d).select(timecode.month_delta(F.trunc("a", "month"), F.trunc("b", "month")).alias("months"))


@query
def anchor_repair(s: SparkSession, d: str) -> DataFrame:
    return _t(s, d, "messages").select("message_id", html.repair_anchors(F.col("contenthtml")).alias("repaired"))


@query
def invalid_anchor_lines(s: SparkSession, d: str) -> DataFrame:
    page = F.regexp_replace("contenthtml", "(</a>[^<]*)</a>", "$1")
    return _t(s, d, "messages").select("message_id", html.invalid_anchor_lines(F.regexp_replace(page, "</a> ", "\n")).alias("invalid_lines"))


@query
def list_items(s: SparkSession, d: str) -> DataFrame:
    found = _t(s, d, "messages").select("message_id", F.posexplode(html.list_items(F.col("contenthtml"))).alias("item_no", "body"))
    return found.select("message_id", F.col("item_no").cast("bigint").alias("item_no"), "body")


@query
def item_candidates(s: SparkSession, d: str) -> DataFrame:
    items = html.list_items(F.col("contenthtml"))
    return _t(s, d, "messages").select("message_id", F.size(F.filter(items, lambda x: F.exists(links.hrefs(x), lambda h: h.contains("?ts=")))).cast("bigint").alias("candidates"))


def _parsed(s: SparkSession, d: str) -> DataFrame:
    return _t(s, d, "messages").select("message_id", html.nodes_of(F.col("contenthtml")).alias("n"))


@query
def quote_counts(s: SparkSession, d: str) -> DataFrame:
    return _parsed(s, d).select("message_id", html.quote_count(F.col("n")).cast("bigint").alias("quotes"))


@query
def dom_nodes(s: SparkSession, d: str) -> DataFrame:
    return html.node_table(_t(s, d, "messages"), "message_id", "contenthtml").groupBy("kind", "tag").agg(F.count(F.lit(1)).alias("cnt"))


@query
def stripped_text(s: SparkSession, d: str) -> DataFrame:
    return _parsed(s, d).select("message_id", html.inner_text(html.without_quotations(F.col("n"))).alias("own_text"))


def _literal(s: SparkSession, page: str) -> DataFrame:
    return s.createDataFrame([(1, page)], "page_id bigint, html string")


@query
def asof_header(s: SparkSession, d: str) -> DataFrame:
    return html.header_before(_literal(s, PAGE), "page_id", "html").where("tag = 'ul'").select("page_id", F.col("pos").cast("bigint").alias("pos"), "header")


@query
def nearest_blockquote(s: SparkSession, d: str) -> DataFrame:
    anchors = _literal(s, PAGE).withColumn("n", html.nodes_of(F.col("html"))).withColumn("a", F.explode(html.external_anchors(F.col("n"))))
    return anchors.select("a.href", html.quotation_after(F.col("n"), F.col("a")).alias("quotation"))


@query
def next_sentence(s: SparkSession, d: str) -> DataFrame:
    anchors = _literal(s, PAGE).withColumn("n", html.nodes_of(F.col("html"))).withColumn("a", F.explode(html.external_anchors(F.col("n"))))
    return anchors.select("a.href", html.sentence_after(F.col("n"), F.col("a")).alias("sentence"))


@query
def source_metadata(s: SparkSession, d: str) -> DataFrame:
    page = _literal(s, HEAD).withColumn("n", html.nodes_of(F.col("html")))
    return page.select(html.page_metadata(F.col("n"), F.lit("https://a.test/x")).alias("m")).select("m.*")


# The four queries above show their operators on a literal page; these run them over every page, anchor and node.


def _anchored(s: SparkSession, d: str) -> DataFrame:
    return _parsed(s, d).withColumn("a", F.explode(html.external_anchors(F.col("n"))))


@query
def anchor_quotations(s: SparkSession, d: str) -> DataFrame:
    return _anchored(s, d).select("message_id", F.col("a.pos").cast("bigint").alias("pos"), "a.href", html.quotation_after(F.col("n"), F.col("a")).alias("quotation"))


@query
def anchor_sentences(s: SparkSession, d: str) -> DataFrame:
    return _anchored(s, d).select("message_id", F.col("a.pos").cast("bigint").alias("pos"), "a.href", html.sentence_after(F.col("n"), F.col("a")).alias("sentence"))


@query
def node_headers(s: SparkSession, d: str) -> DataFrame:
    return html.header_before(_t(s, d, "messages"), "message_id", "contenthtml").select("message_id", F.col("pos").cast("bigint").alias("pos"), "kind", "tag", "header")


def _month_pages(s: SparkSession, d: str) -> DataFrame:
    """(month, html): month pages, made of the messages under a header for each day."""
    day = F.coalesce(F.substring(timecode.decode(F.col("hextimestamp")), 1, 10), F.lit("undated"))
    posts = _t(s, d, "messages").select(_month().alias("month"), F.struct(day.alias("day"), "message_id", F.coalesce("contenthtml", F.lit("")).alias("html")).alias("p"))
    pages = posts.groupBy("month").agg(F.array_sort(F.collect_list("p")).alias("ps"))
    first = lambda p, i: (i == 0) | (F.try_element_at("ps", F.greatest(i, F.lit(1)))["day"] != p["day"])
    item = lambda p, i: F.concat(F.when(first(p, i), F.concat(F.lit("</ul><h3>"), p["day"], F.lit("</h3><ul>"))).otherwise(""), F.lit("<li>"), p["html"])
    return pages.select("month", F.array_join(F.transform("ps", item), "").alias("html"))


@query
def month_headers(s: SparkSession, d: str) -> DataFrame:
    """The headers over month pages; single messages hold none."""
    return html.header_before(_month_pages(s, d), "month", "html").select("month", F.col("pos").cast("bigint").alias("pos"), "kind", "tag", "header")


def _source_pages(s: SparkSession, d: str) -> DataFrame:
    """The pages of externalsources as HTML, since no table holds them: each row's fields in the elements that name them."""
    escaped = lambda c: F.replace(F.replace(F.replace(F.col(c), F.lit("&"), F.lit("&amp;")), F.lit('"'), F.lit("&quot;")), F.lit("<"), F.lit("&lt;"))
    part = lambda before, c, after: F.coalesce(F.concat(F.lit(before), escaped(c), F.lit(after)), F.lit(""))
    head = [part('<meta name="description" content="', "description", '">'), part('<meta name="author" content="', "author", '">'), part('<meta property="og:site_name" content="', "site_name", '">')]
    body = [part('<time datetime="', "published", '">x</time>'), part("<h1>", "title", "</h1>")]
    page = F.concat(F.lit("<html><head>"), *head, F.lit("</head><body>"), *body, F.lit("</body></html>"))
    return _t(s, d, "externalsources").select("source_id", "url", page.alias("html"))


@query
def page_metadata(s: SparkSession, d: str) -> DataFrame:
    pages = _source_pages(s, d).select("source_id", "url", html.nodes_of(F.col("html")).alias("n"))
    return pages.select("source_id", html.page_metadata(F.col("n"), F.col("url")).alias("m")).select("source_id", "m.*")


def _ingested(s: SparkSession, d: str, name: str) -> DataFrame:
    return ingest.aggregate(_month_pages(s, d))[name]


@query
def ingested_posts(s: SparkSession, d: str) -> DataFrame:
    """Month pages to posts: repaired, split into items, parsed, decoded, one row per post."""
    return _ingested(s, d, "posts").select("month", "timestamp", "hexTimestamp", "quoteCount", "wordCount", "sourcesCount", "url", "content")


@query
def ingested_words(s: SparkSession, d: str) -> DataFrame:
    return _ingested(s, d, "words")


@query
def ingested_domains(s: SparkSession, d: str) -> DataFrame:
    return _ingested(s, d, "domains")


@query
def html_topic(s: SparkSession, d: str) -> DataFrame:
    none = F.lit(None).cast("string")
    return html.with_topic(_parsed(s, d), "n", none, none).drop("n")


@query
def source_lookup(s: SparkSession, d: str) -> DataFrame:
    pages = sampling.first_of(_t(s, d, "externalsources").where("url is not null"), [F.col("url")], [F.col("source_id")])
    found = _hrefs(s, d).select(F.col("message_id").alias("post_id"), F.posexplode("hrefs").alias("pos", "href"))
    return html.linked_sources(found, pages).select("post_id", F.size("sources").cast("bigint").alias("n"), F.array_join(F.transform("sources", lambda x: F.coalesce(x["title"], F.lit(""))), "¦").alias("titles"))


@query
def hard_drop_reasons(s: SparkSession, d: str) -> DataFrame:
    return _t(s, d, "fefe_training_data").select("row_id", F.coalesce(curate.drop_reason(F.coalesce("topic", F.lit(""))), F.lit("keep")).alias("reason"))


@query
def rule_cases(s: SparkSession, d: str) -> DataFrame:
    rows = s.createDataFrame([(t,) for t in TOPICS], "topic string")
    return rows.select("topic", F.coalesce(curate.drop_reason(F.col("topic")), F.lit("keep")).alias("reason"), audit.topic_label(F.col("topic")).alias("label"))


@query
def language_votes(s: SparkSession, d: str) -> DataFrame:
    return _t(s, d, "externalsources").where("description is not null").select("source_id", language.stopword_language(F.col("description")).alias("lang"))


@query
def language_prefix(s: SparkSession, d: str) -> DataFrame:
    lang = F.coalesce(F.nullif(F.lower(F.substring("lang", 1, 2)), F.lit("")), F.lit("de"))
    return _t(s, d, "externalsources").select("source_id", language.with_prefix(text.normalize_whitespace(F.col("title")), lang).alias("context"))


@query
def quality_scores(s: SparkSession, d: str) -> DataFrame:
    topic, context = F.coalesce("topic", F.lit("")), F.coalesce("context", F.lit(""))
    return _t(s, d, "fefe_training_data").select("row_id", curate.quality_points(topic, context).cast("bigint").alias("points"))


@query
def quality_buckets(s: SparkSession, d: str) -> DataFrame:
    return quality_scores(s, d).groupBy(curate.bucket_of(F.col("points")).alias("bucket")).agg(F.count(F.lit(1)).alias("cnt"))


def _judged(s: SparkSession, d: str) -> DataFrame:
    rows = _t(s, d, "fefe_training_data")
    bare = F.regexp_replace(F.coalesce("context", F.lit("")), r"^\[Quelle: [A-Z]+\] ?", "")
    rows = rows.select("row_id", F.coalesce("topic", F.lit("")).alias("topic"), bare.alias("context"), text.normalize_whitespace(F.col("target_comment")).alias("target_comment"), "topic_source")
    return curate.judged(rows)


@query
def curated_rows(s: SparkSession, d: str) -> DataFrame:
    return _judged(s, d).select("row_id", "context", F.col("points").cast("bigint").alias("points"), "quality_bucket", "status")


@query
def curation_stats(s: SparkSession, d: str) -> DataFrame:
    return curate.stats(_judged(s, d).withColumn("topic_source", F.coalesce("topic_source", F.lit("unknown"))))


@query
def curated_posts(s: SparkSession, d: str) -> DataFrame:
    posts = sampling.first_of(_t(s, d, "messages"), [F.col("hextimestamp")], [F.col("scraped_at"), F.col("message_id")])
    entry = F.struct("source_pos", "source_id", F.struct("title", "description", "url").alias("source"))
    sources = _t(s, d, "externalsources").groupBy("hextimestamp").agg(F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["source"]).alias("sources"))
    joined = posts.join(sources, "hextimestamp", "left").withColumn("sources", F.coalesce("sources", F.array()))
    rows = joined.select(F.col("hextimestamp").alias("post_id"), F.col("url").alias("post_url"), "posted_at", "content", F.col("contenthtml").alias("content_html"), "sources")
    return curate.training_rows(curation.curate(rows))


@query
def dedup_first(s: SparkSession, d: str) -> DataFrame:
    return sampling.first_of(_t(s, d, "messages").select("message_id", "hextimestamp", "scraped_at"), [F.col("hextimestamp")], [F.col("scraped_at"), F.col("message_id")]).select("message_id", "hextimestamp")


@query
def dedup_rows(s: SparkSession, d: str) -> DataFrame:
    rows = _t(s, d, "fefe_training_data").select("row_id", "post_id")
    return sampling.first_of(rows, [F.coalesce("post_id", F.concat(F.lit("row "), F.col("row_id").cast("string")))], [F.col("row_id")])


@query
def message_count(s: SparkSession, d: str) -> DataFrame:
    return _t(s, d, "messages").agg(F.count(F.lit(1)).alias("scrapes"), F.countDistinct("hextimestamp").alias("posts"))


def _sampled(s: SparkSession, d: str, weighted: bool) -> DataFrame:
    rows = _t(s, d, "fefe_training_data").select("row_id", "post_id", "quality_bucket")
    return sampling.weighted_sample(rows, "row_id", "quality_bucket", 42, weighted).withColumn("copy_no", F.col("copy_no").cast("bigint"))


@query
def weighted_sample(s: SparkSession, d: str) -> DataFrame:
    return _sampled(s, d, True)


@query
def uniform_sample(s: SparkSession, d: str) -> DataFrame:
    return _sampled(s, d, False)


@query
def seeded_shuffle(s: SparkSession, d: str) -> DataFrame:
    return sampling.seeded_shuffle(_t(s, d, "fefe_training_data").select("row_id"), "row_id", 42)


def _benchmark(s: SparkSession, d: str) -> DataFrame:
    rows = _t(s, d, "fefe_training_data").select("row_id", "post_id", "topic", "context", "quality_bucket")
    unique = sampling.first_of(rows, [F.coalesce("post_id", F.concat(F.lit("row "), F.col("row_id").cast("string")))], [F.col("row_id")])
    return sampling.stratified(unique, "row_id", "quality_bucket", "context", 42, 100, 50)


@query
def stratified_benchmark(s: SparkSession, d: str) -> DataFrame:
    return sampling.with_rubric(_benchmark(s, d).select("row_id", "quality_bucket", "topic"))


@query
def benchmark_counts(s: SparkSession, d: str) -> DataFrame:
    return _benchmark(s, d).groupBy("quality_bucket").agg(F.count(F.lit(1)).alias("cnt"), F.count_if(language.is_non_german(F.col("context"))).alias("non_german"))


@query
def topic_labels(s: SparkSession, d: str) -> DataFrame:
    return _t(s, d, "fefe_training_data").select("row_id", audit.topic_label(F.col("topic")).alias("label"))


@query
def label_counts(s: SparkSession, d: str) -> DataFrame:
    return audit.shares(_t(s, d, "fefe_training_data"), audit.topic_label(F.col("topic")), "label").select("label", "cnt")


@query
def audit_shares(s: SparkSession, d: str) -> DataFrame:
    rows = _t(s, d, "fefe_training_data")
    parts = [audit.shares(rows, F.col(c), "key").withColumn("column_name", F.lit(c)) for c in ("quality_bucket", "topic_source")]
    return parts[0].unionByName(parts[1]).select("column_name", "key", "cnt", F.col("pct").cast("double").alias("pct"))


@query
def suspicious_totals(s: SparkSession, d: str) -> DataFrame:
    return audit.totals(_t(s, d, "fefe_training_data"), F.col("topic"))


@query
def top_topics(s: SparkSession, d: str) -> DataFrame:
    return audit.top_topics(_t(s, d, "fefe_training_data"), F.col("topic"), "row_id", 15)


@query
def examples_per_label(s: SparkSession, d: str) -> DataFrame:
    return audit.examples(_t(s, d, "fefe_training_data").select("row_id", "topic"), F.col("topic"), "row_id", 5).select("label", F.col("example_no").cast("bigint").alias("example_no"), "row_id")


@query
def prompt_text(s: SparkSession, d: str) -> DataFrame:
    return _t(s, d, "fefe_training_data").select("row_id", prompt.prompt_text(F.col("topic"), F.col("context"), F.col("url")).alias("prompt"))


def _turns() -> F.Column:
    return prompt.messages(F.col("topic"), F.col("context"), F.col("url"), F.col("target_comment"))


@query
def chat_messages(s: SparkSession, d: str) -> DataFrame:
    turns = _t(s, d, "fefe_training_data").select("row_id", F.posexplode(_turns()).alias("turn", "m"))
    return turns.select("row_id", F.col("turn").cast("bigint").alias("turn"), "m.role", "m.content")


@query
def chat_text(s: SparkSession, d: str) -> DataFrame:
    return _t(s, d, "fefe_training_data").select("row_id", prompt.chat_text(_turns()).alias("text"))


@query
def experiment_config(s: SparkSession, d: str) -> DataFrame:
    parts = [curation.experiment_config(s, "E3"), curation.experiment_config(s, "E1", epochs=2), curation.experiment_config(s, lr=1e-4)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select(F.coalesce("name", F.lit("none")).alias("name"), "packing", F.col("epochs").cast("bigint").alias("epochs"), "lr")


@query
def packed_sequences(s: SparkSession, d: str) -> DataFrame:
    return curation.pack(chat_text(s, d), "row_id", "text", 512)


@query
def batch_inference(s: SparkSession, d: str) -> DataFrame:
    return curation.generate(_t(s, d, "benchmark_set").select(prompt.prompt_text(F.col("topic"), F.col("context"), F.col("url")).alias("prompt")), None, ("base", "adapter"))
