"""Pages as node tables, and the tree operators as expressions over them.

Python parses; everything else is native. A node array is in document order; ``stop`` is the position of the last node
inside an element, so that containment is an interval test.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.functions.links import is_external
from quillspark.functions.patterns import DEICTIC_WORDS, LINE_BREAK, MAPS_BOILER, MAPS_URL, java, whole_words
from quillspark.functions.text import first_sentence, join_context, normalize_whitespace, strip_ws, truncate
from quillspark.runtime import computed

NODE = T.StructType(
    [
        T.StructField("pos", T.IntegerType()),
        T.StructField("kind", T.StringType()),
        T.StructField("tag", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
        T.StructField("stop", T.IntegerType()),
        T.StructField("depth", T.IntegerType()),
    ]
)
# Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())


class _Nodes(HTMLParser):
    """Lenient tree: an end tag closes the nearest open element of its name and all inside it; others are ignored."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes: list[dict] = []
        self.open: list[int] = []

    def _add(self, kind: str, tag: str | None, text: str | None, attrs: dict | None) -> int:
        pos = len(self.nodes)
        self.nodes.append({"pos": pos, "kind": kind, "tag": tag, "text": text, "attrs": attrs or {}, "stop": pos, "depth": len(self.open)})
        return pos

    def handle_starttag(self, tag: str, attrs: list) -> None:
        pos = self._add("tag", tag, None, {k: v or "" for k, v in reversed(attrs)})
        if tag not in VOID:
            self.open.append(pos)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self._add("tag", tag, None, {k: v or "" for k, v in reversed(attrs)})

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, -1, -1):
            if self.nodes[self.open[i]]["tag"] == tag:
                for pos in self.open[i:]:
                    self.nodes[pos]["stop"] = len(self.nodes) - 1
                del self.open[i:]
                return

    def handle_data(self, data: str) -> None:
        last = self.nodes[-1] if self.nodes else None
        if last and last["kind"] == "text" and last["depth"] == len(self.open) and last["pos"] == len(self.nodes) - 1:
            last["text"] += data
        else:
            raw = bool(self.open) and self.nodes[self.open[-1]]["tag"] in ("script", "style")
            self._add("raw" if raw else "text", None, data, None)

    def handle_comment(self, data: str) -> None:
        self._add("comment", None, data, None)


def parse(page: str | None) -> list[dict]:
    if not page:
        return []
    p = _Nodes()
    try:
        p.feed(page)
        p.close()
    except Exception:  # a page that cannot be parsed has the nodes up to the fault
        pass
    for pos in p.open:
        p.nodes[pos]["stop"] = len(p.nodes) - 1
    return p.nodes


@F.pandas_udf(T.ArrayType(NODE))
def nodes_of(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in pages:
        yield s.map(parse)


# --- regular operators on raw pages


def _excess(line: Column) -> Column:
    return F.regexp_count(line, F.lit("<a")) - F.regexp_count(line, F.lit("</a>"))


def repair_anchors(page: Column) -> Column:
    """Each line closed with as many ``</a>`` as are missing in it; the lines are joined without a separator."""
    return F.array_join(F.transform(F.split(page, LINE_BREAK), lambda x: F.concat(x, F.repeat(F.lit("</a>"), F.greatest(F.lit(0), _excess(x))))), "")


def invalid_anchor_lines(page: Column) -> Column:
    return F.size(F.filter(F.split(page, LINE_BREAK), lambda x: _excess(x) != 0)).cast("bigint")


def list_items(page: Column) -> Column:
    """The contents of the list items of a list, split at each opening tag, unclosed ones included."""
    parts = F.split(page, "<li[^>]*>")
    return F.transform(F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1))), lambda x: F.replace(x, F.lit("</ul>"), F.lit("")))


# --- expressions over a node array


def _tag(n: Column, *names: str) -> Column:
    return (n["kind"] == "tag") & n["tag"].isin(*names)


def elements(nodes: Column, *names: str) -> Column:
    return F.filter(nodes, lambda n: _tag(n, *names))


def top_lists(nodes: Column) -> Column:
    """Lists at the top level; lists of any depth if there are none."""
    top = F.filter(nodes, lambda n: _tag(n, "ul") & (n["depth"] == 0))
    return F.when(F.size(top) > 0, top).otherwise(elements(nodes, "ul"))


def without_quotations(nodes: Column) -> Column:
    """The nodes outside all quotations."""
    quotes = elements(nodes, "blockquote")
    return F.filter(nodes, lambda n: ~F.exists(quotes, lambda q: (n["pos"] >= q["pos"]) & (n["pos"] <= q["stop"])))


def quote_count(nodes: Column) -> Column:
    return F.size(elements(nodes, "blockquote"))


def inner_text(nodes: Column) -> Column:
    return strip_ws(F.array_join(F.transform(F.filter(nodes, lambda n: n["kind"] == "text"), lambda n: n["text"]), ""))


def text_inside(nodes: Column, of: Column) -> Column:
    """The non-empty texts of an element joined by blanks."""
    texts = F.transform(F.filter(nodes, lambda n: (n["kind"] == "text") & (n["pos"] > of["pos"]) & (n["pos"] <= of["stop"])), lambda n: normalize_whitespace(n["text"]))
    return F.array_join(F.filter(texts, lambda t: t != ""), " ")


def link_target(n: Column) -> Column:
    return F.coalesce(F.try_element_at(n["attrs"], F.lit("href")), F.try_element_at(n["attrs"], F.lit("ref")))


def external_anchors(nodes: Column) -> Column:
    """array<struct<pos, stop, href, text>> of the external links in order, quotations included."""
    found = F.filter(elements(nodes, "a"), lambda n: is_external(F.coalesce(F.try_element_at(n["attrs"], F.lit("href")), F.lit(""))))
    return F.transform(found, lambda n: F.struct(n["pos"].alias("pos"), n["stop"].alias("stop"), n["attrs"]["href"].alias("href"), text_inside(nodes, n).alias("text")))


def quotation_after(nodes: Column, anchor: Column, reach: int = 20, most: int = 140) -> Column:
    """The text of the first quotation among the next ``reach`` nodes, empty without one."""
    near = F.slice(nodes, anchor["pos"] + 2, reach)
    quote = F.try_element_at(elements(near, "blockquote"), F.lit(1))
    return F.coalesce(truncate(text_inside(nodes, quote), most), F.lit(""))


def sentence_after(nodes: Column, anchor: Column, reach: int = 60, most: int = 140) -> Column:
    """Texts from the anchor's own on, until they end a sentence or are long enough, or ``reach`` nodes are passed."""
    near = F.slice(nodes, anchor["pos"] + 2, reach)
    texts = F.filter(F.transform(F.filter(near, lambda n: n["kind"] != "tag"), lambda n: normalize_whitespace(n["text"])), lambda t: t != "")
    done = lambda s: s.rlike("[.!?]$") | (F.length(s) >= most)
    joined = F.aggregate(texts, F.lit(""), lambda s, t: F.when((s != "") & done(s), s).otherwise(F.when(s == "", t).otherwise(F.concat_ws(" ", s, t))))
    return F.coalesce(truncate(joined, most), F.lit(""))


def with_topic(rows: DataFrame, nodes: str, title: Column, description: Column) -> DataFrame:
    """``rows`` with topic, context and topic_source by the rules: anchor, quotation, deictic words, maps, else the linked page."""
    d = computed(rows, _anchors=external_anchors(F.col(nodes)), _title=normalize_whitespace(title), _desc=normalize_whitespace(description), _both=join_context(title, description))
    d = computed(d, _first=F.try_element_at("_anchors", F.lit(1)), _second=F.coalesce(F.try_element_at("_anchors", F.lit(2))["text"], F.lit("")), _n=F.size("_anchors"))
    first, text, second, quote, extra, topic = F.col("_first"), F.col("_text"), F.col("_second"), F.col("_quote"), F.col("_extra"), F.col("_topic")
    d = computed(d, _text=F.coalesce(first["text"], F.lit("")), _quote=quotation_after(F.col(nodes), first), _extra=sentence_after(F.col(nodes), first))
    s = lambda topic, source: F.struct(topic.alias("_topic"), F.lit(source).alias("_source"))
    step = F.when(F.length(quote) >= 20, s(F.concat(text, F.lit(": "), quote), "html_anchor+blockquote")).otherwise(s(text, "html_anchor"))
    deictic = text.rlike(java(whole_words(DEICTIC_WORDS), True))
    step = (
        F.when(deictic & (F.length(extra) >= 20), s(F.concat(text, F.lit(" "), extra), "html_text"))
        .when(deictic & (F.length(second) >= 20), s(F.concat(text, F.lit(" ("), second, F.lit(")")), "html_text"))
        .otherwise(step)
    )
    d = computed(d, _step=step).select("*", "_step.*")
    maps = F.coalesce(first["href"].rlike(java(MAPS_URL, True)), F.lit(False)) & (topic.rlike(java(MAPS_BOILER, True)) | (F.length(topic) < 40)) & (F.length(extra) >= 20)
    out = lambda topic, context, source: F.struct(topic.alias("topic"), context.alias("context"), source.alias("topic_source"))
    anchored = out(
        strip_ws(truncate(F.when(maps, extra).otherwise(topic), 180)),
        strip_ws(F.when(F.col("_desc") != "", F.col("_both")).otherwise(F.col("_title"))),
        F.when(maps, F.lit("html_text")).otherwise(F.col("_source")),
    )
    chosen = (
        F.when(F.col("_n") > 0, anchored)
        .when(F.length("_title") >= 18, out(truncate(F.col("_title"), 180), truncate(F.col("_desc"), 160), F.lit("external_title")))
        .when(F.length("_desc") >= 18, out(truncate(first_sentence(F.col("_desc")), 180), F.lit(""), F.lit("external_desc")))
        .otherwise(out(F.lit(""), F.lit(""), F.lit("none")))
    )
    return computed(d, _chosen=chosen).select(*rows.columns, "_chosen.*")


def _meta(nodes: Column, attribute: str, value: str) -> Column:
    """The trimmed content of the first such meta element; null without the element, empty without content."""
    found = F.try_element_at(F.filter(elements(nodes, "meta"), lambda n: F.try_element_at(n["attrs"], F.lit(attribute)) == value), F.lit(1))
    return F.when(found.isNotNull(), strip_ws(F.coalesce(F.try_element_at(found["attrs"], F.lit("content")), F.lit(""))))


def _element_text(nodes: Column, tag: str) -> Column:
    found = F.try_element_at(elements(nodes, tag), F.lit(1))
    texts = F.transform(F.filter(nodes, lambda n: n["kind"].isin("text", "raw") & (n["pos"] > found["pos"]) & (n["pos"] <= found["stop"])), lambda n: n["text"])
    return F.when(found.isNotNull(), strip_ws(F.array_join(texts, "")))


def _chain(*candidates: Column) -> Column:
    """The first non-empty candidate; empty if all that exist are empty, null if none exists."""
    full = [F.nullif(c, F.lit("")) for c in candidates]
    return F.coalesce(*full, *candidates)


def page_metadata(nodes: Column, url: Column) -> Column:
    """struct<title, description, author, published, site_name, url> of a linked page."""
    time = F.try_element_at(elements(nodes, "time"), F.lit(1))
    when = F.coalesce(strip_ws(F.try_element_at(time["attrs"], F.lit("datetime"))), _element_text(nodes, "time"))
    return F.struct(
        _chain(_meta(nodes, "property", "og:title"), _meta(nodes, "name", "twitter:title"), _element_text(nodes, "title"), _element_text(nodes, "h1")).alias("title"),
        _chain(_meta(nodes, "property", "og:description"), _meta(nodes, "name", "twitter:description"), _meta(nodes, "name", "description")).alias("description"),
        _chain(_meta(nodes, "name", "author"), _meta(nodes, "property", "article:author"), _meta(nodes, "name", "twitter:creator")).alias("author"),
        _chain(_meta(nodes, "property", "article:published_time"), _meta(nodes, "name", "date"), when).alias("published"),
        _chain(_meta(nodes, "property", "og:site_name"), _meta(nodes, "name", "application-name")).alias("site_name"),
        url.alias("url"),
    )


# --- node tables


def node_table(pages: DataFrame, key: str, page: str) -> DataFrame:
    """One row per node: key and the fields of the node."""
    return pages.select(key, F.explode(nodes_of(F.col(page))).alias("n")).select(key, "n.*")


def header_before(pages: DataFrame, key: str, page: str) -> DataFrame:
    """The node table with ``header``: the text of the last ``h3`` with a text that begins before the node, ``unknown``
    without one. Each page is parsed once and its headers are found within its own nodes, without an exchange."""
    parsed = pages.select(key, nodes_of(F.col(page)).alias("_n"))
    inside = lambda h: F.filter(F.col("_n"), lambda n: (n["kind"] == "text") & (n["pos"] > h["pos"]) & (n["pos"] <= h["stop"]))
    heads = F.transform(elements(F.col("_n"), "h3"), lambda h: F.struct(h["pos"].alias("pos"), F.transform(inside(h), lambda n: n["text"]).alias("texts")))
    named = F.transform(F.filter(heads, lambda h: F.size(h["texts"]) > 0), lambda h: F.struct(h["pos"].alias("pos"), strip_ws(F.array_join(h["texts"], "")).alias("text")))
    parsed = computed(parsed, _heads=named)
    last = lambda n: F.try_element_at(F.filter(F.col("_heads"), lambda h: h["pos"] < n["pos"]), F.lit(-1))["text"]
    nodes = F.transform("_n", lambda n: F.struct(n.alias("n"), F.coalesce(last(n), F.lit("unknown")).alias("header")))
    return parsed.select(key, F.explode(nodes).alias("x")).select(key, "x.n.*", "x.header")


def linked_sources(links: DataFrame, pages: DataFrame) -> DataFrame:
    """(post_id, sources): for each post the metadata of its external links in order, inner semantics, no de-duplication.

    links: post_id, pos, href; pages: url and the metadata columns. Links to the archive itself or without http are left out.
    """
    wanted = links.where(~F.col("href").rlike(r"^/?\?ts=") & F.col("href").startswith("http"))
    found = wanted.join(pages, wanted["href"] == pages["url"])
    entry = F.struct("pos", F.struct("title", "description", "author", "published", "site_name", "url").alias("source"))
    return found.groupBy("post_id").agg(F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["source"]).alias("sources"))
