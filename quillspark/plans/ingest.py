"""From month pages to posts, word counts and domain counts."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.functions.links import code, permalink
from quillspark.functions.text import token_count
from quillspark.functions.timecode import decode
from quillspark.operators.counts import domain_counts, word_counts
from quillspark.operators.html import elements, inner_text, link_target, linked_sources, list_items, nodes_of, parse, quote_count, repair_anchors, without_quotations
from quillspark.operators.sampling import first_of

BASE = "https://blog.linkstube.example/"


def items_of(pages: DataFrame) -> DataFrame:
    """(month, list_no, item_no, html): the list items of the pages, unclosed ones closed. pages: month, html."""
    fixed = pages.select("month", repair_anchors(F.col("html")).alias("html")).where(F.length("html") > 0)
    lists = fixed.select("month", F.posexplode(_list_html(F.col("html"))).alias("list_no", "ul"))
    items = lists.select("month", "list_no", F.posexplode(list_items(F.col("ul"))).alias("item_no", "body"))
    return items.select("month", "list_no", "item_no", F.concat(F.lit("<li>"), F.col("body"), F.lit("</li>")).alias("html"))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _list_html(pages: pd.Series) -> pd.Series:
    return pages.map(lambda p: _lists(p) if p else [])


def _lists(page: str) -> list[str]:
    """The source of the top-level lists of a page, of all lists where no list is at the top level."""
    nodes = parse(page)
    lists = [n for n in nodes if n["kind"] == "tag" and n["tag"] == "ul"]
    top = [n for n in lists if n["depth"] == 0] or lists
    return [_source(nodes, n) for n in top]


def _source(nodes: list[dict], root: dict) -> str:
    """The markup of an element, with attributes quoted and text escaped."""
    import html

    out: list[str] = []
    open_tags: list[dict] = []
    for n in nodes[root["pos"] : root["stop"] + 1]:
        while open_tags and open_tags[-1]["stop"] < n["pos"]:
            out.append(f"</{open_tags.pop()['tag']}>")
        if n["kind"] == "tag":
            out.append("<" + n["tag"] + "".join(f' {k}="{html.escape(v)}"' for k, v in n["attrs"].items()) + ">")
            if n["tag"] not in ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"):
                open_tags.append(n)
        elif n["kind"] == "comment":
            out.append(f"<!--{n['text']}-->")
        else:
            out.append(n["text"] if n["kind"] == "raw" else html.escape(n["text"], quote=False))
    return "".join(out) + "".join(f"</{n['tag']}>" for n in reversed(open_tags))


def post_items(items: DataFrame, base: str = BASE) -> DataFrame:
    """Items with everything that posts and counts need: text and links without quotations, code, time."""
    parsed = items.withColumn("nodes", nodes_of(F.col("html")))
    own = parsed.withColumn("own", without_quotations(F.col("nodes")))
    found = own.withColumn("content", inner_text(F.col("own"))).withColumn("hrefs", F.transform(elements(F.col("own"), "a"), link_target)).withColumn("quoteCount", quote_count(F.col("nodes"))).drop("nodes", "own")
    first = F.try_element_at("hrefs", F.lit(1))
    return found.withColumn("hexTimestamp", code(first)).withColumn("timestamp", decode(F.col("hexTimestamp"))).withColumn("url", permalink(first, base)).withColumn("wordCount", token_count(F.col("content")))


def aggregate(pages: DataFrame, linked: DataFrame | None = None, base: str = BASE) -> dict[str, DataFrame]:
    """posts, words, domains and the persisted items of the pages. Words count in all items, domains in all items with a code, posts once.

    ``linked`` (url and metadata columns) adds externalSources by lookup; without it they stay empty and no join is planned.
    """
    items = post_items(items_of(pages), base).persist()  # three consumers; lost blocks are recomputed from the pages
    words = word_counts(items, F.col("month"), "content")
    coded = items.where("timestamp is not null")
    rest = F.slice("hrefs", 2, F.greatest(F.size("hrefs"), F.lit(1)))
    domains = domain_counts(coded, F.col("month"), rest)
    posts = first_of(coded.withColumn("sourcesCount", F.size(rest).cast("int")), [F.col("hexTimestamp")], [F.col("month"), F.col("list_no"), F.col("item_no")])
    if linked is None:
        posts = posts.withColumn("externalSources", F.array().cast("array<struct<title:string,description:string,author:string,published:string,site_name:string,url:string>>"))
    else:
        links = posts.select(F.col("hexTimestamp").alias("post_id"), F.posexplode(rest).alias("pos", "href"))
        posts = posts.join(linked_sources(links, linked).withColumnRenamed("post_id", "hexTimestamp"), "hexTimestamp", "left").withColumn("externalSources", F.coalesce("sources", F.array()))
    posts = posts.select("timestamp", "hexTimestamp", F.col("quoteCount"), F.col("wordCount").cast("int").alias("wordCount"), "sourcesCount", "url", "content", F.col("html").alias("contentHtml"), "externalSources", "month")
    return {"posts": posts, "words": words, "domains": domains, "items": items}
