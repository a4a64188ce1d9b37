"""The tree operators over every page of the small tables, against plain Python over the same nodes."""

import re

from quillspark import queries
from quillspark.operators.html import parse


def squeezed(t):
    return re.sub(r"\s+", " ", t).strip()


def pages(spark, small):
    return {r.message_id: parse(r.contenthtml) for r in spark.read.parquet(f"{small}/messages.parquet").select("message_id", "contenthtml").collect()}


def anchors(nodes):
    return [n for n in nodes if n["tag"] == "a" and re.match("https?://", n["attrs"].get("href", "").strip())]


def quotation(nodes, a):
    quote = next((n for n in nodes[a["pos"] + 1 : a["pos"] + 21] if n["tag"] == "blockquote"), None)
    if quote is None:
        return ""
    texts = [squeezed(n["text"]) for n in nodes[quote["pos"] + 1 : quote["stop"] + 1] if n["kind"] == "text"]
    return " ".join(t for t in texts if t)[:140]


def sentence(nodes, a):
    joined = ""
    for n in nodes[a["pos"] + 1 : a["pos"] + 61]:
        t = squeezed(n["text"]) if n["kind"] != "tag" else ""
        if t:
            joined = f"{joined} {t}".strip()
            if joined[-1] in ".!?" or len(joined) >= 140:
                break
    return joined[:140]


def headers(nodes):
    last = "unknown"
    for n in nodes:
        yield n["pos"], n["kind"], n["tag"], last
        if n["tag"] == "h3":
            last = "".join(m["text"] for m in nodes[n["pos"] + 1 : n["stop"] + 1] if m["kind"] == "text").strip()


def test_every_anchor(spark, small):
    parsed = pages(spark, small)
    for name, of in (("anchor_quotations", quotation), ("anchor_sentences", sentence)):
        want = sorted((k, a["pos"], a["attrs"]["href"], of(nodes, a)) for k, nodes in parsed.items() for a in anchors(nodes))
        assert sorted(map(tuple, queries.QUERIES[name](spark, small).collect())) == want
        assert len(want) > len(parsed) and len({w[3] for w in want}) > 50


def test_every_node(spark, small):
    want = {(k, *h) for k, nodes in pages(spark, small).items() for h in headers(nodes)}
    got = queries.QUERIES["node_headers"](spark, small).collect()
    assert len(got) == len(want) and set(map(tuple, got)) == want


def test_every_month_page(spark, small):
    rows = queries.QUERIES["month_headers"](spark, small).collect()
    months = {}
    for r in rows:
        months.setdefault(r.month, []).append(r)
    assert len(months) > 50
    for month, nodes in months.items():
        nodes.sort(key=lambda r: r.pos)
        assert [r.pos for r in nodes] == list(range(len(nodes))) and (nodes[0].tag, nodes[0].header) == ("h3", "unknown")
        assert all(r.header.startswith(f"{month[:4]}-{month[4:]}-") for r in nodes[1:])
        assert [r.header for r in nodes] == sorted((r.header for r in nodes), key=lambda h: "" if h == "unknown" else h)
    posts = spark.read.parquet(f"{small}/messages.parquet").selectExpr("length(contenthtml) - length(replace(contenthtml, '<li', '<l')) as n").collect()
    assert sum(r.tag == "li" for r in rows) == sum(p.n or 0 for p in posts) + len(posts)


def test_metadata_of_every_page(spark, small):
    fields = ["source_id", "title", "description", "author", "published", "site_name", "url"]
    want = spark.read.parquet(f"{small}/externalsources.parquet").select(fields).collect()
    assert sorted(map(tuple, queries.QUERIES["page_metadata"](spark, small).collect())) == sorted((*(v.strip() if isinstance(v, str) and k != 6 else v for k, v in enumerate(r)),) for r in want)


def test_ingestion_of_month_pages(spark):
    from quillspark.queries import QUERIES

    d = "/root/testdata/sf0.001"
    messages = spark.read.parquet(f"{d}/messages.parquet").collect()
    posts = QUERIES["ingested_posts"](spark, d).collect()
    assert {p.hexTimestamp for p in posts} == {m.hextimestamp for m in messages} and len(posts) == len({m.hextimestamp for m in messages})
    # a post without a list of its own is one item, so its page gives back what the archive knows of it
    one = {m.hextimestamp: m for m in messages if m.contenthtml.count("<li") == 1 and "<ul" not in m.contenthtml}
    by = {p.hexTimestamp: p for p in posts}
    seen = [(by[k].quoteCount == m.contenthtml.count("<blockquote"), by[k].url.endswith("?ts=" + k)) for k, m in one.items()]
    assert len(seen) > 50 and all(a and b for a, b in seen)
    for name, key in (("ingested_words", "word"), ("ingested_domains", "domain")):
        rows = QUERIES[name](spark, d).collect()
        total, parts = {r[key]: r.cnt for r in rows if r.bucket == "sum"}, {}
        for r in rows:
            if r.bucket != "sum":
                parts[r[key]] = parts.get(r[key], 0) + r.cnt
        assert total == parts and total
