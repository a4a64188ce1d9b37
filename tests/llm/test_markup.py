import json
import random

import pytest
from pyspark.sql import functions as F

from quillspark.llm import markup
from quillspark.llm.markup import LEAST_PAGES, Inference, Wrapper, align, clean, clean_pages, constants, find_markup, fold, infer_wrappers, residue, slot_text, slotted, stream, to_text


@pytest.mark.parametrize(
    "text, kinds",
    [
        ("a **b** c", ["markdown"]), ("a __b c__ d", ["markdown"]), ("~~b~~", ["markdown"]), ("x `y` z", ["markdown"]), ("\n## T\n", ["markdown"]), ("T x\n=====\n", ["markdown"]), ("[a b][1] und\n[1]: https://a.test/x", ["markdown"]),
        ("![x](https://a.test/y.png)", ["markdown"]), ("| a | b |\n|---|---|\n| 1 | 2 |", ["markdown"]), ("- [ ] x", ["markdown"]), ("```\nx = {k: v}\n[[ -f a ]]\n```", ["markdown"]),
        ("== T ==", ["wiki"]), ("'''b'''", ["wiki"]), ("[[a|b]]", ["wiki"]), ("{{Zitat|x}}", ["wiki"]), ("{| class=\"wikitable\"\n|-\n| a || b\n|}", ["wiki"]), ("#WEITERLEITUNG [[X]]", ["wiki"]), ("[https://a.test/b Text]", ["wiki"]),
        ("\\section{A}", ["latex"]), ("f\\\"ur", ["latex"]), ("$x_{0} = y^2$", ["latex"]), ("$$\\sum_i x$$", ["latex"]), ("\\(O(n)\\)", ["latex"]), ("x~\\cite{a}", ["latex"]), ("siehe \\ref{t}", ["latex"]),
        ("a <b>b</b>", ["html"]), ("K &amp; M", ["html"]), ("x<br />y", ["html"]), ("<!-- x -->", ["html"]), ("&#228;hnlich", ["html"]),
        ("*hust* [l] [sic] [1] [...] 2 * 3 * 7", []), ("Also wenn a < b und b > c, <3", []), ("C:\\temp\\neu\\konf.ini", []), ("C# und F# #neuland", []), ("R&D K&M GmbH & Co. KG", []), ("zwischen $5 und $10, $HOME war leer", []),
        ("{a, b} ~ 40 % ~ --> ¯\\_(ツ)_/¯", []), ("def f(*args, **kw): return args[0] == kw", []), ("x\nif [[ -f /etc/konf ]]; then echo $HOME; fi\ny", []), ("#include <konf.h>\nint main(int argc, char **argv) { return 0; }", []), ("SELECT a FROM t WHERE a <> b;", []), ("", []),
    ],
)
def test_kinds(text, kinds):
    assert residue(text, False) == kinds


def test_page_slots():
    page = "<li>a &lt;b&gt;x&lt;/b&gt; <pre><code>**kw = '''x'''</code></pre><blockquote>[[Q]]</blockquote> <a href='u'>**fe</a>tt**"
    assert residue(slot_text(page), True) == ["markdown", "wiki"]
    assert residue("&lt;b&gt;", True) == []


def test_clean_keeps_structure():
    text = clean("== T ==\nf\\\"ur **b** [[a|c]] {{Zitat|d}} <i>e</i> &amp; [f](https://a.test/)\n\\begin{itemize}\n\\item g\n\\end{itemize}\n```\n**kw\n```\n$x_1 = 2$")
    assert text.split("\n")[0] == "## T" and "für b c d e & f" in text and "- g" in text and "```\n**kw\n```" in text and "$x_1 = 2$" in text
    page = "<h2>T</h2><ul><li>a <sup>2</sup><li>b</ul><pre>x  y</pre><blockquote>q</blockquote><table><tr><td>1<td>2</table>"
    assert to_text(page) == "## T\n\n- a ^{2}\n- b\n\n```\nx  y\n```\n\n> q\n\n | 1 | 2"


def _page(r):
    """A page of a template: a mark, a title, paragraphs with inline tags, perhaps a list or a quotation, and a footer."""
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    parts = [f"<div><a href='?{word()}'>[m]</a><h2>{word()}</h2>"]
    parts += [f"<p>{word()} <b>{word()}</b> {word()}</p>" for _ in range(r.randrange(1, 4))]
    if r.random() < 0.5:
        parts.append("<ul>" + "".join(f"<li>{word()}" for _ in range(r.randrange(1, 5))) + "</ul>")
    if r.random() < 0.3:
        parts.append(f"<blockquote>{word()} <i>{word()}</i></blockquote>")
    return "".join(parts) + "<table><tr><td>**Impressum** [[Start]]</td></tr></table></div>"


def test_wrapper_separates_template_and_slots():
    r = random.Random(1)
    made = Inference()
    pages = [_page(r) for _ in range(200)]
    for p in pages:
        made.add(p)
    w = Wrapper(made.wrapper.items, len(made.seen))
    assert all(w.fits(stream(p)) for p in pages + [_page(r) for _ in range(200)])
    assert w.template == {"=[m]", "=**Impressum** [[Start]]"} and len(w.items) < 40
    assert not w.fits(stream("<p>a<table><tr><td>b")) and not w.fits(stream("<h2>T</h2>"))
    assert residue(slot_text(pages[0], w.template), True) == [] and residue(slot_text(pages[0]), True) == ["markdown", "wiki"]
    assert '["ul", ["+", ["li", "#"]], "/ul"]' in json.dumps(w.items)


def test_alignment():
    one, two, three = fold(stream("<li>A<p>x")), fold(stream("<li>A<p>y<p>z<p>w")), fold(stream("<li>A<blockquote>q</blockquote>"))
    assert align(one, two)[:2] == ["li", "=A"]
    all_three = align(align(one, two), three)
    assert constants(all_three) == {"=A"} and all(Wrapper(all_three, 99).fits(stream(p)) for p in ("<li>A<p>x", "<li>A<p>y<p>z<p>w", "<li>A<blockquote>q</blockquote>"))
    assert not Wrapper(all_three, 99).fits(stream("<li>B<p>x")) and not Wrapper(all_three, 99).fits(stream("<li>A<table>"))
    assert fold(["a", "b", "a", "b", "a", "b", "c"]) == [["+", ["a", "b"]], "c"] and fold(["a", "a"]) == [["+", ["a"]]]


def test_pieces_of_a_host_merge(spark):
    r = random.Random(2)
    df = spark.createDataFrame([("h", _page(r)) for _ in range(120)] + [("one", "<p>**a**")] + [(None, "<p>x"), ("h", None), ("h", "")], "h string, page string").repartition(7)
    got = {x.host: x for x in infer_wrappers(df, F.col("h"), "page").collect()}
    w = Wrapper(json.loads(got["h"].wrapper), got["h"].distinct)
    assert got["h"].pages == 120 and got["h"].distinct == LEAST_PAGES and w.template == {"=[m]", "=**Impressum** [[Start]]"}
    assert all(w.fits(stream(_page(r))) for _ in range(50)) and (got["one"].pages, got["one"].distinct) == (1, 1)


def test_template_is_no_residue(spark):
    r = random.Random(3)
    pages = [_page(r) for _ in range(40)]
    rows = [(i, None, p, "h") for i, p in enumerate(pages)] + [(90, None, pages[0].replace("<h2>", "<h2>**x** "), "h"), (91, None, pages[0], "few")]
    df = spark.createDataFrame(rows, "id long, content string, page string, host string")
    got = sorted((x.id, x.markup, x.fits_wrapper) for x in find_markup(df, "id", "content", "page", F.col("host")).collect())
    assert got == [(90, "markdown", True), (91, "markdown", True), (91, "wiki", True)]
    texts = {x.id: x.clean_text for x in clean_pages(df, "id", "content", "page", F.col("host")).collect()}
    assert "Impressum" not in texts[0] and "[m]" not in texts[0] and "Impressum" in texts[91]


def test_tables(spark):
    schema = "id long, plain string, page string, host string, wrapper string"
    long = "wort " * 50_000 + "**fett**"
    rows = [(1, "**a**", "<p>b", "h", "x"), (2, None, None, None, None), (3, "", "", "h", ""), (4, long, "<p>[[x]]", None, "y"), (4, long, "<p>[[x]]", None, "y")]
    df = spark.createDataFrame(rows, schema)
    got = sorted((r.id, r.field_name, r.markup) for r in find_markup(df, "id", "plain", "page", F.col("host")).collect())
    assert got == [(1, "plain", "markdown"), (4, "page", "wiki"), (4, "page", "wiki"), (4, "plain", "markdown"), (4, "plain", "markdown")]
    texts = {r.id: r.clean_text for r in clean_pages(df, "id", "plain", "page", F.col("host")).collect()}
    assert texts[1] == "b" and texts[2] is None and texts[4] == "x"
    assert find_markup(spark.createDataFrame([], schema), "id", "plain", "page", F.col("host")).count() == 0


def _long_page(r, blocks):
    """A page of one template with a body of ``blocks`` elements in no order."""
    tags = ["p", "div", "li", "br", "h3", "td", "pre", "hr"]
    body = "".join(f"<{r.choice(tags)}>" + ("".join(r.choice("abcdefgh") for _ in range(5)) if r.random() < 0.7 else "") for _ in range(blocks))
    return f"<div>[m]{body}<footer>**Impressum** [[Start]]</footer>"


def test_wrappers_of_any_length_are_extended():
    r = random.Random(6)
    for blocks, n in ((400, 12), (40, 120)):
        pages = [_long_page(r, blocks) for _ in range(n)]
        made = Inference()
        for p in pages:
            made.add(p)
        w = Wrapper(made.wrapper.items, len(made.seen))
        assert len(w.items) > 400 and all(w.fits(stream(p)) for p in pages) and w.template == {"=[m]", "=**Impressum** [[Start]]"}


def test_alignment_matches_both_sides():
    r = random.Random(7)
    for _ in range(500):
        names = ["p", "/p", "li", "ul", "/ul", "br", "td", "=A", "=B", "=C", "=D"][: r.randrange(3, 12)]
        pages = [[r.choice(names) for _ in range(r.randrange(14))] for _ in range(5)]
        wrapper = fold(pages[0])
        for n, p in enumerate(pages):
            wrapper = align(wrapper, fold(slotted(p, constants(wrapper))))
            assert all(Wrapper(wrapper, 0).fits(q) for q in pages[: n + 1])


def test_pieces_of_long_pages_merge(spark, monkeypatch):
    r = random.Random(8)
    rows = [(i, None, _long_page(r, 200), "h") for i in range(24)] + [(50, None, "<p>**x**", "few"), (51, "[[y]]", None, None), (52, None, "<p>{{z}}", None)]
    df = spark.createDataFrame(rows, "id long, content string, page string, host string").repartition(5)
    (got,) = infer_wrappers(df.where("host = 'h'"), F.col("host"), "page").collect()
    w = Wrapper(json.loads(got.wrapper), got.distinct)
    assert got.pages == 24 and all(w.fits(stream(p)) for _, _, p, h in rows if h == "h") and w.template == {"=[m]", "=**Impressum** [[Start]]"}
    found, texts = [], []
    for beside, held in ((10**9, 10**9), (0, 1)):  # beside every page, and ahead of the pages, handed on after each other host
        monkeypatch.setattr(markup, "BESIDE", beside)
        monkeypatch.setattr(markup, "HELD", held)
        found.append(sorted((x.id, x.field_name, x.markup, x.fits_wrapper) for x in find_markup(df, "id", "content", "page", F.col("host")).collect()))
        texts.append({x.id: (x.clean_text, x.fits_wrapper) for x in clean_pages(df, "id", "content", "page", F.col("host")).collect()})
    assert found[0] == found[1] == [(50, "page", "markdown", True), (51, "content", "wiki", None), (52, "page", "wiki", None)]
    assert texts[0] == texts[1] and len(texts[0]) == len(rows) and all("Impressum" not in texts[0][i][0] and texts[0][i][1] for i in range(24))
