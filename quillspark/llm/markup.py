"""Problem 3: markup residue, and clean text that keeps headings, lists, code and formulas.

Pages of one host share a template. Their token streams (block tags and texts) are aligned one after the other into a
wrapper, a union-free regular expression: differing texts become a slot, what one side lacks an optional group, and what
repeats a repeated group. Only pages that the wrapper does not match yet are aligned. Every task infers the wrappers of its
hosts, which are then aligned as a tree, so that a hot host is inferred in pieces. Texts that all pages of a host have in
the same place are its template; what the wrapper leaves to the slots is searched for markup of other languages, code
excepted, and is the text that comes out.
"""

from __future__ import annotations

import html
import json
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.runtime import cut_lineage

KINDS = ("html", "markdown", "wiki", "latex")

# The elements of HTML, those that begin a new line, and those that hold code.
_ELEMENTS = (
    "a abbr acronym address applet area article aside audio b base basefont bdo big blink blockquote body br button canvas caption center cite code col colgroup dd del details dfn dir div dl dt em embed fieldset figcaption figure font footer form "
    "frame frameset h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label legend li link main map mark marquee menu meta nav nobr noscript object ol optgroup option p param picture pre q s samp script section select small source "
    "span strike strong style sub summary sup svg table tbody td textarea tfoot th thead time title tr tt u ul var video wbr"
).split()
_BLOCKS = frozenset("address article aside blockquote body br caption center dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select table tbody td tfoot th thead title tr ul".split())
_CODE = frozenset("pre code tt kbd samp script style".split())
_VOID = frozenset("area base basefont br col embed frame hr img input link meta param source wbr".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?\]\]>|<!?/?[a-zA-Z][^\s<>/]*(?:\"[^\"]*\"|'[^']*'|[^<>\"'])*>", re.S)
_NAME = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)")


def tokens(page: str) -> list[tuple[str, str]]:
    """(tag, '') and ('#', text) in order; end tags with a slash, entities decoded, comments left out, tags in lower case."""
    out, last = [], 0
    for m in _TOKEN.finditer(page):
        if m.start() > last:
            out.append(("#", html.unescape(page[last : m.start()])))
        n = _NAME.match(m.group())
        if n:
            out.append((n.group(1) + n.group(2).lower(), ""))
        last = m.end()
    if last < len(page):
        out.append(("#", html.unescape(page[last:])))
    return out


# --- wrappers: lists of items. An item is a block tag, "=" and a text of the template, the slot "#", or a group ["?", items]
# or ["+", items]. Inline tags belong to the text around them.

SLOT = "#"
#: Distinct pages of a host from which its constant texts are taken for its template.
LEAST_PAGES = 10
#: Memory only, no rows: items of all wrappers that a task holds before it hands them to the merge, bytes of steps that a
#: wrapper remembers before it works them out anew, and characters of a wrapper that may stand beside every page.
HELD = 200_000
REMEMBERED = 2_000_000
BESIDE = 8_000


def stream(page: str | list[tuple[str, str]]) -> list[str]:
    """The block tags and texts of a page, texts behind "="."""
    out = []
    for tag, text in tokens(page) if isinstance(page, str) else page:
        if tag != "#":
            if tag.lstrip("/") in _BLOCKS:
                out.append(tag)
        elif text := text.strip():
            out.append("=" + text)
    return out


def slotted(items: list[str], template: frozenset[str] | set[str]) -> list[str]:
    """A stream with slots in place of all texts but those of ``template``."""
    out: list[str] = []
    for i in items:
        if i[0] != "=" or i in template:
            out.append(i)
        elif not out or out[-1] != SLOT:
            out.append(SLOT)
    return out


def constants(items: list) -> set[str]:
    """The template texts of a wrapper: those that stand in no optional group."""
    out: set[str] = set()
    for i in items:
        if isinstance(i, str):
            if i[0] == "=":
                out.add(i)
        elif i[0] == "+":
            out |= constants(i[1])
    return out


def _textual(item: object) -> bool:
    return isinstance(item, str) and item[0] in "=#"


def _bare(item: object) -> object:
    return item[1][0] if isinstance(item, list) and item[0] == "?" and len(item[1]) == 1 else item


def _repeating(items: list, n: int) -> int | None:
    """The least length from ``n`` at which items repeat next to each other or go on with the group before them."""
    codes: dict[str, int] = {}
    ids = np.array([codes.setdefault(i if isinstance(i, str) else json.dumps(i), len(codes)) for i in items], np.int32)
    textual = np.array([_textual(i) for i in items], bool)
    more = set()
    for k, i in enumerate(items):
        if isinstance(i, list) and (group := _bare(i))[0] == "+" and items[k + 1 : k + 1 + len(group[1])] == group[1]:
            more.add(len(group[1]))
    for k in range(n, len(items) // 2 + 1):
        if k in more:
            return k
        same = ids[:-k] == ids[k:]
        if k == 1:
            same &= ~textual[:-1]
        if np.count_nonzero(same) >= k and np.diff(np.flatnonzero(~same), prepend=-1, append=len(same)).max() > k:
            return k
    return None


def fold(items: list) -> list:
    """Adjacent repetitions of one or more items as a repeated group, shortest first, until none is left."""
    n: int | None = 1
    while (n := _repeating(items, n)) is not None:
        out: list = []
        i = 0
        while i < len(items):
            block = items[i : i + n]
            k = i + n
            while len(block) == n and items[k : k + n] == block:
                k += n
            before = _bare(out[-1]) if out else None
            if k > i + n and not _textual(block[0] if n == 1 else ()):
                inner = [_bare(block[0])] if n == 1 else block
                group = inner[0] if n == 1 and isinstance(inner[0], list) and inner[0][0] == "+" else ["+", inner]
                out.append(["?", [group]] if n == 1 and inner[0] is not block[0] else group)
                i = k
            elif isinstance(before, list) and before == ["+", block]:
                i += n  # one more of the group before it
            else:
                out.append(items[i])
                i += 1
        shorter = len(out) < len(items)
        items, n = out, 1 if shorter else n + 1
    return items


def _optional(run: list) -> list:
    """A run that only one side has, as optional groups, one for each element; texts that not every page has are slots."""

    def slots(items: list) -> list:
        out: list = []
        for i in items:
            i = [i[0], slots(i[1])] if isinstance(i, list) else SLOT if i[0] == "=" else i
            if not (i == SLOT and out and out[-1] == SLOT):
                out.append(i)
        return out

    out, i = [], 0
    while i < len(run):
        item, k = run[i], i
        if isinstance(item, str) and item[0] not in "=#/" and item not in _VOID:
            depth = 0
            for j in range(i, len(run)):
                depth += (run[j] == item) - (run[j] == "/" + item)
                if depth == 0:
                    k = j
                    break
        group = slots(run[i : k + 1])
        out.append(group[0] if len(group) == 1 and isinstance(group[0], list) and group[0][0] == "?" else ["?", group])
        i = k + 1
    return out


class _Scores:
    """scores[i][j]: the best alignment of the items from i and from j. Kept is every root-th row; the rows between are
    worked out again when the walk from the first row comes to them, so that two long pages fit into memory."""

    def __init__(self, x: list[str], y: list[str], tx: list[bool], ty: list[bool]) -> None:
        codes: dict[str, int] = {}
        self.x = [codes.setdefault(k, len(codes)) for k in x]
        self.y = np.array([codes.setdefault(k, len(codes)) for k in y], np.int32)
        self.tx, self.ty = tx, np.array(ty, np.int32)
        self.step = math.isqrt(len(x)) + 1
        row = np.zeros(len(y) + 1, np.int32)
        self.kept = {len(x): row}
        for i in range(len(x) - 1, -1, -1):
            row = self._before(i, row)
            if i % self.step == 0:
                self.kept[i] = row
        self.rows: dict[int, np.ndarray] = {}

    def _before(self, i: int, below: np.ndarray) -> np.ndarray:
        same = np.where(self.y == self.x[i], 2, self.ty if self.tx[i] else 0)
        row = np.zeros_like(below)
        row[:-1] = np.maximum.accumulate(np.maximum(below[:-1], below[1:] + same)[::-1])[::-1]
        return row

    def __getitem__(self, i: int) -> np.ndarray:
        if i not in self.rows:
            last = min(i - i % self.step + self.step, len(self.x))
            self.rows = {last: self.kept[last]}
            for k in range(last - 1, i - 1, -1):
                self.rows[k] = self._before(k, self.rows[k + 1])
        return self.rows[i]


def align(a: list, b: list) -> list:
    """The least general wrapper of both: aligned items stay, texts that differ become slots, what one side lacks becomes an
    optional group, and adjacent repetitions become repeated groups."""
    grown = [i[1] for i in a + b if isinstance(i, list) and i[0] == "+"]
    a, b = _grouped(a, grown), _grouped(b, grown)
    x, y = [json.dumps(_bare(i)) for i in a], [json.dumps(_bare(i)) for i in b]
    tx, ty = [_textual(_bare(i)) for i in a], [_textual(_bare(i)) for i in b]
    best = _Scores(x, y, tx, ty)
    out: list = []
    i = j = 0
    left: list = []
    right: list = []

    def flush() -> None:
        out.extend(_optional(left))
        out.extend(_optional(right))
        left.clear()
        right.clear()

    while i < len(x) or j < len(y):
        same = i < len(x) and j < len(y) and (2 if x[i] == y[j] else 1 if tx[i] and ty[j] else 0)
        if same and best[i][j] == best[i + 1][j + 1] + same:
            flush()
            either = [v for v in (a[i], b[j]) if isinstance(v, list) and v[0] == "?"]
            item = _bare(a[i]) if same == 2 else SLOT
            out.extend(_optional([item]) if either else [item])
            i, j = i + 1, j + 1
        elif j >= len(y) or (i < len(x) and best[i + 1][j] >= best[i][j + 1]):
            left.append(a[i])
            i += 1
        else:
            right.append(b[j])
            j += 1
    flush()
    merged: list = []
    for item in out:
        if not (merged and item in (SLOT, ["?", [SLOT]]) and merged[-1] in (SLOT, ["?", [SLOT]])):
            merged.append(item)
        elif item == SLOT:
            merged[-1] = SLOT
    return fold(merged)


def _grouped(items: list, bodies: list[list]) -> list:
    """Write what the other side knows as a repeated group as such a group, though it stands here only once."""
    begin: dict[str, list[list]] = {}
    for g in bodies:
        if g not in (same := begin.setdefault(json.dumps(g[0]), [])):
            same.append(g)
    out, i = [], 0
    while i < len(items):
        body = next((g for g in begin.get(json.dumps(items[i]), ()) if items[i : i + len(g)] == g), None) if begin else None
        out.append(["+", body] if body else items[i])
        i += len(body) if body else 1
    return out


class Wrapper:
    """A wrapper with its automaton. A set of states is one number with a bit for each item, in order, and one for the end.
    Where an item is behind others that may be left out, all of them are one range of bits, so that long wrappers with many
    optional groups need no walk. What follows on a set by an item is remembered. A slot takes one or more texts, also texts that the template has elsewhere."""

    def __init__(self, items: list, pages: int) -> None:
        self.items = items
        self.constants = constants(items)
        self.template = self.constants if pages >= LEAST_PAGES else set()
        self.bits: list[int] = []  # for each state the bit of the item that it takes, -1 for none
        self.free: list[list[int]] = []  # for each state those reached without taking any
        self.behind: list[int] = []  # for each bit the state behind its item
        self.takers: dict[str, int] = {}
        at = self._state()
        self.top = {at: 0}  # the states between the items outside of groups
        starts = [0]
        for n, i in enumerate(items):
            at = self._build([i], at)
            self.top[at] = n + 1
            starts.append(len(self.behind))
        self.end = 1 << len(self.behind)
        self.starts = starts + [len(self.behind) + 1]
        self.reached: dict[int, tuple[int, int, int]] = {}
        self.firsts = self.end  # the items that are taken first in those outside of groups
        self.stops = [len(items)] * (len(items) + 1)  # the first item from here that cannot be left out
        for s, n in reversed(self.top.items()):
            if n < len(items):
                bits, shift, to = self._reach(s)
                self.firsts |= bits << shift
                self.stops[n] = self.stops[n + 1] if to > n else n
        self.start: dict = {"": self._from(0)}  # a set of states under "", and what follows on it by item
        self.nodes: dict[int, dict] = {}
        self.kept = 0

    def _state(self) -> int:
        self.bits.append(-1)
        self.free.append([])
        return len(self.bits) - 1

    def _take(self, at: int, item: str, to: int) -> None:
        self.bits[at] = len(self.behind)
        self.takers[item] = self.takers.get(item, 0) | 1 << len(self.behind)
        self.behind.append(to)

    def _build(self, items: list, at: int) -> int:
        """Add the states of ``items`` from the state ``at``; the state behind them."""
        for i in items:
            end = self._state()
            if i == SLOT:
                inside = self._state()
                self._take(at, i, inside)
                self._take(inside, i, inside)
                self.free[inside].append(end)
            elif isinstance(i, str):
                self._take(at, i, end)
            else:
                begin = self._state()
                self.free[at].append(begin)
                behind = self._build(i[1], begin)
                self.free[behind].append(end)
                if i[0] == "?":
                    self.free[at].append(end)
                else:
                    self.free[behind].append(begin)
            at = end
        return at

    def _reach(self, state: int) -> tuple[int, int, int]:
        """What can be taken from a state before the next item outside of groups: its bits, their shift, and the number of
        that item, -1 if it cannot be reached."""
        to, found, seen, todo = -1, [], {state}, [state]
        while todo:
            s = todo.pop()
            if s != state and s in self.top:
                to = self.top[s]
                continue
            if self.bits[s] >= 0:
                found.append(self.bits[s])
            new = [t for t in self.free[s] if t not in seen]
            seen.update(new)
            todo += new
        shift = min(found, default=0)
        return sum(1 << f - shift for f in found), shift, to

    def _from(self, n: int) -> int:
        """The bits from the item ``n`` outside of groups."""
        low = self.starts[n]
        return (self.firsts >> low & (1 << self.starts[self.stops[n] + 1] - low) - 1) << low

    def _next(self, states: int, item: str) -> int:
        """The states behind an item of a page."""
        states &= self.takers.get(item, 0) | (self.takers.get(SLOT, 0) if item[0] == "=" else 0)
        to, done = 0, -1
        while states:
            bit = (states & -states).bit_length() - 1
            states &= states - 1
            s = self.behind[bit]
            if (n := self.top.get(s, -1)) < 0:
                if s not in self.reached:
                    self.reached[s] = self._reach(s)
                bits, shift, n = self.reached[s]
                to |= bits << shift
            if n > done:  # else it is in the range of one before it
                to |= self._from(n)
                done = self.stops[n]
        return to

    def fits(self, items: list[str]) -> bool:
        node = self.start
        for i in items:
            if i[0] == "=" and i not in self.takers:
                i = SLOT
            if (to := node.get(i)) is None:
                if not (states := self._next(node[""], i)):
                    return False
                to = self.nodes.setdefault(states, {"": states})
                self.kept += len(self.behind) // 8 + 100
                if self.kept > REMEMBERED:
                    for n in (self.start, *self.nodes.values()):
                        known = n[""]
                        n.clear()
                        n[""] = known
                    self.nodes.clear()
                    self.kept = 0
                else:
                    node[i] = to
            node = to
        return bool(node[""] & self.end)


class Inference:
    """The wrapper of one host, extended page by page; only pages that it does not match are aligned. What comes out of an
    alignment matches all that either side matches, so that in the end the wrapper matches every page."""

    def __init__(self) -> None:
        self.wrapper: Wrapper | None = None
        self.pages = 0
        self.seen: set[int] = set()  # hashes of distinct pages, as many as are needed

    def size(self) -> int:
        return len(self.wrapper.behind) if self.wrapper else 0

    def add(self, page: str) -> None:
        items = stream(page)
        self.pages += 1
        if len(self.seen) < LEAST_PAGES:
            self.seen.add(zlib.crc32(page.encode("utf-8", "surrogatepass")))
        if self.wrapper is None:
            self.wrapper = Wrapper(fold(items), 0)
        elif not self.wrapper.fits(items):
            self.wrapper = Wrapper(align(self.wrapper.items, fold(slotted(items, self.wrapper.constants))), 0)


def infer_wrappers(pages: DataFrame, host: Column, page: str) -> DataFrame:
    """(host, wrapper, pages, distinct): one wrapper for each host, as JSON. distinct counts different pages, to LEAST_PAGES.

    Every task infers one wrapper for each of its hosts; those of one host are aligned in three levels of a tree, so that
    one host with all pages is no hot key: what travels is one wrapper for each task and host.
    """

    def infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str | None, Inference] = {}
        held = 0

        def out() -> pa.RecordBatch:
            rows = [(h, json.dumps(i.wrapper.items), i.pages, sorted(i.seen)) for h, i in found.items()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64())))], names=["host", "wrapper", "pages", "seen"])

        for b in batches:
            for h, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if p:
                    made = found.setdefault(h, Inference())
                    held -= made.size()
                    made.add(p)
                    held += made.size()
                if held > HELD and len(found) > 1:  # many hosts: what is known so far goes on to the merge
                    yield out()
                    found.clear()
                    held = 0
        if found:
            yield out()

    def merge(part: pd.DataFrame) -> pd.DataFrame:
        wrapper: list | None = None
        for f in sorted(part["wrapper"], key=lambda f: (len(f), f)):
            items = json.loads(f)
            wrapper = items if wrapper is None else align(wrapper, items)
        seen = sorted({x for xs in part["seen"] for x in xs})[:LEAST_PAGES]
        return pd.DataFrame({"host": part["host"].iloc[:1].tolist(), "wrapper": [json.dumps(wrapper)], "pages": [int(part["pages"].sum())], "seen": [seen], "piece": [int(part["piece"].iloc[0])]})

    schema = "host string, wrapper string, pages long, seen array<long>"
    made = pages.select(host.alias("host"), F.col(page)).where(F.col(page).isNotNull()).mapInArrow(infer, schema).withColumn("piece", F.spark_partition_id().cast("long"))
    for width in (1024, 32, 1):
        made = made.withColumn("piece", F.pmod("piece", F.lit(width))).groupBy("host", "piece").applyInPandas(merge, schema + ", piece long")
    return made.select("host", "wrapper", "pages", F.size("seen").alias("distinct"))


# --- text of the slots

_TIGHT = re.compile(r"[ \t]*\n[ \t\n]*")


def slot_text(page: str | list[tuple[str, str]], template: frozenset[str] | set[str] = frozenset()) -> str:
    """The text of the slots, as it is searched for residue: block tags are line breaks, inline tags nothing; code and the
    texts of the template are left out."""
    out, inside = [], 0
    for tag, text in tokens(page) if isinstance(page, str) else page:
        if tag == "#":
            if not inside and not (template and "=" + text.strip() in template):
                out.append(text)
        else:
            name = tag.lstrip("/")
            if name in _CODE and name not in _VOID:
                inside = max(0, inside + (-1 if tag[0] == "/" else 1))
            if name in _BLOCKS or name in _CODE:
                out.append("\n")
    return "".join(out)


def to_text(page: str | list[tuple[str, str]], template: frozenset[str] | set[str] = frozenset()) -> str:
    """Clean text of the slots: headings as ``# x``, list items as ``- x``, quotations as ``> x``, code in fences, cells with bars, sub- and superscripts kept as formulas."""
    out: list[str] = []
    code = 0
    for tag, text in tokens(page) if isinstance(page, str) else page:
        if tag == "#" and template and "=" + text.strip() in template:
            continue
        if tag == "#":
            out.append(text if code else re.sub(r"\s+", " ", text))
        elif tag in ("pre", "code"):
            code += 1
            if code == 1:
                out.append("\n```\n" if tag == "pre" else "`")
        elif tag in ("/pre", "/code"):
            code = max(0, code - 1)
            if code == 0:
                out.append("\n```\n" if tag == "/pre" else "`")
        elif re.fullmatch("h[1-6]", tag):
            out.append("\n\n" + "#" * int(tag[1]) + " ")
        elif tag == "li":
            out.append("\n- ")
        elif tag == "blockquote":
            out.append("\n> ")
        elif tag in ("td", "th"):
            out.append(" | ")
        elif tag in ("sup", "sub"):
            out.append("^{" if tag == "sup" else "_{")
        elif tag in ("/sup", "/sub"):
            out.append("}")
        elif tag.lstrip("/") in _BLOCKS:
            out.append("\n")
    text = re.sub(r"[ \t]+", " ", "".join(out)) if not code and "```" not in "".join(out) else "".join(out)
    return re.sub(r"\n{3,}", "\n\n", re.sub(r" *\n", "\n", text)).strip()


# --- residue

_ATTR = r"(?:\s+(?:[\w:-]+\s*=\s*(?:\"[^\"<>]*\"|'[^'<>]*'|[^\s\"'<>]+)|nowrap|noshade|compact|checked|disabled|selected|readonly|multiple|async|defer|hidden|controls))*"
_HTML = re.compile(r"</?(?:" + "|".join(_ELEMENTS) + r")" + _ATTR + r"\s*/?>|<(?:a|img|span|div|font|td|table)\s+\w+=[\"'][^<>]*$|<!--|<!DOCTYPE\b|&(?:#\d{2,6}|#[xX][0-9a-fA-F]{2,5}|nbsp|amp|lt|gt|quot|apos|[aouAOU]uml|szlig|[aeiouyAEIOUY](?:acute|grave|circ)|[cC]cedil|[anoANO]tilde|[mn]dash|hellip|euro|[lrb]dquo|[lrs]squo|sbquo|laquo|raquo|copy|reg|trade|shy|deg|sect|middot|bull|para|times|frac12|frac14|sup[123]|thinsp|ensp|emsp|rarr|larr|auml|iexcl|iquest|ordm|pound|yen|cent|aring|oslash|aelig|ccedil|ntilde);", re.I | re.M)
_DUNDER = r"(?:init|name|main|file|doc|dict|class|str|repr|len|call|new|del|all|version|import|enter|exit|iter|next|getattr|setattr|getitem|setitem)"
_MARKDOWN = re.compile(
    r"(?<![\w*\\/])\*\*(?=[^\s*])[^*\n]*?(?<=[^\s*])\*\*(?!\*?\w)|(?<![\w*])\*\*\*(?=[^\s*])[^*\n]+\*\*\*"
    r"|(?<![\w_])__(?!" + _DUNDER + r"__)(?=[^\s_])(?![A-ZÄÖÜ]{3,}__)[^_\n]+(?<=\S)__(?![\w_])"
    r"|(?<!~)~~(?=[^\s~])[^~\n]+(?<=\S)~~(?!~)"
    r"|(?<![`\w])`(?=[^`\s])[^`\n]*`(?![`\w'])|^\s*(?:```|~~~)|```"
    r"|^[ \t]{0,3}#{1,6}[ \t]+\S.*$"
    r"|^[^\S\n]*[^\s=#|>][^\n]*\n[ \t]*={3,}[ \t]*$|^[^\S\n]*[^\W\d_][^\n|]{0,80}\n[ \t]*-{4,}[ \t]*$"
    r"|!?\[[^\[\]\n]*\]\((?:https?://|/|\./|\.\./|#|mailto:|www\.|[\w/.-]+\.\w{2,5}\))[^()\s]*(?:\s+\"[^\"]*\")?\)?"
    r"|(?<![\w\])])\[[^\[\]\n]{2,}\]\[[^\[\]\n]*\]|^\s*\[[^\[\]\n]+\]:\s+(?:https?://|/|www\.)\S+"
    r"|^[ \t]*\|?[ \t]*:?-{3,}:?[ \t]*(?:\|[ \t]*:?-{3,}:?[ \t]*)+\|?[ \t]*$"
    r"|^[ \t]*[-*+][ \t]+\[[ xX]\][ \t]|<https?://[^\s<>]+>|\[\^\w+\]",
    re.M,
)
_WIKI = re.compile(
    r"(?<!['\w])'{2,5}(?=[^'\s])[^'\n]+(?:'[^'\n]+)*'{2,5}(?!')"
    r"|^[ \t]*(={2,6})[ \t]*[^=\n]+?[ \t]*\1[ \t]*$"
    r"|\[\[(?![:]\w+:\]\])[^\s\[\]\-$!(\"][^\[\]\n]*\]\]|\{\{[^\s{}][^{}\n]*(?:\{\{[^{}]*\}\}[^{}\n]*)*\}\}|^\s*\{\||^\s*\|\}|^\s*\|-\s*$"
    r"|#(?:WEITERLEITUNG|REDIRECT|redirect)\b|(?<!\])\[(?:https?:)?//[^\s\[\]]+[ \t]+[^\[\]\n]+\](?!\()"
    r"|</?(?:ref|nowiki|noinclude|includeonly|onlyinclude|gallery|references|math|syntaxhighlight|poem)\b[^<>]*>|(?<!~)~~~~~?(?!~)|(?<![\w_])__[A-ZÄÖÜ]{3,}__(?![\w_])"
    r"|^(?:\*{1,4}|:{1,4}|;)[ \t]*\[\[",
    re.M,
)
_LATEX = re.compile(
    r"\\(?:begin|end)\{|(?<![\w:\\/.])\\(?!x\d|u\d)[a-zA-Z]{2,}\*?(?:\[[^\[\]\n]*\])?\{|(?<=[~\w.,) ])\\(?:cite|ref|footnote|label|eqref|pageref|emph|url|href|index)\w*(?:\[[^\]]*\])?\{"
    r"|(?<![\w:\\/.])\\(?:item|LaTeX|TeX|ldots|dots|cdots|cdot|times|alpha|beta|gamma|delta|epsilon|lambda|mu|pi|sigma|omega|infty|sum|int|prod|frac|sqrt|leq|geq|neq|approx|rightarrow|Rightarrow|to|in|quad|qquad|noindent|newline|newpage|par|bigskip|medskip|smallskip|hline|maketitle|tableofcontents|centering|bf|it|tt|em|sc|ss|S|today)(?![\w\\])"
    r"|\$\$[^$]+?\$\$|(?<![\w$\\])\$(?=[^\s$])(?:[^$\n]*[\\^_={}<>+][^$\n]*|[a-zA-Z])(?<=\S)\$(?![\w$])"
    r"|\\\([^\n]+?\\\)|\\\[[^\n]+?\\\]"
    r"|(?<![\\:])(?:(?<=\w)|(?<=\s)|^)\\[\"'`^~]\{?[aouAOUeEiIcnsyN]\}?(?=\w|\b|[.,;:!? ]|$)|(?<=[a-zA-Z])\\ss(?:\{\}|[ \\]|\b)|(?<=\d)\\[%&]|(?<![`\w])``(?=\w)[^`'\n]+''",
    re.M,
)

_FENCE = re.compile(r"^[ \t]*(```|~~~)[^\n]*\n(.*?)(?:^[ \t]*\1[ \t]*$|\Z)|```[^\n`]*```", re.S | re.M)
_CODE_LINE = re.compile(
    r"^\s*(?:#\s*(?:include|define|ifdef|ifndef|endif|pragma|!/)\b|(?:def|class|import|from|elif|except|lambda|return|yield|async)\b.*[:()]|(?:if|for|while|switch|else|do|try|catch|foreach|elseif)\s*[({].*[;{}]|(?:if|while|for)\s+(?:\[\[?|\(\(|\w+ in ).*(?:;|then|do)"
    r"|(?:int|void|char|float|double|long|bool|static|const|public|private|protected|var|let|function|fn|func|struct|unsigned|std::)\s.*[;{(]|(?:SELECT|INSERT|UPDATE|DELETE|CREATE|ALTER|DROP)\s.*(?:FROM|INTO|SET|TABLE|WHERE|VALUES|;).*|(?:sudo|cd|ls|cp|mv|rm|grep|sed|awk|curl|wget|git|echo|cat|chmod|export|apt|pip|npm|make|ssh)\s.*[-/|>$]"
    r"|[\w.\[\]>*-]+\s*(?:[-+*/|&^%]|<<|>>)?=\s*[\[{(\"'\w].*(?:[;{}\])]|for .* in )\s*$|[\w.:>-]+\(.*\)\s*;\s*$|\w+(?:\[\w*\])+\s*=.*|.*(?:\+\+|--)\s*;\s*$|.*;\s*\}?\s*$|[{}]\s*$|>>> .*|\$ \w+.*|\w+ = lambda\b.*)",
    re.I,
)
_LIKELY = re.compile(r"[*_~`#\[\]{}|\\$<&]|''|==|--")


def _prose(text: str) -> tuple[str, bool]:
    """``text`` without program code: fenced blocks and lines of code go; whether there was a fence."""
    fenced = False
    if "```" in text or "~~~" in text:
        text, n = _FENCE.subn("\n", text)
        fenced = n > 0 or "```" in text
    if "\n" in text and re.search(r"[;{}()=\[]", text):
        text = "\n".join("" if _is_code(line) else line for line in text.split("\n"))
    return text, fenced


def _is_code(line: str) -> bool:
    if not re.search(r"[;{}()=\[<]", line) or not _CODE_LINE.match(line):
        return False
    # markup that happens to hold braces is no code
    return not re.search(r"\\[a-zA-Z]+\{|^\s*\{\||\[\[\w|\{\{|^\s*[|!]|</?[a-z]+[ >]|&\w+;", line) or bool(re.match(r"\s*(?:if|while|for)\b.*\[\[", line))


def residue(text: str, page: bool) -> list[str]:
    """The kinds of markup left over in a text; with ``page`` the text comes from HTML, which then is no residue."""
    text = text.replace("[l]", "")  # the mark of a permalink
    if not _LIKELY.search(text):
        return []
    prose, fenced = _prose(text)
    found = []
    if not page and ("<" in prose or "&" in prose) and _HTML.search(prose):
        found.append("html")
    if fenced or _MARKDOWN.search(prose):
        found.append("markdown")
    if _WIKI.search(prose):
        found.append("wiki")
    if ("\\" in prose or "$" in prose or "``" in prose) and _LATEX.search(prose):
        found.append("latex")
    return found


def clean(text: str) -> str:
    """Plain text without residue; headings, list items, code and formulas keep a plain form."""
    kept: list[str] = []

    def keep(m: re.Match) -> str:
        kept.append(m.group())
        return f"\x00{len(kept) - 1}\x00"

    text = _FENCE.sub(keep, text)
    text = re.sub(r"\$\$[^$]+\$\$|\\\([^\n]+?\\\)|\\\[[^\n]+?\\\]|(?<![\w$\\])\$(?=[^\s$])[^$\n]*[\\^_={}][^$\n]*(?<=\S)\$|\\begin\{(equation|align|math|displaymath)\*?\}.*?\\end\{\1\*?\}", keep, text, flags=re.S)
    text = re.sub(r"`([^`\n]+)`", keep, text)
    text = re.sub(r"^[ \t]*(={2,6})[ \t]*([^=\n]+?)[ \t]*\1[ \t]*$", lambda m: "#" * len(m.group(1)) + " " + m.group(2), text, flags=re.M)
    text = re.sub(r"^([^\s=#|>][^\n]*)\n[ \t]*(?:={3,}|-{4,})[ \t]*$", r"# \1", text, flags=re.M)
    text = re.sub(r"^([ \t]{0,3}#{1,6}[ \t]+\S.*?)[ \t]+#+[ \t]*$", r"\1", text, flags=re.M)
    text = re.sub(r"\\(?:sub)*section\*?\{([^{}]*)\}", r"\n# \1\n", text)
    text = re.sub(r"\\begin\{(?:itemize|enumerate)\}|\\end\{(?:itemize|enumerate)\}", "", text)
    text = re.sub(r"\\item\b[ \t]*", "- ", text)
    text = re.sub(r"^[ \t]*[*+](?=[ \t])", "-", text, flags=re.M)
    text = re.sub(r"!?\[([^\[\]\n]*)\]\([^()\s]*(?:\s+\"[^\"]*\")?\)", r"\1", text)
    text = re.sub(r"^\s*\[[^\[\]\n]+\]:\s+\S+\s*$", "", text, flags=re.M)
    text = re.sub(r"(?<![\w\])])\[([^\[\]\n]{2,})\]\[[^\[\]\n]*\]", r"\1", text)
    text = re.sub(r"\[\[(?:[^\[\]|\n]*\|)*([^\[\]|\n]*)\]\]", r"\1", text)
    text = re.sub(r"\[(?:https?:)?//[^\s\[\]]+[ \t]+([^\[\]\n]+)\]", r"\1", text)
    text = re.sub(r"\{\{[^{}|\n]*\|?([^{}\n]*)\}\}", r"\1", text)
    text = re.sub(r"#(?:WEITERLEITUNG|REDIRECT)\b", "", text)
    text = re.sub(r"^\s*(?:\{\|.*|\|\}|\|-)\s*$", "", text, flags=re.M)
    text = re.sub(r"^[ \t]*\|?[ \t]*:?-{3,}:?[ \t]*(?:\|[ \t]*:?-{3,}:?[ \t]*)+\|?[ \t]*$", "", text, flags=re.M)
    text = re.sub(r"(?<![\w*])\*{2,3}(?=[^\s*])([^*\n]+)\*{2,3}", r"\1", text)
    text = re.sub(r"(?<![\w_])__(?=[^\s_])([^_\n]+)__(?![\w_])", r"\1", text)
    text = re.sub(r"~~(?=[^\s~])([^~\n]+)~~", r"\1", text)
    text = re.sub(r"(?<!['\w])'{2,5}(?=[^'\s])([^'\n]+)'{2,5}(?!')", r"\1", text)
    text = re.sub(r"\\\"\{?([aouAOU])\}?", lambda m: {"a": "ä", "o": "ö", "u": "ü", "A": "Ä", "O": "Ö", "U": "Ü"}[m.group(1)], text)
    text = re.sub(r"\\ss(?:\{\}|\b)", "ß", text)
    text = re.sub(r"\\href\{[^{}]*\}\{([^{}]*)\}", r"\1", text)
    text = re.sub(r"~?\\(?:cite|ref|label|eqref|pageref)\w*(?:\[[^\]]*\])?\{[^{}]*\}", "", text)
    for _ in range(3):
        text = re.sub(r"(?<![:\w\\])\\[a-zA-Z]+\*?(?:\[[^\[\]\n]*\])?\{([^{}]*)\}", r"\1", text)
    text = _HTML.sub(lambda m: html.unescape(m.group()) if m.group()[0] == "&" else ("\n" if (n := _NAME.match(m.group())) and n.group(2).lower() in _BLOCKS else ""), re.sub(r"<!--.*?-->", "", text, flags=re.S))
    return re.sub(r"\x00(\d+)\x00", lambda m: kept[int(m.group(1))], text)


def _run(batches: Iterator[pa.RecordBatch], use: str) -> Iterator[pa.RecordBatch]:
    wrappers: dict[tuple[str, int], Wrapper] = {}
    held = 0
    ahead: tuple[str | None, str | None, int | None] = (None, None, None)  # the last wrapper that came as a row of its own

    def fitting(parsed: list[tuple[str, str]] | None, wrapper: str | None, distinct: int | None) -> tuple[bool | None, set[str]]:
        """Whether the page fits the wrapper of its host, and the texts of the template, none if it does not."""
        nonlocal held
        if not parsed or not wrapper:
            return None, set()
        if (w := wrappers.get((wrapper, distinct))) is None:
            if held > 2 * HELD:
                wrappers.clear()
                held = 0
            w = wrappers[wrapper, distinct] = Wrapper(json.loads(wrapper), distinct)
            held += len(w.behind)
        fits = w.fits(stream(parsed))
        return fits, w.template if fits else set()

    for b in batches:
        keys, fields, kinds, wrapped = [], [], [], []
        texts = []
        for i, (plain, page, wrapper, distinct, of, leads) in enumerate(zip(*(b.column(c).to_pylist() for c in range(1, 7)))):
            if leads:
                ahead = (of, wrapper, distinct)
                continue
            if of is not None and of == ahead[0]:
                _, wrapper, distinct = ahead
            parsed = tokens(page) if page else None
            fits, template = fitting(parsed, wrapper, distinct)
            if use == "text":
                keys.append(i)
                texts.append(clean(to_text(parsed, template)) if page else clean(plain) if plain else None)
                wrapped.append(fits)
                continue
            for field, text in (("content", plain), ("contenthtml", slot_text(parsed, template) if parsed else None)):
                if text:
                    for kind in residue(text, field != "content"):
                        keys.append(i)
                        fields.append(field)
                        kinds.append(kind)
                        wrapped.append(fits)
        if use == "text":
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(keys, pa.int64())), pa.array(texts, pa.string()), pa.array(wrapped, pa.bool_())], names=["k", "clean_text", "fits_wrapper"])
        elif keys:
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(keys)), pa.array(fields, pa.string()), pa.array(kinds, pa.string()), pa.array(wrapped, pa.bool_())], names=["k", "field_name", "markup", "fits_wrapper"])


def _with_wrappers(rows: DataFrame, key: str, plain: str, page: str, host: Column, most: int = 10_000) -> DataFrame:
    """(k, plain, page, wrapper, distinct, of, leads): the rows with the wrapper of their host, or, where hosts are many or a
    wrapper is too long to stand beside every page, sorted behind a row that leads with the wrapper of the host ``of``."""
    base = rows.select(F.col(key).alias("k"), F.col(plain).alias("plain"), F.col(page).alias("page"), host.alias("host"))
    wrappers = infer_wrappers(base, F.col("host"), "page").select("host", "wrapper", "distinct")
    wrappers = cut_lineage(wrappers.where("host is not null"))
    hosts, longest = wrappers.agg(F.count("*"), F.max(F.length("wrapper"))).first()
    if hosts <= most and (longest or 0) <= BESIDE:
        joined = base.join(F.broadcast(wrappers), "host", "left")
        return joined.select("k", "plain", "page", "wrapper", "distinct", F.lit(None).cast("string").alias("of"), F.lit(False).alias("leads"))
    # salted, since one host may hold a third of the rows
    pages = base.select("k", "plain", "page", F.lit(None).cast("string").alias("wrapper"), F.lit(None).cast("int").alias("distinct"), F.col("host").alias("of"), F.lit(False).alias("leads"), F.pmod(F.xxhash64("k"), F.lit(32)).cast("int").alias("_salt"))
    heads = wrappers.select(*(F.lit(None).cast(base.schema[c].dataType).alias(c) for c in ("k", "plain", "page")), "wrapper", "distinct", F.col("host").alias("of"), F.lit(True).alias("leads"), F.explode(F.sequence(F.lit(0), F.lit(31))).alias("_salt"))
    return heads.union(pages).repartition("of", "_salt").sortWithinPartitions("of", "_salt", F.desc("leads")).drop("_salt")


def find_markup(rows: DataFrame, key: str, plain: str, page: str, host: Column) -> DataFrame:
    """(key, field_name, markup, fits_wrapper): one row for each kind of residue in the plain text and in the slots of the
    page. fits_wrapper says whether the page matches its host's wrapper, as all pages do that it was inferred from; null
    without page or host. On a host with fewer than LEAST_PAGES different pages all text is searched.

    Null and empty texts hold no residue; repeated rows are cases of their own. Empty input gives no rows.
    """
    kind = dict(rows.dtypes)[key]
    found = _with_wrappers(rows, key, plain, page, host).mapInArrow(lambda b: _run(b, "residue"), f"k {kind}, field_name string, markup string, fits_wrapper boolean")
    return found.select(F.col("k").alias(key), F.when(F.col("field_name") == "content", plain).otherwise(page).alias("field_name"), "markup", "fits_wrapper")


def clean_pages(rows: DataFrame, key: str, plain: str, page: str, host: Column) -> DataFrame:
    """(key, clean_text, fits_wrapper) of all rows: the text of the page, or of the plain text without a page; null for neither."""
    kind = dict(rows.dtypes)[key]
    return _with_wrappers(rows, key, plain, page, host).mapInArrow(lambda b: _run(b, "text"), f"k {kind}, clean_text string, fits_wrapper boolean").withColumnRenamed("k", key)
