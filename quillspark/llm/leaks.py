"""Problem 7: held-out evaluation texts inside a training corpus.

The hashes of the n-grams of the normalised evaluation texts form a broadcast set. Each training text is normalised the same way
and its token windows are looked up; a hit is the equality of all n words, not only of hashes. The evaluation set is read
in blocks of a checked number of words, so that what is broadcast stays bounded however large it is.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of evaluation text held in one broadcast block: at about 32 bytes for each, and 100 for each different word, less
#: than 200 MB in a worker.
BLOCK_WORDS = 2_000_000

_COMBINING = re.compile("[\u0300-\u036f]+")
_WORD = re.compile(r"[^\W_]+")
_INVISIBLE = re.compile("[\u00ad\u200b-\u200f\u2060\ufeff]")
_BROKEN = re.compile(r"(?<=[^\W\d_])[-\u2010\u2011][ \t]*\r?\n\s*(?=[^\W\d_])")
_BLOCK_TAG = re.compile(r"</?(?:p|br|li|ul|ol|div|h[1-6]|tr|td|th|table|blockquote|pre|hr|dd|dt|dl|section|article)\b[^<>]*>", re.I)
_TAG = re.compile(r"<(?:/?[a-zA-Z][^<>]*|!--.*?--)>", re.S)
_TARGET = re.compile(r"\]\s?(?:\([^()\s]*(?:\s+\"[^\"]*\")?\)|\[\w*\])")
_WIKI = re.compile(r"\[\[[^\[\]|]*\|([^\[\]]*)\]\]")
_WIKI_URL = re.compile(r"\[https?://\S+\s+([^\[\]]*)\]")
_INWORD = re.compile(r"(?<=[^\W_])(?:\*{1,3}|_{2,3}|'{2,5}|`)(?=[^\W_])")
_TEX = re.compile(r"\\[\"'`^~=.]\s?\{?([a-zA-Z])\}?|\\(?:href|url)\{[^{}]*\}|\\ss\b\{?\}?|\\[a-zA-Z]+\*?(?:\[[^\[\]]*\])?")


def _tex(m: re.Match) -> str:
    return m.group(1) or ("ss" if m.group(0).startswith("\\ss") else "")


def plain(text: str) -> str:
    """``text`` without markup: tags, entities, link targets and commands go, the words inside stay."""
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = _TAG.sub("", _BLOCK_TAG.sub(" ", text))
    if "](" in text or "][" in text or "] [" in text:
        text = _TARGET.sub("]", text)
    if "[[" in text:
        text = _WIKI.sub(r"\1", text)
    if "[http" in text:
        text = _WIKI_URL.sub(r"\1", text)
    if "\\" in text:
        text = _TEX.sub(_tex, text)
    return text


def fold(text: str) -> str:
    """Lower case; umlauts, their two-letter spellings and their bare vowels become one; sharp s likewise."""
    text = text.casefold()
    if not text.isascii():
        text = _COMBINING.sub("", unicodedata.normalize("NFKD", text)).casefold()
    return text.replace("ae", "a").replace("oe", "o").replace("ue", "u").replace("sz", "s").replace("ss", "s")


def words(text: str) -> list[str]:
    return _WORD.findall(fold(text))


def readings(text: str) -> list[tuple[str, ...] | list[str]]:
    """The word lists of a text. Where a line ends in a hyphen it is read as one word and, secondly, as two."""
    text = _INVISIBLE.sub("", text)
    whole = plain(text)
    out = [words(_BROKEN.sub("", whole))]
    if _BROKEN.search(whole):
        out.append(words(whole))
    if whole is not text and whole != text:  # what looks like markup may be text after all
        raw = words(_BROKEN.sub("", text))
        if raw != out[0]:
            out.append(raw)
    if _INWORD.search(whole):
        out.append(words(_BROKEN.sub("", _INWORD.sub("", whole))))
    return out


class Grams:
    """The n-grams of the items of a block: a sorted array of 64-bit hashes with the place of each, and the words to verify
    a hit against. Words are shared, so an n-gram takes about 32 bytes, whatever n is."""

    def __init__(self, items: list[tuple[int, str]], n: int) -> None:
        self.n = n
        self.keys: list[int] = []
        self.words: list[list[str]] = []  # one list for each reading of an item
        shared: dict[str, str] = {}
        hashes, places = [], []
        for key, text in items:
            for ws in readings(text):
                if len(ws) >= n:
                    own = [shared.setdefault(w, w) for w in ws]
                    hashes += [self.hash(own[i : i + n]) for i in range(len(own) - n + 1)]
                    places += [len(self.words) << 32 | i for i in range(len(own) - n + 1)]
                    self.keys.append(key)
                    self.words.append(own)
        order = np.argsort(np.array(hashes, np.uint64), kind="stable")
        self.hashes, self.places = np.array(hashes, np.uint64)[order], np.array(places, np.int64)[order]
        self.vocabulary = frozenset(shared)

    @staticmethod
    def hash(window: list[str]) -> int:
        import xxhash

        return xxhash.xxh3_64_intdigest("\x1f".join(window).encode("utf-8", "surrogatepass"))

    def items(self, window: list[str]) -> set[int]:
        """The items that hold the n words of ``window``."""
        h = np.uint64(self.hash(window))
        i, found = int(np.searchsorted(self.hashes, h)), set()
        while i < len(self.hashes) and self.hashes[i] == h:
            reading, at = divmod(int(self.places[i]), 1 << 32)
            if self.words[reading][at : at + self.n] == window:
                found.add(self.keys[reading])
            i += 1
        return found


def windows_hit(ws: list[str], grams: Grams) -> list[tuple[int, set[int]]]:
    """(start, items) of each window of ``ws`` that is in ``grams``. Every run of n known words covers one position
    n-1 modulo n, so only there does the scan look for known words before it extends the run to both sides."""
    hits = []
    n, vocabulary = grams.n, grams.vocabulary
    done, last = 0, len(ws)
    for p in range(n - 1, last, n):
        if p < done or ws[p] not in vocabulary:
            continue
        a = p
        while a > done and ws[a - 1] in vocabulary:
            a -= 1
        b = p + 1
        while b < last and ws[b] in vocabulary:
            b += 1
        for i in range(a, b - n + 1):
            if k := grams.items(ws[i : i + n]):
                hits.append((i, k))
        done = b
    return hits


def _blocks(items: DataFrame, key: str, text: str, limit: int) -> Iterator[list[tuple[int, str]]]:
    """The evaluation items, in blocks of at most about ``limit`` words (a single item always fits into one block)."""
    rows = items.select(F.col(key).alias("k"), F.col(text).alias("t")).where("k is not null and t is not null")
    total = rows.agg(F.sum(F.length("t") / 4)).first()[0] or 0
    parts = int(total // limit) + 1
    for i in range(parts):
        part = rows if parts == 1 else rows.where(F.pmod(F.xxhash64("k"), F.lit(parts)) == i)
        yield [(r.k, r.t) for r in part.toLocalIterator()]


def find_leaks(corpus: DataFrame, key: str, text: str, items: DataFrame, item_key: str, item_text: str, n: int = 12, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(key, item_key) for each corpus text and each item of which it has at least ``n`` consecutive words.

    Null texts and null keys give no rows; texts or items shorter than n words have no window; repeated corpus rows give
    a row each unless key and item are both equal. Empty tables give an empty result of the same columns.
    """
    spark = corpus.sparkSession
    source = corpus.select(F.col(key).alias("k"), F.col(text).alias("t")).where("k is not null and t is not null")
    kind = dict(corpus.dtypes)[key], dict(items.dtypes)[item_key]
    out: DataFrame | None = None
    for block in _blocks(items, item_key, item_text, block_words):
        shared = spark.sparkContext.broadcast(Grams(block, n))

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            grams = shared.value
            for b in batches:
                ks, vs = [], []
                for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    found: set[int] = set()
                    for ws in readings(t):
                        for _, items_ in windows_hit(ws, grams):
                            found.update(items_)
                    ks += [k] * len(found)
                    vs += sorted(found)
                if ks:
                    yield pa.RecordBatch.from_arrays([pa.array(ks), pa.array(vs)], names=["k", "v"])

        part = source.mapInArrow(scan, f"k {kind[0]}, v {kind[1]}")
        out = part if out is None else out.unionByName(part)
    return out.select(F.col("k").alias(key), F.col("v").alias(item_key)).distinct()


_ENTITY = re.compile(r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)")
_PAIRS = [(re.compile(p), p[0]) for p in ("ae", "oe", "ue", "sz", "ss")]

#: A text derived from another, and for each of its characters the stretch of the other that it stands for.
Traced = tuple[str, list[tuple[int, int]]]


def _replaced(traced: Traced, pattern: re.Pattern, new: Callable[[re.Match], str | int], attach: bool = False) -> Traced:
    """``pattern.sub`` on a traced text. ``new`` gives the new text or the number of the group that stays. With
    ``attach`` what is taken out belongs to the character before it."""
    text, at = traced
    parts, spans, last = [], [], 0
    for m in pattern.finditer(text):
        parts.append(text[last : m.start()])
        spans += at[last : m.start()]
        r = new(m)
        if isinstance(r, int):
            parts.append(m.group(r))
            spans += at[m.start(r) : m.end(r)]
        elif r:
            parts.append(r)
            spans += [(at[m.start()][0], at[m.end() - 1][1])] * len(r)
        elif attach and spans:
            spans[-1] = (spans[-1][0], at[m.end() - 1][1])
        last = m.end()
    return "".join([*parts, text[last:]]), spans + at[last:]


def _traced_plain(t: Traced) -> Traced:
    """``plain`` on a traced text."""
    if "&" in t[0]:
        t = _replaced(t, _ENTITY, lambda m: html.unescape(m.group()))
    if "<" in t[0]:
        t = _replaced(_replaced(t, _BLOCK_TAG, lambda m: " "), _TAG, lambda m: "")
    if "](" in t[0] or "][" in t[0] or "] [" in t[0]:
        t = _replaced(t, _TARGET, lambda m: "]")
    if "[[" in t[0]:
        t = _replaced(t, _WIKI, lambda m: 1)
    if "[http" in t[0]:
        t = _replaced(t, _WIKI_URL, lambda m: 1)
    if "\\" in t[0]:
        t = _replaced(t, _TEX, lambda m: 1 if m.group(1) else _tex(m))
    return t


def _traced_words(t: Traced) -> list[tuple[str, list[tuple[int, int]]]]:
    """``words`` of a traced text, each with the stretches of its letters."""
    letters, spans = [], []
    for c, (a, b) in zip(*t):
        folded = _COMBINING.sub("", unicodedata.normalize("NFKD", c.casefold())).casefold()
        letters.append(folded)
        spans += [(a, b)] * len(folded)
        if not folded and spans:
            spans[-1] = (spans[-1][0], b)
    t = "".join(letters), spans
    for pair, one in _PAIRS:
        t = _replaced(t, pair, lambda m, one=one: one)
    return [(m.group(), t[1][m.start() : m.end()]) for m in _WORD.finditer(t[0])]


def traced_readings(text: str) -> list[list[tuple[str, list[tuple[int, int]]]]]:
    """The word lists of ``readings``, with the place of each letter in ``text``."""
    gone = lambda m: ""
    raw = _replaced((text, [(i, i + 1) for i in range(len(text))]), _INVISIBLE, gone, True)
    whole = _traced_plain(raw)
    joined = lambda t: _replaced(t, _BROKEN, gone, True)
    out = [joined(whole)]
    if _BROKEN.search(whole[0]):
        out.append(whole)
    if whole[0] != raw[0]:
        out.append(joined(raw))
    if _INWORD.search(whole[0]):
        out.append(joined(_replaced(whole, _INWORD, gone)))
    return [_traced_words(t) for t in out]


def leaked(text: str, grams: Grams) -> bool:
    return any(windows_hit(ws, grams) for ws in readings(text))


def remove_spans(text: str, grams: Grams) -> tuple[str | None, int]:
    """``text`` without the words of every window that leaked in any of its readings, and the number of words removed.

    Markup and signs between the words stay. Words that meet where others were cut are looked at again, until nothing
    leaks; null if a leak is left that has no place in the text.
    """
    removed = 0
    while leaked(text, grams):
        cut = bytearray(len(text))
        for ws in traced_readings(text):
            for i, _ in windows_hit([w for w, _ in ws], grams):
                for _, spans in ws[i : i + grams.n]:
                    for a, b in spans:
                        cut[a:b] = b"\1" * (b - a)
        if not any(cut):
            return None, removed
        removed += sum(any(cut[m.start() : m.end()]) for m in _WORD.finditer(text))
        text = "".join(c for c, gone in zip(text, cut) if not gone)
    return text, removed


def clean_leaks(corpus: DataFrame, key: str, text: str, items: DataFrame, item_key: str, item_text: str, n: int = 12, most_removed: float = 0.5, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(key, text, removed_words, action) of all texts: leaked spans are cut out ('trimmed'); where more than
    ``most_removed`` of the words leaked the whole text is ('dropped', null text); others are 'kept' as they are.

    Null texts are 'kept' as null. With several blocks of items, each pass trims what the one before left, and what then
    still leaks, because words met where a later pass cut, is dropped. No text that comes out has a leak.
    """
    out = corpus.select(F.col(key).alias("k"), F.col(text).alias("t"), F.lit(0).cast("long").alias("removed"), F.lit("kept").alias("action"), F.lit(-1).cast("long").alias("whole"))
    spark = corpus.sparkSession
    schema = f"k {dict(corpus.dtypes)[key]}, t string, removed long, action string, whole long"

    def trimmed(out: DataFrame, block: list[tuple[int, str]], last: bool) -> DataFrame:
        shared = spark.sparkContext.broadcast(Grams(block, n))

        def trim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            grams = shared.value
            for b in batches:
                rows = list(zip(*(c.to_pylist() for c in b.columns)))
                new = []
                for k, t, removed, action, whole in rows:
                    if t is not None and leaked(t, grams):
                        whole = len(_WORD.findall(t)) if whole < 0 else whole
                        t, cut = (None, 0) if last else remove_spans(t, grams)
                        removed += cut
                        t, action = (None, "dropped") if t is None or removed > most_removed * whole else (t, "trimmed")
                    new.append((k, t, removed, action, whole))
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in new], b.schema.field(i).type) for i in range(5)], names=b.schema.names)

        return out.mapInArrow(trim, schema)

    blocks = 0
    for block in _blocks(items, item_key, item_text, block_words):
        out, blocks = trimmed(out, block, False), blocks + 1
    if blocks > 1:
        for block in _blocks(items, item_key, item_text, block_words):
            out = trimmed(out, block, True)
    return out.select(F.col("k").alias(key), F.col("t").alias(text), F.col("removed").alias("removed_words"), "action")
