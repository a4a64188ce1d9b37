"""Problem 9: keyword-stuffed and link-list pages.

The pairs of neighbouring words of the whole corpus are counted by a hash aggregation; pairs and words that occur once are
left out, since they say nothing about another text. Each unit (sentence or line) of a document gets, from the counts of all
other documents, the mean pointwise mutual information of its neighbours and the mean gain in information over the same
words in reverse order, in which the frequencies of the single words cancel. Word salad is incoherent: its words stand
together by chance or in any order, while prose of any language has an order. Excessively repeated collocations are pairs
that a document holds far more often than the corpus. Links are not words and are counted apart. A document is spam when
more than half of its characters are in such units.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.runtime import cut_lineage

#: Occurrences from which words and pairs are kept.
LEAST_COUNT = 2
#: Bound of the counts that are broadcast, in entries of 12 bytes; beyond it they are joined.
BROADCAST_ENTRIES = 8_000_000
#: Words of the documents that are judged together where the counts are joined.
PIECE_WORDS = 1_000_000
#: Mean gain in nats over the reverse order, and mean information, below which a unit is incoherent.
LEAST_GAIN, LEAST_PMI = 3.0, 0.0
#: A pair is repeated in excess if a document holds it so often, and so many times more often than expected.
LEAST_REPEATS, EXCESS = 3, 10.0
#: Share of a unit without a sentence end covered by such pairs, and of words covered by one word or pair, from which they are stuffed.
MOST_COLLOCATIONS, MOST_REPEATED = 0.4, 0.3

_LINK = re.compile(r"(?:https?:)?//\S+|www\.\S+|\]\([^()\s]*\)|(?<![\w@.-])(?:[a-z0-9à-ÿ][a-z0-9à-ÿ-]*\.)+[a-z]{2,}(?:/\S*)?", re.I)
_DOT = re.compile(r"[a-z0-9à-ÿ]\.[a-z]{2}", re.I)
_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
_STOP = re.compile(r"[.!?…][\"”“»)]*\s+(?=[^\W\d_]|[^\w\s])")
_ENDS, _CLOSERS = frozenset(".!?…"), "\"”“’»)]"
_TAGS = re.compile(r"^\W*(?:tags?|keywords?|stichw(?:ö|oe)rter|schlagw(?:ö|oe)rter|labels?|mots-clés|etiquetas|trefwoorden)\s*:", re.I)
_SEPARATORS, _SPACED = ",;|/•·»>", re.compile(r"\s[-–*]\s|\(\d+\)")

#: From hashes to their counts in the corpus, 0 where they are not kept.
Lookup = Callable[[np.ndarray], np.ndarray]


class _Ids(dict):
    """Stable 64-bit hashes of words, remembered for the words of one task; the memory is emptied when it is large."""

    def __missing__(self, word: str) -> int:
        import xxhash

        h = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h

    def __call__(self, ws: list[str], limit: int = 400_000) -> np.ndarray:
        if len(self) > limit:
            self.clear()
        return np.fromiter(map(self.__getitem__, ws), np.uint64, len(ws))


def _pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a * np.uint64(0xD6E8FEB86659FD93) + (b ^ (b >> np.uint64(31))) * np.uint64(0xA0761D6478BD642F)


def _may_link(text: str) -> bool:
    """Whether ``_LINK`` can match: a cheap test for the texts without links."""
    return "//" in text or "www." in text.lower() or "](" in text or bool(_DOT.search(text))


def _units(text: str) -> Iterator[str]:
    for line in text.split("\n"):
        last = 0
        for m in _STOP.finditer(line):
            yield line[last : m.end()]
            last = m.end()
        yield line[last:]


class _Words:
    """The units of a batch of texts, their words, and which words are neighbours."""

    def __init__(self, texts: list[str], ids: _Ids) -> None:
        self.ws: list[str] = []
        self.units: list[tuple[str, str, int, int]] = []  # text, text without links, size of the links, links
        start, first = [], []
        for text in texts:
            first.append(len(self.units))
            linking = _may_link(text)
            for raw in _units(text):
                if unit := raw.strip():
                    rest, links = _LINK.subn(" ", unit) if linking else (unit, 0)
                    start.append(len(self.ws))
                    self.units.append((unit, rest, len(unit) - len(rest) + links, links))
                    self.ws += _WORD.findall(rest.lower())
        self.first = np.array([*first, len(self.units)], np.int64)
        self.start = np.array([*start, len(self.ws)], np.int64)
        self.h = ids(self.ws)
        self.left = np.ones(max(0, len(self.ws) - 1), bool)  # words with a neighbour behind them in the same unit
        inner = self.start[(self.start > 0) & (self.start < len(self.ws))]
        self.left[inner - 1] = False
        self.at = np.flatnonzero(self.left)

    def forward(self) -> np.ndarray:
        return _pairs(self.h[self.at], self.h[self.at + 1])

    def reverse(self) -> np.ndarray:
        return _pairs(self.h[self.at + 1], self.h[self.at])


def corpus_counts(texts: DataFrame) -> DataFrame:
    """(hash, n) of all words and pairs of neighbours of the column ``t`` that occur at least LEAST_COUNT times.

    Every batch sends each of its words and pairs once, with its count; Spark combines them before and after the shuffle.
    The hash 0 stands for the number of all words.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _Ids()
        for b in batches:
            w = _Words([t for t in b.column(0).to_pylist() if t], ids)
            if len(w.h):
                keys, n = np.unique(np.concatenate([w.h, w.forward()]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.append(keys, np.uint64(0)).view(np.int64)), pa.array(np.append(n, len(w.h)).astype(np.int64))], names=["hash", "n"])

    return texts.select("t").mapInArrow(count, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


class Counts:
    """Sorted hashes and their counts."""

    def __init__(self, hashes: np.ndarray, n: np.ndarray) -> None:
        order = np.argsort(hashes)
        self.hashes, self.n = hashes[order], n[order]

    def __call__(self, h: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.zeros(len(h), np.int64)
        i = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[i] == h, self.n[i], 0).astype(np.int64)


class Scorer:
    """Judges texts by the corpus counts, a batch of texts at a time."""

    def __init__(self, total: int, ids: _Ids | None = None) -> None:
        self.total, self.ids = max(1, total), ids or _Ids()

    def judge(self, texts: list[str], counts: Lookup) -> list[dict]:
        """For each text: the stuffed share of its characters, the commonest kind, its mean information and mean gain."""
        w = _Words(texts, self.ids)
        n_units, at = len(w.units), w.at
        doc_of_unit = np.repeat(np.arange(len(texts)), np.diff(w.first))
        n = np.diff(w.start)
        unit_of_word = np.repeat(np.arange(n_units), n)
        fwd, rev = w.forward(), w.reverse()
        unit = unit_of_word[at]
        doc = doc_of_unit[unit]
        # counts in the document itself: hashes mixed with its number
        mix = doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        keys, back, n_own = np.unique(fwd ^ mix, return_inverse=True, return_counts=True)
        own_f, own_r = n_own[back], Counts(keys, n_own)(rev ^ mix)
        all_f = np.maximum(counts(fwd), own_f)
        other_f, other_r = all_f - own_f, np.maximum(0, counts(rev) - own_r)
        seen = other_f + other_r > 0
        gain = np.where(seen, np.log(0.5 + other_f) - np.log(0.5 + other_r), 0.0)
        single = np.maximum(1, counts(w.h)).astype(float)
        expected = single[at] * single[at + 1] / self.total if len(at) else np.zeros(0)
        told = seen | (expected >= 1)
        pmi = np.where(told, np.log(0.5 + other_f) - np.log(np.maximum(expected, 1e-9)), 0.0)
        words_of_doc = np.bincount(doc_of_unit[unit_of_word], minlength=len(texts)) if n_units else np.zeros(len(texts), np.int64)
        excess = (own_f >= LEAST_REPEATS) & (own_f > EXCESS * words_of_doc[doc] * all_f / self.total)
        covered = np.zeros(len(w.ws) + 1, bool)
        covered[at[excess]] = covered[at[excess] + 1] = True
        per_unit = lambda x, u: np.bincount(u, weights=x, minlength=n_units) if n_units else np.zeros(0)
        n_seen, n_told = per_unit(seen, unit), per_unit(told, unit)
        mean_gain, mean_pmi = per_unit(gain, unit) / np.maximum(1, n_seen), per_unit(pmi, unit) / np.maximum(1, n_told)
        known = (n > 1) & (2 * n_seen >= n - 1)
        coherent = known & (mean_gain >= LEAST_GAIN)
        incoherent = (known & (mean_gain < LEAST_GAIN)) | ((n > 1) & (2 * n_told >= n - 1) & (mean_pmi < LEAST_PMI))
        top_of_unit, top_of_doc = _commonest(w.h, unit_of_word, n_units), _commonest(w.h, doc_of_unit[unit_of_word], len(texts))
        stuffed = per_unit(covered[:-1], unit_of_word) >= MOST_COLLOCATIONS * np.maximum(1, n)
        out = []
        for d in range(len(texts)):
            a, b = int(w.first[d]), int(w.first[d + 1])
            # a pair occurs at most as often as its words
            phrase = repeated(w.ws[w.start[a] : w.start[b]], w.start[a:b] - w.start[a]) if 2 * top_of_doc[d] >= MOST_REPEATED * words_of_doc[d] else ()
            size, bad = 0, Counter()
            for k in range(a, b):
                text, rest, linked, links = w.units[k]
                size += len(text)
                ws = w.ws[w.start[k] : w.start[k + 1]] if phrase else ()
                if kind := _kind(text, rest, linked, links, int(n[k]), int(top_of_unit[k]), bool(coherent[k]), bool(incoherent[k]), bool(stuffed[k]), bool(phrase) and set(phrase) <= set(ws)):
                    bad[kind] += len(text)
            seen_here, told_here = max(1.0, n_seen[a:b].sum()), max(1.0, n_told[a:b].sum())
            out.append(
                {
                    "share": sum(bad.values()) / max(1, size),
                    "kind": max(bad, key=lambda k: (bad[k], k)) if bad else None,
                    "pmi": float((mean_pmi[a:b] * n_told[a:b]).sum() / told_here),
                    "gain": float((mean_gain[a:b] * n_seen[a:b]).sum() / seen_here),
                }
            )
        return out


def _commonest(h: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    """How often the commonest word of each group occurs in it."""
    top = np.zeros(groups, np.int64)
    if len(h):
        _, at, n = np.unique(h ^ group.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), return_index=True, return_counts=True)
        np.maximum.at(top, group[at], n)
    return top


def repeated(ws: list[str], starts: np.ndarray) -> tuple[str, ...]:
    """The word or pair of neighbours that covers most words of a text, if it covers MOST_REPEATED of them, else ()."""
    if not ws:
        return ()
    word, c = max(Counter(ws).items(), key=lambda x: (x[1], x[0]))
    breaks = set(starts.tolist())
    pairs = Counter(p for i, p in enumerate(zip(ws, ws[1:]), 1) if i not in breaks)
    best, m = max(pairs.items(), key=lambda x: (x[1], x[0]), default=((), 0))
    share, phrase = max((c / len(ws), (word,)), (2 * m / len(ws), best))
    return phrase if share >= MOST_REPEATED else ()


def _kind(text: str, rest: str, linked: int, links: int, n: int, top: int, coherent: bool, incoherent: bool, stuffed: bool, phrased: bool) -> str | None:
    """repeated, links or salad if a unit is stuffed; None if it is a sentence, a heading or a name."""
    if phrased or (n >= 12 and top >= MOST_REPEATED * n) or (n >= 3 and stuffed and text.rstrip(_CLOSERS)[-1:] not in _ENDS):
        return "repeated"
    if links and (n < 4 or incoherent or linked > (3 if coherent else 1) * (len(text) - linked)):
        return "links"
    if n >= 3 and (incoherent or _listed(rest, n) or _TAGS.match(text)):
        return "salad"
    if n and "#" in text and text.count("#") >= max(2, n // 2):
        return "salad"
    return None


def _listed(text: str, n: int) -> bool:
    """More than a third as many separators as words: a list rather than a phrase."""
    found = sum(map(text.count, _SEPARATORS))
    if "(" in text or "-" in text or "–" in text or "*" in text:
        found += len(_SPACED.findall(text))
    return found * 3 > n


def _rows(scorer: Scorer, keys: pa.Array, texts: list[str | None], counts: Lookup, most: float) -> pa.RecordBatch | None:
    keep, found = [], []
    for at in range(0, len(texts), 500):
        for i, x in enumerate(scorer.judge([t or "" for t in texts[at : at + 500]], counts), at):
            if x["share"] > most:
                keep.append(i)
                found.append(x)
    if not keep:
        return None
    columns = [keys.take(pa.array(keep)), pa.array([x["kind"] for x in found], pa.string()), *(pa.array([x[c] for x in found], pa.float64()) for c in ("share", "pmi", "gain"))]
    return pa.RecordBatch.from_arrays(columns, names=["k", "kind", "share", "mean_pmi", "mean_gain"])


def find_stuffed(corpus: DataFrame, key: str, text: str, most: float = 0.5, broadcast_entries: int = BROADCAST_ENTRIES) -> DataFrame:
    """(key, kind, share, mean_pmi, mean_gain) of the documents of which more than ``most`` of the characters are stuffed.

    kind is the commonest of links, salad and repeated. The counts are broadcast if they have at most ``broadcast_entries``
    entries; otherwise every piece of the corpus gets those of its own words and pairs by a join, with the same result. Null
    and empty texts are no spam; exact copies and repeated keys are judged each for itself; a null key is returned as null.
    An empty table gives no rows.
    """
    spark = corpus.sparkSession
    docs = corpus.select(F.col(key).alias("k"), F.col(text).alias("t"))
    counted = cut_lineage(corpus_counts(docs))
    entries = counted.count()
    total = counted.where("hash = 0").first()
    total = total.n if total else 0
    schema = f"k {dict(corpus.dtypes)[key]}, kind string, share double, mean_pmi double, mean_gain double"
    if entries <= broadcast_entries:
        table = counted.toPandas()
        shared = spark.sparkContext.broadcast((table["hash"].to_numpy(np.int64).view(np.uint64), np.minimum(table["n"].to_numpy(np.int64), 2**31 - 1).astype(np.int32)))

        def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            scorer, counts = Scorer(total), Counts(*shared.value)
            for b in batches:
                if rows := _rows(scorer, b.column(0), b.column(1).to_pylist(), counts, most):
                    yield rows

        return docs.mapInArrow(judge, schema).withColumnRenamed("k", key)
    return _joined(docs, counted, total, most, schema).withColumnRenamed("k", key)


def _joined(docs: DataFrame, counted: DataFrame, total: int, most: float, schema: str) -> DataFrame:
    """The same for counts of any size. A piece of the corpus asks for each of its words and pairs once."""
    pieces = max(1, total // PIECE_WORDS)
    parted = docs.withColumn("piece", F.pmod(F.xxhash64("k", "t"), F.lit(pieces)))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _Ids()
        for b in batches:
            by_piece: dict[int, list[str]] = {}
            for t, p in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                if t:
                    by_piece.setdefault(p, []).append(t)
            for p, texts in by_piece.items():
                w = _Words(texts, ids)
                asked = np.unique(np.concatenate([w.h, w.forward(), w.reverse()])).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(asked), p, np.int64)), pa.array(asked)], names=["piece", "hash"])

    answers = parted.mapInArrow(ask, "piece long, hash long").distinct().join(counted, "hash")

    def judge(texts: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        counts = Counts(answers["hash"].to_numpy(np.int64).view(np.uint64), answers["n"].to_numpy(np.int64))
        keys = pa.Array.from_pandas(texts["k"])
        rows = _rows(Scorer(total), keys, [t if isinstance(t, str) else None for t in texts["t"]], counts, most)
        return rows.to_pandas() if rows else pd.DataFrame({f.name: pd.Series(dtype="object") for f in T._parse_datatype_string(schema)})

    return parted.groupBy("piece").cogroup(answers.groupBy("piece")).applyInPandas(judge, schema)
