"""Problem 2: text that was decoded with a wrong character encoding.

Noisy-channel decoding in two steps. (1) Byte lattices: every character of a value stands for the bytes that it has in an
encoding, also in the other case, as an HTML entity or, for a blank, as the byte it may have replaced; paths that form
UTF-8 sequences of plausible characters are decoded, again and again for text damaged several times. (2) Damage that left
no UTF-8 behind (one single-byte encoding read as another, letters lost for good) is decoded word by word: candidates come
from the pairs of encodings and, with wildcards for lost bytes, from the words of the corpus of the same skeleton. A
Viterbi search over the words of a value, with the encodings as states, weighs candidates by corpus frequency.
"""

from __future__ import annotations

import html
import math
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.runtime import cut_lineage

#: Encodings in which UTF-8 bytes may have been read, commonest first.
MISREAD = ("cp1252", "latin-1", "cp1250", "cp1251", "mac_roman", "cp437", "cp850", "cp1253", "cp1254", "cp1257", "iso8859-2", "iso8859-5", "iso8859-7", "iso8859-15", "cp852", "cp866", "koi8-r", "mac_latin2", "gbk", "shift_jis", "big5")
#: Encodings read in place of Western single-byte text.
CONFUSED = ("cp1251", "mac_roman", "cp437", "cp850", "cp1250", "iso8859-2", "iso8859-5", "cp1253", "iso8859-7", "koi8-r", "cp866", "cp852", "cp1257")
#: Western encodings of such text.
WESTERN = ("cp1252", "cp850", "mac_roman")
#: Costs in nats: a change of the state, and reading a word as clean although it mixes scripts or case.
SWITCH, ODD = 4.0, 9.0

# Characters that decoded text may hold besides ASCII.
_PLAUSIBLE = frozenset(
    [chr(c) for c in range(0x80, 0x180)]  # the control characters stand in text that was damaged twice
    + list("\u0192\u0218\u0219\u021a\u021b\u2010\u2011\u2012\u2013\u2014\u2015\u2018\u2019\u201a\u201b\u201c\u201d\u201e\u201f\u2020\u2021\u2022\u2026\u2030\u2032\u2033\u2039\u203a\u20ac\u2122\u2190\u2191\u2192\u2193\u2212\u2260\u2264\u2265\u02c6\u02dc\ufeff\u200b\u00ad\ufb01\ufb02")
    + [chr(c) for c in range(0x391, 0x3CA)]
    + [chr(c) for c in range(0x410, 0x450)]
)
_RARE_PLAUSIBLE = frozenset(chr(c) for c in range(0x370, 0x530))

#: Values without any such character are clean: everything else is looked at. The lower-case letters are those of the six languages.
SUSPICIOUS = (
    "[^\\x00-\\x7f\\u00e4\\u00f6\\u00fc\\u00df\\u00c4\\u00d6\\u00dc\\u00e9\\u00e8\\u00ea\\u00eb\\u00e0\\u00e1\\u00ee\\u00ef\\u00ed\\u00f4\\u00f3\\u00f9\\u00fb\\u00fa\\u00f1\\u00e7\\u00c9\\u00c0\\u00c8\\u2013\\u2014\\u2019\\u201c\\u201d\\u201e\\u20ac\\u2026]"
    "|[\\p{Ll}][\\u00c0-\\u00de]|(?<![\\p{L}])[\\u00c0\\u00c8\\u00c9](?![\\p{L}])|&(?:#[0-9]{2,4}|#x[0-9a-fA-F]{2,4}|[A-Z]?[a-z]{2,6}[0-9]{0,2});|[\\p{L}]\\?[\\p{Ll}]|[\\p{L}][\\u201c\\u201d\\u2013\\u2026\\u20ac][\\p{L}]"
)
#: Words of the corpus that hold a character outside ASCII.
FOREIGN_WORD = "[\\p{L}\\p{M}]*[^\\x00-\\x7f\\P{L}][\\p{L}\\p{M}]*"


def _table(encoding: str) -> dict[str, int]:
    """Character to byte; bytes that the encoding leaves open pass as control characters."""
    out = {}
    for b in range(0x80, 0x100):
        try:
            c = bytes([b]).decode(encoding)
        except UnicodeDecodeError:
            c = chr(b)
        if len(c) == 1:
            out.setdefault(c, b)
    if encoding == "cp1252":
        for b in range(0x80, 0xA0):
            out.setdefault(chr(b), b)
    return out


class Lattice:
    """The byte readings of characters in one encoding and the UTF-8 sequences among them."""

    def __init__(self, encoding: str) -> None:
        exact = _table(encoding)
        self.bytes: dict[str, tuple[int, ...]] = {}
        for c, b in exact.items():
            for form in {c, c.lower(), c.upper()}:
                if len(form) == 1 and ord(form) > 127:
                    have = self.bytes.get(form, ())
                    if b not in have:
                        self.bytes[form] = (b, *have) if form == c else (*have, b)
        self.exact = exact
        leads2 = [c for c, bs in self.bytes.items() if any(0xC2 <= b <= 0xDF for b in bs)]
        leads3 = [c for c, bs in self.bytes.items() if any(0xE0 <= b <= 0xEF for b in bs)]
        tails = [c for c, bs in self.bytes.items() if any(0x80 <= b <= 0xBF for b in bs)]
        cls = lambda cs: "[" + "".join(re.escape(c) for c in cs) + "]"
        self.pattern = re.compile(f"{cls(leads3)}{cls(tails)}{cls(tails)}|{cls(leads2)}{cls([*tails, ' '])}") if leads2 and leads3 and tails else None

    def decode(self, text: str) -> tuple[str, int] | None:
        """``text`` with all UTF-8 sequences decoded and the number of characters they took, or None without any."""
        if not self.pattern:
            return None
        used = 0

        def one(m: re.Match) -> str:
            nonlocal used
            s = m.group()
            c = self._char(s)
            if c is None:
                return s
            used += sum(1 for x in s if ord(x) > 127)
            return c

        out = self.pattern.sub(one, text)
        return (out, used) if used else None

    @lru_cache(maxsize=20_000)  # noqa: B019
    def _char(self, s: str) -> str | None:
        lead = [b for b in self.bytes.get(s[0], ()) if (0xC2 <= b <= 0xDF if len(s) == 2 else 0xE0 <= b <= 0xEF)]
        if len(s) == 2 and s[1] == " ":  # a no-break space that became a blank: only behind the exact lead byte of a-grave
            return "\u00e0 " if self.exact.get(s[0]) == 0xC3 and s[0] not in "\u0413\u0433" else None
        rest = [[b for b in self.bytes.get(c, ()) if 0x80 <= b <= 0xBF] for c in s[1:]]
        paths = [[b] for b in lead]
        for r in rest:
            paths = [[*p, b] for p in paths for b in r]
        for p in paths:
            try:
                c = bytes(p).decode("utf-8")
            except UnicodeDecodeError:
                continue
            if c in _PLAUSIBLE:
                return c
        return None


@lru_cache(maxsize=1)
def lattices() -> list[tuple[str, Lattice]]:
    return [(e, Lattice(e)) for e in MISREAD if e not in ("gbk", "shift_jis", "big5")]


_CJK = re.compile("[\u2e80-\u9fff\uff61-\uff9f]+")
_WORDS = re.compile(r"[^\W\d_]+")
_ENTITY = re.compile(r"&(?:#\d{2,4}|#x[0-9a-fA-F]{2,4}|[A-Za-z]{2,8}\d{0,2});")


def _mixed(a: str, b: str) -> bool:
    """The words of the decoded text mix Latin letters with Cyrillic or Greek ones more than the text did."""

    def count(t: str) -> int:
        return sum(1 for w in _WORDS.findall(t) if any(c not in _RARE_PLAUSIBLE for c in w) and any(c in _RARE_PLAUSIBLE for c in w))

    return count(b) > count(a)


def decode_utf8(text: str) -> tuple[str, str] | None:
    """(restored text, encoding) where the byte lattice of an encoding holds UTF-8 sequences; None otherwise."""
    start = text
    for _ in range(2):
        if _ENTITY.search(text):
            text = html.unescape(text)
    first = None
    for _ in range(4):
        best = None
        for name, lattice in lattices():
            hit = lattice.decode(text)
            if hit is not None and not _mixed(text, hit[0]):
                # the encoding that explains most characters; then the one that leaves fewest rare ones
                score = (-hit[1], sum(1 for c in hit[0] if c in _RARE_PLAUSIBLE or unicodedata.category(c) in ("Cc", "So", "Sm")))
                if best is None or score < best[0]:
                    best = (score, hit[0], name)
        if best is None:
            break
        text, first = best[1], first or best[2]
    if first is None and (m := _CJK.search(text)) and re.search("[A-Za-z]", text):
        for e in ("gbk", "shift_jis", "big5"):
            try:
                out = text.encode(e).decode("utf-8")
            except (UnicodeEncodeError, UnicodeDecodeError):
                continue
            if all(ord(c) < 128 or c in _PLAUSIBLE for c in out):
                return out, e
        return None
    return (text, first) if first and text != start else None


_TOKEN = re.compile(r"[^\s\"'()<>\[\]{}/|,;:!.\-\u2010-\u2015\u201e]+")
_LOST = re.compile("[\ufffd\u00c3\u00e3\u0102\u251c\u221a]|(?<=[^\\W\\d_])\\?(?=[^\\W\\d_])")


def _bare(token: str) -> str:
    return token.strip("?\u2019\u2018\u201c\u201d\u2026")


def odd_tokens(text: str) -> list[str]:
    """The tokens of a value that hold a character which may be damage, in order, without repetition."""
    out = {}
    for m in _TOKEN.finditer(text):
        t = _bare(m.group())
        if t and (any(ord(c) > 127 for c in t) or "?" in t):
            out[t] = None
    return list(out)


def skeleton(word: str) -> str:
    """Lower case with every run of characters outside ASCII as one wildcard."""
    return re.sub("[^\x00-\x7f]+", "?", word.lower())


@lru_cache(maxsize=1)
def _confusions() -> list[tuple[str, dict[int, str]]]:
    out = []
    for read in CONFUSED:
        exact = _table(read)
        for true in WESTERN:
            if true == read:
                continue
            back = {b: c for c, b in _table(true).items()}
            out.append((f"{true}>{read}", {ord(c): back[b] for c, b in exact.items() if b in back and back[b] in _PLAUSIBLE and back[b] != c}))
    return out


def candidates(token: str) -> list[tuple[str, str]]:
    """(channel, candidate) of a token read in a wrong single-byte encoding."""
    seen, out = {token}, []
    for channel, table in _confusions():
        if all(ord(c) < 128 or ord(c) in table or c in "\u2019\u201c\u201d" for c in token):
            c = token.translate(table)
            if c not in seen and any(x.isalpha() and ord(x) > 127 for x in c) and all(a == b or b.isalpha() or b in "\u2019\u201c\u201d\u2013\u20ac\u00bf\u00a1" for a, b in zip(token, c)):
                seen.add(c)
                out.append((channel, c))
    return out


def _script(c: str) -> str:
    o = ord(c)
    return "c" if 0x400 <= o < 0x530 else "g" if 0x370 <= o < 0x400 else "l"


def oddness(token: str) -> float:
    """What the clean reading of a token costs: it mixes scripts, has signs inside, or capitals behind small letters."""
    letters = [c for c in token if c.isalpha()]
    if len({_script(c) for c in letters}) > 1:
        return 2 * ODD
    if letters and any(ord(c) > 127 and not c.isalnum() and unicodedata.category(c)[0] != "M" and c not in "\u2019\u2018\u201c\u201d\u2026\u20ac%" for c in token):
        return ODD
    if any(a.islower() and b.isupper() and ord(b) > 127 for a, b in zip(token, token[1:])):
        return ODD
    if any(c in "\ufb01\ufb02\u207f\u2320\u2321" for c in token):
        return ODD / 2
    if "\u00c3" in token or "\u00e3" in token:
        return ODD / 2
    return 0.0


def words_of(candidate: str) -> list[str]:
    """The lower-case words of a candidate that hold a letter outside ASCII."""
    return [w.lower() for w in _WORDS.findall(unicodedata.normalize("NFC", candidate)) if any(ord(c) > 127 for c in w)]


def viterbi(tokens: list[tuple[str, float, list[tuple[str, str, float]]]]) -> list[str | None]:
    """The best reading of each token, None for clean. tokens: (token, log frequency, [(channel, candidate, log frequency)])."""
    best: dict[str, tuple[float, list]] = {"clean": (0.0, [])}
    for token, own, options in tokens:
        new: dict[str, tuple[float, list]] = {}
        if not any(c.isalpha() for c in token):
            options = []
        for channel, text, gain in [("clean", None, own - oddness(token)), *options]:
            arrive = max(((s - (0 if state in (channel, "clean") and channel != "clean" and state == channel else SWITCH if channel != "clean" else 0), p) for state, (s, p) in best.items()), key=lambda x: x[0])
            score = arrive[0] + gain
            if channel not in new or score > new[channel][0]:
                new[channel] = (score, [*arrive[1], text])
        best = new
    return max(best.values(), key=lambda x: x[0])[1]


#: Values whose words are left out of the corpus frequencies, since they plainly hold misread bytes.
_DAMAGED = "[\\x80-\\x9f\\ufffd]|[\u00c3\u00e3\u00c2\u00e2\u0102\u0103\u0412\u0432\u0413\u0433\u251c\u221a\u0393\u201a][^\\x00-\\x7f\\p{L}]|&#[0-9]+;"


def word_counts(values: Column, table: DataFrame) -> DataFrame:
    """(word, n) of all corpus words that hold a letter outside ASCII."""
    return table.select(F.explode(F.regexp_extract_all(values, F.lit("(" + FOREIGN_WORD + ")"), F.lit(1))).alias("w")).groupBy(F.lower("w").alias("word")).agg(F.count(F.lit(1)).alias("n"))


def find_damage(table: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, field_name, value, restored, channel) of all damaged values.

    restored is the most probable original; U+FFFD stays where no word of the corpus fits. channel names the encoding in
    which the bytes were read, ``true>read`` for single-byte mix-ups, or ``lost``. Null and empty values are clean;
    repeated rows are cases of their own; a null key is returned as null. Empty input gives no rows.
    """
    kind = dict(table.dtypes)[key]
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).cast("string").alias("value")) for f in fields]))
    values = table.select(F.col(key).alias("k"), pairs.alias("v")).select("k", "v.field_name", "v.value").where("value <> ''")
    suspects = values.where(F.col("value").rlike(SUSPICIOUS))

    def structural(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[list] = [[], [], [], [], [], []]
            for i, v in enumerate(b.column(2).to_pylist()):
                hit = decode_utf8(v)
                text = hit[0] if hit else v
                tokens = odd_tokens(text)
                if hit or tokens or "\ufffd" in v:
                    for column, x in zip(rows, (i, v, text, hit[1] if hit else "lost" if "\ufffd" in v else None, tokens)):
                        column.append(x)
            if rows[0]:
                take = pa.array(rows[0])
                yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), pa.array(rows[1], pa.string()), pa.array(rows[2], pa.string()), pa.array(rows[3], pa.string()), pa.array(rows[4], pa.list_(pa.string()))], names=["k", "field_name", "value", "text", "channel", "tokens"])

    read = suspects.mapInArrow(structural, f"k {kind}, field_name string, value string, text string, channel string, tokens array<string>")
    read = cut_lineage(read.withColumn("_row", F.monotonically_increasing_id()))

    # candidates of the distinct odd tokens, with the corpus frequency of their words
    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for t in b.column(0).to_pylist():
                own = words_of(t)
                if own:
                    out.append((t, "clean", None, own[0], None))
                for channel, c in candidates(t):
                    ws = words_of(c)
                    if ws:
                        out.append((t, channel, c, max(ws, key=len), None))
                if _LOST.search(t):
                    out.append((t, "lost", None, None, skeleton(_LOST.sub("\ufffd", t))))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.string()) for i in range(5)], names=["token", "channel", "candidate", "word", "skeleton"])

    tokens = read.select(F.explode("tokens").alias("token")).distinct()
    proposals = cut_lineage(tokens.mapInArrow(propose, "token string, channel string, candidate string, word string, skeleton string"))
    counts = word_counts(F.col("value"), values.where(~F.col("value").rlike(_DAMAGED)))
    wanted_words = proposals.where("word is not null").select("word").distinct()
    wanted_skeletons = proposals.where("skeleton is not null").select("skeleton").distinct()
    keyed = counts.withColumn("skeleton", F.regexp_replace("word", "[^\\x00-\\x7f]+", "?"))
    known = cut_lineage(keyed.join(wanted_words.withColumn("a", F.lit(True)), "word", "left").join(wanted_skeletons.withColumn("b", F.lit(True)), "skeleton", "left").where("a or b"))
    by_word = proposals.where("word is not null").join(known.select("word", "n"), "word", "left").select("token", "channel", "candidate", F.coalesce("n", F.lit(0)).alias("n"))
    # of each skeleton the commonest word is enough: it is the best path through the wildcard
    fits = known.where("b").where(F.col("word").rlike("^[a-z\\u00df-\\u00f6\\u00f8-\\u00ff\\u0153]+$") & ~F.col("word").rlike("[\\u00e3]")).groupBy("skeleton").agg(F.max_by("word", F.struct("n", "word")).alias("candidate"), F.max("n").alias("n"))
    by_skeleton = proposals.where("skeleton is not null").drop("candidate").join(fits, "skeleton").select("token", "channel", "candidate", "n")
    options = by_word.unionByName(by_skeleton).groupBy("token").agg(F.collect_list(F.struct("channel", "candidate", "n")).alias("options"))
    # the tokens of a value may be hot: both sides are salted
    salt = 8
    spread = options.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    asked = read.select("_row", F.posexplode("tokens").alias("pos", "token")).withColumn("_salt", (F.pmod(F.xxhash64("_row"), F.lit(salt))).cast("int"))
    asked = asked.join(spread, ["token", "_salt"]).groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("pos", "token", "options"))).alias("asked"))
    joined = read.join(asked, "_row", "left").select("k", "field_name", "value", "text", "channel", "asked")

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, texts, channels = [], [], []
            for i, (text, channel, asked) in enumerate(zip(*(b.column(c).to_pylist() for c in (3, 4, 5)))):
                path = []
                for a in asked or []:
                    own = max([o["n"] for o in a["options"] if o["channel"] == "clean"], default=0)
                    options = [(o["channel"], o["candidate"], math.log(o["n"] + 0.01)) for o in a["options"] if o["channel"] != "clean" and _admissible(a["token"], o)]
                    path.append((a["token"], math.log(own + 0.01), options))
                chosen = viterbi(path)
                better: dict[str, str] = {}
                states = {next(o[0] for o in options if o[1] == best) for (_, _, options), best in zip(path, chosen) if best}
                for (token, own, options), best in zip(path, chosen):
                    if best is None and not any(c.isalpha() for c in token):  # signs follow the words around them
                        best = next((o[1] for o in options if o[0] in states and o[2] > own), None)
                    if best is not None and best.lower() != token.lower():
                        by = next(o[0] for o in options if o[1] == best)
                        better[token] = _cased(token, best) if by == "lost" else best
                        channel = channel or by
                if better:
                    text = _TOKEN.sub(lambda m: m.group().replace(_bare(m.group()), better.get(_bare(m.group()), _bare(m.group()))) if _bare(m.group()) else m.group(), text)
                if channel:
                    keep.append(i)
                    texts.append(text)
                    channels.append(channel)
            if keep:
                take = pa.array(keep)
                yield pa.RecordBatch.from_arrays([*(b.column(c).take(take) for c in range(3)), pa.array(texts, pa.string()), pa.array(channels, pa.string())], names=["k", "field_name", "value", "restored", "channel"])

    return joined.mapInArrow(settle, f"k {kind}, field_name string, value string, restored string, channel string").withColumnRenamed("k", key)


def _admissible(token: str, option: dict) -> bool:
    """A reading needs a word of the corpus; only a word mixing Latin and Cyrillic letters is decoded without one."""
    if option["n"] > 0:
        return True
    scripts = {_script(c) for c in token if c.isalpha()}
    return "c" in scripts and "l" in scripts and all(_script(c) == "l" for c in option["candidate"] if c.isalpha())


def _cased(token: str, best: str) -> str:
    return best.capitalize() if best.islower() and token[:1].isupper() else best
