"""Problem 6: document and segment languages.

A language model per language over a fixed public vocabulary of pieces: a word's probability is the sum over all its
segmentations into pieces of the product of the piece probabilities (forward algorithm), so that no single segmentation
has to be right. The piece probabilities are fitted by expectation-maximisation on a bounded sample of labelled texts.
Texts are scored segment by segment; segments vote for one language or for a mixture of whole sentences.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.encoding import decode_utf8

LANGUAGES = ("de", "en", "fr", "es", "it", "nl")
#: Where the fixed vocabulary lies; pass another path where it lies elsewhere.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Bound of the sample: labelled texts for each language, those of the smallest key hashes.
SAMPLE = 500
#: Longest text taken into the sample, in characters. No text is cut.
MOST_CHARACTERS = 5000
#: Rounds of expectation-maximisation, added count of every piece, least words and posterior of a voting segment.
ROUNDS, ADDED, LEAST_WORDS, LEAST_POSTERIOR = 2, 0.05, 4, 0.95
#: The log posteriors are divided by this, since the words of a sentence are far from independent.
TEMPERATURE = 4.0

_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
_BREAK = re.compile(r"(?:(?<=[.!?…])|(?<=[.!?…][\"”“’»)]))\s+|\s*\n+\s*|\s+(?:[|/•·]|--|//|–|—)\s+")
_FOREIGN = re.compile("[^a-zß-öø-ÿœ'’]")
_ODD = re.compile("[^\x00-\x7fäöüßÄÖÜéèêëàâáîïíìôóòùûúñçÉÀÈ¿–—‘’“”„€…]|&#?\\w+;")
#: Quotations that end no sentence, or hold few words: names and slogans, which do not speak the language of the text.
_QUOTED = re.compile(r"[\"„“«][^\"„“”«»\n.!?]{1,60}[\"“”»]")


class PieceModel:
    """Word scores of all languages from piece probabilities; words are remembered up to a limit."""

    def __init__(self, pieces: dict[str, tuple[float, ...]], floor: tuple[float, ...], vocabulary: frozenset[str], limit: int = 200_000) -> None:
        self.pieces, self.floor, self.vocabulary, self.limit = pieces, floor, vocabulary, limit
        self.longest = max((len(p) for p in vocabulary), default=1)
        self.known: dict[str, tuple[float, ...]] = {}

    def forward(self, word: str) -> tuple[float, ...]:
        """Log probability of a word in each language, summed over all segmentations."""
        found = self.known.get(word)
        if found is None:
            if len(self.known) > self.limit:
                self.known.clear()
            found = self.known[word] = tuple(self._forward(word))
        return found

    def _forward(self, word: str) -> list[float]:
        s = "▁" + word
        k, n = len(self.floor), len(s)
        alpha = [[1.0] * k] + [[0.0] * k for _ in range(n)]
        scale = [0.0] * k
        for i in range(n):
            a = alpha[i]
            if not any(a):
                continue
            for j in range(i + 1, min(n, i + self.longest) + 1):
                piece = s[i:j]
                p = self.pieces.get(piece)
                if p is None:
                    if piece in self.vocabulary or j == i + 1:
                        p = self.floor
                    else:
                        continue
                b = alpha[j]
                for x in range(k):
                    b[x] += a[x] * p[x]
            # rescale what follows, so that long words do not underflow
            nxt = alpha[i + 1] if i + 1 <= n else None
            if nxt is not None and i % 8 == 7:
                for x in range(k):
                    top = max(alpha[j][x] for j in range(i + 1, min(n, i + self.longest) + 1))
                    if 0 < top < 1e-60:
                        f = 1e60
                        for j in range(i + 1, min(n, i + self.longest) + 1):
                            alpha[j][x] *= f
                        scale[x] -= math.log(f)
        return [math.log(max(alpha[n][x], 1e-300)) + scale[x] for x in range(k)]

    def posterior(self, words: list[str]) -> list[float]:
        total = [0.0] * len(self.floor)
        for w in words:
            for x, v in enumerate(self.forward(w)):
                total[x] += v
        top = max(total)
        e = [math.exp((t - top) / TEMPERATURE) for t in total]
        z = sum(e)
        return [v / z for v in e]


def words(text: str) -> list[str]:
    """Lower-case words without damaged ones: a word with other letters than those of the languages says nothing."""
    return [w for w in _WORD.findall(unicodedata.normalize("NFC", text).lower()) if not _FOREIGN.search(w)]


def fit(samples: dict[str, list[str]], vocabulary: str = VOCABULARY, rounds: int = ROUNDS, added: float = ADDED) -> PieceModel:
    """Piece probabilities of each language from its sample texts, by expectation-maximisation over all segmentations."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
    pieces = frozenset(p for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)) and (p := sp.id_to_piece(i)).lower() == p)
    longest = max(map(len, pieces))
    counts: list[Counter] = []
    for lang in LANGUAGES:
        tally = Counter(w for t in samples.get(lang, []) for w in words(t))
        total: Counter = Counter()
        for w, n in tally.items():
            for p in sp.encode(w, out_type=str):
                total[p] += n
        for _ in range(rounds):
            z = sum(total.values()) + added * len(pieces)
            prob = {p: (c + added) / z for p, c in total.items()}
            least = added / z
            new: Counter = Counter()
            for w, n in tally.items():
                for p, share in _expected(w, prob, least, pieces, longest).items():
                    new[p] += n * share
            total = new
        counts.append(total)
    sums = [sum(c.values()) + added * len(pieces) for c in counts]
    every = set().union(*counts)
    table = {p: tuple((c[p] + added) / z for c, z in zip(counts, sums)) for p in every}
    return PieceModel(table, tuple(added / z for z in sums), pieces)


def _expected(word: str, prob: dict[str, float], least: float, pieces: frozenset[str], longest: int) -> dict[str, float]:
    """Expected piece counts of a word under all its segmentations (forward and backward sums).

    Sums that become small are raised by powers of two, which rounds nothing; ``up`` and ``down`` hold the powers.
    """
    s = "▁" + word
    n = len(s)
    arcs = []
    for i in range(n):
        for j in range(i + 1, min(n, i + longest) + 1):
            p = s[i:j]
            if p in pieces or j == i + 1:
                arcs.append((i, j, p, prob.get(p, least)))
    fwd, bwd, up, down = [0.0] * (n + 1), [0.0] * (n + 1), [0] * (n + 1), [0] * (n + 1)
    fwd[0] = bwd[n] = 1.0
    at = 0
    for i, j, _, q in arcs:
        if i > at:
            at, up[i] = i, up[i - 1]
            if fwd[i] < 2.0**-300:
                fwd[i : i + longest] = [f * 2.0**300 for f in fwd[i : i + longest]]
                up[i] += 300
        fwd[j] += fwd[i] * q
    up[n] = up[n - 1]
    at = n
    for i, j, _, q in reversed(arcs):
        if i < at:
            if bwd[at] < 2.0**-300:
                bwd[at] *= 2.0**300
                down[at] += 300
            at, down[i] = i, down[at]
        bwd[i] += math.ldexp(q * bwd[j], down[i] - down[j])
    out: dict[str, float] = {}
    for i, j, p, q in arcs:
        x = math.ldexp(fwd[i] * q * bwd[j] / fwd[n], up[n] - up[i] - down[j])
        if x > 1e-6:
            out[p] = out.get(p, 0.0) + x
    return out


def sample_texts(labelled: DataFrame, key: str, text: str, lang: str, size: int = SAMPLE) -> dict[str, list[str]]:
    """At most ``size`` texts of at most MOST_CHARACTERS for each language, those of the smallest hash of the key; what is
    read here is bounded."""
    rows = labelled.select(F.col(key).alias("k"), F.lower(F.substring(F.trim(lang), 1, 2)).alias("l"), F.col(text).alias("t")).where(F.col("l").isin(*LANGUAGES) & (F.length("t") <= MOST_CHARACTERS))
    order = Window.partitionBy("l").orderBy(F.xxhash64("k"), "k")  # a group limit: each task passes on at most ``size`` keys
    chosen = rows.select("k", "l").withColumn("n", F.row_number().over(order)).where(F.col("n") <= size).select("k", "l")
    found = rows.join(F.broadcast(chosen), ["k", "l"], "left_semi").select("l", "t").collect()
    out: dict[str, list[str]] = {one: [] for one in LANGUAGES}
    for r in sorted(found):
        out[r.l].append(r.t)
    return {one: texts[:size] for one, texts in out.items()}


def segments(text: str) -> list[str]:
    return [s for s in (x.strip() for x in _BREAK.split(text)) if s]


def judge(text: str, model: PieceModel) -> tuple[str | None, float, list[tuple[str, str, float]]]:
    """(language or None, confidence, [(segment, language, confidence)]); ``mixed`` as the language of mixed texts.

    Neighbouring segments that are too short or too uncertain to vote take the language of the whole text.
    """
    if _ODD.search(text):
        hit = decode_utf8(text)
        text = hit[0] if hit else text
    text = _QUOTED.sub(" ", text)
    parts: list[tuple[str, list[str]]] = [(s, words(s)) for s in segments(text)]
    everything = [w for _, ws in parts for w in ws]
    if not everything:
        return None, 0.0, []
    whole = model.posterior(everything)
    top = max(range(len(whole)), key=whole.__getitem__)
    judged, voters = [], set()
    for s, ws in parts:
        post = model.posterior(ws) if ws else whole
        i = max(range(len(post)), key=post.__getitem__)
        sure = len(ws) >= LEAST_WORDS and post[i] >= LEAST_POSTERIOR
        if sure:
            voters.add(LANGUAGES[i])
        judged.append((s, LANGUAGES[i] if sure else LANGUAGES[top], post[i] if sure else whole[top]))
    if len(voters) > 1:
        return "mixed", min(c for _, _, c in judged), judged
    return LANGUAGES[top], whole[top], judged


# Three-letter codes and names of the six languages.
_CODES = {
    "deu": "de", "ger": "de", "german": "de", "deutsch": "de", "eng": "en", "english": "en", "englisch": "en", "fra": "fr", "fre": "fr", "french": "fr", "francais": "fr", "français": "fr",
    "französisch": "fr", "spa": "es", "spanish": "es", "español": "es", "spanisch": "es", "ita": "it", "italian": "it", "italiano": "it", "italienisch": "it", "nld": "nl", "dut": "nl", "dutch": "nl",
    "nederlands": "nl", "niederländisch": "nl",
}
# The two-letter codes of languages, and some three-letter codes of others; any other label names none.
_LANGUAGES = (
    "aa ab ae af ak am an ar as av ay az ba be bg bh bi bm bn bo br bs ca ce ch co cr cs cu cv cy da de dv dz ee el en eo es et eu fa ff fi fj fo fr fy ga gd gl gn gu gv ha he hi ho hr ht hu hy hz ia id ie ig ii ik io is it iu ja jv ka kg ki kj kk kl "
    "km kn ko kr ks ku kv kw ky la lb lg li ln lo lt lu lv mg mh mi mk ml mn mr ms mt my nb nd ne ng nl nn no nr nv ny oc oj om or os pa pi pl ps pt qu rm rn ro ru rw sa sc sd se sg si sk sl sm sn so sq sr ss st su sv sw ta te tg th ti tk tl tn to tr ts "
    "tt tw ty ug uk ur uz ve vi vo wa wo xh yi yo za zh zu"
).split() + "por rus pol tur ara zho jpn swe dan ces ukr lat".split()


def label_language(label: Column) -> Column:
    """The two-letter language of a label in any notation; null where it names none."""
    first = F.regexp_extract(F.lower(F.trim(label)), "^([^-_;,. @]*)", 1)
    known = F.create_map(*[F.lit(x) for kv in _CODES.items() for x in kv])
    code = F.coalesce(F.try_element_at(known, first), first)
    return F.when(code.isin(*_LANGUAGES), code)


def detect(texts: DataFrame, model: PieceModel) -> DataFrame:
    """``texts`` has name, id, text, label. Adds ``language`` ('mixed' for mixtures), ``confidence`` and ``segments``
    (array of segment, language, confidence). Null and empty texts, and texts without letters of the languages, get null."""
    shared = texts.sparkSession.sparkContext.broadcast((model.pieces, model.floor, model.vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = PieceModel(*shared.value)
        kind = pa.list_(pa.struct([("segment", pa.string()), ("language", pa.string()), ("confidence", pa.float64())]))
        for b in batches:
            langs, confs, segs = [], [], []
            for t in b.column(2).to_pylist():
                lang, conf, parts = judge(t, model) if t else (None, 0.0, [])
                langs.append(lang)
                confs.append(conf)
                segs.append([{"segment": s, "language": x, "confidence": c} for s, x, c in parts])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(3), pa.array(langs, pa.string()), pa.array(confs, pa.float64()), pa.array(segs, kind)], names=["name", "id", "label", "language", "confidence", "segments"])

    kinds = dict(texts.dtypes)
    schema = f"name string, id {kinds['id']}, label string, language string, confidence double, segments array<struct<segment string, language string, confidence double>>"
    return texts.select("name", "id", "text", "label").mapInArrow(run, schema)


def label_issues(detected: DataFrame, silent: Column, silent_language: str) -> DataFrame:
    """(name, id, issue, lang): missing, wrong or mixed labels. ``label`` of ``detected`` is a two-letter code or null.

    Where ``silent`` holds, a text in ``silent_language`` needs no label. Of a mixed text there is one row for each
    language of its segments and no other issue. Texts without a language are no cases.
    """
    found = F.when(F.col("label").isNull(), F.when(~(silent & (F.col("language") == silent_language)), "missing")).when(F.col("label") != F.col("language"), "wrong")
    issue = lambda kind, lang: F.struct(kind.alias("issue"), lang.alias("lang"))
    mixed = F.transform(F.array_distinct(F.col("segments.language")), lambda x: issue(F.lit("mixed"), x))
    rows = detected.where("language is not null").select("name", "id", F.explode(F.when(F.col("language") == "mixed", mixed).otherwise(F.array(issue(found, F.col("language"))))).alias("i"))
    return rows.where("i.issue is not null").select("name", "id", "i.issue", "i.lang")
