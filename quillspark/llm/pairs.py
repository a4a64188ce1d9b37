"""Problem 5: broken prompt and response pairs.

Each response is tested in this order: empty, refusal, copy, truncated, other language. Copies are measured on a suffix
automaton of the prompt: the response is walked through it and the words of its longest matches count as copied.
Refusals come from an Aho-Corasick automaton of word classes over clauses outside quotations. Truncation is a delimiter
stack and the end of the last sentence; the language is a vote of stopwords that belong to one language, and of a model of
word pieces where the stopwords are silent.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.language import LANGUAGES, PieceModel, words

DEFECTS = ("empty", "refusal", "copy", "truncated", "other_language")
#: Share of the response's words that must be found in the prompt for a copy.
COPIED = 0.95

_WORD = re.compile(r"[^\W_]+")
_MARK = re.compile(r"^(?:\s|​|﻿)*(?:\[l\](?:\s|​|﻿)*)+|(?:\s|​|﻿)+$")
_SMILEY = re.compile(r"(?:[:;=8][-'^o]?[()\[\]DPpOo/\\|*3]|\bm\(|\^_?\^|<3|¯\\_\(ツ\)_/¯|\bo_O|\bO_o|\bx[dD]\b|\bXD\b|\\o/)")
_LETTERS = re.compile(r"[^\W\d_]+")
_LONG_WORD = re.compile(r"[^\W\d_]{4}")
_QUOTES = re.compile("[\"„“«»‚]")
_QUOTE = re.compile(r"\"[^\"]*\"|„[^“”\"]*[“”\"]|“[^”]*”|«[^»]*»|»[^«]*«|‚[^‘’]*[‘’](?!\w)")

# Stand-ins for a missing text, as a whole response without signs.
_STAND_INS = frozenset(
    """n a|na|k a|keine angabe|keine angaben|kein text|kein kommentar|kein inhalt|kein inhalt vorhanden|kein kommentar vorhanden|ohne text|ohne inhalt|leer|empty|null|none|nan|nil|undefined|todo|tbd|tba|missing|fehlt|text fehlt|kommentar fehlt
    |noch kein text|platzhalter|placeholder|xxx|xx|deleted|removed|gelöscht|no text|no comment|no content|no answer|no response|sans texte|vide|vacío|sin texto|nessun testo|geen tekst|leeg|unbekannt|unknown|siehe oben|folgt|text folgt|nicht verfügbar|not available|keine antwort|text|kommentar|comment|antwort|response|l""".replace("\n", "")
    .replace("    ", "").split("|")
)

# Fixed values, by class: who speaks, in which mood, what is denied, and the acts that an answer consists of. A star stands
# for any ending of the word.
_SPEAKER = "ich|mir|mich|mein*|wir|uns|unser*|i|i'm|i'd|i've|my|me|we|our|je|j'*|m'*|moi|mes|mon|ma|nous|me|mi|mis|yo|mio|mia|miei|mie|ik|mij|mijn|ons|kunnen we"
_MOOD = """
kann|können|könnte|darf|dürfen|möchte|möchten|will|wollen|werde|werden|muss|müssen|vermag|soll
|can|can't|cannot|could|may|must|will|won't|would|able|unable|feel|comfortable|permitted|allowed|have to|going to
|peux|pouvons|puis|dois|devons|souhaite|veux|vais|mesure|puedo|podemos|debo|debemos|quiero|voy a|posso|possiamo|devo|dobbiamo|voglio|grado
|kan|kunnen|mag|mogen|wil|willen|zal|moet|moeten
"""
#: Moods whose act may follow behind a comma.
_OPEN = "möglich|lage|gestattet|erlaubt|erlauben|bereit|untersagt|außerstande|impossible|possible|posible|condiciones|possibile|mogelijk|staat|informationen vor"
_DENIAL = "nicht|kein*|nichts|weder|untersagt|außerstande|not|no|can't|cannot|won't|don't|unable|never|ne|n'*|pas|impossible|aucun*|non|niet|geen|niets|nessun*|ningún|ninguna"
_ACT = """
helfen|weiterhelfen|behilflich|unterstützen|äußern|kommentieren|beantworten|beantwortet|bearbeiten|bearbeitet|erfüllen|erfüllt|verfassen|schreiben|erstellen|liefern|formulieren|vornehmen|abgeben|nachkommen|stellung nehmen|stellung beziehen|antworten|eingehen|dienen|generieren|erzeugen|beitragen|dazu etwas sagen|dazu nichts sagen|hierzu nichts sagen|mitwirken
|help|assist|write|comment|provide|produce|create|generate|fulfill|fulfil|answer|discuss|engage|take a position|take a stance|make fun|making fun|complete|do that|do this|respond|support|offer an opinion|give an opinion|share an opinion|comply|writing|commenting|answering
|aider|écrire|rédiger|commenter|répondre|fournir|produire|générer|prendre position|traiter|satisfaire|plaisanter|donner suite
|ayudar|ayudarte|ayudarle|escribir|redactar|comentar|responder|proporcionar|generar|opinar|atender|contestar|tomar posición|bromear|hacer bromas
|aiutare|aiutarti|aiutarla|scrivere|redigere|commentare|rispondere|fornire|generare|esprimermi|prendere posizione|scherzare|soddisfare
|helpen|schrijven|reageren|beantwoorden|geven|leveren|opstellen|innemen|maken|voldoen|uitlaten|assisteren
"""
_DECLINE = "ablehnen|verweigern|decline|refuse|refuser|décliner|rechazar|declinar|rifiutare|declinare|weigeren|afwijzen|lehne|verweigere"
#: What is declined, so that refusing in general (a law, an offer) is none.
_TASK = """
aufgabe|anfrage|bitte|auftrag|antwort|beitrag|kommentar|text|thema|wunsch|anliegen|request|task|topic|question|prompt|answer|comment|demande|tâche|question|sujet|requête
|solicitud|petición|tarea|pregunta|tema|richiesta|compito|domanda|argomento|verzoek|vraag|taak|opdracht|onderwerp
"""


def _phrases(text: str) -> list[str]:
    return [p for p in text.replace("\n", "|").split("|") if p]


class Refusals:
    """An automaton over the word classes of a clause: a first person, a mood, a denial and an act of answering.

    Acts are infinitives, or participles with a denial ("wird nicht beantwortet"). Where the mood is an adjective the act
    may stand in the next clause ("es ist mir nicht möglich, ..."). Declining counts with a first person and what is
    declined. Without a first person, or with an act that is not answering, nothing is a refusal. Quotations do not count.
    """

    CLASSES = (_SPEAKER, _MOOD, _OPEN, _DENIAL, _ACT, _DECLINE, _TASK)
    SPEAKER, MOOD, OPEN, DENIAL, ACT, DECLINE, TASK = (1 << i for i in range(7))
    _CLAUSE = re.compile(r"[,;:–—()]|\s-\s|\b(?:aber|denn|but|mais|pero|maar|weil|dass|because)\b")

    def __init__(self) -> None:
        import ahocorasick

        kinds: dict[str, int] = {}
        for i, words in enumerate(self.CLASSES):
            for w in _phrases(words):
                kinds[w] = kinds.get(w, 0) | 1 << i
        self.automaton = ahocorasick.Automaton()
        self.acts: set[str] = set()  # a text without an act or a declining word needs no second look
        for w, kind in kinds.items():
            stem = w.rstrip("*")
            self.automaton.add_word(stem, (kind, len(stem), w != stem))
            if kind & (self.ACT | self.DECLINE):
                self.acts.add(_LETTERS.match(stem).group())
        self.automaton.make_automaton()

    def classes(self, clause: str) -> int:
        found = 0
        for end, (kind, n, open_end) in self.automaton.iter(clause):
            at = end - n + 1
            before, after = clause[at - 1] if at else " ", clause[end + 1] if end + 1 < len(clause) else " "
            if not (before.isalpha() or before == "'") and (open_end or not (after.isalpha() or after == "'")):
                found |= kind
        return found

    def found(self, text: str) -> bool:
        low = text.lower().replace("’", "'")
        if self.acts.isdisjoint(_LETTERS.findall(low)):
            return False
        for sentence in re.split(r"(?<=[.!?])\s+|\n+", _QUOTE.sub(" ", low)):
            carried = 0
            for clause in self._CLAUSE.split(sentence):
                c = self.classes(clause)
                acts = c & self.ACT and not re.search(r"\bmir (?:nicht|kaum) helfen|help (?:but|it|laughing)\b", clause)
                if c & self.SPEAKER and c & self.DENIAL and c & (self.MOOD | self.OPEN) and acts:
                    return True
                if carried and acts:
                    return True
                if c & self.SPEAKER and c & self.DECLINE and (c & self.TASK or acts):
                    return True
                if acts and c & self.SPEAKER and c & self.DENIAL and c & self.TASK and re.search(r"\b(?:wird|werden|wurde)\b", clause):
                    return True
                carried = c & self.SPEAKER and c & self.DENIAL and c & self.OPEN
        return False


class SuffixAutomaton:
    """The suffix automaton of a word sequence."""

    def __init__(self, sequence: list[str]) -> None:
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length = [-1], [0]
        last = 0
        for w in sequence:
            cur = len(self.next)
            self.next.append({})
            self.length.append(self.length[last] + 1)
            self.link.append(0)
            p = last
            while p != -1 and w not in self.next[p]:
                self.next[p][w] = cur
                p = self.link[p]
            if p != -1:
                q = self.next[p][w]
                if self.length[p] + 1 == self.length[q]:
                    self.link[cur] = q
                else:
                    clone = len(self.next)
                    self.next.append(dict(self.next[q]))
                    self.length.append(self.length[p] + 1)
                    self.link.append(self.link[q])
                    while p != -1 and self.next[p].get(w) == q:
                        self.next[p][w] = clone
                        p = self.link[p]
                    self.link[q] = self.link[cur] = clone
            last = cur

    def coverage(self, response: list[str], least: int) -> float:
        """Share of the response's words inside matches of at least ``least`` words."""
        if not response:
            return 0.0
        covered = [False] * len(response)
        state, n = 0, 0
        for i, w in enumerate(response):
            while state and w not in self.next[state]:
                state = self.link[state]
                n = self.length[state]
            if w in self.next[state]:
                state, n = self.next[state][w], n + 1
            if n >= least:
                for k in range(i - n + 1, i + 1):
                    covered[k] = True
        return sum(covered) / len(covered)


_FIELDS = frozenset("topic context thema kontext titel title url quelle input instruction response kommentar comment prompt frage text beschreibung description überschrift".split())
_PREFIX = re.compile(r"^\s*\[Quelle:[^\]]*\]\s*", re.I)


def copied(comment: str, topic: str | None, context: str | None) -> float:
    """The share of the comment's words that only repeat the prompt; field names count as nothing."""
    ws = [w for w in _WORD.findall(comment.casefold()) if w not in _FIELDS]
    if not ws:
        return 0.0
    prompt = _WORD.findall((topic or "").casefold()) + ["\n"] + _WORD.findall((context or "").casefold())
    bag = {w for w in prompt if w not in _FIELDS}
    # no match can cover a word that the prompt lacks, so the automaton is built only where a copy is possible
    if sum(w in bag for w in ws) < COPIED * len(ws):
        return 0.0
    automaton = SuffixAutomaton([w for w in prompt if w not in _FIELDS])
    return automaton.coverage(ws, min(2, len(ws)))


_SINGLE = re.compile(r"(?:(?:danke|dank|thx|thanks|merci)\b[^.!?]{0,60}|\([^()]*\)|\[[^\[\]]*\]|#\w+(?:\s+#\w+)*|[\U0001F300-\U0001FAFF☀-➿️]+|\*[\w ]+\*|</?\w+>|\b(?:ts|tja|hach|ohne worte|no comment|sic)!?)$", re.I)
_URL = re.compile(r"(?:https?://|www\.)\S*$", re.I)
_FULL_URL = re.compile(r"^(?:https?://|www\.)[^\s/]+\.[a-z]{2,}(?::\d+)?/\S{3,}$", re.I)
_PAIRS = {")": "(", "]": "[", "}": "{", "“": "„", "”": "“", "»": "«"}


_LAST_SMILEY = re.compile(r"(?:" + _SMILEY.pattern + r")$")
_DELIMITER = re.compile("[(\\[{„«\"“]")
_CLOSERS = "\"”“’‘»«)]_* \t\r\n"


def _done(text: str) -> bool:
    """A sentence sign, then only closing signs."""
    return text.rstrip(_CLOSERS)[-1:] in tuple(".!?…‽")


def truncated(comment: str) -> bool:
    """The comment breaks off: its last sentence has no end, or a bracket, quotation or address stays open."""
    text = comment.strip()
    if _DELIMITER.search(text) and _open(_SMILEY.sub(" ", text)):
        return True
    smiley, rest = False, text
    while m := _ends_with(_LAST_SMILEY, rest.rstrip(" \t\r\n.!")):
        smiley, rest = True, rest[: m].rstrip()
    while rest and not _done(rest) and (m := _SINGLE.search(rest)) is not None:
        smiley, rest = True, rest[: m.start()].rstrip()
    if not rest:
        return False
    last = rest.rsplit(None, 1)[-1]
    u = _URL.search(last)
    if u:  # an address breaks off if its host does, or if it ends without a sign and is no whole address
        address = u.group().rstrip(".!?…,;:\"“”’)]")
        return "." not in address.split("//")[-1].split("/")[0] or (address == u.group() and not _FULL_URL.match(address))
    return not _done(rest) and not smiley


def _ends_with(pattern: re.Pattern, text: str) -> int | None:
    """Where the match at the end of ``text`` begins; None without. No smiley is longer than 12 characters."""
    for at in range(max(0, len(text) - 12), len(text)):
        if pattern.match(text, at) and (at == 0 or not (text[at].isalpha() and text[at - 1].isalnum())):
            return at
    return None


def _open(text: str) -> bool:
    """Whether a bracket or quotation is open at the end of the text."""
    stack: list[str] = []
    for c in text:
        if c in "([{„":
            stack.append(c)
        elif c == "«" and "»" not in stack:
            stack.append(c)
        elif c == '"':
            if '"' in stack:
                while stack.pop() != '"':
                    pass
            elif "„" in stack:
                while stack.pop() != "„":
                    pass
            else:
                stack.append(c)
        elif c in ")]}":
            if _PAIRS[c] in stack:
                while stack.pop() != _PAIRS[c]:
                    pass
        elif c in "“”":
            o = next((x for x in ("„", "“") if x in stack), None)
            if o:
                while stack.pop() != o:
                    pass
            elif c == "“":
                stack.append(c)
        elif c == "»" and "«" in stack:
            while stack.pop() != "«":
                pass
    return bool(stack)


# Stopwords that belong to one of the languages only.
_STOPWORDS = {
    "de": "der das und ist nicht auf für mit dem den ein eine einer eines einem einen von zu zum zur sich hat haben hatte hatten wird werden wurde auch aus bei nach über vom wegen dass weil wenn schon noch nur ich ihr wir sie er mir mal dann aber oder wie wozu jetzt keine kein keiner sei habe doch jemand seit",
    "en": "the of and to is that for it with as be this by from or have not but what all were when we there can an your which their said has about nobody why how again very just too really never always",
    "fr": "le les des et est une du pour dans que qui pas sur au aux avec ce cette ont été par plus mais sont leurs dès depuis selon près encore très rien quelle quel",
    "es": "el los las y una por que para del fue está han más según desde pero como aunque también qué ya había sobre es muy nada siempre",
    "it": "il gli che è per una della dei delle di non sono ha più nel anche stato perché secondo questo dal alla ancora molti molto niente sempre",
    "nl": "het een van en is dat niet voor op zijn met ook er wordt heeft hebben naar maar nog wel was al bij deze volgens waarom meer dan te gewoon heel weer altijd niets",
}
_OWNER: dict[str, list[str]] = {}
for _lang, _list in _STOPWORDS.items():
    for _w in _list.split():
        _OWNER.setdefault(_w, []).append(_lang)


#: Where fewer stopwords than this vote, the word pieces decide, from this posterior of another language, or below this
#: posterior of German if the one vote is for another language.
LEAST_VOTES, LEAST_PIECES, MOST_GERMAN = 2, 0.9, 0.2


def foreign(comment: str, pieces: PieceModel | None = None) -> bool:
    """The stopwords of the writer's own text, outside quotations, vote for another language than German; where hardly any
    stopword stands, the word pieces of ``pieces`` decide, and without it nothing does."""
    own = (_QUOTE.sub(" ", comment) if _QUOTES.search(comment) else comment).lower()
    votes = dict.fromkeys(_STOPWORDS, 0.0)
    for w in _LETTERS.findall(own):
        for lang in (owners := _OWNER.get(w, ())):
            votes[lang] += 1 / len(owners)
    best = max((v, k) for k, v in votes.items() if k != "de")
    if pieces is not None and sum(votes.values()) < LEAST_VOTES:
        ws = words(own)
        if len(ws) < 2:
            return False
        post = dict(zip(LANGUAGES, pieces.posterior(ws)))
        return max(v for k, v in post.items() if k != "de") >= LEAST_PIECES or (best[0] >= 1 and votes["de"] == 0 and post["de"] < MOST_GERMAN)
    return best[0] >= 2 and best[0] > 1.5 * votes["de"]


class Judge:
    def __init__(self, pieces: PieceModel | None = None) -> None:
        self.refusals, self.pieces = Refusals(), pieces

    def defect(self, comment: str | None, topic: str | None, context: str | None) -> str | None:
        if comment is None:
            return "empty"
        text = _MARK.sub("", _MARK.sub("", comment))
        # no smiley holds a word of four letters and no stand-in has five words
        if len(list(islice(_LONG_WORD.finditer(text), 5))) < 5:
            ws = _WORD.findall(_SMILEY.sub(" ", text).lower())
            if not ws or " ".join(ws) in _STAND_INS:
                return "empty"
        if self.refusals.found(text):
            return "refusal"
        if copied(text, topic, _PREFIX.sub("", context) if context else None) >= COPIED:
            return "copy"
        if truncated(text):
            return "truncated"
        if foreign(text, self.pieces):
            return "other_language"
        return None


def find_broken(pairs: DataFrame, key: str, topic: str, context: str, response: str, pieces: PieceModel | None = None) -> DataFrame:
    """(key, defect) of every defective pair, one row per input row. ``pieces``, the model of problem 6, judges the language
    of responses in which hardly a stopword stands.

    Null and blank responses are ``empty``; null or empty topics and contexts copy nothing; repeated rows are cases of
    their own; a null key is returned as null. Empty input gives no rows.
    """

    shared = pairs.sparkSession.sparkContext.broadcast((pieces.pieces, pieces.floor, pieces.vocabulary)) if pieces else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(PieceModel(*shared.value) if shared else None)
        known: dict[tuple, str | None] = {}
        for b in batches:
            keep, found = [], []
            if len(known) > 50_000:
                known.clear()
            for i, row in enumerate(zip(*(b.column(c).to_pylist() for c in (3, 1, 2)))):
                if row not in known:
                    known[row] = judge.defect(*row)
                if known[row]:
                    keep.append(i)
                    found.append(known[row])
            if keep:
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(keep)), pa.array(found, pa.string())], names=["k", "defect"])

    rows = pairs.select(F.col(key).alias("k"), F.col(topic).alias("topic"), F.col(context).alias("context"), F.col(response).alias("response"))
    return rows.mapInArrow(run, f"k {dict(pairs.dtypes)[key]}, defect string").withColumnRenamed("k", key)
