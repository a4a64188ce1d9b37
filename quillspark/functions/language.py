"""The language seam of the curation: any function from a text column to a two-letter code can take this one's place."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark.functions.text import normalize_whitespace

# Stopwords that tell the languages apart.
STOPWORDS = {
    "de": "der die das und ist nicht auf für mit dem den ein eine von zu zum zur sich hat wird auch aus bei nach über wegen",
    "en": "the of and to is that for it with as was by from or have this not are who why how about",
    "fr": "le les des et est une du pour dans que qui pas sur au aux avec été",
    "es": "el los las y una por que para del fue está han contra sobre",
    "it": "il gli che è per una della delle di sono ha contro perché",
    "nl": "het een van en dat niet voor op zijn met ook er heeft over waarom",
}


def stopword_language(text: Column, least: int = 20, default: str = "de") -> Column:
    """The language with most stopwords, ties in the order above; ``default`` for short texts and without any."""
    # lambda variables, so that the text is split once and the best vote is found once
    hits = lambda ws, listed: F.size(F.filter(ws, lambda w: w.isin(*listed)))
    votes = lambda ws: F.array(*[F.struct(hits(ws, s.split()).alias("n"), F.lit(-i).alias("rank"), F.lit(k).alias("lang")) for i, (k, s) in enumerate(STOPWORDS.items())])
    best = F.transform(F.array(F.split(F.lower(normalize_whitespace(text)), r"[^\p{L}]+")), lambda ws: F.array_max(votes(ws)))
    lang = F.transform(best, lambda b: F.when(b["n"] == 0, F.lit(default)).otherwise(F.coalesce(b["lang"], F.lit(default))))
    return F.when(F.length(text) < least, F.lit(default)).otherwise(lang[0])


def with_prefix(context: Column, lang: Column) -> Column:
    """The context behind ``[Quelle: XX]`` unless the language is German."""
    prefix = F.concat(F.lit("[Quelle: "), F.upper(lang), F.lit("]"))
    return F.when(lang != "de", F.concat_ws(" ", prefix, F.nullif(context, F.lit("")))).otherwise(context)


def is_non_german(context: Column) -> Column:
    c = F.coalesce(context, F.lit(""))
    return c.startswith("[Quelle:") & ~c.startswith("[Quelle: DE]")


def language_sample(topic: Column, context: Column) -> Column:
    return F.when(F.length(topic) >= 40, topic).otherwise(F.concat_ws(" ", topic, context))
