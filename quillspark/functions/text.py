"""Scalar text functions as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark.functions.patterns import WS


#: Characters of a counted word at least.
LEAST_WORD = 4


def normalize_whitespace(v: Column) -> Column:
    """Runs of Unicode white space as one blank, none at the ends; null as the empty string."""
    return F.trim(F.regexp_replace(F.coalesce(v, F.lit("")), WS + "+", " "))


def strip_ws(v: Column) -> Column:
    return F.regexp_replace(v, f"^{WS}+|{WS}+$", "")


def strip_marker(v: Column) -> Column:
    """Without the permalink mark; the blank behind it belongs to the mark."""
    return F.replace(v, F.lit("[l] "), F.lit(""))


def open_sentence_gaps(v: Column) -> Column:
    """A blank where a sentence end touches the next word; the digit 1 counts as a sign, as in "!1!1"."""
    return F.regexp_replace(v, "([:.!?1]+)([a-zA-Z1-9]+)", "$1 $2")


def tokens(v: Column) -> Column:
    return F.filter(F.split(F.lower(v), WS + "+"), lambda x: x != "")


def split_words(v: Column) -> Column:
    return F.filter(F.split(v, WS + "+"), lambda x: x != "")


def clean_token(t: Column) -> Column:
    return F.regexp_replace(t, r"[^\p{L}\p{N}]", "")


def is_counted_word(w: Column) -> Column:
    return (F.length(w) >= LEAST_WORD) & ~w.rlike(r"^\p{Nd}")


def token_count(v: Column) -> Column:
    """All tokens of the text without its mark, counted words or not."""
    return F.size(tokens(open_sentence_gaps(strip_marker(v)))).cast("bigint")


def truncate(v: Column, n: int) -> Column:
    return F.substring(v, 1, n)


def first_sentence(v: Column) -> Column:
    return F.split_part(v, F.lit("."), F.lit(1))


def join_context(title: Column, description: Column, most: int = 160) -> Column:
    """``title | first sentence of the description``, without separators at the ends."""
    parts = F.concat(normalize_whitespace(title), F.lit(" | "), truncate(first_sentence(normalize_whitespace(description)), most))
    return F.regexp_replace(parts, "^[ |]+|[ |]+$", "")
