"""Prompts and chat messages as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark.functions.text import normalize_whitespace

# The wording of the prompt.
INSTRUCTION = "Write a short German blog comment in a dry, ironic, satirical tone."
SYSTEM = "You write short German blog comments in German with dry irony and satire."


def prompt_text(topic: Column, context: Column, url: Column) -> Column:
    t, c, u = (normalize_whitespace(x) for x in (topic, context, url))
    lines = [F.lit("### Instruction"), F.lit(INSTRUCTION), F.lit(""), F.lit("### Input"), F.concat(F.lit("Topic: "), t)]
    lines += [F.when(c != "", F.concat(F.lit("Context: "), c)), F.when(u != "", F.concat(F.lit("URL: "), u)), F.lit(""), F.lit("### Response")]
    return F.array_join(F.array_compact(F.array(*lines)), "\n")


def messages(topic: Column, context: Column, url: Column, target: Column | None, topic_final: Column | None = None, context_final: Column | None = None) -> Column:
    """array<struct<role, content>>; the edited topic and context count where they are not empty."""
    prefer = lambda a, b: b if a is None else F.coalesce(F.nullif(a, F.lit("")), b)
    said = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    turns = [said("system", F.lit(SYSTEM)), said("user", prompt_text(prefer(topic_final, topic), prefer(context_final, context), url))]
    if target is not None:
        turns.append(said("assistant", normalize_whitespace(target)))
    return F.array(*turns)


def chat_text(turns: Column, begin: str = "<|{role}|>\n", end: str = "\n", generate: bool = False) -> Column:
    """The turns as one text; ``begin`` and ``end`` stand for a tokenizer's template."""
    head, tail = begin.split("{role}")
    body = F.array_join(F.transform(turns, lambda m: F.concat(F.lit(head), m["role"], F.lit(tail), m["content"], F.lit(end))), "")
    return F.concat(body, F.lit(head + "assistant" + tail)) if generate else body
