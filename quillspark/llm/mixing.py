"""Problem 8: a mixture of sources with target shares of all tokens.

Efraimidis-Spirakis sampling: every document gets the exponential key -ln(u) / weight with u from a hash of seed and key.
Within a source the documents are sorted by that key and their tokens summed up; a source first repeats all its documents
for the complete epochs of its budget and then takes the documents whose running total fits the rest of it.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.runtime import cut_lineage, ranked_in_groups

#: Where the public tokenizers lie; pass another path where they lie elsewhere.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def with_tokens(docs: DataFrame, key: str, text: str, extra: list[str], tokenizer: str = TOKENIZER) -> DataFrame:
    """(key, extra..., tokens): the length of each text in tokens of the byte-level vocabulary at ``tokenizer``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers
        import tiktoken

        with open(tokenizer, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        for b in batches:
            n = [len(encoding.encode_ordinary(t)) if t else 0 for t in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(n, pa.int64())], names=[*b.schema.names[:-1], "tokens"])

    kinds = dict(docs.dtypes)
    return docs.select(key, *extra, text).mapInArrow(count, ", ".join(f"`{c}` {kinds[c]}" for c in [key, *extra]) + ", tokens long")


def clean_source(source: Column) -> Column:
    return F.lower(F.trim(source))


def text_quality(text: Column) -> Column:
    """The default quality weight, from 0.01 to 1: the share of letters and blanks, times the share of characters in lines
    that end like a sentence (a quarter of the weight is left without any), times the variety of the words, which is their
    number of different ones over the power 0.75 of their number, at most 1. Null counts as 0.01."""
    letters = 1 - F.length(F.regexp_replace(text, "[\\p{L}\\s]", "")) / F.greatest(F.length(text), F.lit(1))
    ended = F.aggregate(F.split(text, "\n+"), F.lit(0), lambda n, line: n + F.when(line.rlike("[.!?\u2026][\"\u201c\u201d\u00bb)\\s]*$"), F.length(line)).otherwise(0))
    words = F.transform(F.array(F.split(F.lower(text), "[^\\p{L}\\p{N}]+")), lambda w: F.size(F.array_distinct(w)) / F.pow(F.greatest(F.size(w), F.lit(1)), F.lit(0.75)))[0]
    return F.greatest(F.lit(0.01), letters * (0.25 + 0.75 * F.least(F.lit(1.0), ended / F.greatest(F.length(text), F.lit(1)))) * F.least(F.lit(1.0), words))


def sampling_key(key: Column, weight: Column, seed: int) -> Column:
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), key), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(u) / weight


def _budgets(sized: DataFrame, targets: DataFrame, total_tokens: int | None) -> DataFrame:
    """One row per target source: tokens at hand, budget, complete epochs, rest."""
    have = sized.where("tokens > 0").groupBy("source").agg(F.sum("tokens").alias("have"))
    t = targets.select(clean_source(F.col("source")).alias("source"), F.col("target_share").cast("double").alias("target_share"), F.greatest(F.col("max_repeats"), F.lit(0)).alias("max_repeats"))
    t = t.where("source is not null and target_share is not null").groupBy("source").agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    t = t.join(have, "source", "left").na.fill(0, ["have"])
    if total_tokens is None:  # the largest mixture in which every source reaches its share
        fits = t.where("target_share > 0").agg(F.min(F.col("max_repeats") * F.col("have") / F.col("target_share"))).first()[0]
        total_tokens = int(fits or 0)
    wanted = F.floor(F.col("target_share") * F.lit(total_tokens) + F.lit(1e-6))
    return t.withColumn("budget", F.least(wanted, F.col("max_repeats") * F.col("have"))).withColumn(
        "epochs", F.when(F.col("have") > 0, F.floor(F.col("budget") / F.col("have"))).otherwise(0)
    ).withColumn("rest", F.col("budget") - F.col("epochs") * F.col("have"))


def mix(docs: DataFrame, key: str, text: str, source: str, targets: DataFrame, total_tokens: int | None = None, seed: int = 42, weight: Column | None = None, tokenizer: str = TOKENIZER) -> tuple[DataFrame, DataFrame]:
    """The chosen documents (key, source, tokens, copies >= 1) and the report by source.

    ``targets`` has source, target_share, max_repeats; source names compare without case and outer blanks. Without
    ``total_tokens`` the mixture is as large as all shares allow within the repeats. The report has one row per target
    source and one row per other source of ``docs`` (target 0): source, target_share, max_repeats, have, chosen_tokens,
    actual_share, most_copies. A source falls short of its budget by less than its next document. Documents with a null
    source, or one that is no target, are never chosen; null and empty texts hold no tokens and are never chosen; a null
    or non-positive weight counts as 0.01; ``weight`` is a column of ``docs``, without it ``text_quality``; repeated keys are separate documents of the same sampling key. A target whose
    source has no documents makes the default size zero; give ``total_tokens`` then.
    """
    w = text_quality(F.col(text)) if weight is None else F.coalesce(F.greatest(weight.cast("double"), F.lit(0.01)), F.lit(0.01))
    named = docs.select(F.col(key).alias("k"), clean_source(F.col(source)).alias("source"), w.alias("weight"), F.col(text).alias("t"))
    sized = cut_lineage(with_tokens(named.withColumn("weight", F.coalesce("weight", F.lit(0.01))), "k", "t", ["source", "weight"], tokenizer))
    budgets = cut_lineage(_budgets(sized, targets, total_tokens))
    keyed = sized.where("tokens > 0").join(budgets.select("source"), "source", "left_semi").withColumn("draw", sampling_key(F.col("k"), F.col("weight"), seed))
    order = [F.col("draw").asc(), F.col("k").asc_nulls_last(), F.col("tokens").asc()]
    summed = ranked_in_groups(keyed.select("k", "source", "tokens", "draw"), ["source"], order, "tokens")
    copies = (F.col("epochs") + (F.col("running_total") <= F.col("rest")).cast("int")).cast("int")
    chosen = summed.join(budgets.select("source", "epochs", "rest"), "source").withColumn("copies", copies).where("copies > 0").select(F.col("k").alias(key), "source", "tokens", "copies")
    got = chosen.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("chosen_tokens"), F.max("copies").alias("most_copies"))
    others = sized.groupBy("source").agg(F.sum("tokens").alias("have")).join(budgets.select("source"), "source", "left_anti")
    report = budgets.select("source", "target_share", "max_repeats", "have").unionByName(others.select("source", F.lit(0.0).alias("target_share"), F.lit(0).alias("max_repeats"), "have"))
    report = report.join(got, "source", "left").na.fill(0, ["chosen_tokens", "most_copies"])
    total = report.agg(F.sum("chosen_tokens").alias("all_tokens"))
    report = report.join(F.broadcast(total)).withColumn("actual_share", F.when(F.col("all_tokens") > 0, F.col("chosen_tokens") / F.col("all_tokens")).otherwise(0.0)).drop("all_tokens")
    return chosen, report.select("source", "target_share", "max_repeats", "have", "chosen_tokens", "actual_share", "most_copies")
