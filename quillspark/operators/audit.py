"""Audit of training rows: labels, shares, totals, top topics and examples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions.patterns import AUDIT_LABELS, java
from quillspark.functions.text import normalize_whitespace


def topic_label(topic: Column) -> Column:
    """The first label whose pattern the normalised topic matches."""
    t = normalize_whitespace(topic)
    label = F.when(t == "", "empty")
    for name, ignore_case, pattern in AUDIT_LABELS:
        label = label.when(t.rlike(java(pattern, ignore_case)), name)
    return label.when(F.regexp_count(t, F.lit(r"\|")) >= 2, "metadata-heavy").when(F.regexp_count(t, F.lit(r"\p{Nd}")) >= 6, "digit-heavy").otherwise("ok")


def shares(rows: DataFrame, column: Column, name: str) -> DataFrame:
    """(name, cnt, pct) of a column's values; null is ``unknown``. The total is a one-row aggregate of the counts."""
    counts = rows.groupBy(F.coalesce(column, F.lit("unknown")).alias(name)).agg(F.count(F.lit(1)).alias("cnt"))
    whole = counts.agg(F.sum("cnt")).scalar()
    return counts.withColumn("pct", F.round(100.0 * F.col("cnt") / F.nullif(whole, F.lit(0)), 1))


def totals(rows: DataFrame, topic: Column) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("total"), F.count_if(topic_label(topic) != "ok").alias("suspicious"))


def top_topics(rows: DataFrame, topic: Column, order: str, n: int = 15) -> DataFrame:
    """The commonest topics, ties by first appearance."""
    counts = rows.groupBy(normalize_whitespace(topic).alias("topic")).agg(F.count(F.lit(1)).alias("cnt"), F.min(order).alias("first_at"))
    return counts.orderBy(F.desc("cnt"), "first_at").limit(n)


def examples(rows: DataFrame, topic: Column, order: str, n: int = 5) -> DataFrame:
    """The first ``n`` rows of each label but ok, in the order of ``order``."""
    labelled = rows.withColumn("label", topic_label(topic)).where("label <> 'ok'")
    ranked = labelled.withColumn("example_no", F.row_number().over(Window.partitionBy("label").orderBy(order)))
    return ranked.where(F.col("example_no") <= n)
