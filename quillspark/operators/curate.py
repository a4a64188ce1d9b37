"""Curation: hard drops, quality score, buckets and the chain from posts to training rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.language import language_sample, stopword_language, with_prefix
from quillspark.functions.patterns import BRAND_HOSTS, GENERIC_PORTAL, MAPS_BOILER, NUMBER_UNIT, QUOTE_SIGNS, SEPARATORS, URL_ISH, java
from quillspark.functions.text import normalize_whitespace, split_words, strip_ws
from quillspark.runtime import computed

LEAST_COMMENT = 30


def drop_reason(topic: Column) -> Column:
    """The first hard rule that a topic breaks; null keeps it."""
    t = strip_ws(topic)
    return (
        F.when(F.length(t) < 18, "too_short")
        .when(t.rlike(java(URL_ISH, True)), "url_ish")
        .when(t.rlike(java(MAPS_BOILER, True)), "maps_boilerplate")
        .when(F.regexp_count(t, F.lit(r"\p{Nd}")) / F.length(t) > 0.18, "digit_heavy")
        .when(F.lower(t).isin(*BRAND_HOSTS) & (F.length(t) < 25), "brand_domain")
    )


def quality_points(topic: Column, context: Column) -> Column:
    """The additive score in hundredths, so that no rounding decides on a bucket."""
    content = lambda ws: F.size(F.filter(ws, lambda w: F.length(w) > 2))
    names = lambda ws: F.size(F.filter(F.slice(ws, 2, F.greatest(F.size(ws), F.lit(1))), lambda w: (F.length(w) > 2) & w.rlike(r"^\p{Lu}")))
    given = lambda test, points: F.when(test, points).otherwise(0)
    worded = lambda n: given(n["content"] >= 4, 15) + given(n["names"] >= 2, 10) - given((F.regexp_count(topic, F.lit(SEPARATORS)) >= 2) & (n["content"] < 4), 25)
    # lambda variables, so that the topic is split once
    counted = F.transform(F.array(split_words(topic)), lambda ws: F.struct(content(ws).alias("content"), names(ws).alias("names")))
    points = (
        F.lit(50)
        + F.transform(counted, worded)[0]
        + given(topic.rlike(QUOTE_SIGNS), 10)
        + given(topic.rlike(NUMBER_UNIT), 10)
        + given(F.length(context) >= 40, 5)
        - given(topic.rlike(java(GENERIC_PORTAL, True)), 35)
        - given(topic.rlike(java(MAPS_BOILER, True)), 40)
    )
    return F.transform(F.array(points), lambda p: F.greatest(F.lit(0), F.least(F.lit(100), p)))[0]


def bucket_of(points: Column) -> Column:
    return F.when(points >= 70, "high").when(points >= 35, "mid").when(points >= 15, "low").otherwise("drop")


def best_source(sources: Column) -> Column:
    """The first source with a title or a description."""
    has = lambda s: (normalize_whitespace(s["title"]) != "") | (normalize_whitespace(s["description"]) != "")
    return F.try_element_at(F.filter(sources, has), F.lit(1))


def judged(rows: DataFrame, detect: Callable[[Column], Column] = stopword_language) -> DataFrame:
    """Rows with comment, topic, context: adds context with language prefix, points, bucket and status.

    status is short_comment, no_topic, a drop reason, quality_drop or kept, in this order; all tests are one projection,
    so that counters and kept rows come from the same pass.
    """
    rows = computed(rows, _lang=detect(language_sample(F.col("topic"), F.col("context"))))
    rows = rows.withColumn("context", with_prefix(F.col("context"), F.col("_lang"))).drop("_lang")
    rows = computed(rows, points=quality_points(F.col("topic"), F.col("context")))
    rows = rows.withColumn("quality_bucket", bucket_of(F.col("points")))
    status = (
        F.when(F.length(F.col("target_comment")) < LEAST_COMMENT, "short_comment")
        .when(F.col("topic") == "", "no_topic")
        .otherwise(F.coalesce(drop_reason(F.col("topic")), F.when(F.col("quality_bucket") == "drop", "quality_drop"), F.lit("kept")))
    )
    return rows.withColumn("status", status)


def training_rows(judged_rows: DataFrame) -> DataFrame:
    kept = judged_rows.where("status = 'kept'")
    return kept.select("topic", "context", "url", "target_comment", "posted_at", "post_url", "post_id", "topic_source", F.round(F.col("points") / 100, 3).alias("quality_score"), "quality_bucket")


def stats(judged_rows: DataFrame) -> DataFrame:
    """(metric, key, cnt): totals by status, and bucket and topic source of the kept rows, in one pass; ordered as a
    report, by metric and falling count."""
    kept = F.col("status") == "kept"
    tagged = judged_rows.select(
        F.explode(
            F.array_compact(
                F.array(
                    F.struct(F.lit("total").alias("metric"), F.lit("").alias("key")),
                    F.struct(F.lit("status").alias("metric"), F.col("status").alias("key")),
                    F.when(kept, F.struct(F.lit("bucket").alias("metric"), F.col("quality_bucket").alias("key"))),
                    F.when(kept, F.struct(F.lit("source").alias("metric"), F.col("topic_source").alias("key"))),
                )
            )
        ).alias("t")
    )
    counts = tagged.groupBy("t.metric", "t.key").agg(F.count(F.lit(1)).alias("cnt"))
    return counts.orderBy("metric", F.desc("cnt"), "key")
