"""Grouped counts with a grand-total level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.links import domain
from quillspark.functions.text import clean_token, is_counted_word, open_sentence_gaps, strip_marker, tokens


def with_total(items: DataFrame, bucket: str, key: str) -> DataFrame:
    """(bucket, key, cnt) for each bucket and, under ``sum``, over all.

    The total is summed from the counts by bucket, whose exchange is reused, so the items are counted once.
    """
    per = items.groupBy(bucket, key).agg(F.count(F.lit(1)).alias("cnt"))
    whole = per.groupBy(key).agg(F.sum("cnt").alias("cnt")).select(F.lit("sum").alias(bucket), key, "cnt")
    return per.unionByName(whole)


def word_counts(items: DataFrame, bucket: Column, text: str) -> DataFrame:
    """Counts of the words of at least four characters that begin with no digit, from all items, also those that give no post."""
    cleaned = F.transform(tokens(open_sentence_gaps(strip_marker(F.col(text)))), clean_token)  # each token once, before it is tested
    found = items.select(bucket.alias("bucket"), F.explode(F.filter(cleaned, is_counted_word)).alias("word"))
    return with_total(found, "bucket", "word")


def domain_counts(items: DataFrame, bucket: Column, hrefs: Column) -> DataFrame:
    """Counts of the linked domains; ``hrefs`` is the array of link targets behind the permalink. Null targets do not count."""
    found = items.select(bucket.alias("bucket"), F.explode(hrefs).alias("href")).where("href is not null").select("bucket", domain(F.col("href")).alias("domain"))
    return with_total(found, "bucket", "domain")
