"""Outputs: archived pages, tab-separated counts and posts, nested and line-wise JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def archive_pages(pages: DataFrame, path: str) -> None:
    """The pages as read, one folder per month; only the months of this run are replaced."""
    pages.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path)


def counts_tsv(counts: DataFrame, path: str) -> None:
    """bucket, key and count separated by tabs, without header or quoting."""
    counts.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in counts.columns])).write.mode("overwrite").text(path)


def posts_tsv(posts: DataFrame, path: str) -> None:
    """All columns separated by tabs with a tab at the end; null as ``None``, nested columns as JSON."""
    nested = {n for n, t in posts.dtypes if t.startswith(("array", "struct", "map"))}
    cells = [F.coalesce(F.to_json(c) if c in nested else F.col(c).cast("string"), F.lit("None")) for c in posts.columns]
    posts.select(F.concat(F.concat_ws("\t", *cells), F.lit("\t"))).write.mode("overwrite").text(path)


def json_lines(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def nested_counts(counts: DataFrame, bucket: str, key: str) -> DataFrame:
    """One JSON object ``{key: count}`` per bucket: (bucket, value). A bucket's vocabulary is one cell, as in the original form."""
    return counts.groupBy(bucket).agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, "cnt"))))).alias("value"))


def write_all(posts: DataFrame, words: DataFrame, domains: DataFrame, folder: str) -> None:
    """The six outputs of a run, each replaced as a whole. Counts as JSON are one line per bucket and key; ``nested_counts``
    gives the original form, which needs a bucket's vocabulary in one cell."""
    posts_tsv(posts, f"{folder}/messages.csv")
    counts_tsv(words, f"{folder}/words.csv")
    counts_tsv(domains, f"{folder}/domains.csv")
    json_lines(posts, f"{folder}/messages.json")
    json_lines(words, f"{folder}/words.json")
    json_lines(domains, f"{folder}/domains.json")
