"""Incremental ingestion: each saved page is read once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quillspark.plans.ingest import BASE, aggregate


def ingest_new_pages(spark: SparkSession, folder: str, out: str, checkpoint: str, base: str = BASE, pattern: str = "*.html") -> StreamingQuery:
    """Process the pages in ``folder`` that no run with this checkpoint has seen, then stop; call ``stop()`` to end early.

    Each batch replaces the partitions of its months in posts, words and domains, so a repeated batch changes nothing.
    The grand totals are sums over the months and are taken when they are read (``totals``).
    """
    pages = spark.readStream.format("text").option("wholetext", True).option("pathGlobFilter", pattern).load(folder)
    named = pages.select(F.regexp_extract(F.col("_metadata.file_path"), r"(\d{6})[^/]*$", 1).alias("month"), F.col("value").alias("html")).where("month <> ''")

    def batch(df: DataFrame, _: int) -> None:
        made = aggregate(df, base=base)
        for name, part in (("posts", made["posts"]), ("words", made["words"].where("bucket <> 'sum'")), ("domains", made["domains"].where("bucket <> 'sum'"))):
            by = "month" if name == "posts" else "bucket"
            part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(f"{out}/{name}")
        made["items"].unpersist()

    return named.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def totals(counts: DataFrame, key: str) -> DataFrame:
    """Counts by month with the grand total added."""
    by_month = counts.select(F.col("bucket").cast("string").alias("bucket"), key, "cnt")
    return by_month.unionByName(by_month.groupBy(key).agg(F.sum("cnt").alias("cnt")).select(F.lit("sum").alias("bucket"), key, "cnt"))
