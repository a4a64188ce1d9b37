"""De-duplication, weighted and stratified sampling, ranked reports. Randomness is a hash of seed and key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions.language import is_non_german


def first_of(rows: DataFrame, key: list[Column], order: list[Column]) -> DataFrame:
    """The first row of each key in a total order. The group limit leaves one row per key and task before the exchange, so
    no key is a hot window."""
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return rows.withColumn("_place", place).where("_place = 1").drop("_place")


def shuffle_key(key: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def coin(key: Column, seed: int) -> Column:
    """Uniform integer below 2**32 from seed and key."""
    return F.conv(F.substring(shuffle_key(key, seed), 1, 8), 16, 10).cast("bigint")


def weighted_copies(bucket: Column, key: Column, seed: int) -> Column:
    return F.when(bucket == "high", 3).when(bucket == "mid", 1).when((bucket == "low") & (coin(key, seed) < (1 << 31)), 1).otherwise(0)


def weighted_sample(rows: DataFrame, key: str, bucket: str, seed: int = 42, weighted: bool = True) -> DataFrame:
    """High rows three times, middle ones once, low ones with probability a half, others never; ``copy_no`` counts from 1."""
    n = weighted_copies(F.col(bucket), F.col(key), seed) if weighted else F.lit(1)
    return rows.withColumn("_copies", n).where("_copies > 0").withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col("_copies")))).drop("_copies")


def seeded_shuffle(rows: DataFrame, key: str, seed: int = 42) -> DataFrame:
    return rows.withColumn("shuffle_key", shuffle_key(F.col(key), seed)).orderBy("shuffle_key", key)


def quotas(counts: DataFrame, per_bucket: int, min_foreign: int) -> DataFrame:
    """(bucket, foreign_quota, german_quota) from (bucket, foreign, german): buckets in the order high, mid, low; foreign
    rows wanted but missing in one bucket are asked of the next. All is one row of columns, without a loop over data."""
    pick = lambda b, c: F.coalesce(F.sum(F.when(F.col("bucket") == b, F.col(c))), F.lit(0)).alias(f"{c}_{b}")
    row = counts.agg(*[pick(b, c) for b in ("high", "mid", "low") for c in ("foreign", "german")]).withColumn("c", F.lit(0))
    parts = []
    for b in ("high", "mid", "low"):
        f, g, k = F.col(f"foreign_{b}"), F.col(f"german_{b}"), F.lit(per_bucket)
        row = row.withColumn("take", F.least(f, F.greatest(F.lit(0), F.lit(min_foreign) - F.col("c")), F.lit(per_bucket // 2)))
        row = row.withColumn(f"g_{b}", F.least(g, k - F.col("take")))
        row = row.withColumn(f"f_{b}", F.col("take") + F.least(f - F.col("take"), k - F.col("take") - F.col(f"g_{b}"))).withColumn("c", F.col("c") + F.col(f"f_{b}"))
        parts.append(F.struct(F.lit(b).alias("bucket"), F.col(f"f_{b}").cast("bigint").alias("foreign_quota"), F.col(f"g_{b}").cast("bigint").alias("german_quota")))
    return row.select(F.inline(F.array(*parts)))


def stratified(rows: DataFrame, key: str, bucket: str, context: str, seed: int = 42, per_bucket: int = 100, min_foreign: int = 50) -> DataFrame:
    """The evaluation sample: ``per_bucket`` rows of each bucket, at least ``min_foreign`` foreign ones if there are enough."""
    tagged = rows.withColumn("_b", F.coalesce(F.col(bucket), F.lit("mid"))).withColumn("_f", is_non_german(F.col(context))).where(F.col("_b").isin("high", "mid", "low"))
    counts = tagged.groupBy(F.col("_b").alias("bucket")).agg(F.count_if("_f").alias("foreign"), F.count_if(~F.col("_f")).alias("german"))
    rank = F.row_number().over(Window.partitionBy("_b", "_f").orderBy(shuffle_key(F.col(key), seed), key))
    top = tagged.withColumn("_n", rank).where(F.col("_n") <= per_bucket)  # a group limit: each task passes on per_bucket rows at most
    wanted = F.broadcast(quotas(counts, per_bucket, min_foreign).toDF("_qb", "_fq", "_gq"))  # three rows
    chosen = top.join(wanted, F.col("_b") == F.col("_qb")).where(F.col("_n") <= F.when(F.col("_f"), F.col("_fq")).otherwise(F.col("_gq")))
    return chosen.select(*rows.columns)


def with_rubric(rows: DataFrame) -> DataFrame:
    none = F.lit(None).cast("int")
    return rows.withColumns({"rubric_style_fidelity": none, "rubric_topical_relevance": none, "rubric_hallucination_risk": none, "rubric_notes": F.lit("")})
