"""Queries of the training-data problems; each runs over its whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    from quillspark.llm.contributors import cap_hosts

    return cap_hosts(_table(spark, d, "fefe_training_data"), "row_id", "url", "quality_score", 50).where("not kept").select("row_id")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    from quillspark.llm.encoding import find_damage

    return find_damage(_table(spark, d, "externalsources"), "source_id", ["title", "description"]).select("source_id", "field_name")


def p2_restored(spark: SparkSession, d: str) -> DataFrame:
    from quillspark.llm.encoding import find_damage

    return find_damage(_table(spark, d, "externalsources"), "source_id", ["title", "description"])


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    from quillspark.llm.markup import find_markup
    from quillspark.llm.residue import site_of

    return find_markup(_table(spark, d, "messages"), "message_id", "content", "contenthtml", site_of(F.col("url"))).select("message_id", "field_name", "markup")


def p3_clean(spark: SparkSession, d: str) -> DataFrame:
    from quillspark.llm.markup import clean_pages
    from quillspark.llm.residue import site_of

    return clean_pages(_table(spark, d, "messages"), "message_id", "content", "contenthtml", site_of(F.col("url")))


def _p4_values(spark: SparkSession, d: str) -> DataFrame:
    from quillspark.llm.residue import values_of

    pages = values_of(_table(spark, d, "externalsources"), "externalsources", "source_id", ["title", "description"], F.col("url"))
    return pages.unionByName(values_of(_table(spark, d, "fefe_training_data"), "fefe_training_data", "row_id", ["topic"], F.col("url")))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    from quillspark.llm.residue import find_residue

    return find_residue(_p4_values(spark, d)).select("table_name", "record_id", "field_name")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    from quillspark.llm.language import fit, sample_texts
    from quillspark.llm.pairs import find_broken

    pieces = fit(sample_texts(_table(spark, d, "documents"), "doc_id", "text", "lang"))
    return find_broken(_table(spark, d, "fefe_training_data"), "row_id", "topic", "context", "target_comment", pieces)


def _p6_detected(spark: SparkSession, d: str) -> DataFrame:
    from quillspark.llm.language import detect, fit, label_language, sample_texts
    from quillspark.llm.residue import residue_rules

    docs = _table(spark, d, "documents").select("doc_id", "text", "lang")
    model = fit(sample_texts(docs, "doc_id", "text", "lang"))
    pages = _table(spark, d, "externalsources").where(F.length(F.trim("description")) > 0).where(~residue_rules(F.col("description")))
    pages = pages.select(F.lit("externalsources").alias("name"), F.col("source_id").alias("id"), F.col("description").alias("text"), label_language(F.col("lang")).alias("label"))
    prefix = "^\\s*\\[Quelle:\\s*([^\\]]*)\\]\\s*"
    rows = _table(spark, d, "fefe_training_data")
    label = label_language(F.nullif(F.regexp_extract("context", prefix, 1), F.lit("")))
    rows = rows.select(F.lit("fefe_training_data").alias("name"), F.col("row_id").alias("id"), F.regexp_replace("context", prefix, "").alias("text"), label.alias("label"))
    return detect(pages.unionByName(rows.where(F.length(F.trim("text")) > 0)), model)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    from quillspark.llm.language import label_issues

    detected = _p6_detected(spark, d).where("language is not null")
    silent = F.col("name") == "fefe_training_data"
    return label_issues(detected, silent, "de").select(F.col("name").alias("table_name"), F.col("id").alias("record_id"), "issue", "lang")


def p6_segments(spark: SparkSession, d: str) -> DataFrame:
    segment = F.posexplode("segments").alias("segment_no", "s")
    return _p6_detected(spark, d).select(F.col("name").alias("table_name"), F.col("id").alias("record_id"), segment).select("table_name", "record_id", "segment_no", "s.segment", "s.language", "s.confidence")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    from quillspark.llm.leaks import find_leaks

    return find_leaks(_table(spark, d, "documents"), "doc_id", "text", _table(spark, d, "benchmark_set"), "item_id", "target_comment", 12)


def p7_clean(spark: SparkSession, d: str) -> DataFrame:
    from quillspark.llm.leaks import clean_leaks

    return clean_leaks(_table(spark, d, "documents"), "doc_id", "text", _table(spark, d, "benchmark_set"), "item_id", "target_comment", 12)


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    from quillspark.llm.mixing import mix

    return mix(_table(spark, d, "documents"), "doc_id", "text", "source", _table(spark, d, "mix_targets"))[0]


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    from quillspark.llm.mixing import mix

    return mix(_table(spark, d, "documents"), "doc_id", "text", "source", _table(spark, d, "mix_targets"))[1]


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    from quillspark.llm.stuffing import find_stuffed

    return find_stuffed(_table(spark, d, "documents"), "doc_id", "text").select("doc_id")


def queries() -> dict[str, Query]:
    named = [p1_found, p2_found, p2_restored, p3_found, p3_clean, p4_found, p5_found, p6_found, p6_segments, p7_found, p7_clean, p8_mix, p8_shares, p9_found]
    return {f.__name__: f for f in named}


def oracle_sql() -> dict[str, str]:
    from quillspark.llm.oracle import P1, P7

    return {"p1_found": P1, "p7_found": P7}
