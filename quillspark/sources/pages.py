"""Month pages and JSON inputs."""

from __future__ import annotations

import ssl
import urllib.request
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SOURCE = "title string, description string, author string, published string, site_name string, url string"
POST = f"timestamp string, hexTimestamp string, quoteCount int, wordCount int, sourcesCount int, url string, content string, contentHtml string, externalSources array<struct<{SOURCE.replace(' string', ':string')}>>"
TRAINING_ROW = "topic string, context string, url string, target_comment string, timestamp string, post_url string, post_id string, topic_source string, quality_score double, quality_bucket string"


class _Month(InputPartition):
    def __init__(self, month: str) -> None:
        self.month = month


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.template = options["url"]
        self.months = [m for m in options["months"].split(",") if m]
        self.timeout = float(options.get("timeout", "10"))

    def partitions(self) -> list[InputPartition]:
        return [_Month(m) for m in self.months]

    def read(self, partition: _Month) -> Iterator[tuple]:
        url = self.template + partition.month if "{month}" not in self.template else self.template.replace("{month}", partition.month)
        with urllib.request.urlopen(url, timeout=self.timeout, context=ssl.create_default_context()) as answer:  # certificates stay verified
            yield partition.month, answer.read().decode("utf8")


class MonthPages(DataSource):
    """``spark.read.format("month_pages").option("url", ...).option("months", "202401,202402")``: one task per month."""

    @classmethod
    def name(cls) -> str:
        return "month_pages"

    def schema(self) -> str:
        return "month string, html string"

    def reader(self, schema: object) -> DataSourceReader:
        return _Reader(self.options)


def saved_pages(spark: SparkSession, path: str, suffix: str = r"\.html") -> DataFrame:
    """(month, html) of files named ``YYYYMM`` and ``suffix``."""
    pages = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_path"), rf"(\d{{6}})[^/]*{suffix}$", 1).alias("month"), F.col("value").alias("html"))
    return pages.where("month <> ''")


def posts_json(spark: SparkSession, path: str) -> DataFrame:
    """Posts of a JSON object keyed by post id; post_id and the fields of the post."""
    parsed = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", f"map<string, struct<{_fields(POST)}>>")).alias("post_id", "p"))
    return parsed.select("post_id", "p.*")


def _fields(ddl: str) -> str:
    out, depth, part = [], 0, ""
    for c in ddl + ",":
        depth += (c == "<") - (c == ">")
        if c == "," and depth == 0:
            name, kind = part.strip().split(" ", 1)
            out.append(f"{name}:{kind}")
            part = ""
        else:
            part += c
    return ",".join(out)


def rows_json(spark: SparkSession, path: str, schema: str = TRAINING_ROW) -> DataFrame:
    """Rows of a JSON array."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def prompt_rows(spark: SparkSession, prompts: list[tuple[str, str, str]]) -> DataFrame:
    """Literal prompts (topic, context, url); those without a topic are left out."""
    return spark.createDataFrame(prompts, "topic string, context string, url string").where("topic <> ''")
