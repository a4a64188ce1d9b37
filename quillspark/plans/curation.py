"""From posts and linked pages to judged rows, samples, chat texts and packed sequences."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.language import stopword_language
from quillspark.functions.prompt import chat_text, messages
from quillspark.functions.text import normalize_whitespace
from quillspark.operators.curate import best_source, judged
from quillspark.operators.html import nodes_of, with_topic

# The experiment presets (name, packing, epochs, learning rate, note).
EXPERIMENTS = [
    ("E0", True, 1, 2e-5, "baseline"),
    ("E1", True, 1, 2e-5, "HTML-first + hard-drop, uniform sampling"),
    ("E2", True, 1, 2e-5, "HTML-first + hard-drop + weighted sampling"),
    ("E3", False, 1, 2e-5, "same as E2, packing off"),
]


def curate(posts: DataFrame, detect: Callable[[Column], Column] = stopword_language) -> DataFrame:
    """Judged rows of posts (post_id, post_url, posted_at, content, content_html, sources).

    Short comments are tested before anything is parsed, so that pages of dropped posts reach Python empty.
    """
    comment = normalize_whitespace(F.col("content"))
    page = F.when(F.length(comment) >= 30, F.col("content_html"))
    best = best_source(F.col("sources"))
    url = normalize_whitespace(F.try_element_at("sources", F.lit(1))["url"])
    rows = posts.select("post_id", "post_url", "posted_at", comment.alias("target_comment"), url.alias("url"), best.alias("best"), nodes_of(page).alias("nodes"))
    rows = with_topic(rows, "nodes", F.col("best")["title"], F.col("best")["description"]).drop("nodes", "best")
    return judged(rows, detect)


def training_text(rows: DataFrame) -> DataFrame:
    """One column ``text``, the chat of each row; all other columns go."""
    return rows.select(chat_text(messages(F.col("topic"), F.col("context"), F.col("url"), F.col("target_comment"))).alias("text"))


def experiment_config(spark, name: str | None = None, packing: bool | None = None, epochs: int | None = None, lr: float | None = None) -> DataFrame:  # noqa: ANN001
    """The preset with what the caller overrides; without a preset the defaults."""
    presets = spark.createDataFrame(EXPERIMENTS, "name string, packing boolean, epochs int, lr double, note string")
    base = presets.where(F.col("name") == name) if name else spark.createDataFrame([(None, True, 1, 2e-5, None)], presets.schema)
    over = lambda v, c: F.coalesce(F.lit(v), F.col(c)) if v is not None else F.col(c)
    return base.select("name", over(packing, "packing").alias("packing"), over(epochs, "epochs").alias("epochs"), over(lr, "lr").alias("lr"), "note")


def pack(rows: DataFrame, key: str, text: str, most: int = 512, packing: bool = True) -> DataFrame:
    """(pack_no, key, tokens): texts cut to ``most`` words and packed greedily in partition order; without packing one text each.

    A pack never crosses partitions, so packing needs no shuffle; pack numbers are unique by partition.
    """

    def greedy(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        no, used = TaskContext.get().partitionId() << 33, 0
        for p in parts:
            packs = []
            for n in p["tokens"]:
                if used and (not packing or used + n > most):
                    no, used = no + 1, 0
                used += n
                packs.append(no)
            yield pd.DataFrame({"pack_no": packs, key: p[key], "tokens": p["tokens"]})

    sized = rows.select(key, F.least(F.lit(most), F.size(F.filter(F.split(F.trim(text), r"\s+"), lambda w: w != ""))).cast("bigint").alias("tokens"))
    return sized.mapInPandas(greedy, f"pack_no long, {key} {dict(rows.dtypes)[key]}, tokens long")


def generate(prompts: DataFrame, predict: Callable[[list[str]], list[str | None]] | None = None, models: tuple[str, ...] = ("default",)) -> DataFrame:
    """Batch inference hook: (model, prompt, generated, error). ``predict`` takes and gives lists; without one the result is
    null. A batch that fails gives null and the fault for its rows and leaves the others alone.
    """
    each = prompts.withColumn("model", F.explode(F.array(*[F.lit(m) for m in models])))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            fault = None
            try:
                out = predict(p["prompt"].tolist()) if predict else [None] * len(p)
            except Exception as e:
                out, fault = [None] * len(p), f"{type(e).__name__}: {e}"
            yield pd.DataFrame({"model": p["model"], "prompt": p["prompt"], "generated": pd.Series(out, dtype=object), "error": pd.Series([fault] * len(p), dtype=object)})

    return each.select("model", "prompt").mapInPandas(run, "model string, prompt string, generated string, error string")
