import math
import os

import pytest

from pyspark.sql import functions as F

from quillspark.llm.mixing import TOKENIZER, mix, text_quality

pytestmark = pytest.mark.skipif(not os.path.exists(TOKENIZER), reason="no vocabulary")


def tables(spark, docs, targets):
    a = spark.createDataFrame([(*d, "x", 1) for d in docs], "id long, source string, text string, tokens string, weight int")
    return a, spark.createDataFrame(targets, "source string, target_share double, max_repeats int")


def test_shares_and_repeats(spark):
    docs = [(i, "Big " if i % 2 else "big", f"some words in text number {i}") for i in range(200)] + [(1000 + i, "small", f"few words {i}") for i in range(5)] + [(2000, None, "x y"), (2001, "other", "x"), (2002, "big", None), (2003, "big", "")]
    chosen, report = mix(*[*tables(spark, docs, [("big", 0.8, 1), ("small", 0.2, 3)])][:1], "id", "text", "source", tables(spark, docs, [("big", 0.8, 1), ("small", 0.2, 3)])[1])
    rows, by = chosen.collect(), {r.source: r for r in report.collect()}
    small = [r for r in rows if r.source == "small"]
    assert len(small) == 5 and all(r.copies == 3 for r in small) and not [r for r in rows if r.id >= 2000]
    total = by["small"].max_repeats * by["small"].have / 0.2
    assert by["big"].chosen_tokens <= 0.8 * total < by["big"].chosen_tokens + 20 and abs(by["small"].actual_share - 0.2) < 0.02
    assert by["other"].target_share == 0 and by[None].chosen_tokens == 0 and abs(sum(r.actual_share for r in by.values()) - 1) < 1e-9
    assert max(r.copies for r in rows if r.source == "big") == 1


def test_order_is_by_exponential_keys(spark):
    docs = [(i, "a", "same text") for i in range(50)]
    d, t = tables(spark, docs, [("a", 1.0, 2)])
    per = mix(d, "id", "text", "source", t)[0].first().tokens
    one = {r.id for r in mix(d, "id", "text", "source", t, total_tokens=10 * per)[0].collect()}
    two = {r.id: r.copies for r in mix(d, "id", "text", "source", t, total_tokens=60 * per)[0].collect()}
    assert len(one) == 10 and sum(two.values()) == 60 and {i for i, c in two.items() if c == 2} == one
    again = {r.id for r in mix(d, "id", "text", "source", t, total_tokens=10 * per)[0].collect()}
    other = {r.id for r in mix(d, "id", "text", "source", t, total_tokens=10 * per, seed=7)[0].collect()}
    assert one == again != other and not math.isnan(per)


def test_empty(spark):
    d, t = tables(spark, [], [("a", 1.0, 2)])
    chosen, report = mix(d, "id", "text", "source", t)
    assert chosen.count() == 0 and report.collect()[0].actual_share == 0
    d, t = tables(spark, [(1, "a", "b")], [])
    chosen, report = mix(d, "id", "text", "source", t)
    assert chosen.count() == 0 and [r.source for r in report.collect()] == ["a"]


def test_quality_weight(spark):
    prose = "Der Rat stimmte gestern mit knapper Mehrheit zu. Die Kosten steigen auf zwei Millionen Euro."
    texts = [prose, "Kaufen Kaufen Kaufen Kaufen Kaufen Kaufen Kaufen Kaufen", "1234 | 5678 | 91011 | 1213", "Der Rat stimmte gestern mit knapper Mehrheit zu und", "", None]
    got = [r.w for r in spark.createDataFrame([(t,) for t in texts], "t string").select(text_quality(F.col("t")).alias("w")).collect()]
    assert got[0] > 0.8 and got[0] > got[3] > got[1] > 0 and got[0] > got[2] and got[5] == 0.01 and min(got) >= 0.01
