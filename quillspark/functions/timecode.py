"""Time codes of posts and month arithmetic. Times are UTC; pin spark.sql.session.timeZone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: the key with which the archive masks its Unix times.
KEY = 0xFEFEC0DE


def decode_seconds(code: Column) -> Column:
    """Unix seconds of a code of 1 to 8 hex digits; null for anything else."""
    ok = code.rlike("^[0-9A-Fa-f]{1,8}$")
    return F.when(ok, F.conv(code, 16, 10).cast("bigint").bitwiseXOR(F.lit(KEY).cast("bigint")))


def decode(code: Column) -> Column:
    return F.date_format(F.timestamp_seconds(decode_seconds(code)), "yyyy-MM-dd HH:mm:ss")


def month_of(code: Column) -> Column:
    return F.date_format(F.timestamp_seconds(decode_seconds(code)), "yyyyMM")


def encode(seconds: Column) -> Column:
    return F.lower(F.hex(seconds.cast("bigint").bitwiseXOR(F.lit(KEY).cast("bigint"))))


def months(spark: SparkSession, start: Column | str, end: Column | str, most: int | None = None) -> DataFrame:
    """(month) as ``yyyyMM`` from the month of ``start`` to that of ``end``; at most ``most`` of them."""
    as_col = lambda x: F.to_date(F.lit(x)) if isinstance(x, str) else x
    return month_rows(spark.range(1).select(as_col(start).alias("a"), as_col(end).alias("b")), "a", "b", most)


def month_rows(bounds: DataFrame, start: str, end: str, most: int | None = None) -> DataFrame:
    first, last = F.trunc(F.col(start).cast("date"), "month"), F.trunc(F.col(end).cast("date"), "month")
    ok = bounds.where(last >= first).select(F.explode(F.sequence(first, F.greatest(first, last), F.expr("interval 1 month"))).alias("d")).select(F.date_format("d", "yyyyMM").alias("month"))
    return ok if most is None else ok.orderBy("month").limit(most)


def unprocessed(all_months: DataFrame, processed: DataFrame, reprocess: bool = False) -> DataFrame:
    return all_months if reprocess else all_months.join(processed.select("month"), "month", "left_anti")


def month_delta(start: Column, end: Column) -> Column:
    return F.floor(F.months_between(end, start)).cast("bigint")


def page_url(month: Column, base: str) -> Column:
    return F.concat(F.lit(base), month)
