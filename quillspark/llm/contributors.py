"""Problem 1: a cap on the records of each dominant contributor.

``cap_contributors`` is a distributed suitor b-matching. Every record proposes to all contributors that it lists. A
contributor holds the best proposals that fit its places and displaces the weakest, which then leaves all its lists; places
that become free are proposed for again. Rounds over all proposals settle what is certain, and a rest of bounded size is
settled in one task by lists with displacement, so that long chains of displacements need no rounds. The result equals the
greedy matching in the order (quality descending, null last, key ascending).
"""

from __future__ import annotations

import functools
import heapq
import unicodedata
from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.runtime import cut_lineage, ranked_in_groups

_BLANK = "^[\\s\\u00a0\\u1680\\u2000-\\u200b\\u2028\\u2029\\u202f\\u205f\\u3000\\ufeff]+|[\\s\\u00a0\\u1680\\u2000-\\u200b\\u2028\\u2029\\u202f\\u205f\\u3000\\ufeff]+$"


def stripped(c: Column) -> Column:
    return F.regexp_replace(c, _BLANK, "")


def raw_host(url: Column) -> Column:
    """The authority of a URL without user and port, as written; works for URLs without a scheme as well."""
    rest = F.regexp_replace(stripped(url), "^(?:[a-zA-Z][a-zA-Z0-9+.-]*:(?=[/\\\\]{2})|[hH][tT][tT][pP][sS]?:)?[/\\\\]*", "")
    authority = F.regexp_extract(rest, "^[^/\\\\?#]*", 0)
    return F.regexp_replace(F.regexp_replace(authority, "^.*@", ""), ":[0-9]*$", "")


def registrable(host: str, labels: int = 2) -> str | None:
    """The last ``labels`` labels of a host, lower case, international labels decoded; None for an empty host."""
    if "%" in host:
        from urllib.parse import unquote

        host = unquote(host)
    host = unicodedata.normalize("NFKC", host).lower()
    for dot in "\u3002\uff0e\uff61":
        host = host.replace(dot, ".")
    parts = [p for p in host.strip(" \t.").split(".") if p][-labels:]
    out = []
    for p in parts:
        if p.startswith("xn--"):
            try:
                p = unicodedata.normalize("NFKC", p[4:].encode("ascii").decode("punycode")).lower()
            except UnicodeError:
                pass
        out.append(p.replace("\u00df", "ss"))
    return ".".join(out) or None


@F.pandas_udf(T.StringType())
def _registrable(hosts: pd.Series) -> pd.Series:
    known = {h: registrable(h) for h in hosts.dropna().unique()}
    return hosts.map(known).astype(object).where(hosts.notna(), None)


def contributor_of_url(url: Column) -> Column:
    """The last two labels of the host in ``url``; null when the URL is null, blank or has no host."""
    return _registrable(raw_host(url))


def suitors(listed: dict[int, list[str]], free: dict[str, int]) -> set[int]:
    """The records that are held everywhere; a smaller number is a better record.

    A record proposes to all its contributors at once. Each holds a list no longer than its free places; where it is full,
    the weakest record of the list is displaced if the proposal is better, and so leaves its other lists. The proposal is
    turned down if one contributor is full of better records. A place that becomes free lets those propose again that were
    turned down there. The end is the greedy matching, in whatever order the records propose.
    """
    lists: dict[str, list[int]] = {c: [] for cs in listed.values() for c in cs}  # heaps of negated numbers, the weakest first
    gone: dict[str, set[int]] = {c: set() for c in lists}  # numbers that left a heap without being its weakest
    size = dict.fromkeys(lists, 0)
    refused: dict[str, list[int]] = {c: [] for c in lists}
    held: set[int] = set()
    queue = deque(listed)

    def weakest(c: str) -> int:
        heap = lists[c]
        while -heap[0] in gone[c]:
            gone[c].discard(-heapq.heappop(heap))
        return -heap[0]

    def leave(r: int, at: str | None) -> None:
        held.discard(r)
        for c in listed[r]:
            gone[c].add(r)
            size[c] -= 1
            if c != at and refused[c]:
                queue.extend(refused[c])
                refused[c] = []

    while queue:
        r = queue.popleft()
        full = [c for c in listed[r] if size[c] >= free.get(c, 0)]
        blocked = next((c for c in full if not size[c] or weakest(c) < r), None)
        if blocked is not None:
            refused[blocked].append(r)
            continue
        for c in full:
            if size[c] >= free.get(c, 0):  # still: a displaced record may have left two of the lists
                w = weakest(c)
                leave(w, c)
                refused[c].append(w)
        held.add(r)
        for c in listed[r]:
            if r in gone[c]:
                gone[c].discard(r)  # its old entry is valid again
            else:
                heapq.heappush(lists[c], -r)
            size[c] += 1
    return held


#: Proposals from which the rest of a matching is settled in one task.
FINISH = 200_000


def _finished(waiting: DataFrame, taken: DataFrame, capacity: int, order: list[Column], row_type: str) -> DataFrame:
    """(_row) of the records that are kept of the waiting ones, at most FINISH proposals, by ``suitors`` in one task."""
    rows = waiting.select("_row", "key", "quality", F.explode("listed").alias("contributor")).join(taken, "contributor", "left")
    rows = rows.select("_row", "key", "quality", "contributor", (F.lit(capacity) - F.coalesce("taken", F.lit(0))).alias("free")).repartition(1).sortWithinPartitions(*order)

    def settle(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number: dict[int, int] = {}
        listed: dict[int, list[str]] = {}
        free: dict[str, int] = {}
        for part in parts:
            for row, contributor, places in zip(part["_row"], part["contributor"], part["free"]):
                listed.setdefault(number.setdefault(row, len(number)), []).append(contributor)
                free[contributor] = places
        names = list(number)
        yield pd.DataFrame({"_row": [names[i] for i in sorted(suitors(listed, free))]}, dtype="int64")

    return rows.mapInPandas(settle, f"_row {row_type}")


def cap_contributors(records: DataFrame, key: str, contributors: str, quality: str, capacity: int, finish: int = FINISH) -> DataFrame:
    """Decide for every record whether it is kept; each contributor keeps at most ``capacity`` records.

    ``contributors`` is an array column. Returns one row per input row: (key, contributors, quality, kept). A record whose
    list is null or empty, or holds only nulls, competes with nobody and is kept. A null quality ranks last, ties go to the
    smaller key, a null key ranks after all keys; repeated rows compete as separate records. Other columns of ``records``
    are not read. An empty input gives an empty result.

    While more than ``finish`` proposals wait, a round ranks them at their contributors. A record that is held everywhere
    stays, since only better ones stand before it; one that is turned down anywhere is displaced from its other lists, and
    is lost if a contributor has no place left that could become free. The others propose again. A record with one
    contributor needs no exchange beyond its rank, so without shared records the first round decides everything.
    """
    base = records.select(
        F.col(key).alias("key"), F.array_distinct(F.array_compact(F.col(contributors))).alias("listed"), F.col(quality).cast("double").alias("quality")
    ).withColumn("quality", F.when(~F.isnan("quality"), F.col("quality")))
    order = [F.col("quality").desc_nulls_last(), F.col("key").asc_nulls_last(), F.col("_row").asc()]
    base = cut_lineage(base.withColumn("_row", F.monotonically_increasing_id()))
    free = base.where(F.coalesce(F.size("listed"), F.lit(0)) <= 0).withColumn("kept", F.lit(True))
    bound = waiting = base.where(F.size("listed") > 0)
    taken: DataFrame | None = None  # contributor, places taken for good
    kept: list[DataFrame] = []
    while True:
        proposals = waiting.select("_row", "key", "quality", F.size("listed").alias("n"), F.explode("listed").alias("contributor"))
        ranked = ranked_in_groups(proposals, ["contributor"], order)
        if taken is not None:
            ranked = ranked.join(taken, "contributor", "left")
        held = F.col("rank_in_group") <= capacity - (F.coalesce(F.col("taken"), F.lit(0)) if taken is not None else F.lit(0))
        ranked = ranked.withColumn("held", held)
        everywhere = ranked.where("n > 1").groupBy("_row").agg(F.min("held").alias("all_held"))
        state = ranked.join(everywhere, "_row", "left").select("_row", "contributor", F.when(F.col("n") > 1, F.col("all_held")).otherwise(F.col("held")).alias("held"))
        state = cut_lineage(state)
        kept.append(state.where("held").select("_row").distinct())
        gain = state.where("held").groupBy("contributor").agg(F.count(F.lit(1)).alias("taken"))
        taken = cut_lineage(gain if taken is None else taken.unionByName(gain).groupBy("contributor").agg(F.sum("taken").alias("taken")))
        if capacity <= 0:
            break
        closed = taken.where(F.col("taken") >= capacity).select("contributor", F.lit(True).alias("closed"))
        open_rows = state.where("not held").join(closed, "contributor", "left").groupBy("_row").agg(F.max(F.coalesce("closed", F.lit(False))).alias("closed")).where("not closed")
        waiting = cut_lineage(waiting.join(open_rows.select("_row"), "_row", "left_semi"))
        left = waiting.agg(F.sum(F.size("listed"))).first()[0] or 0
        if left == 0:
            break
        if left <= finish:
            kept.append(_finished(waiting, taken, capacity, order, "long"))
            break
    winners = functools.reduce(DataFrame.unionByName, kept)
    decided = bound.join(winners.withColumn("kept", F.lit(True)), "_row", "left").withColumn("kept", F.coalesce("kept", F.lit(False)))
    result = free.select("key", "listed", "quality", "kept").unionByName(decided.select("key", "listed", "quality", "kept"))
    return result.select(F.col("key").alias(key), F.col("listed").alias(contributors), F.col("quality").alias(quality), "kept")


def cap_hosts(rows: DataFrame, key: str, url: str, quality: str, divisor: int) -> DataFrame:
    """``cap_contributors`` with the site of ``url`` as the contributor and floor(rows with a url / divisor) places."""
    linked = rows.select(F.col(key), F.col(url).alias("_url"), F.col(quality)).where(F.length(stripped(F.col("_url"))) > 0)
    n = linked.count()
    sites = linked.select(key, F.array(contributor_of_url(F.col("_url"))).alias("sites"), quality)
    return cap_contributors(sites, key, "sites", quality, n // divisor)
