import random

import pytest

from quillspark.llm.contributors import cap_contributors, cap_hosts, registrable, suitors

SCHEMA = "id long, who array<string>, q double, kept string, quality int"


def greedy(rows, cap):
    """Records in order of quality, null last, then key; each is kept if all its contributors have a free place."""
    left, kept = {}, set()
    for i, who, q in sorted(rows, key=lambda r: (r[2] is None, -(r[2] or 0), r[0])):
        names = {w for w in who or [] if w is not None}
        if all(left.get(w, 0) < cap for w in names):
            kept.add(i)
            for w in names:
                left[w] = left.get(w, 0) + 1
    return kept


def run(spark, rows, cap):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    got = cap_contributors(df.withColumnRenamed("kept", "other").withColumnRenamed("quality", "rank_in_group"), "id", "who", "q", cap).collect()
    assert len(got) == len(rows)
    return {r.id for r in got if r.kept}


@pytest.mark.parametrize("seed, cap", [(1, 5), (2, 1), (3, 40), (4, 0)])
def test_many_contributors_equal_greedy(spark, seed, cap):
    r = random.Random(seed)
    rows = [(i, r.sample(["hot", "a", "b", "c", "d"], r.randrange(1, 4)) if r.random() < 0.6 else ["hot"], r.choice([None, 0.1, 0.5, 0.5, 0.9])) for i in range(120)]
    assert run(spark, rows, cap) == greedy(rows, cap)


def test_one_contributor_with_nulls_and_ties(spark):
    rows = [(1, ["a"], 0.5), (2, ["a"], 0.5), (3, ["a"], None), (4, None, 0.1), (5, [], 0.1), (6, [None], 0.1), (7, ["a"], 0.9), (8, ["b"], None)]
    assert run(spark, rows, 2) == greedy(rows, 2) == {7, 1, 4, 5, 6, 8}


def test_empty(spark):
    assert cap_contributors(spark.createDataFrame([], SCHEMA), "id", "who", "q", 3).count() == 0


@pytest.mark.parametrize(
    "host, site",
    [("www.Münz.Example.", "münz.example"), ("xn--mnz-hoa.example", "münz.example"), ("a.b.c.d", "c.d"), ("", None), ("xn--%%%.x", "xn--%%%.x"), ("A。b", "a.b"), ("localhost", "localhost"), ("xn--a\u00e4", "xn--a\u00e4")],
)
def test_sites(host, site):
    assert registrable(host) == site


def test_hosts_however_written(spark):
    urls = ["https://www.foo.test/a", "  http://www2.foo.test/ ", "//foo.test?x=b.other.test", "www.foo.test", "HTTPS://WWW.FOO.TEST:443/", "https://me@foo.test./", "foo.test:80/x", "https://foo.test#y", "http:\\\\foo.test\\z", None, " ", "", "/nur/pfad"]
    df = spark.createDataFrame([(i, u, 1.0 - i / 100) for i, u in enumerate(urls)], "id long, url string, q double")
    got = {r.id: r.kept for r in cap_hosts(df, "id", "url", "q", 5).collect()}  # 10 rows with a url: two places
    assert {i for i, k in got.items() if k} == {0, 1, 12} and set(got) == {*range(9), 12}


def first_come(records, capacity):
    free, kept = {}, set()
    for r, cs in sorted(records.items()):
        if all(free.setdefault(c, capacity) > 0 for c in cs):
            kept.add(r)
            for c in cs:
                free[c] -= 1
    return kept


@pytest.mark.parametrize("seed", range(40))
def test_displacement_ends_in_the_greedy_matching(seed):
    r = random.Random(seed)
    records = {i: r.sample("abcdefg", r.randrange(1, 4)) for i in range(r.randrange(1, 60))}
    shuffled = dict(r.sample(sorted(records.items()), len(records)))
    capacity = r.randrange(0, 5)
    assert suitors(shuffled, dict.fromkeys("abcdefg", capacity)) == first_come(records, capacity)


@pytest.mark.parametrize("finish", [0, 1_000_000])
def test_long_chain_and_shared_records(spark, finish):
    n = 10 if finish == 0 else 2_000  # each record displaces the next at a shared contributor
    rows = [(i, [f"c{i}", f"c{i + 1}"], 1.0 - i / 10_000) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, by array<string>, q double").repartition(4)
    got = {x.id for x in cap_contributors(df, "id", "by", "q", 1, finish).where("kept").collect()}
    assert got == set(range(0, n, 2))
    two = spark.createDataFrame([(1, ["a", "b"], 0.9), (2, ["b"], 0.8)], "id long, by array<string>, q double")
    assert [x.id for x in cap_contributors(two, "id", "by", "q", 1, finish).where("kept").collect()] == [1]
