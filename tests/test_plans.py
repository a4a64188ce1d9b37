import duckdb
import pytest

from quillspark import oracle, queries
from quillspark.plans.ingest import aggregate
from quillspark.sources import pages, sinks
from quillspark.streaming.incremental import ingest_new_pages, totals

MONTH = '<h3>Day one</h3><ul><li><a href="?ts=b1b2c3d4">[l]</a> Text <a href="https://www.example.org/a">das hier</a> ist toll. <blockquote>A quoted line.</blockquote>\n<li>kein Link hier\n<li><a href="?ts=zz">[l]</a> schlechter Code</ul><h3>Day two</h3><ul><li><a href="?ts=b1b2c3d4">[l]</a> doppelt <a href="/?ts=aa">alt</a></ul>'


def test_posts_words_domains(spark):
    made = aggregate(spark.createDataFrame([("201202", MONTH)], "month string, html string"))
    posts = made["posts"].collect()
    assert len(posts) == 1
    p = posts[0]
    assert (p.hexTimestamp, p.timestamp, p.quoteCount, p.content, p.wordCount, p.sourcesCount) == ("b1b2c3d4", "2012-02-27 22:26:18", 1, "[l] Text das hier ist toll.", 5, 1)
    assert p.url == "https://blog.linkstube.example/?ts=b1b2c3d4" and "<blockquote>" in p.contentHtml and p.externalSources == []
    words = {(r.bucket, r.word): r.cnt for r in made["words"].collect()}
    assert words[("sum", "hier")] == 2 and words[("201202", "text")] == 1 and words[("sum", "schlechter")] == 1 and words[("sum", "doppelt")] == 1
    domains = {(r.bucket, r.domain): r.cnt for r in made["domains"].collect()}
    assert domains == {("201202", "example.org"): 1, ("201202", "self"): 1, ("sum", "example.org"): 1, ("sum", "self"): 1}


def test_lookup_of_sources(spark):
    linked = spark.createDataFrame([("https://www.example.org/a", "T", None, None, None, None)], "url string, title string, description string, author string, published string, site_name string")
    post = aggregate(spark.createDataFrame([("201202", MONTH)], "month string, html string"), linked)["posts"].first()
    assert [s.title for s in post.externalSources] == ["T"]


def test_pages_without_lists(spark):
    made = aggregate(spark.createDataFrame([("201202", "<p>nichts</p>"), ("201203", None)], "month string, html string"))
    assert made["posts"].count() == 0 and made["words"].count() == 0


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/201202data.html").write_text(MONTH, encoding="utf8")
    saved = pages.saved_pages(spark, str(tmp_path / "in"), "data.html")
    assert [(r.month, r.html) for r in saved.collect()] == [("201202", MONTH)]
    spark.dataSource.register(pages.MonthPages)
    fetched = spark.read.format("month_pages").option("url", f"file://{tmp_path}/in/{{month}}data.html").option("months", "201202").load()
    assert fetched.first().html == MONTH
    made = aggregate(saved)
    out = str(tmp_path / "out")
    sinks.write_all(made["posts"], made["words"], made["domains"], out)
    line = spark.read.text(f"{out}/messages.csv").first().value
    assert line.startswith("2012-02-27 22:26:18\tb1b2c3d4\t1\t5\t1\t") and line.endswith("\t")
    assert "sum\texample.org\t1" in {r.value for r in spark.read.text(f"{out}/domains.csv").collect()}
    assert {(r.domain, r.cnt) for r in spark.read.json(f"{out}/domains.json").where("bucket = 'sum'").collect()} == {("example.org", 1), ("self", 1)}
    nested = {r.bucket: r.value for r in sinks.nested_counts(made["domains"], "bucket", "domain").collect()}
    assert nested["sum"] == '{"example.org":1,"self":1}'
    sinks.archive_pages(saved, f"{out}/archive")
    assert spark.read.parquet(f"{out}/archive").first().month in (201202, "201202")
    (tmp_path / "m.json").write_text('{"ab": {"timestamp": "t", "content": "c", "externalSources": [{"title": "x", "url": "u"}]}, "cd": {}}')
    posts = {r.post_id: r for r in pages.posts_json(spark, str(tmp_path / "m.json")).collect()}
    assert posts["ab"].externalSources[0].title == "x" and posts["cd"].content is None
    (tmp_path / "r.json").write_text('[{"topic": "a"}, {"topic": "b", "quality_score": 0.5}]')
    assert pages.rows_json(spark, str(tmp_path / "r.json")).count() == 2
    assert pages.prompt_rows(spark, [("", "", ""), ("t", "", "")]).count() == 1


def test_incremental_run(spark, tmp_path):
    (tmp_path / "in").mkdir()
    run = lambda: ingest_new_pages(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    (tmp_path / "in/201202.html").write_text(MONTH)
    run()
    (tmp_path / "in/201203.html").write_text(MONTH.replace("b1b2c3d4", "b1b2c3d5"))
    run()
    run()
    assert spark.read.parquet(str(tmp_path / "out/posts")).count() == 2
    words = {(str(r.bucket), r.word): r.cnt for r in totals(spark.read.parquet(str(tmp_path / "out/words")), "word").collect()}
    assert words[("sum", "toll")] == 2 and words[("201203", "toll")] == 1


ORACLE = oracle.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, small, name):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in ("messages", "externalsources", "fefe_training_data", "documents", "benchmark_set", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    df = queries.QUERIES[name](spark, small)
    cols = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*cols).collect()), key=str)
    answer = con.execute(ORACLE[name])
    names = [c[0] for c in answer.description]
    want = sorted((tuple(r[names.index(c)] for c in cols) for r in answer.fetchall()), key=str)
    assert sorted(names) == cols and got == want


@pytest.mark.parametrize("name", ["word_counts", "normalize_text", "domain_counts", "hard_drop_reasons", "quality_scores", "topic_labels", "prompt_text", "anchor_repair", "months_unprocessed", "dedup_first"])
def test_plans_stay_native(spark, small, name):
    plan = queries.QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan
    if name == "months_unprocessed":
        assert "LeftAnti" in plan
    if name == "topic_labels":
        assert "topic:string" in plan and "target_comment" not in plan


def test_top_topics_takes_ordered(spark, small):
    assert "TakeOrderedAndProject" in queries.QUERIES["top_topics"](spark, small)._jdf.queryExecution().executedPlan().toString()
