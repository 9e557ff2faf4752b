"""Survivorship: every rule, ties, nulls, clashing columns."""

from datetime import datetime

from foliospark.llm import survivorship as sur

SCHEMA = "article_id string, source_html_path string, canonical_url string, published_at_utc timestamp, updated_at_utc timestamp, editorial_character_count long, editorial_block_count int, metadata_completeness int, header_image_path string, inline_image_urls array<string>, path string, empty int"
D = lambda n: datetime(2024, 1, n)


def row(article, path, chars=10, blocks=1, complete=1, updated=None, url=None, image=None, inline=None, published=D(2)):
    return (article, path, url, published, updated, chars, blocks, complete, image, inline, "clash", 1)


def found(spark, rows, finished=D(20)):
    runs = spark.createDataFrame([("r", finished), ("s", None)], "run_id string, finished_at timestamp")
    return {(r.article_id, r.field_name): r.source_html_path for r in sur.sources_by_field(spark.createDataFrame(rows, SCHEMA), runs).collect()}


def test_record_order(spark):
    rows = [
        row("chars", "a", 5), row("chars", "b", 6), row("empty", "a", 0, 9), row("empty", "b", -5), row("empty", "c", None, 99), row("blocks", "a", 5, 1), row("blocks", "b", 5, 2), row("meta", "a", complete=1), row("meta", "b", complete=2),
        row("upd", "a", updated=D(3)), row("upd", "b", updated=D(4)), row("upd", "c", updated=D(25)), row("upd", "d"), row("tie", "b"), row("tie", "a"), row("tie", "a"), row("one", "a"), row("one", "a"), row(None, "x"), row(None, "y"), row("np", None), row("np", "z"),
    ]
    got = {k[0]: v for k, v in found(spark, rows).items() if k[1] == "record"}
    assert got == {"chars": "b", "empty": "a", "blocks": "b", "meta": "b", "upd": "b", "tie": "a"}


def test_fields(spark):
    rows = [
        row("f", "a", 9, url="httpsx://x", image="i.gif", inline=["u", "u"], updated=D(1)),
        row("f", "b", 8, url="https://x", image="i.JPG", inline=["u", None, "v"], updated=D(5)),
        row("f", "c", 7, url="http://y", image="j.webp", inline=["v", "w"], updated=D(6)),
        row("f", "d", 6, updated=D(6), inline=[]),
        row("none", "a"), row("none", "b", inline=[None]),
        row("case", "a", 9, url="HTTPS://x"), row("case", "b", 8, url="https://y"), row("case2", "a", 9, url=" http://x"), row("case2", "b", 8, url="Http://y"),
    ]
    got = found(spark, rows)
    assert {k[1]: v for k, v in got.items() if k[0] == "f"} == {"record": "a", "canonical_url": "b", "header_image_path": "b", "updated_at_utc": "c", "inline_image_urls": "b"}
    assert {k[1] for k in got if k[0] == "none"} == {"record"}
    assert got[("case", "canonical_url")] == "a" and got[("case2", "canonical_url")] == "b"


def test_bounds_that_are_missing_do_not_bind(spark):
    rows = [row("x", "a", updated=D(1), published=None), row("x", "b", updated=D(30), published=None)]
    assert found(spark, rows, finished=None)[("x", "updated_at_utc")] == "b"
    assert found(spark, []) == {}


def test_records_are_built_of_the_best_rows(spark):
    runs = spark.createDataFrame([("r", D(20))], "run_id string, finished_at timestamp")
    rows = [row("f", "a", 9, url="no", inline=["u"]), row("f", "b", 8, url="http://y", inline=["u", "v"]), row("g", "c")]
    got = {r.article_id: r for r in sur.surviving_records(spark.createDataFrame(rows, SCHEMA), runs).collect()}
    assert (got["f"].source_html_path, got["f"].canonical_url, got["f"].inline_images, got["f"].rows) == ("a", "http://y", 2, 2) and got["g"].canonical_url is None


def test_a_hot_article_is_combined_before_the_shuffle(spark):
    rows = spark.range(0, 60_000, 1, 8).selectExpr(
        "case when id % 3 = 0 then 'hot' else concat('a', id) end as article_id", "concat('p', id) as source_html_path", "cast(null as string) as canonical_url", "timestamp'2024-01-01' as published_at_utc", "cast(null as timestamp) as updated_at_utc", "id as editorial_character_count",
        "1 as editorial_block_count", "1 as metadata_completeness", "cast(null as string) as header_image_path", "array('x') as inline_image_urls",
    )
    runs = spark.createDataFrame([], "run_id string, finished_at timestamp")
    got = sur.sources_by_field(rows, runs).collect()
    assert {(r.field_name, r.source_html_path) for r in got} == {("record", "p59997"), ("inline_image_urls", "p59997")}
