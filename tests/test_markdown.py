"""Extraction: exact Markdown, metadata chains, identities, dates."""

import gc
from datetime import UTC, datetime
from html.parser import HTMLParser

import pytest

from foliospark.functions import identity as ids
from foliospark.functions import markdown, markup
from foliospark.functions.markdown import escape, escape_lines, extract
from foliospark.operators.extraction import extract_articles
from foliospark.plans import extraction_queries

HEAD = '<meta name="article.id" content=" A-1 "><meta name="article.published" content="2024-01-15T05:01:00Z">'


def article(body, head=HEAD, **kw):
    return extract(f"<html><head>{head}</head><body><article>{body}</article></body></html>", **kw)


def test_blocks():
    a = article(
        "<p>One <b>two</b> <a href='/x y?q=1'>link</a><br>three</p><h2>Head</h2><ul><li>a<ul><li>b</li></ul></li><li> </li><li>c</li></ul><ol><li></li><li>x</li></ol>"
        "<table><tr><th>h</th><th>i</th></tr><tr><td>1</td></tr></table><blockquote><p>q</p><p>r</p></blockquote><figure><img src='/i.jpg' alt='A *b*'><figcaption>cap</figcaption></figure><p><img src='/i.jpg'></p><div>loose <p>para</p> tail</div>",
        HEAD + '<link rel="Canonical" href="HTTPS://Ex.Com:443/s/">',
    )
    assert a.markdown_text.split("\n\n") == [
        "One two [link](https://ex.com/x%20y?q=1) three",
        "## Head",
        "- a\n  - b\n- c",
        "2. x",
        "| h | i |\n| --- | --- |\n| 1 |  |",
        "> q\n>\n> r",
        "![A \\*b\\*](https://ex.com/i.jpg)",
        "cap",
        "loose",
        "para",
        "tail",
    ]
    assert a.article_id == "id:A-1" and a.canonical_url == "https://ex.com/s" and a.editorial_block_count == 11
    assert a.inline_image_urls == ["https://ex.com/i.jpg"] and a.editorial_character_count == len(a.markdown_text)


def test_excluded_parts():
    a = article("<p>keep</p><nav>n</nav><div class='ad slot'>x</div><p hidden>x</p><p aria-hidden=TRUE>x</p><p style='display : none'>x</p><section id='related-x'><p>x</p></section><script>x</script><div data-testid='share-bar'>x</div><p class='shared'>kept</p>")
    assert a.markdown_text == "keep\n\nkept"


def test_metadata_chains():
    ld = '<script type="application/ld+json">{"@graph":[{"@type":"WebPage"},{"@type":["NewsArticle"],"headline":"LD","description":"D","author":[{"name":"A B"},{"name":"C"}],"datePublished":"2024-01-01T00:00:00+01:00","dateModified":"bad"}]}</script>'
    a = article("<header><h1>Dom</h1><p class=dek>Dek</p></header><div class='body'><p class=dek>no</p></div><p>T</p>", '<script type="application/ld+json">{broken</script>' + ld)
    assert a.markdown_text == "# LD\n\nD\n\nDek\n\nBy A B and C\n\nT"
    assert a.published_at_utc == datetime(2023, 12, 31, 23, tzinfo=UTC) and a.warnings == ["invalid_optional_update"]
    b = article("<h1>Dom title</h1><p class=byline>By X Y, Z and W</p><p>T</p>")
    assert b.markdown_text == "# Dom title\n\nBy X Y, Z and W\n\nT".replace("By X Y, Z and W", "By X Y, Z and W")
    c = article("<p>T</p>", HEAD + '<meta name="author" content="P | Q"><meta property="article.summary" content="By P and Q"><meta name="article.headline" content="H">')
    assert c.markdown_text == "# H\n\nBy P and Q\n\nT"
    assert c.metadata_completeness == 5


def test_failures_and_empty():
    assert extract("").error == "missing_publication_timestamp"
    assert article("", '<meta name="article.published" content="x">').error == "invalid_timestamp"
    assert article("", '<meta name="datePublished" content="2024-01-01T10:00:00">').error == "naive_timestamp"
    assert article("").warnings == ["empty_content"] and article("").markdown_text == ""


@pytest.mark.parametrize("text,expect", [("# a", "\\# a"), ("1. x", "1\\. x"), ("- x", "\\- x"), ("---", "\\---"), ("> q", "\\> q"), ("#tag", "#tag"), ("+", "\\+"), ("a\n2) b", "a\n2\\) b")])
def test_escape_lines(text, expect):
    assert escape_lines(text) == expect


def test_urls_and_identity():
    same = {ids.normalize_url(u) for u in ("HTTPS://WWW.EX.COM:443/business/story/?b=2&a=1#f", "https://www.ex.com/business/story?a=1&b=2")}
    assert same == {"https://www.ex.com/business/story?a=1&b=2"}
    assert ids.normalize_url(" http://h:bad/x ") == "http://h:bad/x"
    assert ids.article_identity(None, " ", "ff", "n") == "html:ff" and ids.article_identity("", "http://a/", "f", "n").startswith("url:")
    assert ids.resolve_url("mailto:x@y", "http://a") is None and ids.resolve_url("b", "http://A:80/c/") == "http://a/c/b"
    assert ids.is_http_url("https://a/b") and not ids.is_http_url("https://a/ b") and not ids.is_http_url("ftp://a") and not ids.is_http_url("http://a:x")
    assert escape("a_b [c]") == "a\\_b \\[c\\]"
    assert ids.is_safe_relative_path("a/b.md") and not any(map(ids.is_safe_relative_path, ("/a", "a//b", "../a", "a/./b", "", None, "a\\b")))


def test_frame(spark):
    rows = [("a.html", f"<html><head>{HEAD}</head><body><p>x</p></body></html>", ["missing_image"], 1), ("b.html", None, None, 2), ("c.html", "", [], 3)]
    got = {r.source_html_path: r for r in extract_articles(spark.createDataFrame(rows, "source_html_path string, html string, warnings array<string>, article_id int")).collect()}
    assert str(got["a.html"].publication_date_new_york) == "2024-01-15" and got["a.html"].warnings == ["missing_image"]
    assert got["b.html"].error_code == got["c.html"].error_code == "missing_publication_timestamp" and got["b.html"].article_id is None


@pytest.mark.parametrize("instant,date", [("2024-01-01 02:30:00", "2023-12-31"), ("2024-01-15 04:59:00", "2024-01-14"), ("2024-01-15 05:01:00", "2024-01-15"), ("2024-07-15 03:59:00", "2024-07-14"), ("2024-07-15 04:01:00", "2024-07-15")])
def test_new_york_dates(spark, instant, date):
    from pyspark.sql import functions as F

    row = spark.range(1).select(ids.new_york_date(F.lit(instant).cast("timestamp")).alias("d")).first()
    assert str(row.d) == date


def test_rendered_pages_are_spread(spark, tmp_path):
    """One small file of parts is work for several tasks, and every part gives its page."""
    rows = [(k, f"name {k}", "Brand#1", "SMALL TIN", k % 50, 900.5) for k in range(2 * extraction_queries.PARTS_A_TASK + 1)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    found = extraction_queries.rendered_pages(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() == 3
    got = found.select("source_html_path", "article_id", "editorial_block_count").collect()
    assert sorted((int(r[0]), r[1], r[2]) for r in got) == [(k, f"id:P{k}", 15) for k, *_ in rows]


def test_markers_are_read_once(monkeypatch):
    """However many sources ask for an element's markers, its words are found once; elements without markers have none to find."""
    calls = []

    class Counting:
        def findall(self, text):
            calls.append(text)
            return pattern.findall(text)

    pattern = markdown._WORDS
    monkeypatch.setattr(markdown, "_WORDS", Counting())
    a = article("<header><h1 class='Headline'>H</h1><p id=dek>D</p></header><div class=body><p>T</p><p>U</p></div>")
    assert a.markdown_text == "# H\n\nD\n\nT\n\nU" and sorted(calls) == ["body", "dek", "headline"]


def test_tree_needs_no_cycle_collector():
    article("<p>x</p>")
    gc.collect()
    gc.disable()
    try:
        a = article("<p>x</p>" * 500)
        assert a.editorial_block_count == 500 and gc.collect() < 100
    finally:
        gc.enable()


@pytest.mark.parametrize("page", ["<P>a</P>b", "<p\x0c>a</p >b</ p>c", "a</>b<a<b>c", "<script><p>a</b></script>b", "<STYLE>a</p></STYLE>b", "<title>a<b>c</b></title>d", "<textarea><p>a</textarea>b", "<\u017fcript>a</\u017fcript>b", "<\u212a>a</\u212a>b", "<br/>a<p/>b<x-y>c</x-y>", "<!-- <p> -->a<p", "a</p", "<h1>a</h1><svg>b", "<!doctype html><p class=a>b&amp;c<!-- d --></p>e<i>", "<!DOCTYPE", "<p a='<b>'>c</p a='>'>d", "a<", "<p>a&lt", "<p a='b"])
def test_short_way_through_tags(page):
    """Tags without attributes give the events of the standard library's tokenizer."""

    def events(short):
        class Told(markup._Builder if short else HTMLParser):
            def handle_starttag(self, tag, attrs):
                out.append(("start", tag, attrs))

            def handle_startendtag(self, tag, attrs):
                out.append(("start and end", tag, attrs))

            def handle_endtag(self, tag):
                out.append(("end", tag))

            def handle_data(self, data):
                out.append(("data", data))

        out = []
        t = Told() if short else Told(convert_charrefs=True)
        t.feed(page)
        t.close()
        return out

    assert events(True) == events(False)
