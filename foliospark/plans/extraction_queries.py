"""Queries over article extraction. Pages are made from rows of the tables by templates; the SQL puts the expected
records together from the same columns, without a page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.functions import identity as ids
from foliospark.operators.extraction import extract_articles
from foliospark.sources.tables import spread, table

#: Parts whose pages one task makes and extracts, about. Files of such rows are small, so by their bytes few tasks would do it all.
PARTS_A_TASK = 2500

HEAD = '<meta name="article.id" content=" P{p_partkey} "><meta name="article.published" content="2024-01-15T05:01:00Z">'


def filled(template: str, *columns: str) -> Column:
    """The template with each {column} replaced by the row's value."""
    parts: list[Column] = []
    while template:
        at, name = min(((i, c) for c in columns if (i := template.find("{" + c + "}")) >= 0), default=(len(template), ""))
        parts.append(F.lit(template[:at]))
        if name:
            parts.append(F.col(name).cast("string"))
        template = template[at + len(name) + 2 :]
    return F.concat(*parts)


def page(head: Column | str, body: Column | str) -> Column:
    lit = lambda x: F.lit(x) if isinstance(x, str) else x
    return F.concat(F.lit("<!doctype html><html><head>"), lit(head), F.lit("</head><body>"), lit(body), F.lit("</body></html>"))


def choose(selector: Column, cases: list[Column | str]) -> Column:
    """The case of number `selector`."""
    out = F.when(selector == 0, cases[0])
    for k, c in enumerate(cases[1:], 1):
        out = out.when(selector == k, c)
    return out


PART = ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")

BODY = """<article><header><h1>{p_name} *{p_brand}*</h1><p class="article-dek">About {p_type}</p></header>
<p class="byline">By {p_brand} Desk, {p_type} Desk and Others</p>
<div class="story"><p>Size  {p_size},<br>see <a href="../q?n={p_partkey}&amp;x=a b">the <i>price</i></a> [{p_retailprice}].</p>
<h3>About {p_type}s</h3>
<ul><li>{p_name}<ul><li>{p_brand}</li></ul></li><li> </li><li>last<p>more</p></li></ul>
<ol><li></li><li>{p_size}</li></ol>
<table><tr><th>brand<th>size</tr><tr><td>{p_brand}</td></tr></table>
<blockquote><p>{p_name}</p><p>- {p_size}</p></blockquote>
<figure><img src="" data-src="/i/{p_partkey}.jpg" alt="{p_brand} [x]"><figcaption>Photo of {p_name}</figcaption></figure>
<p><img src="/i/{p_partkey}.jpg">{p_size}. done</p>
<div>before<p>{p_size}. within</p>after</div></div></article>"""


def rendered_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Every kind of block in one page per part."""
    p = spread(table(spark, sf, "part").select(*PART), PARTS_A_TASK)
    head = filled(HEAD + '<link rel="alternate Canonical" href="HTTPS://Parts.Example:443/p/{p_partkey}/?b=2&amp;a=1#x">', *PART)
    pages = p.select(F.col("p_partkey").cast("string").alias("source_html_path"), page(head, filled(BODY, *PART)).alias("html"))
    x = extract_articles(pages)
    return x.select("source_html_path", "article_id", "canonical_url", "markdown_text", "editorial_character_count", "editorial_block_count", "metadata_completeness", F.array_join("inline_image_urls", " ").alias("images"), F.array_join("warnings", ",").alias("warnings"), F.col("publication_date_new_york").alias("day"))


def metadata_chains(spark: SparkSession, sf: str) -> DataFrame:
    """Which source gives headline, description, authors and dates: by case of the customer, meta elements, structured data, or what is shown."""
    names = ("c_custkey", "c_name", "c_mktsegment")
    meta = '<meta name="article.headline" content="{c_name} in meta"><meta property="article.subtitle" content="Sub"><meta name="description" content="Seg {c_mktsegment}"><meta name="author" content="A {c_custkey} | B"><meta itemprop="datePublished" content="2024-07-15T04:01:00+00:00"><meta name="dateModified" content="2024-07-16T00:00:00-04:00"><meta name="article.headline" content="second">'
    ld = '<script type="application/ld+json">{broken</script><script type="application/ld+json">[{"@type":"WebPage","headline":"no"},{"@graph":[{"@type":["Thing","NewsArticle"],"headline":"{c_name} in data","description":"Seg {c_mktsegment}","author":[{"name":"C {c_custkey}"},{"name":" "},{"name":"D"}],"datePublished":"2024-01-01T02:30:00z","dateModified":"soon"}]}]</script>'
    dom = '<meta name="datePublished" content="20240115T045900Z"><meta name="dateModified" content="2024-01-15T04:59:00">'
    shown = '<header class="top"><h1>{c_name} shown</h1><p class="dek">Seg {c_mktsegment}</p></header><div id="byline">BY E {c_custkey} and F</div><section class="body"><h1>no</h1><p class="summary">no</p></section><p>T</p>'
    c = table(spark, sf, "customer").select(*names)
    kind = F.pmod("c_custkey", F.lit(4))
    head = choose(kind, [filled(meta, *names), filled(meta + ld, *names), filled(ld, *names), filled(dom, *names)])
    x = extract_articles(c.select(F.col("c_custkey").cast("string").alias("source_html_path"), page(head, F.concat(F.lit("<article>"), filled(shown, *names), F.lit("</article>"))).alias("html")))
    return x.select("source_html_path", "markdown_text", F.unix_micros("published_at_utc").alias("published_us"), F.unix_micros("updated_at_utc").alias("updated_us"), "metadata_completeness", F.array_join("warnings", ",").alias("warnings"), F.col("publication_date_new_york").alias("day"))


HIDDEN = [
    "<nav>{s_name}</nav>", "<p hidden>{s_name}</p>", "<p aria-hidden=TRUE>{s_name}</p>", "<p style='color:red; display : none'>{s_name}</p>", "<p style='visibility:hidden'>{s_name}</p>", "<div class='slot ad-top'><p>{s_name}</p></div>", "<section data-testid='share-bar'>{s_name}</section>", "<div role=navigation>{s_name}</div>",
    "<script>{s_name}</script>", "<noscript>{s_name}</noscript>", "<div id=related_items><ul><li>{s_name}</li></ul></div>", "<p data-inset_type='promo'>{s_name}</p>", "<h1>{s_name}</h1>", "<p class='article__byline'>{s_name}</p>", "<button>{s_name}</button>", "<iframe>{s_name}</iframe>",
]
SHOWN = ["<p class='shared adverts'>{s_name}</p>", "<p style='display:block'>{s_name}</p>", "<p aria-hidden=false>{s_name}</p>", "<p><span>{s_name}</span></p>"]


def excluded_parts(spark: SparkSession, sf: str) -> DataFrame:
    """What does not belong to the text, one rule per supplier in turn, within an article, a body, or neither."""
    s = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    kinds = [filled(k, "s_name") for k in HIDDEN + SHOWN]
    part = choose(F.pmod("s_suppkey", F.lit(len(kinds))), kinds)
    roots = [("<div>outside</div><article>", "</article><article><p>second</p></article>"), ("<div>", "</div>")]
    around = F.pmod(F.floor(F.col("s_suppkey") / len(kinds)), F.lit(2))
    inner = F.concat(F.lit("<p>first</p>"), part, F.lit("<p>last</p>"))
    body = choose(around, [F.concat(F.lit(a), inner, F.lit(b)) for a, b in roots])
    x = extract_articles(s.select(F.col("s_suppkey").cast("string").alias("source_html_path"), page('<meta name="article.published" content="2024-01-15T05:01:00Z">', body).alias("html")))
    return x.select("source_html_path", "markdown_text", "editorial_block_count", "metadata_completeness")


def parsed_times(spark: SparkSession, sf: str) -> DataFrame:
    """Publication times in several spellings, zones and defects, and their New York days."""
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("at"))
    day, hour = F.date_format("at", "yyyy-MM-dd"), F.format_string("%02d", F.pmod("o_orderkey", F.lit(24)))
    stamp = lambda zone: F.concat(day, F.lit("T"), hour, F.lit(":30:00" + zone))
    text = choose(F.pmod("o_orderkey", F.lit(7)), [stamp("Z"), stamp("+05:30"), stamp("-04:00"), stamp(""), F.concat(day, F.lit(" at noon")), F.lit("  "), F.concat(F.lit(" "), stamp("z"), F.lit(" "))])
    x = extract_articles(o.select(F.col("o_orderkey").cast("string").alias("source_html_path"), page(F.concat(F.lit('<meta name="article.published" content="'), text, F.lit('">')), "<article><p>x</p></article>").alias("html")))
    return x.select("source_html_path", F.unix_micros("published_at_utc").alias("published_us"), F.col("publication_date_new_york").alias("day"), "error_code", F.col("markdown_text").isNotNull().alias("extracted"))


LINES = ["# {p_name}", "####### {p_name}", "#{p_name}", ">> {p_name}", ">", "+ {p_name}", "-{p_name}", "{p_size}. {p_name}", "{p_size}) {p_name}", "{p_size}.{p_name}", "-----", "~~~~", "--", "`{p_name}` | {p_brand}_x", "{p_name}"]


def escaped_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Paragraphs that look like Markdown blocks, one spelling per part in turn."""
    p = table(spark, sf, "part").select(*PART)
    text = choose(F.pmod("p_partkey", F.lit(len(LINES))), [filled(x, *PART) for x in LINES])
    text = F.replace(F.replace(text, F.lit(">"), F.lit("&gt;")), F.lit("`"), F.lit("&#96;"))
    pages = p.select(F.col("p_partkey").cast("string").alias("source_html_path"), page(filled(HEAD, "p_partkey"), F.concat(F.lit("<article><p>"), text, F.lit("</p></article>"))).alias("html"))
    return extract_articles(pages).select("source_html_path", "markdown_text")


HREFS = ["x/{p_partkey}", "/x?q={p_name}", "//other.example:80/x", "HTTP://Other.Example:80/{p_size}", "http://other.example:8080/é", "mailto:a@b", "", "http://h:port/", "#part-{p_partkey}", "../{p_partkey}.html"]


def resolved_links(spark: SparkSession, sf: str) -> DataFrame:
    """Links of every kind, with and without a canonical address to start from."""
    p = table(spark, sf, "part").select(*PART)
    href = choose(F.pmod("p_partkey", F.lit(len(HREFS))), [filled(h, *PART) for h in HREFS])
    based = F.pmod(F.floor(F.col("p_partkey") / len(HREFS)), F.lit(2)) == 0
    head = F.concat(filled(HEAD, "p_partkey"), F.when(based, '<link rel=canonical href="http://base.example/a/b/">').otherwise(""))
    pages = p.select(F.col("p_partkey").cast("string").alias("source_html_path"), page(head, F.concat(F.lit('<article><p><a href="'), href, F.lit('">label</a></p></article>'))).alias("html"))
    return extract_articles(pages).select("source_html_path", "markdown_text")


def own_identities(spark: SparkSession, sf: str) -> DataFrame:
    """Identities of pages with an id, with a canonical address only, and with neither."""
    p = table(spark, sf, "part").select(*PART)
    time = '<meta name="article.published" content="2024-01-15T05:01:00Z">'
    heads = [filled(HEAD, "p_partkey"), filled(time + '<link rel=canonical href="Https://A.example:443/{p_partkey}//?z=1&amp;a=&amp;k=x+y#f">', "p_partkey"), filled(time + "<!-- {p_partkey} -->", "p_partkey"), filled(time + '<meta name="article.id" content="  "><link rel=canonical href="http://a.example:81/{p_partkey}">', "p_partkey")]
    pages = p.select(F.col("p_partkey").cast("string").alias("source_html_path"), page(choose(F.pmod("p_partkey", F.lit(4)), heads), "<p>x</p>").alias("html"))
    return extract_articles(pages).select("source_html_path", "article_id", "source_html_sha256", ids.markdown_path(F.col("article_id"), F.col("publication_date_new_york")).alias("cleaned_markdown_path"))


def page_extraction(spark: SparkSession, sf: str) -> DataFrame:
    """Extraction over the raw pages, each with the publication time and id of its candidate put into its head."""
    c = table(spark, sf, "candidates").filter("source_html_path is not null").groupBy("source_html_path").agg(F.min_by(F.struct("article_id", "published_at_utc"), F.struct("article_id", "published_at_utc")).alias("c"))
    pages = table(spark, sf, "source_pages").filter("html is not null").groupBy("source_html_path").agg(F.max_by("html", F.struct("fetched_at", "html")).alias("html"))
    head = F.concat(F.lit("<meta name='article.id' content='"), F.coalesce("c.article_id", F.lit("")), F.lit("'><meta name='article.published' content='"), F.date_format("c.published_at_utc", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit("'>"))
    timed = pages.join(c, "source_html_path", "left").select("source_html_path", F.concat(F.coalesce(head, F.lit("")), "html").alias("html"))
    x = extract_articles(timed)
    return x.select("source_html_path", "article_id", "published_at_utc", F.sha2("markdown_text", 256).alias("markdown_sha256"), "editorial_character_count", "editorial_block_count", "error_code")


QUERIES = {f.__name__: f for f in (rendered_pages, metadata_chains, excluded_parts, parsed_times, escaped_lines, resolved_links, own_identities, page_extraction)}

ORACLE = {
    "rendered_pages": r"""WITH p AS (SELECT *, p_partkey::varchar AS k, p_retailprice::varchar AS price, chr(10) AS nl FROM part),
t AS (SELECT k, array_to_string(['# ' || p_name || ' \*' || p_brand || '\*', 'About ' || p_type, 'By ' || p_brand || ' Desk, ' || p_type || ' Desk and Others',
  'Size ' || p_size || ', see [the price](https://parts.example/q?n=' || k || '&x=a%20b) \[' || price || '\].', '### About ' || p_type || 's', '- ' || p_name || nl || '  - ' || p_brand || nl || '- last' || nl || '  more', '2. ' || p_size,
  '| brand | size |' || nl || '| --- | --- |' || nl || '| ' || p_brand || ' |  |', '> ' || p_name || nl || '>' || nl || '> \- ' || p_size, '![' || p_brand || ' \[x\]](https://parts.example/i/' || k || '.jpg)', 'Photo of ' || p_name,
  p_size || '\. done', 'before', p_size || '\. within', 'after'], chr(10) || chr(10)) AS md FROM p)
SELECT k AS source_html_path, 'id:P' || k AS article_id, 'https://parts.example/p/' || k || '?a=1&b=2' AS canonical_url, md AS markdown_text, length(md)::bigint AS editorial_character_count, 15 AS editorial_block_count, 6 AS metadata_completeness,
  'https://parts.example/i/' || k || '.jpg' AS images, '' AS warnings, DATE '2024-01-15' AS day FROM t""",
    "metadata_chains": r"""WITH c AS (SELECT c_custkey::varchar AS k, c_custkey % 4 AS kind, c_name, 'Seg ' || c_mktsegment AS seg, chr(10) || chr(10) AS gap FROM customer)
SELECT k AS source_html_path, '# ' || c_name || CASE WHEN kind <= 1 THEN ' in meta' || gap || 'Sub' WHEN kind = 2 THEN ' in data' ELSE ' shown' END || gap || seg || gap
  || CASE WHEN kind <= 1 THEN 'By A ' || k || ' and B' WHEN kind = 2 THEN 'By C ' || k || ' and D' ELSE 'By E ' || k || ' and F' END || gap || 'T' AS markdown_text,
  epoch_us(CASE WHEN kind <= 1 THEN TIMESTAMP '2024-07-15 04:01:00' WHEN kind = 2 THEN TIMESTAMP '2024-01-01 02:30:00' ELSE TIMESTAMP '2024-01-15 04:59:00' END) AS published_us,
  CASE WHEN kind <= 1 THEN epoch_us(TIMESTAMP '2024-07-16 04:00:00') END AS updated_us, CASE WHEN kind <= 1 THEN 6 ELSE 4 END AS metadata_completeness, CASE WHEN kind <= 1 THEN '' ELSE 'invalid_optional_update' END AS warnings,
  CASE WHEN kind <= 1 THEN DATE '2024-07-15' WHEN kind = 2 THEN DATE '2023-12-31' ELSE DATE '2024-01-14' END AS day FROM c""",
    "excluded_parts": r"""WITH s AS (SELECT s_suppkey::varchar AS k, s_name, s_suppkey % 20 AS kind, (s_suppkey // 20) % 2 = 0 AS article, chr(10) || chr(10) AS gap FROM supplier)
SELECT k AS source_html_path, CASE WHEN article AND kind = 12 THEN '# ' || s_name || gap WHEN article AND kind = 13 THEN 'By ' || s_name || gap ELSE '' END || 'first' || gap || CASE WHEN kind >= 16 THEN s_name || gap ELSE '' END || 'last' AS markdown_text,
  CASE WHEN kind >= 16 OR (article AND kind IN (12, 13)) THEN 3 ELSE 2 END AS editorial_block_count, CASE WHEN article AND kind IN (12, 13) THEN 2 ELSE 1 END AS metadata_completeness FROM s""",
    "parsed_times": r"""WITH o AS (SELECT o_orderkey::varchar AS k, o_orderkey % 7 AS kind, CAST(o_orderdate AS date)::timestamp + to_hours((o_orderkey % 24)::int) + INTERVAL 30 MINUTE AS wall FROM orders),
t AS (SELECT k, kind, CASE kind WHEN 0 THEN wall WHEN 6 THEN wall WHEN 1 THEN wall - INTERVAL 330 MINUTE WHEN 2 THEN wall + INTERVAL 4 HOUR END AS utc FROM o)
SELECT k AS source_html_path, epoch_us(utc) AS published_us, CAST((utc AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS date) AS day, CASE kind WHEN 3 THEN 'naive_timestamp' WHEN 4 THEN 'invalid_timestamp' WHEN 5 THEN 'missing_publication_timestamp' END AS error_code, kind NOT IN (3, 4, 5) AS extracted FROM t""",
    "escaped_lines": r"""SELECT p_partkey::varchar AS source_html_path, CASE p_partkey % 15 WHEN 0 THEN '\# ' || p_name WHEN 1 THEN '####### ' || p_name WHEN 2 THEN '#' || p_name WHEN 3 THEN '\>> ' || p_name WHEN 4 THEN '\>' WHEN 5 THEN '\+ ' || p_name WHEN 6 THEN '-' || p_name
  WHEN 7 THEN p_size || '\. ' || p_name WHEN 8 THEN p_size || '\) ' || p_name WHEN 9 THEN p_size || '.' || p_name WHEN 10 THEN '\-----' WHEN 11 THEN '\~~~~' WHEN 12 THEN '--' WHEN 13 THEN '\`' || p_name || '\` \| ' || p_brand || '\_x' ELSE p_name END AS markdown_text FROM part""",
    "resolved_links": r"""WITH p AS (SELECT p_partkey::varchar AS k, p_partkey % 10 AS kind, (p_partkey // 10) % 2 = 0 AS based, p_name, p_size FROM part),
u AS (SELECT k, CASE WHEN kind = 3 THEN 'http://other.example/' || p_size WHEN kind = 4 THEN 'http://other.example:8080/%C3%A9' WHEN NOT based THEN NULL WHEN kind = 0 THEN 'http://base.example/a/x/' || k WHEN kind = 1 THEN 'http://base.example/x?q=' || replace(p_name, ' ', '%20')
  WHEN kind = 2 THEN 'http://other.example/x' WHEN kind = 8 THEN 'http://base.example/a/b#part-' || k WHEN kind = 9 THEN 'http://base.example/' || k || '.html' END AS url FROM p)
SELECT k AS source_html_path, CASE WHEN url IS NULL THEN 'label' ELSE '[label](' || url || ')' END AS markdown_text FROM u""",
    "own_identities": r"""WITH p AS (SELECT p_partkey::varchar AS k, p_partkey % 4 AS kind, '<meta name="article.published" content="2024-01-15T05:01:00Z">' AS time FROM part),
h AS (SELECT k, kind, '<!doctype html><html><head>' || CASE kind WHEN 0 THEN '<meta name="article.id" content=" P' || k || ' ">' || time WHEN 1 THEN time || '<link rel=canonical href="Https://A.example:443/' || k || '//?z=1&amp;a=&amp;k=x+y#f">' WHEN 2 THEN time || '<!-- ' || k || ' -->'
  ELSE time || '<meta name="article.id" content="  "><link rel=canonical href="http://a.example:81/' || k || '">' END || '</head><body><p>x</p></body></html>' AS html FROM p),
i AS (SELECT k, sha256(html) AS d, CASE kind WHEN 0 THEN 'id:P' || k WHEN 1 THEN 'url:' || sha256('https://a.example/' || k || '?a=&k=x+y&z=1') WHEN 2 THEN 'html:' || sha256(html) ELSE 'url:' || sha256('http://a.example:81/' || k) END AS id FROM h)
SELECT k AS source_html_path, id AS article_id, d AS source_html_sha256, 'text/2024/01/15/' || sha256(id) || '.md' AS cleaned_markdown_path FROM i""",
}
