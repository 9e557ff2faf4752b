"""Queries of the training-data operators and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm import encode, mixing, neighbours, spans, splitting, wrappers
from foliospark.llm import survivorship as sur
from foliospark.sources.files import Folder
from foliospark.sources.tables import new_folder, table


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return wrappers.main_blocks(table(spark, sf, "source_pages"))


def p1_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Of each candidate with a page: the blocks found and the block count stored with it."""
    found = p1_found(spark, sf).groupBy(F.col("source_html_path").alias("page")).agg(F.count("*").alias("found_blocks"))
    pages = table(spark, sf, "source_pages").select(F.col("source_html_path").alias("page")).distinct()
    stored = table(spark, sf, "candidates").groupBy("source_html_path").agg(F.max("editorial_block_count").alias("stored_blocks"))
    joined = stored.join(pages, F.col("source_html_path") == F.col("page")).join(found, "page", "left")
    return joined.select("source_html_path", "stored_blocks", F.coalesce("found_blocks", F.lit(0)).alias("found_blocks"))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return sur.sources_by_field(table(spark, sf, "candidates"), table(spark, sf, "runs"))


def p3_records(spark: SparkSession, sf: str) -> DataFrame:
    return sur.surviving_records(table(spark, sf, "candidates"), table(spark, sf, "runs"))


def p3_stored_ranks(spark: SparkSession, sf: str) -> DataFrame:
    """Stored duplicates whose recorded winner is not the surviving record's source."""
    best = sur.choose(sur.prepare(table(spark, sf, "candidates"), table(spark, sf, "runs")), least_sources=1).select(F.col("article_id").alias("best_article"), F.col("record"))
    d = table(spark, sf, "duplicates").select("article_id", "source_html_path", "duplicate_rank", "winner_source_html_path")
    wrong = ~F.col("winner_source_html_path").eqNullSafe(F.col("record"))
    return d.join(best, F.col("article_id") == F.col("best_article")).filter(wrong).select("article_id", "source_html_path", "duplicate_rank", "winner_source_html_path", F.col("record").alias("expected_winner"))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return neighbours.neighbour_pairs(table(spark, sf, "embedding_storage"), table(spark, sf, "embedding_configurations"))


def p4_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    """The five nearest articles of each article, with similarities to six digits."""
    found = neighbours.neighbours(table(spark, sf, "embedding_storage"), table(spark, sf, "embedding_configurations"))
    return found.withColumn("similarity", F.round("similarity", 6))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return splitting.split_texts(table(spark, sf, "documents")).select("doc_id", "part_index", "char_start", "char_end")


#: Bytes of the files that p5_files makes of the texts, about.
FILE_BYTES = 64 << 20


def p5_files(spark: SparkSession, sf: str) -> DataFrame:
    """All texts as files of one line after the other, in order of id, and the pieces of these files by their number."""
    texts = table(spark, sf, "documents").filter("text is not null").select("doc_id", "text")
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    folder = new_folder(spark, "texts")
    texts.repartition(max(8, size // FILE_BYTES), F.xxhash64("doc_id")).sortWithinPartitions("doc_id", "text").select(F.col("text").alias("value")).write.text(folder)
    names = [f"{folder}/{n}" for n in Folder(spark, folder).names() if n.startswith("part-")]
    number = F.regexp_extract("path", r"part-(\d+)", 1).cast("int").alias("file_no")
    return splitting.split_files(spark, names).select(number, "part_index", "char_start", "char_end")


def p6_ids(spark: SparkSession, sf: str) -> DataFrame:
    return encode.encode_corpus(table(spark, sf, "documents"))


#: The curriculum of the registered queries: the archive early, edited sources late, the rest evenly.
CURRICULUM = {"web_archive": [(0.0, 1.4), (0.7, 1.0), (1.0, 0.4)], "newsletter": [(0.0, 0.6), (1.0, 1.4)], "transcript": [(0.0, 0.8), (0.5, 0.8), (1.0, 1.6)]}


def p7_mixture(spark: SparkSession, sf: str) -> DataFrame:
    """Every copy of every document of the mixture with its training position."""
    return mixing.mixture(mixing.token_counts(table(spark, sf, "documents")), table(spark, sf, "mix_targets"), CURRICULUM)


def p7_shares(spark: SparkSession, sf: str) -> DataFrame:
    """The shares that the mixture reaches."""
    return mixing.reached_shares(p7_mixture(spark, sf), table(spark, sf, "mix_targets"))


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    return spans.shared_regions(table(spark, sf, "documents"))


def p8_shares(spark: SparkSession, sf: str) -> DataFrame:
    """How much of each document is shared elsewhere."""
    docs = table(spark, sf, "documents")
    return spans.shared_amounts(docs, spans.shared_regions(docs))


def p8_levels(spark: SparkSession, sf: str) -> DataFrame:
    """At 120 code points, twice that, and so on until nothing is shared: the documents, regions and code points concerned."""
    found = spans.levels(table(spark, sf, "documents"))
    return found.groupBy("length").agg(F.countDistinct("doc_id").alias("documents"), F.count("*").alias("regions"), F.sum(F.col("char_end") - F.col("char_start")).alias("shared_chars"))


QUERIES = {"p1_found": p1_found, "p1_counts": p1_counts, "p3_found": p3_found, "p3_records": p3_records, "p3_stored_ranks": p3_stored_ranks, "p4_found": p4_found, "p4_neighbours": p4_neighbours, "p5_found": p5_found, "p5_files": p5_files, "p6_ids": p6_ids, "p7_mixture": p7_mixture, "p7_shares": p7_shares, "p8_found": p8_found, "p8_shares": p8_shares, "p8_levels": p8_levels}

_RANKED = r"""
WITH lim AS (SELECT max(finished_at) AS latest FROM runs),
c AS (SELECT article_id, source_html_path, canonical_url, header_image_path, inline_image_urls, editorial_character_count, editorial_block_count, metadata_completeness,
        CASE WHEN NOT coalesce(updated_at_utc < published_at_utc, false) AND NOT coalesce(updated_at_utc > latest, false) THEN updated_at_utc END AS upd,
        len(list_distinct(inline_image_urls)) AS n_img
      FROM candidates, lim WHERE article_id IS NOT NULL AND source_html_path IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY CASE WHEN editorial_character_count > 0 THEN 0 ELSE 1 END,
        editorial_character_count DESC NULLS LAST, editorial_block_count DESC NULLS LAST, metadata_completeness DESC NULLS LAST, upd DESC NULLS LAST, source_html_path) AS rk FROM c)
"""

_NEAR = """WITH v AS (SELECT s.configuration_id, s.modality, s.article_id, s.vector AS x, sqrt(list_sum(list_transform(s.vector, lambda e: e::double * e::double))) AS n
  FROM embedding_storage s JOIN embedding_configurations c ON c.configuration_id = s.configuration_id AND len(s.vector) = c.dimensions
  WHERE s.modality IS NOT NULL AND s.article_id IS NOT NULL AND len(list_filter(s.vector, lambda e: e IS NULL OR NOT isfinite(e))) = 0 AND len(list_filter(s.vector, lambda e: e <> 0)) > 0),
p AS (SELECT a.configuration_id, a.modality, a.article_id, b.article_id AS neighbour_id, round(list_sum(list_transform(list_zip(a.x, b.x), lambda t: t[1]::double * t[2]::double)) / (a.n * b.n), 12) AS similarity
  FROM v a JOIN v b ON a.configuration_id = b.configuration_id AND a.modality = b.modality AND a.article_id <> b.article_id),
k AS (SELECT *, row_number() OVER (PARTITION BY configuration_id, modality, article_id ORDER BY similarity DESC, neighbour_id) AS rn FROM p WHERE similarity >= 0.8)
"""

_SHARED = """WITH w AS (SELECT doc_id, i, substring(text, (i + 1)::int, {length}) AS s FROM (SELECT doc_id, text, unnest(range(length(text) - ({length} - 1))) AS i FROM documents WHERE doc_id IS NOT NULL AND length(text) >= {length})),
repeated AS (SELECT s FROM w GROUP BY s HAVING min(doc_id) < max(doc_id)),
m AS (SELECT DISTINCT doc_id, i FROM w WHERE s IN (SELECT s FROM repeated)),
n AS (SELECT *, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + {length} THEN 0 ELSE 1 END AS new FROM m),
g AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS island FROM n),
regions AS (SELECT doc_id, min(i)::bigint AS char_start, (max(i) + {length})::bigint AS char_end FROM g GROUP BY doc_id, island)
"""

ORACLE: dict[str, str] = {
    "p3_found": _RANKED
    + r""", many AS (SELECT article_id FROM r GROUP BY article_id HAVING count(DISTINCT source_html_path) > 1),
f AS (
  SELECT article_id, 'record' AS field_name, source_html_path, rk FROM r
  UNION ALL SELECT article_id, 'canonical_url', source_html_path, rk FROM r WHERE regexp_matches(lower(canonical_url), '^https?://')
  UNION ALL SELECT article_id, 'header_image_path', source_html_path, rk FROM r WHERE regexp_matches(lower(header_image_path), '\.(jpg|jpeg|png|webp)$')
  UNION ALL SELECT article_id, 'updated_at_utc', source_html_path, row_number() OVER (PARTITION BY article_id ORDER BY upd DESC, rk) FROM r WHERE upd IS NOT NULL
  UNION ALL SELECT article_id, 'inline_image_urls', source_html_path, row_number() OVER (PARTITION BY article_id ORDER BY n_img DESC, rk) FROM r WHERE n_img > 0)
SELECT article_id, field_name, arg_min(source_html_path, rk) AS source_html_path FROM f WHERE article_id IN (SELECT article_id FROM many) GROUP BY article_id, field_name""",
    "p3_records": _RANKED
    + r"""SELECT article_id, count(*) AS rows, arg_min(source_html_path, rk) AS source_html_path,
  min(CASE WHEN rk = 1 THEN editorial_character_count END) AS editorial_character_count, min(CASE WHEN rk = 1 THEN editorial_block_count END) AS editorial_block_count, min(CASE WHEN rk = 1 THEN metadata_completeness END) AS metadata_completeness,
  arg_min(canonical_url, rk) FILTER (WHERE regexp_matches(lower(canonical_url), '^https?://')) AS canonical_url,
  arg_min(header_image_path, rk) FILTER (WHERE regexp_matches(lower(header_image_path), '\.(jpg|jpeg|png|webp)$')) AS header_image_path,
  coalesce(max(n_img), 0)::int AS inline_images, epoch_us(max(upd)) AS updated_us FROM r GROUP BY article_id""",
    "p3_stored_ranks": _RANKED
    + r""", best AS (SELECT article_id, source_html_path AS record FROM r WHERE rk = 1)
SELECT d.article_id, d.source_html_path, d.duplicate_rank, d.winner_source_html_path, b.record AS expected_winner FROM duplicates d JOIN best b ON b.article_id = d.article_id WHERE d.winner_source_html_path IS DISTINCT FROM b.record""",
    "p4_found": _NEAR + "SELECT DISTINCT configuration_id, modality, least(article_id, neighbour_id) AS article_id_a, greatest(article_id, neighbour_id) AS article_id_b FROM k WHERE rn <= 5",
    "p4_neighbours": _NEAR + "SELECT configuration_id, modality, article_id, neighbour_id, round(similarity, 6) AS similarity FROM k WHERE rn <= 5",
    "p5_found": r"""WITH RECURSIVE d AS MATERIALIZED (SELECT row_number() OVER () AS item, doc_id, text, length(text) AS n FROM documents WHERE length(text) > 2000),
w AS (SELECT '[ \t\r\n' || chr(160) || chr(12288) || ']+' AS blank),
pat AS (SELECT '(?:\r?\n[ \t]*){2,}' AS gap, '[.!?' || chr(8230) || '][' || chr(34) || chr(39) || chr(8221) || chr(8217) || chr(187) || ')\]]*' || blank AS sentence, blank FROM w),
hits AS (SELECT item, list_transform([gap, sentence, blank], lambda p: [list_transform(string_split_regex(text, p), lambda x: length(x)), list_transform(regexp_extract_all(text, p), lambda x: length(x))]) AS z FROM d, pat),
cells AS (SELECT item, kind, i, z[kind][1][i] + z[kind][2][i] AS step FROM hits, LATERAL (SELECT unnest([1, 2, 3]) AS kind) k, LATERAL (SELECT unnest(range(1, len(z[kind][2]) + 1)) AS i) r),
places AS (SELECT item, kind, sum(step) OVER (PARTITION BY item, kind ORDER BY i) AS p FROM cells),
k AS (SELECT d.item, d.doc_id, d.n, list(p) FILTER (WHERE kind = 1) AS gaps, list(p) FILTER (WHERE kind = 2) AS ends, list(p) FILTER (WHERE kind = 3 AND p < d.n) AS words FROM d LEFT JOIN places USING (item) GROUP BY ALL),
walk AS (SELECT item, -1 AS part_index, 0::bigint AS s, 0::bigint AS e, n AS n FROM k
UNION ALL SELECT x.item, x.part_index, x.s, CASE WHEN x.n - x.s <= 2000 THEN x.n ELSE coalesce(list_max(list_filter(x.gaps, lambda p: p > x.s + 200 AND p <= x.s + 2000)), list_max(list_filter(x.ends, lambda p: p > x.s + 200 AND p <= x.s + 2000)),
    list_max(list_filter(x.words, lambda p: p > x.s + 200 AND p <= x.s + 2000)), x.s + 2000)::bigint END, x.n
  FROM (SELECT k.*, walk.part_index + 1 AS part_index, CASE WHEN walk.part_index < 0 THEN 0 ELSE coalesce(list_min(list_filter(k.words, lambda p: p >= walk.e - 200 AND p < walk.e)), walk.e - 200)::bigint END AS s FROM walk JOIN k USING (item) WHERE walk.e < walk.n) x)
SELECT doc_id, part_index::bigint AS part_index, s AS char_start, e AS char_end FROM walk JOIN d USING (item) WHERE part_index >= 0""",
    "p8_found": _SHARED.format(length=120) + "SELECT doc_id, char_start, char_end FROM regions",
    "p8_shares": _SHARED.format(length=120)
    + "SELECT d.doc_id, max(coalesce(length(text), 0))::bigint AS n_chars, coalesce(max(s.chars), 0)::bigint AS shared_chars, CASE WHEN max(coalesce(length(text), 0)) > 0 THEN coalesce(max(s.chars), 0) / max(coalesce(length(text), 0)) ELSE 0.0::double END AS share FROM documents d LEFT JOIN (SELECT doc_id, sum(char_end - char_start) AS chars FROM regions GROUP BY 1) s USING (doc_id) WHERE doc_id IS NOT NULL GROUP BY 1",
}
