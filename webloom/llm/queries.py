"""Queries of the training-data problems and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm import boilerplate, capping, encoding, language, mixing, neighbours, packing, reading, repeats, residue, tokens
from webloom.session import materialize
from webloom.sources.tables import load


def p1_found(spark: SparkSession, root: str) -> DataFrame:
    return residue.find_residue(load(spark, root, "pages", "page_id", "content"), "page_id").select("page_id")


def p1_kept(spark: SparkSession, root: str) -> DataFrame:
    return residue.without_residue(load(spark, root, "pages", "page_id", "content"), "page_id")


def _bodies(spark: SparkSession, root: str) -> DataFrame:
    pages = load(spark, root, "pages", F.lit("page").alias("record_kind"), F.col("page_id").alias("record_id"), F.col("content").alias("body"))
    fetched = load(spark, root, "fetch_results", F.lit("fetch").alias("record_kind"), F.col("fetch_id").alias("record_id"), F.col("html").alias("body"))
    return pages.unionByName(fetched).where(F.col("body").isNotNull())


def _pair_model(spark: SparkSession, root: str) -> encoding.PairModel:
    """The one model of problems 2 and 4: both name the same misread pages."""
    return encoding.fit_pairs(_bodies(spark, root).select("body"))


def _misread(spark: SparkSession, root: str) -> DataFrame:
    both, model = _bodies(spark, root), _pair_model(spark, root)
    keyed = both.select(F.struct("record_kind", "record_id").alias("key"), "body")
    return encoding.restore(keyed, "key", "body", model)


def p2_found(spark: SparkSession, root: str) -> DataFrame:
    return _misread(spark, root).select("key.record_kind", "key.record_id")


def p2_restored(spark: SparkSession, root: str) -> DataFrame:
    return _misread(spark, root).select("key.record_kind", "key.record_id", "restored", "fixed", "lost")


def _site_pages(spark: SparkSession, root: str) -> DataFrame:
    pages = load(spark, root, "pages", "page_id", "url_id", "content").where(F.col("content").isNotNull())
    return pages.join(load(spark, root, "urls", "url_id", "domain"), "url_id")


def p3_found(spark: SparkSession, root: str) -> DataFrame:
    return repeats.find_repeated_lines(_site_pages(spark, root), "domain", "url_id", "page_id")


def p3_cleaned(spark: SparkSession, root: str) -> DataFrame:
    return repeats.remove_repeated_lines(load(spark, root, "pages", "page_id", "content"), p3_found(spark, root), "page_id")


def p3_sequences(spark: SparkSession, root: str) -> DataFrame:
    found = repeats.frequent_sequences(_site_pages(spark, root), "domain", "url_id", "page_id")
    return found.select(F.col("source").alias("domain"), F.to_json("pattern").alias("pattern"), F.size("pattern").alias("length"), "support")


P3_FOUND = r"""
WITH d AS (
  SELECT p.page_id, p.url_id, u.domain, p.content FROM pages p JOIN urls u ON u.url_id = p.url_id
  WHERE p.content IS NOT NULL AND u.domain IS NOT NULL
), parts AS (SELECT page_id, url_id, domain, string_split(content, chr(10)) AS a FROM d),
l AS (SELECT page_id, url_id, domain, unnest(a) AS t, unnest(range(len(a))) AS line_no FROM parts),
n AS (
  SELECT page_id, url_id, domain, line_no,
    regexp_replace(lower(regexp_replace(regexp_replace(t, '[ \t]+', ' ', 'g'), '^ +| +$', '', 'g')), '[0-9]+', '0', 'g') AS t FROM l
), s AS (SELECT domain, t, count(DISTINCT url_id) AS c FROM n WHERE t <> '' GROUP BY domain, t),
o AS (SELECT domain, count(DISTINCT url_id) AS c FROM d GROUP BY domain)
SELECT n.page_id, CAST(n.line_no AS BIGINT) AS line_no FROM n
JOIN s ON s.domain = n.domain AND s.t = n.t JOIN o ON o.domain = n.domain
WHERE s.c >= 4 AND 10 * s.c >= o.c
"""


def _cap_candidates(spark: SparkSession, root: str) -> DataFrame:
    pages = load(spark, root, "pages", "page_id", "url_id", F.col("content").isNotNull().alias("has"), "fetched_at", "passes_quality_gate", "quality_score").where("has")
    latest = pages.groupBy("url_id").agg(
        F.max_by(F.struct("page_id", "passes_quality_gate", "quality_score", "fetched_at"), F.struct(F.col("fetched_at").isNotNull(), "fetched_at", -F.col("page_id"))).alias("p")
    )
    rows = latest.select("url_id", "p.*").where("passes_quality_gate")
    return rows.join(load(spark, root, "urls", "url_id", "domain"), "url_id")


def _cap(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    order = [F.col("quality_score").desc_nulls_last(), F.col("fetched_at").desc_nulls_last(), F.col("page_id").asc()]
    return capping.cap_contributors(_cap_candidates(spark, root), "domain", order, max_share=1 / 50)


def p6_found(spark: SparkSession, root: str) -> DataFrame:
    return _cap(spark, root)[1].select("page_id")


def p6_kept(spark: SparkSession, root: str) -> DataFrame:
    return _cap(spark, root)[0].select("page_id", "domain", "position")


P6_RANKED = """
WITH latest AS (
  SELECT p.*, row_number() OVER (PARTITION BY url_id ORDER BY fetched_at DESC NULLS LAST, page_id) AS k FROM pages p WHERE content IS NOT NULL
), c AS (
  SELECT l.page_id, u.domain, l.quality_score, l.fetched_at FROM latest l JOIN urls u ON u.url_id = l.url_id WHERE k = 1 AND passes_quality_gate
), r AS (
  SELECT page_id, domain, row_number() OVER (PARTITION BY domain ORDER BY quality_score DESC NULLS LAST, fetched_at DESC NULLS LAST, page_id) AS position,
    greatest(count(*) OVER () // 50, 1) AS n FROM c
)
"""
P6_FOUND = P6_RANKED + "SELECT page_id FROM r WHERE position > n"
P6_KEPT = P6_RANKED + "SELECT page_id, domain, CAST(position AS BIGINT) AS position FROM r WHERE position <= n"

def _languages(spark: SparkSession, root: str) -> DataFrame:
    pages = load(spark, root, "pages", "page_id", "lang", "content").where(F.col("content").isNotNull())
    documents = load(spark, root, "documents", "doc_id", "lang", "text")
    net = language.fit_network([(documents, "doc_id", "lang", "text"), (pages, "page_id", "lang", "content")])
    misread = encoding.misread_test(pages, _pair_model(spark, root))

    def skip():
        garbled = misread()
        return lambda text: residue.inspect(text)[0] is not None or garbled(text)

    return language.label_languages(pages, "page_id", "lang", "content", net, skip)


def p4_found(spark: SparkSession, root: str) -> DataFrame:
    wrong = F.when(F.col("label_wrong"), F.array(F.struct(F.lit(-1).cast("long").alias("line_no"), "lang", "confidence"))).otherwise(F.array().cast("array<struct<line_no: long, lang: string, confidence: double>>"))
    rows = _languages(spark, root).where("lang is not null").select("page_id", F.explode(F.concat(wrong, "segments")).alias("s"))
    return rows.select("page_id", "s.line_no", "s.lang")


def p4_labels(spark: SparkSession, root: str) -> DataFrame:
    return _languages(spark, root).select("page_id", "lang", "confidence", "label_wrong", F.to_json("segments").alias("segments"))


def p5_found(spark: SparkSession, root: str) -> DataFrame:
    found = neighbours.nearest(load(spark, root, "chunks", "chunk_id", "embedding_vector"), "chunk_id", "embedding_vector")
    return neighbours.neighbour_pairs(found).select(F.col("id_a").alias("chunk_id_a"), F.col("id_b").alias("chunk_id_b"))


def p7_found(spark: SparkSession, root: str) -> DataFrame:
    pages = load(spark, root, "pages", "page_id", "fetch_id", "content")
    fetched = load(spark, root, "fetch_results", "fetch_id", "html")
    return boilerplate.find_boilerplate(pages, fetched, "page_id", "fetch_id")


def p7_main_body(spark: SparkSession, root: str) -> DataFrame:
    pages = load(spark, root, "pages", "page_id", "fetch_id", "content")
    return boilerplate.main_body(pages, load(spark, root, "fetch_results", "fetch_id", "html"), "page_id", "fetch_id")


def _containers(spark: SparkSession, root: str) -> dict[str, int]:
    rows = load(spark, root, "containers", "container_kind", "capacity_tokens").where("container_kind is not null and capacity_tokens > 0")
    return {r[0]: r[1] for r in rows.collect()}


def p8_packed(spark: SparkSession, root: str) -> DataFrame:
    sizes = materialize(tokens.token_sizes(load(spark, root, "documents", "doc_id", "text"), "doc_id", "text"), "sizes")
    return packing.pack(sizes, "doc_id", "tokens", _containers(spark, root))


def p8_fill(spark: SparkSession, root: str) -> DataFrame:
    return packing.fill_report(p8_packed(spark, root), _containers(spark, root))


def _targets(spark: SparkSession, root: str) -> dict[str, tuple[float, int]]:
    rows = load(spark, root, "mix_targets", "source", "target_share", "max_repeats").where("source is not null").collect()
    return {r[0]: (r[1], r[2]) for r in rows}


def p9_mixed(spark: SparkSession, root: str) -> DataFrame:
    sizes = materialize(tokens.token_sizes(load(spark, root, "documents", "doc_id", "text", "source"), "doc_id", "text", "source"), "sizes")
    return mixing.mix(sizes, "doc_id", "source", "tokens", _targets(spark, root))


def p9_shares(spark: SparkSession, root: str) -> DataFrame:
    return mixing.share_report(p9_mixed(spark, root), _targets(spark, root), "doc_id")


def p10_found(spark: SparkSession, root: str) -> DataFrame:
    model = reading.fit_reading(load(spark, root, "level_anchors", "reading_level", "text"), "reading_level", "text")
    return reading.reading_levels(load(spark, root, "documents", "doc_id", "text"), "doc_id", "text", model).select("doc_id", "reading_level")


def p10_profile(spark: SparkSession, root: str) -> DataFrame:
    levels = p10_found(spark, root)
    return levels.join(load(spark, root, "documents", "doc_id", "source"), "doc_id").groupBy("source", "reading_level").agg(F.count("*").alias("texts"))


QUERIES = {
    "p1_found": p1_found,
    "p1_kept": p1_kept,
    "p2_found": p2_found,
    "p2_restored": p2_restored,
    "p3_found": p3_found,
    "p3_cleaned": p3_cleaned,
    "p3_sequences": p3_sequences,
    "p4_found": p4_found,
    "p4_labels": p4_labels,
    "p5_found": p5_found,
    "p6_found": p6_found,
    "p6_kept": p6_kept,
    "p7_found": p7_found,
    "p7_main_body": p7_main_body,
    "p8_packed": p8_packed,
    "p8_fill": p8_fill,
    "p9_mixed": p9_mixed,
    "p9_shares": p9_shares,
    "p10_found": p10_found,
    "p10_profile": p10_profile,
}
ORACLE: dict[str, str] = {"p3_found": P3_FOUND, "p6_found": P6_FOUND, "p6_kept": P6_KEPT}
