"""Explicit schemas of the persistent tables; readers never infer."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, BooleanType, FloatType, IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType

_TYPES = {
    "long": LongType(), "int": IntegerType(), "string": StringType(), "boolean": BooleanType(), "float": FloatType(), "timestamp": TimestampNTZType(),
    "array<string>": ArrayType(StringType()), "array<float>": ArrayType(FloatType()),
}


def _schema(text: str) -> StructType:
    """A schema from ``name type`` pairs, without a session."""
    return StructType([StructField(name, _TYPES[kind]) for name, kind in (pair.split() for pair in text.split(", "))])


URLS = _schema("url_id long, url string, url_hash string, domain string, depth int, status string, discovered_at timestamp, last_crawled_at timestamp")
FETCH_RESULTS = _schema(
    "fetch_id long, url_id long, url string, status_code int, html string, network_error boolean, error_message string, proxy_used string, content_length long, fetched_at timestamp"
)
PAGES = _schema(
    "page_id long, url_id long, fetch_id long, status_code int, title string, description string, h1 string, author string, content string, excerpt string, word_count int, "
    "reading_time int, lang string, quality_score int, quality_length_score int, quality_density_score int, quality_readability_score int, quality_structure_score int, "
    "quality_uniqueness_score int, quality_freshness_score int, content_type string, quality_flags array<string>, passes_quality_gate boolean, published_at timestamp, "
    "modified_at timestamp, og_image string, rendered_with string, proxy_used string, fetched_at timestamp"
)
LINKS = _schema("from_url_id long, to_url_id long, discovered_at timestamp")
CHUNKS = _schema(
    "chunk_id long, page_id long, url_id long, url string, domain string, title string, chunk_index int, total_chunks int, text string, token_estimate int, char_start int, "
    "char_end int, section_heading string, word_count int, embedding_model string, embedding_vector array<float>, created_at timestamp"
)
ROBOTS_CACHE = _schema("domain string, sitemap_urls array<string>, crawl_delay_seconds float, disallow_count int, fetched_at timestamp, expires_at timestamp")
CRAWL_SESSIONS = _schema(
    "session_id string, domain string, status string, max_depth int, pages_crawled int, pages_queued int, pages_failed int, started_at timestamp, completed_at timestamp"
)
CRAWL_JOB = _schema(
    "job_id string, url string, url_hash string, domain string, session_id string, depth int, max_depth int, priority int, retry_count int, max_retries int, state string, "
    "created_at timestamp, updated_at timestamp"
)
