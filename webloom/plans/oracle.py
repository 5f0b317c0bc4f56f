"""SQL that says independently what the catalogue's queries return, for a second engine over the same tables."""

from __future__ import annotations

WS = r"[\t\n\x0B\f\r \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
WS_IN = WS[1:-1]
ASTRAL = r"[\x{10000}-\x{10FFFF}]"


def units(x: str) -> str:
    return f"(length({x}) + len(regexp_extract_all({x}, '{ASTRAL}')))"


def words(x: str) -> str:
    return f"len(list_filter(string_split_regex({x}, '{WS}+'), lambda w: w <> ''))"


def sentences(x: str) -> str:
    return f"greatest(len(regexp_extract_all({x}, '[.!?]+[{WS_IN}\"'')]+|[.!?]+$')), 1)"


def trim(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def unescape(x: str) -> str:
    return f"""replace(replace(replace(replace(replace({x}, '&quot;', '"'), '&#39;', ''''), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')"""


SHAPE = r"'^ *([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?$'"


def part(url: str, n: int) -> str:
    return f"regexp_extract({url}, {SHAPE}, {n})"


def path(url: str) -> str:
    return f"CASE WHEN {part(url, 3)} = '' THEN '/' ELSE {part(url, 3)} END"


def query(url: str) -> str:
    return f"CASE WHEN {part(url, 4)} = '?' THEN '' ELSE {part(url, 4)} END"


#: Query names that never tell pages apart.
BLOCKED = "('utm_source', 'utm_medium', 'utm_campaign', 'fbclid', 'gclid', 'ref', 'source', 'session')"


def normal(url: str) -> str:
    pairs = f"list_filter(string_split(regexp_replace({part(url, 4)}, '^\\?', ''), '&'), lambda p: p <> '' AND split_part(p, '=', 1) NOT IN {BLOCKED})"
    tail = f"array_to_string(list_sort({pairs}), '&')"
    return f"regexp_replace(lower({part(url, 1)}) || '://' || lower({part(url, 2)}) || {path(url)} || CASE WHEN {tail} = '' THEN '' ELSE '?' || {tail} END, '/$', '')"


def host(url: str) -> str:
    return f"lower({part(url, 2)})"


N = normal("url")
OUTCOME = """CASE WHEN status_code IN (401, 403, 407, 429, 503, 999) THEN 'final'
  WHEN coalesce(network_error, false) OR status_code >= 400 OR status_code IS NULL THEN 'retry' WHEN html IS NULL THEN 'skip' ELSE 'parse' END"""

#: Phrases that tell boilerplate.
BOILERPLATE = (
    "cookie policy|privacy policy|terms of service|all rights reserved|subscribe to our newsletter|follow us on|share this|read more|click here|learn more|"
    "contact us|about us|home page|skip to content|back to top|copyright"
).split("|")


def features(source: str, text: str, html: str, published: str) -> str:
    body = f"regexp_replace(regexp_replace(regexp_replace({html}, '(?is)<head.*?</head>', ''), '(?is)<script.*?</script>', '', 'g'), '(?is)<style.*?</style>', '', 'g')"
    tags = ", ".join(f"len(regexp_extract_all({html}, '(?i)<{t}[\\s>]')) AS {t}" for t in ("h1", "h2", "h3", "p", "li"))
    hits = " + ".join(f"CAST(contains(lower({text}), '{p}') AS INT)" for p in BOILERPLATE)
    squeezed = f"regexp_replace({text}, '{WS}', '', 'g')"
    return f"""f AS (SELECT *, {words(text)} AS w, {sentences(text)} AS s, {units(squeezed)} AS c, {units(text)} AS tl, {units(body)} AS bl, {units(html)} AS hl, {tags}, {hits} AS b,
  contains({html}, 'property="article:published_time"') OR contains({html}, 'datePublished') AS og,
  {published} IS NOT NULL OR regexp_matches({html}, '20[0-9]{{2}}[-/][0-9]{{2}}[-/][0-9]{{2}}') AS dated,
  regexp_matches({html}, '(?i)\\$[0-9,]+|€[0-9,]+|£[0-9,]+|add to cart|buy now') AS priced, regexp_matches({text}, '(?i)404|page not found|error 5[0-9][0-9]') AS err
  FROM {source}),
g AS (SELECT *, CASE WHEN (CASE WHEN bl > 0 THEN bl ELSE hl END) > 0 THEN tl / (CASE WHEN bl > 0 THEN bl ELSE hl END) ELSE 0 END AS r,
  CASE WHEN w = 0 THEN 0 ELSE 4.71::DOUBLE * (c / w) + 0.5::DOUBLE * (w / s) - 21.43::DOUBLE END AS ari FROM f),
h AS (SELECT *, CASE WHEN w < 50 THEN 2 WHEN w < 150 THEN 8 WHEN w < 500 THEN 14 WHEN w < 2000 THEN 18 ELSE 20 END AS length_score,
  CASE WHEN r < 0.03 THEN CASE WHEN w < 200 THEN 2 ELSE 8 END WHEN r < 0.15 THEN 10 WHEN r < 0.30 THEN 15 ELSE 20 END AS density_score,
  greatest(0, (CASE WHEN ari < 1 THEN 4 WHEN ari <= 6 THEN 12 WHEN ari <= 14 THEN 20 WHEN ari <= 18 THEN 15 ELSE 8 END) - CASE WHEN w / s > 40 THEN 5 ELSE 0 END) AS readability_score,
  least(20, CASE WHEN h1 >= 1 THEN 6 ELSE 0 END + CASE WHEN h2 >= 2 THEN 6 WHEN h2 = 1 THEN 3 ELSE 0 END + CASE WHEN h3 >= 1 THEN 3 ELSE 0 END
    + CASE WHEN p >= 3 THEN 3 WHEN p >= 1 THEN 1 ELSE 0 END + CASE WHEN li >= 3 THEN 2 ELSE 0 END) AS structure_score,
  CASE WHEN b >= 5 THEN 2 WHEN b >= 3 THEN 5 ELSE 10 END AS uniqueness_score, CASE WHEN og THEN 10 WHEN dated THEN 6 ELSE 2 END AS freshness_score FROM g),
i AS (SELECT *, CAST(length_score + density_score + readability_score + structure_score + uniqueness_score + freshness_score AS INT) AS total FROM h),
j AS (SELECT *, CASE WHEN err AND w < 100 THEN 'error' WHEN priced THEN 'product' WHEN p < 2 AND li > 10 AND w < 300 THEN 'navigation'
  WHEN h2 + h3 >= 3 AND li >= 5 AND w >= 200 THEN 'docs' WHEN total < 30 THEN 'thin' WHEN total >= 70 THEN 'rich' ELSE 'article' END AS content_type FROM i),
k AS (SELECT *, list_filter([CASE WHEN w < 50 THEN 'STUB_CONTENT' END, CASE WHEN r < 0.03 AND w < 200 THEN 'LOW_TEXT_DENSITY' END, CASE WHEN w / s > 40 THEN 'WALL_OF_TEXT' END,
  CASE WHEN h1 < 1 THEN 'NO_HEADINGS' END, CASE WHEN b >= 5 THEN 'BOILERPLATE_HEAVY' END, CASE WHEN content_type = 'error' THEN 'ERROR_PAGE' END,
  CASE WHEN content_type = 'navigation' THEN 'NAVIGATION_PAGE' END], lambda x: x IS NOT NULL) AS flags FROM j)"""


PAGE_QUALITY = (
    "WITH src AS (SELECT p.page_id, p.content AS t, coalesce(f.html, '') AS m, p.published_at AS pub FROM pages p LEFT JOIN fetch_results f ON f.fetch_id = p.fetch_id WHERE p.content <> ''), "
    + features("src", "t", "m", "pub")
    + ", z AS (SELECT a.page_id, k.* EXCLUDE (page_id) FROM pages a LEFT JOIN k ON k.page_id = a.page_id) "
)
DOC_QUALITY = "WITH src AS (SELECT doc_id, text AS t, '' AS m, CAST(NULL AS TIMESTAMP) AS pub FROM documents WHERE text <> ''), " + features("src", "t", "m", "pub")

LINKS = (
    "WITH a AS (SELECT fetch_id, url, regexp_extract_all(html, '(?i)<a\\s[^>]*href=\"([^\"]*)\"', 1) AS h FROM fetch_results WHERE html IS NOT NULL), "
    "b AS (SELECT fetch_id, url, unnest(h) AS href, unnest(range(len(h))) AS position FROM a), "
    f"c AS (SELECT fetch_id, position, {part('url', 1)} || '://' || {host('url')} AS origin, {unescape('href')} AS href FROM b), "
    "l AS (SELECT fetch_id, origin || href AS link, CAST(min(position) AS INT) AS position FROM c WHERE href LIKE '/%' GROUP BY ALL) "
)
KEPT = f"NOT regexp_matches({part('link', 3)}, '(?i)/(login|logout|signin|signup|register|auth|account|cart|checkout)\\b')"

BODY = "regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\\b.*?</script\\s*>', '', 'g'), '(?is)<style\\b.*?</style\\s*>', '', 'g'), '(?is)<noscript\\b.*?</noscript\\s*>', '', 'g'), '(?is)<iframe\\b.*?</iframe\\s*>', '', 'g'), '(?is)<svg\\b.*?</svg\\s*>', '', 'g')"
INSIDE = "array_to_string(regexp_extract_all(x, '(?is)<{0}(?:\\s[^>]*)?>(.*?)</{0}\\s*>', 1), '')"
PLAIN = unescape("regexp_replace(y, '(?s)<[^>]*>', '', 'g')")


def tag_text(tag: str) -> str:
    inner = f"regexp_replace(regexp_extract(html, '(?is)<{tag}(?:\\s[^>]*)?>(.*?)</{tag}\\s*>', 1), '(?s)<[^>]*>', '', 'g')"
    return trim(unescape(inner))


LINES = f"""WITH r AS (SELECT doc_id, string_split_regex(text, '\\n+') AS a FROM documents WHERE text IS NOT NULL),
u AS (SELECT doc_id, unnest(a) AS raw, unnest(range(len(a))) AS n FROM r), l AS (SELECT doc_id, n, {trim("raw")} AS line FROM u),
m AS (SELECT *, {units("line")} < 120 AND NOT ends_with(line, '.') AND regexp_matches(line, '^[A-Z]|^#+{WS}') AS head FROM l WHERE line <> ''),
q AS (SELECT *, max(CASE WHEN head THEN n END) OVER (PARTITION BY doc_id ORDER BY n ROWS UNBOUNDED PRECEDING) AS b FROM m),
s AS (SELECT doc_id, coalesce(b, -1) AS b, string_agg(CASE WHEN NOT head THEN line END, ' ' ORDER BY n) AS body, regexp_replace(max(CASE WHEN head AND n = b THEN line END), '^#+{WS}*', '') AS heading FROM q GROUP BY ALL)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY b) - 1 AS INT) AS n, heading, body FROM s WHERE body IS NOT NULL"""

KNN_CHUNKS = """WITH v AS (SELECT chunk_id, CAST(embedding_vector AS DOUBLE[]) AS e FROM chunks WHERE len(embedding_vector) = 64
  AND len(list_filter(embedding_vector, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
d AS (SELECT q.chunk_id AS query, v.chunk_id, list_distance(q.e, v.e) AS x FROM v q, v WHERE q.chunk_id % 100 = 0),
t AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY x, chunk_id) AS rank FROM d QUALIFY rank <= 5) """

#: The states of a job, then two that are none.
JOB_STATE = "['discovered', 'queued', 'running', 'completed', 'failed', 'retrying', 'skipped', 'fetching', ''][url_id % 9 + 1]"
JOB = "length(domain) > 0 AND depth >= 0 AND length(url_hash) > 0 AND url_id % 9 < 7"

ROBOT_SECTIONS = f"""WITH s AS (SELECT domain, {path("url")} AS p, regexp_extract(url, '://[^/]+(/[^/?#]+/)', 1) AS section FROM urls WHERE domain IS NOT NULL),
e AS (SELECT domain, section, min(p) AS opened, count(*) AS n FROM s WHERE section <> '' GROUP BY ALL)"""
ROBOT_CACHE = """r AS (SELECT domain, CAST(sum(n) % 5 AS FLOAT) AS crawl_delay_seconds, CAST(count_if(section < '/g') AS INT) AS disallow_count FROM e GROUP BY domain),
l AS (SELECT u.domain, max(f.fetched_at) AS fetched_at FROM urls u JOIN fetch_results f ON f.url_id = u.url_id GROUP BY u.domain),
c AS (SELECT r.domain, crawl_delay_seconds, disallow_count, fetched_at, fetched_at + INTERVAL 1 HOUR AS expires_at FROM r JOIN l ON l.domain = r.domain) """

SQL: dict[str, str] = {
    "url_normalize": f"SELECT fetch_id, {N} AS normal FROM fetch_results",
    "url_fingerprint": f"SELECT fetch_id, sha256({N}) AS hash FROM fetch_results",
    "url_parts": f"""SELECT fetch_id, lower({part("url", 1)}) AS protocol, {host("url")} AS hostname, {path("url")} AS pathname, {query("url")} AS search,
  CASE WHEN {part("url", 5)} = '#' THEN '' ELSE {part("url", 5)} END AS fragment, lower(string_split({path("url")}, '.')[-1]) AS extension FROM fetch_results""",
    "url_classify": """SELECT url_id, CASE WHEN regexp_matches(url, '(?i)/product|item|detail') THEN 'detail' WHEN regexp_matches(url, '(?i)page=|category|list') THEN 'listing'
  WHEN regexp_matches(url, '(?i)blog|news|article') THEN 'article' ELSE 'unknown' END AS class FROM urls""",
    "url_dedup": f"SELECT sha256({N}) AS hash, min(fetch_id) AS fetch_id, any_value({N}) AS normal, count(*) AS copies FROM fetch_results GROUP BY 1",
    "url_frontier_new": f"""SELECT DISTINCT sha256({N}) AS hash, {N} AS normal FROM fetch_results
WHERE sha256({N}) NOT IN (SELECT url_hash FROM urls WHERE status = 'crawled') AND {N} NOT IN (SELECT url FROM urls WHERE status = 'crawled')""",
    "url_upsert": f"""WITH b AS (SELECT sha256({N}) AS h, max(fetched_at) AS at FROM fetch_results GROUP BY 1)
SELECT coalesce(u.url_hash, b.h) AS hash, coalesce(u.depth, 0) AS depth, CASE WHEN b.h IS NULL THEN u.status ELSE 'crawling' END AS status,
  CASE WHEN b.h IS NOT NULL AND u.url_hash IS NOT NULL THEN b.at ELSE u.last_crawled_at END AS last_crawled_at FROM urls u FULL JOIN b ON b.h = u.url_hash""",
    "url_status_latest": f"""WITH e AS (SELECT url_id, {OUTCOME} AS o, fetched_at AS tm FROM fetch_results),
s AS (SELECT url_id, tm, CASE WHEN o IN ('parse', 'skip') THEN 'crawled' ELSE 'failed' END AS st FROM e),
l AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY url_id ORDER BY tm DESC, st DESC) = 1),
t AS (SELECT url_id, max(tm) AS tm FROM e WHERE o = 'parse' GROUP BY url_id)
SELECT u.url_id, coalesce(l.st, u.status) AS status, coalesce(t.tm, u.last_crawled_at) AS last_crawled_at FROM urls u LEFT JOIN l ON l.url_id = u.url_id LEFT JOIN t ON t.url_id = u.url_id""",
    "fetch_outcome": f"SELECT fetch_id, {OUTCOME} AS outcome, coalesce(strlen(html) <= 5242880, false) AS readable FROM fetch_results",
    "domain_rollup": "SELECT domain, count(*) AS urls, count_if(status = 'crawled') AS crawled, count_if(status = 'failed') AS failed, count_if(status = 'pending') AS pending, max(depth) AS deepest FROM urls GROUP BY domain",
    "session_rollup": """SELECT domain, status, count(*) AS sessions, CAST(sum(pages_crawled) AS BIGINT) AS crawled, CAST(sum(pages_queued) AS BIGINT) AS queued, CAST(sum(pages_failed) AS BIGINT) AS failed,
  max(CAST(floor(epoch_us(completed_at) / 1000000) AS BIGINT) - CAST(floor(epoch_us(started_at) / 1000000) AS BIGINT)) AS longest_s FROM crawl_sessions GROUP BY ALL""",
    "latest_pages": "SELECT url_id, page_id, fetched_at, title, quality_score FROM pages QUALIFY row_number() OVER (PARTITION BY url_id ORDER BY fetched_at DESC NULLS LAST, page_id) = 1",
    "orphan_rows": """SELECT 'pages' AS child, page_id AS id FROM pages WHERE url_id IS NULL OR url_id NOT IN (SELECT url_id FROM urls WHERE status <> 'failed')
UNION ALL SELECT 'chunks', chunk_id FROM chunks WHERE url_id IS NULL OR url_id NOT IN (SELECT url_id FROM urls WHERE status <> 'failed')
UNION ALL SELECT 'fetch_results', fetch_id FROM fetch_results WHERE url_id IS NULL OR url_id NOT IN (SELECT url_id FROM urls WHERE status <> 'failed')""",
    "cascade_delete": "SELECT page_id, url_id FROM pages WHERE url_id NOT IN (SELECT url_id FROM urls WHERE depth >= 2)",
    "links_extract": LINKS + "SELECT fetch_id, position, link FROM l",
    "links_filter": LINKS + f"SELECT fetch_id, link FROM l WHERE {KEPT}",
    "link_edges": "SELECT from_url_id, to_url_id, min(discovered_at) AS discovered_at FROM links GROUP BY ALL",
    "link_degree": """WITH e AS (SELECT DISTINCT from_url_id AS a, to_url_id AS b FROM links WHERE from_url_id <> to_url_id)
SELECT url_id, CAST(sum(o) AS BIGINT) AS out_degree, CAST(sum(i) AS BIGINT) AS in_degree FROM (SELECT a AS url_id, 1 AS o, 0 AS i FROM e UNION ALL SELECT b, 0, 1 FROM e) GROUP BY url_id""",
    "children_queued": LINKS + f""", n AS (SELECT DISTINCT fetch_id, sha256({normal("link")}) AS h FROM l WHERE {KEPT})
SELECT fetch_id, count(*) AS followed, count(u.url_hash) AS deduped, count(*) - count(u.url_hash) AS queued FROM n LEFT JOIN urls u ON u.url_hash = n.h AND u.status = 'crawled' GROUP BY fetch_id""",
    "crawl_bfs": """WITH RECURSIVE w AS (SELECT url_id, 0 AS depth FROM urls WHERE depth = 0
  UNION SELECT l.to_url_id, w.depth + 1 FROM w JOIN links l ON l.from_url_id = w.url_id WHERE w.depth < 3)
SELECT url_id, min(depth) AS depth FROM w GROUP BY url_id""",
    "needs_js": f"""WITH t AS (SELECT *, {units(trim(f"regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '{WS}+', ' ', 'g')"))} AS n FROM fetch_results)
SELECT fetch_id, html IS NULL OR html = '' OR coalesce(n < 200 OR regexp_matches(html, '(?i)<div[^>]*id=["''](?:root|app|__next|__nuxt)["''][^>]*>\\s*</div>')
  OR (regexp_matches(html, '(?i)docsify') AND n < 2000), false) OR regexp_matches(url, '#/[a-zA-Z]') OR regexp_matches(url, '/app/|/dashboard/') AS needs_js FROM t""",
    "page_meta": f"""SELECT fetch_id, {tag_text("title")} AS title, {tag_text("h1")} AS h1,
  {trim(unescape('''regexp_extract(html, '(?is)<meta\\s+name="description"\\s+content="([^"]*)"', 1)'''))} AS description FROM fetch_results WHERE html IS NOT NULL""",
    "page_body_text": f"""WITH a AS (SELECT fetch_id, {BODY} AS x FROM fetch_results WHERE html IS NOT NULL),
b AS (SELECT fetch_id, CASE WHEN regexp_matches(x, '(?i)<main[\\s>]') THEN {INSIDE.format("main")} WHEN regexp_matches(x, '(?i)<article[\\s>]') THEN {INSIDE.format("article")}
  ELSE regexp_extract(x, '(?is)<body(?:\\s[^>]*)?>(.*)', 1) END AS y FROM a)
SELECT fetch_id, left({trim(f"regexp_replace({PLAIN}, '{WS}+', ' ', 'g')")}, 5000) AS body_text FROM b""",
    "doc_quality": DOC_QUALITY + """, z AS (SELECT a.doc_id, k.* EXCLUDE (doc_id) FROM documents a LEFT JOIN k ON k.doc_id = a.doc_id)
SELECT doc_id, w AS word_count, s AS sentence_count, length_score, readability_score, uniqueness_score, coalesce(total, 0) AS total, content_type FROM z""",
    "text_counts": f"""SELECT doc_id, {words("text")} AS words, {sentences("text")} AS sentences, {units("text")} AS units, CAST(ceil({units("text")} / 4) AS INT) AS tokens,
  CAST(greatest(1, ceil({words("text")} / 200)) AS INT) AS minutes, left(text, 120) AS preview FROM documents WHERE text IS NOT NULL""",
    "sentence_split": f"""WITH a AS (SELECT doc_id, string_split(regexp_replace(text, '([.!?]){WS}+([A-Z"''(])', '\\1' || chr(1) || '\\2', 'g'), chr(1)) AS p FROM documents WHERE text IS NOT NULL),
b AS (SELECT doc_id, list_filter(list_transform(p, lambda x: {trim("x")}), lambda x: x <> '') AS p FROM a)
SELECT doc_id, CAST(unnest(range(len(p))) AS INT) AS n, unnest(p) AS sentence FROM b""",
    "paragraph_blocks": LINES,
    "chunk_text": "SELECT page_id, chunk_index, total_chunks, text, token_estimate, char_start, char_end, section_heading, word_count FROM chunks",
    "embedding_input": """SELECT chunk_id, concat_ws(chr(10) || chr(10), CASE WHEN section_heading <> '' THEN 'Section: ' || section_heading END, text) AS input,
  concat_ws(chr(10) || chr(10), CASE WHEN title <> '' THEN 'Title: ' || title END, CASE WHEN section_heading <> '' THEN 'Section: ' || section_heading END, text) AS titled_input FROM chunks""",
    "unembedded_batch": """SELECT chunk_id, (SELECT url FROM urls u WHERE u.url_id = c.url_id) AS url, text, section_heading FROM chunks c
WHERE embedding_vector IS NULL AND embedding_model IS NULL ORDER BY chunk_id LIMIT 50""",
    "embed_validate": """SELECT chunk_id, len(embedding_vector) = 64 AND len(list_filter(embedding_vector, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding_vector) AS usable
FROM chunks WHERE embedding_vector IS NOT NULL""",
    "embed_apply": """SELECT chunk_id, CASE WHEN embedding_vector IS NULL AND embedding_model IS NULL THEN 'hashing-64' ELSE embedding_model END AS embedding_model,
  CASE WHEN embedding_vector IS NULL AND embedding_model IS NULL THEN 64 ELSE len(embedding_vector) END AS dimensions FROM chunks""",
    "knn_l2": """WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings), d AS (SELECT q.vec_id AS query, v.vec_id, list_distance(q.e, v.e) AS x FROM v q, v WHERE q.vec_id % 100 = 0)
SELECT query, vec_id, round(x, 5) AS distance, CAST(row_number() OVER (PARTITION BY query ORDER BY x, vec_id) AS INT) AS rank FROM d QUALIFY rank <= 5""",
    "knn_cosine": """WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings), d AS (SELECT q.vec_id AS query, v.vec_id, 1 - list_cosine_similarity(q.e, v.e) AS x FROM v q, v WHERE q.vec_id % 100 = 0)
SELECT query, vec_id, round(x, 5) AS distance, CAST(row_number() OVER (PARTITION BY query ORDER BY x, vec_id) AS INT) AS rank, round(1 - round(x, 5), 5) AS similarity FROM d QUALIFY rank <= 10""",
    "knn_join_source": KNN_CHUNKS + "SELECT t.query, CAST(t.rank AS INT) AS rank, t.chunk_id, round(x, 5) AS distance, u.url, c.section_heading FROM t JOIN chunks c ON c.chunk_id = t.chunk_id JOIN urls u ON u.url_id = c.url_id",
    "rag_context": KNN_CHUNKS + """, a AS (SELECT t.query, string_agg(c.text, chr(10) || chr(10) ORDER BY t.rank) AS context FROM t JOIN chunks c ON c.chunk_id = t.chunk_id GROUP BY t.query)
SELECT query, context, 'Context:' || chr(10) || context || chr(10) || chr(10) || 'Question:' || chr(10) || 'What is this about?' AS prompt FROM a""",
    "robots_rules": r"""SELECT * FROM (VALUES ('h.com', 'disallow', '^/private', 1), ('h.com', 'allow', '^/private/ok', 2), ('h.com', 'disallow', '^/.*\.pdf\$', 3),
  ('k.org', 'disallow', '^/a.b', 3)) v(domain, kind, pattern, line_no)""",
    "robots_allowed": """SELECT * FROM (VALUES ('https://h.com/private', false), ('https://h.com/privateer', false), ('https://h.com/private/ok/1', true), ('https://h.com/a.pdf', true), ('https://h.com/x', true),
  ('https://k.org/aXbc', false), ('https://k.org/ab', true), ('https://none.io/p', true), ('not a url', true)) v(url, allowed)""",
    "robots_summary": """SELECT * FROM (VALUES ('h.com', 2, 2.0::DOUBLE, ['https://h.com/sm.xml']), ('k.org', 1, 1.5::DOUBLE, ['https://k.org/sitemap.xml', 'https://k.org/sitemap_index.xml']),
  ('empty.net', 0, 0.0::DOUBLE, ['https://empty.net/sitemap.xml', 'https://empty.net/sitemap_index.xml'])) v(domain, disallow_count, crawl_delay, sitemaps)""",
    "sitemap_urls": """SELECT 'https://h.com/sm.xml' AS root, unnest(['https://h.com/a', 'https://h.com/b/', 'https://other.com/c', 'https://h.com/deep']) AS location""",
    "sitemap_seed": """SELECT 'h.com' AS domain, n AS normal, sha256(n) AS hash, 1 AS depth FROM (SELECT unnest(['https://h.com/a', 'https://h.com/b', 'https://h.com/deep']) AS n)""",
    "rate_limit_slots": """WITH e AS (SELECT event_id, user_id, (epoch_us(ts) // 1000) AS tm, row_number() OVER (PARTITION BY user_id ORDER BY (epoch_us(ts) // 1000), event_id) - 1 AS i FROM events)
SELECT event_id, max(tm - i * 72000000) OVER (PARTITION BY user_id ORDER BY tm, event_id ROWS UNBOUNDED PRECEDING) + i * 72000000 AS slot FROM e""",
    "retry_schedule": f"""WITH f AS (SELECT fetch_id, row_number() OVER (PARTITION BY url_id ORDER BY fetched_at, fetch_id) AS n FROM fetch_results WHERE {OUTCOME} = 'retry')
SELECT fetch_id, CAST(n AS INT) AS attempt, CASE WHEN n < 3 THEN CAST(2000 * pow(2, n - 1) AS BIGINT) END AS delay_ms, n >= 3 AS exhausted FROM f""",
    "crawl_lock_replay": """WITH RECURSIVE e AS (SELECT event_id, user_id, (epoch_us(ts) // 1000) AS tm, row_number() OVER (PARTITION BY user_id ORDER BY (epoch_us(ts) // 1000), event_id) AS n FROM events),
w AS (SELECT event_id, user_id, n, tm AS held, true AS granted FROM e WHERE n = 1
  UNION ALL SELECT e.event_id, e.user_id, e.n, CASE WHEN e.tm >= w.held + 36000000 THEN e.tm ELSE w.held END, e.tm >= w.held + 36000000 FROM w JOIN e ON e.user_id = w.user_id AND e.n = w.n + 1)
SELECT event_id, granted FROM w""",
    "proxy_health": """WITH RECURSIVE e AS (SELECT fetch_id, proxy_used AS k, (epoch_us(fetched_at) // 1000) AS tm, coalesce(network_error, false) OR status_code >= 400 AS bad,
  row_number() OVER (PARTITION BY proxy_used ORDER BY (epoch_us(fetched_at) // 1000), fetch_id) AS n FROM fetch_results WHERE proxy_used IS NOT NULL),
w AS (SELECT fetch_id, k, n, CAST(CASE WHEN bad THEN 1 ELSE 0 END AS INT) AS failures, true AS healthy, CASE WHEN bad THEN tm END AS last FROM e WHERE n = 1
  UNION ALL SELECT fetch_id, k, n, CAST(CASE WHEN bad THEN before + 1 ELSE 0 END AS INT), NOT bad OR (fine AND before + 1 < 3), CASE WHEN bad THEN tm ELSE last END
  FROM (SELECT e.*, w.last, CASE WHEN NOT w.healthy AND e.tm - w.last > 300000 THEN 0 ELSE w.failures END AS before, w.healthy OR e.tm - w.last > 300000 AS fine FROM w JOIN e ON e.k = w.k AND e.n = w.n + 1))
SELECT fetch_id, failures, healthy FROM w""",
    "header_rotation": """SELECT fetch_id, ['Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/124.0.0.0 Safari/537.36',
 'Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/123.0.0.0 Safari/537.36',
 'Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/124.0.0.0 Safari/537.36',
 'Mozilla/5.0 (Windows NT 10.0; Win64; x64; rv:125.0) Gecko/20100101 Firefox/125.0', 'Mozilla/5.0 (Macintosh; Intel Mac OS X 14.4; rv:125.0) Gecko/20100101 Firefox/125.0',
 'Mozilla/5.0 (Macintosh; Intel Mac OS X 14_4_1) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/17.4.1 Safari/605.1.15',
 'Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/124.0.0.0 Safari/537.36 Edg/124.0.0.0'][fetch_id % 7 + 1] AS user_agent,
 ['en-US,en;q=0.9', 'en-GB,en;q=0.9', 'en-US,en;q=0.8,es;q=0.5', 'en-CA,en;q=0.9,fr;q=0.7'][fetch_id % 4 + 1] AS accept_language FROM fetch_results""",
    "crawl_jobs": f"SELECT sha256('s|' || url_hash) AS job_id, url_hash, domain, depth, {JOB_STATE} AS state FROM urls WHERE {JOB} AND depth < 3",
    "dispatch_jobs": f"SELECT job_id, row_number() OVER (ORDER BY depth, job_id) AS place, 'queued' AS state FROM (SELECT sha256('s|' || url_hash) AS job_id, depth FROM urls WHERE {JOB})",
    "links_rules": f"""WITH r AS (SELECT url_id, split_part(url, '?', 1) || ['', '#top', '/file.PDF', '/login', '?next=/cart', '#/cloud', '/accounts', '/logo.svg?v=2', '/register-now', '/a.html#part'][url_id % 10 + 1] AS link,
  CASE WHEN url_id % 7 = 0 THEN 'elsewhere.example' ELSE domain END AS site FROM urls WHERE domain IS NOT NULL)
SELECT url_id, link FROM r WHERE {part("link", 1)} IN ('http', 'https') AND {host("link")} = site AND NOT ({path("link")} = '/' AND {part("link", 5)} <> '' AND NOT starts_with({part("link", 5)}, '#/'))
  AND lower(regexp_extract({part("link", 3)}, '\\.([^.]*)$', 1)) NOT IN ('pdf', 'zip', 'gz', 'tar', 'rar', 'jpg', 'jpeg', 'png', 'gif', 'webp', 'svg', 'ico', 'mp4', 'mp3', 'webm', 'ogg', 'css', 'js', 'json', 'xml', 'woff', 'woff2', 'ttf', 'eot')
  AND NOT regexp_matches({part("link", 3)} || {part("link", 4)}, '(?i)/(login|logout|signin|signup|register|auth|account|cart|checkout)\\b')""",
    "robots_sites": ROBOT_SECTIONS + f"""SELECT u.url_id, EXISTS (SELECT 1 FROM e WHERE e.domain = u.h AND e.section < '/g' AND starts_with(u.p, e.opened))
  OR NOT EXISTS (SELECT 1 FROM e WHERE e.domain = u.h AND e.section < '/g' AND starts_with(u.p, e.section)) AS allowed FROM (SELECT url_id, {host("url")} AS h, {path("url")} AS p FROM urls) u""",
    "robots_cached": ROBOT_SECTIONS + ", " + ROBOT_CACHE + "SELECT * FROM c",
    "robots_due": ROBOT_SECTIONS + ", " + ROBOT_CACHE + """SELECT DISTINCT domain FROM urls WHERE domain IS NOT NULL
  AND domain NOT IN (SELECT domain FROM c WHERE expires_at > (SELECT max(fetched_at) FROM fetch_results) - INTERVAL 24 HOURS)""",
    "sitemap_new": f"""WITH u AS (SELECT domain, depth, status, {host("url")} AS h, {N} AS n FROM urls WHERE domain IS NOT NULL),
d AS (SELECT DISTINCT domain, n FROM u WHERE h = domain AND domain IN (SELECT domain FROM u WHERE depth = 0) AND n NOT IN (SELECT n FROM u WHERE status = 'crawled'))
SELECT domain, n AS normal, sha256(n) AS hash, 1 AS depth FROM d QUALIFY row_number() OVER (PARTITION BY domain ORDER BY n) <= 5000""",
    "lock_release": """WITH RECURSIVE e AS (SELECT event_id, user_id, event_type = 'purchase' AS freed, (epoch_us(ts) // 1000) AS tm, row_number() OVER (PARTITION BY user_id ORDER BY (epoch_us(ts) // 1000), event_id) AS n FROM events),
w AS (SELECT event_id, user_id, n, CASE WHEN NOT freed THEN tm END AS held, NOT freed AS granted FROM e WHERE n = 1
  UNION ALL SELECT e.event_id, e.user_id, e.n, CASE WHEN e.freed THEN NULL WHEN w.held IS NULL OR e.tm >= w.held + 36000000 THEN e.tm ELSE w.held END,
    NOT e.freed AND (w.held IS NULL OR e.tm >= w.held + 36000000) FROM w JOIN e ON e.user_id = w.user_id AND e.n = w.n + 1)
SELECT event_id, granted FROM w""",
    "chunk_rows": "SELECT page_id, url_id, chunk_index, total_chunks, text, token_estimate, char_start, char_end, section_heading, word_count FROM chunks",
    "rag_documents": """SELECT chunk_id, CAST(to_json({'pageContent': text, 'metadata': {'source': url, 'domain': domain, 'title': title, 'chunkIndex': chunk_index, 'totalChunks': total_chunks,
  'section': section_heading, 'wordCount': word_count, 'tokenEstimate': token_estimate}}) AS VARCHAR) AS document FROM chunks""",
    "meta_fallbacks": f"""SELECT fetch_id, CAST(NULL AS VARCHAR) AS description,
  coalesce(nullif({trim(unescape('''regexp_extract(html, '<meta name="author" content="([^"]*)"', 1)'''))}, ''), nullif({trim(unescape('''regexp_extract(html, '<span rel="author">([^<]*)<', 1)'''))}, '')) AS author,
  nullif({trim('''regexp_extract(html, '<meta property="article:published_time" content="([^"]*)"', 1)''')}, '') AS published, CAST(NULL AS VARCHAR) AS modified, CAST(NULL AS VARCHAR) AS og_image,
  CASE WHEN regexp_matches(html, '<html lang="') THEN regexp_extract(html, '<html lang="([^"]*)"', 1) END AS lang FROM fetch_results""",
    "latency_percentiles": "SELECT event_type, quantile_cont(value, 0.95) AS p95, quantile_cont(value, 0.99) AS p99, count(value) AS n FROM events GROUP BY event_type",
    "vector_text": "SELECT vec_id, len(embedding) AS dimensions, true AS same FROM embeddings",
    "proxy_servers": """SELECT * FROM (VALUES ('http://us%40er:p%3Ass@proxy.net:3128/', 'http://proxy.net:3128', 'us@er', 'p:ss'), ('https://proxy.net:443', 'https://proxy.net', NULL, NULL),
  ('socks5://p.net', 'socks5://p.net', NULL, NULL)) v(url, server, username, password)""",
    "seen_links": """SELECT DISTINCT from_url_id, to_url_id FROM links WHERE from_url_id IS NULL OR to_url_id IS NULL OR from_url_id NOT IN (SELECT url_id FROM urls WHERE status = 'crawled') OR to_url_id NOT IN (SELECT url_id FROM urls WHERE status = 'crawled')""",
    "table_schema": "SELECT table_name, column_name, CAST(ordinal_position - 1 AS INT) AS place FROM information_schema.columns WHERE table_name IN ('urls', 'pages', 'links', 'chunks', 'fetch_results', 'crawl_sessions')",
    "table_peek": "SELECT url_id, url, status FROM urls ORDER BY url_id LIMIT 10",
    **{f"quality_{p}": PAGE_QUALITY + f"SELECT page_id, {p}_score FROM z" for p in ("length", "density", "readability", "structure", "uniqueness", "freshness")},
    "quality_total": PAGE_QUALITY + "SELECT page_id, coalesce(total, 0) AS total, w AS word_count, s AS sentence_count, floor(w / s * 10 + 0.5) / 10 AS avg_words_per_sentence FROM z",
    "page_rows": PAGE_QUALITY.replace("p.content AS t", f"{trim('p.content')} AS t") + """SELECT z.page_id, p.url_id, p.title, coalesce(w, 0) AS word_count, CAST(greatest(1, ceil(coalesce(w, 0) / 200)) AS INT) AS reading_time,
  coalesce(total, 0) AS quality_score, length_score AS quality_length_score, density_score AS quality_density_score, structure_score AS quality_structure_score, z.content_type,
  coalesce(flags, []) AS quality_flags, coalesce(total >= 25 AND z.content_type NOT IN ('error', 'navigation'), false) AS passes_quality_gate FROM z JOIN pages p ON p.page_id = z.page_id""",
    "quality_flags": PAGE_QUALITY + "SELECT page_id, coalesce(flags, []) AS flags FROM z",
    "quality_type": PAGE_QUALITY + "SELECT page_id, content_type FROM z",
    "quality_gate": PAGE_QUALITY + "SELECT page_id, coalesce(total, 0) AS total, content_type, coalesce(total >= 25 AND content_type NOT IN ('error', 'navigation'), false) AS passes FROM z",
}
