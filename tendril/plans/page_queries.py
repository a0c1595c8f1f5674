"""Queries over pages and documents in the roles of saved pages, index pages, snapshots and responses."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from tendril.functions.text import absolute_url, form_date
from tendril.operators import normalize, sinks
from tendril.plans import views
from tendril.plans.feature_queries import plain
from tendril.sources import files, pages

QUERIES: dict = {}
SQL: dict[str, str] = {}
c = F.col


def add(name: str, build, sql: str | None = None) -> None:
    QUERIES[name] = lambda spark, sf_dir: plain(build(spark, sf_dir))
    if sql:
        SQL[name] = sql


def _pages(spark, sf_dir):
    return views.read(spark, sf_dir, "pages")


_ANCHOR = r"(?is)<a\b[^>]*?\bhref\s*=\s*[\"'']([^\"'']*)[\"''][^>]*>(.*?)</a>"
_PLAIN = lambda x: f"trim(regexp_replace(regexp_replace({x}, '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g'))"
#: Anchors of other kinds behind each page's own: without quotes, with a quote of the other kind, with references, with > in a
#: value, and one in a comment, which doesn't count.
_MORE = "concat(html, '<a href=/doc', CAST(page_id AS STRING), '.pdf>Doc</a><a data-href=\"x.pdf\" href=\"/it''s.pdf\">A &amp; B</a><a title=\"x > href=y\" HREF = ''/d?a=1&amp;b=', CAST(page_id AS STRING), '.pdf''><b>Q &#235;</b>&eacute;</a><!-- <a href=\"/gone.pdf\">no</a> -->') AS html"
add("a13_b12_links", lambda s, d: pages.links(_pages(s, d).selectExpr("page_id", "url", _MORE)).select("page_id", "pos", "href", "title", "text"), f"""
WITH x AS (SELECT page_id, url, regexp_extract_all(html, '{_ANCHOR}', 1) AS h, regexp_extract_all(html, '{_ANCHOR}', 2) AS t FROM pages),
y AS (SELECT page_id, url, CAST(i - 1 AS BIGINT) AS pos, trim(h[i]) AS raw, {_PLAIN("t[i]")} AS text FROM (SELECT *, unnest(range(1, len(h) + 1)) AS i FROM x)),
z AS (SELECT *, CASE WHEN regexp_matches(raw, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN raw WHEN starts_with(raw, '/') THEN regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1) || raw ELSE 'relative' END AS href FROM y WHERE raw <> ''),
k AS (SELECT *, row_number() OVER (PARTITION BY page_id, href ORDER BY pos) AS nth FROM z WHERE text <> '' OR regexp_matches(href, '(?i)\\.(pdf|docx?|xlsx?)($|\\?)') OR contains(lower(href), 'download'))
SELECT page_id, pos, href, left(CASE WHEN text <> '' THEN text ELSE regexp_extract(href, '([^/]*)$', 1) END, 500) AS title, left(text, 4000) AS text FROM k WHERE nth = 1
UNION ALL SELECT page_id, pos + len(regexp_extract_all(html, '{_ANCHOR}', 0)), regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1) || CASE pos WHEN 0 THEN '/doc' || page_id || '.pdf' WHEN 1 THEN '/it''s.pdf' ELSE '/d?a=1&b=' || page_id || '.pdf' END, title, title
FROM pages, (VALUES (0, 'Doc'), (1, 'A & B'), (2, 'Q ë é')) AS m(pos, title) WHERE html IS NOT NULL""",
)

_MARKED = "concat(html, CASE page_id % 3 WHEN 0 THEN concat('<a data-doc=\"simple\"></a><a data-doc=\" historical \"></a><a data-doc=\"simple\"></a><script>fetchAndDisplayPDF (1); fullUrl = \"https://x/', CAST(page_id AS STRING), '\"; fullUrl = \" \";</script>') WHEN 1 THEN '<script>downloadButtonPress()</script>' ELSE '' END) AS html"
add("a15_e06_action_evidence", lambda s, d: pages.action_evidence(_pages(s, d).selectExpr("page_id", _MARKED)), f"""
WITH p AS (SELECT page_id, {_MARKED} FROM pages) SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'simple,historical' ELSE '' END AS document_types, regexp_matches(html, '\\bfetchAndDisplayPDF\\s*\\(') AS displays_pdf,
 regexp_matches(html, '\\bdownloadButtonPress\\s*\\(') AS downloads, CASE WHEN page_id % 3 = 0 THEN regexp_extract(html, 'fullUrl = "(https://x/\\d+)"', 1) END AS full_url FROM p""")

_INDEX = "concat('<table><tr><td> 20', lpad(CAST(page_id % 25 AS STRING), 2, '0'), '</td><td>', CASE WHEN page_id % 4 = 0 THEN 'x.txt' ELSE concat('file', CAST(page_id AS STRING), '.CSV') END, '</td></tr></table><p>2001 other', CAST(page_id AS STRING), '.csv</p>', CASE WHEN page_id % 5 = 0 THEN 'GetData/ExportDocument?year=2020' ELSE '' END) AS html"
add("a12_export_index", lambda s, d: pages.export_index(_pages(s, d).selectExpr("page_id", _INDEX)), "SELECT page_id, CAST(CASE WHEN page_id % 4 = 0 THEN 2001 ELSE 2000 + page_id % 25 END AS BIGINT) AS year, CASE WHEN page_id % 4 = 0 THEN 'other' || page_id || '.csv' ELSE 'file' || page_id || '.CSV' END AS filename FROM pages")
add("a18_index_contract", lambda s, d: pages.index_contract(_pages(s, d).selectExpr("page_id", _INDEX)), "SELECT page_id, page_id % 5 = 0 AS download_hint, CAST(1 AS BIGINT) AS year_count, CAST(CASE WHEN page_id % 4 = 0 THEN 2001 ELSE 2000 + page_id % 25 END AS BIGINT) AS first_year, CAST(CASE WHEN page_id % 4 = 0 THEN 2001 ELSE 2000 + page_id % 25 END AS BIGINT) AS last_year, CASE WHEN page_id % 5 = 0 THEN '' ELSE 'download hint' END AS missing FROM pages")
_FORM = "concat(html, CASE WHEN page_id % 2 = 0 THEN '<form><input id=\"nipt\">' ELSE '' END, CASE WHEN page_id % 3 = 0 THEN '<button>ok</button>' ELSE '' END) AS html"
add("a18_search_contract", lambda s, d: pages.search_contract(_pages(s, d).selectExpr("page_id", _FORM), {"NIPT": "nipt", "date-from": "data_nga"}), """
SELECT page_id, CAST(CASE WHEN page_id % 2 = 0 THEN 1 ELSE 0 END AS BIGINT) AS form_count, concat_ws(',', CASE WHEN page_id % 2 <> 0 THEN 'search form' END, CASE WHEN page_id % 2 <> 0 THEN 'NIPT selector ''#nipt''' END, 'date-from selector ''#data_nga''', CASE WHEN page_id % 3 <> 0 THEN 'submit control' END) AS missing FROM pages""")
_SELECT = "concat('<select name=\"qarku\"><option value=\"\">-</option><option value=\"', CAST(page_id AS STRING), '\"> A  b </option><option value=\"', CAST(page_id AS STRING), '\">again</option><option value=\"z\"></select><select name=\"other\"><option value=\"q\">Q</option></select>') AS html"
add("a14_facets", lambda s, d: pages.facets(_pages(s, d).selectExpr("page_id", _SELECT), ["qarku"]).select("page_id", "field", "value", "label"), "SELECT page_id, 'qarku' AS field, CAST(page_id AS STRING) AS value, 'A b' AS label FROM pages UNION ALL SELECT page_id, 'qarku', 'z', 'z' FROM pages")

_ITEM = "concat('{\"nipti\": \"K', lpad(CAST(user_id AS STRING), 8, '0'), 'A\", \"emriISubjektit\": \" Firma ', CAST(event_id AS STRING), ' \", \"dataERegjistrimit\": \"1', CAST(event_id % 9 AS STRING), '.02.2019\", \"showRedFlag\": ', CASE event_id % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'false' ELSE 'null' END, '}')"
_PAYLOAD = f"concat('{{\"nipt\": null, \"data_nga\": \"2024-01-01\", \"data_ne\": \"02.01.2024\", \"raw_fetch_id\": ', CAST(event_id % 50 AS STRING), ', \"response\": ', CASE event_id % 4 WHEN 0 THEN concat('{{\"data\": [', {_ITEM}, ']}}') WHEN 1 THEN concat('[7, ', {_ITEM}, ', \"x\", ', {_ITEM}, ']') WHEN 2 THEN '[]' ELSE '\"none\"' END, '}}')"


def _snapshots(spark, sf_dir):
    return views.read(spark, sf_dir, "events").selectExpr("event_id AS id", f"{_PAYLOAD} AS payload")


_ROWS = """SELECT event_id AS id, user_id, unnest(CASE event_id % 4 WHEN 0 THEN [1] WHEN 1 THEN [2, 4] ELSE CAST([] AS INTEGER[]) END) AS ordinal FROM events"""
add("a05_h32_result_items", lambda s, d: normalize.result_items(_snapshots(s, d)).select("id", "result_ordinal", F.get_json_object("item", "$.nipti").alias("nipt")), f"SELECT id, CAST(ordinal AS BIGINT) AS result_ordinal, 'K' || lpad(CAST(user_id AS STRING), 8, '0') || 'A' AS nipt FROM ({_ROWS})")
add("b02_e04_normalized_registry", lambda s, d: normalize.normalize_registry(_snapshots(s, d)).select("id", "result_ordinal", "business_nipt", "business_name", "registration_date", "has_red_flags", "search_date_from", "search_date_to", "raw_fetch_id"),
    f"SELECT id, CAST(ordinal AS BIGINT) AS result_ordinal, 'K' || lpad(CAST(user_id AS STRING), 8, '0') || 'A' AS business_nipt, 'Firma ' || id AS business_name, make_date(2019, 2, CAST(10 + id % 9 AS INT)) AS registration_date, CASE id % 3 WHEN 0 THEN true WHEN 1 THEN false END AS has_red_flags, DATE '2024-01-01' AS search_date_from, DATE '2024-01-02' AS search_date_to, CAST(id % 50 AS BIGINT) AS raw_fetch_id FROM ({_ROWS})")
add("h33_record_counts", lambda s, d: normalize.result_items(_snapshots(s, d)).groupBy("id").agg(F.count(F.lit(1)).alias("n")), f"SELECT id, count(*) AS n FROM ({_ROWS}) GROUP BY 1")
_PAGE = f"CASE event_id % 4 WHEN 2 THEN concat(\"<script>response = JSON.parse('\", {_PAYLOAD}, \"')</script>\") WHEN 0 THEN concat('<script>var response = ', {_PAYLOAD}, ';</script>') WHEN 1 THEN concat('<script>response = JSON.parse(\"', replace({_PAYLOAD}, '\"', '\\\\\"'), '\")</script>') ELSE '<p>none</p>' END"
add("a06_embedded_json", lambda s, d: views.read(s, d, "events").selectExpr("event_id", f"{_PAGE} AS html").select("event_id", F.get_json_object(pages.embedded_json(c("html")), "$.raw_fetch_id").alias("raw_fetch_id")),
    "SELECT event_id, CASE WHEN event_id % 4 < 3 THEN CAST(event_id % 50 AS STRING) END AS raw_fetch_id FROM events")

_BODY = "CASE event_id % 7 WHEN 0 THEN concat('{\"status\": 1, \"data\": \"', base64(to_binary(concat('%PDF-', CAST(event_id AS STRING)), 'utf-8')), '\"}') WHEN 1 THEN '{\"status\": 0, \"message\": \" none \"}' WHEN 2 THEN '{\"status\": -3, \"data\": \"boom\"}' WHEN 3 THEN '{\"status\": 2, \"data\": \"@@\"}' WHEN 4 THEN '[1]' WHEN 5 THEN '{\"status\": \"x\"}' ELSE '{\"status\": 1, \"data\": \"aGVsbG8=\"}' END"
add("a16_h24_h25_document_responses", lambda s, d: pages.document_responses(views.read(s, d, "events").selectExpr("event_id", f"{_BODY} AS body")).select("event_id", "backend_status", "backend_state", "message", "error", "pdf_size"), """
SELECT event_id, CAST(CASE event_id % 7 WHEN 0 THEN 1 WHEN 1 THEN 0 WHEN 2 THEN -3 WHEN 3 THEN 2 WHEN 6 THEN 1 END AS BIGINT) AS backend_status, CASE event_id % 7 WHEN 0 THEN 'success' WHEN 1 THEN 'not_found' WHEN 2 THEN 'server_error' END AS backend_state,
 CASE event_id % 7 WHEN 1 THEN 'none' WHEN 2 THEN 'boom' END AS message, CASE event_id % 7 WHEN 3 THEN 'data is not base64' WHEN 4 THEN 'body is not a JSON object' WHEN 5 THEN 'status is not numeric' WHEN 6 THEN 'data is not a PDF' END AS error,
 CAST(CASE WHEN event_id % 7 = 0 THEN 5 + length(CAST(event_id AS STRING)) END AS BIGINT) AS pdf_size FROM events""")

add("a08_raw_manifest", lambda s, d: files.manifest(_pages(s, d).select("page_id", F.lit("web").alias("source_name"), c("url").alias("source_url"), F.lit("page").alias("fetch_kind"), F.when(c("page_id") % 2 == 0, "text/csv").alias("content_type"), F.lit(None).cast("string").alias("filename"), F.lit("2024-03-05").cast("timestamp").alias("fetched_at"), F.when(c("page_id") % 9 != 0, c("html").cast("binary")).alias("content")))
    .select("page_id", "content_hash", "storage_name", "storage_folder"), """
WITH p AS (SELECT page_id, sha256(html) AS h, CASE WHEN ends_with(url, '.csv') OR page_id % 2 = 0 THEN '.csv' WHEN ends_with(url, '.pdf') THEN '.pdf' WHEN ends_with(url, '.json') THEN '.json' ELSE '.html' END AS e FROM pages WHERE page_id % 9 <> 0) SELECT page_id, h AS content_hash, h || e AS storage_name, 'web/2024/03/05/page' AS storage_folder FROM p""")


def _export(spark, sf_dir):
    own = views.read(spark, sf_dir, "lineitem").join(views.read(spark, sf_dir, "orders"), c("l_orderkey") == c("o_orderkey"))
    text = lambda e: e.cast("string")
    cells = {
        "Numri_i_references": F.concat(F.lit(" REF-"), text(c("l_orderkey")), F.lit(" ")), "Data_e_publikimit": form_date(c("l_shipdate")), "Anulluar": F.when(c("l_returnflag") == "R", "Po").when(c("l_returnflag") == "A", "Jo").otherwise(""),
        "Fondi_limit": F.format_number("l_extendedprice", 2), "NIPT_i_fituesit": F.concat(F.lit("k"), F.lpad(text(c("o_custkey")), 8, "0"), F.lit("a"), F.when(c("l_linenumber") == 2, " L12345678B").otherwise("")),
    }
    return normalize.normalize_export(own.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.create_map(*[x for k, v in cells.items() for x in (F.lit(k), v)]).alias("cells")))


add("b01_normalized_export", lambda s, d: _export(s, d).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "procurement_reference", "publication_date", "is_cancelled", "is_suspended", "budget_limit_amount", "winner_nipt"), """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, 'REF-' || l_orderkey AS procurement_reference, CAST(l_shipdate AS DATE) AS publication_date, CASE l_returnflag WHEN 'R' THEN true WHEN 'A' THEN false END AS is_cancelled, CAST(NULL AS BOOLEAN) AS is_suspended,
 CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS budget_limit_amount, CASE WHEN l_linenumber <> 2 THEN 'K' || lpad(CAST(o_custkey AS STRING), 8, '0') || 'A' END AS winner_nipt FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")

_BASE = "concat('https://h', CAST(page_id AS STRING), '.x/a/b/c?q=1')"
_HREF = "CASE page_id % 8 WHEN 0 THEN '../d' WHEN 1 THEN './e?y=2' WHEN 2 THEN '?z=1' WHEN 3 THEN '#f' WHEN 4 THEN '/g/../h' WHEN 5 THEN '//o/p' WHEN 6 THEN url ELSE '../../../i/..' END"
add("h23_url_resolution", lambda s, d: _pages(s, d).selectExpr("page_id", f"{_BASE} AS base", f"{_HREF} AS href").select("page_id", absolute_url(c("base"), c("href")).alias("full")),
    "SELECT page_id, CASE WHEN page_id % 8 = 5 THEN 'https://o/p' WHEN page_id % 8 = 6 THEN url ELSE 'https://h' || page_id || '.x' || CASE page_id % 8 WHEN 0 THEN '/a/d' WHEN 1 THEN '/a/b/e?y=2' WHEN 2 THEN '/a/b/c?z=1' WHEN 3 THEN '/a/b/c?q=1#f' WHEN 4 THEN '/h' ELSE '/' END END AS full FROM pages")

_AT = "CASE WHEN doc_id % 5 = 0 THEN concat('/abs/', source, '/', CAST(doc_id AS STRING)) ELSE concat(source, '/', CAST(doc_id AS STRING)) END"


def _resolved(spark, sf_dir):
    docs = views.read(spark, sf_dir, "documents")
    place = lambda root, where: docs.where(where).selectExpr(f"concat('file:///{root}/', source, '/', CAST(doc_id AS STRING)) AS path")
    there = place("abs", "doc_id % 10 = 0").union(place("project", "doc_id % 3 = 0")).union(place("raw", "doc_id % 2 = 0"))
    return files.resolved(docs.selectExpr("doc_id", f"{_AT} AS storage_path"), there, ["/project", "/raw"]).select("doc_id", "resolved_path")


add("a07_path_resolution", _resolved, "SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN CASE WHEN doc_id % 10 = 0 THEN '/abs/' END WHEN doc_id % 3 = 0 THEN '/project/' WHEN doc_id % 2 = 0 THEN '/raw/' END || source || '/' || doc_id AS resolved_path FROM documents")
add("h37_materialized_rows", lambda s, d: sinks.materialized(views.awards(s, d), datetime(2024, 3, 5, 13, 30, tzinfo=timezone(timedelta(hours=2)))).groupBy(c("materialized_at").cast("string").alias("at")).agg(F.count(F.lit(1)).alias("n")),
    f"WITH awards AS ({views.AWARDS_SQL}) SELECT '2024-03-05 11:30:00' AS at, count(*) AS n FROM awards")
