"""Queries that go through files, sinks and streams: what comes back must equal what SQL says of the tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tendril.operators import buckets, materialize, sinks, trust
from tendril.plans import page_queries, runners, views
from tendril.plans.feature_queries import plain
from tendril.sources import artifact_store, files
from tendril.sources.scratch import scratch
from tendril.streaming import intake

QUERIES: dict = {}
SQL: dict[str, str] = {}
c = F.col


def add(name: str, build, sql: str | None = None) -> None:
    QUERIES[name] = lambda spark, sf_dir: plain(build(spark, sf_dir))
    if sql:
        SQL[name] = sql


def export_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as CSV exports, a file per priority, read back with the ordinals that its rows were written in."""
    path = scratch(spark, "exports")
    own = views.read(spark, sf_dir, "orders").select(c("o_orderkey").cast("string").alias("key"), F.concat(c("o_orderpriority"), F.lit(', "x"\n'), c("o_orderstatus")).alias("note"), c("o_orderkey").alias("nth"), c("o_orderpriority").alias("part"))
    own.repartition("part").sortWithinPartitions("part", "nth").drop("nth").write.partitionBy("part").option("header", True).option("escape", '"').option("quoteAll", True).csv(path)
    rows = files.export_rows(spark, path)
    return rows.select(c("cells")["key"].cast("long").alias("key"), c("cells")["note"].alias("note"), "row_ordinal")


add("a02_a03_export_scan", export_scan, "SELECT o_orderkey AS key, o_orderpriority || ', \"x\"' || chr(10) || o_orderstatus AS note, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS row_ordinal FROM orders")


def export_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows of exports by priority, with cells longer and shorter than the cut."""
    own = views.read(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.sort_array(F.collect_set("o_orderstatus")).alias("s"))
    cell = F.repeat(F.concat(c("v"), F.lit(" "), c("path")), F.when(c("v") == "F", 3).otherwise(200))
    rows = own.select(c("o_orderpriority").alias("path"), F.posexplode("s").alias("pos", "v")).select("path", (c("pos") + 1).alias("row_ordinal"), F.create_map(F.lit("v"), cell).alias("cells"))
    return files.preview(rows, 2, 500).select("path", "row_ordinal", c("cells")["v"].alias("cell"))


add("a04_preview", export_preview, "SELECT path, row_ordinal, left(repeat(s || ' ' || path, CASE s WHEN 'F' THEN 3 ELSE 200 END), 500) AS cell FROM (SELECT o_orderpriority AS path, o_orderstatus AS s, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderstatus) AS row_ordinal FROM (SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders)) WHERE row_ordinal <= 2")


def artifact_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages put into the artifact store, twice; its files read back by path: bytes, digest, and what the second run
    wrote."""
    path = scratch(spark, "artifacts")
    named = F.when(c("page_id") % 2 == 0, F.concat(F.lit("page"), (c("page_id") % 10).cast("string"), F.lit(".html")))
    own = views.read(spark, sf_dir, "pages").select("page_id", F.lit("web").alias("source_name"), c("url").alias("source_url"), F.lit("page").alias("fetch_kind"), F.lit("text/html").alias("content_type"), named.alias("filename"), F.to_timestamp(F.lit("2024-03-05")).alias("fetched_at"), c("html").cast("binary").alias("content"))
    for name in ("first", "second"):
        artifact_store.store(own, path).write.parquet(f"{path}-{name}")
    again = spark.read.parquet(f"{path}-second").select("page_id", "storage_path", "was_written")
    found = files.artifacts(spark, path).select(F.regexp_extract("path", "(web/.*)$", 1).alias("storage_path"), c("length").alias("file_bytes"), "digest")
    return again.join(found, "storage_path").select("page_id", "storage_path", "file_bytes", "digest", "was_written")


add("a07_artifact_scan", artifact_scan, "WITH p AS (SELECT page_id, html, sha256(html) AS digest FROM pages WHERE html IS NOT NULL) SELECT page_id, 'web/2024/03/05/page/' || CASE WHEN page_id % 2 = 0 THEN 'page' || (page_id % 10) || '-' || digest ELSE digest END || '.html' AS storage_path, CAST(strlen(html) AS BIGINT) AS file_bytes, digest, false AS was_written FROM p")


def artifact_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages in two artifact stores, read back by their manifest: of every five paths one is absolute, one has backslashes
    and one names no file; some digests are wrong. Even pages lie in the second store."""
    path = scratch(spark, "stores")
    own = views.read(spark, sf_dir, "pages").select("page_id", F.lit("web").alias("source_name"), c("url").alias("source_url"), F.lit("page").alias("fetch_kind"), F.lit("text/html").alias("content_type"), F.concat(F.lit("page"), c("page_id").cast("string"), F.lit(".html")).alias("filename"), F.to_timestamp(F.lit("2024-03-05")).alias("fetched_at"), F.when(c("page_id") % 6 == 0, F.lit("")).otherwise(c("html")).cast("binary").alias("content"))
    roots = [f"{path}/odd", f"{path}/even"]
    for root, rest in zip(roots, (1, 0), strict=True):
        artifact_store.store(own.where(c("page_id") % 2 == rest), root).write.parquet(f"{root}-manifest")
    listed = spark.read.parquet(*[f"{r}-manifest" for r in roots])
    at = c("page_id") % 5
    home = F.when(c("page_id") % 2 == 0, F.lit(roots[1])).otherwise(F.lit(roots[0]))
    named = F.when(at == 0, F.concat_ws("/", home, "storage_path")).when(at == 1, F.replace("storage_path", F.lit("/"), F.lit("\\"))).when(at == 2, F.concat("storage_path", F.lit(".gone"))).otherwise(c("storage_path"))
    wrong = F.when(c("page_id") % 7 == 0, F.lit("0")).otherwise(c("content_hash"))
    checked = trust.stored_integrity(listed.select(c("page_id").alias("id"), named.alias("storage_path"), wrong.alias("content_hash")), roots)
    return checked.select("id", F.regexp_extract("resolved_path", "/(odd|even)/", 1).alias("store"), "file_bytes", c("actual_content_hash").alias("digest"), "issue_type", "reason")


add("a07_c06_stored_integrity", artifact_check, """WITH p AS (SELECT page_id AS id, CASE WHEN page_id % 6 = 0 THEN '' ELSE html END AS html, page_id % 5 = 2 AS gone FROM pages),
q AS (SELECT id, CASE WHEN NOT gone THEN CASE WHEN id % 2 = 0 THEN 'even' ELSE 'odd' END END AS store, CASE WHEN NOT gone THEN CAST(strlen(html) AS BIGINT) END AS file_bytes, CASE WHEN NOT gone THEN sha256(html) END AS digest,
  CASE WHEN gone THEN 'missing_file' WHEN id % 7 = 0 THEN 'content_hash_mismatch' END AS issue_type FROM p WHERE html IS NOT NULL)
SELECT *, CASE issue_type WHEN 'missing_file' THEN 'missing file' WHEN 'content_hash_mismatch' THEN 'content_hash mismatch' END AS reason FROM q""")


def snapshot_replacement(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "rows")
    rows = views.awards(spark, sf_dir).select("structured_record_id", "l_orderkey", "l_linenumber", c("budget_limit_amount").alias("v"))
    sinks.replace_by_snapshot(rows, path)
    changed = rows.where("structured_record_id = 3").withColumn("v", F.lit(1).cast("decimal(18,2)"))
    for _ in range(2):  # twice, as a run that is repeated
        sinks.replace_by_snapshot(changed, path)
    return buckets.current(spark, path).groupBy(c("structured_record_id").cast("long").alias("id")).agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("v"))


add("a10_replace_by_snapshot", snapshot_replacement, f"WITH awards AS ({views.AWARDS_SQL}) SELECT structured_record_id AS id, count(*) AS n, CAST(sum(CASE WHEN structured_record_id = 3 THEN 1 ELSE budget_limit_amount END) AS DOUBLE) AS v FROM awards GROUP BY 1")


def full_replacement(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "all")
    counts = views.snapshots(spark, sf_dir).groupBy("source_name").agg(F.count(F.lit(1)).alias("n"))
    sinks.replace_all(counts.limit(1), path)
    sinks.replace_all(counts, path)
    return sinks.as_json(spark.read.parquet(path))


add("a11_a17_full_replace_json", full_replacement, "SELECT '{\"source_name\":\"' || event_type || '\",\"n\":' || count(*) || '}' AS json FROM events GROUP BY event_type")


def _arrivals(spark: SparkSession, sf_dir: str, folder: str, where: str) -> None:
    own = views.read(spark, sf_dir, "events").where(where).selectExpr("event_id AS id", "event_type AS source_name", "concat('u', CAST(user_id % 50 AS STRING)) AS external_key", "ts AS fetched_at", f"{page_queries._PAYLOAD} AS payload")
    own.write.mode("append").json(folder)


#: How snapshots arrive again: without results (every 5th), broken (every 7th), with a number for a list (every 11th).
_AGAIN = "CASE WHEN id % 5 = 0 THEN concat('{\"response\": [], \"raw_fetch_id\": ', CAST(id % 50 AS STRING), '}') WHEN id % 7 = 0 THEN 'no json' WHEN id % 11 = 0 THEN concat('{\"response\": 3, \"raw_fetch_id\": ', CAST(id % 50 AS STRING), '}') ELSE payload END"


def streamed_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch(spark, "stream")
    raw = views.read(spark, sf_dir, "events").where("event_id < 48").selectExpr("event_id AS id", "event_id % 13 = 0 AS is_corrupted", "'cut short' AS corruption_reason")

    def run() -> None:
        intake.normalized_intake(intake.snapshot_stream(spark, f"{base}/in"), f"{base}/out", f"{base}/progress", raw).awaitTermination()

    for where in ("event_id % 2 = 0", "event_id % 2 = 1"):
        _arrivals(spark, sf_dir, f"{base}/in", where)
        run()
    spark.read.schema(intake.SNAPSHOT).json(f"{base}/in").withColumns({"payload": F.expr(_AGAIN), "fetched_at": F.expr("fetched_at + INTERVAL 1 DAY")}).write.json(f"{base}/again")
    spark.read.schema(intake.SNAPSHOT).json(f"{base}/again").write.mode("append").json(f"{base}/in")
    run()
    last = intake.outcomes(spark, f"{base}/out").where("batch = 2").select("id", "outcome", "rows_inserted")
    rows = intake.current_rows(spark, f"{base}/out").groupBy(c("structured_record_id").alias("id")).agg(F.count(F.lit(1)).alias("n"), F.min("business_nipt").alias("business_nipt"))
    return last.join(rows, "id", "left").select("id", "outcome", "rows_inserted", F.coalesce("n", F.lit(0)).alias("n"), "business_nipt")


def streamed_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch(spark, "stream")
    for where in ("event_id % 3 = 0", "event_id % 3 = 1", "event_id % 3 = 2"):
        _arrivals(spark, sf_dir, f"{base}/in", where)
        intake.latest_upkeep(intake.snapshot_stream(spark, f"{base}/in"), f"{base}/state", f"{base}/progress").awaitTermination()
    return intake.latest_rows(spark, f"{base}/state").select("source_name", "external_key", "id", F.to_date("first_seen_at").alias("first_seen"), F.to_date("last_seen_at").alias("last_seen"))


add("j02_latest_upkeep", streamed_latest, f"WITH s AS ({views.SNAPSHOT_SQL}) SELECT source_name, external_key, id, CAST(lo AS DATE) AS first_seen, CAST(hi AS DATE) AS last_seen FROM (SELECT *, min(fetched_at) OVER w AS lo, max(fetched_at) OVER w AS hi, row_number() OVER (PARTITION BY source_name, external_key ORDER BY fetched_at DESC, id DESC) AS nth FROM s WINDOW w AS (PARTITION BY source_name, external_key)) WHERE nth = 1")
add("j01_streamed_intake", streamed_intake, """
WITH s AS (
  SELECT event_id AS id, user_id, CASE WHEN event_id % 50 % 13 = 0 THEN 'corrupted' WHEN event_id % 50 >= 48 THEN 'failed' END AS gate, CASE event_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END AS full_n,
    CASE event_id % 4 WHEN 2 THEN 'empty' WHEN 3 THEN 'failed' ELSE 'ok' END AS whole FROM events
), t AS (
  SELECT *, CASE WHEN gate IS NULL AND whole = 'ok' THEN full_n ELSE 0 END AS before,
    CASE WHEN id % 5 <> 0 AND id % 7 = 0 THEN 'failed' WHEN gate IS NOT NULL THEN gate WHEN id % 5 = 0 THEN 'empty' WHEN id % 11 = 0 THEN 'failed' ELSE whole END AS outcome FROM s
), u AS (SELECT *, CASE outcome WHEN 'ok' THEN full_n WHEN 'empty' THEN 0 ELSE before END AS n FROM t)
SELECT id, outcome, CAST(CASE outcome WHEN 'ok' THEN full_n ELSE 0 END AS BIGINT) AS rows_inserted, CAST(n AS BIGINT) AS n, CASE WHEN n > 0 THEN 'K' || lpad(CAST(user_id AS STRING), 8, '0') || 'A' END AS business_nipt FROM u""")


#: Export snapshots: 40 parts of the orders. Some have no artifact (5, 6 of 9), one that is corrupted on the second run
#: (7 of 9), one whose file is gone (8 of 9), or no year (3 of 10).
_EXPORTS = ("o_custkey % 40 AS id", "CASE WHEN o_custkey % 40 % 10 = 3 THEN 'x' ELSE '2020' END AS external_key", "CAST(NULL AS STRING) AS payload_year", "CASE o_custkey % 40 % 9 WHEN 5 THEN NULL WHEN 6 THEN 5000 + o_custkey % 40 ELSE 1000 + o_custkey % 40 END AS raw_fetch_id")
_REGION_KEY = "concat('legal_form:F', CAST(user_id % 50 AS STRING), CASE WHEN event_id % 6 = 0 THEN '|qarku:T' ELSE '' END, '|2024-01-01|2024-01-0', CAST(event_id % 7 + 1 AS STRING))"


def _normalized_twice(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Everything normalized, then again with half of the rows, corrupted artifacts and snapshots by region: the outcomes
    of the second run."""
    base = scratch(spark, "normalized")
    orders, events = views.read(spark, sf_dir, "orders"), views.read(spark, sf_dir, "events")
    cells = orders.selectExpr("CAST(o_orderkey AS STRING) AS Numri_i_references", "CAST(o_totalprice AS STRING) AS Fondi_limit", "o_custkey % 40 AS part").where("part % 9 <> 8")
    cells.repartition("part").write.partitionBy("part").option("header", True).csv(f"{base}/files")
    numbered = F.concat(F.lit("part="), F.regexp_extract("path", "part=(\\d+)/", 1))
    rows = files.export_rows(spark, f"{base}/files").withColumn("path", numbered)
    exports = orders.selectExpr(*_EXPORTS).distinct()
    there = rows.select("path").distinct()
    raw = exports.selectExpr("1000 + id AS id", "concat('part=', CAST(id AS STRING)) AS storage_path", "id % 9 = 7 AS bad").union(events.where("event_id < 48").selectExpr("event_id", "CAST(NULL AS STRING)", "event_id % 13 = 0"))
    marks = lambda bad: raw.select("id", "storage_path", bad.alias("is_corrupted"), F.lit("cut short").alias("corruption_reason"))
    registry = events.selectExpr("event_id AS id", "event_type AS source_name", f"{_REGION_KEY} AS external_key", "ts AS fetched_at", f"{page_queries._PAYLOAD} AS payload")
    runners.normalize_all(exports, registry.where("id % 6 <> 0"), marks(F.lit(False)), there, rows, base)
    half = rows.where("CAST(cells['Numri_i_references'] AS BIGINT) % 2 = 0")
    return runners.normalize_all(exports, registry, marks(c("bad")), there, half, base)


def _of_both(report):
    """A query that gives a report of each dataset's outcomes."""
    return lambda spark, sf_dir: reduce(DataFrame.union, [report(outcomes, name) for name, outcomes in _normalized_twice(spark, sf_dir).items()])


_TWICE = f"""p AS (SELECT CAST(o_custkey % 40 AS BIGINT) AS id, count(*) AS n1, count(*) FILTER (WHERE o_orderkey % 2 = 0) AS n2 FROM orders GROUP BY 1),
a AS (SELECT id, CASE WHEN id % 9 IN (5, 6) OR id % 9 = 8 THEN 'failed' WHEN id % 9 = 7 THEN 'corrupted' WHEN id % 10 = 3 THEN 'failed' ELSE 'ok' END AS outcome,
  CASE id % 9 WHEN 5 THEN 'structured snapshot is missing raw_fetch_id' WHEN 6 THEN 'raw fetch ' || (5000 + id) || ' not found' WHEN 8 THEN 'artifact of raw fetch ' || (1000 + id) || ' is missing'
   WHEN 7 THEN 'raw fetch ' || (1000 + id) || ' is marked corrupted: cut short' ELSE CASE WHEN id % 10 = 3 THEN 'snapshot has no usable export year' END END AS reason, n1, n2 FROM p),
s AS (SELECT event_id AS id, user_id % 50 AS form, event_id % 7 AS day, event_id % 6 = 0 AS chunked, event_id % 50 AS r, CASE event_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END AS n2, CASE event_id % 4 WHEN 2 THEN 'empty' WHEN 3 THEN 'failed' ELSE 'ok' END AS whole FROM events),
g AS (SELECT *, NOT chunked AND (form, day) IN (SELECT (form, day) FROM s WHERE chunked) AS gone, CASE WHEN NOT chunked AND r < 48 THEN n2 ELSE 0 END AS n1 FROM s),
q AS (SELECT id, CASE WHEN gone THEN 'superseded' WHEN r % 13 = 0 THEN 'corrupted' WHEN r >= 48 THEN 'failed' ELSE whole END AS outcome,
  CASE WHEN gone THEN '{materialize.BY_REGIONS}' WHEN r % 13 = 0 THEN 'raw fetch ' || r || ' is marked corrupted: cut short' WHEN r >= 48 THEN 'raw fetch ' || r || ' not found' WHEN whole = 'failed' THEN 'payload has no list of results' END AS reason, n1, n2 FROM g),
o AS (SELECT 'app_exports' AS dataset, * FROM a UNION ALL SELECT 'qkb_search', * FROM q)"""
add("i04_d28_normalize_all", _of_both(materialize.run_statistics), f"""WITH {_TWICE} SELECT dataset, count(*) AS snapshots_seen, count(*) FILTER (WHERE outcome IN ('ok', 'empty')) AS snapshots_materialized, count(*) FILTER (WHERE outcome = 'corrupted') AS snapshots_skipped_corrupted,
 count(*) FILTER (WHERE outcome = 'superseded') AS snapshots_skipped_superseded, count(*) FILTER (WHERE outcome = 'failed') AS snapshots_failed, CAST(coalesce(sum(n1) FILTER (WHERE outcome IN ('ok', 'empty', 'superseded')), 0) AS BIGINT) AS rows_deleted_before_insert,
 CAST(coalesce(sum(n2) FILTER (WHERE outcome = 'ok'), 0) AS BIGINT) AS rows_inserted, CAST(coalesce(sum(n2) FILTER (WHERE outcome = 'ok'), 0) AS BIGINT) AS rows_materialized FROM o GROUP BY dataset""")
add("d28_left_out_snapshots", _of_both(materialize.left_out), f"WITH {_TWICE} SELECT dataset, id AS structured_record_id, CASE outcome WHEN 'failed' THEN 'error' ELSE 'skipped' END AS kind, reason FROM o WHERE outcome NOT IN ('ok', 'empty')")
