"""Queries for trust, snapshots, coverage and profiles, with the SQL they must equal."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tendril.operators import coverage, entity_join, features, profile, trust
from tendril.plans import feature_queries as fq
from tendril.plans import metadata, text_queries, views
from tendril.plans.feature_queries import plain
from tendril.sources.scratch import written

QUERIES: dict = {}
SQL: dict[str, str] = {}
c = F.col


def add(name: str, build, sql: str | None = None) -> None:
    QUERIES[name] = lambda spark, sf_dir: plain(build(spark, sf_dir))
    if sql:
        SQL[name] = sql


def _raw(spark, sf_dir):
    return views.raw_fetches(spark, sf_dir)


# trust ------------------------------------------------------------------------------------------------------------
add("b03_c01_trusted_rows", lambda s, d: trust.trusted(views.awards(s, d), _raw(s, d)).groupBy("structured_record_id").agg(F.count(F.lit(1)).alias("n"), F.sum("budget_limit_amount").alias("budget")),
    f"WITH awards AS ({views.AWARDS_SQL}), raw AS ({views.RAW_SQL}) SELECT structured_record_id, count(*) AS n, CAST(sum(budget_limit_amount) AS DOUBLE) AS budget FROM awards LEFT JOIN raw ON raw_fetch_id = id WHERE raw_fetch_id IS NULL OR is_corrupted IS FALSE GROUP BY 1")


def _gated(spark, sf_dir):
    return trust.snapshot_gate(views.snapshots(spark, sf_dir), _raw(spark, sf_dir), "payload_raw_id")


GATED = f"""s AS ({views.SNAPSHOT_SQL}), raw AS ({views.RAW_SQL}),
g AS (SELECT s.id, CASE WHEN payload_raw_id IS NULL THEN 'missing_id' WHEN raw.id IS NULL THEN 'not_found' WHEN coalesce(is_corrupted, false) THEN 'corrupted' ELSE 'ok' END AS gate_status,
  CASE WHEN payload_raw_id IS NULL THEN 'structured snapshot is missing raw_fetch_id' WHEN raw.id IS NULL THEN 'raw fetch ' || CAST(payload_raw_id AS STRING) || ' not found'
       WHEN coalesce(is_corrupted, false) THEN 'raw fetch ' || CAST(payload_raw_id AS STRING) || ' is marked corrupted: ' || coalesce(nullif(corruption_reason, ''), 'unknown corruption reason') END AS gate_reason
  FROM s LEFT JOIN raw ON payload_raw_id = raw.id)"""
add("b04_snapshot_gate", lambda s, d: _gated(s, d).select("id", "gate_status", "gate_reason"), f"WITH {GATED} SELECT * FROM g")
add("d28_materialization_stats", lambda s, d: trust.materialization_stats(_gated(s, d).withColumn("superseded", c("id") % 10 == 3)), f"""WITH {GATED}, t AS (SELECT *, id % 10 = 3 AS gone FROM g)
SELECT count(*) AS snapshots_seen, count(*) FILTER (WHERE NOT gone AND gate_status = 'ok') AS snapshots_materialized, count(*) FILTER (WHERE NOT gone AND gate_status = 'corrupted') AS snapshots_skipped_corrupted,
 count(*) FILTER (WHERE NOT gone AND gate_status IN ('missing_id', 'not_found')) AS snapshots_failed, count(*) FILTER (WHERE gone) AS snapshots_superseded FROM t""")
add("a09_latest_snapshots", lambda s, d: trust.latest_snapshots(views.snapshots(s, d), ["source_name", "external_key"]).select("source_name", "external_key", "id", "title", F.to_date("first_seen_at").alias("first_seen"), F.to_date("last_seen_at").alias("last_seen")),
    f"WITH s AS ({views.SNAPSHOT_SQL}) SELECT source_name, external_key, id, title, CAST(lo AS DATE) AS first_seen, CAST(hi AS DATE) AS last_seen FROM (SELECT *, min(fetched_at) OVER w AS lo, max(fetched_at) OVER w AS hi, row_number() OVER (PARTITION BY source_name, external_key ORDER BY fetched_at DESC, id DESC) AS nth FROM s WINDOW w AS (PARTITION BY source_name, external_key)) WHERE nth = 1")
add("a01_source_scan", lambda s, d: views.snapshots(s, d).where("source_name = 'click' and external_key like 'u1%'").select("id", "external_key", "day"), f"WITH s AS ({views.SNAPSHOT_SQL}) SELECT id, external_key, day FROM s WHERE source_name = 'click' AND external_key LIKE 'u1%'")

def _checked(spark, sf_dir):
    docs = views.read(spark, sf_dir, "documents")
    manifest = docs.select(c("doc_id").alias("id"), F.concat_ws("/", "source", c("doc_id").cast("string")).alias("storage_path"), F.when(c("doc_id") % 17 == 0, F.lit("0")).otherwise(F.sha2("text", 256)).alias("content_hash"),
        (c("doc_id") % 23 == 0).alias("is_corrupted"), F.when(c("doc_id") % 46 == 0, "content_hash mismatch").alias("corruption_reason"))
    files = docs.where("doc_id % 13 <> 0").select(F.concat_ws("/", "source", c("doc_id").cast("string")).alias("path"), F.sha2("text", 256).alias("digest"))
    return trust.file_integrity(manifest, files)


CHECKED = """q AS (SELECT doc_id AS id, doc_id % 23 = 0 AS is_corrupted, CASE WHEN doc_id % 46 = 0 THEN 'content_hash mismatch' END AS corruption_reason,
  CASE WHEN doc_id % 13 = 0 THEN 'missing_file' WHEN doc_id % 17 = 0 THEN 'content_hash_mismatch' END AS issue_type FROM documents),
z AS (SELECT *, CASE issue_type WHEN 'missing_file' THEN 'missing file' WHEN 'content_hash_mismatch' THEN 'content_hash mismatch' END AS reason FROM q)"""
add("c06_file_integrity", lambda s, d: _checked(s, d).select("id", "issue_type", "reason"), f"WITH {CHECKED} SELECT id, issue_type, reason FROM z")
add("d27_integrity_summary", lambda s, d: trust.integrity_summary(_checked(s, d), mark=True, limit=20), f"""WITH {CHECKED} SELECT count(*) AS rows_scanned, count(*) FILTER (WHERE NOT is_corrupted AND issue_type IS NULL) AS healthy_rows, count(issue_type) AS issues_found,
 count(*) FILTER (WHERE issue_type = 'content_hash_mismatch') AS content_hash_mismatch_count, count(*) FILTER (WHERE issue_type = 'missing_file') AS missing_file_count, count(*) FILTER (WHERE is_corrupted) AS corrupted_rows_before_scan,
 count(*) FILTER (WHERE is_corrupted OR issue_type IS NOT NULL) AS corrupted_rows_after_scan, count(*) FILTER (WHERE issue_type IS NOT NULL AND (NOT is_corrupted OR corruption_reason IS DISTINCT FROM reason)) AS rows_marked_corrupted,
 least(count(issue_type), 20) AS returned_issue_count, least(count(issue_type), 20) < count(issue_type) AS issues_truncated FROM z""")
add("b10_f04_integrity_issues", lambda s, d: trust.integrity_issues(_checked(s, d), corrupted_only=True, limit=50).select("id", "issue_type", "reason"), f"WITH {CHECKED} SELECT id, coalesce(issue_type, 'marked_corrupted') AS issue_type, reason FROM z WHERE issue_type IS NOT NULL OR is_corrupted ORDER BY id LIMIT 50")

_KEY = "concat('legal_form:', o_orderpriority, CASE WHEN o_orderkey % 5 = 0 THEN '|qarku:TIRANE' WHEN o_orderkey % 5 = 1 THEN '|other:x' ELSE '' END, '|', CAST(CAST(o_orderdate AS DATE) AS STRING), '|', CAST(CAST(o_orderdate AS DATE) AS STRING))"


def _identified(spark, sf_dir):
    own = views.read(spark, sf_dir, "orders").selectExpr("o_orderkey AS id", f"{_KEY} AS k", "CASE WHEN o_orderkey % 31 = 0 THEN 'K1' END AS nipt")
    none = F.lit(None).cast("string")
    return own.select("id", trust.snapshot_identity(c("nipt"), none, none, none, none, c("k"), accents=False).alias("identity"), trust.has_region(c("k"), none).alias("chunked"))


_IDENT = f"""i AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 31 <> 0 AND o_orderkey % 5 <> 1 THEN o_orderpriority END AS form, CASE WHEN o_orderkey % 31 <> 0 AND o_orderkey % 5 <> 1 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) END AS day, o_orderkey % 5 = 0 AS chunked FROM orders)"""
add("h19_snapshot_identity", lambda s, d: _identified(s, d).select("id", c("identity.legal_form").alias("form"), c("identity.date_from").alias("day"), "chunked"), f"WITH {_IDENT} SELECT * FROM i")
add("c04_superseded_snapshots", lambda s, d: trust.superseded(_identified(s, d)), f"WITH {_IDENT} SELECT id FROM i WHERE NOT chunked AND (form, day) IN (SELECT (form, day) FROM i WHERE chunked AND form IS NOT NULL)")

# coverage ---------------------------------------------------------------------------------------------------------
CAP = 60
_CHUNKS = "SELECT CAST(ts AS DATE) AS day, event_type AS chunk, count(*) AS n, sum(event_id) % 7 <> 0 AS ok FROM events GROUP BY 1, 2"


def _chunks(spark, sf_dir):
    return views.read(spark, sf_dir, "events").groupBy(c("ts").cast("date").alias("day"), c("event_type").alias("chunk")).agg(F.count(F.lit(1)).alias("n"), (F.sum("event_id") % 7 != 0).alias("ok"))


add("b13_truncated_windows", lambda s, d: _chunks(s, d).where(coverage.is_truncated(c("day"), c("day"), c("n"), CAP)).select("day", "chunk", "n"), f"SELECT day, chunk, n FROM ({_CHUNKS}) WHERE n = {CAP}")
add("d29_f05_chunk_report", lambda s, d: coverage.chunk_report(_chunks(s, d), CAP), f"""SELECT day, CAST(sum(CASE WHEN ok THEN n ELSE 0 END) AS BIGINT) AS rows, count(*) FILTER (WHERE ok) AS succeeded, count(*) FILTER (WHERE NOT ok) AS failed, count(*) FILTER (WHERE ok AND n = {CAP}) AS at_limit,
 coalesce(string_agg(CASE WHEN ok AND n = {CAP} THEN chunk END, ',' ORDER BY chunk), '') AS limited_chunks, count(*) FILTER (WHERE ok AND n = {CAP}) = 0 AS sufficient FROM ({_CHUNKS}) GROUP BY day""")
add("d30_g02_chunk_union", lambda s, d: coverage.chunk_union(views.read(s, d, "events").select(c("ts").cast("date").alias("day"), c("event_type").alias("chunk"), c("user_id").alias("nipt")), CAP), f"""WITH e AS (SELECT CAST(ts AS DATE) AS day, event_type AS chunk, user_id FROM events), n AS (SELECT day, chunk, count(*) AS n FROM e GROUP BY 1, 2)
SELECT day, CAST(sum(n) AS BIGINT) AS rows_before, count(*) AS chunks, count(*) FILTER (WHERE n = {CAP}) AS chunks_at_limit, (SELECT count(DISTINCT user_id) FROM e WHERE e.day = n.day) AS rows_after FROM n GROUP BY day""")
_WINDOWS = "SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS date_from, CAST(max(o_orderdate) AS DATE) AS date_to FROM orders GROUP BY 1"


def _windows(spark, sf_dir):
    return views.read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").cast("date").alias("date_from"), F.max("o_orderdate").cast("date").alias("date_to"))


def _order_days(spark, sf_dir):
    return views.read(spark, sf_dir, "orders").groupBy("o_custkey", c("o_orderdate").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.bool_and(c("o_orderstatus") != "P").alias("ok"))


_DAYS = "SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, count(*) AS n, bool_and(o_orderstatus <> 'P') AS ok FROM orders GROUP BY 1, 2"
add("c07_remaining_days", lambda s, d: coverage.remaining_spans(_windows(s, d), _order_days(s, d), "o_custkey").groupBy("o_custkey").agg(F.sum(F.datediff("date_to", "date_from") + 1).alias("n"), F.min("date_from").alias("first")),
    f"WITH w AS ({_WINDOWS}), p AS (SELECT o_custkey, CAST(unnest(generate_series(date_from, date_to, INTERVAL 1 DAY)) AS DATE) AS day FROM w) SELECT o_custkey, count(*) AS n, min(day) AS first FROM p WHERE (o_custkey, day) NOT IN (SELECT (o_custkey, day) FROM ({_DAYS})) GROUP BY 1")
add("d31_run_summary", lambda s, d: coverage.run_summary(_order_days(s, d), _windows(s, d), "o_custkey", cap=2), f"""WITH w AS ({_WINDOWS}), d AS ({_DAYS}) SELECT o_custkey, CAST(any_value(date_to - date_from) + 1 AS BIGINT) AS days_requested, count(*) FILTER (WHERE ok) AS days_completed, count(*) FILTER (WHERE NOT ok) AS days_failed,
 count(*) FILTER (WHERE ok AND n = 2) AS days_truncated, CAST(sum(CASE WHEN ok THEN n ELSE 0 END) AS BIGINT) AS rows, CAST(any_value(date_to - date_from) + 1 - count(*) FILTER (WHERE ok) AS BIGINT) AS days_remaining FROM w JOIN d USING (o_custkey) GROUP BY 1""")
_RUN = {"id": "o_orderkey", "collector": "o_orderpriority", "mode": "CASE WHEN o_custkey % 2 = 0 THEN 'daily_range' ELSE 'daily_legal_form:SHPK' END", "date_from": "CAST(concat(CAST(year(o_orderdate) AS STRING), '-01-01') AS DATE)", "date_to": "CAST(concat(CAST(year(o_orderdate) AS STRING), '-06-30') AS DATE)",
        "current_day": "CAST(o_orderdate AS DATE)", "status": "CASE o_orderkey % 5 WHEN 0 THEN 'running' WHEN 1 THEN 'failed' WHEN 2 THEN 'interrupted' WHEN 3 THEN 'completed' ELSE 'superseded' END"}
_RUNS = "SELECT " + ", ".join(f"{e} AS {n}" for n, e in _RUN.items()) + " FROM orders"
_runs = lambda s, d: views.read(s, d, "orders").selectExpr(*[f"{e} AS {n}" for n, e in _RUN.items()])
add("b11_e05_unfinished_runs", lambda s, d: coverage.latest_unfinished_runs(_runs(s, d)).select("id", "collector", "mode", "date_from", "resume_day", "days_done"), f"""SELECT id, collector, mode, date_from, resume_day, CAST(greatest(0, resume_day - date_from) AS BIGINT) AS days_done FROM
 (SELECT *, CASE WHEN current_day BETWEEN date_from AND date_to THEN current_day ELSE date_from END AS resume_day, row_number() OVER (PARTITION BY collector, mode, date_from, date_to ORDER BY id DESC) AS nth FROM ({_RUNS}) WHERE status IN ('running', 'failed', 'interrupted')) WHERE nth = 1""")
add("f03_list_runs", lambda s, d: coverage.list_runs(_runs(s, d), "failed", 25).select("id", "collector", "status"), f"SELECT id, collector, status FROM ({_RUNS}) WHERE status = 'failed' ORDER BY id DESC LIMIT 25")
add("b14_look_back", lambda s, d: views.read(s, d, "events").select("event_id", coverage.local_day(c("ts")).alias("day"), coverage.look_back(coverage.local_day(c("ts")), F.lit("2024-01-20").cast("date"), 7).alias("inside")),
    "SELECT event_id, CAST(timezone('Europe/Tirane', timezone('UTC', ts)) AS DATE) AS day, CAST(timezone('Europe/Tirane', timezone('UTC', ts)) AS DATE) BETWEEN DATE '2024-01-13' AND DATE '2024-01-20' AS inside FROM events")
add("g03_years_to_collect", lambda s, d: coverage.years_to_collect(views.read(s, d, "lineitem").select(F.year("l_shipdate").cast("long").alias("year")).distinct(), views.read(s, d, "orders").select(F.year("o_orderdate").cast("long").alias("year")).distinct()),
    "SELECT DISTINCT CAST(year(l_shipdate) AS BIGINT) AS year FROM lineitem WHERE year(l_shipdate) IN (SELECT year(o_orderdate) FROM orders)")

# profiles ---------------------------------------------------------------------------------------------------------
FIELDS = ["winner_nipt", "winner_name", "publication_date", "procedure_type", "winner_value_amount", "is_cancelled", "raw_fetch_id"]
_TEXT = {"winner_nipt", "winner_name", "procedure_type"}
_missing = lambda f: f"{f} IS NULL OR trim({f}) = ''" if f in _TEXT else f"{f} IS NULL"
# half-even in whole numbers, as DuckDB's round_even goes by the double's binary value
_prate = lambda n, t: f"CASE WHEN {t} > 0 THEN CAST({n} * 10000 // {t} + CASE WHEN 2 * ({n} * 10000 % {t}) > {t} THEN 1 WHEN 2 * ({n} * 10000 % {t}) = {t} THEN ({n} * 10000 // {t}) % 2 ELSE 0 END AS DOUBLE) / 10000 ELSE 0.0 END"
_FIELD_SQL = " UNION ALL ".join(f"SELECT '{f}' AS field, count(*) AS total_rows, count(*) FILTER (WHERE {_missing(f)}) AS missing_count FROM awards" for f in FIELDS)
add("b15_d18_missing_values", lambda s, d: profile.field_profile(views.awards(s, d), FIELDS), f"WITH awards AS ({views.AWARDS_SQL}) SELECT field, total_rows, total_rows - missing_count AS present_count, missing_count, {_prate('(total_rows - missing_count)', 'total_rows')} AS present_rate, {_prate('missing_count', 'total_rows')} AS missing_rate FROM ({_FIELD_SQL})")
_K = "nullif(upper(trim(winner_nipt)), '')"
add("d19_key_coverage", lambda s, d: profile.key_coverage(views.awards(s, d), "winner_nipt"), f"WITH awards AS ({views.AWARDS_SQL}), t AS (SELECT count(*) AS n, count({_K}) AS p FROM awards) SELECT n AS total_rows, p AS present_count, n - p AS missing_count, {_prate('p', 'n')} AS present_rate, {_prate('(n - p)', 'n')} AS missing_rate FROM t")
add("d20_distinct_keys", lambda s, d: profile.distinct_keys(views.awards(s, d), "winner_nipt").agg(F.count(F.lit(1)).alias("n")), f"WITH awards AS ({views.AWARDS_SQL}) SELECT count(DISTINCT {_K}) AS n FROM awards")
add("d21_frequencies", lambda s, d: profile.frequencies(views.awards(s, d), features.nonblank(c("procedure_type")), "v"), f"WITH awards AS ({views.AWARDS_SQL}), n AS (SELECT nullif(trim(procedure_type), '') AS v, count(*) AS count FROM awards GROUP BY 1) SELECT v, count, {_prate('count', '(SELECT count(*) FROM awards)')} AS rate FROM n")
_COVER = f"""awards AS ({views.AWARDS_SQL}), registry AS ({views.REGISTRY_SQL}), x AS (SELECT {_K} AS k FROM awards), y AS (SELECT nullif(upper(trim(business_nipt)), '') AS k FROM registry), b AS (SELECT k FROM x WHERE k IS NOT NULL INTERSECT SELECT k FROM y),
n AS (SELECT (SELECT count(*) FROM b) AS j, (SELECT count(*) FROM x WHERE k IN (SELECT k FROM b)) AS a1, (SELECT count(*) FROM x) AS a2, (SELECT count(k) FROM x) AS a3, (SELECT count(*) FROM y WHERE k IN (SELECT k FROM b)) AS b1, (SELECT count(*) FROM y) AS b2, (SELECT count(k) FROM y) AS b3)"""
add("c05_g01_join_coverage", lambda s, d: profile.join_coverage(views.awards(s, d), "winner_nipt", views.registry(s, d), "business_nipt"), f"WITH {_COVER} SELECT j AS joinable_keys, a1 AS left_rows_joinable, b1 AS right_rows_joinable, {_prate('a1', 'a2')} AS left_rate_all, {_prate('a1', 'a3')} AS left_rate_keyed, {_prate('b1', 'b2')} AS right_rate_all, {_prate('b1', 'b3')} AS right_rate_keyed FROM n")
_F = text_queries._form("legal_form")
_FORMS = f"registry AS ({views.REGISTRY_SQL}), f AS (SELECT nullif(trim(legal_form), '') AS raw, {_F} AS canonical, nullif(upper(trim(business_nipt)), '') AS k FROM registry)"
add("d22_legal_form_profile", lambda s, d: profile.legal_form_profile(views.registry(s, d), "legal_form", "business_nipt"), f"WITH {_FORMS}, t AS (SELECT count(*) AS n, count(DISTINCT k) AS dk, count(*) FILTER (WHERE raw IS NULL) AS mi, count(*) FILTER (WHERE canonical = 'SHPK') AS sh FROM f) SELECT n AS total_rows, dk AS distinct_keys, mi AS missing_legal_form_count, sh AS shpk_count, n - sh AS non_shpk_count, {_prate('sh', 'n')} AS shpk_rate, {_prate('(n - sh)', 'n')} AS non_shpk_rate FROM t")
add("d22_legal_form_counts", lambda s, d: profile.legal_form_counts(views.registry(s, d), "legal_form"), f"WITH {_FORMS}, t AS (SELECT 'raw' AS level, raw AS legal_form, count(*) AS count FROM f GROUP BY raw UNION ALL SELECT 'canonical', canonical, count(*) FROM f GROUP BY canonical) SELECT level, legal_form, count, {_prate('count', '(SELECT count(*) FROM f)')} AS rate FROM t")


def _profiles(spark, sf_dir):
    dictionary = metadata.feature_registry(spark)
    listed = fq.award_features(spark, sf_dir, names=False).drop("source_snapshot_count", "source_structured_record_ids")  # neither these nor names are in the dictionary
    own, companies = written(listed, "award-features"), written(fq.registry_features(spark, sf_dir), "registry-features")
    tables = {"app_company_features": own, "qkb_company_features": companies, "joined_company_features": entity_join.joined_features(own, companies)}
    out = None
    for name, df in tables.items():
        one = profile.feature_profile(df, dictionary, name)
        out = one if out is None else out.union(one)
    return out


_KINDS = {"app_company_features": "f1", "qkb_company_features": "f2", "joined_company_features": "f3"}
_TEXTS = {"top_authority_name", "top_procedure_type", "business_name", "legal_form", "subject_status", "city"}
_quoted = lambda x: "NULL" if x is None else "'" + str(x).replace("'", "''") + "'"


def _sparsity_sql() -> str:
    gone = lambda n: f"{n} IS NULL OR trim({n}) = ''" if n in _TEXTS else f"{n} IS NULL"
    parts = [
        f"SELECT {', '.join(map(_quoted, (d, n, category, level, metadata.DESCRIPTIONS[n])))}, count(*), count(*) FILTER (WHERE {gone(n)}) FROM {_KINDS[d]}"
        for d, n, category, level in metadata.feature_rows() if d in _KINDS
    ]
    return f"""{fq.FEATURES_SQL}, {fq.REGISTRY_FEATURES_SQL}, {fq.JOINED_SQL}, f1 AS MATERIALIZED (SELECT * FROM features), f2 AS MATERIALIZED (SELECT * FROM registry_features), f3 AS MATERIALIZED (SELECT * FROM joined),
t(dataset, name, category, confidence, description, n, missing_count) AS ({" UNION ALL ".join(parts)}),
sparsity AS (SELECT dataset, name, category, confidence, description, n - missing_count AS present_count, missing_count, {_prate("(n - missing_count)", "n")} AS present_rate, {_prate("missing_count", "n")} AS missing_rate FROM t)"""


add("c08_d24_feature_sparsity", _profiles, f"WITH {_sparsity_sql()} SELECT * FROM sparsity")
add("d25_feature_readiness", lambda s, d: profile.feature_readiness(_profiles(s, d)), f"""WITH {_sparsity_sql()},
r AS (SELECT dataset, max(present_count + missing_count) AS row_count, coalesce(round_even(avg(present_rate) FILTER (WHERE confidence = 'safe'), 4), 0.0) AS safe_coverage FROM sparsity GROUP BY dataset)
SELECT *, CASE WHEN row_count = 0 THEN 'blocked' WHEN safe_coverage >= 0.75 THEN 'usable_now' ELSE 'usable_with_caution' END AS status FROM r""")


def _profiled(spark, sf_dir):
    """The columns of awards and registry that reports read, written once, as each report reads them several times."""
    a = views.awards(spark, sf_dir).select("winner_nipt", "publication_date", "raw_fetch_id")
    r = views.registry(spark, sf_dir).select("business_nipt", "legal_form", "registration_date", "raw_fetch_id")
    return written(a, "profiled-awards"), written(r, "profiled-registry")


def readiness_metrics(spark, sf_dir, tables=None):
    """One row of numbers, whatever is empty: each table's aggregate is a row of its own, and the rows are folded. `tables`:
    awards and registry, where they are at hand."""
    a, r = tables or (views.awards(spark, sf_dir), views.registry(spark, sf_dir))
    keyed = lambda df, key: features.with_entity(df, key).select("entity").distinct()
    award_keys = keyed(trust.trusted(a, _raw(spark, sf_dir)), "winner_nipt").withColumn("side", F.lit(1))
    registry_keys = keyed(trust.trusted(r, _raw(spark, sf_dir)), "business_nipt").withColumn("side", F.lit(2))
    sides = award_keys.union(registry_keys).groupBy("entity").agg(F.sum("side").alias("sides"))
    parts = [
        a.agg(F.count(F.lit(1)).alias("award_rows"), F.avg(c("publication_date").isNotNull().cast("double")).alias("date_present_rate"), F.avg((~F.coalesce(F.trim("winner_nipt") != "", F.lit(False))).cast("double")).alias("key_missing_rate")),
        r.agg(F.count(F.lit(1)).alias("registry_rows"), F.avg(c("registration_date").isNull().cast("double")).alias("registration_missing_rate")),
        profile.join_coverage(a, "winner_nipt", r, "business_nipt").select("joinable_keys"),
        sides.agg(F.count_if(F.expr("sides in (1, 3)")).alias("award_entities"), F.count_if(F.expr("sides in (2, 3)")).alias("registry_entities"), F.count_if(F.expr("sides = 3 and entity <> ''")).alias("joined_entities")),
    ]
    rows = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
    return rows.agg(*[F.coalesce(F.max(n), F.lit(0)).alias(n) for n in rows.columns])


_E = lambda t, key: f"SELECT DISTINCT upper(trim({key})) AS e FROM {t} LEFT JOIN raw ON raw_fetch_id = id WHERE (raw_fetch_id IS NULL OR is_corrupted IS FALSE) AND {key} <> ''"
add("d26_readiness_findings", lambda s, d: profile.findings(readiness_metrics(s, d)), f"""WITH {_COVER}, raw AS ({views.RAW_SQL}), ea AS ({_E("awards", "winner_nipt")}), er AS ({_E("registry", "business_nipt")}),
m AS (SELECT (SELECT count(*) FROM awards) AS award_rows, (SELECT avg(CASE WHEN publication_date IS NULL THEN 0.0 ELSE 1.0 END) FROM awards) AS date_present_rate, (SELECT avg(CASE WHEN trim(winner_nipt) <> '' THEN 0.0 ELSE 1.0 END) FROM awards) AS key_missing_rate,
 (SELECT count(*) FROM registry) AS registry_rows, (SELECT avg(CASE WHEN registration_date IS NULL THEN 1.0 ELSE 0.0 END) FROM registry) AS registration_missing_rate, (SELECT j FROM n) AS joinable_keys,
 (SELECT count(*) FROM ea) AS award_entities, (SELECT count(*) FROM er) AS registry_entities, (SELECT count(*) FROM ea WHERE e <> '' AND e IN (SELECT e FROM er)) AS joined_entities)
{" UNION ALL ".join(f"SELECT {_quoted(section)} AS section, {_quoted(text)} AS finding FROM m WHERE {rule}" for section, rule, text in profile.RULES)}""")

_SEMANTICS = {"normalized_app_export_rows": (views.AWARD, views.awards, "awards"), "normalized_qkb_search_rows": (views.REGISTRY, views.registry, "registry")}


def _semantics(spark, sf_dir):
    """How well the fields of the two normalized datasets are filled, beside what they mean."""
    out = []
    for dataset, (view, rows, _) in _SEMANTICS.items():
        known = metadata.dataset_semantics(spark, dataset)
        filled = profile.field_profile(rows(spark, sf_dir), [r[1] for r in metadata.semantics_rows(dataset) if r[1] in view]).select("field", "present_count", "present_rate")
        out.append(known.join(F.broadcast(filled), "field", "left"))
    return reduce(lambda x, y: x.union(y), out)


_STRINGS = {"winner_nipt", "winner_name", "contracting_authority", "procedure_type", "contract_type", "business_nipt", "business_name", "trade_name", "legal_form", "subject_status", "city", "activity_text", "ownership_text"}
_PRESENT = lambda f, t: f"(SELECT count(*) FROM {t} WHERE " + (f"trim({f}) <> ''" if f in _STRINGS else f"{f} IS NOT NULL") + ")"
_MEANT = " UNION ALL ".join(
    f"SELECT {', '.join(map(_quoted, r))}, {_PRESENT(r[1], t) if r[1] in view else 'NULL'}, (SELECT count(*) FROM {t})" for dataset, (view, _, t) in _SEMANTICS.items() for r in metadata.semantics_rows(dataset)
)
add("i02_dataset_semantics", _semantics, f"""WITH awards AS ({views.AWARDS_SQL}), registry AS ({views.REGISTRY_SQL}), t(dataset, field, role, usage_level, join_level, note, candidate_group, present_count, n) AS ({_MEANT})
SELECT dataset, field, role, usage_level, join_level, note, candidate_group, present_count, {_prate("present_count", "n")} AS present_rate FROM t""")

_LEVELS = {"safe": "safe", "caution": "risky", "avoid": "avoid"}


def _policy_use(spark, sf_dir):
    """What the join policy says of the candidate pairs: how many fall under each level."""
    level = F.create_map(*[F.lit(x) for pair in _LEVELS.items() for x in pair])[c("status")]
    counted = fq.candidate_pairs(spark, sf_dir).groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n"), (F.first(level) == "safe").alias("joins"))
    return metadata.join_policy(spark).join(counted, "level", "left").select("level", "pair", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("joins", F.lit(False)).alias("joins"))


add("i03_join_policy", _policy_use, f"""WITH p AS ({fq.SQL["c03_join_assessment"]}), k AS (SELECT CASE status WHEN 'safe' THEN 'safe' WHEN 'caution' THEN 'risky' ELSE 'avoid' END AS level, count(*) AS n FROM p GROUP BY 1),
v(level, pair) AS (VALUES {", ".join(f"({_quoted(level)}, {_quoted(pair)})" for level, pairs in metadata.JOIN_POLICY.items() for pair in pairs)})
SELECT v.level, pair, coalesce(n, 0) AS n, n IS NOT NULL AND v.level = 'safe' AS joins FROM v LEFT JOIN k ON v.level = k.level""")


def _normalized_profile(spark, sf_dir, tables=None):
    from tendril.plans.runners import normalized_profile

    a, r = tables or (views.awards(spark, sf_dir), views.registry(spark, sf_dir))
    return normalized_profile({"awards": (a, "winner_nipt", ["winner_nipt", "publication_date"]), "registry": (r, "business_nipt", ["legal_form", "registration_date"])})


def _unpivot(section: str, dataset: str, field: str, source: str, metrics: str) -> str:
    return " UNION ALL ".join(f"SELECT '{section}' AS section, '{dataset}' AS dataset, {field} AS field, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM {source}" for m in metrics.split())


_FIELD = "total_rows present_count missing_count present_rate missing_rate"
_PROFILE = lambda t, fields: " UNION ALL ".join(f"SELECT '{f}' AS field, count(*) AS total_rows, count(*) FILTER (WHERE NOT ({m})) AS present_count, count(*) FILTER (WHERE {m}) AS missing_count FROM {t}" for f, m in fields)
_RATED = lambda x: f"SELECT *, {_prate('present_count', 'total_rows')} AS present_rate, {_prate('missing_count', 'total_rows')} AS missing_rate FROM ({x})"
_BLANK = lambda f: f"{f} IS NULL OR trim({f}) = ''"
add("d23_i04_normalized_profile", _normalized_profile, f"""WITH {_COVER},
fa AS ({_RATED(_PROFILE("awards", [("winner_nipt", _BLANK("winner_nipt")), ("publication_date", "publication_date IS NULL")]))}),
fr AS ({_RATED(_PROFILE("registry", [("legal_form", _BLANK("legal_form")), ("registration_date", "registration_date IS NULL")]))}),
ka AS ({_RATED(_PROFILE("awards", [("winner_nipt", _BLANK("winner_nipt"))]))}), kr AS ({_RATED(_PROFILE("registry", [("business_nipt", _BLANK("business_nipt"))]))}),
da AS (SELECT count(DISTINCT k) AS distinct_keys FROM x), dr AS (SELECT count(DISTINCT k) AS distinct_keys FROM y),
jc AS (SELECT j AS joinable_keys, a1 AS left_rows_joinable, b1 AS right_rows_joinable, {_prate('a1', 'a2')} AS left_rate_all, {_prate('a1', 'a3')} AS left_rate_keyed, {_prate('b1', 'b2')} AS right_rate_all, {_prate('b1', 'b3')} AS right_rate_keyed FROM n)
{_unpivot("missingness", "awards", "field", "fa", _FIELD)} UNION ALL {_unpivot("missingness", "registry", "field", "fr", _FIELD)}
UNION ALL {_unpivot("key_coverage", "awards", "field", "ka", _FIELD)} UNION ALL {_unpivot("key_coverage", "registry", "field", "kr", _FIELD)}
UNION ALL {_unpivot("keys", "awards", "'winner_nipt'", "da", "distinct_keys")} UNION ALL {_unpivot("keys", "registry", "'business_nipt'", "dr", "distinct_keys")}
UNION ALL {_unpivot("join_coverage", "both", "'winner_nipt = business_nipt'", "jc", "joinable_keys left_rows_joinable right_rows_joinable left_rate_all left_rate_keyed right_rate_all right_rate_keyed")}""")


def _all_profiles(spark, sf_dir):
    from tendril.plans.runners import profile_all

    tables = _profiled(spark, sf_dir)
    return profile_all(_normalized_profile(spark, sf_dir, tables), written(_profiles(spark, sf_dir), "sparsity"), readiness_metrics(spark, sf_dir, tables))


_OF = lambda name: f"({SQL[name]})"
add("i04_profile_all", _all_profiles, f"""SELECT section, dataset, field, metric, value, NULL AS text FROM {_OF("d23_i04_normalized_profile")}
UNION ALL SELECT 'feature_sparsity', dataset, name, metric, value, NULL FROM (UNPIVOT (SELECT dataset, name, CAST(present_count AS DOUBLE) AS present_count, CAST(missing_count AS DOUBLE) AS missing_count, present_rate, missing_rate FROM {_OF("c08_d24_feature_sparsity")}) ON present_count, missing_count, present_rate, missing_rate INTO NAME metric VALUE value)
UNION ALL SELECT 'readiness', dataset, '', metric, value, NULL FROM (UNPIVOT (SELECT dataset, CAST(row_count AS DOUBLE) AS row_count, safe_coverage FROM {_OF("d25_feature_readiness")}) ON row_count, safe_coverage INTO NAME metric VALUE value)
UNION ALL SELECT 'readiness', dataset, '', 'status', NULL, status FROM {_OF("d25_feature_readiness")}
UNION ALL SELECT section, 'all', '', 'finding', NULL, finding FROM {_OF("d26_readiness_findings")}""")
