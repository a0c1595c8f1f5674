"""Queries over the award and registry roles: features, joins and their parts, with the SQL they must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tendril.operators import entity_join, features
from tendril.plans import views
from tendril.sources.scratch import written

ROLES = features.AwardRoles(newest=views.NEWEST)
REGISTRY_ROLES = features.RegistryRoles(newest=("o_orderkey",))
QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, whole numbers as longs and lists as text: types that any engine compares alike."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
        out.append(c.alias(f.name))
    return df.select(*out)


def add(name: str, build: Callable, sql: str | None = None) -> None:
    QUERIES[name] = lambda spark, sf_dir: plain(build(spark, sf_dir))
    if sql:
        SQL[name] = sql


def _trusted_awards(spark, sf_dir) -> DataFrame:
    return views.trusted_awards(spark, sf_dir)


def _marked_awards(spark, sf_dir) -> DataFrame:
    """The same with the marks of amounts and procedures, so that sums of rows carry these alone."""
    return views.trusted_awards(spark, sf_dir, features.amount_marks(ROLES), features.procedure_marks(ROLES))


KEYED = f"""awards AS ({views.AWARDS_SQL}), raw AS ({views.RAW_SQL}),
ok AS (SELECT awards.* FROM awards LEFT JOIN raw ON raw_fetch_id = id WHERE raw_fetch_id IS NULL OR is_corrupted IS FALSE),
k AS (SELECT *, upper(trim(winner_nipt)) AS company_nipt, CAST(budget_limit_amount * 100 AS HUGEINT) AS b, CAST(winner_value_amount * 100 AS HUGEINT) AS a,
             CASE WHEN budget_limit_amount > 0 AND winner_value_amount IS NOT NULL
                  THEN (2 * CAST(winner_value_amount * 100 AS HUGEINT) * 1000000 + CAST(budget_limit_amount * 100 AS HUGEINT)) // (2 * CAST(budget_limit_amount * 100 AS HUGEINT)) END AS r6,
             lower(trim(procedure_type)) = 'purchase tickets' AS tickets
      FROM ok WHERE winner_nipt IS NOT NULL AND winner_nipt <> '')"""


def _rate(n: str, total: str) -> str:
    return f"CASE WHEN {total} > 0 THEN CAST((2 * {n} * 10000 + {total}) // (2 * {total}) AS DOUBLE) / 10000 ELSE 0.0 END"


def _subset(value: str, of: str) -> str:
    return f"CAST(CASE WHEN count(*) FILTER (WHERE {of}) = 0 THEN 0 ELSE sum({value}) FILTER (WHERE {of}) END AS DOUBLE)"


_NEAR, _OVER, _ZERO = "r6 IS NOT NULL AND a * 100 >= b * 95 AND a <= b", "r6 IS NOT NULL AND a > b", "b = 0 AND a IS NOT NULL"
_count = lambda of: f"count(*) FILTER (WHERE {of})"
MAIN_SQL = {
    "source_row_count": "count(*)",
    "source_snapshot_count": "count(DISTINCT structured_record_id)",
    "source_structured_record_ids": "string_agg(DISTINCT CAST(structured_record_id AS STRING), ',' ORDER BY CAST(structured_record_id AS STRING))",
    "latest_winner_name": "arg_max(trim(winner_name), coalesce(strftime(publication_date, '%Y%m%d'), '0') || '-' || lpad(CAST(l_orderkey AS STRING), 12, '0') || '-' || CAST(l_linenumber AS STRING) || '-' || lpad(CAST(l_partkey AS STRING), 12, '0') || '-' || lpad(CAST(l_suppkey AS STRING), 12, '0')) FILTER (WHERE trim(winner_name) <> '')",
    "first_procurement_date": "min(publication_date)",
    "last_procurement_date": "max(publication_date)",
    "first_procurement_year": "CAST(year(min(publication_date)) AS BIGINT)",
    "last_procurement_year": "CAST(year(max(publication_date)) AS BIGINT)",
    "active_year_span": "CAST(year(max(publication_date)) - year(min(publication_date)) + 1 AS BIGINT)",
    "active_procurement_count": _count("is_cancelled IS FALSE"),
    "cancelled_procurement_count": _count("is_cancelled IS TRUE"),
    "suspended_procurement_count": _count("is_suspended IS TRUE"),
    "cancelled_procurement_rate": _rate(_count("is_cancelled IS TRUE"), "count(*)"),
    "suspended_procurement_rate": _rate(_count("is_suspended IS TRUE"), "count(*)"),
    "total_budget_limit_amount": "CAST(sum(budget_limit_amount) AS DOUBLE)",
    "total_winner_value_amount": "CAST(sum(winner_value_amount) AS DOUBLE)",
    "active_total_budget_limit_amount": _subset("budget_limit_amount", "is_cancelled IS FALSE"),
    "active_total_winner_value_amount": _subset("winner_value_amount", "is_cancelled IS FALSE"),
    "cancelled_total_budget_limit_amount": _subset("budget_limit_amount", "is_cancelled IS TRUE"),
    "cancelled_total_winner_value_amount": _subset("winner_value_amount", "is_cancelled IS TRUE"),
    "safe_winner_to_budget_ratio_avg": "CAST((2 * sum(r6) + count(r6)) // (2 * nullif(count(r6), 0)) AS DOUBLE) / 1000000",
    "safe_winner_to_budget_ratio_min": "CAST(min(r6) AS DOUBLE) / 1000000",
    "safe_winner_to_budget_ratio_max": "CAST(max(r6) AS DOUBLE) / 1000000",
    "near_budget_limit_count": _count(_NEAR),
    "near_budget_limit_rate": _rate(_count(_NEAR), "count(r6)"),
    "winner_value_gt_budget_count": _count(_OVER),
    "winner_value_gt_budget_rate": _rate(_count(_OVER), "count(r6)"),
    "purchase_tickets_count": _count("tickets"),
    "purchase_tickets_total_winner_value": _subset("winner_value_amount", "tickets"),
    "zero_budget_with_winner_value_count": _count(_ZERO),
    "zero_budget_with_winner_value_rate": _rate(_count(_ZERO), "count(*)"),
    "has_small_value_procedures": "coalesce(bool_or(contains(lower(procedure_type), 'small value')), false)",
    "has_open_local_procedures": "coalesce(bool_or(contains(lower(procedure_type), 'open local')), false)",
    "rows_with_winner_value_count": "count(winner_value_amount)",
    "rows_with_budget_count": "count(budget_limit_amount)",
    "rows_with_valid_ratio_count": "count(r6)",
}


def _main(*names: str) -> str:
    return f"WITH {KEYED} SELECT company_nipt, " + ", ".join(f"{MAIN_SQL[n]} AS {n}" for n in names) + " FROM k GROUP BY company_nipt"


MAIN_QUERIES = {
    "d01_d02_entity_counts": ("source_row_count", "source_snapshot_count", "source_structured_record_ids"),
    "b06_d03_conditional_counts": ("active_procurement_count", "cancelled_procurement_count", "suspended_procurement_count", "purchase_tickets_count", "zero_budget_with_winner_value_count"),
    "d04_half_up_rates": ("cancelled_procurement_rate", "suspended_procurement_rate", "near_budget_limit_rate", "winner_value_gt_budget_rate", "zero_budget_with_winner_value_rate"),
    "d05_h34_sums": ("total_budget_limit_amount", "total_winner_value_amount"),
    "d06_subset_sums": ("active_total_budget_limit_amount", "active_total_winner_value_amount", "cancelled_total_budget_limit_amount", "cancelled_total_winner_value_amount"),
    "b07_purchase_tickets": ("purchase_tickets_count", "purchase_tickets_total_winner_value"),
    "b08_d14_contains_any": ("has_small_value_procedures", "has_open_local_procedures"),
    "d07_safe_ratios": ("safe_winner_to_budget_ratio_avg", "safe_winner_to_budget_ratio_min", "safe_winner_to_budget_ratio_max"),
    "b09_d08_budget_proximity": ("near_budget_limit_count", "near_budget_limit_rate", "winner_value_gt_budget_count", "winner_value_gt_budget_rate"),
    "d09_support_counts": ("rows_with_winner_value_count", "rows_with_budget_count", "rows_with_valid_ratio_count"),
    "d13_h21_dates": ("first_procurement_date", "last_procurement_date", "first_procurement_year", "last_procurement_year", "active_year_span"),
}
for _name, _parts in MAIN_QUERIES.items():
    add(_name, lambda spark, sf_dir, parts=_parts: features.award_aggregates(_marked_awards(spark, sf_dir), ROLES, *parts), _main(*_parts))
add("e01_f01_latest_value", lambda s, d: features.newest_names(features.with_entity(_trusted_awards(s, d), ROLES.key), ROLES), _main("latest_winner_name"))


def _concentration_sql(column: str, p: str) -> str:
    return f"""{p}_counts AS (SELECT company_nipt, trim({column}) AS v, count(*) AS n FROM k WHERE trim({column}) <> '' GROUP BY ALL),
{p}_ranked AS (SELECT *, row_number() OVER (PARTITION BY company_nipt ORDER BY n DESC, lower(v), v) AS nth FROM {p}_counts),
{p} AS (SELECT company_nipt, max(v) FILTER (WHERE nth = 1) AS {p}_top, max(n) FILTER (WHERE nth = 1) AS {p}_top_count,
    CAST((2 * max(n) FILTER (WHERE nth = 1) * 1000000 + sum(n)) // (2 * sum(n)) AS DOUBLE) / 1000000 AS {p}_top_share,
    CAST((2 * sum(CAST(n AS HUGEINT) * n) * 1000000 + sum(n) * sum(n)) // (2 * sum(n) * sum(n)) AS DOUBLE) / 1000000 AS {p}_hhi, count(*) AS {p}_distinct
    FROM {p}_ranked GROUP BY company_nipt)"""


def _concentrations(spark, sf_dir, column: str, *names: str) -> DataFrame:
    own = features.with_entity(_trusted_awards(spark, sf_dir), ROLES.key)
    return features.concentration(own, column, "p").select(F.col("entity").alias("company_nipt"), *[f"p_{n}" for n in names])


for _name, _column, _parts in (
    ("d11_f02_top_category", "procedure_type", ("top", "top_count", "top_share")),
    ("d12_herfindahl", "contracting_authority", ("hhi",)),
    ("d10_distinct_categories", "procedure_type", ("distinct",)),
):
    add(_name, lambda spark, sf_dir, c=_column, parts=_parts: _concentrations(spark, sf_dir, c, *parts), f"WITH {KEYED}, {_concentration_sql(_column, 'p')} SELECT company_nipt, {', '.join(f'p_{n}' for n in _parts)} FROM p")

YEARS = """y AS (SELECT company_nipt, CAST(year(publication_date) AS BIGINT) AS year, count(*) AS n, sum(coalesce(a, 0)) AS v FROM k WHERE publication_date IS NOT NULL GROUP BY ALL)"""
GROWTH = f"""{YEARS},
l AS (SELECT *, lag(year) OVER w AS y0, lag(n) OVER w AS n0, lag(v) OVER w AS v0 FROM y WINDOW w AS (PARTITION BY company_nipt ORDER BY year)),
g AS (SELECT *, CASE WHEN v0 > 0 THEN (2 * v * 1000000 + v0) // (2 * v0) END AS vr, (2 * n * 1000000 + n0) // (2 * n0) AS nr FROM l WHERE year = y0 + 1),
j AS (SELECT company_nipt, count(*) FILTER (WHERE vr >= 3000000 AND v - v0 >= 10000000) AS yoy_value_jump_count, count(*) FILTER (WHERE nr >= 3000000 AND n - n0 >= 5) AS yoy_contract_count_jump_count,
             CAST(max(vr) AS DOUBLE) / 1000000 AS max_yoy_value_growth_ratio, CAST(max(nr) AS DOUBLE) / 1000000 AS max_yoy_contract_count_growth_ratio FROM g GROUP BY company_nipt)"""


def _years(spark, sf_dir) -> DataFrame:
    return features.yearly(features.with_entity(_trusted_awards(spark, sf_dir), ROLES.key), ROLES.date, ROLES.award)


add("d16_year_buckets", lambda s, d: _years(s, d).select(F.col("entity").alias("company_nipt"), F.col("year").cast("long").alias("year"), "n", F.col("value").alias("v")), f"WITH {KEYED}, {YEARS} SELECT company_nipt, year, n, CAST(v AS DOUBLE) / 100 AS v FROM y")
add("e03_consecutive_growth", lambda s, d: features.growth(_years(s, d)).select(F.col("entity").alias("company_nipt"), "year", "value_ratio", "count_ratio"), f"WITH {KEYED}, {GROWTH} SELECT company_nipt, year, CAST(vr AS DOUBLE) / 1000000 AS value_ratio, CAST(nr AS DOUBLE) / 1000000 AS count_ratio FROM g")
add("d17_growth_jumps", lambda s, d: features.jumps(_years(s, d)).withColumnRenamed("entity", "company_nipt"), f"WITH {KEYED}, {GROWTH} SELECT * FROM j")


def award_features(spark, sf_dir, names: bool = True) -> DataFrame:
    """`names`: whether latest_winner_name is among them."""
    roles = ROLES if names else features.AwardRoles(newest=())
    left = [] if names else [roles.name]
    marks = features.procedure_marks(roles)
    rows = views.trusted_awards(spark, sf_dir, of_parts=marks, keyed=True).select(*[c for c in features.award_columns(roles) if c not in left], *marks)
    return features.award_features(written(rows, "awards"), roles, names)


FEATURES_SQL = f"""{KEYED}, {_concentration_sql("contracting_authority", "a")}, {_concentration_sql("procedure_type", "p")}, {GROWTH},
c AS (SELECT company_nipt, count(DISTINCT trim(contract_type)) AS c_distinct FROM k WHERE trim(contract_type) <> '' GROUP BY company_nipt),
m AS (SELECT company_nipt, {", ".join(f"{e} AS {n}" for n, e in MAIN_SQL.items())} FROM k GROUP BY company_nipt),
features AS (SELECT m.*, coalesce(a_distinct, 0) AS distinct_contracting_authority_count, coalesce(p_distinct, 0) AS distinct_procedure_type_count, coalesce(c_distinct, 0) AS distinct_contract_type_count,
  a_top AS top_authority_name, coalesce(a_top_count, 0) AS top_authority_count, a_top_share AS top_authority_share, a_hhi AS authority_hhi,
  p_top AS top_procedure_type, coalesce(p_top_count, 0) AS top_procedure_type_count, p_top_share AS top_procedure_type_share, p_hhi AS procedure_type_hhi,
  coalesce(yoy_value_jump_count, 0) AS yoy_value_jump_count, coalesce(yoy_contract_count_jump_count, 0) AS yoy_contract_count_jump_count, max_yoy_value_growth_ratio, max_yoy_contract_count_growth_ratio
  FROM m LEFT JOIN a USING (company_nipt) LEFT JOIN p USING (company_nipt) LEFT JOIN c USING (company_nipt) LEFT JOIN j USING (company_nipt))"""
add("i04_award_features", award_features, f"WITH {FEATURES_SQL} SELECT * FROM features")
add("b05_skipped_rows", lambda s, d: features.skipped_rows(_trusted_awards(s, d), ROLES.key), f"WITH {KEYED} SELECT count(*) FILTER (WHERE winner_nipt IS NULL OR winner_nipt = '') AS groups_skipped, count(*) AS source_rows_seen FROM ok")


def trusted_registry(spark, sf_dir) -> DataFrame:
    return views.trusted_registry(spark, sf_dir)


def registry_features(spark, sf_dir) -> DataFrame:
    return features.registry_features(views.trusted_registry(spark, sf_dir, keyed=True), REGISTRY_ROLES)


_ORDER = "coalesce(strftime(search_date_to, '%Y%m%d'), '0') || '-' || lpad(CAST(o_orderkey AS STRING), 12, '0')"
REGISTRY_FEATURES_SQL = f"""registry AS ({views.REGISTRY_SQL}),
rk AS (SELECT registry.*, upper(trim(business_nipt)) AS company_nipt, {_ORDER} AS o FROM registry LEFT JOIN raw ON raw_fetch_id = id WHERE (raw_fetch_id IS NULL OR is_corrupted IS FALSE) AND business_nipt <> ''),
rn AS (SELECT * FROM rk QUALIFY row_number() OVER (PARTITION BY company_nipt ORDER BY o DESC) = 1),
rf AS (SELECT company_nipt, count(*) AS source_row_count, count(DISTINCT structured_record_id) AS source_snapshot_count,
  array_to_string(list_sort(list(DISTINCT structured_record_id)), ',') AS source_structured_record_ids,
  {", ".join(f"arg_max(trim({c}), o) FILTER (WHERE trim({c}) <> '') AS {c}" for c in REGISTRY_ROLES.latest)},
  coalesce(bool_or(trim(activity_text) <> ''), false) AS has_activity_text, coalesce(bool_or(trim(ownership_text) <> ''), false) AS has_ownership_text,
  min(search_date_from) AS search_window_start, max(search_date_to) AS search_window_end FROM rk GROUP BY company_nipt),
registry_features AS (SELECT rf.*, rn.registration_date, CAST(year(rn.registration_date) AS BIGINT) AS registration_year, rn.has_red_flags FROM rf JOIN rn USING (company_nipt))"""
add("e02_d15_registry_features", registry_features, f"WITH raw AS ({views.RAW_SQL}), {REGISTRY_FEATURES_SQL} SELECT * FROM registry_features")


def joined_features(spark, sf_dir) -> DataFrame:
    return entity_join.joined_features(award_features(spark, sf_dir, names=False), registry_features(spark, sf_dir))


_DROPPED = ", ".join(entity_join.LEFT_OUT)
JOINED_SQL = f"""joined AS (SELECT f.* EXCLUDE ({_DROPPED}, source_snapshot_count, source_structured_record_ids), f.source_snapshot_count AS app_source_snapshot_count, f.source_structured_record_ids AS app_structured_record_ids,
  r.source_row_count AS qkb_source_row_count, r.source_snapshot_count AS qkb_source_snapshot_count, r.source_structured_record_ids AS qkb_structured_record_ids, {", ".join(f"r.{c}" for c in entity_join.REGISTRY)},
  f.source_row_count AS app_source_row_count, true AS exact_join_match, CAST(f.first_procurement_date - r.registration_date AS BIGINT) AS company_age_days_at_first_procurement, CAST(f.last_procurement_date - r.registration_date AS BIGINT) AS company_age_days_at_last_procurement
  FROM features f JOIN registry_features r USING (company_nipt) WHERE company_nipt <> '')"""
add("c02_h20_joined_features", joined_features, f"WITH {FEATURES_SQL}, {REGISTRY_FEATURES_SQL}, {JOINED_SQL} SELECT * FROM joined")
add("c02_join_skips", lambda s, d: entity_join.join_skips(features.entities(_trusted_awards(s, d), ROLES.key), features.entities(trusted_registry(s, d), REGISTRY_ROLES.key)), f"WITH {FEATURES_SQL}, {REGISTRY_FEATURES_SQL} SELECT count(*) AS groups_skipped FROM features WHERE company_nipt NOT IN (SELECT company_nipt FROM registry_features)")


def candidate_pairs(spark, sf_dir) -> DataFrame:
    a = views.awards(spark, sf_dir).select("winner_nipt", "winner_name", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    r = views.registry(spark, sf_dir).select("business_nipt", "business_name", "o_orderkey")
    pairs = a.join(r, F.col("l_orderkey") == F.col("o_orderkey"))
    return pairs.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", entity_join.assess(F.col("winner_nipt"), F.col("business_nipt"), F.col("winner_name"), F.col("business_name")).alias("v")).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "v.status", "v.reason")


add("c03_join_assessment", candidate_pairs, f"""WITH awards AS ({views.AWARDS_SQL}), registry AS ({views.REGISTRY_SQL}),
p AS (SELECT *, nullif(upper(trim(winner_nipt)), '') AS x, nullif(upper(trim(business_nipt)), '') AS y, nullif(trim(winner_name), '') AS xn, nullif(trim(business_name), '') AS yn FROM awards JOIN registry ON l_orderkey = o_orderkey)
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, CASE WHEN x = y THEN 'safe' WHEN x IS NOT NULL AND y IS NOT NULL THEN 'avoid' WHEN xn IS NOT NULL AND yn IS NOT NULL THEN 'caution' ELSE 'avoid' END AS status,
 CASE WHEN x = y THEN 'exact_nipt' WHEN x IS NOT NULL AND y IS NOT NULL THEN 'nipt_conflict' WHEN xn IS NOT NULL AND yn IS NOT NULL THEN 'manual_name_review_only' ELSE 'insufficient_identifier' END AS reason FROM p""")
