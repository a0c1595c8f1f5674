"""Queries for the scalar functions, over messy texts made from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tendril.functions import rounding, text
from tendril.plans import views
from tendril.plans.feature_queries import plain

QUERIES: dict = {}
SQL: dict[str, str] = {}

_DAY = "lpad(CAST(day(o_orderdate) AS STRING), 2, '0')"
_MONTH = "lpad(CAST(month(o_orderdate) AS STRING), 2, '0')"
_YEAR = "CAST(year(o_orderdate) AS STRING)"
_NIPT = "concat('k', lpad(CAST(o_custkey AS STRING), 8, '0'), 'a')"
MESSY = {
    "o_orderkey": "o_orderkey",
    "day_text": f"CASE o_orderkey % 9 WHEN 0 THEN concat({_DAY}, '.', {_MONTH}, '.', {_YEAR}) WHEN 1 THEN concat(' ', {_DAY}, '/', {_MONTH}, '/', {_YEAR}) WHEN 2 THEN concat({_YEAR}, '-', {_MONTH}, '-', {_DAY}) WHEN 3 THEN concat('31.02.', {_YEAR}) WHEN 4 THEN 'n/a' WHEN 5 THEN '  ' WHEN 6 THEN concat({_DAY}, '-', {_MONTH}, '-', {_YEAR}) WHEN 7 THEN concat(CAST(day(o_orderdate) AS STRING), '.', CAST(month(o_orderdate) AS STRING), '.', {_YEAR}) ELSE NULL END",
    "amount_text": "CASE o_orderkey % 6 WHEN 0 THEN concat(CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS STRING), ',', lpad(CAST(CAST(floor(o_totalprice) AS BIGINT) % 1000 AS STRING), 3, '0'), '.50') WHEN 1 THEN CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) WHEN 2 THEN ' 12,5 ' WHEN 3 THEN 'abc' WHEN 4 THEN '' ELSE concat('-', CAST(o_custkey AS STRING), '.1') END",
    "flag_text": "CASE o_orderkey % 8 WHEN 0 THEN 'Po' WHEN 1 THEN ' JO ' WHEN 2 THEN 'yes' WHEN 3 THEN 'false' WHEN 4 THEN 'TRUE' WHEN 5 THEN 'maybe' WHEN 6 THEN '' ELSE NULL END",
    "padded": "CASE o_orderkey % 5 WHEN 0 THEN concat('  ', o_orderpriority, '  ') WHEN 1 THEN '   ' WHEN 2 THEN NULL ELSE concat(o_orderpriority, ' ') END",
    "ids_text": f"CASE o_orderkey % 6 WHEN 0 THEN {_NIPT} WHEN 1 THEN concat({_NIPT}, '; L12345678B, ', upper({_NIPT})) WHEN 2 THEN concat('x', {_NIPT}) WHEN 3 THEN concat('NIPT:', upper({_NIPT}), '.') WHEN 4 THEN '' ELSE NULL END",
    "form": views.REGISTRY["legal_form"].replace("c_mktsegment", "o_orderpriority"),
    "file_name": "CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN concat('export ', o_orderpriority, '.csv') WHEN 2 THEN 'noext' WHEN 3 THEN 'a.b.pdf' ELSE concat('x', CAST(o_orderkey AS STRING), '.json') END",
    "content_type": "CASE o_orderkey % 4 WHEN 0 THEN 'text/csv' WHEN 1 THEN 'application/pdf; q=1' WHEN 2 THEN NULL ELSE 'text/html' END",
    "url": "CASE o_orderkey % 7 WHEN 0 THEN 'https://x.al/a.csv' WHEN 1 THEN 'https://x.al/a.json' ELSE concat('https://x.al/', CAST(o_orderkey AS STRING)) END",
    "o_orderdate": "o_orderdate",
    "region": "CASE o_orderkey % 4 WHEN 0 THEN concat(' ', o_orderpriority, ' ') WHEN 1 THEN '--' ELSE NULL END",
    "nipt": f"CASE WHEN o_orderkey % 10 = 0 THEN upper({_NIPT}) WHEN o_orderkey % 10 = 1 THEN '' ELSE NULL END",
    "from_day": "CASE WHEN o_orderkey % 12 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END",
    "until_day": "CASE WHEN o_orderkey % 14 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) + 1 END",
    "doc_type": "CASE o_orderkey % 5 WHEN 0 THEN ' Historical ' WHEN 1 THEN 'simple' WHEN 2 THEN 'RPP' WHEN 3 THEN 'other' ELSE NULL END",
    "issue": "CASE o_orderkey % 4 WHEN 0 THEN 'missing_file' WHEN 1 THEN 'content_hash_mismatch' WHEN 2 THEN 'bad_page_body' ELSE NULL END",
    "o_orderstatus": "o_orderstatus", "o_custkey": "o_custkey", "o_orderpriority": "o_orderpriority",
}
MESSY_SQL = f"m AS (SELECT {', '.join(f'{e} AS {n}' for n, e in MESSY.items())} FROM orders)"
_STRIP = r"regexp_replace({0}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"


def _strip(x: str) -> str:
    return _STRIP.format(x)


def _compact(x: str) -> str:
    return f"nullif({_strip(x)}, '')"


def _label(x: str) -> str:
    return f"nullif(trim(regexp_replace(upper(strip_accents({x})), '[^A-Z0-9]+', ' ', 'g')), '')"


def _form(x: str) -> str:
    n = _label(x)
    return f"CASE WHEN replace({n}, ' ', '') = 'SHPK' OR {n} = '{text.SHPK_LONG}' THEN 'SHPK' WHEN replace({n}, ' ', '') = 'SHA' OR {n} = '{text.SHA_LONG}' THEN 'SHA' ELSE {n} END"


def _slug(x: str) -> str:
    return f"coalesce(nullif(regexp_replace(regexp_replace(upper(coalesce({x}, '')), '[^A-Z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'UNKNOWN')"


def add(name: str, columns, sql: dict[str, str], where: str = "true") -> None:
    def build(spark, sf_dir):
        messy = views.read(spark, sf_dir, "orders").selectExpr(*[f"{e} AS {n}" for n, e in MESSY.items()]).where(where)
        return plain(messy.select("o_orderkey", *[v.alias(n) for n, v in columns().items()]))

    QUERIES[name] = build
    SQL[name] = f"WITH {MESSY_SQL} SELECT o_orderkey, {', '.join(f'{e} AS {n}' for n, e in sql.items())} FROM m WHERE {where}"


c = F.col
add("h01_h35_compact_text", lambda: {"v": text.compact_text(c("padded")), "n": F.length(text.strip(c("padded")))}, {"v": _compact("padded"), "n": f"length({_strip('padded')})"})
_d = _compact("day_text")
add("h02_h29_dates", lambda: {"v": text.parse_date(c("day_text")), "shown": text.form_date(text.parse_date(c("day_text")))},
    {"v": f"CAST(coalesce(try_strptime({_d}, '%d.%m.%Y'), try_strptime({_d}, '%d/%m/%Y'), try_strptime({_d}, '%Y-%m-%d')) AS DATE)", "shown": f"strftime(coalesce(try_strptime({_d}, '%d.%m.%Y'), try_strptime({_d}, '%d/%m/%Y'), try_strptime({_d}, '%Y-%m-%d')), '%d/%m/%Y')"})
add("h03_decimals", lambda: {"v": text.parse_decimal(c("amount_text"))}, {"v": f"CAST(TRY_CAST(replace({_compact('amount_text')}, ',', '') AS DECIMAL(18,2)) AS DOUBLE)"})
add("h04_h05_flags", lambda: {"v": text.parse_flag(c("flag_text"))}, {"v": f"CASE WHEN lower({_compact('flag_text')}) IN ('po', 'yes', 'true') THEN true WHEN lower({_compact('flag_text')}) IN ('jo', 'no', 'false') THEN false END"})
_ids = r"list_distinct(list_transform(regexp_extract_all(coalesce(ids_text, ''), '(?i)\b[A-Z][0-9]{8}[A-Z]\b'), lambda x: upper(x)))"
add("h06_h07_identifiers", lambda: {"ids": F.sort_array(text.identifiers(c("ids_text"))), "single": text.single_identifier(c("ids_text"))}, {"ids": f"coalesce(array_to_string(list_sort({_ids}), ','), '')", "single": f"CASE WHEN len({_ids}) = 1 THEN {_ids}[1] END"})
add("h08_h11_legal_forms", lambda: {"plain": text.strip_accents(c("form")), "label": text.label_text(c("form")), "canonical": text.canonical_legal_form(c("form")), "official": text.official_legal_form(c("form")), "is_shpk": F.coalesce(text.canonical_legal_form(c("form")) == "SHPK", F.lit(False))},
    {"plain": "strip_accents(form)", "label": _label("form"), "canonical": _form("form"), "official": f"CASE {_form('form')} WHEN 'SHPK' THEN '{text.SHPK_OFFICIAL}' WHEN 'SHA' THEN '{text.SHA_OFFICIAL}' ELSE {_compact('form')} END", "is_shpk": f"coalesce({_form('form')} = 'SHPK', false)"})
_ext = "CASE WHEN ends_with(coalesce(url, ''), '.csv') OR contains(coalesce(content_type, ''), 'csv') THEN '.csv' WHEN ends_with(coalesce(url, ''), '.pdf') OR contains(coalesce(content_type, ''), 'pdf') THEN '.pdf' WHEN ends_with(coalesce(url, ''), '.json') OR contains(coalesce(content_type, ''), 'json') THEN '.json' ELSE '.html' END"
_hash = "sha256(url)"
add("h12_h15_storage_names", lambda: {"digest": F.sha2("url", 256), "ext": text.extension(c("content_type"), c("url")), "name": text.storage_name(F.sha2("url", 256), text.extension(c("content_type"), c("url")), c("file_name")), "folder": text.storage_partition(F.lit("src"), c("o_orderdate"), F.lit("page"))},
    {"digest": _hash, "ext": _ext, "name": f"CASE WHEN file_name IS NULL THEN {_hash} || {_ext} ELSE regexp_extract(file_name, '^(.+?)(\\.[^.]+)?$', 1) || '-' || {_hash} || coalesce(nullif(regexp_extract(file_name, '^.+?(\\.[^.]+)$', 1), ''), {_ext}) END", "folder": "'src/' || strftime(o_orderdate, '%Y/%m/%d') || '/page'"})
_fields = lambda: F.when(c("region").isNotNull(), F.array(F.struct(F.lit("qarku").alias("name"), c("region").alias("value"))))
add("h16_h17_snapshot_keys", lambda: {"k": text.snapshot_key(c("nipt"), c("form"), _fields(), c("from_day"), c("until_day")), "slug": text.slug(c("region"))},
    {"k": f"concat_ws('|', coalesce(nullif(concat_ws('|', nullif(nipt, ''), CASE WHEN coalesce(form, '') <> '' THEN 'legal_form:' || coalesce({_form('form')}, {_strip('form')}) END, CASE WHEN region IS NOT NULL THEN 'qarku:' || {_slug('region')} END), ''), 'all'), coalesce(CAST(from_day AS STRING), 'none'), coalesce(CAST(until_day AS STRING), 'none'))", "slug": _slug("region")})
_longq = "concat(o_orderpriority, ' ', repeat('long name ', CAST(o_orderkey % 6 AS BIGINT)))"
_name = f"coalesce(nullif(regexp_replace(upper({_longq}), '[^A-Z0-9]+', '', 'g'), ''), 'UNKNOWN')"
add("h18_run_modes", lambda: {"v": text.run_mode(F.concat(c("o_orderpriority"), F.lit(" "), F.repeat(F.lit("long name "), (c("o_orderkey") % 6).cast("int"))))}, {"v": f"CASE WHEN length({_name}) + 17 <= 50 THEN 'daily_legal_form:' || {_name} ELSE 'daily_legal_form:' || left({_name}, 24) || '-' || left(sha1({_longq}), 8) END"})
_parse = lambda x: f"CAST(try_strptime(regexp_extract({x}, '(\\d{{1,2}})[./-](\\d{{1,2}})[./-](\\d{{4}})', 3) || '-' || regexp_extract({x}, '(\\d{{1,2}})[./-](\\d{{1,2}})[./-](\\d{{4}})', 2) || '-' || regexp_extract({x}, '(\\d{{1,2}})[./-](\\d{{1,2}})[./-](\\d{{4}})', 1), '%Y-%m-%d') AS DATE)"
_dated = lambda before, after: text.embedded_date(F.concat(F.lit(before), F.trim(c("day_text")), F.lit(after)))
add("h22_embedded_dates", lambda: {"v": text.embedded_date(F.concat(F.lit("Njoftim "), c("day_text"), F.lit(" - fund"))), "glued_before": _dated("Njoftim 12", " - fund"), "glued_after": _dated("Njoftim ", "1 fund"), "later": _dated("nr. 123.04.20201 dt", " pa, 05.06.2019.")},
    {"v": _parse("('Njoftim ' || day_text || ' - fund')"), "glued_before": "NULL", "glued_after": "NULL", "later": "CASE WHEN day_text IS NOT NULL THEN DATE '2019-06-05' END"})
add("h26_h31_kinds_and_reasons", lambda: {"kind": text.document_kind(c("doc_type")), "reason": text.corruption_reason(c("issue")), "part": text.safe_file_part(c("file_name"))},
    {"kind": f"CASE lower({_compact('doc_type')}) WHEN 'simple' THEN 'simple_extract_pdf' WHEN 'historical' THEN 'historical_extract_pdf' WHEN 'rpp' THEN 'rpp_pdf' END", "reason": "CASE issue WHEN 'content_hash_mismatch' THEN 'content_hash mismatch' WHEN 'missing_file' THEN 'missing file' ELSE replace(issue, '_', ' ') END",
     "part": f"coalesce(nullif(regexp_replace(regexp_replace({_strip('file_name')}, '[^A-Za-z0-9_-]+', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'document')"})
add("h20_h36_days_and_ranges", lambda: {"days": F.datediff("until_day", "from_day"), "ranged": text.is_ranged_search(c("nipt"), c("from_day"), c("until_day"))}, {"days": "CAST(until_day - from_day AS BIGINT)", "ranged": "nipt IS NULL AND from_day IS NOT NULL AND until_day IS NOT NULL"})
add("h27_h28_keys_and_rates", lambda: {"k": text.normalized_key(c("padded")), "r": rounding.profile_rate(c("o_orderkey") % 97, c("o_custkey") % 13)}, {"k": f"nullif(upper({_strip('padded')}), '')", "r": "CASE WHEN o_custkey % 13 > 0 THEN round_even(CAST(o_orderkey % 97 AS DOUBLE) / (o_custkey % 13), 4) ELSE 0.0 END"})
