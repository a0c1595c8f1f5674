"""Profiles of tables: missing values, key coverage, frequencies, join coverage, readiness. Reports are tall frames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tendril.functions.rounding import profile_rate
from tendril.functions.text import canonical_legal_form, compact_text, normalized_key, strip

READY = 0.75


def is_missing(column: str, kind: T.DataType) -> Column:
    """Null, a blank string or an empty collection."""
    c = F.col(column)
    if isinstance(kind, T.StringType):
        return c.isNull() | (strip(c) == "")
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return c.isNull() | (F.size(c) == 0)
    return c.isNull()


def field_profile(df: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Of each field: rows, present and missing values and their rates. One pass over the table."""
    fields = fields or df.columns
    kinds = {f.name: f.dataType for f in df.schema.fields}
    one = df.agg(F.count(F.lit(1)).alias("__total"), *[F.count_if(is_missing(f, kinds[f])).alias(f) for f in fields])
    tall = one.select("__total", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("missing_count")) for f in fields])).alias("x"))
    total, missing = F.col("__total"), F.col("x.missing_count")
    return tall.select(F.col("x.field").alias("field"), total.alias("total_rows"), (total - missing).alias("present_count"), missing.alias("missing_count"), profile_rate(total - missing, total).alias("present_rate"), profile_rate(missing, total).alias("missing_rate"))


def key_coverage(df: DataFrame, key: str) -> DataFrame:
    present = normalized_key(F.col(key)).isNotNull()
    one = df.agg(F.count(F.lit(1)).alias("total_rows"), F.count_if(present).alias("present_count"))
    missing = F.col("total_rows") - F.col("present_count")
    return one.select("*", missing.alias("missing_count"), profile_rate(F.col("present_count"), F.col("total_rows")).alias("present_rate"), profile_rate(missing, F.col("total_rows")).alias("missing_rate"))


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(normalized_key(F.col(key)).alias("key")).where("key is not null").distinct()


def frequencies(df: DataFrame, value: Column, name: str) -> DataFrame:
    """Values, null among them, with counts and rates. The total is that of the counts, so the table is read once."""
    return _rated(df.groupBy(value.alias(name)).agg(F.count(F.lit(1)).alias("count"))).select(name, "count", "rate")


def _rated(counts: DataFrame, *per: str) -> DataFrame:
    """Adds each count's rate of the total, a one-row (or one row per `per`) aggregate of the counts that is joined."""
    own = counts.withColumn("__of", F.struct(*per) if per else F.lit(1))
    totals = own.groupBy("__of").agg(F.sum("count").alias("__total"))
    return own.join(F.broadcast(totals), "__of").withColumn("rate", profile_rate(F.col("count"), F.col("__total")))


def join_coverage(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """Keys in both tables, and rows of each whose key is: rates over all rows and over rows with a key. Rows are
    counted per key first, so no row is joined."""
    count = lambda df, key, name: df.groupBy(normalized_key(F.col(key)).alias("key")).agg(F.count(F.lit(1)).alias(name))
    a, b = count(left, left_key, "a"), count(right, right_key, "b")
    per_key = a.join(b, "key", "full")  # null keys match nothing but count as rows
    both, keyed = F.col("a").isNotNull() & F.col("b").isNotNull(), F.col("key").isNotNull()
    one = per_key.agg(
        F.count_if(both).alias("joinable_keys"), F.sum(F.when(both, F.col("a"))).alias("a"), F.sum(F.when(both, F.col("b"))).alias("b"),
        F.sum(F.when(keyed, F.col("a"))).alias("keyed_a"), F.sum(F.when(keyed, F.col("b"))).alias("keyed_b"), F.sum("a").alias("rows_a"), F.sum("b").alias("rows_b"),
    ).fillna(0)
    return one.select(
        "joinable_keys", F.col("a").alias("left_rows_joinable"), F.col("b").alias("right_rows_joinable"), profile_rate(F.col("a"), F.col("rows_a")).alias("left_rate_all"), profile_rate(F.col("a"), F.col("keyed_a")).alias("left_rate_keyed"),
        profile_rate(F.col("b"), F.col("rows_b")).alias("right_rate_all"), profile_rate(F.col("b"), F.col("keyed_b")).alias("right_rate_keyed"),
    )


def legal_form_profile(df: DataFrame, form: str, key: str) -> DataFrame:
    """Totals: rows, keys, missing forms, SHPK and other rows with rates."""
    shpk = F.coalesce(canonical_legal_form(F.col(form)) == "SHPK", F.lit(False))
    marked = df.select(compact_text(F.col(form)).alias("f"), shpk.alias("s"), normalized_key(F.col(key)).alias("k"))
    one = marked.agg(F.count(F.lit(1)).alias("total_rows"), F.count_distinct("k").alias("distinct_keys"), F.count_if(F.col("f").isNull()).alias("missing_legal_form_count"), F.count_if("s").alias("shpk_count"))
    other = F.col("total_rows") - F.col("shpk_count")
    return one.select("*", other.alias("non_shpk_count"), profile_rate(F.col("shpk_count"), F.col("total_rows")).alias("shpk_rate"), profile_rate(other, F.col("total_rows")).alias("non_shpk_rate"))


def legal_form_counts(df: DataFrame, form: str) -> DataFrame:
    """Frequencies of raw and canonical forms, `level` telling which: raw forms are counted in one pass, and canonical
    ones are sums of those."""
    raw = df.groupBy(compact_text(F.col(form)).alias("raw")).agg(F.count(F.lit(1)).alias("count"))
    both = raw.select("count", F.explode(F.create_map(F.lit("raw"), F.col("raw"), F.lit("canonical"), canonical_legal_form(F.col("raw")))).alias("level", "legal_form"))
    return _rated(both.groupBy("level", "legal_form").agg(F.sum("count").alias("count")), "level").select("level", "legal_form", "count", "rate")


def feature_profile(df: DataFrame, registry: DataFrame, dataset: str) -> DataFrame:
    """Missing values of a dataset's registered features beside their category, confidence and description."""
    own = registry.where(F.col("dataset") == dataset)
    names = [r.name for r in own.select("name").collect()]  # the dictionary's, at most a hundred or so
    return field_profile(df, names).join(F.broadcast(own), F.col("field") == F.col("name")).select("dataset", "name", "category", "confidence", "description", "present_count", "missing_count", "present_rate", "missing_rate")


def readiness(rows: Column, coverage: Column) -> Column:
    return F.when(rows == 0, "blocked").when(coverage >= READY, "usable_now").otherwise("usable_with_caution")


def feature_readiness(profile: DataFrame) -> DataFrame:
    """By dataset: rows, the mean present rate of safe features (rounded half-even) and the verdict."""
    rows = F.max(F.col("present_count") + F.col("missing_count"))
    one = profile.groupBy("dataset").agg(rows.alias("row_count"), F.coalesce(F.bround(F.avg(F.when(F.col("confidence") == "safe", F.col("present_rate"))), 4), F.lit(0.0)).alias("safe_coverage"))
    return one.withColumn("status", readiness(F.col("row_count"), F.col("safe_coverage")))


# Section, condition on the metrics, finding.
RULES = (
    ("strengths", "award_rows > 0", "award rows are present"),
    ("strengths", "date_present_rate > 0.9", "publication dates are mostly there"),
    ("strengths", "registry_rows > 0", "registry rows are present"),
    ("usable_feature_families_now", "award_entities > 0", "award features"),
    ("usable_feature_families_now", "registry_entities > 0", "registry features"),
    ("usable_feature_families_now", "joined_entities > 0", "joined features"),
    ("weaknesses", "key_missing_rate > 0.1", "many award rows lack a key"),
    ("blockers", "registry_rows = 0", "no registry rows"),
    ("weaknesses", "registry_rows > 0 and registry_rows < 25", "few registry rows"),
    ("blockers", "joinable_keys = 0", "no key in both tables"),
    ("weaknesses", "joinable_keys > 0 and joinable_keys < 10", "few keys in both tables"),
    ("priority_backfill_actions", "joinable_keys = 0", "search the registry for award keys"),
    ("priority_backfill_actions", "key_missing_rate > 0.1", "look into missing award keys"),
    ("priority_backfill_actions", "registration_missing_rate > 0.2", "collect registration dates"),
    ("priority_backfill_actions", "joined_entities = 0", "hold joined analysis back"),
)


def findings(metrics: DataFrame) -> DataFrame:
    """One row of metrics -> section, finding of each rule that holds."""
    held = [F.when(F.expr(rule), F.struct(F.lit(section).alias("section"), F.lit(text).alias("finding"))) for section, rule, text in RULES]
    return metrics.select(F.explode(F.array_compact(F.array(*held))).alias("x")).select("x.*")
