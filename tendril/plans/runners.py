"""Whole runs: everything normalized, all features, all profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tendril.operators import entity_join, features, materialize, profile
from tendril.operators.trust import trusted
from tendril.sources.scratch import written


def features_all(awards: DataFrame, registry: DataFrame, raw: DataFrame, roles: features.AwardRoles | None = None, registry_roles: features.RegistryRoles | None = None) -> dict[str, DataFrame]:
    """The three feature tables over trusted rows; the joined one reuses the other two."""
    roles = roles or features.AwardRoles()
    own = features.award_features(written(trusted(awards, raw).select(*features.award_columns(roles)), "awards"), roles)
    companies = features.registry_features(trusted(registry, raw), registry_roles)
    return {"app_company_features": own, "qkb_company_features": companies, "joined_company_features": entity_join.joined_features(own, companies)}


def normalize_all(exports: DataFrame, registry: DataFrame, raw: DataFrame, files: DataFrame, rows: DataFrame, target: str) -> dict[str, DataFrame]:
    """Both sources' snapshots into tables below target; dataset -> outcomes of its snapshots. exports, raw, files and rows
    are as judged_exports and export_table take them, registry as judged_registry."""
    own = written(materialize.judged_exports(exports, raw, files), "judged-exports")
    companies = written(materialize.judged_registry(registry, raw), "judged-registry")
    tables = {"app_exports": (own, materialize.export_table(own, rows)), "qkb_search": (companies, materialize.registry_table(companies))}
    return {name: materialize.materialize(judged, found, f"{target}/{name}") for name, (judged, found) in tables.items()}


def tall(df: DataFrame, section: str, dataset: str, field=None) -> DataFrame:
    """A frame of numbers -> section, dataset, field, metric, value. `field` names each row, by a column or a text."""
    metrics = [c for c in df.columns if c != field]
    name = F.col(field) if field in df.columns else F.lit(field or "")
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]))
    return df.select(F.lit(section).alias("section"), F.lit(dataset).alias("dataset"), name.alias("field"), pairs.alias("x")).select("section", "dataset", "field", "x.metric", "x.value")


def normalized_profile(tables: dict[str, tuple[DataFrame, str, list[str]]]) -> DataFrame:
    """tables: dataset -> rows, key, important fields; two of them -> row counts, missing values, key coverage, distinct
    keys and join coverage, as one tall report."""
    parts = []
    for name, (df, key, fields) in tables.items():
        parts += [tall(profile.field_profile(df, fields), "missingness", name, "field"), tall(profile.key_coverage(df, key), "key_coverage", name, key), tall(profile.distinct_keys(df, key).agg(F.count(F.lit(1)).alias("distinct_keys")), "keys", name, key)]
    (_, (a, a_key, _)), (_, (b, b_key, _)) = tables.items()
    parts.append(tall(profile.join_coverage(a, a_key, b, b_key), "join_coverage", "both", f"{a_key} = {b_key}"))
    return reduce(DataFrame.union, parts)


def profile_all(normalized: DataFrame, sparsity: DataFrame, metrics: DataFrame) -> DataFrame:
    """One report: the normalized profile, missing values and readiness of the feature tables (sparsity: feature_profile of
    each), and the findings of the metrics. section, dataset, field, metric, value, and text where there is no number."""
    state = profile.feature_readiness(sparsity)
    numbers = [("feature_sparsity", sparsity, "name", ["present_count", "missing_count", "present_rate", "missing_rate"]), ("readiness", state, None, ["row_count", "safe_coverage"])]
    parts = [normalized]
    for section, df, field, names in numbers:
        pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names]))
        parts.append(df.select(F.lit(section).alias("section"), "dataset", (F.col(field) if field else F.lit("")).alias("field"), pairs.alias("x")).select("section", "dataset", "field", "x.metric", "x.value"))
    texts = [state.select(F.lit("readiness").alias("section"), "dataset", F.lit("").alias("field"), F.lit("status").alias("metric"), F.col("status").alias("text")), profile.findings(metrics).select("section", F.lit("all").alias("dataset"), F.lit("").alias("field"), F.lit("finding").alias("metric"), F.col("finding").alias("text"))]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [*parts, *texts])
