"""Joining entities of two sources under a policy that allows exact keys only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tendril.functions.text import compact_text, normalized_key
from tendril.plans.metadata import JOIN_POLICY

LEFT_OUT = (
    "latest_winner_name near_budget_limit_count near_budget_limit_rate winner_value_gt_budget_count winner_value_gt_budget_rate"
    " top_authority_name top_authority_count top_authority_share authority_hhi top_procedure_type top_procedure_type_count"
    " top_procedure_type_share procedure_type_hhi yoy_value_jump_count yoy_contract_count_jump_count max_yoy_value_growth_ratio"
    " max_yoy_contract_count_growth_ratio"
).split()
REGISTRY = "business_name legal_form subject_status registration_date registration_year city has_red_flags has_activity_text has_ownership_text".split()


def assess(award_key: Column, registry_key: Column, award_name: Column, registry_name: Column) -> Column:
    """A struct (status, reason) of a candidate pair."""
    a, b = normalized_key(award_key), normalized_key(registry_key)
    verdict = lambda status, reason: F.struct(F.lit(status).alias("status"), F.lit(reason).alias("reason"))
    return (
        F.when(a == b, verdict("safe", "exact_nipt"))
        .when(a.isNotNull() & b.isNotNull(), verdict("avoid", "nipt_conflict"))
        .when(compact_text(award_name).isNotNull() & compact_text(registry_name).isNotNull(), verdict("caution", "manual_name_review_only"))
        .otherwise(verdict("avoid", "insufficient_identifier"))
    )


def guard_join(pair: str) -> None:
    """Refuses keys that the policy doesn't call safe."""
    if pair not in JOIN_POLICY["safe"]:
        raise ValueError(f"joining on {pair} isn't safe")


def joined_features(awards: DataFrame, registry: DataFrame) -> DataFrame:
    """Award features of the companies that the registry has under the same key, with its attributes and ages in days."""
    guard_join("winner_nipt = business_nipt")
    left = awards.drop(*LEFT_OUT).withColumnsRenamed({"source_snapshot_count": "app_source_snapshot_count", "source_structured_record_ids": "app_structured_record_ids"})
    right = registry.select("company_nipt", F.col("source_row_count").alias("qkb_source_row_count"), F.col("source_snapshot_count").alias("qkb_source_snapshot_count"), F.col("source_structured_record_ids").alias("qkb_structured_record_ids"), *REGISTRY)
    both = left.join(right, "company_nipt").where("company_nipt <> ''")
    return both.withColumns({
        "app_source_row_count": F.col("source_row_count"), "exact_join_match": F.lit(True),
        "company_age_days_at_first_procurement": F.datediff("first_procurement_date", "registration_date"), "company_age_days_at_last_procurement": F.datediff("last_procurement_date", "registration_date"),
    })


def join_skips(awards: DataFrame, registry: DataFrame) -> DataFrame:
    """Award entities that find no company."""
    return awards.join(registry.select("company_nipt"), "company_nipt", "left_anti").agg(F.count(F.lit(1)).alias("groups_skipped"))
