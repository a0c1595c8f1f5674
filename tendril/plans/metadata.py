"""Feature dictionary, dataset semantics and join policy as small tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Dataset, category and confidence of every feature.
AWARD_FEATURES = """
participation safe: source_row_count active_procurement_count cancelled_procurement_count suspended_procurement_count
participation_rate caution: cancelled_procurement_rate suspended_procurement_rate
outcome_value safe: total_budget_limit_amount total_winner_value_amount active_total_budget_limit_amount active_total_winner_value_amount cancelled_total_budget_limit_amount cancelled_total_winner_value_amount
ratio caution: safe_winner_to_budget_ratio_avg safe_winner_to_budget_ratio_min safe_winner_to_budget_ratio_max
budget_proximity caution: near_budget_limit_count near_budget_limit_rate winner_value_gt_budget_count winner_value_gt_budget_rate
purchase_tickets caution: purchase_tickets_count purchase_tickets_total_winner_value
data_quality safe: zero_budget_with_winner_value_count
data_quality caution: zero_budget_with_winner_value_rate
temporal safe: first_procurement_date last_procurement_date first_procurement_year last_procurement_year active_year_span
context caution: distinct_contracting_authority_count distinct_procedure_type_count distinct_contract_type_count
concentration caution: top_authority_name top_authority_share authority_hhi top_procedure_type top_procedure_type_share procedure_type_hhi
concentration safe: top_authority_count top_procedure_type_count
year_over_year caution: yoy_value_jump_count yoy_contract_count_jump_count max_yoy_value_growth_ratio max_yoy_contract_count_growth_ratio
context caution: has_small_value_procedures has_open_local_procedures
support safe: rows_with_winner_value_count rows_with_budget_count rows_with_valid_ratio_count
"""
REGISTRY_FEATURES = """
identity safe: business_name legal_form
status safe: subject_status
temporal safe: registration_date registration_year
context caution: city has_activity_text has_ownership_text
risk caution: has_red_flags
"""
JOINED_FEATURES = """
join safe: exact_join_match
participation safe: source_row_count active_procurement_count cancelled_procurement_count suspended_procurement_count
participation_rate caution: cancelled_procurement_rate suspended_procurement_rate
outcome_value safe: total_budget_limit_amount total_winner_value_amount active_total_budget_limit_amount active_total_winner_value_amount cancelled_total_budget_limit_amount cancelled_total_winner_value_amount
ratio caution: safe_winner_to_budget_ratio_avg safe_winner_to_budget_ratio_min safe_winner_to_budget_ratio_max
purchase_tickets caution: purchase_tickets_count purchase_tickets_total_winner_value
data_quality safe: zero_budget_with_winner_value_count
data_quality caution: zero_budget_with_winner_value_rate
temporal safe: first_procurement_date last_procurement_date first_procurement_year last_procurement_year active_year_span company_age_days_at_first_procurement company_age_days_at_last_procurement
context caution: distinct_contracting_authority_count distinct_procedure_type_count distinct_contract_type_count has_small_value_procedures has_open_local_procedures
support safe: rows_with_winner_value_count rows_with_budget_count rows_with_valid_ratio_count
registry_enrichment safe: business_name legal_form subject_status registration_date registration_year
registry_enrichment caution: city
risk caution: has_red_flags
registry_context caution: has_activity_text has_ownership_text
"""
#: What a feature says, in our own words; features of the same name say the same of the joined dataset.
DESCRIPTIONS = {
    "source_row_count": "award rows of the company", "active_procurement_count": "rows that are known not to be cancelled", "cancelled_procurement_count": "rows that are cancelled", "suspended_procurement_count": "rows that are suspended",
    "cancelled_procurement_rate": "share of rows that are cancelled", "suspended_procurement_rate": "share of rows that are suspended",
    "total_budget_limit_amount": "sum of budgets", "total_winner_value_amount": "sum of awarded values", "active_total_budget_limit_amount": "sum of budgets of active rows", "active_total_winner_value_amount": "sum of awarded values of active rows",
    "cancelled_total_budget_limit_amount": "sum of budgets of cancelled rows", "cancelled_total_winner_value_amount": "sum of awarded values of cancelled rows",
    "safe_winner_to_budget_ratio_avg": "mean of award to budget, where the budget is positive", "safe_winner_to_budget_ratio_min": "least award to budget", "safe_winner_to_budget_ratio_max": "greatest award to budget",
    "near_budget_limit_count": "awards between 95 and 100 hundredths of their budget", "near_budget_limit_rate": "share of such awards among those with a ratio", "winner_value_gt_budget_count": "awards above their budget", "winner_value_gt_budget_rate": "share of awards above their budget",
    "purchase_tickets_count": "rows of the ticket procedure", "purchase_tickets_total_winner_value": "sum of awarded values of ticket rows",
    "zero_budget_with_winner_value_count": "awards with a budget of zero", "zero_budget_with_winner_value_rate": "share of awards with a budget of zero",
    "first_procurement_date": "first publication", "last_procurement_date": "last publication", "first_procurement_year": "year of the first publication", "last_procurement_year": "year of the last publication", "active_year_span": "years from the first to the last, both counted",
    "distinct_contracting_authority_count": "different authorities", "distinct_procedure_type_count": "different procedures", "distinct_contract_type_count": "different kinds of contract",
    "top_authority_name": "authority with the most rows", "top_authority_count": "rows of that authority", "top_authority_share": "its share of rows with an authority", "authority_hhi": "Herfindahl index of authorities",
    "top_procedure_type": "procedure with the most rows", "top_procedure_type_count": "rows of that procedure", "top_procedure_type_share": "its share of rows with a procedure", "procedure_type_hhi": "Herfindahl index of procedures",
    "yoy_value_jump_count": "years whose value jumped over that of the year before", "yoy_contract_count_jump_count": "years whose row count jumped over that of the year before", "max_yoy_value_growth_ratio": "greatest growth of value in a year", "max_yoy_contract_count_growth_ratio": "greatest growth of row count in a year",
    "has_small_value_procedures": "whether any procedure is one of small value", "has_open_local_procedures": "whether any procedure is open and local",
    "rows_with_winner_value_count": "rows that have an awarded value", "rows_with_budget_count": "rows that have a budget", "rows_with_valid_ratio_count": "rows that have a ratio of award to budget",
    "business_name": "newest name in the registry", "legal_form": "newest legal form", "subject_status": "newest status", "registration_date": "registration date of the newest row", "registration_year": "year of that date", "city": "newest city",
    "has_activity_text": "whether any row tells an activity", "has_ownership_text": "whether any row tells of ownership", "has_red_flags": "red flag of the newest row", "exact_join_match": "keys are equal in both sources",
    "company_age_days_at_first_procurement": "days from registration to the first publication", "company_age_days_at_last_procurement": "days from registration to the last publication",
}

# Field, role, usage level and our note on it, of the two normalized datasets, in the order of use.
AWARD_FIELDS = (
    ("procurement_reference", "core_identity", "safe", "names the procurement within an export"),
    ("export_year", "context_metadata", "safe", "the export that the row came with"),
    ("winner_nipt", "join_candidate", "safe", "the only key that leads to the registry"),
    ("winner_name", "join_candidate", "caution", "spelling varies; for review by hand"),
    ("contracting_authority", "context_metadata", "safe", "who buys; a label, not a company key"),
    ("procurement_subject", "context_metadata", "caution", "free text; never a key"),
    ("procedure_type", "performance_signal", "safe", "few values, fit for grouping"),
    ("contract_type", "performance_signal", "safe", "few values, fit for grouping"),
    ("publication_date", "temporal", "safe", "the date that orders rows"),
    ("opening_date", "temporal", "caution", "a step of the procedure more than of the market"),
    ("closing_date", "temporal", "caution", "its meaning varies between rows"),
    ("budget_limit_amount", "performance_signal", "safe", "stands for the size of the procurement"),
    ("winner_value_amount", "performance_signal", "safe", "what was awarded, where it is filled"),
    ("is_cancelled", "risk_signal", "safe", "an outcome that the source states"),
    ("is_suspended", "risk_signal", "safe", "an outcome that the source states"),
    ("cpv_codes", "context_metadata", "caution", "sector codes inside text"),
    ("source_payload", "weak_or_noisy", "caution", "kept for tracing back, not for analysis"),
)
REGISTRY_FIELDS = (
    ("business_nipt", "core_identity", "safe", "the company's key"),
    ("business_name", "core_identity", "safe", "a label beside the key"),
    ("trade_name", "context_metadata", "caution", "a label that changes more often than the name"),
    ("search_nipt", "join_candidate", "caution", "what was searched, not what was found"),
    ("legal_form", "context_metadata", "safe", "few values once canonical"),
    ("registration_date", "temporal", "safe", "gives a company's age"),
    ("city", "context_metadata", "caution", "never enough to match by"),
    ("ownership_text", "risk_signal", "caution", "text on ownership, not parsed"),
    ("subject_status", "risk_signal", "safe", "the registry's own state of the company"),
    ("subject_type", "weak_or_noisy", "caution", "often blank"),
    ("activity_text", "context_metadata", "caution", "free text, no code"),
    ("administrators_text", "weak_or_noisy", "caution", "names in text, for review by hand"),
    ("has_red_flags", "risk_signal", "caution", "depends on how the registry marks pages"),
    ("search_date_from", "temporal", "safe", "window of the search that found the row"),
    ("search_date_to", "temporal", "safe", "window of the search that found the row"),
    ("source_payload", "weak_or_noisy", "caution", "kept for tracing back, not for analysis"),
)
# Groups of fields that features may be made of.
FEATURE_CANDIDATES = {
    "normalized_app_export_rows": {
        "procurement_outcome": ("budget_limit_amount", "winner_value_amount", "is_cancelled", "is_suspended", "procedure_type", "contract_type"),
        "temporal": ("publication_date", "opening_date", "closing_date", "export_year"),
        "entity_context": ("winner_nipt", "winner_name", "contracting_authority", "cpv_codes"),
    },
    "normalized_qkb_search_rows": {
        "registry_identity": ("business_nipt", "business_name", "legal_form", "registration_date"),
        "registry_status": ("subject_status", "has_red_flags", "ownership_text"),
        "registry_context": ("city", "activity_text", "trade_name"),
    },
}
JOIN_FIELDS = {
    "normalized_app_export_rows": {"safe": ("winner_nipt",), "caution": ("winner_name",), "avoid": ("procurement_subject", "contracting_authority")},
    "normalized_qkb_search_rows": {"safe": ("business_nipt",), "caution": ("business_name", "trade_name"), "avoid": ("city", "activity_text", "administrators_text")},
}
#: What to mind with each dataset, in our own words.
CAVEATS = {
    "normalized_app_export_rows": ("rows of consortia have no key", "amounts are as published, of any currency unit in the export"),
    "normalized_qkb_search_rows": ("a company may appear in many snapshots", "searches are capped, so rows may be missing"),
}
JOIN_POLICY = {
    "safe": ("winner_nipt = business_nipt",),
    "risky": ("winner_name ~ business_name, by hand", "trade_name, as context of a review by hand"),
    "avoid": ("names alone", "address or city", "activity text or contracting authority text"),
    "default": ("keep the sources apart unless keys are equal",),
}


def _rows(dataset: str, text: str) -> list[tuple[str, str, str, str]]:
    out = []
    for line in text.strip().splitlines():
        head, _, names = line.partition(":")
        category, level = head.split()
        out += [(dataset, name, category, level) for name in names.split()]
    return out


def feature_rows() -> list[tuple[str, str, str, str]]:
    return _rows("app_company_features", AWARD_FEATURES) + _rows("qkb_company_features", REGISTRY_FEATURES) + _rows("joined_company_features", JOINED_FEATURES)


def feature_registry(spark: SparkSession) -> DataFrame:
    """dataset, name, category, confidence and description of all features."""
    return spark.createDataFrame([(*r, DESCRIPTIONS[r[1]]) for r in feature_rows()], "dataset string, name string, category string, confidence string, description string")


def semantics_rows(dataset: str) -> list[tuple]:
    fields = {"normalized_app_export_rows": AWARD_FIELDS, "normalized_qkb_search_rows": REGISTRY_FIELDS}
    if dataset not in fields:
        raise KeyError(f"no such dataset: {dataset}")
    join = {f: level for level, names in JOIN_FIELDS[dataset].items() for f in names}
    group = {f: name for name, names in FEATURE_CANDIDATES[dataset].items() for f in names}
    return [(dataset, name, role, level, join.get(name), note, group.get(name)) for name, role, level, note in fields[dataset]]


def dataset_semantics(spark: SparkSession, dataset: str) -> DataFrame:
    """field, role, usage level, join level, note and group of feature candidates (null: none), of a normalized dataset's
    columns; an unknown dataset is an error."""
    return spark.createDataFrame(semantics_rows(dataset), "dataset string, field string, role string, usage_level string, join_level string, note string, candidate_group string")


def caveats(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(d, x) for d, xs in CAVEATS.items() for x in xs], "dataset string, caveat string")


def join_policy(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(level, pair) for level, pairs in JOIN_POLICY.items() for pair in pairs], "level string, pair string")
