"""Feature semantics on hand-made rows."""

from datetime import date
from decimal import Decimal

import pytest

from tendril.operators import entity_join, features
from tendril.plans import metadata

AWARDS = "winner_nipt string, winner_name string, publication_date date, budget_limit_amount decimal(18,2), winner_value_amount decimal(18,2), is_cancelled boolean, is_suspended boolean, contracting_authority string, procedure_type string, contract_type string, structured_record_id long, row_ordinal int, materialized_at timestamp"


def award(nipt="L1", name=None, day=None, budget=None, value=None, cancelled=None, suspended=None, authority=None, procedure=None, contract=None, snapshot=1, ordinal=1):
    as_money = lambda x: None if x is None else Decimal(str(x))
    return (nipt, name, day, as_money(budget), as_money(value), cancelled, suspended, authority, procedure, contract, snapshot, ordinal, None)


def features_of(spark, rows):
    return {r.company_nipt: r.asDict() for r in features.award_features(spark.createDataFrame(rows, AWARDS)).collect()}


def test_subset_sums_and_rates(spark):
    out = features_of(spark, [award(" l1 ", budget=100, value=50, cancelled=False), award("L1", budget=None, value=None, cancelled=True, ordinal=2), award(None), award("")])
    one = out["L1"]
    assert set(out) == {"L1"} and one["source_row_count"] == 2
    assert one["cancelled_procurement_rate"] == Decimal("0.5000")
    assert one["cancelled_total_winner_value_amount"] is None  # rows, but only nulls
    assert one["purchase_tickets_total_winner_value"] == 0  # no rows
    assert one["safe_winner_to_budget_ratio_avg"] == Decimal("0.500000")


def test_blank_keys_form_a_group_and_flags_are_three_valued(spark):
    out = features_of(spark, [award("  ", cancelled=None), award("L2", cancelled=None, suspended=True)])
    assert out[""]["source_row_count"] == 1
    assert out["L2"]["active_procurement_count"] == 0 and out["L2"]["suspended_procurement_count"] == 1


def test_four_row_company(spark):
    rows = [
        award(day=date(2022, 5, 1), budget=100, value=50, procedure="Purchase Tickets"), award(day=date(2024, 5, 1), budget=100, value=75, ordinal=2),
        award(day=None, budget=0, value=50, procedure=" purchase tickets ", ordinal=3), award(day=date(2023, 1, 1), budget=None, value=10, ordinal=4),
    ]
    one = features_of(spark, rows)["L1"]
    assert (one["safe_winner_to_budget_ratio_avg"], one["safe_winner_to_budget_ratio_min"], one["safe_winner_to_budget_ratio_max"]) == (Decimal("0.625000"), Decimal("0.500000"), Decimal("0.750000"))
    assert one["active_year_span"] == 3 and one["zero_budget_with_winner_value_count"] == 1
    assert one["purchase_tickets_count"] == 2 and one["purchase_tickets_total_winner_value"] == 100


def test_concentration_ties_and_index(spark):
    rows = [award(authority=a, ordinal=k) for k, a in enumerate(["A"] * 7 + ["B"] * 2 + ["C"])] + [award("T", authority=a) for a in ("b", "B", "a ", None, " ")]
    out = features_of(spark, rows)
    assert (out["L1"]["top_authority_name"], out["L1"]["top_authority_count"], out["L1"]["top_authority_share"], out["L1"]["authority_hhi"]) == ("A", 7, Decimal("0.700000"), Decimal("0.540000"))
    assert (out["T"]["top_authority_name"], out["T"]["distinct_contracting_authority_count"]) == ("a", 3)
    assert out["T"]["top_procedure_type"] is None and out["T"]["top_procedure_type_count"] == 0 and out["T"]["procedure_type_hhi"] is None


def test_year_over_year(spark):
    rows = [award(day=date(2020, 1, k + 1), value=50_000, ordinal=k) for k in range(2)] + [award(day=date(2021, 1, k + 1), value=50_000, ordinal=k) for k in range(8)] + [award(day=date(2023, 1, 1), value=9_000_000)]
    one = features_of(spark, rows)["L1"]
    assert (one["yoy_value_jump_count"], one["yoy_contract_count_jump_count"]) == (1, 1)  # 2023 doesn't follow 2021
    assert (one["max_yoy_value_growth_ratio"], one["max_yoy_contract_count_growth_ratio"]) == (Decimal("4.000000"), Decimal("4.000000"))


def test_near_budget_uses_the_unrounded_ratio(spark):
    one = features_of(spark, [award(budget=1000000, value=949999.99), award(budget=100, value=95, ordinal=2), award(budget=100, value=100, ordinal=3), award(budget=100, value="100.01", ordinal=4)])["L1"]
    assert (one["near_budget_limit_count"], one["winner_value_gt_budget_count"], one["near_budget_limit_rate"]) == (2, 1, Decimal("0.5000"))


def test_latest_name_skips_blanks(spark):
    rows = [award(name="old", day=date(2020, 1, 1)), award(name=" new ", day=date(2021, 1, 1)), award(name=" ", day=date(2022, 1, 1)), award(name="undated")]
    assert features_of(spark, rows)["L1"]["latest_winner_name"] == "new"


REGISTRY = "business_nipt string, business_name string, trade_name string, legal_form string, subject_status string, city string, registration_date date, has_red_flags boolean, activity_text string, ownership_text string, search_date_from date, search_date_to date, structured_record_id long, result_ordinal int, materialized_at timestamp"


def test_registry_row_and_join(spark):
    rows = [("l1", "Old", None, "SHPK", "Aktiv", None, date(2018, 1, 1), True, " ", None, date(2024, 1, 1), date(2024, 1, 2), 1, 1, None), ("L1", " ", None, None, "Pasiv", "Tirane", None, None, None, "x", None, date(2024, 2, 1), 2, 1, None)]
    registry = features.registry_features(spark.createDataFrame(rows, REGISTRY))
    one = registry.first()
    assert (one.business_name, one.subject_status, one.city) == ("Old", "Pasiv", "Tirane")
    assert one.registration_date is None and one.has_red_flags is None  # of the newest row
    assert (one.has_activity_text, one.has_ownership_text, one.search_window_start, one.search_window_end) == (False, True, date(2024, 1, 1), date(2024, 2, 1))
    only = features.registry_features(spark.createDataFrame(rows[:1], REGISTRY))
    awards = features.award_features(spark.createDataFrame([award("L1", day=date(2022, 1, 7)), award("L9")], AWARDS))
    joined = entity_join.joined_features(awards, only).collect()
    assert len(joined) == 1 and joined[0].company_age_days_at_first_procurement == 1467 and joined[0].exact_join_match
    assert entity_join.join_skips(awards, only).first()[0] == 1
    assert {r.name for r in metadata.feature_registry(spark).where("dataset = 'joined_company_features'").collect()} <= set(entity_join.joined_features(awards, only).columns)
    with pytest.raises(ValueError):
        entity_join.guard_join("winner_name = business_name")


def test_registry_of_features(spark):
    table = metadata.feature_registry(spark)
    assert table.count() == 101 and table.where("confidence = 'safe'").count() == 53
    assert metadata.dataset_semantics(spark, "normalized_app_export_rows").count() == 17 and metadata.dataset_semantics(spark, "normalized_qkb_search_rows").count() == 16
    groups = {d: sum(r[6] is not None for r in metadata.semantics_rows(d)) for d in metadata.FEATURE_CANDIDATES}
    assert groups == {"normalized_app_export_rows": 14, "normalized_qkb_search_rows": 10} and set(metadata.FEATURE_CANDIDATES["normalized_qkb_search_rows"]["registry_status"]) == {"subject_status", "has_red_flags", "ownership_text"}
    assert metadata.join_policy(spark).where("level = 'safe'").count() == 1
    with pytest.raises(KeyError):
        metadata.dataset_semantics(spark, "x")


def test_an_entity_without_any_facet(spark):
    one = features_of(spark, [award("L1", snapshot=None)])["L1"]
    assert (one["source_snapshot_count"], one["source_structured_record_ids"], one["distinct_contract_type_count"], one["yoy_value_jump_count"]) == (0, [], 0, 0)
    assert one["top_authority_name"] is None and one["authority_hhi"] is None and one["max_yoy_value_growth_ratio"] is None


def test_dates_flags_and_white_space(spark):
    from pyspark.sql import functions as F

    from tendril.functions.text import parse_date, parse_flag, strip

    texts = [" 1.2.2024 ", "01/02/2024", "2024-2-1", "1.2/2024", "31.02.2024", "1.2.24", "2024-02-01T00:00:00", "", None, " a\x1c b\xa0", " Po", "JO", "maybe"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", parse_date(F.col("t")).alias("d"), parse_flag(F.col("t")).alias("f"), strip(F.col("t")).alias("s")).collect()
    assert [r.d for r in got] == [date(2024, 2, 1)] * 3 + [None] * 10
    assert [r.f for r in got] == [None] * 10 + [True, False, None]
    assert all(r.s == (None if r.t is None else r.t.strip()) for r in got)
