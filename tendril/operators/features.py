"""Per-entity features of awards and of registry rows, by column role.

Three steps share the entity key: counts and amounts, in a hash aggregate; the newest names, a row per entity and task
before the shuffle (a window's group limit); and the facets of a row (authority, procedure, contract, year, snapshot),
which are counted by entity, facet and value, so that distinct counts, top categories and growth come from those counts
rather than from an aggregation or an Expand for each. For the first and the last, rows are shuffled by entity as they are,
once for both (`dealt_once`): a row is narrower than the buffers of the aggregates or than its five facets, and most
entities have too few rows in a task for those to be combined before the shuffle. A hot entity's rows pass through one task
in a stream; what is held is its buffers and its values' counts.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tendril.functions.rounding import MONEY, count_ratio, rate, ratio
from tendril.functions.text import strip

NEAR_LOW = 95  # hundredths of the budget from which an award is near it
JUMP_RATIO, JUMP_VALUE, JUMP_COUNT = 3, 100_000, 5
TICKETS, SMALL_VALUE, OPEN_LOCAL = "purchase tickets", "small value", "open local"


@dataclass(frozen=True)
class AwardRoles:
    """Which columns of an awards table play which part. `newest` orders rows of one date, the newest last."""

    key: str = "winner_nipt"
    name: str = "winner_name"
    date: str = "publication_date"
    budget: str = "budget_limit_amount"
    award: str = "winner_value_amount"
    cancelled: str = "is_cancelled"
    suspended: str = "is_suspended"
    authority: str = "contracting_authority"
    procedure: str = "procedure_type"
    contract: str = "contract_type"
    snapshot: str = "structured_record_id"
    newest: tuple[str, ...] = ("materialized_at", "structured_record_id", "row_ordinal")


@dataclass(frozen=True)
class RegistryRoles:
    key: str = "business_nipt"
    until: str = "search_date_to"
    since: str = "search_date_from"
    registered: str = "registration_date"
    red_flag: str = "has_red_flags"
    activity: str = "activity_text"
    ownership: str = "ownership_text"
    snapshot: str = "structured_record_id"
    latest: tuple[str, ...] = ("business_name", "trade_name", "legal_form", "subject_status", "city")
    newest: tuple[str, ...] = field(default=("materialized_at", "structured_record_id", "result_ordinal"))


def with_entity(rows: DataFrame, key: str) -> DataFrame:
    """Rows that have a key, with it stripped and in upper case as `entity`; blank keys form the group ''."""
    return rows.where((F.col(key).isNotNull()) & (F.col(key) != "")).withColumn("entity", F.upper(strip(F.col(key))))


def by_entity(own: DataFrame) -> DataFrame:
    """Rows dealt out by entity, before they are aggregated."""
    return own.repartition("entity")


def dealt_once(own: DataFrame, columns: list[str]) -> DataFrame:
    """Rows dealt out by entity, for several aggregates of one query: each of them would else have a shuffle of its own
    columns. The generator asks for all the columns, and the filter, which keeps all rows, is what a join would ask of one of
    its sides; so the shuffles are equal, and Spark does one and reads it again."""
    return by_entity(own.where("entity is not null").select("entity", *columns)).select("entity", F.inline(F.array(F.struct(*columns))))


def skipped_rows(rows: DataFrame, key: str) -> DataFrame:
    """How many rows have no key."""
    return rows.agg(F.count_if(F.col(key).isNull() | (F.col(key) == "")).alias("groups_skipped"), F.count(F.lit(1)).alias("source_rows_seen"))


def subset_sum(value: Column, of: Column) -> Column:
    """Sum over a subset: 0 if the subset is empty, null if it has only nulls."""
    return F.when(F.count_if(of) == 0, F.lit(0)).otherwise(F.sum(F.when(of, value)))


def nonblank(value: Column) -> Column:
    return F.nullif(strip(value), F.lit(""))


def latest(value: Column, *newest: Column) -> Column:
    """The newest row's non-blank value, column by column; a null in the order counts as oldest."""
    text = nonblank(value)
    return F.max_by(text, F.when(text.isNotNull(), F.struct(*newest)))


def concentration(rows: DataFrame, column: str, prefix: str, entity: str = "entity") -> DataFrame:
    """Per entity: the most frequent category (ties: the first in lower-case, then exact order), its count and share,
    the Herfindahl index and how many categories there are. Entities without any have no row."""
    counts = rows.select(entity, nonblank(F.col(column)).alias("value")).where("value is not null").groupBy(entity, "value").agg(F.count(F.lit(1)).alias("n"))
    top = F.min_by(F.struct("value", "n"), F.struct(-F.col("n"), F.lower("value"), F.col("value")))
    summed = counts.groupBy(entity).agg(top.alias("top"), F.sum("n").alias("total"), F.sum(F.col("n").cast("decimal(18,0)") * F.col("n").cast("decimal(18,0)")).alias("squares"), F.count(F.lit(1)).alias(f"{prefix}_distinct"))
    total = F.col("total").cast("decimal(18,0)")
    return summed.select(entity, F.col("top.value").alias(f"{prefix}_top"), F.col("top.n").alias(f"{prefix}_top_count"), count_ratio(F.col("top.n"), F.col("total")).alias(f"{prefix}_top_share"), ratio(F.col("squares").cast("decimal(24,0)"), (total * total).cast("decimal(24,0)")).alias(f"{prefix}_hhi"), f"{prefix}_distinct")


def yearly(rows: DataFrame, date: str, award: str, entity: str = "entity") -> DataFrame:
    """Per entity and year: rows and awards; undated rows are left out, null awards count as 0."""
    return rows.where(F.col(date).isNotNull()).groupBy(entity, F.year(date).alias("year")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce(F.col(award), F.lit(0).cast(MONEY))).alias("value"))


def _change(now: Column, before: Column) -> Column:
    """Struct of the ratios of two consecutive years (structs year, n, value), and whether they are jumps."""
    value = F.when(before["value"] > 0, ratio(now["value"], before["value"]))
    count = count_ratio(now["n"], before["n"])
    return F.struct(
        now["year"].alias("year"), value.alias("value_ratio"), count.alias("count_ratio"),
        F.coalesce((value >= JUMP_RATIO) & (now["value"] - before["value"] >= JUMP_VALUE), F.lit(False)).alias("value_jump"),
        F.coalesce((count >= JUMP_RATIO) & (now["n"] - before["n"] >= JUMP_COUNT), F.lit(False)).alias("count_jump"),
    )


def growth(by_year: DataFrame, entity: str = "entity") -> DataFrame:
    """Ratios of consecutive years: value (if the earlier one's is positive) and count, and whether they are jumps."""
    now = F.struct("year", "n", "value")
    pairs = by_year.select(entity, now.alias("now"), F.lag(now).over(Window.partitionBy(entity).orderBy("year")).alias("before"))
    return pairs.where("now.year = before.year + 1").select(entity, _change(F.col("now"), F.col("before")).alias("x")).select(entity, "x.*")


def jumps(by_year: DataFrame, entity: str = "entity") -> DataFrame:
    return growth(by_year, entity).groupBy(entity).agg(
        F.count_if("value_jump").alias("yoy_value_jump_count"), F.count_if("count_jump").alias("yoy_contract_count_jump_count"),
        F.max("value_ratio").alias("max_yoy_value_growth_ratio"), F.max("count_ratio").alias("max_yoy_contract_count_growth_ratio"),
    )


def amount_marks(roles: AwardRoles) -> dict[str, Column]:
    """What the aggregates ask of a row's budget and award: narrower than these, where the amounts aren't summed."""
    budget, award = F.col(roles.budget), F.col(roles.award)
    valid = F.coalesce((budget > 0) & award.isNotNull(), F.lit(False))
    return {
        "__valid": valid,
        "__near": valid & (award * 100 >= budget * NEAR_LOW) & (award <= budget),
        "__over": valid & (award > budget),
        "__zero": F.coalesce((budget == 0) & award.isNotNull(), F.lit(False)),
        "__ratio": F.when(valid, ratio(award, F.when(valid, budget))),
    }


def procedure_marks(roles: AwardRoles) -> dict[str, Column]:
    """What the aggregates ask of a row's procedure."""
    kind = F.lower(F.col(roles.procedure))
    return {"__tickets": F.coalesce(F.lower(strip(F.col(roles.procedure))) == TICKETS, F.lit(False)), "__small": kind.contains(SMALL_VALUE), "__open_local": kind.contains(OPEN_LOCAL)}


def main_aggregates(roles: AwardRoles, brought: list[str] | None = None) -> dict[str, Column]:
    """The aggregates with fixed-width buffers over an entity's rows, by feature name. `brought`: columns of the rows; marks
    among them are taken as they are."""
    budget, award, date = F.col(roles.budget), F.col(roles.award), F.col(roles.date)
    active, cancelled, suspended = F.col(roles.cancelled).eqNullSafe(False), F.col(roles.cancelled).eqNullSafe(True), F.col(roles.suspended).eqNullSafe(True)
    marks = {n: F.col(n) if n in (brought or []) else c for n, c in (amount_marks(roles) | procedure_marks(roles)).items()}
    valid, near, over, zero, own, tickets, small, open_local = (marks[f"__{m}"] for m in ("valid", "near", "over", "zero", "ratio", "tickets", "small", "open_local"))
    n, n_valid = F.count(F.lit(1)), F.count_if(valid)
    return {
        "source_row_count": n,
        "first_procurement_date": F.min(date),
        "last_procurement_date": F.max(date),
        "first_procurement_year": F.year(F.min(date)),
        "last_procurement_year": F.year(F.max(date)),
        "active_year_span": F.year(F.max(date)) - F.year(F.min(date)) + 1,
        "active_procurement_count": F.count_if(active),
        "cancelled_procurement_count": F.count_if(cancelled),
        "suspended_procurement_count": F.count_if(suspended),
        "cancelled_procurement_rate": rate(F.count_if(cancelled), n),
        "suspended_procurement_rate": rate(F.count_if(suspended), n),
        "total_budget_limit_amount": F.sum(budget),
        "total_winner_value_amount": F.sum(award),
        "active_total_budget_limit_amount": subset_sum(budget, active),
        "active_total_winner_value_amount": subset_sum(award, active),
        "cancelled_total_budget_limit_amount": subset_sum(budget, cancelled),
        "cancelled_total_winner_value_amount": subset_sum(award, cancelled),
        "safe_winner_to_budget_ratio_avg": ratio(F.sum(own), F.nullif(F.count(own), F.lit(0)).cast("decimal(18,0)")),
        "safe_winner_to_budget_ratio_min": F.min(own),
        "safe_winner_to_budget_ratio_max": F.max(own),
        "near_budget_limit_count": F.count_if(near),
        "near_budget_limit_rate": rate(F.count_if(near), n_valid),
        "winner_value_gt_budget_count": F.count_if(over),
        "winner_value_gt_budget_rate": rate(F.count_if(over), n_valid),
        "purchase_tickets_count": F.count_if(tickets),
        "purchase_tickets_total_winner_value": subset_sum(award, tickets),
        "zero_budget_with_winner_value_count": F.count_if(zero),
        "zero_budget_with_winner_value_rate": rate(F.count_if(zero), n),
        "has_small_value_procedures": F.coalesce(F.bool_or(small), F.lit(False)),
        "has_open_local_procedures": F.coalesce(F.bool_or(open_local), F.lit(False)),
        "rows_with_winner_value_count": F.count(award),
        "rows_with_budget_count": F.count(budget),
        "rows_with_valid_ratio_count": n_valid,
    }


def snapshot_aggregates(roles: AwardRoles) -> dict[str, Column]:
    """Those that need a list as buffer; apart, so that the others needn't be sorted."""
    return {"source_snapshot_count": F.size(F.collect_set(roles.snapshot)).cast("long"), "source_structured_record_ids": F.sort_array(F.collect_set(roles.snapshot))}


def award_aggregates(rows: DataFrame, roles: AwardRoles, *names: str) -> DataFrame:
    """company_nipt and the named aggregates. Rows may bring marks with them (amount_marks, procedure_marks); those that they
    don't bring are worked out after the shuffle."""
    return _aggregated(by_entity(with_entity(rows, roles.key)), roles, *names)


def _aggregated(dealt: DataFrame, roles: AwardRoles, *names: str) -> DataFrame:
    every = main_aggregates(roles, dealt.columns) | snapshot_aggregates(roles)
    return dealt.groupBy(F.col("entity").alias("company_nipt")).agg(*[every[n].alias(n) for n in names])


def facets(dealt: DataFrame, roles: AwardRoles) -> DataFrame:
    """Of rows dealt out by entity: per entity, facet (a, p, c: authority, procedure, contract; y: year; s: snapshot) and value as text: rows n, and
    awards for years (null awards count as 0). A row without a value isn't counted in that facet."""
    values = {"a": nonblank(F.col(roles.authority)), "p": nonblank(F.col(roles.procedure)), "c": nonblank(F.col(roles.contract)), "y": F.year(F.col(roles.date)).cast("string"), "s": F.col(roles.snapshot).cast("string")}
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("facet"), v.alias("value")) for k, v in values.items()]))
    amount = F.when(F.col("x.facet") == "y", F.coalesce(F.col(roles.award), F.lit(0).cast(MONEY)))
    rows = dealt.select("entity", roles.award, pairs.alias("x")).where("x.value is not null").select("entity", "x.facet", "x.value", amount.alias("amount"))
    return rows.groupBy("entity", "facet", "value").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"))


def facet_features(counts: DataFrame, snapshot_type) -> DataFrame:
    """A row per entity: what `facets` say about it."""
    of = lambda k, c: F.when(F.col("facet") == k, c)
    n, value = F.col("n"), F.col("value")
    exact = n.cast("decimal(18,0)")
    sums = []
    for k in ("a", "p"):
        top = F.min_by(F.struct("value", "n"), of(k, F.struct(-n, F.lower(value), value)))
        sums += [top.alias(f"{k}_top"), F.sum(of(k, exact)).cast("decimal(18,0)").alias(f"{k}_total"), F.sum(of(k, exact * exact)).cast("decimal(24,0)").alias(f"{k}_squares")]
    year = F.struct(value.cast("int").alias("year"), n.alias("n"), F.col("amount").alias("value"))
    grouped = counts.groupBy("entity").agg(
        *sums, *[F.count_if(F.col("facet") == k).alias(f"{k}_distinct") for k in ("a", "p", "c", "s")],
        F.sort_array(F.collect_list(of("s", value.cast(snapshot_type)))).alias("snapshots"), F.sort_array(F.collect_list(of("y", year))).alias("years"),
    )
    years = F.col("years")
    pairs = F.filter(F.arrays_zip(F.slice(years, 2, F.size(years)).alias("now"), F.slice(years, 1, F.greatest(F.size(years) - 1, F.lit(0))).alias("before")), lambda x: x["now"]["year"] == x["before"]["year"] + 1)
    changed = grouped.withColumn("changes", F.transform(pairs, lambda x: _change(x["now"], x["before"])))
    share = lambda k: count_ratio(F.col(f"{k}_top.n"), F.col(f"{k}_total"))
    hhi = lambda k: ratio(F.col(f"{k}_squares"), (F.col(f"{k}_total") * F.col(f"{k}_total")).cast("decimal(24,0)"))
    return changed.select(
        "entity", F.col("s_distinct").alias("source_snapshot_count"), F.col("snapshots").alias("source_structured_record_ids"),
        F.col("a_distinct").alias("distinct_contracting_authority_count"), F.col("p_distinct").alias("distinct_procedure_type_count"), F.col("c_distinct").alias("distinct_contract_type_count"),
        F.col("a_top.value").alias("top_authority_name"), F.coalesce("a_top.n", F.lit(0)).alias("top_authority_count"), share("a").alias("top_authority_share"), hhi("a").alias("authority_hhi"),
        F.col("p_top.value").alias("top_procedure_type"), F.coalesce("p_top.n", F.lit(0)).alias("top_procedure_type_count"), share("p").alias("top_procedure_type_share"), hhi("p").alias("procedure_type_hhi"),
        F.size(F.filter("changes", lambda x: x["value_jump"])).cast("long").alias("yoy_value_jump_count"), F.size(F.filter("changes", lambda x: x["count_jump"])).cast("long").alias("yoy_contract_count_jump_count"),
        F.array_max(F.transform("changes", lambda x: x["value_ratio"])).alias("max_yoy_value_growth_ratio"), F.array_max(F.transform("changes", lambda x: x["count_ratio"])).alias("max_yoy_contract_count_growth_ratio"),
    )


#: What an entity without any facet has: no snapshots, and counts of 0.
NO_FACETS = {"source_structured_record_ids": F.array, **dict.fromkeys(
    ("source_snapshot_count", "distinct_contracting_authority_count", "distinct_procedure_type_count", "distinct_contract_type_count", "top_authority_count", "top_procedure_type_count", "yoy_value_jump_count", "yoy_contract_count_jump_count"), lambda: F.lit(0),
)}


def newest_names(own: DataFrame, roles: AwardRoles) -> DataFrame:
    """company_nipt and latest_winner_name, the newest row's non-blank name (a null in the order counts as oldest), null of
    entities that have none. A task hands on one row of an entity."""
    order = [F.col(c) for c in dict.fromkeys((roles.date, *roles.newest))]
    named = own.select(F.col("entity").alias("company_nipt"), nonblank(F.col(roles.name)).alias("latest_winner_name"), *order)
    nth = F.row_number().over(Window.partitionBy("company_nipt").orderBy(F.col("latest_winner_name").isNull(), *[c.desc_nulls_last() for c in order]))
    return named.withColumn("__nth", nth).where("__nth = 1").select("company_nipt", "latest_winner_name")


def award_columns(roles: AwardRoles) -> list[str]:
    """The columns of an awards table that its features are made of."""
    return list(dict.fromkeys((roles.key, roles.name, roles.date, roles.budget, roles.award, roles.cancelled, roles.suspended, roles.authority, roles.procedure, roles.contract, roles.snapshot, *roles.newest)))


def entities(rows: DataFrame, key: str) -> DataFrame:
    """company_nipt of every entity that has rows, as the feature tables have it."""
    return with_entity(rows, key).select(F.col("entity").alias("company_nipt")).distinct()


def award_features(rows: DataFrame, roles: AwardRoles | None = None, names: bool = True) -> DataFrame:
    """All features of an awards table, a row per entity; without latest_winner_name, if that isn't asked for. The rows are
    read twice, for the names and for the rest: where they come out of joins, write them (`award_columns`) and hand in what is read back."""
    roles = roles or AwardRoles()
    own = with_entity(rows, roles.key)
    # what mostly stays the same from one row to the next comes first, as such rows compress better
    used = (roles.authority, roles.contract, roles.snapshot, roles.suspended, roles.cancelled, roles.date, roles.budget, roles.award, roles.procedure)
    dealt = dealt_once(own, [*dict.fromkeys(used), *[m for m in (*amount_marks(roles), *procedure_marks(roles)) if m in rows.columns]])
    main = _aggregated(dealt, roles, *main_aggregates(roles))
    parts = facet_features(facets(dealt, roles), own.schema[roles.snapshot].dataType).withColumnRenamed("entity", "company_nipt")
    joined = (main.join(newest_names(own, roles), "company_nipt", "left") if names else main).join(parts, "company_nipt", "left")
    filled = {c: F.coalesce(F.col(c), empty().cast(joined.schema[c].dataType)) for c, empty in NO_FACETS.items()}
    lead = ["company_nipt", "source_row_count", "source_snapshot_count", "source_structured_record_ids", *(["latest_winner_name"] if names else [])]
    return joined.withColumns(filled).select(*lead, *[c for c in joined.columns if c not in lead])


def registry_features(rows: DataFrame, roles: RegistryRoles | None = None) -> DataFrame:
    """A row per company: latest texts column by column; registration date and red flag of the newest row, null or not."""
    roles = roles or RegistryRoles()
    newest = (F.col(roles.until), *[F.col(c) for c in roles.newest])
    first = F.max_by(F.struct(F.col(roles.registered).alias("registered"), F.col(roles.red_flag).alias("flag")), F.struct(*newest))
    has = lambda c: F.coalesce(F.bool_or(nonblank(F.col(c)).isNotNull()), F.lit(False))
    out = with_entity(rows, roles.key).groupBy(F.col("entity").alias("company_nipt")).agg(
        F.count(F.lit(1)).alias("source_row_count"), F.size(F.collect_set(roles.snapshot)).cast("long").alias("source_snapshot_count"), F.sort_array(F.collect_set(roles.snapshot)).alias("source_structured_record_ids"),
        *[latest(F.col(c), *newest).alias(c) for c in roles.latest], first.alias("first"), has(roles.activity).alias("has_activity_text"), has(roles.ownership).alias("has_ownership_text"),
        F.min(roles.since).alias("search_window_start"), F.max(roles.until).alias("search_window_end"),
    )
    return out.withColumns({"registration_date": F.col("first.registered"), "registration_year": F.year("first.registered"), "has_red_flags": F.col("first.flag")}).drop("first")
