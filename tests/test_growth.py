"""What large tables ask for: how much is shuffled, and into how many tasks and files it goes."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tendril.operators import buckets, coverage, features, sinks, trust
from tendril.plans import feature_queries, registry, report_queries, views

DATA = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_remaining_days_go_by_spans(spark):
    day = lambda n: date(2024, 1, 1) + timedelta(n)
    wanted = [("a", 0, 4), ("a", 2, 9), ("a", 3, 3), ("a", 20, 22), ("a", 23, 23), ("b", 5, 5), ("b", 7, 6), ("c", 0, 2), (None, 0, 1)]
    done = [("a", 0), ("a", 3), ("a", 3), ("a", 9), ("a", 15), ("a", 21), ("b", 5), ("d", 1), (None, 0), ("c", None)]
    windows = spark.createDataFrame([(k, day(a), day(b)) for k, a, b in wanted], "k string, date_from date, date_to date")
    covered = spark.createDataFrame([(k, None if n is None else day(n)) for k, n in done], "k string, day date")
    left = {(k, day(n)) for k, a, b in wanted for n in range(a, b + 1)} - {(k, day(n)) for k, n in done if k is not None and n is not None}
    found = [(r.k, r.day) for r in coverage.remaining_days(windows, covered, "k").collect()]
    assert len(found) == len(left) and set(found) == left
    assert "Generate" not in plan(registry.QUERIES["c07_remaining_days"](spark, DATA))


def test_awards_are_shuffled_as_rows(spark):
    assert plan(registry.QUERIES["i04_award_features"](spark, DATA)).count("REPARTITION_BY_COL") == 2
    sums = plan(registry.QUERIES["d05_h34_sums"](spark, DATA)).splitlines()
    assert not [x for x in sums if "Exchange hashpartitioning(company_nipt" in x]  # rows are shuffled, not buffers


def test_joins_of_entities_read_what_they_need(spark):
    skips = plan(registry.QUERIES["c02_join_skips"](spark, DATA))
    assert "Window" not in skips and "Generate" not in skips and "l_extendedprice" not in skips and "o_orderstatus" in skips
    assert "Window" not in plan(registry.QUERIES["c02_h20_joined_features"](spark, DATA))


def test_lines_meet_order_and_artifact_in_one_join(spark):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(registry.QUERIES["b06_d03_conditional_counts"](spark, DATA))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    *_, last = [x for x in text.splitlines() if "REPARTITION_BY_COL" in x]
    carried = text[text.index(last) :].splitlines()[1]
    assert "Project" in carried and "__tickets" in carried and "__zero" in carried
    assert "budget_limit_amount" not in carried and "procedure_type" not in carried  # marks are shuffled, not what they are made of
    by_artifact = [x for x in text.splitlines() if "Exchange hashpartitioning(raw_fetch_id" in x]
    assert len(by_artifact) == 1  # of the lines that name another artifact than their order's
    assert any("Filter" in x and "NOT (" in x for x in text[text.index(by_artifact[0]) :].splitlines()[1:4])


def test_trusted_awards_of_odd_artifacts(spark, tmp_path):
    """Orders of one number, lines without an artifact, with another's or with none that exists: as the plain joins have it."""
    for name, rows in {
        "orders": spark.read.parquet(f"{DATA}/orders.parquet").selectExpr("* except (o_orderkey)", "CASE WHEN o_orderkey % 5 = 0 THEN -(o_orderkey + 1) WHEN o_orderkey % 7 = 0 THEN o_orderkey + 1 ELSE o_orderkey END AS o_orderkey"),
        "lineitem": spark.read.parquet(f"{DATA}/lineitem.parquet").selectExpr("* except (l_orderkey, l_suppkey)", "CASE WHEN l_linenumber = 6 THEN NULL ELSE l_orderkey END AS l_orderkey", "l_partkey % 25 AS l_suppkey"),
        "part": spark.read.parquet(f"{DATA}/part.parquet"),
    }.items():
        rows.write.parquet(str(tmp_path / f"{name}.parquet"))
    there = str(tmp_path)
    plain = trust.trusted(views.awards(spark, there), views.raw_fetches(spark, there))
    own = views.trusted_awards(spark, there)
    assert own.columns == plain.columns and own.where("raw_fetch_id is null").count() and own.where("raw_fetch_id < 0").count()
    assert own.count() == plain.count() and own.exceptAll(plain).isEmpty() and plain.exceptAll(own).isEmpty()


def test_orders_are_judged_before_they_meet_customers(spark):
    plain = trust.trusted(views.registry(spark, DATA), views.raw_fetches(spark, DATA))
    own = views.trusted_registry(spark, DATA)
    assert own.columns == plain.columns and own.count() == plain.count() and own.exceptAll(plain).isEmpty() and plain.exceptAll(own).isEmpty()
    text = plan(own)
    assert text.index("c_custkey") < text.index("__raw")  # the plan's top comes first


def test_amounts_and_facets_share_a_shuffle(spark):
    rows = feature_queries.award_features(spark, DATA, names=False)
    rows.collect()
    text = plan(rows).split("Initial Plan")[0]
    assert text.count("ReusedExchange") == 1 and text.count("FileScan") == 1  # awards are read and dealt out once


def test_rows_without_a_key_stay_behind(spark, tmp_path):
    """They are left out before the joins, and no others; keys and artifacts may be null."""
    for name in ("orders", "lineitem", "part", "customer", "nation"):
        rows = spark.read.parquet(f"{DATA}/{name}.parquet")
        if name == "orders":
            rows = rows.withColumn("o_custkey", F.expr("CASE WHEN o_orderkey % 8 = 0 THEN NULL WHEN o_orderkey % 8 = 1 THEN -o_custkey ELSE o_custkey END"))
        elif name == "lineitem":
            rows = rows.withColumn("l_partkey", F.expr("CASE WHEN l_orderkey % 8 = 2 THEN NULL ELSE l_partkey END"))
        rows.write.parquet(str(tmp_path / f"{name}.parquet"))
    there = str(tmp_path)
    for view, key, condition in ((views.trusted_awards, "winner_nipt", "(l_partkey"), (views.trusted_registry, "business_nipt", "(o_custkey")):
        plain, own = view(spark, there).where(f"{key} is not null"), view(spark, there, keyed=True).where(f"{key} is not null")
        assert own.columns == plain.columns and 0 < own.count() == plain.count() and own.exceptAll(plain).isEmpty() and plain.exceptAll(own).isEmpty()
        text = plan(view(spark, there, keyed=True))
        below = text[text.index("Join") :].splitlines()
        assert any("Filter" in x and condition in x and "%" in x for x in below)


def test_registry_rows_are_combined_before_their_shuffle(spark):
    text = plan(feature_queries.registry_features(spark, DATA))
    assert "hashpartitioning(o_custkey" in text  # where customers are broadcast too, a customer's rows meet in one task


@pytest.mark.parametrize("name", ["c08_d24_feature_sparsity", "d25_feature_readiness"])
def test_sparsity_reads_what_its_dictionary_lists(spark, monkeypatch, name):
    kept = {}
    monkeypatch.setattr(report_queries, "written", lambda df, what: kept.setdefault(what, df))
    monkeypatch.setattr(feature_queries, "written", lambda df, what: kept.setdefault(what, df))
    registry.QUERIES[name](spark, DATA)
    assert "Window" not in plan(kept["award-features"]) and "winner_name" not in kept["awards"].columns
    sums = next(x for x in plan(kept["award-features"]).splitlines() if "HashAggregate(keys=[entity" in x and "budget_limit_amount" in x)
    assert "__tickets" in sums and "procedure_type" not in sums


def test_a_task_hands_on_one_name_of_an_entity(spark):
    text = plan(registry.QUERIES["e01_f01_latest_value"](spark, DATA))
    assert "WindowGroupLimit" in text and "SortAggregate" not in text
    rows = [("a", "old", 1, 1), ("A ", " new ", 2, 1), ("a", " ", 3, 1), ("a", None, 4, 1), ("a", "undated", None, 9), ("b", " ", 1, 1), ("b", None, None, None), (None, "x", 1, 1), (" ", "blank key", None, None)]
    roles = features.AwardRoles(key="k", name="name", date="day", newest=("n",))
    own = features.with_entity(spark.createDataFrame(rows, "k string, name string, day int, n int").repartition(3), "k")
    assert {tuple(r) for r in features.newest_names(own, roles).collect()} == {("A", "new"), ("B", None), ("", "blank key")}


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_path):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor")}
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        rows = spark.range(200_000, numPartitions=8).selectExpr("CAST(3 AS BIGINT) AS structured_record_id", "sha2(CAST(id AS STRING), 256) AS v")
        sinks.replace_by_snapshot(rows, str(tmp_path / "t"))
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert len(list((tmp_path / "t").glob("data/version=0/*/*.parquet"))) > 1
    assert buckets.current(spark, str(tmp_path / "t")).count() == 200_000


def test_rows_are_worked_out_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(parts):
        for part in parts:
            seen.add(part.num_rows)
            yield part

    rows = spark.range(50).selectExpr("id % 5 AS structured_record_id", "id AS v").mapInArrow(count, "structured_record_id bigint, v bigint")
    named = spark.range(6).select(F.col("id").alias("structured_record_id"))
    for version in (0, 1):
        sinks.replace_by_snapshot(rows, str(tmp_path / "t"), snapshots=named, version=version, all_named=True)
    assert seen.value == 100 and buckets.current(spark, str(tmp_path / "t")).count() == 50


def test_all_profiles_join_awards_once(spark):
    text = plan(registry.QUERIES["i04_profile_all"](spark, DATA))
    assert "l_orderkey" not in text
