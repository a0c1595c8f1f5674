"""Whole runs of normalization on hand-made snapshots: reruns, replacement, nulls and empty tables."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tendril.operators import buckets, materialize
from tendril.plans import runners

RAW = "id long, storage_path string, is_corrupted boolean, corruption_reason string"
EXPORTS = "id long, external_key string, payload_year string, raw_fetch_id long, structured_record_id string"
ROWS = "path string, row_ordinal int, cells map<string,string>"
SNAPSHOTS = "id long, source_name string, external_key string, fetched_at timestamp, payload string"


def payload(raw, *names, **more):
    return json.dumps({"raw_fetch_id": raw, "response": [{"nipti": n} for n in names], **more})


@pytest.fixture
def run(spark, tmp_path):
    def go(exports, rows, snapshots, bad=()):
        raw = [(k, f"f{k}" if k < 50 else None, k in bad, None) for k in (1, 2, 3, 60, 61, 62)]
        frames = (spark.createDataFrame(x, s) for x, s in ((exports, EXPORTS), (snapshots, SNAPSHOTS), (raw, RAW), ([(f"f{k}",) for k in (1, 2)], "path string"), (rows, ROWS)))
        return runners.normalize_all(*frames, str(tmp_path))

    go.path = str(tmp_path)
    return go


def figures(outcomes, name):
    return materialize.run_statistics(outcomes[name], name).first().asDict()


def test_runs_replace_and_count(spark, run):
    at = datetime(2024, 1, 1)
    exports = [(1, "2020", None, 1, "x"), (2, "no year", None, 2, None), (3, None, "2021", 3, None), (4, "2020", None, None, None), (5, "2020", None, 9, None), (6, None, "2022", 2, None)]
    rows = [("f1", k, {"Numri_i_references": f"R{k}"}) for k in (1, 2, 3)] + [("f2", 1, {"Fituesi": " W "}), ("f9", 1, {})]
    whole = [(1, "q", "legal_form:A|x|y", at, payload(60, "K", "L")), (2, "q", None, at, payload(61, "M")), (3, "q", None, at, "no json"), (None, None, None, None, None)]
    first = run(exports, rows, whole)
    assert figures(first, "app_exports") == {"dataset": "app_exports", "snapshots_seen": 6, "snapshots_materialized": 2, "snapshots_skipped_corrupted": 0, "snapshots_skipped_superseded": 0, "snapshots_failed": 4, "rows_deleted_before_insert": 0, "rows_inserted": 4, "rows_materialized": 4}
    assert {r.structured_record_id: r.reason for r in materialize.left_out(first["app_exports"], "a").collect()} == {
        2: "snapshot has no usable export year", 3: "artifact of raw fetch 3 is missing", 4: "structured snapshot is missing raw_fetch_id", 5: "raw fetch 9 not found",
    }
    stored = {(r.structured_record_id, r.row_ordinal): r for r in buckets.current(spark, f"{run.path}/app_exports/rows").collect()}
    assert sorted(stored) == [(1, 1), (1, 2), (1, 3), (6, 1)] and stored[6, 1].winner_name == "W" and stored[6, 1].export_year == 2022

    by_region = [(4, "q", "legal_form:A|qarku:T|x|y", at, payload(62, "N"))]
    second = run(exports, rows[:1], [*whole, *by_region], bad=(2, 61))
    got = figures(second, "qkb_search")
    assert (got["snapshots_seen"], got["snapshots_materialized"], got["snapshots_skipped_corrupted"], got["snapshots_skipped_superseded"], got["snapshots_failed"], got["rows_deleted_before_insert"], got["rows_inserted"]) == (5, 1, 1, 1, 2, 2, 1)
    names = {r.business_nipt for r in buckets.current(spark, f"{run.path}/qkb_search/rows").collect()}
    assert names == {"M", "N"}  # a corrupted snapshot keeps its rows, one that regions supersede loses them
    assert {(r.structured_record_id, r.row_ordinal) for r in buckets.current(spark, f"{run.path}/app_exports/rows").collect()} == {(1, 1), (6, 1)}

    judged = second["app_exports"].select(F.col("structured_record_id").alias("id"), "outcome", "reason")
    kept = buckets.current(spark, f"{run.path}/app_exports/rows").where("structured_record_id = 1")
    frozen = spark.createDataFrame(kept.collect(), kept.schema)
    again = materialize.materialize(spark.createDataFrame(judged.collect(), judged.schema), frozen, f"{run.path}/app_exports", version=1)
    got = figures({"app_exports": again}, "app_exports")
    assert (got["rows_deleted_before_insert"], got["rows_inserted"]) == (3, 1)  # the same figures as when version 1 was first run


def test_nothing_to_do(spark, run):
    got = run([], [], [])
    assert all(figures(got, name)["snapshots_seen"] == 0 and figures(got, name)["rows_inserted"] == 0 and materialize.left_out(got[name], name).count() == 0 for name in got)
