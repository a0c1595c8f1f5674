"""Materialization of normalized rows: snapshots are judged, rows of the good ones replace those they had, and a run
leaves an outcome per snapshot, from which its statistics come.

What is wrong with a snapshot is that snapshot's outcome and stops no other: `corrupted` and `failed` ones keep the rows
they had, `superseded` and `empty` ones lose them, `ok` ones get new ones. Whatever else fails (storage, lost executors
beyond Spark's retries) ends the run before its manifest is written, so readers still see the version before. A version
that is run again leaves the same table and the same statistics. An empty table of snapshots gives statistics of zeros.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tendril.operators import buckets
from tendril.operators.normalize import export_year, normalize_export, normalize_registry
from tendril.operators.sinks import replace_all, replace_by_snapshot
from tendril.operators.trust import has_region, snapshot_gate, snapshot_identity, superseded
from tendril.sources.scratch import written
from tendril.streaming.intake import snapshot_outcomes

KEY = "structured_record_id"
REPLACED = ("ok", "empty", "superseded")
BY_REGIONS = "superseded by regional snapshots of the same legal form and dates"


def judged_exports(snapshots: DataFrame, raw: DataFrame, files: DataFrame) -> DataFrame:
    """snapshots (id, external_key, payload_year, raw_fetch_id), raw (id, storage_path, is_corrupted, corruption_reason),
    files (path) -> id, external_key, raw_fetch_id, storage_path, export_year, outcome, reason."""
    gated = snapshot_gate(snapshots.select("id", "external_key", "payload_year", "raw_fetch_id"), raw, "raw_fetch_id")
    places = raw.select(F.col("id").alias("__of"), "storage_path")
    there = files.select(F.col("path").alias("__there")).distinct()
    placed = gated.join(places, F.col("raw_fetch_id") == F.col("__of"), "left").join(there, F.col("storage_path") == F.col("__there"), "left")
    year = export_year(F.col("payload_year"), F.col("external_key"))
    reason = (
        F.when(F.col("gate_status") != "ok", F.col("gate_reason"))
        .when(F.col("__there").isNull(), F.concat(F.lit("artifact of raw fetch "), F.col("raw_fetch_id").cast("string"), F.lit(" is missing")))
        .when(year.isNull(), "snapshot has no usable export year")
    )
    outcome = F.when(F.col("gate_status") == "corrupted", "corrupted").when(reason.isNotNull(), "failed").otherwise("ok")
    return placed.select("id", "external_key", "raw_fetch_id", "storage_path", year.alias("export_year"), outcome.alias("outcome"), reason.alias("reason"))


def export_table(judged: DataFrame, rows: DataFrame) -> DataFrame:
    """Normalized rows of the exports that are ok; rows (path, row_ordinal, cells) are those of all files."""
    own = judged.where("outcome = 'ok'").select(F.col("id").alias(KEY), "raw_fetch_id", F.col("external_key").alias("snapshot_external_key"), "export_year", F.col("storage_path").alias("path"))
    return normalize_export(rows.select("path", "row_ordinal", "cells").join(own, "path").drop("path"))


def judged_registry(snapshots: DataFrame, raw: DataFrame) -> DataFrame:
    """snapshots (columns of intake.SNAPSHOT) with outcome and reason. A snapshot of a whole country goes where there is
    one by regions, whatever its own artifact is like."""
    judged = written(snapshot_outcomes(snapshots, raw), "judged")  # read by the judgement of regions and by the rows
    own = lambda k: F.get_json_object("payload", f"$.{k}")
    identity = snapshot_identity(own("nipt"), own("canonical_legal_form_filter"), own("legal_form_filter"), own("data_nga"), own("data_ne"), F.col("external_key"))
    gone = superseded(judged.select("id", identity.alias("identity"), has_region(F.col("external_key"), own("secondary_filters.qarku")).alias("chunked")))
    marked = judged.join(gone.select("id", F.lit(True).alias("__gone")), "id", "left")
    return marked.withColumns({"outcome": F.when(F.col("__gone"), "superseded").otherwise(F.col("outcome")), "reason": F.when(F.col("__gone"), BY_REGIONS).otherwise(F.col("reason"))}).drop("__gone")


def registry_table(judged: DataFrame) -> DataFrame:
    """Normalized rows of the registry snapshots that are ok."""
    return normalize_registry(judged.where("outcome = 'ok'").drop("outcome", "reason")).withColumnsRenamed({"id": KEY, "external_key": "snapshot_external_key"})


def materialize(judged: DataFrame, rows: DataFrame, target: str, version: int | None = None) -> DataFrame:
    """Puts the rows below target/rows (read them by buckets.current) and returns the run's outcomes: id, outcome,
    reason, rows_deleted, rows_inserted. A given version is the newest one, which is run again, or a later one."""
    spark, table = judged.sparkSession, f"{target}/rows"
    if version is None:
        last = buckets.last_version(spark, table)
        version = 0 if last is None else last + 1
    marks = written(judged.select("id", "outcome", "reason"), "outcomes")
    good = marks.where(F.col("outcome").isin(*REPLACED)).select(F.col("id").alias(KEY))

    def counted(stored: DataFrame | None, name: str) -> DataFrame:
        if stored is None:
            return good.limit(0).select(KEY, F.lit(0).cast("long").alias(name))
        return stored.join(good, KEY, "left_semi").groupBy(KEY).agg(F.count(F.lit(1)).alias(name))

    deleted = written(counted(buckets.current(spark, table, before=version), "rows_deleted"), "deleted")  # before they go
    replace_by_snapshot(rows, table, KEY, good, version, all_named=True)
    inserted = counted(buckets.current(spark, table), "rows_inserted")
    both = marks.withColumnRenamed("id", KEY).join(deleted, KEY, "left").join(inserted, KEY, "left").fillna(0, ["rows_deleted", "rows_inserted"])
    replace_all(both, f"{target}/outcomes/version={version}")
    return spark.read.schema(both.schema).parquet(f"{target}/outcomes/version={version}")


def run_statistics(outcomes: DataFrame, dataset: str) -> DataFrame:
    """One row: what a run saw, did and left out."""
    of = lambda *kinds: F.count_if(F.col("outcome").isin(*kinds))
    total = lambda name: F.coalesce(F.sum(name), F.lit(0))
    return outcomes.agg(
        F.lit(dataset).alias("dataset"), F.count(F.lit(1)).alias("snapshots_seen"), of("ok", "empty").alias("snapshots_materialized"), of("corrupted").alias("snapshots_skipped_corrupted"), of("superseded").alias("snapshots_skipped_superseded"),
        of("failed").alias("snapshots_failed"), total("rows_deleted").alias("rows_deleted_before_insert"), total("rows_inserted").alias("rows_inserted"), total("rows_inserted").alias("rows_materialized"),
    )


def left_out(outcomes: DataFrame, dataset: str) -> DataFrame:
    """dataset, structured_record_id, kind (skipped, error) and reason of each snapshot that isn't materialized."""
    kind = F.when(F.col("outcome") == "failed", "error").otherwise("skipped")
    return outcomes.where("outcome NOT IN ('ok', 'empty')").select(F.lit(dataset).alias("dataset"), KEY, kind.alias("kind"), "reason")
