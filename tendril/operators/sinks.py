"""Sinks: replace by snapshot, full replace, reports."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tendril.operators import buckets


def replace_by_snapshot(rows: DataFrame, path: str, key: str = "structured_record_id", snapshots: DataFrame | None = None, version: int | None = None, all_named: bool = False) -> None:
    """Replaces the rows of each snapshot that `rows` has, and of each of `snapshots` (a column named as the key), which
    may have none any more; others stay. With all_named, `snapshots` has every snapshot of `rows` too, and rows are worked
    out once. Snapshots lie in hash buckets, as many folders whatever their number; read them by buckets.current."""

    def merge(old: DataFrame | None, new: DataFrame) -> DataFrame:
        return rows if old is None else old.select(*rows.columns).join(new.select(key).distinct(), key, "left_anti").select(*rows.columns).union(rows)

    ids = rows.select(key)
    if all_named and snapshots is not None:
        ids = snapshots.select(key)
        return buckets.change(ids, [key], path, merge, version)
    buckets.change(ids if snapshots is None else ids.union(snapshots.select(key)), [key], path, merge, version)


def replace_all(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").parquet(path)


def as_json(report: DataFrame, pretty: bool = False) -> DataFrame:
    """Each row as one JSON text, nulls included; over several lines if it is to be read by people."""
    return report.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false", "pretty": str(pretty).lower()}).alias("json"))


def materialized(rows: DataFrame, at: datetime | None = None) -> DataFrame:
    """rows with materialized_at: one time for the whole run, in UTC and without a zone; now, unless it is given."""
    when = at or datetime.now(UTC)
    when = when.astimezone(UTC).replace(tzinfo=None) if when.tzinfo else when
    return rows.withColumn("materialized_at", F.lit(when.isoformat(sep=" ")).cast("timestamp_ntz"))
