"""Trust in raw artifacts: quarantine filter, snapshot gate, file integrity, supersession and latest snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tendril.functions.text import canonical_legal_form, corruption_reason
from tendril.sources.artifact_files import located


def trusted(rows: DataFrame, raw: DataFrame, key: str = "raw_fetch_id") -> DataFrame:
    """Rows without a raw id, or whose raw artifact is known not to be corrupted; dangling ids are dropped."""
    marks = raw.select(F.col("id").alias("__raw"), F.col("is_corrupted").alias("__bad"))
    return rows.join(marks, rows[key] == F.col("__raw"), "left").where(F.col(key).isNull() | (F.col("__bad") == F.lit(False))).select(*rows.columns)


def snapshot_gate(snapshots: DataFrame, raw: DataFrame, key: str) -> DataFrame:
    """Each snapshot with gate_status (ok, missing_id, not_found, corrupted) and the reason it fails."""
    marks = raw.select(F.col("id").alias("__raw"), F.coalesce("is_corrupted", F.lit(False)).alias("__bad"), F.col("corruption_reason").alias("__why"))
    ref = F.col(key)
    joined = snapshots.join(marks, ref == F.col("__raw"), "left")
    status = F.when(ref.isNull(), "missing_id").when(F.col("__raw").isNull(), "not_found").when(F.col("__bad"), "corrupted").otherwise("ok")
    reason = (
        F.when(ref.isNull(), "structured snapshot is missing raw_fetch_id")
        .when(F.col("__raw").isNull(), F.concat(F.lit("raw fetch "), ref.cast("string"), F.lit(" not found")))
        .when(F.col("__bad"), F.concat(F.lit("raw fetch "), ref.cast("string"), F.lit(" is marked corrupted: "), F.coalesce(F.nullif("__why", F.lit("")), F.lit("unknown corruption reason"))))
    )
    return joined.select(*snapshots.columns, status.alias("gate_status"), reason.alias("gate_reason"))


def materialization_stats(gated: DataFrame) -> DataFrame:
    """Snapshots seen, materialized, skipped as corrupted, failed, and superseded (a column of that name counts)."""
    superseded = F.col("superseded") if "superseded" in gated.columns else F.lit(False)
    live = ~superseded
    return gated.agg(
        F.count(F.lit(1)).alias("snapshots_seen"), F.count_if(live & (F.col("gate_status") == "ok")).alias("snapshots_materialized"), F.count_if(live & (F.col("gate_status") == "corrupted")).alias("snapshots_skipped_corrupted"),
        F.count_if(live & F.col("gate_status").isin("missing_id", "not_found")).alias("snapshots_failed"), F.count_if(superseded).alias("snapshots_superseded"),
    )


def snapshot_identity(nipt: Column, canonical: Column, legal_form: Column, date_from: Column, date_to: Column, external_key: Column, accents: bool = True) -> Column:
    """(legal_form, from, to) of a snapshot from its payload, else from its key; null if it was searched by nipt or its
    key has foreign parts."""
    form = F.coalesce(F.nullif(canonical, F.lit("")), canonical_legal_form(legal_form, accents))
    make = lambda a, b, c: F.struct(a.alias("legal_form"), b.alias("date_from"), c.alias("date_to"))
    parts = F.split(F.coalesce(external_key, F.lit("")), r"\|")
    subject = F.slice(parts, 1, F.greatest(F.size(parts) - 2, F.lit(0)))
    forms = F.filter(subject, lambda p: p.startswith("legal_form:"))
    known = F.forall(subject, lambda p: p.startswith("legal_form:") | p.startswith("qarku:"))
    from_key = F.when((F.size(parts) >= 3) & known & (F.size(forms) == 1), make(F.substring(F.get(forms, F.lit(0)), 12, 1000), F.element_at(parts, -2), F.element_at(parts, -1)))
    filled = (F.coalesce(form, F.lit("")) != "") & (F.coalesce(date_from, F.lit("")) != "") & (F.coalesce(date_to, F.lit("")) != "")
    return F.when(F.coalesce(nipt, F.lit("")) != "", None).when(filled, make(form, date_from, date_to)).otherwise(from_key)


def has_region(external_key: Column, region: Column) -> Column:
    return (F.coalesce(region, F.lit("")) != "") | F.exists(F.split(F.coalesce(external_key, F.lit("")), r"\|"), lambda p: p.startswith("qarku:"))


def superseded(snapshots: DataFrame) -> DataFrame:
    """snapshots (id, identity, chunked) -> id of the un-chunked ones whose identity also has a chunked one, trusted or
    not. A null identity matches nothing."""
    own = snapshots.select("id", "chunked", "identity.*")
    names = ["legal_form", "date_from", "date_to"]
    return own.where(~F.col("chunked")).join(own.where("chunked").select(*names).distinct(), names, "left_semi").select("id")


def latest_snapshots(fetches: DataFrame, keys: list[str], at: str = "fetched_at", tie: str = "id") -> DataFrame:
    """One row per key: the attributes of the last fetch, with first_seen_at and last_seen_at. Aggregates only, so a
    hot key is combined before the shuffle."""
    rest = [c for c in fetches.columns if c not in keys]
    out = fetches.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(at, tie)).alias("__last"), F.min(at).alias("first_seen_at"), F.max(at).alias("last_seen_at"))
    return out.select(*keys, *[F.col(f"__last.{c}").alias(c) for c in rest], "first_seen_at", "last_seen_at")


def file_integrity(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """manifest (id, storage_path, content_hash, is_corrupted, ...) against files (path, digest): issue_type, reason."""
    there = files.select(F.col("path").alias("__path"), F.col("digest").alias("actual_content_hash"))
    joined = manifest.join(there, F.col("storage_path") == F.col("__path"), "left")
    return _with_issue(joined, F.col("__path").isNull()).drop("__path")


def stored_integrity(manifest: DataFrame, roots: list[str]) -> DataFrame:
    """The same against the files themselves, which are looked up below the roots (artifact_files.located) and read piece
    by piece: with resolved_path and file_bytes too. A file without bytes is there."""
    found = located(manifest, roots).withColumnRenamed("digest", "actual_content_hash")
    return _with_issue(found, F.col("resolved_path").isNull())


def _with_issue(found: DataFrame, missing: Column) -> DataFrame:
    issue = F.when(missing, "missing_file").when(~F.col("actual_content_hash").eqNullSafe(F.col("content_hash")), "content_hash_mismatch")
    return found.withColumn("issue_type", issue).withColumn("reason", corruption_reason(F.col("issue_type")))


def integrity_issues(checked: DataFrame, corrupted_only: bool = False, limit: int | None = None) -> DataFrame:
    """Rows with an issue; corrupted_only adds rows that are only marked. In id order, as many as the limit."""
    keep = F.col("issue_type").isNotNull()
    if corrupted_only:
        keep = keep | F.coalesce("is_corrupted", F.lit(False))
    out = checked.where(keep).withColumn("issue_type", F.coalesce("issue_type", F.lit("marked_corrupted")))
    return out if limit is None else out.orderBy("id").limit(limit)


def integrity_summary(checked: DataFrame, mark: bool = False, corrupted_only: bool = False, limit: int | None = None) -> DataFrame:
    marked, found = F.coalesce("is_corrupted", F.lit(False)), F.col("issue_type").isNotNull()
    after = marked | found if mark else marked
    newly = found & (~marked | ~F.col("corruption_reason").eqNullSafe(F.col("reason"))) if mark else F.lit(False)
    listed = F.count_if(found | (after if corrupted_only else F.lit(False)))
    returned = listed if limit is None else F.least(listed, F.lit(limit).cast("long"))
    truncated = F.lit(False) if limit is None else returned < (F.count_if(after) if corrupted_only else F.count_if(found))
    return checked.agg(
        F.count(F.lit(1)).alias("rows_scanned"), F.count_if(~marked & ~found).alias("healthy_rows"), F.count_if(found).alias("issues_found"),
        F.count_if(F.col("issue_type") == "content_hash_mismatch").alias("content_hash_mismatch_count"), F.count_if(F.col("issue_type") == "missing_file").alias("missing_file_count"),
        F.count_if(marked).alias("corrupted_rows_before_scan"), F.count_if(after).alias("corrupted_rows_after_scan"), F.count_if(newly).alias("rows_marked_corrupted"),
        returned.alias("returned_issue_count"), truncated.alias("issues_truncated"),
    )
