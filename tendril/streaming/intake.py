"""Incremental intake and upkeep of latest snapshots with Structured Streaming.

Both are micro-batch jobs with an idempotent sink: what a batch writes is a function of its rows and of what is there,
so a batch that runs twice leaves the same tables, and the checkpoint advances past successful batches only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tendril.operators import buckets
from tendril.operators.normalize import normalize_registry
from tendril.operators.sinks import replace_all, replace_by_snapshot
from tendril.operators.trust import snapshot_gate

SNAPSHOT = "id bigint, source_name string, external_key string, fetched_at timestamp, payload string"


def snapshot_stream(spark: SparkSession, folder: str) -> DataFrame:
    """New snapshot files (JSON lines) of a folder."""
    return spark.readStream.schema(SNAPSHOT).json(folder)


def snapshot_outcomes(batch: DataFrame, raw: DataFrame | None = None) -> DataFrame:
    """The last of each snapshot of a batch (by fetched_at, then payload), with outcome and reason: `corrupted` and
    `failed` by its raw artifact (trust.snapshot_gate) if raw artifacts are given, `failed` where the payload has no list
    of results, `empty` where that list has no object, else `ok`."""
    rest = [c for c in batch.columns if c != "id"]
    last = batch.groupBy("id").agg(F.max_by(F.struct(*rest), F.struct("fetched_at", "payload")).alias("s")).select("id", "s.*")
    response = F.try_parse_json("payload")
    kinds = [F.try_variant_get(response, path, "array<variant>") for path in ("$.response", "$.response.data")]
    listed = F.coalesce(*kinds)
    objects = F.exists(listed, lambda x: F.schema_of_variant(x).startswith("OBJECT"))
    outcome = F.when(listed.isNull(), "failed").when(objects, "ok").otherwise("empty")
    reason = F.when(listed.isNull(), F.when(response.isNull(), "payload is no JSON").otherwise("payload has no list of results"))
    if raw is None:
        return last.withColumns({"outcome": outcome, "reason": reason})
    ref = F.try_variant_get(response, "$.raw_fetch_id", "bigint")
    gated = snapshot_gate(last.withColumn("raw_fetch_id", ref), raw, "raw_fetch_id")
    sound = F.col("gate_status") == "ok"
    return gated.withColumns({"outcome": F.when(F.col("gate_status") == "corrupted", "corrupted").when(~sound, "failed").otherwise(outcome), "reason": F.when(sound, reason).otherwise(F.col("gate_reason"))}).drop("gate_status", "gate_reason", "raw_fetch_id")


def normalized_intake(stream: DataFrame, target: str, checkpoint: str, raw: DataFrame | None = None) -> StreamingQuery:
    """Normalizes each new snapshot. The rows of a snapshot that is ok replace those it had; an empty one loses its rows;
    one that failed or is corrupted keeps them. What became of each is in the outcomes, one row per snapshot and batch;
    rows and outcomes of a batch that is run again are the same."""

    def put(batch: DataFrame, number: int) -> None:
        judged = snapshot_outcomes(batch, raw).persist()
        rows = normalize_registry(judged.where("outcome = 'ok'").drop("outcome", "reason")).withColumnRenamed("id", "structured_record_id")
        good = judged.where("outcome IN ('ok', 'empty')").select(F.col("id").alias("structured_record_id"))
        replace_by_snapshot(rows, f"{target}/rows", snapshots=good, version=number, all_named=True)
        put_now = buckets.current(batch.sparkSession, f"{target}/rows")
        fresh = judged.where("outcome = 'ok'").select(F.col("id").alias("structured_record_id"))
        counts = judged.limit(0).select("id", F.lit(0).cast("long").alias("n")) if put_now is None else put_now.join(fresh, "structured_record_id", "left_semi").groupBy(F.col("structured_record_id").alias("id")).agg(F.count(F.lit(1)).alias("n"))
        found = judged.join(counts, "id", "left").select("id", "source_name", "external_key", "fetched_at", "outcome", "reason", F.coalesce("n", F.lit(0)).alias("rows_inserted"))
        replace_all(found, f"{target}/outcomes/batch={number}")
        judged.unpersist()

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current_rows(spark: SparkSession, target: str) -> DataFrame | None:
    """The rows of every snapshot's last good arrival; None before the first batch with one."""
    return buckets.current(spark, f"{target}/rows")


OUTCOME = "id bigint, source_name string, external_key string, fetched_at timestamp, outcome string, reason string, rows_inserted bigint, batch int"


def outcomes(spark: SparkSession, target: str) -> DataFrame:
    """id, source_name, external_key, fetched_at, outcome, reason, rows_inserted and batch of every arrival."""
    return spark.read.schema(OUTCOME).parquet(f"{target}/outcomes")


def unfinished(spark: SparkSession, target: str) -> DataFrame:
    """Snapshots whose last arrival failed or is corrupted: those to fetch again."""
    return outcomes(spark, target).groupBy("id").agg(F.max_by(F.struct("outcome", "reason", "batch"), "batch").alias("last")).select("id", "last.*").where("outcome NOT IN ('ok', 'empty')")


def latest_upkeep(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Keeps one row per (source_name, external_key): the last snapshot, first and last sight. A batch rewrites the hash
    buckets of its keys; latest_rows reads the table."""
    keys = ["source_name", "external_key"]

    def put(batch: DataFrame, number: int) -> None:
        rest = [c for c in batch.columns if c not in keys]

        def merge(old: DataFrame | None, new: DataFrame) -> DataFrame:
            seen = new.withColumns({"first_seen_at": F.col("fetched_at"), "last_seen_at": F.col("fetched_at")})
            both = seen if old is None else old.select(*seen.columns).union(seen)
            last = F.max_by(F.struct(*rest), F.struct("fetched_at", "id")).alias("last")
            return both.groupBy(*keys).agg(last, F.min("first_seen_at").alias("first_seen_at"), F.max("last_seen_at").alias("last_seen_at")).select(*keys, "last.*", "first_seen_at", "last_seen_at")

        buckets.change(batch, keys, target, merge, number)

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_rows(spark: SparkSession, target: str) -> DataFrame | None:
    """The kept row of each key; None before the first batch."""
    return buckets.current(spark, target)
