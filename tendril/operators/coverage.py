"""Coverage of collected windows: truncation, completeness by day, run logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

CAP = 50
UNFINISHED = ("running", "failed", "interrupted")
ZONE = "Europe/Tirane"


def is_truncated(date_from: Column, date_to: Column, records: Column, cap: int = CAP) -> Column:
    """A one-day window with exactly as many records as the source gives at most."""
    return (date_from == date_to) & (records == cap)


def local_day(at: Column, zone: str = ZONE) -> Column:
    return F.to_date(F.from_utc_timestamp(at, zone))


def look_back(day: Column, today: Column, days: int) -> Column:
    """Whether a day lies in [today - days, today]; negative counts mean 0."""
    return day.between(F.date_sub(today, max(0, days)), today)


def chunk_report(chunks: DataFrame, cap: int = CAP) -> DataFrame:
    """chunks (day, chunk, n, ok) -> by day: rows, chunks done and failed, those at the cap and their names, and
    whether chunking was enough."""
    full = F.col("ok") & (F.col("n") == cap)
    return chunks.groupBy("day").agg(
        F.sum(F.when(F.col("ok"), F.col("n")).otherwise(0)).alias("rows"), F.count_if("ok").alias("succeeded"), F.count_if(~F.col("ok")).alias("failed"),
        F.count_if(full).alias("at_limit"), F.array_join(F.sort_array(F.collect_set(F.when(full, F.col("chunk")))), ",").alias("limited_chunks"), (F.count_if(full) == 0).alias("sufficient"),
    )


def chunk_union(rows: DataFrame, cap: int = CAP) -> DataFrame:
    """rows (day, chunk, nipt) -> by day: rows before and after taking keys once, chunks, chunks at the cap."""
    per_chunk = rows.groupBy("day", "chunk").agg(F.count(F.lit(1)).alias("n"))
    counts = per_chunk.groupBy("day").agg(F.sum("n").alias("rows_before"), F.count(F.lit(1)).alias("chunks"), F.count_if(F.col("n") == cap).alias("chunks_at_limit"))
    keys = rows.where("nipt is not null").select("day", "nipt").distinct().groupBy("day").agg(F.count(F.lit(1)).alias("rows_after"))
    return counts.join(keys, "day", "left").fillna(0, ["rows_after"])


def day_spine(windows: DataFrame, *keys: str) -> DataFrame:
    """windows (keys, date_from, date_to) -> a row per day, both ends included."""
    return windows.where("date_from <= date_to").select(*keys, F.explode(F.sequence("date_from", "date_to", F.expr("interval 1 day"))).alias("day"))


def remaining_spans(windows: DataFrame, covered: DataFrame, *keys: str) -> DataFrame:
    """The days of the windows that aren't covered, as spans without overlap: keys, date_from, date_to. Windows and covered
    days are shuffled by key; days are never listed. A null key has its windows, but covers nothing."""
    own = windows.where("date_from <= date_to").groupBy(*keys, "date_from").agg(F.max("date_to").alias("date_to"))
    # a window is cut to what begins after all that began before it
    before = F.max("date_to").over(Window.partitionBy(*keys).orderBy("date_from").rowsBetween(Window.unboundedPreceding, -1))
    disjoint = own.select(*keys, F.greatest(F.col("date_from"), F.date_add(before, 1)).alias("at"), F.col("date_to").alias("until")).where("at <= until")
    days = covered.select(*keys, F.col("day").alias("at"), F.lit(None).cast("date").alias("until")).where(" and ".join(f"`{k}` is not null" for k in (*keys, "at")))
    # in order, with a window before a day at its beginning: what lies between a row and the next, within the last window
    order = Window.partitionBy(*keys).orderBy("at", F.col("until").desc_nulls_last())
    end = F.max("until").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    spans = disjoint.union(days).select(*keys, F.when(F.col("until").isNull(), F.date_add("at", 1)).otherwise(F.col("at")).alias("date_from"), F.least(end, F.date_sub(F.lead("at").over(order), 1)).alias("date_to"), end.alias("__end"))
    return spans.where("__end is not null and date_from <= date_to").drop("__end")


def remaining_days(windows: DataFrame, covered: DataFrame, *keys: str) -> DataFrame:
    """Days of the windows that aren't covered."""
    return day_spine(remaining_spans(windows, covered, *keys), *keys)


def run_summary(days: DataFrame, windows: DataFrame, *keys: str, cap: int = CAP) -> DataFrame:
    """days (keys, day, n, ok), windows (keys, date_from, date_to) -> days asked for, done, failed, remaining and
    truncated, and rows."""
    asked = windows.select(*keys, (F.datediff("date_to", "date_from") + 1).cast("long").alias("days_requested"))
    done = days.groupBy(*keys).agg(F.count_if("ok").alias("days_completed"), F.count_if(~F.col("ok")).alias("days_failed"), F.count_if(F.col("ok") & (F.col("n") == cap)).alias("days_truncated"), F.sum(F.when(F.col("ok"), F.col("n")).otherwise(0)).alias("rows"))
    out = asked.join(done, list(keys), "left").fillna(0, ["days_completed", "days_failed", "days_truncated", "rows"])
    return out.withColumn("days_remaining", F.col("days_requested") - F.col("days_completed"))


def latest_unfinished_runs(runs: DataFrame) -> DataFrame:
    """runs (id, collector, mode, date_from, date_to, current_date, status) -> the last unfinished one of each window,
    where it would resume, and how many days are done."""
    order = Window.partitionBy("collector", "mode", "date_from", "date_to").orderBy(F.desc("id"))
    last = runs.where(F.col("status").isin(*UNFINISHED)).withColumn("nth", F.row_number().over(order)).where("nth = 1").drop("nth")
    resume = F.when(F.col("current_day").between(F.col("date_from"), F.col("date_to")), F.col("current_day")).otherwise(F.col("date_from"))
    return last.withColumn("resume_day", resume).withColumn("days_done", F.greatest(F.lit(0), F.datediff("resume_day", "date_from")).cast("long"))


def list_runs(runs: DataFrame, status: str | None = None, limit: int | None = None) -> DataFrame:
    """Newest first."""
    out = runs if status is None else runs.where(F.col("status") == status)
    out = out.orderBy(F.desc("id"))
    return out if limit is None else out.limit(limit)


def years_to_collect(requested: DataFrame, available: DataFrame) -> DataFrame:
    """Requested years that are available; all requested ones if none is."""
    both = requested.join(available.select("year").distinct(), "year", "left_semi")
    return requested.distinct() if both.isEmpty() else both.distinct()
