"""Tables in hash buckets with a manifest per version.

A version writes the buckets that it changes, below data/version=N, and then its manifest, one file that names for each
bucket the version that holds it. Readers go by the newest manifest, so they see a version as a whole or not at all, and
what a change costs follows the buckets that it touches. A version that is written again leaves the same table. A bucket
stays as long as one of the last two manifests names it, for readers that have just begun.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64
BUCKET = "__bucket"


def _folder(spark: SparkSession, path: str):
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()), there


def _numbers(spark: SparkSession, path: str, name: str) -> list[int]:
    """Numbers N of the folders name=N below a path, in order."""
    files, there = _folder(spark, path)
    found = [s.getPath().getName() for s in files.listStatus(there)] if files.exists(there) else []
    return sorted(int(x.rpartition("=")[2]) for x in found if x.startswith(f"{name}="))


def _manifest(spark: SparkSession, target: str, version: int) -> tuple[int, dict[int, int]]:
    """The number of buckets and the version of each that has rows; as many rows as buckets at most."""
    rows = spark.read.schema("bucket int, version bigint, buckets int").parquet(f"{target}/manifest/version={version}").collect()
    return rows[0].buckets, {r.bucket: r.version for r in rows if r.bucket is not None}


def last_version(spark: SparkSession, target: str, before: int | None = None) -> int | None:
    """The newest version, or the newest before another."""
    there = [v for v in _numbers(spark, f"{target}/manifest", "version") if before is None or v < before]
    return there[-1] if there else None


def current(spark: SparkSession, target: str, schema=None, before: int | None = None, only: set[int] | None = None) -> DataFrame | None:
    """The table as its newest manifest has it (of certain buckets); None if there is no such table or bucket."""
    version = last_version(spark, target, before)
    held = _manifest(spark, target, version)[1] if version is not None else {}
    paths = [f"{target}/data/version={v}/{BUCKET}={b}" for b, v in sorted(held.items()) if only is None or b in only]
    if not paths:
        return spark.createDataFrame([], schema) if schema is not None and version is not None else None
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*paths)


def change(new: DataFrame, keys: list[str], target: str, merge: Callable[[DataFrame | None, DataFrame], DataFrame], version: int | None = None, buckets: int = BUCKETS) -> None:
    """Writes the next version: of the buckets that the rows of `new` fall into (by keys), what merge(their rows so far,
    the new rows) gives. A given version is the number of the change, e.g. of a micro-batch."""
    spark = new.sparkSession
    before = last_version(spark, target, version)
    n, held = _manifest(spark, target, before) if before is not None else (buckets, {})
    version = version if version is not None else (before + 1 if before is not None else 0)
    bucket: Column = F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")
    touched = {r[0] for r in new.select(bucket).distinct().collect()}  # as many as buckets at most
    old = current(spark, target, before=version, only=touched)
    path = f"{target}/data/version={version}"
    # rebalanced, not repartitioned: a large bucket is written by several tasks, small ones share one
    merge(old, new).withColumn(BUCKET, bucket).hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(path)
    held = {b: v for b, v in held.items() if b not in touched} | dict.fromkeys(_numbers(spark, path, BUCKET), version)
    entries = [(b, v, n) for b, v in held.items()] or [(None, None, n)]
    spark.createDataFrame(entries, "bucket int, version bigint, buckets int").coalesce(1).write.mode("overwrite").parquet(f"{target}/manifest/version={version}")
    _tidy(spark, target, version)


def _tidy(spark: SparkSession, target: str, version: int) -> None:
    kept = [v for v in _numbers(spark, f"{target}/manifest", "version") if v <= version][-2:]
    named = {(b, v) for k in kept for b, v in _manifest(spark, target, k)[1].items()}
    for v in _numbers(spark, f"{target}/data", "version"):
        own = _numbers(spark, f"{target}/data/version={v}", BUCKET)
        if v > version or v in kept and all((b, v) in named for b in own):
            continue
        for b in own:
            if (b, v) not in named:
                files, there = _folder(spark, f"{target}/data/version={v}/{BUCKET}={b}")
                files.delete(there, True)
        if not any((b, v) in named for b in own):
            files, there = _folder(spark, f"{target}/data/version={v}")
            files.delete(there, True)
    for v in _numbers(spark, f"{target}/manifest", "version"):
        if v < kept[0]:
            files, there = _folder(spark, f"{target}/manifest/version={v}")
            files.delete(there, True)
