"""What the training-data operators share: tables in the shared folder, and reading inputs."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: Rows and bytes of a table that may be broadcast after they have been added up; larger ones are joined by a shuffle.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 32 << 20
#: Rows and bytes of an Arrow batch at most; texts are large rows, and every worker holds a few batches.
BATCH_ROWS, BATCH_BYTES = 512, 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches of this session's Python workers, unless they are smaller already."""
    rows, size = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, BATCH_ROWS)
        spark.conf.set(size, BATCH_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_OWN: dict[str, str] = {}  # by application, where spark.checkpoint.dir isn't set


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, a session in one process
    gets a new local one; on a cluster that is an error, as executors wouldn't see each other's files."""
    there = spark.conf.get("spark.checkpoint.dir", None)
    if not there:
        if not spark.conf.get("spark.master", "").startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        app = spark.sparkContext.applicationId
        there = _OWN.setdefault(app, "") or f"file://{tempfile.mkdtemp(prefix='tendril-')}"
        _OWN[app] = there
    return there.rstrip("/")


def new_folder(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark)}/tendril-{uuid.uuid4().hex}/{what}"


#: Open scopes of the running thread or task: operators that run at the same time have their own.
_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables written inside are deleted at the end, but those written with keep. What is kept must not be a plan over
    the others, and is itself left to the scope around this one."""
    paths: list[str] = []
    before = _SCOPES.set((*_SCOPES.get(), paths))
    try:
        yield
    finally:
        _SCOPES.reset(before)
        conf = spark._jsc.hadoopConfiguration()
        for path in paths:
            there = spark._jvm.org.apache.hadoop.fs.Path(path.rpartition("/")[0])
            there.getFileSystem(conf).delete(there, True)


def written(df: DataFrame, what: str, keep: bool = False) -> DataFrame:
    """df as a Parquet table in the shared folder: lineage ends there, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    small_batches(spark)
    path = new_folder(spark, what)
    df.write.parquet(path)
    scopes = _SCOPES.get()
    if len(scopes) > keep:
        scopes[-1 - keep].append(path)
    return spark.read.schema(df.schema).parquet(path)


def _bytes_of(df: DataFrame) -> Column:
    """About how many bytes a row of df takes."""

    def size(field: T.StructField) -> Column:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.octet_length(field.name)
        return F.lit(8) if isinstance(field.dataType, T.AtomicType) else F.octet_length(F.to_json(F.struct(field.name)))

    return sum((F.coalesce(size(f), F.lit(0)).cast("long") for f in df.schema.fields), F.lit(16).cast("long"))


def maybe_broadcast(df: DataFrame, limit: int = BROADCAST_ROWS, most: int = BROADCAST_BYTES) -> DataFrame:
    """df with a broadcast hint if it has at most `limit` rows of at most `most` bytes together, else as it is. Meant for
    written tables: its rows and bytes are added up first, which leaves one row per task."""
    rows, size = df.agg(F.count(F.lit(1)), F.sum(_bytes_of(df))).first()
    return F.broadcast(df) if rows <= limit and (size or 0) <= most else df


def keyed(docs: DataFrame) -> tuple[DataFrame, DataFrame, str, bool]:
    """docs (doc_id, text and others) -> docs with a key, rows (doc_id, digest, n_bytes, key), the key's column name, and
    whether keys are one to one with rows.

    Rows with the same doc_id and text share a key and no others do, so what is decided by key hits no other row, nulls
    included. Keys are longs in order of doc_id (a null one first), then of the text's digest; where the ids are whole
    numbers, none null and none twice, they are the ids themselves and nothing is joined. A null text is the empty one.
    """
    name = "key"
    while name in docs.columns:
        name += "_"
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = written(docs.select("doc_id", F.sha2(text, 256).alias("digest"), F.octet_length(text).cast("long").alias("n_bytes")), "digests")
    whole = isinstance(docs.schema["doc_id"].dataType, T.IntegralType)
    if whole and rows.where("doc_id is null").isEmpty() and rows.groupBy("doc_id").count().where("count > 1").isEmpty():
        return docs.withColumn(name, F.col("doc_id").cast("long")), rows.withColumn("key", F.col("doc_id").cast("long")), name, True
    first = F.col("doc_id").asc_nulls_first()
    order = rows.select("doc_id", "digest").distinct().repartitionByRange(first, "digest").sortWithinPartitions(first, "digest")
    order = written(order.select(F.col("doc_id").alias("__id"), F.col("digest").alias("__of"), F.monotonically_increasing_id().alias("__key")), "keys")
    own = docs.join(order, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.sha2(text, 256) == F.col("__of"))).select(*[F.col(f"`{c}`") for c in docs.columns], F.col("__key").alias(name))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("digest") == F.col("__of"))
    return own, rows.join(order, same).select("doc_id", "digest", "n_bytes", F.col("__key").alias("key")), name, False


def least_hashes(rows: DataFrame, n: int, per: str | None = None) -> DataFrame:
    """rows with a hash h -> the n rows with the smallest h, of each value of `per` if that is given; for rows that are
    written. How many values h has is estimated first and rows beyond a bound that keeps eight times as many as wanted
    are left out, so what reaches one task doesn't grow with the table or its partitions; the result doesn't depend
    on it, but that fewer than n may be left of a table whose estimate is off by as much."""
    values = F.approx_count_distinct("h").alias("__values")
    if per:
        counted = rows.join(F.broadcast(rows.groupBy(per).agg(values)), per)  # a row per value
    else:
        counted = rows.withColumn("__values", F.lit(rows.agg(values).first()[0]))
    near = counted.where((F.col("h") + F.lit(2.0**63)) * F.col("__values") <= F.lit(2.0**64 * 8 * n)).drop("__values")
    if per:
        near = near.distinct()
        return near.withColumn("__nth", F.row_number().over(Window.partitionBy(per).orderBy("h"))).where(F.col("__nth") <= n).drop("__nth")
    return near.orderBy("h").limit(n)


def crc_of_id(doc_id: str = "doc_id"):
    """crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))
