"""Raw artifacts and exports on files: manifests, CSV exports with row ordinals, previews."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tendril.functions.text import extension, storage_name, storage_partition
from tendril.sources import csv_ranges
from tendril.sources.artifact_files import opened, sha256_of


def artifacts(spark: SparkSession, folder: str) -> DataFrame:
    """path, length, modified and digest of every file below a folder. Files are dealt out by their sizes and read piece by
    piece, so they may be of any size; Spark's listing passes over files without bytes (artifact_files.located doesn't)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    listed = files.select("path", "length", F.col("modificationTime").alias("modified"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = [sha256_of(*opened(p))[1] for p in batch.column("path").to_pylist()]
            yield batch.append_column("digest", pa.array(digests, pa.string()))

    return listed.mapInArrow(run, "path string, length long, modified timestamp, digest string")


def manifest(fetches: DataFrame) -> DataFrame:
    """fetches (source_name, source_url, fetch_kind, content_type, filename, fetched_at, content) -> with content hash,
    extension, content-addressed storage name and dated folder; rows without bytes are left out."""
    digest = F.sha2("content", 256)
    suffix = extension(F.col("content_type"), F.col("source_url"))
    return fetches.where("content is not null").withColumns({
        "content_hash": digest, "extension": suffix, "storage_name": storage_name(digest, suffix, F.col("filename")), "storage_folder": storage_partition(F.col("source_name"), F.col("fetched_at"), F.col("fetch_kind")),
    })


def export_rows(spark: SparkSession, path: str) -> DataFrame:
    """CSV exports -> path, row_ordinal (1-based per file) and cells, a map by header. A byte-order mark is dropped,
    undecodable bytes become U+FFFD, quoted line breaks stay, blank lines are skipped, short rows are filled with ''
    and cells beyond the header are dropped; of equal headers the last counts. A file is read in as many tasks as it has
    ranges (spark.sql.files.maxPartitionBytes)."""
    rows = csv_ranges.records(spark, path)
    last = F.filter(F.transform("cells", lambda h, k: F.struct(h.alias("name"), k.alias("at"))), lambda e: ~F.array_contains(F.slice("cells", e["at"] + 2, F.size("cells")), e["name"]))
    headers = rows.where("ordinal = 0").select(F.col("path").alias("of"), last.alias("columns"))
    named = rows.where("ordinal > 0").join(headers, F.col("path") == F.col("of"))
    cells = F.map_from_entries(F.transform("columns", lambda e: F.struct(e["name"], F.coalesce(F.get("cells", e["at"]), F.lit("")))))
    return named.select("path", F.col("ordinal").alias("row_ordinal"), cells.alias("cells"))


def preview(rows: DataFrame, limit: int = 5, width: int = 500) -> DataFrame:
    """The first rows of each file, cells cut."""
    return rows.where(F.col("row_ordinal") <= limit).withColumn("cells", F.transform_values("cells", lambda k, v: F.substring(v, 1, width)))


def resolved(manifest: DataFrame, files: DataFrame, roots: list[str], path: str = "storage_path") -> DataFrame:
    """manifest with resolved_path: its path if that is absolute and among the files (path), else the first of the roots
    under which there is such a file; null if there is none. Backslashes count as slashes."""
    plain = F.replace(F.col(path), F.lit("\\"), F.lit("/"))
    under = F.when(plain.startswith("/"), F.array(plain)).otherwise(F.array(*[F.concat(F.lit(r.rstrip("/") + "/"), plain) for r in roots]))
    wanted = manifest.select(F.col(path).alias("__wanted"), F.posexplode(under).alias("__nth", "__there")).distinct()
    found = wanted.join(files.select(F.regexp_replace("path", r"^[a-z0-9]+:(//)?(?=/)", "").alias("__there")).distinct(), "__there")
    first = found.groupBy("__wanted").agg(F.min_by("__there", "__nth").alias("resolved_path"))
    return manifest.join(first, manifest[path] == first["__wanted"], "left").drop("__wanted")
