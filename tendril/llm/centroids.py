"""Centroid clustering of embedding vectors by scalar lookup tables.

Vectors become whole numbers first: floor(scale * x) of every component. In a round each task tabulates, for every
dimension, the squared difference between each whole number that occurs there and each centroid's component; a vector's
distances are the sums of its rows of those tables (NumPy gathers). Tables are made per Arrow batch, so they never hold
more than the batch does.

Spark deals the vectors out; a task returns counts and componentwise sums per cluster, which are added up by Spark, so
the driver sees one row per cluster and round: centroids are as many as asked for, whatever the input. The whole numbers
are written once and read in each round; nothing is shuffled but the sums.

Defined cases: vectors without exactly `dimensions` components, null ones, and those with a null, NaN or infinite
component are left out. Whole numbers beyond 2^26 count as 2^26 (below -2^26 as that), so that distances fit a long.
Repeated rows are vectors each, and may start as several equal centroids; equal hashes go by the vector itself. A null
id counts as the empty text where ids are hashed. Fewer vectors than centroids: each starts one. No vectors: no rows.
Distances that tie go to the smaller centroid number. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tendril.llm.shared import passing, table, written

DIMENSIONS, SCALE = 64, 64
CENTROIDS, ROUNDS, SEED = 16, 3, "1"
#: Whole numbers stay within this: 64 * (2 * MOST)^2 is below 2^63.
MOST = 1 << 26


def whole_numbers(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """vectors (vec_id, embedding) -> vec_id and `numbers`, of the rows with as many finite components."""
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    within: Column = F.transform(x, lambda v: F.least(F.greatest(F.floor(F.least(F.greatest(v.cast("double") * scale, F.lit(-1e9)), F.lit(1e9))), F.lit(-MOST)), F.lit(MOST)).cast("int"))
    return vectors.where((F.size(x) == dimensions) & finite).select("vec_id", within.alias("numbers"))


def starting(numbers: DataFrame, k: int = CENTROIDS, seed: str = SEED) -> list[list[int]]:
    """The k vectors whose ids hash lowest."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return [r.numbers for r in numbers.select(name.alias("h"), "numbers").orderBy("h", "numbers").limit(k).collect()]


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centroids, gathered from a table per dimension."""
    out = np.zeros((len(x), len(centroids)), np.int64)
    for d in range(x.shape[1]):
        values, at = np.unique(x[:, d], return_inverse=True)
        squares = (values[:, None] - centroids[None, :, d]) ** 2  # each number that occurs, against each centroid
        out += squares[at]
    return out


def _batches(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """ids, numbers, nearest centroid and squared distance of each batch."""
    for batch in batches:
        if batch.num_rows:
            x = batch.column("numbers").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(batch.num_rows, -1)
            all_ = distances(x, centroids)
            nearest = all_.argmin(axis=1)  # of equal ones the first
            yield batch.column("vec_id"), x, nearest, all_[np.arange(len(x)), nearest]


def moved(numbers: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Centroids after a round: each the floor of its vectors' mean; those without vectors stay."""
    at = np.array(centroids, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(len(at), np.int64), np.zeros(at.shape, np.int64)
        for _, x, nearest, _ in _batches(batches, at):
            counts += np.bincount(nearest, minlength=len(at))
            np.add.at(sums, nearest, x)
        there = np.flatnonzero(counts)
        if len(there):
            yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(counts[there]), pa.array(sums[there].tolist(), pa.list_(pa.int64()))], ["cluster", "n", "sums"])

    parts = numbers.mapInArrow(run, "cluster int, n bigint, sums array<bigint>")
    added = parts.select("cluster", "n", F.posexplode("sums").alias("d", "v")).groupBy("cluster", "d").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n"))
    out = [list(c) for c in centroids]
    for r in added.collect():  # clusters times dimensions
        out[r.cluster][r.d] = int(r.s) // r.n
    return out


def assigned(numbers: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """vec_id, cluster and squared distance of every vector."""
    at = np.array(centroids, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, nearest, distance in _batches(batches, at):
            yield pa.RecordBatch.from_arrays([ids, pa.array(nearest.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return numbers.mapInArrow(run, f"vec_id {numbers.schema['vec_id'].dataType.simpleString()}, cluster int, distance bigint")


def clustered(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, seed: str = SEED) -> tuple[DataFrame, list[list[int]]]:
    """vec_id, cluster and distance of each kept vector after the rounds, as a written table, and the centroids."""
    spark = vectors.sparkSession
    with passing(spark):
        numbers = written(whole_numbers(vectors, dimensions, scale), "numbers")
        centroids = starting(numbers, k, seed)
        for _ in range(rounds if centroids else 0):
            centroids = moved(numbers, centroids)
        found = assigned(numbers, centroids) if centroids else numbers.selectExpr("vec_id", "0 AS cluster", "CAST(0 AS BIGINT) AS distance")
        return written(found, "clusters", keep=True), centroids


def op13_lookup_table_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centroids = clustered(table(spark, sf_dir, "embeddings"))
    inertia = {r.cluster: int(r.s) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # a row per cluster
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    facts = spark.createDataFrame([(k, inertia.get(k, 0), sum(inertia.values()), name) for k, name in enumerate(names)], "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql(k: int = CENTROIDS, rounds: int = ROUNDS) -> str:
    """The same in SQL: a distance for each vector, centroid and round."""
    parts = [
        f"v AS (SELECT vec_id, x, row_number() OVER (ORDER BY sha256('{SEED}:' || CAST(vec_id AS VARCHAR)), x) AS nth FROM (SELECT vec_id, list_transform(embedding, lambda e: CAST(floor({SCALE} * CAST(e AS DOUBLE)) AS BIGINT)) AS x FROM embeddings "
        f"WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {DIMENSIONS}))",
        f"c0 AS (SELECT CAST(nth - 1 AS INTEGER) AS cluster, x FROM v WHERE nth <= {k})",
    ]
    near = "SELECT nth, any_value(vec_id) AS vec_id, any_value(x) AS x, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS d FROM (SELECT v.nth, v.vec_id, v.x, c.cluster, list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM v, {c} c) GROUP BY nth"
    for r in range(rounds):
        parts.append(f"a{r} AS ({near.format(c=f'c{r}')})")
        means = f"SELECT cluster, list(m ORDER BY i) AS x FROM (SELECT cluster, i, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS m FROM (SELECT cluster, i, sum(y) AS s, count(*) AS n FROM (SELECT cluster, unnest(x) AS y, unnest(range(len(x))) AS i FROM a{r}) GROUP BY cluster, i)) GROUP BY cluster"
        parts.append(f"c{r + 1} AS (SELECT c.cluster, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN ({means}) m ON m.cluster = c.cluster)")
    parts.append(f"f AS ({near.format(c=f'c{rounds}')})")
    name = "sha256(array_to_string(c.x, ','))"
    return f"WITH {', '.join(parts)} SELECT f.vec_id, f.cluster, CAST(f.d AS BIGINT) AS distance, CAST(sum(f.d) OVER (PARTITION BY f.cluster) AS BIGINT) AS cluster_inertia, CAST(sum(f.d) OVER () AS BIGINT) AS inertia, {name} AS centroid_sha256 FROM f JOIN c{rounds} c ON c.cluster = f.cluster"


OP13_SQL = _sql()
