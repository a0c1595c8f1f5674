"""Near duplicates by 64-bit SimHash, linked through pivot distance tables.

Fingerprints come from word 3-shingles. A table of Hamming distances to the reference fingerprints decides which
pairs are looked at: by the triangle inequality a pair whose table rows differ by more than the radius in any
coordinate can't link and is discarded unseen, and the survivors are verified bit by bit.

References alone can't deal the pairs out to tasks, as distances from random references to random fingerprints hardly
differ and nearly every cell would meet nearly every other. Two fingerprints within two bits agree on one of three
blocks of bits at least, so fingerprints are dealt out by block, the coarsest deal that loses no pair; a block of 21
bits leaves one random pair in 700,000 together, and of such pairs the table passes about one in five million
(measured: 4 of 20 million random pairs with an equal block).

Rows with equal fingerprints are grouped before any comparison, a bucket gives a spanning forest and never its pairs,
and a bucket with more than `BUCKET` fingerprints is cut into chunks that meet two by two in tasks of their own.

Defined cases: null or empty text, or one without a word, has fingerprint zero and links like any other; rows
repeated whole get one result each; a null doc_id stays null and names no component unless all its rows are null
(then component_id is null); other columns are ignored. Whole texts are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tendril.llm.shared import passing, table, written

SHINGLE = 3
SEED = 42
RADIUS = 2
REFERENCES = 24
BLOCKS = ((0, 22), (22, 21), (43, 21))  # first bit and width; one more than the radius
BUCKET = 8192

_LANE = np.uint64(0x0101010101010101)
_SHIFTS = np.arange(8, dtype=np.uint64)[:, None]
_PIVOTS = np.random.default_rng(20_11).integers(0, 2**64, REFERENCES, dtype=np.uint64)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits set: eight byte-wide counters ride in each 64-bit word."""
    total = np.zeros((8, 8), np.int64)
    for at in range(0, len(hashes), 65_025):
        lanes = (hashes[None, at : at + 65_025] >> _SHIFTS) & _LANE
        sums = np.add.reduceat(lanes, np.arange(0, lanes.shape[1], 255), axis=1)
        total += np.ascontiguousarray(sums).view(np.uint8).reshape(8, -1, 8).sum(axis=1, dtype=np.int64)
    return total.T.reshape(64)  # bit = 8 * byte + shift


def fingerprint(text: bytes | None) -> int:
    """SimHash of one text's word 3-shingles, as an unsigned 64-bit number."""
    words = (text or b"").lower().split()  # on bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = [0, *(ends[: -SHINGLE] + 1).tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter(
            (digest(joined[a:b], SEED) for a, b in zip(starts, ends[SHINGLE - 1 :].tolist(), strict=True)), np.uint64, len(starts)
        )
    bits = 2 * bit_counts(hashes) > len(hashes)
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> doc_id, fp (the fingerprint's bits as a signed long); a narrow job."""
    kept = docs.select("doc_id", F.col("text").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(x.as_py()) for x in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return kept.mapInArrow(run, f"doc_id {kept.schema['doc_id'].dataType.simpleString()}, fp bigint")


def forest(fps: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Of one bucket's distinct fingerprints: the linked ones that aren't roots, and their roots."""
    table_ = np.bitwise_count(fps[:, None] ^ _PIVOTS[None, :]).astype(np.int8)
    order = np.argsort(table_[:, 0], kind="stable")
    fps, table_ = fps[order], table_[order]
    first = table_[:, 0].astype(np.int64)
    low, high = np.searchsorted(first, first - radius), np.searchsorted(first, first + radius, side="right")
    root = np.full(len(fps), -1, np.int64)
    for start in range(len(fps)):
        if root[start] >= 0:
            continue
        root[start] = start
        queue = [start]
        while queue:
            i = queue.pop()
            near = low[i] + np.flatnonzero(root[low[i] : high[i]] < 0)
            if len(near):
                near = near[np.abs(table_[near] - table_[i]).max(axis=1) <= radius]
                near = near[np.bitwise_count(fps[near] ^ fps[i]) <= radius]
                root[near] = start
                queue.extend(near.tolist())
    child = np.flatnonzero(root != np.arange(len(fps)))
    return fps[child], fps[root[child]]


def _bucket_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, pair, fp), sorted by the first two -> links (a, b) of each bucket's forest."""

    def links(rows: np.ndarray) -> pa.RecordBatch | None:
        cuts = np.flatnonzero((rows[1:, :2] != rows[:-1, :2]).any(axis=1)) + 1
        ends = np.append(cuts, len(rows))
        starts = np.insert(cuts, 0, 0)
        many = ends - starts > 1
        found = [forest(np.unique(rows[a:b, 2].view(np.uint64))) for a, b in zip(starts[many], ends[many], strict=True)]
        found = [x for x in found if len(x[0])]
        if not found:
            return None
        a, b = (np.concatenate(x).view(np.int64) for x in zip(*found, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    rest = np.empty((0, 3), np.int64)
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.concatenate([rest, np.column_stack([batch.column(k).to_numpy() for k in range(3)])])
        last = np.flatnonzero((rows[:, :2] != rows[-1, :2]).any(axis=1))
        cut = int(last[-1]) + 1 if len(last) else 0
        if cut and (out := links(np.ascontiguousarray(rows[:cut]))) is not None:
            yield out
        rest = rows[cut:]
    if len(rest) and (out := links(np.ascontiguousarray(rest))) is not None:
        yield out


def fingerprint_links(distinct: DataFrame) -> DataFrame:
    """distinct (fp) -> links (a, b) that connect exactly the fingerprints within the radius, or through others."""
    blocks = [F.shiftrightunsigned("fp", start).bitwiseAND(F.lit(2**width - 1)) for start, width in BLOCKS]
    dealt = distinct.select("fp", F.explode(F.array(*[F.lit(n << 32).bitwiseOR(b) for n, b in enumerate(blocks)])).alias("bucket"))
    sizes = written(dealt.groupBy("bucket").count().where("count > 1"), "block_sizes")
    chunks = F.ceil(F.col("count") / BUCKET).cast("int")
    own = F.pmod(F.hash("fp"), chunks)
    # a chunk meets itself and every other one; with a single chunk that is the whole bucket
    pair = F.explode(F.transform(F.sequence(F.lit(0), chunks - 1), lambda c: (F.least(c, own) * 65536 + F.greatest(c, own)).cast("long")))
    met = dealt.join(sizes, "bucket").select("bucket", pair.alias("pair"), "fp")
    return met.repartition("bucket", "pair").sortWithinPartitions("bucket", "pair").mapInArrow(_bucket_links, "a bigint, b bigint")


def connected(links: DataFrame) -> DataFrame:
    """links (a, b) -> stars (node, root), root the smallest node of the component and no row for it itself.

    Alternates large stars and small stars until nothing changes; every round is written to the shared folder, so
    lineage stays short, and so are each node's least neighbours, so that the join with a hub's links can be split.
    """

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen, now = None, mark(edges)
    while now != seen:
        with passing(links.sparkSession):
            both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
            least = written(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), "least")
            large = written(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large_stars")
            least = written(large.groupBy("a").agg(F.min("b").alias("m")), "least")
            small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
            edges = written(small.select("e.*").where("a <> b").distinct(), "edges", keep=True)
        seen, now = now, mark(edges)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> doc_id, fingerprint (16 hex digits), component_id: one row per document."""
    fps = written(fingerprints(docs), "fingerprints")
    with passing(docs.sparkSession):
        first = written(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct_fingerprints")
        stars = written(connected(fingerprint_links(first.select("fp"))), "stars")
        member = stars.select(F.col("node").alias("fp"), "root").union(stars.select(F.col("root").alias("fp"), "root").distinct())
        component = written(member.join(first, "fp").groupBy("root").agg(F.min("first").alias("component")), "components")
        linked = member.join(component, "root").select("fp", "component")
        # a table of its own, so that the last join has a plain shuffle on either side and a hot fingerprint can be split
        classes = written(first.join(linked, "fp", "left").select("fp", F.coalesce("component", "first").alias("component_id")), "classes", keep=True)
    return fps.join(classes, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
