"""Sharding by k-d tree: splits at distributed weighted medians along the widest metadata dimension.

A node holds rows and a number of shards to become. It is split along the dimension in which its rows spread widest
(of size, source, language and id, each scaled to the whole table's range) at the row where half its shards' share of
the bytes is reached (for an odd number, the smaller half's), until every leaf is one shard. Splits are points of a
total order (the coordinate, then a hash of the id and text, then of a row number that is written once), so one source,
one language, one group of copies or of rows repeated whole may be cut anywhere and shards come out equal in bytes.

A split point is found by narrowing an interval: each pass adds up the bytes in `BINS` equal parts of it, for all
nodes of a level at once, so what the driver sees is bounded by shards x dimensions x bins. Slots within shards come
from a range sort and per-partition counts, not from one task per shard.

Defined cases: null text has size 8 and the crc of the empty text; null source, language or id take the lowest
coordinate; rows repeated whole are sharded each, and may come to lie in several shards; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tendril.llm.shared import table, written

SHARDS = 24
OVERHEAD = 8
BINS = 2048
CLOSE = 1e-4  # of a shard's bytes, by which a split may miss
DIMENSIONS = ("size", "source", "lang", "id")
_WIDTH = 1 << 30  # of a coordinate


def metadata(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text, lang, source) -> doc_id, size, text_crc32, and a coordinate per dimension in [0, 2^62)."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    size = (F.octet_length(text) + OVERHEAD).cast("long")
    slim = docs.select("doc_id", size.alias("size"), F.crc32(text).alias("text_crc32"), F.crc32(F.coalesce(F.col("source"), F.lit("")).cast("binary")).alias("s"), F.crc32(F.coalesce(F.col("lang"), F.lit("")).cast("binary")).alias("l"))
    slim = written(slim.withColumn("nth", F.monotonically_increasing_id()), "metadata")
    low, high, most = slim.agg(F.min("doc_id"), F.max("doc_id"), F.max("size")).first()
    # 20 bits tell ids and texts apart, 12 more the rows that are the same
    tie = F.shiftleft(F.xxhash64("doc_id", "text_crc32", "size").bitwiseAND(F.lit(2**20 - 1)), 12).bitwiseOR(F.xxhash64("nth").bitwiseAND(F.lit(2**12 - 1)))

    def placed(share: Column) -> Column:
        main = F.least(F.greatest(F.floor(F.coalesce(share, F.lit(0.0)) * (_WIDTH - 1)), F.lit(0)), F.lit(_WIDTH - 1)).cast("long")
        return F.shiftleft(main, 32).bitwiseOR(tie)

    shares = {
        "size": F.log2(F.col("size").cast("double")) / F.log2(F.lit(float(most or 2))),
        "source": F.col("s") / float(2**32),
        "lang": F.col("l") / float(2**32),
        "id": (F.col("doc_id") - F.lit(low)).cast("double") / F.lit(max(1.0, float((high or 0) - (low or 0)))),
    }
    return slim.select("doc_id", "size", "text_crc32", *[placed(shares[d]).alias(f"at_{d}") for d in DIMENSIONS])


def _on(nodes: dict[int, object], value) -> Column:
    """value(of the row's node), over the nodes of a level: at most one per shard."""
    pairs = [x for n, v in nodes.items() for x in (F.lit(n), F.lit(value(v)))]
    return F.get(F.map_values(F.map_filter(F.create_map(*pairs), lambda k, v: k == F.col("node"))), F.lit(0))


def _split_points(rows: DataFrame, nodes: dict[int, tuple[str, float, float]]) -> dict[int, int]:
    """nodes: dimension, bytes wanted below the split, and bytes by which it may miss -> the split's coordinate."""
    state = {n: (0, 1 << 62, 0) for n in nodes}  # interval, bytes below it
    done: dict[int, int] = {}
    own = F.coalesce(*[F.when(F.col("node").isin(of), F.col(f"at_{d}")) for d in DIMENSIONS if (of := [n for n, x in nodes.items() if x[0] == d])])
    while len(done) < len(nodes):
        left = {n: x for n, x in state.items() if n not in done}
        step = {n: max(1, -(-(b - a) // BINS)) for n, (a, b, _) in left.items()}
        low, high = _on(left, lambda x: x[0]), _on(left, lambda x: x[1])
        inside = rows.where(F.col("node").isin(list(left))).select("node", "size", own.alias("at"), low.alias("low"), high.alias("high"), _on(step, lambda x: x).alias("step")).where("at >= low and at < high")
        sums: dict[int, dict[int, int]] = {n: {} for n in left}
        alone: set[tuple[int, int]] = set()
        for r in inside.groupBy("node", F.expr("(at - low) div step").alias("bin")).agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).collect():  # nodes x BINS at most
            sums[r.node][r.bin] = r.bytes
            if r.n == 1:
                alone.add((r.node, r.bin))
        for n, (a, b, below) in left.items():
            want, may_miss = nodes[n][1:]
            for k in sorted(sums[n]):
                if below + sums[n][k] > want:
                    break
                below += sums[n][k]
            else:
                done[n] = b
                continue
            start = a + k * step[n]
            over = below + sums[n][k] - want
            if min(want - below, over) <= may_miss or step[n] == 1 or (n, k) in alone:
                done[n] = start if want - below <= over else start + step[n]
            else:
                state[n] = (start, min(b, start + step[n]), below)
    return done


def kd_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """docs (doc_id, text, lang, source) -> doc_id, size, text_crc32, shard, slot."""
    rows = written(metadata(docs).withColumn("node", F.lit(0)), "rows")
    total = rows.agg(F.sum("size")).first()[0] or 0
    leaves = {0: (0, shards)}  # node -> its first shard and how many
    next_node = 1
    close = max(1.0, CLOSE * total / shards)
    while any(n > 1 for _, n in leaves.values()) and total:
        wide = {r.node: r for r in rows.groupBy("node").agg(F.sum("size").alias("bytes"), *[(F.max(f"at_{d}") - F.min(f"at_{d}")).alias(d) for d in DIMENSIONS]).collect()}  # a row per node
        to_split = {n: x for n, x in leaves.items() if x[1] > 1 and n in wide}
        leaves = {n: (x[0], 1) if n not in wide else x for n, x in leaves.items()}
        if not to_split:
            break
        plan = {n: (max(DIMENSIONS, key=lambda d: wide[n][d]), wide[n].bytes * (k // 2) / k, close) for n, (_, k) in to_split.items()}
        points = _split_points(rows, plan)
        moved = F.lit(None).cast("int")
        for n, (first, k) in to_split.items():
            moved = F.when((F.col("node") == n) & (F.col(f"at_{plan[n][0]}") >= points[n]), next_node).otherwise(moved)
            leaves[n], leaves[next_node] = (first, k // 2), (first + k // 2, k - k // 2)
            next_node += 1
        rows = written(rows.withColumn("node", F.coalesce(moved, F.col("node"))), "rows")  # else the plan grows by level
    of = F.create_map(*[F.lit(x) for n, (first, _) in leaves.items() for x in (n, first)])
    return slotted(rows.select("doc_id", "size", "text_crc32", of[F.col("node")].alias("shard")))


def slotted(rows: DataFrame) -> DataFrame:
    """rows with shard -> slot, gapless from 0 in each shard in the order of doc_id: a range sort, then counts by
    partition (at most one row per partition and shard) give each run's first slot."""
    sorted_ = rows.repartitionByRange("shard", "doc_id", "text_crc32").sortWithinPartitions("shard", "doc_id", "text_crc32").withColumn("nth", F.monotonically_increasing_id())
    laid = written(sorted_.withColumn("part", F.shiftright("nth", 33)), "laid")
    runs = laid.groupBy("shard", "part").agg(F.min("nth").alias("start"), F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = runs.select("shard", "part", (F.coalesce(before, F.lit(0)) - F.col("start")).alias("shift"))
    return laid.join(F.broadcast(starts), ["shard", "part"]).select("doc_id", "size", "text_crc32", "shard", (F.col("nth") + F.col("shift")).alias("slot"))


def op10_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards(table(spark, sf_dir, "documents")).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
