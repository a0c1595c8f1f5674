"""Prefix trie of conversations, rolled up by centroid decomposition.

Every node is a distinct sequence of first turns. Sequences are told apart by prefix sums of the turns' SHA-256 digests,
taken with their positions (four lanes of 60 bits): sums add up, so a conversation of any length is spread over as many
tasks as a range sort gives it, each adds its own turns, and what came before is carried in, one row per task. No
conversation, node or group of copies meets in one task as a whole.

Rolling up a node's subtree must not take a round per level, as tries can be as deep as a conversation is long. The
parent-edge forest is split instead: the centroid of a component is its deepest node with at least half of the
component's rows below (a node weighs its conversations, and what is below it weighs the rows of its members from there
on, so weights are known without a roll-up). The centroid's total is added to each node on the path up to the
component's top; what hung below the centroid and what is left above it are components of their own, at most half as
heavy. Large components are split by joins, all at a time and in a number of rounds that is at most the logarithm of
all rows; those of at most `LOCAL` nodes go on within a task by the same steps.

A node is named by its smallest conversation and its depth. Which node a conversation passes at a depth is a table
(`passes`), so ancestors and paths are looked up, not walked.

The digest of the conversations that end at a node is over sorted ids, formatted by the range-sorted tasks in pieces; a
node whose ids lie in one task is finished there, the others' pieces are hashed one after the other as they stream by.

Defined cases: a null role or text is empty; turns that tie go by the digest of role and text (a null turn comes first);
repeated rows are turns each; rows without a conv_id belong to no conversation and are left out; a remainder has the
sign of its id, as in SQL; no conversations: no rows, not even the root. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tendril.llm.shared import maybe_broadcast, passing, table, written

FAMILY, MOST_SHARED = 20, 4
#: Nodes of a component that one task may split on its own.
LOCAL = 50_000
#: Ids that are formatted into one piece.
PIECE_IDS = 50_000
LANE = (1 << 60) - 1
WORDS = r"[^\x20\x09-\x0D]+"

c = F.col


# ---- running sums along a key, without a task per key


def running(df: DataFrame, key: str, order: list[Column], lanes: list[str]) -> DataFrame:
    """df with each lane replaced by its sum over the key's rows up to there, modulo 2^60; a key is a long and not null.
    Rows are sorted by range; each task adds up its own, then takes on what the key had in the tasks before."""
    names = [x for x in df.columns if x not in lanes]
    fields = ", ".join(f"`{x}` {df.schema[x].dataType.simpleString()}" for x in names) + "".join(f", `{x}` bigint" for x in lanes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth, last, so_far = TaskContext.get().partitionId(), 0, None, np.zeros(len(lanes), np.uint64)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = batch.column(key).to_numpy(zero_copy_only=False)
            own = np.stack([batch.column(x).to_numpy(zero_copy_only=False).astype(np.uint64) for x in lanes], axis=1)
            sums = np.cumsum(own, axis=0, dtype=np.uint64)  # wraps, and 2^60 divides 2^64
            first = np.flatnonzero(np.r_[keys[0] != last, keys[1:] != keys[:-1]])  # rows with which a key begins
            before, began = np.zeros_like(sums), np.zeros(n, np.int64)
            before[first], began[first] = sums[first] - own[first], first
            sums = sums - before[np.maximum.accumulate(began)]
            sums[: first[0] if len(first) else n] += so_far
            sums &= np.uint64(LANE)
            last, so_far = keys[-1], sums[-1]
            columns = [*(batch.column(x) for x in names), *(pa.array(sums[:, k].astype(np.int64)) for k in range(len(lanes)))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.full(n, part, np.int32)), pa.array(np.arange(nth, nth + n))], [*names, *lanes, "__part", "__nth"])
            nth += n

    in_order = df.repartitionByRange(c(key), *order).sortWithinPartitions(c(key), *order).select(*names, *lanes)
    own = written(in_order.mapInArrow(run, f"{fields}, __part int, __nth bigint"), "running")
    edges = own.groupBy("__part").agg(F.min(key).alias("first"), F.max(key).alias("last"), *[F.max_by(x, "__nth").alias(x) for x in lanes]).collect()  # a row per task
    carries, carried, before = [], [0] * len(lanes), None
    for edge in sorted(edges, key=lambda r: r["__part"]):
        goes_on = before is not None and before["last"] == edge["first"]
        carried = [(before[x] + (v if before["first"] == before["last"] else 0)) & LANE if goes_on else 0 for x, v in zip(lanes, carried, strict=True)]
        if goes_on:
            carries.append((edge["__part"], edge["first"], *carried))
        before = edge
    if not carries:
        return own.drop("__part", "__nth")
    carry = df.sparkSession.createDataFrame(carries, "__in int, __key bigint" + "".join(f", `__add_{x}` bigint" for x in lanes))
    met = own.join(F.broadcast(carry), (c("__part") == c("__in")) & (c(key) == c("__key")), "left")  # a row per task at most
    return met.select(*names, *[(c(x) + F.coalesce(c(f"__add_{x}"), F.lit(0))).bitwiseAND(LANE).alias(x) for x in lanes])


# ---- conversations, nodes, passes

LANES = ["k0", "k1", "k2", "k3"]


def rebuilt(conversations: DataFrame, family: int = FAMILY, most_shared: int = MOST_SHARED) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id, length), and their turns (conv_id, depth, digest, words, length) after the first turns of
    each were replaced by those of its family's first conversation."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    turns = conversations.where("conv_id IS NOT NULL").select(c("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"), F.regexp_count(text, F.lit(WORDS)).cast("long").alias("words"), F.lit(1).cast("long").alias("nth"))
    turns = running(turns, "conv_id", [c("turn").asc_nulls_first(), c("digest")], ["nth"]).drop("turn")
    sizes = written(turns.groupBy("conv_id").agg(F.max("nth").alias("n")), "sizes")
    base = c("conv_id") - c("conv_id") % family
    shared = F.crc32(c("conv_id").cast("string").cast("binary")) % most_shared
    known = sizes.select("conv_id", "n", base.alias("base"), shared.alias("h")).join(sizes.select(c("conv_id").alias("base"), c("n").alias("base_n")), "base", "left")
    taken = F.least("h", F.coalesce("base_n", F.lit(0)))
    convs = written(known.select("conv_id", "base", "h", taken.alias("taken"), (taken + F.greatest(c("n") - c("h"), F.lit(0))).alias("length")), "conversations")
    own = turns.join(convs, "conv_id").where("nth > h").select("conv_id", (c("nth") - c("h") + c("taken")).alias("depth"), "digest", "words", "length")
    first = turns.where(c("nth") < most_shared).withColumnRenamed("conv_id", "base")
    theirs = convs.join(first, "base").where("nth <= taken").select("conv_id", c("nth").alias("depth"), "digest", "words", "length")
    return convs.select("conv_id", "length"), own.union(theirs)


def trie(convs: DataFrame, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (node, depth, parent, n_convs, n_children, weight, words) and passes (conv_id, depth, node, parent), both
    written; the root is a node, but passes begin below it."""
    root, n, total = convs.agg(F.min("conv_id"), F.count(F.lit(1)), F.sum("length")).first()
    lanes = [F.xxhash64(F.lit(k), "depth", "digest").bitwiseAND(LANE).alias(x) for k, x in enumerate(LANES)]
    prefixes = written(running(turns.select("conv_id", "depth", "words", "length", *lanes), "conv_id", [c("depth")], LANES), "prefixes")
    nodes = prefixes.groupBy("depth", *LANES).agg(F.min("conv_id").alias("node"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"), F.sum("length").alias("lengths"))
    nodes = written(nodes, "nodes")
    ways = written(prefixes.select("conv_id", "depth", *LANES).join(nodes.select("depth", *LANES, "node"), ["depth", *LANES]).select("conv_id", "depth", "node"), "ways")
    above = ways.select("conv_id", (c("depth") + 1).alias("depth"), c("node").alias("parent"))
    passes = written(ways.join(above, ["conv_id", "depth"], "left").select("conv_id", "depth", "node", F.coalesce("parent", F.lit(root)).cast("long").alias("parent")), "passes", keep=True)
    own = passes.where("conv_id = node").select("node", "depth", "parent")
    top = convs.sparkSession.createDataFrame([(root, 0, None, n, 0, int(total))] if n else [], "node bigint, depth bigint, parent bigint, n_convs bigint, words bigint, lengths bigint")
    all_ = nodes.join(own, ["node", "depth"]).select(*top.columns).union(top)
    children = all_.where("parent IS NOT NULL").groupBy(c("parent").alias("node"), (c("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    weight = c("lengths") - c("n_convs") * (c("depth") - 1)
    out = all_.join(children, ["node", "depth"], "left").select("node", "depth", "parent", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), weight.alias("weight"), "words")
    return written(out, "trie", keep=True), passes


# ---- roll-up by centroid decomposition


def rolled_up(nodes: DataFrame, passes: DataFrame, values: list[str], local: int = LOCAL) -> DataFrame:
    """nodes with each of `values` replaced by its sum over the node's subtree.

    A round splits every component of more than `local` nodes at its centroid: the centroid's total goes to all nodes on
    its path to the top, and the component to what hangs below each child of the centroid and what is left above."""
    spark = nodes.sparkSession
    sums = [f"sum_{v}" for v in values]
    comp = ["top", "top_depth"]
    root = nodes.where("depth = 0").select(c("node").alias("top"), c("depth").alias("top_depth"))
    state = nodes.select("*", *[F.lit(0).cast("long").alias(s) for s in sums]).join(F.broadcast(root))  # a row at most
    kept = state.columns
    finished, small = [], []
    while True:
        sizes = state.groupBy(*comp).agg(F.count(F.lit(1)).alias("__n"), F.max("weight").alias("__total")).where(c("__n") > local)
        large = maybe_broadcast(written(sizes, "large"))
        if large.isEmpty():
            break
        small.append(state.join(large, comp, "left_anti"))
        active = state.join(large, comp)
        halves = active.where(c("weight") * 2 >= c("__total")).groupBy(*comp).agg(F.max_by(F.struct("node", "depth", "weight"), "depth").alias("z"))
        centroids = maybe_broadcast(written(halves.select(*comp, c("z.node").alias("z"), c("z.depth").alias("zd"), c("z.weight").alias("zw")), "centroids"))
        step = passes.select(c("conv_id").alias("node"), (c("depth") - 1).alias("zd"), c("node").alias("child"), c("parent").alias("of"))
        path = passes.join(centroids, c("conv_id") == c("z")).where("depth BETWEEN top_depth AND zd").select("node", "depth")
        path = path.union(centroids.where("top_depth = 0").select("top", "top_depth")).withColumn("up", F.lit(True))
        is_z = (c("node") == c("z")) & (c("depth") == c("zd"))
        below = (c("depth") > c("zd")) & (c("of") == c("z"))
        marked = active.join(centroids, comp).join(step, ["node", "zd"], "left").join(path, ["node", "depth"], "left")
        marked = written(marked.select(*kept, "z", "zd", "zw", "child", is_z.alias("is_z"), F.coalesce(below, F.lit(False)).alias("below"), F.coalesce("up", F.lit(False)).alias("up")), "marked")
        totals = marked.where("is_z OR below").groupBy(*comp).agg(*[F.sum(v).alias(f"__{v}") for v in values])
        met = marked.join(maybe_broadcast(written(totals, "totals")), comp)
        added = {s: F.when(c("up"), c(s) + c(f"__{v}")).otherwise(c(s)) for s, v in zip(sums, values, strict=True)}
        met = met.withColumns(added | {"weight": F.when(c("up") & ~c("is_z"), c("weight") - c("zw")).otherwise(c("weight"))})
        met = met.withColumns({"top": F.when(c("below"), c("child")).otherwise(c("top")), "top_depth": F.when(c("below"), c("zd") + 1).otherwise(c("top_depth"))})
        met = written(met.select(*kept, "is_z"), "split")
        finished.append(met.where("is_z").select(*kept))
        state = met.where("NOT is_z").select(*kept)
    for part in small:
        state = state.union(part.select(*kept))
    done = _within_tasks(state, values, sums)
    for part in finished:
        done = done.union(part)
    return done.select(*[x for x in nodes.columns if x not in values], *[c(s).alias(v) for s, v in zip(sums, values, strict=True)])


def _within_tasks(state: DataFrame, values: list[str], sums: list[str]) -> DataFrame:
    """The same steps for whole components within a task."""
    names = state.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def split(whole: pa.Table) -> pa.RecordBatch:
            at = {x: whole.column(x).to_pylist() for x in ("node", "depth", "parent", "top", "top_depth", "weight")}
            place = {key: k for k, key in enumerate(zip(at["node"], at["depth"], strict=True))}
            parent = [-1 if (n, d) == top else place[p, d - 1] for n, d, p, *top in zip(at["node"], at["depth"], at["parent"], at["top"], at["top_depth"], strict=True) for top in [tuple(top)]]
            own = [whole.column(v).to_pylist() for v in values]
            added = [whole.column(s).to_pylist() for s in sums]
            begins = [k for k, p in enumerate(parent) if p < 0]
            for a, b in zip(begins, [*begins[1:], len(parent)], strict=True):
                decompose(range(a, b), parent, at["weight"], own, added)
            out = {x: whole.column(x) for x in names} | dict(zip(sums, added, strict=True))
            return pa.RecordBatch.from_pydict({x: v.combine_chunks() if isinstance(v, pa.ChunkedArray) else pa.array(v, pa.int64()) for x, v in out.items()})

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= LOCAL:
                whole = pa.Table.from_batches(held)
                top, deep = whole.column("top").to_numpy(), whole.column("top_depth").to_numpy()
                end = int(np.flatnonzero((top != top[-1]) | (deep != deep[-1]))[-1]) + 1 if (top[0], deep[0]) != (top[-1], deep[-1]) else 0
                if end:
                    yield split(whole.slice(0, end))
                held = whole.slice(end).to_batches()
        if sum(b.num_rows for b in held):
            yield split(pa.Table.from_batches(held))

    by = ["top", "top_depth"]
    return state.repartition(*by).sortWithinPartitions(*by, "depth").mapInArrow(run, state.schema)


def decompose(nodes, parent: list[int], weight: list[int], values: list[list[int]], added: list[list[int]]) -> None:
    """Splits a component until nothing is left of it. nodes: top first, parents before children; weight: what is below
    each node, itself included, which is kept up to date within its component."""
    waiting = [list(nodes)]
    while waiting:
        part = waiting.pop()
        top = part[0]
        z = next(k for k in reversed(part) if 2 * weight[k] >= weight[top])  # parts are in order of depth
        below: dict[int, list[int]] = {}
        of: dict[int, int] = {}  # the child of z above each node below z
        rest = []
        for k in part:
            p = parent[k]
            child = k if p == z else of.get(p)
            if k != top and child is not None:
                of[k] = child
                below.setdefault(child, []).append(k)
            elif k != z:
                rest.append(k)
        totals = [v[z] + sum(v[k] for k in of) for v in values]
        heavy, k = weight[z], z
        while True:
            for a, t in zip(added, totals, strict=True):
                a[k] += t
            if k != z:
                weight[k] -= heavy
            if k == top:
                break
            k = parent[k]
        waiting.extend(below.values())
        if rest:
            waiting.append(rest)


# ---- digests of the conversations that end at a node


def ends_digests(ends: DataFrame, piece: int = PIECE_IDS) -> DataFrame:
    """ends (node, depth, conv_id) -> node, depth and the SHA-256 of the ids, ascending and comma-joined."""
    key = ["node", "depth"]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, now, ids, n, first = TaskContext.get().partitionId(), [], None, [], 0, True

        def put(whole: bool) -> None:
            text = ",".join(map(str, ids))
            out.append((*now, part, n, None if whole else text, hashlib.sha256(text.encode()).hexdigest() if whole else None))

        def take() -> pa.RecordBatch:
            rows = list(zip(*out, strict=True)) or [[]] * 6
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.string()), strict=True)], ["node", "depth", "part", "nth", "ids", "ends_sha256"])

        for batch in batches:
            for node, depth, conv in zip(*(batch.column(x).to_pylist() for x in (*key, "conv_id")), strict=True):
                if (node, depth) != now:
                    if now:
                        put(whole=not first and n == 0)  # neither cut off before nor too long for one piece
                        first = False
                    now, ids, n = (node, depth), [], 0
                elif len(ids) >= piece:
                    put(whole=False)
                    ids, n = [], n + 1
                ids.append(conv)
            yield take()
        if now:
            put(whole=False)  # the next task may go on with it
        yield take()

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        schema = ["node", "depth", "ends_sha256"]
        row = lambda: pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int64()), pa.array([now[1]], pa.int64()), pa.array([state.hexdigest()])], schema)
        for batch in batches:
            for node, depth, ids in zip(*(batch.column(x).to_pylist() for x in (*key, "ids")), strict=True):
                if (node, depth) != now:
                    if now:
                        yield row()
                    now, state = (node, depth), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
        if now:
            yield row()

    by = [*key, "conv_id"]
    cut = written(ends.repartitionByRange(*by).sortWithinPartitions(*by).select(*by).mapInArrow(pieces, "node bigint, depth bigint, part int, nth bigint, ids string, ends_sha256 string"), "pieces", keep=True)
    streams = cut.where("ids IS NOT NULL").repartition(*key).sortWithinPartitions(*key, "part", "nth").select(*key, "ids").mapInArrow(joined, "node bigint, depth bigint, ends_sha256 string")
    return cut.where("ids IS NULL").select(*key, "ends_sha256").union(streams)


def prefix_trie(conversations: DataFrame, family: int = FAMILY, most_shared: int = MOST_SHARED, local: int = LOCAL) -> DataFrame:
    """conversations (conv_id, turn, role, text) -> a row per node of the trie of rebuilt conversations."""
    spark = conversations.sparkSession
    with passing(spark):
        convs, turns = rebuilt(conversations, family, most_shared)
        nodes, passes = trie(convs, turns)
        with_values = nodes.select("node", "depth", "parent", "n_convs", "n_children", "weight", (c("n_children") == 0).cast("long").alias("n_leaves"), ((c("n_convs") - 1) * c("words")).alias("saved_tokens"))
        rolled = rolled_up(with_values, passes, ["n_leaves", "saved_tokens"], local)
        root = nodes.where("depth = 0").select("node")
        ends = convs.where("length > 0").join(passes.withColumnRenamed("depth", "length"), ["conv_id", "length"]).select("node", c("length").alias("depth"), "conv_id")
        turnless = convs.where("length = 0").join(F.broadcast(root)).select("node", F.lit(0).cast("long").alias("depth"), "conv_id")  # the root is one row
        digests = ends_digests(ends.union(turnless))
        out = rolled.join(digests, ["node", "depth"], "left").select(
            c("node").alias("conv_id"), "depth", c("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
        )
        return written(out, "nodes", keep=True)


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


#: The same in SQL, where each node is met by all of its ancestors. CRC-32 is worked out bit by bit.
OP12_SQL = f"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS nth
  FROM conversations WHERE conv_id IS NOT NULL
), n AS (
  SELECT c, n, c - c % {FAMILY} AS base, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(c AS VARCHAR), ''), lambda y: CAST(ascii(y) AS BIGINT))),
    lambda a, b: list_reduce(list_prepend(xor(a, b), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])), lambda y, i: xor(y >> 1, 3988292384 * (y & 1)))), 4294967295) % {MOST_SHARED} AS h
  FROM (SELECT c, count(*) AS n FROM t GROUP BY c)
), own AS (
  SELECT n.c, t.nth AS d, r, x FROM n JOIN t ON t.c = n.base AND t.nth <= n.h
  UNION ALL SELECT t.c, t.nth - n.h + least(n.h, coalesce(b.n, 0)), r, x FROM t JOIN n ON n.c = t.c LEFT JOIN n b ON b.c = n.base WHERE t.nth > n.h
), p AS (SELECT c, d, x, list({{'r': r, 'x': x}}) OVER (PARTITION BY c ORDER BY d) AS s FROM own
), below AS (SELECT d, s, min(c) AS node, count(*) AS n_convs, any_value(x) AS x FROM p GROUP BY d, s
), root AS (SELECT min(c) AS node, count(*) AS n_convs FROM n
), ways AS (SELECT p.c, p.d, b.node FROM p JOIN below b USING (d, s) UNION ALL SELECT n.c, 0, root.node FROM n, root
), nodes AS (
  SELECT b.node, b.d, w.node AS parent, b.n_convs, (b.n_convs - 1) * len(regexp_extract_all(b.x, '{WORDS}')) AS saved FROM below b JOIN ways w ON w.c = b.node AND w.d = b.d - 1
  UNION ALL SELECT node, 0, NULL, n_convs, 0 FROM root WHERE node IS NOT NULL
), kids AS (SELECT parent AS node, d - 1 AS d, count(*) AS k FROM nodes WHERE parent IS NOT NULL GROUP BY 1, 2
), full_nodes AS (SELECT nodes.*, coalesce(k, 0) AS k FROM nodes LEFT JOIN kids ON kids.node = nodes.node AND kids.d = nodes.d
), rolled AS (
  SELECT w.node, w.d, sum(CASE WHEN u.k = 0 THEN 1 ELSE 0 END) AS leaves, sum(u.saved) AS saved FROM full_nodes u JOIN ways w ON w.c = u.node AND w.d <= u.d GROUP BY 1, 2
), ends AS (
  SELECT w.node, w.d, string_agg(CAST(w.c AS VARCHAR), ',' ORDER BY w.c) AS ids FROM (SELECT c, max(d) AS d FROM ways GROUP BY c) e JOIN ways w ON w.c = e.c AND w.d = e.d GROUP BY 1, 2
)
SELECT f.node AS conv_id, CAST(f.d AS BIGINT) AS depth, f.parent AS parent_conv_id, CAST(f.n_convs AS BIGINT) AS n_convs, CAST(f.k AS BIGINT) AS n_children, CAST(r.leaves AS BIGINT) AS n_leaves,
  CAST(r.saved AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM full_nodes f JOIN rolled r ON r.node = f.node AND r.d = f.d LEFT JOIN ends e ON e.node = f.node AND e.d = f.d
"""
