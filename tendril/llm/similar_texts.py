"""Documents of similar texts, as the pipeline's near-dedup stage needs them: five-word shingles, Jaccard 0.8 or more.

The SimHash operator with a wide radius, over distinct shingles: texts that similar mostly differ in up to about twenty
bits, where blocks of bits no longer deal the pairs out, so documents are dealt out by `BANDS` pairs of MinHash values of their shingles (a pair of
similarity 0.8 shares none with a chance of 4 in 100,000). In each bucket the table of distances to the reference
fingerprints bounds Hamming distances from below, pairs beyond `RADIUS` are put off by it or on sight, and the rest
is cut down to a minimum spanning forest, at most a link per fingerprint and never all pairs. Every link is then
verified by exact Jaccard similarity of the two texts' shingle sets, and verified links are joined to parts.

That settles most buckets cheaply, but it decides nothing: a bucket whose documents aren't all of one part after it is
taken again with its shingle sets, and every pair of two parts is tested exactly (`links_across`), so that each
similar pair of a bucket ends in one component, whatever its fingerprints and whatever links were refuted. A bucket's
largest part never meets itself there; large buckets are cut into chunks that meet two by two in tasks of their own.

Copies of whole texts are grouped by digest first. Defined cases: null texts count as empty; texts without a word are
similar to each other; rows are told apart by doc_id and text (`shared.keyed`), so null ids and ids of several texts
are judged row by row, a null id coming first; rows repeated whole are one document and stay together; other columns
are ignored. Whole texts are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tendril.llm.shared import keyed, maybe_broadcast, passing, written
from tendril.llm.simhash_dedup import _PIVOTS, BUCKET, SEED, bit_counts, connected

SHINGLE = 5
SIMILAR = 80  # hundredths
RADIUS = 22
BANDS = 11
SHINGLES = 1 << 20  # of a chunk of a bucket, where whole sets are compared
_ODD = np.random.default_rng(80).integers(0, 2**63, 2 * BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_hashes(text: bytes | None) -> np.ndarray:
    """Hashes of the text's five-word shingles, repeats included; a shorter text is one shingle."""
    words = (text or b"").lower().split()
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[:-SHINGLE] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends[SHINGLE - 1 :].tolist(), strict=True)), np.uint64, len(starts))


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, text) -> id, fp, bands, n (distinct shingles)."""
    for batch in batches:
        fps, bands, sizes = [], [], []
        for x in batch.column(1):
            h = np.unique(shingle_hashes(x.as_py()))  # similarity is of distinct shingles, so the bits are too
            bits = 2 * bit_counts(h) > len(h)
            fps.append(int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little", signed=True))
            low = np.array([((h * m) ^ ((h * m) >> np.uint64(29))).min() for m in _ODD])
            key = (low[::2] * np.uint64(0x9E3779B97F4A7C15)) ^ (low[1::2] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ np.arange(BANDS, dtype=np.uint64)
            bands.append(key.view(np.int64).tolist())
            sizes.append(len(h))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(sizes, pa.int64())], ["id", "fp", "bands", "n"])


def spanning_forest(fps: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links (positions) of a minimum spanning forest of the fingerprints, none longer than the radius."""
    size = len(fps)
    refs = np.bitwise_count(fps[:, None] ^ _PIVOTS[None, :]).astype(np.int8)
    far = np.full(size, radius + 1, np.int16)  # from the tree, so far
    via = np.zeros(size, np.int64)
    out = np.zeros(size, bool)
    a, b = [], []
    now = 0
    for _ in range(size):
        out[now] = True
        rest = np.flatnonzero(~out)
        if not len(rest):
            break
        rest_near = rest[np.abs(refs[rest] - refs[now]).max(axis=1) <= far[rest]]  # the others can't come nearer
        d = np.bitwise_count(fps[rest_near] ^ fps[now]).astype(np.int16)
        nearer = d <= far[rest_near]  # of links as short the newest counts: chains, not hubs with a link to each
        far[rest_near[nearer]], via[rest_near[nearer]] = d[nearer], now
        now = int(rest[far[rest].argmin()])
        if far[now] <= radius:
            a.append(now)
            b.append(int(via[now]))
    return np.array(a, np.int64), np.array(b, np.int64)


def _bucket_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (band, pair, fp, id) in order -> links (a, b) of ids."""

    def links(rows: np.ndarray) -> pa.RecordBatch:
        cuts = np.flatnonzero((rows[1:, :2] != rows[:-1, :2]).any(axis=1)) + 1
        found = []
        for part in np.split(rows, cuts):
            if len(part) > 1:
                a, b = spanning_forest(part[:, 2].copy().view(np.uint64))
                found.append(np.column_stack([part[a, 3], part[b, 3]]))
        pairs = np.concatenate(found) if found else np.empty((0, 2), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs.max(axis=1, initial=-(2**63))), pa.array(pairs.min(axis=1, initial=2**63 - 1))], ["a", "b"])

    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.column_stack([batch.column(k).to_numpy() for k in range(4)])
        other = np.flatnonzero((rows[:, :2] != rows[-1, :2]).any(axis=1))
        start = int(other[-1]) + 1 if len(other) else 0
        if held and (start or last != tuple(rows[0, :2])):
            yield links(np.concatenate([*held, rows[:start]]))
            held = [rows[start:]]
        elif start:
            yield links(rows[:start])
            held = [rows[start:]]
        else:
            held.append(rows)
        last = tuple(rows[-1, :2])
    if held:
        yield links(np.concatenate(held))


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (a, b, texts of both) -> those whose shingle sets are similar."""
    for batch in batches:
        keep = []
        for x, y in zip(batch.column(2), batch.column(3), strict=True):
            s, t = np.unique(shingle_hashes(x.as_py())), np.unique(shingle_hashes(y.as_py()))
            both = len(np.intersect1d(s, t, assume_unique=True))
            keep.append(100 * both >= SIMILAR * (len(s) + len(t) - both))
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def _shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, text) -> id, shingles (distinct, sorted)."""
    for batch in batches:
        sets = [np.unique(shingle_hashes(x.as_py())).view(np.int64) for x in batch.column(1)]
        ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
        flat = np.concatenate(sets) if sets else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["id", "shingles"])


def links_across(part: np.ndarray, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Links (positions) of similar sets that join all parts which have a similar pair between them, no more links
    than parts. The largest part comes last, when nothing is left to be compared with it."""
    _, part, members = np.unique(part, return_inverse=True, return_counts=True)
    order = np.lexsort((part, members[part]))
    part, sets = part[order], [sets[k] for k in order]
    sizes = np.array([len(x) for x in sets])
    start_of = np.append(0, np.cumsum(sizes))
    _, shingle, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    holders = np.repeat(np.arange(len(sets)), sizes)[np.argsort(shingle, kind="stable")]
    first = np.cumsum(counts) - counts
    after = np.searchsorted(members[part] * len(members) + part, members[part] * len(members) + part, side="right")
    root = np.arange(len(members))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    a, b = [], []
    for k in range(len(sets)):
        rest = slice(after[k], len(sets))
        if not (100 * np.minimum(sizes[rest], sizes[k]) >= SIMILAR * np.maximum(sizes[rest], sizes[k])).any():
            continue
        own = shingle[start_of[k] : start_of[k + 1]]
        own = own[counts[own] > 1]
        many = counts[own]
        at = np.repeat(first[own] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        both = np.bincount(holders[at], minlength=len(sets))[rest]
        for j in (after[k] + np.flatnonzero(100 * both >= SIMILAR * (sizes[k] + sizes[rest] - both))).tolist():
            x, y = find(part[k]), find(part[j])
            if x != y:
                root[y] = x
                a.append(order[k])
                b.append(order[j])
    return np.array(a, np.int64), np.array(b, np.int64)


def _links_across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (band, pair, part, id, shingles) sorted by the first two -> links (a, b) of ids."""

    def links(rows: list[tuple]) -> pa.RecordBatch:
        ids = np.array([x[1] for x in rows], np.int64)
        a, b = links_across(np.array([x[0] for x in rows], np.int64), [x[2] for x in rows])
        return pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(ids[b])], ["a", "b"])

    held, last = [], None
    for batch in batches:
        band, pair, part, ids = (batch.column(k).to_numpy() for k in range(4))
        for k in range(batch.num_rows):
            if last != (now := (band[k], pair[k])):
                if len(held) > 1:
                    yield links(held)
                held, last = [], now
            held.append((part[k], ids[k], batch.column(4)[k].values.to_numpy().copy()))
    if len(held) > 1:
        yield links(held)


_LARGEST = 1 << 31  # chunks of a bucket's largest part are numbered from here


def _pair(a: Column, b: Column) -> Column:
    return F.shiftleft(F.least(a, b), 32).bitwiseOR(F.greatest(a, b))


def _chunk_pairs(chunks: Column) -> Column:
    """A row for each pair of chunks in which the id's chunk meets another one or itself."""
    mine = F.pmod(F.xxhash64("id"), chunks)
    return F.explode(F.transform(F.sequence(F.lit(0).cast("long"), chunks - 1), lambda c: _pair(c, mine)))


def _pairs_across(others: Column, largest: Column, is_largest: Column) -> Column:
    """The same where the bucket's largest part, in `largest` chunks of its own, meets the others but not itself."""
    zero = F.lit(0).cast("long")
    mine = F.pmod(F.xxhash64("id"), F.when(is_largest, largest).otherwise(others))
    all_others = F.sequence(zero, others - 1)
    met = F.transform(all_others, lambda c: _pair(c, F.when(is_largest, mine + _LARGEST).otherwise(mine)))
    with_largest = F.transform(F.sequence(zero, largest - 1), lambda c: _pair(mine, c + _LARGEST))
    return F.explode(F.when(is_largest, met).otherwise(F.concat(met, with_largest)))


def remaining_links(firsts: DataFrame, sketched: DataFrame, stars: DataFrame) -> DataFrame:
    """firsts (id, text), sketched (id, bands, n), stars (node, root) -> links (a, b) of similar documents, for all
    similar pairs that share a bucket and aren't of one star or connected by those links."""
    part = sketched.join(stars.select(F.col("node").alias("id"), "root"), "id", "left").select("id", "n", "bands", F.coalesce("root", "id").alias("part"))
    dealt = written(part, "parts").select("id", "n", "part", F.explode("bands").alias("band"))
    of_part = dealt.groupBy("band", "part").agg(F.count(F.lit(1)).alias("count"), F.sum("n").alias("size"))
    found = of_part.groupBy("band").agg(F.max(F.struct("count", "size", "part")).alias("top"), F.sum("count").alias("count"), F.sum("size").alias("size")).where("count > top.count")
    chunks = lambda count, size: F.ceil(F.greatest(count / BUCKET, size / SHINGLES)).cast("long")
    unsettled = found.select("band", F.col("top.part").alias("top"), chunks(F.col("count") - F.col("top.count"), F.col("size") - F.col("top.size")).alias("others"), chunks(F.col("top.count"), F.col("top.size")).alias("largest"))
    pairs = _pairs_across(F.col("others"), F.col("largest"), F.col("part") == F.col("top"))
    met = written(dealt.join(written(unsettled, "unsettled"), "band").select("band", pairs.alias("pair"), "part", "id"), "met")
    ids = written(met.select("id").distinct(), "ids_met")
    texts = firsts.join(maybe_broadcast(ids), "id", "left_semi")
    sets = written(texts.select("id", "text").mapInArrow(_shingle_sets, "id bigint, shingles array<bigint>"), "shingle_sets")
    rows = met.join(sets, "id").select("band", "pair", "part", "id", "shingles").repartition("band", "pair").sortWithinPartitions("band", "pair")
    return rows.mapInArrow(_links_across, "a bigint, b bigint").where("a <> b").distinct()


def similar_documents(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """texts (id, text) of one row per id, rows (key, digest) -> node, root: all ids but the first of each group of
    similar texts, and that."""
    first = written(rows.groupBy("digest").agg(F.min("key").alias("first")), "first_copies")
    copies = written(rows.join(first, "digest").where("key > first").select(F.col("key").alias("a"), F.col("first").alias("b")).distinct(), "copies")
    firsts = written(texts.join(maybe_broadcast(copies.select(F.col("a").alias("id"))), "id", "left_anti"), "firsts")
    sketched = written(firsts.mapInArrow(_sketches, "id bigint, fp bigint, bands array<bigint>, n bigint"), "sketches")
    dealt = sketched.select("id", "fp", F.explode("bands").alias("band"))
    sizes = written(dealt.groupBy("band").count().where("count > 1"), "buckets")
    pair = _chunk_pairs(F.ceil(F.col("count") / BUCKET).cast("long"))
    met = dealt.join(sizes, "band").select("band", pair.alias("pair"), "fp", "id").repartition("band", "pair").sortWithinPartitions("band", "pair", "fp", "id")
    links = written(met.mapInArrow(_bucket_links, "a bigint, b bigint").where("a <> b").distinct(), "links")
    ends = written(links.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ends")
    of_ends = written(firsts.join(maybe_broadcast(ends), "id", "left_semi"), "texts_of_ends")
    with_a = links.join(of_ends.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
    with_both = with_a.join(of_ends.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb")
    stars = written(connected(with_both.mapInArrow(_verified, "a bigint, b bigint")), "stars")
    more = remaining_links(firsts, sketched, stars)
    return connected(stars.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more).union(copies))


def without_similar(docs: DataFrame) -> DataFrame:
    """docs without those that are similar to one before them, or linked to such through others; all columns stay."""
    own, rows, key, unique = keyed(docs)
    texts = own.select(F.col(key).alias("id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    with passing(docs.sparkSession):
        found = similar_documents(texts if unique else texts.dropDuplicates(["id"]), rows.select("key", "digest"))
        gone = written(found.select(F.col("node").alias(key)).distinct(), "similar", keep=True)
    return own.join(maybe_broadcast(gone), key, "left_anti").select(docs.columns)
