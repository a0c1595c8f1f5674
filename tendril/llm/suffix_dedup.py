"""Exact substring dedup over the corpus's suffix order, with longest-previous-factor tests.

A byte goes if it lies in a `MATCH`-byte string that also starts earlier (smaller doc_id, or the same document further
left). That is LPF >= MATCH for the string's first position: in suffix order, the previous or the next smaller
position shares at least MATCH bytes with it (`earlier_match`). The first copy keeps its bytes.

The suffix array is never built whole. Every MATCH-byte string has one anchor, the `GRAM`-byte piece in it with the
least hash, and equal strings have equal anchors at the same place, so suffixes are dealt out by anchor: a bucket holds
all occurrences of one anchor with the bytes around it. There the occurrences are sorted by what follows the anchor
(suffix order) and by what precedes it (suffix order of the reversed text), each with an LCP array, which together
give the classes of equal strings at each distance before the anchor.

What is shuffled: anchors (about one in 35 bytes), texts twice (compressed), and the surroundings of those anchors
that occur more than once. Copies of whole texts are found by digest first and take no part. A bucket beyond `BUCKET`
occurrences is cut into chunks by place, so that neither a passage of many documents nor a text that repeats itself
fills a task; what is first in its chunk is then compared across chunks by a grouped minimum. Where an anchor's
surroundings are those of its occurrence before in the same piece of text, all strings around it go and it takes no
further part: a text of one repeated line leaves a few anchors, not one for each repetition.

Defined cases: null text counts as empty; documents in order of doc_id, a null one first, and rows that share an id in
the order of their texts' hashes; rows repeated whole are one document (each row gets its result); other columns are
ignored. Whole texts are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tendril.llm.shared import keyed, maybe_broadcast, passing, table, written

MATCH = 100
GRAM = 32
REACH = MATCH - GRAM  # of a string's bytes that may precede its anchor
BUCKET = 20_000
BLOCK = 1 << 20  # bytes that are hashed at a time
PIECE = 8 << 20  # of a document; a longer one is taken in overlapping pieces
ROWS = 30_000  # occurrences that are sorted at a time, whole buckets

_POSITION = np.uint64((1 << 24) - 1)
_BASE = 0x9E3779B97F4A7C15


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each GRAM-byte piece."""
    h, power, width = data.astype(np.uint64) + np.uint64(1), _BASE, 1
    while width < GRAM:
        h = h[:-width] * np.uint64(power) + h[width:]
        power, width = power * power % 2**64, width * 2
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def anchors_of(data: bytes, ends: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors of all MATCH-byte strings in texts laid end to end."""
    if len(data) < MATCH:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    h = _gram_hashes(np.frombuffer(data, np.uint8))
    least = (h & ~_POSITION) | np.arange(len(h), dtype=np.uint64)  # of equal hashes the leftmost counts
    windows, width = REACH + 1, 1
    while 2 * width <= windows:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[: len(data) - MATCH + 1], least[windows - width :])
    inside = np.ones(len(least), bool)
    start = 0
    for end in ends:
        inside[max(start, end - MATCH + 1) : end] = False
        start = end
    least = least[inside]
    at = (least[np.flatnonzero(np.diff(least, prepend=least[:1] ^ np.uint64(1)))] & _POSITION).astype(np.int64)
    return at, h[at]


def repeats_before(data: np.ndarray, of: np.ndarray, h: np.ndarray, at: np.ndarray, left: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Of anchors at `at` (ascending) in data, those whose surroundings are whole and equal those of the one before with
    the same hash in the same text. left and room: bytes of the text before and from the anchor on."""
    order = np.lexsort((h, of))
    a, b = order[:-1], order[1:]
    whole = (left >= REACH) & (room >= MATCH)
    near = np.flatnonzero((of[a] == of[b]) & (h[a] == h[b]) & whole[a] & whole[b])
    again = np.zeros(len(at), bool)
    window = np.arange(-REACH, MATCH)
    for k in range(0, len(near), 4096):
        x, y = a[near[k : k + 4096]], b[near[k : k + 4096]]
        again[y] = (data[at[x][:, None] + window] == data[at[y][:, None] + window]).all(axis=1)
    return again


def _anchors(batches: Iterator[pa.RecordBatch], piece: int = PIECE) -> Iterator[pa.RecordBatch]:
    """Rows (key, text) -> h, key, pos, each anchor once; and where surroundings repeat those before them, in place of
    the anchors, runs of bytes to remove: a null h, key, pos and stop."""
    last = None  # anchor; where a text is cut, it is often the next piece's first one as well

    def out(block: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        nonlocal last
        ends = np.cumsum([len(x[2]) for x in block])
        starts = np.append(0, ends[:-1])
        data = b"".join(x[2] for x in block)
        at, h = anchors_of(data, ends.tolist())
        of = np.searchsorted(ends, at, side="right")
        again = repeats_before(np.frombuffer(data, np.uint8), of, h, at, at - starts[of], ends[of] - at)
        key, pos = np.array([x[0] for x in block], np.int64)[of], at + (np.array([x[1] for x in block]) - starts)[of]
        new = ~again
        new[1:] &= (key[1:] != key[:-1]) | (pos[1:] != pos[:-1])
        if len(key):
            new[0] = last != (key[0], pos[0])
            last = (key[-1], pos[-1])
        gone = np.flatnonzero(again)
        first = np.append(True, (of[gone[1:]] != of[gone[:-1]]) | (at[gone[1:]] - REACH > at[gone[:-1]] + MATCH))[: len(gone)]
        end = gone[np.append(first[1:], True)[: len(gone)]]
        none = np.append(np.zeros(new.sum(), bool), np.ones(first.sum(), bool))
        columns = [np.append(h.view(np.int64)[new], np.zeros(len(end), np.int64)), np.append(key[new], key[end]), np.append(pos[new], pos[gone[first]] - REACH), np.append(np.zeros(new.sum(), np.int64), pos[end] + MATCH)]
        return pa.RecordBatch.from_arrays([pa.array(c, mask=m) for c, m in zip(columns, (none, None, None, ~none), strict=True)], ["h", "key", "pos", "stop"])

    block, size = [], 0
    for batch in batches:
        for key, text in zip(batch.column(0), batch.column(1), strict=True):
            key, text = key.as_py(), text.as_py()
            for start in range(0, max(1, len(text) - MATCH + 1), piece):
                block.append((key, start, text[start : start + piece + MATCH - 1] if len(text) > piece else text))
                size += len(block[-1][2])
                if size >= BLOCK:
                    yield out(block)
                    block, size = [], 0
    if block:
        yield out(block)


def _surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, packed text, at: structs of pos, h, chunk, chunks) -> h, chunk, chunks, key, pos, before, bytes."""
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    rows: list[tuple] = []

    def out() -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
        rows.clear()
        return pa.RecordBatch.from_arrays(columns, ["h", "chunk", "chunks", "key", "pos", "before", "bytes"])

    for batch in batches:
        unpack = zstandard.ZstdDecompressor()
        for k in range(batch.num_rows):
            text = unpack.decompress(batch.column(1)[k].as_py())
            key = batch.column(0)[k].as_py()
            at = batch.column(2)[k].values
            for start in range(0, len(at), 20_000):
                part = at.slice(start, 20_000)
                for pos, h, chunk, chunks in zip(*(part.field(n).to_pylist() for n in ("pos", "h", "chunk", "chunks")), strict=True):
                    low = max(0, pos - REACH)
                    rows.append((h, chunk, chunks, key, pos, pos - low, text[low : pos + MATCH]))
                if len(rows) >= 20_000:
                    yield out()
    if rows:
        yield out()


def _order_and_lcp(bucket: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows sorted by bucket and text, and how far each agrees with the one before it (-1 across buckets)."""
    wide = np.zeros((len(text), -(-text.shape[1] // 8) * 8), np.uint8)
    wide[:, : text.shape[1]] = text
    words = wide.view(">u8").astype(np.uint64)
    order = np.lexsort((*words.T[::-1], bucket))
    lcp = np.full(len(order), -1, np.int64)
    differ = text[order[1:]] != text[order[:-1]]
    lcp[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), text.shape[1])
    lcp[1:][bucket[order[1:]] != bucket[order[:-1]]] = -1
    return order, lcp


def earlier_match(run: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Whether LPF >= MATCH, for positions in suffix order. run numbers the stretches whose neighbours share MATCH bytes
    or more, in that order; place is a position's rank in the corpus. A position has an earlier match if in its run
    there is a smaller position before it (so a previous smaller one) or after it (a next smaller one)."""
    size = int(place.max(initial=0)) + 2
    falling, rising = place - run * size, place + run * size  # runs apart, so that running minima start anew with each
    before = np.append(size, np.minimum.accumulate(falling)[:-1])
    after = np.append(np.minimum.accumulate(rising[::-1])[::-1][1:], np.iinfo(np.int64).max)
    return (before < falling) | (after < rising)


def covered_windows(bucket: np.ndarray, key: np.ndarray, pos: np.ndarray, left: np.ndarray, n_left: np.ndarray, right: np.ndarray, n_right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each occurrence and distance before its anchor: whether the string there also starts earlier, and whether
    it is its class's first. left: bytes before the anchor, nearest first; right: from the anchor on.

    Strings that start `before` bytes before their anchors are in suffix order once they are sorted by those bytes and
    then by what follows from the anchor on. Neighbours share MATCH bytes if the anchors' surroundings agree that far to
    the left and MATCH - before bytes to the right, which the two LCP arrays tell for whole stretches."""
    size = len(bucket)
    again, whole_at = np.zeros((size, REACH + 1), bool), np.zeros((size, REACH + 1), bool)
    place = np.empty(size, np.int64)
    place[np.lexsort((pos, key))] = np.arange(size)
    order_r, lcp_r = _order_and_lcp(bucket, right)
    order_l, lcp_l = _order_and_lcp(bucket, left)
    most_r, most_l = np.empty(size, np.int64), np.empty(size, np.int64)
    most_r[order_r] = np.maximum(lcp_r, np.append(lcp_r[1:], -1))
    most_l[order_l] = np.maximum(lcp_l, np.append(lcp_l[1:], -1))
    run_r, run_l = np.empty(size, np.int64), np.empty(size, np.int64)
    for before in range(REACH + 1):
        after = MATCH - before
        whole = (n_left >= before) & (n_right >= after)
        whole_at[:, before] = whole
        rows = order_r[(whole & (most_l >= before) & (most_r >= after))[order_r]]
        if len(rows) < 2:
            continue
        run_r[order_r] = np.cumsum(lcp_r < after)
        run_l[order_l] = np.cumsum(lcp_l < before)
        rows = rows[np.argsort(run_l[rows], kind="stable")]  # suffix order of the strings that start here
        l, r = run_l[rows], run_r[rows]
        run = np.cumsum(np.append(0, (l[1:] != l[:-1]) | (r[1:] != r[:-1])))
        again[rows, before] = earlier_match(run, place[rows])
    return again, whole_at & ~again


def _bucket_matches(batches: Iterator[pa.RecordBatch], most: int = ROWS) -> Iterator[pa.RecordBatch]:
    """Rows of _surroundings sorted by (h, chunk) -> key, start, stop to remove; and of buckets in chunks, for each
    string that is first in its chunk, its digest instead (d1, d2)."""
    names = ["key", "start", "stop", "d1", "d2"]

    def batch_of(*columns: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names)

    def out(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(rows)
        h, chunk, chunks, key, pos, before = (t.column(k).to_numpy() for k in range(6))
        bucket = np.cumsum(np.append(0, (h[1:] != h[:-1]) | (chunk[1:] != chunk[:-1])))
        data = np.zeros((len(h), REACH + MATCH), np.uint8)
        lengths = np.empty(len(h), np.int64)
        for k, x in enumerate(t.column(6)):
            x = x.as_py()
            lengths[k] = len(x)
            data[k, REACH - before[k] : REACH - before[k] + len(x)] = np.frombuffer(x, np.uint8)
        again, first = covered_windows(bucket, key, pos, np.ascontiguousarray(data[:, REACH - 1 :: -1]), before, np.ascontiguousarray(data[:, REACH:]), lengths - before)
        hit = np.flatnonzero(again.any(axis=1))
        nearest, farthest = again[hit].argmax(axis=1), REACH - again[hit][:, ::-1].argmax(axis=1)
        none = np.zeros(len(hit), np.int64)
        # strings of one anchor overlap, so those that go make one run
        yield batch_of(key[hit], pos[hit] - farthest, pos[hit] - nearest + MATCH, none, none)
        cut = np.flatnonzero(chunks > 1)
        for at in range(0, len(cut), 2_000):
            row, back = np.nonzero(first[cut[at : at + 2_000]])
            row = cut[at : at + 2_000][row]
            digests = b"".join(hashlib.blake2b(data[k, REACH - n : REACH - n + MATCH].tobytes(), digest_size=16).digest() for k, n in zip(row, back, strict=True))
            d = np.frombuffer(digests, np.int64).reshape(-1, 2)
            yield batch_of(key[row], pos[row] - back, np.full(len(row), -1), d[:, 0], d[:, 1])

    held: list[pa.RecordBatch] = []
    count, last = 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        h, chunk = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        other = np.flatnonzero((h != h[-1]) | (chunk != chunk[-1]))
        start = int(other[-1]) + 1 if len(other) else 0  # of the batch's last bucket
        whole = start or last != (h[0], chunk[0])
        if count + start >= most and whole:
            yield from out([*held, batch.slice(0, start)])
            held, count = [batch.slice(start)], batch.num_rows - start
        else:
            held.append(batch)
            count += batch.num_rows
        last = (h[-1], chunk[-1])
    if count:
        yield from out(held)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The second column, a text, compressed; the others as they are."""
    for batch in batches:
        pack = zstandard.ZstdCompressor(level=3)
        yield batch.set_column(1, "text", pa.array([pack.compress(x.as_py()) for x in batch.column(1)], pa.binary()))


def duplicate_spans(texts: DataFrame, match_bucket: int = BUCKET) -> DataFrame:
    """texts (key, text) -> key, spans (arrays of start, stop, not merged) of the bytes to remove."""
    piece, most = PIECE, ROWS  # workers import this module, so what is set here is passed on
    anchors = texts.mapInArrow(lambda batches: _anchors(batches, piece), "h bigint, key bigint, pos bigint, stop bigint")
    # a table of its own, so that the join below has a plain shuffle on either side and a hot anchor can be split
    run = lambda name: F.when(F.col("h").isNull(), F.col(name)).alias(name)
    counted = written(anchors.groupBy("h", run("key"), run("pos"), "stop").count().where("count > 1 or h is null"), "repeated_anchors")
    inner = counted.where("h is null").select("key", F.col("pos").alias("start"), "stop")
    repeated = counted.where("h is not null").select("h", "count")
    chunks = F.ceil(F.col("count") / match_bucket).cast("int")
    met = anchors.join(repeated, "h").select("key", F.struct("pos", "h", F.pmod(F.hash("key", "pos"), chunks).alias("chunk"), chunks.alias("chunks")).alias("at"))
    by_text = met.groupBy("key").agg(F.collect_list("at").alias("at"))  # bounded by the text
    packed = texts.select("key", "text").mapInArrow(_packed, "key bigint, text binary")
    around = packed.join(by_text, "key").select("key", "text", "at").mapInArrow(_surroundings, "h bigint, chunk int, chunks int, key bigint, pos bigint, before int, bytes binary")
    around = around.repartition("h", "chunk").sortWithinPartitions("h", "chunk")
    found = written(around.mapInArrow(lambda batches: _bucket_matches(batches, most), "key bigint, start bigint, stop bigint, d1 bigint, d2 bigint"), "matches")
    own = found.where("stop >= 0").select("key", "start", "stop").union(inner)
    across = found.where("stop < 0").select("d1", "d2", F.struct("key", "start").alias("place"))
    first = across.groupBy("d1", "d2").agg(F.min("place").alias("first"), F.max("place").alias("last")).where("first < last").select("d1", "d2", "first")
    later = across.join(written(first, "first_strings"), ["d1", "d2"]).where("place > first").select("place.key", "place.start", (F.col("place.start") + MATCH).alias("stop"))
    return own.union(later).groupBy("key").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))  # bounded by the text


def merged(starts: list[int], stops: list[int]) -> list[tuple[int, int]]:
    """Maximal runs."""
    runs: list[list[int]] = []
    for a, b in sorted(zip(starts, stops, strict=True)):
        if runs and a <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], b)
        else:
            runs.append([a, b])
    return [(a, b) for a, b in runs]


def remove_repeats(docs: DataFrame, carry: tuple[str, ...] = (), match_bucket: int = BUCKET) -> tuple[DataFrame, DataFrame, DataFrame]:
    """docs (doc_id, text) -> what is left of each document (key, kept, n_removed, n_spans, and c0, c1 ... carried along),
    the keys of later copies of whole texts, of which nothing is left, and the rows (doc_id, digest, n_bytes, key)."""
    keyed_docs, rows, name, unique = keyed(docs)
    texts = keyed_docs.select(F.col(name).alias("key"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"), *[F.col(c).alias(f"c{k}") for k, c in enumerate(carry)])
    texts = texts if unique else texts.dropDuplicates(["key"])
    one = written(rows.groupBy("digest").agg(F.min("key").alias("first")), "first_copies")
    copies = written(rows.where(f"n_bytes >= {MATCH}").join(one, "digest").where("key > first").select("key").distinct(), "copies")
    firsts = texts.join(maybe_broadcast(copies), "key", "left_anti")
    with passing(docs.sparkSession):
        spans = written(duplicate_spans(firsts.select("key", "text"), match_bucket), "spans", keep=True)
    packed_schema = ", ".join(["key bigint", "text binary", *[f"{f.name} {f.dataType.simpleString()}" for f in texts.schema.fields[2:]]])
    names = [f"c{k}" for k in range(len(carry))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unpack, cut = zstandard.ZstdDecompressor(), []
            for text, of in zip(batch.column(1), batch.column(2), strict=True):
                text = unpack.decompress(text.as_py())
                runs = merged(of.values.field("start").to_pylist(), of.values.field("stop").to_pylist()) if of.is_valid else []
                edges = [0, *(x for r in runs for x in r), len(text)]
                cut.append((b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)), sum(b - a for a, b in runs), len(runs)))
            kept, removed, count = zip(*cut, strict=True) if cut else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.binary()), pa.array(removed, pa.int64()), pa.array(count, pa.int64()), *batch.columns[3:]], ["key", "kept", "n_removed", "n_spans", *names])

    joined = firsts.mapInArrow(_packed, packed_schema).join(spans, "key", "left").select("key", "text", "spans", *names)
    left = joined.mapInArrow(run, ", ".join(["key bigint", "kept binary", "n_removed bigint", "n_spans bigint", *packed_schema.split(", ")[2:]]))
    return left, copies, rows


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, copies, rows = remove_repeats(table(spark, sf_dir, "documents"))
    sums = left.select("key", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
    whole = copies.select(F.col("key").alias("copy"))
    found = rows.join(sums, "key", "left").join(whole, F.col("key") == F.col("copy"), "left")
    gone = F.col("copy").isNotNull()
    return found.select(
        "doc_id", "n_bytes", F.when(gone, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(gone, F.lit(1).cast("long")).otherwise(F.col("n_spans")).alias("n_spans"), F.when(gone, F.sha2(F.lit(b""), 256)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text, n_chars and others) with repeated strings cut out of the texts and n_chars counted anew;
    documents of which nothing is left go. Of a character cut in two, what is left of it goes too."""
    carry = tuple(c for c in docs.columns if c != "text")
    left, _, _ = remove_repeats(docs, carry)
    return _decoded(left).where("text <> ''").select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col("text") if c == "text" else F.col(f"c{carry.index(c)}").alias(c) for c in docs.columns])


def _decoded(left: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.set_column(1, "text", pa.array([x.as_py().decode("utf-8", "ignore") for x in batch.column(1)], pa.string()))

    schema = ", ".join(f"{'text' if f.name == 'kept' else f.name} {'string' if f.name == 'kept' else f.dataType.simpleString()}" for f in left.schema.fields)
    return left.mapInArrow(run, schema)
