"""Language-model scores of texts by a weighted backoff automaton over smoothed n-grams.

Model: P(w) = (c(w) + 1) / (N + V + 1), and P(w | h) = (c(hw) + MU * P(w | h')) / (c(h) + MU), where h' is h without its
first word. That is a Dirichlet prior centred on the shorter history; it sums to one over the vocabulary and the
unknown word, and needs counts of n-grams only. As an automaton: a state for every history that training has, an arc
with log P(w | h) for every n-gram hw that it has, and a failure arc with log(MU / (c(h) + MU)) to the state of h'. A
text is read once from left to right: follow failure arcs until there is an arc, add its weight, go to its state.

The counts of a large corpus fit no task, so the automaton is never whole. Documents are put into blocks of half a million
tokens (longer texts are blocks of their own). Each block asks for the counts of the distinct n-grams that it holds, and
says how often its own training documents have them; n-grams are dealt by hash to buckets, where they are added up and
answered; so a frequent word or n-gram is one entry per block. With the answers a task builds the block's part of the
automaton and reads the block's documents. What is asked and answered grows with the corpus, and memory doesn't.

Words are known by 96 bits of their XXH3 hash, longer n-grams by 64 bits within their order, as n-gram toolkits do: at
10^12 different ones about 3 in 10^8 of them share a hash with another.

Defined cases: a null text is empty and has one token, its end; repeated rows are documents each; the id of a null
doc_id hashes as the empty text; without training documents every token has the probability 1 that the formula gives;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tendril.llm.shared import crc_of_id, passing, table, written

#: MU: of 4, 16, 64, 256 and 1024 the best on a sixth of training rows kept apart (held-out rows not looked at).
ORDER, MU = 2, 256.0
#: Tokens of a block, n-grams of a bucket, characters that are split into words at a time.
BLOCK, BUCKET, SLICE = 1 << 19, 1 << 20, 1 << 20
SPACE = re.compile(r"[\x20\x09-\x0D]")
END = b" "  # no word


class _Numbers(dict):
    """Words by the order in which they come; a new one gets the next number."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def token_ids(text: str, numbers: _Numbers) -> np.ndarray:
    """A text's words and its end, as numbers."""
    parts, at = [], 0
    while at < len(text):
        cut = SPACE.search(text, at + SLICE)
        end = cut.start() if cut else len(text)
        words = text[at:end].encode("utf-8", "surrogatepass").lower().split()  # ASCII only, both
        parts.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
        at = end
    return np.concatenate([*parts, np.array([numbers[END]], np.int32)])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Grams:
    """The distinct n-grams of a block, by order: `of[k]` has the n-gram that ends at each token (-1: none), `prefix`,
    `suffix` and `word` its parts, `key` its hash."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, keys: np.ndarray, order: int):
        words = len(keys)
        starts = np.cumsum(sizes) - sizes
        self.of, self.key = [ids.astype(np.int64)], [keys.view(np.uint64)]
        self.prefix, self.suffix, self.word = [np.zeros(words, np.int64)], [np.zeros(words, np.int64)], [np.arange(words)]
        for _ in range(1, order):
            before = np.empty(len(ids), np.int64)
            before[1:] = self.of[-1][:-1]
            before[starts] = -1
            there = before >= 0
            found, at = np.unique(before[there] * words + ids[there], return_inverse=True)
            of = np.full(len(ids), -1)
            of[there] = at
            suffix = np.zeros(len(found), np.int64)
            suffix[at] = self.of[-1][there]
            self.of.append(of)
            self.prefix.append(found // words)
            self.word.append(found % words)
            self.suffix.append(suffix)
            self.key.append(_mixed(self.key[-1][found // words] * np.uint64(0x9E3779B97F4A7C15) + self.key[0][found % words]))

    def dealt(self, k: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """N-grams of order k + 1 in order of their buckets; the buckets that have any, and where each begins."""
        bucket = (self.key[k] >> np.uint64(20)) % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        there, starts = np.unique(bucket[order], return_index=True)
        return order, there.astype(np.int64), starts


def packed(x: np.ndarray) -> bytes:
    """Whole numbers as bytes, the lowest of each first, compressed: most are small."""
    return zstandard.compress(x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes(), 1)


def unpacked(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(zstandard.decompress(data), np.uint8).reshape(size, -1).T.copy().view(kind).ravel()


def blocks(docs: DataFrame, held_out: Column, block: int = BLOCK) -> DataFrame:
    """docs (doc_id, text) -> rows of many documents each: block, n_tokens, doc_ids, held, sizes (in tokens), ids (packed
    numbers of words), keys and checks (the hashes of the words by number)."""
    kept = docs.select("doc_id", "text", held_out.alias("held"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nth, numbers, held, tokens, kind = TaskContext.get().partitionId() << 33, _Numbers(), [], 0, None

        def put() -> pa.RecordBatch:
            digests = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, numbers)), np.int64).reshape(-1, 2)
            lists = [pa.array([[d for d, _, _ in held]], pa.list_(kind)), pa.array([[h for _, h, _ in held]]), pa.array([[len(x) for *_, x in held]], pa.list_(pa.int32()))]
            data = [packed(np.concatenate([x for *_, x in held])), digests[:, 0].tobytes(), digests[:, 1].astype(np.int32).tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([nth]), pa.array([tokens]), *lists, *(pa.array([x], pa.binary()) for x in data)], ["block", "n_tokens", "doc_ids", "held", "sizes", "ids", "keys", "checks"])

        for batch in batches:
            kind = batch.schema.field(0).type
            for doc, text, out in zip(*batch.columns, strict=True):
                ids = token_ids(text.as_py() or "", numbers)
                held.append((doc.as_py(), out.as_py(), ids))
                tokens += len(ids)
                if tokens >= block:
                    yield put()
                    nth, numbers, held, tokens = nth + 1, _Numbers(), [], 0
        if held:
            yield put()

    kind = kept.schema["doc_id"].dataType.simpleString()
    return kept.mapInArrow(run, f"block bigint, n_tokens bigint, doc_ids array<{kind}>, held array<boolean>, sizes array<int>, ids binary, keys binary, checks binary")


def _block(row: dict, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, Grams]:
    """Held-out marks, sizes, words and n-grams of a block."""
    out, sizes, ids = np.array(row["held"], bool), np.array(row["sizes"]), unpacked(row["ids"], np.int32)
    return out, sizes, ids, Grams(ids, sizes, np.frombuffer(row["keys"], np.int64), order)


def requests(held: DataFrame, order: int, buckets: int) -> DataFrame:
    """A row for each block, order and bucket: the n-grams' hashes and their counts in the block's training documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for nth in range(batch.num_rows):
                row = batch.slice(nth, 1).to_pylist()[0]
                out, sizes, _, grams = _block(row, order)
                checks = np.frombuffer(row["checks"], np.int32)
                training = np.repeat(~out, sizes)
                for k in range(order):
                    counts = np.bincount(grams.of[k][training & (grams.of[k] >= 0)], minlength=len(grams.key[k]))
                    at, there, starts = grams.dealt(k, buckets)
                    parts = [at[a:b] for a, b in zip(starts, [*starts[1:], len(at)], strict=True)]
                    columns = [pa.array([row["block"]] * len(parts)), pa.array([k] * len(parts), pa.int32()), pa.array(there)]
                    data = [[grams.key[k][x].tobytes() for x in parts], [checks[x].tobytes() if k == 0 else b"" for x in parts], [packed(counts[x]) for x in parts]]
                    yield pa.RecordBatch.from_arrays([*columns, *(pa.array(x, pa.binary()) for x in data)], ["block", "k", "bucket", "keys", "checks", "counts"])

    return held.mapInArrow(run, "block bigint, k int, bucket bigint, keys binary, checks binary, counts binary")


def answers(asked: DataFrame) -> DataFrame:
    """Each request with the counts over all blocks; a row of k = -1 per bucket has its tokens and distinct words."""

    def add_up(k: int, rows: list[tuple]) -> tuple[list[np.ndarray], int, int]:
        keys = np.concatenate([r[1] for r in rows])
        checks = np.concatenate([r[2] for r in rows]) if k == 0 else np.zeros(len(keys), np.int32)
        order = np.lexsort((checks, keys)) if k == 0 else np.argsort(keys)
        a, b = keys[order], checks[order]
        new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
        total = np.add.reduceat(np.concatenate([r[3] for r in rows])[order], np.flatnonzero(new))
        of = np.empty(len(order), np.int64)
        of[order] = np.cumsum(new) - 1
        return np.split(total[of], np.cumsum([len(r[1]) for r in rows])[:-1]), int(total.sum()), int((total > 0).sum())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []

        def put() -> pa.RecordBatch:
            bucket, k = now
            counts, tokens, types = add_up(k, rows)
            found = [(r[0], k, bucket, packed(x), None, None) for r, x in zip(rows, counts, strict=True)] + [(None, -1, bucket, None, tokens, types)] * (k == 0)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*found, strict=True), kinds, strict=True)], ["block", "k", "bucket", "counts", "tokens", "types"])

        for batch in batches:
            for block, k, bucket, keys, checks, counts in zip(*(batch.column(x).to_pylist() for x in ("block", "k", "bucket", "keys", "checks", "counts")), strict=True):
                if (bucket, k) != now and rows:
                    yield put()
                    rows = []
                now = (bucket, k)
                rows.append((block, np.frombuffer(keys, np.uint64), np.frombuffer(checks, np.int32), unpacked(counts, np.int64)))
        if rows:
            yield put()

    return asked.repartition("bucket").sortWithinPartitions("bucket", "k").mapInArrow(run, "block bigint, k int, bucket bigint, counts binary, tokens bigint, types bigint")


class Automaton:
    """The part of the model's automaton that a block's texts can reach.

    A state is a history of training, from none to one word less than the order; the arc that leaves it with a word is
    the n-gram of both, if training has that, and leads to the longest history that it ends with. Arcs and failure arcs
    have weights by n-gram; they are laid out along the block's tokens before these are read."""

    def __init__(self, grams: Grams, counts: list[np.ndarray], tokens: int, types: int, mu: float):
        chance = [(counts[0] + 1) / (tokens + types + 1)]
        for k in range(1, len(counts)):
            chance.append((counts[k] + mu * chance[k - 1][grams.suffix[k]]) / (counts[k - 1][grams.prefix[k]] + mu))
        self.base = np.log10(chance[0])
        arcs = [self.base, *(np.where(n > 0, np.log10(p), np.nan) for n, p in zip(counts[1:], chance[1:], strict=True))]
        fails = [np.log10(mu / (n + mu)) for n in counts[:-1]]
        along = lambda of, x: np.where(of >= 0, np.append(x, np.nan)[of], np.nan)  # noqa: E731  no n-gram, no arc
        self.arcs = [along(of, x).tolist() for of, x in zip(grams.of, arcs, strict=True)]
        self.fails = [along(of, x).tolist() for of, x in zip(grams.of, fails, strict=False)]
        self.known = (counts[0] > 0)[grams.of[0]].tolist()

    def score(self, start: int, end: int) -> float:
        """One pass over a text, the tokens from start to end: the sum of its arcs' and failure arcs' weights. The state
        is the last `words` tokens."""
        arcs, fails, known, most = self.arcs, self.fails, self.known, len(self.arcs) - 1
        words, total = 0, 0.0
        for at in range(start, end):
            weight = arcs[words][at]
            while weight != weight:  # no arc
                words -= 1
                total += fails[words][at - 1]
                weight = arcs[words][at]
            total += weight
            if not known[at]:
                words = 0
            elif words < most:
                words += 1
        return total


def scores(docs: DataFrame, held_out: Column, order: int = ORDER, mu: float = MU, block: int = BLOCK, bucket: int = BUCKET) -> DataFrame:
    """docs (doc_id, text) -> doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    with passing(docs.sparkSession):
        held = written(blocks(docs, held_out, block), "blocks")
        buckets = max(1, -(-(held.agg(F.sum("n_tokens")).first()[0] or 0) * order // bucket))
        found = written(answers(requests(held.drop("doc_ids", "n_tokens"), order, buckets)), "counts")
        tokens, types = (x or 0 for x in found.where("k = -1").agg(F.sum("tokens"), F.sum("types")).first())

        def scored(row: dict, got: list[tuple[int, bytes]]) -> pa.RecordBatch:
            out, sizes, ids, grams = _block(row, order)
            counts = []
            for k in range(order):
                at, _, _ = grams.dealt(k, buckets)
                counts.append(np.zeros(len(at), np.int64))
                counts[k][at] = np.concatenate([np.zeros(0, np.int64), *(unpacked(x, np.int64) for n, x in got if n == k)])
            model = Automaton(grams, counts, tokens, types, mu)
            ends = np.cumsum(sizes)
            starts = ends - sizes
            total = [model.score(a, b) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            known, base = np.add.reduceat((counts[0] > 0)[ids].astype(np.int64), starts), np.add.reduceat(model.base[ids], starts)
            columns = [out, sizes.astype(np.int64), known, np.full(len(sizes), tokens), base, np.array(total)]
            return pa.RecordBatch.from_arrays([row["doc_ids"], *map(pa.array, columns)], ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, got = None, []
            for batch in batches:
                for nth in range(batch.num_rows):
                    if batch.column("k")[nth].as_py() >= 0:
                        got.append((batch.column("k")[nth].as_py(), batch.column("counts")[nth].as_py()))
                        continue
                    if now:
                        yield scored(now, got)
                    now, got = {x: batch.column(x)[nth].as_py() for x in ("held", "sizes", "ids", "keys")} | {"doc_ids": batch.column("doc_ids")[nth].values}, []
            if now:
                yield scored(now, got)

        own = held.select("block", F.lit(-1).alias("k"), F.lit(-1).cast("bigint").alias("bucket"), "doc_ids", "held", "sizes", "ids", "keys")
        rows = own.unionByName(found.where("k >= 0").select("block", "k", "bucket", "counts"), allowMissingColumns=True)
        met = rows.repartition("block").sortWithinPartitions("block", "k", "bucket")  # a block, then what it has been told
        return written(met.mapInArrow(run, f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"), "scores", keep=True)


def op11_backoff_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(table(spark, sf_dir, "documents"), crc_of_id() % 7 == 2)
