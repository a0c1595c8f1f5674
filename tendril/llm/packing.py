"""Packing token sequences by Karmarkar-Karp multiway differencing.

A document is its token ids and a closing id. What fills whole windows is cut off first; the rest, in parts of at most
`PART` tokens, is dealt to windows by multiway differencing: the two partial partitions with the widest spread are
merged so that the fullest windows of one meet the emptiest of the other, until one is left, whose windows are nearly
equal. If any of them exceeds the capacity, the window count rises by one and the parts are dealt again.

A narrow job: each task packs its own documents, `BATCH` windows at a time, so memory doesn't depend on the input, and
a task that is run again gives the same sequences. Sequence ids are the task's number (upper bits) and a count.

Ids are those of the vocabulary file under `tokenizers`; as that library encodes a plain byte-level file slowly, such
a file is encoded by tiktoken with the same merges and pattern (a test holds the two against each other), but for
pieces with a run of 50,000 white-space characters or more, on which tiktoken overflows its stack.

Defined cases: null text counts as empty and is one token, the closing id; special tokens' strings in a text are
ordinary text; repeated rows are packed each; doc_id passes through, nulls included; other columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from tendril.llm.shared import small_batches, table

CAPACITY = 1024
CLOSING = 0
PART = 512
BATCH = 256
PIECE = 1 << 20  # characters that are encoded at a time

# The pattern of byte-level BPE.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Tokens of that pattern have white space only in front, so one always begins at a space that follows something else:
#: texts may be cut there without changing their ids.
CUT = re.compile(r"(?<=\S)(?= )")
#: tiktoken's pattern engine recurses over a run of white space; longer runs than this go to `tokenizers`.
LONG_RUN = re.compile(r"\s{50000}")


class Encoder:
    """Token ids of texts under a `tokenizers` file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.path, self.fast = path, None
        ranks = self._byte_level_ranks(spec)
        if ranks:
            import tiktoken

            self.fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def slow(self):
        from tokenizers import Tokenizer

        out = Tokenizer.from_file(self.path)
        out.encode_special_tokens = True
        return out

    @staticmethod
    def _byte_level_ranks(spec: dict) -> dict[bytes, int] | None:
        """Ranks by bytes if the file is plain byte-level BPE whose merges come in the order of their ids."""
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        if spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or model.get("type") != "BPE":
            return None
        if any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
            return None
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(x for x in range(256) if x not in printable)}
        special = {x["content"] for x in spec.get("added_tokens", [])}
        vocabulary = {bytes(byte[c] for c in token): k for token, k in model["vocab"].items() if token not in special}
        merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        return vocabulary if merged == sorted(merged) and len(vocabulary) == len(merged) + 256 else None

    def ids(self, text: str) -> np.ndarray:
        parts, at = array("I"), 0
        while at < len(text):
            cut = CUT.search(text, at + PIECE) if len(text) - at > PIECE else None
            end = cut.start() if cut else len(text)
            piece = text[at:end] if at or cut else text
            fast = self.fast and not LONG_RUN.search(piece)
            parts.extend(self.fast.encode_ordinary(piece) if fast else self.slow.encode(piece, add_special_tokens=False).ids)
            at = end
        parts.append(CLOSING)
        return np.asarray(parts).astype("<u4", copy=False)


def difference(sizes: np.ndarray, windows: int) -> np.ndarray:
    """Karmarkar-Karp: the window of each item, the windows' sums nearly equal."""
    # a node is an item, or two nodes joined; a partial partition has the sums of its windows that hold anything, in
    # falling order and less what all windows have in common, beside their nodes
    left, right = [-1] * len(sizes), [-1] * len(sizes)
    heap = [(-int(size), k, np.array([size]), np.array([k])) for k, size in enumerate(sizes)]
    heapq.heapify(heap)
    count = len(sizes)
    while len(heap) > 1:
        _, _, a, na = heapq.heappop(heap)
        _, _, b, nb = heapq.heappop(heap)
        over = len(a) + len(b) - windows
        if over > 0:  # the emptiest `over` windows of a meet those of b, in opposite order
            joined = np.arange(len(left), len(left) + over)
            left.extend(na[len(a) - over :].tolist())
            right.extend(nb[::-1][:over].tolist())
            sums = np.concatenate([a[: len(a) - over], a[len(a) - over :] + b[::-1][:over], b[: len(b) - over]])
            nodes = np.concatenate([na[: len(a) - over], joined, nb[: len(b) - over]])
        else:
            sums, nodes = np.concatenate([a, b]), np.concatenate([na, nb])
        order = np.argsort(-sums, kind="stable")
        sums, nodes = sums[order], nodes[order]
        low = 0
        if len(sums) == windows:
            low = int(sums[-1])
            sums = sums - low
        heapq.heappush(heap, (-int(sums[0]), count, sums, nodes))
        count += 1
    out = np.zeros(len(sizes), np.int64)
    for window, node in enumerate(heap[0][3].tolist()):
        stack = [node]
        while stack:
            x = stack.pop()
            if left[x] < 0:
                out[x] = window
            else:
                stack += (left[x], right[x])
    return out


def deal(sizes: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """The window of each part; none holds more than the capacity."""
    windows = -(-int(sizes.sum()) // capacity)
    while True:
        of = difference(sizes, windows)
        if np.bincount(of, sizes, windows).max() <= capacity:
            return of
        windows += 1


class Packer:
    """Packs one task's documents."""

    def __init__(self, first_id: int, with_ids: bool):
        self.next_id, self.with_ids = first_id, with_ids
        self.rows: list[tuple] = []
        self.waiting: list[tuple] = []
        self.tokens = 0

    def add(self, doc, ids: np.ndarray) -> None:
        n = len(ids)
        whole = n - n % CAPACITY
        for start in range(0, whole, CAPACITY):
            self._put(doc, start, ids[start : start + CAPACITY], n, self.next_id, 0)
            self.next_id += 1
        for start in range(whole, n, PART):
            part = ids[start : min(n, start + PART)]
            self.waiting.append((doc, start, part, n))
            self.tokens += len(part)
        if self.tokens >= BATCH * CAPACITY:
            self.flush()

    def _put(self, doc, start: int, ids: np.ndarray, n: int, sequence: int, offset: int) -> None:
        data = ids.tobytes()
        self.rows.append((doc, start, len(ids), zlib.crc32(data), n, sequence, offset, *([ids.tolist()] if self.with_ids else [])))

    def flush(self) -> None:
        if not self.waiting:
            return
        of = deal(np.array([len(x[2]) for x in self.waiting]))
        filled = np.zeros(int(of.max()) + 1, np.int64)
        for k in np.argsort(of, kind="stable").tolist():
            doc, start, ids, n = self.waiting[k]
            self._put(doc, start, ids, n, self.next_id + int(of[k]), int(filled[of[k]]))
            filled[of[k]] += len(ids)
        self.next_id += len(filled)
        self.waiting, self.tokens = [], 0

    def take(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


def pack(docs: DataFrame, tokenizer_path: str, with_ids: bool = True) -> DataFrame:
    """docs (doc_id, text) -> a row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and,
    if asked for, the ids themselves."""
    small_batches(docs.sparkSession)
    kept = docs.select("doc_id", "text")
    id_type = pa.int64() if kept.schema["doc_id"].dataType.simpleString() == "bigint" else None
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *["ids"] * with_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer_path)
        packer, kind = Packer(TaskContext.get().partitionId() << 40, with_ids), id_type

        def out() -> pa.RecordBatch:
            columns = list(zip(*packer.take(), strict=True)) or [[]] * len(names)
            types = [kind, *[pa.int64()] * 6, *[pa.list_(pa.int64())] * with_ids]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        for batch in batches:
            kind = batch.schema.field(0).type
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                packer.add(doc.as_py(), encoder.ids(text.as_py() or ""))
                if len(packer.rows) >= (1_000 if with_ids else 20_000):
                    yield out()
        packer.flush()
        if packer.rows:
            yield out()

    schema = f"doc_id {kept.schema['doc_id'].dataType.simpleString()}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    return kept.mapInArrow(run, schema + ", ids array<bigint>" * with_ids)


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), default_tokenizer(), with_ids=False)
