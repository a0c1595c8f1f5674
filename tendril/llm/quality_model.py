"""Quality classifier: random-indexing word vectors pooled per document, then a two-layer network.

A word's vector is the sum, over its occurrences in the training sample, of its neighbours' sparse random index
vectors (four of +1 and -1 among `DIM`, drawn from the neighbour's hash). Words outside the vocabulary share a vector
by shape (letters' case, length, kind of characters). A document is pooled from the vectors of its words in order: their
mean, their spread, and the mean product of neighbours, each dimension by itself, and the lengths of these three;
nothing else is an input. The network has one hidden layer, and its logits are divided by a temperature fitted on rows kept apart from its training, so
scores are probabilities.

Fitting uses at most `SAMPLE` labelled ids (those with the smallest hash), one whole text of each, and a vocabulary of
at most `VOCABULARY` words; texts stay on the executors, which send at most eight tables of sums and `SAMPLE` document
vectors. Scoring is a narrow job over every row.

Defined cases: null text counts as empty and is scored like any other; labels that are null or contradict each other
for an id teach nothing; of several texts of an id the one with the smallest hash teaches; without any label every
score is 0.5; repeated rows give one result each; other columns are ignored. Whole texts are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tendril.llm.shared import crc_of_id, least_hashes, table, written

HELD_OUT_FOLDS, HELD_OUT = 4, 2
SAMPLE = 6000
VOCABULARY = 8192
DIM = 64
WINDOW = 2
HIDDEN = 24
EPOCHS = 40
THRESHOLD = 0.7
PIECE = 1 << 20  # characters of a text whose words are held at a time
CHUNK = 4096  # words whose vectors are held at a time

TOKEN = re.compile(r"\w+|[^\w\s]+")
POOLED = 3  # vectors that a document is pooled to


def tokens_of(text: str) -> Iterator[list[str]]:
    """The text's words and runs of signs, a bounded piece at a time; pieces end at white space where there is some."""
    at = 0
    while at < len(text):
        end = at + PIECE
        if end < len(text):
            end = max(text.rfind(" ", at, end), text.rfind("\n", at, end)) + 1 or end
            end = end if end > at else at + PIECE
        yield TOKEN.findall(text[at:end])
        at = end


def shape(word: str) -> str:
    """The class of a word outside the vocabulary."""
    if word.isalpha():
        kind = "X" if word.isupper() and len(word) > 1 else "x" if word.islower() else "Xx"
    else:
        kind = "9" if word.isdigit() else "x9" if word[0].isalnum() or word[0] == "_" else word[0]
    return f"\0{kind}{min(len(word), 12) // 3}"


def index_vector(word: str) -> np.ndarray:
    """Sparse, random, the same on every machine."""
    rng = np.random.default_rng(zlib.crc32(word.encode("utf-8", "replace")))
    v = np.zeros(DIM, np.float32)
    v[rng.choice(DIM, 4, replace=False)] = rng.choice([-1, 1], 4)
    return v


class Words:
    """Row numbers of words: the vocabulary's, then those of shapes."""

    def __init__(self, vocabulary: list[str]):
        self.names = vocabulary
        self.row = {w: k for k, w in enumerate(vocabulary)}
        self.other = len(vocabulary)  # shapes that the sample doesn't have

    def rows(self, words: list[str]) -> list[int]:
        get = self.row.get
        return [k if (k := get(w)) is not None else get(shape(w), self.other) for w in words]


def context_sums(texts: Iterator[str], words: Words) -> np.ndarray:
    """For each row the sum of the neighbours' index vectors."""
    index = np.stack([*map(index_vector, words.names), np.zeros(DIM, np.float32)])
    out = np.zeros((len(index), DIM), np.float32)
    for text in texts:
        for piece in tokens_of(text):
            at = np.array(words.rows(piece), np.int64)
            for step in range(1, WINDOW + 1):
                if len(at) > step:
                    np.add.at(out, at[step:], index[at[:-step]])
                    np.add.at(out, at[:-step], index[at[step:]])
    return out


def document_vector(text: str, words: Words, vectors: np.ndarray) -> np.ndarray:
    """By dimension: the mean of the words' vectors, their standard deviation, and the mean product of neighbours; then
    the length of each of the three, which tells how alike the words are whatever their direction."""
    total, squares, products = np.zeros((3, vectors.shape[1]))
    n, before = 0, vectors[:0]
    for piece in tokens_of(text):
        rows = np.array(words.rows(piece), np.int64)
        for at in range(0, len(rows), CHUNK):
            v = vectors[rows[at : at + CHUNK]]
            follow = np.concatenate([before, v])
            total += v.sum(axis=0)
            squares += np.einsum("ij,ij->j", v, v)
            products += np.einsum("ij,ij->j", follow[1:], follow[:-1])
            n, before = n + len(v), v[-1:]
    if not n:
        return np.zeros(POOLED * (vectors.shape[1] + 1), np.float32)
    pooled = total / n, np.sqrt(np.maximum(squares / n - (total / n) ** 2, 0)), products / max(1, n - 1)
    return np.concatenate([*pooled, [np.linalg.norm(p) for p in pooled]]).astype(np.float32)


@dataclass
class Network:
    """Two layers over standardized inputs, and the temperature of the logits."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def train(x: np.ndarray, y: np.ndarray) -> Network:
    """Minibatch Adam on four fifths of the rows; the temperature is fitted on the rest."""
    rng = np.random.default_rng(5)
    apart = np.arange(len(y)) % 5 == 4
    tx, ty = (x[~apart], y[~apart]) if len(y) >= 20 else (x, y)
    net = Network(tx.mean(axis=0), tx.std(axis=0) + 1e-3, rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), 0.0)
    tx = (tx - net.mean) / net.scale
    params = [net.w1, net.b1, net.w2, np.zeros(1)]
    m, v, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(ty))
        for at in range(0, len(order), 64):
            i, step = order[at : at + 64], step + 1
            h = np.tanh(tx[i] @ params[0] + params[1])
            p = 1 / (1 + np.exp(-np.clip(h @ params[2] + params[3][0], -40, 40)))
            d = (p - ty[i]) / len(i)
            back = np.outer(d, params[2]) * (1 - h * h)
            slopes = [tx[i].T @ back + 1e-3 * params[0], back.sum(axis=0), h.T @ d + 1e-3 * params[2], np.array([d.sum()])]
            for k, g in enumerate(slopes):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                params[k] -= 0.004 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = params[0], params[1], params[2], float(params[3][0])
    if len(y) >= 20:
        z, zy = net.logits(x[apart]), y[apart]
        heats = np.exp(np.linspace(np.log(0.25), np.log(8), 200))
        net.temperature = float(heats[np.argmin([np.logaddexp(0, -(2 * zy - 1) * z / t).mean() for t in heats])])
    return net


@dataclass
class Model:
    words: Words
    vectors: np.ndarray
    network: Network

    def scores(self, texts: list[str]) -> np.ndarray:
        return self.network.scores(np.stack([document_vector(t, self.words, self.vectors) for t in texts]))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """docs (doc_id, text), labels (doc_id, quality 0 or 1), training rows only -> the model."""
    sure = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("y"), F.max("quality").alias("z")).where("y = z")
    ranked = written(sure.select(F.col("doc_id").alias("id"), F.col("y").cast("int").alias("y"), F.xxhash64("doc_id").alias("h")), "labels")
    chosen = least_hashes(ranked, sample).select("id", "y")
    own = docs.join(F.broadcast(written(chosen, "label_sample")), F.col("doc_id") == F.col("id"))  # `sample` rows at most
    text = F.coalesce("text", F.lit(""))
    texts = written(own.groupBy("id", "y").agg(F.min_by(text, F.xxhash64(text)).alias("text")), "labelled_texts")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for batch in batches:
            for x in batch.column(0):
                for piece in tokens_of(x.as_py()):
                    total.update(piece)
                    total.update(map(shape, piece))
        yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])

    counted = texts.select("text").mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    words = Words([r.word for r in counted.orderBy(F.desc("n"), "word").limit(VOCABULARY).collect()])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = context_sums((x.as_py() for batch in batches for x in batch.column(0)), words)
        yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], ["sums"])

    parts = texts.select("text").coalesce(8).mapInArrow(sums, "sums binary").toArrow()["sums"].to_pylist()  # eight tables at most
    vectors = sum((np.frombuffer(x, np.float32).reshape(-1, DIM) for x in parts), np.zeros((len(words.names) + 1, DIM), np.float32))
    vectors = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-6)

    def pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [document_vector(t.as_py(), words, vectors).tobytes() for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(x, pa.binary())], ["id", "y", "x"])

    rows = texts.select("id", "y", "text").mapInArrow(pooled, f"id {texts.schema['id'].dataType.simpleString()}, y int, x binary").toArrow()
    if not rows.num_rows:
        return None
    rows = rows.sort_by("id")
    x = np.frombuffer(b"".join(rows["x"].to_pylist()), np.float32).reshape(rows.num_rows, -1)
    mixed = np.random.default_rng(11).permutation(rows.num_rows)
    return Model(words, vectors, train(x[mixed], rows["y"].to_numpy().astype(np.float64)[mixed]))


def score_quality(docs: DataFrame, model: Model | None) -> DataFrame:
    """docs (doc_id, text) -> doc_id, score."""
    kept = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for at in range(0, batch.num_rows, 128):
                texts = [x.as_py() or "" for x in batch.column(1).slice(at, 128)]
                out.extend(model.scores(texts).tolist() if model else [0.5] * len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], ["doc_id", "score"])

    return kept.mapInArrow(run, f"doc_id {kept.schema['doc_id'].dataType.simpleString()}, score double")


def op4_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    apart = crc_of_id() % HELD_OUT_FOLDS == HELD_OUT
    model = fit(docs.where(~apart), table(spark, sf_dir, "labels").where(~apart))
    return score_quality(docs, model).select("doc_id", apart.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
