"""Language identification by error-correcting output codes.

Each language has a codeword; one logistic classifier over hashed byte trigrams is trained per bit of the code. A
text's language is the one whose codeword has the least loss under the bits' margins, each bit weighted by how well
its classifier did on the training rows; a text whose two best codewords are close is flagged as ambiguous.

Fitting uses at most `SAMPLE_PER_LANG` training rows per language (those with the smallest hash of id and text, rows
repeated whole once), whole texts; their feature vectors are made on the executors and only those reach the driver.
Predicting is a narrow job.

Defined cases: null or empty text, or one without a letter, is `und` with score 0; any other text gets the language of
its nearest codeword, however far that is, and `ambiguous` tells where another is as near; rows with null lang teach
nothing; if nothing can be learned every text is `und`; repeated rows give one result each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tendril.llm.shared import crc_of_id, least_hashes, table, written

UNKNOWN = "und"
HELD_OUT_FOLDS = 5
SAMPLE_PER_LANG = 500
BUCKETS = 4096
STEPS = 150
AMBIGUOUS = 0.1  # least difference of the two best probabilities
PIECE = 1 << 22  # bytes of a text that are counted at a time

_TO_SPACE = bytes(32 if c < 128 and not chr(c).isalpha() else c for c in range(256))


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def features(text: str) -> np.ndarray:
    """Square roots of the shares of the text's hashed byte trigrams: a vector of length one."""
    data = np.frombuffer(b" " + text.lower().encode("utf-8", "replace").translate(_TO_SPACE) + b" ", np.uint8)
    counts = np.zeros(BUCKETS, np.int64)
    for at in range(0, len(data) - 2, PIECE):
        b = data[at : at + PIECE + 2].astype(np.uint32)
        codes = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
        codes = codes[(b[:-2] != 32) | (b[1:-1] != 32)]  # runs of spaces tell nothing
        counts += np.bincount((codes * np.uint32(2654435761)) >> np.uint32(20), minlength=BUCKETS)
    return np.sqrt(counts / max(1, counts.sum())).astype(np.float32)


def codewords(n: int) -> np.ndarray:
    """n codewords of +1 and -1: every split of the languages in two for up to four of them, else the best of some
    random codes by the least distance of two codewords."""
    if n <= 4:
        splits = range(1, 2 ** (n - 1)) if n > 1 else [0]
        return np.array([[1 if row == 0 else 1 - 2 * (s >> (row - 1) & 1) for s in splits] for row in range(n)])
    rng, width = np.random.default_rng(7), int(np.ceil(10 * np.log2(n)))
    best, found = -1, None
    for _ in range(200):
        code = rng.choice([-1, 1], (n, width))
        if (np.abs(code.sum(axis=0)) == n).any():
            continue
        apart = ((width - code @ code.T) // 2 + width * np.eye(n, dtype=int)).min()
        if apart > best:
            best, found = apart, code
    return found


@dataclass
class Codes:
    """The fitted model: languages, their codewords, and weights, biases and trust of each bit's classifier."""

    langs: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """Of each language, for rows of features."""
        margin = (x @ self.weights + self.bias)[:, None, :] * self.code[None]
        loss = np.logaddexp(0, -margin) @ self.trust
        p = np.exp(loss.min(axis=1, keepdims=True) - loss)
        return p / p.sum(axis=1, keepdims=True)


def train(x: np.ndarray, langs: list[str]) -> Codes | None:
    """Logistic regression per bit by accelerated gradient steps."""
    names = sorted(set(langs))
    if not names:
        return None
    code = codewords(len(names))
    row = np.searchsorted(names, langs)
    y = code[row].astype(np.float32)
    share = 1 / np.bincount(row)[row].astype(np.float32)[:, None] / len(names)  # each language counts alike
    w, last = np.zeros((x.shape[1], y.shape[1]), np.float32), 0
    bias = np.zeros(y.shape[1], np.float32)
    for step in range(STEPS):
        at = w + (step / (step + 3)) * (w - last) if step else w
        slope = -y * share / (1 + np.exp(np.clip(y * (x @ at + bias), -30, 30)))
        last, w = w, at - 12 * (x.T @ slope + 1e-5 * at)
        bias = bias - 2 * slope.sum(axis=0)
    right = ((x @ w + bias) * y > 0).mean(axis=0)
    trust = np.log(np.clip(right, 0.55, 0.999) / (1 - np.clip(right, 0.55, 0.999)))
    return Codes(names, code, w, bias, trust / trust.sum() * len(trust))


def fit(docs: DataFrame, per_lang: int = SAMPLE_PER_LANG) -> Codes | None:
    """docs (doc_id, text, lang), training rows only -> the model."""
    known = docs.where("lang is not null and text is not null").select("lang", "text", F.xxhash64("doc_id", "text").alias("h"))
    chosen = written(least_hashes(written(known.select("lang", "h"), "language_hashes"), per_lang, "lang"), "language_sample")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(lang.as_py(), features(t).tobytes()) for t, lang in ((t.as_py(), lang) for t, lang in zip(batch.column(0), batch.column(1), strict=True)) if has_letter(t)]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows], pa.string()), pa.array([x[1] for x in rows], pa.binary())], ["lang", "x"])

    # per_lang rows of each language, so they may be broadcast; rows repeated whole teach once
    own = known.join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("text")).select("text", "lang")
    rows = own.mapInArrow(run, "lang string, x binary").toArrow()
    x = np.frombuffer(b"".join(rows["x"].to_pylist()), np.float32).reshape(-1, BUCKETS)
    return train(x, rows["lang"].to_pylist())


def identify(docs: DataFrame, model: Codes | None, *keep: str | Column) -> DataFrame:
    """docs with text and the columns `keep` -> keep, lang_pred, score, ambiguous."""
    kept = docs.select(*keep, F.col("text").alias("__text"))
    names = kept.columns[:-1]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, score, close = [], [], []
            for at in range(0, batch.num_rows, 256):
                texts = [t if (t := x.as_py()) is not None and has_letter(t) else None for x in batch.column(len(names)).slice(at, 256)]
                p = iter(model.probabilities(np.stack([features(t) for t in texts if t is not None]))) if model and any(t is not None for t in texts) else iter(())
                for t in texts:
                    own = next(p) if t is not None and model else None
                    top = np.sort(own)[::-1] if own is not None else [0.0, 0.0]
                    lang.append(model.langs[int(own.argmax())] if own is not None else UNKNOWN)
                    score.append(float(top[0]))
                    close.append(own is None or len(top) > 1 and bool(top[0] - top[1] < AMBIGUOUS))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(close, pa.bool_())], [*names, "lang_pred", "score", "ambiguous"])

    return kept.mapInArrow(run, f"{schema}, lang_pred string, score double, ambiguous boolean")


def held_out() -> Column:
    return crc_of_id() % HELD_OUT_FOLDS == 0


def op7_language_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit(docs.where(~held_out())), "doc_id", held_out().alias("held_out"))


def with_known_language(docs: DataFrame) -> DataFrame:
    """docs without those whose language can't be told, as they have no letter; all columns stay."""
    fields = docs.schema.fields
    found = identify(docs, fit(docs.where(~held_out())), *[F.col(f.name).alias(f"c{k}") for k, f in enumerate(fields)])
    return found.where(F.col("lang_pred") != UNKNOWN).select(*[F.col(f"c{k}").alias(f.name) for k, f in enumerate(fields)])
