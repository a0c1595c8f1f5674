import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tendril.llm import language_model as L
from tendril.llm.shared import crc_of_id


def tokens(text):
    lower = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
    return (*re.findall(r"[^\x20\x09-\x0D]+", lower), " ")


def is_held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


class Brute:
    """The model by its definition, over counts of all n-grams."""

    def __init__(self, texts, order, mu):
        self.c, self.order, self.mu = Counter(), order, mu
        for t in texts:
            for n in range(order):
                self.c.update(t[i - n : i + 1] for i in range(n, len(t)))
        self.tokens = sum(v for k, v in self.c.items() if len(k) == 1)
        self.types = sum(len(k) == 1 for k in self.c)

    def p(self, h, w):
        if not h:
            return (self.c[(w,)] + 1) / (self.tokens + self.types + 1)
        return (self.c[h + (w,)] + self.mu * self.p(h[1:], w)) / (self.c[h] + self.mu)

    def row(self, t):
        score = sum(math.log10(self.p(t[max(0, i - self.order + 1) : i], t[i])) for i in range(len(t)))
        return len(t), sum(self.c[(w,)] > 0 for w in t), self.tokens, sum(math.log10(self.p((), w)) for w in t), score


def compare(df, order, mu, **sizes):
    rows = df.select("doc_id", "text").collect()
    brute = Brute([tokens(r.text) for r in rows if not is_held(r.doc_id)], order, mu)
    known = {r.text: brute.row(tokens(r.text)) for r in rows}
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[5])
    expected = sorted(((r.doc_id, is_held(r.doc_id), *known[r.text]) for r in rows), key=lambda r: key((r[0], r[2], 0, 0, 0, round(r[6], 3))))
    got = sorted((tuple(r) for r in L.scores(df, crc_of_id() % 7 == 2, order, mu, **sizes).collect()), key=lambda r: key((r[0], r[2], 0, 0, 0, round(r[6], 3))))
    assert [g[:5] for g in got] == [e[:5] for e in expected]
    assert np.allclose([g[5:] for g in got], [e[5:] for e in expected], rtol=1e-10, atol=1e-9)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_brute_force_on_odd_rows(odd_docs, order):
    compare(odd_docs, order, 3.0, block=500, bucket=700)


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    brute = Brute([tokens(r.text) for r in docs.collect() if not is_held(r.doc_id)], L.ORDER, L.MU)
    got = {r.doc_id: r for r in L.op11_backoff_automaton(spark, "/root/testdata/sf0.001").collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    for r in rows:
        n, known, train, base, score = brute.row(tokens(r.text))
        g = got[r.doc_id]
        assert (g.held_out, g.n_tokens, g.n_known, g.train_tokens) == (is_held(r.doc_id), n, known, train)
        assert abs(g.base_score - base) < 1e-6 and abs(g.score - score) < 1e-6


def test_one_word_that_is_a_third_of_all_tokens(spark):
    text = F.concat(F.lit("hot hot "), F.col("id").cast("string"), F.lit(" hot again "), (F.col("id") % 7).cast("string"))
    compare(spark.range(400).select(F.col("id").alias("doc_id"), text.alias("text")), 3, 2.0, block=300, bucket=500)


def test_no_rows_no_training_rows(spark, no_docs):
    assert L.scores(no_docs, crc_of_id() % 7 == 2).count() == 0
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    r = L.scores(one, F.lit(True)).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (3, 0, 0, 0.0, 0.0)


def test_model_sums_to_one():
    texts = [tokens(t) for t in ("a b c a b", "b a", "c c c", "a b d")]
    brute = Brute(texts, 3, 2.0)
    words = {w for t in texts for w in t}
    histories = {t[max(0, i - n) : i] for t in texts for i in range(len(t)) for n in range(3)}
    assert len(histories) > 10
    for h in histories:
        assert abs(sum(brute.p(h, w) for w in words) + brute.p(h, "unknown") - 1) < 1e-12


def test_packed_numbers():
    for x in (np.array([0, 1, 2**40, -5, 7]), np.array([], np.int64), np.arange(1000)):
        assert (L.unpacked(L.packed(x), np.int64) == x).all()
    assert (L.unpacked(L.packed(np.arange(9, dtype=np.int32)), np.int32) == np.arange(9)).all()


def test_long_texts_are_cut_between_words():
    numbers = L._Numbers()
    words = ("Ab  c\n" * 300_000).split()
    ids = L.token_ids("Ab  c\n" * 300_000, numbers)
    assert len(ids) == len(words) + 1 and list(numbers) == [b"ab", b"c", L.END]
