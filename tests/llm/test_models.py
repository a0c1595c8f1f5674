import numpy as np
import pytest

from tendril.llm import language_id as L
from tendril.llm import quality_model as M
from tendril.llm.shared import least_hashes

DATA = "/root/testdata/sf0.01"


def test_language_held_out(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang").collect()}
    out = L.op7_language_codes(spark, DATA).collect()
    held = [r for r in out if r.held_out]
    assert len(out) == len(truth) and len(held) > 100 and all(0 <= r.score <= 1 for r in out)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.98


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 12])
def test_codewords_are_apart(n):
    code = L.codewords(n)
    assert code.shape[0] == n and len({tuple(r) for r in code}) == n
    if n > 1:
        assert not (np.abs(code.sum(axis=0)) == n).any()
    if n > 2:  # one wrong bit never makes another codeword nearest
        apart = (code.shape[1] - code @ code.T) // 2 + 99 * np.eye(n, dtype=int)
        assert apart.min() >= 2


def test_language_of_odd_documents(spark, odd_docs, no_docs):
    model = L.fit(odd_docs)
    out = L.identify(odd_docs, model, "doc_id", "h").collect()
    assert len(out) == odd_docs.count() and {r.doc_id for r in out if r.lang_pred == "und"} == {1, 2, 3, 7}
    assert all(r.score == 0 for r in out if r.lang_pred == "und") and set(model.langs) == {"en", "de", "es", "xx"}
    kept = L.with_known_language(odd_docs)
    assert kept.columns == odd_docs.columns and {r.doc_id for r in kept.collect()} == {4, 5, 6, 8, 9, 10, None}
    assert L.fit(no_docs) is None and {r.lang_pred for r in L.identify(odd_docs, None, "doc_id").collect()} == {"und"}
    assert L.identify(no_docs, model, "doc_id").count() == 0


def test_language_features_of_pieces(monkeypatch):
    text = "Das ist ein Text über vieles. " * 50
    whole = L.features(text)
    monkeypatch.setattr(L, "PIECE", 100)
    assert np.allclose(L.features(text), whole)


def test_quality_held_out(spark):
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    out = M.op4_quality_model(spark, DATA).collect()
    held = [(r.score, r.predicted, truth[r.doc_id]) for r in out if r.held_out and r.doc_id in truth]
    assert len(held) > 60 and all((r.predicted == 1) == (r.score >= 0.7) and 0 <= r.score <= 1 for r in out)
    good, bad = [s for s, _, y in held if y], [s for s, _, y in held if not y]
    assert np.mean([[g > b for b in bad] for g in good]) > 0.95 and np.mean([p == y for _, p, y in held]) > 0.93
    assert sorted(r.doc_id for r in out) == sorted(r.doc_id for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id").collect())


def test_quality_of_odd_documents(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(4, 1), (5, 0), (5, 1), (7, 0), (8, None), (None, 1), (99, 1), (10, 0)], "doc_id long, quality int")
    model = M.fit(odd_docs, labels)
    out = M.score_quality(odd_docs, model).collect()
    assert len(out) == odd_docs.count() and all(0 <= r.score <= 1 for r in out)
    assert M.fit(odd_docs, labels.limit(0)) is None and {r.score for r in M.score_quality(odd_docs, None).collect()} == {0.5}
    assert M.score_quality(no_docs, model).count() == 0
    assert M.score_quality(odd_docs.limit(1), M.fit(no_docs, labels)).count() == 1


def test_tokens_of_pieces(monkeypatch):
    text = "Some words, and more!! of them " * 40
    whole = [t for p in M.tokens_of(text) for t in p]
    monkeypatch.setattr(M, "PIECE", 50)
    assert [t for p in M.tokens_of(text) for t in p] == whole


def test_samples_are_bounded_in_rows(spark):
    """Rows without an id, and ids of many rows, don't widen the samples."""
    rows = spark.range(3000).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "concat('text of row ', id, ' is here') AS text", "'en' AS lang").union(spark.range(3000).selectExpr("7L AS doc_id", "'the very same' AS text", "'de' AS lang"))
    seen = []
    plain = L.train
    try:
        L.train = lambda x, langs: seen.extend(langs) or plain(x, langs)
        L.fit(rows, 50)
    finally:
        L.train = plain
    assert seen.count("en") == 50 and seen.count("de") == 1
    labels = spark.createDataFrame([(7, 1), (8, 0)], "doc_id long, quality int")
    assert M.fit(rows, labels).vectors.shape[1] == M.DIM


def test_least_hashes(spark):
    rows = spark.range(20_000).selectExpr("id % 3 AS k", "xxhash64(id) AS h", "id")
    every = sorted((r.h, r.k) for r in rows.collect())
    assert [r.h for r in least_hashes(rows, 100).collect()] == [h for h, _ in every[:100]]
    out = least_hashes(rows.select("k", "h"), 100, "k").collect()
    assert all(sorted(r.h for r in out if r.k == k) == [h for h, x in every if x == k][:100] for k in range(3))
