import hashlib
import random

import numpy as np
import pyarrow as pa

from tendril.llm import suffix_dedup as M


def brute(docs):
    """docs: (doc_id, text) in document order -> n_bytes, n_removed, n_spans, what is left."""
    seen, out = set(), {}
    for doc, text in docs:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - 99):
            s = data[i : i + 100]
            if s in seen:
                gone[i : i + 100] = b"\1" * 100
            seen.add(s)
        spans = sum(1 for a, b in zip(b"\0" + bytes(gone), gone, strict=False) if b and not a)
        out[doc] = (len(data), sum(gone), spans, bytes(c for c, x in zip(data, gone, strict=True) if not x))
    return out


def results(spark, df, monkeypatch):
    monkeypatch.setattr(M, "table", lambda *_: df)
    return [(r.doc_id, (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in M.op8_suffix_array_dedup(spark, "").collect()]


def digested(x):
    return (*x[:3], hashlib.sha256(x[3]).hexdigest())


def test_given_documents(spark, monkeypatch):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = brute(sorted((r.doc_id, r.text) for r in df.collect()))
    assert dict(results(spark, df, monkeypatch)) == {i: digested(x) for i, x in want.items()}


def test_random_repeats_and_chunks(spark, monkeypatch):
    rng = random.Random(3)
    text = lambda n: "".join(rng.choice("abc de") for _ in range(n))
    parts = [text(rng.randint(60, 400)) for _ in range(12)] + ["x" * 300, "ab" * 200, "é" * 120]
    docs = [(i, "".join(rng.choice(parts) if rng.random() < 0.5 else text(rng.randint(0, 250)) for _ in range(rng.randint(0, 8)))) for i in range(150)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    want = {i: digested(x) for i, x in brute(docs).items()}
    assert dict(results(spark, df, monkeypatch)) == want
    plain = M.duplicate_spans
    monkeypatch.setattr(M, "duplicate_spans", lambda t, _: plain(t, 7))  # buckets cut into chunks of seven
    monkeypatch.setattr(M, "ROWS", 50)
    monkeypatch.setattr(M, "PIECE", 300)
    assert dict(results(spark, df, monkeypatch)) == want


def test_odd_documents(spark, odd_docs, no_docs, monkeypatch):
    out = results(spark, odd_docs, monkeypatch)
    assert len(out) == odd_docs.count()
    distinct = {(r.doc_id, r.text) for r in odd_docs.collect()}
    want = brute(sorted(distinct, key=lambda x: (x[0] is not None, x[0] or 0)))
    assert dict(out) == {i: digested(x) for i, x in want.items()}
    assert dict(out)[9][1] == dict(out)[9][0] and dict(out)[10][:2] == (500, 499)  # a later copy; one that overlaps itself
    assert results(spark, no_docs, monkeypatch) == []
    kept = M.without_repeats(odd_docs)
    assert kept.columns == odd_docs.columns and 9 not in {r.doc_id for r in kept.collect()}


def test_clean_text_longer_than_a_piece(spark, monkeypatch):
    text = random.Random(9).randbytes(M.PIECE + 5_000).hex()  # two boundaries
    assert dict(results(spark, spark.createDataFrame([(1, text)], "doc_id long, text string"), monkeypatch)) == {1: digested((len(text), 0, 0, text.encode()))}


def test_anchors_come_once():
    text = random.Random(4).randbytes(4_000).hex().encode()
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([text, text[5:]])], ["key", "text"])
    rows = [tuple(r.values()) for b in M._anchors(iter([batch]), 300) for r in b.to_pylist()]
    assert {r[3] for r in rows} == {None}
    assert len(rows) == len(set(rows)) and sorted(rows) == sorted(tuple(r.values()) for b in M._anchors(iter([batch])) for r in b.to_pylist())


def test_previous_and_next_smaller_positions():
    rng = random.Random(8)
    for _ in range(200):
        n = rng.randint(1, 30)
        run, place = sorted(rng.choices(range(6), k=n)), rng.sample(range(100), n)
        want = [any(q < p and s == r for q, s in zip(place, run, strict=True)) for p, r in zip(place, run, strict=True)]
        assert M.earlier_match(np.array(run), np.array(place)).tolist() == want


def test_texts_that_repeat_themselves(spark, monkeypatch):
    """Constant and periodic texts leave a few anchors, and what goes is what brute force says."""
    line = "One line of the text that is there again and again, with a period of more than a hundred bytes, to be sure. "
    docs = [(1, "x" * 5000), (2, "ab" * 3000), (3, line * 60), (4, "y" * 150 + line * 20 + "x" * 400), (5, (line + "z" * 130) * 30), (6, "".join(f"{line}{k % 2}" for k in range(40)))]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    assert dict(results(spark, df, monkeypatch)) == {i: digested(x) for i, x in brute(docs).items()}
    monkeypatch.setattr(M, "PIECE", 1000)
    assert dict(results(spark, df, monkeypatch)) == {i: digested(x) for i, x in brute(docs).items()}


def test_ten_megabytes_of_one_byte(spark, monkeypatch):
    n = 10 << 20
    anchors = [r for b in M._anchors(iter([pa.RecordBatch.from_arrays([pa.array([1]), pa.array([b"x" * n])], ["key", "text"])])) for r in b.to_pylist()]
    assert len(anchors) < 1000
    out = dict(results(spark, spark.createDataFrame([(1, "x" * n)], "doc_id long, text string"), monkeypatch))
    assert out == {1: (n, n - 1, 1, hashlib.sha256(b"x").hexdigest())}
