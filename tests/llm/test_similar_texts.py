import random

import numpy as np
import pyarrow as pa

from tendril.llm import shared
from tendril.llm import similar_texts as M


def brute_similar(texts):
    """texts by id -> the smallest id of each one's group."""
    sets = {i: set(M.shingle_hashes((t or "").encode()).tolist()) for i, t in texts.items()}
    ids = sorted(sets)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            a, b = len(sets[i]), len(sets[j])
            if 100 * min(a, b) >= 80 * max(a, b):
                both = len(sets[i] & sets[j])
                if 100 * both >= 80 * (a + b - both):
                    x, y = find(i), find(j)
                    parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def roots(docs):
    """id -> the first of its group, for all but the firsts."""
    own, rows, key, unique = M.keyed(docs)
    assert unique
    return {r.node: r.root for r in M.similar_documents(own.select(M.F.col(key).alias("id"), M.F.col("text").cast("binary").alias("text")), rows.select("key", "digest")).collect()}


def test_given_documents_in_chunks(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    group = brute_similar({r.doc_id: r.text for r in docs.collect()})
    want = {i: g for i, g in group.items() if i != g}
    assert len(want) > 50
    for size in (M.BUCKET, 3):
        monkeypatch.setattr(M, "BUCKET", size)
        assert roots(docs) == want


def test_a_large_group_of_near_copies(spark):
    words = [f"w{k}" for k in range(300)]
    texts = {n: " ".join(w if (k * 7 + n) % 150 else f"x{n}" for k, w in enumerate(words)) for n in range(200)}
    group = brute_similar(texts)
    out = roots(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))
    assert out == {i: g for i, g in group.items() if i != g} and len(out) > 150


def test_odd_documents(spark, odd_docs, no_docs):
    kept = M.without_similar(odd_docs)
    assert kept.columns == odd_docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "10", "4", "5", "5", "7", "8", "None"]
    assert M.without_similar(no_docs).count() == 0


def test_rows_without_ids_and_ids_of_several_texts(spark):
    """Rows are judged by id and text: a copy goes, whatever other row has its id."""
    a, b, c = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
    rows = [(1, a), (2, b), (3, a), (3, c), (None, b), (None, b + " more"), (None, c + " x"), (3, c), (5, None), (6, "")]
    left = M.without_similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len([r for r in left if r.text and r.text.startswith("b0")]) == 1 and len([r for r in left if r.text and r.text.startswith("c0")]) == 1
    assert [r.doc_id for r in left if r.text and r.text.startswith("a0")] == [1] and [r.doc_id for r in left if not r.text] == [5]
    text_ids = M.without_similar(spark.createDataFrame([("x", a), ("y", a), ("z", b)], "doc_id string, text string")).collect()
    assert sorted(r.doc_id for r in text_ids) == ["x", "z"]


def test_a_form_filled_in_differently(spark, monkeypatch):
    """A family whose similarities lie on both sides of 0.8: links that fail don't hide those that hold."""
    rng = random.Random(5)
    fields = set(rng.sample(range(200), 12))
    texts = {n: " ".join(f"v{k}_{rng.randint(0, 4)}" if k in fields else f"w{k}" for k in range(200)) for n in range(300)}
    want = {i: g for i, g in brute_similar(texts).items() if i != g}
    assert 30 < len(want)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for shingles in (M.SHINGLES, 20_000):
        monkeypatch.setattr(M, "SHINGLES", shingles)
        assert roots(docs) == want


def test_repeated_lines(spark):
    """Similarity is of distinct shingles, however often a text repeats some; the radius discards no similar pair."""
    article = " ".join(f"a{k}" for k in range(400))
    texts = {1: article, 2: article + "".join(f" x{k % 10}" for k in range(1000)), 3: article + "".join(f" y{k % 10}" for k in range(1000))}
    fps = [r["fp"] for b in M._sketches(iter([pa.RecordBatch.from_arrays([pa.array([*texts]), pa.array([t.encode() for t in texts.values()])], ["id", "text"])])) for r in b.to_pylist()]
    assert max((x ^ y).bit_count() for x in np.array(fps).view(np.uint64).tolist() for y in np.array(fps).view(np.uint64).tolist()) <= 12
    assert roots(spark.createDataFrame(list(texts.items()), "doc_id long, text string")) == {2: 1, 3: 1}


def test_passing_tables_are_deleted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(shared, "shared_dir", lambda _: f"file://{tmp_path}")
    docs = spark.createDataFrame([(k, f"{'a b c d e f ' * 9} {k // 2}") for k in range(8)], "doc_id long, text string")
    assert sorted(r.doc_id for r in M.without_similar(docs).collect()) == [0, 2, 4, 6]
    assert {p.name for p in tmp_path.glob("*/*")} == {"digests", "similar"}
