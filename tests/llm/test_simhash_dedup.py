import re

import numpy as np
import xxhash

from tendril.llm import simhash_dedup as M


def brute_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    ids = sorted(fps)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_given_documents(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    out = {r.doc_id: r for r in M.op6_simhash_near_duplicates(spark, "/root/testdata/sf0.001").collect()}
    fps = {i: brute_fingerprint(t) for i, t in docs.items()}
    assert {i: int(r.fingerprint, 16) for i, r in out.items()} == fps
    assert {i: r.component_id for i, r in out.items()} == brute_components(fps)


def test_links_in_chunks(spark, monkeypatch):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 4)
    fps = {int(b) for b in base}
    for _ in range(300):  # chains around a few centres: buckets far above the chunk size
        fps.add(int(rng.choice(sorted(fps))) ^ (1 << int(rng.integers(0, 63))) ^ (1 << int(rng.integers(0, 63))))
    for size in (10**6, 7):
        monkeypatch.setattr(M, "BUCKET", size)
        links = M.fingerprint_links(spark.createDataFrame([(f,) for f in fps], "fp long"))
        stars = {r.node: r.root for r in M.connected(links).collect()}
        root = brute_components({f: f for f in fps})
        mine = {f: stars.get(f, f) for f in fps}
        assert len({(mine[f], root[f]) for f in fps}) == len(set(root.values())) == len(set(mine.values()))


def test_bit_counts_of_many():
    h = np.random.default_rng(2).integers(0, 2**64, 70_000, dtype=np.uint64)
    want = [int(((h >> np.uint64(b)) & np.uint64(1)).sum()) for b in range(64)]
    assert M.bit_counts(h).tolist() == want and M.bit_counts(h[:1]).sum() == int(h[0]).bit_count()


def test_odd_documents(spark, odd_docs, no_docs):
    out = M.near_duplicates(odd_docs).collect()
    assert len(out) == odd_docs.count() and {r.component_id for r in out if r.doc_id in (1, 2, 3)} == {1}
    assert {r.component_id for r in out if r.doc_id in (5, 6)} == {5} and {r.component_id for r in out if r.doc_id in (4, 9)} == {4}
    assert [r.component_id for r in out if r.doc_id is None] == [None]
    assert M.near_duplicates(no_docs).count() == 0
