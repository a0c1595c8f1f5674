import gzip
import hashlib
import zlib
from collections import defaultdict
from pathlib import Path

import pytest

from tendril.llm import sharding as S
from tendril.llm import warc as W

ROWS = [(3, "u\nx", "A" * 200), (1, None, "A" * 200), (2, "v", None), (5, "w", "A" * 200), (None, "z", "A" * 200), (6, "p", "short"), (7, "p", "short"), (5, "w", "A" * 200), (8, "é", "Ä" * 60), (9, "q", "B" * 100_000), (10, "q", "Ä" * 60)]


def test_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(*r, 1) for r in ROWS], "page_id long, url string, html string, digest int").repartition(3)
    folder = f"file://{tmp_path}/w"
    manifest = W.write_archives(df, folder, roll_bytes=600)
    assert manifest.count() > 2 and manifest.agg({"records": "sum"}).first()[0] == len(ROWS)
    out = W.read_archives(manifest, folder).collect()
    text = lambda h: (h or "").encode()
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest) for r in out) == sorted((str(p), len(text(h)), hashlib.sha256(text(h)).hexdigest()) for p, _, h in ROWS)
    kind = {(r.page_id, r.record_type, r.refers_to) for r in out}
    assert {(1, "response", None), (3, "revisit", 1), (5, "revisit", 1), (6, "response", None), (7, "response", None), (8, "response", None), (10, "revisit", 8), (None, "response", None)} <= kind
    assert {r.url for r in out if r.page_id == 3} == {"u x"} and all((r.payload is None) == (r.record_type == "revisit") for r in out)
    # any reader of gzip sees whole records, and a second run writes the same bytes under the same names
    files = sorted(Path(tmp_path, "w").glob("*.warc.gz"))
    assert gzip.decompress(files[0].read_bytes()).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n") and not list(Path(tmp_path, "w").glob("_temporary*"))
    again = W.write_archives(df, f"file://{tmp_path}/again", roll_bytes=600)
    assert sorted(r.sha256 for r in again.collect()) == sorted(r.sha256 for r in manifest.collect())
    files[0].write_bytes(files[0].read_bytes()[:-9])
    with pytest.raises(Exception, match="manifest"):
        W.read_archives(manifest, folder).collect()


def brute_records(rows):
    """rows (page_id, html) -> page_id, payload_bytes, payload_digest, record_type, refers_to of each."""
    first, out = {}, []
    data = [(p, (h or "").encode()) for p, h in rows]
    for p, x in data:
        if p is not None and len(x) >= 100:
            first[x] = min(p, first.get(x, p))
    for p, x in data:
        to = first.get(x, p) if p is not None else None
        out.append((p, len(x), hashlib.sha256(x).hexdigest(), "response" if to == p else "revisit", None if to == p else to))
    return sorted(map(str, out))


def found(df):
    return sorted(str((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in df.collect())


def test_given_pages_against_brute_force(spark):
    pages = [(r.page_id, r.html) for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    assert found(W.op2_warc_round_trip(spark, "/root/testdata/sf0.01")) == brute_records(pages)


def test_ids_of_several_payloads(spark, tmp_path):
    """A revisit is one of page and payload: no payload is lost where an id has several."""
    a, b = "A" * 200, "B" * 200
    rows = [(1, a), (7, a), (7, b), (8, b), (8, a), (8, a), (None, b), (9, None), (9, b)]
    df = spark.createDataFrame(rows, "page_id long, html string").withColumn("url", W.F.lit(None).cast("string")).repartition(3)
    folder = f"file://{tmp_path}/w"
    out = W.read_archives(W.write_archives(df, folder), folder)
    assert found(out) == brute_records(rows)
    assert {r.payload for r in out.collect() if r.record_type == "response"} == {a.encode(), b.encode(), b""}
    texts = df.selectExpr("concat('p/', page_id, ' é>') AS page_id", "html", "url")
    folder = f"file://{tmp_path}/t"
    out = W.read_archives(W.write_archives(texts, folder), folder, "string").collect()
    assert {(r.page_id, r.refers_to) for r in out if r.record_type == "revisit"} == {("p/7 é>", "p/1 é>"), ("p/8 é>", "p/1 é>"), ("p/8 é>", "p/7 é>"), ("p/9 é>", "p/7 é>")}


def test_shard_counts():
    assert [W.shard_count(n) for n in (0, 100 << 20, 200 << 20, 10 << 30, 100 << 40)] == [1, 6, 8, 10, 100 << 10]


def test_same_archives_whatever_the_partitions(spark, tmp_path):
    """A table larger than any sample of a range sort, dealt out and read in other ways."""
    pages = spark.range(60_000).selectExpr("(id * 7919) % 60013 - 3 AS page_id", "concat('https://x/', id) AS url", "concat(repeat(sha2(cast(id % 40000 AS string), 256), 2), id % 40000) AS html")
    pages = pages.union(pages.limit(0)).withColumn("page_id", W.F.when(W.F.col("page_id") > 5, W.F.col("page_id")))
    sums, before = [], spark.conf.get("spark.sql.shuffle.partitions")
    for k, (parts, shuffled) in enumerate(((3, "4"), (11, "17"))):
        spark.conf.set("spark.sql.shuffle.partitions", shuffled)
        rows = W.write_archives(pages.repartition(parts, "url"), f"file://{tmp_path}/{k}", roll_bytes=100_000, shard_bytes=1 << 20).collect()
        sums.append(sorted((r.shard, r.part, r.records, r.sha256) for r in rows))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sums[0] == sums[1] and len({r[0] for r in sums[0]}) == 8 and max(r[1] for r in sums[0]) > 1 and sum(r[2] for r in sums[0]) == 60_000
    by_shard = defaultdict(int)
    for shard, _, records, _ in sums[0]:
        by_shard[shard] += records
    assert max(by_shard.values()) < 1.1 * min(by_shard.values())


def test_damage_is_seen():
    record = W.page_record("1", "u", b"payload", None, hashlib.sha256(b"payload").hexdigest(), 7)
    assert W.parsed(record)[1].endswith(b"payload")
    with pytest.raises(ValueError):
        W.parsed(record.replace(b"payload", b"paYload"))
    with pytest.raises(ValueError):
        list(W.members(gzip.compress(record)[:-20]))
    assert [zlib.crc32(x) for x in W.members(gzip.compress(b"a") + gzip.compress(b"b" * 200_000))] == [zlib.crc32(b"a"), zlib.crc32(b"b" * 200_000)]


def test_no_pages(spark, tmp_path):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    folder = f"file://{tmp_path}/w"
    assert W.read_archives(W.write_archives(df, folder), folder).count() == 0


def check_shards(rows, shards):
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    assert set(by) <= set(range(shards))
    for x in by.values():
        assert sorted(r.slot for r in x) == list(range(len(x)))
    return [sum(r.size for r in by[k]) for k in range(shards)]


def test_shards_of_given_documents(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text").collect()}
    rows = S.op10_kd_sharding(spark, "/root/testdata/sf0.1").collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {i: (len(t.encode()) + 8, zlib.crc32(t.encode())) for i, t in docs.items()} and len(rows) == len(docs)
    sizes = check_shards(rows, 24)
    assert max(sizes) / min(sizes) < 1.05 and {r.law for r in rows} == {"bytes"}


def test_odd_shards(spark, odd_docs, no_docs):
    rows = S.kd_shards(odd_docs, 5).collect()
    assert len(rows) == odd_docs.count() and {r.size for r in rows if r.doc_id == 1} == {8}
    check_shards(rows, 5)
    assert S.kd_shards(no_docs).count() == 0
    same = spark.range(240).selectExpr("id % 2 AS doc_id", "'t' AS text", "'l' AS lang", "'s' AS source")
    check_shards(S.kd_shards(same, 4).collect(), 4)
    hot = spark.range(2400).selectExpr("id % 2 AS doc_id", "'t' AS text", "'l' AS lang", "'s' AS source")
    sizes = check_shards(S.kd_shards(hot).collect(), 24)  # two rows, each repeated 1,200 times
    assert sum(sizes) == 2400 * 9 and max(sizes) / min(sizes) < 1.05
