"""Deterministic sharded WARC writer, and reading its archives back.

Records are range-sorted by page_id and payload digest into shards of equal bytes, whose bounds come from exact prefix
sums: the same pages give the same archives, whatever the cores, partitions or session. A shard's task streams its
records into gzip members, rolls to a new file when the compressed size reaches `ROLL_BYTES`, and regenerates every
header and digest. A file is written under a temporary name and then moved to its final one, and counts only once the manifest, a Parquet table that Spark commits,
names it: a task that runs twice writes the same bytes, and what a lost one leaves behind is in no manifest.

Which records are revisits is found from digests alone (a group of copies gives one row, its smallest page_id) and is
sorted in before the page and payload it is about, so page contents are shuffled once. Files go to any store that
pyarrow's file systems reach; the folder must be shared by all executors.

Defined cases: null html counts as empty; payloads under `MIN_SHARED` bytes are always responses; a page_id of several
payloads has a record of each, and each is judged by its own; rows repeated whole are all what the page is for that
payload; a null page_id is kept, sorts first and is always a response; line breaks in a url become spaces, a null url
is left out; ids of any type that casts to text and back; other columns are ignored. Pages are written whole.
"""

from __future__ import annotations

import bisect
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tendril.llm.prefix_trie import running
from tendril.llm.shared import new_folder, table, written

MIN_SHARED = 100
SHARD_BYTES = 1 << 30  # of payloads in a shard at most, or thereabouts
FEW, LEAST_SHARD = 8, 16 << 20  # a smaller table is cut into so many shards, but none below so many bytes
ROLL_BYTES = 16 << 20  # of a compressed file
READ_BYTES = 64 << 20  # of archives that a task reads, one after another
LEVEL = 6
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "path string, shard int, part int, records bigint, bytes bigint, sha256 string"
FIELDS = "url string, payload_bytes bigint, payload_digest string, record_type string"


def _record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = [("WARC-Type", kind), *fields, ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def _digest(data: bytes) -> str:
    return "sha256:" + hashlib.sha256(data).hexdigest()


def _urn(page_id: str | None) -> str:
    return "<urn:page>" if page_id is None else f"<urn:page:{quote(page_id, safe='')}>"


def _page_id(urn: str | None) -> str | None:
    return unquote(urn[len("<urn:page:") : -1]) if urn and urn != "<urn:page>" else None


def page_record(page_id: str | None, url: str | None, payload: bytes | None, refers_to: str | None, digest: str, n_bytes: int) -> bytes:
    """A response, or a revisit if refers_to is given; a revisit's block has the HTTP head only."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    fields = [("WARC-Record-ID", _urn(page_id)), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", " ".join(url.splitlines())))
    fields += [("WARC-Payload-Digest", f"sha256:{digest}"), ("WARC-Block-Digest", _digest(block)), ("Content-Type", "application/http;msgtype=response")]
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _urn(refers_to))]
    return _record("response" if refers_to is None else "revisit", fields, block)


class _Shard:
    """Writes one shard's records to rolling files."""

    def __init__(self, fs: FileSystem, folder: str, shard: int, roll: int):
        self.fs, self.folder, self.shard, self.roll = fs, folder, shard, roll
        self.part, self.out, self.rows = 0, None, []

    def put(self, record: bytes) -> None:
        if self.out is None:
            self.temporary = f"{self.folder}/_temporary-{self.shard:06d}-{self.part:04d}-{TaskContext.get().taskAttemptId()}"
            self.out = self.fs.open_output_stream(self.temporary, compression=None)
            self.size = self.records = 0
            self.sum = hashlib.sha256()
            self._member(_record("warcinfo", [("WARC-Record-ID", f"<urn:shard:{self.shard}:{self.part}>"), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
        self._member(record)
        self.records += 1
        if self.size >= self.roll:
            self.close()

    def _member(self, record: bytes) -> None:
        packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        data = packer.compress(record) + packer.flush()
        self.out.write(data)
        self.sum.update(data)
        self.size += len(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            final = f"{self.folder}/part-{self.shard:06d}-{self.part:04d}.warc.gz"
            self.fs.move(self.temporary, final)
            self.rows.append((final, self.shard, self.part, self.records, self.size, self.sum.hexdigest()))
            self.part, self.out = self.part + 1, None

    def done(self) -> list[tuple]:
        self.close()
        return self.rows


def revisits(pages: DataFrame) -> DataFrame:
    """pages (page_id, html) -> page_id, digest, refers_to: the payloads of pages that have a response with a smaller
    page_id, which is the same page's for none of them."""
    digests = pages.select("page_id", F.sha2(F.col("html").cast("binary"), 256).alias("digest")).where(F.octet_length("html") >= MIN_SHARED).where("page_id is not null")
    digests = written(digests, "digests")
    first = digests.groupBy("digest").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last")).where("first < last").select("digest", "first")
    # a table of its own, so that the join has a plain shuffle on either side and a common page can be split
    return digests.join(written(first, "first_pages"), "digest").where("page_id > first").select("page_id", "digest", F.col("first").alias("refers_to")).distinct()


def shard_count(total: int, shard_bytes: int = SHARD_BYTES) -> int:
    """Shards of about shard_bytes; `FEW` of a smaller table, but none below LEAST_SHARD."""
    return max(1, -(-total // shard_bytes), min(FEW, total // min(LEAST_SHARD, shard_bytes)))


def shard_bounds(sizes: DataFrame, total: int, shards: int) -> list[tuple]:
    """sizes (page_id, digest, n), written -> the first (page_id, digest) of each shard: shards are equal parts of the
    bytes in order, which prefix sums give exactly, so they are the table's own and not those of a sample or of cores."""
    at = running(sizes.select(F.lit(0).cast("long").alias("all"), "page_id", "digest", "n", F.col("n").alias("sum")), "all", [F.col("page_id").asc_nulls_first(), F.col("digest")], ["sum"])
    shard = F.least(F.floor((F.col("sum") - F.col("n")) * shards / max(total, 1)), F.lit(shards - 1))
    first = at.groupBy(shard.cast("int").alias("shard")).agg(F.min(F.struct("page_id", "digest")).alias("key")).collect()  # a row per shard
    return sorted((_order(r["key"].page_id, r["key"].digest) for r in first))


def _order(page_id, digest: str) -> tuple:
    return (page_id is not None, *([] if page_id is None else [page_id]), digest)


def write_archives(pages: DataFrame, folder: str, roll_bytes: int = ROLL_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """pages (page_id, url, html) -> the manifest of the archives written to the folder (a URI)."""
    id_type = pages.schema["page_id"].dataType
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    digest = F.sha2(payload, 256)
    sizes = written(pages.select("page_id", digest.alias("digest"), F.octet_length(payload).cast("long").alias("n")), "sizes")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    bounds = shard_bounds(sizes, total, shard_count(total, shard_bytes))

    @F.arrow_udf("int")
    def shard_of(ids: pa.Array, digests: pa.Array) -> pa.Array:
        # equal keys are in one shard, the last that begins with them
        return pa.array([max(0, bisect.bisect_right(bounds, _order(*key)) - 1) for key in zip(ids.to_pylist(), digests.to_pylist(), strict=True)], pa.int32())

    rows = pages.select("page_id", digest.alias("digest"), F.lit(1).alias("kind"), "url", payload.alias("payload"), F.lit(None).cast(id_type).alias("refers_to"))
    marks = revisits(pages).select("page_id", "digest", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"), "refers_to")
    dealt = rows.unionByName(marks).withColumn("shard", shard_of("page_id", "digest") if bounds else F.lit(0))
    shards = dealt.repartitionByRange(max(1, len(bounds)), "shard").sortWithinPartitions("shard", "page_id", "digest", "kind", "url")
    shards = shards.select(F.col("page_id").cast("string"), "digest", "kind", "url", "payload", F.col("refers_to").cast("string"), "shard")
    fs_, path_ = FileSystem.from_uri(folder)
    fs_.create_dir(path_, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = FileSystem.from_uri(folder)
        fs.create_dir(path, recursive=True)
        shard, mark, manifest = None, (None, None, None), []
        for batch in batches:
            for k in range(batch.num_rows):
                page, digest, kind, url, payload, refers_to, own = (c[k].as_py() for c in batch.columns)
                if shard is None or own != shard.shard:
                    manifest += shard.done() if shard else []
                    shard = _Shard(fs, path, own, roll_bytes)
                if not kind:
                    mark = (page, digest, refers_to)
                    continue
                to = mark[2] if mark[:2] == (page, digest) else None
                shard.put(page_record(page, url, payload, to, digest, len(payload)))
        manifest += shard.done() if shard else []
        columns = list(zip(*manifest, strict=True)) or [[]] * 6
        types = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [x.split()[0] for x in MANIFEST.split(", ")])

    return written(shards.mapInArrow(run, MANIFEST), "manifest")


def members(data: bytes) -> Iterator[bytes]:
    """The contents of a gzip file's members, one by one."""
    view, at = memoryview(data), 0
    while at < len(view):
        unpacker, parts = zlib.decompressobj(31), []
        while not unpacker.eof:
            if at >= len(view):
                raise ValueError("an archive ends inside a record")
            fed = min(len(view) - at, 1 << 16)
            parts.append(unpacker.decompress(view[at : at + fed]))
            at += fed - len(unpacker.unused_data)
        yield b"".join(parts)


def parsed(record: bytes) -> tuple[dict[str, str], bytes]:
    """A record's fields (lower-case names) and block; the block's length and digest are verified."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    block = rest[: int(fields["content-length"])]
    if not version.startswith("WARC/") or rest[len(block) :] != b"\r\n\r\n" or fields.get("warc-block-digest", _digest(block)) != _digest(block):
        raise ValueError(f"a damaged record: {fields.get('warc-record-id')}")
    return fields, block


def read_archives(manifest: DataFrame, folder: str, id_type: str = "bigint") -> DataFrame:
    """The manifest's archives -> page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload (null
    for revisits): a row per response or revisit. A task reads about `READ_BYTES` of them, a file at a time."""
    names = ["page_id", *[x.split()[0] for x in FIELDS.split(", ")], "refers_to", "payload"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = FileSystem.from_uri(folder)
        rows: list[tuple] = []

        def out() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [[]] * 7
            rows.clear()
            types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        for batch in batches:
            for path, sha in zip(batch.column(0), batch.column(1), strict=True):
                with fs.open_input_stream(path.as_py(), compression=None) as file:
                    data = file.read()
                if hashlib.sha256(data).hexdigest() != sha.as_py():
                    raise ValueError(f"{path} isn't what its manifest says")
                size = 0
                for fields, block in map(parsed, members(data)):
                    if fields["warc-type"] not in ("response", "revisit"):
                        continue
                    http, _, payload = block.partition(b"\r\n\r\n")
                    length = int(http.decode().lower().rpartition("content-length:")[2].split("\r\n")[0])
                    digest = fields["warc-payload-digest"]
                    if fields["warc-type"] == "response" and (len(payload) != length or _digest(payload) != digest):
                        raise ValueError(f"a damaged payload: {fields['warc-record-id']}")
                    revisit = fields["warc-type"] == "revisit"
                    rows.append((_page_id(fields["warc-record-id"]), fields.get("warc-target-uri"), length, digest.removeprefix("sha256:"), fields["warc-type"], _page_id(fields.get("warc-refers-to")), None if revisit else payload))
                    size += len(payload)
                    if len(rows) >= 2000 or size >= 8 << 20:
                        size = 0
                        yield out()
        yield out()

    files, size = manifest.agg(F.count(F.lit(1)), F.sum("bytes")).first()
    tasks = max(1, -(-(size or 0) // READ_BYTES), min(files, manifest.sparkSession.sparkContext.defaultParallelism))
    read = manifest.select("path", "sha256").repartition(tasks).mapInArrow(run, f"page_id string, {FIELDS}, refers_to string, payload binary")
    return read.withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})


def op2_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    folder = new_folder(spark, "warc")
    if "://" not in folder:
        folder = f"file://{folder}" if folder.startswith("/") else folder
    manifest = write_archives(pages, folder)
    return read_archives(manifest, folder, pages.schema["page_id"].dataType.simpleString()).drop("url", "payload")
