"""Digests of raw artifacts where they lie.

Files are opened by the tasks and read piece by piece, so a task holds one piece of one file, whatever the file's size. A
manifest's paths are looked up one by one: nothing is listed on the driver, and a file without bytes is a file too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow.fs import FileSystem, FileType, LocalFileSystem
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE = 1 << 22  # bytes that are held at a time
TASKS_PER_CORE = 4  # files differ in size, so there are more tasks than cores

FOUND = "resolved_path string, file_bytes long, digest string"


def candidates(path: str, roots: list[str]) -> list[str]:
    """Where a manifest's path may lie: there, if it is absolute or a URI, else below each of the roots. Backslashes
    count as slashes."""
    plain = path.replace("\\", "/")
    if plain.startswith("/") or "://" in plain or plain.startswith("file:/"):
        return [plain]
    return [f"{root.rstrip('/')}/{plain}" for root in roots]


def opened(place: str) -> tuple[FileSystem, str]:
    """The file system and the path in it of a path or URI. Names are taken as they are: a URI's escapes aren't decoded."""
    if place.startswith(("file:/", "/")):
        return LocalFileSystem(), "/" + place.removeprefix("file:").lstrip("/")
    return FileSystem.from_uri(quote(place, safe="/:@"))


def sha256_of(fs: FileSystem, path: str, piece: int = PIECE) -> tuple[int, str]:
    """Size and digest of a file, read piece by piece."""
    size, digest = 0, hashlib.sha256()
    with fs.open_input_stream(path, compression=None) as stream:
        while data := stream.read(piece):
            digest.update(data)
            size += len(data)
    return size, digest.hexdigest()


def _first(path: str, roots: list[str]) -> tuple[str | None, int | None, str | None]:
    for place in candidates(path, roots):
        fs, own = opened(place)
        if fs.get_file_info(own).type == FileType.File:
            return place, *sha256_of(fs, own)
    return None, None, None


def digests(paths: DataFrame, roots: list[str], path: str = "path") -> DataFrame:
    """The column `path` -> that, resolved_path (the first place where there is a file), file_bytes and digest (lower-case
    hex SHA-256), null where there is none. A file that is there but can't be read fails its task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                one = batch.slice(at, 1)
                place, size, digest = _first(one.column(0)[0].as_py(), roots) if one.column(0)[0].is_valid else (None, None, None)
                yield pa.RecordBatch.from_arrays([one.column(0), pa.array([place], pa.string()), pa.array([size], pa.int64()), pa.array([digest], pa.string())], [path, "resolved_path", "file_bytes", "digest"])

    return paths.select(path).mapInArrow(run, f"`{path}` string, {FOUND}")


def located(manifest: DataFrame, roots: list[str], path: str = "storage_path", tasks: int | None = None) -> DataFrame:
    """manifest with resolved_path, file_bytes and digest of its files (see digests). A path that many rows name is read
    once; paths are dealt to as many tasks as given, by default a multiple of the cores."""
    tasks = tasks or TASKS_PER_CORE * manifest.sparkSession.sparkContext.defaultParallelism
    own = manifest.select(F.col(path).alias("__path")).where("__path is not null").distinct().repartition(tasks)
    found = digests(own, roots, "__path")
    return manifest.join(found, F.col(path) == F.col("__path"), "left").drop("__path")
