"""A store of raw artifacts under content addresses.

Each task writes what it fetched, so no bytes are shuffled: first under a temporary name that readers don't see, then
renamed, so that a file is whole or isn't there. Names hold the digest, so a file that is there is the right one and
isn't written again, neither by a task that is repeated nor for equal content; tasks that write the same at once rename
the same bytes into place.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSystem, FileType
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tendril.sources.files import manifest


def _put(fs, path: str, content: bytes) -> bool:
    """Writes content to a path if there is no file; whether it did."""
    if fs.get_file_info(path).type == FileType.File:
        return False
    folder, _, name = path.rpartition("/")
    fs.create_dir(folder, recursive=True)
    temporary = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(temporary, compression=None) as out:
        out.write(content)
    try:
        fs.move(temporary, path)
    except OSError:  # another task was first, on stores whose renames don't replace
        fs.delete_file(temporary)
        if fs.get_file_info(path).type != FileType.File:
            raise
        return False
    return True


def store(fetches: DataFrame, root: str) -> DataFrame:
    """fetches (see files.manifest) -> their manifest with storage_path, below the root (a URI such as file:///data or
    hdfs://host/data), stored_bytes and whether this run wrote the file; without content. The files are written when the
    result is, so write the manifest once and read that."""
    listed = manifest(fetches)
    full = F.concat_ws("/", "storage_folder", "storage_name")
    rows = listed.withColumns({"storage_path": full, "stored_bytes": F.lit(0).cast("bigint"), "was_written": F.lit(False)})
    names = [x for x in rows.columns if x != "content"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = FileSystem.from_uri(root)
        for batch in batches:
            sizes, wrote = [], []
            for path, content in zip(batch.column("storage_path"), batch.column("content"), strict=True):
                data = content.as_buffer() if hasattr(content, "as_buffer") else content.as_py()
                sizes.append(len(data))
                wrote.append(_put(fs, f"{base.rstrip('/')}/{path.as_py()}", data))
            own = {"stored_bytes": pa.array(sizes, pa.int64()), "was_written": pa.array(wrote, pa.bool_())}
            yield pa.RecordBatch.from_arrays([own.get(x, batch.column(x)) for x in names], names)

    return rows.mapInArrow(run, rows.drop("content").schema)
