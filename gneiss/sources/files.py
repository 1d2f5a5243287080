"""Files opened inside tasks: any store that pyarrow knows, local and shared mounts included."""

from __future__ import annotations

import uuid
from typing import IO

from pyarrow import fs
from pyspark.sql import DataFrame

from gneiss.session import bounded_batches, settle


def store_of(address: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path in it."""
    if address.startswith("file:"):
        return fs.LocalFileSystem(), "/" + address[5:].lstrip("/")
    return fs.FileSystem.from_uri(address)


def opened(address: str) -> IO[bytes]:
    store, path = store_of(address)
    return store.open_input_file(path)


def put_once(store: fs.FileSystem, path: str, content: bytes) -> bool:
    """Create a file that holds all of its content or is not there; False if it was there before.

    The bytes are written under a name of their own and renamed. Writers of one path bring the same bytes, so which of
    two renames comes last makes no difference, and a task that dies leaves no half file under the path.
    """
    if store.get_file_info(path).type != fs.FileType.NotFound:
        return False
    folder, name = path.rsplit("/", 1)
    store.create_dir(folder, recursive=True)
    own = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(own) as f:
        f.write(content)
    try:
        store.move(own, path)
    except OSError:  # some stores do not rename over a file
        if store.get_file_info(path).type == fs.FileType.NotFound:
            raise
        store.delete_file(own)
        return False
    return True


def store_objects(objects: DataFrame, folder: str, path: str = "path", content: str = "content") -> DataFrame:
    """(path, sha256, size, stored): each object's bytes in a file named by their digest, each distinct content once.

    Tasks write where they read: nothing is shuffled, and a resent object finds its file there. A null content is stored
    nowhere and has nulls. The table that comes back is settled, so that the files are written when this returns.
    """
    import hashlib

    import pyarrow as pa

    bounded_batches(objects.sparkSession)

    def run(batches):
        store, root = store_of(folder)
        for b in batches:
            rows = []
            for name, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if data is None:
                    rows.append((name, None, None, None))
                    continue
                digest = hashlib.sha256(data).hexdigest()
                place = f"{digest[:2]}/{digest}"
                put_once(store, f"{root.rstrip('/')}/{place}", data)
                rows.append((name, digest, len(data), f"{folder.rstrip('/')}/{place}"))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.string()), strict=True)], names=["path", "sha256", "size", "stored"])

    rows = objects.select(objects[path].cast("string").alias("path"), objects[content].cast("binary").alias("content"))
    return settle(rows.mapInArrow(run, "path string, sha256 string, size long, stored string"))
