"""Files that tasks themselves read or write in the shared folder, on any store that Arrow can open."""

from __future__ import annotations

import uuid

import pyarrow.fs as pafs
import pyarrow.parquet as pq


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path within it."""
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


def write_file(uri: str, parts) -> None:
    """Write all parts under another name and then rename: a repeated task replaces whole files only."""
    store, path = opened(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    draft = f"{path}.{uuid.uuid4().hex}"
    with store.open_output_stream(draft) as out:
        for part in parts:
            out.write(part)
    try:
        store.move(draft, path)
    except OSError:
        # Some stores do not rename onto a file. What is there is whole, and another attempt's same content.
        if store.get_file_info(path).type == pafs.FileType.NotFound:
            raise
        store.delete_file(draft)


def read_unit(uri: str, unit: int):
    """The rows of one unit of a table written with ``partitionBy("unit")``, or None."""
    store, path = opened(f"{uri}/unit={unit}")
    if store.get_file_info(path).type == pafs.FileType.NotFound:
        return None
    return pq.read_table(path, filesystem=store, partitioning=None)
