"""Files by path or URI (local, hdfs://, s3://, s3a://, gs://), for the data sources and the sinks of one file."""

from __future__ import annotations

import uuid

from pyarrow import fs


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri("s3" + path[3:] if path.startswith("s3a://") else path)


def write_whole(files: fs.FileSystem, to: str, data: bytes) -> None:
    """A reader sees the whole file or none: object stores publish on close, elsewhere a finished file is renamed."""
    if folder := to.rpartition("/")[0]:
        files.create_dir(folder, recursive=True)
    rename = files.type_name in ("local", "hdfs")
    part = f"{to}.{uuid.uuid4().hex}.part" if rename else to  # a name of each attempt's own
    with files.open_output_stream(part, compression=None) as out:
        out.write(data)
    if rename:
        files.move(part, to)
