"""A sink of one file per row: df of (path, data) written with format("image_files").save(folder or URI)."""

from __future__ import annotations

import posixpath
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from veilwork.sources.storage import opened, write_whole


class FileWriter(DataSourceWriter):
    def __init__(self, options: dict):
        self.root = options["path"]

    def write(self, rows: Iterator) -> WriterCommitMessage:
        files, root = opened(self.root)
        root = posixpath.normpath(root)
        for row in rows:
            to = posixpath.normpath(posixpath.join(root, row["path"].lstrip("/")))
            if not to.startswith(root + "/"):
                raise ValueError(f"outside the folder: {row['path']}")
            write_whole(files, to, bytes(row["data"]))  # a retried task writes the same files again
        return WriterCommitMessage()


class ImageFiles(DataSource):
    @classmethod
    def name(cls):
        return "image_files"

    def writer(self, schema, overwrite):
        return FileWriter(self.options)
