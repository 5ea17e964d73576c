"""Tar shards as a data source: a row per regular member, read member by member, with tests of names before any bytes are read.

The tests are options: a reader that takes pushed filters keeps them for later queries on the same frame in this version."""

from __future__ import annotations

import fnmatch
import tarfile
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from veilwork.sources.storage import opened


class Shard(InputPartition):
    def __init__(self, path: str):
        self.path = path


class TarReader(DataSourceReader):
    """One partition per shard; members are streamed, so a shard of any size needs the memory of one member."""

    def __init__(self, options: dict):
        self.root, self.glob = options["path"], options.get("pattern", "shard-*.tar")
        self.payload = str(options.get("payload", "true")).lower() == "true"
        self.prefix, self.suffix = options.get("prefix", ""), options.get("suffix", "")

    def partitions(self):
        files, root = opened(self.root)
        inside = files.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        found = sorted(x.path for x in inside if x.type == fs.FileType.File and fnmatch.fnmatch(x.base_name, self.glob))
        if not found:
            raise FileNotFoundError(f"no {self.glob} under {self.root}")
        return [Shard(x) for x in found]

    def read(self, partition: Shard) -> Iterator[tuple]:
        files, _ = opened(self.root)
        with files.open_input_stream(partition.path, compression=None) as raw, tarfile.open(fileobj=raw, mode="r|*") as tar:
            for k, member in enumerate(tar):
                if member.isfile() and member.name.startswith(self.prefix) and member.name.endswith(self.suffix):
                    yield partition.path, k, member.name, member.size, tar.extractfile(member).read() if self.payload else None


class TarShards(DataSource):
    """spark.read.format("tar_shards").option("suffix", ".json").load(folder): shard, ordinal, member, size, content."""

    @classmethod
    def name(cls):
        return "tar_shards"

    def schema(self):
        return "shard string, ordinal long, member string, size long, content binary"

    def reader(self, schema):
        return TarReader(self.options)
