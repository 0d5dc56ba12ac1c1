"""A data source that writes named Parquet shards in its tasks.

A task gets whole shards, sorted by shard. It writes each to a hidden file of its own, and when all are done
moves them to their names and logs them, in this order: a shard that is logged is there, and a task that is
killed before its moves leaves nothing visible. A task that runs again, or twice at once, writes the same files
under the same names. The driver sees one message a task, with a number, and removes what killed tasks left.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

KEYS = ("split", "shard", "shard_name")


@dataclass
class Written(WriterCommitMessage):
    """Shards that a task wrote."""

    shards: int


def located(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system and path of a folder's URI or local path."""
    return pa.fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def moved(fs: pa.fs.FileSystem, source: str, target: str) -> None:
    """A move that takes the place of what is there, on file systems too whose moves do not."""
    try:
        fs.move(source, target)
    except OSError:
        fs.delete_file(target)
        fs.move(source, target)


class ShardWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.folder, self.progress, self.run = options["path"], options["progress"], options["run"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = located(self.folder)
        aside = posixpath.join(root, "_writing", f"{self.run}-{uuid.uuid4().hex}")
        done: list[dict] = []
        key = writer = None
        for batch in iterator:
            keys = list(zip(*(batch.column(batch.schema.get_field_index(k)).to_pylist() for k in KEYS)))
            edges = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            rows = batch.select([n for n in batch.schema.names if n not in KEYS])
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                if keys[a] != key:
                    if writer:
                        writer.close()
                    key = keys[a]
                    fs.create_dir(aside, recursive=True)
                    writer = pa.parquet.ParquetWriter(f"{aside}/{key[2]}", rows.schema, filesystem=fs)
                    done.append({"split": key[0], "shard_idx": key[1], "shard_name": key[2], "rows": 0})
                writer.write_batch(rows.slice(a, b - a))
                done[-1]["rows"] += b - a
        if not done:
            return Written(0)
        writer.close()
        for d in done:
            d["mb"] = round(fs.get_file_info(f"{aside}/{d['shard_name']}").size / 2**20, 2)
            moved(fs, f"{aside}/{d['shard_name']}", f"{root}/{d['shard_name']}")
        self._log(done)
        fs.delete_dir(aside)
        return Written(len(done))

    def _log(self, done: list[dict]) -> None:
        """One file of log lines a task, put into place whole."""
        fs, root = located(self.progress)
        fs.create_dir(root, recursive=True)
        name, stamp = f"{self.run}-{uuid.uuid4().hex}.json", datetime.now(timezone.utc).isoformat()
        with fs.open_output_stream(f"{root}/.{name}") as out:
            out.write("".join(json.dumps(d | {"ts": stamp, "run": self.run}) + "\n" for d in done).encode())
        moved(fs, f"{root}/.{name}", f"{root}/{name}")

    def _clear(self) -> None:
        fs, root = located(self.folder)
        if fs.get_file_info(f"{root}/_writing").type == pa.fs.FileType.Directory:
            fs.delete_dir(f"{root}/_writing")

    def commit(self, messages: list[Written | None]) -> None:
        self._clear()

    def abort(self, messages: list[Written | None]) -> None:
        self._clear()


class ShardSink(DataSource):
    """format("weft_shards"): options path, progress and run."""

    @classmethod
    def name(cls) -> str:
        return "weft_shards"

    def writer(self, schema: StructType, overwrite: bool) -> ShardWriter:
        return ShardWriter(dict(self.options))
