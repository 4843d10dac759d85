"""A release written by tasks: ``df.write.format("csv_release")`` after ``register(spark)``; see ``operators.export.release_parts``.

Each task writes CSV parts of its rows into a staging folder beside the target and reports their digests and row counts. The commit writes the headers and the manifest, removes what failed or repeated attempts have left, and renames the folder: a release is there whole or not at all. No row reaches the driver.
"""

from __future__ import annotations

import csv
import hashlib
import io
import json
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import Row, StructType

MANIFEST = "manifest.json"


def place(uri: str) -> tuple[pafs.FileSystem, str]:
    """A folder in any store that Arrow opens; a plain path or file: is local, and has to be shared by all executors."""
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def exists(fs: pafs.FileSystem, path: str) -> bool:
    return fs.get_file_info(path).type != pafs.FileType.NotFound


@dataclass
class Part:
    file: str
    name: str
    rows: int = 0
    bytes: int = 0
    sha256: str = ""


@dataclass
class Parts(WriterCommitMessage):
    parts: list[Part] = field(default_factory=list)


class Digested:
    """A part being written: what goes into it is counted and hashed on the way."""

    def __init__(self, fs: pafs.FileSystem, path: str, file: str, name: str):
        self.part, self.sha = Part(file, name), hashlib.sha256()
        fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.out = fs.open_output_stream(path)

    def write(self, lines: str, rows: int) -> None:
        data = lines.encode()
        self.sha.update(data)
        self.out.write(data)
        self.part.rows += rows
        self.part.bytes += len(data)

    def close(self) -> Part:
        self.out.close()
        self.part.sha256 = self.sha.hexdigest()
        return self.part


def lines(rows: list) -> str:
    out = io.StringIO()
    csv.writer(out).writerows(rows)
    return out.getvalue()


class ReleaseWriter(DataSourceWriter):
    """Rows of (file, fields): those of a task are in order, so a file's parts in order of their names are the file."""

    def __init__(self, options: dict[str, str]):
        self.target = options["path"].rstrip("/")
        self.staging = options["staging"]
        self.headers: dict[str, list[str]] = json.loads(options["headers"])
        self.extra: dict = json.loads(options["manifest"])

    def write(self, iterator: Iterator[Row]) -> Parts:
        task = TaskContext.get()
        name = f"{task.partitionId() + 1:06}-{task.taskAttemptId()}.csv"
        fs, root = place(self.staging)
        done: list[Part] = []
        out, file, block = None, None, []
        for row in iterator:
            if row[0] != file or len(block) >= 10_000:
                if block:
                    out.write(lines(block), len(block))
                block = []
                if row[0] != file:
                    if out:
                        done.append(out.close())
                    file = row[0]
                    out = Digested(fs, f"{root}/{file}/{name}", file, name)
            block.append(row[1])
        if out:
            if block:
                out.write(lines(block), len(block))
            done.append(out.close())
        return Parts(done)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, root = place(self.staging)
        parts: dict[str, list[Part]] = {f: [] for f in self.headers}
        for m in messages:
            for p in m.parts if m else []:
                parts[p.file].append(p)
        files = {}
        for f, header in self.headers.items():
            head = Digested(fs, f"{root}/{f}/000000.csv", f, "000000.csv")
            head.write(lines([header]), 0)
            own = [head.close(), *sorted(parts[f], key=lambda p: p.name)]
            kept = {p.name for p in own}
            for x in fs.get_file_info(pafs.FileSelector(f"{root}/{f}")):  # attempts that came to nothing
                if x.base_name not in kept:
                    fs.delete_file(x.path)
            files[f] = {"rows": sum(p.rows for p in own), "parts": [{"name": p.name, "rows": p.rows, "bytes": p.bytes, "sha256": p.sha256} for p in own]}
        with fs.open_output_stream(f"{root}/{MANIFEST}") as out:
            out.write(json.dumps(self.extra | {"files": files}, indent=2, sort_keys=True).encode())
        _, target = place(self.target)
        if exists(fs, target):
            if fs.get_file_info(pafs.FileSelector(target)):
                self.abort([])
                raise FileExistsError(f"{self.target} is not empty")
            fs.delete_dir(target)
        fs.move(root, target)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, root = place(self.staging)
        if exists(fs, root):
            fs.delete_dir(root)


class CsvRelease(DataSource):
    @classmethod
    def name(cls) -> str:
        return "csv_release"

    def writer(self, schema: StructType, overwrite: bool) -> ReleaseWriter:
        return ReleaseWriter({k.lower(): v for k, v in self.options.items()})


def register(spark: SparkSession) -> None:
    spark.dataSource.register(CsvRelease)
