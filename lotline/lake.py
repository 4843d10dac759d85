"""A folder of Parquet tables that commands read and replace."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotline.buckets import BucketTable

LIST = "tables.json"


class Lake:
    """Tables by name under one folder, in any store that Spark reads. ``tables.json`` says which folder holds a table now; a folder of a table's name counts where it says nothing.

    A replacement writes new folders and then the list, by one rename, so that all tables of a call change at once and a reader finds either the old ones or the new. The folders that the list no longer names are removed with the next replacement of their table, when readers of the old list are done. A table that another writer has replaced since it was read here is not replaced: the change would be lost.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._seen: dict[str, str] = {}

    def _fs(self, path: str):
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(conf), p

    def _list(self) -> dict[str, str]:
        fs, p = self._fs(f"{self.root}/{LIST}")
        if not fs.exists(p):
            return {}
        stream = fs.open(p)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _write_list(self, names: dict[str, str]) -> None:
        fs, p = self._fs(f"{self.root}/{LIST}")
        _, new = self._fs(f"{self.root}/{LIST}.{uuid.uuid4().hex}")
        stream = fs.create(new, True)
        stream.write(bytearray(json.dumps(names, sort_keys=True).encode()))
        stream.close()
        jvm = self.spark._jvm
        kind = jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(kind, 1)
        options[0] = kind.OVERWRITE
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri() if p.toUri().getScheme() else fs.getUri(), self.spark._jsc.hadoopConfiguration()).rename(fs.makeQualified(new), fs.makeQualified(p), options)

    def _at(self, name: str) -> str | None:
        at = self._seen[name] = self._list().get(name, name)
        fs, p = self._fs(f"{self.root}/{at}")
        return f"{self.root}/{at}" if fs.exists(p) else None

    def has(self, name: str) -> bool:
        return self._at(name) is not None

    def read(self, name: str, schema: str | None = None) -> DataFrame:
        """The table; empty, with ``schema``, if there is none yet."""
        at = self._at(name)
        if at is None:
            if schema is None:
                raise FileNotFoundError(f"no table {name} in {self.root}")
            return self.spark.createDataFrame([], schema)
        return BucketTable(self.spark, at).read() if BucketTable.at(self.spark, at) else self.spark.read.parquet(at)

    def buckets(self, name: str, schema: str, keys: Sequence[str], by: Sequence[str] = (), n: int = 64) -> BucketTable:
        """A table whose merges rewrite only what they touch; it stays under its own name. A table that was replaced as a whole before is dealt into buckets once."""
        table = BucketTable(self.spark, f"{self.root}/{name}", schema, keys, by, n)
        was = self._list()
        if name in was:
            old = self.spark.read.parquet(f"{self.root}/{was[name]}")
            missing = [f for f in table.schema.fields if f.name not in old.columns]
            table.merge(old.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing]), lambda _, rows: rows)
            self._write_list({k: v for k, v in was.items() if k not in (name, f"{name} before")})
            self._seen.pop(name, None)
        return table

    def replace(self, name: str, df: DataFrame) -> DataFrame:
        self.replace_all({name: df})
        return self.read(name)

    def replace_all(self, tables: dict[str, DataFrame]) -> None:
        """All are written before the list changes, so each may be made from the old state of any."""
        run = uuid.uuid4().hex
        for name, df in tables.items():
            df.write.parquet(f"{self.root}/{name}-{run}")
        was = self._list()
        if lost := [n for n in tables if n in self._seen and was.get(n, n) != self._seen[n]]:
            for name in tables:
                fs, p = self._fs(f"{self.root}/{name}-{run}")
                fs.delete(p, True)
            raise RuntimeError(f"another writer replaced {', '.join(lost)}; read again")
        self._seen |= {name: f"{name}-{run}" for name in tables}
        self._write_list(was | {name: f"{name}-{run}" for name in tables} | {f"{name} before": was.get(name, name) for name in tables})
        for name in tables:
            if old := was.get(f"{name} before"):
                fs, p = self._fs(f"{self.root}/{old}")
                fs.delete(p, True)

    def append(self, name: str, df: DataFrame) -> None:
        at = self._at(name)
        if at is None:
            self.replace(name, df)
        else:
            df.write.mode("append").parquet(at)
