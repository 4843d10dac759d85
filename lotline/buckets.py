"""Tables dealt into folders by a hash of their key, so that a merge rewrites only the folders it touches."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NOTE = "_buckets.json"
#: Folders of a table (of each value of ``by``): a merge's least work is a table's share of one.
BUCKETS = 64


class BucketTable:
    """A Parquet table with a folder for each bucket of its key's hash, within one for each value of ``by`` (columns whose every value has few folders of its own, like a source).

    A merge reads the folders that its rows, or rows of ``also``, are in, and replaces them by Spark's dynamic partition overwrite: new files are staged, and take the folders' places when all tasks are done, so a run that fails before that leaves the table as it was. One writer at a time. The number of buckets and the key are noted beside the data; a table opened with others is refused.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str | None = None, keys: Sequence[str] = (), by: Sequence[str] = (), buckets: int = BUCKETS):
        self.spark, self.path = spark, path.rstrip("/")
        note = self._note()
        if note is None:
            if schema is None or not keys:
                raise FileNotFoundError(f"no table of buckets in {path}")
            note = {"schema": schema, "keys": [*keys], "by": [*by], "buckets": buckets}
            self._write_note(note)
        elif keys and (note["keys"], note["by"]) != ([*keys], [*by]):
            raise ValueError(f"{path} is dealt by {note['by']} and {note['keys']}")
        self.keys, self.by, self.buckets = note["keys"], note["by"], note["buckets"]
        self.schema = T.StructType.fromDDL(note["schema"])

    def _fs(self, name: str = ""):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _note(self) -> dict | None:
        fs, p = self._fs(NOTE)
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _write_note(self, note: dict) -> None:
        fs, p = self._fs(NOTE)
        stream = fs.create(p, False)
        stream.write(bytearray(json.dumps(note, sort_keys=True).encode()))
        stream.close()

    @staticmethod
    def at(spark: SparkSession, path: str) -> bool:
        p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{NOTE}")
        return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _all(self) -> DataFrame:
        fields = [f for f in self.schema.fields if f.name not in self.by]
        schema = T.StructType([*fields, *[f for f in self.schema.fields if f.name in self.by], T.StructField("bucket", T.IntegerType())])
        return self.spark.read.schema(schema).parquet(self.path)

    def read(self) -> DataFrame:
        return self._all().select(*self.schema.names)

    def touched(self, rows: DataFrame) -> list[tuple]:
        """The folders of ``rows``: a list as long as the table has folders at most."""
        return sorted({tuple(r) for r in rows.select(*self.by, self.bucket().alias("bucket")).distinct().collect()}, key=str)

    def of(self, folders: Sequence[tuple]) -> DataFrame:
        """The rows in some folders; the others aren't read."""
        d = self._all()
        if not folders:
            return d.where(F.lit(False)).select(*self.schema.names)
        by: dict[tuple, list[int]] = {}
        for f in folders:
            by.setdefault(f[:-1], []).append(f[-1])
        want = F.lit(False)
        for value, buckets in by.items():
            one = F.col("bucket").isin(buckets)
            for c, v in zip(self.by, value, strict=True):
                one = one & F.col(c).eqNullSafe(F.lit(v))
            want = want | one
        return d.where(want).select(*self.schema.names)

    def merge(self, incoming: DataFrame, how: Callable[[DataFrame, DataFrame], DataFrame], also: Column | None = None) -> list[tuple]:
        """Replaces the folders that ``incoming`` touches by ``how(current rows in them, incoming)``, and returns them. ``also``: rows of the table that the merge may change though ``incoming`` lacks their keys; their folders count as well. ``how`` must not make rows of other folders."""
        folders = self.touched(incoming)
        if also is not None:
            d = self._all().where(also)
            folders = sorted({*folders, *(tuple(r) for r in d.select(*self.by, "bucket").distinct().collect())}, key=str)
        if not folders:
            return []
        out = how(self.of(folders), incoming).select(*self.schema.names).withColumn("bucket", self.bucket())
        seen = Observation()
        out = out.observe(seen, F.collect_set(F.struct(*self.by, "bucket")).alias("folders"))
        # a row group for each folder: a bucket's rows meet in one task, of the table's share of a bucket
        out.repartition(*self.by, "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*self.by, "bucket").parquet(self.path)
        full = {tuple(r) for r in seen.get["folders"]}
        if stray := full - set(folders):
            raise ValueError(f"the merge made rows of other folders: {sorted(stray, key=str)[:5]}")
        for f in set(folders) - full:  # all rows of it are gone
            fs, p = self._fs(self._folder(f))
            fs.delete(p, True)
        return folders

    def _folder(self, f: tuple) -> str:
        escape = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        part = lambda v: "__HIVE_DEFAULT_PARTITION__" if v is None or v == "" else escape(str(v))
        return "/".join(f"{c}={part(v)}" for c, v in zip([*self.by, "bucket"], f, strict=True))
