"""Sessions and the folder that all executors share."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid
import zipfile

from pyspark import SparkContext
from pyspark.sql import SparkSession


def build(name: str = "lotline", **conf: str) -> SparkSession:
    """A session with what the library counts on: UTC, adaptive plans, ANSI casts. Sizes are the cluster's business."""
    b = SparkSession.builder.appName(name)
    for k, v in {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.ansi.enabled": "true", **conf}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only a local session may lack it."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="lotline-")
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


#: Folders of this process that go when it ends.
_scratch: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's path in the shared folder, removed when the process ends: results that are read lazily may rest on it until then."""
    if not _scratch:
        atexit.unregister(_drop_scratch)
        atexit.register(_drop_scratch)
    _scratch.append(f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")
    return _scratch[-1]


def drop_scratch(spark: SparkSession) -> None:
    """Removes the scratch folders of this process; results that rest on them can't be read after that."""
    while _scratch:
        p = spark._jvm.org.apache.hadoop.fs.Path(_scratch.pop())
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _drop_scratch() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and SparkContext._active_spark_context is not None:
        with contextlib.suppress(Exception):  # the JVM may be gone
            drop_scratch(spark)


#: Bytes of an Arrow batch: documents are long, and each task holds a batch or two on both sides of the pipe to Python.
ARROW_BYTES = "8m"
#: Rows that the Parquet reader holds at a time: a column of 4096 documents is an array of 16 MB or more, for which the collector grows the heap.
READER_ROWS = "512"


def prepare(spark: SparkSession) -> None:
    """Makes a session ready for the operators that run Python: executors get this package (which a cluster may have installed anyway), and batches of documents a bound (bytes for Arrow, rows for Parquet), unless the session has one of its own."""
    own = {k for k, _ in spark.sparkContext.getConf().getAll()}
    for key, value in {"spark.sql.execution.arrow.maxBytesPerBatch": ARROW_BYTES, "spark.sql.parquet.columnarReaderBatchSize": READER_ROWS}.items():
        if key not in own:
            spark.conf.set(key, value)
    sc = spark.sparkContext
    if getattr(sc, "_lotline_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="lotline-"), "lotline.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    path = os.path.join(folder, n)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(archive)
    sc._lotline_shipped = True
