"""The folder that the driver and all executors share, and tables written there to cut lineage."""

from __future__ import annotations

import ctypes
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T


def shared_folder(spark: SparkSession) -> str:
    """A new folder name below the session's checkpoint folder (`spark.checkpoint.dir`), qualified by Hadoop.

    A folder without a scheme means the cluster's default file system, as Spark itself reads it. Where nothing is set,
    a local run (tests) gets a local temporary folder; any other master has to name a folder all executors share.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="tapflow-shared-")
        context.setCheckpointDir(folder)
    path = f"{context.getCheckpointDir().rstrip('/')}/llm-{uuid.uuid4()}"
    for paths in getattr(_recording, "lists", []):
        paths.append(path)
    return path


#: Lists of folders being recorded, per thread: queries run side by side in one driver don't see each other's.
_recording = threading.local()


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The folders that this thread names inside, in a list."""
    paths: list[str] = []
    if not hasattr(_recording, "lists"):
        _recording.lists = []
    _recording.lists.append(paths)
    try:
        yield paths
    finally:
        _recording.lists = [x for x in _recording.lists if x is not paths]


def stored(df: DataFrame) -> DataFrame:
    """`df` written as a table into the shared folder and read back: a lost executor repeats one step only."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Remove folders that this library has written and that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text as a string; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit("")).alias("text")


def struct(**fields: str) -> T.StructType:
    """A schema from names and simple type strings."""
    return T._parse_datatype_string(", ".join(f"`{k}` {v}" for k, v in fields.items()))


def with_fields(schema: T.StructType, **fields: str) -> T.StructType:
    return T.StructType([*schema.fields, *struct(**fields).fields])


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    top = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="tapflow-package-")) / f"{top.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(top.rglob("*.py")):
            out.write(file, file.relative_to(top.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(application)


def map_arrow(
    df: DataFrame, step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType
) -> DataFrame:
    """`mapInArrow` with this package at hand on the executors, whose workers keep no freed memory from task to task."""
    ship(df.sparkSession)

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from step(batches)
        finally:
            hand_back()

    return df.mapInArrow(steps, schema)


def hand_back() -> None:
    """Give memory that Arrow and the C library have freed, but keep for later, back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim is not None:
        trim(0)
