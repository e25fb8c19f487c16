"""Checks made before a side of a join is broadcast, and before lineage is cut."""

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

# Rows of a dictionary-like table (a few hundred bytes each) that every executor can hold.
BROADCAST_ROWS = 500_000


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether `df` has at most `max_rows` rows, by a count that combines in the tasks."""
    return df.count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df` with a broadcast hint if it is counted as small, else `df` itself.

    Without the hint the join shuffles on its keys and adaptive execution splits skewed keys.
    """
    return F.broadcast(df) if is_small(df, max_rows) else df


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` as a table into the checkpoint folder of the cluster and read it from there.

    A table rather than `checkpoint()`, which stores whole rows: readers of a few columns skip the
    rest, and the planner knows the size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the cluster's checkpoint folder, which every executor and the driver can reach."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="tapflow-checkpoint-")
        context.setCheckpointDir(folder)
    path = f"{context.getCheckpointDir()}/{name}-{uuid.uuid4()}"
    for owned in getattr(_scopes, "stack", []):
        owned.append(path)
    return path


#: Per thread, the lists of scratch paths that open scopes own: jobs side by side in one driver don't see each other's.
_scopes = threading.local()


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Scratch tables named inside (`cut_lineage`, `scratch_path`) belong to the block and are removed when it ends,
    also when it fails. Only what this thread named is removed."""
    owned: list[str] = []
    if not hasattr(_scopes, "stack"):
        _scopes.stack = []
    _scopes.stack.append(owned)
    try:
        yield owned
    finally:
        _scopes.stack = [x for x in _scopes.stack if x is not owned]
        jvm = spark.sparkContext._jvm
        for path in owned:
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
