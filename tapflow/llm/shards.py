"""Deterministic shards: rows in the order of an integer id, cut into ranges of about equal bytes.

The cuts come from exact sums over cells of the id range, refined where a cell holds too much, so they
depend on the rows alone and not on how Spark happens to deal them out.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow
import pyarrow.fs
from pyspark.sql import Column, DataFrame, functions as F

from tapflow.llm import shared


def cuts(rows: DataFrame, shard_bytes: int) -> list[int]:
    """The first ids of all shards but the first, from columns id (long, nulls belong to the first shard) and bytes.

    The driver sees about 16 cells per shard, whatever the number of rows. A single id is never cut.
    """
    low, high, total = rows.agg(F.min("id"), F.max("id"), F.sum("bytes")).first()
    if low is None:
        return []
    bits = max(8, (16 * total // shard_bytes).bit_length())
    shift = max(0, (high - low).bit_length() - bits)
    cells = _sums(rows, shift)
    done: list[tuple[int, int]] = []
    while cells:
        heavy = {c: n for c, n in cells.items() if n > shard_bytes and shift > 0}
        done += [(c << shift, n) for c, n in cells.items() if c not in heavy]
        if not heavy:
            break
        finer = max(0, shift - bits)
        cells = _sums(rows.where(F.expr(f"shiftright(id, {shift})").isin(list(heavy))), finer)
        shift = finer
    found, held = [], 0
    for first, n in sorted(done):
        if held and held + n > shard_bytes:
            found.append(first)
            held = 0
        held += n
    return found


def _sums(rows: DataFrame, shift: int) -> dict[int, int]:
    cells = rows.where("id IS NOT NULL").groupBy(F.expr(f"shiftright(id, {shift})").alias("cell")).agg(F.sum("bytes").alias("n"))
    return {r.cell: r.n for r in cells.collect()}


def shard_of(key: Column, bounds: list[int]) -> Column:
    """Number of the shard of an id."""
    table = np.array(bounds, np.int64)

    @F.pandas_udf("int")
    def numbered(ids: pd.Series) -> pd.Series:
        none = ids.isna()
        at = np.searchsorted(table, ids.where(~none, 0).astype("int64"), "right")
        return pd.Series(np.where(none, 0, at).astype("int32"))

    return numbered(key)


def in_shards(rows: DataFrame, bounds: list[int], *order: str) -> DataFrame:
    """The rows with their `shard`, each shard whole in one task, in the order of shard, id and `order`."""
    shared.ship(rows.sparkSession)
    dealt = rows.withColumn("shard", shard_of(F.col("id"), bounds))
    return dealt.repartition(len(bounds) + 1, "shard").sortWithinPartitions("shard", "id", *order)


@contextmanager
def committed(folder: str, name: str) -> Iterator[pyarrow.NativeFile]:
    """A file to write under a temporary name; it gets its own name when all is written.

    A repeated task writes the same bytes again, under another temporary name.
    """
    system, top = pyarrow.fs.FileSystem.from_uri(folder)
    system.create_dir(top, recursive=True)
    draft, final = f"{top}/_{name}-{uuid.uuid4().hex}", f"{top}/{name}"
    with system.open_output_stream(draft) as out:
        yield out
    if system.get_file_info(final).type != pyarrow.fs.FileType.NotFound and system.type_name != "local":
        system.delete_file(final)
    system.move(draft, final)


def opened(folder: str, name: str) -> pyarrow.NativeFile:
    system, top = pyarrow.fs.FileSystem.from_uri(folder)
    return system.open_input_file(f"{top}/{name}")
