"""Token ids of documents in files of directly addressable codes.

An id is split into chunks of eight bits. All ids have a chunk in the first level; one whose rest isn't 0 has its
continuation bit set and goes on in the next level, where only those ids have a chunk. A directory holds the
number of continuation bits before every block of 512, so the place of any token in each level is a look-up
and a count within one block: no token before it is decoded.

A file holds the documents of one shard: header, doc_ids, token counts, then for each level its chunks, its bitmap
and its directory. Files get their names when they are complete, and a manifest lists them.
"""

from __future__ import annotations

import itertools
import struct
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tapflow.llm import shards, shared, words as W
from tapflow.llm.subwords import encoder

MAGIC = b"tapflowC"
CHUNK, BLOCK = 8, 512  # bits
SHARD_BYTES = 16 << 20  # of text
PIECE = 1 << 20  # bytes of text that a worker encodes at once
END = 0  # id behind each document
#: magic, documents, tokens, levels
_HEADER = struct.Struct("<8sQQQ")
_FLAG_NULL = np.int8(1)


def coded(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Chunks, bitmap and directory of each level; at least one level."""
    rest, out = ids, []
    while True:
        goes_on = rest > 0xFF
        bits = np.packbits(np.pad(goes_on, (0, -len(goes_on) % BLOCK)), bitorder="little")
        counts = np.bitwise_count(bits.view(np.uint64)).reshape(-1, BLOCK // 64).sum(axis=1)
        directory = np.append(0, np.cumsum(counts)).astype(np.uint64)
        out.append((rest.astype(np.uint8), bits, directory))  # the lowest bits
        if not goes_on.any():
            return out
        rest = rest[goes_on] >> CHUNK


class Level(NamedTuple):
    """Where a level's parts lie in the file."""

    chunks: int
    bits: int
    directory: int
    size: int


class TokenFile:
    """Random access to the ids of a shard."""

    def __init__(self, source: pa.NativeFile):
        self.source = source
        magic, self.n_docs, self.n_tokens, levels = _HEADER.unpack(self._bytes(0, _HEADER.size))
        if magic != MAGIC:
            raise ValueError("not a token file")
        sizes = np.frombuffer(self._bytes(_HEADER.size, 8 * levels), np.uint64).astype(int).tolist()
        at = _HEADER.size + 8 * levels
        self.doc_ids = np.frombuffer(self._bytes(at, 8 * self.n_docs), np.int64)
        at += 8 * self.n_docs
        self.nulls = np.frombuffer(self._bytes(at, self.n_docs), np.int8) == _FLAG_NULL
        at += self.n_docs
        self.counts = np.frombuffer(self._bytes(at, 8 * self.n_docs), np.int64)
        at += 8 * self.n_docs
        self.levels = []
        for size in sizes:
            blocks = -(-size // BLOCK)
            bits, directory = at + size, at + size + blocks * BLOCK // 8
            self.levels.append(Level(at, bits, directory, size))
            at = directory + 8 * (blocks + 1)

    def _bytes(self, at: int, n: int) -> bytes:
        return self.source.read_at(int(n), int(at)) if n else b""

    def _bits(self, level: Level, first: int, last: int) -> tuple[int, np.ndarray]:
        """Continuation bits set before `first`, and the bits first .. last - 1."""
        block = first // BLOCK
        before = int.from_bytes(self._bytes(level.directory + 8 * block, 8), "little")
        begin = block * BLOCK // 8
        packed = np.frombuffer(self._bytes(level.bits + begin, -(-last // 8) - begin), np.uint8)
        flags = np.unpackbits(packed, bitorder="little")[: last - block * BLOCK].astype(bool)
        skip = first - block * BLOCK
        return before + int(np.count_nonzero(flags[:skip])), flags[skip:]

    def slice(self, first: int, last: int) -> np.ndarray:
        """Ids first .. last - 1."""
        out = np.zeros(last - first, np.uint32)
        where, shift = np.arange(last - first), 0
        for level in self.levels:
            if first >= last:
                break
            chunk = np.frombuffer(self._bytes(level.chunks + first, last - first), np.uint8)
            out[where] |= chunk.astype(np.uint32) << np.uint32(shift)
            rank, flags = self._bits(level, first, last)
            where = where[flags]
            first, last, shift = rank, rank + len(where), shift + CHUNK
        return out

    def token(self, index: int) -> int:
        """One id."""
        return int(self.slice(index, index + 1)[0])


def write_shard(out, doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray) -> None:
    levels = coded(ids)
    out.write(_HEADER.pack(MAGIC, len(doc_ids), len(ids), len(levels)))
    out.write(np.array([len(c) for c, _, _ in levels], np.uint64).tobytes())
    out.write(np.array([0 if d is None else d for d in doc_ids], np.int64).tobytes())
    out.write(np.array([d is None for d in doc_ids], np.int8).tobytes())
    out.write(np.asarray(counts, np.int64).tobytes())
    for parts in levels:
        for part in parts:
            out.write(part.tobytes())


def write(docs: DataFrame, folder: str, vocabulary: str, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write the ids of all documents to `folder` in the order of doc_id; returns the manifest.

    One row per file: shard, name, n_docs, n_tokens. Each document ends with id 0. Null texts count as
    empty; null ids come first; repeated ids stand side by side, ordered by text. An empty table gives no file.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), shared.text_of())
    bounds = shards.cuts(rows.select("id", (F.octet_length("text") + 1).alias("bytes")), shard_bytes)

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, group in itertools.groupby(_by_shard(batches), key=lambda x: x[0]):
            own, ids, counts, names = encoder(vocabulary), [], [], []
            kind = np.uint16 if own.size <= 1 << 16 else np.uint32  # a shard's ids are held until its last is known
            for _, batch in group:
                names += batch.column(0).to_pylist()
                for _, piece in W.pieces(W.flat(batch.column(1)), PIECE):
                    found, n = own.texts(piece)
                    ends = np.cumsum(n + 1) - 1
                    full = np.full(len(found) + len(n), END, kind)
                    inside = np.ones(len(full), bool)
                    inside[ends] = False
                    full[inside] = found
                    ids.append(full)
                    counts.append(n + 1)
            name = f"shard-{shard:06d}.dac"
            all_ids = np.concatenate(ids)
            ids.clear()
            shared.hand_back()
            with shards.committed(folder, name) as out:
                write_shard(out, names, np.concatenate(counts), all_ids)
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int32()), "name": [name],
                "n_docs": pa.array([len(names)], pa.int64()), "n_tokens": pa.array([len(all_ids)], pa.int64()),
            })

    files = shared.map_arrow(
        shards.in_shards(rows, bounds, "text"), written,
        shared.struct(shard="int", name="string", n_docs="long", n_tokens="long"),
    )
    files.write.parquet(f"{folder}/manifest")
    return docs.sparkSession.read.parquet(f"{folder}/manifest")


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Batches of id and text, none with rows of two shards."""
    for batch in batches:
        if not batch.num_rows:
            continue
        shard = batch.column(2).to_numpy()
        starts = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]
        for a, b in itertools.pairwise(starts):
            yield int(shard[a]), batch.slice(a, b - a)


def read(spark, folder: str, at_once: int = 1 << 20) -> DataFrame:
    """The documents of the files that the manifest lists: doc_id, start, n_tokens, ids_crc32.

    `start` counts the ids of all documents before. About `at_once` ids are decoded at a time.
    """
    # one small row per file
    listed = sorted(tuple(r) for r in spark.read.parquet(f"{folder}/manifest").select("shard", "name", "n_tokens").collect())
    bases = itertools.accumulate([n for _, _, n in listed], initial=0)
    files = [(name, base) for (_, name, _), base in zip(listed, bases, strict=False)]
    schema = shared.struct(doc_id="long", start="long", n_tokens="long", ids_crc32="long")
    if not files:
        return spark.createDataFrame([], schema)

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with shards.opened(folder, name) as source:
                    yield from _summaries(TokenFile(source), base, at_once)

    given = spark.createDataFrame(files, "name string, base long").repartition(len(files))
    return shared.map_arrow(given, decoded, schema)


def _summaries(file: TokenFile, base: int, at_once: int) -> Iterator[pa.RecordBatch]:
    ends = np.append(0, np.cumsum(file.counts))
    at = 0
    while at < file.n_docs:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + at_once, "right")) - 1)
        ids = file.slice(int(ends[at]), int(ends[to])).astype("<u4")
        local = ends[at : to + 1] - ends[at]
        view = memoryview(ids.tobytes())
        sums = [zlib.crc32(view[4 * a : 4 * b]) for a, b in itertools.pairwise(local.tolist())]
        yield pa.RecordBatch.from_pydict({
            "doc_id": pa.array(file.doc_ids[at:to], pa.int64(), mask=file.nulls[at:to]),
            "start": pa.array(ends[at:to] + base), "n_tokens": pa.array(file.counts[at:to]),
            "ids_crc32": pa.array(sums, pa.int64()),
        })
        at = to
