"""Web pages as WARC archives: sharded deterministically, every record compressed on its own, and read back.

Records are sorted by page_id; cuts between shards follow from the rows alone. A shard's files are rolled when their
compressed size reaches a limit. Headers and digests are made anew from the payloads. Files get their names when
they are complete, and the manifest lists only those: a task that is repeated leaves the same files.
Of pages with equal payloads the one with the largest page_id is a response; the others revisit it.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tapflow.llm import shards, shared

SHARD_BYTES = 32 << 20  # of payload
FILE_BYTES = 8 << 20  # compressed
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_TYPE = "application/http; msgtype=response"


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _uri(url: str | None, page_id: int | None) -> str:
    """The url as one line of ASCII."""
    if not url:
        return _record_id(page_id)
    return "".join(c if 32 < ord(c) < 127 else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass")) for c in url)


def _record_id(page_id: int | None) -> str:
    return f"urn:page:{'none' if page_id is None else page_id}"


def record(page_id: int | None, url: str | None, payload: bytes, response_id: int | None, revisits: bool, date: str = DATE) -> bytes:
    """A record, not compressed. A revisit's block keeps the HTTP header, which tells the payload's length."""
    block = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    )
    if not revisits:
        block += payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisits else 'response'}", f"WARC-Record-ID: <{_record_id(page_id)}>",
        f"WARC-Date: {date}", f"WARC-Target-URI: {_uri(url, page_id)}", f"WARC-Payload-Digest: sha1:{sha1(payload)}",
        f"WARC-Block-Digest: sha1:{sha1(block)}",
    ]
    if revisits:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{_record_id(response_id)}>"]
    head += [f"Content-Type: {_TYPE}", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _info() -> bytes:
    block = b"format: WARC File Format 1.1\r\n"
    head = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:page:info>\r\nWARC-Date: {DATE}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(block)}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


def _gzipped(data: bytes) -> bytes:
    """One gzip member, without a time."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _responses(pages: DataFrame) -> DataFrame:
    """The page_id of the response for every payload that several pages have: digest, response_id."""
    return shared.stored(
        pages.groupBy("digest").agg(F.max("id").alias("response_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    )


def write(
    pages: DataFrame, folder: str, shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES
) -> DataFrame:
    """Write every page as a record to `folder`; returns the manifest: shard, name, records, bytes, sha256.

    Null html counts as empty, and empty payloads are equal like others. Null page_ids come first and count as
    the smallest; repeated rows of the largest page_id are all responses. An empty table gives no file.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    )
    bounds = shards.cuts(rows.select("id", (F.length("payload") + 300).alias("bytes")), shard_bytes)
    # 160 bits of SHA-1 tell payloads apart, as the format itself has it
    rows = rows.withColumn("digest", F.unhex(F.sha1("payload")))
    rows = rows.join(_responses(rows), "digest", "left").select(
        "id", "url", "payload", "response_id",
        F.expr("response_id IS NOT NULL AND NOT (id <=> response_id)").alias("revisits"),
    )

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records = (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        for shard, own in itertools.groupby(records, key=lambda r: r[5]):
            own, number = iter(own), 0
            following = next(own, None)
            while following is not None:
                name, n, size, seen = f"shard-{shard:06d}-{number:04d}.warc.gz", 0, 0, hashlib.sha256()
                with shards.committed(folder, name) as out:
                    data = _gzipped(_info())
                    while following is not None and size < file_bytes:
                        page_id, url, payload, response_id, revisits, _ = following
                        data += _gzipped(record(page_id, url, payload, response_id, revisits))
                        out.write(data)
                        seen.update(data)
                        n, size, data = n + 1, size + len(data), b""
                        following = next(own, None)
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array([shard], pa.int32()), "name": [name], "records": pa.array([n], pa.int64()),
                    "bytes": pa.array([size], pa.int64()), "sha256": [seen.hexdigest()],
                })
                number += 1

    files = shared.map_arrow(
        shards.in_shards(rows, bounds, "url", "payload"), written,
        shared.struct(shard="int", name="string", records="long", bytes="long", sha256="string"),
    )
    files.write.parquet(f"{folder}/manifest")
    return pages.sparkSession.read.parquet(f"{folder}/manifest")


def records_of(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header and block of every record of an archive, one record in memory at a time."""
    waiting = b""
    while True:
        unpacker, parts = zlib.decompressobj(31), []
        while not unpacker.eof:
            waiting = waiting or source.read(1 << 20)
            if not waiting:
                if parts:
                    raise ValueError("archive ends within a record")
                return
            parts.append(unpacker.decompress(waiting))
            waiting = unpacker.unused_data
        data = b"".join(parts)
        end = data.index(b"\r\n\r\n")
        head = dict(line.split(": ", 1) for line in data[:end].decode().split("\r\n")[1:])
        size = int(head["Content-Length"])
        if data[end + 4 + size :] != b"\r\n\r\n":
            raise ValueError("a record's length is wrong")
        yield head, data[end + 4 : end + 4 + size]


def _page(urn: str) -> int | None:
    own = urn.strip("<>").rpartition(":")[2]
    return None if own == "none" else int(own)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The records of the archives that the manifest lists.

    page_id, url, payload_bytes, payload_digest (of the full payload, for revisits too), record_type, refers_to, payload (null
    for revisits). Digests of blocks and payloads are checked; a wrong one is an error.
    """
    # a file name per task; the rows' order plays no part
    listed = spark.read.parquet(f"{folder}/manifest").select("name")
    n = listed.count()

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with shards.opened(folder, name) as source:
                    found: list[tuple] = []
                    for head, block in records_of(source):
                        if head["WARC-Type"] == "warcinfo":
                            continue
                        found.append(_parsed(head, block))
                        if len(found) == 500:
                            yield _rows(found)
                            found = []
                    yield _rows(found)

    schema = shared.struct(
        page_id="long", url="string", payload_bytes="long", payload_digest="string", record_type="string",
        refers_to="long", payload="binary",
    )
    return shared.map_arrow(listed.repartition(max(1, n)), parsed, schema)


def _parsed(head: dict[str, str], block: bytes) -> tuple:
    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
    if head["WARC-Block-Digest"] != f"sha1:{sha1(block)}":
        raise ValueError("a block's digest is wrong")
    end = block.index(b"\r\n\r\n") + 4
    http = dict(line.split(": ", 1) for line in block[: end - 4].decode().split("\r\n")[1:])
    payload = block[end:] if head["WARC-Type"] == "response" else None
    if payload is not None and (sha1(payload) != digest or len(payload) != int(http["Content-Length"])):
        raise ValueError("a payload's digest is wrong")
    refers = head.get("WARC-Refers-To")
    return (
        _page(head["WARC-Record-ID"]), head["WARC-Target-URI"], int(http["Content-Length"]), digest, head["WARC-Type"],
        _page(refers) if refers else None, payload,
    )


def _rows(found: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
    names = ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload")
    columns = zip(*found, strict=True) if found else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=list(names))
