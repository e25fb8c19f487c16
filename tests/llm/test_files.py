"""Token files and archives: exact round trips, whatever the shards."""

import base64
import gzip
import hashlib
import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tapflow.llm import shards, token_files as T, warc
from tests.llm.helpers import DATA, docs, odd_docs, prose

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def expected(rows):
    plain = Tokenizer.from_file(VOCABULARY)
    plain.encode_special_tokens = True
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode())):
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def key(row):
    return row[1]


def test_token_files_round_trip(spark, tmp_path):
    table = odd_docs(spark).unionByName(docs(spark, [prose(i, 300) for i in range(40)], [10 ** (i // 3) * 7 - i for i in range(40)]))
    rows = [(r.doc_id, r.text) for r in table.collect()]
    for n, size in enumerate((T.SHARD_BYTES, 5000, 1)):
        folder = f"file://{tmp_path}/{n}"
        manifest = T.write(table, folder, VOCABULARY, size)
        assert manifest.agg(F.sum("n_docs")).first()[0] == len(rows)
        assert sorted(map(tuple, T.read(spark, folder, 1000).collect()), key=key) == expected(rows)
    assert manifest.count() > 40


def test_any_token_without_the_others(tmp_path):
    rng = np.random.default_rng(3)
    ids = np.concatenate([rng.integers(0, 300, 3000), rng.integers(0, 2**32, 500), rng.integers(0, 256, 2000)]).astype(np.uint32)
    with pa.OSFile(str(tmp_path / "f"), "wb") as out:
        T.write_shard(out, [1, None], np.array([3000, 2500]), ids)
    with pa.OSFile(str(tmp_path / "f"), "rb") as source:
        file = T.TokenFile(source)
        assert (file.n_docs, file.n_tokens, len(file.levels)) == (2, len(ids), 4)
        for i in rng.integers(0, len(ids), 200):
            assert file.token(i) == ids[i]
        for a, b in ((0, len(ids)), (511, 513), (2999, 3001), (5499, 5500), (7, 7)):
            assert (file.slice(a, b) == ids[a:b]).all()


def test_cuts_depend_on_rows_alone(spark):
    rows = spark.range(1000).selectExpr("CASE WHEN id < 900 THEN id ELSE id * 1000000007 END AS id", "id % 50 + 1 AS bytes")
    found = shards.cuts(rows, 500)
    assert found == shards.cuts(rows.repartition(7), 500) and len(found) > 20
    sizes: dict[int, int] = {}
    for r in rows.withColumn("s", shards.shard_of(F.col("id"), found)).collect():
        sizes[r.s] = sizes.get(r.s, 0) + r.bytes
    assert max(sizes.values()) <= 500 and sorted(sizes) == list(range(len(found) + 1))
    assert shards.cuts(rows.limit(0), 10) == []
    assert shards.cuts(spark.createDataFrame([(None, 5), (-(2**63), 9), (2**63 - 1, 9)], "id long, bytes long"), 10) != []


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")


def test_archives_round_trip(spark, tmp_path):
    rnd = random.Random(2)
    rows = [(i * 37, f"http://a.example/{i}?é {i}\r\nX: y", rnd.choice(["", None, "same", prose(i, 50), "<é>\r\n\r\nWARC/1.1"])) for i in range(300)]
    rows += [(None, None, "same"), (None, None, "alone"), (37, "u", "same"), (37, "u", "same"), (10**15, "twice", "t"), (10**15, "twice", "t")]
    table = pages(spark, rows)
    for n, (shard, file) in enumerate(((warc.SHARD_BYTES, warc.FILE_BYTES), (4000, 1500))):
        folder = f"file://{tmp_path}/{n}"
        manifest = warc.write(table, folder, shard, file).collect()
        found = warc.read(spark, folder).collect()
        assert len(found) == len(rows) == sum(m.records for m in manifest)
        last: dict[str, int] = {}
        for i, _, html in rows:
            last[html or ""] = max(last.get(html or "", -1), -1 if i is None else i)
        by_id: dict = {}
        for i, _, html in rows:
            by_id.setdefault(i, []).append(html or "")
        for r in found:
            html = next(h for h in by_id[r.page_id] if base64.b32encode(hashlib.sha1(h.encode()).digest()).decode() == r.payload_digest)
            assert r.payload_bytes == len(html.encode())
            response = last[html] == (-1 if r.page_id is None else r.page_id)
            assert r.record_type == ("response" if response else "revisit")
            assert r.refers_to == (None if response else last[html])
            assert (bytes(r.payload) == html.encode()) if response else r.payload is None
        for m in manifest:
            data = (tmp_path / str(n) / m.name).read_bytes()
            assert hashlib.sha256(data).hexdigest() == m.sha256 and len(data) == m.bytes
            assert gzip.decompress(data).count(b"WARC-Record-ID") >= m.records + 1
    again = warc.write(table.repartition(5), f"file://{tmp_path}/again", 4000, 1500).collect()
    assert {tuple(m) for m in again} == {tuple(m) for m in manifest} and len(again) > 10
    assert not [p for p in (tmp_path / "1").iterdir() if p.name.startswith("_")]


def test_no_pages(spark, tmp_path):
    folder = f"file://{tmp_path}/none"
    assert warc.write(pages(spark, []), folder).count() == 0
    assert warc.read(spark, folder).count() == 0
    assert T.write(odd_docs(spark).limit(0), f"{folder}-t", VOCABULARY).count() == 0
    assert T.read(spark, f"{folder}-t").count() == 0


def test_a_damaged_archive_is_an_error(spark, tmp_path):
    record = warc.record(1, "http://a", b"payload", 1, False)
    good = gzip.compress(record)
    bad = gzip.compress(record.replace(b"payload\r\n", b"paYload\r\n"))
    assert warc._parsed(*next(warc.records_of(pa.BufferReader(good))))[:4] == (1, "http://a", 7, warc.sha1(b"payload"))
    for data in (bad, good[:-12]):
        try:
            [warc._parsed(*r) for r in warc.records_of(pa.BufferReader(data))]
        except ValueError:
            continue
        raise AssertionError("not noticed")
    assert spark.read.parquet(f"{DATA}/pages.parquet").columns == ["page_id", "url", "html"]


def test_the_tokenizer_is_given_little_at_once(monkeypatch):
    from tapflow.llm import subwords

    monkeypatch.setattr(subwords, "AT_ONCE", 200)
    own, given = subwords.Encoder(VOCABULARY), []
    ids_of = own._ids
    monkeypatch.setattr(own, "_ids", lambda text: given.append(len(text)) or ids_of(text))
    texts = ["", "one\ntwo\n\nthree " + "x" * 300 + " É. a,b", prose(1, 500), "\n".join(prose(i, 3) for i in range(50))]
    found, counts = own.texts(subwords.W.flat(pa.array(texts, pa.string())))
    plain = Tokenizer.from_file(VOCABULARY)
    assert [x.tolist() for x in np.split(found, np.cumsum(counts)[:-1])] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(given) > 10 and sum(n > 400 for n in given) == 0


def test_coding_a_shard_holds_few_bytes_per_id():
    ids = np.random.default_rng(3).integers(0, 50257, 1 << 20).astype(np.uint16)
    tracemalloc.start()
    levels = T.coded(ids)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(levels) == 2 and peak < 8 * len(ids)
    for wide in (np.int32, np.uint32, np.int64):
        for (a, b, c), (x, y, z) in zip(levels, T.coded(ids.astype(wide)), strict=True):
            assert (a.tobytes(), b.tobytes(), c.tobytes()) == (x.tobytes(), y.tobytes(), z.tobytes())


def test_a_task_hands_its_memory_back(monkeypatch):
    from tapflow.llm import shared

    class Rows:
        sparkSession = None

        def mapInArrow(self, step, schema):
            return step

    said = []
    monkeypatch.setattr(shared, "ship", lambda spark: None)
    monkeypatch.setattr(shared, "hand_back", lambda: said.append("back"))
    steps = shared.map_arrow(Rows(), lambda batches: (said.append(b) or b for b in batches), None)
    assert list(steps(iter([1, 2]))) == [1, 2] and said == [1, 2, "back"]
    monkeypatch.undo()
    shared.hand_back()
