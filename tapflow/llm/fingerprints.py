"""Document fingerprints by SpotSigs: chains of content words that follow common words.

Each common word of a text (an anchor) with the next two words that aren't common is a signature; where common
words are far off, every word is an anchor. A text without any such chain has one signature of all its words. A text's
fingerprint is the set of its signatures, as sorted 32-bit hashes. Likeness is the Jaccard similarity of two sets. A text
is compared with its edited text and with the next one only; there is no join over all pairs, and length classes are written
out for one.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tapflow.llm import shards, shared, words as W

#: Common words of English, German, French and Spanish.
ANCHORS = """
a an and are as at be but by can for from had has have he her his in is it its not of on or she that the their they this to
was we were which will with you
aber als auch auf aus bei das dem den der des die ein eine einer er es für ich im ist mit nach nicht sich sie sind und von
war wie wird zu zum zur
au aux avec ce ces dans de des du elle en est et il ils je la le les leur mais ne nous ou par pas plus pour qui que sa se ses
son sont sur un une vous
al con como del el ella en es esta este las lo los más me mi muy no o para pero por que se si sin su sus también un una y ya
""".split()  # fixed values
CHAIN = 2  # content words behind an anchor
#: A word is an anchor too if no common word is among so many words before it, as in tables and lists.
GAP = 8
SHARD_BYTES = 8 << 20
AT_ONCE = 2 << 20  # bytes of text whose fingerprints are made together
SIMILARITY = 0.8
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _anchor_hashes() -> np.ndarray:
    flat = W.flat(pa.array(sorted(set(ANCHORS))))
    return np.sort(W.hashes(flat.data, flat.offsets[:-1], flat.offsets[1:])[0])


_COMMON = _anchor_hashes()


def signatures(texts: W.Flat) -> list[np.ndarray]:
    """The sorted set of signatures of each text."""
    folded = W.LOWER[texts.data]
    words = W.words_of(W.Flat(folded, texts.offsets), W.ALNUM)
    hashed, first = W.hashes(folded, words.starts, words.ends)[0], words.first
    n = len(first) - 1
    owner = np.repeat(np.arange(n), np.diff(first))
    place = np.minimum(np.searchsorted(_COMMON, hashed), len(_COMMON) - 1)
    common = _COMMON[place] == hashed
    at = np.arange(len(hashed))
    last = np.maximum.accumulate(np.where(common, at, -1))  # common word at or before
    spots = np.flatnonzero(common | (last < first[owner]) | (at - last > GAP))
    content = np.flatnonzero(~common)
    found, of = _chains(hashed, owner, spots, content, np.searchsorted(content, spots, "right"), CHAIN)
    short = np.flatnonzero((np.diff(first) > 0) & (np.bincount(of, minlength=n) == 0))
    whole = np.array([hashed[first[i] : first[i + 1]].sum(dtype=np.uint64) for i in short], np.uint64)
    values = (np.concatenate([found, W.mixed(whole)]) >> np.uint64(32)).astype(np.uint64)
    owners = np.concatenate([of, short]).astype(np.uint64)
    keys = np.unique((owners << np.uint64(32)) | values)
    ends = np.searchsorted(keys, np.arange(1, n, dtype=np.uint64) << np.uint64(32))
    return np.split((keys & np.uint64(0xFFFFFFFF)).astype("<u4"), ends) if n else []


def _chains(hashed, owner, spots, content, behind, chain):
    """Hashes of the spots' words with the `chain` content words behind them, and whose they are; only whole chains."""
    fits = behind + chain <= len(content)
    spots, behind = spots[fits], behind[fits]
    fits = owner[content[behind + chain - 1]] == owner[spots] if len(spots) else np.zeros(0, bool)
    spots, behind = spots[fits], behind[fits]
    h = W.mixed(hashed[spots])
    for j in range(chain):
        h = W.mixed(h * _ODD + hashed[content[behind + j]])
    return h, owner[spots]


def printed(signs: np.ndarray) -> str:
    return base64.b64encode(signs.tobytes()).decode()


def likeness(a: np.ndarray, b: np.ndarray, at_least: float = 0.0) -> float:
    """Jaccard similarity of two sorted sets; 0 without counting if their lengths rule `at_least` out; two empty sets: 1."""
    small, large = sorted((len(a), len(b)))
    if not large:
        return 1.0
    if small < at_least * large or not small:
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (small + large - both)


def length_class(n: int, at_least: float = SIMILARITY) -> int:
    """Class of a set's length: sets that are `at_least` alike are in the same class or in neighbouring ones."""
    return 0 if n <= 0 else 1 + int(math.log(n) / -math.log(at_least) + 1e-9)


def _edited(text: str, following: str) -> str:
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


_FIELDS = {
    "doc_id": "long", "n_chars": "long", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string",
    "near_edited": "double", "near_next": "double", "length_class": "int",
}


def _rows(ids: list[int | None], texts: list[str]) -> pa.RecordBatch:
    """Of all but the last document, which follows the last but one."""
    edited = [_edited(a, b) for a, b in itertools.pairwise(texts)]
    own = signatures(W.flat(pa.array(texts, pa.large_string())))
    other = signatures(W.flat(pa.array(edited, pa.large_string())))
    return pa.RecordBatch.from_pydict({
        "doc_id": pa.array(ids[:-1], pa.int64()),
        "n_chars": pa.array([len(t) for t in texts[:-1]], pa.int64()),
        "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in edited],
        "fingerprint": [printed(s) for s in own[:-1]], "edited_fingerprint": [printed(s) for s in other],
        "near_edited": pa.array([likeness(a, b) for a, b in zip(own[:-1], other, strict=True)], pa.float64()),
        "near_next": pa.array([likeness(a, b) for a, b in itertools.pairwise(own)], pa.float64()),
        "length_class": pa.array([length_class(len(s)) for s in own[:-1]], pa.int32()),
    })


def edited_and_next(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Fingerprints of every text and of its edited text, and the likeness to that and to the next document.

    The edited text ends in the beginning of the next document: its last quarter gives way to as many
    characters of the next by doc_id (the first follows the last). Null texts count as empty; null ids
    come first; repeated ids stand in the order of their texts. A document alone is followed by itself.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), shared.text_of())
    bounds = shards.cuts(rows.select("id", (F.octet_length("text") + 50).alias("bytes")), shard_bytes)
    shared.ship(rows.sparkSession)
    dealt = rows.withColumn("shard", shards.shard_of(F.col("id"), bounds))
    order = F.struct(F.col("id").isNotNull().alias("known"), "id", "text")
    heads = shared.stored(dealt.groupBy("shard").agg(F.min(order).alias("first")))
    present = sorted(r.shard for r in heads.select("shard").collect())  # one number for each shard
    before = {s: present[i - 1] for i, s in enumerate(present)}
    tails = heads.select(
        "first.id", "first.text",
        F.element_at(F.create_map(*[F.lit(x) for pair in before.items() for x in pair]), F.col("shard")).alias("shard"),
    ) if present else heads.select("first.id", "first.text", "shard")
    both = dealt.withColumn("tail", F.lit(False)).unionByName(tails.withColumn("tail", F.lit(True)))
    sorted_ = both.repartition(len(bounds) + 1, "shard").sortWithinPartitions("shard", "tail", "id", "text")

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int | None] = []
        texts: list[str] = []
        size = 0
        for batch in batches:
            for id_, text, tail in zip(*(batch.column(c).to_pylist() for c in ("id", "text", "tail")), strict=True):
                ids.append(id_)
                texts.append(text)
                size += len(text)
                if tail or (size > AT_ONCE and len(ids) > 1):
                    yield _rows(ids, texts)
                    ids, texts, size = ([], [], 0) if tail else (ids[-1:], texts[-1:], len(text))

    return shared.map_arrow(sorted_.select("id", "text", "tail", "shard"), made, shared.struct(**_FIELDS))
