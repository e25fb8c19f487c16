"""Benchmark decontamination: test passages searched in suffix arrays of the training documents.

Each task takes its documents in shards of a few megabytes and sorts the suffixes of a shard (one per
word) as deep as the longest test item has words. Every suffix of every test item is then narrowed
down word by word by binary search: how far it gets is its longest verbatim match, the range of the
suffix array holds the places. Words that no test item has end a suffix like the end of a document.
Test items are read in blocks from a table in the shared folder, so neither side has to fit in memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import DataFrame, functions as F

from tapflow.llm import shared, words as W

WINDOW = 13  # words of a passage
SHARD_BYTES = 4 << 20
BLOCK_ITEMS = 20_000  # test items searched at once


class Items(NamedTuple):
    """A block of test items: distinct words, word numbers (0 ends an item) and one row per word."""

    vocabulary: np.ndarray
    ids: np.ndarray
    starts: np.ndarray
    item: np.ndarray  # of each word
    window: np.ndarray  # words of the window that begins here, 0 if none does
    names: list[str]


class Found(NamedTuple):
    """Matches of a block's suffixes in a shard."""

    place: np.ndarray  # suffix array
    low: np.ndarray  # windows that occur: range in the suffix array, words, item
    high: np.ndarray
    size: np.ndarray
    item: np.ndarray
    length: np.ndarray  # of each test suffix: words of its longest match and one place of it
    at: np.ndarray


def _hashed(texts: W.Flat) -> tuple[np.ndarray, np.ndarray]:
    folded = texts._replace(data=W.LOWER[texts.data])
    words = W.words_of(folded, W.ALNUM)
    return W.hashes(folded.data, words.starts, words.ends)[0], words.first


def items_of(texts: W.Flat, names: list[str], window: int) -> Items:
    hashed, first = _hashed(texts)
    counts = np.diff(first)
    vocabulary = np.unique(hashed)
    item = np.repeat(np.arange(len(counts)), counts)
    nth = np.arange(len(hashed)) - first[item]
    starts = np.arange(len(hashed)) + item  # each item has a 0 behind it
    ids = np.zeros(len(hashed) + len(counts) + 1, np.int64)
    ids[starts] = np.searchsorted(vocabulary, hashed) + 1
    long = counts[item] >= window
    size = np.where(long, np.where(nth + window <= counts[item], window, 0), np.where(nth == 0, counts[item], 0))
    return Items(vocabulary, ids, starts, item, size, names)


def numbered(hashed: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """Place of each word in the vocabulary, from 1; 0: it isn't there."""
    if len(vocabulary) == 0:
        return np.zeros(len(hashed), np.int64)
    at = np.searchsorted(vocabulary, hashed)
    at[at == len(vocabulary)] = 0
    return np.where(vocabulary[at] == hashed, at + 1, 0)


def suffix_array(ids: np.ndarray, depth: int) -> np.ndarray:
    """Places of all numbers over 0, ordered by the numbers from there to the next 0, `depth` at most.

    As many numbers as 62 bits hold are sorted first; then the groups that are still equal are sorted
    by what follows them, which doubles the depth each time.
    """
    n = len(ids)
    bits = max(1, int(ids.max(initial=0)).bit_length())
    k = min(62 // bits, max(1, depth))
    padded = np.concatenate([ids, np.zeros(k, ids.dtype)])
    key, alive = ids.copy(), ids > 0
    for j in range(1, k):
        following = padded[j : j + n]
        alive &= following > 0
        key <<= bits
        key |= np.where(alive, following, 0)
    place = np.flatnonzero(ids)
    key = key[place]
    order = np.argsort(key)
    place, key = place[order], key[order]
    ended = np.ones(n + 1, bool)  # the text ends within the part that is sorted
    ended[:n] = ~alive
    rank = np.zeros(n + 1, np.int64)
    m = len(place)
    fresh = np.ones(m, bool)
    fresh[1:] = key[1:] != key[:-1]
    rank[place] = np.maximum.accumulate(np.where(fresh, np.arange(m), 0)) + 1
    open_ = np.arange(m)
    while k < depth and len(open_):
        own = rank[place[open_]]
        alone = np.ones(len(open_), bool)
        alone[1:] &= own[1:] != own[:-1]
        alone[:-1] &= own[1:] != own[:-1]
        open_ = open_[~alone & ~ended[place[open_]]]
        p = place[open_]
        after = np.minimum(p + k, n)
        second = rank[after]
        key = rank[p] * (n + 2) + second
        order = np.argsort(key)
        p, key, second, after = p[order], key[order], second[order], after[order]
        place[open_] = p
        fresh = np.ones(len(p), bool)
        fresh[1:] = key[1:] != key[:-1]
        over = (second == 0) | ended[after]
        rank[p] = np.maximum.accumulate(np.where(fresh, open_, 0)) + 1
        ended[p] |= over
        k *= 2
    return place


def search(ids: np.ndarray, items: Items, depth: int) -> Found:
    """Every suffix of every test item, narrowed down in the suffix array one word at a time."""
    place = suffix_array(ids, depth)
    heads = ids[place]
    padded = np.concatenate([ids, np.zeros(1, ids.dtype)])
    wanted = items.ids[items.starts]
    low, high = np.searchsorted(heads, wanted, "left"), np.searchsorted(heads, wanted, "right")
    length, at = np.zeros(len(wanted), np.int64), np.full(len(wanted), -1)
    found: list[tuple[np.ndarray, ...]] = []
    open_, d = np.arange(len(wanted)), 0
    while True:
        keep = low < high
        open_, low, high = open_[keep], low[keep], high[keep]
        if not len(open_):
            break
        d += 1
        length[open_], at[open_] = d, place[low]
        full = items.window[open_] == d
        found.append((low[full], high[full], np.full(int(full.sum()), d), items.item[open_[full]]))
        word = items.ids[items.starts[open_] + d]
        go = word > 0
        open_, low, high, word = open_[go], low[go], high[go], word[go]
        low, high = _bounds(padded, place, low, high, word, d)
    parts = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 4
    return Found(place, *parts, length, at)


def _bounds(ids, place, low, high, word, d):
    """First place in each range whose word at depth d isn't below `word`, and first that is above it."""
    n = len(low)
    a, b = np.concatenate([low, low]), np.concatenate([high, high])
    target = np.concatenate([word, word + 1])
    while True:
        busy = np.flatnonzero(a < b)
        if not len(busy):
            return a[:n], a[n:]
        middle = (a[busy] + b[busy]) >> 1
        less = ids[place[middle] + d] < target[busy]
        a[busy[less]] = middle[less] + 1
        b[busy[~less]] = middle[~less]


@lru_cache(maxsize=2)
def _blocks(path: str, window: int) -> list:
    """Opened anew by each worker: one (file, row group) per block."""
    system, inner = pa.fs.FileSystem.from_uri(path)
    files = sorted(f.path for f in system.get_file_info(pa.fs.FileSelector(inner)) if f.path.endswith(".parquet"))
    return [(system, f) for f in files]


@lru_cache(maxsize=1)
def _one_block(path: str, window: int, index: int) -> list[Items]:
    system, file = _blocks(path, window)[index]
    out = []
    with system.open_input_file(file) as source:
        for batch in pa.parquet.ParquetFile(source).iter_batches(BLOCK_ITEMS):
            names = batch.column("item_id").fill_null("").to_pylist()
            out.append(items_of(W.flat(batch.column("text")), names, window))
    return out


def _all_items(path: str, window: int) -> Iterator[Items]:
    for index in range(len(_blocks(path, window))):
        yield from _one_block(path, window, index)


def _shards(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Of each shard: its first document, word hashes, first words, and where each word stands (0s between documents)."""
    for at, piece in W.pieces(W.flat(column), SHARD_BYTES):
        hashed, first = _hashed(piece)
        counts = np.diff(first)
        yield at, hashed, first, np.arange(len(hashed)) + np.repeat(np.arange(len(counts)), counts)


def _ids(hashed: np.ndarray, stand: np.ndarray, n_docs: int, items: Items) -> np.ndarray:
    ids = np.zeros(len(hashed) + n_docs + 1, np.int64)
    ids[stand] = numbered(hashed, items.vocabulary)
    return ids


def _counts(column: pa.Array, path: str, window: int, depth: int) -> dict[str, list]:
    n_words, n_hit, n_items, digests = [], [], [], []
    for _, hashed, first, stand in _shards(column):
        n_docs = len(first) - 1
        hit = np.zeros(len(hashed) + n_docs + 2, np.int32)
        doc_at = np.append(first[:-1] + np.arange(n_docs), len(hashed) + n_docs)
        names: dict[int, set[str]] = {}
        for items in _all_items(path, window):
            found = search(_ids(hashed, stand, n_docs, items), items, depth)
            ranges, which = np.unique(np.stack([found.low, found.high, found.size]), axis=1, return_inverse=True)
            low, high, size = ranges
            of = np.repeat(np.arange(len(low)), high - low)
            spot = found.place[W.ragged(low, high - low)]
            np.add.at(hit, spot, 1)
            np.add.at(hit, spot + size[of], -1)
            docs = np.searchsorted(doc_at, spot, "right") - 1
            range_items: dict[int, set[str]] = {}
            for r, i in zip(which.reshape(-1).tolist(), found.item.tolist(), strict=True):
                range_items.setdefault(r, set()).add(items.names[i])
            for pair in np.unique(of * (n_docs + 1) + docs).tolist():
                names.setdefault(pair % (n_docs + 1), set()).update(range_items[pair // (n_docs + 1)])
        covered = np.append(0, np.cumsum(np.cumsum(hit)[stand] > 0))
        n_words += np.diff(first).tolist()
        n_hit += (covered[first[1:]] - covered[first[:-1]]).tolist()
        for i in range(n_docs):
            own = sorted(names.get(i, ()))
            n_items.append(len(own))
            digests.append(hashlib.sha256(",".join(own).encode()).hexdigest())
    return {"n_words": n_words, "n_hit": n_hit, "n_items": n_items, "items_sha256": digests}


def _contaminated(counts: dict[str, list]) -> list[bool]:
    return [h > 0 and 20 * h >= n for h, n in zip(counts["n_hit"], counts["n_words"], strict=True)]


def _items_table(benchmark: DataFrame) -> tuple[str, int]:
    """Test items as a table in the shared folder: its path, and the words of the longest item at most."""
    spark = benchmark.sparkSession
    path = shared.shared_folder(spark)
    benchmark.select(F.col("item_id").cast("string").alias("item_id"), shared.text_of()).where(
        "text != ''"
    ).write.parquet(path)
    # a word and what ends it take two bytes at least
    longest = spark.read.parquet(path).agg(F.max(F.octet_length("text"))).first()[0] or 0
    return path, longest // 2 + 1


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    Null texts and texts without words have no hits; a null item_id is listed as ''; items without words
    are never found; repeated documents are judged each; equal item_ids count once. Extra columns of
    either table play no part.
    """
    path, depth = _items_table(benchmark)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = _counts(batch.column(1), path, window, depth)
            flags = _contaminated(counts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(counts[k], pa.int64()) for k in ("n_words", "n_hit", "n_items")),
                 pa.array(counts["items_sha256"], pa.string()), pa.array(flags, pa.bool_())],
                names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
            )

    rows = docs.select("doc_id", shared.text_of())
    return shared.map_arrow(rows, judged, shared.with_fields(
        rows.select("doc_id").schema,
        n_words="long", n_hit="long", n_items="long", items_sha256="string", contaminated="boolean",
    ))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents, all columns, without those of which a twentieth of the words or more is hit."""
    path, depth = _items_table(benchmark)
    column = docs.columns.index("text")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bad = _contaminated(_counts(batch.column(column), path, window, depth))
            yield batch.filter(pa.array([not x for x in bad], pa.bool_()))

    return shared.map_arrow(docs, kept, docs.schema)


def longest_matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """For every test suffix that occurs: item_id, item_word, length in words, and doc_id, doc_word of one place.

    Of equally long matches the one with the smallest doc_id, then doc_word. Words count from 0.
    """
    path, depth = _items_table(benchmark)

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, hashed, first, stand in _shards(batch.column(1)):
                n_docs = len(first) - 1
                doc_at = first[:-1] + np.arange(n_docs)
                for items in _all_items(path, WINDOW):
                    found = search(_ids(hashed, stand, n_docs, items), items, depth)
                    hits = np.flatnonzero(found.length)
                    doc = np.searchsorted(doc_at, found.at[hits], "right") - 1
                    begin = np.searchsorted(items.item, items.item[hits])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([items.names[i] for i in items.item[hits]], pa.string()),
                         pa.array(hits - begin, pa.int64()), pa.array(found.length[hits], pa.int64()),
                         batch.column(0).take(pa.array(at + doc)),
                         pa.array(found.at[hits] - doc_at[doc], pa.int64())],
                        names=["item_id", "item_word", "length", "doc_id", "doc_word"],
                    )

    rows = docs.select("doc_id", shared.text_of())
    found = shared.map_arrow(rows, matched, _match_schema(rows))
    best = F.max_by(F.struct("length", "doc_id", "doc_word"), F.struct("length", -F.col("doc_id"), -F.col("doc_word")))
    return found.groupBy("item_id", "item_word").agg(best.alias("best")).select("item_id", "item_word", "best.*")


def _match_schema(rows: DataFrame):
    kind = rows.schema["doc_id"].dataType.simpleString()
    return shared.struct(item_id="string", item_word="long", length="long", doc_id=kind, doc_word="long")
