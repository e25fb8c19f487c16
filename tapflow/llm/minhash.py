"""Near copies by DartMinHash: weighted minwise signatures, joined band by band, checked exactly.

An element of weight w (a shingle that occurs w times) owns the strip [0, w) of a weight axis, cut into regions that
double in width. Hashed darts arrive in each region in the order of a second axis, their rank, as often as the region is
wide; how many there are doesn't depend on the document. A dart counts where it falls below w, and names one
of the signature's coordinates, which keeps its earliest dart. About k ln k darts fill k coordinates, whatever
the document's length, and two documents agree in a coordinate with the probability of their weighted
Jaccard similarity.

All work is on distinct texts, known by their MD5. Texts that share a band are candidates. Each is compared with
one text of its bucket, not all with all; then, where that gave no link, with the bucket's most central text (the one most
like the first), and at last all pairs of a bucket that are still apart, unless their lengths, the triangle
inequality of the Jaccard distance or longer signatures rule them out. So groups of thousands cost about as many
comparisons as they have members, and no link is lost that the signatures show.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, functions as F

from tapflow.llm import shared, words as W
from tapflow.llm.graphs import components

SHINGLE = 5  # words
SIMILARITY = 0.8
BANDS, ROWS = 24, 6
#: Coordinates of the sketches that decide whether a pair is compared at last, one bit of each, and how many have to agree:
#: 3.3 standard deviations below what similarity 0.8 leads to expect.
SKETCH = 1024
AGREEING = int(SKETCH * 0.9 - 3.3 * (SKETCH * 0.9 * 0.1) ** 0.5)
_LONGS = SKETCH // 64
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SALT = np.uint64(0xC2B2AE3D27D4EB4F)


def shingles(texts: W.Flat, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n words, and the text of each; one of all its words for a text of fewer."""
    folded = W.LOWER[texts.data]
    words = W.words_of(W.Flat(folded, texts.offsets), W.ALNUM)
    hashed, first = W.hashes(folded, words.starts, words.ends)[0], words.first
    counts = np.diff(first)
    runs = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    at = W.ragged(first[:-1], runs)
    text = np.repeat(np.arange(len(counts)), runs)
    size = np.minimum(counts, n)[text]
    h = np.zeros(len(at), np.uint64)
    behind = np.append(hashed, np.zeros(n, np.uint64))
    for j in range(n):
        h = W.mixed(h * _ODD + np.where(j < size, behind[at + j], 0) + np.uint64(1))
    return h, text


def weighted(h: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct elements of each text: hash, text and how often it occurs."""
    _, index, counts = np.unique(W.mixed(h + text.astype(np.uint64) * _SALT), return_index=True, return_counts=True)
    return h[index], text[index], counts


def _unit(h: np.ndarray) -> np.ndarray:
    """Over 0, up to 1."""
    return ((h >> np.uint64(11)).astype(np.float64) + 1) / (1 << 53)


def signatures(element: np.ndarray, owner: np.ndarray, weight: np.ndarray, n: int, k: int) -> np.ndarray:
    """The k coordinates of each of n sets; weights over 0 may be any number. Sets without elements stay 0."""
    out = np.zeros((n, k), np.uint64)
    total = np.bincount(owner, weight, n)
    todo = total > 0
    limit = np.zeros(n)
    limit[todo] = (k * np.log(k) + 2 * k) / total[todo]  # rank up to which so many darts are expected
    while todo.any():
        own = todo[owner]
        rank, value = _earliest(element[own], owner[own], weight[own], limit, n, k)
        full = np.isfinite(rank).all(axis=1) & todo
        out[full] = value[full]
        todo &= ~full
        limit *= 2
    return out


def _earliest(element, owner, weight, limit, n, k):
    best, value = np.full(n * k, np.inf), np.zeros(n * k, np.uint64)
    width, low = 1.0, 0.0
    level = 0
    while len(element):
        state = W.mixed(element + np.full(1, _SALT) * np.uint64(level + 1))
        who, cut, size = owner, limit[owner], weight
        rank, at, many = np.zeros(len(who)), 0, 1
        while len(who):
            steps = np.arange(at, at + many, dtype=np.uint64)
            dart = W.mixed(state[:, None] + (steps + np.uint64(1))[None] * _ODD)
            arrival = rank[:, None] + np.cumsum(-np.log(_unit(dart)), axis=1) / width
            second = W.mixed(dart ^ _SALT)
            counts = (arrival <= cut[:, None]) & (low + width * (1 - _unit(second)) < size[:, None])
            slot = (who[:, None] * k + (W.mixed(second ^ _ODD) % np.uint64(k)).astype(np.int64))[counts]
            came, thrown = arrival[counts], dart[counts]
            np.minimum.at(best, slot, came)
            first = came == best[slot]
            value[slot[first]] = thrown[first]
            rank = arrival[:, -1]
            going = rank <= cut
            state, who, cut, size, rank = state[going], who[going], cut[going], size[going], rank[going]
            at, many = at + many, 8
        low, width, level = low + width, width * 2, level + 1
        wide = weight > low
        element, owner, weight = element[wide], owner[wide], weight[wide]
    return best.reshape(n, k), value.reshape(n, k)


def bands_of(texts: W.Flat, bands: int, rows: int) -> np.ndarray:
    """Of each text, a hash for each band of its signature; texts without words have zeros."""
    n = len(texts.offsets) - 1
    out = np.zeros((n, bands), np.uint64)
    for start, piece in W.pieces(texts):
        m = len(piece.offsets) - 1
        element, owner, weight = weighted(*shingles(piece))
        signed = signatures(element, owner, weight, m, bands * rows).reshape(m, bands, rows)
        h = np.zeros((m, bands), np.uint64) + np.arange(1, bands + 1, dtype=np.uint64)[None] * _SALT
        for j in range(rows):
            h = W.mixed(h * _ODD + signed[:, :, j])
        h[np.bincount(owner, minlength=m) == 0] = 0
        out[start : start + m] = h
    return out


def sketches_of(texts: W.Flat) -> tuple[np.ndarray, np.ndarray]:
    """Of each text its number of shingles, and one bit of each coordinate of a long signature."""
    n = len(texts.offsets) - 1
    sizes, bits = np.zeros(n, np.int64), np.zeros((n, _LONGS), np.int64)
    for start, piece in W.pieces(texts, 1 << 20):
        m = len(piece.offsets) - 1
        element, owner, weight = weighted(*shingles(piece))
        whole = signatures(element, owner, weight, m, SKETCH)
        sizes[start : start + m] = np.bincount(owner, weight, m)
        bits[start : start + m] = np.packbits((whole & np.uint64(1)).astype(bool), axis=1, bitorder="little").view(np.int64)
    return sizes, bits


def likeness(left: W.Flat, right: W.Flat) -> np.ndarray:
    """Weighted Jaccard similarity of the shingles of left[i] and right[i]; 0 where neither has any."""
    n = len(left.offsets) - 1
    (a, i), (b, j) = shingles(left), shingles(right)
    pair = np.concatenate([i, j])
    key = W.mixed(np.concatenate([a, b]) + pair.astype(np.uint64) * _SALT)
    _, index, inverse = np.unique(key, return_index=True, return_inverse=True)
    x = np.bincount(inverse[: len(a)], minlength=len(index))
    y = np.bincount(inverse[len(a) :], minlength=len(index))
    both = np.bincount(pair[index], np.minimum(x, y), n)
    return both / np.maximum(np.bincount(pair[index], np.maximum(x, y), n), 1)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.unhex(F.md5("text")).alias("key"), "text")


def _lists(values: np.ndarray) -> pa.Array:
    flat = pa.array(np.ascontiguousarray(values).view(np.int64).reshape(-1))
    return pa.FixedSizeListArray.from_arrays(flat, values.shape[1]).cast(pa.list_(pa.int64()))


def _banded(rows: DataFrame) -> DataFrame:
    """row, doc_id, key of the text, and the bands of its signature (null without words)."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bands = bands_of(W.flat(batch.column(3)), BANDS, ROWS)
            none = pa.array((bands == 0).all(axis=1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.compute.if_else(none, pa.scalar(None, pa.list_(pa.int64())), _lists(bands))],
                names=["row", "doc_id", "key", "bands"],
            )

    given = rows.select("row", "doc_id", F.unhex(F.md5("text")).alias("key"), "text")
    return shared.map_arrow(given, signed, shared.with_fields(given.drop("text").schema, bands="array<long>"))


def _sketched(texts: DataFrame) -> DataFrame:
    """key, size, bands and the sketch as numbers s0, s1, ..., written down."""
    names = [f"s{i}" for i in range(_LONGS)]

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = W.flat(batch.column(1))
            sizes, bits = sketches_of(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes), _lists(bands_of(texts, BANDS, ROWS)), *(pa.array(np.ascontiguousarray(x)) for x in bits.T)],
                names=["key", "size", "bands", *names],
            )

    schema = shared.struct(key="binary", size="long", bands="array<long>", **dict.fromkeys(names, "long"))
    return shared.stored(shared.map_arrow(texts.select("key", "text"), sketched, schema))


def _compared(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) of texts with their likeness, written down."""
    pairs = shared.stored(pairs.distinct())
    sides = pairs.join(texts.select(F.col("key").alias("a"), F.col("text").alias("left")), "a").join(
        texts.select(F.col("key").alias("b"), F.col("text").alias("right")), "b"
    ).select("a", "b", "left", "right")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = W.flat(batch.column(2)), W.flat(batch.column(3))
            values = np.zeros(batch.num_rows)
            for at, piece in W.pieces(left):
                n = len(piece.offsets) - 1
                ends = right.offsets[at : at + n + 1]
                values[at : at + n] = likeness(piece, W.Flat(right.data[ends[0] : ends[-1]], ends - ends[0]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(values)], names=["a", "b", "likeness"])

    return shared.stored(shared.map_arrow(sides, compared, shared.struct(a="binary", b="binary", likeness="double")))


def _links(compared: DataFrame) -> DataFrame:
    return compared.where(F.col("likeness") >= SIMILARITY).select("a", "b")


def _edges(classes: DataFrame) -> DataFrame:
    return classes.select(F.col("node").alias("a"), F.col("component").alias("b"))


def _grouped(rows: DataFrame) -> DataFrame:
    """Of each row (row, doc_id, text): row, doc_id and the key that its class goes by."""
    signed = shared.stored(_banded(rows))
    distinct = signed.where("bands IS NOT NULL").groupBy("key").agg(F.first("bands").alias("bands"))
    banded = shared.stored(distinct.select("key", F.explode("bands").alias("band")))
    buckets = shared.stored(
        banded.groupBy("band").agg(F.min("key").alias("pivot"), F.max("key").alias("last")).where("pivot != last").drop("last")
    )
    members = shared.stored(banded.join(buckets, "band"))
    wanted = shared.stored(members.select("key").distinct())
    # by a shuffle at every size: how many texts have candidates grows with the input
    texts = shared.stored(_texts(rows).join(wanted.hint("merge"), "key", "left_semi").groupBy("key").agg(F.first("text").alias("text")))
    stars = _compared(members.where("key != pivot").select(F.col("key").alias("a"), F.col("pivot").alias("b")), texts)
    far = stars.select(F.col("a").alias("key"), F.col("b").alias("pivot"), (1 - F.col("likeness")).alias("far"))
    # a pivot itself is no longer needed: all of its bucket were compared with it
    members = shared.stored(members.where("key != pivot").join(far, ["key", "pivot"]).drop("pivot"))
    central = shared.stored(members.groupBy("band").agg(F.min(F.struct("far", "key")).alias("c")).select(
        "band", F.col("c.key").alias("center"), F.col("c.far").alias("center_far")
    ))
    # texts that are both linked to the first are connected already
    apart = members.join(central, "band").where(
        (F.col("key") != F.col("center")) & (F.greatest("far", "center_far") > 1 - SIMILARITY)
        & (F.abs(F.col("far") - F.col("center_far")) <= REACH)
    )
    more = _compared(apart.select(F.greatest("key", "center").alias("a"), F.least("key", "center").alias("b")), texts)
    found = shared.stored(components(_links(stars).unionAll(_links(more))))
    links = _links(_compared(_unconnected(_placed(members, found), texts), texts))
    if not links.isEmpty():
        found = shared.stored(components(_edges(found).unionAll(links)))
    return signed.select("row", "doc_id", "key").join(
        found.select(F.col("node").alias("key"), "component"), "key", "left"
    ).select("row", "doc_id", F.coalesce("component", "key").alias("component"))


REACH = 1 - SIMILARITY + 1e-9


def _placed(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows with the component of their text, which is its own key as long as nothing is linked to it."""
    classes = found.select(F.col("node").alias("key"), "component")
    return rows.join(classes, "key", "left").withColumn("component", F.coalesce("component", "key"))


def _unconnected(placed: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs of a bucket in different components that may still be alike, each in the first of the bands that both have.

    If one of them is the text that all of that bucket were compared with, the pair is known already.
    """
    mixed = shared.stored(
        placed.groupBy("band").agg(F.min("component").alias("m"), F.max("component").alias("n")).where("m != n").select("band")
    )
    open_ = shared.stored(placed.join(mixed, "band"))
    sketches = _sketched(texts.join(shared.stored(open_.select("key").distinct()), "key", "left_semi"))
    open_ = shared.stored(open_.join(sketches, "key"))
    apart = " + ".join(f"bit_count(x.s{i} ^ y.s{i})" for i in range(_LONGS))
    return open_.alias("x").join(open_.alias("y"), F.expr(
        f"x.band = y.band AND x.key > y.key AND x.component != y.component AND abs(x.far - y.far) <= {REACH!r}D "
        f"AND least(x.size, y.size) >= {SIMILARITY}D * greatest(x.size, y.size) AND {apart} <= {SKETCH - AGREEING} "
        "AND array_min(array_intersect(x.bands, y.bands)) = x.band"
    )).select(F.col("x.key").alias("a"), F.col("y.key").alias("b"))


def _stored_groups(rows: DataFrame) -> DataFrame:
    """The groups written down, and what led to them removed."""
    with shared.recorded() as paths:
        grouped = _grouped(rows)
    result = shared.stored(grouped)
    shared.remove(rows.sparkSession, paths)
    return result


def classes(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, class_id (the smallest doc_id of its class), class_size in rows.

    A class holds equal texts, and texts connected by links of a similarity of 0.8 or more. Null counts as empty; all texts without
    content but equal are one class; a text without words has only equal ones beside it. Rows without id are members, and
    give a class its id only where no other does (null then). Repeated rows are copies.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", shared.text_of())
    grouped = _stored_groups(rows)
    ids = shared.stored(grouped.groupBy("component").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size")))
    return grouped.join(ids, "component").select("doc_id", "class_id", "class_size")


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents, all columns, one of each class: that with the smallest doc_id, of repeated rows any one."""
    held = shared.stored(docs.withColumn(_ROW, F.monotonically_increasing_id()))
    grouped = _stored_groups(held.select(F.col(_ROW).alias("row"), "doc_id", shared.text_of()))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    kept = shared.stored(grouped.groupBy("component").agg(F.min(order).alias("best")).select(F.col("best.row").alias(_ROW)))
    # by a shuffle at every size: how many rows are kept grows with the input
    return held.join(kept.hint("merge"), _ROW, "left_semi").select(*docs.columns)


_ROW = "row of this run"
