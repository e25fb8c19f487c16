"""Line dedup by pairwise alignment: passages that an earlier document has go from the later one.

Overlapping documents are found through lines they share. A rare line (few documents hold it) pairs each of its documents with
every earlier one; any other pairs each with the first that holds it, and so does a run of short lines that has five words only
together; both grow in proportion however common they are. A pair is aligned by patience diff: lines that both documents hold once
anchor the alignment, what lies next to and between them follows. Runs of aligned lines of five words or more in all are deleted from
the later document, then all other runs of that size that both have, moved or repeated, which no alignment takes. So a line goes
exactly if it is in a run of five words or more that any earlier document has: the first to have the run's shortest part around
the line is among the partners. The first document with a line has no earlier one there, so one copy always stays.

Documents are ordered by doc_id, then by a hash of the text. Lines are compared without white space around them; blank lines don't
count and don't interrupt a run.
"""

from __future__ import annotations

import itertools
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tapflow.llm import shared, words as W

RARE = 4  # documents
MIN_WORDS = 5  # of a run that is deleted
_BLANK = " \t\n\x0b\x0c\r"
_LINE = np.ones(256, bool)
_LINE[10] = False


def lines_of(texts: W.Flat) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and number of words of each line that isn't blank, and the first line of each text."""
    lines, words = W.words_of(texts, _LINE), W.words_of(texts, W.NOT_SPACE)
    of = np.searchsorted(lines.starts, words.starts, "right") - 1
    begin = np.flatnonzero(np.diff(of, prepend=-1))
    end = np.append(begin[1:], len(of)) - 1 if len(of) else begin
    starts = words.starts[begin]
    hashed = W.hashes(texts.data, starts, words.ends[end])[0]
    return hashed, end - begin + 1, np.searchsorted(starts, texts.offsets)


def aligned(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Places (i, j) of lines that patience diff aligns, in order."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i0, i1, j0, j1 = todo.pop()
        while i0 < i1 and j0 < j1 and a[i0] == b[j0]:
            out.append((i0, j0))
            i0, j0 = i0 + 1, j0 + 1
        while i0 < i1 and j0 < j1 and a[i1 - 1] == b[j1 - 1]:
            i1, j1 = i1 - 1, j1 - 1
            out.append((i1, j1))
        if i0 == i1 or j0 == j1:
            continue
        in_a, in_b = Counter(a[i0:i1]), Counter(b[j0:j1])
        at = {x: j for j, x in enumerate(b[j0:j1], j0) if in_b[x] == 1}
        both = [(i, at[x]) for i, x in enumerate(a[i0:i1], i0) if in_a[x] == 1 and x in at]
        anchors = _rising(both)
        if not anchors:
            continue
        out += anchors
        edges = [(i0 - 1, j0 - 1), *anchors, (i1, j1)]
        todo += [(i + 1, k, j + 1, m) for (i, j), (k, m) in itertools.pairwise(edges) if k > i + 1 and m > j + 1]
    return sorted(out)


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest run of pairs, in the order given, whose second numbers rise."""
    tails: list[int] = []
    last: list[int] = []
    before: list[int] = []
    for n, (_, j) in enumerate(pairs):
        k = bisect_left(tails, j)
        before.append(last[k - 1] if k else -1)
        if k == len(tails):
            tails.append(j)
            last.append(n)
        else:
            tails[k], last[k] = j, n
    out, n = [], last[-1] if last else -1
    while n >= 0:
        out.append(pairs[n])
        n = before[n]
    return out[::-1]


def runs(lines: list[tuple[int, int, int]], min_words: int = MIN_WORDS) -> set[tuple[int, int]]:
    """The shortest runs of neighbouring lines with `min_words` words that begin or end at each line, as (from, to).

    They cover every line of any longer run without leaving it.
    """
    out = set()
    for step in (1, -1):
        for i in range(len(lines)):
            j, size = i, lines[i][2]
            while size < min_words and 0 <= j + step < len(lines) and lines[j + step][0] == lines[j][0] + step:
                j += step
                size += lines[j][2]
            if size >= min_words:
                out.add((min(i, j), max(i, j) + 1))
    return out


def doomed(earlier: list[tuple[int, int, int]], later: list[tuple[int, int, int]], min_words: int = MIN_WORDS) -> list[int]:
    """Lines to delete from the later of two documents, given as (place, hash, words) of the lines that any other document has."""
    out = _aligned_runs(earlier, later, min_words)
    if len(out) == len(later):
        return out
    held = {tuple(x[1] for x in earlier[a:b]) for a, b in runs(earlier, min_words)}
    moved = {
        later[j][0] for a, b in runs(later, min_words) if tuple(x[1] for x in later[a:b]) in held for j in range(a, b)
    }
    return out + sorted(moved.difference(out))


def _aligned_runs(earlier: list[tuple[int, int, int]], later: list[tuple[int, int, int]], min_words: int) -> list[int]:
    out: list[int] = []
    run: list[int] = []
    size, last = 0, (-2, -2)
    for i, j in [*aligned([x[1] for x in earlier], [x[1] for x in later]), (-1, -1)]:
        place = (earlier[i][0], later[j][0]) if i >= 0 else (-9, -9)
        if place != (last[0] + 1, last[1] + 1):
            if size >= min_words:
                out += run
            run, size = [], 0
        if i >= 0:
            run.append(later[j][0])
            size += later[j][2]
        last = place
    return out


def _lines(docs: DataFrame) -> DataFrame:
    """id, k (hash of the text), place, line (hash), words: one row per line that isn't blank."""
    rows = docs.where("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("id"), F.xxhash64(shared.text_of()).alias("k"), shared.text_of()
    )

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, piece in W.pieces(W.flat(batch.column(2))):
                hashed, words, first = lines_of(piece)
                counts = np.diff(first)
                of = np.repeat(np.arange(at, at + len(counts)), counts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(of)), batch.column(1).take(pa.array(of)),
                     pa.array((np.arange(len(of)) - np.repeat(first[:-1], counts)).astype(np.int32)),
                     pa.array(hashed.view(np.int64)), pa.array(words.astype(np.int32))],
                    names=["id", "k", "place", "line", "words"],
                )

    return shared.map_arrow(rows, split, shared.struct(id="long", k="long", place="int", line="long", words="int"))


def deletions(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """id, k (hash of the text) and places of the lines to delete, for documents that lose any."""
    lines = shared.stored(_lines(docs))
    held = lines.groupBy("line", "id", "k").agg(F.first("words").alias("w"))
    common = shared.stored(
        held.groupBy("line").agg(F.min(F.struct("id", "k")).alias("first"), F.max(F.struct("id", "k")).alias("last"), F.count("*").alias("n"))
        .where("first != last").select("line", "first", "n")
    )
    shown = shared.stored(lines.join(common, "line"))
    holder = F.struct("id", "k").alias("d")
    star = shown.where("first != struct(id, k)").select(F.col("first").alias("e"), holder)
    rare = shown.where(f"n <= {RARE}").groupBy("line").agg(F.array_sort(F.collect_set(holder)).alias("all"))
    each = rare.selectExpr("explode(all) AS d", "all").selectExpr("explode(filter(all, x -> x < d)) AS e", "d")
    # a document's own lines only; equal rows of a repeated document fall together
    own = shared.stored(shown.groupBy("id", "k").agg(F.array_sort(F.collect_set(F.struct("place", "line", "words"))).alias("lines")))
    several = _short_runs(own, min_words)
    begun = several.groupBy("run").agg(F.min(F.struct("id", "k")).alias("e"), F.max(F.struct("id", "k")).alias("last")).where("e != last")
    by_run = several.join(begun.select("run", "e"), "run").where("e != struct(id, k)").select("e", holder)
    pairs = star.unionAll(each).unionAll(by_run).select(
        F.col("e.id").alias("ia"), F.col("e.k").alias("ka"), F.col("d.id").alias("ib"), F.col("d.k").alias("kb")
    ).distinct()
    sides = shared.stored(pairs).join(
        own.select(F.col("id").alias("ia"), F.col("k").alias("ka"), F.col("lines").alias("earlier")), ["ia", "ka"]
    ).join(own.select(F.col("id").alias("ib"), F.col("k").alias("kb"), F.col("lines").alias("later")), ["ib", "kb"])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                doomed(a, b, min_words) for a, b in zip(_triples(batch.column("earlier")), _triples(batch.column("later")), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("ib"), batch.column("kb"), pa.array(found, pa.list_(pa.int32()))], names=["id", "k", "places"]
            ).filter(pa.array([bool(x) for x in found]))

    cut = shared.map_arrow(sides.select("ib", "kb", "earlier", "later"), compared, shared.struct(id="long", k="long", places="array<int>"))
    return shared.stored(cut.select("id", "k", F.explode("places").alias("place")).distinct().groupBy("id", "k").agg(
        F.collect_list("place").alias("places")
    ))


def _short_runs(own: DataFrame, min_words: int) -> DataFrame:
    """run (hash), id, k: the runs of two lines or more of each document; a run of one line is paired by the line."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashed = [
                list({hash(tuple(x[1] for x in lines[a:b])) for a, b in runs(lines, min_words) if b > a + 1})
                for lines in _triples(batch.column(2))
            ]
            of = pa.array(np.repeat(np.arange(len(hashed)), [len(x) for x in hashed]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for own in hashed for x in own], pa.int64()), batch.column(0).take(of), batch.column(1).take(of)],
                names=["run", "id", "k"],
            )

    return shared.stored(shared.map_arrow(own.select("id", "k", "lines"), found, shared.struct(run="long", id="long", k="long")))


def _triples(column: pa.Array) -> Iterator[list[tuple[int, int, int]]]:
    values = column.flatten()
    rows = list(zip(*(values.field(i).to_pylist() for i in range(3)), strict=True))
    at = np.cumsum(np.append(0, column.value_lengths().to_numpy()))
    return (rows[a:b] for a, b in itertools.pairwise(at.tolist()))


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Per document: doc_id, text without the deleted lines, n_lines (not blank) and n_removed.

    Null texts count as empty; a document without id has no place in the order and stays as it is; repeated
    rows are treated alike; of two texts under one id the one with the larger hash is the later.
    """
    cut = deletions(docs, min_words)
    rows = docs.select(
        "doc_id", F.col("doc_id").cast("long").alias("id"), F.xxhash64(shared.text_of()).alias("k"), shared.text_of()
    ).join(cut, ["id", "k"], "left").select("doc_id", "text", "places")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = np.concatenate([np.zeros(0, np.int64), *(np.diff(lines_of(p)[2]) for _, p in W.pieces(W.flat(batch.column(1))))])
            texts, removed = [], []
            for text, places in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                removed.append(len(places or ()))
                texts.append(_without(text, set(places)) if places else text)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), pa.array(counts), pa.array(removed, pa.int64())],
                names=["doc_id", "text", "n_lines", "n_removed"],
            )

    return shared.map_arrow(rows, kept, shared.with_fields(rows.select("doc_id", "text").schema, n_lines="long", n_removed="long"))


def _without(text: str, places: set[int]) -> str:
    n, out = 0, []
    for line in text.split("\n"):
        blank = not line.strip(_BLANK)
        if blank or n not in places:
            out.append(line)
        n += not blank
    return "\n".join(out)
