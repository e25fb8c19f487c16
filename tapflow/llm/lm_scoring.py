"""Language-model scores of whole documents: a word unigram model, and a causal self-attention model on subword ids.

Each text is encoded once: pieces of about 1 MB of texts are stored with their distinct words, the words' ids, and the place of
each word. Everything is learned from these pieces of all training documents. Counts of words and ids, and what stands beside
each id (for the classes), are summed by Spark. The attention model is fitted in rounds, each over a share of the pieces: tasks go on
from the same parameters over their own pieces, and what they change is averaged. Of the training documents one in TRIED, by a
hash, is not fitted; all of those choose the mixture. Which pieces a task fits one after the other depends on how the input is dealt.
The most frequent words are sent to all tasks (a fixed number); the others travel with the attention model's log probabilities of
their places, and their counts are joined by a shuffle. The model's probability of a word mixes the attention model's, over the
word's subwords, with the unigram model's; every count takes part in both scores, whichever way it comes.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tapflow.llm import attention, shards, shared, words as W
from tapflow.llm.subwords import encoder

#: One training document in so many takes no part in the gradient steps, but chooses the mixture.
TRIED = 20
#: The round in which a task's pieces are fitted, first to last and again; the first rounds are short.
ROUNDS = (0, 1, 1, 2, 2, 3, 3, 3)
#: Pieces of a task, where there are enough for all cores: one that fits sends off a few MB, however much it reads.
SCORED_PIECES, LEARNED_PIECES = 16, 128
#: Ids whose sums travel in one row.
BLOCK = 4096
#: Words whose counts every task holds.
FREQUENT = 1 << 18
#: Bytes of text that a worker handles at once.
PIECE = 1 << 20
MIXES = (0.3, 0.5, 0.7, 0.85, 0.95)


@dataclass
class Model:
    """Attention model, frequent words (sorted hashes, counts) and the sums of the training tokens."""

    net: attention.Attention
    words: np.ndarray
    counts: np.ndarray
    ends: int  # training documents
    tokens: int
    distinct: int
    mix: float = 0.5

    def known(self, hashed: np.ndarray) -> np.ndarray:
        """Count of each word, 0 if it isn't frequent."""
        if not len(self.words):
            return np.zeros(len(hashed), np.int64)
        at = np.minimum(np.searchsorted(self.words, hashed), len(self.words) - 1)
        return np.where(self.words[at] == hashed, self.counts[at], 0)

    def mixed(self, known: np.ndarray, by_word: np.ndarray, mix: float) -> np.ndarray:
        """Log10 probability of tokens of these counts and attention logs."""
        unigram = np.log(mix * (known + 1) / (self.tokens + self.distinct + 1))
        return np.logaddexp(unigram, np.log(1 - mix) + by_word) / np.log(10)


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))


def split(texts: W.Flat) -> tuple[np.ndarray, W.Words, np.ndarray]:
    """Lower-case bytes, words, and a hash of each word."""
    data = W.LOWER[texts.data]
    found = W.words_of(W.Flat(data, texts.offsets), W.NOT_SPACE)
    return data, found, W.hashes(data, found.starts, found.ends)[0]


def spaced(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words once more, each with a space before it: bytes, starts and ends."""
    sizes = ends - starts
    begin = np.cumsum(sizes + 1) - sizes - 1
    out = np.full(int((sizes + 1).sum()), 32, np.uint8)
    out[W.ragged(begin + 1, sizes)] = data[W.ragged(starts, sizes)]
    return out, begin, begin + sizes + 1


class Piece:
    """Texts as places in a list of their distinct words: each word's hash and ids, and what each text is used for."""

    FIELDS = ("held", "tried", "per_doc", "index", "hashed", "sizes", "pool")

    def __init__(self, held: np.ndarray, tried: np.ndarray, per_doc: np.ndarray, index: np.ndarray, hashed: np.ndarray, sizes: np.ndarray, pool: np.ndarray):
        self.held, self.tried, self.per_doc, self.index, self.hashed, self.sizes, self.pool = held, tried, per_doc, index, hashed, sizes, pool

    @classmethod
    def of(cls, own, texts: W.Flat, held: np.ndarray, tried: np.ndarray) -> Piece:
        data, found, hashed = split(texts)
        unique, first, index = W.distinct(hashed)
        if len(unique):
            pool, sizes = own.pieces(*spaced(data, found.starts[first], found.ends[first]))
        else:
            pool, sizes = np.zeros(0, np.int32), np.zeros(0, np.int64)
        return cls(held, tried, np.diff(found.first), index, unique, sizes, pool)

    def packed(self) -> list[bytes]:
        whole = [x.astype(np.min_scalar_type(int(x.max())) if len(x) else np.uint8) for x in (self.per_doc, self.index, self.sizes, self.pool)]
        return [x.tobytes() for x in (self.held.astype(np.int8), self.tried.astype(np.int8), whole[0], whole[1], self.hashed, whole[2], whole[3])]

    @classmethod
    def unpacked(cls, stored: pa.RecordBatch) -> Piece:
        row = {k: stored.column(k)[0].as_buffer() for k in cls.FIELDS}
        held, tried, hashed = (np.frombuffer(row[k], t) for k, t in (("held", bool), ("tried", bool), ("hashed", np.uint64)))
        per_doc = _whole(row["per_doc"], len(held))
        sizes = _whole(row["sizes"], len(hashed))
        return cls(held, tried, per_doc, _whole(row["index"], int(per_doc.sum())), hashed, sizes, _whole(row["pool"], int(sizes.sum())))

    def some(self, docs: np.ndarray) -> Piece:
        """Only these documents; the words stay listed."""
        return Piece(self.held[docs], self.tried[docs], self.per_doc[docs], self.index[np.repeat(docs, self.per_doc)], self.hashed, self.sizes, self.pool)

    def laid(self, end: int):
        """Ids of all words and ends, ids per document, first id of each word or end, hash of each (ends: 0), which are ends, tokens per document."""
        sizes = self.sizes[self.index]
        codes = self.pool[W.ragged((np.cumsum(self.sizes) - self.sizes)[self.index], sizes)]
        return _with_ends(codes, sizes, self.hashed[self.index], self.per_doc, end)


def _whole(data: pa.Buffer, n: int) -> np.ndarray:
    """n whole numbers of the fewest bytes that hold them."""
    return np.frombuffer(data, f"<u{data.size // n}").astype(np.int64) if n else np.zeros(0, np.int64)


def _with_ends(codes: np.ndarray, sizes: np.ndarray, hashed: np.ndarray, per_doc: np.ndarray, end: int):
    n_docs = len(per_doc)
    # one more token, of one id, behind each document's words
    at = np.cumsum(per_doc)
    sizes = np.insert(sizes, at, 1)
    words = np.insert(hashed, at, 0)
    is_end = np.zeros(len(sizes), bool)
    is_end[at + np.arange(n_docs)] = True
    begin = np.cumsum(sizes) - sizes
    ids = np.full(int(sizes.sum()), end, np.int32)
    inside = np.ones(len(ids), bool)
    inside[begin[is_end]] = False
    ids[inside] = codes
    tokens = per_doc + 1
    counts = np.add.reduceat(sizes, np.cumsum(tokens) - tokens) if n_docs else np.zeros(0, np.int64)
    return ids, counts, begin, words, is_end, tokens


def _encoded(own, texts: W.Flat):
    """A piece's `laid` of texts."""
    none = np.zeros(len(texts.offsets) - 1, bool)
    return Piece.of(own, texts, none, none).laid(own.size - 1)


class Pieces(NamedTuple):
    """All documents, encoded: files in the shared folder of one batch per piece, which tasks read one after the other."""

    spark: SparkSession
    folder: str
    files: list[tuple[str, int]]  # names and how many pieces

    def map(self, step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType, pieces: int, round_: int | None = None) -> DataFrame:
        """`step` over the pieces (of a round), about so many to a task, but no fewer tasks than cores; in the same way each time."""
        total = sum(n for _, n in self.files)
        n_tasks = max(1, min(total, max(self.spark.sparkContext.defaultParallelism, total // pieces)))
        folder, files = self.folder, self.files

        def stored(first: int, last: int) -> Iterator[pa.RecordBatch]:
            for name, n in files:
                wanted = [i for i in range(max(first, 0), min(last, n)) if round_ is None or ROUNDS[i % len(ROUNDS)] == round_]
                first, last = first - n, last - n
                if wanted:
                    with shards.opened(folder, name) as source:
                        file = pa.ipc.open_file(source)
                        for i in wanted:
                            yield file.get_batch(i)

        def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for task in batch.column(0).to_pylist():
                    yield from step(stored(task * total // n_tasks, (task + 1) * total // n_tasks))

        return shared.map_arrow(self.spark.range(0, n_tasks, 1, n_tasks), mapped, schema)


def _pieces(docs: DataFrame, vocabulary: str) -> Pieces:
    by_hash = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), shared.text_of()), F.lit(TRIED)) == 0
    rows = docs.select("doc_id", held_out().alias("held"), by_hash.alias("tried"), shared.text_of())
    folder = shared.shared_folder(docs.sparkSession)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary)
        for batch in batches:
            held, tried = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            for at, piece in W.pieces(W.flat(batch.column(3)), PIECE):
                n = len(piece.offsets) - 1
                row = Piece.of(own, piece, held[at : at + n], tried[at : at + n]).packed()
                ids = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), batch.column(0).slice(at, n))
                yield pa.RecordBatch.from_arrays([ids, *(pa.array([x], pa.binary()) for x in row)], names=["doc_ids", *Piece.FIELDS])

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoded(batches)
        first = next(made, None)
        if first is None:
            return
        name, n = f"pieces-{TaskContext.get().partitionId():06d}.arrow", 0
        with shards.committed(folder, name) as out, pa.ipc.new_file(out, first.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as file:
            for batch in itertools.chain([first], made):
                file.write_batch(batch)
                n += 1
        yield pa.RecordBatch.from_pydict({"name": [name], "n": pa.array([n], pa.int64())})

    files = shared.map_arrow(rows, written, shared.struct(name="string", n="long")).collect()  # one small row per file
    return Pieces(docs.sparkSession, folder, sorted(map(tuple, files)))


def _trained(batches: Iterator[pa.RecordBatch]) -> Iterator[Piece]:
    """The training documents of pieces that have any."""
    for piece in map(Piece.unpacked, batches):
        if not piece.held.all():
            yield piece.some(~piece.held)


def _counted(stored: Pieces, size: int) -> tuple[DataFrame, np.ndarray, int]:
    """Counts of words by hash (a table), counts of subword ids, and the number of training documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, ends = np.zeros(size, np.int64), 0
        for piece in _trained(batches):
            ends += len(piece.per_doc)
            n = np.bincount(piece.index, minlength=len(piece.hashed))
            ids += np.bincount(piece.pool, np.repeat(n, piece.sizes), size).astype(np.int64)
            some = np.flatnonzero(n)
            yield _pairs(np.zeros(len(some), np.int8), piece.hashed[some].view(np.int64), n[some])
        used = np.flatnonzero(ids)
        yield _pairs(np.ones(len(used), np.int8), used, ids[used])
        yield _pairs(np.full(1, 2, np.int8), np.zeros(1, np.int64), np.array([ends]))

    schema = shared.struct(kind="byte", item="long", n="long")
    sums = shared.stored(stored.map(count, schema, SCORED_PIECES).groupBy("kind", "item").agg(F.sum("n").alias("n")))
    ids = np.zeros(size, np.int64)
    for r in sums.where("kind = 1").collect():  # one row per id of the vocabulary at most
        ids[r.item] = r.n
    ends = sums.where("kind = 2").agg(F.sum("n")).first()[0] or 0
    return sums.where("kind = 0").select(F.col("item").alias("word"), "n"), ids, ends


def _pairs(kind: np.ndarray, item: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(kind), pa.array(item.astype(np.int64)), pa.array(n.astype(np.int64))], names=["kind", "item", "n"])


def _summed(stored: Pieces, step, size: int, width: int, round_: int | None = None) -> np.ndarray:
    """Sums of the matrices (size rows, width columns) that `step` makes of the pieces of each task.

    They travel in blocks of rows and are added by Spark in the order of the tasks; the driver gets the sums.
    """

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = step(batches)
        part = TaskContext.get().partitionId()
        for block in range(0, size if matrix is not None else 0, BLOCK):
            data = matrix[block : block + BLOCK].astype(np.float32)
            if data.any():
                yield _block(part, block, data)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sums = -1, None
        for batch in batches:
            for block, data in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                if block != at:
                    if sums is not None:
                        yield _block(0, at, sums)
                    at, sums = block, 0.0
                sums = sums + np.frombuffer(data.as_buffer(), np.float32).astype(np.float64)
        if sums is not None:
            yield _block(0, at, sums)

    schema = shared.struct(part="int", block="int", data="binary")
    blocks = stored.map(made, schema, LEARNED_PIECES, round_)
    blocks = blocks.repartition(-(-size // BLOCK), "block").sortWithinPartitions("block", "part")
    out = np.zeros((size, width))
    for r in shared.map_arrow(blocks, added, schema).collect():  # one matrix, whatever the input
        out[r.block : r.block + BLOCK] = np.frombuffer(r.data, np.float64).reshape(-1, width)
    return out


def _block(part: int, block: int, data: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([data.tobytes()], pa.binary())], names=["part", "block", "data"]
    )


def _classes(stored: Pieces, id_counts: np.ndarray, end: int) -> np.ndarray:
    """Classes of ids by what stands beside them in all training documents."""
    size = len(id_counts)
    sent = stored.spark.sparkContext.broadcast(id_counts)

    def beside(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
        made, sums = attention.Neighbours(sent.value), None
        for piece in _trained(batches):
            found = made.of(piece.laid(end)[0])
            if sums is None:
                sums = found
            else:
                sums += found
        return sums

    return attention.classes(_summed(stored, beside, size, 2 * attention.NEAR), id_counts)


def _fitted(stored: Pieces, net: attention.Attention, end: int, batch: int) -> None:
    """Fit the model on all training documents but the tried ones, in rounds: tasks go on from one model, their changes are averaged.

    An id's row is averaged by how often each task read it, all else by the tasks' steps.
    """
    size, progress = len(net.ids), attention.Progress.start(net)
    left = len(ROUNDS)
    for number in sorted(set(ROUNDS)):
        pace = (left / len(ROUNDS), (left - ROUNDS.count(number)) / len(ROUNDS))
        left -= ROUNDS.count(number)
        sent = stored.spark.sparkContext.broadcast((net, progress))
        before = _flat(net, progress)
        rows, width = size + -(-len(before) // attention.DIM), attention.DIM + 2

        def changed(batches: Iterator[pa.RecordBatch], sent=sent, before=before, pace=pace, rows=rows, width=width) -> np.ndarray | None:
            (given, past), own, now = sent.value, None, None
            for piece in _trained(batches):
                ids, counts, *_ = piece.some(~piece.tried).laid(end)
                if not len(counts):
                    continue
                if own is None:
                    own, now = given.copy(), past.copy()
                attention.train(own, ids, counts, end, seed=now.step, progress=now, pace=pace, batch=batch)
            if own is None:
                return None
            read, steps = now.read, now.step - past.step
            out = np.zeros((rows, width), np.float32)
            out[:size, :-2] = (own.ids - given.ids) * read[:, None]
            out[:size, -2], out[:size, -1] = (now.sums - past.sums) * read, read
            dense = (_flat(own, now) - before) * steps
            out[size:, :-2] = np.pad(dense, (0, -len(dense) % attention.DIM)).reshape(-1, attention.DIM)
            out[size:, -1] = steps
            return out

        sums = _summed(stored, changed, rows, width, number)
        sent.unpersist()
        sums[:, :-1] /= np.maximum(sums[:, -1:], 1)
        net.ids += sums[:size, :-2].astype(np.float32)
        progress.sums += sums[:size, -2].astype(np.float32)
        _unflat(net, progress, before + sums[size:, :-2].reshape(-1)[: len(before)].astype(np.float32))
        progress.step += int(sums[-1, -1])


def _flat(net: attention.Attention, progress: attention.Progress) -> np.ndarray:
    return np.concatenate([x[k].reshape(-1) for x in (net.dense, progress.mean, progress.square) for k in net.dense])


def _unflat(net: attention.Attention, progress: attention.Progress, values: np.ndarray) -> None:
    at = 0
    for x in (net.dense, progress.mean, progress.square):
        for k in net.dense:
            x[k] = values[at : at + x[k].size].reshape(x[k].shape).astype(np.float32)
            at += x[k].size


def _mix(stored: Pieces, model: Model, counted: DataFrame, end: int) -> float:
    """The mixture under which the tried training documents are likeliest."""
    sent = stored.spark.sparkContext.broadcast(model)

    def tried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _trained(batches):
            if not piece.tried.any():
                continue
            given = sent.value
            by_word, words, known, is_end, _ = _logs(given, piece.some(piece.tried), end)
            rare = (known == 0) & ~is_end
            sums = [[float(given.mixed(known[~rare], by_word[~rare], m).sum()) for m in MIXES]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([None, *words[rare].view(np.int64).tolist()], pa.int64()), pa.array(sums + [[x] for x in by_word[rare].tolist()], pa.list_(pa.float64()))],
                names=["word", "logs"],
            )

    found = shared.stored(stored.map(tried, shared.struct(word="long", logs="array<double>"), SCORED_PIECES))
    often = found.where("word IS NULL").agg(*[F.sum(F.col("logs")[i]) for i in range(len(MIXES))]).first()
    if often[0] is None:
        return model.mix
    n = float(model.tokens + model.distinct + 1)
    rare = found.where("word IS NOT NULL").join(counted, "word").agg(*[
        F.coalesce(F.sum(F.log10(m * (F.col("n") + 1) / n + (1 - m) * F.exp(F.col("logs")[0]))), F.lit(0.0)) for m in MIXES
    ]).first()
    return max(zip(MIXES, often, rare, strict=True), key=lambda x: x[1] + x[2])[0]


def train(docs: DataFrame, vocabulary: str, batch: int = attention.BATCH) -> tuple[Model, DataFrame, Pieces]:
    """The model, the table of the counts of all training words, and all documents encoded."""
    stored = _pieces(docs, vocabulary)
    size = encoder(vocabulary).size
    end = size - 1
    counted, id_counts, ends = _counted(stored, size)
    total, distinct = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = counted.orderBy(F.desc("n"), "word").limit(FREQUENT).toArrow()  # FREQUENT pairs of numbers
    hashed, n = top["word"].to_numpy().view(np.uint64), top["n"].to_numpy()
    order = np.argsort(hashed)
    id_counts[end] += ends
    klass = _classes(stored, id_counts, end)
    net = attention.fresh(size, klass, attention.shares(klass, id_counts))
    if ends:
        _fitted(stored, net, end, batch)
    model = Model(net, hashed[order], n[order], int(ends), int(total + ends), int(distinct + (ends > 0)))
    model.mix = _mix(stored, model, counted, end) if ends else model.mix
    return model, counted, stored


def _logs(model: Model, piece: Piece, end: int):
    """Of each token the attention model's log, hash, count if frequent, and whether it is an end; tokens per text."""
    ids, counts, begin, words, is_end, tokens = piece.laid(end)
    logs = attention.log_probabilities(model.net, ids, counts, end)
    known = np.full(len(words), model.ends, np.int64)
    known[~is_end] = model.known(piece.hashed)[piece.index]  # each distinct word looked up once
    return np.add.reduceat(logs.astype(np.float64), begin), words, known, is_end, tokens


def _rare(doc: np.ndarray, words: np.ndarray, logs: np.ndarray, n_docs: int) -> pa.ListArray:
    """Of each document, its distinct words among these with the attention logs of their places."""
    order = np.lexsort((words, doc))
    doc, words, logs = doc[order], words[order], logs[order]
    begin = np.flatnonzero((np.diff(doc, prepend=-1) != 0) | (words != np.roll(words, 1)))
    each = pa.ListArray.from_arrays(pa.array(np.append(begin, len(doc)).astype(np.int32)), pa.array(logs))
    pairs = pa.StructArray.from_arrays([pa.array(words[begin].view(np.int64)), each], names=["word", "logs"])
    ends = np.cumsum(np.bincount(doc[begin], minlength=n_docs))
    return pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pairs)


def score(docs: DataFrame, vocabulary: str, batch: int = attention.BATCH) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    A null text counts as empty and has its end only; a null id isn't held out; repeated documents are scored each.
    Without training documents nothing is known and the attention model is as it began. `batch` is how many windows a
    step of the fit takes.
    """
    model, counted, stored = train(docs, vocabulary, batch)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # FREQUENT words and the vocabulary's ids, whatever the input
    end = len(model.net.klass) - 1

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = sent.value
        for batch in batches:
            piece = Piece.unpacked(batch)
            by_word, words, known, is_end, tokens = _logs(given, piece, end)
            values = np.add.reduceat(given.mixed(known, by_word, given.mix), np.cumsum(tokens) - tokens)
            doc = np.repeat(np.arange(len(tokens)), tokens)
            seen = np.bincount(doc, known > 0, len(tokens)).astype(np.int64)
            logs = np.bincount(doc, np.log10(known + 1.0) * ((known > 0) | is_end), len(tokens))
            rare = (known == 0) & ~is_end
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_ids").flatten(), pa.array(piece.held), pa.array(tokens), pa.array(seen), pa.array(logs),
                 pa.array(values), _rare(doc[rare], words[rare], by_word[rare], len(tokens))],
                names=["doc_id", "held_out", "n_tokens", "seen", "logs", "score", "rare"],
            )

    schema = docs.select("doc_id", held_out().alias("held_out")).schema
    found = stored.map(scored, shared.with_fields(
        schema, n_tokens="long", seen="long", logs="double", score="double", rare="array<struct<word:long,logs:array<double>>>"
    ), SCORED_PIECES)
    found = shared.stored(found.withColumn("row", F.monotonically_increasing_id()))
    others = found.select("row", F.explode("rare").alias("rare")).select("row", "rare.word", "rare.logs")
    # scored as unknown so far: what the mixture gains by the count
    one = model.mix / (model.tokens + model.distinct + 1)
    gain = F.aggregate("logs", F.lit(0.0), lambda sum_, x: sum_ + F.log10(
        (one * (F.col("n") + 1) + (1 - model.mix) * F.exp(x)) / (one + (1 - model.mix) * F.exp(x))
    ))
    sums = others.join(counted, "word").groupBy("row").agg(
        F.sum(F.size("logs")).alias("more"), F.sum(F.size("logs") * F.log10(F.col("n") + 1.0)).alias("more_logs"), F.sum(gain).alias("gain")
    )
    norm = float(np.log10(model.tokens + model.distinct + 1))
    return found.join(sums, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("seen") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * F.lit(norm)).alias("base_score"),
        (F.col("score") + F.coalesce("gain", F.lit(0.0))).alias("score"),
    )
