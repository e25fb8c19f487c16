"""Subword ids of whole texts by a public byte-level BPE tokenizer, each distinct piece encoded once.

The tokenizer cuts a text into pieces before it merges bytes, and some of its borders can be told from two
neighbouring characters: before a lone space or line break between two characters that are no white space, behind
such a line break, and between an ASCII letter and a full stop or comma. Cutting there first changes no id, and most
pieces then occur many times.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from tapflow.llm import words as W

#: Bytes of remembered pieces (their ids, hashes, places and counts) above which a worker forgets them all.
REMEMBERED_BYTES = 64 << 20
#: Characters of new pieces that the tokenizer is given at once: it holds many bytes for each of them.
AT_ONCE = 1 << 16
_SPACE, _BREAK = 32, 10

_solid = W.byte_class((33, 126))
_ascii = _solid & (np.arange(256) < 128)
_letter = np.zeros(256, bool)
_letter[65:91] = _letter[97:123] = True


def _not_space(data: np.ndarray) -> np.ndarray:
    """Bytes of characters that certainly are no white space; for a rare few that may be, False."""
    solid = _solid[data]
    lead = np.flatnonzero((data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3)) | (data == 0xEF))
    if len(lead):
        n = len(data)
        second, third = data[np.minimum(lead + 1, n - 1)], data[np.minimum(lead + 2, n - 1)]
        first = data[lead]
        two = lead[(first == 0xC2) & ((second == 0x85) | (second == 0xA0))]
        three = lead[
            ((first == 0xE1) & (((second == 0x9A) & (third == 0x80)) | ((second == 0xA0) & (third == 0x8E))))
            | ((first == 0xE2) & ((second == 0x80) | ((second == 0x81) & (third >= 0x9F))))
            | ((first == 0xE3) & (second == 0x80) & (third == 0x80))
            | ((first == 0xEF) & (second == 0xBB) & (third == 0xBF))
        ]
        for at, size in ((two, 2), (three, 3)):
            for j in range(size):
                solid[np.minimum(at + j, n - 1)] = False
    return solid


def cut(texts: W.Flat) -> np.ndarray:
    """Where pieces begin; each non-empty text begins one."""
    data, n = texts.data, len(texts.data)
    begins = np.zeros(n + 1, bool)
    if n > 2:
        solid = _not_space(data)
        lone = np.zeros(n, bool)
        lone[1:-1] = ((data[1:-1] == _SPACE) | (data[1:-1] == _BREAK)) & solid[:-2] & solid[2:]
        edge = texts.offsets[(texts.offsets > 0) & (texts.offsets < n)]
        lone[edge] = False  # first of a text
        lone[edge - 1] = False  # last of a text
        begins[:n] = lone
        begins[1:] |= lone & (data == _BREAK)
        stop = (data[1:] == 46) | (data[1:] == 44)
        begins[1:n] |= stop & _letter[data[:-1]]
    begins[texts.offsets] = True
    begins[n] = False
    return np.flatnonzero(begins)


def _kinds(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which pieces are a space and then printable characters that are no spaces, which only such characters, and the others."""
    spaced = data[starts] == _SPACE
    inside = np.append(0, np.cumsum(_ascii[data[W.ragged(starts, sizes)]]))
    last = np.cumsum(sizes)
    solid = (inside[last] - inside[last - sizes] == sizes - spaced) & (sizes > spaced)
    for i in np.flatnonzero(~solid).tolist():
        rest = str(data[starts[i] + spaced[i] : starts[i] + sizes[i]], "utf-8", "surrogatepass")
        solid[i] = rest != "" and " " not in rest and rest.isprintable()  # no white space but a space is printable
    return np.flatnonzero(solid & spaced), np.flatnonzero(solid & ~spaced), np.flatnonzero(~solid)


def _runs(sizes: np.ndarray) -> Iterator[slice]:
    """Pieces of these sizes in runs of about AT_ONCE bytes; a longer piece is a run alone."""
    long = np.cumsum(sizes > AT_ONCE)
    number = (np.cumsum(sizes) - sizes) // AT_ONCE + long + np.append(0, long)[:-1]
    borders = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(sizes)]
    for first, last in zip(borders, borders[1:], strict=False):
        if first < last:
            yield slice(first, last)


class Encoder:
    """Ids of texts; remembers pieces that it has seen."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        vocabulary = self.tokenizer.get_vocab()
        self.size = max(vocabulary.values()) + 1
        self.opens = np.zeros(self.size, bool)  # begins with a space
        for token, number in vocabulary.items():
            self.opens[number] = token.startswith("Ġ")
        (self.line_break,) = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.int32)

    def pieces(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces one after the other, and how many each has."""
        hashed = W.hashes(data, starts, ends)[0]
        unique, index, inverse = W.distinct(hashed)
        at = np.searchsorted(self.known, unique)
        new = np.ones(len(unique), bool)
        inside = at < len(self.known)
        new[inside] = self.known[at[inside]] != unique[inside]
        if new.any():
            if self.nbytes() + 32 * int(new.sum()) > REMEMBERED_BYTES:
                self._forget()
                new[:] = True
            self._learn(data, unique[new], starts[index[new]], ends[index[new]])
            at = np.searchsorted(self.known, unique)
        own = at[inverse]
        counts = self.counts[own]
        return self.pool[W.ragged(self.at[own], counts)], counts

    def nbytes(self) -> int:
        return self.known.nbytes + self.at.nbytes + self.counts.nbytes + self.pool.nbytes

    def _learn(self, data: np.ndarray, hashed: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        # Only the new pieces are copied out of the text, not the whole text.
        sizes = ends - starts
        spaced, plain, odd = _kinds(data, starts, sizes)
        found, n_ids, which = [self.pool], [], []
        for run in _runs(sizes[spaced]):
            own = spaced[run]
            ids = self._ids(str(data[W.ragged(starts[own], sizes[own])], "utf-8", "surrogatepass"))
            begins = np.flatnonzero(self.opens[ids])
            begins[0] = 0
            found.append(ids)
            n_ids.append(np.diff(begins, append=len(ids)))
            which.append(own)
        for run in _runs(sizes[plain]):
            own = plain[run]
            lines = np.full(int(sizes[own].sum()) + len(own) - 1, _BREAK, np.uint8)
            lines[W.ragged(np.cumsum(sizes[own] + 1) - sizes[own] - 1, sizes[own])] = data[W.ragged(starts[own], sizes[own])]
            ids = self._ids(str(lines, "utf-8", "surrogatepass"))
            marks = ids == self.line_break
            found.append(ids[~marks])
            n_ids.append(np.diff(np.flatnonzero(marks), prepend=-1, append=len(ids)) - 1)
            which.append(own)
        for run in _runs(sizes[odd]):
            own = odd[run]
            words = [str(data[a:b], "utf-8", "surrogatepass") for a, b in zip(starts[own].tolist(), ends[own].tolist(), strict=True)]
            parts = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
            found.append(np.array([x for part in parts for x in part], np.int32))
            n_ids.append(np.array([len(part) for part in parts], np.int64))
            which.append(own)
        for run, n in zip(which, n_ids, strict=True):
            if len(run) != len(n):
                raise ValueError("the tokenizer didn't cut between the pieces")
        order = np.argsort(np.concatenate(which))  # as the hashes come: sorted
        counts = np.concatenate(n_ids)
        at = len(self.pool) + np.cumsum(counts) - counts
        self.pool = np.concatenate(found).astype(np.int32, copy=False)
        into = np.searchsorted(self.known, hashed)
        self.known = np.insert(self.known, into, hashed)
        self.at = np.insert(self.at, into, at[order])
        self.counts = np.insert(self.counts, into, counts[order])

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)

    def texts(self, texts: W.Flat) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each has."""
        if not len(texts.data):
            return np.zeros(0, np.int32), np.zeros(len(texts.offsets) - 1, np.int64)
        starts = cut(texts)
        ids, counts = self.pieces(texts.data, starts, np.append(starts[1:], len(texts.data)))
        sums = np.append(0, np.cumsum(counts))[np.searchsorted(starts, texts.offsets)]
        return ids, np.diff(sums)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    return Encoder(path)


def encode(texts: list[str], path: str) -> list[list[int]]:
    """Ids of some texts."""
    ids, counts = encoder(path).texts(W.flat(pa.array(texts, pa.string())))
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] if texts else []
