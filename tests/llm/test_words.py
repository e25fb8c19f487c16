import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tapflow.llm import subwords, words as W
from tests.llm.helpers import ODD

ALPHABET = " \n.,'abAZ1é \t-\x1c日😀@"


def random_texts(n=3000):
    rnd = random.Random(3)
    return ODD + ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randrange(40))) for _ in range(n)]


@pytest.mark.parametrize(("members", "pattern"), [(W.ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), (W.NOT_SPACE, r"[^\x20\x09-\x0D]+")])
def test_words_are_those_of_the_pattern(members, pattern):
    texts = random_texts()
    flat = W.flat(pa.array(texts))
    data = W.LOWER[flat.data]
    found = W.words_of(W.Flat(data, flat.offsets), members)
    raw = data.tobytes()
    lower = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
    for i, text in enumerate(texts):
        own = range(found.first[i], found.first[i + 1])
        assert [raw[found.starts[w] : found.ends[w]].decode() for w in own] == re.findall(pattern, text.translate(lower))


def test_equal_words_have_equal_hashes_wherever_they_stand(monkeypatch):
    monkeypatch.setattr(W, "BLOCK", 64)
    texts = random_texts()
    flat = W.flat(pa.array(texts))
    found = W.words_of(flat, W.NOT_SPACE)
    raw = flat.data.tobytes()
    by_word: dict[bytes, int] = {}
    for s, e, h in zip(found.starts, found.ends, W.hashes(flat.data, found.starts, found.ends)[0], strict=True):
        assert by_word.setdefault(raw[s:e], int(h)) == int(h)
    assert len(set(by_word.values())) == len(by_word)


def test_nulls_slices_and_pieces():
    column = pa.array(["ab", None, "", "cde", "f"]).slice(1)
    flat = W.flat(column)
    assert flat.data.tobytes() == b"cdef" and flat.offsets.tolist() == [0, 0, 0, 3, 4]
    assert [(at, len(p.offsets) - 1) for at, p in W.pieces(flat, 2)] == [(0, 2), (2, 1), (3, 1)]
    assert W.flat(pa.array([], pa.string())).offsets.tolist() == [0]
    assert len(W.words_of(W.flat(pa.array([None, ""], pa.string())), W.ALNUM).starts) == 0


def test_subword_ids_equal_the_tokenizers():
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    texts = [*random_texts(), "<|endoftext|> a", "it's. he'll,x", "a  b \n c\n\nd", "1.5, 2"]
    assert subwords.encode(texts, path) == [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]


def test_kinds_and_runs_of_pieces_are_found_by_arrays(monkeypatch):
    words = [t for t in random_texts(600) if t] + [" a", "a", " ", "\x7f", " \x7f", " é", "é", " \x85", "\u2028a", " \u3000", "日", " 😀", "a b", "  a"]
    texts = W.flat(pa.array(words))
    starts, sizes = texts.offsets[:-1], np.diff(texts.offsets)
    decoded = []
    monkeypatch.setattr(subwords, "str", lambda *a: decoded.append(str(*a)) or decoded[-1], raising=False)
    spaced, plain, odd = subwords._kinds(texts.data, starts, sizes)
    for i, w in enumerate(words):
        rest = w.removeprefix(" ")
        solid = rest != "" and " " not in rest and rest.isprintable()
        assert i in (odd if not solid else plain if rest is w else spaced)
    assert len(spaced) + len(plain) + len(odd) == len(words)
    assert not [x for x in decoded if x and x.isascii() and x.isprintable() and " " not in x]  # ordinary words aren't looked at one by one
    monkeypatch.setattr(subwords, "AT_ONCE", 10)
    sizes = np.array([3, 3, 3, 3, 25, 1, 2, 30, 40, 4])
    assert [sizes[r].tolist() for r in subwords._runs(sizes)] == [[3, 3, 3, 3], [25], [1, 2], [30], [40], [4]]
    assert list(subwords._runs(sizes[:0])) == []


def test_distinct_values_with_a_place_and_numbers():
    for values in (np.array([5, 1, 5, 2, 1], np.uint64), np.zeros(0, np.uint64), np.random.default_rng(0).integers(0, 50, 1000).astype(np.uint64)):
        unique, place, number = W.distinct(values)
        expected, inverse = np.unique(values, return_inverse=True)
        assert unique.tolist() == expected.tolist() == values[place].tolist() and number.tolist() == inverse.tolist()


def test_encoder_forgets_and_goes_on(monkeypatch):
    monkeypatch.setattr(subwords, "REMEMBERED_BYTES", 2_000)  # about 50 pieces
    own = subwords.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = random_texts(300)
    for begin in range(0, 300, 20):
        part = texts[begin : begin + 20]
        ids, counts = own.texts(W.flat(pa.array(part)))
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [
            own.tokenizer.encode(t, add_special_tokens=False).ids for t in part
        ]


def test_shared_folders_are_qualified_and_recorded_per_thread(spark):
    import threading

    from tapflow.llm.shared import recorded, shared_folder

    seen: dict[str, list[str]] = {}

    def query(name):
        with recorded() as paths:
            shared_folder(spark)
            shared_folder(spark)
        seen[name] = paths

    threads = [threading.Thread(target=query, args=(n,)) for n in "ab"]
    with recorded() as outer:
        for t in threads:
            t.start()
        for t in threads:
            t.join()
    assert outer == [] and len(seen["a"]) == len(seen["b"]) == 2 and not set(seen["a"]) & set(seen["b"])
    assert all(p.startswith("file:/") for p in seen["a"])  # qualified by Hadoop, not by hand
