import base64
import hashlib

import numpy as np
import pyarrow as pa
import pytest

from tapflow.llm import fingerprints as X, words as W
from tests.llm.helpers import docs, edited, odd_docs, prose


def sets(texts):
    return X.signatures(W.flat(pa.array(texts)))


def test_edited_texts_and_next_documents(spark):
    texts = [("the " + prose(i, 5 + 9 * i)).replace("w1", "é") for i in range(40)] + ["", None, "a", "abc", "das ist gut so"]
    ids = [7 * i % 101 for i in range(len(texts))]
    order = sorted(zip(ids, (t or "" for t in texts)))
    for size in (X.SHARD_BYTES, 1500, 1):
        rows = {r.doc_id: r for r in X.edited_and_next(docs(spark, texts, ids), size).collect()}
        assert len(rows) == len(texts)
        for n, (doc_id, text) in enumerate(order):
            following = order[(n + 1) % len(order)][1]
            k = len(text) // 4
            changed = text[: len(text) - k] + following[:k]
            own, other, after = sets([text, changed, following])
            r = rows[doc_id]
            assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
            assert (r.fingerprint, r.edited_fingerprint) == (X.printed(own), X.printed(other))
            assert r.near_edited == X.likeness(own, other) and r.near_next == X.likeness(own, after)


def test_signatures_are_anchors_with_two_content_words():
    a, b, c = sets(["the red fox and a blue dog ran", "THE red, fox!", "the the red fox"])
    assert len(a) == 3 and set(b) <= set(a) and set(c) == set(b)
    assert len(sets(["Lo siento mucho"])[0]) == 1 and len(sets(["x y"])[0]) == 1 and len(sets([""])[0]) == 0
    table = " | ".join(f"c{i}" for i in range(60))
    assert X.likeness(*sets([table, table + " and the rest of it is a long text"])) > 0.7


def test_a_text_has_its_fingerprint_wherever_it_stands():
    texts = [prose(i, 40).replace("w2", "the ") for i in range(20)] + ["", "one"]
    for text, together in zip(texts, sets(texts), strict=True):
        assert (sets([text])[0] == together).all()


def test_likeness_and_length_classes():
    rng = np.random.default_rng(1)
    for _ in range(300):
        a, b = (np.unique(rng.integers(0, 60, rng.integers(0, 50))).astype(np.uint32) for _ in "ab")
        exact = len(set(a) & set(b)) / len(set(a) | set(b)) if len(a) + len(b) else 1.0
        assert X.likeness(a, b) == pytest.approx(exact)
        if exact >= 0.8:
            assert X.likeness(a, b, 0.8) == pytest.approx(exact) and abs(X.length_class(len(a)) - X.length_class(len(b))) <= 1
    assert base64.b64decode(X.printed(np.array([1, 2], "<u4"))) == b"\1\0\0\0\2\0\0\0"


def test_odd_rows_and_empty_tables(spark):
    odd = odd_docs(spark)
    rows = X.edited_and_next(odd).collect()
    assert len(rows) == odd.count() and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert X.edited_and_next(odd.limit(0)).count() == 0
    (alone,) = X.edited_and_next(docs(spark, ["the only one here"])).collect()
    assert alone.near_next == 1.0
    assert edited("a b", 1)
