import collections
import re

import numpy as np
import pyarrow as pa
import pytest

from tapflow.llm import graphs, minhash as M, words as W
from tests.llm.helpers import docs, edited, odd_docs, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingles(text):
    w = WORD.findall((text or "").lower())
    return collections.Counter(tuple(w[p : p + 5]) for p in range(max(1, len(w) - 4))) if w else collections.Counter()


def brute(texts):
    """Smallest index of each text's class."""
    sets, parent = [shingles(t) for t in texts], list(range(len(texts)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if (texts[i] or "") == (texts[j] or "") or a and b and (a & b).total() >= 0.8 * (a | b).total():
                x, y = sorted((top(i), top(j)))
                parent[y] = x
    return [top(i) for i in range(len(texts))]


def test_classes_equal_brute_force(spark):
    texts = [prose(i, 120) for i in range(15)]
    texts += [edited(texts[i % 5], n, 10 * i + n) for i in range(10) for n in (1, 3, 6)]
    texts += texts[:4] + [prose(1, 120).upper(), "two words", "two words", "Two words.", "", None, "!!!"]
    rows = M.classes(docs(spark, texts)).collect()
    assert [r.class_id for r in sorted(rows, key=lambda r: r.doc_id)] == brute(texts)
    sizes = collections.Counter(r.class_id for r in rows)
    assert all(r.class_size == sizes[r.class_id] for r in rows)
    kept = M.keep_one(docs(spark, texts)).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(brute(texts)))


def test_kept_rows_are_joined_in_one_way_at_every_size(spark):
    texts = [prose(i % 40, 40) for i in range(90)] + ["", None, "", "two words"]
    kept = M.keep_one(docs(spark, texts).unionAll(docs(spark, texts[:3])).repartition(7))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(brute(texts)))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan.split("Initial Plan")[0]


def test_large_group_of_near_copies(spark):
    """Copies of one text whose likeness to each other lies on both sides of the limit."""
    base = prose(7, 150)
    texts = [edited(base, n % 9, n) for n in range(60)] + [prose(900 + i, 30) + " " + prose(5, 25) for i in range(20)]
    rows = sorted(M.classes(docs(spark, texts)).collect(), key=lambda r: r.doc_id)
    assert [r.class_id for r in rows] == brute(texts)


def test_likeness_is_weighted_jaccard():
    texts = [prose(1, 50), "a b c d e " * 20, "x", "", edited(prose(2, 80), 4)]
    others = [edited(texts[0], 3), "a b c d e " * 7, "x", "", prose(2, 80)]
    found = M.likeness(W.flat(pa.array(texts)), W.flat(pa.array(others)))
    for value, a, b in zip(found, map(shingles, texts), map(shingles, others), strict=True):
        assert value == pytest.approx((a & b).total() / max(1, (a | b).total()))


def test_signatures_estimate_the_similarity_of_any_weights():
    rng = np.random.default_rng(4)
    element = rng.integers(0, 2**63, 300).astype(np.uint64)
    a, b = rng.gamma(0.5, 3, 300), rng.gamma(0.5, 3, 300)
    b[:200] = a[:200]
    k = 4096
    owner = np.zeros(300, np.int64)
    x, y = (M.signatures(element, owner, w, 1, k)[0] for w in (a, b))
    assert (x == y).mean() == pytest.approx(np.minimum(a, b).sum() / np.maximum(a, b).sum(), abs=0.03)
    assert (M.signatures(element, owner, a, 1, k)[0] == x).all()
    assert (M.signatures(element[:0], owner[:0], a[:0], 2, 8) == 0).all()


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3), (200, 201), (200, 201)]
    found = {r.node: r.component for r in graphs.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)} | {200: 200, 201: 200}
    assert graphs.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_rows_and_empty_tables(spark):
    odd = odd_docs(spark)
    rows = M.classes(odd).collect()
    assert len(rows) == odd.count()
    by_id = collections.defaultdict(set)
    for r in rows:
        by_id[r.doc_id].add(r.class_id)
    assert by_id[100] == {100} and by_id[101] == {101} and by_id[None] == {0} and by_id[102] == {0}
    kept = M.keep_one(odd)
    assert kept.columns == odd.columns
    assert kept.where("doc_id = 100").count() == 1 and kept.where("coalesce(text, '') = ''").count() == 1
    assert M.classes(odd.limit(0)).count() == 0 and M.keep_one(odd.limit(0)).count() == 0
