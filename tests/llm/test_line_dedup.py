import collections
import random

import numpy as np
import pyarrow as pa

from tapflow.llm import line_dedup as X, words as W
from tests.llm.helpers import docs, odd_docs, prose


def test_lines_are_those_with_words():
    texts = ["a b\n\n  c  \r\n", "", "\n", "x", " \t\ny z\x0b\n", "é b\nc"]
    flat = W.flat(pa.array(texts))
    hashed, counts, first = X.lines_of(flat)
    assert [counts[a:b].tolist() for a, b in zip(first, first[1:])] == [[2, 1], [], [], [1], [2], [1, 1]]
    assert hashed[1] == hashed[-1] and len(set(hashed.tolist())) == len(hashed) - 1


def test_alignment_is_a_common_subsequence_anchored_in_unique_lines():
    rnd = random.Random(5)
    for _ in range(400):
        a, b = ([rnd.randrange(12) for _ in range(rnd.randrange(14))] for _ in "ab")
        pairs = X.aligned(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(i < k and j < m for (i, j), (k, m) in zip(pairs, pairs[1:]))
    unique = [5, 1, 2, 3, 9]
    assert X.aligned(unique, [7, 1, 2, 3, 8]) == [(1, 1), (2, 2), (3, 3)]
    assert X.aligned([1, 2, 3], [3, 1, 2]) == [(0, 1), (1, 2)]
    assert X.aligned([4, 4, 1], [4, 4, 1]) == [(0, 0), (1, 1), (2, 2)] and X.aligned([], [1]) == []


def expected(rows, min_words=X.MIN_WORDS):
    """Places to delete of each (id, text), by the rule on all of its partners."""
    lines = {r: [x.strip(X._BLANK) for x in r[1].split("\n") if x.strip(X._BLANK)] for r in rows}
    holders = collections.defaultdict(list)
    for r in rows:
        for x in dict.fromkeys(lines[r]):
            holders[x].append(r)
    shared = {r: [(n, x, len([w for w in x.split(" ") if w])) for n, x in enumerate(lines[r]) if len(holders[x]) > 1] for r in rows}
    out = {}
    for n, r in enumerate(rows):
        partners = set()
        for x in set(lines[r]):
            before = [h for h in holders[x] if rows.index(h) < n]
            partners |= set(before if len(holders[x]) <= X.RARE else before[:1])
        out[r] = {p for partner in partners for p in X.doomed(shared[partner], shared[r], min_words)}
    return out


def test_equal_to_brute_force(spark):
    rnd = random.Random(3)
    pool = [prose(i, rnd.choice([1, 3, 8, 20])) for i in range(60)]
    texts = ["\n".join(rnd.choice(pool) if rnd.random() < 0.5 else prose(1000 + 50 * d + k, 6) for k in range(12)) for d in range(40)]
    passage = "\n".join(prose(5000 + k, 9) for k in range(7))
    texts += [f"{prose(6000 + i, 10)}\n\n{passage.replace(chr(10), chr(10) * 2)}\n{prose(7000 + i, 10)}" for i in range(9)] + [texts[0]] * 3
    rows = list(enumerate(texts))
    cut = expected(rows)
    found = {r.doc_id: r for r in X.without_repeats(docs(spark, texts)).collect()}
    for r in rows:
        assert found[r[0]].n_removed == len(cut[r]) and found[r[0]].text == (X._without(r[1], cut[r]) if cut[r] else r[1])
    assert passage.replace("\n", "\n\n") in found[40].text
    assert all(passage.split("\n")[3] not in found[i].text for i in range(41, 49))
    assert all(not found[i].text.strip() for i in range(50, 52))


def in_any_earlier(texts, min_words=X.MIN_WORDS):
    """Places in runs of so many words that any earlier text has."""
    split = [[x.strip(X._BLANK) for x in t.split("\n") if x.strip(X._BLANK)] for t in texts]
    out = []
    for d, own in enumerate(split):
        gone = set()
        for other in split[:d]:
            for i in range(len(other)):
                for j in range(len(own)):
                    n = 0
                    while i + n < len(other) and j + n < len(own) and other[i + n] == own[j + n]:
                        n += 1
                    if sum(len(x.split()) for x in own[j : j + n]) >= min_words:
                        gone |= set(range(j, j + n))
        out.append(gone)
    return out


def test_equal_to_brute_force_over_all_earlier_documents(spark):
    a, b, c = (prose(n, 9) for n in (1, 2, 3))
    short = ["one", "two", "three four", "five", "six"]
    texts = [f"{a}\n{b}\n{a}", f"{b}\n{prose(10, 9)}\n{a}\n{a}"]  # twice among others, in another order
    texts += [f"{x}\n{prose(20 + n, 9)}" for n, x in enumerate(short)]  # each short line has another first holder
    texts += [f"{c}\n{prose(30 + n, 9)}\n{a}\n{b}" for n in range(6)]
    texts += ["\n".join([prose(40 + n, 9), *short, prose(50 + n, 9)]) for n in range(4)]
    rnd = random.Random(4)
    pool = [*short, a, b, c, *(prose(60 + n, rnd.choice([1, 2, 3, 6])) for n in range(6))]
    texts += ["\n".join(rnd.choice(pool) if rnd.random() < 0.8 else prose(100 + 50 * d + n, 4) for n in range(9)) for d in range(40)]
    found = {r.doc_id: r for r in X.without_repeats(docs(spark, texts)).collect()}
    for n, (text, gone) in enumerate(zip(texts, in_any_earlier(texts), strict=True)):
        assert found[n].text == (X._without(text, gone) if gone else text) and found[n].n_removed == len(gone)


def test_odd_rows_and_empty_tables(spark):
    odd = odd_docs(spark).unionAll(docs(spark, ["one two three four five six\nnew line"] * 2, [200, 201]))
    rows = X.without_repeats(odd).collect()
    assert len(rows) == odd.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[200].n_removed == 0 and (by_id[201].text, by_id[201].n_removed, by_id[201].n_lines) == ("", 2, 2)
    assert [r.text for r in rows if r.doc_id == 100] == ["same text"] * 2
    assert X.without_repeats(odd.limit(0)).count() == 0
    assert np.array(X.lines_of(W.flat(pa.array([], pa.string())))[2]).tolist() == [0]
