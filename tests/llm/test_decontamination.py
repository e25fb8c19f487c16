import hashlib
import random
import re

import numpy as np

from tapflow.llm import decontamination as D
from tests.llm.helpers import docs, edited, odd_docs, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(texts, items):
    windows: dict[tuple, set] = {}
    for name, text in items:
        w = words(text)
        for p in range(max(1, len(w) - 12)) if w else ():
            windows.setdefault(tuple(w[p : p + 13]), set()).add(name)
    out = []
    for text in texts:
        w, hit, names = words(text), set(), set()
        for size in {len(k) for k in windows}:
            for p in range(len(w) - size + 1):
                if found := windows.get(tuple(w[p : p + size])):
                    hit |= set(range(p, p + size))
                    names |= found
        out.append((len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def cases():
    items = [(str(i), prose(i, 30, 40)) for i in range(12)] + [("12", "only four words here"), ("13", ""), ("14", None), ("15", prose(3, 30, 40))]
    texts = [prose(100 + i, 200, 40) for i in range(10)] + [None, "", "only FOUR words, here!", "only four words"]
    texts += [f"{prose(50, 20)} {items[i][1]} {prose(51, 300)}" for i in range(4)]
    texts += [f"{prose(9, 5)} {' '.join((items[5][1] or '').split()[4:18])} {prose(8, 500)}", items[2][1] * 1]
    return texts, items


def test_equal_to_brute_force(spark, monkeypatch):
    texts, items = cases()
    table = spark.createDataFrame(items, "item_id string, text string")
    for shard, block in ((D.SHARD_BYTES, D.BLOCK_ITEMS), (2000, 3)):
        monkeypatch.setattr(D, "SHARD_BYTES", shard)
        monkeypatch.setattr(D, "BLOCK_ITEMS", block)
        found = {r.doc_id: tuple(r)[1:] for r in D.contamination(docs(spark, texts), table).collect()}
        assert [found[i] for i in range(len(texts))] == brute(texts, items)
    kept = {r.doc_id for r in D.decontaminate(docs(spark, texts), table).collect()}
    assert kept == {i for i, x in found.items() if not x[-1]}


def test_suffix_array_orders_all_suffixes():
    rng = np.random.default_rng(2)
    for top, depth in ((2, 50), (3, 7), (200, 30)):
        ids = rng.integers(0, top + 1, 400)

        def suffix(p, ids=ids, depth=depth):
            s = ids[p : p + depth].tolist()
            return s[: s.index(0)] if 0 in s else s

        place = D.suffix_array(ids, depth)
        assert sorted(place) == np.flatnonzero(ids).tolist()
        ordered = [suffix(p) for p in place]
        assert ordered == sorted(ordered)


def test_longest_matches_and_their_places(spark):
    texts, items = cases()
    rows = D.longest_matches(docs(spark, texts), spark.createDataFrame(items, "item_id string, text string")).collect()
    split, by_name = [words(t) for t in texts], {n: words(t) for n, t in items}
    rnd = random.Random(1)
    assert rows
    for r in rnd.sample(rows, 60):
        suffix = by_name[r.item_id][r.item_word :]
        assert split[r.doc_id][r.doc_word : r.doc_word + r.length] == suffix[: r.length]
        longest = max(
            next((n for n, (x, y) in enumerate(zip(w[p:], suffix)) if x != y), min(len(w) - p, len(suffix)))
            for w in split for p in range(len(w))
        )
        assert r.length == longest


def test_odd_rows_and_empty_tables(spark):
    odd = odd_docs(spark)
    items = spark.createDataFrame([(None, "same text", 1), (1, "same text", 1), (2, None, 1)], "item_id int, text string, n_words int")
    rows = D.contamination(odd, items).collect()
    assert len(rows) == odd.count()
    assert sorted((r.n_hit, r.n_items) for r in rows if r.n_hit) == [(2, 2), (2, 2)]
    assert D.decontaminate(odd, items).columns == odd.columns
    none = spark.createDataFrame([], items.schema)
    assert not [r for r in D.contamination(odd, none).collect() if r.contaminated]
    assert D.contamination(odd.limit(0), items).count() == 0
    assert edited("a b c", 1) != "a b c"
