from itertools import combinations

import pytest

from tapflow.llm import url_filters as X

URLS = [
    ("http://Blog.Example.ORG/es/12?x=1#y", "blog.example.org", "/es/12"),
    ("https://example.org/en/15", "example.org", "/en/15"),
    ("https://example.org/en/2", "example.org", "/en/2"),
    ("https://shop.com/de/a", "shop.com", "/de/a"),
    ("https://shop.com/fr", "shop.com", "/fr"),
    ("https://x.net/", "x.net", "/"),
    ("https://org?q=1", "org", ""),
    ("a://b://c/d", "b:", "//c/d"),
    ("no scheme here/x", "", ""),
    (None, "", ""),
    ("ftp://ÉX.Org/Path/#frag", "Éx.org", "/Path/"),
]


def expected_rule(host, path):
    fitting = [(h + p, k) for k, h, p in X.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fitting, key=lambda r: len(r[0]), default=(None, None))


def pages(spark, urls, ids=None):
    ids = list(range(len(urls))) if ids is None else ids
    return spark.createDataFrame(list(zip(ids, urls, ["<p>x</p>"] * len(urls), ["clash"] * len(urls))),
                                 "page_id long, url string, html string, verdict string")


def test_host_path_and_fixed_rule_follow_the_contract(spark):
    rows = {r.page_id: r for r in X.judge(pages(spark, [u for u, _, _ in URLS])).collect()}
    for i, (url, host, path) in enumerate(URLS):
        r = rows[i]
        assert (r.host, r.path) == (host, path), url
        rule, verdict = expected_rule(host, path)
        assert r.rule == rule
        if rule is not None:
            assert r.verdict == verdict
        else:
            assert r.verdict in ("allow", "block")


def brute_force(labelled, everyone, min_support, min_confidence):
    """All token sets of every labelled page counted by hand; rules with a label as consequent."""
    n = len(labelled)
    count = {}
    for items, label in labelled:
        items = sorted(set(items))
        for k in range(len(items) + 1):
            for subset in combinations(items, k):
                count[subset] = count.get(subset, 0) + 1
                count[(subset, label)] = count.get((subset, label), 0) + 1
    rules = []
    for key, c in count.items():
        if isinstance(key, tuple) and len(key) == 2 and isinstance(key[1], str) and isinstance(key[0], tuple):
            subset, label = key
            if subset and c >= min_support * n and c / count[subset] >= min_confidence:
                rules.append((set(subset), label, c / count[subset], c / n))
    out = {}
    for row, items in everyone:
        firing = [(conf, sup, len(s), label == "block", label) for s, label, conf, sup in rules if s <= set(items)]
        out[row] = max(firing)[-1] if firing else None
    return out


def test_mined_verdicts_equal_brute_force(spark):
    hosts = ["a.example.org", "b.example.org", "shop.com", "m.shop.com", "x.net", "y.example.net", "www.org"]
    langs = ["es", "en", "fr", "de"]
    urls = [f"https://{hosts[i % 7]}/{langs[(i // 7) % 4]}/{i % 13}" + ("?page=2" if i % 5 == 0 else "") for i in range(120)]
    table = pages(spark, urls)
    judged = X.judge(table, min_support=0.05, min_confidence=0.8).collect()
    parsed = X._parsed(table, X.RULES).select("page_id", "tokens", "_label").collect()
    truth = brute_force([(r.tokens, r._label) for r in parsed if r._label], [(r.page_id, r.tokens) for r in parsed], 0.05, 0.8)
    assert {r.page_id: r.mined_verdict for r in judged} == truth
    assert any(v == "block" for k, v in truth.items() if expected_rule(*[(r.host, r.path) for r in judged if r.page_id == k][0])[0] is None)


def test_nulls_repeats_empty_and_no_labels(spark):
    odd = pages(spark, [None, None, "https://x.net/a", "https://x.net/a", ""], [None, 1, 1, 1, 2])
    rows = X.judge(odd).collect()
    assert len(rows) == 5 and all(r.verdict == "allow" and r.rule is None for r in rows)
    assert X.judge(pages(spark, [])).count() == 0


def test_join_path_equals_the_constant_index(spark, monkeypatch):
    urls = [f"https://{h}/{lang}/{i}" for i, (h, lang) in enumerate((h, l) for h in ("a.com", "b.org", "example.org", "c.net") for l in ("en", "de", "fr", "es"))] * 4
    table = pages(spark, urls)
    small = sorted((r.page_id, r.verdict, r.mined_verdict, r.confidence) for r in X.judge(table, min_support=0.05).collect())
    monkeypatch.setattr(X, "BROADCAST_ITEMS", -1)
    large = sorted((r.page_id, r.verdict, r.mined_verdict, r.confidence) for r in X.judge(table, min_support=0.05).collect())
    assert small == large and any(m is not None for _, _, m, _ in small)
