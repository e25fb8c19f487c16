import math

import pytest

from tapflow.llm import mixing as X
from tests.llm.helpers import docs, odd_docs, prose


@pytest.fixture(scope="module")
def table(spark):
    parts = [docs(spark, [prose(1000 * k + i, 20 + i % 30) for i in range(n)], [1000 * k + i for i in range(n)], source=s) for k, (s, n) in enumerate((("big", 300), ("mid", 60), ("low", 20)))]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


def counted(table):
    return table.selectExpr("source", "size(split(text, ' ')) AS n_tokens")


def test_weights_meet_the_limit_on_repetition(table):
    rows = {r.source: r for r in X.weights(counted(table), max_repeats=1.5).collect()}
    total = sum(r.tokens for r in rows.values())
    assert sum(r.weight for r in rows.values()) == pytest.approx(1)
    repeats = {s: r.weight * total / r.tokens for s, r in rows.items()}
    assert max(repeats.values()) == pytest.approx(1.5, abs=1e-5) and max(repeats, key=repeats.get) == "low"
    powers = {s: math.log(r.weight / rows["big"].weight) / math.log(r.tokens / rows["big"].tokens) for s, r in rows.items() if s != "big"}
    assert powers["mid"] == pytest.approx(powers["low"])  # one exponent for all


def test_weights_meet_an_entropy(table):
    for target in (0.7, 0.9, 1.05):
        rows = X.weights(counted(table), max_repeats=None, target_entropy=target).collect()
        assert -sum(r.weight * math.log(r.weight) for r in rows) == pytest.approx(target, abs=1e-5)
    # no exponent from 0 to 1 is flat enough or sharp enough
    flat, given = (X.weights(counted(table), max_repeats=None, target_entropy=t).collect() for t in (5.0, 0.0))
    assert all(r.weight == pytest.approx(1 / 3) for r in flat)
    assert all(r.weight == pytest.approx(r.tokens / sum(x.tokens for x in given)) for r in given)


@pytest.mark.parametrize(("budget", "limit"), [(None, 1.5), (40_000, 5.0), (3_000, 2.0)])
def test_draws_are_a_permutation_up_to_the_budget(table, budget, limit):
    rows = X.draws(table, budget, limit, block_tokens=1000).collect()
    plan = {r.source: r for r in X.weights(counted(table), budget, limit).collect()}
    sizes = {r.doc_id: len(r.text.split()) for r in table.collect()}
    sources = {r.doc_id: r.source for r in table.collect()}
    for source, p in plan.items():
        own = [r for r in rows if r.source == source]
        for epoch in range(p.epochs):
            assert sorted(r.doc_id for r in own if r.epoch == epoch) == sorted(d for d, s in sources.items() if s == source)
        last = sorted((r for r in own if r.epoch == p.epochs), key=lambda r: r.sort_key)
        paid = sum(sizes[r.doc_id] for r in last)
        assert paid <= p.rest and p.rest - paid < max(sizes.values())
        assert len(own) == len({(r.doc_id, r.epoch) for r in own})
    blocks = {r.block for r in rows}
    assert blocks == set(range(max(blocks) + 1))
    full = [r for r in rows if r.block == 1]
    if budget != 3_000 and full:
        share = sum(r.n_tokens for r in full if r.source == "big") / sum(r.n_tokens for r in full)
        assert share == pytest.approx(plan["big"].weight, abs=0.15)


def test_mix_gives_the_drawn_rows(table):
    drawn = sorted(r.doc_id for r in X.draws(table, max_repeats=1.5).collect())
    mixed = X.mix(table, max_repeats=1.5)
    assert mixed.columns == table.columns and sorted(r.doc_id for r in mixed.collect()) == drawn


def test_odd_rows_and_empty_tables(spark):
    odd = odd_docs(spark)
    rows = X.draws(odd, max_repeats=3.0).collect()
    assert all(r.epoch >= 0 and r.block == 0 for r in rows)
    assert X.mix(odd).columns == odd.columns
    assert X.draws(odd.limit(0)).count() == 0 and X.mix(odd.limit(0)).count() == 0
    blank = docs(spark, ["", None, " "])
    assert sorted(r.doc_id for r in X.mix(blank).collect()) == [0, 1, 2]


def test_no_python_in_the_plan(table):
    plan = X.draws(table)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan and "NestedLoop" not in plan
