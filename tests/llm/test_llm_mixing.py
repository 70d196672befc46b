import math
from collections import Counter

import pytest
from llm_cases import ROWS, edge_docs, no_docs

from normwatch.llm import mixing as mx


def test_exponents_meet_their_targets():
    shares = [0.6, 0.3, 0.08, 0.02]
    for target in (0.3, 0.7, 1.2):
        a = mx.exponent_for_entropy(shares, target)
        assert abs(mx.entropy(mx.tempered(shares, a)) - target) < 1e-6
    assert mx.exponent_for_entropy(shares, 5.0) < 1e-6
    tokens = [6000, 3000, 800, 200]
    for budget in (None, 9000.0):
        a = mx.exponent_for_repeats(tokens, 3.0, budget)
        w = mx.tempered(shares, a)
        size = mx.whole_budget(tokens, w) if budget is None else budget
        assert abs(max(x * size / t for x, t in zip(w, tokens)) - 3.0) < 1e-6
    assert mx.exponent_for_repeats([500, 500], 2.0, None) < 1e-6


def test_budgets_add_up():
    plan = mx.plan_mixture([("a", 600), (None, 300), ("b", 100)], budget=777)
    assert sum(plan.budgets) == 777 and plan.sources == ["a", "b", None]
    whole = mx.plan_mixture([("a", 600), ("b", 100)], max_repeats=2.0)
    assert whole.budgets[0] == 600 and whole.budgets[1] == 200
    assert mx.plan_mixture([]).weights == []


def docs_of(spark, n=900):
    rows = [(i, "w " * (1 + i % 9), "big" if i % 3 else ("mid" if i % 2 else "low")) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4), rows


@pytest.mark.parametrize("options", [{}, {"budget": 3000}, {"target_entropy": 1.0, "budget": 2500}])
def test_passes_and_budgets(spark, options):
    docs, rows = docs_of(spark)
    plain = {i: len(t.split()) + 1 for i, t, _ in rows}
    of = {i: s for i, _, s in rows}
    totals = Counter()
    for i in plain:
        totals[of[i]] += plain[i]
    plan = mx.plan_mixture(list(totals.items()), **options)
    got = mx.mix(docs, block_tokens=200, **options).collect()
    taken = Counter((r["doc_id"], r["mix_pass"]) for r in got)
    assert max(taken.values()) == 1
    used = Counter()
    for r in got:
        assert r["n_tokens"] == plain[r["doc_id"]]
        used[r["source"]] += r["n_tokens"]
    for source, total, budget in zip(plan.sources, plan.tokens, plan.budgets):
        assert budget - 10 < used[source] <= budget
        full = budget // total
        for i in plain:
            if of[i] == source:
                assert all(taken[i, k] == 1 for k in range(full)) and taken[i, full + 1] == 0
    if not options:
        assert {i for i, _ in taken} == set(plain)
    # Every pass has its own permutation of the blocks, and stops in one of them.
    order = {}
    for r in got:
        order.setdefault((r["source"], r["mix_pass"]), {})[r["mix_rank"]] = r["mix_block"]
        assert 0 <= r["mix_at"] < 1
    assert all(sorted(x) == list(range(len(x))) for x in order.values())


@pytest.mark.parametrize("seed", range(1, 7))
def test_budgets_are_met_without_ids(spark, seed):
    rows = [
        (None if i % 3 == 0 else i % 40, f"x{i} " + "w " * (i % 9), "big" if i % 5 else "small")
        for i in range(1500)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    totals = Counter()
    for _, text, source in rows:
        totals[source] += len(text.split()) + 1
    plan = mx.plan_mixture(list(totals.items()), budget=3000)
    used = Counter()
    for r in mx.mix(docs, block_tokens=200, budget=3000, seed=seed).collect():
        used[r["source"]] += r["n_tokens"]
    for source, budget in zip(plan.sources, plan.budgets):
        assert budget - 10 < used[source] <= budget


def test_edge_rows(spark):
    docs = edge_docs(spark)
    rows = mx.mix(docs).collect()
    assert Counter(r["doc_id"] for r in rows if r["mix_pass"] == 0) == Counter(i for i, *_ in ROWS)
    kept = mx.mixed_documents(docs)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r["doc_id"] for r in rows)
    assert mx.mix(no_docs(spark)).count() == 0 and mx.mixed_documents(no_docs(spark)).count() == 0
    one = docs.where("doc_id = 1")
    assert mx.mix(one).count() == 1 and math.isclose(mx.mix(one).first()["mix_at"], 0.0)
