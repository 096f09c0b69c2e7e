from __future__ import annotations

import random

import pytest

from loadtide.llm import groups


def brute_roots(edges):
    parent = {x: x for e in edges for x in e}
    for a, b in edges:
        x, y = groups.find(parent, a), groups.find(parent, b)
        parent[max(x, y)] = min(x, y)
    return {x: groups.find(parent, x) for e in edges if e[0] != e[1] for x in e}


@pytest.mark.parametrize("kind", ["long", "binary"])
@pytest.mark.parametrize("per_batch", ["10000", "3"])
def test_components_against_brute_force(spark, kind, per_batch):
    """Chains, a star, a ring and random links, given twice and in both directions; also where a node's rows span batches."""
    rng = random.Random(5)
    edges = [(k, k + 1) for k in range(-9, 30)] + [(100, 100 + k) for k in range(1, 40)] + [(300 + k, 300 + (k + 1) % 9) for k in range(9)]
    edges += [(rng.randrange(400, 500), rng.randrange(400, 500)) for _ in range(60)] + [(600, 600)]
    edges += [(b, a) for a, b in edges[::2]] + edges[::3]
    rng.shuffle(edges)
    name = (lambda x: x) if kind == "long" else (lambda x: (x + 1000).to_bytes(2, "big"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", per_batch)
    try:
        got = groups.components(spark.createDataFrame([(name(a), name(b)) for a, b in edges], f"u {kind}, v {kind}"), "t").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    plain = (lambda x: x) if kind == "long" else (lambda x: int.from_bytes(x, "big") - 1000)
    assert sorted((plain(r.node), plain(r.root)) for r in got) == sorted(brute_roots(edges).items())


def test_components_of_no_edges(spark):
    for rows in ([], [(1, 1), (None, 2)]):
        assert not groups.components(spark.createDataFrame(rows, "u long, v long"), "t").collect()


def test_a_round_needs_no_join(spark, monkeypatch):
    """The driver compiles and keeps every round's plan: two sorted shuffles and one to drop repeats, no join and no broadcast."""
    plans = []
    write = groups.staged
    monkeypatch.setattr(groups, "staged", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df, name))
    groups.components(spark.createDataFrame([(k, k + 1) for k in range(20)], "u long, v long"), "t").collect()
    assert len(plans) > 2
    for plan in plans[1:]:
        assert "Join" not in plan and "Broadcast" not in plan
        assert plan.count("Exchange") <= 3
