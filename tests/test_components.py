"""Both ways of finding components, and what the small one costs."""

import random

import pytest
from pagewright import scratch
from pagewright.operators import components


@pytest.fixture
def written(monkeypatch):
    """Labels of the intermediate tables."""
    labels = []
    table = scratch.table
    monkeypatch.setattr(scratch, "table", lambda df, label, *more: labels.append(label) or table(df, label, *more))
    return labels


def graph(seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1080)]
    edges += [(2000, k) for k in range(2001, 2100)] + [(-5, 7), (7, -5), (-(1 << 63), (1 << 63) - 1), (3, 3), (None, 4)]
    rng.shuffle(edges)
    return edges


@pytest.mark.parametrize("seed", [1, 2])
def test_both_ways_give_the_same(spark, monkeypatch, written, seed):
    edges = spark.createDataFrame(graph(seed), "a long, b long")
    small = sorted(components.connected_components(edges, "a", "b").collect())
    assert written == ["cc-given", "cc-labels"]  # no rounds, each of which writes four tables
    n = edges.where("a <> b").count()
    monkeypatch.setattr(components, "FEW_EDGES", n)
    assert sorted(components.connected_components(edges, "a", "b").collect()) == small
    assert written == ["cc-given", "cc-labels"] * 2
    monkeypatch.setattr(components, "FEW_EDGES", n - 1)
    assert sorted(components.connected_components(edges, "a", "b").collect()) == small
    assert "cc-low" in written
    assert len({r.node for r in small}) == len(small)


def test_nodes_of_other_types(spark, written):
    got = components.connected_components(spark.createDataFrame([("b", "a"), ("c", "b")], "src string, dst string")).collect()
    assert sorted(map(tuple, got)) == [("a", "a"), ("b", "a"), ("c", "a")] and "cc-edges" in written
