from __future__ import annotations

import random

import numpy as np
import pytest

from conftest import rows
from kinfold.operators.components import assign_clusters, connected_components, least_reachable
from kinfold.operators.skew import lookup
from kinfold.scratch import Scratch


def _union_find(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return sorted((x, find(x)) for x in parent)


def _components(spark, edges, **options):
    df = spark.createDataFrame(edges, "a string, b string")
    return rows(connected_components(df, "a", "b", Scratch(spark, "test"), **options))


def _name(i: int) -> str:
    return f"n{i:06d}"


CASES = {
    "triangle": [("c", "a"), ("b", "c"), ("a", "b")],
    "two": [("a", "b"), ("c", "d"), ("d", "e")],
    "loop and repeat": [("a", "a"), ("a", "b"), ("b", "a"), ("a", "b")],
    "path": [(_name(i), _name(i + 1)) for i in range(300)],
    "shuffled path": [(_name(i * 617 % 1000), _name((i + 1) * 617 % 1000)) for i in range(999)],
    "star around the largest": [(_name(i), _name(9_999)) for i in range(3_000)],
    "star around the least": [(_name(0), _name(i)) for i in range(1, 3_000)],
}


@pytest.mark.parametrize("case", CASES)
def test_known_graphs(spark, case):
    edges = CASES[case]
    assert _components(spark, edges) == _union_find(edges)


def test_forests_connect_what_the_edges_connect():
    rng = np.random.default_rng(3)
    for n in (1, 2, 50, 400):
        a, b = rng.integers(0, n, 2 * n // 3), rng.integers(0, n, 2 * n // 3)
        want = dict(_union_find(list(zip(a.tolist(), b.tolist(), strict=True))))
        assert least_reachable(a, b, n).tolist() == [want.get(i, i) for i in range(n)]
    path = np.arange(5000)
    assert not least_reachable(path[1:], path[:-1], 5000).any()


@pytest.mark.parametrize("case", ["shuffled path", "star around the largest"])
def test_small_forests_give_the_same_components(spark, case):
    assert _components(spark, CASES[case], forest_edges=7) == _union_find(CASES[case])


def test_forests_halve_the_rounds_of_a_shuffled_path(spark):
    edges = spark.createDataFrame(CASES["shuffled path"], "a string, b string").repartition(8)

    def rounds(size: int) -> int:
        scratch = Scratch(spark, "rounds")
        written = []
        scratch_write = scratch.materialise
        scratch.materialise = lambda df, name: (written.append(name), scratch_write(df, name))[1]
        connected_components(edges, "a", "b", scratch, forest_edges=size)
        return len(written) - 1

    assert 2 * rounds(1_000_000) <= rounds(1)


def test_hot_nodes_take_the_broadcast_path(spark):
    rng = random.Random(4)
    edges = [(_name(rng.randrange(400)), _name(rng.randrange(400))) for _ in range(250)]
    edges += [(_name(7), _name(i)) for i in range(500, 900)] + [(_name(999), _name(i)) for i in range(900, 999)]
    edges = [(a, b) for a, b in edges if a != b]
    assert _components(spark, edges, hot_rows=50) == _union_find(edges)


def test_no_edges(spark):
    assert _components(spark, []) == []


def test_isolated_nodes_stand_alone(spark):
    nodes = spark.createDataFrame([("a",), ("b",), ("c",)], "record_id string")
    found = spark.createDataFrame([("a", "a"), ("b", "a")], "node string, component string")
    assert rows(assign_clusters(nodes, found, "record_id")) == [("a", "a"), ("b", "a"), ("c", "c")]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_is_the_same_for_hot_and_cold_keys(spark, how):
    data = [("hot", "x", i) for i in range(500)] + [(f"k{i % 9}", None, i) for i in range(90)] + [("none", "x", 1)]
    df = spark.createDataFrame(data, "a string, b string, i int")
    values = df.filter("a != 'none'").groupBy("a", "b").count().selectExpr("a", "b", "count as n", "upper(a) as v")
    plain = lookup(df, values, ["a", "b"], "n", 100, how=how)
    split = lookup(df, values, ["a", "b"], "n", 591, how=how, hot_rows=100)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(plain.collect(), key=key) == sorted(split.collect(), key=key)
    assert split.count() == (591 if how == "left" else 590)
