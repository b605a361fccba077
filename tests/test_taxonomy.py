"""Ancestors at any depth, and pruning, against plain climbs."""

from __future__ import annotations

import random
from collections import deque

import pytest

from inkwell.operators import taxonomy


def plain_ancestors(edges):
    up = {}
    for parent, child in edges:
        up.setdefault(child, set()).add(parent)
    out = set()
    for node in up:
        depth, queue = {}, deque((p, 1) for p in up[node])
        while queue:
            at, d = queue.popleft()
            if at not in depth:
                depth[at] = d
                queue.extend((p, d + 1) for p in up.get(at, ()))
        out |= {(node, a, d) for a, d in depth.items()}
    return out


def layers(n):
    return [(f"{i}{a}", f"{i + 1}{b}") for i in range(n) for a in "xy" for b in "xy"]


rng = random.Random(3)
CASES = {
    "chain": [(str(i), str(i + 1)) for i in range(500)],
    "diamonds": layers(30),
    "cycle": [("a", "b"), ("b", "c"), ("c", "d"), ("d", "b"), ("d", "e")],
    "loop": [("a", "a"), ("a", "b")],
    "tree": [(str(i // 3), str(i)) for i in range(1, 400)],
    "random": [(str(rng.randrange(80)), str(rng.randrange(80))) for _ in range(120)],
    "repeats": [("a", "b"), ("a", "b"), ("r", "a")],
    "empty": [],
}


@pytest.mark.parametrize("name", CASES)
def test_ancestors_equal_climbs(spark, name):
    edges = spark.createDataFrame(CASES[name] + [(None, "x"), ("x", None)], "parent string, child string").repartition(3)
    found = taxonomy.ancestors(edges).collect()
    assert len(found) == len({(r.node, r.ancestor) for r in found})
    assert {(r.node, r.ancestor, r.depth) for r in found} == plain_ancestors(CASES[name])


def plain_prune(curies, edges):
    up = plain_ancestors(edges)
    above = {a for n, a, _ in up if n in set(curies)}
    out = []
    for c in curies:
        if c not in above and c not in out:
            out.append(c)
    return out


def test_pruning_keeps_first_places(spark):
    edges = [*CASES["cycle"], *layers(5), ("0x", "a")]
    rng = random.Random(1)
    nodes = sorted({n for e in edges for n in e} | {"unrelated"})
    lists = {k: [rng.choice(nodes) for _ in range(rng.randrange(9))] for k in range(60)}
    rows = [(k, i, n) for k, own in lists.items() for i, n in enumerate(own)]
    df = spark.createDataFrame(rows, "doc int, place int, node string").repartition(3)
    closure = taxonomy.ancestors(spark.createDataFrame(edges, "parent string, child string"))
    found = {}
    for r in sorted(taxonomy.most_specific(df, closure, "doc", order="place").collect(), key=lambda r: r.place):
        found.setdefault(r.doc, []).append(r.node)
    assert found == {k: p for k, own in lists.items() if (p := plain_prune(own, edges))}
    assert {(r.doc, r.node) for r in taxonomy.most_specific(df.drop("place"), closure, "doc").collect()} == {(k, n) for k, own in found.items() for n in own}
