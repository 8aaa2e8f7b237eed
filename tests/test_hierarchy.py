import random

import pytest

from ledgerline.operators import hierarchy

SCHEMA = "id string, up string, parent string, node string"


def brute(rows):
    ids = {r[0] for r in rows if r[0] is not None}
    parent = {}
    for node, up, *_ in rows:
        if node is not None and up in ids:
            parent[node] = min(up, parent.get(node, up))
    found = {}
    for node in parent:
        seen = [node]
        while seen[-1] in parent and parent[seen[-1]] not in seen:
            seen.append(parent[seen[-1]])
        if seen[-1] in parent:
            cycle = seen[seen.index(parent[seen[-1]]) :]
            found[node] = (min(cycle), None, "cycle" if node in cycle else "below cycle", None)
        else:
            found[node] = (seen[-1], len(seen) - 1, "tree", seen[::-1])
    return found


def solve(spark, rows):
    df = spark.createDataFrame([(a, b, "clash", "clash") for a, b in rows], SCHEMA)
    return hierarchy.pointers(df, "id", {"up": "up"})


CASES = {
    "chain": [(f"n{i:03}", f"n{i + 1:03}") for i in range(90)] + [("n090", None)],
    "cycle of one": [("a", "a"), ("b", "a"), ("c", "b")],
    "cycle and tail": [("a", "b"), ("b", "c"), ("c", "a"), ("d", "a"), ("e", "d"), ("x", "y"), ("y", None)],
    "missing, null and repeated": [("a", "gone"), ("b", None), (None, "b"), ("c", "b"), ("c", "b"), ("d", "c")],
    "two parents": [("a", None), ("b", None), ("c", "b"), ("c", "a")],
    "long cycle": [(f"n{i:02}", f"n{(i + 1) % 37:02}") for i in range(37)] + [("t", "n05")],
}


@pytest.mark.parametrize("name", CASES)
def test_tops_and_paths(spark, name):
    rows = CASES[name]
    expected = brute(rows)
    edges = solve(spark, rows)
    assert {r.node: (r.top, r.depth, r.state) for r in hierarchy.tops(edges).collect()} == {k: v[:3] for k, v in expected.items()}
    nodes = {r.node: r for r in hierarchy.hierarchy(edges).collect()}
    for node, (top, depth, state, path) in expected.items():
        assert (nodes[node].root, nodes[node].depth, nodes[node].state, nodes[node].path) == (top, depth, state, path)
        if state == "tree":
            assert nodes[node].descendants == sum(node in (v[3] or [])[:-1] for v in expected.values())
    pairs = {(r.ancestor, r.descendant, r.distance) for r in hierarchy.descendants(edges).collect()}
    assert pairs == {(a, node, len(v[3]) - 1 - i) for node, v in expected.items() if v[3] for i, a in enumerate(v[3][:-1])}


def test_nodes_without_links_are_roots(spark):
    rows = [("a", "gone", None), ("b", None, "c"), ("b", None, "c"), ("c", "b", None), (None, "b", "b"), ("d", "d", None)]
    fields = {"up": "up", "split": "split"}
    df = spark.createDataFrame(rows, "id string, up string, split string")
    found = hierarchy.hierarchy(hierarchy.pointers(df, "id", fields), hierarchy.all_nodes(df, "id", fields)).collect()
    assert sorted((r.tree, r.node, r.root, r.depth, r.path, r.descendants, r.state) for r in found) == [
        ("split", "a", "a", 0, ["a"], 0, "tree"), ("split", "b", "c", 1, ["c", "b"], 0, "tree"), ("split", "c", "c", 0, ["c"], 1, "tree"), ("split", "d", "d", 0, ["d"], 0, "tree"),
        ("up", "a", "a", 0, ["a"], 0, "tree"), ("up", "b", "b", 0, ["b"], 1, "tree"), ("up", "c", "b", 1, ["b", "c"], 0, "tree"), ("up", "d", "d", None, None, None, "cycle"),
    ]


def test_random_forest_with_a_hot_parent(spark):
    rng = random.Random(7)
    rows = [(f"n{i}", f"n{rng.randrange(400)}" if i % 3 else "n1") for i in range(400)]
    assert {r.node: (r.top, r.depth, r.state) for r in hierarchy.tops(solve(spark, rows)).collect()} == {k: v[:3] for k, v in brute(rows).items()}


def test_empty(spark):
    edges = solve(spark, [("a", None)]).where("false")
    assert hierarchy.tops(edges).count() == 0 and hierarchy.hierarchy(edges).count() == 0


def test_left_out_parents_are_reported(spark):
    df = spark.createDataFrame([("a", None), ("b", None), ("c", "b"), ("c", "a"), ("c", "b"), ("c", "gone"), ("d", "a"), (None, "a")], "id string, up string")
    rows = hierarchy.further_parents(df, "id", {"up": "up"}).collect()
    assert [(r.tree, r.node, r.parent) for r in rows] == [("up", "c", "b")]
    assert hierarchy.further_parents(df.limit(0), "id", {"up": "up"}).count() == 0
