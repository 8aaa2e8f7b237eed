"""Problem 5: parent pointers to full hierarchies.

Some nodes are splitters: by a deterministic hash one in SPLIT_ONE_IN, and every top. Every node
walks to its next splitter, the pointers between splitters are a graph smaller by that factor which
is solved by itself, and both parts are put together. Walks double their stride each round, so a
round is one join and their number is logarithmic in the longest stretch. A walk that comes to no
top ends in a cycle; such nodes are taken apart from the rest and followed until the set they
reach no longer shrinks, which is the set of nodes on cycles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.plans.lineage import cut, drop_cut

SPLIT_ONE_IN = 8
_KEY = ["tree", "node"]


def pointers(df: DataFrame, node: str, fields: dict[str, str]) -> DataFrame:
    """(tree, node, parent): the pointers of each field (tree -> column) whose parent exists as a node.

    Repeated rows count once; of several different parents that exist a node keeps the smallest, so
    that every tree stays one, and further_parents() reports the others. Null nodes and null parents
    give no pointer.
    """
    return _given(df, node, fields).groupBy("tree", "node").agg(F.min("parent").alias("parent"))


def _given(df: DataFrame, node: str, fields: dict[str, str]) -> DataFrame:
    """(tree, node, parent): every pointer to a parent that exists; repeats are left in."""
    rows = df.where(F.col(node).isNotNull())
    nodes = rows.select(F.col(node).alias("parent")).distinct()
    all_fields = F.explode(F.array(*(F.struct(F.lit(tree).alias("tree"), F.col(column).alias("parent")) for tree, column in fields.items())))
    given = rows.select(F.col(node).alias("node"), all_fields.alias("p")).where("p.parent is not null").select("p.tree", "node", "p.parent")
    return given.join(nodes, "parent", "left_semi").select("tree", "node", "parent")


def further_parents(df: DataFrame, node: str, fields: dict[str, str]) -> DataFrame:
    """(tree, node, parent): the existing parents that pointers() leaves out because the node has a smaller one."""
    given = _given(df, node, fields).distinct()
    several = given.groupBy("tree", "node").agg(F.min("parent").alias("_kept"), F.count("*").alias("_n")).where("_n > 1")
    return given.join(several, _KEY).where("parent <> _kept").select("tree", "node", "parent")


def all_nodes(df: DataFrame, node: str, fields: dict[str, str]) -> DataFrame:
    """(tree, node): every node once for each field, pointers or none. Null nodes are left out."""
    trees = F.explode(F.array(*(F.lit(tree) for tree in fields))).alias("tree")
    return df.where(F.col(node).isNotNull()).select(F.col(node).alias("node")).distinct().select(trees, "node")


def _is_splitter(column: Column) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(SPLIT_ONE_IN)) == 0


def _walk(state: DataFrame, max_rounds: int = 40) -> tuple[DataFrame, DataFrame]:
    """(arrived, cyclic) of state (tree, node, at, steps, done, path): follow `at` until done.

    Each round a row that isn't done takes over its `at`'s own stride, and is done if that one was.
    The last open row before a stop is done next, so a round in which no row gets done leaves only
    rows that go round in cycles. Both results are reads of tables written on the way.
    """
    stride = lambda rows: rows.select("tree", F.col("node").alias("at"), F.col("at").alias("at2"), F.col("steps").alias("steps2"), F.col("done").alias("done2"), F.col("path").alias("path2"))
    finished, open_rows, before = [], cut(state), -1
    for _ in range(max_rounds):
        finished.append(open_rows.where("done"))
        walking = open_rows.where("not done")
        left = walking.count()
        if left in (0, before):
            break
        before = left
        ahead = stride(open_rows)
        for earlier in finished[:-1]:
            ahead = ahead.unionByName(stride(earlier))
        open_rows = cut(
            walking.join(ahead, ["tree", "at"]).select(
                "tree", "node", F.col("at2").alias("at"), (F.col("steps") + F.col("steps2")).alias("steps"), F.col("done2").alias("done"), F.concat("path", "path2").alias("path")
            )
        )
    else:
        raise RuntimeError(f"walks are longer than 2^{max_rounds}")
    arrived = finished[0]
    for part in finished[1:]:
        arrived = arrived.unionByName(part)
    return arrived, walking.select("tree", "node")


def _split_walk(edges: DataFrame, with_paths: bool) -> tuple[DataFrame, DataFrame]:
    """(reached, rest): reached (tree, node, top, depth, path) for nodes below a top; rest the others."""
    tops = edges.select("tree", F.col("parent").alias("node")).distinct().join(edges, _KEY, "left_anti").select("tree", F.col("node").alias("parent"), F.lit(True).alias("is_top"))
    marked = edges.join(tops, ["tree", "parent"], "left").withColumn("is_top", F.coalesce("is_top", F.lit(False)))
    path = F.array("node") if with_paths else F.array().cast("array<string>")
    start = marked.select("tree", "node", F.col("parent").alias("at"), F.lit(1).alias("steps"), (F.col("is_top") | _is_splitter(F.col("parent"))).alias("done"), path.alias("path"), "is_top")
    to_splitter, _ = _walk(start.drop("is_top"))
    # the reduced graph: splitters that have a parent, each with its next splitter
    top_keys = tops.select("tree", F.col("parent").alias("at"), "is_top")
    reduced = to_splitter.where(_is_splitter(F.col("node"))).join(top_keys, ["tree", "at"], "left").select("tree", "node", "at", "steps", F.coalesce("is_top", F.lit(False)).alias("done"), "path")
    solved, _ = _walk(reduced)
    onward = solved.select("tree", F.col("node").alias("at"), F.col("at").alias("top"), F.col("steps").alias("more"), F.col("path").alias("onward"))
    whole = (
        to_splitter.join(top_keys, ["tree", "at"], "left")
        .join(onward, ["tree", "at"], "left")
        .select(
            "tree", "node",
            F.when(F.col("is_top"), F.col("at")).otherwise(F.col("top")).alias("top"),
            (F.col("steps") + F.when(F.col("is_top"), F.lit(0)).otherwise(F.col("more"))).alias("depth"),
            F.when(F.col("is_top"), F.concat("path", F.array("at"))).otherwise(F.concat("path", "onward", F.array("top"))).alias("path"),
        )
    )
    whole = cut(whole)
    return whole.where("top is not null"), edges.join(whole.where("top is not null"), _KEY, "left_anti")


def _cycles(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(tree, node, top, on_cycle) for nodes all of whose ways end in cycles; top is the smallest node of the cycle."""
    state = cut(edges.select("tree", "node", F.col("parent").alias("at"), F.col("node").alias("low")))
    before = None
    for _ in range(max_rounds):
        there = state.select("tree", "at").distinct()
        mark = state.join(there.withColumnRenamed("at", "node"), _KEY, "left_semi").agg(F.count("*"), F.sum(F.xxhash64("tree", "node", "low") % 1_000_000_007)).first()
        if mark == before:
            break
        before = mark
        ahead = state.select("tree", F.col("node").alias("at"), F.col("at").alias("at2"), F.col("low").alias("low2"))
        last, state = state, cut(state.join(ahead, ["tree", "at"]).select("tree", "node", F.col("at2").alias("at"), F.least("low", "low2").alias("low")))
        drop_cut(last)
    else:
        raise RuntimeError(f"cycles are longer than 2^{max_rounds}")
    on = state.select("tree", F.col("at").alias("node")).distinct().withColumn("on_cycle", F.lit(True))
    lows = state.join(on, _KEY).select("tree", F.col("node").alias("at"), F.col("low").alias("top"))
    return state.join(lows, ["tree", "at"]).join(on, _KEY, "left").select("tree", "node", "top", F.coalesce("on_cycle", F.lit(False)).alias("on_cycle"))


def tops(edges: DataFrame) -> DataFrame:
    """(tree, node, top, depth, state): every node that has a parent, with the last node above it.

    state is "tree", or "cycle" and "below cycle" for nodes whose way ends in a cycle: their top
    is the smallest node on it and they have no depth.
    """
    edges = cut(edges)
    reached, rest = _split_walk(edges, with_paths=False)
    cyclic = _cycles(rest)
    return reached.select("tree", "node", "top", "depth", F.lit("tree").alias("state")).unionByName(
        cyclic.select("tree", "node", "top", F.lit(None).cast("int").alias("depth"), F.when(F.col("on_cycle"), "cycle").otherwise("below cycle").alias("state"))
    )


def hierarchy(edges: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """(tree, node, root, depth, path, descendants, state): every node of edges, tops included.

    Nodes of `every` (tree, node) that no edge holds are roots of depth 0 without descendants. path runs from the root to the node. descendants counts the nodes below; for nodes on a cycle
    and below one, path, depth and descendants are null and root is the smallest node on the cycle.
    """
    edges = cut(edges)
    reached, rest = _split_walk(edges, with_paths=True)
    cyclic = _cycles(rest)
    below = reached.select("tree", F.explode(F.slice("path", 2, 2_000_000_000)).alias("node")).groupBy("tree", "node").agg(F.count("*").alias("descendants"))
    roots = reached.select("tree", F.col("top").alias("node")).distinct()
    nodes = reached.select("tree", "node", F.col("top").alias("root"), "depth", F.reverse("path").alias("path")).unionByName(
        roots.select("tree", "node", F.col("node").alias("root"), F.lit(0).alias("depth"), F.array("node").alias("path"))
    )
    counted = nodes.join(below, _KEY, "left").select("tree", "node", "root", "depth", "path", F.coalesce("descendants", F.lit(0)).alias("descendants"), F.lit("tree").alias("state"))
    if every is not None:
        linked = edges.select("tree", "node").unionByName(edges.select("tree", F.col("parent").alias("node")))
        alone = every.join(linked, _KEY, "left_anti")
        counted = counted.unionByName(
            alone.select("tree", "node", F.col("node").alias("root"), F.lit(0).alias("depth"), F.array("node").alias("path"), F.lit(0).cast("long").alias("descendants"), F.lit("tree").alias("state"))
        )
    return counted.unionByName(
        cyclic.select(
            "tree", "node", F.col("top").alias("root"), F.lit(None).cast("int").alias("depth"), F.lit(None).cast("array<string>").alias("path"), F.lit(None).cast("long").alias("descendants"),
            F.when(F.col("on_cycle"), "cycle").otherwise("below cycle").alias("state"),
        )
    )


def descendants(edges: DataFrame) -> DataFrame:
    """(tree, ancestor, descendant, distance): every pair of a tree; nodes on or below cycles have none."""
    reached, _ = _split_walk(cut(edges), with_paths=True)
    above = reached.select("tree", F.col("node").alias("descendant"), F.posexplode("path").alias("distance", "ancestor"))
    return above.where("distance > 0").select("tree", "ancestor", "descendant", "distance")
