"""Graphs held as edge tables: connected components of undirected graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.plans.lineage import cut, drop_cut


def _smallest_neighbour(links: DataFrame) -> DataFrame:
    """(u, m): every u with its smallest v."""
    return links.groupBy("u").agg(F.min("v").alias("m"))


def _is_star_forest(links: DataFrame) -> bool:
    """Whether every u has one v and no v is a u: then each v is the root of its component."""
    ends = links.select(F.col("u").alias("n"), F.lit(1).alias("below"), F.lit(0).alias("above"))
    ends = ends.unionByName(links.select(F.col("v").alias("n"), F.lit(0).alias("below"), F.lit(1).alias("above")))
    open_ends = ends.groupBy("n").agg(F.sum("below").alias("below"), F.max("above").alias("above")).where("below > 1 or (below > 0 and above > 0)")
    return open_ends.limit(1).count() == 0


def connected_components(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """(node, component): every node of an undirected edge table with the smallest node of its component.

    Alternates the large-star and small-star steps (Kiveris et al., 2014), each an aggregation to
    the smallest neighbour and a join back, so that no neighbourhood is ever held in one place and
    the number of rounds is logarithmic. There is one way for every size of table. Self-loops are a
    node of their own; null ends are dropped; repeated edges count once. RuntimeError where the
    rounds run out.
    """
    loops = edges.where(F.col(a).isNotNull() & F.col(a).eqNullSafe(F.col(b))).select(F.col(a).alias("node")).distinct()
    now = cut(edges.where(f"{a} is not null and {b} is not null and {a} <> {b}").select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    for _ in range(max_rounds):
        if _is_star_forest(now):
            break
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _smallest_neighbour(both).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = _smallest_neighbour(large)
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        last, now = now, cut(small)
        drop_cut(last)
    else:
        raise RuntimeError(f"no fixpoint after {max_rounds} rounds")
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    found = now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
    return found.unionByName(loops.join(found, "node", "left_anti").withColumn("component", F.col("node")))
