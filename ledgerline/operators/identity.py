"""Keeping instrument ids over rebuilds: carry-over from the last clusters, redirects for retired ids."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import text
from ledgerline.operators import hierarchy
from ledgerline.operators.graph import connected_components
from ledgerline.plans.lineage import cut


#: What a previous instrument and a new cluster's mentions are compared by, where they share items only.
CONTENT = ("fingerprint", "instrument_type", "start_date", "maturity_date", "interest_rate_pct", "principal_amount")


@dataclass(frozen=True)
class Evidence:
    """What speaks for a new cluster keeping a previous id."""

    new: str
    old: str
    mentions: int
    content: int
    items: int
    seed: str = ""

    @property
    def level(self) -> tuple[int, int, int]:
        return (self.mentions, self.content, self.items)


def pair_up(pairs: list[Evidence]) -> tuple[dict[str, str], dict[str, str]]:
    """(new id -> previous id, retired previous id -> new id) of a group's evidence.

    Pairs are taken level by level, best first; of one level the older seed first. A pair that shares
    mentions is taken if both sides are free. Pairs that share items count only if the contents agree
    somewhere, and are taken only where the level leaves both sides one partner; else both are out of
    the running. An id that nobody keeps is led to its best partner, unless it was out of the running.
    """
    admitted = sorted((p for p in pairs if p.mentions or p.content), key=lambda p: (*(-x for x in p.level), p.seed, p.new, p.old))
    kept: dict[str, str] = {}
    taken, out_new, out_old = set(), set(), set()
    for (mentions, *_), level in groupby(admitted, key=lambda p: p.level):
        free = [p for p in level if p.new not in kept and p.old not in taken and p.new not in out_new and p.old not in out_old]
        new, old = Counter(p.new for p in free), Counter(p.old for p in free)
        for p in free:
            if mentions:
                if p.new in kept or p.old in taken:
                    continue
            elif new[p.new] > 1 or old[p.old] > 1:
                out_new.add(p.new)
                out_old.add(p.old)
                continue
            kept[p.new] = p.old
            taken.add(p.old)
    led: dict[str, str] = {}
    for p in admitted:
        if p.old not in taken and p.old not in out_old:
            led.setdefault(p.old, p.new)
    return kept, led


def content(rows: DataFrame) -> DataFrame:
    """(instrument_id, field, value) of rows (instrument_id and any of CONTENT): numbers in canonical form, placeholders and nulls left out."""
    have = set(rows.columns)
    number = lambda c: text.canonical_number(F.expr(f"try_cast({c} as decimal(38,6))"))
    value = lambda c: number(c) if c in ("interest_rate_pct", "principal_amount") else text.coerce_text(F.col(c))
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("field"), value(c).alias("value")) for c in CONTENT if c in have))).alias("c")
    return rows.select("instrument_id", each).where("c.value is not null").select("instrument_id", "c.field", "c.value").distinct()


def _evidence(members: DataFrame, previous: DataFrame, said: DataFrame | None, stated: DataFrame | None) -> DataFrame:
    now = members.select(F.col("instrument_id").alias("new"), "mention_id", "item_id").distinct()
    old = previous.select(F.col("instrument_id").alias("old"), "mention_id", "item_id").distinct()
    by_mention = now.join(old.drop("item_id"), "mention_id").groupBy("new", "old").agg(F.countDistinct("mention_id").alias("mentions"))
    by_item = now.select("new", "item_id").distinct().join(old.select("old", "item_id").distinct(), "item_id").groupBy("new", "old").agg(F.count("*").alias("items"))
    pairs = cut(by_mention.join(by_item, ["new", "old"], "full_outer").na.fill(0, ["mentions", "items"]))
    if said is None or stated is None:
        return pairs.where("mentions > 0").withColumn("content", F.lit(0).cast("long"))
    items_only = pairs.where("mentions = 0")
    agreed = items_only.join(stated.withColumnRenamed("instrument_id", "old"), "old").join(said.withColumnRenamed("instrument_id", "new"), ["new", "field", "value"]).groupBy("new", "old").agg(F.countDistinct("field").alias("content"))
    return pairs.join(agreed, ["new", "old"], "left").na.fill(0, ["content"]).where("mentions > 0 or content > 0")


def carry_over(members: DataFrame, previous: DataFrame, said: DataFrame | None = None, stated: DataFrame | None = None, seeds: DataFrame | None = None) -> DataFrame:
    """(kind, from_id, to_id): which new cluster keeps which previous id ("kept", new to previous), and where retired ids lead ("retired", previous to new).

    members and previous are (instrument_id, mention_id, item_id); said and stated are the content()
    of the new clusters' mentions and of the previous instruments, without which clusters that share
    items only keep nothing; seeds (instrument_id, seed) decides ties. Clusters compete for ids only
    within a component of shared mentions and items; components are solved one by one, each in one task.
    """
    pairs = cut(_evidence(members, previous, said, stated))
    if seeds is not None:
        pairs = pairs.join(seeds.select(F.col("instrument_id").alias("new"), "seed"), "new", "left")
    pairs = pairs if seeds is not None else pairs.withColumn("seed", F.lit(""))
    edges = pairs.select(F.concat(F.lit("n|"), "new").alias("a"), F.concat(F.lit("o|"), "old").alias("b"))
    block = connected_components(edges, "a", "b").where(F.col("node").startswith("n|")).select(F.substring("node", 3, 1_000_000).alias("new"), F.col("component").alias("block"))
    rows = pairs.join(block, "new").repartition(int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")), "block").sortWithinPartitions("block")

    def solved(held: list[Evidence]) -> list[tuple[str, str, str]]:
        kept, led = pair_up(held)
        return [("kept", *p) for p in kept.items()] + [("retired", *p) for p in led.items()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Evidence] = []
        block, found = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["block"] != block:
                    found += solved(held)
                    held, block = [], row["block"]
                held.append(Evidence(row["new"], row["old"], row["mentions"], row["content"], row["items"], row["seed"] or ""))
        found += solved(held)
        yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.string()) for i in range(3)], ["kind", "from_id", "to_id"])

    return rows.mapInArrow(work, "kind string, from_id string, to_id string")


def resolve_redirects(redirects: DataFrame, live: DataFrame) -> DataFrame:
    """(old_id, new_id): every retired id led to a live one, over as many steps as it takes.

    redirects has old_id and new_id, live the ids in use (instrument_id). Ids that live again lose
    their redirect; ways that end nowhere or go round give none.
    """
    alive = live.select(F.col("instrument_id")).distinct()
    stored = redirects.select(F.col("old_id").alias("node"), F.col("new_id").alias("parent")).where("node is not null and parent is not null and node <> parent").distinct()
    pointing = stored.join(alive, stored["node"] == alive["instrument_id"], "left_anti").groupBy("node").agg(F.min("parent").alias("parent"))
    led = hierarchy.tops(pointing.select(F.lit("redirect").alias("tree"), "node", "parent")).where("state = 'tree'")
    return led.join(alive, led["top"] == alive["instrument_id"], "left_semi").select(F.col("node").alias("old_id"), F.col("top").alias("new_id"))
