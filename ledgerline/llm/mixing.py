"""Problem 8: mixing sources to target weights.

Weights form a family with one exponent: w_i ~ q_i * (n_i / q_i)^x, where q is the target share and
n the source's share of all tokens. At 0 the weights are the targets, at 1 the natural shares
(without targets, q is uniform and w ~ n^x is plain temperature mixing). The exponent is bisected
to the least for which no source must repeat beyond its cap at the wanted size, or to the one whose
weights have a wanted entropy. Without a wanted size, the mixture is the largest in which all
targets hold exactly within the caps, and the exponent comes out as 0.

Budgets are realised as block permutations: each source's records are put into blocks by hash and
blocks in hash order; a source goes through all its blocks once per whole repeat, and through the
first blocks, and the first records of the block where the budget ends, for the remainder.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Expected records of a block; running sums are only taken within blocks and over blocks.
BLOCK_RECORDS = 4096
BISECTIONS = 60


@dataclass(frozen=True)
class Source:
    """What is known of a source: tokens it has, share it should have, most uses of one record."""

    name: str
    tokens: int
    target: float
    max_repeats: int


def weights(sources: list[Source], exponent: float) -> dict[str, float]:
    """Normalised weights of the sources that have tokens and a target."""
    live = [s for s in sources if s.tokens > 0 and s.target > 0]
    total = sum(s.tokens for s in live)
    logs = {s.name: math.log(s.target) + exponent * (math.log(s.tokens / total) - math.log(s.target)) for s in live}
    top = max(logs.values(), default=0.0)
    raw = {name: math.exp(v - top) for name, v in logs.items()}
    return {name: v / sum(raw.values()) for name, v in raw.items()}


def entropy(shares: dict[str, float]) -> float:
    return -sum(w * math.log(w) for w in shares.values() if w > 0)


def largest_exact(sources: list[Source], shares: dict[str, float]) -> int:
    """The most tokens a mixture of these shares can have within the repeat caps."""
    return int(min((s.tokens * s.max_repeats / shares[s.name] for s in sources if shares.get(s.name, 0) > 0), default=0))


def bisect_exponent(sources: list[Source], size: int | None = None, target_entropy: float | None = None) -> float:
    """The least exponent in [0, 1] at which a mixture of `size` tokens keeps all caps, or at which
    the weights have target_entropy (the nearer end of the interval where none has)."""
    if target_entropy is not None:
        off = lambda x: entropy(weights(sources, x)) - target_entropy
        low, high = 0.0, 1.0
        if off(low) * off(high) > 0:
            return low if abs(off(low)) <= abs(off(high)) else high
        rising = off(high) > off(low)
        for _ in range(BISECTIONS):
            middle = (low + high) / 2
            low, high = (low, middle) if (off(middle) > 0) == rising else (middle, high)
        return (low + high) / 2
    if size is None or size <= largest_exact(sources, weights(sources, 0.0)):
        return 0.0
    if size > largest_exact(sources, weights(sources, 1.0)):
        return 1.0
    low, high = 0.0, 1.0
    for _ in range(BISECTIONS):
        middle = (low + high) / 2
        low, high = (low, middle) if size <= largest_exact(sources, weights(sources, middle)) else (middle, high)
    return high


def budgets(sources: list[Source], size: int | None = None, target_entropy: float | None = None) -> tuple[dict[str, int], float]:
    """(tokens to take of each source, exponent). The size is reduced where no exponent keeps the caps."""
    exponent = bisect_exponent(sources, size, target_entropy)
    shares = weights(sources, exponent)
    most = largest_exact(sources, shares)
    size = most if size is None else min(size, most)
    return {name: int(size * w) for name, w in shares.items()}, exponent


def realise(records: DataFrame, key: str, source: str, tokens: str, takes: DataFrame) -> DataFrame:
    """(source, key, tokens, times): how often each record appears; records that don't appear are left out.

    takes has one row per source: source, budget, available, blocks. A record comes in the remainder
    if the records before it in its source's order and half of itself are within it, so a source's
    total is off its budget by half a record at most.
    """
    placed = records.join(takes, source).withColumn("_block", F.pmod(F.xxhash64(F.col(key), F.lit(1)), F.col("blocks"))).withColumn("_order", F.xxhash64(F.col(key), F.lit(2)))
    placed = placed.withColumn("_whole", F.floor(F.col("budget") / F.col("available")).cast("long")).withColumn("_rest", F.col("budget") - F.col("_whole") * F.col("available"))
    # over blocks there are few rows per source, within blocks few records per block
    per_block = placed.groupBy(source, "_block").agg(F.sum(tokens).alias("_in_block"))
    before = per_block.withColumn("_before", F.coalesce(F.sum("_in_block").over(Window.partitionBy(source).orderBy(F.xxhash64("_block"), "_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    ordered = placed.join(before.select(source, "_block", "_before"), [source, "_block"])
    running = F.coalesce(F.sum(tokens).over(Window.partitionBy(source, "_block").orderBy("_order", key).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    timed = ordered.withColumn("_start", F.col("_before") + running).withColumn("times", (F.col("_whole") + (F.col("_start") + F.col(tokens) / 2 <= F.col("_rest")).cast("long")).cast("long"))
    return timed.where("times > 0").select(source, key, tokens, "times")


def mix(records: DataFrame, key: str, source: str, tokens: str, targets: DataFrame, size: int | None = None, target_entropy: float | None = None) -> tuple[DataFrame, DataFrame]:
    """(mixture, report) of records (key, source, tokens) by targets (source, target_share, max_repeats).

    mixture is what realise() gives. report has a row per source of targets: available tokens,
    target share, wanted share (after leaving out sources without tokens), budget, actual tokens and
    share, and the most repeats. Records of null or unknown source, null size or size 0 take no
    part; a key repeated within a source counts once. targets is a short list by its nature and is
    read by the driver, as are the sums per source.
    """
    spark = records.sparkSession
    known = targets.select(F.col(source).alias(source))
    live = records.select(key, source, tokens).where(f"{tokens} > 0").join(known, source, "left_semi").dropDuplicates([source, key])
    sums = {r[source]: r for r in live.groupBy(source).agg(F.sum(tokens).alias("n"), F.count("*").alias("rows")).collect()}
    rows = targets.collect()
    sources = [Source(r[source], sums[r[source]]["n"] if r[source] in sums else 0, r["target_share"], r["max_repeats"]) for r in rows]
    taken, exponent = budgets(sources, size, target_entropy)
    shares = weights(sources, exponent)
    blocks = {name: max(1, -(-sums[name]["rows"] // BLOCK_RECORDS)) for name in taken}
    takes = spark.createDataFrame([(n, int(b), int(sums[n]["n"]), int(blocks[n])) for n, b in taken.items()], f"{source} string, budget long, available long, blocks long")
    mixture = realise(live, key, source, tokens, takes)
    plan = spark.createDataFrame([(s.name, s.tokens, s.target, shares.get(s.name, 0.0), int(taken.get(s.name, 0)), int(s.max_repeats)) for s in sources], f"{source} string, available long, target_share double, wanted_share double, budget long, max_repeats long")
    actual = mixture.groupBy(source).agg(F.sum(F.col(tokens) * F.col("times")).alias("actual_tokens"), F.max("times").alias("most_times"))
    report = plan.join(actual, source, "left").na.fill(0, ["actual_tokens", "most_times"])
    total = report.agg(F.sum("actual_tokens").alias("_all"))
    report = report.join(F.broadcast(total)).withColumn("actual_share", F.col("actual_tokens") / F.greatest("_all", F.lit(1))).drop("_all").withColumn("exponent", F.lit(exponent))
    return mixture, report
