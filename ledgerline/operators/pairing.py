"""Pairs within groups of any size: large groups are cut into blocks whose pairs are spread over tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a block: a group of no more rows is paired by one task, a larger one block by block.
BLOCK_ROWS = 1024


def pairs_within(rows: DataFrame, keys: list[str], member: str, carried: list[str] | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(keys, a_member, b_member, a_<carried>, b_<carried>): every pair of different members of a group, smaller member first.

    rows holds a member once per group. The rows of a group are counted first (combined before the
    shuffle); a group of more than block_rows goes into about n / block_rows blocks by the hash of
    its members, and each two blocks meet under a key of their own. So no task sees more than two
    blocks of a group, at the price of sending a row once per block of its group. Null keys group
    nothing, null members pair with nothing.
    """
    carried = carried or []
    known = rows.where(" and ".join(f"{c} is not null" for c in (*keys, member)))
    sizes = known.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1")
    blocks = F.ceil(F.col("_n") / F.lit(block_rows)).cast("int")
    own = known.join(sizes, keys).withColumn("_blocks", blocks).withColumn("_own", F.pmod(F.xxhash64(member, F.lit(7)), F.col("_blocks")).cast("int"))
    meets = own.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    meets = meets.select(*keys, member, *carried, "_own", F.least("_own", "_other").alias("_low"), F.greatest("_own", "_other").alias("_high"))
    a, b = meets.alias("a"), meets.alias("b")
    same = F.lit(True)
    for key in (*keys, "_low", "_high"):
        same = same & (F.col(f"a.{key}") == F.col(f"b.{key}"))
    # two rows of one block meet in the key of that block alone
    once = (F.col("a._low") == F.col("a._high")) | (F.col("a._own") != F.col("b._own"))
    both = a.join(b, same & (F.col(f"a.{member}") < F.col(f"b.{member}")) & once)
    return both.select(
        *(F.col(f"a.{k}").alias(k) for k in keys), F.col(f"a.{member}").alias(f"a_{member}"), F.col(f"b.{member}").alias(f"b_{member}"),
        *(F.col(f"{side}.{c}").alias(f"{side}_{c}") for c in carried for side in ("a", "b")),
    )
