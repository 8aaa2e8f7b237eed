"""Rolling observations up into one row per entity, every value with its source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.plans.lineage import cut


def newest(value: Column, *recency: Column) -> Column:
    """The newest non-null value; nulls and ties in recency are decided by the further keys."""
    return F.max_by(value, F.when(value.isNotNull(), F.struct(*recency)))


def oldest(value: Column, *recency: Column) -> Column:
    return F.min_by(value, F.when(value.isNotNull(), F.struct(*recency)))


def _kept(df: DataFrame, keys: list[str], order: tuple[Column, ...], pick) -> DataFrame:
    row = F.struct(*(F.col(c) for c in df.columns))
    return df.groupBy(*(F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys))).agg(pick(row, F.struct(*order)).alias("_row")).select("_row.*")


def keep_last(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row per key: the last in order, which must be total. Null keys form one group, nulls come first in order.

    An aggregate that combines before the shuffle, so a key may hold any share of the rows.
    """
    return _kept(df, keys, order, F.max_by)


def keep_first(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row per key: the first in order, which must be total. Null keys form one group, nulls come first in order."""
    return _kept(df, keys, order, F.min_by)


def set_digest(df: DataFrame, key: str, *columns: str) -> DataFrame:
    """(key, digest): a sha256 of the distinct rows of each key, whatever their order or repetition.

    Two levels: the rows' hashes are digested by their first three digits, those digests by key, so
    that no more than a 4096th of a key's rows is ever in one place.
    """
    row = F.concat_ws("\x1f", *(F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns))
    hashed = df.select(key, F.sha2(row, 256).alias("_row")).distinct()
    listed = lambda c: F.sha2(F.array_join(F.array_sort(F.collect_list(c)), "\n"), 256)
    parts = hashed.groupBy(key, F.substring("_row", 1, 3).alias("_part")).agg(listed("_row").alias("_digest"))
    return parts.groupBy(key).agg(listed(F.concat("_part", "_digest")).alias("digest"))


def running_sums(df: DataFrame, order: str, *values: str) -> DataFrame:
    """df with <value>_sum: the sum of each value over all rows from the highest `order` down to the row's own, which must be distinct.

    Rows are parted by ranges of order; sums are taken within the ranges, and the ranges' totals,
    one row each, are summed up among themselves.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut(df.repartitionByRange(parts, F.desc(order)).withColumn("_part", F.spark_partition_id()))
    upto = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = ranged.groupBy("_part").agg(*(F.sum(v).alias(v) for v in values)).select("_part", *(F.coalesce(F.sum(v).over(upto), F.lit(0)).alias(f"_{v}") for v in values))
    within = Window.partitionBy("_part").orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, 0)
    return ranged.join(before, "_part").select(*df.columns, *((F.sum(v).over(within) + F.col(f"_{v}")).alias(f"{v}_sum") for v in values))


def changed_keys(now: DataFrame, before: DataFrame, key: str) -> DataFrame:
    """(key, change): keys whose digest is new, gone or different."""
    joined = now.select(key, F.col("digest").alias("_now")).join(before.select(key, F.col("digest").alias("_before")), key, "full_outer")
    change = F.when(F.col("_before").isNull(), "added").when(F.col("_now").isNull(), "removed").otherwise("changed")
    return joined.where(~F.col("_now").eqNullSafe(F.col("_before"))).select(key, change.alias("change"))


def replace_by_source(existing: DataFrame, fresh: DataFrame, keys: list[str], sources: DataFrame | None = None) -> DataFrame:
    """existing without the rows of the reprocessed sources, plus fresh; sources defaults to those of fresh."""
    gone = (sources if sources is not None else fresh).select(*keys).distinct()
    return existing.join(gone, keys, "left_anti").unionByName(fresh, allowMissingColumns=True)


def islands(df: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """(key, start, end, members): overlapping or touching intervals of a key merged."""
    order = Window.partitionBy(key).orderBy(start, end)
    before = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = df.select(key, start, end).withColumn("_new", F.when(F.col(start) <= before, 0).otherwise(1))
    numbered = marked.withColumn("_island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(key, "_island").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("members")).drop("_island")


def single_or_null(value: Column) -> Column:
    """The value if all non-null values of the group are the same one, else null."""
    return F.when(F.min(value) == F.max(value), F.min(value))
