"""Nearest-URL page differencing: what a page shares, line by line, with the page whose URL is nearest.

Pages are put in the order of host and path; the nearest page of a page is the one before or after
it with the longer common path. The order is made by range partitioning of keys and URLs alone, so
that a host may hold any share of all pages; the pages at the ends of a partition find their
neighbours in a table of one row per partition. Texts never travel: a page is its lines' hashes,
and two pages are aligned by the longest common subsequence of those.
"""

from __future__ import annotations

from bisect import bisect_left

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, IntegerType

from ledgerline.plans.lineage import cut

_LINE_END = r"\r\n|\n|\r"


def lines(text: Column) -> Column:
    """The lines of a text, blank ones included, so that their numbers are those of the text."""
    return F.split(text, _LINE_END, -1)


def common_prefix(a: Column, b: Column) -> Column:
    """The number of leading characters two strings share; null for a null."""
    upto = F.sequence(F.lit(1), F.least(F.char_length(a), F.char_length(b)))
    shared = F.aggregate(upto, F.lit(0), lambda done, i: F.when((done == i - 1) & (F.substr(a, i, F.lit(1)) == F.substr(b, i, F.lit(1))), i).otherwise(done))
    return F.when(a.isNull() | b.isNull(), None).when((a == "") | (b == ""), 0).otherwise(shared)


def nearest_pages(df: DataFrame, key: str, url: str) -> DataFrame:
    """(key, mate, prefix): each page with the page of its host whose path is nearest, and how much of the path they share.

    A key with several URLs is taken at the smallest. Pages without a URL, and a host's only page,
    have no row. Of two equally near pages the one before counts.
    """
    address = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(.*)$", 1)
    rows = df.where(F.col(key).isNotNull() & F.col(url).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.min(url).alias(url))
    rows = rows.select("_key", address.alias("_host"), path.alias("_path"))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    page = F.struct("_host", "_path", "_key")
    ranged = cut(rows.repartitionByRange(parts, "_host", "_path", "_key").select(F.spark_partition_id().alias("_part"), page.alias("_page")))
    within = Window.partitionBy("_part").orderBy("_page")
    near = ranged.withColumn("_before", F.lag("_page").over(within)).withColumn("_after", F.lead("_page").over(within))
    # one row per partition: its first and last page
    ends = ranged.groupBy("_part").agg(F.min("_page").alias("_first"), F.max("_page").alias("_last"))
    across = Window.orderBy("_part")
    ends = ends.select("_part", F.lag("_last").over(across).alias("_ended"), F.lead("_first").over(across).alias("_begins"))
    near = near.join(ends, "_part").withColumn("_before", F.coalesce("_before", "_ended")).withColumn("_after", F.coalesce("_after", "_begins"))
    shared = lambda other: F.when(F.col(f"{other}._host") == F.col("_page._host"), common_prefix(F.col(f"{other}._path"), F.col("_page._path")))
    near = near.withColumn("_b", shared("_before")).withColumn("_a", shared("_after"))
    first = F.coalesce(F.col("_b") >= F.col("_a"), F.col("_b").isNotNull())
    found = near.where("_a is not null or _b is not null")
    return found.select(F.col("_page._key").alias(key), F.when(first, F.col("_before._key")).otherwise(F.col("_after._key")).alias("mate"), F.when(first, F.col("_b")).otherwise(F.col("_a")).alias("prefix"))


def common_lines(a: list[int], b: list[int]) -> list[int]:
    """Positions in a of a longest common subsequence of a and b (Hunt and Szymanski, 1977); zeros match nothing."""
    places: dict[int, list[int]] = {}
    for j, x in enumerate(b):
        if x:
            places.setdefault(x, []).append(j)
    ends: list[int] = []  # the least last position in b of a common subsequence of each length
    chains: list[tuple] = []
    for i, x in enumerate(a):
        # from the last place to the first, so that one line of a is used once
        for j in reversed(places.get(x, ())):
            at = bisect_left(ends, j)
            link = (i, chains[at - 1] if at else None)
            if at == len(ends):
                ends.append(j)
                chains.append(link)
            elif ends[at] > j:
                ends[at] = j
                chains[at] = link
    found, link = [], chains[-1] if chains else None
    while link is not None:
        found.append(link[0])
        link = link[1]
    return found[::-1]


@pandas_udf(ArrayType(IntegerType()))
def _shared(own: pd.Series, other: pd.Series) -> pd.Series:
    return pd.Series([common_lines(list(a), list(b)) for a, b in zip(own, other, strict=True)], dtype=object)


def page_differences(df: DataFrame, key: str, url: str, text: str) -> DataFrame:
    """(key, mate, prefix, lines, shared): each page's lines that its nearest page has as well, as numbers from 0.

    Lines are compared without the white space at their ends; blank lines are shared by none. A row
    repeated with one key counts once (of different texts under one key the smallest hash list
    counts); null texts and pages without a nearest page have no row.
    """
    hashes = F.transform(lines(F.col(text)), lambda line: F.when(F.trim(line) == "", F.lit(0).cast("long")).otherwise(F.xxhash64(F.trim(line))))
    kept = cut(df.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).alias("_key"), hashes.alias("_lines")).groupBy("_key").agg(F.min("_lines").alias("_lines")))
    near = nearest_pages(df.select(key, url), key, url).withColumnRenamed(key, "_key")
    own = near.join(kept, "_key").withColumnRenamed("_lines", "_own")
    both = own.join(kept.select(F.col("_key").alias("mate"), F.col("_lines").alias("_other")), "mate")
    # pages without any line in common need no alignment
    meets = F.arrays_overlap(F.array_remove("_own", 0), F.array_remove("_other", 0))
    none = F.array().cast("array<int>")
    columns = lambda rows, shared: rows.select(F.col("_key").alias(key), "mate", "prefix", F.size("_own").alias("lines"), shared.alias("shared"))
    both = cut(both.withColumn("_meets", F.coalesce(meets, F.lit(False))))
    return columns(both.where("_meets"), _shared("_own", "_other")).unionByName(columns(both.where("not _meets"), none))
