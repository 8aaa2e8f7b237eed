"""Problem 7: filling containers of fixed capacity, by Karmarkar-Karp multiway differencing.

Items larger than a container are cut into full pieces and a rest; nothing else is cut. Items are
spread by hash over groups of bounded size, and every group is packed by itself: differencing
gives windows of nearly equal sums for a number of windows that starts at the least possible and
rises while some window exceeds the capacity. What the last windows of a group leave over is small
against the group, and no step depends on all items being in one place.
"""

from __future__ import annotations

import heapq
from operator import itemgetter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Expected items of a group; the hash keeps groups close to it, whatever the data.
GROUP_ITEMS = 1024
#: Groups packed by one task.
GROUPS_A_TASK = 4
#: An exchange that takes no more than this above the need is taken without looking further.
EXCHANGE_NEAR = 4
_sum = itemgetter(0)


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """The items (positions in sizes) of each of `windows` windows of nearly equal sums.

    The largest-spread partial partitions are merged first, the fullest windows of one with the
    emptiest of the other. Equal sizes are taken in order, so the result is deterministic.
    """
    if windows < 1:
        raise ValueError("needs at least one window")
    heap = [(-size, i, [(size, i)]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    serial = len(sizes)
    while len(heap) > 1:
        _, _, one = heapq.heappop(heap)
        _, _, two = heapq.heappop(heap)
        p, q = len(one), len(two)
        if p + q <= windows:
            merged = sorted(one + two, key=_sum, reverse=True)
        else:
            alone = windows - q
            middle = [(a[0] + b[0], (a[1], b[1])) for a, b in zip(one[alone:], reversed(two[windows - p :]), strict=True)]
            merged = sorted(one[:alone] + middle + two[: windows - p], key=_sum, reverse=True)
        least = merged[-1][0] if len(merged) == windows else 0
        if least:
            merged = [(s - least, items) for s, items in merged]
        heapq.heappush(heap, (-merged[0][0], serial, merged))
        serial += 1
    found: list[list[int]] = []
    for _, items in heap[0][2] if heap else []:
        flat, stack = [], [items]
        while stack:
            top = stack.pop()
            if isinstance(top, tuple):
                stack.extend(top)
            else:
                flat.append(top)
        found.append(sorted(flat))
    return found + [[] for _ in range(windows - len(found))]


def level(found: list[list[int]], sizes: list[int], capacity: int) -> bool:
    """Exchange items of windows above the capacity with those of emptier windows; whether all fit then.

    An exchange takes at least as much as is needed, if some window has room for that, else as
    much as there is room for. Every exchange empties an overfull window, so this ends.
    """
    load = [sum(sizes[i] for i in w) for w in found]
    over = [w for w, s in enumerate(load) if s > capacity]
    order = sorted((w for w in range(len(found)) if load[w] < capacity), key=load.__getitem__)
    for w in over:
        while load[w] > capacity:
            excess, best = load[w] - capacity, None
            for v in order:
                room = capacity - load[v]
                if room <= 0:
                    continue
                for i in found[w]:
                    for j in (*found[v], None):
                        gain = sizes[i] - (sizes[j] if j is not None else 0)
                        if 0 < gain <= room and (best is None or (abs(gain - excess) if gain >= excess else capacity + excess - gain) < best[0]):
                            best = (abs(gain - excess) if gain >= excess else capacity + excess - gain, i, j, v, gain)
                if best and best[0] <= EXCHANGE_NEAR:
                    break
            if best is None:
                return False
            _, i, j, v, gain = best
            found[w].remove(i)
            found[v].append(i)
            if j is not None:
                found[v].remove(j)
                found[w].append(j)
            load[w] -= gain
            load[v] += gain
        found[w].sort()
    return True


def pack(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows of at most `capacity`, by differencing with a number of windows that rises as needed.

    Items that fill a window by themselves are set aside first; no size may exceed the capacity.
    Before the number of windows rises, those above the capacity are levelled by exchanges.
    """
    if any(s > capacity or s < 0 for s in sizes):
        raise ValueError("sizes must be between 0 and the capacity")
    full = [[i] for i, s in enumerate(sizes) if s == capacity]
    rest = [i for i, s in enumerate(sizes) if s < capacity]
    if not rest:
        return full
    own = [sizes[i] for i in rest]
    windows = max(1, -(-sum(own) // capacity))
    while True:
        found = differencing(own, windows)
        if level(found, own, capacity):
            return full + [sorted(rest[i] for i in w) for w in found if w]
        windows += max(1, windows // 400)


def cut_items(df: DataFrame, size: Column | str, capacity: Column) -> DataFrame:
    """df with piece_no, piece_start and piece_size: one row per item that fits, else one per piece."""
    size = F.col(size) if isinstance(size, str) else size
    count = F.greatest(F.lit(1), F.ceil(size / capacity)).cast("int")
    rows = df.where(size.isNotNull()).withColumn("piece_no", F.explode(F.sequence(F.lit(0), count - 1)))
    return rows.withColumn("piece_start", F.col("piece_no") * capacity).withColumn("piece_size", F.least(capacity, size - F.col("piece_start")))


def fill_containers(items: DataFrame, key: str, size: str, capacity: int, group_items: int = GROUP_ITEMS) -> DataFrame:
    """(container, key, piece_no, piece_start, piece_size): every item, or piece of an item above capacity, in its container.

    Items of null size are left out, items of size 0 take no space. A key that repeats with the
    same size counts once. Containers are named "group-number".
    """
    pieces = cut_items(items.select(F.col(key).alias("_key"), F.col(size).cast("long").alias("_size")).distinct(), "_size", F.lit(capacity))
    total = pieces.count()
    groups = max(1, -(-total // group_items))
    grouped = pieces.withColumn("_group", F.pmod(F.xxhash64("_key", "piece_no"), F.lit(groups)).cast("int"))
    kept = items.schema[key].dataType.simpleString()

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["_key", "piece_no"], kind="stable").reset_index(drop=True)
        number = pd.Series(0, index=rows.index)
        for at, window in enumerate(pack(rows["piece_size"].tolist(), capacity)):
            number.iloc[window] = at
        container = rows["_group"].astype(str) + "-" + number.astype(str)
        return pd.DataFrame({"container": container, key: rows["_key"], "piece_no": rows["piece_no"], "piece_start": rows["piece_start"], "piece_size": rows["piece_size"]})

    # few bytes but much work a row: the number of tasks follows the groups, not the bytes
    spread = grouped.select("_group", "_key", "piece_no", "piece_start", "piece_size").repartition(max(1, groups // GROUPS_A_TASK), "_group")
    return spread.groupBy("_group").applyInPandas(
        work, f"container string, `{key}` {kept}, piece_no int, piece_start long, piece_size long"
    )


def fill_report(filled: DataFrame, capacity: int) -> DataFrame:
    """One row: containers, pieces, size packed, unused share of the containers' space, and the fullest container."""
    each = filled.groupBy("container").agg(F.sum("piece_size").alias("used"), F.count("*").alias("pieces"))
    return each.agg(
        F.count("*").alias("containers"), F.sum("pieces").alias("pieces"), F.sum("used").alias("used"), F.max("used").alias("fullest"),
        (F.lit(1.0) - F.sum("used") / (F.count("*") * F.lit(capacity))).alias("unused_share"),
    )
