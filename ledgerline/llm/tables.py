"""Tables of fixed size made from all rows: counts and bitmaps over hashed values.

Their size depends on a parameter alone, never on the data, so they can be sent to every
executor. Each task adds up its rows in one array and hands over a compressed slice per range;
ranges are added up in parallel, and only the finished table passes through the driver, as it is:
the same number of bytes for any data.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANGES = 32


def slices(cells: np.ndarray) -> tuple[list[int], list[bytes]]:
    """The non-zero slices of a task's cells, compressed, with their range numbers."""
    parts = cells.reshape(RANGES, -1)
    kept = [i for i in range(RANGES) if parts[i].any()]
    return kept, [zlib.compress(parts[i].tobytes(), 1) for i in kept]


def combined(parts: DataFrame, size: int, dtype: str, combine: str) -> np.ndarray:
    """The table made of all tasks' slices: parts has the columns range and cells; combine is "sum" (saturating) or "or"."""
    if size % RANGES:
        raise ValueError(f"size must be a multiple of {RANGES}")
    most = np.iinfo(dtype).max

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, blob in zip(batch["range"].to_pylist(), batch["cells"], strict=True):
                own = np.frombuffer(zlib.decompress(blob.as_buffer()), dtype=dtype)
                if i not in sums:
                    sums[i] = own.astype("uint64" if combine == "sum" else dtype)
                elif combine == "sum":
                    sums[i] += own
                else:
                    sums[i] |= own
        if sums:
            yield pa.RecordBatch.from_pydict(
                {"range": pa.array(list(sums), pa.int32()), "cells": pa.array([np.minimum(x, most).astype(dtype).tobytes() for x in sums.values()], pa.binary())}
            )

    added = parts.select("range", "cells").repartition(F.col("range")).mapInArrow(whole, "range int, cells binary")
    table = np.zeros((RANGES, size // RANGES), dtype=dtype)
    for row in added.collect():
        table[row["range"]] = np.frombuffer(row["cells"], dtype=dtype)
    return table.reshape(-1)


def counted(cells: np.ndarray, size: int) -> tuple[list[int], list[bytes]]:
    """How often each cell occurs, for tables of which a task fills a small part: the numbers of the ranges met and,
    compressed, the steps from cell to cell and the counts of each."""
    cells, counts = np.unique(cells, return_counts=True)
    at, starts = np.unique(cells // (size // RANGES), return_index=True)
    blobs = []
    for i, a, b in zip(at, starts, [*starts[1:], cells.size], strict=True):
        steps = np.diff(cells[a:b], prepend=i * (size // RANGES))
        blobs.append(zlib.compress(steps.astype(np.uint32).tobytes() + np.minimum(counts[a:b], np.iinfo(np.uint32).max).astype(np.uint32).tobytes(), 1))
    return at.tolist(), blobs


def added(parts: DataFrame, size: int, code: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The table made of what counted() gave for all batches (columns range and cells); code makes a byte of every sum."""
    if size % RANGES:
        raise ValueError(f"size must be a multiple of {RANGES}")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, blob in zip(batch["range"].to_pylist(), batch["cells"], strict=True):
                steps, counts = np.frombuffer(zlib.decompress(blob.as_buffer()), dtype=np.uint32).reshape(2, -1)
                own = sums.setdefault(i, np.zeros(size // RANGES, dtype=np.int64))
                own[np.cumsum(steps, dtype=np.int64)] += counts
        for i, own in sums.items():
            yield pa.RecordBatch.from_pydict({"range": pa.array([i], pa.int32()), "cells": pa.array([code(own).tobytes()], pa.binary())})

    table = np.zeros((RANGES, size // RANGES), dtype=np.uint8)
    for row in parts.select("range", "cells").repartition(F.col("range")).mapInArrow(whole, "range int, cells binary").collect():
        table[row["range"]] = np.frombuffer(row["cells"], dtype=np.uint8)
    return table.reshape(-1)


def fixed_table(df: DataFrame, add: Callable[[pa.RecordBatch, np.ndarray], None], size: int, dtype: str, combine: str) -> np.ndarray:
    """The table of `size` cells that add(batch, cells) fills, over all of df's rows.

    add is called with each Arrow batch and the task's own cells (dtype).
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(size, dtype=dtype)
        for batch in batches:
            add(batch, cells)
        kept, blobs = slices(cells)
        yield pa.RecordBatch.from_pydict({"range": pa.array(kept, pa.int32()), "cells": pa.array(blobs, pa.binary())})

    return combined(df.mapInArrow(partial, "range int, cells binary"), size, dtype, combine)
