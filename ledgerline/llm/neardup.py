"""Problem 3: near-duplicates by rare-first prefix filtering, without comparing every pair.

Similarity of two texts is the number of distinct runs of `width` words in both, divided by the
number in either. The plan, for a threshold t:

1. One pass hashes every text to its class (texts with the same words are one class) and counts,
   in a table of fixed size, how often each run occurs in the whole collection (by hashed bucket and
   in steps of a ninth: any order is a correct one, and this one puts rare runs first).
2. A second pass sorts each class's runs rarest first and keeps the prefix of n - ceil(t n) + 1
   runs: two texts that reach t share a run of their prefixes. Prefix runs travel in arrays by hash
   range; there are as many ranges as RANGE_RUNS prefix runs go into, so a task's share stays the
   same however much data there is. A run the table of counts holds for frequent is cut into blocks
   of classes beforehand, and every two blocks meet under a key of their own, in another range.
3. Within a range, equal runs give pairs of classes, cut by the length filter (sizes within t). Of a
   pair that needs o common runs, the first k of them lie within the first n - o + k runs of either
   side: matches behind that are dropped where they are found, so that pairs of classes with little
   in common seldom leave their range. The rest are added up; the positional filter drops pairs with
   too little left from their first match on, the count filter those with fewer than k matches.
4. The classes of the remaining pairs are read again and their full run sets joined to the pairs. The
   suffix filter parts both sets at the same runs, recursively, and drops a pair as soon as the parts'
   sizes differ by more than t allows; what is left is verified once, exactly.

Every step is lossless: what the filters drop can't reach the threshold. Copies cost one class and
are expanded only where a caller asks for pairs of rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import lookalikes, shingles, tables
from ledgerline.operators.graph import connected_components
from ledgerline.operators.pairing import pairs_within
from ledgerline.plans.lineage import cut

#: Cells of the table of counts (a byte each) and bytes of the candidates' bitmap: fixed sizes. Where many
#: runs share a cell a rare one counts for frequent, and the prefixes fill with runs that all texts have.
COUNT_CELLS = 1 << 26
BITMAP_BYTES = 1 << 22
#: The counts that a cell can hold: exact at first, then in steps of a ninth.
LEVELS = np.r_[np.arange(16), np.ceil(16 * 1.11 ** np.arange(240))].astype(np.int64)
#: Prefix runs (about 50 bytes each while they are joined) that one range holds.
RANGE_RUNS = 2_000_000
#: Classes a block of a frequent run holds.
BLOCK_CLASSES = 4096
#: Matches within their prefixes that pairs must have, where their sizes allow to ask for so many: more of
#: them mean fewer candidates, but longer prefixes and so more matches to add up.
PREFIX_MATCHES = 6
#: Recursions of the suffix filter.
SUFFIX_DEPTH = 4
WIDTH, THRESHOLD = 5, 0.8


def _prefix(n: int, t: float) -> int:
    return n - math.ceil(t * n - 1e-6) + 1


def _hashed(batch: pa.RecordBatch, looks: str | None) -> Iterator[tuple[int, np.ndarray]]:
    """(row, word hashes) of each non-null text; kinds never share a hash, and an empty text has one."""
    kinds = batch["kind"].to_pylist()
    for i, text in enumerate(batch["text"].to_pylist()):
        if text is None:
            continue
        if kinds[i] == looks:
            text = lookalikes.mapped_text(text)
        words = shingles.word_hashes(text)
        salt = np.uint64(shingles._memo["\x00" + kinds[i]])
        yield i, words ^ salt if words.size else np.array([salt], dtype=np.uint64)


def _cells(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - COUNT_CELLS.bit_length() + 1)).astype(np.int64)


def _levels(counts: np.ndarray) -> np.ndarray:
    return (np.searchsorted(LEVELS, counts, side="right") - 1).astype(np.uint8)


def _bits(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    spread = shingles.mix(ids.astype(np.int64).view(np.uint64)) & np.uint64(BITMAP_BYTES * 8 - 1)
    return (spread >> np.uint64(3)).astype(np.int64), np.left_shift(1, (spread & np.uint64(7)).astype(np.int64)).astype(np.uint8)


_CLASSES = "kind string, key string, c1 long, c2 long, n_runs int, range int, cells binary"


def classes(df: DataFrame, width: int, looks: str | None) -> tuple[DataFrame, np.ndarray, int]:
    """((kind, key, c1, c2), counts, runs): every non-null text of df (kind, key, text) with its class, how
    often runs fall into each cell of the table of counts (as one of LEVELS), and how many there are. One pass over the texts gives all."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, ones, twos, found = [], [], [], []
            for i, words in _hashed(batch, looks):
                one, two = shingles.content_hash(words)
                rows.append(i)
                ones.append(one)
                twos.append(two)
                found.append(_cells(shingles.runs(words, width)))
            if not rows:
                continue
            kept = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [kept["kind"], kept["key"], pa.array(ones, pa.int64()), pa.array(twos, pa.int64()), pa.array([f.size for f in found], pa.int32()), pa.nulls(len(rows), pa.int32()), pa.nulls(len(rows), pa.binary())],
                ["kind", "key", "c1", "c2", "n_runs", "range", "cells"],
            )
            at, blobs = tables.counted(np.concatenate(found), COUNT_CELLS)
            blank = [pa.nulls(len(at), t) for t in (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int32())]
            yield pa.RecordBatch.from_arrays([*blank, pa.array(at, pa.int32()), pa.array(blobs, pa.binary())], ["kind", "key", "c1", "c2", "n_runs", "range", "cells"])

    both = cut(df.select("kind", "key", "text").mapInArrow(work, _CLASSES))
    counts = tables.added(both.where("range is not null"), COUNT_CELLS, _levels)
    runs = both.agg(F.sum("n_runs")).first()[0] or 0
    return both.where("range is null").select("kind", "key", "c1", "c2").distinct(), counts, runs


def _met(run: np.ndarray, place: np.ndarray, blocks: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, run, side): where each posting goes; rows of a run of several blocks go to all pairs of blocks with their own.

    side is 0 where all of a group is paired, else 1 or 2 for the two blocks that are paired with each other.
    """
    own = (shingles.mix(ids[place].view(np.uint64) + np.uint64(1)) % blocks.astype(np.uint64)).astype(np.int64)
    row = np.repeat(np.arange(run.size), blocks)
    other = np.arange(row.size) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    own, many = own[row], blocks[row] > 1
    low, high = np.minimum(own, other), np.maximum(own, other)
    met = run[row]
    met[many] = shingles.mix(met[many] + (low[many].astype(np.uint64) << np.uint64(32)) + high[many].astype(np.uint64))
    side = np.where(low == high, 0, np.where(own == low, 1, 2)).astype(np.int8)
    return row, met, side


def _blocks(counts: np.ndarray) -> np.ndarray:
    """Into how many blocks of classes runs of these counts go."""
    return 1 + counts // BLOCK_CLASSES


def _postings(width: int, t: float, looks: str | None, counts, mean: int, ranges: int) -> Callable:
    """Texts -> per batch and range: the prefix runs as arrays (32 bits of the run, side, place of its class, position)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a cell holds rare runs and at times a frequent one, which is what exceeds twice the mean
        often, into = counts.value, _blocks(np.maximum(LEVELS - 2 * mean, 0))
        for batch in batches:
            # copies within a batch come once, others are dropped where their range is joined
            seen: set[int] = set()
            ids, sizes, firsts, places, positions = [], [], [], [], []
            for _, words in _hashed(batch, looks):
                one, _ = shingles.content_hash(words)
                if one in seen:
                    continue
                seen.add(one)
                own = shingles.shingle_set(words, width)
                take = _prefix(own.size, t)
                order = np.lexsort((own, often[_cells(own)]))[:take]
                firsts.append(own[order])
                positions.append(np.arange(take, dtype=np.int32))
                places.append(np.full(take, len(ids), dtype=np.int32))
                ids.append(one)
                sizes.append(own.size)
            if not ids:
                continue
            runs, place, position = np.concatenate(firsts), np.concatenate(places), np.concatenate(positions)
            ids, sizes = np.array(ids, dtype=np.int64), np.array(sizes, dtype=np.int32)
            row, run, side = _met(shingles.mix(runs), place, into[often[_cells(runs)]], ids)
            part = (run % np.uint64(ranges)).astype(np.int32)
            order = np.argsort(part, kind="stable")
            part, run, side = part[order], (run[order] >> np.uint64(32)).astype(np.uint32), side[order]
            place, position = place[row][order], position[row][order]
            edges = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True])
            out = {"range": [], "run": [], "side": [], "place": [], "position": [], "ids": [], "sizes": []}
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                here, local = np.unique(place[a:b], return_inverse=True)
                out["range"].append(int(part[a]))
                out["run"].append(run[a:b].tobytes())
                out["side"].append(side[a:b].tobytes())
                out["place"].append(local.astype(np.int32).tobytes())
                out["position"].append(position[a:b].tobytes())
                out["ids"].append(ids[here].tobytes())
                out["sizes"].append(sizes[here].tobytes())
            yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.int32() if k == "range" else pa.binary()) for k, v in out.items()})

    return work


_POSTINGS = "range int, run binary, side binary, place binary, position binary, ids binary, sizes binary"
_NUMBERS = {"a": pa.int64(), "b": pa.int64(), "common": pa.int32(), "mark": pa.int32()}
_MATCHES = "a long, b long, common int, mark int"


def _match_batch(a: np.ndarray, b: np.ndarray, common: np.ndarray, mark: np.ndarray) -> pa.RecordBatch:
    """Matches of pairs of classes: the number of common runs, and what _needed() makes of the pair."""
    return pa.RecordBatch.from_arrays([pa.array(v, kind) for v, kind in zip((a, b, common, mark), _NUMBERS.values(), strict=True)], list(_NUMBERS))


def _demands(t: float, n_a: np.ndarray, n_b: np.ndarray, p_a: np.ndarray, p_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(k, spare): how many matches a pair must have within its prefixes, and by how many runs what is left
    from a match on (its run included) exceeds the o common runs that the pair's sizes and t demand.

    Of a pair's common runs the k-th from the rare end has o - k others behind it at least, on either
    side: it and those before it have a spare of 1 - k or more, the first one of 0. The prefixes that
    were sent end where no more than t n - 1 runs are left, which limits k for sizes that differ much.
    """
    need = np.ceil(t / (1 + t) * (n_a.astype(np.float64) + n_b) - 1e-6).astype(np.int64)
    rest = np.maximum(np.ceil(t * n_a - 1e-6), np.ceil(t * n_b - 1e-6)).astype(np.int64) - 1
    left = np.minimum(n_a.astype(np.int64) - p_a, n_b.astype(np.int64) - p_b)
    return np.clip(need - rest, 1, PREFIX_MATCHES), left - need


def _needed(t: float, n_a: np.ndarray, n_b: np.ndarray, p_a: np.ndarray, p_b: np.ndarray) -> np.ndarray:
    """Twice the matches that a pair needs within its prefixes, plus 1 if what is left from its first match on suffices.

    The first part is the same in every range, the second one is true in the range of the pair's
    first match if it is true at all.
    """
    k, spare = _demands(t, n_a, n_b, p_a, p_b)
    return 2 * k + (spare >= 0)


class _Pairs:
    """Adds up matches per pair of classes and hands them over in batches."""

    LIMIT = 1_000_000

    def __init__(self, t: float) -> None:
        self.t = t
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.held = 0

    def add(self, a, b, n_a, n_b, p_a, p_b) -> None:
        swap = a > b
        both = ((a, b), (n_a, n_b), (p_a, p_b))
        self.parts.append(tuple(np.where(swap, x, y) for one, two in both for x, y in ((two, one), (one, two))))
        self.held += a.size

    def flush(self, least: int = 0) -> Iterator[pa.RecordBatch]:
        if self.held <= least:
            return
        a, b, n_a, n_b, p_a, p_b = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        self.parts, self.held = [], 0
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        new = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        firsts = np.minimum.reduceat(p_a[order], new), np.minimum.reduceat(p_b[order], new)
        out = a[new], b[new], np.diff(np.r_[new, a.size]), _needed(self.t, n_a[order][new], n_b[order][new], *firsts)
        for at in range(0, new.size, 100_000):
            yield _match_batch(*(v[at : at + 100_000] for v in out))


def _filtered(pairs: _Pairs, t: float, ida, na, pa_, idb, nb, pb) -> None:
    """Keep matches that pass the length filter and lie within the prefixes of their pair."""
    k, spare = _demands(t, na, nb, pa_, pb)
    keep = (np.minimum(na, nb) >= t * np.maximum(na, nb) - 1e-6) & (ida != idb) & (spare > -k)
    if keep.any():
        pairs.add(ida[keep], idb[keep], na[keep], nb[keep], pa_[keep], pb[keep])


def _join(t: float) -> Callable:
    """Postings of a whole range (a partition) -> matches."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for batch in batches:
            columns = {name: batch[name] for name in ("run", "side", "place", "position", "ids", "sizes")}
            for i in range(batch.num_rows):
                get = lambda name, kind, i=i: np.frombuffer(columns[name][i].as_buffer(), dtype=kind)  # noqa: E731, B023
                place = get("place", np.int32)
                parts.append((get("run", np.uint32), get("side", np.int8), get("ids", np.int64)[place], get("sizes", np.int32)[place], get("position", np.int32)))
        if parts:
            yield from _range_matches(parts, t)

    return work


def _range_matches(parts: list[tuple], t: float) -> Iterator[pa.RecordBatch]:
    """The matches of one range, whose postings are in arrays."""
    run, side, ids, n, position = (np.concatenate(x) for x in zip(*parts, strict=True))
    parts.clear()
    order = np.lexsort((ids, n, run))
    run, side, ids, n, position = run[order], side[order], ids[order], n[order], position[order]
    once = np.r_[True, (run[1:] != run[:-1]) | (ids[1:] != ids[:-1])]
    start = np.r_[True, run[1:] != run[:-1]]
    # a run of a single class can't join anything
    several = ~(start & np.r_[start[1:], True]) & once
    run, side, ids, n, position = run[several], side[several], ids[several], n[several], position[several]
    if not run.size:
        return
    pairs = _Pairs(t)
    edges = np.flatnonzero(np.r_[True, run[1:] != run[:-1], True])
    length = np.diff(edges)
    left = np.repeat(length, length) - (np.arange(run.size) - np.repeat(edges[:-1], length)) - 1
    active, step = np.flatnonzero(left > 0), 1
    while active.size:
        other = active + step
        close = n[active] >= t * n[other] - 1e-6
        active, other = active[close], other[close]
        # two classes of one block are paired in that block's own group
        x, y = side[active], side[other]
        meet = (x == 0) | (y == 0) | (x != y)
        _filtered(pairs, t, ids[active[meet]], n[active[meet]], position[active[meet]], ids[other[meet]], n[other[meet]], position[other[meet]])
        yield from pairs.flush(_Pairs.LIMIT)
        step += 1
        active = active[left[active] >= step]
    yield from pairs.flush()


def _candidates(matches: DataFrame) -> DataFrame:
    """(a, b): pairs that pass the positional filter (what is left from the first match on suffices)
    and the count filter (there are as many matches in the prefixes as the pair needs there)."""
    added = matches.groupBy("a", "b").agg(F.sum("common").alias("common"), F.max("mark").alias("mark"))
    return added.where((F.col("mark") % 2 == 1) & (F.col("common") >= F.floor(F.col("mark") / 2))).select("a", "b")


def _run_sets(df: DataFrame, width: int, looks: str | None, bitmap) -> DataFrame:
    """(c1, c2, runs): the sorted run set of every class whose id the bitmap may hold."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value
        for batch in batches:
            ones, twos, sets = [], [], []
            for _, words in _hashed(batch, looks):
                one, two = shingles.content_hash(words)
                byte, bit = _bits(np.array([one], dtype=np.int64))
                if bits[byte[0]] & bit[0]:
                    ones.append(one)
                    twos.append(two)
                    sets.append(shingles.shingle_set(words, width).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ones, pa.int64()), pa.array(twos, pa.int64()), pa.array(sets, pa.binary())], ["c1", "c2", "runs"])

    rows = df.select("kind", "text").mapInArrow(work, "c1 long, c2 long, runs binary")
    return rows.groupBy("c1", "c2").agg(F.first("runs").alias("runs"))


def _least_difference(a: np.ndarray, b: np.ndarray, most: int, depth: int = SUFFIX_DEPTH) -> int:
    """A lower bound of the number of runs in only one of two sorted sets; beyond `most` it needn't be tight.

    Both sets are parted at the middle run of the larger; the parts' sizes alone give a bound, which
    parting them further raises (Xiao et al., 2008).
    """
    bound = abs(a.size - b.size)
    if depth == 0 or bound > most or not a.size or not b.size:
        return bound
    large, small = (a, b) if a.size >= b.size else (b, a)
    middle = large.size // 2
    at = int(np.searchsorted(small, large[middle]))
    found = at < small.size and small[at] == large[middle]
    left, right = (large[:middle], small[:at]), (large[middle + 1 :], small[at + found :])
    apart = abs(left[0].size - left[1].size) + abs(right[0].size - right[1].size) + (not found)
    if apart > most:
        return apart
    right_sizes = abs(right[0].size - right[1].size)
    in_left = _least_difference(*left, most - right_sizes - (not found), depth - 1)
    if in_left + right_sizes + (not found) > most:
        return in_left + right_sizes + (not found)
    return in_left + (not found) + _least_difference(*right, most - in_left - (not found), depth - 1)


def _alike(a: np.ndarray, b: np.ndarray, t: float) -> float:
    """The similarity of two sorted sets, or 0.0 where the suffix filter shows that it stays below t."""
    # t * either <= common, and the runs in only one of the sets are either - common
    most = a.size + b.size - 2 * math.ceil(t / (1 + t) * (a.size + b.size) - 1e-6)
    return shingles.similarity(a, b) if _least_difference(a, b, most) <= most else 0.0


def _verified(pairs: DataFrame, t: float) -> DataFrame:
    kept = "a1 long, a2 long, b1 long, b2 long, similarity double"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alike = [_alike(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), t) for x, y in zip(batch["a_runs"], batch["b_runs"], strict=True)]
            out = pa.RecordBatch.from_arrays([*(batch[c] for c in ("a1", "a2", "b1", "b2")), pa.array(alike, pa.float64())], ["a1", "a2", "b1", "b2", "similarity"])
            yield out.filter(pa.array([s >= t - 1e-12 for s in alike], pa.bool_()))

    return pairs.mapInArrow(work, kept)


def class_pairs(
    df: DataFrame, counts: np.ndarray, runs: int, width: int = WIDTH, threshold: float = THRESHOLD, looks: str | None = None, range_runs: int = RANGE_RUNS
) -> DataFrame:
    """(a1, a2, b1, b2, similarity): every pair of different classes that reaches the threshold.

    df has kind, key and text, counts and runs are what classes() gives; only rows of one kind are
    compared with each other. Texts of kind `looks` are compared as they look (see lookalikes).
    Null texts take no part.
    """
    spark: SparkSession = df.sparkSession
    sc = spark.sparkContext
    # of n runs about (1 - t) n are prefix; small collections still give every task something
    ranges = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(runs * (1 - threshold)) // range_runs))
    counts = sc.broadcast(counts)
    postings = df.select("kind", "text").mapInArrow(_postings(width, threshold, looks, counts, runs // COUNT_CELLS, ranges), _POSTINGS)
    matches = postings.repartitionById(ranges, F.col("range")).mapInArrow(_join(threshold), _MATCHES)
    pairs = cut(_candidates(matches))

    def add(batch: pa.RecordBatch, cells: np.ndarray) -> None:
        for side in ("a", "b"):
            byte, bit = _bits(batch[side].to_numpy(zero_copy_only=False))
            np.bitwise_or.at(cells, byte, bit)

    bitmap = sc.broadcast(tables.fixed_table(pairs, add, BITMAP_BYTES, "uint8", "or"))
    sets = cut(_run_sets(df, width, looks, bitmap))
    one = sets.select(F.col("c1").alias("a"), F.col("c1").alias("a1"), F.col("c2").alias("a2"), F.col("runs").alias("a_runs"))
    two = sets.select(F.col("c1").alias("b"), F.col("c1").alias("b1"), F.col("c2").alias("b2"), F.col("runs").alias("b_runs"))
    return _verified(pairs.join(one, "a").join(two, "b"), threshold)


def near_duplicate_pairs(df: DataFrame, width: int, threshold: float, looks: str | None = None) -> DataFrame:
    """(kind, key_a, key_b): all pairs of rows that reach the threshold, copies expanded, smaller key first.

    Rows repeated with one key and text count once. Null texts take no part; two empty texts are
    equal texts. Texts shorter than `width` words have one run, of all their words.
    """
    member, counts, runs = classes(df, width, looks)
    member = cut(member)
    linked = cut(class_pairs(df, counts, runs, width, threshold, looks))
    a, b = member.alias("a"), member.alias("b")
    same = pairs_within(member.select("kind", "c1", "c2", "key").distinct(), ["kind", "c1", "c2"], "key").select("kind", F.col("a_key").alias("key_a"), F.col("b_key").alias("key_b"))
    across = (
        linked.join(a, (F.col("a1") == F.col("a.c1")) & (F.col("a2") == F.col("a.c2")))
        .join(b, (F.col("b1") == F.col("b.c1")) & (F.col("b2") == F.col("b.c2")))
        .where("a.kind = b.kind and a.key <> b.key")
        .select("a.kind", F.least("a.key", "b.key").alias("key_a"), F.greatest("a.key", "b.key").alias("key_b"))
    )
    return same.unionByName(across).distinct()


def near_duplicate_groups(df: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD, looks: str | None = None) -> DataFrame:
    """(kind, key, class_id, copies, links, group_id): one row per row of df with a text.

    class_id names the class of equal texts, copies is its number of rows, links the number of other
    classes within the threshold of it, and group_id the group of classes connected by links.
    """
    member, counts, runs = classes(df, width, looks)
    member = cut(member.withColumn("class_id", F.concat_ws("-", F.lower(F.hex("c1")), F.lower(F.hex("c2")))))
    name = lambda one, two: F.concat_ws("-", F.lower(F.hex(one)), F.lower(F.hex(two)))
    linked = cut(class_pairs(df, counts, runs, width, threshold, looks).select(name("a1", "a2").alias("a"), name("b1", "b2").alias("b")))
    links = linked.select(F.col("a").alias("class_id")).unionByName(linked.select(F.col("b").alias("class_id"))).groupBy("class_id").agg(F.count("*").alias("links"))
    groups = connected_components(linked, "a", "b").select(F.col("node").alias("class_id"), F.col("component").alias("group_id"))
    copies = member.groupBy("class_id").agg(F.count("*").alias("copies"))
    rows = member.join(copies, "class_id").join(links, "class_id", "left").join(groups, "class_id", "left")
    return rows.select("kind", "key", "class_id", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("group_id", "class_id").alias("group_id"))
