import itertools
import random

import numpy as np
import pytest

from ledgerline.llm import neardup
from ledgerline.llm.lookalikes import mapped_text


def runs(text, width):
    words = text.lower().split()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def brute(rows, width, threshold, looks=None):
    found = set()
    rows = sorted({(k, i, mapped_text(t) if k == looks else t) for k, i, t in rows if t is not None})
    for (k, a, s), (m, b, t) in itertools.combinations(rows, 2):
        x, y = runs(s, width), runs(t, width)
        if k == m and a != b and len(x & y) / len(x | y) >= threshold:
            found.add((k, min(a, b), max(a, b)))
    return found


def corpus(seed, vocabulary=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    rows, n = [], 0
    for _ in range(25):
        base = [rng.choice(words) for _ in range(rng.randrange(3, 60))]
        for _ in range(rng.randrange(1, 5)):
            text = list(base)
            for _ in range(rng.randrange(0, 4)):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append(("document" if n % 3 else "snippet", f"d{n:03}", " ".join(text)))
            n += 1
    extra = ["", "", " ", "one", "ONE", "two words", "two  words", "caf\u00e9 is open now ok", "cafe\u0301 is open now ok", None]
    return rows + [("document", f"x{i}", t) for i, t in enumerate(extra)] + rows[:3]


@pytest.mark.parametrize(("seed", "width", "threshold", "hot"), [(1, 3, 0.7, 4096), (2, 5, 0.8, 4), (3, 1, 0.5, 6)])
def test_pairs_against_brute_force(spark, monkeypatch, seed, width, threshold, hot):
    monkeypatch.setattr(neardup, "BLOCK_CLASSES", hot)
    rows = corpus(seed)
    df = spark.createDataFrame([(*r, "clash") for r in rows], "kind string, key string, text string, c1 string")
    found = {tuple(r) for r in neardup.near_duplicate_pairs(df, width, threshold, looks="document").collect()}
    assert found == brute(rows, width, threshold, "document")


def test_groups_and_copies(spark):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [("document", f"c{i}", base) for i in range(40)] + [("document", "near", base + " more"), ("document", "far", "something else entirely is here"), ("document", "null", None)]
    df = spark.createDataFrame(rows, "kind string, key string, text string")
    found = {r.key: r for r in neardup.near_duplicate_groups(df).collect()}
    assert found["c0"].copies == 40 and found["c0"].links == 1 and found["c0"].group_id == found["near"].group_id
    assert found["far"].links == 0 and found["far"].group_id == found["far"].class_id and "null" not in found


def test_empty(spark):
    df = spark.createDataFrame([], "kind string, key string, text string")
    assert neardup.near_duplicate_pairs(df, 3, 0.7).count() == 0


def test_frequent_runs_are_joined_block_by_block(spark, monkeypatch):
    """Many different texts that share most of their runs: every pair is found, each counted once."""
    monkeypatch.setattr(neardup, "BLOCK_CLASSES", 2)
    base = [f"w{i}" for i in range(30)]
    rows = [("document", f"d{i:02}", " ".join([*base, f"end{i}"])) for i in range(20)]
    df = spark.createDataFrame(rows, "kind string, key string, text string")
    member, counts, total = neardup.classes(df, 3, None)
    monkeypatch.setattr(neardup, "_blocks", lambda c: 1 + c.astype("int64") // 2)
    pairs = neardup.class_pairs(df, counts, total, 3, 0.7, range_runs=50).collect()
    assert len(pairs) == len({tuple(sorted((p.a1, p.b1))) for p in pairs}) == 190 and member.count() == 20


def test_suffix_filter_is_a_lower_bound():
    rng = np.random.default_rng(5)
    for _ in range(300):
        a, b = (np.unique(rng.integers(0, 60, rng.integers(0, 40)).astype(np.uint64)) for _ in range(2))
        true = np.setxor1d(a, b).size
        for most in (0, 5, 1000):
            bound = neardup._least_difference(a, b, most)
            assert bound <= true and neardup._least_difference(a, b, 1000, depth=20) == true


def test_matches_behind_a_pairs_prefixes_stay_in_their_range():
    """Of texts of 300 runs each that share one in the last third of what is sent no match leaves the range; one they could begin with does."""
    shared = {position: [(np.array([9, 9], np.uint32), np.zeros(2, np.int8), np.array([1, 2]), np.full(2, 300, np.int32), np.full(2, position, np.int32))] for position in (0, 52, 57, 58, 89)}
    sent = {position: sum(b.num_rows for b in neardup._range_matches(parts, 0.7)) for position, parts in shared.items()}
    # 248 of 300 runs must be common; six matches are asked for
    assert sent == {0: 1, 52: 1, 57: 1, 58: 0, 89: 0}


def test_prefix_matches_drop_no_pair_that_reaches_the_threshold():
    rng = random.Random(11)
    for _ in range(400):
        t, universe = rng.choice([0.5, 0.7, 0.8]), range(rng.randrange(2, 200))
        a = set(rng.sample(universe, rng.randrange(1, len(universe) + 1)))
        b = {x for x in a if rng.random() < 0.95} | set(rng.sample(universe, rng.randrange(0, 1 + len(universe) // 5)))
        if not b or len(a & b) / len(a | b) < t:
            continue
        a, b = sorted(a), sorted(b)
        both = [(a.index(x), b.index(x)) for x in a[: neardup._prefix(len(a), t)] if x in b[: neardup._prefix(len(b), t)]]
        n = np.full(len(both), len(a)), np.full(len(both), len(b))
        k, spare = neardup._demands(t, *n, *(np.array(p) for p in zip(*both, strict=True)))
        assert (spare > -k).sum() >= k[0] and spare.max() >= 0


def test_the_table_of_counts_tells_rare_runs_from_frequent_ones(spark):
    """A text of a hundred thousand runs that come once fills no cell so far that one looks like a run of 60 texts."""
    rows = [("document", "long", " ".join(f"x{i}" for i in range(100_000)))] + [("document", f"d{i}", f"all of them own{i}") for i in range(60)]
    member, counts, total = neardup.classes(spark.createDataFrame(rows, "kind string, key string, text string"), 3, None)
    held = neardup.LEVELS[counts]
    assert total == 99_998 + 120 and member.count() == 61
    assert (held >= 50).sum() == 1 and held[held < 50].max() <= 3 and (held > 0).sum() > 99_500
