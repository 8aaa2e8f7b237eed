from itertools import combinations

from ledgerline.operators.pairing import pairs_within


def test_every_pair_once_whatever_the_blocks(spark):
    rows = [("hot", f"m{i:02}", i) for i in range(40)] + [("two", "x", 1), ("two", "y", 2), ("one", "z", 3), (None, "q", 4), ("two", None, 5)]
    df = spark.createDataFrame(rows, "k string, m string, v int")
    expected = sorted(("hot", f"m{a:02}", f"m{b:02}", a, b) for a, b in combinations(range(40), 2)) + [("two", "x", "y", 1, 2)]
    for size in (1, 7, 1000):
        assert sorted(tuple(r) for r in pairs_within(df, ["k"], "m", ["v"], block_rows=size).collect()) == expected
    assert pairs_within(df.limit(0), ["k"], "m").count() == 0
