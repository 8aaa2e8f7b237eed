import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import mixing, packing, tokens


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 100), max_size=80))
def test_windows_hold_every_item_once(sizes):
    windows = packing.pack(sizes, 100)
    assert sorted(i for w in windows for i in w) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in w) <= 100 for w in windows)


def test_differencing_balances():
    windows = packing.differencing([8, 7, 6, 5, 4], 2)
    assert abs(sum([8, 7, 6, 5, 4][i] for i in windows[0]) - 15) <= 1
    assert packing.differencing([], 2) == [[], []] and packing.pack([], 5) == []
    with pytest.raises(ValueError):
        packing.pack([6], 5)


def test_containers(spark):
    rows = [(i, (i * 37) % 900 + 1, "clash") for i in range(700)] + [(9000, 5000, "x"), (9001, 0, "x"), (9002, None, "x"), (9003, 1000, "x"), (0, 1, "clash")]
    df = spark.createDataFrame(rows, "doc long, n long, container string")
    filled = packing.fill_containers(df, "doc", "n", 1000, group_items=200)
    got = filled.collect()
    by = {}
    for r in got:
        by[r.container] = by.get(r.container, 0) + r.piece_size
    assert max(by.values()) <= 1000 and {r.doc for r in got} == {r[0] for r in rows} - {9002}
    assert sorted((r.piece_start, r.piece_size) for r in got if r.doc == 9000) == [(i * 1000, 1000) for i in range(5)]
    assert all(sum(x.doc == r.doc for x in got) == 1 for r in got if r.doc not in (9000,))
    report = packing.fill_report(filled, 1000).first()
    assert report.unused_share < 0.06 and report.fullest <= 1000
    assert packing.fill_containers(df.limit(0), "doc", "n", 1000).count() == 0


def test_tokens(spark):
    df = spark.createDataFrame([("Some words <|endoftext|>",), ("",), (None,), ("long " * 50_000,)], "t string")
    counts = [r.n for r in df.select(tokens.token_count("t").alias("n")).collect()]
    own = tokens.encoding(tokens.default_path())
    assert counts[0] == len(own.encode_ordinary("Some words <|endoftext|>")) and counts[1:3] == [0, None] and counts[3] > 50_000 - 2


SOURCES = [mixing.Source("big", 900_000, 0.2, 1), mixing.Source("mid", 90_000, 0.5, 2), mixing.Source("small", 9_000, 0.2, 4), mixing.Source("none", 0, 0.1, 9)]


def test_exponents():
    assert mixing.weights(SOURCES, 0)["mid"] == pytest.approx(0.5 / 0.9) and mixing.weights(SOURCES, 1)["big"] == pytest.approx(900 / 999)
    assert mixing.bisect_exponent(SOURCES) == 0.0
    size = 600_000
    x = mixing.bisect_exponent(SOURCES, size)
    assert 0 < x < 1 and size <= mixing.largest_exact(SOURCES, mixing.weights(SOURCES, x)) <= size * 1.001
    wanted = 0.5
    assert mixing.entropy(mixing.weights(SOURCES, mixing.bisect_exponent(SOURCES, target_entropy=wanted))) == pytest.approx(wanted, abs=1e-6)
    assert mixing.budgets([], None) == ({}, 0.0)


def test_mixture(spark):
    rows = [(i, "big" if i % 3 else "mid", 50 + i % 7, "clash") for i in range(6000)] + [(10_000 + i, "small", 60, "x") for i in range(40)] + [(20_000, None, 50, "x"), (20_001, "other", 50, "x"), (20_002, "big", None, "x"), (1, "big", 51, "clash")]
    df = spark.createDataFrame(rows, "doc long, source string, n long, times string")
    targets = spark.createDataFrame([("big", 0.6, 1), ("mid", 0.3, 2), ("small", 0.05, 3), ("gone", 0.05, 2)], "source string, target_share double, max_repeats long")
    mixture, report = mixing.mix(df, "doc", "source", "n", targets)
    got, shares = mixture.collect(), {r.source: r for r in report.collect()}
    caps = {"big": 1, "mid": 2, "small": 3}
    assert len({r.doc for r in got}) == len(got) and all(1 <= r.times <= caps[r.source] for r in got)
    for name, share in (("big", 0.6), ("mid", 0.3), ("small", 0.05)):
        assert shares[name].actual_share == pytest.approx(share / 0.95, abs=0.01)
    assert shares["gone"].actual_tokens == 0 and sum(s.actual_share for s in shares.values()) == pytest.approx(1)
    empty, blank = mixing.mix(df.limit(0), "doc", "source", "n", targets)
    assert empty.count() == 0 and blank.count() == 4


def test_a_size_beyond_the_targets_moves_the_exponent(spark):
    """At the size of all that is there the caps bind: shares move from the targets no further than they must."""
    df = spark.createDataFrame([(i, "big" if i >= 300 else "small", 50) for i in range(6000)], "doc long, source string, n long")
    targets = spark.createDataFrame([("big", 0.5, 2), ("small", 0.5, 2)], "source string, target_share double, max_repeats long")
    mixture, report = mixing.mix(df, "doc", "source", "n", targets, size=300_000)
    shares = {r.source: r for r in report.collect()}
    assert 0 < shares["small"].exponent < 1 and shares["small"].actual_share == pytest.approx(0.1, abs=0.005)
    assert shares["small"].most_times == 2 and sum(s.actual_tokens for s in shares.values()) == pytest.approx(300_000, rel=0.01)
    assert {r.times for r in mixture.where("source = 'small'").collect()} == {2}
