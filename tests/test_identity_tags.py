import pytest

from ledgerline.functions import tags
from ledgerline.operators import identity


def pair(new, old, mentions=0, content=0, items=1, seed=""):
    return identity.Evidence(new, old, mentions, content, items, seed)


def test_pairs_are_one_to_one():
    assert identity.pair_up([pair("n1", "o1", 3), pair("n1", "o2", 1), pair("n2", "o1", 2), pair("n2", "o2", 1)]) == ({"n1": "o1", "n2": "o2"}, {})
    # a merge keeps the id it shares most with and leads the other to it
    assert identity.pair_up([pair("n", "big", 3), pair("n", "small", 1)]) == ({"n": "big"}, {"small": "n"})
    # a split keeps the id on one part: of equal ones the older
    assert identity.pair_up([pair("n1", "o", 1, seed="b"), pair("n2", "o", 1, seed="a")]) == ({"n2": "o"}, {})


def test_items_alone_carry_nothing():
    assert identity.pair_up([pair("n1", "o1")]) == ({}, {})
    assert identity.pair_up([pair("n1", "o1", content=2)]) == ({"n1": "o1"}, {})
    # the contents tell tranches of one item apart; two of one content are ambiguous and lead nowhere
    assert identity.pair_up([pair("n1", "o1", content=3), pair("n1", "o2", content=2), pair("n2", "o1", content=2), pair("n2", "o2", content=3)]) == ({"n1": "o1", "n2": "o2"}, {})
    assert identity.pair_up([pair(n, o, content=2) for n in ("n1", "n2") for o in ("o1", "o2")]) == ({}, {})


def test_carry_over_and_redirects(spark):
    schema = "instrument_id string, mention_id string, item_id string"
    now = spark.createDataFrame([("x", "m1", "i1"), ("x", "m2", "i2"), ("y", "m3", "i3"), ("z", "m9", "i9"), ("w", "m5", "i5")], schema)
    before = spark.createDataFrame([("a", "m1", "i1"), ("b", "m2", "i2"), ("c", "m3b", "i3"), ("d", "m5b", "i5")], schema)
    contents = "instrument_id string, name string, principal_amount string, start_date string"
    said = identity.content(spark.createDataFrame([("y", "Notes", "690000000.00", None), ("y", None, "5", "2024-01-01"), ("w", None, "7", "N/A")], contents))
    stated = identity.content(spark.createDataFrame([("c", "Bonds", "690000000", "2023-01-01"), ("d", None, "8", "n/a")], contents))
    found = {tuple(r) for r in identity.carry_over(now, before, said, stated).collect()}
    assert found in ({("kept", "x", "a"), ("kept", "y", "c"), ("retired", "b", "x")},)
    assert {tuple(r) for r in identity.carry_over(now, before).collect()} == {("kept", "x", "a"), ("retired", "b", "x")}
    assert identity.carry_over(now, before.limit(0)).count() == 0
    redirects = spark.createDataFrame([("a", "b"), ("b", "e"), ("c", "d"), ("p", "q"), ("q", "p"), (None, "e")], "old_id string, new_id string")
    live = spark.createDataFrame([("e",), ("c",)], "instrument_id string")
    assert {tuple(r) for r in identity.resolve_redirects(redirects, live).collect()} == {("a", "e"), ("b", "e")}


def test_tags():
    plain, found = tags.parse_tagged('<body>On <date id="t-1">May 1</date> the <org id=\'o\'>A &amp; <b>B</b></org>.</body>')
    assert plain == "On May 1 the A & B." and found["o"]["text"] == "A & B" and plain[found["t-1"]["char_start"] : found["t-1"]["char_end"]] == "May 1"
    moved = tags.realign(found, plain, "On  May\n1 the A & B.")
    assert moved["t-1"]["text"] == "May\n1"
    for bad in ("<a>", "</a>", '<a id="x"/><b>', '<a id="x">1</a><a id="x">2</a>'):
        with pytest.raises(ValueError):
            tags.parse_tagged(bad)
    with pytest.raises(ValueError):
        tags.realign(found, plain, "other")


def test_verdicts():
    good = {"kept": [0], "duplicates": [{"index": 1, "covered_by": 0}], "no_details": [2]}
    assert tags.verdict_problems(good, 3) == []
    for bad in (None, {"kept": 1}, {"kept": [0, 0]}, {"kept": [0]}, {"kept": [True, 1]}, {**good, "duplicates": [{"index": 1, "covered_by": 2}]}, {"kept": [0, 1, 9]}):
        assert tags.verdict_problems(bad, 3)


def test_merged_spans():
    assert tags.merge_spans([(5, 9), (0, 4), (4, 6), (20, 21)], 10) == [(0, 9), (20, 21)] and tags.merge_spans([(0, 8), (4, 12)], 10) == [(0, 8), (4, 12)]
