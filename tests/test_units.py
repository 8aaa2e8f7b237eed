import json
from decimal import Decimal

import pytest

from ledgerline.functions import money
from ledgerline.operators import units


@pytest.mark.parametrize(
    ("written", "expected"),
    [
        ("US$45 million", ("45", 6, "USD")),
        ("$10,000", ("10000", None, "USD")),
        ("45,000", ("45000", None, None)),
        ("INR 4 crores", ("4", 7, "INR")),
        ("₹2.5 lakhs", ("2.5", 5, "INR")),
        ("CHF 5'000'000", ("5000000", None, "CHF")),
        ("316.640.000,00 EUR", ("316640000", None, "EUR")),
        ("4.515.000.000,00 Swedish kronor", ("4515000000", None, "SEK")),
        ("U.S. $30,000 (in thousands)", ("30000", 3, "USD")),
        ("Mex$12 (000s)", ("12", 3, "MXN")),
        ("four hundred fifty-four million U.S. dollars", ("454", 6, "USD")),
        ("37.5 million Hong Kong dollars", ("37.5", 6, "HKD")),
        ("¥3B", ("3", 9, "JPY")),
        ("nothing here", (None, None, None)),
        ("", (None, None, None)),
    ],
)
def test_amounts_as_written(written, expected):
    assert money.stated(written) == expected


def test_headers_survive_slips():
    assert [h[1:] for h in money.headers("(Amounts in thousands of Canadian dollars) x Stated in millions Swiss francs")] == [(3, "CAD"), (6, "CHF")]
    assert money.headers(None) == [] and money.headers("millions of people") == []


def fact(tag, span, amount, currency, kind="principal", prior=False):
    return {"kind": kind, "normalized_amount": amount, "currency": currency, "prior": prior, "spans": [{"tag_id": tag, "char_start": 60, "text": span}]}


SCHEMA = "debt_instrument_mention_id string, item_id string, date string, name string, principal_amount decimal(38,2), principal_currency string, amounts_json string, slot string"


@pytest.fixture
def tables(spark):
    rows = [
        ("a", "i", "2024-01-02", None, Decimal("45000000.00"), "USD", json.dumps([fact("t1", "$45 million", "45000000", "USD")]), "clash"),
        ("b", "i", "2024-01-02", None, Decimal("45.00"), "USD", json.dumps([fact("t1", "$45 million", "45000", "USD"), fact("t2", "$4", "4", None, "draw")]), "clash"),
        ("b", "i", "2024-01-02", None, Decimal("45.00"), "USD", json.dumps([fact("t1", "$45 million", "45000", "USD"), fact("t2", "$4", "4", None, "draw")]), "clash"),
        ("c", "i", "2024-01-02", None, None, None, json.dumps([fact("t1", "450", "450", "INR")]), "clash"),
        ("d", "i", "2024-01-02", "£45 million 2018 Term Loan", Decimal("45.00"), "GBP", "[]", "clash"),
        ("e", None, None, None, None, None, None, None),
        ("f", "i", "2024-01-02", None, None, None, json.dumps([fact("t1", "no amount", "1", "USD")]), "clash"),
    ]
    items = spark.createDataFrame([("i", "x " * 5 + "Stated in thousands of Indian rupees unless noted."), ("i", "x " * 5 + "Stated in thousands of Indian rupees unless noted."), (None, None)], "item_id string, text string")
    return spark.createDataFrame(rows, SCHEMA), items


def test_misrecorded_amounts(tables):
    found = {tuple(r) for r in units.misrecorded(units.recorded_amounts(*tables)).select("debt_instrument_mention_id", "slot").collect()}
    assert found == {("b", "t1"), ("b", "t2"), ("b", "principal_amount"), ("c", "t1"), ("d", "principal_amount")}


def test_known_conversions_and_dollars(spark, tables):
    rates = spark.createDataFrame([("USD", "2024-01", 1.0), ("INR", "2024-01", 0.01)], "currency string, rate_month string, usd_per_unit double")
    rows = {(r.debt_instrument_mention_id, r.slot): r for r in units.in_dollars(units.recorded_amounts(*tables), rates).collect()}
    assert rows["b", "t1"].power == -3 and rows["b", "principal_amount"].power == -6
    assert rows["c", "t1"].amount == 450000 and rows["c", "t1"].usd_amount == 4500.0
    assert rows["d", "principal_amount"].currency == "GBP" and rows["d", "principal_amount"].usd_amount is None


def test_empty_tables(spark, tables):
    mentions, items = tables
    assert units.recorded_amounts(mentions.limit(0), items.limit(0)).count() == 0


def test_scales_propagate_through_the_graph(spark):
    rows = [(f"e{i}", s, float(i + 1) * f) for i in range(30) for s, f in (("text", 1.0), ("fact", 1e-3), ("flat", 1e-6)) if not (s == "flat" and i % 2)]
    rows += [("odd", "text", 5.0), ("odd", "fact", 7.0), ("null", "text", None)]
    observed = spark.createDataFrame(rows, "entity string, source string, value double")
    scales = units.pairwise_scales(observed, "entity", "source", "value")
    assert {(r.source, r.power) for r in units.propagate_scales(scales, "text").collect()} == {("text", 0), ("fact", -3), ("flat", -6)}


def test_offsets_are_found_beside_scales(spark):
    """A source that records value / 1000 + 32: the ratio is no conversion, the slope is."""
    rows = [(f"e{i}", s, v) for i in range(200) for s, v in (("a", float(i + 1) ** 2), ("b", float(i + 1) ** 2 / 1000 + 32))]
    (pair,) = units.pairwise_scales(spark.createDataFrame(rows, "entity string, source string, value double"), "entity", "source", "value").collect()
    assert pair.power == -3 and abs(pair.offset - 32) < 1e-6 and pair.entities == 200


def test_long_chains_of_sources_are_followed_to_the_end(spark):
    links = spark.createDataFrame([(f"s{i:02}", f"s{i + 1:02}", 3 if i % 2 else -3, 5) for i in range(20)], "source_a string, source_b string, power int, entities long")
    found = {r.source: r.power for r in units.propagate_scales(links, "s00").collect()}
    assert len(found) == 21 and found["s20"] == 0 and found["s19"] == -3


def test_many_records_teach_the_unit_of_a_notation(spark):
    """A notation whose records all say otherwise than is customary is read as the records say."""
    rows = [(f"m{i}", "i", "2024-01-02", None, None, None, json.dumps([fact("t", f"${i + 2} mm", f"{(i + 2) * 1000}", "USD")]), "c") for i in range(60)]
    none = spark.createDataFrame([], "item_id string, text string")
    read = units.recorded_amounts(spark.createDataFrame(rows, SCHEMA), none)
    assert {r.stated_amount for r in read.collect()} == {Decimal(f"{(i + 2) * 1000}.00") for i in range(60)}
    assert units.misrecorded(read).count() == 0


def test_facts_of_several_spans_are_sums(spark):
    two = {"kind": "principal", "normalized_amount": "7000000", "currency": "USD", "prior": False, "spans": [{"tag_id": "a", "char_start": 1, "text": "$3 million"}, {"tag_id": "b", "char_start": 9, "text": "$4 million"}]}
    mixed = {**two, "spans": [two["spans"][0], {"tag_id": "b", "char_start": 9, "text": "four"}], "kind": "draw"}
    df = spark.createDataFrame([("m", "i", "2024-01-02", None, None, None, json.dumps([two, mixed]), "c")], SCHEMA)
    rows = units.recorded_amounts(df, spark.createDataFrame([], "item_id string, text string")).collect()
    assert {(r.slot, r.stated_amount, r.stated_currency) for r in rows} == {(None, Decimal("7000000.00"), "USD"), (None, None, None)}
