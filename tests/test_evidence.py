from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import evidence as ev

TEXT = {
    "magnitude": (
        ev.magnitude,
        [("$5 million", 6), ("US$2 bn", 9), ("$250M", 6), ("£250m", 6), ("250m", None), ("$250MMBtu", None), ("$500K", 3), ("12 mils", 6), ("$5", None), ("smillion 5", None), ("", None), (None, None)],
    ),
    "amount": (
        ev.amount,
        [
            ("$5 million", "5000000"), ("20.877.777", "20877777"), ("1.234.567,89", "1234567.89"), ("1,234,567.89", "1234567.89"), ("30.000", "30"), ("$1,000", "1000"), ("US$2.5 bn", "2500000000"), ("$250M", "250000000"),
            ("none", None), ("", None), (None, None), ("$400.0", "400"),
        ],
    ),
    "amount_in_name": (ev.amount_in_name, [("$183.36 million term loan", "183360000"), ("5% Notes due 2030", None), ("$5 million and $6 million notes", None), ("$5 million, $5 million", "5000000"), ("C$300 million notes due 2033", "300000000")]),
    "currency_in_name": (ev.currency_in_name, [("C$300 million notes", "CAD"), ("$5 and $6", None), ("€5 million loan", "EUR"), ("notes", None)]),
    "is_rate_like": (
        ev.is_rate_like,
        [("5.25%", True), ("150 basis points", True), ("1.5 percent and 2%", True), ("500,000,000 (100% of principal)", False), ("$5%", False), ("5 million %", False), ("none", False), (None, False)],
    ),
    "month_year": (ev.month_year, [("matures in June 2016", "2016-06-30"), ("March 2056 or April 2056", None), ("February 2024", "2024-02-29"), ("Smarch 2020", None), (None, None)]),
    "maturity": (
        ev.maturity,
        [
            ("notes due 2028", "2028-12-31"), ("due June 1, 2027", "2027-06-01"), ("due on June 1 2027", "2027-06-01"), ("due April 2033", "2033-04-30"), ("due 2028 and 2030", None), ("due June 1, 2027 and 2028", None),
            ("due 2028, due 2028", "2028-12-31"), ("due April 2033 and May 2033", "2033-04-30"), ("due April 2033 and May 2034", None), ("no maturity", None), ("due June 31, 2027", None), (None, None), ("due in 2031", "2031-12-31"),
        ],
    ),
}


@pytest.mark.parametrize("name", TEXT)
def test_readings_of_text(spark, name):
    function, cases = TEXT[name]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, t string")
    found = {r.i: r.v for r in df.select("i", function(F.col("t")).alias("v")).collect()}
    for i, (text, expected) in enumerate(cases):
        value = found[i]
        assert (value == Decimal(expected)) if isinstance(value, Decimal) else value == expected, text


def test_lists_read_from_text(spark):
    df = spark.createDataFrame([("US$5 and HK$6 or 7 EUR, XYZ 1",), ("£5 and ¥6",), ("5 u.s. dollars and 3 euro",), ("none",)], "t string")
    assert [sorted(r.c) for r in df.select(ev.currencies(F.col("t")).alias("c")).collect()] == [["EUR", "HKD", "USD"], ["GBP", "JPY"], ["EUR", "USD"], []]
    rates = spark.createDataFrame([("6 1/2% and 5.25 percent",), ("4.125",), ("1 1/0%",), ("no",)], "t string").select(ev.rates(F.col("t")).alias("a"), ev.rates_in_rate_text(F.col("t")).alias("b")).collect()
    assert [[float(x) for x in r.a] for r in rates] == [[6.5, 5.25], [], [], []] and [float(x) for x in rates[1].b] == [4.125]
    tenors = spark.createDataFrame([("five-year loan",), ("18 months",), ("one year and 2 years",), ("2-year, two-year",), ("soon",)], "t string").select(ev.tenor(F.col("t")).alias("t")).collect()
    assert [r.t and (r.t["count"], r.t.unit) for r in tenors] == [(5, "year"), (18, "month"), None, (2, "year"), None]


def test_amounts_are_confirmed_or_left_null(spark):
    rows = [
        ("500000.00", "USD", ["$500,000", "Principal Amount"], None), ("500001", "USD", ["$500,000"], None), ("500000", "EUR", ["$500,000"], None), ("183360000", "USD", [], "$183.36 million term loan"),
        ("700", "USD", ["$300", "$400"], None), ("400", "USD", ["$400", "$300"], None), ("5", None, ["5%"], None), ("7", "USD", ["7"], None), (None, None, ["$1"], None), ("x", "USD", None, None),
    ]
    df = spark.createDataFrame(rows, "amount string, currency string, spans array<string>, name string")
    found = [tuple(r.verified) for r in ev.verify_amounts(df.withColumn("own", F.array(F.lit("USD"))), "amount", "currency", "spans", "name", "own").collect()]
    assert found == [
        ("500000", "USD", "stated"), (None, "USD", None), ("500000", None, "stated"), ("183360000", "USD", "name"), ("700", "USD", "computed"), ("400", "USD", "stated"), (None, None, None), ("7", "USD", "stated"), (None, None, None), (None, "USD", None),
    ]


def test_magnitudes_of_siblings(spark):
    rows = [("400000000", ["$400.0"], ["$500.0 million"]), ("400000000", ["$400.0 million"], ["$500.0 million"]), ("400000000", ["$400.0"], ["$5 million", "$5 billion"]), ("400", ["$400"], ["5%"]), ("4", ["$400"], ["$5 million"])]
    df = spark.createDataFrame(rows, "amount string, own array<string>, other array<string>")
    assert [r.scaled and int(r.scaled) for r in ev.scale_by_siblings(df, "amount", "own", "other").collect()] == [400000000, None, None, None, None]


def test_rates_and_dates_are_confirmed(spark):
    rates = spark.createDataFrame([("6.5", ["6 1/2%"], None), ("6.50", ["6.5"], None), ("5", [], "5% Notes"), ("5", ["6%"], "5% Notes"), ("x", ["6%"], None)], "r string, t array<string>, n string")
    assert [tuple(r.verified) for r in ev.verify_rates(rates, "r", "t", "n").collect()] == [("6.5", "stated"), ("6.5", "stated"), ("5", "name"), (None, None), (None, None)]
    dates = spark.createDataFrame([("2026-7-28", ["July 28, 2026"]), ("2026-07-28", ["July 28, 2026", "July 29, 2026"]), ("2026-07-27", ["July 28, 2026"]), (None, ["July 28, 2026"])], "d string, t array<string>")
    assert [r.v for r in dates.select(ev.verified_date(F.col("d"), F.col("t")).alias("v")).collect()] == ["2026-07-28", None, None, None]
    ends = [
        ("2030-06-30", ["in June 2030"], None, [], []), ("2030-12-31", ["notes due 2030"], None, [], []), ("2029-01-31", ["five-year"], None, ["January 31, 2024"], ["five-year"]), ("2020-02-29", [], None, ["February 29, 2024"], ["4 years"]),
        ("2030-01-01", ["March 1, 2031"], "Notes due 2031", [], []), (None, [], None, [], []),
    ]
    df = spark.createDataFrame(ends, "d string, t array<string>, n string, starts array<string>, tenors array<string>")
    found = [tuple(r.verified) for r in ev.verify_end_dates(df, "d", "t", "n", "starts", "tenors").collect()]
    assert found == [("2030-06-30", "stated"), ("2030-12-31", "name"), ("2029-01-31", "computed"), ("2020-02-29", "computed"), ("2031-12-31", "name"), (None, None)]
    precise = spark.createDataFrame([("2030-06-01", ["June 1, 2030"], "stated"), ("2030-06-30", ["June 2030"], "stated"), ("2030-12-31", ["due 2030"], "name"), ("2030-05-05", [], "computed"), (None, [], None)], "d string, t array<string>, h string")
    assert [r.p for r in precise.select(ev.date_precision(F.col("d"), F.col("t"), F.col("h")).alias("p")).collect()] == ["day", "month", "year", "day", None]


def test_statuses_follow_from_dated_facts(spark):
    fact = lambda kind, day=None, prior=False, expected=False: (kind, day, prior, expected)
    rows = [
        [fact("closing", "2024-01-01"), fact("amendment", "2024-02-01")], [fact("closing", "2024-02-01"), fact("default")], [fact("termination", "2024-01-01"), fact("retirement", "2024-01-01")], [fact("closing", "2025-01-01")],
        [fact("agreement", "2024-01-01"), fact("repayment", "2024-01-01")], [fact("amendment", "2024-01-01", prior=True)], [], None,
    ]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, f {ev.DATED}")
    marked = df.withColumn("f", ev.mark_expected(F.col("f"), F.lit("2024-12-31")))
    found = {r.i: tuple(r.s) for r in marked.select("i", ev.derived_status(F.col("f")).alias("s")).collect()}
    assert found == {
        0: ("amended", "2024-02-01", "amendment"), 1: ("defaulted", None, "default"), 2: ("terminated", "2024-01-01", "termination"), 3: ("announced", None, "closing:expected"), 4: ("entered_into", "2024-01-01", "agreement"),
        5: (None, None, None), 6: (None, None, None), 7: (None, None, None),
    }
    assert [r.d for r in df.where("i < 2").select(ev.current_date(F.col("f"), "closing").alias("d")).collect()] == ["2024-01-01", "2024-02-01"]
    planned = spark.createDataFrame([([fact("retirement", expected=True)],), ([fact("retirement")],), (None,)], f"f {ev.DATED}")
    assert [r.p for r in planned.select(ev.retirement_expected(F.col("f")).alias("p")).collect()] == [True, False, False]
