import json
import random

import pytest
from pyspark.ml.feature import IDFModel
from pyspark.sql import functions as F

from ledgerline.functions import dates, text
from ledgerline.operators import classify, clustering, graph, matching, publish, rollup, segmenting


def one(spark, column, **values):
    row = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items()))
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("name", "expected"),
    [("$500 million 5.25 per cent. Notes due 2030", "5 25% note due 2030"), ("4.000% Senior Notes", "4% senior note"), ("US 2027 Notes", "us 2027 note"), ("", None), (None, None)],
)
def test_fingerprint(spark, name, expected):
    assert one(spark, text.name_fingerprint(F.col("n")), n=name) == expected


@pytest.mark.parametrize(
    ("a", "b", "expected"),
    [("senior note due 2034", "the senior note due 2034", True), ("tranche a loan", "tranche b loan", False), ("note", "senior note", False), ("5% note due 2030", "6% senior note due 2030", False), ("note due 2030", "senior note due 2030", True), (None, "x", False)],
)
def test_compatible_names(spark, a, b, expected):
    assert one(spark, text.names_compatible(F.col("a").cast("string"), F.col("b")), a=a, b=b) is expected


@pytest.mark.parametrize(
    ("written", "expected"),
    [("7/28/2026", "2026-07-28"), ("July 28 2026", "2026-07-28"), ("28 July 2026", "2026-07-28"), ("2026-7-8", "2026-07-08"), ("7/28/26", None), ("13/28/2026", None), ("2/30/2026", None), (None, None)],
)
def test_dates(spark, written, expected):
    assert one(spark, dates.iso_date(F.col("t").cast("string")), t=written) == expected


@pytest.mark.parametrize(
    ("name", "expected"),
    [("3.875% senior notes due 2028", "2028-12-31"), ("due October 1, 2028", "2028-10-01"), ("notes due in 2030", "2030-12-31"), ("due 2028 and 2030", None), ("due 2028, and obligations remain", "2028-12-31"), ("no end", None)],
)
def test_maturity(spark, name, expected):
    assert one(spark, dates.maturity_from_name(F.col("t")), t=name) == expected


def test_coercion(spark):
    assert [one(spark, text.coerce_text(F.col("t").cast("string")), t=t) for t in (" NaN ", "N/A", " x ", "", None)] == [None, None, "x", None, None]
    assert [one(spark, text.normalize_cik(F.col("t").cast("string")), t=t) for t in ("320193", "0000320193", "12345678901", "x1 ", None)] == ["0000320193", "0000320193", "12345678901", "x1", None]
    assert one(spark, text.shard(F.col("t")), t="000114036126006577").isdigit()


def test_components(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "y"), ("z", "z"), (None, "q"), ("c", "a"), *((f"k{i:03}", f"k{i + 1:03}") for i in range(50))], "a string, b string")
    found = {r.node: r.component for r in graph.connected_components(edges, "a", "b").collect()}
    assert found["c"] == "a" and found["y"] == "x" and found["z"] == "z" and found["k050"] == "k000" and "q" not in found
    assert graph.connected_components(edges.limit(0), "a", "b").count() == 0


def test_islands_and_digests(spark):
    rows = spark.createDataFrame([("u", 1, 5), ("u", 4, 6), ("u", 9, 10), ("u", 9, 10), ("v", 1, 1)], "k string, s int, e int")
    assert {(r.k, r.s, r.e, r.members) for r in rollup.islands(rows, "k", "s", "e").collect()} == {("u", 1, 6, 2), ("u", 9, 10, 2), ("v", 1, 1, 1)}
    a, b = rollup.set_digest(rows, "k", "s", "e"), rollup.set_digest(rows.repartition(3).orderBy(F.desc("s")), "k", "s", "e")
    assert rollup.changed_keys(a, b, "k").count() == 0
    assert {tuple(r) for r in rollup.changed_keys(a, rollup.set_digest(rows.where("k = 'u' and s > 1"), "k", "s", "e"), "k").collect()} == {("u", "changed"), ("v", "added")}


MENTION = (
    "debt_instrument_mention_id string, item_id string, accession_number string, cik string, date string, name string, principal_amount decimal(38,2), start_date string, maturity_date string, "
    "maturity_date_json string, interest_rate_kind string, interest_rate_pct decimal(9,4), amendment_of string, split_of string, retired_by_json string, parties_json string, synthesized_by string, status string"
)


def mention(i, item, name, amount=None, start=None, cik="1", date="2024-01-01", up=None):
    from decimal import Decimal

    return (f"m{i}", item, f"acc{i}", cik, date, name, Decimal(amount) if amount else None, start, None, None, None, None, up, None, "[]", "[]", None, "announced")


def clusters(df):
    edges = matching.cluster(df).where("edge_type = 'member'").collect()
    by = {}
    for e in edges:
        by.setdefault(e.instrument_id, set()).add(e.mention_id)
    return {frozenset(v) for v in by.values()}, {e.mention_id: e.instrument_id for e in edges}


def test_clustering(spark):
    rows = [
        mention(1, "i1", "5% Senior Notes due 2030", "100", "2020-01-01"), mention(2, "i2", "5.00 per cent. senior notes due 2030", date="2024-02-01"), mention(3, "i3", "6% Senior Notes due 2030", date="2024-03-01"),
        mention(4, "i4", None, "100", "2020-01-01", date="2024-04-01"), mention(5, "i5", "5% Senior Notes due 2030", cik="2"), mention(6, "i6", None, cik=None), mention(7, "i1", "7% Notes due 2031", "100", "2020-01-01", date="2024-05-01"),
        mention(8, "i8", "5% Senior Notes due 2030", date="2024-06-01", up="m1"),
    ]
    df = spark.createDataFrame([*rows, rows[0]], MENTION)
    found, ids = clusters(df)
    assert frozenset({"m1", "m2"}) in found and frozenset({"m3"}) in found and frozenset({"m5"}) in found
    assert ids["m8"] != ids["m1"] and "m6" not in ids
    again, same = clusters(df.repartition(3).orderBy(F.desc("date")))
    assert again == found and same == ids


def test_synthesized_states_borrow_lenders(spark):
    """A prior state that names no lender is matched by those of the mention it was made from."""
    from decimal import Decimal

    party = lambda *spans, role="lender": json.dumps([{"role": role, "kind": "named", "canonical_name": spans[0], "spans": [{"text": s} for s in spans]}])
    columns = MENTION + ", synthesized_from_mention_id string"
    row = lambda i, date, parties, kind=None, source=None, name=None: (f"m{i}", f"i{i}", f"acc{i}", "1", date, name, Decimal(100), "2020-01-01", None, None, None, None, None, None, "[]", parties, kind, "announced", source)
    rows = [row(1, "2024-01-01", party("First Oak Bank, N.A.")), row(2, "2024-02-01", party("First Oak Bank", "Lender"), name="Term Loan"), row(3, "2024-03-01", "[]", "prior_amount", "m2"), row(4, "2024-04-01", party("the other lenders"), name="Bridge Loan")]
    df = spark.createDataFrame(rows, columns)
    prepared = {r.mention_id: r for r in matching.borrowed_lenders(matching.prepare(df)).collect()}
    assert {i: (r.lenders, r.borrowed) for i, r in prepared.items()} == {"m1": ("first oak bank", None), "m2": ("first oak bank", None), "m3": ("", "first oak bank"), "m4": ("", None)}
    found, _ = clusters(df)
    assert found == {frozenset({"m1", "m2", "m3"}), frozenset({"m4"})}


@pytest.mark.parametrize(("kind", "same"), [("fixed", False), (None, False), ("other", False), ("floating", True)])
def test_any_rate_that_does_not_float_is_a_coupon(spark, kind, same):
    from decimal import Decimal

    row = lambda i, rate: (f"m{i}", f"i{i}", f"acc{i}", "1", "2024-01-01", "Notes due 2030", None, None, None, None, kind, Decimal(rate), None, None, "[]", "[]", None, "announced")
    found, _ = clusters(spark.createDataFrame([row(1, "5.5"), row(2, "6.5")], MENTION))
    assert (frozenset({"m1", "m2"}) in found) is same


def test_a_name_only_tie_goes_to_the_living():
    base = {"item_id": "i", "accession_number": "a", "date": "2024", "amount": None, "start": None, "end": None, "lenders": "", "coupons": [], "amendment_of": None, "split_of": None, "retired_by": [], "synthesized_by": None, "identifies": True, "class_size": 1}
    rows = [{**base, "mention_id": f"m{i}", "item_id": f"i{i}", "date": f"202{i}", "fingerprint": "5% note", "terminal": i == 1, "amendment_of": {2: "m1"}.get(i)} for i in (1, 2, 3)]
    edges = clustering.cluster_block(rows, lambda name: {name})
    assert [e[:3] for e in edges if e[0] == "m3"] == [("m3", "m2", "member"), ("m3", "m1", "ambiguous_candidate")]


def test_blocks_do_not_change_the_result(spark):
    """Clustering an issuer whole gives what clustering its blocks gives."""
    rows = [mention(i, f"i{i % 40}", f"{i % 5}% Notes due 20{30 + i % 3}" if i % 4 else None, str(100 + i % 6) if i % 3 else None, f"2020-01-0{1 + i % 4}" if i % 2 else None, date=f"2024-01-{1 + i % 28:02}") for i in range(120)]
    df = spark.createDataFrame(rows, MENTION)
    found, _ = clusters(df)
    prepared = matching.prepare(df)
    pairs = matching.compatible_names(prepared)
    near = {}
    for r in pairs.collect():
        near.setdefault(r.a, set()).add(r.b)
    size = {r.fingerprint: r.class_size for r in matching.class_sizes(prepared, pairs).collect()}
    records = [{**r.asDict(), "class_size": size[r.fingerprint]} for r in prepared.collect()]
    whole = {}
    for m, c, kind, *_ in clustering.cluster_block(records, lambda a: near.get(a, set()) | {a}):
        if kind == "member":
            whole.setdefault(c, set()).add(m)
    assert {frozenset(v) for v in whole.values()} == found


def test_lineage_follows_all_pointers_and_breaks_cycles(spark):
    # a, b and c amend one another in a ring, d amends c from below it; e is split of a, f retired by e and g
    ups = {"a": "b", "b": "c", "c": "a", "d": "c", "e": None, "f": None, "g": None, "h": None}
    days = {"a": "2024-01-01", "b": "2024-03-01", "c": "2024-02-01"}
    retired = {"f": '["mg", "me", "gone", null]'}
    rows = [(f"m{i}", "i", "acc", days.get(i, "2024-01-05"), up and f"m{up}", "ma" if i == "e" else None, retired.get(i, "[]"), None) for i, up in ups.items()]
    names = "debt_instrument_mention_id string, item_id string, accession_number string, date string, amendment_of string, split_of string, retired_by_json string, synthesized_by string"
    mentions = spark.createDataFrame([*rows, rows[0]], names)
    edges = spark.createDataFrame([(f"m{i}", i, "member") for i in ups], "mention_id string, instrument_id string, edge_type string")
    links = matching.break_cycles(matching.parent_links(mentions, edges, "amendment_of"), matching.first_seen(mentions, edges))
    assert {tuple(r) for r in links.collect()} == {("b", "c"), ("c", "a"), ("d", "c")}
    found = matching.lifecycle(links, edges.select("instrument_id"), matching.parent_links(mentions, edges, "split_of"), matching.retirer_links(mentions, edges)).collect()
    assert {r.instrument_id: (r.family_id, r.superseded_by, r.is_head, r.amendment_of, r.split_of, r.retired_by) for r in found} == {
        "a": ("a", "c", False, None, None, None), "b": ("a", None, True, "c", None, None), "c": ("a", None, False, "a", None, None), "d": ("a", None, True, "c", None, None),
        "e": ("a", None, True, None, "a", None), "f": ("a", None, True, None, None, '["e","g"]'), "g": ("a", None, True, None, None, None), "h": ("h", None, True, None, None, None),
    }
    assert len(found) == 8


@pytest.mark.parametrize("most", [1, 4, 17])
def test_windows_tile_the_text(most):
    body = "a. b. c.\n\nlong words here, and more of them; " * 7 + "unbroken" * 9
    found = segmenting.windows(body, most)
    assert all(n <= most or e - s == 1 for s, e, n in found)
    covered = {i for s, e, _ in found for i in range(s, e)}
    assert all(i in covered for i, c in enumerate(body) if not c.isspace()) and sum(e - s for s, e, _ in found) == len(covered)
    assert segmenting.windows("  \n ") == []


def test_publish(spark, tmp_path):
    root = str(tmp_path / "out")
    df = spark.createDataFrame([(1, " nan "), (2, "x")], "id long, t string")
    kept = publish.conform(df.withColumn("extra", F.lit(1)), {"id": "bigint", "t": "string", "new": "double"})
    assert [tuple(r) for r in kept.orderBy("id").collect()] == [(1, None, None), (2, "x", None)]
    assert publish.publish(spark, root, {"t": kept}, "d1") == "gen-1"
    assert publish.publish(spark, root, {"t": kept}, "d1") is None
    with pytest.raises(publish.ShrinkError):
        publish.publish(spark, root, {"t": kept.limit(0)}, "d2")
    assert publish.publish(spark, root, {"t": kept}, "d3") and publish.publish(spark, root, {"t": kept}, "d4")
    assert publish.tree_digest(spark, [root]) != publish.tree_digest(spark, [root], "other")


def test_classifier(spark, monkeypatch):
    monkeypatch.setattr(classify, "FEATURES", 1 << 10)
    rows = [(str(i), ("loan notes indenture " if i % 3 else "dividend meeting vote ") * 3 + f"w{i}", bool(i % 3)) for i in range(300)] + [("n", None, None)]
    df = spark.createDataFrame(rows, "id string, body string, good boolean")
    scored = classify.fit(df, "id", "body", "good", recall=0.95).score(df, "body").collect()
    right = sum((r.verdict == "relevant") == r.good for r in scored if r.good is not None)
    assert len(scored) == 301 and right / 300 > 0.95


def test_classifier_statistics_cover_all_rows(spark, monkeypatch):
    """A bounded sample fits the linear model only: document counts and the threshold come from every row."""
    monkeypatch.setattr(classify, "FEATURES", 1 << 10)
    rng = random.Random(3)
    body = lambda good: " ".join(rng.choice(("loan", "notes") if rng.random() < (0.6 if good else 0.4) else ("vote", "meeting")) for _ in range(12))
    rows = [(str(i), body(i % 2), bool(i % 2)) for i in range(3000)] + [("n", "loan", None), ("n2", None, None)]
    df = spark.createDataFrame(rows, "id string, body string, good boolean")
    found = classify.fit(df, "id", "body", "good", recall=0.95, fit_rows=90)
    assert [s.numDocs for s in found.model.stages if isinstance(s, IDFModel)] == [3002]
    part = F.pmod(F.xxhash64("id"), F.lit(1_000_000))
    outside = found.score(df, "body").where("good is not null").where(~((part < 30_000) & (part % 3 != 0)))
    assert found.threshold == classify.threshold_for_recall(outside, "classification_score", "good", 0.95)
    assert outside.where("good").agg(F.avg((F.col("verdict") == "relevant").cast("int"))).first()[0] >= 0.95


def test_threshold_keeps_the_recall(spark):
    scores = spark.createDataFrame([(0.1234566, True), (0.5, True), (0.05, False)], "s double, y boolean")
    assert scores.where(F.col("s") >= classify.threshold_for_recall(scores, "s", "y", 1.0)).count() == 2


def test_running_sums_and_areas_over_ranges(spark):
    rng = random.Random(7)
    rows = [(i, round(rng.random(), 2) if i % 3 else 0.5, bool(rng.random() < 0.4)) for i in range(500)] + [(501, None, True), (502, 0.3, None)]
    df = spark.createDataFrame(rows, "id int, s double, y boolean")
    known = [(s, y) for _, s, y in rows if s is not None and y is not None]
    total, area, last = sum(y for _, y in known), 0.0, (0.0, 1.0)
    expected = {}
    for score in sorted({s for s, _ in known}, reverse=True):
        kept = [y for s, y in known if s >= score]
        point = (sum(kept) / total, sum(kept) / len(kept))
        expected[score] = point
        area += (point[0] - last[0]) * (point[1] + last[1]) / 2
        last = point
    found = {r.threshold: (r.recall, r.precision) for r in classify.recall_curve(df, "s", "y").collect()}
    assert found.keys() == expected.keys() and all(found[k] == pytest.approx(expected[k]) for k in expected)
    assert classify.average_area(df, "s", "y") == pytest.approx(area)
    assert classify.average_area(df.limit(0), "s", "y") is None


def test_first_and_last_rows_of_keys(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", None, "z"), (None, 2, "n"), (None, 1, "m")], "k string, o int, v string")
    assert {(r.k, r.v) for r in rollup.keep_last(df, ["k"], F.col("o")).collect()} == {("a", "y"), (None, "n")}
    assert {(r.k, r.v) for r in rollup.keep_first(df, ["k"], F.col("o")).collect()} == {("a", "z"), (None, "m")}
