import hashlib
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.streaming import registry


def test_done_rows_open_again_when_they_change(spark):
    rows = [("a", 0, 1, "x"), ("a", 1, 2, "y"), ("b", 0, 1, "x"), (None, 0, 1, "n")]
    digest = lambda data: {r.acc: r.digest for r in registry.window_digest(spark.createDataFrame(data, "acc string, win int, s int, t string"), ["acc"], "win", "s").collect()}
    first = digest(rows)
    assert digest(list(reversed(rows)) + rows[:1]) == first and all(len(d) == 16 for d in first.values()) and len(first) == 3
    assert digest([("a", 0, 1, "x"), ("a", 1, 3, "y")])["a"] != first["a"]
    windows = spark.createDataFrame([("a", "d1"), ("b", "d2")], "acc string, digest string")
    assert [r.acc for r in registry.not_done(windows, spark.createDataFrame([("a", "d1"), ("b", "old")], "acc string, digest string"), ["acc", "digest"]).collect()] == ["b"]


def test_failures_count_up_and_clear_themselves(spark):
    known = spark.createDataFrame([("k1", "lost", 2, 1.0), ("k2", "lost", 1, 1.0), ("k3", "late", 5, 1.0)], registry.FAILURES)
    failed = spark.createDataFrame([("k1", "bad"), ("k4", "bad"), ("k4", "worse")], "key string, kind string")
    processed = spark.createDataFrame([("k1",), ("k2",), ("k4",)], "key string")
    found = {(r.key, r.kind, r.attempts, r["at"]) for r in registry.updated_failures(known, failed, processed, 9.0).collect()}
    assert found == {("k1", "bad", 3, 9.0), ("k3", "late", 5, 1.0), ("k4", "worse", 1, 9.0)}
    source = spark.createDataFrame([("k1", 1), ("k2", 2)], "acc string, v int")
    output = spark.createDataFrame([("k1", -1), ("k2", 20)], "acc string, w int")
    again = registry.retried(source, output, known.where("key = 'k1'"), lambda df: df.select("acc", (F.col("v") * 10).alias("w")), "acc")
    assert {tuple(r) for r in again.collect()} == {("k1", 10), ("k2", 20)}


def test_unfinished_sources_keep_their_rows(spark):
    new, old = (spark.createDataFrame(rows, "src string, v int") for rows in ([("a", 1), ("b", 2)], [("a", 0), ("c", 0)]))
    complete = spark.createDataFrame([("a", False), ("b", True)], "src string, complete boolean")
    assert {tuple(r) for r in registry.held(new, old, complete, "src").collect()} == {("a", 0), ("b", 2)}


def test_a_replay_rewrites_changed_items_only(spark):
    stored = spark.createDataFrame([("i1", "m1", 1), ("i1", "m2", 1), ("i2", "m3", 1), ("i3", "m4", 1)], "item string, id string, run int")
    derived = spark.createDataFrame([("i1", "m2", 2), ("i1", "m1", 2), ("i2", "m5", 2), ("i4", "m6", 2)], "item string, id string, run int")
    assert {tuple(r) for r in registry.changed_items(stored, derived, "item", "id").collect()} == {("i2", "changed"), ("i3", "removed"), ("i4", "added")}
    assert {tuple(r) for r in registry.rewritten(stored, derived, "item", "id").collect()} == {("i1", "m1", 1), ("i1", "m2", 1), ("i2", "m5", 2), ("i4", "m6", 2)}
    assert [r.run for r in registry.newest_records(stored.unionByName(derived).where("item = 'i1'"), "item", "run", "id").collect()] == [2]


def test_mention_ids_are_hashes_of_content(spark):
    row = {"item_id": "i", "name": "5% Notes é", "principal_amount": "5.00", "amounts_json": '[{"b": 1, "a": 2.0}]', "parties_json": "junk", "start_date": None}
    df = spark.createDataFrame([(row["item_id"], row["name"], Decimal("5.00"), row["amounts_json"], row["parties_json"], None, "x")], "item_id string, name string, principal_amount decimal(38,2), amounts_json string, parties_json string, start_date string, extra string")
    content = {c: (registry.canonical_json(row.get(c)) if c.endswith("_json") else row.get(c)) for c in registry.MENTION_ID_COLUMNS}
    assert content["amounts_json"] == '[{"a":2.0,"b":1}]' and content["parties_json"] == "junk" and content["name_json"] == "None"
    expected = "dim::" + hashlib.sha256(json.dumps(content, sort_keys=True, separators=(",", ":")).encode()).hexdigest()[:24]
    assert df.select(registry.mention_id(df).alias("i")).first().i == expected


def test_one_writer_holds_the_lease(spark, tmp_path):
    now = [1000.0]
    lease = lambda owner: registry.Lease(spark, f"file://{tmp_path}/lease.json", owner, 100, lambda: now[0])
    one, two = lease("one"), lease("two")
    assert one.take() and not two.take() and one.take()
    now[0] += 101
    assert two.take() and not one.take()
    now[0] += registry.RENEW
    with pytest.raises(RuntimeError):
        one.renew()
    two.renew()
    two.give_back()
    assert one.take()
