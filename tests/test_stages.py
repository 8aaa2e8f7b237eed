from pyspark.sql import functions as F

from ledgerline.operators import publish
from ledgerline.streaming import stages


def test_stage_replaces_by_source_and_is_idempotent(spark, tmp_path):
    source, out, registry = (str(tmp_path / n) for n in ("src", "out", "reg"))
    rows = spark.createDataFrame([("2024-01-02", 1), ("2024-01-09", 2), ("2024-02-03", 3)], "date string, v int")
    rows.coalesce(1).write.partitionBy("date").parquet(source)
    process = lambda df: df.withColumn("month", F.substring(F.col("date").cast("string"), 1, 7)).withColumn("w", F.col("v") * 10)
    run = lambda forced=None: stages.run_stage(spark, source, out, registry, process, "month", forced)
    assert run() == 3 and run() == 0
    assert {(r.w, r.month) for r in spark.read.parquet(out).collect()} == {(10, "2024-01"), (20, "2024-01"), (30, "2024-02")}
    spark.createDataFrame([("2024-01-09", 7)], "date string, v int").coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(source)
    assert run() == 1
    assert sorted(r.w for r in spark.read.parquet(out).collect()) == [10, 30, 70]


def test_a_partition_that_sources_left_goes(spark, tmp_path):
    """A source that moves to another partition leaves nothing behind in the one it leaves."""
    source, out, registry = (str(tmp_path / n) for n in ("src", "out", "reg"))
    write = lambda month, v: spark.createDataFrame([("s1", month, v)], "name string, month string, v int").coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("name").parquet(source)
    run = lambda: stages.run_stage(spark, source, out, registry, lambda df: df.select("month", "v", "source"), "month", order=("v",))
    write("2025-01", 1)
    assert run() == 1
    write("2025-02", 1)
    assert run() == 1
    assert [(r.month, r.v) for r in spark.read.parquet(out).collect()] == [("2025-02", 1)]


def test_texts_are_swapped_whole(spark, tmp_path):
    path = f"file://{tmp_path}/pointer.json"
    assert publish.read_text(spark, path) is None
    assert publish.replace_text(spark, path, "one", "") and publish.read_text(spark, path) == "one"
    assert not publish.replace_text(spark, path, "two", "") and publish.read_text(spark, path) == "one"
    assert publish.replace_text(spark, path, "two", publish.content_version("one")) and publish.read_text(spark, path) == "two"
    assert not publish.create_text(spark, path, "three") and publish.create_text(spark, path + "2", "three")
    publish.write_text(spark, path, "four")
    assert publish.read_text(spark, path) == "four" and len([f for f in publish.files(spark, f"file://{tmp_path}") if "pointer" in f[0]]) == 2


def test_poll_goes_on_from_its_checkpoint(spark, tmp_path):
    source, check, sink = (str(tmp_path / n) for n in ("events", "check", "sink"))
    schema = "event_id long, ts timestamp, user_id long, event_type string"
    batch = lambda rows: spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string").withColumn("ts", F.to_timestamp("ts")).write.mode("append").parquet(source)
    batch([(1, "2024-01-01 00:00:00", 1, "click"), (2, "2024-01-02 00:00:00", 1, "error"), (3, "2024-01-01 00:00:00", 2, "view")])
    sc = spark.read.parquet(source).schema
    first = {r.entity: (r.events, r.last_kind, r.closed) for r in stages.poll(spark, source, sc, check, sink).collect()}
    assert first == {"1": (2, "error", False), "2": (1, "view", False)} and schema
    batch([(4, "2024-01-03 00:00:00", 1, "error"), (5, "2024-01-04 00:00:00", 1, "error")])
    assert {r.entity: (r.events, r.closed) for r in stages.poll(spark, source, sc, check, sink).collect()} == {"1": (4, True), "2": (1, False)}
