"""Incremental stages: pending sources, replace by source, failures, and per-entity state on streams."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.publish import files, remove
from ledgerline.operators.rollup import keep_last

REGISTRY = "source string, fingerprint string, complete boolean, at double"


def fingerprints(spark: SparkSession, root: str) -> DataFrame:
    """(source, fingerprint) of every partition folder below root: what a later change of a file changes."""
    by_folder: dict[str, list[str]] = {}
    for path, length, modified in files(spark, root):
        folder, _, name = path.rpartition("/")
        if name.endswith(".parquet"):
            by_folder.setdefault(folder, []).append(f"{name}:{length}:{modified}")
    return spark.createDataFrame([(k, "|".join(sorted(v))) for k, v in by_folder.items()], "source string, fingerprint string")


def registry(spark: SparkSession, path: str) -> DataFrame:
    """The newest entry of every source; empty where nothing was recorded."""
    if not files(spark, path):
        return spark.createDataFrame([], REGISTRY)
    return keep_last(spark.read.schema(REGISTRY).parquet(path), ["source"], F.col("at"), F.col("fingerprint"))


def pending(current: DataFrame, known: DataFrame, forced: list[str] | None = None) -> DataFrame:
    """Sources that are new, changed, incomplete or forced. Late rows change their source, so nothing is dropped for being late."""
    joined = current.join(known.select("source", F.col("fingerprint").alias("_known"), "complete"), "source", "left")
    due = ~F.col("fingerprint").eqNullSafe(F.col("_known")) | ~F.coalesce("complete", F.lit(False)) | F.col("source").isin(forced or [])
    return joined.where(due).select("source", "fingerprint")


def run_stage(spark: SparkSession, source_root: str, output: str, registry_path: str, process: Callable[[DataFrame], DataFrame], partition: str, forced: list[str] | None = None, order: tuple[str, ...] = ("source",)) -> int:
    """Process the pending source folders and replace their rows in output (partitioned by `partition`, in files sorted by `order`); how many there were.

    A partition left without rows, since its sources now write elsewhere, goes. process gets the rows of the pending sources with a column `source` and must keep both. The
    registry is written last: a crash before it only makes the same sources pending again.
    """
    due = pending(fingerprints(spark, source_root), registry(spark, registry_path), forced)
    sources = due.collect()  # one entry per partition folder, not per row
    if not sources:
        return 0
    rows = spark.read.option("mergeSchema", True).option("basePath", source_root).parquet(*[r["source"] for r in sources])
    rows = rows.withColumn("source", F.regexp_replace(F.regexp_extract(F.input_file_name(), r"^(.*)/[^/]*$", 1), "^file:/+", "file:/"))
    fresh = process(rows)
    gone = []
    if files(spark, output):
        old = spark.read.parquet(output)
        touched = fresh.select(partition).unionByName(old.join(due.select("source"), "source", "left_semi").select(partition)).distinct()
        kept = old.join(touched, partition, "left_semi").join(due.select("source"), "source", "left_anti")
        fresh = kept.unionByName(fresh, allowMissingColumns=True)
    staged = f"{output}.staged"
    fresh.write.mode("overwrite").parquet(staged)
    if files(spark, output):
        # partitions whose rows all came from reprocessed sources that no longer write there
        left = spark.read.parquet(staged).select(partition).distinct()
        gone = [r[0] for r in touched.join(left, partition, "left_anti").collect()]
    spark.read.parquet(staged).repartition(F.col(partition)).sortWithinPartitions(*order).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(output)
    for value in gone:
        remove(spark, f"{output}/{partition}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}")
    now = time.time()
    due.withColumn("complete", F.lit(True)).withColumn("at", F.lit(now)).write.mode("append").parquet(registry_path)
    return len(sources)


STATE = "entity string, events long, last_kind string, rounds long, closed boolean"
_KEPT = "events long, last_kind string, rounds long"


def _advance(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """Count an entity's events, keep its newest kind, and close it after an error was seen `LIMIT` times."""
    events, last, rounds = state.get if state.exists else (0, None, 0)
    for batch in batches:
        batch = batch.sort_values(["ts", "event_id"])
        events += len(batch)
        rounds += int((batch["kind"] == "error").sum())
        last = batch["kind"].iloc[-1]
    state.update((events, last, rounds))
    yield pd.DataFrame({"entity": [key[0]], "events": [events], "last_kind": [last], "rounds": [rounds], "closed": [rounds >= LIMIT]})


#: Errors after which an entity is closed.
LIMIT = 3


def poll(spark: SparkSession, source: str, schema, checkpoint: str, sink: str) -> DataFrame:
    """Take in what is new below source, update each entity's state, and return the newest state of every entity.

    One tick of a poll: it ends when all that is there is processed, and the next call goes on from
    the checkpoint. The sink is a table of state changes.
    """
    stream = spark.readStream.schema(schema).parquet(source)
    keyed = stream.select(F.col("user_id").cast("string").alias("entity"), "event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("kind"))
    states = keyed.groupBy("entity").applyInPandasWithState(_advance, STATE, _KEPT, "update", "NoTimeout")

    def take(batch: DataFrame, number: int) -> None:
        batch.withColumn("tick", F.lit(number)).write.mode("append").parquet(sink)

    states.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(take).start().awaitTermination()
    rows = spark.read.schema(STATE + ", tick long").parquet(sink) if files(spark, sink) else spark.createDataFrame([], STATE + ", tick long")
    return keep_last(rows, ["entity"], F.col("tick"), F.col("events")).drop("tick")


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one, for a run that keeps nothing."""
    import uuid

    from ledgerline.plans.lineage import shared_dir

    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
