"""What stages remember between runs: done rows, failures that clear themselves, replays that changed something, and a writer's lease."""

from __future__ import annotations

import json
import time
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from ledgerline.operators.publish import content_version, create_text, read_text, replace_text
from ledgerline.operators.rollup import changed_keys, keep_last, set_digest

FAILURES = "key string, kind string, attempts long, at double"
#: Seconds a lease holds, and how old it must be before it is renewed.
LEASE, RENEW = 7200, 300


# -- rows that are done ---------------------------------------------------------------------------


def window_digest(windows: DataFrame, keys: list[str], *columns: str) -> DataFrame:
    """(keys, digest): 16 digits of a hash of each filing's distinct windows, whatever their order: what a done filing is known by."""
    one = windows.withColumn("_key", F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}))
    found = set_digest(one, "_key", *columns).withColumn("digest", F.substring("digest", 1, 16))
    return one.select("_key", *keys).distinct().join(found, "_key").select(*keys, "digest")


def not_done(rows: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose keys (a digest among them, if any) aren't among the done ones; a changed filing has another digest and is open again."""
    return rows.join(done.select(*keys).distinct(), keys, "left_anti")


# -- failures -------------------------------------------------------------------------------------


def updated_failures(known: DataFrame, failed: DataFrame, processed: DataFrame, now: float) -> DataFrame:
    """The failure registry after a run: known (FAILURES) without the keys that were processed without failing, and the failed ones (key, kind) counted up.

    A key that fails several ways in one run keeps the last kind by name; keys the run didn't touch stay.
    """
    fresh = failed.groupBy("key").agg(F.max("kind").alias("kind"))
    before = known.select("key", F.col("attempts").alias("_attempts"))
    counted = fresh.join(before, "key", "left").select("key", "kind", (F.coalesce("_attempts", F.lit(0)) + 1).cast("long").alias("attempts"), F.lit(float(now)).alias("at"))
    touched = processed.select("key").unionByName(failed.select("key")).distinct()
    return known.select("key", "kind", "attempts", "at").join(touched, "key", "left_anti").unionByName(counted)


def retried(source: DataFrame, output: DataFrame, failures: DataFrame, process, key: str) -> DataFrame:
    """output with the failed keys' rows made anew: process gets the source rows of those keys alone."""
    keys = failures.select(F.col("key").alias(key)).distinct()
    again = process(source.join(keys, key, "left_semi"))
    return output.join(keys, key, "left_anti").unionByName(again, allowMissingColumns=True)


def held(rows: DataFrame, earlier: DataFrame, complete: DataFrame, source: str) -> DataFrame:
    """The output of a run in which some sources couldn't be finished: those keep their earlier rows, the others have the new ones.

    complete is (source, complete); a source without an entry counts as finished.
    """
    open_sources = complete.where("not complete").select(source).distinct()
    return rows.join(open_sources, source, "left_anti").unionByName(earlier.join(open_sources, source, "left_semi"), allowMissingColumns=True)


# -- replay ---------------------------------------------------------------------------------------


def newest_records(records: DataFrame, key: str, *order: str) -> DataFrame:
    """The newest record of every key across runs: the last in order wins."""
    return keep_last(records, [key], *(F.col(c) for c in order))


def changed_items(stored: DataFrame, derived: DataFrame, item: str, *columns: str) -> DataFrame:
    """(item, change): items whose rows, as a set, come out of a replay otherwise than they are stored."""
    return changed_keys(set_digest(derived, item, *columns), set_digest(stored, item, *columns), item)


def rewritten(stored: DataFrame, derived: DataFrame, item: str, *columns: str) -> DataFrame:
    """stored with the rows of changed items taken from derived; all other rows are untouched."""
    changed = changed_items(stored, derived, item, *columns).select(item)
    return stored.join(changed, item, "left_anti").unionByName(derived.join(changed, item, "left_semi"), allowMissingColumns=True)


# The columns that a mention's id is a hash of; those that end in _json by their content.
MENTION_ID_COLUMNS = (
    "amounts_json", "commitment_termination_date", "commitment_termination_date_json", "dates_json", "instrument_type", "interest_rate_json", "item_id", "lender_disclosure", "maturity_date", "maturity_date_json",
    "name", "name_json", "parties_json", "principal_amount", "start_date", "start_date_json", "status_json",
)


def canonical_json(value: str | None) -> str:
    """A payload with its keys sorted and without white space; what isn't JSON stays as it is."""
    try:
        return json.dumps(json.loads(str(value)), sort_keys=True, separators=(",", ":"))
    except json.JSONDecodeError:
        return str(value)


@pandas_udf(StringType())
def _identity(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
    for rows in batches:
        columns = {c: [None if pd.isna(v) else v for v in rows[c]] for c in MENTION_ID_COLUMNS}
        out = []
        for i in range(len(rows)):
            row = {c: canonical_json(v[i]) if c.endswith("_json") else v[i] for c, v in columns.items()}
            out.append(json.dumps(row, sort_keys=True, separators=(",", ":")))
        yield pd.Series(out, dtype=object)


def mention_id(df: DataFrame) -> Column:
    """The id of a mention by its content: "dim::" and 24 digits; columns df lacks count as null, amounts as their text."""
    have = set(df.columns)
    content = F.struct(*((F.col(c).cast("string") if c in have else F.lit(None).cast("string")).alias(c) for c in MENTION_ID_COLUMNS))
    return F.concat(F.lit("dim::"), F.substring(F.sha2(_identity(content), 256), 1, 24))


# -- lease ----------------------------------------------------------------------------------------


class Lease:
    """One writer at a time: a small text with the owner and the time until which it holds.

    A lease that has run out may be taken over; taking, renewing and giving back all compare the
    text they read with the one they replace, so of two writers one fails.
    """

    def __init__(self, spark: SparkSession, path: str, owner: str, seconds: float = LEASE, clock=time.time) -> None:
        self.spark, self.path, self.owner, self.seconds, self.clock = spark, path, owner, seconds, clock
        self.taken_at = 0.0

    def _text(self, until: float) -> str:
        return json.dumps({"owner": self.owner, "until": until})

    def take(self) -> bool:
        """Take the lease; False if another writer holds it."""
        now = self.clock()
        current = read_text(self.spark, self.path)
        if current is None:
            taken = create_text(self.spark, self.path, self._text(now + self.seconds))
        else:
            held_by = json.loads(current)
            if held_by["owner"] != self.owner and held_by["until"] > now:
                return False
            taken = replace_text(self.spark, self.path, self._text(now + self.seconds), content_version(current))
        self.taken_at = now if taken else self.taken_at
        return taken

    def renew(self) -> None:
        """Extend the lease, at most every RENEW seconds; RuntimeError if another writer has it by now."""
        if self.clock() - self.taken_at < RENEW:
            return
        current = read_text(self.spark, self.path)
        if current is None or json.loads(current)["owner"] != self.owner or not self.take():
            raise RuntimeError(f"the lease {self.path} is lost")

    def give_back(self) -> None:
        """End the lease now, if it is still this writer's."""
        current = read_text(self.spark, self.path)
        if current is not None and json.loads(current)["owner"] == self.owner:
            replace_text(self.spark, self.path, self._text(0.0), content_version(current))
