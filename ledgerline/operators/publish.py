"""Publishing tables: contract, guards, snapshot generations behind a pointer."""

from __future__ import annotations

import hashlib
import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import text

#: A snapshot with fewer rows than this share of the last is refused.
LEAST_SHARE = 0.5


class ShrinkError(RuntimeError):
    """A table lost so many rows that it isn't published."""


def conform(df: DataFrame, contract: dict[str, str]) -> DataFrame:
    """df under the contract (column -> type): unknown columns go, missing ones are null, types are cast, placeholder texts null."""
    have = set(df.columns)

    def column(name: str, kind: str):
        if name not in have:
            return F.lit(None).cast(kind).alias(name)
        value = text.coerce_text(F.col(name)) if kind == "string" else F.col(name)
        return value.try_cast(kind).alias(name)

    return df.select(*(column(*item) for item in contract.items()))


def files(spark: SparkSession, root: str) -> list[tuple[str, int, int]]:
    """(path, length, modification time) of all files below root; none if it doesn't exist."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    found, listing = [], fs.listFiles(path, True)
    while listing.hasNext():
        status = listing.next()
        found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return sorted(found)


def tree_digest(spark: SparkSession, roots: list[str], context: str = "") -> str:
    """A digest of what lies below roots (paths, lengths, times) and of a context: equal digests, nothing to publish."""
    listed = [(root, *entry) for root in roots for entry in files(spark, root)]
    return hashlib.sha256(json.dumps([listed, context]).encode()).hexdigest()


def _context(spark: SparkSession, path: str):
    """(file context, path) of the file system that path is on."""
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    uri = hpath.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hpath).toUri()
    return jvm.org.apache.hadoop.fs.FileContext.getFileContext(uri, spark._jsc.hadoopConfiguration()), hpath


def write_text(spark: SparkSession, path: str, content: str) -> None:
    """Write a small text beside its place and rename it over the old one in one step: a reader sees the old or the new one, never none."""
    context, hpath = _context(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(beside, True)
    out.write(bytearray(content.encode()))
    out.close()
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context.rename(beside, hpath, options)


def create_text(spark: SparkSession, path: str, content: str) -> bool:
    """Write a small text where there is none; False, and nothing written, where there is one."""
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        out = fs.create(hpath, False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in str(error.java_exception):
            return False
        raise
    out.write(bytearray(content.encode()))
    out.close()
    return True


def content_version(content: str | None) -> str:
    """What a text is known by: equal texts, equal versions; that of no text is empty."""
    return hashlib.sha256(content.encode()).hexdigest() if content is not None else ""


def replace_text(spark: SparkSession, path: str, content: str, version: str) -> bool:
    """Replace a text if it still has that version (compare and swap); False, and nothing written, if not.

    A lock file made by create_text() keeps two writers apart; it names no owner and goes with the
    swap. One left behind by a writer that died is an error for the caller to see.
    """
    lock = f"{path}.lock"
    if not create_text(spark, lock, ""):
        return False
    try:
        if content_version(read_text(spark, path)) != version:
            return False
        write_text(spark, path, content)
        return True
    finally:
        remove(spark, lock)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there."""
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hpath, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hpath):
        return None
    return "\n".join(r[0] for r in spark.read.text(path).collect())


def shrunk(before, now, least_share: float = LEAST_SHARE):
    """Whether a table has so few rows left that it must not be published; of numbers and of columns."""
    return now < least_share * before


def guard(before: dict[str, int], now: dict[str, int], least_share: float = LEAST_SHARE) -> None:
    for name, rows in before.items():
        if rows and shrunk(rows, now.get(name, 0), least_share):
            raise ShrinkError(f"{name}: {now.get(name, 0)} rows after {rows}")


def publish(spark: SparkSession, root: str, tables: dict[str, DataFrame], digest: str, keep: int = 2, force: bool = False) -> str | None:
    """Write tables as a new generation below root and point latest.json at it; None if digest is the published one.

    The pointer moves after all tables are written and checked, and carries the digest, so a crash
    before leaves the last generation in place. The newest `keep` generations stay.
    """
    pointer = json.loads(read_text(spark, f"{root}/latest.json") or "{}")
    if pointer.get("digest") == digest and not force:
        return None
    generation = f"gen-{int(pointer.get('generation', 'gen-0').split('-')[1]) + 1}"
    counts = {}
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root}/snapshots/{generation}/{name}")
        counts[name] = spark.read.parquet(f"{root}/snapshots/{generation}/{name}").count()
    if not force:
        guard(pointer.get("rows", {}), counts)
    kept = [*pointer.get("kept", []), generation][-keep:]
    write_text(spark, f"{root}/latest.json", json.dumps({"generation": generation, "rows": counts, "kept": kept, "digest": digest}))
    for old in set(pointer.get("kept", [])) - set(kept):
        remove(spark, f"{root}/snapshots/{old}")
    return generation
