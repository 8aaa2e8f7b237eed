"""Datasets of partition folders: listing and pruning by layout, tolerant reads, sinks, and small texts.

Two layouts: `date=YYYY-MM-DD/cik_shard=NNNN/part-0000.parquet` and `month=YYYY-MM/part-0000.parquet`.
The driver sees folders only, never rows.
"""

from __future__ import annotations

import gzip
import re
from collections.abc import Iterator
from datetime import date

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType, StructType

from ledgerline.functions.text import normalize_cik
from ledgerline.operators.publish import files, remove

# The two layouts of partition paths.
DATE_SHARD = re.compile(r"(?P<dataset>[^/]+)/date=(?P<date>\d{4}-\d{2}-\d{2})/cik_shard=(?P<shard>\d{4})/part-0000\.parquet$")
MONTH = re.compile(r"(?P<dataset>[^/]+)/month=(?P<month>\d{4}-\d{2})/part-0000\.parquet$")


class StrayFileError(ValueError):
    """A Parquet file of a dataset that lies outside of its layout."""


def partition_of(path: str) -> dict[str, str] | None:
    """What a path says of its partition (dataset and date with shard, or month), by either layout; null for other paths."""
    found = DATE_SHARD.search(path) or MONTH.search(path)
    return found.groupdict() if found else None


def partition_column(path: Column, name: str) -> Column:
    """The value of a partition key in a file's path (`_metadata.file_path`); null where the path has no such key."""
    value = F.regexp_extract(path, rf"/{name}=([^/]+)/", 1)
    return F.when(value != "", value)


def partition_files(spark: SparkSession, root: str, segment: str | None = None) -> list[str]:
    """The Parquet files below root, those with a path segment equal to `segment` ("date=2024-01-02") only."""
    found = [path for path, *_ in files(spark, root) if path.endswith(".parquet")]
    return [p for p in found if segment is None or segment in p.split("/")]


def files_between(spark: SparkSession, root: str, start: date | None = None, end: date | None = None) -> list[str]:
    """The files of a date and shard dataset from start to end, both included; None leaves a side open.

    A Parquet file outside of the layout is an error: its rows would be counted as taken in and never read.
    """
    kept = []
    for path in partition_files(spark, root):
        where = DATE_SHARD.search(path)
        if where is None:
            raise StrayFileError(f"{path} lies outside of the dataset's layout")
        day = date.fromisoformat(where["date"])
        if (start is None or start <= day) and (end is None or day <= end):
            kept.append(path)
    return kept


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The columns of schema of a Parquet file or folder: what it lacks is null, and a path that isn't there has no rows."""
    if not files(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def read_files(spark: SparkSession, paths: list[str], columns: list[str] | None = None, where: dict[str, list] | None = None, base: str | None = None) -> DataFrame | None:
    """The rows of many Parquet files under the union of their schemas; None for no files.

    where keeps rows whose column is one of a list (pushed to the scan); a column no file has keeps
    none. Files whose schemas contradict each other are read one by one and what differs is text.
    """
    if not paths:
        return None
    reader = spark.read.option("mergeSchema", True)
    reader = reader.option("basePath", base) if base else reader
    try:
        rows = reader.parquet(*paths)
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE" not in str(error):
            raise
        each = [(spark.read.option("basePath", base) if base else spark.read).parquet(p) for p in paths]
        kinds: dict[str, set] = {}
        for df in each:
            for field in df.schema:
                kinds.setdefault(field.name, set()).add(field.dataType.simpleString())
        plain = [df.select(*(F.col(c).cast("string").alias(c) if len(kinds[c]) > 1 else F.col(c) for c in df.columns)) for df in each]
        rows = plain[0]
        for df in plain[1:]:
            rows = rows.unionByName(df, allowMissingColumns=True)
    for column, values in (where or {}).items():
        rows = rows.where(F.col(column).isin(values) if column in rows.columns else F.lit(False))
    if columns is None:
        return rows
    return rows.select(*(F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in columns))


def footer_rows(spark: SparkSession, path: str) -> int:
    """The number of rows below a path, from the files' footers alone: an aggregate pushed into the scan."""
    if not files(spark, path):
        return 0
    before = {k: spark.conf.get(k) for k in ("spark.sql.sources.useV1SourceList", "spark.sql.parquet.aggregatePushdown")}
    try:
        spark.conf.set("spark.sql.sources.useV1SourceList", "")
        spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
        return spark.read.option("recursiveFileLookup", True).parquet(path).groupBy().count().first()[0]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def write_partition(df: DataFrame, root: str, partition: str, order: list[str]) -> str:
    """Write df as the one file of a partition folder, sorted, beside its place first; the file's path."""
    spark = df.sparkSession
    staged, target = f"{root}/.staged-{partition.replace('/', '-')}", f"{root}/{partition}"
    df.coalesce(1).sortWithinPartitions(*order).write.mode("overwrite").parquet(staged)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    (made,) = [p for p, *_ in files(spark, staged) if p.endswith(".parquet")]
    fs.mkdirs(path(target))
    remove(spark, f"{target}/part-0000.parquet")
    fs.rename(path(made), path(f"{target}/part-0000.parquet"))
    remove(spark, staged)
    return f"{target}/part-0000.parquet"


def decoded(content: bytes | None) -> str | None:
    """Stored bytes as text: unzipped if they are zipped, with a mark for what isn't UTF-8."""
    if content is None:
        return None
    body = gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content
    return body.decode("utf-8", errors="replace")


@pandas_udf(StringType())
def _decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        yield batch.map(decoded)


def documents_at(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(resource_uri, text): stored documents, zipped or not, read as files by the executors."""
    return spark.read.format("binaryFile").load(paths).select(F.col("path").alias("resource_uri"), _decoded("content").alias("text"))


def resolved_texts(rows: DataFrame, resources: DataFrame) -> DataFrame:
    """rows (with text and resource_uri) with each blank text replaced by that of its resource."""
    inline = F.when(F.trim("text") != "", F.col("text"))
    stored = resources.select("resource_uri", F.col("text").alias("_stored"))
    return rows.join(stored, "resource_uri", "left").withColumn("text", F.coalesce(inline, "_stored")).select(*rows.columns)


def copy_file(spark: SparkSession, source: str, target: str) -> None:
    """Copy one file within or across file systems."""
    path, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    own, other = path(source), path(target)
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(own.getFileSystem(conf), own, other.getFileSystem(conf), other, False, conf)


def split_uri(uri: str) -> tuple[str, str]:
    """(bucket, key) of an object's address; ValueError for anything else."""
    found = re.fullmatch(r"s3a?://([^/]+)/(.+)", uri)
    if not found:
        raise ValueError(f"{uri} is no object's address")
    return found[1], found[2]


def joined(prefix: str, *parts: str) -> str:
    """A path below a prefix, with one slash between parts."""
    return "/".join([prefix.rstrip("/"), *(p.strip("/") for p in parts)])


def listed_issuers(spark: SparkSession, path: str) -> DataFrame | None:
    """(cik): the issuers a text file lists, a line each; None, for no restriction, where a line says "all"."""
    rows = spark.read.text(path).select(F.trim("value").alias("value")).where("value <> '' and not value like '#%'")
    if rows.where("lower(value) = 'all'").limit(1).count():
        return None
    return rows.select(normalize_cik(F.col("value")).alias("cik")).distinct()
