"""Cutting long lineages with a table in the folder all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; a temporary one only where that is unset (tests, local runs)."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    if not getattr(shared_dir, "own", None):
        shared_dir.own = "file://" + tempfile.mkdtemp(prefix="ledgerline-")
    return shared_dir.own


#: Folders written by cut() in this process and not deleted since.
_written: list[str] = []


def cut(df: DataFrame) -> DataFrame:
    """Write df as a Parquet table in the shared folder and return a scan of it.

    The written table survives the loss of executors, ends the lineage, and gives later
    joins exact sizes, so that broadcasts are only chosen below the session's threshold.
    """
    path = f"{shared_dir(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    _written.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_cut(df: DataFrame) -> None:
    """Delete the files of a table made by cut() that no later plan reads."""
    for name in df.inputFiles()[:1]:
        folder = name.rsplit("/", 1)[0]
        if "/cut-" in folder:
            _delete(df.sparkSession, folder)
            _written[:] = [w for w in _written if not folder.endswith(w.rsplit("/", 1)[1])]


def release(spark: SparkSession) -> int:
    """Delete every table cut() has written in this process; how many there were.

    Results that haven't been read or written yet can't be read any more, so a long session calls
    this between jobs. At the end of the process it happens by itself.
    """
    count = len(_written)
    while _written:
        _delete(spark, _written.pop())
    return count


@atexit.register
def _release_at_exit() -> None:
    try:
        if _written and (spark := SparkSession.getActiveSession()) is not None:
            release(spark)
    except Exception:  # noqa: BLE001  the session may have gone before
        pass
