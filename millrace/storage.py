"""Shared folders, and tables whose rows are filed under their batch."""

from __future__ import annotations

import tempfile
import uuid
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SETTING = "spark.checkpoint.dir"
_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows of a file of a table with a known bound, and the number of files below which
#: it does not go.
_FILE_ROWS, _FEW_FILES = 1 << 16, 16

#: Folders that ``stored`` has made, by application.
_MADE: dict[str, list[str]] = defaultdict(list)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as ``spark.checkpoint.dir`` names it.

    Only a local session, where driver and executors are one process, may do
    without the setting; it then gets a new temporary folder.
    """
    context = spark.sparkContext
    folder = context.getConf().get(_SETTING)
    if folder is None:
        folder = spark.conf.get(_SETTING, None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {_SETTING} to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="millrace-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A path for one run under the shared folder, never used before."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(rows: DataFrame, name: str, most: int | None = None, tidy: bool = False) -> DataFrame:
    """Rows written once as a table in the shared folder, for a result read often.

    Lost executors cost no recomputation, and later reads take only the columns
    and row groups they need.  A filed table is also a side of its own for a
    join: nothing above it is dealt out by the join's key yet, so Spark can
    split the other side where one key has very many rows.

    ``most``, if known, is about the largest number of rows, or of the items of their
    lists.  A small table is then written by few tasks: with many shuffle partitions it
    would be hundreds of files of a few rows, which cost more than the work.  No row is
    left out if there are more, and a large table keeps its tasks.

    With ``tidy``, Spark removes the shuffle files of the write as it ends, not when the driver
    collects its garbage: nothing reads them again, as the rows are filed.

    The table stays until ``release`` or ``discard``: results are computed from it later.
    """
    spark = rows.sparkSession
    if most is not None:
        rows = rows.coalesce(max(_FEW_FILES, -(-most // _FILE_ROWS)))
    path = new_folder(spark, name)
    _MADE[spark.sparkContext.applicationId].append(path)
    before = spark.conf.get(_TIDY, None)
    if tidy:
        spark.conf.set(_TIDY, "true")
    try:
        rows.write.parquet(path)
    finally:
        if tidy and before is None:
            spark.conf.unset(_TIDY)
        elif tidy:
            spark.conf.set(_TIDY, before)
    return spark.read.schema(rows.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Remove a table that ``stored`` has made, when all that reads it is filed itself."""
    spark = table.sparkSession
    made = _MADE[spark.sparkContext.applicationId]
    files = table.inputFiles()
    for path in [path for path in made if any(f"/{path.rpartition('/')[2]}/" in file for file in files)]:
        made.remove(path)
        remove(spark, path)


def release(spark: SparkSession) -> None:
    """Remove every table that ``stored`` has made in this application so far.

    Call it when no result is open that was made from one of them.
    """
    for path in _MADE.pop(spark.sparkContext.applicationId, []):
        remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder on whatever file system it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def filed_batches(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the batches that are completely filed, newest first; reads no rows."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch_id=*/_SUCCESS")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    names = [str(status.getPath().getParent().getName()) for status in found or []]
    return sorted((int(name.partition("=")[2]) for name in names), reverse=True)


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """File a batch's rows under its id, replacing an earlier attempt.

    ``foreachBatch`` may repeat a batch after a failure; a repeat writes the
    same folder again, so every batch counts once.
    """
    rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All filed rows with ``batch_id bigint``."""
    rows = spark.read.parquet(path)
    return rows.withColumn("batch_id", F.col("batch_id").cast("bigint"))
