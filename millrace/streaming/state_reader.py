"""The state that a stream keeps, read from its checkpoint as a table.

Nothing of the stream's output is read, so the cost is that of the state at one batch,
however long the stream has run and whatever it has filed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kept_batches(spark: SparkSession, checkpoint: str) -> tuple[int, int]:
    """The first and the last batch whose state the checkpoint still has."""
    found = spark.read.format("state-metadata").load(checkpoint)
    first, last = found.agg(F.min("minBatchId"), F.max("maxBatchId")).first()
    if last is None:
        raise ValueError(f"{checkpoint} has no state")
    return first, last


def state_at(
    spark: SparkSession, checkpoint: str, batch_id: int | None = None, variable: str | None = None
) -> DataFrame:
    """Every key and its state after a batch, by default the last one: the key's columns
    and the state's.

    ``variable`` names the value of a custom state; an aggregate has none.  A map gives a row
    for each of its keys, without columns of the grouping key that begin with an underscore: these
    only deal the map's keys out.  Spark keeps the
    last 100 batches (``spark.sql.streaming.minBatchesToRetain``).
    """
    options = {} if batch_id is None else {"batchId": str(batch_id)}
    rows = _read(spark, checkpoint, options, variable)
    return rows.select(*_columns(rows))


def state_changes(
    spark: SparkSession, checkpoint: str, first: int, last: int, variable: str | None = None
) -> DataFrame:
    """What batches ``first`` to ``last`` wrote: ``batch_id, change``, key and state.

    ``change`` is ``update`` or ``delete``, whose state is null.  Reads the logs of these batches only.
    """
    options = {
        "readChangeFeed": "true",
        "changeStartBatchId": str(first),
        "changeEndBatchId": str(last),
    }
    rows = _read(spark, checkpoint, options, variable)
    return rows.select("batch_id", F.col("change_type").alias("change"), *_columns(rows))


def _columns(rows: DataFrame) -> list[str]:
    if "user_map_key" not in rows.columns:
        return ["key.*", "value.*"]
    own = [f"key.`{name}`" for name in rows.schema["key"].dataType.names if name[0] != "_"]
    return [*own, "user_map_key.*", "user_map_value.*"]


def _read(
    spark: SparkSession, checkpoint: str, options: dict[str, str], variable: str | None
) -> DataFrame:
    reader = spark.read.format("statestore").options(**options)
    if variable is not None:
        reader = reader.option("stateVarName", variable)
    return reader.load(checkpoint)
