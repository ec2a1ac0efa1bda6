"""Feeding a table to a stream in known batches."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def replay(
    batches: Sequence[Sequence[tuple[DataFrame, str]]], start: Callable[[], StreamingQuery]
) -> None:
    """Drop the files of one batch, run the query until it has read them, repeat.

    Each batch is a list of (lines, folder).  Starting the query anew for every
    batch makes its contents certain, however many files a drop has, and takes
    the query through a restart from its checkpoint each time.
    """
    for batch in batches:
        for lines, folder in batch:
            lines.write.mode("append").text(folder)
        start().awaitTermination()
