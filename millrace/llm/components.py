"""Connected components of links, smallest id as the name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import stored


def components(links: DataFrame) -> DataFrame:
    """For links ``a, b`` in one direction each, ``id, component`` of all linked ids.

    Every round takes the smallest label among a node's neighbours and then the
    label of that label, so that chains shrink by half or more; it ends when no
    label changes.  Each round is filed, and a node with very many links is
    combined in the map tasks.  Links should be filed; they are read every round.
    """
    most = 2 * links.count()
    back = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    edges = stored(links.select("a", "b").unionByName(back).distinct(), "edges", most)
    labels = stored(
        edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("near")).select(
            "id", F.least("id", "near").alias("component")
        ),
        "labels",
        most,
    )
    while True:
        near = (
            edges.join(labels.withColumnRenamed("id", "b"), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("component").alias("near"))
        )
        hooked = stored(
            labels.join(near, "id").select(
                "id",
                F.col("component").alias("before"),
                F.least("component", "near").alias("hook"),
            ),
            "hooked",
            most,
        )
        if hooked.filter("hook <> before").isEmpty():
            return labels
        jump = hooked.select(F.col("id").alias("hook"), F.col("hook").alias("further"))
        labels = stored(
            hooked.join(jump, "hook", "left").select(
                "id", F.coalesce(F.least("hook", "further"), "hook").alias("component")
            ),
            "labels",
            most,
        )


def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels after links ``a, b`` between components are added.

    ``labels`` are ``id, component`` as ``components`` gives them; an id without one
    is a component of its own.  Only the new links are gone through.
    """
    if links.isEmpty():
        return labels
    moved = components(links)
    names = moved.select(F.col("id").alias("component"), F.col("component").alias("new"))
    old = labels.join(names, "component", "left").select(
        "id", F.coalesce("new", "component").alias("component")
    )
    new = moved.join(labels.select("id"), "id", "left_anti")
    most = labels.count() + 2 * links.count()
    return stored(old.unionByName(new), "labels", most)
