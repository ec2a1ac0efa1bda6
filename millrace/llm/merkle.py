"""A manifest of a dataset as hash trees, with a proof for every row.

Rows of a group are the leaves of one tree and the groups' roots are the leaves of
the last one.  A level is one aggregate: every parent spreads its children into as many
columns as it has slots; all columns joined give the parent's digest, all but
one the siblings of that one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import stored
from .numbering import numbered

FANOUT = 8
_PATH = "array<struct<left:string,right:string>>"


def framed(values: list[Column]) -> Column:
    """Values behind one another, each as its UTF-8 byte count, ``:`` and itself; null is ``-``."""

    def one(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.concat(*(one(value) for value in values))


def digest(*parts: Column) -> Column:
    """Lowercase hexadecimal SHA-256 of the parts behind one another."""
    return F.sha2(F.concat(*parts), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give, level by level."""
    return F.aggregate(path, leaf, lambda node, side: digest(side["left"], node, side["right"]))


def proof(path: Column) -> Column:
    """All siblings behind one another, from the leaf's own to the root's."""
    sides = F.transform(path, lambda side: F.concat(side["left"], side["right"]))
    return F.array_join(sides, "")


def _level(nodes: DataFrame, columns: list[str], fanout: int) -> DataFrame:
    """Parents of all nodes ``tree, i, n, digest`` of trees with more than one."""
    node = F.struct("digest", *columns)
    slots = [
        F.max(F.when(F.col("i") % fanout == k, node)).alias(f"c{k}") for k in range(fanout)
    ]
    parents = (
        nodes.filter("n > 1")
        .groupBy("tree", F.call_function("div", F.col("i"), F.lit(fanout)).alias("i"))
        .agg(
            F.call_function("div", F.max("n") + fanout - 1, F.lit(fanout)).alias("n"), *slots
        )
    )
    joined = F.concat_ws("", *(f"c{k}.digest" for k in range(fanout)))
    return stored(parents.withColumn("digest", F.sha2(joined, 256)), "level")


def _children(parents: DataFrame, columns: list[str], fanout: int) -> DataFrame:
    """Nodes below parents that have their ``path``, each with its own path."""
    nodes = []
    for k in range(fanout):
        left = F.concat_ws("", *(f"c{j}.digest" for j in range(k)))
        right = F.concat_ws("", *(f"c{j}.digest" for j in range(k + 1, fanout)))
        side = F.struct(left.alias("left"), right.alias("right"))
        node = F.struct(
            (F.col("i") * fanout + k).alias("i"),
            F.concat(F.array(side), F.col("path")).alias("path"),
            F.col(f"c{k}.digest").alias("digest"),
            *(F.col(f"c{k}.{name}").alias(name) for name in columns),
        )
        nodes.append(F.when(F.col(f"c{k}").isNotNull(), node))
    below = parents.select("tree", "top", F.explode(F.array(*nodes)).alias("node"))
    return below.filter("node IS NOT NULL").select("tree", "top", "node.*")


def trees(
    leaves: DataFrame, above: str, columns: list[str], fanout: int, largest: int
) -> tuple[DataFrame, list[DataFrame]]:
    """Hash every tree of ``tree, i, n, digest`` up to its root.

    ``columns`` of the leaves travel with them; ``largest`` is the most leaves that a tree has.
    Gives the roots ``tree, digest`` as column ``above``, and the levels for ``paths``.
    """
    levels = [leaves]
    while largest > 1:
        levels.append(_level(levels[-1], columns if len(levels) == 1 else [], fanout))
        largest = -(-largest // fanout)
    tops = [level.filter("n = 1").select("tree", F.col("digest").alias(above)) for level in levels]
    return reduce(DataFrame.unionByName, tops), levels


def paths(
    levels: list[DataFrame], tops: DataFrame, columns: list[str], fanout: int
) -> DataFrame:
    """The leaves ``tree, i, digest`` with ``columns``, ``path`` and their tree's ``top``.

    ``tops`` has ``tree, path, top`` for every tree: the way on from its root.  A path
    comes down from parent to children, so the joins are on parents, an eighth
    of the nodes and less with every level.
    """
    known = None
    for depth in range(len(levels) - 1, -1, -1):
        own = columns if depth == 0 else []
        roots = (
            levels[depth]
            .filter("n = 1")
            .join(tops, "tree")
            .select("tree", "top", "i", "path", "digest", *own)
        )
        if known is not None:
            parents = levels[depth + 1].drop("digest", "n").join(
                known.select("tree", "i", "path", "top"), ["tree", "i"]
            )
            roots = roots.unionByName(_children(parents, own, fanout))
        known = roots
    return known


def manifest(
    rows: DataFrame,
    leaf: Column,
    group: Column,
    order: list[Column],
    carried: dict[str, Column],
    fanout: int = FANOUT,
) -> DataFrame:
    """Every row's ``leaf``, ``subroot``, ``root`` and ``path``, with ``carried`` columns.

    Within a ``group`` (a string) leaves stand in ``order``, then by their digest.  While a
    tree has several nodes, every ``fanout`` that follow one another become the
    SHA-256 of their hexadecimal digests; the last run may be shorter.  What remains, a lone
    leaf itself included, is ``subroot``.  Subroots in order of the group (null
    first, bytewise) give ``root`` in the same way.  ``path`` is an array of ``left,
    right``: the digests beside the row's node at every level, up to the root.
    ``folded`` and ``proof`` read it.

    Rows that repeat are leaves of their own.  A null group is a group.  No rows give no rows,
    and then there is no root.  ``carried`` may use names of any kind, but not those above.
    """
    names = list(carried)
    slim = rows.select(
        group.alias("tree_of"),
        leaf.alias("digest"),
        F.struct(*(column.alias(name) for name, column in carried.items())).alias("row"),
        *(key.alias(f"key{k}") for k, key in enumerate(order)),
    )
    by = [F.col("tree_of").asc_nulls_first()]
    by += [F.col(f"key{k}").asc_nulls_last() for k in range(len(order))]
    placed = numbered(stored(slim, "leaves"), [*by, F.col("digest")], "number")
    counted = stored(
        placed.groupBy("tree_of").agg(F.min("number").alias("tree"), F.count("*").alias("n")),
        "groups",
    )
    sizes = counted.agg(F.max("n"), F.count("*")).first()
    # A group's first number is its name from here on, and never null.
    key = counted.withColumnRenamed("tree_of", "_tree_of")
    leaves = stored(
        placed.join(key, F.col("tree_of").eqNullSafe(F.col("_tree_of"))).select(
            "tree", (F.col("number") - F.col("tree")).alias("i"), "n", "digest", "row"
        ),
        "leaves",
    )
    subroots, levels = trees(leaves, "subroot", ["row"], fanout, sizes[0] or 0)
    subroots = stored(subroots, "subroots")

    last = numbered(subroots, [F.col("tree")], "i").select(
        F.lit(0).cast("long").alias("tree"),
        "i",
        F.lit(sizes[1]).cast("long").alias("n"),
        F.col("subroot").alias("digest"),
        F.col("tree").alias("group"),
    )
    roots, upper = trees(last, "root", ["group"], fanout, sizes[1])
    start = roots.select(
        "tree", F.col("root").alias("top"), F.array().cast(_PATH).alias("path")
    )
    tops = paths(upper, start, ["group"], fanout).select(
        F.col("group").alias("tree"),
        "path",
        F.struct(F.col("digest").alias("subroot"), F.col("top").alias("root")).alias("top"),
    )
    found = paths(levels, stored(tops, "tops"), ["row"], fanout)
    return found.select(
        *(F.col("row")[name].alias(name) for name in names),
        F.col("digest").alias("leaf"),
        F.col("top.subroot").alias("subroot"),
        F.col("top.root").alias("root"),
        "path",
    )
