"""Documents drawn from a tree of sources to target weights in tokens."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..storage import stored

#: Pieces that a range of hash values is cut into, and rows that need no further cut.
_CUT, _FEW = 2, 256

Path = tuple


def shares(budget: float, weights: Sequence[float], room: Sequence[float]) -> list[float]:
    """A budget split by weight; what does not fit into one goes to the others by weight.

    Children are filled in the order of room for each unit of weight.  Nothing
    is left over unless all are full; a child without weight gets nothing.
    """
    given = [0.0] * len(weights)
    order = sorted(
        (i for i in range(len(weights)) if weights[i] > 0), key=lambda i: (room[i] / weights[i], i)
    )
    weight = sum(weights[i] for i in order)
    for i in order:
        given[i] = min(float(room[i]), budget * weights[i] / weight)
        budget, weight = budget - given[i], weight - weights[i]
    return given


def budgets(
    room: Mapping[Path, float], weights: Mapping[Path, float], total: float
) -> dict[Path, int]:
    """Tokens for each leaf of the tree whose leaves ``room`` names by their paths.

    ``weights`` has the weight of a node among its siblings by its path, 1 where
    it has none.  A leaf's shortage goes to its siblings first and only what
    their whole family cannot take goes to the families beside it, since every
    node's room is that of all its leaves.
    """
    below: dict[Path, dict[Path, float]] = {}
    for path, tokens in room.items():
        for depth in range(len(path)):
            family = below.setdefault(path[:depth], {})
            child = path[: depth + 1]
            family[child] = family.get(child, 0.0) + tokens
    given: dict[Path, float] = {(): float(total)}
    for parent in sorted(below, key=len):
        family = sorted(below[parent].items(), key=lambda item: repr(item[0]))
        parts = shares(
            given[parent],
            [float(weights.get(child, 1.0)) for child, _ in family],
            [tokens for _, tokens in family],
        )
        given.update(zip((child for child, _ in family), parts, strict=True))
    return {path: int(given[path] + 1e-6) for path in room}


def _cuts(rows: DataFrame) -> tuple[DataFrame, int]:
    """For each leaf the piece of hash values in which its budget ends.

    ``leaf, cut, base``: all rows with a smaller beginning of ``key`` fit, with
    ``base`` tokens; of those that begin with ``cut`` some may.  A piece is cut
    again until few rows of any leaf are open, so no task gets all rows of a
    large leaf, only sums of pieces.
    """
    cuts, length = None, 0
    while True:
        length += _CUT
        if cuts is None:
            inside = rows.withColumn("base", F.lit(0).cast("long"))
        else:
            inside = rows.join(cuts, "leaf").filter(F.expr(f"left(key, {length - _CUT}) = cut"))
        pieces = inside.groupBy("leaf", F.expr(f"left(key, {length})").alias("cut")).agg(
            F.sum("tokens").alias("piece"),
            F.count("*").alias("n"),
            F.first("rest").alias("rest"),
            F.first("base").alias("base"),
        )
        so_far = Window.partitionBy("leaf").orderBy("cut").rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
        over = pieces.withColumn("upto", F.col("base") + F.sum("piece").over(so_far)).filter(
            "upto > rest"
        )
        filed = stored(
            over.withColumn("base", F.col("upto") - F.col("piece"))
            .groupBy("leaf")
            .agg(F.min_by(F.struct("cut", "base", "n"), "cut").alias("c"))
            .select("leaf", "c.cut", "c.base", "c.n"),
            "cuts",
        )
        most = filed.agg(F.max("n")).first()[0] or 0
        cuts = filed.select("leaf", "cut", "base")
        if most <= _FEW or length >= 32:
            return cuts, length


def mix(
    documents: DataFrame,
    levels: Sequence[str],
    weights: Mapping[Path, float],
    total: float | None = None,
    share: float = 1.0,
    epochs: int = 1,
    seed: int = 1,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The chosen documents: id, ``levels``, ``tokens bigint``, ``copies int``.

    ``levels`` are the columns of the tree from the root down, such as domain,
    language and source; ``weights`` holds relative weights by path from the
    root (see ``budgets``).  The budget is ``total`` tokens, or ``share`` of all
    tokens there are; a token is a run of characters other than ASCII white space.

    A leaf may be read ``epochs`` times at most.  Each epoch is an order of the
    leaf's documents by a hash of seed, epoch and id; a leaf gives whole epochs
    and then, if budget is left, the longest beginning of the next whose tokens
    fit.  ``copies`` counts how often a document is chosen, at least once.

    Through the driver goes one row for each leaf, as for ``weights``.  A null in
    a level is a value of its own, with ``None`` in its path.  Texts without
    tokens, or null, cost nothing and are chosen as their place in the order
    says; a leaf with no tokens at all gives nothing.  Repeated rows of one id have one place and follow each other.  An
    empty table gives no rows.  Other columns are not read.
    """
    leaf = F.to_json(F.array(*(F.col(level).cast("string") for level in levels)))
    text = F.coalesce(F.col(text_column), F.lit(""))
    sized = stored(
        documents.select(
            F.col(id_column).alias("id"),
            *(F.col(level).alias(f"level_{i}") for i, level in enumerate(levels)),
            leaf.alias("leaf"),
            F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("tokens"),
        ),
        "sized",
    )
    names = [f"level_{i}" for i in range(len(levels))]
    found = sized.groupBy("leaf", *names).agg(F.sum("tokens").alias("tokens")).collect()
    there = {tuple(row[name] for name in names): row["tokens"] for row in found}
    budget = share * sum(there.values()) if total is None else total
    given = budgets({path: tokens * epochs for path, tokens in there.items()}, weights, budget)
    plan = []
    for row in found:
        tokens = row["tokens"]
        whole, rest = divmod(given[tuple(row[name] for name in names)], tokens) if tokens else (0, 0)
        plan.append((row["leaf"], whole, rest))
    spark = documents.sparkSession
    plans = stored(
        spark.createDataFrame(plan, "leaf string, whole bigint, rest bigint").coalesce(1), "plan"
    )
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("whole"), F.col("id")))
    rows = stored(sized.join(plans, "leaf").withColumn("key", order), "ordered")
    cuts, length = _cuts(rows.filter("rest > 0").select("leaf", "tokens", "key", "rest"))

    begin = F.expr(f"left(key, {length})")
    placed = rows.join(cuts, "leaf", "left").withColumn("begin", begin)
    outside = placed.filter("cut IS NULL OR begin <> cut").withColumn(
        "extra", F.coalesce(F.col("begin") < F.col("cut"), F.lit(False))
    )
    so_far = (
        Window.partitionBy("leaf")
        .orderBy("key", "tokens")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    edge = placed.filter("begin = cut").withColumn(
        "extra", F.col("base") + F.sum("tokens").over(so_far) <= F.col("rest")
    )
    chosen = outside.unionByName(edge).withColumn(
        "copies", (F.col("whole") + F.col("extra").cast("long")).cast("int")
    )
    return chosen.filter("copies > 0").select(
        F.col("id").alias(id_column),
        *(F.col(name).alias(level) for name, level in zip(names, levels, strict=True)),
        "tokens",
        "copies",
    )
