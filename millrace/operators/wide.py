"""Principal components of very wide vectors, without a matrix of width by width.

A randomised range finder (Halko, Martinsson and Tropp, 2011): the rows are multiplied
with a narrow matrix, the products are made orthonormal, and rows and products are
multiplied back, a few times over.  Every round is one pass over the rows where they
lie.  The narrow matrix has ``width * (k + extra)`` numbers and travels with the
function, as a model does.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import stored

#: Numbers in the narrow matrix at most; 128 MB.
MOST_CELLS = 1 << 24
#: Entries multiplied at a time, which bounds a task's memory.
_TOGETHER = 1 << 16
#: Triangles that one step of the tree puts together.
_FAN = 16
#: Share of the largest variance by which none may move in the last round, and most rounds.
_STILL, _LONGEST = 1e-6, 30


class WideComponents(NamedTuple):
    """``loadings`` is width x k, one component a column; its largest entry is positive."""

    count: int
    mean: np.ndarray
    loadings: np.ndarray
    variances: np.ndarray

    def project(
        self, rows: DataFrame, indices: str = "indices", values: str = "values"
    ) -> DataFrame:
        """Add ``scores``, the coordinates of each centred row; rows stay where they are."""
        mean, loadings = self.mean, self.loadings

        @F.arrow_udf("array<double>")
        def scores(where: pa.Array, what: pa.Array) -> pa.Array:
            parts = [
                _times(at, columns, weights, loadings) - mean @ loadings
                for at, columns, weights in _slices(where, what, len(mean))
            ]
            flat = np.concatenate([*parts, np.zeros((0, loadings.shape[1]))]).ravel()
            ends = np.arange(len(where) + 1, dtype=np.int32) * loadings.shape[1]
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

        return rows.withColumn("scores", scores(F.col(indices), F.col(values)))


def dense_rows(vectors: DataFrame, features: str = "features") -> DataFrame:
    """Full vectors as ``indices, values`` beside their other columns."""
    places = F.sequence(F.lit(0), F.size(features) - 1)
    return vectors.withColumn(
        "indices", F.when(F.size(features) > 0, places).otherwise(F.array().cast("array<int>"))
    ).withColumnRenamed(features, "values")


def _slices(
    where: pa.Array, what: pa.Array, width: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Where rows begin, columns and values of some rows at a time.

    Null lists, uneven lists, null or non-finite numbers and columns out of range are errors.
    """
    if where.null_count or what.null_count:
        raise ValueError("a row is null")
    starts = where.offsets.to_numpy().astype(np.int64)
    if not np.array_equal(np.diff(starts), np.diff(what.offsets.to_numpy())):
        raise ValueError("a row has not as many indices as values")
    columns, values = where.flatten(), what.flatten()
    if columns.null_count or values.null_count:
        raise ValueError("a row holds a null")
    columns = columns.to_numpy(zero_copy_only=False).astype(np.int64)
    values = values.to_numpy(zero_copy_only=False).astype(np.float64)
    if len(columns) and not (0 <= columns.min() and columns.max() < width):
        raise ValueError(f"a row has an index outside 0 to {width - 1}")
    if not np.isfinite(values).all():
        raise ValueError("a row holds a number that is not finite")
    starts -= starts[0]
    begin = 0
    while begin < len(where):
        end = int(np.searchsorted(starts, starts[begin] + _TOGETHER, side="right")) - 1
        end = min(max(end, begin + 1), len(where))
        a, b = starts[begin], starts[end]
        yield starts[begin : end + 1] - a, columns[a:b], values[a:b]
        begin = end


def _times(
    at: np.ndarray, columns: np.ndarray, values: np.ndarray, narrow: np.ndarray
) -> np.ndarray:
    """Sparse rows times a narrow matrix."""
    sums = np.zeros((len(at) - 1, narrow.shape[1]))
    filled = at[1:] > at[:-1]
    if filled.any():
        sums[filled] = np.add.reduceat(narrow[columns] * values[:, None], at[:-1][filled], axis=0)
    return sums


def _back(
    at: np.ndarray,
    columns: np.ndarray,
    values: np.ndarray,
    products: np.ndarray,
    total: np.ndarray,
) -> None:
    """Add the transposed sparse rows times their products to ``total``."""
    if not len(columns):
        return
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    order = np.argsort(columns, kind="stable")
    sorted_ = columns[order]
    begins = np.flatnonzero(np.concatenate(([True], sorted_[1:] != sorted_[:-1])))
    parts = products[row[order]]
    parts *= values[order, None]
    total[sorted_[begins]] += np.add.reduceat(parts, begins, axis=0)


def _triangle(rows: np.ndarray) -> np.ndarray:
    """The triangle of the rows' QR decomposition, as many rows as columns."""
    width = rows.shape[1]
    padded = rows if len(rows) >= width else np.vstack([rows, np.zeros((width - len(rows), width))])
    return np.linalg.qr(padded, mode="r")


def _pass(rows: DataFrame, mean: np.ndarray, narrow: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows A less their mean and Y = A * narrow: the triangle of Y, and A' * Y.

    Every task folds its rows into one triangle and one product; only columns that its
    rows have are sent on.
    """
    width, l = narrow.shape
    names = [f"w{j}" for j in range(l)]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = mean @ narrow
        total, ones, triangle = np.zeros((width, l)), np.zeros(l), np.zeros((0, l))
        for batch in batches:
            for at, columns, values in _slices(batch.column(0), batch.column(1), width):
                products = _times(at, columns, values, narrow) - shift
                _back(at, columns, values, products, total)
                ones += products.sum(axis=0)
                triangle = _triangle(np.vstack([triangle, products]))
        if not len(triangle):
            return
        task = TaskContext.get().partitionId()
        used = np.flatnonzero(total.any(axis=1))
        # Rows -1 to -l are the triangle, row -l - 1 the sums of the products.
        feature = np.concatenate([used, -1 - np.arange(l + 1)])
        block = np.vstack([total[used], triangle, ones])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(feature), task), pa.int32()),
                pa.array(feature, pa.int32()),
                *(pa.array(column) for column in block.T),
            ],
            names=["task", "feature", *names],
        )

    columns = ", ".join(f"{name} double" for name in names)
    found = stored(rows.mapInArrow(fold, f"task int, feature int, {columns}"), "products")
    sums = found.filter((F.col("feature") >= 0) | (F.col("feature") == -l - 1))
    added = sums.groupBy("feature").agg(*(F.sum(name).alias(name) for name in names)).toArrow()
    block = np.column_stack([added[name].to_numpy() for name in names])
    feature = added["feature"].to_numpy()
    back = np.zeros((width, l))
    back[feature[feature >= 0]] = block[feature >= 0]
    if (feature < 0).any():
        back -= np.outer(mean, block[feature < 0][0])
    return _tree(found.filter(F.col("feature").between(-l, -1)), names), back


def _tree(triangles: DataFrame, names: list[str]) -> np.ndarray:
    """One triangle out of those of all tasks, ``_FAN`` of them at a time."""

    def stack(group: pa.Table) -> pa.Table:
        ordered = group.sort_by([("task", "ascending"), ("feature", "descending")])
        top = _triangle(np.column_stack([ordered[name].to_numpy() for name in names]))
        parent = int(ordered["parent"][0].as_py())
        return pa.table(
            [
                pa.array(np.full(len(top), parent), pa.int32()),
                pa.array(-1 - np.arange(len(top)), pa.int32()),
                *(pa.array(column) for column in top.T),
            ],
            names=["task", "feature", *names],
        )

    last = triangles.agg(F.max("task")).first()[0]
    if last is None:
        return np.zeros((len(names), len(names)))
    schema = "task int, feature int, " + ", ".join(f"{name} double" for name in names)
    parents = last + 1
    while True:
        parent = F.call_function("div", F.col("task"), F.lit(_FAN)).cast("int")
        triangles = triangles.withColumn("parent", parent).groupBy("parent").applyInArrow(stack, schema)
        parents = -(-parents // _FAN)
        if parents == 1:
            break
    final = triangles.orderBy(F.desc("feature")).toArrow()
    return np.column_stack([final[name].to_numpy() for name in names])


def _mean(rows: DataFrame, width: int) -> tuple[int, np.ndarray]:
    count = rows.count()
    sums = (
        rows.select(F.explode(F.arrays_zip("indices", "values")).alias("e"))
        .groupBy(F.col("e.indices").alias("i"))
        .agg(F.sum(F.col("e.values")).alias("total"))
        .toArrow()
    )
    mean = np.zeros(width)
    mean[sums["i"].to_numpy()] = sums["total"].to_numpy() / max(count, 1)
    return count, mean


def wide_components(
    rows: DataFrame,
    width: int,
    k: int,
    extra: int = 8,
    rounds: int = 4,
    seed: int = 1,
    indices: str = "indices",
    values: str = "values",
) -> WideComponents:
    """The first ``k`` principal components of sparse rows over ``width`` columns.

    Rows hold ``indices`` (from 0) and their ``values``; an index that a row lists twice
    counts with both values.  The seeded start matrix has ``k + extra`` columns;
    each of the ``rounds`` brings it closer to the components, by the square of the ratio of a
    component's variance to that of the first one left out.  Rows are read ``rounds + 1`` times:
    pass a stored table.

    Through the driver go one number a column, and ``width * (k + extra)`` numbers a
    round, of which ``MOST_CELLS`` are allowed.  Where the rows span fewer directions, only
    these are given.
    """
    wanted = min(k + extra, width)
    if width * wanted > MOST_CELLS:
        raise ValueError(f"{width} columns times {wanted} are more than {MOST_CELLS} numbers")
    rows = rows.select(
        F.col(indices).cast("array<int>").alias("indices"),
        F.col(values).cast("array<double>").alias("values"),
    )
    count, mean = _mean(rows, width)
    narrow = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, wanted)))[0]
    back = np.zeros((width, 0))
    variances = np.zeros(0)
    for step in range(1, max(rounds, _LONGEST) + 1):
        triangle, product = _pass(rows, mean, narrow)
        _, scale, turned = np.linalg.svd(triangle)
        kept = scale > (scale[0] if len(scale) else 0) * 1e-12
        # The products times this are orthonormal, so this is A' times an orthonormal basis.
        back = product @ (turned[kept].T / scale[kept])
        if not kept.any():
            break
        narrow, upper = np.linalg.qr(back)
        before, variances = variances, np.linalg.svd(upper, compute_uv=False)[:k] ** 2
        still = len(before) == len(variances) and np.allclose(
            before, variances, rtol=0, atol=_STILL * variances.max(initial=0)
        )
        if step >= rounds and still:
            break
    left, lengths, _ = np.linalg.svd(back, full_matrices=False)
    kept = lengths[:k] > (lengths[0] if len(lengths) else 0) * 1e-9
    loadings = left[:, :k][:, kept]
    if loadings.shape[1]:
        largest = loadings[np.abs(loadings).argmax(axis=0), np.arange(loadings.shape[1])]
        loadings = loadings * np.where(largest < 0, -1.0, 1.0)
    return WideComponents(count, mean, loadings, lengths[:k][kept] ** 2 / max(count - 1, 1))
