"""All similar pairs through blocks of the inverted index, each pair added up in one place.

A feature's ids are filed in blocks of ids of like remaining length.  A block meets an id only
if what both have left from this feature on can matter, so frequent features, whose place
is at the end of every vector, meet almost nothing.  What meets travels as arrays and is added up
pair by pair in the task of the id, where a pair ends as soon as it cannot reach the
threshold.  Bounds after Anastasiu and Karypis (L2AP, 2014).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import stored
from .meeting import BLOCK, completed, index_rows, may_reach, placed, shipped
from .similarity import SimilarPairs, _groups, _numbered, _ranked, _signatures, copies_of

#: Products of what two vectors have left are looked at down to this share of the threshold.
KEEP = 0.25


def blocked_pairs(vectors: DataFrame, threshold: float, min_common: int = 1) -> SimilarPairs:
    """The same pairs as ``similarity.similar_pairs``, exactly; meant for low thresholds.

    Features are ranked from rare to frequent.  Where two vectors meet first, at their rarest
    common feature, the product of the shares of their lengths from there on bounds
    their cosine, so a pair opens only if it reaches the threshold.  Further common features are
    added up while this product is above ``KEEP`` of the threshold; a pair is left out once sum and
    bound stay below it, or too few features remain for ``min_common``.  The pairs that are
    left get the rest by a join.

    An id is met block by block, so an id or a feature with very many rows is spread over as many
    tasks as there are blocks of ids.  ``vectors`` is read several times; pass a stored table.
    """
    vectors = vectors.filter(F.col("weight") != 0).select("id", "feature", "weight")
    groups = placed(_groups(_signatures(vectors)))
    ranked = _ranked(vectors, groups, stored(_numbered(vectors), "features"))
    least = (KEEP * threshold) ** 2
    rows = stored(index_rows(ranked, min_common, least), "index")
    lists = _shipped(rows, least)
    found = stored(may_reach(rows, threshold, min_common, KEEP, lists), "open")
    pairs = completed(found, rows, groups).filter(
        (F.col("cosine") >= threshold) & (F.col("common") >= min_common)
    )
    return SimilarPairs(pairs, copies_of(vectors))


def _shipped(rows: DataFrame, least: float) -> DataFrame:
    return shipped(rows, least, BLOCK)
