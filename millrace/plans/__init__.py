"""The registered queries over the test tables, and their SQL counterparts."""

from . import events, splits, files, text, classification, datasets, vectors, images  # noqa: I001
from . import regression, streams
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
