"""Text lines to typed rows, with a reason for every line that does not fit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parsing import field, fields, number, numbers

TOO_FEW_FIELDS = "too few fields"
BAD_PRICE = "bad price"
BAD_LABEL = "bad label"
BAD_FEATURE = "bad feature"
WRONG_LENGTH = "wrong length"


def parse_purchases(lines: DataFrame, mode: str = "quarantine") -> DataFrame:
    """``user,product,price`` lines as columns, plus ``problem``.

    Extra fields are ignored and text fields are not trimmed.  ``problem`` is
    null for a good line; ``mode="failfast"`` fails the job on a bad one.  All
    other columns of the input, ``value`` included, are kept.
    """
    part = fields(F.col("value"), ",")
    price = number(field(part, 2))
    problem = F.when(F.size(part) < 3, TOO_FEW_FIELDS).when(price.isNull(), BAD_PRICE)
    return lines.select(
        "*",
        field(part, 0).alias("user"),
        field(part, 1).alias("product"),
        price.alias("price"),
        _checked(problem, mode).alias("problem"),
    )


def parse_points(lines: DataFrame, width: int, mode: str = "quarantine") -> DataFrame:
    """``label<TAB>f1,f2,...`` lines as ``label, features``, plus ``problem``."""
    part = fields(F.col("value"), "\t")
    label = number(field(part, 0))
    split = lines.select(
        "*",
        F.size(part).alias("_parts"),
        label.alias("label"),
        numbers(field(part, 1), ",").alias("features"),
    )
    features = F.col("features")
    problem = (
        F.when(F.col("_parts") < 2, TOO_FEW_FIELDS)
        .when(F.col("label").isNull(), BAD_LABEL)
        .when(F.size(features) != width, WRONG_LENGTH)
        .when(F.exists(features, lambda x: x.isNull()), BAD_FEATURE)
    )
    return split.withColumn("problem", _checked(problem, mode)).drop("_parts")


def _checked(problem: Column, mode: str) -> Column:
    if mode == "quarantine":
        return problem
    if mode == "failfast":
        message = F.concat(problem, F.lit(": "), F.col("value"))
        return F.when(problem.isNotNull(), F.raise_error(message).cast("string"))
    raise ValueError(f"mode must be 'quarantine' or 'failfast', not {mode!r}")


def accepted(parsed: DataFrame) -> DataFrame:
    """The good rows, without the raw text."""
    return parsed.filter(F.col("problem").isNull()).drop("value", "problem")


def quarantined(parsed: DataFrame) -> DataFrame:
    """The raw text of the bad rows and what is wrong with them."""
    return parsed.filter(F.col("problem").isNotNull()).select("value", "problem")


def by_user(purchases: DataFrame) -> DataFrame:
    """Purchases keyed by user: ``user, item struct<product, price>``."""
    return purchases.select("user", F.struct("product", "price").alias("item"))
