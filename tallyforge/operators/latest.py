"""Latest, ranked and most frequent rows of a group.

Row numbers always have a total order: callers give tie-breakers. Filters on
rank 1 become partial and final group limits, so a hot group is cut down before
the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _cols(keys: Sequence[str | Column]) -> list[Column]:
    return [F.col(k) if isinstance(k, str) else k for k in keys]


def keep_latest(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first n rows of each group in a total order."""
    w = Window.partitionBy(*_cols(keys)).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn")


def keep_top_rank(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column], n: int = 1) -> DataFrame:
    """Rows of rank up to n: all ties stay."""
    w = Window.partitionBy(*_cols(keys)).orderBy(*order)
    return df.withColumn("__rk", F.rank().over(w)).filter(F.col("__rk") <= n).drop("__rk")


def flag_latest(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column], flag: str = "is_latest") -> DataFrame:
    """All rows, the first of each group marked."""
    w = Window.partitionBy(*_cols(keys)).orderBy(*order)
    return df.withColumn(flag, F.row_number().over(w) == 1)


def modal(df: DataFrame, keys: Sequence[str], attributes: Sequence[str]) -> DataFrame:
    """The most frequent combination of attributes of each key; of equal counts
    the first by value, nulls last. Counting combines before the shuffle, and the
    winner is taken by an aggregate, not a sort."""
    counts = df.groupBy(*keys, *attributes).agg(F.count(F.lit(1)).alias("__n"))
    order = F.struct((-F.col("__n")).alias("n"), *[x for i, a in enumerate(attributes) for x in (F.col(a).isNull().alias(f"m{i}"), F.col(a).alias(f"v{i}"))])
    best = counts.groupBy(*keys).agg(F.min_by(F.struct(*attributes), order).alias("__best"))
    return best.select(*keys, "__best.*")


def continuity_failures(df: DataFrame, keys: Sequence[str], order: Sequence[Column], start: str, end: str, carry: Sequence[str] = (), tolerance: float = 0.01) -> DataFrame:
    """Rows whose opening value differs from the closing value of the row before
    them, with that row's `carry` columns as previous_*. One window serves all."""
    w = Window.partitionBy(*keys).orderBy(*order)
    df = df.filter(F.col(start).isNotNull() & F.col(end).isNotNull())
    for c in (end, *carry):
        df = df.withColumn(f"previous_{c}", F.lag(c).over(w))
    df = df.withColumn("sequence", F.row_number().over(w)).withColumn("discrepancy", F.col(start) - F.col(f"previous_{end}"))
    return df.filter((F.col("sequence") > 1) & (F.abs("discrepancy") > tolerance))
