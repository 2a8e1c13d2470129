"""Aggregations with parameters: conditional totals, edges, sums by any column,
histograms, tops with ties, and predicates built from data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def conditional_totals(df: DataFrame, keys: Sequence[str], amount: str, kind: str, names: Mapping[str, tuple[str, str]]) -> DataFrame:
    """For each kind its sum and count: names maps a kind to the two output names."""
    aggs = []
    for value, (total, count) in names.items():
        hit = F.coalesce(F.col(kind) == value, F.lit(False))
        aggs += [F.sum(F.when(hit, F.col(amount)).otherwise(0.0)).alias(total), F.count_if(hit).cast("long").alias(count)]
    return df.groupBy(*keys).agg(*aggs)


def edges(df: DataFrame, forward: Column, source: str, target: str, keys: Sequence[str], amount: str) -> DataFrame:
    """Directed edges with summed weight; where `forward` does not hold the ends swap."""
    ahead = F.coalesce(forward, F.lit(False))
    ends = df.withColumn("source_name", F.when(ahead, F.col(source)).otherwise(F.col(target))).withColumn("target_name", F.when(ahead, F.col(target)).otherwise(F.col(source)))
    return ends.groupBy("source_name", "target_name", *keys).agg(F.sum(amount).alias("total_amount"), F.count(F.lit(1)).alias("transaction_count"))


def matches(filters: Mapping[str, Any]) -> Column:
    """A predicate: a string is contained, a list holds the value, another value is
    equal, and None asks nothing."""
    out = F.lit(True)
    for c, v in filters.items():
        if isinstance(v, str):
            out = out & F.upper(F.col(c)).contains(v.upper())
        elif isinstance(v, list | tuple | set):
            out = out & F.col(c).isin(*v)
        elif v is not None:
            out = out & (F.col(c) == v)
    return out


def sum_by(df: DataFrame, keys: Sequence[str], amount: str, date: str | None = None, filters: Mapping[str, Any] | None = None, allowed: Sequence[str] | None = None, top: int | None = None, distinct: Mapping[str, str] | None = None) -> DataFrame:
    """Sum, count, mean, least and greatest amount and first and last date by any of
    the allowed columns, null keys included. distinct: output name to a column whose
    different values are counted."""
    wrong = [k for k in keys if k not in (allowed or df.columns)]
    if wrong:
        raise ValueError(f"not a grouping column: {', '.join(wrong)}")
    aggs = [F.sum(amount).alias("total_amount"), F.count(F.lit(1)).alias("row_count"), F.avg(amount).alias("mean_amount"), F.min(amount).alias("min_amount"), F.max(amount).alias("max_amount")]
    if date:
        aggs += [F.min(date).alias("first_date"), F.max(date).alias("last_date")]
    aggs += [F.count_distinct(c).alias(name) for name, c in (distinct or {}).items()]
    out = df.filter(matches(filters or {})).groupBy(*keys).agg(*aggs)
    return out if top is None else out.orderBy(F.col("total_amount").desc_nulls_last(), *keys).limit(top)


def histogram(df: DataFrame, value: str, edges_: Sequence[float], labels: Sequence[str] | None = None) -> DataFrame:
    """Counts by fixed edges: below the first, between, and from the last on."""
    labels = labels or [f"<{edges_[0]:g}", *[f"{a:g}-{b:g}" for a, b in zip(edges_, edges_[1:])], f">={edges_[-1]:g}"]
    bucket = F.lit(labels[-1])
    for edge, label in reversed(list(zip(edges_, labels))):
        bucket = F.when(F.col(value) < edge, label).otherwise(bucket)
    return df.filter(F.col(value).isNotNull()).groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("row_count"), F.sum(value).alias("total_amount"))


def top_with_ties(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """Rows of rank up to n over the whole table, ties at the last place included.
    The n-th row's order is found first by a top-n, so no task sorts all rows."""
    keys = [c.alias(f"k{i}") for i, c in enumerate(order)]
    keyed = df.withColumn("__k", F.struct(*keys))
    last = keyed.select("__k").orderBy(F.col("__k").desc()).limit(n).agg(F.min("__k").alias("__last"))
    return keyed.join(F.broadcast(last), F.col("__k") >= F.col("__last")).drop("__k", "__last")


#: Ranges of values an exact median is looked for in.
RANGES = 1000


def exact_median(df: DataFrame, value: str, ranges: int = RANGES) -> DataFrame:
    """One row (median): the mean of the middle values, null without any. Rows are
    counted by value and values by range; only the range or two that hold the middle,
    about a thousandth of the different values each, are put in order."""
    counts = df.select(F.col(value).cast("double").alias("v")).filter("v IS NOT NULL").groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    edges_ = sorted(set(counts.approxQuantile("v", [i / ranges for i in range(1, ranges)], 0.5 / ranges)))
    at = F.lit(0) if not edges_ else F.size(F.filter(F.array(*[F.lit(e) for e in edges_]), lambda e: e < F.col("v")))
    counts = counts.withColumn("r", at)
    sums = counts.groupBy("r").agg(F.sum("n").alias("k")).orderBy("r").collect()  # a row a range
    total, before, want = sum(r["k"] for r in sums), 0, []
    for r in sums:
        want += [(r["r"], p - before) for p in {(total - 1) // 2, total // 2} if before <= p < before + r["k"]]
        before += r["k"]
    if not want:
        return df.sparkSession.createDataFrame([(None,)], "median double")
    w = Window.partitionBy("r").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    inside = counts.filter(F.col("r").isin([r for r, _ in want])).withColumn("upto", F.sum("n").over(w))
    hit = reduce(or_, [(F.col("r") == r) & (F.col("upto") > p) & (F.col("upto") - F.col("n") <= p) for r, p in want])
    return inside.filter(hit).agg(F.avg("v").alias("median"))


def summary(df: DataFrame, value: str, distinct: str) -> DataFrame:
    """Rows, sum, mean, exact median, greatest and least value and distinct keys."""
    every = df.agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(value).alias("total_amount"), F.avg(value).alias("mean_amount"),
        F.min(value).alias("min_amount"), F.max(value).alias("max_amount"), F.count_distinct(distinct).alias("distinct_keys"), F.count_if(F.col(value) < 0).cast("long").alias("negatives"),
    )
    return every.join(F.broadcast(exact_median(df, value).withColumnRenamed("median", "median_amount")), F.lit(True), "left")  # one row each


def code_arrays(df: DataFrame, key: str, value: str) -> DataFrame:
    """The sorted distinct non-null values of each key."""
    return df.groupBy(key).agg(F.array_sort(F.collect_set(value)).alias("codes"))


def pivot_totals(df: DataFrame, key: str, kind: str, amount: str, kinds: Mapping[str, str]) -> DataFrame:
    """One column of sums per kind, in one pass; kinds maps values to column names."""
    return df.groupBy(key).agg(*[F.sum(F.when(F.col(kind) == k, F.col(amount))).alias(n) for k, n in kinds.items()])


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str], amount: str, out: str = "running_total") -> DataFrame:
    return df.withColumn(out, F.sum(amount).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
