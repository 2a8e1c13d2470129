"""Joins the engine lacks: nearest match, tolerant anti-join, range and substring
lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.operators.latest import keep_latest

#: Bytes of a lookup table, as text, up to which it is broadcast.
BROADCAST_BYTES = 16 << 20


def fits(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether all values of df together, arrays included, are no longer as text than
    the limit, by measuring them."""
    return (df.agg(F.sum(F.length(F.to_json(F.struct("*"))).cast("long"))).first()[0] or 0) <= limit


def small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """df with a broadcast hint if it fits."""
    return F.broadcast(df) if fits(df, limit) else df


def nearest_match(left: DataFrame, right: DataFrame, on: Sequence[str], row: str, distance: Column, ties: Sequence[Column]) -> DataFrame:
    """Of all right rows equal in `on` the one at the least distance; null
    distances last. Left rows without any are left out."""
    joined = left.join(right, list(on))
    return keep_latest(joined, [row], [distance.asc_nulls_last(), *ties])


def tolerance_anti_join(left: DataFrame, right: DataFrame, key: Column, amount: tuple[str, str], date: tuple[str, str], days: tuple[int, int], tolerance: float = 0.01, extra: Column | None = None) -> DataFrame:
    """Left rows without a right row of the same key whose amount differs by at
    most the tolerance and whose date lies from days[0] before to days[1] after;
    a null date on either side passes. `key` must contain an equality, so the
    join hashes on it; the rest is a residual of the same join."""
    (a, b), (d, e) = amount, date
    close = F.abs(F.col(a) - F.col(b)) <= tolerance
    within = F.col(d).isNull() | F.col(e).isNull() | F.col(e).between(F.date_sub(F.col(d), days[0]), F.date_add(F.col(d), days[1]))
    on = key & close & within
    return left.join(right, on if extra is None else on & extra, "left_anti")


def range_lookup(left: DataFrame, periods: DataFrame, value: str, low: str, high: str, ordinal: str, take: Sequence[str], equal: Sequence[tuple[str, str]] = (), row: str = "row") -> DataFrame:
    """Left rows with `take` of the first period (by ordinal) that contains the
    value; null where none does. Each left row gives exactly one row, whatever
    overlaps. A calendar of periods that is small, by its measured size, goes to
    every row as one array, so the left side is not shuffled; a longer one is joined
    and the first hit taken by `row`, which must then be unique."""
    names = [low, high, ordinal, *take, *[b for _, b in equal]]
    entry = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate([ordinal, *names])])
    if fits(periods.select(*dict.fromkeys(names))):
        calendar = periods.agg(F.array_sort(F.collect_list(entry)).alias("__calendar"))
        at = {c: f"c{i + 1}" for i, c in enumerate(names)}

        def holds(x: Column) -> Column:
            on = F.col(value).between(x[at[low]], x[at[high]])
            for a, b in equal:
                on = on & (F.col(a) == x[at[b]])
            return on

        df = left.join(F.broadcast(calendar), F.lit(True)).withColumn("__hit", F.get(F.filter("__calendar", holds), F.lit(0)))
        return df.select(*[F.col(c) for c in left.columns], *[F.col("__hit")[at[c]].alias(c) for c in take])
    on = F.col(value).between(F.col(low), F.col(high))
    for a, b in equal:
        on = on & (F.col(a) == F.col(b))
    first = left.join(periods, on).groupBy(row).agg(*[F.min_by(c, ordinal).alias(c) for c in take])
    return left.join(first, row, "left")


def contains_lookup(left: DataFrame, words: DataFrame, text: str, word: str, ordinal: str, take: str, row: str) -> DataFrame:
    """`take` of the word equal to the text, else of the first (by ordinal) where
    either contains the other; null where none does. Distinct texts are looked up
    once and joined back."""
    texts = left.select(F.lower(F.trim(text)).alias("__t")).filter("__t <> ''").distinct()
    table = small(words.select(F.lower(F.trim(word)).alias("__w"), F.col(ordinal).alias("__o"), F.col(take).alias("__v")))
    hit = texts.join(table, F.col("__t").contains(F.col("__w")) | F.col("__w").contains(F.col("__t")))
    best = hit.groupBy("__t").agg(F.min_by("__v", F.struct((F.col("__t") != F.col("__w")).alias("x"), "__o")).alias(take))
    return left.join(best, F.lower(F.trim(F.col(text))) == F.col("__t"), "left").drop("__t")
