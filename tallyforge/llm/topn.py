"""The N best items of every group by merging sorted runs.

Each input partition is sorted by group and order in the JVM (which spills) and
becomes a run; while it is written, everything after the N-th distinct item of a
group is skipped, as nothing after it can be among the N best. Runs are stored in
the shared folder and read by bucket of groups. A task merges the runs of a bucket
with a loser tree, emits the first N items of a group and seeks every run to the
next group. Where there are more runs than FAN_IN, they are merged in
rounds, so a task never holds more than FAN_IN runs of a bucket, however many
partitions or items a group has: after the first pass a group has at most N items
in a run.

The order is total: score descending, then the tie columns ascending. Rows whose
group is null or blank, or whose score is null or NaN, do not take part. Of rows
with the same group and item only the first in this order does; a null item is an
item like any other and comes first among equals. Groups are compared as trimmed
upper-case text. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.session import stored

#: Runs of a bucket that one task merges.
FAN_IN = 64
#: Rows of a bucket, about: there are as many buckets of groups as the runs need.
BUCKET_ROWS = 200_000


class LoserTree:
    """A tournament over sources of keys in ascending order: `head` is the source
    with the least key, `next` replays the matches on its path to the root only.
    None is an exhausted source. Keys of different sources may be equal: the
    source with the smaller number wins."""

    def __init__(self, sources: Sequence[Callable[[], Any]]) -> None:
        self.sources = sources
        self.k = len(sources)
        self.keys = [s() for s in sources]
        self.losers = [-1] * max(self.k, 1)
        self.head = -1
        winners = [-1] * self.k + list(range(self.k))
        for node in range(self.k - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self.losers[node] = (a, b) if self._before(a, b) else (b, a)
        if self.k:
            self.head = winners[1] if self.k > 1 else 0

    def _before(self, a: int, b: int) -> bool:
        x, y = self.keys[a], self.keys[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return x < y or (x == y and a < b)

    def key(self) -> Any:
        return self.keys[self.head] if self.k else None

    def replay(self, source: int) -> None:
        """After the key of the winning source changed."""
        winner, node = source, (source + self.k) // 2
        while node >= 1:
            if self._before(self.losers[node], winner):
                winner, self.losers[node] = self.losers[node], winner
            node //= 2
        self.head = winner

    def next(self) -> None:
        self.keys[self.head] = self.sources[self.head]()
        self.replay(self.head)


class Run:
    """A sorted run in memory with a cursor that can seek to the next group."""

    def __init__(self, rows: list[tuple]) -> None:
        self.rows, self.at = rows, 0

    def take(self) -> tuple | None:
        if self.at >= len(self.rows):
            return None
        self.at += 1
        return self.rows[self.at - 1]

    def seek(self, group: str) -> tuple | None:
        """The first row of a group after `group`, by doubling steps and bisection."""
        low, step = self.at, 1
        rows = self.rows
        while low + step < len(rows) and rows[low + step][0] <= group:
            low, step = low + step, step * 2
        high = min(low + step, len(rows))
        while low < high:
            mid = (low + high) // 2
            if rows[mid][0] <= group:
                low = mid + 1
            else:
                high = mid
        self.at = low
        return self.take()


def merge_runs(runs: list[list[tuple]], n: int) -> Iterator[tuple]:
    """The first n rows with distinct items of each group. A row is (group, order,
    item, payload); runs ascend by group and order."""
    cursors = [Run(r) for r in runs]
    tree = LoserTree([c.take for c in cursors])
    group, items = None, set()
    while (row := tree.key()) is not None:
        if row[0] != group:
            group, items = row[0], set()
        if row[2] not in items:
            items.add(row[2])
            yield row
        if len(items) < n:
            tree.next()
            continue
        # Every run that stands in this group moves past it.
        while (key := tree.key()) is not None and key[0] == group:
            tree.keys[tree.head] = cursors[tree.head].seek(group)
            tree.replay(tree.head)


def _order(score: float, ties: Sequence[Any]) -> tuple:
    """Ascending key: the higher score first, then ties ascending with nulls first."""
    return (-score, *[(v is not None, v if v is not None else 0) for v in ties])


def _first_n(batches: Iterator, n: int, cols: dict[str, int]) -> Iterator:
    """Rows of a partition sorted by group and order, without those after the n-th
    distinct item of their group, whatever batch they are in."""
    import pyarrow as pa

    group, items = object(), set()
    for b in batches:
        keep = []
        groups, names = b.column(cols["g"]).to_pylist(), b.column(cols["item"]).to_pylist()
        for i, (g, name) in enumerate(zip(groups, names)):
            if g != group:
                group, items = g, set()
            if len(items) < n and name not in items:
                items.add(name)
                keep.append(i)
        if keep:
            yield b.take(pa.array(keep, pa.int64()))


def top_n(df: DataFrame, group: str, score: str, n: int, item: str, row: str, fan_in: int = FAN_IN, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(group, place, row): places 1 to n of each group by score descending, item
    ascending, row ascending; `row` is a unique number."""
    import pyarrow as pa

    if n < 1:
        raise ValueError("n must be at least 1")
    g = F.upper(F.trim(F.col(group).cast("string")))
    rows = df.select(g.alias("g"), F.col(score).cast("double").alias("score"), F.col(item).cast("string").alias("item"), F.col(row).cast("long").alias("row"))
    rows = rows.filter((F.col("g") != "") & F.col("score").isNotNull() & ~F.isnan("score"))
    rows = rows.select(F.spark_partition_id().alias("run"), "g", "score", "item", "row")
    cols = {c: i for i, c in enumerate(rows.columns)}
    order = ["g", F.col("score").desc(), F.col("item").asc_nulls_first(), "row"]
    runs = rows.sortWithinPartitions(*order).mapInArrow(lambda it: _first_n(it, n, cols), rows.schema)
    runs = stored(runs, "sorted-runs")

    merged_schema = T.StructType([*rows.schema.fields, T.StructField("place", T.LongType())])

    def merge(table: pa.Table) -> pa.Table:
        turn = table.column("turn")[0].as_py()
        by_run: dict[int, list[tuple]] = {}
        for r, gr, sc, it, ro in zip(*[table.column(c).to_pylist() for c in ("run", "g", "score", "item", "row")]):
            by_run.setdefault(r, []).append((gr, _order(sc, (it, ro)), it, (sc, ro)))
        for rows_of_run in by_run.values():  # one concatenated sort order; already sorted runs cost a single pass
            rows_of_run.sort(key=lambda x: x[:2])
        out: list[tuple] = []
        place, last = 0, None
        for gr, _, it, (sc, ro) in merge_runs([by_run[k] for k in sorted(by_run)], n):
            place, last = (place + 1 if gr == last else 1), gr
            out.append((turn, gr, sc, it, ro, place))
        return pa.table([list(c) for c in zip(*out)], schema=arrow)

    arrow = pa.schema([("run", pa.int32()), ("g", pa.string()), ("score", pa.float64()), ("item", pa.string()), ("row", pa.int64()), ("place", pa.int64())])
    while True:
        most, count = runs.agg(F.max("run"), F.count(F.lit(1))).first()
        buckets = max(1, -(-count // bucket_rows), min(runs.sparkSession.sparkContext.defaultParallelism, count // 1000))
        groups = runs.withColumn("turn", F.floor(F.col("run") / fan_in).cast("int")).withColumn("bucket", F.pmod(F.xxhash64("g"), F.lit(buckets)))
        merged = groups.groupBy("bucket", "turn").applyInArrow(merge, merged_schema)
        if (most or 0) < fan_in:
            return merged.select(F.col("g").alias(group), "place", F.col("row").alias(row))
        runs = stored(merged.drop("place"), "merged-runs")
