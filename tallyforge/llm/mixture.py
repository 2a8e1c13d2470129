"""A mixture of sources at target shares of tokens, in training order.

Sizes are tokens of a public tokenizer. The total is the largest at which every
source that has documents meets its share without using any of them more than
max_repeats times, or a given one: then sources that reach their cap leave what
they lack to the others in proportion to their targets. Shares of sources without
documents are left to the others alike.

The mixture is a curriculum: a source's weight may change with the time t from 0
to 1 by a schedule of knots, between which it is linear; knots are scaled so that
the integral over all time is the source's share. A document's place follows by
inversion: it comes at the t by which its source's cumulative demand reaches the
tokens before it. The mixture is range-sorted by t.

Documents of a source are taken in the order of a hash, whole rounds first, then
a part of a last one. Cumulative tokens are sums over hash buckets and within a
bucket, so no task sees a whole source. Sources are compared in lower case,
trimmed, with `-` as `_`; documents of other or no sources, and those without
tokens, take no part. Equal hashes are ordered by id; repeated rows are documents
of their own. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyforge.llm import bpe
from tallyforge.session import stored

#: Documents of a source that a task sums over, about.
BUCKET_ROWS = 20_000

#: Uses of documents in a partition of the sorted mixture, about.
PART_ROWS = 50_000

Knots = Sequence[tuple[float, float]]
#: Weights by time unless a schedule is given: level throughout.
LEVEL: Knots = ((0.0, 1.0), (1.0, 1.0))


def source_key(source: Column) -> Column:
    return F.replace(F.lower(F.trim(source)), F.lit("-"), F.lit("_"))


@dataclass(frozen=True)
class Plan:
    """What a source contributes: its tokens once, its demand and whole rounds."""

    source: str
    target_share: float
    max_repeats: int
    size: int
    demand: float


def plan(targets: Sequence[tuple[str, float, int]], sizes: Mapping[str, int], total: float | None = None) -> list[Plan]:
    """The demand of each source in tokens; targets: source, share, max repeats."""
    able = [(s, w, r) for s, w, r in targets if sizes.get(s, 0) > 0 and w > 0 and r > 0]
    if total is None:
        whole = sum(w for _, w, _ in able)
        total = min((sizes[s] * r * whole / w for s, w, r in able), default=0.0)
    demand = {s: 0.0 for s, _, _ in targets}
    open_, left = able, float(total)
    while open_ and left > 1e-9:
        whole = sum(w for _, w, _ in open_)
        full = [(s, w, r) for s, w, r in open_ if left * w / whole >= sizes[s] * r]
        if not full:
            for s, w, _ in open_:
                demand[s] = left * w / whole
            break
        for s, _, r in full:
            demand[s] = float(sizes[s] * r)
            left -= demand[s]
        open_ = [x for x in open_ if x not in full]
    return [Plan(s, w, r, sizes.get(s, 0), demand[s]) for s, w, r in targets]


def segments(knots: Knots) -> list[tuple[float, float, float, float, float]]:
    """(t0, t1, w0, w1, area before) of a schedule scaled to an area of 1."""
    points = sorted(knots)
    if points[0][0] > 0:
        points = [(0.0, points[0][1]), *points]
    if points[-1][0] < 1:
        points = [*points, (1.0, points[-1][1])]
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))
    if area <= 0 or any(w < 0 for _, w in points):
        raise ValueError("a schedule needs weights of at least 0, some above")
    out, before = [], 0.0
    for a, b in zip(points, points[1:]):
        if b[0] > a[0]:
            out.append((a[0], b[0], a[1] / area, b[1] / area, before))
            before += (b[0] - a[0]) * (a[1] + b[1]) / 2 / area
    return out


def when_reached(share: Column, segs: Column) -> Column:
    """The time by which a schedule's area reaches `share` of the whole: in the
    last segment that begins at or below it, the root of a quadratic."""
    at = F.element_at(F.filter(segs, lambda x: x["area"] <= share), -1)
    slope = (at["w1"] - at["w0"]) / (at["t1"] - at["t0"])
    rest = share - at["area"]
    root = F.sqrt(F.greatest(at["w0"] * at["w0"] + 2 * slope * rest, F.lit(0.0)))
    step = 2 * rest / (at["w0"] + root)  # the form of the solution that holds for slope 0 too
    return F.least(at["t0"] + F.coalesce(F.when(rest > 0, step), F.lit(0.0)), at["t1"])


def sized(documents: DataFrame, targets: DataFrame, row: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(row, source, tokens) of the documents of listed sources that have tokens."""
    names = [r[0] for r in targets.select(source_key(F.col("source"))).distinct().collect()]  # one row a source
    known = documents.select(F.col(row).alias("row"), source_key(F.col(source)).alias("source"), F.col(text).alias("text")).filter(F.col("source").isin([n for n in names if n]))
    return bpe.counted(known, "text", keep=("row", "source")).filter("tokens > 0")


def mixture(documents: DataFrame, targets: DataFrame, row: str = "doc_id", total: float | None = None, schedule: Mapping[str, Knots] | None = None, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(places, shares).

    places: position (0 to 1), row, source, round, tokens: one row for each use of
    a document, sorted by position. shares: source, target_share, max_repeats,
    available_tokens, documents_used, tokens, actual_share of every listed source."""
    spark = documents.sparkSession
    docs = sized(documents, targets, row).withColumn("h", F.xxhash64("row", F.lit(seed)))
    docs = stored(docs, "mixture-sizes")
    totals = {r["source"]: (r["size"], r["n"]) for r in docs.groupBy("source").agg(F.sum("tokens").alias("size"), F.count(F.lit(1)).alias("n")).collect()}  # one row a source
    listed = [(r["s"], float(r["w"] or 0), int(r["m"] or 0)) for r in targets.groupBy(source_key(F.col("source")).alias("s")).agg(F.sum("target_share").alias("w"), F.max("max_repeats").alias("m")).filter("s <> ''").orderBy("s").collect()]
    plans = plan(listed, {s: v[0] for s, v in totals.items()}, total)
    rows = []
    for p in plans:
        buckets = max(1, -(-totals.get(p.source, (0, 0))[1] // BUCKET_ROWS))
        rows.append((p.source, p.target_share, p.max_repeats, p.size, p.demand, buckets, [dict(zip(("t0", "t1", "w0", "w1", "area"), s)) for s in segments((schedule or {}).get(p.source, LEVEL))]))
    info = spark.createDataFrame(rows, "source string, target_share double, max_repeats int, size bigint, demand double, buckets int, segs array<struct<t0:double,t1:double,w0:double,w1:double,area:double>>")
    docs = docs.join(F.broadcast(info.filter("demand > 0")), "source")  # one row a source
    docs = docs.withColumn("b", F.least(F.floor((F.col("h").cast("double") / 2.0**64 + 0.5) * F.col("buckets")), F.col("buckets") - 1).cast("int"))
    sums = docs.groupBy("source", "b").agg(F.sum("tokens").alias("in_bucket"))
    before = F.sum("in_bucket").over(Window.partitionBy("source").orderBy("b").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select("source", "b", F.coalesce(before, F.lit(0)).alias("before_bucket"))  # as many rows as buckets
    inside = F.sum("tokens").over(Window.partitionBy("source", "b").orderBy("h", "row").rowsBetween(Window.unboundedPreceding, -1))
    docs = docs.withColumn("inside", F.coalesce(inside, F.lit(0))).join(sums, ["source", "b"])
    docs = docs.withColumn("start", F.col("before_bucket") + F.col("inside"))
    uses = docs.withColumn("round", F.explode(F.sequence(F.lit(0), F.col("max_repeats") - 1)))
    uses = uses.withColumn("start", F.col("start") + F.col("round") * F.col("size"))
    # A use belongs to the mixture if more than half of it is within the demand.
    uses = uses.filter(F.col("start") + F.col("tokens") / 2 <= F.col("demand"))
    uses = uses.withColumn("position", when_reached(F.least(F.col("start") / F.col("demand"), F.lit(1.0)), F.col("segs")))
    places = stored(uses.select("position", F.col("row").alias(row), "source", "round", "tokens"), "mixture-places")
    used = places.groupBy("source").agg(F.count(F.lit(1)).alias("documents_used"), F.sum("tokens").alias("tokens"))
    all_tokens = used.agg(F.sum("tokens").alias("all_tokens"))
    shares = info.select("source", "target_share", "max_repeats", F.col("size").alias("available_tokens")).join(used, "source", "left").join(F.broadcast(all_tokens), F.lit(True), "left")
    shares = shares.fillna(0, ["documents_used", "tokens"])
    shares = shares.withColumn("actual_share", F.coalesce(F.col("tokens") / F.col("all_tokens"), F.lit(0.0))).drop("all_tokens")
    parts = max(1, -(-places.count() // PART_ROWS))  # of rows, not of cores, so that a task's share does not grow
    return places.repartitionByRange(parts, "position", row, "round").sortWithinPartitions("position", row, "round"), shares
