"""Probabilistic record linkage: comparison levels, weights by expectation-
maximisation, forests of links and pairs of the linked rows.

Only counts of comparison patterns, of which there are at most the product of
the level numbers, reach the driver. Links and clusters stay distributed."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.session import cut

#: Level of a comparison in which a value is missing on either side.
MISSING = -1


#: How rarely, of all matches, a field contradicts (level 0): fixed, as without it the
#: look-alikes that one field tells apart count as matches with a slip.
CONTRADICTS = 1e-5


def em_weights(patterns: Mapping[tuple[int, ...], int], random: Sequence[Mapping[int, float]], rounds: int = 500, start_match: float = 0.8, tolerance: float = 1e-9, contradicts: float = CONTRADICTS) -> tuple[list[dict[int, float]], float]:
    """(log2 likelihood ratio of each level of each field, share of matches).

    patterns: how many blocked pairs show each tuple of levels. random: for each
    field the probability of each level for two records drawn at random, by value
    frequencies; the estimate starts from it. Other pairs of a block agree far more often
    than random ones, so what they show is estimated too: how often a field contradicts
    (level 0; of matches this is given). How often a value is missing and how the degrees
    of agreement are spread are levels of their own with one estimate for both classes:
    free ones were tried, and split the pairs by what is missing instead of by location.
    The share of matches is not settled by the pairs of blocks that hardly contradict, so
    it is no part of the weights. Levels are smoothed by half a pair and stay finite."""

    def bounded(f: Mapping[int, float]) -> dict[int, float]:
        rest = sum(v for x, v in f.items() if x != 0) or 1.0
        return {x: contradicts if x == 0 else (1 - contradicts) * v / rest for x, v in f.items()}

    scaled = lambda f: {x: v / sum(f.values()) for x, v in f.items()}
    u = [scaled({x: max(v, 1e-6) for x, v in f.items()}) for f in random]
    # Before any evidence matches agree: the levels are given from the highest agreement on.
    m = [bounded({x: 0.6**i for i, x in enumerate(f)}) for f in u]
    p, total = start_match, sum(patterns.values())
    for _ in range(rounds if total else 0):
        alike, other = [{x: 0.5 for x in f} for f in u], [{x: 0.5 for x in f} for f in u]
        matched = 0.0
        for g, n in patterns.items():
            a, b = p, 1 - p
            for i, x in enumerate(g):
                a, b = a * m[i][x], b * u[i][x]
            share = n * a / (a + b) if a + b else 0.0
            matched += share
            for i, x in enumerate(g):
                alike[i][x] += share
                other[i][x] += n - share
        new = min(max(matched / total, 1e-6), 1 - 1e-6)
        m, u = [], []
        for f, g in zip(alike, other):
            both = {x: f[x] + g[x] for x in f if x != 0}
            m.append(bounded({x: both.get(x, 0.0) for x in f}))
            contradict = g[0] / sum(g.values())
            u.append({x: contradict if x == 0 else (1 - contradict) * both[x] / sum(both.values()) for x in g})
        done = abs(new - p) < tolerance
        p = new
        if done:
            break
    weights = [{x: math.log2(m[i][x] / u[i][x]) for x in f} for i, f in enumerate(u)]
    return weights, p


def value_rates(records: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """For each column the share of records that have a value (not empty), and
    the chance that two of these have the same. Without records 0 and 0."""
    each = [records.filter(F.col(c) != "").groupBy(F.col(c)).agg(F.count(F.lit(1)).cast("double").alias("n")).agg(F.lit(c).alias("c"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("nn")) for c in columns]
    each.append(records.agg(F.lit("").alias("c"), F.count(F.lit(1)).cast("double").alias("n"), F.lit(0.0).alias("nn")))
    union = each[0]
    for e in each[1:]:
        union = union.unionByName(e)
    got = {r["c"]: (r["n"] or 0.0, r["nn"] or 0.0) for r in union.collect()}  # one row a column
    total = got[""][0] or 1.0
    return {c: (got[c][0] / total, got[c][1] / got[c][0] ** 2 if got[c][0] else 0.0) for c in columns}


def learn(pairs: DataFrame, random: Mapping[str, Mapping[int, float]]) -> tuple[dict[str, dict[int, float]], dict[str, dict[int, float]]]:
    """(weights, bits) over all pairs: em_weights, and how much more often a level is
    seen than in records drawn at random, which ranks links. random: comparison column
    to its levels' chances."""
    counted = pairs.groupBy(*random).agg(F.count(F.lit(1)).alias("n")).collect()  # at most the product of the level numbers
    weights, _ = em_weights({tuple(r[f] for f in random): r["n"] for r in counted}, list(random.values()))
    bits = {}
    for f, chances in random.items():
        seen = {x: 0.5 + sum(r["n"] for r in counted if r[f] == x) for x in chances}
        bits[f] = {x: math.log2(v / sum(seen.values()) / max(chances[x], 1e-9)) for x, v in seen.items()}
        bits[f] = {x: min(v, 0.0) if x == MISSING else v for x, v in bits[f].items()}  # a missing part is no evidence
    return dict(zip(random, weights)), bits


def score(weights: Mapping[str, Mapping[int, float]]) -> Column:
    """The sum of the weights of a pair's levels."""
    total = F.lit(0.0)
    for f, by_level in weights.items():
        w = F.lit(0.0)
        for level, value in by_level.items():
            w = F.when(F.col(f) == level, F.lit(float(value))).otherwise(w)
        total = total + w
    return total


def roots(parents: DataFrame, limit: int = 40) -> DataFrame:
    """(node, root) for (node, parent) rows without cycles, by pointer jumping:
    each round halves the depth, is checkpointed and joins on the node alone.
    Nodes that are only parents are not listed: they are their own roots."""
    now = cut(parents.select("node", F.col("parent").alias("root")))
    for _ in range(limit):
        up = now.select(F.col("node").alias("root"), F.col("root").alias("upper"))
        step = cut(now.join(up, "root", "left").select("node", F.coalesce("upper", "root").alias("root"), F.col("upper").isNotNull().alias("moved")))
        now = step.drop("moved")
        if not step.filter("moved").limit(1).count():
            return now
    raise RuntimeError("parents do not form a forest of the depth allowed")


#: Rows of a cluster that one task pairs with as many others.
CHUNK = 2000


def row_pairs(members: DataFrame, cluster: str, row: str, chunk: int = CHUNK) -> DataFrame:
    """(id_a, id_b), id_a < id_b: all pairs of rows of a cluster, with the columns
    of `members` other than these dropped.

    A cluster of more than `chunk` rows is cut into blocks by a hash of the row,
    and each two blocks are paired apart, so no task holds a whole large cluster."""
    small = members.select(F.col(cluster).alias("c"), F.col(row).alias("r"))
    sizes = small.groupBy("c").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("c", F.ceil(F.col("n") / chunk).cast("int").alias("k"))
    small = small.join(sizes, "c").withColumn("b", F.when(F.col("k") > 1, F.pmod(F.xxhash64("r"), F.col("k"))).otherwise(0).cast("int"))
    others = F.transform(F.sequence(F.lit(0), F.col("k") - 1), lambda o: F.struct(F.least(F.col("b"), o).alias("lo"), F.greatest(F.col("b"), o).alias("hi")))
    spread = small.select("c", "r", "b", F.explode(others).alias("x")).select("c", "r", "b", "x.lo", "x.hi")
    a = spread.filter("b = lo").select("c", "lo", "hi", F.col("r").alias("ra"))
    b = spread.filter("b = hi").select("c", "lo", "hi", F.col("r").alias("rb"))
    joined = a.join(b, ["c", "lo", "hi"]).filter(F.when(F.col("lo") == F.col("hi"), F.col("ra") < F.col("rb")).otherwise(F.col("ra") != F.col("rb")))
    return joined.select(F.least("ra", "rb").alias("id_a"), F.greatest("ra", "rb").alias("id_b"))
