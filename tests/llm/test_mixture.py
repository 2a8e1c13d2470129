import pytest
from pyspark.sql import functions as F

from tallyforge.llm import mixture as M


def test_plan_meets_targets_or_caps():
    targets = [("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.2, 4), ("none", 0.0, 3)]
    plans = {p.source: p.demand for p in M.plan(targets, {"a": 1000, "b": 1000, "c": 100})}
    assert plans == {"a": 1000.0, "b": 600.0, "c": 400.0, "none": 0.0}
    capped = {p.source: p.demand for p in M.plan(targets, {"a": 1000, "b": 1000, "c": 100}, total=3000)}
    assert capped == {"a": 1000.0, "b": 1600.0, "c": 400.0, "none": 0.0}
    assert sum(p.demand for p in M.plan(targets, {"a": 10}, total=1e9)) == 10
    assert M.plan(targets, {})[0].demand == 0.0


@pytest.mark.parametrize("knots", [M.LEVEL, ((0.0, 0.0), (1.0, 2.0)), ((0.0, 2.0), (1.0, 0.0)), ((0.2, 1.0), (0.5, 3.0), (0.6, 0.0), (0.9, 1.0))])
def test_schedules_invert(spark, knots):
    segs = M.segments(knots)
    area = lambda t: sum(max(0.0, min(t, t1) - t0) * (w0 + (w0 + (w1 - w0) * (min(t, t1) - t0) / (t1 - t0))) / 2 for t0, t1, w0, w1, _ in segs if t > t0)
    assert abs(area(1.0) - 1) < 1e-9
    rows = [(i / 50, [dict(zip(("t0", "t1", "w0", "w1", "area"), s)) for s in segs]) for i in range(51)]
    df = spark.createDataFrame(rows, "share double, segs array<struct<t0:double,t1:double,w0:double,w1:double,area:double>>")
    for r in df.select("share", M.when_reached(F.col("share"), F.col("segs")).alias("t")).collect():
        assert abs(area(r.t) - r.share) < 1e-6


def documents(spark, n=3000):
    text = F.concat(F.lit("word "), F.col("id").cast("string"))
    source = F.when(F.col("id") % 3 > 0, "Big-One").when(F.col("id") % 30 == 0, " small_one ").when(F.col("id") % 3 == 0, F.when(F.col("id") % 2 == 0, "mid").otherwise("unlisted"))
    return spark.range(n).select(F.col("id").alias("doc_id"), text.alias("text"), source.alias("source"), F.lit(1).alias("tokens"), F.lit("x").alias("position"))


def test_mixture(spark, monkeypatch):
    monkeypatch.setattr(M, "BUCKET_ROWS", 100)
    targets = spark.createDataFrame([("big_one", 0.6, 1), ("mid", 0.2, 2), ("small_one", 0.15, 4), ("absent", 0.05, 9)], "source string, target_share double, max_repeats int")
    df = documents(spark).union(spark.createDataFrame([(-1, None, "mid", 1, "x"), (-2, "", "mid", 1, "x"), (-3, "a b", None, 1, "x")], "doc_id long, text string, source string, tokens int, position string"))
    places, shares = M.mixture(df, targets, schedule={"mid": ((0.0, 0.0), (1.0, 2.0))})
    rows = places.collect()
    assert [r.position for r in rows] == sorted(r.position for r in rows) and all(0 <= r.position <= 1 for r in rows)
    got = {r.source: r for r in shares.collect()}
    assert set(got) == {"big_one", "mid", "small_one", "absent"} and got["absent"].tokens == 0
    for s, w in (("big_one", 0.6), ("mid", 0.2), ("small_one", 0.15)):
        assert abs(got[s].actual_share - w / 0.95) < 0.01, s
    uses = {}
    for r in rows:
        uses.setdefault((r.source, r.doc_id), []).append(r.round)
    for (s, _), rounds in uses.items():
        assert sorted(rounds) == list(range(len(rounds))) and len(rounds) <= got[s].max_repeats
    mid = [r.position for r in rows if r.source == "mid"]
    assert sum(p > 0.5 for p in mid) > 2 * sum(p <= 0.5 for p in mid)
    again, _ = M.mixture(df.repartition(7), targets, schedule={"mid": ((0.0, 0.0), (1.0, 2.0))})
    assert sorted(map(repr, again.collect())) == sorted(map(repr, rows))


def test_empty(spark):
    targets = spark.createDataFrame([("big_one", 0.6, 1)], "source string, target_share double, max_repeats int")
    places, shares = M.mixture(documents(spark).limit(0), targets)
    assert places.count() == 0 and shares.first().actual_share == 0.0
    with pytest.raises(ValueError):
        M.segments(((0.0, 0.0), (1.0, 0.0)))
