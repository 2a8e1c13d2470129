import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyforge.operators import aggregate as A
from tallyforge.operators import latest as L
from tallyforge.operators import matching as M


def test_latest_and_ties(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("a", 2, 3), (None, 5, 4), (None, 5, 5)], "k string, v int, id int")
    one = {r.id for r in L.keep_latest(df, ["k"], [F.col("v").desc(), F.col("id")]).collect()}
    ties = {r.id for r in L.keep_top_rank(df, ["k"], [F.col("v").desc()]).collect()}
    assert one == {2, 4} and ties == {2, 3, 4, 5} and one <= ties
    again = L.keep_latest(L.keep_latest(df, ["k"], [F.col("v").desc(), F.col("id")]), ["k"], [F.col("v").desc(), F.col("id")])
    assert {r.id for r in again.collect()} == one
    flags = {r.id: r.is_latest for r in L.flag_latest(df, ["k"], [F.col("v").desc(), F.col("id")]).collect()}
    assert {k for k, v in flags.items() if v} == one and len(flags) == 5
    assert L.keep_latest(df.limit(0), ["k"], [F.col("v")]).count() == 0


def test_modal(spark):
    df = spark.createDataFrame([("a", "x", None), ("a", "y", 1), ("a", "y", 1), ("b", "z", None), ("b", "q", 2)], "k string, v string, w int")
    assert {tuple(r) for r in L.modal(df, ["k"], ["v", "w"]).collect()} == {("a", "y", 1), ("b", "q", 2)}


def test_continuity(spark):
    df = spark.createDataFrame([("a", 1, 0.0, 10.0), ("a", 2, 10.01, 20.0), ("a", 3, 20.02, 5.0), ("a", 4, None, 5.0), ("b", 1, 9.0, 1.0)], "k string, t int, s double, e double")
    out = L.continuity_failures(df, ["k"], [F.col("t")], "s", "e", ["t"]).collect()
    assert [(r.k, r.t, r.previous_t, round(r.discrepancy, 2)) for r in out] == [("a", 3, 2, 0.02)]


def test_tolerance_anti_join(spark):
    d = dt.date
    left = spark.createDataFrame([(1, "n", 100.0, d(2024, 3, 1)), (2, "n", 100.03, d(2024, 3, 1)), (3, "n", 200.0, None), (4, None, 100.0, d(2024, 3, 1)), (5, "m", 50.0, d(2024, 3, 1)), (6, "q", 50.0, d(2024, 3, 1))], "id int, k string, a double, d date")
    right = spark.createDataFrame([("n", 100.005, d(2024, 1, 31)), ("n", 200.0, d(1999, 1, 1)), ("m", 50.0, d(2024, 1, 30)), ("q", 50.0, d(2024, 4, 30))], "rk string, b double, e date")
    out = M.tolerance_anti_join(left, right, F.col("k") == F.col("rk"), ("a", "b"), ("d", "e"), (30, 60))
    assert {r.id for r in out.collect()} == {2, 4, 5}


def test_nearest_range_and_substring_lookup(spark):
    left = spark.createDataFrame([(1, "x", 2020), (2, "x", None), (3, "y", 2020)], "id int, k string, y int")
    right = spark.createDataFrame([("x", 2018, "c1"), ("x", 2021, "c2"), ("x", None, "c3")], "k string, ry int, code string")
    near = M.nearest_match(left, right, ["k"], "id", F.abs(F.col("y") - F.col("ry")), [F.col("code")])
    assert {r.id: r.code for r in near.collect()} == {1: "c2", 2: "c1"}
    v = spark.createDataFrame([(1, 5), (2, 50), (3, None)], "row int, v int")
    periods = spark.createDataFrame([(0, 10, "late", 2), (5, 9, "first", 1)], "lo int, hi int, name string, o int")
    assert {r.row: r.name for r in M.range_lookup(v, periods, "v", "lo", "hi", "o", ["name"]).collect()} == {1: "first", 2: None, 3: None}
    text = spark.createDataFrame([(1, "Old Town"), (2, "town"), (3, "zzz"), (4, None), (5, "")], "id int, t string")
    words = spark.createDataFrame([("old town hall", "B", 1), ("Town", "A", 2)], "w string, c string, o int")
    assert {r.id: r.c for r in M.contains_lookup(text, words, "t", "w", "o", "c", "id").collect()} == {1: "B", 2: "A", 3: None, 4: None, 5: None}


def test_aggregates(spark):
    df = spark.createDataFrame([("a", "r", 10.0), ("a", "d", 4.0), ("a", None, 1.0), (None, "r", None)], "k string, kind string, v double")
    totals = {r.k: (r.i, r.n) for r in A.conditional_totals(df, ["k"], "v", "kind", {"r": ("i", "n")}).collect()}
    assert totals == {"a": (10.0, 1), None: (None, 1)}
    hist = {r.bucket: r.row_count for r in A.histogram(df, "v", [4, 10]).collect()}
    assert hist == {"<4": 1, "4-10": 1, ">=10": 1}
    with pytest.raises(ValueError):
        A.sum_by(df, ["v"], "v", allowed=["k"])
    top = A.sum_by(df, ["k"], "v", filters={"kind": "R", "k": None}, top=5).collect()
    assert {r.k: r.total_amount for r in top} == {"a": 10.0, None: None}
    ranked = spark.createDataFrame([(i, v) for i, v in enumerate([9, 8, 8, 8, 1])], "id int, v int")
    assert {r.id for r in A.top_with_ties(ranked, [F.col("v")], 2).collect()} == {0, 1, 2, 3}
    assert A.top_with_ties(ranked.limit(0), [F.col("v")], 2).count() == 0
    ends = A.edges(df, F.col("kind") == "r", "k", "kind", [], "v")
    assert ends.count() == 4
    stats = A.summary(df, "v", "k").first()
    assert (stats.row_count, stats.median_amount, stats.distinct_keys) == (4, 4.0, 1)
    pivot = A.pivot_totals(df.filter("k = 'a'"), "k", "kind", "v", {"r": "tr", "d": "td", "x": "tx"}).first()
    assert (pivot.tr, pivot.td, pivot.tx) == (10.0, 4.0, None)
    assert [r.codes for r in A.code_arrays(df.filter("k = 'a'"), "k", "kind").collect()] == [["d", "r"]]


def test_top_rank_is_limited_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = L.keep_top_rank(df, ["k"], [F.col("id").desc()])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_range_lookup_gives_each_row_once_whatever_the_size_of_the_periods(spark, monkeypatch):
    v = spark.createDataFrame([(1, 5, "x"), (1, 5, "x"), (2, None, "x"), (3, 50, "x")], "row int, v int, c string")
    periods = spark.createDataFrame([(0, 9, 2, "second"), (1, 9, 1, "first"), (40, 60, 3, None)], "lo int, hi int, o int, name string")
    got = sorted(((r.row, r.name) for r in M.range_lookup(v, periods, "v", "lo", "hi", "o", ["name"]).collect()), key=str)
    assert got == [(1, "first"), (1, "first"), (2, None), (3, None)]
    monkeypatch.setattr(M, "fits", lambda df, limit=0: False)
    one = v.dropDuplicates(["row"])
    assert {(r.row, r.name) for r in M.range_lookup(one, periods, "v", "lo", "hi", "o", ["name"]).collect()} == {(1, "first"), (2, None), (3, None)}


def test_lookup_tables_are_measured_before_they_are_broadcast(spark):
    wide = spark.range(10).select(F.array_repeat("id", 100).alias("a"))
    assert M.fits(wide) and not M.fits(wide, 1000) and M.fits(wide.limit(0), 0)


def test_exact_median(spark):
    import statistics

    for values in ([], [None], [5.0], [1.0, 2.0], [3.0] * 50 + [9.0], [float(i * 7 % 101) for i in range(400)], [1.0, 1.0, 2.0, 2.0]):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        known = [v for v in values if v is not None]
        for ranges in (3, 1000):
            assert [r.median for r in A.exact_median(df, "v", ranges).collect()] == [statistics.median(known) if known else None]


def test_scratch_is_cleared_and_a_shared_folder_is_asked_for(spark):
    import types

    from tallyforge import session

    kept = session.stored(spark.range(3), "kept")
    path = session._written[-1]
    assert kept.count() == 3 and session.clear_scratch(spark) >= 1 and not session._written
    import os

    assert not os.path.exists(path.removeprefix("file:"))
    conf = types.SimpleNamespace(get=lambda *_: None)
    far = types.SimpleNamespace(sparkContext=types.SimpleNamespace(getConf=lambda: conf, getCheckpointDir=lambda: None, master="spark://host:7077"))
    with pytest.raises(RuntimeError):
        session.shared_dir(far)
