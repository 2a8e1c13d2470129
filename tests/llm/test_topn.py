import math
import random

import pytest
from pyspark.sql import functions as F

from tallyforge.llm import topn

SCHEMA = "committee_code string, total_amount double, entity_name_normalized string, donor_row_id long, g string, score string, bucket string"


def brute(rows, n):
    best = {}
    for code, score, item, row, *_ in rows:
        code = (code or "").strip().upper()
        if code and score is not None and not math.isnan(score):
            best.setdefault(code, []).append(((-score, item is not None, item or "", row), item, row))
    out = []
    for code, xs in best.items():
        seen = []
        for _, item, row in sorted(xs):
            if item not in [s for s, _ in seen]:
                seen.append((item, row))
        out += [(code, i + 1, row) for i, (_, row) in enumerate(seen[:n])]
    return sorted(out)


def make(count, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        code = rng.choice(["HOT"] * 6 + ["a", " A ", "b", "", None, "  "])
        score = rng.choice([1.0, 2.0, 3.5, None, float("nan"), -1.0, float(rng.randint(0, 50))])
        rows.append((code, score, rng.choice(["x", "y", "z", None, ""] + [f"n{k}" for k in range(20)]), i, "g", "s", "b"))
    return rows


@pytest.mark.parametrize("count, n, fan_in, parts", [(400, 5, 64, 4), (400, 3, 2, 12), (300, 1, 3, 7), (50, 30, 64, 3), (0, 5, 64, 2)])
def test_equals_brute_force(spark, count, n, fan_in, parts):
    rows = make(count, count + n)
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    got = topn.top_n(df, "committee_code", "total_amount", n, "entity_name_normalized", "donor_row_id", fan_in=fan_in, bucket_rows=50)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, n)


def test_hot_group_of_repeated_rows(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 > 0, "HOT").otherwise(F.concat(F.lit("g"), F.col("id"))).alias("committee_code"), F.lit(7.0).alias("total_amount"), F.lit("same").alias("entity_name_normalized"), F.col("id").alias("donor_row_id"))
    got = topn.top_n(df.repartition(9), "committee_code", "total_amount", 5, "entity_name_normalized", "donor_row_id")
    assert [tuple(r) for r in got.filter("committee_code = 'HOT'").collect()] == [("HOT", 1, 1)]


def test_loser_tree_merges_any_number_of_sources():
    rng = random.Random(1)
    for k in (0, 1, 2, 3, 5, 8, 13):
        lists = [sorted(rng.randint(0, 9) for _ in range(rng.randint(0, 6))) for _ in range(k)]
        its = [iter(x) for x in lists]
        tree = topn.LoserTree([lambda it=it: next(it, None) for it in its])
        out = []
        while (v := tree.key()) is not None:
            out.append(v)
            tree.next()
        assert out == sorted(v for x in lists for v in x)


def test_wrong_n(spark):
    with pytest.raises(ValueError):
        topn.top_n(spark.createDataFrame([], SCHEMA), "committee_code", "total_amount", 0, "entity_name_normalized", "donor_row_id")
