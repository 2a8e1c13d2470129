import datetime as dt
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from tallyforge.functions.timestamps import instants, local_day, refresh_dictionary, with_instant

UTC = dt.timezone.utc
NY = ZoneInfo("America/New_York")
EPOCH = dt.datetime(1970, 1, 1, tzinfo=UTC)


def micros(*parts, zone=NY):
    return (dt.datetime(*parts, tzinfo=zone) - EPOCH) // dt.timedelta(microseconds=1)


CASES = {
    "2024-01-02": micros(2024, 1, 2),
    " 2024-01-02 ": micros(2024, 1, 2),
    "2024.01.02": micros(2024, 1, 2),
    "20240102": micros(2024, 1, 2),
    "20240102 0304": micros(2024, 1, 2, 3, 4),
    "2024-01-02 03:04:05": micros(2024, 1, 2, 3, 4, 5),
    "2024-01-02T03:04:05.123456789": micros(2024, 1, 2, 3, 4, 5, 123456),
    "2024-01-02T03:04:05.1": micros(2024, 1, 2, 3, 4, 5, 100000),
    "2024-01-02T03:04:05Z": micros(2024, 1, 2, 3, 4, 5, zone=UTC),
    "2024-01-02T03:04:05+01:00": micros(2024, 1, 2, 2, 4, 5, zone=UTC),
    "2024-01-02 03:04:05 -0500": micros(2024, 1, 2, 8, 4, 5, zone=UTC),
    "1/2/2024": micros(2024, 1, 2),
    "01-02-2024": micros(2024, 1, 2),
    "1/2/99": micros(1999, 1, 2),
    "1/2/69": micros(1969, 1, 2),
    "1/2/68": micros(2068, 1, 2),
    "1/2/2024 12:00:00 AM": micros(2024, 1, 2),
    "1/2/2024 12:30": micros(2024, 1, 2, 12, 30),
    "7/2/2024 1:00:00 PM EST": micros(2024, 7, 2, 18, zone=UTC),
    "24-Oct-2015": micros(2015, 10, 24),
    "2 SEP 20": micros(2020, 9, 2),
    "September 15, 2022": micros(2022, 9, 15),
    "Apr 12, 2012 5:39 a.m.": micros(2012, 4, 12, 5, 39),
    "Sun, 05 Jan 2025 13:24:57 GMT": micros(2025, 1, 5, 13, 24, 57, zone=UTC),
    "1329795974": 1329795974 * 10**6,
    "1635411604707": 1635411604707 * 1000,
    "43197": micros(2018, 4, 7),
    # Skipped: the offset before the change. Occurs twice: the earlier instant.
    "2024-03-10 02:30:00": micros(2024, 3, 10, 7, 30, zone=UTC),
    "2024-11-03 01:30:00": micros(2024, 11, 3, 5, 30, zone=UTC),
    "": None,
    None: None,
    "junk": None,
    "13/45/2020": None,
    "2023-02-30": None,
    "0000-00-00": None,
    "2024-01-02 25:00:00": None,
    "99999999": None,
    "1/2/2024 13:00 PM": None,
    "see attached": None,
    "24-Foo-2015": None,
    "2024-01-02 03:04:05 +99:00": None,
    "x" * 100_000: None,
}


def test_forms(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(CASES)], "i int, v string")
    got = {r["i"]: r["m"] for r in with_instant(df, "v", "m").select("i", "m").collect()}
    for i, (v, want) in enumerate(CASES.items()):
        assert got[i] == want, (v and v[:40], got[i], want)


def test_instants_match_row_by_row_and_ignore_other_columns(spark):
    rows = [(i, v, list(CASES)[-1 - i % 5], "noise", 1) for i, v in enumerate(CASES)] * 2
    df = spark.createDataFrame(rows, "row_id int, a string, b string, raw string, n int")
    got = sorted(tuple(r) for r in instants(df, "row_id", ["a", "b"]).collect())
    want = sorted((r[0], f, CASES[v]) for r in rows for f, v in (("a", r[1]), ("b", r[2])) if CASES[v] is not None)
    assert got == want


def test_hot_value_and_empty_table(spark):
    df = spark.range(3000).select(F.col("id").alias("row_id"), F.when(F.col("id") % 3 > 0, "1/2/2024").otherwise(F.concat(F.lit("2020-01-01 00:00:"), F.lpad((F.col("id") % 60).cast("string"), 2, "0"))).alias("a"))
    out = instants(df, "row_id", ["a"])
    assert out.count() == 3000
    assert out.filter(F.col("utc_micros") == micros(2024, 1, 2)).count() == 2000
    assert instants(df.limit(0), "row_id", ["a"]).count() == 0


def test_dictionary_grows_only_by_new_strings(spark, tmp_path):
    path = str(tmp_path / "dictionary")
    first = spark.createDataFrame([("1/2/2024",), ("junk",), ("1/2/2024",)], "raw string")
    assert refresh_dictionary(first, path).count() == 2
    again = spark.createDataFrame([("1/2/2024",), ("1/3/2024",)], "raw string")
    assert {r["raw"] for r in refresh_dictionary(again, path).collect()} == {"1/2/2024", "junk", "1/3/2024"}
    assert refresh_dictionary(again, path, zone="UTC").filter("raw = '1/3/2024'").first()["utc_micros"] == micros(2024, 1, 3, zone=UTC)


@pytest.mark.parametrize("text, day", [("2024-01-02T03:00:00Z", "2024-01-01"), ("1/2/2024", "2024-01-02")])
def test_local_day(spark, text, day):
    df = with_instant(spark.createDataFrame([(text,)], "v string"), "v", "m")
    assert df.select(local_day(F.col("m"))).first()[0] == day
