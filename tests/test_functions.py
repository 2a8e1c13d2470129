import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyforge.functions import normalize as N
from tallyforge.functions import scalars as S


def each(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}").select("i", fn(F.col("v")).alias("o"))
    return [r["o"] for r in df.orderBy("i").collect()]


def check(spark, table, fn, kind="string"):
    assert dict(zip(table, each(spark, list(table), fn, kind))) == table


def test_parse_date(spark):
    d = dt.date
    check(spark, {"": None, None: None, "2024-01-02": d(2024, 1, 2), "2024-01-02 03:04:05": d(2024, 1, 2), "2024-01-02T03:04:05.123456789": d(2024, 1, 2), "2024-01-02 99:04:05": None, "1/2/2024": d(2024, 1, 2), "1/2/2024 12:00": d(2024, 1, 2), "1/2/20245": None, "1/2/99": d(1999, 1, 2), "1/2/68": d(2068, 1, 2), "1/2/69": d(1969, 1, 2), "13/45/2020": None, "2023-02-30": None, "junk": None}, S.parse_date)


def test_parse_date_formats(spark):
    check(spark, {"2024-01-02 03:04:05.1234567": dt.date(2024, 1, 2), "1/2/2024": dt.date(2024, 1, 2), "x": None, None: None}, S.parse_date_formats)


def test_money(spark):
    check(spark, {"10.5": 10.5, "$1,200.00": 1200.0, "($1,200.00)": -1200.0, "": 0.0, "abc": 0.0, "0": 0.0, None: 0.0}, S.money)
    assert each(spark, ["abc"], lambda c: S.money(c, None)) == [None]


def test_small_functions(spark):
    check(spark, {"1": True, "0": False, "2.5": True, "true": True, "False": False, "x": None, None: None}, S.truthy)
    check(spark, {"CC-12-00001": 2012, "CC-49-1": 2049, "CC-50-1": 1950, "PAC-12-1": None, None: None}, S.code_year)
    check(spark, {"o'brien (2nd WARD)": "O'Brien (2Nd Ward)", "": "", None: None, "north-east": "North-East"}, S.title_case)
    check(spark, {"N/A": "", "-": "", "1": "", " Ann ": "Ann", None: "", "12": ""}, S.valid_name)
    check(spark, {"ScheduleA_PAC.csv": "ScheduleA", "schedulea.CSV": "schedulea", "Report.csv": ""}, S.schedule_type)
    check(spark, {"TESTER BOB": True, "TESTERMAN": False, None: False}, lambda c: S.has_word(c, "TESTER", "TESTY"))
    check(spark, {1.01: 101, None: 0, -2.5: -250}, lambda c: S.cents(c), "double")
    assert each(spark, [dt.date(2024, 1, 7), dt.date(2024, 1, 8)], S.week_start, "date") == [dt.date(2024, 1, 1), dt.date(2024, 1, 8)]
    df = spark.createDataFrame([("abcd", "abce"), ("", "x"), (None, "x")], "a string, b string").select(S.similarity(F.col("a"), F.col("b")))
    assert [r[0] for r in df.collect()] == [0.75, 0.0, 0.0]


@pytest.mark.parametrize("raw, flag, want", [
    (None, None, ""), ("  the   honorable john q smith jr ", True, "JOHN SMITH JR"), ("Mary-Ann Q Smith", True, "MARY SMITH"), ("Cher", True, "CHER"), ("JOHN SMITH, JR", True, "JOHN SMITH, JR"),
    ("ACME INC PAC", False, "ACME"), ("ACME PAC INC", False, "ACME PAC"), ("A & B.COM", False, "A AND B"), ("10th St Association", None, "10 ST ASSOC"), ("Virginia Highway Fund", None, "VA HWY FUND"),
    ("Political  Action Committee of X", None, "PAC OF X"), ("Café Élan LLC", False, "CAFÉ ÉLAN"),
])
def test_name(spark, raw, flag, want):
    assert each(spark, [raw], lambda c: N.name(c, flag)) == [want]


def test_name_aliases(spark):
    fn = lambda c: N.name(c, None, {"ACME POWER": "ACME ENERGY"}, {"ACME ENERGY ": "ACME ENERGY"})
    check(spark, {"Acme Power": "ACME ENERGY", "Acme Energy of X": "ACME ENERGY", "Other": "OTHER"}, fn)


def test_office_and_level(spark):
    check(spark, {"HOD": "delegate", "Lt. Gov": "lieutenant governor", "Delegate - 42nd": "delegate", "Member School Board": "member board of supervisors", "Chair County Board": "chair board of supervisors", "School Board": "school board", "Clerk of Court": "clerk of court", "Governor": "governor", "Senate of Virginia": "senator", "Dog Catcher": "dog catcher", "": "", None: None}, N.office)
    df = spark.createDataFrame([("delegate", "x"), ("mayor", None), (None, "1st Congressional"), (None, None)], "o string, d string").select(N.level(F.col("o"), F.col("d")))
    assert [r[0] for r in df.collect()] == ["state", "local", "federal", "local"]


def test_district(spark):
    rows = [
        ("042", None, None, None, "42"), ("At Large", "Old Town", "local", None, "Old Town (0)"), ("At Large", None, None, None, "0"), ("", "old town", "local", None, "Old Town (0)"), ("", "old town", "state", None, "Old Town"),
        (None, None, None, None, None), ("north", None, None, None, "North"), ("--", "Old Town", "local", None, "Old Town (0)"), ("7", "Old Town", "local", "Council - east", "Old Town (7) - East"), ("3", "Old Town", "local", "Mayor", "Old Town (0)"), ("3", None, None, "Mayor", "0"),
    ]
    df = spark.createDataFrame(rows, "d string, c string, l string, s string, want string")
    for r in df.withColumn("got", N.district(F.col("d"), F.col("c"), F.col("l"), F.col("s"))).collect():
        assert r["got"] == r["want"], r


def test_variations(spark):
    check(spark, {"11/2020": "general", "6/2020": "primary", None: None}, N.primary_or_general)
    assert each(spark, ["Ann B Cole", "Cher"], N.search_variations) == [["Ann B Cole", "Ann Cole", "A Cole"], ["Cher"]]
    assert each(spark, ["10ST FRIENDS"], N.match_variations) == [["10ST FRIENDS", "10STFRIENDS", "10 ST FRIENDS", "10ST FRIEND"]]
