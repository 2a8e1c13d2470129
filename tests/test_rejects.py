import csv
import io
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyforge.sources import rejects as R

SPEC = R.RecordSpec(("Id", "Name", "Amount"), {"Amount": R.is_money, "Name": R.is_name_or_blank})
GRAMMAR = re.compile(r'(?:"(?:[^"]|"")*"|[^",\r\n]*)(?:,(?:"(?:[^"]|"")*"|[^",\r\n]*))*\Z')


def judge(spark, lines):
    df = spark.createDataFrame(list(enumerate(lines)), "line_id int, raw_line string")
    bad = {r["line_id"]: r["reason"] for r in R.rejects(df, SPEC).collect()}
    good = {r["line_id"]: r for r in R.strict_load(df, SPEC).collect()}
    assert set(bad) | set(good) == set(range(len(lines))) and not set(bad) & set(good)
    return bad, good


def test_reasons(spark):
    lines = {
        "1,Ann,5": None,
        '1,"Ann, B. ""Bo"" C",5': None,
        '1,"line\nbreak and é",5': "invalid_value",  # a line break is a control character in a name
        ",,5": None,
        "1,  ,5": None,
        "1,Ann,": "invalid_value",
        '1,"Ann,5': "quoting",
        '1,A"nn,5': "quoting",
        '1,"Ann" x,5': "quoting",
        "1,Ann\n,5": "quoting",
        "1,Ann": "column_count",
        "1,Ann,5,6": "column_count",
        "": "column_count",
        None: "column_count",
        "1,12345,5": "invalid_value",
        "1,Ann\x07,5": "invalid_value",
        "1,Ann�,5": "invalid_value",
        "1,Ann,five": "invalid_value",
        '1,Ann,"5\n"': None,
        "1," + "A" * 300_000 + ",5": None,
        '1,"' + '""' * 100_000 + 'A",5': None,
        "," * 50_000: "column_count",
    }
    bad, _ = judge(spark, list(lines))
    for i, (line, reason) in enumerate(lines.items()):
        assert bad.get(i) == reason, (line and line[:40], bad.get(i))


def test_money(spark):
    good = ["5", "5.00", ".5", "-5", "+5", "$5", "-$5", "$-5", "(5.00)", "($5.00)", "1,000", "$1,000.50", "(1,265.48)", "  43.99 "]
    bad = ["", " ", "$", "-", ".", "5..0", "1.2.3", "50 00", "1,00", "10,00.0", "5%", "1e", "1e5", "NaN", "(5", "5)", "--5", "O5", None, "=SUM(R2:R9)", "2019-03-04"]
    df = spark.createDataFrame([(x,) for x in good + bad], "v string").select("v", R.is_money(F.col("v")).alias("ok"))
    assert {r["v"]: r["ok"] for r in df.collect()} == {**dict.fromkeys(good, True), **dict.fromkeys(bad, False)}


def test_loaded_values_and_audit(spark):
    lines = ['7,"Ann ""A"" X, Jr",($5.00)', "7,Ann", '"a","b","1"']
    _, good = judge(spark, lines)
    assert good[0]["Name"] == 'Ann "A" X, Jr' and good[0]["Amount"] == "($5.00)" and good[2]["Id"] == "a"
    df = spark.createDataFrame(list(enumerate(lines)), "line_id int, raw_line string")
    assert {r["reason"]: r["records"] for r in R.load_audit(df, SPEC).collect()} == {"loaded": 2, "column_count": 1}


def test_repeated_offsets_extra_columns_and_empty(spark):
    df = spark.createDataFrame([(1, "1,Ann,5", "x"), (1, "1,Ann", "x"), (1, "1,Ann", "x"), (None, "1,Ann,5", "x"), (None, "bad", "x")], "line_id int, raw_line string, reason string")
    assert sorted(r["reason"] for r in R.rejects(df, SPEC).collect()) == ["column_count"] * 3
    assert R.rejects(df.limit(0), SPEC).count() == 0 and R.strict_load(df.limit(0), SPEC).count() == 0


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet='ab",\n 1é', max_size=20), min_size=1, max_size=30))
def test_split_agrees_with_a_csv_reader(spark, lines):
    df = spark.createDataFrame(list(enumerate(lines)), "i int, v string").select("i", R.well_quoted(F.col("v")).alias("ok"), R.split_record(F.col("v")).alias("f"))
    for r in df.collect():
        line = lines[r["i"]]
        assert r["ok"] == bool(GRAMMAR.match(line))
        if r["ok"] and line:
            assert r["f"] == next(csv.reader(io.StringIO(line, newline="")))


def test_both_tables_are_loaded_whole(spark, tmp_path):
    from tallyforge.plans import problems

    for table, columns in (("schedulea", R.SCHEDULE_A), ("report", R.REPORT)):
        good = ",".join("5" if c == "Amount" else "Ann" if c == "CandidateName" else c for c in columns)
        rows = [(1, good, "2020"), (2, good.replace("Ann", "12").replace(",5,", ",five,"), "2020"), (3, "", None)]
        spark.createDataFrame(rows, "line_id long, raw_line string, folder_name string").write.parquet(f"{tmp_path}/{table}.parquet")
    for query, columns, field, value in (("p3_loaded", R.SCHEDULE_A, "Amount", "5"), ("p3_loaded_report", R.REPORT, "CandidateName", "Ann")):
        loaded = problems.QUERIES[query](spark, str(tmp_path))
        assert loaded.columns == ["line_id", "folder_name", *columns]
        assert [(r.line_id, r[field]) for r in loaded.collect()] == [(1, value)]
