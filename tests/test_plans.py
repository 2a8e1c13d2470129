import pytest
from pyspark.sql import functions as F

from tallyforge.plans import gold, silver, surface

CF = "row_id int, committee_code string, committee_name string, committee_name_normalized string, committee_type string, candidate_name_normalized string, report_year int, schedule_type string, transaction_date string, amount double, entity_name string, entity_name_normalized string, purpose string, amendment_count int, entity_address string, entity_city string"


def cf(spark, *rows):
    base = dict(row_id=0, committee_code="PAC-1", committee_name="Pac One", committee_name_normalized="PAC ONE", committee_type="Political Action Committee", candidate_name_normalized=None, report_year=2020, schedule_type="ScheduleA", transaction_date="1/5/2020", amount=10.0, entity_name="Ann Lee", entity_name_normalized="ANN LEE", purpose=None, amendment_count=None, entity_address=None, entity_city=None)
    return spark.createDataFrame([tuple({**base, **r, "row_id": i}.values()) for i, r in enumerate(rows)], CF)


def test_latest_amendments_keep_ties(spark):
    df = cf(spark, {"amendment_count": 1}, {"amendment_count": 2}, {"amendment_count": 2}, {"transaction_date": "2020-01-20", "amendment_count": 0}, {"transaction_date": None}, {"transaction_date": "junk"}, {"amount": None, "entity_name_normalized": None}, {"committee_code": ""})
    got = gold.fact_transaction(df)
    assert {r.row_id for r in got.collect()} == {1, 2, 4, 5, 6}
    again = gold.fact_transaction(got.select(df.columns))
    assert again.count() == got.count()


def test_test_records(spark):
    df = cf(spark, {"entity_name_normalized": "BOB TESTER"}, {"entity_name_normalized": "TESTERMAN"}, {"entity_address": "test"}, {"entity_city": " TEST "}, {})
    assert {r.row_id for r in gold.suspected_test_records(gold.fact_transaction(df)).collect()} == {0, 2, 3}


PAID = {"schedule_type": "ScheduleD", "purpose": "Campaign contribution", "amount": 1000.0, "entity_name": "Ann for Senate", "entity_name_normalized": "ANN FOR SENATE", "transaction_date": "2020-03-01"}
GOT = {"schedule_type": "ScheduleA", "committee_code": "CC-20-1", "amount": 1000.0, "entity_name": "Pac One", "entity_name_normalized": "PAC ONE", "transaction_date": "2020-03-01"}


@pytest.mark.parametrize("paid, got, matched", [
    ({}, {}, True), ({}, {"amount": 1000.01}, True), ({}, {"amount": 1000.02}, False), ({}, {"transaction_date": "2020-01-31"}, True), ({}, {"transaction_date": "2020-01-30"}, False),
    ({}, {"transaction_date": "2020-04-30"}, True), ({}, {"transaction_date": "2020-05-01"}, False), ({}, {"transaction_date": None}, True), ({"transaction_date": None}, {}, True), ({}, {"committee_code": "CC-18-1"}, True),
    ({}, {"committee_code": "CC-18-9"}, False), ({}, {"entity_name": "Pac O"}, False), ({}, {"entity_name_normalized": "PAC TWO"}, False),
])
def test_unmatched_contributions(spark, paid, got, matched):
    mapping = spark.createDataFrame([("CC-20-1", "ANN FOR SENATE", "ANN"), ("CC-18-1", "ANN FOR SENATE", "ANN")], "committee_code string, committee_name_normalized string, candidate_name_normalized string")
    out = gold.unmatched_contributions(cf(spark, {**PAID, **paid}, {**GOT, **got}), mapping, "row_id").collect()
    assert (len(out) == 0) == matched
    if not matched:
        assert out[0].matched_code == "CC-20-1"


def test_contribution_purposes(spark):
    df = spark.createDataFrame([("Political contribution",), ("Contribution refund",), ("General 2020",), ("Catering",), (None,), ("fundraiser",)], "p string")
    assert [r[0] for r in df.select(gold.is_contribution(F.col("p"))).collect()] == [True, False, True, False, False, True]


def test_mappings_and_dimensions(spark):
    df = cf(spark, {"committee_name_normalized": "B"}, {"committee_name_normalized": "BEST"}, {"committee_name_normalized": "BEST"}, {"committee_name_normalized": "CEST"}, {"committee_name_normalized": "CEST"}, {"committee_code": "CC-1", "committee_name_normalized": "CC", "candidate_name_normalized": "ANN"}, {"committee_code": None})
    mapping, spellings = gold.build_mappings(df)
    assert {tuple(r) for r in mapping.collect()} == {("PAC-1", "BEST", "NOT A CC"), ("CC-1", "CC", "ANN")}
    assert ("Ann Lee", "ANN LEE") in {tuple(r) for r in spellings.collect()}
    dims = {r.committee_code: r.is_candidate_committee for r in gold.dim_committee(df.withColumn("party", F.lit("x")), mapping).collect()}
    assert dims == {"PAC-1": False, "CC-1": True}


def test_report_summary_and_balances(spark):
    rows = [(1, "C", "1/2/2024", "1/2/2024", 0, 0.0, 10.0, 10.0), (2, "C", "1/5/2024", "1/5/2024", 1, 0.0, 12.0, None), (3, "C", "1/10/2024", "1/9/2024", 0, 12.02, -5.0, -5.0), (4, "C", "bad", "x", 0, 1.0, 1.0, 1.0), (5, "", "1/2/2024", "x", 0, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "row_id int, committee_code string, due_date string, report_date string, amendment_count int, starting_balance double, ending_balance double, line_19 double").withColumn("report_year", F.lit(2024)).withColumn("folder_name", F.lit("f"))
    kept = gold.fact_report_summary(df)
    assert {r.row_id for r in kept.collect()} == {2, 3}
    assert [(r.row_id, round(r.discrepancy, 2)) for r in gold.balance_failures(kept).collect()] == [(3, 0.02)]
    assert {r.row_id for r in gold.suspicious_balances(kept).collect()} == {3}
    last = gold.latest_balances(df, F.lit("2024-06-01").cast("date")).filter("committee_code = 'C'").first()
    assert last.row_id == 3 and last.is_stale


def test_silver_new_and_old(spark):
    reports = spark.createDataFrame([("2024_01", "7 ", 1, "CC-1", "Old Name"), ("2024_01", "7", 2, "CC-1", "Friends of Ann"), ("2023_01", "7", 1, "CC-9", "Other")], "folder_name string, ReportId string, line_no int, CommitteeCode string, CommitteeName string")
    new = spark.createDataFrame([("2024_01", "ScheduleA", "7", "Ann", "", "Lee", "($5.00)", "1", "", "pens"), ("2024_01", "ScheduleA", "8", "", "", "Acme Inc", "x", "0", "books", "")], "folder_name string, schedule_type string, ReportId string, FirstName string, MiddleName string, LastOrCompanyName string, Amount string, IsIndividual string, ItemOrService string, ProductOrService string")
    got = {r.report_id: r for r in silver.transactions_new(new, reports).collect()}
    assert got["7"].committee_name == "Friends of Ann" and got["7"].amount == -5.0 and got["7"].entity_name == "Ann Lee" and got["7"].purpose == "pens" and got["7"].entity_is_individual
    assert got["8"].committee_code is None and got["8"].amount == 0.0 and got["8"].entity_name_normalized == "ACME"
    assert [tuple(r) for r in silver.unmatched_reports(silver.transactions_new(new, reports), reports).collect()] == [("2024_01", "8", 1)]
    old = spark.createDataFrame([("2006", "ScheduleD", "CC-2", "Com", "Ann", "Q", "Lee", "1,000.00"), ("2006", "ScheduleD", "CC-3", "Com", "", "", "", "")], ["folder_name", "schedule_type", "COMMITTEE_CODE", "COMMITTEE_NAME", "FIRSTNAME", "MIDDLENAME", "LASTNAME", "TRANS_AMNT"])
    rows = {r.committee_code: r for r in silver.transactions_old(old).collect()}
    assert rows["CC-2"].candidate_name == "Ann Q Lee" and rows["CC-2"].amount == 1000.0 and rows["CC-3"].candidate_name == "Com"


def test_names_once_and_refresh(spark):
    df = spark.createDataFrame([("Acme Inc",), ("Acme Inc",), (None,)], "raw string")
    assert sorted(r.out for r in silver.names_once(df, "raw", "out", False).collect()) == ["", "ACME", "ACME"]
    fixed = spark.createDataFrame([("a", "X", "1")], "entity_type string, raw_name string, target string")
    rows = spark.createDataFrame([("a", "x", "0"), ("b", "x", "2")], "entity_type string, raw_name string, target string")
    assert {tuple(r) for r in silver.refresh_mappings(rows, fixed).collect()} == {("a", "X", "1"), ("b", "x", "2")}


def test_on_time(spark):
    periods = spark.createDataFrame([("2024-01-01", "2024-06-30", "2024-05-01", False, 2), ("2024-01-01", "2024-03-31", "2024-03-15", True, 1)], "s string, e string, d string, on_cycle boolean, ordinal int")
    periods = periods.select(F.to_date("s").alias("period_start"), F.to_date("e").alias("period_end"), F.to_date("d").alias("deadline"), "on_cycle", "ordinal")
    rows = [(1, "2024-03-15", "11/2024", 2024), (2, "2024-03-16", "11/2024", 2024), (3, "2024-04-01", "11/2025", 2024), (4, "2030-01-01", "11/2024", 2024), (5, "junk", "11/2024", 2024), (6, "2024-03-01", None, 2024)]
    df = spark.createDataFrame(rows, "row int, report_date string, election_cycle string, report_year int")
    assert {r.row: r.on_time for r in silver.on_time(df, periods, "row").collect()} == {1: True, 2: False, 3: True, 4: False, 5: None, 6: True}


def test_guard(spark):
    spark.range(3).createOrReplaceTempView("numbers")
    assert len(surface.run_guarded(spark, "SELECT id, 'DROP TABLE x' AS t FROM numbers")) == 3
    assert len(surface.run_guarded(spark, "WITH a AS (SELECT * FROM numbers) SELECT * FROM a WHERE id > :n", args={"n": 0})) == 2
    for bad in ("DROP TABLE numbers", "DROP(x)", "SELECT 1; SELECT 2", "INSERT INTO numbers SELECT 1", "CREATE TABLE a AS SELECT 1", "SET a=b", ""):
        with pytest.raises(surface.QueryRefused):
            surface.guarded(spark, bad)
    for bad in ("SELECT reflect('java.lang.System', 'getProperty', 'user.dir')", "SELECT java_method ('a', 'b')", "SELECT * FROM parquet.`/tmp/x`", "WITH a AS (SELECT * FROM Text.`/etc/hosts`) SELECT * FROM a", "SELECT * FROM range(5)"):
        with pytest.raises(surface.QueryRefused):
            surface.guarded(spark, bad)
    with pytest.raises(surface.QueryRefused):
        surface.guarded(spark, "SELECT * FROM numbers", surface.Limits(scan_bytes=1))
    assert surface.guarded(spark, "SELECT * FROM numbers", surface.Limits(rows=2)).count() == 2
    assert surface.tables_of(spark, "WITH a AS (SELECT * FROM x.y) SELECT * FROM a JOIN z USING (id)") == ["x.y", "z"]
    assert surface.route(" select 1") == "sql" and surface.route("selection") == "search" and surface.route("") == "search"


def test_search_is_plain_text(spark):
    df = spark.createDataFrame([(1, "100% Fund"), (2, "100 Fund"), (3, None)], "id int, name string")
    assert [r.id for r in surface.name_search({"x": (df, "id", "name")}, "100% f").collect()] == ["1"]


def test_runner(spark):
    def totals(a):
        """Totals."""
        return a.agg(F.sum("id").alias("s"))

    runner = surface.Runner({"twice": surface.Table(lambda s: s.select((F.col("s") * 2).alias("x")), ("totals",)), "totals": surface.Table(totals, ("a",))})
    assert runner.order() == ["totals", "twice"] and runner.order(["totals"]) == ["totals"]
    built = runner.run({"a": spark.range(4)})
    assert built["twice"].first().x == 12
    assert runner.document(built)[0] == {"table": "totals", "description": "Totals.", "needs": ["a"], "columns": [("s", "bigint")]}
    with pytest.raises(ValueError):
        runner.run({})
    with pytest.raises(ValueError):
        surface.Runner({"a": surface.Table(lambda x: x, ("b",)), "b": surface.Table(lambda x: x, ("a",))}).order()


def test_questions(spark):
    fact = spark.createDataFrame([(1, "Ann Lee", "Friends of Ann", "Bob", "receipt", 50.0, 2020), (2, "Ann Lee", "Friends of Ann", "Printer", "disbursement", 20.0, 2020)], "transaction_id int, candidate_name string, committee_name string, entity_name string, transaction_category string, amount double, report_year int")
    assert surface.answer(fact, "How much did Ann Lee spend in 2020?").first().total_amount == 20.0
    assert surface.answer(fact, "top 5 donors to ann").first().entity_name == "Bob"
    assert surface.answer(fact, "transactions of ann over $30").count() == 1
    assert surface.answer(fact, "contributions by bob").first().committee_name == "Friends of Ann"
    assert surface.answer(fact, "hello") is None
    assert surface.expand_acronyms("PACs and PACs", {"PAC": "political action committee"}) == "political action committees (PACs) and PACs"


def test_regression_report(spark):
    df = spark.createDataFrame([("Acme Inc", "ACME INC"), ("Bob", "BOB"), ("Bob", "BOB"), (None, None)], "raw string, cur string")
    out = {r.name_variation: r.changed for r in surface.regression(df, "raw", "cur", lambda c: F.regexp_replace(F.upper(c), " INC$", "")).collect()}
    assert out == {"Acme Inc": True, "Bob": False}


def test_local_disbursements(spark):
    rows = [
        (1, "Ann", "Ward 1 Larkmoor", "Mayor", "11/2019", "1/1/2019", 5.0), (2, "Ann", "Ward 1 Larkmoor", "Mayor", "11/2019", "1/2/2019", 6.0), (3, "Bob", "Vantry", "Sheriff", None, "junk", 7.0),
        (4, "Cy", "Vantry", "Member County Board", "11/2010", "1/1/2010", 8.0), (5, "Di", None, "Mayor", "11/2020", None, 9.0), (6, "Ed", "Vantry", "Mayor", "11/2020", None, None),
    ]
    df = spark.createDataFrame(rows, "row_id int, candidate_name string, district string, office_sought string, election_cycle string, report_date string, total_disbursements double")
    ids = lambda **kw: {r.row_id for r in gold.local_disbursements(df, **kw).collect()}
    assert ids() == {2, 3, 4, 5}
    assert ids(districts=["LARK", "zz"]) == {2} and ids(offices=["mayor"]) == {2, 5} and ids(office_likes=["%board%"]) == {4}
    assert ids(cycle_likes=["%/2019%", "%/202_%"]) == {2, 3, 5}
    places = spark.createDataFrame([("larkmoor", "East", 1), ("Vantry", "West", 2)], "place string, county string, ordinal int")
    got = {r.county: (r.races, r.total_disbursements) for r in gold.county_totals(gold.local_disbursements(df, places)).collect()}
    assert got == {"East": (1, 6.0), "West": (2, 15.0), None: (0, 9.0)}
    assert {r.district: r.reports for r in gold.race_totals(df.filter("office_sought = 'Mayor'"), ["office_sought", "district"]).collect()} == {"Ward 1 Larkmoor": 2, "Vantry": 1}
