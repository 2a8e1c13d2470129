from pyspark.sql import functions as F

from tallyforge.sources import drift


def keys_of(phrases):
    return drift.correspond({"f": set(phrases)}, dict(phrases), drift.SCHEDULE_H)


def test_spellings_find_their_field():
    want = {
        "ReportId": "report_id", "COMMITTEE_CODE": "committee_code", "Committee Name": "committee_name", "candidatename": "candidate_name", "Report Year": "report_year", "Date Received": "report_date",
        "Report_Due_Date": "due_date", "Amended Count": "amendment_count", "Party_Desc": "party", "Office Code": "office_sought", "OFFICE_SUB_CODE": "district", "BeginnningBalance": "starting_balance",
        "Total Disb Elec Cycle": "total_disbursements", "End Cash Bal": "ending_balance", "ExpendableFundsBalance": "line_19",
    }
    kinds = {k: next(f.kind for f in drift.SCHEDULE_H if f.name == v) for k, v in want.items()}
    assert {k: v for (_, k), v in keys_of(kinds).items()} == want


def test_one_field_per_key_and_no_field_for_strangers():
    got = keys_of({"EndingBalance": "number", "Ending Balance": "number", "zzqx": "string"})
    assert len(set(got.values())) == len(got)
    assert got["f", "EndingBalance"] == "ending_balance" or got["f", "Ending Balance"] == "ending_balance"
    assert ("f", "zzqx") not in got


def test_flooding_converges_to_bounded_scores():
    scores = drift.flood({"DueDate": "string", "District": "string"}, drift.SCHEDULE_H)
    assert all(0 <= v <= 1 for v in scores.values())
    assert max(scores, key=scores.get) in {("DueDate", "due_date"), ("District", "district")}


def test_folder_names(spark):
    want = {" 2006": "2006", "2012-1": "2012_01", "201209": "2012_09", "2012_05/": "2012_05", "raw_data/2012_01/ScheduleA.csv": "2012_01", "raw_data/2006/": "2006", "2012_10": "2012_10", "x": None, "": None, None: None}
    df = spark.createDataFrame([(k,) for k in want], "f string").select("f", drift.folder_key(F.col("f")).alias("k"))
    assert {r["f"]: r["k"] for r in df.collect()} == want


def rows(spark, records):
    return spark.createDataFrame([(i, f, r) for i, (f, r) in enumerate(records)], "row_id int, folder_name string, record string")


def test_changes_of_json_records(spark):
    df = rows(spark, [
        ("2010", '{"ReportId": 1, "Party": "D", "Ending Balance": 5.5}'), ("2010", '{"ReportId": 2, "Party": "D", "Ending Balance": "6"}'), ("2010", '{"ReportId": 3, "Party": "D", "Ending Balance": 7}'),
        ("2012_01", '{"Report Id": 1, "Ending Balance": "5", "DueDate": null}'), ("2012_01", "not json"), ("2012_01", None), (None, '{"Report Id": 1}'),
    ])
    got = {(r.folder_name, r.field, r.change) for r in drift.json_table_changes(df, "t", drift.SCHEDULE_H).collect()}
    assert got == {("2012_01", "report_id", "renamed"), ("2012_01", "party", "removed"), ("2012_01", "ending_balance", "retyped"), ("2012_01", "due_date", "added")}


def test_changes_of_columns(spark):
    df = spark.createDataFrame([("2010", 1, None, None), ("2010", None, None, None), ("2012_1", 1, "x", None), ("2012_05", None, "x", None)], "folder_name string, a int, b string, c double")
    got = {(r.folder_name, r.field, r.change) for r in drift.column_table_changes(df, "t").collect()}
    assert got == {("2012_01", "b", "added"), ("2012_05", "a", "removed")}
    assert drift.column_table_changes(df.limit(0), "t").count() == 0


def test_unified_casts_and_keeps_every_row(spark):
    df = rows(spark, [("2010", '{"ReportId": 1, "Begin Cash Bal": "($1,200.50)", "Amended Count": "two"}'), ("2012_01", '{"REPORT_ID": 2, "BeginningBalance": 7}'), ("2012_01", "broken")])
    got = {r.row_id: r for r in drift.unified(df, drift.SCHEDULE_H).collect()}
    assert len(got) == 3 and got[0].report_id == 1 and got[0].starting_balance == -1200.5 and got[0].amendment_count is None
    assert got[1].report_id == 2 and got[1].starting_balance == 7.0 and got[2].report_id is None


def test_flooded_scores_select_and_exact_phrases_only_check(monkeypatch):
    keys = {"StartingBalance", "ending balance", "DUE-DATE", "BeginnningBalance"}
    fields = [f for f in drift.SCHEDULE_H if f.name in ("starting_balance", "ending_balance", "due_date")]
    given = []
    select = drift.select
    monkeypatch.setattr(drift, "select", lambda k, s, e, f: given.append(dict(e)) or select(k, s, e, f))
    kinds = dict.fromkeys(keys, "string")
    want = {"StartingBalance": "starting_balance", "ending balance": "ending_balance", "DUE-DATE": "due_date"}
    assert drift.correspond({"2020": keys}, kinds, fields) == {("2020", k): f for k, f in want.items()}
    assert given == [{}]
    # Scores that put a key beside its phrase are caught.
    monkeypatch.setattr(drift, "flood", lambda kinds, fields: {(k, f.name): float(want.get(k) != f.name) for k in kinds for f in fields})
    assert drift.correspond({"2020": set(want)}, kinds, fields) == {("2020", k): f for k, f in want.items()}


def test_unified_keeps_what_it_cannot_place(spark):
    rows = [(1, "2012_01", '{"ReportId": 1, "Zzyzx Qwv": "kept"}'), (2, "nowhere", '{"ReportId": 2}'), (3, "2012_01", '{"ReportId": 3}')]
    df = drift.unified(spark.createDataFrame(rows, "row_id long, folder_name string, record string"), drift.SCHEDULE_H)
    got = {r.row_id: (r.folder_name, r.report_id, r.unmatched) for r in df.collect()}
    assert got == {1: ("2012_01", 1, {"Zzyzx Qwv": "kept"}), 2: (None, None, {"ReportId": "2"}), 3: ("2012_01", 3, None)}


def test_spellings_that_no_phrase_shows(spark):
    known = {"report_id": "ReportId", "committee_code": "CommitteeCode", "committee_name": "CommitteeName", "candidate_name": "CandidateName", "report_year": "ReportYear", "report_date": "FilingDate", "due_date": "DueDate", "amendment_count": "AmendmentCount", "party": "Party", "office_sought": "OfficeSought", "district": "District", "starting_balance": "BeginningBalance", "total_disbursements": "TotalDisbursements", "ending_balance": "EndingBalance", "line_19": "ExpendableFundsBalance"}
    kind = {f.name: f.kind for f in drift.SCHEDULE_H}
    odd = {"report_date": ("Rpt Date", "Filed On"), "due_date": ("Deadline", "Due Dt"), "starting_balance": ("OpeningBalance", "Start Bal"), "ending_balance": ("ClosingBalance", "EndBal"), "party": ("Praty",), "district": ("Dist", "SubCode"), "committee_code": ("Cmte Code",), "total_disbursements": ("DisbTotal", "Total Spent"), "line_19": ("LINE_19", "Line No 19")}
    for field, names in odd.items():
        for name in names:
            folders = {"2012_01": {name if f == field else k for f, k in known.items()}}
            kinds = {**{k: kind[f] for f, k in known.items()}, name: kind[field]}
            assert drift.correspond(folders, kinds, drift.SCHEDULE_H, least=0.0)["2012_01", name] == field


def test_keys_that_are_data_raise(spark, monkeypatch):
    import pytest

    monkeypatch.setattr(drift, "MOST_KEYS", 3)
    df = spark.range(5).selectExpr("id AS row_id", "'2012_01' AS folder_name", "concat('{\"k', id, '\": 1}') AS record")
    with pytest.raises(ValueError):
        drift.unified(df, drift.SCHEDULE_H)
