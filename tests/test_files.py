import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.sources import files


@pytest.fixture
def root(tmp_path):
    def put(name, data):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)

    put("2024_01/ScheduleA.csv", b'Id,Name,Amount\n1,"O\'Brien, ""Bo""",5\n2,"line\nbreak \xa7",6\n3,short\n4,a,b,c\n5,,7\n')
    put("2006/ScheduleA_PAC.csv", b"Id,Name,Amount\n6,x,1\n")
    put("2024_01/Report.csv", b"<html>Error</html>")
    return str(tmp_path)


def test_discover_and_completeness(spark, root):
    found = files.discover(spark, root)
    got = {(r.folder_name, r.file_name): (r.schedule_type, r.new_layout) for r in found.collect()}
    assert got == {("2024_01", "ScheduleA.csv"): ("ScheduleA", True), ("2006", "ScheduleA_PAC.csv"): ("ScheduleA", False), ("2024_01", "Report.csv"): ("", True)}
    assert files.discover(spark, root, 2010).count() == 2
    done = {r.folder_name: (r.present, r.missing) for r in files.completeness(found, ["ScheduleA.csv", "Report.csv"]).collect()}
    assert done == {"2024_01": (2, []), "2006": (0, ["Report.csv", "ScheduleA.csv"])}
    assert files.error_pages(spark, root).count() == 1


def test_scan_quarantines_and_audits(spark, root):
    df = files.scan_csv(spark, [f"{root}/2024_01/ScheduleA.csv", f"{root}/2006/ScheduleA_PAC.csv"], ["Id", "Name", "Amount"]).cache()
    good, bad = files.split_quarantine(df)
    rows = {r.Id: (r.Name, r.Amount, r.folder_name) for r in good.collect()}
    assert rows == {"1": ('O\'Brien, "Bo"', "5", "2024_01"), "2": ("line\nbreak §", "6", "2024_01"), "5": ("", "7", "2024_01"), "6": ("x", "1", "2006")}
    assert bad.count() == 2
    audit = {r.file_name: (r.read, r.loaded, r.quarantined) for r in files.load_audit(df).collect()}
    assert audit == {"ScheduleA.csv": (5, 3, 2), "ScheduleA_PAC.csv": (1, 1, 0)}
    heads = {r.path.rsplit("/", 1)[1]: r.columns for r in files.headers(spark, f"{root}/2006/ScheduleA_PAC.csv").collect()}
    assert heads == {"ScheduleA_PAC.csv": ["Id", "Name", "Amount"]}


def test_columns_go_by_name_in_each_file(spark, root, tmp_path):
    for name, data in (("2023_01/ScheduleA.csv", b"Amount,Name,Id\n7,Ann,10\n"), ("2023_02/Schedule A.csv", b'"Id","Name"\r\n11,Bo\r\n'), ("2023_03/ScheduleA.csv", b"Id,Sec\xa7,Amount,Name\n12,x,3,Cy\n"), ("2023_04/ScheduleA.csv", b"Id,Name,Amount\n")):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(data)
    df = files.scan_csv(spark, [f"{root}/{f}" for f in ("2023_01", "2023_02", "2023_03", "2023_04", "2006")], ["Id", "Name", "Amount"])
    assert {(r.Id, r.Name, r.Amount, r._corrupt_record) for r in df.collect()} == {("10", "Ann", "7", None), ("11", "Bo", "", None), ("12", "Cy", "3", None), ("6", "x", "1", None)}
    heads = {r.path.rsplit("/", 2)[1]: r.columns for r in files.headers(spark, f"{root}/2023_03").collect()}
    assert heads == {"2023_03": ["Id", "Sec\xa7", "Amount", "Name"]}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, name string")
    path = str(tmp_path / "t")
    files.write_table(df, path, ["id"])
    assert spark.read.parquet(path).count() == 2
    strict = T.StructType([T.StructField("name", T.StringType(), False)])
    with pytest.raises(ValueError):
        files.write_checked(df, str(tmp_path / "u"), strict)
    files.write_checked(df.filter("name IS NOT NULL"), str(tmp_path / "u"), strict)
    files.export_csv(df, str(tmp_path / "c"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "c")).count() == 2
    new = spark.createDataFrame([(2, "b"), (3, "c")], "id int, name string")
    assert {tuple(r) for r in files.upsert(df, new, ["id"]).collect()} == {(1, "a"), (2, "b"), (3, "c")}
    assert [r.column_name for r in files.schema_listing(df).collect()] == ["id", "name"]
    wide = files.union_all([df, new.withColumn("x", F.lit(1))])
    assert wide.columns == ["id", "name", "x"] and wide.count() == 4
    with pytest.raises(ValueError):
        files.union_all([])
