"""Dated folders of CSV files as tables, and tables as files.

Folders are `YYYY` (old layout, up to 2011) or `YYYY_MM` (new layout). Files are
read with an explicit all-text schema; records that do not fit go to quarantine
with their text, none is skipped. Blank fields come as empty strings."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.functions.scalars import schedule_type

TRANSACTIONS = ("ScheduleA", "ScheduleB", "ScheduleC", "ScheduleD", "ScheduleF", "ScheduleI")
CORRUPT = "_corrupt_record"


def folder_of(path: Column) -> Column:
    return F.regexp_extract(path, r"/(\d{4}(?:_\d{2})?)/[^/]+$", 1)


def is_new_layout(folder: Column) -> Column:
    return folder.rlike(r"^\d{4}_\d{2}$")


def discover(spark: SparkSession, root: str, after_year: int | None = None) -> DataFrame:
    """(path, folder_name, file_name, schedule_type, new_layout, length) of the CSV
    files below root, of folders from after_year on. Only names and sizes are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").load(root).select("path", "length")
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    out = files.select("path", folder_of(F.col("path")).alias("folder_name"), name.alias("file_name"), schedule_type(name).alias("schedule_type"), "length").withColumn("new_layout", is_new_layout(F.col("folder_name")))
    out = out.filter("folder_name <> ''")
    return out if after_year is None else out.filter(F.substring("folder_name", 1, 4).cast("int") >= after_year)


def completeness(found: DataFrame, expected: Sequence[str]) -> DataFrame:
    """(folder_name, expected, present, missing, complete_share) for each folder."""
    spark = found.sparkSession
    want = spark.createDataFrame([(e,) for e in expected], "file_name string")
    grid = found.select("folder_name").distinct().join(F.broadcast(want), F.lit(True))
    has = found.filter("length > 0").select("folder_name", "file_name", F.lit(True).alias("here"))
    out = grid.join(has, ["folder_name", "file_name"], "left").groupBy("folder_name")
    out = out.agg(F.count(F.lit(1)).alias("expected"), F.count("here").alias("present"), F.array_sort(F.collect_list(F.when(F.col("here").isNull(), F.col("file_name")))).alias("missing"))
    return out.withColumn("complete_share", F.col("present") / F.col("expected"))


def error_pages(spark: SparkSession, root: str, below: int = 100) -> DataFrame:
    """(path, body) of small downloads that are an error page and no data."""
    small = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).filter(F.col("length") < below)
    return small.select("path", F.lower(F.decode("content", "ISO-8859-1")).alias("body")).filter(F.col("body").rlike("error|forbidden|<html"))


def headers(spark: SparkSession, paths: str | Sequence[str], encoding: str = "ISO-8859-1") -> DataFrame:
    """(path, columns): the names in the first line of each file. Lines are read as
    lines, no file is held whole, and an aggregate keeps the first."""
    schema = "line string"
    reader = spark.read.schema(schema).option("encoding", encoding).option("sep", "\x01").option("quote", "").option("lineSep", "\n")
    first = reader.csv(paths).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"), "line")
    first = first.filter("start = 0").groupBy("path").agg(F.min_by("line", "at").alias("line"))
    names = F.split(F.regexp_replace("line", "^\\x{FEFF}|^\u00ef\u00bb\u00bf|\\r$", ""), ",(?=(?:[^\"]*\"[^\"]*\")*[^\"]*$)")
    return first.select("path", F.transform(names, lambda c: F.regexp_replace(F.trim(c), '^"|"$', "")).alias("columns"))


def scan_csv(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str], encoding: str = "ISO-8859-1") -> DataFrame:
    """All records as text, with folder_name, file_name and, for those that do not
    fit, their text in _corrupt_record.

    Columns are taken by the names in each file's own header, in whatever order they
    stand; one that a file lacks is empty, one that is not asked for is left out. Files
    of the same header are read together."""
    layouts = headers(spark, paths, encoding).groupBy("columns").agg(F.collect_list("path").alias("paths")).collect()  # file names by header: metadata
    parts = [_scan(spark, [unquote(p) for p in r["paths"]], list(r["columns"]), columns, encoding) for r in sorted(layouts, key=lambda r: r["columns"])]
    return union_all(parts) if parts else _scan(spark, paths, list(columns), columns, encoding)


def _scan(spark: SparkSession, paths: str | Sequence[str], header: Sequence[str], columns: Sequence[str], encoding: str) -> DataFrame:
    slots = [f"c{i}" for i in range(len(header))]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*slots, CORRUPT)])
    reader = spark.read.schema(schema).option("header", "true").option("encoding", encoding).option("quote", '"').option("escape", '"').option("multiLine", "true")
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).option("ignoreLeadingWhiteSpace", "true").option("enforceSchema", "true")
    df = reader.csv(paths).withColumn("folder_name", folder_of(F.col("_metadata.file_path"))).withColumn("file_name", F.col("_metadata.file_name"))
    at = {c: s for c, s in reversed(list(zip(header, slots)))}
    return df.select(*[(F.coalesce(at[c], F.lit("")) if c in at else F.lit("")).alias(c) for c in columns], CORRUPT, "folder_name", "file_name")


def split_quarantine(scanned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, quarantined) records of a scan; together they are all of them."""
    return scanned.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), scanned.filter(F.col(CORRUPT).isNotNull())


def load_audit(scanned: DataFrame) -> DataFrame:
    """(folder_name, file_name, read, loaded, quarantined)."""
    bad = F.count_if(F.col(CORRUPT).isNotNull()).cast("long")
    return scanned.groupBy("folder_name", "file_name").agg(F.count(F.lit(1)).alias("read"), (F.count(F.lit(1)) - bad).alias("loaded"), bad.alias("quarantined"))


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """Bag union by name; columns that one lacks are null in it."""
    out = None
    for f in frames:
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    if out is None:
        raise ValueError("nothing to unite")
    return out


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Replace a table; the commit is of the whole job, so readers see old or new."""
    writer = df.write.mode("overwrite").format(fmt)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def write_checked(df: DataFrame, path: str, schema: T.StructType) -> None:
    """Write with a declared schema; raises before writing if a required column
    has a null."""
    required = [f.name for f in schema.fields if not f.nullable]
    typed = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    if required:
        broken = typed.filter(" OR ".join(f"`{c}` IS NULL" for c in required)).limit(1).count()
        if broken:
            raise ValueError(f"null in a required column: {', '.join(required)}")
    write_table(typed, path)


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of new, and of old those whose key new lacks."""
    return old.join(new.select(*keys).distinct(), list(keys), "left_anti").unionByName(new, allowMissingColumns=True)


def export_csv(df: DataFrame, path: str) -> None:
    """One CSV file with a header, for results that are small by then."""
    df.coalesce(1).write.mode("overwrite").option("header", "true").csv(path)


def schema_listing(df: DataFrame) -> DataFrame:
    """(position, column_name, data_type, nullable) of a table."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields, 1)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string, nullable boolean")
