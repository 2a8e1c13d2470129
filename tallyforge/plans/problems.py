"""Queries of the general data problems: dates, broken records, drifting schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions.timestamps import instants
from tallyforge.sources import drift, rejects

DATE_FIELDS = ["transaction_date", "report_date", "due_date"]


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return instants(spark.read.parquet(f"{sf_dir}/campaign_finance.parquet"), "row_id", DATE_FIELDS, source="campaign_finance")


def _raw(spark: SparkSession, sf_dir: str) -> list[tuple[str, DataFrame, rejects.RecordSpec]]:
    return [(t, spark.read.parquet(f"{sf_dir}/{t}.parquet"), s) for t, s in (("schedulea", rejects.SCHEDULE_A_SPEC), ("report", rejects.REPORT_SPEC))]


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = (rejects.rejects(df, spec).select(F.lit(t).alias("source_table"), "line_id", "reason") for t, df, spec in _raw(spark, sf_dir))
    return a.unionByName(b)


def _loaded(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    df, spec = next((df, spec) for t, df, spec in _raw(spark, sf_dir) if t == table)
    return rejects.strict_load(df, spec, keep=("folder_name",)).drop("__record")


def p3_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conforming ScheduleA records, each field a column of text as written."""
    return _loaded(spark, sf_dir, "schedulea")


def p3_loaded_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conforming Report records, each field a column of text as written."""
    return _loaded(spark, sf_dir, "report")


def p3_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = (rejects.load_audit(df, spec).select(F.lit(t).alias("source_table"), "reason", "records") for t, df, spec in _raw(spark, sf_dir))
    return a.unionByName(b)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = drift.json_table_changes(spark.read.parquet(f"{sf_dir}/schedule_h.parquet"), "schedule_h", drift.SCHEDULE_H, least=0.0)
    c = drift.column_table_changes(spark.read.parquet(f"{sf_dir}/campaign_finance.parquet"), "campaign_finance")
    return h.unionByName(c)


def p5_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table of all records; `unmatched` (keys without a field) as JSON text."""
    df = drift.unified(spark.read.parquet(f"{sf_dir}/schedule_h.parquet"), drift.SCHEDULE_H, least=0.0)
    return df.withColumn("unmatched", F.to_json("unmatched"))


#: SQL of the rejects: the same grammar without possessive quantifiers.
_FIELD = '(?:"(?:[^"]|"")*"|[^",\\r\\n]*)'
_NUMBER = "(?:[0-9]{1,3}(?:,[0-9]{3})+(?:\\.[0-9]*)?|[0-9]+(?:\\.[0-9]*)?|\\.[0-9]+)"
_MONEY = f"\\s*(?:(?:[+-]?\\s*\\$?|\\$[+-])\\s*{_NUMBER}|[-$]?\\(\\s*\\$?\\s*{_NUMBER}\\s*\\))\\s*"
P3_SQL = f"""
WITH s AS (
  SELECT 'schedulea' AS source_table, line_id, coalesce(raw_line, '') AS r, 22 AS n, 18 AS k FROM schedulea
  UNION ALL SELECT 'report', line_id, coalesce(raw_line, ''), 39, 5 FROM report
), q AS (
  SELECT *, regexp_full_match(r, '{_FIELD}(?:,{_FIELD})*') AS quoted, regexp_extract_all(',' || r, ',({_FIELD})', 1) AS f FROM s
), v AS (
  SELECT *, CASE WHEN starts_with(f[k], '"') THEN replace(f[k][2:length(f[k]) - 1], '""', '"') ELSE f[k] END AS x FROM q
), c AS (
  SELECT *, CASE WHEN source_table = 'schedulea' THEN regexp_full_match(x, '{_MONEY}') ELSE trim(x) = '' OR (regexp_matches(x, '\\p{{L}}') AND NOT regexp_matches(x, '[\\p{{Cc}}�]')) END AS valid FROM v
)
SELECT source_table, line_id, CASE WHEN NOT quoted THEN 'quoting' WHEN len(f) <> n THEN 'column_count' ELSE 'invalid_value' END AS reason FROM c WHERE NOT quoted OR len(f) <> n OR NOT valid
"""

#: SQL of the changes: the spellings known by hand, lower case and without other signs.
_SPELLINGS = {f.name: [f.name.replace("_", ""), *[p.replace(" ", "") for p in f.phrases]] for f in drift.SCHEDULE_H}
_SPELLINGS["starting_balance"].append("beginnningbalance")
_SPELLINGS["total_disbursements"].append("totdisbursements")
_SPELLED = ", ".join(f"('{s}', '{f}')" for f, names in _SPELLINGS.items() for s in names)
_FOLDER = "regexp_extract({c}, '(?:^|[^0-9])((?:19|20)[0-9]{{2}})', 1) || CASE WHEN regexp_extract({c}, '(?:^|[^0-9])(?:19|20)[0-9]{{2}}[-_. ]?(0?[1-9]|1[0-2])(?:[^0-9]|$)', 1) <> '' THEN '_' || lpad(regexp_extract({c}, '(?:^|[^0-9])(?:19|20)[0-9]{{2}}[-_. ]?(0?[1-9]|1[0-2])(?:[^0-9]|$)', 1), 2, '0') ELSE '' END"
P5_SQL = f"""
WITH names(spelling, field) AS (VALUES {_SPELLED}),
keys AS (SELECT {_FOLDER.format(c="folder_name")} AS folder, record, unnest(json_keys(record)) AS key FROM schedule_h),
kinds AS (SELECT folder, key, CASE json_type(json_extract(record, '$."' || key || '"')) WHEN 'VARCHAR' THEN 'string' WHEN 'NULL' THEN NULL WHEN 'BOOLEAN' THEN 'boolean' ELSE 'number' END AS kind FROM keys),
counts AS (SELECT folder, key, kind, count(*) AS n FROM kinds GROUP BY ALL),
h AS (SELECT 'schedule_h' AS t, folder, field, key, max_by(kind, n) FILTER (kind IS NOT NULL) AS kind FROM counts JOIN names ON spelling = regexp_replace(lower(key), '[^a-z0-9]', '', 'g') GROUP BY 1, 2, 3, 4),
c AS (UNPIVOT (SELECT {_FOLDER.format(c="folder_name")} AS folder, count(COLUMNS(* EXCLUDE (folder_name))), count(folder_name) AS folder_name FROM campaign_finance WHERE folder_name IS NOT NULL GROUP BY 1) ON COLUMNS(* EXCLUDE (folder)) INTO NAME field VALUE n),
present AS (SELECT * FROM h UNION ALL SELECT 'campaign_finance', folder, field, field, NULL FROM c WHERE n > 0),
folders AS (SELECT t, folder, lag(folder) OVER (PARTITION BY t ORDER BY folder) AS before FROM (SELECT DISTINCT t, folder FROM present)),
pairs AS (SELECT f.t, f.folder, x.field, a.key AS key1, a.kind AS kind1, b.key AS key0, b.kind AS kind0 FROM folders f JOIN (SELECT DISTINCT t, field FROM present) x USING (t)
  LEFT JOIN present a ON a.t = f.t AND a.folder = f.folder AND a.field = x.field LEFT JOIN present b ON b.t = f.t AND b.folder = f.before AND b.field = x.field WHERE f.before IS NOT NULL)
SELECT t AS table_name, folder AS folder_name, field, 'added' AS change FROM pairs WHERE key0 IS NULL AND key1 IS NOT NULL
UNION ALL SELECT t, folder, field, 'removed' FROM pairs WHERE key1 IS NULL AND key0 IS NOT NULL
UNION ALL SELECT t, folder, field, 'renamed' FROM pairs WHERE key1 <> key0
UNION ALL SELECT t, folder, field, 'retyped' FROM pairs WHERE key1 IS NOT NULL AND key0 IS NOT NULL AND kind1 <> kind0
"""

QUERIES = {"p2_found": p2_found, "p3_found": p3_found, "p3_loaded": p3_loaded, "p3_loaded_report": p3_loaded_report, "p3_audit": p3_audit, "p5_found": p5_found, "p5_unified": p5_unified}
ORACLE: dict[str, str] = {"p3_found": P3_SQL, "p5_found": P5_SQL}
