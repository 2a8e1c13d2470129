"""Strict load of raw CSV records, and the rejected rest with the reason.

A record is read as text with its offset. `strict_load` keeps conforming
records only, parsed into columns. `rejects` subtracts the loaded offsets from
the raw ones and diagnoses what remains, so nothing is in both or in neither.
The field grammar: fields are separated by commas; each is free of double
quotes and line breaks, or wholly enclosed in double quotes with inner ones
doubled. All patterns are possessive: they neither backtrack nor recurse, so
very long records are safe.

A null record counts as an empty one (a single empty field). Repeated records
are each judged. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"|[^",\r\n]*+)'
_RECORD = rf"\A{_FIELD}(?:,{_FIELD})*+\z"
_EACH = rf",({_FIELD})"

#: One decimal number, leaving aside outer spaces, one sign, one $, proper
#: thousands commas and accounting parentheses.
_NUMBER = r"(?:\d{1,3}(?:,\d{3})++(?:\.\d*+)?+|\d++(?:\.\d*+)?+|\.\d++)"
_SIGNED = rf"(?:[+-]?+\s*+\$?+|\$[+-])\s*+{_NUMBER}"
MONEY = rf"\A\s*+(?:{_SIGNED}|\(\s*+\$?+\s*+{_NUMBER}\s*+\)|\$\(\s*+{_NUMBER}\s*+\)|-\(\s*+\$?+{_NUMBER}\s*+\))\s*+\z"

#: Column orders of the two record kinds (fixed values of the file format).
SCHEDULE_A = ("ReportId", "CommitteeContactId", "FirstName", "MiddleName", "LastOrCompanyName", "Prefix", "Suffix", "NameOfEmployer", "OccupationOrTypeOfBusiness", "PrimaryCityAndStateOfEmploymentOrBusiness", "AddressLine1", "AddressLine2", "City", "StateCode", "ZipCode", "IsIndividual", "TransactionDate", "Amount", "TotalToDate", "ScheduleAId", "ScheduleId", "ReportUID")
REPORT = ("ReportId", "CommitteeCode", "CommitteeName", "CommitteeType", "CandidateName", "IsStateWide", "IsGeneralAssembly", "IsLocal", "Party", "FecNumber", "ReportYear", "FilingDate", "StartDate", "EndDate", "AddressLine1", "AddressLine2", "AddressLine3", "City", "StateCode", "ZipCode", "FilingType", "IsFinalReport", "IsAmendment", "AmendmentCount", "SubmitterPhone", "SubmitterEmail", "ElectionCycle", "ElectionCycleStartDate", "ElectionCycleEndDate", "OfficeSought", "District", "NoActivity", "BalanceLastReportingPeriod", "DateOfReferendum", "SubmittedDate", "AccountId", "DueDate", "IsXmlUpload", "ReportUID")


def is_money(text: Column) -> Column:
    return F.coalesce(text.rlike(MONEY), F.lit(False))


def is_name_or_blank(text: Column) -> Column:
    """Blank, or with a letter and free of control and replacement characters."""
    blank = text.isNull() | (F.trim(text) == "")
    return blank | (text.rlike(r"\p{L}") & ~text.rlike("[\\p{Cc}�]"))


@dataclass(frozen=True)
class RecordSpec:
    """columns: names in order. checks: for a column, whether its text is valid."""

    columns: tuple[str, ...]
    checks: dict[str, Callable[[Column], Column]] = field(default_factory=dict)


SCHEDULE_A_SPEC = RecordSpec(SCHEDULE_A, {"Amount": is_money})
REPORT_SPEC = RecordSpec(REPORT, {"CandidateName": is_name_or_blank})


def well_quoted(raw: Column) -> Column:
    return F.coalesce(raw, F.lit("")).rlike(_RECORD)


def split_record(raw: Column) -> Column:
    """The fields of a well-quoted record, without their quotes."""
    fields = F.regexp_extract_all(F.concat(F.lit(","), F.coalesce(raw, F.lit(""))), F.lit(_EACH), F.lit(1))
    return F.transform(fields, lambda f: F.when(f.startswith('"'), F.replace(F.substring(f, F.lit(2), F.length(f) - 2), F.lit('""'), F.lit('"'))).otherwise(f))


def _valid(fields: Column, spec: RecordSpec) -> Column:
    ok = F.lit(True)
    for name, check in spec.checks.items():
        ok = ok & check(F.get(fields, F.lit(spec.columns.index(name))))
    return ok


def _judged(raw_rows: DataFrame, raw: str, spec: RecordSpec) -> DataFrame:
    df = raw_rows.withColumn("__quoted", well_quoted(F.col(raw)))
    df = df.withColumn("__fields", F.when(F.col("__quoted"), split_record(F.col(raw))))
    return df.withColumn("__count", F.size("__fields")).withColumn("__valid", _valid(F.col("__fields"), spec))


def strict_load(raw_rows: DataFrame, spec: RecordSpec, offset: str = "line_id", raw: str = "raw_line", keep: tuple[str, ...] = ()) -> DataFrame:
    """(offset, keep..., the columns of spec as text): conforming records only."""
    df = _judged(raw_rows.select(offset, raw, *keep), raw, spec)
    df = df.filter(F.col("__quoted") & (F.col("__count") == len(spec.columns)) & F.col("__valid"))
    return df.select(F.col(offset), *keep, F.xxhash64(raw).alias("__record"), *[F.get("__fields", F.lit(i)).alias(c) for i, c in enumerate(spec.columns)])


def rejects(raw_rows: DataFrame, spec: RecordSpec, offset: str = "line_id", raw: str = "raw_line") -> DataFrame:
    """(offset, raw, reason): raw records that strict_load did not load.

    The anti-join is on the offset with a hash of the record, so an offset that
    occurs twice, once broken, still gives its broken record."""
    loaded = strict_load(raw_rows, spec, offset, raw).select(F.col(offset).alias("__o"), F.col("__record").alias("__r"))
    reason = F.when(~F.col("__quoted"), "quoting").when(F.col("__count") != len(spec.columns), "column_count").otherwise("invalid_value")
    judged = _judged(raw_rows.select(offset, raw), raw, spec).withColumn("__record", F.xxhash64(raw)).withColumn("reason", reason)
    # Of loaded records only offset and hash are joined, no text: all but the rejects' own texts stay where they are.
    good = F.col("__quoted") & (F.col("__count") == len(spec.columns)) & F.col("__valid")
    rest = judged.select(offset, F.when(~good, F.col(raw)).alias(raw), "__record", "reason")
    return rest.join(loaded, F.col(offset).eqNullSafe(F.col("__o")) & (F.col("__record") == F.col("__r")), "left_anti").select(offset, raw, "reason")


def load_audit(raw_rows: DataFrame, spec: RecordSpec, offset: str = "line_id", raw: str = "raw_line") -> DataFrame:
    """(reason, records): loaded and rejected records counted; they sum to all."""
    good = strict_load(raw_rows, spec, offset, raw).select(F.lit("loaded").alias("reason"))
    bad = rejects(raw_rows, spec, offset, raw).select("reason")
    return good.unionByName(bad).groupBy("reason").agg(F.count(F.lit(1)).alias("records"))
