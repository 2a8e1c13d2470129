"""Raw schedule records as one transaction table, old and new layouts alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyforge.functions import normalize
from tallyforge.functions.scalars import filled, first_filled, joined, money, truthy
from tallyforge.operators.matching import small

#: Report attributes that transactions take over in the new layout: output to header.
REPORT_FIELDS = {
    "committee_code": "CommitteeCode", "committee_name": "CommitteeName", "candidate_name": "CandidateName", "report_year": "ReportYear", "report_date": "FilingDate", "party": "Party",
    "office_sought": "OfficeSought", "district": "District", "candidate_city": "City", "election_cycle": "ElectionCycle", "election_cycle_start_date": "ElectionCycleStartDate",
    "election_cycle_end_date": "ElectionCycleEndDate", "committee_type": "CommitteeType", "zip_code": "ZipCode", "submitted_date": "SubmittedDate", "due_date": "DueDate", "amendment_count": "AmendmentCount",
}
#: The spellings of the old layout's headers, in order of preference.
OLD_FIELDS = {
    "committee_code": ("Committee Code", "COMMITTEE_CODE"), "committee_name": ("Committee Name", "COMMITTEE_NAME"), "report_year": ("Report Year", "REPORT_YEAR"), "report_date": ("Date Received", "DATE_RECEIVED"),
    "party": ("Party", "Party_Desc"), "office_sought": ("Office Code", "OFFICE_CODE"), "district": ("Office Sub Code", "OFFICE_SUB_CODE"), "transaction_date": ("Trans Date", "TRANS_DATE"), "amount": ("Trans Amount", "TRANS_AMNT"),
    "total_to_date": ("Trans Agg To Date", "TRANS_AGG_TO_DATE"), "entity": ("Entity Name", "ENTITY_NAME"), "entity_address": ("Entity Address", "ENTITY_ADDRESS"), "entity_city": ("Entity City", "ENTITY_CITY"),
    "entity_state": ("Entity State", "ENTITY_STATE"), "entity_zip": ("Entity Zip", "ENTITY_ZIP"), "entity_employer": ("Entity Employer", "ENTITY_EMPLOYER"), "entity_occupation": ("Entity Occupation", "ENTITY_OCCUPATION"),
    "transaction_type": ("Trans Type", "TRANS_TYPE"), "purpose": ("Trans Service Or Goods", "TRANS_ITEM_OR_SERVICE"), "first": ("First Name", "FIRSTNAME"), "middle": ("Middle Name", "MIDDLENAME"), "last": ("Last Name", "LASTNAME"),
}


def have(df: DataFrame, *names: str) -> Column:
    """The first filled of those columns that exist; null if none does."""
    there = [F.col(f"`{n}`") for n in names if n in df.columns]
    return first_filled(*there) if there else F.lit(None).cast("string")


def report_attributes(reports: DataFrame) -> DataFrame:
    """One row per folder and report id: of duplicates the last by file order."""
    w = Window.partitionBy("folder_name", "report_id").orderBy(F.col("line_no").desc())
    keyed = reports.withColumn("report_id", F.trim("ReportId")).withColumn("__rn", F.row_number().over(w)).filter("__rn = 1")
    return keyed.select("folder_name", "report_id", *[have(keyed, c).alias(o) for o, c in REPORT_FIELDS.items()])


def transactions_new(schedule: DataFrame, reports: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Records of a new-layout schedule with the attributes of their report; `keep`
    columns go through."""
    first, middle, last = (have(schedule, c) for c in ("FirstName", "MiddleName", "LastOrCompanyName"))
    person = filled(F.coalesce(first, F.lit("")))
    rows = schedule.select(
        *keep, F.trim("ReportId").alias("report_id"), "folder_name", "schedule_type",
        have(schedule, "TransactionDate").alias("transaction_date"), money(have(schedule, "Amount")).alias("amount"), money(have(schedule, "TotalToDate")).alias("total_to_date"),
        F.coalesce(F.when(~filled(F.coalesce(last, F.lit(""))), "").when(person, joined(first, middle, last)).otherwise(last), F.lit("")).alias("entity_name"),
        first.alias("entity_first_name"), F.when(person, last).alias("entity_last_name"), joined(have(schedule, "AddressLine1"), have(schedule, "AddressLine2")).alias("entity_address"),
        have(schedule, "City").alias("entity_city"), have(schedule, "StateCode").alias("entity_state"), have(schedule, "ZipCode").alias("entity_zip"), have(schedule, "NameOfEmployer").alias("entity_employer"),
        have(schedule, "OccupationOrTypeOfBusiness").alias("entity_occupation"), truthy(have(schedule, "IsIndividual")).alias("entity_is_individual"),
        have(schedule, "ItemOrService", "ProductOrService", "PurposeOfObligation").alias("purpose"), F.lit("new").alias("data_source"),
    )
    out = rows.join(report_attributes(reports), ["folder_name", "report_id"], "left")
    return _typed(out.withColumn("transaction_type", F.col("schedule_type")))


def transactions_old(schedule: DataFrame) -> DataFrame:
    """Records of an old-layout schedule, in either spelling of its headers."""
    f = {o: have(schedule, *names) for o, names in OLD_FIELDS.items()}
    first, last = f.pop("first"), f.pop("last")
    middle, entity, committee = f.pop("middle"), f.pop("entity"), f["committee_name"]
    both = filled(F.coalesce(first, F.lit(""))) & filled(F.coalesce(last, F.lit("")))
    rows = schedule.select(
        F.lit(None).cast("string").alias("report_id"), "folder_name", "schedule_type", *[c.alias(o) for o, c in f.items() if o not in ("amount", "total_to_date")],
        money(f["amount"]).alias("amount"), money(f["total_to_date"]).alias("total_to_date"),
        F.when(both, joined(first, middle, last)).otherwise(committee).alias("candidate_name"), F.coalesce(entity, joined(first, middle, last)).alias("entity_name"), F.lit("old").alias("data_source"),
    )
    return _typed(rows)


def _typed(df: DataFrame) -> DataFrame:
    """Numbers read, names, office, district and level normalised."""
    for c in ("report_year", "amendment_count"):
        if c in df.columns:
            df = df.withColumn(c, F.col(c).try_cast("int"))
    flag = F.col("entity_is_individual") if "entity_is_individual" in df.columns else F.lit(None).cast("boolean")
    entity = F.when(flag, normalize.name(F.col("entity_name"), True)).when(~flag, normalize.name(F.col("entity_name"), False)).otherwise(normalize.name(F.col("entity_name")))
    df = df.withColumn("committee_name_normalized", normalize.name(F.col("committee_name"), False)).withColumn("candidate_name_normalized", normalize.name(F.col("candidate_name"), True)).withColumn("entity_name_normalized", entity)
    df = df.withColumn("office_sought_normal", normalize.office(F.col("office_sought")))
    df = df.withColumn("level", normalize.level(F.col("office_sought_normal"), F.col("district")))
    city = F.col("candidate_city") if "candidate_city" in df.columns else F.lit(None).cast("string")
    df = df.withColumn("district_normal", normalize.district(F.col("district"), city, F.col("level"), F.col("office_sought")))
    if "election_cycle" in df.columns:
        df = df.withColumn("primary_or_general", normalize.primary_or_general(F.col("election_cycle")))
    return df


def unmatched_reports(transactions: DataFrame, reports: DataFrame) -> DataFrame:
    """(folder_name, report_id, row_count) of transactions without a report."""
    known = reports.select("folder_name", F.trim("ReportId").alias("report_id")).distinct()
    return transactions.filter("report_id IS NOT NULL").join(known, ["folder_name", "report_id"], "left_anti").groupBy("folder_name", "report_id").agg(F.count(F.lit(1)).alias("row_count"))


def names_once(df: DataFrame, raw: str, out: str, individual: bool | None) -> DataFrame:
    """A normalised name computed once per distinct spelling and joined back."""
    words = df.select(raw).filter(F.col(raw).isNotNull()).distinct()
    table = words.withColumn(out, normalize.name(F.col(raw), individual))
    return df.join(table, raw, "left").withColumn(out, F.coalesce(out, F.lit("")))


def on_time(df: DataFrame, periods: DataFrame, row: str, date: str = "report_date", cycle: str = "election_cycle", year: str = "report_year") -> DataFrame:
    """df with on_time: whether the date is by the deadline of the first period
    that contains it and has the cycle's kind; false without such a period, null
    where date or year is unreadable. periods: period_start, period_end, deadline,
    on_cycle, ordinal."""
    from tallyforge.functions.scalars import parse_date
    from tallyforge.operators.matching import range_lookup

    d = parse_date(F.col(date))
    election = F.regexp_extract(F.col(cycle), r"([^/]*)$", 1).try_cast("int")
    base = df.withColumn("__d", d).withColumn("__on", F.coalesce(F.col(year).cast("int") == election, F.lit(False)))
    out = range_lookup(base, periods, "__d", "period_start", "period_end", "ordinal", ["deadline"], [("__on", "on_cycle")], row)
    known = F.col("__d").isNotNull() & F.col(year).isNotNull()
    return out.withColumn("on_time", F.when(known, F.coalesce(F.col("__d") <= F.col("deadline"), F.lit(False)))).drop("__d", "__on", "deadline")


def refresh_mappings(existing: DataFrame, fixed: DataFrame, keys: Sequence[str] = ("entity_type", "raw_name")) -> DataFrame:
    """Fixed rows, and of the others those that collide with none of them on type
    and upper-case raw name."""
    kind, raw = keys
    taken = fixed.select(F.col(kind).alias("__k"), F.upper(raw).alias("__r")).distinct()
    kept = existing.join(small(taken), (F.col(kind) == F.col("__k")) & (F.upper(F.col(raw)) == F.col("__r")), "left_anti")
    return fixed.unionByName(kept, allowMissingColumns=True)
