"""Queries of the training-data problems by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions.timestamps import local_day, with_instant
from tallyforge.llm import addresses, bpe, currency, mixture, moderation, names, topn


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return addresses.same_location(_read(spark, sf_dir, "transactions"))


def p1_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row with a location, its location's first row and number of rows."""
    return addresses.location_classes(_read(spark, sf_dir, "transactions"))


#: The fields a filing's survivor is filled in for.
FILING_FIELDS = ["committee_name", "candidate_name", "election_cycle"]


def _filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dim_report with its filing key (code, due_day) and report_date as instant."""
    df = with_instant(with_instant(_read(spark, sf_dir, "dim_report"), "due_date", "due"), "report_date", "reported")
    df = df.withColumn("code", F.upper(F.trim("committee_code"))).withColumn("due_day", local_day(F.col("due")))
    return df.filter("code <> '' AND due_day IS NOT NULL")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    declared = [F.coalesce("amendment_count", F.lit(0)), F.col("reported")]
    best = currency.survivors(_filings(spark, sf_dir), ["code", "due_day"], declared, FILING_FIELDS, "report_row_id")
    return best.select(F.col("code").alias("committee_code"), "due_day", F.col("survivor").alias("survivor_row_id"), *[F.col(f"{f}_row").alias(f"{f}_row_id") for f in FILING_FIELDS])


def p4_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As p4_found, but a record without amendment number has the number in force on
    its report date, and records without readable report date are placed among the
    others (of their number, if they have one) by the precedence of committee names
    learnt from timestamped records."""
    df = _filings(spark, sf_dir)
    steps = currency.transitions(df, ["code", "due_day"], "reported", "committee_name", "report_row_id")
    level = currency.levels(currency.precedence(steps)).select(F.col("value").alias("committee_name"), "level")
    df = df.join(level, "committee_name", "left")
    df = currency.in_force(df, ["code", "due_day"], "amendment_count", "reported", "number")
    declared = [F.col("number"), F.col("reported")]
    best = currency.survivors(df, ["code", "due_day"], declared, FILING_FIELDS, "report_row_id", learnt=F.col("level"))
    return best.select(F.col("code").alias("committee_code"), "due_day", F.col("survivor").alias("survivor_row_id"), *[F.col(f"{f}_row").alias(f"{f}_row_id") for f in FILING_FIELDS])


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topn.top_n(_read(spark, sf_dir, "top_donors"), "committee_code", "total_amount", 5, "entity_name_normalized", "donor_row_id")


P6_SQL = """
WITH first AS (
  SELECT upper(trim(committee_code)) AS code, total_amount, entity_name_normalized AS name, donor_row_id,
         row_number() OVER (PARTITION BY upper(trim(committee_code)), entity_name_normalized ORDER BY total_amount DESC, donor_row_id) AS rn
  FROM top_donors WHERE trim(committee_code) <> '' AND total_amount IS NOT NULL AND NOT isnan(total_amount)
), placed AS (
  SELECT code, donor_row_id, row_number() OVER (PARTITION BY code ORDER BY total_amount DESC, name ASC NULLS FIRST, donor_row_id) AS place FROM first WHERE rn = 1
)
SELECT code AS committee_code, place, donor_row_id FROM placed WHERE place <= 5
"""


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names.same_names(_read(spark, sf_dir, "fact_transaction"))


def p7_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every name with its class and the number of the class's spellings."""
    return names.name_classes(_read(spark, sf_dir, "fact_transaction"))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded(_read(spark, sf_dir, "documents"))


def p8_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and tokens by source as written."""
    sizes = bpe.counted(_read(spark, sf_dir, "documents"), keep=("source",))
    return sizes.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.sum("tokens").alias("tokens"))


#: Weights by time: the small sources, which are used several times, rise.
CURRICULUM = {"help_desk": ((0.0, 0.5), (1.0, 1.5)), "treasurer_memos": ((0.0, 0.5), (0.5, 0.5), (1.0, 2.0)), "filing_notes": ((0.0, 1.5), (1.0, 0.5))}


def p9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixture in training order: position, doc_id, source, round, tokens."""
    return mixture.mixture(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "source_targets"), schedule=CURRICULUM)[0]


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and actual share of every listed source."""
    return mixture.mixture(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "source_targets"), schedule=CURRICULUM)[1]


def _moderated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return moderation.moderated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "moderation_labels"), keep=("source",))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _moderated(spark, sf_dir).filter(F.col("score") >= moderation.THRESHOLD).select("doc_id")


def p10_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of every document."""
    return _moderated(spark, sf_dir).select("doc_id", "score")


def p10_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, those found and their rate by source."""
    found = F.sum((F.col("score") >= moderation.THRESHOLD).cast("long"))
    rates = _moderated(spark, sf_dir).groupBy(mixture.source_key(F.col("source")).alias("source")).agg(F.count(F.lit(1)).alias("documents"), found.alias("found"))
    return rates.withColumn("rate", F.col("found") / F.col("documents"))


QUERIES = {
    "p1_found": p1_found,
    "p1_classes": p1_classes,
    "p4_found": p4_found,
    "p4_current": p4_current,
    "p6_found": p6_found,
    "p7_found": p7_found,
    "p7_classes": p7_classes,
    "p8_ids": p8_ids,
    "p8_counts": p8_counts,
    "p9_mixture": p9_mixture,
    "p9_shares": p9_shares,
    "p10_found": p10_found,
    "p10_scores": p10_scores,
    "p10_rates": p10_rates,
}
ORACLE: dict[str, str] = {"p6_found": P6_SQL}
