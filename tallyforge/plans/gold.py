"""Dimensions, facts, marts and data-quality tables over the transaction and
report tables. Every builder is a function of DataFrames; where the data leaves a
choice open (any value, ties), the smallest is taken, so results are repeatable."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.scalars import category, cents, filled, has_word, parse_date, similarity, valid_name, week_start
from tallyforge.operators.aggregate import conditional_totals, edges
from tallyforge.operators.latest import continuity_failures, flag_latest, keep_latest, keep_top_rank, modal
from tallyforge.operators.matching import nearest_match, small

TEST_WORDS = ("TESTER", "TESTY")
NO_CANDIDATE = "NOT A CC"


def _have(df: DataFrame, *names: str) -> list[str]:
    return [n for n in names if n in df.columns]


def is_test_record(names: Sequence[str], texts: Sequence[str]) -> Column:
    out = F.lit(False)
    for n in names:
        out = out | has_word(F.col(n), *TEST_WORDS)
    for t in texts:
        out = out | (F.lower(F.trim(F.coalesce(F.col(t), F.lit("")))) == "test")
    return out


def fact_transaction(cf: DataFrame) -> DataFrame:
    """Transactions of the latest amendment: of rows alike in committee, name,
    cents, month and the other keys those with the highest amendment number; equal
    rows of that number are different transactions and all stay."""
    df = cf.filter(filled(F.col("committee_code")))
    keys: list[Column] = [F.col("committee_code"), F.trim(F.upper(F.coalesce("entity_name_normalized", F.lit("UNKNOWN")))), cents(F.col("amount")), F.trunc(parse_date(F.col("transaction_date")), "MM")]
    keys += [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in _have(df, "zip_code", "committee_type", "transaction_type", "entity_is_individual", "entity_zip", "schedule_type", "primary_or_general", "office_sought", "district")]
    df = keep_top_rank(df, keys, [F.coalesce("amendment_count", F.lit(0)).desc()])
    df = df.withColumn("transaction_category", category(F.col("schedule_type")))
    names = _have(df, "entity_name_normalized", "candidate_name_normalized", "committee_name_normalized")
    return df.withColumn("is_suspected_test_record", is_test_record(names, _have(df, "entity_address", "entity_city")))


def fact_report_summary(reports: DataFrame) -> DataFrame:
    """One report per committee and week of its due date: the latest amendment."""
    df = reports.filter(filled(F.col("committee_code"))).withColumn("due_day", parse_date(F.col("due_date"))).filter("due_day IS NOT NULL")
    order = [F.coalesce("amendment_count", F.lit(0)).desc(), F.col("report_date").desc_nulls_last(), F.col("folder_name").desc_nulls_last(), *[F.col(c) for c in _have(df, "report_row_id", "row_id")]]
    return keep_latest(df, ["committee_code", week_start(F.col("due_day"))], order)


def dim_candidate(cf: DataFrame, ties: Sequence[str]) -> DataFrame:
    """Each candidate's latest attributes, with all committee codes and the years."""
    df = cf.filter(filled(F.col("candidate_name_normalized")))
    order = [parse_date(F.col("report_date")).desc_nulls_last(), F.col("report_year").desc_nulls_last(), *[F.col(t) for t in ties]]
    last = keep_latest(df, ["candidate_name_normalized"], order).select("candidate_name_normalized", *_have(df, "office_sought", "district", "level", "party"), F.col("election_cycle").alias("most_recent_election_cycle"))
    codes = df.groupBy("candidate_name_normalized").agg(F.array_sort(F.collect_set("committee_code")).alias("committee_codes"), F.min("report_year").alias("first_year"), F.max("report_year").alias("last_year"))
    return last.join(codes, "candidate_name_normalized")


def dim_committee(cf: DataFrame, mappings: DataFrame) -> DataFrame:
    """Mapped committees with their most frequent attributes and years."""
    df = cf.filter(filled(F.col("committee_code")))
    usual = modal(df, ["committee_code"], ["committee_name", "committee_type", "party"]).withColumnRenamed("committee_name", "committee_name_raw")
    years = df.groupBy("committee_code").agg(F.min("report_year").alias("first_seen_year"), F.max("report_year").alias("last_seen_year"))
    out = mappings.withColumn("is_candidate_committee", F.col("candidate_name_normalized") != NO_CANDIDATE)
    return out.join(usual, "committee_code", "left").join(years, "committee_code", "left")


def dim_entity(cf: DataFrame, variations: DataFrame) -> DataFrame:
    """Each entity with whether it was ever an individual, one value of its other
    attributes, years, and its name variations."""
    each = cf.filter(filled(F.col("entity_name_normalized"))).groupBy("entity_name_normalized")
    base = each.agg(
        F.bool_or(F.coalesce("entity_is_individual", F.lit(False))).alias("is_individual"), *[F.min(c).alias(c) for c in _have(cf, "entity_employer", "entity_occupation", "entity_city", "entity_state")],
        F.min("report_year").alias("first_seen_year"), F.max("report_year").alias("last_seen_year"),
    )
    spelt = variations.groupBy(F.col("normalized_name").alias("entity_name_normalized")).agg(F.array_sort(F.collect_set("name_variation")).alias("name_variations"))
    return base.join(spelt, "entity_name_normalized", "left")


def dim_report(cf: DataFrame, columns: Sequence[str] = ("report_id", "committee_code", "committee_name", "candidate_name", "report_year", "report_date", "due_date", "amendment_count", "election_cycle", "primary_or_general", "data_source", "folder_name")) -> DataFrame:
    """Distinct reports; the latest of each committee and due date is marked."""
    df = cf.filter("report_id IS NOT NULL").select(*columns).distinct()
    ties = [F.col(c).asc_nulls_last() for c in columns if c not in ("committee_code", "due_date")]
    df = flag_latest(df, ["committee_code", "due_date"], [F.coalesce("amendment_count", F.lit(0)).desc(), F.col("report_date").desc_nulls_last(), *ties], "is_latest_amendment")
    return df.withColumn("is_amendment", F.col("amendment_count") > 0).withColumn("amendment_count", F.coalesce("amendment_count", F.lit(0)))


def candidate_cycle_totals(fact: DataFrame, keys: Sequence[str] = ("candidate_name_normalized", "election_cycle", "report_year", "office_sought", "district", "level", "party")) -> DataFrame:
    df = fact.filter(filled(F.col("candidate_name_normalized")) & ~F.col("is_suspected_test_record"))
    return conditional_totals(df, _have(df, *keys), "amount", "transaction_category", {"receipt": ("total_raised", "receipt_count"), "disbursement": ("total_spent", "disbursement_count")})


def donor_recipient_edges(fact: DataFrame) -> DataFrame:
    df = fact.filter(filled(F.col("entity_name_normalized")) & filled(F.col("committee_name_normalized")) & ~F.col("is_suspected_test_record")).withColumn("edge_type", F.col("transaction_category"))
    return edges(df, F.col("edge_type") == "receipt", "entity_name_normalized", "committee_name_normalized", ["edge_type", *_have(df, "election_cycle"), "report_year"], "amount")


def donor_totals(fact: DataFrame) -> DataFrame:
    """Totals of each donor to each committee."""
    df = fact.filter((F.col("transaction_category") == "receipt") & filled(F.col("entity_name_normalized")) & ~F.col("is_suspected_test_record")).withColumn("__d", parse_date(F.col("transaction_date")))
    return df.groupBy("candidate_name_normalized", "committee_code", "committee_name_normalized", "entity_name_normalized").agg(
        F.bool_or(F.coalesce("entity_is_individual", F.lit(False))).alias("entity_is_individual"), F.min("entity_employer").alias("entity_employer"), F.min("entity_occupation").alias("entity_occupation"),
        F.sum("amount").alias("total_amount"), F.count(F.lit(1)).alias("contribution_count"), F.min("__d").alias("first_contribution_date"), F.max("__d").alias("last_contribution_date"),
    )


def local_election_costs(reports: DataFrame, ties: Sequence[str] = ("report_id",)) -> DataFrame:
    """Spending by local race: each candidate's latest report, then aggregated."""
    df = reports.filter((F.col("level") == "local") & ~has_word(F.col("candidate_name_normalized"), *TEST_WORDS))
    df = keep_latest(df, ["candidate_name_normalized", "district_normal", "office_sought_normal", "election_cycle"], [parse_date(F.col("report_date")).desc_nulls_last(), *[F.col(t) for t in ties]])
    df = df.filter("total_disbursements > 0")
    return df.groupBy("election_cycle", "office_sought_normal", "district_normal").agg(
        F.max("total_disbursements").alias("max_disbursements"), F.avg("total_disbursements").alias("avg_disbursements"), F.sum("total_disbursements").alias("total_disbursements"), F.count_distinct("candidate_name_normalized").alias("num_candidates")
    )


def balance_failures(reports: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    """Reports that do not open with the balance the one before closed with, by
    parsed due date."""
    df = reports.withColumn("due_day", parse_date(F.col("due_date"))).withColumn("report_day", parse_date(F.col("report_date"))).filter("due_day IS NOT NULL")
    order = [F.col("due_day"), F.col("report_day").asc_nulls_first(), F.col("report_year").asc_nulls_first(), F.col("folder_name"), *[F.col(t) for t in ties]]
    return continuity_failures(df, ["committee_code"], order, "starting_balance", "ending_balance", ["report_date", "due_date"])


def suspicious_balances(reports: DataFrame) -> DataFrame:
    """Negative closing balances, and those that differ from line 19."""
    gap = F.abs(F.coalesce("ending_balance", F.lit(0.0)) - F.coalesce("line_19", "ending_balance"))
    df = reports.withColumn("line_19_discrepancy", gap).withColumn("negative_ending_balance", F.col("ending_balance") < 0).withColumn("line_19_mismatch", gap > 0.01)
    return df.filter("negative_ending_balance OR line_19_mismatch")


def suspected_test_records(fact: DataFrame) -> DataFrame:
    return fact.filter("is_suspected_test_record")


def build_mappings(cf: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(committee_mappings, name_variations): each code's most frequent valid names,
    and each spelling's normalised name, of several the longest."""
    named = cf.filter(filled(F.col("committee_code"))).select("committee_code", valid_name(F.col("committee_name_normalized")).alias("committee_name_normalized"), valid_name(F.col("candidate_name_normalized")).alias("candidate_name_normalized"))
    committees = modal(named.filter("committee_name_normalized <> ''"), ["committee_code"], ["committee_name_normalized"])
    candidates = modal(named.filter("candidate_name_normalized <> ''"), ["committee_code"], ["candidate_name_normalized"])
    mapping = committees.join(candidates, "committee_code", "left").withColumn("candidate_name_normalized", F.coalesce("candidate_name_normalized", F.lit(NO_CANDIDATE)))
    pairs = [cf.select(valid_name(F.col(a)).alias("name_variation"), valid_name(F.col(b)).alias("normalized_name")) for a, b in (("entity_name", "entity_name_normalized"), ("committee_name", "committee_name_normalized"))]
    pair = pairs[0].unionByName(pairs[1]).filter("name_variation <> '' AND normalized_name <> '' AND name_variation <> normalized_name")
    longest = pair.groupBy("name_variation").agg(F.max_by("normalized_name", F.struct(F.length("normalized_name").alias("n"), F.col("normalized_name").alias("v"))).alias("normalized_name"))
    return mapping, longest


#: What marks a payment as a contribution, and what rules it out.
CONTRIBUTION = r"\b(political|campaign)\s+contribution\b|\bcontribution\s+(to|for)\b|\bpac\s+contribution\b|\b(primary|general)\s+\d{4}\b|\bfundraiser\b|\bstate\s+committee\s+contribution\b|\bcontribution\b"
NO_CONTRIBUTION = r"\b(refund|share)\b"


def is_contribution(purpose: Column) -> Column:
    p = F.lower(purpose)
    return F.coalesce(p.rlike(CONTRIBUTION) & ~p.rlike(NO_CONTRIBUTION), F.lit(False))


def unmatched_contributions(cf: DataFrame, mappings: DataFrame, row: str, min_year: int = 2018, min_amount: float = 1000, payer_types: Sequence[str] | None = None, tolerance: float = 0.01, days: tuple[int, int] = (30, 60)) -> DataFrame:
    """Contributions paid that no recipient reports as received.

    A payment's recipient is the mapped committee of its name nearest in year; the
    receipt may stand under any code of that candidate, with the payer's name, the
    same amount and a date near the payment's, null dates passing."""
    from tallyforge.functions.scalars import code_year

    base = cf.filter((F.col("report_year") >= min_year) & (F.col("amount") >= min_amount)).withColumn("paid_on", parse_date(F.col("transaction_date")))
    paid = base.filter((F.col("schedule_type") == "ScheduleD") & is_contribution(F.col("purpose")) & (F.length("entity_name") > 1))
    if payer_types:
        paid = paid.filter(F.col("committee_type").isin(*payer_types))
    named = mappings.select(F.col("committee_name_normalized").alias("__name"), F.col("committee_code").alias("matched_code"), F.col("candidate_name_normalized").alias("matched_candidate"))
    distance = F.coalesce(F.abs(F.col("report_year") - code_year(F.col("matched_code"))), F.lit(9999))
    paid = nearest_match(paid.withColumn("__name", F.col("entity_name_normalized")), named, ["__name"], row, distance, [F.col("matched_code")])
    codes = mappings.filter(F.col("candidate_name_normalized") != NO_CANDIDATE).groupBy(F.col("candidate_name_normalized").alias("matched_candidate")).agg(F.array_sort(F.collect_set("committee_code")).alias("codes"))
    paid = paid.join(small(codes), "matched_candidate", "left").withColumn("codes", F.coalesce("codes", F.array("matched_code")))
    got = base.filter((F.col("schedule_type") == "ScheduleA") & (F.length("entity_name") > 5)).select(F.col("committee_code").alias("got_code"), F.col("entity_name_normalized").alias("got_from"), F.col("amount").alias("got_amount"), F.col("paid_on").alias("got_on"))
    # One row a code, so that the join hashes on payer and recipient: a payer of many payments is spread.
    each = paid.select(row, "committee_name_normalized", "amount", "paid_on", F.explode("codes").alias("code"))
    key = (F.col("committee_name_normalized") == F.col("got_from")) & (F.col("code") == F.col("got_code"))
    met = each.join(got, key & _close(tolerance) & _timely(days), "left_semi").select(row).distinct()
    return paid.join(met, row, "left_anti").drop("__name")


def _close(tolerance: float) -> Column:
    return F.abs(F.col("amount") - F.col("got_amount")) <= tolerance


def _timely(days: tuple[int, int]) -> Column:
    """The receipt's date near the payment's; a null date passes."""
    return F.col("paid_on").isNull() | F.col("got_on").isNull() | F.col("got_on").between(F.date_sub("paid_on", days[0]), F.date_add("paid_on", days[1]))


def failure_reasons(unmatched: DataFrame, receipts: DataFrame, row: str, tolerance: float = 0.01, days: tuple[int, int] = (30, 60), alike: float = 0.8) -> DataFrame:
    """(row, reason, best_name): why a payment has no receipt under the codes of the
    matched candidate: none at all from the payer (`no_receipts`), or whether some
    receipt is near the date and whether some has the amount. For `no_receipts`
    best_name is the most similar name of a payer under these codes, from `alike` on.

    receipts: got_code, got_from, got_amount, got_on. Payments meet the receipts of
    one payer and code, counted by amount and day, and the distinct names of a code."""
    each = unmatched.select(row, "committee_name_normalized", "amount", "paid_on", F.explode("codes").alias("code"))
    distinct = receipts.select("got_code", "got_from", "got_amount", "got_on").distinct()
    key = (F.col("committee_name_normalized") == F.col("got_from")) & (F.col("code") == F.col("got_code"))
    flags = each.join(distinct, key).groupBy(row).agg(F.bool_or(_close(tolerance)).alias("amount_ok"), F.bool_or(_timely(days)).alias("date_ok"), F.lit(True).alias("any"))
    yes = lambda c: F.when(F.coalesce(F.col(c), F.lit(False)), "yes").otherwise("no")
    out = unmatched.select(row, "committee_name_normalized", "codes").join(flags, row, "left")
    out = out.withColumn("reason", F.when(F.col("any").isNull(), "no_receipts").otherwise(F.concat(F.lit("date_"), yes("date_ok"), F.lit("_amount_"), yes("amount_ok"))))
    asked = out.filter("any IS NULL").select("committee_name_normalized", F.explode("codes").alias("got_code")).distinct()
    names = receipts.select("got_code", "got_from").distinct()
    score = similarity(F.col("committee_name_normalized"), F.col("got_from"))
    close = asked.join(names, "got_code").withColumn("score", score).filter(F.col("score") >= alike)
    best = close.groupBy("committee_name_normalized", "got_code").agg(F.max(F.struct("score", "got_from")).alias("b"))
    per_row = out.filter("any IS NULL").select(row, "committee_name_normalized", F.explode("codes").alias("got_code")).join(best, ["committee_name_normalized", "got_code"])
    named = per_row.groupBy(row).agg(F.max("b").getField("got_from").alias("best_name"))
    return out.join(named, row, "left").select(row, "reason", "best_name")


def latest_balances(reports: DataFrame, as_of: Column | None = None, ties: Sequence[str] = ("row_id",)) -> DataFrame:
    """Each committee's latest report with a balance, and whether it is older than
    90 days."""
    df = reports.filter("ending_balance IS NOT NULL").withColumn("report_day", parse_date(F.col("report_date")))
    df = keep_latest(df, ["committee_code"], [F.col("report_day").desc_nulls_last(), *[F.col(t) for t in ties]])
    return df.withColumn("is_stale", F.col("report_day") < F.date_sub(as_of if as_of is not None else F.current_date(), 90))


def local_disbursements(reports: DataFrame, places: DataFrame | None = None, districts: Sequence[str] = (), offices: Sequence[str] = (), office_likes: Sequence[str] = (), cycle_likes: Sequence[str] = (), ties: Sequence[str] = ("row_id",)) -> DataFrame:
    """The latest report of each candidate and race, of the races asked for, with
    its county if `places` (place, county, ordinal) is given.

    districts: parts of a district's name, any of which may be in it. offices: whole
    names. office_likes and cycle_likes: LIKE patterns, any of which may fit; a race
    without a cycle passes the last."""
    from tallyforge.operators.matching import contains_lookup

    df = reports.filter(F.col("total_disbursements").isNotNull())
    if districts:
        df = df.filter(F.exists(F.array(*[F.lit(x) for x in districts]), lambda x: F.lower("district").contains(F.lower(x))))
    if offices:
        df = df.filter(F.array_contains(F.array(*[F.lit(o.lower()) for o in offices]), F.lower("office_sought")))
    for column, likes, none in (("office_sought", office_likes, False), ("election_cycle", cycle_likes, True)):
        if likes:
            hit = F.lit(False)
            for pattern in likes:
                hit = hit | F.coalesce(F.lower(column).like(pattern.lower()), F.lit(False))
            df = df.filter(hit | F.col(column).isNull() if none else hit)
    df = keep_latest(df, ["candidate_name", "district", "office_sought", "election_cycle"], [parse_date(F.col("report_date")).desc_nulls_last(), *[F.col(t) for t in ties]])
    if places is None:
        return df
    df = contains_lookup(df, places, "district", "place", "ordinal", "county", ties[0])
    return df


def county_totals(rows: DataFrame) -> DataFrame:
    """Races, candidates and spending of each county; races without one together."""
    return rows.groupBy("county").agg(F.count_distinct("office_sought", "district").alias("races"), F.count_distinct("candidate_name").alias("candidates"), F.sum("total_disbursements").alias("total_disbursements"))


def race_totals(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Greatest, mean and summed spending and the number of rows of each race; races
    with a null key are left out."""
    df = rows.dropna(subset=list(keys))
    return df.groupBy(*keys).agg(F.max("total_disbursements").alias("max_disbursements"), F.avg("total_disbursements").alias("avg_disbursements"), F.sum("total_disbursements").alias("total_disbursements"), F.count(F.lit(1)).alias("reports"))
