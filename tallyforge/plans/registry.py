"""Queries of the operators by name, with the SQL each is checked against.

They run over the whole tables of a directory. Sums of money are rounded to
cents, as the order of additions differs between engines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions import normalize
from tallyforge.functions.scalars import cents, code_year, first_filled, money, parse_date, similarity, title_case, week_start
from tallyforge.operators import aggregate as A
from tallyforge.operators import latest as L
from tallyforge.operators import matching as M
from tallyforge.plans import gold, oracles, silver, surface
from tallyforge.sources import files, rejects
from tallyforge.streaming import amendments

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def add(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql
        return fn

    return add


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def two(c: str | Column) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 2)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: two(c) for c in columns})


#: SQL of the shared expressions.
def date_sql(c: str) -> str:
    clock = "([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]"
    return f"""CASE WHEN regexp_matches({c}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}[ T]{clock}') THEN CAST(try_strptime({c}[1:10], '%Y-%m-%d') AS DATE)
      WHEN regexp_matches({c}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') THEN CAST(try_strptime({c}, '%Y-%m-%d') AS DATE)
      WHEN regexp_matches({c}, '^[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}') THEN CAST(try_strptime(split_part({c}, ' ', 1), '%m/%d/%Y') AS DATE)
      WHEN regexp_matches({c}, '^[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{2}}$') THEN CAST(try_strptime({c}, '%m/%d/%y') AS DATE) END"""


TEST_SQL = " OR ".join([f"regexp_matches(coalesce({c}, ''), '\\b(TESTER|TESTY)\\b')" for c in ("entity_name_normalized", "candidate_name_normalized", "committee_name_normalized")] + [f"lower(trim(coalesce({c}, ''))) = 'test'" for c in ("entity_address", "entity_city")])
FACT_SQL = f"""WITH ranked AS (
  SELECT *, rank() OVER (PARTITION BY committee_code, trim(upper(coalesce(entity_name_normalized, 'UNKNOWN'))), CAST(round(coalesce(amount, 0) * 100, 0) AS BIGINT),
    date_trunc('month', {date_sql("transaction_date")}), coalesce(zip_code, ''), coalesce(committee_type, ''), coalesce(transaction_type, ''), coalesce(CAST(entity_is_individual AS VARCHAR), ''),
    coalesce(entity_zip, ''), coalesce(schedule_type, ''), coalesce(primary_or_general, ''), coalesce(office_sought, ''), coalesce(district, '') ORDER BY coalesce(amendment_count, 0) DESC) AS rk
  FROM campaign_finance WHERE committee_code IS NOT NULL AND committee_code <> ''
), fact AS (
  SELECT *, CASE WHEN schedule_type IN ('ScheduleA', 'ScheduleB', 'ScheduleC') THEN 'receipt' WHEN schedule_type IN ('ScheduleD', 'ScheduleF', 'ScheduleI') THEN 'disbursement' ELSE 'unknown' END AS transaction_category,
    ({TEST_SQL}) AS is_suspected_test_record FROM ranked WHERE rk = 1)
"""


def fact(spark: SparkSession, d: str) -> DataFrame:
    return gold.fact_transaction(t(spark, d, "campaign_finance"))


@query(FACT_SQL + "SELECT row_id, committee_code, transaction_category, amount, is_suspected_test_record FROM fact")
def fact_transaction(spark: SparkSession, d: str) -> DataFrame:
    return fact(spark, d).select("row_id", "committee_code", "transaction_category", "amount", "is_suspected_test_record")


@query(FACT_SQL + """SELECT candidate_name_normalized, election_cycle, report_year, office_sought, district, level, party,
  round(sum(CASE WHEN transaction_category = 'receipt' THEN amount ELSE 0 END), 2) AS total_raised, round(sum(CASE WHEN transaction_category = 'disbursement' THEN amount ELSE 0 END), 2) AS total_spent,
  CAST(count(*) FILTER (transaction_category = 'receipt') AS BIGINT) AS receipt_count, CAST(count(*) FILTER (transaction_category = 'disbursement') AS BIGINT) AS disbursement_count
  FROM fact WHERE candidate_name_normalized IS NOT NULL AND candidate_name_normalized <> '' AND NOT is_suspected_test_record GROUP BY ALL""")
def candidate_cycle_totals(spark: SparkSession, d: str) -> DataFrame:
    return rounded(gold.candidate_cycle_totals(fact(spark, d)), "total_raised", "total_spent")


@query(FACT_SQL + f"""SELECT candidate_name_normalized, committee_code, committee_name_normalized, entity_name_normalized, bool_or(coalesce(entity_is_individual, false)) AS entity_is_individual,
  min(entity_employer) AS entity_employer, min(entity_occupation) AS entity_occupation, round(sum(amount), 2) AS total_amount, count(*) AS contribution_count,
  min({date_sql("transaction_date")}) AS first_contribution_date, max({date_sql("transaction_date")}) AS last_contribution_date
  FROM fact WHERE transaction_category = 'receipt' AND entity_name_normalized IS NOT NULL AND entity_name_normalized <> '' AND NOT is_suspected_test_record
  GROUP BY candidate_name_normalized, committee_code, committee_name_normalized, entity_name_normalized""")
def donor_totals(spark: SparkSession, d: str) -> DataFrame:
    return rounded(gold.donor_totals(fact(spark, d)), "total_amount")


@query(FACT_SQL + """SELECT CASE WHEN transaction_category = 'receipt' THEN entity_name_normalized ELSE committee_name_normalized END AS source_name,
  CASE WHEN transaction_category = 'receipt' THEN committee_name_normalized ELSE entity_name_normalized END AS target_name, transaction_category AS edge_type, election_cycle, report_year,
  round(sum(amount), 2) AS total_amount, count(*) AS transaction_count
  FROM fact WHERE entity_name_normalized <> '' AND committee_name_normalized <> '' AND NOT is_suspected_test_record GROUP BY ALL""")
def donor_recipient_edges(spark: SparkSession, d: str) -> DataFrame:
    return rounded(gold.donor_recipient_edges(fact(spark, d)), "total_amount")


@query("SELECT id, entity_name_normalized, entity_address, entity_city FROM transactions WHERE " + " OR ".join([f"regexp_matches(coalesce({c}, ''), '\\b(TESTER|TESTY)\\b')" for c in ("entity_name_normalized", "candidate_name_normalized")] + [f"lower(trim(coalesce({c}, ''))) = 'test'" for c in ("entity_address", "entity_city")]))
def suspected_test_records(spark: SparkSession, d: str) -> DataFrame:
    flag = gold.is_test_record(["entity_name_normalized", "candidate_name_normalized"], ["entity_address", "entity_city"])
    return gold.suspected_test_records(t(spark, d, "transactions").withColumn("is_suspected_test_record", flag)).select("id", "entity_name_normalized", "entity_address", "entity_city")


@query(f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY candidate_name_normalized ORDER BY {date_sql("report_date")} DESC NULLS LAST, report_year DESC NULLS LAST, row_id) AS rn
    FROM campaign_finance WHERE candidate_name_normalized <> ''),
  c AS (SELECT candidate_name_normalized, array_to_string(list_sort(list(DISTINCT committee_code) FILTER (committee_code IS NOT NULL)), '|') AS committee_codes, min(report_year) AS first_year, max(report_year) AS last_year
    FROM campaign_finance WHERE candidate_name_normalized <> '' GROUP BY 1)
  SELECT r.candidate_name_normalized, office_sought, district, level, party, election_cycle AS most_recent_election_cycle, coalesce(committee_codes, '') AS committee_codes, first_year, last_year FROM r JOIN c USING (candidate_name_normalized) WHERE rn = 1""")
def dim_candidate(spark: SparkSession, d: str) -> DataFrame:
    return gold.dim_candidate(t(spark, d, "campaign_finance"), ["row_id"]).withColumn("committee_codes", F.array_join("committee_codes", "|"))


VALID_SQL = "CASE WHEN length(trim(coalesce({c}, ''))) < 2 OR upper(trim({c})) IN ('NAN', 'NONE', 'NULL', 'N/A', 'NA', 'UNKNOWN', 'TEST') OR regexp_full_match(trim({c}), '[0-9\\W_]+') THEN '' ELSE trim({c}) END"
MAPPING_SQL = f"""WITH n AS (SELECT committee_code, {VALID_SQL.format(c="committee_name_normalized")} AS cn, {VALID_SQL.format(c="candidate_name_normalized")} AS pn FROM campaign_finance WHERE committee_code <> ''),
  a AS (SELECT committee_code, cn, row_number() OVER (PARTITION BY committee_code ORDER BY count(*) DESC, cn) AS rn FROM n WHERE cn <> '' GROUP BY 1, 2),
  b AS (SELECT committee_code, pn, row_number() OVER (PARTITION BY committee_code ORDER BY count(*) DESC, pn) AS rn FROM n WHERE pn <> '' GROUP BY 1, 2),
  mapping AS (SELECT a.committee_code, a.cn AS committee_name_normalized, coalesce(b.pn, 'NOT A CC') AS candidate_name_normalized FROM (SELECT * FROM a WHERE rn = 1) a LEFT JOIN (SELECT * FROM b WHERE rn = 1) b USING (committee_code))
"""


@query(MAPPING_SQL + "SELECT * FROM mapping")
def committee_mappings(spark: SparkSession, d: str) -> DataFrame:
    return gold.build_mappings(t(spark, d, "campaign_finance"))[0]


VARIATION_SQL = f"""WITH p AS (SELECT {VALID_SQL.format(c="entity_name")} AS v, {VALID_SQL.format(c="entity_name_normalized")} AS n FROM campaign_finance
    UNION ALL SELECT {VALID_SQL.format(c="committee_name")}, {VALID_SQL.format(c="committee_name_normalized")} FROM campaign_finance),
  q AS (SELECT v AS name_variation, n AS normalized_name, row_number() OVER (PARTITION BY v ORDER BY length(n) DESC, n DESC) AS rn FROM p WHERE v <> '' AND n <> '' AND v <> n)
"""


@query(VARIATION_SQL + "SELECT name_variation, normalized_name FROM q WHERE rn = 1")
def name_variations(spark: SparkSession, d: str) -> DataFrame:
    return gold.build_mappings(t(spark, d, "campaign_finance"))[1]


@query(MAPPING_SQL + """, counts AS (SELECT committee_code, committee_name, committee_type, party, row_number() OVER (PARTITION BY committee_code ORDER BY count(*) DESC, committee_name NULLS LAST, committee_type NULLS LAST, party NULLS LAST) AS rn
    FROM campaign_finance WHERE committee_code <> '' GROUP BY 1, 2, 3, 4),
  years AS (SELECT committee_code, min(report_year) AS first_seen_year, max(report_year) AS last_seen_year FROM campaign_finance WHERE committee_code <> '' GROUP BY 1)
  SELECT m.*, candidate_name_normalized <> 'NOT A CC' AS is_candidate_committee, committee_name AS committee_name_raw, committee_type, party, first_seen_year, last_seen_year
  FROM mapping m LEFT JOIN (SELECT * FROM counts WHERE rn = 1) c USING (committee_code) LEFT JOIN years USING (committee_code)""".replace("SELECT m.*, candidate", "SELECT m.committee_code, m.committee_name_normalized, m.candidate_name_normalized, candidate").replace("committee_type, party, first", "c.committee_type, c.party, first").replace("c.committee_type, c.party, c.", "c.committee_type, c.party, ").replace("SELECT committee_code, committee_name, c.committee_type", "SELECT committee_code, committee_name, committee_type"))
def dim_committee(spark: SparkSession, d: str) -> DataFrame:
    cf = t(spark, d, "campaign_finance")
    out = gold.dim_committee(cf, gold.build_mappings(cf)[0])
    return out.select("committee_code", "committee_name_normalized", "candidate_name_normalized", "is_candidate_committee", "committee_name_raw", "committee_type", "party", "first_seen_year", "last_seen_year")


@query(VARIATION_SQL + """, v AS (SELECT normalized_name, array_to_string(list_sort(list(DISTINCT name_variation)), '|') AS name_variations FROM q WHERE rn = 1 GROUP BY 1)
  SELECT entity_name_normalized, bool_or(coalesce(entity_is_individual, false)) AS is_individual, min(entity_employer) AS entity_employer, min(entity_city) AS entity_city, min(report_year) AS first_seen_year, max(report_year) AS last_seen_year, any_value(name_variations) AS name_variations
  FROM campaign_finance LEFT JOIN v ON entity_name_normalized = normalized_name WHERE entity_name_normalized <> '' GROUP BY 1""")
def dim_entity(spark: SparkSession, d: str) -> DataFrame:
    cf = t(spark, d, "campaign_finance")
    out = gold.dim_entity(cf, gold.build_mappings(cf)[1])
    return out.select("entity_name_normalized", "is_individual", "entity_employer", "entity_city", "first_seen_year", "last_seen_year", F.array_join("name_variations", "|").alias("name_variations"))


REPORT_COLUMNS = "report_id, committee_code, committee_name, candidate_name, report_year, report_date, due_date, amendment_count, election_cycle, primary_or_general, data_source, folder_name"
REPORT_ORDER = "coalesce(amendment_count, 0) DESC, report_date DESC NULLS LAST, report_id NULLS LAST, committee_name NULLS LAST, candidate_name NULLS LAST, report_year NULLS LAST, report_date NULLS LAST, amendment_count NULLS LAST, election_cycle NULLS LAST, primary_or_general NULLS LAST, data_source NULLS LAST, folder_name NULLS LAST"


@query(f"""WITH r AS (SELECT DISTINCT {REPORT_COLUMNS} FROM campaign_finance WHERE report_id IS NOT NULL)
  SELECT {REPORT_COLUMNS.replace("amendment_count", "coalesce(amendment_count, 0) AS amendment_count")}, amendment_count > 0 AS is_amendment, row_number() OVER (PARTITION BY committee_code, due_date ORDER BY {REPORT_ORDER}) = 1 AS is_latest_amendment FROM r""")
def dim_report(spark: SparkSession, d: str) -> DataFrame:
    return gold.dim_report(t(spark, d, "campaign_finance"))


SUMMARY_SQL = f"""WITH p AS (SELECT *, {date_sql("due_date")} AS due_day FROM dim_report WHERE committee_code <> ''),
  s AS (SELECT *, row_number() OVER (PARTITION BY committee_code, date_trunc('week', due_day) ORDER BY coalesce(amendment_count, 0) DESC, report_date DESC NULLS LAST, folder_name DESC NULLS LAST, report_row_id) AS rn FROM p WHERE due_day IS NOT NULL)
"""


@query(SUMMARY_SQL + "SELECT report_row_id, committee_code, due_day, report_date, folder_name FROM s WHERE rn = 1")
def report_summary(spark: SparkSession, d: str) -> DataFrame:
    return gold.fact_report_summary(t(spark, d, "dim_report")).select("report_row_id", "committee_code", "due_day", "report_date", "folder_name")


def _balances(spark: SparkSession, d: str) -> DataFrame:
    """Schedule H as one table, with the columns the balance checks use."""
    from tallyforge.sources import drift

    df = drift.unified(t(spark, d, "schedule_h"), drift.SCHEDULE_H)
    office = normalize.office(F.col("office_sought"))
    df = df.withColumn("candidate_name_normalized", normalize.name(F.col("candidate_name"), True)).withColumn("office_sought_normal", office).withColumn("election_cycle", F.concat(F.lit("11/"), F.col("report_year").cast("string")))
    df = df.withColumn("level", normalize.level(office, F.col("district")))
    return df.withColumn("district_normal", normalize.district(F.col("district"), None, F.col("level"), F.col("office_sought")))


@query()
def balance_continuity(spark: SparkSession, d: str) -> DataFrame:
    """Schedule H reports that do not open with the balance before."""
    df = gold.balance_failures(gold.fact_report_summary(_balances(spark, d)), ["row_id"])
    return rounded(df.select("row_id", "committee_code", "due_day", "previous_due_date", "starting_balance", "previous_ending_balance", "discrepancy"), "discrepancy")


@query(oracles.balances_sql(date_sql) + f""", b AS (SELECT *, {date_sql("report_date")} AS report_day, CAST(date_trunc('week', due_day) AS DATE) AS week FROM s WHERE starting_balance IS NOT NULL AND ending_balance IS NOT NULL),
  p AS (SELECT *, lag(ending_balance) OVER x AS previous_ending_balance, lag(line_19) OVER x AS previous_line_19, row_number() OVER x AS sequence FROM b WINDOW x AS (PARTITION BY committee_code ORDER BY week, due_day, report_day NULLS FIRST, report_year NULLS FIRST, row_id))
  SELECT row_id, committee_code, week, previous_line_19, round(starting_balance - previous_ending_balance, 2) AS discrepancy FROM p WHERE sequence > 1 AND abs(starting_balance - previous_ending_balance) > 0.01""")
def balance_continuity_weeks(spark: SparkSession, d: str) -> DataFrame:
    """As balance_continuity in the order of weeks, with line 19 of the report before."""
    df = gold.fact_report_summary(_balances(spark, d)).withColumn("report_day", parse_date(F.col("report_date"))).withColumn("week", week_start(F.col("due_day")))
    order = [F.col("week"), F.col("due_day"), F.col("report_day").asc_nulls_first(), F.col("report_year").asc_nulls_first(), F.col("row_id")]
    out = L.continuity_failures(df, ["committee_code"], order, "starting_balance", "ending_balance", ["line_19"])
    return rounded(out.select("row_id", "committee_code", "week", "previous_line_19", "discrepancy"), "discrepancy")


@query()
def suspicious_balances(spark: SparkSession, d: str) -> DataFrame:
    df = gold.suspicious_balances(gold.fact_report_summary(_balances(spark, d)))
    return rounded(df.select("row_id", "committee_code", "ending_balance", "line_19", "line_19_discrepancy", "negative_ending_balance", "line_19_mismatch"), "line_19_discrepancy")


@query()
def local_election_costs(spark: SparkSession, d: str) -> DataFrame:
    return rounded(gold.local_election_costs(gold.fact_report_summary(_balances(spark, d)), ["row_id"]), "total_disbursements").withColumn("avg_disbursements", F.round("avg_disbursements", 4))


@query()
def local_disbursements(spark: SparkSession, d: str) -> DataFrame:
    """Latest reports of local races whose office fits, by pattern and cycle."""
    df = gold.local_disbursements(_balances(spark, d), office_likes=["%board%", "mayor", "%sheriff%"], cycle_likes=["%/2018%", "%/2019%", "%/202_%"])
    return df.select("row_id", "candidate_name", "office_sought", "district", "election_cycle", "total_disbursements")


@query()
def county_totals(spark: SparkSession, d: str) -> DataFrame:
    places = spark.createDataFrame([("1", "first", 1), ("at large", "whole", 2), ("2", "second", 3)], "place string, county string, ordinal int")
    return rounded(gold.county_totals(gold.local_disbursements(_balances(spark, d), places)), "total_disbursements")


@query()
def race_totals(spark: SparkSession, d: str) -> DataFrame:
    df = rounded(gold.race_totals(_balances(spark, d), ["office_sought", "district"]), "total_disbursements")
    return df.withColumn("avg_disbursements", F.round("avg_disbursements", 4))


@query()
def latest_balances(spark: SparkSession, d: str) -> DataFrame:
    df = gold.latest_balances(_balances(spark, d), F.lit("2025-12-31").cast("date"))
    return df.select("committee_code", "row_id", "report_day", "ending_balance", "is_stale")


UNMATCHED_SQL = f"""WITH names AS (SELECT committee_code, entity_name_normalized AS name, row_number() OVER (PARTITION BY committee_code ORDER BY count(*) DESC, entity_name_normalized) AS rn FROM campaign_finance WHERE committee_code <> '' AND entity_name_normalized <> '' GROUP BY 1, 2),
  mapping AS (SELECT committee_code, name AS committee_name_normalized, name AS candidate_name_normalized FROM names WHERE rn = 1),
  base AS (SELECT *, {date_sql("transaction_date")} AS paid_on FROM campaign_finance WHERE report_year >= 2010 AND amount >= 100),
  dd AS (SELECT * FROM base WHERE schedule_type = 'ScheduleD' AND regexp_matches(lower(purpose), '{gold.CONTRIBUTION}') AND NOT regexp_matches(lower(purpose), '{gold.NO_CONTRIBUTION}') AND length(entity_name) > 1),
  m AS (SELECT dd.*, mp.committee_code AS matched_code, mp.candidate_name_normalized AS matched_candidate, row_number() OVER (PARTITION BY row_id ORDER BY
      coalesce(abs(dd.report_year - CASE WHEN TRY_CAST(regexp_extract(mp.committee_code, '^CC-([0-9]{{2}})-', 1) AS INT) < 50 THEN 2000 + TRY_CAST(regexp_extract(mp.committee_code, '^CC-([0-9]{{2}})-', 1) AS INT) ELSE 1900 + TRY_CAST(regexp_extract(mp.committee_code, '^CC-([0-9]{{2}})-', 1) AS INT) END), 9999), mp.committee_code) AS rn
    FROM dd JOIN mapping mp ON mp.committee_name_normalized = dd.entity_name_normalized),
  k AS (SELECT candidate_name_normalized AS c, list(DISTINCT committee_code) AS codes FROM mapping GROUP BY 1),
  received AS (SELECT * FROM base WHERE schedule_type = 'ScheduleA' AND length(entity_name) > 5)
"""


def _payees(cf: DataFrame) -> DataFrame:
    """For these tables, whose payments go to people: each committee's usual donor
    stands for it."""
    named = L.modal(cf.filter("committee_code <> '' AND entity_name_normalized <> ''"), ["committee_code"], ["entity_name_normalized"])
    return named.select("committee_code", F.col("entity_name_normalized").alias("committee_name_normalized"), F.col("entity_name_normalized").alias("candidate_name_normalized"))


@query(UNMATCHED_SQL + """SELECT row_id, matched_code, matched_candidate, amount FROM (SELECT m.*, coalesce(k.codes, [m.matched_code]) AS codes FROM m LEFT JOIN k ON k.c = m.matched_candidate WHERE rn = 1) x
  WHERE NOT EXISTS (SELECT 1 FROM received a WHERE list_contains(x.codes, a.committee_code) AND a.entity_name_normalized = x.committee_name_normalized AND abs(a.amount - x.amount) <= 0.01
    AND (x.paid_on IS NULL OR a.paid_on IS NULL OR a.paid_on BETWEEN x.paid_on - 30 AND x.paid_on + 60))""")
def unmatched_contributions(spark: SparkSession, d: str) -> DataFrame:
    cf = t(spark, d, "campaign_finance")
    return gold.unmatched_contributions(cf, _payees(cf), "row_id", 2010, 100).select("row_id", "matched_code", "matched_candidate", "amount")


@query(UNMATCHED_SQL + """, x AS (SELECT m.*, coalesce(k.codes, [m.matched_code]) AS codes FROM m LEFT JOIN k ON k.c = m.matched_candidate WHERE rn = 1),
  u AS (SELECT row_id, committee_name_normalized AS payer, amount, paid_on, codes FROM x WHERE NOT EXISTS (SELECT 1 FROM received a WHERE list_contains(x.codes, a.committee_code) AND a.entity_name_normalized = x.committee_name_normalized AND abs(a.amount - x.amount) <= 0.01
    AND (x.paid_on IS NULL OR a.paid_on IS NULL OR a.paid_on BETWEEN x.paid_on - 30 AND x.paid_on + 60))),
  g AS (SELECT DISTINCT committee_code, entity_name_normalized AS payee, amount, paid_on FROM received),
  e AS (SELECT row_id, payer, amount, paid_on, unnest(codes) AS code FROM u),
  f AS (SELECT e.row_id, bool_or(abs(g.amount - e.amount) <= 0.01) AS a, bool_or(e.paid_on IS NULL OR g.paid_on IS NULL OR g.paid_on BETWEEN e.paid_on - 30 AND e.paid_on + 60) AS d FROM e JOIN g ON g.committee_code = e.code AND g.payee = e.payer GROUP BY 1),
  y AS (SELECT e.row_id, payee, (greatest(length(payer), length(payee)) - levenshtein(payer, payee)) / greatest(length(payer), length(payee)) AS score FROM e JOIN (SELECT DISTINCT committee_code, payee FROM g) g ON g.committee_code = e.code WHERE payer <> '' AND payee <> ''),
  z AS (SELECT row_id, max_by(payee, struct_pack(s := score, p := payee)) AS best_name FROM y WHERE score >= 0.8 GROUP BY 1)
  SELECT u.row_id, CASE WHEN f.row_id IS NULL THEN 'no_receipts' ELSE 'date_' || CASE WHEN d THEN 'yes' ELSE 'no' END || '_amount_' || CASE WHEN a THEN 'yes' ELSE 'no' END END AS reason, CASE WHEN f.row_id IS NULL THEN best_name END AS best_name FROM u LEFT JOIN f USING (row_id) LEFT JOIN z USING (row_id)""")
def unmatched_reasons(spark: SparkSession, d: str) -> DataFrame:
    cf = t(spark, d, "campaign_finance")
    got = cf.filter("schedule_type = 'ScheduleA' AND report_year >= 2010 AND amount >= 100 AND length(entity_name) > 5")
    got = got.select(F.col("committee_code").alias("got_code"), F.col("entity_name_normalized").alias("got_from"), F.col("amount").alias("got_amount"), parse_date(F.col("transaction_date")).alias("got_on"))
    return gold.failure_reasons(gold.unmatched_contributions(cf, _payees(cf), "row_id", 2010, 100), got, "row_id")


@query("""WITH o AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, date_trunc('week', o_orderdate) ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) SELECT o_orderkey, o_custkey, CAST(date_trunc('week', o_orderdate) AS DATE) AS week FROM o WHERE rn = 1""")
def latest_row_number(spark: SparkSession, d: str) -> DataFrame:
    df = t(spark, d, "orders").withColumn("week", week_start(F.col("o_orderdate")))
    return L.keep_latest(df, ["o_custkey", "week"], [F.col("o_totalprice").desc(), F.col("o_orderkey")]).select("o_orderkey", "o_custkey", "week")


@query("""WITH l AS (SELECT *, rank() OVER (PARTITION BY l_suppkey, date_trunc('month', l_shipdate) ORDER BY l_quantity DESC) AS rk FROM lineitem) SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity FROM l WHERE rk = 1""")
def latest_rank_ties(spark: SparkSession, d: str) -> DataFrame:
    return L.keep_top_rank(t(spark, d, "lineitem"), ["l_suppkey", F.trunc("l_shipdate", "MM")], [F.col("l_quantity").desc()]).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")


@query("""WITH c AS (SELECT o_custkey, o_orderpriority, row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, o_orderpriority) AS rn FROM orders GROUP BY 1, 2) SELECT o_custkey, o_orderpriority FROM c WHERE rn = 1""")
def modal_attribute(spark: SparkSession, d: str) -> DataFrame:
    return L.modal(t(spark, d, "orders"), ["o_custkey"], ["o_orderpriority"])


@query("""WITH w AS (SELECT user_id, event_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events) SELECT event_id, user_id, round(value - before, 6) AS discrepancy FROM w WHERE before IS NOT NULL AND abs(value - before) > 0.01""")
def event_continuity(spark: SparkSession, d: str) -> DataFrame:
    df = L.continuity_failures(t(spark, d, "events"), ["user_id"], [F.col("ts"), F.col("event_id")], "value", "value")
    return df.select("event_id", "user_id", F.round("discrepancy", 6).alias("discrepancy"))


@query("""WITH l AS (SELECT l_orderkey, l_extendedprice, l_shipdate FROM lineitem) SELECT o_orderkey, o_totalprice FROM orders o WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.l_orderkey = o.o_orderkey AND abs(l.l_extendedprice - o.o_totalprice) <= 20000 AND CAST(l.l_shipdate AS DATE) BETWEEN CAST(o.o_orderdate AS DATE) - 30 AND CAST(o.o_orderdate AS DATE) + 60)""")
def tolerance_anti_join(spark: SparkSession, d: str) -> DataFrame:
    o = t(spark, d, "orders").withColumn("od", F.to_date("o_orderdate"))
    line = t(spark, d, "lineitem").select("l_orderkey", "l_extendedprice", F.to_date("l_shipdate").alias("sd"))
    return M.tolerance_anti_join(o, line, F.col("o_orderkey") == F.col("l_orderkey"), ("o_totalprice", "l_extendedprice"), ("od", "sd"), (30, 60), 20000).select("o_orderkey", "o_totalprice")


@query("""WITH p(lo, hi, deadline, ordinal) AS (VALUES (DATE '1995-01-01', DATE '1996-06-30', DATE '1996-07-15', 1), (DATE '1996-01-01', DATE '1998-12-31', DATE '1997-06-30', 2), (DATE '2000-01-01', DATE '2000-12-31', DATE '2000-03-01', 3)),
  h AS (SELECT o_orderkey, deadline, row_number() OVER (PARTITION BY o_orderkey ORDER BY ordinal) AS rn FROM orders JOIN p ON CAST(o_orderdate AS DATE) BETWEEN lo AND hi)
  SELECT o.o_orderkey, deadline, coalesce(CAST(o_orderdate AS DATE) <= deadline, false) AS on_time FROM orders o LEFT JOIN (SELECT * FROM h WHERE rn = 1) h USING (o_orderkey)""")
def range_deadline(spark: SparkSession, d: str) -> DataFrame:
    rows = [("1995-01-01", "1996-06-30", "1996-07-15", 1), ("1996-01-01", "1998-12-31", "1997-06-30", 2), ("2000-01-01", "2000-12-31", "2000-03-01", 3)]
    p = spark.createDataFrame(rows, "lo string, hi string, deadline string, ordinal int").select(*[F.col(c).cast("date").alias(c) for c in ("lo", "hi", "deadline")], "ordinal")
    o = t(spark, d, "orders").withColumn("od", F.to_date("o_orderdate"))
    out = M.range_lookup(o, p, "od", "lo", "hi", "ordinal", ["deadline"], row="o_orderkey")
    return out.select("o_orderkey", "deadline", F.coalesce(F.col("od") <= F.col("deadline"), F.lit(False)).alias("on_time"))


@query("""SELECT n_nationkey, n_name, (SELECT min_by(c, struct_pack(x := lower(n_name) <> lower(w), o := o)) FROM (VALUES ('NATION_1', 'one', 1), ('nation', 'any', 2)) AS t(w, c, o) WHERE contains(lower(n_name), lower(w)) OR contains(lower(w), lower(n_name))) AS county FROM nation""")
def contains_lookup(spark: SparkSession, d: str) -> DataFrame:
    words = spark.createDataFrame([("NATION_1", "one", 1), ("nation", "any", 2)], "w string, county string, o int")
    return M.contains_lookup(t(spark, d, "nation"), words, "n_name", "w", "o", "county", "n_nationkey").select("n_nationkey", "n_name", "county")


@query("""SELECT c_nationkey, array_to_string(list_sort(list(DISTINCT c_mktsegment)), '|') AS codes FROM customer GROUP BY 1""")
def code_arrays(spark: SparkSession, d: str) -> DataFrame:
    return A.code_arrays(t(spark, d, "customer"), "c_nationkey", "c_mktsegment").withColumn("codes", F.array_join("codes", "|"))


@query("""SELECT CASE WHEN o_totalprice < 25000 THEN '<25000' WHEN o_totalprice < 100000 THEN '25000-100000' WHEN o_totalprice < 500000 THEN '100000-500000' ELSE '>=500000' END AS bucket, count(*) AS row_count, round(sum(o_totalprice), 2) AS total_amount FROM orders WHERE o_totalprice IS NOT NULL GROUP BY 1""")
def amount_histogram(spark: SparkSession, d: str) -> DataFrame:
    return rounded(A.histogram(t(spark, d, "orders"), "o_totalprice", [25000, 100000, 500000], ["<25000", "25000-100000", "100000-500000", ">=500000"]), "total_amount")


@query("""SELECT count(*) AS row_count, round(sum(o_totalprice), 2) AS total_amount, round(avg(o_totalprice), 2) AS mean_amount, round(median(o_totalprice), 2) AS median_amount, min(o_totalprice) AS min_amount, max(o_totalprice) AS max_amount, count(DISTINCT o_custkey) AS distinct_keys, CAST(count(*) FILTER (o_totalprice < 0) AS BIGINT) AS negatives FROM orders""")
def summary_stats(spark: SparkSession, d: str) -> DataFrame:
    return rounded(A.summary(t(spark, d, "orders"), "o_totalprice", "o_custkey"), "total_amount", "mean_amount", "median_amount")


@query("""WITH r AS (SELECT p_partkey, p_size, rank() OVER (ORDER BY p_size DESC) AS rk FROM part) SELECT p_partkey, p_size FROM r WHERE rk <= 10""")
def top_with_ties(spark: SparkSession, d: str) -> DataFrame:
    return A.top_with_ties(t(spark, d, "part"), [F.col("p_size")], 10).select("p_partkey", "p_size")


@query("""SELECT l_returnflag, l_linestatus, round(sum(l_extendedprice), 2) AS total_amount, count(*) AS row_count, round(avg(l_extendedprice), 2) AS mean_amount, min(l_extendedprice) AS min_amount, max(l_extendedprice) AS max_amount, min(l_shipdate) AS first_date, max(l_shipdate) AS last_date FROM lineitem WHERE l_quantity IN (1, 2, 3, 4, 5) GROUP BY 1, 2""")
def generic_sum_by(spark: SparkSession, d: str) -> DataFrame:
    return rounded(A.sum_by(t(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice", "l_shipdate", {"l_quantity": [1, 2, 3, 4, 5]}), "total_amount", "mean_amount")


@query("""SELECT l_orderkey, round(sum(CASE WHEN l_returnflag = 'A' THEN l_extendedprice END), 2) AS total_a, round(sum(CASE WHEN l_returnflag = 'N' THEN l_extendedprice END), 2) AS total_n, round(sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END), 2) AS total_r FROM lineitem GROUP BY 1""")
def schedule_pivot(spark: SparkSession, d: str) -> DataFrame:
    return rounded(A.pivot_totals(t(spark, d, "lineitem"), "l_orderkey", "l_returnflag", "l_extendedprice", {"A": "total_a", "N": "total_n", "R": "total_r"}), "total_a", "total_n", "total_r")


@query("""SELECT a.n_name AS a, b.n_name AS b, round((greatest(length(a.n_name), length(b.n_name)) - levenshtein(a.n_name, b.n_name)) / greatest(length(a.n_name), length(b.n_name)), 6) AS score FROM nation a JOIN nation b ON a.n_nationkey < b.n_nationkey AND a.n_regionkey = b.n_regionkey WHERE (greatest(length(a.n_name), length(b.n_name)) - levenshtein(a.n_name, b.n_name)) / greatest(length(a.n_name), length(b.n_name)) >= 0.8""")
def name_similarity(spark: SparkSession, d: str) -> DataFrame:
    n = t(spark, d, "nation")
    a, b = n.select(F.col("n_name").alias("a"), F.col("n_nationkey").alias("ka"), "n_regionkey"), n.select(F.col("n_name").alias("b"), F.col("n_nationkey").alias("kb"), "n_regionkey")
    score = similarity(F.col("a"), F.col("b"))
    return a.join(b, "n_regionkey").filter((F.col("ka") < F.col("kb")) & (score >= 0.8)).select("a", "b", F.round(score, 6).alias("score"))


@query("""SELECT 'part' AS kind, CAST(p_partkey AS VARCHAR) AS id, p_name AS name FROM (SELECT DISTINCT p_partkey, p_name FROM part WHERE contains(upper(p_name), '11') ORDER BY p_name, CAST(p_partkey AS VARCHAR) LIMIT 50)
  UNION ALL SELECT 'supplier', CAST(s_suppkey AS VARCHAR), s_name FROM (SELECT DISTINCT s_suppkey, s_name FROM supplier WHERE contains(upper(s_name), '11') ORDER BY s_name, CAST(s_suppkey AS VARCHAR) LIMIT 50)""")
def name_search(spark: SparkSession, d: str) -> DataFrame:
    return surface.name_search({"part": (t(spark, d, "part"), "p_partkey", "p_name"), "supplier": (t(spark, d, "supplier"), "s_suppkey", "s_name")}, "11")


@query("SELECT row_id, purpose FROM campaign_finance WHERE regexp_matches(lower(purpose), '" + gold.CONTRIBUTION + "') AND NOT regexp_matches(lower(purpose), '" + gold.NO_CONTRIBUTION + "')")
def purpose_filter(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "campaign_finance").filter(gold.is_contribution(F.col("purpose"))).select("row_id", "purpose")


@query("""SELECT c_custkey, c_mktsegment FROM customer WHERE lower(c_mktsegment) IN ('building', 'machinery') AND (c_name LIKE '%1%' OR c_name LIKE '%7%')""")
def array_filter(spark: SparkSession, d: str) -> DataFrame:
    terms, segments = F.array(F.lit("1"), F.lit("7")), F.array(F.lit("building"), F.lit("machinery"))
    hit = F.exists(terms, lambda x: F.lower("c_name").contains(F.lower(x))) & F.array_contains(segments, F.lower("c_mktsegment"))
    return t(spark, d, "customer").filter(hit).select("c_custkey", "c_mktsegment")


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag FROM lineitem""")
def union_schedules(spark: SparkSession, d: str) -> DataFrame:
    df = t(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag")
    return files.union_all(df.filter(F.col("l_returnflag") == f) for f in "ANR")


@query("""SELECT 'without orders' AS kind, c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) UNION ALL SELECT 'with large order', c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000) UNION ALL SELECT 'distinct segment', CAST(length(c_mktsegment) AS BIGINT) FROM (SELECT DISTINCT c_mktsegment FROM customer)""")
def anti_semi_distinct(spark: SparkSession, d: str) -> DataFrame:
    c, o = t(spark, d, "customer"), t(spark, d, "orders")
    a = c.join(o, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select(F.lit("without orders").alias("kind"), "c_custkey")
    b = c.join(o.filter("o_totalprice > 400000"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select(F.lit("with large order").alias("kind"), "c_custkey")
    e = c.select("c_mktsegment").distinct().select(F.lit("distinct segment").alias("kind"), F.length("c_mktsegment").cast("long").alias("c_custkey"))
    return a.union(b).union(e)


@query("""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders""")
def parse_dates(spark: SparkSession, d: str) -> DataFrame:
    """Order dates written in four forms and read back."""
    o = t(spark, d, "orders").withColumn("k", F.pmod("o_orderkey", F.lit(4)))
    text = F.when(F.col("k") == 0, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).when(F.col("k") == 1, F.date_format("o_orderdate", "yyyy-MM-dd")).when(F.col("k") == 2, F.date_format("o_orderdate", "M/d/yyyy H:mm")).otherwise(F.date_format("o_orderdate", "M/d/yy"))
    return o.select("o_orderkey", parse_date(text).alias("d"))


@query("SELECT row_id, " + date_sql("transaction_date") + " AS d FROM campaign_finance")
def transaction_days(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "campaign_finance").select("row_id", parse_date(F.col("transaction_date")).alias("d"))


@query("""SELECT committee_code, TRY_CAST(CASE WHEN TRY_CAST(regexp_extract(committee_code, '^CC-([0-9]{2})-', 1) AS INT) < 50 THEN 2000 ELSE 1900 END + TRY_CAST(regexp_extract(committee_code, '^CC-([0-9]{2})-', 1) AS INT) AS INT) AS y, count(*) AS n FROM campaign_finance GROUP BY 1""")
def code_years(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "campaign_finance").groupBy("committee_code").agg(F.count(F.lit(1)).alias("n")).withColumn("y", code_year(F.col("committee_code")))


@query("""WITH m AS (SELECT p_partkey, regexp_replace(trim(p_txt), '[()$,\\s]', '', 'g') AS b, regexp_matches(trim(p_txt), '^\\$?\\(.*\\)$') AS neg FROM (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN '$' || CAST(p_size AS VARCHAR) || ',000.50' WHEN 1 THEN '(' || CAST(p_size AS VARCHAR) || '.25)' ELSE 'none' END AS p_txt FROM part))
  SELECT p_partkey, coalesce(CASE WHEN neg THEN -TRY_CAST(b AS DOUBLE) ELSE TRY_CAST(b AS DOUBLE) END, 0) AS amount FROM m""")
def parse_money(spark: SparkSession, d: str) -> DataFrame:
    k, size = F.pmod("p_partkey", F.lit(3)), F.col("p_size").cast("string")
    text = F.when(k == 0, F.concat(F.lit("$"), size, F.lit(",000.50"))).when(k == 1, F.concat(F.lit("("), size, F.lit(".25)"))).otherwise("none")
    return t(spark, d, "part").select("p_partkey", money(text).alias("amount"))


NAME_SQL = "upper(trim(regexp_replace({c}, '\\s+', ' ', 'g')))"


def _name_sql(c: str) -> str:
    out = NAME_SQL.format(c=c)
    for pattern, to in normalize.SHORTENED:
        out = f"regexp_replace({out}, '{pattern}', '{to.replace('$1', chr(92) + '1')}', 'g')"
    out = f"regexp_replace({out}, '\\s*&\\s*', ' AND ', 'g')"
    out = f"regexp_replace({out}, '[^\\w\\s]', '', 'g')"
    for word in normalize.CLOSING:
        out = f"trim(regexp_replace({out}, '\\b{word}$', ''))"
    return f"trim(regexp_replace({out}, '\\s+', ' ', 'g'))"


def _either_sql(c: str) -> str:
    """A name that may be a person's or an organisation's."""
    out = NAME_SQL.format(c=c)
    for pattern, to in normalize.SHORTENED:
        out = f"regexp_replace({out}, '{pattern}', '{to.replace('$1', chr(92) + '1')}', 'g')"
    return f"trim(regexp_replace({out}, '\\s+', ' ', 'g'))"


@query("SELECT p_partkey, " + _name_sql("p_name || ' & Virginia Street Association Inc'") + " AS n FROM part")
def normalize_names(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "part").select("p_partkey", normalize.name(F.concat("p_name", F.lit(" & Virginia Street Association Inc")), False).alias("n"))


@query()
def name_forms(spark: SparkSession, d: str) -> DataFrame:
    """Distinct people's names with their normal form and search variations."""
    names = t(spark, d, "fact_transaction").select("candidate_name").filter("trim(candidate_name) <> ''").distinct()
    return names.select("candidate_name", normalize.name(F.col("candidate_name"), True).alias("n"), title_case(F.col("candidate_name")).alias("titled"), F.array_join(normalize.search_variations(F.col("candidate_name")), "|").alias("variations"))


@query()
def offices(spark: SparkSession, d: str) -> DataFrame:
    """Distinct offices and districts with their normal forms and level."""
    df = t(spark, d, "campaign_finance").select("office_sought", "district", "candidate_city", "election_cycle").distinct().withColumn("office", normalize.office(F.col("office_sought")))
    df = df.withColumn("lvl", normalize.level(F.col("office"), F.col("district"))).withColumn("kind", normalize.primary_or_general(F.col("election_cycle")))
    return df.withColumn("district_normal", normalize.district(F.col("district"), F.col("candidate_city"), F.col("lvl"), F.col("office_sought")))


@query("""SELECT c_custkey, c_acctbal, c_acctbal < 0 AS negative, abs(coalesce(c_acctbal, 0) - round(c_acctbal)) > 0.01 AS mismatch FROM customer WHERE c_acctbal < 0 OR abs(coalesce(c_acctbal, 0) - round(c_acctbal)) > 0.01""")
def balance_flags(spark: SparkSession, d: str) -> DataFrame:
    b = F.col("c_acctbal")
    gap = F.abs(F.coalesce(b, F.lit(0.0)) - F.round(b))
    return t(spark, d, "customer").select("c_custkey", "c_acctbal", (b < 0).alias("negative"), (gap > 0.01).alias("mismatch")).filter("negative OR mismatch")


@query("""SELECT o_custkey, o_orderkey, CAST(round(o_totalprice * 100, 0) AS BIGINT) AS c, round(sum(CAST(round(o_totalprice * 100, 0) AS BIGINT)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) / 100, 2) AS running_total FROM orders""")
def running_totals(spark: SparkSession, d: str) -> DataFrame:
    df = A.running(t(spark, d, "orders").withColumn("c", cents(F.col("o_totalprice"))), ["o_custkey"], ["o_orderdate", "o_orderkey"], "c")
    return df.select("o_custkey", "o_orderkey", "c", two(F.col("running_total") / 100).alias("running_total"))


@query("""SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, event_type, count(*) AS event_count, round(sum(value), 4) AS total_value FROM events GROUP BY 1, 2""")
def windowed_totals(spark: SparkSession, d: str) -> DataFrame:
    return amendments.windowed_totals(t(spark, d, "events"), "ts", ["event_type"], "value").withColumn("total_value", F.round("total_value", 4))


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL '30 minutes' THEN 0 ELSE 1 END AS s FROM events), h AS (SELECT user_id, ts, sum(s) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
  SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL '30 minutes' AS session_end, count(*) AS event_count FROM h GROUP BY user_id, k""")
def event_sessions(spark: SparkSession, d: str) -> DataFrame:
    return amendments.sessions(t(spark, d, "events"), "ts", "user_id")


@query("""SELECT n_name, r_name, round(sum(o_totalprice), 2) AS total_amount, GROUPING(n_name) AS g FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)""")
def rollup_totals(spark: SparkSession, d: str) -> DataFrame:
    o, c, n, r = (t(spark, d, x) for x in ("orders", "customer", "nation", "region"))
    df = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey")).join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey"))
    return df.rollup("r_name", "n_name").agg(two(F.sum("o_totalprice")).alias("total_amount"), F.grouping("n_name").cast("long").alias("g")).select("n_name", "r_name", "total_amount", "g")


@query("""SELECT e.entity_name AS name_variation, coalesce(e.entity_name_normalized, '') AS current_normalized, count(*) AS n FROM campaign_finance e WHERE e.entity_name IS NOT NULL GROUP BY 1, 2""")
def spellings(spark: SparkSession, d: str) -> DataFrame:
    df = t(spark, d, "campaign_finance").filter("entity_name IS NOT NULL")
    return df.groupBy(F.col("entity_name").alias("name_variation"), F.coalesce("entity_name_normalized", F.lit("")).alias("current_normalized")).agg(F.count(F.lit(1)).alias("n"))


@query("WITH p AS (SELECT DISTINCT entity_name AS name_variation, coalesce(entity_name_normalized, '') AS current_normalized FROM campaign_finance WHERE entity_name IS NOT NULL), q AS (SELECT *, " + _either_sql("name_variation") + " AS new_normalized FROM p) SELECT *, current_normalized <> new_normalized AS changed FROM q")
def normalization_regression(spark: SparkSession, d: str) -> DataFrame:
    return surface.regression(t(spark, d, "campaign_finance"), "entity_name", "entity_name_normalized", lambda c: normalize.name(c))


@query("""SELECT row_id, coalesce(nullif(purpose, ''), nullif(transaction_type, ''), nullif(schedule_type, '')) AS p FROM campaign_finance""")
def first_purpose(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "campaign_finance").select("row_id", first_filled(F.col("purpose"), F.col("transaction_type"), F.col("schedule_type")).alias("p"))


@query(FACT_SQL + """SELECT entity_name, round(sum(amount), 2) AS total_amount, count(*) AS row_count FROM fact WHERE transaction_category = 'receipt' GROUP BY 1 ORDER BY sum(amount) DESC NULLS LAST, entity_name LIMIT 25""")
def sample_top_donors(spark: SparkSession, d: str) -> DataFrame:
    df = A.sum_by(fact(spark, d).filter("transaction_category = 'receipt'"), ["entity_name"], "amount", top=25)
    return df.select("entity_name", two("total_amount").alias("total_amount"), "row_count")


@query(f"""WITH a AS ({oracles.LOADED_A}), r AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY folder_name, trim("ReportId") ORDER BY line_id DESC) AS rn FROM ({oracles.LOADED_R})) WHERE rn = 1),
  n AS (SELECT line_id, folder_name, trim("ReportId") AS report_id, "Amount" AS raw, nullif("FirstName", '') AS f, nullif("MiddleName", '') AS m, nullif("LastOrCompanyName", '') AS l, lower(trim("IsIndividual")) AS flag FROM a),
  j AS (SELECT n.*, nullif("CommitteeCode", '') AS committee_code, nullif("CandidateName", '') AS candidate_name, TRY_CAST(nullif("ReportYear", '') AS INTEGER) AS report_year, nullif("ElectionCycle", '') AS election_cycle, nullif("OfficeSought", '') AS office_sought, nullif("District", '') AS district
    FROM n LEFT JOIN r ON n.folder_name = r.folder_name AND n.report_id = trim(r."ReportId")),
  k AS (SELECT *, {oracles.office_sql("office_sought")} AS office_sought_normal FROM j)
  SELECT line_id, folder_name, report_id, coalesce(CASE WHEN regexp_matches(trim(raw), '^\\$?\\(.*\\)$') THEN -1 ELSE 1 END * TRY_CAST(regexp_replace(trim(raw), '[()$,\\s]', '', 'g') AS DOUBLE), 0) AS amount,
    coalesce(CASE WHEN l IS NULL THEN '' WHEN f IS NOT NULL THEN concat_ws(' ', nullif(trim(f), ''), nullif(trim(m), ''), nullif(trim(l), '')) ELSE l END, '') AS entity_name,
    CASE WHEN flag IN ('true', 't', 'yes') THEN true WHEN flag IN ('false', 'f', 'no') THEN false ELSE TRY_CAST(flag AS DOUBLE) <> 0 END AS entity_is_individual, committee_code, candidate_name, report_year, election_cycle,
    CASE WHEN election_cycle IS NULL THEN NULL WHEN starts_with(trim(election_cycle), '11/') THEN 'general' ELSE 'primary' END AS primary_or_general, office_sought_normal, {oracles.level_sql("office_sought_normal", "district")} AS level FROM k""")
def silver_transactions(spark: SparkSession, d: str) -> DataFrame:
    """The conforming ScheduleA records as transactions with their report's attributes."""
    a = rejects.strict_load(t(spark, d, "schedulea"), rejects.SCHEDULE_A_SPEC, keep=("folder_name",)).withColumn("schedule_type", F.lit("ScheduleA"))
    out = silver.transactions_new(a, _reports(spark, d), keep=("line_id",))
    return out.select("line_id", "folder_name", "report_id", "amount", "entity_name", "entity_is_individual", "committee_code", "candidate_name", "report_year", "election_cycle", "primary_or_general", "office_sought_normal", "level")


def _reports(spark: SparkSession, d: str) -> DataFrame:
    return rejects.strict_load(t(spark, d, "report"), rejects.REPORT_SPEC, keep=("folder_name",)).withColumn("line_no", F.col("line_id"))


@query(f"""WITH a AS ({oracles.LOADED_A}), r AS ({oracles.LOADED_R}) SELECT folder_name, trim("ReportId") AS report_id, count(*) AS row_count FROM a
  WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.folder_name = a.folder_name AND trim(r."ReportId") = trim(a."ReportId")) GROUP BY 1, 2""")
def silver_unmatched_reports(spark: SparkSession, d: str) -> DataFrame:
    """Report ids of conforming ScheduleA records that no report of the folder has."""
    a = rejects.strict_load(t(spark, d, "schedulea"), rejects.SCHEDULE_A_SPEC, keep=("folder_name",)).withColumn("report_id", F.trim("ReportId"))
    return silver.unmatched_reports(a, _reports(spark, d))


@query(f"""WITH r AS (SELECT report_row_id, {date_sql("report_date")} AS d, report_year, TRY_CAST(regexp_extract(election_cycle, '([^/]*)$', 1) AS INTEGER) AS election FROM dim_report),
  p AS (SELECT make_date(CAST(y AS INTEGER), 1 + 6 * CAST(h AS INTEGER), 1) AS lo, CASE h WHEN 0 THEN make_date(CAST(y AS INTEGER), 6, 30) ELSE make_date(CAST(y AS INTEGER), 12, 31) END AS hi, CASE h WHEN 0 THEN make_date(CAST(y AS INTEGER), 6, 15) ELSE make_date(CAST(y AS INTEGER), 12, 15) END AS deadline, on_cycle
    FROM range(1999, 2031) a(y), range(0, 2) b(h), (VALUES (true), (false)) c(on_cycle))
  SELECT report_row_id, CASE WHEN d IS NOT NULL AND report_year IS NOT NULL THEN coalesce(d <= deadline, false) END AS on_time FROM r LEFT JOIN p ON d BETWEEN lo AND hi AND on_cycle = coalesce(report_year = election, false)""")
def report_on_time(spark: SparkSession, d: str) -> DataFrame:
    """Whether a report's date is by the deadline of its half year."""
    y = spark.range(1999, 2031).select(F.col("id").cast("int").alias("y"), F.explode(F.array(F.lit(0), F.lit(1))).alias("h"))
    y = y.select("*", F.explode(F.array(F.lit(True), F.lit(False))).alias("on_cycle"))
    first = F.make_date("y", 1 + 6 * F.col("h"), F.lit(1))
    periods = y.select(first.alias("period_start"), F.last_day(F.add_months(first, 5)).alias("period_end"), F.make_date("y", 6 + 6 * F.col("h"), F.lit(15)).alias("deadline"), "on_cycle", (F.col("y") * 2 + F.col("h")).alias("ordinal"))
    return silver.on_time(t(spark, d, "dim_report"), periods, "report_row_id").select("report_row_id", "on_time")


@query(FACT_SQL + """SELECT committee_name_normalized, round(sum(amount), 2) AS total_amount, count(*) AS row_count, count(DISTINCT entity_name_normalized) AS entities FROM fact WHERE transaction_category = 'disbursement' AND committee_name_normalized <> '' GROUP BY 1 ORDER BY sum(amount) DESC NULLS LAST, 1 LIMIT 10""")
def top_payers(spark: SparkSession, d: str) -> DataFrame:
    """The ten committees that paid most, with their payees counted."""
    df = fact(spark, d).filter("transaction_category = 'disbursement' AND committee_name_normalized <> ''")
    out = A.sum_by(df, ["committee_name_normalized"], "amount", top=10, distinct={"entities": "entity_name_normalized"})
    return out.select("committee_name_normalized", two("total_amount").alias("total_amount"), "row_count", "entities")


@query(FACT_SQL + """SELECT candidate_name, round(sum(amount), 2) AS total_amount, count(*) AS row_count FROM fact WHERE transaction_category = 'receipt' AND level = 'local' GROUP BY 1 ORDER BY sum(amount) DESC NULLS LAST, 1 NULLS FIRST LIMIT 50""")
def sample_local_receipts(spark: SparkSession, d: str) -> DataFrame:
    df = A.sum_by(fact(spark, d).filter("transaction_category = 'receipt'"), ["candidate_name"], "amount", filters={"level": ["local"]}, top=50)
    return df.select("candidate_name", two("total_amount").alias("total_amount"), "row_count")


@query(FACT_SQL + """SELECT row_id, entity_name, amount FROM fact WHERE NOT is_suspected_test_record ORDER BY amount DESC NULLS LAST, row_id LIMIT 100""")
def sample_largest_transactions(spark: SparkSession, d: str) -> DataFrame:
    df = fact(spark, d).filter("NOT is_suspected_test_record")
    return df.orderBy(F.col("amount").desc_nulls_last(), "row_id").limit(100).select("row_id", "entity_name", "amount")


@query(oracles.balances_sql(date_sql) + f""", f AS (SELECT row_id, ending_balance < 0 AS negative, abs(coalesce(ending_balance, 0) - coalesce(line_19, ending_balance)) AS gap FROM s)
  SELECT row_id, negative AS negative_ending_balance, round(gap, 2) AS line_19_discrepancy FROM f WHERE negative OR gap > 0.01 ORDER BY negative DESC, round(gap, 2) DESC NULLS LAST, row_id LIMIT 50""")
def sample_worst_balances(spark: SparkSession, d: str) -> DataFrame:
    """Suspicious balances, negative ones and the largest discrepancies first."""
    df = rounded(gold.suspicious_balances(gold.fact_report_summary(_balances(spark, d))), "line_19_discrepancy")
    df = df.orderBy(F.col("negative_ending_balance").desc_nulls_last(), F.col("line_19_discrepancy").desc_nulls_last(), "row_id").limit(50)
    return df.select("row_id", "negative_ending_balance", "line_19_discrepancy")


ORACLE.update(oracles.queries(date_sql))
