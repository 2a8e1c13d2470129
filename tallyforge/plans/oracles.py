"""SQL of the Schedule H queries and the normalisers, as DuckDB says it."""

from __future__ import annotations

from tallyforge.functions import normalize
from tallyforge.plans import problems
from tallyforge.sources.rejects import REPORT, SCHEDULE_A


def title_sql(x: str) -> str:
    return f"array_to_string(list_transform(range(1, length({x}) + 1), lambda i: CASE WHEN i = 1 OR NOT regexp_matches(({x})[i - 1], '\\p{{L}}') THEN upper(({x})[i]) ELSE lower(({x})[i]) END), '')"


def person_sql(x: str) -> str:
    """A person's name for comparing."""
    spaces = "trim(regexp_replace({}, '\\s+', ' ', 'g'))".format
    out = spaces(f"upper(coalesce({x}, ''))")
    for t in normalize.TITLES:
        out = f"regexp_replace({out}, '\\b{t}\\b', '', 'g')"
    out = spaces(f"regexp_replace({out}, '^[^\\p{{L}}\\p{{M}}\\p{{N}}_]+|[^\\p{{L}}\\p{{M}}\\p{{N}}_]+$', '', 'g')")
    suffixes = ", ".join(f"'{s}'" for s in normalize.SUFFIXES)
    words = f"list_filter(string_split_regex(replace({out}, '-', ' '), '\\s+'), lambda w: w <> '')"
    out = f"""(SELECT CASE WHEN len(ns) < 2 THEN o ELSE array_to_string(list_concat([ns[1], ns[-1]], list_filter(ws, lambda w: w IN ({suffixes}))), ' ') END
      FROM (SELECT o, ws, list_filter(ws, lambda w: w NOT IN ({suffixes})) AS ns FROM (SELECT {out} AS o, {words} AS ws)))"""
    for pattern, to in normalize.SHORTENED:
        out = f"regexp_replace({out}, '{pattern}', '{to.replace('$1', chr(92) + '1')}', 'g')"
    return spaces(out)


def office_sql(x: str) -> str:
    """An office's category, by the precedence the normaliser documents."""
    c = f"trim(regexp_replace(regexp_replace(regexp_replace(lower(trim({x})), '\\s*-\\s*.*$', ''), '\\b(prince william county|blue ridge district|arlington county|at large)\\b', '', 'g'), '\\s+', ' ', 'g'))"
    return f"""(SELECT CASE WHEN c IS NULL THEN NULL WHEN c IN ('hod', 'h.o.d.') THEN 'delegate' WHEN c IN ('ag', 'a.g.') THEN 'attorney general' WHEN c IN ('gov', 'governor') THEN 'governor'
      WHEN regexp_matches(c, 'lt\\.? gov|lieutenant gov|lieut gov|lieu gov') THEN 'lieutenant governor' WHEN regexp_matches(c, 'delegate|hod') THEN 'delegate' WHEN regexp_matches(c, 'senator|senate') THEN 'senator'
      WHEN c LIKE '%governor%' THEN CASE WHEN regexp_matches(c, 'lieutenant|lt') THEN 'lieutenant governor' ELSE 'governor' END
      WHEN c LIKE '%attorney%' AND c LIKE '%general%' THEN 'attorney general' WHEN c LIKE '%treasurer%' THEN 'treasurer' WHEN c LIKE '%secretary%' AND c LIKE '%commonwealth%' THEN 'secretary of the commonwealth'
      WHEN c LIKE '%member%' AND c LIKE '%county board%' OR regexp_matches(c, 'supervisor|county board') AND c LIKE '%chair%' THEN 'chair board of supervisors'
      WHEN c LIKE '%member%' AND c LIKE '%board%' OR regexp_matches(c, 'supervisor|county board') THEN 'member board of supervisors'
      WHEN c LIKE '%school%' AND c LIKE '%board%' THEN CASE WHEN c LIKE '%chair%' THEN 'chair school board' ELSE 'school board' END
      WHEN regexp_matches(c, '(city|town) council') THEN 'city council' WHEN c LIKE '%mayor%' THEN 'mayor' WHEN c LIKE '%sheriff%' THEN 'sheriff' WHEN c LIKE '%clerk%' AND c LIKE '%court%' THEN 'clerk of court'
      WHEN c LIKE '%commonwealth%' AND c LIKE '%attorney%' THEN 'commonwealth attorney' ELSE c END FROM (SELECT {c} AS c))"""


def level_sql(office: str, district: str) -> str:
    return f"CASE WHEN contains(lower(coalesce({district}, '')), 'congressional') THEN 'federal' WHEN {office} IN ('delegate', 'senator', 'governor', 'lieutenant governor', 'attorney general', 'treasurer', 'secretary of the commonwealth') THEN 'state' ELSE 'local' END"


def district_sql(x: str, city: str, level: str, sought: str) -> str:
    large = "at large|at-large|atlarge| al[ ,.]"
    return f"""(SELECT CASE WHEN whole OR mayor THEN CASE WHEN loc THEN {title_sql("t || ' (0)'")} ELSE '0' END
      WHEN d = '' THEN CASE WHEN loc THEN {title_sql("t || ' (0)'")} WHEN t <> '' THEN {title_sql("t")} END
      WHEN n <> '' THEN CASE WHEN loc THEN {title_sql("t || ' (' || n || ')' || after")} ELSE n END
      WHEN loc AND NOT regexp_matches(d, '[a-zA-Z0-9]') THEN {title_sql("t || ' (0)'")} WHEN loc THEN {title_sql("t || ' (' || d || ')'")} ELSE {title_sql("d")} END
      FROM (SELECT coalesce(trim({x}), '') AS d, trim(coalesce({city}, '')) AS t, coalesce({level} = 'local', false) AND coalesce({city}, '') <> '' AS loc,
        coalesce(regexp_matches(lower({sought}), '{large}'), false) OR coalesce(regexp_matches(lower(trim({x})), '{large}'), false) AS whole, coalesce({office_sql(sought)} = 'mayor', false) AS mayor,
        coalesce(regexp_replace(regexp_extract(trim({x}), '([0-9]+)', 1), '^0+([0-9])', '\\1'), '') AS n,
        coalesce(' - ' || trim(nullif(regexp_extract({sought}, '^[^-]*-(.*)$', 1, 's'), '')), '') AS after))"""


def _field(name: str, kind: str) -> str:
    text = f"max(v) FILTER (field = '{name}')"
    if kind == "text":
        return f"nullif(trim({text}), '') AS {name}"
    bare = f"TRY_CAST(regexp_replace(trim({text}), '[()$,\\s]', '', 'g') AS DOUBLE)"
    number = f"CASE WHEN regexp_matches(trim({text}), '^\\$?\\(.*\\)$') THEN -{bare} ELSE {bare} END"
    return f"{number if kind == 'DOUBLE' else f'CAST(trunc({number}) AS {kind})'} AS {name}"


_KINDS = {"report_id": "BIGINT", "report_year": "INTEGER", "amendment_count": "INTEGER", "starting_balance": "DOUBLE", "total_disbursements": "DOUBLE", "ending_balance": "DOUBLE", "line_19": "DOUBLE"}
_FIELDS = ("report_id", "committee_code", "committee_name", "candidate_name", "report_year", "report_date", "due_date", "amendment_count", "party", "office_sought", "district", "starting_balance", "total_disbursements", "ending_balance", "line_19")


def balances_sql(date_sql) -> str:
    """CTEs `unified` (Schedule H as one table) and `h` (with normal forms), and `s`:
    one report per committee and week of its due date."""
    return f"""WITH names(spelling, field) AS (VALUES {problems._SPELLED}),
  kv AS (SELECT row_id, {problems._FOLDER.format(c="folder_name")} AS folder_name, record, unnest(json_keys(record)) AS key FROM schedule_h),
  kf AS (SELECT row_id, folder_name, field, json_extract_string(record, '$."' || key || '"') AS v FROM kv JOIN names ON spelling = regexp_replace(lower(key), '[^a-z0-9]', '', 'g')),
  unified AS (SELECT row_id, folder_name, {", ".join(_field(f, _KINDS.get(f, "text")) for f in _FIELDS)} FROM kf GROUP BY row_id, folder_name),
  o AS (SELECT *, {office_sql("office_sought")} AS office_sought_normal, '11/' || CAST(report_year AS VARCHAR) AS election_cycle FROM unified),
  l AS (SELECT *, {level_sql("office_sought_normal", "district")} AS level FROM o),
  h AS (SELECT *, {person_sql("candidate_name")} AS candidate_name_normalized, {district_sql("district", "NULL::VARCHAR", "level", "office_sought")} AS district_normal FROM l),
  w AS (SELECT *, {date_sql("due_date")} AS due_day FROM h WHERE committee_code <> ''),
  s AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY committee_code, date_trunc('week', due_day) ORDER BY coalesce(amendment_count, 0) DESC, report_date DESC NULLS LAST, folder_name DESC NULLS LAST, row_id) AS rn FROM w WHERE due_day IS NOT NULL) WHERE rn = 1)
"""


def queries(date_sql) -> dict[str, str]:
    h = balances_sql(date_sql)
    latest = f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY candidate_name, district, office_sought, election_cycle ORDER BY {date_sql('report_date')} DESC NULLS LAST, row_id) AS k FROM h WHERE total_disbursements IS NOT NULL"
    return {
        "balance_continuity": h + f""", b AS (SELECT *, {date_sql("report_date")} AS report_day FROM s WHERE starting_balance IS NOT NULL AND ending_balance IS NOT NULL),
  p AS (SELECT *, lag(ending_balance) OVER x AS previous_ending_balance, lag(due_date) OVER x AS previous_due_date, row_number() OVER x AS sequence FROM b
    WINDOW x AS (PARTITION BY committee_code ORDER BY due_day, report_day NULLS FIRST, report_year NULLS FIRST, folder_name NULLS FIRST, row_id))
  SELECT row_id, committee_code, due_day, previous_due_date, starting_balance, previous_ending_balance, round(starting_balance - previous_ending_balance, 2) AS discrepancy FROM p WHERE sequence > 1 AND abs(starting_balance - previous_ending_balance) > 0.01""",
        "suspicious_balances": h + """SELECT row_id, committee_code, ending_balance, line_19, round(gap, 2) AS line_19_discrepancy, ending_balance < 0 AS negative_ending_balance, gap > 0.01 AS line_19_mismatch
  FROM (SELECT *, abs(coalesce(ending_balance, 0) - coalesce(line_19, ending_balance)) AS gap FROM s) WHERE ending_balance < 0 OR gap > 0.01""",
        "local_election_costs": h + f""", r AS (SELECT *, row_number() OVER (PARTITION BY candidate_name_normalized, district_normal, office_sought_normal, election_cycle ORDER BY {date_sql("report_date")} DESC NULLS LAST, row_id) AS k
    FROM s WHERE level = 'local' AND NOT regexp_matches(coalesce(candidate_name_normalized, ''), '\\b(TESTER|TESTY)\\b'))
  SELECT election_cycle, office_sought_normal, district_normal, max(total_disbursements) AS max_disbursements, round(avg(total_disbursements), 4) AS avg_disbursements, round(sum(total_disbursements), 2) AS total_disbursements, count(DISTINCT candidate_name_normalized) AS num_candidates
  FROM r WHERE k = 1 AND total_disbursements > 0 GROUP BY election_cycle, office_sought_normal, district_normal""",
        "local_disbursements": h + "SELECT row_id, candidate_name, office_sought, district, election_cycle, total_disbursements FROM (" + latest + """ AND (lower(office_sought) LIKE '%board%' OR lower(office_sought) LIKE 'mayor' OR lower(office_sought) LIKE '%sheriff%') AND (election_cycle IS NULL OR election_cycle LIKE '%/2018%' OR election_cycle LIKE '%/2019%' OR election_cycle LIKE '%/202_%')) WHERE k = 1)""",
        "county_totals": h + ", f AS (" + latest + """) WHERE k = 1), p(place, county, ordinal) AS (VALUES ('1', 'first', 1), ('at large', 'whole', 2), ('2', 'second', 3)),
  c AS (SELECT t, min_by(county, struct_pack(x := t <> place, o := ordinal)) AS county FROM (SELECT DISTINCT lower(trim(district)) AS t FROM f WHERE trim(district) <> '') JOIN p ON contains(t, place) OR contains(place, t) GROUP BY t)
  SELECT county, count(DISTINCT CASE WHEN office_sought IS NOT NULL AND district IS NOT NULL THEN {'o': office_sought, 'd': district} END) AS races, count(DISTINCT candidate_name) AS candidates, round(sum(total_disbursements), 2) AS total_disbursements FROM f LEFT JOIN c ON lower(trim(district)) = t GROUP BY county""",
        "race_totals": h + """SELECT office_sought, district, max(total_disbursements) AS max_disbursements, round(avg(total_disbursements), 4) AS avg_disbursements, round(sum(total_disbursements), 2) AS total_disbursements, count(*) AS reports FROM h WHERE office_sought IS NOT NULL AND district IS NOT NULL GROUP BY 1, 2""",
        "latest_balances": h + f"""SELECT committee_code, row_id, report_day, ending_balance, report_day < DATE '2025-12-31' - 90 AS is_stale FROM (SELECT *, row_number() OVER (PARTITION BY committee_code ORDER BY report_day DESC NULLS LAST, row_id) AS k FROM (SELECT *, {date_sql("report_date")} AS report_day FROM h WHERE ending_balance IS NOT NULL)) WHERE k = 1""",
        "name_forms": f"""WITH n AS (SELECT DISTINCT candidate_name FROM fact_transaction WHERE trim(candidate_name) <> ''), w AS (SELECT *, string_split_regex(trim(candidate_name), '\\s+') AS ws FROM n)
  SELECT candidate_name, {person_sql("candidate_name")} AS n, {title_sql("candidate_name")} AS titled, array_to_string(CASE WHEN len(ws) < 2 THEN [candidate_name] WHEN candidate_name = ws[1] || ' ' || ws[-1] AND length(ws[1]) = 1 THEN [candidate_name] WHEN candidate_name = ws[1] || ' ' || ws[-1] THEN [candidate_name, ws[1][1] || ' ' || ws[-1]]
    WHEN length(ws[1]) = 1 THEN [candidate_name, ws[1] || ' ' || ws[-1]] ELSE [candidate_name, ws[1] || ' ' || ws[-1], ws[1][1] || ' ' || ws[-1]] END, '|') AS variations FROM w""",
        "offices": f"""WITH d AS (SELECT DISTINCT office_sought, district, candidate_city, election_cycle FROM campaign_finance), o AS (SELECT *, {office_sql("office_sought")} AS office FROM d), l AS (SELECT *, {level_sql("office", "district")} AS lvl FROM o)
  SELECT *, CASE WHEN election_cycle IS NULL THEN NULL WHEN starts_with(trim(election_cycle), '11/') THEN 'general' ELSE 'primary' END AS kind, {district_sql("district", "candidate_city", "lvl", "office_sought")} AS district_normal FROM l""",
    }


def _loaded(table: str, columns: tuple[str, ...], n: int, valid: str, k: int) -> str:
    """The conforming records of a table of raw ones, a column each field."""
    plain = lambda i: f"CASE WHEN starts_with(f[{i}], '\"') THEN replace(f[{i}][2:length(f[{i}]) - 1], '\"\"', '\"') ELSE f[{i}] END"
    field = problems._FIELD
    return f"""SELECT line_id, folder_name, {", ".join(f'{plain(i)} AS "{c}"' for i, c in enumerate(columns, 1))} FROM (SELECT *, {plain(k)} AS x
      FROM (SELECT line_id, folder_name, coalesce(raw_line, '') AS r, regexp_extract_all(',' || coalesce(raw_line, ''), ',({field})', 1) AS f FROM {table}) WHERE regexp_full_match(r, '{field}(?:,{field})*') AND len(f) = {n}) WHERE {valid}"""


LOADED_A = _loaded("schedulea", SCHEDULE_A, 22, f"regexp_full_match(x, '{problems._MONEY}')", 18)
LOADED_R = _loaded("report", REPORT, 39, "trim(x) = '' OR (regexp_matches(x, '\\p{L}') AND NOT regexp_matches(x, '[\\p{Cc}\ufffd]'))", 5)
problems.ORACLE["p3_loaded"], problems.ORACLE["p3_loaded_report"] = LOADED_A, LOADED_R
problems.ORACLE["p3_audit"] = f"""SELECT source_table, reason, count(*) AS records FROM ({problems.P3_SQL}) GROUP BY 1, 2 UNION ALL SELECT 'schedulea', 'loaded', count(*) FROM ({LOADED_A}) UNION ALL SELECT 'report', 'loaded', count(*) FROM ({LOADED_R})"""
problems.ORACLE["p5_unified"] = balances_sql(lambda c: "NULL::DATE") + f"SELECT row_id, folder_name, {', '.join(_FIELDS)}, NULL::VARCHAR AS unmatched FROM unified"
