"""Schemas that drift between files: match every spelling of a field to one
canonical field, cast and union, and report each change from folder to folder.

Matching is similarity flooding. Two graphs are built, one of the observed keys
and one of the canonical fields, each with name, token and type edges, and nesting
edges where the caller gives parents; keys are those of the outermost object.
Match scores start from name similarity, flow along equal edge labels of the
pairwise graph until they converge, and one-to-one correspondences are taken per
folder. Only schema metadata (distinct keys with their types and folders) reaches
the driver; rows stay distributed. Unmatched keys are kept out of the union and
listed by `correspondences` with a null field; `unified` keeps their values in a map.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


@dataclass(frozen=True)
class Canonical:
    """A field of the consistent table: JSON type, Spark type, phrases for it."""

    name: str
    kind: str
    sql_type: str
    phrases: tuple[str, ...] = ()
    parent: str = "$"


#: The consistent Schedule H table with the phrases its fields go by.
SCHEDULE_H = (
    Canonical("report_id", "number", "bigint"),
    Canonical("committee_code", "string", "string"),
    Canonical("committee_name", "string", "string"),
    Canonical("candidate_name", "string", "string"),
    Canonical("report_year", "number", "int"),
    Canonical("report_date", "string", "string", ("filing date", "date received", "received", "date filed")),
    Canonical("due_date", "string", "string", ("report due date",)),
    Canonical("amendment_count", "number", "int", ("amended count",)),
    Canonical("party", "string", "string", ("party description", "party desc")),
    Canonical("office_sought", "string", "string", ("office code", "office")),
    Canonical("district", "string", "string", ("office sub code", "sub code")),
    Canonical("starting_balance", "number", "double", ("beginning balance", "begin cash balance", "begin cash bal", "start balance")),
    Canonical("total_disbursements", "number", "double", ("tot disbursements", "total disb elec cycle", "disbursements")),
    Canonical("ending_balance", "number", "double", ("end cash balance", "end cash bal", "close balance")),
    Canonical("line_19", "number", "double", ("line nineteen", "expendable funds balance")),
)

EPSILON, ROUNDS, LEAST = 1e-4, 200, 0.2
#: Rows of a profile (folder, key and type) that are taken as metadata; more raise.
MOST_KEYS = 200_000


def words(name: str) -> list[str]:
    """Lower-case words of a name in camel case, snake case or plain."""
    name = re.sub(r"([a-z0-9])([A-Z])", r"\1 \2", name)
    name = re.sub(r"([A-Za-z])(\d)", r"\1 \2", name)
    return [w for w in re.split(r"[^a-z0-9]+", name.lower()) if w]


def _grams(text: str) -> set[str]:
    text = f"##{text}#"
    return {text[i : i + 3] for i in range(len(text) - 2)}


def _dice(a: str, b: str) -> float:
    x, y = _grams(a), _grams(b)
    return 2 * len(x & y) / (len(x) + len(y))


def _name_score(a: str, b: str) -> float:
    """Similarity of two names, with and without their word borders."""
    x, y = words(a), words(b)
    if not x or not y:
        return 0.0
    whole = _dice("".join(x), "".join(y))
    best = sum(max(_dice(w, v) for v in y) for w in x) / len(x) + sum(max(_dice(w, v) for v in x) for w in y) / len(y)
    return max(whole, best / 2)


def flood(keys: dict[str, str], fields: Iterable[Canonical], parents: dict[str, str] | None = None) -> dict[tuple[str, str], float]:
    """Scores in 0..1 of (key, field) pairs. keys: the usual JSON type of each."""
    fields, parents = list(fields), parents or {}

    def graph(items: Iterable[tuple[str, str, str, list[str]]]) -> dict[str, set[tuple[str, str]]]:
        edges: dict[str, set[tuple[str, str]]] = defaultdict(set)
        for name, kind, parent, tokens in items:
            edges["type"].add((f"n:{name}", f"t:{kind}"))
            edges["in"].add((f"n:{name}", f"p:{parent}"))
            edges["word"].update((f"n:{name}", f"w:{w}") for w in tokens)
        return edges

    left = graph((k, kind, parents.get(k, "$"), words(k)) for k, kind in keys.items())
    right = graph((f.name, f.kind, f.parent, sorted({w for p in (f.name, *f.phrases) for w in words(p)})) for f in fields)
    start: dict[tuple[str, str], float] = {}
    for k in keys:
        for f in fields:
            start[f"n:{k}", f"n:{f.name}"] = max(_name_score(k, p) for p in (f.name, *f.phrases)) ** 2
    flows: dict[tuple[str, str], list[tuple[tuple[str, str], float]]] = defaultdict(list)
    for label in left:
        pairs = []
        for a, x in left[label]:
            for b, y in right[label]:
                if x not in ("t:null",) and (label != "word" or _dice(x[2:], y[2:]) >= 0.5):
                    start.setdefault((x, y), 1.0 if x == y else _dice(x[2:], y[2:]) if label == "word" else 0.0)
                    pairs.append(((a, b), (x, y)))
        out: dict[tuple[str, str], int] = defaultdict(int)
        for p, q in pairs:
            out[p] += 1
            out[q] += 1
        for p, q in pairs:
            flows[p].append((q, 1 / out[p]))
            flows[q].append((p, 1 / out[q]))
    now = dict(start)
    for _ in range(ROUNDS):
        got = {p: start[p] + now[p] for p in start}
        for p, ends in flows.items():
            base = start[p] + now[p]
            for q, share in ends:
                got[q] += base * share * 0.5
        # Names, words, types and parents are scaled apart: a type pair has very many neighbours.
        top: dict[str, float] = defaultdict(float)
        for (a, _), v in got.items():
            top[a[0]] = max(top[a[0]], v)
        new = {p: v / (top[p[0][0]] or 1.0) for p, v in got.items()}
        done = max((abs(new[p] - now[p]) for p in new), default=0.0) < EPSILON
        now = new
        if done:
            break
    return {(a[2:], b[2:]): v for (a, b), v in now.items() if a[0] == "n" and b[0] == "n"}


def select(keys: set[str], scores: dict[tuple[str, str], float], exact: dict[str, str], fields: Iterable[Canonical]) -> dict[str, str]:
    """key -> field: `exact` first, then pairs by falling score, taken while both
    sides are free. Pairs without a score are taken only if exact."""
    out: dict[str, str] = {}
    ranked = sorted(((exact.get(k) == f.name, scores.get((k, f.name), -1.0), k, f.name) for k in keys for f in fields), key=lambda x: (-x[0], -x[1], x[2], x[3]))
    for given, score, k, f in ranked:
        if k not in out and f not in out.values() and (given or score >= 0):
            out[k] = f
    return out


def correspond(folders: dict[str, set[str]], kinds: dict[str, str], fields: Iterable[Canonical], least: float = LEAST) -> dict[tuple[str, str], str]:
    """(folder, key) -> field: in each folder as flooded scores from `least` on select. Exact
    phrases are the check afterwards: only a folder in which a key's own phrase
    names another field is selected anew with these keys first."""
    fields = list(fields)
    scores = {p: v for p, v in flood(kinds, fields).items() if v >= least}
    named = {k: max((_name_score(k, p), f.name) for f in fields for p in (f.name, *f.phrases)) for k in kinds}
    exact = {k: f for k, (score, f) in named.items() if score == 1.0}
    out: dict[tuple[str, str], str] = {}
    for folder, keys in folders.items():
        chosen = select(keys, scores, {}, fields)
        if any(chosen.get(k) != exact[k] for k in keys & exact.keys()):
            chosen = select(keys, scores, exact, fields)
        out.update({(folder, k): f for k, f in chosen.items()})
    return out


def folder_key(raw: Column) -> Column:
    """A folder name in any spelling as YYYY or YYYY_MM; null when it has no year."""
    year = F.regexp_extract(raw, r"(?:^|[^0-9])((?:19|20)\d{2})", 1)
    month = F.regexp_extract(raw, r"(?:^|[^0-9])(?:19|20)\d{2}[-_. ]?(0?[1-9]|1[0-2])(?![0-9])", 1)
    return F.when(year != "", F.when(month != "", F.concat_ws("_", year, F.lpad(month, 2, "0"))).otherwise(year))


def json_fields(df: DataFrame, record: str, *keep: str | Column) -> DataFrame:
    """(keep..., key, kind, value): one row for each key of a JSON object. kind is
    string, number, boolean, object, array or null. Null and unreadable records,
    and those that are no object, give no rows."""
    parsed = df.select(*keep, F.explode(F.from_json(F.col(record), "map<string,variant>")).alias("key", "__v"))
    kind = F.upper(F.schema_of_variant(F.col("__v")))
    named = (
        F.when(kind == "VOID", "null").when(kind == "STRING", "string").when(kind == "BOOLEAN", "boolean").when(kind.startswith("OBJECT"), "object").when(kind.startswith("ARRAY"), "array").otherwise("number")
    )
    return parsed.withColumn("kind", named).withColumn("value", F.col("__v").try_cast("string") if hasattr(Column, "try_cast") else F.col("__v").cast("string")).drop("__v")


def profile(df: DataFrame, record: str = "record", folder: str = "folder_name") -> DataFrame:
    """(folder, key, kind, n): how often each key has each JSON type in a folder."""
    rows = json_fields(df, record, folder_key(F.col(folder)).alias("folder"))
    return rows.filter("folder IS NOT NULL").groupBy("folder", "key", "kind").agg(F.count(F.lit(1)).alias("n"))


def correspondences(counts: DataFrame, fields: Iterable[Canonical], least: float = LEAST) -> DataFrame:
    """(folder, key, field, kind): counts is a profile. kind is that of most
    non-null values, null when there are none; of equal counts the first by name.
    least: 0 where every key is known to stand for some field."""
    spark = counts.sparkSession
    rows = counts.limit(MOST_KEYS + 1).collect()  # keys of each folder with their types: metadata, whatever the number of records
    if len(rows) > MOST_KEYS:
        raise ValueError(f"more than {MOST_KEYS} keys by folder and type: the keys of these records are data, not a schema")
    by_key: dict[tuple[str, str], dict[str, int]] = defaultdict(dict)
    overall: dict[str, dict[str, int]] = defaultdict(lambda: defaultdict(int))
    folders: dict[str, set[str]] = defaultdict(set)
    for r in rows:
        folders[r["folder"]].add(r["key"])
        if r["kind"] != "null":
            by_key[r["folder"], r["key"]][r["kind"]] = r["n"]
            overall[r["key"]][r["kind"]] += r["n"]
    most = lambda c: min(c, key=lambda k: (-c[k], k)) if c else None
    kinds = {k: most(overall.get(k, {})) or "null" for keys in folders.values() for k in keys}
    chosen = correspond(folders, kinds, fields, least)
    out = [(f, k, chosen.get((f, k)), most(by_key.get((f, k), {}))) for f, keys in sorted(folders.items()) for k in sorted(keys)]
    return spark.createDataFrame(out, "folder string, key string, field string, kind string")


def changes(present: DataFrame, table: str, folders: DataFrame) -> DataFrame:
    """(table_name, folder_name, field, change) of each folder against the one
    before it. present: (folder, field, key, kind), one row per field and folder;
    folders: all folders of the table, in the order of their names."""
    w = Window.orderBy("folder")  # folders only: a handful of rows
    pairs = folders.select("folder", F.lag("folder").over(w).alias("before")).filter("before IS NOT NULL")
    fields = present.select("field").distinct()
    now = present.select("folder", "field", F.col("key").alias("key1"), F.col("kind").alias("kind1"), F.lit(True).alias("in1"))
    old = present.select(F.col("folder").alias("before"), "field", F.col("key").alias("key0"), F.col("kind").alias("kind0"), F.lit(True).alias("in0"))
    grid = pairs.join(F.broadcast(fields), F.lit(True)).join(now, ["folder", "field"], "left").join(old, ["before", "field"], "left")
    in1, in0 = F.col("in1").isNotNull(), F.col("in0").isNotNull()
    found = F.array_compact(
        F.array(
            F.when(in1 & ~in0, "added"),
            F.when(in0 & ~in1, "removed"),
            F.when(in0 & in1 & (F.col("key0") != F.col("key1")), "renamed"),
            F.when(in0 & in1 & (F.col("kind0") != F.col("kind1")), "retyped"),
        )
    )
    return grid.select(F.lit(table).alias("table_name"), F.col("folder").alias("folder_name"), "field", F.explode(found).alias("change"))


def json_table_changes(df: DataFrame, table: str, fields: Iterable[Canonical], record: str = "record", folder: str = "folder_name", least: float = LEAST) -> DataFrame:
    """Changes of a table of JSON records."""
    matched = correspondences(profile(df, record, folder), fields, least)
    return changes(matched.filter("field IS NOT NULL"), table, matched.select("folder").distinct())


def column_table_changes(df: DataFrame, table: str, folder: str = "folder_name") -> DataFrame:
    """Changes of a table whose columns are present in a folder where any row of
    it has a non-null value: one aggregation with map-side combine."""
    names = list(df.columns)
    slots = [f"c{i}" for i in range(len(names))]
    seen = df.groupBy(folder_key(F.col(folder)).alias("__folder")).agg(*[F.max(F.col(f"`{c}`").isNotNull()).alias(s) for c, s in zip(names, slots)])
    seen = seen.filter("__folder IS NOT NULL")
    present = seen.select(F.col("__folder").alias("folder"), F.explode(F.array_compact(F.array(*[F.when(F.col(s), F.lit(c)) for c, s in zip(names, slots)]))).alias("field"))
    present = present.withColumn("key", F.col("field")).withColumn("kind", F.lit(None).cast("string"))
    return changes(present, table, seen.select(F.col("__folder").alias("folder")))


def unified(df: DataFrame, fields: Iterable[Canonical], record: str = "record", folder: str = "folder_name", keep: tuple[str, ...] = ("row_id",), least: float = LEAST) -> DataFrame:
    """(keep..., folder_name, the canonical fields): all records as one table.

    Numbers written as text, with thousands commas, `$` or accounting
    parentheses, are cast; what does not fit its type is null. Values of keys that
    correspond to no field, and all of a record whose folder has no year, are kept as
    they are in `unmatched`, a map of key to text; null where there are none."""
    fields = list(fields)
    matched = correspondences(profile(df, record, folder), fields, least).filter("field IS NOT NULL")
    by_folder = matched.groupBy("folder").agg(F.map_from_entries(F.collect_list(F.struct("field", "key"))).alias("__keys"))
    rows = df.select(*keep, folder_key(F.col(folder)).alias("folder"), F.from_json(F.col(record), "map<string,string>").alias("__r"))
    rows = rows.join(F.broadcast(by_folder), "folder", "left")  # one row per folder
    out = []
    for f in fields:
        text = F.try_element_at("__r", F.try_element_at("__keys", F.lit(f.name)))
        if f.kind == "number":
            bare = F.regexp_replace(F.trim(text), r"[()$,\s]", "")
            number = bare.try_cast("double")
            number = F.when(F.trim(text).rlike(r"^\$?\(.*\)$"), -number).otherwise(number)
            out.append((number if f.sql_type == "double" else number.try_cast(f.sql_type)).alias(f.name))
        else:
            out.append(F.nullif(F.trim(text), F.lit("")).alias(f.name))
    rest = F.map_filter("__r", lambda k, v: ~F.array_contains(F.coalesce(F.map_values("__keys"), F.array().cast("array<string>")), k))
    return rows.select(*keep, F.col("folder").alias("folder_name"), *out, F.when(F.size(rest) > 0, rest).alias("unmatched"))
