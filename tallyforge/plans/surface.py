"""The query surface: guarded read-only SQL, name search, named queries, an
ordered builder of tables, and their documentation."""

from __future__ import annotations

import re
import threading
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.operators.aggregate import sum_by


class QueryRefused(ValueError):
    """The statement is not a single read-only query, or reads too much."""


@dataclass(frozen=True)
class Limits:
    rows: int = 1000
    scan_bytes: int = 500_000_000
    seconds: int = 30


#: Functions that run code or reach outside the tables.
_REFUSED = {"reflect", "java_method", "try_reflect", "input_file_name", "current_user", "session_user", "user", "raise_error", "assert_true"}


def check_read_only(spark: SparkSession, sql: str) -> None:
    """Parse, do not search for words: one statement whose plan is a query. Words
    such as DROP inside a literal are no reason to refuse."""
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    except Exception as e:
        raise QueryRefused(f"cannot be read: {str(e).splitlines()[0]}") from None
    nodes = [plan.getClass().getName()]
    walk = plan.children()
    queue = [walk.apply(i) for i in range(walk.size())]
    while queue:
        node = queue.pop()
        nodes.append(node.getClass().getName())
        kids = node.children()
        queue += [kids.apply(i) for i in range(kids.size())]
    text = plan.toString()
    if re.search(r"'?UnresolvedRelation \[(?:parquet|csv|json|orc|text|avro|binaryfile|delta)\s*,", text, re.I):
        raise QueryRefused("files are not read by path, only registered tables")
    called = {w.lower() for w in re.findall(r"([a-z_]+)\s*\(", sql, re.I)} & _REFUSED
    if called or re.search(r"UnresolvedTableValuedFunction|ScriptTransformation", " ".join(nodes)):
        raise QueryRefused(f"not allowed here: {', '.join(sorted(called)) or 'table functions and scripts'}")
    if any("command" in n.lower() or re.search(r"\.(Insert|Create|Replace|Drop|Alter|Delete|Update|Merge|Truncate|Set|Cache|Refresh|Append|Overwrite)\w*$", n) for n in nodes):
        raise QueryRefused("only SELECT and WITH queries are allowed")


def estimated_bytes(df: DataFrame) -> int:
    """The size of the leaves by the optimiser's statistics."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def guarded(spark: SparkSession, sql: str, limits: Limits = Limits(), args: Mapping | Sequence | None = None) -> DataFrame:
    """The query's first rows, refused if it would scan more than allowed."""
    check_read_only(spark, sql)
    df = spark.sql(sql, args=args) if args else spark.sql(sql)
    if (size := estimated_bytes(df)) > limits.scan_bytes:
        raise QueryRefused(f"would scan {size} bytes; the limit is {limits.scan_bytes}")
    return df.limit(limits.rows)


def run_guarded(spark: SparkSession, sql: str, limits: Limits = Limits(), args: Mapping | Sequence | None = None) -> list:
    """Rows of guarded(), cancelled after the time limit."""
    df = guarded(spark, sql, limits, args)
    tag = f"guarded-{uuid.uuid4().hex}"
    timer = threading.Timer(limits.seconds, lambda: spark.interruptTag(tag))
    spark.addTag(tag)
    timer.start()
    try:
        return df.collect()
    finally:
        timer.cancel()
        spark.removeTag(tag)


def name_search(tables: Mapping[str, tuple[DataFrame, str, str]], term: str, limit: int = 50) -> DataFrame:
    """(kind, id, name) of rows whose name contains the term, in any letter case;
    tables: kind to (table, id column, name column). The term is plain text."""
    out = None
    for kind, (df, key, name) in tables.items():
        hit = df.filter(F.upper(F.col(name)).contains(F.upper(F.lit(term)))).select(F.lit(kind).alias("kind"), F.col(key).cast("string").alias("id"), F.col(name).alias("name")).distinct()
        hit = hit.orderBy("name", "id").limit(limit)
        out = hit if out is None else out.unionByName(hit)
    return out


def route(text: str) -> str:
    """sql for text that begins as a query, else search."""
    return "sql" if re.match(r"(?is)^\s*(select|with)\b", text or "") else "search"


@dataclass
class Table:
    """A table of the build: its builder takes the tables it needs, by name."""

    build: Callable[..., DataFrame]
    needs: tuple[str, ...] = ()


@dataclass
class Runner:
    """Builds tables in the order of their needs; each is built once and may be
    written as soon as it is, for the others to read."""

    tables: dict[str, Table] = field(default_factory=dict)

    def order(self, only: Sequence[str] | None = None) -> list[str]:
        done: list[str] = []

        def visit(name: str, path: tuple[str, ...] = ()) -> None:
            if name in path:
                raise ValueError("tables need each other: " + " -> ".join((*path, name)))
            if name in done or name not in self.tables:
                return
            for need in self.tables[name].needs:
                visit(need, (*path, name))
            done.append(name)

        for name in only or self.tables:
            visit(name)
        return done

    def run(self, sources: Mapping[str, DataFrame], only: Sequence[str] | None = None, dry_run: bool = False, store: Callable[[str, DataFrame], DataFrame] | None = None) -> dict[str, DataFrame]:
        """The built tables; with dry_run they are analysed but nothing is stored."""
        built = dict(sources)
        for name in self.order(only):
            table = self.tables[name]
            missing = [n for n in table.needs if n not in built]
            if missing:
                raise ValueError(f"{name} needs {', '.join(missing)}")
            df = table.build(*[built[n] for n in table.needs])
            df.schema  # noqa: B018  analysis raises here, not at the first read
            built[name] = store(name, df) if store and not dry_run else df
        return {n: built[n] for n in self.order(only)}

    def document(self, built: Mapping[str, DataFrame]) -> list[dict]:
        """Name, description, needs and columns of each built table."""
        out = []
        for name in self.order():
            if name in built:
                text = (self.tables[name].build.__doc__ or "").strip()
                out.append({"table": name, "description": text, "needs": list(self.tables[name].needs), "columns": [(f.name, f.dataType.simpleString()) for f in built[name].schema.fields]})
        return out


def tables_of(spark: SparkSession, sql: str) -> list[str]:
    """The tables a statement reads, by its parsed plan."""
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql).toString()
    cte = set(re.findall(r"CTE \[([^\]]*)\]", plan)[0].split(", ")) if "CTE [" in plan else set()
    return sorted({n.replace("`", "").replace(", ", ".") for n in re.findall(r"'UnresolvedRelation \[([^\]]+)\]", plan)} - cte)


def expand_acronyms(text: str, meanings: Mapping[str, str]) -> str:
    """The first use of each acronym with its meaning, plurals included."""
    for short, long in meanings.items():
        text = re.sub(rf"\b{re.escape(short)}(s?)\b", lambda m: f"{long}{m.group(1)} ({m.group(0)})", text, count=1)
    return text


#: Phrases to a plan: pattern, verb, fixed arguments.
PHRASES = (
    (r"^how much (?:did|has) (?P<name>.+?) (?:spend|spent)(?: in (?P<year>\d{4}))?\??$", "spending"),
    (r"^(?:who are the )?top (?P<n>\d+)? ?(?:donors|contributors) (?:to|for) (?P<name>.+?)(?: in (?P<year>\d{4}))?\??$", "contributors"),
    (r"^(?:what did|contributions (?:by|from)) (?P<entity>.+?)(?: give| donate)?(?: in (?P<year>\d{4}))?\??$", "entity"),
    (r"^(?:total )?spending in (?P<year>\d{4})\??$", "year"),
    (r"^transactions of (?P<name>.+?)(?: over \$?(?P<over>[\d,]+))?\??$", "detail"),
)


def understand(text: str) -> dict | None:
    """The verb and arguments of a question in one of the known forms, or of its
    key words; null where there are none."""
    t = re.sub(r"\s+", " ", text.strip().lower())
    for pattern, verb in PHRASES:
        if m := re.match(pattern, t):
            return {"verb": verb} | {k: v for k, v in m.groupdict().items() if v}
    year = re.search(r"\b(19|20)\d{2}\b", t)
    for word, verb in (("donor", "contributors"), ("contribut", "contributors"), ("spen", "spending"), ("transaction", "detail")):
        if word in t:
            return {"verb": verb} | ({"year": year.group(0)} if year else {})
    return None


def answer(fact: DataFrame, question: str) -> DataFrame | None:
    """A lazy plan for a question over a fact table, or None."""
    q = understand(question)
    if q is None:
        return None
    df = fact
    if "year" in q:
        df = df.filter(F.col("report_year") == int(q["year"]))
    if "name" in q:
        df = df.filter(F.upper(F.coalesce("candidate_name", "committee_name")).contains(q["name"].upper()))
    if "entity" in q:
        df = df.filter(F.upper("entity_name").contains(q["entity"].upper()))
    if "over" in q:
        df = df.filter(F.col("amount") > float(q["over"].replace(",", "")))
    verb = q["verb"]
    if verb == "contributors":
        return sum_by(df.filter("transaction_category = 'receipt'"), ["entity_name"], "amount", top=int(q.get("n", 10)))
    if verb in ("spending", "year"):
        return sum_by(df.filter("transaction_category = 'disbursement'"), ["candidate_name"], "amount")
    if verb == "entity":
        return sum_by(df, ["committee_name"], "amount")
    return df.orderBy(F.col("amount").desc_nulls_last(), "transaction_id").limit(100)


def regression(names: DataFrame, raw: str, current: str, new: Callable) -> DataFrame:
    """(name_variation, current_normalized, new_normalized, changed) of distinct
    names, to look at before a rule changes."""
    pairs = names.select(F.col(raw).alias("name_variation"), F.coalesce(current, F.lit("")).alias("current_normalized")).filter(F.col(raw).isNotNull()).distinct()
    out = pairs.withColumn("new_normalized", F.coalesce(new(F.col("name_variation")), F.lit("")))
    return out.withColumn("changed", F.col("current_normalized") != F.col("new_normalized"))
