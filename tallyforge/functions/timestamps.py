"""Written dates and times in mixed forms, precisions and zones as instants.

`parse_instant` is one Column expression without Python. `instants` applies it
to a whole table through a dictionary of distinct raw strings, which is kept on
disk and only ever extended by strings it has not seen.

Forms read: year first (`-`, `.`, `/` or no separator), month first, day with a
month name, month name with a day, each with an optional clock time, fraction,
AM/PM and zone; seconds, milliseconds or microseconds since 1970; five-digit
spreadsheet day numbers. A value without a zone is local to `zone`; a bare day
is its local midnight. A local time that occurs twice is the earlier instant,
one that is skipped uses the offset before the change. Two-digit years from 69
on are 19xx. Null, blank, impossible and unreadable values give null. Digits
finer than microseconds are cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.session import scratch_path

LOCAL_ZONE = "America/New_York"
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
#: Fixed offsets of zone abbreviations in minutes.
ABBREVIATIONS = {"z": 0, "utc": 0, "gmt": 0, "est": -300, "edt": -240, "cst": -360, "cdt": -300, "mst": -420, "mdt": -360, "pst": -480, "pdt": -420}

_TIME = r"(?:(?:\s+|T|t|,\s*)(?:at\s+)?(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d+))?)?\s*([AaPp]\.?[Mm]\.?)?\s*([A-Za-z]{3}|[Zz]|(?:UTC|GMT)?[+-]\d{2}(?::?\d{2})?)?)?"
_DAYNAME = r"(?:(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun)[a-z]*\.?,?\s+)?"
#: Each form rewritten to year|month|day|hour|minute|second|fraction|half|zone.
_FORMS = (
    (rf"^(\d{{4}})[-./](\d{{1,2}})[-./](\d{{1,2}}){_TIME}$", "$1|$2|$3|$4|$5|$6|$7|$8|$9"),
    (rf"^(\d{{1,2}})[-./](\d{{1,2}})[-./](\d{{4}}|\d{{2}}){_TIME}$", "$3|$1|$2|$4|$5|$6|$7|$8|$9"),
    (rf"^{_DAYNAME}(\d{{1,2}})[-\s]([A-Za-z]{{3,9}})\.?,?[-\s]\s*(\d{{4}}|\d{{2}}){_TIME}$", "$3|$2|$1|$4|$5|$6|$7|$8|$9"),
    (rf"^{_DAYNAME}([A-Za-z]{{3,9}})\.?\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s+(\d{{4}}){_TIME}$", "$3|$1|$2|$4|$5|$6|$7|$8|$9"),
    (r"^(\d{4})(\d{2})(\d{2})(?:[\sT](\d{2}):?(\d{2}):?(\d{2})?)?([Zz])?$", "$1|$2|$3|$4|$5|$6|||$7"),
)


def clean_raw(raw: Column) -> Column:
    """Without outer white space; null when nothing is left."""
    return F.nullif(F.btrim(raw.cast("string"), F.lit(" \t\r\n ")), F.lit(""))


def _parts(s: Column) -> Column:
    out = F.lit(None).cast("string")
    for pattern, parts in reversed(_FORMS):
        out = F.when(s.rlike(pattern), F.regexp_replace(s, pattern, parts)).otherwise(out)
    return F.split(out, r"\|")


def _local_to_utc(local_micros: Column, zone: str) -> Column:
    return F.unix_micros(F.to_utc_timestamp(F.timestamp_micros(local_micros), zone))


def with_instant(df: DataFrame, raw: str, out: str, zone: str = LOCAL_ZONE) -> DataFrame:
    """df with `out`: microseconds since 1970-01-01 UTC of column `raw`, or null."""
    s, p = "__s", "__p"
    df = df.withColumn(s, clean_raw(F.col(raw)))
    number = F.col(s).rlike(r"^\d+$") & ~(F.col(s).rlike(r"^\d{8}$"))
    df = df.withColumn(p, F.when(~number, _parts(F.col(s))))
    get = lambda i: F.nullif(F.get(F.col(p), F.lit(i)), F.lit(""))
    num = lambda i: get(i).try_cast("int")
    year_text, month_text = get(0), F.lower(get(1))
    year = F.when(F.length(year_text) == 4, num(0)).otherwise(F.when(num(0) >= 69, num(0) + 1900).otherwise(num(0) + 2000))
    named = F.lit(None).cast("int")
    for i, month in enumerate(MONTHS, 1):
        named = F.when(F.lit(month).startswith(F.regexp_replace(month_text, r"^sept$", "sep")), i).otherwise(named)
    month = F.when(month_text.rlike(r"^\d"), num(1)).otherwise(named)
    day = F.unix_date(F.try_to_date(F.format_string("%04d-%02d-%02d", year, month, num(2)), "yyyy-MM-dd"))
    day = F.when((year >= 1) & month.isNotNull(), day)
    half = F.lower(F.substring(get(7), 1, 1))
    hour = F.coalesce(num(3), F.lit(0))
    hour = F.when(half.isNull(), F.when(hour <= 23, hour)).otherwise(F.when(hour.between(1, 12), F.pmod(hour, F.lit(12)) + F.when(half == "p", 12).otherwise(0)))
    minute, second = F.coalesce(num(4), F.lit(0)), F.coalesce(num(5), F.lit(0))
    fraction = F.coalesce(F.rpad(F.substring(get(6), 1, 6), 6, "0").try_cast("int"), F.lit(0))
    zone_text = F.lower(get(8))
    digits = F.regexp_replace(zone_text, r"[^0-9]", "")
    minutes = F.substring(digits, 1, 2).try_cast("int") * 60 + F.coalesce(F.nullif(F.substring(digits, 3, 2), F.lit("")).try_cast("int"), F.lit(0))
    offset = F.when(zone_text.rlike(r"[+-]\d"), F.when(zone_text.contains("-"), -minutes).otherwise(minutes))
    for name, value in ABBREVIATIONS.items():
        offset = F.when(zone_text == name, F.lit(value)).otherwise(offset)
    known = zone_text.isNull() | (offset.isNotNull() & (F.abs(offset) <= 18 * 60))
    local = (day.cast("long") * 86400 + hour * 3600 + minute * 60 + second) * 1_000_000 + fraction
    df = df.withColumn("__local", F.when(known & (minute <= 59) & (second <= 59), local)).withColumn("__offset", offset)
    whole = F.col(s).try_cast("long")
    digits_n = F.length(F.col(s))
    instant = (
        F.when(
            number,
            F.when(digits_n == 10, whole * 1_000_000)
            .when(digits_n == 13, whole * 1_000)
            .when(digits_n == 16, whole)
            .when(digits_n == 5, _local_to_utc((whole - 25569) * 86_400_000_000, zone)),
        )
        .when(F.col("__offset").isNull(), _local_to_utc(F.col("__local"), zone))
        .otherwise(F.col("__local") - F.col("__offset").cast("long") * 60_000_000)
    )
    return _behind(df, out, instant).drop(s, p, "__local", "__offset")


def _behind(df: DataFrame, name: str, value: Column) -> DataFrame:
    """withColumn through a one-element explode: the optimiser does not copy the
    long expression into filters and aggregates above it."""
    return df.withColumn(name, F.explode(F.array(value)))


def local_day(micros: Column, zone: str = LOCAL_ZONE) -> Column:
    """The calendar day in `zone` of an instant, as yyyy-MM-dd text."""
    return F.date_format(F.from_utc_timestamp(F.timestamp_micros(micros), zone), "yyyy-MM-dd")


def refresh_dictionary(raws: DataFrame, path: str, zone: str = LOCAL_ZONE, source: str = "") -> DataFrame:
    """Extend the dictionary of distinct strings at `path` by those of
    raws(raw) it lacks for this source and zone, each parsed once, and read it.

    It holds source, zone, raw, n (rows seen when it was added), utc_micros (null for
    unreadable strings, so that they too are parsed only once). What comes back has the
    n of these raws, 0 for strings they lack. Refreshes of one path must not run at once."""
    spark: SparkSession = raws.sparkSession
    counted = every = raws.filter("raw IS NOT NULL").groupBy("raw").agg(F.count(F.lit(1)).alias("n"))
    try:
        known = spark.read.parquet(path)
    except Exception as e:  # no dictionary yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        known = None
    if known is not None:
        known = known.filter((F.col("source") == source) & (F.col("zone") == zone))
        counted = counted.join(known.select("raw"), "raw", "left_anti")
    parsed = with_instant(counted, "raw", "utc_micros", zone).select(F.lit(source).alias("source"), F.lit(zone).alias("zone"), "raw", "n", "utc_micros")
    parsed.write.mode("append").parquet(path)
    now = spark.read.schema(parsed.schema).parquet(path).filter((F.col("source") == source) & (F.col("zone") == zone))
    return now if known is None else now.drop("n").join(every, "raw", "left").withColumn("n", F.coalesce("n", F.lit(0))).select(parsed.columns)


#: A raw string is joined by broadcast where more than one row in so many holds
#: it; there can be no more such strings than that.
HOT_SHARE = 1000


def instants(df: DataFrame, id_col: str, fields: list[str], zone: str = LOCAL_ZONE, dictionary: str | None = None, source: str = "") -> DataFrame:
    """(id_col, field, utc_micros): one row for each readable value of `fields`.

    Distinct strings are parsed once, in the dictionary at path `dictionary`
    (a fresh one in the shared folder by default), and joined back. Strings that
    many rows hold, of which there are at most HOT_SHARE by definition, are
    joined by broadcast and their rows spread, so no shuffle partition gets a
    hot string. Repeated rows and ids come out as often as they go in; other
    columns, whatever their names, do not matter."""
    rows = df.select(F.col(id_col).alias("__id"), F.explode(F.array(*[F.struct(F.lit(f).alias("f"), clean_raw(F.col(f)).alias("v")) for f in fields])).alias("e"))
    rows = rows.select("__id", F.col("e.f").alias("field"), F.col("e.v").alias("raw")).filter("raw IS NOT NULL")
    words = refresh_dictionary(rows.select("raw"), dictionary or scratch_path(df.sparkSession, "timestamps"), zone, source)
    total = words.agg(F.sum("n").alias("total"))
    hot = words.crossJoin(F.broadcast(total)).filter(F.col("n") * HOT_SHARE > F.col("total")).select("raw", F.col("utc_micros").alias("hot_micros"), F.lit(True).alias("hot"))
    rows = rows.join(F.broadcast(hot), "raw", "left")
    # A null key matches nothing, and Spark spreads null keys of a left join's left side by the other key.
    rows = rows.withColumn("raw", F.when(F.col("hot").isNull(), F.col("raw"))).withColumn("__salt", F.when(F.col("hot"), F.xxhash64("__id", "field")).otherwise(F.lit(0)))
    readable = words.filter("utc_micros IS NOT NULL").select("raw", F.lit(0).cast("long").alias("__salt"), "utc_micros")
    joined = rows.join(readable, ["raw", "__salt"], "left")
    return joined.select(F.col("__id").alias(id_col), "field", F.coalesce("hot_micros", "utc_micros").alias("utc_micros")).filter("utc_micros IS NOT NULL")
