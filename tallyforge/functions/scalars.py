"""Scalar functions as Column expressions: dates, money, codes, text tests.

None of them raises on dirty input: what cannot be read is null (or the stated
default), under ANSI mode too."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_CLOCK = r"([01]\d|2[0-3]):[0-5]\d:[0-5]\d"


def parse_date(x: Column) -> Column:
    """A date from ISO date-times, ISO dates, M/D/YYYY (a time after a space is
    ignored) and M/D/YY with years from 69 on in the 1900s; else null."""
    iso = F.try_to_date(F.substring(x, 1, 10), "yyyy-MM-dd")
    month, day = F.regexp_extract(x, r"^(\d{1,2})/", 1), F.regexp_extract(x, r"^\d{1,2}/(\d{1,2})/", 1)
    long_year, short_year = F.regexp_extract(x, r"^\d{1,2}/\d{1,2}/(\d{4})(?: |$)", 1), F.regexp_extract(x, r"^\d{1,2}/\d{1,2}/(\d{2})$", 1).try_cast("int")
    built = lambda y: F.try_to_date(F.concat_ws("-", y, F.lpad(month, 2, "0"), F.lpad(day, 2, "0")), "yyyy-MM-dd")
    century = F.when(short_year >= 69, short_year + 1900).otherwise(short_year + 2000).cast("string")
    return (
        F.when(x.rlike(rf"^\d{{4}}-\d{{2}}-\d{{2}}[ T]{_CLOCK}"), iso)
        .when(x.rlike(r"^\d{4}-\d{2}-\d{2}$"), iso)
        .when(x.rlike(r"^\d{1,2}/\d{1,2}/\d{4}"), F.when(long_year != "", built(long_year)))
        .when(x.rlike(r"^\d{1,2}/\d{1,2}/\d{2}$"), built(century))
    )


def parse_date_formats(x: Column, formats: Sequence[str] = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd", "M/d/yyyy", "M/d/yyyy H:mm")) -> Column:
    """The first of several formats that fits, fractions beyond six digits cut."""
    cut = F.regexp_replace(F.trim(x), r"(\.\d{6})\d+", "$1")
    cut = F.regexp_replace(cut, r"\.\d{1,6}$", "")
    return F.coalesce(*[F.to_date(F.try_to_timestamp(cut, F.lit(f))) for f in formats])


def money(x: Column, default: float | None = 0.0) -> Column:
    """A number without `$`, commas and spaces; parentheses make it negative; what
    is blank or no number is `default`."""
    bare = F.regexp_replace(F.trim(x), r"[()$,\s]", "").try_cast("double")
    value = F.when(F.trim(x).rlike(r"^\$?\(.*\)$"), -bare).otherwise(bare)
    return value if default is None else F.coalesce(value, F.lit(float(default)))


def truthy(x: Column) -> Column:
    """Nullable boolean of a number or a true/false literal."""
    text = F.lower(F.trim(x.cast("string")))
    return F.when(text.isin("true", "t", "yes"), True).when(text.isin("false", "f", "no"), False).otherwise(text.try_cast("double") != 0)


def code_year(code: Column, prefix: str = "CC", pivot: int = 50) -> Column:
    """The year in a code `PREFIX-YY-...`: below the pivot 20YY, else 19YY."""
    yy = F.nullif(F.regexp_extract(code, rf"^{prefix}-(\d{{2}})-", 1), F.lit("")).try_cast("int")
    return F.when(yy < pivot, yy + 2000).otherwise(yy + 1900)


def cents(amount: Column) -> Column:
    """Whole cents; null counts as 0. Money is compared for equality as this."""
    return F.round(F.coalesce(amount, F.lit(0.0)) * 100, 0).cast("long")


def week_start(d: Column) -> Column:
    """The Monday of a date's week."""
    return F.to_date(F.date_trunc("week", d))


def filled(x: Column) -> Column:
    """Whether there is a value other than the empty string."""
    return x.isNotNull() & (x != "")


def first_filled(*xs: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[F.nullif(x, F.lit("")) for x in xs])


def joined(*parts: Column) -> Column:
    """Filled parts with spaces between."""
    return F.concat_ws(" ", *[F.nullif(F.trim(p), F.lit("")) for p in parts])


def title_case(x: Column) -> Column:
    """Upper case after anything that is no letter, lower case elsewhere."""
    chars = F.split(x, "")
    up = lambda c, i: F.when((i == 0) | ~F.element_at(chars, F.when(i == 0, 1).otherwise(i)).rlike(r"\p{L}"), F.upper(c)).otherwise(F.lower(c))
    return F.array_join(F.transform(chars, up), "")


def valid_name(x: Column, junk: Sequence[str] = ("NAN", "NONE", "NULL", "N/A", "NA", "UNKNOWN", "TEST")) -> Column:
    """The trimmed name, or '' for short ones, words for nothing, and those
    without a letter."""
    t = F.trim(F.coalesce(x, F.lit("")))
    return F.when((F.length(t) < 2) | F.upper(t).isin(*junk) | t.rlike(r"^[\d\W_]+$"), "").otherwise(t)


def similarity(a: Column, b: Column) -> Column:
    """1 - edits / longer length; 0 where either side is null or empty."""
    longer = F.greatest(F.length(a), F.length(b))
    return F.when(filled(a) & filled(b), (longer - F.levenshtein(a, b)) / longer).otherwise(F.lit(0.0))


def has_word(x: Column, *words: str) -> Column:
    """Whether one of the words stands in the text, bounded on both sides."""
    return F.coalesce(x, F.lit("")).rlike(r"\b(" + "|".join(words) + r")\b")


def category(schedule: Column, receipts: Sequence[str] = ("ScheduleA", "ScheduleB", "ScheduleC"), payments: Sequence[str] = ("ScheduleD", "ScheduleF", "ScheduleI")) -> Column:
    """receipt, disbursement or unknown."""
    return F.when(schedule.isin(*receipts), "receipt").when(schedule.isin(*payments), "disbursement").otherwise("unknown")


def straight_quotes(x: Column) -> Column:
    """Typographic quotes and dashes as plain ones."""
    return F.translate(x, "‘’“”–—", "''\"\"--")


def schedule_type(file_name: Column) -> Column:
    """`ScheduleA` of `ScheduleA_PAC.csv`, in the file's own letter case; '' for others."""
    return F.regexp_extract(file_name, r"(?i)^(Schedule[A-Z])(?:_PAC)?\.csv$", 1)
