"""The same postal address written differently.

Rows are parsed into components (house number, direction, street, street type,
city, postcode, or the number of a post-office box), all as Spark expressions.
Distinct forms are blocked on number with postcode, with city and an end or the
sounds of the street, and, where a form lacks city or postcode, with street sound
alone; they are compared component by component with a level for missing values.
The levels' weights are estimated by expectation-maximisation over all blocked
pairs, and a pair links if its weight says match: look-alikes that contradict in
type, direction, city or postcode come out below. Each form then joins the best
linked form of more authority (more components, more rows), so a form with parts
missing never ties two complete, contradicting forms together.

Suites, units and care-of lines are no part of a location. Blank addresses and
those without a number (`on file`, `test`) have no location and are in no pair.
Repeated rows pair with each other like any rows of one location."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.linkage import MISSING, learn, roots, row_pairs, score, value_rates
from tallyforge.session import stored

#: Postal abbreviations.
STREET_TYPES = {
    "st": "street str", "rd": "road", "dr": "drive drv", "ave": "avenue av aven", "ln": "lane", "ct": "court crt", "cir": "circle circ",
    "blvd": "boulevard boul blv", "pkwy": "parkway parkwy pky", "ter": "terrace terr", "tpke": "turnpike tpk tnpk", "hwy": "highway hiway",
    "pl": "place", "sq": "square", "trl": "trail", "way": "wy",
}
DIRECTIONS = {"n": "north no", "s": "south so", "e": "east", "w": "west", "ne": "northeast", "nw": "northwest", "se": "southeast", "sw": "southwest"}
CITY_WORDS = {
    "north": "n no", "south": "s so", "east": "e", "west": "w", "fort": "ft", "mount": "mt", "saint": "st", "springs": "spgs spg", "harbor": "hbr", "beach": "bch",
    "point": "pt", "heights": "hts", "creek": "crk", "village": "vlg", "crossing": "xing", "junction": "jct", "valley": "vly", "landing": "lndg", "lake": "lk", "mills": "mls",
}
#: Values of a city field that name no city.
NO_CITY = ("test", "na", "unknown", "none", "null", "onfile")

_UNIT = r"(?:^|,\s?|\s)(?:(?:ste|suite|unit|apt|apartment|rm|room)\s?#?\s?[0-9]+[a-z]?|#\s?[0-9]+[a-z]?)(?=$|,|\s)"
_BOX = r"^(?:p\s?o\s?b(?:ox)?|post office box|box|po)\s?#?\s?([0-9]+)$"


def _map(words: dict[str, str], itself: bool = True) -> Column:
    pairs = [x for k, v in words.items() for w in ([k] if itself else []) + v.split() for x in (F.lit(w), F.lit(k))]
    return F.create_map(*pairs)


def _city(raw: Column) -> Column:
    text = F.regexp_replace(F.lower(F.coalesce(raw, F.lit(""))), r"[.]", "")
    text = F.regexp_replace(F.trim(text), r",?\s*\bva\s*(?:[0-9]{5}(?:-[0-9]{4})?)?$", "")
    known = _map(CITY_WORDS)
    joined = F.concat_ws("", F.transform(F.split(text, r"[^a-z0-9]+"), lambda w: F.coalesce(F.try_element_at(known, w), w)))
    return F.when(joined.isin(*NO_CITY), "").otherwise(joined)


def parsed(df: DataFrame, address: str, city: str, postcode: str, *keep: str) -> DataFrame:
    """(keep..., kind, number, dir, street, type, city, zip): kind is street, box or
    null for an address without a location; missing components are empty."""
    s = F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(F.col(address), F.lit(""))), r"[.]", ""), r"\s+", " ")
    df = df.select(*keep, F.regexp_replace(s, r"^[ ,]+|[ ,]+$", "").alias("s"), _city(F.col(city)).alias("c"), F.regexp_extract(F.coalesce(F.col(postcode), F.lit("")), r"^\s*([0-9]{5})", 1).alias("z"))
    tail = r",\s?([a-z .]+?), [a-z]{2} ([0-9]{5})(?:-[0-9]{4})?$"
    df = df.withColumn("c", F.when(F.col("c") == "", _city(F.regexp_extract("s", tail, 1))).otherwise(F.col("c")))
    df = df.withColumn("z", F.when(F.col("z") == "", F.regexp_extract("s", tail, 2)).otherwise(F.col("z")))
    df = df.withColumn("s", F.regexp_replace("s", tail, ""))
    df = df.withColumn("s", F.regexp_replace("s", r"^(?:c/o|care of|attn:?) [^,]+,\s?", ""))
    df = df.withColumn("box", F.regexp_extract("s", _BOX, 1))
    df = df.withColumn("s", F.regexp_replace(F.regexp_replace("s", _UNIT, ","), r"^[ ,]+|[ ,]+$", ""))
    head, foot = r"^(?:no )?([0-9]+),? +(.+)$", r"^(.*[a-z].*?),? +([0-9]+)$"
    ahead = F.col("s").rlike(head)
    df = df.withColumn("number", F.when(F.col("box") != "", F.col("box")).when(ahead, F.regexp_extract("s", head, 1)).otherwise(F.regexp_extract("s", foot, 2)))
    df = df.withColumn("rest", F.when(ahead, F.regexp_extract("s", head, 2)).otherwise(F.regexp_extract("s", foot, 1)))
    df = df.withColumn("w", F.filter(F.split(F.col("rest"), r"[^a-z0-9]+"), lambda x: x != ""))
    dirs, types = _map(DIRECTIONS), _map(STREET_TYPES)
    last = lambda: F.try_element_at("w", F.lit(-1))
    first = lambda: F.try_element_at("w", F.lit(1))
    many = F.size("w") > 1
    df = df.withColumn("d1", F.when(many, F.try_element_at(dirs, last())))
    df = df.withColumn("w", F.when(F.col("d1").isNotNull(), F.slice("w", 1, F.size("w") - 1)).otherwise(F.col("w")))
    df = df.withColumn("d0", F.when(many, F.try_element_at(dirs, first())))
    df = df.withColumn("w", F.when(F.col("d0").isNotNull(), F.slice("w", 2, F.size("w") - 1)).otherwise(F.col("w")))
    df = df.withColumn("t", F.when(many, F.try_element_at(types, last())))
    df = df.withColumn("w", F.when(F.col("t").isNotNull(), F.slice("w", 1, F.size("w") - 1)).otherwise(F.col("w")))
    street = F.concat_ws("", "w")
    is_box = F.col("box") != ""
    placed = (F.col("c") != "") | (F.col("z") != "")
    kind = F.when(is_box & placed, "box").when(~is_box & (F.col("number") != "") & street.rlike("[a-z]"), "street")
    part = lambda c: F.when(is_box, "").otherwise(c)
    form = F.struct(
        kind.alias("kind"),
        F.regexp_replace("number", r"^0+(?=.)", "").alias("number"),
        part(F.coalesce("d0", "d1", F.lit(""))).alias("dir"),
        part(street).alias("street"),
        part(F.coalesce("t", F.lit(""))).alias("type"),
        F.col("c").alias("city"),
        F.col("z").alias("zip"),
    )
    # Through a one-element explode: filters above do not copy the whole parse into themselves.
    return df.select(*keep, F.explode(F.array(form)).alias("__form")).select(*keep, "__form.*")


PARTS = ["kind", "number", "dir", "street", "type", "city", "zip"]
#: Of a name, how many others are within two and within three edits, for each
#: that is the same: what the chance of a near agreement is taken from.
NEIGHBOURS = {2: 4.0, 1: 12.0}


def random_levels(forms: DataFrame) -> dict[str, dict[int, float]]:
    """The chance of each comparison level for two forms drawn at random, from
    highest agreement to lowest, by the frequencies of all values."""
    rates = value_rates(forms, ["street", "type", "dir", "city", "zip"])

    def levels(name: str, near: dict[int, float], top: int) -> dict[int, float]:
        have, same = rates[name]
        out = {top: have**2 * same} | {k: have**2 * same * v for k, v in near.items()} | {MISSING: 1 - have**2}
        out[0] = have**2 - sum(v for k, v in out.items() if k != MISSING)
        return {k: min(max(v, 0.0), 1.0) for k, v in out.items()}

    street = levels("street", NEIGHBOURS, 3)
    street[0] = max(1 - sum(v for k, v in street.items() if k != 0), 0.5)
    del street[MISSING]
    have, same = rates["dir"]
    direction = {1: have**2 * same + (1 - have) ** 2, MISSING: 2 * have * (1 - have), 0: have**2 * (1 - same)}
    return {"street_l": street, "type_l": levels("type", {}, 1), "dir_l": direction, "city_l": levels("city", {1: 0.5}, 2), "zip_l": levels("zip", {}, 1)}


def _near(a: Column, b: Column, edits: int = 2, share: float = 0.25) -> Column:
    """At most so many edits (a swap of letters counts as two), and few for the length."""
    d = F.levenshtein(a, b, edits)
    return (d >= 0) & (d <= F.greatest(F.lit(1), F.ceil(F.greatest(F.length(a), F.length(b)) * share)))


def _block_keys() -> Column:
    """Keys of a form: the number with postcode or city and an end of the street's
    name, so that a slip at one end leaves another key; with the sounds of street and
    city; and, marked open, with street sound alone. An open key only blocks pairs of
    which a form lacks city or postcode. Null keys block nothing."""
    n, z, s, c = F.col("number"), F.col("zip"), F.col("street"), F.col("city")
    with_zip = lambda x: F.when(z != "", F.concat_ws("|", F.col("kind"), z, n, x))
    with_city = lambda *x: F.when(c != "", F.concat_ws("|", *x))
    none = F.lit(None).cast("string")
    street = (
        with_zip(F.substring(s, 1, 1)),
        with_zip(F.substring(s, -1, 1)),
        with_city(F.lit("e"), n, c, F.substring(s, 1, 1)),
        with_city(F.lit("f"), n, F.soundex(c), F.soundex(s)),
        with_city(F.lit("g"), n, F.soundex(F.reverse(c)), F.soundex(F.reverse(s))),
        F.concat_ws("|", F.lit("a"), n, F.soundex(s)),
        F.concat_ws("|", F.lit("b"), n, F.soundex(F.reverse(s))),
    )
    box = (with_zip(F.lit("")), none, none, with_city(F.lit("c"), n, F.soundex(c)), with_city(F.lit("d"), n, F.soundex(F.reverse(c))), none, none)
    return F.array(*[F.xxhash64(k) * F.when(k.isNotNull(), 1) for k in (F.when(F.col("kind") == "box", x).otherwise(y) for x, y in zip(box, street))])


#: The first of the open keys.
OPEN = 5


def candidate_pairs(forms: DataFrame) -> DataFrame:
    """Blocked pairs of forms with their comparison levels, each pair once. Only keys
    and the numbers of forms are joined in blocks; parts are fetched for pairs alone. A
    block of many forms is a skewed key, which adaptive execution cuts into tasks."""
    lacks = (F.col("city") == "") | (F.col("zip") == "")
    keyed = forms.select("form", lacks.alias("lacks"), F.posexplode(_block_keys()).alias("i", "key")).filter("key IS NOT NULL")
    a = keyed.filter((F.col("i") < OPEN) | F.col("lacks")).select("i", "key", F.col("form").alias("a"))
    b = keyed.select("i", "key", F.col("form").alias("b"), F.col("lacks").alias("lacks_b"))
    # Side a of an open key lacks a part; where both do, the smaller form is side a.
    ordered = (F.col("a") < F.col("b")) | (F.col("i") >= OPEN) & ~F.col("lacks_b") & (F.col("a") != F.col("b"))
    pairs = a.join(b, ["i", "key"]).filter(ordered).select(F.least("a", "b").alias("form_a"), F.greatest("a", "b").alias("form_b")).distinct()
    left, right = (forms.select(*[F.col(c).alias(f"{c}_{side}") for c in ("form", *PARTS, "n")]) for side in "ab")
    both = pairs.join(left, "form_a").join(right, "form_b").filter("kind_a = kind_b AND number_a = number_b")

    def level(name: str, near: bool) -> Column:
        x, y = F.col(f"{name}_a"), F.col(f"{name}_b")
        out = F.when((x == "") | (y == ""), F.lit(MISSING)).when(x == y, F.lit(2 if near else 1))
        return (out.when(_near(x, y), F.lit(1)) if near else out).otherwise(F.lit(0))

    x, y = F.col("street_a"), F.col("street_b")
    street = F.when(x == y, 3).when(_near(x, y), 2).when(_near(x, y, 3, 0.375), 1).otherwise(0)
    # Two forms without a direction agree in it: most streets have none.
    direction = F.when(F.col("dir_a") == F.col("dir_b"), 1).when((F.col("dir_a") == "") | (F.col("dir_b") == ""), MISSING).otherwise(0)
    return both.select(
        "form_a", "form_b", "n_a", "n_b", *[_full(side).alias(f"full_{side}") for side in "ab"],
        street.alias("street_l"), level("type", False).alias("type_l"), direction.alias("dir_l"), level("city", True).alias("city_l"), level("zip", False).alias("zip_l"),
    )


def _full(side: str) -> Column:
    """How complete a form is: direction, type, city and postcode."""
    return sum((F.when(F.col(f"{c}_{side}") != "", 1).otherwise(0) for c in ("dir", "type", "city", "zip")), F.lit(0))


#: Bits of evidence for a match from which a pair links.
THRESHOLD = 0.0


def form_roots(forms: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(node, root) of forms that are not their own location's first form. What links is
    decided by the estimated weights; of a form's links the one that agrees in more and
    in rarer values counts."""
    pairs = stored(candidate_pairs(forms), "address-pairs")
    weights, bits = learn(pairs, random_levels(forms))
    linked = pairs.filter(score(weights) >= threshold).withColumn("weight", score(bits))
    rank = lambda side: F.struct(F.col(f"full_{side}").alias("full"), F.col(f"n_{side}").alias("n"), F.col(f"form_{side}").alias("form"))
    up = linked.select("weight", F.least(rank("a"), rank("b")).alias("low"), F.greatest(rank("a"), rank("b")).alias("high"))
    best = up.groupBy(F.col("low.form").alias("node")).agg(F.max(F.struct("weight", "high")).alias("best"))
    return roots(best.select("node", F.col("best.high.form").alias("parent")))


def locations(df: DataFrame, row: str = "id", address: str = "entity_address", city: str = "entity_city", postcode: str = "entity_zip") -> DataFrame:
    """(row, location): the location of each row that has one. `location` is the
    hash of its most complete form."""
    rows = parsed(df, address, city, postcode, row).filter("kind IS NOT NULL").withColumn("form", F.xxhash64(*PARTS))
    rows = stored(rows, "address-rows")
    forms = stored(rows.groupBy("form").agg(*[F.first(c).alias(c) for c in PARTS], F.count(F.lit(1)).alias("n")), "address-forms")
    top = form_roots(forms)
    return rows.select(row, "form").join(top, F.col("form") == F.col("node"), "left").select(row, F.coalesce("root", "form").alias("location"))


def location_classes(df: DataFrame, row: str = "id", **columns: str) -> DataFrame:
    """(row, class, rows): each row that has a location with the smallest row of it
    and how many it has."""
    found = locations(df, row, **columns)
    classes = found.groupBy("location").agg(F.min(row).alias("class"), F.count(F.lit(1)).alias("rows"))
    return found.join(classes, "location").select(row, "class", "rows")


def same_location(df: DataFrame, row: str = "id", **columns: str) -> DataFrame:
    """(id_a, id_b): every pair of rows at the same location, id_a < id_b."""
    return row_pairs(locations(df, row, **columns), "location", row)
