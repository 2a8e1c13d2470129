"""Variant spellings of names typed by people: merge and rematch.

Distinct strings become profiles: readings (surname, given name, middle initial,
or the words and legal form of an organisation), suffix, and the context they
occur with (postcodes and employers, or committee codes). Profiles that block
together and match are merged; a merged profile unions its members' readings,
initials and context, and as a richer one re-enters blocking, until nothing more
merges. A profile joins the best match of more authority (more rows), and a merge
that would unite different middle initials, suffixes or legal forms is undone for
the minority, which re-enters blocking as well.

Any two names that match share a block key (see `block_keys`): a surname with three
letters of the given name, a surname with a letter deleted with the full given name,
or a context value with an end of the surname and one of the given name. There is no
cap on candidates, nor on context: a profile with many values keeps the rest of them in
`pages`, which give block keys and are looked through like the first. A slip in a surname of three or four letters links only with the same
given name and agreeing context, two slips only with agreeing context and one end of
the surname the same; surnames of two letters must be the same.

Placeholders and blank strings are nobody. Relatives with different suffixes, and
committees of different style or office, are different. All strings are compared
without case, accents and punctuation; repeated rows only add authority.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyforge.llm.linkage import roots, row_pairs
from tallyforge.session import cut

#: Texts that name nobody.
PLACEHOLDERS = ("", "-", "--", "anonymous", "na", "none", "not provided", "notprovided", "null", "unknown", "test", "tbd", "various", "unitemized", "not available", "not applicable", "information requested", "same as above", "on file")
#: Given names and what they are shortened to.
NICKNAMES = {
    "alexander": "alex al sandy xander", "andrew": "andy drew", "anthony": "tony ant", "barbara": "babs barb barbie bobbie", "benjamin": "ben benny", "charles": "chuck charlie",
    "christopher": "chris kit", "daniel": "dan danny", "david": "dave davey", "deborah": "deb debbie debby", "donald": "don donnie", "dorothy": "dot dottie", "edward": "ed eddie eddy ted teddy ned",
    "elizabeth": "beth liz lizzie betsy betty eliza bess libby", "frances": "fran frannie franny frankie", "gregory": "greg gregg", "harold": "harry hal", "isabella": "isa izzy bella", "james": "jim jimmy jamie",
    "jennifer": "jen jenny", "john": "jack johnny", "joseph": "joe joey", "judith": "judy", "katherine": "kate kathy katie kat cathy kay", "kenneth": "ken kenny", "lawrence": "larry laurie lawrie", "margaret": "maggie peg peggy meg",
    "matthew": "matt", "michael": "mike mick mickey mikey", "nathaniel": "nat nate nathan", "nicholas": "nick nicky", "ophelia": "opal", "patricia": "pat patty patti trish tricia", "rebecca": "becky", "richard": "rick rich dick richie ricky",
    "robert": "bob rob bobby robbie", "ronald": "ron ronnie", "samuel": "sam sammy", "stephen": "steve", "steven": "steve", "susan": "sue susie suzy", "theodore": "ted teddy theo", "thomas": "tom tommy", "timothy": "tim timmy",
    "vincent": "vince vinny vin", "virginia": "ginny gina ginger", "walter": "walt wally", "william": "bill will billy willie willy", "zachary": "zach zack zak",
}
HONORIFICS = {"mr", "mrs", "ms", "miss", "dr", "hon", "honorable", "rev", "sir", "prof", "sen", "del", "judge"}
SUFFIXES = {"jr": "jr", "junior": "jr", "sr": "sr", "senior": "sr", "ii": "ii", "iii": "iii", "iv": "iv", "2nd": "ii", "3rd": "iii"}
LEGAL = {"inc": "inc", "incorporated": "inc", "corp": "corp", "corporation": "corp", "co": "co", "company": "co", "llc": "llc", "llp": "llp", "lp": "lp", "ltd": "ltd", "limited": "ltd", "plc": "plc"}
_PAC = re.compile(r"\b(?:pac|pol(?:it|itical)? action (?:committee|comm|cmte|cttee))\b")

_FULL: dict[str, set[str]] = {}
for _full, _shorts in NICKNAMES.items():
    _FULL.setdefault(_full, set()).add(_full)
    for _short in _shorts.split():
        _FULL.setdefault(_short, set()).add(_full)


def plain(text: str) -> str:
    """Lower case without accents; dots between single letters go with them."""
    text = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).lower()
    text = re.sub(r"\b((?:[a-z]\.){2,})", lambda m: m.group(1).replace(".", "") + " ", text)
    return re.sub(r"\s+", " ", text).strip()


def is_placeholder(text: str | None) -> bool:
    return text is None or re.sub(r"[^a-z ]", "", plain(text)).strip() in PLACEHOLDERS or not re.search(r"[^\W\d_]", text)


def _letters(word: str) -> str:
    return re.sub(r"[^a-z0-9]", "", word)


def person(text: str) -> tuple[str, list[tuple[str, str, str]]]:
    """(suffix, readings): each reading is (surname, given name, middle initial)."""
    text = plain(text)
    nicks = re.findall(r'["“(]([^"”)]+)["”)]', text)
    text = re.sub(r'["“(][^"”)]+["”)]', " ", text)
    suffix = ""
    parts = []
    for part in text.split(","):
        kept = []
        for word in part.split():
            w = _letters(word)
            if w in SUFFIXES:
                suffix = SUFFIXES[w]
            elif w and w not in HONORIFICS:
                kept.append(w)
        if kept:
            parts.append(kept)
    if not parts:
        return suffix, []
    if len(parts) > 1:
        last, rest = "".join(parts[0]), [w for p in parts[1:] for w in p]
        readings = [(last, rest[0], rest[1][0] if len(rest) > 1 else "")]
    else:
        words = parts[0]
        if len(words) == 1:
            return suffix, [(words[0], "", "")]
        readings = [(words[-1], words[0], words[1][0] if len(words) > 2 else "")]
        if len(words) == 2 and words[1] in _FULL and words[0] not in _FULL or len(words) == 2 and len(words[1]) > 1 and len(words[0]) > 1:
            readings.append((words[0], words[1], ""))
    last, _, middle = readings[0]
    readings += [(last, _letters(n), middle) for n in nicks if _letters(n)]
    return suffix, readings


def organisation(text: str) -> list[tuple[str, str, str]]:
    """One reading: the words, nothing, the legal form."""
    text = re.sub(r"['’]s\b", "", plain(text)).replace("&", " and ")
    parts = [[_letters(w) for w in re.split(r"[\s\-/]+", p) if _letters(w)] for p in text.split(",")]
    legal, kept = "", []
    for part in parts:
        while part and part[-1] in LEGAL and (len(part) > 1 or kept):
            legal = LEGAL[part.pop()]
        if part:
            kept.append(part)
    if len(kept) > 1 and len(kept[-1]) == 1:  # `Marine Hospital, Trencasacre`
        kept = [kept[-1], *kept[:-1]]
    words = [w for p in kept for w in p if w not in ("the", "and")]
    return [(" ".join(words), "", legal)] if words else []


def is_friends(word: str) -> bool:
    """Whether a word is `friends` with at most one slip or with letters left out."""
    return edits(word, "friends", 1) <= 1 or abbreviates(word, "friends")


def committee(text: str) -> tuple[str, str, list[tuple[str, str, str]]]:
    """(style, suffix, readings) of a committee's name: friends of a person, a
    person for an office, a political action committee, or an organisation."""
    text = re.sub(r"^the ", "", plain(text))
    bare = re.sub(r"[.]", "", text)
    if _PAC.search(bare):
        rest = re.sub(r"^\s*of\s+|\s+of\s*$", "", _PAC.sub(" ", bare).strip())
        return "pac", "", organisation(rest)
    for pattern, style in (
        (r"^(?P<f>[a-z]+) (?:of|for) (?P<n>.+)$", "friends"),
        (r"^(?P<n>.+?),? (?P<f>[a-z]+) (?:of|for)$", "friends"),
        (r"^(?:committee|cmte|comm)\.? for (?P<o>[a-z ]+): ?(?P<n>.+)$", ""),
        (r"^(?:committee|cmte|comm)\.? to elect (?P<n>.+)$", "elect"),
        (r"^(?P<n>.+?) (?:for|4) (?P<o>[a-z ]+?)(?: (?:committee|cmte|comm|campaign)\.?)?$", ""),
    ):
        m = re.match(pattern, text)
        if m and (style != "friends" or is_friends(m.group("f"))):
            suffix, readings = person(m.group("n"))
            if readings:
                return style or f"for {m.group('o').strip()}", suffix, readings
    return "org", "", organisation(text)


@lru_cache(1 << 17)
def edits(a: str, b: str, most: int) -> int:
    """Edits between two words, a swap of neighbours being one; most + 1 if more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    if a == b:
        return 0
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        older, before, row = before, row, [i]
        for j, y in enumerate(b, 1):
            v = min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, older[j - 2] + 1)
            row.append(v)
        if min(row) > most:
            return most + 1
    return min(row[-1], most + 1)


def abbreviates(a: str, b: str) -> bool:
    """Whether a (at least 3 letters) is b with letters left out, the first kept."""
    if len(a) < 3 or len(a) >= len(b) or a[0] != b[0] or len(b) - len(a) < 2:
        return False
    it = iter(b)
    return all(c in it for c in a)


def shortens(short: str, long: str) -> bool:
    """Whether a given name is a short form of another by its letters: the beginning
    (3 letters on), the end (4 letters on), or a beginning with -i, -ie, -y or -ey."""
    if not 3 <= len(short) < len(long):
        return False
    stem = re.sub(r"(?:ie|ey|y|i)$", "", short)
    return long.startswith(short) or len(short) > 3 and long.endswith(short) or len(stem) >= 3 and long.startswith(stem)


@lru_cache(1 << 17)
def given_level(a: str, b: str) -> int:
    """3 same name or nickname of it, 2 a slip or a shortened form, 1 an initial, 0."""
    if not a or not b:
        return 0
    full_a, full_b = _FULL.get(a, set()), _FULL.get(b, set())
    if a == b and len(a) > 1 or (full_a & full_b):
        return 3
    if len(a) == 1 or len(b) == 1:
        return int(bool({a[0], *(f[0] for f in full_a)} & {b[0], *(f[0] for f in full_b)}))
    short, long = sorted((a, b), key=len)
    if shortens(short, long) or len(short) >= 3 and edits(a, b, 1) <= 1:
        return 2
    # A slip in a nickname or of a full name whose nickname stands on the other side.
    close = lambda x, ys: any(len(x) > 3 and (edits(x, y, 1) <= 1 or (len(y) > len(x) >= 3 and y.startswith(x))) for y in ys)
    return 2 if close(a, full_b) or close(b, full_a) else 0


@lru_cache(1 << 17)
def words_level(a: str, b: str) -> int:
    """2 the same words or abbreviations of them, 1 with one slip, 0."""
    x, y = a.split(), b.split()
    if len(x) == len(y):
        slips = 0
        for v, w in zip(x, y):
            if v == w or abbreviates(v, w) or abbreviates(w, v):
                continue
            short, long = sorted((v, w), key=len)
            if edits(v, w, 1) <= 1 and len(long) > 3:
                slips += 1
            elif len(short) > 3 and edits(short, long[: len(short)], 1) <= 1 and len(long) - len(short) >= 2 or len(short) > 3 and len(long) - len(short) >= 2 and any(abbreviates(short[:i] + short[i + 1 :], long) for i in range(1, len(short))):
                slips += 1  # a slip inside an abbreviation
            else:
                return 0
        return 2 if slips == 0 else 1 if slips <= 2 else 0
    j, k = "".join(x), "".join(y)
    return 2 if j == k else 1 if edits(j, k, 1) <= 1 else 0


#: How far two names may differ, by whether their context agrees (1), is unknown
#: (0) or differs (-1): the least sum of levels that links.
def linked(kind: str, surname: int, given: int, context: int) -> bool:
    if surname == 2 and given == 3:
        return kind != "entity" or context >= 0
    if surname == 2 and given == 2 or surname == 1 and given == 3:
        return context >= 0 if kind == "entity" else True
    return context == 1


@lru_cache(1 << 16)
def _readings(packed: tuple[str, ...]) -> list[tuple[str, str, str]]:
    return [tuple(r.split("|")) for r in packed]


def match(kind: str, style: str, a: Sequence[str], b: Sequence[str], context: int) -> int:
    """0, or the strength of a match of two profiles' readings (`s|g|m`)."""
    x, y = _readings(tuple(a)), _readings(tuple(b))
    m, n = {r[2] for r in x if r[2]}, {r[2] for r in y if r[2]}
    if m and n and not m & n:
        return 0
    best = 0
    for s, g, _ in x:
        for t, h, _ in y:
            if style in ("org", "pac"):
                level = words_level(s, t)
                if level == 2 or level == 1 and (context >= 0 or kind != "entity"):
                    best = max(best, 10 * level + 3 + context)
                continue
            e = 2 if s == t else 0
            if not e and min(len(s), len(t)) > 4:
                d = edits(s, t, 2 if context == 1 else 1)
                e = int(d <= 1 or d == 2 and context == 1 and (s[:2] == t[:2] or s[-2:] == t[-2:]))
            elif not e and min(len(s), len(t)) > 2 and context == 1 and given_level(g, h) == 3:
                e = int(edits(s, t, 1) <= 1)
            if e:
                f = given_level(g, h)
                if f and linked(kind, e, f, context):
                    best = max(best, 10 * e + 3 * f + context)
    return best


def _shortened_once(word: str) -> set[str]:
    return {word[:i] + word[i + 1 :] for i in range(len(word))}


@lru_cache(1 << 16)
def _given_keys(given: str) -> frozenset[str]:
    """Keys of which two given names that are alike in any way but by initial share
    one: three letters of the first four of it and of its full forms, and the last four."""
    out = set()
    for c in {given, *_FULL.get(given, ())}:
        out |= {c} if len(c) < 3 else {c[:3]} | _shortened_once(c[:4]) | ({"$" + c[-4:]} if len(c) > 3 else set())
    return frozenset(out)


def block_keys(kind: str, style: str, suffix: str, readings: Sequence[str], context: Sequence[str]) -> set[str]:
    """Keys of which any two profiles that match share one. People: the surname with
    keys of the given name; the surname with a letter deleted, with the full given
    name; and a context value with an end of the surname and one of the given name, for names
    further apart. Organisations: the first word with a letter deleted, with an
    initial, and a context value with two letters."""
    out = set()
    base = f"{kind}|{style}|{suffix}|"
    for s, g, _ in _readings(tuple(readings)):
        if style in ("org", "pac"):
            words = s.split()
            head, inits = words[0], {w[0] for w in words[1:2]} or {""}
            deleted = {head} | _shortened_once(head) if len(head) >= 5 else {head}
            out |= {f"{base}{i}|{d}" for i in inits for d in deleted}
        elif g:
            full = {g, *_FULL.get(g, ())}
            out |= {f"{base}{s}|{k}" for k in _given_keys(g)}
            if len(g) > 1 and len(s) > 2:
                out |= {f"{base}-{d}|{f}" for d in {s} | _shortened_once(s) for f in full}
    return out | context_keys(kind, style, suffix, readings, context)


def context_keys(kind: str, style: str, suffix: str, readings: Sequence[str], context: Sequence[str]) -> set[str]:
    """The block keys that context values give."""
    ends = set()
    for s, g, _ in _readings(tuple(readings)):
        if style in ("org", "pac"):
            ends.add(s.split()[0][:2])
        elif g:
            full = {g, *_FULL.get(g, ())}
            ends |= {f"{e}|{i}" for e in (s[:2], "-" + s[-2:]) for i in {f[0] for f in full} | {"-" + f[-1] for f in full if len(f) > 1}}
    return {f"{kind}|{style}|{suffix}|@{c}|{e}" for c in context for e in ends}


PROFILE = "id bigint, kind string, style string, suffix string, readings array<string>, context array<string>, spread boolean, n bigint"


def _profiles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for df in batches:
        out = []
        for name_id, kind, name, is_person, context, spread, n in zip(df["id"], df["kind"], df["name"], df["is_person"], df["context"], df["spread"], df["n"]):
            if is_placeholder(name):
                continue
            if kind == "committee":
                style, suffix, readings = committee(name)
            else:
                readings = organisation(name) if kind == "entity" else []
                # A legal form names an organisation, whatever the rows' flag says.
                if readings and (not is_person or readings[0][2]):
                    style, suffix = "org", ""
                else:
                    style, (suffix, readings) = "person", person(name)
            if readings:
                out.append((name_id, kind, style, suffix, ["|".join(r) for r in readings], list(context), spread, n))
        yield pd.DataFrame(out, columns=["id", "kind", "style", "suffix", "readings", "context", "spread", "n"])


def profiles(names: DataFrame) -> DataFrame:
    """names: (id, kind, name, is_person, context, spread, n), one row per distinct string."""
    return names.mapInPandas(_profiles, PROFILE)


def _keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for df in batches:
        ids, fresh, keys = [], [], []
        for i, kind, style, suffix, readings, context, new, page in zip(df["id"], df["kind"], df["style"], df["suffix"], df["readings"], df["context"], df["fresh"], df["page"]):
            found = sorted((context_keys if page else block_keys)(kind, style, suffix, list(readings), list(context)))
            ids += [i] * len(found)
            fresh += [new] * len(found)
            keys += found
        yield pd.DataFrame({"id": ids, "fresh": fresh, "key": keys})


def _matched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for df in batches:
        strength = []
        for kind, style, ra, rb, context in zip(df["kind"], df["style"], df["readings_a"], df["readings_b"], df["context"]):
            strength.append(match(kind, style, tuple(ra), tuple(rb), context))
        out = df[["a", "b", "n_a", "n_b"]].assign(strength=strength)
        yield out[out["strength"] > 0]


def _agreeing(both: DataFrame, now: DataFrame, pages: DataFrame) -> DataFrame:
    """(a, b) of the pairs that share a context value which stands on a page of one
    of them. The values of the side without pages, which are few, are looked up in
    the other's; joins spread all values over tasks, and no task holds a profile's."""
    own = now.filter("more").select("id", F.explode("context").alias("v"))
    values = cut(own.union(pages.select("id", F.explode("context").alias("v"))).distinct())
    open_ = both.filter((F.col("more_a") | F.col("more_b")) & ~F.arrays_overlap("context_a", "context_b"))
    one = open_.filter("NOT (more_a AND more_b)").select("a", "b", F.when(F.col("more_a"), F.col("a")).otherwise(F.col("b")).alias("id"), F.explode(F.when(F.col("more_a"), F.col("context_b")).otherwise(F.col("context_a"))).alias("v"))
    two = open_.filter("more_a AND more_b").select("a", "b").join(values.withColumnRenamed("id", "a"), "a").select("a", "b", F.col("b").alias("id"), "v")
    return one.union(two).join(values, ["id", "v"], "left_semi").select("a", "b").distinct()


def matches(now: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """(a, b, n_a, n_b, strength) of matching profiles of which at least one is new or set back.
    pages: (id, context) of further context values of profiles.

    A block is of names so alike that most of it matches. One that is large all the
    same is a skewed key of a join, which adaptive execution cuts into several tasks."""
    parts = now.select("id", "kind", "style", "suffix", "readings", "context", "fresh", F.lit(False).alias("page"))
    if pages is not None:
        parts = parts.unionByName(parts.drop("context", "page").join(pages, "id").withColumn("page", F.lit(True)))
    keyed = parts.mapInPandas(_keyed, "id bigint, fresh boolean, key string").select("id", "fresh", F.xxhash64("key").alias("key"))
    x, y = (keyed.select(F.col("id").alias(i), F.col("fresh").alias(f"f{i}"), "key") for i in "ab")
    pairs = x.join(y, "key").filter("a < b AND (fa OR fb)").select("a", "b").distinct()
    more = F.lit(False)
    if pages is not None:
        now, more = cut(now.join(pages.select("id").distinct().withColumn("more", F.lit(True)), "id", "left").fillna(False, ["more"])), F.col("more")
    left = now.select(F.col("id").alias("a"), "kind", "style", F.col("readings").alias("readings_a"), F.col("context").alias("context_a"), F.col("spread").alias("sa"), F.col("n").alias("n_a"), more.alias("more_a"))
    right = now.select(F.col("id").alias("b"), F.col("readings").alias("readings_b"), F.col("context").alias("context_b"), F.col("spread").alias("sb"), F.col("n").alias("n_b"), more.alias("more_b"))
    both = pairs.join(left, "a").join(right, "b").withColumn("spread", F.col("sa") | F.col("sb")).drop("sa", "sb")
    agrees = F.arrays_overlap("context_a", "context_b")
    if pages is not None:
        both = cut(both)
        both = both.join(_agreeing(both, now, pages).withColumn("paged", F.lit(True)), ["a", "b"], "left")
        agrees |= F.col("paged").isNotNull()
    unknown = F.col("spread") | (F.size("context_a") == 0) | (F.size("context_b") == 0)
    both = both.withColumn("context", F.when(agrees, 1).when(unknown, 0).otherwise(-1))
    return both.select("a", "b", "n_a", "n_b", "kind", "style", "readings_a", "readings_b", "context").mapInPandas(_matched, "a bigint, b bigint, n_a bigint, n_b bigint, strength int")


#: A string of which no context value of a sort has at least this share of its rows
#: with a value of that sort is `spread`: that its values differ from others' says nothing.
CONTEXT_SHARE = 0.2
#: Context values in a profile's row; those beyond stand on pages of as many at most.
#: A merged profile with more is `spread` too.
MOST = 64


def _some(pages: DataFrame) -> DataFrame | None:
    pages = cut(pages)
    return pages if pages.limit(1).count() else None


def resolve(names: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """(id, cluster) of every string that names someone. Every round with a match
    merges at least two profiles, so the rounds come to an end by themselves.
    pages: (id, context) of further context values of the strings."""
    now = cut(profiles(names).withColumn("fresh", F.lit(True)))
    if pages is not None:
        pages = _some(pages.join(now.select("id"), "id"))
    members = now.select("id", F.col("id").alias("cluster"))
    while True:
        found = matches(now) if pages is None else matches(now, pages)
        rank = lambda s: F.struct(F.col(f"n_{s}").alias("n"), F.col(s).alias("id"))
        up = found.select("strength", F.least(rank("a"), rank("b")).alias("low"), F.greatest(rank("a"), rank("b")).alias("high"))
        best = up.groupBy(F.col("low.id").alias("node")).agg(F.max(F.struct("strength", "high")).alias("best"))
        parents = cut(best.select("node", F.col("best.high.id").alias("parent")))
        if not parents.limit(1).count():
            return members
        top = roots(parents)
        grouped = now.join(top, F.col("id") == F.col("node"), "left").withColumn("root", F.coalesce("root", "id")).drop("node")
        # The third part of a reading is what must not differ: middle initial or legal form.
        third = F.array_distinct(F.filter(F.transform("readings", lambda r: F.element_at(F.split(r, r"\|"), 3)), lambda m: m != ""))
        grouped = cut(grouped.withColumn("third", third))
        votes = grouped.select("root", "n", F.explode("third").alias("m")).groupBy("root", "m").agg(F.sum("n").alias("n"))
        ruling = votes.groupBy("root").agg(F.max_by("m", F.struct("n", "m")).alias("ruling"))
        grouped = grouped.join(ruling, "root", "left")
        out = F.col("ruling").isNotNull() & (F.size("third") > 0) & ~F.array_contains("third", F.col("ruling"))
        grouped = cut(grouped.withColumn("out", out))
        # Where the minority holds the root, the rest goes on under its own best authority.
        kept = grouped.filter("NOT out").groupBy("root").agg(F.max_by("id", F.struct("n", "id")).alias("kept"))
        grouped = grouped.join(kept, "root").withColumn("root", F.when(F.col("out"), F.col("id")).otherwise(F.col("kept")))
        grouped = cut(grouped.select("id", "root", "out", "kind", "style", "suffix", "readings", "context", "spread", "n"))
        moved = grouped.filter("id <> root").limit(1).count()
        if not moved:
            return members
        members = cut(members.join(grouped.select(F.col("id").alias("cluster"), "root"), "cluster").select("id", F.col("root").alias("cluster")))
        merged = cut(
            grouped.groupBy(F.col("root").alias("id")).agg(
                F.first("kind").alias("kind"),
                F.first("style").alias("style"),
                F.first("suffix").alias("suffix"),
                F.array_sort(F.array_distinct(F.flatten(F.collect_set("readings")))).alias("readings"),
                F.array_sort(F.array_distinct(F.flatten(F.collect_set("context")))).alias("all"),
                F.bool_or("spread").alias("spread"),
                F.sum("n").alias("n"),
                # Those set back are compared again: with each other, and with what they left for
                # their best match. What they were set back from has the ruling part now, so the
                # refused merge is no match any more, and at least two of its members stay merged.
                ((F.count(F.lit(1)) > 1) | F.bool_or("out")).alias("fresh"),
            ).withColumns({"context": F.slice("all", 1, MOST), "rest": F.slice("all", MOST + 1, 2**31 - 1), "spread": F.col("spread") | (F.size("all") > MOST)}).drop("all")
        )
        now, beyond = merged.drop("rest"), merged.filter(F.size("rest") > 0)
        if pages is not None or beyond.limit(1).count():
            cuts = F.transform(F.sequence(F.lit(0), F.floor((F.size("rest") - 1) / MOST).cast("int")), lambda i: F.slice("rest", i * MOST + 1, MOST))
            turned = beyond.select("id", F.explode(cuts).alias("context"))
            if pages is not None:
                turned = turned.union(pages.join(grouped.select("id", "root"), "id").select("root", "context"))
            pages = cut(turned)


def strings(rows: DataFrame, columns: Sequence[tuple[str, str, dict[str, Column], Column]]) -> tuple[DataFrame, DataFrame]:
    """(id, kind, name, is_person, context, spread, n) of the distinct strings of
    columns, each given as kind, name, context values by their sort, whether a person;
    and pages (id, context) of the context values that are too many for a row.

    The context is all values its rows have; placeholders are no values."""
    slots = []
    for kind, name, values, is_person in columns:
        found = F.filter(F.array(*[F.struct(F.lit(s).alias("s"), v.alias("v")) for s, v in values.items()]), lambda x: ~F.lower(x["v"]).isin(*PLACEHOLDERS))
        whole = F.array(F.struct(F.lit("").alias("s"), F.lit("").alias("v")))  # stands for the row itself
        slots.append(F.struct(F.lit(kind).alias("kind"), F.col(name).alias("name"), F.when(is_person, 1).when(~is_person, -1).otherwise(0).alias("p"), F.concat(whole, found).alias("values")))
    each = rows.select(F.explode(F.array(*slots)).alias("e")).select("e.*").filter(F.trim("name") != "").select("kind", "name", "p", F.explode("values").alias("x"))
    every = cut(each.groupBy("kind", "name", "x.s", "x.v").agg(F.count(F.lit(1)).alias("k"), F.sum("p").alias("p")))
    counted = every.filter("s = ''").select("kind", "name", F.col("k").alias("n"), (F.col("p") >= 0).alias("is_person"))
    uses = every.filter("s <> ''").select("kind", "name", "s", "v", "k")
    totals = uses.groupBy("kind", "name", "s").agg(F.sum("k").alias("total"), F.max("k").alias("top"))
    place = F.row_number().over(Window.partitionBy("kind", "name", "s").orderBy(F.col("k").desc(), "v"))
    placed = uses.withColumn("page", F.floor((place - 1) / (MOST // 2)))
    kept = placed.join(totals, ["kind", "name", "s"]).withColumn("wide", F.col("top") < CONTEXT_SHARE * F.col("total"))
    parts = cut(kept.groupBy("kind", "name", "page").agg(F.array_sort(F.collect_set(F.concat_ws(":", "s", "v"))).alias("context"), F.bool_or("wide").alias("spread")))
    key = F.xxhash64("kind", "name").alias("id")
    both = counted.join(parts.filter("page = 0"), ["kind", "name"], "left").withColumns({"context": F.coalesce("context", F.array().cast("array<string>")), "spread": F.coalesce("spread", F.lit(False))})
    return both.select(key, "kind", "name", "is_person", "context", "spread", "n"), parts.filter("page > 0").select(key, "context")


def resolved(df: DataFrame) -> DataFrame:
    """(kind, name, cluster): every string of the three name columns of a transaction
    table that names someone, with the id of its cluster's leading string."""
    zip5 = F.regexp_extract(F.coalesce("entity_zip", F.lit("")), r"^\s*([0-9]{5})", 1)
    code = {"code": F.upper(F.trim(F.coalesce("committee_code", F.lit(""))))}
    place = {"zip": zip5, "employer": F.upper(F.trim(F.coalesce("entity_employer", F.lit(""))))}
    yes = F.lit(True)
    names, pages = strings(df, [("entity", "entity_name", place, F.col("entity_is_individual")), ("candidate", "candidate_name", code, yes), ("committee", "committee_name", code, yes)])
    names = cut(names)
    return names.select("id", "kind", "name").join(resolve(names, pages), "id").select("kind", "name", "cluster")


def same_names(df: DataFrame) -> DataFrame:
    """(kind, name_a, name_b): all pairs of different strings of one column of a
    transaction table that name the same, name_a < name_b in byte order."""
    found = resolved(df).select(F.struct("kind", "cluster").alias("c"), F.struct("kind", "name").alias("r"))
    pairs = row_pairs(found, "c", "r")
    return pairs.select("id_a.kind", F.col("id_a.name").alias("name_a"), F.col("id_b.name").alias("name_b"))


def name_classes(df: DataFrame) -> DataFrame:
    """(kind, name, class, spellings): every string that names someone with the first
    string in byte order of its class, and how many strings the class has."""
    found = resolved(df)
    classes = found.groupBy("kind", "cluster").agg(F.min("name").alias("class"), F.count(F.lit(1)).alias("spellings"))
    return found.join(classes, ["kind", "cluster"]).select("kind", "name", "class", "spellings")
