from pyspark.sql import functions as F

from tallyforge.llm import addresses as A
from tallyforge.llm import linkage

COLUMNS = "id long, entity_address string, entity_city string, entity_zip string, s string, c string, form string"


def table(spark, rows):
    return spark.createDataFrame([(i, *r, "x", "y", "z") for i, r in enumerate(rows)], COLUMNS)


def test_parse(spark):
    rows = {
        ("12 N. Oak Street, Apt. 4B", "Ft. Ellery", "22074-1234"): ("street", "12", "n", "oak", "st", "fortellery", "22074"),
        ("No. 012, West Oak Ave N", "Fort Ellery, VA", None): ("street", "12", "w", "oak", "ave", "fortellery", ""),
        ("c/o Law Dept, Unit 4, 12 Granite Spur Tpk", "", ""): ("street", "12", "", "granitespur", "tpke", "", ""),
        ("Oak Dr 99, #3", "test", None): ("street", "99", "", "oak", "dr", "", ""),
        ("SUITE 2, OAK LN 15361", "X", "1"): ("street", "15361", "", "oak", "ln", "x", ""),
        ("5 Oak Rd, Widow Creek, VA 22297.", None, None): ("street", "5", "", "oak", "rd", "widowcreek", "22297"),
        ("P.O. Box # 7", "Larkmoor", None): ("box", "7", "", "", "", "larkmoor", ""),
        ("Post Office Box 7", "Larkmoor", None): ("box", "7", "", "", "", "larkmoor", ""),
    }
    got = A.parsed(table(spark, list(rows)), "entity_address", "entity_city", "entity_zip", "id").collect()
    want = list(rows.values())
    for r in got:
        assert (r.kind, r.number, r.dir, r.street, r.type, r.city, r.zip) == want[r.id]
    none = [("on file", "Larkmoor", None), ("", "", ""), (None, None, None), ("N/A", None, None), ("PO Box 7", None, None), ("77", "Larkmoor", "22222"), ("x" * 50_000, "L", "2"), ("1 " + "a, " * 20_000, "L", "22222")]
    kinds = {r.id: r.kind for r in A.parsed(table(spark, none), "entity_address", "entity_city", "entity_zip", "id").collect()}
    assert [kinds[i] for i in range(7)] == [None] * 7


GROUPS = [
    ["12 N Oakfield Street|Larkmoor|22001", "12 north oakfield st., Suite 5|LARKMOOR|22001-0001", "12 N Oakfeild St|Larkmoor|", "C/O TREASURER, 12 N OAKFIELD ST|Larkmor|22001", "No. 12, N Oakfield St, Larkmoor, VA 22001||"],
    ["12 S Oakfield Street|Larkmoor|22001", "12 South Oakfield Str|Larkmoor|22001"],
    ["12 N Oakfield Lane|Larkmoor|22001", "12 N Oakfield Ln|Larkmoor|"],
    ["112 N Oakfield Street|Larkmoor|22001"],
    ["12 N Oakfield Street|Duskfield|22900", "12 N Oakfield St|Duskfield|22900"],
    ["PO Box 12|Larkmoor|22009", "POB 12|Larkmoor|", "box 12|Larkmoor|22009"],
    ["PO Box 12|Duskfield|22909", "P O BOX 12|Duskfield|22909"],
]


def truth(groups):
    ids, at = [], 0
    for g in groups:
        ids.append(range(at, at + len(g)))
        at += len(g)
    return {(a, b) for r in ids for a in r for b in r if a < b}


def test_look_alikes_stay_apart(spark):
    filler = [f"{n} {name} {t}|{c}|{z}" for n in range(30, 90) for name, t, c, z in (("Maplebrook", "Road", "Ambermouth", "22262"), ("Quillhaven", "Dr", "Vantry", "23297"))]
    rows = [tuple(x.split("|")) for g in GROUPS for x in g] + [tuple(x.split("|")) for x in filler] * 2
    want = truth(GROUPS)
    first = sum(map(len, GROUPS))
    want |= {(first + i, first + len(filler) + i) for i in range(len(filler))}
    got = {(r.id_a, r.id_b) for r in A.same_location(table(spark, rows)).collect()}
    assert got == want


def test_empty_and_one_place_with_a_third_of_all_rows(spark, monkeypatch):
    df = table(spark, [("on file", "Larkmoor", None)])
    assert A.same_location(df.limit(0)).count() == 0 and A.same_location(df).count() == 0
    hot = spark.range(900).select("id", F.when(F.col("id") % 3 == 0, "12 Oakfield St").otherwise(F.concat((F.col("id") + 20).cast("string"), F.lit(" Maplebrook Rd"))).alias("entity_address"), F.lit("Larkmoor").alias("entity_city"), F.lit("22001").alias("entity_zip"))
    assert A.same_location(hot).count() == 300 * 299 // 2


def test_row_pairs_in_blocks_equal_all_pairs(spark):
    df = spark.createDataFrame([(i % 3 if i < 90 else 99, i) for i in range(120)] + [(None, 500), (None, 501)], "c int, r int")
    members = {}
    for i in range(120):
        members.setdefault(i % 3 if i < 90 else 99, []).append(i)
    want = {(a, b) for m in members.values() for a in m for b in m if a < b}
    for chunk in (7, 1000):
        got = [tuple(r) for r in linkage.row_pairs(df, "c", "r", chunk).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_roots(spark):
    chain = [(i, i + 1) for i in range(20)] + [(100, 101)]
    got = {r.node: r.root for r in linkage.roots(spark.createDataFrame(chain, "node long, parent long")).collect()}
    assert got == {**{i: 20 for i in range(20)}, 100: 101}


def test_em_without_pairs():
    weights, share = linkage.em_weights({}, [{1: 0.01, 0: 0.99}])
    assert share == 0.8 and weights[0][1] > 0 > weights[0][0]


def test_em_sets_look_alikes_apart():
    # Look-alikes agree in all but one field, far more than records drawn at random.
    patterns = {(3, 1, 1): 9000, (3, 0, 1): 700, (3, 1, 0): 600, (2, 1, 1): 500, (3, 1, linkage.MISSING): 900}
    random = [{3: 0.01, 2: 0.01, 0: 0.98}, {1: 0.1, 0: 0.9}, {1: 0.1, linkage.MISSING: 0.1, 0: 0.8}]
    weights, _ = linkage.em_weights(patterns, random)
    for g in patterns:
        assert (sum(w[x] for w, x in zip(weights, g)) >= 0) == (0 not in g), g


def test_classes(spark):
    rows = [("12 Oakfield St", "Larkmoor", "22001"), ("12 OAKFIELD STREET", "Larkmoor", ""), ("9 Oakfield St", "Larkmoor", "22001"), ("on file", "", ""), ("12 Oakfield", "", "22001")]
    got = {tuple(r) for r in A.location_classes(table(spark, rows)).collect()}
    assert got == {(0, 0, 3), (1, 0, 3), (2, 2, 1), (4, 0, 3)}


def test_contradicting_pairs_count_in_the_estimate_but_never_link(spark, monkeypatch):
    from tallyforge.llm import addresses

    seen = []

    def learn(pairs, random):
        seen.extend(r.asDict() for r in pairs.collect())
        assert all(0 in levels for levels in random.values())
        return learnt(pairs, random)

    learnt = addresses.learn
    monkeypatch.setattr(addresses, "learn", learn)
    rows = [(1, "12 Quillrun St", "Eddering", "22001"), (2, "12 Quillrun Rd", "Eddering", "22001"), (3, "12 Quillrun Street", "Eddering", "22001"), (4, "12 Quillrun St", "Zephyr Mills", "23443"), (5, "12 Quillrun St", "Zephyr Mills", "22001")]
    df = spark.createDataFrame(rows, "id long, entity_address string, entity_city string, entity_zip string")
    assert [tuple(r) for r in addresses.same_location(df).collect()] == [(1, 3)]
    assert any(r["type_l"] == 0 for r in seen) and any(r["city_l"] == 0 for r in seen) and any(r["zip_l"] == 0 for r in seen)
