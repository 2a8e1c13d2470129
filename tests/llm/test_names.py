import pytest

from tallyforge.llm import names as N

SCHEMA = "entity_name string, candidate_name string, committee_name string, committee_code string, entity_zip string, entity_employer string, entity_is_individual boolean, n string, key string, id string"


def table(spark, rows):
    base = dict(entity_name=None, candidate_name=None, committee_name=None, committee_code=None, entity_zip=None, entity_employer=None, entity_is_individual=None)
    return spark.createDataFrame([(*{**base, **r}.values(), "n", "k", "i") for r in rows], SCHEMA)


@pytest.mark.parametrize("a, b, want", [
    ("William", "Bill", 3), ("Edward", "Ted", 3), ("Patricia", "Patr", 2), ("Daniel", "Danielk", 2), ("E", "Elizabeth", 1), ("E", "Edward", 1), ("Bill", "W", 1), ("Frances", "Michael", 0), ("", "Ann", 0), ("Zechary", "Zachary", 2), ("Wililam", "Bill", 2),
])
def test_given_names(a, b, want):
    assert N.given_level(a.lower(), b.lower()) == want == N.given_level(b.lower(), a.lower())


def test_readings():
    assert N.person("Querquasstein, Jr, Edward J.") == ("jr", [("querquasstein", "edward", "j")])
    assert ("querquasstein", "ted", "") in N.person('Edward "Ted" Querquasstein Jr')[1]
    assert {("edward", "drarclonhart", ""), ("drarclonhart", "edward", "")} == set(N.person("Drarclonhart Edward")[1])
    assert N.person("Hon. Ann B. Lee")[1] == [("lee", "ann", "b")]
    assert N.organisation("Marine Hospital, Trencasacre") == [("trencasacre marine hospital", "", "")]
    assert N.organisation("ACME MARINE SERVICES, L.L.P.") == [("acme marine services", "", "llp")]
    assert N.committee("The Friends of Ann Lee")[0] == N.committee("Ann Lee, Friends of")[0] == N.committee("Freinds For Ann Lee")[0] == "friends"
    assert N.committee("Ann Lee 4 Mayor")[0] == N.committee("Committee for Mayor: Ann Lee")[0] == "for mayor"
    assert N.committee("PAC of Acme Builders")[2] == N.committee("Acme Builders Political Action Committee")[2] == N.committee("Acme Builders P.A.C.")[2]
    for x in ("-", "N/A", "not provided", "Anonymous", "", None, "123", "  "):
        assert N.is_placeholder(x)


def test_words_and_edits():
    assert N.words_level("acme tobacco manufacturing", "acme tobacco mfg") == 2
    assert N.words_level("acme tobacco services", "acme freight services") == 0
    assert N.words_level("gadshosythe marine", "gadshosyhe marine") == 1
    assert N.edits("abcd", "abdc", 2) == 1 and N.edits("kitten", "sitting", 2) == 3 and N.edits("", "abc", 2) == 3


GROUPS = {
    "entity": [
        [("Edward Querquasstein Jr", "22001"), ('Edward "Ted" Querquasstein Jr', "22001"), ("Querquasstein, Jr, Edward J.", "22001"), ("TED QUERQUASSTEIN JR", "22001"), ("E. Querquasstein Jr", "22001")],
        [("Edward Querquasstein Sr", "22002"), ("Querquasstein, Edward Sr", "22002")],
        [("Michael Querquasstein", "22001"), ("Michael Querquássteín", "22001")],
        [("Acme Freight Services LLC", "22003"), ("ACME FREIGHT SERVICES, L.L.C.", "22003"), ("Freight Services, Acme", "22003"), ("Acme's Freight Svcs", "22003")],
        [("Acme Tobacco Services LLC", "22003")],
        [("Acme Freight Services Inc", "22004")],
    ],
    "candidate": [[("Ann Castleford", "CC-1"), ("Castleford, Ann B.", "CC-2"), ("A B Castleford", "CC-1")], [("Anthony Castleford", "CC-3")]],
    "committee": [[("Friends of Ann Castleford", "CC-1"), ("Frnds of Ann Castleford", "CC-1"), ("Ann Castleford, Friends of", "CC-2")], [("Ann Castleford for Mayor", "CC-4"), ("Castleford, Ann for Mayor", "CC-4")], [("Acme Builders PAC", "P-1"), ("Acme Bldrs Polit Action Comm", "P-1")]],
}


def test_variants_link_and_others_do_not(spark):
    rows, want = [], set()
    for kind, groups in GROUPS.items():
        for g in groups:
            for name, where in g:
                key = {"entity_zip": where, "entity_is_individual": "Acme" not in name and "ACME" not in name} if kind == "entity" else {"committee_code": where}
                rows += [{f"{kind}_name": name, **key}] * 2
            labels = [n for n, _ in g]
            want |= {(kind, *sorted((a, b), key=str.encode)) for a in labels for b in labels if a != b}
    rows += [{"entity_name": x, "candidate_name": x, "committee_name": x, "entity_zip": "22001", "committee_code": "CC-1"} for x in ("N/A", "Unknown", "", None, "-", "  ")]
    rows.append({"entity_name": "x" * 5000, "entity_zip": "22001"})
    got = [tuple(r) for r in N.same_names(table(spark, rows)).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_middle_initials_keep_namesakes_apart(spark):
    rows = [{"candidate_name": "Ann Castleford", "committee_code": "CC-1"}] * 3 + [{"candidate_name": "Ann J Castleford", "committee_code": "CC-1"}] * 2 + [{"candidate_name": "Castleford, Ann K.", "committee_code": "CC-1"}]
    got = {(r.name_a, r.name_b) for r in N.same_names(table(spark, rows)).collect()}
    assert got == {("Ann Castleford", "Ann J Castleford")}


def test_names_set_back_by_the_vote_still_find_each_other(spark):
    rows = [{"candidate_name": n, "committee_code": "CC-1"} for n, k in (("Ann Castleford", 5), ("Ann J Castleford", 3), ("Castleford, Ann K.", 1), ("Ann K Castleford", 1)) for _ in range(k)]
    rows += [{"entity_name": n, "entity_zip": "22003", "entity_is_individual": False} for n, k in (("Acme Freight", 5), ("Acme Freight LLC", 3), ("Acme Freight Inc", 1), ("ACME FREIGHT, INCORPORATED", 1)) for _ in range(k)]
    got = {(r.name_a, r.name_b) for r in N.same_names(table(spark, rows)).collect()}
    assert got == {("Ann Castleford", "Ann J Castleford"), ("Ann K Castleford", "Castleford, Ann K."), ("Acme Freight", "Acme Freight LLC"), ("ACME FREIGHT, INCORPORATED", "Acme Freight Inc")}


def test_a_minority_with_most_rows_of_one_spelling_is_set_back_too(spark):
    names = [("Ann K Castleford", 4), ("Ann Castleford", 3), ("Ann J Castleford", 2), ("Castleford, Ann J.", 2), ("CASTLEFORD, ANN J", 1)]
    got = {(r.name_a, r.name_b) for r in N.same_names(table(spark, [{"candidate_name": n, "committee_code": "CC-1"} for n, k in names for _ in range(k)])).collect()}
    kept = sorted((n for n, _ in names[1:]), key=str.encode)
    assert got == {(a, b) for i, a in enumerate(kept) for b in kept[i + 1 :]}


def test_rounds_go_on_until_nothing_merges(spark, monkeypatch):
    # Each round only the two lowest are let match, so fourteen names need thirteen rounds.
    lowest = lambda now: (lambda x: now.sparkSession.createDataFrame([(x[0], x[1], 1, 1, 1)] if len(x) > 1 else [], "a bigint, b bigint, n_a bigint, n_b bigint, strength int"))(sorted(r.id for r in now.select("id").collect())[:2])
    monkeypatch.setattr(N, "matches", lowest)
    names = spark.createDataFrame([(i, "candidate", "Ann Castleford", True, [], False, 1) for i in range(14)], "id bigint, kind string, name string, is_person boolean, context array<string>, spread boolean, n bigint")
    assert N.resolve(names).select("cluster").distinct().count() == 1


def test_slips_in_short_surnames(spark):
    names = [("Ward, Ann", "22001"), ("Wrad, Ann", "22001"), ("Ann Wad", "22001"), ("Warb, Eve", "22001"), ("Lee, Edward", "22002"), ("Ted Lwe", "22002"), ("Ted Lwee", "22003"), ("Li, Ann", "22001"), ("Lo, Ann", "22001")]
    rows = [{"entity_name": n, "entity_zip": z, "entity_is_individual": True} for n, z in names]
    got = {(r.name_a, r.name_b) for r in N.same_names(table(spark, rows)).collect()}
    assert got == {("Ann Wad", "Ward, Ann"), ("Ann Wad", "Wrad, Ann"), ("Ward, Ann", "Wrad, Ann"), ("Lee, Edward", "Ted Lwe")}


def test_matching_names_share_a_block_key():
    given = ["Patricia", "Patr", "Patti", "Zechary", "Zachary", "Zach", "Wililam", "Bill", "Yolanda", "Yoli", "Landa", "E", "Edward", "Ed", "Ann", "Anna", "Ana", "Ophelia", "Ophie", "Phelia", "Theo", "Theodore", "Xandra"]
    surnames = ["castleford", "castelford", "astleford", "castlefort", "ward", "wrad"]
    people = [(s, g.lower(), "") for s in surnames for g in given]
    for x in people:
        for y in people:
            for context, shared in ((-1, ()), (0, ()), (1, ("zip:22001",))):
                a, b = ("|".join(x),), ("|".join(y),)
                if N.match("candidate", "person", a, b, context):
                    keys = [N.block_keys("candidate", "person", "", r, shared) for r in (a, b)]
                    assert keys[0] & keys[1], (x, y, context)


def test_short_forms():
    for short, long in (("yoli", "yolanda"), ("landa", "yolanda"), ("ophie", "ophelia"), ("phelia", "ophelia"), ("patr", "patricia")):
        assert N.given_level(short, long) == 2
    assert N.given_level("ian", "brian") == 0
    for word in ("friends", "freinds", "frnds", "firends", "friend", "friendss", "friands"):
        assert N.is_friends(word)
    assert not N.is_friends("fiends of") and not N.is_friends("people")


def test_a_name_of_many_places_keeps_its_context(spark):
    rows = [{"entity_name": "Ann Castleford", "entity_zip": f"{22000 + i}", "entity_is_individual": True} for i in range(40) for _ in range(1 + (i == 7))]
    rows += [{"entity_name": n, "entity_zip": z, "entity_is_individual": True} for n, z in (("A. Castleford", "22007"), ("Castleford, Anne", "29999"))]
    got = {(r.name_a, r.name_b) for r in N.same_names(table(spark, rows)).collect()}
    assert got == {("A. Castleford", "Ann Castleford"), ("Ann Castleford", "Castleford, Anne"), ("A. Castleford", "Castleford, Anne")}


def test_no_context_value_of_a_name_of_many_places_is_lost(spark):
    rows = [{"entity_name": n, "entity_zip": f"{22000 + i}", "entity_is_individual": True} for n in ("Ann Castleford", "Castleford, Ann") for i in range(150)]
    rows += [{"entity_name": n, "entity_zip": z, "entity_is_individual": True} for n, z in (("A. Castleford", "22149"), ("Ann Cazdleford", "22120"), ("A Castlefordd", "29999"))]
    got = {(r.name_a, r.name_b) for r in N.same_names(table(spark, rows)).collect()}
    one = sorted(("Ann Castleford", "Castleford, Ann", "A. Castleford", "Ann Cazdleford"), key=str.encode)
    assert got == {(a, b) for i, a in enumerate(one) for b in one[i + 1 :]}


def test_a_rare_context_value_counts(spark):
    rows = [{"candidate_name": n, "committee_code": c} for n, c, k in (("Ann Castleford", "CC-1", 9), ("Ann Castleford", "CC-2", 1), ("A. Castleford", "CC-2", 1), ("E. Castleford", "CC-3", 1)) for _ in range(k)]
    assert [(r.name_a, r.name_b) for r in N.same_names(table(spark, rows)).collect()] == [("A. Castleford", "Ann Castleford")]


def test_names_of_many_places_agree_in_any_of_them(spark):
    rows = [{"entity_name": n, "entity_zip": f"{i}", "entity_is_individual": True} for n, start in (("A. Castleford", 22000), ("Ann Castleford", 22199), ("E. Castleford", 23000), ("Eve Castleford", 23200)) for i in range(start, start + 200)]
    got = {(r.name_a, r.name_b) for r in N.same_names(table(spark, rows)).collect()}
    assert got == {("A. Castleford", "Ann Castleford")}


def test_no_context_value_of_a_merged_name_is_lost(spark):
    forms = ["Ann Castleford", "ANN CASTLEFORD", "ann castleford", "Castleford, Ann", "CASTLEFORD, ANN", "castleford, ann", "Ann  Castleford", "Castleford,Ann", "Ms Ann Castleford", "Dr Ann Castleford", "Hon. Ann Castleford", "Rev Ann Castleford", "Miss Ann Castleford", "Ann Castleford."]
    rows = [{"candidate_name": n, "committee_code": f"CC-{i:02}{j}"} for i, n in enumerate(forms) for j in range(5)]
    rows += [{"candidate_name": n, "committee_code": "ZZ"} for n in ("Ann Castlefrod", "Ann Cazdleford")]  # alike only by what the merged name has of both
    got = {(r.name_a, r.name_b) for r in N.same_names(table(spark, rows)).collect()}
    one = sorted([*forms, "Ann Castlefrod", "Ann Cazdleford"], key=str.encode)
    assert got == {(a, b) for i, a in enumerate(one) for b in one[i + 1 :]}


def test_classes(spark):
    rows = [{"candidate_name": n, "committee_code": "CC-1"} for n in ("Ann Castleford", "Castleford, Ann", "Bo Lee", "N/A", None)]
    got = {tuple(r) for r in N.name_classes(table(spark, rows)).collect()}
    assert got == {("candidate", "Ann Castleford", "Ann Castleford", 2), ("candidate", "Castleford, Ann", "Ann Castleford", 2), ("candidate", "Bo Lee", "Bo Lee", 1)}


def test_empty(spark):
    assert N.same_names(table(spark, [{"entity_name": "A"}]).limit(0)).count() == 0
