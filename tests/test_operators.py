
import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from membra.operators import link as lk
from membra.operators import reconcile as rc
from membra.operators import reports as rp
from membra.operators import rules as ru
from membra.operators import sets as st
from membra.operators.roles import classify_roles, leadership_of, position_of, spell_features


def test_kleene_exclusion_fixture(spark):  # K18, N2
    df = spark.createDataFrame(
        [(29373, None), (29373, "X"), (None, None), (None, "X"), (1, None), (29373, "M001226")],
        "icpsr int, bioguide string")
    pairs = [(29373, "M001226")]
    keep = rows(ru.exclude_pairs(df, pairs, "icpsr", "bioguide"))
    assert keep == sorted([(29373, "X"), (None, "X"), (1, None)], key=repr)
    loose = rows(ru.exclude_pairs(df, pairs, "icpsr", "bioguide", strict=False))
    assert len(loose) == 5


def test_kleene_exclusion_table_path_matches_expression(spark):
    data = [(a, b) for a in (None, 1, 2, 3) for b in (None, "x", "y", "z")]
    df = spark.createDataFrame(data, "a int, b string")
    pairs = [(1, "x"), (2, "y"), (1, "z")]
    pdf = spark.createDataFrame(pairs, "x int, y string")
    for strict in (True, False):
        e = rows(ru.exclude_pairs(df, pairs, "a", "b", strict))
        t = rows(ru.exclude_pairs(df, pdf, "a", "b", strict))
        assert e == t


def test_recode_simultaneous_last_wins(spark):  # K2
    df = spark.createDataFrame(
        [(1, "one", 105, 4), (2, "two", 105, 4), (3, "three", 111, 2), (3, "three", 111, 4),
         (None, "one", 105, 4)], "code bigint, name string, period int, status int")
    df = df.withColumn("icpsr", F.col("code")).withColumn("party", F.lit(100))
    rules = spark.createDataFrame([
        (1, 1, 1, "one", None, None, "icpsr", "2", True),
        (2, 2, 2, "two", None, None, "icpsr", "3", True),
        (3, 3, 1, "one", None, None, "icpsr", "7", True),       # later rule on same key wins
        (4, 4, 3, "three", 111, 4, "icpsr", "30", True),        # period + status scoped
        (5, 5, 3, "three", 111, 2, "party", "200", True),
        (6, 6, 2, "two", None, None, "icpsr", "99", False),     # inactive
    ], ru.RULE_SCHEMA)
    out = ru.recode(df, rules, {"src_code": "code", "name": "name"},
                    {"icpsr": "icpsr", "party": "party"},
                    {"period": "period", "status": "status"})
    got = rows(out, "code", "status", "icpsr", "party")
    assert got == sorted([(1, 4, 7, 100), (2, 4, 3, 100), (3, 2, 3, 200), (3, 4, 30, 100),
                          (None, 4, None, 100)], key=repr)


def test_patches_subset_vs_ifelse(spark):  # K3
    df = spark.createDataFrame([("a", 1), (None, 1), ("b", 1)], "name string, x int")
    out = ru.apply_patches(df, [ru.Patch("x", 5, {"name": "a"}, "subset")])
    assert rows(out) == sorted([("a", 5), (None, 1), ("b", 1)], key=repr)
    out = ru.apply_patches(df, [ru.Patch("x", 5, {"name": "a"}, "ifelse")])
    assert rows(out) == sorted([("a", 5), (None, None), ("b", 1)], key=repr)
    seq = ru.apply_patches(df, [ru.Patch("x", 2, {"name": "b"}), ru.Patch("x", 3, {"x": 2})])
    assert rows(seq) == sorted([("a", 1), (None, 1), ("b", 3)], key=repr)


def test_overlay_never_overwrites(spark):  # K6
    base = spark.createDataFrame([(1, 116, "A"), (2, 116, None)], "icpsr int, congress int, c string")
    corr = spark.createDataFrame([(1, 116, "Z"), (2, 116, "B"), (3, 116, "C")],
                                 "icpsr int, congress int, fix string")
    got = rows(ru.overlay(base, corr, ["icpsr", "congress"], "c", "fix"))
    assert got == [(1, 116, "A"), (2, 116, "B"), (3, 116, "C")]


def test_group_sets_modes(spark):
    df = spark.createDataFrame(
        [(1, 3, "b", "NA", "X|y"), (1, 1, "a", None, "y ; z"), (1, 2, "b", "r", None),
         (2, 1, None, None, None)], "k int, o int, v string, r string, s string")
    out = st.group_sets(df, ["k"], {"u": ("v", "unique"), "n": ("r", "unique_na"),
                                    "s": ("s", "sorted")}, "o")
    got = {r["k"]: (r["u"], r["n"], r["s"]) for r in out.collect()}
    assert got == {1: ("a;b", "NA;r", "X;y;z"), 2: ("", "NA", None)}


def test_collapse_all_keeps_duplicates(spark):
    df = spark.createDataFrame([(1, 2, "a"), (1, 1, "b"), (1, 3, "a"), (1, 4, None)],
                               "k int, o int, v string")
    assert st.collapse_all(df, ["k"], "v", "o", ";", "x").first()["x"] == "b;a;a;NA"


def test_wide_lists(spark):  # K14
    df = spark.createDataFrame([(1, 1, "A"), (1, 2, "B")], "k int, o int, v string")
    out = st.wide_lists(df, ["k"], "v", "o", out="member_groups", n_columns=3)
    r = out.orderBy("o").first()
    assert (r["member_groups"], r["member_group1"], r["member_group2"], r["member_group3"]) == \
        ("A|B", "A", "B", None)


def test_add_count_null_group(spark):  # W1, N5
    df = spark.createDataFrame([(None,), (None,), (1,)], "k int")
    assert sorted(r["n"] for r in st.add_count(df, ["k"]).collect()) == [1, 2, 2]


def test_ladders(spark):  # P19, P20
    df = spark.createDataFrame([(c,) for c in (0, 5, 10, 11, 17, 20, 21, 24, 25, 32, 62)]
                               + [(None,)], "s int")
    got = rows(df.select("s", position_of("s").alias("p"), leadership_of("s").alias("l")))
    expect = {0: ("Other", "All Others"), 5: (None, "All Others"), 10: (None, "Chair"),
              11: ("Chair", "Chair"), 17: (None, "Chair"), 20: (None, "Ranking Minority"),
              21: ("Ranking Minority", "Ranking Minority"), 24: (None, "Ranking Minority"),
              25: ("Other", "All Others"), 32: ("Other", "Speaker"),
              62: ("Other", "Minority Whip"), None: (None, None)}
    assert {r[0]: (r[1], r[2]) for r in got} == expect


def test_classify_roles_flags(spark):  # K15
    df = spark.createDataFrame([(12, "WAYS", 1), (62, "LIBRARY", 2), (None, "RULES", None)],
                               "seniorstatus int, committee string, partystatus int")
    out = {r["seniorstatus"]: r for r in classify_roles(df).collect()}
    assert (out[12]["chair"], out[12]["prestige_chair"], out[12]["chair_of"],
            out[12]["majority"]) == (1, 1, "WAYS", 1)
    assert (out[62]["minority_leader"], out[62]["minority_whip"], out[62]["party_whip"]) == (0, 1, 1)
    assert (out[None]["chair"], out[None]["party_leader"], out[None]["chair_of"]) == (None, 0, None)


def test_spell_features(spark):  # K13
    df = spark.createDataFrame(
        [(1, "A", dt.date(2001, 5, 1), "Chair"), (1, "A", dt.date(1999, 1, 1), "Other"),
         (2, "A", None, None)], "icpsr int, committee string, assigneddate date, position string")
    out = {(r["icpsr"], r["assigneddate"]): r for r in spell_features(df).collect()}
    r = out[(1, dt.date(2001, 5, 1))]
    assert (r["firstassigned"], r["assignedchairdate"], r["chair_since_2007"]) == \
        (1999, dt.date(2001, 5, 1), True)
    r = out[(2, None)]
    assert (r["firstassigneddate"], r["chair_since_2007"]) == (None, False)


def test_reconcile_paths_agree(spark):  # K5
    data = [("R", 1, 105, "H", "x", "ECON", "Chair", None, 1),
            ("R", 1, 105, "S", "x", "BUDGET", None, None, 2),
            ("A", 1, 105, "H", "B1", "ECON", None, "Chair", 3),
            ("A", None, 105, "H", "B2", "RULES", None, "Member", 4),
            ("R", None, 105, "H", "x", None, "Other", None, 5)]
    df = spark.createDataFrame(data, "src string, m int, p int, sub string, person string, "
                                     "g string, role string, title string, o int")
    one = rc.reconcile_rows(df, "src", "R", "A", "m", "p", "sub", "person", "g", "role",
                            "title", "o", person_out="person")
    a = rc.legacy_side(df.filter("src = 'R'"), "m", "p", "sub", "g", "role", "o")
    b = rc.roster_side(df.filter("src = 'A'"), "m", "p", "person", "g", "title", "o")
    two = rc.reconcile(a, b, ["m", "p"])
    assert rows(one) == rows(two.select(*one.columns))
    got = {r["m"]: r for r in one.collect()}
    assert got[1]["groups_a"] == "BUDGET;ECON" and got[1]["positions"] == "ChairNA"
    assert got[None]["groups_b"] == "RULES" and got[None]["positions"] == ""


def leftmost_longest(text, terms):
    """All matches by trying every length at every place."""
    if text is None:
        return None
    longest, out, i = max(map(len, terms), default=0), [], 0
    while i < len(text):
        hit = next((text[i:i + n] for n in range(longest, 0, -1) if text[i:i + n] in terms), None)
        if hit:
            out.append(hit)
        i += len(hit) if hit else 1
    return out


def test_extract_terms_takes_the_longest(spark):  # K7
    texts = spark.createDataFrame([(1, "THE REDWOOD RING IS RED"), (2, "NOTHING"),
                                   (3, "GEARBOX ON A RED GEAR")], "id int, t string")
    vocab = spark.createDataFrame([("RED",), ("REDWOOD",), ("GEAR",), ("RING",)], "term string")
    got = dict(rows(lk.extract_terms(texts, "t", vocab, "term", "m").select("id", "m")))
    assert got == {1: ["REDWOOD", "RING", "RED"], 2: [], 3: ["GEAR", "RED", "GEAR"]}


@pytest.mark.parametrize("size", [0, 10, 50_000])
def test_extract_terms_at_any_vocabulary_size(spark, monkeypatch, size):  # J15, X12, X20
    """The same arrays as brute force with 10 and with 50,000 terms, over
    texts of many windows, with quotes, astral letters and shared prefixes."""
    import random
    rnd = random.Random(3)
    monkeypatch.setattr(lk, "WINDOW_CHARS", 40)
    letters = "ABCD .|\\E\n😀"
    terms = {"".join(rnd.choice(letters) for _ in range(rnd.randint(1, 4))) for _ in range(size // 2)}
    k = 0
    while len(terms) < size:
        terms.add(f"COMMITTEE ON {k}")
        k += 1
    texts = [(i, "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 200)))) for i in range(60)]
    texts += [(100, None), (101, ""), (102, texts[3][1]), (103, " ".join(f"COMMITTEE ON {i}" for i in range(0, 30_000, 999)) * 3)]
    df = spark.createDataFrame(texts, "id int, t string")
    vocab = spark.createDataFrame([(w,) for w in terms] + [(None,), ("",)], "term string")
    got = dict(rows(lk.extract_terms(df, "t", vocab, "term", "m").select("id", "m")))
    assert got == {i: leftmost_longest(t, terms) for i, t in texts}
    cov = dict(rows(lk.vocabulary_coverage(df, "t", vocab).select("id", "matched")))
    assert cov == {i: None if t is None else bool(leftmost_longest(t, terms)) for i, t in texts}


def test_anchor_is_the_rarest_part_of_a_term(spark):
    vocab = spark.createDataFrame([("COMMITTEE ON A",), ("COMMITTEE ON B",), ("AB",)], "term string")
    got = dict(rows(lk.term_anchors(vocab)))
    assert got["AB"] == "AB" and got["COMMITTEE ON A"] == "TEE ON A" and got["COMMITTEE ON B"] == "TEE ON B"


def test_attach_by_crosswalk_na_path(spark):  # K8
    df = spark.createDataFrame([(1, 116, "b1", "A;B;A"), (1, 116, "b2", "C|A")],
                               "icpsr int, congress int, bioguide string, member_groups string")
    cw = spark.createDataFrame([("A", "X1"), ("A", "X2"), ("C", "Y")], "t string, a string")
    out = lk.attach_by_crosswalk(df, ["icpsr", "congress"], "member_groups", ["bioguide"], cw,
                                 "t", "a")
    got = {r["bioguide"]: (r["member_groups"], r["oversight"]) for r in out.collect()}
    assert got["b1"] == ("A;B;C", "X1;X2;Y;X1;X2")


def test_attach_by_crosswalk_texts_and_persons(spark):  # K8: Q13, Q5
    schema = "icpsr int, congress int, bioguide string, member_groups string"
    df = spark.createDataFrame([(1, 116, "b1", "A"), (None, 116, "b2", "A"),
                                (None, 116, "b3", "C")], schema)
    cw = spark.createDataFrame([("A", "X", "text 1"), ("A", "X", "text 2"), ("C", "Y", "text 1")],
                               "t string, a string, text string")
    args = (["icpsr", "congress"], "member_groups", ["bioguide"], cw, "t", "a")
    pooled = {r["bioguide"]: r["oversight"] for r in lk.attach_by_crosswalk(df, *args).collect()}
    assert pooled == {"b1": "X;X", "b2": "X;X;Y", "b3": "X;X;Y"}
    out = lk.attach_by_crosswalk(df, *args, person="bioguide")
    assert out.columns == ["icpsr", "congress", "bioguide", "member_groups", "oversight"]
    assert {r["bioguide"]: r["oversight"] for r in out.collect()} == {
        "b1": "X;X", "b2": "X;X", "b3": "Y"}


def test_resolve_names_left_semantics(spark):  # J16
    people = spark.createDataFrame([(1, 110, "Sen. John  SMITH (politician)"),
                                    (2, 110, "Nobody Here"), (3, 111, "jane doe")],
                                   "k int, p int, txt string")
    d = spark.createDataFrame([("John Smith", None, 10), ("John Smith", None, 11),
                               ("Jane Doe", 110, 20)], "alias string, period int, id int")
    got = rows(lk.resolve_names(people, "txt", "p", d), "k", "id")
    assert got == sorted([(1, 10), (1, 11), (2, None), (3, None)], key=repr)


def test_resolve_names_against_brute_force(spark):  # J16: long aliases, repeats, odd rows
    import random
    rnd = random.Random(5)
    word = lambda: rnd.choice("ann bob cid dee eve fay".split())
    aliases = [(" ".join(word() for _ in range(rnd.randint(1, 6))), rnd.choice([None, 1, 2]), i) for i in range(60)]
    aliases += [("", None, 900), (None, None, 901), ("...", None, 902)]
    texts = [(i, rnd.choice([1, 2, 3, None]), ", ".join(word() for _ in range(rnd.randint(0, 30)))) for i in range(120)]
    texts += [(500, 1, None), (501, 1, ""), (502, None, "ANN bob")]
    d = spark.createDataFrame(aliases, "alias string, period int, id int")
    got = rows(lk.resolve_names(spark.createDataFrame(texts, "k int, p int, txt string"), "txt", "p", d), "k", "id")
    want = []
    for k, p, t in texts:
        w = (t or "").lower().replace(",", "").split()
        ids = {i for a, q, i in aliases if a and a != "..." and (q is None or q == p)
               and any(w[j:j + len(a.split())] == a.split() for j in range(len(w)))}
        want += [(k, i) for i in ids] or [(k, None)]
    assert got == sorted(want, key=repr)


def test_agency_crosswalk(spark):  # K16
    agencies = spark.createDataFrame([("EPA",), ("DOE",), ("NASA",)], "Agency string")
    cw = spark.createDataFrame([(None, "EPA", "E1"), ("DOE", "X", "D1"), ("ZZZ", None, "Z1"),
                                ("DOE", None, None)], "ACUS_agency string, agency string, ac string")
    got = rows(lk.agency_crosswalk(agencies, "Agency", cw, "ACUS_agency", "agency", "ac"))
    assert got == sorted([("EPA", "E1"), ("DOE", "D1"), ("NASA", None)], key=repr)


def test_gap_report_and_history(spark):  # K11
    roster = spark.createDataFrame(
        [(1, 110, "N1", "b1"), (1, 111, "N1", "b1"), (2, 110, "USA", "b2"), (3, 110, None, "b3")],
        "icpsr int, congress int, state_abbrev string, bioguide_id string")
    sets = spark.createDataFrame([(1, 111, "A")], "icpsr int, congress int, member_groups string")
    joined = rp.roster_with_sets(roster, sets, ["icpsr", "congress"], "congress", 102)
    cond = rp.gap_condition("member_groups", "state_abbrev", "USA")
    missing = spark.createDataFrame([(110, "b1")], "congress int, bioguide_id string")
    gaps = rp.gap_report(joined, cond, missing, ["congress", "bioguide_id"])
    assert rows(gaps, "icpsr", "congress", "icpsr_missing") == [(1, 110, True)]
    hist = rp.gap_history(joined, rp.gap_ids(joined, cond, "icpsr"), "icpsr")
    assert rows(hist, "icpsr", "congress") == [(1, 110), (1, 111)]
