"""
FIXTURES.md section 3."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from membra.functions import semantics as S
from membra.functions import text as X
from membra.functions.periods import election_year_of, period_of, snapshot_date_of
from membra.operators.joins import join_on
from membra.operators.reconcile import CHAIR_TITLE_PATTERN
from membra.operators.sets import normalize_set, normalize_set_string


def one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr).collect()]


def test_period_boundaries(spark):
    dates = ["2019-01-02", "2019-01-03", "2020-12-07", "2021-01-02", "2026-06-19", "1789-03-04"]
    got = one(spark, period_of(F.col("d").cast("date")), [(d,) for d in dates] + [(None,)],
              "d string")
    assert got == [115, 116, 116, 116, 119, 1, None]


def test_election_year(spark):
    got = one(spark, election_year_of("p"), [(96,), (115,), (116,), (None,)], "p int")
    assert got == [1978, 2016, None, None]


def test_snapshot_date_from_name(spark):
    got = one(spark, snapshot_date_of("f"),
              [("committee-membership-2020-12-07-abcdef1.yaml",), ("no-date.yaml",)], "f string")
    assert got == [dt.date(2020, 12, 7), None]


def test_if_else3_null_test_gives_null(spark):  # N1, N8
    got = one(spark, S.if_else3(F.col("x") > 1, 1, 0), [(2,), (0,), (None,)], "x int")
    assert got == [1, 0, None]


def test_assign_where_null_test_keeps_value(spark):  # N7
    got = one(spark, S.assign_where("x", F.col("x") > 1, 9), [(2,), (0,), (None,)], "x int")
    assert got == [9, 0, None]


def test_in_set_never_null(spark):  # N6
    got = one(spark, S.in_set("x", ["a"]), [("a",), ("b",), (None,)], "x string")
    assert got == [True, False, False]


def test_paste_and_str_c(spark):  # N3
    df = spark.createDataFrame([("a", None), ("a", "b")], "x string, y string")
    assert [r[0] for r in df.select(S.paste("x", "y")).collect()] == ["a NA", "a b"]
    assert [r[0] for r in df.select(S.str_c("x", "y", sep=";")).collect()] == [None, "a;b"]


def test_first_vs_all_replace(spark):  # N11
    df = spark.createDataFrame([(";A;",)], "x string")
    r = df.select(S.replace_first("x", "^;|;$"), S.replace_all("x", "^;|;$")).first()
    assert tuple(r) == ("A;", "A")


def test_replace_first_with_special_replacement(spark):
    got = one(spark, S.replace_first("x", "b", "$1\\"), [("abcb",)], "x string")
    assert got == ["a$1\\cb"]


def test_squish(spark):
    assert one(spark, S.squish("x"), [("  a \t b\n",)], "x string") == ["a b"]


def test_normalise_fixture(spark):  # A7
    df = spark.createDataFrame([(1, "B ; A|NA;;A  C;B"), (2, "NA;"), (2, None)],
                               "k int, x string")
    got = dict(rows(normalize_set(df, ["k"], "x", "n")))
    assert got == {1: "A;A C;B", 2: None}
    assert one(spark, normalize_set_string("x"), [("B ; A|NA;;A  C;B",), ("NA;",)],
               "x string") == ["A;A C;B", None]


def test_role_flag_patterns(spark):  # P23
    data = [("Chairman",), ("Vice Chair",), ("Ranking Member;Chair",), ("Cochairman",)]
    got = one(spark, F.col("t").rlike(CHAIR_TITLE_PATTERN), data, "t string")
    assert got == [True, False, True, False]


def test_extract_all_leftmost(spark):  # X12
    df = spark.createDataFrame([("HOUSE ENERGY AND COMMERCE",), ("NOTHING",)], "t string")
    got = [r[0] for r in df.select(F.regexp_extract_all("t", F.lit("ENERGY|COMMERCE"), 0))
           .collect()]
    assert got == [["ENERGY", "COMMERCE"], []]
    df2 = spark.createDataFrame([("A B",)], "t string")
    assert df2.select(F.regexp_extract_all("t", F.lit("A|A B"), 0)).first()[0] == ["A"]
    assert df2.select(F.regexp_extract_all(
        "t", F.lit(X.vocabulary_pattern(["A", "A B"])), 0)).first()[0] == ["A B"]


def test_null_safe_full_join(spark):  # N4
    a = spark.createDataFrame([(1, "a1"), (None, "an")], "k int, a string")
    b = spark.createDataFrame([(None, "bn"), (2, "b2")], "k int, b string")
    got = rows(join_on(a, b, ["k"], "full"))
    assert got == sorted([(1, "a1", None), (None, "an", "bn"), (2, None, "b2")], key=repr)


def test_role_cleanup_fuses(spark):  # X18
    got = one(spark, X.clean_roles("x"), [("Chair;Ranking Minority",), ("Other;Chair",)],
              "x string")
    assert got == ["ChairRanking Minority", "Chair"]


def test_set_repair(spark):  # X19
    got = one(spark, X.repair_set_string("x"),
              [("AGRICULTURETURAL RESOURCES;EDUCATION",), ("NATURAL RESOURCES",), (None,),
               ("A|B;NA;C",)], "x string")
    assert got == ["AGRICULTURE;NATURAL RESOURCES;EDUCATION", "NATURAL RESOURCES", "NA",
                   "A;B;C"]


def test_canonicalisers(spark):  # X3, X4
    a = one(spark, X.canonical_name_a("x"),
            [("House Committee on Veterans' Affairs",), ("Joint Economic Committee",),
             ("House Committee on Ways and Means",)], "x string")
    assert a == ["VETERANS", "ECONOMIC", "WAYS"]
    b = one(spark, X.canonical_name_b("x"),
            [("Indian Affairs (Select Committee)",), ("Economic (Joint Committee)",),
             ("Agriculture, Nutrition, and Forestry",), ("Veterans' Affairs",)], "x string")
    assert b == ["INDIAN", "ECONOMIC", "AGRICULTURE", "VETERANS"]


def test_strip_collapsed_na(spark):  # K8 cleanup
    got = one(spark, X.strip_collapsed_na("x"), [("NA;A;NA;B;NA;C;NA",), ("NA",)], "x string")
    assert got == ["A;B;NA;C", ""]


def test_pattern_of_a_rows_terms(spark):  # X20
    terms = ["A|B", "x\\Ey", "(A"]
    df = spark.createDataFrame([(terms,), (None,)], "t array<string>")
    got = [r[0] for r in df.select(X.pattern_of_terms("t")).collect()]
    assert got == [X.vocabulary_pattern(terms, longest_first=False), None]


def test_non_strict_variants(spark):  # Q4, Q14
    got = one(spark, X.clean_roles("x", strict=False),
              [("Chair;Ranking Minority",), ("Other;Chair;;Other",)], "x string")
    assert got == ["Chair;Ranking Minority", "Chair"]
    got = one(spark, X.strip_collapsed_na("x", strict=False), [("NA;A;NA;B;NA;C;NA",)],
              "x string")
    assert got == ["A;B;C"]
