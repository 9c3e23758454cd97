"""The combined sets at size (F7, F8): rows stay rows, lists meet once, stages are read."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from membra.functions.semantics import replace_all, replace_first
from membra.functions.text import COLLAPSED_EDGE_NA, COLLAPSED_INNER_NA, strip_collapsed_na
from membra.operators import link as lk
from membra.operators import reconcile as rc
from membra.operators import sets as st
from membra.plans import driver_queries as dq

CW = [("A", "X2"), ("A", "X1"), ("A", None), ("C", "Y"), (None, "Z"), (None, "W")]


def _plan(df, which="optimizedPlan"):
    return getattr(df._jdf.queryExecution(), which)().toString()


@pytest.fixture(scope="module")
def raw(spark):
    """Values with NULL, NA, "" and blanks; NULL and equal orders; repeated rows."""
    def pick(seed, *vs):
        return F.array(*[F.lit(v).cast("string") for v in vs])[(F.abs(F.hash("id", F.lit(seed))) % len(vs))]

    df = spark.range(4000).select(
        pick(1, "a", "b", None).alias("k"), (F.abs(F.hash("id", F.lit(2))) % 90).alias("p"),
        pick(3, "X; Y", "Y|Z", " NA ", None, "", "W", "X").alias("g"), pick(4, "Chair", None, "NA", "Other", "").alias("r"),
        pick(5, "T1", "T2", None, "").alias("t"),
        F.when(F.abs(F.hash("id", F.lit(6))) % 3 > 0, F.abs(F.hash("id", F.lit(7))) % 12).alias("o"))
    return df.unionByName(df.filter("p < 9"))


def test_row_sets_equal_the_stacked_sets(raw):  # A5, A6, A7
    for specs in ({"gs": ("g", "sorted"), "rs": ("r", "unique_na"), "ts": ("t", "unique", "|")},
                  {"gs": ("g", "sorted"), "g2": ("r", "sorted", "+")}, {"rs": ("r", "unique")}):
        for keys in (["k", "p"], ["k"]):
            got, want = st.group_row_sets(raw, keys, specs, "o"), st.group_sets(raw, keys, specs, "o")
            assert got.columns == want.columns and got.dtypes == want.dtypes and rows(got) == rows(want)
    with pytest.raises(ValueError):
        st.group_row_sets(raw, ["k"], {"x": ("g", "other")}, "o")


def test_reconcile_keeps_a_row_one_row(raw):  # K5: before, a row was first made one per column
    src = raw.withColumn("s", F.when(F.col("o") % 2 == 0, "R").otherwise("A"))
    out = rc.reconcile_rows(src, "s", "R", "A", "k", "p", "t", "t", "g", "r", "t", "o")
    side = _plan(rc.legacy_side(src, "k", "p", "t", "g", "r", "o"))
    assert side.count("Generate") == 1 and out.columns == [
        "k", "p", "groups_a", "positions", "bioguide", "groups_b", "titles"]


def test_lists_meet_as_rows_before_they_become_terms(spark, tmp_path):  # K8
    data = [(1, 116, "b1", "A;B"), (1, 116, "b1", "A;C"), (1, 116, None, "C"), (1, 116, None, "C|A"), (2, 116, "b2", "C"),
            (2, 116, "b3", "C"), (3, 116, "b4", None), (3, 116, "b5", "A"), (None, 116, "b6", "A;NA"), (None, 116, None, "NA")]
    df = spark.createDataFrame(data, "icpsr int, congress int, bioguide string, member_groups string")
    spark.createDataFrame(CW, "t string, a string").write.parquet(str(tmp_path / "cw"))
    cw = spark.read.parquet(str(tmp_path / "cw"))
    args = (df, ["icpsr", "congress"], "member_groups", ["bioguide"], cw, "t", "a")
    out = lk.crosswalk_lists(*args, person="bioguide")
    # in order; attributes of rows tied in order, term and place go in order together
    want = [(None, "A", "X1;X2", "b6"), (None, "", "", None), (1, "C;A;B", "Y;Y;NA;X1;X2;NA;NA;X1;X1;X2;X2;NA;Y".replace(";NA;", ";", 1), None),
            (2, "C", "Y;Y", None), (3, None, "W;Z;X1;X2", None)]
    assert rows(out, "icpsr", "member_groups", "oversight", "__person") == sorted(want, key=repr)
    plan = _plan(out, "executedPlan")
    assert 0 <= plan.index("Generate") < plan.index("hashpartitioning(icpsr")  # before: above it


def test_group_terms_by_person_equals_the_reduced_terms(spark, raw):  # K8
    """Groups with tied and NULL orders and NULL sets; before, every term was a row twice sorted."""
    df = raw.select(F.abs(F.hash("p", "k") % 900).alias("id"), F.lit(1).alias("c"), F.col("o").alias("who"), F.expr(
        "case when p = 5 and r is null then null when g is null and p % 7 > 0 then 'NA' when p % 3 = 0 then concat_ws(';', r, g, t) else concat_ws('|', t, g) end").alias("s"))
    args = (["id", "c"], "s", ["who"])
    want = rows(lk.group_terms(df, *args))
    assert rows(lk.group_terms(df, *args, person="who")) == want and len({r[3] for r in want}) > 9 and None in {r[3] for r in want}
    with_no_id = df.withColumn("id", F.when(F.col("id") % 5 > 0, F.col("id")))
    got = lk.group_terms(with_no_id, *args, person="who")
    key = F.coalesce(F.col("id").cast("string"), F.concat(F.lit("w"), F.coalesce(F.col("who").cast("string"), F.lit("?"))))
    plain = lk.group_terms(with_no_id.withColumn("id0", F.col("id")).withColumn("id", key), *args)
    assert rows(got, "id", "who", "s") == rows(plain.select(F.col("id0").alias("id"), "who", "s"))
    assert "Generate" not in _plan(got)


def test_stripped_lists_equal_the_plain_patterns(spark):  # Q14
    parts = ["NA", "A", "NATION", "", "xNA", "NA\n"]
    texts = [(";".join(x),) for x in [()] + [(a,) for a in parts] + [(a, b) for a in parts for b in parts]
             + [(a, b, c) for a in parts for b in parts for c in parts]] + [(None,), ("NA;NA;NA;NA",)]
    df = spark.createDataFrame(texts, "x string").select(
        "x", strip_collapsed_na("x").alias("got"),
        replace_first(replace_all("x", COLLAPSED_EDGE_NA), COLLAPSED_INNER_NA, ";").alias("want"))
    assert df.filter(~F.col("got").eqNullSafe(F.col("want"))).collect() == []


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))

    def put(name, data, schema):
        spark.createDataFrame(data, schema).write.parquet(f"{d}/{name}.parquet")

    day = "1997-03-01 00:00:00"
    put("nation", [(1, "N1")], "n_nationkey int, n_name string")
    put("customer", [(1, "C1", 1, 1.0, "S"), (2, "C2", 1, -1.0, "S")],
        "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    put("part", [(7, "Small", 3), (8, "Big", 14), (9, "Big", 50)], "p_partkey long, p_type string, p_size int")
    spark.createDataFrame([(10, 1, "1-URGENT", day), (11, 2, "1-URGENT", day), (12, 2, "1-URGENT", "1999-03-01 00:00:00")],
                          "o_orderkey long, o_custkey long, o_orderpriority string, o_orderdate string").withColumn(
        "o_orderdate", F.to_timestamp("o_orderdate")).write.parquet(f"{d}/orders.parquet")
    put("lineitem", [(10, 7, 1, 12.0, "R", "O"), (10, 8, 2, 2.0, "A", "O"), (11, 9, 1, 1.0, "A", "F")],
        "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string")
    return d


def test_attach_by_crosswalk_of_small_tables(spark, sf):  # K8 (F7)
    out = dq.attach_by_crosswalk(spark, sf)
    assert rows(out, "icpsr", "bioguide", "member_groups", "oversight") == [
        (1, "O000001", "SMALL;BIG", "Sma-0;Big-1;Big-5"), (2, "F000002", "", "")]
    plan = _plan(out)
    assert "p_size" not in plan and "groups_a" in plan  # before: the crosswalk of the parts was made in the plan


def test_gap_history_reads_written_sets(spark, sf):  # K11 (F8)
    out = dq.gap_history(spark, sf)
    assert rows(out, "icpsr", "congress", "member_groups") == [(2, 105, ""), (2, 106, None)]
    assert "collect_list" not in _plan(out) and "Generate explode(split" not in _plan(out)  # before: listed once more
