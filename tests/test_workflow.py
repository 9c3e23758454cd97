"""Split NULL keys, resumed stages, numbered rows, long crosswalk lists, CSV."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from membra.operators import link as lk
from membra.operators import reports as rp
from membra.operators.joins import join_on, join_split_nulls
from membra.session import shared_dir
from membra.sources import files as fl


@pytest.fixture(scope="module")
def sides(spark):
    """30 % of B without an id; NULL keys on both, one or the other side."""
    b = spark.range(3000).select(
        F.when(F.col("id") % 10 < 7, F.col("id") % 400).alias("k"), (F.col("id") % 3).cast("int").alias("p"), F.col("id").alias("b"))
    b = b.filter("not (k is null and p = 2)")
    a = spark.range(900).select(
        F.when(F.col("id") % 9 > 0, F.col("id") % 500).alias("k"), (F.col("id") % 4).cast("int").alias("p"),
        (F.col("id") % 50).alias("a"))
    return a.distinct(), b.unionByName(b.filter("b % 500 = 0"))


@pytest.mark.parametrize("how,spread", [("full", "right"), ("full", "left"), ("left", "left")])
@pytest.mark.parametrize("parts", [1, 7])
def test_split_nulls_equals_the_plain_join(sides, how, spread, parts):  # J5, J6, J11
    a, b = sides
    for x, y in ((a, b), (b, a), (a.limit(0), b), (a, b.limit(0)), (a.filter("k is not null"), b)):
        got = join_split_nulls(x, y, ["k", "p"], how, spread, parts)
        want = join_on(x, y, ["k", "p"], how)
        assert got.columns == want.columns
        assert rows(got) == rows(want)


def test_split_nulls_spreads_the_rows_without_an_id(spark, sides):
    """No partition of the join reads more than twice the median."""
    _, b = sides
    one = b.filter("k is null").select("k", "p").distinct().withColumn("a", F.lit(1))
    a = one.unionByName(spark.range(400).select(F.col("id").alias("k"), F.lit(0).alias("p"), F.lit(2).alias("a")))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = join_split_nulls(a, b.withColumn("pad", F.lit(0)), ["k", "p"], "full", "right", 64)
        sizes = sorted(r[0] for r in out.filter("b is not null").groupBy(F.spark_partition_id()).count().select("count").collect())
        plain = join_on(a, b, ["k", "p"], "full").filter("b is not null").groupBy(F.spark_partition_id()).count()
        hot = max(r[0] for r in plain.select("count").collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[len(sizes) // 2] and sizes[-1] < hot


def test_gap_history_keeps_all_rows_of_gap_members(spark):  # K11
    data = [(1, 1, True), (1, 2, False), (2, 1, False), (None, 1, False), (None, 2, True), (3, 1, None)]
    df = spark.createDataFrame(data, "id int, p int, gap boolean")
    got = rows(rp.gap_history(df, rp.gap_ids(df, F.col("gap"), "id"), "id"), "id", "p")
    assert got == sorted([(1, 1), (1, 2), (None, 1), (None, 2)], key=repr)
    some = df.filter("not (id is null and p = 2)")
    assert rows(rp.gap_history(some, rp.gap_ids(some, F.col("gap"), "id"), "id"), "id", "p") == [(1, 1), (1, 2)]
    plan = rp.gap_history(df, rp.gap_ids(df, F.col("gap"), "id"), "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan


def test_numbered_rows_follow_the_order(spark):  # O1, O2
    df = spark.range(5000).select(F.when(F.col("id") % 7 > 0, F.col("id") * 7919 % 613).alias("a"), "id").repartition(9)
    got = rp.numbered(df, [F.desc("a"), "id"], shared_dir(spark, "numbered")).orderBy("row").collect()
    want = sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert [(r["a"], r["id"]) for r in got] == want and [r["row"] for r in got] == list(range(1, 5001))
    assert rp.numbered(df.limit(0), ["id"], shared_dir(spark, "numbered")).count() == 0


def test_crosswalk_forms_agree(spark):  # K8, W4, Q5
    df = spark.createDataFrame([(1, 116, "b1", "A;B;A"), (1, 116, "b2", "C|A"), (None, 116, "b3", "A"), (None, 116, "b4", None)],
                               "icpsr int, congress int, bioguide string, member_groups string")
    cw = spark.createDataFrame([("A", "X1"), ("A", "X2"), ("A", "X2"), ("C", "Y")], "t string, a string")
    args = (["icpsr", "congress"], "member_groups", ["bioguide"])
    pairs = rows(lk.crosswalk_members(df, *args, cw, "t", "a"), "icpsr", "term", "attribute", "n")
    assert pairs == sorted([(1, "A", "X1", 2), (1, "A", "X2", 4), (1, "B", None, 1), (1, "C", "Y", 1),
                            (None, "A", "X1", 1), (None, "A", "X2", 2), (None, None, None, 1)], key=repr)
    lists = rows(lk.crosswalk_lists(df, *args, cw, "t", "a"), "icpsr", "member_groups", "oversight")
    assert lists == sorted([(1, "A;B;C", "X1;X2;X2;NA;Y;X1;X2;X2".replace(";NA;", ";")), (None, None, "X1;X2;X2")], key=repr)
    on_rows = rows(lk.attach_by_crosswalk(df, *args, cw, "t", "a"), "icpsr", "bioguide", "member_groups")
    assert on_rows == rows(lk.group_terms(df, *args), "icpsr", "bioguide", "member_groups")


def test_stages_resume_and_follow_their_inputs(spark, tmp_path):  # S8
    src = str(tmp_path / "in")
    spark.range(5).write.parquet(src)
    built = []

    def run(*more):
        st = fl.Stages(spark, str(tmp_path / "stages"), [src, *more])
        return st, st.stage("doubled", lambda: built.append(1) or spark.read.parquet(src).selectExpr("id * 2 as x"))

    st, first = run()
    assert rows(first) == [(0,), (2,), (4,), (6,), (8,)] and rows(run()[1]) == rows(first) and len(built) == 1
    run("other parameter")
    assert len(built) == 2
    spark.range(1).write.mode("append").parquet(src)  # changed input: a new state
    assert run()[1].count() == 6 and len(built) == 3
    st, _ = run()
    st.delete("doubled")
    assert not st.done("doubled") and run()[1].count() == 6 and len(built) == 4


def test_a_stage_that_failed_is_built_again(spark, tmp_path):
    st = fl.Stages(spark, str(tmp_path))
    with pytest.raises(Exception):
        st.stage("x", lambda: spark.range(3).select(F.raise_error(F.lit("no")).cast("int").alias("y")))
    assert not st.done("x") and st.stage("x", lambda: spark.range(3)).count() == 3


def test_csv_sets_malformed_lines_aside(spark, tmp_path):  # S5, S9
    path = tmp_path / "in.csv"
    path.write_text('id,name,\n1,"a, ""b""",2020-01-03\nx,c,NA\n3,NA,2020-02-30\n4,,\n5,e\n', encoding="utf-8")
    good, bad = fl.read_csv_checked(spark, str(path), "id int, name string, d date")
    assert [r["id"] for r in good.orderBy("id").collect()] == [1, 4]
    assert good.select("name").count() == 2  # whatever a query selects
    assert sorted(r["line"] for r in bad.select("line").collect()) == ["3,NA,2020-02-30", "5,e", "x,c,NA"]
    report = str(tmp_path / "out")
    fl.write_report(good, report)
    assert rows(fl.read_csv_typed(spark, report, "id int, name string, d date")) == rows(good)
    many = str(tmp_path / "many")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20000")
    try:
        fl.write_report(spark.range(50_000).repartition(8), many)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert spark.read.csv(many, header=True).count() == 50_000 and len(list((tmp_path / "many").glob("part-*"))) > 1
    assert len(list((tmp_path / "out").glob("part-*"))) == 1
