"""Queries of the workflow's remaining operators on the driver's tables:
checked order, delimited files, resumed stages, long crosswalk lists, the real
rule table, whole role classification, person metadata and schema verbs.

Same analogy as ``driver_queries``; each query's DuckDB statement stands below
it.
"""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.periods import period_of
from ..functions.semantics import paste
from ..operators import link as lk
from ..operators import reports as rp
from ..operators import rules as ru
from ..operators.joins import join_on
from ..operators.roles import classify_roles
from ..rules import legacy as lg
from ..session import shared_dir
from ..sources import files as fl
from ..streaming.snapshot_stream import facts_stream
from . import driver_queries as dq
from . import oracle_sql as sql
from .tables import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _query(f):
    QUERIES[f.__name__] = f
    return f


# ---------------------------------------------------------------------------
# Checked order (O1, O2, A2)
# ---------------------------------------------------------------------------
@_query
def ordered_counts(spark: SparkSession, sf: str) -> DataFrame:
    """O1/A2: groups by falling size with their place in that order."""
    n = rp.value_counts(table(spark, sf, "lineitem"), ["l_suppkey", "l_returnflag"], sort=False)
    return rp.numbered(n, [F.desc("n"), "l_suppkey", "l_returnflag"], shared_dir(spark, "ordered"))


SQL["ordered_counts"] = """
SELECT l_suppkey, l_returnflag, n, row_number() OVER (ORDER BY n DESC, l_suppkey, l_returnflag) AS row
FROM (SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL)"""


@_query
def ordered_discrepancies(spark: SparkSession, sf: str) -> DataFrame:
    """O2: discrepancies by member, latest period first, NULL ids at the front."""
    rows = dq.discrepancy_report(spark, sf).select("icpsr", "congress", "bioguide", "groups_a", "groups_b")
    return rp.numbered(rows, [F.col("icpsr"), F.desc("congress"), F.col("bioguide")], shared_dir(spark, "ordered"))


SQL["ordered_discrepancies"] = f"""
WITH d AS ({sql.SQL["discrepancy_report"]})
SELECT icpsr, congress, bioguide, groups_a, groups_b,
       row_number() OVER (ORDER BY icpsr NULLS FIRST, congress DESC, bioguide NULLS FIRST) AS row
FROM d"""


# ---------------------------------------------------------------------------
# Delimited files
# ---------------------------------------------------------------------------
CUSTOMER_FIELDS = "a bigint, b string, c string, d double, e int, f date"


def _customer_report(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    return c.select(
        "c_custkey", F.concat(F.col("c_name"), F.lit(', the "first"é')).alias("quoted"),
        F.when(F.col("c_nationkey") < 3, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("segment"),
        "c_acctbal", F.when(F.col("c_nationkey") == 7, F.lit(None)).otherwise(F.col("c_nationkey")).alias("nation"),
        F.date_add(F.lit("2019-01-03").cast("date"), F.col("c_nationkey").cast("int")).alias("since"))


@_query
def csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """A report written as CSV (NULL as NA, quotes, commas, UTF-8),
    read back with declared types and renamed by position."""
    path = shared_dir(spark, "report")
    fl.write_report(_customer_report(spark, sf), path)
    got = fl.read_csv_typed(spark, path, CUSTOMER_FIELDS)
    return fl.rename_positional(got, ["id", "label", "segment", "balance", "nation", "since"])


SQL["csv_round_trip"] = """
SELECT c_custkey AS id, c_name || ', the "first"é' AS label,
       CASE WHEN c_nationkey >= 3 THEN c_mktsegment END AS segment, CAST(c_acctbal AS DOUBLE) AS balance,
       CASE WHEN c_nationkey <> 7 THEN CAST(c_nationkey AS INTEGER) END AS nation,
       CAST(DATE '2019-01-03' + CAST(c_nationkey AS INTEGER) AS DATE) AS since
FROM customer"""


@_query
def csv_malformed_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of a delimited file that don't fit the declared types are set
    aside whole; the others are typed rows."""
    path = shared_dir(spark, "lines")
    o = table(spark, sf, "orders")
    key = F.col("o_orderkey").cast("string")
    price = F.when(F.col("o_orderkey") % 97 == 0, F.lit("12,5 EUR")).when(
        F.col("o_orderkey") % 101 == 0, F.lit("n/a")).otherwise(F.col("o_custkey").cast("string"))
    o.select(F.concat_ws(",", key, F.concat(F.lit('"'), "o_orderpriority", F.lit('"')), price)).write.text(path)
    good, bad = fl.read_csv_checked(spark, path, "o_orderkey bigint, priority string, custkey bigint", header=False)
    return good.unionByName(bad.select("o_orderkey", "line"), allowMissingColumns=True)


SQL["csv_malformed_lines"] = """
WITH t AS (SELECT o_orderkey, o_orderpriority, o_custkey,
                  CASE WHEN o_orderkey % 97 = 0 THEN '12,5 EUR' WHEN o_orderkey % 101 = 0 THEN 'n/a' END AS bad
           FROM orders)
SELECT o_orderkey, CASE WHEN bad IS NULL THEN o_orderpriority END AS priority,
       CASE WHEN bad IS NULL THEN o_custkey END AS custkey,
       CASE WHEN bad IS NOT NULL THEN o_orderkey || ',"' || o_orderpriority || '",' || bad END AS line
FROM t"""


# ---------------------------------------------------------------------------
# Resumed stages
# ---------------------------------------------------------------------------
@_query
def resumed_discrepancies(spark: SparkSession, sf: str) -> DataFrame:
    """The reconciled table is a stage; a second run over the same
    inputs reads it and builds nothing, and reports the discrepancies."""
    folder = shared_dir(spark, "stages")
    inputs = [f"{sf.rstrip('/')}/{t}.parquet" for t in ("lineitem", "orders", "part")]
    fl.Stages(spark, folder, inputs).stage("reconciled", lambda: dq.two_source_reconcile(spark, sf))

    def again() -> DataFrame:
        raise AssertionError("the stage is there already")

    rows = fl.Stages(spark, folder, inputs).stage("reconciled", again)
    return dq.rc.discrepancies(rows, "groups_a", "groups_b")


SQL["resumed_discrepancies"] = sql.SQL["discrepancy_report"]


# ---------------------------------------------------------------------------
# Crosswalk pairs, rows without an id pooled
# ---------------------------------------------------------------------------
@_query
def crosswalk_members(spark: SparkSession, sf: str) -> DataFrame:
    """K8 in the reference's strict form: all rows without an id are one group
    a period, in rows that grow with its distinct pairs."""
    p = table(spark, sf, "part")
    cw = p.select(F.upper("p_type").alias("member_groups"), (F.col("p_size") % 2).alias("text"), F.concat(
        F.substring("p_type", 1, 3), F.lit("-"), (F.col("p_size") / 10).cast("int").cast("string")).alias("acronym")).distinct()
    out = lk.crosswalk_members(dq._combined(spark, sf), ["icpsr", "congress"], "member_groups", ["bioguide"],
                               cw, "member_groups", "acronym", attr="acronym")
    return out.select("icpsr", "congress", "term", "acronym", "n", F.col("first.bioguide").alias("bioguide"),
                      F.col("first.position").alias("position"))


SQL["crosswalk_members"] = f"""
WITH {sql.COMBINED},
cw AS (SELECT cw_term, acronym, count(*) AS k
       FROM (SELECT DISTINCT upper(p_type) AS cw_term, p_size % 2 AS cw_text,
                    substr(p_type, 1, 3) || '-' || CAST(CAST(trunc(p_size / 10) AS INTEGER) AS VARCHAR) AS acronym
             FROM part) GROUP BY ALL),
parts0 AS (
  SELECT icpsr, congress, bioguide, unnest(string_split_regex(member_groups, ';|\\|')) AS term,
         unnest(generate_series(1, len(string_split_regex(member_groups, ';|\\|')))) AS pos
  FROM combined),
parts1 AS (SELECT icpsr, congress, bioguide, term, min(pos) AS pos0 FROM parts0 GROUP BY ALL),
parts AS (SELECT *, row_number() OVER (PARTITION BY icpsr, congress, bioguide ORDER BY pos0) AS pos FROM parts1),
placed AS (SELECT *, row_number() OVER (PARTITION BY icpsr, congress, term ORDER BY bioguide NULLS FIRST, pos) AS rn,
                  count(*) OVER (PARTITION BY icpsr, congress, term) AS m FROM parts)
SELECT icpsr, congress, term, acronym, m * coalesce(k, 1) AS n, bioguide, CAST(pos AS INTEGER) AS position
FROM placed LEFT JOIN cw ON term = cw_term WHERE rn = 1"""


# ---------------------------------------------------------------------------
# The real rule table
# ---------------------------------------------------------------------------
@_query
def recode_real_rules(spark: SparkSession, sf: str) -> DataFrame:
    """K2 with the curated table: each order carries the code and name of a
    rule (every other one with a wrong code), a period and a status."""
    rules = lg.id_recode_rules(spark)
    pick = rules.select(F.col("rule_id").alias("pick"), F.col("src_code").cast("bigint").alias("code"),
                        F.col("name").alias("name"))
    o = table(spark, sf, "orders").select(
        "o_orderkey", (F.col("o_orderkey") % 200).cast("int").alias("pick"), period_of("o_orderdate").alias("period"),
        (F.col("o_custkey") % 5).cast("int").alias("status"), (F.col("o_orderkey") % 3 == 0).alias("wrong"))
    rows = join_on(o, pick, ["pick"], "left").select(
        "o_orderkey", "name", "period", "status", F.lit(100).alias("party"),
        F.when(F.col("wrong"), F.col("code") + 1).otherwise(F.col("code")).alias("code"))
    rows = rows.withColumn("icpsr", F.col("code"))
    return ru.recode(rows, rules, {"src_code": "code", "name": "name"},
                     {"icpsr": "icpsr", "party": "party", "name": "name"}, {"period": "period", "status": "status"})


def _rule_values() -> str:
    with open(lg.ID_RECODES_CSV, encoding="utf-8") as f:
        rows = list(csv.DictReader(x for x in f if not x.startswith("#")))

    def lit(v: str, number: bool) -> str:
        return "NULL" if v in ("", "NA") else v if number else "'" + v.replace("'", "''") + "'"

    return ",\n".join("(" + ", ".join([
        lit(r["rule_id"], True), lit(r["ord"], True), lit(r["src_code"], True), lit(r["name"], False), lit(r["period"], True),
        lit(r["status"], True), lit(r["target"], False), lit(r["value"], False), r["active"].lower()]) + ")" for r in rows)


SQL["recode_real_rules"] = f"""
WITH rules(rule_id, ord, src_code, name, period, status, target, value, active) AS (VALUES
{_rule_values()}),
s AS (
  SELECT o_orderkey, r.name, {sql.period_sql('o_orderdate')} AS period, CAST(o_custkey % 5 AS INTEGER) AS status,
         CAST(r.src_code + CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS BIGINT) AS code
  FROM orders LEFT JOIN rules r ON r.rule_id = o_orderkey % 200),
w AS (
  SELECT o_orderkey, arg_max(r.value, r.ord) FILTER (WHERE r.target = 'icpsr') AS new_icpsr,
         arg_max(r.value, r.ord) FILTER (WHERE r.target = 'party') AS new_party,
         arg_max(r.value, r.ord) FILTER (WHERE r.target = 'name') AS new_name
  FROM s JOIN rules r ON r.active AND r.src_code = s.code AND r.name = s.name
                     AND (r.period IS NULL OR r.period = s.period) AND (r.status IS NULL OR r.status = s.status)
  GROUP BY o_orderkey)
SELECT o_orderkey, coalesce(new_name, s.name) AS name, period, status, code,
       coalesce(CAST(new_party AS INTEGER), 100) AS party, coalesce(CAST(new_icpsr AS BIGINT), code) AS icpsr
FROM s LEFT JOIN w USING (o_orderkey)"""


# ---------------------------------------------------------------------------
# Roles as a whole, person metadata, schema verbs
# ---------------------------------------------------------------------------
@_query
def role_classification(spark: SparkSession, sf: str) -> DataFrame:
    """Both ladders, all flags, prestige and chair_of for every line item."""
    code = F.col("l_quantity").cast("int") + 10 * (F.col("l_linenumber").cast("int") - 1)
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_quantity") != 50, code).alias("seniorstatus"),
        F.when(F.col("l_returnflag") == "A", "RULES").when(F.col("l_returnflag") == "N", "LIBRARY")
         .when(F.col("l_linestatus") == "F", "OTHER").alias("committee"),
        F.when(F.col("l_linenumber") != 7, F.col("l_linenumber").cast("int") % 3).alias("partystatus"))
    return classify_roles(li)


SQL["role_classification"] = f"""
WITH r AS (
  SELECT l_orderkey, l_linenumber,
         CASE WHEN l_quantity <> 50 THEN CAST(l_quantity AS INTEGER) + 10 * (CAST(l_linenumber AS INTEGER) - 1) END AS s,
         CASE WHEN l_returnflag = 'A' THEN 'RULES' WHEN l_returnflag = 'N' THEN 'LIBRARY'
              WHEN l_linestatus = 'F' THEN 'OTHER' END AS committee,
         CASE WHEN l_linenumber <> 7 THEN CAST(l_linenumber AS INTEGER) % 3 END AS partystatus
  FROM lineitem),
l AS (SELECT *, {sql.POSITION_SQL} AS position, {sql.LEADERSHIP_SQL} AS lp,
             CASE WHEN committee = 'RULES' THEN 1 ELSE 0 END AS prestige FROM r),
f AS (SELECT *, CASE WHEN lp = 'Chair' THEN 1 WHEN lp IS NOT NULL THEN 0 END AS chair FROM l)
SELECT l_orderkey, l_linenumber, s AS seniorstatus, committee, partystatus, position, lp AS leadership_position, chair,
       {sql._flag("'Ranking Minority'")} AS ranking_minority, {sql._flag("'Majority Leader'")} AS majority_leader,
       {sql._flag("'Speaker'")} AS speaker, {sql._flag("'Minority Leader'")} AS minority_leader,
       {sql._flag("'Majority Whip'")} AS majority_whip, {sql._flag("'Minority Whip'")} AS minority_whip,
       CASE WHEN lp IN ('Majority Leader', 'Minority Leader') THEN 1 ELSE 0 END AS party_leader,
       CASE WHEN lp IN ('Majority Whip', 'Minority Whip') THEN 1 ELSE 0 END AS party_whip,
       CASE WHEN partystatus IS NULL THEN NULL WHEN partystatus = 1 THEN 1 ELSE 0 END AS majority, prestige,
       CASE WHEN prestige = 1 AND chair = 1 THEN 1 WHEN (prestige = 1 AND chair = 1) IS NOT NULL THEN 0 END AS prestige_chair,
       CASE WHEN chair = 1 AND committee <> 'LIBRARY' AND committee <> 'PRINTING' THEN committee
            WHEN (chair = 1 AND committee <> 'LIBRARY' AND committee <> 'PRINTING') IS NOT NULL THEN 'None' END AS chair_of
FROM f"""


@_query
def person_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """Member-periods with their person's columns; unknown persons keep NULLs."""
    o = table(spark, sf, "orders")
    known = F.when(F.col("o_custkey") % 11 == 0, F.lit(None)).otherwise(
        F.when(F.col("o_custkey") % 13 == 0, -F.col("o_custkey")).otherwise(F.col("o_custkey")))
    mc = o.select(known.alias("bioguide_id"), period_of("o_orderdate").alias("congress")).distinct()
    c = table(spark, sf, "customer")
    people = c.select(F.col("c_custkey").alias("bioguide_id"), F.col("c_name").alias("full_name"),
                      F.when(F.col("c_acctbal") < 0, F.lit(None)).otherwise(F.col("c_custkey") + 10_000).alias("icpsr_id"),
                      paste("c_mktsegment", "c_nationkey", sep="-").alias("wikipedia_id"))
    return join_on(mc, people, ["bioguide_id"], "left")


SQL["person_metadata"] = f"""
WITH mc AS (
  SELECT DISTINCT CASE WHEN o_custkey % 11 = 0 THEN NULL WHEN o_custkey % 13 = 0 THEN -o_custkey ELSE o_custkey END AS bioguide_id,
         {sql.period_sql('o_orderdate')} AS congress FROM orders)
SELECT mc.bioguide_id, mc.congress, c_name AS full_name, CASE WHEN c_acctbal >= 0 THEN c_custkey + 10000 END AS icpsr_id,
       c_mktsegment || '-' || CAST(c_nationkey AS VARCHAR) AS wikipedia_id
FROM mc LEFT JOIN customer ON c_custkey = mc.bioguide_id"""


@_query
def schema_verbs(spark: SparkSession, sf: str) -> DataFrame:
    """Columns by prefix, one renamed and moved to the front, rows
    whose number isn't 0 (NULL drops)."""
    s = table(spark, sf, "supplier").withColumn(
        "s_nationkey", F.when(F.col("s_nationkey") == 5, F.lit(None)).otherwise(F.col("s_nationkey")))
    s = s.select(*rp.columns_starting_with(s, "s_na"), "s_suppkey")
    s = s.withColumnRenamed("s_nationkey", "district").select("s_suppkey", *[c for c in s.columns if c not in ("s_suppkey", "s_nationkey")], "district")
    return s.filter(F.col("district") != 0)


SQL["schema_verbs"] = """
SELECT s_suppkey, s_name, s_nationkey AS district FROM supplier WHERE s_nationkey NOT IN (0, 5)"""


@_query
def table_dims(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and columns of some tables."""
    out = None
    for name in ("region", "supplier", "orders", "lineitem"):
        d = rp.dims(table(spark, sf, name)).select(F.lit(name).alias("name"), "rows", "columns")
        out = d if out is None else out.unionByName(d)
    return out


SQL["table_dims"] = " UNION ALL ".join(
    f"SELECT '{t}' AS name, (SELECT count(*) FROM {t}) AS rows, "
    f"CAST((SELECT count(*) FROM (DESCRIBE {t})) AS INTEGER) AS columns" for t in ("region", "supplier", "orders", "lineitem"))


# ---------------------------------------------------------------------------
# Period facts kept up to date
# ---------------------------------------------------------------------------
@_query
def period_facts_merged(spark: SparkSession, sf: str) -> DataFrame:
    """K1 in two landings: the versions of even days, then those of odd days,
    each merged into the facts of the periods by a run of its own."""
    landing, sink = shared_dir(spark, "landing"), shared_dir(spark, "facts")
    for days in ("day(day) % 2 = 0", "day(day) % 2 = 1"):
        dq.land_event_snapshots(spark, sf, landing, days=days)
        facts = facts_stream(spark, landing, sink, sink + "-checkpoint", dq._members_from_decoded)
    return facts


SQL["period_facts_merged"] = sql.SNAPSHOT_MEMBERS
