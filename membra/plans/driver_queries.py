"""

Analogy used throughout: a *member* is a customer (``o_custkey``), a
*period* is the period of ``o_orderdate`` (P16), a *group* is the part type,
*source A* / *source B* are line items with return flag ``R`` / ``A``, the
*sub-unit* of source A is ``l_linestatus``, a *role code* is
``l_quantity``.  NULLs are made with explicit rules because the tables hold
none.  Every query scans whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.periods import (base_name, election_year_of, election_year_table, period_of,
                                 snapshot_date_of, version_file_name)
from ..functions.semantics import if_else3, in_set, paste
from ..functions.text import (canonical_name_a, canonical_name_b, repair_set_string,
                              strip_collapsed_na)
from ..operators import link as lk
from ..operators import reconcile as rc
from ..operators import reports as rp
from ..operators import rules as ru
from ..operators import sets as st
from ..operators import joins as jn
from ..operators.joins import join_on, literal_table
from ..operators.roles import (group_flags, leadership_flags, leadership_of, position_of,
                               range_ladder, spell_features)
from ..operators.sets import normalize_set
from ..session import shared_dir
from ..sources import snapshots as snap
from ..sources.files import save_stage
from ..streaming.snapshot_stream import snapshot_stream as stream_snapshots
from .tables import spread_by_text, table

# Fixed values of the analogy (role titles of source B by role code).
TITLE_LADDER = (
    ("Chair", 1, 3),
    ("Ranking Member", 4, 6),
    ("Vice Chair", 7, 7),
    ("Cochairman", 8, 8),
    ("Chairman", 9, 9),
    ("Member", 10, 12),
)
NULL_ID_PRIORITY = "5-LOW"   # first line of such orders has no member id
NULL_GROUP_MIN_SIZE = 46     # parts this large have no group


def assignments(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as (member, period, group, role) assignment rows."""
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate",
                                          "o_orderpriority")
    p = table(spark, sf, "part").select("p_partkey", "p_type", "p_size")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
    code = F.col("l_quantity").cast("int")
    return j.select(
        F.when((F.col("o_orderpriority") == NULL_ID_PRIORITY) & (F.col("l_linenumber") == 1),
               F.lit(None)).otherwise(F.col("o_custkey")).alias("icpsr"),
        period_of("o_orderdate").alias("congress"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"),
        F.col("l_returnflag").alias("source"),
        F.col("l_linestatus").alias("chamber"),
        F.concat(F.col("l_linestatus"),
                 F.lpad(F.col("o_custkey").cast("string"), 6, "0")).alias("bioguide"),
        F.when(F.col("p_size") >= NULL_GROUP_MIN_SIZE, F.lit(None))
         .otherwise(F.upper("p_type")).alias("committee"),
        code.alias("seniorstatus"),
        position_of(code).alias("position"),
        range_ladder(code, TITLE_LADDER).alias("title"),
    )


def two_source_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    """K5: both sources normalised at (member, period) and full-joined."""
    rows = assignments(spark, sf)
    return rc.reconcile_rows(rows, "source", "R", "A", "icpsr", "congress", "chamber", "bioguide",
                             "committee", "position", "title", "ord")


def discrepancy_report(spark: SparkSession, sf: str) -> DataFrame:
    """Both sources present and different, by member then latest period."""
    return rc.discrepancies(two_source_reconcile(spark, sf), "groups_a",
                            "groups_b", [F.col("icpsr"), F.desc("congress")])


def role_flags(spark: SparkSession, sf: str) -> DataFrame:
    """K9: chair / ranking flags from role text and the combined group set.
    The reconcile output has one row per (member, period, person), so the
    reference's ``distinct`` cannot remove anything and is skipped."""
    return rc.role_flags(two_source_reconcile(spark, sf), dedupe=False)




# ---------------------------------------------------------------------------
# Periods, versions, nested documents
# ---------------------------------------------------------------------------
def period_from_date(spark: SparkSession, sf: str) -> DataFrame:
    """Period of every order date."""
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"),
                    period_of("o_orderdate").alias("congress"))


def period_year_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Election year through the 20-row ``sequence`` table
    (broadcast: its size is fixed), the arithmetic form ten periods later, and
    the pasted id-year key ("NA" for NULLs)."""
    o = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") == NULL_ID_PRIORITY, F.lit(None))
         .otherwise(F.col("o_custkey")).alias("icpsr"),
        period_of("o_orderdate").alias("congress"))
    years = F.broadcast(election_year_table(spark))
    j = join_on(o, years, [("congress", "period")], "left").drop("period")
    return j.select("o_orderkey", "congress", "year_elected",
                    election_year_of(F.col("congress") + 10).alias("year_elected_plus10"),
                    paste("icpsr", "year_elected", sep="").alias("icpsr_year"))


SNAPSHOT_PREFIX = "committee-membership"


def snapshot_name_and_date(spark: SparkSession, sf: str) -> DataFrame:
    """A version name per event (date + short hash), the date read
    back from the name, its period and the base name of a landing path."""
    e = table(spark, sf, "events")
    named = e.select("event_id", version_file_name(
        SNAPSHOT_PREFIX, F.col("ts").cast("date"), F.md5(F.col("event_id").cast("string")))
        .alias("file_name"))
    d = snapshot_date_of("file_name")
    return named.select("event_id", "file_name", d.alias("snapshot_date"),
                        period_of(d).alias("congress"),
                        base_name(F.concat(F.lit("/landing/"), F.col("file_name")))
                        .alias("base_name"))


NESTED_DOC_SCHEMA = "map<string, array<struct<k: bigint>>>"


def nested_map_explode(spark: SparkSession, sf: str) -> DataFrame:
    """A nested document per event, ``{type: [props, {k: user}],
    "all": [props]}``, exploded to one row per (group, member)."""
    e = table(spark, sf, "events")
    doc = F.concat(F.lit('{"'), F.col("event_type"), F.lit('": ['), F.col("props"),
                   F.lit(', {"k": '), F.col("user_id").cast("string"), F.lit('}], "all": ['),
                   F.col("props"), F.lit("]}"))
    groups = e.select("event_id", F.explode(F.from_json(doc, NESTED_DOC_SCHEMA))
                      .alias("thomas_id", "members"))
    return groups.select("event_id", "thomas_id",
                         F.posexplode("members").alias("member_pos", "m")) \
        .select("event_id", "thomas_id", "member_pos", F.col("m.k").alias("k"))


def union_missing_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Stack two tables by column name, absent columns NULL."""
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"), F.col("c_mktsegment").alias("segment"),
        F.lit("customer").alias("source"))
    s = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"),
        F.lit("supplier").alias("source"))
    return c.unionByName(s, allowMissingColumns=True)


def _event_members(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    d = F.col("ts").cast("date")
    return e.select("event_id", d.alias("snapshot_date"), period_of(d).alias("congress"),
                    "user_id", "event_type")


def snapshot_distinct_per_period(spark: SparkSession, sf: str) -> DataFrame:
    """K1/A4: daily snapshots reduced to the distinct facts of each period."""
    return _event_members(spark, sf).select("congress", "user_id", "event_type").distinct()


def duplicate_audit(spark: SparkSession, sf: str) -> DataFrame:
    """(member, group, snapshot) keys seen more than once."""
    m = _event_members(spark, sf)
    return rp.duplicate_audit(m, ["user_id", "event_type", "snapshot_date"]) \
        .select("event_id", "user_id", "event_type", "snapshot_date", "n")


# ---------------------------------------------------------------------------
# Conditionals, ladders, flags
# ---------------------------------------------------------------------------
def null_propagating_ifelse(spark: SparkSession, sf: str) -> DataFrame:
    """P12-P15 with NULLs made by rule (segment BUILDING has none)."""
    c = table(spark, sf, "customer")
    seg = F.when(F.col("c_mktsegment") == "BUILDING", F.lit(None)).otherwise(F.col("c_mktsegment"))
    c = c.select("c_custkey", "c_nationkey", seg.alias("seg"))
    return c.select(
        "c_custkey", "seg",
        if_else3(F.col("seg") == "MACHINERY", 1, 0).alias("machinery"),
        if_else3(F.col("seg") == "HOUSEHOLD", F.lit("2020-01-01").cast("date"),
                 F.lit("2019-01-01").cast("date")).alias("since"),
        F.when(in_set("seg", ["FURNITURE", "MACHINERY"]), F.col("seg")).alias("seg_known"),
        F.when(F.col("seg").isNotNull(), if_else3(F.col("c_nationkey") < 10, 1, 0))
         .alias("nation_gated"))


def _role_codes(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    code = F.col("l_quantity").cast("int") + 10 * (F.col("l_linenumber") - 1)
    return li.select(
        F.when(F.col("l_quantity") == 50, F.lit(None)).otherwise(code).alias("seniorstatus"),
        F.when(F.col("l_returnflag") == "R", F.lit(1))
         .when(F.col("l_returnflag") == "A", F.lit(2)).alias("partystatus"))


def range_ladder_position(spark: SparkSession, sf: str) -> DataFrame:
    """Position ladder on every line's role code, counted per code."""
    r = _role_codes(spark, sf).select("seniorstatus", position_of("seniorstatus").alias("position"))
    return rp.value_counts(r, ["seniorstatus", "position"], sort=False)


def range_ladder_leadership(spark: SparkSession, sf: str) -> DataFrame:
    """Leadership ladder and its one-hot flags, counted per code."""
    r = _role_codes(spark, sf).withColumn("leadership_position", leadership_of("seniorstatus"))
    r = leadership_flags(r, "leadership_position", "partystatus")
    keys = [c for c in r.columns]
    return rp.value_counts(r, keys, sort=False)


# Fixed values of the analogy for P22/P24 (part types stand in for groups).
ANALOG_PRESTIGE = ("PROMO", "LARGE")
ANALOG_NOT_CHAIR_OF = ("SMALL", "MEDIUM")


def set_flags(spark: SparkSession, sf: str) -> DataFrame:
    """Prestige and chair-of flags per part."""
    p = table(spark, sf, "part")
    p = p.select("p_partkey",
                 F.when(F.col("p_brand") == "Brand#1", F.lit(None))
                  .otherwise(F.upper("p_type")).alias("committee"),
                 if_else3(leadership_of("p_size") == "Chair", 1, 0).alias("chair"))
    return group_flags(p, "committee", "chair", ANALOG_PRESTIGE, ANALOG_NOT_CHAIR_OF)


# Fixed values of the analogy for K18: six (id, code) pairs.
EXCLUDED_PAIRS = ((1, "MACHINERY"), (2, "FURNITURE"), (5, "HOUSEHOLD"), (7, "BUILDING"),
                  (11, "MACHINERY"), (13, "HOUSEHOLD"))


def _kleene_input(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    return c.select("c_custkey",
                    F.when(F.col("c_nationkey") == 0, F.lit(None))
                     .otherwise(F.col("c_custkey")).alias("icpsr"),
                    F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit(None))
                     .otherwise(F.col("c_mktsegment")).alias("bioguide"))


def kleene_exclusion(spark: SparkSession, sf: str) -> DataFrame:
    """Drop listed pairs with three-valued logic (NULLs drop too)."""
    return ru.exclude_pairs(_kleene_input(spark, sf), EXCLUDED_PAIRS, "icpsr", "bioguide")


# ---------------------------------------------------------------------------
# Joins (J1, J2, J6, J9, K16)
# ---------------------------------------------------------------------------
def left_join_dim_dropna(spark: SparkSession, sf: str) -> DataFrame:
    """Join a deduplicated dimension, drop rows it does not cover."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    dim = table(spark, sf, "part").select(
        F.col("p_partkey").alias("l_partkey"),
        F.when(F.col("p_size") <= 40, F.upper("p_type")).alias("committee"))
    return jn.left_join_dim_dropna(li, dim, ["l_partkey"], "committee")


def null_safe_full_join(spark: SparkSession, sf: str) -> DataFrame:
    """Two pre-aggregated slices full-joined, NULL keys matching."""
    li = table(spark, sf, "lineitem")
    m = li.select(
        F.when((F.col("l_linestatus") == "O") & (F.col("l_linenumber") == 1), F.lit(None))
         .otherwise(F.col("l_suppkey")).alias("member"),
        period_of("l_shipdate").alias("period"), "l_returnflag")
    a = rp.value_counts(m.filter(F.col("l_returnflag") == "R"), ["member", "period"], "n_a", False)
    b = rp.value_counts(m.filter(F.col("l_returnflag") == "A"), ["member", "period"], "n_b", False)
    return join_on(a, b, ["member", "period"], "full")


def _agency_inputs(spark: SparkSession, sf: str):
    agencies = table(spark, sf, "supplier").select("s_suppkey", F.col("s_name").alias("Agency"))
    c = table(spark, sf, "customer")
    cw = c.select(
        F.regexp_replace("c_name", "Customer#", "Supplier#").alias("agency"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit(None))
         .otherwise(F.concat(F.lit("Supplier#"),
                             F.lpad(F.col("c_nationkey").cast("string"), 9, "0")))
         .alias("ACUS_agency"),
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit(None))
         .otherwise(F.concat(F.substring("c_mktsegment", 1, 3), F.lit("-"),
                             F.col("c_nationkey").cast("string")))
         .alias("department_agency_acronym"))
    return agencies, cw


def renamed_key_left_join(spark: SparkSession, sf: str) -> DataFrame:
    """Agency crosswalk with fallback name, known-name check and a
    left join on differently named keys (many-to-many kept)."""
    agencies, cw = _agency_inputs(spark, sf)
    return lk.agency_crosswalk(agencies, "Agency", cw, "ACUS_agency", "agency",
                               "department_agency_acronym")


def head_n(spark: SparkSession, sf: str) -> DataFrame:
    """O3: the first 15 agencies without an acronym (a top-k report)."""
    j = renamed_key_left_join(spark, sf)
    un = j.filter(F.col("department_agency_acronym").isNull()).select(
        F.col("Agency").alias("ACUS_agency"), "department_agency_acronym")
    return rp.head_n(un, [F.col("ACUS_agency")], 15)


# ---------------------------------------------------------------------------
# Rules (K2, K3, K6)
# ---------------------------------------------------------------------------
# Fixed values of the analogy: a recode rule table (schema RULE_SCHEMA).
RECODE_RULES = [
    (1, 1, 1, "Supplier#000000001", None, None, "icpsr", "2", True),
    (2, 2, 2, "Supplier#000000002", None, None, "icpsr", "3", True),
    (3, 3, 3, "Supplier#000000003", None, None, "icpsr", "30", True),
    (4, 4, 3, "Supplier#000000003", None, None, "icpsr", "31", True),
    (5, 5, 4, "Supplier#000000004", 11, None, "icpsr", "40", True),
    (6, 6, 5, "Supplier#000000005", 99, None, "icpsr", "50", True),
    (7, 7, 6, "Supplier#000000006", None, 1, "icpsr", "60", True),
    (8, 8, 6, "Supplier#000000006", None, 1, "party", "200", True),
    (9, 9, 7, "Supplier#000000007", None, None, "name", "Renamed, Seven", True),
    (10, 10, 8, "Supplier#000000008", None, None, "icpsr", "80", False),
    (11, 11, 9, "Wrong Name", None, None, "icpsr", "90", True),
]


def recode_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Simultaneous keyed recodes, last rule wins, inactive skipped."""
    s = table(spark, sf, "supplier").select(
        "s_suppkey", F.col("s_suppkey").alias("icpsr"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("period"),
        F.when(F.col("s_acctbal") > 0, F.lit(1)).otherwise(F.lit(2)).alias("status"),
        F.col("s_nationkey").alias("party"))
    rules = literal_table(spark, RECODE_RULES, ru.RULE_SCHEMA)
    return ru.recode(s, rules, {"src_code": "s_suppkey", "name": "name"},
                     {"icpsr": "icpsr", "party": "party", "name": "name"},
                     {"period": "period", "status": "status"})


def _patch_list():
    P = ru.Patch
    d = lambda s: F.lit(s).cast("date")
    return [
        P("seniorstatus", 21, {"congress": 105, "commcode": "3-MEDIUM"}, "subset"),
        P("seniorstatus", 0, {"congress": 104, "commcode": "1-URGENT"}, "subset"),
        P("party", 200, {"name": "F"}, "ifelse"),
        P("party", 100, {"name": "O"}, "ifelse"),
        P("seniorstatus", 22, {"name": "O", "assigneddate": d("1997-05-28")}, "ifelse"),
        P("terminationdate", d("2000-01-01"),
          {"name": "F", "congress": 103, "commcode": "2-HIGH"}, "ifelse"),
        P("assigneddate", d("1999-12-31"), {"name": "O"}, "ifelse",
          extra=F.col("assigneddate") >= d("2001-07-01")),
        P("assigneddate", d("2001-08-02"), {"name": "O", "assigneddate": d("1999-12-31")},
          "ifelse"),
    ]


def attribute_patches(spark: SparkSession, sf: str) -> DataFrame:
    """K3: patches in sequence; subset patches keep values on NULL tests,
    ifelse patches turn them NULL; a later patch reads an earlier result."""
    o = table(spark, sf, "orders")
    pr = F.substring("o_orderpriority", 1, 1)
    base = o.select(
        "o_orderkey", F.col("o_custkey").alias("icpsr"),
        period_of("o_orderdate").alias("congress"),
        F.col("o_orderpriority").alias("commcode"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_orderstatus"))
         .alias("name"),
        F.when(pr == "3", F.lit(None)).otherwise(pr.cast("int")).alias("seniorstatus"),
        F.lit(100).alias("party"),
        F.col("o_orderdate").cast("date").alias("assigneddate"),
        F.date_add(F.col("o_orderdate").cast("date"), 700).alias("terminationdate"))
    out = ru.apply_patches(base, _patch_list())
    return out.select("o_orderkey", "seniorstatus", "party", "assigneddate", "terminationdate")


def _corrections(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return o.filter((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")) \
        .select(period_of("o_orderdate").alias("congress"),
                F.col("o_custkey").alias("icpsr"),
                F.concat(F.lit("CORRECTED;"), F.col("o_orderpriority"))
                .alias("corrected_groups"))


def correction_overlay(spark: SparkSession, sf: str) -> DataFrame:
    """Corrections fill missing sets and add rows, never overwrite."""
    rows = assignments(spark, sf).filter(F.col("source") == "A")
    base = normalize_set(rows, ["icpsr", "congress"], "committee", "groups_b")
    return ru.overlay(base, _corrections(spark, sf), ["icpsr", "congress"],
                      "groups_b", "corrected_groups")


# ---------------------------------------------------------------------------
# Set aggregations
# ---------------------------------------------------------------------------
def _turns(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "conversations")
    return c.select(
        "conv_id", "turn", "role", "text",
        F.when(F.length("text") > 200, F.lit("long"))
         .when(F.length("text") < 20, F.lit(None)).otherwise(F.lit("short")).alias("kind"))


def member_period_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """K4/A5: per (conversation, role) the ordered unique words of its whole
    turns and the turn kinds, plus the number of roles of the conversation."""
    words = spread_by_text(_turns(spark, sf), "text").select(
        "conv_id", "turn", "role", "kind", F.posexplode_outer(F.split("text", " ")).alias("pos", "w"))
    t = words.select(
        "conv_id", "role", "kind", F.regexp_replace("w", "[.,;:!?]", "").alias("word"),
        F.struct("turn", F.coalesce(F.col("pos"), F.lit(0)).alias("pos")).alias("ord"))
    return st.member_period_rollup(t, "conv_id", "role",
                                   {"member_groups": F.col("word"), "titles": F.col("kind")},
                                   "ord")


def collapse_keep_na(spark: SparkSession, sf: str) -> DataFrame:
    """Ordered unique roles with NA kept, and all roles in order."""
    t = _turns(spark, sf).withColumn(
        "role", F.when(F.col("role") == "system", F.lit(None)).otherwise(F.col("role")))
    u = st.collapse_unique(t, ["conv_id"], "role", "turn", ";", "roles_unique", keep_na=True)
    a = st.collapse_all(t, ["conv_id"], "role", "turn", ";", "roles_all")
    return join_on(u, a, ["conv_id"], "inner")


def normalized_sets(spark: SparkSession, sf: str) -> DataFrame:
    """Canonical sets from messy set strings per (supplier, flag)."""
    li = table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag", "l_partkey")
    p = table(spark, sf, "part")
    raw = F.when(F.col("p_size") < 5, F.lit(None)).otherwise(F.concat(
        F.upper("p_type"), F.lit(" | "), F.regexp_replace("p_name", " ", "  "), F.lit(";NA;")))
    j = li.join(p.select("p_partkey", raw.alias("raw")), li.l_partkey == p.p_partkey)
    return normalize_set(j, ["l_suppkey", "l_returnflag"], "raw", "normalized")


def wide_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Each turn carries its conversation's role list, also split
    into nine columns."""
    t = table(spark, sf, "conversations").select("conv_id", "turn", "role")
    return st.wide_lists(t, ["conv_id"], "role", "turn", out="roles", n_columns=9, prefix="role")


# ---------------------------------------------------------------------------
# Text (X3, X4, X19, K7, K8)
# ---------------------------------------------------------------------------
def canonical_names_a(spark: SparkSession, sf: str) -> DataFrame:
    """X3 on every page title."""
    p = table(spark, sf, "pages")
    t = F.regexp_extract("html", "<title>(.*?)</title>", 1)
    return p.select("page_id", t.alias("title"), canonical_name_a(t).alias("canonical"))


def canonical_names_b(spark: SparkSession, sf: str) -> DataFrame:
    """X4 on every whole document."""
    d = table(spark, sf, "documents")
    return d.select("doc_id", canonical_name_b("text").alias("canonical"))


def set_string_repair(spark: SparkSession, sf: str) -> DataFrame:
    """Repair chain and the first-only inner NA removal."""
    p = table(spark, sf, "part")
    raw = F.when(F.col("p_brand") == "Brand#1", F.lit(None)).otherwise(F.concat(
        F.upper("p_type"),
        F.when(F.col("p_size") > 40, F.lit("TURAL RESOURCES")).otherwise(F.lit("")),
        F.lit("|"),
        F.when(F.col("p_size") < 8, F.lit("NA")).otherwise(F.upper("p_name")),
        F.lit(";NA"),
        F.when(F.col("p_size").between(20, 25), F.lit(";NA;NA;X")).otherwise(F.lit(""))))
    r = p.select("p_partkey", raw.alias("raw"))
    r = r.withColumn("repaired", repair_set_string("raw"))
    return r.withColumn("stripped", strip_collapsed_na("repaired"))


def _part_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    return lk.vocabulary(p.select(F.upper("p_name").alias("names")), "names", sep=" ")


def vocabulary_crosswalk(spark: SparkSession, sf: str) -> DataFrame:
    """Every part-name word found in each (upper-cased) document."""
    d = table(spark, sf, "documents").select("doc_id", "source", F.upper("text").alias("text"))
    return lk.vocabulary_crosswalk(d, "text", _part_vocabulary(spark, sf), "term",
                                   keep=["doc_id", "source"], keep_text=False, dedupe=False)


def vocabulary_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """K7 coverage (F9): does a document contain any vocabulary word?"""
    d = table(spark, sf, "documents").select("doc_id", F.upper("text").alias("text"))
    return lk.vocabulary_coverage(d, "text", _part_vocabulary(spark, sf), "term").drop("text")


def _combined(spark: SparkSession, sf: str) -> DataFrame:
    """The combined sets, from a written table of the reconcile: the attach and
    the reports on it read it several times."""
    reconciled = save_stage(two_source_reconcile(spark, sf), shared_dir(spark, "reconciled"))
    flagged = rc.role_flags(reconciled, dedupe=False)
    return flagged.withColumn("member_groups", repair_set_string("member_groups"))


def attach_by_crosswalk(spark: SparkSession, sf: str) -> DataFrame:
    """Attach brand lists to each member-period through its groups;
    rows without an id group by person (Q5)."""
    p = table(spark, sf, "part")
    # two crosswalk texts (odd and even sizes) can name one acronym for a group;
    # written, because the plan then knows its size, which doesn't follow the parts'
    cw = save_stage(p.select(
        F.upper("p_type").alias("member_groups"), (F.col("p_size") % 2).alias("text"),
        F.concat(F.substring("p_type", 1, 3), F.lit("-"),
                 (F.col("p_size") / 10).cast("int").cast("string")).alias("acronym")).distinct(),
        shared_dir(spark, "crosswalk"))
    # rows of one (member, period) differ in ``bioguide``, so the reference's
    # final ``distinct`` cannot remove anything and is skipped
    return lk.attach_by_crosswalk(_combined(spark, sf), ["icpsr", "congress"], "member_groups",
                                  ["bioguide"], cw, "member_groups", "acronym", dedupe=False,
                                  person="bioguide")


# ---------------------------------------------------------------------------
# Spells, reports, identities
# ---------------------------------------------------------------------------
def _spells(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    r = li.select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("icpsr"),
                  F.col("l_returnflag").alias("committee"),
                  F.when(F.col("l_quantity") == 50, F.lit(None))
                   .otherwise(F.col("l_shipdate").cast("date")).alias("assigneddate"),
                  position_of(F.col("l_quantity").cast("int")).alias("position"))
    return spell_features(r, "icpsr", "committee", "assigneddate", "position")


def first_assignment(spark: SparkSession, sf: str) -> DataFrame:
    """First assignment date and year per (member, group)."""
    return _spells(spark, sf).select(
        "l_orderkey", "l_linenumber", "member_committee", "firstassigneddate", "firstassigned",
        "assignedchairdate", "chair_since_2007")


def ever_chair(spark: SparkSession, sf: str) -> DataFrame:
    """(member, group) pairs with their ever-chair flag."""
    return _spells(spark, sf).select("member_committee", "firstassigned",
                                     "chair_since_2007").distinct()


def _roster(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_custkey", "o_orderdate")
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation")
    cn = c.join(n, c.c_nationkey == n.n_nationkey)
    j = o.join(cn, o.o_custkey == cn.c_custkey)
    return j.select(
        F.col("c_mktsegment").alias("chamber"), period_of("o_orderdate").alias("congress"),
        F.col("c_name").alias("bioname"), F.col("o_custkey").alias("icpsr"),
        F.lower("n_name").alias("state"),
        F.when(F.col("c_nationkey") == 24, F.lit("USA"))
         .when(F.col("c_nationkey") == 23, F.lit(None))
         .otherwise(F.concat(F.lit("N"), F.col("c_nationkey").cast("string")))
         .alias("state_abbrev"),
        F.concat(F.lit("F"), F.lpad(F.col("o_custkey").cast("string"), 6, "0"))
         .alias("bioguide_id"),
        (F.col("c_acctbal") < 0).alias("no_id")).distinct()


GAP_COLUMNS = ["chamber", "congress", "bioname", "icpsr", "state", "bioguide_id", "icpsr_missing"]


GAP_MIN_PERIOD = 102


def _roster_sets(spark: SparkSession, sf: str) -> DataFrame:
    members = lk.group_terms(_combined(spark, sf), ["icpsr", "congress"], "member_groups", ["bioguide"],
                             person="bioguide").select(
        "icpsr", "congress", "bioguide", "positions", "titles", "member_groups", "groups_a",
        "groups_b")
    members = save_stage(members, shared_dir(spark, "member-sets"))  # the history reads it twice
    return rp.roster_with_sets(_roster(spark, sf), members, ["icpsr", "congress"], "congress",
                               GAP_MIN_PERIOD)


def _is_gap():
    return rp.gap_condition("member_groups", "state_abbrev", "USA")


def gap_report(spark: SparkSession, sf: str) -> DataFrame:
    """Roster rows without groups, not flagged as missing an id."""
    missing = _roster(spark, sf).filter("no_id").select("congress", "bioguide_id")
    gaps = rp.gap_report(_roster_sets(spark, sf), _is_gap(), missing, ["congress", "bioguide_id"])
    return gaps.filter(~F.col("icpsr_missing")).select(*GAP_COLUMNS)


def gap_history(spark: SparkSession, sf: str) -> DataFrame:
    """All periods of members with a gap, with their sets."""
    joined = _roster_sets(spark, sf)
    ids = save_stage(rp.gap_ids(joined, _is_gap(), "icpsr"), shared_dir(spark, "gap-ids"))
    out = rp.gap_history(joined, ids, "icpsr", [F.col("icpsr")])
    return out.select("chamber", "congress", "bioname", "icpsr", "state", "bioguide_id",
                      "positions", "titles", "member_groups", "groups_a",
                      "groups_b")


def identity_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    """A person-period twice with different person ids."""
    roster = _roster(spark, sf)
    members = two_source_reconcile(spark, sf).select("icpsr", "congress", "bioguide")
    j = join_on(roster, members, ["icpsr", "congress"], "left")
    return rc.same_person_twice(
        j, ["bioname", "icpsr", "chamber", "congress"], "bioguide_id", "bioguide",
        {"chamber": "chamber", "congress": "congress", "bioname": "bioname", "icpsr": "icpsr",
         "bioguide_correct": "bioguide_id", "bioguide_incorrect": "bioguide"})


def identity_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Person ids per member id."""
    return rc.ids_per_key(two_source_reconcile(spark, sf), "icpsr", "bioguide")


def value_counts(spark: SparkSession, sf: str) -> DataFrame:
    """A1: ``count(priority, status, sort = TRUE)``."""
    return rp.value_counts(table(spark, sf, "orders"), ["o_orderpriority", "o_orderstatus"])


def null_counts(spark: SparkSession, sf: str) -> DataFrame:
    """A3: ``count(is.na(icpsr))`` over the assignment rows."""
    return rp.null_counts(assignments(spark, sf), "icpsr")


# ---------------------------------------------------------------------------
# Name resolution
# ---------------------------------------------------------------------------
def _alias_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    plain = c.select(F.col("c_name").alias("alias"), F.lit(None).cast("int").alias("period"),
                     F.col("c_custkey").alias("id"))
    dated = c.select(F.concat(F.lit("cust "), F.col("c_custkey").cast("string")).alias("alias"),
                     F.lit(104).alias("period"), F.col("c_custkey").alias("id"))
    return plain.unionByName(dated)


def name_resolution(spark: SparkSession, sf: str) -> DataFrame:
    """Order texts naming a customer in one of two forms; the short form
    is only valid in period 104."""
    o = table(spark, sf, "orders")
    long_form = F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))
    short_form = F.concat(F.lit("CUST "), F.col("o_custkey").cast("string"))
    text = F.concat(F.lit("Order "), F.col("o_orderkey").cast("string"), F.lit(" by "),
                    F.when(F.col("o_orderpriority") == "2-HIGH", short_form).otherwise(long_form),
                    F.lit(" ("), F.col("o_orderpriority"), F.lit(")"))
    t = o.select("o_orderkey", period_of("o_orderdate").alias("congress"), text.alias("text"))
    return lk.resolve_names(t, "text", "congress", _alias_dictionary(spark, sf),
                            "alias", "period", ["id"])


def _people(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_custkey", "o_orderdate")
    c = table(spark, sf, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey)
    seg = F.col("c_mktsegment")
    return j.select(
        F.concat(F.lit("F"), F.lpad(F.col("c_custkey").cast("string"), 6, "0")).alias("bioguide"),
        period_of("o_orderdate").alias("congress"),
        F.when(seg == "BUILDING", F.lit(None)).otherwise(F.col("c_name")).alias("name"),
        F.when(F.col("c_acctbal") < 0, F.lit(None)).otherwise(F.col("c_custkey")).alias("icpsr_id"),
        F.when(seg == "MACHINERY", F.lit(None)).otherwise(F.col("c_name")).alias("full_name"),
        F.when(F.col("c_nationkey") < 5, F.lit(None))
         .otherwise(F.concat(F.col("c_name"), F.lit(" (politician)"))).alias("wikipedia_id"),
    ).distinct()


# Fixed value of the analogy: the single-person literal id patch.
LITERAL_ID_PATCH = ("Customer#000000007", 41904)


def _people_patched(spark: SparkSession, sf: str) -> DataFrame:
    p = _people(spark, sf)
    name, new_id = LITERAL_ID_PATCH
    return p.withColumn("icpsr_id", if_else3(F.col("name") == name, F.lit(new_id).cast("bigint"),
                                             F.col("icpsr_id")))


def _resolved_missing(spark: SparkSession, sf: str) -> DataFrame:
    p = _people_patched(spark, sf).filter(F.col("icpsr_id").isNull())
    p = p.withColumn("lookup", paste("full_name", "wikipedia_id"))
    return lk.resolve_names(p, "lookup", "congress",
                            _alias_dictionary(spark, sf), "alias", "period", ["id"])


def missing_id_fill(spark: SparkSession, sf: str) -> DataFrame:
    """Keep existing ids, resolve names for the rest, full-join the
    fixes and coalesce."""
    fixes = _resolved_missing(spark, sf).select(
        "bioguide", "congress", F.col("id").alias("icpsr"))
    out = lk.fill_missing_ids(_people_patched(spark, sf), "icpsr_id", fixes,
                              ["bioguide", "congress"], "icpsr", "icpsr")
    return out.select("bioguide", "congress", "name", "icpsr_id", "icpsr")


def unresolved_ids(spark: SparkSession, sf: str) -> DataFrame:
    """K17 report: people still without an id after name resolution."""
    r = _resolved_missing(spark, sf).filter(F.col("id").isNull())
    return r.select("congress", "bioguide", "full_name", "wikipedia_id").distinct()


QUERIES = {
    "period_from_date": period_from_date,
    "period_year_lookup": period_year_lookup,
    "snapshot_name_and_date": snapshot_name_and_date,
    "nested_map_explode": nested_map_explode,
    "union_missing_columns": union_missing_columns,
    "snapshot_distinct_per_period": snapshot_distinct_per_period,
    "duplicate_audit": duplicate_audit,
    "null_propagating_ifelse": null_propagating_ifelse,
    "range_ladder_position": range_ladder_position,
    "range_ladder_leadership": range_ladder_leadership,
    "set_flags": set_flags,
    "kleene_exclusion": kleene_exclusion,
    "left_join_dim_dropna": left_join_dim_dropna,
    "null_safe_full_join": null_safe_full_join,
    "renamed_key_left_join": renamed_key_left_join,
    "recode_rules": recode_rules,
    "attribute_patches": attribute_patches,
    "correction_overlay": correction_overlay,
    "member_period_rollup": member_period_rollup,
    "collapse_keep_na": collapse_keep_na,
    "normalized_sets": normalized_sets,
    "two_source_reconcile": two_source_reconcile,
    "discrepancy_report": discrepancy_report,
    "role_flags": role_flags,
    "canonical_names_a": canonical_names_a,
    "canonical_names_b": canonical_names_b,
    "set_string_repair": set_string_repair,
    "vocabulary_crosswalk": vocabulary_crosswalk,
    "vocabulary_coverage": vocabulary_coverage,
    "attach_by_crosswalk": attach_by_crosswalk,
    "wide_lists": wide_lists,
    "first_assignment": first_assignment,
    "ever_chair": ever_chair,
    "gap_report": gap_report,
    "gap_history": gap_history,
    "identity_conflicts": identity_conflicts,
    "identity_counts": identity_counts,
    "name_resolution": name_resolution,
    "missing_id_fill": missing_id_fill,
    "unresolved_ids": unresolved_ids,
    "value_counts": value_counts,
    "null_counts": null_counts,
    "head_n": head_n,
}


# ---------------------------------------------------------------------------
# Snapshot files: landing, batch ingest with quarantine, streaming
# ---------------------------------------------------------------------------
# Fixed values of the analogy: days of the month whose snapshot is written
# broken in one of its parts, and how (only where quarantine is asked for).
BROKEN_DAYS = {7: "duplicate key", 14: "unparsable", 21: "empty or not a mapping"}
# Day of the month whose groups each hold a member written as bare text.
BARE_TEXT_DAY = 28

# Events per document: a version's events are split over as many part files
# (each a complete YAML document) as this needs, and one more.
EVENTS_PER_DOCUMENT = 50_000


def land_event_snapshots(spark: SparkSession, sf: str, path: str, broken: bool = False,
                         days: str = "true") -> None:
    """One snapshot version per event day: YAML documents ``{event_type:
    [member, ...]}`` with one flow-style member per event, written by Spark
    into ``path/file_name=<version>/salt=<k>/part-*``.  The number of documents
    of a version follows from its events, so no document grows with the data.
    With ``broken`` one part of the versions of ``BROKEN_DAYS`` is bad; ``days``
    is a condition on ``day`` for the versions to land."""
    e = table(spark, sf, "events").withColumn("day", F.col("ts").cast("date")).filter(days)
    sizes = e.groupBy("day").agg(F.ceil(F.count(F.lit(1)) / EVENTS_PER_DOCUMENT).alias("n"),
                                F.min("event_id").alias("first_id"))
    parts = F.col("n") + 1
    salt = F.pmod(F.xxhash64("event_id"), parts)
    named = join_on(e, sizes, ["day"], "inner").select(
        "event_id", "event_type", "user_id", "value", F.dayofmonth("day").alias("dom"),
        version_file_name(SNAPSHOT_PREFIX, F.col("day"),
                          F.md5(F.col("day").cast("string"))).alias("file_name"),
        salt.alias("salt"),
        (F.lit(broken) & (salt == F.pmod(F.xxhash64("first_id"), parts))).alias("bad_part"))
    named = named.repartition("file_name", "salt")
    w = Window.partitionBy("file_name", "salt", "event_type").orderBy("event_id")
    rn = F.row_number().over(w)
    title = F.when(F.col("value") > 50, F.lit(", title: Chair")).otherwise(F.lit(""))
    rank = F.when(F.col("value") > 90, F.lit(", rank: 1")).otherwise(F.lit(""))
    member = F.concat(F.lit("- {name: 'User "), F.col("user_id").cast("string"),
                      F.lit("', bioguide: U"), F.lpad(F.col("user_id").cast("string"), 6, "0"),
                      F.lit(", icpsr: "), F.col("user_id").cast("string"), title, rank, F.lit("}"))
    head = F.concat(F.col("event_type"), F.lit(":\n"))
    first = rn == 1
    dom = F.col("dom")
    bad = F.col("bad_part")
    line = (F.when(bad & (dom == 21), F.lit("# removed"))
             .when(bad & (dom == 7) & first, F.concat(head, member, F.lit("\n"), head, member))
             .when(bad & (dom == 14) & first, F.concat(head, member, F.lit("\n  ]bad: [")))
             .when(first & (dom == BARE_TEXT_DAY), F.concat(head, F.lit("- just text\n"), member))
             .otherwise(F.concat(F.when(first, head).otherwise(F.lit("")), member)))
    lines = named.select("file_name", "salt", "event_type", "event_id", line.alias("line"))
    (lines.sortWithinPartitions("file_name", "salt", "event_type", "event_id")
     .select("file_name", "salt", "line").write.mode("append")
     .partitionBy("file_name", "salt").text(path))


MEMBER_KEYS = ["name", "bioguide", "icpsr", "title", "rank", "value"]


def _members_from_decoded(decoded: DataFrame) -> DataFrame:
    m = snap.member_rows(decoded, MEMBER_KEYS)
    return snap.per_period_distinct(
        m.withColumns({c: F.col(c).try_cast("bigint") for c in ("icpsr", "rank")}),
        ["congress", "name", "bioguide", "thomas_id", "title", "icpsr", "rank", "value"])


def _landed(spark: SparkSession, sf: str, broken: bool = False) -> str:
    path = shared_dir(spark, "landing")
    land_event_snapshots(spark, sf, path, broken)
    return path


def _decoded(spark: SparkSession, sf: str, broken: bool = False) -> DataFrame:
    """The decoded files as a written table: they are parsed once."""
    files = snap.list_snapshots(spark, _landed(spark, sf, broken), partitioned=True)
    path = shared_dir(spark, "decoded")
    snap.decode_snapshots(files).write.parquet(path)
    return spark.read.schema(snap.DECODED_SCHEMA).parquet(path)


def snapshot_members(spark: SparkSession, sf: str) -> DataFrame:
    """K1 from files: list, decode, stack, distinct per period."""
    return _members_from_decoded(_decoded(spark, sf))


def quarantine_bad_files(spark: SparkSession, sf: str) -> DataFrame:
    """S3: the snapshot files set aside, with the kind of failure."""
    q = snap.quarantine(_decoded(spark, sf, broken=True))
    return q.select("source_file",
                    F.split("reason", ":").getItem(0).alias("reason_kind")).distinct()


def quarantine_kept_versions(spark: SparkSession, sf: str) -> DataFrame:
    """S3: members per version that stays; a version with one bad part goes whole."""
    m = snap.member_rows(_decoded(spark, sf, broken=True), ["name"])
    return m.filter("name is not null").groupBy("source_file").agg(F.count(F.lit(1)).alias("n"))


def snapshot_stream(spark: SparkSession, sf: str) -> DataFrame:
    """S10 incremental: the same landing folder drained by a Structured
    Streaming query (availableNow) into a Parquet member table."""
    landing = _landed(spark, sf)
    sink = shared_dir(spark, "snapshot-sink")
    ckpt = shared_dir(spark, "snapshot-sink-checkpoint")
    decoded = stream_snapshots(spark, landing, sink, ckpt)
    return _members_from_decoded(decoded)


QUERIES.update({
    "snapshot_members": snapshot_members,
    "quarantine_bad_files": quarantine_bad_files,
    "quarantine_kept_versions": quarantine_kept_versions,
    "snapshot_stream": snapshot_stream,
})


# ---------------------------------------------------------------------------
# Diagnostics (J5 + K10 first part, U3)
# ---------------------------------------------------------------------------
def naive_merge_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """Join both sources *before* normalising (many-to-many on
    member-period), keep pairs where both sets exist and differ, count them."""
    rows = assignments(spark, sf)
    a = st.group_sets(rows.filter(F.col("source") == "R"), ["icpsr", "congress", "chamber"],
                      {"member_groups": ("committee", "unique_na")}, "ord")
    a = a.withColumn("member_groups", F.regexp_replace("member_groups", r"\|", ";"))
    b = rc.roster_side(rows.filter(F.col("source") == "A"), "icpsr", "congress", "bioguide",
                       "committee", "title", "ord").drop("titles")
    naive = jn.join_split_nulls(a, b, ["icpsr", "congress"], "full", spread="right")
    look = naive.dropna(subset=["member_groups", "groups_b"]).filter(
        F.col("member_groups") != F.col("groups_b"))
    return rp.value_counts(look, ["icpsr", "bioguide", "congress", "member_groups",
                                  "groups_b"])


def vocabulary_unmatched(spark: SparkSession, sf: str) -> DataFrame:
    """Vocabulary terms that no document contains (``!%in%`` as anti-join)."""
    vocab = _part_vocabulary(spark, sf)
    found = vocabulary_crosswalk(spark, sf).select("term").distinct()
    return join_on(vocab, found, ["term"], "left_anti")


QUERIES.update({
    "naive_merge_overlap": naive_merge_overlap,
    "vocabulary_unmatched": vocabulary_unmatched,
})
