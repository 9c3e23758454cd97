"""The reference's workflow end to end on small inline inputs."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from membra.plans import roster_jobs as rj
from membra.rules import legacy as lg
from membra.sources.files import HOUSE_SHEET_NAMES, SENATE_SHEET_NAMES


def _snapshots(spark):
    d = tempfile.mkdtemp(prefix="membra-hist-")
    docs = {
        "committee-membership-2019-03-28-aaaaaaa.yaml":
            "HSWM:\n- {name: Ann Smith, bioguide: S000001, title: Chair}\n"
            "- {name: Bob Jones, bioguide: J000002}\nHSWM01:\n- {name: Ann Smith, bioguide: S000001}\n",
        "committee-membership-2020-12-07-bbbbbbb.yaml":
            "HSWM:\n- {name: Ann Smith, bioguide: S000001, title: Chair}\n"
            "SSVA:\n- {name: Cy Young, bioguide: Y000003, title: Ranking Member}\n",
        "committee-membership-2021-01-02-ccccccc.yaml": "HSWM: [\n",
    }
    for n, t in docs.items():
        with open(os.path.join(d, n), "w") as f:
            f.write(t)
    return d


def test_whole_workflow(spark):
    hist = rj.membership_history(spark, _snapshots(spark))
    assert hist["quarantine"].count() == 1
    assert hist["per_congress"].count() == 4

    member_groups = spark.createDataFrame(
        [("HSWM", "House Committee on Ways and Means", "house"),
         ("SSVA", "Senate Committee on Veterans' Affairs", "senate")],
        "thomas_id string, name string, type string")
    cur = spark.createDataFrame([("S000001", 101, "Ann Smith", "Ann_Smith")],
                                "bioguide_id string, icpsr_id int, full_name string, "
                                "wikipedia_id string")
    old = spark.createDataFrame([("J000002", None, "Bob Jones", "Bob Jones (politician)"),
                                 ("Y000003", None, "Cy Young", None)],
                                "bioguide_id string, icpsr_id int, full_name string, "
                                "wikipedia_id string")
    dictionary = spark.createDataFrame([("Bob Jones", None, 202, "House")],
                                       "alias string, period int, icpsr int, chamber string")
    mc = rj.members_groups(hist["per_congress"], member_groups, cur, old, dictionary)
    got = {(r["bioguide"], r["congress"]): r for r in mc["members_groups"].collect()}
    assert got[("S000001", 116)]["member_groups"] == "WAYS" and got[("S000001", 116)]["icpsr"] == 101
    assert got[("J000002", 116)]["icpsr"] == 202 and got[("J000002", 116)]["chamber"] == "House"
    assert got[("Y000003", 116)]["member_groups"] == "VETERANS"
    assert mc["unresolved"].count() == 1

    def sheet(names, rows):
        cols = [f"c{i}" for i in range(len(names))]
        return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols) + ", row_number int")

    h = [None] * len(HOUSE_SHEET_NAMES)

    def hrow(**kw):
        r = list(h)
        for k, v in kw.items():
            r[HOUSE_SHEET_NAMES.index(k)] = v
        return r

    house = sheet(HOUSE_SHEET_NAMES, [
        hrow(congress="106.0", commcode="142", source_code="15001.0", name="Bartlett, Steve",
             partystatus="1.0", party="200", assigneddate="1999-01-06", seniorstatus="12",
             committeename="Ways and Means") + [1],
        hrow(congress="106", commcode="142", source_code="14873", name="Hoyer, Steny",
             partystatus="2", party="100", assigneddate="1999-01-06", seniorstatus="25",
             committeename="House Administration") + [2],
        hrow(congress="113", commcode="100", source_code="29999", name="Schiff, Adam",
             partystatus="2", party="x", assigneddate="2013-01-03", seniorstatus="0",
             committeename="Budget") + [3],
    ])
    s = [None] * len(SENATE_SHEET_NAMES)
    s[SENATE_SHEET_NAMES.index("congress")] = "113"
    s[SENATE_SHEET_NAMES.index("source_code")] = "40001"
    s[SENATE_SHEET_NAMES.index("name")] = "Wyden, Ron"
    s[SENATE_SHEET_NAMES.index("committeename")] = "Energy and Natural Resources"
    s[SENATE_SHEET_NAMES.index("assigneddate")] = "2013-01-03"
    s[SENATE_SHEET_NAMES.index("seniorstatus")] = "11"
    senate = sheet(SENATE_SHEET_NAMES, [s + [4]])
    legacy = rj.legacy_assignments(spark, house, senate)
    got = {r["name"]: r for r in legacy.collect()}
    assert got["Bartlett, Steve"]["icpsr"] == 15002          # id recode rule
    assert got["Bartlett, Steve"]["congress"] == 106 and got["Bartlett, Steve"]["majority"] == 1
    assert got["Bartlett, Steve"]["chair"] == 1 and got["Bartlett, Steve"]["prestige"] == 1
    assert got["Hoyer, Steny"]["seniorstatus"] == 21        # subset patch on the recoded id
    assert got["Schiff, Adam"]["party"] == 100              # party patch; "x" -> NULL first
    assert got["Wyden, Ron"]["terminationdate"] == dt.date(2014, 2, 12)   # date patch
    assert got["Wyden, Ron"]["committee"] == "ENERGY" and got["Wyden, Ron"]["chair_of"] == "ENERGY"
    assert legacy.columns[:4] == ["icpsr", "name", "congress", "chamber"]

    corrections = spark.createDataFrame([(116, 303, "FINANCE")],
                                        "congress int, icpsr int, member_groups string")
    oversight = spark.createDataFrame([("House Ways and Means; Budget", "TREAS")],
                                      "`Reporting Committees` string, department_agency_acronym string")
    roster = spark.createDataFrame(
        [("House", 116, "SMITH, Ann", 101, "md", "MD", "S000001"),
         ("House", 116, "JONES, Bob", 202, "ny", "NY", "J000002"),
         ("House", 116, "NEW, Person", 404, "ca", "CA", "N000004")],
        "chamber string, congress int, bioname string, icpsr int, state string, "
        "state_abbrev string, bioguide_id string")
    missing_ids = spark.createDataFrame([(116, "X000000")], "congress int, bioguide string")
    out = rj.merge_sources(legacy, mc["members_groups"], corrections, oversight, roster,
                           missing_ids)
    comb = {r["icpsr"]: r for r in out["combined"].collect()}
    assert comb[303]["groups_b"] == "FINANCE"
    assert comb[15002]["groups_a"] == "WAYS"
    assert [r["icpsr"] for r in out["missing_groups"].collect()] == [404]
    assert out["oversight"].filter(F.col("icpsr") == 101).first()["oversight"] == "TREAS"

    agencies = spark.createDataFrame([("EPA",), ("DOE",)], "Agency string")
    cw = spark.createDataFrame([(None, "EPA", "EPA"), ("X", "DOE", "DOE")],
                               "ACUS_agency string, agency string, department_agency_acronym string")
    ot = rj.oversight_table(agencies, cw)
    assert [r[0] for r in ot["unmatched"].collect()] == ["DOE"]


def test_rule_table_loads(spark):
    rules = lg.id_recode_rules(spark)
    assert rules.count() == 187
    assert rules.filter(~F.col("active")).count() == 3
    assert rules.filter(F.col("target") == "icpsr").count() == 185


def test_corrections_strict_and_fixed(spark):  # Q18, Q19
    corr = spark.createDataFrame([(116, 1, "0"), (116, 2, "TRANSPORTATION | ENERGY")],
                                 "congress int, icpsr int, member_groups string")
    strict = {r["icpsr"]: r["corrected_groups"]
              for r in rj.corrections_for_overlay(corr).collect()}
    fixed = {r["icpsr"]: r["corrected_groups"]
             for r in rj.corrections_for_overlay(corr, strict=False).collect()}
    assert strict == {1: "0", 2: "TRANSPORTATION | ENERGY"}
    assert fixed == {1: None, 2: "ENERGY;TRANSPORTATION"}
