"""Curated rules of the reference's workflow, as data.

Fixed values: every literal below must equal the reference's for equal
results.  They are listed in their original order; the operators that apply
them are generic (``membra.operators.rules``).  The 187 id/party/name recode
rules live in ``id_recodes.csv`` next to this file.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rules import RULE_SCHEMA, Patch

RULES_DIR = os.path.dirname(os.path.abspath(__file__))
ID_RECODES_CSV = os.path.join(RULES_DIR, "id_recodes.csv")

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------
# (icpsr, bioguide) pairs removed from the merged table, twice, with R's
# three-valued filter.
EXCLUDED_ID_PAIRS = (
    (22529, "K000402"),
    (22341, "L000602"),
    (41110, "L000597"),
    (21526, "M001221"),
    (29373, "M001226"),
    (1110, "L000597"),
)

# Seniority codes set on (icpsr, period, committee code): x[cond] <- v form.
SENIORITY_SUBSET_PATCHES = (
    (14873, 106, 142, 21),
    (14039, 106, 176, 21),
    (15448, 106, 242, 0),
    (15005, 106, 186, 21),
)

# Party codes set by member name: ifelse form (a NULL name gives NULL).
PARTY_PATCHES = (
    ("Byrne, Bradley", 200),
    ("Johnson, Tim", 100),
    ("Johnson, Bill", 200),
    ("Davis, Rodney", 200),
    ("Turner, Bob L.", 200),
    ("Schiff, Adam", 100),
    ("Guinta, Frank", 200),
    ("Newhouse, Dan", 200),
    ("Bost, Mike", 200),
    ("Hensarling, Jeb", 200),
    ("Davidson, Warren", 200),
    ("Hoeven, John", 200),
)

# Seniority codes set by (name, assigned-date test[, committee name]): ifelse form.
# The date test is (operator, date).
SENIORITY_DATE_PATCHES = (
    ("Waters, Maxine", (">=", "2015-01-06"), None, 21),
    ("Brown, Corrine", ("==", "2015-01-06"), None, 22),
    ("Stark, Fortney Pete", ("==", "2009-01-07"), None, 0),
    ("Coats, Dan", ("==", "2015-01-07"), ("committeename", "Economic (Joint Committee)"), 11),
)

# Date corrections: (target, new date, name, period or None, assigned date or None,
# (committee column, value)).  ifelse form, applied in this order.
DATE_PATCHES = (
    ("terminationdate", "2010-03-03", "Rangel, Charles B.", None, "2009-01-06",
     ("committeename", "Ways and Means")),
    ("assigneddate", "2010-03-04", "Levin, Sander M.", None, "2009-01-07",
     ("committeename", "Ways and Means")),
    ("assigneddate", "2015-10-29", "Brady, Kevin", None, "2015-01-13",
     ("committeename", "Ways and Means")),
    ("terminationdate", "2014-02-12", "Cantwell, Maria", 113, None,
     ("committeename", "Indian Affairs (Select Committee)")),
    ("assigneddate", "2014-02-12", "Tester, Jon", 113, None,
     ("committeename", "Indian Affairs (Select Committee)")),
    ("terminationdate", "2009-09-09", "Harkin, Tom", 111, None,
     ("committeename", "Agriculture, Nutrition, and Forestry")),
    ("assigneddate", "2009-09-09", "Lincoln, Blanche Lambert", 111, None,
     ("committeename", "Agriculture, Nutrition, and Forestry")),
    ("assigneddate", "2014-02-12", "Wyden, Ron", 113, None, ("committeename", "Finance")),
    ("assigneddate", "2009-09-09", "Harkin, Tom", 111, None, ("committeename", "HEALTH")),
    ("terminationdate", "2014-02-12", "Wyden, Ron", 113, None, ("committee", "ENERGY")),
    ("assigneddate", "2014-02-12", "Landrieu, Mary L.", 113, None, ("committee", "ENERGY")),
    ("terminationdate", "2014-02-12", "Landrieu, Mary L.", 113, None,
     ("committee", "SMALL BUSINESS")),
    ("assigneddate", "2014-02-12", "Cantwell, Maria", 113, None, ("committee", "SMALL BUSINESS")),
)

# The single-person id fill of the roster side.
LITERAL_ID_PATCH = ("Kelly Loeffler", 41904)


def id_recode_rules(spark: SparkSession, path: str = ID_RECODES_CSV) -> DataFrame:
    """The recode rule table (schema ``RULE_SCHEMA``)."""
    return (spark.read.option("header", True).option("comment", "#")
            .option("quote", '"').option("escape", '"').schema(RULE_SCHEMA).csv(path))


def _d(s: str):
    return F.lit(s).cast("date")


def seniority_subset_patches() -> list[Patch]:
    return [Patch("seniorstatus", v, {"icpsr": i, "congress": p, "commcode": c}, "subset")
            for i, p, c, v in SENIORITY_SUBSET_PATCHES]


def party_patches() -> list[Patch]:
    return [Patch("party", v, {"name": n}, "ifelse") for n, v in PARTY_PATCHES]


def seniority_date_patches() -> list[Patch]:
    out = []
    for name, (op, day), extra, v in SENIORITY_DATE_PATCHES:
        test = F.col("assigneddate") >= _d(day) if op == ">=" else F.col("assigneddate") == _d(day)
        when = {"name": name}
        if extra:
            when[extra[0]] = extra[1]
        out.append(Patch("seniorstatus", v, when, "ifelse", extra=test))
    return out


def date_patches() -> list[Patch]:
    out = []
    for target, new, name, period, assigned, (ccol, cval) in DATE_PATCHES:
        when = {"name": name}
        if period is not None:
            when["congress"] = period
        if assigned is not None:
            when["assigneddate"] = _d(assigned)
        when[ccol] = cval
        out.append(Patch(target, _d(new), when, "ifelse"))
    return out
