"""Role classification and spell features (K15: P19-P24, K13: W3, X15, J13)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.semantics import if_else3, in_set, paste
from .joins import join_on

# ---------------------------------------------------------------------------
# Fixed values (code ranges and labels of the two legacy role ladders)
# Each entry is (label, lowest code, highest code), inclusive, applied in this
# order; a later hit overrides an earlier one.  ``None`` = no upper end.
# ---------------------------------------------------------------------------
POSITION_LADDER = (
    ("Chair", 11, 16),
    ("Ranking Minority", 21, 23),
    ("Other", 0, 0),
    ("Other", 25, None),
)
POSITION_START = None  # codes outside every range stay NULL

LEADERSHIP_LADDER = (
    ("Chair", 10, 17),
    ("Ranking Minority", 20, 24),
    ("Speaker", 31, 33),
    ("Majority Leader", 41, 44),
    ("Majority Whip", 51, 53),
    ("Minority Leader", 61, 63),
    ("Minority Whip", 61, 63),
)
LEADERSHIP_START = "All Others"

# One 0/1 flag per label (``==``, so a NULL label gives a NULL flag).
LEADERSHIP_FLAGS = (
    ("chair", "Chair"),
    ("ranking_minority", "Ranking Minority"),
    ("majority_leader", "Majority Leader"),
    ("speaker", "Speaker"),
    ("minority_leader", "Minority Leader"),
    ("majority_whip", "Majority Whip"),
    ("minority_whip", "Minority Whip"),
)
# Flags from label sets (``%in%``, so a NULL label gives 0).
LEADERSHIP_SET_FLAGS = (
    ("party_leader", ("Majority Leader", "Minority Leader")),
    ("party_whip", ("Majority Whip", "Minority Whip")),
)
MAJORITY_STATUS = 1
PRESTIGE_GROUPS = ("RULES", "BUDGET", "WAYS", "COMMERCE", "APPROPRIATIONS",
                   "ARMED SERVICES", "FINANCE", "FOREIGN RELATIONS")
NOT_CHAIR_OF = ("LIBRARY", "PRINTING")
CHAIR_OF_NONE = "None"
CHAIR_LABEL = "Chair"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def range_ladder(code, ladder: Sequence[tuple], start=None) -> Column:
    """Apply ``ifelse(lo <= code & code <= hi, label, previous)`` rung by rung,
    starting from ``start``.  A NULL code makes the first test NULL, so the
    result is NULL (R's ``ifelse``); codes outside every range keep ``start``
    (NULL for the position ladder, "All Others" for the leadership one)."""
    s = _c(code)
    out = F.lit(start).cast("string")
    for label, lo, hi in ladder:
        cond = s >= lo if hi is None else ((s >= lo) & (s <= hi))
        out = if_else3(cond, F.lit(label), out)
    return out


def position_of(code) -> Column:
    """Ladder A (P19): 11-16 Chair, 21-23 Ranking Minority, 0 or >24 Other,
    everything else NULL."""
    return range_ladder(code, POSITION_LADDER, POSITION_START)


def leadership_of(code) -> Column:
    """Ladder B (P20): misses are "All Others"; 61-63 ends as Minority Whip
    because the later rung overrides (kept as in the reference)."""
    return range_ladder(code, LEADERSHIP_LADDER, LEADERSHIP_START)


def leadership_flags(df: DataFrame, leadership: str = "leadership_position",
                     party_status: str | None = "partystatus") -> DataFrame:
    """One-hot flags."""
    lp = F.col(leadership)
    out = df
    for name, label in LEADERSHIP_FLAGS:
        out = out.withColumn(name, if_else3(lp == label, 1, 0))
    for name, labels in LEADERSHIP_SET_FLAGS:
        out = out.withColumn(name, if_else3(in_set(lp, labels), 1, 0))
    if party_status:
        out = out.withColumn("majority", if_else3(F.col(party_status) == MAJORITY_STATUS, 1, 0))
    return out


def group_flags(df: DataFrame, group: str = "committee", chair: str = "chair",
                prestige_groups: Iterable[str] = PRESTIGE_GROUPS,
                not_chair_of: Iterable[str] = NOT_CHAIR_OF) -> DataFrame:
    """Prestige flags and the group a member chairs."""
    g = F.col(group)
    prestige = if_else3(in_set(g, prestige_groups), 1, 0)
    out = df.withColumn("prestige", prestige)
    out = out.withColumn("prestige_chair",
                         if_else3((F.col("prestige") == 1) & (F.col(chair) == 1), 1, 0))
    cond = F.col(chair) == 1
    for name in not_chair_of:
        cond = cond & (g != name)
    return out.withColumn("chair_of", if_else3(cond, g, F.lit(CHAIR_OF_NONE)))


def classify_roles(df: DataFrame, code: str = "seniorstatus", group: str = "committee",
                   party_status: str | None = "partystatus") -> DataFrame:
    """Both ladders, the one-hot flags, prestige and ``chair_of``."""
    out = (df.withColumn("position", position_of(code))
             .withColumn("leadership_position", leadership_of(code)))
    out = leadership_flags(out, "leadership_position", party_status)
    return group_flags(out, group, "chair")


def spell_features(df: DataFrame, member: str = "icpsr", group: str = "committee",
                   assigned: str = "assigneddate", position: str = "position") -> DataFrame:
    """First assignment date and year per (member, group), the date of a
    chair assignment, and whether the member ever chaired that group."""
    out = df.withColumn("member_committee", paste(member, group))
    is_chair = F.col(position) == CHAIR_LABEL
    per = out.groupBy("member_committee").agg(
        F.min(assigned).alias("firstassigneddate"),
        F.max(F.coalesce(is_chair, F.lit(False))).alias("__chaired"))
    out = join_on(out, per, ["member_committee"], "left")
    out = out.withColumn("firstassigned", F.year("firstassigneddate"))
    out = out.withColumn("assignedchairdate", F.when(is_chair, F.col(assigned).cast("date")))
    return out.withColumn("chair_since_2007", F.col("__chaired")).drop("__chaired")
