"""The reference's workflow as Spark jobs on its own kinds of input.

Four entry points, each a lazy chain of library operators; stage outputs are
returned as a dict of DataFrames (write them with
``membra.sources.files.save_stage`` where the reference saves a stage).

* :func:`membership_history` - versioned roster snapshots -> long table,
  per-period facts, duplicate audit, quarantine (K1, S1-S4).
* :func:`members_groups` - group names, canonical names, member-period
  rollup, person metadata, missing-id fill (J1, X3, K4, J3, K17).
* :func:`legacy_assignments` - two legacy sheet exports -> one recoded,
  patched, classified assignment table (S6, U1, K2, K3, X4, K15, K14, K13).
* :func:`merge_sources` - reconcile both sources, overlay corrections,
  exclusions, flags, vocabulary crosswalk, attach, reports (K5-K12, K18).
* :func:`oversight_table` - agency acronym crosswalk (K16).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.periods import election_year_of
from ..functions.semantics import if_else3, paste, replace_all
from ..functions.text import canonical_name_a, canonical_name_b, clean_roles, repair_set_string
from ..operators import link as lk
from ..operators import reconcile as rc
from ..operators import reports as rp
from ..operators import rules as ru
from ..operators import sets as st
from ..operators.joins import join_on, left_join_dim_dropna
from ..operators.roles import classify_roles, spell_features
from ..rules import legacy as lg
from ..session import checkpoint, shared_dir
from ..sources import files as fl
from ..sources import snapshots as snap

# Member keys that always are columns; other keys of the snapshots follow.
SNAPSHOT_MEMBER_KEYS = ["name", "bioguide", "title", "icpsr", "party", "rank"]
LEGACY_COLUMNS = ["congress", "source_code", "name", "statenumber", "cd", "party",
                  "seniorstatus", "chamber", "commcode", "committeename", "assigneddate",
                  "terminationdate", "partystatus"]
LEGACY_NUMERIC = ["congress", "source_code", "cd", "party", "seniorstatus", "commcode", "icpsr",
                  "partystatus"]
LEGACY_FRONT = ["icpsr", "name", "congress", "chamber", "committee", "prestige",
                "prestige_chair", "leadership_position", "position", "chair_of", "seniorstatus",
                "assigneddate", "terminationdate"]
MIN_ROSTER_PERIOD = 102
EXCLUDED_STATE = "USA"


def membership_history(spark, snapshot_dir: str, partitioned: bool = False,
                       keys=None) -> dict[str, DataFrame]:
    """Entry 1a: every snapshot file -> one row per (file, group, member).

    The decoded files are checkpointed once (reliable checkpoint in the
    cluster's checkpoint folder), since both the members and the quarantine
    read them."""
    files = snap.list_snapshots(spark, snapshot_dir, partitioned=partitioned)
    decoded = checkpoint(snap.decode_snapshots(files))
    members = snap.member_rows(decoded, keys, always=tuple(SNAPSHOT_MEMBER_KEYS))
    ordk = F.struct("source_file", "group_pos", "member_pos")
    per_congress = (members.groupBy("congress", "name", "bioguide", "thomas_id", "title", "icpsr")
                    .agg(F.min(ordk).alias("ord")))
    return {
        "members": members,
        "quarantine": snap.quarantine(decoded),
        "icpsr_counts": rp.value_counts(members, ["icpsr"]),
        "per_congress": per_congress,
        "duplicates": rp.duplicate_audit(per_congress, ["bioguide", "name", "thomas_id",
                                                        "congress"]),
    }


def members_groups(per_congress: DataFrame, member_groups: DataFrame,
                       legislators_current: DataFrame, legislators_historical: DataFrame,
                       dictionary: DataFrame) -> dict[str, DataFrame]:
    """Entry 1b.  ``dictionary`` is the dated alias table (alias, period, icpsr,
    chamber) that replaces the external name matcher."""
    dim = member_groups.select("thomas_id", F.col("name").alias("committee"), "type")
    cm = left_join_dim_dropna(per_congress, dim, ["thomas_id"], "committee")
    c = cm.withColumn("committee", canonical_name_a("committee"))
    mc = st.member_period_rollup(
        c, "bioguide", "congress",
        {"name": F.col("name"), "member_groups": F.col("committee"), "titles": F.col("title")},
        "ord", sep={"name": "|", "member_groups": ";", "titles": ";"})
    legislators = legislators_current.unionByName(legislators_historical,
                                                  allowMissingColumns=True).distinct()
    mc = join_on(mc.withColumn("bioguide_id", F.col("bioguide")), legislators, ["bioguide_id"],
                 "left")
    name, new_id = lg.LITERAL_ID_PATCH
    mc = mc.withColumn("icpsr_id", if_else3(F.col("name") == name, F.lit(new_id),
                                            F.col("icpsr_id")))
    missing = mc.filter(F.col("icpsr_id").isNull()).withColumn(
        "lookup", paste("full_name", "wikipedia_id"))
    resolved = lk.resolve_names(missing, "lookup", "congress",
                                dictionary, "alias", "period", ["icpsr", "chamber"])
    fix = resolved.filter(F.col("icpsr").isNotNull()).select("icpsr", "bioguide", "congress",
                                                             "chamber")
    out = lk.fill_missing_ids(mc, "icpsr_id", fix, ["bioguide", "congress"], "icpsr", "icpsr",
                              extra=["chamber"])
    return {
        "members_groups": out,
        "unresolved": resolved.filter(F.col("icpsr").isNull()),
        "duplicates": rp.value_counts(out, ["name", "icpsr", "congress"]).filter(F.col("n") > 1),
        "missing_counts": rp.null_counts(out, "icpsr"),
    }


def legacy_assignments(spark, house: DataFrame, senate: DataFrame,
                       recode_rules: DataFrame | None = None,
                       order: str = "row_number") -> DataFrame:
    """Entry 2.  ``house`` / ``senate`` are exports of the two sheets with
    their columns in sheet order plus a ``row_number`` column (the sheet row,
    used wherever R relies on row order)."""
    house_rows = _rename_keep(house, fl.HOUSE_SHEET_NAMES, order)
    house_rows = house_rows.withColumn("chamber", F.lit("House")).select(*LEGACY_COLUMNS, order)
    senate_rows = _rename_keep(senate, fl.SENATE_SHEET_NAMES, order)
    senate_rows = (senate_rows.withColumn("cd", F.lit(0)).withColumn("chamber", F.lit("Senate"))
           .select(*LEGACY_COLUMNS, order))
    sheet_rows = house_rows.unionByName(senate_rows).withColumn("icpsr", F.col("source_code"))
    # as.numeric: "113.0" is 113, non-numbers become NULL.  Done before the
    # recode (the reference casts after it); a rule never matches a NULL code
    # either way.
    sheet_rows = sheet_rows.withColumns(
        {c: F.col(c).try_cast("double").try_cast("int") for c in LEGACY_NUMERIC})
    rules = recode_rules if recode_rules is not None else lg.id_recode_rules(spark)
    sheet_rows = ru.recode(sheet_rows, rules, {"src_code": "source_code", "name": "name"},
                     {"icpsr": "icpsr", "party": "party", "name": "name"},
                     {"period": "congress", "status": "partystatus"})
    sheet_rows = ru.apply_patches(sheet_rows, lg.seniority_subset_patches())
    sheet_rows = sheet_rows.withColumn("yearelected", election_year_of("congress"))
    sheet_rows = sheet_rows.withColumn("ICPSRYear", paste("icpsr", "yearelected", sep=""))
    sheet_rows = (sheet_rows.withColumn("assigneddate", F.col("assigneddate").try_cast("date"))
                .withColumn("terminationdate", F.col("terminationdate").try_cast("date")))
    sheet_rows = ru.apply_patches(sheet_rows, lg.party_patches())
    sheet_rows = sheet_rows.withColumn("committee", canonical_name_b("committeename"))
    sheet_rows = ru.apply_patches(sheet_rows, lg.seniority_date_patches() + lg.date_patches())
    sheet_rows = classify_roles(sheet_rows, "seniorstatus", "committee", "partystatus")
    sheet_rows = st.wide_lists(sheet_rows, ["icpsr", "ICPSRYear"], "committee", order, out="member_groups",
                         n_columns=9, prefix="committee")
    sheet_rows = sheet_rows.withColumn("committeename", F.upper("committeename"))
    sheet_rows = spell_features(sheet_rows, "icpsr", "committee", "assigneddate", "position")
    sheet_rows = sheet_rows.filter(F.col("congress").isNotNull())
    rest = [c for c in sheet_rows.columns if c not in LEGACY_FRONT]
    return sheet_rows.select(*LEGACY_FRONT, *rest)


def _rename_keep(df: DataFrame, names, keep: str) -> DataFrame:
    body = [c for c in df.columns if c != keep]
    if len(body) != len(names):
        raise ValueError(f"{len(body)} sheet columns, {len(names)} names")
    return df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(body, names)], keep)


def corrections_for_overlay(corrections: DataFrame, strict: bool = True) -> DataFrame:
    """The correction table as the overlay reads it.  ``strict`` keeps the
    reference: the set text is used as written, "0" (= none) included (Q18).
    ``strict=False`` turns "0" into NULL and canonicalises the set, so padded
    entries such as "TRANSPORTATION " match the crosswalk later (Q19)."""
    corr = corrections.select("congress", "icpsr",
                              F.col("member_groups").alias("corrected_groups"))
    if strict:
        return corr
    c = F.col("corrected_groups")
    return corr.withColumn("corrected_groups",
                           st.normalize_set_string(F.when(c != "0", c)))


def merge_sources(legacy: DataFrame, members: DataFrame, corrections: DataFrame,
                  oversight_data: DataFrame, roster: DataFrame, missing_ids: DataFrame,
                  order: str = "row_number", strict: bool = True,
                  stages: fl.Stages | None = None) -> dict[str, DataFrame]:
    """Entry 3: both sources -> combined member-period table and reports.
    Tables that several outputs use are stages, computed once; with ``stages``
    given, a later run over the same inputs resumes from them.
    ``strict=False`` applies the documented fixes of the correction overlay
    (see :func:`corrections_for_overlay`) and attaches agencies to rows without
    an id per person instead of pooling them (Q5)."""
    stages = stages or fl.Stages(legacy.sparkSession, shared_dir(legacy.sparkSession, "merge"))
    sw = st.group_sets(legacy, ["icpsr", "congress", "chamber"],
                       {"member_groups": ("member_groups", "unique_na"),
                        "positions": ("position", "unique_na")}, order)
    sw = sw.withColumn("member_groups", replace_all("member_groups", r"\|", ";"))
    sw_clean = sw.groupBy("icpsr", "congress").agg(
        st.agg_normalized("member_groups").alias("groups_a"),
        st.agg_paste("positions", "chamber").alias("positions"))
    sw_clean = sw_clean.withColumn("positions", clean_roles("positions"))
    us = members.select("icpsr", "bioguide", "congress", "titles",
                        F.col("member_groups").alias("groups_b")).distinct()
    us_clean = us.groupBy("icpsr", "congress", "bioguide").agg(
        st.agg_normalized("groups_b").alias("groups_b"),
        st.agg_paste("titles", "titles").alias("titles"))
    merged = rc.reconcile(sw_clean, us_clean, ["icpsr", "congress"])
    corr = corrections_for_overlay(corrections, strict)
    merged = ru.overlay(merged, corr, ["icpsr", "congress"], "groups_b",
                        "corrected_groups")
    merged = ru.exclude_pairs(merged, lg.EXCLUDED_ID_PAIRS, "icpsr", "bioguide")
    combined = merged
    merged = stages.stage("combined", lambda: combined)
    discrepancies = rc.discrepancies(merged, "groups_a", "groups_b",
                                     [F.col("icpsr"), F.desc("congress")])
    flagged = rc.role_flags(merged)
    repaired = flagged.withColumn("member_groups", repair_set_string("member_groups"))
    flagged = stages.stage("flagged", lambda: repaired)
    vocab = lk.vocabulary(flagged, "member_groups")
    agencies = (oversight_data.select(F.col("Reporting Committees").alias("member_groups"),
                                "department_agency_acronym")
          .filter(F.col("member_groups").isNotNull())
          .withColumn("member_groups", F.upper("member_groups")))
    crosswalk = lk.vocabulary_crosswalk(
        agencies.withColumnRenamed("member_groups", "reporting_text"), "reporting_text", vocab, "term",
        keep=["department_agency_acronym"], out="member_groups")
    coverage = lk.vocabulary_coverage(
        lk.vocabulary(oversight_data.filter(F.col("Reporting Committees").isNotNull()),
                      "Reporting Committees", excluded=()).select(F.upper("term").alias("ACUS_reporting_committee")),
        "ACUS_reporting_committee", vocab, "term", "in_combined_committee_membership_data")
    oversight = lk.attach_by_crosswalk(flagged, ["icpsr", "congress"], "member_groups", ["bioguide"],
                                       crosswalk, "member_groups", "department_agency_acronym",
                                       person=None if strict else "bioguide")
    oversight = ru.exclude_pairs(oversight, lg.EXCLUDED_ID_PAIRS, "icpsr", "bioguide")
    attached = oversight
    oversight = stages.stage("oversight", lambda: attached)
    joined = stages.stage("members", lambda: rp.roster_with_sets(
        roster, oversight, ["icpsr", "congress"], "congress", MIN_ROSTER_PERIOD).distinct())
    is_gap = rp.gap_condition("member_groups", "state_abbrev", EXCLUDED_STATE)
    missing = rp.gap_report(joined, is_gap, missing_ids.select(
        "congress", F.col("bioguide").alias("bioguide_id")), ["congress", "bioguide_id"])
    conflicts = rc.same_person_twice(
        joined, ["bioname", "icpsr", "chamber", "congress"], "bioguide_id", "bioguide",
        {"chamber": "chamber", "congress": "congress", "bioname": "bioname", "icpsr": "icpsr",
         "bioguide_correct": "bioguide_id", "bioguide_incorrect": "bioguide"})
    history_cols = ["chamber", "congress", "bioname", "icpsr", "state", "bioguide_id",
                    "positions", "titles", "member_groups", *rp.columns_starting_with(joined, "groups_")]
    history = rp.gap_history(joined, rp.gap_ids(joined, is_gap, "icpsr"), "icpsr", [F.col("icpsr")]).select(*history_cols)
    return {
        "combined": merged,
        "discrepancies": discrepancies,
        "flagged": flagged,
        "vocabulary": vocab,
        "crosswalk": crosswalk,
        "coverage": coverage,
        "oversight": oversight,
        "members": joined,
        "identity_conflicts": conflicts,
        "ids_per_icpsr": rc.ids_per_key(merged, "icpsr", "bioguide"),
        "ids_per_bioguide": rc.ids_per_key(merged, "bioguide", "icpsr"),
        "missing": missing,
        "missing_groups": missing.filter(~F.col("icpsr_missing")).select(
            "chamber", "congress", "bioname", "icpsr", "state", "bioguide_id", "icpsr_missing"),
        "missing_with_nonmissing": history,
    }


def oversight_table(agencies: DataFrame, crosswalk: DataFrame) -> dict[str, DataFrame]:
    """Entry 4 (K16): agencies with their acronyms, and the first 15 without."""
    d = agencies.filter(F.col("Agency").isNotNull())
    cw = crosswalk.filter(F.col("department_agency_acronym").isNotNull())
    out = lk.agency_crosswalk(d, "Agency", cw, "ACUS_agency", "agency",
                              "department_agency_acronym")
    unmatched = out.filter(F.col("department_agency_acronym").isNull()).select(
        F.col("Agency").alias("ACUS_agency"), "department_agency_acronym")
    return {"oversight_committee_data": out,
            "unmatched": rp.head_n(unmatched, [F.col("ACUS_agency")], 15)}
