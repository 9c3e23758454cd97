"""Two-source reconciliation, role flags, discrepancy and identity audits
(K5, K9, K10, K12)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.semantics import if_else3, replace_first, squish
from ..functions.text import clean_roles
from .joins import join_split_nulls
from .sets import add_count, agg_normalized, agg_paste, group_row_sets

# ---------------------------------------------------------------------------
# Fixed values (role text patterns of K9)
# ---------------------------------------------------------------------------
CHAIR_TITLE_PATTERN = "^Chair|;Chair|;Chairman|;Cochairman"
CHAIR_POSITION_PATTERN = "Chair"
RANKING_TITLE_PATTERN = "Ranking Member"
RANKING_POSITION_PATTERN = "Ranking Minority"
COMBINED_EDGE_SEPARATOR = "^;|;$"


def legacy_side(rows: DataFrame, member: str, period: str, sub: str, group, role, order,
                groups_out: str = "groups_a", roles_out: str = "positions") -> DataFrame:
    """Source A at the join grain (K5, first half).

    Per (member, period, sub): the ordered unique roles with NA kept (A6) and
    the canonical group set; per (member, period): the canonical union of the
    group sets (A7) and the roles of all subs joined in sub order (A8),
    then the role cleanup (X18).
    """
    per_sub = group_row_sets(rows, [member, period, sub],
                             {"__roles": (role, "unique_na"), "__groups": (group, "sorted")}, order)
    clean = per_sub.groupBy(member, period).agg(
        agg_normalized("__groups", canonical_inputs=True).alias(groups_out),
        agg_paste("__roles", sub).alias(roles_out))
    return clean.withColumn(roles_out, clean_roles(roles_out))


def roster_side(rows: DataFrame, member: str, period: str, person: str, group, title, order,
                groups_out: str = "groups_b", titles_out: str = "titles") -> DataFrame:
    """Source B at the join grain (K5, second half): per (member, period,
    person) the canonical group set (A7) and the ordered unique titles (A5)."""
    return group_row_sets(rows, [member, period, person],
                          {groups_out: (group, "sorted"), titles_out: (title, "unique")}, order)


def reconcile_rows(rows: DataFrame, source: str, a_value, b_value, member: str, period: str,
                   a_sub: str, b_person: str, group, a_role, b_title, order,
                   a_groups_out: str = "groups_a", roles_out: str = "positions",
                   b_groups_out: str = "groups_b", titles_out: str = "titles",
                   person_out: str = "bioguide") -> DataFrame:
    """K5 when both sources live in one row set (told apart by ``source``).

    The input is read once a side and once more for the keys of B's rows
    without an id.
    """
    src = F.col(source)
    a = legacy_side(rows.filter(src == F.lit(a_value)).withColumn("__sub", F.col(a_sub).cast("string")),
                    member, period, "__sub", group, a_role, order, a_groups_out, roles_out)
    b = roster_side(rows.filter(src == F.lit(b_value)).withColumn("__sub", F.col(b_person).cast("string")),
                    member, period, "__sub", group, b_title, order, b_groups_out, titles_out)
    return reconcile(a, b.withColumnRenamed("__sub", person_out), [member, period])


def reconcile(a_clean: DataFrame, b_clean: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full join of both sides on the join grain, NULL keys matching.

    Both inputs must already be at (or below) the key grain - that is the
    operator's contract, it is what keeps the join from fanning out.  The rows
    of B without an id, all persons of a period, are spread over tasks.
    """
    return join_split_nulls(a_clean, b_clean, list(keys), "full", spread="right")


def discrepancies(df: DataFrame, a: str, b: str, sort: Sequence = ()) -> DataFrame:
    """Rows where both sides are present and differ, sorted (K10: F4 + O2)."""
    out = df.filter(F.col(a) != F.col(b))
    return out.orderBy(*sort) if sort else out


def role_flags(df: DataFrame, titles: str = "titles", positions: str = "positions",
               a_set: str = "groups_a", b_set: str = "groups_b",
               out: str = "member_groups", dedupe: bool = True) -> DataFrame:
    """Role flags from role text and the union of both sources' sets (K9).

    Text columns are NULL-filled first (``replace_na``); the union is
    ``str_c(a, b, sep = ";")`` with the first edge separator removed, squished,
    "" -> NULL; flags are NULL when the union is NULL.  Duplicate rows go
    (``dedupe``); a caller whose rows are unique by construction - e.g. the
    output of :func:`reconcile`, one row per key and person - can skip that
    shuffle with ``dedupe=False``, since no column is dropped here.
    """
    filled = df
    for c in (titles, positions, a_set, b_set):
        filled = filled.withColumn(c, F.coalesce(F.col(c), F.lit("")))
    chair = if_else3(F.col(titles).rlike(CHAIR_TITLE_PATTERN)
                     | F.col(positions).rlike(CHAIR_POSITION_PATTERN), 1, 0)
    ranking = if_else3(F.col(titles).rlike(RANKING_TITLE_PATTERN)
                       | F.col(positions).rlike(RANKING_POSITION_PATTERN), 1, 0)
    union = squish(replace_first(F.concat(F.col(a_set), F.lit(";"), F.col(b_set)),
                                 COMBINED_EDGE_SEPARATOR))
    flagged = (filled.withColumn("chair", chair).withColumn("ranking_minority", ranking)
               .withColumn(out, union))
    flagged = flagged.withColumn(out, if_else3(F.col(out) == "", F.lit(None).cast("string"), F.col(out)))
    flagged = (flagged
               .withColumn("chair", if_else3(F.col(out).isNull(), F.lit(None), F.col("chair")))
               .withColumn("ranking_minority",
                           if_else3(F.col(out).isNull(), F.lit(None), F.col("ranking_minority"))))
    return flagged.distinct() if dedupe else flagged


def same_person_twice(df: DataFrame, person_keys: Sequence[str], id_a: str, id_b: str,
                      out_cols: dict[str, str] | None = None) -> DataFrame:
    """Identity conflict audit (K12, first form): a person-period that appears
    more than once, where the two ids disagree (NULL comparisons drop).
    A person-period holds a handful of rows, so the count is a window over
    the input (read once) rather than an aggregate joined back."""
    counted = add_count(df, list(person_keys), "n", method="window")
    hits = counted.filter((F.col("n") > 1) & (F.col(id_a) != F.col(id_b)))
    cols = out_cols or {c: c for c in list(person_keys) + [id_a, id_b]}
    return hits.select(*[F.col(src).alias(dst) for dst, src in cols.items()]).distinct()


def ids_per_key(df: DataFrame, key: str, other: str, name: str = "n") -> DataFrame:
    """``distinct(key, other) |> count(key, sort = TRUE)`` (K12, second form)."""
    return (df.select(key, other).distinct().groupBy(key)
            .agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), key))
