"""Rule tables applied to data: recodes, patches, overlays, exclusions
(K2, K3, K6, K18).

Rules are data (a DataFrame or a list), not code lines: one join applies
any number of recode rules, so the plan size does not grow with the rules.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.semantics import assign_where, if_else3
from .joins import join_on

RULE_SCHEMA = ("rule_id int, ord int, src_code bigint, name string, period int, "
               "status int, target string, value string, active boolean")


def recode(df: DataFrame, rules: DataFrame, key_cols: dict[str, str],
           targets: dict[str, str], optional_cols: dict[str, str] | None = None) -> DataFrame:
    """Keyed recode from a rule table.

    ``rules`` has ``ord``, ``target``, ``value``, ``active`` and the columns
    named by ``key_cols`` (rule column -> data column, exact match) and
    ``optional_cols`` (NULL in a rule = any value).  Every rule is tested on
    the *original* values, so rules apply simultaneously; when several rules
    hit one row and target, the highest ``ord`` wins (R's last assignment).
    A NULL data key never matches (R leaves the value unchanged, N7).

    Plan: the rules of a key become one row with an array; one lookup join
    brings it to the data's rows, and an expression picks each target's
    winner.  The data is neither deduplicated nor joined back, and the
    optimizer broadcasts the rules when their measured size allows.
    """
    optional_cols = optional_cols or {}
    r = rules.filter(F.coalesce(F.col("active"), F.lit(True)))
    per_key = r.groupBy(*[F.col(c).alias(f"__k_{c}") for c in key_cols]).agg(
        F.collect_list(F.struct("ord", "value", "target", *optional_cols)).alias("__rules"))
    cond = None
    for rc, dc in key_cols.items():
        e = df[dc] == per_key[f"__k_{rc}"]
        cond = e if cond is None else cond & e
    out = df.join(per_key, cond, "left")
    types = dict(df.dtypes)

    def winner(target: str) -> Column:
        def holds(x: Column) -> Column:
            c = x["target"] == target
            for rc, dc in optional_cols.items():
                c = c & (x[rc].isNull() | (F.col(dc) == x[rc]))
            return c
        return F.array_max(F.transform(F.filter("__rules", holds), lambda x: F.struct(x["ord"].alias("ord"), x["value"].alias("value"))))

    out = out.withColumns({f"__w_{t}": winner(t) for t in targets})
    out = out.withColumns({dcol: F.when(F.col(f"__w_{t}").isNotNull(), F.col(f"__w_{t}.value").cast(types[dcol]))
                           .otherwise(F.col(dcol)) for t, dcol in targets.items()})
    return out.select(*[F.col(f"`{c}`") for c in df.columns])


@dataclass
class Patch:
    """One conditional assignment.

    ``when`` maps a column to the value it must equal (all must hold).
    ``mode="subset"`` is ``x[cond] <- v`` (a NULL test leaves x unchanged);
    ``mode="ifelse"`` is ``mutate(x = ifelse(cond, v, x))`` (a NULL test
    makes x NULL).  ``extra`` is an optional additional Column condition.
    """
    target: str
    value: object
    when: dict = field(default_factory=dict)
    mode: str = "subset"
    extra: Column | None = None
    note: str = ""


def _patch_condition(p: Patch) -> Column:
    cond = None
    for c, v in p.when.items():
        e = F.col(c) == (v if isinstance(v, Column) else F.lit(v))
        cond = e if cond is None else cond & e
    if p.extra is not None:
        cond = p.extra if cond is None else cond & p.extra
    return cond


def apply_patches(df: DataFrame, patches: Sequence[Patch]) -> DataFrame:
    """Apply patches in sequence (K3): a later patch sees earlier results.

    Consecutive patches become nested ``CASE`` expressions in one projection
    (Catalyst collapses the projections), evaluated row-locally - no shuffle.
    """
    out = df
    types = dict(df.dtypes)
    for p in patches:
        cond = _patch_condition(p)
        value = p.value if isinstance(p.value, Column) else F.lit(p.value)
        value = value.cast(types[p.target])
        if p.mode == "subset":
            expr = assign_where(p.target, cond, value)
        elif p.mode == "ifelse":
            expr = if_else3(cond, value, F.col(p.target))
        else:
            raise ValueError(f"unknown patch mode {p.mode!r}")
        out = out.withColumn(p.target, expr.cast(types[p.target]))
    return out


def overlay(df: DataFrame, corrections: DataFrame, keys: Sequence[str], value: str,
            corr_value: str) -> DataFrame:
    """Correction overlay (K6): full join on ``keys`` (NULL = NULL), fill a
    missing ``value`` from the correction, add rows only the corrections have,
    never overwrite a present value."""
    c = corrections.select(*keys, F.col(corr_value).alias("__corr")).distinct()
    out = join_on(df, c, list(keys), "full")
    return out.withColumn(value, F.coalesce(F.col(value), F.col("__corr"))).drop("__corr")


def exclude_pairs(df: DataFrame, pairs, a: str, b: str, strict: bool = True) -> DataFrame:
    """Drop rows matching (a, b) pairs with R's ``filter(!(a == x & b == y))``
    (K18 / F3).

    ``strict=True`` keeps R's three-valued logic: a row is dropped when any
    pair test is TRUE *or NULL*, so (x, NULL), (NULL, y) and (NULL, NULL) go
    too (N2).  ``strict=False`` drops exact pair matches only.

    ``pairs`` is a list of (x, y) literals - one filter expression - or a
    DataFrame with columns ``x``, ``y`` (non-NULL), applied in one pass with
    equi-joins against the distinct pairs and the distinct values of each
    side, so it scales with any number of pairs.
    """
    A, B = F.col(a), F.col(b)
    if not isinstance(pairs, DataFrame):
        keep = None
        for x, y in pairs:
            t = ~((A == F.lit(x)) & (B == F.lit(y)))
            if not strict:
                t = F.coalesce(t, F.lit(True))
            keep = t if keep is None else keep & t
        return df if keep is None else df.filter(keep)
    # One pass: flag each row by equi-joins against the distinct pairs and the
    # distinct first / second values.
    px = pairs.select(F.col("x").alias("__x"), F.col("y").alias("__y")).distinct()
    tagged = df.join(px.withColumn("__hit_xy", F.lit(True)),
                     (A == F.col("__x")) & (B == F.col("__y")), "left").drop("__x", "__y")
    if not strict:
        return tagged.filter(F.col("__hit_xy").isNull()).drop("__hit_xy")
    xs = px.select(F.col("__x").alias("__xa")).distinct().withColumn("__hit_x", F.lit(True))
    ys = px.select(F.col("__y").alias("__ya")).distinct().withColumn("__hit_y", F.lit(True))
    # whether any pair exists is one bounded check (at most one row comes back)
    any_pair = F.lit(px.limit(1).count() > 0)
    tagged = (tagged.join(xs, A == F.col("__xa"), "left")
              .join(ys, B == F.col("__ya"), "left"))
    hit_xy, hit_x, hit_y = (F.col("__hit_xy").isNotNull(), F.col("__hit_x").isNotNull(),
                            F.col("__hit_y").isNotNull())
    # R drops a row when some pair test is TRUE or NULL: an exact pair; a NULL
    # first value with a listed second; a listed first with a NULL second; or
    # both NULL while any pair exists.
    drop = (hit_xy
            | (A.isNull() & B.isNotNull() & hit_y)
            | (A.isNotNull() & B.isNull() & hit_x)
            | (A.isNull() & B.isNull() & any_pair))
    return tagged.filter(~drop).drop("__hit_xy", "__xa", "__hit_x", "__ya", "__hit_y")
