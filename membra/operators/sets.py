"""Set-valued aggregations: ordered collapses, canonical sets, group counts.

The ordered forms (A5, A6, A8, W2) reproduce R's first-appearance order from
an explicit ordinal column, because a distributed table has no row order.
All of them dedupe *before* collecting, so one group only ever holds its
distinct values, never its raw rows, and the pre-aggregation is combined
map-side.  Group keys are compared with NULL = NULL (N5), which is what
``groupBy`` does already; join-backs use ``<=>``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.semantics import is_na_like, na_text, squish
from ..functions.text import SET_SEPARATORS
from .joins import join_on


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def join_back(df: DataFrame, agg: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Attach per-group results to every row of ``df`` (NULL keys match).

    The aggregate side holds one row per group.  No broadcast hint: AQE turns
    the join into a broadcast when the measured aggregate is small and splits
    skewed partitions otherwise.
    """
    return join_on(df, agg, list(keys), how)


def add_count(df: DataFrame, keys: Sequence[str], name: str = "n",
              method: str = "join") -> DataFrame:
    """dplyr ``add_count``: group size on every row.

    ``method="join"`` (default) counts with a map-side-combined aggregate and
    joins it back - safe for hot keys (AQE splits skewed join partitions) but
    the input is evaluated twice.  ``method="window"`` reads the input once;
    use it when groups are small by construction (e.g. one person-period)."""
    if method == "window":
        return df.withColumn(name, F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return join_back(df, counts, keys)


def add_group_min(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Grouped ``mutate(x = min(v, na.rm = TRUE))`` (W3); all-NULL -> NULL."""
    mins = df.groupBy(*keys).agg(F.min(value).alias(name))
    return join_back(df, mins, keys)


def _sorted_join(pairs: Column, sep: str) -> Column:
    """Join the ``v`` fields of (o, v) structs in ``o`` order.  ``sort_array``
    and a struct-field projection keep this free of lambda functions, so it
    stays in generated code."""
    return F.array_join(F.sort_array(pairs).getField("v"), sep)


def collapse_unique_multi(df: DataFrame, keys: Sequence[str], values: dict[str, Column],
                          order, sep: dict[str, str] | str = ";",
                          keep_na: bool = False) -> DataFrame:
    """Ordered-unique collapse of several value columns per group.

    ``keep_na=False`` is ``collapse_unique``: NULL, "NA" and "" are dropped and
    an empty group gives "".  ``keep_na=True`` is ``unique() |> paste(collapse)``:
    NULL is printed as "NA" and kept.  Values keep the order of their first
    appearance by ``order`` (ties: binary order of the value).  One
    :func:`group_sets` pass (two shuffles, whatever the number of columns).
    """
    seps = sep if isinstance(sep, dict) else {n: sep for n in values}
    mode = "unique_na" if keep_na else "unique"
    return group_sets(df, keys, {n: (v, mode, seps[n]) for n, v in values.items()}, order)


def collapse_unique(df: DataFrame, keys: Sequence[str], value, order, sep: str = ";",
                    out: str = "collapsed", keep_na: bool = False) -> DataFrame:
    """One-column form of :func:`collapse_unique_multi`."""
    return collapse_unique_multi(df, keys, {out: _c(value)}, order, sep, keep_na)


def collapse_all(df: DataFrame, keys: Sequence[str], value, order, sep: str = ";",
                 out: str = "collapsed") -> DataFrame:
    """``paste(x, collapse = sep)`` per group: duplicates kept, NULL -> "NA" (A8).

    Rows are joined in ``order``; this keeps every row by definition, so the
    group's list is as long as the group.
    """
    pairs = F.collect_list(F.struct(_c(order).alias("o"), na_text(value).alias("v")))
    return df.groupBy(*keys).agg(_sorted_join(pairs, sep).alias(out))


def normalize_set(df: DataFrame, keys: Sequence[str], value, out: str = "normalized",
                  sep: str = SET_SEPARATORS) -> DataFrame:
    """The canonical set of a group (A7): split on ``sep``, squish, drop
    NULL/""/"NA", dedupe, sort (binary), join with ";"; an empty set is NULL.

    ``collect_set`` dedupes in the map-side partial aggregate, so a group
    ships at most its distinct terms.
    """
    keys = list(keys)
    ex = df.select(*keys, F.explode_outer(F.split(_c(value), sep, -1)).alias("__t"))
    t = squish(F.col("__t"))
    terms = F.sort_array(F.collect_set(F.when(~is_na_like(t), t)))
    joined = F.array_join(terms, ";")
    return ex.groupBy(*keys).agg(F.when(F.size(terms) == 0, F.lit(None))
                                 .otherwise(joined).alias(out))


def normalize_set_string(c) -> Column:
    """Row-level canonical form of one set string (same rules as A7)."""
    parts = F.transform(F.split(_c(c), SET_SEPARATORS, -1), lambda t: squish(t))
    kept = F.array_sort(F.array_distinct(F.filter(parts, lambda t: ~is_na_like(t))))
    return F.when(F.size(kept) == 0, F.lit(None)).otherwise(F.array_join(kept, ";"))


def wide_lists(df: DataFrame, keys: Sequence[str], value, order, out: str = "member_groups",
               n_columns: int = 9, prefix: str | None = None, sep: str = "|") -> DataFrame:
    """Grouped ``paste(collapse = "|")`` on every row, then a split into a fixed
    number of columns, filled from the left, extras dropped (K14: W2 + X8)."""
    prefix = prefix or out.rstrip("s")
    lists = collapse_all(df, keys, value, order, sep=sep, out=out)
    res = join_back(df, lists, keys)
    parts = F.split(F.col(out), "[" + sep + "]", -1)
    return res.select("*", *[F.get(parts, i).alias(f"{prefix}{i + 1}") for i in range(n_columns)])


def member_period_rollup(df: DataFrame, member: str, period: str, values: dict[str, Column],
                         order, sep: dict[str, str] | str = ";", count_name: str = "n",
                         sort: bool = True) -> DataFrame:
    """Rows -> one row per (member, period) with ordered-unique sets, plus the
    number of periods of the member, most first (K4)."""
    rolled = collapse_unique_multi(df, [member, period], values, order, sep)
    rolled = add_count(rolled, [member], count_name)
    return rolled.orderBy(F.desc(count_name), member, period) if sort else rolled


# ---------------------------------------------------------------------------
# Aggregate expressions for groups that are already small (pre-aggregated)
# ---------------------------------------------------------------------------
def agg_normalized(value, canonical_inputs: bool = False) -> Column:
    """A7 as one aggregate expression over set strings of a small group:
    ``flatten(collect_list(split))`` -> squish -> drop NA-like -> distinct ->
    sort -> join; empty -> NULL.  With ``canonical_inputs`` (every input is
    already a canonical set or NULL) the squish/filter lambdas are skipped."""
    parts = F.flatten(F.collect_list(F.split(_c(value), SET_SEPARATORS, -1)))
    if canonical_inputs:
        kept = F.sort_array(F.array_distinct(parts))
        return F.when(F.size(kept) == 0, F.lit(None)).otherwise(F.array_join(kept, ";"))
    kept = F.sort_array(F.array_distinct(
        F.filter(F.transform(parts, lambda t: squish(t)), lambda t: ~is_na_like(t))))
    return F.when(F.size(kept) == 0, F.lit(None)).otherwise(F.array_join(kept, ";"))


def agg_paste(value, order, sep: str = ";") -> Column:
    """A8 as one aggregate expression: rows joined in ``order``, NULL -> "NA"."""
    return _sorted_join(F.collect_list(F.struct(_c(order).alias("o"),
                                                na_text(value).alias("v"))), sep)


def group_sets(df: DataFrame, keys: Sequence[str], specs: dict[str, tuple], order) -> DataFrame:
    """Several set columns per group from raw rows with one pre-aggregation.

    ``specs`` maps an output name to ``(value, mode[, sep])`` with mode
      * ``"unique"``    - A5: first-appearance order, NULL/"NA"/"" dropped, empty -> ""
      * ``"unique_na"`` - A6: first-appearance order, NULL printed as "NA"
      * ``"sorted"``    - A7: split on ``[;|]``, squish, drop NA-like, binary
                          order, empty -> NULL
    Rows are stacked as (group, column, value), reduced to ``min(order)`` per
    distinct triple (combined map-side), then collected per group: a group
    only ever holds its distinct values.  Only generators and plain
    expressions are used (no lambda functions), so every stage is codegen'd.
    """
    keys = list(keys)
    names = list(specs)
    modes = [specs[n][1] for n in names]
    for m in modes:
        if m not in ("unique", "unique_na", "sorted"):
            raise ValueError(f"unknown set mode {m!r}")
    arms = []
    for i, n in enumerate(names):
        v = _c(specs[n][0]).cast("string")
        if modes[i] == "unique_na":
            v = na_text(v)
        arms.append(F.struct(F.lit(i).alias("i"), v.alias("v")))
    step = df.select(*keys, _c(order).alias("__o"), F.explode(F.array(*arms)).alias("__s"))
    split_ids = [i for i, m in enumerate(modes) if m == "sorted"]
    i_col, v_col = F.col("__s.i"), F.col("__s.v")
    if split_ids:
        pieces = F.when(i_col.isin(split_ids),
                        F.coalesce(F.split(v_col, SET_SEPARATORS, -1),
                                   F.array(F.lit(None).cast("string"))))
        pieces = pieces.otherwise(F.array(v_col))
        step = step.select(*keys, "__o", i_col.alias("__i"), F.explode(pieces).alias("__raw"))
        v = F.when(F.col("__i").isin(split_ids), squish("__raw")).otherwise(F.col("__raw"))
        stacked = step.select(*keys, "__o", F.struct(F.col("__i").alias("i"), v.alias("v"))
                              .alias("__s"))
    else:
        stacked = step
    pre = (stacked.groupBy(*keys, F.col("__s.i").alias("__i"), F.col("__s.v").alias("__v"))
           .agg(F.min("__o").alias("__o")))
    aggs = []
    for i, n in enumerate(names):
        mode = specs[n][1]
        sep = specs[n][2] if len(specs[n]) > 2 else ";"
        mine = F.col("__i") == i
        if mode == "sorted":
            vals = F.sort_array(F.collect_list(F.when(mine & ~is_na_like("__v"), F.col("__v"))))
            aggs.append(F.when(F.size(vals) == 0, F.lit(None))
                        .otherwise(F.array_join(vals, sep)).alias(n))
        else:
            keep = mine if mode == "unique_na" else (mine & ~is_na_like("__v"))
            pairs = F.collect_list(F.when(keep, F.struct(F.col("__o").alias("o"),
                                                         F.col("__v").alias("v"))))
            aggs.append(_sorted_join(pairs, sep).alias(n))
    return pre.groupBy(*keys).agg(*aggs)


def group_row_sets(df: DataFrame, keys: Sequence[str], specs: dict[str, tuple], order) -> DataFrame:
    """:func:`group_sets`, same result, for values of few distinct combinations.

    A row stays one row (one per piece of its ``"sorted"`` values) instead of
    one per column: rows are reduced to ``min(order)`` per distinct combination
    of values (combined map-side), and a group holds its distinct combinations.
    Use it for values such as roles and titles beside a group name; where two
    columns of one group have many values each, :func:`group_sets` holds less.
    """
    keys, names = list(keys), list(specs)
    if any(specs[n][1] not in ("unique", "unique_na", "sorted") for n in names):
        raise ValueError(f"unknown set mode in {[specs[n][1] for n in names]}")
    split = [i for i, n in enumerate(names) if specs[n][1] == "sorted"]
    value = [_c(specs[n][0]).cast("string") for n in names]
    cols = [(F.split(v, SET_SEPARATORS, -1) if i in split else na_text(v) if specs[names[i]][1] == "unique_na" else v)
            .alias(f"__v{i}") for i, v in enumerate(value)]
    rows = df.select(*keys, _c(order).alias("__o"), *cols)
    if split:  # side by side: a row is as many rows as its longest list has pieces
        rows = rows.withColumn("__p", F.explode_outer(F.arrays_zip(
            *[F.coalesce(F.col(f"__v{i}"), F.array().cast("array<string>")).alias(f"__v{i}") for i in split])))
        rows = rows.withColumns({f"__v{i}": squish(F.col("__p")[f"__v{i}"]) for i in split}).drop("__p")
    vs = [f"__v{i}" for i in range(len(names))]
    pre = rows.groupBy(*keys, *vs).agg(F.min("__o").alias("__o"))
    aggs, out = [], []
    for i, n in enumerate(names):
        mode, sep = specs[n][1], specs[n][2] if len(specs[n]) > 2 else ";"
        v, got = F.col(vs[i]), F.col(f"__l{i}")
        if mode == "sorted":
            aggs.append(F.sort_array(F.collect_set(F.when(~is_na_like(v), v))).alias(f"__l{i}"))
            out.append(F.when(F.size(got) == 0, F.lit(None)).otherwise(F.array_join(got, sep)).alias(n))
            continue
        pair = F.struct(F.col("__o").alias("o"), v.alias("v"))
        aggs.append(F.sort_array(F.collect_list(pair if mode == "unique_na" else F.when(~is_na_like(v), pair))).alias(f"__l{i}"))
        # a value's place is its least order; it is NULL (first) only where all of its orders are
        placed = F.array_distinct(F.filter(got, lambda x: x["o"].isNotNull())["v"])
        unplaced = F.array_except(F.filter(got, lambda x: x["o"].isNull())["v"], placed)
        first = F.when(F.get(got, F.lit(0))["o"].isNull(), F.concat(unplaced, placed)).otherwise(F.array_distinct(got["v"]))
        out.append(F.array_join(first, sep).alias(n))
    return pre.groupBy(*keys).agg(*aggs).select(*keys, *out)
