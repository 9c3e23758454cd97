"""Linking text to vocabularies and dictionaries (K7/J15, K8/J10/W4,
J16/K17, K16/J9)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.semantics import if_else3, na_text, squish
from ..functions.text import pattern_of_terms, strip_collapsed_na
from .joins import exists_flag, join_on

# Characters of an anchor (a term takes the longest that fits into
# it), and of the windows in which a text's anchors are listed.
ANCHOR_LENGTHS = (1, 2, 4, 8)
WINDOW_CHARS = 4_096
VOCABULARY_EXCLUDED = ("0", "NA", "")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def vocabulary(df: DataFrame, set_col: str, sep: str = ";",
               excluded: Sequence[str] = VOCABULARY_EXCLUDED, out: str = "term") -> DataFrame:
    """Distinct squished terms of a set column, minus excluded values (A10)."""
    pieces = df.select(F.explode(F.split(F.col(set_col), sep, -1)).alias("__t"))
    v = pieces.select(squish("__t").alias(out)).distinct()
    return v.filter(F.col(out).isNotNull() & ~F.col(out).isin(list(excluded)))


def _substrings(c: Column, n: int) -> Column:
    """All substrings of ``n`` characters, one for each place they start at."""
    return F.regexp_extract_all(c, F.lit(f"(?s)(?=(.{{{n}}}))."), 1)


def _anchor_length(c: Column) -> Column:
    e = F.lit(ANCHOR_LENGTHS[0])
    for n in ANCHOR_LENGTHS[1:]:
        e = F.when(F.length(c) >= n, n).otherwise(e)
    return e


def term_anchors(vocab: DataFrame, term: str = "term") -> DataFrame:
    """(__term, __anchor): for each distinct term its rarest substring of anchor
    length, counted over the vocabulary (ties: binary order)."""
    t = vocab.select(F.col(term).alias("__term")).filter(F.length("__term") > 0).distinct()
    subs = F.coalesce(*[F.when(_anchor_length(F.col("__term")) == n, _substrings(F.col("__term"), n))
                        for n in ANCHOR_LENGTHS])
    parts = t.select("__term", F.explode(F.array_distinct(subs)).alias("__a"))
    common = parts.groupBy("__a").agg(F.count(F.lit(1)).alias("__n"))
    return parts.join(common, "__a").groupBy("__term").agg(
        F.min(F.struct("__n", "__a"))["__a"].alias("__anchor"))


def _anchor_patterns(anchors: DataFrame) -> Column:
    """For each anchor length the pattern of places where an anchor could
    start (NULL without anchors): at every character one that anchors have
    there.  A scalar of the plan, no larger than the alphabet."""
    def pattern(n: int) -> Column:
        sets = [F.collect_set(F.when(F.length("__anchor") == n, F.substring("__anchor", i + 1, 1))) for i in range(n)]
        one_of = [F.concat(F.lit("["), F.array_join(F.transform(
            x, lambda c: F.concat(F.lit(r"\x{"), F.hex(F.ascii(c)), F.lit("}"))), ""), F.lit("]")) for x in sets]
        return F.when(F.size(sets[0]) > 0, F.concat(F.lit("(?s)(?=("), *one_of, F.lit(")).")))

    return anchors.agg(F.array(*[pattern(n) for n in ANCHOR_LENGTHS])).scalar()


def _with_contained_terms(texts: DataFrame, text: str, vocab: DataFrame, term: str) -> DataFrame:
    """``texts`` plus ``__found``: the terms that a text contains anywhere, the
    longest first; NULL when there is none.

    A text that contains a term contains its anchor, so the distinct anchors
    of a text (listed window by window) meet the terms by an equi-join; only
    what meets is compared with the text.  Texts go by a 64-bit hash: two
    texts that shared one would only share terms to be compared."""
    anchors = term_anchors(vocab, term)
    patterns = _anchor_patterns(anchors)
    windows = F.regexp_extract_all(
        F.col(text), F.lit(f"(?s)(?=(.{{1,{WINDOW_CHARS + max(ANCHOR_LENGTHS) - 1}}})).{{1,{WINDOW_CHARS}}}"), 1)
    subs = F.concat(*[F.coalesce(F.regexp_extract_all(F.col("__w"), patterns[i], 1), F.array().cast("array<string>"))
                      for i in range(len(ANCHOR_LENGTHS))])
    key = F.when(F.col(text) != "", F.xxhash64(text))
    places = (texts.select(key.alias("__tk"), F.explode(windows).alias("__w"))
              .select("__tk", F.explode(F.array_distinct(subs)).alias("__anchor")))
    longest_first = F.sort_array(F.collect_set(F.struct((-F.length("__term")).alias("l"), F.col("__term").alias("t"))))
    met = places.join(anchors, "__anchor").groupBy("__tk").agg(longest_first.getField("t").alias("__met"))
    out = texts.withColumn("__tk", key).join(met, "__tk", "left").drop("__tk")
    found = F.filter("__met", lambda t: F.contains(F.col(text), t))
    return out.withColumn("__found", F.when(F.size(found) > 0, found)).drop("__met")


def extract_terms(texts: DataFrame, text: str, vocab: DataFrame, term: str = "term",
                  out: str = "matches") -> DataFrame:
    """All vocabulary terms found in ``text``, as an array column.

    Matching is leftmost-longest and non-overlapping (terms quoted, longest
    first: documented change Q7).  Terms that a text doesn't contain can't
    change its matches, so each text is matched with the alternation of the
    terms that it contains (:func:`..functions.text.pattern_of_terms`), which an
    anchor index finds for a vocabulary of any size; nothing of the vocabulary
    reaches the driver.  A NULL text gives NULL, an empty text or an empty
    vocabulary an empty array.
    """
    found = _with_contained_terms(texts, text, vocab, term).withColumn("__re", pattern_of_terms("__found"))
    none = F.when(F.col(text).isNotNull(), F.array().cast("array<string>"))
    return found.withColumn(out, F.when(F.col("__re").isNotNull(), F.regexp_extract_all(F.col(text), F.col("__re"), 0))
                            .otherwise(none)).drop("__found", "__re")


def vocabulary_crosswalk(texts: DataFrame, text: str, vocab: DataFrame, term: str = "term",
                         keep: Sequence[str] = (), out: str = "term",
                         keep_text: bool = True, dedupe: bool = True) -> DataFrame:
    """K7: (term, attributes, text) for every vocabulary term in each text,
    ``unnest`` + ``distinct``; texts without a hit drop out.  With
    ``keep_text=False`` the text itself is not carried along (use it when
    ``keep`` already identifies the text), and where rows can't repeat in the
    kept columns ``dedupe=False`` saves the shuffle of the ``distinct``."""
    m = extract_terms(texts, text, vocab, term, "__m")
    cols = [*keep, F.col(text)] if keep_text else list(keep)
    # a short term can match thousands of times in one long text, the
    # crosswalk needs it once
    hits = m.select(*cols, F.explode(F.array_distinct("__m")).alias(out))
    return hits.distinct() if dedupe else hits


def vocabulary_coverage(texts: DataFrame, text: str, vocab: DataFrame, term: str = "term",
                        out: str = "matched") -> DataFrame:
    """K7 coverage (F9): does each text contain any vocabulary term?  NULL for
    a NULL text."""
    m = _with_contained_terms(texts, text, vocab, term)
    return m.withColumn(out, F.when(F.col(text).isNotNull(), F.col("__found").isNotNull())).drop("__found")


def _grouped_by(df: DataFrame, keys: Sequence[str], person: str | None) -> tuple[DataFrame, list[str]]:
    """``df`` and its group keys; with ``person`` rows without an id (the first
    key) are grouped by that column."""
    if person is None:
        return df, list(keys)
    return df.withColumn("__person", F.when(F.col(keys[0]).isNull(), F.col(person))), [*keys, "__person"]


def _set_terms(df: DataFrame, keys: Sequence[str], set_col: str, order: Sequence[str], sep: str) -> DataFrame:
    """``keys``, ``__t`` (a term of the set, NULL for a NULL set) and its place ``__o``."""
    at = F.struct(*[F.col(c) for c in order])
    terms = df.select(*keys, at.alias("__r"), F.posexplode_outer(F.array_distinct(F.split(F.col(set_col), sep, -1))).alias("__p", "__t"))
    return terms.select(*keys, "__t", F.struct(F.col("__r").alias("r"), F.col("__p").alias("p")).alias("__o"))


def group_terms(df: DataFrame, keys: Sequence[str], set_col: str, order: Sequence[str],
                sep: str = ";|\\|", person: str | None = None) -> DataFrame:
    """K8's set alone: ``set_col`` becomes the unique terms of all rows of its
    group, by first appearance, with edge NAs and the first inner ``;NA;``
    removed.  Pooled rows without an id are many: terms are reduced to their
    first place map-side.  With ``person`` a group is a few rows, listed whole."""
    rows, by = _grouped_by(df, keys, person)
    if person is None:
        first = _set_terms(rows, by, set_col, order, sep).groupBy(*by, "__t").agg(F.min("__o").alias("__o"))
        listed = F.sort_array(F.collect_list(F.struct("__o", "__t"))).getField("__t")
        per = first.groupBy(*by).agg(F.when(~F.max(F.col("__t").isNull()), F.array_join(listed, ";")).alias("__set"))
    else:
        sets = rows.select(*by, F.struct(*[F.col(c) for c in order]).alias("__r"),
                           F.array_distinct(F.split(F.col(set_col), sep, -1)).alias("__ts"))
        per = sets.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("__r", "__ts"))).alias("__l"),
                                    F.collect_list(F.xxhash64("__r")).alias("__h"))
        got = F.col("__l")
        # terms of rows that (may) tie in order go by place, then in binary order; a NULL set makes all NULL
        placed = F.flatten(F.transform(got, lambda x: F.transform(
            x["__ts"], lambda t, i: F.struct(x["__r"].alias("r"), i.alias("p"), t.alias("t")))))
        tied = F.size(F.array_distinct("__h")) < F.size("__h")
        terms = F.when(tied, F.sort_array(placed)["t"]).otherwise(F.flatten(got["__ts"]))
        per = per.select(*by, F.array_join(F.array_distinct(terms), ";").alias("__set"))
    per = per.withColumn("__set", strip_collapsed_na("__set"))
    return join_on(rows, per, by, "left").withColumn(set_col, F.col("__set")).select(*df.columns)


def crosswalk_members(df: DataFrame, keys: Sequence[str], set_col: str, order: Sequence[str],
                      crosswalk: DataFrame, cw_term: str, cw_attr: str, term: str = "term",
                      attr: str = "attribute", sep: str = ";|\\|", person: str | None = None) -> DataFrame:
    """K8 in long form: per group its distinct (term, attribute) pairs, the
    number of times each is attached (``n``) and its first place (``first``:
    the row's ``order``, then the position in the set).

    Nothing is collected: a group of any size, such as all rows without an id
    in a period, is as many rows as it has pairs, combined map-side.
    :func:`crosswalk_lists` renders the lists where they are wanted."""
    rows, by = _grouped_by(df, keys, person)
    cw = crosswalk.select(F.col(cw_term).alias("__t2"), F.col(cw_attr).alias("__a")).groupBy("__t2", "__a").agg(
        F.count(F.lit(1)).alias("__k"))
    terms = _set_terms(rows, by, set_col, order, sep).groupBy(*by, "__t").agg(
        F.count(F.lit(1)).alias("__m"), F.min("__o").alias("__o"))
    hits = terms.join(cw, F.col("__t") == F.col("__t2"), "left")
    return hits.select(*by, F.col("__t").alias(term), F.col("__a").alias(attr),
                       (F.col("__m") * F.coalesce("__k", F.lit(1))).alias("n"),
                       F.struct(*[F.col("__o.r")[c].alias(c) for c in order], (F.col("__o.p") + 1).alias("position")).alias("first"))


def crosswalk_lists(df: DataFrame, keys: Sequence[str], set_col: str, order: Sequence[str],
                    crosswalk: DataFrame, cw_term: str, cw_attr: str, out_attr: str = "oversight",
                    sep: str = ";|\\|", person: str | None = None) -> DataFrame:
    """K8's lists, one row a group: ``keys`` (and ``__person``), ``set_col`` (the
    group's unique terms) and ``out_attr`` (all attached attributes, NULL
    printed as NA, duplicates kept), each with edge NAs and the first inner
    ``;NA;`` removed.  Term order is (row ``order``, position in the set);
    attributes of one term follow in binary order.  An attribute comes as often
    as the crosswalk holds it for the term (once a text)."""
    rows, by = _grouped_by(df, keys, person)
    # A group's rows meet before they become terms, and a term meets all of
    # its attributes as one list.
    near = rows.select(*[F.col(c) for c in dict.fromkeys([*by, *order, set_col])]).repartition(*by)
    terms = _set_terms(near, by, set_col, order, sep)
    cw = crosswalk.groupBy(F.col(cw_term).alias("__t2")).agg(F.sort_array(F.collect_list(na_text(cw_attr))).alias("__as"))
    hits = terms.join(cw, F.col("__t").eqNullSafe(F.col("__t2")), "left")
    # One sorted list per group: array_distinct of its terms keeps each
    # term's first appearance; its attributes are already in order.
    lst = F.sort_array(F.collect_list(F.struct(F.col("__o").alias("o"), F.col("__t").alias("t"),
                                               F.coalesce("__as", F.array(F.lit("NA"))).alias("a"))))
    row_hashes = F.collect_list(F.when(F.coalesce(F.col("__o.p"), F.lit(0)) == 0, F.xxhash64("__o.r")))
    per = hits.groupBy(*by).agg(lst.alias("__l"), row_hashes.alias("__h"),
                                F.max(F.col("__t").isNull().cast("int")).alias("__anynull"))
    got = F.col("__l")
    # Rows of one order can hold one term at one place; their attributes then
    # go in order together.  Only where two rows' order has the same hash.
    each = F.flatten(F.transform(got, lambda x: F.transform(
        x["a"], lambda a: F.struct(x["o"].alias("o"), x["t"].alias("t"), a.alias("a")))))
    tied = F.size(F.array_distinct("__h")) < F.size("__h")
    attached = F.when(tied, F.sort_array(each)["a"]).otherwise(F.flatten(got["a"]))
    texts = per.select(
        *by,
        F.when(F.col("__anynull") == 0, F.array_join(F.array_distinct(got["t"]), ";")).alias(set_col),
        F.array_join(attached, ";").alias(out_attr))
    return texts.select(*by, strip_collapsed_na(set_col).alias(set_col), strip_collapsed_na(out_attr).alias(out_attr))


def attach_by_crosswalk(df: DataFrame, keys: Sequence[str], set_col: str, order: Sequence[str],
                        crosswalk: DataFrame, cw_term: str, cw_attr: str,
                        out_attr: str = "oversight", sep: str = ";|\\|",
                        dedupe: bool = True, person: str | None = None) -> DataFrame:
    """K8 on rows: the lists of :func:`crosswalk_lists` attached to every row of
    their group.

    By default all rows without an id (the first key) are one group a period,
    as in the reference; its list is copied to each of them, so this output
    grows with the square of that group.  :func:`crosswalk_lists` keeps one row
    a group and :func:`crosswalk_members` one a pair; with ``person`` given,
    rows without an id group by that column instead.
    """
    rows, by = _grouped_by(df, keys, person)
    per = crosswalk_lists(df, keys, set_col, order, crosswalk, cw_term, cw_attr, out_attr, sep, person)
    res = join_on(rows, per.withColumnRenamed(set_col, "__set"), by, "left")
    res = res.withColumn(set_col, F.col("__set")).select(*df.columns, out_attr)
    # ``distinct`` as in the reference; ``dedupe=False`` when the rows of a
    # group differ in a column other than ``set_col`` by construction
    return res.distinct() if dedupe else res


# ---------------------------------------------------------------------------
# Dated alias dictionary
# ---------------------------------------------------------------------------
def normalize_alias(c) -> Column:
    """Lower case, anything but letters and digits -> space, squish."""
    return squish(F.regexp_replace(F.lower(_c(c)), r"[^\p{L}\p{N}]+", " "))


def _tokens(norm: Column) -> Column:
    return F.array_distinct(F.array_remove(F.split(norm, " "), ""))


def resolve_names(df: DataFrame, text: str, period: str, dictionary: DataFrame, alias: str = "alias",
                  dict_period: str = "period", dict_cols: Sequence[str] = ("id",)) -> DataFrame:
    """Free text -> ids through a dated alias dictionary (J16 re-aimed).

    Texts and aliases are normalised to tokens; an alias matches where its
    tokens follow one another in a text whose period it is valid in (a NULL
    dictionary period means any).  An alias is indexed by its rarest token, so
    a text's distinct tokens meet few aliases; those are then compared with
    the whole text.  Rows keep NULL ids when nothing matches and repeat when
    several ids match, like a left join.  Works for any dictionary size and
    alias length: no broadcast hint, no regex, nothing counted while planning.
    """
    d = dictionary.select(normalize_alias(alias).alias("__alias"), F.col(dict_period).alias("__dp"),
                          F.struct(*dict_cols).alias("__ids")).filter(F.col("__alias") != "")
    parts = d.select("__alias").distinct().select("__alias", F.explode(_tokens(F.col("__alias"))).alias("__t"))
    common = parts.groupBy("__t").agg(F.count(F.lit(1)).alias("__n"))
    rarest = parts.join(common, "__t").groupBy("__alias").agg(F.min(F.struct("__n", "__t"))["__t"].alias("__t"))
    index = d.join(rarest, "__alias")
    # texts go by a 64-bit hash; what is met is compared with the text itself
    rows = df.withColumn("__norm", normalize_alias(text)).withColumn(
        "__tk", F.when(F.col("__norm") != "", F.xxhash64("__norm")))
    tokens = rows.select("__tk", F.col(period).alias("__p"), F.explode(_tokens(F.col("__norm"))).alias("__t"))
    met = (tokens.join(index, "__t").filter(F.col("__dp").isNull() | (F.col("__dp") == F.col("__p")))
           .groupBy("__tk", "__p").agg(F.collect_set(F.struct("__alias", "__ids")).alias("__met")))
    rows = rows.withColumn("__p", F.col(period))
    rows = join_on(rows, met, ["__tk", "__p"], "left")
    pad = lambda c: F.concat(F.lit(" "), c, F.lit(" "))
    inside = F.filter("__met", lambda m: F.contains(pad(F.col("__norm")), pad(m["__alias"])))
    ids = F.array_distinct(F.transform(inside, lambda m: m["__ids"]))
    return rows.select(*[F.col(f"`{c}`") for c in df.columns], F.explode_outer(ids).alias("__id")).select(
        *[F.col(f"`{c}`") for c in df.columns], *[F.col("__id")[c].alias(c) for c in dict_cols])


def fill_missing_ids(df: DataFrame, id_col: str, resolved: DataFrame, keys: Sequence[str],
                     new_id: str, out: str, extra: Sequence[str] = ()) -> DataFrame:
    """Full join the resolved ids on ``keys`` and keep an existing id:
    ``out = coalesce(new_id, id_col)``.  ``extra`` columns of ``resolved`` come
    along."""
    fix = resolved.filter(F.col(new_id).isNotNull()).select(*keys, new_id, *extra).distinct()
    j = join_on(df, fix, list(keys), "full")
    return j.withColumn(out, F.coalesce(F.col(new_id), F.col(id_col)))


# ---------------------------------------------------------------------------
# Agency-acronym crosswalk
# ---------------------------------------------------------------------------
def agency_crosswalk(agencies: DataFrame, agency: str, crosswalk: DataFrame, cw_primary: str,
                     cw_fallback: str, cw_attr: str, out_key: str = "ACUS_agency") -> DataFrame:
    """The crosswalk key falls back to another name, becomes NULL when
    the agency table does not know it, and is left-joined (keys named
    differently, J9); several crosswalk rows per agency are kept."""
    cw = crosswalk.filter(F.col(cw_attr).isNotNull()).withColumn(
        out_key, F.coalesce(F.col(cw_primary), F.col(cw_fallback)))
    known = agencies.select(F.col(agency).alias(out_key))
    cw = exists_flag(cw, known, [out_key], "__known")
    cw = cw.withColumn(out_key, if_else3(F.col("__known"), F.col(out_key),
                                         F.lit(None).cast("string")))
    out = join_on(agencies, cw.select(out_key, cw_attr), [(agency, out_key)], "left")
    return out.drop(out_key) if out_key != agency else out
