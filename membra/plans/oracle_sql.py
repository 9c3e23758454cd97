"""DuckDB SQL for every driver query: an independent statement of the same
result, used as the correctness oracle.  Views ``lineitem``, ``orders``, ...
are registered by the caller.

DuckDB notes: ``regexp_replace`` replaces the first match unless given the
``'g'`` option; ``IS NOT DISTINCT FROM`` is R's NA = NA key match; ordered
collapses are ``string_agg(.. ORDER BY first_ordinal, value)``.
"""

from __future__ import annotations


def period_sql(ts: str) -> str:
    """Period number of a timestamp/date expression."""
    d = f"CAST({ts} AS DATE)"
    eff = (f"(CASE WHEN year({d}) % 2 = 1 AND {d} < make_date(year({d}), 1, 3) "
           f"THEN year({d}) - 1 ELSE year({d}) END)")
    return f"CAST(floor(({eff} - 1789) / 2) + 1 AS INTEGER)"


def squish_sql(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


POSITION_SQL = ("CASE WHEN s = 0 OR s >= 25 THEN 'Other' "
                "WHEN s BETWEEN 21 AND 23 THEN 'Ranking Minority' "
                "WHEN s BETWEEN 11 AND 16 THEN 'Chair' END")
TITLE_SQL = ("CASE WHEN s BETWEEN 1 AND 3 THEN 'Chair' WHEN s BETWEEN 4 AND 6 THEN 'Ranking Member' "
             "WHEN s = 7 THEN 'Vice Chair' WHEN s = 8 THEN 'Cochairman' WHEN s = 9 THEN 'Chairman' "
             "WHEN s BETWEEN 10 AND 12 THEN 'Member' END")

ASSIGNMENTS = f"""
assign AS (
  SELECT CASE WHEN o.o_orderpriority = '5-LOW' AND l.l_linenumber = 1 THEN NULL
              ELSE o.o_custkey END AS icpsr,
         {period_sql('o.o_orderdate')} AS congress,
         l.l_orderkey * 10 + l.l_linenumber AS ord,
         l.l_returnflag AS source,
         l.l_linestatus AS chamber,
         l.l_linestatus || lpad(CAST(o.o_custkey AS VARCHAR), 6, '0') AS bioguide,
         CASE WHEN p.p_size >= 46 THEN NULL ELSE upper(p.p_type) END AS committee,
         CAST(l.l_quantity AS INTEGER) AS s
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                  JOIN part p ON l.l_partkey = p.p_partkey
),
rows AS (SELECT *, {POSITION_SQL} AS position, {TITLE_SQL} AS title FROM assign)"""

RECONCILE = f"""
{ASSIGNMENTS},
a AS (SELECT * FROM rows WHERE source = 'R'),
b AS (SELECT * FROM rows WHERE source = 'A'),
a_roles AS (
  SELECT icpsr, congress, chamber, v, min(ord) AS o
  FROM (SELECT icpsr, congress, chamber, coalesce(position, 'NA') AS v, ord FROM a)
  GROUP BY icpsr, congress, chamber, v),
a_sub AS (
  SELECT icpsr, congress, chamber, string_agg(v, ';' ORDER BY o, v) AS positions
  FROM a_roles GROUP BY icpsr, congress, chamber),
a_terms AS (
  SELECT DISTINCT icpsr, congress, {squish_sql('t')} AS t
  FROM a, unnest(string_split_regex(committee, '[;|]')) AS u(t)),
a_sets AS (
  SELECT icpsr, congress, string_agg(t, ';' ORDER BY t) AS groups_a
  FROM a_terms WHERE t IS NOT NULL AND t <> '' AND t <> 'NA' GROUP BY icpsr, congress),
a_clean AS (
  SELECT k.icpsr, k.congress, s.groups_a,
         regexp_replace(regexp_replace(k.positions, ';Other|Other;|Other|;;', '', 'g'),
                        ';+', '', 'g') AS positions
  FROM (SELECT icpsr, congress, string_agg(positions, ';' ORDER BY chamber) AS positions
        FROM a_sub GROUP BY icpsr, congress) k
  LEFT JOIN a_sets s ON k.icpsr IS NOT DISTINCT FROM s.icpsr AND k.congress = s.congress),
b_titles AS (
  SELECT icpsr, congress, bioguide, title, min(ord) AS o FROM b
  WHERE title IS NOT NULL AND title <> '' AND title <> 'NA'
  GROUP BY icpsr, congress, bioguide, title),
b_terms AS (
  SELECT DISTINCT icpsr, congress, bioguide, {squish_sql('t')} AS t
  FROM b, unnest(string_split_regex(committee, '[;|]')) AS u(t)),
b_keys AS (SELECT DISTINCT icpsr, congress, bioguide FROM b),
b_clean AS (
  SELECT k.icpsr, k.congress, k.bioguide,
         (SELECT string_agg(t, ';' ORDER BY t) FROM b_terms x
           WHERE x.icpsr IS NOT DISTINCT FROM k.icpsr AND x.congress = k.congress
             AND x.bioguide = k.bioguide AND t IS NOT NULL AND t <> '' AND t <> 'NA')
           AS groups_b,
         coalesce((SELECT string_agg(title, ';' ORDER BY o, title) FROM b_titles y
           WHERE y.icpsr IS NOT DISTINCT FROM k.icpsr AND y.congress = k.congress
             AND y.bioguide = k.bioguide), '') AS titles
  FROM b_keys k),
reconciled AS (
  SELECT coalesce(a_clean.icpsr, b_clean.icpsr) AS icpsr,
         coalesce(a_clean.congress, b_clean.congress) AS congress,
         groups_a, positions, bioguide, groups_b, titles
  FROM a_clean FULL OUTER JOIN b_clean
    ON a_clean.icpsr IS NOT DISTINCT FROM b_clean.icpsr
   AND a_clean.congress IS NOT DISTINCT FROM b_clean.congress)"""

SQL: dict[str, str] = {}

SQL["two_source_reconcile"] = f"WITH {RECONCILE.strip()} SELECT * FROM reconciled"

SQL["discrepancy_report"] = (
    f"WITH {RECONCILE.strip()} SELECT * FROM reconciled "
    "WHERE groups_a <> groups_b ORDER BY icpsr, congress DESC")

SQL["role_flags"] = f"""WITH {RECONCILE.strip()},
filled AS (
  SELECT icpsr, congress, coalesce(groups_a, '') AS groups_a,
         coalesce(positions, '') AS positions, bioguide,
         coalesce(groups_b, '') AS groups_b,
         coalesce(titles, '') AS titles
  FROM reconciled),
flagged AS (
  SELECT *,
    CASE WHEN regexp_matches(titles, '^Chair|;Chair|;Chairman|;Cochairman')
           OR regexp_matches(positions, 'Chair') THEN 1 ELSE 0 END AS chair0,
    CASE WHEN regexp_matches(titles, 'Ranking Member')
           OR regexp_matches(positions, 'Ranking Minority') THEN 1 ELSE 0 END AS rank0,
    nullif({squish_sql("regexp_replace(groups_a || ';' || groups_b, '^;|;$', '')")}, '')
      AS member_groups
  FROM filled)
SELECT DISTINCT icpsr, congress, groups_a, positions, bioguide, groups_b,
       titles,
       CASE WHEN member_groups IS NULL THEN NULL ELSE chair0 END AS chair,
       CASE WHEN member_groups IS NULL THEN NULL ELSE rank0 END AS ranking_minority,
       member_groups
FROM flagged"""


def _nz(cond: str, val: str) -> str:
    return f"CASE WHEN {cond} THEN NULL ELSE {val} END"


P_ORDER = period_sql("o_orderdate")

SQL["period_from_date"] = f"""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date, {P_ORDER} AS congress FROM orders"""

SQL["period_year_lookup"] = f"""
WITH o AS (
  SELECT o_orderkey, {_nz("o_orderpriority = '5-LOW'", "o_custkey")} AS icpsr,
         {P_ORDER} AS congress FROM orders),
y AS (SELECT o.*, CASE WHEN congress BETWEEN 96 AND 115 THEN 1978 + 2 * (congress - 96) END
                  AS year_elected,
             CASE WHEN congress + 10 BETWEEN 96 AND 115 THEN 1978 + 2 * (congress + 10 - 96) END
                  AS year_elected_plus10
      FROM o)
SELECT o_orderkey, congress, CAST(year_elected AS INTEGER) AS year_elected,
       CAST(year_elected_plus10 AS INTEGER) AS year_elected_plus10,
       coalesce(CAST(icpsr AS VARCHAR), 'NA') || coalesce(CAST(year_elected AS VARCHAR), 'NA')
         AS icpsr_year
FROM y"""

SQL["snapshot_name_and_date"] = f"""
WITH n AS (
  SELECT event_id, 'committee-membership-' || strftime(CAST(ts AS DATE), '%Y-%m-%d') || '-'
           || substr(md5(CAST(event_id AS VARCHAR)), 1, 7) || '.yaml' AS file_name
  FROM events),
d AS (SELECT *, CAST(nullif(regexp_extract(file_name, '(\\d{{4}}-\\d{{2}}-\\d{{2}})', 1), '') AS DATE)
               AS snapshot_date FROM n)
SELECT event_id, file_name, snapshot_date, {period_sql('snapshot_date')} AS congress,
       list_extract(string_split('/landing/' || file_name, '/'), -1) AS base_name
FROM d"""

SQL["nested_map_explode"] = """
SELECT event_id, event_type AS thomas_id, 0 AS member_pos,
       CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
UNION ALL
SELECT event_id, event_type, 1, user_id FROM events
UNION ALL
SELECT event_id, 'all', 0, CAST(json_extract(props, '$.k') AS BIGINT) FROM events"""

SQL["union_missing_columns"] = """
SELECT c_custkey AS key, c_name AS name, c_nationkey AS nationkey, c_mktsegment AS segment,
       'customer' AS source, CAST(NULL AS DOUBLE) AS acctbal FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, NULL, 'supplier', s_acctbal FROM supplier"""

EVENT_MEMBERS = f"""
em AS (SELECT event_id, CAST(ts AS DATE) AS snapshot_date, {period_sql('ts')} AS congress,
              user_id, event_type FROM events)"""

SQL["snapshot_distinct_per_period"] = f"""
WITH {EVENT_MEMBERS.strip()} SELECT DISTINCT congress, user_id, event_type FROM em"""

SQL["duplicate_audit"] = f"""
WITH {EVENT_MEMBERS.strip()},
c AS (SELECT *, count(*) OVER (PARTITION BY user_id, event_type, snapshot_date) AS n FROM em)
SELECT event_id, user_id, event_type, snapshot_date, n FROM c WHERE n > 1"""

SQL["null_propagating_ifelse"] = """
WITH c AS (SELECT c_custkey, c_nationkey,
                  CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END AS seg
           FROM customer)
SELECT c_custkey, seg,
       CASE WHEN seg IS NULL THEN NULL WHEN seg = 'MACHINERY' THEN 1 ELSE 0 END AS machinery,
       CASE WHEN seg IS NULL THEN NULL WHEN seg = 'HOUSEHOLD' THEN DATE '2020-01-01'
            ELSE DATE '2019-01-01' END AS since,
       CASE WHEN seg IN ('FURNITURE', 'MACHINERY') THEN seg END AS seg_known,
       CASE WHEN seg IS NOT NULL THEN CASE WHEN c_nationkey < 10 THEN 1 ELSE 0 END END
         AS nation_gated
FROM c"""

ROLE_CODES = """
rc AS (SELECT CASE WHEN l_quantity = 50 THEN NULL
                   ELSE CAST(l_quantity AS INTEGER) + 10 * (l_linenumber - 1) END AS s,
              CASE WHEN l_returnflag = 'R' THEN 1 WHEN l_returnflag = 'A' THEN 2 END AS partystatus
       FROM lineitem)"""

SQL["range_ladder_position"] = f"""
WITH {ROLE_CODES.strip()}
SELECT s AS seniorstatus, {POSITION_SQL} AS position, count(*) AS n FROM rc GROUP BY ALL"""

LEADERSHIP_SQL = ("CASE WHEN s IS NULL THEN NULL WHEN s BETWEEN 61 AND 63 THEN 'Minority Whip' "
                  "WHEN s BETWEEN 51 AND 53 THEN 'Majority Whip' "
                  "WHEN s BETWEEN 41 AND 44 THEN 'Majority Leader' "
                  "WHEN s BETWEEN 31 AND 33 THEN 'Speaker' "
                  "WHEN s BETWEEN 20 AND 24 THEN 'Ranking Minority' "
                  "WHEN s BETWEEN 10 AND 17 THEN 'Chair' ELSE 'All Others' END")


def _flag(expr: str) -> str:
    return f"CASE WHEN lp IS NULL THEN NULL WHEN lp = {expr} THEN 1 ELSE 0 END"


SQL["range_ladder_leadership"] = f"""
WITH {ROLE_CODES.strip()},
l AS (SELECT s, partystatus, {LEADERSHIP_SQL} AS lp FROM rc)
SELECT s AS seniorstatus, partystatus, lp AS leadership_position,
       {_flag("'Chair'")} AS chair,
       {_flag("'Ranking Minority'")} AS ranking_minority,
       {_flag("'Majority Leader'")} AS majority_leader,
       {_flag("'Speaker'")} AS speaker,
       {_flag("'Minority Leader'")} AS minority_leader,
       {_flag("'Majority Whip'")} AS majority_whip,
       {_flag("'Minority Whip'")} AS minority_whip,
       CASE WHEN lp IN ('Majority Leader', 'Minority Leader') THEN 1 ELSE 0 END AS party_leader,
       CASE WHEN lp IN ('Majority Whip', 'Minority Whip') THEN 1 ELSE 0 END AS party_whip,
       CASE WHEN partystatus IS NULL THEN NULL WHEN partystatus = 1 THEN 1 ELSE 0 END AS majority,
       count(*) AS n
FROM l GROUP BY ALL"""

SQL["set_flags"] = """
WITH p AS (
  SELECT p_partkey, CASE WHEN p_brand = 'Brand#1' THEN NULL ELSE upper(p_type) END AS committee,
         CASE WHEN p_size BETWEEN 10 AND 17 THEN 1 ELSE 0 END AS chair FROM part),
f AS (SELECT *, CASE WHEN coalesce(committee IN ('PROMO', 'LARGE'), false) THEN 1 ELSE 0 END
                  AS prestige FROM p)
SELECT p_partkey, committee, chair, prestige,
       CASE WHEN prestige = 1 AND chair = 1 THEN 1 ELSE 0 END AS prestige_chair,
       CASE WHEN (chair = 1 AND committee <> 'SMALL' AND committee <> 'MEDIUM') IS NULL THEN NULL
            WHEN chair = 1 AND committee <> 'SMALL' AND committee <> 'MEDIUM' THEN committee
            ELSE 'None' END AS chair_of
FROM f"""

SQL["kleene_exclusion"] = """
WITH k AS (
  SELECT c_custkey, CASE WHEN c_nationkey = 0 THEN NULL ELSE c_custkey END AS icpsr,
         CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN NULL ELSE c_mktsegment END AS bioguide
  FROM customer)
SELECT * FROM k
WHERE NOT (icpsr = 1 AND bioguide = 'MACHINERY') AND NOT (icpsr = 2 AND bioguide = 'FURNITURE')
  AND NOT (icpsr = 5 AND bioguide = 'HOUSEHOLD') AND NOT (icpsr = 7 AND bioguide = 'BUILDING')
  AND NOT (icpsr = 11 AND bioguide = 'MACHINERY') AND NOT (icpsr = 13 AND bioguide = 'HOUSEHOLD')"""

SQL["left_join_dim_dropna"] = """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, d.committee
FROM lineitem l
LEFT JOIN (SELECT DISTINCT p_partkey, CASE WHEN p_size <= 40 THEN upper(p_type) END AS committee
           FROM part) d ON l.l_partkey = d.p_partkey
WHERE d.committee IS NOT NULL"""

SQL["null_safe_full_join"] = f"""
WITH m AS (
  SELECT CASE WHEN l_linestatus = 'O' AND l_linenumber = 1 THEN NULL ELSE l_suppkey END AS member,
         {period_sql('l_shipdate')} AS period, l_returnflag FROM lineitem),
a AS (SELECT member, period, count(*) AS n_a FROM m WHERE l_returnflag = 'R' GROUP BY ALL),
b AS (SELECT member, period, count(*) AS n_b FROM m WHERE l_returnflag = 'A' GROUP BY ALL)
SELECT coalesce(a.member, b.member) AS member, coalesce(a.period, b.period) AS period, n_a, n_b
FROM a FULL OUTER JOIN b ON a.member IS NOT DISTINCT FROM b.member
                        AND a.period IS NOT DISTINCT FROM b.period"""

AGENCY = """
agencies AS (SELECT s_suppkey, s_name AS Agency FROM supplier),
cw0 AS (
  SELECT replace(c_name, 'Customer#', 'Supplier#') AS agency,
         CASE WHEN c_mktsegment = 'BUILDING' THEN NULL
              ELSE 'Supplier#' || lpad(CAST(c_nationkey AS VARCHAR), 9, '0') END AS ACUS_agency,
         CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN NULL
              ELSE substr(c_mktsegment, 1, 3) || '-' || CAST(c_nationkey AS VARCHAR) END
           AS department_agency_acronym
  FROM customer),
cw AS (
  SELECT CASE WHEN coalesce(ACUS_agency, agency) IN (SELECT Agency FROM agencies)
              THEN coalesce(ACUS_agency, agency) END AS ACUS_agency, department_agency_acronym
  FROM cw0 WHERE department_agency_acronym IS NOT NULL),
joined AS (
  SELECT a.s_suppkey, a.Agency, cw.department_agency_acronym
  FROM agencies a LEFT JOIN cw ON a.Agency = cw.ACUS_agency)"""

SQL["renamed_key_left_join"] = f"WITH {AGENCY.strip()} SELECT * FROM joined"

SQL["head_n"] = f"""WITH {AGENCY.strip()}
SELECT Agency AS ACUS_agency, department_agency_acronym FROM joined
WHERE department_agency_acronym IS NULL ORDER BY Agency LIMIT 15"""

SQL["recode_rules"] = """
WITH rules(rule_id, ord, src_code, name, period, status, target, value, active) AS (VALUES
  (1, 1, 1, 'Supplier#000000001', NULL, NULL, 'icpsr', '2', true),
  (2, 2, 2, 'Supplier#000000002', NULL, NULL, 'icpsr', '3', true),
  (3, 3, 3, 'Supplier#000000003', NULL, NULL, 'icpsr', '30', true),
  (4, 4, 3, 'Supplier#000000003', NULL, NULL, 'icpsr', '31', true),
  (5, 5, 4, 'Supplier#000000004', 11, NULL, 'icpsr', '40', true),
  (6, 6, 5, 'Supplier#000000005', 99, NULL, 'icpsr', '50', true),
  (7, 7, 6, 'Supplier#000000006', NULL, 1, 'icpsr', '60', true),
  (8, 8, 6, 'Supplier#000000006', NULL, 1, 'party', '200', true),
  (9, 9, 7, 'Supplier#000000007', NULL, NULL, 'name', 'Renamed, Seven', true),
  (10, 10, 8, 'Supplier#000000008', NULL, NULL, 'icpsr', '80', false),
  (11, 11, 9, 'Wrong Name', NULL, NULL, 'icpsr', '90', true)),
s AS (SELECT s_suppkey, s_suppkey AS icpsr, s_name AS name, s_nationkey AS period,
             CASE WHEN s_acctbal > 0 THEN 1 ELSE 2 END AS status, s_nationkey AS party
      FROM supplier),
w AS (
  SELECT s.s_suppkey,
         arg_max(r.value, r.ord) FILTER (WHERE r.target = 'icpsr') AS new_icpsr,
         arg_max(r.value, r.ord) FILTER (WHERE r.target = 'party') AS new_party,
         arg_max(r.value, r.ord) FILTER (WHERE r.target = 'name') AS new_name
  FROM s JOIN rules r ON r.active AND r.src_code = s.s_suppkey AND r.name = s.name
                     AND (r.period IS NULL OR r.period = s.period)
                     AND (r.status IS NULL OR r.status = s.status)
  GROUP BY s.s_suppkey)
SELECT s.s_suppkey, coalesce(CAST(w.new_icpsr AS BIGINT), s.icpsr) AS icpsr,
       coalesce(w.new_name, s.name) AS name, s.period, s.status,
       coalesce(CAST(w.new_party AS INTEGER), s.party) AS party
FROM s LEFT JOIN w ON s.s_suppkey = w.s_suppkey"""

SQL["attribute_patches"] = f"""
WITH b AS (
  SELECT o_orderkey, o_custkey AS icpsr, {P_ORDER} AS congress, o_orderpriority AS commcode,
         CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS name,
         CASE WHEN substr(o_orderpriority, 1, 1) = '3' THEN NULL
              ELSE CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END AS seniorstatus,
         100 AS party, CAST(o_orderdate AS DATE) AS assigneddate,
         CAST(CAST(o_orderdate AS DATE) + INTERVAL 700 DAY AS DATE) AS terminationdate
  FROM orders),
p1 AS (SELECT * REPLACE (CASE WHEN congress = 105 AND commcode = '3-MEDIUM' THEN 21
                              ELSE seniorstatus END AS seniorstatus) FROM b),
p2 AS (SELECT * REPLACE (CASE WHEN congress = 104 AND commcode = '1-URGENT' THEN 0
                              ELSE seniorstatus END AS seniorstatus) FROM p1),
p3 AS (SELECT * REPLACE (CASE WHEN name IS NULL THEN NULL WHEN name = 'F' THEN 200
                              ELSE party END AS party) FROM p2),
p4 AS (SELECT * REPLACE (CASE WHEN name IS NULL THEN NULL WHEN name = 'O' THEN 100
                              ELSE party END AS party) FROM p3),
p5 AS (SELECT * REPLACE (CASE WHEN (name = 'O' AND assigneddate = DATE '1997-05-28') IS NULL
                              THEN NULL
                              WHEN name = 'O' AND assigneddate = DATE '1997-05-28' THEN 22
                              ELSE seniorstatus END AS seniorstatus) FROM p4),
p6 AS (SELECT * REPLACE (CASE WHEN (name = 'F' AND congress = 103 AND commcode = '2-HIGH') IS NULL
                              THEN NULL
                              WHEN name = 'F' AND congress = 103 AND commcode = '2-HIGH'
                              THEN DATE '2000-01-01' ELSE terminationdate END AS terminationdate)
       FROM p5),
p7 AS (SELECT * REPLACE (CASE WHEN (name = 'O' AND assigneddate >= DATE '2001-07-01') IS NULL
                              THEN NULL
                              WHEN name = 'O' AND assigneddate >= DATE '2001-07-01'
                              THEN DATE '1999-12-31' ELSE assigneddate END AS assigneddate)
       FROM p6),
p8 AS (SELECT * REPLACE (CASE WHEN (name = 'O' AND assigneddate = DATE '1999-12-31') IS NULL
                              THEN NULL
                              WHEN name = 'O' AND assigneddate = DATE '1999-12-31'
                              THEN DATE '2001-08-02' ELSE assigneddate END AS assigneddate)
       FROM p7)
SELECT o_orderkey, seniorstatus, party, assigneddate, terminationdate FROM p8"""

SQL["correction_overlay"] = f"""
WITH {ASSIGNMENTS.strip()},
b AS (SELECT * FROM rows WHERE source = 'A'),
terms AS (
  SELECT DISTINCT icpsr, congress, {squish_sql('t')} AS t
  FROM b, unnest(string_split_regex(committee, '[;|]')) AS u(t)),
keys AS (SELECT DISTINCT icpsr, congress FROM b),
base AS (
  SELECT k.icpsr, k.congress,
         (SELECT string_agg(t, ';' ORDER BY t) FROM terms x
           WHERE x.icpsr IS NOT DISTINCT FROM k.icpsr AND x.congress = k.congress
             AND t IS NOT NULL AND t <> '' AND t <> 'NA') AS groups_b
  FROM keys k),
corr AS (
  SELECT DISTINCT {P_ORDER} AS congress, o_custkey AS icpsr,
         'CORRECTED;' || o_orderpriority AS corrected_groups
  FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')
SELECT coalesce(base.icpsr, corr.icpsr) AS icpsr, coalesce(base.congress, corr.congress) AS congress,
       coalesce(base.groups_b, corr.corrected_groups) AS groups_b
FROM base FULL OUTER JOIN corr ON base.icpsr IS NOT DISTINCT FROM corr.icpsr
                              AND base.congress IS NOT DISTINCT FROM corr.congress"""

TURNS = """
turns AS (
  SELECT conv_id, turn, role, text,
         CASE WHEN length(text) > 200 THEN 'long' WHEN length(text) < 20 THEN NULL
              ELSE 'short' END AS kind
  FROM conversations)"""

SQL["member_period_rollup"] = f"""
WITH {TURNS.strip()},
keys AS (SELECT DISTINCT conv_id, role FROM turns),
words AS (
  SELECT conv_id, role, turn, unnest(string_split(text, ' ')) AS word,
         generate_subscripts(string_split(text, ' '), 1) AS pos FROM turns),
w0 AS (SELECT conv_id, role, regexp_replace(word, '[.,;:!?]', '', 'g') AS v,
              turn * 10000000 + pos AS p FROM words),
w AS (SELECT conv_id, role, v, min(p) AS o FROM w0
      WHERE v IS NOT NULL AND v <> '' AND v <> 'NA' GROUP BY ALL),
k AS (SELECT conv_id, role, kind AS v, min(turn) AS o FROM turns
      WHERE kind IS NOT NULL AND kind <> '' AND kind <> 'NA' GROUP BY ALL),
r AS (
  SELECT keys.conv_id, keys.role,
         coalesce((SELECT string_agg(v, ';' ORDER BY o, v) FROM w
                   WHERE w.conv_id = keys.conv_id AND w.role = keys.role), '') AS member_groups,
         coalesce((SELECT string_agg(v, ';' ORDER BY o, v) FROM k
                   WHERE k.conv_id = keys.conv_id AND k.role = keys.role), '') AS titles
  FROM keys)
SELECT r.*, count(*) OVER (PARTITION BY conv_id) AS n FROM r"""

SQL["collapse_keep_na"] = f"""
WITH {TURNS.strip()},
t AS (SELECT conv_id, turn, CASE WHEN role = 'system' THEN NULL ELSE role END AS role FROM turns),
u AS (SELECT conv_id, coalesce(role, 'NA') AS v, min(turn) AS o FROM t GROUP BY ALL)
SELECT conv_id,
       (SELECT string_agg(v, ';' ORDER BY o, v) FROM u WHERE u.conv_id = t.conv_id) AS roles_unique,
       string_agg(coalesce(role, 'NA'), ';' ORDER BY turn) AS roles_all
FROM t GROUP BY conv_id"""

SQL["normalized_sets"] = f"""
WITH j AS (
  SELECT l.l_suppkey, l.l_returnflag,
         CASE WHEN p.p_size < 5 THEN NULL
              ELSE upper(p.p_type) || ' | ' || replace(p.p_name, ' ', '  ') || ';NA;' END AS raw
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
terms AS (
  SELECT DISTINCT l_suppkey, l_returnflag, {squish_sql('t')} AS t
  FROM j, unnest(string_split_regex(raw, '[;|]')) AS u(t)),
keys AS (SELECT DISTINCT l_suppkey, l_returnflag FROM j)
SELECT keys.l_suppkey, keys.l_returnflag,
       (SELECT string_agg(t, ';' ORDER BY t) FROM terms x
         WHERE x.l_suppkey = keys.l_suppkey AND x.l_returnflag = keys.l_returnflag
           AND t IS NOT NULL AND t <> '' AND t <> 'NA') AS normalized
FROM keys"""

SQL["wide_lists"] = """
WITH l AS (SELECT conv_id, string_agg(coalesce(role, 'NA'), '|' ORDER BY turn) AS roles
           FROM conversations GROUP BY conv_id),
c AS (SELECT c.conv_id, c.turn, c.role, l.roles, string_split(l.roles, '|') AS parts
      FROM conversations c JOIN l ON c.conv_id = l.conv_id)
SELECT conv_id, turn, role, roles, parts[1] AS role1, parts[2] AS role2, parts[3] AS role3,
       parts[4] AS role4, parts[5] AS role5, parts[6] AS role6, parts[7] AS role7,
       parts[8] AS role8, parts[9] AS role9
FROM c"""

CANON_A = r".*ommittee on the |.*ommittee on | and.*|,.*|' Affairs| Affairs| Committee|Joint "


def upper_sql(x: str) -> str:
    # Java upper-cases the sharp s to "SS"; DuckDB keeps one letter.
    return f"upper(replace({x}, 'ß', 'SS'))"


SQL["canonical_names_a"] = f"""
WITH t AS (SELECT page_id, regexp_extract(html, '<title>(.*?)</title>', 1) AS title FROM pages)
SELECT page_id, title,
       {upper_sql("regexp_replace(title, '" + CANON_A.replace("'", "''") + "', '', 'g')")} AS canonical
FROM t"""

SQL["canonical_names_b"] = f"""
SELECT doc_id,
  regexp_replace(regexp_replace(regexp_replace(regexp_replace({upper_sql('text')},
    ' AND .*|, .*|\\(.*', '', 'g'), ' $', '', 'g'),
    'EVENTS SURROUNDING THE 2012 TERRORIST ATTACK ON |INVESTIGATE THE ', '', 'g'),
    '''| AFFAIRS', '', 'g') AS canonical
FROM documents"""

SQL["set_string_repair"] = """
WITH r AS (
  SELECT p_partkey,
         CASE WHEN p_brand = 'Brand#1' THEN NULL ELSE
           upper(p_type) || CASE WHEN p_size > 40 THEN 'TURAL RESOURCES' ELSE '' END || '|'
           || CASE WHEN p_size < 8 THEN 'NA' ELSE upper(p_name) END || ';NA'
           || CASE WHEN p_size BETWEEN 20 AND 25 THEN ';NA;NA;X' ELSE '' END END AS raw
  FROM part),
f AS (
  SELECT p_partkey, raw,
         coalesce(regexp_replace(regexp_replace(regexp_replace(regexp_replace(raw,
           '\\|', ';', 'g'), 'TURAL RESOURCES', ';NATURAL RESOURCES', 'g'), ';NA;', ';', 'g'),
           ';NA$|^NA;', '', 'g'), 'NA') AS repaired
  FROM r)
SELECT p_partkey, raw, repaired,
       regexp_replace(regexp_replace(repaired, '^NA;|;NA$|^NA$', '', 'g'), ';NA;', ';') AS stripped
FROM f"""

VOCAB = f"""
vocab AS (
  SELECT DISTINCT {squish_sql('w')} AS term
  FROM part, unnest(string_split(upper(p_name), ' ')) AS u(w)),
pat AS (SELECT string_agg('\\Q' || term || '\\E', '|' ORDER BY length(term) DESC, term) AS re
        FROM vocab WHERE term IS NOT NULL AND term NOT IN ('0', 'NA', '')),
docs AS (SELECT doc_id, source, {upper_sql('text')} AS text FROM documents)"""

SQL["vocabulary_crosswalk"] = f"""
WITH {VOCAB.strip()}
SELECT DISTINCT doc_id, source, unnest(regexp_extract_all(text, (SELECT re FROM pat))) AS term
FROM docs"""

SQL["vocabulary_coverage"] = f"""
WITH {VOCAB.strip()}
SELECT doc_id, len(regexp_extract_all(text, (SELECT re FROM pat))) > 0 AS matched FROM docs"""

COMBINED = f"""{RECONCILE.strip()},
filled AS (
  SELECT icpsr, congress, coalesce(groups_a, '') AS groups_a,
         coalesce(positions, '') AS positions, bioguide,
         coalesce(groups_b, '') AS groups_b,
         coalesce(titles, '') AS titles
  FROM reconciled),
flagged AS (
  SELECT *,
    CASE WHEN regexp_matches(titles, '^Chair|;Chair|;Chairman|;Cochairman')
           OR regexp_matches(positions, 'Chair') THEN 1 ELSE 0 END AS chair0,
    CASE WHEN regexp_matches(titles, 'Ranking Member')
           OR regexp_matches(positions, 'Ranking Minority') THEN 1 ELSE 0 END AS rank0,
    nullif({squish_sql("regexp_replace(groups_a || ';' || groups_b, '^;|;$', '')")}, '')
      AS groups0
  FROM filled),
combined AS (
  SELECT DISTINCT icpsr, congress, groups_a, positions, bioguide, groups_b,
       titles,
       CASE WHEN groups0 IS NULL THEN NULL ELSE chair0 END AS chair,
       CASE WHEN groups0 IS NULL THEN NULL ELSE rank0 END AS ranking_minority,
       coalesce(regexp_replace(regexp_replace(regexp_replace(regexp_replace(groups0,
           '\\|', ';', 'g'), 'TURAL RESOURCES', ';NATURAL RESOURCES', 'g'), ';NA;', ';', 'g'),
           ';NA$|^NA;', '', 'g'), 'NA') AS member_groups
  FROM flagged)"""


def _strip_na(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^NA;|;NA$|^NA$', '', 'g'), ';NA;', ';')"


OVERSIGHT = f"""{COMBINED},
cw AS (SELECT DISTINCT upper(p_type) AS cw_term, p_size % 2 AS cw_text,
              substr(p_type, 1, 3) || '-' || CAST(CAST(trunc(p_size / 10) AS INTEGER) AS VARCHAR)
                AS acronym
       FROM part),
parts0 AS (
  SELECT icpsr, congress, bioguide, CASE WHEN icpsr IS NULL THEN bioguide END AS person,
         unnest(string_split_regex(member_groups, ';|\\|')) AS term,
         unnest(generate_series(1, len(string_split_regex(member_groups, ';|\\|')))) AS pos
  FROM combined),
parts AS (SELECT icpsr, congress, bioguide, person, term, min(pos) AS pos FROM parts0 GROUP BY ALL),
hits AS (SELECT p.*, cw.acronym FROM parts p LEFT JOIN cw ON p.term = cw.cw_term),
first_t AS (
  SELECT * FROM (
    SELECT icpsr, congress, person, term, bioguide, pos,
           row_number() OVER (PARTITION BY icpsr, congress, person, term
                              ORDER BY bioguide NULLS FIRST, pos) AS rn
    FROM parts) WHERE rn = 1),
per AS (
  SELECT t.icpsr, t.congress, t.person,
         {_strip_na("string_agg(t.term, ';' ORDER BY t.bioguide NULLS FIRST, t.pos)")} AS groups_new,
         (SELECT {_strip_na("string_agg(coalesce(h.acronym, 'NA'), ';' ORDER BY h.bioguide NULLS FIRST, h.pos, coalesce(h.acronym, 'NA'))")}
          FROM hits h WHERE h.icpsr IS NOT DISTINCT FROM t.icpsr AND h.congress = t.congress
                            AND h.person IS NOT DISTINCT FROM t.person)
           AS oversight
  FROM first_t t GROUP BY t.icpsr, t.congress, t.person),
oversight AS (
  SELECT DISTINCT c.icpsr, c.congress, c.groups_a, c.positions, c.bioguide,
         c.groups_b, c.titles, c.chair, c.ranking_minority,
         per.groups_new AS member_groups, per.oversight
  FROM combined c LEFT JOIN per ON c.icpsr IS NOT DISTINCT FROM per.icpsr
                               AND c.congress IS NOT DISTINCT FROM per.congress
                               AND (CASE WHEN c.icpsr IS NULL THEN c.bioguide END)
                                   IS NOT DISTINCT FROM per.person)"""

SQL["attach_by_crosswalk"] = f"WITH {OVERSIGHT} SELECT * FROM oversight"

SPELLS = f"""
r AS (
  SELECT l_orderkey, l_linenumber, l_partkey AS icpsr, l_returnflag AS committee,
         CASE WHEN l_quantity = 50 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS assigneddate,
         CAST(l_quantity AS INTEGER) AS s
  FROM lineitem),
m AS (SELECT *, {POSITION_SQL} AS position,
             coalesce(CAST(icpsr AS VARCHAR), 'NA') || ' ' || coalesce(committee, 'NA')
               AS member_committee FROM r),
f AS (SELECT *, min(assigneddate) OVER (PARTITION BY member_committee) AS firstassigneddate
      FROM m),
chairs AS (SELECT DISTINCT member_committee FROM m WHERE position = 'Chair'),
spells AS (
  SELECT l_orderkey, l_linenumber, member_committee, firstassigneddate,
         CAST(year(firstassigneddate) AS INTEGER) AS firstassigned,
         CASE WHEN position = 'Chair' THEN assigneddate END AS assignedchairdate,
         member_committee IN (SELECT member_committee FROM chairs) AS chair_since_2007
  FROM f)"""

SQL["first_assignment"] = f"WITH {SPELLS.strip()} SELECT * FROM spells"
SQL["ever_chair"] = (f"WITH {SPELLS.strip()} SELECT DISTINCT member_committee, firstassigned, "
                     "chair_since_2007 FROM spells")

ROSTER = f"""
roster AS (
  SELECT DISTINCT c.c_mktsegment AS chamber, {period_sql('o.o_orderdate')} AS congress,
         c.c_name AS bioname, o.o_custkey AS icpsr, lower(n.n_name) AS state,
         CASE WHEN c.c_nationkey = 24 THEN 'USA' WHEN c.c_nationkey = 23 THEN NULL
              ELSE 'N' || CAST(c.c_nationkey AS VARCHAR) END AS state_abbrev,
         'F' || lpad(CAST(o.o_custkey AS VARCHAR), 6, '0') AS bioguide_id,
         c.c_acctbal < 0 AS no_id
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
                JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

GAPS = f"""{OVERSIGHT},
{ROSTER.strip()},
j AS (
  SELECT r.*, m.bioguide, m.positions, m.titles, m.member_groups
  FROM (SELECT * FROM roster WHERE congress > 102) r
  LEFT JOIN oversight m ON r.icpsr IS NOT DISTINCT FROM m.icpsr
                       AND r.congress IS NOT DISTINCT FROM m.congress),
gaps0 AS (SELECT * FROM j WHERE state_abbrev <> 'USA'
                             AND (member_groups IS NULL OR member_groups IN ('', ';'))),
missing AS (SELECT DISTINCT congress, bioguide_id FROM roster WHERE no_id),
gaps AS (SELECT g.*, EXISTS (SELECT 1 FROM missing x WHERE x.congress = g.congress
                                                   AND x.bioguide_id = g.bioguide_id)
                     AS icpsr_missing FROM gaps0 g)"""

SQL["gap_report"] = (f"WITH {GAPS} SELECT chamber, congress, bioname, icpsr, state, bioguide_id, "
                     "icpsr_missing FROM gaps WHERE NOT icpsr_missing")

SQL["gap_history"] = f"""WITH {GAPS}
SELECT r.chamber, r.congress, r.bioname, r.icpsr, r.state, r.bioguide_id, m.positions, m.titles,
       m.member_groups, m.groups_a, m.groups_b
FROM (SELECT * FROM roster WHERE congress > 102) r
LEFT JOIN oversight m ON r.icpsr IS NOT DISTINCT FROM m.icpsr
                     AND r.congress IS NOT DISTINCT FROM m.congress
WHERE r.icpsr IN (SELECT icpsr FROM gaps)
ORDER BY r.icpsr"""

SQL["identity_conflicts"] = f"""WITH {RECONCILE.strip()},
{ROSTER.strip()},
j AS (SELECT r.*, m.bioguide FROM roster r
      LEFT JOIN (SELECT icpsr, congress, bioguide FROM reconciled) m
        ON r.icpsr IS NOT DISTINCT FROM m.icpsr AND r.congress IS NOT DISTINCT FROM m.congress),
c AS (SELECT *, count(*) OVER (PARTITION BY bioname, icpsr, chamber, congress) AS n FROM j)
SELECT DISTINCT chamber, congress, bioname, icpsr, bioguide_id AS bioguide_correct,
       bioguide AS bioguide_incorrect
FROM c WHERE n > 1 AND bioguide_id <> bioguide"""

SQL["identity_counts"] = f"""WITH {RECONCILE.strip()}
SELECT icpsr, count(*) AS n FROM (SELECT DISTINCT icpsr, bioguide FROM reconciled)
GROUP BY icpsr ORDER BY n DESC, icpsr"""


def norm_alias_sql(x: str) -> str:
    return squish_sql(f"regexp_replace(lower({x}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')")


DICT = f"""
dict AS (
  SELECT {norm_alias_sql('c_name')} AS alias, CAST(NULL AS INTEGER) AS period, c_custkey AS id
  FROM customer
  UNION ALL
  SELECT {norm_alias_sql("'cust ' || CAST(c_custkey AS VARCHAR)")}, 104, c_custkey FROM customer),
maxn AS (SELECT max(len(string_split(alias, ' '))) AS n FROM dict)"""


def grams_sql(src: str, keys: str, text: str, period: str) -> str:
    return f"""
toks AS (SELECT {keys}, {period} AS p, string_split({norm_alias_sql(text)}, ' ') AS tk FROM {src}),
grams AS (
  SELECT {keys}, p, array_to_string(tk[i:i + n - 1], ' ') AS g
  FROM toks, generate_series(1, (SELECT n FROM maxn)) AS s(n),
       generate_series(1, len(tk) - n + 1) AS q(i)),
matches AS (
  SELECT DISTINCT {keys}, d.id FROM grams JOIN dict d
    ON grams.g = d.alias AND (d.period IS NULL OR d.period = grams.p)
  WHERE grams.g <> '')"""


SQL["name_resolution"] = f"""
WITH {DICT.strip()},
t AS (
  SELECT o_orderkey, {P_ORDER} AS congress,
         'Order ' || CAST(o_orderkey AS VARCHAR) || ' by '
         || CASE WHEN o_orderpriority = '2-HIGH' THEN 'CUST ' || CAST(o_custkey AS VARCHAR)
                 ELSE 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') END
         || ' (' || o_orderpriority || ')' AS text
  FROM orders),
{grams_sql('t', 'o_orderkey', 'text', 'congress').strip()}
SELECT t.o_orderkey, t.congress, t.text, m.id FROM t LEFT JOIN matches m
  ON t.o_orderkey = m.o_orderkey"""

PEOPLE = f"""
{DICT.strip()},
people AS (
  SELECT DISTINCT 'F' || lpad(CAST(c.c_custkey AS VARCHAR), 6, '0') AS bioguide,
         {period_sql('o.o_orderdate')} AS congress,
         CASE WHEN c.c_mktsegment = 'BUILDING' THEN NULL ELSE c.c_name END AS name,
         CASE WHEN c.c_acctbal < 0 THEN NULL ELSE c.c_custkey END AS icpsr_id,
         CASE WHEN c.c_mktsegment = 'MACHINERY' THEN NULL ELSE c.c_name END AS full_name,
         CASE WHEN c.c_nationkey < 5 THEN NULL ELSE c.c_name || ' (politician)' END
           AS wikipedia_id
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
patched AS (
  SELECT * REPLACE (CASE WHEN name IS NULL THEN NULL WHEN name = 'Customer#000000007'
                         THEN 41904 ELSE icpsr_id END AS icpsr_id) FROM people),
miss AS (
  SELECT *, coalesce(full_name, 'NA') || ' ' || coalesce(wikipedia_id, 'NA') AS lookup
  FROM patched WHERE icpsr_id IS NULL),
{grams_sql('miss', 'bioguide, congress', 'lookup', 'congress').strip()}"""

SQL["missing_id_fill"] = f"""
WITH {PEOPLE.strip()},
fixes AS (SELECT DISTINCT bioguide, congress, id AS icpsr FROM matches)
SELECT coalesce(p.bioguide, f.bioguide) AS bioguide, coalesce(p.congress, f.congress) AS congress,
       p.name, p.icpsr_id, coalesce(f.icpsr, p.icpsr_id) AS icpsr
FROM patched p FULL OUTER JOIN fixes f
  ON p.bioguide IS NOT DISTINCT FROM f.bioguide AND p.congress IS NOT DISTINCT FROM f.congress"""

SQL["unresolved_ids"] = f"""
WITH {PEOPLE.strip()}
SELECT DISTINCT congress, bioguide, full_name, wikipedia_id FROM miss
WHERE NOT EXISTS (SELECT 1 FROM matches m WHERE m.bioguide = miss.bioguide
                                            AND m.congress = miss.congress)"""

SQL["value_counts"] = """
SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL
ORDER BY n DESC, o_orderpriority, o_orderstatus"""

SQL["null_counts"] = f"""WITH {ASSIGNMENTS.strip()}
SELECT icpsr IS NULL AS is_na_icpsr, count(*) AS n FROM assign GROUP BY ALL"""

SNAP = """
snap AS (
  SELECT CAST(ts AS DATE) AS d, event_type, user_id, value,
         'committee-membership-' || strftime(CAST(ts AS DATE), '%Y-%m-%d') || '-'
           || substr(md5(CAST(CAST(ts AS DATE) AS VARCHAR)), 1, 7) || '.yaml' AS source_file
  FROM events)"""

SNAPSHOT_MEMBERS = f"""
WITH {SNAP.strip()}
SELECT DISTINCT {period_sql('d')} AS congress, 'User ' || CAST(user_id AS VARCHAR) AS name,
       'U' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS bioguide, event_type AS thomas_id,
       CASE WHEN value > 50 THEN 'Chair' END AS title, CAST(user_id AS BIGINT) AS icpsr,
       CASE WHEN value > 90 THEN CAST(1 AS BIGINT) END AS rank, CAST(NULL AS VARCHAR) AS value
FROM snap
UNION
SELECT {period_sql('d')}, NULL, NULL, event_type, NULL, NULL, NULL, 'just text'
FROM snap WHERE day(d) = 28"""

SQL["snapshot_members"] = SNAPSHOT_MEMBERS
SQL["snapshot_stream"] = SNAPSHOT_MEMBERS

SQL["quarantine_bad_files"] = f"""
WITH {SNAP.strip()}
SELECT DISTINCT source_file,
       CASE day(d) WHEN 7 THEN 'duplicate key' WHEN 14 THEN 'unparsable'
                   WHEN 21 THEN 'empty or not a mapping' END AS reason_kind
FROM snap WHERE day(d) IN (7, 14, 21)"""

SQL["quarantine_kept_versions"] = f"""
WITH {SNAP.strip()}
SELECT source_file, count(*) AS n FROM snap WHERE day(d) NOT IN (7, 14, 21) GROUP BY source_file"""

SQL["naive_merge_overlap"] = f"""WITH {RECONCILE.strip()},
a_c AS (
  SELECT icpsr, congress, chamber, v, min(ord) AS o
  FROM (SELECT icpsr, congress, chamber, coalesce(committee, 'NA') AS v, ord FROM a)
  GROUP BY ALL),
a_cs AS (SELECT icpsr, congress, chamber,
                replace(string_agg(v, ';' ORDER BY o, v), '|', ';') AS member_groups
         FROM a_c GROUP BY ALL),
naive AS (
  SELECT coalesce(x.icpsr, y.icpsr) AS icpsr, coalesce(x.congress, y.congress) AS congress,
         x.member_groups, y.bioguide, y.groups_b
  FROM a_cs x FULL OUTER JOIN b_clean y
    ON x.icpsr IS NOT DISTINCT FROM y.icpsr AND x.congress IS NOT DISTINCT FROM y.congress)
SELECT icpsr, bioguide, congress, member_groups, groups_b, count(*) AS n
FROM naive
WHERE member_groups IS NOT NULL AND groups_b IS NOT NULL
  AND member_groups <> groups_b
GROUP BY ALL"""

SQL["vocabulary_unmatched"] = f"""
WITH {VOCAB.strip()},
found AS (SELECT DISTINCT unnest(regexp_extract_all(text, (SELECT re FROM pat))) AS term FROM docs)
SELECT term FROM vocab
WHERE term IS NOT NULL AND term NOT IN ('0', 'NA', '') AND term NOT IN (SELECT term FROM found)"""
