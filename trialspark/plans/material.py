"""Material and tester resolution on the driver tables.

A cross is a row of ``part``; its columns are written once as expressions that
both engines read the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialspark.operators import keyed, lookup
from trialspark.operators import material as M
from trialspark.plans.registry import Tables, plan
from trialspark.session import cut_lineage

_CROSS = {
    "be_bid": "concat('E', CAST(p_partkey AS STRING))",
    "fp_be_bid": "concat('F', CAST(p_partkey % 97 AS STRING))",
    "mp_be_bid": "concat('M', CAST(p_size % 41 AS STRING))",
    "family": "CASE WHEN p_size % 5 = 0 THEN 'blue' WHEN p_size % 7 = 0 THEN 'B' END",
    "pedigree": "CASE WHEN p_partkey % 23 = 0 THEN '(A/B)/C' WHEN p_partkey % 29 = 0 THEN 'A/(B/C)' WHEN p_partkey % 31 = 0 THEN 'A ver/B' ELSE 'A/B' END",
    "cpi": "CASE WHEN p_partkey % 13 = 0 THEN 1 ELSE 0 END",
    "create_year": "1990 + p_size % 20",
    "create_year_max": "1990 + p_size % 20 + CASE WHEN p_partkey % 17 = 0 THEN 4 ELSE 1 END",
    "region_lid": "CASE WHEN p_size % 11 = 0 THEN '' ELSE concat('R', CAST(p_size % 3 AS STRING)) END",
    "cgenes": "CASE WHEN p_partkey % 19 = 0 THEN 'xMIR162y' WHEN p_partkey % 3 = 0 THEN 'none' END",
    "fp_linecode": "CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_brand END",
    "mp_linecode": "CASE WHEN p_partkey % 11 = 0 THEN '' ELSE p_type END",
    "fp_abbr_code": "CASE WHEN p_partkey % 37 = 0 THEN 'X)Y' ELSE p_name END",
    "mp_abbr_code": "CASE WHEN p_partkey % 41 = 0 THEN 'X)Y' ELSE p_type END",
    "fp_chassis_year": "1975 + p_partkey % 35",
    "mp_chassis_year": "1970 + p_partkey % 33",
    "fp_line_create_year": "CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE 1980 + p_partkey % 24 END",
    "mp_line_create_year": "CASE WHEN p_partkey % 8 = 0 THEN NULL ELSE 1980 + p_partkey % 26 END",
    "fp_create_year": "1985 + p_partkey % 21",
    "mp_create_year": "1985 + p_partkey % 22",
    "fp_region_lid": "CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE concat('R', CAST(p_partkey % 4 AS STRING)) END",
    "mp_region_lid": "CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE concat('R', CAST(p_partkey % 5 AS STRING)) END",
    "fp_het_group": "CASE p_partkey % 4 WHEN 0 THEN 'ss' WHEN 1 THEN 'nss' END",
    "mp_het_group": "CASE p_size % 4 WHEN 0 THEN 'ss' WHEN 1 THEN 'nss' END",
    "fp_family": "CASE WHEN p_partkey % 3 = 0 THEN 'long' ELSE 'x' END",
    "mp_family": "CASE WHEN p_size % 3 = 0 THEN 'long' ELSE 'x' END",
    "fp_precd": "CASE WHEN p_partkey % 5 = 0 THEN 'a_b' WHEN p_partkey % 6 = 1 THEN 'Ver1' ELSE 'ab' END",
    "mp_precd": "CASE WHEN p_partkey % 4 = 0 THEN 'a_b' ELSE 'ab' END",
    "fp_base_pool": "CASE p_partkey % 3 WHEN 0 THEN 'pool1' WHEN 1 THEN 'pool2' END",
    "mp_base_pool": "CASE p_size % 3 WHEN 0 THEN 'pool2' WHEN 1 THEN 'pool1' ELSE '' END",
    "fp_base_pool_rank": "p_partkey % 5",
    "mp_base_pool_rank": "p_size % 5",
}
_CROSS_SQL = "crosses AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in _CROSS.items()) + " FROM part)"


def _crosses(t: Tables) -> DataFrame:
    return t.part.selectExpr(*[f"{e} AS {n}" for n, e in _CROSS.items()])


def _kn(x: str) -> str:
    return f"({x} IS NOT NULL AND {x} <> '')"


def _bl(x: str) -> str:
    return f"({x} IS NULL OR {x} = '')"


def _tester_ladder() -> list[tuple[str, int, str]]:
    """(role, number, condition) triples in order, for the SQL twin."""
    rev = "reverse(pedigree)"
    out = [
        ("M", 1, f"strpos({rev}, '/') < strpos({rev}, ')') AND strpos({rev}, '/') > 0 AND {_kn('mp_linecode')}"),
        ("F", 2, f"strpos({rev}, '/') > strpos({rev}, '(') AND strpos({rev}, '(') > 0 AND {_kn('fp_linecode')}"),
    ]

    def pair(ids: tuple[int, int], text: str, first: str = "M") -> None:
        for role, number in zip(first + ("F" if first == "M" else "M"), ids):
            a, b = ("mp_", "fp_") if role == "M" else ("fp_", "mp_")
            out.append((role, number, text.replace("own.", a).replace("other.", b)))

    line = "(own.linecode IS NOT NULL AND own.linecode <> '')"
    pair((3, 4), f"(other.linecode IS NULL OR other.linecode = '') AND {line}")
    pair((5, 6), "strpos(other.abbr_code, ')') > 0 AND NOT strpos(own.abbr_code, ')') > 0")
    pair((7, 8), "other.chassis_year > create_year_max - 3 AND other.region_lid <> region_lid AND region_lid <> ''")
    pair((9, 10), "other.chassis_year >= create_year_max AND own.chassis_year < create_year_max")
    out.append(("", 11, "create_year_max - create_year > 3"))
    out.append(("", 12, "cpi = 1"))
    pair((13, 14), "least(own.chassis_year, own.line_create_year) < least(other.chassis_year, other.line_create_year) AND "
         f"(own.region_lid = region_lid OR own.region_lid = other.region_lid OR own.region_lid IS NULL OR own.region_lid = '') AND {line}")
    out.append(("", 15, "fp_het_group = mp_het_group AND fp_het_group <> ''"))
    pair((16, 17), f"length(other.family) > 2 AND length(own.family) < 3 AND {line}")
    pair((18, 19), f"length(family) > 2 AND strpos(other.abbr_code, family) > 0 AND {line}")
    pair((22, 23), f"own.line_create_year IS NOT NULL AND other.line_create_year IS NULL AND {line}")
    pair((24, 25), f"other.region_lid <> region_lid AND other.region_lid <> '' AND own.region_lid = region_lid AND {line}")
    pair((30, 31), "NOT strpos(other.precd, '_') > 0 AND strpos(own.precd, '_') > 0 AND own.line_create_year = other.line_create_year")
    pair((26, 27), f"create_year <= other.create_year + 1 AND NOT create_year <= own.create_year + 1 AND {line}", "F")
    pair((28, 29), "create_year <= other.line_create_year AND create_year > own.line_create_year + 2 AND own.region_lid = region_lid", "F")
    pair((32, 33), f"strpos(lower(pedigree), 'ver') > 0 AND strpos(lower(other.precd), 'ver') > 0 AND {line}")
    pair((34, 35), "own.chassis_year = other.chassis_year AND own.line_create_year < other.line_create_year")
    return out


_ROLE_SQL = f"""WITH {_CROSS_SQL},
roles AS (SELECT *, CASE {" ".join(f"WHEN {c} THEN '{r}'" for r, _, c in _tester_ladder())} END AS tester_role,
  CASE {" ".join(f"WHEN {c} THEN {n}" for _, n, c in _tester_ladder())} ELSE 0 END AS rule FROM crosses)"""


@plan("M13", _ROLE_SQL + """
SELECT be_bid, tester_role, rule, CASE WHEN cgenes LIKE '%MIR162%' THEN 1 ELSE 0 END AS insect_cgenes FROM roles""")
def tester_rule_cascade(t: Tables) -> DataFrame:
    out = M.tester_roles(_crosses(t)).withColumn("insect_cgenes", M.carries_any(F.col("cgenes"), M.INSECT_EVENTS))
    return out.select("be_bid", "tester_role", "rule", "insect_cgenes")


_RATIO_SQL = _ROLE_SQL + """,
f AS (SELECT fp_be_bid AS be_bid, count(*) FILTER (tester_role = 'F') AS y, count(*) FILTER (tester_role = 'M') AS n, count(*) AS c FROM roles WHERE fp_linecode <> '' AND (rule > 6 OR rule = 0) GROUP BY 1),
m AS (SELECT mp_be_bid AS be_bid, count(*) FILTER (tester_role = 'M') AS y, count(*) FILTER (tester_role = 'F') AS n, count(*) AS c FROM roles WHERE mp_linecode <> '' AND (rule > 6 OR rule = 0) GROUP BY 1),
j AS (SELECT coalesce(f.be_bid, m.be_bid) AS be_bid, f.c AS fp_count, m.c AS mp_count, coalesce(f.c, 0) + coalesce(m.c, 0) AS count, (coalesce(f.y, 0) + coalesce(m.y, 0)) / (coalesce(f.c, 0) + coalesce(m.c, 0)) AS tester_ratio,
  (coalesce(f.n, 0) + coalesce(m.n, 0)) / (coalesce(f.c, 0) + coalesce(m.c, 0)) AS not_tester_ratio, f.y / f.c AS fp_tester_ratio, f.n / f.c AS fp_not_tester_ratio, m.y / m.c AS mp_tester_ratio, m.n / m.c AS mp_not_tester_ratio
  FROM f FULL JOIN m ON f.be_bid = m.be_bid),
ratios AS (SELECT *, CASE WHEN tester_ratio >= not_tester_ratio + 0.4 THEN 1 WHEN not_tester_ratio >= tester_ratio + 0.3 THEN 0 END AS make_tester,
  CASE WHEN fp_tester_ratio >= fp_not_tester_ratio + 0.4 THEN 1 WHEN fp_not_tester_ratio >= fp_tester_ratio + 0.3 THEN 0 END AS fp_make_tester,
  CASE WHEN mp_tester_ratio >= mp_not_tester_ratio + 0.4 THEN 1 WHEN mp_not_tester_ratio >= mp_tester_ratio + 0.3 THEN 0 END AS mp_make_tester FROM j)"""


@plan("M14 J3", _RATIO_SQL + " SELECT * FROM ratios")
def tester_ratios(t: Tables) -> DataFrame:
    return M.tester_ratios(_roles(t))


_REFINED_SQL = _RATIO_SQL + """,
p AS (SELECT r.* EXCLUDE (tester_role), r.tester_role AS role1, coalesce(a.fp_tester_ratio, a.tester_ratio) AS fy, coalesce(a.fp_not_tester_ratio, a.not_tester_ratio) AS fn,
  CASE WHEN a.fp_tester_ratio IS NOT NULL THEN a.fp_make_tester ELSE a.make_tester END AS fm, coalesce(b.mp_tester_ratio, b.tester_ratio) AS my, coalesce(b.mp_not_tester_ratio, b.not_tester_ratio) AS mn,
  CASE WHEN b.mp_tester_ratio IS NOT NULL THEN b.mp_make_tester ELSE b.make_tester END AS mm FROM roles r LEFT JOIN ratios a ON a.be_bid = r.fp_be_bid LEFT JOIN ratios b ON b.be_bid = r.mp_be_bid),
q AS (SELECT *, CASE WHEN fm = 1 AND fp_linecode IS NOT NULL AND mm = 0 THEN 1 WHEN mm = 1 AND mp_linecode IS NOT NULL AND fm = 0 THEN 2
  WHEN fm = 1 AND fp_linecode IS NOT NULL AND (mm <> 1 OR mm IS NULL OR rule IN (12, 13)) AND (role1 IS NULL OR role1 = '') THEN 3
  WHEN mm = 1 AND mp_linecode IS NOT NULL AND (fm <> 1 OR fm IS NULL OR rule IN (12, 13)) AND (role1 IS NULL OR role1 = '') THEN 4
  WHEN mm = 0 AND fn < fy - 0.1 AND fm IS NULL THEN 5 WHEN fm = 0 AND mn < my - 0.1 AND mm IS NULL THEN 6
  WHEN cpi = 1 AND fp_line_create_year < mp_line_create_year AND (role1 IS NULL OR role1 = '') THEN 7 WHEN cpi = 1 AND mp_line_create_year < fp_line_create_year AND (role1 IS NULL OR role1 = '') THEN 8
  WHEN fy > my AND (role1 IS NULL OR role1 = '') THEN 9 WHEN my > fy AND (role1 IS NULL OR role1 = '') THEN 10 ELSE 0 END AS rule2 FROM p),
refined AS (SELECT *, CASE WHEN rule2 = 0 THEN role1 WHEN rule2 % 2 = 1 THEN 'F' ELSE 'M' END AS tester_role FROM q),
pools AS (SELECT *, CASE WHEN fp_base_pool = 'pool1' AND (mp_base_pool = 'pool2' OR mp_base_pool IS NULL OR mp_base_pool = '') THEN 'pool1' WHEN fp_base_pool = 'pool2' AND (mp_base_pool = 'pool1' OR mp_base_pool IS NULL OR mp_base_pool = '') THEN 'pool2'
  WHEN mp_base_pool = 'pool1' AND (fp_base_pool = 'pool2' OR fp_base_pool IS NULL) THEN 'pool2' WHEN mp_base_pool = 'pool2' AND (fp_base_pool = 'pool1' OR fp_base_pool IS NULL) THEN 'pool1'
  WHEN fp_base_pool = mp_base_pool THEN CASE WHEN tester_role = 'M' THEN fp_base_pool WHEN tester_role = 'F' THEN CASE fp_base_pool WHEN 'pool1' THEN 'pool2' ELSE 'pool1' END
    WHEN fp_base_pool_rank < mp_base_pool_rank THEN fp_base_pool WHEN fp_base_pool_rank > mp_base_pool_rank THEN CASE fp_base_pool WHEN 'pool1' THEN 'pool2' ELSE 'pool1' END END END AS fp_het_pool FROM refined),
assigned AS (SELECT *, CASE fp_het_pool WHEN 'pool1' THEN 'pool2' WHEN 'pool2' THEN 'pool1' END AS mp_het_pool FROM pools)"""


def _roles(t: Tables) -> DataFrame:
    """Tester roles, written once: the share and the refining step both read them."""
    return cut_lineage(M.tester_roles(_crosses(t)))


def _assigned(t: Tables) -> DataFrame:
    roles = _roles(t)
    return M.assign_pools(M.refine_testers(roles, M.tester_ratios(roles)))


@plan("M15", _REFINED_SQL + " SELECT be_bid, tester_role, rule, rule2, fp_het_pool, mp_het_pool FROM assigned")
def refined_testers_and_pools(t: Tables) -> DataFrame:
    return _assigned(t).select("be_bid", "tester_role", "rule", "rule2", "fp_het_pool", "mp_het_pool")


_VOTES_SQL = """,
r AS (SELECT fp_be_bid AS be_bid, fp_het_pool AS pool, fp_het_group AS het FROM assigned UNION ALL SELECT mp_be_bid, mp_het_pool, mp_het_group FROM assigned),
votes AS (SELECT be_bid, count(*) FILTER (pool = 'pool1') AS pool1_vote, count(*) FILTER (pool = 'pool2') AS pool2_vote, count(*) FILTER (pool IS NULL) AS poolnull_vote, count(*) FILTER (het = 'ss') AS ss_vote,
  count(*) FILTER (het = 'nss') AS nss_vote, count(*) FILTER (het IS NULL) AS hetgrpnull_vote FROM r GROUP BY be_bid)"""


@plan("M16 A2", _REFINED_SQL + _VOTES_SQL + " SELECT * FROM votes")
def pool_votes(t: Tables) -> DataFrame:
    return M.pool_votes(_assigned(t))


@plan("M16", _REFINED_SQL + _VOTES_SQL + """,
x AS (SELECT a.*, f.pool1_vote AS f1, f.pool2_vote AS f2, m.pool1_vote AS m1, m.pool2_vote AS m2 FROM assigned a LEFT JOIN votes f ON f.be_bid = a.fp_be_bid LEFT JOIN votes m ON m.be_bid = a.mp_be_bid),
y AS (SELECT *, CASE WHEN f1 > f2 * 3 AND m1 <= m2 * 3 THEN 'pool1' WHEN f2 > f1 * 3 AND m2 <= m1 * 3 THEN 'pool2' WHEN f1 <= f2 * 3 AND m1 > m2 * 3 THEN 'pool2' WHEN f2 <= f1 * 3 AND m2 > m1 * 3 THEN 'pool1' END AS v FROM x),
z AS (SELECT *, CASE v WHEN 'pool1' THEN 'pool2' WHEN 'pool2' THEN 'pool1' END AS w FROM y)
SELECT be_bid, coalesce(fp_het_pool, v) AS fp_het_pool, coalesce(mp_het_pool, w) AS mp_het_pool,
  CASE WHEN fp_het_pool = 'pool1' THEN fp_be_bid WHEN mp_het_pool = 'pool1' THEN mp_be_bid WHEN v = 'pool1' THEN fp_be_bid WHEN w = 'pool1' THEN mp_be_bid END AS par_hp1_be_bid,
  CASE WHEN mp_het_pool = 'pool2' THEN mp_be_bid WHEN fp_het_pool = 'pool2' THEN fp_be_bid WHEN v = 'pool2' THEN fp_be_bid WHEN w = 'pool2' THEN mp_be_bid END AS par_hp2_be_bid FROM z""")
def final_pools(t: Tables) -> DataFrame:
    a = cut_lineage(_assigned(t))
    return M.final_pools(a, M.pool_votes(a)).select("be_bid", "fp_het_pool", "mp_het_pool", "par_hp1_be_bid", "par_hp2_be_bid")


@plan("M17", f"""WITH {_CROSS_SQL}
SELECT be_bid, CASE WHEN fp_base_pool <> 'pool2' THEN coalesce(fp_linecode, region_lid) WHEN mp_base_pool = 'pool1' THEN coalesce(mp_linecode, pedigree) ELSE region_lid END AS par_hp1_linecode,
  CASE WHEN fp_base_pool = 'pool2' THEN coalesce(fp_linecode, region_lid) WHEN mp_base_pool <> 'pool1' THEN coalesce(mp_linecode, pedigree) ELSE pedigree END AS par_hp2_linecode FROM crosses""")
def parents_by_pool(t: Tables) -> DataFrame:
    rows = _crosses(t).withColumns({"fp_het_pool": F.col("fp_base_pool"), "mp_het_pool": F.col("mp_base_pool")})
    out = M.pool_parents(rows, ["linecode"], {"linecode": ("region_lid", "pedigree")})
    return out.select("be_bid", "par_hp1_linecode", "par_hp2_linecode")


@plan("M1 M2 A3", """
WITH x AS (SELECT p_brand, p_partkey, CASE WHEN p_size % 3 > 0 THEN p_type END AS kind, nullif(p_name, 'red widget') AS name, p_size, CAST(p_size > 45 AS INTEGER) AS cpi FROM part)
SELECT p_brand, arg_min(kind, p_partkey) FILTER (kind IS NOT NULL) AS kind_first, arg_min(name, p_partkey) FILTER (name IS NOT NULL) AS name_first, min(p_size) AS p_size_min, max(p_size) AS p_size_max, max(cpi) AS cpi_max,
  count(DISTINCT kind) AS kind_distinct, count(DISTINCT p_size) AS p_size_distinct, count(*) AS count FROM x GROUP BY p_brand""")
def collapsed_attributes(t: Tables) -> DataFrame:
    x = t.part.select(
        "p_brand", "p_partkey", F.when(F.col("p_size") % 3 > 0, F.col("p_type")).alias("kind"),
        F.nullif("p_name", F.lit("red widget")).alias("name"), "p_size", (F.col("p_size") > 45).cast("int").alias("cpi"),
    )
    return M.collapse(x, "p_brand", "p_partkey", ["kind", "name"], ["p_size"], ["p_size", "cpi"], ["kind", "p_size"])


@plan("M4", """
SELECT l_partkey, l_suppkey, n FROM (SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY n DESC, l_suppkey) = 1""")
def best_sample_per_level(t: Tables) -> DataFrame:
    counted = t.lineitem.filter("l_returnflag = 'R'").groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    return keyed.top_per_key(counted, ["l_partkey"], ["-n", "l_suppkey"])


_MEMBER = """WITH g AS (SELECT l_partkey, CASE l_returnflag WHEN 'A' THEN 'Alpha' WHEN 'R' THEN 'Rho' ELSE 'Nu' END AS grp, sum(l_quantity) AS share FROM lineitem GROUP BY ALL),
map(name, ss, pool) AS (VALUES ('alpha', 'ss', 'pool1'), ('RHO', 'nss', 'pool2')),
best AS (SELECT l_partkey, grp, ss, pool, least(share, 100) AS share FROM g JOIN map ON lower(grp) = lower(name) QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY share DESC, grp) = 1)"""


def _membership(t: Tables) -> DataFrame:
    from trialspark.sources.tables import small_table

    word = F.when(F.col("l_returnflag") == "A", F.lit("Alpha")).when(F.col("l_returnflag") == "R", F.lit("Rho")).otherwise(F.lit("Nu"))
    g = t.lineitem.groupBy("l_partkey", word.alias("grp")).agg(F.sum("l_quantity").alias("share"))
    mapping = small_table(t.spark, [("alpha", "ss", "pool1"), ("RHO", "nss", "pool2")], "name string, ss string, pool string")
    return M.group_membership(g, mapping, ["l_partkey"], "grp", "name", "share").select("l_partkey", "grp", "ss", "pool", "share")


@plan("M5 M6", _MEMBER + " SELECT * FROM best")
def best_genetic_group(t: Tables) -> DataFrame:
    return _membership(t)


@plan("M7", r"""
WITH x AS (SELECT upper(substr(p_name, 1, 3)) || CAST(1000 + p_size AS VARCHAR) || '-' || p_partkey % 50 AS id, CASE WHEN p_size % 2 = 0 THEN 'PBM' ELSE 'BATCH' END AS kind, p_type AS grp, p_retailprice / 10 AS share FROM part),
raw AS (SELECT id AS group_id, kind, grp, share FROM x),
short AS (SELECT regexp_extract(id, '^([A-Z]{3}\d{4})', 1) AS group_id, kind, grp, share FROM x WHERE kind = 'PBM' AND regexp_extract(id, '^([A-Z]{3}\d{4})', 1) <> ''),
best AS (SELECT * FROM short QUALIFY row_number() OVER (PARTITION BY group_id ORDER BY share DESC, grp) = 1)
SELECT group_id, kind, grp, max(share) AS share FROM (SELECT * FROM raw UNION ALL SELECT * FROM best) GROUP BY ALL""")
def groups_by_id_prefix(t: Tables) -> DataFrame:
    x = t.part.select(
        F.concat(F.upper(F.substring("p_name", 1, 3)), (1000 + F.col("p_size")).cast("string"), F.lit("-"), F.col("p_partkey") % 50).alias("id"),
        F.when(F.col("p_size") % 2 == 0, F.lit("PBM")).otherwise(F.lit("BATCH")).alias("kind"), F.col("p_type").alias("grp"), (F.col("p_retailprice") / 10).alias("share"),
    )
    return M.groups_by_prefix(x, "id", "kind", "share", ["grp"])


_EVIDENCE = _MEMBER + """,
m AS (SELECT p_partkey, p_partkey + 7 AS line, p_size * 3 AS code, p_size AS chassis, p_brand AS family FROM part),
e AS (SELECT m.*, a.ss AS a_ss, a.pool AS a_pool, a.share AS a_share, b.ss AS b_ss, b.pool AS b_pool, b.share AS b_share, c.ss AS c_ss, c.pool AS c_pool, c.share AS c_share, d.ss AS d_ss, d.pool AS d_pool, d.share AS d_share FROM m
  LEFT JOIN (SELECT * FROM best WHERE share > 60) a ON a.l_partkey = line LEFT JOIN (SELECT * FROM best WHERE grp = 'Rho') b ON b.l_partkey = p_partkey
  LEFT JOIN (SELECT * FROM best WHERE grp = 'Alpha') c ON c.l_partkey = code LEFT JOIN best d ON d.l_partkey = chassis),
w AS (SELECT p_partkey, family, coalesce(a_ss, b_ss, c_ss, d_ss) AS ss, coalesce(a_pool, b_pool, c_pool, d_pool) AS pool, coalesce(a_share, b_share, c_share, d_share) AS share,
  CASE WHEN a_pool IS NOT NULL THEN 'line' WHEN b_pool IS NOT NULL THEN 'material' WHEN c_pool IS NOT NULL THEN 'code' WHEN d_pool IS NOT NULL THEN 'chassis' ELSE 'none' END AS source,
  CASE WHEN a_ss = 'ss' OR c_ss = 'ss' THEN 1.0 ELSE 0 END + CASE WHEN b_ss = 'ss' THEN 1 ELSE 0 END + CASE WHEN d_ss = 'ss' THEN 0.5 ELSE 0 END AS ss_votes,
  CASE WHEN a_ss = 'nss' OR c_ss = 'nss' THEN 1.0 ELSE 0 END + CASE WHEN b_ss = 'nss' THEN 1 ELSE 0 END + CASE WHEN d_ss = 'nss' THEN 0.5 ELSE 0 END AS nss_votes
  FROM e WHERE coalesce(a_ss, b_ss, c_ss, d_ss) IS NOT NULL)"""


def _evidence(t: Tables) -> DataFrame:
    best = _membership(t)
    m = t.part.select(
        "p_partkey", (F.col("p_partkey") + 7).alias("line"), (F.col("p_size") * 3).cast("bigint").alias("code"),
        F.col("p_size").cast("bigint").alias("chassis"), F.col("p_brand").alias("family"),
    )
    levels = [
        M.Evidence("line", "line", best.filter("share > 60"), "l_partkey", "line"),
        M.Evidence("material", "p_partkey", best.filter("grp = 'Rho'"), "l_partkey", "material"),
        M.Evidence("code", "code", best.filter("grp = 'Alpha'"), "l_partkey", "line"),
        M.Evidence("chassis", "chassis", best, "l_partkey", "chassis", 0.5),
    ]
    return M.weigh_evidence(m, levels, "ss", ["ss", "nss"], ["pool", "share"])


@plan("M8 J13 J14", _EVIDENCE + " SELECT p_partkey, ss, pool, share, source, CAST(ss_votes AS DOUBLE) AS ss_votes, CAST(nss_votes AS DOUBLE) AS nss_votes FROM w")
def weighted_group_evidence(t: Tables) -> DataFrame:
    return _evidence(t).select("p_partkey", "ss", "pool", "share", "source", "ss_votes", "nss_votes")


@plan("M9", _EVIDENCE + """ SELECT family, max(share) AS share_max, CAST(sum(ss_votes) AS DOUBLE) AS ss_votes_sum, CAST(sum(nss_votes) AS DOUBLE) AS nss_votes_sum,
  CASE WHEN sum(ss_votes) >= 2 * sum(nss_votes) THEN 'ss' WHEN sum(nss_votes) >= 2 * sum(ss_votes) THEN 'nss' ELSE '' END AS family_class, count(*) AS count FROM w WHERE share >= 33 GROUP BY family""")
def family_majority(t: Tables) -> DataFrame:
    return M.family_majority(_evidence(t), "family", ("ss_votes", "nss_votes"), ("ss", "nss"), "share")


@plan("M10", """
SELECT p_partkey, l_suppkey AS sample_id, count(*) AS genotype_count FROM part JOIN lineitem ON l_partkey = p_partkey WHERE l_linestatus = 'O' GROUP BY ALL""")
def sample_to_material(t: Tables) -> DataFrame:
    calls = t.lineitem.filter("l_linestatus = 'O'").groupBy("l_partkey", F.col("l_suppkey").alias("sample_id")).agg(F.count(F.lit(1)).alias("genotype_count"))
    return t.part.join(calls, F.col("p_partkey") == F.col("l_partkey")).select("p_partkey", "sample_id", "genotype_count")


@plan("M11", f"""WITH {_CROSS_SQL}
SELECT be_bid, max(cpi) AS cpi FROM (SELECT be_bid, cpi FROM crosses UNION ALL SELECT fp_be_bid, cpi FROM crosses UNION ALL SELECT mp_be_bid, cpi FROM crosses) GROUP BY be_bid""")
def flags_over_roles(t: Tables) -> DataFrame:
    return M.flags_over_roles(_crosses(t), {"self": "be_bid", "female": "fp_be_bid", "male": "mp_be_bid"}, "cpi")


@plan("M12 A4", f"""WITH {_CROSS_SQL},
r AS (SELECT fp_linecode AS k, region_lid AS c FROM crosses WHERE fp_linecode IS NOT NULL),
n AS (SELECT k, c, count(*) AS n FROM r WHERE c IS NOT NULL GROUP BY ALL),
md AS (SELECT k, c FROM n QUALIFY row_number() OVER (PARTITION BY k ORDER BY n DESC, c) = 1),
fi AS (SELECT fp_linecode AS k, arg_min(family, be_bid) FILTER (family IS NOT NULL) AS family FROM crosses WHERE fp_linecode IS NOT NULL GROUP BY 1)
SELECT be_bid, coalesce(x.family, fi.family) AS family, md.c AS usual_region FROM crosses x LEFT JOIN md ON md.k = fp_linecode LEFT JOIN fi ON fi.k = fp_linecode""")
def consolidated_record(t: Tables) -> DataFrame:
    x = _crosses(t)
    usual = M.consolidate(x, "fp_linecode", ["region_lid"]).withColumnRenamed("region_lid", "usual_region")
    first = M.consolidate(x, "fp_linecode", ["family"], "first", "be_bid")
    out = lookup.fallback_join(x, [("line", "fp_linecode", first)], ["family"])
    return out.join(usual, "fp_linecode", "left").select("be_bid", "family", "usual_region")


@plan("M18", """
SELECT l_partkey, l_suppkey, CAST(min(year(l_shipdate)) AS INTEGER) AS first_year FROM lineitem GROUP BY ALL""")
def first_year_seen(t: Tables) -> DataFrame:
    rows = t.lineitem.withColumn("year", F.year("l_shipdate"))
    return M.first_years(rows, ["l_partkey", "l_suppkey"], "year")


@plan("M19", """
WITH c AS (SELECT l_suppkey, l_linestatus, CASE l_returnflag WHEN 'A' THEN 'A/A' WHEN 'R' THEN 'C/T' ELSE 'G/G' END AS call FROM lineitem)
SELECT l_suppkey, l_linestatus, count(*) AS genotype_count FROM c WHERE call IN ('A/A', 'C/C', 'G/G', 'T/T') GROUP BY ALL HAVING count(*) > 99""")
def covered_samples(t: Tables) -> DataFrame:
    call = F.when(F.col("l_returnflag") == "A", F.lit("A/A")).when(F.col("l_returnflag") == "R", F.lit("C/T")).otherwise(F.lit("G/G"))
    return M.covered_samples(t.lineitem.withColumn("call", call), "l_suppkey", "l_linestatus", "call")


@plan("M20", """
WITH m AS (SELECT p_partkey, p_brand AS chassis, CASE WHEN p_size % 9 = 0 THEN ' Unknown ' ELSE p_name END AS code FROM part),
y AS (SELECT p_brand AS chassis, min(1980 + p_size) AS chassis_year FROM part WHERE p_retailprice > 930 GROUP BY 1)
SELECT p_partkey, m.chassis, CASE WHEN lower(trim(code)) IN ('unknown', 'n/a') THEN '' ELSE trim(code) END AS code, chassis_year FROM m LEFT JOIN y ON y.chassis = m.chassis""")
def material_base_table(t: Tables) -> DataFrame:
    m = t.part.select("p_partkey", F.col("p_brand").alias("chassis"), F.when(F.col("p_size") % 9 == 0, F.lit(" Unknown ")).otherwise(F.col("p_name")).alias("code"))
    lines = t.part.filter("p_retailprice > 930").select(F.col("p_brand").alias("chassis"), (1980 + F.col("p_size")).alias("year"))
    return M.material_base(m, lines, "code", "chassis", "year")


@plan("M21 PF10 PF13", """
WITH x AS (SELECT p_brand, p_name || ' maturity' AS trait, CAST(p_size % 9 AS DOUBLE) AS v FROM part UNION ALL SELECT p_brand, p_name || ' gene maturity', 50.0 FROM part)
SELECT p_brand, trait, avg(CASE WHEN v < 10 THEN v * 5 + 80 ELSE v END) AS rm FROM x WHERE trait LIKE '%maturity%' AND trait NOT LIKE '%gene%' GROUP BY ALL""")
def maturity_trait_extract(t: Tables) -> DataFrame:
    from trialspark.functions import cleaning as C

    a = t.part.select("p_brand", F.concat("p_name", F.lit(" maturity")).alias("trait"), (F.col("p_size") % 9).cast("double").alias("v"))
    b = t.part.select("p_brand", F.concat("p_name", F.lit(" gene maturity")).alias("trait"), F.lit(50.0).alias("v"))
    rows = a.union(b).filter(C.matches_but_not(F.col("trait"), ["%maturity%"], ["%gene%"]))
    return rows.groupBy("p_brand", "trait").agg(F.avg(C.to_day_scale(F.col("v"))).alias("rm"))
