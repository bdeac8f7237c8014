"""Material, pedigree and tester resolution.

Rules about the two parents are written once, from the view of one parent (its
``own`` columns, the ``other`` parent's and the entry's), and mirrored for the
other parent. One list yields both the label and the number of the rule that
set it, so the two cannot disagree.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialspark.operators.aggregates import first_value
from trialspark.operators.keyed import modes, top_per_key
from trialspark.operators.lookup import parent_attributes
from trialspark.operators.reshape import stack_roles

# Prefixes of the parents' columns, role letters, and thresholds of the tester rules.
FEMALE, MALE = "fp_", "mp_"
ROLE = {FEMALE: "F", MALE: "M"}
TESTER_MARGIN, NOT_TESTER_MARGIN, LEANING = 0.4, 0.3, 0.1
POOL_DOMINANCE = 3
INSECT_EVENTS = ("Bt11", "TC1507", "MON89034", "MIR162", "DP-004114-3", "5307", "MIR604", "DAS-59122-7", "DP-4114")
HOMOZYGOUS = ("A/A", "C/C", "G/G", "T/T")


def known(x: Column) -> Column:
    return x.isNotNull() & (x != "")


def blank(x: Column) -> Column:
    return x.isNull() | (x == "")


def carries_any(x: Column, words: Sequence[str]) -> Column:
    """1 when a text holds any of the words, else 0."""
    hit = F.lit(False)
    for w in words:
        hit = hit | F.coalesce(F.contains(x, F.lit(w)), F.lit(False))
    return hit.cast("int")


# --- collapsing attributes ------------------------------------------------------

def collapse(df: DataFrame, level: str, order: str, first: Sequence[str] = (), lowest: Sequence[str] = (), highest: Sequence[str] = (), distinct: Sequence[str] = ()) -> DataFrame:
    """One row per id of a level: first known values by an order column, extremes, distinct counts.

    First values are aggregates over (order, value), so no group is sorted.
    """
    rows = df.filter(known(F.col(level).cast("string")))
    at = F.col(order)
    return rows.groupBy(level).agg(
        *[first_value(c, F.struct(at, F.col(c))).alias(f"{c}_first") for c in first],
        *[F.min(c).alias(f"{c}_min") for c in lowest],
        *[F.max(c).alias(f"{c}_max") for c in highest],
        *[F.count_distinct(c).alias(f"{c}_distinct") for c in distinct],
        F.count(F.lit(1)).alias("count"),
    )


def consolidate(df: DataFrame, level: str, columns: Sequence[str], how: str = "mode", order: str | None = None) -> DataFrame:
    """One value per column and id: the most frequent (smallest among equals) or the first known."""
    rows = df.filter(known(F.col(level).cast("string")))
    if how == "mode":
        return modes(rows, [level], columns)
    return rows.groupBy(level).agg(*[first_value(c, F.struct(F.col(order), F.col(c))).alias(c) for c in columns])


def flags_over_roles(df: DataFrame, roles: dict[str, str], flag: str, id_col: str = "be_bid") -> DataFrame:
    """Largest flag of an id over every role it appears in."""
    rows = stack_roles(df.filter(F.col(flag).isNotNull()), roles, id_col, keep=[flag])
    return rows.groupBy(id_col).agg(F.max(flag).alias(flag))


def with_parents(df: DataFrame, attributes: DataFrame, key: str, columns: Sequence[str], female: str = "fp_be_bid", male: str = "mp_be_bid") -> DataFrame:
    return parent_attributes(df, attributes, key, {FEMALE: female, MALE: male}, columns)


# --- genetic groups ------------------------------------------------------------

def group_membership(groups: DataFrame, mapping: DataFrame, keys: Sequence[str], name: str, mapped: str, share: str) -> DataFrame:
    """Largest membership per material with its mapped group; shares are capped at 100."""
    joined = groups.join(mapping, F.lower(groups[name]) == F.lower(mapping[mapped]))
    joined = joined.withColumn(share, F.col(share).cast("double"))
    return top_per_key(joined, keys, [f"-{share}", name]).withColumn(share, F.least(F.col(share), F.lit(100.0)))


def groups_by_prefix(df: DataFrame, id_col: str, kind: str, share: str, keep: Sequence[str], pattern: str = r"^([A-Z]{3}\d{4})", kinds: Sequence[str] = ("PBM",)) -> DataFrame:
    """Memberships by raw id and, for given kinds, the best one by the id's prefix; the largest share per row wins."""
    raw = df.select(F.col(id_col).alias("group_id"), kind, *keep, share).distinct()
    prefix = F.regexp_extract(id_col, pattern, 1)
    short = df.filter((prefix != "") & F.col(kind).isin(*kinds)).select(prefix.alias("group_id"), kind, *keep, share)
    best = top_per_key(short, ["group_id"], [f"-{share}", *keep])
    return raw.union(best.select(*raw.columns)).groupBy("group_id", kind, *keep).agg(F.max(share).alias(share))


@dataclass(frozen=True)
class Evidence:
    """One identifier level that may know a material's group."""

    label: str
    key: str
    table: DataFrame
    table_key: str
    kind: str
    weight: float = 1.0


def weigh_evidence(df: DataFrame, levels: Sequence[Evidence], label: str, classes: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Group columns of the first level that knows them, and weighted votes per class.

    Levels of the same ``kind`` vote once. Rows no level knows are left out.
    """
    out = df
    for e in levels:
        side = e.table.select(F.col(e.table_key).alias(e.key), *[F.col(c).alias(f"_{e.label}_{c}") for c in (label, *columns)])
        out = out.join(side, e.key, "left")
    resolved = {c: F.coalesce(*[F.col(f"_{e.label}_{c}") for e in levels]) for c in (label, *columns)}
    source = None
    for e in levels:
        hit = F.col(f"_{e.label}_{columns[0]}").isNotNull()
        source = F.when(hit, F.lit(e.label)) if source is None else source.when(hit, F.lit(e.label))
    resolved["source"] = source.otherwise(F.lit("none"))
    for name in classes:
        votes = F.lit(0.0)
        for kind in dict.fromkeys(e.kind for e in levels):
            same = [e for e in levels if e.kind == kind]
            hit = F.lit(False)
            for e in same:
                hit = hit | F.coalesce(F.col(f"_{e.label}_{label}") == name, F.lit(False))
            votes = votes + F.when(hit, F.lit(same[0].weight)).otherwise(F.lit(0.0))
        resolved[f"{name}_votes"] = votes
    any_known = F.lit(False)
    for e in levels:
        any_known = any_known | known(F.col(f"_{e.label}_{label}"))
    temporary = [f"_{e.label}_{c}" for e in levels for c in (label, *columns)]
    return out.filter(any_known).withColumns(resolved).drop(*temporary)


def family_majority(df: DataFrame, family: str, votes: tuple[str, str], names: tuple[str, str], share: str, least: float = 33.0, ratio: float = 2.0) -> DataFrame:
    """Class of a family when one class has at least ``ratio`` times the votes of the other; else empty."""
    a, b = (F.sum(v) for v in votes)
    rows = df.filter(known(F.col(family)) & (F.col(share) >= least))
    word = F.when(a >= ratio * b, F.lit(names[0])).when(b >= ratio * a, F.lit(names[1])).otherwise(F.lit(""))
    return rows.groupBy(family).agg(
        F.max(share).alias(f"{share}_max"), a.alias(f"{votes[0]}_sum"), b.alias(f"{votes[1]}_sum"), word.alias("family_class"), F.count(F.lit(1)).alias("count")
    )


# --- rule cascades ----------------------------------------------------------------

class Side:
    """Columns of one parent by bare name."""

    def __init__(self, prefix: str):
        self.prefix = prefix

    def __getattr__(self, name: str) -> Column:
        return F.col(self.prefix + name)


class Entry:
    """Columns of the entry itself."""

    def __getattr__(self, name: str) -> Column:
        return F.col(name)


@dataclass(frozen=True)
class Rule:
    """A rule that names a parent, or settles that none can be named.

    ``numbers`` are the rule numbers for the parents in the order they are
    tried; a settling rule has a single number and the prefix ``""``.
    """

    numbers: dict[str, int]
    test: Callable[[Side, Side, Entry], Column]


def _expanded(rules: Sequence[Rule]) -> list[tuple[str, int, Column]]:
    out = []
    entry = Entry()
    for r in rules:
        for prefix, number in r.numbers.items():
            own = Side(prefix or FEMALE)
            other = Side(FEMALE if prefix == MALE else MALE)
            out.append((ROLE.get(prefix, ""), number, r.test(own, other, entry)))
    return out


def apply_rules(df: DataFrame, rules: Sequence[Rule], label: str, number: str, otherwise: Column | None = None) -> DataFrame:
    """First rule that holds sets the number; the label follows from the number.

    Without a rule the number is 0 and the label ``otherwise`` (null by default).
    The conditions are evaluated once, as one ladder.
    """
    ladder = None
    by_word: dict[str, list[int]] = {}
    for word, n, test in _expanded(rules):
        ladder = F.when(test, F.lit(n)) if ladder is None else ladder.when(test, F.lit(n))
        by_word.setdefault(word, []).append(n)
    words = None
    for word, numbers in by_word.items():
        hit = F.col(number).isin(numbers)
        words = F.when(hit, F.lit(word)) if words is None else words.when(hit, F.lit(word))
    out = df.withColumn(number, ladder.otherwise(F.lit(0)))
    return out.withColumn(label, words if otherwise is None else words.otherwise(otherwise))


def _position_from_end(text: Column, mark: str) -> Column:
    return F.instr(F.reverse(text), mark)


def _has(text: Column, mark: str) -> Column:
    return F.instr(text, mark) > 0


def _bracketed(own: Side, other: Side, e: Entry) -> Column:
    """The last slash of the pedigree separates this parent from a bracketed cross."""
    slash = _position_from_end(e.pedigree, "/")
    if own.prefix == MALE:
        return (slash < _position_from_end(e.pedigree, ")")) & (slash > 0) & known(own.linecode)
    opening = _position_from_end(e.pedigree, "(")
    return (slash > opening) & (opening > 0) & known(own.linecode)


def _older(own: Side) -> Column:
    return F.least(own.chassis_year, own.line_create_year)


def _from_elsewhere(side: Side, e: Entry) -> Column:
    return (side.region_lid != e.region_lid) & known(e.region_lid)


def _both(first: int, second: int) -> dict[str, int]:
    """Male rule first."""
    return {MALE: first, FEMALE: second}


def _female_first(first: int, second: int) -> dict[str, int]:
    return {FEMALE: first, MALE: second}


TESTER_RULES: tuple[Rule, ...] = (
    Rule(_both(1, 2), _bracketed),
    # the other parent is no line
    Rule(_both(3, 4), lambda own, other, e: blank(other.linecode) & known(own.linecode)),
    # the other parent is itself a bracketed cross
    Rule(_both(5, 6), lambda own, other, e: _has(other.abbr_code, ")") & ~_has(own.abbr_code, ")")),
    # the other parent is recent and from another region than the entry
    Rule(_both(7, 8), lambda own, other, e: (other.chassis_year > e.create_year_max - 3) & _from_elsewhere(other, e)),
    # only the other parent is as young as the entry
    Rule(_both(9, 10), lambda own, other, e: (other.chassis_year >= e.create_year_max) & (own.chassis_year < e.create_year_max)),
    # re-made or commercial entries say nothing
    Rule({"": 11}, lambda own, other, e: e.create_year_max - e.create_year > 3),
    Rule({"": 12}, lambda own, other, e: e.cpi == 1),
    # the older parent, when its region fits
    Rule(
        _both(13, 14),
        lambda own, other, e: (_older(own) < _older(other))
        & ((own.region_lid == e.region_lid) | (own.region_lid == other.region_lid) | blank(own.region_lid))
        & known(own.linecode),
    ),
    Rule({"": 15}, lambda own, other, e: (own.het_group == other.het_group) & known(own.het_group)),
    # the other parent has a family name, this one has none
    Rule(_both(16, 17), lambda own, other, e: (F.length(other.family) > 2) & (F.length(own.family) < 3) & known(own.linecode)),
    # the entry's family is the other parent's
    Rule(_both(18, 19), lambda own, other, e: (F.length(e.family) > 2) & (F.instr(other.abbr_code, e.family) > 0) & known(own.linecode)),
    # only this parent has a line year
    Rule(_both(22, 23), lambda own, other, e: own.line_create_year.isNotNull() & other.line_create_year.isNull() & known(own.linecode)),
    # only this parent is from the entry's region
    Rule(
        _both(24, 25),
        lambda own, other, e: (other.region_lid != e.region_lid) & known(other.region_lid) & (own.region_lid == e.region_lid) & known(own.linecode),
    ),
    # lines of the same year, only this one has a derived code
    Rule(_both(30, 31), lambda own, other, e: ~_has(other.precd, "_") & _has(own.precd, "_") & (own.line_create_year == other.line_create_year)),
    # only the other parent was made together with the entry
    Rule(
        _female_first(26, 27),
        lambda own, other, e: (e.create_year <= other.create_year + 1) & ~(e.create_year <= own.create_year + 1) & known(own.linecode),
    ),
    Rule(
        _female_first(28, 29),
        lambda own, other, e: (e.create_year <= other.line_create_year) & (e.create_year > own.line_create_year + 2) & (own.region_lid == e.region_lid),
    ),
    # the other parent is a version
    Rule(_both(32, 33), lambda own, other, e: _has(F.lower(e.pedigree), "ver") & _has(F.lower(other.precd), "ver") & known(own.linecode)),
    # same chassis year, older line
    Rule(_both(34, 35), lambda own, other, e: (own.chassis_year == other.chassis_year) & (own.line_create_year < other.line_create_year)),
)


def tester_roles(df: DataFrame) -> DataFrame:
    """Which parent is the tester (``F``, ``M``, empty when undecided, null when no rule fits) and the rule number."""
    return apply_rules(df, TESTER_RULES, "tester_role", "rule")


def tester_ratios(df: DataFrame, evidence_above: int = 6) -> DataFrame:
    """Per parent line how often it was the tester, from all its crosses and by side.

    Only rules beyond pedigree notation count (above number 6, or none). A
    parent becomes a tester when its tester share leads by 0.4, a non-tester when
    the other share leads by 0.3.
    """
    votes = df.filter((F.col("rule") > evidence_above) | (F.col("rule") == 0))
    rows = None
    for prefix in (FEMALE, MALE):
        side = votes.filter(known(F.col(f"{prefix}be_bid")) & known(F.col(f"{prefix}linecode")))
        yes = F.count_if(F.col("tester_role") == ROLE[prefix])
        no = F.count_if(F.col("tester_role") == ROLE[MALE if prefix == FEMALE else FEMALE])
        part = side.groupBy(F.col(f"{prefix}be_bid").alias("be_bid")).agg(
            yes.alias(f"{prefix}yes"), no.alias(f"{prefix}no"), F.count(F.lit(1)).alias(f"{prefix}count")
        )
        rows = part if rows is None else rows.join(part, "be_bid", "full")

    def both(what: str) -> Column:
        return F.coalesce(F.col(f"{FEMALE}{what}"), F.lit(0)) + F.coalesce(F.col(f"{MALE}{what}"), F.lit(0))

    out = rows.withColumn("count", both("count"))
    ratios = {"tester_ratio": both("yes") / F.col("count"), "not_tester_ratio": both("no") / F.col("count")}
    for prefix in (FEMALE, MALE):
        ratios[f"{prefix}tester_ratio"] = F.col(f"{prefix}yes") / F.col(f"{prefix}count")
        ratios[f"{prefix}not_tester_ratio"] = F.col(f"{prefix}no") / F.col(f"{prefix}count")
    out = out.withColumns(ratios)

    def decided(prefix: str) -> Column:
        yes, no = F.col(f"{prefix}tester_ratio"), F.col(f"{prefix}not_tester_ratio")
        return F.when(yes >= no + TESTER_MARGIN, F.lit(1)).when(no >= yes + NOT_TESTER_MARGIN, F.lit(0))

    out = out.withColumns({f"{p}make_tester": decided(p) for p in ("", FEMALE, MALE)})
    return out.drop(*[f"{p}{w}" for p in (FEMALE, MALE) for w in ("yes", "no")])


def _undecided(e: Entry) -> Column:
    return blank(e.tester_role)


REFINING_RULES: tuple[Rule, ...] = (
    Rule(_female_first(1, 2), lambda own, other, e: (own.make_tester == 1) & own.linecode.isNotNull() & (other.make_tester == 0)),
    Rule(
        _female_first(3, 4),
        lambda own, other, e: (own.make_tester == 1)
        & own.linecode.isNotNull()
        & ((other.make_tester != 1) | other.make_tester.isNull() | e.rule.isin(12, 13))
        & _undecided(e),
    ),
    Rule(
        _female_first(5, 6),
        lambda own, other, e: (other.make_tester == 0) & (own.not_tester_ratio < own.tester_ratio - LEANING) & own.make_tester.isNull(),
    ),
    Rule(_female_first(7, 8), lambda own, other, e: (e.cpi == 1) & (own.line_create_year < other.line_create_year) & _undecided(e)),
    Rule(_female_first(9, 10), lambda own, other, e: (own.tester_ratio > other.tester_ratio) & _undecided(e)),
)


def refine_testers(df: DataFrame, ratios: DataFrame) -> DataFrame:
    """Second cascade on the parents' tester shares; otherwise the first role stays."""
    out = df
    for prefix in (FEMALE, MALE):
        own = F.col(f"{prefix}tester_ratio")
        side = ratios.select(
            F.col("be_bid").alias(f"{prefix}be_bid"),
            F.coalesce(own, F.col("tester_ratio")).alias("_yes"),
            F.coalesce(F.col(f"{prefix}not_tester_ratio"), F.col("not_tester_ratio")).alias("_no"),
            F.when(own.isNotNull(), F.col(f"{prefix}make_tester")).otherwise(F.col("make_tester")).alias("_make"),
        ).withColumnsRenamed({"_yes": f"{prefix}tester_ratio", "_no": f"{prefix}not_tester_ratio", "_make": f"{prefix}make_tester"})
        out = out.join(side, f"{prefix}be_bid", "left")
    # the cascade replaces the role it reads, so it goes through a second name
    out = apply_rules(out, REFINING_RULES, "_role", "rule2", F.col("tester_role"))
    return out.drop("tester_role").withColumnRenamed("_role", "tester_role")


def opposite(pool: Column) -> Column:
    return F.when(pool == "pool1", F.lit("pool2")).when(pool == "pool2", F.lit("pool1"))


def assign_pools(df: DataFrame) -> DataFrame:
    """Pool of each parent from base pools; the two parents get opposite pools.

    A parent alone in its pool keeps it. When both share a base pool the
    non-tester keeps it, and without a tester the one of the better rank.
    """
    f, m = F.col("fp_base_pool"), F.col("mp_base_pool")
    alone = lambda own, other: own.isin("pool1", "pool2") & (blank(other) | (other == opposite(own)))
    keeps = (F.col("tester_role") == "M") | (
        F.coalesce(~F.col("tester_role").isin("M", "F"), F.lit(True)) & (F.col("fp_base_pool_rank") < F.col("mp_base_pool_rank"))
    )
    yields = (F.col("tester_role") == "F") | (
        F.coalesce(~F.col("tester_role").isin("M", "F"), F.lit(True)) & (F.col("fp_base_pool_rank") > F.col("mp_base_pool_rank"))
    )
    shared = (f == m) & f.isin("pool1", "pool2")
    female = F.when(alone(f, m), f).when(alone(m, f), opposite(m)).when(shared & keeps, f).when(shared & yields, opposite(f))
    return df.withColumn("fp_het_pool", female).withColumn("mp_het_pool", opposite(F.col("fp_het_pool")))


def pool_votes(df: DataFrame) -> DataFrame:
    """How often a line was put into each pool and group, over both parent roles."""
    roles = F.array(
        *[F.struct(F.col(f"{p}be_bid").alias("be_bid"), F.col(f"{p}het_pool").alias("pool"), F.col(f"{p}het_group").alias("het")) for p in (FEMALE, MALE)]
    )
    rows = df.select(F.explode(roles).alias("_r")).select("_r.*")
    return rows.groupBy("be_bid").agg(
        F.count_if(F.col("pool") == "pool1").alias("pool1_vote"),
        F.count_if(F.col("pool") == "pool2").alias("pool2_vote"),
        F.count_if(blank(F.col("pool"))).alias("poolnull_vote"),
        F.count_if(F.col("het") == "ss").alias("ss_vote"),
        F.count_if(F.col("het") == "nss").alias("nss_vote"),
        F.count_if(blank(F.col("het"))).alias("hetgrpnull_vote"),
    )


def final_pools(df: DataFrame, votes: DataFrame) -> DataFrame:
    """Fill missing pools by vote: one parent dominates a pool three to one, the other does not.

    Also names the parent in each pool.
    """
    out = df
    for p in (FEMALE, MALE):
        side = votes.select(F.col("be_bid").alias(f"{p}be_bid"), *[F.col(f"pool{i}_vote").alias(f"_{p}{i}") for i in (1, 2)])
        out = out.join(side, f"{p}be_bid", "left")
    vote = lambda p, i: F.col(f"_{p}{i}")
    leads = lambda p, i: vote(p, i) > vote(p, 3 - i) * POOL_DOMINANCE
    follows = lambda p, i: vote(p, i) <= vote(p, 3 - i) * POOL_DOMINANCE
    by_vote = (
        F.when(leads(FEMALE, 1) & follows(MALE, 1), F.lit("pool1"))
        .when(leads(FEMALE, 2) & follows(MALE, 2), F.lit("pool2"))
        .when(follows(FEMALE, 1) & leads(MALE, 1), F.lit("pool2"))
        .when(follows(FEMALE, 2) & leads(MALE, 2), F.lit("pool1"))
    )
    out = out.withColumn("_voted", by_vote)
    own = {p: F.col(f"{p}het_pool") for p in (FEMALE, MALE)}
    named = {p: F.col(f"{p}be_bid") for p in (FEMALE, MALE)}
    voted = {FEMALE: F.col("_voted"), MALE: opposite(F.col("_voted"))}

    def in_pool(pool: str, order: tuple[str, str]) -> Column:
        ladder = F.when(own[order[0]] == pool, named[order[0]]).when(own[order[1]] == pool, named[order[1]])
        return ladder.when(voted[FEMALE] == pool, named[FEMALE]).when(voted[MALE] == pool, named[MALE])

    return out.withColumns(
        {
            "par_hp1_be_bid": in_pool("pool1", (FEMALE, MALE)),
            "par_hp2_be_bid": in_pool("pool2", (MALE, FEMALE)),
            "fp_het_pool": F.when(known(own[FEMALE]), own[FEMALE]).otherwise(voted[FEMALE]),
            "mp_het_pool": F.when(known(own[MALE]), own[MALE]).otherwise(voted[MALE]),
        }
    ).drop("_voted", *[f"_{p}{i}" for p in (FEMALE, MALE) for i in (1, 2)])


def pool_parents(df: DataFrame, columns: Sequence[str], fallback: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """Columns of the parent that stands for each pool in trial data.

    The female stands for pool 1 unless it is a pool-2 line; the male stands for
    pool 2 unless it is a pool-1 line. ``fallback`` names, per column, the
    (receiver, donor) columns used when the parent has none.
    """
    f, m = F.col("fp_het_pool"), F.col("mp_het_pool")
    out = df
    for c in columns:
        fp, mp = F.col(f"fp_{c}"), F.col(f"mp_{c}")
        receiver, donor = (F.col(x) for x in fallback[c]) if fallback and c in fallback else (F.lit(None), F.lit(None))
        first = F.when(f != "pool2", F.coalesce(fp, receiver)).when(m == "pool1", F.coalesce(mp, donor)).otherwise(receiver)
        second = F.when(f == "pool2", F.coalesce(fp, receiver)).when(m != "pool1", F.coalesce(mp, donor)).otherwise(donor)
        out = out.withColumns({f"par_hp1_{c}": first, f"par_hp2_{c}": second})
    return out


# --- source tables -------------------------------------------------------------------

def first_years(df: DataFrame, keys: Sequence[str], year: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(year).alias(f"first_{year}"))


def covered_samples(calls: DataFrame, sample: str, technology: str, call: str, more_than: int = 99, accepted: Sequence[str] = HOMOZYGOUS) -> DataFrame:
    """Samples with more than ``more_than`` homozygous calls under one technology."""
    counted = calls.filter(F.col(call).isin(*accepted)).groupBy(sample, technology).agg(F.count(call).alias("genotype_count"))
    return counted.filter(F.col("genotype_count") > more_than)


def material_base(materials: DataFrame, lines: DataFrame, key: str, chassis: str, year: str, unknown: Sequence[str] = ("unknown", "n/a")) -> DataFrame:
    """Materials with cleaned codes and the earliest year of their chassis."""
    earliest = lines.groupBy(chassis).agg(F.min(year).alias("chassis_year"))
    cleaned = materials.withColumn(key, F.when(F.lower(F.trim(key)).isin(*unknown), F.lit("")).otherwise(F.trim(key)))
    return cleaned.join(earliest, chassis, "left")
