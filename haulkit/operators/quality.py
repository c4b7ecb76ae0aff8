"""Data-quality report (Q1-Q24), inventories (D12), ranges (D13), orphan
units (C25) and specimen/catch reconciliation (C26).

The reference runs each rule as its own scan and prints; here every row rule
is one `count_if` inside a single aggregation, so the specimen table is read
once whatever the number of rules, and `violations(rule)` returns the rows.
Rules encode the stated intent (README, "Quality rules"): NULL codes fail
membership rules, "female" means SEX != 1 (NULL sex excluded, like R's filter).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.nulls import is_in, strict_sum
from .joins import null_safe_join


@dataclass(frozen=True)
class Rule:
    rule_id: str
    description: str
    violation: Column          # TRUE marks a violating row (NULL counts as not violating)
    applies: Column | None = None   # rows the rule checks (None = all rows)


def _female():
    return F.col("SEX") != K.MALE


def specimen_rules(expected_cruise: int = 202401, vessels: Sequence[str] = K.POT_VESSELS,
                   species: Sequence[int] = (K.RED_KING_CRAB,), coverage_mode: str = "any") -> list[Rule]:
    sex, ln, sc = F.col("SEX"), F.col("LENGTH"), F.col("SHELL_CONDITION")
    ec, econ, cl = F.col("EGG_COLOR"), F.col("EGG_CONDITION"), F.col("CLUTCH_SIZE")
    dc = F.col("DISEASE_CODE")
    cov = [F.col("DISEASE_DORSAL"), F.col("DISEASE_VENTRAL"), F.col("DISEASE_LEGS")]
    fem = _female()
    any_cov = cov[0].isNotNull() | cov[1].isNotNull() | cov[2].isNotNull()
    all_cov = cov[0].isNotNull() & cov[1].isNotNull() & cov[2].isNotNull()
    no_cov = cov[0].isNull() & cov[1].isNull() & cov[2].isNull()
    return [
        Rule("Q1", "cruise not the expected one", ~is_in("CRUISE", [expected_cruise])),
        Rule("Q2", "vessel not in the survey's set", ~is_in("VESSEL", vessels)),
        Rule("Q3", "species code not expected", ~is_in("SPECIES_CODE", species)),
        Rule("Q4", "sex not 1 or 2", ~is_in("SEX", [K.MALE, K.FEMALE])),
        Rule("Q5", "female egg color not in {0, 2-6}", ~is_in("EGG_COLOR", K.EGG_COLOR_CODES), fem),
        Rule("Q6", "female egg condition not in 0-5", ~is_in("EGG_CONDITION", K.EGG_CONDITION_CODES), fem),
        Rule("Q7", "female clutch size not in {0-6, 999}", ~is_in("CLUTCH_SIZE", K.CLUTCH_CODES), fem),
        Rule("Q8", "male with egg color, egg condition or clutch size",
             ec.isNotNull() | econ.isNotNull() | cl.isNotNull(), sex == K.MALE),
        Rule("Q9a", "female shell 0 with egg condition 1", fem & (sc == 0) & (econ == 1), fem),
        Rule("Q9b", "female shell 1 with egg condition > 1", fem & (sc == 1) & (econ > 1), fem),
        Rule("Q9c", "female shell 3-5 with egg condition 1", fem & sc.isin(3, 4, 5) & (econ == 1), fem),
        Rule("Q10", "female missing an egg code",
             ec.isNull() | econ.isNull() | cl.isNull(), sex == K.FEMALE),
        Rule("Q11", "missing length", ln.isNull()),
        Rule("Q12", "female < 65 mm with clutch > 0", fem & (ln < K.SMALL_FEMALE_MM) & (cl > 0), fem),
        Rule("Q13", "length < 60 with shell condition > 2", (ln < K.SMALL_CRAB_MM) & (sc > 2)),
        Rule("Q14", "width entered for a length-measured species",
             is_in("SPECIES_CODE", species) & F.col("WIDTH").isNotNull()),
        Rule("Q16", "black mat without % coverage", no_cov, dc == K.BLACK_MAT),
        Rule("Q17", "bitter crab recorded", dc == K.BITTER_CRAB),
        Rule("Q18", "coverage entered without a disease code",
             dc.isNull() & (any_cov if coverage_mode == "any" else all_cov)),
        Rule("Q19", "disease code > 9", dc > K.MAX_DISEASE_CODE),
        Rule("Q21", "sampling factor < 1", F.col("SAMPLING_FACTOR") < 1),
    ]


def quality_report(specimens: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """(RULE_ID, DESCRIPTION, VIOLATIONS, CHECKED) from one aggregation."""
    rules = list(rules or specimen_rules())
    aggs = []
    for i, r in enumerate(rules):
        applies = F.lit(True) if r.applies is None else F.coalesce(r.applies, F.lit(False))
        aggs += [F.count_if(applies & F.coalesce(r.violation, F.lit(False))).alias(f"v{i}"),
                 F.count_if(applies).alias(f"c{i}")]
    wide = specimens.agg(*aggs)
    def sq(s):
        return "'" + s.replace("'", "\\'") + "'"
    rows = ", ".join(f"{sq(r.rule_id)}, {sq(r.description)}, v{i}, c{i}" for i, r in enumerate(rules))
    return wide.selectExpr(f"stack({len(rules)}, {rows}) AS (RULE_ID, DESCRIPTION, VIOLATIONS, CHECKED)")


def violations(specimens: DataFrame, rule: Rule) -> DataFrame:
    """The violating rows of one rule."""
    cond = F.coalesce(rule.violation, F.lit(False))
    if rule.applies is not None:
        cond = cond & F.coalesce(rule.applies, F.lit(False))
    return specimens.where(cond)


def all_violations(specimens: DataFrame, rules: Sequence[Rule] | None = None, keys: Sequence[str] | None = None) -> DataFrame:
    """Every violation of every rule in one pass: RULE_ID and the row's columns (or `keys`).

    A row's violations are a mask with a bit per rule, computed where the row is read; rows
    with an empty mask go, and the others are listed once per bit.  No shuffle, one scan.
    """
    rules = list(rules or specimen_rules())
    if len(rules) > 63:
        raise ValueError("a mask has room for 63 rules")
    mask = F.lit(0).cast("bigint")
    for i, r in enumerate(rules):
        hit = F.coalesce(r.violation, F.lit(False))
        if r.applies is not None:
            hit = hit & F.coalesce(r.applies, F.lit(False))
        mask = mask.bitwiseOR(F.when(hit, F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint"))
    named = F.array(*[F.struct(F.lit(1 << i).cast("bigint").alias("bit"), F.lit(r.rule_id).alias("rule")) for i, r in enumerate(rules)])
    found = specimens.withColumn("__mask", mask).where("__mask <> 0")
    broken = F.filter(named, lambda x: x["bit"].bitwiseAND(F.col("__mask")) != 0)
    return found.withColumn("__rule", F.explode(broken)).select(
        F.col("__rule.rule").alias("RULE_ID"), *(keys if keys is not None else specimens.columns))


INVENTORY_SETS = {
    1: ["VESSEL", "CRUISE"],
    2: ["VESSEL", "CRUISE", "SPECIES_CODE", "SEX"],
    3: ["SPECIES_CODE", "SEX", "SHELL_CONDITION"],
    4: ["SPECIES_CODE", "SHELL_CONDITION", "EGG_COLOR", "EGG_CONDITION", "CLUTCH_SIZE", "__FEMALE"],
}


def inventories(specimens: DataFrame, factor: str = "SAMPLING_FACTOR") -> DataFrame:
    """The four inventories in one GROUPING SETS pass.

    Inventory 4 covers females only; it groups by a female flag and keeps the
    TRUE group, so all four still share one scan and one shuffle."""
    cols = ["VESSEL", "CRUISE", "SPECIES_CODE", "SEX", "SHELL_CONDITION", "EGG_COLOR", "EGG_CONDITION",
            "CLUTCH_SIZE", "__FEMALE"]
    s = specimens.withColumn("__FEMALE", F.col("SEX") == K.FEMALE)
    sets = [[F.col(c) for c in v] for v in INVENTORY_SETS.values()]
    g = s.groupingSets(sets, *[F.col(c) for c in cols]).agg(
        strict_sum(factor).alias("COUNT"), F.count(F.lit(1)).alias("N"),
        F.grouping_id(*[F.col(c) for c in cols]).alias("__gid"))
    inv = None
    for k, members in INVENTORY_SETS.items():
        gid = sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in members)
        inv = F.when(F.col("__gid") == gid, k) if inv is None else inv.when(F.col("__gid") == gid, k)
    g = g.withColumn("INVENTORY", inv)
    g = g.where((F.col("INVENTORY") != 4) | F.coalesce(F.col("__FEMALE"), F.lit(False)))
    return g.drop("__gid", "__FEMALE")


def ranges(specimens: DataFrame, keys: Sequence[str] = ("SPECIES_CODE", "SEX")) -> DataFrame:
    """D13 (Q15, Q20): min/max length and sampling factor per species x sex,
    NULL when any input is NULL (R's min/max)."""
    from ..functions.nulls import strict_max, strict_min
    return specimens.groupBy(*keys).agg(
        strict_min("LENGTH").alias("MIN_LENGTH"), strict_max("LENGTH").alias("MAX_LENGTH"),
        strict_min("SAMPLING_FACTOR").alias("MIN_SAMPLING_FACTOR"),
        strict_max("SAMPLING_FACTOR").alias("MAX_SAMPLING_FACTOR"))


def orphan_units(units: DataFrame, other: DataFrame, keys: Sequence[str],
                 left_name: str = "units_only", right_name: str = "other_only") -> DataFrame:
    """Unit ids present on one side only (two anti joins)."""
    a = null_safe_join(units.select(*keys).distinct(), other.select(*keys).distinct(), list(keys), "left_anti")
    b = null_safe_join(other.select(*keys).distinct(), units.select(*keys).distinct(), list(keys), "left_anti")
    return (a.withColumn("SIDE", F.lit(left_name))
             .unionByName(b.withColumn("SIDE", F.lit(right_name))))


def reconcile_totals(spec_sum: DataFrame, catch_sum: DataFrame, keys: Sequence[str],
                     cols: Sequence[str] = ("NUMBER_CRAB", "N_ENTRIES")) -> DataFrame:
    """Keys where specimen totals and the catch summary disagree or
    exist on one side only (full outer join, NULL-safe comparison)."""
    l = spec_sum.select(*keys, *[F.col(c).alias(f"SPEC_{c}") for c in cols])
    r = catch_sum.select(*keys, *[F.col(c).alias(f"CATCH_{c}") for c in cols])
    j = null_safe_join(l, r, list(keys), "full")
    differ = None
    for c in cols:
        d = ~F.col(f"SPEC_{c}").eqNullSafe(F.col(f"CATCH_{c}"))
        differ = d if differ is None else differ | d
    return j.where(differ)


__all__ = ["Rule", "specimen_rules", "quality_report", "violations", "all_violations", "inventories", "ranges",
           "orphan_units", "reconcile_totals"]
