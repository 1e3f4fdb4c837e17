"""Priority rules: an ordered list of overwrites, written as data.

Each rule is a SQL predicate over the star's columns and the priority so far.
Rules run in order and later ones win; this is not a first-match CASE. Inputs:
``g0 i0 gi0 gn0`` (dereddened), ``p_member``, ``cli clg`` and, where proper
motions take part, ``pmra err_pmra pmdec err_pmdec``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.nulls import is_true
from ..session import pin


@dataclass(frozen=True)
class Rule:
    name: str
    when: str                   # SQL predicate; ``priority`` and ``code`` are the values so far
    value: float | str          # number or SQL expression; RINT[...] rounds half to even
    code: int | None = None     # class code set along with the priority


@dataclass(frozen=True)
class RuleSet:
    rules: tuple[Rule, ...]
    keep: str                   # rows that keep their priority; all others get -1
    exposure: str               # SQL expression of the exposure time


def render(text: float | str, dialect: str = "spark") -> str:
    """SQL text of a rule value for Spark or for the oracle."""
    text = repr(float(text)) if isinstance(text, (int, float)) else text
    return re.sub(r"RINT\[([^\]]*)\]", r"rint(\1)" if dialect == "spark" else r"round_even(\1, 0)", text)


def pm_outlier(pm: tuple[float, float], err: tuple[float, float], sigma: float = 3.0, guard: str = "true") -> str:
    """Predicate: proper motion off the systemic one by more than ``sigma``, errors known."""
    return (f"({guard}) AND pmra IS NOT NULL AND pmdec IS NOT NULL AND err_pmra >= 0 AND err_pmdec >= 0 AND "
            f"sqrt(power(pmra - ({pm[0]}), 2) / (power(err_pmra, 2) + power({err[0]}, 2)) + "
            f"power(pmdec - ({pm[1]}), 2) / (power(err_pmdec, 2) + power({err[1]}, 2))) > {sigma}")


def apply_rules(df: DataFrame, rules: tuple[Rule, ...] | list[Rule], start: float = -1.0) -> DataFrame:
    """Run the rules in order; adds ``priority`` and ``code``."""
    df = df.withColumns({"priority": F.lit(float(start)), "code": F.lit(0)})
    for rule in rules:
        hit = is_true(F.expr(rule.when))
        new = {"priority": F.when(hit, F.expr(f"CAST({render(rule.value)} AS DOUBLE)")).otherwise(F.col("priority"))}
        if rule.code is not None:
            new["code"] = F.when(hit, F.lit(rule.code)).otherwise(F.col("code"))
        df = df.withColumns(new)
    return pin(df, "priority", "code")


def assign_priorities(df: DataFrame, rule_set: RuleSet) -> DataFrame:
    """Priority and exposure time; stars that are not kept get -1 and no exposure time."""
    out = apply_rules(df, rule_set.rules)
    keep = is_true(F.expr(rule_set.keep))
    return out.withColumns({
        "exp_time": F.when(keep, F.expr(render(rule_set.exposure)).cast("double")),
        "priority": F.when(keep, F.col("priority")).otherwise(F.lit(-1.0)),
    }).drop("code")


def exposure_sqrt(mag: str, most: int = 6) -> str:
    return f"1800e0 * greatest(least(RINT[5e0 * sqrt(power(10e0, ({mag} - 19e0) / 2.5e0)) + 1e0], {most}e0), 1e0)"


def exposure_linear(mag: str, most: int = 6) -> str:
    return f"1800e0 * greatest(least(RINT[5e0 * (({mag} - 16e0) / 7e0) + 1e0], {most}e0), 1e0)"


def clipped_ladder(mag: str, lo: float, hi: float, top: tuple[float, float, float],
                   bottom: tuple[float, float, float], most: float) -> str:
    """``clip(bot - rint(p * (bot - top)), 0, most)``; top and bottom fall with magnitude.

    ``top`` and ``bottom`` are (steps, offset, least value).
    """
    def level(steps, offset, least):
        return f"greatest(floor(({mag} - {lo}e0) / ({hi}e0 - {lo}e0) * {steps}e0) + ({offset}e0), {least}e0)"
    t, b = level(*top), level(*bottom)
    return f"least(greatest({b} - RINT[p_member * ({b} - {t})], 0e0), {most}e0)"


@dataclass(frozen=True)
class Wedge:
    """Blue-straggler strip between two slanted lines."""

    x: tuple[float, float, float, float]
    y: tuple[float, float]

    def sql(self) -> str:
        x1, x2, x3, x4 = self.x
        y1, y3 = self.y
        return (f"g0 > {y1} AND g0 < {y3} AND (g0 - {y1}) < {(y3 - y1) / (x3 - x1)!r}e0 * (gi0 - ({x1})) "
                f"AND (g0 - {y1}) > {(y3 - y1) / (x4 - x2)!r}e0 * (gi0 - ({x2}))")


_NO_P = "(p_member IS NULL OR p_member = 0)"
_POINT = "cli < 0.5 AND clg < 0.5"
_KEPT = f"g0 >= 16 AND g0 <= 23 AND i0 >= 16 AND i0 < 23 AND {_POINT} AND priority >= 0 AND priority <= 9"


def _member(p: str, g: str) -> str:
    return f"priority = -1 AND p_member > {p} AND g0 < {g}"


# Systemic proper motion (mas/yr) and its error per field.
SYSTEMIC_PM = {
    "ursaminor": ((-0.119, 0.072), (0.005, 0.005)),
    "draco": ((0.046, -0.188), (0.006, 0.006)),
    "bootes": ((-0.387, -1.064), (0.122, 0.098)),
    "sextans": ((-0.260, 0.100), (0.410, 0.440)),
    "fornax": ((0.381, -0.358), (0.001, 0.002)),
    "sculptor": ((0.101, -0.156), (0.003, 0.002)),
}


def _demote(field: str, guard: str) -> Rule:
    return Rule("proper-motion non-members", pm_outlier(*SYSTEMIC_PM[field], guard=guard), 9)


_BOOST = Rule("known members", "boosted", 0)


def _rgb_field(field: str, ladder: list[Rule], hb: str, wedge: Wedge, tip: str | None, agb: str,
               unknown: str = _NO_P, keep: str = _KEPT, mag: str = "i0", wedge_guard: str = "true",
               demote_guard: str = "true", boost: bool = True) -> RuleSet:
    """The common shape of the galaxies with narrow-band data; ``blue_side`` and ``nb`` are flag columns."""
    rules = [Rule("no membership", unknown, 9),
             Rule("bright likely members", "p_member > 0.8 AND g0 < 22.5", 0), *ladder,
             Rule("horizontal branch", f"priority = 9 AND {hb}", 3)]
    if agb:
        rules.append(Rule("asymptotic giants", f"blue_side AND priority = 9 AND {agb}", 3))
    if tip:
        rules.append(Rule("tip of the giant branch", f"priority = 9 AND {tip} AND nb", 3))
    rules += [Rule("faint likely members", "priority = -1 AND p_member > 0.0", 8),
              Rule("blue stragglers", f"priority = 9 AND {wedge_guard} AND {wedge.sql()}", 4),
              _demote(field, f"{demote_guard} AND priority >= 0 AND p_member > 0")]
    if boost:
        rules.append(_BOOST)
    return RuleSet(tuple(rules), keep, exposure_sqrt(mag))


_TWO_STEPS = [Rule("likely members", _member("0.7", "22.5"), 1), Rule("possible members", _member("0.0", "22.5"), 2)]
_SIX_STEPS = [
    Rule("bright, high probability", "priority = -1 AND p_member > 0.7 AND g0 < 19.5", 1),
    Rule("medium, high probability", "priority = -1 AND p_member > 0.7 AND g0 >= 19.5 AND g0 < 21.0", 2),
    Rule("faint, high probability", "priority = -1 AND p_member > 0.7 AND g0 >= 21.0 AND g0 < 22.5", 2.1),
    Rule("bright, low probability", "priority = -1 AND p_member > 0.0 AND p_member <= 0.7 AND g0 < 19.5", 2.2),
    Rule("medium, low probability",
         "priority = -1 AND p_member > 0.0 AND p_member <= 0.7 AND g0 >= 19.5 AND g0 < 21.0", 2.3),
    Rule("faint, low probability",
         "priority = -1 AND p_member > 0.0 AND p_member <= 0.7 AND g0 >= 21.0 AND g0 < 22.5", 2.4),
]
_UMI_HB = "g0 > 19.4 AND g0 < 20.2 AND gi0 > -0.5 AND gi0 < 0.2"
_UMI_AGB = "g0 > 17.25 AND g0 < 19.8 AND gi0 > -0.5 AND gn0 > 0.25 * gi0 - 0.15 AND g0 > 19.25 - 1.5 * gi0"
_UMI_TIP = "g0 >= 16.8 AND g0 <= 18.5 AND gi0 >= 0.75 AND gi0 <= 1.8"
_UMI_WEDGE = Wedge((-0.7, -0.2, -0.2, 0.3), (20.8, 23.0))
_SEXTANS_KEPT = _KEPT.replace("i0 >= 16", "i0 >= 15")


def _formula_field(field: str, ladder: str, extra: list[Rule], bright: str, faint: str, mag: str,
                   keep: str = "g0 < 23 AND priority <= 9 AND code = 0", exposure: str | None = None,
                   demote: bool = True, boost: bool = False) -> RuleSet:
    """Fields whose priority is a continuous function of probability and magnitude."""
    rules = [Rule("probability ladder", "p_member IS NOT NULL", ladder), Rule("no membership", _NO_P, 9, 0), *extra,
             Rule("very bright", f"{bright} AND cli <= 0.5 AND clg <= 0.5", 9, 1),
             Rule("very faint", f"{faint} AND cli <= 0.5 AND clg <= 0.5", 9, 2),
             Rule("extended", "cli > 0.5 OR clg > 0.5", 9, 3)]
    if demote:
        rules.append(_demote(field, "code = 0 AND p_member > 0"))
    if boost:
        rules.append(Rule("known members", "boosted", 0, 0))
    return RuleSet(tuple(rules), keep, exposure or exposure_linear(mag))


_STEEP = ((8, -7, -7), (6, 3, 3))

# The rule sets per field.
RULES: dict[str, RuleSet] = {
    "ursaminor": _rgb_field("ursaminor", _SIX_STEPS, _UMI_HB, _UMI_WEDGE, _UMI_TIP, _UMI_AGB),
    "ursaminor_v1": _rgb_field("ursaminor", _TWO_STEPS, _UMI_HB, _UMI_WEDGE, _UMI_TIP, _UMI_AGB),
    "ursaminor_old": _formula_field(
        "ursaminor", clipped_ladder("g0", 17, 23, (4, 0, 0), (4, 4, 4), 8),
        [Rule("horizontal branch", f"{_UMI_HB} AND cli <= 0.5 AND clg < 0.5", 6, 0),
         Rule("blue stragglers", f"priority = 9 AND {_UMI_WEDGE.sql()}", 7, 0)],
        "i0 <= 16", "(g0 >= 23 OR i0 >= 23)", "i0", exposure=exposure_sqrt("i0"), boost=True),
    "draco": _rgb_field(
        "draco", _TWO_STEPS, "g0 > 19.2 AND g0 < 20.7 AND gi0 > -0.7 AND gi0 < 0.2",
        Wedge((-1.0, -0.2, -0.6, 0.3), (20.8, 23.0)), None,
        "g0 > 17.25 AND g0 < 20.6 AND gi0 > -0.5 AND gn0 > 0.25 * gi0 - 0.15 AND g0 > 19.15 - 1.5 * gi0"),
    "bootes": RuleSet((
        Rule("no membership", f"{_NO_P} AND g0 > 17.5", 9),
        Rule("bright likely members", "p_member > 0 AND g0 < 20.0", 0),
        Rule("likely members", _member("0.5", "22.5"), 1),
        Rule("possible members", _member("0.0", "22.5"), 4),
        Rule("horizontal branch", "priority = 9 AND g0 > 19.2 AND g0 < 20 AND gr0 > -0.5 AND gr0 < 0.1", 2),
        Rule("blue stragglers", "priority = 9 AND g0 >= 21 AND g0 <= 23 AND gr0 >= -0.5 AND gr0 <= 0.2", 3),
        Rule("faint likely members", "priority = -1 AND p_member > 0.0", 5),
        Rule("blue of the giant branch", "blue_side AND priority = 9 AND g0 > 17.2 AND g0 < 22 AND gr0 > -0.5", 6),
        _demote("bootes", "priority >= 0 AND p_member > 0"),
    ), "g0 >= 16 AND g0 <= 23 AND r0 >= 16 AND r0 < 23 AND gr0 >= -0.4 AND gr0 < 2 AND priority >= 0 AND priority <= 9",
        exposure_sqrt("r0")),
    "sextans": _rgb_field(
        "sextans", _TWO_STEPS, "g0 > 19.8 AND g0 < 20.5 AND gi0 > -0.7 AND gi0 < 0.1 AND gn0 > -0.1 AND gn0 < 0.1 AND near",
        Wedge((-1.0, -0.2, -0.5, 0.3), (21.5, 23.0)), "g0 >= 16.8 AND g0 <= 18.5 AND gi0 >= 0.75 AND gi0 <= 2.0 AND near",
        "", unknown=f"{_NO_P} AND near AND g0 >= 16 AND g0 <= 23 AND i0 >= 15 AND i0 < 23 AND {_POINT}",
        keep=_SEXTANS_KEPT, mag="g0", wedge_guard="gn0 > -0.15 AND gn0 < 0.2 AND near", demote_guard="near", boost=False),
    "fornax": _formula_field(
        "fornax", clipped_ladder("g0", 16, 23, *_STEEP, 9),
        [Rule("blue", "gi0 < 0.12 AND clg <= 0.5", 9, 0),
         Rule("horizontal branch",
              "i0 > 20.8 AND i0 < 21.6 AND gi0 > -0.5 AND gi0 < 0.4 AND cli <= 0.5 AND clg < 0.5", 6, 0)],
        "i0 <= 16", "g0 >= 23", "i0"),
    "sculptor": _formula_field(
        "sculptor", clipped_ladder("i0", 16, 21.5, *_STEEP, 9),
        [Rule("horizontal branch",
              "g0 > 19.6 AND g0 < 20.2 AND gi0 > -0.5 AND gi0 < 0.2 AND cli <= 0.5 AND clg < 0.5", 6, 0)],
        "i0 <= 16", "i0 >= 21.5", "i0"),
    "ngc6822": RuleSet((
        Rule("in range", "g0 > 18 AND g0 < 23", 9),
        Rule("blue main sequence", "selected AND g0 > 18 AND g0 < 23 AND gi0 <= 0",
             "least(greatest(8e0 - RINT[4e0 * (g0 - 23e0) / (18e0 - 23e0)], 0e0), 8e0)"),
        Rule("red giants", "selected AND g0 > 18 AND g0 < 23 AND gi0 > 0",
             "least(greatest(4e0 - RINT[4e0 * (g0 - 23e0) / (18e0 - 23e0)], 0e0), 8e0)"),
        Rule("very bright", "g0 <= 18 AND cli <= 0.5 AND clg <= 0.5", 9, 1),
        Rule("very faint", "g0 >= 23 AND cli <= 0.5 AND clg <= 0.5", 9, 2),
        Rule("extended", "cli > 0.5 OR clg > 0.5", 9, 3),
    ), "g0 < 23 AND priority <= 9 AND code = 0", exposure_linear("i0")),
    "m31": RuleSet((
        Rule("no membership", "(p_member IS NULL OR p_member <= 0.1) AND i0 < 23.0 AND i0 > 20.0", 9),
        Rule("sure, bright", "priority = -1 AND p_member > 0.95 AND i0 < 22.25", 1),
        Rule("sure, faint", "priority = -1 AND p_member > 0.95 AND i0 < 23.0", 2),
        Rule("likely, bright", "priority = -1 AND p_member > 0.8 AND i0 < 22.25", 3),
        Rule("likely, faint", "priority = -1 AND p_member > 0.8 AND i0 < 23.0", 4),
        Rule("possible, bright", "priority = -1 AND p_member > 0.1 AND i0 < 22.25", 5),
        Rule("possible, faint", "priority = -1 AND p_member > 0.1 AND i0 < 23.0", 6),
    ), f"g0 > 19 AND g0 < 30 AND i0 > 19 AND i0 < 30 AND {_POINT} AND priority >= 0 AND priority <= 9",
        exposure_sqrt("i0", 10)),
    "m31_old": _formula_field(
        "m31", clipped_ladder("i0", 21, 24.5, *_STEEP, 9), [], "i0 <= 21", "i0 >= 24", "i0",
        keep="i0 < 25 AND g0 < 24.5 AND priority <= 9 AND code <= 2", exposure=exposure_sqrt("i0", 10), demote=False),
}

# The wedge classification used where no membership map exists.
WEDGE_RULES: tuple[Rule, ...] = (
    Rule("brightness ladder", "g0 > 16 AND g0 < 23", "RINT[11e0 * (g0 - 16e0) / (23e0 - 16e0)] + 1e0"),
    Rule("off the blue wedge", "gi0 < 0.6 AND (i0 < -(0.65e0 / 0.6e0) * gi0 + 22.4e0 OR i0 > -(1.75e0 / 0.9e0) * gi0 + 23.5e0)", 13),
    Rule("off the red wedge", "gi0 >= 0.6 AND (i0 < -(5.75e0 / 0.3e0) * gi0 + 33.25e0 OR i0 > -(5.75e0 / 0.65e0) * gi0 + 28.38e0)", 13),
    Rule("too bright", "g0 <= 16", 13),
    Rule("too faint", "g0 >= 23", 13),
)


def required_visits(exp_time: Column, visit_time: float) -> Column:
    return F.coalesce(F.ceil(F.try_divide(exp_time, F.lit(float(visit_time)))), F.lit(0)).cast("int")
