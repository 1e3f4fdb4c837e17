"""Derived columns of target lists: extras, defaults, codes, lists of fluxes."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from .ids import dense_id


@dataclass(frozen=True)
class ExtraColumn:
    """One extra column: exactly one of constant, expression or pattern (constant wins over nothing)."""

    name: str
    dtype: str = "string"
    constant: Any = None
    expression: str | Callable[..., Column] | None = None
    args: tuple[str, ...] = ()
    pattern: str | None = None
    default: Any = None

    def kind(self) -> str:
        given = [k for k in ("constant", "expression", "pattern") if getattr(self, k) is not None]
        if len(given) > 1:
            raise ValueError(f"column {self.name}: give only one of constant, expression and pattern")
        return given[0] if given else "constant"


def constant_column(df: DataFrame, name: str, dtype: str, value: Any = None, default: Any = None) -> DataFrame:
    """The configured value, else the column as it is (recast), else the default."""
    if value is not None:
        return df.withColumn(name, F.lit(value).cast(dtype))
    if name in df.columns:
        return df.withColumn(name, F.col(name).cast(dtype))
    return df.withColumn(name, F.lit(default).cast(dtype))


def expression_column(df: DataFrame, name: str, dtype: str, expression, args: tuple[str, ...] = ()) -> DataFrame:
    c = F.expr(expression) if isinstance(expression, str) else expression(*[F.col(a) for a in args])
    return df.withColumn(name, c.cast(dtype))


def pattern_column(df: DataFrame, name: str, dtype: str, pattern: str, settings: dict[str, Any]) -> DataFrame:
    """``{field}`` is filled once from the settings, ``{{targetid:d}}`` from each row.

    Row formats: ``{col}``, ``{col:d}``, ``{col:05d}``, ``{col:.2f}``.
    """
    import string
    parts, row_text = [], pattern.format(**settings)
    for text, column, spec, _ in string.Formatter().parse(row_text):
        if text:
            parts.append(F.lit(text))
        if column:
            if not spec:
                parts.append(F.col(column).cast("string"))
            elif spec.endswith("d"):
                parts.append(F.format_string(f"%{spec}", F.col(column).cast("bigint")))
            else:
                parts.append(F.format_string(f"%{spec}", F.col(column).cast("double")))
    return df.withColumn(name, F.concat(*parts).cast(dtype))


def add_extra_columns(df: DataFrame, extras: list[ExtraColumn], settings: dict[str, Any] | None = None) -> DataFrame:
    """Constants first, then expressions, then patterns, so that later kinds see earlier ones."""
    by_kind: dict[str, list[ExtraColumn]] = {"constant": [], "expression": [], "pattern": []}
    for e in extras:
        by_kind[e.kind()].append(e)
    for e in by_kind["constant"]:
        df = constant_column(df, e.name, e.dtype, e.constant, e.default)
    for e in by_kind["expression"]:
        df = expression_column(df, e.name, e.dtype, e.expression, e.args)
    for e in by_kind["pattern"]:
        df = pattern_column(df, e.name, e.dtype, e.pattern, settings or {})
    return df


# Defaults of the mandatory columns.
MANDATORY_DEFAULTS = {"epoch": ("double", 2016.0), "catid": ("int", -1), "proposalid": ("string", ""),
                      "tract": ("int", 0), "patch": ("string", "0,0")}


def with_mandatory_columns(df: DataFrame) -> DataFrame:
    """Fill in the columns every list must have; ``obcode`` falls back to the target id."""
    new = {n: F.lit(v).cast(t) for n, (t, v) in MANDATORY_DEFAULTS.items() if n not in df.columns}
    if "obcode" not in df.columns:
        new["obcode"] = F.col("targetid").cast("string")
    return df.withColumns(new) if new else df


def with_targetid(df: DataFrame, source: str | None, order: str) -> DataFrame:
    """``targetid`` from a unique key column, else 1..N in the given order."""
    if source is not None:
        return df.withColumn("targetid", F.col(source).cast("bigint"))
    return dense_id(df, order, "targetid", start=1)


def class_label(prefix: Column, priority: Column) -> Column:
    """``sci_P3``, ``sci_P2.1``; the prefix alone where there is no priority."""
    whole = priority == F.floor(priority)
    label = (F.when(whole, F.format_string("%s_P%d", prefix, priority.cast("bigint")))
             .otherwise(F.format_string("%s_P%s", prefix, F.bround(priority, 1).cast("string"))))
    return F.when((prefix == "sci") & priority.isNotNull(), label).otherwise(prefix)


# Numeric target types.
TARGET_TYPES = {"sci": 1, "sky": 2, "cal": 3, "na": 4, "eng": 5}


def target_type_code(prefix: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(v) for kv in TARGET_TYPES.items() for v in kv]), prefix)


def class_lookup(costs: dict[str, float]) -> Column:
    """Value of the row's class from the survey's class settings; NULL for an unknown class.

    Classes are configuration, so they travel as a literal map: most rows share
    a few classes and must not be shuffled by them.
    """
    return F.element_at(F.create_map(*[F.lit(v) for kv in costs.items() for v in kv]), F.col("class"))


def with_class_costs(df: DataFrame, costs: dict[str, int]) -> tuple[DataFrame, DataFrame]:
    """(rows with ``non_observation_cost`` of their class, rows of unknown classes).

    A cost given on the row goes before the class's.
    """
    known = class_lookup(costs).isNotNull()
    own = F.col("non_observation_cost") if "non_observation_cost" in df.columns else F.lit(None)
    out = df.where(known).withColumn("non_observation_cost", F.coalesce(own.cast("int"), class_lookup(costs).cast("int")))
    return out, df.where(~known)


def pick_population(a: str, g: str) -> Column:
    """The array element of the star's own population."""
    return F.get(F.col(a), F.col(g))


def remap_filters(c: Column, mapping: dict[str, str]) -> Column:
    if not mapping:
        return c
    m = F.create_map(*[F.lit(v) for kv in mapping.items() for v in kv])
    return F.coalesce(F.element_at(m, c), c)


def pointing_code(prefix: str, field: str, stage: Column, pidx: Column, vidx: Column,
                  ridx: Column | None = None) -> Column:
    """``{prefix}_{field}_S1P02V03R00``; stage and repeat are left out when unknown."""
    s = F.when(stage.isNotNull(), F.format_string("S%d", stage.cast("int"))).otherwise("")
    pv = F.format_string("P%02dV%02d", pidx.cast("int"), vidx.cast("int"))
    parts = [F.lit(f"{prefix}_{field}_"), s, pv]
    if ridx is not None:
        parts.append(F.when(ridx >= 0, F.format_string("R%02d", ridx.cast("int"))).otherwise(""))
    return F.concat(*parts)


def design_name(name: str, stage: Column, pidx: Column, n_pointings, vidx: Column, n_visits) -> Column:
    s = F.when(stage.isNotNull(), F.format_string(" S%d", stage.cast("int"))).otherwise("")
    n_p, n_v = (v if isinstance(v, Column) else F.lit(v) for v in (n_pointings, n_visits))
    return F.concat(F.lit(name), s, F.format_string("P%02d/%02d V%02d/%02d", pidx.cast("int"), n_p.cast("int"),
                                                    vidx.cast("int"), n_v.cast("int")))


@dataclass(frozen=True)
class FluxColumns:
    """Where one filter's fluxes are. With ``filter_column`` the flux counts only for rows of that filter."""

    filter: str
    psf: str | None = None
    psf_err: str | None = None
    fiber: str | None = None
    fiber_err: str | None = None
    total: str | None = None
    total_err: str | None = None
    filter_column: str | None = None


FLUX_KINDS = ("psf", "psf_err", "fiber", "fiber_err", "total", "total_err")


def flux_array(specs: list[FluxColumns]) -> Column:
    """All fluxes of a row as one array of structs, in the order of the specs."""
    items = []
    for s in specs:
        values = [(F.col(getattr(s, k)) if getattr(s, k) else F.lit(None)).cast("double").alias(k) for k in FLUX_KINDS]
        own = F.lit(s.filter) if s.filter_column is None else F.when(F.col(s.filter_column) == s.filter, F.lit(s.filter))
        items.append(F.struct(own.alias("filter"), *values))
    return F.filter(F.array(*items), lambda f: f["filter"].isNotNull())


# Replacements for missing values in exported lists.
EXPORT_FILL = {"pmra": 0.0, "pmdec": 0.0, "parallax": 1.0e-5, "tract": -1, "patch": "-1,-1", "exp_time": 0.0}


def export_fill(df: DataFrame) -> DataFrame:
    """Null rules of the exported lists, by kind of target."""
    out = df.na.fill({k: v for k, v in EXPORT_FILL.items() if k in df.columns})
    science, standard = F.col("prefix") == "sci", F.col("prefix") == "cal"
    prob = F.col("prob_f_star") if "prob_f_star" in df.columns else F.lit(1.0)
    return out.withColumns({
        "priority": F.when(science, F.col("priority").cast("int")).otherwise(F.lit(-1)),
        "prob_f_star": F.when(standard, prob).otherwise(F.lit(-1.0)),
    })
