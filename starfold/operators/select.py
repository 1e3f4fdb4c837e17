"""Selections: predicates on colors, magnitudes, curves and positions."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.astro import haversine_deg
from ..functions.nulls import is_true
from ..session import pin
from .blocks import cell_join
from .zonejoin import with_cell, with_cover, zone_height


def in_range(c: Column, lo: float | None = None, hi: float | None = None, closed: bool = False) -> Column:
    """``lo < c < hi`` (``<=`` if closed); None leaves an end open."""
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (c >= lo if closed else c > lo)
    if hi is not None:
        cond = cond & (c <= hi if closed else c < hi)
    return cond


def linear(cs: list[Column], coef: list[float], lo: float | None = None, hi: float | None = None) -> Column:
    """``lo < sum(coef * c) < hi``."""
    return in_range(reduce(lambda a, b: a + b, (F.lit(k) * c for k, c in zip(coef, cs))), lo, hi)


def all_of(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds, F.lit(True))


def any_of(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conds, F.lit(False))


def polygon(x: Column, y: Column, points: list[tuple[float, float]]) -> Column:
    """Inside test by counting edge crossings, one term per edge."""
    crossings = F.lit(0)
    for (x1, y1), (x2, y2) in zip(points, points[1:] + points[:1]):
        if y1 == y2:
            continue
        spans = (F.lit(y1) > y) != (F.lit(y2) > y)
        left = x < (x2 - x1) * (y - y1) / (y2 - y1) + x1
        crossings = crossings + F.when(spans & left, 1).otherwise(0)
    return crossings % 2 == 1


def around(ra: Column, dec: Column, ra0: float, dec0: float, radius_deg: float) -> Column:
    return haversine_deg(ra, dec, ra0, dec0) <= radius_deg


def point_source(columns: list[str], limit: float, how: str = "all") -> Column:
    """Star/galaxy cut; scans accept a star by ``any`` band, selections ask for ``all``."""
    tests = [F.col(c) < limit for c in columns]
    return all_of(tests) if how == "all" else any_of(tests)


def clean_detection(score: Column, primary: Column, mags: list[Column], min_score: float = 0.9,
                    sentinel: float = -999.0) -> Column:
    """Primary point sources with a value in every band."""
    return all_of([score > min_score, primary == 1] + [m != sentinel for m in mags])


def config_limits(df: DataFrame, limits: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    """Keep rows inside ``{"g": (lo, hi), "g-r": (lo, hi)}``; ``a-b`` is a color. Bounds are inclusive.

    A plain name takes the first of its psf, fiber and total magnitudes that is
    present as a column.
    """
    def value(name: str) -> Column:
        kinds = [k for k in (name, f"psf_mag_{name}", f"fiber_mag_{name}", f"total_mag_{name}") if k in df.columns]
        if not kinds:
            raise ValueError(f"no magnitude column for {name!r}")
        return F.coalesce(*[F.col(k) for k in kinds])

    for key, (lo, hi) in limits.items():
        a, dash, b = key.partition("-")
        c = value(a.strip()) - value(b.strip()) if dash else value(a.strip())
        df = df.where(in_range(c, lo, hi, closed=True))
    return df


def parallax_snr(parallax: Column, error: Column, snr: float = 10.0) -> Column:
    return (parallax > 0) & (F.try_divide(parallax, error) > snr)


def ring_index(radius: Column, width: float) -> Column:
    """Ring ``k`` holds ``k*width < R <= (k+1)*width``."""
    return (F.ceil(radius / width) - 1).cast("int")


def curve_side(df: DataFrame, x: str, y: str, curve: list[tuple[float, float]], direction: str, name: str,
               extend: bool = False, dm: float = 0.0, sigma: tuple[float, float] = (0.0, 0.0)) -> DataFrame:
    """Flag rows on one side of an interpolated curve x(y).

    ``curve`` is the isochrone as (color, absolute magnitude[, color error,
    magnitude error]) points, a few hundred at most, so it travels as a literal.
    Outside its magnitude range the flag is false, or with ``extend`` the end
    colors go on. ``name`` must be a new column.
    """
    shifted = []
    for p in curve:
        ex, ey = (p[2], p[3]) if len(p) > 2 else (0.0, 0.0)
        shifted.append((p[0] + sigma[0] * ex, p[1] + dm + sigma[1] * ey))
    pts = sorted(shifted, key=lambda p: p[1])
    ys = F.array(*[F.lit(float(p[1])) for p in pts])
    xs = F.array(*[F.lit(float(p[0])) for p in pts])
    v, last = F.col(y), len(pts)
    kept = df.columns
    # number of points not fainter than v, by halving steps
    df = df.withColumn("_pos", F.lit(0))
    for step in reversed([1 << b for b in range(last.bit_length())]):
        ahead = F.col("_pos") + step
        df = df.withColumn("_pos", F.when((ahead <= last) & (F.get(ys, ahead - 1) <= v), ahead).otherwise(F.col("_pos")))
    k = F.least(F.col("_pos"), F.lit(last - 1))
    y0, y1 = F.get(ys, k - 1), F.get(ys, k)
    x0, x1 = F.get(xs, k - 1), F.get(xs, k)
    inside = (v >= pts[0][1]) & (v <= pts[-1][1])
    at = F.when(inside, x0 + (x1 - x0) * F.coalesce(F.try_divide(v - y0, y1 - y0), F.lit(0.0)))
    if extend:
        at = F.when(v < pts[0][1], F.lit(float(pts[0][0]))).when(v > pts[-1][1], F.lit(float(pts[-1][0]))).otherwise(at)
    side = F.col(x) >= at if direction == "+" else F.col(x) <= at
    return pin(df.select(*kept, is_true(side).alias(name)), name)


def hashed_uniform(*parts: Column) -> Column:
    """A number in (0, 1) that depends on the parts only: 52 bits of the MD5 of their texts joined by ``/``."""
    digest = F.md5(F.concat_ws("/", *[p.cast("string") for p in parts]).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") + 0.5) / F.lit(float(1 << 52))


def probability_cut(lp: Column, population: int, limit: float) -> Column:
    return is_true(F.get(lp, F.lit(population)) > limit)


def probability_sampling(lp: Column, population: int, key: Column, seed: int) -> Column:
    """Keep a star with its membership probability."""
    return is_true(F.get(lp, F.lit(population)) > F.log(hashed_uniform(key, F.lit(seed))))


def random_mask(p: Column, key: Column, seed: int) -> Column:
    """One hashed Bernoulli draw per population."""
    return F.transform(p, lambda v, k: F.coalesce(v > hashed_uniform(key, F.lit(seed), k), F.lit(False)))


def in_view(df: DataFrame, pointings: list[dict], radius_deg: float = 0.75,
            pos: tuple[str, str] = ("ra", "dec")) -> DataFrame:
    """One row per (target, pointing) closer than the radius, with the pointing's columns.

    The circles of the pointings are listed by cell of the sky and joined with
    the targets' cells; a target meets only pointings near it. The pointings,
    survey configuration, go to the targets; the engine can't tell the size of
    rows from Python and would broadcast the targets instead. The declinations
    that all pointings span reach the scan.
    """
    ra, dec = pos
    names = ["pointing_idx", "stage", "ra", "dec", "posang"]
    kinds = "pointing_idx int, stage int, p_ra double, p_dec double, p_posang double"
    rows = [tuple(p.get(n) if n in ("pointing_idx", "stage") else float(p.get(n) or 0.0) for n in names) for p in pointings]
    views = df.sparkSession.createDataFrame(rows, kinds)
    h = zone_height(radius_deg)
    span = F.col(dec).between(min(p["dec"] for p in pointings) - radius_deg, max(p["dec"] for p in pointings) + radius_deg)
    met = cell_join(with_cell(df.where(span), ra, dec, h), F.broadcast(with_cover(views, "p_ra", "p_dec", h, radius_deg)))
    return met.where(haversine_deg(F.col(ra), F.col(dec), F.col("p_ra"), F.col("p_dec")) < radius_deg)


def forbidden(df: DataFrame, key: str, listed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that are not on the list, listed ids that are not in ``df``)."""
    ids = listed.select(key).distinct()
    return df.join(ids, key, "left_anti"), ids.join(df.select(key).distinct(), key, "left_anti")


def forbidden_pairs(df: DataFrame, key: str, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pairs t1, t2 whose targets are both in ``df``, pairs to skip because one is not)."""
    ids = df.select(key)
    kept = (pairs.join(ids.withColumnRenamed(key, "t1"), "t1", "left_semi")
            .join(ids.withColumnRenamed(key, "t2"), "t2", "left_semi"))
    return kept, pairs.join(kept, ["t1", "t2"], "left_anti")


def subset(df: DataFrame, **values) -> DataFrame:
    """Rows whose columns take the given value or one of the given values."""
    for name, v in values.items():
        df = df.where(F.col(name).isin(list(v)) if isinstance(v, (list, tuple, set)) else F.col(name) == v)
    return df


@dataclass(frozen=True)
class FieldCuts:
    """Selection limits of a field. ``nb`` lists the accepted regions of the color–color plane;
    each is a dict with any of ``gi``, ``gn`` ranges and a ``line`` (slope on gi, lower limit)."""

    broad: tuple[float | None, float | None]
    nb: tuple[dict, ...] = ()
    blue: float = 0.12
    bright: float = 16.0
    faint: float = 23.5
    red_bright_offset: float | None = None
    color: str = "gi0"         # columns of the field's color and red magnitude
    red: str = "i0"
    point: bool = True         # whether the field's selection asks for point sources
    allows_blue: bool = True   # whether blue stars can be let in
    cone: tuple[float, float, float] | None = None     # center and radius in degrees, where the selection has one


# Selection limits per field.
FIELD_CUTS: dict[str, FieldCuts] = {
    "ursaminor": FieldCuts((0.12, 2.0), (dict(gi=(0.12, 0.5)), dict(gn=(0.1, None), gi=(None, 1.65)),
                                         dict(line=(-0.25, -0.15)))),
    "draco": FieldCuts((0.0, 2.0), (dict(gi=(0.0, 0.5)), dict(gn=(0.05, None), gi=(None, 1.65)),
                                    dict(line=(-0.25, -0.16)))),
    "bootes": FieldCuts((0.1, 1.5), bright=17.0, faint=23.0, color="gr0", red="r0", point=False),
    "sextans": FieldCuts((0.12, 2.0), (dict(gi=(0.12, 0.5)), dict(gn=(0.2, None), gi=(None, 1.8)),
                                       dict(line=(-0.25, -0.10))), red_bright_offset=1.5,
                          cone=(153.26208333333333, -1.6147222222222222, 2.5)),
    "fornax": FieldCuts((0.12, 2.5), (dict(gi=(None, 0.0)), dict(line=(0.25, 0.2), gi=(0.1, 1.5)),
                                      dict(line=(-0.33, -0.66), gi=(1.5, None))), faint=23.0, point=False),
    "sculptor": FieldCuts((0.12, 2.0), (dict(gi=(0.12, 0.5)), dict(gn=(0.1, None), gi=(None, 2.0)),
                                        dict(line=(-0.25, -0.15))), point=False),
    "ngc6822": FieldCuts((None, 2.75), (dict(gi=(None, 0.0)), dict(line=(0.25, 0.25), gi=(0.1, 1.5)),
                                        dict(line=(-0.33, -0.62), gi=(1.5, None))), bright=18.0, faint=23.0, point=False),
    "m31": FieldCuts((0.95, 4.0), (dict(gi=(0.12, 0.5)), dict(gn=(0.05, None), gi=(None, 4.0))),
                     bright=19.0, faint=30.0, point=False),
    "cluster": FieldCuts((-0.1, 1.0), bright=14.0, faint=22.0, color="gr0", red="r0", point=False, allows_blue=False),
}


def narrow_band(cuts: FieldCuts, gi: Column, gn: Column) -> Column:
    """Any of the field's regions of the (g-i, g-nb) plane."""
    regions = []
    for region in cuts.nb:
        tests = []
        if "gi" in region:
            tests.append(in_range(gi, *region["gi"]))
        if "gn" in region:
            tests.append(in_range(gn, *region["gn"]))
        if "line" in region:
            slope, lo = region["line"]
            tests.append(linear([gi, gn], [slope, 1.0], lo))
        regions.append(all_of(tests))
    return any_of(regions)


def field_selection(cuts: FieldCuts, g: Column, gi: Column, gn: Column | None = None, nb: bool = True,
                    blue: bool = False, probcut: Column | None = None, i: Column | None = None,
                    bright: float | None = None, faint: float | None = None,
                    point: Column | None = None, pos: tuple[Column, Column] | None = None) -> Column:
    """Broad color, narrow band and probability; blue stars are let in *before* the magnitude cut.

    With ``pos`` (RA, Dec) the field's cone applies, where it has one. Blue
    stars can't be asked for where the field doesn't allow them.
    """
    if blue and not cuts.allows_blue:
        raise ValueError("this selection has no rule for blue stars")
    bright = cuts.bright if bright is None else bright
    faint = cuts.faint if faint is None else faint
    cond = in_range(gi, *cuts.broad)
    if nb and cuts.nb and gn is not None:
        cond = cond & narrow_band(cuts, gi, gn)
    if probcut is not None:
        cond = cond & probcut
    if blue:
        cond = is_true(cond) | in_range(gi, None, cuts.blue)
    cond = cond & in_range(g, bright, faint)
    if cuts.red_bright_offset is not None and i is not None:
        cond = cond & in_range(i, bright - cuts.red_bright_offset, faint)
    if point is not None:
        cond = cond & point
    if pos is not None and cuts.cone is not None:
        cond = cond & around(*pos, *cuts.cone)
    return is_true(cond)
