"""Deprojection by iterative whitening, radial profiles and profile choice."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.geometry import Whitening, king, sersic
from ..session import cut
from .pmap import bin_of


def _eigen(cxx: float, cxy: float, cyy: float) -> tuple[tuple[float, float], tuple[tuple[float, float], tuple[float, float]]]:
    """Eigenvalues (falling) and unit eigenvectors of a symmetric 2×2 matrix."""
    mid, diff = (cxx + cyy) / 2, math.hypot((cxx - cyy) / 2, cxy)
    big, small = mid + diff, mid - diff
    angle = 0.5 * math.atan2(2 * cxy, cxx - cyy)
    c, s = math.cos(angle), math.sin(angle)
    return (big, small), ((c, s), (-s, c))


def fit_whitening(df: DataFrame, x: str, y: str, iterations: int = 10, r_cut: float | None = None,
                  s_cut: list[float] | float | None = None, mask: Column | None = None,
                  callback: Callable[[int, dict, Whitening], None] | None = None) -> Whitening:
    """Mean and axes of a sigma-clipped cloud of points.

    One aggregate per iteration; the driver sees six numbers each time, never
    rows. The cut is 2 sigma in the first half and 2.8 after it by default and
    is taken from all points, not only from those kept before.
    """
    if s_cut is None:
        s_cut = [2.0] * (iterations // 2) + [2.8] * (iterations - iterations // 2)
    elif not isinstance(s_cut, (list, tuple)):
        s_cut = [float(s_cut)] * iterations
    points = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"),
                       (mask if mask is not None else F.lit(True)).alias("m"))
    points = cut(points)      # read once more in every iteration, from the shared folder
    px, py = F.col("x"), F.col("y")
    keep = F.col("m")
    if r_cut is not None:
        keep = keep & (px * px + py * py < r_cut**2)
    fit = None
    for it in range(iterations):
        a = points.where(keep).agg(F.avg("x").alias("mx"), F.avg("y").alias("my"), F.var_samp("x").alias("cxx"),
                                   F.var_samp("y").alias("cyy"), F.covar_samp("x", "y").alias("cxy"),
                                   F.count(F.lit(1)).alias("n")).first().asDict()
        if a["n"] < 2 or a["cxx"] is None:
            raise ValueError("too few points to whiten")
        (big, small), (v1, v2) = _eigen(a["cxx"], a["cxy"], a["cyy"])
        if small <= 0:
            raise ValueError("points lie on a line")
        w = (tuple(v / math.sqrt(big) for v in v1), tuple(v / math.sqrt(small) for v in v2))
        fit = Whitening((a["mx"], a["my"]), w)
        if callback is not None:
            callback(it, a, fit)
        keep = fit.radius(px, py) < float(s_cut[it])
    return fit


def radial_profile(df: DataFrame, radius: Column, r_max: float, bins: int, by: list[str] | None = None) -> DataFrame:
    """(by…, bin, r, n, log_s, log_s_sigma): log surface density with Poisson errors; empty bins are NULL.

    Empty bins inside the range are listed too, so that profiles line up.
    """
    by = by or []
    width = r_max / bins
    counts = (df.withColumn("bin", bin_of(radius, 0.0, r_max, bins)).where("bin IS NOT NULL")
              .groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("n")))
    if by:
        groups = df.select(*by).distinct()
    else:
        groups = df.sparkSession.range(1).select()
    grid = groups.select(*by, F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    full = grid.join(counts, by + ["bin"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    area = F.lit(math.pi * width * width) * (2 * F.col("bin") + 1)
    n = F.col("n")
    return full.select(*by, "bin", ((F.col("bin") + 0.5) * width).alias("r"), "n",
                       F.when(n > 0, F.log(n / area)).alias("log_s"),
                       F.when(n > 0, 1.0 / F.sqrt(n)).alias("log_s_sigma"))


def choose_profile(profile: DataFrame, grid: list[dict[str, float]], model: str, by: list[str] | None = None) -> DataFrame:
    """The grid point with the least chi-square per field.

    ``model`` is ``king`` (s_b, s_0, r_c, r_t) or ``sersic`` (s_0, s_e, r_e,
    n). The grid is a driver-side parameter list; bins per field are few.
    """
    by = by or []
    names = {"king": ("s_b", "s_0", "r_c", "r_t"), "sersic": ("s_0", "s_e", "r_e", "n")}[model]
    points = F.array(*[F.struct(F.lit(k).alias("k"), *[F.lit(float(g[p])).alias(p) for p in names])
                       for k, g in enumerate(grid)])
    long = profile.where("log_s IS NOT NULL").withColumn("g", F.explode(points))
    args = [F.col(f"g.{p}") for p in names]
    value = F.log((king if model == "king" else sersic)(F.col("r"), *args))
    term = F.pow((F.col("log_s") - value) / F.col("log_s_sigma"), F.lit(2.0))
    chi = long.groupBy(*by, F.col("g.k").alias("k")).agg(F.sum(term).alias("chi2"), F.first("g").alias("g"))
    best = chi.groupBy(*by).agg(F.min(F.struct("chi2", "k", "g")).alias("b"))
    return best.select(*by, F.col("b.k").alias("grid_idx"), F.col("b.chi2").alias("chi2"),
                       *[F.col(f"b.g.{p}").alias(p) for p in names])


def half_light_radius(profile: DataFrame, background: float, by: list[str] | None = None) -> DataFrame:
    """Radius that holds half of the background-subtracted counts, interpolated between bin centers."""
    by = by or []
    width = F.col("r") / (F.col("bin") + 0.5)
    area = F.lit(math.pi) * width * width * (2 * F.col("bin") + 1)
    net = F.greatest(F.col("n") - background * area, F.lit(0.0))
    # the window sees the bins of one profile, never the stars
    w = Window.partitionBy(*by).orderBy("bin")
    cum = (profile.withColumn("c", F.sum(net).over(w.rowsBetween(Window.unboundedPreceding, 0)))
           .withColumn("c0", F.lag("c").over(w)).withColumn("r0", F.lag("r").over(w))
           .withColumn("half", F.max("c").over(Window.partitionBy(*by)) / 2))
    hit = cum.where((F.col("c") >= F.col("half")) & (F.col("c0") <= F.col("half")) & (F.col("c") > F.col("c0")))
    at = F.col("r0") + (F.col("r") - F.col("r0")) * (F.col("half") - F.col("c0")) / (F.col("c") - F.col("c0"))
    return hit.groupBy(*by).agg(F.min(at).alias("r_half"))


def ellipse_points(radii: DataFrame, radius: str, white: Whitening | None = None, steps: int = 360) -> DataFrame:
    """World coordinates of the curves of constant deprojected radius."""
    phi = F.col("step") * (2 * math.pi / (steps - 1))
    df = radii.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(steps - 1))))
    u, v = F.col(radius) * F.cos(phi), F.col(radius) * F.sin(phi)
    x, y = white.reverse(u, v) if white is not None else (u, v)
    return df.withColumns({"x": x, "y": y})
