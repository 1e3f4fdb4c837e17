"""Focal-plane joins: which fiber reaches which target, and what would collide.

Positions are binned into square cells (mm) and joined on the cell, as on the
sky. Edges are rows (pointing_idx, fiber_id, target_idx, x, y, dist, …).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import geometry as geo
from ..session import pin
from .blocks import cell_join, grown_join

_HALF = 1 << 20  # cells on each side of the origin, per axis
_PAD = 1e-9  # mm added to a box against rounding


def _key(plane: Column, ix: Column, iy: Column) -> Column:
    return (plane.cast("bigint") * (1 << 42) + (ix.cast("bigint") + _HALF) * (1 << 21) + iy.cast("bigint") + _HALF)


def with_cell(df: DataFrame, x: str, y: str, size: float, plane: str | None = None) -> DataFrame:
    """Cell of each position; cells of different planes (pointings) never meet."""
    p = F.col(plane) if plane else F.lit(0)
    return df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).withColumn(
        "cell", _key(p, F.floor(F.col(x) / size), F.floor(F.col(y) / size)))


def with_box_cover(df: DataFrame, x_lo: Column, x_hi: Column, y_lo: Column, y_hi: Column, size: float,
                   plane: str | None = None) -> DataFrame:
    """List each row under every cell its box touches."""
    p = F.col(plane) if plane else F.lit(0)
    keep = df.columns
    rows = df.withColumns({"_y0": F.floor(y_lo / size), "_y1": F.floor(y_hi / size)}).select(
        *keep, "_y0", "_y1", F.explode(F.sequence(F.floor(x_lo / size), F.floor(x_hi / size))).alias("_ix"))
    return (rows.select(*keep, "_ix", F.explode(F.sequence("_y0", "_y1")).alias("_iy"))
            .withColumn("cell", _key(p, F.col("_ix"), F.col("_iy"))).drop("_ix", "_iy"))


def project_targets(targets: DataFrame, scale: float, pos: tuple[str, str] = ("ra", "dec")) -> DataFrame:
    """Focal-plane position (x, y) of (target, pointing) rows that carry p_ra, p_dec, p_posang.

    The tangent-plane projection in steps: each sine is taken once, and the
    generated code stays in small methods.
    """
    c, kept = F.col, targets.columns
    df = targets.withColumns({
        "_sd": F.sin(F.radians(pos[1])), "_cd": F.cos(F.radians(pos[1])), "_s0": F.sin(F.radians("p_dec")),
        "_c0": F.cos(F.radians("p_dec")), "_da": F.radians(c(pos[0]) - c("p_ra"))})
    df = df.withColumns({"_sa": F.sin("_da"), "_ca": F.cos("_da")})
    df = df.withColumn("_cosc", c("_s0") * c("_sd") + c("_c0") * c("_cd") * c("_ca"))
    df = df.withColumn("_k", F.when(c("_cosc") > 0, F.degrees(F.lit(1.0)) * scale / c("_cosc")))
    df = df.withColumns({"_xi": c("_k") * c("_cd") * c("_sa"),
                         "_eta": c("_k") * (c("_c0") * c("_sd") - c("_s0") * c("_cd") * c("_ca")),
                         "_sp": F.sin(F.radians("p_posang")), "_cp": F.cos(F.radians("p_posang"))})
    df = df.select(*kept, (c("_xi") * c("_cp") - c("_eta") * c("_sp")).alias("x"),
                   (c("_xi") * c("_sp") + c("_eta") * c("_cp")).alias("y"))
    return pin(df, "x", "y")


def plane_pairs(points: DataFrame, centers: DataFrame, radius: float, plane: str | None = None) -> DataFrame:
    """All (point, center) pairs closer than the radius; columns ``x y`` and ``cx cy`` hold the positions."""
    size = max(2.0 * radius, 1e-6)
    p = with_cell(points, "x", "y", size, plane)
    if plane:
        centers = centers.withColumnRenamed(plane, f"_{plane}")
    cx, cy = F.col("cx"), F.col("cy")
    cov = with_box_cover(centers, cx - radius, cx + radius, cy - radius, cy + radius, size, f"_{plane}" if plane else None)
    dist = geo.distance(F.col("x"), F.col("y"), cx, cy)
    near = (F.abs(F.col("x") - cx) <= radius) & (F.abs(F.col("y") - cy) <= radius)
    out = cell_join(p, cov, True).where(near).withColumn("dist", dist)
    return out.drop(f"_{plane}") if plane else out


def on_planes(centers: DataFrame, pointings: list[int], plane: str = "pointing_idx") -> DataFrame:
    """Each center once for each pointing. Pointings are survey configuration and travel as a literal."""
    return centers.withColumn(plane, F.explode(F.array(*[F.lit(int(p)) for p in pointings])))


def _candidates(targets_xy: DataFrame, fibers: DataFrame, largest_reach: float, pointings: list[int], more: DataFrame) -> DataFrame:
    """(fiber, target's columns, dist, columns of ``more``) no farther than the largest reach; cells are kept apart by pointing.

    ``more`` holds what is wanted of the fibers, by fiber_id. It joins the
    centers, not the far more numerous pairs, which so are never shuffled.
    """
    named = [c for c in more.columns if c != "fiber_id"]
    own = more.select("fiber_id", *[F.col(c).alias(f"_{c}") for c in named])
    centers = on_planes(grown_join(fibers.select("fiber_id", "cx", "cy"), own, "fiber_id"), pointings)
    near = plane_pairs(targets_xy, centers, largest_reach, "pointing_idx").where(F.col("dist") <= largest_reach)
    return near.select("fiber_id", *targets_xy.columns, "dist", *[F.col(f"_{c}").alias(c) for c in named])


def reach(targets_xy: DataFrame, fibers: DataFrame, largest_reach: float, pointings: list[int], r_min: str = "r_min", r_max: str = "r_max") -> DataFrame:
    """(pointing, fiber, target) edges in each fiber's annulus ``r_min <= dist <= r_max``.

    ``largest_reach`` bounds ``r_max`` over the instrument and sets the cells;
    ``pointings`` lists the pointings in ``targets_xy``.
    """
    limits = fibers.select("fiber_id", F.col(r_min).alias("r_min"), F.col(r_max).alias("r_max"))
    pairs = _candidates(targets_xy, fibers, largest_reach, pointings, limits)
    return pairs.where((F.col("dist") >= F.col("r_min")) & (F.col("dist") <= F.col("r_max")))


def neighbours(fibers: DataFrame, spacing: float) -> DataFrame:
    """(fiber_id, neighbour_id) both ways for fibers whose centers are at most ``spacing`` apart."""
    pts = fibers.select(F.col("fiber_id").alias("neighbour_id"), F.col("cx").alias("x"), F.col("cy").alias("y"))
    pairs = plane_pairs(pts, fibers.select("fiber_id", "cx", "cy"), spacing)
    return pairs.where((F.col("fiber_id") != F.col("neighbour_id")) & (F.col("dist") <= spacing)).select("fiber_id", "neighbour_id")


def with_dots(fibers: DataFrame, dots: DataFrame, near: DataFrame) -> DataFrame:
    """Attach to each fiber the obstacles of itself and its neighbours as an array.

    ``dots`` holds fiber_id, dot_x, dot_y, dot_r. A fiber has a handful of
    neighbours, so the array stays short.
    """
    around = near.unionByName(fibers.select("fiber_id", F.col("fiber_id").alias("neighbour_id")))
    lists = (grown_join(around, dots.withColumnRenamed("fiber_id", "neighbour_id"), "neighbour_id")
             .groupBy("fiber_id").agg(F.collect_list(F.struct("dot_x", "dot_y", "dot_r")).alias("dots")))
    return grown_join(fibers, lists, "fiber_id", "left")


def with_dot_clearance(df: DataFrame) -> DataFrame:
    """``dot_dist`` to the nearest obstacle of the row's ``dots``; rows inside an obstacle are dropped.

    Each distance is taken once; the pin keeps the filter from repeating it.
    """
    def gap(o: Column) -> Column:
        d = geo.distance(F.col("x"), F.col("y"), o["dot_x"], o["dot_y"])
        return F.struct(d.alias("d"), o["dot_r"].alias("r"))

    gaps = pin(df.withColumn("_gaps", F.transform("dots", gap)).drop("dots"), "_gaps")
    clear = F.coalesce(F.forall("_gaps", lambda g: g["d"] > g["r"]), F.lit(True))
    return gaps.where(clear).withColumn("dot_dist", F.array_min("_gaps")["d"]).drop("_gaps")


def visible_edges(targets_xy: DataFrame, fibers: DataFrame, largest_reach: float, pointings: list[int], safety_margin: float = 0.0,
                  maximum_distance: float | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """Edges with arm solutions: working fibers, valid angles, clear of obstacles and margins.

    ``fibers`` needs the arm columns, ``broken`` and ``dots`` (may be NULL).
    ``solutions`` holds one or two structs (theta, phi, ex, ey, bend, usable).
    Columns of the targets named in ``carry`` come along.
    """
    working = fibers.where(~F.col("broken"))
    pairs = _candidates(targets_xy, working, largest_reach, pointings, working)
    d = F.col("dist")
    if safety_margin > 0:
        pairs = pairs.where((d > F.col("r_min") + safety_margin) & (d < F.col("r_max") - safety_margin))
    if maximum_distance is not None:
        pairs = pairs.where(d < maximum_distance)
    pairs = with_dot_clearance(pairs)
    valid = F.filter("solutions", lambda s: s["usable"])
    return (geo.solve_arm(pairs).withColumn("solutions", valid).where(F.size("solutions") > 0)
            .select("pointing_idx", "fiber_id", "target_idx", "x", "y", "dist", "dot_dist", "solutions", *carry))


def shared_targets(edges: DataFrame, near: DataFrame) -> DataFrame:
    """(pointing, fiber_a, fiber_b, target) for targets both fibers of a neighbour pair reach; a < b."""
    a = edges.select("pointing_idx", "target_idx", F.col("fiber_id").alias("fiber_a"), "x", "y")
    b = edges.select("pointing_idx", "target_idx", F.col("fiber_id").alias("fiber_b"))
    pair = near.select(F.col("fiber_id").alias("fiber_a"), F.col("neighbour_id").alias("fiber_b"))
    # few fibers reach one target, so this join stays narrow
    both = grown_join(a, b, ["pointing_idx", "target_idx"]).where(F.col("fiber_a") < F.col("fiber_b"))
    return grown_join(both, pair, ["fiber_a", "fiber_b"]).select("pointing_idx", "fiber_a", "fiber_b", "target_idx", "x", "y")


def colliding_endpoints(edges: DataFrame, near: DataFrame, distance: float) -> DataFrame:
    """Target pairs closer than ``distance`` that one neighbour pair could hold at once: (pointing, t1 < t2).

    Close pairs are found on a fine grid first; the shared lens of two fibers
    is never paired with itself as a whole.
    """
    shared = shared_targets(edges, near)
    spots = shared.select("pointing_idx", "target_idx", "x", "y").distinct()
    other = spots.select("pointing_idx", F.col("target_idx").alias("t2"), F.col("x").alias("cx"), F.col("y").alias("cy"))
    close = (plane_pairs(spots.withColumnRenamed("target_idx", "t1"), other, distance, "pointing_idx")
             .where((F.col("t1") < F.col("t2")) & (F.col("dist") < distance)).select("pointing_idx", "t1", "t2"))
    s = shared.select("pointing_idx", "fiber_a", "fiber_b", "target_idx")
    held = grown_join(close, s.withColumnRenamed("target_idx", "t1"), ["pointing_idx", "t1"])
    return (grown_join(held, s.withColumnRenamed("target_idx", "t2"), ["pointing_idx", "t2", "fiber_a", "fiber_b"])
            .select("pointing_idx", "t1", "t2").distinct())


def _facing_arms(edges: DataFrame, near: DataFrame, distance: float) -> DataFrame:
    """Each edge's arm once for each neighbour that has targets in reach of it, with the box that holds them (x0 to y1).

    The box around the arm's solutions is cut to the box around the
    neighbour's targets, which mostly leaves a strip between the two fibers.
    """
    e = F.col("solutions")
    lo, hi = (lambda axis, k: F.least(F.col(axis), F.array_min(F.transform(e, lambda s: s[k]))),
              lambda axis, k: F.greatest(F.col(axis), F.array_max(F.transform(e, lambda s: s[k]))))
    held = edges.groupBy("pointing_idx", F.col("fiber_id").alias("neighbour_id")).agg(
        *[f(c).alias(f"_{c}{k}") for c in ("x", "y") for k, f in enumerate((F.min, F.max))])
    beside = grown_join(held, near, "neighbour_id")
    pad = distance + _PAD
    arms = grown_join(edges, beside, ["pointing_idx", "fiber_id"]).select(
        F.col("pointing_idx").alias("p"), "fiber_id", "target_idx", F.col("neighbour_id").alias("nb"), F.col("x").alias("tx"), F.col("y").alias("ty"),
        F.transform(e, lambda s: F.struct(s["ex"].alias("ex"), s["ey"].alias("ey"))).alias("elbows"),
        F.greatest(lo("x", "ex") - pad, "_x0").alias("x0"), F.least(hi("x", "ex") + pad, "_x1").alias("x1"),
        F.greatest(lo("y", "ey") - pad, "_y0").alias("y0"), F.least(hi("y", "ey") + pad, "_y1").alias("y1"))
    return arms.where("x0 <= x1 AND y0 <= y1")


def colliding_elbows(edges: DataFrame, near: DataFrame, distance: float, arm_length: float) -> DataFrame:
    """(pointing, fiber, target, other_fiber, other_target): the other target sits too near the arm.

    Any of the arm's solutions counts. ``arm_length`` is the longest upper arm
    and sets the cells. Arms are listed per neighbour and per cell of the box
    that holds the neighbour's targets near the arm, so a pair of edges meets by
    pointing, fiber and cell. The point lies in one cell, so each pair is found once.
    """
    size = max(arm_length, 2 * distance)
    covers = with_box_cover(_facing_arms(edges, near, distance), F.col("x0"), F.col("x1"), F.col("y0"), F.col("y1"), size, "p").drop("p", "x0", "x1", "y0", "y1")
    points = with_cell(edges.select("pointing_idx", F.col("fiber_id").alias("other_fiber"), F.col("target_idx").alias("other_target"),
                                    "x", "y"), "x", "y", size, "pointing_idx")
    hit = F.exists("elbows", lambda s: geo.point_segment(F.col("x"), F.col("y"), F.col("tx"), F.col("ty"), s["ex"], s["ey"]) < distance)
    met = grown_join(points, covers.withColumnRenamed("nb", "other_fiber"), ["cell", "other_fiber"])
    return met.where(hit).select("pointing_idx", "fiber_id", "target_idx", "other_fiber", "other_target")


def parked_arm(fibers: DataFrame) -> DataFrame:
    """Tip and elbow of each arm at its home position (park_x, park_y, park_ex, park_ey)."""
    home = F.greatest(F.lit(-math.pi), F.col("phi_in")) + 1e-5 - F.col("phi_in")
    x, y = geo.arm_position(F.lit(0.0), home)
    return fibers.withColumns({"park_x": x, "park_y": y, "park_ex": F.col("cx") + F.col("l1") * F.cos("theta0"),
                               "park_ey": F.col("cy") + F.col("l1") * F.sin("theta0")})


def colliding_broken(edges: DataFrame, fibers: DataFrame, near: DataFrame, distance: float) -> DataFrame:
    """(pointing, broken_fiber, fiber, target): reaching the target would hit a parked broken arm."""
    parked = parked_arm(fibers.where("broken")).select(
        F.col("fiber_id").alias("broken_fiber"), "park_x", "park_y", "park_ex", "park_ey")
    beside = grown_join(near.withColumnsRenamed({"fiber_id": "broken_fiber", "neighbour_id": "fiber_id"}), parked, "broken_fiber")
    hit = F.exists("solutions", lambda s: geo.segment_segment(
        F.col("park_x"), F.col("park_y"), F.col("park_ex"), F.col("park_ey"), F.col("x"), F.col("y"), s["ex"], s["ey"]) < distance)
    arms = edges.select("pointing_idx", "fiber_id", "target_idx", "x", "y", F.transform("solutions", lambda s: F.struct(s["ex"].alias("ex"), s["ey"].alias("ey"))).alias("solutions"))
    return grown_join(arms, beside, "fiber_id").where(hit).select("pointing_idx", "broken_fiber", "fiber_id", "target_idx")


def bright_star_histogram(tips: DataFrame, stars_xy: DataFrame, r_max: float = 10.0, bins: int = 20) -> DataFrame:
    """Counts of (fiber tip, bright star) pairs by distance up to ``r_max`` mm."""
    from .pmap import histogram_1d
    pairs = plane_pairs(stars_xy.select("pointing_idx", "x", "y"), tips.select(F.col("fp_x").alias("cx"), F.col("fp_y").alias("cy")), r_max)
    return histogram_1d(pairs, F.col("dist"), 0.0, r_max, bins, ["pointing_idx"])


def edge_cost(edges: DataFrame, move_cost: str = "0", dot_penalty: str = "0", visit_cost: float = 0.0) -> DataFrame:
    """Cost of using an edge; both terms are SQL in ``dist`` (from the center and from the nearest obstacle)."""
    import re
    penalty = re.sub(r"\bdist\b", "dot_dist", dot_penalty)
    return edges.withColumn("cost", F.lit(float(visit_cost)) + F.coalesce(F.expr(f"CAST({move_cost} AS DOUBLE)"), F.lit(0.0))
                            + F.coalesce(F.expr(f"CAST({penalty} AS DOUBLE)"), F.lit(0.0)))
