"""Radius joins on the sphere by zones (Gray, Nieto-Santisteban & Szalay 2006).

The sky is cut into declination zones of equal height and each zone into cells
of roughly equal width. A point lies in one cell; a search circle is listed
under every cell it may touch, RA wrap and poles included. The equi-join on the
cell is followed by the exact separation.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.astro import haversine_deg
from ..session import cut
from .blocks import cell_join, grown_join

ARCSEC = 1.0 / 3600.0
MIN_HEIGHT = 5.0 * ARCSEC
_PAD = 1e-9  # degrees added to every search circle against rounding at cell edges
_CELL_BASE = 1 << 31


def zone_height(radius_deg: float) -> float:
    """Zone height for a radius: few copies per circle, few strangers per cell."""
    return min(max(4.0 * radius_deg, MIN_HEIGHT), 10.0)


def _zone_count(h: float) -> int:
    return math.ceil(180.0 / h)


def _zone(dec: Column, h: float) -> Column:
    z = F.floor((dec + 90.0) / h)
    return F.least(F.greatest(z, F.lit(0)), F.lit(_zone_count(h) - 1)).cast("bigint")


def _cells_in_zone(zone: Column, h: float) -> Column:
    edge = F.greatest(F.abs(zone * h - 90.0), F.abs((zone + 1) * h - 90.0))
    width = F.cos(F.radians(F.least(edge, F.lit(90.0))))
    return F.greatest(F.lit(1), F.floor(width * 360.0 / h)).cast("bigint")


def _has_position(ra: str, dec: str) -> Column:
    return (F.col(ra).isNotNull() & F.col(dec).isNotNull()
            & ~F.isnan(ra) & ~F.isnan(dec))


def cell_of(ra: str, dec: str, h: float) -> Column:
    """Cell of a position."""
    z = _zone(F.col(dec), h)
    n = _cells_in_zone(z, h)
    return z * _CELL_BASE + F.pmod(F.floor(F.pmod(F.col(ra), F.lit(360.0)) / 360.0 * n).cast("bigint"), n)


def with_cell(df: DataFrame, ra: str, dec: str, h: float) -> DataFrame:
    """Put each row with a position in its cell (``cell``)."""
    return df.where(_has_position(ra, dec)).withColumn("cell", cell_of(ra, dec, h))


def with_cover(df: DataFrame, ra: str, dec: str, h: float, radius_deg: float) -> DataFrame:
    """List each row under every cell its search circle may touch (``cell``)."""
    r = radius_deg + _PAD
    keep = df.columns
    d = F.col(dec)
    near_pole = F.abs(d) + r >= 90.0
    half = F.when(near_pole, F.lit(180.0)).otherwise(
        F.degrees(F.asin(F.least(F.lit(1.0), F.lit(math.sin(math.radians(min(r, 90.0)))) / F.cos(F.radians(d))))))
    zoned = df.where(_has_position(ra, dec)).select(
        *keep, half.alias("_half"), F.explode(F.sequence(_zone(d - r, h), _zone(d + r, h))).alias("_zone"))
    n = F.col("_n")
    spans = (zoned.withColumn("_n", _cells_in_zone(F.col("_zone"), h))
             .withColumn("_lo", F.floor((F.col(ra) - F.col("_half")) / 360.0 * n).cast("bigint"))
             .withColumn("_hi", F.floor((F.col(ra) + F.col("_half")) / 360.0 * n).cast("bigint")))
    whole = F.col("_hi") - F.col("_lo") + 1 >= n
    lo = F.when(whole, F.lit(0).cast("bigint")).otherwise(F.col("_lo"))
    hi = F.when(whole, n - 1).otherwise(F.col("_hi"))
    return (spans.select(*keep, "_zone", "_n", F.explode(F.sequence(lo, hi)).alias("_c"))
            .select(*keep, (F.col("_zone") * _CELL_BASE + F.pmod(F.col("_c"), n)).alias("cell")))


def with_disk(df: DataFrame, ra: str, dec: str, h: float, radius_deg: float) -> DataFrame:
    """List each row under the cells its search circle reaches into (``cell``); ``inside`` marks those that lie in the circle as a whole.

    Meant for cells that are small beside the circle: each zone lists only what
    the circle spans there. Within 90 degrees no point of a cell is farther than
    its farthest corner; a circle around a pole marks nothing.
    """
    r = radius_deg + _PAD
    keep, d = df.columns, F.col(dec)
    spans = df.where(_has_position(ra, dec)).select(*keep, F.explode(F.sequence(_zone(d - r, h), _zone(d + r, h))).alias("_zone"))
    spans = spans.withColumns({"_n": _cells_in_zone(F.col("_zone"), h), "_d0": F.col("_zone") * h - 90.0, "_d1": (F.col("_zone") + 1) * h - 90.0})
    # the circle is widest where it touches its two meridians, or at the zone's edge next to that
    widest = F.degrees(F.asin(F.least(F.greatest(F.sin(F.radians(d)) / math.cos(math.radians(min(r, 89.0))), F.lit(-1.0)), F.lit(1.0))))
    at = F.least(F.greatest(widest, F.col("_d0")), F.col("_d1"))
    chord = (math.sin(math.radians(min(r, 180.0) / 2)) ** 2 - F.pow(F.sin(F.radians((at - d) / 2)), F.lit(2.0))) / (F.cos(F.radians(at)) * F.cos(F.radians(d)))
    half = 2 * F.degrees(F.asin(F.sqrt(F.least(F.greatest(chord, F.lit(0.0)), F.lit(1.0))))) + _PAD / F.cos(F.radians(d))
    near_pole = (F.abs(d) + r >= 90.0 - h) | F.lit(r >= 89.0)
    spans = spans.withColumn("_half", F.when(near_pole, F.lit(180.0)).otherwise(half))
    spans = spans.withColumns({"_lo": F.floor((F.col(ra) - F.col("_half")) / 360.0 * F.col("_n")).cast("bigint"),
                               "_hi": F.floor((F.col(ra) + F.col("_half")) / 360.0 * F.col("_n")).cast("bigint")})
    n, c = F.col("_n"), F.col("_c")
    whole = F.col("_hi") - F.col("_lo") + 1 >= n
    spans = spans.withColumns({"_lo": F.when(whole, F.lit(0).cast("bigint")).otherwise(F.col("_lo")), "_hi": F.when(whole, n - 1).otherwise(F.col("_hi"))})
    cells = spans.select(*keep, "_zone", "_n", "_d0", "_d1", F.explode(F.sequence("_lo", "_hi")).alias("_c"))
    corners = [haversine_deg(c_ra, c_dec, F.col(ra), d) for c_ra in (c / n * 360.0, (c + 1) / n * 360.0) for c_dec in (F.col("_d0"), F.col("_d1"))]
    return cells.select(*keep, (F.col("_zone") * _CELL_BASE + F.pmod(c, n)).alias("cell"), (~near_pole & (F.greatest(*corners) <= radius_deg - _PAD)).alias("inside"))


def _slim(df: DataFrame, key: str, pos: tuple[str, str], side: str) -> DataFrame:
    return df.select(F.col(key).alias(f"{side}_id"), F.col(pos[0]).cast("double").alias(f"{side}_ra"),
                     F.col(pos[1]).cast("double").alias(f"{side}_dec"))


def _sides(left: DataFrame, right: DataFrame, radius_deg: float, explode: str, h: float) -> tuple[DataFrame, DataFrame]:
    """(points, covers) of slim sides for cells of height ``h``."""
    if explode == "left":
        return with_cell(right, "r_ra", "r_dec", h), with_cover(left, "l_ra", "l_dec", h, radius_deg)
    return with_cell(left, "l_ra", "l_dec", h), with_cover(right, "r_ra", "r_dec", h, radius_deg)


def _exact(points: DataFrame, covers: DataFrame, radius_deg: float, closed: bool, at: Column | None = None) -> DataFrame:
    """Pairs within the radius. Points whose cell is given by ``at`` move without it: it is the join's key, and cheap."""
    near = F.abs(F.col("l_dec") - F.col("r_dec")) <= radius_deg + _PAD
    sep = haversine_deg(*(F.col(c) for c in ("l_ra", "l_dec", "r_ra", "r_dec"))) * 3600.0
    limit = radius_deg * 3600.0
    met = cell_join(points, covers, True) if at is None else grown_join(points, covers, at == F.col("cell")).drop("cell")
    pairs = met.where(near).withColumn("sep", sep)
    return pairs.where(F.col("sep") <= limit if closed else F.col("sep") < limit)


def _exact_semi(points: DataFrame, covers: DataFrame, radius_deg: float) -> DataFrame:
    """The covers with a point within the radius."""
    p = points.select(F.col("cell").alias("_cell"), "r_ra", "r_dec")
    near = F.abs(F.col("l_dec") - F.col("r_dec")) <= radius_deg + _PAD
    sep = haversine_deg(*(F.col(c) for c in ("l_ra", "l_dec", "r_ra", "r_dec"))) * 3600.0
    return grown_join(covers, p, (F.col("cell") == F.col("_cell")) & near & (sep <= radius_deg * 3600.0), "left_semi")


def _pairs(left: DataFrame, right: DataFrame, radius_deg: float, closed: bool, explode: str) -> DataFrame:
    """Pairs of slim sides (``l_*`` and ``r_*`` columns) within the radius, with ``sep`` in arcsec."""
    return _exact(*_sides(left, right, radius_deg, explode, zone_height(radius_deg)), radius_deg, closed)


_FINER = 16.0     # a crowded search starts in cells this much smaller
CROWD = 10_000    # right rows in a cell from which a narrower search comes first, unless the caller names another number
_FINEST = 4e-7    # degrees: cells are not made smaller than about a milliarcsecond


def _largest_cell(searched: DataFrame) -> int:
    return searched.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0


DENSE = 1000      # rows of a circle's coarse cell from which finer cells cost less than the rows they spare
FINE = 8          # no more of them than this along a circle's radius


def circle_cells(searched: DataFrame, ra: str, dec: str, radius_deg: float) -> float:
    """Height of cells for circles over ``searched``: the denser its rows, the more cells go to a circle."""
    h = zone_height(radius_deg)
    k = min(FINE, math.isqrt(_largest_cell(with_cell(searched.select(ra, dec), ra, dec, h)) // DENSE))
    return max(radius_deg / k, MIN_HEIGHT) if k else h


def _nearest(left: DataFrame, right: DataFrame, radius_deg: float, closed: bool, explode: str, h: float, crowd: int,
             unfolded: DataFrame | None = None) -> DataFrame:
    """(l_id, m.sep, m.r_id) of the closest right row; right rows have positions of their own.

    Right rows are counted in every cell. ``unfolded`` are the right rows with
    copies of a position: if no cell of theirs is crowded, none is without them,
    and they need not be folded to be counted. Left rows whose cells are crowded try
    a narrower circle in smaller cells first: what they find is the closest
    there is, and only the rest searches on. The counts stay distributed; only
    the largest of them is looked at.
    """
    points, covers = _sides(left, right, radius_deg, explode, h)
    targets, searchers = (points, covers) if explode == "left" else (covers, points)
    found, small = None, h / _FINER
    may = small >= _FINEST
    if may and unfolded is not None:
        raw = _sides(left, unfolded, radius_deg, explode, h)[explode != "left"]
        may = _largest_cell(raw) > crowd
    if may and _largest_cell(targets) > crowd:
        crowded = targets.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > crowd).select("cell")
        busy = searchers.join(crowded, "cell", "left_semi").select(*left.columns).distinct()
        found = cut(_nearest(cut(busy), right, min(radius_deg, small / 4.0), closed, explode, small, crowd))
        left = left.join(found.select("l_id"), "l_id", "left_anti")
        points, covers = _sides(left, right, radius_deg, explode, h)
    pos = ("r_ra", "r_dec") if explode == "left" else ("l_ra", "l_dec")
    best = _exact(points.drop("cell"), covers, radius_deg, closed, cell_of(*pos, h)).groupBy("l_id").agg(F.min(F.struct("sep", "r_id")).alias("m"))
    return best if found is None else found.unionByName(best)


def pairs_within(left: DataFrame, right: DataFrame, radius_arcsec: float, left_id: str, right_id: str,
                 left_pos: tuple[str, str] = ("ra", "dec"), right_pos: tuple[str, str] = ("ra", "dec"),
                 closed: bool = True, explode: str = "left") -> DataFrame:
    """Every pair within the radius: (left_id, right_id, sep_arcsec).

    ``explode`` names the side listed under several cells; name the smaller one.
    """
    out = _pairs(_slim(left, left_id, left_pos, "l"), _slim(right, right_id, right_pos, "r"),
                 radius_arcsec * ARCSEC, closed, explode)
    return out.select(F.col("l_id").alias("left_id"), F.col("r_id").alias("right_id"),
                      F.col("sep").alias("sep_arcsec"))


def nearest_within(left: DataFrame, right: DataFrame, radius_arcsec: float, left_id: str, right_id: str,
                   left_pos: tuple[str, str] = ("ra", "dec"), right_pos: tuple[str, str] = ("ra", "dec"),
                   closed: bool = True, explode: str = "left", crowd: int | None = None) -> DataFrame:
    """The closest right row of each left row, if within the radius; ties go to the smallest id.

    Right rows at one position are folded into the smallest id first, so that
    copies of a source never multiply the candidates.
    """
    copies = _slim(right, right_id, right_pos, "r")
    r = copies.groupBy("r_ra", "r_dec").agg(F.min("r_id").alias("r_id"))
    radius = radius_arcsec * ARCSEC
    best = _nearest(_slim(left, left_id, left_pos, "l"), r, radius, closed, explode, zone_height(radius),
                    CROWD if crowd is None else crowd, copies)
    return best.select(F.col("l_id").alias("left_id"), F.col("m.r_id").alias("right_id"),
                       F.col("m.sep").alias("sep_arcsec"))


def match_one_to_one(left: DataFrame, right: DataFrame, radius_arcsec: float, left_id: str, right_id: str,
                     **options) -> DataFrame:
    """Nearest match in which each right row keeps only its closest claimant.

    A left row that loses its right row stays unmatched, as in the list merge.
    """
    near = nearest_within(left, right, radius_arcsec, left_id, right_id, **options)
    won = near.groupBy("right_id").agg(F.min(F.struct("sep_arcsec", "left_id")).alias("m"))
    return won.select(F.col("m.left_id").alias("left_id"), "right_id", F.col("m.sep_arcsec").alias("sep_arcsec"))


FINEST, STEP = 15, 3      # levels of the pyramid: the sky in 2**level rows and twice as many columns
FEW_CELLS = 1 << 14       # a level with no more cells than this travels to the searches


def _grid(ra: Column, dec: Column, level: int) -> tuple[Column, Column]:
    """(row, column) of a position in the grid of a level."""
    n = 1 << level
    row = F.least(F.floor((dec + 90.0) / 180.0 * n), F.lit(n - 1))
    return row.cast("int"), F.pmod(F.floor(F.pmod(ra, F.lit(360.0)) / 360.0 * 2 * n), F.lit(2 * n)).cast("int")


def _cell_number(row: Column, col: Column) -> Column:
    return row.cast("bigint") * _CELL_BASE + col


def _least_to_cell(ra: Column, dec: Column, row: Column, col: Column, level: int) -> Column:
    """No point of a cell is closer than this (degrees).

    A cell beside the point's meridian can only be reached over one of its two
    edge meridians, and those are no closer than their great circles.
    """
    h, n = 180.0 / (1 << level), 2 << level
    low = row * h - 90.0
    up = F.greatest(low - dec, dec - (low + h), F.lit(0.0))
    width = 360.0 / n
    east = F.pmod(col * width - ra, F.lit(360.0))                  # from the point to the western edge, eastwards
    inside = (east == 0) | (east > 360.0 - width)
    west = F.pmod(ra - (col + 1) * width, F.lit(360.0))
    turn = F.radians(F.least(east, west, F.lit(90.0)))
    side = F.degrees(F.asin(F.least(F.cos(F.radians(dec)) * F.sin(turn), F.lit(1.0))))
    return F.greatest(up, F.when(inside, 0.0).otherwise(side))


def pyramid(big: DataFrame, finest: int = FINEST, step: int = STEP) -> dict[int, DataFrame]:
    """Occupied cells (``_row``, ``_col``) of each level with the position of one row and the number of rows ``_n``, from ``b_ra, b_dec, _row, _col``.

    The finest level is counted from the rows, each coarser one from the finer one.
    """
    pick = F.min(F.struct("b_ra", "b_dec")).alias("_one")
    out = {finest: cut(big.groupBy("_row", "_col").agg(pick, F.count(F.lit(1)).alias("_n")).select("_row", "_col", "_one.*", "_n"))}
    for level in range(finest - step, -1, -step):
        up = out[level + step].withColumns({c: F.shiftright(c, step) for c in ("_row", "_col")})
        out[level] = cut(up.groupBy("_row", "_col").agg(pick, F.sum("_n").alias("_n")).select("_row", "_col", "_one.*", "_n"))
    return out


def _inner_cells(level: DataFrame, step: int) -> DataFrame:
    """Each cell of the next coarser level with the list of occupied cells in it, no more than 4**step."""
    cell = F.struct("_row", "_col", "b_ra", "b_dec")
    up = [F.shiftright(c, step).alias(f"_up{c}") for c in ("_row", "_col")]
    return level.groupBy(*up).agg(F.collect_list(cell).alias("_cells")).withColumnsRenamed({"_up_row": "_row", "_up_col": "_col"})


def nearest_any_distance(small: DataFrame, big: DataFrame, small_id: str, big_id: str,
                         small_pos: tuple[str, str] = ("ra", "dec"), big_pos: tuple[str, str] = ("ra", "dec"),
                         finest: int = FINEST, step: int = STEP) -> DataFrame:
    """The closest row of ``big`` for each row of ``small``, however far; ties go to the smallest id.

    Cell ids are hierarchical: a row's cell at a coarse level is a prefix of
    its finest one. Searches go down the
    pyramid of occupied cells: a row in a cell bounds the distance from above,
    the cell's edges from below, and cells that can't hold the closest row are
    left. A cell carries the cells inside it, so a search looks through them
    where it is and only those that are left move on. What remains at the finest
    level, some cells for each search, meets the rows of the large table in one
    join. Rows at one position count once.

    ``big`` is read twice, for the pyramid and for that join, and not kept in
    between; its rows move once, without their cell, which is the join's key. Only
    if a finest cell is crowded are copies of a position folded before that.
    """
    slim = big.where(_has_position(*big_pos)).select(F.col(big_pos[0]).cast("double").alias("b_ra"), F.col(big_pos[1]).cast("double").alias("b_dec"), F.col(big_id).alias("b_id"))
    row, col = _grid(F.col("b_ra"), F.col("b_dec"), finest)
    levels = pyramid(slim.select("b_ra", "b_dec", row.alias("_row"), col.alias("_col")), finest, step)
    crowded = (levels[finest].agg(F.max("_n")).first()[0] or 0) > CROWD
    # copies of a position fold on the map side, so this moves positions and not rows
    placed = slim.groupBy("b_ra", "b_dec").agg(F.min("b_id").alias("b_id")) if crowded else slim
    ahead = small.where(_has_position(*small_pos)).select(F.col(small_id).alias("left_id"), F.pmod(F.col(small_pos[0]).cast("double"), F.lit(360.0)).alias("ra"),
                                                          F.col(small_pos[1]).cast("double").alias("dec"))
    ahead = ahead.select("*", F.lit(0).alias("_row"), F.explode(F.array(F.lit(0), F.lit(1))).alias("_col"), F.lit(360.0).alias("_best"))
    search = Window.partitionBy("left_id", "ra", "dec")
    for level in range(0, finest, step):
        few = 2 << 2 * level <= FEW_CELLS
        inner = _inner_cells(levels[level + step], step)
        met = ahead.join(F.broadcast(inner) if few else inner, ["_row", "_col"])
        seps = F.transform("_cells", lambda k: haversine_deg(F.col("ra"), F.col("dec"), k["b_ra"], k["b_dec"]))
        # without the default, a check for NULL would look through the cells once more in the join
        met = met.select("left_id", "ra", "dec", F.coalesce(F.least("_best", F.array_min(seps)), F.lit(360.0)).alias("_best"), "_cells")
        met = met.select("left_id", "ra", "dec", "_best", F.inline("_cells")).drop("b_ra", "b_dec")
        least = _least_to_cell(F.col("ra"), F.col("dec"), F.col("_row"), F.col("_col"), level + step)
        met = met.where(least <= F.col("_best") + _PAD)
        # the cells that are left hold the row of the least bound, so this is the bound of the search
        met = met.withColumn("_best", F.min("_best").over(search)).where(least <= F.col("_best") + _PAD)
        ahead = met if few or level + step == finest else cut(met)
        ahead = ahead.select("left_id", "ra", "dec", "_row", "_col", "_best")
    sep = haversine_deg(*(F.col(c) for c in ("ra", "dec", "b_ra", "b_dec")))
    ahead = ahead.select("left_id", "ra", "dec", _cell_number(F.col("_row"), F.col("_col")).alias("_cell"))
    near = grown_join(ahead, placed, F.col("_cell") == _cell_number(row, col))
    found = near.groupBy("left_id", "ra", "dec").agg(F.min(F.struct(sep.alias("sep"), "b_id")).alias("m"))
    return found.groupBy("left_id").agg(F.min("m").alias("m")).select("left_id", F.col("m.b_id").alias("right_id"), (F.col("m.sep") * 3600.0).alias("sep_arcsec"))


def _near_join(left: DataFrame, right: DataFrame, radius_arcsec: float, how: str, left_pos: tuple[str, str], right_pos: tuple[str, str],
               closed: bool, also: Column | None = None) -> DataFrame:
    """Left rows with (left_semi) or without (left_anti) a right row within the radius, by a join that stops at the first one.

    The left row lies in one cell, so it is looked at once; right rows are
    listed under the cells that their circles touch.
    """
    radius = radius_arcsec * ARCSEC
    h = zone_height(radius)
    covers = with_cover(right, *right_pos, h, radius).withColumnsRenamed({right_pos[0]: "_r_ra", right_pos[1]: "_r_dec", "cell": "_r_cell"})
    z = _zone(F.col(left_pos[1]), h)
    n = _cells_in_zone(z, h)
    c = F.pmod(F.floor(F.pmod(F.col(left_pos[0]), F.lit(360.0)) / 360.0 * n).cast("bigint"), n)
    points = left.withColumn("_l_cell", F.when(_has_position(*left_pos), z * _CELL_BASE + c))
    sep = haversine_deg(F.col(left_pos[0]), F.col(left_pos[1]), F.col("_r_ra"), F.col("_r_dec")) * 3600.0
    limit = radius * 3600.0
    on = (F.col("_l_cell") == F.col("_r_cell")) & (F.abs(F.col(left_pos[1]) - F.col("_r_dec")) <= radius + _PAD) & (sep <= limit if closed else sep < limit)
    return points.join(covers, on if also is None else on & also, how).drop("_l_cell")


def with_match(left: DataFrame, right: DataFrame, radius_arcsec: float, left_pos: tuple[str, str] = ("ra", "dec"),
               right_pos: tuple[str, str] = ("ra", "dec"), closed: bool = True) -> DataFrame:
    """Left rows with a right row within the radius, each once."""
    return _near_join(left, right.select(*right_pos), radius_arcsec, "left_semi", left_pos, right_pos, closed)


def without_match(left: DataFrame, right: DataFrame, radius_arcsec: float, left_pos: tuple[str, str] = ("ra", "dec"),
                  right_pos: tuple[str, str] = ("ra", "dec"), closed: bool = True) -> DataFrame:
    """Left rows without a right row within the radius; a row without a position has none."""
    return _near_join(left, right.select(*right_pos), radius_arcsec, "left_anti", left_pos, right_pos, closed)


def cone(df: DataFrame, ra0: float, dec0: float, radius_deg: float,
         pos: tuple[str, str] = ("ra", "dec"), closed: bool = True) -> DataFrame:
    """Rows within a circle: a box that the scan can use, then the exact test."""
    ra, dec = F.col(pos[0]), F.col(pos[1])
    box = dec.between(dec0 - radius_deg, dec0 + radius_deg)
    if abs(dec0) + radius_deg < 90.0 and radius_deg < 90.0:
        half = math.degrees(math.asin(min(1.0, math.sin(math.radians(radius_deg)) / math.cos(math.radians(dec0)))))
        lo, hi = (ra0 - half - _PAD), (ra0 + half + _PAD)
        if lo < 0:
            box = box & ((ra >= lo + 360.0) | (ra <= hi))
        elif hi >= 360.0:
            box = box & ((ra >= lo) | (ra <= hi - 360.0))
        else:
            box = box & ra.between(lo, hi)
    sep = haversine_deg(ra, dec, ra0, dec0)
    return df.where(box).where(sep <= radius_deg if closed else sep < radius_deg)


def merge_nearby(left: DataFrame, right: DataFrame, radius_arcsec: float, left_id: str, right_id: str,
                 how: str = "inner", left_pos=("ra", "dec"), right_pos=("ra", "dec")) -> DataFrame:
    """All pairs within the radius as one wide catalog; ``how='left'`` keeps unmatched left rows.

    The left position is the primary one. Columns of the right table get the
    suffix ``_2`` where the name is taken.

    Both tables' columns go through the cell join, so the pairs, of which there
    may be far more than rows, are made in place and never shuffled. Unmatched
    rows are found beside them, by a join that stops at the first match.
    """
    taken = set(left.columns) | {"sep_arcsec"}
    r = right.select(*[F.col(c).alias(f"{c}_2" if c in taken else c) for c in right.columns])
    rid = f"{right_id}_2" if right_id in taken else right_id
    radius = radius_arcsec * ARCSEC
    h = zone_height(radius)
    l_slim, r_slim = _slim(left, left_id, left_pos, "l"), _slim(right, right_id, right_pos, "r")
    points, covers = _sides(grown_join(l_slim, left, F.col("l_id") == F.col(left_id)),
                            grown_join(r_slim, r, F.col("r_id") == F.col(rid), how), radius, "left", h)
    names = [*left.columns, "sep_arcsec", *r.columns]
    wide = _exact(points, covers, radius, True).withColumnRenamed("sep", "sep_arcsec").select(*names)
    if how == "left":
        found = _exact_semi(*_sides(l_slim, r_slim, radius, "left", h), radius).select(F.col("l_id").alias("_l"))
        rest = grown_join(left, found, F.col(left_id) == F.col("_l"), "left_anti")
        wide = wide.unionByName(rest, allowMissingColumns=True)
    ra2, dec2 = (f"{c}_2" if c in taken else c for c in right_pos)
    return wide.withColumns({"primary_ra": F.coalesce(F.col(left_pos[0]), F.col(ra2)),
                             "primary_dec": F.coalesce(F.col(left_pos[1]), F.col(dec2))})


def copy_columns(left: DataFrame, right: DataFrame, matches: DataFrame, left_id: str, right_id: str,
                 columns: list[str], how: str = "left") -> DataFrame:
    """Copy columns of the matched right row onto each left row."""
    m = matches.select(F.col("left_id").alias("_l"), F.col("right_id").alias("_r"))
    cols = right.select(F.col(right_id).alias("_k"), *columns)
    got = m.join(cols, F.col("_r") == F.col("_k"), "inner").drop("_r", "_k")
    return left.join(got, F.col(left_id) == F.col("_l"), how).drop("_l")


def append_unmatched(left: DataFrame, right: DataFrame, matches: DataFrame, right_id: str) -> DataFrame:
    """The left list followed by the right rows that matched nothing."""
    rest = right.join(matches.select(F.col("right_id").alias(right_id)).distinct(), right_id, "left_anti")
    return left.unionByName(rest, allowMissingColumns=True)


def drop_lower_precedence(df: DataFrame, radius_arcsec: float, source: str, passes: list[list[str]],
                          key: list[str], pos: tuple[str, str] = ("ra", "dec")) -> DataFrame:
    """Deduplicate in passes: a row of a listed source goes if any other row is closer than the radius.

    Positions are folded before the join, so a crowd of copies counts as one
    place that is shared.
    """
    ra, dec = pos
    for sources in passes:
        df = cut(df)
        # ``key`` tells rows apart; several rows with one key are one object
        places = df.groupBy(ra, dec).agg(F.min(F.struct(*key)).alias("_lo"), F.max(F.struct(*key)).alias("_hi"))
        places = places.select(ra, dec, (F.col("_lo") != F.col("_hi")).alias("_shared"))
        listed = F.coalesce(F.col(source).isin(sources), F.lit(False))
        other = (F.col(ra) != F.col("_r_ra")) | (F.col(dec) != F.col("_r_dec")) | F.col("_shared")
        alone = _near_join(df.where(listed), places, radius_arcsec, "left_anti", pos, pos, False, other)
        df = df.where(~listed).unionByName(alone)
    return df


INDEX_HEIGHT = 1.0     # degrees: the cells that a position index is partitioned by; some 41,000 cover the sky


def add_to_index(df: DataFrame, path: str, key: str, pos: tuple[str, str] = ("ra", "dec")) -> None:
    """Append ids and positions to an index of files partitioned by cell; rows without a position have no place in it."""
    slim = df.select(F.col(key).cast("bigint").alias(key), *[F.col(c).cast("double").alias(c) for c in pos])
    with_cell(slim, *pos, INDEX_HEIGHT).write.mode("append").partitionBy("cell").parquet(path)


def read_index(near: DataFrame, path: str, key: str, radius_arcsec: float, pos: tuple[str, str] = ("ra", "dec"),
               index_pos: tuple[str, str] = ("ra", "dec")) -> DataFrame:
    """The rows of an index in the cells that the circles around ``near`` touch.

    The touched cells, no more than the sky has, are found first and select the
    partitions while the query runs; the other cells' files are not opened.
    """
    schema = f"{key} bigint, {index_pos[0]} double, {index_pos[1]} double, cell bigint"
    touched = with_cover(near.select(*pos), *pos, INDEX_HEIGHT, radius_arcsec * ARCSEC).where("cell >= 0").select("cell").distinct()
    return near.sparkSession.read.schema(schema).parquet(path).join(F.broadcast(touched), "cell", "left_semi").drop("cell")


def join_by_neighbours(left: DataFrame, links: DataFrame, right: DataFrame, left_key: tuple[str, str],
                       right_key: tuple[str, str]) -> DataFrame:
    """Equi-join of two catalogs through a ready-made neighbour table.

    Keys are (catalog column, link column) pairs.
    """
    (a, la), (b, lb) = left_key, right_key
    return left.join(links, F.col(a) == F.col(la)).join(right, F.col(lb) == F.col(b))


def closest_per_object(neighbours: DataFrame, obj: str, distance: str, source: str) -> DataFrame:
    """The closest source of each object, ties to the smallest id; other columns come along."""
    rest = [c for c in neighbours.columns if c not in (obj, distance, source)]
    best = neighbours.groupBy(obj).agg(F.min(F.struct(distance, source, *rest)).alias("_m"))
    return best.select(obj, "_m.*")
