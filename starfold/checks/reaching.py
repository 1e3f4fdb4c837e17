"""Checks of the focal-plane joins and visit tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import reach as rc, select as sel, visits as vi
from ..operators.blocks import grown_join
from ..session import cut
from ..sources.fixtures import PLANE_MM, PLANES_SQL, PLATE_SCALE, POINTINGS, planes, table, with_
from .registry import HAV, R, check, r
from .scalars import TAN

C = F.col
REACH = 4.75
SPACING = 9.0
VIEWED = [p["pointing_idx"] for p in POINTINGS]


def _views() -> str:
    parts = []
    for p in POINTINGS:
        x, y = TAN("ra", "dec", f"{p['ra']}e0", f"{p['dec']}e0", f"{p['posang']}e0")
        parts.append(f"SELECT targetid AS target_idx, {p['pointing_idx']} AS pointing_idx, {x} + 5.04e2*(targetid % {PLANES_SQL}) AS x, {y} AS y FROM hsc "
                     f"WHERE {HAV('ra', 'dec', str(p['ra']) + 'e0', str(p['dec']) + 'e0')} < 7.5e-1")
    return " UNION ALL ".join(parts)


# fibers sit on an 8 mm grid, so a target can only belong to the nearest grid columns and rows
_EDGES = """SELECT v.pointing_idx, f.fiber_id, v.target_idx, v.x, v.y, sqrt((v.x-f.cx)*(v.x-f.cx)+(v.y-f.cy)*(v.y-f.cy)) AS dist, f.r_min, f.r_max
    FROM (SELECT *, floor((x+1.96e2)/8e0) + o AS gx FROM views, (VALUES (0),(1)) t(o)) v
    JOIN (SELECT *, floor((cx+1.96e2)/8e0+5e-1) AS gx FROM fibers WHERE status = 0) f ON f.gx = v.gx AND abs(f.cy-v.y) <= 4.75e0"""
_REACH = dict(views=_views(), cand=_EDGES, edges="SELECT * FROM cand WHERE dist >= r_min AND dist <= r_max",
              near="""SELECT a.fiber_id, b.fiber_id AS neighbour_id FROM fibers a JOIN fibers b ON a.fiber_id <> b.fiber_id
                AND abs(a.cx-b.cx) <= 9 AND sqrt(power(a.cx-b.cx,2)+power(a.cy-b.cy,2)) <= 9""")
_HEAD = with_("hsc", "fibers", **_REACH)


def _on_plane(c, key):
    """Place beside the first plane of the plane that a target is dealt to."""
    return PLANE_MM * (C(key) % planes(c.spark, c.sf_dir))


def views(c):
    seen = rc.project_targets(sel.in_view(c("hsc").withColumnRenamed("targetid", "target_idx"), POINTINGS), PLATE_SCALE)
    return seen.select("target_idx", "pointing_idx", (C("x") + _on_plane(c, "target_idx")).alias("x"), "y")


def fibers(c):
    return c("fibers").withColumn("broken", C("status") != 0)


def edges(c):
    return rc.reach(views(c), fibers(c).where("NOT broken").select("fiber_id", "cx", "cy", "r_min", "r_max"), REACH, VIEWED)


def near(c):
    return rc.neighbours(fibers(c), SPACING)


@check("j17_reach", _HEAD + f"SELECT pointing_idx, fiber_id, target_idx, {R('dist')} AS dist FROM edges")
def _(c):
    return edges(c).select("pointing_idx", "fiber_id", "target_idx", r("dist").alias("dist"))


@check("j20_shared_targets", _HEAD + """SELECT a.pointing_idx, a.fiber_id AS fiber_a, b.fiber_id AS fiber_b, a.target_idx FROM edges a
    JOIN edges b USING (pointing_idx, target_idx) JOIN near n ON n.fiber_id = a.fiber_id AND n.neighbour_id = b.fiber_id WHERE a.fiber_id < b.fiber_id""")
def _(c):
    return rc.shared_targets(cut(edges(c)), near(c)).drop("x", "y")


_SHARED = dict(_REACH, sh="""SELECT a.pointing_idx, a.fiber_id AS fa, b.fiber_id AS fb, a.target_idx, a.x, a.y FROM edges a
    JOIN edges b USING (pointing_idx, target_idx) JOIN near n ON n.fiber_id = a.fiber_id AND n.neighbour_id = b.fiber_id WHERE a.fiber_id < b.fiber_id""")


@check("j21_colliding_endpoints", with_("hsc", "fibers", **_SHARED) + """SELECT DISTINCT a.pointing_idx, a.target_idx AS t1, b.target_idx AS t2
    FROM sh a JOIN sh b USING (pointing_idx, fa, fb) WHERE a.target_idx < b.target_idx AND sqrt(power(a.x-b.x,2)+power(a.y-b.y,2)) < 1.5e0""")
def _(c):
    return rc.colliding_endpoints(cut(edges(c)), cut(near(c)), 1.5)


def _wrap(a: str) -> str:
    return f"({a}) - 2*pi()*floor(({a})/(2*pi()))"


# arm solutions, written out for equal links
_SOL = f"""SELECT e.pointing_idx, e.fiber_id, e.target_idx, e.x, e.y, e.dist, f.cx, f.cy, f.theta0, f.theta1, f.phi_in, f.phi_out,
    acos(greatest(-1e0, least(1e0, (2*2.375e0*2.375e0-e.dist*e.dist)/(2*2.375e0*2.375e0)))) AS bend,
    acos(greatest(-1e0, least(1e0, e.dist/(2*2.375e0)))) AS shoulder, atan2(e.y-f.cy, e.x-f.cx) AS spot FROM cand0 e JOIN fibers f USING (fiber_id)"""
_SOLVED = f"""SELECT *, theta + theta0 AS a, cx+2.375e0*cos(theta+theta0) AS ex, cy+2.375e0*sin(theta+theta0) AS ey FROM
    (SELECT *, {_wrap('spot+shoulder-theta0')} AS theta, bend - phi_in - pi() AS phi, 1 AS sol FROM bent
     UNION ALL SELECT *, {_wrap('spot-shoulder-theta0')}, CASE WHEN bend <= pi()/2 THEN -bend ELSE 2*pi()-bend END - phi_in - pi(), 2 FROM bent)"""
_VALID = f"""SELECT * FROM solved WHERE dist <= 4.75e0 AND phi >= 0 AND phi <= phi_out - phi_in
    AND theta <= {_wrap('theta1-theta0+pi()')} + pi()"""
_DOTS = "SELECT fiber_id, cx+1e0 AS dot_x, cy-2.5e0 AS dot_y, 7.5e-1 AS dot_r FROM fibers"
_VIS = dict(_REACH, cand0="SELECT * FROM cand WHERE dist > 5e-1 AND dist < 4.55e0", bent=_SOL, solved=_SOLVED, valid=_VALID, dots=_DOTS,
            around="SELECT * FROM near UNION ALL SELECT fiber_id, fiber_id FROM fibers",
            dotted="""SELECT v.pointing_idx, v.fiber_id, v.target_idx, min(sqrt(power(v.x-d.dot_x,2)+power(v.y-d.dot_y,2))) AS dot_dist,
                bool_and(sqrt(power(v.x-d.dot_x,2)+power(v.y-d.dot_y,2)) > d.dot_r) AS clear
                FROM valid v JOIN around n USING (fiber_id) JOIN dots d ON d.fiber_id = n.neighbour_id GROUP BY ALL""",
            vis="SELECT v.*, d.dot_dist FROM valid v JOIN dotted d USING (pointing_idx, fiber_id, target_idx) WHERE d.clear")
_VHEAD = with_("hsc", "fibers", **_VIS)


def visible(c):
    f = fibers(c)
    dots = f.select("fiber_id", (C("cx") + 1.0).alias("dot_x"), (C("cy") - 2.5).alias("dot_y"), F.lit(0.75).alias("dot_r"))
    f = rc.with_dots(f, dots, near(c)).drop("status", "spectrograph_id")
    return rc.visible_edges(views(c), f, REACH, VIEWED, safety_margin=0.2)


@check("j18_visible_edges", _VHEAD + f"""SELECT pointing_idx, fiber_id, target_idx, {R('dist')} AS dist, {R('dot_dist')} AS dot_dist,
    {R('theta', 4)} AS theta, {R('phi', 4)} AS phi, {R('ex', 4)} AS ex, {R('ey', 4)} AS ey FROM vis""")
def _(c):
    e = visible(c).withColumn("s", F.explode("solutions"))
    return e.select("pointing_idx", "fiber_id", "target_idx", r("dist").alias("dist"), r("dot_dist").alias("dot_dist"),
                    *[r(C(f"s.{k}"), 4).alias(k) for k in ("theta", "phi", "ex", "ey")])


def _pseg(px, py, ax, ay, bx, by):
    t = f"greatest(0, least(1, (({px}-{ax})*({bx}-{ax})+({py}-{ay})*({by}-{ay}))/(power({bx}-{ax},2)+power({by}-{ay},2))))"
    return f"sqrt(power({px}-({ax}+{t}*({bx}-{ax})),2)+power({py}-({ay}+{t}*({by}-{ay})),2))"


@check("j22_colliding_elbows", _VHEAD + f"""SELECT DISTINCT a.pointing_idx, a.fiber_id, a.target_idx, b.fiber_id AS other_fiber, b.target_idx AS other_target
    FROM vis a JOIN near n USING (fiber_id) JOIN vis b ON b.pointing_idx = a.pointing_idx AND b.fiber_id = n.neighbour_id
    WHERE {_pseg('b.x', 'b.y', 'a.x', 'a.y', 'a.ex', 'a.ey')} < 3e-1""")
def _(c):
    return rc.colliding_elbows(cut(visible(c)), cut(near(c)), 0.3, 2.375)


_PARKED = """SELECT fiber_id AS bf, cx+2.375e0*cos(theta0) AS qx, cy+2.375e0*sin(theta0) AS qy,
    cx+2.375e0*cos(theta0)+2.375e0*cos(theta0+1e-5-pi()) AS px, cy+2.375e0*sin(theta0)+2.375e0*sin(theta0+1e-5-pi()) AS py FROM fibers WHERE status <> 0"""


def _side(p, q, s):
    return f"(({q}x-{p}x)*({s}y-{p}y)-({q}y-{p}y)*({s}x-{p}x))"


@check("j23_colliding_broken", with_("hsc", "fibers", **_VIS, parked=_PARKED, seg="""SELECT v.pointing_idx, p.bf, v.fiber_id, v.target_idx,
    p.px AS ax, p.py AS ay, p.qx AS bx, p.qy AS b_y, v.x AS cx, v.y AS cy, v.ex AS dx, v.ey AS dy
    FROM vis v JOIN near n USING (fiber_id) JOIN parked p ON p.bf = n.neighbour_id""") + f"""
    SELECT DISTINCT pointing_idx, bf AS broken_fiber, fiber_id, target_idx FROM seg WHERE least(
    {_pseg('ax', 'ay', 'cx', 'cy', 'dx', 'dy')}, {_pseg('bx', 'b_y', 'cx', 'cy', 'dx', 'dy')},
    {_pseg('cx', 'cy', 'ax', 'ay', 'bx', 'b_y')}, {_pseg('dx', 'dy', 'ax', 'ay', 'bx', 'b_y')}) < 2e0 OR
    (((bx-ax)*(cy-ay)-(b_y-ay)*(cx-ax))*((bx-ax)*(dy-ay)-(b_y-ay)*(dx-ax)) < 0 AND
     ((dx-cx)*(ay-cy)-(dy-cy)*(ax-cx))*((dx-cx)*(b_y-cy)-(dy-cy)*(bx-cx)) < 0)""")
def _(c):
    return rc.colliding_broken(visible(c), fibers(c), near(c), 2.0)


@check("j24_bright_star_histogram", _HEAD + """SELECT pointing_idx, CAST(least(floor(d/1e1*20), 19) AS INTEGER) AS bin, count(*) AS n FROM (
    SELECT pointing_idx, sqrt(power(v.x-f.cx,2)+power(v.y-f.cy,2)) AS d FROM views v JOIN hsc h ON h.targetid = v.target_idx
    JOIN fibers f ON f.cx BETWEEN v.x-1e1 AND v.x+1e1 AND f.cy BETWEEN v.y-1e1 AND v.y+1e1 WHERE h.g < 16.5) WHERE d <= 1e1 GROUP BY ALL""")
def _(c):
    bright = rc.project_targets(sel.in_view(c("hsc").where("g < 16.5"), POINTINGS), PLATE_SCALE)
    bright = bright.withColumn("x", C("x") + _on_plane(c, "targetid"))
    return rc.bright_star_histogram(c("fibers").select(C("cx").alias("fp_x"), C("cy").alias("fp_y")), bright)


@check("a05_a06_arm_round_trip", _VHEAD + f"SELECT pointing_idx, fiber_id, target_idx, {R('x')} AS x, {R('y')} AS y FROM vis")
def _(c):
    from ..functions.geometry import arm_position
    e = visible(c).withColumn("s", F.explode("solutions"))
    x, y = arm_position(C("s.theta"), C("s.phi"))
    return grown_join(e, c("fibers"), "fiber_id").select("pointing_idx", "fiber_id", "target_idx", r(x).alias("x"), r(y).alias("y"))


@check("a09_edge_costs", _HEAD + f"""SELECT pointing_idx, fiber_id, target_idx, {R('2e0 + 1e-1*dist + greatest(0, 1-dist)*10')} AS cost FROM edges""")
def _(c):
    e = rc.edge_cost(edges(c).withColumn("dot_dist", C("dist")), "0.1 * dist", "greatest(0, 1 - dist) * 10", 2.0)
    return e.select("pointing_idx", "fiber_id", "target_idx", r("cost").alias("cost"))


# --- visits ------------------------------------------------------------------

def many_pointings(c):
    """Pointings derived from suppliers, for the table builders."""
    k = C("s_suppkey")
    return table(c.spark, c.sf_dir, "supplier").select(
        k.cast("int").alias("pointing_idx"), (200 + (k * 7) % 60).cast("double").alias("ra"), ((k * 11) % 80).cast("double").alias("dec"),
        F.lit(0.0).alias("posang"), (k % 3).cast("int").alias("stage"), (k % 5).cast("int").alias("priority"),
        F.when(k % 4 != 0, k % 4).cast("int").alias("nvisits"), F.when(k % 5 != 0, k % 5).cast("int").alias("nrepeats"),
        F.lit(1800.0).alias("exp_time"), F.lit("2026-03-01 08:00:00").cast("timestamp").alias("obs_time"))


_PTS = """SELECT s_suppkey AS pointing_idx, CAST(200 + (s_suppkey*7)%60 AS DOUBLE) AS ra, CAST((s_suppkey*11)%80 AS DOUBLE) AS dec, s_suppkey%3 AS stage,
    CASE WHEN s_suppkey%4<>0 THEN s_suppkey%4 END AS nvisits, CASE WHEN s_suppkey%5<>0 THEN s_suppkey%5 END AS nrepeats FROM supplier"""


@check("b01_select_pointings", f"SELECT pointing_idx, stage, 3 AS nvisits, 9e2 AS exp_time FROM ({_PTS}) WHERE stage IN (0, 2)")
def _(c):
    return vi.select_pointings(many_pointings(c), [0, 2], nvisits=3, exp_time=900.0).select("pointing_idx", "stage", "nvisits", "exp_time")


_VISITS = f"""SELECT pointing_idx, stage, coalesce(nrepeats, 1) AS nrepeats, CAST(row_number() OVER (ORDER BY pointing_idx, v) - 1 AS INTEGER) AS visit_idx
    FROM (SELECT *, unnest(range(coalesce(nvisits, 1))) AS v FROM ({_PTS}))"""


@check("b02_visits", _VISITS)
def _(c):
    return vi.visits_of(many_pointings(c)).select("pointing_idx", "stage", "nrepeats", "visit_idx")


@check("j15_repeats", f"""SELECT pointing_idx, CAST(unnest(CASE WHEN nrepeats IS NULL THEN [-1] ELSE range(nrepeats) END) AS INTEGER) AS repeat_idx FROM ({_PTS})""")
def _(c):
    return vi.with_repeats(many_pointings(c)).select("pointing_idx", "repeat_idx")


_STATE = "CASE WHEN p_partkey%11=0 THEN 3 WHEN (p_partkey%8)&1=0 AND (p_partkey%8)&4=0 THEN 4 WHEN (p_partkey%8)&4<>0 THEN 2 ELSE 1 END"


@check("b04_fiber_state", f"SELECT p_partkey, {_STATE} AS state FROM part")
def _(c):
    k = C("p_partkey")
    return table(c.spark, c.sf_dir, "part").select("p_partkey", vi.fiber_state(k % 8, k % 11 == 0).alias("state"))


@check("b08_visibility_grid", f"""WITH t AS (SELECT pointing_idx, ra, dec, unnest(range(TIMESTAMP '2026-03-01 06:00:00', TIMESTAMP '2026-03-01 12:00:01', INTERVAL 30 MINUTE)) AS time FROM ({_PTS})),
    a AS (SELECT pointing_idx, time, degrees(asin(greatest(-1e0, least(1e0, sin(radians(dec))*sin(radians(1.98255e1)) + cos(radians(dec))*cos(radians(1.98255e1))
      *cos(radians(2.8046061837e2 + 3.6098564736629e2*((epoch_us(time) - 946728000000000)/8.64e10) - 1.55476e2 - ra)))))) AS alt FROM t)
    SELECT pointing_idx, strftime(time, '%H:%M') AS hhmm, {R('alt', 5)} AS alt, coalesce(alt > 0 AND 1/sin(radians(alt)) <= 3, false) AS visible FROM a""")
def _(c):
    g = vi.visibility_grid(many_pointings(c), "2026-03-01 06:00:00", "2026-03-01 12:00:00", 30)
    return g.select("pointing_idx", F.date_format("time", "HH:mm").alias("hhmm"), r("alt", 5).alias("alt"), "visible")


@check("x03_annulus_as_difference", _HEAD + "SELECT pointing_idx, fiber_id, target_idx FROM cand WHERE dist <= 4.75e0 AND dist > 2e0")
def _(c):
    f = fibers(c).where("NOT broken").select("fiber_id", "cx", "cy")
    outer = rc.plane_pairs(views(c), f, REACH).where(C("dist") <= REACH)
    inner = rc.plane_pairs(views(c), f, 2.0).where(C("dist") <= 2.0)
    cols = ["pointing_idx", "fiber_id", "target_idx"]
    return outer.select(*cols).exceptAll(inner.select(*cols))


@check("b06_design_list", f"""SELECT v.pointing_idx, v.visit_idx, v.stage, CASE WHEN v.visit_idx%2 = 0 THEN v.visit_idx*10 END AS design_id FROM ({_VISITS}) v""")
def _(c):
    v = vi.visits_of(many_pointings(c))
    d = v.where("visit_idx % 2 = 0").select("pointing_idx", "visit_idx", (C("visit_idx") * 10).alias("design_id"))
    return vi.design_list(v, d).select("pointing_idx", "visit_idx", "stage", "design_id")
