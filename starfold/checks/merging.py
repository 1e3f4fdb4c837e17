"""Checks of the list merge, assignment, verification, reports and exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.astro import haversine_deg
from ..operators import assign as asg, export as ex, merge as mg, report as rp, verify as ve
from ..operators.blocks import grown_join
from ..session import cut
from ..sources.fixtures import table, with_
from .maps import _bin
from .matching import _NEAREST, _ONE, _pairs
from .reaching import _HEAD, _REACH, edges
from .registry import HAV, R, UNIFORM, check, r

C = F.col


# --- unified targets ----------------------------------------------------------

@check("p07_unify", with_("list_a", "list_b", "cal") + """SELECT 'a' AS key, targetid, 2e3 AS epoch, 'sci' AS prefix, CAST(0 AS INTEGER) AS penalty,
    exp_time, 3e0 AS priority, 'sci_P3' AS class, 100 AS cost, CAST(NULL AS DOUBLE) AS pmra FROM list_a WHERE priority > 2
    UNION ALL SELECT 'b', targetid, NULL, 'sci', 0, exp_time, CASE WHEN targetid%5 > 0 THEN priority END,
    CASE WHEN targetid%5 > 0 THEN 'sci_P' || CAST(CAST(priority AS INT) AS VARCHAR) END, CASE WHEN targetid%5 > 0 THEN CAST(priority AS INT)*7 + 1 ELSE 0 END, NULL FROM list_b
    UNION ALL SELECT 'cal', targetid, NULL, 'cal', 0, NULL, NULL, 'cal', 55, 1e0 FROM cal""")
def _(c):
    costs = {f"sci_P{k}": 7 * k + 1 for k in range(10)} | {"cal": 55}
    a = mg.unify(c("list_a").withColumn("epoch", F.lit("J2000.0")), "a", "sci", priority=3.0, non_observation_cost=100, mask=C("priority") > 2)
    b = c("list_b").withColumns({"priority": F.when(C("targetid") % 5 > 0, C("priority")), "class": F.lit("other"), "pmra": F.lit(2.0)})
    cal = c("cal").withColumns({"pmra": F.lit(1.0), "pmdec": F.lit(1.0)})
    df = a.unionByName(mg.unify(b, "b", "sci", class_costs=costs)).unionByName(mg.unify(cal, "cal", "cal", exp_time=9.0, priority=1.0, class_costs=costs))
    return df.select("pmra", "key", "targetid", "epoch", "prefix", "penalty", "exp_time", "priority", "class", C("non_observation_cost").alias("cost"))


_T0 = """SELECT 'cal' AS key, targetid, ra, dec, 'cal' AS prefix, NULL::DOUBLE AS pmra, NULL::DOUBLE AS exp_time, NULL::DOUBLE AS priority, 'cal' AS class,
    row_number() OVER (ORDER BY targetid) - 1 AS idx, 7 AS cost FROM cal"""


def _step(k: int, lst: str, epoch_pm: str) -> dict[str, str]:
    """One merge step as CTEs: pairs, one-to-one matches, update, append."""
    lab = "'sci_P' || CAST(CAST(n.priority AS BIGINT) AS VARCHAR)"
    cost = "1000 - 100*CAST(n.priority AS INTEGER)"
    low = "(n.targetid IS NOT NULL AND (t.priority IS NULL OR n.priority < t.priority))"
    return {
        f"l{k}": f"SELECT *, {epoch_pm} AS pmra FROM {lst}",
        f"p{k}": _pairs(f"l{k}", f"t{k - 1}", "targetid", "idx", "0.1"),
        f"n{k}": f"SELECT lid, rid, sep FROM p{k} QUALIFY row_number() OVER (PARTITION BY lid ORDER BY sep, rid) = 1",
        f"o{k}": f"SELECT lid, rid FROM n{k} QUALIFY row_number() OVER (PARTITION BY rid ORDER BY sep, lid) = 1",
        f"t{k}": f"""SELECT t.key, t.targetid, t.ra, t.dec, t.prefix,
            CASE WHEN n.targetid IS NOT NULL AND t.pmra IS NULL THEN n.pmra ELSE t.pmra END AS pmra,
            CASE WHEN n.targetid IS NOT NULL THEN greatest(t.exp_time, n.exp_time) ELSE t.exp_time END AS exp_time,
            CASE WHEN {low} THEN n.priority ELSE t.priority END AS priority,
            CASE WHEN {low} AND t.prefix = 'sci' THEN {lab} ELSE t.class END AS class, t.idx,
            CASE WHEN n.targetid IS NOT NULL THEN greatest(t.cost, {cost}) ELSE t.cost END AS cost
            FROM t{k - 1} t LEFT JOIN o{k} o ON o.rid = t.idx LEFT JOIN l{k} n ON n.targetid = o.lid
            UNION ALL SELECT '{lst}', n.targetid, n.ra, n.dec, 'sci', n.pmra, n.exp_time, n.priority, {lab},
            (SELECT count(*) FROM t{k - 1}) + row_number() OVER (ORDER BY n.targetid) - 1, {cost}
            FROM l{k} n WHERE n.targetid NOT IN (SELECT lid FROM o{k})"""}


_PM = "CASE WHEN targetid%4=0 THEN (targetid%17)/1e1 END"
_MERGE = dict(t0=_T0, **_step(1, "list_a", _PM), **_step(2, "list_b", _PM), t3="""SELECT * FROM t2 UNION ALL
    SELECT 'sky', targetid, ra, dec, 'sky', NULL, NULL, NULL, 'sky', (SELECT count(*) FROM t2) + row_number() OVER (ORDER BY targetid) - 1, 3 FROM sky""")


CLASS_COSTS = {f"sci_P{k}": 1000 - 100 * k for k in range(10)} | {"cal": 7, "sky": 3}


def raw_lists(c):
    pm = F.when(C("targetid") % 4 == 0, (C("targetid") % 17) / 10.0)
    return [mg.TargetList("list_a", "sci", c("list_a").withColumns({"pmra": pm, "pmdec": pm})),
            mg.TargetList("list_b", "sci", c("list_b").withColumns({"pmra": pm, "pmdec": pm})),
            mg.TargetList("sky", "sky", c("sky")), mg.TargetList("cal", "cal", c("cal"))]


def merged(c):
    return mg.merge_lists(raw_lists(c), 0x600000000)


@check("plan_import", with_("cal", "sky", "list_a", "list_b", **_MERGE) + "SELECT targetid, idx AS target_idx, class, priority, cost FROM t3")
def _(c):
    from ..plans.survey import import_lists
    targets = import_lists(raw_lists(c), CLASS_COSTS, 0x600000000).targets
    return targets.select("targetid", "target_idx", "class", "priority", C("non_observation_cost").alias("cost"))


@check("u01_merge_lists", with_("cal", "sky", "list_a", "list_b", **_MERGE) + f"""SELECT key, targetid, idx AS target_idx, prefix, {R('pmra')} AS pmra,
    exp_time, priority, class, {R('ra', 7)} AS ra, {R('dec', 7)} AS dec FROM t3""")
def _(c):
    return merged(c)[0].select("key", "targetid", "target_idx", "prefix", r("pmra").alias("pmra"), "exp_time", "priority", "class",
                               r("RA", 7).alias("ra"), r("Dec", 7).alias("dec"))


@check("u01_merge_links", with_("cal", "sky", "list_a", "list_b", **_MERGE) + """
    SELECT 'cal' AS key, targetid, idx AS target_idx, targetid AS objid FROM t0
    UNION ALL SELECT 'sky', targetid, idx, targetid FROM t3 WHERE key = 'sky'
    UNION ALL SELECT 'list_a', targetid, idx, 25769803776 | idx FROM t1 WHERE key = 'list_a'
    UNION ALL SELECT 'list_a', lid, rid, 25769803776 | rid FROM o1
    UNION ALL SELECT 'list_b', targetid, idx, 25769803776 | idx FROM t2 WHERE key = 'list_b'
    UNION ALL SELECT 'list_b', lid, rid, 25769803776 | rid FROM o2""")
def _(c):
    return merged(c)[1]


@check("u02_update_targets", with_("list_a", "list_b") + """SELECT a.targetid, greatest(a.exp_time, b.exp_time) AS exp_time, least(a.priority, b.priority) AS priority,
    'sci_P' || CAST(CAST(least(a.priority, b.priority) AS BIGINT) AS VARCHAR) AS class FROM list_a a LEFT JOIN list_b b USING (targetid)""")
def _(c):
    a = mg.unify(c("list_a"), "a", "sci").withColumn("target_idx", C("targetid"))
    b = mg.unify(c("list_b"), "b", "sci").withColumn("target_idx", C("targetid"))
    return mg.update_targets(a, b, "sci").select("targetid", "exp_time", "priority", "class")


@check("u03_append_targets", with_("list_a") + "SELECT targetid, 500 + row_number() OVER (ORDER BY targetid) - 1 AS target_idx FROM list_a")
def _(c):
    return mg.append_targets(None, mg.unify(c("list_a"), "a", "sci"), 500).select("targetid", "target_idx")


@check("u04_merge_flux_lists", with_("photometry_long", ranked="""SELECT target_idx//2 AS t, target_idx%2 AS list_rank, pos, filter, psf_flux FROM photometry_long""",
                                     won="SELECT * FROM ranked QUALIFY row_number() OVER (PARTITION BY t, filter ORDER BY list_rank, pos) = 1")
       + f"SELECT t AS target_idx, CAST(row_number() OVER (PARTITION BY t ORDER BY list_rank, pos) - 1 AS INTEGER) AS k, filter, {R('psf_flux')} AS psf FROM won")
def _(c):
    p = c("photometry_long").select(F.floor(C("target_idx") / 2).alias("target_idx"), (C("target_idx") % 2).alias("list_rank"),
                                    "pos", "filter", C("psf_flux").alias("psf"))
    out = mg.merge_flux_lists(p).select("target_idx", F.posexplode("fluxes").alias("k", "f"))
    return out.select("target_idx", "k", "f.filter", r(C("f.psf")).alias("psf"))


@check("u04_duplicate_keys", "SELECT l_orderkey*10+l_linenumber AS id, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def _(c):
    l = table(c.spark, c.sf_dir, "lineitem").select((C("l_orderkey") * 10 + C("l_linenumber")).alias("id"))
    return mg.duplicate_keys(l, "id")


FILTERS = ["g_ps1", "g_hsc", "i_old_hsc", "bp_gaia", "nb515_hsc"]


def _wide(skip: bool) -> str:
    cols = ", ".join(f"max(mag) FILTER (filter = '{f}') AS {f}_mag, max(err) FILTER (filter = '{f}') AS {f}_mag_err" for f in FILTERS)
    keep = "WHERE psf_flux IS NOT NULL" if skip else ""
    return with_("photometry_long", won=f"""SELECT target_idx//2 AS t, filter, {R('3.14e1-2.5e0*log10(psf_flux)')} AS mag, {R('2.5e0/ln(1e1)*(pos+1)/psf_flux')} AS err
        FROM photometry_long {keep} QUALIFY row_number() OVER (PARTITION BY target_idx//2, filter ORDER BY target_idx%2, pos) = 1""") + \
        f"SELECT t AS target_idx, {cols} FROM won GROUP BY t"


def _wide_query(c, skip: bool):
    p = c("photometry_long").select(F.floor(C("target_idx") / 2).alias("target_idx"), (C("target_idx") % 2).alias("list_rank"),
                                    C("pos").alias("kind_rank"), "filter", F.lit(None).cast("double").alias("mag"),
                                    F.lit(None).cast("double").alias("mag_err"), C("psf_flux").alias("flux"), (C("pos") + 1.0).alias("flux_err"))
    w = mg.wide_magnitudes(p, FILTERS, skip)
    return w.select("target_idx", *[r(n).alias(n) for n in w.columns if n != "target_idx"])


check("u06_wide_magnitudes", _wide(False))(lambda c: _wide_query(c, False))
check("u06_wide_magnitudes_skip_nulls", _wide(True))(lambda c: _wide_query(c, True))


@check("j13_close_matches", with_("hsc") + f"""SELECT targetid FROM hsc WHERE 3.6e3*{HAV('ra', 'dec', 'ra', 'dec+(targetid%5)*3e-2/3.6e3')} <= 0.1""")
def _(c):
    t = c("hsc").select(C("targetid").alias("target_idx"), "targetid", C("ra").alias("RA"), C("dec").alias("Dec"))
    l = t.withColumn("Dec", C("Dec") + (C("targetid") % 5) * 3e-2 / 3.6e3)
    return mg.close_matches(t, l, 0.1).select("targetid")


# --- assignments over the fixture edges ---------------------------------------

# A deterministic assignment: each fiber's nearest target per pointing, then each target's nearest fiber.
_ASG = dict(_REACH, f1="SELECT * FROM edges QUALIFY row_number() OVER (PARTITION BY pointing_idx, fiber_id ORDER BY dist, target_idx) = 1",
            a="""SELECT pointing_idx AS visit_idx, pointing_idx, fiber_id, target_idx, dist, target_idx%4 AS cls, CASE target_idx%4 WHEN 0 THEN 'cal' WHEN 1 THEN 'sky' ELSE 'sci' END AS prefix
                FROM f1 QUALIFY row_number() OVER (PARTITION BY pointing_idx, target_idx ORDER BY dist, fiber_id) = 1""")
_AHEAD = with_("hsc", "fibers", **_ASG)


def nearest_edges(c):
    return asg.pick_first(edges(c), [C("dist")])


def assignments(c):
    e = edges(c).groupBy("pointing_idx", "fiber_id").agg(F.min(F.struct("dist", "target_idx")).alias("m")).select(
        "pointing_idx", "fiber_id", "m.*")
    a = e.groupBy("pointing_idx", "target_idx").agg(F.min(F.struct("dist", "fiber_id")).alias("m")).select("pointing_idx", "target_idx", "m.*")
    kind = C("target_idx") % 4
    return a.withColumns({"visit_idx": C("pointing_idx"), "cls": kind,
                          "prefix": F.when(kind == 0, "cal").when(kind == 1, "sky").otherwise("sci")})


for _by, _order, _desc in (("brightness", "g", False), ("priority", "prio", False), ("probability", "clg", True)):
    def _rank(c, by=_by, order=_order):
        h = c("hsc").select(C("targetid").alias("target_idx"), "g", "clg", (C("targetid") % 7).cast("double").alias("prio"))
        return asg.rank_candidates(edges(c).join(h, "target_idx"), by, order).select("pointing_idx", "fiber_id", "target_idx", "rank")
    check(f"w02_rank_by_{_by}", _HEAD + f"""SELECT pointing_idx, fiber_id, target_idx, CAST(row_number() OVER (PARTITION BY pointing_idx, fiber_id
        ORDER BY {_order} {'DESC' if _desc else ''}, target_idx) AS INTEGER) AS rank
        FROM (SELECT e.*, h.g, h.clg, CAST(h.targetid%7 AS DOUBLE) AS prio FROM edges e JOIN hsc h ON h.targetid = e.target_idx)""")(_rank)


@check("w02_rank_random", _HEAD + f"""SELECT pointing_idx, fiber_id, target_idx, CAST(row_number() OVER (PARTITION BY pointing_idx, fiber_id
    ORDER BY {UNIFORM("target_idx || '/3'")}, target_idx) AS INTEGER) AS rank FROM edges""")
def _(c):
    return asg.rank_candidates(edges(c), "random", seed=3).select("pointing_idx", "fiber_id", "target_idx", "rank")


@check("w03_pick_first", _HEAD + """SELECT p.pointing_idx, f.fiber_id, coalesce(e.target_idx, -1) AS target_idx FROM fibers f CROSS JOIN (VALUES (0),(1)) p(pointing_idx)
    LEFT JOIN (SELECT * FROM edges QUALIFY row_number() OVER (PARTITION BY pointing_idx, fiber_id ORDER BY dist, target_idx) = 1) e USING (pointing_idx, fiber_id)""")
def _(c):
    return asg.with_all_fibers(nearest_edges(c), c("fibers"), [0, 1])


_PF = "row_number() OVER (PARTITION BY fiber_id ORDER BY dist, target_idx) = 1"


@check("w04_pick_over_pointings", with_("hsc", "fibers", **_REACH, e0=f"SELECT * FROM edges WHERE pointing_idx = 0 QUALIFY {_PF}",
                                        a0="SELECT pointing_idx, min(fiber_id) AS fiber_id, target_idx FROM e0 GROUP BY 1, 3",
                                        e1=f"SELECT * FROM edges WHERE pointing_idx = 1 AND target_idx NOT IN (SELECT target_idx FROM a0) QUALIFY {_PF}")
       + "SELECT * FROM a0 UNION ALL SELECT pointing_idx, min(fiber_id), target_idx FROM e1 GROUP BY 1, 3")
def _(c):
    return asg.pick_over_pointings(edges(c), [0, 1], [C("dist")])


@check("w05_conflict_free_assignment")
def _(c):
    e = edges(c).select("pointing_idx", "fiber_id", "target_idx", C("dist").alias("cost"), (C("target_idx") % 5).cast("double").alias("class_cost"))
    need = c("hsc").select(C("targetid").alias("target_idx"), (1 + C("targetid") % 2).alias("req_visits"))
    visits = [dict(visit_idx=0, pointing_idx=0, nrepeats=1), dict(visit_idx=1, pointing_idx=1, nrepeats=2)]
    return asg.assign_visits(e, visits, need).select("visit_idx", "fiber_id", "target_idx", r("cost").alias("cost"))


@check("w06_slit_groups", with_("fibers") + """SELECT fiber_id, CAST(floor((row_number() OVER (PARTITION BY spectrograph_id ORDER BY fiber_id) - 1)
    / count(*) OVER (PARTITION BY spectrograph_id) * 8) + (spectrograph_id-1)*8 AS INTEGER) AS slit_group FROM fibers""")
def _(c):
    return asg.slit_groups(c("fibers")).select("fiber_id", "slit_group")


_SEEDS = asg.ring_seeds()


@check("w07_nearest_seed", with_("fibers", seeds="SELECT * FROM (VALUES " + ", ".join(f"({k}, {x!r}, {y!r})" for k, (x, y) in enumerate(_SEEDS)) + ") v(k, sx, sy)")
       + """SELECT fiber_id, CAST(arg_min(k, (power(cx-sx,2)+power(cy-sy,2), k)) AS INTEGER) AS location_group FROM fibers CROSS JOIN seeds GROUP BY fiber_id""")
def _(c):
    return asg.nearest_seed(c("fibers"), _SEEDS).select("fiber_id", "location_group")


@check("w08_ring_sectors", with_("fibers", lab="""SELECT fiber_id, sqrt(cx*cx+cy*cy) AS rr, CAST(2*floor((atan2(cy,cx)+pi())/(2*pi()/6))
    + CASE WHEN sqrt(cx*cx+cy*cy) >= 150 THEN 1 ELSE 0 END + CASE WHEN sqrt(cx*cx+cy*cy) >= 240 THEN 1 ELSE 0 END AS INTEGER) AS l FROM fibers""")
       + "SELECT fiber_id, CASE WHEN rr < 60 THEN (SELECT max(l) FROM lab) + 1 ELSE l END AS sector_group FROM lab")
def _(c):
    return asg.ring_sectors(c("fibers")).select("fiber_id", "sector_group")


@check("w10_limit_per_group", with_("list_a") + "SELECT targetid, priority FROM list_a QUALIFY row_number() OVER (PARTITION BY priority ORDER BY exp_time, targetid) <= 100")
def _(c):
    return asg.limit_per_group(c("list_a"), ["priority"], "exp_time", "targetid", 100).select("targetid", "priority")


@check("w10_filled_groups", _HEAD + """SELECT v.v AS visit_idx, CAST(s.g AS INTEGER) AS grp, 0 AS twice, 0 AS strange, 0 AS fixable
    FROM (VALUES (0),(1)) v(v) CROSS JOIN (SELECT DISTINCT fiber_id%97 AS g FROM fibers) s""")
def _(c):
    # groups of about twenty fibers, of which some have no working fiber in reach of a free target; none may stay short where a path would help
    least = 14
    e = cut(edges(c).select(C("pointing_idx").alias("visit_idx"), "fiber_id", "target_idx", C("dist").alias("cost"), (C("target_idx") % 5).cast("double").alias("class_cost")))
    groups = c("fibers").select("fiber_id", (C("fiber_id") % 97).cast("int").alias("grp"))
    first = asg.assign_visit(e.where("target_idx % 7 < 2"))
    got = asg.fill_short_groups(first, e, groups, least)
    return asg.group_faults(got, e, groups, least)


@check("w11_sorted_output", with_("list_a") + "SELECT targetid, priority FROM list_a ORDER BY priority, targetid")
def _(c):
    return c("list_a").select("targetid", "priority").orderBy("priority", "targetid")


@check("w12_top_rows", with_("list_a") + "SELECT targetid FROM list_a ORDER BY targetid LIMIT 50")
def _(c):
    return c("list_a").select("targetid").orderBy("targetid").limit(50)


# --- verification -------------------------------------------------------------

@check("v02_list_problems", with_("list_a") + """SELECT 'duplicate targetid' AS problem, 'warning' AS severity, targetid//2 AS targetid, count(*) AS n FROM list_a GROUP BY 3 HAVING count(*) > 1
    UNION ALL SELECT 'missing priority', 'error', targetid//2, 1 FROM list_a WHERE targetid%11 = 0
    UNION ALL SELECT 'bad exposure time', 'error', targetid//2, 1 FROM list_a WHERE targetid%13 = 0""")
def _(c):
    df = c("list_a").select(F.floor(C("targetid") / 2).alias("targetid"), F.when(C("targetid") % 11 != 0, C("priority")).alias("priority"),
                            F.when(C("targetid") % 13 == 0, -1.0).otherwise(C("exp_time")).alias("exp_time"))
    return ve.list_problems(df, "sci")


@check("v03_visit_problems", with_("list_a") + """SELECT 'too few visits' AS problem, s_suppkey AS pointing_idx, CAST((s_suppkey%4+1)*(s_suppkey%3+1) AS INTEGER) AS n FROM supplier
    WHERE (s_suppkey%4+1)*(s_suppkey%3+1) < (SELECT max(exp_time/1800) FROM list_a)
    UNION ALL SELECT 'unequal exposure times', NULL, 2""")
def _(c):
    k = C("s_suppkey")
    p = table(c.spark, c.sf_dir, "supplier").select(k.cast("int").alias("pointing_idx"), (k % 4 + 1).cast("int").alias("nvisits"),
                                                    (k % 3 + 1).cast("int").alias("nrepeats"), (F.lit(900.0) * (1 + k % 2)).alias("exp_time"))
    return ve.visit_problems(c("list_a").select((C("exp_time") / 1800).cast("int").alias("req_visits")), p)


@check("v03_cost_problems", "SELECT p_partkey FROM part WHERE p_size < p_partkey%40")
def _(c):
    df = table(c.spark, c.sf_dir, "part").select("p_partkey", C("p_size").alias("partial_observation_cost"), (C("p_partkey") % 40).alias("non_observation_cost"))
    return ve.cost_problems(df).select("p_partkey")


@check("v04_assignment_conflicts", _HEAD + """SELECT 'fiber with several targets' AS problem, pointing_idx AS visit_idx, fiber_id AS id, count(*) AS n FROM edges GROUP BY 2, 3 HAVING count(*) > 1
    UNION ALL SELECT 'target on several fibers', pointing_idx, target_idx, count(*) FROM edges GROUP BY 2, 3 HAVING count(*) > 1""")
def _(c):
    return ve.assignment_conflicts(edges(c).withColumn("visit_idx", C("pointing_idx")))


@check("v04_class_limits", _AHEAD + """SELECT 'sci' AS class, -1 AS visit_idx, count(DISTINCT target_idx) AS n FROM a WHERE prefix = 'sci' HAVING count(DISTINCT target_idx) > 10
    UNION ALL SELECT prefix, visit_idx, count(DISTINCT target_idx) FROM a WHERE prefix IN ('cal', 'sky') GROUP BY 1, 2 HAVING count(DISTINCT target_idx) > 20""")
def _(c):
    classes = assignments(c).select(C("prefix").alias("class")).distinct().select(
        "class", F.lit(0).alias("min_targets"), F.when(C("class") == "sci", 10).otherwise(20).alias("max_targets"), (C("class") != "sci").alias("per_visit"))
    return ve.class_limits(assignments(c).withColumn("class", C("prefix")), classes, [0, 1]).select("class", "visit_idx", "n")


@check("v04_group_limits", with_("hsc", "fibers", **_ASG, g="SELECT fiber_id, fiber_id%30 AS grp FROM fibers") + """SELECT grp, visit_idx, coalesce(n, 0) AS n FROM (SELECT DISTINCT grp FROM g) x CROSS JOIN (VALUES (0),(1)) v(visit_idx)
    LEFT JOIN (SELECT grp, visit_idx, count(*) AS n FROM a JOIN g USING (fiber_id) WHERE prefix = 'cal' GROUP BY 1, 2) y USING (grp, visit_idx)
    WHERE coalesce(n, 0) < 15 OR coalesce(n, 0) > 17""")
def _(c):
    g = c("fibers").select("fiber_id", (C("fiber_id") % 30).alias("grp"))
    return ve.group_limits(assignments(c).withColumn("class", C("prefix")), g, "grp", ["cal"], 15, 17, [0, 1])


@check("v04_thin_groups", with_("hsc", "fibers", **_REACH, g="SELECT fiber_id, fiber_id%30 AS grp FROM fibers")
       + "SELECT pointing_idx, grp, count(DISTINCT target_idx) AS n FROM edges JOIN g USING (fiber_id) GROUP BY 1, 2 HAVING count(DISTINCT target_idx) < 3*400")
def _(c):
    return ve.thin_groups(edges(c), c("fibers").select("fiber_id", (C("fiber_id") % 30).alias("grp")), "grp", 400)


@check("v04_reserved_fibers", _AHEAD + "SELECT visit_idx, (SELECT count(*) FROM fibers) - count(DISTINCT fiber_id) AS free FROM a GROUP BY 1 HAVING (SELECT count(*) FROM fibers) - count(DISTINCT fiber_id) < 400")
def _(c):
    return ve.reserved_fibers(assignments(c), c("fibers"), 400).select("visit_idx", "free")


@check("v04_over_budget", _AHEAD + "SELECT prefix AS class, CAST(count(*)*1800 AS DOUBLE) AS used_sec FROM a GROUP BY 1 HAVING count(*)*1800 > 3600*400")
def _(c):
    a = assignments(c).withColumn("class", C("prefix"))
    budgets = a.select("class").distinct().withColumn("hours", F.lit(400.0))
    return ve.over_budget(a, budgets, 1800.0).select("class", "used_sec")


@check("v04_forbidden_used", _AHEAD + """SELECT 'forbidden target' AS problem, visit_idx, target_idx AS t1, NULL AS t2 FROM a WHERE target_idx IN (SELECT targetid FROM hsc WHERE targetid%50 = 3)
    UNION ALL SELECT 'forbidden pair', x.visit_idx, x.target_idx, y.target_idx FROM a x JOIN a y ON x.visit_idx = y.visit_idx AND y.target_idx = x.target_idx + 1 WHERE x.target_idx%3 = 0""")
def _(c):
    h = c("hsc").select(C("targetid").alias("target_idx"))
    pairs = h.where("target_idx % 3 = 0").select(C("target_idx").alias("t1"), (C("target_idx") + 1).alias("t2"))
    return ve.forbidden_used(assignments(c), h.where("target_idx % 50 = 3"), pairs)


@check("v05_objective", with_("hsc", "fibers", **_ASG, got="SELECT target_idx, count(*) AS got FROM a GROUP BY 1",
                              t="""SELECT h.targetid, (h.targetid%4+1)*100 AS cost, (h.targetid%4+1)*1000 AS pcost, 1+h.targetid%3 AS req, coalesce(got, 0) AS got
                                FROM hsc h LEFT JOIN got g ON g.target_idx = h.targetid""") + f"""
    SELECT 'non_observation' AS term, CAST(sum(CASE WHEN got = 0 THEN cost ELSE 0 END) AS DOUBLE) AS value FROM t WHERE targetid%4 > 0
    UNION ALL SELECT 'partial_observation', CAST(sum(CASE WHEN got > 0 THEN pcost*greatest(least(req, 2)-got, 0) ELSE 0 END) AS DOUBLE) FROM t WHERE targetid%4 > 0
    UNION ALL SELECT 'penalty', CAST(sum(CASE WHEN got > 0 THEN targetid%7 ELSE 0 END) AS DOUBLE) FROM t WHERE targetid%4 > 0
    UNION ALL SELECT 'calibration', 1e2*((SELECT count(*) FROM (SELECT DISTINCT pointing_idx, target_idx FROM edges WHERE target_idx%4 = 0))
      - (SELECT count(*) FROM a WHERE target_idx%4 = 0))
    UNION ALL SELECT 'edges', {R('sum(dist)', 4)} FROM a UNION ALL SELECT 'unassigned_fibers', 7e0*((SELECT count(*) FROM fibers)*2 - count(*)) FROM a""")
def _(c):
    k = C("targetid")
    t = c("hsc").select(k.alias("target_idx"), (k % 4).cast("int").alias("class"), (1 + k % 3).alias("req_visits"), (k % 7).alias("penalty"))
    seen = edges(c).select(C("pointing_idx").alias("visit_idx"), "target_idx")
    cost, partial = {k: (k + 1) * 100 for k in range(4)}, {k: (k + 1) * 1000 for k in range(4)}
    n = c("fibers").count()
    out = ve.objective(assignments(c).withColumn("cost", C("dist")), t, cost, partial, n, [0, 1], 7.0, 2, (0,), seen)
    return out.select("term", r("value", 4).alias("value"))


@check("v06_design_problems", with_("fibers") + """SELECT 'duplicate fiber' AS problem, fiber_id%5 AS visit_idx, fiber_id%100 AS fiber_id, count(*) AS n FROM fibers GROUP BY 2, 3 HAVING count(*) > 1
    UNION ALL SELECT 'coordinates without target', fiber_id%5, fiber_id%100, 1 FROM fibers WHERE fiber_id%7 = 0 AND fiber_id%2 = 0""")
def _(c):
    k = C("fiber_id")
    d = c("fibers").select((k % 5).alias("visit_idx"), (k % 100).alias("fiber_id"), F.when(k % 7 == 0, -1).otherwise(k).alias("target_idx"),
                           F.when(k % 2 == 0, C("cx")).alias("ra"), F.when(k % 2 == 0, C("cy")).alias("dec"))
    return ve.design_problems(d)


@check("v07_coverage", _HEAD + f"""SELECT pointing_idx, count(*) FILTER (sqrt(x*x+y*y) < 150) AS n, {R('min(x)')} AS x_lo FROM views GROUP BY 1
    HAVING count(*) FILTER (sqrt(x*x+y*y) < 150) < 20000 OR least(abs(min(x)), abs(max(x)), abs(min(y)), abs(max(y))) < 190""")
def _(c):
    from .reaching import views
    return ve.coverage_problems(views(c), 150.0, 20000).select("pointing_idx", "n", r("x_lo").alias("x_lo"))


@check("v08_resolve_collisions", _AHEAD.rstrip() + """, p AS (SELECT visit_idx, fiber_id AS fa, fiber_id + 1 AS fb FROM a WHERE fiber_id%5 = 0),
    q AS (SELECT p.*, x.cls AS ca, y.cls AS cb FROM p LEFT JOIN a x ON x.visit_idx = p.visit_idx AND x.fiber_id = fa LEFT JOIN a y ON y.visit_idx = p.visit_idx AND y.fiber_id = fb),
    gone AS (SELECT visit_idx, CASE WHEN cb IS NULL OR ca <= cb THEN fa ELSE fb END AS fiber_id FROM q)
    SELECT visit_idx, fiber_id, target_idx FROM a WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.visit_idx = a.visit_idx AND g.fiber_id = a.fiber_id)""")
def _(c):
    a = assignments(c).withColumn("class_cost", C("cls"))
    pairs = a.where("fiber_id % 5 = 0").select("visit_idx", C("fiber_id").alias("fiber_a"), (C("fiber_id") + 1).alias("fiber_b"))
    return ve.resolve_collisions(a, pairs).select("visit_idx", "fiber_id", "target_idx")


# --- reports --------------------------------------------------------------------

_SUM = dict(_ASG, sm="""SELECT h.targetid AS target_idx, CASE h.targetid%4 WHEN 0 THEN 'cal' WHEN 1 THEN 'sky' ELSE 'sci' END AS class, h.targetid%10 AS priority,
    1+h.targetid%3 AS req_visits, h.targetid%2 AS done_visits, coalesce(n, 0) AS num_visits FROM hsc h
    LEFT JOIN (SELECT target_idx, sum(1+visit_idx) AS n FROM a GROUP BY 1) q ON q.target_idx = h.targetid""")
_SHEAD = with_("hsc", "fibers", **_SUM)


def targets(c):
    k = C("targetid")
    return c("hsc").select(k.alias("target_idx"), F.when(k % 4 == 0, "cal").when(k % 4 == 1, "sky").otherwise("sci").alias("class"),
                           (k % 10).alias("priority"), (1 + k % 3).alias("req_visits"), (k % 2).alias("done_visits"), "ra", "dec")


def visits(c):
    return c("fibers").select(C("fiber_id").alias("visit_idx"), (C("fiber_id") + 1).alias("nrepeats"))


def summed(c):
    return rp.summary(targets(c), assignments(c), visits(c))


@check("g01_count_per_key", _AHEAD + "SELECT target_idx, count(*) AS n FROM a GROUP BY 1")
def _(c):
    return rp.count_per_key(assignments(c), ["target_idx"])


@check("g02_distinct_targets", _AHEAD + "SELECT prefix, visit_idx, count(DISTINCT target_idx) AS n FROM a GROUP BY 1, 2")
def _(c):
    return rp.distinct_targets(assignments(c), ["prefix", "visit_idx"])


@check("g03_visit_table", _AHEAD + """SELECT pointing_idx, visit_idx, prefix, count(DISTINCT target_idx) AS n FROM a
    GROUP BY GROUPING SETS ((pointing_idx, visit_idx, prefix), (prefix))""")
def _(c):
    return rp.visit_table(assignments(c))


@check("g04_completeness", _SHEAD + """SELECT class, count(*) AS n, count(*) FILTER (num_visits > 0) AS observed, count(*) FILTER (num_visits = 0) AS missed,
    count(*) FILTER (done_visits < req_visits AND num_visits > 0) AS partial, count(*) FILTER (num_visits > req_visits) AS over FROM sm GROUP BY 1""")
def _(c):
    return rp.completeness(summed(c))


@check("g05_priority_fractions", _SHEAD + f"SELECT priority, count(*) AS n_all, count(*) FILTER (num_visits > 0) AS n_assigned, {R('count(*) FILTER (num_visits > 0)/count(*)')} AS fraction FROM sm GROUP BY 1")
def _(c):
    return rp.priority_fractions(summed(c)).withColumn("fraction", r("fraction"))


@check("g06_visit_histogram", with_("list_a") + """SELECT CAST(v AS INTEGER) AS value, coalesce(n, 0) AS n FROM (SELECT unnest(range(0, 13)) AS v) g
    LEFT JOIN (SELECT ceil(exp_time/9e2) AS v, count(*) AS n FROM list_a GROUP BY 1) h USING (v)""")
def _(c):
    return rp.dense_counts(c("list_a").withColumn("v", F.ceil(C("exp_time") / 900.0)), "v")


@check("g08_list_contributions", with_("hsc", "gaia") + f"""SELECT key, count(*) AS n, count(pmra) AS n_pm, {R('count(pmra)/(SELECT count(*) FROM gaia)')} AS pm_fraction
    FROM (SELECT CASE source_id%3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS key, pmra FROM gaia) GROUP BY 1""")
def _(c):
    k = C("source_id") % 3
    return rp.list_contributions(c("gaia").withColumn("key", F.when(k == 0, "a").when(k == 1, "b").otherwise("c"))).withColumn("pm_fraction", r("pm_fraction"))


@check("g09_assignment_summary", _SHEAD + "SELECT target_idx, CAST(num_visits AS BIGINT) AS num_visits FROM sm")
def _(c):
    return summed(c).select("target_idx", "num_visits")


_LOAD = dict(_REACH, fl="""SELECT p.pointing_idx, f.fiber_id, coalesce(n, 0) AS n FROM fibers f CROSS JOIN (VALUES (0),(1)) p(pointing_idx)
    LEFT JOIN (SELECT pointing_idx, fiber_id, count(DISTINCT target_idx) AS n FROM edges GROUP BY 1, 2) q USING (pointing_idx, fiber_id)""")


@check("g10_fiber_load", with_("hsc", "fibers", **_LOAD) + "SELECT * FROM fl")
def _(c):
    return rp.fiber_load(edges(c), c("fibers"), [0, 1])


@check("g10_load_histogram", with_("hsc", "fibers", **_LOAD) + "SELECT pointing_idx, n AS n_targets, count(*) AS n_fibers FROM fl GROUP BY 1, 2")
def _(c):
    return rp.load_histogram(rp.fiber_load(edges(c), c("fibers"), [0, 1]))


@check("g10_group_load", with_("hsc", "fibers", **_LOAD) + "SELECT pointing_idx, spectrograph_id, CAST(sum(n) AS BIGINT) AS n, count(*) FILTER (n = 0) AS n_idle FROM fl JOIN fibers USING (fiber_id) GROUP BY 1, 2")
def _(c):
    return rp.group_load(rp.fiber_load(edges(c), c("fibers"), [0, 1]), c("fibers"), "spectrograph_id")


@check("g11_multiplets", _HEAD + "SELECT pointing_idx, target_idx, count(DISTINCT fiber_id) AS n_fibers FROM edges GROUP BY 1, 2 HAVING count(DISTINCT fiber_id) > 1")
def _(c):
    return rp.multiplets(edges(c))


@check("g12_assigned_profile", with_("hsc", "fibers", **_ASG, rad=f"""SELECT {HAV('ra', 'dec', '2.2725e2', '6.725e1')} AS rr FROM hsc
    WHERE targetid IN (SELECT target_idx FROM a)""") + f"SELECT {_bin('rr', '0e0', '5e-1', 10)} AS bin, count(*) AS n FROM rad WHERE rr <= 5e-1 GROUP BY 1")
def _(c):
    from ..operators.density import radial_profile
    t = rp.target_radii(assignments(c), targets(c), haversine_deg(C("ra"), C("dec"), 227.25, 67.25))
    return radial_profile(t, C("radius"), 0.5, 10).where("n > 0").select("bin", "n")


@check("g13_median_separation", with_("hsc", "gaia", pairs=_pairs("gaia", "hsc", "source_id", "targetid", "0.1"), near=_NEAREST, one=_ONE)
       + f"SELECT {R('median(sep)')} AS median FROM one")
def _(c):
    from ..operators.zonejoin import match_one_to_one
    return rp.median(match_one_to_one(c("gaia"), c("hsc"), 0.1, "source_id", "targetid"), "sep_arcsec").select(r("median").alias("median"))


@check("g14_null_counts", with_("gaia") + """SELECT 'pmra' AS "column", count(*) - count(pmra) AS n_null FROM gaia UNION ALL SELECT 'parallax', count(*) - count(parallax) FROM gaia""")
def _(c):
    return rp.null_counts(c("gaia"), ["pmra", "parallax"])


# --- joins and exports ----------------------------------------------------------

@check("j09_join_new_columns", _AHEAD + f"SELECT a.visit_idx, a.fiber_id, a.target_idx, a.prefix, {R('h.g')} AS g FROM a LEFT JOIN hsc h ON h.targetid = a.target_idx")
def _(c):
    m = c("hsc").select(C("targetid").alias("target_idx"), "g", F.lit("x").alias("prefix"))
    return ex.join_assignments(assignments(c), m).select("visit_idx", "fiber_id", "target_idx", "prefix", r("g").alias("g"))


@check("j11_assigned_only", _AHEAD + "SELECT targetid FROM hsc WHERE targetid IN (SELECT target_idx FROM a)")
def _(c):
    return ex.assigned_only(c("hsc").withColumn("target_idx", C("targetid")), assignments(c)).select("targetid")


@check("j12_assigned_count", _AHEAD + "SELECT targetid, coalesce(n, 0) AS assigned FROM hsc LEFT JOIN (SELECT target_idx, count(*) AS n FROM a GROUP BY 1) q ON q.target_idx = targetid")
def _(c):
    return ex.with_assigned_count(c("hsc").withColumn("target_idx", C("targetid")), assignments(c)).select("targetid", "assigned")


@check("j14_join_catalogs", _AHEAD + f"SELECT a.visit_idx, a.target_idx AS targetid, {R('h.g')} AS g, l.priority FROM a LEFT JOIN hsc h ON h.targetid = a.target_idx LEFT JOIN list_a l ON l.targetid = a.target_idx".replace("list_a l", "(SELECT targetid, targetid%10 + 0e0 AS priority FROM hsc WHERE targetid%3 <> 0) l"))
def _(c):
    a = assignments(c).select("visit_idx", C("target_idx").alias("targetid"))
    return ex.join_catalogs(a, [c("hsc").select("targetid", "g"), c("list_a").select("targetid", "g", "priority")]).select(
        "visit_idx", "targetid", r("g").alias("g"), "priority")


@check("u05_accumulate_visits", _SHEAD + "SELECT target_idx, CAST(done_visits + num_visits AS INTEGER) AS done_visits FROM sm")
def _(c):
    return mg.accumulate_visits(targets(c), assignments(c), visits(c)).select("target_idx", "done_visits")


_SYS = "CASE WHEN filter LIKE '%ps1' THEN 0 WHEN filter LIKE '%gaia' THEN 1 WHEN filter LIKE '%hsc' THEN 2 ELSE 100 END"


@check("w09_flux_by_band", with_("photometry_long", k=f"""SELECT target_idx, pos, filter, psf_flux, CASE filter WHEN 'g_ps1' THEN 'g' WHEN 'g_hsc' THEN 'g' WHEN 'bp_gaia' THEN 'g' END AS band, {_SYS} AS rk
    FROM photometry_long WHERE psf_flux IS NOT NULL""", b="SELECT * FROM k WHERE band = 'g' QUALIFY row_number() OVER (PARTITION BY target_idx ORDER BY rk, pos) = 1")
       + f"""SELECT t.target_idx, coalesce(CASE b.filter WHEN 'g_hsc' THEN 'g2_hsc' ELSE b.filter END, '') AS filter_g, {R('b.psf_flux')} AS psf_flux_g, '' AS filter_r
       FROM (SELECT DISTINCT target_idx FROM photometry_long) t LEFT JOIN b USING (target_idx)""")
def _(c):
    p = c("photometry_long").withColumn("list_rank", F.lit(0)).withColumn("psf_err", C("psf_flux") / 10).withColumnRenamed("psf_flux", "psf")
    per_target = mg.merge_flux_lists(p)
    bands = ex.fluxes_by_band(C("fluxes"), {"g_hsc": "g2_hsc"})
    return per_target.select("target_idx", bands["filter_g"].alias("filter_g"), r(bands["psf_flux_g"]).alias("psf_flux_g"), bands["filter_r"].alias("filter_r"))


@check("b03_fiber_table", _AHEAD.rstrip() + """, fl AS (SELECT fiber_id, CASE WHEN fiber_id%10 <> 0 THEN fiber_id END AS pid, cx, cy, spectrograph_id FROM fibers)
    SELECT f.fiber_id, v.visit_idx, v.visit_idx AS pointing_idx, f.spectrograph_id, CAST(f.fiber_id + 1 AS INTEGER) AS fiber_hole_id,
      CASE WHEN f.fiber_id%3 = 0 THEN CAST(f.fiber_id//3 AS INTEGER) ELSE -1 END AS science_fiber_id, -1 AS field_id,
      CASE WHEN a.target_idx IS NOT NULL THEN (round(a.dist, 6) + 0e0) END AS center_dist, CAST(v.visit_idx + 5 AS INTEGER) AS stage, coalesce(a.target_idx, -1) AS target_idx, coalesce(f.pid, -1) AS positioner_id,
      CASE WHEN f.pid IS NULL THEN 5 WHEN a.prefix = 'sci' THEN 1 WHEN a.prefix = 'sky' THEN 2 WHEN a.prefix = 'cal' THEN 3 ELSE 4 END AS target_type,
      CASE WHEN f.pid IS NULL THEN 1 ELSE 7 END AS fiber_status, CASE WHEN a.target_idx IS NULL AND f.pid IS NOT NULL THEN f.cx END AS park
    FROM fl f CROSS JOIN (VALUES (0),(1)) v(visit_idx) LEFT JOIN a ON a.fiber_id = f.fiber_id AND a.visit_idx = v.visit_idx AND f.pid IS NOT NULL""")
def _(c):
    from ..operators.visits import fiber_table
    f = c("fibers").select("fiber_id", F.when(C("fiber_id") % 10 != 0, C("fiber_id")).alias("positioner_id"), "spectrograph_id",
                           (C("fiber_id") + 1).alias("fiber_hole_id"), F.when(C("fiber_id") % 3 == 0, (C("fiber_id") / 3).cast("int")).alias("science_fiber_id"),
                           C("cx").alias("park_x"), C("cy").alias("park_y"), F.lit(7).alias("fiber_status"))
    a = assignments(c).where("fiber_id % 10 <> 0").withColumns({"x": C("dist"), "y": C("dist"), "dot_dist": C("dist")})
    t = fiber_table(f, a, [dict(visit_idx=0, pointing_idx=0, stage=5), dict(visit_idx=1, pointing_idx=1, stage=6)])
    return t.select("fiber_id", "visit_idx", "pointing_idx", "spectrograph_id", "fiber_hole_id", "science_fiber_id", "field_id",
                    r("center_dist").alias("center_dist"), "stage", "target_idx", "positioner_id", "target_type", "fiber_status",
                    F.when(C("target_idx") == -1, C("fp_x")).alias("park"))


def _assigned_rows(c):
    h = c("hsc").select(C("targetid").alias("target_idx"), "targetid", "ra", "dec", "g")
    return grown_join(assignments(c), h, "target_idx").withColumns({
        "tract": F.when(C("target_idx") % 2 == 0, 1), "patch": F.when(C("target_idx") % 3 == 0, F.lit("1,1")), "catid": F.lit(9),
        "fiber_status": F.lit(None).cast("int"), "pmra": F.lit(None).cast("double"), "pmdec": F.lit(0.5), "parallax": F.lit(None).cast("double"),
        "epoch": F.lit(2016.0), "exp_time": F.lit(1800.0), "priority": C("target_idx") % 10, "obcode": C("target_idx").cast("string"),
        "proposalid": F.lit("p"), "x": C("dist"), "y": C("dist"),
        "fluxes": F.when(C("target_idx") % 5 != 0, F.array(F.struct(F.lit("g_hsc").alias("filter"), C("g").alias("psf"), F.lit(1.0).alias("psf_err"))))})


_AROWS = "SELECT a.*, h.ra, h.dec, h.g FROM a JOIN hsc h ON h.targetid = a.target_idx"


@check("b05_design_rows", _AHEAD + """SELECT visit_idx, fiber_id, CASE WHEN prefix = 'sci' THEN 25769803776 | target_idx ELSE target_idx END AS obj_id,
    CASE WHEN target_idx%2 = 0 THEN 1 ELSE -1 END AS tract, CASE WHEN target_idx%3 = 0 THEN '1,1' ELSE '0,0' END AS patch, -1 AS fiber_status,
    CASE WHEN target_idx%5 = 0 THEN 0 ELSE 1 END AS n_flux FROM a""")
def _(c):
    return ex.design_rows(_assigned_rows(c), 0x600000000).select("visit_idx", "fiber_id", "obj_id", "tract", "patch", "fiber_status", F.size("fluxes").alias("n_flux"))


@check("s21_design_ids", _AHEAD.rstrip() + f""", h AS (SELECT visit_idx, CAST('0x' || substr(md5(fiber_id || '/' || CAST(round(ra*3.6e6) AS BIGINT) || '/' || CAST(round("dec"*3.6e6) AS BIGINT)), 1, 13) AS UBIGINT) AS v
    FROM ({_AROWS})), t AS (SELECT visit_idx, CAST(sum(v) AS VARCHAR) || '/' || count(*) AS k, count(*) AS n_fibers FROM h GROUP BY 1),
    d AS (SELECT *, CAST(CAST('0x' || substr(md5(k), 1, 15) AS UBIGINT) AS BIGINT) AS design_id FROM t)
    SELECT visit_idx, design_id, printf('%016x', design_id) AS design_hex, n_fibers FROM d""")
def _(c):
    return ex.design_ids(_assigned_rows(c), ["visit_idx"])


def designs(c):
    return c("fibers").select(C("fiber_id").alias("pointing_idx"), C("fiber_id").alias("visit_idx"), (C("fiber_id") % 3 + 1).alias("nrepeats"),
                                                    F.lit(3).alias("stage"), F.lit(1).alias("priority"), C("cx").alias("ra"), C("cy").alias("dec"), F.lit(0.0).alias("posang"),
                                                    F.lit(1800.0).alias("exp_time"), F.lit("2026-03-01 08:00:00").cast("timestamp").alias("obs_time"))


@check("io12_export_rows", _AHEAD.rstrip() + f""", d AS (SELECT v, CAST(unnest(range(v%3+1)) AS INTEGER) AS r FROM (VALUES (0),(1)) t(v))
    SELECT prefix AS target_type, 'RUN_A_umi_S3P0' || v || 'V0' || v || 'R0' || r AS point_code, CASE WHEN prefix = 'sci' THEN 25769803776 | target_idx ELSE target_idx END AS obj_id,
    0e0 AS pmra, 1e-5 AS parallax, 'J2016.00' AS epoch, CASE WHEN prefix = 'sci' THEN 77 ELSE 9 END AS input_catalog_id,
    CASE WHEN prefix = 'sci' THEN CAST(target_idx%10 AS INTEGER) ELSE -1 END AS priority, CASE WHEN prefix = 'cal' THEN 1e0 ELSE -1e0 END AS prob_f_star,
    CASE WHEN target_idx%5 = 0 THEN '' ELSE 'g_hsc' END AS filter_g, CASE WHEN target_idx%5 <> 0 THEN {R('g')} END AS psf_flux_g
    FROM ({_AROWS}) q JOIN d ON d.v = q.visit_idx""")
def _(c):
    out = ex.export_rows(designs(c), _assigned_rows(c), 0x600000000, ("RUN_A", "umi"), catalog_id=77)
    return out.select("target_type", "point_code", "obj_id", "pmra", "parallax", "epoch", "input_catalog_id", "priority", "prob_f_star", "filter_g",
                      r("psf_flux_g").alias("psf_flux_g"))


@check("io13_pointing_list", with_("fibers") + "SELECT printf('RUN_A_umi_S3P%02dV%02d', fiber_id, fiber_id) AS point_code, cx AS point_ra, '2026-03-01T08:00:00' AS obstime, '2026-02-28T22:00:00' AS obstime_local FROM fibers")
def _(c):
    return ex.pointing_list(ex.with_codes(designs(c), "RUN_A", "umi", False)).select("point_code", "point_ra", "obstime", "obstime_local")


@check("j10_join_targets", _AHEAD.rstrip() + f""", slots AS (SELECT visit_idx, fiber_id, target_idx FROM a UNION ALL SELECT 9, fiber_id, -1 FROM fibers)
    SELECT visit_idx, fiber_id, target_idx, {R('h.g')} AS g FROM slots LEFT JOIN hsc h ON h.targetid = target_idx""")
def _(c):
    slots = assignments(c).select("visit_idx", "fiber_id", "target_idx").unionByName(
        c("fibers").select(F.lit(9).alias("visit_idx"), "fiber_id", F.lit(-1).cast("long").alias("target_idx")))
    t = c("hsc").select(C("targetid").alias("target_idx"), "g")
    return ex.join_assignments(slots, t).withColumn("g", r("g"))


@check("j25_group_labels", _AHEAD + "SELECT visit_idx, spectrograph_id, prefix, count(*) AS n FROM a JOIN fibers USING (fiber_id) GROUP BY 1, 2, 3")
def _(c):
    a = ex.join_assignments(assignments(c), c("fibers").select("fiber_id", "spectrograph_id"), "fiber_id")
    return rp.count_per_key(a, ["visit_idx", "spectrograph_id", "prefix"])
