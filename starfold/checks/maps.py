"""Checks of histogram maps, membership and density profiles."""

from __future__ import annotations


from pyspark.sql import functions as F

from ..functions.geometry import Whitening
from ..operators import density as den, pmap as pm, select as sel
from ..sources.fixtures import with_
from .registry import HAV, R, check, r
from .selections import STARS_SQL, stars

C = F.col
SPEC = pm.MapSpec(((0.1, 2.0), (17.0, 23.5)), (40, 40))
WEIGHTS = [0.1, 0.2, 0.3, 0.4]
GROUPS = [[0, 1], [2, 3]]


def _bin(v: str, lo: str, hi: str, n: int, close: bool = True) -> str:
    edge = f"WHEN {v} = {hi} THEN {n - 1} " if close else ""
    return f"CASE {edge}WHEN {v} >= {lo} AND {v} < {hi} THEN CAST(floor(({v}-{lo})/({hi}-{lo})*{n}) AS INTEGER) END"


_LONG = "SELECT star_id, pop AS g, unnest([0,1,2,3]) AS pop, unnest(gi) AS x, unnest(gmag) AS y FROM sim"
_HIST = f"""SELECT pop, ix, iy, CAST(count(*) AS DOUBLE) AS w FROM (SELECT pop, {_bin('x', '1e-1', '2e0', 40)} AS ix,
    {_bin('y', '1.7e1', '2.35e1', 40)} AS iy FROM sl) WHERE ix IS NOT NULL AND iy IS NOT NULL GROUP BY ALL"""
_MERGED = "SELECT pop//2 AS pop, ix, iy, sum(w*(pop+1)/1e1) AS w FROM hist GROUP BY ALL"
_MAXED = """SELECT pop, ix+i AS ix, iy+j AS iy, max(w) AS w FROM merged, (VALUES (-1),(0),(1)) a(i), (VALUES (-1),(0),(1)) b(j)
    WHERE ix+i BETWEEN 0 AND 39 AND iy+j BETWEEN 0 AND 39 GROUP BY ALL"""
_ROWS = """SELECT ix, iy, coalesce(sum(w) FILTER (pop=0), 0) AS h0, coalesce(sum(w) FILTER (pop=1), 0) AS h1 FROM maxed GROUP BY ALL"""
_NORM = "SELECT sum(h0) AS n0, sum(h1) AS n1 FROM maprows WHERE h0 > 0 AND h1 > 0"
_CTES = dict(sl=_LONG, hist=_HIST, merged=_MERGED, maxed=_MAXED, maprows=_ROWS, norm=_NORM)


def hist(c):
    return pm.map_from_simulation(c("sim"), "gi", "gmag", SPEC)


def maxed(c):
    cells, weights = pm.merge_populations(hist(c), GROUPS, WEIGHTS)
    return pm.maximum_filter(cells, SPEC), weights


@check("h01_histogram_2d", with_("sim", sl=_LONG, hist=_HIST) + "SELECT pop, ix, iy, w FROM hist")
def _(c):
    return hist(c)


@check("m01_map_weighted", with_("sim", sl=_LONG) + f"""SELECT pop, ix, iy, {R('sum(wt)')} AS w FROM (SELECT pop, {_bin('x', '1e-1', '2e0', 40)} AS ix,
    {_bin('y', '1.7e1', '2.35e1', 40)} AS iy, exp(-(star_id%7)/1e0) AS wt FROM sl WHERE star_id%3 <> 0) WHERE ix IS NOT NULL AND iy IS NOT NULL GROUP BY ALL""")
def _(c):
    sim = c("sim").withColumn("lp", -(C("star_id") % 7).cast("double"))
    return pm.map_from_simulation(sim, "gi", "gmag", SPEC, lp_stars="lp", mask=C("star_id") % 3 != 0).withColumn("w", r("w"))


@check("m02_merge_populations", with_("sim", sl=_LONG, hist=_HIST, merged=_MERGED) + f"SELECT pop, ix, iy, {R('w')} AS w FROM merged")
def _(c):
    return pm.merge_populations(hist(c), GROUPS, WEIGHTS)[0].withColumn("w", r("w"))


@check("m03_maximum_filter", with_("sim", sl=_LONG, hist=_HIST, merged=_MERGED, maxed=_MAXED) + f"SELECT pop, ix, iy, {R('w')} AS w FROM maxed")
def _(c):
    return maxed(c)[0].withColumn("w", r("w"))


@check("m04_nonzero_cells", with_("sim", sl=_LONG, hist=_HIST) + """SELECT ix, iy FROM hist WHERE pop IN (0, 1, 2) AND w > 0
    GROUP BY ix, iy HAVING count(DISTINCT pop) = 3""")
def _(c):
    return pm.nonzero_cells(hist(c), [0, 1, 2])


@check("m05_membership_map", with_("sim", **_CTES) + f"""SELECT ix, iy, {R('p1')} AS p, CASE WHEN p1 > 0 THEN {R('ln(p1)')} END AS lp
    FROM (SELECT ix, iy, 7e-1*h1/n1 / (3e-1*h0/n0 + 7e-1*h1/n1) AS p1 FROM maprows, norm)""")
def _(c):
    cells, weights = maxed(c)
    lp = F.get("log_p", F.lit(1))
    return pm.membership_map(cells, weights).select("ix", "iy", r(F.get("p", F.lit(1))).alias("p"),
                                                    F.when(lp > float("-inf"), r(lp)).alias("lp"))


def _lookup(extra: str = "") -> str:
    return f"""SELECT s.*, CASE WHEN t.ix IS NOT NULL THEN 7e-1*h1/n1 / (3e-1*h0/n0 + 7e-1*h1/n1) END AS p1, h0/n0 AS d0, h1/n1 AS d1
    FROM (SELECT *, {_bin('gi0', '1e-1', '2e0', 40, False)}{extra} AS sx, {_bin('g0', '1.7e1', '2.35e1', 40, False)}{extra} AS sy FROM stars) s
    LEFT JOIN maprows t ON t.ix = s.sx AND t.iy = s.sy LEFT JOIN norm ON true"""


@check("m06_lookup_membership", with_("sim", "hsc", stars=STARS_SQL, **_CTES, seen=_lookup()) + f"SELECT targetid, {R('p1')} AS p FROM seen")
def _(c):
    cells, weights = maxed(c)
    out = pm.lookup_membership(stars(c), "gi0", "g0", cells, SPEC, weights)
    return out.select("targetid", r(F.get("p", F.lit(1))).alias("p"))


@check("m06_lookup_star_weights", with_("sim", "hsc", stars=STARS_SQL, **_CTES, seen=_lookup())
       + f"SELECT targetid, {R('(1+targetid%3)*d1/(d0+(1+targetid%3)*d1)')} AS p FROM seen")
def _(c):
    cells, weights = maxed(c)
    df = stars(c).withColumn("w", F.array(F.lit(1.0), (1 + C("targetid") % 3).cast("double")))
    out = pm.lookup_membership(df, "gi0", "g0", cells, SPEC, weights, star_weights="w")
    return out.select("targetid", r(F.get("p", F.lit(1))).alias("p"))


@check("m06_lookup_legacy_shift", with_("sim", "hsc", stars=STARS_SQL, **_CTES, seen=_lookup("+1"))
       + f"SELECT targetid, {R('p1')} AS p FROM seen")
def _(c):
    cells, weights = maxed(c)
    out = pm.lookup_membership(stars(c), "gi0", "g0", cells, SPEC, weights, legacy_shift=True)
    return out.select("targetid", r(F.get("p", F.lit(1))).alias("p"))


@check("m07_assign_membership", with_("sim", "hsc", stars=STARS_SQL, **_CTES, seen=_lookup())
       + f"SELECT targetid, CASE WHEN clg < 0.5 THEN {R('p1')} END AS p_member FROM seen")
def _(c):
    cells, weights = maxed(c)
    out = pm.assign_membership(stars(c).drop("p_member"), "gi0", "g0", cells, SPEC, weights, C("clg") < 0.5)
    return out.select("targetid", r("p_member").alias("p_member"))


@check("m07_membership_from_column", with_("hsc") + "SELECT targetid, CASE WHEN targetid%3<>0 THEN (targetid%11)/1e1 END AS p_member FROM hsc")
def _(c):
    ml = F.when(C("targetid") % 3 == 0, F.lit(float("nan"))).otherwise((C("targetid") % 11) / 10.0)
    return pm.membership_from_column(c("hsc").withColumn("ml", ml), "ml").select("targetid", "p_member")


@check("f07_probability_cut", with_("sim", "hsc", stars=STARS_SQL, **_CTES, seen=_lookup()) + "SELECT targetid FROM seen WHERE p1 > exp(-5e-1)")
def _(c):
    cells, weights = maxed(c)
    out = pm.lookup_membership(stars(c), "gi0", "g0", cells, SPEC, weights)
    return out.where(sel.probability_cut(pm.log_probability(C("p")), 1, -0.5)).select("targetid")


@check("m08b_rescale_weights", with_("sim", w="SELECT pop, count(*)/sum(count(*)) OVER () AS weight FROM sim GROUP BY pop")
       + f"SELECT pop, {R('weight*(pop+1)/sum(weight*(pop+1)) OVER ()')} AS weight FROM w")
def _(c):
    return pm.rescale_weights(pm.population_weights(c("sim"), "pop"), [1, 2, 3, 4]).withColumn("weight", r("weight"))


@check("g16_population_weights", with_("sim") + f"SELECT pop, {R('count(*)/sum(count(*)) OVER ()')} AS weight FROM sim GROUP BY pop")
def _(c):
    return pm.population_weights(c("sim"), "pop").withColumn("weight", r("weight"))


@check("m09_compare_counts", with_("sim", "hsc") + """SELECT 'observed' AS source, count(*) FILTER (g-i BETWEEN 0.2 AND 0.9) AS n_inside, count(*) AS n_all FROM hsc
    UNION ALL SELECT 'simulated', count(*) FILTER (gi[pop+1] BETWEEN 0.2 AND 0.9), count(*) FROM sim""")
def _(c):
    return pm.compare_counts(c("hsc"), c("sim"), (C("g") - C("i")).between(0.2, 0.9), F.get("gi", C("pop")).between(0.2, 0.9))


@check("g15_extents", with_("hsc") + f"""SELECT 'g' AS axis, {R('floor(min(g)/5e-1)*5e-1')} AS lo, {R('ceil(max(g)/5e-1)*5e-1')} AS hi FROM hsc
    UNION ALL SELECT 'i', {R('floor(min(i)/2.5e-1)*2.5e-1')}, {R('ceil(max(i)/2.5e-1)*2.5e-1')} FROM hsc""")
def _(c):
    return pm.measured_extents(c("hsc"), ["g", "i"], [0.5, 0.25]).select("axis", r("lo").alias("lo"), r("hi").alias("hi"))


@check("g07_histograms", with_("hsc") + f"""SELECT 'g' AS axis, {_bin('g', '1.6e1', '2.4e1', 50)} AS bin, count(*) AS n FROM hsc GROUP BY ALL
    UNION ALL SELECT 'clg', {_bin('clg', '0e0', '2e-1', 20)}, count(*) FROM hsc WHERE clg <= 2e-1 GROUP BY ALL""")
def _(c):
    h = c("hsc")
    return (pm.histogram_1d(h, C("g"), 16.0, 24.0, 50).withColumn("axis", F.lit("g"))
            .unionByName(pm.histogram_1d(h, C("clg"), 0.0, 0.2, 20).withColumn("axis", F.lit("clg"))))


# --- density ----------------------------------------------------------------

_RADIUS = HAV("ra", "dec", "2.2725e2", "6.725e1")
_PROFILE = f"""SELECT bin, (bin+5e-1)*2.5e-2 AS r, coalesce(n, 0) AS n,
    CASE WHEN n > 0 THEN ln(n/(pi()*power(2.5e-2,2)*(2*bin+1))) END AS log_s, CASE WHEN n > 0 THEN 1/sqrt(n) END AS log_s_sigma
    FROM (SELECT CAST(unnest(range(20)) AS INTEGER) AS bin) g LEFT JOIN (SELECT {_bin('rr', '0e0', '5e-1', 20)} AS bin, count(*) AS n
      FROM (SELECT {_RADIUS} AS rr FROM hsc) WHERE rr <= 5e-1 GROUP BY 1) h USING (bin)"""


def profile(c):
    from ..functions.astro import haversine_deg
    return den.radial_profile(c("hsc"), haversine_deg(C("ra"), C("dec"), 227.25, 67.25), 0.5, 20)


@check("r03_radial_profile", with_("hsc", prof=_PROFILE) + f"SELECT bin, {R('r')} AS r, n, {R('log_s')} AS log_s, {R('log_s_sigma')} AS log_s_sigma FROM prof")
def _(c):
    return profile(c).select("bin", r("r").alias("r"), "n", r("log_s").alias("log_s"), r("log_s_sigma").alias("log_s_sigma"))


@check("w13_half_light_radius", with_("hsc", prof=_PROFILE, cum="""SELECT *, sum(greatest(n - 1e2*pi()*power(2.5e-2,2)*(2*bin+1), 0)) OVER (ORDER BY bin) AS c FROM prof""",
                                      lagged="SELECT *, lag(c) OVER (ORDER BY bin) AS c0, lag(r) OVER (ORDER BY bin) AS r0, max(c) OVER ()/2 AS half FROM cum")
       + f"SELECT {R('min(r0+(r-r0)*(half-c0)/(c-c0))')} AS r_half FROM lagged WHERE c >= half AND c0 <= half AND c > c0")
def _(c):
    return den.half_light_radius(profile(c), 100.0).select(r("r_half").alias("r_half"))


GRID = [dict(s_b=b, s_0=s, r_c=rc, r_t=0.6) for b in (1e3, 3e3, 1e4, 3e4) for s in (1e3, 1e4) for rc in (0.05, 0.2)]
_GRID_SQL = ", ".join(f"({k}, {g['s_b']!r}e0, {g['s_0']!r}e0, {g['r_c']!r}e0)" for k, g in enumerate(GRID))


@check("r04p_choose_profile", with_("hsc", prof=_PROFILE, chi=f"""SELECT k, sum(power((log_s - ln(s_b + CASE WHEN r < 6e-1 THEN
    s_0*power(1/sqrt(1+power(r/r_c,2)) - 1/sqrt(1+power(6e-1/r_c,2)), 2) ELSE 0 END))/log_s_sigma, 2)) AS chi2
    FROM prof CROSS JOIN (VALUES {_GRID_SQL}) v(k, s_b, s_0, r_c) WHERE log_s IS NOT NULL GROUP BY k""")
       + f"SELECT CAST(k AS INTEGER) AS grid_idx, {R('chi2', 4)} AS chi2 FROM chi QUALIFY row_number() OVER (ORDER BY chi2, k) = 1")
def _(c):
    return den.choose_profile(profile(c), GRID, "king").select("grid_idx", r("chi2", 4).alias("chi2"))


@check("r05p_ellipses", f"""SELECT s_suppkey, CAST(step AS INTEGER) AS step, {R('(4*u - (-5e-1)*v)/8.125e0 + 2.272e2')} AS x, {R('(2*v - 2.5e-1*u)/8.125e0 + 6.72e1')} AS y
    FROM (SELECT s_suppkey, step, rad*cos(step*2*pi()/19) AS u, rad*sin(step*2*pi()/19) AS v
      FROM (SELECT s_suppkey, (1+s_suppkey%5)/1e1 AS rad, unnest(range(20)) AS step FROM supplier))""")
def _(c):
    from ..sources.fixtures import table
    radii = table(c.spark, c.sf_dir, "supplier").select("s_suppkey", ((1 + C("s_suppkey") % 5) / 10.0).alias("rad"))
    out = den.ellipse_points(radii, "rad", Whitening((227.2, 67.2), ((2.0, -0.5), (0.25, 4.0))), 20)
    return out.select("s_suppkey", "step", r("x").alias("x"), r("y").alias("y"))


def _whitening_sql(iterations: int) -> str:
    """One CTE per iteration: moments of the points kept, then the closed eigen form of a 2x2 matrix."""
    cuts = [2.0] * (iterations // 2) + [2.8] * (iterations - iterations // 2)
    ctes, keep = {}, ""
    for k in range(iterations):
        ctes[f"m{k}"] = (f"SELECT avg(ra) AS mx, avg(\"dec\") AS my, var_samp(ra) AS cxx, var_samp(\"dec\") AS cyy, covar_samp(ra, \"dec\") AS cxy "
                         f"FROM hsc{keep}")
        ctes[f"e{k}"] = (f"SELECT *, (cxx+cyy)/2 + sqrt(power((cxx-cyy)/2, 2) + cxy*cxy) AS big, (cxx+cyy)/2 - sqrt(power((cxx-cyy)/2, 2) + cxy*cxy) AS small, "
                         f"5e-1*atan2(2*cxy, cxx-cyy) AS ang FROM m{k}")
        ctes[f"w{k}"] = (f"SELECT targetid, ra, \"dec\", (cos(ang)*(ra-mx) + sin(ang)*(\"dec\"-my))/sqrt(big) AS u, "
                         f"(cos(ang)*(\"dec\"-my) - sin(ang)*(ra-mx))/sqrt(small) AS v FROM hsc, e{k}")
        keep = f" WHERE targetid IN (SELECT targetid FROM w{k} WHERE sqrt(u*u+v*v) < {cuts[k]}e0)"
    return with_("hsc", **ctes) + f"SELECT targetid, {R('u')} AS u, {R('v')} AS v FROM w{iterations - 1}"


@check("rw_whitening", _whitening_sql(6))
def _(c):
    df = c("hsc")
    fit = den.fit_whitening(df, "ra", "dec", iterations=6)
    u, v = fit.apply(C("ra"), C("dec"))
    return df.select("targetid", r(u).alias("u"), r(v).alias("v"))
