"""Checks of selections, derived columns and priority rules."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ..operators import columns as col, rules as ru, select as sel, zonejoin as zj
from ..sources import tables as tb
from ..sources.fixtures import POINTINGS, table, with_
from .registry import HAV, R, UNIFORM, check, r

C = F.col

# Stars with dereddened colors, membership and proper motions; SQL that both engines read alike.
STAR_COLUMNS = {
    "targetid": "targetid", "ra": "ra", "dec": "dec", "g0": "g", "i0": "i", "gi0": "g-i", "gn0": "g-nb",
    "r0": "g-8e-1*(g-i)", "gr0": "8e-1*(g-i)",
    "clg": "clg*3e0", "cli": "cli*3e0",
    "p_member": "CASE WHEN targetid%4=0 THEN NULL WHEN targetid%9=0 THEN 0e0 ELSE ((targetid*7)%1000)/1e3 END",
    "pmra": "CASE WHEN targetid%7=0 THEN NULL ELSE ((targetid*3)%4000)/1e3-2e0 END",
    "pmdec": "CASE WHEN targetid%7=0 THEN NULL ELSE ((targetid*11)%4000)/1e3-2e0 END",
    "err_pmra": "((targetid*5)%900)/1e3", "err_pmdec": "((targetid*13)%900)/1e3",
    "boosted": "targetid%101=0", "blue_side": "targetid%3=0", "near": "dec < 6.74e1", "selected": "targetid%2=0",
}
STARS_SQL = "SELECT " + ", ".join(f"{e} AS {n}" for n, e in STAR_COLUMNS.items()) + " FROM hsc"


def stars(c):
    return c("hsc").selectExpr(*[f"{e} AS {n}" for n, e in STAR_COLUMNS.items()])


def _where(cond: str) -> str:
    return with_("hsc", stars=STARS_SQL) + f"SELECT targetid FROM stars WHERE {cond}"


def _query(name: str, cond: str, make):
    check(name, _where(cond))(lambda c: stars(c).where(make(c)).select("targetid"))


_query("f01_magnitude_range", "g0 > 1.85e1 AND g0 < 2.25e1", lambda c: sel.in_range(C("g0"), 18.5, 22.5))
_query("f02_color_range", "gi0 >= 0 AND gi0 <= 1.5", lambda c: sel.in_range(C("gi0"), 0.0, 1.5, closed=True))
_query("f03_linear", "-2.5e-1*gi0 + gn0 > -1.5e-1 AND -2.5e-1*gi0 + gn0 < 2e-1",
       lambda c: sel.linear([C("gi0"), C("gn0")], [-0.25, 1.0], -0.15, 0.2))
_query("f10_polygon", """((1.61e1 > g0) <> (2.15e1 > g0) AND gi0 < (2e0-1e0)*(g0-1.61e1)/(2.15e1-1.61e1)+1e0)
    <> ((2.15e1 > g0) <> (1.61e1 > g0) AND gi0 < (1e-1-2e0)*(g0-2.15e1)/(1.61e1-2.15e1)+2e0)""",
       lambda c: sel.polygon(C("gi0"), C("g0"), [(1.0, 16.1), (2.0, 21.5), (0.1, 16.1)]))
_query("f11_conjunction", "g0 > 18 AND gi0 < 1 AND clg < 0.3", lambda c: sel.all_of([C("g0") > 18, C("gi0") < 1, C("clg") < 0.3]))
_query("f12_cone_selection", f"{HAV('ra', 'dec', '2.27e2', '6.72e1')} <= 3e-1",
       lambda c: sel.around(C("ra"), C("dec"), 227.0, 67.2, 0.3))
_query("f13_point_source_any", "clg < 0.1 OR cli < 0.1", lambda c: sel.point_source(["clg", "cli"], 0.1, "any"))
_query("f13_point_source_all", "clg < 0.1 AND cli < 0.1", lambda c: sel.point_source(["clg", "cli"], 0.1, "all"))
_query("f14_user_mask", "g0 < 20 AND targetid % 3 = 1", lambda c: F.expr("g0 < 20 AND targetid % 3 = 1"))
_query("f16_clean_detection", "clg > 2e-1 AND targetid%2 = 1 AND g0 <> 18 AND i0 <> -999",
       lambda c: sel.clean_detection(C("clg"), C("targetid") % 2, [C("i0"), F.when(C("g0") != 18, C("g0")).otherwise(-999.0)], 0.2))
_query("f19_keep_valid", "clg < 0.5 AND cli < 0.5 AND g0 >= 16 AND g0 <= 23",
       lambda c: sel.point_source(["clg", "cli"], 0.5) & sel.in_range(C("g0"), 16, 23, closed=True))


def _nb_sql(field: str) -> str:
    parts = []
    for region in sel.FIELD_CUTS[field].nb:
        t = []
        for k in ("gi", "gn"):
            lo, hi = region.get(k, (None, None))
            t += [f"{k}0 > {lo}"] if lo is not None else []
            t += [f"{k}0 < {hi}"] if hi is not None else []
        if "line" in region:
            t.append(f"({region['line'][0]}e0*gi0 + gn0) > {region['line'][1]}e0")
        parts.append("(" + " AND ".join(t) + ")")
    return "(" + " OR ".join(parts) + ")"


for _field in ("ursaminor", "draco", "fornax", "sculptor", "sextans", "ngc6822", "m31"):
    _query(f"f04_narrow_band_{_field}", _nb_sql(_field),
           lambda c, f=_field: sel.narrow_band(sel.FIELD_CUTS[f], C("gi0"), C("gn0")))

# the selections in full, written out for each field: color, narrow band, magnitudes
SELECTIONS = {
    "ursaminor": """gi0 > 0.12 AND gi0 < 2.0 AND ((gi0 > 0.12 AND gi0 < 0.5) OR (gi0 < 1.65 AND gn0 > 0.1) OR (-0.25e0*gi0 + gn0 > -0.15e0))
        ~ g0 > 16 AND g0 < 23.5""",
    "draco": """gi0 > 0.0 AND gi0 < 2.0 AND ((gi0 > 0.0 AND gi0 < 0.5) OR (gi0 < 1.65 AND gn0 > 0.05) OR (-0.25e0*gi0 + gn0 > -0.16e0))
        ~ g0 > 16 AND g0 < 23.5""",
    "bootes": "gr0 > 0.1 AND gr0 < 1.5 ~ g0 > 17 AND g0 < 23",
    "sextans": """gi0 > 0.12 AND gi0 < 2.0 AND ((gi0 > 0.12 AND gi0 < 0.5) OR (gi0 < 1.8 AND gn0 > 0.2) OR (-0.25e0*gi0 + gn0 > -0.1e0))
        ~ g0 > 16 AND g0 < 23.5 AND i0 > 14.5 AND i0 < 23.5""",
    "fornax": """gi0 > 0.12 AND gi0 < 2.5 AND ((gi0 < 0.0) OR (gi0 > 0.1 AND gi0 < 1.5 AND 0.25e0*gi0 + gn0 > 0.2e0)
        OR (gi0 > 1.5 AND -0.33e0*gi0 + gn0 > -0.66e0)) ~ g0 > 16 AND g0 < 23""",
    "sculptor": """gi0 > 0.12 AND gi0 < 2.0 AND ((gi0 > 0.12 AND gi0 < 0.5) OR (gi0 < 2.0 AND gn0 > 0.1) OR (-0.25e0*gi0 + gn0 > -0.15e0))
        ~ g0 > 16 AND g0 < 23.5""",
    "ngc6822": """gi0 < 2.75 AND ((gi0 < 0.0) OR (gi0 > 0.1 AND gi0 < 1.5 AND 0.25e0*gi0 + gn0 > 0.25e0)
        OR (gi0 > 1.5 AND -0.33e0*gi0 + gn0 > -0.62e0)) ~ g0 > 18 AND g0 < 23""",
    "m31": "gi0 > 0.95 AND gi0 < 4.0 AND ((gi0 > 0.12 AND gi0 < 0.5) OR (gi0 < 4.0 AND gn0 > 0.05)) ~ g0 > 19 AND g0 < 30",
}

for _field, _text in SELECTIONS.items():
    _cut, (_red_stars, _mags) = sel.FIELD_CUTS[_field], _text.split("~")
    _query(f"f05_selection_{_field}",
           f"(coalesce({_red_stars} AND p_member > 1e-1, false) OR {'gr0' if _field == 'bootes' else 'gi0'} < 0.12) AND {_mags}"
           " AND clg < 0.1 AND cli < 0.1",
           lambda c, f=_cut: sel.field_selection(f, C("g0"), C(f.color), C("gn0"), blue=True,
                                                 probcut=C("p_member") > 0.1, i=C(f.red),
                                                 point=sel.point_source(["clg", "cli"], 0.1)))

_query("f05_selection_cluster", "gr0 > -0.1 AND gr0 < 1.0 AND p_member > 1e-1 AND g0 > 14 AND g0 < 22",
       lambda c: sel.field_selection(sel.FIELD_CUTS["cluster"], C("g0"), C("gr0"), probcut=C("p_member") > 0.1))

# the stars moved to the field and spread, so that some lie outside the cone
_MOVED = {"fra": "1.5326e2 + (ra-2.2725e2)*4e0", "fdec": "(dec-6.725e1)*6e0 - 1.6e0"}


@check("f05_selection_sextans_cone", with_("hsc", stars=STARS_SQL, moved="SELECT *, " + ", ".join(f"{e} AS {n}" for n, e in _MOVED.items()) + " FROM stars")
       + f"""SELECT targetid FROM moved WHERE {SELECTIONS['sextans'].replace('~', 'AND')}
    AND {HAV('fra', 'fdec', '1.5326208333333333e2', '-1.6147222222222222e0')} <= 2.5e0""")
def _(c):
    moved = stars(c).selectExpr("*", *[f"{e} AS {n}" for n, e in _MOVED.items()])
    return moved.where(sel.field_selection(sel.FIELD_CUTS["sextans"], C("g0"), C("gi0"), C("gn0"), i=C("i0"),
                                           pos=(C("fra"), C("fdec")))).select("targetid")


CURVE = [(0.2, 0.0), (0.5, 1.5), (1.1, 3.0), (0.8, 4.5)]
_SEG = " ".join(f"WHEN g0 <= {b[1] + 17}e0 AND g0 >= {a[1] + 17}e0 THEN {a[0]}e0 + ({b[0] - a[0]!r}e0)*(g0-{a[1] + 17}e0)/1.5e0"
                for a, b in reversed(list(zip(CURVE, CURVE[1:]))))


@check("f06_curve_side", with_("hsc", stars=STARS_SQL) + f"""SELECT targetid, coalesce(gi0 <= cx, false) AS blue_of,
    coalesce(gi0 >= CASE WHEN g0 < 1.7e1 THEN 2e-1 WHEN g0 > 2.15e1 THEN 8e-1 ELSE cx END, false) AS red_of
    FROM (SELECT *, CASE {_SEG} END AS cx FROM stars)""")
def _(c):
    df = sel.curve_side(stars(c), "gi0", "g0", CURVE, "-", "blue_of", dm=17.0)
    df = sel.curve_side(df, "gi0", "g0", CURVE, "+", "red_of", extend=True, dm=17.0)
    return df.select("targetid", "blue_of", "red_of")


@check("f15_config_limits", with_("hsc", stars=STARS_SQL) + """SELECT targetid FROM stars
    WHERE g0 >= 17 AND g0 <= 22 AND g0 - i0 >= 0.25 AND g0 - i0 <= 0.4""")
def _(c):
    return sel.config_limits(stars(c), {"g0": (17.0, 22.0), "g0-i0": (0.25, 0.4)}).select("targetid")


@check("f15c_parallax_snr", with_("gaia") + "SELECT source_id FROM gaia WHERE parallax > 0 AND parallax/err_parallax > 10")
def _(c):
    return c("gaia").where(sel.parallax_snr(C("parallax"), C("err_parallax"))).select("source_id")


@check("f15d_annulus", with_("hsc") + f"""SELECT targetid, CAST(ceil({HAV('ra', 'dec', '2.2725e2', '6.725e1')}/1e-1) - 1 AS INTEGER) AS ring
    FROM hsc WHERE {HAV('ra', 'dec', '2.2725e2', '6.725e1')} > 1e-9""")
def _(c):
    df = c("hsc").withColumn("rr", zj.haversine_deg(C("ra"), C("dec"), 227.25, 67.25))
    return df.where("rr > 1e-9").select("targetid", sel.ring_index(C("rr"), 0.1).alias("ring"))


@check("f17_field_of_view", with_("hsc") + " UNION ALL ".join(
    f"SELECT targetid, {p['pointing_idx']} AS pointing_idx FROM hsc WHERE {HAV('ra', 'dec', str(p['ra']) + 'e0', str(p['dec']) + 'e0')} < 7.5e-1"
    for p in POINTINGS))
def _(c):
    return sel.in_view(c("hsc"), POINTINGS).select("targetid", "pointing_idx")


@check("f18_forbidden_targets", with_("hsc", "list_a") + """SELECT targetid, 'kept' AS status FROM hsc
    WHERE targetid NOT IN (SELECT targetid FROM list_a WHERE priority < 3) UNION ALL
    SELECT targetid+1000000007, 'not in field' FROM list_a WHERE priority < 1""")
def _(c):
    listed = c("list_a").where("priority < 3").select("targetid").unionByName(
        c("list_a").where("priority < 1").select((C("targetid") + 1000000007).alias("targetid")))
    kept, missing = sel.forbidden(c("hsc"), "targetid", listed)
    return (kept.select("targetid", F.lit("kept").alias("status"))
            .unionByName(missing.select("targetid", F.lit("not in field").alias("status"))))


@check("f18_forbidden_pairs", with_("hsc", p="SELECT targetid AS t1, targetid + 1 AS t2 FROM hsc WHERE targetid%3 = 0")
       + """SELECT t1, t2, 'kept' AS status FROM p WHERE t2 IN (SELECT targetid FROM hsc)
            UNION ALL SELECT t1, t2, 'not in field' FROM p WHERE t2 NOT IN (SELECT targetid FROM hsc)""")
def _(c):
    pairs = c("hsc").where("targetid % 3 = 0").select(C("targetid").alias("t1"), (C("targetid") + 1).alias("t2"))
    kept, skipped = sel.forbidden_pairs(c("hsc"), "targetid", pairs)
    return (kept.select("t1", "t2", F.lit("kept").alias("status"))
            .unionByName(skipped.select("t1", "t2", F.lit("not in field").alias("status"))))


@check("f20_subset", with_("list_a") + "SELECT targetid FROM list_a WHERE priority IN (1, 2, 5) AND exp_time = 3600")
def _(c):
    return sel.subset(c("list_a"), priority=[1.0, 2.0, 5.0], exp_time=3600.0).select("targetid")


@check("f08_probability_sampling", with_("hsc", stars=STARS_SQL) + f"""SELECT targetid, {R('p_member')} AS p_member FROM stars
    WHERE CASE WHEN p_member > 0 THEN ln(p_member) END > ln({UNIFORM("targetid || '/42'")})""")
def _(c):
    lp = F.array(F.log(1 - C("p_member")), F.log("p_member"))
    return stars(c).where(sel.probability_sampling(lp, 1, C("targetid"), 42)).select("targetid", r("p_member").alias("p_member"))


@check("f09_random_member_mask", with_("hsc", stars=STARS_SQL) + f"""SELECT targetid, [coalesce(1 - p_member > {UNIFORM("targetid || '/42/0'")}, false),
    coalesce(p_member > {UNIFORM("targetid || '/42/1'")}, false)] AS drawn FROM stars""")
def _(c):
    p = F.array(1 - C("p_member"), C("p_member"))
    return stars(c).select("targetid", sel.random_mask(p, C("targetid"), 42).alias("drawn"))


# --- derived columns -------------------------------------------------------

@check("p01_p05_extra_columns", with_("list_a") + """SELECT targetid, 'run_7' AS run, 2 * priority AS double_priority,
    'RUN_umi_' || lpad(CAST(targetid AS VARCHAR), 9, '0') || printf('_%.1f', exp_time) AS obcode2,
    2.016e3 AS epoch, -1 AS catid, '' AS proposalid, 0 AS tract, '0,0' AS patch, CAST(targetid AS VARCHAR) AS obcode FROM list_a""")
def _(c):
    extras = [col.ExtraColumn("obcode2", pattern="RUN_{field}_{{targetid:09d}}_{{exp_time:.1f}}"),
              col.ExtraColumn("double_priority", "double", expression=lambda p: 2 * p, args=("priority",)),
              col.ExtraColumn("run", constant="run_7")]
    df = col.with_mandatory_columns(col.add_extra_columns(c("list_a"), extras, {"field": "umi"}))
    return df.select("targetid", "run", "double_priority", "obcode2", "epoch", "catid", "proposalid", "tract", "patch", "obcode")


@check("p06_generate_targetid", with_("gaia") + "SELECT source_id, row_number() OVER (ORDER BY source_id) AS targetid FROM gaia")
def _(c):
    return col.with_targetid(c("gaia").select("source_id"), None, "source_id").select("source_id", "targetid")


@check("p08_class_costs", with_("list_a", costs="SELECT DISTINCT 'sci_P' || CAST(CAST(priority AS INT) AS VARCHAR) AS class, CAST(1000 - 100*priority AS INT) AS class_cost FROM list_a WHERE priority < 8")
       + """SELECT l.targetid, coalesce(CASE WHEN l.targetid%10 = 0 THEN 5 END, c.class_cost) AS cost
            FROM list_a l JOIN costs c ON c.class = 'sci_P' || CAST(CAST(l.priority AS INT) AS VARCHAR)
            UNION ALL SELECT targetid, NULL FROM list_a WHERE priority >= 8""")
def _(c):
    df = c("list_a").withColumns({"class": col.class_label(F.lit("sci"), C("priority")),
                                  "non_observation_cost": F.when(C("targetid") % 10 == 0, 5)})
    known, unknown = col.with_class_costs(df, {f"sci_P{k}": 1000 - 100 * k for k in range(8)})
    return (known.select("targetid", C("non_observation_cost").alias("cost"))
            .unionByName(unknown.select("targetid", F.lit(None).cast("int").alias("cost"))))


@check("p09_fill_fluxes", with_("list_a") + f"""SELECT targetid, {R('CASE WHEN targetid%5=0 THEN power(1e1,(3.14e1-g)/2.5e0) ELSE targetid/1e3 END')} AS psf,
    {R('CASE WHEN targetid%5=0 THEN power(1e1,(3.14e1-g)/2.5e0) ELSE targetid/1e3 END')} AS fiber,
    {R('CASE WHEN targetid%2=0 THEN targetid/2e3 WHEN targetid%5=0 THEN power(1e1,(3.14e1-g)/2.5e0) ELSE targetid/1e3 END')} AS total FROM list_a""")
def _(c):
    from ..functions.photometry import fill_flux_kinds
    df = c("list_a").withColumns({"psf_flux_g": F.when(C("targetid") % 5 != 0, C("targetid") / 1e3),
                                  "fiber_flux_g": F.lit(None).cast("double"),
                                  "total_flux_g": F.when(C("targetid") % 2 == 0, C("targetid") / 2e3)})
    filled = fill_flux_kinds(("psf", "fiber", "total"), "g", C("g"))
    return df.select("targetid", *[r(v).alias(k.split("_")[0]) for k, v in filled.items()])


@check("p10_pick_population", with_("sim") + f"SELECT star_id, {R('gi[pop+1]')} AS gi FROM sim")
def _(c):
    return c("sim").select("star_id", r(col.pick_population("gi", "pop")).alias("gi"))


@check("p12_export_fill", with_("gaia") + f"""SELECT source_id, coalesce(pmra, 0) AS pmra, {R('coalesce(CASE WHEN parallax > 0 THEN parallax END, 1e-5)')} AS parallax,
    CASE WHEN source_id%3=0 THEN -1 ELSE source_id%7 END AS tract, CASE WHEN source_id%2=0 THEN '-1,-1' ELSE '3,4' END AS patch,
    CASE WHEN source_id%3=0 THEN CAST(source_id%9 AS INT) ELSE -1 END AS priority,
    CASE WHEN source_id%3=1 THEN 1e0 ELSE -1e0 END AS prob_f_star FROM gaia""")
def _(c):
    kinds = F.array(F.lit("sci"), F.lit("cal"), F.lit("sky"))
    df = c("gaia").withColumns({
        "prefix": F.get(kinds, (C("source_id") % 3).cast("int")), "priority": (C("source_id") % 9).cast("double"),
        "parallax": F.when(C("parallax") > 0, C("parallax")),
        "tract": F.when(C("source_id") % 3 != 0, C("source_id") % 7),
        "patch": F.when(C("source_id") % 2 != 0, F.lit("3,4"))})
    return col.export_fill(df).select("source_id", "pmra", r("parallax").alias("parallax"), "tract", "patch", "priority", "prob_f_star")


@check("p13_filter_remap", with_("photometry_long") + """SELECT target_idx, pos,
    CASE filter WHEN 'g_hsc' THEN 'g2_hsc' WHEN 'bp_gaia' THEN 'b_gaia' ELSE filter END AS filter FROM photometry_long""")
def _(c):
    return c("photometry_long").select("target_idx", "pos",
                                       col.remap_filters(C("filter"), {"g_hsc": "g2_hsc", "bp_gaia": "b_gaia"}).alias("filter"))


@check("p14_codes", """SELECT o_orderkey, 'RUN_A_umi_' || CASE WHEN o_orderkey%3=0 THEN '' ELSE 'S' || CAST(o_orderkey%3 AS VARCHAR) END
    || 'P' || lpad(CAST(o_orderkey%20 AS VARCHAR), 2, '0') || 'V' || lpad(CAST(o_orderkey%30 AS VARCHAR), 2, '0')
    || CASE WHEN o_orderkey%2=0 THEN '' ELSE 'R' || lpad(CAST(o_orderkey%5 AS VARCHAR), 2, '0') END AS code,
    'Ursa Minor' || CASE WHEN o_orderkey%3=0 THEN '' ELSE ' S' || CAST(o_orderkey%3 AS VARCHAR) END
    || 'P' || lpad(CAST(o_orderkey%20 AS VARCHAR), 2, '0') || '/20 V' || lpad(CAST(o_orderkey%30 AS VARCHAR), 2, '0') || '/30' AS name
    FROM orders""")
def _(c):
    k = C("o_orderkey")
    stage = F.when(k % 3 != 0, k % 3)
    repeat = F.when(k % 2 == 0, -1).otherwise(k % 5)
    return table(c.spark, c.sf_dir, "orders").select(
        "o_orderkey", col.pointing_code("RUN_A", "umi", stage, k % 20, k % 30, repeat).alias("code"),
        col.design_name("Ursa Minor", stage, k % 20, 20, k % 30, 30).alias("name"))


@check("p15_flux_lists", with_("hsc") + f"""SELECT targetid, 'g_hsc' AS filter, {R('g')} AS psf FROM hsc UNION ALL
    SELECT targetid, 'i_hsc', {R('i')} FROM hsc WHERE targetid%2=0 UNION ALL
    SELECT targetid, 'i2_hsc', {R('i')} FROM hsc WHERE targetid%2=1""")
def _(c):
    df = c("hsc").withColumn("ifilter", F.when(C("targetid") % 2 == 0, "i_hsc").otherwise("i2_hsc"))
    fluxes = col.flux_array([col.FluxColumns("g_hsc", psf="g"), col.FluxColumns("i_hsc", psf="i", filter_column="ifilter"),
                             col.FluxColumns("i2_hsc", psf="i", filter_column="ifilter")])
    return df.select("targetid", F.explode(fluxes).alias("f")).select("targetid", "f.filter", r(C("f.psf")).alias("psf"))


@check("io01_configured_scan", """SELECT l_orderkey AS targetid, CAST(l_linenumber AS VARCHAR) AS line,
    CASE l_returnflag WHEN 'R' THEN 'returned' ELSE l_returnflag END AS flag, CASE WHEN l_discount = 0 THEN NULL ELSE l_discount END AS discount
    FROM lineitem WHERE l_quantity > 30""")
def _(c):
    cfg = tb.ListConfig(f"{c.sf_dir}/lineitem.parquet", columns=["l_orderkey", "l_linenumber", "l_returnflag", "l_discount", "l_quantity"],
                        column_map={"l_orderkey": "targetid", "l_linenumber": "line", "l_returnflag": "flag", "l_discount": "discount"},
                        data_types={"line": "string"}, value_map={"flag": {"R": "returned"}}, mask="l_quantity > 30", sentinels=(0.0,))
    return tb.read_list(c.spark, cfg).drop("l_quantity")


@check("io02_text_catalog", "SELECT p_partkey AS id, p_retailprice AS ra, CAST(p_size AS DOUBLE) AS dec FROM part")
def _(c):
    lines = table(c.spark, c.sf_dir, "part").select(F.concat_ws("  ", F.lit(""), "p_partkey", "p_retailprice", "p_size").alias("value"))
    return tb.parse_text(lines, tb.TextLayout((("id", "bigint"), ("ra", "double"), ("dec", "double"))))


@check("io10_stage_union", """SELECT o_orderkey AS k, o_custkey AS a, NULL AS b FROM orders WHERE o_orderstatus = 'F' UNION ALL
    SELECT o_orderkey, NULL, o_totalprice FROM orders WHERE o_orderstatus <> 'F'""")
def _(c):
    o = table(c.spark, c.sf_dir, "orders")
    return tb.union_all([o.where("o_orderstatus = 'F'").select(C("o_orderkey").alias("k"), C("o_custkey").alias("a")),
                         o.where("o_orderstatus <> 'F'").select(C("o_orderkey").alias("k"), C("o_totalprice").alias("b"))])


@check("io05_column_maps", "SELECT c_custkey AS objid, c_acctbal AS obs_hsc_i2, CAST(c_nationkey AS DOUBLE) AS ext_hsc_i2 FROM customer")
def _(c):
    raw = tb.ListConfig(f"{c.sf_dir}/customer.parquet", columns=["c_custkey", "c_acctbal", "c_nationkey"],
                        column_map={"c_custkey": "hsc_targetid", "c_acctbal": "ipsf", "c_nationkey": "a_i"}, data_types={"a_i": "double"})
    df = tb.read_list(c.spark, raw)
    return df.withColumnsRenamed({"hsc_targetid": tb.MULTI_SURVEY_MAP["hsc_targetid"]} | tb.hsc_column_map({"i": "i2"}))


@check("io06_standard_list", with_("gaia") + "SELECT source_id AS targetid, ra AS \"RA\", err_pm AS err_pmra, err_parallax FROM gaia")
def _(c):
    df = c("gaia").select(C("source_id").alias("fluxstd_id"), C("ra"), C("err_pm").alias("pmra_error"), C("err_parallax").alias("parallax_error"))
    return tb.apply_config(df, tb.ListConfig("", column_map={k: v for k, v in tb.FLUX_STANDARD_MAP.items() if k in df.columns}))


@check("io07_simulation_columns", with_("sim") + f"SELECT star_id, {R('gi[1]')} AS first_color, {R('gmag[4]')} AS last_mag FROM sim")
def _(c):
    names = tb.simulation_columns({"gi": "color", "gmag": "mag"})
    df = c("sim").withColumnsRenamed({a: b for a, b in names.items() if a in ("gi", "gmag")})
    return df.select("star_id", r(F.get("color", F.lit(0))).alias("first_color"), r(F.get("mag", F.lit(3))).alias("last_mag"))


@check("io09_cone_scan", f"""SELECT p_partkey FROM part WHERE {HAV('p_retailprice/1e2', 'CAST(p_size AS DOUBLE)', '1.2e1', '2.5e1')} <= 4e0""")
def _(c):
    df = table(c.spark, c.sf_dir, "part").select("p_partkey", (C("p_retailprice") / 100.0).alias("ra"), C("p_size").cast("double").alias("dec"))
    return zj.cone(df, 12.0, 25.0, 4.0).select("p_partkey")


@check("io15_masked_rows", with_("hsc", stars=STARS_SQL) + "SELECT targetid FROM stars WHERE p_member > 0.5")
def _(c):
    return stars(c).where(F.expr("p_member > 0.5")).select("targetid")


# --- priority rules --------------------------------------------------------

def _duck(text: str) -> str:
    return ru.render(text, "duck")


def rule_oracle(rule_set: ru.RuleSet, stars_sql: str) -> str:
    """Each rule as one CTE over the one before it."""
    ctes = {"stars": stars_sql, "q0": "SELECT *, -1e0 AS priority, 0 AS code FROM stars"}
    for k, rule in enumerate(rule_set.rules):
        new = f"CASE WHEN coalesce({rule.when}, false) THEN CAST({_duck(rule.value)} AS DOUBLE) ELSE priority END AS priority"
        if rule.code is not None:
            new += f", CASE WHEN coalesce({rule.when}, false) THEN {rule.code} ELSE code END AS code"
        ctes[f"q{k + 1}"] = f"SELECT * REPLACE ({new}) FROM q{k}"
    keep = f"coalesce({rule_set.keep}, false)"
    return with_("hsc", **ctes) + (f"SELECT targetid, CASE WHEN {keep} THEN {R('priority')} ELSE -1e0 END AS priority, "
                                   f"CASE WHEN {keep} THEN {_duck(rule_set.exposure)} END AS exp_time FROM q{len(rule_set.rules)}")


for _field, _rules in ru.RULES.items():
    _base = re.sub(r"_(v1|old)$", "", _field)
    _has_nb = bool(sel.FIELD_CUTS[_base].nb)
    _with_nb = f"SELECT *, {_nb_sql(_base) if _has_nb else 'true'} AS nb FROM ({STARS_SQL})"

    def _make(c, f=_field, b=_base, has_nb=_has_nb):
        nb = sel.narrow_band(sel.FIELD_CUTS[b], C("gi0"), C("gn0")) if has_nb else F.lit(True)
        out = ru.assign_priorities(stars(c).withColumn("nb", nb), ru.RULES[f])
        return out.select("targetid", r("priority").alias("priority"), "exp_time")
    check(f"r02_priorities_{_field}", rule_oracle(_rules, _with_nb))(_make)


_WEDGE = ru.RuleSet(ru.WEDGE_RULES, "priority >= 0", "0e0")


@check("r02d_wedge_classes", rule_oracle(_WEDGE, STARS_SQL).rsplit("SELECT targetid", 1)[0]
       + f"SELECT targetid, priority FROM q{len(ru.WEDGE_RULES)}")
def _(c):
    return ru.apply_rules(stars(c), ru.WEDGE_RULES).select("targetid", "priority")


@check("r03p_proper_motion_outliers", _where("p_member > 0 AND pmra IS NOT NULL AND pmdec IS NOT NULL AND "
       "power(pmra+0.119,2)/(power(err_pmra,2)+power(0.005,2)) + power(pmdec-0.072,2)/(power(err_pmdec,2)+power(0.005,2)) > 9"))
def _(c):
    return stars(c).where(ru.pm_outlier(*ru.SYSTEMIC_PM["ursaminor"], guard="p_member > 0")).select("targetid")


@check("r04_exposure_times", with_("hsc", stars=STARS_SQL) + """SELECT targetid,
    1.8e3*greatest(least(round_even(5*sqrt(power(10, (i0-19)/2.5e0))+1, 0), 6), 1) AS curved,
    1.8e3*greatest(least(round_even(5*((i0-16)/7e0)+1, 0), 6), 1) AS straight FROM stars""")
def _(c):
    return stars(c).select("targetid", F.expr(ru.render(ru.exposure_sqrt("i0"))).alias("curved"),
                           F.expr(ru.render(ru.exposure_linear("i0"))).alias("straight"))


@check("r05_required_visits", with_("list_a") + "SELECT targetid, CAST(ceil(coalesce(CASE WHEN targetid%5<>0 THEN exp_time END, 0)/7e2) AS INTEGER) AS req_visits FROM list_a")
def _(c):
    exp = F.when(C("targetid") % 5 != 0, C("exp_time"))
    return c("list_a").select("targetid", ru.required_visits(exp, 700.0).alias("req_visits"))


# --- the flagship: match, copy proper motions, select, prioritise, count ----

_PAIRS = f"""SELECT * FROM (SELECT l.source_id AS lid, q.targetid AS rid, 3.6e3*{HAV('l.ra', 'l.dec', 'q.ra', 'q.dec')} AS sep
    FROM gaia l JOIN hsc q ON q.dec >= l.dec-1.01e-1/3.6e3 AND q.dec <= l.dec+1.01e-1/3.6e3) x WHERE sep <= 1e-1"""


def flagship_stars(c):
    """One-to-one match to the astrometric list, proper motions copied, selection and priorities."""
    m = zj.match_one_to_one(c("gaia"), c("hsc"), 0.1, "source_id", "targetid").select(
        C("right_id").alias("left_id"), C("left_id").alias("right_id"))
    df = zj.copy_columns(c("hsc"), c("gaia"), m, "targetid", "source_id", ["pmra", "pmdec", "err_pm"])
    df = df.withColumns({
        "g0": C("g"), "i0": C("i"), "gi0": C("g") - C("i"), "gn0": C("g") - C("nb"),
        "err_pmra": C("err_pm"), "err_pmdec": C("err_pm"),
        "p_member": F.expr(STAR_COLUMNS["p_member"]), "boosted": F.lit(False), "blue_side": F.lit(False)})
    cuts = sel.FIELD_CUTS["ursaminor"]
    df = df.withColumn("nb_ok", sel.narrow_band(cuts, C("gi0"), C("gn0"))).where(
        sel.field_selection(cuts, C("g0"), C("gi0"), C("gn0"), point=sel.point_source(["clg", "cli"], 0.1)))
    return ru.assign_priorities(df.drop("nb").withColumnRenamed("nb_ok", "nb"), ru.RULES["ursaminor"])


_FLAG_STARS = f"""SELECT h.targetid, h.ra, h.dec, h.g AS g0, h.i AS i0, h.g-h.i AS gi0, h.g-h.nb AS gn0, h.clg, h.cli,
    g.pmra, g.pmdec, g.err_pm AS err_pmra, g.err_pm AS err_pmdec, false AS boosted, false AS blue_side,
    {STAR_COLUMNS['p_member'].replace('targetid', 'h.targetid')} AS p_member
    FROM hsc h LEFT JOIN one o ON o.rid = h.targetid LEFT JOIN gaia g ON g.source_id = o.lid"""
_FLAG_SELECTED = f"""SELECT *, {_nb_sql('ursaminor')} AS nb FROM ({_FLAG_STARS}) WHERE gi0 > 0.12 AND gi0 < 2.0
    AND {_nb_sql('ursaminor')} AND g0 > 16 AND g0 < 23.5 AND clg < 0.1 AND cli < 0.1"""
_MATCH = dict(pairs=_PAIRS, near="SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY lid ORDER BY sep, rid) = 1",
              one="SELECT * FROM near QUALIFY row_number() OVER (PARTITION BY rid ORDER BY sep, lid) = 1")


def _flag_oracle() -> str:
    body = rule_oracle(ru.RULES["ursaminor"], _FLAG_SELECTED)
    head = with_("hsc", "gaia", **_MATCH).rstrip() + ",\n"
    ctes, final = body.split("stars AS (", 1)[1].rsplit("SELECT targetid", 1)
    return (head + "stars AS (" + ctes.rstrip() + ", scored AS (SELECT targetid" + final + ") "
            "SELECT priority, CAST(count(*) AS BIGINT) AS n, CAST(sum(exp_time) AS DOUBLE) AS exp_time FROM scored GROUP BY priority")


@check("flagship_sample_counts", _flag_oracle())
def _(c):
    return (flagship_stars(c).groupBy(r("priority").alias("priority"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum("exp_time").alias("exp_time")))
