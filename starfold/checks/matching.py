"""Checks of the joins on the sphere."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import zonejoin as zj
from ..sources.fixtures import with_
from .registry import HAV, R, check, r

_MAS = "CAST(round(sep*1e3) AS BIGINT)"


def _sep():
    return F.rint(F.col("sep_arcsec") * 1e3).cast("bigint").alias("sep_mas")


def _pairs(left: str, right: str, lid: str, rid: str, radius: str, op: str = "<=", extra: str = "") -> str:
    """Oracle CTE body: all pairs within ``radius`` arcsec, by a band join on declination."""
    return (f"SELECT * FROM (SELECT l.{lid} AS lid, q.{rid} AS rid, 3.6e3*{HAV('l.ra', 'l.dec', 'q.ra', 'q.dec')} AS sep "
            f"FROM {left} l JOIN {right} q ON q.dec >= l.dec-({radius}+1e-3)/3.6e3 AND q.dec <= l.dec+({radius}+1e-3)/3.6e3 {extra}"
            f") x WHERE sep {op} {radius}")


_NEAREST = "SELECT lid, rid, sep FROM pairs QUALIFY row_number() OVER (PARTITION BY lid ORDER BY sep, rid) = 1"
_ONE = "SELECT lid, rid, sep FROM near QUALIFY row_number() OVER (PARTITION BY rid ORDER BY sep, lid) = 1"


@check("j01_cone", with_("hsc") + f"""
    SELECT targetid, {R(HAV('ra', 'dec', '2.2725e2', '6.725e1'))} AS sep_deg FROM hsc
    WHERE {HAV('ra', 'dec', '2.2725e2', '6.725e1')} <= 0.2""")
def _(c):
    out = zj.cone(c("hsc"), 227.25, 67.25, 0.2)
    return out.select("targetid", r(zj.haversine_deg(F.col("ra"), F.col("dec"), 227.25, 67.25)).alias("sep_deg"))


@check("j02_match_one_to_one", with_("hsc", "gaia", pairs=_pairs("gaia", "hsc", "source_id", "targetid", "0.1"),
                                     near=_NEAREST, one=_ONE)
       + f"SELECT lid AS source_id, rid AS targetid, {_MAS} AS sep_mas FROM one")
def _(c):
    m = zj.match_one_to_one(c("gaia"), c("hsc"), 0.1, "source_id", "targetid")
    return m.select(F.col("left_id").alias("source_id"), F.col("right_id").alias("targetid"), _sep())


@check("j03_nearest_many_to_one", with_("hsc", "gaia", pairs=_pairs("gaia", "hsc", "source_id", "targetid", "0.1", "<"),
                                        near=_NEAREST)
       + f"SELECT lid AS source_id, rid AS targetid, {_MAS} AS sep_mas FROM near")
def _(c):
    m = zj.nearest_within(c("gaia"), c("hsc"), 0.1, "source_id", "targetid", closed=False)
    return m.select(F.col("left_id").alias("source_id"), F.col("right_id").alias("targetid"), _sep())


@check("j03_nearest_other_way", with_("hsc", "gaia", pairs=_pairs("hsc", "gaia", "targetid", "source_id", "0.1", "<"),
                                      near=_NEAREST)
       + f"SELECT lid AS targetid, rid AS source_id, {_MAS} AS sep_mas FROM near")
def _(c):
    m = zj.nearest_within(c("hsc"), c("gaia"), 0.1, "targetid", "source_id", closed=False, explode="right")
    return m.select(F.col("left_id").alias("targetid"), F.col("right_id").alias("source_id"), _sep())


@check("j03_crowded_cells", with_("hsc", "cal", pairs=_pairs("cal", "hsc", "targetid", "targetid", "30", "<="), near=_NEAREST)
       + f"SELECT lid AS cal_id, rid AS targetid, {_MAS} AS sep_mas FROM near")
def _(c):
    m = zj.nearest_within(c("cal"), c("hsc"), 30, "targetid", "targetid", crowd=2)
    return m.select(F.col("left_id").alias("cal_id"), F.col("right_id").alias("targetid"), _sep())


@check("j04_nearest_any_distance", with_("hsc", "cal", pairs=f"""
        SELECT l.targetid AS lid, h.targetid AS rid, {HAV('l.ra', 'l.dec', 'h.ra', 'h.dec')} AS sep
        FROM cal l JOIN hsc h ON h.dec >= l.dec-1.2e-1 AND h.dec <= l.dec+1.2e-1
          AND h.ra >= l.ra-3.5e-1 AND h.ra <= l.ra+3.5e-1""", near=_NEAREST)
       + f"SELECT lid AS cal_id, rid AS targetid, {R('sep', 9)} AS sep_deg FROM near")
def _(c):
    m = zj.nearest_any_distance(c("cal"), c("hsc"), "targetid", "targetid")
    return m.select(F.col("left_id").alias("cal_id"), F.col("right_id").alias("targetid"),
                    r(F.col("sep_arcsec") / 3600.0, 9).alias("sep_deg"))


@check("j05_merge_pairs_left", with_("hsc", "cal", pairs=_pairs("cal", "hsc", "targetid", "targetid", "5.0")) + f"""
    SELECT c.targetid, h.targetid AS targetid_2, {R('coalesce(c.ra, h.ra)', 9)} AS primary_ra,
           {R('coalesce(c.dec, h.dec)', 9)} AS primary_dec
    FROM cal c LEFT JOIN pairs p ON p.lid = c.targetid LEFT JOIN hsc h ON h.targetid = p.rid""")
def _(c):
    m = zj.merge_nearby(c("cal"), c("hsc"), 5.0, "targetid", "targetid", how="left")
    return m.select("targetid", "targetid_2", r("primary_ra", 9).alias("primary_ra"), r("primary_dec", 9).alias("primary_dec"))


@check("j06_append_unmatched", with_("list_a", "list_b",
                                     pairs=_pairs("list_b", "list_a", "targetid", "targetid", "0.1"), near=_NEAREST, one=_ONE)
       + """SELECT targetid, 'a' AS src FROM list_a UNION ALL
            SELECT targetid, 'b' FROM list_b WHERE targetid NOT IN (SELECT lid FROM one)""")
def _(c):
    a, b = c("list_a").withColumn("src", F.lit("a")), c("list_b").withColumn("src", F.lit("b"))
    m = zj.match_one_to_one(b, a, 0.1, "targetid", "targetid").select(
        F.col("right_id").alias("left_id"), F.col("left_id").alias("right_id"))
    return zj.append_unmatched(a, b, m, "targetid").select("targetid", "src")


@check("j07_copy_columns", with_("hsc", "gaia", pairs=_pairs("gaia", "hsc", "source_id", "targetid", "0.1"),
                                 near=_NEAREST, one=_ONE) + f"""
    SELECT h.targetid, {R('g.pmra', 6)} AS pmra, {R('g.pmdec', 6)} AS pmdec, {R('g.err_pm', 6)} AS err_pm
    FROM hsc h LEFT JOIN one o ON o.rid = h.targetid LEFT JOIN gaia g ON g.source_id = o.lid""")
def _(c):
    m = zj.match_one_to_one(c("gaia"), c("hsc"), 0.1, "source_id", "targetid").select(
        F.col("right_id").alias("left_id"), F.col("left_id").alias("right_id"))
    out = zj.copy_columns(c("hsc"), c("gaia"), m, "targetid", "source_id", ["pmra", "pmdec", "err_pm"])
    return out.select("targetid", r("pmra").alias("pmra"), r("pmdec").alias("pmdec"), r("err_pm").alias("err_pm"))


@check("j08_neighbour_table", """
    SELECT o.o_orderkey, l.l_suppkey, p.p_partkey, (round(p.p_retailprice, 6) + 0e0) AS p_retailprice
    FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey JOIN part p ON p.p_partkey = l.l_partkey""")
def _(c):
    from ..sources.fixtures import table
    o, l, p = (table(c.spark, c.sf_dir, t) for t in ("orders", "lineitem", "part"))
    joined = zj.join_by_neighbours(o, l, p, ("o_orderkey", "l_orderkey"), ("p_partkey", "l_partkey"))
    return joined.select("o_orderkey", "l_suppkey", "p_partkey", r("p_retailprice").alias("p_retailprice"))


_SRC = "CASE source_id%3 WHEN 0 THEN 'wide' WHEN 1 THEN 'deep' ELSE 'old' END"


@check("j16_precedence_dedupe", with_(
    "gaia", t0=f"SELECT source_id, ra, dec, {_SRC} AS src FROM gaia",
    d1=_pairs("t0", "t0", "source_id", "source_id", "2.0", "<", "AND l.source_id <> q.source_id"),
    t1="SELECT * FROM t0 WHERE NOT (src = 'old' AND source_id IN (SELECT lid FROM d1))",
    d2=_pairs("t1", "t1", "source_id", "source_id", "2.0", "<", "AND l.source_id <> q.source_id"),
    t2="SELECT * FROM t1 WHERE NOT (src = 'wide' AND source_id IN (SELECT lid FROM d2))")
       + "SELECT source_id, src FROM t2")
def _(c):
    df = c("gaia").withColumn("src", F.expr(_SRC))
    out = zj.drop_lower_precedence(df, 2.0, "src", [["old"], ["wide"]], ["source_id", "src"])
    return out.select("source_id", "src")


@check("w01b_closest_per_object", """SELECT l_orderkey, l_quantity, l_partkey FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity, l_partkey) = 1""")
def _(c):
    from ..sources.fixtures import table
    l = table(c.spark, c.sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_partkey")
    return zj.closest_per_object(l, "l_orderkey", "l_quantity", "l_partkey")


@check("x05_unmatched_rows", with_("hsc", "gaia", pairs=_pairs("gaia", "hsc", "source_id", "targetid", "0.1"))
       + "SELECT source_id FROM gaia WHERE source_id NOT IN (SELECT lid FROM pairs)")
def _(c):
    return zj.without_match(c("gaia"), c("hsc"), 0.1).select("source_id")


@check("x05_matched_rows", with_("hsc", "gaia", pairs=_pairs("gaia", "hsc", "source_id", "targetid", "5.0"))
       + "SELECT source_id FROM gaia WHERE source_id IN (SELECT lid FROM pairs)")
def _(c):
    return zj.with_match(c("gaia"), c("hsc"), 5.0).select("source_id")


@check("x06_distinct_values", with_("list_a") + "SELECT DISTINCT priority, exp_time FROM list_a")
def _(c):
    return c("list_a").select("priority", "exp_time").distinct()
