"""Test catalogs derived from the supplied tables, in SQL that Spark and DuckDB read alike.

Integer arithmetic comes first and one division last, so both engines get the
same doubles. Literals carry an exponent because ``1000.0`` is DECIMAL in Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("lineitem", "orders", "customer", "part", "supplier")


def _pos(i: str, ra: str = "ra", dec: str = "dec") -> str:
    return (f"2.26e2 + 2.5e0*((({i})*7919) % 15485863)/1.5485863e7 AS {ra}, "
            f"6.67e1 + 1.1e0*((({i})*104729) % 15485863)/1.5485863e7 AS {dec}")


_STARS = ("SELECT l_orderkey*10+l_linenumber AS id, min(l_partkey) AS mp, min(l_suppkey) AS ms "
          "FROM {lineitem} GROUP BY l_orderkey*10+l_linenumber")
_G = "(1.6e1+((id*31+mp*17)%8000)/1e3)"

SQL: dict[str, str] = {
    "hsc": f"""SELECT id AS targetid, {_pos('id')}, {_G} AS g,
        {_G}-(((id*13+ms*7)%3000)/1e3-5e-1) AS i,
        {_G}-(((id*11)%1000)/1e3-5e-1) AS nb,
        ((id*3+mp)%100)/4e2 AS clg, ((id*5+ms)%100)/4e2 AS cli FROM ({_STARS}) s""",
    "gaia": f"""SELECT source_id, ra, dec + (source_id%4)*4e-2/3.6e3 AS dec,
        CASE WHEN source_id%5=0 THEN NULL ELSE ((ck*7)%400)/1e2-2e0 END AS pmra,
        CASE WHEN source_id%5=0 THEN NULL ELSE ((ck*11)%400)/1e2-2e0 END AS pmdec,
        CASE WHEN source_id%5=0 THEN NULL ELSE ((ck%20)+1)/1e2 END AS err_pm,
        ((source_id*7)%500)/1e2-5e-1 AS parallax, ((source_id%9)+1)/1e1 AS err_parallax,
        1.2e1+((source_id*29)%9000)/1e3 AS gmag
        FROM (SELECT source_id, ck, {_pos('id')} FROM (SELECT o_orderkey AS source_id, o_custkey AS ck,
            CASE WHEN o_orderkey%10=0 THEN (o_orderkey+1)*10+1+(o_orderkey+1)%7
                 ELSE o_orderkey*10+1+o_orderkey%7 END AS id FROM {{orders}}) o) p""",
    "cal": f"""SELECT c_custkey AS targetid, {_pos('id')} FROM (SELECT c_custkey,
        CASE WHEN c_custkey%3=0 THEN c_custkey*10+1+c_custkey%7 ELSE 20000000+c_custkey END AS id FROM {{customer}}) c""",
    "sky": f"SELECT 30000000+p_partkey AS targetid, {_pos('30000000+p_partkey')} FROM {{part}}",
    "fibers": """SELECT CAST(p_partkey AS INT) AS fiber_id, 8e0*((p_partkey*17)%50)-1.96e2 + 5.04e2*((p_partkey-p_partkey%2050)/2.05e3) AS cx,
        8e0*((p_partkey*29)%41)-1.6e2 AS cy, CAST(p_partkey%4+1 AS INT) AS spectrograph_id,
        CASE WHEN p_partkey%40=7 THEN 4 ELSE 0 END AS status,
        2.375e0 AS l1, 2.375e0 AS l2, CASE WHEN p_partkey%3=0 THEN -3.6e0 ELSE -3.141592653589793e0 END AS phi_in, CASE WHEN p_partkey%5=0 THEN 4e-1 ELSE -1e-3 END AS phi_out,
        (p_partkey%63)/1e1 AS theta0, (p_partkey%63)/1e1+3e-1 AS theta1, 3e-1 AS r_min, 4.75e0 AS r_max
        FROM {part}""",
    "list_a": f"""SELECT targetid, ra, dec, g, CAST(targetid%10 AS DOUBLE) AS priority,
        CAST(1800*(1+targetid%6) AS DOUBLE) AS exp_time FROM (SELECT id AS targetid, {_pos('id')}, {_G} AS g
        FROM ({_STARS}) s) h WHERE targetid%3<>0""",
    "list_b": f"""SELECT targetid, ra, dec+5e-2/3.6e3 AS dec, g, CAST((targetid*7)%10 AS DOUBLE) AS priority,
        CAST(1800*(1+(targetid*5)%6) AS DOUBLE) AS exp_time FROM (SELECT id AS targetid, {_pos('id')}, {_G} AS g
        FROM ({_STARS}) s) h WHERE targetid%3<>1""",
    "photometry_long": """SELECT p_partkey AS target_idx, CAST(pos AS INT) AS pos,
        CASE (p_partkey+pos)%5 WHEN 0 THEN 'g_ps1' WHEN 1 THEN 'g_hsc' WHEN 2 THEN 'i_old_hsc'
             WHEN 3 THEN 'bp_gaia' ELSE 'nb515_hsc' END AS filter,
        CASE WHEN (p_partkey*3+pos)%7=0 THEN NULL ELSE p_retailprice*(1e0+pos/1e1) END AS psf_flux
        FROM {part} CROSS JOIN (VALUES (0),(1),(2)) v(pos)""",
}

# Fibers sit on a grid of 50 x 41 places; when it is full the next plane begins 504 mm (63 places) beside it. Targets are dealt
# to the planes by their ids, so every plane has targets in view and the edges grow with both tables.
PLANE_FIBERS, PLANE_MM = 2050, 504.0
PLANES_SQL = f"(SELECT max(p_partkey)//{PLANE_FIBERS} + 1 FROM part)"

# Stars with four simulated populations; the array constructor differs by engine.
_SIM_GI = [f"1e-1+((l_orderkey*{a}+l_linenumber*{b})%1900)/1e3" for a, b in ((37, 11), (41, 13), (43, 17), (47, 19))]
_SIM_G = [f"1.7e1+((l_orderkey*{a}+l_linenumber*{b})%6500)/1e3" for a, b in ((53, 23), (59, 29), (61, 31), (67, 37))]


def _sim(array: str) -> str:
    close = ")" if array.endswith("(") else "]"
    return (f"SELECT l_orderkey*10+l_linenumber AS star_id, CAST((min(l_partkey)*7+min(l_suppkey))%4 AS INT) AS pop, "
            f"{array}{', '.join(_SIM_GI)}{close} AS gi, {array}{', '.join(_SIM_G)}{close} AS gmag "
            "FROM {lineitem} GROUP BY l_orderkey, l_linenumber")


# Pointings are survey configuration, not catalog rows.
POINTINGS = [
    dict(pointing_idx=0, ra=227.25, dec=67.25, posang=0.0, stage=0, priority=1, nvisits=2, nrepeats=1, exp_time=1800.0),
    dict(pointing_idx=1, ra=226.80, dec=67.40, posang=30.0, stage=1, priority=2, nvisits=1, nrepeats=2, exp_time=1800.0),
]
PLATE_SCALE = 360.0  # mm per degree


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = _sim("array(") if name == "sim" else SQL[name]
    used = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)


def planes(spark: SparkSession, sf_dir: str) -> int:
    """Number of focal planes that the fibers fill."""
    return int(table(spark, sf_dir, "part").selectExpr(f"coalesce(max(p_partkey), 0) div {PLANE_FIBERS} + 1").first()[0])


MATERIAL = ("views", "edges", "near", "vis", "sh")     # tables that are read more than once


def oracle(name: str) -> str:
    """The same catalog as DuckDB text over the supplied tables."""
    text = _sim("[") if name == "sim" else SQL[name]
    return text.format(**{t: t for t in TABLES})


def with_(*names: str, **more: str) -> str:
    """A WITH clause that defines the named catalogs (and further CTEs) for DuckDB."""
    parts = [f"{n} AS ({oracle(n)})" for n in names] + [f"{n} AS {'MATERIALIZED ' if n in MATERIAL else ''}({q})" for n, q in more.items()]
    return "WITH " + ",\n".join(parts) + "\n"
