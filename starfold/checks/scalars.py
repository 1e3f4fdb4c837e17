"""Checks of the scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import astro, geometry as geo, photometry as ph
from ..operators import ids
from ..operators.columns import class_label, target_type_code
from ..sources.fixtures import table, with_
from .registry import HAV, R, check, r

C = F.col


@check("s01_mag_to_flux", with_("hsc") + f"""SELECT targetid, {R('power(1e1, (3.14e1-g)/2.5e0)')} AS flux,
    {R('power(1e1, (3.14e1-g)/2.5e0)*clg*ln(1e1)/2.5e0')} AS flux_err FROM hsc""")
def _(c):
    return c("hsc").select("targetid", r(ph.ab_to_njy(C("g"))).alias("flux"),
                           r(ph.ab_err_to_njy(C("g"), C("clg"))).alias("flux_err"))


@check("s02_flux_to_mag", with_("photometry_long") + f"""SELECT target_idx, pos,
    CASE WHEN f > 0 THEN {R('3.14e1-2.5e0*log10(f)')} END AS mag,
    CASE WHEN f > 0 THEN {R('2.5e0/ln(1e1)*(pos+1)/f', 9)} END AS mag_err,
    {R('2.5e0/ln(1e1)/(pos+1)')} AS mag_err_snr
    FROM (SELECT *, psf_flux - 9e2 AS f FROM photometry_long)""")
def _(c):
    df = c("photometry_long").withColumn("f", C("psf_flux") - 900.0)
    return df.select("target_idx", "pos", r(ph.njy_to_ab(C("f"))).alias("mag"),
                     r(ph.njy_err_to_ab(C("f"), C("pos") + 1), 9).alias("mag_err"),
                     r(ph.snr_to_ab_err(C("pos") + 1)).alias("mag_err_snr"))


@check("s03_color_and_dereddening", with_("hsc") + f"""SELECT targetid, {R('(g-clg)-(i-cli)')} AS gi0,
    {R('sqrt(clg*clg+cli*cli)')} AS err, {R('g+1.92e1')} AS shifted FROM hsc""")
def _(c):
    df = c("hsc").withColumnsRenamed({"g": "obs_s_g", "i": "obs_s_i"}).withColumns(
        {"ext_s_g": C("clg"), "ext_s_i": C("cli"), "err_s_g": C("clg"), "err_s_i": C("cli")})
    color = ph.Color(ph.Magnitude("s", "g"), ph.Magnitude("s", "i"))
    return df.select("targetid", r(color.value(dered=True)).alias("gi0"), r(color.error()).alias("err"),
                     r(ph.shift_by_distance(C("obs_s_g"), 19.2)).alias("shifted"))


@check("s04_distance_modulus", with_("gaia") + f"""SELECT source_id,
    CASE WHEN parallax > 0 THEN {R('1e1-5e0*log10(parallax)')} END AS dm,
    CASE WHEN parallax > 0 THEN {R('gmag-(1e1-5e0*log10(parallax))')} END AS abs_mag FROM gaia""")
def _(c):
    return c("gaia").select("source_id", r(ph.distance_modulus(C("parallax"))).alias("dm"),
                            r(ph.absolute_magnitude(C("gmag"), C("parallax"))).alias("abs_mag"))


_PA = ("atan2(sin(radians({b}-({a})))*cos(radians({d2})), cos(radians({d1}))*sin(radians({d2}))"
       "-sin(radians({d1}))*cos(radians({d2}))*cos(radians({b}-({a}))))")


@check("s06_s07_separation_and_angle", with_("hsc") + f"""SELECT targetid,
    {R('3.6e3*' + HAV('2.27e2', '6.7e1', 'ra', 'dec'), 4)} AS sep_arcsec,
    {R('CASE WHEN pa < 0 THEN pa + 3.6e2 ELSE pa END')} AS pa FROM (SELECT *,
      degrees({_PA.format(a='2.27e2', b='ra', d1='6.7e1', d2='dec')}) AS pa FROM hsc)""")
def _(c):
    return c("hsc").select("targetid",
                           r(astro.separation_arcsec(227.0, 67.0, C("ra"), C("dec")), 4).alias("sep_arcsec"),
                           r(astro.position_angle_deg(227.0, 67.0, C("ra"), C("dec"))).alias("pa"))


@check("s08_offset_pointing", with_("cal") + f"""SELECT targetid,
    {R('degrees(radians(ra)+atan2(sin(s)*sin(p)*cos(d), cos(s)-sin(d)*sd))')} AS ra2,
    {R('degrees(asin(sd))')} AS dec2 FROM (SELECT *, sin(d)*cos(s)+cos(d)*sin(s)*cos(p) AS sd FROM
      (SELECT targetid, ra, radians(dec) AS d, radians(3.5e-1) AS s, radians(5e1) AS p FROM cal))""")
def _(c):
    ra2, dec2 = astro.offset_by(C("ra"), C("dec"), 0.35, 50.0)
    return c("cal").select("targetid", r(ra2).alias("ra2"), r(dec2).alias("dec2"))


@check("s09_epoch_propagation", with_("gaia") + f"""SELECT source_id,
    {R('CASE WHEN pmra IS NULL THEN ra ELSE degrees(atan2(y, x)) + CASE WHEN atan2(y, x) < 0 THEN 360 ELSE 0 END END', 9)} AS ra2,
    {R('CASE WHEN pmra IS NULL THEN dec ELSE degrees(atan2(z, sqrt(x*x+y*y))) END', 9)} AS dec2
    FROM (SELECT *, cos(d)*cos(a)-ua*sin(a)-ud*sin(d)*cos(a) AS x, cos(d)*sin(a)+ua*cos(a)-ud*sin(d)*sin(a) AS y,
                 sin(d)+ud*cos(d) AS z FROM
      (SELECT *, radians(ra) AS a, radians(dec) AS d, radians(pmra/3.6e6)*2.45e1 AS ua,
              radians(pmdec/3.6e6)*2.45e1 AS ud FROM gaia))""")
def _(c):
    ra2, dec2 = astro.propagate_epoch(C("ra"), C("dec"), C("pmra"), C("pmdec"), F.lit(2000.0), 2024.5)
    return c("gaia").select("source_id", r(ra2, 9).alias("ra2"), r(dec2, 9).alias("dec2"))


def TAN(ra: str, dec: str, ra0: str, dec0: str, pa: str, scale: str = "3.6e2") -> tuple[str, str]:
    """Tangent-plane x and y as oracle text."""
    cosc = (f"(sin(radians({dec0}))*sin(radians({dec}))+cos(radians({dec0}))*cos(radians({dec}))*cos(radians({ra}-{ra0})))")
    xi = f"(degrees(1e0)*{scale}/{cosc}*cos(radians({dec}))*sin(radians({ra}-{ra0})))"
    eta = (f"(degrees(1e0)*{scale}/{cosc}*(cos(radians({dec0}))*sin(radians({dec}))"
           f"-sin(radians({dec0}))*cos(radians({dec}))*cos(radians({ra}-{ra0}))))")
    return (f"({xi}*cos(radians({pa}))-{eta}*sin(radians({pa})))", f"({xi}*sin(radians({pa}))+{eta}*cos(radians({pa})))")


_TX, _TY = TAN("ra", "dec", "2.2725e2", "6.725e1", "3e1")


@check("s10_tangent_plane", with_("hsc") + f"""SELECT targetid, {R(_TX)} AS x, {R(_TY)} AS y,
    {R('ra', 8)} AS ra_back, {R('dec', 8)} AS dec_back FROM hsc""")
def _(c):
    x, y = astro.tan_project(C("ra"), C("dec"), 227.25, 67.25, 30.0, 360.0)
    df = c("hsc").withColumns({"x": x, "y": y})
    ra, dec = astro.tan_unproject(C("x"), C("y"), 227.25, 67.25, 30.0, 360.0)
    return df.select("targetid", r("x").alias("x"), r("y").alias("y"), r(ra, 8).alias("ra_back"), r(dec, 8).alias("dec_back"))


@check("s11_epoch_text", with_("cal") + f"""SELECT targetid, 2e3 + (targetid%50)/2e0 AS epoch,
    printf('J%.2f', 2e3 + (targetid%50)/2e0) AS label FROM cal""")
def _(c):
    df = c("cal").withColumn("label", astro.format_epoch(F.lit(2000.0) + (C("targetid") % 50) / 2.0))
    return df.select("targetid", astro.parse_epoch(C("label")).alias("epoch"), "label")


@check("s12_class_label", with_("list_a") + """SELECT targetid,
    CASE WHEN p = floor(p) THEN 'sci_P' || CAST(CAST(p AS BIGINT) AS VARCHAR) ELSE printf('sci_P%.1f', p) END AS label
    FROM (SELECT targetid, priority + CASE WHEN targetid%4 = 0 THEN 1e-1 ELSE 0e0 END AS p FROM list_a)""")
def _(c):
    p = C("priority") + F.when(C("targetid") % 4 == 0, 0.1).otherwise(0.0)
    return c("list_a").select("targetid", class_label(F.lit("sci"), p).alias("label"))


@check("s13_object_ids", with_("hsc") + """SELECT targetid, 25769803776 | targetid AS objid,
    lower(lpad(hex(25769803776 | targetid), 16, '0')) AS objid_hex FROM hsc""")
def _(c):
    oid = ids.object_id(0x600000000, C("targetid"))
    return c("hsc").select("targetid", oid.alias("objid"), ids.hex_id(oid).alias("objid_hex"))


@check("s14_dense_id", with_("hsc") + "SELECT targetid, row_number() OVER (ORDER BY targetid) + 99 AS idx FROM hsc")
def _(c):
    return ids.dense_id(c("hsc").select("targetid"), "targetid", "idx", start=100)


_SEXA = "CASE WHEN c_custkey%2=0 THEN '-' ELSE '+' END || lpad(CAST(c_custkey%60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(c_custkey%59 AS VARCHAR), 2, '0') || ':' || CAST(c_custkey%58 AS VARCHAR) || '.25'"


@check("s15_sexagesimal", f"""SELECT c_custkey, {_SEXA} AS txt,
    {R("CASE WHEN c_custkey%2=0 THEN -1 ELSE 1 END * (c_custkey%60 + (c_custkey%59)/6e1 + (c_custkey%58 + 2.5e-1)/3.6e3)", 8)} AS deg
    FROM customer""")
def _(c):
    df = table(c.spark, c.sf_dir, "customer").withColumn("txt", F.expr(_SEXA.replace("VARCHAR", "STRING")))
    return df.select("c_custkey", "txt", r(astro.sexagesimal_to_deg(C("txt")), 8).alias("deg"))


@check("s16_local_time", """SELECT event_id, strftime(ts - INTERVAL 10 HOUR, '%Y-%m-%dT%H:%M:%S') AS hst FROM events""")
def _(c):
    ts = astro.to_local_time(C("ts").cast("timestamp"))
    return table(c.spark, c.sf_dir, "events").select("event_id", astro.iso_seconds(ts).alias("hst"))


@check("s17_altitude_airmass", f"""SELECT event_id, {R('alt', 5)} AS alt,
    {R('CASE WHEN alt > 5 THEN 1/sin(radians(alt)) END')} AS airmass, alt > 5 AS visible FROM (
    SELECT event_id, degrees(asin(greatest(-1e0, least(1e0, sin(radians(6.725e1))*sin(radians(1.98255e1))
      + cos(radians(6.725e1))*cos(radians(1.98255e1))*cos(radians(lst - 2.2725e2)))))) AS alt FROM (
    SELECT event_id, 2.8046061837e2 + 3.6098564736629e2*((epoch_us(ts) - 946728000000000)/8.64e10) - 1.55476e2 AS lst
    FROM events))""")
def _(c):
    alt, _ = astro.altitude_azimuth(227.25, 67.25, C("ts").cast("timestamp"))
    df = table(c.spark, c.sf_dir, "events").select("event_id", alt.alias("alt"))
    return df.select("event_id", r("alt", 5).alias("alt"), r(F.when(C("alt") > 5, astro.airmass(C("alt")))).alias("airmass"),
                     (C("alt") > 5).alias("visible"))


_M = astro.GALACTIC_TO_ICRS


def _row(k: int) -> str:
    a, b, d = (repr(v) + "e0" for v in _M[k])
    return f"({a}*cos(b)*cos(l)+({b})*cos(b)*sin(l)+({d})*sin(b))"


@check("s18_galactic", with_("hsc") + f"""SELECT targetid,
    {R('CASE WHEN atan2(y,x) < 0 THEN degrees(atan2(y,x)) + 360 ELSE degrees(atan2(y,x)) END')} AS ra2,
    {R('degrees(atan2(z, sqrt(x*x+y*y)))')} AS dec2 FROM (SELECT targetid, {_row(0)} AS x, {_row(1)} AS y, {_row(2)} AS z
    FROM (SELECT targetid, radians(ra) AS l, radians(dec) AS b FROM hsc))""")
def _(c):
    ra2, dec2 = astro.galactic_to_icrs(C("ra"), C("dec"))
    return c("hsc").select("targetid", r(ra2).alias("ra2"), r(dec2).alias("dec2"))


_W = geo.Whitening((227.2, 67.2), ((2.0, -0.5), (0.25, 4.0)))


@check("s19_whitened_radius", with_("hsc") + f"""SELECT targetid, {R('sqrt(u*u+v*v)')} AS radius, {R('atan2(v,u)')} AS phi,
    {R('ra', 9)} AS ra_back FROM (SELECT *, 2e0*(ra-2.272e2)-5e-1*(dec-6.72e1) AS u, 2.5e-1*(ra-2.272e2)+4e0*(dec-6.72e1) AS v FROM hsc)""")
def _(c):
    u, v = _W.apply(C("ra"), C("dec"))
    back, _ = _W.reverse(u, v)
    return c("hsc").select("targetid", r(_W.radius(C("ra"), C("dec"))).alias("radius"),
                           r(_W.angle(C("ra"), C("dec"))).alias("phi"), r(back, 9).alias("ra_back"))


@check("s20_profiles", with_("hsc") + f"""SELECT targetid, {R('k')} AS king, {R('ln(k)')} AS log_king,
    {R("k/(4.53e1*7.25e0 + 1.0848e3*1.3825e0*(1.3825e0*7.25e0 - 2*power(1.3825e0,2)*sqrt(1+power(7.25e0/1.3825e0,2))*asinh(7.25e0/1.3825e0) + (power(1.3825e0,2)+power(7.25e0,2))*atan(7.25e0/1.3825e0))/(power(1.3825e0,2)+power(7.25e0,2)))", 8)} AS king_prob,
    {R("1e0 + 2e2*exp(-bn*(power(rr/1.5e0, 1/4e0)-1))", 6)} AS sersic
    FROM (SELECT targetid, rr, 2*4e0-1/3e0+4/(405*4e0)+46/(25515*16e0)+131/(1148175*64e0)-2194697/(30690717750*256e0) AS bn,
      4.53e1 + CASE WHEN rr < 7.25e0 THEN 1.0848e3*power(1/sqrt(1+power(rr/1.3825e0,2)) - 1/sqrt(1+power(7.25e0/1.3825e0,2)),2) ELSE 0 END AS k
      FROM (SELECT targetid, clg*4e1 AS rr FROM hsc))""")
def _(c):
    p = (45.3, 1084.8, 1.3825, 7.25)
    rr = C("clg") * 40.0
    k = geo.king(rr, *[F.lit(v) for v in p])
    return c("hsc").select("targetid", r(k).alias("king"), r(F.log(k)).alias("log_king"),
                           r(geo.king_prob(rr, *p), 8).alias("king_prob"),
                           r(geo.sersic(rr, F.lit(1.0), F.lit(200.0), F.lit(1.5), F.lit(4.0))).alias("sersic"))


@check("s22_id_from_text", "SELECT c_custkey, CAST(substr(c_name, 10) AS BIGINT) AS num FROM customer")
def _(c):
    return table(c.spark, c.sf_dir, "customer").select("c_custkey", ids.id_from_text(C("c_name"), 9).alias("num"))


@check("s23_target_type", with_("hsc") + """SELECT targetid, CASE targetid%5 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3
    WHEN 3 THEN 4 ELSE 5 END AS target_type FROM hsc""")
def _(c):
    kinds = F.array(*[F.lit(k) for k in ("sci", "sky", "cal", "na", "eng")])
    return c("hsc").select("targetid", target_type_code(F.get(kinds, (C("targetid") % 5).cast("int"))).alias("target_type"))
