"""Spherical astronomy in closed form, built from JVM-side column functions."""

from __future__ import annotations


from pyspark.sql import Column, functions as F

MAS_PER_DEG = 3.6e6


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(float(v))


def haversine_deg(ra1, dec1, ra2, dec2) -> Column:
    """Great-circle separation in degrees."""
    ra1, dec1, ra2, dec2 = map(_lit, (ra1, dec1, ra2, dec2))
    sd = F.sin(F.radians(dec2 - dec1) / 2)
    sr = F.sin(F.radians(ra2 - ra1) / 2)
    a = sd * sd + F.cos(F.radians(dec1)) * F.cos(F.radians(dec2)) * sr * sr
    return F.degrees(2 * F.asin(F.sqrt(F.least(F.lit(1.0), a))))


def separation_arcsec(ra1, dec1, ra2, dec2) -> Column:
    return haversine_deg(ra1, dec1, ra2, dec2) * 3600.0


def position_angle_deg(ra1, dec1, ra2, dec2) -> Column:
    """Direction from the first point to the second, east of north, in [0, 360)."""
    ra1, dec1, ra2, dec2 = (F.radians(_lit(v)) for v in (ra1, dec1, ra2, dec2))
    y = F.sin(ra2 - ra1) * F.cos(dec2)
    x = F.cos(dec1) * F.sin(dec2) - F.sin(dec1) * F.cos(dec2) * F.cos(ra2 - ra1)
    return F.pmod(F.degrees(F.atan2(y, x)), F.lit(360.0))


def offset_by(ra, dec, sep_deg, direction_deg) -> tuple[Column, Column]:
    """The point ``sep`` away in the given direction (a negative sep goes the other way)."""
    ra, dec, sep, pa = (F.radians(_lit(v)) for v in (ra, dec, sep_deg, direction_deg))
    sin_d = F.sin(dec) * F.cos(sep) + F.cos(dec) * F.sin(sep) * F.cos(pa)
    d2 = F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), sin_d)))
    dra = F.atan2(F.sin(sep) * F.sin(pa) * F.cos(dec), F.cos(sep) - F.sin(dec) * sin_d)
    return F.pmod(F.degrees(ra + dra), F.lit(360.0)), F.degrees(d2)


def propagate_epoch(ra: Column, dec: Column, pmra: Column, pmdec: Column, epoch: Column,
                    to_epoch) -> tuple[Column, Column]:
    """Move a star along its tangent vector; missing motion leaves it in place.

    ``pmra`` includes cos(dec), mas/yr. The perspective term (radial velocity)
    is not modelled.
    """
    years = _lit(to_epoch) - epoch
    a, d = F.radians(ra), F.radians(dec)
    ua, ud = F.radians(pmra / MAS_PER_DEG) * years, F.radians(pmdec / MAS_PER_DEG) * years
    x = F.cos(d) * F.cos(a) - ua * F.sin(a) - ud * F.sin(d) * F.cos(a)
    y = F.cos(d) * F.sin(a) + ua * F.cos(a) - ud * F.sin(d) * F.sin(a)
    z = F.sin(d) + ud * F.cos(d)
    moved = ua.isNotNull() & ud.isNotNull()
    new_ra = F.pmod(F.degrees(F.atan2(y, x)), F.lit(360.0))
    new_dec = F.degrees(F.atan2(z, F.sqrt(x * x + y * y)))
    return F.when(moved, new_ra).otherwise(ra), F.when(moved, new_dec).otherwise(dec)


def tan_project(ra, dec, ra0, dec0, posang=0.0, scale: float = 1.0) -> tuple[Column, Column]:
    """Tangent-plane position (scale units per degree), rotated by the position angle.

    Points on the far hemisphere have no projection (NULL).
    """
    a, d, a0, d0, pa = (F.radians(_lit(v)) for v in (ra, dec, ra0, dec0, posang))
    cosc = F.sin(d0) * F.sin(d) + F.cos(d0) * F.cos(d) * F.cos(a - a0)
    k = F.when(cosc > 0, F.degrees(F.lit(1.0)) * scale / cosc)
    xi = k * F.cos(d) * F.sin(a - a0)
    eta = k * (F.cos(d0) * F.sin(d) - F.sin(d0) * F.cos(d) * F.cos(a - a0))
    return xi * F.cos(pa) - eta * F.sin(pa), xi * F.sin(pa) + eta * F.cos(pa)


def tan_unproject(x, y, ra0, dec0, posang=0.0, scale: float = 1.0) -> tuple[Column, Column]:
    x, y = _lit(x), _lit(y)
    a0, d0, pa = (F.radians(_lit(v)) for v in (ra0, dec0, posang))
    xi = F.radians((x * F.cos(pa) + y * F.sin(pa)) / scale)
    eta = F.radians((-x * F.sin(pa) + y * F.cos(pa)) / scale)
    den = F.cos(d0) - eta * F.sin(d0)
    ra = F.pmod(F.degrees(a0 + F.atan2(xi, den)), F.lit(360.0))
    dec = F.degrees(F.atan2(F.sin(d0) + eta * F.cos(d0), F.sqrt(xi * xi + den * den)))
    return ra, dec


def parse_epoch(c: Column) -> Column:
    """``J2016.0`` as 2016.0."""
    return F.substring(c, 2, 30).cast("double")


def format_epoch(c: Column) -> Column:
    return F.format_string("J%.2f", c.cast("double"))


def sexagesimal_to_deg(c: Column, hours: bool = False) -> Column:
    """``dd:mm:ss`` (or ``hh:mm:ss``) as degrees; the sign of ``-00`` is kept."""
    parts = F.split(F.trim(c), "[:\\s]+")
    size = (F.abs(F.get(parts, F.lit(0)).cast("double")) + F.get(parts, F.lit(1)).cast("double") / 60.0
            + F.get(parts, F.lit(2)).cast("double") / 3600.0)
    value = F.when(F.trim(c).startswith("-"), -size).otherwise(size)
    return value * 15.0 if hours else value


def local_sidereal_deg(ts: Column, longitude_deg) -> Column:
    """Local mean sidereal time (degrees) of a UTC timestamp."""
    days = (F.unix_micros(ts) - F.lit(946728000000000)) / F.lit(86400e6)
    return F.pmod(F.lit(280.46061837) + F.lit(360.98564736629) * days + _lit(longitude_deg), F.lit(360.0))


# Geodetic position of the default site, degrees east and north.
SITE_LONGITUDE = -155.476
SITE_LATITUDE = 19.8255
AIRMASS_LIMIT = 3.0


def altitude_azimuth(ra, dec, ts: Column, longitude=SITE_LONGITUDE, latitude=SITE_LATITUDE) -> tuple[Column, Column]:
    ha = F.radians(local_sidereal_deg(ts, longitude) - _lit(ra))
    d, lat = F.radians(_lit(dec)), F.radians(_lit(latitude))
    sin_alt = F.sin(d) * F.sin(lat) + F.cos(d) * F.cos(lat) * F.cos(ha)
    alt = F.degrees(F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), sin_alt))))
    y = -F.cos(d) * F.sin(ha)
    x = F.sin(d) * F.cos(lat) - F.cos(d) * F.sin(lat) * F.cos(ha)
    return alt, F.pmod(F.degrees(F.atan2(y, x)), F.lit(360.0))


def airmass(alt_deg: Column) -> Column:
    return F.when(alt_deg > 0, F.try_divide(F.lit(1.0), F.sin(F.radians(alt_deg))))


# J2000 rotation from galactic to equatorial axes.
GALACTIC_TO_ICRS = (
    (-0.0548755604, 0.4941094279, -0.8676661490),
    (-0.8734370902, -0.4448296300, -0.1980763734),
    (-0.4838350155, 0.7469822445, 0.4559837762),
)


def galactic_to_icrs(lon, lat) -> tuple[Column, Column]:
    l, b = F.radians(_lit(lon)), F.radians(_lit(lat))
    g = (F.cos(b) * F.cos(l), F.cos(b) * F.sin(l), F.sin(b))
    x, y, z = (sum(F.lit(m) * v for m, v in zip(row, g)) for row in GALACTIC_TO_ICRS)
    ra = F.pmod(F.degrees(F.atan2(y, x)), F.lit(360.0))
    return ra, F.degrees(F.atan2(z, F.sqrt(x * x + y * y)))


def to_local_time(ts: Column, hours: int = 10) -> Column:
    """UTC shifted to the site's civil time."""
    return ts - F.expr(f"INTERVAL '{int(hours)}' HOUR")


def iso_seconds(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


