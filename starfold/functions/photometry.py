"""Magnitudes, fluxes, colors and the naming rule of photometric columns."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

# AB zero points for a flux in nJy and in Jy.
AB_ZERO_NJY = 31.4
AB_ZERO_JY = 8.9
MAG_PER_E = 2.5 / math.log(10.0)


def ab_to_njy(mag: Column) -> Column:
    return F.pow(F.lit(10.0), (F.lit(AB_ZERO_NJY) - mag) / 2.5)


def ab_err_to_njy(mag: Column, mag_err: Column) -> Column:
    return ab_to_njy(mag) * mag_err / MAG_PER_E


def njy_to_ab(flux: Column, zero: float = AB_ZERO_NJY) -> Column:
    """Magnitude of a flux; a flux that is not positive has none."""
    return F.when(flux > 0, F.lit(zero) - 2.5 * F.log10(flux))


def njy_err_to_ab(flux: Column, flux_err: Column) -> Column:
    return F.when(flux > 0, MAG_PER_E * flux_err / flux)


def snr_to_ab_err(flux_over_error: Column) -> Column:
    return F.when(flux_over_error > 0, F.try_divide(F.lit(MAG_PER_E), flux_over_error))


def deredden(mag: Column, ext: Column) -> Column:
    return mag - ext


def color_error(err1: Column, err2: Column) -> Column:
    return F.sqrt(err1 * err1 + err2 * err2)


def shift_by_distance(mag: Column, dm: float | Column) -> Column:
    return mag + (dm if isinstance(dm, Column) else F.lit(float(dm)))


def distance_modulus(parallax_mas: Column) -> Column:
    return F.when(parallax_mas > 0, F.lit(10.0) - 5.0 * F.log10(parallax_mas))


def absolute_magnitude(mag: Column, parallax_mas: Column) -> Column:
    return mag - distance_modulus(parallax_mas)


@dataclass(frozen=True)
class Magnitude:
    """A filter of a photometric system; columns follow ``{obs|err|ext}_{system}_{band}``."""

    system: str
    band: str

    @property
    def suffix(self) -> str:
        return f"{self.system}_{self.band}"

    def value(self, observed: bool = True, dered: bool = False) -> Column:
        c = F.col(f"obs_{self.suffix}" if observed else self.suffix)
        return deredden(c, F.col(f"ext_{self.suffix}")) if dered else c

    def error(self, observed: bool = True) -> Column:
        return F.col(f"err_{self.suffix}" if observed else f"err_model_{self.suffix}")


@dataclass(frozen=True)
class Color:
    blue: Magnitude
    red: Magnitude

    def value(self, observed: bool = True, dered: bool = False) -> Column:
        return self.blue.value(observed, dered) - self.red.value(observed, dered)

    def error(self, observed: bool = True) -> Column:
        return color_error(self.blue.error(observed), self.red.error(observed))


def fill_flux_kinds(prefixes: tuple[str, ...], name: str, mag: Column | None = None) -> dict[str, Column]:
    """Flux columns of one filter, each missing kind copied from the next better one.

    ``prefixes`` lists the kinds in order (psf, fiber, total); the first is
    computed from the magnitude when it has no flux of its own.
    """
    out, best = {}, None
    for kind in prefixes:
        own = F.col(f"{kind}_flux_{name}")
        fallback = ab_to_njy(mag) if best is None and mag is not None else best
        best = own if fallback is None else F.coalesce(own, fallback)
        out[f"{kind}_flux_{name}"] = best
    return out
