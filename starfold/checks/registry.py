"""Registry of checked queries: each has a Spark callable and, where SQL can say it, an oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources.fixtures import load

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Catalogs:
    """Lazy access to the catalogs of one scale: ``c("hsc")``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __call__(self, name: str) -> DataFrame:
        return load(self.spark, self.sf_dir, name)


def check(name: str, sql: str | None = None):
    def wrap(fn: Callable[[Catalogs], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(Catalogs(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return wrap


def r(c: Column | str, n: int = 6) -> Column:
    """Rounded for comparison, with -0.0 folded into 0.0."""
    return F.round(F.col(c) if isinstance(c, str) else c, n) + F.lit(0.0)


def R(text: str, n: int = 6) -> str:
    return f"(round({text}, {n}) + 0e0)"


def UNIFORM(text: str) -> str:
    """The hashed number in (0, 1) of a text, for the oracle."""
    return f"((CAST('0x' || substr(md5({text}), 1, 13) AS UBIGINT) + 5e-1)/4.503599627370496e15)"


def HAV(ra1: str, dec1: str, ra2: str, dec2: str) -> str:
    """Separation in degrees as oracle text."""
    return (f"degrees(2*asin(sqrt(least(1e0, power(sin(radians({dec2}-({dec1}))/2),2)"
            f"+cos(radians({dec1}))*cos(radians({dec2}))*power(sin(radians({ra2}-({ra1}))/2),2)))))")
