"""Scans and sinks, driven by configuration."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.nulls import normalise_missing
from ..functions.astro import haversine_deg
from ..operators.blocks import cell_join
from ..operators.zonejoin import circle_cells, cone, with_cell, with_disk


@dataclass(frozen=True)
class ListConfig:
    """How to read one target list."""

    path: str
    format: str = "parquet"
    schema: str | None = None
    columns: list[str] | None = None
    column_map: dict[str, str] = field(default_factory=dict)
    data_types: dict[str, str] = field(default_factory=dict)
    value_map: dict[str, dict[Any, Any]] = field(default_factory=dict)
    mask: Any = None                       # SQL text or a function of the frame
    sentinels: tuple[float, ...] = ()
    options: dict[str, Any] = field(default_factory=dict)


def apply_config(df: DataFrame, cfg: ListConfig) -> DataFrame:
    """Column subset, rename, casts, value replacement, missing values, row mask — in that order."""
    if cfg.columns:
        df = df.select(*cfg.columns)
    df = df.withColumnsRenamed(cfg.column_map)
    if cfg.data_types:
        df = df.withColumns({c: F.col(c).cast(t) for c, t in cfg.data_types.items()})
    for c, mapping in cfg.value_map.items():
        m = F.create_map(*[F.lit(v) for kv in mapping.items() for v in kv])
        df = df.withColumn(c, F.coalesce(F.element_at(m, F.col(c)), F.col(c)))
    df = normalise_missing(df, cfg.sentinels)
    if cfg.mask is not None:
        df = df.where(F.expr(cfg.mask) if isinstance(cfg.mask, str) else cfg.mask(df))
    return df


def read_list(spark: SparkSession, cfg: ListConfig) -> DataFrame:
    reader = spark.read.format(cfg.format).options(**cfg.options)
    if cfg.schema:
        reader = reader.schema(cfg.schema)
    return apply_config(reader.load(cfg.path), cfg)


@dataclass(frozen=True)
class TextLayout:
    """A headerless text catalog: column names and types in file order."""

    columns: tuple[tuple[str, str], ...]
    delimiter: str = r"\s+"
    comment: str = "#"
    skip: int = 0


# Column order of the known text catalogs.
LAYOUTS: dict[str, TextLayout] = {
    "hsc_g_i_nb": TextLayout((
        ("ID", "bigint"), ("RA", "double"), ("Dec", "double"), ("X", "double"), ("Y", "double"), ("ipsf", "double"),
        ("gpsf", "double"), ("npsf", "double"), ("ipsferr", "double"), ("gpsferr", "double"), ("npsferr", "double"),
        ("cli", "double"), ("clg", "double"), ("cln", "double"), ("a_g", "double"), ("a_i", "double"), ("a_n", "double"),
    )),
    "hsc_g_i_nb_old": TextLayout((
        ("ID", "bigint"), ("RA", "double"), ("Dec", "double"), ("X", "double"), ("Y", "double"), ("ipsf", "double"),
        ("gpsf", "double"), ("npsf", "double"), ("ipsferr", "double"), ("gpsferr", "double"), ("npsferr", "double"),
        ("cli", "double"), ("clg", "double"), ("cln", "double"), ("a_i", "double"), ("a_g", "double"), ("a_n", "double"),
    )),
    "cfht_g_r": TextLayout((
        ("ID", "bigint"), ("RA", "double"), ("Dec", "double"), ("obs_sdss_g", "double"), ("obs_sdss_r", "double"),
        ("err_sdss_g", "double"), ("err_sdss_r", "double"), ("ext_sdss_g", "double"), ("ext_sdss_r", "double"),
    )),
    "hsc_g_i2_nb_csv": TextLayout((
        ("RA", "double"), ("Dec", "double"), ("xi", "double"), ("eta", "double"), ("gpsf", "double"), ("ipsf", "double"),
        ("npsf", "double"), ("gpsferr", "double"), ("ipsferr", "double"), ("npsferr", "double"), ("clg", "double"),
        ("cli", "double"), ("cln", "double"), ("EBV", "double"), ("a_g", "double"), ("a_i", "double"), ("a_n", "double"),
        ("gpsf0", "double"), ("ipsf0", "double"), ("nb515psf0", "double"),
    ), delimiter=",", skip=1),
    "ps1_grizy_csv": TextLayout((
        ("RA", "double"), ("Dec", "double"), ("objid", "bigint"), ("obs_ps1_g", "double"), ("err_ps1_g", "double"),
        ("obs_ps1_r", "double"), ("err_ps1_r", "double"), ("rKmag", "double"), ("obs_ps1_i", "double"),
        ("err_ps1_i", "double"), ("obs_ps1_z", "double"), ("err_ps1_z", "double"), ("obs_ps1_y", "double"),
        ("err_ps1_y", "double"), ("gPSFf", "double"), ("rPSFf", "double"), ("iPSFf", "double"), ("zPSFf", "double"),
        ("Epoch", "string"), ("coord", "string"), ("separation", "double"), ("ext_ps1_g", "double"),
        ("ext_ps1_r", "double"), ("ext_ps1_i", "double"), ("ext_ps1_z", "double"), ("ext_ps1_y", "double"),
    ), delimiter=",", skip=1),
}

# Renames of catalogs that come with a header.
MULTI_SURVEY_MAP = {
    "hsc_targetid": "objid", "hsc_ra": "RA", "hsc_dec": "Dec",
    "hsc_g": "obs_hsc_g", "hsc_r": "obs_hsc_r", "hsc_a_g": "ext_hsc_g", "hsc_a_r": "ext_hsc_r",
    "ps1_g": "obs_ps1_g", "ps1_r": "obs_ps1_r", "ps1_i": "obs_ps1_i", "ps1_z": "obs_ps1_z", "ps1_y": "obs_ps1_y",
}
NEBULA_MAP = {"DEC": "Dec", "mag_g": "obs_hsc_g", "flag": "pnflag"}


def hsc_column_map(mags: dict[str, str]) -> dict[str, str]:
    """Renames of PSF magnitudes, errors and extinctions, e.g. ``{"g": "g", "i": "i2"}``."""
    out = {}
    for short, band in mags.items():
        out |= {f"{short}psf": f"obs_hsc_{band}", f"{short}psferr": f"err_hsc_{band}", f"a_{short}": f"ext_hsc_{band}"}
    return out


def parse_text(lines: DataFrame, layout: TextLayout) -> DataFrame:
    """Split text lines on the layout's delimiter (a pattern) into typed columns."""
    value = F.trim(F.col("value"))
    parts = F.split(value, layout.delimiter)
    kept = lines.where((F.length(value) > 0) & ~value.startswith(layout.comment))
    return kept.select(*[F.get(parts, F.lit(k)).try_cast(t).alias(n) for k, (n, t) in enumerate(layout.columns)])


def read_text_catalog(spark: SparkSession, path: str, layout: TextLayout, keep: Column | None = None) -> DataFrame:
    """Text catalog of a fixed layout; ``keep`` filters at the scan.

    A single-character delimiter is left to the CSV reader (with its header
    line, if the layout skips one); patterns are split here.
    """
    if len(layout.delimiter) == 1:
        schema = ", ".join(f"`{n}` {t}" for n, t in layout.columns)
        df = normalise_missing(spark.read.csv(path, schema=schema, sep=layout.delimiter, header=layout.skip > 0,
                                              comment=layout.comment, enforceSchema=True))
    else:
        df = normalise_missing(parse_text(spark.read.text(path), layout))
    return df.where(keep) if keep is not None else df


def read_csv(spark: SparkSession, path: str, schema: str, sep: str = ",", comment: str = "#",
             header: bool = True) -> DataFrame:
    """Delimited text with a header and ``#`` comments."""
    return normalise_missing(spark.read.csv(path, schema=schema, sep=sep, comment=comment, header=header,
                                            ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True))


# Column maps of flux standard and sky lists.
FLUX_STANDARD_MAP = {"fluxstd_id": "targetid", "obj_id": "orig_objid", "ra": "RA", "dec": "Dec",
                     "parallax_error": "err_parallax", "pmra_error": "err_pmra", "pmdec_error": "err_pmdec"}
SKY_MAP = {"sky_id": "targetid", "ra": "RA", "dec": "Dec"}


# Families of simulated columns.
PREFIXES = ("", "obs_", "err_", "flux_", "obs_flux_", "err_flux_", "counts_", "obs_counts_", "err_counts_")


def simulation_columns(mapping: dict[str, str], prefixes: tuple[str, ...] = PREFIXES) -> dict[str, str]:
    """Expand a magnitude map over the families of prefixed array columns."""
    return {p + old: p + new for old, new in mapping.items() for p in prefixes}


def read_simulation(spark: SparkSession, path: str, mapping: dict[str, str]) -> DataFrame:
    df = spark.read.parquet(path)
    return df.withColumnsRenamed({a: b for a, b in simulation_columns(mapping).items() if a in df.columns})


def read_cone(spark: SparkSession, path: str, ra0: float, dec0: float, radius_deg: float,
              pos: tuple[str, str] = ("ra", "dec")) -> DataFrame:
    """Cone of a table written by ``write_sky_table``.

    The zones name their limits, so those that the cone can't touch are pruned
    as partitions; the box on the position reaches the Parquet scan.
    """
    sky = spark.read.parquet(path)
    sky = sky.where((F.col("dec_from") <= dec0 + radius_deg) & (F.col("dec_to") >= dec0 - radius_deg))
    return cone(sky, ra0, dec0, radius_deg, pos).drop("dec_from", "dec_to")


def read_cones(centers: DataFrame, path: str, radius_deg: float, key: str, height_deg: float = 1.0, center_pos: tuple[str, str] = ("ra", "dec"),
               pos: tuple[str, str] = ("ra", "dec")) -> DataFrame:
    """Many cones of a table written by ``write_sky_table`` at once: its rows with the ``key`` of each center within the radius.

    The zones that the cones touch, of which the sky has 180 / ``height_deg`` at
    most, are found from the centers while the query runs and prune the
    partitions of the table; the rest is a cell join of rows and cones. Where
    rows are dense a cone is listed under many small cells: most of them lie in it
    as a whole, so that their rows need no distance, and few rows meet it in vain.
    """
    sky = centers.sparkSession.read.parquet(path)
    low = lambda d: F.floor((d + 90.0) / height_deg).cast("int")
    dec = F.col(center_pos[1])
    at = centers.where(dec.between(-90.0, 90.0)).select(F.explode(F.sequence(low(dec - radius_deg), low(dec + radius_deg))).alias("z"))
    zones = at.distinct().select((F.col("z") * height_deg - 90.0).cast("double").alias("dec_from"))
    near = sky.join(F.broadcast(zones), "dec_from", "left_semi").drop("dec_from", "dec_to")
    h = circle_cells(near, *pos, radius_deg)
    named = centers.select(F.col(key), F.col(center_pos[0]).cast("double").alias("_c_ra"), F.col(center_pos[1]).cast("double").alias("_c_dec"))
    met = cell_join(with_cell(near, *pos, h), with_disk(named, "_c_ra", "_c_dec", h, radius_deg).withColumnRenamed("inside", "_inside"), True)
    close = haversine_deg(F.col(pos[0]), F.col(pos[1]), F.col("_c_ra"), F.col("_c_dec")) <= radius_deg
    return met.where(F.col("_inside") | close).drop("_c_ra", "_c_dec", "_inside")


def write_sky_table(df: DataFrame, path: str, height_deg: float = 1.0, dec: str = "dec") -> None:
    """All-sky table partitioned by declination zone and sorted, so that cones read few files."""
    low = F.floor((F.col(dec) + 90.0) / height_deg) * height_deg - 90.0
    (df.withColumns({"dec_from": low.cast("double"), "dec_to": (low + height_deg).cast("double")})
     .repartitionByRange("dec_from", dec).sortWithinPartitions("dec_from", dec)
     .write.mode("errorifexists").partitionBy("dec_from", "dec_to").parquet(path))


def write_preprocessed(df: DataFrame, path: str, photometry: dict | None = None) -> None:
    """A preprocessed list and its photometry description; refuses to overwrite."""
    df.write.mode("errorifexists").parquet(f"{path}/data")
    text = json.dumps(photometry or {}, sort_keys=True)
    df.sparkSession.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{path}/photometry")


def read_preprocessed(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    df = spark.read.parquet(f"{path}/data")
    if "__objid" not in df.columns:
        df = df.withColumn("__objid", F.lit(0).cast("bigint"))
    return df, json.loads(spark.read.text(f"{path}/photometry").first().value)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Rows of all stages; a column missing in one of them is NULL there."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def read_stages(spark: SparkSession, paths: list[str]) -> DataFrame:
    return union_all([spark.read.parquet(p).withColumn("input_file", F.input_file_name()) for p in paths])


def write_clustered(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> None:
    """Materialise a query bucketed and sorted on its key, so that joins on it need no shuffle.

    The rows are dealt to the buckets before they are written, so a bucket is
    one file and not one of every task. ``path`` keeps the files in a folder of
    the caller's; else they go to the warehouse.
    """
    writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).mode("errorifexists")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def join_clustered(spark: SparkSession, left: str, right: str, key: str, how: str = "inner") -> DataFrame:
    """Join of two tables of ``write_clustered`` with the same key and number of buckets: bucket meets bucket, nothing is shuffled."""
    return spark.table(left).join(spark.table(right).hint("merge"), key, how)


def write_partitioned_text(df: DataFrame, path: str, by: list[str]) -> None:
    """One set of CSV files per value of the partition columns, in one job.

    Rebalancing gathers each value in few files but splits a value that is too
    large for one task.
    """
    df.hint("rebalance", *by).write.mode("errorifexists").partitionBy(*by).csv(path, header=True)


def write_rows(df: DataFrame, path: str, mask: Column | str | None = None) -> None:
    if mask is not None:
        df = df.where(mask)
    df.write.mode("errorifexists").parquet(path)


def write_pointing_list(pointings: DataFrame, path: str, run: dict[str, Any]) -> None:
    """The list of pointings (tens of rows) as one CSV file, with the run's settings beside it."""
    pointings.coalesce(1).write.mode("errorifexists").csv(f"{path}/pointings", header=True)
    text = json.dumps(run, sort_keys=True)
    pointings.sparkSession.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{path}/run")
