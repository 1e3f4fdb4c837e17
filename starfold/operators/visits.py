"""Pointings, visits and the fiber tables of each visit.

Pointings and visits are survey configuration (tens of rows). Tables that
repeat per visit get them as a literal array, so no join is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions import astro
from .blocks import grown_join
from .columns import target_type_code

POINTING_SCHEMA = ("pointing_idx int, ra double, dec double, posang double, stage int, priority int, "
                   "nvisits int, nrepeats int, exp_time double, obs_time timestamp")


def pointings_frame(spark: SparkSession, pointings: list[dict]) -> DataFrame:
    names = [f.split()[0] for f in POINTING_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(p.get(n) for n in names) for p in pointings], POINTING_SCHEMA)


def select_pointings(pointings: DataFrame, stages: list[int] | None = None, **overrides) -> DataFrame:
    """Pointings of the given stages; a setting given here goes before the pointing's own."""
    if stages is not None:
        pointings = pointings.where(F.col("stage").isin(stages))
    changed = {k: F.coalesce(F.lit(v).cast(pointings.schema[k].dataType), F.col(k)) for k, v in overrides.items()}
    return pointings.withColumns(changed) if changed else pointings


def visits_of(pointings: DataFrame) -> DataFrame:
    """One row per visit with a running ``visit_idx`` in the order of the pointings."""
    before = Window.orderBy("pointing_idx").rowsBetween(Window.unboundedPreceding, -1)
    n = F.coalesce("nvisits", F.lit(1))
    # the window runs over the pointings of one survey plan
    first = pointings.withColumn("_first", F.coalesce(F.sum(n).over(before), F.lit(0)))
    return (first.withColumn("_v", F.explode(F.sequence(F.lit(0), n - 1)))
            .withColumn("visit_idx", (F.col("_first") + F.col("_v")).cast("int"))
            .withColumn("nrepeats", F.coalesce("nrepeats", F.lit(1))).drop("_first", "_v", "nvisits"))


def with_repeats(designs: DataFrame, repeats: str = "nrepeats") -> DataFrame:
    """One row per repeat; a missing number of repeats is one, numbered -1 if it was not asked for."""
    n = F.col(repeats)
    idx = F.when(n.isNull(), F.array(F.lit(-1))).otherwise(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1))
    return designs.withColumn("repeat_idx", F.explode(idx))


def visibility_grid(pointings: DataFrame, start: str, stop: str, step_minutes: int, longitude=astro.SITE_LONGITUDE,
                    latitude=astro.SITE_LATITUDE, airmass_limit: float = astro.AIRMASS_LIMIT) -> DataFrame:
    """Altitude, azimuth and airmass of each pointing over a grid of times."""
    times = F.sequence(F.lit(start).cast("timestamp"), F.lit(stop).cast("timestamp"),
                       F.expr(f"INTERVAL '{int(step_minutes)}' MINUTE"))
    df = pointings.withColumn("time", F.explode(times))
    alt, az = astro.altitude_azimuth(F.col("ra"), F.col("dec"), F.col("time"), longitude, latitude)
    df = df.withColumns({"alt": alt, "az": az})
    mass = astro.airmass(F.col("alt"))
    return df.withColumns({"airmass": mass, "visible": F.coalesce((F.col("alt") > 0) & (mass <= airmass_limit), F.lit(False))})


# Fiber states and the bits that lead to them.
GOOD, BROKEN_FIBER, BROKEN_POSITIONER, BLOCKED = 1, 2, 4, 3
BIT_POSITIONER_OK, BIT_FIBER_BROKEN = 1, 4


def fiber_state(status: Column, blocked: Column) -> Column:
    """State from the status bits; later causes go before earlier ones."""
    broken = status.bitwiseAND(BIT_FIBER_BROKEN) != 0
    ok = status.bitwiseAND(BIT_POSITIONER_OK) != 0
    return (F.when(F.coalesce(blocked, F.lit(False)), F.lit(BLOCKED)).when(~ok & ~broken, F.lit(BROKEN_POSITIONER))
            .when(broken, F.lit(BROKEN_FIBER)).otherwise(F.lit(GOOD)))


# Numbers of a fiber's parts beside its own and its positioner's.
HARDWARE_IDS = ("science_fiber_id", "field_id", "fiber_hole_id", "spectrograph_id")


def fiber_table(fibers: DataFrame, assignments: DataFrame, visits: list[dict]) -> DataFrame:
    """Every fiber of every visit: assigned, unassigned (parked) or engineering.

    ``fibers`` holds fiber_id, positioner_id (NULL for engineering fibers),
    park_x, park_y, fiber_status and any of ``HARDWARE_IDS``, which come along
    (-1 where unknown); ``assignments`` holds visit_idx, fiber_id,
    target_idx, prefix, x, y, dist, dot_dist.
    """
    items = F.array(*[F.struct(F.lit(v["visit_idx"]).alias("visit_idx"), F.lit(v["pointing_idx"]).alias("pointing_idx"),
                               F.lit(v["stage"] if v.get("stage") is not None else -1).alias("stage")) for v in visits])
    slots = fibers.withColumn("_v", F.explode(items)).select("*", "_v.*").drop("_v")
    a = assignments.select("visit_idx", "fiber_id", "target_idx", "prefix", "x", "y", "dist", "dot_dist")
    engineering = F.col("positioner_id").isNull()
    kind = F.when(engineering, "eng").otherwise(F.coalesce("prefix", F.lit("na")))
    taken = F.col("target_idx").isNotNull()
    return grown_join(slots, a, ["visit_idx", "fiber_id"], "left").select(
        "fiber_id", "stage", "pointing_idx", "visit_idx",
        F.coalesce("target_idx", F.lit(-1)).cast("long").alias("target_idx"),
        F.coalesce("positioner_id", F.lit(-1)).cast("int").alias("positioner_id"),
        *[F.coalesce(F.col(n) if n in fibers.columns else F.lit(None), F.lit(-1)).cast("int").alias(n) for n in HARDWARE_IDS],
        F.when(taken, F.col("x")).when(~engineering, F.col("park_x")).alias("fp_x"),
        F.when(taken, F.col("y")).when(~engineering, F.col("park_y")).alias("fp_y"),
        target_type_code(kind).alias("target_type"),
        F.when(engineering, F.lit(GOOD)).otherwise(F.col("fiber_status")).alias("fiber_status"),
        F.col("dist").alias("center_dist"), F.col("dot_dist").alias("black_dot_dist"))


def design_list(visits: DataFrame, design_ids: DataFrame) -> DataFrame:
    """One row per visit with the id of its design."""
    return grown_join(visits, design_ids, ["pointing_idx", "visit_idx"], "left").select(
        "stage", "pointing_idx", "visit_idx", "priority", "nrepeats", "ra", "dec", "posang", "obs_time", "exp_time", "design_id")
