"""Completeness reports over targets and assignments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .blocks import grown_join
from .ids import dense_id


def count_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def distinct_targets(assignments: DataFrame, keys: list[str], approximate: bool = False) -> DataFrame:
    """Distinct targets per key, or estimated on request."""
    f = F.approx_count_distinct("target_idx") if approximate else F.count_distinct("target_idx")
    return assignments.groupBy(*keys).agg(f.alias("n")) if keys else assignments.agg(f.alias("n"))


SKETCH_BITS = 12       # 2**12 cells: one sigma of an estimate is about 1.6 %


def write_sketches(assignments: DataFrame, path: str, keys: list[str], run: str) -> None:
    """One sketch of the distinct targets for each key, stored beside those of other runs.

    A sketch has a few kilobytes whatever it counts; later stages read these
    and not the assignments.
    """
    sketched = assignments.groupBy(*keys).agg(F.hll_sketch_agg("target_idx", F.lit(SKETCH_BITS)).alias("sketch"))
    sketched.withColumn("run", F.lit(run)).write.mode("append").parquet(path)


def sketched_targets(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Estimated distinct targets per key over all stored runs, or of all; a target in several runs counts once."""
    merged = F.hll_sketch_estimate(F.hll_union_agg("sketch", F.lit(False))).alias("n")
    stored = spark.read.parquet(path)
    return stored.groupBy(*keys).agg(merged) if keys else stored.agg(merged)


def visit_table(assignments: DataFrame) -> DataFrame:
    """Distinct targets per (pointing, visit, prefix), and per prefix in total (NULL pointing and visit)."""
    once = assignments.groupBy("pointing_idx", "visit_idx", "prefix", "target_idx").agg(F.first(F.lit(1)))
    per_visit = once.groupBy("pointing_idx", "visit_idx", "prefix").agg(F.count(F.lit(1)).alias("n"))
    total = once.groupBy("prefix").agg(F.count_distinct("target_idx").alias("n"))
    return per_visit.unionByName(total, allowMissingColumns=True)


def summary(targets: DataFrame, assignments: DataFrame, visits: DataFrame) -> DataFrame:
    """Every target with the visits scheduled for it (repeats included)."""
    n = (grown_join(assignments, visits.select("visit_idx", "nrepeats"), "visit_idx").groupBy("target_idx")
         .agg(F.sum("nrepeats").alias("num_visits")))
    return grown_join(targets, n, "target_idx", "left").withColumn("num_visits", F.coalesce("num_visits", F.lit(0)))


def completeness(summed: DataFrame) -> DataFrame:
    """Per class: targets, observed, missed, partially observed, over-observed."""
    done, req, num = F.col("done_visits"), F.col("req_visits"), F.col("num_visits")
    return summed.groupBy("class").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(num > 0).alias("observed"), F.count_if(num == 0).alias("missed"),
        F.count_if((done < req) & (num > 0)).alias("partial"), F.count_if(num > req).alias("over"))


def priority_fractions(summed: DataFrame) -> DataFrame:
    """Per priority: all targets, assigned ones, and their share."""
    g = summed.groupBy("priority").agg(F.count(F.lit(1)).alias("n_all"), F.count_if(F.col("num_visits") > 0).alias("n_assigned"))
    return g.withColumn("fraction", F.try_divide(F.col("n_assigned"), F.col("n_all")))


def dense_counts(df: DataFrame, value: str, top: int | None = None) -> DataFrame:
    """Counts of a small non-negative integer from 0 to its maximum, zeros included."""
    counts = df.groupBy(F.col(value).cast("int").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    limit = counts.agg(F.max("value").alias("m")) if top is None else df.sparkSession.range(1).select(F.lit(top).alias("m"))
    grid = limit.select(F.explode(F.sequence(F.lit(0), F.col("m"))).alias("value"))
    return grid.join(counts, "value", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def list_contributions(targets: DataFrame) -> DataFrame:
    """Targets per input list and the share of *all* targets that come from it with proper motion."""
    total = targets.agg(F.count(F.lit(1))).scalar()
    moving = F.count_if(F.col("pmra").isNotNull() & F.col("pmdec").isNotNull())
    return targets.groupBy("key").agg(F.count(F.lit(1)).alias("n"), moving.alias("n_pm")).withColumn(
        "pm_fraction", F.col("n_pm") / total)


def fiber_load(edges: DataFrame, fibers: DataFrame, pointing_idx: list[int]) -> DataFrame:
    """Visible targets per fiber and pointing; fibers that see nothing count zero."""
    n = edges.groupBy("pointing_idx", "fiber_id").agg(F.count_distinct("target_idx").alias("n"))
    slots = fibers.select("fiber_id", F.explode(F.array(*[F.lit(p) for p in pointing_idx])).alias("pointing_idx"))
    return grown_join(slots, n, ["pointing_idx", "fiber_id"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def load_histogram(load: DataFrame) -> DataFrame:
    return load.groupBy("pointing_idx", F.col("n").alias("n_targets")).agg(F.count(F.lit(1)).alias("n_fibers"))


def group_load(load: DataFrame, fibers: DataFrame, group: str) -> DataFrame:
    return (grown_join(load, fibers.select("fiber_id", group), "fiber_id").groupBy("pointing_idx", group)
            .agg(F.sum("n").alias("n"), F.count_if(F.col("n") == 0).alias("n_idle")))


def multiplets(edges: DataFrame) -> DataFrame:
    """Targets that more than one fiber reaches, with the number of fibers."""
    return (edges.groupBy("pointing_idx", "target_idx").agg(F.count_distinct("fiber_id").alias("n_fibers"))
            .where("n_fibers > 1"))


def median(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    """One row with the median. The exact one numbers the values over range partitions and takes the middle ones."""
    if approximate:
        return df.agg(F.percentile_approx(column, 0.5, 10_000).alias("median"))
    placed = dense_id(df.select(F.col(column).alias("_x")).where("_x IS NOT NULL"), "_x", "_place")
    n = placed.count()
    return placed.where(F.col("_place").isin((n - 1) // 2, n // 2)).agg(F.avg("_x").alias("median"))


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Missing values per column, in one pass: (column, n_null)."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return wide.unpivot([], columns, "column", "n_null")


def target_radii(assignments: DataFrame, targets: DataFrame, radius: Column) -> DataFrame:
    """Distinct assigned targets with their radius, for the radial profile of what was observed."""
    seen = assignments.select("target_idx").distinct()
    return targets.join(seen, "target_idx", "left_semi").withColumn("radius", radius)
