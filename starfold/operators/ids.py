"""Dense identifiers without a global sort in one task, and id formats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut


def dense_id(df: DataFrame, order: str, name: str, start: int = 0) -> DataFrame:
    """Number the rows ``start, start+1, …`` in the order of a unique column.

    Rows are range-partitioned and sorted within partitions; each row's place is
    its place in the partition plus the sizes of the partitions before it. The
    ranges are written out first, since they may differ when computed again.
    Only the partition sizes meet in one task.
    """
    ranged = df.repartitionByRange(order).sortWithinPartitions(order)
    ranged = cut(ranged.withColumn("_at", F.monotonically_increasing_id()))
    part, row = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    shift = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    # one row per partition, so the broadcast is bounded
    return (ranged.withColumn("_part", part).join(F.broadcast(shift), "_part")
            .withColumn(name, (row + F.col("_shift") + F.lit(start)).cast("bigint")).drop("_part", "_at", "_shift"))


def rank_in_groups(df: DataFrame, keys: list[str], value: str, tie: str, name: str, descending: bool = False) -> DataFrame:
    """1-based rank within groups by a value, ties by a unique column, missing values last.

    A group may hold a large part of all rows, so rows are range-partitioned by
    group and value: a large group spreads over several ranges, each is numbered
    on its own and shifted by the group's rows in the ranges before it.
    """
    v = F.col("_v").desc_nulls_last() if descending else F.col("_v").asc_nulls_last()
    df = df.withColumn("_v", F.col(value))
    ranged = cut(df.repartitionByRange(*keys, v, tie).withColumn("_part", F.spark_partition_id()))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # a boundary between ranges cuts at most one group, so fewer rows than partitions have a shift
    shift = (ranged.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_n"))
             .withColumn("_shift", F.sum("_n").over(before)).where("_shift IS NOT NULL").drop("_n"))
    row = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(v, tie))
    return (ranged.withColumn("_row", row).join(F.broadcast(shift), [*keys, "_part"], "left")
            .withColumn(name, (F.col("_row") + F.coalesce("_shift", F.lit(0))).cast("int"))
            .drop("_part", "_row", "_shift", "_v"))


def object_id(prefix_mask: int, idx: Column) -> Column:
    """Field prefix bits joined with the target's index."""
    return F.lit(prefix_mask).cast("bigint").bitwiseOR(idx.cast("bigint"))


def hex_id(c: Column) -> Column:
    return F.lower(F.lpad(F.hex(c), 16, "0"))


def id_from_text(c: Column, skip: int) -> Column:
    """The number that follows a fixed-length text prefix."""
    return F.substring(c, skip + 1, 64).cast("bigint")
