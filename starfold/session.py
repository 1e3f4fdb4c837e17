"""Session helpers: lineage cuts through the cluster's checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession, functions as F


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``; one of our own only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
            named = tempfile.mkdtemp(prefix="starfold-")
        sc.setCheckpointDir(named)
        current = sc.getCheckpointDir()
    return current


def cut(df: DataFrame) -> DataFrame:
    """Write the rows out and go on from there, so that loops keep short plans."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def pin(df: DataFrame, *names: str) -> DataFrame:
    """Keep computed columns computed once.

    A later filter on a column is pushed below the projections that make it,
    with the column's definition written out in full; for columns built in many
    steps that text grows exponentially. Passing the values through a generator
    stops the push without moving any row.
    """
    others = [c for c in df.columns if c not in names]
    packed = df.select(*others, F.explode(F.array(F.struct(*names))).alias("_pin"))
    return packed.select(*[F.col(f"_pin.{c}").alias(c) if c in names else F.col(c) for c in df.columns])
