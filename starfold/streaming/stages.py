"""Stage chaining: the outputs of earlier stages feed the next one.

A survey is observed in stages. Each stage writes targets and assignments to
its own folder; the next reads all of them, adds up the visits done and goes on
with what is left. New target lists may also arrive as files in a folder; the
column and selection operators hold no state, so they run on such a stream.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.merge import accumulate_visits
from ..sources.tables import ListConfig, apply_config, read_stages


def next_stage_targets(spark: SparkSession, targets_dir: str, stage_dirs: list[str], visits: DataFrame) -> DataFrame:
    """Targets with ``done_visits`` summed over the assignments of all earlier stages.

    ``visits`` lists visit_idx and nrepeats of those stages; visit numbers run
    on over the stages.
    """
    targets = spark.read.parquet(targets_dir)
    if not stage_dirs:
        return targets.withColumn("done_visits", F.lit(0)) if "done_visits" not in targets.columns else targets
    return accumulate_visits(targets, read_stages(spark, stage_dirs), visits)


def unfinished(targets: DataFrame) -> DataFrame:
    """Targets that still need visits, with the number they need."""
    left = F.col("req_visits") - F.col("done_visits")
    return targets.withColumn("visits_left", left).where(left > 0)


def ingest_lists(spark: SparkSession, folder: str, schema: str, cfg: ListConfig, out: str, checkpoint: str,
                 transform: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Read target lists as their files arrive, apply the list's configuration and append the rows to Parquet."""
    stream = spark.readStream.format(cfg.format).schema(schema).options(**cfg.options).load(folder)
    rows = apply_config(stream, cfg)
    if transform is not None:
        rows = transform(rows)
    return (rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
