"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import cut


def components(links: DataFrame) -> DataFrame:
    """(node, root) for the ends of all links ``a``, ``b``: root is the smallest node reachable.

    Alternates two steps until nothing changes: every node hands the smallest
    node it sees to its larger neighbours, then every node joins its smaller
    neighbours to the smallest of them. Both keep the components and end in
    stars. Minima are combined before the shuffle; a node with very many
    links is one key of a sort-merge join that the engine may split. Each
    round is checkpointed. Empty input gives an empty table; loops (a = b) and
    repeated links do no harm, links with a null end are left out.
    """
    edges = cut(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                .where("u IS NOT NULL AND v IS NOT NULL AND u <> v").distinct())
    seen = None
    while True:
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                                             F.col("m").alias("v")).where("u <> v").distinct())
        edges = cut(small)
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
