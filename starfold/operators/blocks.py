"""Equi-join of points with covering cells.

Spatial joins here put every point in one cell and every searching row in all
the cells its search region touches, so every (point, searcher) pair meets in
exactly one cell. The join is an ordinary sort-merge join on the cell: its
inputs keep no partitioning of their own, so the engine is free to split the
partitions of a crowded cell, on both sides, by the sizes it measures while
running, and to broadcast a side that proves small unless both grow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def grown_join(left: DataFrame, right: DataFrame, on: Column | list[str] | str, how: str = "inner") -> DataFrame:
    """Join of two tables that both grow with the input; neither is sent through the driver.

    The engine estimates a table by its compressed files and takes rows that an
    explosion adds for none, so it would broadcast millions of rows as small.
    """
    return left.join(right.hint("merge"), on, how)


def cell_join(points: DataFrame, covers: DataFrame, grown: bool = False) -> DataFrame:
    """All (point, cover) pairs that share a cell. Both inputs carry ``cell``.

    Column names other than ``cell`` must differ between the inputs. ``grown``
    says that both grow with the input.
    """
    return (grown_join(points, covers, "cell") if grown else points.join(covers, "cell")).drop("cell")
