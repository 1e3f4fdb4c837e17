"""Histogram maps over (population, x, y) cells and membership probability."""

from __future__ import annotations

import json
import math
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut


@dataclass(frozen=True)
class MapSpec:
    """Extents and bin counts of the two axes; give one of bins, bin_sizes or digits."""

    extents: tuple[tuple[float, float], tuple[float, float]]
    bins: tuple[int, int] = (50, 50)

    @staticmethod
    def make(extents, bins=None, bin_sizes=None, digits=None) -> "MapSpec":
        if sum(v is not None for v in (bins, bin_sizes, digits)) > 1:
            raise ValueError("give only one of bins, bin_sizes and digits")
        if digits is not None:
            bin_sizes = [10.0 ** -d for d in (digits if isinstance(digits, (list, tuple)) else (digits, digits))]
        if bin_sizes is not None:
            sizes = bin_sizes if isinstance(bin_sizes, (list, tuple)) else (bin_sizes, bin_sizes)
            bins = [math.ceil((hi - lo) / s) for (lo, hi), s in zip(extents, sizes)]
        return MapSpec(tuple(map(tuple, extents)), tuple(bins or (50, 50)))


def measured_extents(df: DataFrame, columns: list[str], bin_sizes: list[float] | None = None) -> DataFrame:
    """(axis, lo, hi) per column, snapped outwards to whole bins if a bin size is given."""
    stats = df.agg(*[f(c).alias(f"{n}_{k}") for k, c in enumerate(columns) for n, f in (("lo", F.min), ("hi", F.max))])
    rows = []
    for k, c in enumerate(columns):
        lo, hi = F.col(f"lo_{k}"), F.col(f"hi_{k}")
        if bin_sizes:
            lo, hi = F.floor(lo / bin_sizes[k]) * bin_sizes[k], F.ceil(hi / bin_sizes[k]) * bin_sizes[k]
        rows.append(F.struct(F.lit(c).alias("axis"), lo.cast("double").alias("lo"), hi.cast("double").alias("hi")))
    return stats.select(F.explode(F.array(*rows)).alias("e")).select("e.*")


def bin_of(c: Column, lo: float, hi: float, n: int, close_last: bool = True) -> Column:
    """Bin number, NULL outside; the last bin includes its upper edge."""
    idx = F.floor((c - lo) / (hi - lo) * n).cast("int")
    if close_last:
        return F.when((c >= lo) & (c <= hi), F.least(idx, F.lit(n - 1)))
    return F.when((c >= lo) & (c < hi), idx)


def histogram_1d(df: DataFrame, c: Column, lo: float, hi: float, n: int, by: list[str] | None = None) -> DataFrame:
    """Counts per non-empty bin: (by…, bin, n)."""
    return (df.withColumn("bin", bin_of(c, lo, hi, n)).where("bin IS NOT NULL")
            .groupBy(*(by or []), "bin").agg(F.count(F.lit(1)).alias("n")))


def histogram_2d(df: DataFrame, x: str, y: str, spec: MapSpec, weight: str | None = None,
                 mask: Column | None = None) -> DataFrame:
    """(pop, ix, iy, w): weighted counts per population of array columns x and y.

    The mask (and the weight) may be a plain column or an array with one entry
    per population; both drop the same stars.
    """
    values = F.arrays_zip(F.col(x).alias("x"), F.col(y).alias("y"))
    kept = df.select(values.alias("_v"), (F.lit(1.0) if weight is None else F.col(weight)).alias("_wt"), (F.lit(True) if mask is None else mask).alias("_on"))
    per_pop = {c: kept.schema[c].dataType.typeName() == "array" for c in ("_wt", "_on")}
    at = lambda c, k: F.get(F.col(c), k) if per_pop[c] else F.col(c)
    packed = F.transform("_v", lambda v, k: F.struct(v["x"].alias("x"), v["y"].alias("y"), at("_wt", k).alias("wt"), at("_on", k).alias("on")))
    long = kept.select(F.posexplode(packed).alias("pop", "v")).where("v.on")
    (xl, xh), (yl, yh) = spec.extents
    return (long.select("pop", bin_of(F.col("v.x"), xl, xh, spec.bins[0]).alias("ix"),
                        bin_of(F.col("v.y"), yl, yh, spec.bins[1]).alias("iy"), F.col("v.wt").alias("w"))
            .where("ix IS NOT NULL AND iy IS NOT NULL")
            .groupBy("pop", "ix", "iy").agg(F.sum("w").alias("w")))


def map_from_simulation(sim: DataFrame, x: str, y: str, spec: MapSpec, lp_stars: str | None = None,
                        mask: Column | None = None) -> DataFrame:
    """Map of a simulation; stars weigh ``exp(lp_stars)`` if a log weight is named."""
    if lp_stars:
        sim = sim.withColumn("_wt", F.exp(lp_stars))
    return histogram_2d(sim, x, y, spec, "_wt" if lp_stars else None, mask)


def population_weights(sim: DataFrame, pop: str) -> DataFrame:
    """Share of each drawn population."""
    counts = sim.groupBy(F.col(pop).alias("pop")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.select("pop", (F.col("n") / total).alias("weight"))


def rescale_weights(weights: DataFrame, factors: list[float]) -> DataFrame:
    """Multiply each population's weight by its factor and normalise to one."""
    f = F.array(*[F.lit(float(v)) for v in factors])
    scaled = weights.withColumn("weight", F.col("weight") * F.get(f, F.col("pop")))
    total = scaled.agg(F.sum("weight")).scalar()
    return scaled.select("pop", (F.col("weight") / total).alias("weight"))


def merge_populations(cells: DataFrame, groups: list[list[int]], weights: list[float]) -> tuple[DataFrame, list[float]]:
    """Sum ``weight * w`` of the populations of each group; group weights are the sums."""
    group_of = {p: g for g, members in enumerate(groups) for p in members}
    size = max(group_of) + 1
    group = F.array(*[F.lit(group_of.get(p)).cast("int") for p in range(size)])
    weight = F.array(*[F.lit(float(weights[p])) for p in range(size)])
    merged = (cells.select(F.get(group, F.col("pop")).alias("pop"), "ix", "iy",
                           (F.col("w") * F.get(weight, F.col("pop"))).alias("w"))
              .where("pop IS NOT NULL").groupBy("pop", "ix", "iy").agg(F.sum("w").alias("w")))
    return merged, [sum(weights[p] for p in members) for members in groups]


def maximum_filter(cells: DataFrame, spec: MapSpec, size: int = 3) -> DataFrame:
    """Each cell takes the largest value of its ``size`` × ``size`` surroundings."""
    k = size // 2
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"))
                      for i in range(-k, k + 1) for j in range(-k, k + 1)])
    spread = cells.select("pop", "ix", "iy", "w", F.explode(steps).alias("s")).select(
        "pop", (F.col("ix") + F.col("s.i")).alias("ix"), (F.col("iy") + F.col("s.j")).alias("iy"), "w")
    return (spread.where(F.col("ix").between(0, spec.bins[0] - 1) & F.col("iy").between(0, spec.bins[1] - 1))
            .groupBy("pop", "ix", "iy").agg(F.max("w").alias("w")))


def map_rows(cells: DataFrame, n_pop: int) -> DataFrame:
    """One row per cell with the values of all populations as an array ``h`` (0 where empty)."""
    per_pop = [F.coalesce(F.sum(F.when(F.col("pop") == p, F.col("w"))), F.lit(0.0)) for p in range(n_pop)]
    return cells.groupBy("ix", "iy").agg(F.array(*per_pop).alias("h"))


def nonzero_cells(cells: DataFrame, populations: list[int]) -> DataFrame:
    """Cells that hold something in every listed population."""
    return (cells.where(F.col("pop").isin(populations) & (F.col("w") > 0)).groupBy("ix", "iy")
            .agg(F.count_distinct("pop").alias("n")).where(F.col("n") == len(set(populations))).select("ix", "iy"))


def _norms(rows: DataFrame, n_pop: int) -> Column:
    """Sum of each population over the cells that all populations share (one row, lazily)."""
    shared = rows.where(F.forall("h", lambda v: v > 0))
    return shared.agg(F.array(*[F.sum(F.get("h", F.lit(p))) for p in range(n_pop)]).alias("norm")).scalar()


def _share(h: Column, norm: Column, w: Column) -> Column:
    """Weighted share of every population, NULL where there is nothing to share."""
    parts = F.zip_with(F.zip_with(h, norm, lambda a, b: F.try_divide(a, b)), w, lambda a, b: a * b)
    total = F.aggregate(parts, F.lit(0.0), lambda s, v: s + v)
    return F.when(total > 0, F.transform(parts, lambda v: v / total))


def _weights_array(weights: list[float]) -> Column:
    s = sum(weights)
    return F.array(*[F.lit(float(w) / s) for w in weights])


def membership_map(cells: DataFrame, weights: list[float]) -> DataFrame:
    """(ix, iy, p): membership of every population per cell; ``log_p`` is its logarithm."""
    rows = map_rows(cells, len(weights))
    p = _share(F.col("h"), F.col("norm"), _weights_array(weights))
    out = rows.withColumn("norm", _norms(rows, len(weights))).select("ix", "iy", "h", p.alias("p"))
    return out.withColumn("log_p", log_probability(F.col("p")))


def log_probability(p: Column) -> Column:
    return F.transform(p, lambda v: F.when(v > 0, F.log(v)).otherwise(F.lit(float("-inf"))))


def lookup_membership(stars: DataFrame, x: str, y: str, cells: DataFrame, spec: MapSpec, weights: list[float],
                      star_weights: str | None = None, legacy_shift: bool = False) -> DataFrame:
    """Add ``p`` (array over populations) to each star inside the map, else NULL.

    ``star_weights`` names an array column with the star's own population
    weights. ``legacy_shift`` reads the next cell on both axes and leaves the
    last one out, as results made with an off-by-one lookup did.
    """
    (xl, xh), (yl, yh) = spec.extents
    ix = bin_of(F.col(x), xl, xh, spec.bins[0], close_last=False)
    iy = bin_of(F.col(y), yl, yh, spec.bins[1], close_last=False)
    if legacy_shift:
        ix = F.when(ix + 1 < spec.bins[0], ix + 1)
        iy = F.when(iy + 1 < spec.bins[1], iy + 1)
    # the map is small beside the stars; it is computed once and its true size decides how it is joined
    rows = cut(map_rows(cells, len(weights)))
    rows = rows.withColumn("_norm", _norms(rows, len(weights)))
    # with common weights the whole share is a property of the cell
    value = F.struct("h", "_norm") if star_weights else _share(F.col("h"), F.col("_norm"), _weights_array(weights))
    rows = rows.select(F.col("ix").alias("_ix"), F.col("iy").alias("_iy"), value.alias("_v"))
    joined = stars.withColumns({"_sx": ix, "_sy": iy}).join(
        rows, (F.col("_sx") == F.col("_ix")) & (F.col("_sy") == F.col("_iy")), "left")
    p = _share(F.col("_v.h"), F.col("_v._norm"), F.col(star_weights)) if star_weights else F.col("_v")
    return joined.withColumn("p", p).drop("_sx", "_sy", "_ix", "_iy", "_v")


def assign_membership(stars: DataFrame, x: str, y: str, cells: DataFrame, spec: MapSpec, weights: list[float],
                      selected: Column, population: int = -1, **options) -> DataFrame:
    """``p_member`` of one population (the last by default) for selected stars."""
    k = population if population >= 0 else len(weights) + population
    out = lookup_membership(stars, x, y, cells, spec, weights, **options)
    return out.withColumn("p_member", F.when(selected, F.get("p", F.lit(k)))).drop("p")


def membership_from_column(stars: DataFrame, ml_prob: str) -> DataFrame:
    """``p_member`` from a ready-made probability column."""
    return stars.withColumn("p_member", F.when(~F.isnan(ml_prob), F.col(ml_prob)))


def save_map(cells: DataFrame, spec: MapSpec, weights: list[float], path: str) -> None:
    spark = cells.sparkSession
    cells.write.mode("errorifexists").parquet(f"{path}/cells")
    text = json.dumps({**asdict(spec), "weights": list(weights)})
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{path}/spec")


def load_map(spark, path: str) -> tuple[DataFrame, MapSpec, list[float]]:
    meta = json.loads(spark.read.text(f"{path}/spec").first().value)
    spec = MapSpec(tuple(map(tuple, meta["extents"])), tuple(meta["bins"]))
    return spark.read.parquet(f"{path}/cells"), spec, meta["weights"]


def compare_counts(observed: DataFrame, simulated: DataFrame, observed_cut: Column, simulated_cut: Column) -> DataFrame:
    """Observed and simulated rows inside the cuts."""
    def one(df, cut, name):
        return df.agg(F.count_if(cut).alias("n_inside"), F.count(F.lit(1)).alias("n_all")).withColumn("source", F.lit(name))
    return one(observed, observed_cut, "observed").unionByName(one(simulated, simulated_cut, "simulated"))
