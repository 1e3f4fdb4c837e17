"""Mixing sources to target weights along a curriculum that changes over time.

Training time runs from 0 to 1. Each source has a weight schedule, a step
function of time. Its integral is the source's share; the shares say how many
words of each source the mix takes (its target), at most ``max_repeats`` times
the source's size. Within a source the documents are lined up in a hashed
order, one full round after another, and each takes the words from its place
in the line to the next. A document that begins after ``c`` of its source's
words belongs at the time when the source's cumulative demand reaches ``c``:
the inverse of the integrated schedule. Sorting by that time, in ranges, gives
the training order.

Nothing about single documents or sources meets in one task: lines are summed
over range partitions of (source, hash), and targets come from a few rounds of
totals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.ids import dense_id
from ..session import cut

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cyclic_weights(sources: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0)) -> DataFrame:
    """(source, weight): weights dealt in turn to the sources in code point order, null last."""
    named = dense_id(sources.where("source IS NOT NULL").select("source").distinct(), "source", "_nth")
    count = named.agg(F.count(F.lit(1)).alias("_nth"))
    missing = sources.where("source IS NULL").select("source").distinct().crossJoin(count)     # one row with one row
    table = F.array(*[F.lit(float(w)) for w in weights])
    both = named.select("source", "_nth").unionByName(missing)
    return both.select("source", F.get(table, (F.col("_nth") % len(weights)).cast("int")).alias("weight"))


def targets(sizes: DataFrame, share: float = 1.5, max_repeats: float = 2.0) -> DataFrame:
    """(source, source_size, weight, target) from (source, source_size, weight).

    ``share`` of all words is dealt by weight; a target stops at
    ``max_repeats`` times its source's size and the excess is dealt again by
    weight among the others until none is above. Each round fixes at least one
    more source at its limit; a round moves three totals to the driver. A
    source of weight 0 gets nothing.
    """
    limit = F.col("source_size") * max_repeats
    total = float(sizes.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]) * share
    level = 0.0
    while True:
        full = (F.col("weight") * level >= limit) & (F.col("weight") > 0)
        t = sizes.where("weight > 0").agg(F.sum(F.when(full, limit)), F.sum(F.when(~full, F.col("weight"))), F.count(F.when(full, 1))).first()
        if not t[1]:
            break
        new = max(level, (total - (t[0] or 0.0)) / t[1])
        if new <= level:
            break
        level = new
    return sizes.withColumn("target", F.least(F.col("weight") * level, limit).cast("double"))


def _inverse(schedule: list[tuple[float, float]], u: Column) -> Column:
    """Time at which the share ``u`` of a step schedule [(start, weight), …] is used up."""
    starts = [s for s, _ in schedule] + [1.0]
    area = [w * (b - a) for (a, w), b in zip(schedule, starts[1:])]
    total, done, out = sum(area), 0.0, F.lit(1.0)
    pieces = []
    for (a, w), part in zip(schedule, area):
        if part > 0:
            pieces.append((done / total, F.lit(a) + (u * total - done) / w))
        done += part
    for begin, value in pieces:
        out = F.when(u >= begin, value).otherwise(out)
    return F.least(F.greatest(out, F.lit(0.0)), F.lit(1.0))


SHAPES = (((0.0, 1.5), (0.5, 0.5)), ((0.0, 1.0),), ((0.0, 0.5), (0.5, 1.5)))     # early, even and late; each integrates to 1


def cyclic_schedules(sources: DataFrame, shapes: tuple = SHAPES) -> DataFrame:
    """(source, schedule): step schedules [(start, weight), …] dealt in turn to the sources in code point order, null last."""
    steps = F.array(*[F.array(*[F.struct(F.lit(float(a)).alias("start"), F.lit(float(w)).alias("weight")) for a, w in shape]) for shape in shapes])
    return cyclic_weights(sources, tuple(range(len(shapes)))).select("source", F.get(steps, F.col("weight").cast("int")).alias("schedule"))


def time_of_share(schedule: Column, u: Column) -> Column:
    """Time at which the share ``u`` of a schedule column is used up: the inverse of its integral.

    Steps without or with a negative or undefined weight use nothing; a
    schedule that uses nothing at all has no such time (null).
    """
    weight = lambda i: F.when((F.get(schedule, i)["weight"] > 0) & ~F.isnan(F.get(schedule, i)["weight"]), F.get(schedule, i)["weight"]).otherwise(0.0)
    end = lambda i: F.coalesce(F.get(schedule, i + 1)["start"], F.lit(1.0))
    steps = F.transform(schedule, lambda x, i: F.struct(x["start"].alias("start"), weight(i).alias("weight"), (weight(i) * (end(i) - x["start"])).alias("area")))
    total = F.aggregate(steps, F.lit(0.0), lambda s, x: s + x["area"])
    state = F.struct(F.lit(0.0).alias("done"), F.lit(None).cast("double").alias("time"))

    def walk(s: Column, x: Column) -> Column:
        here = (x["area"] > 0) & (u * total >= s["done"])          # the last step that begins no later than the share
        return F.struct((s["done"] + x["area"]).alias("done"), F.when(here, x["start"] + (u * total - s["done"]) / x["weight"]).otherwise(s["time"]).alias("time"))

    return F.aggregate(steps, state, walk, lambda s: F.when(s["time"].isNotNull(), F.least(s["time"], F.lit(1.0))))


def curriculum(lined: DataFrame, schedules: DataFrame | None = None, id_col: str = "doc_id") -> DataFrame:
    """``lined`` (from ``line_up``) with the ``position`` of each document's first round in training time, range-sorted by it.

    ``schedules`` has (source, schedule), else ``cyclic_schedules`` are used. A
    document of which the mix takes nothing has no position and comes first.
    """
    if schedules is None:
        schedules = cyclic_schedules(lined.select("source").distinct())
    named = schedules.select(F.col("source").alias("_s"), F.col("schedule").alias("_schedule"))
    rows = lined.drop("position").join(named, F.col("source").eqNullSafe(F.col("_s")), "left")
    share = F.col("place") / F.greatest(F.col("target"), F.lit(1.0))
    rows = rows.withColumn("position", F.when(F.col("taken") > 0, time_of_share(F.col("_schedule"), share))).drop("_s", "_schedule")
    order = ["position", "source", id_col]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def line_up(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", size: Column | None = None, text_col: str = "text",
            weights: DataFrame | None = None, schedules: dict[str, list[tuple[float, float]]] | None = None,
            share: float = 1.5, max_repeats: float = 2.0, seed: int = 0) -> DataFrame:
    """One row per row of ``docs``: its place in its source's line and the words the mix takes of it.

    Columns: the id, ``source``, ``size`` (words; or the given column),
    ``source_size``, ``target``, ``place`` (words of the source before it) and
    ``taken`` (repeats counted). ``weights`` has (source, weight), else
    ``cyclic_weights`` are used; ``schedules`` gives step schedules for some
    sources by name, and the weight of such a source is multiplied by its
    integral (the others are even over time).

    A null source is a source. A null or empty text has size 0 and nothing is
    taken of it. Documents are lined up by a hash of id and seed, then by id,
    size and content; equal rows are documents of their own. Reruns agree. An
    empty table gives no rows.
    """
    n = word_count(F.col(text_col).cast("string")) if size is None else F.coalesce(size, F.lit(0)).cast("long")
    text = F.md5(F.col(text_col).cast("binary")) if text_col in docs.columns else F.lit("")
    rows = cut(docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), n.alias("size"), text.alias("_text")))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    weights = cyclic_weights(sizes) if weights is None else weights
    joined = sizes.join(weights.select(F.col("source").alias("_s"), F.col("weight").cast("double")), F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    joined = joined.withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    for name, steps in (schedules or {}).items():
        ends = [s for s, _ in steps[1:]] + [1.0]
        integral = sum(w * (b - a) for (a, w), b in zip(steps, ends))
        joined = joined.withColumn("weight", F.when(F.col("source") == name, F.col("weight") * integral).otherwise(F.col("weight")))
    goal = targets(cut(joined), share, max_repeats)

    line = rows.withColumn("_h", F.md5(F.concat_ws("/", F.lit(str(seed)), F.col("id").cast("string")).cast("binary")))
    order = ["source", "_h", "id", "size", "_text"]
    line = cut(line.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    before = Window.partitionBy("source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # a source spread over several ranges: words in the ranges before; fewer rows than ranges and sources
    shift = (line.groupBy("source", "_part").agg(F.sum("size").alias("_n")).withColumn("_shift", F.coalesce(F.sum("_n").over(before), F.lit(0)))
             .select(F.col("source").alias("_s"), F.col("_part").alias("_p"), "_shift"))
    inner = Window.partitionBy("source", "_part").orderBy(*order[1:]).rowsBetween(Window.unboundedPreceding, -1)
    line = line.withColumn("_c", F.coalesce(F.sum("size").over(inner), F.lit(0)))
    line = line.join(shift, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_part") == F.col("_p")))
    line = line.select("id", "source", "size", (F.col("_c") + F.col("_shift")).alias("place"))
    line = line.join(goal.select(F.col("source").alias("_s"), "source_size", "target"), F.col("source").eqNullSafe(F.col("_s")))

    terms = F.transform(F.sequence(F.lit(0), _last_round()), lambda r: _words_taken(r))
    return line.select(F.col("id").alias(id_col), "source", "size", "source_size", "target", "place",
                       F.aggregate(terms, F.lit(0).cast("long"), lambda a, b: a + b).alias("taken"))


def _last_round() -> Column:
    last = F.floor((F.floor("target") - 1 - F.col("place")) / F.greatest(F.col("source_size"), F.lit(1)))
    return F.greatest(last, F.lit(0)).cast("int")


def _words_taken(r: Column) -> Column:
    left = F.floor("target") - F.col("place") - r * F.col("source_size")
    return F.greatest(F.least(F.col("size"), left), F.lit(0)).cast("long")


def schedule(lined: DataFrame, schedules: dict[str, list[tuple[float, float]]] | None = None) -> DataFrame:
    """One row per document and ``round`` (0 for the first) of ``line_up`` that the mix takes, with its ``position`` in time.

    ``taken`` is of this round; it is less than ``size`` only where a source's
    target ends inside the document. Other columns stay.
    """
    line = lined.where("taken > 0").withColumn("round", F.explode(F.sequence(F.lit(0), _last_round())))
    line = line.withColumn("taken", _words_taken(F.col("round")))
    used = (F.col("place") + F.col("round") * F.col("source_size")) / F.greatest(F.col("target"), F.lit(1.0))
    position = used
    for name, steps in (schedules or {}).items():
        position = F.when(F.col("source") == name, _inverse(steps, used)).otherwise(position)
    return line.withColumn("position", position)


def in_training_order(mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``schedule``, range-sorted by position; ties by source, id and round."""
    order = ["position", "source", id_col, "round"]
    return mixed.repartitionByRange(*order).sortWithinPartitions(*order)
