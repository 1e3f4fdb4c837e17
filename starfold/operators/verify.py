"""Checks of lists, plans and assignments; each returns its violations as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from .blocks import grown_join
from .columns import class_lookup

# Columns each kind of list must and should have.
REQUIRED = {"sci": ("targetid", "RA", "Dec", "priority", "exp_time"), "cal": ("targetid", "RA", "Dec"),
            "sky": ("targetid", "RA", "Dec"), "ag": ("targetid", "RA", "Dec")}
RECOMMENDED = {"sci": ("epoch", "pmra", "pmdec", "parallax", "rv", "proposalid", "catid", "obcode"),
               "cal": ("epoch", "pmra", "pmdec", "parallax"), "sky": (), "ag": ("epoch", "pmra", "pmdec", "parallax")}


def missing_columns(df: DataFrame, prefix: str) -> tuple[list[str], list[str]]:
    """(required, recommended) columns that the list lacks."""
    have = set(df.columns)
    return [c for c in REQUIRED[prefix] if c not in have], [c for c in RECOMMENDED[prefix] if c not in have]


def list_problems(df: DataFrame, prefix: str) -> DataFrame:
    """(problem, severity, targetid, n): duplicate ids, missing priorities, missing or bad exposure times."""
    dup = (df.groupBy("targetid").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
           .select(F.lit("duplicate targetid").alias("problem"), F.lit("warning").alias("severity"), "targetid", "n"))
    if prefix != "sci":
        return dup
    bad = F.array_compact(F.array(F.when(F.col("priority").isNull(), F.lit("missing priority")),
                                  F.when(F.col("exp_time").isNull() | (F.col("exp_time") <= 0), F.lit("bad exposure time"))))
    rows = df.select("targetid", F.explode(bad).alias("problem")).select(
        "problem", F.lit("error").alias("severity"), "targetid", F.lit(1).cast("bigint").alias("n"))
    return dup.unionByName(rows)


def list_counts(prefix: str) -> dict[str, Column]:
    """Conditions of the problems that a list's rows show by themselves, by name."""
    out = {"missing_position": F.col("RA").isNull() | F.col("Dec").isNull() | F.isnan("RA") | F.isnan("Dec"), "missing_id": F.col("targetid").isNull()}
    if prefix == "sci":
        out |= {"missing_priority": F.col("priority").isNull(), "bad_exposure_time": F.col("exp_time").isNull() | (F.col("exp_time") <= 0)}
    return out


def design_counts() -> dict[str, Column]:
    """The same for the rows of designs."""
    return {"coordinates_without_target": (F.col("target_idx") == -1) & (F.col("ra").isNotNull() | F.col("dec").isNotNull()),
            "unassigned": F.col("target_idx") == -1}


def visit_counts(most: int) -> dict[str, Column]:
    """The same for pointings, given the most visits that a target needs."""
    return {"too_few_visits": F.coalesce("nvisits", F.lit(1)) * F.coalesce("nrepeats", F.lit(1)) < most, "missing_exposure_time": F.col("exp_time").isNull()}


def write_counted(df: DataFrame, path: str, problems: dict[str, Column]) -> dict[str, int]:
    """Write the rows and return ``n_rows`` and the number of rows with each problem, counted by the job that writes them.

    The counts are metrics of the query: no other scan, and a task that runs
    again is counted once.
    """
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in problems.items()]]
    df.observe(seen, *counts).write.mode("errorifexists").parquet(path)
    return dict(seen.get)


def visit_problems(targets: DataFrame, pointings: DataFrame) -> DataFrame:
    """(problem, pointing_idx, n): pointings that offer too few visits, and unequal exposure times."""
    most = targets.agg(F.max("req_visits")).scalar()
    offered = F.coalesce("nvisits", F.lit(1)) * F.coalesce("nrepeats", F.lit(1))
    few = pointings.where(offered < most).select(F.lit("too few visits").alias("problem"), "pointing_idx", offered.alias("n"))
    uneven = (pointings.agg(F.count_distinct("exp_time").alias("n")).where("n > 1")
              .select(F.lit("unequal exposure times").alias("problem"), F.lit(None).cast("int").alias("pointing_idx"), F.col("n").cast("int").alias("n")))
    return few.unionByName(uneven)


def cost_problems(classes: DataFrame) -> DataFrame:
    """Classes whose partial observation costs less than none at all."""
    return classes.where("partial_observation_cost < non_observation_cost")


def assignment_conflicts(assignments: DataFrame) -> DataFrame:
    """(problem, visit_idx, id, n): a fiber with two targets or a target on two fibers in one visit."""
    def dup(key: str, text: str) -> DataFrame:
        return (assignments.groupBy("visit_idx", F.col(key).cast("bigint").alias("id")).agg(F.count(F.lit(1)).alias("n"))
                .where("n > 1").select(F.lit(text).alias("problem"), "visit_idx", "id", "n"))
    return dup("fiber_id", "fiber with several targets").unionByName(dup("target_idx", "target on several fibers"))


def class_limits(assignments: DataFrame, classes: DataFrame, visits: list[int]) -> DataFrame:
    """Classes outside [min_targets, max_targets]: calibration per visit, others over all visits.

    ``classes``: class, min_targets, max_targets, per_visit.
    """
    total = assignments.groupBy("class").agg(F.count_distinct("target_idx").alias("n")).withColumn("visit_idx", F.lit(-1))
    visit = assignments.groupBy("class", "visit_idx").agg(F.count_distinct("target_idx").alias("n"))
    whole = classes.where("NOT per_visit").join(total, "class", "left").withColumn("visit_idx", F.lit(-1))
    slots = classes.where("per_visit").withColumn("visit_idx", F.explode(F.array(*[F.lit(v) for v in visits])))
    each = slots.join(visit, ["class", "visit_idx"], "left")
    cols = ["class", "visit_idx", F.coalesce("n", F.lit(0)).alias("n"), "min_targets", "max_targets"]
    both = whole.select(*cols).unionByName(each.select(*cols))
    return both.where("n < min_targets OR n > max_targets")


def group_limits(assignments: DataFrame, fibers: DataFrame, group: str, classes: list[str], least: int, most: int,
                 visits: list[int]) -> DataFrame:
    """Fiber groups outside [least, most] targets of the classes, per visit; empty groups count as zero."""
    slots = fibers.select(group).distinct().withColumn("visit_idx", F.explode(F.array(*[F.lit(v) for v in visits])))
    n = (grown_join(assignments.where(F.col("class").isin(classes)), fibers.select("fiber_id", group), "fiber_id")
         .groupBy(group, "visit_idx").agg(F.count(F.lit(1)).alias("n")))
    return (slots.join(n, [group, "visit_idx"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
            .where((F.col("n") < least) | (F.col("n") > most)))


def thin_groups(edges: DataFrame, fibers: DataFrame, group: str, least: int) -> DataFrame:
    """Groups with fewer than three times the wanted number of candidate targets."""
    n = (grown_join(edges, fibers.select("fiber_id", group), "fiber_id").groupBy("pointing_idx", group)
         .agg(F.count_distinct("target_idx").alias("n")))
    return n.where(F.col("n") < 3 * least)


def reserved_fibers(assignments: DataFrame, fibers: DataFrame, reserve: int) -> DataFrame:
    """Visits that leave fewer fibers free than must stay reserved."""
    total = fibers.agg(F.count(F.lit(1))).scalar()
    used = assignments.groupBy("visit_idx").agg(F.count_distinct("fiber_id").alias("used"))
    return used.withColumn("free", total - F.col("used")).where(F.col("free") < reserve)


def over_budget(assignments: DataFrame, budgets: DataFrame, visit_time: float) -> DataFrame:
    """Classes that use more fiber time than their hours allow. ``budgets``: class, hours."""
    used = assignments.groupBy("class").agg((F.count(F.lit(1)) * visit_time).alias("used_sec"))
    return used.join(budgets, "class").where(F.col("used_sec") > F.col("hours") * 3600.0)


def forbidden_used(assignments: DataFrame, targets: DataFrame, pairs: DataFrame) -> DataFrame:
    """Assigned forbidden targets and forbidden pairs observed in one visit: (problem, visit_idx, t1, t2)."""
    a = assignments.select("visit_idx", "target_idx")
    single = a.join(targets.select("target_idx"), "target_idx", "left_semi").select(
        F.lit("forbidden target").alias("problem"), "visit_idx", F.col("target_idx").alias("t1"), F.lit(None).cast("bigint").alias("t2"))
    return single.unionByName(pairs_both_assigned(assignments, pairs).select(
        F.lit("forbidden pair").alias("problem"), "visit_idx", "t1", "t2"))


def pairs_both_assigned(assignments: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs (t1, t2) whose two targets are assigned in the same visit (and pointing, if given)."""
    keys = ["pointing_idx"] if "pointing_idx" in pairs.columns else []
    a = assignments.select("visit_idx", *keys, "target_idx")
    one = pairs.join(a.withColumnRenamed("target_idx", "t1"), ["t1", *keys])
    return one.join(a.withColumnRenamed("target_idx", "t2"), ["t2", "visit_idx", *keys]).select("visit_idx", *keys, "t1", "t2")


def objective(assignments: DataFrame, targets: DataFrame, class_cost: dict[str, float], partial_cost: dict[str, float],
              n_fibers: int, visits: list[int], fiber_cost: float = 0.0, max_visits: int = 1,
              calibration: tuple = (), seen: DataFrame | None = None) -> DataFrame:
    """(term, value) of a given assignment.

    Science targets never observed cost their class's non-observation cost,
    those with missing visits their partial cost per missing visit, and
    observed ones their own ``penalty``, if the column is there. Targets of the
    classes in ``calibration`` cost their class's non-observation cost in every
    visit that could see them (``seen``: visit_idx, target_idx) and doesn't.
    Edges cost their own cost, idle fibers a fixed cost per visit.
    """
    got = assignments.groupBy("target_idx").agg(F.count(F.lit(1)).alias("got"))
    penalty = F.col("penalty") if "penalty" in targets.columns else F.lit(0)
    known = targets.withColumns({"class_cost": class_lookup(class_cost), "partial_cost": class_lookup(partial_cost), "penalty": penalty})
    known = known.where("class_cost IS NOT NULL")
    is_calibration = F.col("class").isin(list(calibration))
    t = known.where(~is_calibration).join(got, "target_idx", "left").withColumn("got", F.coalesce("got", F.lit(0)))
    missing = F.greatest(F.least(F.col("req_visits"), F.lit(max_visits)) - F.col("got"), F.lit(0))
    costs = t.agg(F.sum(F.when(F.col("got") == 0, F.col("class_cost")).otherwise(0)).cast("double").alias("non_observation"),
                  F.sum(F.when(F.col("got") > 0, F.col("partial_cost") * missing).otherwise(0)).cast("double").alias("partial_observation"),
                  F.sum(F.when(F.col("got") > 0, F.col("penalty")).otherwise(0)).cast("double").alias("penalty"))
    edges = assignments.agg(F.coalesce(F.sum("cost"), F.lit(0.0)).alias("edges"),
                            (F.lit(fiber_cost) * (n_fibers * len(visits) - F.count(F.lit(1)))).alias("unassigned_fibers"))
    out = (costs.unpivot([], ["non_observation", "partial_observation", "penalty"], "term", "value")
           .unionByName(edges.unpivot([], ["edges", "unassigned_fibers"], "term", "value")))
    if seen is not None:
        keys = ["visit_idx", "target_idx"]
        missed = seen.select(*keys).distinct().join(assignments.select(*keys), keys, "left_anti")
        cost = missed.join(known.where(is_calibration).select("target_idx", "class_cost"), "target_idx")
        out = out.unionByName(cost.agg(F.coalesce(F.sum("class_cost"), F.lit(0)).cast("double").alias("calibration"))
                              .unpivot([], ["calibration"], "term", "value"))
    return out


def design_problems(design: DataFrame) -> DataFrame:
    """(problem, visit_idx, fiber_id, n): a fiber listed twice, or coordinates on an unassigned fiber."""
    dup = (design.groupBy("visit_idx", "fiber_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
           .select(F.lit("duplicate fiber").alias("problem"), "visit_idx", "fiber_id", "n"))
    stray = design.where((F.col("target_idx") == -1) & (F.col("ra").isNotNull() | F.col("dec").isNotNull())).select(
        F.lit("coordinates without target").alias("problem"), "visit_idx", "fiber_id", F.lit(1).cast("bigint").alias("n"))
    return dup.unionByName(stray)


def coverage_problems(targets_xy: DataFrame, radius: float = 400.0, least: int = 100, extent: float = 190.0) -> DataFrame:
    """Pointings with few targets or targets that do not reach across the focal plane."""
    rr = F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y"))
    s = targets_xy.groupBy("pointing_idx").agg(F.count_if(rr < radius).alias("n"), F.min("x").alias("x_lo"),
                                               F.max("x").alias("x_hi"), F.min("y").alias("y_lo"), F.max("y").alias("y_hi"))
    short = F.least(*[F.abs(F.col(c)) for c in ("x_lo", "x_hi", "y_lo", "y_hi")]) < extent
    return s.withColumns({"few": F.col("n") < least, "short": short}).where("few OR short")


def resolve_collisions(assignments: DataFrame, pairs: DataFrame) -> DataFrame:
    """Unassign the cheaper side of each reported collision (visit_idx, fiber_a, fiber_b).

    ``assignments`` carries class_cost. A fiber without a target is broken or
    parked and stays; then the other one goes. On equal cost the first goes.
    """
    a = assignments.select("visit_idx", "fiber_id", "class_cost")
    both = (pairs.join(a.withColumnsRenamed({"fiber_id": "fiber_a", "class_cost": "ca"}), ["visit_idx", "fiber_a"], "left")
            .join(a.withColumnsRenamed({"fiber_id": "fiber_b", "class_cost": "cb"}), ["visit_idx", "fiber_b"], "left"))
    first = F.col("cb").isNull() | (F.col("ca") <= F.col("cb"))
    loser = F.when(F.col("ca").isNotNull() & first, F.col("fiber_a")).when(F.col("cb").isNotNull(), F.col("fiber_b"))
    gone = both.select("visit_idx", loser.alias("fiber_id")).where("fiber_id IS NOT NULL").distinct()
    return assignments.join(gone, ["visit_idx", "fiber_id"], "left_anti")
