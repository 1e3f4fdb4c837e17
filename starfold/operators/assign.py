"""Choosing targets for fibers: rankings, picks, groups and conflict-free assignment."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut
from .blocks import grown_join
from .ids import rank_in_groups
from .select import hashed_uniform


def rank_candidates(edges: DataFrame, by: str, column: str | None = None, seed: int = 0, descending: bool | None = None) -> DataFrame:
    """Rank each fiber's candidates: ``brightness`` and ``priority`` rise, ``probability`` falls, ``random`` is hashed."""
    if by == "random":
        edges, column = edges.withColumn("_u", hashed_uniform(F.col("target_idx"), F.lit(seed))), "_u"
    down = by == "probability" if descending is None else descending
    return rank_in_groups(edges, ["pointing_idx", "fiber_id"], column, "target_idx", "rank", down).drop("_u")


def pick_first(edges: DataFrame, order: list[Column]) -> DataFrame:
    """The first candidate of every fiber and pointing in the given order.

    A minimum per fiber, combined before the shuffle; no ranking is needed.
    """
    keys = [c.alias(f"k{i}") for i, c in enumerate(order)]
    best = edges.groupBy("pointing_idx", "fiber_id").agg(F.min(F.struct(*keys, "target_idx")).alias("b"))
    return best.select("pointing_idx", "fiber_id", F.col("b.target_idx").alias("target_idx"))


def with_all_fibers(picks: DataFrame, fibers: DataFrame, pointing_idx: list[int]) -> DataFrame:
    """Add the fibers without a pick, as target -1."""
    slots = fibers.select("fiber_id", F.explode(F.array(*[F.lit(p) for p in pointing_idx])).alias("pointing_idx"))
    return (slots.join(picks, ["pointing_idx", "fiber_id"], "left")
            .withColumn("target_idx", F.coalesce("target_idx", F.lit(-1))))


def pick_over_pointings(edges: DataFrame, pointing_idx: list[int], order: list[Column]) -> DataFrame:
    """Pick pointing by pointing; a target that is taken is no candidate later on.

    A target that two fibers pick goes to the one with the lower id.
    """
    out = None
    for p in pointing_idx:
        left = edges.where(F.col("pointing_idx") == p)
        if out is not None:
            left = left.join(out.select("target_idx"), "target_idx", "left_anti")
        got = pick_first(left, order)
        got = got.groupBy("pointing_idx", "target_idx").agg(F.min("fiber_id").alias("fiber_id")).select(
            "pointing_idx", "fiber_id", "target_idx")
        out = cut(got if out is None else out.unionByName(got))
    return out


SHORT = 32        # candidates that a fiber is given at a time


def _shortlist(edges: DataFrame, most: int | None) -> DataFrame:
    """The first candidates of each fiber in the order of its wishes; all of them if ``most`` is None.

    The limit is applied before the shuffle as well, so only short lists move.
    Edges without a fiber or visit are no list and all stay.
    """
    if most is None:
        return cut(edges.withColumn("_n", F.lit(0)))
    loose = F.when(F.col("fiber_id").isNull() | F.col("visit_idx").isNull(), F.col("target_idx"))
    order = Window.partitionBy("visit_idx", "fiber_id", loose).orderBy(-F.col("class_cost"), "cost", "target_idx")
    return cut(edges.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= most))


def assign_visit(edges: DataFrame, groups: DataFrame | None = None, most: int | None = None, taken: DataFrame | None = None) -> DataFrame:
    """Conflict-free pairs of one visit from edges (visit_idx, fiber_id, target_idx, class_cost, cost).

    Every round each free fiber names its best free target (highest class cost,
    lowest edge cost, id); a target named by several goes to the cheapest
    fiber. Rounds go on until no edge is left between a free fiber and a free
    target, so no pair could still be added. Each round settles at least one.

    Fibers look at short lists of their best candidates. The first target that is
    left on a list is the best one left at all, so lists change nothing; when one
    that was cut short runs out, new and longer ones are made of what is free.

    ``groups`` (fiber_id, grp) and ``most`` bound the pairs of each fiber group
    in a visit; of a round's pairs the cheapest come first, and a full group's
    fibers leave. A group has the size of the instrument at most. ``taken``
    (target_idx) are no candidates.
    """
    done, at, size = None, ["visit_idx", "fiber_id"], SHORT
    edges = edges.select(*at, "target_idx", "class_cost", "cost")

    def free(df: DataFrame) -> DataFrame:
        if taken is not None:
            df = df.join(taken, "target_idx", "left_anti")
        if done is None:
            return df
        df = (df.join(done.select(*at), at, "left_anti").join(done.select("visit_idx", "target_idx"), ["visit_idx", "target_idx"], "left_anti"))
        return df if groups is None else df.join(full_groups(), at, "left_anti")

    def full_groups() -> DataFrame:
        return grown_join(_group_use(done, groups).where(F.col("used") >= most), groups, "grp").select(*at)

    def listed(df: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        """Short lists and the fibers that may have more than is on theirs, if there are any."""
        got = _shortlist(df, size)
        cropped = got.where(F.col("_n") == (-1 if size is None else size)).select(*at).dropna().distinct()
        return got, None if cropped.isEmpty() else cut(cropped)

    def ran_out() -> bool:
        out = cropped.join(left.select(*at), at, "left_anti")
        if done is not None:
            out = out.join(done.select(*at), at, "left_anti")
            out = out if groups is None else out.join(full_groups(), at, "left_anti")
        return not out.isEmpty()

    left, cropped = listed(edges)
    left = left if taken is None else cut(free(left))
    while True:
        if cropped is not None and ran_out():
            size = None if size * 4 > 1000 else size * 4      # up to there the engine limits before the shuffle
            left, cropped = listed(free(edges))
        if left.isEmpty():
            break
        wish = (left.groupBy("visit_idx", "fiber_id")
                .agg(F.min(F.struct((-F.col("class_cost")).alias("c"), "cost", "target_idx")).alias("b"))
                .select("visit_idx", "fiber_id", F.col("b.target_idx").alias("target_idx"), F.col("b.cost").alias("cost")))
        won = (wish.groupBy("visit_idx", "target_idx").agg(F.min(F.struct("cost", "fiber_id")).alias("b"))
               .select("visit_idx", F.col("b.fiber_id").alias("fiber_id"), "target_idx", F.col("b.cost").alias("cost")))
        if groups is not None:
            order = Window.partitionBy("visit_idx", "grp").orderBy("cost", "fiber_id")
            used = _group_use(done, groups) if done is not None else None
            won = grown_join(won, groups, "fiber_id", "left").withColumn("_n", F.row_number().over(order))
            won = won.join(used, ["visit_idx", "grp"], "left") if used is not None else won.withColumn("used", F.lit(0))
            won = won.where(F.col("grp").isNull() | (F.col("_n") + F.coalesce("used", F.lit(0)) <= most)).select("visit_idx", "fiber_id", "target_idx", "cost")
        won = cut(won)
        done = won if done is None else done.unionByName(won)
        left = (left.join(won.select("visit_idx", "fiber_id"), ["visit_idx", "fiber_id"], "left_anti")
                .join(won.select("visit_idx", "target_idx"), ["visit_idx", "target_idx"], "left_anti"))
        if groups is not None:
            left = left.join(full_groups(), at, "left_anti")
        left = cut(left)
    return done if done is not None else left.select("visit_idx", "fiber_id", "target_idx", "cost")


def _group_use(done: DataFrame, groups: DataFrame) -> DataFrame:
    return grown_join(done, groups, "fiber_id").groupBy("visit_idx", "grp").agg(F.count(F.lit(1)).alias("used"))


def short_groups(assigned: DataFrame, groups: DataFrame, visits: list[int], least: int) -> DataFrame:
    """(visit_idx, grp, used) of the fiber groups below their minimum, empty ones included."""
    every = groups.select("grp").distinct().withColumn("visit_idx", F.explode(F.array(*[F.lit(v) for v in visits])))
    return (every.join(_group_use(assigned, groups), ["visit_idx", "grp"], "left").withColumn("used", F.coalesce("used", F.lit(0)))
            .where(F.col("used") < least).select("visit_idx", "grp", "used"))


def _groups_and_visits(edges: DataFrame, groups: DataFrame) -> DataFrame:
    """(grp, visit_idx) of every group, also without a pair, in every visit of the plan (a literal of some tens)."""
    visits = sorted(r.visit_idx for r in edges.select("visit_idx").distinct().collect())
    return groups.select("grp").distinct().withColumn("visit_idx", F.explode(F.array(*[F.lit(v) for v in visits]).cast("array<int>")))


def fill_short_groups(assigned: DataFrame, edges: DataFrame, groups: DataFrame, least: int) -> DataFrame:
    """``assigned`` pairs (visit_idx, fiber_id, target_idx, cost) with fiber groups brought up to ``least`` pairs per visit where a short path allows it.

    A free fiber of a short group takes a free target; or one from the fiber
    that has it, and that fiber takes a free target of its own (an alternating
    path of three edges, which adds a pair) or goes without if its group has
    pairs to spare.
    Every round carries out paths that touch different fibers and targets,
    cheapest first, no more than a group lacks or can spare; no group falls
    below its minimum, no target is lost to a fiber that is not its own. Rounds
    end when no such path is left; each lowers the number of missing pairs.
    """
    pair = ["visit_idx", "fiber_id", "target_idx", "cost"]
    edges = cut(grown_join(edges.select(*pair), groups, "fiber_id", "left"))
    assigned = cut(assigned.select(*pair))
    every = cut(_groups_and_visits(edges, groups))
    while True:
        held = grown_join(assigned, groups, "fiber_id", "left")
        use = (every.join(held.groupBy("visit_idx", "grp").agg(F.count(F.lit(1)).alias("used")), ["visit_idx", "grp"], "left")
               .select("visit_idx", "grp", F.coalesce("used", F.lit(0)).alias("used")))
        lacking = use.where(F.col("used") < least).select("visit_idx", "grp", (least - F.col("used")).alias("lack"))
        spare = use.where(F.col("used") > least).select("visit_idx", F.col("grp").alias("o_grp"), (F.col("used") - least).alias("spare"))
        free = edges.join(lacking, ["visit_idx", "grp"]).join(assigned.select("visit_idx", "fiber_id"), ["visit_idx", "fiber_id"], "left_anti")
        owner = held.select("visit_idx", "target_idx", F.col("fiber_id").alias("o_fiber"), F.col("grp").alias("o_grp"))
        other = (edges.join(assigned.select("visit_idx", "target_idx"), ["visit_idx", "target_idx"], "left_anti").groupBy("visit_idx", F.col("fiber_id").alias("o_fiber"))
                 .agg(F.min(F.struct(F.col("cost").alias("new_cost"), F.col("target_idx").alias("new_target"))).alias("o")))
        paths = (free.join(owner, ["visit_idx", "target_idx"], "left").join(other, ["visit_idx", "o_fiber"], "left").join(spare, ["visit_idx", "o_grp"], "left")
                 .where(F.col("o").isNotNull() | (F.col("spare") > 0) & ~F.col("o_grp").eqNullSafe(F.col("grp")) | F.col("o_grp").isNull()))
        paths = paths.select("visit_idx", "fiber_id", "target_idx", "cost", "grp", "lack", "o_fiber", "o_grp", "spare", F.col("o.new_target").alias("new_target"), F.col("o.new_cost").alias("new_cost"))
        rank = F.struct((F.col("o_fiber").isNotNull() & F.col("new_target").isNull()).alias("gone"), (F.col("cost") + F.coalesce("new_cost", F.lit(0.0))).alias("price"), "fiber_id", "target_idx")

        def best(df: DataFrame, *keys: str) -> DataFrame:
            names = [c for c in df.columns if c not in keys]
            return df.groupBy(*keys).agg(F.min(F.struct(rank.alias("_r"), *names)).alias("_m")).select(*keys, *[F.col(f"_m.{c}").alias(c) for c in names])

        moves = best(best(paths, "visit_idx", "fiber_id"), "visit_idx", "target_idx")
        simple = moves.where("o_fiber IS NULL").select("visit_idx", F.col("target_idx").alias("new_target"))
        swaps = best(moves.where("new_target IS NOT NULL").join(simple, ["visit_idx", "new_target"], "left_anti"), "visit_idx", "new_target")
        moves = swaps.select(*moves.columns).unionByName(moves.where("new_target IS NULL"))
        # a group gains no more than it lacks and gives no more than it has to spare; groups have the size of the instrument
        nth = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy(rank))
        moves = moves.withColumn("_n", nth("visit_idx", "grp")).where("_n <= lack")
        moves = moves.withColumn("_n", nth("visit_idx", "o_grp", F.col("new_target").isNull())).where("new_target IS NOT NULL OR o_grp IS NULL OR _n <= spare").drop("_n")
        moves = cut(moves)
        if moves.isEmpty():
            return assigned
        kept = assigned.join(moves.select("visit_idx", "target_idx"), ["visit_idx", "target_idx"], "left_anti").select(*pair)
        again = moves.where("new_target IS NOT NULL").select("visit_idx", F.col("o_fiber").alias("fiber_id"), F.col("new_target").alias("target_idx"), F.col("new_cost").alias("cost"))
        assigned = cut(kept.unionByName(moves.select(*pair)).unionByName(again))


def group_faults(assigned: DataFrame, edges: DataFrame, groups: DataFrame, least: int) -> DataFrame:
    """(visit_idx, grp, twice, strange, fixable) of every group and visit: fibers or targets used twice, pairs that are no edge, paths left for a short group."""
    every = _groups_and_visits(edges, groups)
    held = grown_join(assigned, groups, "fiber_id")
    twice = (held.groupBy("visit_idx", "grp").agg((F.count(F.lit(1)) - F.count_distinct("fiber_id")).alias("a"))
             .join(held.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("visit_idx", "target_idx"))).groupBy("visit_idx", "grp").agg(F.count_if(F.col("n") > 1).alias("b")), ["visit_idx", "grp"])
             .select("visit_idx", "grp", (F.col("a") + F.col("b")).alias("twice")))
    strange = held.join(edges, ["visit_idx", "fiber_id", "target_idx"], "left_anti").groupBy("visit_idx", "grp").agg(F.count(F.lit(1)).alias("strange"))
    use = held.groupBy("visit_idx", "grp").agg(F.count(F.lit(1)).alias("used"))
    short = every.join(use, ["visit_idx", "grp"], "left").where(F.coalesce("used", F.lit(0)) < least).select("visit_idx", "grp")
    rest = edges.join(assigned.select("visit_idx", "target_idx"), ["visit_idx", "target_idx"], "left_anti").select("visit_idx", F.col("fiber_id").alias("o_fiber")).distinct()
    begin = grown_join(edges, groups, "fiber_id").join(short, ["visit_idx", "grp"]).join(assigned.select("visit_idx", "fiber_id"), ["visit_idx", "fiber_id"], "left_anti")
    owner = held.select("visit_idx", "target_idx", F.col("fiber_id").alias("o_fiber"))
    fixable = begin.join(owner, ["visit_idx", "target_idx"]).join(rest, ["visit_idx", "o_fiber"], "left_semi").groupBy("visit_idx", "grp").agg(F.count(F.lit(1)).alias("fixable"))
    for t in (twice, strange, fixable):
        every = every.join(t, ["visit_idx", "grp"], "left")
    return every.select("visit_idx", "grp", *[F.coalesce(n, F.lit(0)).cast("int").alias(n) for n in ("twice", "strange", "fixable")])


def shared_pointings(edges: DataFrame) -> set[tuple[int, int]]:
    """Pairs of pointings with a target in common, each both ways: the conflict graph of the survey plan.

    Targets are reduced to the distinct sets of pointings that see them; only
    pairs of pointings reach the driver.
    """
    sets = edges.groupBy("target_idx").agg(F.sort_array(F.collect_set("pointing_idx")).alias("s")).where(F.size("s") > 1).select("s").distinct()
    pairs = sets.withColumn("a", F.explode("s")).withColumn("b", F.explode("s")).where("a <> b").select("a", "b").distinct()
    return {(r.a, r.b) for r in pairs.collect()}


def waves(visits: list[dict], shared: set[tuple[int, int]]) -> list[list[dict]]:
    """Visits that can be assigned side by side: a visit comes after the last earlier one it shares targets with.

    The number of waves is the longest chain of visits that depend on each
    other, however many visits there are.
    """
    rank: list[int] = []
    for v in visits:
        p = v["pointing_idx"]
        rank.append(1 + max((rank[k] for k, u in enumerate(visits[:len(rank)]) if u["pointing_idx"] == p or (u["pointing_idx"], p) in shared), default=-1))
    return [[v for v, r in zip(visits, rank) if r == w] for w in range(max(rank, default=-1) + 1)]


def assign_visits(edges: DataFrame, visits: list[dict], required: DataFrame, groups: DataFrame | None = None,
                  most: int | None = None, least: int | None = None) -> DataFrame:
    """Assign visits in their order until each target has its required visits; ``groups`` and ``most`` as in ``assign_visit``, ``least`` as in ``fill_short_groups``.

    ``edges`` is per pointing; ``required`` holds target_idx and the visits it
    still needs (targets that are not listed need one). Visits whose pointings
    share no target run together, in ``waves``; the result is that of one visit
    after the other.
    """
    done = None
    for wave in waves(visits, shared_pointings(edges)):
        visit = F.create_map(*[F.lit(x) for v in wave for x in (v["pointing_idx"], v["visit_idx"])])
        repeats = F.create_map(*[F.lit(x) for v in wave for x in (v["visit_idx"], int(v.get("nrepeats") or 1))])
        e = edges.where(F.col("pointing_idx").isin([v["pointing_idx"] for v in wave])).withColumn("visit_idx", F.element_at(visit, F.col("pointing_idx")))
        full = None
        if done is not None:
            got = done.groupBy("target_idx").agg(F.sum("n").alias("got"))
            full = got.join(required, "target_idx", "left").where(F.col("got") >= F.coalesce("req_visits", F.lit(1)))
            full = cut(full.select("target_idx"))
        mine = assign_visit(e, groups if most is not None else None, most, full)
        if groups is not None and least is not None:
            mine = fill_short_groups(mine, e if full is None else e.join(full, "target_idx", "left_anti"), groups, least)
        mine = mine.withColumn("n", F.element_at(repeats, F.col("visit_idx")))
        done = mine if done is None else cut(done.unionByName(mine))
    if done is None:
        return edges.select(F.lit(0).alias("visit_idx"), "fiber_id", "target_idx", "cost", F.lit(1).alias("n")).limit(0)
    return done


def limit_per_group(df: DataFrame, keys: list[str], value: str, tie: str, most: int) -> DataFrame:
    """At most ``most`` rows per group, best first (a quota, not a sample)."""
    return rank_in_groups(df, keys, value, tie, "_rank").where(F.col("_rank") <= most).drop("_rank")


# --- fiber groups; these tables have the size of the instrument -------------

def slit_groups(fibers: DataFrame, groups: int = 8) -> DataFrame:
    """Label fibers along the slit: equal groups within each spectrograph."""
    w = Window.partitionBy("spectrograph_id")
    i = F.row_number().over(w.orderBy("fiber_id")) - 1
    n = F.count(F.lit(1)).over(w)
    return fibers.withColumn("slit_group", (F.floor(i / n * groups) + (F.col("spectrograph_id") - 1) * groups).cast("int"))


def ring_seeds(rings=((1, 0.0, 0.0), (6, 100.0, 15.0), (13, 175.0, -15.0))) -> list[tuple[float, float]]:
    """Seed points on rings of (count, radius, first angle in degrees)."""
    out = []
    for n, radius, first in rings:
        out += [(radius * math.cos(math.radians(360.0 * k / n + first)), radius * math.sin(math.radians(360.0 * k / n + first)))
                for k in range(n)]
    return out


def nearest_seed(fibers: DataFrame, seeds: list[tuple[float, float]], name: str = "location_group") -> DataFrame:
    """Label each fiber with the number of its closest seed; seeds are a short literal."""
    items = F.array(*[F.struct(F.pow(F.col("cx") - x, F.lit(2.0)) + F.pow(F.col("cy") - y, F.lit(2.0)), F.lit(k)) for k, (x, y) in enumerate(seeds)])
    return fibers.withColumn(name, F.array_min(items)["col2"])


def ring_sectors(fibers: DataFrame, sectors: int = 6, radii: tuple[float, ...] = (150.0, 240.0), core: float = 60.0,
                 name: str = "sector_group") -> DataFrame:
    """Label fibers by sector and ring, with one more label for the core."""
    rr = F.sqrt(F.col("cx") * F.col("cx") + F.col("cy") * F.col("cy"))
    angle = F.atan2("cy", "cx")
    sector = F.floor((angle + math.pi) / (2 * math.pi / sectors)).cast("int")
    ring = sum((F.when(rr >= edge, 1).otherwise(0) for edge in radii), F.lit(0))
    labelled = fibers.withColumns({"_l": F.lit(len(radii)) * sector + ring, "_r": rr})
    top = labelled.agg(F.max("_l")).scalar()
    return labelled.withColumn(name, F.when(F.col("_r") < core, top + 1).otherwise(F.col("_l"))).drop("_l", "_r")
