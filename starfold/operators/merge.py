"""Unified targets: normalising lists, ordered merge with update rules, catalogs across lists."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.astro import parse_epoch, separation_arcsec
from ..functions.nulls import is_true
from ..functions.photometry import njy_err_to_ab, njy_to_ab
from ..session import checkpoint_dir, cut
from .blocks import grown_join
from .columns import class_label
from .ids import dense_id, object_id
from .zonejoin import add_to_index, match_one_to_one, read_index

# The unified target table (name, type), in order.
TARGET_SCHEMA = (("key", "string"), ("targetid", "bigint"), ("RA", "double"), ("Dec", "double"), ("prefix", "string"),
                 ("epoch", "double"), ("pm", "double"), ("pmra", "double"), ("pmdec", "double"), ("parallax", "double"),
                 ("rv", "double"), ("penalty", "int"), ("exp_time", "double"), ("priority", "double"), ("class", "string"),
                 ("non_observation_cost", "int"))
# Id columns in the order they are looked for.
ID_COLUMNS = ("targetid", "objid", "skyid")


@dataclass(frozen=True)
class TargetList:
    """One input of the merge; ``prefix`` is cal, sci or sky."""

    key: str
    prefix: str
    data: DataFrame
    radius_arcsec: float | None = None


def unify(df: DataFrame, key: str, prefix: str, exp_time: float | None = None, priority: float | None = None,
          penalty: int | None = None, non_observation_cost: int | None = None, mask: Column | None = None,
          class_costs: dict[str, int] | None = None) -> DataFrame:
    """Any list in the unified schema.

    Values given in the call go before the list's own, but exposure times and
    priorities belong to science lists only. The class is made from prefix and
    priority, whatever the list says; a science row without priority has none.
    A list without epochs has NULL there. Proper motion counts only if the list
    has both components. A list without costs gets the cost of the class from
    ``class_costs``, where a class that isn't listed is an error; without
    ``class_costs`` it is 0.
    """
    if mask is not None:
        df = df.where(mask)
    have = set(df.columns)
    ids = [c for c in ID_COLUMNS if c in have]
    if not ids:
        raise ValueError(f"list {key}: no id column out of {ID_COLUMNS}")

    def own(name: str, given=None, fallback=None) -> Column:
        return F.lit(given) if given is not None else F.col(name) if name in have else F.lit(fallback)

    science = prefix == "sci"
    ra, dec = ("RA", "Dec") if "RA" in have else ("ra", "dec")
    epoch = own("epoch")
    if "epoch" in have and df.schema["epoch"].dataType.typeName() == "string":
        epoch = parse_epoch(F.col("epoch"))
    prio = (own("priority", priority) if science else F.lit(None)).cast("double")
    motion = {c: F.col(c) if {"pmra", "pmdec"} <= have else F.lit(None) for c in ("pmra", "pmdec")}
    label = class_label(F.lit(prefix), prio)
    if science:
        label = F.when(prio.isNotNull(), label)
    cost = own("non_observation_cost", non_observation_cost, 0)
    if non_observation_cost is None and "non_observation_cost" not in have and class_costs is not None:
        listed = F.element_at(F.create_map(*[F.lit(v) for kv in class_costs.items() for v in kv]), label)
        unknown = F.raise_error(F.concat(F.lit(f"list {key}: no cost for class "), label))
        cost = F.when(label.isNull(), F.lit(0)).otherwise(F.coalesce(listed, unknown.cast("int")))
    values = {"key": F.lit(key), "targetid": F.col(ids[0]), "RA": F.col(ra), "Dec": F.col(dec), "prefix": F.lit(prefix),
              "epoch": epoch, "pm": own("pm"), **motion, "parallax": own("parallax"),
              "rv": own("rv"), "penalty": own("penalty", penalty, 0), "exp_time": own("exp_time", exp_time) if science else F.lit(None),
              "priority": prio, "class": label, "non_observation_cost": cost}
    return df.select(*[values[n].cast(t).alias(n) for n, t in TARGET_SCHEMA])


def update_targets(accepted: DataFrame, found: DataFrame, prefix: str) -> DataFrame:
    """Update accepted targets from their matched list rows.

    ``found`` holds ``target_idx`` (one row per target) and the unified columns
    of the match. Position and id never change. Epoch, motion and parallax move
    together, and only where the target has no motion yet. Science lists raise
    exposure time and cost and lower the priority; a science target then gets
    the class of its new priority, a calibration target keeps its class.
    """
    names = ["epoch", "pm", "pmra", "pmdec", "parallax", "exp_time", "priority", "non_observation_cost"]
    m = found.select("target_idx", F.lit(True).alias("_hit"), *[F.col(n).alias(f"n_{n}") for n in names])
    df = accepted.join(m, "target_idx", "left")
    hit = F.coalesce("_hit", F.lit(False))
    no_motion = hit & F.col("pm").isNull() & (F.col("pmra").isNull() | F.col("pmdec").isNull())
    new = {n: F.when(no_motion, F.col(f"n_{n}")).otherwise(F.col(n)) for n in ("pm", "pmra", "pmdec", "parallax")}
    new["epoch"] = F.when(no_motion, F.coalesce("n_epoch", "epoch")).otherwise(F.col("epoch"))       # a list without epochs takes none away
    if prefix == "sci":
        lower = hit & (F.col("priority").isNull() | is_true(F.col("n_priority") < F.col("priority")))
        prio = F.when(lower, F.col("n_priority")).otherwise(F.col("priority"))
        relabel = lower & F.col("n_priority").isNotNull() & (F.col("prefix") == "sci")
        new |= {"exp_time": F.when(hit, F.greatest("exp_time", "n_exp_time")).otherwise(F.col("exp_time")),
                "priority": prio,
                "class": F.when(relabel, class_label(F.col("prefix"), F.col("n_priority"))).otherwise(F.col("class")),
                "non_observation_cost": F.when(hit, F.greatest("non_observation_cost", "n_non_observation_cost"))
                .otherwise(F.col("non_observation_cost"))}
    return df.withColumns(new).drop("_hit", *[f"n_{n}" for n in names])


def append_targets(accepted: DataFrame | None, rows: DataFrame, start: int) -> DataFrame:
    """Append rows with the next dense ``target_idx`` values, in the order of their target ids."""
    numbered = dense_id(rows, "targetid", "target_idx", start)
    return numbered if accepted is None else accepted.unionByName(numbered)


_UPDATED = ("epoch", "pm", "pmra", "pmdec", "parallax", "exp_time", "priority", "class", "non_observation_cost")


def fold_updates(targets: DataFrame, log: DataFrame) -> DataFrame:
    """Targets after all updates of ``log``, in the order of its ``list_rank``; the same rules as ``update_targets``.

    ``log`` holds target_idx, list_rank, list_prefix and the unified columns of
    the matched rows. An entry's epoch and motion count up to the first one with
    a motion, the last of these wins. Times and costs are raised to the largest
    and priorities lowered to the smallest one, so their order doesn't matter.
    """
    names = [n for n in _UPDATED if n != "class"]
    order = Window.partitionBy("target_idx").orderBy("_at")
    at = F.struct("list_rank", "list_prefix", *names)
    moves = F.col("pm").isNotNull() | (F.col("pmra").isNotNull() & F.col("pmdec").isNotNull())
    entries = log.select("target_idx", at.alias("_at"), moves.alias("_moves")).withColumn(
        "_late", F.max("_moves").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    early, science = ~F.coalesce("_late", F.lit(False)), F.col("_at.list_prefix") == "sci"
    found = entries.groupBy("target_idx").agg(
        F.max(F.when(early, F.col("_at"))).alias("_last"), F.max(F.when(early & F.col("_at.epoch").isNotNull(), F.col("_at"))).alias("_dated"),
        *[F.max(F.when(science, F.col(f"_at.{n}"))).alias(f"_{n}") for n in ("exp_time", "non_observation_cost")],
        F.min(F.when(science, F.col("_at.priority"))).alias("_priority"))
    still = F.col("_last").isNotNull() & F.col("pm").isNull() & (F.col("pmra").isNull() | F.col("pmdec").isNull())
    lower = F.col("_priority").isNotNull() & (F.col("priority").isNull() | (F.col("_priority") < F.col("priority")))
    new = {n: F.when(still, F.col("_last")[n]).otherwise(F.col(n)) for n in ("pm", "pmra", "pmdec", "parallax")}
    new["epoch"] = F.when(still, F.coalesce(F.col("_dated.epoch"), F.col("epoch"))).otherwise(F.col("epoch"))
    new |= {n: F.greatest(n, f"_{n}") for n in ("exp_time", "non_observation_cost")}
    new["priority"] = F.when(lower, F.col("_priority")).otherwise(F.col("priority"))
    new["class"] = F.when(lower & (F.col("prefix") == "sci"), class_label(F.col("prefix"), F.col("_priority"))).otherwise(F.col("class"))
    return grown_join(targets, found, "target_idx", "left").withColumns(new).select(*targets.columns)


def merge_lists(lists: list[TargetList], id_prefix: int = 0, radius_arcsec: float = 0.1,
                class_costs: dict[str, int] | None = None) -> tuple[DataFrame, DataFrame]:
    """Merge lists into one target table; calibration first, then science, then sky.

    Each list is matched with everything accepted before it. Target ids must be
    unique within a list. Returns the targets and the links (key, targetid,
    target_idx, objid) of every input row.

    Positions never change, so lists are matched with ids and positions alone.
    These are kept in an index partitioned by cell of the sky, to which a list
    adds its new targets and of which it reads only the cells it touches. What
    a list updates is folded in one pass at the end, so the work for a list
    grows with the list and not with the table.
    """
    ordered = [x for p in ("cal", "sci", "sky") for x in lists if x.prefix == p]
    parts, log, links, count = [], None, None, 0
    index = f"{checkpoint_dir(lists[0].data.sparkSession)}/positions-{uuid.uuid4().hex}"
    radii = [x.radius_arcsec or radius_arcsec for x in ordered]
    for rank, x in enumerate(ordered):
        rows = cut(unify(x.data, x.key, x.prefix, class_costs=class_costs))
        new, mine = rows, None
        if parts and x.prefix != "sky":
            known = read_index(rows, index, "target_idx", radii[rank], ("RA", "Dec"), ("RA", "Dec"))
            mine = cut(match_one_to_one(rows, known, radii[rank], "targetid", "target_idx",
                                        left_pos=("RA", "Dec"), right_pos=("RA", "Dec"))
                       .select(F.col("left_id").alias("targetid"), F.col("right_id").alias("target_idx")))
            new = rows.join(mine.select("targetid"), "targetid", "left_anti").select(*rows.columns)
            entry = rows.join(mine, "targetid").select("target_idx", F.lit(rank).alias("list_rank"), F.lit(x.prefix).alias("list_prefix"), *_UPDATED)
            log = entry if log is None else log.unionByName(entry)
        appended = dense_id(new, "targetid", "target_idx", count)
        count += appended.count()
        parts.append(appended)
        if any(y.prefix != "sky" for y in ordered[rank + 1:]):
            add_to_index(appended, index, "target_idx", ("RA", "Dec"))
        got = appended.select("targetid", "target_idx")
        got = got if mine is None else got.unionByName(mine)
        objid = object_id(id_prefix, F.col("target_idx")) if x.prefix == "sci" else F.col("targetid")
        got = got.select(F.lit(x.key).alias("key"), "targetid", "target_idx", objid.alias("objid"))
        links = got if links is None else links.unionByName(got)
    accepted = reduce(DataFrame.unionByName, parts)
    return (accepted if log is None else fold_updates(accepted, log)), links


def accumulate_visits(targets: DataFrame, assignments: DataFrame, visits: DataFrame) -> DataFrame:
    """Add the repeats of every visit a target was assigned in to its ``done_visits``."""
    n = (grown_join(assignments, visits.select("visit_idx", "nrepeats"), "visit_idx").groupBy("target_idx")
         .agg(F.sum("nrepeats").alias("_n")))
    done = F.col("done_visits") if "done_visits" in targets.columns else F.lit(0)
    return (grown_join(targets, n, "target_idx", "left")
            .withColumn("done_visits", (done + F.coalesce("_n", F.lit(0))).cast("int")).drop("_n"))


def merge_flux_lists(photometry: DataFrame, key: str = "target_idx") -> DataFrame:
    """One flux array per target: the first list that has a filter supplies it.

    ``photometry`` is long: key, list_rank, pos, filter and the flux columns.
    """
    values = [c for c in photometry.columns if c not in (key, "list_rank", "pos", "filter")]
    first = photometry.groupBy(key, "filter").agg(F.min(F.struct("list_rank", "pos", *values)).alias("v"))
    # a target has one entry per filter of the survey, so the array is short
    ordered = first.groupBy(key).agg(F.array_sort(F.collect_list(
        F.struct("v.list_rank", "v.pos", "filter", *[F.col(f"v.{c}").alias(c) for c in values]))).alias("a"))
    return ordered.select(key, F.transform("a", lambda s: F.struct(
        s["filter"].alias("filter"), *[s[c].alias(c) for c in values])).alias("fluxes"))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def close_matches(targets: DataFrame, listed: DataFrame, radius_arcsec: float = 0.1) -> DataFrame:
    """Rows of one list joined to its targets where the positions agree."""
    l = listed.select("target_idx", F.col("targetid").alias("list_targetid"), F.col("RA").alias("list_RA"),
                      F.col("Dec").alias("list_Dec"))
    sep = separation_arcsec(F.col("RA"), F.col("Dec"), F.col("list_RA"), F.col("list_Dec"))
    return targets.join(l, "target_idx").where(sep <= radius_arcsec)


def wide_magnitudes(photometry: DataFrame, filters: list[str], skip_nulls: bool = False) -> DataFrame:
    """One row per target with ``{filter}_mag`` and ``{filter}_mag_err``.

    ``photometry`` is long: target_idx, list_rank, filter, kind_rank, mag,
    mag_err, flux, flux_err. The first list that has the filter wins, even if
    its value is missing (unless ``skip_nulls``); within a list the first kind
    wins, and a magnitude goes before a flux.
    """
    mag = F.coalesce("mag", njy_to_ab(F.col("flux")))
    err = F.when(F.col("mag").isNotNull(), F.col("mag_err")).otherwise(njy_err_to_ab(F.col("flux"), F.col("flux_err")))
    p = photometry.select("target_idx", "list_rank", "kind_rank", "filter", mag.alias("m"), err.alias("e"))
    if skip_nulls:
        p = p.where("m IS NOT NULL")
    best = (p.groupBy("target_idx", "filter").agg(F.min(F.struct("list_rank", "kind_rank", "m", "e")).alias("v"))
            .select("target_idx", "filter", F.col("v.m").alias("mag"), F.col("v.e").alias("mag_err")))
    wide = best.groupBy("target_idx").pivot("filter", filters).agg(F.first("mag").alias("mag"), F.first("mag_err").alias("mag_err"))
    return wide
