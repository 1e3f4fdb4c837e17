"""Exported lists: repeats, one flux per band, designs and their identifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .blocks import grown_join
from .columns import export_fill, pointing_code, remap_filters
from .ids import hex_id, object_id
from .visits import with_repeats

# Band of each filter and the order of preference of photometric systems.
FILTER_BANDS = {
    "g_ps1": "g", "r_ps1": "r", "i_ps1": "i", "z_ps1": "z", "y_ps1": "y",
    "g_gaia": "r", "bp_gaia": "g", "rp_gaia": "i",
    "g_hsc": "g", "r_hsc": "r", "r2_hsc": "r", "i_hsc": "i", "i2_hsc": "i",
    "g_cfht": "g", "r_cfht": "r", "i_cfht": "i", "z_cfht": "z", "u_cfht": "b", "y_cfht": "y",
}
SYSTEM_RANK = {"ps1": 0, "gaia": 1, "hsc": 2, "cfht": 3}
OTHER_RANK = 100
BANDS = ("b", "g", "r", "i", "z", "y")


def _lookup(mapping: dict, key: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(v) for kv in mapping.items() for v in kv]), key)


def fluxes_by_band(fluxes: Column, filter_map: dict[str, str] | None = None, rank_mapped: bool = False) -> dict[str, Column]:
    """``filter_b, psf_flux_b, psf_flux_error_b`` for every band from one array of fluxes.

    Only finite fluxes of known filters count; the preferred photometric system
    wins and the order of the array breaks ties. The system is read from the
    filter's own name; ``rank_mapped`` reads it from the renamed filter, the
    text after its first underscore.
    """
    filter_map = filter_map or {}
    usable = F.filter(fluxes, lambda f: F.abs(f["psf"]) < float("inf"))      # also leaves out NULL and NaN

    def entry(f: Column, k: Column) -> Column:
        shown = remap_filters(f["filter"], filter_map)
        system = F.get(F.split(shown if rank_mapped else f["filter"], "_"), F.lit(1))
        return F.struct(F.coalesce(_lookup(SYSTEM_RANK, system), F.lit(OTHER_RANK)).alias("rank"), k.alias("k"),
                        _lookup(FILTER_BANDS, f["filter"]).alias("band"), shown.alias("filter"),
                        f["psf"].alias("psf"), f["psf_err"].alias("psf_err"))

    ranked = F.transform(usable, entry)

    def best_of(b: str) -> Column:
        return F.array_min(F.filter(ranked, lambda f: f["band"] == b))

    out = {}
    for b in BANDS:
        best = best_of(b)
        out |= {f"filter_{b}": F.coalesce(best["filter"], F.lit("")), f"psf_flux_{b}": best["psf"],
                f"psf_flux_error_{b}": best["psf_err"]}
    return out


def with_codes(designs: DataFrame, prefix: str, field: str, repeats: bool) -> DataFrame:
    """Pointing code of each design; with repeats one row and code per repeat, else repeat -1."""
    df = with_repeats(designs) if repeats else designs.withColumn("repeat_idx", F.lit(-1))
    return df.withColumn("point_code", pointing_code(prefix, field, F.col("stage"), F.col("pointing_idx"),
                                                   F.col("visit_idx"), F.col("repeat_idx")))


def join_assignments(assignments: DataFrame, merged: DataFrame, key: str = "target_idx") -> DataFrame:
    """Assignments with the merged target columns they do not have yet."""
    new = [c for c in merged.columns if c not in assignments.columns]
    return grown_join(assignments, merged.select(key, *new), key, "left")


def join_catalogs(assignments: DataFrame, catalogs: list[DataFrame], key: str = "targetid") -> DataFrame:
    for cat in catalogs:
        assignments = join_assignments(assignments, cat, key)
    return assignments


def assigned_only(listed: DataFrame, assignments: DataFrame, key: str = "target_idx") -> DataFrame:
    return grown_join(listed, assignments.select(key).distinct(), key, "left_semi")


def with_assigned_count(targets: DataFrame, assignments: DataFrame) -> DataFrame:
    n = assignments.groupBy("target_idx").agg(F.count(F.lit(1)).alias("assigned"))
    return grown_join(targets, n, "target_idx", "left").withColumn("assigned", F.coalesce("assigned", F.lit(0)))


def design_rows(assigned: DataFrame, id_prefix: int) -> DataFrame:
    """Rows of the designs: object id by kind, empty flux arrays instead of NULL, plain defaults."""
    science = F.col("prefix") == "sci"
    return assigned.withColumns({
        "obj_id": F.coalesce(F.when(science, object_id(id_prefix, F.col("target_idx"))).otherwise(F.col("targetid")), F.lit(-1)),
        "tract": F.coalesce("tract", F.lit(-1)), "patch": F.coalesce("patch", F.lit("0,0")),
        "catid": F.coalesce("catid", F.lit(-1)), "fiber_status": F.coalesce("fiber_status", F.lit(-1)),
        "fluxes": F.coalesce("fluxes", F.filter("fluxes", lambda f: F.lit(False)),
                             F.array().cast(assigned.schema["fluxes"].dataType)),
    })


def design_ids(design: DataFrame, keys: list[str]) -> DataFrame:
    """Content hash of each design from its fibers and their positions in milliarcseconds.

    Rows are hashed one by one and added up, so the order does not matter and
    no design has to be gathered in one place.
    """
    def number(text: Column, digits: int) -> Column:
        return F.conv(F.substring(F.md5(text.cast("binary")), 1, digits), 16, 10).cast("bigint")

    mas = [F.coalesce(F.round(F.col(c) * 3.6e6).cast("bigint").cast("string"), F.lit("")) for c in ("ra", "dec")]
    h = number(F.concat_ws("/", F.col("fiber_id").cast("string"), *mas), 13)
    folded = F.sum(h.cast("decimal(38,0)"))
    total = design.groupBy(*keys).agg(folded.alias("_s"), F.count(F.lit(1)).alias("n_fibers"))
    did = number(F.concat_ws("/", F.col("_s").cast("string"), F.col("n_fibers").cast("string")), 15)
    return total.select(*keys, did.alias("design_id"), hex_id(did).alias("design_hex"), "n_fibers")


def export_rows(designs: DataFrame, assigned: DataFrame, id_prefix: int, code: tuple[str, str], filter_map: dict[str, str] | None = None,
                catalog_id: int | None = None, proposal_id: str | None = None, repeats: bool = True) -> DataFrame:
    """All rows of the exported lists, one per (design repeat, assigned target), with type and code.

    ``code`` holds prefix and field of the pointing codes. Repeats are expanded
    behind the join, so a design without targets costs nothing.
    """
    science = F.col("prefix") == "sci"
    d = designs.select("stage", "pointing_idx", "visit_idx", "nrepeats")
    rows = with_codes(grown_join(export_fill(assigned.drop("stage", "nrepeats")), d, ["pointing_idx", "visit_idx"]), *code, repeats)
    cat = F.when(science, F.lit(catalog_id)).otherwise(F.col("catid")) if catalog_id is not None else F.col("catid")
    prop = F.lit(proposal_id) if proposal_id is not None else F.col("proposalid")
    from ..functions.astro import format_epoch
    return rows.select(
        F.col("prefix").alias("target_type"), "point_code",
        F.when(science, object_id(id_prefix, F.col("target_idx"))).otherwise(F.col("targetid")).alias("obj_id"),
        "ra", "dec", "pmra", "pmdec", "parallax", format_epoch(F.col("epoch")).alias("epoch"), "tract", "patch",
        cat.cast("bigint").alias("input_catalog_id"), F.col("obcode").alias("ob_code"), prop.alias("proposal_id"),
        "priority", "prob_f_star", F.col("exp_time").alias("effective_exptime"),
        *[c.alias(n) for n, c in fluxes_by_band(F.col("fluxes"), filter_map).items()],
        "fiber_id", F.col("x").alias("fp_x"), F.col("y").alias("fp_y"))


def pointing_list(designs: DataFrame) -> DataFrame:
    """The list of pointings with local times."""
    from ..functions.astro import iso_seconds, to_local_time
    return designs.select("point_code", F.col("ra").alias("point_ra"), F.col("dec").alias("point_dec"),
                          F.col("posang").alias("point_pa"), "priority", F.col("exp_time").alias("exptime"), "nrepeats",
                          iso_seconds(F.col("obs_time")).alias("obstime"), iso_seconds(to_local_time(F.col("obs_time"))).alias("obstime_local"))
