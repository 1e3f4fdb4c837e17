import pytest
from pyspark.sql import functions as F

from starfold.operators import columns as col, pmap as pm, rules as ru, select as sel


def test_later_rules_overwrite(spark):
    df = spark.createDataFrame([(1, 0.9), (2, 0.5), (3, None)], "id int, p double")
    rules = [ru.Rule("a", "p > 0.4", 1), ru.Rule("b", "priority = 1 AND p > 0.8", 2), ru.Rule("c", "p IS NULL", 9)]
    assert {x.id: x.priority for x in ru.apply_rules(df, rules).collect()} == {1: 2.0, 2: 1.0, 3: 9.0}


def test_blue_stars_enter_before_the_magnitude_cut(spark):
    cuts = sel.FIELD_CUTS["ursaminor"]
    df = spark.createDataFrame([(1, 20.0, -0.3, 0.0), (2, 25.0, -0.3, 0.0), (3, 20.0, 0.3, 0.0)], "id int, g double, gi double, gn double")
    picked = df.where(sel.field_selection(cuts, F.col("g"), F.col("gi"), F.col("gn"), blue=True))
    assert sorted(x.id for x in picked.collect()) == [1, 3]


def test_cone_and_clusters(spark):
    cuts = sel.FIELD_CUTS["sextans"]
    df = spark.createDataFrame([(1, 153.26, -1.6), (2, 153.26, 0.88), (3, 153.26, 0.89), (4, 150.7, -1.6), (5, None, None)], "id int, ra double, dec double")
    mags = [F.lit(x) for x in (20.0, 0.3, 0.0)]
    picked = df.where(sel.field_selection(cuts, *mags, i=F.lit(19.7), pos=(F.col("ra"), F.col("dec"))))
    assert sorted(x.id for x in picked.collect()) == [1, 2]
    assert df.where(sel.field_selection(cuts, *mags, i=F.lit(19.7))).count() == 5
    with pytest.raises(ValueError):
        sel.field_selection(sel.FIELD_CUTS["cluster"], *mags[:2], blue=True)


def test_class_labels(spark):
    df = spark.createDataFrame([("sci", 2.0), ("sci", 2.1), ("cal", None), ("sky", 1.0)], "prefix string, p double")
    got = [x[0] for x in df.select(col.class_label(F.col("prefix"), F.col("p"))).collect()]
    assert got == ["sci_P2", "sci_P2.1", "cal", "sky"]


def test_extra_column_takes_one_kind_only():
    with pytest.raises(ValueError):
        col.ExtraColumn("x", constant=1, pattern="a").kind()


def test_last_bin_is_closed(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (1.0,), (1.1,)], "x double")
    got = [x[0] for x in df.select(pm.bin_of(F.col("x"), 0.0, 1.0, 2)).collect()]
    assert got == [0, 1, 1, None]
    got = [x[0] for x in df.select(pm.bin_of(F.col("x"), 0.0, 1.0, 2, close_last=False)).collect()]
    assert got == [0, 1, None, None]


def test_map_spec_takes_one_definition():
    assert pm.MapSpec.make(((0, 1), (0, 2)), bin_sizes=0.25).bins == (4, 8)
    assert pm.MapSpec.make(((0, 1), (0, 2)), digits=1).bins == (10, 20)
    assert pm.MapSpec.make(((0, 1), (0, 2))).bins == (50, 50)
    with pytest.raises(ValueError):
        pm.MapSpec.make(((0, 1), (0, 2)), bins=(1, 1), digits=1)


def test_maximum_filter_stays_on_the_grid(spark):
    spec = pm.MapSpec(((0, 1), (0, 1)), (3, 3))
    cells = spark.createDataFrame([(0, 0, 0, 5.0), (0, 2, 2, 1.0)], "pop int, ix int, iy int, w double")
    got = {(x.ix, x.iy): x.w for x in pm.maximum_filter(cells, spec).collect()}
    assert got == {(0, 0): 5.0, (0, 1): 5.0, (1, 0): 5.0, (1, 1): 5.0, (2, 2): 1.0, (1, 2): 1.0, (2, 1): 1.0}


def test_map_round_trip(spark, tmp_path):
    spec = pm.MapSpec(((0, 1), (0, 1)), (3, 3))
    cells = spark.createDataFrame([(0, 0, 0, 5.0)], "pop int, ix int, iy int, w double")
    pm.save_map(cells, spec, [1.0], str(tmp_path / "m"))
    back, spec2, w = pm.load_map(spark, str(tmp_path / "m"))
    assert spec2 == spec and w == [1.0] and back.collect() == cells.collect()


def test_curve_side_outside_is_false_unless_extended(spark):
    df = spark.createDataFrame([(0.0, 10.0), (0.0, 15.0), (0.9, 15.0)], "c double, m double")
    curve = [(0.5, 14.0), (0.5, 16.0)]
    assert [x.s for x in sel.curve_side(df, "c", "m", curve, "-", "s").collect()] == [False, True, False]
    assert [x.s for x in sel.curve_side(df, "c", "m", curve, "-", "s", extend=True).collect()] == [True, True, False]


def test_sampling_follows_probability(spark):
    df = spark.range(20000).withColumn("lp", F.array(F.lit(float("-inf")), F.log(F.lit(0.3))))
    n = df.where(sel.probability_sampling(F.col("lp"), 1, F.col("id"), 1)).count()
    assert abs(n / 20000 - 0.3) < 0.02
    assert df.where(sel.probability_sampling(F.col("lp"), 0, F.col("id"), 1)).count() == 0


def test_half_to_even_exposure(spark):
    df = spark.createDataFrame([(10.0,), (30.0,), (19.0,), (None,)], "i0 double")
    got = [x[0] for x in df.selectExpr(ru.render(ru.exposure_sqrt("i0"))).collect()]
    assert got[:3] == [1800.0, 10800.0, 10800.0]
