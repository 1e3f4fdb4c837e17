import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from starfold.operators import export, merge as mg, report as rp, verify, zonejoin as zj
from starfold.sources import tables as tb
from starfold.streaming import stages


def test_text_catalog_with_comments_and_missing_values(spark, tmp_path):
    f = tmp_path / "cat.txt"
    f.write_text("# comment\n 1  10.5  -3.25 nan\n\n2 11.0 4.0 7\n")
    layout = tb.TextLayout((("id", "bigint"), ("ra", "double"), ("dec", "double"), ("g", "double")))
    rows = tb.read_text_catalog(spark, str(f), layout).orderBy("id").collect()
    assert [tuple(x) for x in rows] == [(1, 10.5, -3.25, None), (2, 11.0, 4.0, 7.0)]


def test_csv_layout_skips_the_header(spark, tmp_path):
    f = tmp_path / "cat.csv"
    f.write_text("a,b\n1,2.5\n2,nan\n")
    layout = tb.TextLayout((("id", "bigint"), ("v", "double")), delimiter=",", skip=1)
    assert [tuple(x) for x in tb.read_text_catalog(spark, str(f), layout).orderBy("id").collect()] == [(1, 2.5), (2, None)]


def test_writers_refuse_to_overwrite(spark, tmp_path):
    df = spark.range(3)
    tb.write_preprocessed(df, str(tmp_path / "x"), {"g": 1})
    back, photometry = tb.read_preprocessed(spark, str(tmp_path / "x"))
    assert photometry == {"g": 1} and back.select("__objid").distinct().first()[0] == 0
    with pytest.raises(AnalysisException):
        tb.write_preprocessed(df, str(tmp_path / "x"))


def test_sky_table_cone_and_partitioned_text(spark, tmp_path):
    df = spark.range(500).select("id", (F.col("id") * 0.7 % 360).alias("ra"), (F.col("id") % 170 - 85.0).alias("dec"))
    tb.write_sky_table(df, str(tmp_path / "sky"), 10.0)
    want = {x.id for x in df.collect() if abs(x.dec - 20) <= 1 and abs(x.ra - 73.5) <= 1}
    got = {x.id for x in tb.read_cone(spark, str(tmp_path / "sky"), 73.5, 20.0, 1.0).collect()}
    assert got <= want and got
    plan = tb.read_cone(spark, str(tmp_path / "sky"), 73.5, 20.0, 1.0)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dec_from" in plan
    near = spark.read.parquet(str(tmp_path / "sky")).where("dec_from <= 21 and dec_to >= 19").select("dec_from").distinct()
    assert 1 <= near.count() <= 3
    tb.write_partitioned_text(df.withColumn("t", F.col("id") % 3), str(tmp_path / "txt"), ["t"])
    assert spark.read.csv(str(tmp_path / "txt"), header=True).groupBy("t").count().count() == 3
    tb.write_rows(df, str(tmp_path / "rows"), "id < 10")
    assert spark.read.parquet(str(tmp_path / "rows")).count() == 10


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    for name, n in (("starfold_t", 100), ("starfold_u", 60)):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        tb.write_clustered(spark.range(n).withColumnRenamed("id", "k").withColumn(name, F.col("k") * 2), name, "k", 4, str(tmp_path / name))
        assert len(list((tmp_path / name).glob("*.parquet"))) == 4
    joined = tb.join_clustered(spark, "starfold_t", "starfold_u", "k")
    plans = [x._jdf.queryExecution().executedPlan().toString() for x in (joined, joined.groupBy("k").count())]
    assert joined.count() == 60 and not [p for p in plans if "Exchange" in p] and "SortMergeJoin" in plans[0]
    for name in ("starfold_t", "starfold_u"):
        spark.sql(f"DROP TABLE {name}")


def one_list(spark, key, prefix, rows):
    return mg.TargetList(key, prefix, spark.createDataFrame(rows, "targetid long, RA double, Dec double, pmra double, pmdec double, priority double, exp_time double"))


def test_merge_rules_by_hand(spark):
    a = 0.05 / 3600
    cal = one_list(spark, "cal", "cal", [(7, 10.0, 10.0, None, None, None, None)])
    s1 = one_list(spark, "s1", "sci", [(1, 10.0, 10.0 + a, 1.0, 2.0, 3.0, 900.0), (2, 20.0, 20.0, None, None, 2.0, 900.0)])
    s2 = one_list(spark, "s2", "sci", [(5, 20.0, 20.0 + a, 9.0, 9.0, 1.0, 600.0), (6, 20.0, 20.0 + 1.5 * a, None, None, 0.0, 60.0)])
    targets, links = mg.merge_lists([s1, s2, cal], 1 << 40)
    t = {x.target_idx: x for x in targets.collect()}
    assert t[0].prefix == "cal" and t[0]["class"] == "cal" and t[0].priority == 3.0 and t[0].exp_time == 900.0 and t[0].pmra == 1.0
    # 5 is closest to 2 and wins; the loser 6 becomes a target of its own
    assert t[1].targetid == 2 and t[1].priority == 1.0 and t[1]["class"] == "sci_P1" and t[1].exp_time == 900.0 and t[1].pmra == 9.0
    assert t[2].targetid == 6 and len(t) == 3
    ln = {(x.key, x.targetid): (x.target_idx, x.objid) for x in links.collect()}
    assert ln[("s2", 5)] == (1, (1 << 40) | 1) and ln[("cal", 7)] == (0, 7) and len(ln) == 5


def test_first_list_wins_even_without_a_value(spark):
    p = spark.createDataFrame([(1, 0, 0, "g", None, None, None, None), (1, 1, 0, "g", 20.0, 0.1, None, None)],
                              "target_idx long, list_rank int, kind_rank int, filter string, mag double, mag_err double, flux double, flux_err double")
    assert mg.wide_magnitudes(p, ["g"]).first().g_mag is None
    assert mg.wide_magnitudes(p, ["g"], skip_nulls=True).first().g_mag == 20.0


def test_preference_reads_the_original_filter_name(spark):
    df = spark.createDataFrame([([("i_hsc", 1.0, 0.1), ("i_cfht", 2.0, 0.2)],)], "fluxes array<struct<filter:string,psf:double,psf_err:double>>")
    plain = export.fluxes_by_band(F.col("fluxes"), {"i_hsc": "i_old_hsc"})["psf_flux_i"]
    mapped = export.fluxes_by_band(F.col("fluxes"), {"i_hsc": "i_old_hsc"}, rank_mapped=True)["psf_flux_i"]
    assert tuple(df.select(plain, mapped).first()) == (1.0, 2.0)


def test_missing_columns():
    class Frame:
        columns = ["targetid", "RA", "Dec", "priority", "epoch"]
    assert verify.missing_columns(Frame, "sci")[0] == ["exp_time"]


def test_stages_add_up(spark, tmp_path):
    spark.createDataFrame([(1, 3), (2, 1)], "target_idx long, req_visits int").write.parquet(str(tmp_path / "t"))
    spark.createDataFrame([(1, 0), (2, 0)], "target_idx long, visit_idx int").write.parquet(str(tmp_path / "s0"))
    spark.createDataFrame([(1, 1)], "target_idx long, visit_idx int").write.parquet(str(tmp_path / "s1"))
    visits = spark.createDataFrame([(0, 1), (1, 2)], "visit_idx int, nrepeats int")
    t = stages.next_stage_targets(spark, str(tmp_path / "t"), [str(tmp_path / "s0"), str(tmp_path / "s1")], visits)
    assert {x.target_idx: x.done_visits for x in t.collect()} == {1: 3, 2: 1}
    assert stages.unfinished(t).count() == 0


def test_lists_arrive_as_files(spark, tmp_path):
    src = tmp_path / "in"
    cfg = tb.ListConfig(str(src), column_map={"id": "targetid"}, mask="targetid > 2")
    for k in range(2):
        spark.range(k * 3, k * 3 + 3).write.mode("append").parquet(str(src))
        q = stages.ingest_lists(spark, str(src), "id long", cfg, str(tmp_path / "out"), str(tmp_path / "ck"))
        q.awaitTermination(60)
    assert sorted(x.targetid for x in spark.read.parquet(str(tmp_path / "out")).collect()) == [3, 4, 5]


def scanned_rows(df):
    """Rows that the scan with run-time pruning gave, from the metrics of the plan."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "dynamicpruning" in text
    leaves = plan.collectLeaves()
    scans = [leaves.apply(k) for k in range(leaves.size()) if "dynamicpruning" in leaves.apply(k).toString()]
    return sum(int(x.metrics().apply("numOutputRows").value()) for x in scans if x.metrics().contains("numOutputRows"))


def test_index_gives_the_touched_cells_only(spark, tmp_path):
    sky = spark.range(4000).selectExpr("id AS target_idx", "(id * 37) % 360 + 0.5 AS RA", "(id * 11) % 160 - 79.5 AS Dec")
    path = str(tmp_path / "index")
    zj.add_to_index(sky.where("target_idx < 2000"), path, "target_idx", ("RA", "Dec"))
    zj.add_to_index(sky.where("target_idx >= 2000").unionByName(spark.sql("SELECT 9999L AS target_idx, CAST(NULL AS DOUBLE) AS RA, 1.0D AS Dec")), path, "target_idx", ("RA", "Dec"))
    assert spark.read.parquet(path).count() == 4000
    few = sky.where("target_idx IN (5, 3000)")
    near = zj.read_index(few, path, "target_idx", 0.1, ("RA", "Dec"), ("RA", "Dec"))
    got = {r.target_idx for r in near.collect()}
    assert {5, 3000} <= got and len(got) < 20
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert scanned_rows(zj.read_index(few, path, "target_idx", 0.1, ("RA", "Dec"), ("RA", "Dec"))) == len(got)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    edge = spark.createDataFrame([(1, 359.99999, 10.0)], "targetid long, RA double, Dec double")
    zj.add_to_index(spark.createDataFrame([(7777, 0.00001, 10.0)], "target_idx long, RA double, Dec double"), path, "target_idx", ("RA", "Dec"))
    assert 7777 in {r.target_idx for r in zj.read_index(edge, path, "target_idx", 1.0, ("RA", "Dec"), ("RA", "Dec")).collect()}


def test_many_cones_prune_while_running(spark, tmp_path):
    sky = spark.range(5000).selectExpr("id", "(id * 37) % 360 + 0.25 AS ra", "(id * 11) % 160 - 79.5 AS dec")
    path = str(tmp_path / "sky")
    tb.write_sky_table(sky, path)
    centers = spark.createDataFrame([(1, 10.25, 20.0), (2, 359.9, 20.0), (3, 200.0, -70.0), (4, 5.0, 95.0)], "center int, ra double, dec double")
    out = tb.read_cones(centers, path, 2.0, "center")
    assert "dynamicpruning" in out._jdf.queryExecution().executedPlan().toString()
    rows = sky.collect()
    def sep(a, b, c, d):
        import math
        a, b, c, d = map(math.radians, (a, b, c, d))
        return math.degrees(2 * math.asin(math.sqrt(math.sin((d - b) / 2) ** 2 + math.cos(b) * math.cos(d) * math.sin((c - a) / 2) ** 2)))
    want = {(k, r.id) for k, ra, dec in ((1, 10.25, 20.0), (2, 359.9, 20.0), (3, 200.0, -70.0)) for r in rows if sep(ra, dec, r.ra, r.dec) <= 2.0}
    assert {(r.center, r.id) for r in out.collect()} == want and want


def test_problems_are_counted_by_the_writing_job(spark, tmp_path):
    df = spark.range(100).selectExpr("id AS targetid", "IF(id % 10 = 0, NULL, 1.0D) AS RA", "2.0D AS Dec", "IF(id % 4 = 0, NULL, 1.0D) AS priority", "IF(id % 5 = 0, -1.0D, 60.0D) AS exp_time")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("counted", "counted")
    seen = verify.write_counted(df, str(tmp_path / "list"), verify.list_counts("sci"))
    jobs = tracker.getJobIdsForGroup("counted")
    spark.sparkContext.setJobGroup("other", "other")
    assert len(jobs) == 1
    assert seen == {"n_rows": 100, "missing_position": 10, "missing_id": 0, "missing_priority": 25, "bad_exposure_time": 20}
    problems = {r.problem: r.n for r in verify.list_problems(df, "sci").groupBy("problem").count().withColumnRenamed("count", "n").collect()}
    assert (problems["missing priority"], problems["bad exposure time"]) == (25, 20)
    design = spark.sql("SELECT * FROM VALUES (1, -1L, 1.0D, NULL), (2, 5L, 1.0D, 1.0D), (3, -1L, NULL, NULL) t(fiber_id, target_idx, ra, dec)")
    assert verify.write_counted(design, str(tmp_path / "d"), verify.design_counts()) == {"n_rows": 3, "coordinates_without_target": 1, "unassigned": 2}
    plan = spark.sql("SELECT * FROM VALUES (1, 2, 1, 60.0D), (2, CAST(NULL AS INT), 3, CAST(NULL AS DOUBLE)) t(pointing_idx, nvisits, nrepeats, exp_time)")
    assert verify.write_counted(plan, str(tmp_path / "p"), verify.visit_counts(3)) == {"n_rows": 2, "too_few_visits": 1, "missing_exposure_time": 1}


def test_sketches_of_runs_are_merged(spark, tmp_path):
    path = str(tmp_path / "s")
    seen = spark.range(60_000).selectExpr("id % 3 AS stage", "id % 20000 AS target_idx")
    rp.write_sketches(seen.where("stage < 2"), path, ["stage"], "a")
    rp.write_sketches(seen.where("stage > 0"), path, ["stage"], "b")
    assert abs(rp.sketched_targets(spark, path, []).first().n - 20_000) < 0.065 * 20_000
    assert all(abs(r.n - 20_000) < 0.065 * 20_000 for r in rp.sketched_targets(spark, path, ["stage"]).collect())


def test_folded_updates_are_those_of_one_list_after_another(spark):
    import random
    rnd = random.Random(7)

    def some(*values):
        return rnd.choice([None, *values])

    def row(t, key, prefix):
        prio = some(0.0, 1.0, 2.5, 4.0, float("nan")) if prefix == "sci" else None
        return (key, t, 1.0, 2.0, prefix, some(1.0, 2.0), some(0.5), some(1.5, -2.0), some(3.0), some(0.1, 0.2), None, 0,
                some(900.0, 1800.0, 3600.0), prio, f"{prefix}_own", rnd.choice([1, 5, 9]))

    schema = ", ".join(f"{n} {k}" for n, k in mg.TARGET_SCHEMA)
    kinds = ["sci", "cal", "sci", "sci"]
    targets = spark.createDataFrame([(*row(t, "first", rnd.choice(["sci", "cal"])), t) for t in range(300)], f"{schema}, target_idx long")
    lists = [spark.createDataFrame([(*row(1000 + t, f"l{k}", p), t) for t in range(300) if rnd.random() < 0.6], f"{schema}, target_idx long")
             for k, p in enumerate(kinds)]
    want, log = targets, None
    for k, (p, l) in enumerate(zip(kinds, lists)):
        want = mg.update_targets(want, l, p)
        entry = l.select("target_idx", F.lit(k).alias("list_rank"), F.lit(p).alias("list_prefix"), *mg._UPDATED)
        log = entry if log is None else log.unionByName(entry)
    folded = mg.fold_updates(targets, log)
    key = lambda r: repr(tuple(r))
    assert folded.columns == targets.columns and sorted(map(key, folded.collect())) == sorted(map(key, want.select(*targets.columns).collect()))
    # an entry stays a row of columns: no list of entries is collected and folded in an interpreter
    assert "collect_list" not in folded._jdf.queryExecution().simpleString()
