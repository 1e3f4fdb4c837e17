import math
import random

import pytest
from pyspark.sql import functions as F

from starfold.operators import blocks, zonejoin as zj


def sep(a, b):
    r1, d1, r2, d2 = map(math.radians, (a[1], a[2], b[1], b[2]))
    s = math.sin((d2 - d1) / 2) ** 2 + math.cos(d1) * math.cos(d2) * math.sin((r2 - r1) / 2) ** 2
    return math.degrees(2 * math.asin(min(1, math.sqrt(s)))) * 3600


def sky(n, seed, spread):
    """Points at the RA wrap, at both poles and in an ordinary field."""
    rnd = random.Random(seed)
    out = []
    for k in range(n):
        u, v = rnd.uniform(-spread, spread), rnd.uniform(-spread, spread)
        kind = k % 4
        if kind == 0:
            p = (u % 360, v)
        elif kind == 1:
            p = (rnd.uniform(0, 360), 90 - abs(v) / 4)
        elif kind == 2:
            p = (rnd.uniform(0, 360), -90 + abs(v) / 4)
        else:
            p = (227 + u, 67 + v / 2)
        out.append((k, p[0], p[1]))
    return out


@pytest.fixture(scope="module", params=[(60.0, 0.05), (3600.0, 2.0), (30.0, 0.001), (36000.0, 30.0)])
def case(request, spark):
    radius, spread = request.param
    a, b = sky(160, 1, spread), sky(160, 2, spread)
    frames = [spark.createDataFrame(x, "id long, ra double, dec double") for x in (a, b)]
    return radius, a, b, *frames


def brute(a, b, radius):
    return {(x[0], y[0]) for x in a for y in b if sep(x, y) <= radius}


@pytest.mark.parametrize("side", ["left", "right"])
def test_pairs_match_brute_force(case, side):
    radius, a, b, da, db = case
    got = zj.pairs_within(da, db, radius, "id", "id", explode=side).collect()
    assert len(got) == len({(g.left_id, g.right_id) for g in got})
    assert {(g.left_id, g.right_id) for g in got} == brute(a, b, radius)


def test_one_to_one_matches_brute_force(case):
    radius, a, b, da, db = case
    nearest = {}
    for x in a:
        best = min((sep(x, y), y[0]) for y in b)
        if best[0] <= radius:
            nearest[x[0]] = best
    won = {}
    for lid, (s, rid) in nearest.items():
        won[rid] = min(won.get(rid, (1e9, 0)), (s, lid))
    got = zj.match_one_to_one(da, db, radius, "id", "id").collect()
    assert {(g.left_id, g.right_id) for g in got} == {(w[1], rid) for rid, w in won.items()}


def test_nearest_any_distance_reaches_the_far_side(spark):
    big = spark.createDataFrame([(1, 0.0, -89.9), (2, 10.0, 10.0)], "id long, ra double, dec double")
    small = spark.createDataFrame([(1, 180.0, 89.9), (2, 10.0, 10.01), (3, 190.0, -10.0)], "id long, ra double, dec double")
    got = {g.left_id: g.right_id for g in zj.nearest_any_distance(small, big, "id", "id").collect()}
    assert got == {1: 2, 2: 2, 3: 1}
    assert zj.nearest_any_distance(small, big.where("id > 5"), "id", "id").count() == 0


def test_many_equally_hot_cells_and_one_hot_cell(spark):
    # 5000 cells with two rows each side, and one with a third of all rows
    rows = [(k, (k // 2) * 0.01 if k < 10_000 else 77.0051, 5.0) for k in range(15_000)]
    df = spark.createDataFrame(rows, "id long, ra double, dec double")
    h = zj.zone_height(1 / 3600)
    p = zj.with_cell(df.where("id < 10000 or id < 10200").select(F.col("id").alias("a"), F.col("ra").alias("x"), F.col("dec").alias("y")), "x", "y", h)
    c = zj.with_cover(df.select(F.col("id").alias("b"), "ra", "dec"), "ra", "dec", h, 1 / 3600)
    met = blocks.cell_join(p, c).where("x = ra and y = dec")
    n = met.agg(F.count(F.lit(1)), F.count_distinct("a", "b")).first()
    assert n[0] == n[1] == 5000 * 4 + 200 * 5000


def test_crowded_search_is_refined_and_exact(spark, monkeypatch):
    monkeypatch.setattr(zj, "CROWD", 20)
    rnd = random.Random(9)
    def crowd(n):
        return [(k, 40.0 + (rnd.uniform(0, 2e-4) if k % 3 else k * 0.003), 20.0 + (rnd.uniform(0, 2e-4) if k % 3 else 0.0)) for k in range(n)]
    a, b = crowd(240), crowd(240)
    da, db = (spark.createDataFrame(x, "id long, ra double, dec double") for x in (a, b))
    for radius in (0.5, 20.0):
        want = {}
        for x in a:
            s, rid = min((sep(x, y), y[0]) for y in b)
            if s <= radius:
                want[x[0]] = rid
        got = zj.nearest_within(da, db, radius, "id", "id").collect()
        assert len(got) == len(want) and {g.left_id: g.right_id for g in got} == want


def test_cone_box_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame(sky(50, 1, 1.0), "id long, ra double, dec double").write.parquet(str(tmp_path / "t"))
    plan = zj.cone(spark.read.parquet(str(tmp_path / "t")), 227.0, 67.0, 0.5)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(dec" in plan


def test_copies_and_ties_go_to_the_smallest_id(spark):
    right = spark.createDataFrame([(9, 1.0, 1.0), (4, 1.0, 1.0), (7, 1.0, 1.0)], "id long, ra double, dec double")
    left = spark.createDataFrame([(2, 1.0, 1.0), (1, 1.0, 1.0)], "id long, ra double, dec double")
    near = {g.left_id: g.right_id for g in zj.nearest_within(left, right, 1.0, "id", "id").collect()}
    assert near == {1: 4, 2: 4}
    one = zj.match_one_to_one(left, right, 1.0, "id", "id").collect()
    assert [(o.left_id, o.right_id) for o in one] == [(1, 4)]


def test_missing_positions_and_empty_sides(spark):
    left = spark.createDataFrame([(1, None, 1.0), (2, float("nan"), 1.0), (3, 1.0, 1.0)], "id long, ra double, dec double")
    right = left.where("id = 3")
    assert [tuple(x)[:2] for x in zj.nearest_within(left, right, 1.0, "id", "id").collect()] == [(3, 3)]
    assert zj.nearest_within(left, right.where("id < 0"), 1.0, "id", "id").count() == 0


@pytest.mark.parametrize("ra0,dec0,radius", [(0.01, 0.0, 0.1), (359.99, 10.0, 0.1), (120.0, 89.95, 0.2), (227.0, 67.0, 0.5)])
def test_cone_matches_brute_force(spark, ra0, dec0, radius):
    pts = sky(400, 5, 0.3)
    df = spark.createDataFrame(pts, "id long, ra double, dec double")
    want = {p[0] for p in pts if sep((0, ra0, dec0), p) <= radius * 3600}
    assert {x.id for x in zj.cone(df, ra0, dec0, radius).collect()} == want


def test_strict_and_closed_radius(spark):
    a = spark.createDataFrame([(1, 0.0, 0.0)], "id long, ra double, dec double")
    d = zj.pairs_within(a, a, 1.0, "id", "id").first().sep_arcsec
    assert d == 0.0
    assert zj.pairs_within(a, a, 0.0, "id", "id").count() == 1
    assert zj.pairs_within(a, a, 0.0, "id", "id", closed=False).count() == 0


def test_precedence_dedupe_counts_copies(spark):
    rows = [(1, "deep", 5.0, 5.0), (2, "old", 5.0, 5.0), (3, "old", 8.0, 8.0), (4, "wide", 8.0, 8.0 + 1 / 3600), (5, "old", 9.0, 9.0)]
    df = spark.createDataFrame(rows, "id long, src string, ra double, dec double")
    out = zj.drop_lower_precedence(df, 2.0, "src", [["old"], ["wide"]], ["id", "src"])
    assert sorted(x.id for x in out.collect()) == [1, 4, 5]


def test_nearest_at_any_distance(case, spark):
    radius, a, b, da, db = case
    for part, frame in ((b, db), (b[:1], spark.createDataFrame(b[:1], db.schema)))[:2 if radius == 60.0 else 1]:
        got = {x.left_id: x for x in zj.nearest_any_distance(da, frame, "id", "id").collect()}
        assert len(got) == len(a)
        for p in a:
            best = min(sep(p, q) for q in part)
            assert abs(got[p[0]].sep_arcsec - best) < 1e-5
    assert zj.nearest_any_distance(da, db.limit(0), "id", "id").count() == 0


def test_large_table_is_celled_once(spark, monkeypatch):
    rows = spark.range(2000).selectExpr("id", "id % 360 + 0.5 AS ra", "(id * 7) % 170 - 85.0 AS dec")
    seen = []
    real = zj._grid
    monkeypatch.setattr(zj, "_grid", lambda *a: seen.append(1) or real(*a))
    found = zj.nearest_any_distance(rows.where("id < 20"), rows.withColumn("id", F.col("id") + 0), "id", "id")
    assert len(seen) == 1 and found.where("sep_arcsec > 0").count() == 0
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 2 and "explode" not in plan          # the last level, then the rows


def test_existence_within_a_radius(case):
    radius, a, b, da, db = case
    have = {p[0] for p in a if any(sep(p, q) <= radius for q in b)}
    near, far = zj.with_match(da, db, radius), zj.without_match(da, db, radius)
    assert sorted(x.id for x in near.collect()) == sorted(have)
    assert sorted(x.id for x in far.collect()) == sorted({p[0] for p in a} - have)
    for frame, kind in ((near, "LeftSemi"), (far, "LeftAnti")):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert kind in plan and "Aggregate" not in plan


def test_rows_without_position_have_no_match(spark):
    a = spark.createDataFrame([(1, None, 1.0), (2, float("nan"), 1.0), (3, 1.0, 1.0)], "id long, ra double, dec double")
    assert [x.id for x in zj.with_match(a, a, 1.0).collect()] == [3]
    assert sorted(x.id for x in zj.without_match(a, a, 1.0).collect()) == [1, 2]


def test_pairs_are_neither_broadcast_nor_shuffled(spark):
    k = F.col("id")
    a = spark.range(60).select((k % 50).alias("a_id"), (226.0 + (k % 50) / 2e3).alias("ra"), F.lit(67.0).alias("dec"))       # ten ids twice
    b = spark.range(90).select(F.when(k != 7, k % 80).alias("b_id"), (226.0 + k / 4e3).alias("ra"), F.lit(67.0).alias("dec"), k.alias("tag"))
    for how in ("inner", "left"):
        got = zj.merge_nearby(a, b, 4.0, "a_id", "b_id", how)
        plan = got._jdf.queryExecution().simpleString()
        assert "Broadcast" not in plan and "Exchange hashpartitioning(_r" not in plan and plan.count("_l_id") == 0
        pairs = zj.pairs_within(a, b, 4.0, "a_id", "b_id")
        wide = (a.join(pairs, F.col("a_id") == F.col("left_id"), how)
                .join(b.withColumnsRenamed({"ra": "ra_2", "dec": "dec_2"}), F.col("right_id") == F.col("b_id"), "left" if how == "left" else "inner"))
        names = ["a_id", "b_id", "ra", "ra_2", "tag", "sep_arcsec"]
        assert got.count() > 60 and got.select(names).exceptAll(wide.select(names)).isEmpty() and wide.select(names).exceptAll(got.select(names)).isEmpty()


def test_searches_carry_few_cells(spark, monkeypatch):
    stars = spark.range(20000).selectExpr("id", "226 + ((id * 7919) % 20011) / 20011.0D AS ra", "67 + ((id * 104) % 20011) / 20011.0D AS dec")
    moved, real = [], zj.cut
    monkeypatch.setattr(zj, "cut", lambda df: moved.append(real(df)) or moved[-1])
    found = zj.nearest_any_distance(stars.where("id % 200 = 3").withColumn("dec", F.col("dec") + 0.001), stars, "id", "id")
    assert found.count() == 100
    assert max(m.count() for m in moved if "left_id" in m.columns) < 40 * 100


@pytest.mark.parametrize("h", [0.25, 0.9, 7.0])
def test_disk_cells_hold_what_is_near_and_little_else(spark, h):
    """Cells that lie in a circle are marked, all others touch it; also at the RA wrap and the poles."""
    radius = 2.0
    a, b = sky(24, 5, 3.0), sky(3000, 6, 4.0)
    da, db = (spark.createDataFrame(x, "id long, ra double, dec double") for x in (a, b))
    cover = zj.with_disk(da.toDF("cid", "c_ra", "c_dec"), "c_ra", "c_dec", h, radius)
    met = [(m.cid, m.id, m.inside) for m in blocks.cell_join(zj.with_cell(db, "ra", "dec", h), cover, True).select("cid", "id", "inside").collect()]
    assert len(met) == len({m[:2] for m in met})
    want = brute(a, b, radius * 3600)
    assert want <= {m[:2] for m in met} and {m[:2] for m in met if m[2]} <= want


def test_cones_of_dense_rows_meet_little_else(spark, monkeypatch, tmp_path):
    from starfold.sources import tables as tb
    monkeypatch.setattr(zj, "DENSE", 5)
    rnd = random.Random(8)
    stars = [(k, 227 + rnd.uniform(-2, 2), 67 + rnd.uniform(-1, 1)) for k in range(4000)]
    cones = [(k, 227 + rnd.uniform(-1, 1), 67 + rnd.uniform(-0.6, 0.6)) for k in range(12)]
    tb.write_sky_table(spark.createDataFrame(stars, "id long, ra double, dec double"), str(tmp_path / "sky"), 0.25)
    met = tb.read_cones(spark.createDataFrame(cones, "center long, ra double, dec double"), str(tmp_path / "sky"), 0.3, "center", 0.25)
    got = [(m.center, m.id) for m in met.collect()]
    want = brute(cones, stars, 0.3 * 3600)
    assert len(got) == len(set(got)) and set(got) == want
    plan = met._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    assert "_inside" in plan
    h = zj.circle_cells(spark.createDataFrame(stars, "id long, ra double, dec double"), "ra", "dec", 0.3)
    meeting = blocks.cell_join(zj.with_cell(spark.createDataFrame(stars, "id long, ra double, dec double"), "ra", "dec", h),
                               zj.with_disk(spark.createDataFrame(cones, "center long, c_ra double, c_dec double"), "c_ra", "c_dec", h, 0.3), True)
    assert meeting.count() < 1.7 * len(want)


def test_large_table_moves_once_and_is_not_kept(spark, monkeypatch):
    """Crowds of copies are folded first; else rows go to the last join as they are, without their cell."""
    rnd = random.Random(9)
    many = [(k, 227 + rnd.uniform(-2, 2), 67 + rnd.uniform(-1, 1)) for k in range(3000)]
    many += [(5000 - k, 227.5, 67.5) for k in range(60)] + [(9001, None, 1.0), (9002, 1.0, float("nan"))]
    big = spark.createDataFrame(many, "id long, ra double, dec double")
    small = [(k, 227 + rnd.uniform(-2, 2), 67 + rnd.uniform(-1, 1)) for k in range(20)] + [(20, 227.5, 67.5001)]
    whole = [x for x in many if x[0] < 9000]
    want = {p[0]: min((round(sep(p, q), 6), q[0]) for q in whole)[1] for p in small}
    for crowd, folded in ((10_000, False), (50, True)):
        kept, real = [], zj.cut
        monkeypatch.setattr(zj, "CROWD", crowd)
        monkeypatch.setattr(zj, "cut", lambda df: kept.append(real(df)) or kept[-1])
        found = zj.nearest_any_distance(spark.createDataFrame(small, "id long, ra double, dec double"), big, "id", "id")
        monkeypatch.setattr(zj, "cut", real)
        assert {x.left_id: x.right_id for x in found.collect()} == want and want[20] == 4941
        assert not [df for df in kept if "b_id" in df.columns]
        assert ("Aggregate [b_ra" in found._jdf.queryExecution().optimizedPlan().toString()) == folded


def test_nearest_points_move_without_their_cell(spark):
    a = spark.range(60).selectExpr("id", "226 + id / 1000.0D AS ra", "67.0D AS dec")
    for side in ("left", "right"):
        found = zj.nearest_within(a, a, 3.0, "id", "id", explode=side)
        tops = found._jdf.queryExecution().optimizedPlan().toString().split("Join")[1]
        assert tops.count("AS cell") == 1 and found.where("left_id = right_id AND sep_arcsec = 0").count() == 60
