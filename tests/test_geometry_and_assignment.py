import math
import random

import pytest
from pyspark.sql import functions as F

from starfold.functions import astro, geometry as geo
from starfold.operators import assign, density, export, ids, reach, report, verify


def test_arm_solutions_return_to_the_point(spark):
    rnd = random.Random(0)
    rows = []
    for k in range(400):
        rr, a = rnd.uniform(0.2, 6.0), rnd.uniform(-math.pi, math.pi)
        rows.append((k, 3.0, -2.0, 2.4, 2.3, -math.pi + rnd.uniform(0, 0.5), rnd.uniform(-0.5, 0.8), rnd.uniform(0, 6), rnd.uniform(0, 6),
                     3.0 + rr * math.cos(a), -2.0 + rr * math.sin(a)))
    df = spark.createDataFrame(rows, "id int, cx double, cy double, l1 double, l2 double, phi_in double, phi_out double, "
                                     "theta0 double, theta1 double, x double, y double")
    s = geo.solve_arm(df).withColumn("s", F.explode("solutions")).where(F.col("s.ex").isNotNull())
    px, py = geo.arm_position(F.col("s.theta"), F.col("s.phi"))
    worst = s.agg(F.max(F.greatest(F.abs(px - F.col("x")), F.abs(py - F.col("y"))))).first()[0]
    assert worst < 1e-9
    far = geo.solve_arm(df).where("solutions[0].theta IS NULL AND sqrt((x-3.0)*(x-3.0)+(y+2.0)*(y+2.0)) > 1.0")
    assert far.count() == sum(1 for r in rows if math.hypot(r[9] - 3.0, r[10] + 2.0) > 4.7)


def test_segment_distances(spark):
    one = spark.range(1)
    lit = [F.lit(float(v)) for v in (0, 0, 1, 0, 0.5, -1, 0.5, 1)]
    assert one.select(geo.segment_segment(*lit)).first()[0] == 0.0
    assert abs(one.select(geo.point_segment(*[F.lit(float(v)) for v in (2, 1, 0, 0, 1, 0)])).first()[0] - math.sqrt(2)) < 1e-12
    assert one.select(geo.point_segment(*[F.lit(float(v)) for v in (3, 4, 0, 0, 0, 0)])).first()[0] == 5.0


def test_sexagesimal_keeps_the_sign_of_minus_zero(spark):
    df = spark.createDataFrame([("-00:10:00",), ("10 30 00",), ("+01:00:36",)], "t string")
    assert [round(x[0], 9) for x in df.select(astro.sexagesimal_to_deg(F.col("t"))).collect()] == [-0.166666667, 10.5, 1.01]
    assert df.limit(3).select(astro.sexagesimal_to_deg(F.col("t"), hours=True)).collect()[1][0] == 157.5


def test_visibility(spark):
    ts = F.lit("2026-03-01 12:00:00").cast("timestamp")
    alt, _ = astro.altitude_azimuth(227.25, 67.25, ts)
    low, _ = astro.altitude_azimuth(227.25, -80.0, ts)
    a, b = spark.range(1).select(alt, astro.airmass(low)).first()
    assert a > 0 and b is None


def test_whitening_makes_a_round_cloud(spark):
    rnd = random.Random(3)
    pts = []
    for k in range(4000):
        u, v = rnd.gauss(0, 3), rnd.gauss(0, 0.5)
        pts.append((5 + 0.8 * u - 0.6 * v, -1 + 0.6 * u + 0.8 * v))
    df = spark.createDataFrame(pts, "x double, y double")
    seen = []
    fit = density.fit_whitening(df, "x", "y", s_cut=10.0, iterations=3, callback=lambda i, a, w: seen.append(i))
    u, v = fit.apply(F.col("x"), F.col("y"))
    s = df.select(u.alias("u"), v.alias("v")).agg(F.stddev("u"), F.stddev("v"), F.corr("u", "v"), F.avg("u")).first()
    assert abs(s[0] - 1) < 1e-6 and abs(s[1] - 1) < 1e-6 and abs(s[2]) < 1e-6 and seen == [0, 1, 2]
    x, y = fit.reverse(u, v)
    assert df.agg(F.max(F.abs(x - F.col("x")))).first()[0] < 1e-9


def test_dense_ids_and_ranks_across_ranges(spark):
    df = spark.range(5000).select((F.col("id") * 37 % 5000).alias("k")).repartition(7)
    got = ids.dense_id(df, "k", "n", start=10).collect()
    assert sorted(x.n for x in got) == list(range(10, 5010)) and all(x.n == x.k + 10 for x in got)
    # one group holds most of the rows and spans several ranges
    g = df.withColumn("grp", F.when(F.col("k") < 4000, 0).otherwise(F.col("k") % 3 + 1)).withColumn("v", (F.col("k") % 50).cast("double"))
    ranked = ids.rank_in_groups(g, ["grp"], "v", "k", "rank").collect()
    want = {}
    for x in sorted(ranked, key=lambda x: (x.grp, x.v, x.k)):
        want[x.grp] = want.get(x.grp, 0) + 1
        assert x["rank"] == want[x.grp]


def edges_of(spark, seed):
    rnd = random.Random(seed)
    rows = [(0, f, t, float(t % 4), rnd.random()) for f in range(30) for t in range(60) if rnd.random() < 0.15]
    return spark.createDataFrame(rows, "visit_idx int, fiber_id int, target_idx long, class_cost double, cost double")


def test_assignment_is_feasible_and_maximal(spark):
    for seed in (1, 2):
        e = edges_of(spark, seed)
        a = assign.assign_visit(e)
        assert verify.assignment_conflicts(a).count() == 0
        rows = a.collect()
        fibers, targets = {x.fiber_id for x in rows}, {x.target_idx for x in rows}
        assert not [x for x in e.collect() if x.fiber_id not in fibers and x.target_idx not in targets]


def test_visits_stop_when_a_target_is_done(spark):
    e = edges_of(spark, 3).withColumnRenamed("visit_idx", "pointing_idx")
    need = e.select("target_idx").distinct().withColumn("req_visits", F.lit(1))
    a = assign.assign_visits(e, [dict(visit_idx=k, pointing_idx=0, nrepeats=1) for k in range(3)], need)
    assert a.count() == a.select("target_idx").distinct().count()


def test_group_quota_keeps_the_best(spark):
    df = spark.createDataFrame([(1, "a", 3.0), (2, "a", 1.0), (3, "a", 2.0), (4, "b", 9.0)], "id int, g string, v double")
    assert sorted(x.id for x in assign.limit_per_group(df, ["g"], "v", "id", 2).collect()) == [2, 3, 4]


def test_ring_seeds_count():
    assert len(assign.ring_seeds()) == 20


def test_group_quota_in_the_assignment(spark):
    rows = [(0, f, t, 1.0, float((f * 7 + t * 3) % 11)) for f in range(12) for t in range(40)]
    e = spark.createDataFrame(rows, "visit_idx int, fiber_id int, target_idx long, class_cost double, cost double")
    groups = spark.range(12).select(F.col("id").cast("int").alias("fiber_id"), (F.col("id") % 3).alias("grp"))
    got = assign.assign_visit(e, groups, 2).collect()
    per_group = {}
    for r in got:
        per_group[r.fiber_id % 3] = per_group.get(r.fiber_id % 3, 0) + 1
    assert per_group == {0: 2, 1: 2, 2: 2} and len({r.fiber_id for r in got}) == len({r.target_idx for r in got}) == 6
    short = assign.short_groups(assign.assign_visit(e, groups, 2), groups, [0, 1], 2).collect()
    assert {(r.visit_idx, r.grp, r.used) for r in short} == {(1, g, 0) for g in range(3)}
    assert len(assign.assign_visit(e).collect()) == 12


def test_pointings_apart_run_together(spark):
    import random
    rnd = random.Random(9)
    # pointings 0-1-2 share targets in a chain, 3 and 4 stand alone
    views = {0: range(0, 30), 1: range(20, 50), 2: range(40, 70), 3: range(100, 130), 4: range(200, 230)}
    rows = [(p, f, t, float(t % 3), rnd.random()) for p, ts in views.items() for t in ts for f in range(12) if rnd.random() < 0.3]
    e = spark.createDataFrame(rows, "pointing_idx int, fiber_id int, target_idx long, class_cost double, cost double")
    assert assign.shared_pointings(e) == {(0, 1), (1, 0), (1, 2), (2, 1)}
    visits = [dict(visit_idx=k, pointing_idx=p, nrepeats=1 + p % 2) for k, p in enumerate([0, 1, 2, 3, 4, 0, 3])]
    assert [[v["visit_idx"] for v in w] for w in assign.waves(visits, assign.shared_pointings(e))] == [[0, 3, 4], [1, 6], [2, 5]]
    need = e.select("target_idx").distinct().withColumn("req_visits", (F.col("target_idx") % 2 + 1).cast("int"))
    got = {(r.visit_idx, r.fiber_id, r.target_idx, r.n) for r in assign.assign_visits(e, visits, need).collect()}
    # one visit after the other, in plain Python
    count, want = {}, set()
    for v in visits:
        left = [r for r in rows if r[0] == v["pointing_idx"] and count.get(r[2], 0) < r[2] % 2 + 1]
        while left:
            wish = {}
            for r in left:
                wish[r[1]] = min(wish.get(r[1], (1e9,)), (-r[3], r[4], r[2]))
            won = {}
            for f, (_, cost, t) in wish.items():
                won[t] = min(won.get(t, (1e9,)), (cost, f))
            for t, (_, f) in won.items():
                want.add((v["visit_idx"], f, t, v["nrepeats"]))
                count[t] = count.get(t, 0) + v["nrepeats"]
            taken = {f for _, f in won.values()}
            left = [r for r in left if r[1] not in taken and r[2] not in won]
    assert got == want


def test_short_groups_are_filled_by_paths(spark):
    import random
    for seed in (1, 2):
        rnd = random.Random(seed)
        # group of a fiber: fiber % 4; the first group's fibers see only what others may hold as well
        rows = [(v, f, t, 1.0, round(rnd.random(), 3)) for v in (0, 1) for f in range(24) for t in range(40) if rnd.random() < (0.08 if f % 4 == 0 else 0.25)]
        e = spark.createDataFrame(rows, "visit_idx int, fiber_id int, target_idx long, class_cost double, cost double")
        groups = spark.range(24).select(F.col("id").cast("int").alias("fiber_id"), (F.col("id") % 4).cast("int").alias("grp"))
        first = assign.assign_visit(e.where("fiber_id % 4 <> 0 OR target_idx < 3"))
        least = 6
        before = {(r.visit_idx, r.fiber_id, r.target_idx) for r in first.collect()}
        filled = assign.fill_short_groups(first, e, groups, least)
        after = {(r.visit_idx, r.fiber_id, r.target_idx) for r in filled.collect()}
        edges = {r[:3] for r in rows}
        assert after <= edges and len({x[:2] for x in after}) == len({(x[0], x[2]) for x in after}) == len(after) >= len(before)
        used = lambda pairs, v, g: sum(x[0] == v and x[1] % 4 == g for x in pairs)
        for v in (0, 1):
            for g in range(4):
                assert used(after, v, g) >= min(used(before, v, g), least)
                if used(after, v, g) < least:      # no path of three edges, and none from a group that could spare a pair
                    held = {x[2]: x[1] for x in after if x[0] == v}
                    free = [f for f in range(g, 24, 4) if f not in held.values()]
                    for f in free:
                        for t in [x[2] for x in edges if x[0] == v and x[1] == f]:
                            o = held[t]
                            assert not [x for x in edges if x[0] == v and x[1] == o and x[2] not in held]
                            assert o % 4 == g or used(after, v, o % 4) <= least
        faults = assign.group_faults(filled, e, groups, least).collect()
        assert len(faults) == 8 and not [r for r in faults if r.twice or r.strange or r.fixable]
        assert sum(used(after, v, 0) for v in (0, 1)) > sum(used(before, v, 0) for v in (0, 1))


def test_fibers_are_never_broadcast(spark):
    # small here, but a few bytes a row in the files of a large table too
    k = F.col("id")
    f = spark.range(40).select(k.cast("int").alias("fiber_id"), (8.0 * (k % 8)).alias("cx"), (8.0 * F.floor(k / 8)).cast("double").alias("cy"),
                               F.lit(0.3).alias("r_min"), F.lit(4.75).alias("r_max"), (k % 2).alias("grp"))
    xy = spark.range(500).select(k.alias("target_idx"), (k % 2).cast("int").alias("pointing_idx"), ((k * 37) % 60).cast("double").alias("x"),
                                 ((k * 11) % 40).cast("double").alias("y"))
    near = reach.neighbours(f, 9.0)
    dots = f.select("fiber_id", (F.col("cx") + 1.0).alias("dot_x"), F.col("cy").alias("dot_y"), F.lit(0.75).alias("dot_r"))
    edges = reach.reach(xy, f, 4.75, [0, 1])
    assigned = edges.select("fiber_id", "target_idx", F.col("pointing_idx").alias("visit_idx"))
    visits = f.select(F.col("fiber_id").alias("visit_idx"), F.lit(1).alias("nrepeats"))
    for df in (edges, reach.with_dots(f, dots, near), report.summary(xy, assigned, visits), report.group_load(report.fiber_load(edges, f, [0, 1]), f, "grp"),
               verify.thin_groups(edges, f, "grp", 2), export.join_assignments(assigned, f.select("fiber_id", "grp"), "fiber_id")):
        assert "Broadcast" not in df._jdf.queryExecution().simpleString()
    rows, fibers = xy.collect(), f.collect()
    want = {(t.pointing_idx, b.fiber_id, t.target_idx) for t in rows for b in fibers if 0.3 <= math.hypot(t.x - b.cx, t.y - b.cy) <= 4.75}
    assert want and sorted(want) == sorted((e.pointing_idx, e.fiber_id, e.target_idx) for e in edges.collect())


def test_arms_are_listed_only_where_the_neighbour_has_targets(spark):
    rnd = random.Random(3)
    fibers = {k: (8.0 * (k % 5), 8.0 * (k // 5)) for k in range(20)}
    rows = []
    for t in range(400):
        x, y = rnd.uniform(-4, 36), rnd.uniform(-4, 28)
        for k, (cx, cy) in fibers.items():
            d = math.hypot(x - cx, y - cy)
            if 0.3 <= d <= 4.5:
                a, b = math.atan2(y - cy, x - cx), math.acos(d / 4.75)
                rows.append((t % 2, k, t, x, y, [(cx + 2.375 * math.cos(a + s * b), cy + 2.375 * math.sin(a + s * b)) for s in (1, -1)]))
    edges = spark.createDataFrame(rows, "pointing_idx int, fiber_id int, target_idx long, x double, y double, solutions array<struct<ex:double,ey:double>>")
    pairs = [(a, b) for a in fibers for b in fibers if a != b and math.dist(fibers[a], fibers[b]) <= 9.0]
    near = spark.createDataFrame(pairs, "fiber_id int, neighbour_id int")

    def gap(px, py, ax, ay, bx, by):
        k = max(0.0, min(1.0, ((px - ax) * (bx - ax) + (py - ay) * (by - ay)) / ((bx - ax) ** 2 + (by - ay) ** 2)))
        return math.hypot(px - ax - k * (bx - ax), py - ay - k * (by - ay))

    want = sorted((p, f, t, g, o) for p, f, t, x, y, arm in rows for q, g, o, u, v, _ in rows
                  if p == q and (f, g) in set(pairs) and any(gap(u, v, x, y, *e) < 0.3 for e in arm))
    got = reach.colliding_elbows(edges, near, 0.3, 2.375)
    assert want and sorted(tuple(r) for r in got.collect()) == want
    assert "Broadcast" not in got._jdf.queryExecution().simpleString()
    facing = reach._facing_arms(edges, near, 0.3)      # the box of all solutions reaches neither side of most neighbours
    assert 0 < facing.count() < 0.7 * sum(f == a for _, f, *_ in rows for a, _ in pairs)


def rounds(rows):
    """The rounds of one visit in plain Python."""
    fibers, targets, out = set(), set(), set()
    while True:
        wish = {}
        for f, t, cc, cost in rows:
            if f not in fibers and t not in targets:
                wish[f] = min(wish.get(f, (1e9,)), (-cc, cost, t))
        won = {}
        for f, (_, cost, t) in wish.items():
            won[t] = min(won.get(t, (1e9,)), (cost, f))
        if not won:
            return out
        for t, (_, f) in won.items():
            out.add((f, t))
            fibers.add(f)
            targets.add(t)


@pytest.mark.parametrize("short", [1, 3, 32])
def test_short_lists_change_no_assignment(spark, monkeypatch, short):
    """Fibers that all want the same targets run out of short lists and get new ones."""
    monkeypatch.setattr(assign, "SHORT", short)
    rnd = random.Random(4)
    edges = {(f, t): (float(t % 3), rnd.randrange(50) / 10) for f in range(12) for t in range(40) if rnd.random() < 0.5}
    rows = [(f, t, *v) for (f, t), v in edges.items()]
    e = spark.createDataFrame([(v, *x) for v in (0, 1) for x in rows], "visit_idx int, fiber_id int, target_idx long, class_cost double, cost double")
    want = rounds(rows)
    assert {(r.visit_idx, r.fiber_id, r.target_idx) for r in assign.assign_visit(e).collect()} == {(v, *p) for v in (0, 1) for p in want}
    taken = spark.createDataFrame([(t,) for t in range(0, 40, 2)], "target_idx long")
    got = assign.assign_visit(e.where("visit_idx = 0"), taken=taken).collect()
    assert {(r.fiber_id, r.target_idx) for r in got} == rounds([r for r in rows if r[1] % 2])


def test_allocation_keeps_no_pairs_of_all_targets(spark, monkeypatch):
    """Targets crowd between two fibers; what is kept stays below the edges, and the pairs can still be read."""
    from starfold.plans import survey as sv
    from starfold.sources.fixtures import PLATE_SCALE
    kept, real = [], sv.cut
    monkeypatch.setattr(sv, "cut", lambda df: kept.append(real(df)) or kept[-1])
    rnd = random.Random(3)
    mm = 1 / PLATE_SCALE
    spots = [(k, 227.0 + (4 + rnd.uniform(-0.3, 0.3)) * mm / math.cos(math.radians(20.0)), 20.0 + rnd.uniform(-0.5, 0.5) * mm, 1800.0, 10.0 + k % 2) for k in range(300)]
    targets = spark.createDataFrame(spots, "target_idx long, ra double, dec double, exp_time double, non_observation_cost double")
    fibers = spark.createDataFrame([(f, 8.0 * f, 0.0, 2.375, 2.375, -math.pi, -0.001, 0.0, 0.3, 0.0, 4.75, False) for f in range(2)],
                                   "fiber_id int, cx double, cy double, l1 double, l2 double, phi_in double, phi_out double, theta0 double, theta1 double, r_min double, r_max double, broken boolean")
    out = sv.allocate(targets, fibers, None, [dict(pointing_idx=0, ra=227.0, dec=20.0, posang=0.0, stage=0, nvisits=1)], PLATE_SCALE, 4.75, 9.0, 1800.0, 1.0, "0.1 * dist")
    edges = {(r.fiber_id, r.target_idx): (r.x, r.y) for r in out.edges.collect()}
    assert len(edges) > 300 and max(df.count() for df in kept) <= len(edges)
    both = {t: p for (f, t), p in edges.items() if (1 - f, t) in edges}
    near = {(a, b) for a in both for b in both if a < b and math.dist(both[a], both[b]) < 1.0}
    assert {(r.t1, r.t2) for r in out.endpoint_pairs.collect()} == near and len(near) > 10 * len(edges)
    price = {(r.fiber_id, r.target_idx): 0.1 * r.dist for r in out.edges.collect()}
    placed = rounds([(f, t, 10.0 + t % 2, c) for (f, t), c in price.items()])
    assert tuple(sorted(t for _, t in placed)) in near           # so the cheaper one goes, on equal cost the first
    stays = max(placed, key=lambda p: (p[1] % 2, p[1]))
    assert [(r.fiber_id, r.target_idx) for r in out.assignments.collect()] == [stays] and all(p.isEmpty() for p in out.problems)
