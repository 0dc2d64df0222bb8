"""Containment rules, strategies, projection round trip."""

import math

import pytest
from pyspark.sql import functions as F

from zonecast.functions.geometry import NY_LONG_ISLAND_FTUS, lcc_forward, lcc_inverse
from zonecast.operators import polygons, quadtree, spatial
from zonecast.plans.strategy import materialize
from zonecast.sources import fixtures as fx

VSCHEMA = "locationid bigint, ring int, seq int, x double, y double"


def _square(zone, ring, x0, y0, x1, y1):
    return [(zone, ring, 0, x0, y0), (zone, ring, 1, x1, y0), (zone, ring, 2, x1, y1),
            (zone, ring, 3, x0, y1)]


def _zones(spark):
    v = []
    v += _square(1, 0, 0.0, 0.0, 2.0, 2.0)          # zone 1
    v += _square(2, 0, 2.0, 0.0, 4.0, 2.0)          # zone 2 abuts zone 1 at x = 2
    v += _square(3, 0, 0.0, 0.0, 1.0, 1.0)          # zone 3 overlaps zone 1
    v += _square(4, 0, 10.0, 10.0, 14.0, 14.0)      # zone 4 with a hole
    v += _square(4, 1, 11.0, 11.0, 13.0, 13.0)
    return spark.createDataFrame(v, VSCHEMA)


POINTS = [("outside", 20.0, 20.0), ("in1", 1.5, 1.5), ("overlap", 0.5, 0.5),
          ("on_shared_edge", 2.0, 1.5), ("in_hole", 12.0, 12.0), ("in_ring", 10.5, 12.0),
          ("in2", 3.0, 0.5), ("null", None, None)]


@pytest.mark.parametrize("broadcast", [True, False])
def test_point_in_zone_rules(spark, broadcast):
    pts = spark.createDataFrame(POINTS, "pid string, lon double, lat double")
    shapes = spatial.zone_shapes(_zones(spark))
    got = {r.pid: r.locationid for r in
           spatial.assign_zone(pts, shapes, max_edges=6, broadcast=broadcast).collect()}
    assert got["outside"] is None            # D2: NULL, not a row index
    assert got["in1"] == 1
    assert got["overlap"] == 1               # D3: lowest zone id wins
    assert got["on_shared_edge"] in (1, 2)   # D14: exactly one of two abutting zones
    assert got["in_hole"] is None            # even-odd: holes excluded
    assert got["in_ring"] == 4
    assert got["in2"] == 2
    assert got["null"] is None
    assert len(got) == len(POINTS)           # a left join: every point kept once


def test_leaf_size_does_not_change_result(spark, sf_small):
    shapes = spatial.zone_shapes(fx.zone_vertices_view(spark, sf_small))
    pts = fx.customer_points_view(spark, sf_small)
    a = spatial.assign_zone(pts, shapes, max_edges=1000).select("point_id", "locationid")
    b = spatial.assign_zone(pts, shapes, max_edges=4).select("point_id", "locationid")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_fixture_checksum(spark, sf_mid):
    # FIXTURES.md: 1500 customer points, 684 in a zone, checksum 6680504
    shapes = spatial.zone_shapes(fx.zone_vertices_view(spark, sf_mid))
    r = spatial.assign_zone(fx.customer_points_view(spark, sf_mid), shapes).agg(
        F.count("*").alias("n"), F.count("locationid").alias("hit"),
        F.sum(F.col("point_id") * (F.col("locationid") + 1)).alias("chk")).first()
    assert (r.n, r.hit, r.chk) == (1500, 684, 6680504)


def test_tile_join_is_broadcast_hash_join(spark, sf_small):
    shapes = spatial.zone_shapes(fx.zone_vertices_view(spark, sf_small))
    out = spatial.assign_zone(fx.customer_points_view(spark, sf_small), shapes)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan \
        and "BroadcastNestedLoopJoin" not in plan


def test_polygon_edges_close_rings(spark):
    e = spatial.polygon_edges(_zones(spark)).where("locationid = 1").collect()
    assert len(e) == 4
    assert {(r.x1, r.y1, r.x2, r.y2) for r in e if r.x2 == 0.0 and r.y2 == 0.0} == {(0.0, 2.0, 0.0, 0.0)}


def test_lcc_round_trip(spark):
    pts = spark.createDataFrame([(-74.0, 40.7), (-73.75, 40.6), (-73.95, 40.85)],
                                "lon0 double, lat0 double")
    x, y = lcc_forward(F.col("lon0"), F.col("lat0"), NY_LONG_ISLAND_FTUS)
    fwd = pts.select("lon0", "lat0", x.alias("x"), y.alias("y"))
    back = lcc_inverse(fwd, "x", "y", NY_LONG_ISLAND_FTUS).collect()
    for r in back:
        assert abs(r.lon - r.lon0) < 1e-9 and abs(r.lat - r.lat0) < 1e-9
    # origin: central meridian at the false easting
    r0 = [r for r in back if r.lon0 == -74.0][0]
    assert math.isclose(r0.x, NY_LONG_ISLAND_FTUS.false_easting, abs_tol=1e-6)


def test_geojson_lines_parse_back(spark, sf_small):
    feats = polygons.zone_features(fx.zone_vertices_view(spark, sf_small),
                                   fx.zone_attrs_view(spark, sf_small))
    lines = feats.select(F.col("feature").alias("value"))
    parsed = polygons.parse_features(lines).collect()
    assert len(parsed) == 25
    for p in parsed:
        ring = p.coordinates[0]
        assert p.feature_type == "Feature" and p.geometry_type == "Polygon"
        assert ring[0] == ring[-1] and len(ring) == 6
    # encoded once: the line is a JSON object, not a JSON string
    assert feats.first().feature.startswith("{")


def _even_odd(px, py, rings):
    inside = False
    for ring in rings:
        n = len(ring)
        for i in range(n):
            (x1, y1), (x2, y2) = ring[i], ring[(i + 1) % n]
            if (y1 > py) != (y2 > py) and px < (x2 - x1) * (py - y1) / (y2 - y1) + x1:
                inside = not inside
    return inside


def test_point_in_zone_matches_brute_force(spark):
    import random

    rnd = random.Random(7)
    zones, verts = {}, []
    for z in range(1, 9):                       # random star-shaped polygons, some overlapping
        cx, cy, r = rnd.uniform(0, 10), rnd.uniform(0, 10), rnd.uniform(0.5, 3)
        k = rnd.randint(3, 9)
        ring = []
        for i in range(k):
            a = 2 * math.pi * i / k
            rr = r * rnd.uniform(0.4, 1.0)
            ring.append((cx + rr * math.cos(a), cy + rr * math.sin(a)))
        zones[z] = [ring]
        verts += [(z, 0, i, vx, vy) for i, (vx, vy) in enumerate(ring)]
    pts = [(i, rnd.uniform(-1, 11), rnd.uniform(-1, 11)) for i in range(400)]
    # points exactly on tile boundaries (multiples of 0.5 and 0.2)
    pts += [(1000 + i, rnd.randint(0, 20) * 0.5, rnd.randint(0, 50) * 0.2) for i in range(200)]
    expect = {}
    for pid, px, py in pts:
        hits = [z for z, rings in zones.items() if _even_odd(px, py, rings)]
        expect[pid] = min(hits) if hits else None
    shapes = spatial.zone_shapes(spark.createDataFrame(verts, VSCHEMA))
    df = spark.createDataFrame(pts, "pid long, lon double, lat double")
    for most, broadcast in ((64, None), (3, True), (10, False)):
        got = {r.pid: r.locationid for r in spatial.assign_zone(
            df, shapes, max_edges=most, broadcast=broadcast).collect()}
        assert got == expect


def test_a_crowded_place_and_cell_are_spread(spark):
    # a third of all points stand on one spot, another third in one leaf
    pts = spark.range(3000).select(
        F.col("id").alias("pid"),
        F.when(F.col("id") % 3 == 0, F.lit(1.5)).when(F.col("id") % 3 == 1, F.lit(1.2) + F.col("id") / 1e5)
         .otherwise((F.col("id") % 40).cast("double")).alias("lon"),
        F.when(F.col("id") % 3 == 0, F.lit(1.5)).when(F.col("id") % 3 == 1, F.lit(1.2))
         .otherwise((F.col("id") % 13).cast("double")).alias("lat"))
    more = spark.createDataFrame([(5000, None, 1.0), (5001, float("nan"), 1.0), (5002, 0.0, 0.5), (5003, -0.0, 0.5),
                                  (5004, 1e300, 0.0), (5005, None, None)], "pid long, lon double, lat double")
    pts = materialize(pts.unionByName(more))
    shapes = spatial.zone_shapes(_zones(spark))
    b = spatial.assign_zone(pts, shapes, max_edges=6, broadcast=True)
    s = spatial.assign_zone(pts, shapes, max_edges=6, broadcast=False)
    assert b.exceptAll(s).count() == 0 and s.count() == 3006
    got = {r.pid: r.locationid for r in s.where("pid >= 5000").collect()}
    assert got[5002] == got[5003] == 1 and {got[i] for i in (5000, 5001, 5004, 5005)} == {None}
    # identical points are joined back by a broadcast, never by their one key
    tree = quadtree.build(shapes, max_edges=6)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = quadtree._looked_up(pts.select("pid", "lon", "lat"), tree, F.col("lon"), F.col("lat"), "z",
                               F.array_min, False)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    keyed = [line for line in plan.split("\n") if "hashpartitioning(_cell" in line]
    assert keyed and all("_salt" in line for line in keyed)
    salts = pts.where("pid < 3000 and pid % 3 = 1").select(F.pmod(F.xxhash64("lon", "lat"), F.lit(32)).alias("s"))
    assert salts.distinct().count() == 32          # a crowded leaf uses every task


def _wave(zone, ring, cx, cy, r, corners, folds):
    """A folded outline of many corners: dense, and seen from far away."""
    out = []
    for i in range(corners):
        a = 2 * math.pi * i / corners
        rr = r * (1 + 0.3 * math.sin(folds * a))
        out.append((zone, ring, i, cx + rr * math.cos(a), cy + rr * math.sin(a)))
    return out


@pytest.mark.parametrize("broadcast", [True, False])
def test_one_huge_zone_beside_small_ones(spark, broadcast):
    import random

    rnd = random.Random(11)
    verts = _wave(1, 0, 0.0, 0.0, 50.0, 4000, 40) + _wave(1, 1, 5.0, 5.0, 10.0, 500, 9)
    for z in range(2, 30):
        verts += _wave(z, 0, rnd.uniform(-40, 40), rnd.uniform(-40, 40), rnd.uniform(0.05, 0.4), 12, 3)
    rings = {}
    for z, ring, _, vx, vy in verts:
        rings.setdefault(z, {}).setdefault(ring, []).append((vx, vy))
    pts = [(i, rnd.uniform(-70, 70), rnd.uniform(-70, 70)) for i in range(250)]
    pts += [(1000 + i, vx + rnd.uniform(-.2, .2), vy + rnd.uniform(-.2, .2))
            for i, (_, _, _, vx, vy) in enumerate(rnd.sample(verts, 250))]
    pts += [(2000 + i, vx, vy) for i, (_, _, _, vx, vy) in enumerate(rnd.sample(verts, 100))]
    expect = {}
    for pid, px, py in pts:
        expect[pid] = sorted(z for z, rs in rings.items() if _even_odd(px, py, list(rs.values())))
    shapes = spatial.zone_shapes(spark.createDataFrame(verts, VSCHEMA))
    df = spark.createDataFrame(pts, "pid long, lon double, lat double")
    tree = quadtree.build(shapes, max_edges=16)
    got = {r.pid: r.z for r in quadtree.containing(df, tree, "lon", "lat", "z", broadcast=broadcast).collect()}
    assert got == expect and len({tuple(v) for v in expect.values()}) > 8 and len(tree.levels) > 1


def test_edges_on_each_other_are_not_cut_for_ever(spark):
    # fifty equal zones: no cell on their outline can hold few edges
    verts = [v for z in range(1, 51) for v in _square(z, 0, 1.0, 1.0, 3.0, 3.0)]
    tree = quadtree.build(spatial.zone_shapes(spark.createDataFrame(verts, VSCHEMA)), max_edges=8)
    assert tree.n_leaves < 2000
    pts = spark.createDataFrame([(1, 2.0, 2.0), (2, 0.0, 2.0), (3, 3.5, 2.0)], "pid long, lon double, lat double")
    got = {r.pid: len(r.z) for r in quadtree.containing(pts, tree, "lon", "lat", "z").collect()}
    assert got == {1: 50, 2: 0, 3: 0}


def test_leaves_hold_few_edges_and_their_copies_are_bounded(spark):
    shapes = spatial.zone_shapes(spark.createDataFrame(_wave(1, 0, 0.0, 0.0, 50.0, 6000, 40), VSCHEMA))
    tree = quadtree.build(shapes, max_edges=64)
    held = tree.leaves.where("cell >= 0").select(F.aggregate("candidates", F.lit(0), lambda n, c: (
        n + F.size(c["edges"]) + F.size(c["turns"]))).alias("n"))
    assert held.agg(F.max("n")).first()[0] <= 64 and held.count() == tree.n_leaves
    # an edge is in the few leaves it reaches, not in every cell of the outline
    assert tree.n_edges < 4 * 6000 and len(tree.levels) > 1


def test_empty_layer_and_no_points(spark):
    none = spatial.zone_shapes(spark.createDataFrame([], VSCHEMA))
    pts = spark.createDataFrame([(1, 0.0, 0.0)], "pid long, lon double, lat double")
    for broadcast in (True, False):
        assert [r.locationid for r in spatial.assign_zone(pts, none, broadcast=broadcast).collect()] == [None]
        assert spatial.assign_zone(pts.limit(0), spatial.zone_shapes(_zones(spark)), broadcast=broadcast).count() == 0


# --- zones of several parts ---------------------------------------------------

def _nested(spark):
    v = _square(1, 0, 3.0, 3.0, 4.0, 4.0)          # an island in the hole of ring 2
    v += _square(1, 1, 20.0, 0.0, 24.0, 4.0)[::-1]  # a second part, clockwise
    v += _square(1, 2, 0.0, 0.0, 10.0, 10.0)
    v += _square(1, 3, 2.0, 2.0, 8.0, 8.0)
    v += _square(1, 4, 20.0, 0.0, 22.0, 2.0)        # a hole that touches its shell's corner
    v += _square(2, 0, 1.0, 1.0, 9.0, 9.0)          # another zone, over the first
    v = [(z, r, i % 4, x, y) for i, (z, r, _, x, y) in enumerate(v)]
    return spark.createDataFrame(v, VSCHEMA)


def test_ring_nesting(spark):
    for broadcast in (True, False):
        got = {(r.locationid, r.ring): (r.part, r.hole, r.depth) for r in
               polygons.ring_parts(_nested(spark), broadcast).collect()}
        assert got == {(1, 0): (0, False, 2), (1, 1): (1, False, 0), (1, 2): (2, False, 0), (1, 3): (2, True, 1),
                       (1, 4): (1, True, 1), (2, 0): (0, False, 0)}
    for r in polygons.ring_parts(_nested(spark)).collect():
        pts = [(p.x, p.y) for p in r.v]
        area = sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(pts, pts[1:] + pts[:1])) / 2
        assert (area < 0) == r.hole


def test_multipart_zone_round_trips_as_geojson_and_wkt(spark):
    attrs = spark.createDataFrame([(1, "b", "z1"), (2, "b", "z2")], "locationid long, borough string, zone string")
    feats = polygons.zone_features(_nested(spark), attrs)
    got = {r.locationid: r for r in polygons.parse_features(feats.select(F.col("feature").alias("value"))).collect()}
    assert got[1].geometry_type == "MultiPolygon" and got[1].coordinates is None
    assert [[len(r) for r in p] for p in got[1].polygons] == [[5], [5, 5], [5, 5]]
    assert got[2].geometry_type == "Polygon" and len(got[2].coordinates) == len(got[2].polygons) == 1
    wkt = polygons.to_wkt(_nested(spark))
    text = {r.locationid: r.wkt for r in wkt.collect()}
    assert text[2].startswith("POLYGON ((1.0 1.0, ") and text[1].startswith("MULTIPOLYGON (((")
    back = polygons.wkt_vertices(polygons.read_wkt(wkt))
    assert {(r.locationid, r.part, r.ring) for r in back.collect()} == {
        (1, 0, 0), (1, 1, 1), (1, 1, 2), (1, 2, 3), (1, 2, 4), (2, 0, 0)}
    same = lambda v: {tuple(sorted([(r.x1, r.y1), (r.x2, r.y2)])) for r in spatial.polygon_edges(v).collect()}
    assert same(back) == same(_nested(spark))


@pytest.mark.parametrize("text, problem, parts", [
    ("POLYGON((0 0,1 0,1 1,0 0))", None, 1), ("polygon z ((0 0 5, 1 0 5, 1 1 5, 0 0 5))", None, 1),
    ("MULTIPOLYGON(((0 0,1 0,1 1,0 0)),((5 5,6 5,6 6,5 5),(5.1 5.1,5.2 5.1,5.2 5.2,5.1 5.1)))", None, 2),
    ("POLYGON ((-1e2 .5, 1.25E-3 0, 1 1., -1e2 .5))", None, 1), ("POLYGON EMPTY", None, 0),
    (None, "missing", None), ("", "not a polygon", None), ("LINESTRING (0 0, 1 1)", "not a polygon", None),
    ("POLYGON (0 0, 1 0, 1 1, 0 0)", "unbalanced", None), ("POLYGON ((0 0, 1 0, 1 1, 0 0)))", "unbalanced", None),
    ("POLYGON ((0 0, 1 0, 1 nan, 0 0))", "not a number", None), ("POLYGON ((0 0, 1, 1 1, 0 0))", "not a number", None),
    ("POLYGON ((0 0, (1 0), 1 1, 0 0))", "not a number", None), ("POLYGON (())", "not a number", None),
    ("POLYGON ((0 0, 1 0, 0 0))", "too few points", None), ("POLYGON ((0 0, 1 0, 1 1, 0 1))", "not closed", None),
])
def test_wkt_texts(spark, text, problem, parts):
    df = spark.createDataFrame([(1, text)], "locationid long, wkt string")
    r = polygons.read_wkt(df).first()
    assert r.problem == problem and (None if r.polygons is None else len(r.polygons)) == parts
    assert problem is None or problem in polygons.REASONS


def test_a_long_wkt_text(spark):
    n = 50_000
    pts = [f"{math.cos(2 * math.pi * i / n)!r} {math.sin(2 * math.pi * i / n)!r}" for i in range(n)]
    df = spark.createDataFrame([(1, f"POLYGON (({', '.join([*pts, pts[0]])}))")], "locationid long, wkt string")
    assert polygons.wkt_vertices(polygons.read_wkt(df)).count() == n
