"""Spatial operators against plain Python over all pairs."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tracewright.functions import geo
from tracewright.operators import grid, spatial
from tracewright.sources import schema

SQUARE = [[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 1.0], [0.0, 0.0]]
# Not convex: a square with a notch cut in from the top.
NOTCHED = [[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [2.0, 1.0], [0.0, 4.0], [0.0, 0.0]]


def obj(sid, oid, kind, pt=None, path=None, rings=None):
    shape = "Point" if pt else "LineString" if path else "Polygon"
    return (sid, abs(hash(oid)) % 10**9, oid, kind, oid.upper(), [], (shape, pt, path, rings), None)


def table(spark, rows):
    return spark.createDataFrame(rows, schema.OBJECTS)


def metres(x1, y1, x2, y2):
    a, b = math.radians(y1), math.radians(y2)
    h = math.sin((b - a) / 2) ** 2 + math.cos(a) * math.cos(b) * math.sin(math.radians(x2 - x1) / 2) ** 2
    return 2 * 6371000 * math.asin(math.sqrt(h))


@pytest.mark.parametrize(
    "ring, x, y, inside",
    [
        (SQUARE, 0.5, 0.5, True),
        (SQUARE, 1.0, 0.5, False),
        (SQUARE, 0.0, 0.0, False),
        (SQUARE, 1.5, 0.5, False),
        (SQUARE[:4], 0.5, 0.5, True),
        (NOTCHED, 2.0, 2.0, False),
        (NOTCHED, 0.5, 2.0, True),
        (NOTCHED, 2.0, 1.0, False),
        (NOTCHED, 3.0, 1.0, True),
    ],
)
def test_point_in_polygon(spark, ring, x, y, inside):
    df = spark.createDataFrame([([ring], x, y)], "rings array<array<array<double>>>, x double, y double")
    assert df.select(geo.point_in_polygon(F.col("rings"), F.col("x"), F.col("y"))).first()[0] is inside


@pytest.mark.parametrize(
    "a, b, meet",
    [
        ([[0, 0], [2, 2]], [[0, 2], [2, 0]], True),
        ([[0, 0], [1, 1]], [[1, 1], [2, 0]], True),
        ([[0, 0], [2, 0]], [[1, 0], [3, 0]], True),
        ([[0, 0], [1, 0]], [[2, 0], [3, 0]], False),
        ([[0, 0], [1, 1]], [[0, 1], [0.4, 0.6]], False),
        ([[0, 0], [2, 0]], [[1, 0], [1, 5]], True),
        ([[0, 0], [1, 0], [1, 1]], [[2, 2], [0.5, 0.5]], True),  # through the corner (1, 1)
        ([[0, 0], [1, 0], [1, 1]], [[2, 2], [0.5, 1.1]], False),
        ([[0, 0], [1, 0], [1, 1]], [[2, 0.5], [0.5, 0.5]], True),
    ],
)
def test_paths_meet(spark, a, b, meet):
    row = [[[float(v) for v in p] for p in path] for path in (a, b)]
    df = spark.createDataFrame([tuple(row)], "a array<array<double>>, b array<array<double>>")
    assert df.select(geo.paths_meet(F.col("a"), F.col("b"))).first()[0] is meet


def test_area_and_length(spark):
    ring = [[106.7, 10.77], [106.71, 10.77], [106.71, 10.78], [106.7, 10.78], [106.7, 10.77]]
    rows = [obj("s", "z", "polygon", rings=[ring]), obj("s", "l", "line", path=ring[:3])]
    objects = table(spark, rows)
    mean = sum(p[1] for p in ring) / 5
    area = 0.01 * 0.01 * 111320 * 111320 * math.cos(math.radians(mean))
    assert spatial.polygon_area(objects).first().area_sqm == pytest.approx(area, abs=0.02)
    length = metres(*ring[0], *ring[1]) + metres(*ring[1], *ring[2])
    assert spatial.line_length(objects).first().length_meters == pytest.approx(length, abs=0.01)


def test_inside_polygons_of_all_sizes(spark):
    random.seed(7)
    points = [(f"v{i}", random.uniform(-1, 1), random.uniform(-1, 1)) for i in range(300)]
    zones = []
    for i in range(40):
        x, y, r = random.uniform(-1, 1), random.uniform(-1, 1), 10 ** random.uniform(-3, 0.3)
        corners = [[x + r * math.cos(t), y + r * math.sin(t) * random.uniform(0.5, 1)] for t in (0, 1.2, 2.5, 3.9, 5.1)]
        zones.append((f"z{i}", corners + [corners[0]]))

    def inside(ring, x, y):
        hit = False
        for (ax, ay), (bx, by) in zip(ring, ring[1:]):
            if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                hit = not hit
        return hit

    objects = table(
        spark,
        [obj("s", n, "vehicle", pt=[x, y]) for n, x, y in points] + [obj("s", n, "polygon", rings=[r]) for n, r in zones],
    )
    ask = spark.createDataFrame([("s", n, "vehicle") for n, _ in zones], "scenario_id string, polygon_id string, object_type string")
    got = {(r.polygon_id, r.id) for r in spatial.objects_inside_polygon(ask, objects).collect()}
    want = {(z, p) for z, ring in zones for p, x, y in points if inside(ring, x, y)}
    assert got == want and len(want) > 300


@pytest.mark.parametrize("centre", [(106.7, 10.8), (179.995, 5.0), (-179.99, -60.0), (20.0, 89.9)])
@pytest.mark.parametrize("radius", [0.0, 900.0, 60_000.0])
def test_nearby_anywhere_on_the_globe(spark, centre, radius):
    random.seed(3)

    def near():
        y = max(-90.0, min(90.0, centre[1] + random.gauss(0, 0.3)))
        x = centre[0] + random.gauss(0, 0.3) / max(math.cos(math.radians(centre[1])), 0.01)
        return ((x + 540) % 360 - 180, y)

    points = [(f"c{i}", *near()) for i in range(200)] + [("twin", *centre)]
    objects = table(spark, [obj("s", "me", "camera", pt=list(centre))] + [obj("s", n, "camera", pt=[x, y]) for n, x, y in points])
    ask = spark.createDataFrame([("s", "me", "camera", radius)], "scenario_id string, object_id string, object_type string, radius_meters double")
    got = {r.id for r in spatial.nearby_objects(ask, objects).collect()}
    assert got == {n for n, x, y in points if metres(*centre, x, y) <= radius}
    assert "twin" in got


@pytest.mark.parametrize("radius", [0.0, 1.0, 40.0, 900.0, 60_000.0, 5_000_000.0])
def test_circles_cover_few_cells_everywhere(spark, radius):
    lats = [0.0, 10.8, 60.0, 89.0, 89.9, 89.9995, 90.0, -89.9995]
    rows = [(lat, lon, radius) for lat in lats for lon in (0.0, 179.9999, -180.0)]
    circles = spark.createDataFrame(rows, "lat double, lon double, r double")
    boxed = circles.select("*", F.explode(spatial._circle_boxes(F.col("lon"), F.col("lat"), F.col("r"))).alias("_box"))
    cells = grid.with_box_cells(boxed, grid.box_level(F.col("_box"))).groupBy("lat", "lon").count()
    assert cells.select(F.max("count")).first()[0] <= 50


def test_crossing_uses_the_points_left_after_the_filter(spark):
    random.seed(5)
    minutes = {"last_10_minutes": 10, "last_1_hour": 60, "whatever": 10}
    lines = {f"l{i}": [[random.uniform(0, 1), random.uniform(0, 1)] for _ in range(random.choice([2, 3]))] for i in range(12)}
    # Times are not in list order: the path follows the list.
    paths = {
        f"v{i}": [(random.randint(0, 90), random.uniform(0, 1) * 10 ** random.uniform(-2, 0), random.uniform(0, 1)) for _ in range(12)]
        for i in range(10)
    }

    def meets(p, q):
        def side(a, b, c):
            return (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])

        return any(
            side(a, b, c) * side(a, b, d) <= 0 and side(c, d, a) * side(c, d, b) <= 0
            for a, b in zip(p, p[1:])
            for c, d in zip(q, q[1:])
        )

    objects = table(
        spark,
        [obj("s", n, "line", path=p) for n, p in lines.items()] + [obj("s", n, "vehicle", pt=[0.0, 0.0]) for n in paths],
    )
    scenarios = spark.sql("select 's' scenario_id, 1 ord, timestamp'2024-01-01 12:00:00' time")
    traj = spark.createDataFrame(
        [("s", n, i, m, x, y) for n, p in paths.items() for i, (m, x, y) in enumerate(p)],
        "scenario_id string, object_id string, pos bigint, m int, lon double, lat double",
    ).withColumn("ts", F.expr("timestamp'2024-01-01 12:00:00' - make_dt_interval(0, 0, m)"))
    ask = spark.createDataFrame(
        [("s", n, "vehicle", r) for n in lines for r in minutes], "scenario_id string, line_id string, object_type string, time_range string"
    )
    got = {(r.line_id, r.time_range, r.id) for r in spatial.objects_crossing_line(ask, scenarios, objects, traj).collect()}
    want = set()
    for r, m in minutes.items():
        for n, p in paths.items():
            left = [(x, y) for t, x, y in p if t <= m]
            want |= {(line, r, n) for line, path in lines.items() if len(left) >= 2 and meets(path, left)}
    assert got == want and want


def test_targets_are_the_last_objects_of_their_ids(spark):
    ring = lambda x: [[[x, 0.0], [x + 1.0, 0.0], [x + 1.0, 1.0], [x, 1.0], [x, 0.0]]]
    rows = [
        obj("s", "z", "polygon", rings=ring(50.0)), obj("s", "z", "polygon", rings=ring(0.0)),
        obj("s", "was", "polygon", rings=ring(0.0)), obj("s", "was", "camera", pt=[80.0, 0.0]),
        obj("s", "c", "camera", pt=[0.5, 0.5]), obj("s", "c", "camera", pt=[50.5, 0.5]), obj("s", "d", "camera", pt=[50.5, 0.5]),
    ]
    objects = table(spark, [(r[0], i, *r[2:]) for i, r in enumerate(rows)])
    ask = spark.createDataFrame([("s", i, "camera") for i in ("z", "was")], "scenario_id string, polygon_id string, object_type string")
    assert [(r.polygon_id, r.id) for r in spatial.objects_inside_polygon(ask, objects).collect()] == [("z", "c")]
    near = spark.createDataFrame([("s", "c", "camera", 10.0)], "scenario_id string, object_id string, object_type string, radius_meters double")
    assert [r.id for r in spatial.nearby_objects(near, objects).collect()] == ["d"]


def test_rectangles_take_no_edges(spark):
    """A box is recognised closed or open; there-and-back rings and slanted ones are none."""
    there_and_back = [[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [1.0, 0.0], [0.0, 0.0]]
    rings = [SQUARE, SQUARE[:4], NOTCHED, there_and_back, [[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]], None, []]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rings)], "i int, ring array<array<double>>")
    got = [r[0] for r in df.orderBy("i").select(geo.is_box(F.col("ring"))).collect()]
    assert got == [True, True, False, False, False, False, False]
    objects = table(spark, [obj("s", "v", "vehicle", pt=[0.5, 0.5]), obj("s", "w", "vehicle", pt=[1.0, 0.5])]
                    + [obj("s", f"z{i}", "polygon", rings=[r]) for i, r in enumerate(rings[:4])])
    ask = spark.createDataFrame([("s", f"z{i}", "vehicle") for i in range(4)], "scenario_id string, polygon_id string, object_type string")
    got = {(r.polygon_id, r.id) for r in spatial.objects_inside_polygon(ask, objects).collect()}
    assert got == {("z0", "v"), ("z1", "v"), ("z2", "v"), ("z2", "w")}


def test_meeting_paths_of_all_sizes(spark):
    random.seed(5)
    paths = []
    for i in range(60):
        x, y, r = random.uniform(0, 1), random.uniform(0, 1), 10 ** random.uniform(-2.5, -0.3)
        paths.append((f"p{i:02}", [[x + r * random.uniform(-1, 1), y + r * random.uniform(-1, 1)] for _ in range(4)]))
    df = spark.createDataFrame([("k", n, p) for n, p in paths], "k string, id string, path array<array<double>>")
    other = df.select(F.col("id").alias("other"), F.col("path").alias("b"))
    want = df.join(other, F.col("id") < F.col("other")).filter(geo.paths_meet(F.col("path"), F.col("b")))
    got = sorted((r.one, r.other) for r in spatial.meeting_paths(df, ["k"]).collect())
    assert got == sorted((r.id, r.other) for r in want.collect()) and len(got) > 20


def test_cells_of_a_small_table_are_not_broadcast(spark):
    """One step as long as a map becomes many cells; to the planner its table stays small."""
    import contextlib
    import io

    ones = spark.range(10).select(F.col("id").alias("n"), F.lit("k").alias("k"), F.struct(*[F.lit(0.5).alias(c) for c in ("ax", "ay", "bx", "by")]).alias("_one"))
    pairs = spatial.meeting_segments(ones, ones.withColumnsRenamed({"n": "m", "_one": "_other"}), ["k"], ["n"], ["m"])
    with contextlib.redirect_stdout(io.StringIO()) as plan:
        pairs.explain()
    assert "SortMergeJoin" in plan.getvalue() and "BroadcastHashJoin" not in plan.getvalue()
    assert pairs.count() == 100
