"""Documents, catalog, sinks, requests and synthetic worlds."""

import json
import math

import pytest
from pyspark.sql import functions as F

from tracewright.operators import conformance, lookup, multiturn, requests, spatial
from tracewright.plans.catalog import TOOLS
from tracewright.session import scratch_dir
from tracewright.sources import scenarios as docs
from tracewright.sources import schema, sinks, tables, worlds

WORLD = {
    "scenario_id": "traffic_synthetic_001",
    "coordinate_system": "EPSG:4326",
    "time": "2026-05-18T09:15:00+07:00",
    "objects": {
        "vehicles": [
            {"id": "vehicle_102", "type": "vehicle", "name": "Truck 102", "aliases": ["xe 102"],
             "geometry": {"type": "Point", "coordinates": [106.7001, 10.7762]}, "properties": {"speed_kmh": 42, "status": "moving"}},
        ],
        "cameras": [{"id": "camera_03", "type": "camera", "name": "Camera 03", "geometry": {"type": "Point", "coordinates": [106.701, 10.777]}}],
        "polygons": [
            {"id": "zone_07", "type": "polygon", "name": "Zone 07",
             "geometry": {"type": "Polygon", "coordinates": [[[106.699, 10.775], [106.703, 10.775], [106.703, 10.779], [106.699, 10.779], [106.699, 10.775]]]}},
        ],
        "lines": [{"id": "road_01", "type": "line", "name": "Road", "geometry": {"type": "LineString", "coordinates": [[106.7, 10.7], [106.8, 10.8]]}}],
    },
    "time_series": {
        "vehicle_102": {"trajectory": [
            {"timestamp": "2026-05-18T09:05:00+07:00", "coordinates": [106.7001, 10.7762]},
            {"timestamp": "2026-05-18T09:10:00+07:00", "coordinates": [106.7005, 10.7769]},
        ]},
    },
}


@pytest.fixture()
def world(spark, tmp_path):
    for name in ("b", "a"):
        text = json.dumps({**WORLD, "scenario_id": f"traffic_synthetic_{name}"}, indent=2)
        (tmp_path / f"{name}.json").write_text(text)
    return docs.read_documents(spark, str(tmp_path))


def test_documents_to_tables(world):
    scenarios = docs.scenario_table(world).orderBy("ord").collect()
    assert [(s.scenario_id[-1], s.ord) for s in scenarios] == [("a", "a.json"), ("b", "b.json")]
    assert str(scenarios[0].time) == "2026-05-18 02:15:00"
    objects = docs.object_table(world)
    assert objects.schema.simpleString() == objects.sparkSession.createDataFrame([], schema.OBJECTS).schema.simpleString()
    first = objects.filter(F.col("scenario_id").endswith("a")).orderBy("ord").collect()
    assert [o.type for o in first] == ["vehicle", "camera", "polygon", "line"]
    assert first[0].geom.pt == [106.7001, 10.7762] and first[0].props.speed_kmh == 42 and first[1].aliases == []
    assert len(first[2].geom.rings[0]) == 5 and first[3].geom.path[1] == [106.8, 10.8]
    points = docs.trajectory_table(world).orderBy("scenario_id", "pos").collect()
    assert [(p.pos, str(p.ts)) for p in points[:2]] == [(0, "2026-05-18 02:05:00"), (1, "2026-05-18 02:10:00")]


def test_example_world_queries(spark, world):
    objects, scenarios, traj = docs.object_table(world), docs.scenario_table(world), docs.trajectory_table(world)
    sid = "traffic_synthetic_a"
    inside = spatial.objects_inside_polygon(
        spark.createDataFrame([(sid, "zone_07", t) for t in ("vehicle", "camera")], "scenario_id string, polygon_id string, object_type string"), objects
    )
    assert sorted(r.id for r in inside.collect()) == ["camera_03", "vehicle_102"]
    path = spatial.vehicle_trajectory(
        spark.createDataFrame([(sid, "vehicle_102", "last_10_minutes"), (sid, "vehicle_102", "last_5_minutes"), (sid, "camera_03", "today")], "scenario_id string, vehicle_id string, time_range string"),
        scenarios, objects, traj,
    )
    assert sorted((r.time_range, r.pos) for r in path.collect()) == [("last_10_minutes", 0), ("last_10_minutes", 1), ("last_5_minutes", 1)]
    found = lookup.resolve_reference(
        spark.createDataFrame([(1, sid, " XE 102 ", None), (2, sid, "xe 102", "camera"), (3, sid, "Zone 07", "polygon")], "query_id int, scenario_id string, reference string, expected_type string"),
        objects,
    )
    assert {r.query_id: (r.entity_id, r.confidence) for r in found.collect()} == {1: ("vehicle_102", 1.0), 2: (None, 0.0), 3: ("zone_07", 1.0)}


def test_last_object_of_an_id_wins(spark):
    rows = [("s", 1, "x", "vehicle", "old", [], None, None), ("s", 2, "y", "camera", "y", [], None, None), ("s", 3, "x", "camera", "new", [], None, None)]
    got = lookup.by_id(spark.createDataFrame(rows, schema.OBJECTS)).orderBy("ord").collect()
    assert [(o.ord, o.id, o.name, o.type) for o in got] == [(1, "x", "new", "camera"), (2, "y", "y", "camera")]


def test_large_scenarios_are_split_into_documents(spark):
    plan = worlds.world_plan(spark.range(1, 5).select(F.col("id").alias("i")))
    objects, traj = worlds.objects(plan), worlds.trajectories(plan)
    made = docs.to_documents(plan, objects, traj, rows_per_part=15)
    assert made.filter("part > 0").count() > 0
    assert made.select(F.max(F.size("objects.vehicles"))).first()[0] <= 15
    out = scratch_dir(spark)
    docs.write_documents(made, out)
    read = docs.read_documents(spark, out, one_per_file=False)
    drop = ["ord", "pos"]
    for mine, want in [(docs.object_table(read), objects), (docs.trajectory_table(read), traj)]:
        mine = mine.drop(*drop).select([F.to_json(F.struct("*"))])
        want = want.drop(*drop).select([F.to_json(F.struct("*"))])
        assert mine.exceptAll(want).count() == 0 and want.exceptAll(mine).count() == 0
    order = docs.trajectory_table(read).join(traj.withColumnRenamed("pos", "was").select("scenario_id", "object_id", "ts", "was"), ["scenario_id", "object_id", "ts"])
    lists = order.groupBy("scenario_id", "object_id").agg(F.array_sort(F.collect_list(F.struct("pos", "was"))).alias("l")).collect()
    assert all([x.was for x in r.l] == sorted(x.was for x in r.l) for r in lists)


def test_catalog_document(spark, tmp_path):
    tools = [
        {
            "name": name, "description": "", "category": t.category, "side_effects": t.side_effects,
            "parameters": [{"name": p.name, "type": p.type, "required": p.required, "enum": p.enum} for p in t.params],
        }
        for name, t in TOOLS.items()
    ]
    (tmp_path / "c.json").write_text(json.dumps({"version": "v", "tools": tools}, indent=1))
    read = tables.read_catalog(spark, str(tmp_path / "c.json"))
    assert read.count() == sum(max(len(t.params), 1) for t in TOOLS.values())
    mine = conformance.tool_params_table(spark)
    same = read.filter("param is not null").select(*mine.columns)
    assert same.exceptAll(mine).count() == 0 and mine.exceptAll(same).count() == 0
    assert len(TOOLS) == 16


def test_sinks(spark):
    out = scratch_dir(spark)
    df = spark.createDataFrame([("a", None, 1, "train"), ("b", "x", 2, "test_easy")], "id string, note string, _tmp int, split string")
    sinks.write_dataset(df, out)
    lines = [r.value for r in spark.read.text(out).collect()]
    assert sorted(lines) == ['{"id":"a","note":null}', '{"id":"b","note":"x"}']
    assert {r.split for r in spark.read.json(out).select("split").collect()} == {"train", "test_easy"}
    sinks.write_metrics(spark.createDataFrame([(3, 2)], "candidates int, final int"), out + "-m")
    assert spark.read.text(out + "-m").first().value == '{"candidates":3,"final":2}'


def test_review_queue_and_responses(spark):
    out = scratch_dir(spark)
    sinks.write_review_queue(spark.createDataFrame([("a", None, "pending")], "id string, tags array<string>, review_status string"), out)
    assert spark.read.text(out).first().value == '{"id":"a","tags":null,"review_status":"pending"}'
    answers = spark.createDataFrame([("r", "verdict", 1, "{}")], tables.RESPONSES)
    for file_format in ("parquet", "json"):
        path = f"{out}-{file_format}"
        answers.write.format(file_format).save(path)
        assert tables.read_responses(spark, path, file_format).collect() == answers.collect()


def test_render_does_not_rescan_values(spark):
    df = spark.createDataFrame([("{b}", "x")], "a string, b string")
    text = requests.render('{a} and {b}, {"utterances": []}', a=F.col("a"), b=F.col("b"))
    assert df.select(text).first()[0] == '{b} and x, {"utterances": []}'


def test_long_conversations_stay_in_one_row(spark):
    turns = spark.range(1000).select(F.lit("c").alias("id"), F.col("id").alias("turn"), F.col("id").cast("string").alias("user"))
    rows = multiturn.nest_turns(turns.repartition(7)).collect()
    assert len(rows) == 1
    assert [(t.turn, t.user) for t in rows[0].turns] == [(i, str(i)) for i in range(1000)]


def test_worlds(spark):
    plan = worlds.world_plan(spark.range(1, 11).select(F.col("id").alias("i")))
    tiers = [r.tier for r in plan.orderBy("ord").collect()]
    assert tiers == ["small"] * 3 + ["medium"] * 5 + ["large"] * 2
    objects, traj = worlds.objects(plan), worlds.trajectories(plan)
    again = worlds.objects(plan.repartition(7))
    assert objects.select("id", "name", "geom.pt").exceptAll(again.select("id", "name", "geom.pt")).count() == 0
    other = worlds.objects(plan, seed=1)
    assert objects.select("scenario_id", "id", "geom.pt").join(other.select("scenario_id", "id", "geom.pt"), ["scenario_id", "id", "pt"]).count() == 0
    for o in objects.filter("type = 'vehicle'").collect():
        assert 20 <= o.props.speed_kmh <= 80 and 106.62 <= o.geom.pt[0] <= 106.75 and 10.75 <= o.geom.pt[1] <= 10.85
        assert o.aliases[2] == f"xe {o.id[-3:]}" and o.name.endswith(o.id[-3:])
    areas = spatial.polygon_area(objects).collect()
    assert all(300 * 300 * 0.98 <= a.area_sqm <= 800 * 800 * 1.02 for a in areas)
    for length in spatial.line_length(objects).collect():
        assert 400 <= length.length_meters <= 1700
    by_vehicle = {}
    for p in traj.collect():
        by_vehicle.setdefault((p.scenario_id, p.object_id), []).append(p)
    starts = {(o.scenario_id, o.id): tuple(o.geom.pt) for o in objects.filter("type = 'vehicle'").collect()}
    assert set(starts) == set(by_vehicle)
    for key, points in by_vehicle.items():
        points.sort(key=lambda p: p.pos)
        assert [str(p.ts) for p in points] == [f"2026-05-18 0{1 + (45 + 5 * i) // 60}:{(45 + 5 * i) % 60:02d}:00" for i in range(6)]
        assert (points[0].lon, points[0].lat) == starts[key]
        steps = [math.dist((a.lon, a.lat), (b.lon, b.lat)) for a, b in zip(points, points[1:])]
        assert max(steps) - min(steps) < 0.002
    normal = spark.range(20000).select(worlds.Draw(F.col("id")).normal("z").alias("z")).agg(F.avg("z"), F.stddev("z")).first()
    assert abs(normal[0]) < 0.05 and abs(normal[1] - 1) < 0.05


def test_plan_pages_are_kept_once_per_scenario(spark):
    """Many requests of one scenario: the ids are not repeated for each of them."""
    things = spark.createDataFrame([("s", i, f"v{i}") for i in range(7)], "scenario_id string, ord bigint, id string")
    asked = spark.createDataFrame([(w, i, "t") for w in ("s", "empty") for i in range(20)], "scenario_id string, bp_ord int, task_type string")
    heads = requests.plan_requests(asked).collect()
    pages = sorted((r.scenario_id, r.page, r.text) for r in requests.plan_pages(asked, things, page_size=3).collect())
    assert len(heads) == 40 and {r.request_id for r in heads} == {f"plan|{w}|{i}" for w in ("s", "empty") for i in range(20)}
    assert not any('"v1"' in r.text for r in heads)
    assert pages == [
        ("empty", 0, "\nIds, page 1: []"),
        ("s", 0, '\nIds, page 1: ["v0","v1","v2"]'),
        ("s", 1, '\nIds, page 2: ["v3","v4","v5"]'),
        ("s", 2, '\nIds, page 3: ["v6"]'),
    ]
