"""Searches counted and probed without listing what they find."""

from pyspark.sql import functions as F

from tracewright.operators import lookup
from tracewright.operators import trace_audit as audit
from tracewright.sources import schema

TRAJ = "scenario_id string, object_id string, pos bigint, ts timestamp, lon double, lat double"
RING = [[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 1.0], [0.0, 0.0]]


def _point(n, oid, x):
    return ("s", n, oid, "vehicle", oid, [], ("Point", [x, 0.5], None, None), None)


def test_sizes_and_hits_without_lists(spark):
    zone = ("s", 9, "z", "polygon", "z", [], ("Polygon", None, None, [RING]), None)
    spread = [_point(i, f"v{i}", 0.1 + 0.1 * i) for i in range(5)] + [_point(7, "out", 2.0)]
    scenarios = spark.createDataFrame([("s",)], "scenario_id string").withColumn("time", F.lit("2024-01-01").cast("timestamp"))
    traj = spark.createDataFrame([], TRAJ)
    columns = "scenario_id string, tool string, object_id string, object_type string, radius_meters double, time_range string"
    tool = "get_objects_inside_polygon"
    asked = spark.createDataFrame([("s", tool, "z", "vehicle", None, None)], columns).withColumn("key", audit.search_key())
    for more, n in [([], 5), ([_point(8, "v1", 0.3)], 5)]:  # two objects with one id count once
        objects = spark.createDataFrame([*spread, *more, zone], schema.OBJECTS)
        sizes = audit.keyed_sizes(asked, scenarios, objects, traj).collect()
        assert [(r.key, r.n) for r in sizes] == [(asked.first().key, n)]
        probes = asked.withColumn("result_id", F.explode(F.array(*[F.lit(x) for x in ("v1", "v4", "out", "nobody")])))
        hits = audit.keyed_hits(probes, scenarios, objects, traj)
        assert sorted(r.result_id for r in hits.collect()) == ["v1", "v4"]
        nothing = audit.keyed_hits(probes.filter("false"), scenarios, objects, traj)
        assert nothing.count() == 0


def test_results_come_with_who_asks(spark):
    """One search of two traces: both get what it finds, without a join of results with those who ask."""
    zone = ("s", 9, "z", "polygon", "z", [], ("Polygon", None, None, [RING]), None)
    objects = spark.createDataFrame([*[_point(i, f"v{i}", 0.1 + 0.1 * i) for i in range(3)], _point(7, "out", 2.0), zone], schema.OBJECTS)
    scenarios = spark.createDataFrame([("s",)], "scenario_id string").withColumn("time", F.lit("2024-01-01").cast("timestamp"))
    columns = "id string, pos int, scenario_id string, tool string, object_id string, object_type string, radius_meters double, time_range string"
    asked = [("a", 1, "s", "get_objects_inside_polygon", "z", "vehicle", None, None), ("b", 4, "s", "get_objects_inside_polygon", "z", "vehicle", None, None)]
    asked.append(("b", 2, "s", "get_nearby_objects", "v0", "vehicle", 20_000.0, None))
    found = audit.shown_results(spark.createDataFrame(asked, columns), scenarios, objects, spark.createDataFrame([], TRAJ))
    inside = [(i, p, v) for i, p in (("a", 1), ("b", 4)) for v in ("v0", "v1", "v2")]
    assert sorted(map(tuple, found.collect())) == sorted([*inside, ("b", 2, "v1")])


def test_only_texts_asked_for_are_indexed(spark):
    objects = spark.createDataFrame([_point(i, f"v{i}", 0.1) for i in range(50)], schema.OBJECTS)
    asked = spark.createDataFrame([("s", "v7", ""), ("s", "nobody", "")], "scenario_id string, _key string, _wanted string")
    got = lookup.reference_index(objects, asked).collect()
    assert {r._key for r in got} == {"v7"} and {r._hit.id for r in got} == {"v7"}
