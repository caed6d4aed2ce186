"""Tables that the registered queries start from."""

from pyspark.sql import functions as F

from checks import fixtures as fx
from tracewright.operators import spatial
from tracewright.sources import schema

SF = "/root/testdata/sf0.001"


def test_traces_are_those_of_the_samples_without_their_texts(spark):
    def shown(df):
        steps = F.transform("gold_trace", lambda s: F.struct(s.tool, F.to_json(s.args)))
        return sorted(map(str, df.select("id", "scenario_id", "sample_ord", "initial_state", steps, "expected").collect()))

    assert shown(fx.faulty_traces(spark, SF)) == shown(fx.faulty_samples(spark, SF))
    made = fx._faulty(spark, SF, fx._samples(spark, SF).select("id", "scenario_id", "sample_ord", "initial_state", "gold_trace", "expected"))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "struct<doc_id:bigint>" in plan and "text:string" not in plan


def test_points_are_read_once_for_the_vehicles_asked_for(spark):
    objects = spark.createDataFrame([("s", i, f"v{i}", "vehicle", f"v{i}", [], ("Point", [0.0, 0.0], None, None), None) for i in range(20)], schema.OBJECTS)
    scenarios = spark.createDataFrame([("s",)], "scenario_id string").withColumn("time", F.lit("2024-01-01").cast("timestamp"))
    points = spark.range(100).select(
        F.lit("s").alias("scenario_id"), F.concat(F.lit("v"), F.col("id") % 20).alias("object_id"), F.col("id").alias("pos"),
        F.lit("2024-01-01").cast("timestamp").alias("ts"), F.lit(0.0).alias("lon"), F.lit(0.0).alias("lat"),
    )
    asked = spark.createDataFrame([("s", "v3", "today"), ("s", "v3", None), ("s", "none", "today")], "scenario_id string, vehicle_id string, time_range string")
    found = spatial.vehicle_trajectory(asked, scenarios, objects, points)
    assert sorted((r.vehicle_id, r.time_range or "", r.pos) for r in found.collect()) == sorted(("v3", t, p) for t in ("", "today") for p in range(3, 100, 20))
    assert "Range (" not in found._jdf.queryExecution().executedPlan().toString()  # only what was written is joined
    nobody = spatial.vehicle_trajectory(asked.filter("vehicle_id = 'none'"), scenarios, objects, points)
    assert nobody.count() == 0
