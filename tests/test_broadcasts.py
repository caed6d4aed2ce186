"""Tables that are large, though the planner takes them for small, do not pass through the driver."""

from pyspark.sql import functions as F

from tracewright.operators import lookup, spatial
from tracewright.session import materialize


def _plan(df):
    counted = df.agg(F.count(F.lit(1)).alias("n"))
    n = counted.collect()[0].n
    return n, counted._jdf.queryExecution().executedPlan().toString()


def test_objects_made_from_one_column_are_not_broadcast(spark):
    keys = materialize(spark.range(300_000))  # a file of one or two MB, objects of over 20 MB
    objects = keys.select(
        F.concat(F.lit("traffic_synthetic_"), F.col("id") % 25).alias("scenario_id"),
        F.concat(F.lit("road_"), F.col("id").cast("string")).alias("id"),
        F.lit("line").alias("type"),
        F.col("id").alias("ord"),
    )
    n, plan = _plan(lookup.found_by_id(objects, "line"))
    assert n == 300_000
    assert "BroadcastExchange" not in plan


def test_what_is_measured_as_small_is_still_broadcast(spark):
    keys = materialize(spark.range(300_000))
    few = keys.filter("id % 1000 = 0").withColumnRenamed("id", "other")
    n, plan = _plan(keys.join(few, F.col("id") == F.col("other")))
    assert n == 300
    assert "BroadcastHashJoin" in plan


def test_paths_are_compared_by_id_before_their_geometry(spark):
    """Each pair of paths would be tested twice otherwise."""
    path = F.array(*[F.array(F.lit(106.62) + F.col("id") * x, F.lit(10.75) + F.col("id") % 3 * x) for x in (0.0001, 0.0002)])
    paths = spark.range(60).select(F.lit("s").alias("k"), F.format_string("p%02d", "id").alias("id"), path.alias("path"))
    _, plan = _plan(spatial.meeting_paths(paths, ["k"]))
    joined = next(line for line in plan.splitlines() if "SortMergeJoin" in line)
    condition = joined[joined.index("Inner") :]
    assert 0 < condition.index("one#") < condition.index("_one#")
