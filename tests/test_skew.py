"""Hot keys: same results as the plain operator, and no task with a whole hot group."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tracewright.operators.skew import block_join, first_rows, pick_by_hash, with_next


def test_block_join_equals_join(spark):
    left = spark.range(400).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7).alias("k"), F.col("id").alias("a"))
    right = spark.range(300).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 9).alias("k"), F.col("id").alias("b"))
    cut = block_join(left, right, ["k"], ["a"], ["b"], block_rows=20)
    assert cut.columns == ["k", "a", "b"]
    plain = left.join(right, "k")
    assert cut.count() == plain.count()
    assert cut.exceptAll(plain).count() == 0


@pytest.fixture()
def no_broadcast(spark):
    """Join strategies as for tables too large to broadcast."""
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = {k: spark.conf.get(k, None) for k in names}
    for k in names:
        spark.conf.set(k, "-1")
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_block_join_spreads_a_hot_key(spark, no_broadcast):
    # One key only, written so that the optimizer does not know it.
    one = F.floor(F.col("id") / 10**6).alias("k")
    left = spark.range(1000).select(one, F.col("id").alias("a"))
    right = spark.range(1000).select(one, F.col("id").alias("b"))
    cut = block_join(left, right, ["k"], ["a"], ["b"], block_rows=100)
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" in plan and "_l" in plan and "_r" in plan
    assert cut.count() == 1_000_000


def test_adaptive_skew_join_cuts_hot_lookup(spark, no_broadcast):
    keep = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    before = {k: spark.conf.get(k, None) for k in keep}
    for k, v in keep.items():
        spark.conf.set(k, v)
    try:
        facts = spark.range(0, 300_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("k"), F.col("id").alias("v")
        )
        table = spark.range(5000).select(F.col("id").alias("k"), F.lit("x").alias("w"))
        joined = facts.join(table, "k", "left").filter(F.col("w") == "x")
        assert len(joined.collect()) == 300_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_with_next_across_blocks(spark):
    random.seed(1)
    rows = [(g, p, p * 10) for g in "ab" for p in random.sample(range(500), 80)] + [("c", 3, 30)]
    df = spark.createDataFrame(rows, "g string, p bigint, v bigint")
    got = with_next(df, ["g"], "p", ["v"], block_rows=7).select("g", "p", F.col("next.v").alias("n"))
    want = df.select("g", "p", F.lead("v").over(Window.partitionBy("g").orderBy("p")).alias("n"))
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)


def test_pick_by_hash_takes_the_smallest(spark):
    df = spark.range(2000).select(F.col("id"), (F.col("id") % 3).alias("g"))
    quotas = spark.createDataFrame([(0, 10), (1, 0), (2, 5000)], "g bigint, quota bigint")
    got = {tuple(r) for r in pick_by_hash(df, "g", quotas, F.col("id").cast("string"), prefix_digits=1).collect()}
    w = Window.partitionBy("g").orderBy(F.sha2(F.col("id").cast("string"), 256))
    want = df.withColumn("r", F.row_number().over(w)).join(quotas, "g").filter("r <= quota").select("id", "g")
    assert got == {tuple(r) for r in want.collect()}


def test_first_rows_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("k"), F.col("id").alias("o"))
    top = first_rows(df, ["k"], "o", 2)
    assert sorted(r.o for r in top.collect()) == [0, 1, 2, 3]
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_mix_quotas_deal_out_every_row():
    from tracewright.operators.metrics import mix_quotas

    quotas = mix_quotas(107, {"a": 34, "b": 33, "c": 33})
    assert sum(quotas.values()) == 107 and quotas == {"a": 37, "b": 35, "c": 35}


def test_last_object_of_an_id_counts(spark):
    from tracewright.operators import lookup

    rows = [("s", "v1", "vehicle", 1), ("s", "v1", "camera", 5), ("s", "v2", "vehicle", 2)]
    objects = spark.createDataFrame(rows, "scenario_id string, id string, type string, ord long")
    assert {(r.id, r.type) for r in lookup.types_by_id(objects).collect()} == {("v1", "camera"), ("v2", "vehicle")}
    asked = spark.createDataFrame([(1, "s", "v1", "camera"), (2, "s", "v1", "vehicle")], "query_id long, scenario_id string, object_id string, required_type string")
    assert [(r.query_id, r.error) for r in lookup.reference_errors(asked, objects).collect()] == [(2, "type_mismatch")]


def test_pick_by_hash_keeps_rows_where_they_are(spark):
    df = spark.range(2000).select(F.col("id"), (F.col("id") % 2).alias("g"), F.lit("x").alias("wide"))
    quotas = spark.createDataFrame([(0, 10), (1, 20)], "g bigint, quota bigint")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        picked = pick_by_hash(df, "g", quotas, F.col("id").cast("string"))
        plan = picked._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 2  # of the histogram with the quotas, once per part of the union; never of all rows
        assert picked.count() == 30
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
