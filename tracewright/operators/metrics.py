"""Funnel counts, rates, distributions and quotas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import percent_of
from .skew import pick_by_hash

STAGES = ["candidates", "schema_pass", "static_pass", "exec_pass", "assert_pass", "semantic_pass", "after_dedup", "final"]

# Samples wanted per difficulty, and the share of each task type in percent.
DIFFICULTY_QUOTAS = {"L0": 150, "L1": 150, "L2": 250, "L3": 200, "L4": 150, "L5": 100}
TASK_MIX = {
    "draw_vehicle_trajectory": 20,
    "show_object_info": 10,
    "highlight_selected_entity": 10,
    "objects_inside_polygon": 15,
    "objects_crossing_line": 10,
    "polygon_area / line_length": 10,
    "nearby_objects": 10,
    "artifact_modification": 10,
    "unsupported_or_ambiguous": 5,
}


def funnel(gated: DataFrame, kept: DataFrame) -> DataFrame:
    """One row of counts. `gated` has the cumulative gate columns, `kept` the deduplicated samples."""
    gates = ["schema_pass", "static_pass", "exec_pass", "assert_pass", "semantic_pass"]
    counts = gated.agg(F.count(F.lit(1)).alias("candidates"), *[F.count_if(g).alias(g) for g in gates])
    after = kept.agg(F.count(F.lit(1))).scalar()
    return counts.select("*", after.alias("after_dedup"), after.alias("final"))


def funnel_report(counts: DataFrame) -> DataFrame:
    """(stage, n, percent of candidates)."""
    rows = F.array(
        *[F.struct(F.lit(i).alias("step"), F.lit(s).alias("stage"), F.col(s).alias("n")) for i, s in enumerate(STAGES)]
    )
    return counts.select("candidates", F.inline(rows)).select(
        "step", "stage", "n", F.round(percent_of(F.col("n"), F.col("candidates")), 1).alias("percent")
    )


def quality_metrics(gated: DataFrame, stats: DataFrame) -> DataFrame:
    """Duplicate rate, mean steps per task, share of negatives that ask back without a trace."""
    negative = F.array_contains("tags", "negative")
    right = negative & F.col("expected.should_ask_clarification") & (F.size("gold_trace") == 0)
    base = gated.agg(
        F.round(F.avg(F.size("gold_trace")), 6).alias("mean_steps"),
        F.count_if(negative).alias("negatives"),
        F.round(percent_of(F.count_if(right), F.count_if(negative)), 6).alias("negative_correct_pct"),
        F.round(percent_of(F.count_if("semantic_pass"), F.count(F.lit(1))), 6).alias("acceptance_pct"),
    )
    rate = stats.select(percent_of(F.col("samples") - F.col("kept"), F.col("samples"))).scalar()
    return base.select("*", F.round(rate, 6).alias("duplicate_pct"))


def human_pass_rate(reviews: DataFrame) -> DataFrame:
    """reviews(id, review_status) -> share of finished reviews that passed."""
    done = F.col("review_status") != "pending"
    return reviews.agg(
        F.count_if(done).alias("reviewed"),
        F.round(percent_of(F.count_if(F.col("review_status") == "pass"), F.count_if(done)), 6).alias("pass_pct"),
    )


def distributions(samples: DataFrame) -> DataFrame:
    """Counts by task type, difficulty and language, with subtotals."""
    return samples.rollup("task_type", "difficulty", "language").agg(
        F.count(F.lit(1)).alias("n"), F.grouping_id().cast("int").alias("level")
    )


def pick_by_quota(samples: DataFrame, group: Column, quotas: dict[str, int], seed: str = "") -> DataFrame:
    """At most `quota` samples of each group, drawn by hash."""
    rows = [F.struct(F.lit(g).alias("_group"), F.lit(n).cast("bigint").alias("quota")) for g, n in quotas.items()]
    table = samples.sparkSession.range(1).select(F.inline(F.array(*rows)))
    grouped = samples.withColumn("_group", group)
    return pick_by_hash(grouped, "_group", table, F.concat("id", F.lit(seed))).drop("_group")


def pick_by_difficulty(samples: DataFrame, quotas: dict[str, int] | None = None, seed: str = "") -> DataFrame:
    return pick_by_quota(samples, F.col("difficulty"), quotas or DIFFICULTY_QUOTAS, seed)


def task_group(task_type: Column) -> Column:
    """Task type as listed in the mix: area and length share one entry."""
    return F.when(task_type.isin("polygon_area", "line_length"), "polygon_area / line_length").otherwise(task_type)


def pick_by_task_mix(samples: DataFrame, total: int, mix: dict[str, int] | None = None, seed: str = "") -> DataFrame:
    return pick_by_quota(samples, task_group(F.col("task_type")), mix_quotas(total, mix or TASK_MIX), seed)


def mix_quotas(total: int, mix: dict[str, int]) -> dict[str, int]:
    """`total` rows dealt out by percentages; what rounding down leaves goes to the largest remainders."""
    quotas = {name: total * share // 100 for name, share in mix.items()}
    left = total * sum(mix.values()) // 100 - sum(quotas.values())
    for name in sorted(mix, key=lambda n: -(total * mix[n] % 100))[:left]:
        quotas[name] += 1
    return quotas
