"""Train / dev / test by scenario, so that no scenario is in two of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import scenario_number


def split_bounds(scenario_count: Column, train_frac: float = 0.8, dev_frac: float = 0.1) -> tuple[Column, Column]:
    """Last scenario number of train and of dev."""
    train_end = (scenario_count * F.lit(train_frac)).cast("int")
    return train_end, train_end + (scenario_count * F.lit(dev_frac)).cast("int")


def split_ranges(scenarios: DataFrame, train_frac: float = 0.8, dev_frac: float = 0.1) -> DataFrame:
    """Scenario number ranges (split, first, last) for the scenarios at hand."""
    n = F.col("_n")
    train_end, dev_end = split_bounds(n, train_frac, dev_frac)
    def span(split: str, first: Column, last: Column) -> Column:
        return F.struct(
            F.lit(split).alias("split"), first.cast("bigint").alias("first"), last.cast("bigint").alias("last")
        )

    rows = F.array(
        span("train", F.lit(1), train_end), span("dev", train_end + 1, dev_end), span("test", dev_end + 1, n)
    )
    return scenarios.agg(F.count(F.lit(1)).alias("_n")).select(F.inline(rows))


def bucket(scenario_id: Column, difficulty: Column, clarify: Column, scenario_count: Column) -> Column:
    """Export bucket, null for scenario numbers outside 1..count."""
    number = scenario_number(scenario_id)
    train_end, dev_end = split_bounds(scenario_count)
    test = (
        F.when(clarify | (difficulty == "L5"), "test_adversarial")
        .when(difficulty.isin("L0", "L1", "L2"), "test_easy")
        .otherwise("test_hard")
    )
    return (
        F.when((number < 1) | (number > scenario_count), None)
        .when(number <= train_end, "train")
        .when(number <= dev_end, "dev")
        .otherwise(test)
    )


def assign_split(samples: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Add `split`; samples outside every split are dropped."""
    count = scenarios.agg(F.count(F.lit(1))).scalar()
    flag = F.coalesce("expected.should_ask_clarification", F.lit(False))
    split = bucket(F.col("scenario_id"), F.coalesce("difficulty", F.lit("L1")), flag, count)
    return samples.withColumn("split", split).filter(F.col("split").isNotNull())


def split_counts(split_samples: DataFrame) -> DataFrame:
    return split_samples.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def leakage(split_samples: DataFrame, key: Column) -> DataFrame:
    """Keys (a scenario, a normalised text, ...) found in more than one of train, dev and test."""
    part = F.substring_index("split", "_", 1)
    return (
        split_samples.groupBy(key.alias("key"))
        .agg(F.array_sort(F.collect_set(part)).alias("splits"), F.count(F.lit(1)).alias("n"))
        .filter(F.size("splits") > 1)
    )
