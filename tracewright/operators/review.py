"""Samples to be reviewed by people."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .skew import pick_by_hash

# Tags and difficulties that go first.
PRIORITY_TAGS = ["negative", "adversarial", "L4", "L5", "multi_turn"]
PRIORITY_DIFFICULTIES = ["L4", "L5"]


def with_priority(samples: DataFrame) -> DataFrame:
    tags = F.arrays_overlap(F.col("tags"), F.array(*[F.lit(t) for t in PRIORITY_TAGS]))
    return samples.withColumn(
        "priority",
        F.coalesce("expected.should_ask_clarification", F.lit(False))
        | F.col("difficulty").isin(PRIORITY_DIFFICULTIES)
        | F.coalesce(tags, F.lit(False)),
    )


def review_quotas(flagged: DataFrame, rate: float = 0.1) -> DataFrame:
    """How many priority and other samples to take: (priority, quota).

    The target is `rate` of all; half of it, at least one, goes to priority samples, the rest
    to the others as far as there are any.
    """
    counts = flagged.agg(
        F.count(F.lit(1)).alias("n"), F.count_if("priority").alias("first"), F.count_if(~F.col("priority")).alias("rest")
    )
    target = F.greatest(F.lit(1), (F.col("n") * F.lit(rate)).cast("bigint"))
    first = F.least(F.col("first"), F.greatest(F.floor(target / 2), F.lit(1)))
    rest = F.least(F.col("rest"), F.greatest(target - first, F.lit(0)))
    rows = F.array(
        F.struct(F.lit(True).alias("priority"), first.alias("quota")), F.struct(F.lit(False).alias("priority"), rest.alias("quota"))
    )
    return counts.select(F.inline(rows))


def select_review_samples(samples: DataFrame, rate: float = 0.1, seed: str = "") -> DataFrame:
    """A review sample drawn by hash: the same input always gives the same sample.

    The input is read more than once; hand in a written table rather than a long plan.
    """
    flagged = with_priority(samples)
    picked = pick_by_hash(flagged, "priority", review_quotas(flagged, rate), F.concat("id", F.lit(seed)))
    return picked.drop("priority")


def review_queue(selected: DataFrame) -> DataFrame:
    """The columns a reviewer sees."""
    return selected.select(
        "id",
        "task_type",
        "difficulty",
        "user_request",
        "initial_state",
        "gold_trace",
        "expected",
        "tags",
        F.lit("pending").alias("review_status"),
    )
