"""Samples from blueprints, scenarios and utterances."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import language_of
from ..plans.traces import expected_block
from ..plans.vocabulary import DEFAULT_LAYERS, TOOL_CATALOG_VERSION
from ..sources import schema
from .negatives import ADVERSARIAL

# Position of a sample in the dataset: scenario, positives before negatives, blueprint,
# mutation, utterance. Structs compare field by field.
ORDER = ["scenario", "negative", "blueprint", "mutation", "utterance"]


def all_blueprints(positives: DataFrame, negatives: DataFrame | None = None) -> DataFrame:
    """Traced positives and negatives in one table; negatives have empty traces.

    Within a scenario the positives come first, then all mutations, then what a model has written.
    """
    table = positives.withColumns({"mutation": F.lit(0), "stage": F.lit(0)})
    if negatives is None:
        return table
    empty = F.array().cast(schema.TRACE)
    blank = negatives.withColumns({"gold_trace": empty, "stage": F.when(F.col("mutation") == ADVERSARIAL, 2).otherwise(1)})
    return table.unionByName(blank, allowMissingColumns=True)


def placeholder(task_type: Column) -> Column:
    return F.concat(F.lit("[auto] "), F.coalesce(task_type, F.lit("unknown")), F.lit(" task"))


def sample_id(*key: Column) -> Column:
    """A stable id from the sample's key, 128 bits: 64 would meet its first collisions near
    ten billion samples.
    """
    return F.concat(F.lit("mapagent_"), F.substring(F.sha2(F.concat_ws("|", *key), 256), 1, 32))


def tags_of(mode: Column, kind: Column, negative: Column, negative_type: Column, trace: Column, constraints: Column) -> Column:
    filled = lambda c: c.isNotNull() & (c != "")
    time_range = F.try_variant_get(constraints, "$.time_range", "string")
    return F.array_compact(
        F.array(
            F.when(filled(mode), F.replace(mode, F.lit(" "), F.lit("_"))),
            F.when(filled(kind), kind),
            F.when(negative, "negative"),
            F.when(negative & filled(negative_type), negative_type),
            F.when(F.size(trace) >= 3, "multi_tool"),
            F.when(filled(time_range), "temporal"),
        )
    )


def assemble_samples(blueprints: DataFrame, scenarios: DataFrame, utterances: DataFrame) -> DataFrame:
    """blueprints x utterances x scenario -> one row per sample.

    `blueprints` comes from `all_blueprints`; `utterances(scenario_id, bp_ord, mutation, utt_ord,
    utterance)` from ingest.utterances. A blueprint without utterances gets a placeholder.
    """
    said = utterances.select("scenario_id", "bp_ord", "mutation", "utt_ord", "utterance")
    world = scenarios.select("scenario_id", F.col("ord").alias("_world_ord"), F.col("time").alias("_time"))
    joined = blueprints.join(said, ["scenario_id", "bp_ord", "mutation"], "left").join(world, "scenario_id")
    text = F.coalesce("utterance", placeholder(F.col("task_type")))
    utt = F.coalesce("utt_ord", F.lit(0))
    negative = F.coalesce("negative_case", F.lit(False))
    trace = F.col("gold_trace")
    no_slot = F.struct(*[F.lit(None).cast(schema.SLOT).alias(s) for s in ("object", "line", "polygon")]).cast(schema.SELECTED)
    return joined.select(
        F.struct(
            F.col("_world_ord").alias("scenario"),
            F.col("stage").alias("negative"),
            F.col("bp_ord").cast("bigint").alias("blueprint"),
            F.col("mutation").alias("mutation"),
            utt.alias("utterance"),
        ).alias("sample_ord"),
        sample_id(F.col("scenario_id"), F.col("bp_ord"), F.col("mutation"), utt).alias("id"),
        "scenario_id",
        F.lit(TOOL_CATALOG_VERSION).alias("tool_catalog_version"),
        language_of(text).alias("language"),
        F.coalesce("difficulty", F.lit("L1")).alias("difficulty"),
        F.coalesce("task_type", F.lit("unknown")).alias("task_type"),
        text.alias("user_request"),
        F.struct(
            F.date_format("_time", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("time"),
            F.coalesce("selected", no_slot).alias("selected"),
            F.coalesce("active_layers", F.array(*[F.lit(x) for x in DEFAULT_LAYERS])).alias("active_layers"),
            F.coalesce("drawn_artifacts", F.array().cast(f"array<{schema.ARTIFACT}>")).alias("drawn_artifacts"),
        ).alias("initial_state"),
        F.array_sort(F.array_distinct(F.transform(trace, lambda s: s.tool))).alias("available_tools"),
        trace.alias("gold_trace"),
        expected_block().alias("expected"),
        tags_of(
            F.col("target.reference_mode"), F.col("target.expected_type"), negative, F.col("negative_type"), trace, F.col("constraints")
        ).alias("tags"),
        F.struct(
            F.lit("").alias("generator_model"),
            F.coalesce("requested_family", F.lit("")).alias("blueprint_id"),
            F.lit(False).alias("verified_by_schema"),
            F.lit(False).alias("verified_by_execution"),
            F.lit(False).alias("verified_by_llm"),
            F.lit(False).alias("human_reviewed"),
        ).alias("generation_metadata"),
    )
