"""Model output as tables.

Inference runs elsewhere: it reads request tables (operators.requests) and fills
responses(request_id, kind, attempt, text). Everything here starts from that table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import hash_choice
from ..functions.variants import field, parse_response, string_field, string_value
from ..plans.vocabulary import DIFFICULTIES, TASK_FAMILIES
from ..sources import schema
from .negatives import ADVERSARIAL, asking_back

MAX_ATTEMPTS = 3  # fixed value: answers tried per request


def first_parsed(responses: DataFrame, kind: str) -> DataFrame:
    """(request_id, attempt, value): the first answer of each request that holds JSON.

    Answers are parsed before the aggregation, so texts without JSON are never shuffled.
    """
    parsed = (
        responses.filter((F.col("kind") == kind) & (F.col("attempt") <= MAX_ATTEMPTS))
        .withColumn("value", parse_response(F.col("text")))
        .filter(F.col("value").isNotNull())
    )
    return parsed.groupBy("request_id").agg(
        F.min("attempt").alias("attempt"), F.min_by("value", "attempt").alias("value")
    )


def is_object(value: Column) -> Column:
    return F.schema_of_variant(value).startswith(F.lit("OBJECT"))


def utterances(parsed: DataFrame) -> DataFrame:
    """parsed(..., value) -> one row per non-blank string in `utterances`, numbered from 0."""
    keys = [c for c in parsed.columns if c not in ("attempt", "value")]
    said = F.filter(
        F.transform(field(F.col("value"), "$.utterances", "array<variant>"), string_value),
        lambda u: u.isNotNull() & (F.trim(u, F.lit(" \t\n\r\x0b\x0c")) != ""),
    )
    return parsed.select(*keys, F.posexplode(said).alias("utt_ord", "utterance"))


NO_VERDICT = "no readable verdict"


def verdicts(requests: DataFrame, parsed: DataFrame) -> DataFrame:
    """requests(id, request_id) -> (id, valid, issues); unreadable answers count as invalid."""
    value = F.col("value")
    raw = field(value, "$.issues", "variant")
    as_list = F.transform(field(raw, "$", "array<variant>"), lambda i: F.try_variant_get(i, "$", "string"))
    issues = (
        F.when(~F.coalesce(is_object(value), F.lit(False)), F.array(F.lit(NO_VERDICT)))
        .when(raw.isNull(), F.array().cast("array<string>"))
        .otherwise(F.coalesce(as_list, F.array(F.try_variant_get(raw, "$", "string"))))
    )
    return requests.select("id", "request_id").join(parsed, "request_id", "left").select(
        "id", F.coalesce(field(value, "$.valid", "boolean"), F.lit(False)).alias("valid"), issues.alias("issues")
    )


def plan_steps(parsed: DataFrame) -> DataFrame:
    """parsed(..., value) -> `trace`: a list as it is, else its `trace`, else its `steps`, else empty."""
    keys = [c for c in parsed.columns if c not in ("attempt", "value")]
    value = F.col("value")
    options = [field(value, path, schema.TRACE) for path in ("$", "$.trace", "$.steps")]
    return parsed.select(*keys, F.coalesce(*options, F.array().cast(schema.TRACE)).alias("trace"))


def work_items(scenarios: DataFrame, per_scenario: int = 10, seed: str = "") -> DataFrame:
    """(request_id, scenario_id, bp_ord, family, difficulty): tasks to ask for, drawn by hash."""
    items = scenarios.select("scenario_id", F.explode(F.sequence(F.lit(1), F.lit(per_scenario))).alias("bp_ord"))
    key = F.concat_ws("|", "scenario_id", F.col("bp_ord").cast("string"))
    return items.select(
        F.concat(F.lit("blueprint|"), key).alias("request_id"),
        "scenario_id",
        F.col("bp_ord").cast("bigint").alias("bp_ord"),
        hash_choice(F.concat(key, F.lit(f"|family{seed}")), TASK_FAMILIES).alias("family"),
        hash_choice(F.concat(key, F.lit(f"|difficulty{seed}")), DIFFICULTIES).alias("difficulty"),
    )


def _slot(value: Column, path: str) -> Column:
    inner = field(value, path, "variant")
    one = F.try_variant_get(inner, "$", schema.ENTITY)
    many = F.try_variant_get(inner, "$", f"array<{schema.ENTITY}>")
    return (
        F.when(many.isNotNull(), F.struct(F.lit(True).alias("is_list"), many.alias("ents")))
        .when(one.isNotNull(), F.struct(F.lit(False).alias("is_list"), F.array(one).alias("ents")))
        .cast(schema.SLOT)
    )


def _blueprint_columns(value: Column) -> dict[str, Column]:
    flag = lambda name: F.coalesce(field(value, f"$.{name}", "boolean"), F.lit(False))
    selected = field(value, "$.initial_state.selected", "variant")
    slots = F.struct(*[_slot(selected, f"$.{s}").alias(s) for s in ("object", "line", "polygon")])
    return {
        "task_type": string_field(value, "$.task_type"),
        "difficulty": string_field(value, "$.difficulty"),
        "target": F.try_variant_get(value, "$.target", schema.TARGET),
        "constraints": field(value, "$.constraints", "variant"),
        "required_semantic_steps": field(value, "$.required_semantic_steps", "array<string>"),
        "expected_final_state": field(value, "$.expected_final_state", f"array<{schema.ASSERTION}>"),
        "should_ask_clarification": flag("should_ask_clarification"),
        "negative_case": flag("negative_case"),
        "negative_type": string_field(value, "$._negative_type"),
        "selected": F.when(selected.isNotNull(), slots).cast(schema.SELECTED),
        "active_layers": field(value, "$.initial_state.active_layers", "array<string>"),
        "drawn_artifacts": field(value, "$.initial_state.drawn_artifacts", f"array<{schema.ARTIFACT}>"),
    }


def blueprints(items: DataFrame, parsed: DataFrame) -> DataFrame:
    """Work items with a readable answer, as blueprints that keep what was asked for."""
    answered = items.join(parsed.filter(is_object(F.col("value"))), "request_id")
    columns = _blueprint_columns(F.col("value"))
    return answered.select(
        "scenario_id",
        "bp_ord",
        *[c.alias(name) for name, c in columns.items()],
        F.col("family").alias("requested_family"),
        F.col("difficulty").alias("requested_difficulty"),
    )


def rejected_answers(requests: DataFrame, parsed: DataFrame) -> DataFrame:
    """(request_id, reason) for requests without an answer of the right shape."""
    value = F.col("value")
    reason = F.when(value.isNull(), "no_json").when(~is_object(value), "not_an_object")
    joined = requests.select("request_id").join(parsed, "request_id", "left")
    return joined.select("request_id", reason.alias("reason")).filter(F.col("reason").isNotNull())


def adversarial_items(scenarios: DataFrame, per_scenario: int = 3) -> DataFrame:
    """(request_id, scenario_id, bp_ord) for negative cases a model is to write."""
    items = scenarios.select("scenario_id", F.explode(F.sequence(F.lit(1), F.lit(per_scenario))).alias("bp_ord"))
    key = F.concat_ws("|", F.lit("adversarial"), "scenario_id", F.col("bp_ord").cast("string"))
    return items.select(key.alias("request_id"), "scenario_id", F.col("bp_ord").cast("bigint").alias("bp_ord"))


def adversarial_blueprints(items: DataFrame, parsed: DataFrame) -> DataFrame:
    """Answered adversarial requests as negative blueprints."""
    answered = items.join(parsed.filter(is_object(F.col("value"))), "request_id")
    columns = _blueprint_columns(F.col("value"))
    named = answered.select(
        "scenario_id",
        "bp_ord",
        *[c.alias(name) for name, c in columns.items()],
        F.lit(None).cast("string").alias("requested_family"),
        F.lit(None).cast("string").alias("requested_difficulty"),
        F.lit(ADVERSARIAL).alias("mutation"),
    )
    return asking_back(named)
