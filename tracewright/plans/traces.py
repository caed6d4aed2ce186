"""Gold traces from blueprints: a small table of step templates, filled in row by row."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import schema
from .vocabulary import ALLOWED_EXTRA_TOOLS



@dataclass(frozen=True)
class Source:
    """Where an argument's value comes from; `text` is its literal, prefix or JSON default."""

    kind: str
    text: str = ""


def literal(value: str) -> Source:
    return Source("literal", value)


def target_id() -> Source:
    return Source("target")


def target_list() -> Source:
    return Source("target_list")


def about_target(prefix: str) -> Source:
    return Source("about", prefix)


def constraint(default: str | int) -> Source:
    """The blueprint's constraint of the argument's name; the default if it is not listed."""
    return Source("constraint", json.dumps(default))


@dataclass(frozen=True)
class Step:
    tool: str
    args: dict[str, Source] = field(default_factory=dict)
    only_if_selected: bool = False


STATE = Step("get_current_map_state")


def selection(slot: str, always: bool = False) -> Step:
    return Step("get_selected_entity", {"entity_type": literal(slot)}, only_if_selected=not always)


# The tool sequence of each task type and the defaults of its arguments.
TEMPLATES: dict[str, list[Step]] = {
    "draw_vehicle_trajectory": [
        STATE,
        selection("object"),
        Step(
            "get_vehicle_trajectory",
            {"vehicle_id": target_id(), "time_range": constraint("last_10_minutes")},
        ),
        Step(
            "draw_polyline",
            {
                "points": literal("$get_vehicle_trajectory.points"),
                "label": about_target("Trajectory of "),
                "source_object_id": target_id(),
            },
        ),
    ],
    "show_object_info": [
        STATE,
        selection("object"),
        Step("get_object_info", {"object_id": target_id()}),
        Step("show_popup", {"target_id": target_id(), "content": about_target("Info for ")}),
    ],
    "highlight_selected_entity": [
        STATE,
        selection("object", always=True),
        Step("highlight_objects", {"object_ids": target_list()}),
    ],
    "objects_inside_polygon": [
        STATE,
        selection("polygon"),
        Step(
            "get_objects_inside_polygon",
            {"polygon_id": target_id(), "object_type": constraint("vehicle")},
        ),
        Step("highlight_objects", {"object_ids": literal("$get_objects_inside_polygon.results")}),
    ],
    "objects_crossing_line": [
        STATE,
        Step(
            "get_objects_crossing_line",
            {
                "line_id": target_id(),
                "object_type": constraint("vehicle"),
                "time_range": constraint("last_10_minutes"),
            },
        ),
    ],
    "polygon_area": [STATE, Step("get_polygon_area", {"polygon_id": target_id()})],
    "line_length": [STATE, Step("get_line_length", {"line_id": target_id()})],
    "nearby_objects": [
        STATE,
        Step(
            "get_nearby_objects",
            {
                "object_id": target_id(),
                "object_type": constraint("camera"),
                "radius_meters": constraint(1000),
            },
        ),
        Step("highlight_objects", {"object_ids": literal("$get_nearby_objects.results")}),
    ],
}


STEPS = (
    "array<struct<tool: string, only_if_selected: boolean, "
    "args: array<struct<name: string, kind: string, text: string>>>>"
)


def template_table(spark: SparkSession, templates: dict[str, list[Step]] | None = None) -> DataFrame:
    """The templates as rows (task_type, steps)."""
    rows = [
        (
            task,
            [(s.tool, s.only_if_selected, [(n, src.kind, src.text) for n, src in s.args.items()]) for s in steps],
        )
        for task, steps in (templates or TEMPLATES).items()
    ]
    return spark.createDataFrame(rows, f"task_type string, steps {STEPS}")


def _rendered(steps: Column) -> Column:
    """The steps that apply to a blueprint row, arguments filled in."""
    selected = F.coalesce(F.col("target.reference_mode") == "selected_object", F.lit(False))
    target = F.col("target.object_id")
    listed = F.coalesce(
        F.try_variant_get("constraints", "$", "map<string,variant>"), F.create_map().cast("map<string,variant>")
    )

    def value(a: Column) -> Column:
        return (
            F.when(a.kind == "target", F.coalesce(target.cast("variant"), F.parse_json(F.lit("null"))))
            .when(a.kind == "target_list", F.to_variant_object(F.array(target)))
            .when(a.kind == "about", F.concat(a.text, F.coalesce(target, F.lit("None"))).cast("variant"))
            .when(a.kind == "constraint", F.coalesce(listed[a["name"]], F.try_parse_json(a.text)))
            .otherwise(a.text.cast("variant"))
        )

    def step(s: Column) -> Column:
        args = F.map_from_entries(F.transform(s["args"], lambda a: F.struct(a["name"], value(a))))
        return F.struct(s.tool.alias("tool"), F.to_variant_object(args).alias("args"))

    return F.transform(F.filter(steps, lambda s: ~s.only_if_selected | selected), step)


def with_gold_trace(
    blueprints: DataFrame, fallback: DataFrame | None = None, templates: dict[str, list[Step]] | None = None
) -> DataFrame:
    """Add `gold_trace`; blueprints that are negative or ask for clarification get an empty one.

    `fallback(scenario_id, bp_ord, trace)` serves task types without a
    template (traces a model wrote, see ingest.plan_steps); without one their trace is empty.
    """
    empty = F.array().cast(schema.TRACE)
    # One row per template: far below any broadcast limit.
    table = F.broadcast(template_table(blueprints.sparkSession, templates))
    silent = F.coalesce("negative_case", F.lit(False)) | F.coalesce("should_ask_clarification", F.lit(False))
    traced = blueprints.join(table, "task_type", "left").withColumn(
        "gold_trace", F.when(silent, empty).otherwise(_rendered(F.col("steps")))
    ).select(*blueprints.columns, "gold_trace")
    if fallback is None:
        return traced.withColumn("gold_trace", F.coalesce("gold_trace", empty))
    written = fallback.select("scenario_id", "bp_ord", F.col("trace").alias("_written"))
    return (
        traced.join(written, ["scenario_id", "bp_ord"], "left")
        .withColumn("gold_trace", F.coalesce("gold_trace", "_written", empty))
        .drop("_written")
    )


def expected_block(blueprint: Callable[[str], Column] = F.col) -> Column:
    """What a sample is checked against: steps, allowed and forbidden tools, assertions, flag."""
    strings = F.array().cast("array<string>")
    return F.struct(
        F.coalesce(blueprint("required_semantic_steps"), strings).alias("required_semantic_steps"),
        F.array(*[F.lit(t) for t in ALLOWED_EXTRA_TOOLS]).alias("allowed_extra_tools"),
        strings.alias("forbidden_tools"),
        F.coalesce(
            blueprint("expected_final_state"), F.array().cast(f"array<{schema.ASSERTION}>")
        ).alias("final_state_assertions"),
        F.coalesce(blueprint("should_ask_clarification"), F.lit(False)).alias("should_ask_clarification"),
    )
