"""Traces, negatives and sample assembly."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewright.functions.text import short_hash
from tracewright.operators import negatives
from tracewright.plans import traces

from . import fixtures as fx
from .oracle_views import SAMPLE_ID, and_views, with_views

QUERIES = {}
ORACLES = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return register


ARGS = [
    "entity_type", "object_id", "vehicle_id", "polygon_id", "line_id", "object_type",
    "time_range", "radius_meters", "points", "label", "source_object_id", "target_id", "content",
]


def _step_row(cond: str, pos: str, tool: str, **args: str) -> str:
    columns = ", ".join(f"{args.get(a, 'CAST(NULL AS VARCHAR)')} AS {a}" for a in ARGS)
    ids = args.get("object_ids", "CAST(NULL AS VARCHAR)")
    return f"SELECT doc_id, scenario_id, {pos} AS pos, '{tool}' AS tool, {columns}, {ids} AS object_ids FROM bps WHERE NOT clarify AND {cond}"


_T = "target_id"
_S = "CAST(sel AS INTEGER)"
_RANGE = "coalesce(c_range, 'last_10_minutes')"
STEP_ROWS = "\n  UNION ALL ".join(
    [
        _step_row("family < 8", "0", "get_current_map_state"),
        _step_row("family IN (0, 1) AND sel", "1", "get_selected_entity", entity_type="'object'"),
        _step_row("family = 2", "1", "get_selected_entity", entity_type="'object'"),
        _step_row("family = 3 AND sel", "1", "get_selected_entity", entity_type="'polygon'"),
        _step_row("family = 0", f"1 + {_S}", "get_vehicle_trajectory", vehicle_id=_T, time_range=_RANGE),
        _step_row("family = 0", f"2 + {_S}", "draw_polyline", points="'$get_vehicle_trajectory.points'", label=f"'Trajectory of ' || {_T}", source_object_id=_T),
        _step_row("family = 1", f"1 + {_S}", "get_object_info", object_id=_T),
        _step_row("family = 1", f"2 + {_S}", "show_popup", target_id=_T, content=f"'Info for ' || {_T}"),
        _step_row("family = 2", "2", "highlight_objects", object_ids=f"'[\"' || {_T} || '\"]'"),
        _step_row("family = 3", f"1 + {_S}", "get_objects_inside_polygon", polygon_id=_T, object_type="coalesce(c_type, 'vehicle')"),
        _step_row("family = 3", f"2 + {_S}", "highlight_objects", object_ids="'$get_objects_inside_polygon.results'"),
        _step_row("family = 4", "1", "get_objects_crossing_line", line_id=_T, object_type="'vehicle'", time_range=_RANGE),
        _step_row("family = 5", "1", "get_polygon_area", polygon_id=_T),
        _step_row("family = 6", "1", "get_line_length", line_id=_T),
        _step_row("family = 7", "1", "get_nearby_objects", object_id=_T, object_type="'camera'", radius_meters="CAST(coalesce(c_radius, 1000) AS VARCHAR)"),
        _step_row("family = 7", "2", "highlight_objects", object_ids="'$get_nearby_objects.results'"),
    ]
)


@query("gold_trace_steps", with_views("bps", STEP_ROWS))
def gold_trace_steps(spark, sf_dir):
    traced = traces.with_gold_trace(fx.blueprints(spark, sf_dir))
    return traced.select(
        F.col("bp_ord").alias("doc_id"), "scenario_id", F.posexplode("gold_trace").alias("pos", "s")
    ).select(
        "doc_id",
        "scenario_id",
        "pos",
        F.col("s.tool").alias("tool"),
        *[F.try_variant_get("s.args", f"$.{a}", "string").alias(a) for a in ARGS],
        F.try_variant_get("s.args", "$.object_ids", "string").alias("object_ids"),
    )


def _shown(selected, what):
    """Type or ids of whatever is selected."""
    slots = [F.col(f"{selected}.{s}") for s in ("object", "line", "polygon")]
    if what == "type":
        return F.coalesce(*[s.ents[0].type for s in slots])
    return F.coalesce(*[F.when(s.isNotNull(), F.array_join(F.transform(s.ents, lambda e: e.id), ",")) for s in slots])


@query(
    "negative_cases",
    with_views(
        "negs",
        """
SELECT doc_id, scenario_id, mutation, negative_type, difficulty, object_id, shown_type, shown,
       true AS asks_back, 'clarification_requested' AS asserted
FROM negs""",
    ),
)
def negative_cases(spark, sf_dir):
    cases = negatives.negative_cases(fx.blueprints(spark, sf_dir), fx.objects(spark, sf_dir))
    return cases.select(
        F.col("bp_ord").alias("doc_id"),
        "scenario_id",
        "mutation",
        "negative_type",
        "difficulty",
        F.col("target.object_id").alias("object_id"),
        _shown("selected", "type").alias("shown_type"),
        _shown("selected", "ids").alias("shown"),
        (F.col("negative_case") & F.col("should_ask_clarification")).alias("asks_back"),
        F.element_at("expected_final_state", 1).type.alias("asserted"),
    )


_TOOL_LISTS = """CASE WHEN NOT traced THEN ''
            WHEN family = 0 THEN 'draw_polyline,get_current_map_state,' || CASE WHEN sel THEN 'get_selected_entity,' ELSE '' END || 'get_vehicle_trajectory'
            WHEN family = 1 THEN 'get_current_map_state,get_object_info,' || CASE WHEN sel THEN 'get_selected_entity,' ELSE '' END || 'show_popup'
            WHEN family = 2 THEN 'get_current_map_state,get_selected_entity,highlight_objects'
            WHEN family = 3 THEN 'get_current_map_state,get_objects_inside_polygon,' || CASE WHEN sel THEN 'get_selected_entity,' ELSE '' END || 'highlight_objects'
            WHEN family = 4 THEN 'get_current_map_state,get_objects_crossing_line'
            WHEN family = 5 THEN 'get_current_map_state,get_polygon_area'
            WHEN family = 6 THEN 'get_current_map_state,get_line_length'
            WHEN family = 7 THEN 'get_current_map_state,get_nearby_objects,highlight_objects' END"""


@query(
    "assembled_samples",
    with_views(
        "samples",
        f"""
SELECT {SAMPLE_ID} AS id, world, stage, doc_id, mutation, scenario_id, task_type, difficulty,
       substr(sha256(user_request), 1, 16) AS request_hash,
       CASE WHEN length(regexp_replace(user_request, '[^\\x00-\\x7F]', '', 'g')) / greatest(length(user_request), 1) > 0.9 THEN 'en' ELSE 'vi' END AS language,
       shown_type, shown, '2024-01-30T23:30:00Z' AS time, 'vehicles,cameras,roads,zones' AS layers,
       {_TOOL_LISTS} AS available_tools,
       concat_ws(',', CASE WHEN sel THEN 'selected_object' ELSE 'explicit_id' END, kind,
                 CASE WHEN mutation > 0 THEN 'negative,' || negative_type END,
                 CASE WHEN traced AND family IN (0, 1, 2, 3, 7) THEN 'multi_tool' END,
                 CASE WHEN c_range IS NOT NULL THEN 'temporal' END) AS tags,
       clarify AS asks_back, 'get_object_info,resolve_entity,get_current_map_state' AS extra_tools, task_type AS blueprint_id
FROM samples""",
    ),
)
def assembled_samples(spark, sf_dir):
    s = fx.samples(spark, sf_dir)
    return s.select(
        "id",
        F.col("sample_ord.scenario").alias("world"),
        F.col("sample_ord.negative").alias("stage"),
        F.col("sample_ord.blueprint").alias("doc_id"),
        F.col("sample_ord.mutation").alias("mutation"),
        "scenario_id",
        "task_type",
        "difficulty",
        short_hash(F.col("user_request")).alias("request_hash"),
        "language",
        _shown("initial_state.selected", "type").alias("shown_type"),
        _shown("initial_state.selected", "ids").alias("shown"),
        F.col("initial_state.time").alias("time"),
        F.array_join("initial_state.active_layers", ",").alias("layers"),
        F.array_join("available_tools", ",").alias("available_tools"),
        F.array_join("tags", ",").alias("tags"),
        F.col("expected.should_ask_clarification").alias("asks_back"),
        F.array_join("expected.allowed_extra_tools", ",").alias("extra_tools"),
        F.col("generation_metadata.blueprint_id").alias("blueprint_id"),
    )
