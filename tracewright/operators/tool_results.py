"""What the read tools of a trace return, as tables keyed by (id, pos).

Results of bounded size are one VARIANT per step. Searches and trajectories can be of any
size, so they stay in long form: join `trace_audit.all_searches` with `search_results`, or use
`trajectory_points`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..functions.variants import string_value
from ..plans.vocabulary import SLOTS
from ..session import materialize
from . import spatial
from .lookup import by_id
from .requests import geojson
from .trace_audit import searches_on_map, shown_results, states_with, with_timeline


def _calls(prepared: DataFrame, *tools: str) -> DataFrame:
    """(id, scenario_id, pos, tool, args, object_id) of the steps that call one of the tools."""
    wanted = F.filter("steps", lambda s: s.tool.isin(*tools))
    return prepared.select(
        "id", "scenario_id", "step_ids", "known", "initial_state", F.explode(wanted).alias("s")
    ).select(
        "id",
        "scenario_id",
        "initial_state",
        "known",
        F.col("s.pos").alias("pos"),
        F.col("s.tool").alias("tool"),
        F.col("s.args").alias("args"),
        F.get("step_ids", F.col("s.pos")).alias("object_id"),
    )


def _result(df: DataFrame, value: Column) -> DataFrame:
    return df.select("id", "pos", "tool", value.alias("result"))


def _slot_value(slot: Column) -> Column:
    """An entity, a list of entities, or a null VARIANT."""
    return (
        F.when(slot.is_list, F.to_variant_object(slot.ents))
        .when(slot.isNotNull(), F.to_variant_object(F.get(slot.ents, F.lit(0))))
        .otherwise(F.parse_json(F.lit("null")))
    )


def selected_entities(prepared: DataFrame) -> DataFrame:
    """get_selected_entity: one slot under `entity`, or all three."""
    calls = _calls(prepared, "get_selected_entity")
    selected = F.col("initial_state.selected")
    name = string_value(F.col("args")["entity_type"])
    one = reduce(lambda rest, s: F.when(name == s, _slot_value(selected[s])).otherwise(rest), SLOTS, F.lit(None).cast("variant"))
    every = F.to_variant_object(F.struct(*[_slot_value(selected[s]).alias(s) for s in SLOTS]))
    return _result(
        calls.filter(name.isNull() | name.isin(SLOTS)),
        F.when(name.isNull(), every).otherwise(F.to_variant_object(F.struct(one.alias("entity")))),
    )


def resolved(prepared: DataFrame) -> DataFrame:
    """resolve_entity: the entity and the confidence, from what was looked up when references were followed."""
    found = F.col("known")[F.col("pos")]
    entity = F.when(found.isNotNull(), F.struct(found.id.alias("id"), found.type.alias("type"), found["name"].alias("name")))
    confidence = F.when(found.isNotNull(), 1.0).otherwise(0.0)
    asked = _calls(prepared, "resolve_entity").filter(string_value(F.col("args")["reference"]).isNotNull())
    return _result(asked, F.to_variant_object(F.struct(entity.alias("entity"), confidence.alias("confidence"))))


def object_reads(prepared: DataFrame, objects: DataFrame) -> DataFrame:
    """get_object_info, get_polygon_area and get_line_length: one lookup for all three."""
    calls = _calls(prepared, "get_object_info", "get_polygon_area", "get_line_length")
    table = by_id(objects).select(
        "scenario_id", F.col("id").alias("object_id"), F.col("type").alias("_type"), F.col("name").alias("_name"), "geom", "props"
    )
    found = calls.join(table, ["scenario_id", "object_id"])
    info = F.struct(
        F.col("object_id").alias("id"),
        F.col("_type").alias("type"),
        F.col("_name").alias("name"),
        geojson(F.col("geom")).alias("geometry"),
        F.col("props").alias("properties"),
    )
    area = F.struct(
        F.col("object_id").alias("polygon_id"), F.round(geo.ring_area_m2(F.col("geom.rings")[0]), 2).alias("area_sqm")
    )
    length = F.struct(
        F.col("object_id").alias("line_id"), F.round(geo.path_length_m(F.col("geom.path")), 2).alias("length_meters")
    )
    value = (
        F.when(F.col("tool") == "get_object_info", F.to_variant_object(info))
        .when((F.col("tool") == "get_polygon_area") & (F.col("_type") == "polygon"), F.to_variant_object(area))
        .when((F.col("tool") == "get_line_length") & (F.col("_type") == "line"), F.to_variant_object(length))
    )
    return _result(found, value).filter(F.col("result").isNotNull())


def map_states(prepared: DataFrame, scenarios: DataFrame, objects: DataFrame, traj: DataFrame) -> DataFrame:
    """get_current_map_state: what is visible at that step, highlights of searches included.

    Only searches that are highlighted at such a step are run.
    """
    calls = F.filter("steps", lambda s: s.tool == "get_current_map_state")
    timed, at = with_timeline(prepared), F.transform(calls, lambda s: s.pos)
    queries = materialize(searches_on_map(timed, at))
    asked = states_with(timed, at, shown_results(queries, scenarios, objects, traj))
    selected = F.struct(*[_slot_value(F.col("selected")[s]).alias(s) for s in SLOTS]).alias("selected")
    parts = ["time", selected, "active_layers", "drawn_artifacts", "highlighted_objects", "popups"]
    value = F.to_variant_object(F.struct(*parts)).alias("result")
    return asked.select("id", F.col("at").alias("pos"), F.lit("get_current_map_state").alias("tool"), value)


def read_results(prepared: DataFrame, scenarios: DataFrame, objects: DataFrame, traj: DataFrame) -> DataFrame:
    """(id, pos, tool, result) of every read but searches and trajectories."""
    states = map_states(prepared, scenarios, objects, traj)
    return reduce(DataFrame.unionByName, [states, selected_entities(prepared), resolved(prepared), object_reads(prepared, objects)])


def trajectory_points(
    prepared: DataFrame, scenarios: DataFrame, objects: DataFrame, traj: DataFrame
) -> DataFrame:
    """get_vehicle_trajectory: distinct (scenario_id, vehicle_id, time_range, pos, ts, lon, lat)."""
    asked = _calls(prepared, "get_vehicle_trajectory").select(
        "scenario_id",
        F.col("object_id").alias("vehicle_id"),
        string_value(F.col("args")["time_range"]).alias("time_range"),
    )
    return spatial.vehicle_trajectory(asked.filter(F.col("vehicle_id").isNotNull()), scenarios, objects, traj)
