"""The set-based audit against a plain step-by-step replay of random traces."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tracewright.operators import gates
from tracewright.operators import trace_audit as audit
from tracewright.sources import schema

OBJECTS = {"v1": "vehicle", "v2": "vehicle", "c1": "camera", "z1": "polygon", "l1": "line"}


def objects(spark):
    names = {"v1": "Truck", "v2": "Bus", "c1": "Cam", "z1": "Zone", "l1": "Road"}
    rows = [("s", i, o, k, names[o], [f"the {names[o]}"], ("Point", [0.0, 0.0], None, None), None) for i, (o, k) in enumerate(OBJECTS.items())]
    return spark.createDataFrame(rows, schema.OBJECTS)


def samples(spark, traces, selected=None, assertions=(), clarify=False):
    rows = [(f"id{i}", "s", [(t, json.dumps(a)) for t, a in trace]) for i, trace in enumerate(traces)]
    df = spark.createDataFrame(rows, "id string, scenario_id string, raw array<struct<tool: string, args: string>>")
    state = {"time": "t", "selected": {"object": None, "line": None, "polygon": None, **(selected or {})}, "active_layers": [], "drawn_artifacts": []}
    expected = {"required_semantic_steps": [], "allowed_extra_tools": [], "forbidden_tools": [], "final_state_assertions": list(assertions), "should_ask_clarification": clarify}
    return df.select(
        "id",
        "scenario_id",
        F.from_json(F.lit(json.dumps(state)), schema.STATE).alias("initial_state"),
        F.transform("raw", lambda s: F.struct(s.tool.alias("tool"), F.parse_json(s.args).alias("args"))).alias("gold_trace"),
        F.from_json(F.lit(json.dumps(expected)), schema.EXPECTED).alias("expected"),
    )


def random_step(rng):
    some = lambda: rng.choice([*OBJECTS, "ghost"])
    return rng.choice(
        [
            lambda: ("get_current_map_state", {}),
            lambda: ("get_object_info", {"object_id": some()}),
            lambda: ("get_polygon_area", {"polygon_id": rng.choice(["z1", "$get_object_info.id", "v1"])}),
            lambda: ("highlight_objects", {"object_ids": rng.sample(list(OBJECTS), rng.randint(0, 2))}),
            lambda: ("highlight_objects", {"object_ids": [some()]}),
            lambda: ("draw_marker", {"coordinates": [1, 2], "label": "m"}),
            lambda: ("draw_marker", {"label": "m"}),
            lambda: ("draw_polyline", {"points": "$get_vehicle_trajectory.points", "label": "p", "source_object_id": "v1"}),
            lambda: ("get_vehicle_trajectory", {"vehicle_id": rng.choice(["v1", "v2", "c1"]), "time_range": "today"}),
            lambda: ("draw_polygon", {"geometry": {}, "label": "z"}),
            lambda: ("show_popup", {"target_id": rng.choice(["v1", "$get_vehicle_trajectory.vehicle_id", "ghost"]), "content": "c"}),
            lambda: ("clear_artifacts", {"scope": rng.choice(["all", "polylines", "polygons", "markers", "popups", "highlights", "sky"])}),
            lambda: ("warp", {}),
        ]
    )()


class Replay:
    """A step-by-step model of the traces above."""

    def __init__(self):
        self.results, self.errors = {}, []
        self.artifacts, self.popups, self.shown = [], [], set()

    def value(self, v):
        if isinstance(v, str) and v.startswith("$"):
            tool, name = v[1:].split(".")
            return self.results[tool][name]
        return v

    def known(self, oid, kind=None):
        if OBJECTS[oid] != (kind or OBJECTS[oid]):
            raise KeyError(oid)
        return oid

    def step(self, pos, tool, args):
        a = {k: self.value(v) for k, v in args.items()}
        out = {}
        if tool == "get_object_info":
            out = {"id": self.known(a["object_id"])}
        elif tool == "get_polygon_area":
            out = {"polygon_id": self.known(a["polygon_id"], "polygon")}
        elif tool == "get_vehicle_trajectory":
            out = {"vehicle_id": self.known(a["vehicle_id"], "vehicle"), "points": []}
        elif tool == "highlight_objects":
            self.shown |= {self.known(o) for o in a["object_ids"]}
        elif tool.startswith("draw_"):
            kind = tool.removeprefix("draw_")
            a[{"polyline": "points", "polygon": "geometry", "marker": "coordinates"}[kind]]
            self.artifacts.append((pos, kind, a.get("source_object_id")))
        elif tool == "show_popup":
            self.popups.append((pos, self.known(a["target_id"])))
        elif tool == "clear_artifacts":
            scope = a["scope"]
            {"all": 0, "polylines": 0, "polygons": 0, "markers": 0, "popups": 0, "highlights": 0}[scope]
            self.artifacts = [x for x in self.artifacts if scope not in ("all", x[1] + "s")]
            if scope in ("all", "popups"):
                self.popups = []
            if scope in ("all", "highlights"):
                self.shown = set()
        elif tool != "get_current_map_state":
            raise KeyError(tool)
        self.results[tool] = out

    def run(self, trace):
        for pos, (tool, args) in enumerate(trace):
            try:
                self.step(pos, tool, args)
            except KeyError:
                self.errors.append(pos)
        return self


def test_random_traces(spark):
    rng = random.Random(42)
    traces = [[random_step(rng) for _ in range(rng.randint(1, 7))] for _ in range(600)]
    # Half of the traces keep only steps that work, so that many end in a state.
    for i in range(0, 600, 2):
        model, kept = Replay(), []
        for tool, args in traces[i]:
            before = len(model.errors)
            model.run([(tool, args)])
            if len(model.errors) == before:
                kept.append((tool, args))
        traces[i] = kept
    prepared = audit.prepare(samples(spark, traces), objects(spark))
    stated = audit.with_final_state(prepared).withColumn("errors", audit.step_errors())
    rows = {r.id: r for r in stated.select("id", "errors", "artifacts", "popups", "highlights").collect()}
    good = 0
    for i, trace in enumerate(traces):
        row, model = rows[f"id{i}"], Replay().run(trace)
        assert bool(row.errors) == bool(model.errors), trace
        if model.errors:
            # A step that depends on a failed one is not reported again.
            assert {e.pos for e in row.errors} <= set(model.errors)
            assert row.errors[0].pos == model.errors[0]
            continue
        good += 1
        assert [(a.pos, a.artifact_type, a.source_object_id) for a in row.artifacts] == model.artifacts
        assert [(p.pos, p.target_id) for p in row.popups] == model.popups
        assert {x for h in row.highlights for x in h.ids} == model.shown
    assert good > 200


ONE = {"object": {"is_list": False, "ents": [{"id": "v1", "type": "vehicle", "name": "Truck"}]}}
TWO = {"object": {"is_list": True, "ents": [{"id": "v1", "type": "vehicle"}, {"id": "v2", "type": "vehicle"}]}}


@pytest.mark.parametrize(
    "trace, selected, strict, errors",
    [
        ([("get_selected_entity", {"entity_type": "object"}), ("show_popup", {"target_id": "$get_selected_entity.entity", "content": "c"})], ONE, False, []),
        ([("get_selected_entity", {"entity_type": "object"}), ("show_popup", {"target_id": "$get_selected_entity.entity", "content": "c"})], ONE, True, ["object_not_found"]),
        ([("get_selected_entity", {}), ("highlight_objects", {"object_ids": "$get_selected_entity.object"})], TWO, False, []),
        ([("get_selected_entity", {}), ("highlight_objects", {"object_ids": "$get_selected_entity.entity"})], TWO, False, ["unresolved_reference"]),
        ([("get_selected_entity", {"entity_type": "line"}), ("highlight_objects", {"object_ids": "$get_selected_entity.entity"})], ONE, False, ["bad_highlight"]),
        ([("get_selected_entity", {"entity_type": "roof"})], ONE, False, ["invalid_slot"]),
        ([("resolve_entity", {"reference": "THE bus"}), ("get_object_info", {"object_id": "$resolve_entity.entity"})], None, False, []),
        ([("resolve_entity", {"reference": "nobody"}), ("get_object_info", {"object_id": "$resolve_entity.entity"})], None, False, ["object_not_found"]),
        ([("get_object_info", {"object_id": None})], None, False, ["object_not_found"]),
        ([("get_object_info", {})], None, False, ["missing_argument"]),
        ([("get_object_info", {"object_id": "v1"}), ("show_popup", {"target_id": "$get_object_info.id", "content": "c"}), ("get_vehicle_trajectory", {"vehicle_id": "$get_object_info.id", "time_range": "x"})], None, False, []),
        ([("highlight_objects", {"object_ids": ["v1"]}), ("highlight_objects", {"object_ids": "$highlight_objects.highlighted"})], None, False, []),
        ([("get_nearby_objects", {"object_id": "v1", "object_type": "camera", "radius_meters": "far"})], None, False, ["bad_argument"]),
        ([("get_nearby_objects", {"object_id": "z1", "object_type": "camera", "radius_meters": 5})], None, False, ["not_a_point"]),
    ],
)
def test_references_and_arguments(spark, trace, selected, strict, errors):
    prepared = audit.prepare(samples(spark, [trace], selected), objects(spark), strict)
    prepared = prepared.withColumn("found", F.create_map().cast("map<int,bigint>"))
    found = prepared.select(audit.step_errors(strict)).first()[0]
    assert [e.error for e in found] == errors


MARKED = [("draw_marker", {"coordinates": [1, 2], "label": "m"}), ("show_popup", {"target_id": "v1", "content": "c"}), ("highlight_objects", {"object_ids": ["v1", "c1"]})]


@pytest.mark.parametrize(
    "assertion, holds",
    [
        ({"type": "artifact_exists"}, True),
        ({"type": "artifact_exists", "artifact_type": "marker"}, True),
        ({"type": "artifact_exists", "artifact_type": "polyline"}, False),
        ({"type": "artifact_exists", "source_object_id": "v1"}, False),
        ({"type": "artifact_removed", "artifact_type": "polygon"}, True),
        ({"type": "artifact_removed", "artifact_type": "marker"}, False),
        ({"type": "polyline_source_matches_vehicle", "source_object_id": "v1"}, False),
        ({"type": "object_highlighted", "object_id": "v1"}, True),
        ({"type": "object_highlighted", "object_id": "v2"}, False),
        ({"type": "objects_highlighted", "object_ids": ["v1", "c1"]}, True),
        ({"type": "objects_highlighted", "object_ids": ["v1", "v2"]}, False),
        ({"type": "objects_highlighted", "object_type": "polygon"}, True),
        ({"type": "objects_highlighted"}, True),
        ({"type": "popup_shown", "target_id": "v1"}, True),
        ({"type": "popup_shown", "target_id": "v2"}, False),
        ({"type": "objects_inside_polygon_highlighted"}, True),
        ({"type": "clarification_requested"}, True),
        ({"type": "no_tool_called"}, True),
    ],
)
def test_assertions(spark, assertion, holds):
    stated = audit.with_final_state(audit.prepare(samples(spark, [MARKED], None, [assertion]), objects(spark)))
    stated = stated.withColumn("found", F.create_map().cast("map<int,bigint>")).withColumn("hits", F.array().cast("array<string>"))
    assert (stated.select(gates.failed_assertions()).first()[0] == []) is holds


def test_static_gate(spark):
    trace = [
        ("teleport", {"object_id": "ghost"}),
        ("get_line_length", {"line_id": "z1"}),
        ("get_vehicle_trajectory", {"vehicle_id": "v1", "time_range": "last_year"}),
        ("show_popup", {"target_id": "$get_object_info.id", "content": "c"}),
        ("show_popup", {"target_id": "", "content": "c"}),
        ("show_popup", {"target_id": 7, "content": "c"}),
    ]
    ghost = {"line": {"is_list": True, "ents": [{"id": "l1", "type": "line"}, {"id": "gone", "type": "line"}, {"id": "", "type": "line"}]}}

    def found(clarify):
        prepared = audit.prepare(samples(spark, [trace], ghost, clarify=clarify), objects(spark))
        return [(e.pos, e.error) for e in prepared.select(gates.static_errors()).first()[0]]

    always = [(-1, "selected_not_found"), (0, "unknown_tool"), (1, "type_mismatch"), (2, "invalid_time_range")]
    assert sorted(found(False)) == sorted([*always, (0, "object_id_not_found")])
    assert sorted(found(True)) == sorted(always)
