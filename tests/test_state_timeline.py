"""Chains of references and the state at every step, against a replay step by step."""

import random

import pytest
from pyspark.sql import functions as F

from tracewright.operators import skew
from tracewright.operators import trace_audit as audit
from tracewright.plans import catalog

from test_trace_audit import OBJECTS, objects, samples

NAMES = {"v1": "Truck", "v2": "Bus", "c1": "Cam", "z1": "Zone", "l1": "Road"}


def random_trace(rng):
    steps = [("get_object_info", {"object_id": rng.choice([*OBJECTS, "ghost"] if rng.random() < 0.1 else list(OBJECTS))})]
    for _ in range(rng.randint(2, 9)):
        steps.append(
            rng.choice(
                [
                    ("get_object_info", {"object_id": rng.choice([*OBJECTS, "$resolve_entity.entity", "$get_object_info.id"])}),
                    ("resolve_entity", {"reference": rng.choice(["$get_object_info.name", "$get_object_info.id", "$get_object_info.type", "the bus", "nobody"])}),
                    ("resolve_entity", {"reference": "$get_object_info.name", "expected_type": rng.choice(["vehicle", "camera"])}),
                    ("resolve_entity", {"reference": rng.choice(["$resolve_entity.entity", "$get_object_info.geometry", "$clear_artifacts.cleared"])}),
                    ("show_popup", {"target_id": "$resolve_entity.entity", "content": "c"}),
                    ("draw_marker", {"coordinates": [1, 2], "label": "m"}),
                    ("draw_polygon", {"geometry": {}, "label": "z"}),
                    ("highlight_objects", {"object_ids": rng.sample(list(OBJECTS), 2)}),
                    ("clear_artifacts", {"scope": rng.choice(["all", "markers", "popups", "highlights"])}),
                ]
            )
        )
    return steps


class Failed(Exception):
    pass


def look_up(text, kind):
    for oid, name in NAMES.items():
        if text.strip().lower() in (oid, name.lower(), f"the {name}".lower()) and kind in (None, OBJECTS[oid]):
            return oid
    return None


def replay(trace, strict):
    """The states before each step and at the end, as far as the trace goes."""
    results, items, states = {}, [], []

    def value(v):
        if not (isinstance(v, str) and v.startswith("$")):
            return v
        tool, field = v[1:].split(".")
        if tool not in results or field not in results[tool]:
            raise Failed
        return results[tool][field]

    def as_id(v):
        v = (v if not isinstance(v, tuple) else None if strict else v[0])
        if v not in OBJECTS:
            raise Failed
        return v

    for tool, args in trace:
        states.append(sorted(items))
        a = {k: value(v) for k, v in args.items()}
        if tool == "get_object_info":
            oid = as_id(a["object_id"])
            results[tool] = {"id": oid, "name": NAMES[oid], "type": OBJECTS[oid], "geometry": []}
        elif tool == "resolve_entity":
            ref = a["reference"]
            if isinstance(ref, tuple) and not strict and ref[0] is not None:
                ref = ref[0]
            elif isinstance(ref, tuple) and not strict:
                ref = "\0"
            if not isinstance(ref, str):
                raise Failed
            results[tool] = {"entity": (look_up(ref, a.get("expected_type")),)}
        elif tool == "show_popup":
            items.append(("popups", as_id(a["target_id"])))
        elif tool.startswith("draw_"):
            items.append((tool[5:] + "s", a["label"]))
        elif tool == "highlight_objects":
            items += [("highlights", oid) for oid in a["object_ids"] if ("highlights", oid) not in items]
        elif tool == "clear_artifacts":
            items = [x for x in items if a["scope"] not in ("all", x[0])]
            results[tool] = {"cleared": a["scope"]}
    return [*states, sorted(items)]


@pytest.mark.parametrize("strict", [False, True])
def test_chains_and_states_as_in_a_replay(spark, strict):
    rng = random.Random(4)
    traces = [random_trace(rng) for _ in range(400)]
    prepared = audit.prepare(samples(spark, traces), objects(spark), strict)
    timed = audit.with_timeline(prepared.withColumn("found", F.create_map().cast("map<int,bigint>"))).select(
        "*", (F.size(audit.step_errors(strict)) == 0).alias("fine")
    )
    queries = spark.createDataFrame([], "id string, pos int, key string")
    results = spark.createDataFrame([], "key string, result_id string")
    every = F.sequence(F.lit(0), F.size("steps"))
    got = {}
    for r in audit.states(timed.filter("fine"), every, queries, results).collect():
        shown = [("highlights", x) for x in r.highlighted_objects] + [("popups", p.target_id) for p in r.popups]
        got.setdefault(r.id, {})[r.at] = sorted(shown + [(a.artifact_type + "s", a.label) for a in r.drawn_artifacts])
    good = 0
    for i, trace in enumerate(traces):
        try:
            want = replay(trace, strict)
        except Failed:
            assert f"id{i}" not in got, trace
            continue
        good += 1
        assert got[f"id{i}"] == dict(enumerate(want)), trace
    assert 30 < good < 400


def test_numbers_of_a_group_in_many_partitions(spark):
    rows = [("hot", i * 7 % 5003, 0) for i in range(5003)] + [(f"g{i % 50}", i, 1) for i in range(500)]
    got = skew.with_index(spark.createDataFrame(rows, "g string, o int, x int"), ["g"], ["o"], "n").collect()
    groups = {}
    for r in got:
        groups.setdefault(r.g, []).append((r.o, r.n))
    assert len(got) == len(rows)
    assert all([n for _, n in sorted(g)] == list(range(len(g))) for g in groups.values())


def test_more_hot_keys_than_are_broadcast(spark, monkeypatch):
    monkeypatch.setattr(skew, "BROADCAST_KEYS", 1)
    left = spark.createDataFrame([(k, i) for k in range(3) for i in range(40)], "k int, a int")
    right = spark.createDataFrame([(k, i) for k in range(4) for i in range(30)], "k int, b int")
    joined = skew.block_join(left, right, ["k"], ["a"], ["b"], block_rows=10)
    assert joined.select("k", "a", "b").distinct().count() == joined.count() == 3 * 40 * 30


def test_catalog_from_rows():
    rows = [
        {"tool": t, "category": tool.category, "side_effects": tool.side_effects, "param": p and p.name, "type": p and p.type,
         "required": p and p.required, "enum": p and p.enum}
        for t, tool in catalog.TOOLS.items()
        for p in (tool.params or [None])
    ]
    assert catalog.from_rows(rows) == catalog.TOOLS
    more = [{"tool": "describe", "category": "object", "side_effects": False, "param": "vehicle_id", "type": "string", "required": True, "enum": None, "returns": ["vehicle_id"]}]
    made = catalog.from_rows(more)["describe"]
    assert (made.id_param, made.echo, made.required_type) == ("vehicle_id", "vehicle_id", "vehicle")
