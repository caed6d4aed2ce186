"""Gates, trace audit and final state, on samples with faults added by modulus."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewright.operators import conformance, gates, tool_results
from tracewright.operators import trace_audit as audit

from . import fixtures as fx
from .lookups import CROSSINGS
from .oracle_views import SAMPLE_ID, and_views, haversine, sample_id, with_views

QUERIES = {}
ORACLES = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return register


# Steps that each modulus adds.
_FLAGS = {13: 1, 17: 1, 19: 1, 23: 1, 29: 1, 31: 1, 37: 1, 41: 1, 43: 2, 47: 1, 53: 1, 59: 3, 61: 3, 67: 5, 71: 1}


def _position(m: int) -> str:
    """Position of the first step a modulus adds: after the trace and the steps of smaller ones."""
    before = [f"CAST(doc_id % {k} = 0 AS INTEGER) * {n}" for k, n in _FLAGS.items() if k < m]
    return " + ".join(["n0", *before])


_P = {m: _position(m) for m in _FLAGS}
FAULTY = {
    "faulty": f"""
  SELECT *, {sample_id('scenario_id', 'doc_id', '0')} AS id,
         CASE WHEN clarify OR family >= 8 THEN 0
              ELSE CASE family WHEN 0 THEN 3 + s WHEN 1 THEN 3 + s WHEN 2 THEN 3 WHEN 3 THEN 3 + s WHEN 7 THEN 3 ELSE 2 END END AS n0,
         CASE WHEN doc_id % 31 = 0 THEN list_extract(['all', 'polylines', 'highlights', 'popups', 'markers'], doc_id % 5 + 1) ELSE '' END AS clears
  FROM (SELECT *, CAST(sel AS INTEGER) AS s FROM bps)""",
    "static_errs": f"""
  SELECT id, doc_id, {_P[13]} AS pos, 'object_id_not_found' AS error FROM faulty WHERE doc_id % 13 = 0 AND NOT clarify
  UNION ALL SELECT id, doc_id, {_P[17]}, 'type_mismatch' FROM faulty WHERE doc_id % 17 = 0
  UNION ALL SELECT id, doc_id, {_P[19]}, 'type_mismatch' FROM faulty WHERE doc_id % 19 = 0 AND kind <> 'vehicle'
  UNION ALL SELECT id, doc_id, {_P[19]}, 'invalid_time_range' FROM faulty WHERE doc_id % 19 = 0
  UNION ALL SELECT id, doc_id, {_P[23]}, 'unknown_tool' FROM faulty WHERE doc_id % 23 = 0
  UNION ALL SELECT id, doc_id, -1, 'selected_not_found' FROM faulty WHERE doc_id % 29 = 1 AND family IN (5, 6)""",
    "exec_errs": f"""
  SELECT id, doc_id, {_P[13]} AS pos, 'get_object_info' AS tool, 'object_not_found' AS error FROM faulty WHERE doc_id % 13 = 0
  UNION ALL SELECT id, doc_id, {_P[17]}, CASE kind WHEN 'polygon' THEN 'get_line_length' ELSE 'get_polygon_area' END, 'type_mismatch' FROM faulty WHERE doc_id % 17 = 0
  UNION ALL SELECT id, doc_id, {_P[19]}, 'get_vehicle_trajectory', 'type_mismatch' FROM faulty WHERE doc_id % 19 = 0 AND kind <> 'vehicle'
  UNION ALL SELECT id, doc_id, {_P[23]}, 'teleport', 'unknown_tool' FROM faulty WHERE doc_id % 23 = 0
  UNION ALL SELECT id, doc_id, {_P[29]}, 'draw_polyline', 'unresolved_reference' FROM faulty WHERE doc_id % 29 = 0
  UNION ALL SELECT id, doc_id, {_P[41]}, 'draw_marker', 'missing_argument' FROM faulty WHERE doc_id % 41 = 0
  UNION ALL SELECT id, doc_id, {_P[47]}, 'highlight_objects', 'bad_highlight' FROM faulty WHERE doc_id % 47 = 0
  UNION ALL SELECT id, doc_id, {_P[53]}, 'clear_artifacts', 'invalid_scope' FROM faulty WHERE doc_id % 53 = 0
  UNION ALL SELECT id, doc_id, {_P[61]} + 2, 'show_popup', 'object_not_found' FROM faulty WHERE doc_id % 61 = 0""",
    "left_artifacts": f"""
  SELECT id, n0 - 1 AS pos, 'polyline' AS artifact_type, 'Trajectory of ' || target_id AS label, target_id AS source_object_id
  FROM faulty WHERE family = 0 AND NOT clarify AND clears NOT IN ('all', 'polylines')
  UNION ALL
  SELECT id, {_P[37]}, 'marker', 'm', NULL FROM faulty WHERE doc_id % 37 = 0""",
    "left_popups": f"""
  SELECT id, n0 - 1 AS pos, target_id, 'Info for ' || target_id AS content
  FROM faulty WHERE family = 1 AND NOT clarify AND clears NOT IN ('all', 'popups')
  UNION ALL SELECT id, {_P[43]} + 1, target_id, 'hi' FROM faulty WHERE doc_id % 43 = 0
  UNION ALL SELECT id, {_P[59]} + 2, target_id, 'via' FROM faulty WHERE doc_id % 59 = 0
  UNION ALL SELECT id, {_P[67]} + 4, target_id, 'deep' FROM faulty WHERE doc_id % 67 = 0""",
    # what the searches shown at the end find
    "found": f"""
  SELECT f.id, v.id AS object_id FROM faulty f JOIN zones z ON z.scenario_id = f.scenario_id AND z.id = f.target_id
         JOIN (SELECT scenario_id, id, type, lon, lat FROM vehicles UNION ALL SELECT scenario_id, id, type, lon, lat FROM cameras) v
         ON v.scenario_id = f.scenario_id AND v.type = coalesce(f.c_type, 'vehicle')
  WHERE family = 3 AND NOT clarify AND v.lon > x0 AND v.lon < x1 AND v.lat > y0 AND v.lat < y1
  UNION ALL
  SELECT f.id, c.id FROM faulty f JOIN vehicles v ON v.scenario_id = f.scenario_id AND v.id = f.target_id
         JOIN cameras c ON c.scenario_id = f.scenario_id
  WHERE family = 7 AND NOT clarify AND {haversine('v.lon', 'v.lat', 'c.lon', 'c.lat')} <= coalesce(c_radius, 1000)""",
}
FAULTY["left_lit"] = """
  SELECT f.id, r.object_id FROM faulty f JOIN found r ON r.id = f.id WHERE clears NOT IN ('all', 'highlights')
  UNION ALL
  SELECT id, target_id FROM faulty WHERE family = 2 AND NOT clarify AND clears NOT IN ('all', 'highlights')"""
CASCADE = {
    **FAULTY,
    "flags": """
  SELECT f.*, true AS schema_pass,
         NOT EXISTS (SELECT 1 FROM static_errs e WHERE e.id = f.id) AS static_ok,
         NOT EXISTS (SELECT 1 FROM exec_errs e WHERE e.id = f.id) AS exec_ok,
         EXISTS (SELECT 1 FROM found r WHERE r.id = f.id) AND clears NOT IN ('all', 'highlights') AS any_found,
         n0 + CAST(list_sum([CAST(doc_id % m = 0 AS INTEGER) FOR m IN [13, 17, 19, 23, 29, 31, 37, 41, 43, 47, 53, 59, 61, 67, 71]]) AS INTEGER) AS n_steps
  FROM faulty f""",
    "gated": """
  SELECT *, static_ok AS static_pass, static_ok AND exec_ok AS exec_pass, static_ok AND exec_ok AND assert_ok AS assert_pass,
         static_ok AND exec_ok AND assert_ok AND coalesce(valid, false) AS semantic_pass
  FROM (SELECT f.*, quality = 1 AS valid,
          CASE WHEN clarify THEN true
               WHEN n_steps = 0 THEN family NOT IN (0, 1, 2, 3, 7, 8, 9)
               WHEN family = 0 THEN clears NOT IN ('all', 'polylines')
               WHEN family = 1 THEN clears NOT IN ('all', 'popups') OR doc_id % 43 = 0 OR doc_id % 59 = 0 OR doc_id % 67 = 0
               WHEN family = 2 THEN clears NOT IN ('all', 'highlights')
               WHEN family IN (3, 7) THEN any_found
               WHEN family = 8 THEN doc_id % 29 <> 0
               ELSE true END AS assert_ok
        FROM flags f LEFT JOIN (SELECT doc_id AS l_doc, quality FROM labels) l ON l.l_doc = f.doc_id)""",
    # Negatives ask back, which is all they have to do; their documents' labels are the verdicts.
    "gated_all": f"""
  SELECT id, doc_id, schema_pass, static_pass, exec_pass, assert_pass, semantic_pass FROM gated
  UNION ALL
  SELECT {SAMPLE_ID}, doc_id, true, true, true, true, coalesce(quality = 1, false)
  FROM negs LEFT JOIN (SELECT doc_id AS l_doc, quality FROM labels) l ON l.l_doc = negs.doc_id""",
}
_VIEWS = "bps vehicles cameras zones negs"


def _verified(spark, sf_dir):
    samples = fx.faulty_samples(spark, sf_dir)
    return gates.verify(
        samples,
        fx.scenarios(spark, sf_dir),
        fx.objects(spark, sf_dir),
        fx.traj(spark, sf_dir),
        fx.verdicts(spark, sf_dir, samples),
    )


def _errors(gated, column, *fields):
    return gated.select("id", F.col("sample_ord.blueprint").alias("doc_id"), F.explode(column).alias("e")).select(
        "id", "doc_id", *[F.col(f"e.{f}").alias(f) for f in fields]
    )


@query("static_check", and_views(_VIEWS, FAULTY, "SELECT id, doc_id, pos, error FROM static_errs"))
def static_check(spark, sf_dir):
    prepared = audit.prepare(fx.faulty_traces(spark, sf_dir), fx.objects(spark, sf_dir))
    return _errors(prepared.withColumn("errors", gates.static_errors()), "errors", "pos", "error")


@query("execution_check", and_views(_VIEWS, FAULTY, "SELECT id, doc_id, pos, tool, error FROM exec_errs"))
def execution_check(spark, sf_dir):
    prepared = audit.prepare(fx.faulty_traces(spark, sf_dir), fx.objects(spark, sf_dir))
    return _errors(prepared.withColumn("errors", audit.step_errors()), "errors", "pos", "tool", "error")


@query(
    "execution_check_strict",
    and_views(
        _VIEWS,
        FAULTY,
        f"""
SELECT id, doc_id, pos, tool, error FROM exec_errs
UNION ALL
SELECT id, doc_id, n0 - 1, 'highlight_objects', 'bad_highlight' FROM faulty f WHERE EXISTS (SELECT 1 FROM found r WHERE r.id = f.id)
UNION ALL
SELECT id, doc_id, {_P[43]} + 1, 'show_popup', 'object_not_found' FROM faulty WHERE doc_id % 43 = 0
UNION ALL
SELECT id, doc_id, {_P[59]} + 2, 'show_popup', 'object_not_found' FROM faulty WHERE doc_id % 59 = 0
UNION ALL
SELECT id, doc_id, {_P[67]} + 2, 'get_object_info', 'object_not_found' FROM faulty WHERE doc_id % 67 = 0
UNION ALL
SELECT id, doc_id, {_P[67]} + 4, 'show_popup', 'object_not_found' FROM faulty WHERE doc_id % 67 = 0""",
    ),
)
def execution_check_strict(spark, sf_dir):
    objects = fx.objects(spark, sf_dir)
    prepared = fx.materialize(audit.prepare(fx.faulty_traces(spark, sf_dir), objects, strict_refs=True))
    queries = fx.materialize(audit.searches(prepared))
    sizes = audit.keyed_sizes(queries, fx.scenarios(spark, sf_dir), objects, fx.traj(spark, sf_dir))
    sized = audit.with_search_sizes(prepared, queries, sizes)
    checked = sized.withColumn("errors", audit.step_errors(strict_refs=True))
    return _errors(checked, "errors", "pos", "tool", "error")


@query(
    "final_artifacts",
    and_views(
        _VIEWS,
        FAULTY,
        f"""
SELECT id, pos, 'artifact_' || substr(sha256(id || '|' || pos), 1, 16) AS artifact_id, artifact_type, label, source_object_id
FROM left_artifacts
WHERE id NOT IN (SELECT id FROM exec_errs)""",
    ),
)
def final_artifacts(spark, sf_dir):
    return _final(spark, sf_dir).select("id", F.inline("artifacts"))


def _final(spark, sf_dir):
    prepared = audit.prepare(fx.faulty_traces(spark, sf_dir), fx.objects(spark, sf_dir)).drop("gold_trace")
    return audit.with_final_state(prepared.filter(F.size(audit.step_errors()) == 0))


@query(
    "final_popups",
    and_views(
        _VIEWS,
        FAULTY,
        f"""
SELECT id, pos, 'popup_' || substr(sha256(id || '|' || pos), 1, 16) AS popup_id, target_id, content
FROM left_popups
WHERE id NOT IN (SELECT id FROM exec_errs)""",
    ),
)
def final_popups(spark, sf_dir):
    return _final(spark, sf_dir).select("id", F.inline("popups"))


@query(
    "final_highlights",
    and_views(
        _VIEWS,
        FAULTY,
        """
SELECT id, object_id FROM left_lit
WHERE id NOT IN (SELECT id FROM exec_errs)""",
    ),
)
def final_highlights(spark, sf_dir):
    stated = fx.materialize(_final(spark, sf_dir))
    return audit.highlighted_objects(stated, *_world(spark, sf_dir))


def _world(spark, sf_dir):
    return fx.scenarios(spark, sf_dir), fx.objects(spark, sf_dir), fx.traj(spark, sf_dir)


def _slots(case: str) -> str:
    return "'" + " || ';".join(f"{slot}=' || {case.format(kind=kind)}" for slot, kind in (("object", "vehicle"), ("line", "line"), ("polygon", "polygon")))


_SELECTED = (
    "CASE WHEN doc_id % 29 = 1 AND family IN (5, 6) THEN replace(" + _slots("CASE WHEN sel AND kind = '{kind}' THEN target_id ELSE '' END")
    + ", 'object=;', 'object=' || target_id || ',vehicle_missing;') ELSE " + _slots("CASE WHEN sel AND kind = '{kind}' THEN target_id ELSE '' END") + " END"
)
_NEG_SELECTED = _slots("CASE WHEN replace(shown_type, 'camera', 'vehicle') = '{kind}' THEN shown ELSE '' END")
_STATE = {
    **FAULTY,
    "drawn": """
  SELECT id, string_agg('artifact_' || substr(sha256(id || '|' || pos), 1, 16) || ' ' || artifact_type || ' ' || label || ' ' || coalesce(source_object_id, '-'),
                        ';' ORDER BY pos) AS drawn FROM left_artifacts GROUP BY id""",
    "popped": """
  SELECT id, string_agg('popup_' || substr(sha256(id || '|' || pos), 1, 16) || ' ' || target_id || ' ' || content, ';' ORDER BY pos) AS popped
  FROM left_popups GROUP BY id""",
    "lit": "SELECT id, string_agg(object_id, ',' ORDER BY object_id) AS lit FROM (SELECT DISTINCT id, object_id FROM left_lit) GROUP BY id",
    "ends": f"""
  SELECT id, doc_id, n0, {_P[71]} AS pos71, {_SELECTED} AS selected, coalesce(drawn, '') AS drawn, coalesce(lit, '') AS lit, coalesce(popped, '') AS popped
  FROM faulty LEFT JOIN drawn USING (id) LEFT JOIN lit USING (id) LEFT JOIN popped USING (id)""",
}
_TIME = "'2024-01-30T23:30:00Z' AS time, 'vehicles,cameras,roads,zones' AS layers"


def _as_text(states):
    """The parts of a state as text, to be compared with SQL."""
    selected = F.concat_ws(
        ";",
        *[
            F.concat(F.lit(f"{s}="), F.coalesce(F.array_join(F.transform(F.col("selected")[s].ents, lambda e: e.id), ","), F.lit("")))
            for s in ("object", "line", "polygon")
        ],
    )
    fields = lambda x, *names: F.concat_ws(" ", *[F.coalesce(x[n], F.lit("-")) for n in names])
    drawn = F.transform("drawn_artifacts", lambda a: fields(a, "artifact_id", "artifact_type", "label", "source_object_id"))
    popped = F.transform("popups", lambda p: fields(p, "popup_id", "target_id", "content"))
    return states.select(
        "id",
        "at",
        "time",
        F.array_join("active_layers", ",").alias("layers"),
        selected.alias("selected"),
        F.array_join(drawn, ";").alias("drawn"),
        F.array_join("highlighted_objects", ",").alias("lit"),
        F.array_join(popped, ";").alias("popped"),
    )


@query(
    "final_state",
    and_views(
        _VIEWS,
        _STATE,
        f"""
SELECT id, {_TIME}, selected, drawn, lit, popped FROM ends WHERE id NOT IN (SELECT id FROM exec_errs)
UNION ALL
SELECT {SAMPLE_ID}, {_TIME}, {_NEG_SELECTED}, '', '', '' FROM negs""",
    ),
)
def final_state(spark, sf_dir):
    """The whole state that every sample without errors ends in, in one row."""
    prepared = audit.prepare(fx.faulty_traces(spark, sf_dir), fx.objects(spark, sf_dir)).drop("gold_trace")
    timed = fx.materialize(audit.with_timeline(prepared.filter(F.size(audit.step_errors()) == 0)))
    end = F.array(F.size("steps"))
    queries = fx.materialize(audit.searches_on_map(timed, end))
    found = audit.shown_results(queries, *_world(spark, sf_dir))
    return _as_text(audit.states_with(timed, end, found)).drop("at")


@query(
    "map_states",
    and_views(
        _VIEWS,
        _STATE,
        f"""
SELECT id, 0 AS at, {_TIME}, selected, '' AS drawn, '' AS lit, '' AS popped FROM ends WHERE n0 > 0
UNION ALL
SELECT id, pos71, {_TIME}, selected, drawn, lit, popped FROM ends WHERE doc_id % 71 = 0 AND id NOT IN (SELECT id FROM exec_errs)""",
    ),
)
def map_states(spark, sf_dir):
    """The whole state at every get_current_map_state step, those in mid-trace for samples without errors."""
    prepared = audit.prepare(fx.faulty_traces(spark, sf_dir), fx.objects(spark, sf_dir)).drop("gold_trace")
    fine = F.size(audit.step_errors()) == 0
    timed = fx.materialize(audit.with_timeline(prepared.withColumn("fine", fine)))
    calls = F.filter("steps", lambda s: (s.tool == "get_current_map_state") & (F.col("fine") | (s.pos == 0)))
    asked = timed.withColumn("_at", F.transform(calls, lambda s: s.pos))
    queries = fx.materialize(audit.searches_on_map(asked, F.col("_at")))
    return _as_text(audit.states_with(asked, F.col("_at"), audit.shown_results(queries, *_world(spark, sf_dir))))


@query(
    "gate_cascade",
    and_views(
        _VIEWS,
        CASCADE,
        "SELECT id, doc_id, schema_pass, static_pass, exec_pass, assert_pass, semantic_pass, semantic_pass AS marked_verified FROM gated_all",
    ),
)
def gate_cascade(spark, sf_dir):
    return _verified(spark, sf_dir).select(
        "id",
        F.col("sample_ord.blueprint").alias("doc_id"),
        *gates.GATES,
        F.col("generation_metadata.verified_by_llm").alias("marked_verified"),
    )


@query(
    "schema_check",
    with_views(
        "samples",
        f"""
SELECT id, error FROM (
  SELECT {SAMPLE_ID} AS id, unnest(list_filter([CASE WHEN doc_id % 7 = 0 THEN 'user_request' END, CASE WHEN doc_id % 5 = 0 THEN 'difficulty' END,
          CASE WHEN doc_id % 11 = 1 THEN 'initial_state.selected' END, CASE WHEN doc_id % 13 = 2 THEN 'assertion.type' END,
          CASE WHEN doc_id % 17 = 3 AND traced THEN 'gold_trace.tool' END], lambda x: x IS NOT NULL)) AS error
  FROM samples)""",
    ),
)
def schema_check(spark, sf_dir):
    d = F.col("sample_ord.blueprint")
    unknown = F.transform("expected.final_state_assertions", lambda a: a.withField("type", F.lit("no_such_type")))
    odd = F.array(fx.assertion("no_such_type"))
    broken = (
        fx.samples(spark, sf_dir)
        .withColumn("user_request", F.when(d % 7 != 0, F.col("user_request")))
        .withColumn("difficulty", F.when(d % 5 == 0, "L9").otherwise(F.col("difficulty")))
        .withColumn(
            "initial_state",
            F.when(d % 11 == 1, F.col("initial_state").withField("selected", F.lit(None).cast(fx.schema.SELECTED))).otherwise(F.col("initial_state")),
        )
        .withColumn(
            "expected",
            F.when(d % 13 == 2, F.col("expected").withField("final_state_assertions", F.concat(unknown, odd))).otherwise(F.col("expected")),
        )
        .withColumn(
            "gold_trace",
            F.when(d % 17 == 3, F.transform("gold_trace", lambda s: s.withField("tool", F.lit(None).cast("string")))).otherwise(F.col("gold_trace")),
        )
    )
    return broken.select("id", F.explode(gates.schema_errors()).alias("error"))


@query(
    "argument_check",
    and_views(
        _VIEWS,
        FAULTY,
        f"""
SELECT id, {_P[19]} AS pos, 'get_vehicle_trajectory' AS tool, 'time_range' AS param, 'not_in_enum' AS error FROM faulty WHERE doc_id % 19 = 0
UNION ALL SELECT id, {_P[53]}, 'clear_artifacts', 'scope', 'not_in_enum' FROM faulty WHERE doc_id % 53 = 0""",
    ),
)
def argument_check(spark, sf_dir):
    return conformance.argument_errors(fx.faulty_traces(spark, sf_dir), conformance.tool_params_table(spark))


@query(
    "task_tool_check",
    and_views(
        "bps",
        {
            "kept": f"""
  SELECT {sample_id('scenario_id', 'doc_id', '0')} AS id, task_type, family, doc_id FROM bps WHERE NOT clarify AND family < 8 AND doc_id % 4 = 0"""
        },
        """
SELECT id, task_type, CASE family WHEN 0 THEN 'draw_polyline' WHEN 1 THEN 'show_popup' WHEN 4 THEN 'get_objects_crossing_line'
       WHEN 5 THEN 'get_polygon_area' WHEN 6 THEN 'get_line_length' ELSE 'highlight_objects' END AS missing
FROM kept""",
    ),
)
def task_tool_check(spark, sf_dir):
    """Traces of every fourth blueprint lose their last step."""
    s = fx.samples(spark, sf_dir, with_negatives=False)
    short = F.slice("gold_trace", F.lit(1), F.greatest(F.size("gold_trace") - 1, F.lit(0)))
    cut = s.withColumn("gold_trace", F.when(F.col("sample_ord.blueprint") % 4 == 0, short).otherwise(F.col("gold_trace")))
    return conformance.task_tool_mismatches(cut).withColumn("missing", F.array_join("missing", ","))


@query(
    "policy_check",
    with_views(
        "bps",
        f"""
SELECT {sample_id('scenario_id', 'doc_id', '0')} AS id, CASE WHEN doc_id % 3 = 0 THEN 'clear_artifacts' ELSE '' END AS forbidden,
       CASE WHEN doc_id % 3 = 0 THEN 'clear_artifacts' ELSE '' END AS not_allowed,
       CASE WHEN clarify OR family >= 8 THEN '' WHEN family = 0 THEN 'draw_polyline,get_vehicle_trajectory' WHEN family = 1 THEN 'show_popup'
            WHEN family = 2 THEN 'get_selected_entity,highlight_objects' WHEN family = 3 THEN 'get_objects_inside_polygon,highlight_objects'
            WHEN family = 4 THEN 'get_objects_crossing_line' WHEN family = 5 THEN 'get_polygon_area' WHEN family = 6 THEN 'get_line_length'
            ELSE 'get_nearby_objects,highlight_objects' END AS missing
FROM (SELECT * REPLACE (CASE WHEN family IN (0, 1, 3) THEN false ELSE sel END AS sel) FROM bps)""",
    ),
)
def policy_check(spark, sf_dir):
    """Agents that call resolve_entity, get_selected_entity where it helps, and sometimes clear the map."""
    s = fx.samples(spark, sf_dir, with_negatives=False)
    tools = F.array(F.lit("resolve_entity"), F.lit("get_current_map_state"))
    gold = F.transform("gold_trace", lambda x: x.tool)
    looked = F.array_intersect(gold, F.array(F.lit("get_selected_entity")))
    family = F.col("sample_ord.blueprint") % 10
    tools = F.concat(
        tools,
        F.when(family.isin(0, 1, 3), looked).otherwise(F.array().cast("array<string>")),
        F.when(F.col("sample_ord.blueprint") % 3 == 0, F.array(F.lit("clear_artifacts"))).otherwise(F.array().cast("array<string>")),
    )
    agents = s.select("id", tools.alias("tools"))
    strict = s.withColumn("expected", F.col("expected").withField("forbidden_tools", F.array(F.lit("clear_artifacts"), F.lit("delete_object"))))
    found = conformance.policy_violations(strict, agents)
    return found.select("id", *[F.array_join(c, ",").alias(c) for c in ("forbidden", "not_allowed", "missing")])


@query(
    "search_results",
    and_views(
        "bps vehicles cameras zones roads traj scenarios",
        {**FAULTY, **CROSSINGS},
        f"""
SELECT f.scenario_id, 'get_objects_inside_polygon' AS tool, f.target_id AS object_id, coalesce(c_type, 'vehicle') AS object_type,
       CAST(NULL AS DOUBLE) AS radius_meters, CAST(NULL AS VARCHAR) AS time_range, count(DISTINCT r.object_id) AS n
FROM faulty f JOIN found r ON r.id = f.id WHERE family = 3 GROUP BY ALL
UNION ALL
SELECT f.scenario_id, 'get_nearby_objects', f.target_id, 'camera', CAST(coalesce(c_radius, 1000) AS DOUBLE), NULL, count(DISTINCT r.object_id)
FROM faulty f JOIN found r ON r.id = f.id WHERE family = 7 GROUP BY ALL
UNION ALL
SELECT f.scenario_id, 'get_objects_crossing_line', f.target_id, 'vehicle', NULL, f.time_range, count(DISTINCT c.id)
FROM (SELECT DISTINCT scenario_id, target_id, coalesce(c_range, 'last_10_minutes') AS time_range FROM faulty WHERE family = 4 AND NOT clarify) f
JOIN crossings c ON c.scenario_id = f.scenario_id AND c.line_id = f.target_id AND c.time_range = f.time_range GROUP BY ALL""",
    ),
)
def search_results(spark, sf_dir):
    """Result sizes of every distinct search in the traces, whether or not it is highlighted."""
    asked = audit.all_searches(audit.followed(fx.faulty_traces(spark, sf_dir), fx.objects(spark, sf_dir)))
    return audit.result_sizes(
        fx.materialize(asked), fx.scenarios(spark, sf_dir), fx.objects(spark, sf_dir), fx.traj(spark, sf_dir)
    )


_AREA = """round(abs(((x1 - x0) * (y0 - y1) + (x1 - x0) * (y0 - y1) + (x0 - x0) * (y1 - y0)) / 2)
             * CAST(111320 AS DOUBLE) * (CAST(111320 AS DOUBLE) * cos(radians((y0 + y0 + y1 + y1 + y0) / 5))), 2)"""
_LENGTH = f"round({haversine('x0', 'y0', 'x1', 'y1')} + {haversine('x1', 'y1', 'x2', 'y2')} + {haversine('x2', 'y2', 'x3', 'y3')}, 2)"


@query(
    "tool_results",
    and_views(
        "bps objects zones roads",
        {
            **FAULTY,
            "areas": f"SELECT scenario_id, id, {_AREA} AS v FROM zones",
            "lengths": f"SELECT scenario_id, id, {_LENGTH} AS v FROM roads",
        },
        f"""
SELECT id, 0 AS pos, 'get_current_map_state' AS tool, CASE WHEN sel THEN target_id END AS entity, CAST(NULL AS DOUBLE) AS number
FROM faulty WHERE n0 > 0
UNION ALL SELECT id, 1, 'get_selected_entity', CASE WHEN sel THEN target_id END, NULL FROM faulty WHERE n0 > 0 AND (family = 2 OR (family IN (0, 1, 3) AND sel))
UNION ALL SELECT id, n0 - 2, 'get_object_info', target_id, NULL FROM faulty WHERE n0 > 0 AND family = 1
UNION ALL SELECT f.id, n0 - 1, 'get_polygon_area', target_id, v FROM faulty f JOIN areas a ON a.scenario_id = f.scenario_id AND a.id = f.target_id WHERE n0 > 0 AND family = 5
UNION ALL SELECT f.id, n0 - 1, 'get_line_length', target_id, v FROM faulty f JOIN lengths a ON a.scenario_id = f.scenario_id AND a.id = f.target_id WHERE n0 > 0 AND family = 6
UNION ALL SELECT id, {_P[43]}, 'resolve_entity', target_id, 1 FROM faulty WHERE doc_id % 43 = 0
UNION ALL SELECT id, {_P[59]} + i, tool, target_id, n FROM faulty, (VALUES (0, 'get_object_info', NULL), (1, 'resolve_entity', 1)) s(i, tool, n) WHERE doc_id % 59 = 0
UNION ALL SELECT id, {_P[61]} + i, tool, CASE i WHEN 0 THEN target_id END, n FROM faulty, (VALUES (0, 'get_object_info', NULL), (1, 'resolve_entity', 0)) s(i, tool, n)
WHERE doc_id % 61 = 0
UNION ALL SELECT id, {_P[67]} + i, tool, target_id, n
FROM faulty, (VALUES (0, 'get_object_info', NULL), (1, 'resolve_entity', 1), (2, 'get_object_info', NULL), (3, 'resolve_entity', 1)) s(i, tool, n) WHERE doc_id % 67 = 0
UNION ALL SELECT id, {_P[71]}, 'get_current_map_state', CASE WHEN sel THEN target_id END, NULL FROM faulty WHERE doc_id % 71 = 0""",
    ),
)
def read_tool_results(spark, sf_dir):
    objects = fx.objects(spark, sf_dir)
    prepared = fx.materialize(audit.prepare(fx.faulty_traces(spark, sf_dir), objects).drop("gold_trace"))
    found = tool_results.read_results(prepared, *_world(spark, sf_dir))
    get = lambda path, kind: F.try_variant_get("result", path, kind)
    ids = ["$.entity.id", "$.id", "$.polygon_id", "$.line_id", "$.selected.object.id", "$.selected.line.id", "$.selected.polygon.id"]
    return found.select(
        "id",
        "pos",
        "tool",
        F.coalesce(*[get(p, "string") for p in ids]).alias("entity"),
        F.coalesce(*[get(p, "double") for p in ("$.area_sqm", "$.length_meters", "$.confidence")]).alias("number"),
    )


@query(
    "trajectory_results",
    and_views(
        "bps vehicles traj scenarios",
        {"faulty": FAULTY["faulty"]},
        """
SELECT t.scenario_id, t.object_id AS vehicle_id, a.time_range, t.pos, t.lon, t.lat
FROM (SELECT DISTINCT scenario_id, target_id, coalesce(c_range, 'last_10_minutes') AS time_range FROM faulty WHERE family = 0 AND n0 > 0
      UNION SELECT scenario_id, target_id, 'last_year' FROM faulty WHERE doc_id % 19 = 0 AND kind = 'vehicle') a
JOIN traj t ON t.scenario_id = a.scenario_id AND t.object_id = a.target_id JOIN scenarios s ON s.scenario_id = t.scenario_id
WHERE t.ts >= s.time - CASE a.time_range WHEN 'today' THEN 1440 ELSE 10 END * INTERVAL 1 MINUTE""",
    ),
)
def trajectory_results(spark, sf_dir):
    objects = fx.objects(spark, sf_dir)
    asking = F.exists("gold_trace", lambda s: s.tool == "get_vehicle_trajectory")
    followed = audit.followed(fx.faulty_traces(spark, sf_dir).filter(asking), objects)
    points = tool_results.trajectory_points(followed, fx.scenarios(spark, sf_dir), objects, fx.traj(spark, sf_dir))
    return points.drop("ts")
