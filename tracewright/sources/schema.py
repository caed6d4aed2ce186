"""Table schemas, as DDL."""

GEOM = "struct<type: string, pt: array<double>, path: array<array<double>>, rings: array<array<array<double>>>>"

PROPS = "struct<speed_kmh: double, status: string, heading_deg: double, extra: map<string, string>>"

OBJECTS = (
    f"scenario_id string, ord bigint, id string, type string, name string, "
    f"aliases array<string>, geom {GEOM}, props {PROPS}"
)

ENTITY = "struct<id: string, type: string, name: string>"

# A slot holds nothing (null), one entity, or a list of entities.
SLOT = f"struct<is_list: boolean, ents: array<{ENTITY}>>"

SELECTED = f"struct<object: {SLOT}, line: {SLOT}, polygon: {SLOT}>"

ARTIFACT = "struct<artifact_id: string, artifact_type: string, label: string, source_object_id: string>"

POPUP = "struct<popup_id: string, target_id: string, content: string>"

STATE = (
    f"struct<time: string, selected: {SELECTED}, active_layers: array<string>, "
    f"drawn_artifacts: array<{ARTIFACT}>>"
)

ASSERTION = (
    "struct<type: string, artifact_type: string, source_object_id: string, object_id: string, "
    "object_ids: array<string>, object_type: string, target_id: string, time_range: string>"
)

STEP = "struct<tool: string, args: variant>"

TRACE = f"array<{STEP}>"

TARGET = "struct<reference_mode: string, expected_type: string, object_id: string>"

EXPECTED = (
    "struct<required_semantic_steps: array<string>, allowed_extra_tools: array<string>, "
    f"forbidden_tools: array<string>, final_state_assertions: array<{ASSERTION}>, "
    "should_ask_clarification: boolean>"
)

METADATA = (
    "struct<generator_model: string, blueprint_id: string, verified_by_schema: boolean, "
    "verified_by_execution: boolean, verified_by_llm: boolean, human_reviewed: boolean>"
)

BLUEPRINT = (
    f"scenario_id string, bp_ord bigint, task_type string, difficulty string, target {TARGET}, "
    "constraints variant, required_semantic_steps array<string>, "
    f"expected_final_state array<{ASSERTION}>, should_ask_clarification boolean, "
    "negative_case boolean, negative_type string, "
    f"selected {SELECTED}, active_layers array<string>, drawn_artifacts array<{ARTIFACT}>, "
    "requested_family string, requested_difficulty string"
)

SAMPLE = (
    "sample_ord bigint, id string, scenario_id string, tool_catalog_version string, language string, "
    f"difficulty string, task_type string, user_request string, initial_state {STATE}, "
    f"available_tools array<string>, gold_trace {TRACE}, expected {EXPECTED}, tags array<string>, "
    f"generation_metadata {METADATA}"
)
