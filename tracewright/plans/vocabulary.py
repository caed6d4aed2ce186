"""Fixed values shared by several operators: names that must match the data."""

# Task families a blueprint can be requested for.
TASK_FAMILIES = [
    "draw_vehicle_trajectory",
    "show_object_info",
    "highlight_selected_entity",
    "objects_inside_polygon",
    "objects_crossing_line",
    "polygon_area",
    "line_length",
    "nearby_objects",
    "artifact_modification",
    "unsupported_or_ambiguous",
]

DIFFICULTIES = ["L0", "L1", "L2", "L3", "L4", "L5"]

OBJECT_TYPES = ["vehicle", "camera", "polygon", "line"]

# Object categories of a scenario document, in reading order.
CATEGORIES = ["vehicles", "cameras", "polygons", "lines"]

SLOTS = ["object", "line", "polygon"]

DEFAULT_LAYERS = ["vehicles", "cameras", "roads", "zones"]

ALLOWED_EXTRA_TOOLS = ["get_object_info", "resolve_entity", "get_current_map_state"]

TOOL_CATALOG_VERSION = "map_tools_v0.1"

ASSERTION_TYPES = [
    "artifact_exists",
    "object_highlighted",
    "objects_highlighted",
    "popup_shown",
    "artifact_removed",
    "polyline_source_matches_vehicle",
    "objects_inside_polygon_highlighted",
    "no_tool_called",
    "clarification_requested",
]

CLEAR_SCOPES = ["all", "polylines", "polygons", "markers", "popups", "highlights"]
