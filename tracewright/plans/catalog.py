"""The tool catalog as fixed values: what each tool needs, returns and checks."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from .vocabulary import CLEAR_SCOPES, OBJECT_TYPES, SLOTS

TIME_RANGES = ["last_5_minutes", "last_10_minutes", "last_30_minutes", "last_1_hour", "today"]


@dataclass(frozen=True)
class Param:
    name: str
    type: str = "string"
    required: bool = True
    enum: list[str] | None = None


@dataclass(frozen=True)
class Tool:
    category: str
    params: list[Param] = field(default_factory=list)
    returns: list[str] = field(default_factory=list)
    side_effects: bool = False
    id_param: str | None = None  # the argument naming the object the tool works on
    echo: str | None = None  # the result field that gives that object back
    required_type: str | None = None  # type the object must have


# Names, parameters, enums and result fields of the 16 tools.
TOOLS = {
    "get_current_map_state": Tool(
        "state",
        returns=["time", "selected", "active_layers", "drawn_artifacts", "highlighted_objects", "popups"],
    ),
    "get_selected_entity": Tool(
        "state", [Param("entity_type", required=False, enum=SLOTS)], ["object", "line", "polygon", "entity"], echo="entity"
    ),
    "resolve_entity": Tool(
        "state",
        [Param("reference"), Param("expected_type", required=False, enum=OBJECT_TYPES)],
        ["entity", "confidence"],
        echo="entity",
    ),
    "get_object_info": Tool(
        "object", [Param("object_id")], ["id", "type", "name", "geometry", "properties"], id_param="object_id", echo="id"
    ),
    "get_vehicle_trajectory": Tool(
        "object",
        [Param("vehicle_id"), Param("time_range", enum=TIME_RANGES)],
        ["vehicle_id", "points", "timestamps", "time_range"],
        id_param="vehicle_id",
        echo="vehicle_id",
        required_type="vehicle",
    ),
    "get_nearby_objects": Tool(
        "object",
        [Param("object_id"), Param("object_type", enum=OBJECT_TYPES), Param("radius_meters", "number")],
        ["center_object_id", "results", "radius_meters"],
        id_param="object_id",
        echo="center_object_id",
    ),
    "get_polygon_area": Tool(
        "polygon",
        [Param("polygon_id")],
        ["polygon_id", "area_sqm"],
        id_param="polygon_id",
        echo="polygon_id",
        required_type="polygon",
    ),
    "get_line_length": Tool(
        "polygon", [Param("line_id")], ["line_id", "length_meters"], id_param="line_id", echo="line_id", required_type="line"
    ),
    "get_objects_inside_polygon": Tool(
        "polygon",
        [Param("polygon_id"), Param("object_type", enum=["vehicle", "camera"])],
        ["polygon_id", "results"],
        id_param="polygon_id",
        echo="polygon_id",
        required_type="polygon",
    ),
    "get_objects_crossing_line": Tool(
        "polygon",
        [Param("line_id"), Param("object_type", enum=["vehicle"]), Param("time_range", enum=TIME_RANGES)],
        ["line_id", "results"],
        id_param="line_id",
        echo="line_id",
        required_type="line",
    ),
    "highlight_objects": Tool("action", [Param("object_ids", "array")], ["highlighted"], side_effects=True),
    "draw_polyline": Tool(
        "action",
        [Param("points", "array"), Param("label"), Param("source_object_id", required=False)],
        ["artifact_id"],
        side_effects=True,
    ),
    "draw_polygon": Tool(
        "action", [Param("geometry", "object"), Param("label")], ["artifact_id"], side_effects=True
    ),
    "draw_marker": Tool(
        "action", [Param("coordinates", "array"), Param("label")], ["artifact_id"], side_effects=True
    ),
    "show_popup": Tool(
        "action", [Param("target_id"), Param("content")], ["popup_id"], side_effects=True, id_param="target_id"
    ),
    "clear_artifacts": Tool(
        "action", [Param("scope", enum=CLEAR_SCOPES)], ["cleared"], side_effects=True
    ),
}

# Result fields that are texts, whatever the tool.
TEXT_RESULTS = [
    "id", "type", "name", "vehicle_id", "polygon_id", "line_id", "center_object_id",
    "time_range", "time", "artifact_id", "popup_id", "cleared",
]

# Arguments the static gate looks up, whatever the tool.
ID_ARGUMENTS = ["object_id", "vehicle_id", "polygon_id", "line_id", "target_id"]

# Tools whose `results` are lists of objects.
SEARCH_TOOLS = ["get_objects_inside_polygon", "get_nearby_objects", "get_objects_crossing_line"]

# The type that the object named by an argument must have, where one is asked for.
ARGUMENT_TYPES = {"vehicle_id": "vehicle", "polygon_id": "polygon", "line_id": "line"}


def from_rows(rows: list) -> dict[str, Tool]:
    """Tools from the rows of sources.read_catalog, a few per tool.

    What a tool works on follows from its parameters: the first that names an object, and the result field
    that gives it back. Tools that the fixed catalog has keep their result fields; others
    return what the rows name in `returns`, where there is such a column.
    """
    tools: dict[str, Tool] = {}
    for row in rows:
        tool = tools.get(row["tool"])
        if tool is None:
            known = TOOLS.get(row["tool"])
            named = row["returns"] if "returns" in row and row["returns"] else None
            returns = list(named) if named is not None else list(known.returns) if known else []
            tool = tools[row["tool"]] = Tool(row["category"], [], returns, bool(row["side_effects"]))
        if row["param"] is not None:
            tool.params.append(Param(row["param"], row["type"], row["required"], row["enum"]))
    return {name: _with_roles(name, tool) for name, tool in tools.items()}


def _with_roles(name: str, tool: Tool) -> Tool:
    if name in ("resolve_entity", "get_selected_entity"):
        return replace(tool, echo="entity")
    own = next((p.name for p in tool.params if p.name in ID_ARGUMENTS), None)
    backs = [own, "id", "center_object_id"]
    return replace(
        tool, id_param=own, echo=next((f for f in backs if own and f in tool.returns), None), required_type=ARGUMENT_TYPES.get(own)
    )


class Rules:
    """A catalog as the lookups that the checks of a step need."""

    def __init__(self, tools: dict[str, Tool]):
        self.tools = tools
        self.id_param = {name: t.id_param for name, t in tools.items() if t.id_param}
        self.echo = {name: t.echo for name, t in tools.items() if t.echo}
        self.required_type = {name: t.required_type for name, t in tools.items() if t.required_type}
        self.required = {name: [p.name for p in t.params if p.required] for name, t in tools.items()}
        self.returns = {name: t.returns for name, t in tools.items()}
        self.texts = {name: [f for f in t.returns if f in TEXT_RESULTS] for name, t in tools.items()}
        self.searches = [name for name, t in tools.items() if "results" in t.returns]
        self.enums = {(name, p.name): p.enum for name, t in tools.items() for p in t.params if p.enum}
        ranges = [v for (_, param), values in self.enums.items() if param == "time_range" for v in values]
        self.time_ranges = list(dict.fromkeys(ranges))


RULES = Rules(TOOLS)
