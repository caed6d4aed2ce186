"""Set-based audit of tool traces: is every step valid, and what state does the trace end in?

Steps are not replayed. A trace is valid iff every step is valid assuming the ones before it
succeeded, so each step is checked on its own; an item drawn, highlighted or shown survives
iff no later step clears its kind. A trace is one row, so checks and survivors are array
expressions on that row. Only object ids and search results need other tables: each sample
asks for its distinct ids once, and each distinct search is run once for all samples.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.variants import string_value
from ..plans.catalog import ID_ARGUMENTS, RULES, SEARCH_TOOLS, Rules
from ..plans.vocabulary import CLEAR_SCOPES, SLOTS
from ..session import materialize
from . import spatial
from .lookup import by_id, resolve_reference, types_by_id

# Fixed value: the form of a reference to an earlier result, as a whole string argument.
REFERENCE = r"(?U)^\$(\w+)\.(\w+)$"

QUERY = ["scenario_id", "tool", "object_id", "object_type", "radius_meters", "time_range"]


def _by_tool(values: dict[str, object], kind: str) -> Column:
    pairs = [F.lit(x) if not isinstance(x, Column) else x for x in chain.from_iterable(values.items())]
    return F.create_map(*pairs) if pairs else F.create_map().cast(f"map<string,{kind}>")


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


KNOWN = "map<int,struct<id:string,name:string,type:string>>"


def _reference(value: Column, part: int) -> Column:
    """Tool (1) or field (2) of a reference, null for anything else."""
    found = F.regexp_extract(value, REFERENCE, part)
    return F.when(found != "", found)


def _given(value: Column) -> Column:
    """Whether an argument is there and not null."""
    return value.isNotNull() & ~F.is_variant_null(value)


def latest_before(tools: Column, tool: Column, pos: Column) -> Column:
    """Index of the latest step before `pos` that calls the tool."""
    earlier = F.slice(tools, F.lit(1), pos)
    return F.array_max(F.transform(earlier, lambda t, j: F.when(t == tool, j)))


def _slot_ids(selected: Column, slot: str) -> Column:
    """Ids in a selection slot; null when nothing is selected."""
    return F.when(selected[slot].isNotNull(), F.transform(selected[slot].ents, lambda e: e.id))


def _slot_of(selected: Column, name: Column) -> Column:
    return F.coalesce(*[F.when(name == s, _slot_ids(selected, s)) for s in SLOTS])


def with_steps(traces: DataFrame, rules: Rules = RULES) -> DataFrame:
    """Add `steps`: position, tool, arguments as a map, and where references point.

    `traces` has gold_trace; a step without arguments counts as one with none. `own` is the argument
    that names what the step works on, as text.
    """
    own_param = _by_tool({**rules.id_param, "resolve_entity": "reference"}, "string")
    no_args = F.create_map().cast("map<string,variant>")
    tools = F.transform("gold_trace", lambda s: F.coalesce(s.tool, F.lit("")))
    based = traces.withColumn("_tools", tools)

    def read(s: Column, i: Column) -> Column:
        args = F.coalesce(F.try_variant_get(s.args, "$", "map<string,variant>"), no_args)
        return F.struct(i.alias("pos"), F.coalesce(s.tool, F.lit("")).alias("tool"), args.alias("args"))

    based = based.withColumn("_read", F.transform("gold_trace", read))

    def refs_of(s: Column) -> Column:
        texts = F.filter(
            F.transform(F.map_values(s.args), lambda v: string_value(v)), lambda t: t.rlike(REFERENCE)
        )
        return F.transform(
            texts,
            lambda t: F.struct(
                _reference(t, 1).alias("tool"),
                _reference(t, 2).alias("field"),
                latest_before(F.col("_tools"), _reference(t, 1), s.pos).alias("at"),
            ),
        )

    def own(s: Column) -> Column:
        return s.args[own_param[s.tool]]

    def refined(s: Column) -> Column:
        raw = string_value(own(s))
        return F.struct(
            s.pos.alias("pos"),
            s.tool.alias("tool"),
            s.args.alias("args"),
            raw.alias("own"),
            latest_before(F.col("_tools"), _reference(raw, 1), s.pos).alias("own_at"),
            refs_of(s).alias("refs"),
        )

    return based.withColumn("steps", F.transform("_read", refined)).drop("_read", "_tools")


def _echoed(step_ids: Column, at: Column, ref: Column, selected: Column, rules: Rules) -> Column:
    """Id a reference stands for: the object an earlier step worked on, or the one selected."""
    tool, field = _reference(ref, 1), _reference(ref, 2)
    slot = _slot_of(selected, field)
    return F.when(field == _by_tool(rules.echo, "string")[tool], F.get(step_ids, at)).when(
        (tool == "get_selected_entity") & (F.size(slot) == 1), F.get(slot, F.lit(0))
    )


def _ids_of_steps(strict_refs: bool, rules: Rules) -> Column:
    """Per step the object id it works on or finds, given `known`; with `strict_refs` an entity does not stand for its id."""
    selected = F.col("initial_state.selected")

    def one(acc: Column, s: Column) -> Column:
        chosen = _slot_of(selected, string_value(s.args["entity_type"]))
        entity = (
            F.when(s.tool == "get_selected_entity", F.when(F.size(chosen) == 1, F.get(chosen, F.lit(0))))
            .when(s.tool == "resolve_entity", F.col("known")[s.pos].id)
            .otherwise(
                F.when(_reference(s.own, 1).isNull(), s.own).otherwise(_echoed(acc, s.own_at, s.own, selected, rules))
            )
        )
        if strict_refs:
            entity = F.when(~s.tool.isin("get_selected_entity", "resolve_entity"), entity)
        return F.concat(acc, F.array(entity))

    return F.aggregate("steps", F.array().cast("array<string>"), one)


def with_step_ids(
    stepped: DataFrame, known: DataFrame | None = None, strict_refs: bool = False, rules: Rules = RULES
) -> DataFrame:
    """Add `step_ids`, the object id each step works on, references followed, and `known`.

    `known(id, known)` says what lookups within a trace have found (see known_entities).
    """
    if known is None:
        stepped = stepped.withColumn("known", F.create_map().cast(KNOWN))
    else:
        stepped = stepped.join(known, "id", "left")
    return stepped.withColumn("step_ids", _ids_of_steps(strict_refs, rules))


def _made(pos: Column, prefix: str) -> Column:
    """Id of what a step puts on the map."""
    digest = F.sha2(F.concat_ws("|", F.col("id"), pos.cast("string")), 256)
    return F.concat(F.lit(prefix), F.substring(digest, 1, 16))


def _asks_fields(tool: Column, field: Column) -> Column:
    """Whether a reference is to a field that only the object table has."""
    return (tool == "get_object_info") & field.isin("name", "type")


def _levels() -> Column:
    """Per step the number of lookups that must be done before it is known what it works on."""

    def one(acc: Column, s: Column) -> Column:
        tool, field = _reference(s.own, 1), _reference(s.own, 2)
        looked_up = (tool == "resolve_entity") | _asks_fields(tool, field)
        below = F.get(acc, s.own_at) + F.coalesce(looked_up, F.lit(False)).cast("int")
        return F.concat(acc, F.array(F.coalesce(below, F.lit(0))))

    return F.aggregate("steps", F.array().cast("array<int>"), one)


def _text_of(s: Column, strict_refs: bool, rules: Rules) -> Column:
    """Text that a resolve_entity step goes by, its reference followed; null where that is not known or no text."""
    tool, field = _reference(s.own, 1), _reference(s.own, 2)
    source, found = F.get(F.col("steps"), s.own_at), F.col("known")[s.own_at]
    echoed = _echoed(F.col("step_ids"), s.own_at, s.own, F.col("initial_state.selected"), rules)
    if strict_refs:
        echoed = F.when(~tool.isin("get_selected_entity", "resolve_entity"), echoed)
    return F.when(tool.isNull(), s.own).otherwise(
        F.coalesce(
            echoed,
            F.when(_asks_fields(tool, field), F.when(field == "name", found["name"]).otherwise(found["type"])),
            F.when(field == "time_range", string_value(source.args["time_range"])),
            F.when(field == "cleared", string_value(source.args["scope"])),
            F.when(field == "artifact_id", _made(s.own_at, "artifact_")),
            F.when(field == "popup_id", _made(s.own_at, "popup_")),
            F.when(field == "time", F.col("initial_state.time").cast("string")),
        )
    )


def known_entities(stepped: DataFrame, objects: DataFrame, strict_refs: bool = False, rules: Rules = RULES) -> DataFrame:
    """(id, known): what each resolve_entity step finds, and the objects by whose name or type one is asked.

    A reference can come from an earlier result, that one from another, and so on. Lookups are done level by
    level for all traces together, as many levels as the deepest chain has; only traces that
    resolve something take part, with their steps and state alone.
    """
    resolves = lambda s: s.tool == "resolve_entity"
    asks_name = lambda s: F.exists(
        "steps", lambda r: resolves(r) & (r.own_at == s.pos) & _asks_fields(_reference(r.own, 1), _reference(r.own, 2))
    )
    chains = materialize(
        stepped.filter(F.exists("steps", resolves))
        .select("id", "scenario_id", "steps", "initial_state", _levels().alias("levels"))
        .withColumn("known", F.create_map().cast(KNOWN))
    )
    level_of = lambda s: F.get("levels", s.pos)
    deepest, named_at = chains.agg(
        *[F.max(F.array_max(F.transform(F.filter("steps", f), level_of))) for f in (resolves, asks_name)]
    ).first()
    for level in range(-1 if deepest is None else deepest + 1):
        due = F.filter("steps", lambda s: (level_of(s) == level) & (resolves(s) | asks_name(s)))
        asked = chains.withColumn("step_ids", _ids_of_steps(strict_refs, rules)).select(
            "id",
            "scenario_id",
            F.explode(
                F.transform(
                    due,
                    lambda s: F.struct(
                        s.pos.alias("pos"),
                        resolves(s).alias("by_text"),
                        F.when(resolves(s), _text_of(s, strict_refs, rules)).otherwise(F.get("step_ids", s.pos)).alias("ask"),
                        string_value(s.args["expected_type"]).alias("expected_type"),
                    ),
                )
            ).alias("s"),
        ).filter(F.col("s.ask").isNotNull())
        # Written: read for the texts that are looked for and for the answers.
        texts = materialize(
            asked.filter("s.by_text").select(
                F.struct("id", "s.pos").alias("query_id"), "scenario_id", F.col("s.ask").alias("reference"), "s.expected_type"
            )
        )
        entity = F.struct(F.col("entity_id").alias("id"), F.col("entity_name").alias("name"), F.col("entity_type").alias("type"))
        by_text = resolve_reference(texts, objects).filter(F.col("entity_id").isNotNull()).select("query_id.*", entity.alias("found"))
        found = by_text
        if named_at is not None and level <= named_at:
            ids = asked.filter("not s.by_text").select("id", "s.pos", "scenario_id", F.col("s.ask").alias("object_id"))
            wanted = objects.withColumnRenamed("id", "object_id").join(
                ids.select("scenario_id", "object_id").distinct(), ["scenario_id", "object_id"], "left_semi"
            )
            named = by_id(wanted.withColumnRenamed("object_id", "id").select(*objects.columns))
            named = named.select("scenario_id", F.col("id").alias("object_id"), F.struct("id", "name", "type").alias("found"))
            found = found.unionByName(ids.join(named, ["scenario_id", "object_id"]).select("id", "pos", "found"))
        found = found.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("pos", "found"))).cast(KNOWN).alias("_new"))
        more = F.coalesce("_new", F.create_map().cast(KNOWN))
        chains = chains.join(found, "id", "left").withColumn("known", F.map_concat("known", more)).drop("_new")
        if level < deepest:
            chains = materialize(chains)
    return chains.select("id", "known")


def _literal_ids(value: Column, strict_refs: bool) -> Column:
    """Ids in a literal list; an element that is no id becomes null."""
    items = F.try_variant_get(value, "$", "array<variant>")
    coerced = lambda v: F.coalesce(string_value(v), F.try_variant_get(v, "$.id", "string"))
    return F.transform(items, string_value if strict_refs else coerced)


def with_highlights(stepped: DataFrame, strict_refs: bool = False, rules: Rules = RULES) -> DataFrame:
    """Add `shown`: per highlight step its ids, or the search step whose results it takes.

    `bad` marks a highlight whose argument can never be a list of ids.
    """
    selected = F.col("initial_state.selected")

    def one(s: Column) -> Column:
        value = s.args["object_ids"]
        text = string_value(value)
        tool, field = _reference(text, 1), _reference(text, 2)
        at = F.get(F.filter(s.refs, lambda r: (r.tool == tool) & (r.field == field)), F.lit(0)).at
        source = F.get(F.col("steps"), at)
        search = F.when(tool.isin(rules.searches) & (field == "results"), at)
        ids = _literal_ids(value, strict_refs)
        if not strict_refs:
            slot = F.when(
                tool == "get_selected_entity",
                F.coalesce(
                    F.when(field == "entity", _slot_of(selected, string_value(source.args["entity_type"]))),
                    _slot_of(selected, field),
                ),
            )
            found = F.when((tool == "resolve_entity") & (field == "entity"), F.get(F.col("step_ids"), at))
            ids = F.coalesce(ids, slot, F.when(found.isNotNull(), F.array(found)))
        # Everything highlighted so far may be highlighted again.
        again = (tool == "highlight_objects") & (field == "highlighted")
        nothing = (text == "") | F.coalesce(again, F.lit(False))
        ids = F.when(nothing, F.array().cast("array<string>")).otherwise(ids)
        return F.struct(s.pos.alias("pos"), ids.alias("ids"), search.alias("search"), (ids.isNull() & search.isNull()).alias("bad"))

    calls = F.filter("steps", lambda s: s.tool == "highlight_objects")
    return stepped.withColumn("shown", F.transform(calls, one))


def wanted_ids(stepped: DataFrame) -> Column:
    """Distinct ids a sample refers to: selected, in id arguments, worked on, highlighted."""
    selected = F.col("initial_state.selected")
    picks = [F.coalesce(_slot_ids(selected, s), F.array().cast("array<string>")) for s in SLOTS]
    arguments = F.flatten(
        F.transform("steps", lambda s: F.transform(_strings(ID_ARGUMENTS), lambda k: string_value(s.args[k])))
    )
    shown = F.flatten(F.transform("shown", lambda h: F.coalesce(h.ids, F.array().cast("array<string>"))))
    everything = F.concat(*picks, arguments, F.col("step_ids"), shown)
    return F.array_distinct(
        F.filter(everything, lambda x: x.isNotNull() & (x != "") & ~x.startswith(F.lit("$")))
    )


def types_of(stepped: DataFrame, objects: DataFrame) -> DataFrame:
    """(id, object_id, type) of the objects that each sample refers to; unknown ids are absent."""
    asked = stepped.select("id", "scenario_id", F.explode(wanted_ids(stepped)).alias("object_id"))
    table = types_by_id(objects).withColumnRenamed("id", "object_id")
    return asked.join(table, ["scenario_id", "object_id"]).select("id", "object_id", "type")


def with_types(stepped: DataFrame, objects: DataFrame) -> DataFrame:
    """Add `types`, a map from each id the sample refers to to its type; unknown ids are absent."""
    found = types_of(stepped, objects).groupBy("id").agg(
        F.map_from_entries(F.collect_list(F.struct("object_id", "type"))).alias("types")
    )
    known = stepped.join(found, "id", "left")
    return known.withColumn("types", F.coalesce("types", F.create_map().cast("map<string,string>")))


def prepare(samples: DataFrame, objects: DataFrame, strict_refs: bool = False, rules: Rules = RULES) -> DataFrame:
    """Samples with `steps`, `step_ids`, `shown` and `types`, which everything below works on."""
    return with_types(followed(samples, objects, strict_refs, rules), objects)


def followed(samples: DataFrame, objects: DataFrame, strict_refs: bool = False, rules: Rules = RULES) -> DataFrame:
    """Samples with `steps`, `step_ids` and `shown`."""
    stepped = with_steps(samples, rules)
    known = known_entities(stepped, objects, strict_refs, rules)
    return with_highlights(with_step_ids(stepped, known, strict_refs, rules), strict_refs, rules)


def search_key() -> Column:
    """One text for the query columns of a search."""
    return F.sha2(F.to_json(F.struct(*QUERY)), 256)


def _query_columns(step: Column, object_id: Column) -> list[Column]:
    """What a search asks for; arguments that its tool does not read are left out."""
    radius = F.when(step.tool == "get_nearby_objects", F.try_variant_get(step.args["radius_meters"], "$", "double"))
    time_range = F.when(step.tool == "get_objects_crossing_line", string_value(step.args["time_range"]))
    return [
        F.col("scenario_id"),
        step.tool.alias("tool"),
        object_id.alias("object_id"),
        string_value(step.args["object_type"]).alias("object_type"),
        radius.alias("radius_meters"),
        time_range.alias("time_range"),
    ]


def searches(prepared: DataFrame, items: str | Column = "shown", *more: Column) -> DataFrame:
    """(id, pos, query columns, key): the search behind each highlight that takes search results.

    `items` are the highlights looked at; `more` columns of the trace come along.
    """
    hits = F.filter(items, lambda h: h.search.isNotNull())
    rows = prepared.select("id", "scenario_id", "steps", "step_ids", F.explode(hits).alias("h"), *more)
    step = F.get(F.col("steps"), F.col("h.search"))
    query = _query_columns(step, F.get("step_ids", F.col("h.search")))
    along = [c for c in rows.columns if c not in ("id", "scenario_id", "steps", "step_ids", "h")]
    return rows.select("id", F.col("h.pos").alias("pos"), *query, *along).withColumn("key", search_key())


def searches_on_map(timed: DataFrame, at: Column) -> DataFrame:
    """`searches` of the highlights that are on the map before any of the steps `at`, an array of positions."""
    return searches(timed, F.filter("lit", lambda h: F.exists(at, lambda a: _there(h, a))))


def all_searches(prepared: DataFrame) -> DataFrame:
    """(id, pos, query columns): every search step."""
    calls = F.filter("steps", lambda s: s.tool.isin(SEARCH_TOOLS))
    rows = prepared.select("id", "scenario_id", "step_ids", F.explode(calls).alias("s"))
    return rows.select(
        "id", F.col("s.pos").alias("pos"), *_query_columns(F.col("s"), F.get("step_ids", F.col("s.pos")))
    )


def search_results(
    queries: DataFrame, scenarios: DataFrame, objects: DataFrame, traj: DataFrame, keep: Sequence[str] = ()
) -> DataFrame:
    """Result ids of every distinct search, (query columns, result_id); with `keep`, of every one that differs in these columns."""
    asked = queries.select(*QUERY, *keep).distinct()
    kept = [f"_of_{k}" for k in keep]  # an `id` is the object's in what the spatial joins return
    own = [F.col(f"_of_{k}").alias(k) for k in keep]

    def results(tool: str, found: DataFrame, id_column: str, **extra: str) -> DataFrame:
        columns = {
            "scenario_id": F.col("scenario_id"),
            "tool": F.lit(tool),
            "object_id": F.col(id_column),
            "object_type": F.col("object_type"),
            "radius_meters": F.lit(None).cast("double"),
            "time_range": F.lit(None).cast("string"),
        }
        columns.update({k: F.col(v) for k, v in extra.items()})
        return found.select(*[v.alias(k) for k, v in columns.items()], F.col("id").alias("result_id"), *own)

    def asking(tool: str, id_column: str) -> DataFrame:
        return asked.filter(F.col("tool") == tool).select(
            *[F.col(c).alias(id_column if c == "object_id" else c) for c in QUERY], *[F.col(k).alias(f"_of_{k}") for k in keep]
        )

    found = {
        "get_objects_inside_polygon": lambda tool: results(
            tool, spatial.objects_inside_polygon(asking(tool, "polygon_id"), objects, kept), "polygon_id"
        ),
        "get_nearby_objects": lambda tool: results(
            tool,
            spatial.nearby_objects(asking(tool, "object_id"), objects, kept),
            "object_id",
            radius_meters="radius_meters",
        ),
        "get_objects_crossing_line": lambda tool: results(
            tool,
            spatial.objects_crossing_line(asking(tool, "line_id"), scenarios, objects, traj, kept),
            "line_id",
            time_range="time_range",
        ),
    }
    in_use = [r[0] for r in asked.select("tool").distinct().collect()]  # three names at most
    tables = [found[tool](tool) for tool in SEARCH_TOOLS if tool in in_use]
    nothing = asked.select(*QUERY, F.lit(None).cast("string").alias("result_id"), *keep).filter(F.lit(False))
    return reduce(DataFrame.unionByName, tables, nothing)


def keyed_results(queries: DataFrame, scenarios: DataFrame, objects: DataFrame, traj: DataFrame) -> DataFrame:
    """(key, result_id): every distinct search once, whoever asks for it. Traces hold the key of a search only."""
    return search_results(queries, scenarios, objects, traj).select(search_key().alias("key"), "result_id").distinct()


def shown_results(queries: DataFrame, scenarios: DataFrame, objects: DataFrame, traj: DataFrame) -> DataFrame:
    """(id, pos, result_id): what the search behind each highlight of `searches` finds; objects that share an id come as often.

    Whoever asks goes through the spatial joins, so pairs come out where they are formed and none is shuffled for its asker.
    """
    return search_results(queries, scenarios, objects, traj, ["id", "pos"]).select("id", "pos", "result_id")


def ids_are_shared(objects: DataFrame) -> bool:
    """Whether any objects of a scenario have the same id."""
    return bool(objects.groupBy("scenario_id", "id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).count())


def result_sizes(queries: DataFrame, scenarios: DataFrame, objects: DataFrame, traj: DataFrame) -> DataFrame:
    """(query columns, n): how many ids every distinct search finds; those that find nothing are absent.

    Results are counted where the pairs are formed, so what is shuffled grows with searches and not with what they
    find. Only where objects share an id are the ids told apart first.
    """
    n = F.countDistinct("result_id") if ids_are_shared(objects) else F.count(F.lit(1))
    return search_results(queries, scenarios, objects, traj).groupBy(*QUERY).agg(n.alias("n"))


def keyed_sizes(queries: DataFrame, scenarios: DataFrame, objects: DataFrame, traj: DataFrame) -> DataFrame:
    """(key, n) of `result_sizes`."""
    return result_sizes(queries, scenarios, objects, traj).select(search_key().alias("key"), "n")


def keyed_hits(
    probes: DataFrame, scenarios: DataFrame, objects: DataFrame, traj: DataFrame
) -> DataFrame:
    """probes(query columns, key, result_id) -> the (key, result_id) among them that the searches find.

    The searches run over the objects asked about and those they start from, not over all.
    """
    ends = probes.select("scenario_id", F.explode(F.array("object_id", "result_id")).alias("id")).distinct()
    some = materialize(objects.join(ends, ["scenario_id", "id"], "left_semi"))
    moved = traj.join(ends.withColumnRenamed("id", "object_id"), ["scenario_id", "object_id"], "left_semi")
    found = keyed_results(probes, scenarios, some, moved)
    return found.join(probes.select("key", "result_id").distinct(), ["key", "result_id"])


def search_sizes(queries: DataFrame, sizes: DataFrame) -> DataFrame:
    """(id, pos, n): how many objects the search behind a highlight found; `sizes` comes from keyed_sizes."""
    return queries.join(sizes, "key").select("id", "pos", "n")


def with_search_sizes(prepared: DataFrame, queries: DataFrame, sizes: DataFrame) -> DataFrame:
    """Add `found`, a map from the position of a highlight to the size of its search result; empty ones are absent."""
    counted = search_sizes(queries, sizes).groupBy("id").agg(
        F.map_from_entries(F.collect_list(F.struct("pos", "n"))).alias("found")
    )
    joined = prepared.join(counted, "id", "left")
    return joined.withColumn("found", F.coalesce("found", F.create_map().cast("map<int,bigint>")))


def step_errors(strict_refs: bool = False, rules: Rules = RULES) -> Column:
    """First error of each invalid step, ARRAY<STRUCT<pos, tool, error>>, on a row of `prepare`.

    With `strict_refs`, `found` must be there (see with_search_sizes): a search result can then
    be highlighted only when it is empty.
    """
    required, returns, texts = _lists(rules.required), _lists(rules.returns), _lists(rules.texts)
    steps, types = F.col("steps"), F.col("types")

    def bad_ref(r: Column) -> Column:
        field_known = F.array_contains(returns[r.tool], r.field)
        # What a selection query returns depends on whether it names a slot.
        named = _given(F.get(steps, r.at).args["entity_type"])
        slot_query = r.tool == "get_selected_entity"
        field_there = F.when(slot_query, named == (r.field == "entity")).otherwise(True)
        return r.at.isNull() | ~F.coalesce(field_known & field_there, F.lit(False))

    def no_text(s: Column) -> Column:
        """Whether the reference of a resolve_entity step is no text: not even one that is not found."""
        tool, field = _reference(s.own, 1), _reference(s.own, 2)
        entity = F.lit(False) if strict_refs else tool.isin("resolve_entity", "get_selected_entity")
        return s.own.isNull() | (tool.isNotNull() & ~entity & ~F.coalesce(F.array_contains(texts[tool], field), F.lit(False)))

    def error_of(s: Column) -> Column:
        missing = F.array_except(required[s.tool], F.map_keys(s.args))
        own_id = F.get(F.col("step_ids"), s.pos)
        works_on = _by_tool(rules.id_param, "string")[s.tool].isNotNull()
        needed = _by_tool(rules.required_type, "string")[s.tool]
        slot = string_value(s.args["entity_type"])
        slot_given = _given(s.args["entity_type"])
        scope = string_value(s.args["scope"])
        radius = F.try_variant_get(s.args["radius_meters"], "$", "double")
        call = F.get(F.filter("shown", lambda h: h.pos == s.pos), F.lit(0))
        ids_missing = F.exists(call.ids, lambda x: x.isNull() | types[x].isNull())
        highlight_bad = call.bad | F.coalesce(ids_missing, F.lit(False))
        if strict_refs:
            highlight_bad = highlight_bad | (F.coalesce(F.col("found")[s.pos], F.lit(0)) > 0)
        return (
            F.when(~s.tool.isin(list(rules.tools)), "unknown_tool")
            .when(F.exists(s.refs, bad_ref), "unresolved_reference")
            .when(F.size(missing) > 0, "missing_argument")
            .when(works_on & types[own_id].isNull(), "object_not_found")
            .when(types[own_id] != needed, "type_mismatch")
            .when((s.tool == "get_selected_entity") & slot_given & ~F.coalesce(slot.isin(SLOTS), F.lit(False)), "invalid_slot")
            .when((s.tool == "resolve_entity") & no_text(s), "bad_argument")
            .when((s.tool == "get_nearby_objects") & radius.isNull(), "bad_argument")
            .when(
                (s.tool == "get_nearby_objects")
                & (types[own_id].isin("polygon", "line") | string_value(s.args["object_type"]).isin("polygon", "line")),
                "not_a_point",
            )
            .when((s.tool == "clear_artifacts") & ~F.coalesce(scope.isin(CLEAR_SCOPES), F.lit(False)), "invalid_scope")
            .when((s.tool == "highlight_objects") & highlight_bad, "bad_highlight")
        )

    marked = F.transform(steps, lambda s: F.struct(s.pos.alias("pos"), s.tool.alias("tool"), error_of(s).alias("error")))
    return F.filter(marked, lambda e: e.error.isNotNull())


def _lists(values: dict[str, list[str]]) -> Column:
    return F.create_map(*chain.from_iterable((F.lit(k), _strings(v)) for k, v in values.items()))


def with_timeline(prepared: DataFrame, rules: Rules = RULES) -> DataFrame:
    """Add what steps put on the map: `drawn`, `popped` and `lit`, each item from `pos` to `until`.

    `until` is the first later step that clears items of the kind; null where none does. The state at any
    step is a selection of these items (see `alive`).
    """
    clears = F.transform(
        F.filter("steps", lambda s: s.tool == "clear_artifacts"),
        lambda s: F.struct(s.pos.alias("pos"), string_value(s.args["scope"]).alias("scope")),
    )
    cleared = prepared.withColumn("_clears", clears)

    def until(pos: Column, scope: Column) -> Column:
        later = F.filter("_clears", lambda c: (c.pos > pos) & ((c.scope == "all") | (c.scope == scope)))
        return F.array_min(F.transform(later, lambda c: c.pos)).alias("until")

    def text(s: Column, name: str) -> Column:
        return F.try_variant_get(s.args[name], "$", "string")

    selected = F.col("initial_state.selected")

    def source_of(s: Column) -> Column:
        raw = string_value(s.args["source_object_id"])
        at = F.get(F.filter(s.refs, lambda r: r.tool == _reference(raw, 1)), F.lit(0)).at
        echoed = _echoed(F.col("step_ids"), at, raw, selected, rules)
        return F.when(s.tool == "draw_polyline", F.when(_reference(raw, 1).isNull(), raw).otherwise(echoed))

    kind = lambda s: F.substring_index(s.tool, "_", -1)
    drawn = F.transform(
        F.filter("steps", lambda s: s.tool.isin("draw_polyline", "draw_polygon", "draw_marker")),
        lambda s: F.struct(
            s.pos.alias("pos"),
            until(s.pos, F.concat(kind(s), F.lit("s"))),
            _made(s.pos, "artifact_").alias("artifact_id"),
            kind(s).alias("artifact_type"),
            text(s, "label").alias("label"),
            source_of(s).alias("source_object_id"),
        ),
    )
    popped = F.transform(
        F.filter("steps", lambda s: s.tool == "show_popup"),
        lambda s: F.struct(
            s.pos.alias("pos"),
            until(s.pos, F.lit("popups")),
            _made(s.pos, "popup_").alias("popup_id"),
            F.get("step_ids", s.pos).alias("target_id"),
            text(s, "content").alias("content"),
        ),
    )
    lit = F.transform("shown", lambda h: F.struct(h.pos.alias("pos"), until(h.pos, F.lit("highlights")), h.ids.alias("ids"), h.search.alias("search")))
    return cleared.withColumns({"drawn": drawn, "popped": popped, "lit": lit}).drop("_clears")


def _there(x: Column, at: Column | None) -> Column:
    return x.until.isNull() if at is None else (x.pos < at) & F.coalesce(x.until >= at, F.lit(True))


def alive(items: str, at: Column | None = None) -> Column:
    """The items of a timeline that are on the map before step `at`, or at the end."""
    return F.transform(F.filter(items, lambda x: _there(x, at)), lambda x: x.dropFields("until"))


def with_final_state(prepared: DataFrame) -> DataFrame:
    """Add what is left at the end: `artifacts`, `popups`, `highlights` (pos, ids, search)."""
    return with_timeline(prepared).withColumns(
        {"artifacts": alive("drawn"), "popups": alive("popped"), "highlights": alive("lit")}
    ).drop("drawn", "popped", "lit")


def states(timed: DataFrame, at: Column, queries: DataFrame, results: DataFrame) -> DataFrame:
    """(id, at, time, selected, active_layers, drawn_artifacts, highlighted_objects, popups): the whole state before steps.

    `timed` comes from with_timeline; `at` is the array of positions asked for, the number of steps being the end.
    Highlights of searches are expanded here only, from `keyed_results`.
    """
    return states_with(timed, at, queries.select("id", "pos", "key").join(results, "key").select("id", "pos", "result_id"))


def states_with(timed: DataFrame, at: Column, found: DataFrame) -> DataFrame:
    """`states` with the results of searches from `shown_results`, which need be those on the map at these steps only.

    Results are gathered per trace in one shuffle, and picked for each state on the trace's row.
    """
    strings = F.array().cast("array<string>")
    state = F.col("initial_state")
    by_trace = found.groupBy("id").agg(F.collect_set(F.struct("pos", "result_id")).alias("_found"))
    rows = timed.withColumn("at", F.explode(at)).select(
        "id",
        "at",
        state.time.alias("time"),
        state.selected.alias("selected"),
        state.active_layers.alias("active_layers"),
        F.transform(alive("drawn", F.col("at")), lambda a: a.dropFields("pos")).alias("drawn_artifacts"),
        alive("lit", F.col("at")).alias("_lit"),
        F.transform(alive("popped", F.col("at")), lambda p: p.dropFields("pos")).alias("popups"),
    )
    named = F.flatten(F.transform("_lit", lambda h: F.coalesce(h.ids, strings)))
    searched = F.transform(F.filter("_lit", lambda h: h.search.isNotNull()), lambda h: h.pos)
    shown = F.transform(F.filter("_found", lambda f: F.array_contains(searched, f.pos)), lambda f: f.result_id)
    ids = F.array_sort(F.array_distinct(F.concat(named, F.coalesce(shown, strings))))
    joined = rows.join(by_trace, "id", "left").withColumn("highlighted_objects", ids)
    return joined.select(
        "id", "at", "time", "selected", "active_layers", "drawn_artifacts", "highlighted_objects", "popups"
    )


def highlighted_objects(stated: DataFrame, scenarios: DataFrame, objects: DataFrame, traj: DataFrame) -> DataFrame:
    """(id, object_id): highlighted objects at the end of each trace, in long form; `stated` is read more than once.

    Only traces whose highlights come from more than one call can name an object twice, and searches only where objects
    share ids; no other rows are shuffled for it.
    """
    size = F.size("highlights").alias("_calls")
    literal = stated.select("id", size, F.explode("highlights").alias("h")).select(
        "id", "_calls", F.explode(F.array_distinct("h.ids")).alias("object_id")
    )
    queries = materialize(searches(stated, "highlights", size))
    found = search_results(queries, scenarios, objects, traj, ["id", "_calls"])
    every = literal.unionByName(found.select("id", "_calls", F.col("result_id").alias("object_id")))
    if ids_are_shared(objects):
        return every.select("id", "object_id").distinct()
    once = every.filter("_calls = 1").select("id", "object_id")
    return once.unionByName(every.filter("_calls > 1").select("id", "object_id").distinct())
