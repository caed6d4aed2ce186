"""Validity gates: schema, static consistency, trace audit, final-state assertions, verdict.

Every gate is a list of errors or a boolean on the sample's row; `verify` puts them together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.variants import string_value
from ..plans.catalog import ID_ARGUMENTS, RULES, Rules
from ..plans.vocabulary import ASSERTION_TYPES, DIFFICULTIES, SLOTS
from ..session import materialize
from . import trace_audit as audit

GATES = ["schema_pass", "static_pass", "exec_pass", "assert_pass", "semantic_pass"]


def _failed(checks: dict[str, Column]) -> Column:
    """Names of the checks that do not hold."""
    return F.array_compact(
        F.array(*[F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in checks.items()])
    )


def schema_errors() -> Column:
    """Gate 1: what a sample must have, as predicates over the sample's columns."""
    state, expected = F.col("initial_state"), F.col("expected")

    def entity_ok(slot: str) -> Column:
        ents = F.coalesce(state["selected"][slot].ents, F.array())
        return F.forall(ents, lambda e: e.id.isNotNull() & e.type.isNotNull())

    required = ["id", "scenario_id", "task_type", "user_request", "initial_state", "expected"]
    checks = {name: F.col(name).isNotNull() for name in required}
    checks["initial_state.selected"] = state["selected"].isNotNull()
    checks["initial_state.time"] = state["time"].isNotNull()
    checks["gold_trace.tool"] = F.forall(F.coalesce("gold_trace", F.array()), lambda s: s.tool.isNotNull())
    checks["difficulty"] = F.col("difficulty").isin(DIFFICULTIES)
    checks["assertion.type"] = F.forall(
        F.coalesce(expected["final_state_assertions"], F.array()), lambda a: F.coalesce(a.type.isin(ASSERTION_TYPES), F.lit(False))
    )
    for slot in SLOTS:
        checks[f"selected.{slot}"] = entity_ok(slot)
    checks["artifact"] = F.forall(
        F.coalesce(state["drawn_artifacts"], F.array()), lambda a: a.artifact_id.isNotNull() & a.artifact_type.isNotNull()
    )
    return _failed(checks)


def _asks_back() -> Column:
    return F.coalesce("expected.should_ask_clarification", F.lit(False))


def static_errors(rules: Rules = RULES) -> Column:
    """Gate 2, ARRAY<STRUCT<pos, error>> on a row of `trace_audit.prepare`; pos -1 is the selection.

    Names and ids only: nothing is looked up but whether an id exists and what type it has.
    """
    types, steps = F.col("types"), F.col("steps")
    selected = F.col("initial_state.selected")
    picked = F.concat(
        *[F.coalesce(F.transform(selected[s].ents, lambda e: e.id), F.array().cast("array<string>")) for s in SLOTS]
    )
    strangers = F.transform(
        F.filter(picked, lambda x: (x != "") & types[x].isNull()),
        lambda x: F.struct(F.lit(-1).alias("pos"), F.lit("selected_not_found").alias("error")),
    )

    def at(s: Column, error: str, failed: Column) -> Column:
        return F.when(
            F.coalesce(failed, F.lit(False)), F.struct(s.pos.alias("pos"), F.lit(error).alias("error"))
        )

    def unknown_argument(s: Column, name: str) -> Column:
        value = string_value(s.args[name])
        literal = (value != "") & ~value.startswith(F.lit("$"))
        return at(s, f"{name}_not_found", literal & types[value].isNull() & ~_asks_back())

    def wrong_type(s: Column) -> Column:
        failed = F.lit(False)
        for name, tool in rules.tools.items():
            if tool.required_type:
                kind = types[string_value(s.args[tool.id_param])]
                failed = failed | ((s.tool == name) & F.coalesce(kind != tool.required_type, F.lit(False)))
        return at(s, "type_mismatch", failed)

    def bad_range(s: Column) -> Column:
        value = F.try_variant_get(s.args["time_range"], "$", "string")
        return at(s, "invalid_time_range", (value != "") & ~value.isin(rules.time_ranges))

    def of_step(s: Column) -> Column:
        return F.array_compact(
            F.array(
                at(s, "unknown_tool", ~s.tool.isin(list(rules.tools))),
                *[unknown_argument(s, name) for name in ID_ARGUMENTS],
                wrong_type(s),
                bad_range(s),
            )
        )

    return F.concat(strangers, F.flatten(F.transform(steps, of_step)))


def asserted_probes(timed: DataFrame, queries: DataFrame) -> DataFrame:
    """(id, query columns, key, result_id): asserted ids, with each search that is highlighted at the end."""
    asserted = F.flatten(
        F.transform(
            "expected.final_state_assertions",
            lambda a: F.concat(F.array(a.object_id), F.coalesce(a.object_ids, F.array().cast("array<string>"))),
        )
    )
    probes = (
        timed.select("id", F.explode(audit.alive("lit")).alias("h"), asserted.alias("_ids"))
        .filter(F.col("h.search").isNotNull())
        .select("id", F.col("h.pos").alias("pos"), F.explode(F.array_distinct("_ids")).alias("result_id"))
        .filter(F.col("result_id").isNotNull())
    )
    return probes.join(queries, ["id", "pos"]).drop("pos")


def with_facts(timed: DataFrame, objects: DataFrame, queries: DataFrame, sizes: DataFrame, hits: DataFrame) -> DataFrame:
    """Add `types`, `found` and `hits`: all that the gates know from other tables, grouped by sample once.

    `sizes(key, n)` and `hits(id, result_id)` say how much the searches find, and which of the asserted ids.
    """
    types = audit.types_of(timed, objects)
    sizes = audit.search_sizes(queries, sizes)
    shape = {"object_id": "string", "type": "string", "pos": "int", "n": "bigint", "hit": "string"}

    def facts(df: DataFrame, **columns: str) -> DataFrame:
        return df.select("id", *[(F.col(columns[c]) if c in columns else F.lit(None)).cast(t).alias(c) for c, t in shape.items()])

    every = (
        facts(types, object_id="object_id", type="type")
        .unionByName(facts(sizes, pos="pos", n="n"))
        .unionByName(facts(hits, hit="result_id"))
    )
    by_sample = every.groupBy("id").agg(
        F.map_from_entries(F.collect_list(F.when(F.col("object_id").isNotNull(), F.struct("object_id", "type")))).alias("types"),
        F.map_from_entries(F.collect_list(F.when(F.col("n").isNotNull(), F.struct("pos", "n")))).alias("found"),
        F.collect_set("hit").alias("hits"),
    )
    joined = timed.join(by_sample, "id", "left")
    none = {"types": F.create_map().cast("map<string,string>"), "found": F.create_map().cast("map<int,bigint>")}
    none["hits"] = F.array().cast("array<string>")
    return joined.withColumns({c: F.coalesce(c, empty) for c, empty in none.items()})


def failed_assertions() -> Column:
    """Gate 4: indexes of the assertions that do not hold in the final state."""
    artifacts, popups, found = F.col("artifacts"), F.col("popups"), F.col("found")
    ids = F.concat(F.flatten(F.transform("highlights", lambda h: F.coalesce(h.ids, F.array().cast("array<string>")))), F.col("hits"))
    any_shown = F.exists(
        "highlights", lambda h: (F.size(F.coalesce(h.ids, F.array())) > 0) | (F.coalesce(found[h.pos], F.lit(0)) > 0)
    )

    def has_artifact(kind: Column, source: Column) -> Column:
        return F.exists(
            artifacts,
            lambda a: (kind.isNull() | (a.artifact_type == kind))
            & (source.isNull() | a.source_object_id.eqNullSafe(source)),
        )

    def holds(a: Column) -> Column:
        wanted = F.coalesce(a.object_ids, F.array().cast("array<string>"))
        return (
            F.when(a.type == "artifact_exists", has_artifact(a.artifact_type, a.source_object_id))
            .when(a.type == "artifact_removed", ~has_artifact(a.artifact_type, a.source_object_id))
            .when(
                a.type == "polyline_source_matches_vehicle",
                has_artifact(F.lit("polyline"), F.coalesce(a.source_object_id, F.lit(""))),
            )
            .when(a.type == "object_highlighted", F.array_contains(ids, F.coalesce(a.object_id, F.lit(""))))
            .when(
                a.type == "objects_highlighted",
                F.when(F.coalesce(a.object_type, F.lit("")) != "", any_shown).otherwise(
                    F.size(F.array_except(wanted, ids)) == 0
                ),
            )
            .when(a.type == "popup_shown", F.exists(popups, lambda p: p.target_id.eqNullSafe(a.target_id)))
            .when(a.type == "objects_inside_polygon_highlighted", any_shown)
            .otherwise(True)
        )

    numbered = F.transform(
        "expected.final_state_assertions", lambda a, i: F.when(~F.coalesce(holds(a), F.lit(False)), i)
    )
    return F.array_compact(numbered)


def verify(
    samples: DataFrame,
    scenarios: DataFrame,
    objects: DataFrame,
    traj: DataFrame,
    verdicts: DataFrame | None = None,
    strict_refs: bool = False,
    rules: Rules = RULES,
) -> DataFrame:
    """All samples with `*_errors` per gate and cumulative `*_pass` flags.

    A sample without its scenario passes nothing. `verdicts(id, valid)` are a model's answers
    (ingest.verdicts); without them the last gate is skipped. Searches are run for samples that
    passed the schema gate, each distinct one once; their results are counted, and asserted ids looked for, not listed.

    The gates work on a narrow table, written once: steps, references followed, and what is on the map when. Types,
    search sizes and hits join it after one grouping by sample; the samples themselves, which have unique ids,
    are joined with the flags at the end. Samples are read twice, so hand in a written table.
    """
    worlds = scenarios.select("scenario_id", F.lit(True).alias("_in_world"))
    narrow = samples.select("id", "scenario_id", "gold_trace", "initial_state", "expected", schema_errors().alias("schema_errors"))
    first = F.coalesce("_in_world", F.lit(False)) & (F.size("schema_errors") == 0)
    placed = narrow.join(worlds, "scenario_id", "left").withColumn("schema_pass", first).drop("_in_world")
    followed = audit.followed(placed, objects, strict_refs, rules)
    timed = materialize(audit.with_timeline(followed, rules).drop("gold_trace"))
    queries = materialize(audit.searches(timed.filter("schema_pass")))
    sizes = materialize(audit.keyed_sizes(queries, scenarios, objects, traj))
    probes = materialize(asserted_probes(timed, queries))
    found = audit.keyed_hits(probes, scenarios, objects, traj)
    hits = probes.select("id", "key", "result_id").join(found, ["key", "result_id"], "left_semi").select("id", "result_id")
    known = with_facts(timed, objects, queries, sizes, hits).withColumns(
        {"artifacts": audit.alive("drawn"), "popups": audit.alive("popped"), "highlights": audit.alive("lit")}
    )
    judged = known.select(
        "id",
        "schema_errors",
        static_errors(rules).alias("static_errors"),
        audit.step_errors(strict_refs, rules).alias("exec_errors"),
        failed_assertions().alias("assert_errors"),
        "schema_pass",
        F.when(_asks_back(), True)
        .when(F.size("steps") == 0, F.size("expected.final_state_assertions") == 0)
        .alias("_excused"),
    )
    if verdicts is None:
        judged = judged.withColumn("_valid", F.lit(True))
    else:
        judged = judged.join(verdicts.select("id", F.coalesce("valid", F.lit(False)).alias("_valid")), "id", "left")
    flags = (
        judged.withColumn("static_pass", F.col("schema_pass") & (F.size("static_errors") == 0))
        .withColumn("exec_pass", F.col("static_pass") & (F.size("exec_errors") == 0))
        .withColumn("assert_pass", F.col("exec_pass") & F.coalesce("_excused", F.size("assert_errors") == 0))
        .withColumn("semantic_pass", F.col("assert_pass") & F.coalesce("_valid", F.lit(False)))
    )
    errors = ["schema_errors", "static_errors", "exec_errors", "assert_errors"]
    marked = samples.join(flags.select("id", *errors, *GATES), "id").withColumn(
        "generation_metadata",
        F.col("generation_metadata")
        .withField("verified_by_schema", F.col("semantic_pass"))
        .withField("verified_by_execution", F.col("semantic_pass"))
        .withField("verified_by_llm", F.col("semantic_pass") & F.lit(verdicts is not None)),
    )
    return marked.select(*samples.columns, *errors, *GATES)


def verified(gated: DataFrame) -> DataFrame:
    """The samples that passed every gate."""
    errors = ["schema_errors", "static_errors", "exec_errors", "assert_errors"]
    return gated.filter("semantic_pass").drop(*errors, *GATES)
