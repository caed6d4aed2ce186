"""Negative cases: positive blueprints mutated so that the agent has to ask back."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import schema
from .skew import first_rows

# The type shown in place of the expected one, the made-up id, and the
# difficulty each mutation gets.
WRONG_TYPE = {"vehicle": "camera", "camera": "vehicle", "polygon": "line", "line": "polygon"}
NONEXISTENT_ID = "vehicle_999_nonexistent"
MUTATIONS = {"missing_selected": "L0", "type_mismatch": "L5", "multiple_selected": "L5", "nonexistent_id": "L5"}
ADVERSARIAL = len(MUTATIONS) + 1


def first_entities(objects: DataFrame, n: int = 2) -> DataFrame:
    """Per scenario, a map from type to its first `n` objects in order."""
    entity = F.struct("id", "type", "name").cast(schema.ENTITY)
    return (
        first_rows(objects.select("scenario_id", "ord", "id", "type", "name"), ["scenario_id", "type"], "ord", n)
        .groupBy("scenario_id", "type")
        .agg(F.array_sort(F.collect_list(F.struct("rank", entity.alias("entity")))).alias("_ranked"))
        .groupBy("scenario_id")
        .agg(
            F.map_from_entries(
                F.collect_list(F.struct("type", F.transform("_ranked", lambda r: r.entity)))
            ).alias("first_of")
        )
    )


def _selected(kind: Column, entities: Column, is_list: bool) -> Column:
    """A selection with the entities in the slot their type belongs to."""
    slot = F.struct(F.lit(is_list).alias("is_list"), entities.alias("ents")).cast(schema.SLOT)
    name = F.when(kind.isin("vehicle", "camera"), "object").otherwise(kind)
    return F.struct(*[F.when(name == s, slot).alias(s) for s in ("object", "line", "polygon")]).cast(schema.SELECTED)


def mutate(blueprints: DataFrame, objects: DataFrame) -> DataFrame:
    """Every mutation that applies to each positive blueprint, as blueprints with a `mutation` rank."""
    mode, kind = F.col("target.reference_mode"), F.col("target.expected_type")
    has_kind = F.coalesce(kind != "", F.lit(False))
    wrong = F.create_map(*[F.lit(x) for x in chain.from_iterable(WRONG_TYPE.items())])[kind]
    shown, own = F.col("first_of")[wrong], F.col("first_of")[kind]
    nothing = F.struct(*[F.lit(None).cast(schema.SLOT).alias(s) for s in ("object", "line", "polygon")])
    applies = {
        "missing_selected": mode == "selected_object",
        "type_mismatch": (mode == "selected_object") & has_kind & (F.size(shown) >= 1),
        "multiple_selected": has_kind & (F.size(own) >= 2),
        "nonexistent_id": mode == "explicit_id",
    }
    shows = {
        "missing_selected": nothing.cast(schema.SELECTED),
        "type_mismatch": _selected(wrong, F.slice(shown, 1, 1), False),
        "multiple_selected": _selected(kind, F.slice(own, 1, 2), True),
        "nonexistent_id": F.col("selected"),
    }
    target = F.col("target")
    fake = target.withField("object_id", F.lit(NONEXISTENT_ID))
    cases = []
    for rank, (name, difficulty) in enumerate(MUTATIONS.items(), start=1):
        case = F.struct(
            F.lit(rank).alias("mutation"),
            F.lit(name).alias("negative_type"),
            F.lit(difficulty).alias("difficulty"),
            shows[name].alias("selected"),
            (fake if name == "nonexistent_id" else target).alias("target"),
        )
        cases.append(F.when(F.coalesce(applies[name], F.lit(False)), case))
    replaced = ["mutation", "negative_type", "difficulty", "selected", "target"]
    kept = [c for c in blueprints.columns if c not in replaced]
    return (
        blueprints.filter(~F.coalesce("negative_case", F.lit(False)))
        .join(first_entities(objects), "scenario_id", "left")
        .select(*kept, F.inline(F.array_compact(F.array(*cases))))
        .transform(asking_back)
    )


def asking_back(blueprints: DataFrame) -> DataFrame:
    """Mark blueprints as negative: the one thing to check is that the agent asks back."""
    ask = F.struct(F.lit("clarification_requested").alias("type"))
    fields = [f.split(":")[0].strip() for f in schema.ASSERTION[len("struct<") : -1].split(", ")]
    full = F.struct(ask["type"].alias("type"), *[F.lit(None).alias(f) for f in fields[1:]])
    return blueprints.withColumns(
        {
            "negative_case": F.lit(True),
            "should_ask_clarification": F.lit(True),
            "expected_final_state": F.array(full.cast(schema.ASSERTION)),
        }
    )


def negative_cases(
    blueprints: DataFrame, objects: DataFrame, adversarial: DataFrame | None = None
) -> DataFrame:
    """Mutations, followed by the blueprints a model wrote (see ingest.adversarial_blueprints)."""
    cases = mutate(blueprints, objects)
    if adversarial is None:
        return cases
    return cases.unionByName(adversarial, allowMissingColumns=True)
