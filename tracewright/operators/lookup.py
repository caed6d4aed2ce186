"""Object lookups: by id, by type, by reference text, and the errors they give."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Minutes of each time range; any other text means 10 minutes.
TIME_RANGE_MINUTES = {
    "last_5_minutes": 5,
    "last_10_minutes": 10,
    "last_30_minutes": 30,
    "last_1_hour": 60,
    "today": 1440,
}
DEFAULT_MINUTES = 10


def time_range_minutes(time_range: Column) -> Column:
    known = F.create_map(*[F.lit(x) for x in chain.from_iterable(TIME_RANGE_MINUTES.items())])
    return F.coalesce(known[time_range], F.lit(DEFAULT_MINUTES))


def by_id(objects: DataFrame) -> DataFrame:
    """One row per (scenario, id): the last object listed under the id, at its first position."""
    rest = [c for c in objects.columns if c not in ("scenario_id", "id", "ord")]
    return (
        objects.groupBy("scenario_id", "id")
        .agg(F.min("ord").alias("ord"), F.max_by(F.struct(*rest), "ord").alias("_last"))
        .select("scenario_id", "ord", "id", "_last.*")
        .select(*objects.columns)
    )


def found_by_id(objects: DataFrame, object_type: str | None = None) -> DataFrame:
    """The objects that a lookup by id finds, of one type if given: the last one listed under each id."""
    last = objects.groupBy("scenario_id", "id").agg(F.max("ord").alias("ord"))
    wanted = objects if object_type is None else objects_of_type(objects, object_type)
    return wanted.join(last, ["scenario_id", "id", "ord"], "left_semi")


def object_info(queries: DataFrame, objects: DataFrame) -> DataFrame:
    """queries(query_id, scenario_id, object_id) -> id, type, name, geometry, properties.

    Of objects that share an id the last one listed is found.
    """
    table = by_id(objects).select("scenario_id", F.col("id").alias("object_id"), "type", "name", "geom", "props")
    return queries.join(table, ["scenario_id", "object_id"])


def types_by_id(objects: DataFrame) -> DataFrame:
    """(scenario_id, id, type) of the last object listed under each id."""
    return objects.groupBy("scenario_id", "id").agg(F.max_by("type", "ord").alias("type"))


def objects_of_type(objects: DataFrame, object_type: str) -> DataFrame:
    return objects.filter(F.col("type") == object_type)


def reference_index(objects: DataFrame, asked: DataFrame | None = None) -> DataFrame:
    """(scenario_id, _key, _wanted, _hit): the first object in order per text it goes by and type asked for.

    With `asked(scenario_id, _key, _wanted)`, of what is asked for only: other texts are dropped before they are grouped.
    """
    words = F.array_distinct(
        F.transform(
            F.concat(F.array("id", "name"), F.coalesce("aliases", F.array().cast("array<string>"))),
            lambda w: F.lower(w),
        )
    )
    first = F.min(F.struct("ord", "id", "type", "name"))
    named = objects.select(
        "scenario_id",
        "ord",
        "id",
        "type",
        "name",
        F.explode(words).alias("_key"),
    )
    if asked is not None:
        named = named.join(asked.select("scenario_id", "_key").distinct(), ["scenario_id", "_key"], "left_semi")
    return (
        named.withColumn("_wanted", F.explode(F.array(F.col("type"), F.lit(""))))
        .groupBy("scenario_id", "_key", "_wanted")
        .agg(first.alias("_hit"))
    )


def resolve_reference(references: DataFrame, objects: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """references(query_id, scenario_id, reference, expected_type) -> entity and confidence.

    A reference matches an object's id, name or alias, whatever the case; the first object in
    order wins. Candidates are those of the texts asked for, reduced to one per (scenario, text, type) before
    the join; a written `reference_index` can be handed in.
    """
    asked = references.withColumn("_key", F.trim(F.lower("reference"))).withColumn(
        "_wanted", F.coalesce("expected_type", F.lit(""))
    )
    typed = reference_index(objects, asked) if index is None else index
    found = asked.join(typed, ["scenario_id", "_key", "_wanted"], "left")
    return found.select(
        *references.columns,
        F.col("_hit.id").alias("entity_id"),
        F.col("_hit.type").alias("entity_type"),
        F.col("_hit.name").alias("entity_name"),
        F.when(F.col("_hit").isNotNull(), 1.0).otherwise(0.0).alias("confidence"),
    )


def reference_errors(queries: DataFrame, objects: DataFrame) -> DataFrame:
    """queries(query_id, scenario_id, object_id, required_type) that cannot be answered.

    `error` is `object_not_found`, or `type_mismatch` when a type is required and differs.
    """
    table = types_by_id(objects).select(
        "scenario_id", F.col("id").alias("object_id"), F.col("type").alias("actual_type")
    )
    found = queries.join(table, ["scenario_id", "object_id"], "left")
    error = F.when(F.col("actual_type").isNull(), "object_not_found").when(
        F.col("required_type") != F.col("actual_type"), "type_mismatch"
    )
    return found.withColumn("error", error).filter(F.col("error").isNotNull())
