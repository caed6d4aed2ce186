"""Request tables for inference that runs elsewhere, as (request_id, ..., text)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans import prompts
from ..plans.catalog import TOOLS
from .skew import first_rows, with_index

# How many objects of each type a compact scenario shows, and how many ids an
# adversarial request shows.
COMPACT_LIMITS = {"vehicle": 5, "camera": 5, "polygon": 3, "line": 3}
ADVERSARIAL_IDS = 15

CATEGORY_OF = {"vehicle": "vehicles", "camera": "cameras", "polygon": "polygons", "line": "lines"}


def render(template: str, **values: Column) -> Column:
    """The template with its placeholders replaced; values are never scanned for placeholders."""
    parts = re.split(r"\{(\w+)\}", template)
    pieces = [values[p] if i % 2 else F.lit(p) for i, p in enumerate(parts) if i % 2 or p]
    return F.concat(*pieces)


def geojson(geom: Column) -> Column:
    coordinates = F.coalesce(
        F.to_variant_object(geom.pt), F.to_variant_object(geom.path), F.to_variant_object(geom.rings)
    )
    return F.struct(geom.type.alias("type"), coordinates.alias("coordinates"))


def compact_scenarios(scenarios: DataFrame, objects: DataFrame) -> DataFrame:
    """(scenario_id, compact): JSON with the scenario's time and the first objects of each type."""
    most = max(COMPACT_LIMITS.values())
    kept = F.lit(False)
    for kind, limit in COMPACT_LIMITS.items():
        kept = kept | ((F.col("type") == kind) & (F.col("rank") <= limit))
    first = first_rows(objects, ["scenario_id", "type"], "ord", most).filter(kept)
    shown = F.struct(
        "id", "type", "name", "aliases", geojson(F.col("geom")).alias("geometry"), F.col("props").alias("properties")
    )
    lists = [
        F.transform(
            F.array_sort(F.collect_list(F.when(F.col("type") == kind, F.struct("ord", F.to_json(shown).alias("j"))))),
            lambda x: F.parse_json(x.j),
        ).alias(category)
        for kind, category in CATEGORY_OF.items()
    ]
    grouped = first.groupBy("scenario_id").agg(*lists)
    time = F.date_format("time", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("time")
    empty = F.array().cast("array<variant>")
    return scenarios.join(grouped, "scenario_id", "left").select(
        "scenario_id",
        F.to_json(
            F.struct(
                "scenario_id",
                time,
                F.struct(*[F.coalesce(c, empty).alias(c) for c in CATEGORY_OF.values()]).alias("objects"),
            )
        ).alias("compact"),
    )


def blueprint_requests(items: DataFrame, compact: DataFrame, template: str = prompts.BLUEPRINT) -> DataFrame:
    """Work items (ingest.work_items) as request texts."""
    hint = F.lit("")
    for level, words in prompts.DIFFICULTY_HINTS.items():
        hint = F.when(F.col("difficulty") == level, words).otherwise(hint)
    tools = F.to_json(F.array(*[F.lit(t) for t in TOOLS]))
    text = render(
        template, scenario=F.col("compact"), tools=tools, family=F.col("family"), difficulty=F.col("difficulty"), hint=hint
    )
    return items.join(compact, "scenario_id").select(*items.columns, text.alias("text"))


def blueprint_key(kind: str) -> Column:
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("0")) for c in ("bp_ord", "mutation")]
    return F.concat_ws("|", F.lit(kind), "scenario_id", *parts)


def utterance_requests(blueprints: DataFrame, template: str = prompts.UTTERANCES) -> DataFrame:
    """Requests to phrase blueprints, showing six of their fields."""
    shown = F.to_json(
        F.struct("task_type", "difficulty", "target", "constraints", "should_ask_clarification", "negative_case")
    )
    return blueprints.select(
        blueprint_key("utterance").alias("request_id"), "scenario_id", "bp_ord", "mutation",
        render(template, blueprint=shown).alias("text"),
    )


def verifier_requests(samples: DataFrame, template: str = prompts.VERIFIER) -> DataFrame:
    """Requests to judge samples, showing eight of their fields. Render them for samples that
    passed the other gates only.
    """
    shown = F.to_json(
        F.struct("id", "task_type", "difficulty", "user_request", "initial_state", "gold_trace", "expected", "tags")
    )
    return samples.select(
        "id", F.concat(F.lit("verdict|"), "id").alias("request_id"), render(template, sample=shown).alias("text")
    )


def adversarial_requests(items: DataFrame, objects: DataFrame, template: str = prompts.ADVERSARIAL) -> DataFrame:
    """Requests for adversarial blueprints, showing the first ids of the scenario."""
    first = first_rows(objects.select("scenario_id", "ord", "id"), ["scenario_id"], "ord", ADVERSARIAL_IDS)
    ids = first.groupBy("scenario_id").agg(
        F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("rank", "id"))), lambda x: x.id)).alias("_ids")
    )
    text = render(template, scenario_id=F.col("scenario_id"), object_ids=F.coalesce("_ids", F.lit("[]")))
    return items.join(ids, "scenario_id", "left").select(*items.columns, text.alias("text"))


def plan_requests(blueprints: DataFrame, template: str = prompts.PLAN) -> DataFrame:
    """Requests for traces of blueprints without a template, (request_id, scenario_id, bp_ord, text).

    A plan request lists every id of its scenario, in order: its whole text is `text` and then the text of every
    row of `plan_pages` with its scenario_id, by page. Requests of a scenario share these pages, so they
    are kept once and not once per request: all texts spelled out would grow with requests times objects.
    """
    shown = F.to_json(F.struct(*[c for c in blueprints.columns if c not in ("scenario_id", "bp_ord")]))
    head = render(template, scenario_id=F.col("scenario_id"), blueprint=F.col("_shown"))
    return blueprints.withColumn("_shown", shown).select(
        F.concat_ws("|", F.lit("plan"), "scenario_id", F.col("bp_ord").cast("string")).alias("request_id"),
        "scenario_id",
        "bp_ord",
        head.alias("text"),
    )


def plan_pages(scenarios: DataFrame, objects: DataFrame, page_size: int = 1000) -> DataFrame:
    """(scenario_id, page, text): lines of at most `page_size` ids that all plan requests of a scenario end with.

    A scenario without objects has one line without ids.
    """
    pages = object_id_pages(objects, page_size)
    page, ids = F.coalesce("page", F.lit(0)), F.to_json(F.coalesce("ids", F.array().cast("array<string>")))
    line = F.concat(F.lit("\nIds, page "), (page + 1).cast("string"), F.lit(": "), ids)
    asked = scenarios.select("scenario_id").distinct()
    return asked.join(pages, "scenario_id", "left").select("scenario_id", page.alias("page"), line.alias("text"))


def object_id_pages(objects: DataFrame, page_size: int = 1000) -> DataFrame:
    """(scenario_id, page, ids): all ids of each scenario in order, `page_size` a page but for the last."""
    numbered = with_index(objects.select("scenario_id", "ord", "id"), ["scenario_id"], ["ord"], "_at")
    return (
        numbered.groupBy("scenario_id", F.floor(F.col("_at") / page_size).alias("page"))
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("_at", "id"))), lambda x: x.id).alias("ids"))
    )
