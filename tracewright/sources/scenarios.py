"""Scenario documents: reading, flattening into tables, and writing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.requests import geojson
from ..operators.skew import with_index
from ..plans.vocabulary import CATEGORIES
from . import schema

OBJECT = (
    "struct<id: string, type: string, name: string, aliases: array<string>, "
    "geometry: struct<type: string, coordinates: variant>, "
    "properties: struct<speed_kmh: double, status: string, heading_deg: double, extra: map<string, string>>>"
)
# `part` numbers the documents of a scenario that was written as several; `first` says how many objects of each
# category, or points of a vehicle, the parts before hold. Documents that stand alone have neither.
DOCUMENT = (
    "scenario_id string, part bigint, coordinate_system string, time string, first struct<"
    + ", ".join(f"{c}: bigint" for c in CATEGORIES)
    + ">, objects struct<"
    + ", ".join(f"{c}: array<{OBJECT}>" for c in CATEGORIES)
    + ">, time_series map<string, struct<first: bigint, trajectory: array<struct<timestamp: string, coordinates: array<double>>>>>"
)

CRS = "EPSG:4326"  # fixed value
CATEGORY_STEP = 10**18  # objects of a category are numbered below this

TYPE_OF = {"vehicles": "vehicle", "cameras": "camera", "polygons": "polygon", "lines": "line"}


def read_documents(spark: SparkSession, path: str, one_per_file: bool = True) -> DataFrame:
    """Scenario documents, with `ord` = the name of the file, which is the order they count in."""
    reader = spark.read.schema(DOCUMENT).option("multiLine", one_per_file)
    return reader.json(path).select(F.col("_metadata.file_name").alias("ord"), "*")


def scenario_table(documents: DataFrame) -> DataFrame:
    return documents.groupBy("scenario_id").agg(
        F.min("ord").alias("ord"), F.min(F.to_timestamp("time")).alias("time")
    )


def object_table(documents: DataFrame) -> DataFrame:
    """All objects in reading order: vehicles, cameras, polygons, lines, each as listed."""

    def numbered(rank: int, category: str):
        listed = F.coalesce(f"objects.{category}", F.array().cast(f"array<{OBJECT}>"))
        return F.transform(
            listed,
            lambda o, i: F.struct(
                (F.lit(rank * CATEGORY_STEP) + F.coalesce(f"first.{category}", F.lit(0)) + i).alias("at"), o.alias("o")
            ),
        )

    every = F.concat(*[numbered(rank, c) for rank, c in enumerate(CATEGORIES)])
    rows = documents.select("scenario_id", F.inline(every))
    kind, coordinates = F.col("o.geometry.type"), F.col("o.geometry.coordinates")

    def shape(name: str, as_type: str):
        return F.when(kind == name, F.try_variant_get(coordinates, "$", as_type))

    geom = F.struct(
        kind.alias("type"),
        shape("Point", "array<double>").alias("pt"),
        shape("LineString", "array<array<double>>").alias("path"),
        shape("Polygon", "array<array<array<double>>>").alias("rings"),
    )
    return rows.select(
        "scenario_id",
        F.col("at").alias("ord"),
        "o.id",
        "o.type",
        "o.name",
        F.coalesce("o.aliases", F.array().cast("array<string>")).alias("aliases"),
        geom.cast(schema.GEOM).alias("geom"),
        F.col("o.properties").alias("props"),
    )


def trajectory_table(documents: DataFrame) -> DataFrame:
    series = documents.select("scenario_id", F.explode("time_series").alias("object_id", "_series"))
    points = series.select(
        "scenario_id", "object_id", F.coalesce("_series.first", F.lit(0)).alias("_first"), F.posexplode("_series.trajectory").alias("pos", "p")
    )
    return points.select(
        "scenario_id",
        "object_id",
        (F.col("_first") + F.col("pos")).alias("pos"),
        F.to_timestamp("p.timestamp").alias("ts"),
        F.col("p.coordinates")[0].alias("lon"),
        F.col("p.coordinates")[1].alias("lat"),
    )


def to_documents(
    scenarios: DataFrame, objects: DataFrame, traj: DataFrame, rows_per_part: int = 10_000
) -> DataFrame:
    """The tables as documents again, the inverse of the three functions above.

    The objects of a scenario are numbered in order, and its trajectory points by vehicle and order; a document
    takes the next `rows_per_part` of both. A scenario of ordinary size is one document, of
    the given format; one of any size goes on in further parts, whose `first` says where each list continues. The
    tables read back hold the same rows in the same order, numbered from 0 per category and vehicle.
    """
    shown = F.struct(
        "id", "type", "name", "aliases", geojson(F.col("geom")).alias("geometry"), F.col("props").alias("properties")
    )
    rank = F.create_map(*[F.lit(x) for i, kind in enumerate(TYPE_OF.values()) for x in (kind, i)])[F.col("type")]
    placed = objects.withColumn("_rank", rank).filter("_rank is not null")
    placed = with_index(placed, ["scenario_id"], ["_rank", "ord"], "_at")
    part = F.floor(F.col("_at") / rows_per_part).alias("part")

    def of_kind(kind: str):
        return F.col("type") == kind

    def in_order(kind: str):
        mine = F.when(of_kind(kind), F.struct("_at", F.to_json(shown).alias("j")))
        return F.transform(F.array_sort(F.collect_list(mine)), lambda x: F.parse_json(x.j))

    starts = placed.groupBy("scenario_id").agg(*[F.min(F.when(of_kind(k), F.col("_at"))).alias(f"_start_{c}") for c, k in TYPE_OF.items()])
    listed = placed.groupBy("scenario_id", part).agg(
        F.struct(*[in_order(kind).alias(category) for category, kind in TYPE_OF.items()]).alias("objects"),
        *[F.min(F.when(of_kind(k), F.col("_at"))).alias(f"_first_{c}") for c, k in TYPE_OF.items()],
    )
    offset = {c: F.nullif(F.col(f"_first_{c}") - F.col(f"_start_{c}"), F.lit(0)) for c in TYPE_OF}
    first = F.when(
        F.coalesce(*offset.values()).isNotNull(), F.struct(*[o.alias(c) for c, o in offset.items()])
    )
    listed = listed.join(starts, "scenario_id").select("scenario_id", "part", first.alias("first"), "objects")

    point = F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("timestamp"), F.array("lon", "lat").alias("coordinates")
    )
    points = with_index(traj, ["scenario_id"], ["object_id", "pos"], "_at")
    begins = points.groupBy("scenario_id", "object_id").agg(F.min("_at").alias("_start"))
    paths = (
        points.groupBy("scenario_id", part, "object_id")
        .agg(F.array_sort(F.collect_list(F.struct("_at", point.alias("p")))).alias("_points"))
        .join(begins, ["scenario_id", "object_id"])
    )
    slice_ = F.struct(
        F.nullif(F.col("_points")[0]["_at"] - F.col("_start"), F.lit(0)).alias("first"),
        F.transform("_points", lambda x: x.p).alias("trajectory"),
    )
    series = paths.groupBy("scenario_id", "part").agg(
        F.map_from_entries(F.collect_list(F.struct("object_id", slice_.alias("s")))).alias("time_series")
    )
    clock = scenarios.select("scenario_id", F.date_format("time", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("time"))
    alone = scenarios.select("scenario_id", F.lit(0).cast("bigint").alias("part"))
    parts = alone.join(listed, ["scenario_id", "part"], "full").join(series, ["scenario_id", "part"], "full")
    return parts.join(clock, "scenario_id").select(
        "scenario_id", "part", F.lit(CRS).alias("coordinate_system"), "time", "first", "objects", "time_series"
    )


def write_documents(documents: DataFrame, path: str) -> None:
    """One JSON document per line."""
    documents.write.mode("overwrite").json(path)
