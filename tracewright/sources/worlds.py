"""Synthetic scenarios of any number, drawn from hashes of the scenario and object.

The same seed gives the same worlds on any cluster, in any order of execution: every random
number depends on its key alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..functions.text import padded
from . import schema
from .scenarios import CATEGORY_STEP

# The area worlds lie in, name parts, sizes per tier, and the form of trajectories.
MIN_LON, MAX_LON, MIN_LAT, MAX_LAT = 106.62, 106.75, 10.75, 10.85
NAMES = ["Truck", "Car", "Bus", "Van", "Motorbike"]
VIETNAMESE_NAMES = ["Xe tải", "Ô tô", "Xe buýt", "Xe van", "Xe máy"]
PLATES = ["51A", "51B", "51C", "51D", "51F", "30A", "30B", "29A", "43A"]
STATUSES = ["moving", "stopped", "idle"]
TIERS = {"small": (5, 3, 2, 2), "medium": (20, 10, 5, 5), "large": (50, 20, 10, 8)}
BASE_TIME = "2026-05-18T09:15:00+07:00"
INTERVAL_S = 300
ROAD_POINTS = 4


class Draw:
    """Random numbers for one row: each name gives an independent number."""

    def __init__(self, *key: Column):
        self.key = key

    def uniform(self, name: str, low: float = 0.0, high: float = 1.0, *more: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(*self.key, *more, F.lit(name)), 11)
        return F.lit(low) + bits / F.lit(float(1 << 53)) * F.lit(high - low)

    def normal(self, name: str, *more: Column) -> Column:
        u = F.greatest(self.uniform(f"{name}.a", 0.0, 1.0, *more), F.lit(1e-300))
        return F.sqrt(-2 * F.log(u)) * F.cos(F.lit(2 * math.pi) * self.uniform(f"{name}.b", 0.0, 1.0, *more))

    def choice(self, name: str, options: list) -> Column:
        index = F.floor(self.uniform(name) * len(options)).cast("int") + 1
        return F.element_at(F.array(*[F.lit(o) for o in options]), index)

    def point(self, name: str) -> tuple[Column, Column]:
        return (
            geo.to_micro(self.uniform(f"{name}.lon", MIN_LON, MAX_LON)),
            geo.to_micro(self.uniform(f"{name}.lat", MIN_LAT, MAX_LAT)),
        )


def world_plan(numbers: DataFrame, small_fraction: float = 0.3, medium_fraction: float = 0.5) -> DataFrame:
    """numbers(i), 1-based -> (scenario_id, ord, time, tier, number of objects per category).

    The tier goes by rank i / count: the first worlds are small, the last ones large.
    """
    count = numbers.agg(F.count(F.lit(1))).scalar()
    rank = F.col("i") / count
    tier = (
        F.when(rank <= small_fraction, "small")
        .when(rank <= small_fraction + medium_fraction, "medium")
        .otherwise("large")
    )
    sizes = [
        F.when(F.col("tier") == "small", TIERS["small"][k])
        .when(F.col("tier") == "medium", TIERS["medium"][k])
        .otherwise(TIERS["large"][k])
        .alias(name)
        for k, name in enumerate(["vehicles", "cameras", "zones", "roads"])
    ]
    return numbers.withColumn("tier", tier).select(
        padded("traffic_synthetic_", F.col("i"), 3).alias("scenario_id"),
        F.col("i").cast("bigint").alias("ord"),
        F.to_timestamp(F.lit(BASE_TIME)).alias("time"),
        "tier",
        *sizes,
    )


def _members(plan: DataFrame, size: str) -> DataFrame:
    return plan.select("scenario_id", "time", F.explode(F.sequence(F.lit(1), F.col(size))).alias("n"))


def _object(rank: int, kind: str, object_id: Column, name: Column, aliases: list[Column], props: Column, **shape: Column) -> list[Column]:
    types = {"pt": "array<double>", "path": "array<array<double>>", "rings": "array<array<array<double>>>"}
    label = {"pt": "Point", "path": "LineString", "rings": "Polygon"}[next(iter(shape))]
    geom = F.struct(F.lit(label).alias("type"), *[shape.get(k, F.lit(None)).cast(t).alias(k) for k, t in types.items()])
    return [
        F.col("scenario_id"),
        (F.lit(rank * CATEGORY_STEP) + F.col("n") - 1).alias("ord"),
        object_id.alias("id"),
        F.lit(kind).alias("type"),
        name.alias("name"),
        F.array(*aliases).alias("aliases"),
        geom.cast(schema.GEOM).alias("geom"),
        props.cast(schema.PROPS).alias("props"),
    ]


def _vehicles(plan: DataFrame, seed: int) -> DataFrame:
    n = F.col("n")
    draw = Draw(F.lit(seed), F.col("scenario_id"), F.lit("vehicle"), n)
    plate = F.concat(
        padded("", n, 3), F.lit("."), F.floor(draw.uniform("plate", 10, 100)).cast("string")
    )
    return _members(plan, "vehicles").select(
        "*",
        F.array(*draw.point("at")).alias("at"),
        F.round(draw.uniform("speed", 20, 80), 1).alias("speed"),
        F.round(draw.uniform("heading", 0, 360), 1).alias("heading"),
        draw.choice("status", STATUSES).alias("status"),
        F.concat(draw.choice("name", NAMES), F.lit(" "), padded("", n, 3)).alias("name"),
        F.concat(draw.choice("name_vi", VIETNAMESE_NAMES), F.lit(" "), padded("", n, 3)).alias("name_vi"),
        F.concat(draw.choice("prefix", PLATES), F.lit("-"), plate).alias("plate"),
    )


def objects(plan: DataFrame, seed: int = 42) -> DataFrame:
    """The objects of all planned worlds."""
    n = F.col("n")
    none = F.lit(None)
    moving = F.struct(
        F.col("speed").alias("speed_kmh"), F.col("status").alias("status"), F.col("heading").alias("heading_deg"), none.alias("extra")
    )
    vehicles = _vehicles(plan, seed).select(
        *_object(
            0, "vehicle", padded("vehicle_", n, 3), F.col("name"), [F.col("name_vi"), F.col("plate"), padded("xe ", n, 3)], moving, pt=F.col("at")
        )
    )

    def draw(kind: str) -> Draw:
        return Draw(F.lit(seed), F.col("scenario_id"), F.lit(kind), n)

    cameras = _members(plan, "cameras").select(
        *_object(
            1, "camera", padded("camera_", n, 2), padded("Camera ", n, 2),
            [padded("cam ", n, 2), F.concat(F.lit("camera số "), n.cast("string"))], none, pt=F.array(*draw("camera").point("at")),
        )
    )
    z = draw("zone")
    zones = (
        _members(plan, "zones")
        .select("*", F.array(*z.point("at")).alias("at"), z.uniform("w", 300, 800).alias("w"), z.uniform("h", 300, 800).alias("h"))
        .select(
            *_object(
                2, "polygon", padded("zone_", n, 2), padded("Zone ", n, 2),
                [padded("vùng ", n, 2), F.concat(F.lit("khu vực "), n.cast("string"))], none,
                rings=F.array(geo.rectangle_ring(F.col("at")[0], F.col("at")[1], F.col("w"), F.col("h"))),
            )
        )
    )
    r = draw("road")
    roads = _members(plan, "roads").select(
        "*",
        F.array(*r.point("at")).alias("at"),
        F.radians(r.uniform("heading", 0, 360)).alias("heading"),
        (r.uniform("length", 500, 1500) / (ROAD_POINTS - 1)).alias("step"),
    )
    bends = F.transform(
        F.sequence(F.lit(1), F.lit(ROAD_POINTS - 1)), lambda i: r.normal("bend", i) * F.lit(0.0001)
    )
    path = F.aggregate(
        bends,
        F.array(F.col("at")),
        lambda path, bend: F.concat(
            path, F.array(_moved(F.element_at(path, -1), F.col("step"), F.col("heading"), bend))
        ),
    )
    lines = roads.select(
        *_object(
            3, "line", padded("road_", n, 2), padded("Road ", n, 2),
            [padded("đường ", n, 2), F.concat(F.lit("tuyến "), n.cast("string"))], none, path=path,
        )
    )
    return vehicles.unionByName(cameras).unionByName(zones).unionByName(lines)


def _moved(at: Column, metres: Column, heading: Column, shift: Column) -> Column:
    """The point reached from `at`, moved by `shift` degrees on top."""
    lon, lat = at[0], at[1]
    return F.array(
        geo.to_micro(lon + geo.degrees_lon(metres, lat) * F.sin(heading) + shift),
        geo.to_micro(lat + geo.degrees_lat(metres) * F.cos(heading) + shift),
    )


def trajectories(plan: DataFrame, seed: int = 42, duration_min: int = 30) -> DataFrame:
    """Points of every vehicle, one per interval up to one interval before the scenario's time."""
    points = max(duration_min * 60 // INTERVAL_S, 2)
    draw = Draw(F.lit(seed), F.col("scenario_id"), F.lit("path"), F.col("n"))
    low = F.greatest(F.col("speed") - 10, F.lit(10.0))
    kmh = low + draw.uniform("speed") * (F.col("speed") + 10 - low)
    based = _vehicles(plan, seed).withColumn("_step", kmh * 1000 / 3600 * INTERVAL_S)
    turns = F.transform(F.sequence(F.lit(1), F.lit(points - 1)), lambda i: draw.normal("turn", i) * F.lit(0.05))
    heading = F.radians("heading")
    path = F.aggregate(
        turns,
        F.array(F.col("at")),
        lambda path, turn: F.concat(
            path, F.array(_moved(F.element_at(path, -1), F.col("_step"), heading + turn, F.lit(0.0)))
        ),
    )
    start = F.col("time") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(duration_min))
    seconds = (F.col("pos") * INTERVAL_S).cast("double")
    return based.select(
        "scenario_id", padded("vehicle_", F.col("n"), 3).alias("object_id"), start.alias("_start"), F.posexplode(path).alias("pos", "p")
    ).select(
        "scenario_id",
        "object_id",
        F.col("pos").cast("bigint").alias("pos"),
        (F.col("_start") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)).alias("ts"),
        F.col("p")[0].alias("lon"),
        F.col("p")[1].alias("lat"),
    )
