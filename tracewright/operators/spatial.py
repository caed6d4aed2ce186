"""Spatial and temporal lookups as joins.

Tables used here:
  scenarios(scenario_id, time)
  objects(scenario_id, ord, id, type, name, aliases, geom, props)
  traj(scenario_id, object_id, pos, ts, lon, lat), pos being the list index of the point

Every operator takes a table of queries and returns result rows in long form, so neither a
busy polygon nor a long trajectory is gathered into one row. Queries about an id that does not
exist or has the wrong type give no rows; `lookup.reference_errors` reports them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..session import materialize
from . import grid
from .lookup import found_by_id, time_range_minutes
from .skew import block_join, with_next


def _points(objects: DataFrame) -> DataFrame:
    """Objects with a Point geometry, as (scenario_id, object_type, id, name, lon, lat)."""
    return objects.filter(F.col("geom.type") == "Point").select(
        "scenario_id",
        F.col("type").alias("object_type"),
        "id",
        "name",
        F.col("geom.pt")[0].alias("lon"),
        F.col("geom.pt")[1].alias("lat"),
    )


def _spread(queries: DataFrame) -> DataFrame:
    """Queries over all cores before they turn into cells: few rows, much work per row.

    Each row becomes about sixteen, so this moves little next to the join that follows.
    """
    return queries.repartition(queries.sparkSession.sparkContext.defaultParallelism)


def objects_inside_polygon(queries: DataFrame, objects: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """queries(scenario_id, polygon_id, object_type) -> the objects strictly inside each polygon.

    Here and below, `keep` names columns of the queries, as who asks, that the results come with.
    """
    ask = queries.select("scenario_id", "polygon_id", "object_type", *keep).distinct()
    zones = found_by_id(objects, "polygon").select(
        "scenario_id", F.col("id").alias("polygon_id"), F.col("geom.rings")[0].alias("_ring")
    )
    asked = ask.join(zones, ["scenario_id", "polygon_id"])
    found = points_in_rings(asked, _points(objects), ["scenario_id", "object_type"], ["polygon_id", *keep], ["id"])
    return found.select("scenario_id", "polygon_id", "object_type", "id", "name", *keep)


def points_in_rings(
    areas: DataFrame, points: DataFrame, keys: list[str], area_id: list[str], point_id: list[str]
) -> DataFrame:
    """areas(keys, `_ring`, ...) and points(keys, lon, lat, ...) -> the pairs with the point strictly inside.

    For a ring that is a rectangle along the axes its box says all; the edges of any other are tested.
    """
    boxed = areas.select(
        *[c for c in areas.columns if c != "_ring"],
        grid.box_of(F.col("_ring")).alias("_box"),
        geo.is_box(F.col("_ring")).alias("_plain"),
        "_ring",
    )
    level, b = grid.box_level(F.col("_box")), F.col("_box")
    shapes = boxed.select(level, "_plain").distinct().collect()  # ten resolutions, two forms
    in_box = (
        (F.col("lon") > b.min_x)
        & (F.col("lon") < b.max_x)
        & (F.col("lat") > b.min_y)
        & (F.col("lat") < b.max_y)
    )
    tables = []
    for plain in sorted({s[1] for s in shapes}) or [True]:
        levels = sorted({s[0] for s in shapes if s[1] == plain and s[0] is not None})
        of_form = boxed.filter(F.col("_plain") == plain).drop("_plain")
        edged = of_form if plain else of_form.withColumn("_edges", geo.edges(geo.closed(F.col("_ring"))))
        left = grid.with_box_cells(_spread(edged.drop("_ring")), level)
        right = grid.with_point_cells(points, "lon", "lat", levels)
        pairs = block_join(left, right, [*keys, *grid.CELL], area_id, point_id).filter(in_box)
        if not plain:
            pairs = pairs.filter(geo.strictly_inside(F.col("_edges"), F.col("lon"), F.col("lat"))).drop("_edges")
        tables.append(pairs.drop("_box", *grid.CELL))
    return reduce(DataFrame.unionByName, tables)


def _circle_boxes(lon: Column, lat: Column, radius: Column) -> Column:
    """Boxes that hold every point within the radius; two of them across the date line."""
    angle = radius / F.lit(float(geo.EARTH_RADIUS_M))
    margin = F.lit(1e-9)
    dlat = F.degrees(angle) + margin
    reach = F.sin(F.least(angle, F.lit(1.5))) / F.cos(F.radians(lat))
    polar = (F.abs(lat) + dlat >= 90) | (F.abs(reach) >= 1) | (angle >= 1.5)
    dlon = F.degrees(F.asin(F.least(reach, F.lit(1.0)))) + margin
    low, high = lat - dlat, lat + dlat
    whole = F.array(grid.box(F.lit(-180.0), low, F.lit(180.0), high))
    west, east = lon - dlon, lon + dlon
    plain = F.array(grid.box(west, low, east, high))
    over_west = F.array(grid.box(F.lit(-180.0), low, east, high), grid.box(west + 360, low, F.lit(180.0), high))
    over_east = F.array(grid.box(west, low, F.lit(180.0), high), grid.box(F.lit(-180.0), low, east - 360, high))
    return (
        F.when(polar, whole)
        .when(west < -180, over_west)
        .when(east > 180, over_east)
        .otherwise(plain)
    )


def nearby_objects(queries: DataFrame, objects: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """queries(scenario_id, object_id, object_type, radius_meters) -> objects within the radius.

    The centre itself is left out; the distance is compared unrounded and shown to 0.1 m.
    """
    ask = queries.select("scenario_id", "object_id", "object_type", "radius_meters", *keep).distinct()
    centres = _points(found_by_id(objects)).select(
        "scenario_id",
        F.col("id").alias("object_id"),
        F.col("lon").alias("_lon"),
        F.col("lat").alias("_lat"),
    )
    asked = ask.join(centres, ["scenario_id", "object_id"])
    radius, level = F.col("radius_meters"), grid.box_level(F.col("_box"))
    # A box near a pole is wider than high: its own extent gives the resolution, so it never covers many cells.
    boxed = materialize(asked.select("*", F.explode(_circle_boxes(F.col("_lon"), F.col("_lat"), radius)).alias("_box")))
    levels = grid.levels_in_use(boxed, level)
    left = grid.with_box_cells(_spread(boxed), level)
    right = grid.with_point_cells(_points(objects), "lon", "lat", levels)
    pairs = block_join(
        left, right, ["scenario_id", "object_type", *grid.CELL], ["object_id", "radius_meters", *keep], ["id"]
    )
    b = F.col("_box")  # holds all points within the radius, and spares most others the distance
    in_box = (
        (F.col("lon") >= b.min_x) & (F.col("lon") <= b.max_x) & (F.col("lat") >= b.min_y) & (F.col("lat") <= b.max_y)
    )
    distance = geo.haversine_m(F.col("_lon"), F.col("_lat"), F.col("lon"), F.col("lat"))
    return (
        pairs.filter(in_box & (F.col("id") != F.col("object_id")))
        .withColumn("_d", distance)
        .filter(F.col("_d") <= F.col("radius_meters"))
        .select(
            "scenario_id",
            "object_id",
            "object_type",
            "radius_meters",
            "id",
            "name",
            F.round("_d", 1).alias("distance_m"),
            *keep,
        )
    )


def vehicle_trajectory(
    queries: DataFrame, scenarios: DataFrame, objects: DataFrame, traj: DataFrame
) -> DataFrame:
    """queries(scenario_id, vehicle_id, time_range) -> trajectory points in the range.

    The range starts at the scenario's time minus its minutes, inclusive, and has no end. Who is asked for is
    written once, and so are the points of these vehicles; no others are counted or sorted.
    """
    ask = (
        queries.select("scenario_id", "vehicle_id", "time_range")
        .distinct()
        .join(
            found_by_id(objects, "vehicle").select("scenario_id", F.col("id").alias("vehicle_id")),
            ["scenario_id", "vehicle_id"],
        )
    )
    windows = materialize(ask.join(scenarios.select("scenario_id", "time"), "scenario_id").select(
        "scenario_id", "vehicle_id", "time_range", _cutoff(F.col("time"), time_range_minutes(F.col("time_range"))).alias("_from")
    ))
    points = traj.select(
        "scenario_id", F.col("object_id").alias("vehicle_id"), "pos", "ts", "lon", "lat"
    )
    points = points.filter(F.col("ts") >= windows.agg(F.min("_from")).scalar())
    asked = windows.select("scenario_id", "vehicle_id").distinct()
    points = materialize(points.join(asked, ["scenario_id", "vehicle_id"], "left_semi"))
    return (
        block_join(windows, points, ["scenario_id", "vehicle_id"], ["time_range"], ["pos"])
        .filter(F.col("ts") >= F.col("_from"))
        .drop("_from")
    )


def _cutoff(time: Column, minutes: Column) -> Column:
    return time - F.make_dt_interval(F.lit(0), F.lit(0), minutes)


def objects_crossing_line(
    queries: DataFrame, scenarios: DataFrame, objects: DataFrame, traj: DataFrame, keep: Sequence[str] = ()
) -> DataFrame:
    """queries(scenario_id, line_id, object_type, time_range) -> objects whose path meets the line.

    The path joins the points left after the time filter, so a path needs two such points. The
    steps of these paths are written to the scratch folder once.
    """
    minutes = time_range_minutes(F.col("time_range"))
    ask = queries.select("scenario_id", "line_id", "object_type", "time_range", *keep).distinct()
    asked = ask.withColumn("_minutes", minutes).join(
        found_by_id(objects, "line").select(
            "scenario_id",
            F.col("id").alias("line_id"),
            F.explode(geo.edges(F.col("geom.path"))).alias("_line"),
        ),
        ["scenario_id", "line_id"],
    )
    in_use = [r[0] for r in ask.select(minutes).distinct().collect()]  # five values at most
    points = _recent_points(scenarios, traj, in_use)
    # Names come before the pairs are formed: there are far more pairs than objects.
    named = objects.groupBy("scenario_id", "id", F.col("type").alias("object_type")).agg(
        F.collect_list(F.struct("name")).alias("_names")
    )
    steps = materialize(_segments(points).join(named, ["scenario_id", "id"]))  # read for its levels, its hot cells and the join
    pairs = meeting_segments(
        asked.withColumnRenamed("_line", "_one"),
        steps.withColumnRenamed("_step", "_other"),
        ["scenario_id", "object_type", "_minutes"],
        ["line_id", "_one", *keep],
        ["id", "pos"],
    )
    crossing = pairs.select("scenario_id", "line_id", "object_type", "time_range", "id", "_names", *keep).distinct()
    return crossing.select("scenario_id", "line_id", "object_type", "time_range", "id", F.inline("_names"), *keep)


def meeting_segments(
    ones: DataFrame, others: DataFrame, keys: list[str], one_id: list[str], other_id: list[str], wanted: Column | None = None
) -> DataFrame:
    """ones(keys, `_one`, ...) and others(keys, `_other`, ...) -> each pair of segments that share a point, once.

    With `wanted`, of such pairs only; it is looked at before the geometry.
    """
    ones = ones.withColumn("_box", _segment_box(F.col("_one")))
    others = others.withColumn("_box", _segment_box(F.col("_other")))
    level = grid.box_level(F.col("_box"))
    one_levels, other_levels = grid.levels_in_use(ones, level), grid.levels_in_use(others, level)
    left = grid.with_shared_cells(_spread(ones), other_levels).withColumnsRenamed(
        {"_box": "_one_box", "_own_level": "_one_level"}
    )
    right = grid.with_shared_cells(_spread(others), one_levels).withColumnsRenamed(
        {"_box": "_other_box", "_own_level": "_other_level"}
    )
    once = grid.first_shared_cell(F.col("_one_box"), F.col("_other_box"), F.col("_one_level"), F.col("_other_level"))
    pairs = block_join(left, right, [*keys, *grid.CELL], one_id, other_id)
    if wanted is not None:
        pairs = pairs.filter(wanted)
    return pairs.filter(geo.segments_meet(F.col("_one"), F.col("_other")) & once)


def meeting_paths(paths: DataFrame, keys: list[str]) -> DataFrame:
    """paths(keys, id, path) -> (keys, one, other): the pairs of paths of a key that share a point, one < other by id."""
    steps = paths.select(*keys, "id", F.explode(geo.edges(F.col("path"))).alias("_one"))
    ones = steps.withColumnRenamed("id", "one")
    others = steps.select(*keys, F.col("id").alias("other"), F.col("_one").alias("_other"))
    in_order = F.col("one") < F.col("other")
    pairs = meeting_segments(ones, others, keys, ["one", "_one"], ["other", "_other"], in_order)
    return pairs.select(*keys, "one", "other").distinct()


def _segment_box(s: Column) -> Column:
    return grid.box(
        F.least(s.ax, s.bx), F.least(s.ay, s.by), F.greatest(s.ax, s.bx), F.greatest(s.ay, s.by)
    )


def _recent_points(scenarios: DataFrame, traj: DataFrame, minutes: list[int]) -> DataFrame:
    """Trajectory points, once per range in use that holds them."""
    earliest = scenarios.agg(_cutoff(F.min("time"), F.lit(max(minutes, default=0)))).scalar()
    recent = traj.filter(F.col("ts") >= earliest).join(
        scenarios.select("scenario_id", "time"), "scenario_id"
    )
    ranges = F.filter(
        F.array(*[F.lit(m) for m in minutes]).cast("array<int>"),
        lambda m: F.col("ts") >= _cutoff(F.col("time"), m),
    )
    return recent.select(
        "scenario_id",
        F.col("object_id").alias("id"),
        "pos",
        "lon",
        "lat",
        F.explode(ranges).alias("_minutes"),
    )


def _segments(points: DataFrame) -> DataFrame:
    """Steps between consecutive points."""
    linked = with_next(points, ["scenario_id", "id", "_minutes"], "pos", ["lon", "lat"])
    return linked.filter(F.col("next").isNotNull()).select(
        "scenario_id",
        "id",
        "_minutes",
        "pos",
        F.struct(
            F.col("lon").alias("ax"),
            F.col("lat").alias("ay"),
            F.col("next.lon").alias("bx"),
            F.col("next.lat").alias("by"),
        ).alias("_step"),
    )


def polygon_area(objects: DataFrame) -> DataFrame:
    """Area in square metres of every polygon, to 2 decimals."""
    return objects.filter(F.col("type") == "polygon").select(
        "scenario_id",
        F.col("id").alias("polygon_id"),
        F.round(geo.ring_area_m2(F.col("geom.rings")[0]), 2).alias("area_sqm"),
    )


def line_length(objects: DataFrame) -> DataFrame:
    """Length in metres of every line, to 2 decimals."""
    return objects.filter(F.col("type") == "line").select(
        "scenario_id",
        F.col("id").alias("line_id"),
        F.round(geo.path_length_m(F.col("geom.path")), 2).alias("length_meters"),
    )
