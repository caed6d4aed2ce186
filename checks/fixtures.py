"""The driver tables seen as scenarios, map objects, trajectories, blueprints and responses."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from tracewright.functions import geo
from tracewright.functions.text import padded
from tracewright.operators import assemble, negatives
from tracewright.plans import traces
from tracewright.plans.vocabulary import TASK_FAMILIES
from tracewright.session import configure, materialize, scratch_dir
from tracewright.sources import schema

SCENARIOS = 25
_WRITTEN: dict[tuple[str, str, str], tuple[str, StructType]] = {}
CATEGORY_STEP = 10**12
ID = {"vehicle": "vehicle_", "camera": "camera_", "polygon": "zone_", "line": "road_"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def written(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """A table that many queries start from, written once per application and input, and read by each of them."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    for _ in range(2):
        if key not in _WRITTEN:
            df, path = make(), scratch_dir(spark)
            df.write.parquet(path)
            _WRITTEN[key] = path, df.schema
        path, shape = _WRITTEN[key]
        try:
            return spark.read.schema(shape).parquet(path)
        except AnalysisException:  # the scratch folder has been cleared
            del _WRITTEN[key]
    raise FileNotFoundError(path)


def lon(key: Column, factor: int, offset: Column | int = 0) -> Column:
    return (F.lit(106620000) + key.cast("long") * factor % 26000 + offset) / F.lit(1e6)


def lat(key: Column, factor: int, offset: Column | int = 0) -> Column:
    return (F.lit(10750000) + key.cast("long") * factor % 20000 + offset) / F.lit(1e6)


def scenario_id(number: Column) -> Column:
    return padded("traffic_synthetic_", number + 1, 3)


def object_id(kind: str, key: Column) -> Column:
    return padded(ID[kind], key, 6)


def scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        scenario_id(n).alias("scenario_id"),
        (n + 1).alias("ord"),
        F.lit("2024-01-30 23:30:00").cast("timestamp").alias("time"),
    )


def _objects(df: DataFrame, rank: int, kind: str, number: Column, key: Column, name: Column, aliases: Column, **geom: Column) -> DataFrame:
    empty = {
        "pt": "array<double>",
        "path": "array<array<double>>",
        "rings": "array<array<array<double>>>",
    }
    shape = F.struct(
        F.lit({"pt": "Point", "path": "LineString", "rings": "Polygon"}[next(iter(geom))]).alias("type"),
        *[geom.get(k, F.lit(None)).cast(t).alias(k) for k, t in empty.items()],
    )
    return df.select(
        scenario_id(number).alias("scenario_id"),
        (F.lit(rank * CATEGORY_STEP) + key).alias("ord"),
        object_id(kind, key).alias("id"),
        F.lit(kind).alias("type"),
        name.alias("name"),
        aliases.cast("array<string>").alias("aliases"),
        shape.alias("geom"),
        F.lit(None).cast(schema.PROPS).alias("props"),
    )


def vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return _objects(
        table(spark, sf_dir, "customer"), 0, "vehicle", F.col("c_nationkey"), k, F.col("c_name"),
        F.array(padded("xe ", k % 1000, 3)), pt=F.array(lon(k, 7919), lat(k, 104729)),
    )


def cameras(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    return _objects(
        table(spark, sf_dir, "supplier"), 1, "camera", F.col("s_nationkey"), k, F.col("s_name"),
        F.array(padded("cam ", k % 100, 2)), pt=F.array(lon(k, 6101), lat(k, 15013)),
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    ring = geo.rectangle_ring(
        lon(k, 3571), lat(k, 8837), (F.col("p_size") * 10 + 300).cast("double"), (k % 500 + 300).cast("double")
    )
    return _objects(
        table(spark, sf_dir, "part"), 2, "polygon", k % SCENARIOS, k, padded("Zone ", k, 2),
        F.array(padded("vùng ", k, 2)), rings=F.array(ring),
    )


def roads(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    df = table(spark, sf_dir, "part").select("p_partkey")
    heading = F.radians((k * 37 % 360).cast("double"))
    step = (k * 13 % 1000 + 500).cast("double") / 3
    df = df.select("*", lon(k, 4409).alias("x0"), lat(k, 9973).alias("y0"))
    for i in range(3):
        x, y = F.col(f"x{i}"), F.col(f"y{i}")
        df = df.select(
            "*",
            F.round(x + geo.degrees_lon(step, y) * F.sin(heading), 6).alias(f"x{i + 1}"),
            F.round(y + geo.degrees_lat(step) * F.cos(heading), 6).alias(f"y{i + 1}"),
        )
    path = F.array(*[F.array(f"x{i}", f"y{i}") for i in range(4)])
    return _objects(
        df, 3, "line", k % SCENARIOS, k, padded("Road ", k, 2), F.array(padded("đường ", k, 2)), path=path
    )


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [f(spark, sf_dir) for f in (vehicles, cameras, zones, roads)]
    return reduce(DataFrame.unionByName, parts)


def traj(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, k = F.col("event_id"), F.col("c_custkey")
    events = table(spark, sf_dir, "events").select("event_id", "ts", F.col("user_id").alias("c_custkey"))
    owner = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    # Path order is time order.
    rank = F.row_number().over(Window.partitionBy("c_custkey").orderBy("ts", "event_id"))
    return events.withColumn("rank", rank.cast("bigint")).join(owner, "c_custkey").select(
        scenario_id(F.col("c_nationkey")).alias("scenario_id"),
        object_id("vehicle", k).alias("object_id"),
        F.col("rank").alias("pos"),
        F.col("ts").cast("timestamp").alias("ts"),
        lon(k, 7919, (e * 31 % 2001 - 1000) * 10).alias("lon"),
        lat(k, 104729, (e * 53 % 2001 - 1000) * 10).alias("lat"),
    )


def _row_count(df: DataFrame) -> Column:
    return df.agg(F.count(F.lit(1))).scalar()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the target of the task each one stands for."""
    d = F.col("doc_id")
    family = (d % 10).cast("int")
    customer, part = table(spark, sf_dir, "customer"), table(spark, sf_dir, "part")
    kind = F.when(family.isin(3, 5), "polygon").when(family.isin(4, 6), "line").otherwise("vehicle")
    docs = (
        table(spark, sf_dir, "documents")
        .select("doc_id", "text", family.alias("family"), kind.alias("kind"))
        .withColumn(
            "key", F.when(F.col("kind") == "vehicle", d * 7 % _row_count(customer)).otherwise(d * 7 % _row_count(part))
        )
    )
    owner = customer.select(F.lit("vehicle").alias("kind"), F.col("c_custkey").alias("key"), "c_nationkey", "c_name")
    number = F.coalesce(F.col("c_nationkey"), F.col("key") % SCENARIOS)
    name = F.coalesce(
        "c_name",
        F.when(F.col("kind") == "polygon", padded("Zone ", F.col("key"), 2)).otherwise(padded("Road ", F.col("key"), 2)),
    )
    target = (
        F.when(F.col("kind") == "vehicle", object_id("vehicle", F.col("key")))
        .when(F.col("kind") == "polygon", object_id("polygon", F.col("key")))
        .otherwise(object_id("line", F.col("key")))
    )
    return docs.join(owner, ["kind", "key"], "left").select(
        "doc_id", "text", "family", "kind",
        scenario_id(number).alias("scenario_id"), target.alias("target_id"), name.alias("target_name"),
    )


def _slot(entity: Column | None) -> Column:
    if entity is None:
        return F.lit(None).cast(schema.SLOT)
    return F.when(entity.isNotNull(), F.struct(F.lit(False).alias("is_list"), F.array(entity).alias("ents"))).cast(schema.SLOT)


def assertion(kind: str, **fields: Column | str) -> Column:
    names = ["artifact_type", "source_object_id", "object_id", "object_ids", "object_type", "target_id", "time_range"]
    values = [F.lit(fields[n]) if isinstance(fields.get(n), str) else fields.get(n, F.lit(None)) for n in names]
    return F.struct(F.lit(kind).alias("type"), *[v.alias(n) for v, n in zip(values, names)]).cast(schema.ASSERTION)


def blueprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, f, target = F.col("doc_id"), F.col("family"), F.col("target_id")
    selected_mode = F.floor(d / 10) % 2 == 0
    none = F.array().cast(f"array<{schema.ASSERTION}>")
    wanted = (
        F.when(
            f == 0,
            F.array(
                assertion("artifact_exists", artifact_type="polyline", source_object_id=target),
                assertion("polyline_source_matches_vehicle", source_object_id=target),
            ),
        )
        .when(f == 1, F.array(assertion("popup_shown", target_id=target)))
        .when(f == 2, F.array(assertion("object_highlighted", object_id=target)))
        .when(f == 3, F.array(assertion("objects_inside_polygon_highlighted")))
        .when(f == 7, F.array(assertion("objects_highlighted", object_type="camera")))
        .when(f == 8, F.array(assertion("artifact_removed", artifact_type="polyline")))
        .when(f == 9, F.array(assertion("clarification_requested")))
        .otherwise(none)
    )
    constraints = (
        F.when(f.isin(0, 4) & (d % 3 == 0), '{"time_range":"today"}')
        .when((f == 3) & (d % 4 == 3), '{"object_type":"camera"}')
        .when((f == 7) & (d % 4 == 3), '{"radius_meters":400}')
        .otherwise("{}")
    )
    entity = F.struct(target.alias("id"), F.col("kind").alias("type"), F.col("target_name").alias("name")).cast(schema.ENTITY)

    def slot_for(kind: str) -> Column:
        return _slot(F.when(selected_mode & (F.col("kind") == kind), entity))

    return documents(spark, sf_dir).select(
        "scenario_id",
        d.alias("bp_ord"),
        F.element_at(F.array(*[F.lit(x) for x in TASK_FAMILIES]), f + 1).alias("task_type"),
        F.concat(F.lit("L"), d % 6).alias("difficulty"),
        F.struct(
            F.when(selected_mode, "selected_object").otherwise("explicit_id").alias("reference_mode"),
            F.col("kind").alias("expected_type"),
            target.alias("object_id"),
        ).alias("target"),
        F.parse_json(constraints).alias("constraints"),
        F.array(F.concat(F.lit("resolve_"), F.col("kind")), F.lit("act")).alias("required_semantic_steps"),
        wanted.alias("expected_final_state"),
        (d % 11 == 0).alias("should_ask_clarification"),
        F.lit(False).alias("negative_case"),
        F.lit(None).cast("string").alias("negative_type"),
        F.struct(slot_for("vehicle").alias("object"), slot_for("line").alias("line"), slot_for("polygon").alias("polygon")).alias("selected"),
        F.lit(None).cast("array<string>").alias("active_layers"),
        F.lit(None).cast(f"array<{schema.ARTIFACT}>").alias("drawn_artifacts"),
        F.element_at(F.array(*[F.lit(x) for x in TASK_FAMILIES]), f + 1).alias("requested_family"),
        F.concat(F.lit("L"), d % 6).alias("requested_difficulty"),
    )


def utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One utterance per positive blueprint: the document's text. Negatives get placeholders."""
    return documents(spark, sf_dir).select(
        "scenario_id",
        F.col("doc_id").alias("bp_ord"),
        F.lit(0).alias("mutation"),
        F.lit(0).alias("utt_ord"),
        F.col("text").alias("utterance"),
    )


def samples(spark: SparkSession, sf_dir: str, with_negatives: bool = True) -> DataFrame:
    """Samples of all blueprints."""
    return written(configure(spark), sf_dir, f"samples {with_negatives}", lambda: _samples(spark, sf_dir, with_negatives))


def _samples(spark: SparkSession, sf_dir: str, with_negatives: bool = True) -> DataFrame:
    asked = blueprints(spark, sf_dir)
    negative = negatives.negative_cases(asked, objects(spark, sf_dir)) if with_negatives else None
    table = assemble.all_blueprints(traces.with_gold_trace(asked), negative)
    return assemble.assemble_samples(table, scenarios(spark, sf_dir), utterances(spark, sf_dir))


def _step(tool: str, **args: Column | str) -> Column:
    values = [(v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in args.items()]
    body = F.to_variant_object(F.struct(*values)) if values else F.parse_json(F.lit("{}"))
    return F.struct(F.lit(tool).alias("tool"), body.alias("args"))


def faulty_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written(configure(spark), sf_dir, "faulty samples", lambda: _faulty(spark, sf_dir, samples(spark, sf_dir)))


def faulty_traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What audits look at of the faulty samples. Texts are neither read nor written for it."""
    parts = ["id", "scenario_id", "sample_ord", "initial_state", "gold_trace", "expected"]
    return written(configure(spark), sf_dir, "faulty traces", lambda: _faulty(spark, sf_dir, _samples(spark, sf_dir).select(*parts)))


def _faulty(spark: SparkSession, sf_dir: str, base: DataFrame) -> DataFrame:
    """All samples; positive ones have further steps, many of them wrong, added by modulus of the blueprint."""
    named = documents(spark, sf_dir).select(
        "scenario_id", F.col("doc_id").alias("_d"), "family", "kind", "target_id", "target_name"
    )
    joined = base.withColumn("_d", F.col("sample_ord.blueprint")).join(named, ["scenario_id", "_d"])
    d, target, point = F.col("_d"), F.col("target_id"), F.array(F.lit(106.7), F.lit(10.8))
    positive = F.col("sample_ord.mutation") == 0
    scopes = F.array(*[F.lit(s) for s in ("all", "polylines", "highlights", "popups", "markers")])
    info = _step("get_object_info", object_id=target)
    by_name = _step("resolve_entity", reference="$get_object_info.name")

    def popup(content: str) -> Column:
        return _step("show_popup", target_id="$resolve_entity.entity", content=content)

    extra = {
        13: [_step("get_object_info", object_id="vehicle_missing")],
        17: [
            F.when(F.col("kind") == "polygon", _step("get_line_length", line_id=target)).otherwise(
                _step("get_polygon_area", polygon_id=target)
            )
        ],
        19: [_step("get_vehicle_trajectory", vehicle_id=target, time_range="last_year")],
        23: [_step("teleport")],
        29: [_step("draw_polyline", points="$get_line_length.points", label="x")],
        31: [_step("clear_artifacts", scope=F.element_at(scopes, (d % 5 + 1).cast("int")))],
        37: [_step("draw_marker", coordinates=point, label="m")],
        41: [_step("draw_marker", coordinates=point)],
        43: [_step("resolve_entity", reference=F.col("target_name")), popup("hi")],
        47: [_step("highlight_objects", object_ids=F.array(F.lit("vehicle_missing")))],
        53: [_step("clear_artifacts", scope="everything")],
        # Chains: what is resolved comes from a result, and so does what that was asked for.
        59: [info, by_name, popup("via")],
        61: [info, _step("resolve_entity", reference="$get_object_info.name", expected_type="camera"), popup("no")],
        67: [
            info,
            by_name,
            _step("get_object_info", object_id="$resolve_entity.entity"),
            _step("resolve_entity", reference="$get_object_info.id"),
            popup("deep"),
        ],
        71: [_step("get_current_map_state")],
    }
    empty = F.array().cast(schema.TRACE)
    parts = [F.when(positive & (d % m == 0), F.array(*steps)).otherwise(empty) for m, steps in extra.items()]
    # A list in a selection slot, with an object that is not there.
    entity = F.struct(target.alias("id"), F.col("kind").alias("type"), F.col("target_name").alias("name"))
    ghost = F.struct(F.lit("vehicle_missing").alias("id"), F.lit("vehicle").alias("type"), F.lit("none").alias("name"))
    two = F.struct(F.lit(True).alias("is_list"), F.array(entity, ghost).alias("ents")).cast(schema.SLOT)
    state = F.col("initial_state")
    odd = positive & (d % 29 == 1) & F.col("family").isin(5, 6)
    listed = state.withField("selected", state.selected.withField("object", two))
    return (
        joined.withColumn("gold_trace", F.concat("gold_trace", *parts))
        .withColumn("initial_state", F.when(odd, listed).otherwise(state))
        .select(*base.columns)
    )


def verdicts(spark: SparkSession, sf_dir: str, of: DataFrame) -> DataFrame:
    """Verdicts on samples from the labels of their documents; documents without one have none."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("_d"), (F.col("quality") == 1).alias("valid"))
    return of.select("id", F.col("sample_ord.blueprint").alias("_d")).join(labels, "_d").select("id", "valid")
