"""Checks of traces against the catalog, the templates and a sample's own policy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.catalog import TOOLS
from ..plans.traces import TEMPLATES


def tool_params_table(spark) -> DataFrame:
    """The catalog as rows (tool, category, param, type, required, enum), one per parameter."""
    rows = [
        (tool, t.category, p.name, p.type, p.required, p.enum)
        for tool, t in TOOLS.items()
        for p in t.params
    ]
    return spark.createDataFrame(
        rows, "tool string, category string, param string, type string, required boolean, enum array<string>"
    )


def policy_violations(samples: DataFrame, traces: DataFrame) -> DataFrame:
    """traces(id, tools) of an agent against what a sample forbids, allows and needs.

    A tool is allowed when the gold trace has it or it is listed as an extra; a tool of the
    gold trace the agent never called is missing unless it is such an extra.
    """
    gold = F.array_distinct(F.transform("gold_trace", lambda s: s.tool))
    extra = F.col("expected.allowed_extra_tools")
    joined = samples.select("id", "expected", gold.alias("_gold")).join(traces, "id")
    return joined.select(
        "id",
        F.array_sort(F.array_intersect("tools", "expected.forbidden_tools")).alias("forbidden"),
        F.array_sort(F.array_except(F.array_except("tools", "_gold"), extra)).alias("not_allowed"),
        F.array_sort(F.array_except(F.array_except("_gold", "tools"), extra)).alias("missing"),
    )


def argument_errors(samples: DataFrame, params: DataFrame) -> DataFrame:
    """(id, pos, tool, param, error) for arguments whose type or value the catalog rules out.

    References are not looked into; nulls stand for an argument left out. `params` has the
    catalog's few dozen rows.
    """
    kinds = params.select("tool", "param", F.col("type").alias("_type"), F.col("enum").alias("_enum"))
    steps = samples.select("id", F.posexplode("gold_trace").alias("pos", "s"))
    given = steps.select(
        "id", "pos", F.col("s.tool").alias("tool"), F.explode(F.try_variant_get("s.args", "$", "map<string,variant>")).alias("param", "_value")
    ).join(kinds, ["tool", "param"])
    actual = F.schema_of_variant("_value")
    text = F.try_variant_get("_value", "$", "string")
    is_reference = (actual == "STRING") & text.startswith(F.lit("$"))
    fits = (
        F.when(F.col("_type") == "string", actual == "STRING")
        .when(F.col("_type") == "array", actual.startswith(F.lit("ARRAY")))
        .when(F.col("_type") == "object", actual.startswith(F.lit("OBJECT")))
        .when(F.col("_type") == "number", actual.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"))
    )
    error = F.when(~fits, "wrong_type").when(
        F.col("_enum").isNotNull() & ~F.array_contains("_enum", text), "not_in_enum"
    )
    return (
        given.filter(~F.is_variant_null("_value") & ~is_reference)
        .withColumn("error", error)
        .filter(F.col("error").isNotNull())
        .select("id", "pos", "tool", "param", "error")
    )


def expected_tools(task_type: Column) -> Column:
    """Tools every trace of the task type has; null for types without a template."""
    tools = F.lit(None).cast("array<string>")
    for name, steps in TEMPLATES.items():
        always = F.array(*[F.lit(s.tool) for s in steps if not s.only_if_selected])
        tools = F.when(task_type == name, always).otherwise(tools)
    return tools


def task_tool_mismatches(samples: DataFrame) -> DataFrame:
    """(id, task_type, missing): traces lacking a tool their task type stands for."""
    tools = F.transform("gold_trace", lambda s: s.tool)
    missing = F.array_sort(F.array_except(expected_tools(F.col("task_type")), tools))
    return (
        samples.filter(F.size("gold_trace") > 0)
        .select("id", "task_type", missing.alias("missing"))
        .filter(F.size("missing") > 0)
    )
