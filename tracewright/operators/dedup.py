"""First-wins removal of duplicate samples on four levels.

Each level looks only at what the level before kept, so level k is "the first sample per key
among the survivors of level k-1". Every level is one aggregation of narrow rows; partial
aggregation takes up keys shared by a large part of the data before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalize_text, trace_structure


def dedup_keys(samples: DataFrame, scope: str = "global") -> DataFrame:
    """Narrow rows (sample_ord, id, exact, norm, composite, trace) of hashed keys.

    Keys are whole SHA-256 values: with 64 bits, different samples would meet at a few billion.

    `scope="scenario"` adds the scenario to the composite key; by default the same task on the
    same target id counts as a duplicate in whatever scenario it is asked.
    """
    slots = [F.col(f"initial_state.selected.{s}") for s in ("object", "line", "polygon")]
    target = F.coalesce(*[F.when(~s.is_list, F.coalesce(s.ents[0].id, F.lit(""))) for s in slots], F.lit(""))
    ranges = F.transform("gold_trace", lambda s: F.try_variant_get(s.args, "$.time_range", "string"))
    time_range = F.coalesce(F.try_element_at(F.filter(ranges, lambda r: r != ""), F.lit(1)), F.lit(""))
    parts = [F.col("task_type"), target, time_range]
    if scope == "scenario":
        parts.append(F.col("scenario_id"))
    structure = F.sha2(trace_structure(F.col("gold_trace")), 256)
    return samples.select(
        "sample_ord",
        "id",
        F.sha2(F.col("user_request"), 256).alias("exact"),
        F.sha2(normalize_text(F.col("user_request")), 256).alias("norm"),
        F.sha2(F.concat_ws("|", *parts), 256).alias("composite"),
        F.when(
            F.size("gold_trace") > 0, F.sha2(F.concat_ws("|", "scenario_id", structure, target), 256)
        ).alias("trace"),
    )


def _first_per(rows: DataFrame, key: str, counters: list[str], survivors: str) -> DataFrame:
    """The first row per key, with the sums of earlier counters and the number of rows met."""
    rest = [c for c in rows.columns if c not in (key, "sample_ord", *counters)]
    return (
        rows.groupBy(key)
        .agg(
            F.min(F.struct("sample_ord", *rest)).alias("_first"),
            *[F.sum(c).alias(c) for c in counters],
            F.count(F.lit(1)).alias(survivors),
        )
        .select("_first.*", *counters, survivors)
    )


def _own_key_if_missing(rows: DataFrame) -> DataFrame:
    # A sample with an empty trace has no key on level 4 and always passes.
    return rows.withColumn("trace", F.coalesce("trace", "id"))


def deduplicate(samples: DataFrame, scope: str = "global") -> DataFrame:
    """The samples that survive all levels.

    Equal texts are equal after normalisation, so level 1 changes nothing in the kept set.
    """
    rows = dedup_keys(samples, scope).drop("exact")
    rows = _first_per(rows, "norm", [], "_n1").drop("_n1")
    rows = _first_per(rows, "composite", [], "_n2").drop("_n2")
    kept = _first_per(_own_key_if_missing(rows), "trace", [], "_n3")
    return samples.join(kept.select("id"), "id", "left_semi").select(*samples.columns)


def dedup_stats(samples: DataFrame, scope: str = "global") -> DataFrame:
    """One row: samples in, removed per level, kept. Counts travel along the levels."""
    rows = _first_per(dedup_keys(samples, scope), "exact", [], "_all")
    rows = _first_per(rows, "norm", ["_all"], "_exact")
    rows = _first_per(rows, "composite", ["_all", "_exact"], "_norm")
    rows = _first_per(_own_key_if_missing(rows), "trace", ["_all", "_exact", "_norm"], "_composite")
    left = [F.coalesce(F.sum(c), F.lit(0)) for c in ("_all", "_exact", "_norm", "_composite")]
    left.append(F.count(F.lit(1)))
    removed = [
        (a - b).alias(name) for a, b, name in zip(left, left[1:], ["exact", "norm", "composite", "trace"])
    ]
    return rows.agg(left[0].alias("samples"), *removed, left[-1].alias("kept"))
