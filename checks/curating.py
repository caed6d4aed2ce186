"""De-duplication, splits, review samples, metrics and quotas."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewright.functions import text
from tracewright.operators import dedup, gates, metrics, review, split

from . import fixtures as fx
from .oracle_views import SAMPLE_ID, and_views, with_views
from .verifying import _VIEWS, CASCADE, _verified

QUERIES = {}
ORACLES = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return register


NORMALIZED = (
    "trim(regexp_replace(regexp_replace(nfc_normalize(lower({t})), '[^\\p{{L}}\\p{{N}}_\\s\\x{{85}}\\x{{A0}}\\x{{2000}}-\\x{{200A}}\\x{{2028}}\\x{{2029}}\\x{{3000}}]', '', 'g'), "
    "'[\\s\\x{{85}}\\x{{A0}}\\x{{2000}}-\\x{{200A}}\\x{{2028}}\\x{{2029}}\\x{{3000}}]+', ' ', 'g'))"
)


def short(x: str) -> str:
    return f"substr(sha256({x}), 1, 16)"


_TOOLS = """CASE WHEN NOT traced THEN '' ELSE 'get_current_map_state|' || CASE family
    WHEN 0 THEN CASE WHEN sel THEN 'get_selected_entity|' ELSE '' END || 'get_vehicle_trajectory|draw_polyline'
    WHEN 1 THEN CASE WHEN sel THEN 'get_selected_entity|' ELSE '' END || 'get_object_info|show_popup'
    WHEN 2 THEN 'get_selected_entity|highlight_objects'
    WHEN 3 THEN CASE WHEN sel THEN 'get_selected_entity|' ELSE '' END || 'get_objects_inside_polygon|highlight_objects'
    WHEN 4 THEN 'get_objects_crossing_line' WHEN 5 THEN 'get_polygon_area' WHEN 6 THEN 'get_line_length'
    WHEN 7 THEN 'get_nearby_objects|highlight_objects' END END"""

_ONE = "CASE WHEN shown IS NULL OR contains(shown, ',') THEN '' ELSE shown END"
KEYED = {
    "keyed": f"""
  SELECT *, {SAMPLE_ID} AS id, row_number() OVER (ORDER BY world, stage, doc_id, mutation) AS rk,
         {short('user_request')} AS h1, {short(NORMALIZED.format(t='user_request'))} AS h2,
         {short(f"task_type || '|' || {_ONE} || '|' || used_range")} AS h3,
         {short(f"task_type || '|' || {_ONE} || '|' || used_range || '|' || scenario_id")} AS h3s,
         CASE WHEN traced THEN {short(f"scenario_id || '|' || {short(_TOOLS)} || '|' || {_ONE}")} ELSE CAST(rk AS VARCHAR) END AS h4
  FROM samples"""
}


def _levels(third: str) -> dict[str, str]:
    first = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY rk) AS rn{n} FROM {t}) WHERE rn{n} = 1"
    return {
        **KEYED,
        "k1": first.format(k="h1", t="keyed", n=1),
        "k2": first.format(k="h2", t="k1", n=2),
        "k3": first.format(k=third, t="k2", n=3),
        "k4": first.format(k="h4", t="k3", n=4),
    }


@query(
    "text_keys",
    with_views(
        "scenarios",
        f"""
SELECT doc_id, {short(NORMALIZED.format(t='text'))} AS norm_hash, {short('text')} AS text_hash,
       length({NORMALIZED.format(t='text')}) AS norm_length,
       CASE WHEN length(regexp_replace(text, '[^\\x00-\\x7F]', '', 'g')) / greatest(length(text), 1) > 0.9 THEN 'en' ELSE 'vi' END AS language,
       coalesce(TRY_CAST(regexp_extract(source, '[^_]*$') AS INTEGER), 0) AS number
FROM documents""",
    ),
)
def text_keys(spark, sf_dir):
    normal = text.normalize_text(F.col("text"))
    return fx.table(spark, sf_dir, "documents").select(
        "doc_id",
        text.short_hash(normal).alias("norm_hash"),
        text.short_hash(F.col("text")).alias("text_hash"),
        F.length(normal).alias("norm_length"),
        text.language_of(F.col("text")).alias("language"),
        text.scenario_number(F.col("source")).alias("number"),
    )


@query("dedup_kept", and_views("samples", _levels("h3"), "SELECT id, doc_id, mutation FROM k4"))
def dedup_kept(spark, sf_dir):
    return _plain(dedup.deduplicate(fx.samples(spark, sf_dir)))


def _plain(df):
    return df.select(
        "id", F.col("sample_ord.blueprint").alias("doc_id"), F.col("sample_ord.mutation").alias("mutation")
    )


@query("dedup_kept_per_scenario", and_views("samples", _levels("h3s"), "SELECT id, doc_id, mutation FROM k4"))
def dedup_kept_per_scenario(spark, sf_dir):
    return _plain(dedup.deduplicate(fx.samples(spark, sf_dir), scope="scenario"))


_COUNTS = """(SELECT count(*) FROM keyed) AS samples, (SELECT count(*) FROM keyed) - (SELECT count(*) FROM k1) AS exact,
       (SELECT count(*) FROM k1) - (SELECT count(*) FROM k2) AS norm, (SELECT count(*) FROM k2) - (SELECT count(*) FROM k3) AS composite,
       (SELECT count(*) FROM k3) - (SELECT count(*) FROM k4) AS trace, (SELECT count(*) FROM k4) AS kept"""


@query("dedup_stats", and_views("samples", _levels("h3"), f"SELECT {_COUNTS}"))
def dedup_stats(spark, sf_dir):
    return dedup.dedup_stats(fx.samples(spark, sf_dir))


_SPLIT = """CASE WHEN world < 1 OR world > n THEN NULL WHEN world <= CAST(floor(n * 0.8) AS INTEGER) THEN 'train'
            WHEN world <= CAST(floor(n * 0.8) AS INTEGER) + CAST(floor(n * 0.1) AS INTEGER) THEN 'dev'
            WHEN clarify OR difficulty = 'L5' THEN 'test_adversarial' WHEN difficulty IN ('L0', 'L1', 'L2') THEN 'test_easy' ELSE 'test_hard' END"""
SPLIT = {
    "split_samples": f"""
  SELECT *, {SAMPLE_ID} AS id, {_SPLIT} AS split FROM (SELECT *, (SELECT count(*) FROM nation) AS n FROM samples)"""
}


@query("split_assignment", and_views("samples", SPLIT, "SELECT id, scenario_id, split FROM split_samples WHERE split IS NOT NULL"))
def split_assignment(spark, sf_dir):
    assigned = split.assign_split(fx.samples(spark, sf_dir), fx.scenarios(spark, sf_dir))
    return assigned.select("id", "scenario_id", "split")


@query("split_counts", and_views("samples", SPLIT, "SELECT split, count(*) AS n FROM split_samples WHERE split IS NOT NULL GROUP BY split"))
def split_counts(spark, sf_dir):
    return split.split_counts(split.assign_split(fx.samples(spark, sf_dir), fx.scenarios(spark, sf_dir)))


@query(
    "split_ranges",
    """
SELECT r.split, CAST(r.first AS BIGINT) AS first, CAST(r.last AS BIGINT) AS last
FROM (SELECT count(*) AS n, CAST(floor(count(*) * 0.8) AS INTEGER) AS a, CAST(floor(count(*) * 0.1) AS INTEGER) AS b FROM nation) c,
     LATERAL (VALUES ('train', 1, a), ('dev', a + 1, a + b), ('test', a + b + 1, n)) r(split, first, last)""",
)
def split_ranges(spark, sf_dir):
    return split.split_ranges(fx.scenarios(spark, sf_dir))


@query(
    "split_leakage",
    and_views(
        "samples",
        SPLIT,
        f"""
SELECT key, string_agg(DISTINCT part, ',' ORDER BY part) AS splits, count(*) AS n
FROM (SELECT {short(NORMALIZED.format(t='user_request'))} AS key, regexp_extract(split, '^[^_]*') AS part FROM split_samples WHERE split IS NOT NULL)
GROUP BY key HAVING count(DISTINCT part) > 1""",
    ),
)
def split_leakage(spark, sf_dir):
    assigned = split.assign_split(fx.samples(spark, sf_dir), fx.scenarios(spark, sf_dir))
    key = text.short_hash(text.normalize_text(F.col("user_request")))
    return split.leakage(assigned, key).withColumn("splits", F.array_join("splits", ","))


_PRIORITY = "clarify OR difficulty IN ('L4', 'L5')"
REVIEW = {
    "flagged": f"SELECT *, {SAMPLE_ID} AS id, {_PRIORITY} AS priority FROM samples",
    "quota": """
  SELECT n_first, n_rest, target, least(n_first, greatest(target // 2, 1)) AS take_first
  FROM (SELECT count(*) FILTER (priority) AS n_first, count(*) FILTER (NOT priority) AS n_rest,
               greatest(1, CAST(floor(count(*) * 0.1) AS BIGINT)) AS target FROM flagged)""",
    "ranked": "SELECT *, row_number() OVER (PARTITION BY priority ORDER BY sha256(id || 'r1')) AS rn FROM flagged",
}


@query(
    "review_sample",
    and_views(
        "samples",
        REVIEW,
        """
SELECT id, task_type, difficulty, 'pending' AS review_status FROM ranked, quota
WHERE CASE WHEN priority THEN rn <= take_first ELSE rn <= least(n_rest, greatest(target - take_first, 0)) END""",
    ),
)
def review_sample(spark, sf_dir):
    picked = review.select_review_samples(fx.samples(spark, sf_dir), 0.1, "r1")
    return review.review_queue(picked).select("id", "task_type", "difficulty", "review_status")


@query("review_priority", and_views("samples", REVIEW, "SELECT id, priority FROM flagged"))
def review_priority(spark, sf_dir):
    return review.with_priority(fx.samples(spark, sf_dir)).select("id", "priority")


def _quota_sql(group: str, quotas: dict[str, int]) -> str:
    values = ", ".join(f"('{g}', {n})" for g, n in quotas.items())
    return f"""
SELECT id, g AS picked_for FROM (
  SELECT {SAMPLE_ID} AS id, {group} AS g, row_number() OVER (PARTITION BY {group} ORDER BY sha256({SAMPLE_ID} || 'q')) AS rn FROM samples)
JOIN (VALUES {values}) q(name, quota) ON q.name = g WHERE rn <= quota"""


@query("difficulty_quotas", with_views("samples", _quota_sql("difficulty", metrics.DIFFICULTY_QUOTAS)))
def difficulty_quotas(spark, sf_dir):
    picked = metrics.pick_by_difficulty(fx.samples(spark, sf_dir), seed="q")
    return picked.select("id", F.col("difficulty").alias("picked_for"))


_GROUP = "CASE WHEN task_type IN ('polygon_area', 'line_length') THEN 'polygon_area / line_length' ELSE task_type END"


@query(
    "task_mix",
    with_views("samples", _quota_sql(_GROUP, {k: 1000 * v // 100 for k, v in metrics.TASK_MIX.items()})),
)
def task_mix(spark, sf_dir):
    picked = metrics.pick_by_task_mix(fx.samples(spark, sf_dir), 1000, seed="q")
    return picked.select("id", metrics.task_group(F.col("task_type")).alias("picked_for"))


@query(
    "distributions",
    with_views(
        "samples",
        """
SELECT task_type, difficulty, language, count(*) AS n, CAST(grouping(task_type, difficulty, language) AS INTEGER) AS level
FROM (SELECT task_type, difficulty, CASE WHEN length(regexp_replace(user_request, '[^\\x00-\\x7F]', '', 'g')) / greatest(length(user_request), 1) > 0.9
             THEN 'en' ELSE 'vi' END AS language FROM samples)
GROUP BY ROLLUP (task_type, difficulty, language)""",
    ),
)
def distributions(spark, sf_dir):
    return metrics.distributions(fx.samples(spark, sf_dir))


_STAGE_COUNTS = ", ".join(f"count(*) FILTER ({g}) AS {g}" for g in gates.GATES)
_CASCADE_KEPT = {
    **CASCADE,
    "ok": f"""
  SELECT id, scenario_id, CAST(substr(scenario_id, 19) AS BIGINT) AS world, 0 AS stage, doc_id, 0 AS mutation, text, task_type,
         CASE WHEN sel THEN target_id ELSE '' END AS one,
         CASE WHEN NOT clarify AND family IN (0, 4) THEN coalesce(c_range, 'last_10_minutes') WHEN doc_id % 19 = 0 THEN 'last_year' ELSE '' END AS used_range,
         concat_ws('|', nullif({_TOOLS}, ''), CASE WHEN doc_id % 31 = 0 THEN 'clear_artifacts' END, CASE WHEN doc_id % 37 = 0 THEN 'draw_marker' END,
            CASE WHEN doc_id % 43 = 0 THEN 'resolve_entity|show_popup' END, CASE WHEN doc_id % 59 = 0 THEN 'get_object_info|resolve_entity|show_popup' END,
            CASE WHEN doc_id % 67 = 0 THEN 'get_object_info|resolve_entity|get_object_info|resolve_entity|show_popup' END,
            CASE WHEN doc_id % 71 = 0 THEN 'get_current_map_state' END) AS tool_list
  FROM (SELECT *, NOT clarify AND family < 8 AS traced FROM gated WHERE semantic_pass)
  UNION ALL
  SELECT {SAMPLE_ID}, scenario_id, CAST(substr(scenario_id, 19) AS BIGINT), 1, doc_id, mutation, '[auto] ' || task_type || ' task', task_type, {_ONE}, '', ''
  FROM negs JOIN labels USING (doc_id) WHERE quality = 1""",
    "tools": "SELECT *, row_number() OVER (ORDER BY world, stage, doc_id, mutation) AS rk FROM ok",
    "n1": f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {NORMALIZED.format(t='text')} ORDER BY rk) AS r1 FROM tools) WHERE r1 = 1",
    "n2": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY task_type, one, used_range ORDER BY rk) AS r2 FROM n1) WHERE r2 = 1",
    "n3": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY CASE WHEN tool_list = '' THEN id ELSE scenario_id || '|' || tool_list || '|' || one END ORDER BY rk) AS r3 FROM n2) WHERE r3 = 1",
    "funnel": f"SELECT count(*) AS candidates, {_STAGE_COUNTS}, (SELECT count(*) FROM n3) AS after_dedup, (SELECT count(*) FROM n3) AS final FROM gated_all",
}


@query(
    "funnel_report",
    and_views(
        _VIEWS,
        _CASCADE_KEPT,
        "\nUNION ALL ".join(
            f"SELECT {i} AS step, '{s}' AS stage, {s} AS n, round({s} * 100 / greatest(candidates, 1), 1) AS percent FROM funnel"
            for i, s in enumerate(metrics.STAGES)
        ),
    ),
)
def funnel_report(spark, sf_dir):
    gated = fx.materialize(_verified(spark, sf_dir))
    kept = dedup.deduplicate(gates.verified(gated))
    return metrics.funnel_report(metrics.funnel(gated, kept))


@query(
    "quality_metrics",
    and_views(
        "samples",
        _levels("h3"),
        """
SELECT round(avg(CASE WHEN NOT traced THEN 0 WHEN family = 0 THEN 3 + s WHEN family = 1 THEN 3 + s WHEN family = 2 THEN 3
                      WHEN family = 3 THEN 3 + s WHEN family = 7 THEN 3 ELSE 2 END), 6) AS mean_steps,
       count(*) FILTER (mutation > 0) AS negatives, CAST(100 AS DOUBLE) AS negative_correct_pct,
       round(count(*) FILTER (doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)) * 100 / count(*), 6) AS acceptance_pct,
       round((count(*) - (SELECT count(*) FROM k4)) * 100 / count(*), 6) AS duplicate_pct
FROM (SELECT *, CAST(sel AS INTEGER) AS s FROM keyed)""",
    ),
)
def quality_metrics(spark, sf_dir):
    """Samples whose documents have a good label count as accepted."""
    s = fx.samples(spark, sf_dir)
    judged = s.join(fx.verdicts(spark, sf_dir, s), "id", "left").withColumn("semantic_pass", F.coalesce("valid", F.lit(False)))
    return metrics.quality_metrics(judged, dedup.dedup_stats(s))


@query(
    "human_pass_rate",
    """
SELECT count(*) AS reviewed, round(count(*) FILTER (toxic = 0) * 100 / greatest(count(*), 1), 6) AS pass_pct
FROM labels WHERE doc_id % 4 <> 0""",
)
def human_pass_rate(spark, sf_dir):
    """Labels as reviews: toxic documents fail, every fourth is still pending."""
    status = F.when(F.col("doc_id") % 4 == 0, "pending").when(F.col("toxic") == 0, "pass").otherwise("fail")
    reviews = fx.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), status.alias("review_status"))
    return metrics.human_pass_rate(reviews)
