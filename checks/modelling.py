"""Model requests and responses, conversations, readers and writers, synthetic worlds."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewright.operators import assemble, gates, ingest, multiturn, requests, split
from tracewright.plans import traces
from tracewright.session import materialize, scratch_dir
from tracewright.sources import scenarios as docs
from tracewright.sources import sinks, tables, worlds

from . import fixtures as fx
from .oracle_views import SAMPLE_ID, and_views, hex_number, pad, scenario, with_views

QUERIES = {}
ORACLES = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return register


def _wrapped(form, payload):
    """A payload as a model might send it: bare, fenced, in an unclosed fence, or not at all."""
    return (
        F.when(form == 0, F.concat(F.lit("  "), payload, F.lit("\n")))
        .when(form == 1, F.concat(F.lit("Here it is:\n```json\n"), payload, F.lit("\n```\nDone.")))
        .when(form == 2, F.concat(F.lit("```\n"), payload, F.lit("\n```")))
        .when(form == 3, F.concat(F.lit("```json\n"), payload))
        .when(form == 4, F.concat(payload, F.lit(" trailing")))
        .otherwise("no idea")
    )


def _wrapped_sql(form: str, payload: str) -> str:
    return f"""CASE {form} WHEN 0 THEN '  ' || {payload} || chr(10) WHEN 1 THEN 'Here it is:' || chr(10) || '```json' || chr(10) || {payload} || chr(10) || '```' || chr(10) || 'Done.'
         WHEN 2 THEN '```' || chr(10) || {payload} || chr(10) || '```' WHEN 3 THEN '```json' || chr(10) || {payload} WHEN 4 THEN {payload} || ' trailing' ELSE 'no idea' END"""


def _parsed_sql(t: str) -> str:
    """JSON text of a response, null when there is none."""
    inner = f"trim(CASE WHEN contains({t}, '```json') THEN regexp_extract({t}, '(?s)```json(.*?)```', 1) ELSE regexp_extract({t}, '(?s)```(.*?)```', 1) END, ' ' || chr(10))"
    whole = f"trim({t}, ' ' || chr(10))"
    return f"CASE WHEN json_valid({whole}) THEN {whole} WHEN json_valid({inner}) THEN {inner} END"


def _responses(df, kind, payload, request_id):
    """Up to four attempts per document; the fourth is one too many."""
    d = F.col("doc_id")
    attempts = F.when(d % 3 == 0, F.array(F.lit(1), F.lit(2), F.lit(4))).otherwise(F.array(F.lit(1), F.lit(4)))
    form = F.when(F.col("attempt") == 1, d % 6).when(F.col("attempt") == 2, F.lit(2)).otherwise(F.lit(0))
    return df.select("*", F.explode(attempts).alias("attempt")).select(
        request_id.alias("request_id"), F.lit(kind).alias("kind"), "attempt", _wrapped(form, payload).alias("text")
    )


def _responses_sql(payload: str, source: str) -> dict[str, str]:
    return {
        "attempts": f"SELECT *, unnest(CASE WHEN doc_id % 3 = 0 THEN [1, 2, 4] ELSE [1, 4] END) AS attempt FROM {source}",
        "answers": f"""
  SELECT doc_id, attempt, {_wrapped_sql('CASE attempt WHEN 1 THEN doc_id % 6 WHEN 2 THEN 2 ELSE 0 END', payload)} AS t FROM attempts""",
        "parsed": f"""
  SELECT doc_id, min(attempt) AS attempt, arg_min(v, attempt) AS v FROM (SELECT *, {_parsed_sql('t')} AS v FROM answers)
  WHERE attempt <= 3 AND v IS NOT NULL GROUP BY doc_id""",
    }


def _said(spark, sf_dir):
    df = fx.table(spark, sf_dir, "documents").select("doc_id", "text")
    body = F.concat(
        F.lit('{"utterances":['), F.to_json(F.col("text").cast("variant")), F.lit(', " ", 7, "xe '), F.col("doc_id"), F.lit('"]}')
    )
    payload = F.when(F.col("doc_id") % 7 == 0, '{"utterances":"none"}').otherwise(body)
    return _responses(df, "utterance", payload, F.col("doc_id").cast("string"))


_SAID = _responses_sql(
    """CASE WHEN doc_id % 7 = 0 THEN '{"utterances":"none"}' ELSE '{"utterances":[' || to_json(text) || ', " ", 7, "xe ' || doc_id || '"]}' END""",
    "documents",
)


@query(
    "first_parsed_answers",
    and_views("scenarios", _SAID, "SELECT CAST(doc_id AS VARCHAR) AS request_id, attempt FROM parsed"),
)
def first_parsed_answers(spark, sf_dir):
    return ingest.first_parsed(_said(spark, sf_dir), "utterance").select("request_id", "attempt")


@query(
    "utterances",
    and_views(
        "scenarios",
        _SAID,
        """
SELECT CAST(doc_id AS VARCHAR) AS request_id, utt_ord, substr(sha256(utterance), 1, 16) AS utterance_hash
FROM (SELECT doc_id, unnest([0, 1]) AS utt_ord, unnest([v ->> '$.utterances[0]', v ->> '$.utterances[3]']) AS utterance
      FROM parsed WHERE doc_id % 7 <> 0)""",
    ),
)
def utterances(spark, sf_dir):
    said = ingest.utterances(ingest.first_parsed(_said(spark, sf_dir), "utterance"))
    return said.select("request_id", "utt_ord", F.substring(F.sha2("utterance", 256), 1, 16).alias("utterance_hash"))


@query(
    "verdicts",
    and_views(
        "scenarios",
        _responses_sql(
            """CASE doc_id % 4 WHEN 0 THEN '{"valid":' || (quality = 1) || ',"issues":["a","b"]}' WHEN 1 THEN '{"valid":' || (quality = 1) || ',"issues":"odd"}'
               WHEN 2 THEN '{"valid":' || (quality = 1) || '}' ELSE '{"issues":[]}' END""",
            "labels",
        ),
        """
SELECT CAST(l.doc_id AS VARCHAR) AS id, v IS NOT NULL AND l.doc_id % 4 <> 3 AND quality = 1 AS valid,
       CASE WHEN v IS NULL THEN 'no readable verdict' WHEN l.doc_id % 4 = 0 THEN 'a,b' WHEN l.doc_id % 4 = 1 THEN 'odd' ELSE '' END AS issues
FROM labels l LEFT JOIN parsed p ON p.doc_id = l.doc_id""",
    ),
)
def verdicts(spark, sf_dir):
    labels = fx.table(spark, sf_dir, "labels")
    d, valid = F.col("doc_id"), (F.col("quality") == 1).cast("string")
    head = F.concat(F.lit('{"valid":'), valid)
    payload = (
        F.when(d % 4 == 0, F.concat(head, F.lit(',"issues":["a","b"]}')))
        .when(d % 4 == 1, F.concat(head, F.lit(',"issues":"odd"}')))
        .when(d % 4 == 2, F.concat(head, F.lit("}")))
        .otherwise('{"issues":[]}')
    )
    answers = _responses(labels, "verdict", payload, d.cast("string"))
    asked = labels.select(d.cast("string").alias("id"), d.cast("string").alias("request_id"))
    found = ingest.verdicts(asked, ingest.first_parsed(answers, "verdict"))
    return found.withColumn("issues", F.array_join("issues", ","))


_STEP = """'[{"tool":"get_object_info","args":{"object_id":"vehicle_' || doc_id || '"}},{"tool":"clear_artifacts"}]'"""


@query(
    "written_plans",
    and_views(
        "scenarios",
        _responses_sql(
            f"""CASE doc_id % 5 WHEN 0 THEN {_STEP} WHEN 1 THEN '{{"trace":' || {_STEP} || '}}' WHEN 2 THEN '{{"steps":' || {_STEP} || '}}'
                WHEN 3 THEN '{{"plan":[]}}' ELSE '{{"trace":[],"steps":' || {_STEP} || '}}' END""",
            "documents",
        ),
        """
SELECT CAST(doc_id AS VARCHAR) AS request_id, CASE WHEN doc_id % 5 IN (0, 1, 2) THEN 2 ELSE 0 END AS n_steps,
       CASE WHEN doc_id % 5 IN (0, 1, 2) THEN 'get_object_info,clear_artifacts' ELSE '' END AS tools,
       CASE WHEN doc_id % 5 IN (0, 1, 2) THEN 'vehicle_' || doc_id END AS object_id
FROM parsed""",
    ),
)
def written_plans(spark, sf_dir):
    d = F.col("doc_id")
    steps = F.concat(
        F.lit('[{"tool":"get_object_info","args":{"object_id":"vehicle_'), d, F.lit('"}},{"tool":"clear_artifacts"}]')
    )
    payload = (
        F.when(d % 5 == 0, steps)
        .when(d % 5 == 1, F.concat(F.lit('{"trace":'), steps, F.lit("}")))
        .when(d % 5 == 2, F.concat(F.lit('{"steps":'), steps, F.lit("}")))
        .when(d % 5 == 3, '{"plan":[]}')
        .otherwise(F.concat(F.lit('{"trace":[],"steps":'), steps, F.lit("}")))
    )
    answers = _responses(fx.table(spark, sf_dir, "documents").select("doc_id"), "plan", payload, d.cast("string"))
    plans = ingest.plan_steps(ingest.first_parsed(answers, "plan"))
    return plans.select(
        "request_id",
        F.size("trace").alias("n_steps"),
        F.array_join(F.transform("trace", lambda s: s.tool), ",").alias("tools"),
        F.try_variant_get(F.get("trace", F.lit(0)).args, "$.object_id", "string").alias("object_id"),
    )


def _asking_scenarios(spark, sf_dir):
    """One scenario to ask for per supplier."""
    return fx.table(spark, sf_dir, "supplier").select(fx.scenario_id(F.col("s_suppkey")).alias("scenario_id"))


_FAMILY_LIST = "[" + ", ".join(f"'{f}'" for f in fx.TASK_FAMILIES) + "]"
ITEMS = {
    "items": f"""
  SELECT *, 'blueprint|' || k AS request_id,
         list_extract({_FAMILY_LIST}, CAST({hex_number("sha256(k || '|family')", 15)} % 10 AS INTEGER) + 1) AS family,
         'L' || ({hex_number("sha256(k || '|difficulty')", 15)} % 6) AS difficulty
  FROM (SELECT *, scenario_id || '|' || bp_ord AS k FROM (
    SELECT {scenario('s_suppkey')} AS scenario_id, s_suppkey, unnest(range(1, 11)) AS bp_ord FROM supplier))""",
}


@query("work_items", and_views("scenarios", ITEMS, "SELECT request_id, scenario_id, bp_ord, family, difficulty FROM items"))
def work_items(spark, sf_dir):
    return ingest.work_items(_asking_scenarios(spark, sf_dir))


def _answers_to_items(items):
    b = F.col("bp_ord")
    body = F.concat(
        F.lit('{"task_type":"'), F.col("family"), F.lit('","difficulty":"L3","target":{"reference_mode":"explicit_id","expected_type":"vehicle",'),
        F.lit('"object_id":"vehicle_'), b, F.lit('"},"constraints":{"time_range":"today"},"expected_final_state":[{"type":"popup_shown","target_id":"x"}],'),
        F.lit('"negative_case":'), (b % 5 == 0).cast("string"),
        F.lit(',"initial_state":{"selected":{"object":{"id":"v1","type":"vehicle"},"line":[{"id":"a","type":"line"},{"id":"b","type":"line"}],"polygon":null}}}'),
    )
    text = F.when(b % 4 == 0, "sorry").when(b % 7 == 0, "[1, 2]").otherwise(body)
    return items.select("request_id", F.lit("blueprint").alias("kind"), F.lit(1).alias("attempt"), text.alias("text"))


@query(
    "answered_blueprints",
    and_views(
        "scenarios",
        ITEMS,
        """
SELECT scenario_id, bp_ord, family AS task_type, 'L3' AS difficulty, 'vehicle_' || bp_ord AS object_id, 'today' AS time_range, 'popup_shown' AS asserted,
       bp_ord % 5 = 0 AS negative_case, family AS requested_family, difficulty AS requested_difficulty, 'v1' AS object_slot, 'a,b' AS line_slot, true AS line_is_list,
       true AS polygon_empty
FROM items WHERE bp_ord % 4 <> 0 AND bp_ord % 7 <> 0""",
    ),
)
def answered_blueprints(spark, sf_dir):
    items = ingest.work_items(_asking_scenarios(spark, sf_dir))
    parsed = ingest.first_parsed(_answers_to_items(items), "blueprint")
    found = ingest.blueprints(items, parsed)
    ids = lambda slot: F.array_join(F.transform(f"selected.{slot}.ents", lambda e: e.id), ",")
    return found.select(
        "scenario_id",
        "bp_ord",
        "task_type",
        "difficulty",
        F.col("target.object_id").alias("object_id"),
        F.try_variant_get("constraints", "$.time_range", "string").alias("time_range"),
        F.get("expected_final_state", F.lit(0)).type.alias("asserted"),
        "negative_case",
        "requested_family",
        "requested_difficulty",
        ids("object").alias("object_slot"),
        ids("line").alias("line_slot"),
        F.col("selected.line.is_list").alias("line_is_list"),
        F.col("selected.polygon").isNull().alias("polygon_empty"),
    )


@query(
    "rejected_answers",
    and_views(
        "scenarios",
        ITEMS,
        "SELECT request_id, CASE WHEN bp_ord % 4 = 0 THEN 'no_json' ELSE 'not_an_object' END AS reason FROM items WHERE bp_ord % 4 = 0 OR bp_ord % 7 = 0",
    ),
)
def rejected_answers(spark, sf_dir):
    items = ingest.work_items(_asking_scenarios(spark, sf_dir))
    return ingest.rejected_answers(items, ingest.first_parsed(_answers_to_items(items), "blueprint"))


@query(
    "adversarial_cases",
    f"""
SELECT scenario_id, bp_ord, 5 AS mutation, 'tool_confusion' AS negative_type, true AS asks_back, 'clarification_requested' AS asserted
FROM (SELECT {scenario('s_suppkey')} AS scenario_id, unnest([1, 2, 3]) AS bp_ord FROM supplier) WHERE bp_ord <> 2""",
)
def adversarial_cases(spark, sf_dir):
    items = ingest.adversarial_items(_asking_scenarios(spark, sf_dir))
    text = F.when(F.col("bp_ord") == 2, "no").otherwise('{"task_type":"t","difficulty":"L5","_negative_type":"tool_confusion"}')
    answers = items.select("request_id", F.lit("adversarial").alias("kind"), F.lit(1).alias("attempt"), text.alias("text"))
    cases = ingest.adversarial_blueprints(items, ingest.first_parsed(answers, "adversarial"))
    return cases.select(
        "scenario_id",
        "bp_ord",
        "mutation",
        "negative_type",
        (F.col("negative_case") & F.col("should_ask_clarification")).alias("asks_back"),
        F.get("expected_final_state", F.lit(0)).type.alias("asserted"),
    )


_FIRST = {
    "shown": """
  SELECT scenario_id, type, string_agg(id, ',' ORDER BY ord) AS ids
  FROM (SELECT *, row_number() OVER (PARTITION BY scenario_id, type ORDER BY ord) AS rk FROM objects)
  WHERE rk <= CASE WHEN type IN ('vehicle', 'camera') THEN 5 ELSE 3 END GROUP BY scenario_id, type"""
}


@query(
    "compact_scenarios",
    and_views(
        "scenarios objects",
        _FIRST,
        """
SELECT s.scenario_id, '2024-01-30T23:30:00Z' AS time, coalesce(v.ids, '') AS vehicles, coalesce(c.ids, '') AS cameras,
       coalesce(z.ids, '') AS polygons, coalesce(r.ids, '') AS lines
FROM scenarios s LEFT JOIN shown v ON v.scenario_id = s.scenario_id AND v.type = 'vehicle'
LEFT JOIN shown c ON c.scenario_id = s.scenario_id AND c.type = 'camera'
LEFT JOIN shown z ON z.scenario_id = s.scenario_id AND z.type = 'polygon'
LEFT JOIN shown r ON r.scenario_id = s.scenario_id AND r.type = 'line'""",
    ),
)
def compact_scenarios(spark, sf_dir):
    found = requests.compact_scenarios(fx.scenarios(spark, sf_dir), fx.objects(spark, sf_dir))
    doc = F.parse_json("compact")
    ids = lambda c: F.array_join(
        F.transform(
            F.try_variant_get(doc, f"$.objects.{c}", "array<variant>"), lambda o: F.try_variant_get(o, "$.id", "string")
        ),
        ",",
    ).alias(c)
    return found.select(
        "scenario_id",
        F.try_variant_get(doc, "$.time", "string").alias("time"),
        *[ids(c) for c in ("vehicles", "cameras", "polygons", "lines")],
    )


@query(
    "blueprint_requests",
    and_views(
        "scenarios",
        ITEMS,
        "SELECT request_id, scenario_id, true AS has_family, true AS has_difficulty, true AS has_scenario, true AS has_tools FROM items",
    ),
)
def blueprint_requests(spark, sf_dir):
    worlds_ = _asking_scenarios(spark, sf_dir).withColumn("time", F.lit("2024-01-30 23:30:00").cast("timestamp"))
    compact = requests.compact_scenarios(worlds_, fx.objects(spark, sf_dir))
    asked = requests.blueprint_requests(ingest.work_items(worlds_), compact)
    has = lambda *parts: F.contains(F.col("text"), F.concat(*parts))
    return asked.select(
        "request_id",
        "scenario_id",
        has(F.lit("Task family: "), "family", F.lit("\n")).alias("has_family"),
        has(F.lit("Difficulty: "), "difficulty", F.lit(" - ")).alias("has_difficulty"),
        has(F.lit('"scenario_id":"'), "scenario_id", F.lit('"')).alias("has_scenario"),
        has(F.lit('"clear_artifacts"]')).alias("has_tools"),
    )


def _after(marker):
    """The JSON that follows a marker up to the end of its line."""
    return F.parse_json(F.regexp_extract("text", f"{marker}: (.*)", 1))


@query(
    "utterance_requests",
    with_views(
        "bps",
        "SELECT 'utterance|' || scenario_id || '|' || doc_id || '|0' AS request_id, task_type, difficulty, target_id AS object_id, clarify AS asks_back, 6 AS n_fields FROM bps",
    ),
)
def utterance_requests(spark, sf_dir):
    asked = requests.utterance_requests(fx.blueprints(spark, sf_dir).withColumn("mutation", F.lit(0)))
    doc = _after("Task")
    get = lambda path, kind="string": F.try_variant_get(doc, path, kind)
    return asked.select(
        "request_id",
        get("$.task_type").alias("task_type"),
        get("$.difficulty").alias("difficulty"),
        get("$.target.object_id").alias("object_id"),
        get("$.should_ask_clarification", "boolean").alias("asks_back"),
        F.size(F.try_variant_get(doc, "$", "map<string,variant>")).alias("n_fields"),
    )


@query(
    "verifier_requests",
    with_views(
        "samples",
        f"SELECT 'verdict|' || {SAMPLE_ID} AS request_id, substr(sha256(user_request), 1, 16) AS request_hash, task_type, 8 AS n_fields FROM samples",
    ),
)
def verifier_requests(spark, sf_dir):
    asked = requests.verifier_requests(fx.samples(spark, sf_dir))
    doc = _after("Sample")
    return asked.select(
        "request_id",
        F.substring(F.sha2(F.try_variant_get(doc, "$.user_request", "string"), 256), 1, 16).alias("request_hash"),
        F.try_variant_get(doc, "$.task_type", "string").alias("task_type"),
        F.size(F.try_variant_get(doc, "$", "map<string,variant>")).alias("n_fields"),
    )


@query(
    "adversarial_requests",
    with_views(
        "scenarios objects",
        """
SELECT 'adversarial|' || s.scenario_id || '|' || n AS request_id, ids FROM scenarios s CROSS JOIN (VALUES (1), (2), (3)) t(n)
LEFT JOIN (SELECT scenario_id, string_agg(id, ',' ORDER BY ord) AS ids
           FROM (SELECT *, row_number() OVER (PARTITION BY scenario_id ORDER BY ord) AS rk FROM objects) WHERE rk <= 15 GROUP BY scenario_id) o
ON o.scenario_id = s.scenario_id""",
    ),
)
def adversarial_requests(spark, sf_dir):
    items = ingest.adversarial_items(fx.scenarios(spark, sf_dir))
    asked = requests.adversarial_requests(items, fx.objects(spark, sf_dir))
    ids = F.try_variant_get(_after("Some object ids"), "$", "array<string>")
    return asked.select("request_id", F.array_join(ids, ",").alias("ids"))


@query(
    "plan_requests",
    with_views(
        "bps objects",
        """
SELECT 'plan|' || b.scenario_id || '|' || doc_id AS request_id, task_type, (o.n + 49) // 50 AS parts, o.n AS listed_ids, o.ids AS ids_sha256
FROM bps b JOIN (SELECT scenario_id, count(*) AS n, sha256(string_agg(id, ',' ORDER BY ord)) AS ids FROM objects GROUP BY scenario_id) o
     ON o.scenario_id = b.scenario_id
WHERE family >= 8""",
    ),
)
def plan_requests(spark, sf_dir):
    """Requests with all ids of their scenarios, 50 a page, the pages of each scenario put together again."""
    bps = fx.blueprints(spark, sf_dir).filter(~F.col("task_type").isin(list(traces.TEMPLATES)))
    asked = requests.plan_requests(bps).select(
        "request_id", "scenario_id", F.try_variant_get(_after("Blueprint"), "$.task_type", "string").alias("task_type")
    )
    pages = requests.plan_pages(bps, fx.objects(spark, sf_dir), page_size=50)
    ids = F.from_json(F.regexp_extract("text", "Ids, page [0-9]+: (.*)", 1), "array<string>")
    whole = pages.select("scenario_id", "page", ids.alias("ids")).groupBy("scenario_id").agg(
        F.count(F.lit(1)).alias("parts"),
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("page", "ids"))), lambda x: x.ids)).alias("ids"),
    )
    listed, digest = F.size("ids").cast("bigint").alias("listed_ids"), F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256")
    listing = materialize(whole.select("scenario_id", "parts", listed, digest))
    return asked.join(listing, "scenario_id").select("request_id", "task_type", "parts", "listed_ids", "ids_sha256")


@query(
    "multi_turn_samples",
    """
SELECT conv_id AS id, string_agg(CAST(turn AS VARCHAR), ',' ORDER BY turn) AS numbers, count(*) AS n_turns, string_agg(substr(sha256(text), 1, 8), ',' ORDER BY turn) AS turn_hashes
FROM conversations WHERE role = 'user' GROUP BY conv_id""",
)
def multi_turn_samples(spark, sf_dir):
    turns = fx.table(spark, sf_dir, "conversations").filter(F.col("role") == "user")
    steps = F.array().cast("array<string>").alias("expected_steps")
    nested = multiturn.nest_turns(turns.select(F.col("conv_id").alias("id"), "turn", F.col("text").alias("user"), steps))
    hashes = F.transform("turns", lambda t: F.substring(F.sha2(t.user, 256), 1, 8))
    numbers = F.array_join(F.transform("turns", lambda t: t.turn.cast("string")), ",")
    return nested.select("id", numbers.alias("numbers"), F.size("turns").alias("n_turns"), F.array_join(hashes, ",").alias("turn_hashes"))


@query(
    "scenario_round_trip",
    with_views(
        "scenarios vehicles cameras zones roads traj",
        """
SELECT scenario_id, id, rank * 1000000000000000000 + row_number() OVER (PARTITION BY scenario_id, rank ORDER BY ord) - 1 AS at, round(x, 6) AS x
FROM (SELECT scenario_id, id, ord, 0 AS rank, lon AS x FROM vehicles UNION ALL SELECT scenario_id, id, ord, 1, lon FROM cameras
      UNION ALL SELECT scenario_id, id, ord, 2, x0 FROM zones UNION ALL SELECT scenario_id, id, ord, 3, x0 FROM roads)
UNION ALL
SELECT scenario_id, object_id, pos - 1, round(lon, 6) FROM traj""",
    ),
)
def scenario_round_trip(spark, sf_dir):
    """Tables to documents, several to a scenario, documents to files, files to tables."""
    out = scratch_dir(spark)
    made = docs.to_documents(
        fx.scenarios(spark, sf_dir), fx.objects(spark, sf_dir), fx.traj(spark, sf_dir), rows_per_part=50
    )
    docs.write_documents(made, out)
    read = docs.read_documents(spark, out, one_per_file=False)
    x = F.coalesce(F.col("geom.pt")[0], F.get(F.col("geom.path"), F.lit(0))[0], F.col("geom.rings")[0][0][0])
    objects = docs.object_table(read).select("scenario_id", "id", F.col("ord").alias("at"), F.round(x, 6).alias("x"))
    points = docs.trajectory_table(read)
    return objects.unionByName(points.select("scenario_id", F.col("object_id").alias("id"), F.col("pos").alias("at"), F.round("lon", 6).alias("x")))


@query(
    "dataset_export",
    with_views(
        "samples",
        f"""
SELECT id, split, substr(sha256(user_request), 1, 16) AS request_hash, true AS no_private_columns FROM (
  SELECT {SAMPLE_ID} AS id, user_request,
         CASE WHEN world <= CAST(floor(n * 0.8) AS INTEGER) THEN 'train' WHEN world <= CAST(floor(n * 0.8) AS INTEGER) + CAST(floor(n * 0.1) AS INTEGER) THEN 'dev'
              WHEN clarify OR difficulty = 'L5' THEN 'test_adversarial' WHEN difficulty IN ('L0', 'L1', 'L2') THEN 'test_easy' ELSE 'test_hard' END AS split
  FROM (SELECT *, (SELECT count(*) FROM nation) AS n FROM samples))""",
    ),
)
def dataset_export(spark, sf_dir):
    """Samples written as a dataset and read back."""
    out = scratch_dir(spark)
    assigned = split.assign_split(fx.samples(spark, sf_dir), fx.scenarios(spark, sf_dir))
    sinks.write_dataset(assigned.withColumn("_internal", F.lit(1)), out)
    read = tables.read_samples(spark, out)
    private = [c for c in spark.read.json(out).columns if c.startswith("_")]
    return read.select(
        "id",
        "split",
        F.substring(F.sha2("user_request", 256), 1, 16).alias("request_hash"),
        F.lit(not private).alias("no_private_columns"),
    )


@query("synthetic_objects")
def synthetic_objects(spark, sf_dir):
    """As many worlds as there are suppliers."""
    return worlds.objects(_worlds(spark, sf_dir)).select("scenario_id", "ord", "id", "type", "name")


def _worlds(spark, sf_dir):
    return worlds.world_plan(fx.table(spark, sf_dir, "supplier").select((F.col("s_suppkey") + 1).alias("i")))


@query(
    "synthetic_sizes",
    f"""
SELECT {pad('traffic_synthetic_', '(s_suppkey + 1)', 3)} AS scenario_id, t.type,
       CASE WHEN r <= 0.3 THEN small WHEN r <= 0.8 THEN medium ELSE big END AS n
FROM (SELECT s_suppkey, (s_suppkey + 1) / (SELECT count(*) FROM supplier) AS r FROM supplier)
CROSS JOIN (VALUES ('vehicle', 5, 20, 50), ('camera', 3, 10, 20), ('polygon', 2, 5, 10), ('line', 2, 5, 8), ('point', 30, 120, 300)) t(type, small, medium, big)""",
)
def synthetic_sizes(spark, sf_dir):
    plan = _worlds(spark, sf_dir)
    sizes = worlds.objects(plan).groupBy("scenario_id", "type").agg(F.count(F.lit(1)).alias("n"))
    points = worlds.trajectories(plan).groupBy("scenario_id").agg(F.count(F.lit(1)).alias("n"))
    return sizes.unionByName(points.withColumn("type", F.lit("point")))


@query("synthetic_trajectories")
def synthetic_trajectories(spark, sf_dir):
    return worlds.trajectories(_worlds(spark, sf_dir))
