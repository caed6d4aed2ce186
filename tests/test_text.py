import hashlib
import re
import sys
import unicodedata

import pytest
from pyspark.sql import functions as F

from tracewright.functions import text
from tracewright.operators import dedup, ingest
from tracewright.functions.variants import parse_response

WORDS = ["Xe NÀY, nhé!", "Xe N\u0041\u0300Y nhe\u0301", "  a\tb\u00a0c  ", "snake_case-dash", "", "日本 語。", "ПРИВЕТ!", "Ⅷ ² 3", "\u1100\u1161 x"]


def normal(t):
    t = unicodedata.normalize("NFC", t.lower().strip())
    return re.sub(r"\s+", " ", re.sub(r"[^\w\s]", "", t)).strip()


def test_normalisation(spark):
    df = spark.createDataFrame([(w,) for w in WORDS], "t string")
    got = [r[0] for r in df.select(text.normalize_text(F.col("t"))).collect()]
    assert got == [normal(w) for w in WORDS]


def test_characters_kept_in_the_jvm_are_composed_already(spark):
    pattern = re.compile(re.sub(r"\\x\{([0-9A-F]+)\}", lambda m: f"\\u{m[1].zfill(4)}", text._ALREADY_COMPOSED))
    kept = [chr(c) for c in range(sys.maxunicode) if not 0xD800 <= c < 0xE000 and pattern.match(chr(c))]
    assert len(kept) > 20_000
    assert all(unicodedata.is_normalized("NFC", c) for c in kept)
    # None of them can join with a character before it.
    assert unicodedata.is_normalized("NFC", "".join(kept))


def test_hash_language_number(spark):
    df = spark.createDataFrame([("abc", "traffic_synthetic_042"), ("", "none"), ("vẽ xe này", "x_y_7")], "t string, s string")
    rows = df.select(text.short_hash(F.col("t")), text.language_of(F.col("t")), text.scenario_number(F.col("s"))).collect()
    assert [r[0] for r in rows] == [hashlib.sha256(t.encode()).hexdigest()[:16] for t in ("abc", "", "vẽ xe này")]
    assert [r[1] for r in rows] == ["en", "vi", "vi"]
    assert [r[2] for r in rows] == [42, 0, 7]


@pytest.mark.parametrize(
    "answer, value",
    [
        ('{"a": 1}', '{"a":1}'),
        ('  [1, 2]\n', "[1,2]"),
        ('text ```json\n{"a": 2}\n``` more', '{"a":2}'),
        ('```\n{"a": 3}\n```', '{"a":3}'),
        ('```json\n{"a": 4}', None),
        ('{"a": 5} trailing', None),
        ('{"a": 1}{"b": 2}', None),
        ("", None),
        ("no json", None),
        ('```json\nnot json\n``` ```\n{"a": 6}\n```', None),
        ('{"a": 1, "a": 7}', '{"a":7}'),
    ],
)
def test_parse_response(spark, answer, value):
    df = spark.createDataFrame([(answer,)], "t string")
    assert df.select(F.to_json(parse_response(F.col("t")))).first()[0] == value


def test_first_answer_of_three(spark):
    rows = [("r", "k", 1, "x"), ("r", "k", 2, "[2]"), ("r", "k", 3, "[3]"), ("q", "k", 4, "[4]"), ("p", "other", 1, "[1]")]
    got = ingest.first_parsed(spark.createDataFrame(rows, "request_id string, kind string, attempt int, text string"), "k")
    assert [(r.request_id, r.attempt) for r in got.collect()] == [("r", 2)]


def test_dedup_is_the_sequential_cascade(spark):
    """First wins on each level, and a sample enters a level's memory only if it reached it."""
    import random

    random.seed(11)
    rows = []
    for i in range(400):
        tools = random.choice([[], ["a"], ["a", "b"]])
        rows.append(
            (
                i,
                f"id{i}",
                random.choice(["s1", "s2"]),
                random.choice(["Go there", "go there!", "GO  there", "stop", "look", "x", "y", "z"]) + random.choice(["", " 1", " 2", " 3"]),
                random.choice(["t1", "t2", "t3"]),
                random.choice([None, "v1", "v2"]),
                tools,
            )
        )
    seen = [set() for _ in range(4)]
    want, removed = [], [0] * 4
    for _, oid, sid, request, task, target, tools in rows:
        t = target or ""
        keys = [request, normal(request), (task, t), (sid, tuple(tools), t) if tools else None]
        for level, key in enumerate(keys):
            if key is not None and key in seen[level]:
                removed[level] += 1
                break
            if key is not None:
                seen[level].add(key)
        else:
            want.append(oid)
    df = spark.createDataFrame(rows, "o bigint, id string, scenario_id string, user_request string, task_type string, target string, tools array<string>")
    entity = F.array(F.struct(F.col("target").alias("id"), F.lit("vehicle").alias("type"), F.lit("n").alias("name")))
    slot = F.when(F.col("target").isNotNull(), F.struct(F.lit(False).alias("is_list"), entity.alias("ents")))
    none = F.lit(None).cast("struct<is_list: boolean, ents: array<struct<id: string, type: string, name: string>>>")
    samples = df.select(
        F.struct("o").alias("sample_ord"), "id", "scenario_id", "user_request", "task_type",
        F.struct(F.struct(slot.alias("object"), none.alias("line"), none.alias("polygon")).alias("selected")).alias("initial_state"),
        F.transform("tools", lambda t: F.struct(t.alias("tool"), F.parse_json(F.lit("{}")).alias("args"))).alias("gold_trace"),
    )
    kept = dedup.deduplicate(samples)
    assert sorted(r.id for r in kept.collect()) == sorted(want)
    stats = dedup.dedup_stats(samples).first()
    assert [stats.exact, stats.norm, stats.composite, stats.trace] == removed and stats.kept == len(want)
    assert dedup.deduplicate(kept).count() == len(want)
