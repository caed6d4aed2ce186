"""Decontamination against a search for every window, and the index's parts against plain counts."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.compare import compare
from tracewright.llm import decontaminate as dc
from tracewright.llm import queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def by_hand(docs, items, width):
    windows = {}
    for i, text in items:
        w = words_of(text)
        for k in range(max(len(w) - width + 1, 1 if w else 0)):
            windows.setdefault(tuple(w[k : k + width]), set()).add(i)
    out = []
    for i, text in docs:
        w, hit, found = words_of(text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        out.append((i, len(w), sorted(hit), sorted(found - {None})))
    return out


def small_case():
    rng = random.Random(3)
    words = ["a", "b", "c", "De", "ñ", "9x"]
    pick = lambda n: " ".join(rng.choice(words) for _ in range(n))
    docs = [(i, pick(rng.randint(0, 60))) for i in range(200)] + [(300, None), (301, ""), (302, " .,\x00 "), (303, pick(900))]
    docs += docs[:3]
    return docs, [(str(i), pick(rng.randint(0, 7))) for i in range(30)] + [("3", "zz a"), ("31", "-"), ("32", "a")]


@pytest.mark.parametrize("width", [2, 4, 10])
@pytest.mark.parametrize("shard_words", [64, 1 << 20])
def test_shard_finds_what_a_plain_search_finds(monkeypatch, width, shard_words):
    monkeypatch.setattr(dc, "SHARD_WORDS", shard_words)  # 64: a long document is indexed in pieces
    docs, items = small_case()
    windows = dc.Windows(items, width)
    n, span, pairs, (_, of, _, _) = dc.shard_hits([(t or "").encode() for _, t in docs], windows)
    first = np.concatenate(([0], np.cumsum(n)))
    for at, (_, n_words, hit, found) in enumerate(by_hand(docs, items, width)):
        own = span[of[span[:, 0]] == at] - first[at]
        assert n[at] == n_words
        assert [k for a, b in own.tolist() for k in range(a, b)] == hit
        assert sorted({windows.ids[k] for k in pairs[pairs[:, 0] == at, 1]}) == found


def test_index_against_plain_counts():
    rng = np.random.default_rng(1)
    parts = [rng.integers(1, 6, rng.integers(1, 40)).tolist() for _ in range(30)]
    parts += parts[:5]  # copies
    sequence = np.array([x for p in parts for x in [*p, 0]])
    index = dc.FmIndex(sequence, 5)
    text = "".join(chr(48 + x) for x in sequence)
    patterns = rng.integers(1, 6, (60, 3))
    which, low, high = index.search(patterns)
    for k, p in enumerate(patterns):
        needle = "".join(chr(48 + x) for x in p)
        want = [m.start() for m in re.finditer(f"(?={needle})", text)]
        rows = np.arange(low[which == k][0], high[which == k][0]) if k in which else np.zeros(0, np.int64)
        assert sorted(index.locate(rows)) == want


def test_long_text_is_cut_between_words(monkeypatch):
    text = " ".join(f"w{i}é" for i in range(2000)).encode()
    whole = dc.words([text, b"", b"x"])
    monkeypatch.setattr(dc, "PART_BYTES", 100)
    for a, b in zip(whole, dc.words([text, b"", b"x"]), strict=True):
        assert (a == b).all()


def test_rows_blocks_and_spans(spark, monkeypatch):
    docs, items = small_case()
    items += [(None, "b b b b")]
    d = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id bigint, text string, _leak string")
    b = spark.createDataFrame(items, "item_id string, text string")
    results = []
    for block in (8_000_000, 40):  # at 40 bytes the benchmark takes several passes
        monkeypatch.setattr(dc, "BLOCK_BYTES", block)
        found = dc.find_leaks(d, b, ["doc_id", "_leak", "text"], width=4)
        rest = dc.without_spans(F.coalesce("text", F.lit("")), F.col("_spans"))
        rows = found.select("*", rest.alias("rest")).collect()
        results.append(sorted((r.doc_id, r._n_words, [tuple(s) for s in r._hits], [tuple(s) for s in r._spans], r._items, r.rest) for r in rows))
    assert results[0] == results[1]
    want = sorted((i, n, hit, found) for i, n, hit, found in by_hand(docs, items, 4))
    got = [(r[0], r[1], [k for a, b in r[2] for k in range(a, b)], r[4]) for r in results[0]]
    assert sorted(got) == want
    text = dict(docs)
    for i, n, hits, spans, _, rest in results[0]:
        assert len(words_of(rest)) == n - sum(b - a for a, b in hits)
        for (a, b), (x, y) in zip(hits, spans, strict=True):
            assert words_of(text[i][x:y]) == words_of(text[i])[a:b]


def test_empty_tables_and_clashing_names(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    none = spark.createDataFrame([], "item_id bigint, text string")
    row = dc.find_leaks(d, none, ["doc_id"]).first()
    assert (row._n_words, row._hits, row._items) == (2, [], [])
    assert dc.find_leaks(d.limit(0), d.withColumnRenamed("doc_id", "item_id"), ["doc_id"]).count() == 0
    with pytest.raises(ValueError):
        dc.find_leaks(d.withColumn("_items", F.lit(1)), none, ["doc_id", "_items"])


def test_query_matches_sql(spark):
    mine, theirs, a, b = compare(spark, "/root/testdata/sf0.001", queries.op12_decontaminate, queries.OP12_SQL)
    assert a == b and mine == theirs
    assert hashlib.sha256(b"").hexdigest() in {x for row in mine for x in row if isinstance(x, str)}
