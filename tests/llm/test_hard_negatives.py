"""Hard negatives against a comparison with every row."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracewright.llm import hard_negatives as hn
from tracewright.llm import queries

SCHEMA = "vec_id bigint, label int, embedding array<bigint>, lab string, d int, pure int"


def by_hand(rows, is_anchor, n_positives=5, n_negatives=3):
    rows = sorted({(i, label, tuple(v)) for i, label, v in rows if i is not None and label is not None and v and None not in v})
    out = []
    for i, label, v in rows:
        if is_anchor(i):
            scored = [
                (sum(a * b for a, b in zip(v, w, strict=True)), j, other) for j, other, w in rows if j != i and len(w) == len(v)
            ]
            scored.sort(key=lambda x: (-x[0], x[1]))
            for score, p, _ in [x for x in scored if x[2] == label][:n_positives]:
                fits = [x for x in scored if x[2] != label and 50 * score <= 100 * x[0] <= 95 * score]
                out += [(i, p, r, n, score, s) for r, (s, n, _) in enumerate(fits[:n_negatives], 1)]
    return sorted(out)


def run(spark, rows, condition):
    table = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    return sorted(tuple(r) for r in hn.hard_negatives(table, F.expr(condition)).collect())


def odd_rows():
    rng = np.random.default_rng(1)
    rows = [(int(i), int(rng.integers(0, 4)), rng.integers(-9, 30, 6).tolist()) for i in range(300)]
    rows += [(i, 1, [5] * 6) for i in range(400, 500)]  # a group of copies larger than any list
    rows += rows[:5] + [(3, 2, [1] * 6), (900, 77, [3] * 6), (901, 78, [4] * 6), (950, 1, [1, 2]), (1000, 1, [2, 2])]
    rows += [(1001, 2, [2, 1]), (1050, 0, [0] * 6), (None, 1, [1] * 6), (1060, None, [1] * 6), (1070, 1, None), (1080, 1, [])]
    return rows + [(1090, 1, [1, None, 1, 1, 1, 1]), (1100, 99, [7, 7, 7])]


@pytest.mark.parametrize("tile", [64, 4096])
def test_same_as_all_pairs(spark, monkeypatch, tile):
    monkeypatch.setattr(hn, "TILE", tile)
    monkeypatch.setattr(hn, "ANCHORS", 20)
    rows = odd_rows()
    assert run(spark, rows, "vec_id % 10 = 0") == by_hand(rows, lambda i: i % 10 == 0)


def test_large_numbers_are_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(i, i % 3, [int(x) * 10**7 + int(x) for x in rng.integers(-9, 30, 4)]) for i in range(120)]
    assert run(spark, rows, "vec_id % 10 = 0") == by_hand(rows, lambda i: i % 10 == 0)


@pytest.mark.parametrize(("n", "d"), [(1, 3), (2, 3), (60, 4), (400, 8)])
def test_reach_covers_all_below(n, d):
    points = np.unique(np.random.default_rng(n).integers(-20, 20, (n, d)).astype(float), axis=0)
    tree = hn.CoverTree(points)
    x = points[tree.order]
    lifted = np.column_stack([x, np.sqrt(np.maximum(tree.norm**2 - (x * x).sum(axis=1), 0))])
    assert sorted(tree.order) == list(range(len(points)))
    for i in range(1, len(x)):
        c = i
        while c > 0:
            assert tree.level[tree.parent[c]] < tree.level[c]
            assert np.linalg.norm(lifted[i] - lifted[tree.parent[c]]) <= tree.reach[tree.group_of[c]] + 1e-9
            c = tree.parent[c]


def test_nodes_outside_of_a_window_are_skipped():
    rng = np.random.default_rng(3)
    points = np.concatenate([c + rng.integers(-3, 4, (200, 5)) for c in rng.integers(-300, 300, (10, 5))])
    points = np.unique(points, axis=0)
    looked = []

    class Counting(hn.Search):
        def scores(self, q, p):
            looked.append(len(p))
            return super().scores(q, p)

    import pyarrow as pa

    table = pa.table({"v": pa.array(points.tolist()), "lab": np.zeros(len(points), np.int64), "id": np.arange(len(points))} | {
        k: pa.array([0] * len(points)) for k in hn.KEY
    })
    tree = Counting(hn._planted(table, 3))
    q = points[:1] + 1
    scores = points @ q[0]
    high = int(np.sort(scores)[-50])
    found = tree.best(q, np.array([-1]), np.array([0]), np.array([[high - 2000]]), np.array([[high]]), 3, True)
    want = sorted(((-int(s), i) for i, s in enumerate(scores) if high - 2000 <= s <= high))[:3]
    assert list(zip((-found[3]).tolist(), found[2].tolist(), strict=True)) == want
    assert sum(looked) < len(points) / 2


def test_query_on_the_given_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = []
    for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect():
        if r.label is not None and r.embedding is not None:
            label = (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label
            rows.append((r.vec_id, label, np.floor(256 * np.array(r.embedding, float)).astype(int).tolist()))
    got = sorted(tuple(r) for r in queries.op11_hard_negatives(spark, sf).collect())
    assert got == by_hand(rows, lambda i: i % 50 == 0)


def test_empty_table(spark):
    assert hn.hard_negatives(spark.createDataFrame([], SCHEMA), F.lit(True)).count() == 0
