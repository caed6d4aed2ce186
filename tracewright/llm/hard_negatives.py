"""Hard negatives by inner product, with a cover tree per tile of candidates.

Candidates lie in tiles of about `TILE` rows: labels with many rows have tiles of their own, cut by hash, the others
share tiles by the hash of the label. In a tile every vector gets one more component that brings all of them to
the same norm, so that near means a large inner product. Points enter the tree farthest first; a level
holds the points down to a distance, each of which hangs below its nearest point of the levels above, and knows
how far the points below it reach. An anchor's inner product with a node's point and that reach bound
all products below. Nodes are opened best first for a batch of anchors at a time; those whose bounds
lie outside of all windows, or below what is already found, are skipped. What is opened is scored exactly.

Every anchor is compared with every tile that can hold its partners, in blocks of `ANCHORS`, so work grows with
anchors times rows; a task holds one tile and one block. A tile returns at most as many rows as
are wanted per anchor and window, and the best of all tiles are ranked by Spark.

Vectors hold whole numbers, and scores are exact; they must fit in a long. Defined cases: rows with a null id,
label or vector, an empty vector or a null component take no part; vectors of different lengths are never compared;
rows equal in id, label and vector are one; a row is no partner of another one with its id; ties go by smaller
id; anchors without positives or without negatives in a window return no rows there.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tracewright.session import materialize

TILE = 4096
ANCHORS = 8192
BATCH = 64
OPENED_AT_ONCE = 128
STEP = 1.25  # distances of one level to the next
KEY = ["d", "pure", "own", "salt"]
LARGE = 9.0e18


class CoverTree:
    """Distinct vectors of a tile in the order in which they enter, their parents, and how far each group of children reaches."""

    def __init__(self, points: np.ndarray):
        n = len(points)
        norms = np.sqrt((points * points).sum(axis=1))
        self.norm = float(norms.max(initial=0.0))
        lifted = np.column_stack([points, np.sqrt(np.maximum(self.norm**2 - norms**2, 0))])
        order, level, parent = np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, -1)
        left = np.arange(n)  # points that have not entered yet
        distance, nearest = np.full(n, np.inf), np.zeros(n, np.int64)
        above, radius, now, next_point = nearest.copy(), np.inf, 0, 0
        for i in range(n):
            if i and distance[next_point] < radius:
                # A new level: what enters now hangs below the points that are there so far.
                above = nearest.copy()
                while distance[next_point] < radius:
                    radius, now = (distance[next_point] if radius == np.inf else radius) / STEP, now + 1
                    if distance[next_point] == 0:
                        radius = 0.0
            order[i], level[i] = next_point, now
            parent[i] = above[next_point] if i else -1
            left = left[left != next_point]
            if len(left):
                d = np.sqrt(np.maximum(((lifted[left] - lifted[next_point]) ** 2).sum(axis=1), 0))
                closer = d < distance[left]
                distance[left[closer]], nearest[left[closer]] = d[closer], i
                next_point = left[np.argmax(distance[left])]
        self.order, self.level, self.parent = order, level, parent
        lifted = lifted[order]
        # Groups of children: one per point and level at which it gets some.
        self.group_of = np.full(n, -1)
        keys, self.group_of[1:] = np.unique(parent[1:] * (now + 2) + level[1:], return_inverse=True)
        self.group_parent = keys // (now + 2)
        reach, below, at = np.zeros(len(keys)), np.arange(1, n), np.arange(1, n)
        while len(at):
            up = parent[at]
            np.maximum.at(reach, self.group_of[at], np.sqrt(((lifted[below] - lifted[up]) ** 2).sum(axis=1)))
            more = up > 0
            below, at = below[more], up[more]
        # A node stands for its group and all later ones of its point.
        for g in range(len(keys) - 2, -1, -1):
            if self.group_parent[g] == self.group_parent[g + 1]:
                reach[g] = max(reach[g], reach[g + 1])
        self.reach = reach


class Search:
    """A stored tree, ready to be opened by batches of anchors."""

    def __init__(self, tile: pa.Table):
        tile = tile.sort_by("pos")
        self.points = _matrix(tile.column("v"))
        self.labels = np.asarray(tile.column("lab"))
        parent, group = np.asarray(tile.column("parent")), np.asarray(tile.column("grp"))
        self.norm = tile.column("norm")[0].as_py()
        ids = tile.column("ids").combine_chunks()
        self.ids, self.first_id = np.asarray(ids.values), np.asarray(ids.offsets).astype(np.int64)
        n_groups = int(group.max(initial=-1)) + 1
        by_group = np.argsort(group, kind="stable")[np.count_nonzero(group < 0) :]
        self.members = by_group
        self.first_member = np.searchsorted(group[by_group], np.arange(n_groups + 1))
        self.reach, self.of = np.zeros(n_groups), np.zeros(n_groups, np.int64)
        self.reach[group[by_group]], self.of[group[by_group]] = np.asarray(tile.column("reach"))[by_group], parent[by_group]
        # The first group of each point, and whether a group is followed by another of its point.
        self.first_group = np.full(len(self.points), -1)
        self.first_group[self.of[::-1]] = np.arange(n_groups)[::-1]
        self.again = np.append(self.of[1:] == self.of[:-1], False)[:n_groups]

    def scores(self, q: np.ndarray, points: np.ndarray) -> np.ndarray:
        x = self.points[points]
        if np.abs(q).max(initial=0) * np.abs(self.points).max(initial=0) * q.shape[1] < 2**53:
            return q.astype(np.float64) @ x.T.astype(np.float64)
        return (q.astype(object) @ x.T.astype(object)).astype(np.float64)  # bounds only; decided by exact()

    def exact(self, q: np.ndarray, points: np.ndarray) -> np.ndarray:
        return np.array([sum(a * b for a, b in zip(x, y, strict=True)) for x, y in zip(q.tolist(), self.points[points].tolist(), strict=True)], np.int64)

    def best(
        self, q: np.ndarray, ids: np.ndarray, labels: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, same: bool
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, window, id, score) of the first k partners of every anchor in every window [low, high]."""
        n_q, n_w = low.shape
        norms = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))
        scale = np.maximum(norms * self.norm, 1e-300)
        slack = 1e-9 * scale + 1e-6
        exact = scale.max() < 2**52
        need = low.astype(np.float64)  # least score that can still matter
        found = [np.zeros(0, np.int64) for _ in range(4)]
        center = np.zeros((n_q, len(self.points)))

        def look(points: np.ndarray) -> None:
            nonlocal found
            s = self.scores(q, points)
            center[:, points] = s
            fits = (labels[:, None] == self.labels[points][None, :]) == same
            parts = [found]
            for w in range(n_w):
                i, j = np.nonzero(fits & (s >= need[:, w, None] - (0 if exact else slack[:, None])) & (s <= high[:, w, None].astype(float) + (0 if exact else slack[:, None])))
                if len(i):
                    value = s[i, j].astype(np.int64) if exact else self.exact(q[i], points[j])
                    p = points[j]
                    n = self.first_id[p + 1] - self.first_id[p]
                    at = np.arange(n.sum()) + np.repeat(self.first_id[p] - np.concatenate(([0], np.cumsum(n)[:-1])), n)
                    i, value, partner = np.repeat(i, n), np.repeat(value, n), self.ids[at]
                    good = (partner != ids[i]) & (value >= low[i, w]) & (value <= high[i, w])
                    parts.append([i[good], np.full(good.sum(), w), partner[good], value[good]])
            if len(parts) == 1:
                return
            i, w, partner, value = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.lexsort((partner, -value, w, i))
            i, w, partner, value = i[order], w[order], partner[order], value[order]
            cell = i * n_w + w
            first = np.flatnonzero(np.append(True, cell[1:] != cell[:-1])) if len(cell) else np.zeros(0, np.int64)
            rank = np.arange(len(cell)) - np.repeat(first, np.diff(np.append(first, len(cell))))
            last = rank == k - 1
            need[i[last], w[last]] = np.maximum(need[i[last], w[last]], value[last].astype(np.float64))
            found = [x[rank < k] for x in (i, w, partner, value)]

        look(np.zeros(1, np.int64))
        open_groups = self.first_group[:1][self.first_group[:1] >= 0]
        ceiling = high.max(axis=1).astype(np.float64) + slack
        while len(open_groups):
            angle = np.arccos(np.clip(center[:, self.of[open_groups]] / scale[:, None], -1, 1))
            spread = 2 * np.arcsin(np.clip(self.reach[open_groups] / max(2 * self.norm, 1e-300), 0, 1))[None, :]
            most = scale[:, None] * np.cos(np.maximum(angle - spread, 0)) + slack[:, None]
            least = scale[:, None] * np.cos(np.minimum(angle + spread, np.pi)) - slack[:, None]
            alive = (most >= need.min(axis=1)[:, None]) & (least <= ceiling[:, None])
            value = np.where(alive, most, -np.inf).max(axis=0)
            stay = value > -np.inf
            open_groups, value = open_groups[stay], value[stay]
            if not len(open_groups):
                break
            take = np.argsort(-value, kind="stable")[:OPENED_AT_ONCE]
            groups = open_groups[take]
            n = self.first_member[groups + 1] - self.first_member[groups]
            at = np.arange(n.sum()) + np.repeat(self.first_member[groups] - np.concatenate(([0], np.cumsum(n)[:-1])), n)
            children = self.members[at]
            look(children)
            below = self.first_group[children]
            open_groups = np.concatenate([np.delete(open_groups, take), groups[self.again[groups]] + 1, below[below >= 0]])
        return tuple(found)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    return np.asarray(column.flatten()).reshape(len(column), -1)


def usable(vectors: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    """(id, v, lab, d) of the rows that take part, each once; lab is a hash of the label."""
    v = F.col("v")
    rows = vectors.select(
        F.col(f"`{vec_id}`").cast("bigint").alias("id"),
        F.col(f"`{embedding}`").cast("array<bigint>").alias("v"),
        F.when(F.col(f"`{label}`").isNotNull(), F.xxhash64(F.col(f"`{label}`"))).alias("lab"),
    )
    fine = F.col("id").isNotNull() & F.col("lab").isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull())
    return rows.filter(v.isNotNull() & fine).withColumn("d", F.size(v)).distinct()


def tiled(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows with the key of their tile, and (d, lab, pure, own, parts) of every label."""
    labels = rows.groupBy("d", "lab").agg(F.count("*").alias("n"))
    labels = labels.withColumn("pure", (F.col("n") >= TILE // 2).cast("int"))
    small = labels.filter("pure = 0").groupBy(F.col("d").alias("_d")).agg(F.ceil(F.sum("n") / TILE).cast("int").alias("shared"))
    labels = labels.join(small, F.col("d") == F.col("_d"), "left")
    own = F.when(F.col("pure") == 1, F.col("lab")).otherwise(F.pmod("lab", F.coalesce("shared", F.lit(1))))
    parts = F.when(F.col("pure") == 1, F.ceil(F.col("n") / TILE)).otherwise(1).cast("int")
    labels = materialize(labels.select("d", "lab", "pure", own.alias("own"), parts.alias("parts")))
    placed = rows.join(labels, ["d", "lab"]).withColumn("salt", F.pmod(F.xxhash64("id", "v"), F.col("parts")).cast("int"))
    return placed.drop("parts"), labels


TREE = "d int, pure int, own bigint, salt int, pos int, v array<bigint>, lab bigint, ids array<bigint>, parent int, grp int, reach double, norm double"


def _planted(tile: pa.Table, k: int) -> pa.Table:
    v, labels, ids = _matrix(tile.column("v")), np.asarray(tile.column("lab")), np.asarray(tile.column("id"))
    points, which = np.unique(np.column_stack([v, labels]), axis=0, return_inverse=True)
    points, labels, which = points[:, :-1], points[:, -1], which.ravel()
    tree = CoverTree(points.astype(np.float64))
    order = np.lexsort((ids, which))
    first = np.searchsorted(which[order], np.arange(len(points) + 1))
    # Equal vectors of one label differ by id only: no search for k partners returns more than the first k + 1.
    lists = [ids[order[first[p] : min(first[p + 1], first[p] + k + 1)]] for p in tree.order]
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in lists])))
    n, d = points.shape
    key = {c: pa.array([tile.column(c)[0].as_py()] * n, tile.schema.field(c).type) for c in KEY}
    flat = pa.array(np.ascontiguousarray(points[tree.order]).ravel())
    return pa.table(key | {
        "pos": pa.array(np.arange(n, dtype=np.int32)),
        "v": pa.ListArray.from_arrays(pa.array(np.arange(0, n * d + 1, d, dtype=np.int32)), flat),
        "lab": pa.array(labels[tree.order]),
        "ids": pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(np.concatenate(lists))),
        "parent": pa.array(tree.parent.astype(np.int32)),
        "grp": pa.array(tree.group_of.astype(np.int32)),
        "reach": pa.array(np.where(tree.group_of >= 0, np.append(tree.reach, 0)[tree.group_of], 0.0)),
        "norm": pa.array(np.full(n, tree.norm)),
    })


FOUND = "row bigint, anchor bigint, window int, partner bigint, score bigint"


def _search(tile: pa.Table, anchors: pa.Table, k: int, same: bool) -> pa.Table:
    schema = pa.schema([("row", pa.int64()), ("anchor", pa.int64()), ("window", pa.int32()), ("partner", pa.int64()), ("score", pa.int64())])
    out = []
    if tile.num_rows and anchors.num_rows:
        tree = Search(tile)
        anchors = anchors.sort_by([("lab", "ascending"), ("id", "ascending")])
        for at in range(0, anchors.num_rows, BATCH):
            part = anchors.slice(at, BATCH)
            low, high = part.column("low").to_pylist(), part.column("high").to_pylist()
            n_w = max(map(len, low))
            # Windows that an anchor lacks are empty.
            low_of = np.array([x + [1] * (n_w - len(x)) for x in low], np.int64)
            high_of = np.array([x + [0] * (n_w - len(x)) for x in high], np.int64)
            ids, labels = np.asarray(part.column("id")), np.asarray(part.column("lab"))
            i, w, partner, score = tree.best(_matrix(part.column("v")), ids, labels, low_of, high_of, k, same)
            rows = np.asarray(part.column("row"))
            out.append(pa.table([rows[i], ids[i], w.astype(np.int32), partner, score], schema=schema))
    return pa.concat_tables(out) if out else schema.empty_table()


def _found(trees: DataFrame, anchors: DataFrame, n_blocks: int, k: int, same: bool) -> DataFrame:
    """What each tile finds for the anchors that are dealt to it, in blocks."""
    blocked = anchors.withColumn("block", F.pmod("row", F.lit(n_blocks)).cast("int"))
    spread = trees.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    key = [*KEY, "block"]
    work = partial(_search, k=k, same=same)
    return spread.groupBy(*key).cogroup(blocked.groupBy(*key)).applyInArrow(lambda a, b: work(a, b), FOUND)


def _first(found: DataFrame, by: list[str], k: int) -> DataFrame:
    ranks = Window.partitionBy(*by).orderBy(F.desc("score"), "partner")
    return found.withColumn("rank", F.row_number().over(ranks)).filter(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    n_positives: int = 5,
    n_negatives: int = 3,
    low_percent: int = 50,
    high_percent: int = 95,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    `is_anchor` is a condition on `vec_id`. Negatives of a positive have another label than the anchor and
    a score of low_percent to high_percent of the positive's.
    """
    named = vectors.select(*[F.col(f"`{c}`") for c in dict.fromkeys((vec_id, embedding, label))], F.coalesce(is_anchor, F.lit(False)).alias("_is_anchor"))
    rows = materialize(usable(named, vec_id, embedding, label))
    chosen = usable(named.filter("_is_anchor"), vec_id, embedding, label)
    placed, labels = tiled(rows)
    work = partial(_planted, k=max(n_positives, n_negatives))
    trees = materialize(placed.select(*KEY, "id", "v", "lab").groupBy(*KEY).applyInArrow(lambda t: work(t), TREE))
    anchors = materialize(chosen.withColumn("row", F.xxhash64("id", "v", "lab")))
    n_blocks = max(1, -(-anchors.count() // ANCHORS))

    whole = lambda value: F.array(F.lit(int(value))).alias
    near = anchors.join(labels, ["d", "lab"]).select(
        "row", "id", "v", "lab", "d", "pure", "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"),
        whole(-LARGE)("low"), whole(LARGE)("high"),
    )
    positives = materialize(_first(_found(trees, near, n_blocks, n_positives, True), ["row"], n_positives))

    def share(percent: int, up: bool) -> Column:
        x = f"(CAST(score AS DECIMAL(19, 0)) * CAST({percent} AS DECIMAL(9, 0)))"
        return F.expr(f"({x} - pmod({x}, 100)) div 100" + (f" + int(pmod({x}, 100) > 0)" if up else "")).cast("bigint")

    low, high = share(low_percent, True), share(high_percent, False)
    windows = positives.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("rank", low.alias("low"), high.alias("high")))).alias("w")
    )
    tiles = labels.select(
        F.col("d").alias("_d"), "pure", "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt")
    ).distinct()
    # Every tile of the same length, but for those that hold the anchor's own label only.
    far = anchors.join(windows, "row").join(tiles, F.col("d") == F.col("_d"))
    far = far.filter((F.col("pure") == 0) | (F.col("own") != F.col("lab"))).select(
        "row", "id", "v", "lab", "d", "pure", "own", "salt", F.col("w.low").alias("low"), F.col("w.high").alias("high")
    )
    negatives = _first(_found(trees, far, n_blocks, n_negatives, False), ["row", "window"], n_negatives)
    pairs = positives.select("row", F.col("anchor").alias("anchor_id"), F.col("partner").alias("positive_id"), (F.col("rank") - 1).alias("window"), F.col("score").alias("positive_score"))
    return negatives.select("row", "window", "rank", F.col("partner").alias("negative_id"), F.col("score").alias("negative_score")).join(
        pairs, ["row", "window"]
    ).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
