"""Near-duplicate vectors of one label by PCA-ordered, tiled comparison with residual bounds.

Unit vectors are turned into the basis of their principal components, so that the leading coordinates
carry most of every product. Tiles of `TILE` vectors are compared pairwise: products are added up over
a few leading coordinates, and what the others can still add is bounded by the product of the
norms of the two rests. Pairs whose bound stays below the threshold are done; the others take more
coordinates. The decision itself is made on the given vectors in double precision.

A pair of tiles returns, per vector, its number of links there and one edge to its root in the
spanning forest of these links, so that a group of many copies gives no list of pairs.

The comparison is exact, so its work grows with the square of a label's size; tiles bound the memory of a
task, and a label of any size is spread over all pairs of its tiles.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and those without a
label, link with nothing; so do vectors of different lengths, and a null vec_id, whose component is
null; rows that are equal in id, label and vector count as one vector and are each returned; vectors that
share an id are never linked with each other; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.llm.components import connected_components
from tracewright.session import materialize

THRESHOLD = 0.93
TILE = 2048
ROWS_AT_ONCE = 256
# Cosines this near to the threshold are decided on the vectors as given.
NEAR = 1e-9


def usable(vectors: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    """(id, v, label, d) of the vectors that can link, each once."""
    v = F.col("v")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(
        F.col(vec_id).cast("bigint").alias("id"), F.col(embedding).cast("array<double>").alias("v"), F.col(label).alias("label")
    )
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & fine)
    rows = rows.filter(F.exists(v, lambda x: x != 0)).withColumn("d", F.size("v"))
    return rows.distinct()


def _matrix(column: pa.ChunkedArray, d: int) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in column.chunks])
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no square over- or underflows
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _scaled(x: np.ndarray) -> np.ndarray:
    """The vector times a power of two, exactly, so that no product over- or underflows."""
    return np.ldexp(x, -int(np.frexp(np.abs(x).max())[1]))


def principal_axes(rows: DataFrame) -> dict[int, np.ndarray]:
    """Per vector length the principal axes as columns, from the second moments of all vectors.

    Every task adds up its own d x d sums; the driver gets d * d numbers per length.
    """

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            lengths = np.asarray(batch.column("d"))
            for d in np.unique(lengths):
                part = batch.filter(pa.array(lengths == d))
                x = _unit(_matrix(pa.chunked_array([part.column("v")]), int(d)))
                sums[int(d)] = sums.get(int(d), 0) + x.T @ x
        for d, s in sums.items():
            yield pa.RecordBatch.from_pydict({"d": pa.array([d], pa.int32()), "s": pa.array([s.ravel()], pa.list_(pa.float64()))})

    parts = rows.select("d", "v").mapInArrow(moments, "d int, s array<double>")
    cells = parts.select("d", F.posexplode("s").alias("i", "x")).groupBy("d", "i").agg(F.sum("x").alias("x"))
    found: dict[int, np.ndarray] = {}
    for row in cells.collect():
        found.setdefault(row.d, np.zeros(row.d * row.d))[row.i] = row.x
    return {d: np.linalg.eigh(s.reshape(d, d))[1][:, ::-1] for d, s in found.items()}


def linked(a: np.ndarray, b: np.ndarray, axes: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the pairs with a cosine of at least the threshold."""
    d = axes.shape[0]
    ua, ub = _unit(a), _unit(b)
    ra, rb = ua @ axes, ub @ axes
    ends = sorted({min(d, e) for e in (8, 16, 32, d)})
    rest_a = [np.sqrt((ra[:, e:] ** 2).sum(axis=1)) for e in ends]
    rest_b = [np.sqrt((rb[:, e:] ** 2).sum(axis=1)) for e in ends]
    rows, columns = [], []
    for start in range(0, len(a), ROWS_AT_ONCE):
        stop = min(len(a), start + ROWS_AT_ONCE)
        total = ra[start:stop, : ends[0]] @ rb[:, : ends[0]].T
        i, j = np.nonzero(total + rest_a[0][start:stop, None] * rest_b[0][None, :] >= threshold - NEAR)
        sums = total[i, j]
        for k in range(1, len(ends)):
            lo, hi = ends[k - 1], ends[k]
            for at in range(0, len(i), 65536):  # a few pairs at a time bounds the memory
                p, q = i[at : at + 65536] + start, j[at : at + 65536]
                sums[at : at + 65536] += np.einsum("ij,ij->i", ra[p, lo:hi], rb[q, lo:hi])
            stay = sums + rest_a[k][i + start] * rest_b[k][j] >= threshold - NEAR
            i, j, sums = i[stay], j[stay], sums[stay]
        i += start
        close = np.abs(sums - threshold) <= NEAR
        sure = sums >= threshold
        for c in np.flatnonzero(close):
            x, y = _scaled(a[i[c]]), _scaled(b[j[c]])
            sure[c] = math.sumprod(x, y) / math.sqrt(math.sumprod(x, x) * math.sumprod(y, y)) >= threshold
        rows.append(i[sure])
        columns.append(j[sure])
    return np.concatenate(rows), np.concatenate(columns)


def roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest node of each node's component under the edges i - j."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        np.minimum.at(new, root[i], least)
        np.minimum.at(new, root[j], least)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def tile_links(rows: DataFrame, axes: dict[int, np.ndarray], threshold: float) -> DataFrame:
    """(id, n, root) per vector and pair of tiles, for vectors with links there."""
    counts = rows.groupBy(F.col("label").alias("label2"), F.col("d").alias("d2")).agg(
        F.ceil(F.count("*") / TILE).cast("int").alias("tiles")
    )
    placed = rows.join(counts, (F.col("label") == F.col("label2")) & (F.col("d") == F.col("d2")))
    placed = placed.withColumn("tile", F.pmod(F.xxhash64("id", "v"), F.col("tiles")).cast("int"))
    placed = placed.select("label", "d", "id", "v", "tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
    placed = placed.withColumn("lo", F.least("tile", "other")).withColumn("hi", F.greatest("tile", "other"))

    def compare(group: pa.Table) -> pa.Table:
        d = group.column("d")[0].as_py()
        x, ids = _matrix(group.column("v"), d), np.asarray(group.column("id"))
        tile = np.asarray(group.column("tile"))
        order = np.argsort(ids, kind="stable")
        x, ids, tile = x[order], ids[order], tile[order]
        first = np.flatnonzero(tile == tile.min())
        second = np.flatnonzero(tile != tile.min())
        same = group.column("lo")[0].as_py() == group.column("hi")[0].as_py()
        if same:
            second = first
        i = j = np.zeros(0, np.int64)
        if len(second):
            i, j = linked(x[first], x[second], axes[d], threshold)
            i, j = first[i], second[j]
            keep = (i < j) & (ids[i] != ids[j]) if same else ids[i] != ids[j]
            i, j = i[keep], j[keep]
        n = np.bincount(i, minlength=len(ids)) + np.bincount(j, minlength=len(ids))
        root = roots(len(ids), i, j)
        has = n > 0
        return pa.table({"id": ids[has], "n": n[has].astype(np.int64), "root": ids[root[has]]})

    # A group holds two tiles, whatever the size of the label.
    return placed.select("label", "d", "id", "v", "tile", "lo", "hi").groupBy("label", "d", "lo", "hi").applyInArrow(
        compare, "id bigint, n bigint, root bigint"
    )


def near_duplicates(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    rows = materialize(usable(vectors, vec_id, embedding, label))
    links = materialize(tile_links(rows, principal_axes(rows), threshold))
    counts = links.groupBy("id").agg(F.sum("n").alias("n"))
    parts = connected_components(links.select(F.col("id").alias("a"), F.col("root").alias("b")))
    known = counts.join(parts, F.col("id") == F.col("node")).select("id", "n", "component")
    out = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id")).join(known, F.col("vec_id") == F.col("id"), "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n", F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
