"""Near-duplicate documents by one-permutation hashing, banded buckets and star-shaped candidate edges.

A document is the set of its distinct 2-word shingles (words lower-cased in A-Z). Its shingle
hashes fall into as many bins as the signature has places; a bin's place is its smallest hash,
and an empty bin borrows from the first filled bin in an order of its own (optimal
densification). Runs of `ROWS` places are the keys of `BANDS` buckets.

Documents with equal sets are one node from the start, named by its smallest doc_id, so that
thousands of copies cost one candidate. A bucket of n nodes gives n - 1 candidate edges, to its
heaviest node; each is confirmed on the full sets. Where a bucket's nodes still lie in
different components, all pairs of such nodes that a prefix of rarest shingles does not rule out are
confirmed as well: no link is lost to the star shape.

Defined cases: a null or blank text has no shingles, is linked with nothing and is its own
component; a text of one word is that one shingle; a null doc_id takes part, but names a
component only if there is no other id in it (then component_id is null); rows that repeat a doc_id are
one document; other columns of the input are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.llm.components import connected_components
from tracewright.llm.flat import byte_slices, mix, word_hashes
from tracewright.session import materialize

ROWS, BANDS = 5, 40
PLACES = ROWS * BANDS
PERCENT = 80
BATCH_BYTES = 2_000_000
# Ids of nodes without a doc_id start here, above all ids, so that they never name a component.
NO_ID = 1 << 62

_rng = np.random.default_rng(20240611)
_ORDER = np.argsort(_rng.random((PLACES, PLACES)), axis=1).argsort(axis=1).astype(np.int16)
_FACTORS = _rng.integers(1, 1 << 63, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)
_SALTS = _rng.integers(1, 1 << 63, BANDS, dtype=np.uint64)


def shingle_sets(texts: list[bytes], width: int = 2) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hashes, _, _, first = word_hashes(texts, lower=True)
    n = max(0, len(hashes) - width + 1)
    joined = hashes[:n].copy()
    for i in range(1, width):
        joined = mix(joined * np.uint64(0xD6E8FEB86659FD93) + hashes[i : n + i])
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= width:
            yield np.unique(joined[a : b - width + 1])
        elif b > a:  # too few words: the whole sequence is the one shingle
            whole = hashes[a : a + 1].copy()
            for i in range(a + 1, b):
                whole = mix(whole * np.uint64(0xD6E8FEB86659FD93) + hashes[i : i + 1])
            yield mix(whole ^ np.uint64(b - a))
        else:
            yield hashes[:0]


def signature(shingles: np.ndarray) -> np.ndarray:
    """One-permutation signature of a set that isn't empty; `shingles` are sorted."""
    bins = ((shingles >> np.uint64(32)) * np.uint64(PLACES)) >> np.uint64(32)
    is_first = np.ones(len(bins), bool)
    is_first[1:] = bins[1:] != bins[:-1]
    filled = bins[is_first].astype(np.int64)
    places = np.zeros(PLACES, np.uint64)
    places[filled] = shingles[is_first]
    if len(filled) < PLACES:
        empty = np.ones(PLACES, bool)
        empty[filled] = False
        lenders = filled[_ORDER[np.ix_(empty, filled)].argmin(axis=1)]
        places[empty] = places[lenders]
    return places


def band_keys(shingles: np.ndarray) -> np.ndarray:
    rows = signature(shingles).reshape(BANDS, ROWS)
    return mix((mix(rows) * _FACTORS).sum(axis=1, dtype=np.uint64) + _SALTS).view(np.int64)


def _texts(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.to_pylist()]


def _signed(batches: Iterator[pa.RecordBatch], keep: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = _texts(batch.column("_text"))
        n, digests, keys = [], [], []
        for a, b in byte_slices([len(t) for t in texts], BATCH_BYTES):
            for s in shingle_sets(texts[a:b]):
                n.append(len(s))
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                keys.append(band_keys(s) if len(s) else np.zeros(0, np.int64))
        offsets = np.zeros(len(keys) + 1, np.int32)
        np.cumsum([len(k) for k in keys], out=offsets[1:])
        flat = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        columns = {k: batch.column(k) for k in keep} | {
            "_n": pa.array(n, pa.int64()),
            "_digest": pa.array(digests, pa.binary()),
            "_keys": pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
        }
        yield pa.RecordBatch.from_pydict(columns)


def _with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = _texts(batch.column("_text"))
        for a, b in byte_slices([len(t) for t in texts], BATCH_BYTES):
            sets = list(shingle_sets(texts[a:b]))
            offsets = np.zeros(len(sets) + 1, np.int32)
            np.cumsum([len(s) for s in sets], out=offsets[1:])
            flat = np.concatenate(sets).view(np.int64)
            yield pa.RecordBatch.from_pydict(
                {
                    "node": batch.column("node").slice(a, b - a),
                    "shingles": pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                }
            )


def text_key(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def signed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, key of the text, set size, digest of the set, band keys) of every row, written once."""
    d = docs.select(
        F.col(doc_id).cast("bigint").alias("_id"),
        text_key(F.col(text)).alias("_key"),
        F.col(text).cast("binary").alias("_text"),
    )
    keep = ["_id", "_key"]
    schema = "_id bigint, _key string, _n bigint, _digest binary, _keys array<bigint>"
    return materialize(d.mapInArrow(lambda batches: _signed(batches, keep), schema))


def _nodes(signed: DataFrame) -> DataFrame:
    """One row per distinct set: its node id, size and a text that has it."""
    node = F.coalesce("_id", F.shiftrightunsigned(F.xxhash64("_digest"), 2) + F.lit(NO_ID))
    return (
        signed.filter("_n > 0")
        .select(node.alias("_node"), "_id", "_key", "_n", "_digest")
        .groupBy("_digest", "_n")
        .agg(F.min(F.struct("_node", "_key")).alias("_first"))
        .select("_digest", "_n", F.col("_first._node").alias("node"), F.col("_first._key").alias("key"))
    )


def _buckets(signed: DataFrame, nodes: DataFrame) -> DataFrame:
    """(bucket, node, n, weight) of the buckets with several nodes.

    A node's weight is how many others it meets in all its buckets: the original of many edited
    copies, from which no copy is far, meets more than the copies do.
    """
    node = F.coalesce("_id", F.shiftrightunsigned(F.xxhash64("_digest"), 2) + F.lit(NO_ID))
    own = signed.filter("_n > 0").select(node.alias("node"), F.col("_key").alias("key"), "_n", "_keys")
    first = own.join(nodes.select("node", "key"), ["node", "key"], "left_semi")
    rows = first.dropDuplicates(["node", "key"]).select(
        "node", F.col("_n").alias("n"), F.explode("_keys").alias("bucket")
    )
    rows = materialize(rows)
    several = rows.groupBy("bucket").agg(F.count("*").alias("_m")).filter("_m > 1")
    shared = materialize(rows.join(several, "bucket"))
    weights = shared.groupBy("node").agg(F.sum("_m").alias("weight"))
    return materialize(shared.drop("_m").join(weights, "node"))


def _near_sizes(n: str, m: str) -> Column:
    return 100 * F.least(n, m) >= PERCENT * F.greatest(n, m)


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The candidate pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    both = pairs.join(right, "b").join(left, "a")
    both = both.select("a", "b", common.alias("c"), (F.size("x") + F.size("y")).alias("total"))
    return both.filter(100 * F.col("c") >= PERCENT * (F.col("total") - F.col("c"))).select("a", "b")


def _stars(buckets: DataFrame) -> DataFrame:
    """Edges from the heaviest node of each bucket to its other nodes."""
    hub = F.max_by(F.struct("node", "n"), F.struct("weight", -F.col("node")))
    rows = buckets.join(buckets.groupBy("bucket").agg(hub.alias("h")), "bucket")
    rows = rows.filter((F.col("node") != F.col("h.node")) & _near_sizes("n", "h.n"))
    return rows.select(F.col("h.node").alias("a"), F.col("node").alias("b")).distinct()


def _open_nodes(buckets: DataFrame, parts: DataFrame) -> DataFrame:
    """(node, component) of the nodes in buckets whose nodes the stars did not tie into one component."""
    named = buckets.select("bucket", "node").join(parts, "node", "left")
    named = materialize(named.withColumn("component", F.coalesce("component", "node")))
    several = F.min("component") != F.max("component")
    still = named.groupBy("bucket").agg(several.alias("several")).filter("several")
    return materialize(named.join(still, "bucket", "left_semi").select("node", "component").distinct())


def _prefix_pairs(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """Every pair of nodes of different components that can be similar enough.

    Two sets that share 80 % of the larger one share one of the rarest shingles of each: among
    n shingles in order of frequency, one of the first n - ceil(0.8 n) + 1. So what thousands of
    documents have in common makes no pairs (prefix and positional filters of set joins). Nodes of one component are never paired: pairs of
    components that meet at a shingle come first, their nodes after.
    """
    tokens = nodes.join(sets, "node").select(
        "node", "component", F.size("shingles").alias("n"), F.explode("shingles").alias("t")
    )
    counts = tokens.groupBy("t").agg(F.count("*").alias("f"))
    by_node = tokens.join(counts, "t").groupBy("node", "component", "n")
    length = F.col("n") - F.floor((PERCENT * F.col("n") + 99) / 100).cast("int") + 1
    rarest = by_node.agg(F.sort_array(F.collect_list(F.struct("f", "t"))).alias("tokens"))
    rarest = rarest.select("node", "component", "n", F.posexplode(F.slice("tokens", F.lit(1), length)).alias("i", "x"))
    first = materialize(rarest.filter("x.f > 1").select(F.col("x.t").alias("t"), "i", "node", "component", "n"))
    # The smaller set of a pair meets the larger one in its first n - ceil(8/9 n) + 1 already.
    short = first.filter(F.col("i") <= F.col("n") - F.ceil(8 * F.col("n") / 9))
    one = first.select("t", F.col("component").alias("p"), F.col("n").alias("n1"), F.col("i").alias("i1"), F.col("node").alias("a"))
    two = short.select("t", F.col("component").alias("q"), F.col("n").alias("n2"), F.col("i").alias("i2"), F.col("node").alias("b"))
    # What can still be common from this shingle on must reach 4/9 of both sizes.
    reach = 9 * F.least(F.col("n1") - F.col("i1"), F.col("n2") - F.col("i2")) >= 4 * (F.col("n1") + F.col("n2"))
    able = (F.col("p") != F.col("q")) & (F.col("n1") >= F.col("n2")) & _near_sizes("n1", "n2") & reach
    # Components meet by size and position, of which even a huge component has few at a shingle.
    meet = one.drop("a").distinct().join(two.drop("b").distinct().withColumnRenamed("t", "t2"), (F.col("t") == F.col("t2")) & able)
    pairs = meet.drop("t2").join(two, ["t", "q", "n2", "i2"]).join(one, ["t", "p", "n1", "i1"])
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return pairs.select("a", "b").distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, text_key) of every row of the documents."""
    signed = signed_documents(docs, doc_id, text)
    nodes = materialize(_nodes(signed))
    buckets = _buckets(signed, nodes)
    wanted = nodes.join(buckets.select("node").distinct(), "node", "left_semi").select("node", "key")
    # Texts come back by (key, id), which is one row per node and so has no hot key.
    texts = docs.select(
        F.coalesce(F.col(doc_id).cast("bigint"), F.lit(NO_ID)).alias("_id"),
        text_key(F.col(text)).alias("_key"),
        F.col(text).cast("binary").alias("_text"),
    )
    wanted = wanted.select("node", F.least("node", F.lit(NO_ID)).alias("_id"), F.col("key").alias("_key"))
    found = texts.join(wanted, ["_id", "_key"]).dropDuplicates(["node"]).select("node", "_text")
    sets = materialize(found.mapInArrow(_with_sets, "node bigint, shingles array<bigint>"))

    links = materialize(_confirmed(_stars(buckets), sets))
    parts = materialize(connected_components(links))
    more = materialize(_confirmed(_prefix_pairs(_open_nodes(buckets, parts), sets), sets))
    found = parts.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more)
    parts = connected_components(found)
    return _named(signed, nodes, parts)


def _named(signed: DataFrame, nodes: DataFrame, parts: DataFrame) -> DataFrame:
    of_set = nodes.select(F.col("_digest").alias("_d"), "node").join(parts, "node", "left")
    of_set = of_set.withColumn("component", F.coalesce("component", "node"))
    rows = signed.select("_id", "_n", "_digest", "_key").join(
        of_set, (F.col("_digest") == F.col("_d")) & (F.col("_n") > 0), "left"
    )
    component = F.when(F.col("component") < NO_ID, F.col("component"))
    component = F.when(F.col("_n") > 0, component).otherwise(F.col("_id"))
    rows = rows.select("_id", "_n", "_key", component.alias("component_id"))
    return rows.select(
        F.col("_id").alias("doc_id"),
        F.col("_n").alias("n_shingles"),
        "component_id",
        F.col("_id").eqNullSafe(F.col("component_id")).alias("kept"),
        F.col("_key").alias("text_key"),
    )
