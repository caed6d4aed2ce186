"""Exact substring deduplication with enhanced suffix arrays and common-prefix interval trees.

A byte goes when a string of `MIN_BYTES` bytes that covers it also starts anywhere else.

Which suffixes have to be compared is found by anchors: in every stretch of `MIN_BYTES` bytes, the 16-byte
gram of least hash (the leftmost of equal ones). Equal stretches have equal anchors at equal
offsets, so a stretch is only compared with stretches of the same anchor, and of the same half of
offsets from it; all stretches of a half share a core of about 200 bytes, whose hash is their key. Keys
that occur once are dropped. A segment - the run of stretches of one key at one place - that
occurs twice as a whole is covered without a look at its bytes. Only segments that meet different
segments under one key are read again: their suffix array is built by prefix doubling, a stack scan over
its common prefixes yields the interval tree, and an interval whose suffixes have different bytes
before them is a maximal repeat with all its occurrences.

Groups of segments with a key of more than `MAX_SEGMENTS` different segments are split: each half of
offsets is halved again, which gives longer cores and new keys, down to single stretches, where
equal keys are equal strings and only need counting. So no key brings an unbounded group into a task.

Defined cases: a null text counts as empty; texts below `MIN_BYTES` lose nothing; repeated rows are
different places of the same string, so long ones lose all bytes; strings are judged on the input,
not on what is left; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.llm.flat import mix
from tracewright.session import materialize

MIN_BYTES = 400
GRAM = 16
PIECE = 1 << 18
MAX_SEGMENTS = 1_000
SEGMENTS_PER_TASK = 1_500


def _gram_hashes(buf: np.ndarray) -> np.ndarray:
    """A hash of the 16 bytes at every place."""
    n = len(buf) - GRAM + 1
    padded = np.concatenate((buf, np.zeros(8, np.uint8)))
    eight = np.zeros(len(buf), np.uint64)
    for k in range(8):
        eight |= padded[k : k + len(buf)].astype(np.uint64) << np.uint64(8 * k)
    return mix(mix(eight[:n]) * np.uint64(0x9E3779B97F4A7C15) + eight[8 : n + 8])


def anchors(buf: np.ndarray, min_bytes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first and last start of every run of stretches with one anchor."""
    starts = len(buf) - min_bytes + 1
    width = min_bytes - GRAM + 1
    found: list[tuple[np.ndarray, ...]] = []
    for at in range(0, starts, PIECE):
        count = min(PIECE, starts - at)
        g = _gram_hashes(buf[at : at + count + min_bytes - 1])
        places = np.arange(len(g), dtype=np.uint64)
        packed = (g & ~np.uint64((1 << 20) - 1)) | places
        blocks = -(-len(packed) // width)
        square = np.full(blocks * width, np.iinfo(np.uint64).max)
        square[: len(packed)] = packed
        square = square.reshape(blocks, width)
        ahead = np.minimum.accumulate(square, axis=1).ravel()
        behind = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])
        anchor = (least & np.uint64((1 << 20) - 1)).astype(np.int64)
        new = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
        last = np.concatenate((new[1:], [count])) - 1
        found.append((anchor[new] + at, new + at, last + at))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _key(*parts: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(b"".join(parts), digest_size=8).digest(), "big", signed=True)


def _segment(data: bytes, anchor: int, low: int, high: int, first: int, last: int, min_bytes: int) -> tuple[int, bytes]:
    """Key and digest of the stretches from `first` to `last`, whose offsets before the anchor lie in low..high.

    The core is what all stretches with these offsets share, whichever of them exist here.
    """
    tag = b"%d,%d;" % (low, high)
    key = _key(tag, data[anchor - low : anchor - high + min_bytes])
    place = b"%d;" % (anchor - first)
    return key, hashlib.blake2b(tag + place + data[first : last + min_bytes], digest_size=16).digest()


SEGMENTS = "k bigint, s binary, doc binary, anchor bigint, first bigint, last bigint"


def _segments(batches: Iterator[pa.RecordBatch], min_bytes: int, keys_only: bool) -> Iterator[pa.RecordBatch]:
    half = (min_bytes - GRAM) // 2
    halves = ((0, half), (half + 1, min_bytes - GRAM))
    for batch in batches:
        for row in range(batch.num_rows):
            data = batch.column("data")[row].as_py() or b""
            if len(data) < min_bytes:
                continue
            out: list[tuple] = []
            for anchor, first, last in zip(*(x.tolist() for x in anchors(np.frombuffer(data, np.uint8), min_bytes)), strict=True):
                for low, high in halves:
                    a, b = max(first, anchor - high), min(last, anchor - low)
                    if a > b:
                        continue
                    if keys_only:
                        out.append((_key(b"%d,%d;" % (low, high), data[anchor - low : anchor - high + min_bytes]),))
                    else:
                        out.append((*_segment(data, anchor, low, high, a, b, min_bytes), anchor, a, b))
            columns = list(zip(*out, strict=True))
            if keys_only:
                yield pa.RecordBatch.from_pydict({"k": pa.array(columns[0], pa.int64())})
                continue
            doc = pa.array([batch.column("doc")[row].as_py()] * len(out), pa.binary())
            k, s, anchor, a, b = columns
            yield pa.RecordBatch.from_arrays(
                [pa.array(k, pa.int64()), pa.array(s, pa.binary()), doc, *(pa.array(x, pa.int64()) for x in (anchor, a, b))],
                ["k", "s", "doc", "anchor", "first", "last"],
            )


# ---- enhanced suffix array of a group of segments


def suffix_array(data: list[bytes], group: np.ndarray, min_bytes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places (in the joined segments) of suffixes of at least `min_bytes`, sorted by group and text.

    Also the common prefix of each with the one before it (0 across groups), the byte before each (-1
    minus the segment at a segment's start), and where segments begin.
    """
    lengths = np.array([len(d) for d in data], np.int64)
    joined = np.frombuffer(b"".join(data) + bytes(8), np.uint8)
    n = int(lengths.sum())
    begins = np.concatenate(([0], np.cumsum(lengths)))
    of = np.repeat(np.arange(len(data)), lengths)
    left = begins[1:][of] - np.arange(n)  # bytes to the segment's end
    eight = np.zeros(n, np.uint64)
    for k in range(8):
        byte = np.where(left > k, joined[k : k + n], 0).astype(np.uint64)
        eight |= byte << np.uint64(8 * (7 - k))
    rank = np.unique(eight, return_inverse=True)[1].astype(np.int64)
    rank = rank * 9 + np.minimum(left, 8)
    groups = np.unique(group, return_inverse=True)[1].astype(np.int64)[of]
    rank = np.unique(groups * (int(rank.max()) + 1) + rank, return_inverse=True)[1].astype(np.int64)
    levels, h = [(8, rank)], 8
    while h < int(lengths.max()):
        ahead = np.zeros(n, np.int64)
        far = left > h
        ahead[far] = rank[np.flatnonzero(far) + h] + 1
        rank = np.unique(rank * (n + 2) + ahead, return_inverse=True)[1].astype(np.int64)
        h *= 2
        levels.append((h, rank))
    starts = np.flatnonzero(left >= min_bytes)
    order = starts[np.argsort(rank[starts], kind="stable")]
    common = np.zeros(len(order), np.int64)
    if len(order) > 1:
        i, j = order[:-1], order[1:]
        most = np.minimum(left[i], left[j])
        lcp = np.zeros(len(i), np.int64)
        for h, ranks in reversed(levels):
            fits = lcp + h <= most
            x, y = np.where(fits, i + lcp, i), np.where(fits, j + lcp, j)
            lcp += h * (fits & (ranks[x] == ranks[y]))
        for _ in range(8):
            fits = lcp < most
            x, y = np.where(fits, i + lcp, i), np.where(fits, j + lcp, j)
            lcp += fits & (joined[x] == joined[y])
        common[1:] = np.where(groups[i] == groups[j], lcp, 0)
    before = np.where(order > begins[of[order]], joined[np.maximum(order - 1, 0)].astype(np.int64), -1 - of[order])
    return order, common, before, begins


def maximal_repeats(common: np.ndarray, before: np.ndarray, min_bytes: int) -> Iterator[tuple[int, int, int]]:
    """(first, last, length) of the intervals of the suffix array that are maximal repeats.

    One scan with a stack of open intervals. An interval is passed on when its suffixes don't all have the
    same byte before them; else it lies inside of a repeat that starts one byte earlier.
    """
    stack: list[list] = []  # length, first, byte before (None: different ones)
    values, bytes_before = common.tolist(), before.tolist()
    for i in range(1, len(values) + 1):
        length = values[i] if i < len(values) else 0
        first, byte = i - 1, bytes_before[i - 1]
        while stack and stack[-1][0] > length:
            top = stack.pop()
            if top[2] != byte:
                top[2] = None
            if top[2] is None:
                yield top[1], i - 1, top[0]
            first, byte = top[1], top[2]
        if length >= min_bytes:
            if stack and stack[-1][0] == length:
                if stack[-1][2] != byte:
                    stack[-1][2] = None
            else:
                stack.append([length, first, byte])
        # what is below on the stack learns the byte of the closed interval when it is popped


def repeated_runs(data: list[bytes], group: np.ndarray, min_bytes: int) -> list[tuple[int, int, int]]:
    """(segment, start, end) of the runs covered by repeats within a group."""
    order, common, before, begins = suffix_array(data, group, min_bytes)
    best = np.zeros(len(order), np.int64)
    for first, last, length in maximal_repeats(common, before, min_bytes):
        np.maximum(best[first : last + 1], length, out=best[first : last + 1])
    hit = best > 0
    places, lengths = order[hit], best[hit]
    by_place = np.argsort(places, kind="stable")
    out: list[tuple[int, int, int]] = []
    for place, length in zip(places[by_place].tolist(), lengths[by_place].tolist(), strict=True):
        segment = int(np.searchsorted(begins, place, "right")) - 1
        start = place - int(begins[segment])
        if out and out[-1][0] == segment and start <= out[-1][2]:
            out[-1] = segment, out[-1][1], max(out[-1][2], start + length)
        else:
            out.append((segment, start, start + length))
    return out


# ---- the job


def _with_bytes(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The wanted segments with their bytes; `docs` has doc and data."""
    lists = wanted.groupBy("doc").agg(
        F.collect_list(F.struct("k", "s", "c", "anchor", "first", "last")).alias("segments")
    )
    found = docs.join(lists, "doc")
    rows = found.select("doc", "data", F.explode("segments").alias("x")).select("doc", "x.*", "data")
    length = F.col("last") - F.col("first") + MIN_BYTES
    rows = rows.withColumn("data", F.substring("data", (F.col("first") + 1).cast("int"), length.cast("int")))
    low = F.when(F.col("anchor") - F.col("last") <= (MIN_BYTES - GRAM) // 2, 0).otherwise((MIN_BYTES - GRAM) // 2 + 1)
    high = F.when(low == 0, (MIN_BYTES - GRAM) // 2).otherwise(MIN_BYTES - GRAM)
    return rows.withColumn("low", low).withColumn("high", high).dropDuplicates(["k", "s"])


LEVEL = "k bigint, s binary, doc binary, anchor bigint, first bigint, last bigint, c bigint, low int, high int, data binary"


def _halved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each segment as two, of half the offsets each."""
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            middle = (r["low"] + r["high"]) // 2
            for low, high in ((r["low"], middle), (middle + 1, r["high"])):
                a, b = max(r["first"], r["anchor"] - high), min(r["last"], r["anchor"] - low)
                if low > high or a > b:
                    continue
                at = r["first"]
                data = r["data"]
                key, s = _segment(data, r["anchor"] - at, low, high, a - at, b - at, MIN_BYTES)
                key = _key(key.to_bytes(8, "big", signed=True), r["k"].to_bytes(8, "big", signed=True))
                part = data[a - at : b - at + MIN_BYTES]
                rows.append(r | {"k": key, "s": s, "first": a, "last": b, "low": low, "high": high, "data": part})
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=batch.schema)


def _scanned(table: pa.Table) -> pa.Table:
    rows = table.sort_by([("k", "ascending"), ("s", "ascending")])
    data = [x.as_py() for x in rows.column("data")]
    runs = repeated_runs(data, np.asarray(rows.column("k")), MIN_BYTES) if data else []
    single = np.asarray(rows.column("total")) == 1
    first, doc = rows.column("first").to_pylist(), rows.column("doc").to_pylist()
    kept = [(doc[g], first[g] + a, first[g] + b) for g, a, b in runs if single[g]]
    columns = list(zip(*kept, strict=True)) or [(), (), ()]
    return pa.table(
        {"doc": pa.array(columns[0], pa.binary()), "start": pa.array(columns[1], pa.int64()), "end": pa.array(columns[2], pa.int64())}
    )


def _range(rows: DataFrame) -> DataFrame:
    return rows.select("doc", F.col("first").alias("start"), (F.col("last") + MIN_BYTES).alias("end"))


def covered_ranges(docs: DataFrame) -> DataFrame:
    """(doc, start, end) of byte ranges that repeats cover; `docs` has doc (digest of the text) and data."""
    keys = docs.mapInArrow(lambda b: _segments(b, MIN_BYTES, True), "k bigint").groupBy("k").agg(F.count("*").alias("m"))
    keys = keys.filter("m > 1").drop("m")
    segments = docs.mapInArrow(lambda b: _segments(b, MIN_BYTES, False), SEGMENTS).join(keys, "k")
    segments = materialize(segments)
    groups = segments.groupBy("k", "s").agg(
        F.count("*").alias("c"), F.min(F.struct("doc", "first", "anchor", "last")).alias("x")
    )
    groups = materialize(groups.select("k", "s", "c", "x.*"))
    twice = groups.filter("c > 1").select("k", "s")
    found = [_range(segments.join(twice, ["k", "s"], "left_semi")).distinct()]

    several = groups.groupBy("k").agg(F.count("*").alias("m")).filter("m > 1").drop("m")
    columns = [c.split(" ")[0] for c in LEVEL.split(", ")]
    level = _with_bytes(docs, groups.join(several, "k", "left_semi")).select(
        *[F.col(c).cast(t) for c, t in (x.split(" ") for x in LEVEL.split(", "))]
    )
    level = materialize(level)
    while True:
        same = level.groupBy("k", "s").agg(F.sum("c").alias("total"), F.min(F.struct("doc", "first")).alias("x"))
        per_key = same.groupBy("k").agg(F.count("*").alias("m"))
        sizes = materialize(same.join(per_key, "k").select("k", "s", "total", "m", "x"))
        joined = level.join(sizes, ["k", "s"])
        found.append(_range(joined.filter("total > 1 and c = 1")))
        reps = joined.filter((F.col("x.doc") == F.col("doc")) & (F.col("x.first") == F.col("first")))
        small = reps.filter((F.col("m") > 1) & (F.col("m") <= MAX_SEGMENTS))
        n = sizes.filter((F.col("m") > 1) & (F.col("m") <= MAX_SEGMENTS)).count()
        if n:
            task = F.pmod(F.xxhash64("k"), F.lit(-(-n // SEGMENTS_PER_TASK))).alias("task")
            small = small.select("k", "s", "doc", "first", "total", "data", task)
            found.append(
                materialize(small.groupBy("task").applyInArrow(_scanned, "doc binary, start bigint, end bigint"))
            )
        if not sizes.filter(F.col("m") > MAX_SEGMENTS).head(1):
            break
        hot = reps.filter(F.col("m") > MAX_SEGMENTS)
        hot = hot.withColumn("c", F.col("total")).select(*columns)
        level = materialize(hot.mapInArrow(_halved, LEVEL))
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def _cut(batches: Iterator[pa.RecordBatch], keep: list[str]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        for at in range(0, batch.num_rows, 128):
            part = batch.slice(at, 128)
            kept, spans = [], []
            for data, ranges in zip(part.column("_data").to_pylist(), part.column("_ranges").to_pylist(), strict=True):
                data = data or b""
                runs: list[dict] = []
                for r in sorted(ranges or (), key=lambda r: r["start"]):
                    if runs and r["start"] <= runs[-1]["end"]:
                        runs[-1]["end"] = max(runs[-1]["end"], r["end"])
                    else:
                        runs.append({"start": r["start"], "end": r["end"]})
                pieces, last = [], 0
                for r in runs:
                    pieces.append(data[last : r["start"]])
                    last = r["end"]
                kept.append(b"".join([*pieces, data[last:]]))
                spans.append(runs)
            columns = [*(part.column(c) for c in keep), pa.array(kept, pa.binary()), pa.array(spans, kind)]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "_kept", "_spans"])


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row `_id`, `_n_bytes`, `_kept` (the bytes left) and `_spans` (removed byte ranges)."""
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(F.col(doc_id).alias("_id"), data.alias("_data"))
    digest = F.unhex(F.md5("_data"))
    places = rows.select(digest.alias("doc"), F.col("_data").alias("data")).filter(F.octet_length("data") >= MIN_BYTES)
    ranges = covered_ranges(places).distinct().groupBy("doc").agg(F.collect_list(F.struct("start", "end")).alias("_ranges"))
    joined = rows.withColumn("_doc", digest).join(ranges, F.col("_doc") == F.col("doc"), "left")
    joined = joined.select("_id", F.octet_length("_data").cast("bigint").alias("_n_bytes"), "_data", "_ranges")
    kind = rows.schema["_id"].dataType.simpleString()
    schema = f"_id {kind}, _n_bytes bigint, _kept binary, _spans array<struct<start:bigint,end:bigint>>"
    return joined.mapInArrow(lambda b: _cut(b, ["_id", "_n_bytes"]), schema)
