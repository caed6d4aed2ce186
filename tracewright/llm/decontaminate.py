"""Benchmark passages in documents, by an FM-index per training shard.

A window is `WINDOW` consecutive words of a benchmark item, or all words of an item that has fewer. The
documents of a shard become one sequence of word numbers, in which only stretches of benchmark
words long enough for a window are kept: no window can lie anywhere else. The sequence is sorted by its
suffixes, its Burrows-Wheeler transform is held in a wavelet matrix, and all windows are
searched backward at once, two ranks a word. The rows found are followed to the nearest sampled suffix
position, which gives the places; the word ranges of a document are merged into spans.

Documents are read once, without a shuffle. A shard is a slice of a partition; its memory is bounded by
`SHARD_BYTES` of text and `SHARD_WORDS` words of the index, and a longer document is indexed in pieces that
overlap by a window less one word. The benchmark goes to the executors in blocks of about `BLOCK_BYTES` of text
(one item at least); a larger benchmark takes one pass over the documents per block.

Words are compared by 64-bit hashes. Defined cases: a null or blank text has no words and no
spans; items without words have no windows; rows of the benchmark that share an id are one item; a null
item_id is in no list, but its windows count as hits; repeated documents each give their row; an empty
benchmark leaves every document clean; columns in `keep` must not bear the names of `RESULT`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewright.llm.flat import _INV, _M, _power_table, byte_slices, mix
from tracewright.session import materialize

WINDOW = 10
SHARD_BYTES = 8_000_000
SHARD_WORDS = 1 << 20
PART_BYTES = 2_000_000
BLOCK_BYTES = 8_000_000
SAMPLED = 8  # every so many places of the sequence its suffix keeps its position

SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
RESULT = [
    T.StructField("_n_words", T.LongType()),
    T.StructField("_hits", SPANS),  # ranges of words
    T.StructField("_spans", SPANS),  # the same in code points
    T.StructField("_items", T.ArrayType(T.StringType())),
]

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
# Digits, small letters and every byte of a character beyond ASCII.
_IN_WORD = bytes(int(48 <= b <= 57 or 97 <= b <= 122 or b >= 128) for b in range(256))
_GAP = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text number, start and end byte of every word; long texts are cut between words."""
    parts = []
    for i, text in enumerate(texts):
        at = 0
        while len(text) - at > PART_BYTES:
            gap = _GAP.search(text, at + PART_BYTES)
            end = gap.start() if gap else len(text)
            parts.append((i, at, text[at:end]))
            at = end
        parts.append((i, at, text[at:]))
    found = []
    for a, b in byte_slices([len(p[2]) for p in parts], PART_BYTES):
        joined = b" ".join([*(p[2] for p in parts[a:b]), b""]).translate(_LOWER)
        inside = np.frombuffer(joined.translate(_IN_WORD), np.int8)
        step = np.diff(np.concatenate(([0], inside, [0])).astype(np.int8))
        starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        sums = np.zeros(len(joined) + 1, np.uint64)
        values = np.frombuffer(joined, np.uint8).astype(np.uint64) + np.uint64(1)
        np.cumsum(values * _power_table(_M, len(joined) + 1)[:-1], out=sums[1:])
        hashes = (sums[ends] - sums[starts]) * _power_table(_INV, len(joined) + 1)[starts]
        hashes = mix(hashes ^ ((ends - starts).astype(np.uint64) << np.uint64(40)))
        begins = np.zeros(b - a + 1, np.int64)
        np.cumsum([len(p[2]) + 1 for p in parts[a:b]], out=begins[1:])
        of = np.searchsorted(begins, starts, "right") - 1
        shift = np.array([p[1] for p in parts[a:b]], np.int64)[of] - begins[of]
        found.append((hashes, np.array([p[0] for p in parts[a:b]], np.int64)[of], starts + shift, ends + shift))
    if not found:
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


class Windows:
    """The distinct windows of some items: their vocabulary, symbols by length, and the items that hold them."""

    def __init__(self, items: list[tuple[str | None, str]], width: int = WINDOW):
        self.ids = [i for i, _ in items]
        hashes, of, _, _ = words([t.encode() for _, t in items])
        self.vocabulary = np.unique(hashes)
        self.near = np.zeros(1 << 18, bool)  # most other words are told apart by 18 bits
        self.near[(self.vocabulary & np.uint64((1 << 18) - 1)).astype(np.int64)] = True
        symbols = np.searchsorted(self.vocabulary, hashes) + 1
        n = np.bincount(of, minlength=len(items))
        first = np.concatenate(([0], np.cumsum(n)))
        self.groups, self.owners = [], []
        for length in sorted({int(min(x, width)) for x in n[n > 0]}):
            of_length = np.flatnonzero(n == length if length < width else n >= width)
            starts = np.concatenate([np.arange(first[i], first[i + 1] - length + 1) for i in of_length])
            owner = np.repeat(of_length, n[of_length] - length + 1)
            rows, which = np.unique(symbols[starts[:, None] + np.arange(length)], axis=0, return_inverse=True)
            pairs = np.unique(np.stack([which.ravel(), owner], axis=1), axis=0)
            self.groups.append(rows)
            self.owners.append((np.searchsorted(pairs[:, 0], np.arange(len(rows) + 1)), pairs[:, 1]))
        self.shortest = min((g.shape[1] for g in self.groups), default=0)
        self.longest = max((g.shape[1] for g in self.groups), default=0)

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word in the vocabulary, from 1; 0 for others."""
        out = np.zeros(len(hashes), np.int64)
        if len(self.vocabulary):
            maybe = np.flatnonzero(self.near[(hashes & np.uint64((1 << 18) - 1)).astype(np.int64)])
            at = np.searchsorted(self.vocabulary, hashes[maybe])
            at[at == len(self.vocabulary)] = 0
            same = self.vocabulary[at] == hashes[maybe]
            out[maybe[same]] = at[same] + 1
        return out


class Wavelet:
    """Rank of any symbol in a sequence: one bit vector a level, zeros before ones."""

    def __init__(self, values: np.ndarray, depth: int):
        self.n, self.levels = len(values), []
        for bit in reversed(range(depth)):
            one = (values >> bit) & 1
            packed = np.zeros((self.n // 64 + 1) * 8, np.uint8)
            bits = np.packbits(one.astype(np.uint8), bitorder="little")
            packed[: len(bits)] = bits
            blocks = packed.view(np.uint64)
            before = np.concatenate(([0], np.cumsum(np.bitwise_count(blocks), dtype=np.int64)))
            self.levels.append((bit, blocks, before, self.n - int(before[-1])))
            values = np.concatenate([values[one == 0], values[one == 1]])
        self.start = self._down(np.arange(1 << depth), np.zeros(1 << depth, np.int64))

    @staticmethod
    def _ones(blocks: np.ndarray, before: np.ndarray, i: np.ndarray) -> np.ndarray:
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return before[i >> 6] + np.bitwise_count(blocks[i >> 6] & mask)

    def _down(self, symbols: np.ndarray, i: np.ndarray) -> np.ndarray:
        for bit, blocks, before, zeros in self.levels:
            ones = self._ones(blocks, before, i)
            i = np.where((symbols >> bit) & 1 == 1, zeros + ones, i - ones)
        return i

    def rank(self, symbols: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol comes before place i."""
        return self._down(symbols, i) - self.start[symbols]

    def symbol_and_rank(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at place i and its rank there."""
        symbols = np.zeros(len(i), np.int64)
        for bit, blocks, before, zeros in self.levels:
            one = ((blocks[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64)
            ones = self._ones(blocks, before, i)
            symbols |= one << bit
            i = np.where(one == 1, zeros + ones, i - ones)
        return symbols, i - self.start[symbols]


def suffix_order(sequence: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order; separators (0) are the least symbols, each less than all later ones."""
    n = len(sequence)
    gap = sequence == 0
    rank = np.where(gap, np.cumsum(gap) - 1, sequence + gap.sum())
    step = 1
    while True:
        after = np.zeros(n, np.int64)
        after[:-step] = rank[step:] + 1
        rank = np.unique(rank * (n + 1 + int(rank.max())) + after, return_inverse=True)[1]
        if rank.max() == n - 1:
            order = np.empty(n, np.int64)
            order[rank] = np.arange(n)
            return order
        step *= 2


class FmIndex:
    """Backward search and places in a sequence of symbols, whose stretches each end with a 0."""

    def __init__(self, sequence: np.ndarray, n_symbols: int):
        order = suffix_order(sequence)
        last = sequence[order - 1]
        self.wavelet = Wavelet(last, max(1, int(n_symbols).bit_length()))
        self.less = np.concatenate(([0], np.cumsum(np.bincount(sequence, minlength=n_symbols + 1))))
        # No walk goes across a separator: the first place of every stretch is sampled.
        sampled = (order % SAMPLED == 0) | (last == 0)
        self.sampled, self.nth, self.places = sampled, np.cumsum(sampled) - 1, order[sampled]
        self.n = len(sequence)

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of each pattern that occurs, and its range of suffixes."""
        which = np.arange(len(patterns))
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        for column in reversed(range(patterns.shape[1])):
            symbols = patterns[which, column]
            low = self.less[symbols] + self.wavelet.rank(symbols, low)
            high = self.less[symbols] + self.wavelet.rank(symbols, high)
            found = low < high
            which, low, high = which[found], low[found], high[found]
        return which, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the sequence of these rows of the suffix order."""
        rows, out, steps = rows.copy(), np.zeros(len(rows), np.int64), 0
        todo = np.arange(len(rows))
        while len(todo):
            at = rows[todo]
            here = self.sampled[at]
            out[todo[here]] = self.places[self.nth[at[here]]] + steps
            todo = todo[~here]
            symbols, rank = self.wavelet.symbol_and_rank(rows[todo])
            rows[todo] = self.less[symbols] + rank
            steps += 1
        return out


def _pieces(start: np.ndarray, end: np.ndarray, overlap: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Stretches in groups of at most SHARD_WORDS words; longer ones are cut with an overlap."""
    cut = [(s, e) for s, e in zip(start.tolist(), end.tolist(), strict=True)]
    if (end - start > SHARD_WORDS).any():
        cut = [(a, min(e, a + SHARD_WORDS)) for s, e in cut for a in range(s, max(s + 1, e - overlap), SHARD_WORDS - overlap)]
    for a, b in byte_slices([e - s + 1 for s, e in cut], SHARD_WORDS):
        yield tuple(np.array(x, np.int64) for x in zip(*cut[a:b], strict=True))


def shard_hits(texts: list[bytes], windows: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, tuple]:
    """Occurrences of windows in the texts of a shard.

    Words per text; (text, first word, word after the last) of every merged range; (text, item) pairs; and
    the words as `words` gives them.
    """
    found = words(texts)
    hashes, of = found[:2]
    n_words = np.bincount(of, minlength=len(texts))
    ranges, pairs = [np.zeros((0, 2), np.int64)], [np.zeros((0, 2), np.int64)]
    if windows.groups and len(hashes):
        symbols = windows.symbols(hashes)
        new = np.ones(len(symbols) + 1, bool)
        new[1:-1] = ((symbols[1:] > 0) != (symbols[:-1] > 0)) | (of[1:] != of[:-1])
        bounds = np.flatnonzero(new)
        start, end = bounds[:-1], bounds[1:]
        long_enough = (symbols[start] > 0) & (end - start >= windows.shortest)
        for s, e in _pieces(start[long_enough], end[long_enough], windows.longest - 1):
            size = e - s
            begin = np.concatenate(([0], np.cumsum(size + 1)))  # where each stretch starts in the sequence
            sequence = np.zeros(begin[-1], np.int64)
            source = np.arange(size.sum()) + np.repeat(s - (begin[:-1] - np.arange(len(s))), size)
            sequence[np.arange(size.sum()) + np.repeat(np.arange(len(s)), size)] = symbols[source]
            index = FmIndex(sequence, len(windows.vocabulary))
            for rows, (first, owner) in zip(windows.groups, windows.owners, strict=True):
                which, low, high = index.search(rows)
                for a, b in byte_slices((high - low).tolist(), SHARD_WORDS):
                    n = high[a:b] - low[a:b]
                    row = np.arange(n.sum()) + np.repeat(low[a:b] - np.concatenate(([0], np.cumsum(n)[:-1])), n)
                    place = index.locate(row)
                    stretch = np.searchsorted(begin, place, "right") - 1
                    word = place - begin[stretch] + s[stretch]
                    ranges.append(np.unique(np.stack([word, word + rows.shape[1]], axis=1), axis=0))
                    held = np.unique(np.stack([of[word], np.repeat(which[a:b], n)], axis=1), axis=0)
                    m = first[held[:, 1] + 1] - first[held[:, 1]]
                    at = np.arange(m.sum()) + np.repeat(first[held[:, 1]] - np.concatenate(([0], np.cumsum(m)[:-1])), m)
                    pairs.append(np.stack([np.repeat(held[:, 0], m), owner[at]], axis=1))
    span = np.concatenate(ranges)
    span = span[np.argsort(span[:, 0], kind="stable")]
    if len(span):
        reach = np.maximum.accumulate(span[:, 1])
        first = np.ones(len(span), bool)
        # Ranges that touch are one, but not across the end of a text.
        first[1:] = (span[1:, 0] > reach[:-1]) | (of[span[1:, 0]] != of[span[:-1, 0]])
        last = np.append(np.flatnonzero(first)[1:] - 1, len(span) - 1)
        span = np.stack([span[first, 0], reach[last]], axis=1)
    return n_words, span, np.unique(np.concatenate(pairs), axis=0), found


def _code_points(text: bytes, at: np.ndarray) -> np.ndarray:
    lead = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
    return np.concatenate(([0], np.cumsum(lead)))[at]


def _merged(old: list, new: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted([*((s["start"], s["end"]) for s in old), *new]):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


_built: dict[tuple, Windows] = {}


def _windows_of(block: list[tuple[str | None, str]], width: int) -> Windows:
    key = (width, hash(tuple(block)))
    if key not in _built:
        _built.clear()  # one block at a time
        _built[key] = Windows(block, width)
    return _built[key]


def _searched(batches: Iterator[pa.RecordBatch], block: list, width: int, text: str, first: bool) -> Iterator[pa.RecordBatch]:
    windows = _windows_of(block, width)
    names = [f.name for f in RESULT]
    for batch in batches:
        texts = [t or b"" for t in batch.column(text).cast(pa.binary()).to_pylist()]
        for a, b in byte_slices([len(t) for t in texts], SHARD_BYTES):
            part = batch.slice(a, b - a)
            n_words, span, pairs, (_, of, start, end) = shard_hits(texts[a:b], windows)
            of_text = np.concatenate(([0], np.cumsum(n_words)))
            own = np.searchsorted(of[span[:, 0]], np.arange(b - a + 1)) if len(span) else np.zeros(b - a + 1, np.int64)
            items = np.searchsorted(pairs[:, 0], np.arange(b - a + 1))
            hit_lists, span_lists, item_lists = [[] for _ in range(b - a)], [[] for _ in range(b - a)], [[] for _ in range(b - a)]
            for i in np.flatnonzero(np.diff(own)).tolist():
                these = span[own[i] : own[i + 1]]
                hit_lists[i] = list(map(tuple, (these - of_text[i]).tolist()))
                at = _code_points(texts[a + i], np.stack([start[these[:, 0]], end[these[:, 1] - 1]], axis=1))
                span_lists[i] = list(map(tuple, at.tolist()))
                ids = {windows.ids[k] for k in pairs[items[i] : items[i + 1], 1].tolist()}
                item_lists[i] = sorted(ids - {None})
            if not first:
                # Word ranges that touch are one span of text, whichever blocks they come from.
                before = [part.column(n).to_pylist() for n in names]
                for i in range(b - a):
                    if before[1][i] and hit_lists[i]:
                        hit_lists[i] = _merged(before[1][i], hit_lists[i])
                        at = np.array(hit_lists[i]) + of_text[i]
                        places = np.stack([start[at[:, 0]], end[at[:, 1] - 1]], axis=1)
                        span_lists[i] = list(map(tuple, _code_points(texts[a + i], places).tolist()))
                    elif before[1][i]:
                        hit_lists[i] = [(s["start"], s["end"]) for s in before[1][i]]
                        span_lists[i] = [(s["start"], s["end"]) for s in before[2][i]]
                    item_lists[i] = sorted({*before[3][i], *item_lists[i]})
            kept = [n for n in part.schema.names if n not in names]
            pair = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            columns = [pa.array(n_words, pa.int64()), pa.array(hit_lists, pair), pa.array(span_lists, pair)]
            columns.append(pa.array(item_lists, pa.list_(pa.string())))
            yield pa.RecordBatch.from_arrays([*(part.column(n) for n in kept), *columns], [*kept, *names])


def item_blocks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[str | None, str]]]:
    """The items as (id, text), in blocks of about BLOCK_BYTES of text by hash."""
    items = benchmark.select(F.col(item_id).cast("string").alias("id"), F.col(text).alias("t")).filter("t is not null")
    n_bytes = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n_blocks = -(-n_bytes // BLOCK_BYTES)
    for k in range(n_blocks):
        block = items.filter(F.pmod(F.xxhash64("id", "t"), F.lit(n_blocks)) == k)
        yield [(r.id, r.t) for r in block.distinct().orderBy("id", "t").collect()]


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, keep: list[str], text: str = "text", item_id: str = "item_id", width: int = WINDOW
) -> DataFrame:
    """The columns in `keep`, the number of words, hit word ranges, their spans of text, and the ids of the items found."""
    if set(keep) & {f.name for f in RESULT}:
        raise ValueError("a column has the name of a result")
    kept = [docs.select(f"`{c}`").schema.fields[0] for c in keep]
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("_leak_text"))
    source = rows.schema.fields[-1]
    done = 0
    for block in item_blocks(benchmark, item_id, "text"):
        if done:
            rows = materialize(rows)  # one block's windows at a time on an executor
        schema = T.StructType([*kept, source, *RESULT])
        rows = rows.mapInArrow(partial(_searched, block=block, width=width, text="_leak_text", first=not done), schema)
        done += 1
    if not done:
        none = partial(_searched, block=[], width=width, text="_leak_text", first=True)
        rows = rows.mapInArrow(none, T.StructType([*kept, source, *RESULT]))
    return rows.drop("_leak_text")


def without_spans(text, spans):
    """The text with its spans cut out, as a column expression."""
    start = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["end"]))
    end = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.length(text)))
    return F.array_join(F.transform(F.arrays_zip(start.alias("a"), end.alias("b")), lambda s: F.substring(text, s["a"] + 1, s["b"] - s["a"])), "")
