"""Alignment of two tokenizers' tokens, with corpus-wide pair counts from inverted bitmaps.

A text with a leading space is cut before single spaces between other characters. No token of either vocabulary
goes across such a cut, which `Pair` checks when it loads the files, so the distinct pieces of a worker are
encoded and aligned once, and a document is put together from its pieces.

An (A id, B id) pair that overlaps somewhere is inverted: documents are numbered, `BLOCK` of them make a
block, and each pair has per block a compressed bitmap of the documents that hold it, as sorted
16-bit numbers where that is shorter. Further bitmaps, the multiplicity planes, hold the bits of (links of the pair in
the document - 1). Bitmaps of parts of a block are OR-merged; counts of set bits give the number of documents and, with
the planes' weights, of links. The counts go back to the bitmaps by a join on the pair, and each
block's postings then add them up per document.

Two shuffles move bitmaps, by pair and by block; a pair that is everywhere has one row per block and plane, which
are counted before they are shuffled, and its join is cut by the adaptive skew join. A block is at most
`BLOCK` documents; postings in memory are at most about `POSTINGS` at a time.

Defined cases: null and empty texts, and those that a tokenizer does not give back byte by byte, have no
tokens and no links; repeated rows each count as a document; a null id is returned like others;
columns in `keep` must not bear the names of `RESULT`; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewright.llm.bpe import byte_letters
from tracewright.llm.flat import byte_slices
from tracewright.session import materialize

BLOCK = 4096
POSTINGS = 2_000_000
SLICE_BYTES = 2_000_000
KNOWN_PIECES = 500_000
LONG_PIECE = 64
ENCODED_AT_ONCE = 30_000
# Fixed value: how the byte-level files cut texts into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

RESULT = [
    *[T.StructField(name, T.LongType()) for name in ("_n_a", "_n_b", "_n_groups", "_n_links")],
    T.StructField("_groups_sha256", T.StringType()),
]
POSTING = [
    T.StructField("_block", T.LongType()),
    T.StructField("_place", T.IntegerType()),
    T.StructField("_a", T.IntegerType()),
    T.StructField("_b", T.IntegerType()),
    T.StructField("_plane", T.IntegerType()),
    T.StructField("_n", T.IntegerType()),
    T.StructField("_bits", T.BinaryType()),
]

_CUT = re.compile(r"(?<=\S) (?=\S)")
_LONG_WHITE = re.compile(r"\s{10000}")
_UNEVEN = re.compile(r"\s |  | \s|\A\s|\s\Z")


class Pair:
    """Both tokenizers, and the pieces aligned so far."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        import tiktoken

        self.path_a = path_a
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        pre, vocab = spec["pre_tokenizer"], spec["model"]["vocab"]
        merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in spec["model"]["merges"]]
        plain = spec["normalizer"] is None and pre["type"] == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]
        if not plain or merged != sorted(merged):
            raise ValueError("not a byte-level vocabulary whose ids follow its merges")
        letters = {c: b for b, c in enumerate(byte_letters())}
        ranks = {bytes(letters[c] for c in token): i for token, i in vocab.items() if all(c in letters for c in token)}
        for token in spec["added_tokens"]:
            ranks.pop(token["content"].encode(), None)  # such strings are plain text here
        self.a = tiktoken.Encoding("a", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, i in ranks.items():
            self.bytes_a[i] = token
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        if any(re.search(r"\S ", t.decode(errors="replace")) for t in self.bytes_a + self.bytes_b):
            raise ValueError("tokens of these files go across single spaces")
        self.length_a, self.length_b = (np.array([len(t) for t in x]) for x in (self.bytes_a, self.bytes_b))
        self.written = {
            mark: np.array([f"{i}{mark}" for i in range(max(len(self.bytes_a), len(self.bytes_b)))], object) for mark in ",|;"
        }
        self._empty()

    def _empty(self) -> None:
        self.known: dict[str, int] = {}
        self.groups: list[str | None] = []
        self.sizes = np.zeros((0, 4), np.int64)  # tokens of A, tokens of B, groups, links
        self.first_link = np.zeros(1, np.int64)
        self.links = np.zeros(0, np.int64)  # A id << 32 | B id

    def _encode_a(self, text: str) -> list[int]:
        if not _LONG_WHITE.search(text):
            return self.a.encode_ordinary(text)
        from tokenizers import Tokenizer  # slower, but its expressions need no stack

        plain = Tokenizer.from_file(self.path_a)
        plain.encode_special_tokens = True
        return plain.encode(text, add_special_tokens=False).ids

    def _align(self, pieces: list[str]) -> list[tuple[list[str | None], np.ndarray, np.ndarray]]:
        """(groups, sizes, links) of the pieces, in runs; the pieces are encoded as one text, which each of them begins with a space."""
        text = "".join(pieces)
        a, b = np.array(self._encode_a(text), np.int64), np.array(self.b.encode(text[1:]), np.int64)
        whole = text.encode()
        same = all(b"".join(map(t.__getitem__, x.tolist())) == whole for t, x in ((self.bytes_a, a), (self.bytes_b, b)))
        if not same:
            if len(pieces) == 1:
                return [([None], np.zeros((1, 4), np.int64), np.zeros(0, np.int64))]
            half = len(pieces) // 2
            return self._align(pieces[:half]) + self._align(pieces[half:])
        end_a, end_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        cut = np.intersect1d(end_a, end_b, assume_unique=True)
        group_a, group_b = np.searchsorted(cut, end_a), np.searchsorted(cut, end_b)
        closes_a, closes_b = cut[group_a] == end_a, cut[group_b] == end_b
        # A token of A overlaps a run of tokens of B.
        first = np.searchsorted(end_b, end_a - self.length_a[a], "right")
        n = np.searchsorted(end_b, end_a) - first + 1
        links = np.repeat(a, n) << 32 | b[_spread(first, n)]
        ends = np.cumsum([len(p.encode()) for p in pieces])
        own = np.searchsorted(ends, end_a)
        counts = [np.bincount(x, minlength=len(pieces)) for x in (own, np.searchsorted(ends, end_b), np.searchsorted(ends, cut))]
        counts.append(np.bincount(own, n, minlength=len(pieces)).astype(np.int64))
        written = np.concatenate([
            np.where(closes_a, self.written["|"][a], self.written[","][a]),
            np.where(closes_b, self.written[";"][b], self.written[","][b]),
        ])
        written = written[np.argsort(np.concatenate([group_a * 2, group_b * 2 + 1]), kind="stable")].tolist()
        stop = np.cumsum(counts[0] + counts[1]).tolist()
        groups = ["".join(written[x:y])[:-1] for x, y in zip([0, *stop], stop, strict=False)]
        return [(groups, np.stack(counts, axis=1), links)]

    def learn(self, pieces: list[str]) -> None:
        # Joined pieces must not bring white space together; only the first and the last of a text can.
        ragged = [p for p in pieces if p[1].isspace() or p[-1].isspace()]
        smooth = [p for p in pieces if not (p[1].isspace() or p[-1].isspace())]
        pieces = smooth + ragged
        parts = []
        for lo, hi in byte_slices([len(p) for p in smooth], ENCODED_AT_ONCE):
            parts += self._align(smooth[lo:hi])
        for piece in ragged:
            parts += self._align([piece])
        self.known.update(zip(pieces, range(len(self.groups), len(self.groups) + len(pieces)), strict=True))
        for groups, _, _ in parts:
            self.groups += groups
        self.sizes = np.concatenate([self.sizes, *(p[1] for p in parts)])
        self.first_link = np.concatenate(([0], np.cumsum(self.sizes[:, 3])))
        self.links = np.concatenate([self.links, *(p[2] for p in parts)])

    def numbers(self, texts: list[str]) -> list[np.ndarray]:
        """The numbers of the pieces of each text, in order."""
        if len(self.known) > KNOWN_PIECES or len(self.links) > 20 * KNOWN_PIECES:
            self._empty()
        cut = [pieces_of(t) for t in texts]
        new = list(set().union(*cut).difference(self.known))
        if new:
            self.learn(new)
        out = [np.fromiter(map(self.known.__getitem__, c), np.int64, len(c)) for c in cut]
        for piece in new:  # long ones are not kept
            if len(piece) > LONG_PIECE:
                del self.known[piece]
        return out


def pieces_of(text: str) -> list[str]:
    """The text with its leading space, cut before single spaces between other characters."""
    if not text:
        return []
    cut = _CUT.split(text) if _UNEVEN.search(text) else text.split(" ")
    return [" " + c for c in cut]


_loaded: dict[tuple[str, str], Pair] = {}


def _pair(path_a: str, path_b: str) -> Pair:
    if (path_a, path_b) not in _loaded:
        _loaded[path_a, path_b] = Pair(path_a, path_b)
    return _loaded[path_a, path_b]


def _spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of each run, one after another."""
    return np.arange(size.sum()) + np.repeat(first - np.concatenate(([0], np.cumsum(size)[:-1])), size)


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(values[order], first) if len(first) else values[:0]


def document_links(numbers: list[np.ndarray], pair: Pair) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, pair key, links) of every pair that a document holds."""
    of = np.repeat(np.arange(len(numbers)), [len(x) for x in numbers])
    held, times = np.unique(of << 32 | np.concatenate(numbers), return_counts=True)
    piece = held & 0xFFFFFFFF
    size = pair.sizes[piece, 3]
    keys = pair.links[_spread(pair.first_link[piece], size)]
    n, doc = np.repeat(times, size), np.repeat(held >> 32, size)
    # Pair keys have more bits than fit beside a document: they are numbered first.
    distinct, key = np.unique(keys, return_inverse=True)
    both, n = _summed(doc * max(1, len(distinct)) + key, n)
    return both // max(1, len(distinct)), distinct[both % max(1, len(distinct))], n


def _plane(plane: int, place: np.ndarray, key: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, pa.Array]]:
    if not len(place):
        return
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    size = np.diff(np.append(first, len(key)))
    dense = size * 2 >= BLOCK // 8
    thin = np.repeat(~dense, size)
    offsets = np.concatenate(([0], np.cumsum(size[~dense] * 2))).astype(np.int32)
    buffers = [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(place[thin].astype("<u2").tobytes())]
    yield plane, key[first[~dense]], size[~dense], pa.Array.from_buffers(pa.binary(), int((~dense).sum()), buffers)
    for some in np.array_split(np.flatnonzero(dense), int(dense.sum()) // 4096 + 1):
        bits = np.zeros((len(some), BLOCK // 8), np.uint8)
        row, at = np.repeat(np.arange(len(some)), size[some]), place[_spread(first[some], size[some])]
        np.bitwise_or.at(bits, (row, at >> 3), (1 << (at & 7)).astype(np.uint8))
        yield plane, key[first[some]], size[some], pa.array([r.tobytes() for r in bits], pa.binary())


def bitmaps(place: np.ndarray, key: np.ndarray, links: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, pa.Array]]:
    """(plane, pair keys, set bits, bitmaps) of a block: plane 0 holds the documents, plane j bit j - 1 of links - 1."""
    order = np.lexsort((place, key))
    place, key, more = place[order], key[order], links[order] - 1
    yield from _plane(0, place, key)
    plane = 1
    while more.any():
        has = more & 1 == 1
        yield from _plane(plane, place[has], key[has])
        some = more > 1
        place, key, more, plane = place[some], key[some], more[some] >> 1, plane + 1


def weight(plane: np.ndarray) -> np.ndarray:
    """Links that a set bit of the plane stands for."""
    return np.where(plane == 0, 1, 1 << np.maximum(plane - 1, 0))


def set_places(bits: pa.Array, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) of all set bits."""
    size = np.asarray(pa.compute.binary_length(bits)).astype(np.int64)
    data = np.frombuffer(b"".join(bits.to_pylist()), np.uint8)
    start = np.concatenate(([0], np.cumsum(size)[:-1])) if len(size) else size
    thin, dense = np.flatnonzero(2 * n < BLOCK // 8), np.flatnonzero(2 * n >= BLOCK // 8)
    low = data[_spread(start[thin], size[thin])].view("<u2").astype(np.int64)
    row, place = np.nonzero(np.unpackbits(data[_spread(start[dense], size[dense])].reshape(-1, BLOCK // 8), axis=1, bitorder="little"))
    return np.concatenate([np.repeat(thin, n[thin]), dense[row]]), np.concatenate([low, place])


def _aligned(batches: Iterator[pa.RecordBatch], path_a: str, path_b: str, keep: list[str], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    pair, partition = _pair(path_a, path_b), TaskContext.get().partitionId()
    block, filled, held, parts = partition << 32, 0, 0, []

    def batch_of(n: int, columns: dict[str, pa.Array]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)) for f in schema], schema=schema)

    def closed() -> Iterator[pa.RecordBatch]:
        if parts:
            for plane, key, n, bits in bitmaps(*(np.concatenate(x) for x in zip(*parts, strict=True))):
                for at in range(0, len(key), 10_000):
                    k, piece = key[at : at + 10_000], bits.slice(at, 10_000)
                    yield batch_of(len(k), {
                        "_block": pa.array(np.full(len(k), block)), "_a": pa.array(k >> 32, pa.int32()),
                        "_b": pa.array(k & 0xFFFFFFFF, pa.int32()), "_plane": pa.array(np.full(len(k), plane, np.int32)),
                        "_n": pa.array(n[at : at + 10_000], pa.int32()), "_bits": piece,
                    })

    for batch in batches:
        texts = [t or "" for t in batch.column("_text").to_pylist()]
        for a, b in byte_slices([len(t) for t in texts], SLICE_BYTES):
            for lo in range(a, b, BLOCK):
                hi = min(b, lo + BLOCK)
                numbers = pair.numbers(texts[lo:hi])
                digests = []
                for i, x in enumerate(numbers):
                    groups = list(map(pair.groups.__getitem__, x.tolist()))
                    if not groups or None in groups:
                        numbers[i] = x[:0]
                        digests.append("")
                    else:
                        digests.append(hashlib.sha256(";".join(groups).encode()).hexdigest())
                size = np.array([len(x) for x in numbers])
                flat = np.concatenate(numbers)
                sums = np.zeros((len(flat) + 1, 4), np.int64)
                np.cumsum(pair.sizes[flat], axis=0, out=sums[1:])
                ends = np.cumsum(size)
                totals = sums[ends] - sums[ends - size]
                doc, key, links = document_links(numbers, pair)
                if filled and (filled + hi - lo > BLOCK or held + len(doc) > POSTINGS):
                    yield from closed()
                    block, filled, held, parts = block + 1, 0, 0, []
                parts.append((doc + filled, key, links))
                rows = batch.slice(lo, hi - lo)
                columns = {k: rows.column(k) for k in keep} | {
                    f.name: pa.array(totals[:, i]) for i, f in enumerate(RESULT[:4])
                }
                columns["_groups_sha256"] = pa.array(digests, pa.string())
                columns["_block"] = pa.array(np.full(hi - lo, block))
                columns["_place"] = pa.array(np.arange(filled, filled + hi - lo), pa.int32())
                yield batch_of(hi - lo, columns)
                filled, held = filled + hi - lo, held + len(doc)
    yield from closed()


def aligned(docs: DataFrame, path_a: str, path_b: str, keep: list[str], text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Rows of documents with their place in a block, and the bitmaps of their pairs; both written once."""
    from pyspark.sql.pandas.types import to_arrow_schema

    names = [f.name for f in RESULT + POSTING]
    if set(keep) & {*names, "_text"}:
        raise ValueError("a column has the name of a result")
    kept = [T.StructField(c, docs.select(f"`{c}`").schema.fields[0].dataType) for c in keep]
    schema = T.StructType([*kept, *RESULT, *POSTING])
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("_text"))
    work = partial(_aligned, path_a=path_a, path_b=path_b, keep=keep, schema=to_arrow_schema(schema))
    table = materialize(rows.mapInArrow(work, schema))
    documents = table.filter("_place IS NOT NULL").select(*keep, *[f.name for f in RESULT], "_block", "_place")
    return documents, table.filter("_a IS NOT NULL").select("_block", "_a", "_b", "_plane", "_n", "_bits")


def pair_counts(bits: DataFrame) -> DataFrame:
    """(_a, _b, _docs, _links, _best): documents and links of every pair; _best where no other pair of the A id has more documents."""
    links = F.col("_n") * F.expr("shiftleft(1L, greatest(_plane - 1, 0))")
    docs = F.sum(F.when(F.col("_plane") == 0, F.col("_n")).otherwise(0))
    counts = materialize(bits.groupBy("_a", "_b").agg(docs.alias("_docs"), F.sum(links).alias("_links")))
    most = counts.groupBy("_a").agg(F.max("_docs").alias("_most"))
    return counts.join(most, "_a").select("_a", "_b", "_docs", "_links", (F.col("_docs") == F.col("_most")).alias("_best"))


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def closed(block: int, sums: np.ndarray, best: np.ndarray) -> pa.RecordBatch:
        at = np.flatnonzero(sums)
        columns = [np.full(len(at), block), at.astype(np.int32), best[at], sums[at]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["_block", "_place", "_n_best", "_count_sum"])

    now, sums, best = None, np.zeros(BLOCK, np.int64), np.zeros(BLOCK, np.int64)
    for batch in batches:
        blocks = np.asarray(batch.column("_block"))
        cut = np.flatnonzero(np.append(True, blocks[1:] != blocks[:-1])) if len(blocks) else []
        for lo, hi in zip(cut, [*cut[1:], len(blocks)], strict=True):
            if now != blocks[lo]:
                if now is not None:
                    yield closed(now, sums, best)
                now, sums, best = blocks[lo], np.zeros(BLOCK, np.int64), np.zeros(BLOCK, np.int64)
            part = batch.slice(lo, hi - lo)
            w = weight(np.asarray(part.column("_plane")).astype(np.int64))
            row, place = set_places(part.column("_bits"), np.asarray(part.column("_n")).astype(np.int64))
            np.add.at(sums, place, (w * np.asarray(part.column("_docs")))[row])
            np.add.at(best, place, (w * np.asarray(part.column("_best").cast(pa.int64())))[row])
    if now is not None:
        yield closed(now, sums, best)


def document_scores(bits: DataFrame, counts: DataFrame) -> DataFrame:
    """(_block, _place, _n_best, _count_sum): the counts of its pairs, brought back to every document by its block's postings."""
    # Counts grow with the vocabulary in use: they are never broadcast.
    found = bits.join(counts.hint("merge"), ["_a", "_b"]).select("_block", "_plane", "_n", "_bits", "_docs", "_best")
    found = found.repartition("_block").sortWithinPartitions("_block")
    return found.mapInArrow(_scored, "_block bigint, _place int, _n_best bigint, _count_sum bigint")


def align(docs: DataFrame, path_a: str, path_b: str, keep: list[str], text: str = "text") -> DataFrame:
    """The columns in `keep`, RESULT, `_n_best` and `_count_sum` of every document."""
    documents, bits = aligned(docs, path_a, path_b, keep, text)
    scores = document_scores(bits, pair_counts(bits))
    found = documents.join(scores, ["_block", "_place"], "left")
    return found.select(*keep, *[f.name for f in RESULT], *[F.coalesce(c, F.lit(0)).alias(c) for c in ("_n_best", "_count_sum")])
