"""BPE encoding and decoding with a published vocabulary file, by batched numpy merge rounds.

Texts are cut into words as the file's normalizer and pre-tokenizer say (NFC, lower case, one regular
expression, bytes as printable characters, a mark on the last one). The distinct words of a
batch that are not known yet lie in one flat array of symbols. In every round a binary search over
the sorted pair keys gives the rank of each neighbouring pair, every word merges all its
lowest-ranked pairs from left to right, and words without a pair leave the array.

Only files of this kind are read: BPE without unknown token, a word-end suffix, the pre-tokenizer
sequence Split + ByteLevel, and no decoder (tokens are joined by a space). Anything else raises.

Defined cases: a null or empty text has no tokens and decodes to the empty text; strings of special
tokens in a text become those tokens; a word of any length is encoded whole; repeated rows give the
same ids each; a null id list decodes to the empty text; other columns pass through untouched.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tracewright.llm.flat import byte_slices

BATCH_BYTES = 2_000_000
KNOWN_WORDS = 300_000

# White space of the pattern syntax in which the file's expressions are written.
_SPACE = "\\t-\\r\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def byte_letters() -> list[str]:
    """The printable character that stands for each byte: itself where it is printable, else the next free one."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Pair keys, ranks and merged symbols as sorted arrays, and the tokens by id."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        kinds = [p["type"] for p in pre.get("pretokenizers", [])]
        if model["type"] != "BPE" or kinds != ["Split", "ByteLevel"] or spec["decoder"] is not None:
            raise ValueError("not a vocabulary of the kind that is supported")
        if any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback")):
            raise ValueError("not a vocabulary of the kind that is supported")
        self.suffix = model["end_of_word_suffix"]
        ids = model["vocab"]
        self.size = 1 + max([*ids.values(), *(t["id"] for t in spec["added_tokens"])])
        self.tokens = [""] * self.size
        for token, i in ids.items():
            self.tokens[i] = token
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for token, i in self.special.items():
            self.tokens[i] = token
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([ids[a] * self.size + ids[b] for a, b in pairs], np.int64)
        merged = np.array([ids[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.merged = keys[order], order.astype(np.int64), merged[order]
        letters = byte_letters()
        self.inner = np.array([ids[c] for c in letters], np.int64)
        self.final = np.array([ids[c + self.suffix] for c in letters], np.int64)
        self.splits = re.compile("(" + "|".join(re.escape(t) for t in self.special) + ")") if self.special else None
        pattern = pre["pretokenizers"][0]["pattern"]["Regex"].replace("\\s", _SPACE)
        self.words = regex.compile(pattern)
        self.ascii_words = re.compile(pattern.replace("\\p{L}", "a-z").replace("\\p{N}", "0-9"), re.ASCII)

    def merge(self, words: list[str]) -> list[np.ndarray]:
        """The ids of each word; no word is empty."""
        data = [w.encode("utf-8") for w in words]
        lengths = np.array([len(d) for d in data], np.int64)
        raw = np.frombuffer(b"".join(data), np.uint8)
        symbols, of = self.inner[raw], np.repeat(np.arange(len(words)), lengths)
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self.final[raw[ends]]
        result: list[np.ndarray | None] = [None] * len(words)
        none = np.iinfo(np.int64).max
        while len(symbols):
            same = of[1:] == of[:-1]
            keys = symbols[:-1] * self.size + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            ranks = np.where(same & (self.keys[at] == keys), self.ranks[at], none)
            starts = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
            padded = np.concatenate((ranks, [none]))
            lowest = np.minimum.reduceat(padded, starts)
            counts = np.diff(np.concatenate((starts, [len(symbols)])))
            done = lowest == none
            if done.any():
                for k in np.flatnonzero(done):
                    result[of[starts[k]]] = symbols[starts[k] : starts[k] + counts[k]]
                stay = np.repeat(~done, counts)
                symbols, of, padded = symbols[stay], of[stay], padded[stay]
                at = np.concatenate((at, [0]))[stay]
                lowest, counts = lowest[~done], counts[~done]
            else:
                at = np.concatenate((at, [0]))
            if not len(symbols):
                break
            hit = padded == np.repeat(lowest, counts)
            # Of pairs that overlap (a run of one symbol) every other one counts, from the left.
            places = np.flatnonzero(hit)
            run = np.concatenate(([True], np.diff(places) != 1))
            within = np.arange(len(places)) - np.flatnonzero(run)[np.cumsum(run) - 1]
            places = places[within % 2 == 0]
            symbols[places] = self.merged[at[places]]
            keep = np.ones(len(symbols), bool)
            keep[places + 1] = False
            symbols, of = symbols[keep], of[keep]
        return result

    def pieces(self, text: str) -> list[str | int]:
        """Words in order, and special tokens as ids."""
        if self.splits is None or "<" not in text:
            return self._cut(text)
        out: list[str | int] = []
        for part in self.splits.split(text):
            out.extend([self.special[part]] if part in self.special else self._cut(part))
        return out

    def _cut(self, text: str) -> list[str]:
        if text.isascii():
            return self.ascii_words.findall(text.lower())
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return self.words.findall(text)


_loaded: dict[str, tuple[Vocabulary, dict]] = {}


def _vocabulary(path: str) -> tuple[Vocabulary, dict]:
    """The vocabulary of a file and the words encoded so far, once per Python worker."""
    if path not in _loaded:
        vocabulary = Vocabulary(path)
        _loaded[path] = vocabulary, {i: [i] for i in vocabulary.special.values()}
    return _loaded[path]


def encode_texts(path: str, texts: list[str]) -> list[np.ndarray]:
    vocabulary, known = _vocabulary(path)
    if len(known) > KNOWN_WORDS:
        known.clear()
        known.update({i: [i] for i in vocabulary.special.values()})
    pieces = [vocabulary.pieces(t) for t in texts]
    new = list(set().union(*pieces).difference(known))
    if new:
        known.update(zip(new, (ids.tolist() for ids in vocabulary.merge(new)), strict=True))
    out = []
    for words in pieces:
        ids: list[int] = []
        for part in map(known.__getitem__, words):
            ids += part
        out.append(np.array(ids, np.int32))
    return out


def _encoded(batches: Iterator[pa.RecordBatch], path: str, text: str, ids: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0).to_pylist()
        for a, b in byte_slices(sizes, BATCH_BYTES):
            part = batch.slice(a, b - a)
            arrays = encode_texts(path, [t or "" for t in part.column(text).to_pylist()])
            offsets = np.zeros(len(arrays) + 1, np.int32)
            np.cumsum([len(x) for x in arrays], out=offsets[1:])
            column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays)))
            names = [n for n in part.schema.names if n != text]
            yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), column], [*names, ids])


def _decoded(batches: Iterator[pa.RecordBatch], path: str, ids: str, text: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        token = _vocabulary(path)[0].tokens.__getitem__
        for a in range(0, batch.num_rows, 512):
            part = batch.slice(a, 512)
            texts = [" ".join(map(token, x or ())) for x in part.column(ids).to_pylist()]
            names = part.schema.names
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*names, text])


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """The documents with the token ids in place of the text column; `ids` must not be another column's name."""
    fields = [f for f in docs.schema.fields if f.name != text]
    schema = T.StructType([*fields, T.StructField(ids, T.ArrayType(T.IntegerType()))])
    return docs.mapInArrow(lambda batches: _encoded(batches, path, text, ids), schema)


def decode(docs: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """The documents and the text of their token ids."""
    schema = T.StructType([*docs.schema.fields, T.StructField(text, T.StringType())])
    return docs.mapInArrow(lambda batches: _decoded(batches, path, ids, text), schema)
