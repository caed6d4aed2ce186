"""Token alignment against tokens of whole texts, overlaps and counts taken one by one."""

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tracewright.llm import token_align as ta
from tracewright.llm.bpe import byte_letters

A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def texts():
    rng = random.Random(2)
    odd = [
        "", None, " ", "  ", " a", "a ", "a  b", "a\n b", "a \n b", "\t\tx y\r\n z", "x" * 3000, "日本語 テキスト 😀", "a b   c d e f",
        "▁x", "a ▁ b", "<s> </s> <unk> <0x41> <|endoftext|> hi", "é é ﬁ", "don't we'll I'd 're ' s", "\x00 a\x00b",
        "a\x1cb \x1c c", "a​b ‍ c﻿ d", "1 22 333 4,444.5", "  indent\n    more  \n\n\nend", "\x85 x \x85y",
        "a　b", "foo   bar    baz     ", " " * 200_000 + "x y", "\n " * 3000 + "z", "ß ẞ ı İ", "   x  y z",
    ]
    letters = list("ab ' \n\té日😀1. \xa0\x1c ​▁<s>")
    odd += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 25))) for _ in range(600)]
    prose = [" ".join("".join(rng.choices("aehinrst", k=rng.randint(1, 8))) for _ in range(rng.randint(1, 200))) for _ in range(80)]
    odd += prose + prose[:9]
    return list(enumerate(odd))


def by_hand(docs):
    tok, sp = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    tok.encode_special_tokens = True
    byte = {c: b for b, c in enumerate(byte_letters())}
    aligned, documents, out = [], collections.Counter(), []
    for i, text in docs:
        whole, row = (" " + (text or "")).encode(), None
        if text:
            a, b = tok.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
            bytes_a = [bytes(byte[c] for c in tok.id_to_token(x)) for x in a]
            bytes_b = [bytes([int(sp.id_to_piece(x)[3:5], 16)]) if sp.is_byte(x) else sp.id_to_piece(x).replace("▁", " ").encode() for x in b]
            if b"".join(bytes_a) == whole == b"".join(bytes_b):
                ends_a, ends_b = (np.cumsum([len(x) for x in y]).tolist() for y in (bytes_a, bytes_b))
                cuts, groups, links, p, q = sorted({*ends_a} & {*ends_b}), [], [], 0, 0
                for cut in cuts:
                    r, s = p, q
                    while r < len(a) and ends_a[r] <= cut:
                        r += 1
                    while s < len(b) and ends_b[s] <= cut:
                        s += 1
                    groups.append(",".join(map(str, a[p:r])) + "|" + ",".join(map(str, b[q:s])))
                    for x in range(p, r):
                        for y in range(q, s):
                            start_a, start_b = ends_a[x] - len(bytes_a[x]), ends_b[y] - len(bytes_b[y])
                            if start_a < ends_b[y] and start_b < ends_a[x]:
                                links.append((a[x], b[y]))
                    p, q = r, s
                row = (len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest())
                documents.update(set(links))
        aligned.append((i, row))
    most = collections.Counter()
    for (a, _), n in documents.items():
        most[a] = max(most[a], n)
    for i, row in aligned:
        if row is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
        else:
            n_best = sum(documents[x] == most[x[0]] for x in row[3])
            out.append((i, *row[:3], len(row[3]), n_best, sum(documents[x] for x in row[3]), row[4]))
    return out, documents, [r for _, r in aligned]


def test_documents_and_pair_counts(spark):
    docs = texts()
    want, documents, rows = by_hand(docs)
    table = spark.createDataFrame([(i, t, 7) for i, t in docs], "doc_id bigint, text string, _bit int").repartition(3)
    found = ta.align(table, A, B, ["doc_id", "_bit"]).collect()
    columns = ["doc_id", *[f"_{c}" for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")]]
    assert sorted(tuple(r[c] for c in columns) for r in found) == want
    assert {r._bit for r in found} == {7}
    counts = ta.pair_counts(ta.aligned(table, A, B, ["doc_id"])[1]).collect()
    assert {(r._a, r._b): r._docs for r in counts} == documents
    links = collections.Counter(x for r in rows if r for x in r[3])
    assert {(r._a, r._b): r._links for r in counts} == links


def test_bitmaps_of_any_density():
    rng = np.random.default_rng(4)
    place, key, links = [], [], []
    for k, n in enumerate([1, 2, 255, 256, 257, ta.BLOCK]):
        place.append(rng.choice(ta.BLOCK, n, replace=False))
        key.append(np.full(n, k))
        links.append(rng.integers(1, 1000, n))
    want = collections.Counter()
    for k, p, n in zip(np.concatenate(key), np.concatenate(place), np.concatenate(links), strict=True):
        want[int(k), int(p)] += int(n)
    got = collections.Counter()
    for plane, keys, n, bits in ta.bitmaps(np.concatenate(place), np.concatenate(key), np.concatenate(links)):
        row, at = ta.set_places(bits, n)
        for r, p in zip(row.tolist(), at.tolist(), strict=True):
            got[int(keys[r]), p] += int(ta.weight(np.array(plane)))
    assert got == want


def test_pieces_are_forgotten_and_blocks_close(monkeypatch):
    pair = ta.Pair(A, B)
    monkeypatch.setattr(ta, "KNOWN_PIECES", 1)
    for _ in range(2):
        for text in ("some words here", "other words", "x" * 100 + " y"):
            numbers = pair.numbers([text])
            assert ";".join(pair.groups[i] for i in numbers[0]).count("|") == pair.sizes[numbers[0], 2].sum()
    assert len(pair.known) < 6


def test_empty_table_and_clashing_names(spark):
    d = spark.createDataFrame([], "doc_id bigint, text string")
    assert ta.align(d, A, B, ["doc_id"]).count() == 0
    with pytest.raises(ValueError):
        ta.align(d.withColumn("_block", F.lit(1)), A, B, ["doc_id", "_block"])
