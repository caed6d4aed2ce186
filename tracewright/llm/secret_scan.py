"""Secrets in texts: fixed patterns, and strings that a character model calls random; column expressions only.

The patterns give spans of kinds assign, access and hex. Beside them two Markov models of character
pairs, one of random strings and one of ordinary identifiers, judge every other run of at least
`MIN_LENGTH` characters of keys: a run whose mean log-likelihood ratio is above `MIN_RATIO` bits a
character becomes a span of kind random. The models are trained on labelled samples: the values of
base spans are random strings, long words of documents without any are ordinary ones. Both are collected over all
documents; of each class about `SAMPLE_VALUES` distinct values are used, drawn by their hash, with all their
occurrences, so rare secrets are not thinned out by other documents. What reaches the driver are pair counts over a
fixed alphabet.

Defined cases: a null or empty text has no spans; positions are code points, ends exclusive; with fewer
than `MIN_SAMPLES` samples of either class there is no model and no span of kind random; repeated rows get
the same spans each; other columns are not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.llm.words import text_of, words_of
from tracewright.session import materialize

# Fixed patterns and their least lengths (of group 2, and of the whole match).
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 8, 16, 32
KINDS = ("assign", "access", "hex", "random")

RUN = "[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-."
SYMBOLS = len(ALPHABET) + 1  # place 0 is any other character
MIN_LENGTH = 20
MIN_RATIO = 0.8
MIN_SAMPLES = 8
MIN_WORD = 8
SAMPLE_VALUES = 100_000
SMOOTHING = 0.5
PRIOR = 8.0


def spans(text: Column, pattern: str, group: int = 0) -> Column:
    """(start, end, value) of all matches, from the lengths of matches and of the gaps between them."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    found = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), whole.alias("whole"), value.alias("value"))
    nothing = F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")
    start = F.struct(F.lit(0).cast("bigint").alias("at"), nothing.alias("out"))

    def step(state: Column, x: Column) -> Column:
        begin = state["at"] + F.length(x["gap"])
        end = begin + F.length(x["whole"])
        span = F.struct(begin.cast("bigint").alias("start"), end.cast("bigint").alias("end"), x["value"].alias("value"))
        return F.struct(end.cast("bigint").alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

    # The last gap has no match behind it.
    matched = F.filter(found, lambda x: x["whole"].isNotNull())
    return F.aggregate(matched, start, step, lambda s: s["out"])


def _none() -> Column:
    return F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")


def with_base_spans(docs: DataFrame, text: str = "text", keep: list[str] = ()) -> DataFrame:
    """`keep` columns, `_text`, and the valid spans per kind as `_assign`, `_access` and `_hex`."""
    d = docs.select(*keep, text_of(F.col(text)).alias("_text"))
    t = F.col("_text")
    sign = F.contains(t, F.lit("=")) | F.contains(t, F.lit(":"))
    assign = F.when(sign & t.rlike(ASSIGN), spans(t, ASSIGN, 2)).otherwise(_none())
    access = F.when(F.contains(t, F.lit("AKIA")), spans(t, ACCESS)).otherwise(_none())
    runs = HEX[:-1] + f"{{{MIN_HEX},}}"  # a longest run of that length is what is left of all runs
    hexes = F.when(t.rlike(runs), spans(t, runs)).otherwise(_none())
    d = d.withColumns({"_assign": assign, "_access": access, "_hex": hexes})
    return d.withColumns(
        {
            "_assign": F.filter("_assign", lambda x: F.length(x["value"]) >= MIN_ASSIGN),
            "_access": F.filter("_access", lambda x: F.length(x["value"]) >= MIN_ACCESS),
        }
    )


def _pairs(samples: DataFrame) -> DataFrame:
    """Counts of character pairs per class, and how many samples each class has."""
    n = F.length("value")
    codes = F.transform(F.sequence(F.lit(1), n), lambda i: F.instr(F.lit(ALPHABET), F.substring(F.col("value"), i, F.lit(1))))
    times = F.col("times") if "times" in samples.columns else F.lit(1).alias("times")
    rows = samples.filter(n >= 2).select("random", times, codes.alias("codes"))
    moved = F.zip_with("codes", F.slice("codes", 2, F.size("codes")), lambda a, b: a * SYMBOLS + b)
    # Entry -1 counts the sample itself.
    pairs = F.explode(F.concat(F.array(F.lit(-1)), F.filter(moved, lambda x: x.isNotNull()))).alias("pair")
    return rows.select("random", "times", pairs).groupBy("random", "pair").agg(F.sum("times").alias("n"))


def labelled_samples(docs: DataFrame, text: str = "text") -> DataFrame:
    """(random, value, times): values of base spans, and long words of documents that have none, with their occurrences."""
    d = with_base_spans(docs, text).withColumn("_base", F.concat("_assign", "_access", "_hex"))
    hits = F.transform("_base", lambda x: x["value"])
    long = F.filter(words_of(F.col("_text")), lambda w: F.length(w) >= MIN_WORD)
    words = F.transform(long, lambda w: F.regexp_extract(w, f"[A-Za-z0-9_-]{{{MIN_WORD},}}", 0))
    found = F.size("_base") > 0
    rows = d.select(found.alias("random"), F.explode(F.when(found, hits).otherwise(words)).alias("value")).filter("value <> ''")
    values = materialize(rows.groupBy("random", "value").agg(F.count("*").alias("times")))
    distinct = {r["random"]: r["count"] for r in values.groupBy("random").count().collect()}
    drawn = F.pmod(F.xxhash64("value"), F.lit(1_000_000_000))
    share = {kind: math.ceil(min(1.0, SAMPLE_VALUES / max(1, distinct.get(kind, 0))) * 1e9) for kind in (True, False)}
    return values.filter(drawn < F.when(F.col("random"), share[True]).otherwise(share[False]))


def train(samples: DataFrame) -> list[float] | None:
    """Log-likelihood ratio, in bits, of each character pair; None with too few samples."""
    counts = {(r.random, r.pair): r.n for r in _pairs(samples).collect()}
    if min(counts.get((kind, -1), 0) for kind in (True, False)) < MIN_SAMPLES:
        return None
    log: dict[bool, list[float]] = {}
    for kind in (True, False):
        cells = [counts.get((kind, i), 0) for i in range(SYMBOLS * SYMBOLS)]
        second = [sum(cells[b::SYMBOLS]) + SMOOTHING for b in range(SYMBOLS)]
        total = sum(second)
        # A pair not seen falls back on how common its second character is in this class.
        first = [sum(cells[a * SYMBOLS : (a + 1) * SYMBOLS]) + PRIOR for a in range(SYMBOLS)]
        log[kind] = [
            math.log2((x + PRIOR * second[i % SYMBOLS] / total) / first[i // SYMBOLS]) for i, x in enumerate(cells)
        ]
    return [a - b for a, b in zip(log[True], log[False], strict=True)]


def ratio(value: Column, model: list[float]) -> Column:
    """Mean log-likelihood ratio per pair of characters, in bits."""
    table = F.split(F.lit(",".join(f"{x:.5f}" for x in model)), ",").cast("array<double>")
    place = lambda i: F.instr(F.lit(ALPHABET), F.substring(value, i, F.lit(1)))
    n = F.length(value)
    scores = F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.get(table, place(i) * SYMBOLS + place(i + 1)))
    return F.aggregate(scores, F.lit(0.0), lambda s, x: s + x) / (n - 1)


def scan(docs: DataFrame, text: str = "text", keep: list[str] = (), model: list[float] | None = None) -> DataFrame:
    """`keep` columns and the spans per kind: `_assign`, `_access`, `_hex`, `_random`."""
    d = with_base_spans(docs, text, keep)
    if model is None:
        return d.withColumn("_random", _none()).drop("_text")
    t = F.col("_text")
    d = d.withColumn("_base", F.concat("_assign", "_access", "_hex"))
    d = d.withColumn("_runs", F.when(t.rlike(RUN), spans(t, RUN)).otherwise(_none()))
    apart = F.filter(
        "_runs", lambda r: ~F.exists("_base", lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"]))
    )
    d = d.withColumn("_runs", apart)
    random = F.filter("_runs", lambda r: ratio(r["value"], model) > MIN_RATIO)
    return d.withColumn("_random", random).drop("_text", "_base", "_runs")


def joined(kinds: tuple[str, ...]) -> Column:
    """kind:start:end of the spans of these kinds, by start and then kind as listed."""

    def numbered(i: int, kind: str) -> Column:
        return F.transform(
            f"_{kind}", lambda x: F.struct(x["start"].alias("s"), F.lit(i).alias("k"), x["end"].alias("e"))
        )

    parts = [numbered(i, kind) for i, kind in enumerate(kinds)]
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(
        F.transform(F.sort_array(F.concat(*parts)), lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"], x["e"])), ","
    )
