"""Quality rules: base counts, and how far a document's histograms are from its language's.

Everything is built-in expressions on the document's own row. The references are sums over all
documents of a language that are long enough: a histogram of character classes, and one of the
language's most common short words plus "any other word". A document is rejected when the
Jensen-Shannon distance of either histogram from the reference is above its limit. Histograms
of short documents say little, so below a minimum length there is no verdict and the document
is kept.

Defined cases: a null text counts as empty; empty texts and texts of under 20 words fail the base
rules; a null language is a language of its own; a language with fewer than `MIN_REFERENCE`
words has no reference, and its documents are judged by the base rules alone; repeated rows get
the same verdict each; other columns of the input are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.llm.words import WHITE, count_chars, sealed, text_of, words_of
from tracewright.session import materialize

SYMBOLS = "#*$%&|<>"
PUNCTUATION = ".,;:!?'\"()-"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
COMMON_WORDS = 24
MIN_WORDS_JUDGED = 60
MIN_CHARS_JUDGED = 200
MIN_REFERENCE = 2_000
MAX_COMMON_LENGTH = 5
MAX_CHAR_DISTANCE = 0.30
MAX_WORD_DISTANCE = 0.45


CLASSES = ["letters", "white", "marks", "digits", "others"]


def _with_words(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """`keep` columns, the text, its words, and its character counts by class."""
    d = docs.select(*keep, text_of(F.col(text)).alias("_text")).withColumn("_words", words_of(F.col("_text")))
    # Only ASCII characters that are no letters stay: a small rest, on which counting is cheap.
    rest = F.regexp_replace("_text", "[^\\x21-\\x40\\x5B-\\x60\\x7B-\\x7E]+", "")
    d = d.withColumn("_rest", F.struct(rest.alias("rest"), F.length(F.array_join("_words", "")).alias("word_chars")))
    rest, n = F.col("_rest")["rest"], F.col("_rest")["word_chars"]
    marks, digits = count_chars(rest, PUNCTUATION), count_chars(rest, "0123456789")
    counts = {
        "word_chars": n,
        "symbols": count_chars(rest, SYMBOLS),
        "letters": n - F.length(rest),
        "white": F.length("_text") - n,
        "marks": marks,
        "digits": digits,
        "others": F.length(rest) - marks - digits,
    }
    return d.withColumn("_classes", F.struct(*[c.cast("bigint").alias(k) for k, c in counts.items()])).drop("_rest")


def _repeated_words(pairs: Column) -> Column:
    """Words covered by windows that occur twice or more: neighbours in (hash, position) order are compared."""

    def repeated(pair: Column, i: Column) -> Column:
        before, after = F.get(pairs, i - 1), F.get(pairs, i + 1)
        same = (before["h"] == pair["h"]) | (after["h"] == pair["h"])
        return F.when(F.coalesce(same, F.lit(False)), pair["i"])

    positions = F.sort_array(F.filter(F.transform(pairs, repeated), lambda p: p.isNotNull()))
    start = F.struct(F.lit(0).cast("bigint").alias("covered"), F.lit(-WINDOW).alias("last"))
    covered = F.aggregate(
        positions,
        start,
        lambda s, p: F.struct(
            (s["covered"] + F.least(F.lit(WINDOW), p - s["last"])).alias("covered"), p.alias("last")
        ),
        lambda s: s["covered"],
    )
    return F.when(pairs.isNull(), F.lit(0).cast("bigint")).otherwise(covered)


def base_counts(docs: DataFrame, text: str = "text", keep: list[str] = ()) -> DataFrame:
    """`keep` columns of the documents, their words, and the base counts and verdict under `_`-names."""
    d = _with_words(docs, text, keep)
    n = F.size("_words")
    # Hashes of windows of 1, 2, 4 and 8 words, each from two of half the length: four passes
    # over the array, and no slice per position.
    d = d.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    width = 1
    while width < WINDOW:
        moved = F.slice("_hashes", width + 1, n)
        both = F.zip_with("_hashes", moved, lambda a, b: F.xxhash64(a, b))
        width *= 2
        fits = F.greatest(n - (width - 1), F.lit(0))
        d = d.withColumn("_hashes", F.slice(both, F.lit(1), fits))
    in_order = F.sort_array(F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    d = d.withColumn(
        "_pairs", F.when(F.size(F.array_distinct("_hashes")) < F.size("_hashes"), in_order)
    )
    lines = F.filter(F.split("_text", "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "")
    d = d.withColumn("_lines", lines)
    d = d.select(
        *keep,
        "_words",
        "_classes",
        n.cast("bigint").alias("_n_words"),
        F.col("_classes")["word_chars"].alias("_word_chars"),
        F.col("_classes")["symbols"].alias("_n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("_n_dup_lines"),
        _repeated_words(F.col("_pairs")).alias("_n_repeat_words"),
    )
    failed = (F.col("_n_words") < MIN_WORDS) | (
        100 * F.col("_n_repeat_words") > MAX_REPEAT_PERCENT * F.col("_n_words")
    )
    return d.withColumn("_base_failed", failed)


def language_reference(docs: DataFrame, text: str = "text", lang: str = "lang", common: int = COMMON_WORDS) -> DataFrame:
    """One row per language: shares of the character classes, its most common short words and their shares.

    Sums over all documents long enough to be judged. Both are partial aggregations, so no
    language is gathered in one task; what is shuffled are distinct (language, short word) pairs.
    """
    d = _with_words(docs.select(F.col(lang).alias("_lang"), F.col(text).alias("_t")), "_t", ["_lang"])
    d = d.withColumn("_n", F.size("_words").cast("bigint")).filter(F.col("_n") >= MIN_WORDS_JUDGED)
    # One row per document first, so that the class counts are added up beside the words.
    marked = F.concat(F.array(F.lit(None).cast("string")), "_words")
    rows = d.select("_lang", "_n", "_classes", F.explode(marked).alias("_word")).filter(
        F.col("_word").isNull() | (F.length("_word") <= MAX_COMMON_LENGTH)
    )
    whole = F.col("_word").isNull()
    sums = [
        F.sum(F.when(whole, F.col("_classes")[c])).alias(f"_{c}") for c in CLASSES
    ]
    counts = rows.groupBy("_lang", "_word").agg(
        F.count("*").alias("_count"), F.sum(F.when(whole, F.col("_n"))).alias("_total"), *sums
    )
    counts = materialize(counts)
    total = sum((F.col(f"_{c}") for c in CLASSES[1:]), F.col(f"_{CLASSES[0]}"))
    chars = counts.filter(whole & (F.col("_total") >= MIN_REFERENCE)).select(
        "_lang", "_total", F.array(*[F.col(f"_{c}") / total for c in CLASSES]).alias("_char_shares")
    )
    top = (
        counts.filter(~whole)
        .select(F.col("_lang").alias("_lang2"), "_word", "_count")
        .withColumn("_rank", F.row_number().over(Window.partitionBy("_lang2").orderBy(F.desc("_count"), "_word")))
        .filter(F.col("_rank") <= common)
        .groupBy("_lang2")
        .agg(F.sort_array(F.collect_list(F.struct("_rank", "_word", "_count"))).alias("_top"))
    )
    return chars.join(top, F.col("_lang").eqNullSafe(F.col("_lang2"))).select(
        F.col("_lang").alias("_ref_lang"),
        "_char_shares",
        F.transform("_top", lambda x: x["_word"]).alias("_common"),
        F.transform("_top", lambda x: x["_count"] / F.col("_total")).alias("_word_shares"),
    )


def js_distance(p: Column, q: Column) -> Column:
    """Square root of the Jensen-Shannon divergence, base 2, of two histograms that each sum to 1."""

    def term(a: Column, b: Column) -> Column:
        part = F.lit(0.0)
        for x in (a, b):
            part = part + F.when(x > 0, x / 2 * F.log2(2 * x / (a + b))).otherwise(0.0)
        return part

    divergence = F.aggregate(F.zip_with(p, q, term), F.lit(0.0), lambda s, x: s + x)
    return F.sqrt(F.greatest(divergence, F.lit(0.0)))


def judge(counted: DataFrame, reference: DataFrame, lang: str = "lang") -> DataFrame:
    """Adds `_char_distance`, `_word_distance` (null: no verdict) and `_kept`."""
    d = counted.join(reference, F.col(lang).eqNullSafe(F.col("_ref_lang")), "left")
    ids = F.transform("_words", lambda w: F.array_position(F.col("_common"), w))
    d = d.withColumn("_ids", F.sort_array(F.filter(ids, lambda i: i > 0)))
    n_common = F.size("_common")
    # In the sorted ids, the first and the last position of an id give its count.
    counts = F.transform(
        F.sequence(F.lit(1), n_common),
        lambda k: F.when(
            F.array_position("_ids", k.cast("bigint")) > 0,
            F.size("_ids")
            - F.array_position("_ids", k.cast("bigint"))
            - F.array_position(F.reverse("_ids"), k.cast("bigint"))
            + 2,
        ).otherwise(0),
    )
    d = d.withColumn("_counts", counts)
    classes = F.array(*[F.col("_classes")[c].cast("double") for c in CLASSES])
    n, chars = F.col("_n_words"), F.aggregate(classes, F.lit(0.0), lambda s, x: s + x)
    shares = F.concat(
        F.transform("_counts", lambda c: c / n), F.array((n - F.size("_ids")) / n)
    )
    wanted = F.concat(
        "_word_shares", F.array(F.lit(1.0) - F.aggregate("_word_shares", F.lit(0.0), lambda s, x: s + x))
    )
    word_distance = F.when(
        F.col("_common").isNotNull() & (n >= MIN_WORDS_JUDGED), js_distance(shares, wanted)
    )
    char_distance = F.when(
        F.col("_common").isNotNull() & (chars >= MIN_CHARS_JUDGED),
        js_distance(F.transform(classes, lambda c: c / chars), F.col("_char_shares")),
    )
    d = d.withColumn("_char_distance", char_distance).withColumn("_word_distance", word_distance)
    far = (F.coalesce("_char_distance", F.lit(0.0)) > MAX_CHAR_DISTANCE) | (
        F.coalesce("_word_distance", F.lit(0.0)) > MAX_WORD_DISTANCE
    )
    return d.withColumn("_kept", ~F.col("_base_failed") & ~far).drop(
        "_ids", "_counts", "_common", "_word_shares", "_char_shares", "_ref_lang"
    )


def quality_rules(docs: DataFrame, text: str = "text", lang: str = "lang", keep: list[str] = ()) -> DataFrame:
    """`keep` columns of every document with the base counts, both distances and the verdict under `_`-names."""
    keep = list(dict.fromkeys([*keep, lang]))
    reference = materialize(language_reference(docs, text, lang))
    judged = judge(base_counts(docs, text, keep), reference, lang)
    computed = ["_n_words", "_word_chars", "_n_symbols", "_n_dup_lines", "_n_repeat_words", "_base_failed"]
    return sealed(judged.drop("_words", "_classes"), [*computed, "_char_distance", "_word_distance", "_kept"])
