"""The operators as pipeline stages: (spark, docs, sf_dir) to a DataFrame.

Every stage takes and returns the columns of `documents` and any others beside them, in any number and
under any name; rows of one stage's operator find back to their documents by doc_id and text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.llm import bpe, minhash, mixing, pii, quality_rules
from tracewright.llm.words import words_of
from tracewright.session import configure

# A deployment hands in a secret key; here it is fixed, so that reruns agree.
PII_KEY = b"tracewright"
VOCABULARY = "word_bpe_49k.json"


def _packed(docs: DataFrame) -> DataFrame:
    """Each row as one struct beside the columns that operators read, so that no other column can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "doc_id", "text", "lang", "source")


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality rules keep, unchanged."""
    configure(spark)
    judged = quality_rules.quality_rules(_packed(docs), keep=["_row"])
    return judged.filter("_kept").select("_row.*")


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest doc_id.

    Rows that repeat one doc_id and text are one document. Null ids name no group: they go
    where their group has an id, and stay otherwise.
    """
    configure(spark)
    kept = minhash.near_duplicates(docs).filter("kept").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
    rows = _packed(docs).withColumn("_text_key", minhash.text_key(F.col("text")))
    same = (F.col("_text_key") == F.col("_key")) & F.col("doc_id").cast("bigint").eqNullSafe(F.col("_id"))
    return rows.join(kept.distinct(), same, "left_semi").select("_row.*")


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with pseudonyms; n_chars follows the text where that has changed."""
    configure(spark)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "text")
    rows = pii.pseudonymize(rows, PII_KEY, spans="_spans")
    columns = {c: F.col("_row")[c] for c in docs.columns} | {"text": F.col("text")}
    if "n_chars" in columns:
        changed = F.size("_spans") > 0
        kind = docs.schema["n_chars"].dataType
        columns["n_chars"] = F.when(changed, F.length("text").cast(kind)).otherwise(columns["n_chars"])
    return rows.select(*[c.alias(name) for name, c in columns.items()])


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them: not at all, once, or as two rows."""
    configure(spark)
    taken = mixing.mix(docs).filter("copies > 0")
    taken = taken.select(F.col("doc_id").alias("_id"), F.col("source").alias("_s"), F.col("size").alias("_n"), "copies")
    rows = _packed(docs).withColumn("_size", F.size(words_of(F.col("text"))).cast("bigint"))
    same = (
        F.col("doc_id").cast("bigint").eqNullSafe(F.col("_id"))
        & F.col("source").eqNullSafe(F.col("_s"))
        & (F.col("_size") == F.col("_n"))
    )
    found = rows.join(taken, same).select("_row", F.explode(F.expr("array_repeat(0, copies)")).alias("_copy"))
    return found.select("_row.*")


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source and the token ids of every document."""
    configure(spark)
    import public_tokenizers

    path = public_tokenizers.path(VOCABULARY)
    encoded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), path)
    return encoded.withColumn("n_tokens", F.size("ids").cast("bigint"))
