"""The queries of this subpackage: each operator over its whole table, and SQL where there is some."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.llm import (
    bpe,
    compact_windows,
    decontaminate,
    hard_negatives,
    html_text,
    minhash,
    mixing,
    pii,
    quality_rules,
    secret_scan,
    stages,
    suffix_dedup,
    token_align,
    vector_dedup,
)
from tracewright.session import configure


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = pii.pseudonymize(_table(spark, sf_dir, "documents").select("doc_id", "text"), stages.PII_KEY)
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return d.select("doc_id", "text", F.size("spans").cast("bigint").alias("n_replaced"), spans.alias("spans"))


def op2_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return d.select(
        F.col("_id").alias("doc_id"),
        F.col("_n_bytes").alias("n_bytes"),
        (F.col("_n_bytes") - F.octet_length("_kept")).alias("n_removed"),
        F.size("_spans").cast("bigint").alias("n_spans"),
        F.sha2("_kept", 256).alias("kept_sha256"),
    )


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = html_text.main_text(_table(spark, sf_dir, "pages"))
    return d.withColumn("n_chars", F.length("text").cast("bigint"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = mixing.mix(_table(spark, sf_dir, "documents"))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    rows = d.select("doc_id", "size", "source_size", "target", taken, F.explode(F.expr("array_repeat(1, int(repeats))")))
    return rows.drop("col")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path(stages.VOCABULARY)
    d = bpe.encode(_table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    d = bpe.decode(d, path)
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return d.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op7_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compact_windows.near_duplicate_passages(_table(spark, sf_dir, "documents"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = secret_scan.train(secret_scan.labelled_samples(docs))
    d = secret_scan.scan(docs, keep=["doc_id"], model=model)
    base = secret_scan.joined(secret_scan.KINDS[:3])
    return d.select(
        "doc_id",
        *[F.size(f"_{kind}").cast("bigint").alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(base.cast("binary"), 256).alias("base_sha256"),
        secret_scan.joined(secret_scan.KINDS).alias("spans"),
    )


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents")).drop("text_key")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = quality_rules.quality_rules(_table(spark, sf_dir, "documents"), keep=["doc_id"])
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return d.select("doc_id", *[F.col(f"_{c}").alias(c) for c in counts])


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.col("embedding").cast("array<double>")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = _table(spark, sf_dir, "embeddings").select(
        "vec_id", moved.alias("label"), F.when(fine, F.transform(x, lambda v: F.floor(v * 256))).alias("embedding")
    )
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % 50 == 0)


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    d = decontaminate.find_leaks(docs, benchmark, keep=["doc_id"])
    n_hit = F.aggregate("_hits", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return d.select(
        "doc_id",
        F.col("_n_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("_items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("_items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("_hits") > 0).alias("contaminated"),
    )


def op13_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    d = token_align.align(_table(spark, sf_dir, "documents"), *paths, keep=["doc_id"])
    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return d.select("doc_id", *[F.col(f"_{c}").alias(c) for c in columns])


# Character classes, words and Jensen-Shannon distances as in quality_rules.
OP10_SQL = r"""
WITH w AS (
  SELECT doc_id, lang, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         row_number() OVER () AS r
  FROM documents),
c AS (
  SELECT *, len(words) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         regexp_replace(text, '[^\x21-\x40\x5B-\x60\x7B-\x7E]+', '', 'g') AS rest
  FROM w),
k AS (
  SELECT *, CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
         word_chars - length(rest) AS c1, length(text) - word_chars AS c2,
         length(rest) - length(translate(rest, '.,;:!?''"()-', '')) AS c3,
         length(rest) - length(translate(rest, '0123456789', '')) AS c4
  FROM c),
p AS (SELECT *, length(rest) - c3 - c4 AS c5, c1 + c2 + length(rest) AS chars FROM k),
lines AS (
  SELECT r, CAST(count(*) - count(DISTINCT line) AS BIGINT) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM p)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
windows AS (
  SELECT r, i, array_to_string(words[i:i + 7], chr(10)) AS win
  FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS i FROM p WHERE len(words) >= 8)),
again AS (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM windows),
gaps AS (SELECT r, i - lag(i) OVER (PARTITION BY r ORDER BY i) AS gap FROM again WHERE n > 1),
repeats AS (SELECT r, CAST(sum(least(8, coalesce(gap, 8))) AS BIGINT) AS n_repeat_words FROM gaps GROUP BY r),
base AS (
  SELECT p.*, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         n_words < 20 OR 100 * coalesce(n_repeat_words, 0) > 30 * n_words AS base_failed
  FROM p LEFT JOIN lines USING (r) LEFT JOIN repeats USING (r)),
ref AS (
  SELECT lang, sum(n_words) AS total, sum(c1) AS s1, sum(c2) AS s2, sum(c3) AS s3, sum(c4) AS s4,
         sum(c5) AS s5, sum(chars) AS s
  FROM p WHERE n_words >= 60 GROUP BY lang HAVING sum(n_words) >= 2000),
counts AS (
  SELECT lang, word, count(*) AS n
  FROM (SELECT lang, unnest(words) AS word FROM p WHERE len(words) >= 60)
  WHERE length(word) <= 5 GROUP BY lang, word),
top AS (
  SELECT counts.lang, word, n / total AS q
  FROM counts JOIN ref ON counts.lang IS NOT DISTINCT FROM ref.lang
  QUALIFY row_number() OVER (PARTITION BY counts.lang ORDER BY n DESC, word) <= 24),
seen AS (
  SELECT r, word, count(*) AS n FROM (SELECT r, unnest(words) AS word FROM p) GROUP BY r, word),
pairs AS (
  SELECT base.r, coalesce(seen.n, 0) / base.n_words AS p, top.q
  FROM base JOIN top ON base.lang IS NOT DISTINCT FROM top.lang
       LEFT JOIN seen ON seen.r = base.r AND seen.word = top.word
  WHERE base.n_words >= 60),
whole AS (
  SELECT r, p, q FROM pairs
  UNION ALL SELECT r, greatest(1 - sum(p), 0), 1 - sum(q) FROM pairs GROUP BY r),
word_js AS (
  SELECT r, sqrt(greatest(sum(CASE WHEN p > 0 THEN p / 2 * log2(2 * p / (p + q)) ELSE 0 END
                 + CASE WHEN q > 0 THEN q / 2 * log2(2 * q / (p + q)) ELSE 0 END), 0)) AS d
  FROM whole GROUP BY r),
shares AS (
  SELECT r, unnest([c1, c2, c3, c4, c5]) / chars AS p, unnest([s1, s2, s3, s4, s5]) / s AS q
  FROM base JOIN ref ON base.lang IS NOT DISTINCT FROM ref.lang WHERE chars >= 200),
char_js AS (
  SELECT r, sqrt(greatest(sum(CASE WHEN p > 0 THEN p / 2 * log2(2 * p / (p + q)) ELSE 0 END
                 + CASE WHEN q > 0 THEN q / 2 * log2(2 * q / (p + q)) ELSE 0 END), 0)) AS d
  FROM shares GROUP BY r)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(char_js.d, 0) <= 0.30 AND coalesce(word_js.d, 0) <= 0.45 AS kept
FROM base LEFT JOIN word_js USING (r) LEFT JOIN char_js USING (r)
"""

OP12_SQL = r"""
WITH w AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(words)) AS n, unnest(
         CASE WHEN len(words) = 0 THEN []
              ELSE list_transform(range(1, greatest(len(words) - 8, 2)), lambda i: array_to_string(words[i:i + 9], ' ')) END) AS win
  FROM w),
d AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
places AS (
  SELECT r, n, i, array_to_string(words[i:i + n - 1], ' ') AS win
  FROM (SELECT r, words, n, unnest(range(1, greatest(len(words) - n + 2, 1))) AS i
        FROM d, (SELECT DISTINCT n FROM windows))),
found AS (
  SELECT DISTINCT r, places.n, i, item_id FROM places JOIN windows ON places.n = windows.n AND places.win = windows.win),
hit AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + n)) AS at FROM found) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS joined
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(joined, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""

QUERIES = {
    "op1_pii": op1_pii,
    "op2_vector_dedup": op2_vector_dedup,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_html_text": op4_html_text,
    "op5_mixing": op5_mixing,
    "op6_bpe": op6_bpe,
    "op7_compact_windows": op7_compact_windows,
    "op8_secret_scan": op8_secret_scan,
    "op9_minhash": op9_minhash,
    "op10_quality_rules": op10_quality_rules,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_decontaminate": op12_decontaminate,
    "op13_token_align": op13_token_align,
}

ORACLES = {
    "op10_quality_rules": OP10_SQL,
    "op12_decontaminate": OP12_SQL,
}
