"""Joins, ordering and sampling that stay spread out when one key holds a large share of rows.

Lookups of many rows in a table with one row per key are plain joins: the adaptive skew join
cuts the hot partition of the large side (see session.SQL_CONF).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

# A key with more rows than this on one side is cut into blocks of about this size.
BLOCK_ROWS = 20_000
# Up to so many hot keys are broadcast; more are joined like any other table.
BROADCAST_KEYS = 100_000


def _heavy(df: DataFrame, keys: list[str], blocks: str, block_rows: int) -> DataFrame:
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > block_rows)
        .select(*keys, F.ceil(F.col("_n") / block_rows).cast("int").alias(blocks))
    )


def block_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_id: list[str],
    right_id: list[str],
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Inner equi-join in which the rows of a hot key are cut into blocks on both sides.

    Every pair of a left and a right block meets in one place, so the result is that of the
    plain join while no task gets a whole hot key. It is meant for joins that compare all pairs
    within a key, where few bytes can mean much work and the adaptive skew join, which goes by
    bytes, does not step in. `left_id` / `right_id` name the columns a row's block is drawn from.

    Both sides are shuffled and merged: a side that was multiplied (by cells, by blocks) is as small to the
    planner as before, which would have it broadcast, through the driver.

    The hot keys are looked up first by one job over the key columns of both sides; without any, this
    is the plain join. Every hot key is cut: up to BROADCAST_KEYS of them are broadcast, more are a table.
    """
    a, b = "_left_blocks", "_right_blocks"
    sides = _heavy(left, keys, a, block_rows).withColumn(b, F.lit(1)).unionByName(
        _heavy(right, keys, b, block_rows).withColumn(a, F.lit(1))
    )
    cuts = sides.groupBy(*keys).agg(F.max(a).alias(a), F.max(b).alias(b))
    found = cuts.limit(BROADCAST_KEYS + 1).collect()
    if not found:
        return left.join(right.hint("merge"), keys)
    few = len(found) <= BROADCAST_KEYS
    hot = F.broadcast(left.sparkSession.createDataFrame(found, cuts.schema)) if few else materialize(cuts)

    def in_blocks(df: DataFrame, own: str, other: str, ids: list[str], own_tag: str, other_tag: str):
        return (
            df.join(hot, keys, "left")
            .withColumn(own_tag, F.pmod(F.xxhash64(*ids), F.coalesce(own, F.lit(1))).cast("int"))
            .withColumn(other_tag, F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1)))
            .drop(a, b)
        )

    cut_left = in_blocks(left, a, b, left_id, "_l", "_r")
    cut_right = in_blocks(right, b, a, right_id, "_r", "_l")
    return cut_left.join(cut_right.hint("merge"), [*keys, "_l", "_r"]).drop("_l", "_r")


def with_next(
    df: DataFrame,
    keys: list[str],
    position: str,
    carry: list[str],
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add `next`, a struct of the carried columns of the following row in its group, or null.

    Positions are unique list indexes, so a window over (group, position // block) never
    holds more than `block_rows` rows however long a group is. The last row of each block is
    then linked to the first row of the next non-empty block, a join on the partitioning the
    window already has.
    """
    rows = df.withColumn("_block", F.floor(F.col(position) / block_rows))
    here = F.struct(*carry)
    across = Window.partitionBy(*keys).orderBy("_block")
    links = (
        rows.groupBy(*keys, "_block")
        .agg(F.min_by(here, position).alias("_head"))
        .select(*keys, "_block", F.lead("_head").over(across).alias("_after"))
    )
    inside = Window.partitionBy(*keys, "_block").orderBy(position)
    return (
        rows.withColumn("_next", F.lead(here).over(inside))
        .join(links, [*keys, "_block"], "left")
        .select(*df.columns, F.coalesce("_next", "_after").alias("next"))
    )


def with_index(df: DataFrame, by: list[str], order: list[str], name: str) -> DataFrame:
    """Add the number of each row in its group, from 0 in order, for groups of any size.

    Rows are dealt by range, so that a large group lies in many partitions; they are numbered
    inside of each, and the sizes of the pieces before are added.
    """
    dealt = materialize(df.repartitionByRange(*by, *order).withColumn("_piece", F.spark_partition_id()))
    before = Window.partitionBy(*by).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = dealt.groupBy(*by, "_piece").agg(F.count(F.lit(1)).alias("_n"))
    pieces = pieces.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = F.row_number().over(Window.partitionBy(*by, "_piece").orderBy(*order)) - 1
    numbered = dealt.withColumn("_inside", inside).join(pieces, [*by, "_piece"])
    return numbered.select(*df.columns, (F.col("_before") + F.col("_inside")).alias(name))


def first_rows(df: DataFrame, keys: list[str], order: str, n: int) -> DataFrame:
    """The first `n` rows of each group, with their `rank`.

    The rank filter is applied per input partition before the shuffle, so a hot group sends
    at most `n` rows per partition.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def pick_by_hash(
    df: DataFrame,
    group: str,
    quotas: DataFrame,
    key: Column,
    prefix_digits: int = 4,
) -> DataFrame:
    """Per group, the `quota` rows with the smallest SHA-256 of their key.

    `quotas` has one row per group and a `quota` column. A histogram of hash prefixes (at most
    16^digits rows per group) gives the prefix at which the quota is reached: rows below it
    are taken as they are, and only rows at it are ranked. No group is sorted as a whole, and only ranked rows are shuffled.
    """
    columns = df.columns
    keyed = df.withColumn("_hash", F.sha2(key, 256)).withColumn(
        "_prefix", F.substring("_hash", 1, prefix_digits)
    )
    upto = Window.partitionBy(group).orderBy("_prefix").rowsBetween(Window.unboundedPreceding, 0)
    steps = (
        keyed.groupBy(group, "_prefix")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_upto", F.sum("_n").over(upto))
        .join(quotas, group)
    )
    # The last prefix that starts below the quota: everything before it fits whole.
    cut = (
        steps.filter(F.col("_upto") - F.col("_n") < F.col("quota"))
        .groupBy(group)
        .agg(
            F.max("_prefix").alias("_cut"),
            F.max_by(F.col("quota") - F.col("_upto") + F.col("_n"), "_prefix").alias("_open"),
        )
    )
    # One row per group: joined by a shuffle, each group with all its columns would be sorted in one task.
    marked = keyed.join(F.broadcast(cut), group).filter(F.col("_prefix") <= F.col("_cut"))
    whole = marked.filter(F.col("_prefix") < F.col("_cut")).select(*columns)
    at_cut = Window.partitionBy(group).orderBy("_hash")
    edge = (
        marked.filter(F.col("_prefix") == F.col("_cut"))
        .withColumn("_rank", F.row_number().over(at_cut))
        .filter(F.col("_rank") <= F.col("_open"))
        .select(*columns)
    )
    return whole.unionByName(edge)
