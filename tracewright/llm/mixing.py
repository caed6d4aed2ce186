"""Mixing sources to target weights by pivotal dependent rounding, in column expressions only.

Sources in code point order (null last) weigh 5, 2, 1 and so on in turn, and share 150 % of all
words; no target goes beyond 2 times its source's words, and what is cut goes to the others by
weight until none is above (water filling, computed in closed form from running sums over the
sources). Every document should then be taken target / source words times.

A document takes the whole part of that number for certain. The fractions are rounded in pairs:
of two documents with fractions, words move from one to the other - in a direction drawn from a
hash of their keys, with the probabilities that leave both expectations unchanged - until one of
them is whole. Words are moved, not copies, so every step keeps the source's word total exactly.
Documents are dealt into groups of about `GROUP` by a hash; each group is folded to one document
with a fraction, and the groups' remainders are folded again, `GROUP` at a time, up a tree until
one per source is left. A few documents per source sit out the tree; the last remainder is folded with
them, larger ones first, so that what is left in the end is small, and goes to the nearer number.
What half a
document may still be off is evened out among those few documents, each staying within its two
neighbouring whole numbers.

Defined cases: a null or blank text has size 0 and is taken 0 times (0 words); sources without words
get target 0; a null source is a source; a null doc_id is a key like any other; rows that repeat
(doc_id, source, size) are one item and are all taken equally often, which only happens
to repeated rows; an empty table gives an empty one; other columns are not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.llm.words import words_of
from tracewright.session import materialize

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
GROUP = 16
KEPT_FOR_END = 64
WHOLE = 1e-9


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target, items) per source; `sizes` has source, size and repeats.

    The windows go over one row per source, not over documents.
    """
    per = sizes.groupBy("source").agg(
        F.sum(F.col("size") * F.col("repeats")).alias("source_size"), F.count("*").alias("items")
    )
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    per = per.withColumn("w", F.get(weights, (F.row_number().over(ordered) - 1) % len(WEIGHTS)))
    per = per.withColumn("cap", MOST * F.col("source_size"))
    # Those that reach their cap come first in this order; `level` is what a unit of weight
    # gets when all before are cut to their caps.
    by_need = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rest = SHARE * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    open_weight = F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    per = per.withColumn("level", rest / open_weight)
    fits = F.when(F.col("cap") / F.col("w") > F.col("level"), F.col("level"))
    # The first source that stays below its cap sets the level; later rows show lower ones.
    per = per.withColumn("level", F.max(fits).over(everything))
    target = F.when(F.col("level").isNull(), F.col("cap")).otherwise(
        F.least(F.col("cap"), F.col("level") * F.col("w"))
    )
    return per.select("source", "source_size", target.alias("target"), "items")


def _draw(a: Column, b: Column, salt: int) -> Column:
    """A number in [0, 1) from two keys."""
    return F.pmod(F.xxhash64(a, b, F.lit(salt)), F.lit(1 << 52)) / float(1 << 52)


def _item(doc_id, size, mass, base, whole, fraction) -> Column:
    return F.struct(
        doc_id.alias("doc_id"),
        size.alias("size"),
        mass.alias("mass"),
        base.alias("base"),
        whole.alias("whole"),
        fraction.alias("fraction"),
    )


def _with(item: Column, fraction: Column) -> Column:
    """The item with another fraction; one within rounding error of 0 or 1 is made whole."""
    up = fraction >= 1 - WHOLE
    return _item(
        item["doc_id"],
        item["size"],
        item["mass"],
        item["base"],
        item["whole"] + F.when(up, 1).otherwise(0),
        F.when(up | (fraction <= WHOLE), 0.0).otherwise(fraction),
    )


def _pair(a: Column, b: Column) -> Column:
    """The two items after one transfer of words between them; at least one is whole then."""
    to_b = F.least(a["mass"] * a["fraction"], b["mass"] * (1 - b["fraction"]))
    to_a = F.least(b["mass"] * b["fraction"], a["mass"] * (1 - a["fraction"]))
    moved = F.when(_draw(a["doc_id"], b["doc_id"], 7) * (to_a + to_b) < to_b, to_a).otherwise(-to_b)
    return F.struct(
        _with(a, a["fraction"] + moved / a["mass"]).alias("a"), _with(b, b["fraction"] - moved / b["mass"]).alias("b")
    )


def _folded(items: Column) -> Column:
    """All items of a group after pairing them one by one; one at most keeps a fraction, the last."""

    def step(state: Column, item: Column) -> Column:
        done = state["done"]
        # The pair is computed once, as the only element of an array, and then taken apart.
        pairs = F.array(_pair(done[F.size(done) - 1], item))

        def settled(pair: Column) -> Column:
            before = F.slice(done, 1, F.size(done) - 1)
            ends = F.when(pair["a"]["fraction"] > 0, F.array(pair["b"], pair["a"])).otherwise(
                F.array(pair["a"], pair["b"])
            )
            return F.concat(before, ends)

        paired = F.transform(pairs, settled)[0]
        open_end = done[F.size(done) - 1]["fraction"] > 0
        return F.struct(F.when(open_end, paired).otherwise(F.concat(done, F.array(item))).alias("done"))

    return F.aggregate(
        F.slice(items, F.lit(2), F.size(items)),
        F.struct(F.slice(items, 1, 1).alias("done")),
        step,
        lambda s: s["done"],
    )


def _evened(items: Column) -> Column:
    """The last fraction goes to the nearer number, and what that costs is evened out, larger items first."""

    def rounded(x: Column) -> Column:
        return x["whole"] + F.when(x["fraction"] >= 0.5, 1).otherwise(0)

    off = F.aggregate(
        items, F.lit(0.0), lambda s, x: s + x["mass"] * (rounded(x) - x["whole"] - x["fraction"])
    )

    def step(state: Column, x: Column) -> Column:
        whole, off = rounded(x), state["off"]
        other = F.when(whole > x["base"], -1).otherwise(1)
        turn = F.when(F.abs(off + x["mass"] * other) < F.abs(off), other).otherwise(0)
        item = _item(x["doc_id"], x["size"], x["mass"], x["base"], whole + turn, F.lit(0.0))
        return F.struct(
            (off + x["mass"] * turn).alias("off"), F.concat(state["done"], F.array(item)).alias("done")
        )

    start = F.struct(off.alias("off"), F.slice(items, 1, 0).alias("done"))
    return F.aggregate(F.sort_array(F.transform(items, _by_mass), False), start, step, lambda s: s["done"])


def _by_mass(x: Column) -> Column:
    fields = ("mass", "doc_id", "size", "base", "whole", "fraction")
    return F.struct(*[x[f].alias(f) for f in fields])


def _order() -> Column:
    return F.xxhash64("doc_id", "size")


def _level(items: DataFrame, order: Column | None = None, last: bool = False) -> DataFrame:
    """One level of the tree: items of a group in hash order or the given one, folded."""
    packed = F.struct(
        (_order() if order is None else order).alias("order"), _order().alias("tie"), "doc_id", "size", "mass", "base", "whole", "fraction"
    )
    groups = items.groupBy("source", "group").agg(F.sort_array(F.collect_list(packed)).alias("items"))
    plain = F.transform(
        "items", lambda x: _item(x["doc_id"], x["size"], x["mass"], x["base"], x["whole"], x["fraction"])
    )
    groups = groups.select("source", "group", plain.alias("items"))
    folded = groups.select("source", "group", _folded(F.col("items")).alias("items"))
    if last:
        folded = folded.select("source", "group", _evened(F.col("items")).alias("items"))
    groups = folded.select("source", "group", F.explode("items").alias("x"))
    return groups.select("source", "group", "x.*")


def copies(items: DataFrame, targets: DataFrame) -> DataFrame:
    """How often each item (source, doc_id, size, repeats) is taken: 0, 1 or 2 times, as `copies`."""
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = targets.select(
        F.col("source").alias("_s"), "source_size", "target", rate.alias("rate"), F.col("items").alias("_items")
    )
    joined = items.join(targets, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    rate = F.col("rate")
    near = F.round(rate)
    rate = F.when(F.abs(rate - near) <= WHOLE, near).otherwise(rate)
    whole = F.floor(rate).cast("int")
    groups = F.greatest(F.ceil(F.col("_items") / GROUP), F.lit(1))
    joined = joined.select(
        "source",
        "doc_id",
        "size",
        (F.col("size") * F.col("repeats")).cast("double").alias("mass"),
        whole.alias("base"),
        whole.alias("whole"),
        F.when(F.col("size") > 0, rate - whole).otherwise(0.0).alias("fraction"),
        F.pmod(F.xxhash64("doc_id", "size", F.lit(3)), groups).alias("group"),
        groups.alias("groups"),
    )
    joined = materialize(joined)
    open_items = joined.filter("fraction > 0").drop("groups")
    decided = joined.filter("fraction = 0").select("source", "doc_id", "size", "whole")

    # The documents kept for the end: the first few of each source in hash order.
    rank = F.row_number().over(Window.partitionBy("source").orderBy(_order()))
    ends = open_items.withColumn("rank", rank).filter(F.col("rank") <= KEPT_FOR_END)
    ends = ends.groupBy(F.col("source").alias("_s")).agg(F.max(_order()).alias("_end"))
    open_items = open_items.join(ends, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    at_end = open_items.filter(_order() <= F.col("_end")).drop("_end")
    open_items = open_items.filter(_order() > F.col("_end")).drop("_end")

    most = targets.agg(F.max("_items")).first()[0] or 1
    for _ in range(1 + math.ceil(math.log(max(most, 2), GROUP))):
        folded = materialize(_level(open_items))
        decided = decided.union(folded.filter("fraction = 0").select("source", "doc_id", "size", "whole"))
        open_items = folded.filter("fraction > 0").withColumn("group", F.floor(F.col("group") / GROUP))
    rest = open_items.union(at_end.select(open_items.columns)).withColumn("group", F.lit(0).cast("bigint"))
    rest = _level(rest, -F.col("mass"), last=True)
    decided = decided.union(rest.select("source", "doc_id", "size", "whole"))
    return decided.withColumnRenamed("whole", "copies")


def sized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(source, doc_id, size, repeats) per item, written once: texts are read and counted one time."""
    rows = docs.select(
        F.col(source).alias("source"),
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.size(words_of(F.col(text))).cast("bigint").alias("size"),
    )
    return materialize(rows.groupBy("source", "doc_id", "size").agg(F.count("*").alias("repeats")))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(source, doc_id, size, repeats, source_size, target, copies) per item of the documents."""
    items = sized(docs, doc_id, text, source)
    targets = materialize(source_targets(items))
    taken = copies(items, targets)
    same = [F.col(f"i.{c}").eqNullSafe(F.col(f"t.{c}")) for c in ("source", "doc_id", "size")]
    both = items.alias("i").join(taken.alias("t"), (same[0] & same[1] & same[2]))
    both = both.select("i.*", "t.copies")
    return both.join(
        targets.select(F.col("source").alias("_s"), "source_size", "target"),
        F.col("source").eqNullSafe(F.col("_s")),
    ).drop("_s")
