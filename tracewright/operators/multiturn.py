"""Multi-turn samples: the turns of a conversation as one nested row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def nest_turns(turns: DataFrame) -> DataFrame:
    """turns(id, turn, ...) -> (id, turns): one row per conversation, all its turns in order.

    Each nested turn has its number and the other columns. A sample is one row whatever its length,
    as a reader of the dataset expects; a row is as large as its conversation.
    """
    rest = [c for c in turns.columns if c not in ("id", "turn")]
    return turns.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("turn", *rest))).alias("turns"))
