"""Repeatable draws of labelled rows, for callers that ask to learn from a number of them."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


MOST_VALUES = 100  # of a label that is drawn by, the most frequent ones


def chosen(rows: DataFrame, label: str, most: int, *identity: str | Column) -> Column:
    """The condition that takes about `most` rows of each value of `label`, or all of a value that has no more.

    Rows are taken by a hash of `identity`, so a rerun or another partitioning takes the same ones; the
    number differs from `most` by chance only (its square root).  Of a label with more than `MOST_VALUES` values the most
    frequent ones are drawn.
    """
    counts = rows.groupBy(label).count().orderBy(F.desc("count"), label).limit(MOST_VALUES).collect()
    taken: Column = F.lit(False)
    bucket = F.pmod(F.xxhash64(*identity), F.lit(1_000_000))
    for value, n in counts:
        share = min(1_000_000, -(-most * 1_000_000 // max(n, 1)))
        taken = taken | ((F.col(label) == F.lit(value)) & (bucket < share))
    return taken
