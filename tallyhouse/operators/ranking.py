"""Window results.

Windows without PARTITION BY run in one task. They are used only where their input is bounded:
k rows after a top-k, or one row per calendar day. Everything else goes through ``ordering``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tallyhouse.operators.ordering import number_rows, ranked_and_total
from tallyhouse.operators.relational import mean, top_k


def rank_top(df: DataFrame, by: str, k: int, key: str) -> DataFrame:
    """RANK, DENSE_RANK and ROW_NUMBER of the k largest. A row's rank depends only on rows above
    it, so the top k are cut first and the windows see k rows."""
    best = W.orderBy(F.desc_nulls_last(by))
    return top_k(df, by, k, key).withColumns(
        {
            "purchase_rank": F.rank().over(best),
            "dense_rank": F.dense_rank().over(best),
            "row_num": F.row_number().over(W.orderBy(F.desc_nulls_last(by), F.col(key))),
        }
    )


def top_per_group(df: DataFrame, group: str, by: str) -> DataFrame:
    """The row or rows holding each group's largest value, ties kept. A group whose values are all
    NULL keeps its rows, as RANK() = 1 does.

    The maximum per group is folded inside every task, then joined back: with few groups the
    join is a broadcast filter over the scan and no row is shuffled; with many groups it is a
    shuffle on (group, value), so a hot group is spread over its values.
    """
    best = df.groupBy(F.col(group).alias("_group")).agg(F.max(by).alias("_best"))
    same = F.col(group).eqNullSafe(F.col("_group")) & F.col(by).eqNullSafe(F.col("_best"))
    return df.join(best, same).select(*df.columns)


def running_total(daily: DataFrame, day: str = "day", value: str = "daily_value") -> DataFrame:
    """Running sum over one row per day."""
    upto = W.orderBy(day).rowsBetween(W.unboundedPreceding, 0)
    return daily.withColumn("running_total", F.sum(value).over(upto))


def moving_avg(daily: DataFrame, rows: int = 3, day: str = "day", value: str = "daily_value") -> DataFrame:
    """Mean over this and the rows-1 preceding days (fewer at the start)."""
    frame = W.orderBy(day).rowsBetween(1 - rows, 0)
    return daily.withColumn(
        "moving_avg", mean(F.sum(value).over(frame), F.count(value).over(frame))
    )


def rolling_mean(daily: DataFrame, rows: int = 7, day: str = "day", value: str = "daily_value") -> DataFrame:
    """Mean over this and the rows-1 preceding days; NULL until that many values exist."""
    frame = W.orderBy(day).rowsBetween(1 - rows, 0)
    filled = F.count(value).over(frame) == rows
    return daily.withColumn(
        "rolling_mean", F.when(filled, mean(F.sum(value).over(frame), F.lit(rows)))
    )


def ntile_of(row_number: Column, total: Column, tiles: int) -> Column:
    """Tile of a 1-based row number; the first ``total % tiles`` tiles are one row larger."""
    small = F.floor(total / tiles)
    larger = F.pmod(total, F.lit(tiles))
    edge = larger * (small + 1)
    index = row_number - 1
    return (
        F.when(index < edge, F.floor(index / (small + 1)))
        .otherwise(larger + F.floor((index - edge) / F.greatest(small, F.lit(1))))
        + 1
    ).cast("int")


def percentiles(df: DataFrame, by: str, key: str, tiles: int = 4) -> DataFrame:
    """PERCENT_RANK (as a fraction) and NTILE over the whole table, ascending, NULLs last.

    Rows are numbered by range; a value's rank is carried from partition to partition.
    """
    ranked, total = ranked_and_total(df, by, key, "_row", "_rank")
    fraction = F.when(total > 1, (F.col("_rank") - 1) / (total - 1)).otherwise(F.lit(0.0))
    return ranked.select(
        *df.columns,
        fraction.alias("percent_rank"),
        ntile_of(F.col("_row"), total, tiles).alias("quartile"),
    )


def surrogate_key(df: DataFrame, order: Sequence[Column | str], name: str = "row_id") -> DataFrame:
    """Dense 1-based key in the given order (which must end in a unique column)."""
    return number_rows(df, order, name)


def share_of_total(groups: DataFrame, value: str, name: str = "percentage") -> DataFrame:
    """Each group's percent of the overall sum; the sum is a scalar subquery, not a window."""
    everything = groups.agg(F.sum(value)).scalar()
    part = F.col(value).cast("double") * 100
    return groups.withColumn(name, F.try_divide(part, everything.cast("double")))
