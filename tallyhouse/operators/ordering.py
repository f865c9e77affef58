"""Numbering rows over one global order without putting them into one task.

A window without PARTITION BY sorts everything in a single task. Here the rows are range
partitioned on the whole sort key, sorted inside their partition and written once to the shared
folder together with their place (partition number and position). Only one total per partition,
at most spark.sql.shuffle.partitions rows, then goes through a single-task running sum.

The write is needed: range bounds come from a sample, and a plan evaluated twice could cut the
ranges differently. Written places stay the same whatever happens to the executors afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tallyhouse.session import fresh_path

_PLACE = "_place"  # monotonically_increasing_id: partition number << 33 | position in partition
_PART = "_part"


def _placed(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    path = fresh_path(df.sparkSession, "ordered")
    (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(_PLACE, F.monotonically_increasing_id())
        .write.parquet(path)
    )
    return df.sparkSession.read.parquet(path).withColumn(_PART, F.shiftright(_PLACE, 33))


def _offsets(placed: DataFrame, weight: Column) -> DataFrame:
    """Sum of the weights in all earlier partitions; one row per partition."""
    totals = placed.groupBy(_PART).agg(F.sum(weight).alias("_total"))
    earlier = W.orderBy(_PART).rowsBetween(W.unboundedPreceding, -1)
    return totals.select(
        _PART, F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before")
    )


def number_rows(df: DataFrame, order: Sequence[Column | str], name: str = "row_num") -> DataFrame:
    """Dense 1-based numbers in the given order. The order must end in a unique key: it makes
    the numbers repeatable and lets the range partitioning split any run of equal values."""
    return numbered_and_total(df, order, name)[0]


def numbered_and_total(
    df: DataFrame, order: Sequence[Column | str], name: str
) -> tuple[DataFrame, Column]:
    """Numbered rows, and the row count as a scalar read from the footers of the placed rows."""
    placed = _placed(df, order)
    position = F.col(_PLACE).bitwiseAND(F.lit((1 << 33) - 1)) + 1
    numbered = (
        placed.join(F.broadcast(_offsets(placed, F.lit(1))), _PART)
        .withColumn(name, F.col("_before") + position)
        .drop(_PART, _PLACE, "_before")
    )
    return numbered, placed.agg(F.count("*")).scalar()


def running_weight(
    df: DataFrame, order: Sequence[Column | str], weight: str, name: str = "through"
) -> DataFrame:
    """Sum of ``weight`` over all rows up to and including this one. Callers pass one row per
    distinct order value, so no value can fill a partition by itself."""
    placed = _placed(df, order)
    inside = W.partitionBy(_PART).orderBy(_PLACE).rowsBetween(W.unboundedPreceding, 0)
    return (
        placed.withColumn("_inside", F.sum(weight).over(inside))
        .join(F.broadcast(_offsets(placed, F.col(weight))), _PART)
        .withColumn(name, F.col("_before") + F.col("_inside"))
        .drop(_PART, _PLACE, "_before", "_inside")
    )


def ranked_and_total(
    df: DataFrame, by: str, key: str, name: str, rank: str
) -> tuple[DataFrame, Column]:
    """Rows numbered by (``by`` ascending, NULLs last, then ``key``), with RANK() of the value.

    A value's rank is the number of its first row. Inside a range partition that is where the run of
    equal values begins; a run that goes on from the partition before has its rank carried over,
    from whichever partition it began in. Only the carries, one row per partition, meet the rows:
    nothing is joined on the value, so one that a third of all rows hold costs no more than others.
    """
    placed = _placed(df, [F.asc_nulls_last(by), F.asc(key)])
    # Summaries of one row per partition: first and last value, rows, and how many rows hold the last value.
    ends = placed.groupBy(_PART).agg(
        F.count("*").alias("_rows"),
        F.min_by(F.struct(by), _PLACE)[by].alias("_first"),
        F.max_by(F.struct(by), _PLACE)[by].alias("_last"),
    )
    last = F.broadcast(ends.select(F.col(_PART).alias("_p"), "_last"))
    tails = placed.join(last, F.col(_PART) == F.col("_p")).groupBy(_PART).agg(
        F.count_if(F.col(by).eqNullSafe(F.col("_last"))).alias("_tail")
    )
    ordered = W.orderBy(_PART)
    earlier = ordered.rowsBetween(W.unboundedPreceding, -1)
    summary = ends.join(tails, _PART).withColumns({
        "_before": F.coalesce(F.sum("_rows").over(earlier), F.lit(0)),
        "_goes_on": (F.row_number().over(ordered) > 1) & F.col("_first").eqNullSafe(F.lag("_last").over(ordered)),
    })
    # The rank of the partition's last run, unless that run fills it and began earlier.
    began = F.when(~(F.col("_goes_on") & (F.col("_tail") == F.col("_rows"))), F.col("_before") + F.col("_rows") - F.col("_tail") + 1)
    carried = F.last_value(began, ignoreNulls=True).over(earlier)
    carries = summary.select(
        F.col(_PART).alias("_p"), "_before",
        F.when(F.col("_goes_on"), carried).otherwise(F.col("_before") + 1).alias("_carry"),
    )
    inside = W.partitionBy(_PART).orderBy(_PLACE)
    position = F.col(_PLACE).bitwiseAND(F.lit((1 << 33) - 1)) + 1
    new_run = (position == 1) | ~F.col(by).eqNullSafe(F.lag(by).over(inside))
    upto = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    runs = placed.withColumn("_new", F.when(new_run, position)).withColumn("_run", F.max("_new").over(upto))
    numbered = runs.join(F.broadcast(carries), F.col(_PART) == F.col("_p")).withColumns({
        name: F.col("_before") + position,
        rank: F.when(F.col("_run") == 1, F.col("_carry")).otherwise(F.col("_before") + F.col("_run")),
    })
    return numbered.select(*df.columns, name, rank), placed.agg(F.count("*")).scalar()
