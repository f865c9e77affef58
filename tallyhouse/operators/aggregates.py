"""Aggregations: group statistics, shares, profiles, key figures, trend."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tallyhouse.functions.expressions import floor_band, is_present, money
from tallyhouse.operators.ordering import running_weight
from tallyhouse.operators.relational import mean
from tallyhouse.schemas import BASE_PURCHASE_SEGMENT, PURCHASE_FLOORS


def group_stats(df: DataFrame, keys: Sequence[str | Column], value: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count("*").alias("row_count"),
        F.sum(value).alias("total"),
        mean(F.sum(value), F.count(value)).alias("average"),
        F.min(value).alias("minimum"),
        F.max(value).alias("maximum"),
    )


def count_where(df: DataFrame, predicate: Column) -> DataFrame:
    return df.where(predicate).agg(F.count("*").alias("row_count"))


def exact_median(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Interpolated median per group, for groups of any size.

    Rows are folded to one per (group, value) with a count, which also removes any hot value.
    The folded rows are numbered by range over (group, value); the middle one or two of each
    group are found by their running count. No task ever holds a whole group.
    """
    keys = list(keys)
    folded = (
        df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    )
    running = running_weight(folded, [*keys, value], "_n", "_through")
    if keys:
        group = running.groupBy(*keys).agg(
            F.min(F.col("_through") - F.col("_n")).alias("_start"), F.sum("_n").alias("_size")
        )
        same = [F.col(f"r.{k}").eqNullSafe(F.col(f"g.{k}")) for k in keys]
        joined = running.alias("r").join(group.alias("g"), same)
    else:
        size = running.agg(F.sum("_n")).scalar()
        joined = running.alias("r").withColumns({"_start": F.lit(0), "_size": size})
    low = F.col("_start") + F.floor((F.col("_size") + 1) / 2)
    high = F.col("_start") + F.floor((F.col("_size") + 2) / 2)
    holds = lambda place: (F.col("_through") - F.col("_n") < place) & (F.col("_through") >= place)
    middle = joined.where(holds(low) | holds(high))
    both = (F.min(F.col(value).cast("double")) + F.max(F.col(value).cast("double"))) / 2
    return middle.groupBy(*[F.col(f"r.{k}").alias(k) for k in keys]).agg(both.alias("median"))


def describe_value(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Count, sum, mean, sample standard deviation, minimum, maximum and median."""
    keys = list(keys)
    stats = df.groupBy(*keys).agg(
        F.count("*").alias("row_count"),
        F.sum(value).alias("total"),
        mean(F.sum(value), F.count(value)).alias("average"),
        F.stddev_samp(value).alias("std_deviation"),
        F.min(value).alias("minimum"),
        F.max(value).alias("maximum"),
    )
    middle = exact_median(df, value, keys)
    if not keys:
        return stats.withColumn("median", middle.scalar())
    same = [F.col(f"s.{k}").eqNullSafe(F.col(f"m.{k}")) for k in keys]
    return stats.alias("s").join(middle.alias("m"), same, "left").select("s.*", "m.median")


def segment_share(
    df: DataFrame, value: str, floors=PURCHASE_FLOORS, base: str = BASE_PURCHASE_SEGMENT
) -> DataFrame:
    """Customers per purchase segment with their share of all rows (scalar subquery)."""
    everything = df.agg(F.count("*")).scalar()
    segment = floor_band(value, floors, base).alias("customer_segment")
    stats = group_stats(df, [segment], value)
    return stats.withColumn("percentage", F.col("row_count") * F.lit(100.0) / everything)


def state_summary(summary: DataFrame) -> DataFrame:
    """Customer summary folded per state. ``avg_order_value`` is the mean of the customers'
    means; ``weighted_order_value`` weighs every order alike."""
    return summary.groupBy("state", "country").agg(
        F.count("customer_id").alias("customer_count"),
        F.sum("total_spent").alias("total_revenue"),
        mean(
            F.sum(F.col("avg_order_value").cast("decimal(28,6)")), F.count("avg_order_value")
        ).alias("avg_order_value"),
        mean(F.sum("total_spent"), F.sum("order_count")).alias("weighted_order_value"),
    )


def customer_rollup(orders: DataFrame) -> DataFrame:
    """Lifetime figures per customer."""
    return orders.groupBy("customer_id").agg(
        F.count("order_id").alias("order_count"),
        F.sum("total_amount").alias("lifetime_value"),
        mean(F.sum("total_amount"), F.count("total_amount")).alias("avg_order_value"),
        F.max("order_date").alias("last_order_date"),
    )


def kpis(daily: DataFrame, segments: DataFrame) -> DataFrame:
    """One row of key figures from daily sales and the segment report."""
    revenue, orders = F.sum("daily_revenue"), F.sum("order_count")
    return daily.agg(
        revenue.alias("total_revenue"),
        mean(revenue, F.count("daily_revenue")).alias("avg_daily_revenue"),
        orders.alias("total_orders"),
        F.coalesce(mean(revenue, F.when(orders > 0, orders)), F.lit(0.0)).alias("avg_order_value"),
    ).withColumn("total_customers", segments.agg(F.sum("customer_count")).scalar())


def trend(daily: DataFrame, date_column: str = "order_date", value: str = "daily_revenue") -> DataFrame:
    """Least-squares line of the value over the row position 0, 1, 2, ...

    ``daily`` has one row per calendar day, so the single-task numbering is bounded by the
    calendar. Sums are DECIMAL: the result does not depend on the order of addition.
    """
    placed = daily.select(
        (F.row_number().over(W.orderBy(date_column)) - 1).cast("decimal(10,0)").alias("x"),
        F.col(value).cast("decimal(22,2)").alias("y"),
    ).where(F.col("y").isNotNull())
    sums = placed.agg(
        F.count("*").cast("double").alias("n"),
        F.sum("x").cast("double").alias("sx"),
        F.sum("y").cast("double").alias("sy"),
        F.sum(F.col("x") * F.col("x")).cast("double").alias("sxx"),
        F.sum(F.col("x") * F.col("y")).cast("double").alias("sxy"),
    )
    slope = F.try_divide(
        F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy"),
        F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx"),
    )
    return sums.withColumn("slope", slope).select(
        "slope", ((F.col("sy") - F.col("slope") * F.col("sx")) / F.col("n")).alias("intercept")
    )


def metrics_as_rows(df: DataFrame, metrics: dict[str, Column], name: str, value: str) -> DataFrame:
    """Several aggregates from one pass, turned into one row each."""
    aliases = {f"_m{i}": label for i, label in enumerate(metrics)}
    one = df.agg(*[m.alias(a) for a, m in zip(aliases, metrics.values())])
    pairs = ", ".join(f"'{label.replace(chr(39), chr(92) + chr(39))}', `{a}`" for a, label in aliases.items())
    return one.selectExpr(f"stack({len(aliases)}, {pairs}) as (`{name}`, `{value}`)")


def null_profile(df: DataFrame) -> DataFrame:
    """NULL count per column, all columns in one pass."""
    counts = {c: F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns}
    return metrics_as_rows(df, counts, "column_name", "null_count")


def completeness(df: DataFrame, required: dict[str, Column]) -> DataFrame:
    """Total rows and rows satisfying each named condition, all in one pass."""
    metrics = {"Total Records": F.count("*")}
    metrics |= {label: F.count_if(condition) for label, condition in required.items()}
    return metrics_as_rows(df, metrics, "metric", "value")


def customer_completeness(df: DataFrame) -> DataFrame:
    return completeness(
        df,
        {
            "Records with Email": is_present("email"),
            "Records with Country": is_present("country"),
            "Records with Loyalty Tier": F.col("loyalty_tier").isNotNull(),
        },
    )


def daily_totals(df: DataFrame, date_column: str, value: str) -> DataFrame:
    """One row per day: the bounded input of the running windows."""
    return df.groupBy(F.col(date_column).alias("day")).agg(
        F.count("*").alias("row_count"), F.sum(money(value)).alias("daily_value")
    )
