"""The medallion stages and business reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyhouse.catalog.base import SQL, query
from tallyhouse.catalog.relational import (
    BAND_SQL, BANDS, FLOOR_SQL, FLOORS, ITEM_ORDER, ROLLUP_SQL, STATS_SQL, SUMMARY_SQL,
    people, transactions,
)
from tallyhouse.operators import layout
from tallyhouse.plans import medallion, reports
from tallyhouse.session import fresh_name, fresh_path
from tallyhouse.sources.retail import Retail

STAMP = "2024-01-15 08:00:00"
SILVER_SQL = f"""silver as (
    select order_id, customer_id, order_date, order_status, total_amount,
           '{STAMP}' as ingestion_timestamp, 'retail' as source_system,
           year(order_date) as order_year, month(order_date) as order_month,
           day(order_date) as order_day, coalesce(order_status, 'UNKNOWN') as order_status_clean,
           {BAND_SQL} as amount_category
    from patchy where order_id is not null and customer_id is not null and total_amount > 0)"""
DAILY_SQL = """daily as (
    select order_date, order_year, order_month, count(order_id) as total_orders,
           count(distinct customer_id) as unique_customers,
           cast(sum(total_amount) as double) as total_revenue,
           cast(sum(total_amount) as double) / count(order_id) as avg_order_value,
           cast(min(total_amount) as double) as min_order_value,
           cast(max(total_amount) as double) as max_order_value,
           cast(sum(total_amount) as double) / count(distinct customer_id) as revenue_per_customer
    from silver group by 1, 2, 3)"""
SEGMENT_SQL = f"""seg as (
    select *, {FLOOR_SQL} as customer_segment from (
        select customer_id, count(order_id) as order_count, sum(total_amount) as lifetime_value,
               cast(sum(total_amount) as double) / count(total_amount) as avg_order_value,
               max(order_date) as last_order_date from silver group by 1))"""


def bronze(r: Retail) -> DataFrame:
    columns = ("order_id", "customer_id", "order_date", "order_status", "total_amount")
    return medallion.bronze_orders(r.patchy_orders.select(*columns), "retail", STAMP)


def silver(r: Retail) -> DataFrame:
    return medallion.silver_orders(bronze(r), BANDS)


def daily(r: Retail) -> DataFrame:
    return medallion.gold_daily_sales(silver(r))


@query(
    "e01_bronze_orders",
    f"""select order_id, customer_id, order_date, order_status, cast(total_amount as double)
        as total_amount, '{STAMP}' as ingestion_timestamp, 'retail' as source_system from patchy""",
    "patchy",
)
def e01(r: Retail) -> DataFrame:
    return bronze(r)


@query(
    "e02_silver_orders",
    f", {SILVER_SQL} select * replace (cast(total_amount as double) as total_amount) from silver",
    "patchy",
)
def e02(r: Retail) -> DataFrame:
    return silver(r)


@query("e03_gold_daily_sales", f", {SILVER_SQL}, {DAILY_SQL} select * from daily", "patchy")
def e03(r: Retail) -> DataFrame:
    return daily(r)


@query(
    "e04_gold_customer_segments",
    f""", {SILVER_SQL}, {SEGMENT_SQL}
        select * replace (cast(lifetime_value as double) as lifetime_value) from seg""",
    "patchy",
)
def e04(r: Retail) -> DataFrame:
    return medallion.gold_customer_segments(silver(r), FLOORS)


@query(
    "e05_segment_distribution",
    f""", {SILVER_SQL}, {SEGMENT_SQL}
        select customer_segment, count(*) as customer_count,
               cast(sum(lifetime_value) as double) / count(*) as avg_lifetime_value from seg group by 1""",
    "patchy",
)
def e05(r: Retail) -> DataFrame:
    return medallion.segment_distribution(medallion.gold_customer_segments(silver(r), FLOORS))


@query(
    "e06_medallion_layers",
    f""", {SILVER_SQL}
        select 'bronze_orders' as layer, count(*) as rows from patchy
        union all select 'silver_orders', count(*) from silver
        union all select 'gold_daily_sales', count(distinct order_date) from silver
        union all select 'gold_customer_segments', count(distinct customer_id) from silver""",
    "patchy",
)
def e06(r: Retail) -> DataFrame:
    columns = ("order_id", "customer_id", "order_date", "order_status", "total_amount")
    out = fresh_path(r.spark, "medallion")
    return medallion.run_layers(
        r.spark, r.patchy_orders.select(*columns), out, "retail", STAMP, BANDS, FLOORS
    )


def analysis(r: Retail) -> dict[str, DataFrame]:
    customers = people(r).select("customer_id", "name", "state", "country")
    return reports.customer_analysis(customers, r.orders, fresh_name("customer_summary"))


@query("e07_customer_analysis", SUMMARY_SQL, "people ord")
def e07(r: Retail) -> DataFrame:
    return analysis(r)["summary"]


@query(
    "e07_top_customers",
    f"""select * from ({SUMMARY_SQL}) order by total_spent desc nulls last, customer_id limit 10""",
    "people ord",
)
def e07_top(r: Retail) -> DataFrame:
    return analysis(r)["top_customers"]


@query("e07_state_totals", SQL["a09_state_summary"])
def e07_states(r: Retail) -> DataFrame:
    return analysis(r)["by_state"]


@query(
    "e08_daily_sales_report",
    f", {SILVER_SQL}, {DAILY_SQL} select * from daily order by order_date desc limit 10",
    "patchy",
)
def e08(r: Retail) -> DataFrame:
    return reports.daily_sales_report(daily(r), 10)


@query(
    "e11_sales_trend",
    f""", {SILVER_SQL}, {DAILY_SQL}
        select order_date, total_orders as order_count, total_revenue as daily_revenue, avg_order_value
        from daily where order_date >= (select max(order_date) from daily) - 30""",
    "patchy",
)
def e11(r: Retail) -> DataFrame:
    return reports.sales_trend(daily(r), 30)


@query(
    "e12_customer_lifetime",
    f"""select customer_id, name, email, loyalty_tier, state, country,
               count(order_id) as total_orders,
               cast(coalesce(sum(total_amount), 0) as double) as lifetime_value,
               max(order_date) as last_order_date, date '2024-01-15' as summary_date
        from people left join ord using (customer_id)
        group by 1, 2, 3, 4, 5, 6""",
    "people ord",
)
def e12(r: Retail) -> DataFrame:
    return reports.customer_lifetime(people(r), r.orders, F.lit("2024-01-15").cast("date"))


@query(
    "e13_regional_revenue",
    f"""select state, country, count(distinct customer_id) as customer_count,
               count(order_id) as order_count, cast(sum(total_amount) as double) as total_revenue,
               cast(sum(total_amount) as double) / count(order_id) as avg_order_value
        from people left join ord using (customer_id) group by 1, 2
        having sum(total_amount) > (select sum(total_amount) * 0.04 from ord)""",
    "people ord",
)
def e13(r: Retail) -> DataFrame:
    share = F.sum("total_amount") * F.lit("0.04").cast("decimal(4,3)")
    return reports.regional_revenue(people(r), r.orders, r.orders.agg(share).scalar())


@query(
    "e14_order_totals",
    """select order_id, count(*) as items_count, cast(sum(line_total) as double) as order_total
       from item group by 1 order by sum(line_total) desc, order_id limit 10""",
    "item",
)
def e14(r: Retail) -> DataFrame:
    return reports.order_totals(r.items, 10)


def stored_transactions(r: Retail) -> DataFrame:
    """Transactions written with year and month folders."""
    path = fresh_path(r.spark, "transactions")
    layout.write_partitioned(transactions(r), path, ["transaction_year", "transaction_month"])
    return r.spark.read.parquet(path)


TX_SQL = """tx as (select customer_id, product_id, line_total as total_amount,
    order_date as transaction_date from ord join item using (order_id))"""


@query(
    "e15_daily_in_month",
    f""", {TX_SQL} select transaction_date, count(*) as transaction_count,
          cast(sum(total_amount) as double) as daily_revenue from tx
          where year(transaction_date) = 1998 and month(transaction_date) = 3 group by 1""",
    "ord item",
)
def e15(r: Retail) -> DataFrame:
    return reports.daily_in_month(stored_transactions(r), 1998, 3)


@query(
    "e17_inventory_status",
    """select product_id, product_name, stock_quantity::bigint as stock_quantity,
              reorder_level::bigint as reorder_level,
              case when stock_quantity = 0 then 'Out of Stock' when stock_quantity < reorder_level
                   then 'Low Stock' else 'In Stock' end as status
       from (select product_id, product_name, case when product_id % 9 = 0 then 0 else stock_quantity end
                    as stock_quantity, 10 as reorder_level from prod)""",
    "prod",
)
def e17(r: Retail) -> DataFrame:
    stock = F.when(F.col("product_id") % 9 == 0, 0).otherwise(F.col("stock_quantity"))
    products = r.products.select(
        "product_id", "product_name", stock.alias("stock_quantity"), F.lit(10).alias("reorder_level")
    )
    return reports.inventory_status(products)


@query(
    "e18_upgrade_candidates",
    """select customer_id, loyalty_tier, cast(total_purchases as double) as total_purchases,
              case loyalty_tier when 'HOUSEHOLD' then 'FURNITURE' when 'FURNITURE' then 'BUILDING'
                   when 'BUILDING' then 'MACHINERY' else 'Max Tier' end as next_tier,
              cast(case loyalty_tier when 'HOUSEHOLD' then 4000 - total_purchases when 'FURNITURE'
                   then 6000 - total_purchases when 'BUILDING' then 8000 - total_purchases else 0 end
                   as double) as amount_needed
       from cust where (loyalty_tier = 'HOUSEHOLD' and total_purchases > 3000)
          or (loyalty_tier = 'FURNITURE' and total_purchases > 5000)
          or (loyalty_tier = 'BUILDING' and total_purchases > 7000)""",
    "cust",
)
def e18(r: Retail) -> DataFrame:
    steps = {
        "HOUSEHOLD": (3000, 4000, "FURNITURE"),
        "FURNITURE": (5000, 6000, "BUILDING"),
        "BUILDING": (7000, 8000, "MACHINERY"),
    }
    rows = r.customers.select("customer_id", "loyalty_tier", "total_purchases")
    return reports.upgrade_candidates(rows, steps)


@query(
    "e19_tier_mismatches",
    """select * replace (cast(total_purchases as double) as total_purchases) from (
           select customer_id, total_purchases, loyalty_tier,
                  case when total_purchases >= 8000 then 'MACHINERY' when total_purchases >= 6000
                       then 'BUILDING' when total_purchases >= 4000 then 'FURNITURE'
                       else 'HOUSEHOLD' end as expected_tier from cust)
       where loyalty_tier <> expected_tier""",
    "cust",
)
def e19(r: Retail) -> DataFrame:
    floors = ((8000, "MACHINERY"), (6000, "BUILDING"), (4000, "FURNITURE"))
    rows = r.customers.select("customer_id", "total_purchases", "loyalty_tier")
    return reports.tier_mismatches(rows, floors, "HOUSEHOLD")


STATS = STATS_SQL.format(v="total_purchases")


@query(
    "e20_load_summary",
    f"""select 'all' as part, null as value, count(*) as row_count, null as total,
               null as average, null as minimum, null as maximum from cust
        union all select 'tier', loyalty_tier, {STATS} from cust group by 2
        union all select 'country', country, {STATS} from cust group by 2
        union all select 'top', name, 1, cast(total_purchases as double), null, null, null from
            (select * from cust order by total_purchases desc, customer_id limit 10)""",
    "cust",
)
def e20(r: Retail) -> DataFrame:
    parts = reports.load_summary(r.customers)

    def part(name: str, rows: DataFrame, value: str | None, **figures: str) -> DataFrame:
        wanted = {k: F.col(v) for k, v in figures.items()}
        return rows.select(
            F.lit(name).alias("part"), (F.col(value) if value else F.lit(None)).cast("string").alias("value"),
            wanted.get("row_count", F.lit(1)).cast("bigint").alias("row_count"),
            *[wanted.get(k, F.lit(None)).cast("double").alias(k) for k in ("total", "average", "minimum", "maximum")],
        )

    stats = {k: k for k in ("row_count", "total", "average", "minimum", "maximum")}
    return (
        part("all", parts["count"], None, row_count="total_customers")
        .unionByName(part("tier", parts["by_tier"], "loyalty_tier", **stats))
        .unionByName(part("country", parts["by_country"], "country", **stats))
        .unionByName(part("top", parts["top_customers"], "name", total="total_purchases"))
    )


@query(
    "e21_sample_profile",
    """select 'rows' as part, null as name, count(*) as number from cust
       union all select 'column', unnest(['customer_id bigint', 'name string', 'email string', 'state string']), unnest([1, 2, 3, 4])
       union all select 'nulls', unnest(['customer_id', 'name', 'email', 'state']),
                        unnest([count(*) filter (customer_id is null), count(*) filter (name is null),
                                count(*) filter (email is null), count(*) filter (state is null)]) from cust
       union all select 'sample', '{"customer_id":' || customer_id || ',"name":"' || name || '"' ||
                        coalesce(',"email":"' || email || '"', '') || ',"state":"' || state || '"}', null
                 from (select * from cust order by customer_id limit 10)""",
    "cust",
)
def e21(r: Retail) -> DataFrame:
    """Row count, columns with their types, NULL counts and the ten first customers as JSON."""
    name, columns = fresh_name("profiled_customers"), ("customer_id", "name", "email", "state")
    r.customers.select(*columns).createOrReplaceTempView(name)
    profile = reports.sample_profile(r.spark, name, 10, order=["customer_id"])
    kinds = [("column", f"{f.name} {f.dataType.simpleString()}", k + 1) for k, f in enumerate(profile["columns"])]
    known = r.spark.createDataFrame([("rows", None, profile["rows"]), *kinds], "part string, name string, number bigint")
    nulls = profile["nulls"].select(
        F.lit("nulls").alias("part"), F.col("column_name").alias("name"), F.col("null_count").cast("bigint").alias("number"))
    sample = profile["sample"].select(
        F.lit("sample").alias("part"), F.col("json").alias("name"), F.lit(None).cast("bigint").alias("number"))
    return known.unionByName(nulls).unionByName(sample)


@query(
    "e22_tx_totals",
    f""", {TX_SQL} select 'all' as scope, count(*) as total_transactions,
                cast(sum(total_amount) as double) as total_revenue from tx
          union all select 'one month', count(*), cast(sum(total_amount) as double) from tx
                where year(transaction_date) = 1998 and month(transaction_date) = 3""",
    "ord item",
)
def e22(r: Retail) -> DataFrame:
    stored = stored_transactions(r)
    everything = reports.tx_totals(stored).withColumn("scope", F.lit("all"))
    month = reports.tx_totals(stored, 1998, 3).withColumn("scope", F.lit("one month"))
    return everything.unionByName(month)


@query(
    "e23_customer_orders",
    """select order_id, customer_id, order_date, cast(total_amount as double) as total_amount
       from ord where customer_id = (select customer_id from ord group by 1
                                     order by count(*) desc, customer_id limit 1)""",
    "ord",
)
def e23(r: Retail) -> DataFrame:
    """The orders of the busiest customer, read from a sorted layout."""
    path = fresh_path(r.spark, "orders-sorted")
    rows = r.orders.select("order_id", "customer_id", "order_date", "total_amount", "order_status")
    layout.write_sorted(rows, path, ["order_status"], ["customer_id", "order_date"])
    stored = r.spark.read.parquet(path).drop("order_status")
    counts = stored.groupBy("customer_id").agg(F.count("*").alias("n"))
    busiest = counts.orderBy(F.desc("n"), "customer_id").limit(1).select("customer_id").scalar()
    return reports.customer_orders(stored, busiest)
