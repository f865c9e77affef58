"""Projections, filters, joins, aggregates, windows, sorts, limits and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyhouse.catalog.base import query
from tallyhouse.functions import expressions as X
from tallyhouse.operators import aggregates as agg, ranking as rank, relational as rel
from tallyhouse.plans.medallion import stamp
from tallyhouse.plans.reports import monthly_revenue, segment_report
from tallyhouse.schemas import MONEY
from tallyhouse.sources.retail import Retail

# The test amounts run to 500,000, so bands and floors are set to match.
BANDS = ((100_000, "LOW"), (250_000, "MEDIUM"), (400_000, "HIGH"))
BAND_SQL = """case when total_amount < 100000 then 'LOW' when total_amount < 250000 then 'MEDIUM'
                   when total_amount < 400000 then 'HIGH' else 'PREMIUM' end"""
FLOORS = ((3_000_000, "VIP"), (2_000_000, "PREMIUM"), (1_000_000, "REGULAR"))
FLOOR_SQL = """case when lifetime_value >= 3000000 then 'VIP' when lifetime_value >= 2000000
                    then 'PREMIUM' when lifetime_value >= 1000000 then 'REGULAR' else 'NEW' end"""
PURCHASES = ((7000, "High Value"), (3000, "Medium Value"))
PURCHASE_SQL = """case when total_purchases >= 7000 then 'High Value'
                       when total_purchases >= 3000 then 'Medium Value' else 'Low Value' end"""
TIERS = ("MACHINERY", "BUILDING", "FURNITURE", "HOUSEHOLD")
YEAR = 1998
ONE_YEAR = f"order_date >= date '{YEAR}-01-01' and order_date < date '{YEAR + 1}-01-01'"


def people(r: Retail) -> DataFrame:
    """Customers, and suppliers as customers who never ordered."""
    nations = r.raw("nation").join(r.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    suppliers = r.raw("supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
        (F.col("s_suppkey") + 1_000_000_000).alias("customer_id"), F.col("s_name").alias("name"),
        F.lit(None).cast("string").alias("email"), F.lit("SUPPLIER").alias("loyalty_tier"),
        F.col("n_name").alias("state"), F.col("r_name").alias("country"),
    )
    return r.customers.drop("total_purchases").unionByName(suppliers)


# --- projections and filters ------------------------------------------------

@query(
    "p01_select_rename",
    """select customer_id, name as customer_name, loyalty_tier as current_tier, state, country
       from cust""",
    "cust",
)
def p01(r: Retail) -> DataFrame:
    return r.customers.select(
        "customer_id", F.col("name").alias("customer_name"),
        F.col("loyalty_tier").alias("current_tier"), "state", "country",
    )


@query(
    "p02_comparisons",
    """select customer_id, loyalty_tier, cast(total_purchases as double) as total_purchases from cust
       where (loyalty_tier = 'BUILDING' and total_purchases > 8000)
          or (loyalty_tier = 'MACHINERY' and total_purchases > 5000) or country = 'ASIA'""",
    "cust",
)
def p02(r: Retail) -> DataFrame:
    tier, value = F.col("loyalty_tier"), F.col("total_purchases")
    wanted = (
        ((tier == "BUILDING") & (value > 8000))
        | ((tier == "MACHINERY") & (value > 5000))
        | (F.col("country") == "ASIA")
    )
    return r.customers.where(wanted).select("customer_id", "loyalty_tier", "total_purchases")


@query(
    "p03_in_list",
    """select o_orderkey as order_id, o_orderpriority as order_priority from orders
       where o_orderpriority in ('1-URGENT', '2-HIGH') and o_orderstatus in ('F', 'P')""",
)
def p03(r: Retail) -> DataFrame:
    chosen = F.col("order_priority").isin("1-URGENT", "2-HIGH") & F.col("order_status").isin("F", "P")
    return r.orders.where(chosen).select("order_id", "order_priority")


@query(
    "p04_like_prefix",
    "select product_id, product_name from prod where product_name like 'b%'",
    "prod",
)
def p04(r: Retail) -> DataFrame:
    return r.products.where(F.col("product_name").startswith("b")).select("product_id", "product_name")


@query(
    "p05_present",
    """select customer_id, email, (email is not null and email <> '') as present from cust
       where email is null or email = '' or email like 'user1%'""",
    "cust",
)
def p05(r: Retail) -> DataFrame:
    chosen = ~X.is_present("email") | F.col("email").isNull() | F.col("email").like("user1%")
    present = F.coalesce(X.is_present("email"), F.lit(False))
    return r.customers.where(chosen).select("customer_id", "email", present.alias("present"))


@query(
    "p06_date_range",
    """select order_id, order_date from ord
       where order_date >= date '1997-03-01' and order_date < date '1997-06-01'""",
    "ord",
)
def p06(r: Retail) -> DataFrame:
    return rel.between_dates(r.orders, "order_timestamp", "1997-03-01", "1997-06-01").select(
        "order_id", "order_date"
    )


@query(
    "p07_last_days",
    """select order_id, order_date from ord
       where order_date >= (select max(order_date) from ord) - 90""",
    "ord",
)
def p07(r: Retail) -> DataFrame:
    return rel.last_days(r.orders, "order_timestamp", 90).select("order_id", "order_date")


@query(
    "p08_amount_band",
    f"select order_id, {BAND_SQL} as amount_category from ord",
    "ord",
)
def p08(r: Retail) -> DataFrame:
    return r.orders.select("order_id", X.amount_category("total_amount", BANDS).alias("amount_category"))


@query(
    "p09_decode",
    """select customer_id, case loyalty_tier when 'HOUSEHOLD' then 'FURNITURE' when 'FURNITURE'
              then 'BUILDING' when 'BUILDING' then 'MACHINERY' else 'Max Tier' end as next_tier
       from cust""",
    "cust",
)
def p09(r: Retail) -> DataFrame:
    steps = {"HOUSEHOLD": "FURNITURE", "FURNITURE": "BUILDING", "BUILDING": "MACHINERY"}
    return r.customers.select("customer_id", X.decode("loyalty_tier", steps, "Max Tier").alias("next_tier"))


@query(
    "p10_null_default",
    """select order_id, coalesce(order_status, 'UNKNOWN') as status,
              cast(coalesce(total_amount, 0) as double) as amount from patchy""",
    "patchy",
)
def p10(r: Retail) -> DataFrame:
    return r.patchy_orders.select(
        "order_id",
        X.status_clean("order_status").alias("status"),
        F.coalesce("total_amount", F.lit(0).cast(MONEY)).alias("amount"),
    )


@query(
    "p11_stamp",
    """select order_id, '2024-01-15 08:00:00' as ingestion_timestamp, 'retail' as source_system
       from ord""",
    "ord",
)
def p11(r: Retail) -> DataFrame:
    return stamp(r.orders.select("order_id"), "retail", "2024-01-15 08:00:00")


@query(
    "p12_line_total",
    """select order_id, product_id, quantity::bigint as quantity, cast(discount_percent as double) as discount_percent,
              cast(cast(unit_price * quantity * ((100 - discount_percent) * 0.01)
                   as decimal(18,2)) as double) as total from item""",
    "item",
)
def p12(r: Retail) -> DataFrame:
    return r.items.select(
        "order_id", "product_id", "quantity", "discount_percent",
        X.line_total("unit_price", "quantity", "discount_percent").alias("total"),
    )


# --- joins ------------------------------------------------------------------

@query(
    "j01_join_group",
    """select country, count(*) as order_count, cast(sum(total_amount) as double) as revenue
       from cust join ord using (customer_id) group by 1""",
    "cust ord",
)
def j01(r: Retail) -> DataFrame:
    stats = rel.order_stats(r.orders)
    return r.customers.join(stats, "customer_id").groupBy("country").agg(
        F.sum("order_count").alias("order_count"), F.sum("total_spent").alias("revenue")
    )


SUMMARY_SQL = f"""
    select customer_id, name, state, country, count(order_id) as order_count,
           cast(sum(total_amount) as double) as total_spent,
           cast(sum(total_amount) as double) / nullif(count(order_id), 0) as avg_order_value,
           max(order_date) as last_order_date
    from people left join ord using (customer_id)
    group by 1, 2, 3, 4"""


def summary(r: Retail) -> DataFrame:
    return rel.customer_summary(people(r).select("customer_id", "name", "state", "country"), r.orders)


query("j02_customer_summary", SUMMARY_SQL, "people ord")(summary)


@query(
    "j03_left_join_stats",
    f"""select customer_id, name, order_count, cast(total_spent as double) as total_spent
        from people left join (select customer_id, count(*) as order_count,
             sum(total_amount) as total_spent from ord group by 1)
             using (customer_id)""",
    "people ord",
)
def j03(r: Retail) -> DataFrame:
    return rel.left_join_stats(people(r).select("customer_id", "name"), r.orders)


@query(
    "j04_left_join_filled",
    f""", stats as (select customer_id, count(*) as order_count, sum(total_amount) as total_spent
                    from ord group by 1)
        select customer_id, name, coalesce(order_count, 0) as order_count,
               cast(coalesce(total_spent, 0) as double) as total_spent
        from people left join stats using (customer_id)""",
    "people ord",
)
def j04(r: Retail) -> DataFrame:
    return rel.left_join_stats(people(r).select("customer_id", "name"), r.orders, fill=0)


ITEM_ORDER = ("product_id", "supplier_id", "line_number", "quantity", "unit_price", "ship_date")


def transactions(r: Retail) -> DataFrame:
    return rel.sales_transactions(r.orders, r.items, item_order=ITEM_ORDER)


@query(
    "j06_sales_transactions",
    f"""select row_number() over (order by order_id, {', '.join(ITEM_ORDER)}) as transaction_id,
               customer_id, product_id, quantity::bigint as quantity, cast(unit_price as double) as unit_price,
               cast(line_total as double) as total_amount, order_date as transaction_date,
               year(order_date) as transaction_year, month(order_date) as transaction_month,
               strftime(order_timestamp, '%Y-%m-%d %H:%M:%S') as transaction_timestamp
        from ord join item using (order_id)""",
    "ord item",
)
def j06(r: Retail) -> DataFrame:
    return transactions(r)


TOP_PRODUCT_SQL = """
    select product_name, category, brand, count(distinct order_id) as order_count,
           sum(quantity)::bigint as total_quantity_sold,
           cast(sum(line_total) as double) as total_revenue,
           cast(sum(unit_price) as double) / count(unit_price) as avg_unit_price
    from item join prod using (product_id) group by 1, 2, 3
    order by sum(line_total) desc, product_name, category, brand limit 10"""


def best_sellers(r: Retail) -> DataFrame:
    return rel.top_products(r.items, r.products, 10)


query("j07_top_products", TOP_PRODUCT_SQL, "item prod")(best_sellers)
query("e10_top_products", TOP_PRODUCT_SQL, "item prod")(best_sellers)


@query(
    "j08_lookup_join",
    """select category, brand, count(*) as item_count, cast(sum(line_total) as double) as revenue
       from item join prod using (product_id) group by 1, 2""",
    "item prod",
)
def j08(r: Retail) -> DataFrame:
    named = rel.lookup_join(r.items, r.products, "product_id")
    return named.groupBy("category", "brand").agg(
        F.count("*").alias("item_count"), F.sum("line_total").alias("revenue")
    )


@query(
    "j09_bucket_join",
    """select customer_id, name, order_id, cast(total_amount as double) as total_amount
       from cust join ord using (customer_id)""",
    "cust ord",
)
def j09(r: Retail) -> DataFrame:
    return bucketed_join(r.customers.select("customer_id", "name"), r.orders.select("customer_id", "order_id", "total_amount"))


def bucketed_join(customers: DataFrame, orders: DataFrame) -> DataFrame:
    buckets = rel.bucket_count(customers, orders)
    sides = [rel.bucket_table(side, "customer_id", buckets) for side in (customers, orders)]
    return rel.bucket_join(*sides, "customer_id")


@query(
    "j09_bucket_join_hot_keys",
    """, skewed as (select *, case when order_id % 3 = 0 then 7 else customer_id end as owner from ord)
       select cust.customer_id, name, order_id, cast(total_amount as double) as total_amount
       from cust join skewed on owner = cust.customer_id""",
    "cust ord",
)
def j09_hot(r: Retail) -> DataFrame:
    """One customer holds a third of all orders."""
    owner = F.when(F.col("order_id") % 3 == 0, 7).otherwise(F.col("customer_id")).cast("bigint")
    orders = r.orders.select(owner.alias("customer_id"), "order_id", "total_amount")
    return bucketed_join(r.customers.select(F.col("customer_id").cast("bigint"), "name"), orders)


@query(
    "j10_orphans",
    """select order_id, customer_id from ord where customer_id not in
       (select customer_id from cust where loyalty_tier <> 'BUILDING')""",
    "cust ord",
)
def j10(r: Retail) -> DataFrame:
    parents = r.customers.where(F.col("loyalty_tier") != "BUILDING")
    return rel.orphans(r.orders, parents, "customer_id", "customer_id").select("order_id", "customer_id")


# --- aggregates -------------------------------------------------------------

@query("a01_count", "select count(*) as row_count from lineitem")
def a01(r: Retail) -> DataFrame:
    return r.items.agg(F.count("*").alias("row_count"))


STATS_SQL = """count(*) as row_count, cast(sum({v}) as double) as total,
    cast(sum({v}) as double) / count({v}) as average, cast(min({v}) as double) as minimum,
    cast(max({v}) as double) as maximum"""


@query(
    "a02_group_stats",
    f"select country, loyalty_tier, {STATS_SQL.format(v='total_purchases')} from cust group by 1, 2",
    "cust",
)
def a02(r: Retail) -> DataFrame:
    return agg.group_stats(r.customers, ["country", "loyalty_tier"], "total_purchases")


@query(
    "a03_distinct_count",
    """select order_status, count(distinct customer_id) as customers,
              count(distinct order_date) as days from ord group by 1""",
    "ord",
)
def a03(r: Retail) -> DataFrame:
    return r.orders.groupBy("order_status").agg(
        F.countDistinct("customer_id").alias("customers"), F.countDistinct("order_date").alias("days")
    )


@query("a04_duplicates", "select email, count(*) as count from cust group by 1 having count(*) > 1", "cust")
def a04(r: Retail) -> DataFrame:
    return rel.duplicates(r.customers, ["email"])


DESCRIBE_SQL = STATS_SQL + """, cast(cast(stddev_samp({v}) as decimal(18,4)) as double) as std_deviation,
    cast(quantile_cont(cast({v} as double), 0.5) as double) as median"""


def settled(df: DataFrame) -> DataFrame:
    """Standard deviation to four places: the last digits depend on the order of addition."""
    return df.withColumn("std_deviation", F.col("std_deviation").cast("decimal(18,4)"))


@query(
    "a05_describe",
    f"select {DESCRIBE_SQL.format(v='total_purchases')} from cust",
    "cust",
)
def a05(r: Retail) -> DataFrame:
    return settled(agg.describe_value(r.customers, "total_purchases"))


@query(
    "a06_describe_groups",
    f"select order_status, {DESCRIBE_SQL.format(v='total_amount')} from patchy group by 1",
    "patchy",
)
def a06(r: Retail) -> DataFrame:
    return settled(agg.describe_value(r.patchy_orders, "total_amount", ["order_status"]))


@query(
    "a07_segment_share",
    f"""select {PURCHASE_SQL} as customer_segment, {STATS_SQL.format(v='total_purchases')},
               count(*) * 100.0::double / (select count(*) from cust) as percentage
        from cust group by 1""",
    "cust",
)
def a07(r: Retail) -> DataFrame:
    return agg.segment_share(r.customers, "total_purchases", PURCHASES)


MONTHLY_SQL = f"select strftime(order_date, '%Y-%m') as month, {STATS_SQL.format(v='total_amount')} from ord group by 1"
query("a08_group_by_month", MONTHLY_SQL, "ord")(lambda r: monthly_revenue(r.orders))
query("e16_monthly_revenue", MONTHLY_SQL, "ord")(lambda r: monthly_revenue(r.orders))


@query(
    "a08_group_by_domain",
    """select nullif(regexp_extract(email, '@(.*)$', 1), '') as email_domain, count(*) as customer_count
       from cust group by 1""",
    "cust",
)
def a08_domain(r: Retail) -> DataFrame:
    return r.customers.groupBy(X.email_domain("email").alias("email_domain")).agg(
        F.count("*").alias("customer_count")
    )


@query(
    "a09_state_summary",
    f""", s as ({SUMMARY_SQL})
        select state, country, count(customer_id) as customer_count,
               sum(total_spent_exact)::double as total_revenue,
               cast(sum(cast(avg_order_value as decimal(28,6))) as double) / count(avg_order_value)
                   as avg_order_value,
               sum(total_spent_exact)::double / sum(order_count) as weighted_order_value
        from (select *, cast(total_spent as decimal(18,2)) as total_spent_exact from s)
        group by 1, 2""",
    "people ord",
)
def a09(r: Retail) -> DataFrame:
    return agg.state_summary(summary(r))


@query(
    "a10_count_where",
    f"""select 'all' as scope, count(*) as row_count from ord
        union all select 'one year', count(*) from ord where {ONE_YEAR}
        union all select 'large', count(*) from ord where total_amount > 250000""",
    "ord",
)
def a10(r: Retail) -> DataFrame:
    scopes = {
        "all": F.lit(True),
        "one year": X.in_range("order_timestamp", X.day(f"{YEAR}-01-01"), X.day(f"{YEAR + 1}-01-01")),
        "large": F.col("total_amount") > 250_000,
    }
    parts = [
        agg.count_where(r.orders, p).select(F.lit(s).alias("scope"), "row_count")
        for s, p in scopes.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


ROLLUP_SQL = """select customer_id, count(order_id) as order_count, sum(total_amount) as lifetime_value,
    cast(sum(total_amount) as double) / count(total_amount) as avg_order_value,
    max(order_date) as last_order_date from ord where total_amount > 0 group by 1"""


@query(
    "a11_customer_rollup",
    f"select * replace (cast(lifetime_value as double) as lifetime_value) from ({ROLLUP_SQL})",
    "ord",
)
def a11(r: Retail) -> DataFrame:
    return agg.customer_rollup(r.orders)


DAILY_SQL = """select order_date, count(*) as order_count, sum(total_amount) as daily_revenue
    from ord group by 1"""


def daily_sales(r: Retail) -> DataFrame:
    return r.orders.groupBy("order_date").agg(
        F.count("*").alias("order_count"), F.sum("total_amount").alias("daily_revenue")
    )


@query(
    "a12_kpis",
    f"""select cast(sum(daily_revenue) as double) as total_revenue,
               cast(sum(daily_revenue) as double) / count(daily_revenue) as avg_daily_revenue,
               sum(order_count)::bigint as total_orders,
               cast(sum(daily_revenue) as double) / sum(order_count) as avg_order_value,
               (select count(distinct customer_id) from ord) as total_customers
        from ({DAILY_SQL})""",
    "ord",
)
def a12(r: Retail) -> DataFrame:
    segments = r.orders.select("customer_id").distinct().agg(F.count("*").alias("customer_count"))
    return agg.kpis(daily_sales(r), segments)


@query(
    "a13_trend",
    f""", d as (select cast(row_number() over (order by order_date) - 1 as decimal(10,0)) as x,
                       cast(daily_revenue as decimal(22,2)) as y from ({DAILY_SQL})),
        s as (select cast(count(*) as double) as n, cast(sum(x) as double) as sx,
                     cast(sum(y) as double) as sy, cast(sum(x * x) as double) as sxx,
                     cast(sum(x * y) as double) as sxy from d)
        select (n * sxy - sx * sy) / (n * sxx - sx * sx) as slope,
               (sy - (n * sxy - sx * sy) / (n * sxx - sx * sx) * sx) / n as intercept from s""",
    "ord",
)
def a13(r: Retail) -> DataFrame:
    return agg.trend(daily_sales(r))


@query(
    "a14_null_profile",
    """select unnest(['order_id', 'customer_id', 'order_status', 'total_amount']) as column_name,
              unnest([count(*) filter (order_id is null), count(*) filter (customer_id is null),
                      count(*) filter (order_status is null), count(*) filter (total_amount is null)])
              as null_count from patchy""",
    "patchy",
)
def a14(r: Retail) -> DataFrame:
    return agg.null_profile(
        r.patchy_orders.select("order_id", "customer_id", "order_status", "total_amount")
    )


COMPLETENESS_SQL = """
    select 'Total Records' as metric, count(*) as value from cust
    union all select 'Records with Email', count(*) from cust where email is not null and email <> ''
    union all select 'Records with Country', count(*) from cust
                     where country is not null and country <> ''
    union all select 'Records with Loyalty Tier', count(*) from cust where loyalty_tier is not null"""
query("a15_completeness", COMPLETENESS_SQL, "cust")(lambda r: agg.customer_completeness(r.customers))


# --- windows ----------------------------------------------------------------

@query(
    "w01_rank_top",
    """select customer_id, name, cast(total_purchases as double) as total_purchases,
              rank() over (order by total_purchases desc) as purchase_rank,
              dense_rank() over (order by total_purchases desc) as dense_rank,
              row_number() over (order by total_purchases desc, customer_id) as row_num
       from cust order by total_purchases desc, customer_id limit 10""",
    "cust",
)
def w01(r: Retail) -> DataFrame:
    return rank.rank_top(
        r.customers.select("customer_id", "name", "total_purchases"), "total_purchases", 10, "customer_id"
    )


@query(
    "w02_top_per_group",
    """select state, customer_id, cast(total_purchases as double) as total_purchases from
       (select *, rank() over (partition by state order by total_purchases desc) as place from cust)
       where place = 1""",
    "cust",
)
def w02(r: Retail) -> DataFrame:
    rows = r.customers.select("state", "customer_id", "total_purchases")
    return rank.top_per_group(rows, "state", "total_purchases")


DAY_SQL = """select order_date as day, count(*) as row_count, sum(total_amount) as daily_value
    from ord group by 1"""
DAY_COLUMNS = "day, row_count, cast(daily_value as double) as daily_value"


def days(r: Retail) -> DataFrame:
    return agg.daily_totals(r.orders, "order_date", "total_amount")


@query(
    "w03_running_total",
    f"""select {DAY_COLUMNS}, cast(sum(daily_value) over (order by day) as double) as running_total
        from ({DAY_SQL})""",
    "ord",
)
def w03(r: Retail) -> DataFrame:
    return rank.running_total(days(r))


@query(
    "w04_moving_avg",
    f"""select {DAY_COLUMNS}, cast(sum(daily_value) over w as double) / count(daily_value) over w
               as moving_avg from ({DAY_SQL})
        window w as (order by day rows between 2 preceding and current row)""",
    "ord",
)
def w04(r: Retail) -> DataFrame:
    return rank.moving_avg(days(r), 3)


@query(
    "w05_percentiles",
    """select customer_id, cast(total_purchases as double) as total_purchases,
              percent_rank() over (order by total_purchases) as percent_rank,
              ntile(4) over (order by total_purchases, customer_id) as quartile from cust""",
    "cust",
)
def w05(r: Retail) -> DataFrame:
    rows = r.customers.select("customer_id", "total_purchases")
    return rank.percentiles(rows, "total_purchases", "customer_id")


@query(
    "w06_rolling_mean",
    f"""select {DAY_COLUMNS}, case when count(daily_value) over w = 7
               then cast(sum(daily_value) over w as double) / 7 end as rolling_mean
        from ({DAY_SQL}) window w as (order by day rows between 6 preceding and current row)""",
    "ord",
)
def w06(r: Retail) -> DataFrame:
    return rank.rolling_mean(days(r), 7)


@query(
    "w07_surrogate_key",
    """select row_number() over (order by order_date, order_id) as row_id, order_id, order_date
       from ord""",
    "ord",
)
def w07(r: Retail) -> DataFrame:
    return rank.surrogate_key(r.orders.select("order_id", "order_date"), ["order_date", "order_id"])


SEGMENT_REPORT_SQL = f"""
    , seg as (select *, {FLOOR_SQL} as customer_segment from ({ROLLUP_SQL}))
    select customer_segment, count(*) as customer_count,
           cast(sum(lifetime_value) as double) as total_revenue,
           cast(sum(cast(avg_order_value as decimal(28,6))) as double) / count(avg_order_value)
               as mean_avg_order_value,
           cast(sum(lifetime_value) as double) / count(*) as avg_lifetime_value,
           cast(sum(lifetime_value) as double) * 100
               / cast((select sum(lifetime_value) from seg) as double) as revenue_percentage
    from seg group by 1"""


def segment_revenue(r: Retail) -> DataFrame:
    segment = X.floor_band("lifetime_value", FLOORS, "NEW")
    return segment_report(agg.customer_rollup(r.orders).withColumn("customer_segment", segment))


query("w08_segment_revenue", SEGMENT_REPORT_SQL, "ord")(segment_revenue)
query("e09_segment_report", SEGMENT_REPORT_SQL, "ord")(segment_revenue)


# --- sorts, limits, sets, subqueries ----------------------------------------

@query(
    "t01_sort",
    """select order_id, order_status, cast(total_amount as double) as total_amount from patchy
       order by order_status asc nulls last, total_amount desc nulls last, order_id""",
    "patchy",
)
def t01(r: Retail) -> DataFrame:
    return r.patchy_orders.select("order_id", "order_status", "total_amount").orderBy(
        F.asc_nulls_last("order_status"), F.desc_nulls_last("total_amount"), "order_id"
    )


@query(
    "t02_sort_by_rank",
    """select loyalty_tier, count(*) as customer_count from cust group by 1 order by
       case loyalty_tier when 'MACHINERY' then 1 when 'BUILDING' then 2 when 'FURNITURE' then 3
       when 'HOUSEHOLD' then 4 end nulls last""",
    "cust",
)
def t02(r: Retail) -> DataFrame:
    counts = r.customers.groupBy("loyalty_tier").agg(F.count("*").alias("customer_count"))
    return rel.order_by_rank(counts, "loyalty_tier", TIERS)


@query(
    "t03_top_k",
    """select order_id, cast(total_amount as double) as total_amount from patchy
       order by total_amount desc nulls last, order_id limit 20""",
    "patchy",
)
def t03(r: Retail) -> DataFrame:
    return rel.top_k(r.patchy_orders.select("order_id", "total_amount"), "total_amount", 20, "order_id")


@query("t04_preview")
def t04(r: Retail) -> DataFrame:
    return rel.preview(r.items, 10)


@query("t05_distinct", "select distinct order_status, order_priority from ord", "ord")
def t05(r: Retail) -> DataFrame:
    return r.orders.select("order_status", "order_priority").distinct()


@query(
    "t06_union_all",
    """select 'customer' as kind, c_custkey as id, c_nationkey::bigint as nation from customer
       union all select 'supplier', s_suppkey, s_nationkey from supplier""",
)
def t06(r: Retail) -> DataFrame:
    buyers = r.raw("customer").select(
        F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation")
    )
    sellers = r.raw("supplier").select(
        F.col("s_nationkey").alias("nation"), F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id")
    )
    return buyers.unionByName(sellers)


@query(
    "t07_scalar_subquery",
    """select order_status, count(*) as row_count, (select count(*) from ord) as all_rows,
              (select max(order_date) from ord) as last_day from ord group by 1""",
    "ord",
)
def t07(r: Retail) -> DataFrame:
    return r.orders.groupBy("order_status").agg(F.count("*").alias("row_count")).withColumns(
        {
            "all_rows": r.orders.agg(F.count("*")).scalar(),
            "last_day": r.orders.agg(F.max("order_date")).scalar(),
        }
    )


@query(
    "t08_named_subqueries",
    """, per_customer as (select customer_id, sum(total_amount) as spent from ord group by 1),
       per_state as (select state, max(spent) as best from cust join per_customer using (customer_id)
                     group by 1)
       select state, cast(best as double) as best from per_state
       where best > (select avg(best) from per_state)""",
    "cust ord",
)
def t08(r: Retail) -> DataFrame:
    per_customer = r.orders.groupBy("customer_id").agg(F.sum("total_amount").alias("spent"))
    per_state = r.customers.join(per_customer, "customer_id").groupBy("state").agg(
        F.max("spent").alias("best")
    )
    average = per_state.agg(F.avg(F.col("best").cast("double"))).scalar()
    return per_state.where(F.col("best") > average)


# --- scalar functions -------------------------------------------------------

@query(
    "f01_date_parts",
    """select order_id, year(order_date) as order_year, month(order_date) as order_month,
              day(order_date) as order_day from ord""",
    "ord",
)
def f01(r: Retail) -> DataFrame:
    return r.orders.select(
        "order_id", F.year("order_date").alias("order_year"), F.month("order_date").alias("order_month"),
        F.dayofmonth("order_date").alias("order_day"),
    )


@query("f02_month_label", "select order_id, strftime(order_date, '%Y-%m') as month from ord", "ord")
def f02(r: Retail) -> DataFrame:
    return r.orders.select("order_id", X.month_label("order_date").alias("month"))


@query(
    "f03_days_since",
    "select order_id, date '2002-01-01' - order_date as days from ord",
    "ord",
)
def f03(r: Retail) -> DataFrame:
    return r.orders.select("order_id", X.days_since("order_date", "2002-01-01").alias("days"))


@query(
    "f04_interval_arithmetic",
    """select order_id, cast(order_date - interval 90 day as date) as earlier,
              strftime(order_timestamp + interval 36 hour, '%Y-%m-%d %H:%M:%S') as later,
              order_date >= date '1998-01-01' as recent from ord""",
    "ord",
)
def f04(r: Retail) -> DataFrame:
    return r.orders.select(
        "order_id",
        F.date_sub("order_date", 90).alias("earlier"),
        (F.col("order_timestamp") + F.expr("INTERVAL '36' HOUR")).alias("later"),
        (F.col("order_date") >= X.day("1998-01-01")).alias("recent"),
    )


@query(
    "f05_age_text",
    """select order_id, 'INTERVAL ''' || (date '2002-01-01' - order_date) ||
              ' 00:00:00'' DAY TO SECOND' as age from ord""",
    "ord",
)
def f05(r: Retail) -> DataFrame:
    return r.orders.select("order_id", X.age("order_timestamp", "2002-01-01 00:00:00").alias("age"))


@query(
    "f06_round",
    """select order_id, cast(round(cast(total_amount as decimal(18,2)) * cast(0.37 as decimal(3,2)), 2)
              as double) as rounded from ord""",
    "ord",
)
def f06(r: Retail) -> DataFrame:
    share = F.col("total_amount") * F.lit("0.37").cast("decimal(3,2)")
    return r.orders.select("order_id", F.round(share, 2).alias("rounded"))


@query(
    "f07_casts",
    """select order_id, cast(round(o_totalprice) as bigint) as rounded, cast(order_id as varchar) as key_text,
              cast(cast(o_totalprice as decimal(10,1)) as double) as one_place,
              strftime(cast(order_date as timestamp), '%Y-%m-%d %H:%M:%S') as at
       from ord join (select o_orderkey as order_id, o_totalprice from orders) using (order_id)""",
    "ord",
)
def f07(r: Retail) -> DataFrame:
    return r.raw("orders").select(
        F.col("o_orderkey").alias("order_id"),
        X.rounded_long("o_totalprice").alias("rounded"),
        F.col("o_orderkey").cast("string").alias("key_text"),
        F.col("o_totalprice").cast("decimal(10,1)").alias("one_place"),
        F.col("o_orderdate").cast("date").cast("timestamp_ntz").alias("at"),
    )


@query("f08_random")
def f08(r: Retail) -> DataFrame:
    return r.orders.select("order_id", F.rand(42).alias("random"))


@query(
    "f09_email_domain",
    "select customer_id, nullif(regexp_extract(email, '@(.*)$', 1), '') as email_domain from cust",
    "cust",
)
def f09(r: Retail) -> DataFrame:
    return r.customers.select("customer_id", X.email_domain("email").alias("email_domain"))


@query("f10_rpad", "select customer_id, rpad(name, 24, '.') as padded from cust", "cust")
def f10(r: Retail) -> DataFrame:
    return r.customers.select("customer_id", F.rpad("name", 24, ".").alias("padded"))


@query(
    "f11_to_number",
    """select order_id, try_cast(case when order_id % 3 = 0 then 'n/a'
              else cast(order_id as varchar) || '.5' end as double) as number from ord""",
    "ord",
)
def f11(r: Retail) -> DataFrame:
    text = F.when(F.col("order_id") % 3 == 0, "n/a").otherwise(
        F.concat(F.col("order_id").cast("string"), F.lit(".5"))
    )
    return r.orders.select("order_id", X.to_number(text).alias("number"))


@query(
    "f12_to_date",
    """select order_id, try_cast(case when order_id % 4 = 0 then 'soon'
              else strftime(order_date, '%Y-%m-%d') end as date) as day from ord""",
    "ord",
)
def f12(r: Retail) -> DataFrame:
    text = F.when(F.col("order_id") % 4 == 0, "soon").otherwise(F.col("order_date").cast("string"))
    return r.orders.select("order_id", X.to_day(text).alias("day"))
