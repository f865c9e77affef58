"""Scans, sources, sinks, schemas and constraints."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from tallyhouse.catalog.base import query
from tallyhouse.functions.expressions import has_tag, is_present, spec, volume
from tallyhouse.operators.changes import update_where
from tallyhouse.operators.constraints import Rules, add_column, check_constraints
from tallyhouse.operators.relational import customer_summary, order_stats
from tallyhouse.schemas import SCHEMAS
from tallyhouse.session import fresh_name, fresh_path
from tallyhouse.sources import generators, readers, writers
from tallyhouse.sources.retail import Retail

STATUS_NAMES = (("F", "Fulfilled"), ("O", "Open"), ("P", "Pending"))
STATUS_SQL = "(values ('F', 'Fulfilled'), ('O', 'Open'), ('P', 'Pending')) names(order_status, status_name)"


@query(
    "s01_table_by_name",
    """select o_orderstatus as order_status, count(*) as row_count, max(o_orderkey) as last_key
       from orders group by 1""",
)
def s01(r: Retail) -> DataFrame:
    readers.register_views(r.spark, r.folder)
    orders = readers.table(r.spark, "orders")
    return orders.groupBy(F.col("o_orderstatus").alias("order_status")).agg(
        F.count("*").alias("row_count"), F.max("o_orderkey").alias("last_key")
    )


@query(
    "s02_read_csv",
    """select order_id, customer_id, order_date, order_status, cast(total_amount as double)
       as total_amount from ord""",
    "ord",
)
def s02(r: Retail) -> DataFrame:
    path = fresh_path(r.spark, "csv")
    rows = r.orders.select("order_id", "customer_id", "order_date", "order_status", "total_amount")
    rows.write.option("header", True).csv(path)
    return readers.read_csv(r.spark, path, rows.schema)


@query("s03_read_parquet", "select * replace (p_size::bigint as p_size) from part")
def s03(r: Retail) -> DataFrame:
    return readers.read_parquet(r.spark, f"{r.folder}/part.parquet")


@query(
    "s04_json_roundtrip",
    """select order_id, order_date, order_status, cast(total_amount as double) as total_amount
       from ord""",
    "ord",
)
def s04(r: Retail) -> DataFrame:
    rows = r.orders.select("order_id", "order_date", "order_status", "total_amount")
    return writers.json_roundtrip(rows, fresh_path(r.spark, "json"))


@query(
    "s05_orc_roundtrip",
    """select order_id, order_date, order_status, cast(total_amount as double) as total_amount
       from ord""",
    "ord",
)
def s05(r: Retail) -> DataFrame:
    path = fresh_path(r.spark, "orc")
    writers.write(r.orders.select("order_id", "order_date", "order_status", "total_amount"), path, "orc")
    return readers.read_orc(r.spark, path)


@query(
    "s06_csv_to_parquet",
    """select 'customers' as file, 'SUCCESS' as status, count(*) as rows, 7::bigint as cols from cust
       union all select 'products', 'SUCCESS', count(*), 6 from prod""",
    "cust prod",
)
def s06(r: Retail) -> DataFrame:
    source, target = fresh_path(r.spark, "csv"), fresh_path(r.spark, "parquet")
    tables = {"customers": r.customers, "products": r.products}
    for name, df in tables.items():
        df.write.option("header", True).csv(f"{source}/{name}.csv")
    schemas = {name: df.schema for name, df in tables.items()}
    return writers.csv_to_parquet(r.spark, source, target, schemas)


@query(
    "s07_external_table",
    "select product_id, product_name, cast(price as double) as price from prod",
    "prod",
)
def s07(r: Retail) -> DataFrame:
    path, rows = fresh_path(r.spark, "external"), r.products.select("product_id", "product_name", "price")
    rows.write.option("header", True).csv(path)
    name = fresh_name("external_products")
    return writers.register_external(r.spark, name, path, "csv", rows.schema)


@query(
    "s08_inline_rows",
    f"""select status_name, count(*) as row_count, cast(sum(total_amount) as double) as total
        from ord join {STATUS_SQL} using (order_status) group by 1""",
    "ord",
)
def s08(r: Retail) -> DataFrame:
    names = readers.rows(r.spark, STATUS_NAMES, "order_status string, status_name string")
    return r.orders.join(names, "order_status").groupBy("status_name").agg(
        F.count("*").alias("row_count"), F.sum("total_amount").alias("total")
    )


@query(
    "s09_append_partial",
    """select customer_id, name, state, cast(total_purchases as double) as total_purchases from cust
       union all select s_suppkey + 1000000000, s_name, null, null from supplier""",
    "cust",
)
def s09(r: Retail) -> DataFrame:
    target = r.customers.select("customer_id", "name", "state", "total_purchases")
    added = r.raw("supplier").select(
        (F.col("s_suppkey") + 1_000_000_000).alias("customer_id"), F.col("s_name").alias("name")
    )
    return writers.append_partial(target, added)


@query(
    "s10_insert_select",
    """select order_status, count(*) as row_count, cast(sum(total_amount) as double) as total
       from ord group by 1""",
    "ord",
)
def s10(r: Retail) -> DataFrame:
    name, open_ = fresh_name("orders"), F.col("order_status") == "O"
    writers.ctas(r.orders.where(open_), name)
    return writers.append(r.orders.where(~open_), name).groupBy("order_status").agg(
        F.count("*").alias("row_count"), F.sum("total_amount").alias("total")
    )


@query(
    "s11_overwrite",
    """select order_id, customer_id, cast(total_amount as double) as total_amount, order_status
       from ord""",
    "ord",
)
def s11(r: Retail) -> DataFrame:
    rows = r.orders.select("order_id", "customer_id", "total_amount", "order_status")
    name, path = fresh_name("orders"), fresh_path(r.spark, "orders")
    writers.overwrite(rows.where("order_status = 'F'"), name, ["order_status"], path)
    return writers.overwrite(rows, name, ["order_status"], path)


@query(
    "s12_ctas",
    """select customer_id, state, country, count(order_id) as order_count,
              cast(sum(total_amount) as double) as total_spent,
              cast(sum(total_amount) as double) / nullif(count(order_id), 0) as avg_order_value,
              max(order_date) as last_order_date
       from cust left join ord using (customer_id) group by 1, 2, 3""",
    "cust ord",
)
def s12(r: Retail) -> DataFrame:
    customers = r.customers.select("customer_id", "state", "country")
    return writers.ctas(customer_summary(customers, r.orders), fresh_name("summary"), ["country"])


@query(
    "s13_view",
    """select customer_id, name, last_order_date
       from cust join (select customer_id, max(order_date) as last_order_date from ord group by 1)
            using (customer_id)
       where last_order_date >= (select max(order_date) from ord) - 90""",
    "cust ord",
)
def s13(r: Retail) -> DataFrame:
    last = order_stats(r.orders).select("customer_id", "last_order_date")
    today = r.orders.agg(F.max("order_date")).scalar()
    active = r.customers.join(last, "customer_id").where(
        F.col("last_order_date") >= F.date_sub(today, 90)
    )
    return writers.create_view(
        fresh_name("active_customers"), active.select("customer_id", "name", "last_order_date")
    )


@query(
    "s14_sequence",
    """select n, count(o_orderkey) as order_count
       from (select unnest(range(lo, hi + 1)) as n
             from (select min(c_custkey) as lo, max(c_custkey) + 5 as hi from customer))
            left join orders on o_custkey = n group by 1""",
)
def s14(r: Retail) -> DataFrame:
    first, last = r.raw("customer").agg(F.min("c_custkey"), F.max("c_custkey")).first()
    per_customer = r.orders.groupBy("customer_id").agg(F.count("*").alias("orders"))
    numbers = generators.sequence(r.spark, first, last + 5)
    return numbers.join(per_customer, F.col("n") == F.col("customer_id"), "left").select(
        "n", F.coalesce("orders", F.lit(0)).alias("order_count")
    )


def scatter_sql(n: str, seed: int, span: int) -> str:
    mixed = f"(({n}) % 1000003 * 7919 + {seed} * 104729)"
    return f"(({mixed} % 1000003 * 31 + {seed}) % {span})"


@query(
    "s15_synthetic_orders",
    f"""select o_orderkey as order_id, {scatter_sql('o_orderkey', 1, 8)} + 1 as customer_id,
               date '2024-06-30' - cast({scatter_sql('o_orderkey', 2, 91)} as int) as order_date,
               case {scatter_sql('o_orderkey', 3, 5)} when 0 then 'PENDING' when 1 then 'PROCESSING'
                    when 2 then 'SHIPPED' else 'DELIVERED' end as order_status,
               cast((5000 + {scatter_sql('o_orderkey', 4, 50001)}) * cast(0.01 as decimal(3,2))
                    as double) as total_amount,
               case {scatter_sql('o_orderkey', 5, 4)} when 0 then 'CREDIT_CARD' when 1
                    then 'DEBIT_CARD' else 'PAYPAL' end as payment_method,
               '123 Shipping St' as shipping_address, 'Sample City' as shipping_city,
               'ST' as shipping_state, '12345' as shipping_zip,
               strftime(date '2024-06-30' - cast({scatter_sql('o_orderkey', 2, 91)} as int),
                        '%Y-%m-%d 00:00:00') as order_timestamp
        from orders""",
)
def s15(r: Retail) -> DataFrame:
    return generators.gen_orders(r.raw("orders").select("o_orderkey"), "2024-06-30")


ITEM_SQL = f"""
    select row_number() over (order by order_id, product_id) as order_item_id, order_id, product_id,
           {scatter_sql('order_id * 131 + product_id', 1, 5)} + 1 as quantity,
           cast(price as double) as unit_price,
           cast(percent as double) as discount_percent,
           cast(cast(price * cast({scatter_sql('order_id * 131 + product_id', 1, 5)} + 1
                     as decimal(6,0)) * ((100 - percent) * 0.01) as decimal(18,2)) as double)
               as line_total,
           strftime(order_timestamp, '%Y-%m-%d %H:%M:%S') as created_timestamp
    from (select order_id, order_timestamp, product_id, price,
                 cast({scatter_sql('order_id * 131 + product_id', 2, 2001)} * 0.01
                      as decimal(5,2)) as percent
          from ord cross join prod
          where (order_id * 7 + product_id + 1) % 10 < 3
          order by order_id, product_id limit 500)"""


def synthetic_items(r: Retail) -> DataFrame:
    return generators.gen_order_items(r.orders, r.products, limit=500)


query("s16_synthetic_items", ITEM_SQL, "ord prod")(synthetic_items)
query("j05_sampled_pairs", ITEM_SQL, "ord prod")(synthetic_items)


@query(
    "s17_sized_batch",
    """select c_custkey % 5 as commit_id, c_custkey as row_id, rpad('x', 64, 'x') as payload,
              '2024-01-01 00:00:00' as ts from customer""",
)
def s17(r: Retail) -> DataFrame:
    keys = r.raw("customer").select("c_custkey")
    return generators.gen_batch(keys, F.col("c_custkey") % 5, 64, "2024-01-01")


@query(
    "s18_append_commits",
    """select case o_orderstatus when 'F' then 1 when 'O' then 2 else 3 end::bigint as commit_id,
              count(*) as rows from orders group by 1""",
)
def s18(r: Retail) -> DataFrame:
    path = fresh_path(r.spark, "commits")
    batches = (
        generators.gen_batch(
            r.orders.where(F.col("order_status") == status).select("order_id"), commit, 16, "2024-01-01"
        )
        for commit, (status, _) in enumerate(STATUS_NAMES, 1)
    )
    generators.append_commits(path, batches)
    return generators.commit_counts(r.spark.read.parquet(path))


@query(
    "s20_json_rows",
    """select '{"customer_id":' || customer_id || ',"name":"' || name || '","loyalty_tier":"' ||
              loyalty_tier || '"}' as json from cust""",
    "cust",
)
def s20(r: Retail) -> DataFrame:
    return readers.to_json_rows(r.customers.select("customer_id", "name", "loyalty_tier"))


# --- schemas and constraints ------------------------------------------------

@query(
    "d01_typed_table",
    """select order_id, customer_id, order_date, order_status,
              cast(total_amount as double) as total_amount, null::varchar as payment_method,
              strftime(order_timestamp, '%Y-%m-%d %H:%M:%S') as order_timestamp from ord""",
    "ord",
)
def d01(r: Retail) -> DataFrame:
    schema = SCHEMAS["orders"]
    filled = r.orders.withColumns(
        {f.name: F.lit(None) for f in schema if f.name not in r.orders.columns}
    )
    typed = filled.to(T.StructType([T.StructField(f.name, f.dataType) for f in schema]))
    name = fresh_name("typed_orders")
    return writers.ctas(typed, name).select(
        "order_id", "customer_id", "order_date", "order_status", "total_amount", "payment_method",
        "order_timestamp",
    )


@query(
    "d02_nested_columns",
    """select p_partkey as product_id, p_brand as brand_spec, null::varchar as missing_spec,
              p_type = 'SMALL' as has_small, p_size * 2.0::double * 0.5::double as volume from part""",
)
def d02(r: Retail) -> DataFrame:
    size = F.col("stock_quantity").cast("double")
    nested = r.products.select(
        "product_id",
        F.create_map(F.lit("brand"), F.col("brand")).alias("specifications"),
        F.array("category", "brand").alias("tags"),
        F.struct(
            size.alias("length"), F.lit(2.0).alias("width"), F.lit(0.5).alias("height"),
            F.lit(1.0).alias("weight"),
        ).alias("dimensions"),
    )
    return nested.select(
        "product_id",
        spec("specifications", "brand").alias("brand_spec"),
        spec("specifications", "colour").alias("missing_spec"),
        has_tag("tags", "SMALL").alias("has_small"),
        volume().alias("volume"),
    )


@query(
    "d03_constraints",
    """select 'not_null(email)' as rule, count(*) filter (email is null) as violations from cust
       union all select 'not_null(name)', count(*) filter (name is null) from cust
       union all select 'check(tier)', count(*) filter (loyalty_tier not in
           ('HOUSEHOLD', 'MACHINERY')) from cust
       union all select 'check(purchases)', count(*) filter (total_purchases < 0) from cust
       union all select 'unique(email)', coalesce(sum(n - 1), 0)::bigint from
           (select count(*) as n from cust where email is not null group by email)
       union all select 'unique(id)', coalesce(sum(n - 1), 0)::bigint from
           (select count(*) as n from cust group by customer_id)""",
    "cust",
)
def d03(r: Retail) -> DataFrame:
    rules = Rules(
        not_null=("email", "name"),
        checks={
            "tier": F.col("loyalty_tier").isin("HOUSEHOLD", "MACHINERY"),
            "purchases": F.col("total_purchases") >= 0,
        },
        unique={"email": ["email"], "id": ["customer_id"]},
    )
    return check_constraints(r.customers, rules)


@query(
    "d04_updated_at",
    """select customer_id, cast(case when total_purchases < 0 then 0 else total_purchases end
              as double) as total_purchases,
              case when total_purchases < 0 then '2024-02-01 00:00:00' else '2024-01-01 00:00:00' end
              as updated_at from cust""",
    "cust",
)
def d04(r: Retail) -> DataFrame:
    rows = r.customers.select(
        "customer_id", "total_purchases", F.lit("2024-01-01").cast("timestamp_ntz").alias("updated_at")
    )
    negative = F.col("total_purchases") < 0
    return update_where(rows, negative, {"total_purchases": 0}, ("updated_at", "2024-02-01 00:00:00"))


@query(
    "d05_add_column",
    """select product_id, category, case when category = 'ECONOMY' then true end as discount_eligible
       from prod""",
    "prod",
)
def d05(r: Retail) -> DataFrame:
    wider = add_column(r.products.select("product_id", "category"), "discount_eligible", "boolean")
    return update_where(wider, F.col("category") == "ECONOMY", {"discount_eligible": True})
