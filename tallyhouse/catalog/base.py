"""Registration of queries and the SQL form of the retail tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyhouse.sources.retail import Retail

Run = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Run] = {}
SQL: dict[str, str] = {}

# SQL form of the views in sources/retail.py.
VIEWS = {
    "cust": """
        select c_custkey as customer_id, c_name as name,
               case when c_custkey % 10 <> 0
                    then 'user' || (c_custkey % 997) || '@' || lower(c_mktsegment) || '.example'
                    when c_custkey % 20 <> 0 then '' end as email,
               cast(c_acctbal as decimal(18,2)) as total_purchases,
               c_mktsegment as loyalty_tier, n_name as state, r_name as country
        from customer join nation on c_nationkey = n_nationkey
                      join region on n_regionkey = r_regionkey""",
    "people": """
        select customer_id, name, email, loyalty_tier, state, country from cust
        union all
        select s_suppkey + 1000000000, s_name, null, 'SUPPLIER', n_name, r_name
        from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    "ord": """
        select o_orderkey as order_id, o_custkey as customer_id,
               cast(o_orderdate as date) as order_date, o_orderstatus as order_status,
               cast(o_totalprice as decimal(18,2)) as total_amount,
               o_orderpriority as order_priority, o_orderdate as order_timestamp
        from orders""",
    "patchy": """
        select order_id, case when customer_id % 13 <> 5 then customer_id end as customer_id,
               order_date, nullif(order_status, 'P') as order_status,
               case when order_id % 17 <> 3 then total_amount end as total_amount
        from ord""",
    "item": """
        select l_orderkey as order_id, l_partkey as product_id, l_suppkey as supplier_id,
               l_linenumber as line_number, cast(l_quantity as int) as quantity,
               cast(l_extendedprice as decimal(18,2)) as unit_price,
               cast(cast(l_discount as decimal(5,2)) * 100 as decimal(5,2)) as discount_percent,
               cast(l_extendedprice as decimal(18,2)) as line_total,
               cast(l_shipdate as date) as ship_date
        from lineitem""",
    "prod": """
        select p_partkey as product_id, p_name as product_name, p_type as category,
               p_brand as brand, cast(p_retailprice as decimal(18,2)) as price,
               p_size as stock_quantity
        from part""",
    "log": """
        select order_id, customer_id, order_status as status, amount, commit_id,
               date '2024-01-01' + cast(commit_id as int) as committed_on, op
        from (
            select *, total_amount as amount, order_id % 5 + 1 as commit_id, 'I' as op from ord
            union all
            select *, total_amount + 10, order_id % 3 + 6, 'U' from ord where order_id % 7 = 0
            union all
            select *, total_amount, 9, 'D' from ord where order_id % 11 = 0
            union all
            select *, total_amount + 1, 10, 'I' from ord where order_id % 22 = 0
        ) changes""",
}
NEEDS = {"people": ("cust",), "patchy": ("ord",), "log": ("ord",)}


def with_views(body: str, *views: str) -> str:
    """Put the named views in front of a statement. A body starting with a comma continues the
    list of named subqueries itself."""
    wanted: list[str] = []
    for view in views:
        for name in (*NEEDS.get(view, ()), view):
            if name not in wanted:
                wanted.append(name)
    head = ", ".join(f"{name} as ({VIEWS[name]})" for name in wanted)
    return f"with {head} {body.strip()}"


def plain(df: DataFrame) -> DataFrame:
    """Report types: DECIMAL as DOUBLE, all integers as BIGINT, timestamps as text."""

    def column(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            return c.cast("double").alias(f.name)
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            return c.cast("bigint").alias(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(f.name)
        return c

    return df.select(*[column(f) for f in df.schema])


def query(name: str, sql: str | None = None, views: str = "") -> Callable:
    """Register a query on a ``Retail`` folder, with the SQL that must give the same rows.

    ``views`` names the views (blank separated) the SQL reads.
    """

    def register(function: Callable[[Retail], DataFrame]) -> Callable[[Retail], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: plain(function(Retail(spark, folder)))
        if sql is not None:
            SQL[name] = with_views(sql, *views.split()) if views else sql.strip()
        return function

    return register
