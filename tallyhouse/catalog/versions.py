"""Time travel, audit, rollback, expiry and recovery over the change log of the orders."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from tallyhouse.catalog.base import query
from tallyhouse.functions.expressions import age
from tallyhouse.operators import schema_log as sl, versions as v
from tallyhouse.session import fresh_name
from tallyhouse.sources import writers
from tallyhouse.sources.retail import Retail

KEY = ["order_id"]


def state_sql(condition: str = "true") -> str:
    """Rows of the table after the commits that meet a condition."""
    return f"""select order_id, customer_id, status, amount from
        (select *, row_number() over (partition by order_id order by commit_id desc) as place
         from log where {condition}) where place = 1 and op <> 'D'"""


def shown(inner: str) -> str:
    return f"select order_id, customer_id, status, cast(amount as double) as amount from ({inner})"


SNAPSHOT_SQL = """
    select commit_id as snapshot_id, lag(commit_id) over (order by commit_id) as parent_id,
           strftime(min(committed_on), '%Y-%m-%d %H:%M:%S') as committed_at,
           case when count(*) filter (op = 'I') = count(*) then 'append'
                when count(*) filter (op = 'D') = count(*) then 'delete' else 'overwrite' end as operation,
           count(*) filter (op = 'I') as added, count(*) filter (op = 'U') as updated,
           count(*) filter (op = 'D') as deleted
    from log group by commit_id"""


@query("v01_snapshots", SNAPSHOT_SQL, "log")
def v01(r: Retail) -> DataFrame:
    counts = [F.col(f"summary.{c}").cast("bigint").alias(c) for c in ("added", "updated", "deleted")]
    return v.snapshots(r.log).select("snapshot_id", "parent_id", "committed_at", "operation", *counts)


def pointer_moves(r: Retail) -> tuple[DataFrame, DataFrame]:
    """Snapshots and pointer moves of a table set back to commit 6 after commit 8: commit 9 grew
    out of commit 6, so 7 and 8 are no ancestors of the newest commit."""
    snapshots = v.snapshots(r.log).withColumn(
        "parent_id", F.when(F.col("snapshot_id") == 9, F.lit(6)).otherwise(F.col("parent_id"))
    )
    moves = snapshots.select(F.col("committed_at").alias("made_current_at"), "snapshot_id")
    set_back = snapshots.where(F.col("snapshot_id") == 8).select(
        (F.col("committed_at") + F.expr("INTERVAL '12' HOUR")).alias("made_current_at"),
        F.lit(6).cast("bigint").alias("snapshot_id"),
    )
    return snapshots, moves.unionByName(set_back)


@query(
    "v02_history",
    f""", snaps as (select snapshot_id, case when snapshot_id = 9 then 6 else parent_id end as parent_id,
                           committed_at from ({SNAPSHOT_SQL})),
        moves as (select committed_at as made_current_at, snapshot_id from snaps
                  union all select replace(committed_at, '00:00:00', '12:00:00'), 6 from snaps
                            where snapshot_id = 8)
        select made_current_at, snapshot_id, parent_id, snapshot_id not in (7, 8) as is_current_ancestor
        from moves join snaps using (snapshot_id)""",
    "log",
)
def v02(r: Retail) -> DataFrame:
    return v.history(*pointer_moves(r))


@query("v03_snapshot_count", "select count(distinct commit_id) as total_snapshots from log", "log")
def v03(r: Retail) -> DataFrame:
    return v.snapshots(r.log).agg(F.count("*").alias("total_snapshots"))


@query("v04_as_of_version", shown(state_sql("commit_id <= 7")), "log")
def v04(r: Retail) -> DataFrame:
    return v.as_of(r.log, KEY, version=7)


@query("v05_as_of_time", shown(state_sql("committed_on <= date '2024-01-10'")), "log")
def v05(r: Retail) -> DataFrame:
    return v.as_of(r.log, KEY, ts="2024-01-10 15:30:00")


@query(
    "v06_count_drift",
    f"""select (select count(*) from ({state_sql()})) as current_count,
               (select count(*) from ({state_sql('commit_id <= 4')})) as historical_count""",
    "log",
)
def v06(r: Retail) -> DataFrame:
    return v.count_drift(r.log, KEY, 4)


@query(
    "v07_audit",
    " union all ".join(
        f"""select '{label}' as version, order_id, customer_id, status, cast(amount as double) as amount
            from ({state_sql(condition)}) where customer_id between 10 and 40"""
        for label, condition in (
            ("CURRENT", "true"), ("SNAPSHOT_5", "commit_id <= 5"), ("SNAPSHOT_9", "commit_id <= 9"),
        )
    ),
    "log",
)
def v07(r: Retail) -> DataFrame:
    return v.audit(r.log, KEY, F.col("customer_id").between(10, 40), [5, 9])


def diff_sql(old: str, new: str) -> str:
    return f"""
        select coalesce(a.order_id, b.order_id) as order_id,
               case when a.order_id is null then 'I' when b.order_id is null then 'D' else 'U' end as change,
               a.customer_id as old_customer_id, a.status as old_status, a.amount as old_amount,
               b.customer_id as new_customer_id, b.status as new_status, b.amount as new_amount
        from ({state_sql(old)}) a full outer join ({state_sql(new)}) b on a.order_id = b.order_id
        where a.order_id is null or b.order_id is null
           or (a.customer_id, a.status, a.amount) is distinct from (b.customer_id, b.status, b.amount)"""


@query(
    "v08_diff",
    f"""select * replace (cast(old_amount as double) as old_amount, cast(new_amount as double)
                          as new_amount) from ({diff_sql('commit_id <= 4', 'commit_id <= 9')})""",
    "log",
)
def v08(r: Retail) -> DataFrame:
    return v.diff(r.log, KEY, 4, 9)


@query(
    "v09_rollback_commit",
    f"""select order_id, case change when 'D' then old_customer_id else new_customer_id end as customer_id,
               case change when 'D' then old_status else new_status end as status,
               cast(case change when 'D' then old_amount else new_amount end as double) as amount,
               11::bigint as commit_id, '2024-02-01 00:00:00' as committed_at, change as op
        from ({diff_sql('true', 'commit_id <= 5')})""",
    "log",
)
def v09(r: Retail) -> DataFrame:
    return v.rollback_commit(r.log, KEY, "2024-02-01", version=5)


@query("v09_after_rollback", shown(state_sql("commit_id <= 5")), "log")
def v09_state(r: Retail) -> DataFrame:
    return v.as_of(v.rollback(r.log, KEY, "2024-02-01", ts="2024-01-06 09:00:00"), KEY)


EXPIRED_SQL = f"""
    select order_id, customer_id, status, cast(amount as double) as amount, commit_id,
           strftime(committed_on, '%Y-%m-%d %H:%M:%S') as committed_at, op
    from log where commit_id > 6
    union all select order_id, customer_id, status, cast(amount as double), 6,
                     '2024-01-07 00:00:00', 'I' from ({state_sql('commit_id <= 6')})"""


@query("v10_expire", EXPIRED_SQL, "log")
def v10(r: Retail) -> DataFrame:
    return v.expire(r.log, KEY, "2024-01-09", retain_last=5)


@query("v11_expire_by_age", EXPIRED_SQL, "log")
def v11(r: Retail) -> DataFrame:
    return v.expire_by_age(r.log, KEY, 604_800_000, datetime(2024, 1, 14))


@query(
    "v12_undelete",
    f"""{shown(state_sql('commit_id <= 8'))}
        where order_id not in (select order_id from ({state_sql()}))""",
    "log",
)
def v12(r: Retail) -> DataFrame:
    return v.undelete(r.log, KEY, 8)


@query("v13_restore", shown(state_sql("commit_id <= 3")), "log")
def v13(r: Retail) -> DataFrame:
    return v.restore(r.log, KEY, 3, fresh_name("restored_orders"))


@query(
    "v14_schema_then",
    f"select order_id, customer_id, cast(amount as double) as amount from ({state_sql('commit_id <= 4')})",
    "log",
)
def v14(r: Retail) -> DataFrame:
    columns = {1: ["order_id", "customer_id", "amount"], 6: ["order_id", "customer_id", "amount", "status"]}
    return v.as_of(r.log, KEY, version=4, schema_log=columns)


def evolved(r: Retail) -> tuple[DataFrame, DataFrame]:
    """The orders' log stored by column id, and the log of its columns: commit 3 adds the status, commit 5 renames
    the customer, commit 7 widens the amount (rounded to whole numbers before)."""
    schema = sl.first_schema(r.spark, 1, {"customer_id": "bigint", "amount": "int"})
    schema = sl.alter(schema, 3, add={"status": "string"})
    schema = sl.alter(schema, 5, rename={"customer_id": "buyer_id"})
    schema = sl.alter(schema, 7, widen={"amount": "bigint"})
    whole = r.log.withColumns({"amount": F.floor("amount").cast("bigint"), "customer_id": F.col("customer_id").cast("bigint")})
    names = [({"status"}, {}, 1, 2), (set(), {}, 3, 4), (set(), {"customer_id": "buyer_id"}, 5, 10)]
    stored = None
    for unknown, renamed, first, last in names:
        part = whole.where(F.col("commit_id").between(first, last)).drop(*unknown).withColumnsRenamed(renamed)
        part = sl.to_stored(part, schema, first, KEY)
        stored = part if stored is None else stored.unionByName(part)
    return stored, schema


def evolved_sql(version: int, columns: str) -> str:
    return f"""select order_id, {columns} from (
        select *, row_number() over (partition by order_id order by commit_id desc) as place
        from log where commit_id <= {version}) where place = 1 and op <> 'D'"""


AMOUNT = "cast(floor(amount) as bigint) as amount"


@query("v14_schema_first", evolved_sql(2, f"customer_id, {AMOUNT}"), "log")
def v14_first(r: Retail) -> DataFrame:
    return sl.read_version(*evolved(r), KEY, version=2)


@query(
    "v14_schema_added", evolved_sql(4, f"customer_id, {AMOUNT}, case when commit_id > 2 then status end as status"), "log"
)
def v14_added(r: Retail) -> DataFrame:
    return sl.read_version(*evolved(r), KEY, version=4)


@query(
    "v14_schema_renamed",
    evolved_sql(6, f"customer_id as buyer_id, {AMOUNT}, case when commit_id > 2 then status end as status"), "log",
)
def v14_renamed(r: Retail) -> DataFrame:
    return sl.read_version(*evolved(r), KEY, ts="2024-01-07 18:00:00")


@query(
    "v14_schema_widened",
    evolved_sql(10, f"customer_id as buyer_id, {AMOUNT}, case when commit_id > 2 then status end as status"), "log",
)
def v14_widened(r: Retail) -> DataFrame:
    return sl.read_version(*evolved(r), KEY)


@query("v15_backup", shown(state_sql()), "log")
def v15(r: Retail) -> DataFrame:
    return writers.backup(v.as_of(r.log, KEY), fresh_name("orders_backup"))


@query(
    "f05_snapshot_age",
    f"""select snapshot_id, 'INTERVAL ''' || (date '2024-03-01' - cast(committed_at as date)) ||
               ' 00:00:00'' DAY TO SECOND' as age from ({SNAPSHOT_SQL})""",
    "log",
)
def f05(r: Retail) -> DataFrame:
    return v.snapshots(r.log).select("snapshot_id", age("committed_at", "2024-03-01 00:00:00").alias("age"))
