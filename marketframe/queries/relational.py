"""Relational operators on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.pricing import SHOCKS
from ..operators.relational import (
    audit_types,
    constituent,
    first_by,
    join,
    last_by,
    move_up,
    natural_join,
    rename,
    select_distinct,
    sum_by,
    ungroup,
    update,
    view,
    where,
)
from .registry import money, query, r6

EVENT_ORDER = ["ts", "event_id"]


@query(
    "natural_join_annotate",
    """
    SELECT l.*, o.o_custkey, o.o_orderstatus, o.o_orderdate
    FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
    """,
)
def natural_join_annotate(t):
    orders = t.orders.withColumnRenamed("o_orderkey", "l_orderkey")
    return natural_join(t.lineitem, orders, "l_orderkey", ["o_custkey", "o_orderstatus", "o_orderdate"])


@query(
    "natural_join_unmatched",
    """
    SELECT o.o_orderkey, o.o_custkey, c.c_name AS CustomerName, c.c_acctbal
    FROM orders o LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment = 'MACHINERY') c
      ON o.o_custkey = c.c_custkey
    """,
)
def natural_join_unmatched(t):
    customers = t.customer.filter("c_mktsegment = 'MACHINERY'").withColumnRenamed("c_custkey", "o_custkey")
    return natural_join(t.orders.select("o_orderkey", "o_custkey"), customers, "o_custkey", ["CustomerName=c_name", "c_acctbal"])


@query(
    "natural_join_keyless",
    """
    SELECT n.n_nationkey, n.customers, s.total
    FROM (SELECT c_nationkey AS n_nationkey, count(*) AS customers FROM customer GROUP BY 1) n,
         (SELECT count(*) AS total FROM customer) s
    """,
)
def natural_join_keyless(t):
    by_nation = t.customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("customers"))
    return natural_join(by_nation, t.customer.agg(F.count("*").alias("total")), [])


@query(
    "join_many_to_many",
    """
    WITH e AS (
      SELECT user_id, event_type, value,
             row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
      FROM events)
    SELECT e.user_id, e.event_type, e.value, o.o_orderkey, o.o_totalprice
    FROM e JOIN orders o ON e.user_id = o.o_custkey WHERE rn = 1
    """,
)
def join_many_to_many(t):
    latest = last_by(t.events, ["user_id", "event_type"], EVENT_ORDER).select("user_id", "event_type", "value")
    return join(latest, t.orders.withColumnRenamed("o_custkey", "user_id"), "user_id", ["o_orderkey", "o_totalprice"])


@query(
    "where_view_update",
    """
    SELECT CAST(l_extendedprice * (1 - l_discount) + 1e-7 AS DECIMAL(38,4)) AS Net,
           CAST(l_extendedprice * (1 - l_discount) * (1 + l_tax) + 1e-7 AS DECIMAL(38,4)) AS Gross,
           l_orderkey AS OrderId, l_partkey AS ContractId, l_quantity AS Quantity,
           CASE WHEN l_quantity > 25 THEN 'large' ELSE 'small' END AS Lot
    FROM lineitem WHERE l_returnflag = 'R' AND l_discount >= 0.05
    """,
)
def where_view_update(t):
    rows = where(t.lineitem, "l_returnflag = 'R'", F.col("l_discount") >= 0.05)
    rows = view(rows, ["l_orderkey", "ContractId=l_partkey", "Quantity=l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    rows = update(
        rows,
        {
            "Price": F.col("l_extendedprice") * (1 - F.col("l_discount")),
            "Gross": money(F.col("Price") * (1 + F.col("l_tax")) + 1e-7),
            "Net": money(F.col("Price") + 1e-7),
            "Lot": F.when(F.col("Quantity") > 25, "large").otherwise("small"),
        },
    )
    rows = rows.drop("l_extendedprice", "l_discount", "l_tax", "Price")
    return move_up(rename(rows, "OrderId=l_orderkey"), ["Net", "Gross"])


_LAST = """
    SELECT event_id, ts, user_id, event_type, value, props FROM (
      SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn FROM events)
    WHERE rn = 1
"""


@query("last_by_one", _LAST.format(keys="user_id", order="ts DESC, event_id DESC"))
def last_by_one(t):
    return last_by(t.events, "user_id", EVENT_ORDER)


@query("last_by_many", _LAST.format(keys="user_id, event_type", order="ts DESC, event_id DESC"))
def last_by_many(t):
    return last_by(t.events, ["user_id", "event_type"], EVENT_ORDER)


@query("first_by", _LAST.format(keys="user_id", order="ts, event_id"))
def first_by_user(t):
    return first_by(t.events, "user_id", EVENT_ORDER)


@query(
    "last_by_then_join",
    """
    WITH o AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
               FROM orders),
         e AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    SELECT o.o_custkey, o.o_orderkey, o.o_totalprice, e.event_type AS Status
    FROM o LEFT JOIN e ON o.o_custkey = e.user_id AND e.rn = 1 WHERE o.rn = 1
    """,
)
def last_by_then_join(t):
    orders = last_by(t.orders, "o_custkey", ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")
    status = last_by(t.events, "user_id", EVENT_ORDER).withColumnRenamed("user_id", "o_custkey")
    return natural_join(orders, status, "o_custkey", "Status=event_type", validate=False)


@query("select_distinct", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def select_distinct_flags(t):
    return select_distinct(t.lineitem, ["l_returnflag", "l_linestatus"])


_SUMS = """
    sum(CAST(l_quantity AS DECIMAL(18,4))) AS Quantity,
    sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS Price
"""


def _amounts(t, *keys):
    return t.lineitem.select(
        *keys,
        F.col("l_quantity").cast("decimal(18,4)").alias("Quantity"),
        F.col("l_extendedprice").cast("decimal(18,4)").alias("Price"),
    )


def _as_money(df):
    return df.withColumns({c: money(c) for c in ("Quantity", "Price")})


@query(
    "sum_by_keys",
    f"""SELECT l_partkey, CAST(Quantity AS DECIMAL(38,4)) AS Quantity, CAST(Price AS DECIMAL(38,4)) AS Price
        FROM (SELECT l_partkey, {_SUMS} FROM lineitem GROUP BY 1)""",
)
def sum_by_keys(t):
    return _as_money(sum_by(_amounts(t, "l_partkey"), "l_partkey"))


@query(
    "sum_by_all",
    f"""SELECT CAST(Quantity AS DECIMAL(38,4)) AS Quantity, CAST(Price AS DECIMAL(38,4)) AS Price
        FROM (SELECT {_SUMS} FROM lineitem)""",
)
def sum_by_all(t):
    return _as_money(sum_by(_amounts(t)))


@query(
    "ungroup_scenarios",
    f"""
    SELECT p_partkey, Scenario, round((1 + Scenario) * p_retailprice, 6) AS Shocked
    FROM (SELECT p_partkey, p_retailprice, unnest({[float(s) for s in SHOCKS]}::DOUBLE[]) AS Scenario FROM part)
    """,
)
def ungroup_scenarios(t):
    parts = t.part.select("p_partkey", "p_retailprice", F.array(*[F.lit(s) for s in SHOCKS]).alias("Scenario"))
    rows = ungroup(parts, "Scenario")
    return rows.select("p_partkey", "Scenario", r6((1 + F.col("Scenario")) * F.col("p_retailprice")).alias("Shocked"))


@query(
    "type_audit",
    """
    SELECT 'code' AS ColumnName, 'bigint' AS ColumnType,
           count(*) FILTER (WHERE code IS NOT NULL AND TRY_CAST(code AS BIGINT) IS NULL) AS Mismatches FROM a
    UNION ALL
    SELECT 'amount', 'double',
           count(*) FILTER (WHERE amount IS NOT NULL AND TRY_CAST(amount AS DOUBLE) IS NULL) FROM a
    """.replace("FROM a", "FROM (SELECT substr(p_name, 1, p_size % 3) || CAST(p_size AS VARCHAR) AS code, "
                "CASE WHEN p_size % 4 = 0 THEN p_brand ELSE CAST(p_size AS VARCHAR) END AS amount FROM part)"),
)
def type_audit(t):
    logged = t.part.selectExpr(
        "substr(p_name, 1, p_size % 3) || CAST(p_size AS STRING) AS code",
        "CASE WHEN p_size % 4 = 0 THEN p_brand ELSE CAST(p_size AS STRING) END AS amount",
    )
    return audit_types(logged, {"code": "bigint", "amount": "double"})


@query(
    "partition_constituent",
    "SELECT * FROM events WHERE event_type = 'purchase'",
)
def partition_constituent(t):
    return constituent(t.events, "event_type", "purchase")
