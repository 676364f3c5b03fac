"""Request outcomes and document sources on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.normalize import unset_int
from ..operators import outcomes as out
from ..operators.ordered import with_row_ids
from ..operators.relational import new_keys_only
from ..sources.documents import explode_aliases, explode_groups, explode_list, explode_profiles
from ..sources.error_codes import ADDITIONAL_CODES, error_code_dim
from ..sources.short_rates import parse_short_rates
from .registry import query

_CODES = """
    codes AS (SELECT * FROM (VALUES ('signup', 100), ('purchase', 200), ('error', 504), ('view', 777), ('click', 888)) v(event_type, ErrorCode)),
    tab AS (SELECT * FROM (VALUES (100, 'late', 'note'), (200, 'two', ''), (504, 'from table', 'n')) v(ErrorCode, Message, Note)),
    err AS (SELECT CASE WHEN event_id % 11 = 0 THEN NULL ELSE user_id END AS RequestId, ErrorCode, ts, event_id, props AS Error
            FROM events JOIN codes USING (event_type))
"""


def _errors(t):
    code = (
        F.when(F.col("event_type") == "signup", 100)
        .when(F.col("event_type") == "purchase", 200)
        .when(F.col("event_type") == "error", 504)
        .when(F.col("event_type") == "view", 777)
        .otherwise(888)
    )
    sent = F.when(F.col("event_id") % 11 == 0, F.lit(2147483647)).otherwise(F.col("user_id"))
    return t.events.select(
        unset_int(sent).alias("RequestId"), code.cast("long").alias("ErrorCode"), "ts", "event_id", F.col("props").alias("Error")
    )


def _code_tables(t):
    rows = [(1, 100, "early", "x"), (2, 200, "two", None), (3, 504, "from table", "n")]
    first = t.spark.createDataFrame(rows, "Row int, Code int, Message string, Note string")
    second = t.spark.createDataFrame([(1, 100, "late", "note")], "Row int, Code int, Message string, Note string")
    other = t.spark.createDataFrame([(1,)], "Unrelated int")
    return [first, other, second]


@query(
    "error_enrich",
    f"""
    WITH {_CODES}, first AS (SELECT ErrorCode, arg_min(Error, (ts, event_id)) AS Error FROM err GROUP BY 1)
    SELECT err.RequestId, err.ErrorCode, err.event_id, err.Error, coalesce(tab.Message, first.Error) AS ErrorDescription,
           nullif(tab.Note, '') AS Note
    FROM err LEFT JOIN tab USING (ErrorCode) JOIN first USING (ErrorCode)
    """,
)
def error_enrich(t):
    dim = error_code_dim(t.spark, _code_tables(t))
    return out.enrich_errors(_errors(t), dim, ["ts", "event_id"]).drop("ts")


@query(
    "error_code_usage",
    f"""
    WITH {_CODES}
    SELECT err.ErrorCode, count(*) AS Errors, any_value(CASE WHEN err.ErrorCode = 100 THEN 'late' WHEN err.ErrorCode = 200 THEN 'two'
      WHEN err.ErrorCode = 504 THEN '{ADDITIONAL_CODES[504]}' END) AS Message FROM err GROUP BY 1
    """,
)
def error_code_usage(t):
    # Only the later table here, so 504 falls back to the fixed addition.
    tables = _code_tables(t)
    dim = error_code_dim(t.spark, [tables[0].filter("Code <> 504"), tables[2]])
    counts = _errors(t).groupBy("ErrorCode").agg(F.count("*").alias("Errors"))
    return counts.join(dim, "ErrorCode", "left").select("ErrorCode", "Errors", "Message")


# Orders ask for contracts (the part of their number), lineitems answer with details, events with errors.
_ENTRIES = """
    req AS (SELECT o_orderkey AS RequestId, 'C' || o_custkey AS Contract FROM orders),
    det AS (SELECT l_orderkey AS RequestId, 'C' || l_partkey AS OwnContract, l_linenumber AS Line FROM lineitem),
    err AS (SELECT event_id AS RequestId, event_type AS Error FROM events),
    entries AS (
      SELECT Contract, RequestId, 'detail' AS Kind, Line, NULL AS ErrorText FROM det JOIN req USING (RequestId)
      UNION ALL
      SELECT OwnContract, RequestId, 'detail', Line, NULL FROM det JOIN req USING (RequestId) WHERE Contract <> OwnContract
      UNION ALL
      SELECT Contract, RequestId, 'error', NULL, 'req_id=' || RequestId || ' ' || Error FROM err JOIN req USING (RequestId))
"""


def _entries(t):
    requests = t.orders.selectExpr("o_orderkey AS RequestId", "'C' || o_custkey AS Contract")
    details = t.lineitem.selectExpr(
        "l_orderkey AS RequestId", "'C' || l_partkey AS OwnContract", "l_linenumber AS Line"
    )
    errors = t.events.selectExpr("event_id AS RequestId", "event_type AS Error")
    return requests, out.contract_entries(requests, details, errors, "Contract", "OwnContract")


@query("contract_entries", f"WITH {_ENTRIES} SELECT * FROM entries")
def contract_entries(t):
    _, entries = _entries(t)
    return entries.select("Contract", "RequestId", "Kind", F.col("Detail.Line").alias("Line"), "ErrorText")


@query(
    "resolve_contracts",
    f"""
    WITH {_ENTRIES}, keys AS (SELECT DISTINCT Contract FROM req UNION SELECT DISTINCT Contract FROM entries),
    n AS (SELECT keys.Contract, count(*) FILTER (WHERE Kind = 'detail') AS DetailCount,
                 count(*) FILTER (WHERE Kind = 'error') AS ErrorCount
          FROM keys LEFT JOIN entries USING (Contract) GROUP BY 1)
    SELECT *, CASE WHEN DetailCount > 0 AND ErrorCount > 0 THEN 'conflict' WHEN DetailCount > 1 THEN 'multi'
                   WHEN DetailCount = 1 THEN 'resolved' WHEN ErrorCount > 0 THEN 'error' ELSE 'missing' END AS Status FROM n
    """,
)
def resolve_contracts(t):
    requests, entries = _entries(t)
    return out.resolve_contracts(requests, entries, "Contract")


@query(
    "resolve_errors_joined",
    f"""
    WITH {_ENTRIES}, errors AS (SELECT Contract, RequestId, ErrorText FROM entries WHERE Kind = 'error'),
    firsts AS (
      SELECT * FROM (SELECT DISTINCT * FROM errors) QUALIFY row_number() OVER (PARTITION BY Contract ORDER BY RequestId, ErrorText) <= 3)
    SELECT Contract, ErrorCount, ErrorText
    FROM (SELECT Contract, count(*) AS ErrorCount FROM errors GROUP BY 1)
    JOIN (SELECT Contract, string_agg(ErrorText, '|' ORDER BY RequestId, ErrorText) AS ErrorText FROM firsts GROUP BY 1) USING (Contract)
    """,
)
def resolve_errors_joined(t):
    _, entries = _entries(t)
    return out.joined_errors(entries, "Contract", 3)


@query(
    "new_keys_only",
    """
    SELECT DISTINCT l_partkey AS ContractId FROM lineitem
    WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size > 10)
    """,
)
def new_keys(t):
    known = t.part.filter("p_size > 10").selectExpr("p_partkey AS ContractId")
    return new_keys_only(t.lineitem.selectExpr("l_partkey AS ContractId"), known, "ContractId")


@query(
    "keys_to_request",
    """
    SELECT DISTINCT l_partkey - 5 AS ContractId FROM lineitem
    WHERE l_partkey >= 5 AND NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey - 5 AND p_size > 10)
    """,
)
def keys_to_request(t):
    known = t.part.filter("p_size > 10").selectExpr("p_partkey AS ContractId")
    return out.keys_to_request(t.lineitem.selectExpr("l_partkey - 5 AS ContractId"), known, "ContractId")


@query(
    "request_fanout",
    """
    SELECT CAST(row_number() OVER (ORDER BY o_orderdate, o_orderkey, i) AS BIGINT) AS RequestId, o_orderkey,
           i - 1 AS DetailIndex, d AS Detail, 'HistoricalData' AS RequestType,
           '{"bar_size":"1 day","end":"' || o_orderpriority || '"}' AS Note
    FROM (SELECT *, unnest([o_orderstatus, o_orderpriority]) AS d, unnest([1, 2]) AS i FROM orders)
    """,
)
def request_fanout(t):
    calls = t.orders.withColumn("details", F.array("o_orderstatus", "o_orderpriority"))
    notes = {"bar_size": F.lit("1 day"), "end": F.col("o_orderpriority")}
    order = ["o_orderdate", "o_orderkey"]
    rows = out.fan_out_requests(calls, "details", "HistoricalData", notes, order, F.col("o_orderdate"), "o_orderkey")
    return rows.select("RequestId", "o_orderkey", "DetailIndex", "Detail", "RequestType", "Note")


@query(
    "row_ids",
    "SELECT event_id, CAST(row_number() OVER (ORDER BY ts, event_id) AS BIGINT) AS RequestId FROM events",
)
def row_ids(t):
    hour = F.date_trunc("hour", "ts")
    return with_row_ids(t.events, ["ts", "event_id"], hour, "ts").select("event_id", "RequestId")


@query(
    "cancelled_flow",
    """
    WITH c AS (SELECT user_id, min(ts) AS at FROM events WHERE event_type = 'signup' AND event_id % 3 = 0 GROUP BY 1)
    SELECT e.event_id, e.ts, e.user_id FROM events e LEFT JOIN c ON e.user_id = c.user_id WHERE c.at IS NULL OR e.ts <= c.at
    """,
)
def cancelled_flow(t):
    rows = t.events.selectExpr("event_id", "ts", "user_id AS RequestId")
    cancels = t.events.filter("event_type = 'signup' AND event_id % 3 = 0").selectExpr("user_id AS RequestId", "ts AS CancelTime")
    return out.active_only(rows, cancels, "ts").withColumnRenamed("RequestId", "user_id")


@query(
    "list_first_seen",
    """
    SELECT DISTINCT a AS Account FROM (SELECT unnest(string_split('A' || o_custkey % 50 || ',,' || o_orderstatus, ',')) AS a FROM orders)
    WHERE a <> ''
    """,
)
def list_first_seen(t):
    lists = t.orders.selectExpr("'A' || o_custkey % 50 || ',,' || o_orderstatus AS accounts")
    return explode_list(lists, "accounts", name="Account")


# Documents are built from rows, one small document each, so they grow with the table.
def _xml(t, text):
    return t.customer.selectExpr(f"{text} AS xml")


@query(
    "xml_groups",
    """
    SELECT c_mktsegment AS GroupName, 'method' || c_nationkey AS DefaultMethod, unnest([c_name, 'B' || c_custkey]) AS Account
    FROM customer
    """,
)
def xml_groups(t):
    return explode_groups(
        _xml(
            t,
            "'<ListOfGroups><Group><name>' || c_mktsegment || '</name><defaultMethod>method' || c_nationkey || "
            "'</defaultMethod><ListOfAccts><Account><acct>' || c_name || '</acct></Account><Account><acct>B' || c_custkey || "
            "'</acct></Account></ListOfAccts></Group></ListOfGroups>'",
        )
    )


@query(
    "xml_profiles",
    """
    SELECT c_mktsegment AS AllocationProfileName, CASE c_nationkey % 4 WHEN 1 THEN 'Percentages' WHEN 2 THEN 'Financial Ratios'
           WHEN 3 THEN 'Shares' ELSE 'UNKNOWN(0)' END AS Type, unnest([c_name, 'B' || c_custkey]) AS Account,
           unnest([c_acctbal, 1.5::DOUBLE]) AS Amount
    FROM customer
    """,
)
def xml_profiles(t):
    return explode_profiles(
        _xml(
            t,
            "'<ListOfAllocationProfiles><AllocationProfile><name>' || c_mktsegment || '</name><type>' || c_nationkey % 4 || "
            "'</type><ListOfAllocations><Allocation><acct>' || c_name || '</acct><amount>' || c_acctbal || "
            "'</amount></Allocation><Allocation><acct>B' || c_custkey || '</acct><amount>1.5</amount></Allocation>"
            "</ListOfAllocations></AllocationProfile></ListOfAllocationProfiles>'",
        )
    )


@query("xml_aliases", "SELECT c_name AS Account, c_mktsegment AS Alias FROM customer")
def xml_aliases(t):
    return explode_aliases(
        _xml(
            t,
            "'<?xml version=\"1.0\"?><ListOfAccountAliases><AccountAlias><account>' || c_name || '</account><alias>' || "
            "c_mktsegment || '</alias></AccountAlias></ListOfAccountAliases>'",
        )
    )


@query(
    "short_rates_ingest",
    """
    SELECT p_brand AS Source, 'S' || p_partkey AS Sym, 'USD' AS Currency, p_name || ' & co' AS Name, p_partkey AS Contract,
           CAST(p_size AS DOUBLE) + 0.25 AS RebateRate, CASE WHEN p_size % 7 = 0 THEN 'NA' ELSE CAST(p_size AS VARCHAR) END AS FeeRate,
           CASE WHEN p_size > 40 THEN '>10000000' ELSE CAST(p_size AS VARCHAR) END AS Available
    FROM part
    """,
)
def short_rates_ingest(t):
    line = (
        "'S' || p_partkey || '|USD|' || p_name || ' &amp; co|' || p_partkey || '|' || p_size || '.25|' || "
        "CASE WHEN p_size % 7 = 0 THEN 'NA' ELSE CAST(p_size AS STRING) END || '|' || "
        "CASE WHEN p_size > 40 THEN '>10000000' ELSE CAST(p_size AS STRING) END || '|'"
    )
    data = t.part.selectExpr("p_brand AS Source", f"{line} AS value")
    frame = F.explode(
        F.array(F.lit("#BOF|2024.01.01|"), F.lit("#SYM|CUR|NAME|CON|REBATERATE|FEERATE|AVAILABLE|"), F.lit("#EOF|1"))
    )
    sources = t.part.select(F.col("p_brand").alias("Source")).distinct().select("Source", frame.alias("value"))
    return parse_short_rates(data.unionByName(sources))

