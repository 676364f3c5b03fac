"""Row normalisation on the driver's tables."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import functions as F

from ..functions import codes
from ..functions import normalize as n
from ..sources.rawlog import normalize_rows, unify_ticks
from .registry import money, query, r6

_STATUS = {"F": None, "O": "Open"}


@query(
    "map_values_unknown",
    """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN NULL WHEN 'O' THEN 'Open'
           ELSE 'UNKNOWN(' || o_orderstatus || ')' END AS Status FROM orders
    """,
)
def map_values_unknown(t):
    return t.orders.select("o_orderkey", codes.map_values(F.col("o_orderstatus"), _STATUS).alias("Status"))


def _case(column, mapping, cast=""):
    def text(v):
        return "NULL" if v is None else "'" + v.replace("'", "''") + "'"

    whens = " ".join(f"WHEN '{k}' THEN {text(v)}" for k, v in mapping.items())
    value = f"CAST({column} AS VARCHAR)"
    return f"CASE WHEN {column} IS NULL THEN NULL ELSE CASE {value} {whens} ELSE 'UNKNOWN(' || {value} || ')' END END"


_ORDER_CODE_INPUTS = {
    "OcaType": "l_linenumber % 5",
    "TriggerMethod": "l_linenumber + 1",
    "Rule80A": "l_returnflag",
    "OpenClose": "l_linestatus",
    "Origin": "l_linenumber % 4",
    "ShortSaleSlot": "l_linenumber % 3",
    "AuctionStrategy": "l_linenumber % 6",
    "VolatilityType": "nullif(l_linenumber, 3) % 4",
    "ReferencePriceType": "l_linenumber % 4",
    "HedgeType": "substr('DBFPX', 1 + l_linenumber % 6, 1)",
}


@query(
    "order_code_names",
    "SELECT l_orderkey, "
    + ", ".join(f"{_case(f'({e})', codes.ORDER_CODES[c])} AS {c}" for c, e in _ORDER_CODE_INPUTS.items())
    + " FROM lineitem",
)
def order_code_names(t):
    rows = t.lineitem.selectExpr("l_orderkey", *[f"{e} AS {c}" for c, e in _ORDER_CODE_INPUTS.items()])
    return codes.name_order_codes(rows)


@query(
    "feed_code_names",
    "SELECT event_id, "
    + ", ".join(
        f"{_case(f'(event_id % {m})', names)} AS {c}"
        for c, m, names in (
            ("MsgType", 5, codes.NEWS_MESSAGE_TYPE),
            ("ArticleType", 3, codes.ARTICLE_TYPE),
            ("TickAttrib", 3, codes.OPTION_TICK_ATTRIB),
            ("AllocationType", 5, codes.ALLOCATION_TYPE),
        )
    )
    + " FROM events",
)
def feed_code_names(t):
    i = F.col("event_id")
    return t.events.select(
        "event_id",
        codes.map_values(i % 5, codes.NEWS_MESSAGE_TYPE).alias("MsgType"),
        codes.map_values(i % 3, codes.ARTICLE_TYPE).alias("ArticleType"),
        codes.map_values(i % 3, codes.OPTION_TICK_ATTRIB).alias("TickAttrib"),
        codes.map_values(i % 5, codes.ALLOCATION_TYPE).alias("AllocationType"),
    )


_LETTERS = _case("x", codes.SPECIAL_CONDITION).replace("CAST(x AS VARCHAR)", "x")


@query(
    "special_conditions",
    f"""
    SELECT o_orderkey,
           CASE WHEN o_orderpriority IS NULL OR o_orderpriority = '' THEN NULL ELSE
             array_to_string(list_sort(list_distinct(list_transform(
               string_split(regexp_replace(o_orderpriority, '\\s', '', 'g'), ''), lambda x: {_LETTERS}))), '~') END
           AS SpecialConditions
    FROM orders
    """,
)
def special_conditions(t):
    names = n.special_conditions(F.col("o_orderpriority"))
    return t.orders.select("o_orderkey", F.array_join(names, "~").alias("SpecialConditions"))


@query(
    "string_set",
    """
    SELECT o_orderkey, list_sort(list_distinct([CAST(o_custkey % 3 AS VARCHAR), o_orderstatus, 'O'])) AS Tags
    FROM orders
    """,
)
def string_set(t):
    parts = F.array((F.col("o_custkey") % 3).cast("string"), F.col("o_orderstatus"), F.lit("O"))
    return t.orders.select("o_orderkey", n.string_set(parts).alias("Tags"))


@query(
    "split_set",
    """
    SELECT p_partkey, list_sort(list_distinct(string_split(replace(p_name, ' ', ','), ','))) AS OrderTypes,
           list_sort(list_distinct(string_split(CASE WHEN p_size % 9 = 0 THEN '' ELSE p_type || ';' || p_brand END, ';')))
             AS Hours
    FROM part
    """,
)
def split_set(t):
    hours = F.when(F.col("p_size") % 9 == 0, "").otherwise(F.concat_ws(";", "p_type", "p_brand"))
    return t.part.select(
        "p_partkey",
        n.split_set(F.replace(F.col("p_name"), F.lit(" "), F.lit(",")), ",").alias("OrderTypes"),
        n.split_set(hours, ";").alias("Hours"),
    )


@query(
    "tag_value_set",
    """
    SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN NULL ELSE
      list_sort(list_distinct(['ISIN=' || p_brand, 'CUSIP=' || p_type])) END AS SecIdList
    FROM part
    """,
)
def tag_value_set(t):
    pair = [
        F.struct(F.lit(tag).alias("tag"), F.col(c).alias("value")) for tag, c in (("ISIN", "p_brand"), ("CUSIP", "p_type"))
    ]
    pairs = F.filter(F.array(*pair), lambda p: F.col("p_size") % 5 != 0)
    return t.part.select("p_partkey", n.tag_value_set(pairs).alias("SecIdList"))


@query(
    "null_sentinels",
    """
    SELECT l_orderkey, nullif(CASE WHEN l_linenumber = 3 THEN 2147483647 ELSE l_linenumber END, 2147483647) AS AggGroup,
           CASE WHEN l_linestatus = 'F' THEN NULL ELSE l_extendedprice END AS RealizedPNL,
           CASE WHEN l_quantity - 25 > 0 THEN l_quantity - 25 END AS Volume,
           nullif(l_discount, 0.0) AS Price,
           nullif(CASE WHEN l_returnflag = 'N' THEN '?' ELSE l_returnflag END, '?') AS "Right",
           CASE WHEN l_linenumber % 3 = 0 THEN 1.0 ELSE CAST(l_linenumber AS DOUBLE) END AS Multiplier,
           CASE WHEN l_linenumber = 1 THEN NULL ELSE l_linestatus END AS Text
    FROM lineitem
    """,
)
def null_sentinels(t):
    line = F.col("l_linenumber")
    rows = t.lineitem.select(
        "l_orderkey",
        n.unset_int(F.when(line == 3, F.lit(n.INT_UNSET)).otherwise(line)).alias("AggGroup"),
        n.unset_double(
            F.when(F.col("l_linestatus") == "F", F.lit(n.DOUBLE_UNSET)).otherwise(F.col("l_extendedprice"))
        ).alias("RealizedPNL"),
        n.positive_or_null(F.col("l_quantity") - 25).alias("Volume"),
        n.tick_price(F.col("l_discount")).alias("Price"),
        n.option_right(F.when(F.col("l_returnflag") == "N", "?").otherwise(F.col("l_returnflag"))).alias("Right"),
        n.multiplier(F.when(line % 3 == 0, "").otherwise(line.cast("string"))).alias("Multiplier"),
        F.when(line == 1, "").otherwise(F.col("l_linestatus")).alias("Text"),
    )
    return normalize_rows(rows)


@query(
    "decimal_to_double",
    "SELECT l_orderkey, l_quantity AS Size, l_extendedprice AS Price FROM lineitem",
)
def decimal_to_double(t):
    rows = t.lineitem.select(
        "l_orderkey",
        F.col("l_quantity").cast("decimal(18,4)").alias("Size"),
        F.col("l_extendedprice").cast("decimal(18,4)").alias("Price"),
    )
    return n.decimals_to_double(rows)


@query(
    "float_parse",
    """
    SELECT p_partkey, CASE p_size % 6
      WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN CAST(p_size AS DOUBLE) + 0.5
      WHEN 3 THEN CAST(p_size AS DOUBLE) * 1000 WHEN 4 THEN CAST(p_size AS DOUBLE) ELSE NULL END AS DoubleValue
    FROM part
    """,
)
def float_parse(t):
    size = F.col("p_size").cast("string")
    text = (
        F.when(F.col("p_size") % 6 == 0, F.lit(""))
        .when(F.col("p_size") % 6 == 1, F.col("p_name"))
        .when(F.col("p_size") % 6 == 2, F.concat(size, F.lit(".5")))
        .when(F.col("p_size") % 6 == 3, F.concat(size, F.lit("e3")))
        .when(F.col("p_size") % 6 == 4, F.concat(F.lit(" "), size, F.lit(" ")))
        .otherwise(F.concat(size, F.lit("d")))
    )
    return t.part.select("p_partkey", n.lenient_double(text).alias("DoubleValue"))


@query(
    "json_note",
    """
    SELECT event_id, json_extract_string(props, '$.k') AS K, json_extract_string(props, '$.missing') AS Missing,
           CAST(NULL AS VARCHAR) AS NoNote
    FROM events
    """,
)
def json_note(t):
    return t.events.select(
        "event_id",
        n.note_value(F.col("props"), "k").alias("K"),
        n.note_value(F.col("props"), "missing").alias("Missing"),
        n.note_value(F.lit(None).cast("string"), "k").alias("NoNote"),
    )


@query(
    "json_note_write",
    """
    SELECT o_orderkey, '{"account":"A' || o_custkey || '","conid":"' || o_orderkey || '"}' AS Note FROM orders
    """,
)
def json_note_write(t):
    note = n.note_json({"account": F.concat(F.lit("A"), F.col("o_custkey").cast("string")), "conid": F.col("o_orderkey")})
    return t.orders.select("o_orderkey", note.alias("Note"))


@query(
    "headline_clean",
    """
    SELECT conv_id, turn, CASE WHEN instr(h, '}') > 0 THEN substr(h, instr(h, '}') + 1) ELSE h END AS Headline
    FROM (SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN '{A:800015:L:en}' || text || '}x' ELSE text END AS h
          FROM conversations)
    """,
)
def headline_clean(t):
    text = F.when(F.col("turn") % 2 == 0, F.concat(F.lit("{A:800015:L:en}"), F.col("text"), F.lit("}x")))
    return t.conversations.select(
        "conv_id", "turn", n.clean_headline(F.coalesce(text, F.col("text"))).alias("Headline")
    )


def _unescape_sql() -> str:
    """The decoding of character references as HTML 5 states it: numbers, whole names, else the longest name that needs no ``;``."""

    def values(names) -> str:
        def text(v):
            return "concat(" + ", ".join(f"chr({ord(c)})" for c in v) + ")" if len(v) > 1 else f"chr({ord(v)})"

        return ", ".join(f"('{k}', {text(v)})" for k, v in sorted(names.items()))

    windows = ", ".join(f"({128 + i}, {ord(c)})" for i, c in enumerate(bytes(range(128, 160)).decode("cp1252", "replace")) if c != "\ufffd")
    hexadecimal = "list_reduce([0::BIGINT] || list_transform(string_split(lower(digits), ''), lambda d: (strpos('0123456789abcdef', d) - 1)::BIGINT), lambda a, d: a * 16 + d)"
    return f"""
    WITH names(name, said) AS (VALUES {values(html5)}), windows(code, point) AS (VALUES {windows}),
    cut AS (
      SELECT page_id, html, regexp_extract_all(html, '&(#[0-9]+;?|#[xX][0-9A-Fa-f]+;?|[^\\t\\n\\f <&#;]{{1,32}};?)') AS found,
             regexp_split_to_array(html, '&(#[0-9]+;?|#[xX][0-9A-Fa-f]+;?|[^\\t\\n\\f <&#;]{{1,32}};?)') AS gaps
      FROM pages
    ),
    met AS (SELECT DISTINCT unnest(found) AS r FROM cut),
    numbers AS (
      SELECT r, CASE WHEN length(digits) > 9 THEN 1114112 WHEN digits = '' THEN 0 WHEN r ILIKE '&#x%' THEN {hexadecimal} ELSE digits::BIGINT END AS code
      FROM (SELECT r, regexp_replace(regexp_replace(r, '^&#[xX]?0*', ''), ';$', '') AS digits FROM met WHERE r LIKE '&#%')
    ),
    decoded AS (
      SELECT r, CASE WHEN w.point IS NOT NULL THEN chr(w.point::INT) WHEN n.code = 0 OR n.code > 1114111 OR n.code BETWEEN 55296 AND 57343 THEN chr(65533)
                     WHEN n.code BETWEEN 1 AND 8 OR n.code IN (11, 127) OR n.code BETWEEN 14 AND 31 OR n.code BETWEEN 64976 AND 65007 OR n.code % 65536 >= 65534 THEN ''
                     ELSE chr(n.code::INT) END AS said
      FROM numbers n LEFT JOIN windows w ON w.code = n.code
      UNION ALL
      SELECT r, coalesce(arg_max(said || substr(r, length(name) + 2), length(name)), r)
      FROM met LEFT JOIN names ON starts_with(substr(r, 2), name) AND (name = substr(r, 2) OR name NOT LIKE '%;')
      WHERE r NOT LIKE '&#%' GROUP BY r
    ),
    pieces AS (SELECT page_id, html, unnest(gaps) AS gap, unnest(found || ['']) AS r, generate_subscripts(gaps, 1) AS i FROM cut)
    SELECT page_id, string_agg(gap || coalesce(said, ''), '' ORDER BY i) AS ArticleText FROM pieces LEFT JOIN decoded USING (r) GROUP BY page_id, html
    """


@query("html_unescape", _unescape_sql())
def html_unescape(t):
    return t.pages.select("page_id", n.html_unescape(F.col("html")).alias("ArticleText"))


@query(
    "position_exchange",
    """
    SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'SMART' ELSE p_brand END AS Exchange FROM part
    """,
)
def position_exchange(t):
    sec_type = F.when(F.col("p_size") % 3 == 0, "STK").otherwise("OPT")
    return t.part.select("p_partkey", n.position_exchange(sec_type, F.col("p_brand")).alias("Exchange"))


@query(
    "tick_union",
    """
    SELECT event_id AS Seq, user_id AS RequestId, value AS Price, CASE WHEN event_type IN ('view', 'click') THEN 'live' END AS Source
    FROM events
    """,
)
def tick_union(t):
    live = t.events.filter("event_type IN ('view', 'click')").selectExpr(
        "event_id AS Seq", "user_id AS RequestId", "value AS Price", "'live' AS Source"
    )
    past = t.events.filter("event_type IS NULL OR event_type NOT IN ('view', 'click')").selectExpr("event_id AS Seq", "user_id AS RequestId", "value AS HistoricalPrice")
    return unify_ticks(live, past, {"HistoricalPrice": "Price"})


@query(
    "formula_arithmetic",
    """
    SELECT l_orderkey, CAST(0.5 * (l_extendedprice + l_quantity) + 1e-7 AS DECIMAL(38,4)) AS Mid,
           round(l_extendedprice / nullif(l_discount, 0), 6) AS Ratio,
           coalesce(nullif(l_tax, 0), -1.0) AS Tax, l_discount > 0.05 AND l_tax < 0.05 AS Flag,
           CAST(floor(l_extendedprice / 7 + 0.5) AS BIGINT) AS Shares
    FROM lineitem
    """,
)
def formula_arithmetic(t):
    price, discount, tax = (F.col(c) for c in ("l_extendedprice", "l_discount", "l_tax"))
    return t.lineitem.select(
        "l_orderkey",
        money(n.mid(price, F.col("l_quantity")) + 1e-7).alias("Mid"),
        r6(F.try_divide(price, discount)).alias("Ratio"),
        F.coalesce(F.nullif(tax, F.lit(0.0)), F.lit(-1.0)).alias("Tax"),
        ((discount > 0.05) & (tax < 0.05)).alias("Flag"),
        n.round_half_up(price / 7).alias("Shares"),
    )


@query(
    "null_to_blank",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS CustomerKey FROM orders",
)
def null_to_blank(t):
    key = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey"))
    return t.orders.select("o_orderkey", n.null_to_blank(key).alias("CustomerKey"))
