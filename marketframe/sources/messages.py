"""Raw messages to rows of the raw tables: one fixed rule per column, applied where a column has one.

A message comes with the columns of its table, in the feed's own form: times as text or Unix seconds,
sets as delimited text or arrays, codes as numbers or letters, absent numbers as the largest one.
Columns without a rule pass unchanged and everything gets the table's declared type.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import codes
from ..functions import normalize as n
from ..functions import timefmt
from ..operators.relational import assert_unique_columns
from ..schemas import raw_schema, raw_tables

Rule = Callable[[DataFrame, str], Column]


def _plain(rule: Callable[[Column], Column]) -> Rule:
    return lambda df, name: rule(F.col(name))


def _is(df: DataFrame, name: str, kind: type) -> bool:
    return isinstance(df.schema[name].dataType, kind)


def _instant(df: DataFrame, name: str) -> Column:
    """Unix seconds as an instant; instants stay."""
    return F.col(name) if _is(df, name, T.TimestampType) else timefmt.unix_seconds_to_instant(F.col(name))


def _text_instant(df: DataFrame, name: str) -> Column:
    """Feed time text as an instant; instants stay."""
    return F.col(name) if _is(df, name, T.TimestampType) else timefmt.parse_feed_time_strict(F.col(name).cast("string"))


def _bar_instant(df: DataFrame, name: str) -> Column:
    return F.col(name) if _is(df, name, T.TimestampType) else timefmt.parse_bar_date(F.col(name).cast("string"))


def _set(delimiter: str) -> Rule:
    """Delimited text, or an array, as a set."""
    return lambda df, name: n.string_set(F.col(name)) if _is(df, name, T.ArrayType) else n.split_set(F.col(name), delimiter)


def _tags(df: DataFrame, name: str) -> Column:
    """Structs of tag and value, or their texts, as a set."""
    kind = df.schema[name].dataType
    pairs = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType)
    return n.tag_value_set(F.col(name)) if pairs else n.string_set(F.col(name))


def _elements(df: DataFrame, name: str) -> Column:
    return n.string_set(F.col(name)) if _is(df, name, T.ArrayType) else n.string_set(F.array(F.col(name)))


def _conditions(df: DataFrame, name: str) -> Column:
    return F.col(name) if _is(df, name, T.ArrayType) else n.special_conditions(F.col(name))


def _named(values: Mapping) -> Rule:
    """A code by its name; a text that is one of the names already stays."""
    known = [v for v in values.values() if v is not None]
    return lambda df, name: F.when(F.col(name).cast("string").isin(known), F.col(name).cast("string")).otherwise(codes.map_values(F.col(name), values))


def _exchange(df: DataFrame, name: str) -> Column:
    return n.position_exchange(F.col("SecType"), F.col(name)) if "SecType" in df.columns else F.col(name)


_CONTRACT = {"Right": _plain(n.option_right), "Multiplier": _plain(n.multiplier), "ComboLegs": _elements}
_DETAILS = {
    **{c: _set(",") for c in ("OrderTypes", "ValidExchanges", "MarketRuleIds")},
    **{c: _set(";") for c in ("TradingHours", "LiquidHours")},
    "AggGroup": _plain(n.unset_int),
    "SecIdList": _tags,
}
_BAR = {"Timestamp": _bar_instant, **{c: _plain(n.positive_or_null) for c in ("Volume", "BarCount", "WAP")}}
_LIVE_BAR = {"Timestamp": _instant, "TimestampEnd": _instant, **{c: _plain(n.positive_or_null) for c in ("Volume", "WAP", "Count")}}
_ORDER = {
    **{c: _named(values) for c, values in codes.ORDER_CODES.items()},
    **{c: _elements for c in ("AlgoParams", "SmartComboRoutingParams", "OrderComboLegs", "OrderMiscOptions", "Conditions")},
}
_WHOLE_ORDER = {**_CONTRACT, **_ORDER}

#: Rules by table and column. Tables that are not named here have none of their own.
RULES: dict[str, dict[str, Rule]] = {
    "accounts_allocation_profiles": {"Type": _named(codes.ALLOCATION_TYPE)},
    "accounts_positions": {**_CONTRACT, "Exchange": _exchange},
    "bars_historical": _BAR,
    "bars_realtime": _LIVE_BAR,
    "contracts_details": {**_CONTRACT, **_DETAILS},
    "contracts_matching": {**_CONTRACT, "DerivativeSecTypes": _set(",")},
    "news_articles": {"ArticleType": _named(codes.ARTICLE_TYPE), "ArticleText": _plain(n.html_unescape)},
    "news_bulletins": {"MsgType": _named(codes.NEWS_MESSAGE_TYPE)},
    "news_historical": {"Timestamp": _text_instant, "Headline": _plain(n.clean_headline)},
    "orders_completed": _WHOLE_ORDER,
    "orders_exec_commission_report": {
        "RealizedPNL": _plain(n.unset_double),
        "Yield": _plain(n.unset_double),
        "YieldRedemptionDate": lambda df, name: F.col(name) if _is(df, name, T.StringType) else n.yield_date(F.col(name)),
    },
    "orders_exec_details": {**_CONTRACT, "Timestamp": _text_instant},
    "orders_submitted": _WHOLE_ORDER,
    "requests": _CONTRACT,
    "errors": {"RequestId": _plain(n.unset_int)},
    "ticks_bid_ask": {"Timestamp": _instant},
    "ticks_mid_point": {"Timestamp": _instant},
    "ticks_option_computation": {"TickAttrib": _named(codes.OPTION_TICK_ATTRIB)},
    "ticks_price": {"Price": _plain(n.tick_price)},
    "ticks_trade": {"Timestamp": _instant, "SpecialConditions": _conditions},
}


def normalize_message(table: str, df: DataFrame) -> DataFrame:
    """Messages of one raw table as its rows: the columns given, by rule, with blanks as NULL and declared types.

    Columns that the table doesn't have are kept as they are (ReceiveTime and Seq among them). NULLs stay
    NULL but for a multiplier, which is 1 then. Rows that are normalised already come out unchanged.
    """
    if table not in raw_tables():
        raise ValueError(f"Unknown raw table: {table}")
    df = assert_unique_columns(df)
    kinds = {f.name: f.dataType for f in raw_schema(table)}
    rules = RULES.get(table, {})
    columns = []
    for name in df.columns:
        value = rules[name](df, name) if name in rules else F.col(f"`{name}`")
        columns.append((value.cast(kinds[name]) if name in kinds else value).alias(name))
    return n.blank_to_null(n.decimals_to_double(df.select(*columns)))
