from datetime import datetime, timedelta

import pytest

from marketframe.plans.derived import annotate, derive
from marketframe.schemas import raw_schema, raw_tables

START = datetime(2024, 1, 1)


def raw(spark, table, *rows):
    """A raw table with the named values; all else NULL."""
    schema = raw_schema(table)
    unknown = {k for r in rows for k in r} - set(schema.names)
    assert not unknown, unknown
    data = []
    for i, row in enumerate(rows):
        given = {"ReceiveTime": START + timedelta(seconds=i), "Seq": i, **row}
        data.append(tuple(given.get(c) for c in schema.names))
    return spark.createDataFrame(data, schema)


@pytest.fixture
def requests(spark):
    return raw(
        spark,
        "requests",
        {"RequestId": 1, "RequestType": "Pnl", "Note": '{"account": "All", "model_code": ""}'},
        {"RequestId": 2, "RequestType": "MatchingSymbols", "Note": '{"pattern": "AM"}'},
        {"RequestId": 3, "RequestType": "MarketData", "ContractId": 33, "Symbol": "GOOG", "SecType": "STK", "Note": None},
        {"RequestId": 4, "RequestType": "AccountSummary", "Note": '{"groupName": "g", "conid": "7"}'},
    )


def test_every_table_is_derived(spark, requests):
    everything = {t: raw(spark, t) for t in raw_tables()} | {"requests": requests}
    tables = derive(everything)
    assert list(tables) == sorted(raw_tables()) and len(tables) == 35
    for name, df in tables.items():
        assert "Seq" not in df.columns and len(set(df.columns)) == len(df.columns), name
    for name in ("ticks_bid_ask", "bars_historical"):
        assert tables[name].columns[:4] == ["RequestId", "ReceiveTime", "Timestamp", "ContractId"]
    assert tables["bars_realtime"].columns[:4] == ["RequestId", "ReceiveTime", "Timestamp", "TimestampEnd"]
    assert tables["orders_submitted"].columns[:8] == [
        "ReceiveTime", "Account", "ModelCode", "PermId", "ClientId", "OrderId", "ParentId", "Status",
    ]
    assert "TradeExchange" in tables["ticks_trade"].columns and "Account" in tables["orders_exec_details"].columns


def test_ticks_are_annotated(spark, requests, values):
    ticks = raw(spark, "ticks_price", {"RequestId": 3, "Price": 1.5}, {"RequestId": 99, "Price": 2.0}, {"RequestId": None})
    out = annotate(ticks, requests)
    assert values(out, "RequestId", "Symbol", "Price") == [(None, None, None), (3, "GOOG", 1.5), (99, None, 2.0)]
    with pytest.raises(Exception, match="Duplicate right keys"):
        annotate(ticks, requests.union(requests)).collect()


def test_an_updated_bar_replaces_its_earlier_version(spark, requests, values):
    at = START + timedelta(hours=1)
    bars = raw(
        spark,
        "bars_historical",
        {"RequestId": 3, "Timestamp": at, "Close": 1.0},
        {"RequestId": 3, "Timestamp": at, "Close": 2.0},
        {"RequestId": 3, "Timestamp": START, "Close": 5.0},
    )
    out = derive({"requests": requests, "bars_historical": bars})["bars_historical"]
    assert values(out, "Symbol", "Close") == [("GOOG", 2.0), ("GOOG", 5.0)]


def test_order_status_comes_from_the_status_table(spark, values):
    orders = raw(spark, "orders_submitted", {"PermId": 1, "Status": "wrong", "OrderId": 1}, {"PermId": 2, "Status": "wrong"}, {"PermId": 1, "Status": "wrong", "OrderId": 5})
    status = raw(spark, "orders_status", {"PermId": 1, "Status": "Submitted"}, {"PermId": 1, "Status": "Filled"})
    tables = derive({"orders_submitted": orders, "orders_status": status})
    assert values(tables["orders_submitted"], "PermId", "OrderId", "Status") == [(1, 5, "Filled"), (2, None, None)]
    assert values(tables["orders_status"], "PermId", "Status") == [(1, "Filled")]


def test_accounts(spark, requests, values):
    overview = [{"RequestId": 1, "Account": "A", "Currency": "USD", "Key": k, "Value": v} for k, v in (("x", "1e3"), ("y", "abc"), ("x", " 1.5 "))]
    summary = [{"RequestId": 4, "Account": "A", "Tag": "SMA", "Value": v} for v in ("1", "2")]
    tables = derive(
        {
            "requests": requests,
            "accounts_overview": raw(spark, "accounts_overview", *overview),
            "accounts_summary": raw(spark, "accounts_summary", *summary),
            "accounts_pnl": raw(spark, "accounts_pnl", {"RequestId": 1, "DailyPnl": 1.0}, {"RequestId": 1, "DailyPnl": 2.0}),
            "accounts_pnl_single": raw(spark, "accounts_pnl_single", {"RequestId": 4, "Value": 1.0}),
            "accounts_managed": raw(spark, "accounts_managed", {"Account": "A"}, {"Account": "A"}),
            "accounts_positions": raw(
                spark, "accounts_positions", *[{"RequestId": 1, "Account": "A", "ContractId": c, "Position": float(p)} for c, p in ((1, 5), (2, 6), (1, 7))]
            ),
        }
    )
    assert values(tables["accounts_overview"], "Key", "DoubleValue") == [("x", 1.5), ("y", None)]
    assert values(tables["accounts_summary"], "GroupName", "Tag", "DoubleValue") == [("g", "SMA", 2.0)]
    assert values(tables["accounts_pnl"], "Account", "ModelCode", "DailyPnl") == [("All", "", 2.0)]
    assert values(tables["accounts_pnl_single"], "Account", "ConId") == [(None, "7")]
    assert values(tables["accounts_managed"]) == [("A",)]
    assert values(tables["accounts_positions"], "ContractId", "Position") == [(1, 7.0), (2, 6.0)]
    assert tables["accounts_summary"].columns[:3] == ["RequestId", "ReceiveTime", "GroupName"]


def test_patterns_errors_and_news(spark, requests, values):
    tables = derive(
        {
            "requests": requests,
            "contracts_matching": raw(spark, "contracts_matching", {"RequestId": 2, "Symbol": "AMD"}),
            "errors": raw(spark, "errors", {"RequestId": 3, "ErrorCode": 1, "Note": "n"}, {"RequestId": None, "ErrorCode": 2}),
            "news_historical": raw(spark, "news_historical", {"RequestId": 3, "Headline": "h"}),
            "market_rules": raw(spark, "market_rules", {"MarketRuleId": "26"}, {"MarketRuleId": "26"}),
        }
    )
    assert values(tables["contracts_matching"], "Pattern", "Symbol") == [("AM", "AMD")]
    assert values(tables["errors"], "ErrorCode", "Note", "Symbol") == [(1, "n", "GOOG"), (2, None, None)]
    assert "RequestTime" in tables["errors"].columns
    assert values(tables["news_historical"], "ContractId", "Symbol", "Headline") == [(33, "GOOG", "h")]
    assert tables["market_rules"].count() == 1


def test_arrival_number_can_be_kept(spark, requests):
    assert "Seq" in derive({"requests": requests}, keep_seq=True)["requests"].columns
