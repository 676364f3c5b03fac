"""The derived tables: each a function of the raw tables, built lazily."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.normalize import lenient_double, note_value
from ..operators.relational import last_by, move_up, natural_join, rename, select_distinct, update

ORDER = ["ReceiveTime", "Seq"]
# Request columns that annotated tables leave out.
UNANNOTATED = ["ReceiveTime", "Seq", "RequestType", "SecId", "SecIdType", "DeltaNeutralContract", "Note"]


def annotate(rows: DataFrame, requests: DataFrame, validate: bool = True) -> DataFrame:
    """Each row with the request and contract that produced it, identifying columns first."""
    dim = requests.drop(*UNANNOTATED)
    # Requests always have a number, so plain equality finds the same rows and uses rows parted by RequestId as they are.
    out = natural_join(rows, dim, "RequestId", validate=validate, null_safe=False)
    lead = [c for c in ("RequestId", "ReceiveTime", "Timestamp", "TimestampEnd") if c in out.columns]
    return move_up(out, [*lead, *[c for c in dim.columns if c not in lead]])


def _noted(rows: DataFrame, requests: DataFrame, names: Mapping[str, str], validate: bool) -> DataFrame:
    """Columns read from the request's note. The note is parsed once per request, before the join."""
    notes = requests.select("RequestId", *[note_value(F.col("Note"), k).alias(c) for c, k in names.items()])
    return natural_join(rows, notes, "RequestId", validate=validate, null_safe=False)


def derive(raw: Mapping[str, DataFrame], keep_seq: bool = False, validate: bool = True) -> dict[str, DataFrame]:
    """The derived tables whose raw tables are given, sorted by name.

    ``raw`` maps names to raw tables with ``ReceiveTime`` and ``Seq``; ``requests`` is needed by
    every table that carries request columns. ``keep_seq`` leaves the arrival number in the result,
    for further last-row queries. ``validate=False`` skips the check that request ids are unique.
    """
    rules = {
        "requests": lambda t: move_up(t, ["RequestId", "ReceiveTime"]),
        "errors": lambda t: _errors(t, raw["requests"], validate),
        "contracts_details": lambda t: move_up(t, ["RequestId", "ReceiveTime"]),
        "accounts_family_codes": lambda t: t.drop("ReceiveTime"),
        "accounts_groups": lambda t: t.drop("ReceiveTime"),
        "accounts_allocation_profiles": lambda t: t.drop("ReceiveTime"),
        "accounts_aliases": lambda t: t.drop("ReceiveTime"),
        "accounts_managed": lambda t: select_distinct(t, "Account"),
        "accounts_positions": _accounts_positions,
        "accounts_overview": _accounts_overview,
        "accounts_summary": lambda t: _accounts_summary(t, raw["requests"], validate),
        "accounts_pnl": lambda t: _pnl(
            t, raw["requests"], {"Account": "account", "ModelCode": "model_code"}, validate
        ),
        "accounts_pnl_single": lambda t: _pnl(
            t,
            raw["requests"],
            {"Account": "account", "ModelCode": "model_code", "ConId": "conid"},
            validate,
        ),
        "contracts_matching": lambda t: move_up(
            _noted(t, raw["requests"], {"Pattern": "pattern"}, validate),
            ["RequestId", "ReceiveTime", "Pattern"],
        ),
        "market_rules": lambda t: select_distinct(t, ["MarketRuleId", "LowEdge", "Increment"]),
        "news_bulletins": lambda t: t,
        "news_providers": lambda t: t.drop("ReceiveTime"),
        "news_articles": lambda t: move_up(t, ["RequestId", "ReceiveTime"]),
        "news_historical": lambda t: _news_historical(t, raw["requests"], validate),
        "orders_completed": lambda t: move_up(t, ["ReceiveTime", "OrderId", "ClientId", "PermId", "ParentId"]),
        "orders_exec_commission_report": lambda t: t,
        "orders_exec_details": lambda t: rename(
            move_up(t, ["RequestId", "ReceiveTime", "Timestamp", "ExecId", "AcctNumber"]),
            "Account=AcctNumber",
        ),
        "orders_submitted": lambda t: _orders_submitted(t, raw["orders_status"]),
        "orders_status": lambda t: move_up(
            last_by(t, "PermId", ORDER), ["ReceiveTime", "PermId", "ClientId", "OrderId", "ParentId"]
        ),
        # A request is for one contract, so an update can replace its bar before the join.
        "bars_historical": lambda t: annotate(last_by(t, ["RequestId", "Timestamp"], ORDER), raw["requests"], validate),
        "ticks_trade": lambda t: annotate(rename(t, "TradeExchange=Exchange"), raw["requests"], validate),
        "short_rates": lambda t: t,
    }
    plain = (
        "bars_realtime",
        "ticks_bid_ask",
        "ticks_efp",
        "ticks_generic",
        "ticks_mid_point",
        "ticks_option_computation",
        "ticks_price",
        "ticks_size",
        "ticks_string",
    )
    rules.update({name: lambda t: annotate(t, raw["requests"], validate) for name in plain})
    tables = {name: rules[name](t) for name, t in raw.items()}
    return {name: t if keep_seq else t.drop("Seq") for name, t in sorted(tables.items())}


def _errors(errors, requests, validate):
    dim = requests.drop("Note", "Seq").withColumnRenamed("ReceiveTime", "RequestTime")
    return move_up(natural_join(errors, dim, "RequestId", validate=validate), ["RequestId", "ReceiveTime"])


def _accounts_positions(t):
    latest = last_by(t, ["RequestId", "Account", "ModelCode", "ContractId"], ORDER)
    return move_up(latest, ["RequestId", "ReceiveTime"])


def _accounts_overview(t):
    latest = last_by(t, ["RequestId", "Account", "Currency", "Key"], ORDER)
    out = update(latest, {"DoubleValue": lenient_double(F.col("Value"))})
    return move_up(out, ["RequestId", "ReceiveTime"])


def _accounts_summary(t, requests, validate):
    # GroupName follows from RequestId, so the last row can be taken before the join.
    latest = last_by(t, ["RequestId", "Account", "Tag"], ORDER)
    out = _noted(latest, requests, {"GroupName": "groupName"}, validate)
    out = update(out, {"DoubleValue": lenient_double(F.col("Value"))})
    return move_up(out, ["RequestId", "ReceiveTime", "GroupName"])


def _pnl(t, requests, names, validate):
    out = _noted(last_by(t, "RequestId", ORDER), requests, names, validate)
    return move_up(out, ["RequestId", "ReceiveTime", *names])


def _news_historical(t, requests, validate):
    contract = ["ContractId", "SecType", "Symbol", "LocalSymbol"]
    out = natural_join(t, requests, "RequestId", contract, validate=validate)
    return move_up(out, ["RequestId", "ReceiveTime", "Timestamp", *contract])


def _orders_submitted(orders, status):
    """Latest order per PermId; its status is taken from the status table, the reliable source."""
    latest = last_by(orders, "PermId", ORDER).drop("Status")
    out = natural_join(latest, last_by(status, "PermId", ORDER), "PermId", "Status", validate=False)
    return move_up(
        out, ["ReceiveTime", "Account", "ModelCode", "PermId", "ClientId", "OrderId", "ParentId", "Status"]
    )
