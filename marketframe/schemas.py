"""Schemas of the raw tables, declared once as DDL and never inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# Names and types of the public tables' columns, in their order.
# Column blocks shared by several tables.
CONTRACT = """
    ContractId BIGINT, SecId STRING, SecIdType STRING, SecType STRING, Symbol STRING, LocalSymbol
    STRING, TradingClass STRING, Currency STRING, Exchange STRING, PrimaryExchange STRING,
    LastTradeDateOrContractMonth STRING, Strike DOUBLE, Right STRING, Multiplier DOUBLE,
    ComboLegsDescrip STRING, ComboLegs ARRAY<STRING>, DeltaNeutralContract STRING
"""
CONTRACT_DETAILS = """
    MarketName STRING, MinTick DOUBLE, OrderTypes ARRAY<STRING>, ValidExchanges ARRAY<STRING>,
    PriceMagnifier BIGINT, UnderConId BIGINT, LongName STRING, ContractMonth STRING, Industry
    STRING, Category STRING, SubCategory STRING, TimeZoneId STRING, TradingHours ARRAY<STRING>,
    LiquidHours ARRAY<STRING>, EvRule STRING, EvMultiplier BIGINT, AggGroup BIGINT, UnderSymbol
    STRING, UnderSecType STRING, MarketRuleIds ARRAY<STRING>, SecIdList ARRAY<STRING>,
    RealExpirationDate STRING, LastTradeTime STRING, StockType STRING, CUSIP STRING, Ratings STRING,
    DescAppend STRING, BondType STRING, CouponType STRING, Callable BOOLEAN, Putable BOOLEAN, Coupon
    DOUBLE, Convertible BOOLEAN, Maturity STRING, IssueDate STRING, NextOptionDate STRING,
    NextOptionType STRING, NextOptionPartial BOOLEAN, Notes STRING
"""
FAMILY_CODE = """
    AccountID STRING, FamilyCode STRING
"""
PRICE_INCREMENT = """
    LowEdge DOUBLE, Increment DOUBLE
"""
BAR_DATA = """
    Timestamp TIMESTAMP, Open DOUBLE, High DOUBLE, Low DOUBLE, Close DOUBLE, Volume DOUBLE, BarCount
    BIGINT, WAP DOUBLE
"""
REAL_TIME_BAR_DATA = """
    Timestamp TIMESTAMP, TimestampEnd TIMESTAMP, Open DOUBLE, High DOUBLE, Low DOUBLE, Close DOUBLE,
    Volume DOUBLE, WAP DOUBLE, Count BIGINT
"""
TICK_ATTRIB = """
    CanAutoExecute BOOLEAN, PastLimit BOOLEAN, PreOpen BOOLEAN
"""
TICK_ATTRIB_LAST = """
    PastLimit BOOLEAN, Unreported BOOLEAN
"""
HISTORICAL_TICK_LAST = """
    Timestamp TIMESTAMP, Price DOUBLE, Size DOUBLE, PastLimit BOOLEAN, Unreported BOOLEAN, Exchange
    STRING, SpecialConditions ARRAY<STRING>
"""
TICK_ATTRIB_BID_ASK = """
    BidPastLow BOOLEAN, AskPastHigh BOOLEAN
"""
HISTORICAL_TICK_BID_ASK = """
    Timestamp TIMESTAMP, BidPrice DOUBLE, AskPrice DOUBLE, BidSize DOUBLE, AskSize DOUBLE,
    BidPastLow BOOLEAN, AskPastHigh BOOLEAN
"""
ORDER = """
    OrderId BIGINT, ClientId BIGINT, PermId BIGINT, Action STRING, TotalQuantity DOUBLE, OrderType
    STRING, LmtPrice DOUBLE, AuxPrice DOUBLE, TIF STRING, ActiveStartTime STRING, ActiveStopTime
    STRING, OcaGroup STRING, OcaType STRING, OrderRef STRING, Transmit BOOLEAN, ParentId BIGINT,
    BlockOrder BOOLEAN, SweepToFill BOOLEAN, DisplaySize BIGINT, TriggerMethod STRING, OutsideRth
    BOOLEAN, Hidden BOOLEAN, GoodAfterTime STRING, GoodTillDate STRING, Rule80A STRING, AllOrNone
    BOOLEAN, MinQty BIGINT, PercentOffset DOUBLE, OverridePercentageConstraints BOOLEAN,
    TrailStopPrice DOUBLE, TrailingPercent DOUBLE, FaGroup STRING, FaProfile STRING, FaMethod
    STRING, FaPercentage STRING, DesignatedLocation STRING, OpenClose STRING, Origin STRING,
    ShortSaleSlot STRING, ExemptCode BIGINT, DiscretionaryAmt DOUBLE, OptOutSmarRouting BOOLEAN,
    AuctionStrategy STRING, StartingPrice DOUBLE, StockRefPrice DOUBLE, Delta DOUBLE,
    StockRangeLower DOUBLE, StockRangeUpper DOUBLE, RandomizePrice BOOLEAN, RandomizeSize BOOLEAN,
    Volatility DOUBLE, VolatilityType STRING, DeltaNeutralOrderType STRING, DeltaNeutralAuxPrice
    DOUBLE, DeltaNeutralConId BIGINT, DeltaNeutralSettlingFirm STRING, DeltaNeutralClearingAccount
    STRING, DeltaNeutralClearingIntent STRING, DeltaNeutralOpenClose STRING, DeltaNeutralShortSale
    BOOLEAN, DeltaNeutralShortSaleSlot BIGINT, DeltaNeutralDesignatedLocation STRING,
    ContinuousUpdate BOOLEAN, ReferencePriceType STRING, BasisPoints DOUBLE, BasisPointsType BIGINT,
    ScaleInitLevelSize BIGINT, ScaleSubsLevelSize BIGINT, ScalePriceIncrement DOUBLE,
    ScalePriceAdjustValue DOUBLE, ScalePriceAdjustInterval BIGINT, ScaleProfitOffset DOUBLE,
    ScaleAutoReset BOOLEAN, ScaleInitPosition BIGINT, ScaleInitFillQty BIGINT, ScaleRandomPercent
    BOOLEAN, ScaleTable STRING, HedgeType STRING, HedgeParam STRING, Account STRING, SettlingFirm
    STRING, ClearingAccount STRING, ClearingIntent STRING, AlgoStrategy STRING, AlgoParams
    ARRAY<STRING>, SmartComboRoutingParams ARRAY<STRING>, AlgoId STRING, WhatIf BOOLEAN, NotHeld
    BOOLEAN, Solicited BOOLEAN, ModelCode STRING, OrderComboLegs ARRAY<STRING>, OrderMiscOptions
    ARRAY<STRING>, ReferenceContractId BIGINT, PeggedChangeAmount DOUBLE,
    IsPeggedChangeAmountDecrease BOOLEAN, ReferenceChangeAmount DOUBLE, ReferenceExchangeId STRING,
    AdjustedOrderType STRING, TriggerPrice DOUBLE, AdjustedStopPrice DOUBLE, AdjustedStopLimitPrice
    DOUBLE, AdjustedTrailingAmount DOUBLE, AdjustableTrailingUnit BIGINT, LmtPriceOffset DOUBLE,
    Conditions ARRAY<STRING>, ConditionsCancelOrder BOOLEAN, ConditionsIgnoreRth BOOLEAN,
    ExtOperator STRING, CashQty DOUBLE, Mifid2DecisionMaker STRING, Mifid2DecisionAlgo STRING,
    Mifid2ExecutionTrader STRING, Mifid2ExecutionAlgo STRING, DontUseAutoPriceForHedge BOOLEAN,
    IsOmsContainer BOOLEAN, DiscretionaryUpToLimitPrice BOOLEAN, AutoCancelDate STRING,
    FilledQuantity DOUBLE, RefFuturesConId BIGINT, AutoCancelParent BOOLEAN, Shareholder STRING,
    ImbalanceOnly BOOLEAN, RouteMarketableToBbo BOOLEAN, ParentPermId BIGINT, UsePriceMgmtAlgo
    BOOLEAN, SoftDollarTier STRING
"""
ORDER_STATE = """
    Status STRING, InitMarginBefore STRING, MaintMarginBefore STRING, EquityWithLoanBefore STRING,
    InitMarginChange STRING, MaintMarginChange STRING, EquityWithLoanChange STRING, InitMarginAfter
    STRING, MaintMarginAfter STRING, EquityWithLoanAfter STRING, Commission DOUBLE, MinCommission
    DOUBLE, MaxCommission DOUBLE, CommissionCurrency STRING, WarningText STRING, CompletedTime
    STRING, CompletedStatus STRING
"""
EXECUTION = """
    ExecId STRING, Timestamp TIMESTAMP, AcctNumber STRING, Exchange STRING, Side STRING, Shares
    DOUBLE, Price DOUBLE, PermId BIGINT, ClientId BIGINT, OrderId BIGINT, Liquidation BIGINT, CumQty
    DOUBLE, AvgPrice DOUBLE, OrderRef STRING, EvRule STRING, EvMultiplier DOUBLE, ModelCode STRING,
    LastLiquidity BIGINT
"""
COMMISSION_REPORT = """
    ExecId STRING, Commission DOUBLE, Currency STRING, RealizedPNL DOUBLE, Yield DOUBLE,
    YieldRedemptionDate STRING
"""
NEWS_PROVIDER = """
    Code STRING, Name STRING
"""

_REQUEST = "RequestId BIGINT"

# Columns after ReceiveTime.
_TABLES = {
    "accounts_aliases": "Account STRING, Alias STRING",
    "accounts_allocation_profiles": (
        "AllocationProfileName STRING, Type STRING, Account STRING, Amount DOUBLE"
    ),
    "accounts_family_codes": FAMILY_CODE,
    "accounts_groups": "GroupName STRING, DefaultMethod STRING, Account STRING",
    "accounts_managed": "Account STRING",
    "accounts_overview": (
        f"{_REQUEST}, Account STRING, ModelCode STRING, Currency STRING, Key STRING, Value STRING"
    ),
    "accounts_pnl": f"{_REQUEST}, DailyPnl DOUBLE, UnrealizedPnl DOUBLE, RealizedPnl DOUBLE",
    "accounts_pnl_single": (
        f"{_REQUEST}, Position DOUBLE, DailyPnL DOUBLE, UnrealizedPnL DOUBLE, RealizedPnL DOUBLE, "
        "Value DOUBLE"
    ),
    "accounts_positions": (
        f"{_REQUEST}, Account STRING, ModelCode STRING, {CONTRACT}, Position DOUBLE, AvgCost DOUBLE"
    ),
    "accounts_summary": f"{_REQUEST}, Account STRING, Tag STRING, Value STRING, Currency STRING",
    "bars_historical": f"{_REQUEST}, {BAR_DATA}",
    "bars_realtime": f"{_REQUEST}, {REAL_TIME_BAR_DATA}",
    "contracts_details": f"{_REQUEST}, {CONTRACT}, {CONTRACT_DETAILS}",
    "contracts_matching": f"{_REQUEST}, {CONTRACT}, DerivativeSecTypes ARRAY<STRING>",
    "errors": f"{_REQUEST}, ErrorCode BIGINT, ErrorDescription STRING, Error STRING, Note STRING",
    "market_rules": f"MarketRuleId STRING, {PRICE_INCREMENT}",
    "news_articles": f"{_REQUEST}, ArticleType STRING, ArticleText STRING",
    "news_bulletins": "MsgId BIGINT, MsgType STRING, Message STRING, OriginExch STRING",
    "news_historical": (
        f"{_REQUEST}, Timestamp TIMESTAMP, ProviderCode STRING, ArticleId STRING, Headline STRING"
    ),
    "news_providers": NEWS_PROVIDER,
    "orders_completed": f"{CONTRACT}, {ORDER}, {ORDER_STATE}",
    "orders_exec_commission_report": COMMISSION_REPORT,
    # Two blocks bring an Exchange column; each keeps a name of its own.
    "orders_exec_details": ", ".join(
        (
            _REQUEST,
            CONTRACT.replace(" Exchange STRING", " ContractExchange STRING"),
            EXECUTION.replace(" Exchange STRING", " ExecutionExchange STRING"),
        )
    ),
    "orders_status": (
        "OrderId BIGINT, Status STRING, Filled DOUBLE, Remaining DOUBLE, AvgFillPrice DOUBLE, "
        "PermId BIGINT, ParentId BIGINT, LastFillPrice DOUBLE, ClientId BIGINT, WhyHeld STRING, "
        "MktCapPrice DOUBLE"
    ),
    "orders_submitted": f"{CONTRACT}, {ORDER}, {ORDER_STATE}",
    "requests": f"{_REQUEST}, RequestType STRING, {CONTRACT}, Note STRING",
    "ticks_bid_ask": f"{_REQUEST}, {HISTORICAL_TICK_BID_ASK}",
    "ticks_efp": (
        f"{_REQUEST}, TickType STRING, BasisPoints DOUBLE, FormattedBasisPoints STRING, "
        "TotalDividends DOUBLE, HoldDays BIGINT, FutureLastTradeDate STRING, DividendImpact DOUBLE, "
        "DividendsToLastTradeDate DOUBLE"
    ),
    "ticks_generic": f"{_REQUEST}, TickType STRING, Value DOUBLE",
    "ticks_mid_point": f"{_REQUEST}, Timestamp TIMESTAMP, MidPoint DOUBLE",
    "ticks_option_computation": (
        f"{_REQUEST}, TickType STRING, TickAttrib STRING, ImpliedVol DOUBLE, Delta DOUBLE, "
        "OptPrice DOUBLE, PvDividend DOUBLE, Gamma DOUBLE, Vega DOUBLE, Theta DOUBLE, UndPrice DOUBLE"
    ),
    "ticks_price": f"{_REQUEST}, TickType STRING, Price DOUBLE, {TICK_ATTRIB}",
    "ticks_size": f"{_REQUEST}, TickType STRING, Size DOUBLE",
    "ticks_string": f"{_REQUEST}, TickType STRING, Value STRING",
    "ticks_trade": f"{_REQUEST}, {HISTORICAL_TICK_LAST}",
}

# Arrival time and, to order rows that arrived together, an arrival number.
ARRIVAL = ("ReceiveTime", "Seq")


def raw_schema(table: str, seq: bool = True) -> T.StructType:
    """Schema of a raw table: ReceiveTime, its columns, and the arrival number ``Seq``."""
    tail = ", Seq BIGINT" if seq else ""
    return T.StructType.fromDDL(f"ReceiveTime TIMESTAMP, {_TABLES[table]}{tail}")


def raw_tables() -> list[str]:
    """Names of the raw tables."""
    return sorted(_TABLES)


# Short rates come from files and carry no ReceiveTime; further file columns keep their file names.
SHORT_RATES_RENAMES = {
    "SYM": "Sym",
    "CUR": "Currency",
    "NAME": "Name",
    "CON": "Contract",
    "REBATERATE": "RebateRate",
    "FEERATE": "FeeRate",
    "AVAILABLE": "Available",
}
