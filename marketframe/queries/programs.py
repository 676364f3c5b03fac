"""The four analyses on the driver's tables."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ..functions import pricing
from ..operators.ordered import returns
from ..operators.relational import last_by, natural_join, sum_by
from ..plans import beta_hedge as beta
from ..plans import market_making as mm
from ..plans import option_risk as risk
from ..plans.market import BarSize, bars_from_ticks
from ..plans.pair_ratio import pair_ratio
from .registry import ntz, query, rounded
from .series import TICKS, decay_ctes, grid

DAY = timedelta(days=1)

_DAILY = """
    daily AS (SELECT {key}, date_trunc('day', ts) AS day, arg_max(value, (ts, event_id)) AS c FROM events GROUP BY 1, 2)
"""


def _daily(t, key):
    bars = bars_from_ticks(t.events, BarSize.DAY_1, key, "ts", "event_id", "value", None)
    return bars.select(key, ntz("Timestamp").alias("Timestamp"), "Close")


@query(
    "pair_ratio",
    f"""
    WITH {_DAILY.format(key="event_type")}
    SELECT a.day AS Timestamp, a.c AS "First", b.c AS "Second", round(a.c / nullif(b.c, 0), 6) AS Ratio
    FROM daily a LEFT JOIN daily b ON a.day = b.day AND b.event_type = 'view' WHERE a.event_type = 'purchase'
    """,
)
def pair(t):
    out = pair_ratio(_daily(t, "event_type"), "purchase", "view", "event_type", "Timestamp", ("Timestamp",), validate=False)
    return rounded(out, "Ratio")


_SNAPSHOT = f"""
    {decay_ctes(86400)},
    p AS (SELECT s.*, i.m AS PredPrice, d.sd AS PredSD, i.m - d.sd AS PredLow, i.m + d.sd AS PredHigh,
                 min(s.ts) OVER (PARTITION BY s.user_id) AS TimestampFirst
          FROM src s JOIN inno i USING (event_id) JOIN dev d USING (event_id)),
    g AS ({TICKS}),
    gu AS (SELECT * FROM g, (SELECT DISTINCT user_id FROM events)),
    snap AS (SELECT gu.SnapTime, p.* FROM gu ASOF JOIN p ON gu.user_id = p.user_id AND gu.SnapTime >= p.ts),
    lim AS (SELECT user_id AS ContractId, SnapTime, PredLow, PredHigh, coalesce(c_acctbal, 0.0) AS Position,
                   coalesce(c_acctbal, 0.0) * value AS PositionDollars
            FROM snap LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') c ON user_id = c_custkey
            WHERE ts > TimestampFirst + INTERVAL 1 DAY)
"""
_LIMIT = 500000.0


def _limits(t):
    events = t.events.select("event_id", "ts", "user_id", "value")
    preds = mm.predictions(events, DAY, "user_id", "ts", "event_id", "value")
    snaps = mm.latest_snapshot(preds, grid(t), "user_id", "ts", "event_id", history=True)
    rows = mm.after_burn_in(mm.with_first_time(snaps, events, "user_id", "ts"), DAY, "ts")
    rows = rows.withColumnRenamed("user_id", "ContractId").withColumn("SnapTime", ntz("SnapTime"))
    held = t.customer.filter("c_mktsegment <> 'BUILDING'").selectExpr("c_custkey AS ContractId", "c_acctbal AS Position")
    return mm.order_counts(mm.position_limits(rows, held, _LIMIT, "value"))


@query(
    "position_limits",
    f"""WITH {_SNAPSHOT}
        SELECT ContractId, SnapTime, Position, round(PositionDollars, 4) AS PositionDollars,
               PositionDollars < {_LIMIT} AS BuyOrder, PositionDollars > -{_LIMIT} AS SellOrder,
               CAST((PositionDollars < {_LIMIT})::INT + (PositionDollars > -{_LIMIT})::INT AS BIGINT) AS NumNewOrders
        FROM lim""",
)
def position_limits(t):
    rows = _limits(t)
    return rows.select(
        "ContractId", "SnapTime", "Position", F.round("PositionDollars", 4).alias("PositionDollars"), "BuyOrder", "SellOrder", "NumNewOrders"
    )


_INTENTS = f"""
    SELECT {{keys}}, 'SELL' AS Action, 'LIMIT' AS OrderType, 100.0::DOUBLE AS TotalQuantity, round(PredHigh, 2) AS LmtPrice
    FROM {{source}} WHERE PositionDollars > -{_LIMIT}
    UNION ALL
    SELECT {{keys}}, 'BUY', 'LIMIT', 100.0::DOUBLE, round(PredLow, 2) FROM {{source}} WHERE PositionDollars < {_LIMIT}
"""


@query("order_intents", f"WITH {_SNAPSHOT} " + _INTENTS.format(keys="ContractId, SnapTime", source="lim"))
def order_intents(t):
    return mm.order_intents(_limits(t), ("ContractId", "SnapTime"))


@query(
    "open_intents",
    f"""WITH {_SNAPSHOT}, newest AS (SELECT *, row_number() OVER (PARTITION BY ContractId ORDER BY SnapTime DESC) AS k FROM lim) """
    + _INTENTS.format(keys="ContractId, SnapTime", source="(SELECT * FROM newest WHERE k = 1)"),
)
def open_intents(t):
    return mm.open_intents(_limits(t))


@query(
    "trades_since_start",
    """
    WITH f AS (SELECT user_id, min(ts) AS TimestampFirst FROM events WHERE event_type = 'purchase' GROUP BY 1)
    SELECT e.event_id, e.ts, e.user_id, e.Side, e.value AS Price, f.TimestampFirst FROM (
      SELECT *, CASE WHEN event_id % 2 = 0 THEN 'BOT' ELSE 'SLD' END AS Side FROM events) e
    JOIN f ON e.user_id = f.user_id WHERE e.ts >= f.TimestampFirst
    """,
)
def trades_since_start(t):
    starts = mm.first_times(t.events.filter("event_type = 'purchase'"), "user_id", "ts")
    trades = t.events.selectExpr(
        "event_id", "ts", "user_id", "CASE WHEN event_id % 2 = 0 THEN 'BOT' ELSE 'SLD' END AS Side", "value AS Price"
    )
    since = mm.executions_since_start(trades, starts, "user_id", "ts")
    return mm.buys(since).unionByName(mm.sells(since))


# Daily returns of each user against the daily returns of user 1.
_RETURNS = f"""
    {_DAILY.format(key="user_id")},
    r AS (SELECT *, (c - lag(c) OVER w) / nullif(lag(c) OVER w, 0) AS ret FROM daily WINDOW w AS (PARTITION BY user_id ORDER BY day)),
    rb AS (SELECT r.*, b.ret AS bret FROM r LEFT JOIN (SELECT day, ret FROM r WHERE user_id = 1) b ON r.day = b.day),
    betas AS (SELECT user_id, regr_slope(ret, bret) AS Beta, regr_intercept(ret, bret) AS Intercept, regr_r2(ret, bret) AS R2
              FROM rb GROUP BY 1)
"""


def _returns(t):
    # A key has one row per day, so no key is large.
    rows = returns(_daily(t, "user_id"), "Close", "user_id", "Timestamp", split_rows=None)
    return beta.with_benchmark(rows, beta.benchmark_rows(rows, 1, "user_id"), validate=False)


@query(
    "benchmark_returns",
    f"WITH {_RETURNS} SELECT user_id, day AS Timestamp, round(ret, 6) AS \"Return\", round(bret, 6) AS BenchmarkReturn FROM rb",
)
def benchmark_returns(t):
    out = _returns(t).select("user_id", "Timestamp", "Return", "BenchmarkReturn")
    return rounded(out, "Return", "BenchmarkReturn")


@query(
    "beta_regression",
    f"WITH {_RETURNS} SELECT user_id, round(Beta, 6) AS Beta, round(Intercept, 6) AS Intercept, round(R2, 6) AS R2 FROM betas",
)
def beta_regression(t):
    return rounded(beta.regress(_returns(t), "user_id"), "Beta", "Intercept", "R2")


# Customers are positions: each holds shares of one user's series.
_POSITIONS = f"""
    {_RETURNS},
    px AS (SELECT user_id, arg_max(value, (ts, event_id)) AS Price FROM events GROUP BY 1),
    pos AS (SELECT c_custkey AS ContractId, c_custkey % (SELECT max(user_id) + 1 FROM events) AS user_id, c_acctbal AS Position, 100.0::DOUBLE AS AvgCost FROM customer),
    pb AS (SELECT pos.*, Price, Beta, R2, Position * Price AS PosValue, Position * Price - AvgCost * Position AS PNL,
                  Beta * Position * Price AS BetaValue
           FROM pos LEFT JOIN px USING (user_id) LEFT JOIN betas USING (user_id))
"""


def _positions(t):
    prices = last_by(t.events, "user_id", ["ts", "event_id"]).select("user_id", F.col("value").alias("Price"))
    users = t.events.agg(F.max("user_id") + 1).scalar()
    held = t.customer.select(
        F.col("c_custkey").alias("ContractId"), (F.col("c_custkey") % users).alias("user_id"), F.col("c_acctbal").alias("Position"), F.lit(100.0).alias("AvgCost")
    )
    betas = beta.regress(_returns(t), "user_id")
    return beta.positions_with_beta(held, prices, betas, "user_id", "user_id", validate=False), prices


@query(
    "positions_with_beta",
    f"""WITH {_POSITIONS} SELECT ContractId, user_id, Position, Price, AvgCost, round(PosValue, 4) AS PosValue,
        round(PNL, 4) AS PNL, round(Beta, 6) AS Beta, round(R2, 6) AS R2, round(BetaValue, 4) AS BetaValue FROM pb""",
)
def positions_with_beta(t):
    out, _ = _positions(t)
    out = out.withColumns({c: F.round(c, 4) for c in ("PosValue", "PNL", "BetaValue")})
    return rounded(out, "Beta", "R2")


_HEDGE = f"""
    {_POSITIONS},
    tot AS (SELECT sum(PosValue) AS PosValue, sum(BetaValue) AS BetaValue,
                   sum(CASE WHEN R2 > 0.2 THEN BetaValue ELSE 0 END) AS BetaValueForHedge FROM pb),
    h AS (SELECT tot.*, Price AS BenchmarkPrice, -CAST(floor(BetaValueForHedge / Price + 0.5) AS BIGINT) AS HedgeShares
          FROM tot, (SELECT Price FROM px WHERE user_id = 1))
"""


def _hedge(t):
    positions, prices = _positions(t)
    return beta.hedge(positions, prices.filter("user_id = 1"))


@query(
    "hedge",
    f"""WITH {_HEDGE} SELECT round(PosValue, 2) AS PortfolioValue, round(BetaValue / PosValue, 6) AS PortfolioBeta,
        round(BetaValue, 2) AS BetaValue, round(BetaValueForHedge, 2) AS BetaValueForHedge, HedgeShares,
        round(HedgeShares * BenchmarkPrice, 2) AS HedgeCost, BenchmarkPrice FROM h""",
)
def hedge(t):
    out = _hedge(t)
    out = out.withColumns({c: F.round(c, 2) for c in ("PortfolioValue", "BetaValue", "BetaValueForHedge", "HedgeCost")})
    return rounded(out, "PortfolioBeta")


@query(
    "hedge_intent",
    f"""WITH {_HEDGE} SELECT CASE WHEN HedgeShares > 0 THEN 'BUY' ELSE 'SELL' END AS Action, 'LIMIT' AS OrderType,
        HedgeShares AS TotalQuantity, round(BenchmarkPrice + CASE WHEN HedgeShares > 0 THEN 0.05 ELSE -0.05 END, 6) AS LmtPrice
        FROM h""",
)
def hedge_intent(t):
    return rounded(beta.hedge_intent(_hedge(t)), "LmtPrice")


# Parts are option contracts on one of 25 underlyings; lineitems are positions in them.
_CONTRACT = """
    p_partkey AS ContractId, CASE WHEN p_size % 5 = 0 THEN 'STK' ELSE 'OPT' END AS SecType, p_brand AS Symbol,
    CASE WHEN p_size % 5 = 0 THEN NULL
         ELSE '2025' || lpad(CAST(1 + p_size % 12 AS {text}), 2, '0') || lpad(CAST(1 + p_size % 28 AS {text}), 2, '0') END AS Expiry,
    p_retailprice AS Strike, CASE WHEN p_partkey % 2 = 0 THEN 'C' ELSE 'P' END AS "Right",
    CASE WHEN p_size % 5 = 0 THEN 1.0 ELSE 100.0 END AS Multiplier
"""
_CONTRACT_COLUMNS = ("ContractId", "SecType", "Symbol", "Expiry", "Strike", "Right", "Multiplier")
ASOF = datetime(2024, 6, 28, 12)


def _cnd(d: str) -> str:
    k = f"(1.0 / (1.0 + {pricing.CND_GAMMA} * abs({d})))"
    series = "0.0"
    for a in reversed(pricing.CND_COEFFICIENTS):
        series = f"({k} * ({a!r} + {series}))"
    tail = f"({pricing.CND_RSQRT2PI!r}::DOUBLE * exp(-0.5 * {d} * {d}) * {series})"
    return f"(CASE WHEN {d} > 0 THEN 1.0 - {tail} ELSE {tail} END)"


def _theo(price: str, prefix: str) -> str:
    """CTE body columns for the price under ``price``: d1 and d2 first, then the value."""
    return f"""CASE WHEN IsStock THEN {price} WHEN IsCall THEN {price} * {_cnd(prefix + 'd1')} - Strike * exp(-0.04 * T) * {_cnd(prefix + 'd2')}
        ELSE Strike * exp(-0.04 * T) * (1.0 - {_cnd(prefix + 'd2')}) - {price} * (1.0 - {_cnd(prefix + 'd1')}) END"""


def _d1(price: str) -> str:
    return f"((ln(CASE WHEN {price} / Strike > 0 THEN {price} / Strike END) + (0.04 + 0.5 * Vol * Vol) * T) / (Vol * sqrt(T)))"


def _option_sql(positions: str) -> str:
    contract = _CONTRACT.format(text="VARCHAR")
    return f"""
    contracts AS (SELECT {contract} FROM part),
    pos AS ({positions}),
    vols AS (SELECT event_id % (SELECT max(p_partkey) + 1 FROM part) AS ContractId, arg_max(0.1 + value / 1000, (ts, event_id)) AS Vol FROM events
             WHERE event_type = 'view' GROUP BY 1),
    und AS (SELECT 'Brand#' || (1 + user_id % 25) AS Symbol, arg_max(900 + value, (ts, event_id)) AS UPrice FROM events
            WHERE event_type = 'click' GROUP BY 1),
    j AS (SELECT pos.*, Vol, UPrice,
                 (epoch_us(timezone('UTC', timezone('US/Eastern', strptime(Expiry, '%Y%m%d') + INTERVAL 14 HOUR)))
                  - epoch_us(TIMESTAMP '2024-06-28 12:00:00')) / (365.0 * 86400 * 1e6) AS T,
                 "Right" = 'C' AS IsCall, SecType = 'STK' AS IsStock
          FROM pos LEFT JOIN vols USING (ContractId) JOIN und USING (Symbol)),
    s AS (SELECT *, (1.0 + Scenario) * UPrice AS US FROM (
            SELECT *, unnest({[float(x) for x in pricing.SHOCKS]}::DOUBLE[]) AS Scenario FROM j)),
    d AS (SELECT *, {_d1('UPrice')} AS b_d1, {_d1('US')} AS s_d1 FROM s),
    e AS (SELECT *, b_d1 - Vol * sqrt(T) AS b_d2, s_d1 - Vol * sqrt(T) AS s_d2 FROM d),
    priced AS (SELECT *, {_theo('UPrice', 'b_')} AS TheoBase, {_theo('US', 's_')} AS TheoScenario FROM e)
    """


def _contracts(t):
    return t.part.selectExpr(*_split(_CONTRACT.format(text="STRING").replace('"Right"', "`Right`")))


def _split(columns: str) -> list[str]:
    """Top-level comma-separated SQL columns, split after each alias."""
    out, part = [], ""
    for piece in columns.split(","):
        part = f"{part},{piece}" if part else piece
        if part.count("(") == part.count(")") and " AS " in part and part.count("CASE") == part.count(" END"):
            out.append(part.strip())
            part = ""
    return out


def _vol_ticks(t):
    contract = (F.col("event_id") % t.part.agg(F.max("p_partkey") + 1).scalar()).alias("ContractId")
    return t.events.select(contract, F.col("event_type").alias("TickType"), F.expr("0.1D + value / 1000").alias("Value"), "ts", "event_id")


def _market(t):
    vols = risk.last_vols(_vol_ticks(t), ["ts", "event_id"], "view")
    quotes = t.events.filter("event_type = 'click'").selectExpr(
        "user_id % 25 AS ContractId", "'STK' AS SecType", "'Brand#' || (1 + user_id % 25) AS Symbol",
        "899 + value AS BidPrice", "901 + value AS AskPrice", "ts", "event_id",
    )
    return vols, risk.last_underlying_prices(quotes, ["ts", "event_id"])


@query(
    "option_scenarios",
    f"""WITH {_option_sql('SELECT * FROM contracts')}
        SELECT ContractId, Scenario, round(UPrice, 6) AS UPrice, round(T, 6) AS T, round(TheoBase, 6) AS TheoBase,
               round(TheoScenario, 6) AS TheoScenario, round(TheoScenario - TheoBase, 6) AS TheoChange FROM priced""",
)
def option_scenarios(t):
    out = risk.scenarios(_contracts(t), *_market(t), ASOF, validate=False).select(
        "ContractId", "Scenario", "UPrice", "T", "TheoBase", "TheoScenario", "TheoChange"
    )
    return rounded(out, "UPrice", "T", "TheoBase", "TheoScenario", "TheoChange")


_HELD = """SELECT c.*, l_returnflag AS Account, l_quantity AS Position FROM lineitem JOIN contracts c ON l_partkey = ContractId"""


def _held(t):
    held = t.lineitem.selectExpr("l_partkey AS ContractId", "l_returnflag AS Account", "l_quantity AS Position")
    return natural_join(held, _contracts(t), "ContractId")


@query(
    "net_positions",
    f"""WITH contracts AS (SELECT {_CONTRACT.format(text="VARCHAR")} FROM part), pos AS ({_HELD})
        SELECT ContractId, SecType, Symbol, Expiry, Strike, "Right", Multiplier, sum(Position) AS Position FROM pos GROUP BY ALL""",
)
def net_positions(t):
    return risk.net_positions(_held(t), _CONTRACT_COLUMNS)


@query(
    "account_risk",
    f"""WITH {_option_sql(_HELD)}
        SELECT Account, Symbol, Scenario, round(sum(Position * Multiplier * (TheoScenario - TheoBase)), 2) AS Risk
        FROM priced GROUP BY 1, 2, 3""",
)
def account_risk(t):
    keys = ("Account", "Symbol", "Scenario")
    contract = tuple(c for c in _CONTRACT_COLUMNS if c != "Symbol")
    out = risk.account_risk(_held(t), *_market(t), ASOF, contract, keys, validate=False)
    return out.withColumn("Risk", F.round("Risk", 2))


@query(
    "scenario_risk",
    f"""WITH {_option_sql(_HELD)}
        SELECT Account, Scenario, round(sum(Position * Multiplier * (TheoScenario - TheoBase)), 2) AS Risk
        FROM priced GROUP BY 1, 2""",
)
def scenario_risk(t):
    # Summed per account and contract before the contract's columns are joined.
    held = sum_by(t.lineitem.selectExpr("l_partkey AS ContractId", "l_returnflag AS Account", "l_quantity AS Position"), ["ContractId", "Account"])
    held = natural_join(held, _contracts(t), "ContractId")
    out = risk.scenario_risk(risk.scenarios(held, *_market(t), ASOF, validate=False))
    return out.withColumn("Risk", F.round("Risk", 2))


@query(
    "last_underlying_and_vol",
    """
    SELECT event_id % (SELECT max(p_partkey) + 1 FROM part) AS ContractId, round(arg_max(0.1 + value / 1000, (ts, event_id)), 6) AS Vol FROM events
    WHERE event_type = 'view' GROUP BY 1
    """,
)
def last_underlying_and_vol(t):
    return rounded(risk.last_vols(_vol_ticks(t), ["ts", "event_id"], "view").select("ContractId", "Vol"), "Vol")

