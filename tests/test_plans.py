from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from marketframe.operators.snapshot import TimeGrid
from marketframe.plans import beta_hedge as beta
from marketframe.plans import market as m
from marketframe.plans import market_making as mm
from marketframe.plans import option_risk as risk
from marketframe.plans.pair_ratio import pair_ratio

START = datetime(2024, 1, 1)


def at(seconds):
    return START + timedelta(seconds=seconds)


@pytest.fixture
def ticks(spark):
    rows = [(1, 0, at(0), 10.0, 2.0), (1, 1, at(4), 12.0, 1.0), (1, 2, at(4), 11.0, 1.0), (1, 3, at(5), 9.0, 0.0), (2, 4, at(1), None, None)]
    return spark.createDataFrame(rows, "ContractId long, Seq long, Timestamp timestamp, Price double, Size double")


def test_bars(ticks):
    bars = {(r.ContractId, r.Timestamp): r for r in m.bars_from_ticks(ticks, m.BarSize.SEC_5, "ContractId").collect()}
    first, second = bars[1, at(0)], bars[1, at(5)]
    assert tuple(first)[2:] == (10.0, 12.0, 10.0, 11.0, 4.0, 3, pytest.approx((20 + 12 + 11) / 4))
    assert (second.Close, second.Volume, second.WAP, second.BarCount) == (9.0, None, None, 1)
    # Only rows with a price make a bar.
    assert (2, at(0)) not in bars


def test_bars_leave_out_rows_without_price(spark):
    rows = [(1, 0, at(0), 5.0, 2.0), (1, 1, at(1), None, 7.0), (1, None, at(0), 6.0, 1.0)]
    df = spark.createDataFrame(rows, "ContractId long, Seq long, Timestamp timestamp, Price double, Size double")
    bar = m.bars_from_ticks(df, m.BarSize.SEC_5, "ContractId").first()
    assert (bar.High, bar.Low, bar.Volume, bar.BarCount) == (6.0, 5.0, 3.0, 2) and {bar.Open, bar.Close} <= {5.0, 6.0}


def test_bar_sizes(spark):
    assert len(m.BarSize) == 21 and m.BarSize("2 hour").seconds == 7200 and m.BarSize("1W").seconds is None
    df = spark.createDataFrame([(datetime(2024, 2, 29, 13, 7, 8),)], "t timestamp")
    starts = {s: df.select(m.bar_start(F.col("t"), s)).first()[0] for s in m.BarSize}
    assert starts[m.BarSize.MIN_15] == datetime(2024, 2, 29, 13, 0)
    assert starts[m.BarSize.HOUR_8] == datetime(2024, 2, 29, 8)
    assert starts[m.BarSize.WEEK_1] == datetime(2024, 2, 26)
    assert starts[m.BarSize.MONTH_1] == datetime(2024, 2, 1)


def test_realtime_bars(ticks):
    bars = m.bars_realtime(ticks, "ContractId").filter("ContractId = 1").orderBy("Timestamp").collect()
    assert [(b.TimestampEnd, b.Count) for b in bars] == [(at(5), 3), (at(10), 1)]
    with pytest.raises(ValueError, match="Unsupported bar type"):
        m.bars_realtime(ticks, "ContractId", "YIELD_BID")
    with pytest.raises(ValueError, match="Unsupported bar size"):
        m.bars_realtime(ticks, "ContractId", size_seconds=7)


def test_price_bases(spark):
    quotes = spark.sql("SELECT 1D AS BidPrice, 3D AS AskPrice, 9D AS Price")
    picked = [quotes.select(m.basis_price(quotes, b)).first()[0] for b in ("TRADES", "AGGTRADES", "MIDPOINT", "BID", "ASK")]
    assert picked == [9.0, 9.0, 2.0, 1.0, 3.0]
    for basis in ("FEE_RATE", "NONSENSE"):
        with pytest.raises(ValueError):
            m.basis_price(quotes, basis)


@pytest.mark.parametrize("text, first", [("3 S", 27), ("1 D", 0)])
def test_durations(spark, text, first):
    df = spark.createDataFrame([(at(i),) for i in range(40)], "t timestamp")
    got = [r.t for r in m.in_duration(df, "t", text, at(30)).collect()]
    assert min(got) == at(first + 1 if text == "3 S" else 0) and max(got) == at(30)
    assert [m.duration_interval(f"2 {u}") for u in "SDWMY"] == [f"INTERVAL 2 {u}" for u in ("SECOND", "DAY", "WEEK", "MONTH", "YEAR")]


def test_range_is_pushed_to_the_scan(spark, tmp_path):
    spark.createDataFrame([(at(i),) for i in range(4)], "t timestamp").write.parquet(str(tmp_path / "t"))
    df = m.in_duration(spark.read.parquet(str(tmp_path / "t")), "t", "1 D", at(3))
    assert "GreaterThan(t" in df._jdf.queryExecution().executedPlan().toString()


def test_tick_history(ticks, values):
    def seqs(**kw):
        return [s for (s,) in values(m.tick_history(ticks, 2, "ContractId", **kw).filter("ContractId = 1"), "Seq")]

    assert seqs(start=at(0)) == [1, 2]
    assert seqs(end=at(5)) == [2, 3]
    with pytest.raises(ValueError, match="Unsupported tick data type"):
        seqs(start=at(0), tick_type="BidAsk")
    with pytest.raises(ValueError, match="either"):
        seqs()


def test_generic_ticks():
    assert m.GENERIC_TICK_TYPES["SHORTABLE"] == m.GENERIC_TICK_TYPES["SHORTABLE_SHARES"] == 236
    assert len(m.GENERIC_TICK_TYPES) == 29 and len(m.ACCOUNT_SUMMARY_TAGS) == 31


def test_regular_hours(spark, values):
    rows = [(1, datetime(2024, 1, 2, h, 0)) for h in (14, 15, 20, 21)] + [(1, datetime(2024, 1, 6, 15)), (2, datetime(2024, 1, 2, 15))]
    df = spark.createDataFrame(rows, "ContractId int, Timestamp timestamp")
    periods = ["20240102:0930-20240102:1600", "20240106:CLOSED", "20240107:1800-20240108:1700"]
    hours = spark.createDataFrame([(1, periods, "US/Eastern")], "ContractId int, LiquidHours array<string>, TimeZoneId string")
    assert values(m.regular_hours_only(df, hours), "Timestamp") == [(datetime(2024, 1, 2, 15),), (datetime(2024, 1, 2, 20),)]
    assert m.for_market_data_type(df, hours).count() == 2 and m.for_market_data_type(df, hours, "REAL_TIME") is df
    with pytest.raises(ValueError, match="Unknown market data type"):
        m.for_market_data_type(df, hours, "SOMETIMES")
    overnight = spark.createDataFrame([(1, datetime(2024, 1, 8, 5))], "ContractId int, Timestamp timestamp")
    assert m.regular_hours_only(overnight, hours).count() == 1


def test_news(spark, values):
    rows = [(1, at(i), "P" if i % 2 else "Q", str(i)) for i in range(6)]
    news = spark.createDataFrame(rows, "ContractId int, Timestamp timestamp, ProviderCode string, ArticleId string")
    assert values(m.news_history(news, at(1), at(4), total_results=2), "ArticleId") == [("3",), ("4",)]
    assert values(m.news_history(news, at(0), at(5), ["P"]), "ArticleId") == [("1",), ("3",), ("5",)]
    assert values(m.news_article(news, "P", "3"), "ArticleId") == [("3",)]


def test_search_and_accounts(spark, values):
    contracts = spark.createDataFrame([("AMD", "Advanced Micro"), ("GOOG", "Alphabet"), ("X", None)], "Symbol string, LongName string")
    got = values(m.contract_search(contracts, ["am", "ALPHA", "zz"], ["Symbol", "LongName"]), "Symbol", "Pattern")
    assert got == [("AMD", "am"), ("GOOG", "ALPHA")]
    rows = spark.createDataFrame([("A", "m", 1), ("B", "n", 2)], "Account string, ModelCode string, v int")
    assert values(m.for_account(rows, "All"), "v") == [(1,), (2,)]
    assert values(m.for_account(rows, "All", "n"), "v") == [(2,)]
    assert values(m.for_account(rows, "A", ""), "v") == [(1,)]


def test_pair_ratio(spark, values):
    rows = [("DIA", at(i), at(i + 5), float(10 + i)) for i in (0, 5)] + [("SPY", at(0), at(5), 4.0), ("SPY", at(9), at(14), 0.0)]
    bars = spark.createDataFrame(rows, "Symbol string, Timestamp timestamp, TimestampEnd timestamp, Close double")
    out = pair_ratio(bars, "DIA", "SPY", names=("Dia", "Spy"))
    assert values(out, "Dia", "Spy", "Ratio") == [(10.0, 4.0, 2.5), (15.0, None, None)]


def test_market_making(spark, values):
    rows = [("G", 1, at(60 * i), i, 99.0 + i, 101.0 + i) for i in range(6)]
    quotes = spark.createDataFrame(rows, "Symbol string, ContractId long, Timestamp timestamp, Seq long, BidPrice double, AskPrice double")
    preds = mm.with_first_time(mm.predictions(mm.mid_prices(quotes)))
    row = preds.filter("Seq = 5").first()
    assert row.PredLow == pytest.approx(row.PredPrice - row.PredSD) and row.PredHigh == pytest.approx(row.PredPrice + row.PredSD)
    grid = TimeGrid(at(0), at(300), timedelta(minutes=1))
    snaps = mm.after_burn_in(mm.latest_snapshot(preds, grid, history=True))
    assert values(snaps, "Seq") == [(3,), (4,), (5,)]  # later than two minutes after the first row
    positions = spark.createDataFrame([(1, 500.0)], "ContractId long, Position double")
    limits = mm.order_counts(mm.position_limits(snaps, positions))
    assert values(limits, "BuyOrder", "SellOrder", "NumNewOrders")[0] == (False, True, 1)
    flat = mm.position_limits(snaps, positions.filter("false"))
    intents = mm.open_intents(flat)
    assert values(intents, "Action", "TotalQuantity") == [("BUY", 100.0), ("SELL", 100.0)]
    assert values(intents, "SnapTime") == [(at(300),), (at(300),)]
    executions = spark.createDataFrame(
        [("G", at(-1), "BOT"), ("G", at(1), "BOT"), ("G", at(2), "SLD"), ("H", at(3), "BOT")], "Symbol string, Timestamp timestamp, Side string"
    )
    trades = mm.executions_since_start(executions, mm.first_times(quotes))
    assert mm.buys(trades).count() == 1 and mm.sells(trades).count() == 1
    assert values(mm.first_rows(quotes), "Seq") == [(0,)]


def test_beta_and_hedge(spark, values):
    bench = [0.01, -0.02, 0.03, 0.005]
    rows = [("SPY", at(i), r) for i, r in enumerate(bench)] + [("A", at(i), 2 * r + 0.001) for i, r in enumerate(bench)] + [("A", at(9), 0.5), ("B", at(0), None)]
    returns = spark.createDataFrame(rows, "Symbol string, Timestamp timestamp, Return double")
    joined = beta.with_benchmark(returns, beta.benchmark_rows(returns, "SPY"))
    betas = beta.regress(joined)
    a = betas.filter("Symbol = 'A'").first()
    assert (a.Beta, a.Intercept, a.R2) == (pytest.approx(2), pytest.approx(0.001), pytest.approx(1))
    assert betas.filter("Symbol = 'B'").first().Beta is None
    held = spark.createDataFrame([("A", 1, 10.0, 5.0), ("B", 2, 3.0, 1.0)], "Symbol string, ContractId int, Position double, AvgCost double")
    prices = spark.createDataFrame([(1, 20.0), (2, 10.0), (3, 33.0)], "ContractId int, Price double")
    positions = beta.positions_with_beta(held, prices, betas)
    assert values(positions, "PosValue", "PNL") == [(200.0, 150.0), (30.0, 27.0)]
    out = beta.hedge(positions, prices.filter("ContractId = 3"))
    row = out.first()
    assert row.PortfolioValue == 230.0 and row.BetaValueForHedge == pytest.approx(400.0)
    assert row.HedgeShares == -12 and row.HedgeCost == pytest.approx(-12 * 33.0)
    order = beta.hedge_intent(out).first()
    assert (order.Action, order.LmtPrice) == ("SELL", pytest.approx(32.95))


def test_option_risk(spark, values):
    contract = "ContractId long, SecType string, Symbol string, LocalSymbol string, Expiry string, Strike double, Right string, Multiplier double, Currency string"
    rows = [
        ("acc", 1, "STK", "SPY", "SPY", None, None, None, 1.0, "USD", 10.0),
        ("acc", 2, "OPT", "SPY", "SPY C", "20250117", 100.0, "C", 100.0, "USD", 2.0),
        ("acc", 2, "OPT", "SPY", "SPY C", "20250117", 100.0, "C", 100.0, "USD", -1.0),
        ("oth", 3, "OPT", "SPY", "SPY P", "20250117", 100.0, "P", 100.0, "USD", 1.0),
    ]
    positions = spark.createDataFrame(rows, f"Account string, {contract}, Position double")
    generic = spark.createDataFrame([(2, "OPTION_IMPLIED_VOL", 0.2, 1), (2, "OPTION_IMPLIED_VOL", 0.3, 2), (2, "OTHER", 9.0, 3)], "ContractId long, TickType string, Value double, Seq long")
    quotes = spark.createDataFrame([(1, "STK", "SPY", 99.0, 101.0, 1), (7, "OPT", "SPY", 1.0, 2.0, 2)], "ContractId long, SecType string, Symbol string, BidPrice double, AskPrice double, Seq long")
    vols, last = risk.last_vols(generic, "Seq"), risk.last_underlying_prices(quotes, "Seq")
    assert values(vols, "Vol") == [(0.3,)]
    priced = risk.scenarios(positions, vols, last, datetime(2024, 1, 1))
    assert priced.count() == 4 * 13
    flat = priced.filter("Scenario = 0").select("SecType", "TheoChange", "Right")
    assert values(flat.filter("SecType = 'STK'"), "TheoChange") == [(0.0,)]
    assert values(flat.filter("`Right` = 'P'"), "TheoChange") == [(None,)]  # no volatility, no price
    by_rows = {(r.Account, r.Scenario): r.Risk for r in risk.scenario_risk(priced).collect()}
    direct = {(r.Account, r.Scenario): r.Risk for r in risk.account_risk(positions, vols, last, datetime(2024, 1, 1)).collect()}
    assert by_rows.keys() == direct.keys() and len(direct) == 26
    for key, value in by_rows.items():
        assert direct[key] == (None if value is None else pytest.approx(value, rel=1e-9, abs=1e-9))
    assert direct["acc", 0.2] > 200 and direct["acc", -0.2] < -200
    net = risk.net_positions(positions)
    assert values(net, "ContractId", "Position") == [(1, 10.0), (2, 1.0), (3, 1.0)]
