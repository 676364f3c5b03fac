import pytest

from marketframe.schemas import raw_schema
from marketframe.sources import documents, rawlog, short_rates

HEADER = "#SYM|CUR|NAME|CON|REBATERATE|FEERATE|AVAILABLE|"


def write(folder, name, lines):
    (folder / name).write_text("\n".join(lines) + "\n")


def test_short_rates(spark, tmp_path, values):
    write(tmp_path, "usa.txt", ["#BOF|2024.01.01", HEADER, "A|USD|A &amp; B|1|0.5|0.25|100|", "B|USD|Bee|2||NA|>10|", "#EOF|2"])
    write(tmp_path, "germany.txt", ["#BOF|2024.01.01", HEADER, "C|EUR|Cee|3|1.5|1|7|", "#EOF|1"])
    df = short_rates.read_short_rates(spark, str(tmp_path))
    assert df.columns == ["Source", "Sym", "Currency", "Name", "Contract", "RebateRate", "FeeRate", "Available"]
    kinds = dict(df.dtypes)
    assert (kinds["Contract"], kinds["RebateRate"], kinds["FeeRate"], kinds["Available"]) == ("bigint", "double", "string", "string")
    assert values(df) == [
        ("germany", "C", "EUR", "Cee", 3, 1.5, "1", "7"),
        ("usa", "A", "USD", "A & B", 1, 0.5, "0.25", "100"),
        ("usa", "B", "USD", "Bee", 2, None, "NA", ">10"),
    ]
    given = short_rates.read_short_rates(spark, str(tmp_path), {"FEERATE": "double"})
    assert values(given, "Sym", "FeeRate") == [("A", 0.25), ("B", None), ("C", 1.0)]


def test_short_rates_headers_must_agree(spark, tmp_path):
    write(tmp_path, "usa.txt", [HEADER, "A|USD|A|1|0.5|0.25|100|"])
    write(tmp_path, "other.txt", ["#SYM|CUR|", "A|USD|"])
    with pytest.raises(ValueError, match="Mismatched headers"):
        short_rates.read_short_rates(spark, str(tmp_path))


def xml(spark, text):
    return spark.createDataFrame([(text,)], "xml string")


GROUPS = (
    "<ListOfGroups><Group><name>g</name><defaultMethod>m</defaultMethod><ListOfAccts><Account><acct>A</acct></Account>"
    "<Account><acct>B</acct></Account></ListOfAccts></Group></ListOfGroups>"
)


def test_xml_groups(spark, values):
    assert values(documents.explode_groups(xml(spark, GROUPS))) == [("g", "m", "A"), ("g", "m", "B")]
    assert values(documents.explode_groups(xml(spark, '<?xml version="1.0"?>\n' + GROUPS))) == [("g", "m", "A"), ("g", "m", "B")]


def test_xml_profiles(spark, values):
    text = (
        "<ListOfAllocationProfiles><AllocationProfile><name>p</name><type>2</type><ListOfAllocations><Allocation>"
        "<acct>A</acct><amount>1.5</amount></Allocation></ListOfAllocations></AllocationProfile></ListOfAllocationProfiles>"
    )
    assert values(documents.explode_profiles(xml(spark, text))) == [("p", "Financial Ratios", "A", 1.5)]


def test_xml_aliases(spark, values):
    text = "<ListOfAccountAliases><AccountAlias><account>A</account><alias>Main</alias></AccountAlias></ListOfAccountAliases>"
    assert values(documents.explode_aliases(xml(spark, text))) == [("A", "Main")]


@pytest.mark.parametrize("explode", [documents.explode_profiles, documents.explode_aliases])
def test_wrong_root_tag_is_an_error(spark, explode):
    with pytest.raises(Exception, match="Unexpected XML tag: ListOfGroups"):
        explode(xml(spark, GROUPS)).collect()


def test_lists(spark, values):
    df = spark.createDataFrame([("A,,B,A",)], "accounts string")
    assert values(documents.explode_list(df, "accounts", name="Account")) == [("A",), ("B",)]


def test_raw_round_trip(spark, tmp_path, values):
    schema = raw_schema("ticks_string")
    rows = spark.sql("SELECT timestamp'2024-01-01' AS ReceiveTime, 1L AS RequestId, '' AS TickType, 'v' AS Value, 7L AS Seq")
    rawlog.append_raw(rows, str(tmp_path / "t"))
    rawlog.append_raw(rows, str(tmp_path / "t"))
    back = rawlog.read_raw(spark, "ticks_string", str(tmp_path / "t"))
    assert back.schema.names == schema.names
    assert values(back, "RequestId", "TickType", "Value", "Seq") == [(1, None, "v", 7)] * 2
    assert rawlog.read_raw(spark, "ticks_string", str(tmp_path / "t"), stream=True).isStreaming


def test_csv_source(spark, tmp_path, values):
    (tmp_path / "t.csv").write_text("ReceiveTime,RequestId,TickType,Size,Seq\n2024-01-01 00:00:00,5,BID,2.5,1\n")
    df = rawlog.read_raw(spark, "ticks_size", str(tmp_path / "t.csv"), "csv", header=True)
    assert values(df, "RequestId", "TickType", "Size") == [(5, "BID", 2.5)]


def test_messages(spark, values):
    df = spark.sql(
        """SELECT '{"RequestId": 3, "TickType": "ASK", "Size": 1.5}' AS value, timestamp'2024-01-01' AS timestamp, 42L AS offset"""
    )
    rows = rawlog.parse_messages(df, raw_schema("ticks_size", seq=False))
    assert values(rows, "RequestId", "TickType", "Size", "Seq") == [(3, "ASK", 1.5, 42)]
    assert rows.filter("ReceiveTime IS NULL").count() == 0


def test_receive_time_comes_first(spark):
    assert rawlog.with_receive_time(spark.range(1)).columns == ["ReceiveTime", "id"]


def test_views(spark):
    rawlog.register_views({"ticks": spark.range(3)}, rawlog.RAW_PREFIX)
    assert spark.sql("SELECT count(*) AS n FROM raw_ticks").first().n == 3


def test_tick_union(spark, values):
    live = spark.sql("SELECT 1L AS RequestId, 2D AS MidPoint")
    past = spark.sql("SELECT 5L AS RequestId, 3D AS Price")
    assert values(rawlog.unify_ticks(live, past, {"Price": "MidPoint"})) == [(1, 2.0), (5, 3.0)]


def test_every_raw_table_takes_messages(spark):
    """Rules name columns of their tables, and rows in declared types pass through them unchanged."""
    from marketframe.schemas import raw_schema, raw_tables
    from marketframe.sources.messages import RULES, normalize_message

    for table in raw_tables():
        schema = raw_schema(table)
        assert set(RULES.get(table, {})) <= set(schema.names), table
        empty = spark.createDataFrame([], schema)
        assert normalize_message(table, empty).dtypes == empty.dtypes, table


def test_message_rules(spark):
    from marketframe.sources.messages import normalize_message

    def one(table, schema, *values):
        return tuple(normalize_message(table, spark.createDataFrame([values], schema)).first())

    assert one("errors", "RequestId long, Error string", 2147483647, "") == (None, None)
    assert one("news_bulletins", "MsgType int, Message string", 2, "x") == ("EXCHANGE_AVAILABLE", "x")
    assert one("news_articles", "ArticleType int, ArticleText string", 0, "a &amp; b") == ("PlainTextOrHtml", "a & b")
    assert one("accounts_allocation_profiles", "Type string, Amount decimal(9,2)", "1", None) == ("Percentages", None)
    assert one("ticks_option_computation", "TickAttrib int, ImpliedVol double", 1, 0.5) == ("Price-based", 0.5)
    assert one("contracts_matching", "Right string, Multiplier string, DerivativeSecTypes string", "?", "", "OPT,WAR,OPT") == (None, 1.0, ["OPT", "WAR"])
    assert one("orders_completed", "Origin int, AlgoParams array<string>", 1, ["b", "a", "b"]) == ("Firm", ["a", "b"])
    zoned = one("orders_exec_details", "Timestamp string, Side string", "20240105 10:00:00", "BOT")
    assert zoned[1] == "BOT" and zoned[0] is not None
    assert one("bars_realtime", "Timestamp long, Volume double, Count long", 0, -1.0, 0)[1:] == (None, None)
    assert one("ticks_mid_point", "Timestamp long, MidPoint double", 0, 1.5)[1] == 1.5
    assert one("ticks_price", "Price double", 0.0) == (None,)
    again = normalize_message("orders_submitted", normalize_message("orders_submitted", spark.createDataFrame([(1,)], "Origin int")))
    assert again.first() == ("Firm",)
    with pytest.raises(ValueError):
        normalize_message("nothing", spark.range(1))
