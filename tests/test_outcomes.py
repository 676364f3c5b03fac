from pyspark.sql import functions as F

from marketframe.operators import outcomes as out
from marketframe.sources.error_codes import ADDITIONAL_CODES, error_code_dim


def codes(spark):
    rows = [(200, "No security definition", "n"), (0, "from the table", None)]
    early = spark.createDataFrame(rows, "Code int, Message string, Note string")
    late = spark.createDataFrame([(200, "late text", None)], "Code int, Message string, Note string")
    other = spark.createDataFrame([(1, "x")], "Code int, Text string")
    return error_code_dim(spark, [early, other, late], additions={502: "no connection", 200: "unused"})


def test_error_codes(spark):
    dim = {r.ErrorCode: (r.Message, r.Note) for r in codes(spark).collect()}
    assert dim[200] == ("late text", "") and dim[0] == ("from the table", "")
    assert dim[502] == ("no connection", "") and dim[504] == (ADDITIONAL_CODES[504], "")
    assert len(dim) == len(ADDITIONAL_CODES) + 1


def test_errors_are_described(spark, values):
    rows = [(1, 200, "a", 1), (None, 999, "first", 2), (2, 999, "second", 3), (3, 504, None, 4)]
    errors = spark.createDataFrame(rows, "RequestId long, ErrorCode long, Error string, Seq long")
    got = values(out.enrich_errors(errors, codes(spark), "Seq"), "Seq", "RequestId", "ErrorDescription", "Note")
    assert got == [
        (1, 1, "late text", None),
        (2, None, "first", None),
        (3, 2, "first", None),
        (4, 3, "Not connected", None),
    ]


def contract_frames(spark):
    requests = spark.createDataFrame(
        [(1, "one"), (2, "two"), (3, "err"), (4, "none"), (5, "both")], "RequestId long, Contract string"
    )
    details = spark.createDataFrame(
        [(1, "one", 11), (2, "two-a", 21), (2, "two-b", 22), (5, "both", 51)], "RequestId long, Own string, Id int"
    )
    errors = spark.createDataFrame(
        [(3, "a"), (3, "b"), (5, "c"), (99, "not ours")], "RequestId long, Error string"
    )
    return requests, out.contract_entries(requests, details, errors, "Contract", "Own")


def test_contract_resolution(spark, values):
    requests, entries = contract_frames(spark)
    got = values(out.resolve_contracts(requests, entries, "Contract"), "Contract", "Status", "DetailCount", "ErrorCount")
    assert got == [
        ("both", "conflict", 1, 1),
        ("err", "error", 0, 2),
        ("none", "missing", 0, 0),
        ("one", "resolved", 1, 0),
        ("two", "multi", 2, 0),
        ("two-a", "resolved", 1, 0),
        ("two-b", "resolved", 1, 0),
    ]


def test_contract_entries(spark, values):
    _, entries = contract_frames(spark)
    details = entries.filter("Kind = 'detail'").select("Contract", F.col("Detail.Id").alias("Id"))
    assert values(details) == [("both", 51), ("one", 11), ("two", 21), ("two", 22), ("two-a", 21), ("two-b", 22)]


def test_keys_to_request(spark, values):
    asked = spark.createDataFrame([(1,), (1,), (2,), (-3,), (None,)], "ContractId long")
    known = spark.createDataFrame([(2,)], "ContractId long")
    assert values(out.keys_to_request(asked, known, "ContractId")) == [(None,), (1,)]


def test_fan_out(spark, values):
    calls = spark.createDataFrame([(2, ["c"]), (1, ["a", "b"]), (3, [])], "n int, details array<string>")
    got = out.fan_out_requests(calls, "details", "MarketData", {"snapshot": F.lit(True)}, "n", F.col("n"), "n", first_id=10)
    assert values(got, "RequestId", "Detail", "Note") == [
        (10, "a", '{"snapshot":"true"}'),
        (11, "b", '{"snapshot":"true"}'),
        (12, "c", '{"snapshot":"true"}'),
    ]


def test_cancelled_requests_stop(spark, values):
    rows = spark.createDataFrame([(1, 1), (1, 5), (2, 9)], "RequestId long, ReceiveTime int")
    cancels = spark.createDataFrame([(1, 3), (1, 4)], "RequestId long, CancelTime int")
    assert values(out.active_only(rows, cancels)) == [(1, 1), (2, 9)]


def test_errors_are_joined_in_order(spark):
    rows = [("a", 2, "error", "req_id=2 x"), ("a", 1, "error", "req_id=1 z"), ("a", 1, "error", "req_id=1 y"), ("a", 1, "error", "req_id=1 y"), (None, 3, "error", "req_id=3 n"), ("b", 4, "detail", None)]
    entries = spark.createDataFrame(rows, "Contract string, RequestId long, Kind string, ErrorText string")
    got = {r.Contract: (r.ErrorCount, r.ErrorText) for r in out.joined_errors(entries, "Contract", 2).collect()}
    assert got == {"a": (4, "req_id=1 y|req_id=1 z"), None: (1, "req_id=3 n")}
    assert {r.ErrorText for r in out.joined_errors(entries, "Contract").collect()} == {"req_id=1 y|req_id=1 z|req_id=2 x", "req_id=3 n"}
