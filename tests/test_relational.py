import pytest
from pyspark.sql import functions as F

from marketframe.operators import relational as rel


@pytest.fixture
def left(spark):
    return spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, l string")


@pytest.fixture
def right(spark):
    return spark.createDataFrame([(1, "x", 10), (None, "n", 30), (9, "z", 90)], "k int, r string, q int")


def test_natural_join_keeps_each_left_row_once(left, right, values):
    got = values(rel.natural_join(left, right, "k"), "l", "r", "q")
    assert got == [("a", "x", 10), ("b", "x", 10), ("c", None, None), ("d", "n", 30)]


def test_natural_join_renames(left, right):
    assert rel.natural_join(left, right, ["k"], ["New=r"]).columns == ["k", "l", "New"]


def test_duplicate_right_keys_raise(left, right):
    with pytest.raises(Exception, match="Duplicate right keys"):
        rel.natural_join(left, right.union(right), "k").collect()


def test_column_clash_raises(left, right):
    with pytest.raises(ValueError, match="Duplicate column names: l"):
        rel.natural_join(left, right, "k", "l=r")


def test_keyless_join(left, right, values):
    one = right.filter("k = 1")
    assert values(rel.natural_join(left, one, [], "r"), "l", "r") == [(c, "x") for c in "abcd"]
    assert values(rel.natural_join(left, one.filter("false"), [], "r"), "l", "r") == [(c, None) for c in "abcd"]
    with pytest.raises(Exception, match="more than one row"):
        rel.natural_join(left, right, [], "r").collect()


def test_inner_join_multiplies(left, right, values):
    twice = right.union(right)
    assert values(rel.join(left, twice, "k", "r"), "l") == [("a",), ("a",), ("b",), ("b",)]


def test_last_and_first(spark, values):
    rows = [("a", 1, 1, "p"), ("a", 2, 2, "q"), ("a", 2, 3, "r"), ("b", None, 1, "s"), ("b", 0, 0, "t"), (None, 5, 5, "u")]
    df = spark.createDataFrame(rows, "k string, t int, s int, v string")
    assert values(rel.last_by(df, "k", ["t", "s"]), "v") == [("r",), ("t",), ("u",)]
    assert values(rel.first_by(df, "k", ["t", "s"]), "v") == [("p",), ("s",), ("u",)]
    assert rel.last_by(df, "k", ["t", "s"]).columns == df.columns
    agg = rel.last_by_agg(df, "k", ["t", "s"])
    assert values(agg, "v") == [("r",), ("t",), ("u",)] and agg.columns == df.columns


def test_last_by_is_limited_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS t")
    plan = rel.last_by(df, "k", "t")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_natural_join_stays_an_equi_join(left, right):
    plan = rel.natural_join(left, right, "k")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_update_sees_earlier_columns(spark):
    df = rel.update(spark.range(1), {"a": F.col("id") + 1, "b": F.col("a") * 2})
    assert tuple(df.first()) == (0, 1, 2)


def test_projection_helpers(left, values):
    assert rel.view(left, ["New=l", F.col("k").alias("key")]).columns == ["New", "key"]
    assert rel.view(left, {"x": F.col("k") + 1}).columns == ["x"]
    assert rel.move_up(left, "l").columns == ["l", "k"]
    assert rel.rename(left, "key=k").columns == ["key", "l"]
    assert values(rel.where(left, "k = 1", F.col("l") > "a"), "l") == [("b",)]
    assert values(rel.constituent(left, "k", 2), "l") == [("c",)]


def test_sums(spark, values):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 3, 4.0), ("b", 5, None)], "k string, i int, d double")
    assert values(rel.sum_by(df, "k")) == [("a", 4, 6.0), ("b", 5, None)]
    assert values(rel.sum_by(df.drop("k"))) == [(9, 6.0)]


def test_ungroup(spark, values):
    df = spark.createDataFrame([(1, [0.1, 0.2]), (2, [])], "k int, a array<double>")
    assert values(rel.ungroup(df, "a")) == [(1, 0.1), (1, 0.2)]


def test_checks(spark, left):
    assert rel.expect_min_rows(left, "left", 4) is left
    with pytest.raises(ValueError, match='"left" has 4 rows'):
        rel.expect_min_rows(left, "left", 5)
    with pytest.raises(ValueError, match="Duplicate column names: k"):
        rel.assert_unique_columns(spark.sql("SELECT 1 AS k, 2 AS k"))


def test_audit(spark, values):
    df = spark.createDataFrame([("1", "x"), ("y", None), (None, "2")], "a string, b string")
    got = values(rel.audit_types(df, {"a": "bigint", "b": "double"}))
    assert got == [("a", "bigint", 1), ("b", "double", 1)]


def test_new_keys(spark, values):
    seen = spark.createDataFrame([("26",)], "rule string")
    rules = spark.sql("SELECT explode(split('26,26,32', ',')) AS rule")
    assert values(rel.new_keys_only(rules, seen, "rule")) == [("32",)]


def test_top_rows_beyond_the_early_limit(spark):
    df = spark.range(5000).selectExpr("id % 2 AS k", "id AS t")
    for n in (3, 1500):
        got = rel.top_by(df, "k", [F.col("t").desc()], n)
        assert sorted(r.t for r in got.collect()) == list(range(5000 - 2 * n, 5000))
