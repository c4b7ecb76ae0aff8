"""NULL rules that differ between R and SQL."""

from pyspark.sql import functions as F

from haulkit.functions import nulls as N
from haulkit.operators.joins import common_columns, natural_join, null_safe_join
from tests.conftest import rows


def test_null_key_matches_null_key(spark):
    l = spark.createDataFrame([(1, "a"), (None, "b")], "k int, x string")
    r = spark.createDataFrame([(1, "A"), (None, "B")], "k int, y string")
    assert rows(null_safe_join(l, r, ["k"], "left")) == [(1, "a", "A"), (None, "b", "B")]
    # a plain `using` join drops the NULL match
    assert rows(l.join(r, "k", "left")) == [(1, "a", "A"), (None, "b", None)]


def test_right_and_full_keep_key_values(spark):
    l = spark.createDataFrame([(1, "a")], "k int, x string")
    r = spark.createDataFrame([(1, "A"), (2, "B")], "k int, y string")
    assert rows(null_safe_join(l, r, ["k"], "right")) == [(1, "a", "A"), (2, None, "B")]
    assert rows(null_safe_join(l, r, ["k"], "full")) == [(1, "a", "A"), (2, None, "B")]


def test_natural_join_uses_common_columns(spark):
    l = spark.createDataFrame([(1, "s", 5)], "HAUL int, SEX string, v int")
    r = spark.createDataFrame([(1, "s", 7)], "HAUL int, SEX string, w int")
    assert common_columns(l, r) == ["HAUL", "SEX"]
    assert rows(natural_join(l, r)) == [(1, "s", 5, 7)]


def test_strict_aggregates(spark):
    df = spark.createDataFrame([(1, 1.0), (1, None), (2, 2.0), (2, 3.0)], "g int, x double")
    out = rows(df.groupBy("g").agg(N.strict_sum("x").alias("s"), F.sum("x").alias("l"),
                                   N.strict_min("x").alias("mn"), N.strict_avg("x").alias("a")))
    assert out == [(1, None, 1.0, None, None), (2, 5.0, 5.0, 2.0, 2.5)]


def test_not_in_keeps_null(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    assert rows(df.where(N.not_in("x", ["a"]))) == [("b",), (None,)]
    # SQL NOT IN drops the NULL row
    assert rows(df.where(~F.col("x").isin(["a"]))) == [("b",)]


def test_division_by_zero_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 2.0)], "a double, b double")
    assert sorted(r[0] for r in df.select(N.safe_div("a", "b")).collect() if r[0] is not None) == [0.5]
    assert df.select(N.safe_div("a", "b").alias("q")).where("q IS NULL").count() == 1


def test_prefix_keeps_null(spark):
    df = spark.createDataFrame([("7",), (None,)], "b string")
    assert rows(df.select(N.prefix_id("b"))) == [("X7",), (None,)]


def test_fills_and_requires(spark):
    df = spark.createDataFrame([(None, None, "s"), (1, 2.0, None)], "a int, b double, c string")
    assert rows(N.fill(df, {"a": 0, "zz": 1})) == [(0, None, "s"), (1, 2.0, None)]
    assert rows(N.fill_all0(df)) == [(0, 0.0, "s"), (1, 2.0, None)]
    assert N.require(df, ["a"]).count() == 1
    assert N.require_any(df, ["a", "b"]).count() == 1
    assert rows(df.select(N.to_int(F.lit("x1")), N.to_double(F.lit("2.5"))))[0] == (None, 2.5)


def test_blank_text(spark):
    df = spark.createDataFrame([("",), (None,), ("0930",)], "t string")
    assert df.where(N.present("t")).count() == 1
