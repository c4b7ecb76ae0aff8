"""Layer helpers: display labels (C27/H17), joint ranges (D18), legend scales with overrides."""

from haulkit.operators import layers as LY


def test_display_label(spark):
    df = spark.createDataFrame([("Mature male",), ("HairCrab",), ("Unknown",), (None,)], "c string")
    got = [r[0] for r in df.select(LY.display_label("c")).collect()]
    assert got == ["Mature male (>= 120mm)", "Hair crab", "Unknown", None]


def test_joint_range_and_compare(spark):
    a = spark.createDataFrame([(1, 3.0), (2, 12.0)], "SPN int, COUNT double")
    b = spark.createDataFrame([(3, 7.0)], "SPN int, COUNT double")
    r = LY.joint_range([a, b], "COUNT").first()
    assert (r["MIN"], r["MAX"]) == (3.0, 12.0)
    c = LY.compare_surveys(a, b, "A", "B", "COUNT").collect()
    assert {x["SURVEY"] for x in c} == {"A", "B"} and {x["SCALE_LIMIT"] for x in c} == {15.0}


def test_scale_limits_with_override(spark):
    layer = spark.createDataFrame([("POT", "Tanner", 10.0), ("POT", "Tanner", 3.0), ("TRAWL", "Tanner", 22.0)],
                                  "GEAR string, CATEGORY string, VALUE double")
    override = spark.createDataFrame([("TRAWL", "Tanner", 175.0)], "GEAR string, CATEGORY string, SCALE_LIMIT double")
    rows = LY.scale_limits(layer, override=override).collect()
    lim = {(r["GEAR"], r["BREAK_NO"]): (r["SCALE_LIMIT"], r["BREAK_VALUE"]) for r in rows}
    assert lim[("POT", 5)] == (15.0, 15.0) and lim[("POT", 1)] == (15.0, 3.0)      # 10 rounds strictly up to 15
    assert lim[("TRAWL", 5)] == (175.0, 175.0)
    assert len(rows) == 2 * 6


def test_scale_limits_can_be_fixed_by_a_table(spark):
    from haulkit.operators.layers import scale_limits
    layer = spark.createDataFrame([("POT", "a", 12.0), ("POT", "b", 3.0), ("TRAWL", "a", 7.0)], "GEAR string, CATEGORY string, VALUE double")
    fixed = spark.createDataFrame([("POT", "a", 100.0)], "GEAR string, CATEGORY string, SCALE_LIMIT double")
    got = {(r.GEAR, r.CATEGORY): r.SCALE_LIMIT for r in scale_limits(layer, override=fixed).collect()}
    plain = {(r.GEAR, r.CATEGORY): r.SCALE_LIMIT for r in scale_limits(layer).collect()}
    assert got == plain | {("POT", "a"): 100.0} and plain[("POT", "a")] == 15.0
