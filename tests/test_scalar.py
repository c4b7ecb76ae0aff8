"""Scalar functions H1-H18 and the output rounding rule."""

from pyspark.sql import functions as F

from haulkit.functions import scalar as S


def _one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


def test_hhmm(spark):
    df = spark.createDataFrame([("930",), ("5",), ("2359",), ("2360",), ("12345",), ("ab",), (None,)], "t string")
    assert [r[0] for r in df.select(S.hhmm("t")).collect()] == ["09:30", "00:05", "23:59", None, None, None, None]


def test_soak_hours_across_daylight_saving(spark):
    set_ = S.lift_ts(F.lit("3/10/2001"), F.lit("12:00"), "America/Anchorage")
    haul = S.lift_ts(F.lit("4/2/2001"), F.lit("12:00"), "America/Anchorage")
    wall = S.lift_ts(F.lit("4/2/2001"), F.lit("12:00"), "UTC")
    wall0 = S.lift_ts(F.lit("3/10/2001"), F.lit("12:00"), "UTC")
    assert _one(spark, S.soak_hours(set_, haul)) == 23 * 24 - 1      # one hour lost on 1 April 2001
    assert _one(spark, S.soak_hours(wall0, wall)) == 23 * 24
    assert _one(spark, S.lift_ts(F.lit("13/40/2001"), F.lit("12:00"))) is None


def test_degrees_minutes(spark):
    assert _one(spark, S.dm_to_dd(F.lit(56), F.lit(30.0), -1.0)) == -56.5


def test_maturity_and_legal_classes(spark):
    df = spark.createDataFrame(
        [(69322, 1, 125.0, None), (69322, 1, 100.0, None), (69322, 2, 90.0, 3), (69322, 2, 90.0, 0),
         (69322, 2, 90.0, None), (68560, 1, 140.0, None), (69322, 1, 140.0, None)],
        "sp int, sex int, len double, cl int")
    got = df.select(S.maturity_class("sp", "sex", "len", "cl"), S.legal_class("sp", "sex", "len")).collect()
    assert [tuple(r) for r in got] == [
        ("Mature male", "Sublegal male"), ("Immature male", "Sublegal male"), ("Mature female", None),
        ("Immature female", None), (None, None), (None, None), ("Mature male", "Legal male")]


def test_shell_and_bycatch_labels(spark):
    df = spark.createDataFrame([(69322, 1, 130.0, None, 2), (69322, 2, 80.0, 5, 3), (69400, 2, 1.0, None, 1),
                                (68560, 1, 1.0, None, 1), (69400, None, 1.0, None, 1)],
                               "sp int, sex int, len double, cl int, sc int")
    got = df.select(S.shell_class("sp", "sex", "len", "cl", "sc"), S.bycatch_label("sp", "sex")).collect()
    assert [tuple(r) for r in got] == [("Mature male SC2", None), ("Mature female SC3", None), (None, "HairCrab"),
                                       (None, "MaleTanner"), (None, None)]


def test_fish_label_and_merge(spark):
    df = spark.createDataFrame([("Pacific cod (adult)", 21722), ("walleye pollock", 21740), (None, 1)],
                               "n string, c int")
    out = df.select(S.fish_label(S.merge_species_name("n")), S.merge_species_code("c")).collect()
    assert [tuple(r) for r in out] == [("PacificCod", 21720), ("Pollock", 21740), ("Other", 1)]


def test_round_up_and_breaks(spark):
    assert _one(spark, S.round_up(F.lit(10.0), 5)) == 15.0
    assert _one(spark, S.round_up(F.lit(12.0), 5)) == 15.0
    assert _one(spark, S.breaks(F.lit(15.0), 5)) == [0.0, 3.0, 6.0, 9.0, 12.0, 15.0]


def test_temp_band_and_units(spark):
    df = spark.createDataFrame([(-2.0,), (-1.0,), (0.5,), (4.0,), (9.0,)], "t double")
    assert [r[0] for r in df.select(S.temp_band("t")).collect()] == [
        "(-Inf,-1]", "(-Inf,-1]", "(0,1]", "(3,4]", "(4,Inf]"]
    assert _one(spark, S.measure_of(F.lit("Tanner"))) == "count"
    assert _one(spark, S.measure_of(F.lit("Pollock"))) == "kg"


def test_vessel_gear_station(spark):
    df = spark.createDataFrame([(162,), (134,), (176,), (None,)], "v int")
    assert [r[0] for r in df.select(S.decode_vessel("v", {162: "Marahute", 134: "Provider"})).collect()] == [
        "Marahute", "Provider", None, None]
    assert [r[0] for r in df.select(S.gear_of(S.decode_vessel("v"))).collect()] == ["POT", "POT", "TRAWL", None]
    st = spark.createDataFrame([("G35",), ("CAM1",), (None,)], "s string")
    assert st.where(S.regular_station("s")).count() == 1


def test_fix_rounds_half_away_from_zero_on_the_product(spark):
    # 3 / 53.333... is 0.05625 in exact terms; both engines round the same double product
    import math
    x = 3.0 / (192000.0 / 3600.0)
    assert _one(spark, S.fix(F.lit(x), 4)) == math.floor(x * 10000.0 + 0.5) / 10000.0
    assert _one(spark, S.fix(F.lit(2.5), 0)) == 3.0
    assert _one(spark, S.fix(F.lit(-2.5), 0)) == -3.0


def test_sql_and_column_paths_agree(spark):
    df = spark.createDataFrame([("930", "3/10/2001", "09:30"), ("2460", "11/4/2001", "01:30"), (None, "x", "7:05"),
                                ("0", "4/1/2001", "02:30")], "t string, d string, h string")
    a = df.select(S.hhmm("t"), S.hhmm(F.col("t")), S.lift_ts("d", "h", "America/Anchorage"),
                  S.lift_ts(F.col("d"), F.col("h"), "America/Anchorage")).collect()
    for r in a:
        assert r[0] == r[1] and r[2] == r[3]
