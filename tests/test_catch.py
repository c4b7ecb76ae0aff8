"""Sampling factor, class totals, zero-fill, labelings, pivots."""

import pytest
from pyspark.sql import functions as F

from haulkit import constants as K
from haulkit.operators import catch as C
from haulkit.operators.specimens import duplicates, lengthen, widen
from tests.conftest import rows

SPEC = [  # SPN, species, sex, length, clutch, tossed
    (1, 69322, 1, 130.0, None, 2), (1, 69322, 1, 140.0, None, 2), (1, 69322, 1, 100.0, None, 2),
    (1, 69322, 2, 90.0, 3, 1), (1, 69322, 2, 95.0, 0, 1), (1, 68560, 1, 100.0, None, 5),
    (2, 69322, None, 120.0, None, 0), (2, 69322, 2, 80.0, 1, 4), (3, 69322, 1, 150.0, None, None),
]
SCHEMA = "SPN int, SPECIES_CODE int, SEX int, LENGTH double, CLUTCH_SIZE int, TOSSED int"


@pytest.fixture()
def spec(spark):
    return spark.createDataFrame(SPEC, SCHEMA)


def _flags():
    return C.maturity_flags("SPECIES_CODE", "SEX", "LENGTH", "CLUTCH_SIZE", K.RED_KING_CRAB,
                            K.MATURE_MALE_MM, K.LEGAL_MALE_MM)


def test_sampling_factor_matches_window_form(spec):
    from pyspark.sql import Window
    keys = ["SPN", "SPECIES_CODE", "SEX"]
    a = C.sampling_factor(spec, keys).select("SPN", "LENGTH", "SAMPLING_FACTOR")
    w = Window.partitionBy(*keys)
    b = spec.select("SPN", "LENGTH", ((F.count(F.lit(1)).over(w) + F.col("TOSSED")) / F.count(F.lit(1)).over(w)))
    assert rows(a) == rows(b)
    # group (1, RKC, male) keeps 3 and tossed 2: factor 5/3
    assert [r[0] for r in a.where("SPN = 1 AND LENGTH = 130.0").select("SAMPLING_FACTOR").collect()] == [5 / 3]


def _row_level_totals(spec):
    sf = C.sampling_factor(spec, ["SPN", "SPECIES_CODE", "SEX"])
    out = {}
    for r in sf.collect():
        d = r.asDict()
        for name, f in {"Mature male": d["SPECIES_CODE"] == 69322 and d["SEX"] == 1 and d["LENGTH"] >= 120,
                        "Immature male": d["SPECIES_CODE"] == 69322 and d["SEX"] == 1 and d["LENGTH"] < 120,
                        "Mature female": d["SPECIES_CODE"] == 69322 and d["SEX"] == 2 and (d["CLUTCH_SIZE"] or 0) >= 1,
                        "Immature female": d["SPECIES_CODE"] == 69322 and d["SEX"] == 2 and d["CLUTCH_SIZE"] == 0,
                        "Legal male": d["SPECIES_CODE"] == 69322 and d["SEX"] == 1 and d["LENGTH"] >= 135,
                        "Sublegal male": d["SPECIES_CODE"] == 69322 and d["SEX"] == 1 and d["LENGTH"] < 135}.items():
            if f:
                key = (d["SPN"], name)
                v = d["SAMPLING_FACTOR"]
                out[key] = None if (v is None or out.get(key, 0.0) is None) else out.get(key, 0.0) + v
    return out


@pytest.mark.parametrize("one_pass", [False, True])
def test_class_totals_equal_row_level_sums(spec, one_pass):
    samples = C.maturity_samples(K.RED_KING_CRAB) if one_pass else None
    t = C.class_totals(spec, ["SPN"], ["SPECIES_CODE", "SEX"], "TOSSED", _flags(), samples)
    got = {}
    for r in t.collect():
        for name in K.MAT_SEX_CATEGORIES:
            if r[name] is not None:
                got[(r["SPN"], name)] = r[name]
    ref = _row_level_totals(spec)
    # strict NULL (lift 3 has a NULL tossed count) shows as NULL in both
    assert {k for k, v in ref.items() if v is not None} == set(got)
    for k, v in got.items():
        assert v == pytest.approx(ref[k])


def test_legal_plus_sublegal_equals_mature_plus_immature_males(spec):
    t = C.class_totals(spec, ["SPN"], ["SPECIES_CODE", "SEX"], "TOSSED", _flags()).fillna(0.0)
    for r in t.collect():
        assert r["Legal male"] + r["Sublegal male"] == pytest.approx(r["Mature male"] + r["Immature male"])


def test_zero_fill_rows_are_units_times_categories(spark, spec):
    units = spark.createDataFrame([(1,), (2,), (3,), (4,)], "SPN int")
    t = C.class_totals(spec, ["SPN"], ["SPECIES_CODE", "SEX"], "TOSSED", _flags())
    z = C.zero_fill_wide(units, t, ["SPN"], "MAT_SEX", K.MAT_SEX_CATEGORIES, "COUNT")
    assert z.count() == 4 * 6
    pos = spec.select("SPN").distinct()
    long = z.select("SPN", "MAT_SEX", F.coalesce("COUNT", F.lit(0.0)).alias("COUNT"))
    assert long.where("SPN = 4").where("COUNT != 0").count() == 0
    # generic long zero-fill (explode + NULL-safe left join) agrees
    positive = long.where("COUNT > 0").join(pos, "SPN")
    z2 = C.zero_fill(positive, units, ["SPN"], "MAT_SEX", K.MAT_SEX_CATEGORIES, {"COUNT": 0.0})
    assert rows(z2.select("SPN", "MAT_SEX", "COUNT")) == rows(long)


def test_explode_classes_is_union_of_labelings(spec):
    from haulkit.functions.scalar import legal_class, maturity_class
    mat = maturity_class("SPECIES_CODE", "SEX", "LENGTH", "CLUTCH_SIZE")
    leg = legal_class("SPECIES_CODE", "SEX", "LENGTH")
    one = C.explode_classes(spec, [mat, leg]).select("SPN", "LENGTH", "MAT_SEX")
    two = spec.select("SPN", "LENGTH", mat.alias("MAT_SEX")).unionByName(
        spec.select("SPN", "LENGTH", leg.alias("MAT_SEX")).where("MAT_SEX IS NOT NULL"))
    assert rows(one) == rows(two)


def test_cpue_and_reconcile(spark, spec):
    sf = C.sampling_factor(spec, ["SPN", "SPECIES_CODE", "SEX"]).withColumn("SOAK_TIME", F.lit(10.0))
    c = C.cpue(sf.withColumn("MAT_SEX", F.lit("all")), ["SPN"])
    r = {x["SPN"]: (x["COUNT"], x["CATCH_PER_HOUR"]) for x in c.collect()}
    assert r[1][0] == pytest.approx(6 + 2 * 3 / 3 + 1 * 2 / 2 + 5)  # = Σ (KEPT+TOSSED)/KEPT
    assert r[1][1] == pytest.approx(r[1][0] / 10.0)
    assert r[3] == (None, None)           # NULL tossed -> strict NULL
    est = C.expanded_count(sf, ["SPN", "SPECIES_CODE"])
    rep = spark.createDataFrame([(1, 69322, 8), (2, 69322, 1), (9, 69322, 1)], "SPN int, SPECIES_CODE int, N_ENTRIES int")
    out = rows(C.reconcile_catch(est, rep, ["SPN", "SPECIES_CODE"]).select("SPN", "MISMATCH"))
    assert out == [(1, False), (2, True)]   # lift 9 has no estimate -> dropped (na.omit)


def test_tossed_totals_treat_null_as_zero(spark):
    v = spark.createDataFrame([("h", "s", "d", None), ("h", "s", "d", 3)],
                              "HAUL_ID string, CATCH_SAMPLE_ID string, RECORDING_DEVICE string, COUNT int")
    assert rows(C.tossed_totals(v)) == [("h", "s", "d", 3)]


def test_widen_marks_duplicates(spark):
    long = spark.createDataFrame([(1, "SEX", 1.0), (1, "CARAPACE_LENGTH", 120.0), (2, "SEX", 2.0), (2, "SEX", 1.0)],
                                 "SPECIMEN_ID int, BIOMETRIC_NAME string, VALUE double")
    w = widen(long, ["SPECIMEN_ID"], "BIOMETRIC_NAME", "VALUE", ["SEX", "CARAPACE_LENGTH"])
    assert rows(w) == [(1, 1.0, 120.0, 0), (2, None, None, 1)]
    assert rows(duplicates(long, ["SPECIMEN_ID"], "BIOMETRIC_NAME")) == [(2, "SEX", 2)]
    back = lengthen(w.drop("N_DUP"), ["SPECIMEN_ID"], ["SEX", "CARAPACE_LENGTH"], "NAME", "VALUE")
    assert back.count() == 4


def test_basket_weight_strict(spark):
    s = spark.createDataFrame([(1, 1, 2.0), (1, 1, 3.0), (1, 2, None)], "H int, SEX int, WEIGHT double")
    assert rows(C.basket_weight(s, ["H", "SEX"])) == [(1, 1, 5.0), (1, 2, None)]
