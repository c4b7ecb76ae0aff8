"""Groundfish (W1, D6-D8), bycatch sheets (D9, D16), quality report (Q*, D12, D13, C25, C26)."""

import pytest
from pyspark.sql import functions as F

from haulkit import constants as K
from haulkit.operators import bycatch as BY
from haulkit.operators import fish as FI
from haulkit.operators import quality as QU
from tests.conftest import rows

FISH = [  # STATION, CATCH_SAMPLE_ID, SPECIES_CODE, SPECIES_NAME, WEIGHT, COUNT
    (1, 10, 10210, "yellowfin sole", 6.0, 3), (1, 10, 10210, "yellowfin sole", 4.0, 2),
    (1, 11, 10001, "flatfish unid.", 5.0, None), (1, 12, 21720, "Pacific cod", 9.0, 3),
    (1, 13, 10110, "arrowtooth flounder", 10.0, 0), (2, 20, 10210, "yellowfin sole", 2.0, None),
]


@pytest.fixture()
def fish(spark):
    return spark.createDataFrame(FISH, "STATION int, CATCH_SAMPLE_ID int, SPECIES_CODE int, SPECIES_NAME string, "
                                       "SAMPLE_VALUE_WEIGHT double, SAMPLE_VALUE_COUNT int")


def test_flatfish_expansion_preserves_station_weight(fish):
    f = FI.flatfish_expand(fish)
    assert f.where(F.col("SPECIES_CODE") == K.UNID_FLATFISH_CODE).count() == 0
    calc = f.withColumn("CW", F.col("SAMPLE_VALUE_WEIGHT") * F.col("SAMPLING_FACTOR"))
    st1 = calc.where("STATION = 1 AND SPECIES_CODE != 21720").agg(F.sum("CW")).first()[0]
    assert st1 == pytest.approx(6 + 4 + 10 + 5)        # identified + unidentified flatfish weight
    assert {r[0] for r in f.where("SPECIES_CODE = 21720").select("SAMPLING_FACTOR").collect()} == {1.0}


def test_estimate_counts_matches_plain_python(fish):
    f = FI.flatfish_expand(fish)
    e = FI.estimate_counts(f, ["STATION", "CATCH_SAMPLE_ID", "SPECIES_CODE", "SPECIES_NAME", "SAMPLING_FACTOR"])
    got = {r["CATCH_SAMPLE_ID"]: r for r in e.collect()}
    # sample 10: distinct individual weights {2.0}: counts 6/2 + 4/2 = 5
    assert got[10]["IND_WEIGHT"] == 2.0 and got[10]["COUNT"] == pytest.approx(5.0)
    # sample 13: weight / 0 count -> no individual weight -> NULL count
    assert got[13]["IND_WEIGHT"] is None and got[13]["COUNT"] is None
    assert got[12]["CALC_WEIGHT"] == pytest.approx(9.0)


def test_clean_fish_keeps_null_codes_until_required(spark):
    s = spark.createDataFrame([(1, 69322), (1, None), (1, 21722)], "STATION int, SPECIES_CODE int")
    names = spark.createDataFrame([(21722, "Pacific cod (adult)")], "SPECIES_CODE int, SPECIES_NAME string")
    out = rows(FI.clean_fish(s, names))
    assert out == [(21720, 1, "Pacific cod")]


def test_crab_bycatch_sheet(spark):
    sp = spark.createDataFrame([(1, 68560, 1, 1.0), (1, 68560, 2, 1.0), (1, 69400, 2, 1.0), (1, 69322, 1, 1.0),
                                (2, 69400, None, 1.0)], "ST int, SPECIES_CODE int, SEX int, SAMPLING_FACTOR double")
    units = spark.createDataFrame([(1,), (2,), (3,)], "ST int")
    sheet = BY.add_species_totals(BY.zero_filled_sheet(units, BY.crab_bycatch_wide(sp, ["ST"]), ["ST"],
                                                       K.SPP_SEX_CATEGORIES))
    r = {x["ST"]: x for x in sheet.collect()}
    assert (r[1]["MaleTanner"], r[1]["FemaleTanner"], r[1]["Tanner"], r[1]["HairCrab"]) == (1.0, 1.0, 2.0, 1.0)
    assert all(r[3][c] == 0.0 for c in K.SPP_SEX_CATEGORIES)
    assert r[2]["HairCrab"] == 0.0          # hair crab of unknown sex gets no label


def _specimens(spark):
    return spark.createDataFrame(
        [(202401, "Marahute", 69322, 1, 130.0, None, 2, None, None, None, None, None, None, None, 1.5),
         (202301, None, 69322, 2, 60.0, 2, 1, 3, 2, None, 1, None, None, None, 0.5),
         (202401, "Provider", 69322, None, None, None, 3, None, None, 7.0, 10, 1.0, None, None, 1.0)],
        "CRUISE int, VESSEL string, SPECIES_CODE int, SEX int, LENGTH double, CLUTCH_SIZE int, SHELL_CONDITION int,"
        " EGG_COLOR int, EGG_CONDITION int, WIDTH double, DISEASE_CODE int, DISEASE_DORSAL double,"
        " DISEASE_VENTRAL double, DISEASE_LEGS double, SAMPLING_FACTOR double")


def test_quality_report_one_pass(spark):
    rep = {r["RULE_ID"]: (r["VIOLATIONS"], r["CHECKED"]) for r in QU.quality_report(_specimens(spark)).collect()}
    assert rep["Q1"] == (1, 3) and rep["Q2"] == (1, 3) and rep["Q4"] == (1, 3)
    assert rep["Q11"] == (1, 3) and rep["Q12"] == (1, 1) and rep["Q14"] == (1, 3)
    assert rep["Q16"] == (1, 1) and rep["Q19"] == (1, 3) and rep["Q21"] == (1, 3)
    assert rep["Q9b"] == (1, 1)
    assert QU.violations(_specimens(spark), QU.specimen_rules()[0]).count() == 1


def test_inventories_grouping_sets(spark):
    inv = QU.inventories(_specimens(spark))
    by = {}
    for r in inv.collect():
        by.setdefault(r["INVENTORY"], []).append(r)
    assert sum(r["N"] for r in by[1]) == 3 and sum(r["N"] for r in by[3]) == 3
    assert sum(r["N"] for r in by[4]) == 1            # females only
    rg = rows(QU.ranges(_specimens(spark)).select("SEX", "MIN_LENGTH"))
    assert rg == [(1, 130.0), (2, 60.0), (None, None)]


def test_orphans_and_reconcile(spark):
    a = spark.createDataFrame([(1,), (2,)], "K int")
    b = spark.createDataFrame([(2,), (3,)], "K int")
    assert rows(QU.orphan_units(a, b, ["K"])) == [(1, "units_only"), (3, "other_only")]
    s = spark.createDataFrame([(1, 2.0, 2), (2, 1.0, 1)], "K int, NUMBER_CRAB double, N_ENTRIES int")
    c = spark.createDataFrame([(1, 2.0, 2), (2, 1.0, 3), (4, 1.0, 1)], "K int, NUMBER_CRAB double, N_ENTRIES int")
    assert [r["K"] for r in QU.reconcile_totals(s, c, ["K"]).orderBy("K").collect()] == [2, 4]



def test_sample_groups_are_dealt_by_rows_not_by_cores(spark, fish, monkeypatch):
    from haulkit import session
    keys = ["STATION", "CATCH_SAMPLE_ID", "SPECIES_CODE", "SPECIES_NAME", "SAMPLING_FACTOR"]
    f = FI.flatfish_expand(fish)
    assert rows(FI.estimate_counts(f, keys, tasks=37)) == rows(FI.estimate_counts(f, keys))
    monkeypatch.setattr(session, "TASK_ROWS", 10)
    tasks = session.tasks_for(spark.range(1234))
    assert tasks == 124
    many = spark.range(5000).selectExpr("id AS STATION", "id AS CATCH_SAMPLE_ID", "CAST(id % 9 AS INT) AS SPECIES_CODE", "CAST(id % 3 AS STRING) AS SPECIES_NAME", "1.0D + id % 2 AS SAMPLING_FACTOR",
                                        "2.0D AS SAMPLE_VALUE_WEIGHT", "1 AS SAMPLE_VALUE_COUNT")
    dealt = FI.estimate_counts(many, keys, tasks=tasks).groupBy(F.spark_partition_id().alias("p")).count().agg(F.count("p"), F.max("count")).first()
    assert dealt[0] == tasks and dealt[1] < 200
