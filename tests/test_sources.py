"""Drops with differing headers (A1, A2), sheets (A3), products (A4-A6), layers."""

import os
import tempfile

from haulkit.sources import drops as D
from haulkit.sources.schemas import PLACENAMES, RAW_SAMPLE_VALUES


def _write(folder, name, text):
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


def test_header_drift_is_aligned_by_name(spark):
    d = tempfile.mkdtemp(prefix="drops-")
    _write(d, "A_SAMPLE_VALUES_1.csv",
           "HAUL_ID,CATCH_SAMPLE_VALUE_ID,CATCH_SAMPLE_ID,COUNT,WEIGHT,KEEP,RECORDING_DEVICE,RECORDER\n"
           "h1,v1,s1,3,1.5,Y,dev,me\nh1,v2,s1,NA,2.0,N,dev,me\n")
    # other column order and no KEEP column: a positional read would shift values
    _write(d, "A_SAMPLE_VALUES_2.csv",
           "RECORDER,RECORDING_DEVICE,WEIGHT,COUNT,CATCH_SAMPLE_ID,CATCH_SAMPLE_VALUE_ID,HAUL_ID\n"
           "you,dev2,4.0,7,s2,v3,h2\n")
    _write(d, "A_CATCH_1.csv", "X\n1\n")
    df = D.read_drop(spark, d, "_SAMPLE_VALUES", RAW_SAMPLE_VALUES)
    got = {r["CATCH_SAMPLE_VALUE_ID"]: r for r in df.collect()}
    assert len(got) == 3
    assert got["v3"]["COUNT"] == 7 and got["v3"]["WEIGHT"] == 4.0 and got["v3"]["KEEP"] is None
    assert got["v3"]["RECORDER"] == "you" and got["v3"]["SOURCE_FILE"] == "A_SAMPLE_VALUES_2.csv"
    assert got["v2"]["COUNT"] is None                      # "NA" is NULL
    assert df.columns[:8] == RAW_SAMPLE_VALUES.fieldNames()


def test_products_round_trip_by_survey(spark):
    base = tempfile.mkdtemp(prefix="products-")
    a = spark.createDataFrame([(1, 2.0)], "SPN int, COUNT double")
    b = spark.createDataFrame([(5, 9.0)], "SPN int, COUNT double")
    D.write_product(a, base, "potcatch", "2024")
    D.write_product(b, base, "potcatch", "2026")
    D.write_product(b, base, "potcatch", "2024")           # replaces only the 2024 partition
    assert [tuple(r) for r in D.load_product(spark, base, "potcatch", "2026").select("SPN", "COUNT").collect()] == [(5, 9.0)]
    assert [tuple(r) for r in D.load_product(spark, base, "potcatch", "2024").select("SPN").collect()] == [(5,)]


def test_placenames_and_polygons(spark):
    d = tempfile.mkdtemp(prefix="layers-")
    p = os.path.join(d, "placenames.csv")
    _write(d, "placenames.csv", "type,region,lab,x,y\nislands,bs.all,Nunivak,-166.25,60.1\nmainland,bs.south,Alaska,-154.0,62.0\n")
    assert [r["lab"] for r in D.placenames(spark, p, "islands").collect()] == ["Nunivak"]
    assert D.read_table(spark, p, PLACENAMES).count() == 2
    v = spark.createDataFrame([("a", 0, 0, 0.0, 0.0)], "poly_id string, ring int, seq int, x double, y double")
    v.write.parquet(os.path.join(d, "poly"))
    assert D.load_polygons(spark, os.path.join(d, "poly")).count() == 1


def test_quoted_headers_folders_of_parts_and_corrupt_cells(spark):
    d = tempfile.mkdtemp(prefix="drops-")
    _write(d, "Q_SAMPLE_VALUES_1.csv", '"HAUL_ID","COUNT","note, free"\nh1,3,"a, b"\nh2,x,c\n')
    spark.createDataFrame([("h3", 5)], "HAUL_ID string, COUNT int").write.option("header", True).csv(os.path.join(d, "Q_SAMPLE_VALUES_2"))
    _write(d, "Q_SAMPLE_VALUES_3.csv", "")
    df = D.read_drop(spark, d, "_SAMPLE_VALUES", RAW_SAMPLE_VALUES)
    assert sorted((r["HAUL_ID"], r["COUNT"]) for r in df.select("HAUL_ID", "COUNT").fillna(-1).collect()) == [("h1", 3), ("h2", -1), ("h3", 5)]
    bad = D.corrupt_rows(spark, d, "_SAMPLE_VALUES", RAW_SAMPLE_VALUES).collect()
    assert [(r["SOURCE_FILE"], r["LINE"]) for r in bad] == [("Q_SAMPLE_VALUES_1.csv", "h2,x,c")]


def test_no_drops_at_all(spark):
    d = tempfile.mkdtemp(prefix="drops-")
    assert D.read_drop(spark, d, "_SAMPLE_VALUES", RAW_SAMPLE_VALUES).count() == 0
