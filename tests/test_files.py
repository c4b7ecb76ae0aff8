"""The drop data source, versioned snapshots, violations by row."""

import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from haulkit.operators import quality as QU
from haulkit.sources import dropsource as DS
from haulkit.sources import drops as D
from haulkit.sources import snapshots as SN

SCHEMA = StructType([StructField("HAUL", IntegerType()), StructField("NAME", StringType()), StructField("LENGTH", DoubleType())])


def write(folder, name, text):
    path = os.path.join(str(folder), name)
    with open(path, "w", newline="") as f:
        f.write(text)
    return path


def rows(df):
    return sorted(tuple(r) for r in df.fillna({"HAUL": -1, "NAME": "-", "LENGTH": -1.0}).collect())


def test_headers_differ_cells_fail_and_files_are_odd(spark, tmp_path):
    write(tmp_path, "A_CATCH_1.csv", "HAUL,NAME,LENGTH\n1,a,1.5\n2,NA,\n")
    write(tmp_path, "A_CATCH_2.csv", '﻿"LENGTH", "EXTRA, free" ,"HAUL"\r\n2.5,"x, y",3\r\nbad,z,4\r\n')
    write(tmp_path, "A_CATCH_3.csv", "HAUL,NAME\n5,no newline at the end")
    write(tmp_path, "A_CATCH_4.csv", "HAUL,NAME\n")
    write(tmp_path, "A_CATCH_5.csv", "")
    write(tmp_path, "A_OTHER_1.csv", "HAUL\n99\n")
    write(tmp_path, "A_CATCH_6.csv", "SOMETHING\n7\n")
    spark.createDataFrame([(8, "part")], "HAUL int, NAME string").write.option("header", True).csv(str(tmp_path / "A_CATCH_7.csv"))
    df = DS.scan_drops(spark, str(tmp_path), "_CATCH_", SCHEMA)
    assert df.columns == ["HAUL", "NAME", "LENGTH", "SOURCE_FILE"]
    assert rows(df.drop("SOURCE_FILE")) == sorted([(1, "a", 1.5), (2, "-", -1.0), (3, "-", 2.5), (4, "-", -1.0), (5, "no newline at the end", -1.0), (-1, "-", -1.0), (8, "part", -1.0)])
    names = {r.HAUL: r.SOURCE_FILE for r in df.collect()}
    assert names[1] == "A_CATCH_1.csv" and names[3] == "A_CATCH_2.csv" and names[8].startswith("part-")
    for start in ("file://", "file:"):
        assert DS.scan_drops(spark, start + str(tmp_path), "_OTHER_", SCHEMA, lineage=False).collect() == [(99, None, None)]
    assert DS.scan_drops(spark, str(tmp_path), "_NONE_", SCHEMA).count() == 0


@pytest.mark.parametrize("part", [7, 100, 4096, 1 << 20])
def test_a_large_drop_is_split_and_every_line_read_once(spark, tmp_path, part):
    lines = [f"{k},name {k % 17}{'x' * (k % 40)},{k / 4}" for k in range(300)]
    write(tmp_path, "B_CATCH_1.csv", "HAUL,NAME,LENGTH\n" + "\n".join(lines) + "\n")
    write(tmp_path, "B_CATCH_2.csv", "NAME,HAUL\nother,1000\n")
    df = DS.scan_drops(spark, str(tmp_path), "_CATCH_", SCHEMA, lineage=False, part=part)
    assert sorted(r.HAUL for r in df.collect()) == [*range(300), 1000]
    assert {r.HAUL: r.LENGTH for r in df.collect()}[299] == 74.75
    if part == 100:
        assert df.rdd.getNumPartitions() > 50  # one large file becomes many tasks


def test_scan_equals_the_reader_by_headers(spark, tmp_path):
    for k in range(12):
        order = ["HAUL", "NAME", "LENGTH"][:: -1 if k % 2 else 1][: 2 + k % 3]
        write(tmp_path, f"C_CATCH_{k}.csv", ",".join(order) + "\n" + "\n".join(",".join({"HAUL": str(k * 10 + i), "NAME": f"n{i}", "LENGTH": str(i / 2)}[c] for c in order) for i in range(5)) + "\n")
    a = D.read_drop(spark, str(tmp_path), "_CATCH_", SCHEMA)
    b = DS.scan_drops(spark, str(tmp_path), "_CATCH_", SCHEMA)
    assert rows(a.select("HAUL", "NAME", "LENGTH", "SOURCE_FILE")) == rows(b)
    assert b._jdf.queryExecution().executedPlan().toString().count("BatchScan") == 1


def test_stream_of_drops_takes_each_file_once(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    os.makedirs(folder)

    def run():
        q = (DS.stream_drops(spark, str(folder), "_CATCH_", SCHEMA, part=64).writeStream.format("parquet")
             .option("path", out).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
        q.awaitTermination()
        return sorted(r.HAUL for r in spark.read.parquet(out).collect())

    write(folder, "D_CATCH_1.csv", "HAUL,NAME\n" + "\n".join(f"{k},a" for k in range(40)) + "\n")
    assert run() == list(range(40))
    time.sleep(0.05)
    write(folder, "D_CATCH_2.csv", "NAME,HAUL\nb,100\n")
    assert run() == [*range(40), 100]
    assert run() == [*range(40), 100]


def test_snapshots_are_published_whole_or_not_at_all(spark, tmp_path):
    base = str(tmp_path)
    a = spark.createDataFrame([(1, 2.0), (2, None), (None, 5.0)], "SPN int, COUNT double")
    b = spark.createDataFrame([(1, 3.0), (3, 1.0), (None, 5.0)], "SPN int, COUNT double")
    assert SN.versions(spark, base, "catch", "2024") == [] and SN.prior(spark, base, "catch", "2024") is None
    with pytest.raises(FileNotFoundError):
        SN.snapshot(spark, base, "catch", "2024")
    assert SN.publish(a, base, "catch", "2024") == 1 and SN.publish(a.limit(0), base, "catch", "2026") == 1
    assert SN.prior(spark, base, "catch", "2024") is None
    dying = b.withColumn("COUNT", F.when(F.col("SPN") == 3, F.raise_error(F.lit("the writer died"))).otherwise(F.col("COUNT")))
    with pytest.raises(Exception, match="died"):
        SN.publish(dying, base, "catch", "2024")
    assert SN.versions(spark, base, "catch", "2024") == [1]
    assert SN.snapshot(spark, base, "catch", "2024").count() == 3  # readable as it was
    assert SN.publish(b, base, "catch", "2024") == 2
    got = {(r.SPN, r.CHANGE, r.OLD_COUNT, r.NEW_COUNT) for r in
           SN.changes(SN.prior(spark, base, "catch", "2024"), SN.snapshot(spark, base, "catch", "2024"), ["SPN"]).collect()}
    assert got == {(1, "changed", 2.0, 3.0), (2, "removed", None, None), (3, "added", None, 1.0)}
    assert SN.snapshot(spark, base, "catch", "2024", 1).count() == 3 and SN.snapshot(spark, base, "catch", "2026").columns == ["SPN", "COUNT"]
    with pytest.raises(FileNotFoundError):
        SN.snapshot(spark, base, "catch", "2024", 9)


def test_all_violations_agree_with_the_report_in_one_scan(spark, tmp_path):
    schema = ("CRUISE int, VESSEL string, SPECIES_CODE int, SEX int, LENGTH double, WIDTH double, SHELL_CONDITION int, EGG_COLOR int, EGG_CONDITION int, "
              "CLUTCH_SIZE int, DISEASE_CODE int, DISEASE_DORSAL double, DISEASE_VENTRAL double, DISEASE_LEGS double, SAMPLING_FACTOR double, SOURCE_FILE string")
    values = [(202401 if k % 9 else 1, ["Marahute", "Provider", None, "X"][k % 4], 69322 if k % 5 else None, [1, 2, None, 3][k % 4], float(k) if k % 7 else None,
               5.0 if k % 11 == 0 else None, k % 6, k % 8 if k % 3 else None, k % 7, k % 9, k % 13 if k % 2 else None, 1.0 if k % 5 == 0 else None, None, None,
               0.5 if k % 10 == 0 else 1.0, f"f{k % 3}.csv") for k in range(400)]
    sp = spark.createDataFrame(values, schema)
    sp.write.parquet(str(tmp_path / "sp"))
    sp = spark.read.parquet(str(tmp_path / "sp"))
    found = QU.all_violations(sp)
    counts = {r.RULE_ID: r["count"] for r in found.groupBy("RULE_ID").count().collect()}
    assert counts == {r.RULE_ID: r.VIOLATIONS for r in QU.quality_report(sp).collect() if r.VIOLATIONS}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
    assert {r.SOURCE_FILE for r in found.select("SOURCE_FILE").distinct().collect()} == {"f0.csv", "f1.csv", "f2.csv"}
