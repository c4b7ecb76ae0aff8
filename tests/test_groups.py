"""Specimens joined once a group of them: the same products as joining row by row, on drops with repeats,
NULL and empty ids, hauls numbered twice and specimens without biometrics; fewer rows dealt out."""

import csv
import gzip
import os
import random

import pytest
from pyspark.sql import functions as F

from haulkit import constants as K
from haulkit.functions import nulls as N
from haulkit.functions import scalar as S
from haulkit.operators import catch as C
from haulkit.operators.joins import key_parts, merge_nulls, natural_join, null_safe_join, split_nulls
from haulkit.operators.specimens import fanout, widen
from haulkit.plans import pipelines as P
from haulkit.session import ALL_JOIN_KEYS, setting
from haulkit.sources import drops as D
from haulkit.sources import schemas as SC
from tests.conftest import rows

IDS, DEVICES, SPECIMENS, SAMPLES = ["h1", "h1", "h2", "h3", None, ""], ["d", "d", "e", None], ["s1", "s2", "s3", None], ["a", "b", None]
SPECIES, SEXES, HAULS = [K.RED_KING_CRAB, K.RED_KING_CRAB, K.TANNER_CRAB, None], [1, 2, None], [1, 2, 2, 3, None]
SAMPLE_KEYS = ["HAUL", "HAUL_ID", "SEX", "CATCH_SAMPLE_ID", "SPECIES_CODE", "RECORDING_DEVICE"]
IDS_KEYS = ["HAUL", "HAUL_ID", "SPECIMEN_ID", "RECORDING_DEVICE"]


def _drop(folder, name, schema, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(schema.fieldNames())
        out.writerows([["NA" if x.get(c) is None else x[c] for c in schema.fieldNames()] for x in lines])


def _twice(r, lines):
    """Some rows repeated."""
    return lines + [x for x in lines if r.random() < 0.3]


def _drops(base, seed, n=120):
    r = random.Random(seed)
    pick = r.choice
    ids = lambda: {"HAUL_ID": pick(IDS), "RECORDING_DEVICE": pick(DEVICES)}
    sample = lambda: ids() | {"CATCH_SAMPLE_ID": pick(SAMPLES), "SPECIES_CODE": pick(SPECIES)}
    catch, spec, raw = (os.path.join(base, x) for x in ("catch", "specimen", "raw"))
    _drop(catch, "T_CATCH_1.csv", SC.CATCH, _twice(r, [
        ids() | {"HAUL": pick(HAULS), "ID": str(i), "CRUISE": 202401, "VESSEL": pick([162, 176, None]), "STATION": pick(["A", "B"]),
                 "SPECIES_CODE": pick(SPECIES), "SPECIES_NAME": pick(["x", "y"]), "NUMBER_CRAB": r.randrange(3), "WEIGHT": pick([1.5, None])} for i in range(n)]))
    _drop(spec, "T_SPECIMEN_0001.csv", SC.SPECIMEN, _twice(r, [
        {"HAUL": pick(HAULS), "HAUL_ID": pick(IDS), "SPECIES_CODE": pick(SPECIES), "SEX": pick(SEXES), "LENGTH": pick([90.0, None]), "STATION": pick(["A", "1"]),
         "DISEASE_CODE": pick([1, 2]), "NOTES": pick(["n", None])} for _ in range(n)]))
    _drop(raw, "T_SAMPLE_0001.csv", SC.RAW_SAMPLE, _twice(r, [sample() | {"SPECIES_NAME": pick(["x", "y"]), "SEX": pick(SEXES), "RECORDER": "r"} for _ in range(n)]))
    _drop(raw, "T_SAMPLE_VALUES_0001.csv", SC.RAW_SAMPLE_VALUES, _twice(r, [sample() | {"COUNT": pick([0, 2, None]), "WEIGHT": 1.0, "KEEP": "N", "RECORDER": "r"} for _ in range(n)]))
    _drop(raw, "T_SPECIMEN_0001.csv", SC.RAW_SPECIMEN, _twice(r, [sample() | {"SPECIMEN_ID": pick(SPECIMENS)} for _ in range(n)]))
    _drop(raw, "T_SPECIMEN_BIOMETRICS_0001.csv", SC.RAW_SPECIMEN_BIO, _twice(r, [
        ids() | {"SPECIMEN_ID": pick(SPECIMENS), "BIOMETRIC_NAME": name, "VALUE": value} for _ in range(n)
        for name, value in [pick([("SEX", pick([1.0, 2.0])), ("CARAPACE_LENGTH", 90.0), ("CARAPACE_LENGTH", None), ("WEIGHT", 3.0)])]]))
    _drop(base, "LIFTS.csv", SC.POTLIFTS, [{"VESSEL": v, "SPN": s, "POT_ID": f"P{s}", "BUOY": "1", "DATE_SET": "1/2/2024", "TIME_SET": 800, "DATE_HAUL": "1/3/2024",
                                            "TIME_HAUL": 900, "LAT_DEG": 55, "LAT_MIN": 10.0, "LON_DEG": 160, "LON_MIN": 20.0} for v, s in [(162, 1), (162, 2), (162, 2), (176, 3)]])
    _drop(base, "HAULS.csv", SC.HAULS, [{"SAMPLED": 1, "STATION": s, "LAT_DD": 55.0, "LON_DD": x} for s, x in [("A", -160.0), ("A", -161.0), ("C", -162.0)]])
    return catch, spec, raw


def _row_by_row(spark, raw, catch, samples, trawl=False):
    """Biometrics, raw specimens and samples joined in the reference's order, a row at a time."""
    hauls = catch.select("HAUL", "HAUL_ID", "RECORDING_DEVICE").dropDuplicates()
    bio = null_safe_join(D.read_drop(spark, raw, "_SPECIMEN_BIOMETRICS", SC.RAW_SPECIMEN_BIO, lineage=False), hauls, ["HAUL_ID", "RECORDING_DEVICE"], "right" if trawl else "left")
    wide = widen(bio.distinct() if trawl else bio, IDS_KEYS, "BIOMETRIC_NAME", "VALUE", K.BIOMETRICS).withColumnsRenamed(K.BIOMETRIC_RENAMES)
    wide = wide.withColumns({c: F.col(c).cast("int") for c in K.INT_BIOMETRICS})
    spec = D.read_drop(spark, raw, "_SPECIMEN_0", SC.RAW_SPECIMEN, lineage=False)
    ss = null_safe_join(wide, spec, IDS_KEYS[1:], "left" if trawl else "right")
    ss = null_safe_join(samples, ss, SAMPLE_KEYS, "right")
    return ss.distinct() if trawl else ss


@pytest.mark.parametrize("seed", [1, 2])
def test_pot_groups_equal_rows(spark, tmp_path, seed):
    catch_dir, spec_dir, raw = _drops(str(tmp_path), seed)
    inp = P.PotInputs(catch_dir, spec_dir, raw, [str(tmp_path / "LIFTS.csv")], recode_gear_sheets=())
    read = lambda folder, pattern, schema: D.read_drop(spark, folder, pattern, schema, lineage=False)
    catch = read(catch_dir, "_CATCH_", SC.CATCH).drop("STATION")
    specimen = read(spec_dir, "_SPECIMEN_", SC.SPECIMEN).withColumn("STATION", N.prefix_id("STATION"))
    tossed = C.tossed_totals(read(raw, "_SAMPLE_VALUES", SC.RAW_SAMPLE_VALUES))
    samples = null_safe_join(read(raw, "_SAMPLE_0", SC.RAW_SAMPLE), tossed, ["HAUL_ID", "CATCH_SAMPLE_ID", "RECORDING_DEVICE"], "right")
    samples = null_safe_join(samples, catch.select("HAUL", "HAUL_ID", "RECORDING_DEVICE").distinct(), ["HAUL_ID", "RECORDING_DEVICE"], "right").select(
        *SAMPLE_KEYS, "SPECIES_NAME", "TOSSED")
    ss = _row_by_row(spark, raw, catch, samples).checkpoint()
    sf = C.sampling_factor(ss, ["HAUL", "HAUL_ID", "CATCH_SAMPLE_ID", "SEX", "RECORDING_DEVICE"], "TOSSED").drop("WEIGHT")
    st = natural_join(null_safe_join(catch.drop("RECORDING_DEVICE", "ID"), sf, ["HAUL", "HAUL_ID", "SPECIES_CODE"], "right"), specimen.drop("NOTES"), "left")
    st = null_safe_join(P.pot_lifts(spark, inp), st.distinct().withColumnRenamed("HAUL", "SPN"), ["VESSEL", "SPN"], "right")
    st = N.require(st.withColumn("VESSEL", S.decode_vessel("VESSEL", inp.vessels)), ["LAT_DD", "LON_DD"])
    out = P.pot(spark, inp)
    got, want = rows(out["specimen_table"]), rows(P._opt(st, K.POT_SPECIMEN_COLUMNS))
    assert len(want) > 100
    assert got == want
    assert rows(out["fanout_samples"].select(*SAMPLE_KEYS, "left_rows", "right_rows")) == rows(
        fanout(ss, samples, SAMPLE_KEYS).select(*SAMPLE_KEYS, "left_rows", "right_rows"))


@pytest.mark.parametrize("seed", [3, 4])
def test_trawl_groups_equal_rows(spark, tmp_path, seed):
    catch_dir, spec_dir, raw = _drops(str(tmp_path), seed)
    inp = P.TrawlInputs(catch_dir, spec_dir, raw, str(tmp_path / "HAULS.csv"))
    read = lambda folder, pattern, schema: D.read_drop(spark, folder, pattern, schema, lineage=False)
    catch = read(catch_dir, "_CATCH_", SC.CATCH)
    samples = null_safe_join(read(raw, "_SAMPLE_VALUES", SC.RAW_SAMPLE_VALUES).select("HAUL_ID", "CATCH_SAMPLE_ID", "RECORDING_DEVICE", "RECORDER"),
                             read(raw, "_SAMPLE_0", SC.RAW_SAMPLE), ["HAUL_ID", "CATCH_SAMPLE_ID", "RECORDING_DEVICE", "RECORDER"], "left")
    samples = null_safe_join(samples, catch.select("HAUL", "HAUL_ID", "RECORDING_DEVICE").distinct(), ["HAUL_ID", "RECORDING_DEVICE"], "left")
    ss = _row_by_row(spark, raw, catch, samples.select(*SAMPLE_KEYS, "SPECIES_NAME").distinct(), trawl=True)
    st = null_safe_join(catch.drop("WEIGHT"), ss.drop("WEIGHT"), ["HAUL", "HAUL_ID", "SPECIES_CODE", "RECORDING_DEVICE"], "right")
    st = null_safe_join(P.trawl_hauls(spark, inp.hauls_sheet), natural_join(st, read(spec_dir, "_SPECIMEN_", SC.SPECIMEN), "left"), ["STATION"], "right")
    st = st.withColumns({"VESSEL": P._trawl_vessel(inp), "SAMPLING_FACTOR": F.lit(1.0)})
    got, want = rows(P.trawl(spark, inp)["specimen_table"]), rows(P._opt(st, K.TRAWL_SPECIMEN_COLUMNS))
    assert len(want) > 100
    assert got == want


def test_headers_read_no_file_whole(spark, tmp_path):
    for k, line in enumerate(["A,B", "﻿A,B", "B,A"]):
        with gzip.open(tmp_path / f"T_{k} x.csv.gz", "wt", encoding="utf-8") as f:
            f.write(line + "\n" + "1,2\n" * 1000)
    (tmp_path / "T_3.csv").write_text("A,B\r\n1,2\r\n")
    (tmp_path / "T_4.csv").write_text("")
    files = D.list_drops(spark, str(tmp_path), "^T_")
    spark.sparkContext.setJobGroup("headers", "")
    found = D.headers(spark, files)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {k: [os.path.basename(f) for f in v] for k, v in found.items()} == {"A,B": ["T_0 x.csv.gz", "T_1 x.csv.gz", "T_3.csv"], "B,A": ["T_2 x.csv.gz"]}
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("headers")


def test_split_keys_and_parts_are_dealt_once(spark):
    ids = [(None, 1), ("", 2), ("a", 3), ("a", 4)]
    left, right = spark.createDataFrame(ids, "HAUL_ID string, X int"), spark.createDataFrame(ids, "HAUL_ID string, Y int")
    want = [("", 2, 2), ("a", 3, 3), ("a", 3, 4), ("a", 4, 3), ("a", 4, 4), (None, 1, 1)]
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"), setting(spark, ALL_JOIN_KEYS, "false"), setting(spark, "spark.sql.adaptive.enabled", "false"):
        dealt = null_safe_join(P.by_haul(left), P.by_haul(right), ["HAUL_ID"], "inner", P.PART)
        total = dealt.groupBy(P.PART, "HAUL_ID").count()
        assert total._jdf.queryExecution().executedPlan().toString().count("Exchange") == 2
        assert rows(dealt.select("HAUL_ID", "X", "Y")) == rows(spark.createDataFrame(want, "HAUL_ID string, X int, Y int"))
        factor = C.sampling_factor(dealt, ["HAUL_ID"], "X", rows="Y", part=P.PART)
        plan = factor._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 2 and plan.count("Sort [") == 2          # sorted for the join is sorted for the window
        assert rows(factor.where("HAUL_ID = 'a'").select("X", "SAMPLING_FACTOR")) == [(3, 17 / 14), (3, 17 / 14), (4, 18 / 14), (4, 18 / 14)]
        none = null_safe_join(left.withColumn("E", F.col("X") == 3), right, ["HAUL_ID"], "left", only="E")
        assert rows(none.select("X", "Y")) == [(1, None), (2, None), (3, 3), (3, 4), (4, None)]
        parts = key_parts(["HAUL_ID"])
        split = split_nulls(left, ["HAUL_ID"]).groupBy(*parts).agg(F.count(F.lit(1)).alias("N")).join(split_nulls(right, ["HAUL_ID"]), parts)
        assert split._jdf.queryExecution().executedPlan().toString().count("Exchange") == 2
        assert rows(merge_nulls(split, ["HAUL_ID"]).select("HAUL_ID", "N", "Y")) == rows(
            spark.createDataFrame([(None, 1, 1), ("", 1, 2), ("a", 2, 3), ("a", 2, 4)], "HAUL_ID string, N int, Y int"))


def test_zero_fill_sums_no_rows_without_a_category(spark):
    units = spark.createDataFrame([(1,), (2,)], "U int")
    positive = spark.createDataFrame([(1, "m", 5.0), (1, None, 7.0)], "U int, C string, V double").groupBy("U", "C").agg(F.sum("V").alias("V"))
    out = C.zero_fill(positive, units, ["U"], "C", ["m", "f"], {"V": 0.0})
    assert rows(out) == [(1, "f", 0.0), (1, "m", 5.0), (2, "f", 0.0), (2, "m", 0.0)]
    assert "isnotnull(C" in out._jdf.queryExecution().optimizedPlan().toString()
