"""Stored steps of long products: same rows, nothing left of shuffles or of tables that are done with."""

import glob
import gzip
import os
import time

from pyspark.sql import functions as F

from haulkit.operators.specimens import widen
from haulkit.plans import products as PR
from haulkit.session import FREE_SHUFFLES, Steps
from haulkit.sources import schemas as SC
from haulkit.sources.drops import read_drop
from tests.conftest import rows

CELLS = [("a", "SEX", 1.0), ("a", "SEX", 1.0), ("a", "LENGTH", 90.0), ("a", "LENGTH", 95.0), ("b", "SEX", None), ("b", "SEX", None),
         ("b", "LENGTH", None), ("b", "LENGTH", 80.0), ("c", "SEX", 0.0), ("c", "SEX", -0.0), ("c", "OTHER", 3.0), (None, "SEX", 2.0)]


def test_widen_counts_repeated_rows_once(spark):
    long = spark.createDataFrame(CELLS, "ID string, NAME string, VALUE double")
    args = (["ID"], "NAME", "VALUE", ["SEX", "LENGTH"])
    assert rows(widen(long, *args, distinct=True)) == rows(widen(long.distinct(), *args))


def _shuffle_bytes(spark):
    """Bytes of shuffle files in the local folders of the test's session."""
    local = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return sum(os.path.getsize(f) for d in local for f in glob.glob(f"{d}/*/shuffle_*.data"))


def test_steps_leave_no_shuffles_or_old_tables(spark):
    before, setting = _shuffle_bytes(spark), spark.conf.get(FREE_SHUFFLES)
    steps = Steps(spark, "test")
    first = steps.store(spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("x")).repartition(8, "id"), "first")
    second = steps.store(first.withColumn("double", F.col("id") * 2), "second", drop=["first"])
    for _ in range(50):                                  # files go in the background
        if _shuffle_bytes(spark) - before < 1_000_000:
            break
        time.sleep(0.2)
    assert _shuffle_bytes(spark) - before < 1_000_000    # the texts shuffled are 13 MB
    assert second.agg(F.sum("double")).first()[0] == 200_000 * 199_999
    assert os.listdir(steps.base) == ["second"] and spark.conf.get(FREE_SHUFFLES) == setting


def test_drops_are_compressed_in_short_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(PR, "PART_ROWS", 10)
    PR._write(spark.range(25).coalesce(1).select(F.col("id").cast("string").alias("HAUL_ID")), str(tmp_path), "T_HAUL_0001.csv", SC.RAW_HAUL)
    parts = glob.glob(f"{tmp_path}/T_HAUL_0001.csv/part-*.csv.gz")
    assert sorted(len(gzip.open(p, "rt").readlines()) - 1 for p in parts) == [5, 10, 10]
    assert read_drop(spark, str(tmp_path), "_HAUL_0", SC.RAW_HAUL).agg(F.sum(F.col("HAUL_ID").cast("int"))).first()[0] == 300
