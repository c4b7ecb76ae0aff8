"""Incremental drops: partials appended per micro-batch sum to the batch totals."""

import os
import tempfile

import pytest
from pyspark.sql.types import IntegerType, StructType

from haulkit import constants as K
from haulkit.operators import catch as C
from haulkit.streaming.drops import append_partials, class_totals_from_partials, read_drop_stream
from tests.test_catch import SCHEMA, SPEC


def test_stream_partials_equal_batch_totals(spark):
    root = tempfile.mkdtemp(prefix="stream-")
    drops = os.path.join(root, "drops")
    # lift 1's rows are split over two drop files -> two micro-batches
    for i, part in enumerate((SPEC[:3], SPEC[3:6], SPEC[6:])):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(os.path.join(root, f"tmp{i}"))
        src = [f for f in os.listdir(os.path.join(root, f"tmp{i}")) if f.endswith(".parquet")][0]
        os.makedirs(drops, exist_ok=True)
        os.rename(os.path.join(root, f"tmp{i}", src), os.path.join(drops, f"drop_{i}_SPECIMEN.parquet"))
    flags = C.maturity_flags("SPECIES_CODE", "SEX", "LENGTH", "CLUTCH_SIZE", K.RED_KING_CRAB,
                             K.MATURE_MALE_MM, K.LEGAL_MALE_MM)
    samples = C.maturity_samples(K.RED_KING_CRAB)
    stream = read_drop_stream(spark, drops, "*_SPECIMEN.parquet", spark.createDataFrame(SPEC, SCHEMA).schema,
                              fmt="parquet", max_files_per_trigger=1)
    q = append_partials(stream, lambda b: C.class_partials(b, ["SPN"], "TOSSED", flags, samples),
                        os.path.join(root, "partials"), os.path.join(root, "_ckpt"))
    q.awaitTermination()
    assert spark.read.parquet(os.path.join(root, "partials")).select("batch_id").distinct().count() == 3
    got = {r["SPN"]: r.asDict() for r in class_totals_from_partials(
        spark, os.path.join(root, "partials"), ["SPN"], flags, samples).collect()}
    ref = {r["SPN"]: r.asDict() for r in C.class_totals(spark.createDataFrame(SPEC, SCHEMA), ["SPN"],
                                                         ["SPECIES_CODE", "SEX"], "TOSSED", flags).collect()}
    assert set(got) == set(ref)
    for spn in ref:
        for c in K.MAT_SEX_CATEGORIES:
            assert (got[spn][c] is None) == (ref[spn][c] is None)
            if ref[spn][c] is not None:
                assert got[spn][c] == pytest.approx(ref[spn][c])


def test_csv_drop_stream_totals(spark):
    from haulkit.sources.schemas import RAW_SAMPLE_VALUES
    root = tempfile.mkdtemp(prefix="csvstream-")
    drops = os.path.join(root, "drops")
    os.makedirs(drops)
    hdr = "HAUL_ID,CATCH_SAMPLE_VALUE_ID,CATCH_SAMPLE_ID,COUNT,WEIGHT,KEEP,RECORDING_DEVICE,RECORDER"
    for i, body in enumerate((["h1,v1,s1,2,1.0,N,d,me", "h1,v2,s1,NA,1.0,N,d,me"], ["h1,v3,s1,3,1.0,N,d,me"])):
        with open(os.path.join(drops, f"R_SAMPLE_VALUES_{i}.csv"), "w") as f:
            f.write("\n".join([hdr] + body) + "\n")
    stream = read_drop_stream(spark, drops, "*_SAMPLE_VALUES_*.csv", RAW_SAMPLE_VALUES, max_files_per_trigger=1)
    q = append_partials(stream, lambda b: C.tossed_totals(b), os.path.join(root, "tossed"), os.path.join(root, "_ck"))
    q.awaitTermination()
    parts = spark.read.parquet(os.path.join(root, "tossed"))
    assert parts.select("batch_id").distinct().count() == 2
    total = parts.groupBy("HAUL_ID", "CATCH_SAMPLE_ID", "RECORDING_DEVICE").sum("TOSSED").collect()
    assert [tuple(r) for r in total] == [("h1", "s1", "d", 5)]


def test_streamed_drop_that_lacks_a_column_is_aligned_by_name(spark):
    from haulkit.sources.schemas import RAW_SAMPLE_VALUES
    root = tempfile.mkdtemp(prefix="csvstream-")
    drops = os.path.join(root, "drops")
    os.makedirs(drops)
    with open(os.path.join(drops, "R_SAMPLE_VALUES_1.csv"), "w") as f:      # no COUNT, other order, a column of its own
        f.write('WEIGHT,HAUL_ID,EXTRA,KEEP,RECORDING_DEVICE\n7,h1,"x, y",Y,dev\nNA,h2,,N,dev\n')
    stream = read_drop_stream(spark, drops, "*_SAMPLE_VALUES_*.csv", RAW_SAMPLE_VALUES)
    q = append_partials(stream, lambda b: b, os.path.join(root, "out"), os.path.join(root, "_ck"))
    q.awaitTermination()
    got = {r["HAUL_ID"]: r for r in spark.read.schema(RAW_SAMPLE_VALUES).parquet(os.path.join(root, "out")).collect()}
    assert got["h1"]["WEIGHT"] == 7.0 and got["h1"]["COUNT"] is None and got["h1"]["KEEP"] == "Y" and got["h1"]["RECORDING_DEVICE"] == "dev"
    assert got["h2"]["WEIGHT"] is None


@pytest.mark.parametrize("columns", [64, 70])
def test_wide_drop_raises_instead_of_losing_columns(spark, columns):
    from pyspark.errors import StreamingQueryException
    root = tempfile.mkdtemp(prefix="widestream-")
    os.makedirs(os.path.join(root, "drops"))
    with open(os.path.join(root, "drops", "wide_0.csv"), "w") as f:
        f.write(",".join(['"A,B"', *(f"X{i}" for i in range(2, columns)), "LAST"]) + "\n" + ",".join(map(str, range(columns))) + "\n")
    stream = read_drop_stream(spark, os.path.join(root, "drops"), "*.csv", StructType().add("LAST", IntegerType()))
    q = append_partials(stream, lambda b: b, os.path.join(root, "out"), os.path.join(root, "_ck"))
    if columns > 64:
        with pytest.raises(StreamingQueryException, match="more than 64 columns"):
            q.awaitTermination()
    else:
        q.awaitTermination()
        assert [r.LAST for r in spark.read.parquet(os.path.join(root, "out")).collect()] == [columns - 1]
