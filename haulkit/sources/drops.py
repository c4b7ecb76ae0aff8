"""Sources and sinks: folders of per-haul CSV drops (A1, A2), single sheets
(A3), products by survey (A4-A6), polygon layers (A7), place names (A8).

File listing goes through the Hadoop FileSystem API of the session, so the same
code reads local folders, HDFS or object stores.  File names and the first line
of each file reach the driver.
"""

from __future__ import annotations

import csv
import fnmatch
import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CSV_OPTIONS = {"header": "true", "nullValue": "NA", "mode": "PERMISSIVE", "enforceSchema": "false"}
HEADER_THREADS = 16


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def list_drops(spark: SparkSession, folder: str, pattern: str) -> list[str]:
    """Files in `folder` whose name contains `pattern` (a regex, as R's
    list.files pattern) or matches it as a glob.  A drop may also be a folder
    of part files, as Spark writes them: then the folder's name counts."""
    p, fs = _fs(spark, folder)
    out = []
    rx = re.compile(pattern)
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name[0] in "._" or not (rx.search(name) or fnmatch.fnmatch(name, pattern)):
            continue
        inner = fs.listStatus(st.getPath()) if st.isDirectory() else [st]
        out += [f.getPath().toString() for f in inner if f.isFile() and f.getPath().getName()[0] not in "._"]
    return sorted(out)


def _first_line(spark: SparkSession, file: str) -> str | None:
    """The first line of a file, decompressed by its extension as Spark does; None for an empty one."""
    io, conf = spark.sparkContext._jvm.java.io, spark.sparkContext._jsc.hadoopConfiguration()
    p, fs = _fs(spark, file)
    codec, stream = spark.sparkContext._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(p), fs.open(p)
    reader = io.BufferedReader(io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
    try:
        return reader.readLine()
    finally:
        reader.close()


def headers(spark: SparkSession, files: list[str]) -> dict[str, list[str]]:
    """Files by header line.  Only the first block of a file is read and its first
    line decoded: a job over the files would read them whole, as compressed files
    have one block.  Empty files have no header and are left out."""
    out: dict[str, list[str]] = {}
    with ThreadPoolExecutor(HEADER_THREADS) as pool:
        for file, line in zip(files, pool.map(lambda f: _first_line(spark, f), files)):
            if line is not None:
                out.setdefault(line.lstrip("\ufeff"), []).append(file)
    return {line: sorted(out[line]) for line in sorted(out)}


def _split_header(line: str) -> list[str]:
    """Column names of a header; quoted names may hold commas."""
    return [c.strip() for c in next(csv.reader([line.strip()], skipinitialspace=True))]


def read_drop(spark: SparkSession, folder: str, pattern: str, schema: StructType,
              by_header: bool = True, lineage: bool = True, corrupt: str | None = None) -> DataFrame:
    """A1 + A2: every drop file of one kind as one DataFrame, columns aligned
    by NAME (files may lack columns or order them differently).

    Files are grouped by header line; each group is read with the schema
    restricted to its columns in its order (a positional CSV read would shift
    values into the wrong columns), then groups are unioned by name with the
    missing columns NULL.  `SOURCE_FILE` keeps per-row lineage.  A cell that
    does not parse is NULL; `corrupt` names a column that then holds the whole
    line (see `corrupt_rows`)."""
    files = list_drops(spark, folder, pattern)
    types = {f.name: f for f in schema.fields}
    if not files:
        return spark.createDataFrame([], schema)
    groups: dict[tuple, list[str]] = {}
    if by_header:
        for line, paths in headers(spark, files).items():
            groups.setdefault(tuple(_split_header(line)), []).extend(paths)
        if not groups:
            return spark.createDataFrame([], schema)
    else:
        groups[tuple(schema.fieldNames())] = files
    parts = []
    for cols, paths in groups.items():
        sub = StructType([types[c] for c in cols if c in types])
        known = [c for c in cols if c in types]
        if len(known) != len(cols):       # unknown columns: read as strings, then drop
            sub = StructType([types.get(c, StructField(c, StringType(), True)) for c in cols])
        options = CSV_OPTIONS
        if corrupt:
            sub, options = StructType([*sub.fields, StructField(corrupt, StringType(), True)]), CSV_OPTIONS | {"columnNameOfCorruptRecord": corrupt}
        df = spark.read.options(**options).schema(sub).csv(paths)
        if lineage:
            df = df.withColumn("SOURCE_FILE", F.col("_metadata.file_name"))
        parts.append(df.select(*known, *([corrupt] if corrupt else []), *(["SOURCE_FILE"] if lineage else [])))
    out = parts[0]
    for p_ in parts[1:]:
        out = out.unionByName(p_, allowMissingColumns=True)
    order = ([c for c in schema.fieldNames() if c in out.columns] + ([corrupt] if corrupt else [])
             + (["SOURCE_FILE"] if lineage else []))
    missing = [F.lit(None).cast(types[c].dataType).alias(c) for c in schema.fieldNames() if c not in out.columns]
    return out.select(*order, *missing)


def corrupt_rows(spark: SparkSession, folder: str, pattern: str, schema: StructType) -> DataFrame:
    """Rows of the drops with a cell that does not parse, and LINE as it stands
    in the file.  All columns are returned: Spark parses only what is read."""
    rows = read_drop(spark, folder, pattern, schema, corrupt="LINE")
    return rows.where(F.col("LINE").isNotNull()) if "LINE" in rows.columns else rows.limit(0)


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A3: one CSV sheet with an explicit schema ("NA" is NULL)."""
    return spark.read.options(**CSV_OPTIONS).schema(schema).csv(path)


def write_product(df: DataFrame, base: str, name: str, survey: str, fmt: str = "parquet") -> str:
    """A5: write a product under base/name partitioned by survey id; only the
    given survey's partition is replaced."""
    path = f"{base.rstrip('/')}/{name}"
    (df.withColumn("survey", F.lit(str(survey)))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .option("header", "true").partitionBy("survey").format(fmt).save(path))
    return path


def load_product(spark: SparkSession, base: str, name: str, survey: str | None = None,
                 fmt: str = "parquet", schema: StructType | None = None) -> DataFrame:
    """Read a product back (partition pruned to one survey)."""
    r = spark.read.format(fmt)
    if fmt == "csv":
        r = r.options(**CSV_OPTIONS)
    if schema is not None:
        r = r.schema(schema)
    df = r.load(f"{base.rstrip('/')}/{name}")
    return df.where(F.col("survey") == str(survey)) if survey is not None else df


def load_polygons(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A polygon layer as a vertex table (poly_id, ring, seq, x, y)."""
    from .schemas import POLYGON_VERTICES
    if fmt == "csv":
        return read_table(spark, path, POLYGON_VERTICES)
    return spark.read.parquet(path).select(*POLYGON_VERTICES.fieldNames())


def placenames(spark: SparkSession, path: str, type_: str | None = None, region: str | None = None) -> DataFrame:
    """Place-name points filtered by type and region."""
    from .schemas import PLACENAMES
    df = read_table(spark, path, PLACENAMES)
    if type_ is not None:
        df = df.where(F.col("type") == type_)
    if region is not None:
        df = df.where(F.col("region") == region)
    return df
