"""Versioned snapshots of products.

A product of a survey is written to a folder of its own and published by renaming a
manifest into place, so readers see the whole snapshot or none: a writer that dies leaves the
versions before it as they were.  Versions count from 1 per product and survey; two writers
that meet get different numbers, as a manifest is never replaced.  Files go through the
Hadoop FileSystem API of the session.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .drops import _fs


def _manifests(base: str, name: str, survey: str) -> str:
    return f"{base.rstrip('/')}/{name}/_manifests/{survey}"


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    p, fs = _fs(spark, path)
    out = fs.create(p, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def versions(spark: SparkSession, base: str, name: str, survey: str) -> list[int]:
    """Published versions, ascending."""
    p, fs = _fs(spark, _manifests(base, name, survey))
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p)]
    return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))


def publish(df: DataFrame, base: str, name: str, survey: str) -> int:
    """Write a snapshot and publish it as the next version, which is returned."""
    spark, survey = df.sparkSession, str(survey)
    data = f"{base.rstrip('/')}/{name}/data/{survey}-{uuid.uuid4().hex}"
    df.write.parquet(data)
    folder = _manifests(base, name, survey)
    _, fs = _fs(spark, folder)
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(path_of(folder))
    staged = f"{folder}/_{uuid.uuid4().hex}"
    _write_text(spark, staged, json.dumps({"data": data, "schema": json.loads(df.schema.json())}))
    version = (versions(spark, base, name, survey) or [0])[-1] + 1
    while True:
        target = path_of(f"{folder}/v{version}.json")
        if not fs.exists(target) and fs.rename(path_of(staged), target):
            return version
        if not fs.exists(target):
            raise OSError(f"can't publish {target}")
        version += 1


def snapshot(spark: SparkSession, base: str, name: str, survey: str, version: int | None = None) -> DataFrame:
    """A published version of a product, the latest by default; raises where there is none."""
    survey = str(survey)
    known = versions(spark, base, name, survey)
    if not known or version is not None and version not in known:
        raise FileNotFoundError(f"{name} of survey {survey}: no version {version or ''}; there are {known}")
    row = spark.read.text(f"{_manifests(base, name, survey)}/v{version or known[-1]}.json", wholetext=True).first()
    manifest = json.loads(row[0])
    return spark.read.schema(StructType.fromJson(manifest["schema"])).parquet(manifest["data"])


def prior(spark: SparkSession, base: str, name: str, survey: str) -> DataFrame | None:
    """The version before the latest, None where there is only one."""
    known = versions(spark, base, name, survey)
    return snapshot(spark, base, name, survey, known[-2]) if len(known) > 1 else None


def changes(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that differ between two snapshots: keys, CHANGE ('added', 'removed', 'changed'), and both sides' columns as OLD_ and NEW_.

    Keys may be NULL and must be unique in each snapshot; a NULL differs from any value."""
    values = [c for c in after.columns if c not in keys]

    def side(df: DataFrame, prefix: str) -> DataFrame:
        return df.select(*[F.col(k).alias(f"__{prefix}{k}") for k in keys], *[F.col(c).alias(f"{prefix}{c}") for c in values], F.lit(True).alias(f"__{prefix}"))
    on = None
    for k in keys:
        same = F.col(f"__OLD_{k}").eqNullSafe(F.col(f"__NEW_{k}"))
        on = same if on is None else on & same
    j = side(before, "OLD_").join(side(after, "NEW_"), on, "full")
    differ = F.lit(False)
    for c in values:
        differ = differ | ~F.col(f"OLD_{c}").eqNullSafe(F.col(f"NEW_{c}"))
    change = F.when(F.col("__OLD_").isNull(), "added").when(F.col("__NEW_").isNull(), "removed").when(differ, "changed")
    named: Iterator = (F.when(F.col("__NEW_").isNull(), F.col(f"__OLD_{k}")).otherwise(F.col(f"__NEW_{k}")).alias(k) for k in keys)
    return (j.withColumn("CHANGE", change).where("CHANGE IS NOT NULL")
            .select(*named, "CHANGE", *[f"{p}{c}" for p in ("OLD_", "NEW_") for c in values]))


__all__ = ["publish", "versions", "snapshot", "prior", "changes"]
