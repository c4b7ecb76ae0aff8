"""Incremental reading of the drop folders (Structured Streaming).

The survey reruns everything in batch; when drops arrive during a cruise the
same products can be kept current incrementally.  A drop folder is a file
stream with the drop's explicit schema.  Each micro-batch appends its additive
per-lift partial aggregates (`catch.class_partials`) to a table in the shared
checkpoint area, overwriting only its own `batch_id` partition, so a retried
batch replaces itself (exactly-once with the stream checkpoint).  Finished
totals sum the partials, which is exact whether a lift's specimens arrive in
one drop or several.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import catch as C
from ..sources.drops import CSV_OPTIONS

# Columns of a drop file at most (the widest known kind has 19); a wider header raises.
MAX_COLUMNS = 64


def read_drop_stream(spark: SparkSession, folder: str, glob: str, schema: StructType, fmt: str = "csv",
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """A1 as a stream: files in `folder` matching `glob`, with an explicit schema.

    CSV drops are aligned by NAME, as in batch: each file comes as one text, its
    first line names the cells of the others, and columns it lacks are NULL.
    (A positional read would shift values.)  Quoted cells may hold commas but no
    line breaks; a drop file must fit one row.  A header of more than MAX_COLUMNS
    names raises."""
    r = spark.readStream.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if fmt != "csv":
        return r.schema(schema).format(fmt).load(folder)
    lines = F.split(F.regexp_replace("value", "^\ufeff", ""), "\r?\n")
    rows = (r.format("text").option("wholetext", "true").load(folder)
            .select(F.element_at(lines, 1).alias("header"), F.explode(F.slice(lines, 2, F.size(lines))).alias("line"))
            .where(F.col("line") != ""))
    cells = ", ".join(f"c{i} string" for i in range(MAX_COLUMNS))

    def parsed(c):
        s = F.from_csv(c, cells, {"mode": "PERMISSIVE", "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"})
        return F.array(*[s[f"c{i}"] for i in range(MAX_COLUMNS)])
    width = F.size(F.split(F.regexp_replace("header", '"[^"]*"', ""), ","))
    wide = F.raise_error(F.concat(F.lit(f"a drop has more than {MAX_COLUMNS} columns: "), width.cast("string")))
    rows = rows.select(F.when(width > MAX_COLUMNS, wide).otherwise(parsed(F.col("header"))).alias("names"), parsed(F.col("line")).alias("cells"))

    def cell(field):
        at = F.array_position("names", F.lit(field.name)).cast("int")
        text = F.when(at > 0, F.get("cells", at - 1))
        return F.when(text != CSV_OPTIONS["nullValue"], text).try_cast(field.dataType).alias(field.name)
    return rows.select(*[cell(f) for f in schema.fields])


def append_partials(stream: DataFrame, partials: Callable[[DataFrame], DataFrame], table_path: str,
                    checkpoint: str, available_now: bool = True):
    """Start the incremental job: every micro-batch's partial aggregates are
    written to `table_path/batch_id=<id>` (dynamic partition overwrite)."""
    def write(batch: DataFrame, batch_id: int):
        (partials(batch).withColumn("batch_id", F.lit(batch_id))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(table_path))

    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def class_totals_from_partials(spark: SparkSession, table_path: str, unit_keys: Sequence[str],
                               classes: Mapping[str, Column], class_samples: Mapping[str, Mapping[str, object]]) -> DataFrame:
    parts = spark.read.parquet(table_path).drop("batch_id")
    return C.finish_class_totals(parts, unit_keys, classes, class_samples, combine=True)
