"""Exact duplicates by progressive refinement: length, then hash of a prefix, then hash of the whole text.

Each step reads more of a text, and only of the texts whose group still has two
members.  What survives a step goes to the next as a key filter of fixed size
(``shared.filter_pages``), so no text is ever shuffled: only lengths and hashes are.
A false "maybe" of the filter costs one more hash; groups come from the full hash alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulkit.llm.shared import filter_pages, materialise, maybe_in, text_of


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = 64,
                filter_bits: int = 24, extra: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: id_col, keep_id, group_size, kept, full_hash, and ``extra`` columns.

    Texts are equal when their bytes are; a null text counts as empty.  The row
    with the largest id stays (a null id is smaller than any other); of rows
    with that same id and text one stays, whichever.  ``full_hash`` is the SHA-256
    of the text where the text had to be read whole, else null: such a text is unique.
    ``extra`` holds expressions over ``docs``, computed in the last scan.  An empty
    table gives an empty one; other columns of ``docs`` are not read.
    """
    text = text_of(text_col)
    size = F.octet_length(text)
    by_size = (docs.select(size.alias("size")).groupBy("size").count().filter("count > 1")
               .select(F.xxhash64("size").alias("key")))
    sized = maybe_in(docs.withColumns({"__size": size, "__key": F.xxhash64(size)}), "__key",
                     filter_pages(by_size, "key", filter_bits), filter_bits, "__more")

    start = F.xxhash64(F.left(text, F.lit(prefix)))
    by_start = (sized.filter("__more").select("__size", start.alias("start")).groupBy("__size", "start").count()
                .filter("count > 1").select(F.xxhash64("__size", "start").alias("key")))
    started = maybe_in(sized.withColumn("__key", F.when(F.col("__more"), F.xxhash64("__size", start))), "__key",
                       filter_pages(by_start, "key", filter_bits), filter_bits, "__whole")

    rows = materialise(started.select(
        F.col(id_col), F.when(F.col("__whole"), F.sha2(text.cast("binary"), 256)).alias("full_hash"),
        F.monotonically_increasing_id().alias("__place"),
        *(column.alias(name) for name, column in (extra or {}).items())), "exact-hashes")
    # one row of each group, the copies of which are joined with it: that join Spark splits where a group is large
    stays = F.max(F.struct(F.col(id_col).alias("id"), F.col("__place").alias("place")))
    groups = materialise(rows.filter("full_hash is not null").groupBy("full_hash").agg(stays.alias("__stays"), F.count("*").alias("group_size")), "exact-groups")
    grouped = rows.join(groups, "full_hash").select(
        id_col, F.col("__stays.id").alias("keep_id"), F.col("group_size").cast("long").alias("group_size"),
        (F.col("__place") == F.col("__stays.place")).alias("kept"), "full_hash", *(extra or {}))
    alone = rows.filter("full_hash is null").select(
        id_col, F.col(id_col).alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "full_hash", *(extra or {}))
    return grouped.unionByName(alone)


def op10_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """Every row of ``documents``: the row that stays for its text, the size of its group, and the text's SHA-256."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return exact_dedup(docs, extra={"text_sha256": F.sha2(text_of().cast("binary"), 256)}).drop("full_hash")


OP10_SQL = """
WITH t AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM t JOIN g USING (text_sha256)
"""
