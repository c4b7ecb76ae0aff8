"""A pipeline from raw documents to token ids: five stages, each one operator of ``haulkit.llm``.

Each stage is given all that the one before it kept and returns the columns of
``documents``; the last returns token ids.  Rows with a null id or text, empty texts and
repeated rows go through as the operators say; a column that is not one of
``documents`` is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulkit.llm.exact_dedup import exact_dedup
from haulkit.llm.minhash import near_duplicates
from haulkit.llm.mixing import clean_share, mix_sources
from haulkit.llm.quality import quality_rules
from haulkit.llm.sentencepiece_nbest import encode
from haulkit.llm.shared import WORD, discard, materialise, text_of, with_copies, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _kept(docs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose verdict (doc_id, mark, kept) is to stay."""
    copies = verdicts.select(F.col("doc_id").alias("id"), "mark", F.col("kept").cast("int").alias("copies"))
    return with_copies(docs.select(*COLUMNS), copies)


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that they reject go."""
    return _kept(docs, quality_rules(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: of equal texts the row with the largest id stays."""
    return _kept(docs, exact_dedup(docs, extra={"mark": F.xxhash64(text_of())}))


def unlike_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: of texts linked by 80 % of their five-word shingles the smallest id stays."""
    return _kept(docs, near_duplicates(docs))


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing sources: each document as often as the mix takes it, so 0 to 2 times."""
    sized = docs.withColumn("__size", F.regexp_count(text_of(), F.lit(WORD)))
    mix = mix_sources(sized, F.col("__size"), clean_share(F.col("__size")), carry={"mark": F.xxhash64(text_of())})
    return with_copies(docs.select(*COLUMNS), mix.select(F.col("doc_id").alias("id"), "mark", "copies"))


def encoded_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece: token ids, their number, the score, and the next best segmentations of each document."""
    return encode(docs, carry=("lang", "source")).withColumn("n_pieces", F.size("ids"))


STAGES = [
    ("quality rules", good_documents),
    ("exact dedup", distinct_documents),
    ("MinHash near-dedup", unlike_documents),
    ("mixing sources", mixed_documents),
    ("SentencePiece encoding", encoded_documents),
]
#: No SQL for the thresholds, MinHash links and the lattice; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again by the next.

    When a stage is written, the tables that it and the stages before it used are deleted.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), written()
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        discard(spark, before)
    return docs
