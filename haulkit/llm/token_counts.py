"""Token counts of whole texts under a unigram vocabulary, without writing tokens.

Pre-tokens of a block of texts are reduced to the distinct ones, inserted in a trie, and
forward scores are computed once per node, so shared prefixes are scored once; the node
at which a pre-token ends holds its number of tokens, and a text's count is a sum of these.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulkit.llm.lattice import forward, load, pieces, pretokens
from haulkit.llm.shared import SMALL, Powers, blocks, small_batches, text_of

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate((np.zeros(1, values.dtype), np.cumsum(values)))
    return total[bounds[1:]] - total[bounds[:-1]]


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id_col, n_pretokens, n_tokens, score (of the best segmentation).

    A null or empty text has none and scores 0.  The vocabulary is read on the driver
    and broadcast; its size does not depend on the data.  A long text is counted in
    pieces, cut between pre-tokens.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(load(vocabulary))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, v = Powers(), shared.value
        for batch in blocks(batches, size=SMALL):
            n, tokens, score = 0, 0, 0.0
            for strings in pieces(batch, 1, SMALL):
                p = pretokens(strings, v, powers)
                t = forward(p, v)
                n = n + np.diff(p.texts)
                tokens, score = tokens + sums(t.tokens[t.leaf][p.which], p.texts), score + sums(t.best[t.leaf][p.which], p.texts)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(tokens, pa.int64()), pa.array(score)],
                                             ["id", "n_pretokens", "n_tokens", "score"])

    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(task, f"id {kind}, n_pretokens long, n_tokens long, score double").withColumnRenamed("id", id_col)


def op4_token_counts(spark, sf_dir: str) -> DataFrame:
    """Tokens of every row of ``documents`` under the 32k piece vocabulary."""
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
