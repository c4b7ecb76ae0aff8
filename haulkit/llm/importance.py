"""Importance resampling towards a target distribution, with exact selection by weighted medians of medians.

Features are runs of words, hashed into a fixed number of buckets.  A bucket's gain is the
log ratio of its smoothed shares in target and corpus; a document's weight is the sum of
the gains of its features, read from an array by bucket.  Gumbel noise that the id fixes
is added, and the highest scores are drawn: sampling without replacement by weight.

The cutoff is found without a global sort.  Each group of remaining keys gives its median
and its size; the median of these medians, weighted by size, is better than a quarter of
the remaining keys at least and worse than another quarter at least.  Counting the keys
on its two sides tells which side holds the cutoff; the other is discarded, and what
remains is written again.  Only the winners are sorted.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulkit.llm.hash_tree import BYTES_OF, CRC_OF, CRC_TABLE
from haulkit.llm.shared import blocks, flat, materialise, text_of

#: Bytes of text and number of words that a task turns into arrays at a time.
BLOCK = 512 << 10
WORDS = 1 << 17
#: Words above this length are hashed one by one.
LONG_WORD = 64
#: Keys of one group; the driver sees one median per group, a millionth of the keys.
GROUP = 1 << 20
#: So many remaining keys are sorted instead.
LAST = 1000

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_CRC = _crc_table()


def crc_after(state: np.ndarray, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of byte strings that end with data[start:start + size], from that of what stands before; 0 for nothing."""
    order = np.argsort(-size, kind="stable")
    s, n, x = start[order], size[order], ~state[order]
    long = int(np.searchsorted(-n, -LONG_WORD, "left"))
    for i in range(long):
        x[i] = ~np.uint32(zlib.crc32(data[s[i]:s[i] + n[i]].tobytes(), int(~x[i])))
    s, rest = s[long:], x[long:]
    alive = np.searchsorted(-n[long:], -np.arange(int(n[long]) if long < len(n) else 0), "left")
    for k, m in enumerate(alive):
        y = rest[:m]
        rest[:m] = _CRC[(y ^ data[s[:m] + k]) & np.uint32(255)] ^ (y >> np.uint32(8))
    out = np.empty_like(x)
    out[order] = ~x
    return out


def features(texts: pa.Array, low: int, high: int, buckets: int) -> tuple[np.ndarray, Iterator[tuple[np.ndarray, np.ndarray]]]:
    """Number of words of each text, and pieces (text, bucket) of all runs of low to high words, ascending by text in a piece."""
    data, bounds = flat(texts)
    data = _FOLD[data]
    inside = _IN_WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, bounds)
    n_words = np.diff(first)

    def pieces():
        blank = np.array([32], np.uint8)
        for at in range(0, len(start), WORDS):
            i = np.arange(at, min(at + WORDS, len(start)))
            doc = np.searchsorted(first, i, "right") - 1
            state = np.zeros(len(i), np.uint32)
            for n in range(1, high + 1):
                last = i + (n - 1)
                fits = last < first[doc + 1]
                i, doc, last, state = i[fits], doc[fits], last[fits], state[fits]
                if not len(i):
                    break
                if n > 1:
                    state = crc_after(state, blank, np.zeros(len(i), np.int64), np.ones(len(i), np.int64))
                state = crc_after(state, data, start[last], end[last] - start[last])
                if n >= low:
                    yield doc, (state % np.uint32(buckets)).astype(np.int64)

    return n_words, pieces()


def bucket_counts(docs: DataFrame, text_col: str = "text", low: int = 1, high: int = 1, buckets: int = 10000) -> DataFrame:
    """(bucket, n): features in each bucket over all rows; a task sends one row per bucket at most."""
    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in blocks(batches, "text", BLOCK):
            for _, bucket in features(batch.column(0), low, high, buckets)[1]:
                total += np.bincount(bucket, minlength=buckets)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(total[found])], ["bucket", "n"])

    return docs.select(F.col(text_col).alias("text")).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains_of(corpus: DataFrame, target: DataFrame, buckets: int, scale: int = 1000) -> np.ndarray:
    """floor(scale * ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))) of each bucket; the driver gets one row per bucket of each side."""
    counts = np.zeros((2, buckets), np.int64)
    for k, side in enumerate((corpus, target)):
        for bucket, n in side.toLocalIterator():
            counts[k, bucket] = n
    s_all, t_all = float(counts[0].sum()), float(counts[1].sum())
    return np.array([math.floor(scale * math.log((t + 1.0) * (s_all + buckets) / ((s + 1.0) * (t_all + buckets))))
                     for s, t in zip(*counts.tolist())], np.int64)


def weights(docs: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text_col: str = "text", low: int = 1, high: int = 1) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_features, weight.  The gains go to the tasks: 8 bytes per bucket."""
    def score(batches):
        for batch in blocks(batches, "text", BLOCK):
            n_words, pieces = features(batch.column(1), low, high, len(gains))
            n, weight = np.zeros((2, len(n_words)), np.int64)
            for doc, bucket in pieces:
                total = np.concatenate(([0], np.cumsum(gains[bucket])))
                found, begin = np.unique(doc, return_index=True)
                stop = np.append(begin[1:], len(doc))
                n[found] += stop - begin
                weight[found] += total[stop] - total[begin]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words.astype(np.int64)), pa.array(n), pa.array(weight)],
                                             ["id", "n_words", "n_features", "weight"])

    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(score, f"id {narrow.schema['id'].dataType.simpleString()}, n_words long, n_features long, weight long")


def gumbel(id_col: str, seed: int, scale: int = 1000) -> Column:
    """floor(-scale * ln(-ln(u))), u from the first 32 bits of sha256(seed:id); a null id counts as ''."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-float(scale)) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


# ---- selection: keys (score, id, place), best first --------------------------------------------------------------

_ORDER = [("score", "descending"), ("id", "ascending"), ("place", "ascending")]


def best_first() -> list[Column]:
    return [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("place").asc()]


def better(key: tuple) -> Column:
    """Whether a row's key comes before ``key``; a null id comes after all others."""
    score, i, place = key
    earlier = F.col("id").isNotNull() if i is None else F.coalesce(F.col("id") < F.lit(i), F.lit(False))
    tied = earlier | (F.col("id").eqNullSafe(F.lit(i)) & (F.col("place") < place))
    return (F.col("score") > score) | ((F.col("score") == score) & tied)


def _sorted(table: pa.Table) -> pa.Table:
    return table.take(pc.sort_indices(table, sort_keys=_ORDER, null_placement="at_end"))


def _medians(group: int):
    def medians(batches):
        held, size = [], 0

        def middle():
            table = pa.Table.from_batches(held)
            row = _sorted(table).slice((size - 1) // 2, 1)
            return row.append_column("size", pa.array([size], pa.int64())).to_batches()[0]

        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, group - size)
                held.append(part)
                size += part.num_rows
                batch = batch.slice(part.num_rows)
                if size == group:
                    yield middle()
                    held, size = [], 0
        if size:
            yield middle()

    return medians


def cutoff(rows: DataFrame, k: int, group: int = GROUP, last: int = LAST) -> tuple | None:
    """The key of the k-th best of ``rows`` (score, id, place), None where k < 1 or there are fewer.

    place must be unique.  Groups are of ``group`` keys at most; per round the driver gets one
    key of each.  Each round leaves three quarters of the keys at most.
    """
    rows = materialise(rows.select("score", "id", "place"), "keys")
    n = rows.count()
    if not 1 <= k <= n:
        return None
    schema = f"score long, id {rows.schema['id'].dataType.simpleString()}, place long, size long"
    while n > last:
        medians = _sorted(rows.mapInArrow(_medians(group), schema).toArrow())
        weight = np.cumsum(medians.column("size").to_numpy())
        at = int(np.searchsorted(weight, (n + 1) // 2))
        pivot = tuple(medians.column(c)[at].as_py() for c in ("score", "id", "place"))
        ahead = rows.filter(better(pivot)).count()
        if k == ahead + 1:
            return pivot
        if k <= ahead:
            rows, n = rows.filter(better(pivot)), ahead
        else:
            rows, n, k = rows.filter(~better(pivot) & (F.col("place") != pivot[2])), n - ahead - 1, k - ahead - 1
        rows = materialise(rows, "keys")
    return tuple(rows.orderBy(*best_first()).offset(k - 1).first())


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with rank 1, 2, 3..., best first: sorted by ranges of keys, each range counted on from those before it."""
    order = best_first()
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = materialise(ranged.withColumn("__at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("__at", 33)
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (ranged.groupBy(part.alias("__part")).agg(F.count("*").alias("n"))
              .select("__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__start")))
    rank = F.col("__start") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return ranged.withColumn("__part", part).join(starts, "__part").withColumn("rank", rank).drop("__part", "__start", "__at")


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, low: int = 1, high: int = 1,
             buckets: int = 10000, seed: int = 2024, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id_col, n_words, n_features, weight, score, rank.

    Of the rows with ``least_words`` words or more, percent of them (rounded down) with the highest scores
    get ranks 1, 2, 3...; ties go to the smaller id, a null id last, and rows that repeat an
    id take neighbouring ranks.  Others have a null rank.  Null and empty texts have no words, weight 0, and
    are not drawn.  An empty ``target`` counts as no features; an empty ``docs`` gives an empty table.  Other columns are not read.
    """
    gains = gains_of(bucket_counts(docs, text_col, low, high, buckets), bucket_counts(target, target_text, low, high, buckets), buckets)
    scored = weights(docs, gains, id_col, text_col, low, high).withColumn("score", F.col("weight") + gumbel("id", seed))
    rows = materialise(scored.withColumn("place", F.monotonically_increasing_id()), "scores")
    long_enough = F.col("n_words") >= least_words
    key = cutoff(rows.filter(long_enough), rows.filter(long_enough).count() * percent // 100)
    drawn = F.lit(False) if key is None else long_enough & (better(key) | (F.col("place") == key[2]))
    out = numbered(rows.filter(drawn)).unionByName(rows.filter(~drawn).withColumn("rank", F.lit(None).cast("long")))
    return out.select(F.col("id").alias(id_col), "n_words", "n_features", "weight", "score", "rank")


def op13_importance(spark, sf_dir: str) -> DataFrame:
    """All ``documents``, a tenth of those with 20 words drawn towards the words of ``benchmark``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return resample(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("text")).select("doc_id", "n_features", "weight", "score", "rank")


OP13_SQL = rf"""
WITH {CRC_TABLE},
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
g AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
n AS (SELECT word, sum(s) AS s, sum(t) AS t FROM (SELECT unnest(w) AS word, 1 AS s, 0 AS t FROM d
        UNION ALL SELECT unnest(w), 0, 1 FROM g) GROUP BY word),
h AS (SELECT word, s, t AS tt, {BYTES_OF.format("word")} AS b FROM n),
k AS (SELECT word, s, tt, {CRC_OF} % 10000 AS bucket FROM h, tab),
c AS (SELECT bucket, sum(s)::DOUBLE AS s, sum(tt)::DOUBLE AS t FROM k GROUP BY bucket),
a AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM c),
gain AS (SELECT bucket, floor(1000 * ln((t + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000))))::BIGINT AS gain FROM c, a),
v AS (SELECT word, gain FROM k JOIN gain USING (bucket)),
f AS (SELECT doc_id, unnest(w) AS word FROM d),
sums AS (SELECT doc_id, sum(gain)::BIGINT AS weight FROM f JOIN v USING (word) GROUP BY doc_id),
z AS (SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
        ('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT AS h FROM d LEFT JOIN sums USING (doc_id)),
y AS (SELECT doc_id, n_features, weight, (weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296.0::DOUBLE))))::BIGINT AS score FROM z),
x AS (SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) END AS nth FROM y)
SELECT doc_id, n_features, weight, score,
  (CASE WHEN nth <= 10 * (SELECT count(*) FROM x WHERE n_features >= 20) // 100 THEN nth END)::BIGINT AS rank FROM x
"""
