"""SentencePiece encoding with N-best segmentations, and decoding.

The N best segmentations of a pre-token are found backwards from its end, by A-star:
what stands before a place is bounded by the forward Viterbi score there, which is
exact, so hypotheses leave the agenda in order and no search is wasted.  A text's N
best differ from its best one in at most N - 1 pre-tokens, those whose second
segmentation costs least (the forward pass knows its score): only these are
searched, and their combinations give the text's N best exactly.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulkit.llm.lattice import Vocabulary, character_bytes, forward, load, pieces, pretokens, spell, take_ragged
from haulkit.llm.shared import SMALL, Powers, blocks, materialise, small_batches, text_of
from haulkit.llm.token_counts import VOCABULARY, sums

#: Characters of the distinct pre-tokens whose N best a task remembers: some 10 MB.
REMEMBERED = 1 << 17


def n_best(token: str, ahead: list[float], n: int, v: Vocabulary) -> list[tuple[float, tuple[int, ...]]]:
    """(score, ids) of the n best segmentations of a pre-token, best first (see lattice.MARK).

    ahead: forward Viterbi score of each prefix, from the empty one on.  Ties: smaller
    ids at the end first.
    """
    agenda: list[tuple[float, tuple[int, ...], float, int]] = [(-ahead[len(token)], (), 0.0, len(token))]
    out: list[tuple[float, tuple[int, ...]]] = []
    while agenda and len(out) < n:
        _, ids, score, end = heapq.heappop(agenda)
        if not end:
            out.append((score, ids[::-1]))
            continue
        for start in range(max(0, end - v.longest), end):
            found = v.pieces.get(token[start:end])
            if found:
                step, own = (found[0],), found[1]
            elif start == end - 1:
                step, own = tuple(v.first_byte + b for b in reversed(character_bytes(token[start]))), v.fallback
            else:
                continue
            heapq.heappush(agenda, (-(score + own + ahead[start]), ids + step, score + own, start))
    return out


def ahead_of(t, leaf: int, size: int) -> list[float]:
    """Forward scores along the path from the root to a leaf."""
    out = [0.0] * (size + 1)
    for k in range(size, 0, -1):
        out[k], leaf = float(t.best[leaf]), t.parent[leaf]
    return out


def encode(docs: DataFrame, vocabulary: str = VOCABULARY, n: int = 4, id_col: str = "doc_id", text_col: str = "text",
           carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: id_col, ids, score, others, and the columns of ``carry``.

    ids and score are the best segmentation.  others lists the next n - 1, best
    first: score, and what differs, as (pre-token, ids) with pre-tokens counted from 0.
    There are fewer where the text has fewer segmentations; a null or empty text has no
    ids, score 0 and no others.  A long text is encoded in pieces, cut between
    pre-tokens.  Columns of ``carry`` must not be named as those before them.
    """
    if clash := {"id", "text", "ids", "score", "others", id_col} & set(carry):
        raise ValueError(f"carried columns are named as columns of the result: {sorted(clash)}")
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(load(vocabulary))

    def searched(p, t, v: Vocabulary, w: int, cache: dict) -> list[tuple[float, tuple[int, ...]]]:
        token = p.string(w)
        if token not in cache:
            if cache.get("", 0) + len(token) > REMEMBERED:  # no pre-token is empty
                cache.clear()
            cache[""] = cache.get("", 0) + len(token)
            cache[token] = n_best(token, ahead_of(t, int(t.leaf[w]), len(token)), n, v)
        return cache[token]

    def segmented(strings: list[str], v: Vocabulary, powers: Powers, cache: dict):
        """(ids, their bounds, scores, numbers of pre-tokens, candidates (loss, pre-token, its n best)) of texts."""
        p = pretokens(strings, v, powers)
        t = forward(p, v)
        ids, bounds = take_ragged(*spell(t, v), p.which)
        loss = (t.best - t.second)[t.leaf][p.which]
        candidates = []
        for a, b in zip(p.texts.tolist(), p.texts[1:].tolist()):
            near = loss[a:b]
            near = np.argpartition(near, n - 2)[:n - 1] if b - a >= n > 1 else np.arange(b - a if n > 1 else 0)
            candidates.append([(float(loss[a + k]), int(k), searched(p, t, v, int(p.which[a + k]), cache)) for k in near])
        return ids, bounds[p.texts], sums(t.best[t.leaf][p.which], p.texts), np.diff(p.texts), candidates

    def joined(parts: list):
        """The pieces of one text as one."""
        ahead = np.cumsum([0, *(int(part[3][0]) for part in parts)]).tolist()
        near = sorted((loss, k + first, ways) for part, first in zip(parts, ahead) for loss, k, ways in part[4][0])[:max(0, n - 1)]
        ids = np.concatenate([part[0] for part in parts])
        return ids, np.array([0, len(ids)]), sum(part[2] for part in parts), np.array(ahead[-1:]), [near]

    def combined(score: float, near: list) -> list[dict]:
        """The next n - 1 segmentations of a text from its candidates."""
        near = sorted(near, key=lambda c: c[1])
        ways = [c[2] for c in near]
        ranked = sorted(product(*(range(len(w)) for w in ways)), key=lambda c: (sum(w[0][0] - w[i][0] for w, i in zip(ways, c, strict=True)), c))[1:n]
        return [{"score": score - sum(w[0][0] - w[i][0] for w, i in zip(ways, c, strict=True)),
                 "changes": [{"pretoken": k, "ids": list(w[i][1])} for (_, k, w), i in zip(near, c, strict=True) if i]} for c in ranked]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, v, cache = Powers(), shared.value, {}
        for batch in blocks(batches, size=SMALL):
            parts = [segmented(strings, v, powers, cache) for strings in pieces(batch, 1, SMALL)]
            ids, bounds, score, _, near = parts[0] if len(parts) == 1 else joined(parts)
            others = [combined(s, c) for s, c in zip(score.tolist(), near, strict=True)]
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(score), pa.array(others, kind), *batch.columns[2:]], ["id", "ids", "score", "others", *carry])

    kind = pa.list_(pa.struct([("score", pa.float64()), ("changes", pa.list_(pa.struct([("pretoken", pa.int32()), ("ids", pa.list_(pa.int32()))])))]))
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"), *carry)
    fields = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in carry)
    schema = (f"id {rows.schema['id'].dataType.simpleString()}, ids array<int>, score double, "
              f"others array<struct<score:double,changes:array<struct<pretoken:int,ids:array<int>>>>>{fields}")
    return rows.mapInArrow(task, schema).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, vocabulary: str = VOCABULARY, ids_col: str = "ids", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns of ``carry`` and text: the spelling of the ids without the space that encoding puts in front.

    Ids outside the vocabulary raise; bytes that are not UTF-8 become U+FFFD; null gives ''.
    """
    small_batches(encoded.sparkSession)
    shared = encoded.sparkSession.sparkContext.broadcast(load(vocabulary))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        for batch in batches:
            lists = batch.column(0)
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            data, bounds = take_ragged(v.spelled, v.bounds, ids)
            ends = bounds[np.concatenate(([0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())))]
            data = data.tobytes()
            texts = [data[a:b].removeprefix(b" ").decode("utf-8", "replace") for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(texts, pa.string())], [*carry, "text"])

    rows = encoded.select(F.col(ids_col).alias("__ids"), *carry)
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema if f.name in carry)
    return rows.mapInArrow(task, f"{fields}text string")


def op3_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """Every row of ``documents`` encoded (four best segmentations) and decoded again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("hash", F.xxhash64(text_of()))
    encoded = materialise(encode(docs, carry=("hash",)).select(
        "doc_id", "ids", "hash", F.size("ids").cast("long").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"),
        F.concat(F.array("score"), F.col("others.score")).alias("scores")), "encoded")
    carry = ("doc_id", "hash", "n_pieces", "ids_hash", "scores")
    return decode(encoded, carry=carry).select("doc_id", "n_pieces", "ids_hash", "scores", (F.xxhash64("text") == F.col("hash")).alias("same_text"))
