"""Repeated windows of words, found by super-k-mer partitioning.

A window's minimiser is the smallest hash of its grams of GRAM words.  Neighbouring
windows mostly share it; such a run of windows (a super-k-mer) travels as one packed
string to the minimiser's bucket, where the windows are sorted and counted.  Equal
windows have equal minimisers, so they always meet.

A first pass counts the minimisers alone.  A window can only be repeated if its
minimiser is found at two places, so runs with a minimiser of their own stay at
home (a key filter of fixed size tells; what it passes by chance is sorted out in
the bucket).  Minimisers at more than HOT places are dealt to several buckets by
position, as many as their own count asks for, and what these have found meets once more by window.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulkit.llm.shared import (Powers, Words, binaries, blocks, filter_array, filter_pages, has, materialise, maybe_in, merged, minimisers, mix,
                                runs_hash, runs_of, sorted_buckets, text_of, whole, words_of)

GRAM = 12
#: Windows of a run at most; runs of one minimiser may be cut anywhere.
LONGEST = 256
#: Places of a minimiser that one bucket takes; up to DEAL times as many are dealt to DEAL buckets, and so on.
HOT, DEAL = 512, 4


def super_kmers(w: Words, window: int, powers: Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first word, words, minimiser) of the runs of windows in a block, and the minimisers by place."""
    gram = min(GRAM, window)
    fits = whole(w, window)
    if not len(fits):
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 2
    least, found = minimisers(runs_hash(w, gram, powers), window - gram + 1, fits)
    at = np.flatnonzero(fits)
    least = least[at]
    start, end = runs_of(least, at, w.doc[at], LONGEST)
    return at[start], end - start + window - 1, least[start], found


def rows_with_key(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, mark, text): the hash of the text tells rows apart that repeat an id."""
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("mark"), text_of(text_col).alias("text"))


def repeated_stretches(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text", filter_bits: int = 27) -> DataFrame:
    """(id, mark, start, stop): stretches of words covered by windows that start at two places or more.

    ``window`` words of one text make a window; places in all rows count, also those
    of repeated rows.  mark is xxhash64 of the text.  Stretches of a text may overlap.
    Windows are compared by 64-bit hashes within the bucket of their 64-bit minimiser.
    """
    rows = rows_with_key(docs, id_col, text_col)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in blocks(batches):
            key, n = np.unique(super_kmers(words_of(batch.column(0), powers), window, powers)[3], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n, pa.int64())], ["key", "n"])

    counts = materialise(rows.select("text").mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1"), "minimisers")
    most = counts.agg(F.max("n")).first()[0] or 0
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(filter_array(counts, "key", filter_bits))
    # one filter per power of DEAL: a key that is in k of them has DEAL ** k buckets
    levels = range(math.ceil(math.log(most / HOT, DEAL))) if most > HOT else ()
    hot = context.broadcast([filter_array(counts.filter(F.col("n") > HOT * DEAL ** k), "key", 20) for k in levels])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in blocks(batches):
            w = words_of(batch.column(2), powers)
            first, words, key, _ = super_kmers(w, window, powers)
            keep = has(shared.value, key)
            first, words, key = first[keep], words[keep], key[keep]
            doc = w.doc[first]
            place = first - w.first[doc]
            turn = mix(batch.column(3).to_numpy().view(np.uint64)[doc] + place.astype(np.uint64))
            buckets = np.ones(len(key), np.uint64)
            for level in hot.value:
                buckets[has(level, key)] *= np.uint64(DEAL)
            salt = np.where(buckets > 1, (turn % buckets).astype(np.int64), -1)
            yield pa.RecordBatch.from_arrays([
                pa.array(key.view(np.int64)), pa.array(salt, pa.int64()), batch.column(0).take(pa.array(doc)), batch.column(1).take(pa.array(doc)),
                pa.array(place, pa.int64()), binaries(w.data, w.start[first], w.end[first + words - 1])], ["key", "salt", "id", "mark", "place", "packed"])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for table in sorted_buckets(batches):
            yield from counted(table, powers)

    def counted(table: pa.Table, powers: Powers) -> Iterator[pa.RecordBatch]:
        w = words_of(table.column(5).combine_chunks().cast(pa.string()), powers)
        at = np.flatnonzero(whole(w, window))
        hashes, row = runs_hash(w, window, powers)[at], w.doc[at]
        order = np.argsort(hashes, kind="stable")
        same = hashes[order][1:] == hashes[order][:-1]
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        again = np.zeros(len(at), bool)
        again[order[1:][same]] = True
        place = table.column(4).to_numpy()
        doc, start, stop = merged(twice, at, row, window)
        yield out(table, doc, place[doc] + start - w.first[doc], place[doc] + stop - w.first[doc], np.full(len(doc), None, object))
        salted = (table.column(1).to_numpy() >= 0)[row]
        lone = salted & ~again  # one of each window of a dealt bucket; those that are repeated here only tell the others
        doc, start = row[lone], at[lone]
        start = np.where(twice[lone], -window, place[doc] + start - w.first[doc])
        yield out(table, doc, start, start + window, hashes[lone].view(np.int64))

    def out(table: pa.Table, doc: np.ndarray, start: np.ndarray, stop: np.ndarray, seen: np.ndarray) -> pa.RecordBatch:
        take = pa.array(doc, pa.int64())
        columns = [table.column(2).combine_chunks().take(take), table.column(3).combine_chunks().take(take), pa.array(start, pa.int64()), pa.array(stop, pa.int64()), pa.array(seen, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["id", "mark", "start", "stop", "window"])

    id_type = rows.schema["id"].dataType.simpleString()
    sent = rows.withColumn("turn", F.xxhash64("id")).mapInArrow(send, f"key long, salt long, id {id_type}, mark long, place long, packed binary")
    found = materialise(sent.repartition("key", "salt").sortWithinPartitions("key", "salt")
                        .mapInArrow(sort, f"id {id_type}, mark long, start long, stop long, window long"), "windows")
    dealt = found.filter("window is not null")
    meet = dealt.groupBy("window").count().filter("count > 1").select("window")
    late = dealt.filter("start >= 0").join(meet, "window").select("id", "mark", "start", "stop")
    return found.filter("window is null").select("id", "mark", "start", "stop").unionByName(late)


def remove_repeats(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text", filter_bits: int = 27) -> DataFrame:
    """One row per row of ``docs``: id_col, n_words, n_removed, kept (the words left, joined by one space).

    Words go that a repeated window covers (see repeated_stretches); windows are judged on the
    input.  A null or empty text has no words.  A text with stretches is joined with
    them; the others are passed through their scan alone.
    """
    rows = rows_with_key(docs, id_col, text_col)
    id_type = rows.schema["id"].dataType.simpleString()
    stretches = materialise(repeated_stretches(docs, window, id_col, text_col, filter_bits), "stretches")
    per_text = stretches.groupBy("id", "mark").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("gone"))
    bits = 24
    touched = filter_pages(stretches.select(F.xxhash64("id", "mark").alias("key")).distinct(), "key", bits)
    flagged = maybe_in(rows.withColumn("key", F.xxhash64("id", "mark")), "key", touched, bits, "touched")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            n, gone, kept = [], [], []
            for text, spans in zip(batch.column(1), batch.column(2), strict=True):
                words = (text.as_py() or "").encode().split()
                left, at = [], 0
                for span in spans.as_py() or ():
                    left += words[at:span["start"]]
                    at = max(at, span["stop"])
                left += words[at:]
                n.append(len(words))
                gone.append(len(words) - len(left))
                kept.append(b" ".join(left))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary())], ["id", "n_words", "n_removed", "kept"])

    spans = "array<struct<start:bigint,stop:bigint>>"
    same = [F.col("id").eqNullSafe(F.col("id2")), F.col("mark") == F.col("mark2")]
    joined = (flagged.filter("touched").select("id", "mark", "text")
              .join(per_text.select(F.col("id").alias("id2"), F.col("mark").alias("mark2"), "gone"), same[0] & same[1], "left").select("id", "text", "gone"))
    plain = flagged.filter("not touched").select("id", "text", F.lit(None).cast(spans).alias("gone"))
    schema = f"id {id_type}, n_words long, n_removed long, kept binary"
    out = joined.mapInArrow(cut, schema).unionByName(plain.mapInArrow(cut, schema))
    return out.select(F.col("id").alias(id_col), "n_words", "n_removed", F.col("kept").cast("string").alias("kept"))


def op2_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Every row of ``documents`` without words in windows of 35 that are found twice."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs, window=35).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
