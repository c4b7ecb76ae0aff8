"""Repeated byte strings, found by sorting suffixes block by block with a difference cover.

Only the first ``length`` bytes of a suffix matter here.  Suffixes are dealt to
buckets by the smallest hash among the grams of GRAM bytes of those first bytes:
equal strings meet, and neighbours travel together as one piece of text.  A bucket
is small, and a task sorts a few buckets at a time (blockwise), which bounds its
memory.  A gram that is smallest in one piece of the corpus only can't belong to
a repeat; such pieces stay at home.

Within a block, suffixes are first sorted by a hash of their first and last bytes.
Ties are long (copied text), so they are resolved by ranks: every position whose residue modulo COVER
lies in the difference cover is ranked once by most of the length, by doubling.  For
any two suffixes some shift below COVER puts both on ranked positions; there the
rank decides, together with the few bytes before and after it (their 64-bit hash).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulkit.llm.shared import (_LETTERS, Powers, binaries, blocks, filter_array, filter_pages, flat, has, materialise, maybe_in, merged, minimisers, mix,
                                runs_of, sorted_buckets, spans_hash, text_of)

GRAM = 36
LONGEST = 1024
HOT = 2048
#: Differences of these residues give every residue modulo 16.
COVER, RESIDUES = 16, (0, 1, 2, 5, 8)
#: Bytes of pieces in a block.
BLOCK_BYTES = 1 << 18
#: Bytes of text that are cut into pieces at a time.
TEXT_BYTES = 1 << 20


def rolling(data: np.ndarray, n: int, powers: Powers) -> np.ndarray:
    """Hash of the n bytes from each place on; its upper bits are the random ones."""
    if len(data) < n:
        return np.zeros(0, np.uint64)
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LETTERS[data] * up[:len(data)], out=total[1:])
    return (total[n:] - total[:-n]) * down[:len(data) - n + 1]


def pieces(data: np.ndarray, bounds: np.ndarray, length: int, powers: Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first byte, bytes, key) of the runs of strings of ``length`` bytes that share their smallest gram, and the keys by place."""
    gram = min(GRAM, length)
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    sizes = np.maximum(np.diff(bounds) - length + 1, 0)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + bounds[doc]
    fits = np.zeros(len(data) - length + 1, bool)
    fits[at] = True
    least, found = minimisers(rolling(data, gram, powers), length - gram + 1, fits)
    least = least[at]
    start, end = runs_of(least, at, doc, LONGEST)
    return doc[start], at[start], end - start + length - 1, mix(least[start]), mix(found)


def words8(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as one number whose order is theirs; beyond the end, zeros."""
    padded = np.concatenate((data, np.zeros(16, np.uint8)))
    out = np.empty(len(data), np.uint64)
    for k in range(min(8, len(data))):
        part = out[k::8]
        part[:] = padded[k:k + 8 * len(part)].view(">u8")
    return out


def packed(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, upper bits in that order) of keys sorted by their upper bits; an index takes the lower ones, so that plain numbers are sorted."""
    bits = np.uint64(max(1, (len(keys) - 1).bit_length()))
    both = np.sort(keys >> bits << bits | np.arange(len(keys), dtype=np.uint64))
    return (both & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64), both >> bits


def shared_keys(keys: np.ndarray) -> np.ndarray:
    """Which keys may occur twice: all that do, and a few that share their upper bits."""
    order, upper = packed(keys)
    same = upper[1:] == upper[:-1]
    found = np.zeros(len(keys), bool)
    found[order[1:][same]] = found[order[:-1][same]] = True
    return found


def gathered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order that brings equal keys together, which of them begin a new key)."""
    order, upper = packed(keys)
    new = np.ones(len(keys), bool)
    new[1:] = keys[order[1:]] != keys[order[:-1]]
    if (new[1:] & (upper[1:] == upper[:-1])).any():  # different keys with the same upper bits: they may alternate
        order = np.argsort(keys)
        new[1:] = keys[order[1:]] != keys[order[:-1]]
    return order, new


def rank(keys: np.ndarray) -> np.ndarray:
    """Dense ranks of keys by place: equal keys have one rank."""
    order, new = gathered(keys)
    out = np.empty(len(keys), np.uint64)
    out[order] = np.cumsum(new)
    return out


def pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One key of each pair of numbers."""
    return mix(mix(a) + b)


def first_equal(data: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """For each of the ascending places, the index of the first place with the same ``length`` bytes."""
    sample = COVER
    while sample * 2 <= length - COVER + 1:
        sample *= 2
    size = sample
    more = sample + COVER <= length - COVER + 1  # one more stretch of COVER bytes fits
    if more:
        size += COVER
    first = np.arange(len(at))
    if not len(at):
        return first
    eight = words8(data)
    # what a ranked stretch leaves out lies in the first COVER bytes and in the last length - size
    outer = mix(eight[at]) + eight[at + 8]
    for k in range(1, math.ceil((length - size) / 8) + 1):
        outer = mix(outer) + eight[at + length - 8 * k]
    outer = mix(outer)
    tied = shared_keys(outer)
    at, index, outer = at[tied], first[tied], outer[tied]
    if not len(at):
        return first

    # Ranks of the sampled positions by 16, 32, ... bytes.  Those of the last few of the data are not whole, nor asked for.
    rows_of = np.arange(0, len(data), COVER)
    sampled = (rows_of[:, None] + np.array(RESIDUES)).ravel()
    sampled = sampled[sampled < len(data)]
    slot = np.zeros(len(data), np.int64)
    slot[sampled] = np.arange(len(sampled))

    def ahead(ranks: np.ndarray, by: int) -> np.ndarray:
        return np.where(sampled + by < len(data), ranks[slot[np.minimum(sampled + by, len(data) - 1)]], np.uint64(0))

    by16 = ranked = rank(pairs(eight[sampled], eight[np.minimum(sampled + 8, len(data) - 1)]))
    ranked_by = COVER
    while ranked_by < sample:
        ranked = rank(pairs(ranked, ahead(ranked, ranked_by)))
        ranked_by *= 2
    if more:
        ranked = rank(pairs(ranked, ahead(by16, ranked_by)))

    whole_rank = np.zeros(len(data), np.uint64)
    whole_rank[sampled] = ranked * np.uint64(0x9E3779B97F4A7C15)
    residue = (at % COVER).astype(np.uint8)
    by_residue = np.argsort(residue, kind="stable")
    bounds = np.searchsorted(residue[by_residue], np.arange(COVER + 1))
    best, open_ = np.arange(len(at)), np.ones(len(at), bool)
    for shift in range(COVER):
        # a place equal to an earlier one needs no more shifts: whatever else equals it equals that one, which stays
        here = np.concatenate([by_residue[bounds[r]:bounds[r + 1]] for r in ((c - shift) % COVER for c in RESIDUES)])
        here = here[open_[here]]
        if len(here) < 2:
            continue
        order, new = gathered(outer[here] + whole_rank[at[here] + shift])
        here = here[order]
        starts = np.flatnonzero(new)
        if len(starts) < len(here):
            least = np.minimum.reduceat(here, starts)[np.cumsum(new) - 1]
            best[here] = least
            open_[here[here != least]] = False
    while (best[best] != best).any():
        best = best[best]
    first[index] = index[best]
    return first


def repeated_stretches(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text", filter_bits: int = 27) -> DataFrame:
    """(id, mark, start, stop): stretches of bytes covered by strings of ``length`` bytes that also start earlier.

    Earlier: in a row of smaller id (null is the smallest), or at a smaller place of
    the same id.  Strings don't cross texts.  mark is xxhash64 of the text.  Stretches
    may overlap.  ``length`` is 32 or more.
    """
    if length < 2 * COVER:
        raise ValueError(f"length must be {2 * COVER} at least")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_of(text_col)).alias("mark"), text_of(text_col).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in blocks(batches, size=TEXT_BYTES):
            key, n = np.unique(pieces(*flat(batch.column(0)), length, powers)[4], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n, pa.int64())], ["key", "n"])

    counts = materialise(rows.select("text").mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1"), "grams")
    most = counts.agg(F.max("n")).first()[0] or 0
    salts = max(1, math.ceil(most / HOT))
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(filter_array(counts, "key", filter_bits))
    hot = context.broadcast(filter_array(counts.filter(F.col("n") > HOT), "key", 20))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in blocks(batches, size=TEXT_BYTES):
            data, bounds = flat(batch.column(2))
            doc, first, size, key, _ = pieces(data, bounds, length, powers)
            keep = has(shared.value, key)
            doc, first, size, key = doc[keep], first[keep], size[keep], key[keep]
            place = first - bounds[doc]
            turn = mix(batch.column(3).to_numpy().view(np.uint64)[doc] + place.astype(np.uint64))
            salt = np.where(has(hot.value, key), (turn % np.uint64(salts)).astype(np.int64), -1)
            yield pa.RecordBatch.from_arrays([
                pa.array(key.view(np.int64)), pa.array(salt, pa.int64()), batch.column(0).take(pa.array(doc)), batch.column(1).take(pa.array(doc)),
                pa.array(place, pa.int64()), binaries(data, first, first + size)], ["key", "salt", "id", "mark", "place", "piece"])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, held, size = Powers(), [], 0
        for table in sorted_buckets(batches):  # several small buckets make a block
            held.append(table)
            size += table.column(5).nbytes
            if size >= BLOCK_BYTES:
                yield from block(pa.concat_tables(held).combine_chunks(), powers)
                held, size = [], 0
        if held:
            yield from block(pa.concat_tables(held).combine_chunks(), powers)

    def block(table: pa.Table, powers: Powers) -> Iterator[pa.RecordBatch]:
        key, salt, ids, marks, places, piece = (c.combine_chunks() for c in table.columns)
        # buckets of a block may hold equal strings only within themselves, or in parts of one dealt bucket: rows by id and place
        order = pc.sort_indices(pa.table({"id": ids, "place": places}), [("id", "ascending"), ("place", "ascending")], null_placement="at_start")
        key, salt, ids, marks, places, piece = (x.take(order) for x in (key, salt, ids, marks, places, piece))
        data, bounds = flat(piece)
        sizes = np.diff(bounds) - length + 1
        row = np.repeat(np.arange(len(sizes)), sizes)
        at = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + bounds[row]
        first = first_equal(data, at, length)
        number = pc.fill_null(ids, -(1 << 63)).to_numpy()
        place = places.to_numpy()[row] + at - bounds[row]
        own = number[row]
        later = (own != own[first]) | (place != place[first])
        doc, start, stop = merged(later, at, row, length)
        yield out(ids, marks, doc, places.to_numpy()[doc] + start - bounds[doc], places.to_numpy()[doc] + stop - bounds[doc], None)
        lone = (salt.to_numpy() >= 0)[row] & (first == np.arange(len(at)))
        doc = row[lone]
        yield out(ids, marks, doc, place[lone], place[lone] + length, spans_hash(_LETTERS[data], at[lone], at[lone] + length, powers))

    def out(ids: pa.Array, marks: pa.Array, doc: np.ndarray, start: np.ndarray, stop: np.ndarray, string: np.ndarray | None) -> pa.RecordBatch:
        take = pa.array(doc, pa.int64())
        strings = pa.nulls(len(doc), pa.int64()) if string is None else pa.array(string.view(np.int64))
        return pa.RecordBatch.from_arrays([ids.take(take), marks.take(take), pa.array(start, pa.int64()), pa.array(stop, pa.int64()), strings],
                                          ["id", "mark", "start", "stop", "string"])

    sent = rows.withColumn("turn", F.xxhash64("id")).mapInArrow(send, "key long, salt long, id long, mark long, place long, piece binary")
    found = materialise(sent.repartition("key", "salt").sortWithinPartitions("key", "salt")
                        .mapInArrow(sort, "id long, mark long, start long, stop long, string long"), "stretches")
    # strings of dealt buckets: the first of each part meet (as many at most as there are parts), and all but the first of those go
    dealt = found.filter("string is not null").groupBy("string").agg(F.sort_array(F.collect_list(F.struct("id", "start", "mark", "stop"))).alias("places"))
    late = (dealt.select(F.col("places")[0].alias("f"), F.explode(F.expr("slice(places, 2, size(places))")).alias("p"))
            .filter("not (p.id <=> f.id and p.start = f.start)").select("p.id", "p.mark", "p.start", "p.stop"))
    return found.filter("string is null").select("id", "mark", "start", "stop").unionByName(late)


def remove_repeats(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text", filter_bits: int = 27) -> DataFrame:
    """One row per row of ``docs``: id_col, n_bytes, n_removed, n_spans (maximal removed runs), kept (binary: the bytes left).

    Bytes go that a string covers which also starts earlier (see repeated_stretches),
    as strings stand in the input.  What is left may end within a character.  A null or
    empty text has no bytes.  Only texts with stretches are joined with them.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_of(text_col)).alias("mark"), text_of(text_col).alias("text"))
    stretches = materialise(repeated_stretches(docs, length, id_col, text_col, filter_bits), "gone")
    per_text = stretches.groupBy("id", "mark").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("gone"))
    bits = 24
    touched = filter_pages(stretches.select(F.xxhash64("id", "mark").alias("key")).distinct(), "key", bits)
    flagged = maybe_in(rows.withColumn("key", F.xxhash64("id", "mark")), "key", touched, bits, "touched")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            n, gone, runs, kept = [], [], [], []
            for text, spans in zip(batch.column(1), batch.column(2), strict=True):
                data, left, at, count = (text.as_py() or "").encode(), [], 0, 0
                for span in spans.as_py() or ():
                    if span["start"] > at or not count:
                        left.append(data[at:span["start"]])
                        count += 1
                    at = max(at, span["stop"])
                left = b"".join([*left, data[at:]])
                n.append(len(data))
                gone.append(len(data) - len(left))
                runs.append(count)
                kept.append(left)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.int64()) for x in (n, gone, runs)), pa.array(kept, pa.binary())],
                                             ["id", "n_bytes", "n_removed", "n_spans", "kept"])

    spans = "array<struct<start:bigint,stop:bigint>>"
    joined = (flagged.filter("touched").select("id", "mark", "text")
              .join(per_text.select(F.col("id").alias("id2"), F.col("mark").alias("mark2"), "gone"),
                    F.col("id").eqNullSafe(F.col("id2")) & (F.col("mark") == F.col("mark2")), "left").select("id", "text", "gone"))
    plain = flagged.filter("not touched").select("id", "text", F.lit(None).cast(spans).alias("gone"))
    schema = "id long, n_bytes long, n_removed long, n_spans long, kept binary"
    return joined.mapInArrow(cut, schema).unionByName(plain.mapInArrow(cut, schema)).withColumnRenamed("id", id_col)


def op8_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """Every row of ``documents`` without bytes of 100-byte strings that also start earlier."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs, 100).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
