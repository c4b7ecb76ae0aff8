"""Language-model scores from a log-frequency Bloom filter of quantised n-gram counts.

Counts of words and of pairs of neighbours in the training texts are quantised on the
scale 1, 2, 3, 4, 6, 8, 12, 16, ...; an n-gram is inserted once for each step up to its
own.  A lookup probes step by step until the filter says no, so a false "yes"
overstates a count by one step at a time (Talbot and Osborne 2007).

``train`` counts the n-grams and writes the model: a table of segments of the filter, cut
by the first bits of an n-gram's hash.  A segment has 2 * BITS_EACH to 4 * BITS_EACH bits for
each entry that it holds, and all words and pairs are inserted, so the filter grows with the
input; no task holds more than one segment.  ``score`` knows the finished segments only: the
distinct n-grams of a unit of texts are sent, as hashes, to the tasks of their segments, and
the steps found there by probes come back to the unit's task, which adds up the scores.

The probability of a word after another is interpolated:
LAMBDA * c(pair) / c(first) + (1 - LAMBDA) * (c(word) + 1) / (N + V + 1).
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulkit.llm.shared import SMALL, Powers, Words, blocks, held_back, materialise, mix, small_batches, sorted_buckets, text_of, words_of

BITS_EACH, PROBES = 5, 3
LAMBDA = 0.15
#: Words of which the exact count is broadcast for the base score: the most frequent ones, 4 MB at most.
HEAD = 1 << 18
#: Distinct n-grams that a task merges at a time.
ROOM = 1 << 20
#: Bytes of training text for one segment, about: half a million entries.
SEGMENT = 2 << 20
#: Tokens of the texts that ask the segments together, or one longer block of texts.
UNIT = 1 << 19
#: Bits of a hash within its segment.  Absent n-grams that share them with one of a million there are rarer than false answers.
KEY_BITS = 32
SCALE = np.array([1, 2, *(x << k for k in range(48) for x in (3, 4))], np.int64)
#: Count that a step stands for: the middle of its range on a log scale.
MEANT = np.sqrt(SCALE * (np.append(SCALE[1:], SCALE[-1] * 2) - 1.0).clip(SCALE))
MEANT_FROM_0 = np.concatenate(([0.0], MEANT))
END = np.uint64(0x5851F42D4C957F2D)  # hash of the end of a text
START = np.uint64(0x14057B7EF767814F)


class Model(NamedTuple):
    """segments: table (segment, bits, words); words: table (key, n) of exact counts, for the base score; N and V; the number of segments."""

    segments: DataFrame
    words: DataFrame
    n_all: int
    distinct: int
    cuts: int


def tokens_of(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of words with an end after each text, bounds of texts)."""
    bounds = w.first + np.arange(len(w.first))
    out = np.empty(bounds[-1], np.uint64)
    ends = bounds[1:] - 1
    inner = np.ones(len(out), bool)
    inner[ends] = False
    out[ends], out[inner] = END, w.hashes
    return out, bounds


def pairs_of(tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Hash of each token with the one before it (the first: with START)."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[bounds[:-1]] = START
    return mix(before * np.uint64(0x9E3779B97F4A7C15) ^ tokens)


def words_key(tokens: np.ndarray) -> np.ndarray:
    return mix(tokens)


def short(keys: np.ndarray, cuts: int) -> np.ndarray:
    """A hash as the filter has it: its segment and KEY_BITS more; cuts: the number of segments, a power of 2."""
    return keys >> np.uint64(65 - KEY_BITS - cuts.bit_length())


def segment_of(keys: np.ndarray) -> np.ndarray:
    """The segment of each short key."""
    return (keys >> np.uint64(KEY_BITS)).astype(np.int64)


def step_of(counts: np.ndarray) -> np.ndarray:
    return np.searchsorted(SCALE, counts, "right") - 1


def places(keys: np.ndarray, step: int, bits: int) -> list[np.ndarray]:
    """The PROBES bits of each key at a step, in a segment of 2**bits."""
    x = mix(keys + np.uint64((step + 1) * 0xD1B54A32D192ED03 & (1 << 64) - 1))
    y = mix(x) | np.uint64(1)
    room = np.uint64((1 << bits) - 1)
    return [(x + np.uint64(k) * y & room).astype(np.int64) for k in range(PROBES)]


def filled(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A segment with these n-grams (short keys), as bytes."""
    steps = step_of(counts)
    bits = max(10, math.ceil(math.log2(2 * BITS_EACH * (1 + int((steps + 1).sum())))))
    data = np.zeros(1 << bits, bool)
    for step in range(int(steps.max(initial=-1)) + 1):
        for bit in places(keys[steps >= step], step, bits):
            data[bit] = True
    return np.packbits(data, bitorder="little")


class LogFrequencyFilter:
    """Counts by membership probes in a finished segment; n-grams are given as short keys."""

    def __init__(self, data: np.ndarray):
        self.data, self.bits = data, (len(data) * 8).bit_length() - 1

    def count(self, keys: np.ndarray) -> np.ndarray:
        return MEANT_FROM_0[self.steps(keys)]

    def steps(self, keys: np.ndarray) -> np.ndarray:
        """How many steps of each key the filter has, from the first on."""
        out, left, step = np.zeros(len(keys), np.uint8), np.arange(len(keys)), 0
        while len(left) and step < len(SCALE):
            alive = np.arange(len(left))
            for bit in places(keys[left], step, self.bits):
                bit = bit[alive]
                alive = alive[self.data[bit >> 3] >> (bit & 7).astype(np.uint8) & 1 == 1]
            left = left[alive]
            step += 1
            out[left] = step
        return out


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return keys, counts
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts[order], first)


class Counts:
    """Counts by key that come in parts; parts are merged whenever they hold ROOM keys more than before."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size, self.limit = 0, ROOM

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((keys, counts))
        self.size += len(keys)
        if self.size >= self.limit:
            self.parts = [self.total()]
            self.size = len(self.parts[0][0])
            self.limit = self.size + ROOM

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return summed(*map(np.concatenate, zip(*self.parts, strict=True)))


def planes(values: np.ndarray) -> bytes:
    """Numbers byte by byte, all first bytes before all second ones, without the last bytes that are 0 in all: Spark compresses these well."""
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + values.astype("<u8").view(np.uint8).reshape(-1, 8).T[:width].tobytes()


def unplaned(data: bytes | memoryview, n: int) -> tuple[np.ndarray, int]:
    """(n numbers, bytes that they took)."""
    width = data[0]
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8, width * n, 1).reshape(width, n).T
    return out.view("<u8")[:, 0], 1 + width * n


def packed(keys: np.ndarray, counts: np.ndarray | None = None) -> bytes:
    """Ascending keys as their number, the first one and differences, and their counts."""
    first = int(keys[0]) if len(keys) else 0
    return len(keys).to_bytes(4, "little") + first.to_bytes(8, "little") + planes(np.diff(keys)) + (b"" if counts is None else planes(counts))


def unpacked(data: pa.Scalar) -> tuple[np.ndarray, np.ndarray | None]:
    data = memoryview(data.as_buffer())
    n = int.from_bytes(data[:4], "little")
    gaps, at = unplaned(data[12:], max(0, n - 1))
    rest = data[12 + at:]
    keys = np.cumsum(np.concatenate((np.frombuffer(data[4:12], "<u8")[:n], gaps)), dtype=np.uint64)
    return keys, unplaned(rest, n)[0].astype(np.int64) if len(rest) else None


def by_segment(keys: np.ndarray, segment: np.ndarray, cuts: int) -> Iterator[tuple[int, slice]]:
    """(segment, its part of the ascending keys) of those that have any."""
    bounds = np.searchsorted(segment, np.arange(cuts + 1))
    for k in np.flatnonzero(np.diff(bounds)).tolist():
        yield k, slice(bounds[k], bounds[k + 1])


# ---- training -----------------------------------------------------------------------------------------------------

def train(docs: DataFrame, training: Column | None = None, text_col: str = "text") -> Model:
    """The model of the rows for which ``training`` holds (all, by default), written to the shared folder."""
    small_batches(docs.sparkSession)
    texts = (docs if training is None else docs.filter(training)).select(text_of(text_col).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 1
    cuts = 1 << min(24, max(4, math.ceil(math.log2(size / SEGMENT))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sent(kind: int, keys: np.ndarray, n: np.ndarray, segment: np.ndarray):
            rows = [(k, packed(keys[part], n[part])) for k, part in by_segment(keys, segment, cuts)]
            segments, data = zip(*rows) if rows else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(segments, pa.int64()), pa.array([kind] * len(rows), pa.int64()), pa.array(data, pa.binary())],
                                              ["segment", "kind", "data"])

        def emptied():
            keys, n = words.total()
            yield sent(0, keys, n, segment_of(short(keys, cuts)))
            keys, n = pairs.total()
            yield sent(1, keys, n, segment_of(keys))

        powers, words, pairs, room = Powers(), Counts(), Counts(), 2 * ROOM
        for batch in blocks(batches, size=SMALL):
            tokens, bounds = tokens_of(words_of(batch.column(0), powers, fold=True))
            words.add(*np.unique(words_key(tokens), return_counts=True))
            pairs.add(*np.unique(short(pairs_of(tokens, bounds), cuts), return_counts=True))
            if words.size + pairs.size > room:
                words.parts, pairs.parts = [words.total()], [pairs.total()]
                words.size, pairs.size = len(words.parts[0][0]), len(pairs.parts[0][0])
                if words.size + pairs.size > ROOM:
                    yield from emptied()
                    words, pairs = Counts(), Counts()
        yield from emptied()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def segment():
            keys, n = words.total()
            grams, m = pairs.total()
            data = filled(np.concatenate((short(keys, cuts), grams)), np.concatenate((n, m)))
            own = [{"key": k, "n": c} for k, c in zip(keys.view(np.int64).tolist(), n.tolist())]
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([data.tobytes()], pa.binary()), pa.array([own], kind)],
                                              ["segment", "bits", "words"])

        at, words, pairs = None, Counts(), Counts()
        for batch in batches:
            for k, which, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if k != at:
                    if at is not None:
                        yield segment()
                    at, words, pairs = k, Counts(), Counts()
                (pairs if which else words).add(*unpacked(data))
        if at is not None:
            yield segment()

    kind = pa.list_(pa.struct([("key", pa.int64()), ("n", pa.int64())]))
    counted = texts.mapInArrow(count, "segment long, kind long, data binary").repartition("segment").sortWithinPartitions("segment")
    segments = materialise(counted.mapInArrow(build, "segment long, bits binary, words array<struct<key:long,n:long>>"), "lm-model")
    words = segments.select(F.explode("words").alias("w")).select("w.key", "w.n")
    n_all, distinct = words.agg(F.sum("n"), F.count("*")).first()
    return Model(segments, words, n_all or 0, distinct, cuts)


# ---- scoring ------------------------------------------------------------------------------------------------------

def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, tokens, bounds) of each UNIT tokens of texts, or of one longer block."""
    powers, held, size = Powers(), [], 0

    def joined():
        texts = pa.Table.from_batches([x[0] for x in held]).combine_chunks().to_batches()[0]
        ends = np.cumsum([0, *(len(x[1]) for x in held)])
        return texts, np.concatenate([x[1] for x in held]), np.concatenate([[0], *(x[2][1:] + e for x, e in zip(held, ends[:-1], strict=True))]).astype(np.int64)

    for batch in blocks(batches, size=SMALL):
        tokens, bounds = tokens_of(words_of(batch.column(2), powers, fold=True))
        if held and size + len(tokens) > UNIT:
            yield joined()
            held, size = [], 0
        held.append((batch, tokens, bounds))
        size += len(tokens)
    if held:
        yield joined()


def probed(asks: DataFrame, segments: DataFrame) -> DataFrame:
    """(unit, segment, data): for each row (segment, unit, data) of packed short keys an xor of these and the steps that the filter has of each.

    A task reads a segment and then lets the requests pass one by one.
    """
    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, lookup = None, None
        for batch in batches:
            segments = batch.column(0).to_numpy()
            for rows in map(lambda cut: batch.slice(cut.start, cut.stop - cut.start), runs(segments)) if len(segments) else ():
                k, data = rows.column(0)[0].as_py(), rows.column(2)
                if rows.column(1)[0].as_py() < 0:
                    at, lookup = k, LogFrequencyFilter(np.frombuffer(data[0].as_buffer(), np.uint8).copy())
                    rows, data = rows.slice(1), data.slice(1)
                if not rows.num_rows:
                    continue
                keys = [unpacked(x)[0] for x in data]
                ends = np.cumsum([0, *map(len, keys)])
                asked, which = np.unique(np.concatenate(keys), return_inverse=True)  # units ask for the same n-grams
                found = (lookup.steps(asked) if k == at else np.zeros(len(asked), np.uint8))[which]
                told = [np.bitwise_xor.reduce(x).tobytes() + found[a:b].tobytes() for x, a, b in zip(keys, ends, ends[1:])]
                yield pa.RecordBatch.from_arrays([rows.column(1), rows.column(0), pa.array(told, pa.binary())], ["unit", "segment", "data"])

    met = asks.unionByName(segments.select("segment", F.lit(-1).cast("long").alias("unit"), F.col("bits").alias("data")))
    return met.repartition("segment").sortWithinPartitions("segment", "unit").mapInArrow(answer, "unit long, segment long, data binary")


def score(docs: DataFrame, model: Model, held: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id_col, held_out (``held``), n_tokens, n_known, train_tokens, base_score, score.

    ``docs`` is read twice and must give the same rows in the same order: a table of files, not a shuffle; else it raises.
    """
    small_batches(docs.sparkSession)
    words, cuts, floor = model.words, model.cuts, model.n_all + model.distinct + 1
    # the least count that at most HEAD words reach, from one row a count's step
    by_step = sorted(((r[0], r[1]) for r in words.groupBy(_steps(F.col("n"))).count().collect()), reverse=True)
    top, least = 0, None
    for step, size in by_step:
        if (top := top + size) > HEAD:
            break
        least = int(SCALE[step - 1])
    head = words.filter(F.col("n") >= least).toPandas() if least else None
    keys = np.sort(head["key"].to_numpy().view(np.uint64)) if least else np.zeros(0, np.uint64)
    counts = head["n"].to_numpy()[np.argsort(head["key"].to_numpy().view(np.uint64))] if least else np.zeros(0, np.int64)
    shared = docs.sparkSession.sparkContext.broadcast((keys, counts))

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        return enumerate(_units(batches), (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit, (_, tokens, bounds) in numbered(batches):
            asked = np.sort(np.concatenate([short(np.unique(grams), cuts) for grams in (words_key(tokens), pairs_of(tokens, bounds))]))
            sent = [(k, packed(asked[part])) for k, part in by_segment(asked, segment_of(asked), cuts)]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in sent], pa.int64()), pa.array(np.full(len(sent), unit), pa.int64()),
                                              pa.array([x for _, x in sent], pa.binary())], ["segment", "unit", "data"])

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit, (texts, _, _) in numbered(batches):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(texts.num_rows, unit), pa.int64()), *texts.columns], ["unit", "id", "held_out", "text"])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, (keys, counts) = Powers(), shared.value
        number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        for table in sorted_buckets(batches):
            for rows in map(lambda cut: table[cut], runs(table.column(0).to_numpy())):
                cut = rows.column("segment").to_numpy().searchsorted(cuts)  # texts stand after the answers
                answers, texts = rows.column("data")[:cut].to_pylist(), rows[cut:]
                tokens, bounds = tokens_of(words_of(texts.column("text").combine_chunks(), powers, fold=True))
                own, which = np.unique(words_key(tokens), return_inverse=True)
                pair, first, back = np.unique(pairs_of(tokens, bounds), return_index=True, return_inverse=True)
                asked = short(np.concatenate((own, pair)), cuts)
                told = np.frombuffer(b"".join(x[8:] for x in answers), np.uint8)
                seen = np.bitwise_xor.reduce(np.frombuffer(b"".join(x[:8] for x in answers), np.uint64))
                if len(told) != len(asked) or seen != np.bitwise_xor.reduce(asked):
                    raise RuntimeError("the input gave other rows, or another order of them, when read again")
                steps = np.empty_like(told)
                steps[np.argsort(asked, kind="stable")] = told
                at = np.minimum(np.searchsorted(keys, own), max(0, len(keys) - 1))
                known = keys[at] == own if len(keys) else np.zeros(len(own), bool)
                c = np.where(known, counts[at] if len(keys) else 0, 0)
                base = np.where(known, np.log10((c + 1) / floor), 0.0)[which]
                one, two = MEANT_FROM_0[steps[:len(own)]], MEANT_FROM_0[steps[len(own):]]
                begins = np.zeros(len(tokens), bool)
                begins[bounds[:-1]] = True
                before = np.roll(which, 1)  # the token before; texts begin as often as they end, so that of START is an END
                begins, before, follower = begins[first], before[first], which[first]
                follows = np.where(begins, np.maximum(1.0, one[before]), np.maximum(one[before], two))
                p = LAMBDA * np.minimum(two / np.maximum(follows, 1.0), 1.0) + (1 - LAMBDA) * (one[follower] + 1) / floor
                sums = [np.add.reduceat(x, bounds[:-1]) for x in (known[which].astype(np.int64), base, np.log10(p)[back])]
                rare = np.flatnonzero(~known[which])
                tail = pa.ListArray.from_arrays(pa.array(np.searchsorted(rare, bounds), pa.int32()), pa.array(own[which[rare]].view(np.int64)))
                yield pa.RecordBatch.from_arrays([
                    pa.array(number + np.arange(len(texts))), *(texts.column(c).combine_chunks() for c in ("id", "held_out")), pa.array(np.diff(bounds), pa.int64()),
                    *map(pa.array, sums), tail], ["row", "id", "held_out", "n_tokens", "n_known", "base", "score", "tail"])
                number += len(texts)

    rows = docs.select(F.col(id_col).alias("id"), held.alias("held_out"), text_of(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    answers = probed(rows.mapInArrow(ask, "segment long, unit long, data binary"), model.segments)
    texts = rows.mapInArrow(carry, f"unit long, id {kind}, held_out boolean, text string").withColumn("segment", F.lit(cuts).cast("long"))
    # texts first: their tasks keep the numbers that they have in ask
    met = texts.unionByName(answers, allowMissingColumns=True).select("unit", F.lit(0).cast("long").alias("part"), "segment", "data", "id", "held_out", "text").repartition("unit").sortWithinPartitions("unit", "part", "segment")
    scored = materialise(met.mapInArrow(finish, f"row long, id {kind}, held_out boolean, n_tokens long, n_known long, base double, score double, tail array<long>"), "scores")
    tail = scored.select("row", F.explode("tail").alias("key")).groupBy("row", "key").agg(F.count("*").alias("times"))
    log = F.log10((F.coalesce("n", F.lit(0)) + 1) / F.lit(float(floor))) * F.col("times")
    late = tail.join(words, "key", "left").groupBy("row").agg(F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("late_known"), F.sum(log).alias("late_base"))
    out = scored.drop("tail").join(late, "row", "left")
    return out.select(F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("n_known") + F.coalesce("late_known", F.lit(0))).alias("n_known"),
                      F.lit(model.n_all).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("late_base", F.lit(0.0))).alias("base_score"), "score")


def _steps(n: Column) -> Column:
    """How often a count's n-gram is inserted: the number of values of the scale up to it."""
    k = F.length(F.bin(n)) - 1
    half = F.when(n >= F.pow(F.lit(2.0), k) * 1.5, 1).otherwise(0)
    return F.when(n == 1, 1).otherwise(2 * k + half)


def runs(values: np.ndarray) -> Iterator[slice]:
    """Stretches of equal neighbours."""
    cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
    return itertools.starmap(slice, itertools.pairwise([0, *cuts.tolist(), len(values)]))


def lm_scores(docs: DataFrame, folds: int = 7, fold: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id_col, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Trains on rows whose crc32(id as text) modulo ``folds`` is not ``fold`` (a null id: ''), and
    scores all.  Tokens: A-Z-folded words and one end, so a null or empty text has one
    token.  base_score uses exact counts with one added; words beyond the HEAD most
    frequent ones are joined with their counts.  Without training rows all counts are 0.
    """
    held = held_back(id_col, folds, fold)
    return score(docs, train(docs, ~held, text_col), held, id_col, text_col)


def op7_lm_scoring(spark, sf_dir: str) -> DataFrame:
    """Every row of ``documents`` scored by the model and by the exact unigram base."""
    return lm_scores(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
