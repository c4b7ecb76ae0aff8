"""Helpers of several operators: tables in the shared folder, key filters of a
fixed size, and words of a column of texts as numpy arrays.

A *key filter* is a bitmap of ``2**bits`` bits with one hash per key.  It says
"maybe" or "certainly not", its size never depends on the data, and every use
of it is followed by an exact step; a crowded filter costs time, not rows.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Separators of words are \x20 and \x09-\x0D; everything else belongs to a word.
WORD = r"[^\x20\x09-\x0D]+"
#: Bits of one row of a key filter, as bitmap_construct_agg makes them.
PAGE = 32768
#: Bytes of text that a task turns into arrays at a time; a longer text makes a block of its own.
BLOCK = 2 << 20
#: The same where a byte of text becomes many of arrays.
SMALL = 384 << 10


def small_batches(spark: SparkSession, size: int = 2 << 20) -> None:
    """Send rows to Python in batches of about ``size`` bytes at most (Spark's own bound is 64 MB); the setting stays."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors see.

    Where it is unset a local session gets a temporary folder; any other master raises.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="haulkit-llm-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


#: Tables that this process has written, in order.
_written: list[str] = []


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a table in the shared folder and read that: later steps neither
    repeat the work above nor lose it with an executor."""
    path = f"{shared_dir(df.sparkSession)}/haulkit/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written() -> int:
    """How many tables this process has written: a mark for ``discard``."""
    return len(_written)


def discard(spark: SparkSession, since: int) -> None:
    """Delete the tables written after ``since`` but for the last one: call it when nothing lazy reads the others any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in _written[since:-1]:
        path = jvm.org.apache.hadoop.fs.Path(path)
        path.getFileSystem(conf).delete(path, True)
    del _written[since:-1]


def text_of(name: str = "text") -> Column:
    """The text, null as the empty one."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def held_back(id_col: str, folds: int, fold: int) -> Column:
    """True for rows whose crc32(id as text) leaves ``fold`` modulo ``folds``; a null id counts as ''."""
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.pmod(F.crc32(key.cast("binary")), F.lit(folds)) == fold


def filter_pages(keys: DataFrame, hash_col: str, bits: int) -> DataFrame:
    """Rows (page, bitmap) of the key filter over a column of 64-bit hashes: at most 2**bits / 32768 of 4 KB."""
    place = F.pmod(F.col(hash_col), F.lit(1 << bits))
    return (keys.select(F.floor(place / PAGE).alias("page"), F.pmod(place, F.lit(PAGE)).alias("bit"))
            .groupBy("page").agg(F.bitmap_construct_agg("bit").alias("bitmap")))


def maybe_in(df: DataFrame, hash_col: str, pages: DataFrame, bits: int, flag: str) -> DataFrame:
    """``df`` with a boolean column: whether the key filter has the hash.

    The pages are broadcast: 2**bits / 8 bytes at most, whatever the input.
    """
    place = F.pmod(F.col(hash_col), F.lit(1 << bits))
    bit = F.pmod(place, F.lit(PAGE))
    byte = F.conv(F.hex(F.expr("substring(`__bitmap`, cast(`__bit` div 8 + 1 as int), 1)")), 16, 10).cast("int")
    with_page = df.withColumns({"__page": F.floor(place / PAGE), "__bit": bit})
    joined = with_page.join(F.broadcast(pages.select(F.col("page").alias("__page"), F.col("bitmap").alias("__bitmap"))),
                            "__page", "left")
    on = F.coalesce(F.expr("(shiftright(__byte, cast(__bit % 8 as int)) & 1) = 1"), F.lit(False))
    return joined.withColumn("__byte", byte).withColumn(flag, on).drop("__page", "__bit", "__bitmap", "__byte")


def with_copies(docs: DataFrame, copies: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 24) -> DataFrame:
    """The rows of ``docs`` as often as ``copies`` says: rows (id, mark, copies), one for each row of ``docs``.

    mark is xxhash64 of the text (null: ''), so rows that repeat an id are told apart;
    rows alike in both share what they get, and the first of them stands for all unless
    each stays once.  Rows that stay once are not shuffled: a key filter finds the others.
    """
    changed = (copies.groupBy("id", "mark").agg(F.sum("copies").alias("__total"), F.min("copies").alias("low"), F.max("copies").alias("high"))
               .filter("low <> 1 or high <> 1").select(F.col("id").cast(docs.schema[id_col].dataType).alias("__id"), F.col("mark").alias("__m"), "__total"))
    changed = materialise(changed, "copies")
    pages = filter_pages(changed.select(F.xxhash64("__id", "__m").alias("h")), "h", bits)
    marked = docs.withColumn("__mark", F.xxhash64(text_of(text_col)))
    marked = maybe_in(marked.withColumn("__key", F.xxhash64(F.col(id_col), F.col("__mark"))), "__key", pages, bits, "__changed")
    same = marked.filter("not __changed").select(*docs.columns)
    found = marked.filter("__changed").join(changed, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__mark") == F.col("__m")), "left")
    nth = F.row_number().over(Window.partitionBy("__key").orderBy("__mark"))
    times = F.when(F.col("__total").isNull(), 1).when(nth == 1, F.col("__total")).otherwise(0).cast("int")
    found = found.withColumn("__times", times).filter("__times > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times"))))
    return same.unionByName(found.select(*docs.columns))


def filter_array(keys: DataFrame, hash_col: str, bits: int) -> np.ndarray:
    """The key filter as one array of bytes, for a broadcast to Python tasks: 2**bits / 8 bytes, whatever the input."""
    out = np.zeros((1 << bits) // 8, np.uint8)
    step = PAGE // 8
    for page, bitmap in filter_pages(keys, hash_col, bits).toLocalIterator():
        out[page * step:(page + 1) * step] = np.frombuffer(bitmap, np.uint8)
    return out


def has(filter_bytes: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the filter has each 64-bit hash (as the JVM sees them: signed)."""
    place = hashes.view(np.uint64) & np.uint64(len(filter_bytes) * 8 - 1)
    return (filter_bytes[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


# ---- words as arrays ------------------------------------------------------------------------------------------

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_ODD = 0x9E3779B97F4A7C15 | 3  # base of the polynomial hashes; 3 modulo 4
_LETTERS = np.random.Generator(np.random.PCG64(20240607)).integers(0, 1 << 64, 256, np.uint64)
_FOLDED = _LETTERS.copy()
_FOLDED[65:91] = _LETTERS[97:123]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd base modulo 2**64 and their inverses, as far as needed."""

    def __init__(self, base: int = _ODD):
        self.base, self.back = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            self.up, self.down = (np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(n - 1, b, np.uint64))))
                                  for b in (self.base, self.back))
        return self.up, self.down


def spans_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray, powers: Powers) -> np.ndarray:
    """64-bit hash of each values[start:end], independent of where it stands."""
    up, down = powers(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:len(values)], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


class Words(NamedTuple):
    """Words of a block of texts: bytes, bounds of texts in bytes and in words, bounds of words in bytes, their hashes."""

    data: np.ndarray
    texts: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hashes: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.texts) - 1), np.diff(self.first))


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts (null: none), and the bounds of each."""
    texts = pc.fill_null(texts, b"" if pa.types.is_binary(texts.type) else "")
    large = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64 if large else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    if not len(texts) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]], bounds - bounds[0]


def words_of(texts: pa.Array, powers: Powers, fold: bool = False) -> Words:
    """Words of each text; ``fold``: hashes as if A-Z were lower case."""
    data, bounds = flat(texts)
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    hashes = spans_hash((_FOLDED if fold else _LETTERS)[data], start, end, powers) if len(start) else np.zeros(0, np.uint64)
    return Words(data, bounds, np.searchsorted(start, bounds), start, end, hashes)


def runs_hash(w: Words, n: int, powers: Powers) -> np.ndarray:
    """Hash of the n words from each word on; at places where fewer follow in the block the array ends."""
    at = np.arange(max(0, len(w.hashes) - n + 1))
    return spans_hash(w.hashes, at, at + n, powers)


def whole(w: Words, n: int) -> np.ndarray:
    """Whether n words of the same text stand from each of the places of runs_hash on."""
    last = np.repeat(w.first[1:], np.diff(w.first))
    at = np.arange(max(0, len(w.hashes) - n + 1))
    return at + n <= last[:len(at)]


def blocks(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about ``size`` bytes of text, or one longer text."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        total, at = np.concatenate(([0], np.cumsum(sizes))), 0
        while at < len(sizes):
            to = max(at + 1, int(np.searchsorted(total, total[at] + size, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def binaries(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """An Arrow array of the byte strings data[start:end], which may overlap."""
    sizes = end - start
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    if bounds[-1] >= 1 << 31:
        raise ValueError("more than 2 GB in one batch")
    take = np.arange(bounds[-1]) + np.repeat(start - bounds[:-1], sizes)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(bounds.astype(np.int32).tobytes()), pa.py_buffer(data[take].tobytes())])


# ---- windows that share their smallest gram ---------------------------------------------------------------------

def window_min(values: np.ndarray, n: int) -> np.ndarray:
    """The minimum of the n values from each place on."""
    least, width = values, 1
    while width * 2 <= n:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    return least if width == n else np.minimum(least[:len(least) - (n - width)], least[n - width:])


def minimisers(grams: np.ndarray, width: int, fits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(smallest gram of each window of ``width`` grams, grams that are the smallest of a window, once for each place).

    fits: which windows count.  A gram is the smallest of some window around it if it
    equals the largest of those windows' minima.  Equal windows at two places have two
    such grams, also where both lie in one run.
    """
    least = window_min(grams, width)
    edge = np.full(width - 1, ~np.uint64(0))
    highest = ~window_min(np.concatenate((edge, np.where(fits, ~least, ~np.uint64(0)), edge)), width)
    return least, grams[grams == highest]


def runs_of(least: np.ndarray, at: np.ndarray, doc: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Bounds, as indices of ``at``, of runs of neighbouring windows with one minimum, in one text, ``longest`` windows at most.

    at: first places of the windows, ascending; least and doc: minimum and text of each.
    """
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (least[1:] != least[:-1]) | (doc[1:] != doc[:-1]) | (at[1:] != at[:-1] + 1)
    start = np.flatnonzero(new)
    within = np.arange(len(at)) - np.repeat(start, np.diff(np.append(start, len(at))))
    start = np.flatnonzero(within % longest == 0)
    return start, np.append(start[1:], len(at))


def merged(flag: np.ndarray, at: np.ndarray, doc: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, end) of the stretches that flagged windows of a width cover; at and doc ascend together."""
    at, doc = at[flag], doc[flag]
    if not len(at):
        return doc, at, at
    new = np.ones(len(at), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (at[1:] > at[:-1] + width)
    start = np.flatnonzero(new)
    return doc[start], at[start], at[np.append(start[1:], len(at)) - 1] + width


def sorted_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches sorted by their first two columns as tables of whole buckets: what a batch
    has of its last bucket waits for the next batch."""
    held: list[pa.RecordBatch] = []
    bucket = None
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        last = (a[-1], b[-1])
        ended = np.flatnonzero((a != last[0]) | (b != last[1]))
        cut = int(ended[-1]) + 1 if len(ended) else 0
        if cut or bucket not in (None, last):
            if ready := held + ([batch.slice(0, cut)] if cut else []):
                yield pa.Table.from_batches(ready).combine_chunks()
            held, batch = [], batch.slice(cut)
        held.append(batch)
        bucket = last
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
