import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from haulkit.llm import shared as S

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet=" \t\n\x0b\x0c\rabABé ", max_size=30)), max_size=8)


@given(TEXTS, st.booleans())
@settings(max_examples=150, deadline=None)
def test_words_are_those_of_bytes_split(texts, fold):
    w = S.words_of(pa.array(texts, pa.string()), S.Powers(), fold)
    by_text = [[bytes(w.data[w.start[k]:w.end[k]]) for k in range(w.first[t], w.first[t + 1])] for t in range(len(texts))]
    assert by_text == [(x or "").encode().split() for x in texts]
    seen = {}
    for k, x in enumerate(b for row in by_text for b in row):
        x = x.lower() if fold else x
        assert seen.setdefault(x, w.hashes[k]) == w.hashes[k]
    assert len(set(seen.values())) == len(seen)


@given(st.lists(st.integers(0, 9), min_size=1, max_size=60), st.integers(1, 12), st.integers(0, 3))
@settings(max_examples=150, deadline=None)
def test_window_minima_and_places(values, width, skip):
    grams = S.mix(np.array(values, np.uint64) + np.uint64(1))
    if len(grams) < width:
        return
    windows = len(grams) - width + 1
    fits = np.arange(windows) % 4 != skip
    least, found = S.minimisers(grams, width, fits)
    assert least.tolist() == [min(grams[k:k + width]) for k in range(windows)]
    want = {p for k in range(windows) if fits[k] for p in range(k, k + width) if grams[p] == least[k]}
    assert sorted(found.tolist()) == sorted(grams[sorted(want)].tolist())


@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 2)), max_size=40), st.integers(1, 7))
@settings(max_examples=100, deadline=None)
def test_buckets_come_whole(keys, size):
    keys = sorted(keys)
    table = pa.table({"a": [a for a, _ in keys], "b": [b for _, b in keys], "n": list(range(len(keys)))},
                     schema=pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())]))
    out = [list(zip(*(t.column(c).to_pylist() for c in range(3)), strict=True)) for t in S.sorted_buckets(iter(table.to_batches(max_chunksize=size)))]
    assert [x for part in out for x in part] == [(a, b, n) for n, (a, b) in enumerate(keys)]
    homes = [{(a, b) for a, b, _ in part} for part in out]
    assert sum(map(len, homes)) == len(set(keys))


def test_key_filter_passes_all_keys_and_few_others(spark):
    keys = spark.range(500).select(F.xxhash64("id").alias("h"))
    others = spark.range(1000, 21000).select(F.xxhash64("id").alias("h"))
    pages = S.filter_pages(keys, "h", 20)
    assert pages.count() <= (1 << 20) // S.PAGE
    assert S.maybe_in(keys, "h", pages, 20, "in").filter("in").count() == 500
    passed = S.maybe_in(others, "h", pages, 20, "in").filter("in").count()
    assert passed < 100
    as_array = S.filter_array(keys, "h", 20)
    hashes = np.array([r.h for r in others.collect()], np.int64)
    assert S.has(as_array, hashes).sum() == passed
    assert S.has(as_array, np.array([r.h for r in keys.collect()], np.int64)).all()


def test_copies_of_rows(spark):
    docs = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (2, "b", "y"), (2, "c", "x"), (None, None, "x"), (3, "d", "x")], "doc_id long, text string, other string")
    n = {(1, "a"): 1, (2, "b"): 1, (2, "c"): 0, (None, None): 2, (3, "d"): 3}
    copies = docs.select(F.col("doc_id").alias("id"), F.xxhash64(S.text_of()).alias("mark"),
                         F.coalesce(*(F.when(F.col("doc_id").eqNullSafe(F.lit(k[0])) & F.col("text").eqNullSafe(F.lit(k[1])), v) for k, v in n.items())).alias("copies"))
    got = sorted((r.doc_id or 0, r.text or "") for r in S.with_copies(docs, copies).collect())
    assert got == [(0, ""), (0, ""), (1, "a"), (2, "b"), (2, "b"), (3, "d"), (3, "d"), (3, "d")]


def test_repeated_row_of_which_one_stays(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a")], "doc_id long, text string")
    mark = F.xxhash64(F.lit("a"))
    copies = spark.createDataFrame([(1, 1), (1, 0), (1, 0)], "id long, copies int").withColumn("mark", mark)
    assert S.with_copies(docs, copies).count() == 1
