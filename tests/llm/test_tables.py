"""Embedding whitening, sharding and importance resampling."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF, edge_texts
from pyspark.sql import functions as F

from haulkit.llm import hash_tree as H
from haulkit.llm import importance as I
from haulkit.llm import whitening as W

VECTORS = "vec_id long, embedding array<float>, label int, id long, vector string, component int, n long, i int, s double"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "x", 2, 3, 4, 5.0) for i, v in rows], VECTORS)


# ---- whitening ----------------------------------------------------------------------------------------------------

def check_whitened(out, kept, most=32):
    """``out`` against dense algebra over the kept (id, vector) rows."""
    y = np.floor(64 * np.array([v for _, v in kept], float))
    n, c = len(y), y - y.mean(0)
    v = c.T @ c / n
    values, u = np.linalg.eigh(v)
    values, u = values[::-1], u[:, ::-1]
    k = min(most, int((values > 1e-9 * values[0]).sum()))
    assert len(out) == n * k
    want = Counter((i, int(d)) for (i, _), d in zip(kept, ((n * y - y.sum(0)) ** 2).sum(1)))
    for component in range(1, k + 1):
        rows = [r for r in out if r.component == component]
        assert Counter((r.vec_id, int(r.deviation)) for r in rows) == want
        assert {r.n for r in rows} == {n} and {r.explained for r in rows} == {rows[0].explained}
        assert rows[0].explained == pytest.approx(values[component - 1] / np.trace(v), rel=1e-9)
        got = sorted(abs(r.whitened) for r in rows)
        assert got == pytest.approx(sorted(np.abs(c @ u[:, component - 1]) / math.sqrt(values[component - 1])), abs=1e-6)
    assert max(r.identity_error for r in out) < 1e-9


def test_whitened_rows_equal_dense_algebra(spark):
    rng = np.random.default_rng(5)
    a = rng.normal(size=(300, 8)) @ np.diag([5, 3, 2, 1, 1, .5, .3, .2]) + 40
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(a)]
    bad = [(None, None), (900, []), (901, [1.0] * 7 + [None]), (902, [1.0] * 7 + [float("nan")]), (903, [float("inf")] + [1.0] * 7),
           (904, [1.0, 2.0]), (905, [1e30] + [0.0] * 7)]
    same = [(None, rows[3][1]), (7, rows[3][1]), (7, rows[3][1])]
    kept = [(i, np.float32(v).tolist()) for i, v in rows + same]
    out = W.whiten(vectors(spark, rows + bad + same).repartition(3)).collect()
    check_whitened(out, kept)
    assert {r.component for r in W.whiten(vectors(spark, rows + same), most=3).collect()} == {1, 2, 3}


def test_whitening_of_large_and_dependent_entries(spark):
    rng = np.random.default_rng(6)
    a = rng.normal(size=(200, 4)) * [1e8, 3e7, 1e7, 1e6]
    rows = [(i, [*map(float, v), float(v[0])]) for i, v in enumerate(np.float32(a))]  # the fifth repeats the first
    out = W.whiten(vectors(spark, rows)).collect()
    assert {r.component for r in out} == {1, 2, 3, 4} and max(r.identity_error for r in out) < 1e-9
    y = np.array([[math.floor(64 * x) for x in v] for _, v in rows], object)
    n, s = len(y), y.sum(0)
    want = {i: int(((n * v - s) ** 2).sum()) for (i, _), v in zip(rows, y)}
    assert {r.vec_id: int(r.deviation) for r in out} == want


def test_nothing_to_whiten(spark):
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]):
        assert W.whiten(vectors(spark, rows)).count() == 0


def test_query_whitens_the_table(spark, small):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    out = W.op11_whitening(spark, SF)
    assert dict(out.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double",
                                "explained": "double", "identity_error": "double"}
    check_whitened(out.collect(), [(r.vec_id, r.embedding) for r in table])


def test_products_and_squares_are_exact():
    rng = np.random.default_rng(1)
    y = rng.integers(-(1 << 44), 1 << 44, (50, 3))
    exact = y.astype(object)
    assert (W.products(y) == exact.T @ exact).all()
    t = W.centred(y, 10 ** 6, [5, -7, 1 << 60])
    assert (W.squared(t) == ((exact * 10 ** 6 - np.array([5, -7, 1 << 60], object)) ** 2).sum(axis=1)).all()


def test_small_eigenvalues_are_accurate():
    scale = np.diag(10.0 ** -np.arange(6))
    base = np.array([[2.0 if i == j else 1 / (1 + abs(i - j)) for j in range(6)] for i in range(6)])
    values, u = W.principal(scale @ base @ scale)
    assert np.abs(u.T @ u - np.eye(6)).max() < 1e-14
    assert np.prod(values) == pytest.approx(np.linalg.det(base) * 1e-30, rel=1e-10)


# ---- shards -------------------------------------------------------------------------------------------------------

def placed(tree, key):
    """The shard of a key by the definition."""
    def drawn(name, weight):
        return -math.log((int(hashlib.md5(f"{key}:{name}".encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52) / weight

    prefix = ()
    for depth in range(3):
        weights = {}
        for leaf in tree.leaves:
            if leaf[:depth] == prefix:
                weights[leaf[:depth + 1]] = weights.get(leaf[:depth + 1], 0) + leaf[3]
        prefix = min((p for p in weights if weights[p]), key=lambda p: drawn(".".join(map(str, p)), weights[p]))
    return prefix[2]


def test_shards_of_edge_rows(spark, edge, empty, monkeypatch):
    monkeypatch.setattr(H, "CHUNK", 2)
    tree = H.Tree.regular(5, racks=2, per_rack=2)
    docs = edge.unionByName(edge.filter("doc_id = 12"))
    out = H.assign_shards(docs, tree, tree.grown()).collect()
    texts = [*edge_texts(), *(t for t in edge_texts() if t[0] == 12)]
    want = Counter((i, len((x or "").encode()) + 8, zlib.crc32((x or "").encode())) for i, x in texts)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == want
    for r in out:
        key = "" if r.doc_id is None else str(r.doc_id)
        assert (r.shard, r.grown_shard) == (placed(tree, key), placed(tree.grown(), key)) and r.law == "key"
    for shard in {r.shard for r in out}:
        assert sorted(r.slot for r in out if r.shard == shard) == list(range(sum(r.shard == shard for r in out)))
    assert H.assign_shards(empty, tree).count() == 0


def test_many_copies_are_numbered(spark, monkeypatch):
    monkeypatch.setattr(H, "CHUNK", 16)
    docs = spark.range(500).select(F.lit(7).alias("doc_id"), F.lit("x").alias("text")).unionByName(
        spark.range(20).select(F.col("id").cast("int").alias("doc_id"), F.lit("y").alias("text")))
    out = H.assign_shards(docs, H.Tree.regular(3)).collect()
    for shard in range(3):
        assert sorted(r.slot for r in out if r.shard == shard) == list(range(sum(r.shard == shard for r in out)))
    assert len(out) == 520 and {r.grown_shard for r in out} == {None}


def test_weights_and_movement(spark):
    keys = spark.range(20000).select(F.col("id").cast("string").alias("k")).cache()
    tree = H.Tree(((0, 0, 0, 1.0), (0, 0, 1, 3.0), (0, 1, 2, 2.0), (1, 0, 3, 2.0), (1, 0, 4, 0.0), (1, 1, 5, 2.0)))

    def where(t):
        return {r.k: r.s for r in keys.select("k", t.place(F.col("k")).alias("s")).collect()}

    old, region = where(tree), {leaf[2]: leaf[0] for leaf in tree.leaves}
    shares = Counter(old.values())
    assert shares[4] == 0
    for _, _, shard, weight in tree.leaves:
        assert shares[shard] == pytest.approx(2000 * weight, abs=250)
    grown = where(tree.grown(2.0))
    assert all(grown[k] in (old[k], 6) for k in old) and Counter(grown.values())[6] == pytest.approx(20000 * 2 / 12, abs=250)
    heavier = where(tree.weighed(0, 2.0))
    moved = [(old[k], heavier[k]) for k in old if old[k] != heavier[k]]
    assert moved and all(region[b] == 0 for _, b in moved)  # into the region that grew
    assert all(b in (0, 1) for a, b in moved if a == 2)  # in that region, into the rack that grew
    assert all(b == 0 for a, b in moved if a in (0, 1))  # in that rack, into the shard that grew


def test_trees_that_cannot_be():
    with pytest.raises(ValueError):
        H.Tree(((0, 0, 1, 1.0), (1, 0, 1, 1.0)))
    with pytest.raises(ValueError):
        H.Tree(((0, 0, 1, 0.0),))


def test_shards_written_whole(spark, edge, tmp_path):
    tree = H.Tree.regular(4, racks=1, per_rack=2)
    H.write_shards(edge, tree, str(tmp_path / "s"), files=2)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert Counter((r.doc_id, r.text) for r in back.collect()) == Counter(edge_texts())
    assert all(r.shard == placed(tree, "" if r.doc_id is None else str(r.doc_id)) for r in back.select("shard", "doc_id").collect())
    with pytest.raises(ValueError):
        H.write_shards(edge.withColumn("shard", F.lit(1)), tree, str(tmp_path / "t"))


# ---- importance ---------------------------------------------------------------------------------------------------

def lower_words(text):
    out, word = [], b""
    for b in (text or "").encode() + b" ":
        b = b + 32 if 65 <= b <= 90 else b
        if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128:
            word += bytes([b])
        elif word:
            out.append(word)
            word = b""
    return out


def runs(text, low, high):
    w = lower_words(text)
    return [b" ".join(w[i:i + n]) for n in range(low, high + 1) for i in range(len(w) - n + 1)]


def brute_resample(docs, target, percent=10, least=20, low=1, high=1, buckets=10000, seed=2024):
    s, t = Counter(), Counter()
    for side, texts in ((s, [x for _, x in docs]), (t, target)):
        for x in texts:
            side.update(zlib.crc32(f) % buckets for f in runs(x, low, high))
    s_all, t_all = sum(s.values()), sum(t.values())
    rows = []
    for i, x in docs:
        f = runs(x, low, high)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in (zlib.crc32(k) % buckets for k in f))
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(lower_words(x)), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32)))))
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    rank = [(r, k + 1) for k, r in enumerate(able[:len(able) * percent // 100])]
    rest = Counter(rows)
    rest.subtract(r for r, _ in rank)
    return Counter((*r, k) for r, k in rank) + Counter({(*r, None): c for r, c in rest.items()})


@pytest.mark.parametrize(("low", "high", "buckets"), [(1, 1, 10000), (1, 2, 64), (2, 3, 1000)])
def test_resampling_of_edge_rows(spark, edge, empty, low, high, buckets, monkeypatch):
    monkeypatch.setattr(I, "WORDS", 5000)
    target = spark.createDataFrame([("a b c d nobody word1 of",), (None,), ("",)], "text string")
    kinds = {"percent": 60, "least_words": 3, "low": low, "high": high, "buckets": buckets}
    got = Counter(map(tuple, I.resample(edge, target, **kinds).collect()))
    assert got == brute_resample(edge_texts(), ["a b c d nobody word1 of", None, ""], 60, 3, low, high, buckets)
    got = Counter(map(tuple, I.resample(edge, empty.select("text"), **kinds).collect()))
    assert got == brute_resample(edge_texts(), [], 60, 3, low, high, buckets)
    assert I.resample(empty, target).count() == 0


@pytest.mark.parametrize("k", [0, 1, 2, 57, 300, 599, 600, 601])
def test_cutoff_is_exact(spark, k):
    rows = [(s * s % 11, None if s % 7 == 0 else s % 20, s) for s in range(600)]  # many ties, repeated and null ids
    df = spark.createDataFrame(rows, "score long, id long, place long").repartition(5)
    order = sorted(rows, key=lambda r: (-r[0], r[1] is None, r[1] or 0, r[2]))
    want = order[k - 1] if 1 <= k <= 600 else None
    assert I.cutoff(df, k, group=16, last=3) == want


def test_ranks_count_on(spark):
    rows = [(s % 3, None, s) for s in range(2000)]
    out = I.numbered(spark.createDataFrame(rows, "score long, id string, place long")).collect()
    got = [(r.score, r.place) for r in sorted(out, key=lambda r: r["rank"])]
    assert [r["rank"] for r in sorted(out, key=lambda r: r["rank"])] == list(range(1, 2001))
    assert got == sorted(((r[0], r[2]) for r in rows), key=lambda r: (-r[0], r[1]))


def test_text_ids(spark):
    docs = [(f"d{k}", f"w{k} x y z " * 30) for k in range(40)] + [("ü", "x " * 30), (None, "y " * 30)]
    df = spark.createDataFrame(docs, "doc_id string, text string")
    got = I.resample(df, spark.createDataFrame([("x y",)], "text string"), percent=50)
    ranks = sorted(r["rank"] for r in got.collect() if r["rank"])
    assert ranks == list(range(1, 22))


def test_crc_of_runs():
    texts = ["Aa bB-ccc  9", None, "", "é漢 " + "long" * 50 + " z", "- -"]
    n, pieces = I.features(pa.array(texts), 1, 3, 1 << 31)
    assert n.tolist() == [len(lower_words(x)) for x in texts]
    got = Counter((int(d), int(b)) for doc, bucket in pieces for d, b in zip(doc, bucket))
    assert got == Counter((d, zlib.crc32(f) % (1 << 31)) for d, x in enumerate(texts) for f in runs(x, 1, 3))
