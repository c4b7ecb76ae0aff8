"""Exact, near and substring dedup against brute force."""

import random

import numpy as np
import pytest
from brute import components, sha, without_repeated_bytes, without_repeated_words
from conftest import edge_texts
from pyspark.sql import functions as F

from haulkit.llm import exact_dedup as E
from haulkit.llm import grouping as G
from haulkit.llm import minhash as M
from haulkit.llm import substring_dedup as W
from haulkit.llm import suffix_dedup as B


def test_exact_edge_rows(edge):
    out = E.exact_dedup(edge).collect()
    rows = edge_texts()
    assert len(out) == len(rows)
    groups = {}
    for i, x in rows:
        groups.setdefault(x or "", []).append(i)
    kept = [r for r in out if r.kept]
    assert len(kept) == len(groups)
    for r in out:
        own = next(g for x, g in groups.items() if r.doc_id in g and any(i == r.doc_id and (y or "") == x for i, y in rows) and len(g) == r.group_size)
        assert r.keep_id == max((i for i in own if i is not None), default=None)


def test_exact_empty(empty):
    assert E.exact_dedup(empty).count() == 0


def test_exact_unique_texts_are_not_read_whole(spark):
    docs = spark.createDataFrame([(1, "abc"), (2, "abd"), (3, "abd"), (4, "wxyz")], "doc_id long, text string")
    out = {r.doc_id: r for r in E.exact_dedup(docs).collect()}
    assert out[4].full_hash is None and out[4].kept and out[2].keep_id == 3 and not out[2].kept and out[1].group_size == 1


def test_super_minhash_estimates_similarity():
    rng = np.random.default_rng(5)
    m, errors = 96, []
    for n, common in ((400, 320), (60, 30), (8, 4), (1, 1)):
        items = rng.integers(0, 1 << 63, 2 * n - common, np.uint64)
        docs = np.repeat([0, 1], n)
        s = M.super_minhash(docs, np.concatenate((items[:n], items[n - common:])), 2, m)
        errors.append(abs((s[0] == s[1]).mean() - common / (2 * n - common)))
    assert max(errors) < 0.15 and errors[-1] == 0


def test_super_minhash_of_equal_sets_is_equal_in_any_order():
    items = np.random.default_rng(1).integers(0, 1 << 63, 50, np.uint64)
    s = M.super_minhash(np.repeat([0, 1], 50), np.concatenate((items, items[::-1])), 3, 96)
    assert (s[0] == s[1]).all() and (s[2] == ~np.uint64(0)).all()


def test_near_edge_rows(edge):
    texts = {i: x for i, x in edge_texts() if i is not None}
    want = components(texts, 5)
    out = M.near_duplicates(edge).collect()
    assert len(out) == len(edge_texts())
    for r in out:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id]
    assert sum(r.kept for r in out if r.doc_id is not None) == len({c for _, c in want.values()})


def test_near_empty(empty):
    assert M.near_duplicates(empty).count() == 0


def test_near_query_on_all_rows(spark, small):
    docs, rows = small
    want = components(dict(rows), 4)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in M.near_duplicates(docs, shingle=4).collect()}
    assert got == {i: (n, c, c == i) for i, (n, c) in want.items()}


def test_near_chain_that_no_star_confirms(spark):
    """Neighbours of a chain are linked, its ends are not: all are one group."""
    texts = [(k + 1, " ".join(f"t{i}" for i in range(20 * k, 20 * k + 300))) for k in range(12)]
    random.Random(3).shuffle(texts)
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    assert {r.component_id for r in M.near_duplicates(docs).collect()} == {1}


def test_groups_of_a_long_path_and_a_star(spark):
    path = [(k, k + 1) for k in range(100, 160)]
    star = [(k, 7) for k in range(8, 60)]
    found = {r.id: r.group for r in G.groups(spark.createDataFrame(path + star, "u long, v long").repartition(5)).collect()}
    assert all(found[k] == 100 for k in range(100, 161)) and all(found[k] == 7 for k in range(7, 60))


@pytest.mark.parametrize("hot", [1, 10_000])
def test_words_edge_rows(edge, monkeypatch, hot):
    monkeypatch.setattr(W, "HOT", hot)
    rows = edge_texts()
    want = sorted(zip((i or 0 for i, _ in rows), without_repeated_words([x for _, x in rows], 35), strict=True))
    got = sorted((r.doc_id or 0, (r.n_words, r.n_removed, r.kept.encode())) for r in W.remove_repeats(edge, 35).collect())
    assert got == want


def test_words_query_on_all_rows(small):
    docs, rows = small
    want = {i: w for (i, _), w in zip(rows, without_repeated_words([x for _, x in rows], 35), strict=True)}
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept.encode()) for r in W.remove_repeats(docs, 35).collect()}
    assert got == want


def test_words_empty(empty):
    assert W.remove_repeats(empty, 35).count() == 0


@pytest.mark.parametrize("hot", [1, 10_000])
def test_bytes_edge_rows(edge, monkeypatch, hot):
    monkeypatch.setattr(B, "HOT", hot)
    rows = [(-(1 << 62) if i is None else i, x) for i, x in edge_texts()]
    want = sorted(zip((i for i, _ in rows), without_repeated_bytes(rows, 100), strict=True))
    got = sorted((-(1 << 62) if r.doc_id is None else r.doc_id, (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))) for r in B.remove_repeats(edge, 100).collect())
    assert got == want


def test_bytes_query_on_all_rows(small):
    docs, rows = small
    want = {i: w for (i, _), w in zip(rows, without_repeated_bytes(rows, 100), strict=True)}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in B.remove_repeats(docs, 100).collect()}
    assert got == want


def test_bytes_empty(empty):
    assert B.remove_repeats(empty, 100).count() == 0


@pytest.mark.parametrize("length", [32, 47, 100, 200])
def test_first_equal_finds_the_first_place_of_each_string(length):
    rng = np.random.default_rng(length)
    part = rng.integers(97, 99, 400, np.uint8)
    data = np.concatenate((part, rng.integers(97, 99, 150, np.uint8), part[30:390], np.full(300, 97, np.uint8), part[5:]))
    at = np.arange(len(data) - length + 1)
    seen = {}
    want = [seen.setdefault(bytes(data[k:k + length]), k) for k in at]
    assert B.first_equal(data, at, length).tolist() == want


def test_difference_cover_covers():
    assert {(a - b) % B.COVER for a in B.RESIDUES for b in B.RESIDUES} == set(range(B.COVER))


def test_digests_of_the_queries(spark, small):
    _, rows = small
    got = {r.doc_id: r.kept_sha256 for r in B.op8_suffix_dedup(spark, "/root/testdata/sf0.001").collect()}
    assert got == {i: sha(w[3]) for (i, _), w in zip(rows, without_repeated_bytes(rows, 100), strict=True)}


def family(n, own, seed=9):
    """n texts of one template, each with ``own`` of its 100 words changed in places of its own."""
    rng = random.Random(seed)
    template = [f"t{i}" for i in range(300)]
    out = []
    for k in range(n):
        words = list(template)
        for at in rng.sample(range(300), own):
            words[at] = f"own{k}x{at}"
        out.append((k + 1, " ".join(words)))
    return out


def confirmed_pairs(monkeypatch):
    seen = []
    plain = M.confirmed

    def counting(pairs, sets, percent):
        seen.append(pairs.count())
        return plain(pairs, sets, percent)

    monkeypatch.setattr(M, "confirmed", counting)
    return seen


@pytest.mark.parametrize(("own", "linked"), [(2, True), (40, False)])
def test_a_family_of_one_template_takes_rounds_and_not_pairs(spark, monkeypatch, own, linked):
    """Texts that are each a group of their own at first, as no band has joined them."""
    seen = confirmed_pairs(monkeypatch)
    texts = family(120, own)
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    signed = M.signatures(docs, 5, 24, 4, "doc_id", "text").cache()
    sets = M.sets_of(docs, signed.select("id"), 5, 24, "doc_id", "text").cache()
    links = M.between_groups(signed.select("id", "n", F.col("id").alias("g")), sets, 80).collect()
    want = components(dict(texts), 5)
    parent = {i: i for i, _ in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in links:
        a, b = root(r.u), root(r.v)
        parent[max(a, b)] = min(a, b)
    assert {i: root(i) for i in parent} == {i: c for i, (_, c) in want.items()}
    assert (len({c for _, c in want.values()}) == 1) is linked
    if linked:
        assert sum(seen) < 120 * 119 / 2 / 2, seen  # pairs compared, of all


def test_first_equal_drops_places_once_found():
    """Places found equal to an earlier one leave the later shifts; hashes with equal upper bits may alternate."""
    import numpy as np

    from haulkit.llm.suffix_dedup import first_equal, gathered
    rng = np.random.default_rng(0)
    for length in (32, 33, 64, 100, 150):
        base = rng.integers(97, 100, 400).astype(np.uint8)
        data = np.concatenate([base[i:i + int(n)] for i, n in zip(rng.integers(0, 200, 12), rng.integers(length, 200 + length, 12), strict=True)])
        at, seen = np.flatnonzero(rng.random(len(data) - length + 1) < 0.9), {}
        want = [seen.setdefault(data[p:p + length].tobytes(), i) for i, p in enumerate(at)]
        assert first_equal(data, at, length).tolist() == want
    keys = np.array([5, 5, (1 << 60) + 1, (1 << 60) + 2, (1 << 60) + 1, (1 << 60) + 2] * 50, np.uint64)
    assert gathered(keys)[1].sum() == 3
