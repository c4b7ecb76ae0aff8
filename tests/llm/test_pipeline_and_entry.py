import os

import duckdb
import pytest
from brute import components, quality_counts
from conftest import SF
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from haulkit.llm import quality as Q
from haulkit.llm import shared as S
from haulkit.llm.queries import ORACLE, QUERIES
from haulkit.llm.sentencepiece_nbest import decode
from haulkit.llm.shared import WORD, text_of


def test_all_text_queries_are_registered():
    names = list(entry.queries())
    assert "pipeline" in names and set(QUERIES) <= set(names)
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_agrees(spark, small, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    want = con.execute(ORACLE[name]).fetchall()
    columns = [d[0] for d in con.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    in_order = {"key": lambda r: tuple((x is None, x) for x in r)}
    assert sorted(map(tuple, got.select(*columns).collect()), **in_order) == sorted(want, **in_order)


def brute_stages(spark):
    """(id, text, source) after quality rules, exact dedup and near-dedup."""
    docs = [(r.doc_id, r.text, r.lang, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    good = []
    for i, x, _, s in docs:
        n, _, _, _, repeat = quality_counts(x)
        if n >= 50 and 100 * repeat <= 50 * n:
            good.append((i, x, s))
    stays = {}
    for i, x, _ in good:
        stays[x] = max(stays.get(x, i), i)
    distinct = [r for r in good if stays[r[1]] == r[0]]
    group = components({i: x for i, x, _ in distinct}, 5)
    return good, distinct, [r for r in distinct if group[r[0]][1] == r[0]]


def test_stages_against_brute_force(spark, small):
    docs, found = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        found.append(docs)
        if len(found) < len(corpus_pipeline.STAGES):
            assert tuple(docs.columns) == corpus_pipeline.COLUMNS
    # too few labels at this size to admit a threshold: the base rules alone decide
    assert Q.cutoffs(Q.measures(spark.read.parquet(f"{SF}/documents.parquet")), spark.read.parquet(f"{SF}/labels.parquet")).count() == 0
    for got, want in zip(found, brute_stages(spark), strict=False):
        assert sorted((r.doc_id, r.text, r.source) for r in got.collect()) == sorted(want)
    sized = {(r.doc_id): (r.source, r.n) for r in found[2].select("doc_id", "source", F.regexp_count(text_of(), F.lit(WORD)).alias("n")).collect()}
    copies = {}
    for r in found[3].collect():
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    assert set(copies) <= set(sized) and max(copies.values()) <= 2
    taken, total = sum(sized[i][1] * c for i, c in copies.items()), sum(n for _, n in sized.values())
    assert taken == pytest.approx(1.5 * total, rel=0.1)
    assert sorted((r.doc_id, r.text) for r in decode(found[4]).collect()) == sorted((r.doc_id, r.text) for r in found[3].collect())


def test_run_writes_between_stages_and_keeps_the_last(spark, small):
    folder = f"{S.shared_dir(spark).removeprefix('file:')}/haulkit"
    before, lazy = set(os.listdir(folder)) if os.path.isdir(folder) else set(), QUERIES["op12_shards"](spark, SF)
    mine = set(os.listdir(folder))
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and {"doc_id", "ids", "score", "others"} <= set(out.columns)
    assert len(set(os.listdir(folder)) - mine) == 1 and mine - before and lazy.count() == len(small[1])  # others' tables stay


def test_stages_of_edge_rows_and_no_rows(spark, edge, empty):
    for docs in (edge, empty):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        assert docs.count() >= 0
