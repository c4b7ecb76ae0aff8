"""Near duplicates: SuperMinHash signatures, bands, links confirmed on whole sets, groups.

SuperMinHash (Ertl 2017) gives each element of a set one random permutation of
the m places of the signature: at step j the element offers j plus a random
fraction to the place its permutation has at j.  So places of one element exclude
each other, which makes the estimate vary less than with independent hashes, and
a set whose places all hold values below j + 1 needs no step beyond j.

Texts with equal sets are one class; only one of each class goes into the bands.
Within a bucket of a band no list of all pairs is made: members are compared with
the smallest and the largest id first, and confirmed links are grouped.  Texts of
buckets that still hold two groups are left.  A link between groups needs texts that share
80 % of either's shingles with the other, so shingles that stand in one group only
count for nothing, and a text with too many of those is done (most edited copies
are).  The others are joined by prefixes: with shingles in one order, the rarest first,
two such texts share one among the first 20 % of each, and behind the first that they
share enough must follow in both to make up 80 %.  Again members of a shingle are compared
with two of them first and linked groups become one, round by round; pairs are made only of
what no round joins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haulkit.llm.grouping import groups
from haulkit.llm.shared import SMALL, Powers, Words, blocks, filter_array, has, materialise, mix, runs_hash, small_batches, spans_hash, text_of, whole, words_of

STEP_BITS = 44  # a value of the signature: the step above these bits, a random fraction in them


def shingles(w: Words, n: int, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the distinct n-word shingles of each text; of fewer words, one of them all."""
    doc = w.doc
    kept = whole(w, n)
    hashes, docs = runs_hash(w, n, powers)[kept], doc[:len(kept)][kept]
    words = np.diff(w.first)
    few = np.flatnonzero((words > 0) & (words < n))
    if len(few):
        hashes = np.concatenate((hashes, spans_hash(w.hashes, w.first[few], w.first[few + 1], powers)))
        docs = np.concatenate((docs, few))
    own = mix(hashes + docs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    sorted_ = np.sort(own)
    twice = sorted_[1:][sorted_[1:] == sorted_[:-1]]
    if len(twice):
        first = np.ones(len(own), bool)
        again = np.flatnonzero(np.isin(own, twice))
        first[again] = False
        first[again[np.unique(own[again], return_index=True)[1]]] = True
        hashes, docs = hashes[first], docs[first]
    return docs, hashes


def super_minhash(docs: np.ndarray, hashes: np.ndarray, n_docs: int, m: int) -> np.ndarray:
    """The n_docs x m signatures of the sets of 64-bit hashes; without elements a signature is all ones."""
    signature = np.full(n_docs * m, ~np.uint64(0))
    places, step = None, 0
    while len(docs) and step < m:
        x = mix(hashes + np.uint64((step + 1) * 0xD1B54A32D192ED03 & (1 << 64) - 1))
        pick = (step + ((x & np.uint64(0xFFFFF)) * np.uint64(m - step) >> np.uint64(20))).astype(np.int64)
        value = (np.uint64(step) << np.uint64(STEP_BITS)) | (x >> np.uint64(64 - STEP_BITS))
        if places is None:
            place = pick
        else:
            rows = np.arange(len(docs))
            place = places[rows, pick].astype(np.int64)
            places[rows, pick] = places[:, step]
        np.minimum.at(signature, docs * m + place, value)
        open_ = signature.reshape(n_docs, m).max(axis=1) >= np.uint64(step + 1) << np.uint64(STEP_BITS)
        left = open_[docs]
        if places is None:  # the first swap: place 0 stands where pick was
            docs, hashes, pick = docs[left], hashes[left], pick[left]
            places = np.tile(np.arange(m, dtype=np.uint8), (len(docs), 1))
            places[np.arange(len(docs)), pick] = 0
        elif not left.all():
            docs, hashes, places = docs[left], hashes[left], places[left]
        step += 1
    return signature.reshape(n_docs, m)


def signatures(docs: DataFrame, shingle: int, bands: int, rows: int, id_col: str, text_col: str) -> DataFrame:
    """(id, mark, n, set_a, set_b, bands): xxhash64 of the text, the size of each text's set, two hashes of the set, and the keys of its bands."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in blocks(batches, "text", SMALL):
            n_docs = batch.num_rows
            of, hashes = shingles(words_of(batch.column(1), powers, fold=True), shingle, powers)
            n = np.bincount(of, minlength=n_docs)
            set_a, set_b = np.zeros(n_docs, np.uint64), np.zeros(n_docs, np.uint64)
            np.add.at(set_a, of, mix(hashes))
            np.add.at(set_b, of, mix(hashes ^ np.uint64(0xA5A5A5A55A5A5A5A)))
            keys = np.empty((n_docs, bands), np.uint64)
            signature = super_minhash(of, hashes, n_docs, bands * rows)
            for b in range(bands):
                key = np.full(n_docs, b + 1, np.uint64)
                for r in range(rows):
                    key = mix(key ^ signature[:, b * rows + r]) + np.uint64(b + 1)
                keys[:, b] = key
            ends = np.concatenate(([0], np.cumsum(np.where(n > 0, bands, 0)))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(set_a.view(np.int64)), pa.array(set_b.view(np.int64)),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[n > 0].ravel().view(np.int64)))], ["id", "mark", "n", "set_a", "set_b", "bands"])

    read = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"), F.xxhash64(text_of(text_col)).alias("mark"))
    return read.mapInArrow(task, "id long, mark long, n long, set_a long, set_b long, bands array<long>")


def sets_of(docs: DataFrame, wanted: DataFrame, shingle: int, filter_bits: int, id_col: str, text_col: str) -> DataFrame:
    """(id, items): the shingle hashes of the wanted ids (column id), made again from their texts.

    Texts are passed over by a key filter on the id, so none is shuffled; ids that
    the filter lets pass by chance are dropped by the joins that follow.
    """
    keys = docs.sparkSession.sparkContext.broadcast(filter_array(wanted.select(F.xxhash64("id").alias("h")), "h", filter_bits))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            passed = pa.array(has(keys.value, batch.column(2).to_numpy()))
            for part in blocks([batch.filter(passed)], "text", SMALL):
                of, hashes = shingles(words_of(part.column(1), powers, fold=True), shingle, powers)
                order = np.argsort(of, kind="stable")
                ends = np.concatenate(([0], np.cumsum(np.bincount(of, minlength=part.num_rows)))).astype(np.int32)
                items = pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes[order].view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column(0), items], ["id", "items"])

    read = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).filter("id is not null")
    return read.withColumn("h", F.xxhash64("id")).mapInArrow(task, "id long, items array<long>")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) with 100 * intersection >= percent * union of their whole sets."""
    left = pairs.join(sets.select(F.col("id").alias("v"), F.col("items").alias("items_v")), "v")
    both = left.join(sets.select(F.col("id").alias("u"), F.col("items").alias("items_u")), "u")
    common = F.size(F.array_intersect("items_u", "items_v"))
    union = F.size("items_u") + F.size("items_v") - F.col("common")
    return both.withColumn("common", common).filter(100 * F.col("common") >= percent * union).select("u", "v")


def between_groups(left: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) that join ids of different groups, enough to join all that any such links join; left: (id, n, g).

    Members of a shingle are compared with those of its first and last group, and groups that are found to be
    linked become one, until this finds no more: a family of linked texts takes rounds and not pairs.  What
    is left are texts of groups that share shingles but no link with those; all their pairs are compared.
    """
    item = materialise(left.join(sets, "id").select("id", "n", "g", F.explode("items").alias("item")), "items")
    for _ in range(2):  # texts that go take their shingles with them, so a second time drops more
        common = item.groupBy("item").agg(F.count("*").alias("df"), F.min("g").alias("g0"), F.max("g").alias("g1")).filter("g0 <> g1").select("item", "df")
        shared = item.select("id", "n", "g", "item").join(common, "item")
        enough = shared.groupBy("id", "n").agg(F.count("*").alias("s")).filter(f"100 * s >= {percent} * n").select("id", "s")
        item = materialise(shared.join(enough, "id"), "items")
    # the first n - ceil(n * percent / 100) + 1 of the n shingles; those of one group only, n - s, come first and match nothing
    rank = F.row_number().over(Window.partitionBy("id").orderBy("df", "item"))
    prefix = item.withColumn("nth", rank).filter(f"nth <= s - ceil(n * {percent} / 100) + 1").selectExpr("id", "n", "g", "item", "s - nth as rest")
    prefix = materialise(prefix, "prefixes")
    # at the first item that two texts share, 1 + the smaller rest bounds what they share; later items may pass or not
    near = f"g <> h and {100 + percent} * (1 + least(rest, rest_v)) >= {percent} * (n + m)"
    pair = [F.least("id", "v").alias("u"), F.greatest("id", "v").alias("v")]
    links, tried = None, None
    while True:
        end = F.struct(F.col("g").alias("h"), F.col("id").alias("v"), F.col("n").alias("m"), F.col("rest").alias("rest_v"))
        ends = prefix.groupBy("item").agg(F.min(end).alias("low"), F.max(end).alias("high")).filter("low.h <> high.h")
        stars = (prefix.join(ends, "item").withColumn("e", F.explode(F.array("low", "high"))).select("id", "n", "g", "rest", "e.*")
                 .filter(near).select(*pair).distinct())
        if tried is not None:
            stars = stars.join(tried, ["u", "v"], "left_anti")
        stars = materialise(stars, "stars")
        found = materialise(confirmed(stars, sets, percent), "links")
        tried = stars if tried is None else tried.unionByName(stars)
        if found.isEmpty():
            break
        links = found if links is None else links.unionByName(found)
        of = prefix.select("id", "g").distinct()
        joined = found.join(of.withColumnsRenamed({"id": "u", "g": "gu"}), "u").join(of.withColumnsRenamed({"id": "v", "g": "gv"}), "v")
        now = groups(joined.select(F.col("gu").alias("u"), F.col("gv").alias("v")).distinct()).withColumnsRenamed({"id": "g", "group": "new"})
        prefix = materialise(prefix.join(now, "g", "left").withColumn("g", F.coalesce("new", "g")).drop("new"), "prefixes")
    other = prefix.selectExpr("item", "id as v", "n as m", "g as h", "rest as rest_v")
    pairs = prefix.join(other, "item").filter(f"g < h and {near}").select(*pair).distinct().join(tried, ["u", "v"], "left_anti")
    rest = materialise(confirmed(pairs, sets, percent), "links")
    return rest if links is None else rest.unionByName(links)


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, bands: int = 24, rows: int = 4,
                    filter_bits: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id_col, n_shingles, component_id, kept, mark (xxhash64 of the text).

    A text's set has its distinct shingles of A-Z-folded words, the whole sequence
    if it has fewer words, and nothing if it has none (or is null): then it is linked
    with nothing.  Links join texts with 100 * intersection >= percent * union;
    component_id is the smallest id a row reaches, and that row stays.  A pair at
    exactly 80 % shares no band with probability (1 - 0.8^rows)^bands, 3e-6 by default.
    Rows that repeat an id are one document for links, and one of them stays; a row
    without id is linked with nothing and stays (component_id null).  Ids are whole
    numbers that a long holds.
    """
    small_batches(docs.sparkSession)
    signed = materialise(signatures(docs, shingle, bands, rows, id_col, text_col), "signatures")
    classes = materialise(signed.filter("n > 0 and id is not null").groupBy("set_a", "set_b")
                          .agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands")), "classes")
    member = classes.select(F.explode("bands").alias("key"), F.col("rep").alias("id"), "n")
    end = F.struct("id", "n")
    sizes = member.groupBy("key").agg(F.min(end).alias("low"), F.max(end).alias("high"), F.count("*").alias("members")).filter("members > 1")
    buckets = materialise(member.join(sizes, "key"), "buckets")
    sets = materialise(sets_of(docs, buckets.select("id").distinct(), shingle, filter_bits, id_col, text_col), "sets")

    # smallest and largest id of a bucket against its other members
    stars = buckets.select(F.explode(F.array("low", "high")).alias("e"), "id", "n").filter(
        f"e.id <> id and 100 * least(n, e.n) >= {percent} * greatest(n, e.n)")
    stars = stars.select(F.least("id", "e.id").alias("u"), F.greatest("id", "e.id").alias("v")).distinct()
    links = materialise(confirmed(stars, sets, percent), "links-1")
    grouped = materialise(groups(links), "groups-1")

    labelled = buckets.join(grouped, "id", "left").select("key", "id", "n", F.coalesce("group", "id").alias("g"))
    mixed = labelled.groupBy("key").agg(F.min("g").alias("g0"), F.max("g").alias("g1")).filter("g0 <> g1").select("key")
    left = materialise(labelled.join(mixed, "key", "left_semi").select("id", "n", "g").distinct(), "left")
    more = between_groups(left, sets, percent)
    if not more.isEmpty():
        grouped = materialise(groups(grouped.select(F.col("id").alias("u"), F.col("group").alias("v")).unionByName(more)), "groups-2")

    whose = classes.select("set_a", "set_b", F.col("rep").alias("cid")).join(
        grouped.withColumnRenamed("id", "cid"), "cid", "left").select("set_a", "set_b", F.coalesce("group", "cid").alias("component_id"))
    full = signed.filter("n > 0 and id is not null").join(whose, ["set_a", "set_b"]).select("id", "mark", "n", "component_id")
    rest = signed.filter("n = 0 and id is not null").select("id", "mark", "n", F.col("id").alias("component_id"))
    nth = F.row_number().over(Window.partitionBy("id").orderBy("component_id", "mark"))
    nameless = signed.filter("id is null").select("id", "mark", "n", F.col("id").alias("component_id"), F.lit(1).alias("nth"))
    out = full.unionByName(rest).withColumn("nth", nth).unionByName(nameless)
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
                      (F.col("id").eqNullSafe(F.col("component_id")) & (F.col("nth") == 1)).alias("kept"), "mark")


def op9_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Every row of ``documents``: shingles of four words, links from 80 %, the smallest id of its group."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), shingle=4).drop("mark")
