"""Quality rules with risk-controlled thresholds, in DataFrame operations only.

Each rule rejects texts whose measure is above a cutoff.  Cutoffs are not set by
hand: on labelled documents, a cutoff is admitted for a stratum only if an exact
binomial test shows that it rejects less than a given share of the good ones there.
Cutoffs of a rule are tested from the highest down to the first that fails, which
needs no correction among them (a fixed sequence); rules x strata share ``delta``
(Bonferroni).  The share ``alpha`` is divided over the rules, so that with
probability 1 - delta the rules together reject at most ``alpha`` of the good
documents of each stratum.  The lowest admitted cutoff of each rule and stratum is
used; a stratum with too few labels to tell gets none.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulkit.llm.shared import WORD, materialise, text_of

#: Strata: these languages, and all others as one.
LANGS = ("de", "en", "es", "fr")
#: Rules: measures of 0 to 1 (see ``measures``); cutoffs are multiples of 1 / STEPS below 1.
RULES = ("symbols", "dup_lines", "repeats", "capitals", "no_letters")
STEPS = 40


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated(words: Column, n: int = 3) -> Column:
    """Words that stand in a window of n words found twice or more in the array, first places included.

    Windows are compared by 64-bit hashes.  Where no hash stands twice the answer is 0;
    else (hash, place) is sorted, and equal neighbours are repeats.  Their places in
    order cover min(n, distance to the next) words each.  n log n in the text's length.
    """
    def hashes(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.xxhash64(*(w[i + (k - 1)] for k in range(n))))

    def places(h: Column) -> Column:
        def neighbours(s: Column) -> Column:
            same = F.zip_with(F.slice(s, 2, F.size(s)), s, lambda b, a: F.when(b["h"] == a["h"], F.array(a["p"], b["p"])))
            return F.sort_array(F.array_distinct(F.flatten(F.filter(same, lambda x: x.isNotNull()))))

        return let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p")))), neighbours)

    def covered(p: Column) -> Column:
        gaps = F.zip_with(F.slice(p, 2, F.size(p)), p, lambda b, a: F.least(b - a, F.lit(n)))
        return F.aggregate(gaps, F.lit(0), lambda total, g: total + F.coalesce(g, F.lit(n)))

    def count(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(let(places(h), covered))

    return let(words, lambda w: F.when(F.size(w) > n, let(hashes(w), count)).otherwise(F.lit(0))).cast("long")


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """Per row of ``docs``: id_col, mark (xxhash64 of the text), stratum, counts, and the measures of RULES in steps (0 to STEPS); one pass over the texts.

    A null text counts as empty, all its counts and measures are 0.  Languages
    other than LANGS, null among them, form the stratum ''.
    """
    text = text_of(text_col)

    def without(pattern: str) -> Column:
        return F.length(F.regexp_replace(text, pattern, "")).cast("long")

    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    counted = docs.select(
        F.col(id_col), F.xxhash64(text).alias("mark"), F.when(F.col(stratum_col).isin(*LANGS), F.col(stratum_col)).otherwise("").alias("stratum"),
        let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)),
            lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeated(w).alias("n_repeat_words"))).alias("w"),
        without(r"[\x20\x09-\x0D]+").alias("word_chars"), (F.length(text) - without("[#*$%&|<>]+")).alias("n_symbols"),
        let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))).alias("l"),
        (F.length(text) - without("[A-Z]+")).alias("upper"), (F.length(text) - without("[a-z]+")).alias("lower"))

    def steps(part: Column, of: Column) -> Column:
        return F.when(of > 0, F.floor(part * STEPS / of)).otherwise(0).cast("int")

    letters, chars = F.col("upper") + F.col("lower"), F.col("word_chars")
    return counted.select(
        id_col, "mark", "stratum", "w.n_words", "word_chars", "n_symbols", F.col("l.dup").alias("n_dup_lines"), "w.n_repeat_words",
        steps(F.least(F.col("n_symbols") * 4, chars), chars).alias("symbols"), steps(F.col("l.dup"), F.col("l.n")).alias("dup_lines"),
        steps(F.col("w.n_repeat_words"), F.col("w.n_words")).alias("repeats"), steps(F.col("upper"), letters).alias("capitals"),
        steps(chars - F.least(chars, letters * 2), chars).alias("no_letters"))


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X binomial(n, p), summed term by term in logarithms; 1 where k >= n p, as no test needs it there."""
    odds = math.log(p / (1 - p))
    zero = F.struct((n * math.log(1 - p)).alias("log"), F.exp(n * math.log(1 - p)).alias("sum"))

    def add(a: Column, i: Column) -> Column:
        log = a["log"] + F.log((n - i + 1) / i) + odds
        return F.struct(log.alias("log"), (a["sum"] + F.exp(log)).alias("sum"))

    total = F.when(k > 0, F.aggregate(F.sequence(F.lit(1).cast("long"), F.greatest(k, F.lit(1))), zero, add)["sum"]).otherwise(zero["sum"])
    return F.when(k >= n * p, 1.0).otherwise(total)


def cutoffs(measured: DataFrame, labels: DataFrame, alpha: float = 0.02, delta: float = 0.05, id_col: str = "doc_id") -> DataFrame:
    """Rows (stratum, rule, cutoff): a text whose measure is above the cutoff may go.

    ``labels`` has id_col and quality (1: good); a label of null quality or id tells
    nothing, an id labelled twice counts once, as good if any label says so.
    Rules without an admitted cutoff have no row; without labels there are none.
    """
    good = (labels.filter(f"{id_col} is not null and quality is not null").groupBy(F.col(id_col).alias("__id"))
            .agg(F.max("quality").alias("q")).filter("q = 1"))
    seen = measured.join(good, F.col(id_col) == F.col("__id"), "left_semi")
    per_value = (seen.select("stratum", F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.col(r).alias("value")) for r in RULES))).alias("x"))
                 .groupBy("stratum", "x.rule", "x.value").count())
    # at most len(LANGS) + 1 strata, STEPS + 1 values a rule: small from here on
    hist = per_value.groupBy("stratum", "rule").agg(F.collect_list(F.struct("value", "count")).alias("values"), F.sum("count").alias("n"))
    grid = hist.select("stratum", "rule", "n", "values", F.explode(F.sequence(F.lit(0), F.lit(STEPS - 1))).alias("cutoff"))
    k = F.aggregate(F.filter("values", lambda v: v["value"] > F.col("cutoff")), F.lit(0).cast("long"), lambda a, v: a + v["count"])
    tests = len(RULES) * (len(LANGS) + 1)
    tested = grid.withColumn("p", binomial_tail(k, F.col("n"), alpha / len(RULES)))
    # p falls with the cutoff, so the lowest that passes ends the sequence
    return tested.filter(F.col("p") <= delta / tests).groupBy("stratum", "rule").agg(F.min("cutoff").alias("cutoff"))


def quality_rules(docs: DataFrame, labels: DataFrame, alpha: float = 0.02, delta: float = 0.05, id_col: str = "doc_id",
                  text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """One row per row of ``docs``: id_col, mark, stratum, counts, base_failed, failed_rules and kept.

    base_failed: fewer than 50 words, or more than half of them in repeated windows
    of three.  kept: neither that nor a rule above its cutoff.  An empty table
    gives an empty one.
    """
    measured = materialise(measures(docs, id_col, text_col, stratum_col), "quality-measures")
    limits = cutoffs(measured, labels, alpha, delta, id_col).groupBy("stratum").agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("limits"))
    failed = F.filter(F.array(*(F.when(F.col(r) > F.col("limits")[r], F.lit(r)) for r in RULES)), lambda x: x.isNotNull())
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    # one row for each stratum, len(LANGS) + 1 in all
    out = measured.join(F.broadcast(limits), "stratum", "left").withColumn("failed_rules", failed).withColumn("base_failed", base)
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)).drop("limits")


def op5_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Counts and verdict for every row of ``documents``, cutoffs from all of ``labels``."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return quality_rules(docs, labels).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                              "base_failed", "kept", "stratum", "failed_rules")
