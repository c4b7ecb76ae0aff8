"""Mixing, quality rules, token counts, segmentation, toxicity and language-model scores."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from brute import held_out, quality_counts, unigram_base, words
from conftest import edge_texts
from pyspark.sql import functions as F

from haulkit.llm import lattice as L
from haulkit.llm import lm_scoring as LM
from haulkit.llm import mixing as X
from haulkit.llm import quality as Q
from haulkit.llm import sentencepiece_nbest as N
from haulkit.llm import token_counts as T
from haulkit.llm import toxicity as TX
from haulkit.llm.shared import WORD, Powers, text_of


def targets(sizes, shares=(3, 1, 2), percent=150, most=2):
    """Water filling, source by source."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: shares[k % len(shares)] for k, s in enumerate(order)}
    rest, open_, out = sum(sizes.values()) * percent / 100, set(order), {}
    while open_:
        level = rest / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > most * sizes[s]}
        if not full:
            return out | {s: level * weight[s] for s in open_}
        for s in full:
            out[s] = most * sizes[s]
            rest -= out[s]
        open_ -= full
    return out


def mixed(docs):
    sized = docs.withColumn("__n", F.regexp_count(text_of(), F.lit(WORD)))
    return X.mix_sources(sized, F.col("__n"), X.clean_share(F.col("__n")))


def check_mix(out):
    sizes, taken, largest = {}, {}, {}
    for r in out:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        largest[r.source] = max(largest.get(r.source, 0), r.size)
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 2
    want = targets(sizes)
    for r in out:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6


def test_mix_edge_rows_and_reruns(edge):
    out = mixed(edge).collect()
    assert len(out) == len(edge_texts())
    check_mix(out)
    assert sorted(map(str, out)) == sorted(map(str, mixed(edge.repartition(7)).collect()))


def test_mix_sorts_only_the_bin_of_the_edge(spark):
    rng = random.Random(4)
    rows = [(k, "w " * rng.randrange(1, 30), "hot" if k % 3 else f"s{k % 7}") for k in range(4000)]
    check_mix(mixed(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect())


def test_mix_prefers_clean_documents(spark):
    rows = [(k, ("w " if k % 2 else "w# ") * 10, "s" if k % 4 < 2 else "t") for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs = docs.withColumn("__n", F.regexp_count(text_of(), F.lit(WORD)))
    out = X.mix_sources(docs, F.col("__n"), X.clean_share(F.col("__n")), percent=50).collect()
    copies = {odd: np.mean([r.copies for r in out if r.doc_id % 2 == odd]) for odd in (0, 1)}
    assert copies[1] > 2 * copies[0]


def test_mix_empty(empty):
    assert mixed(empty).count() == 0


def test_quality_counts(edge, empty, small):
    for docs, rows in ((edge, edge_texts()), small):
        got = sorted((r.doc_id or 0, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in Q.measures(docs).collect())
        assert got == sorted((i or 0, quality_counts(x)) for i, x in rows)
    assert Q.measures(empty).count() == 0


def test_binomial_tail(spark):
    def exact(k, n, p):
        return sum(math.comb(n, i) * p**i * (1 - p)**(n - i) for i in range(k + 1))

    for k, n, p in ((0, 100, 0.05), (1, 100, 0.05), (3, 400, 0.02), (20, 5000, 0.01)):
        got = spark.range(1).select(Q.binomial_tail(F.lit(k).cast("long"), F.lit(n).cast("long"), p)).first()[0]
        assert got == pytest.approx(exact(k, n, p), rel=1e-9)


def labelled(spark, n):
    """n texts, of which every eleventh is full of signs and labelled bad."""
    rng = random.Random(1)
    text = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) + str(rng.randrange(1000)) for _ in range(80)) for _ in range(n)]
    rows = [(k, x.replace(" ", "#$%& ") if k % 11 == 0 else x, "en") for k, x in enumerate(text)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame([(k, int(k % 11 > 0)) for k in range(n)], "doc_id long, quality int")


def test_thresholds_reject_bad_texts_and_keep_good_ones(spark):
    docs, labels = labelled(spark, 3000)
    out = Q.quality_rules(docs, labels).collect()
    assert all(r.kept for r in out if r.doc_id % 11) and not any(r.kept for r in out if r.doc_id % 11 == 0)


def test_too_few_labels_admit_no_threshold(spark):
    docs, labels = labelled(spark, 200)
    assert all(r.kept for r in Q.quality_rules(docs, labels).collect())
    none = labels.limit(0).unionByName(spark.createDataFrame([(None, 1), (1, None)], "doc_id long, quality int"))
    assert all(r.kept for r in Q.quality_rules(docs, none).collect())


def test_threshold_holds_its_promise(spark):
    """Cutoffs are such that the exact test passes; one step lower it fails."""
    docs, labels = labelled(spark, 2500)
    measured = Q.measures(docs).cache()
    good = {r.doc_id for r in labels.collect() if r.quality}
    values = [r.symbols for r in measured.collect() if r.doc_id in good]
    cut = {(r.stratum, r.rule): r.cutoff for r in Q.cutoffs(measured, labels).collect()}[("en", "symbols")]
    n, p, level = len(values), 0.02 / len(Q.RULES), 0.05 / (len(Q.RULES) * (len(Q.LANGS) + 1))

    def tail(c):
        k = sum(v > c for v in values)
        return sum(math.comb(n, i) * p**i * (1 - p)**(n - i) for i in range(k + 1)) if k < n * p else 1.0

    assert tail(cut) <= level and (cut == 0 or tail(cut - 1) > level)


@pytest.fixture(scope="module")
def vocabulary():
    return L.load(T.VOCABULARY)


def segmentations(token, v):
    out = []

    def walk(at, ids, score):
        if at == len(token):
            out.append((score, tuple(ids)))
        for to in range(at + 1, min(len(token), at + v.longest) + 1):
            if found := v.pieces.get(token[at:to]):
                walk(to, [*ids, found[0]], score + found[1])
            elif to == at + 1:
                walk(to, [*ids, *(v.first_byte + b for b in L.character_bytes(token[at]))], score + v.fallback)

    walk(0, [], 0.0)
    return sorted(out, key=lambda x: -x[0])


def test_viterbi_second_best_and_n_best_against_all_segmentations(vocabulary):
    v = vocabulary
    texts = ["Hello world", "", None, "a  b", "▁x é漢字 😀z", "tab\tnew\nline  ", "The cat sat on the mat. The them", "unwinding \x00"]
    p = L.pretokens([" " + t if t else "" for t in texts], v, Powers())
    t = L.forward(p, v)
    ids, bounds = L.spell(t, v)
    for w in range(len(p.distinct)):
        token = p.string(w)
        every = segmentations(token, v)
        assert every[0][0] == t.best[t.leaf[w]] and (every[1][0] if len(every) > 1 else -np.inf) == t.second[t.leaf[w]]
        assert (t.best[t.leaf[w]], tuple(ids[bounds[w]:bounds[w + 1]])) in every and t.tokens[t.leaf[w]] == bounds[w + 1] - bounds[w]
        found = N.n_best(token, N.ahead_of(t, int(t.leaf[w]), len(token)), 5, v)
        assert [x[0] for x in found] == [x[0] for x in every[:5]] and all(x in every for x in found) and len(set(found)) == len(found)


def test_n_best_of_a_text_combine_those_of_its_pretokens(spark, vocabulary):
    text = "the them on a mat"
    row = N.encode(spark.createDataFrame([(1, text)], "doc_id long, text string"), n=6).first()
    p = L.pretokens([" " + text], vocabulary, Powers())
    each = [segmentations(p.string(w), vocabulary) for w in p.which]
    totals = [0.0]
    for ways in each:
        totals = sorted((t + s for t in totals for s, _ in ways[:6]), reverse=True)[:6]
    assert [row.score, *(o.score for o in row.others)] == totals
    for o in row.others:
        changed = {c.pretoken: tuple(c.ids) for c in o.changes}
        assert sum(next(s for s, ids in ways if ids == changed[k]) if k in changed else ways[0][0] for k, ways in enumerate(each)) == o.score


def test_encoding_is_lossless_and_counted(edge, empty, spark):
    out = N.encode(edge, carry=("n_chars",))
    back = sorted((r.doc_id or 0, r.text) for r in N.decode(out).collect())
    assert back == sorted((i or 0, x or "") for i, x in edge_texts())
    n = sorted((r.doc_id or 0, len(r.ids), r.score) for r in out.collect())
    assert n == sorted((r.doc_id or 0, r.n_tokens, r.score) for r in T.token_counts(edge).collect())
    with pytest.raises(ValueError):
        N.encode(edge.withColumn("score", F.lit(1)), carry=("score",))
    assert N.encode(empty).count() == T.token_counts(empty).count() == 0


def test_long_texts_in_pieces_are_encoded_as_whole(spark, monkeypatch):
    text = " ".join(f"some words {k * k}  and  漢字 more" for k in range(400)) + "   "
    docs = spark.createDataFrame([(1, text), (2, "a short one"), (3, "x" * 3000), (4, " " * 900)], "doc_id long, text string")
    whole = {r.doc_id: r for r in N.encode(docs).collect()}
    counts = {r.doc_id: r for r in T.token_counts(docs).collect()}
    monkeypatch.setattr(N, "SMALL", 100)
    monkeypatch.setattr(T, "SMALL", 100)
    assert list(L.cut_text(" a  b c", 2)) == [" a", "  b", " c"]
    for r in N.encode(docs).collect():
        assert r.ids == whole[r.doc_id].ids and r.score == pytest.approx(whole[r.doc_id].score)
        assert [o.score for o in r.others] == pytest.approx([o.score for o in whole[r.doc_id].others])
    for r in T.token_counts(docs).collect():
        assert (r.n_pretokens, r.n_tokens) == (counts[r.doc_id].n_pretokens, counts[r.doc_id].n_tokens)


def test_queries_of_tokens_on_all_rows(spark, small):
    out = N.op3_sentencepiece(spark, "/root/testdata/sf0.001").collect()
    counts = {r.doc_id: r.n_tokens for r in T.op4_token_counts(spark, "/root/testdata/sf0.001").collect()}
    assert all(r.same_text and counts[r.doc_id] == r.n_pieces and sorted(r.scores, reverse=True) == list(r.scores) for r in out)
    assert len(out) == len(small[1])


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_automaton_finds_what_edit_distance_finds():
    rng = random.Random(2)
    terms = {"stupid": 5.0, "idiot": 4.0, "scum": 2.0, "clown": 3.0, "vequ*": 1.0}
    lexicon = TX.Lexicon(terms)
    for _ in range(3000):
        word = list(rng.choice(["stupid", "idiot", "scum", "clown", "vequabc"]))
        for _ in range(rng.randrange(3)):
            k = rng.randrange(len(word) + 1)
            word[k:k + rng.randrange(2)] = rng.choice(["", "x", "d", "i"])
        word = "".join(word)
        exact = max([w for t, w in terms.items() if t == word or t.endswith("*") and word.startswith(t[:-1])], default=0.0)
        near = max([w for t, w in terms.items() if not t.endswith("*") and len(t) >= TX.FUZZY and edits(t, word) <= 1], default=0.0)
        assert lexicon.find(word)[0] == (exact or near), word


def test_quotation_is_told_from_abuse_by_learnt_surroundings(spark):
    """The same term in abuse and in quotation: only the words around it, as learnt, tell them apart."""
    rng = random.Random(7)
    plain = [f"{a}{b}" for a in "bcdfglmnprst" for b in ("ato", "ilen", "orux", "anty")] + "you utter shut reportedly claimed one".split()

    def text(kind):
        filler = [rng.choice(plain) for _ in range(30)]
        if kind:
            filler[10:10] = {"abuse": ["you", "utter", "gromble", "shut"], "quote": ["reportedly", '"gromble"', "claimed", "one"]}[kind]
        return " ".join(filler)

    kinds = ["abuse"] * 400 + ["quote"] * 60 + [None] * 6000
    rows = [(k, text(kind)) for k, kind in enumerate(kinds)]
    labels = [(k, int(kind == "abuse")) for k, kind in enumerate(kinds)]
    out = {r.doc_id: r for r in TX.toxicity(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    held = {kind: [out[k] for k, x in enumerate(kinds) if x == kind and out[k].held_out] for kind in ("abuse", "quote")}
    assert all(r.predicted == 1 for r in held["abuse"]) and all(r.predicted == 0 for r in held["quote"]) and len(held["quote"]) > 5
    same = [r.exact for kind in held for r in held[kind]]
    assert max(same) == min(same) > 0  # the term itself says the same in both
    assert min(r.context for r in held["abuse"]) > 0 > max(r.context for r in held["quote"])


def test_toxicity_learns_from_training_rows_only(spark):
    rng = random.Random(6)
    vocabulary = [f"{a}{b}ing" for a in "bcdfglmn" for b in ("a", "e", "ali", "oru", "en")]
    rows, labels = [], []
    for k in range(1200):
        text = [rng.choice(vocabulary) for _ in range(40)]
        toxic = k % 4 == 0
        if toxic:
            text[rng.randrange(40)] = "gromble"
            text[rng.randrange(40)] = rng.choice(["Splonker!", "spl0nker"])
        if held_out(k, 5, 0):  # labels of held-out rows say the contrary; nobody may look
            labels.append((k, int(not toxic)))
        else:
            labels.append((k, int(toxic)))
        rows.append((k, " ".join(text)))
    rows += [(5000, None), (5001, ""), (None, "gromble")]
    out = TX.toxicity(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    right = [r.predicted == (r.doc_id % 4 == 0) for r in out if r.doc_id is not None and r.doc_id < 1200]
    assert np.mean(right) > 0.98
    assert {r.predicted for r in out if r.doc_id in (5000, 5001)} == {0}


def test_toxicity_admits_every_telling_term(spark):
    rng = random.Random(8)
    terms = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8)) for _ in range(600)]
    rows = [(k, " ".join([*terms[k % 20::20], f"rant{k}"]), 1) for k in range(100)] + [(k, f"plain text {k}", 0) for k in range(100, 500)]
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    lexicon = TX.learn_lexicon(table, table.select(F.col("doc_id").alias("id"), "toxic"), "doc_id", "text")
    assert set(terms) <= set(lexicon)


def test_misspelt_words_under_a_beginning_are_found():
    lexicon = TX.Lexicon(TX.pruned({"idiot*": (5.0, 100), "idiot": (5.0, 40), "idiots": (4.5, 20), "idiotic": (4.0, 20)}))
    assert lexicon.find("idiotism") == (5.0, 0) and lexicon.find("id1ots") == (4.5, 1) and lexicon.find("idoitic")[0] == 0.0 and lexicon.find("idi0tic") == (4.0, 1)


def test_toxicity_counts_each_text_once(spark):
    rows = [(k, "copied rant of many", 1) for k in range(900)] + [(k, f"rant {k} {'vexmord plainish' if k < 910 else ''}", 1) for k in range(900, 1000)]
    rows += [(k, f"calm {k} {'plainish' if k < 1200 else ''}", 0) for k in range(1000, 2000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    lexicon = TX.learn_lexicon(table, table.select(F.col("doc_id").alias("id"), "toxic"), "doc_id", "text")
    assert lexicon["vexmord"] == pytest.approx(math.log(10.5 / 102) - math.log(0.5 / 1001)) and not any(t.startswith("plain") for t in lexicon)


def test_toxicity_edits_of_any_letter_and_words_as_scored(spark):
    docs = spark.createDataFrame([(1, "you stup\u200bid"), (2, "you stu\U0001f600id"), (3, "you stuffid")], "doc_id long, text string")
    found = {r.id: r.misspelt for r in TX.hits(docs, {"stupid": 5.0}, "doc_id", "text").collect()}
    assert found == {1: 5.0, 2: 5.0, 3: 0.0}
    rows = [(k, f"grokel\u00a0vumpel {k}", 1) for k in range(20)] + [(k, f"calm {k}", 0) for k in range(20, 120)]
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    lexicon = TX.learn_lexicon(table, table.select(F.col("doc_id").alias("id"), "toxic"), "doc_id", "text")
    assert "grokel\u00a0vumpel" in lexicon and "vumpel" not in lexicon


def test_toxicity_without_labels(edge, empty, spark):
    none = spark.createDataFrame([(None, 1), (4, None)], "doc_id long, toxic int")
    out = TX.toxicity(edge, none).collect()
    assert len(out) == len(edge_texts()) and {round(r.score, 6) for r in out} == {0.01}
    assert TX.toxicity(empty, none).count() == 0


def test_toxicity_on_held_out_rows(spark, small):
    sf = "/root/testdata/sf0.1"
    out = {r.doc_id: r for r in TX.op6_toxicity(spark, sf).collect()}
    rows = [(out[r.doc_id].score, r.toxic) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if out[r.doc_id].held_out]
    bad, good = ([s for s, y in rows if y == k] for k in (1, 0))
    caught, wrong = sum(s >= 0.5 for s in bad), sum(s >= 0.5 for s in good)
    above = np.mean([(b > g) + (b == g) / 2 for b in bad for g in good])
    assert caught / len(bad) > 0.85 and caught / (caught + wrong) > 0.95 and above > 0.95


@pytest.mark.parametrize("head", [1 << 20, 50])
def test_lm_base_is_exact(spark, small, edge, monkeypatch, head):
    monkeypatch.setattr(LM, "HEAD", head)
    for docs, rows in (small, (edge, edge_texts())):
        want = sorted((i or 0, *w) for (i, _), w in zip(rows, unigram_base(rows), strict=True))
        got = sorted((r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in LM.lm_scores(docs).collect())
        assert len(got) == len(want)
        for g, w in zip(got, want, strict=True):
            assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], rel=1e-9) and g[6] < 0


def test_lm_beats_the_base_on_held_out_rows(spark, small):
    out = [r for r in LM.lm_scores(small[0]).collect() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_lm_filter_holds_all_pairs(spark, small, monkeypatch):
    """Every pair of the training texts counts, whatever their number: an old bound of the filter's bits has no effect."""
    docs, rows = small
    monkeypatch.setattr(LM, "MAX_BITS", 12, raising=False)
    monkeypatch.setattr(LM, "SEGMENT", 500)
    monkeypatch.setattr(LM, "UNIT", 3000, raising=False)
    tokens = [["<s>", *(w.lower() for w in words(x)), "</s>"] for _, x in rows]
    training = [t for (i, _), t in zip(rows, tokens, strict=True) if not held_out(i, 7, 2)]
    one, two = Counter(w for t in training for w in t[1:]), Counter(p for t in training for p in zip(t, t[1:]))
    floor = sum(one.values()) + len(one) + 1

    def meant(n):
        return float(LM.MEANT[LM.step_of(np.array([n]))[0]]) if n else 0.0

    def score(t):
        total = 0.0
        for a, b in zip(t, t[1:]):
            pair = meant(two[a, b])
            follows = max(meant(one["</s>"]), 1.0) if a == "<s>" else max(meant(one[a]), pair, 1.0)
            total += math.log10(LM.LAMBDA * min(pair / follows, 1.0) + (1 - LM.LAMBDA) * (meant(one[b]) + 1) / floor)
        return total

    want = {i: (score(t), len(t) - 1) for (i, _), t in zip(rows, tokens, strict=True)}
    off = [(r.score - want[r.doc_id][0]) / want[r.doc_id][1] for r in LM.lm_scores(docs).collect() if r.doc_id is not None]
    assert len(off) == len(want) and abs(np.median(off)) < 0.02 and np.mean(np.abs(off) < 0.1) > 0.95


def test_lm_empty_and_without_training_rows(spark, empty):
    assert LM.lm_scores(empty).count() == 0
    held = next(k for k in range(100) if held_out(k, 7, 2))
    row = LM.lm_scores(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).first()
    assert (row.train_tokens, row.n_known, row.n_tokens, row.base_score) == (0, 0, 3, 0.0)


def test_filter_holds_quantised_counts():
    rng = np.random.default_rng(3)
    keys = LM.short(np.unique(rng.integers(0, (1 << 64) - 1, 4000, np.uint64)), 16)
    counts = rng.integers(1, 3000, len(keys))
    lookup = LM.LogFrequencyFilter(LM.filled(keys, counts))
    steps, got = LM.step_of(counts), lookup.count(keys)
    assert (got >= LM.MEANT[steps] - 1e-9).all() and (got == LM.MEANT[steps]).mean() > 0.95
    others = LM.short(rng.integers(0, (1 << 64) - 1, 4000, np.uint64), 16)
    assert (lookup.count(others) == 0).mean() > 0.95
    assert (np.abs(np.log2(LM.MEANT[LM.step_of(np.arange(1, 5000))] / np.arange(1, 5000))) <= 0.6).all()


def test_packed_keys_come_back():
    rng = np.random.default_rng(4)
    for n, top in ((0, 5), (1, 1 << 47), (1000, 300), (70000, 1 << 63)):
        keys = np.sort(rng.integers(0, top, n, np.uint64))
        counts = rng.integers(1, 70000, n)
        got, m = LM.unpacked(pa.scalar(LM.packed(keys, counts), pa.binary()))
        assert (got == keys).all() and (m == counts).all()
        assert (LM.unpacked(pa.scalar(LM.packed(keys), pa.binary()))[0] == keys).all()


def test_lm_scores_without_the_training_rows(spark, small, tmp_path):
    """The written segments are the model: texts and counts of the training can go."""
    import shutil
    docs, _ = small
    want = {r.doc_id: (r.base_score, r.score) for r in LM.lm_scores(docs).collect()}
    docs.filter(~LM.held_back("doc_id", 7, 2)).write.parquet(str(tmp_path / "train"))
    model = LM.train(spark.read.parquet(str(tmp_path / "train")))
    shutil.rmtree(tmp_path / "train")
    got = {r.doc_id: (r.base_score, r.score) for r in LM.score(docs, model, LM.held_back("doc_id", 7, 2)).collect()}
    assert got.keys() == want.keys() and all(got[i] == pytest.approx(want[i], rel=1e-9) for i in want)


def test_steps_in_sql_and_numpy_agree(spark):
    n = [1, 2, 3, 4, 5, 6, 7, 8, 11, 12, 1023, 1024, 1535, 1536, (1 << 40) - 1, 1 << 40]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in n], "n long").select(LM._steps(F.col("n"))).collect()]
    assert got == (LM.step_of(np.array(n)) + 1).tolist()


def test_words_helper_counts_like_the_contract():
    assert [len(words(x)) for x in (None, "", " a b \t c ")] == [0, 0, 2]
