"""Toxicity: a learnt lexicon, misspellings by Levenshtein automata, and the words around a hit.

The lexicon holds words, and word beginnings, that texts labelled toxic use far more
often than others do.  Terms form a trie; a word of a text is looked up by running the
Levenshtein automaton of strings within one edit of it along the trie, so "st0pid" finds
its term.  The words around a hit, quotation marks among them, tell abuse from quotation: their
log odds are learnt from the training texts that have hits.  A logistic regression on the hits
and their surroundings, fitted on labelled texts, gives the score.

The labelled texts are written once, each distinct one once, and learnt from there; what the
passes over them send is (hash of a term, number of texts), and strings of the admitted terms only.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulkit.llm.lattice import take_ragged
from haulkit.llm.lm_scoring import Counts
from haulkit.llm.shared import (_LETTERS, SMALL, Powers, Words, blocks, filter_array, filter_pages, has, held_back, materialise, maybe_in, mix, small_batches,
                                spans_hash, text_of, words_of)

#: Lengths of word beginnings that may become terms, besides whole words.
STEMS = (4, 5, 6, 7, 8)
#: A term is in at least so many different toxic texts of the training rows, and so many times as often in those as in others.
LEAST, TIMES = 5, 30.0
#: Whole words of so many letters are found misspelt too.
FUZZY = 5
#: Words before and after a hit that are looked at.
AROUND = 6
#: Distinct labelled texts, by hash of the text, on which the regression is fitted at most.
FIT_ROWS = 20_000
#: Words around hits are counted in so many buckets, by hash; one word's log odds count up to STRONGEST.
BUCKETS, STRONGEST = 1 << 16, 3.0
#: Quotation marks, which count as one word of the surroundings.
QUOTES = "\"“”„«»"
FEATURES = ("exact", "misspelt", "context", "most", "share")
BEGINNING = np.uint64(0x632BE59BD9B4E019)  # tells the key of a beginning from that of a word
#: ASCII signs, as bytes of words in lower case.
SIGN = np.array([b < 128 and not (97 <= b <= 122 or 48 <= b <= 57 or b == 95) for b in range(256)])
STEM = "begins"  # key of a trie node's weight as a beginning; that of a whole word is ""; letters are of length 1
_EDGE = re.compile(r"^\W+|\W+$")


def bare(word: str) -> str:
    """The word in lower case without signs at its ends."""
    return _EDGE.sub("", word.lower())


def terms_of(word: str) -> list[str]:
    """A word's candidates for the lexicon: itself, and its beginnings marked by '*'."""
    return [word, *(word[:n] + "*" for n in STEMS if len(word) > n)] if len(word) >= 3 and "*" not in word else []


def hashed(text: str) -> int:
    """64-bit hash of a string, signed as the JVM has it."""
    return int(np.uint64(xxhash.xxh64_intdigest(text.encode())).astype(np.int64))


#: Bucket of a quotation mark.
QUOTE = hashed(QUOTES[0]) & BUCKETS - 1


def place(letters, size, kind: int):
    """Bit of a table of 2**24 for up to eight bytes of a word, its number of letters, and which bytes these are."""
    letters, size = np.atleast_1d(np.asarray(letters, np.uint64)), np.atleast_1d(size).astype(np.uint64)
    return (mix(letters ^ size * np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(kind * 0xD1B54A32D192ED03 & (1 << 64) - 1)) >> np.uint64(40)).astype(np.int64)


def string_keys(terms: list[str], powers: Powers) -> np.ndarray:
    """64-bit keys of terms given as strings."""
    raw = [t.removesuffix("*").encode() for t in terms]
    ends = np.cumsum([0, *map(len, raw)])
    data = np.frombuffer(b"".join(raw), np.uint8)
    keys = spans_hash(_LETTERS[data], ends[:-1], ends[1:], powers)
    return np.where([t.endswith("*") for t in terms], mix(keys ^ BEGINNING), keys) if terms else np.zeros(0, np.uint64)


class Distinct:
    """The distinct words of a block: ``first`` place and, by place, ``which``; in lower case without signs at their ends
    as data[start:end] where ``plain`` (letters of Latin-1, eight signs of ASCII at an end at most); ``other`` words need strings."""

    def __init__(self, w: Words):
        _, self.first, self.which = np.unique(w.hashes, return_index=True, return_inverse=True)
        self.w, self.data = w, np.where((w.data >= 65) & (w.data <= 90), w.data + 32, w.data).astype(np.uint8)
        after = np.flatnonzero(w.data[:-1] == 0xC3) + 1  # second bytes of U+00C0 to U+00FF
        odd = (w.data >= 0xC0) & (w.data != 0xC3)
        odd[after] |= (w.data[after] == 0x97) | (w.data[after] == 0xB7)  # two signs among them
        capital = after[w.data[after] <= 0x9E]
        self.data[capital] += 0x20
        self.start, self.end = w.start[self.first].copy(), w.end[self.first].copy()
        strange = np.concatenate(([0], np.cumsum(odd)))
        latin = strange[self.end] == strange[self.start]
        sign = SIGN[self.data]
        for _ in range(8):
            self.start += sign[self.start] & (self.start < self.end - 1)
            self.end -= sign[self.end - 1] & (self.end > self.start + 1)
        bare_ = ~sign[self.start] & ~sign[self.end - 1]
        self.plain, self.other = latin & bare_, ~latin | ~bare_ & (self.end > self.start + 1)
        self.size = self.end - self.start
        lead = (self.data & 0xC0) != 0x80
        self.letter = np.flatnonzero(lead)  # first byte of each letter
        count = np.concatenate(([0], np.cumsum(lead)))
        self.begin, self.letters = count[self.start], count[self.end] - count[self.start]

    def word(self, k: int) -> str:
        return bare(word_at(self.w, self.first[k]))

    def terms(self, powers: Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, key, letters) of the candidates of each distinct word; letters: of a beginning, 0 for a whole word."""
        stars = np.concatenate(([0], np.cumsum(self.data == 42)))
        long = np.flatnonzero(self.plain & (self.letters >= 3) & (stars[self.end] == stars[self.start]))
        of, ends, letters = [long], [self.end[long]], [np.zeros(len(long), np.int64)]
        for n in STEMS:
            long = long[self.letters[long] > n]
            of.append(long)
            ends.append(self.letter[self.begin[long] + n])
            letters.append(np.full(len(long), n))
        of, ends, letters = map(np.concatenate, (of, ends, letters))
        keys = spans_hash(_LETTERS[self.data], self.start[of], ends, powers) if len(of) else np.zeros(0, np.uint64)
        keys = np.where(letters > 0, mix(keys ^ BEGINNING), keys)
        strings = [(k, t) for k in np.flatnonzero(self.other).tolist() for t in terms_of(self.word(k))]
        return (np.concatenate((of, np.array([k for k, _ in strings], np.int64))), np.concatenate((keys, string_keys([t for _, t in strings], powers))),
                np.concatenate((letters, np.array([len(t) - 1 if t.endswith("*") else 0 for _, t in strings], np.int64))))


class Lexicon:
    """Terms in a trie, searched with automata of Levenshtein distance 1."""

    def __init__(self, terms: dict[str, float]):
        self.root: dict = {}
        for term, weight in terms.items():
            node = self.root
            for c in term.removesuffix("*"):
                node = node.setdefault(c, {})
            node[STEM if term.endswith("*") else ""] = weight
        # with lengths of one letter more or less, the first and the second half of terms that are found misspelt: one
        # edit spares one half
        self.near = np.zeros(1 << 24, bool)
        self.fronts, self.backs = set(), set()  # lengths of such halves in bytes, eight at most
        for term in terms:
            if not term.endswith("*") and len(term) >= FUZZY:
                front, back = term[:len(term) // 2].encode()[:8], term[len(term) // 2:].encode()[-8:]
                self.fronts.add(len(front))
                self.backs.add(len(back))
                size = np.arange(len(term) - 1, len(term) + 2)
                self.near[place(int.from_bytes(front), size, len(front))] = True
                self.near[place(int.from_bytes(back), size, 8 + len(back))] = True

    def find(self, word: str, near: bool = True) -> tuple[float, int]:
        """(weight, edits) of the best term: exact words and beginnings first, then words one edit away; (0, 0) if none."""
        path, best = [self.root], 0.0  # the automaton's states without an edit: one trie node for each letter that fits
        for i, c in enumerate(word):
            node = path[-1].get(c)
            if node is None:
                break
            path.append(node)
            best = max(best, node.get(STEM, 0.0), node.get("", 0.0) if i + 1 == len(word) else 0.0)
        if best:
            return best, 0
        if not near or len(word) < FUZZY - 1:
            return 0.0, 0
        for i, node in enumerate(path):  # states with one edit have one way on: the rest of the word, letter by letter
            best = max(best, self._rest(node, word, i + 1, i))  # a letter too many
            for c, child in node.items():
                if type(child) is dict:
                    best = max(best, self._rest(child, word, i + 1, i + 1), self._rest(child, word, i, i + 1))  # another letter, one missing
        return best, 1

    @staticmethod
    def _rest(node: dict, word: str, at: int, depth: int) -> float:
        """Weight of the whole-word term at the end of word[at:] from a node at a depth, if it is long enough."""
        if at > len(word) or depth + len(word) - at < FUZZY:
            return 0.0
        for c in word[at:]:
            node = node.get(c)
            if node is None:
                return 0.0
        return node.get("", 0.0)


# ---- learning -----------------------------------------------------------------------------------------------------

def training_texts(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, filter_bits: int = 24) -> DataFrame:
    """(mark, toxic, text): each distinct text of the labelled ids (id, toxic), once for each label it has.

    Which texts count is decided on rows (id, mark), mark being a hash of the text; a key filter then picks the texts,
    copies meet before they are sent, and the join with the marks drops what passed the filter by chance.
    """
    marks = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("mark")).filter("id is not null")
    marks = materialise(marks.join(labels, "id").select("mark", F.col("toxic").cast("int").alias("toxic")).distinct(), "toxic-marks")
    pages = filter_pages(marks.select("mark").distinct(), "mark", filter_bits)
    texts = maybe_in(docs.select(text_of(text_col).alias("text")).withColumn("mark", F.xxhash64("text")), "mark", pages, filter_bits, "picked")
    texts = texts.filter("picked").groupBy("mark").agg(F.first("text").alias("text"))
    return materialise(texts.join(marks, "mark").select("mark", "toxic", "text"), "toxic-texts")


def _term_counts(texts: DataFrame, keys=None) -> DataFrame:
    """(h, n): keys of terms, and in how many texts each is; with a key filter only of terms that it has."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, counts = Powers(), Counts()
        for batch in blocks(batches, size=SMALL):
            w = words_of(batch.column(0), powers)
            if not len(w.hashes):
                continue
            words = Distinct(w)
            of, key, _ = words.terms(powers)
            if keys is not None:
                kept = has(keys.value, key.view(np.int64))
                of, key = of[kept], key[kept]
            order = np.argsort(of, kind="stable")
            bounds = np.searchsorted(of[order], np.arange(len(words.first) + 1))
            some = (np.diff(bounds) > 0)[words.which]
            pair = np.unique(w.doc[some] * len(words.first) + words.which[some])  # a word of a text, once
            found, ends = take_ragged(key[order], bounds, pair % len(words.first))
            text = np.repeat(pair // len(words.first), np.diff(ends)).astype(np.uint64)
            _, once = np.unique(mix(found + text * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
            counts.add(*np.unique(found[once], return_counts=True))
        h, n = counts.total()
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n, pa.int64())], ["h", "n"])

    return texts.select("text").mapInArrow(task, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def _spelled(texts: DataFrame, wanted: list[int]) -> DataFrame:
    """(h, term): the strings of these keys of terms."""
    shared = texts.sparkSession.sparkContext.broadcast(np.array(wanted, np.int64).view(np.uint64))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, found = Powers(), {}
        for batch in blocks(batches, size=SMALL):
            w = words_of(batch.column(0), powers)
            if not len(w.hashes):
                continue
            words = Distinct(w)
            of, key, letters = words.terms(powers)
            for i in np.flatnonzero(np.isin(key, shared.value)).tolist():
                if key[i] not in found:
                    word = words.word(of[i])
                    found[key[i]] = word[:letters[i]] + "*" if letters[i] else word
        h = np.array(list(found), np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(list(found.values()), pa.string())], ["h", "term"])

    return texts.select("text").mapInArrow(task, "h long, term string").distinct()


def lexicon_of(texts: DataFrame, filter_bits: int = 22) -> dict[str, float]:
    """Terms and weights (log odds) from training texts (mark, toxic, text); every term that passes LEAST and TIMES reaches the driver and the broadcast.

    Candidates come from toxic texts; other texts are searched for those alone.
    """
    toxic = texts.filter("toxic = 1")
    bad = materialise(_term_counts(toxic).filter(F.col("n") >= LEAST).withColumnRenamed("n", "bad"), "terms")
    keys = texts.sparkSession.sparkContext.broadcast(filter_array(bad, "h", filter_bits))
    good = _term_counts(texts.filter("toxic = 0"), keys).withColumnRenamed("n", "good")
    sizes = {0: 0, 1: 0} | {r[0]: r[1] for r in texts.groupBy("toxic").count().collect()}  # two rows
    odds = F.log((F.col("bad") + 0.5) / (sizes[1] + 1)) - F.log((F.coalesce("good", F.lit(0)) + 0.5) / (sizes[0] + 1))
    best = bad.join(good, "h", "left").withColumn("weight", odds).filter(F.col("weight") >= math.log(TIMES)).select("h", "weight", "bad").collect()
    if not best:
        return {}
    names = {r["h"]: r["term"] for r in _spelled(toxic, [r["h"] for r in best]).collect()}
    return pruned({names[r["h"]]: (r["weight"], r["bad"]) for r in best})


def learn_lexicon(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> dict[str, float]:
    """The lexicon of the labelled rows (labels: id, toxic)."""
    return lexicon_of(training_texts(docs, labels, id_col, text_col))


def pruned(found: dict[str, tuple[float, int]]) -> dict[str, float]:
    """Without beginnings that are found in hardly more texts than one longer term, and without terms that a beginning covers.

    Covered whole words that are long enough stay, for their misspellings.
    """
    stems = {t for t in found if t.endswith("*")}
    for t, (_, bad) in found.items():
        word = t.removesuffix("*")
        stems -= {word[:n] + "*" for n in STEMS if n < len(word) + (not t.endswith("*")) and bad >= 0.8 * found.get(word[:n] + "*", (0.0, 0))[1]}
    return {t: w for t, (w, _) in sorted(found.items()) if (t in stems or not t.endswith("*"))
            and (len(t) >= FUZZY and not t.endswith("*") or not any((x := t.removesuffix("*")[:n] + "*") in stems and x != t and n <= len(t.removesuffix("*")) for n in STEMS))}


class Finder:
    """Hits of a lexicon in blocks of texts, and the words around them."""

    def __init__(self, terms: dict[str, float], powers: Powers):
        self.terms, self.lexicon, self.known, self.powers = terms, Lexicon(terms), {}, powers
        self.keys = string_keys(list(terms), powers)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.keys & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        self.buckets: dict[int, tuple[int, bool]] = {}

    def __call__(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """(places of words that hit, their weights and edits as rows)."""
        if not len(w.hashes) or not self.terms:
            return np.zeros(0, np.int64), np.zeros((0, 2))
        words = Distinct(w)
        of, key, _ = words.terms(self.powers)
        some = self.maybe[(key & np.uint64((1 << 20) - 1)).astype(np.int64)]
        of, key = of[some], key[some]
        near, found = _near(words, self.lexicon), np.zeros((len(words.first), 2))
        look = near.copy()
        look[of[np.isin(key, self.keys)]] = True
        for n in np.flatnonzero(look).tolist():
            what = words.word(n), bool(near[n])
            if what not in self.known:
                if len(self.known) > 200_000:
                    self.known.clear()
                self.known[what] = self.lexicon.find(*what)
            found[n] = self.known[what]
        at = np.flatnonzero(found[words.which, 0])
        return at, found[words.which[at]]

    def surroundings(self, w: Words, at: int, text: int) -> set[int]:
        """Buckets of the words around a word of a text, and of a quotation mark there."""
        out, quote = set(), False
        first, last = max(at - AROUND, int(w.first[text])), min(at + AROUND + 1, int(w.first[text + 1]))
        for k, h in zip(range(first, last), w.hashes[first:last].tolist()):
            if h not in self.buckets:
                if len(self.buckets) > 500_000:
                    self.buckets.clear()
                word = word_at(w, k)
                what = bare(word)
                self.buckets[h] = hashed(what) & BUCKETS - 1 if what else -1, any(q in word for q in QUOTES)
            bucket, marks = self.buckets[h]
            quote |= marks
            if k != at and bucket >= 0:
                out.add(bucket)
        if quote:
            out.add(QUOTE)
        return out


def word_at(w: Words, k: int) -> str:
    return bytes(w.data[w.start[k]:w.end[k]]).decode()


def learn_context(texts: DataFrame, lexicon: dict[str, float]) -> np.ndarray:
    """Log odds of the buckets of words around hits: three rows, from the texts of even marks, of odd marks, and all.

    Each text counts once in a bucket; buckets of fewer than LEAST texts say nothing.  The driver gets four
    counts of each bucket at most.
    """
    shared = texts.sparkSession.sparkContext.broadcast(lexicon)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, counts = Powers(), np.zeros((2, 2, BUCKETS + 1), np.int64)
        find = Finder(shared.value, powers)
        for batch in blocks(batches, size=SMALL):
            w = words_of(batch.column(2), powers)
            at, _ = find(w)
            of = w.doc[at]
            for text in np.unique(of).tolist():
                seen = set().union(*(find.surroundings(w, k, text) for k in at[of == text].tolist()))
                side = counts[batch.column(0)[text].as_py() & 1, batch.column(1)[text].as_py()]
                side[[*seen, BUCKETS]] += 1
        half, toxic, bucket = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (half, toxic, bucket, counts[half, toxic, bucket])], ["half", "toxic", "bucket", "n"])

    counts = np.zeros((3, 2, BUCKETS + 1))
    rows = texts.select("mark", "toxic", "text").mapInArrow(task, "half long, toxic long, bucket long, n long")
    for half, toxic, bucket, n in rows.groupBy("half", "toxic", "bucket").agg(F.sum("n")).toLocalIterator():
        counts[half, toxic, bucket] = n
    counts[2] = counts[0] + counts[1]
    good, bad = counts[:, 0], counts[:, 1]
    odds = np.log((bad[:, :-1] + 1) / (bad[:, -1:] + 2)) - np.log((good[:, :-1] + 1) / (good[:, -1:] + 2))
    heard = (bad + good)[:, :-1] >= LEAST
    return np.where(heard & (bad[:, -1:] > 0) & (good[:, -1:] > 0), np.clip(odds, -STRONGEST, STRONGEST), 0.0)


def hits(docs: DataFrame, lexicon: dict[str, float], id_col: str, text_col: str, context: np.ndarray | None = None, half: Column | None = None) -> DataFrame:
    """(id, FEATURES) of each text: sums of weights of exact and misspelt hits, the mean log odds of the words around them, the largest weight, hits per 100 words.

    half: the row of ``context`` to use, the last (all texts) by default.
    """
    shared = docs.sparkSession.sparkContext.broadcast((lexicon, context))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, context = shared.value
        powers = Powers()
        find = Finder(terms, powers)
        for batch in blocks(batches, size=SMALL):
            w = words_of(batch.column(1), powers)
            values, halves = np.zeros((batch.num_rows, 5)), batch.column(2).to_numpy()
            at, found = find(w)
            of = w.doc[at]
            for k, text, (weight, edits) in zip(at.tolist(), of.tolist(), found.tolist()):
                row = values[text]
                row[int(edits)] += weight
                row[3] = max(row[3], weight)
                row[4] += 1
                if context is not None:
                    row[2] += context[halves[text], list(find.surroundings(w, k, text))].sum()
            values[:, 2] /= np.maximum(values[:, 4], 1)
            values[:, 4] *= 100 / np.maximum(np.diff(w.first), 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(values[:, k]) for k in range(5))], ["id", *FEATURES])

    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"), (F.lit(2) if half is None else half).cast("int").alias("half"))
    return rows.mapInArrow(task, f"id {rows.schema['id'].dataType.simpleString()}, " + ", ".join(f"{f} double" for f in FEATURES))


def _near(words: Distinct, lexicon: Lexicon) -> np.ndarray:
    """Which distinct words may have a term within one edit, by the bytes at their ends.

    One edit leaves the first or the second half of a term as it was.  Words that are not plain are looked up.
    """
    start, end = words.start, words.end
    front, back, near = np.zeros(len(start), np.uint64), np.zeros(len(start), np.uint64), np.zeros(len(start), bool)
    for n in range(1, 9):
        front = front << np.uint64(8) | words.data[np.minimum(start + n - 1, end - 1)].astype(np.uint64)
        back |= words.data[np.maximum(end - n, start)].astype(np.uint64) << np.uint64(8 * n - 8)
        if n in lexicon.fronts:
            near |= (words.size >= n) & lexicon.near[place(front, words.letters, n)]
        if n in lexicon.backs:
            near |= (words.size >= n) & lexicon.near[place(back, words.letters, 8 + n)]
    return near & (words.size >= 3) | words.other


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Weights (the last: intercept) of a ridge-penalised logistic regression, by Newton steps."""
    x = np.hstack((x, np.ones((len(x), 1))))
    w = np.zeros(x.shape[1])
    penalty = ridge * np.diag([1.0] * (x.shape[1] - 1) + [1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p) + 1e-9)[:, None]) + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def squeezed(name: str) -> Column:
    """A feature as the regression has it: sums on a log scale, log odds as they are."""
    return F.col(name) if name == "context" else F.log1p(F.col(name))


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id_col, held_out, score (0 to 1), predicted (score >= 0.5), and the counts of FEATURES.

    Learns only from labelled rows whose crc32(id as text) modulo ``folds`` is not
    ``fold``.  Lexicon and context count all distinct texts of those; the regression uses at most FIT_ROWS of
    them, smallest hashes first, each with the context that the other half of the texts gives.  Labels
    without id or toxic are left out, an id labelled twice counts as toxic if any label says so.  Without
    labels of both kinds the score is that of a text without hits: 0.01.  A null or empty text has none.
    """
    small_batches(docs.sparkSession)
    used = (labels.filter(f"{id_col} is not null and toxic is not null").filter(~held_back(id_col, folds, fold))
            .groupBy(F.col(id_col).alias("id")).agg(F.max("toxic").alias("toxic")))
    texts = training_texts(docs, materialise(used, "labels"), id_col, text_col)
    lexicon = lexicon_of(texts)
    context = learn_context(texts, lexicon)
    # the largest mark of the sample, from marks alone
    last = texts.select("mark").orderBy("mark").limit(FIT_ROWS).agg(F.max("mark")).first()[0]
    rows = texts.filter(F.lit(False) if last is None else F.col("mark") <= last).withColumn("key", F.struct("mark", "toxic"))
    sample = (hits(rows, lexicon, "key", "text", context, F.when(F.col("mark") % 2 == 0, 1).otherwise(0))
              .select(*(squeezed(f).alias(f) for f in FEATURES), F.col("id.toxic").alias("toxic")).toPandas())
    if sample["toxic"].nunique() == 2:
        *weights, intercept = fit(sample[list(FEATURES)].to_numpy(float), sample["toxic"].to_numpy(float)).tolist()
    else:
        weights, intercept = [0.0] * len(FEATURES), math.log(0.01 / 0.99)
    linear = F.lit(intercept)
    for f, w in zip(FEATURES, weights, strict=True):
        linear = linear + squeezed(f) * w
    score = 1 / (1 + F.exp(-linear))
    return hits(docs, lexicon, id_col, text_col, context).select(
        F.col("id").alias(id_col), held_back("id", folds, fold).alias("held_out"), score.alias("score"),
        (score >= 0.5).cast("int").alias("predicted"), *FEATURES)


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    """Every row of ``documents`` scored, learnt from ``labels.toxic``."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return toxicity(docs.select("doc_id", "text"), labels.select("doc_id", "toxic")).select("doc_id", "held_out", "score", "predicted")
