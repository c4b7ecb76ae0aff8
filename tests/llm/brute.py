"""Brute-force versions of the operators, on dicts of texts that fit in memory."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict


def words(text):
    return (text or "").encode().split()


def components(texts, n, percent=80):
    """Smallest id that each id reaches over links of shingle sets, compared pair by pair."""
    sets = {}
    for i, x in texts.items():
        w = (x or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    found = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            found[g].append(i)
    parent = {i: i for i in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in sets.items():
        common = Counter(j for g in s for j in found[g] if j < i)
        for j, k in common.items():
            if 100 * k >= percent * (len(s) + len(sets[j]) - k):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in texts}


def without_repeated_words(rows, window):
    """(words, removed, words left) of each text of a list."""
    split = [words(x) for x in rows]
    seen = Counter(tuple(w[k:k + window]) for w in split for k in range(len(w) - window + 1))
    out = []
    for w in split:
        gone = bytearray(len(w))
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k:k + window])] > 1:
                gone[k:k + window] = b"\1" * window
        out.append((len(w), sum(gone), b" ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


def without_repeated_bytes(rows, length):
    """(bytes, removed, runs, bytes left) of each (id, text) of a list."""
    first = {}
    for i, x in rows:
        x = (x or "").encode()
        for k in range(len(x) - length + 1):
            s = x[k:k + length]
            first[s] = min(first.get(s, (math.inf, 0)), (i, k))
    out = []
    for i, x in rows:
        x = (x or "").encode()
        gone = bytearray(len(x))
        for k in range(len(x) - length + 1):
            if first[x[k:k + length]] != (i, k):
                gone[k:k + length] = b"\1" * length
        runs = sum(1 for r in bytes(gone).split(b"\0") if r)
        out.append((len(x), sum(gone), runs, bytes(c for c, g in zip(x, gone, strict=True) if not g)))
    return out


def quality_counts(text):
    w, text = words(text), text or ""
    seen = Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
    covered = {k + j for k in range(len(w) - 2) if seen[tuple(w[k:k + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    return len(w), sum(len(x.decode()) for x in w), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def held_out(i, folds, fold):
    return zlib.crc32(("" if i is None else str(i)).encode()) % folds == fold


def unigram_base(rows, folds=7, fold=2):
    """(held_out, n_tokens, n_known, train_tokens, base_score) of each (id, text)."""
    split = [(i, [*(x or "").encode().lower().split(), None]) for i, x in rows]
    count = Counter(t for i, w in split if not held_out(i, folds, fold) for t in w)
    n, v = sum(count.values()), len(count)
    return [(held_out(i, folds, fold), len(w), sum(count[t] > 0 for t in w), n, sum(math.log10((count[t] + 1) / (n + v + 1)) for t in w)) for i, w in split]


def sha(data):
    return hashlib.sha256(data).hexdigest()
