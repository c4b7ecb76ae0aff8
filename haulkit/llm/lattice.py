"""The lattice of pieces of a SentencePiece vocabulary over pre-tokens, and Viterbi over a trie of them.

A text is written as SentencePiece does: a space in front (if it isn't empty), spaces
as U+2581.  A U+2581 of the text itself, and every character without a piece,
becomes its UTF-8 bytes, so decoding always gives the text back.  No piece has a
U+2581 after another character, so cutting there (and around characters that stand
in no longer piece) never cuts a piece: a text's best segmentation is that of its
pre-tokens.  Scores are those of the vocabulary file; a character written as
bytes scores 10 less than the rarest one-character piece.  Equal scores: the longer
last piece wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

from haulkit.llm.shared import Powers, mix, spans_hash

SPACE, OWN_MARK = 0x2581, 0x110000
#: Pieces of this score are in the file for other reasons than frequency.
UNUSED = -1e9
#: Stands for the text's own U+2581 in strings; no text holds it.
MARK = "\ud800"
_CODE = 21  # bits of a character, OWN_MARK included


class Vocabulary(NamedTuple):
    """Pieces in a trie of their characters from the last to the first, as arrays."""

    pieces: dict[str, tuple[int, float]]  # only of normal pieces
    letters: np.ndarray  # number of each character in the trie, 0: in no piece
    joins: np.ndarray  # whether a character stands in a piece of two or more
    edges: np.ndarray  # sorted: state << 16 | letter
    to: np.ndarray
    piece: np.ndarray  # of each state, -1: none
    score: np.ndarray
    longest: int
    fallback: float
    first_byte: int
    spelled: np.ndarray  # bytes of all pieces, U+2581 as a space
    bounds: np.ndarray


def load(path: str) -> Vocabulary:
    """Read a SentencePiece model (on the driver; a few MB, as large as the vocabulary)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    special = [model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in ids]
    pieces = {model.id_to_piece(i): (i, model.get_score(i)) for i in ids if not special[i]}
    if any(chr(SPACE) in p.lstrip(chr(SPACE)) for p in pieces):
        raise ValueError("pieces with a space after another character can't be cut into pre-tokens")
    first_byte = next((i for i in ids if model.is_byte(i)), -1)
    if first_byte < 0 or [model.id_to_piece(first_byte + b) for b in range(256)] != [f"<0x{b:02X}>" for b in range(256)]:
        raise ValueError("the vocabulary needs the 256 pieces of bytes in order")
    spelled = [bytes([i - first_byte]) if first_byte <= i < first_byte + 256 else b"" if special[i]
               else model.id_to_piece(i).replace(chr(SPACE), " ").encode() for i in ids]
    letters, joins = np.zeros(OWN_MARK + 1, np.int32), np.zeros(OWN_MARK + 1, bool)
    for n, c in enumerate(sorted({ord(c) for p in pieces for c in p}), 1):
        letters[c] = n
    joins[[ord(c) for p in pieces if len(p) > 1 for c in p]] = True
    joins[SPACE] = True
    states, piece, score = {}, [-1], [0.0]
    for p, (i, s) in pieces.items():
        state = 0
        for c in reversed(p):
            key = state << 16 | int(letters[ord(c)])
            if key not in states:
                states[key] = len(piece)
                piece.append(-1)
                score.append(0.0)
            state = states[key]
        piece[state], score[state] = i, s
    edges = np.array(sorted(states), np.int64)
    return Vocabulary(pieces, letters, joins, edges, np.array([states[int(k)] for k in edges]), np.array(piece), np.array(score),
                      max(map(len, pieces)), min(s for p, (_, s) in pieces.items() if len(p) == 1 and s > UNUSED) - 10.0, first_byte,
                      np.frombuffer(b"".join(spelled), np.uint8), np.cumsum([0, *map(len, spelled)]))


def pieces(batch: pa.RecordBatch, column: int, size: int) -> Iterator[list[str]]:
    """The texts of a block with a space in front, together; one long text in pieces one after the other."""
    strings = [" " + t if t else "" for t in batch.column(column).to_pylist()]
    if len(strings) != 1 or len(strings[0]) <= 2 * size:
        yield strings
    else:
        yield from ([piece] for piece in cut_text(strings[0], size))


class Pretokens(NamedTuple):
    """Pre-tokens of a block of texts: characters, bounds of pre-tokens in them, bounds of texts in pre-tokens,
    the distinct ones (by one place of each) and which of them each pre-token is."""

    codes: np.ndarray
    start: np.ndarray
    end: np.ndarray
    texts: np.ndarray
    distinct: np.ndarray
    which: np.ndarray

    def string(self, n: int) -> str:
        """A distinct pre-token, with MARK for the text's own U+2581."""
        codes = self.codes[self.start[self.distinct[n]]:self.end[self.distinct[n]]]
        return "".join(map(chr, np.where(codes == OWN_MARK, ord(MARK), codes).tolist()))


def cut_text(text: str, size: int) -> Iterator[str]:
    """Pieces of about ``size`` characters, each after the first from a bound of pre-tokens on: a space after another character."""
    at = 0
    while len(text) - at > size:
        to = text.find(" ", at + size)
        while to > 0 and text[to - 1] == " ":
            to = text.find(" ", to + 1)
        if to < 0:
            break
        yield text[at:to]
        at = to
    yield text[at:]


def pretokens(strings: list[str], vocabulary: Vocabulary, powers: Powers) -> Pretokens:
    """Pre-tokens of texts that have their space in front already, or of later pieces of texts."""
    codes = np.frombuffer("".join(strings).encode("utf-32-le"), np.int32)
    bounds = np.cumsum([0, *map(len, strings)])
    codes = np.where(codes == SPACE, OWN_MARK, np.where(codes == 32, SPACE, codes))
    if not len(codes):
        none = np.zeros(0, np.int64)
        return Pretokens(codes, none, none, np.zeros(len(strings) + 1, np.int64), none, none)
    alone = ~vocabulary.joins[codes]
    cut = np.ones(len(codes), bool)
    cut[1:] = (codes[1:] == SPACE) & (codes[:-1] != SPACE) | alone[1:] | alone[:-1]
    cut[bounds[:-1][np.diff(bounds) > 0]] = True
    start = np.flatnonzero(cut)
    end = np.append(start[1:], len(codes))
    hashes = spans_hash(mix(codes.astype(np.uint64) + np.uint64(1)), start, end, powers)
    _, distinct, which = np.unique(hashes, return_index=True, return_inverse=True)
    return Pretokens(codes, start, end, np.searchsorted(start, bounds), distinct, which)


def utf8_size(codes: np.ndarray) -> np.ndarray:
    return np.where(codes == OWN_MARK, 3, 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000))


def character_bytes(c: str) -> bytes:
    return chr(SPACE).encode() if c == MARK else c.encode()


class Trie(NamedTuple):
    """Distinct pre-tokens in a trie with the forward scores of its nodes; node 0 is the root.

    best, second: scores of the two best segmentations of the path to the node; back: the
    node before the last piece of the best; piece: that piece (-1: the last character's
    bytes); tokens: pieces of the best; code: the last character; leaf: the node of each pre-token.
    """

    best: np.ndarray
    second: np.ndarray
    back: np.ndarray
    piece: np.ndarray
    tokens: np.ndarray
    code: np.ndarray
    leaf: np.ndarray
    parent: np.ndarray


def forward(p: Pretokens, v: Vocabulary) -> Trie:
    """Insert the distinct pre-tokens in a trie, level by level, and run Viterbi once per node."""
    first, size = p.start[p.distinct], (p.end - p.start)[p.distinct]
    node = np.zeros(len(first), np.int64)
    room = 1 + int(size.sum())
    best, second, tokens = np.full(room, -np.inf), np.full(room, -np.inf), np.zeros(room, np.int64)
    back, piece, code, parent = np.zeros(room, np.int64), np.full(room, -1), np.zeros(room, np.int64), np.zeros(room, np.int64)
    best[0], used, active, depth = 0.0, 1, np.arange(len(first)), 0
    while len(active := active[size[active] > depth]):
        keys, which = np.unique(node[active] << _CODE | p.codes[first[active] + depth], return_inverse=True)
        new = np.arange(used, used + len(keys))
        parent[new], code[new] = keys >> _CODE, keys & (1 << _CODE) - 1
        node[active] = new[which]
        used += len(keys)
        depth += 1
        _extend(new, best, second, back, piece, tokens, code, parent, v)
    cut = slice(0, used)
    return Trie(best[cut], second[cut], back[cut], piece[cut], tokens[cut], code[cut], node, parent[cut])


def _extend(new, best, second, back, piece, tokens, code, parent, v: Vocabulary) -> None:
    at, before, state = new, parent[new], np.zeros(len(new), np.int64)
    letter = v.letters[code[new]]
    for length in range(1, v.longest + 1):
        key = state << 16 | letter
        edge = np.minimum(np.searchsorted(v.edges, key), len(v.edges) - 1)
        found = v.edges[edge] == key
        if length == 1:  # a character without a piece of its own
            lone = np.ones(len(at), bool)
            lone[found] = v.piece[v.to[edge[found]]] < 0
            x = at[lone]
            best[x], second[x] = best[before[lone]] + v.fallback, second[before[lone]] + v.fallback
            back[x], tokens[x] = before[lone], tokens[before[lone]] + utf8_size(code[x])
        at, before, state = at[found], before[found], v.to[edge[found]]
        ends = v.piece[state] >= 0
        x, y, s = at[ends], before[ends], v.score[state[ends]]
        one, two = best[y] + s, second[y] + s
        second[x] = np.maximum(np.minimum(best[x], one), np.maximum(second[x], two))
        wins = one >= best[x]
        x, y = x[wins], y[wins]
        best[x], back[x], piece[x], tokens[x] = one[wins], y, v.piece[state[ends][wins]], tokens[y] + 1
        more = before > 0
        at, before, state = at[more], before[more], state[more]
        if not len(at):
            return
        letter, before = v.letters[code[before]], parent[before]


def spell(t: Trie, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(ids, bounds): the best segmentation of each distinct pre-token."""
    bounds = np.concatenate(([0], np.cumsum(t.tokens[t.leaf])))
    ids, at, place = np.empty(bounds[-1], np.int32), t.leaf, bounds[1:].copy()
    which = np.flatnonzero(at > 0)
    at, place = at[which], place[which]
    while len(at):
        whole = t.piece[at] >= 0
        ids[place[whole] - 1] = t.piece[at[whole]]
        step = np.ones(len(at), np.int64)
        if not whole.all():
            x = np.flatnonzero(~whole)
            codes = t.code[at[x]]
            size = utf8_size(codes)
            codes = np.where(codes == OWN_MARK, SPACE, codes)
            for k in range(4):  # bytes from the last to the first
                y = size > k
                lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])[size[y]]
                byte = np.where(size[y] == k + 1, codes[y] >> 6 * k | lead, codes[y] >> 6 * k & 0x3F | 0x80)
                ids[place[x[y]] - 1 - k] = v.first_byte + byte
            step[x] = size
        at, place = t.back[at], place - step
        more = at > 0
        at, place = at[more], place[more]
    return ids, bounds


def take_ragged(values: np.ndarray, bounds: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenation of values[bounds[w]:bounds[w + 1]] for w in which, and its bounds."""
    size = np.diff(bounds)[which]
    to = np.concatenate(([0], np.cumsum(size)))
    return values[np.arange(to[-1]) + np.repeat(bounds[which] - to[:-1], size)], to
