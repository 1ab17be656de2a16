"""Split texts into the pieces that a byte-level BPE merges apart from each other.

The pieces are those of the published pattern: contractions, runs of letters, of numbers and of other
characters, each with one blank before it, and white space. All documents of a block are split at
once with array operations; a regular expression would take a microsecond for each piece.
"""

from __future__ import annotations

import re
import unicodedata
from functools import cache

import numpy as np

from .textblocks import firm_hashes, ragged, span_hashes

BLANK, QUOTE = 0x20, 0x27
SPACE_CLASS, LETTER, NUMBER, OTHER = 0, 1, 2, 3

# An odd multiplier that spreads code points over 64 bits.
SPREAD = np.uint64(0xD6E8FEB86659FD93)

# Code points with the Unicode property White_Space.
WHITE_SPACE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# What may follow an apostrophe in a contraction.
SHORT_ENDINGS = "stmd"
LONG_ENDINGS = ["re", "ve", "ll"]


@cache
def classes() -> np.ndarray:
    """The class of every code point."""
    out = np.full(0x110000, OTHER, np.uint8)
    kinds = {"L": LETTER, "N": NUMBER}
    for point in range(0x110000):
        kind = kinds.get(unicodedata.category(chr(point))[0])
        if kind:
            out[point] = kind
    out[WHITE_SPACE] = SPACE_CLASS
    return out


def piece_starts(points: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Positions at which a piece starts; ``rows`` holds the first position of each row."""
    size = len(points)
    if not size:
        return np.zeros(0, np.int64)
    kind = classes()[points]
    edge = np.zeros(size + 1, bool)
    edge[rows] = True
    edge[[0, size]] = True
    mark = edge[:size].copy()
    mark[1:] |= kind[1:] != kind[:-1]
    starts = np.flatnonzero(mark)
    ends = np.append(starts[1:], size)
    run_kind = kind[starts]
    # White space before something else gives up its last character; a blank then joins what follows.
    gives = (run_kind == SPACE_CLASS) & ~edge[ends]
    last = ends[gives] - 1
    mark[last] = True
    joined = last[points[last] == BLANK] + 1
    mark[joined] = False
    # An apostrophe that starts a piece takes a short ending from the letters behind it.
    quote = np.flatnonzero((points == QUOTE) & mark)
    if len(quote):
        padded = np.concatenate([points, np.zeros(2, points.dtype)])
        one, two = padded[quote + 1], padded[quote + 2]
        in_row = ~edge[quote + 1]
        take = np.where(in_row & np.isin(one, [ord(c) for c in SHORT_ENDINGS]), 1, 0)
        follows = in_row & ~edge[np.minimum(quote + 2, size)]
        for ending in LONG_ENDINGS:
            take[follows & (one == ord(ending[0])) & (two == ord(ending[1]))] = 2
        quote, take = quote[take > 0], take[take > 0]
        mark[quote + 1] = False
        after = quote + 1 + take
        after = after[after < size]
        mark[after] = True
    return np.flatnonzero(mark)


class PieceTable:
    """Encodings of the pieces seen so far, as sorted arrays; the oldest are dropped all at once.

    ``encode`` turns a list of distinct pieces into lists of ids. ``most`` bounds the memory of a
    worker; a dropped piece is merely encoded again. Strings of ``whole`` are pieces of their own
    wherever a row holds them, the longest first; what stands between them is split as a text of its own.
    """

    def __init__(self, encode, most: int = 400_000, whole: tuple[str, ...] = ()):
        self.encode, self.most, self.whole = encode, most, whole
        self.pattern = re.compile("|".join(map(re.escape, sorted(whole, key=len, reverse=True))))
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.first, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def add(self, keys: np.ndarray, pieces: list[str]) -> None:
        lists = self.encode(pieces)
        count = np.fromiter(map(len, lists), np.int64, len(lists))
        ids = np.fromiter((i for one in lists for i in one), np.uint32, int(count.sum()))
        first = len(self.ids) + np.cumsum(count) - count
        merged = np.concatenate([self.keys, keys])
        order = np.argsort(merged, kind="stable")
        self.keys = merged[order]
        self.first = np.concatenate([self.first, first])[order]
        self.count = np.concatenate([self.count, count])[order]
        self.ids = np.concatenate([self.ids, ids])

    def starts(self, text: str, points: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Positions at which a piece starts, cut at the whole strings that stand within a row."""
        if not any(w in text for w in self.whole):
            return piece_starts(points, rows)
        bounds = rows.tolist()
        spans = [m.span() for a, b in zip(bounds, bounds[1:]) for m in self.pattern.finditer(text, a, b)]
        first, end = np.array(spans, np.int64).reshape(-1, 2).T
        starts = piece_starts(points, np.concatenate([rows, first, end]))
        # Of the positions in a whole string only the first one stays.
        last = np.searchsorted(first, starts) - 1
        return starts[(last < 0) | (starts >= np.append(end, 0)[last])]

    def encoded(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, index of each row's first id) of UTF-8 rows."""
        text = data.tobytes().decode()
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        # Bytes of the form 10xxxxxx continue a character: what is left counts the characters.
        heads = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=heads[1:])
        rows = heads[offsets]
        starts = self.starts(text, points, rows)
        ends = np.append(starts[1:], len(points))
        values = points * SPREAD
        values ^= values >> np.uint64(29)
        hashes = firm_hashes(points, starts, ends, span_hashes(values, starts, ends))
        keys, where, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) > self.most:
            self.clear()
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        known[at < len(self.keys)] = self.keys[at[at < len(self.keys)]] == keys[at < len(self.keys)]
        if not known.all():
            new = where[~known]
            self.add(keys[~known], [text[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist())])
            at = np.searchsorted(self.keys, keys)
        at = at[inverse] if len(keys) else at
        count = self.count[at]
        ids = self.ids[ragged(self.first[at], count)]
        bounds = np.concatenate([[0], np.cumsum(count)])
        return ids, bounds[np.searchsorted(starts, rows)]
