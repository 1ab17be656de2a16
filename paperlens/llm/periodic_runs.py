"""Periodic runs of words: stretches that repeat one sequence of words at least ``FOLD`` times.

A run has its smallest period q, at least ``FOLD`` q words and at least ``LEAST`` words, and neither
neighbour continues it. Runs are found by a suffix automaton of the words: the strings that end at a word
lie on the path from its state to the root of the link tree. Access at word i recolours that path with i.
A stretch of the path that had colour e holds strings whose last earlier occurrence ended at e; if its
longest has L words and d = i - e is not more than L, the two overlap and the L + d words up to i have
period d. L is longest, so the stretch cannot be extended to the left; that it ends at i is read off the
next word. Since L + d >= 4 d, d is the smallest period: a smaller one would give a later colour.

The link tree of the whole sequence is known before the first access, so the accessed paths are kept as
stacks of coloured stretches on its heavy paths (no tree has to be cut or joined again); an access pops
what it recolours, O(log n) amortised.

Only words that can lie in a run enter an automaton: each four words in a row inside a run come again
inside it, so words covered by no repeated four are left out and the sequence falls into pieces, in which
the same is asked again until nothing falls away. No run is lost or cut by this.

One document at a time, no shuffle; memory follows the longest document. A null or empty text has no
words and no runs; repeated rows keep a row each; other columns play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

FOLD, LEAST, GRAM = 4, 6, 4
# Times that a piece is asked anew; what is left then goes into an automaton all the same.
ROUNDS = 8

SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def numbered(words: list[bytes]) -> np.ndarray:
    """A number for each word, that of its first place: equal words have equal numbers, others do not."""
    first: dict[bytes, int] = {}
    return np.fromiter((first.setdefault(w, k) for k, w in enumerate(words)), np.int64, len(words))


def pairs(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A number for each pair of numbers."""
    size = int(right.max(initial=0)) + 1
    return np.unique(left * size + right, return_inverse=True)[1]


def pieces(ids: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of the stretches that can hold runs."""
    n = len(ids)
    if n < LEAST:
        return []
    two = pairs(ids[:-1], ids[1:])
    four = pairs(two[:-2], two[2:])
    piece = np.zeros(n, np.int64)
    for _ in range(ROUNDS):
        # A group of four counts where it lies in one piece and comes there at least twice.
        inside = np.flatnonzero((piece[: n - GRAM + 1] >= 0) & (piece[: n - GRAM + 1] == piece[GRAM - 1:]))
        _, group, count = np.unique(piece[inside] * (n + 1) + four[inside], return_inverse=True, return_counts=True)
        starts = inside[count[group] > 1]
        cover = np.zeros(n + 1, np.int64)
        np.add.at(cover, starts, 1)
        np.add.at(cover, starts + GRAM, -1)
        covered = np.cumsum(cover[:n]) > 0
        # Pieces of before are not joined again.
        edge = np.ones(n, bool)
        edge[1:] = (covered[1:] != covered[:-1]) | (piece[1:] != piece[:-1])
        if np.array_equal(covered, piece >= 0):
            break
        piece = np.where(covered, np.cumsum(edge), -1)
    first = np.flatnonzero(edge & covered)
    last = np.flatnonzero(covered & np.append(edge[1:], True)) + 1
    return [(a, b) for a, b in zip(first.tolist(), last.tolist()) if b - a >= LEAST]


def automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """(suffix link, longest length, state of each prefix) of the suffix automaton."""
    nexts: list[dict[int, int]] = [{}]
    link, length, ends = [-1], [0], []
    last = 0
    for i, word in enumerate(words):
        state = len(length)
        length.append(i + 1)
        nexts.append({})
        p = last
        while p != -1 and word not in nexts[p]:
            nexts[p][word] = state
            p = link[p]
        if p == -1:
            link.append(0)
        else:
            q = nexts[p][word]
            if length[p] + 1 == length[q]:
                link.append(q)
            else:
                copy = state + 1
                link.append(copy)
                length.append(length[p] + 1)
                nexts.append(nexts[q].copy())
                link.append(link[q])
                link[q] = copy
                while p != -1 and nexts[p].get(word) == q:
                    nexts[p][word] = copy
                    p = link[p]
        last = state
        ends.append(state)
    return link, length, ends


def heavy_paths(link: list[int], length: list[int]) -> list[int]:
    """The top state of the heavy path that each state lies on."""
    n = len(link)
    order = np.argsort(np.array(length), kind="stable").tolist()
    size, heavy = [1] * n, [-1] * n
    for state in reversed(order[1:]):
        size[link[state]] += size[state]
    for state in order[1:]:
        up = link[state]
        if heavy[up] < 0 or size[state] > size[heavy[up]]:
            heavy[up] = state
    top = list(range(n))
    for state in order[1:]:
        if heavy[link[state]] == state:
            top[state] = top[link[state]]
    return top


def runs_of(words: list[int]) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, in order of their ends."""
    n = len(words)
    link, length, ends = automaton(words)
    top = heavy_paths(link, length)
    # Stretches of a heavy path, the one at its top last: [longest length, colour]; -1 is no colour.
    stacks: dict[int, list[tuple[int, int]]] = {}
    runs = []
    for i in range(n):
        state, seen = ends[i], {}
        while state > 0:
            head, deep = top[state], length[state]
            stack = stacks.get(head)
            if stack is None:
                stacks[head] = [(deep, i)]
            else:
                longest = 0
                while stack and stack[-1][0] <= deep:
                    longest, colour = stack.pop()
                    if longest >= (FOLD - 1) * (i - colour):
                        seen[colour] = max(longest, seen.get(colour, 0))
                if stack and longest < deep:
                    colour = stack[-1][1]
                    if deep >= (FOLD - 1) * (i - colour):
                        seen[colour] = max(deep, seen.get(colour, 0))
                stack.append((deep, i))
            state = link[head]
        for colour, longest in seen.items():
            period = i - colour
            whole = longest + period
            if whole >= LEAST and (i + 1 == n or words[i + 1] != words[i + 1 - period]):
                runs.append((colour - longest + 1, whole, period))
    return runs


def document_runs(words: list[bytes]) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a document, by start, then period."""
    ids = numbered(words)
    found = []
    for a, b in pieces(ids):
        found += [(a + start, length, period) for start, length, period in runs_of(ids[a:b].tolist())]
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run holds behind its first period, joined by one blank."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    kept = np.cumsum(change[:-1]) == 0
    return b" ".join([w for w, keep in zip(words, kept.tolist()) if keep])


def with_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every whole text."""

    def found(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            sizes, runs, left = [], [], []
            for text in texts:
                # Of bytes, the six blanks of the word pattern are exactly what ``split`` cuts at.
                words = (text.as_py() or "").encode().split()
                mine = document_runs(words)
                sizes.append(len(words))
                runs.append([{"start": s, "length": n, "period": p} for s, n, p in mine])
                left.append(collapsed(words, mine).decode())
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(sizes, pa.int64()), pa.array(runs, RUNS), pa.array(left, pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"])

    return docs.select("doc_id", "text").mapInArrow(found, SCHEMA)
