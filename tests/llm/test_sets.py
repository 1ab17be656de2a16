"""Similar documents, repeated passages, components: against brute force."""

import hashlib
import random
from itertools import combinations

import numpy as np
import pytest

from paperlens.llm import components, ngram_join, phrase_automata
from paperlens.session import materialize


def word_list(text, fold):
    raw = (text or "").encode()
    return (raw.lower() if fold else raw).split()


def shingle_set(text, n):
    words = word_list(text, True)
    return frozenset(tuple(words[k: k + n]) for k in range(len(words) - n + 1)) if len(words) >= n else frozenset([tuple(words)] if words else [])


def linked(rows, n, percent):
    """Smallest id reachable from each position of (id, text) rows; null ids are never the smallest."""
    sets, root = [shingle_set(t, n) for _, t in rows], list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and sets[b]:
            shared = len(sets[a] & sets[b])
            if 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                root[top(b)] = top(a)
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if top(j) == top(k) and rows[j][0] is not None]
        out.append((i, len(sets[k]), min(ids) if ids else None))
    return out


def chains(rng):
    """Families whose members differ from a base by many edits, so that some are linked through others only."""
    rows, key = [], 1000
    passage = [f"p{k}" for k in range(30)]
    for size, words in ((60, 70), (12, 40), (5, 200)):
        base = [f"w{rng.randint(0, 400)}" for _ in range(words)]
        for _ in range(size):
            text = list(base)
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(words)] = f"e{rng.randint(0, 60)}"
            if rng.random() < 0.2:
                text = passage + text
            rows.append((key, " ".join(text)))
            key += 1
    rows += [(key + k, " ".join(passage + [f"x{k}{j}" for j in range(20)])) for k in range(15)]
    return rows


def by_text(found):
    return sorted(found, key=repr)


def test_similar_documents(spark, odd_rows, odd):
    rows = [(r[0], r[1]) for r in odd_rows] + chains(random.Random(1))
    docs = odd.select("doc_id", "text", "node", "rank").unionByName(
        spark.createDataFrame(chains(random.Random(1)), "doc_id long, text string"), allowMissingColumns=True)
    found = [tuple(r) for r in ngram_join.similar_documents(docs).collect()]
    expected = linked(rows, 4, 85)
    assert by_text(found) == by_text(expected)


def test_cells_of_a_family_meet(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "CELL", 8)
    rows = chains(random.Random(9))
    found = ngram_join.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert by_text(map(tuple, found)) == by_text(linked(rows, 4, 85))


def one_family(rng, size):
    """Near copies of one text, from equal to less than half alike."""
    base = [f"w{k}" for k in range(150)]
    rows = []
    for key in range(size):
        text = list(base)
        for _ in range(rng.choice((0, 1, 1, 2, 3, 5, 8))):
            text[rng.randrange(150)] = f"e{rng.randint(0, 20)}"
        rows.append((key, " ".join(text)))
    return rows


def test_a_family_of_thousands(spark):
    rows = one_family(random.Random(11), 5000)
    sets = [sorted(shingle_set(t, 4)) for _, t in rows]
    numbers = {g: k for k, g in enumerate(sorted({g for s in sets for g in s}))}
    shared = np.zeros((len(rows), len(rows)), np.float32)
    owner = np.repeat(np.arange(len(rows)), [len(s) for s in sets])
    place = np.array([numbers[g] for s in sets for g in s])
    for first in range(0, len(numbers), 2048):
        own = (place >= first) & (place < first + 2048)
        grid = np.zeros((len(rows), 2048), np.float32)
        grid[owner[own], place[own] - first] = 1
        shared += grid @ grid.T
    sizes = np.array([len(s) for s in sets], np.float32)
    link = 100 * shared >= 85 * (sizes[:, None] + sizes[None, :] - shared)
    root = np.full(len(rows), -1)
    for k in range(len(rows)):
        new = np.array([k]) if root[k] < 0 else []
        while len(new):
            root[new] = k
            new = np.flatnonzero(link[new].any(0) & (root < 0))
    assert 1 < len(set(root.tolist())) < len(rows)
    found = ngram_join.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, found)) == [(k, len(sets[k]), int(root[k])) for k in range(len(rows))]


def test_members_linked_to_the_pivot_meet_in_no_cell(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "CELL", 4)
    kind = "pivot long, node long, n long, linked boolean, ring int"
    linked = [(1, k, 10, True, 0) for k in range(2, 40)]
    assert ngram_join.open_cells(spark.createDataFrame(linked, kind)).count() == 0
    near, far = [(1, k, 10, False, 1) for k in range(40, 50)], [(1, k, 10, False, 3) for k in range(50, 60)]
    cells = {}
    for r in ngram_join.open_cells(spark.createDataFrame(linked + near + far, kind)).collect():
        cells.setdefault((tuple(r.x), tuple(r.y)), set()).add(r.node)
    met = {frozenset(p) for c in cells.values() for p in combinations(c, 2)}
    assert all(any(n >= 40 for n in c) for c in cells.values())
    assert all(frozenset((a, b)) in met for a in range(40, 50) for b in range(2, 50) if a != b)
    assert all(frozenset((a, b)) in met for a, b in combinations(range(50, 60), 2))
    assert not any(frozenset((a, b)) in met for a in range(50, 60) for b in range(2, 50))


def test_one_of_each_group_stays(spark, odd, odd_rows, none):
    kept = ngram_join.first_of_each(odd, n=5, percent=80)
    assert kept.columns == odd.columns
    expected = {i for i, n, c in linked([(r[0], r[1]) for r in odd_rows], 5, 80) if i is not None and (n == 0 or i == c)}
    rows = kept.collect()
    assert {r.doc_id for r in rows} == expected
    wordless = [r for r in odd_rows if not word_list(r[1], True)]
    assert len(rows) == len({i for i in expected}) - len({r[0] for r in wordless}) + len(wordless)
    assert ngram_join.first_of_each(none).count() == 0


def test_no_documents(none):
    assert ngram_join.similar_documents(none).count() == 0


def test_sketch_never_exceeds_the_distance():
    rng = np.random.default_rng(4)
    for _ in range(200):
        a, b = (np.unique(rng.integers(0, 3000, rng.integers(1, 900)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for _ in "ab")
        distance = len(np.setxor1d(a, b))
        assert ngram_join.sketch_distance(ngram_join.parity_sketch(a).tobytes(), ngram_join.parity_sketch(b).tobytes()) <= distance


def test_components(spark):
    rng = random.Random(2)
    links = [(k, k + 1) for k in range(60)] + [(100, 200), (200, 100), (7, 7), (300, 100)]
    links += [(rng.randint(1000, 1400), rng.randint(1000, 1400)) for _ in range(250)] + [(None, 5)]
    found = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {x: x for link in links if None not in link for x in link if link[0] != link[1]}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and a != b and top(a) != top(b):
            x, y = sorted((top(a), top(b)))
            root[y] = x
    assert found == {x: top(x) for x in root}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def kept_words(rows):
    """(id, words, removed, digest) of (id, text) rows in the given order."""
    seen, out = set(), []
    for i, text in rows:
        words = word_list(text, False)
        covered = [False] * len(words)
        for s in range(len(words) - phrase_automata.WINDOW + 1):
            window = tuple(words[s: s + phrase_automata.WINDOW])
            if window in seen:
                covered[s: s + phrase_automata.WINDOW] = [True] * phrase_automata.WINDOW
            seen.add(window)
        kept = b" ".join(w for w, c in zip(words, covered) if not c)
        out.append((i, len(words), sum(covered), hashlib.sha256(kept).hexdigest()))
    return out


def passages(rng):
    vocabulary = [f"w{k}" for k in range(300)]
    shared = [[rng.choice(vocabulary) for _ in range(n)] for n in (19, 20, 21, 55, 120)]
    rows = []
    for k in range(60):
        words = []
        for _ in range(rng.randint(1, 4)):
            words += [rng.choice(vocabulary) for _ in range(rng.randint(0, 40))]
            part = list(rng.choice(shared))
            if rng.random() < 0.4:
                part[rng.randrange(len(part))] = "edit"
            words += part
        if k % 7 == 0:
            words += ["same"] * rng.randint(15, 80)
        rows.append((2000 + k, " ".join(words)))
    return rows + [(3000, rows[3][1]), (3001, rows[3][1] + " end")]


@pytest.mark.parametrize("seed, shard", [(1, 1000), (2, 7)])
def test_repeated_passages(spark, monkeypatch, odd, odd_rows, seed, shard):
    monkeypatch.setattr(phrase_automata, "SHARD_DOCUMENTS", shard)
    rows = passages(random.Random(seed))
    one_each = {r[0]: (r[0], r[1]) for r in odd_rows}
    ordered = sorted([*one_each.values(), *rows], key=lambda r: (r[0] is not None, r[0] or 0))
    docs = odd.select("doc_id", "text", "node").unionByName(
        spark.createDataFrame(rows, "doc_id long, text string"), allowMissingColumns=True)
    found = [tuple(r) for r in phrase_automata.without_repeats(docs).collect()]
    repeats = [r[0] for r in odd_rows].count
    expected = [e for e in kept_words(ordered) for _ in range(max(repeats(e[0]), 1))]
    assert by_text(found) == by_text(expected)


def test_no_passages(none):
    assert phrase_automata.without_repeats(none).count() == 0


def test_results_are_tables_in_the_shared_folder(spark, odd):
    stored = materialize(odd.select("doc_id"), "test")
    assert stored.count() == odd.count()
