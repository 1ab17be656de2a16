"""Personal data, periodic runs and the Merkle manifest against plain versions of the same questions."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from paperlens.llm import merkle_manifest, periodic_runs, personal_data, queries

FOLDER = "/root/testdata/sf0.001"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
    return sum(x - 9 * (x > 9) for x in doubled) % 10 == 0


def holds(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {
        "email": True, "ip": all(int(p) <= 255 for p in value.split(".")) if kind == "ip" else None,
        "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15,
    }[kind]


def base_spans(text):
    found = []
    for place, (kind, pattern) in enumerate(PATTERNS.items()):
        found += [(m.start(), place, m.end(), kind) for m in re.finditer(pattern, text or "") if holds(kind, m.group())]
    return sorted(found)


def spans(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    return {r["doc_id"]: r["spans"] for r in personal_data.personal_spans(rows).collect()}


def test_base_spans_by_brute_force(spark):
    rng = random.Random(3)
    pieces = [
        "a@b.c", "_", "@", " ", "1", "12", "4111111111111111", "4111-1111 1111-1111", "+1 (499) 555-6503", ".", "255",
        "1.2.3.4", "x", "é", "\U0001f600", "-", "(", ")", "\n", "+44", "ab%c", "GB82 WEST 1234 5698 7654 32", "phone",
    ]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 40))) for _ in range(800)]
    texts += ["a@b.c_d@e.f a@b_c@d.e", "001.02.0003.255 256.1.1.1 1.2.3.4.5.6.7.8", None, ""]
    for number, found in spans(spark, texts).items():
        assert [(s["start"], s["place"], s["end"], s["kind"]) for s in found if s["place"] < 4] == base_spans(texts[number])
        assert all(s["value"] == texts[number][s["start"]: s["end"]] for s in found)


def test_checksums_and_words_decide_on_added_spans(spark):
    found = spans(spark, [
        "iban GB82 WEST 1234 5698 7654 32 fine", "iban GB82 WEST 1234 5698 7654 33 fine", "xGB82WEST12345698765432",
        "her ssn is 123-45-6789", "part 123-45-6789", "call (415) 555-0100", "rev 415-555-0100", "ssn 000-45-6789",
        "card 4111 1111 1111 1111", "order 4111 1111 1111 1111",
    ])
    kinds = {k: [(s["kind"], s["score"]) for s in v] for k, v in found.items()}
    assert kinds[0] == [("iban", 100)] and kinds[1] == [] and kinds[2] == []
    assert kinds[3] == [("ssn", 70)] and kinds[4] == [] and kinds[5] == [("local", 70)] and kinds[6] == [] and kinds[7] == []
    assert kinds[8] == [("card", 100)] and kinds[9] == [("card", 40)]


def test_long_texts_cost_time_in_proportion(spark):
    texts = [
        "x" * 300_000, "1" * 200_000, "1 " * 50_000, "a@b." + "c." * 20_000 + "d", "+1" + "(" * 20_000, "a." * 50_000 + "@",
        "mail a@b.co " * 3000,
    ]
    for number, found in spans(spark, texts).items():
        assert len(found) == texts[number].count("@b.")
        assert all(texts[number][s["start"]: s["end"]] == s["value"] for s in found)


def test_personal_data_of_odd_rows(spark, odd, odd_rows, none):
    found = personal_data.personal_report(odd).collect()
    assert len(found) == len(odd_rows) and personal_data.personal_report(none).count() == 0
    empty = hashlib.sha256(b"").hexdigest()
    assert all(r["spans"] == "" and r["base_sha256"] == empty for r in found if r["doc_id"] in (0, 1))
    # A filter on the result does not repeat the work without end.
    assert personal_data.personal_report(odd).filter("n_email = 0 and n_likely = 0").count() == len(odd_rows)


def all_runs(words):
    n, found = len(words), set()
    for period in range(1, n // 4 + 1):
        i = 0
        while i + period < n:
            start = i
            while i + period < n and words[i] == words[i + period]:
                i += 1
            length = i - start + period
            part = words[start: start + length]
            if length >= max(6, 4 * period) and not any(part[p:] == part[:-p] for p in range(1, period)):
                found.add((start, length, period))
            i += 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def test_runs_by_brute_force():
    rng = random.Random(1)
    for _ in range(3000):
        words = [bytes([97 + rng.randrange(rng.choice([1, 2, 3, 5]))]) for _ in range(rng.randint(0, 60))]
        if words and rng.random() < 0.6:
            a, p = rng.randrange(len(words)), rng.randint(1, 8)
            words = [words[a + (i - a) % p] if i >= a and a + p <= len(words) else w for i, w in enumerate(words)]
        assert periodic_runs.document_runs(words) == all_runs(words)


def test_runs_of_long_texts():
    words = [b"%d" % (k % 777) for k in range(100_000)]
    assert periodic_runs.document_runs(words) == [(0, 100_000, 777)]
    assert periodic_runs.document_runs([b"w" * 100_000] * 50) == [(0, 50, 1)]


def test_run_query_by_brute_force(spark):
    made = {r["doc_id"]: r for r in queries.op12_periodic_runs(spark, FOLDER).collect()}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    assert len(made) == len(docs)
    for doc_id, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
        runs, row = all_runs(words), made[doc_id]
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
        kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
        assert (row["n_words"], row["n_runs"]) == (n, len(runs))
        assert row["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(kept.encode()).hexdigest()
        best = max(runs, key=lambda r: (r[1] * 10 ** 12 // r[2], -r[0], -r[2]), default=None)
        assert (row["start"], row["length"], row["period"]) == (best or (None, None, None))
        assert row["exponent_milli"] == (1000 * best[1] // best[2] if best else None)


def test_runs_of_odd_rows(spark, odd, odd_rows, none):
    found = periodic_runs.with_runs(odd).collect()
    assert len(found) == len(odd_rows) and periodic_runs.with_runs(none).count() == 0
    repeated = next(r for r in found if r["doc_id"] == 14)
    assert [tuple(r) for r in repeated["runs"]] == [(0, 500, 1)] and repeated["collapsed"] == "la"
    assert all(r["n_words"] == 0 and r["runs"] == [] and r["collapsed"] == "" for r in found if r["doc_id"] in (0, 1))


def sha(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def tree(nodes, arity):
    """(last node, siblings of each first node as (left, right) by level)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, path in enumerate(paths):
            first = at[k] - at[k] % arity
            path.append((nodes[first: at[k]], nodes[at[k] + 1: first + arity]))
            at[k] //= arity
        nodes = [sha(*nodes[i: i + arity]) for i in range(0, len(nodes), arity)]
    return nodes[0], paths


def expected_manifest(rows, arity):
    """rows: (key, part, leaf, folded)."""
    parts = {}
    for row in sorted(rows, key=lambda r: (r[1], r[0] is not None, r[0] or 0, r[2], r[3])):
        parts.setdefault(row[1], []).append(row)
    grown = {part: tree([r[2] for r in mine], arity) for part, mine in parts.items()}
    root, above = tree([grown[p][0] for p in parts], arity)
    out = []
    for (part, mine), up in zip(parts.items(), above):
        for row, path in zip(mine, grown[part][1]):
            proof, node = [], row[3]
            for left, right in path + up:
                proof += left + right
                node = sha(*left, node, *right)
            out.append((row[0], part, row[2], grown[part][0], root, proof, sha(*proof), node))
    return sorted(out, key=repr)


@pytest.mark.parametrize("arity, height, count", [(2, 2, 203), (2, 3, 64), (3, 1, 50), (2, 10, 65), (4, 2, 1)])
def test_manifest_by_brute_force(spark, arity, height, count):
    rng = random.Random(count)
    rows = [(rng.choice([None, rng.randrange(80)]), rng.choice(["", "=a", "=a", "=a", "=é", "=zz"]), sha(str(rng.randrange(60))))
            for _ in range(count)]
    rows = [(k, part, leaf, sha("x", leaf) if rng.random() < 0.3 else leaf) for k, part, leaf in rows]
    made = merkle_manifest.manifest(
        spark.createDataFrame(rows, "key long, _part string, _node string, _folded string").repartition(5), arity, height)
    found = [(r["key"], r["part"], r["leaf"], r["subroot"], r["root"], r["proof"], r["proof_sha256"], r["folded_root"])
             for r in made.collect()]
    assert sorted(found, key=repr) == expected_manifest(rows, arity)


def test_states_fold_like_a_new_tree():
    nodes = [sha(str(k)) for k in range(11)]
    block = merkle_manifest.Block(nodes, 4)
    for k in range(11):
        changed = nodes[:k] + [sha("new")] + nodes[k + 1:]
        assert block.fold(k, sha("new")) == merkle_manifest.Block(changed, 4).levels[-1][0]
        assert block.fold(k, nodes[k]) == block.levels[-1][0]


def test_manifest_of_odd_rows(spark, odd, odd_rows, none):
    never = F.lit(False)
    made = merkle_manifest.documents_manifest(odd, {}, never).collect()
    assert len(made) == len(odd_rows) and {r["root"] for r in made} == {r["folded_root"] for r in made}
    assert len({r["part"] for r in made}) == 2 and len({r["root"] for r in made}) == 1
    assert merkle_manifest.documents_manifest(none, {}, never).count() == 0
    other = merkle_manifest.documents_manifest(odd, {"n_chars": F.col("n_chars") + 1}, F.col("doc_id") == 5).collect()
    assert sum(r["folded_root"] != r["root"] for r in other) == 1
