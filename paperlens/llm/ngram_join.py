"""N-gram Jaccard self-join of document sets, by set relations.

Texts are sets of hashed shingles, rare ones first by counts over all documents. Documents with equal
sets are one class. The index lists of the shingles in the prefixes of the classes tell which sets can
be similar. Two relations between sets save most of the work:

* Each list has a pivot. A set that can be similar to a pivot joins its family and is compared with it. Members
  that link to the pivot are connected by that alone. The answers of the others are derived from the members'
  differences to the pivot, in cells of bounded size, and only among members whose distances to it allow a link.
* Lists are cut into blocks by position. A pair of blocks is skipped when it lies within one family or
  when positions or sizes cannot give enough overlap; only pairs of entries from other block pairs are
  candidates. A parity sketch, whose distance never exceeds that of the sets, drops most of these.

All that is left is decided on the shingles of the whole texts. No link between two classes that
belong to different components is lost; links are kept as they are needed to connect, not all listed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import materialize, remove
from .components import components
from .textblocks import blocks, gram_hashes, word_hashes

COUNTERS = 1 << 20
SLICE = 1 << 16
LEVELS = 15
# A set joins the family of a pivot from this similarity on, in parts of a hundred.
FAMILY = 50
# Members and shingles that a group of a family holds, about.
CELL = 512
CELL_SHINGLES = 200_000
# Shingles of sets that a task remembers from pair to pair, about.
HELD_SHINGLES = 2_000_000


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """60-bit hashes of the n-word shingles; of the whole sequence if there are fewer words."""
    if not len(words):
        return np.zeros(0, np.uint64)
    return gram_hashes(words, min(n, len(words))) >> np.uint64(4)


def token_set(words: np.ndarray, n: int, levels: np.ndarray) -> np.ndarray:
    """The distinct shingles in the global order: level of frequency, then hash."""
    hashes = shingles(words, n)
    level = levels[(hashes >> np.uint64(40)).astype(np.int64)].astype(np.uint64)
    return np.unique(hashes | (level << np.uint64(60)))


def node_of(words: np.ndarray, n: int) -> int | None:
    """A 64-bit digest of the set of shingles; none for a text without words."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(np.unique(shingles(words, n)).tobytes())).view(np.int64)) if len(words) else None


def frequency_levels(docs: DataFrame, n: int) -> np.ndarray:
    """A level from 0 to LEVELS for each of COUNTERS hash buckets, from the shingles of all documents.

    Tasks count their shingles in arrays of fixed size; slices of the arrays are added up. Level 0 is
    what an even spread would give; above it, each doubling is a level.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.uint32)
        for batch in batches:
            for _, data, offsets in blocks(batch.column(0)):
                words, bounds = word_hashes(data, offsets, lower=True)
                whole = np.flatnonzero(np.diff(bounds) < n)
                grams = gram_hashes(words, n)
                inside = np.ones(len(grams), bool)
                for k in range(1, n):
                    cut = bounds[1:-1] - k
                    inside[cut[(cut >= 0) & (cut < len(grams))]] = False
                np.add.at(counts, (grams[inside] >> np.uint64(44)).astype(np.int64), 1)
                short = [shingles(words[bounds[r]: bounds[r + 1]], n) for r in whole]
                if short:
                    np.add.at(counts, (np.concatenate(short) >> np.uint64(40)).astype(np.int64), 1)
        parts = counts.reshape(-1, SLICE)
        used = np.flatnonzero(parts.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array([parts[k].tobytes() for k in used], pa.binary())],
                                         names=["slice", "counts"])

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                sums[k] = sums.get(k, 0) + np.frombuffer(raw.as_buffer(), batch_kind).astype(np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([s.astype("<u8").tobytes() for s in sums.values()], pa.binary())],
                                         names=["slice", "counts"])

    batch_kind = "<u4"
    parts = docs.select("text").mapInArrow(count, "slice long, counts binary")
    sums = parts.repartition(COUNTERS // SLICE, "slice").mapInArrow(add, "slice long, counts binary").collect()
    total = np.zeros((COUNTERS // SLICE, SLICE))
    for row in sums:
        total[row["slice"]] = np.frombuffer(row["counts"], "<u8")
    total = total.ravel()
    even = total.mean()
    floor = even + 6 * np.sqrt(even) + 8
    return np.where(total > floor, np.clip(1 + np.log2(np.maximum(total / floor, 1)), 1, LEVELS), 0).astype(np.uint8)


def parity_sketch(tokens: np.ndarray) -> np.ndarray:
    """One bit for each hash place: whether an odd number of members fall there. Two places a member, at least."""
    size = max(64, 1 << int(2 * len(tokens) - 1).bit_length())
    return np.packbits(np.bincount((tokens & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1, bitorder="little")


def sketch_distance(a: bytes, b: bytes) -> int:
    """A lower bound on the number of members that only one of two sets has."""
    x, y = (np.frombuffer(s, np.uint8) for s in (a, b))
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2:]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def described(docs: DataFrame, n: int, percent: int, levels: np.ndarray) -> DataFrame:
    """doc_id, n_shingles, node (a 64-bit digest of the set), prefix and parity sketch of every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in blocks(batch.column(1)):
                words, bounds = word_hashes(data, offsets, lower=True)
                sizes, nodes, prefixes, sketches = [], [], [], []
                for a, b in zip(bounds, bounds[1:]):
                    tokens = token_set(words[a:b], n, levels)
                    size = len(tokens)
                    sizes.append(size)
                    nodes.append(node_of(words[a:b], n))
                    prefixes.append(tokens[: size + (-percent * size // 100) + 1].view(np.int64) if size else [])
                    sketches.append(parity_sketch(tokens).tobytes() if size else b"")
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(row, len(sizes)), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()),
                    pa.array(prefixes, pa.list_(pa.int64())), pa.array(sketches, pa.binary()),
                ], names=["doc_id", "n_shingles", "node", "prefix", "sketch"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_shingles long, node long, prefix array<long>, sketch binary")


def near_enough(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) whose sizes and sketches allow a similarity of ``percent`` of a hundred, with the size of a."""
    sides = sets.select("node", "n", "sketch")
    joined = pairs.join(sides.toDF("a", "n_a", "s_a"), "a").join(sides.toDF("b", "n_b", "s_b"), "b")
    joined = joined.filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, s_a, n_b, s_b = (batch.column(k).to_pylist() for k in range(2, 6))
            keep = [(p + q) * (100 - percent) >= sketch_distance(s, t) * (100 + percent) for p, s, q, t in zip(n_a, s_a, n_b, s_b)]
            yield pa.RecordBatch.from_arrays(batch.columns[:3], names=["a", "b", "n_a"]).filter(pa.array(keep, pa.bool_()))

    return joined.select("a", "b", "n_a", "s_a", "n_b", "s_b").mapInArrow(run, "a long, b long, n_a long")


def text_tokens(text: str, n: int, levels: np.ndarray) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    return token_set(word_hashes(data, np.array([0, len(data)]), lower=True)[0], n, levels)


def decided(pairs: DataFrame, texts: DataFrame, n: int, levels: np.ndarray) -> DataFrame:
    """a, b, shared, n_a, n_b: the overlap of the sets of whole texts."""
    joined = pairs.join(texts.toDF("a", "t_a"), "a").join(texts.toDF("b", "t_b"), "b")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}

        def tokens(node: int, text: str) -> np.ndarray:
            if node not in held:
                if sum(map(len, held.values())) > HELD_SHINGLES:
                    held.clear()
                held[node] = text_tokens(text, n, levels)
            return held[node]

        for batch in batches:
            rows = []
            for a, t_a, b, t_b in zip(*(batch.column(k).to_pylist() for k in range(4))):
                x, y = tokens(a, t_a), tokens(b, t_b)
                rows.append((len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)))
            columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *columns], names=["a", "b", "shared", "n_a", "n_b"])

    return joined.select("a", "t_a", "b", "t_b").mapInArrow(run, "a long, b long, shared long, n_a long, n_b long")


def similar(percent: int) -> Column:
    union = F.col("n_a") + F.col("n_b") - F.col("shared")
    return 100 * F.col("shared") >= percent * union


def groups_of(count: Column, shingle_count: Column) -> Column:
    """How many groups of about CELL members or CELL_SHINGLES shingles hold so many."""
    return F.greatest(F.ceil(count / CELL), F.ceil(shingle_count / CELL_SHINGLES)).cast("int")


def pivot_answers(members: DataFrame, texts: DataFrame, n: int, percent: int, levels: np.ndarray) -> DataFrame:
    """pivot, node, n, linked, ring: each member (pivot, node, n) of a family compared with its pivot.

    ``linked`` tells whether the two link. ``ring`` is the distance to the pivot (one less the
    similarity) in steps of the largest distance of a link. A family is dealt out over groups; the
    pivot comes to each of them, and every other text to one.
    """
    groups = members.groupBy("pivot").agg(groups_of(F.count("*"), F.sum("n")).alias("groups"))
    rows = members.select("pivot", "node").join(groups, "pivot")
    rows = rows.select("pivot", "node", F.pmod(F.xxhash64("node"), F.col("groups")).cast("int").alias("part"))
    pivots = groups.select("pivot", F.col("pivot").alias("node"), F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("part"))
    step = max(100 - percent, 1)

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        own = part.node == key[0]
        pivot = text_tokens(part.text[own].iloc[0], n, levels)
        rows = []
        for node, text in zip(part.node[~own], part.text[~own]):
            tokens = text_tokens(text, n, levels)
            shared = len(np.intersect1d(pivot, tokens, assume_unique=True))
            union = len(pivot) + len(tokens) - shared
            rows.append((key[0], node, len(tokens), 100 * shared >= percent * union, 100 * (union - shared) // (step * union)))
        return pd.DataFrame(rows, columns=["pivot", "node", "n", "linked", "ring"])

    joined = rows.unionByName(pivots).join(texts, "node")
    return joined.groupBy("pivot", "part").applyInPandas(run, "pivot long, node long, n long, linked boolean, ring int")


def open_cells(answers: DataFrame) -> DataFrame:
    """pivot, x, y, node: the cells in which members of a family that do not link to its pivot meet the others.

    Members that link to the pivot are connected by it, so two groups of such meet in no cell. Nor do
    groups two rings or more apart: distances obey the triangle inequality, and members that far apart
    from the pivot's point of view cannot link.
    """
    kind = ["pivot", "linked", "ring"]
    sizes = answers.groupBy(*kind).agg(groups_of(F.count("*"), F.sum("n")).alias("groups"))
    slot = F.struct("linked", "ring", "group")
    slots = sizes.withColumn("group", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))).select("pivot", slot.alias("slot"))
    x, y = slots.filter("not slot.linked").toDF("pivot", "x"), slots.toDF("pivot", "y")
    cells = x.join(y, "pivot").filter((F.abs(F.col("x.ring") - F.col("y.ring")) <= 1) & (F.col("y.linked") | (F.col("x") <= F.col("y"))))
    cells = cells.withColumn("slot", F.explode(F.array_distinct(F.array("x", "y"))))
    rows = answers.join(sizes, kind).withColumn("group", F.pmod(F.xxhash64("node"), F.col("groups")).cast("int"))
    return cells.join(rows.select("pivot", slot.alias("slot"), "node"), ["pivot", "slot"]).select("pivot", "x", "y", "node")


def family_links(answers: DataFrame, texts: DataFrame, n: int, percent: int, levels: np.ndarray) -> DataFrame:
    """Links (a, b) among the members of each family and its pivot, as a forest for each cell.

    The pivot comes to every cell; the overlap of two members follows from their differences to it.
    """
    rows = open_cells(answers)
    cells = rows.select("pivot", "x", "y").distinct()
    rows = rows.unionByName(cells.withColumn("node", F.col("pivot"))).join(texts, "node")

    def run(key: tuple, cell: pd.DataFrame) -> pd.DataFrame:
        nodes = cell.node.to_numpy()
        sets = [text_tokens(t, n, levels) for t in cell.text]
        pivot = sets[int(np.flatnonzero(nodes == key[0])[0])]
        # Differences to the pivot: what a set lacks, and what it has more. Every overlap follows from them.
        less = [np.setdiff1d(pivot, s, assume_unique=True) for s in sets]
        more = [np.setdiff1d(s, pivot, assume_unique=True) for s in sets]
        base = np.array([len(pivot) - len(x) for x in less], np.float64)
        sizes = np.array([len(s) for s in sets], np.float64)
        shared = base[:, None] + base[None, :] - len(pivot) + common(less) + common(more)
        link = np.triu(100 * shared >= percent * (sizes[:, None] + sizes[None, :] - shared), 1)
        a, b = forest(link)
        return pd.DataFrame({"a": nodes[a], "b": nodes[b]})

    met = rows.groupBy("pivot", "x", "y").applyInPandas(run, "a long, b long")
    return met.unionByName(answers.filter("linked").select(F.col("node").alias("a"), F.col("pivot").alias("b")))


def common(lists: list[np.ndarray]) -> np.ndarray:
    """How many items each two different lists share."""
    out = np.zeros((len(lists), len(lists)))
    owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    _, at, times = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    often = times[at] > 1
    owner, at = owner[often], np.unique(at[often], return_inverse=True)[1]
    for first in range(0, int(at.max(initial=-1)) + 1, 4096):
        own = (at >= first) & (at < first + 4096)
        grid = np.zeros((len(lists), 4096), np.float32)
        grid[owner[own], at[own] - first] = 1
        out += grid @ grid.T
    return out


def forest(link: np.ndarray) -> tuple[list[int], list[int]]:
    """Links enough to connect what a matrix of links connects, fewer than it has rows."""
    label, a, b = np.arange(len(link)), [], []
    link = link | link.T
    for x in range(len(link)):
        while True:
            open_ = np.flatnonzero(link[x] & (label != label[x]))
            if not len(open_):
                break
            y = int(open_[0])
            label[label == label[y]] = label[x]
            a.append(x)
            b.append(y)
    return a, b


def index_lists(sets: DataFrame) -> DataFrame:
    """token, node, n, pos, pivot: the index lists with more than one entry, the smallest node as pivot.

    Length and pivot of a list are combined before the shuffle and joined to its entries, so the entries
    of a long list may lie in many tasks. Common shingles come last in every set, so a list is long only
    where many sets have nothing rarer.
    """
    postings = sets.select("node", "n", F.posexplode("prefix").alias("pos", "token"))
    pivots = postings.groupBy("token").agg(F.min("node").alias("pivot"), F.max("node").alias("_last"))
    return postings.join(pivots.filter("pivot < _last").drop("_last"), "token").select("token", "node", "n", "pos", "pivot")


def cross_candidates(lists: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes of different families that share an index list, at positions and of sizes that allow a link."""
    entries = lists.withColumn("part", F.floor(F.col("pos") / 16).cast("int"))
    parts = entries.groupBy("token", "part").agg(
        F.min("pos").alias("lo"), F.min("n").alias("least"), F.max("n").alias("most"), F.min("family").alias("f_lo"), F.max("family").alias("f_hi"))

    def allowed(pos_a: Column, pos_b: Column, small_a: Column, large_a: Column, small_b: Column, large_b: Column) -> Column:
        sizes = 100 * F.least(large_a, large_b) >= percent * F.greatest(small_a, small_b)
        return sizes & ((pos_a + pos_b) * (100 + percent) <= (large_a + large_b) * (100 - percent))

    x, y = (parts.select("token", *[F.col(c).alias(f"{c}_{k}") for c in parts.columns if c != "token"]) for k in "xy")
    one_family = (F.col("f_lo_x") == F.col("f_hi_x")) & (F.col("f_lo_y") == F.col("f_hi_y")) & (F.col("f_lo_x") == F.col("f_lo_y"))
    c = F.col
    met = x.join(y, "token").filter(
        (c("part_x") <= c("part_y")) & ~one_family & allowed(c("lo_x"), c("lo_y"), c("least_x"), c("most_x"), c("least_y"), c("most_y")))
    met = met.select("token", "part_x", "part_y")
    a, b = (entries.select("token", *[F.col(c).alias(f"{c}_{k}") for c in entries.columns if c != "token"]) for k in "xy")
    pairs = met.join(a, ["token", "part_x"]).join(b, ["token", "part_y"])
    pairs = pairs.filter(
        ((c("part_x") < c("part_y")) | (c("node_x") < c("node_y"))) & (c("node_x") != c("node_y")) & (c("family_x") != c("family_y"))
        & allowed(c("pos_x"), c("pos_y"), c("n_x"), c("n_x"), c("n_y"), c("n_y")))
    return pairs.select(F.greatest("node_x", "node_y").alias("a"), F.least("node_x", "node_y").alias("b")).distinct()


def classified(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_shingles, node of every document; node, doc, root of every class of equal sets)."""
    docs = docs.select("doc_id", "text")
    levels = frequency_levels(docs, n)
    full = materialize(described(docs, n, percent, levels), "shingle-sets")
    # One row for each class: equal nodes have equal sets.
    sets = full.filter("n_shingles > 0").select("node", F.col("n_shingles").alias("n"), "prefix", "sketch").dropDuplicates(["node"])
    sets = materialize(sets, "shingle-classes")
    every = materialize(full.select("doc_id", "n_shingles", "node"), "shingle-documents")
    remove(full)
    classes = every.filter("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("doc"))
    lists = materialize(index_lists(sets), "shingle-lists")

    # Families by sketches alone; the answers within them are computed from whole texts.
    stars = lists.filter("node != pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
    families = near_enough(stars, sets, FAMILY).groupBy("a").agg(F.min("b").alias("pivot"), F.min("n_a").alias("n"))
    members = materialize(families.select("pivot", F.col("a").alias("node"), "n"), "shingle-families")
    named = lists.select("token", "node", "n", "pos").join(members.select("node", "pivot"), "node", "left")
    named = named.select("token", "node", "n", "pos", F.coalesce("pivot", "node").alias("family"))
    crossing = materialize(near_enough(cross_candidates(named, percent), sets, percent).drop("n_a"), "shingle-pairs")
    remove(lists)
    remove(sets)

    # Texts of the nodes to be compared; the set of a text tells whether it is the one that is meant.
    ends = [members.select("node"), members.select(F.col("pivot").alias("node")), crossing.select(F.col("a").alias("node")), crossing.select(F.col("b").alias("node"))]
    wanted = ends[0].union(ends[1]).union(ends[2]).union(ends[3]).distinct().join(classes, "node")
    wanted = wanted.select("node", F.coalesce(F.col("doc").cast("string"), F.lit("")).alias("_doc"))
    held = docs.withColumn("_doc", F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).join(wanted, "_doc")
    texts = materialize(matching(held.dropDuplicates(["_doc", "node", "text"]).select("node", "text"), n), "shingle-texts")
    answers = materialize(pivot_answers(members, texts, n, percent, levels), "shingle-answers")
    links = family_links(answers, texts, n, percent, levels).unionByName(
        decided(crossing, texts, n, levels).filter(similar(percent)).select("a", "b"))
    links = materialize(links, "shingle-links")
    remove(texts)

    roots = components(links, "shingle-links")
    ends = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    return every.select("doc_id", "n_shingles", "node"), ends


def similar_documents(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest doc_id reachable by links, for every document.

    Words are runs without the six ASCII spaces, A-Z folded. A set holds the distinct ``n``-word
    shingles; with fewer words the whole sequence as one; a text without words, or null, has an empty set
    and is linked with nothing. Two documents link when their Jaccard similarity is ``percent`` of a
    hundred or more. Documents with equal sets are always linked. Rows are not merged: a repeated row
    comes out again, and a component of null ids alone has the component_id null. Other columns are
    ignored; an empty table gives no rows. Shingles are compared as 60-bit and sets as 64-bit hashes.
    """
    every, ends = classified(docs, n, percent)
    smallest = ends.groupBy("root").agg(F.min("doc").alias("component_id"))
    out = every.join(ends.join(smallest, "root").select("node", "component_id"), "node", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def first_of_each(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component left: that of the smallest doc_id, null ids last.

    All columns stay as they are. Rows that share that id are told apart by a digest of their set, and of
    rows equal in both one stays. Documents without words stay.
    """
    _, ends = classified(docs, n, percent)
    last = F.lit((1 << 63) - 1)
    chosen = ends.groupBy("root").agg(F.min(F.struct(F.coalesce("doc", last).alias("doc"), "node")).alias("first"))
    chosen = chosen.select(F.col("first.node").alias("_first"), F.col("first.doc").alias("_doc"))
    rows = with_node(docs.select(F.struct(*docs.columns).alias("_row"), F.coalesce("doc_id", last).alias("_id"), "text"), n)
    kept = rows.join(chosen, F.col("_node") == F.col("_first"), "left").filter(F.col("_node").isNull() | (F.col("_id") == F.col("_doc")))
    # A row without words is a group of its own.
    own = F.when(F.col("_node").isNull(), F.monotonically_increasing_id()).otherwise(F.lit(-1))
    return kept.withColumn("_own", own).dropDuplicates(["_node", "_own"]).select("_row.*")


def with_node(rows: DataFrame, n: int) -> DataFrame:
    """``rows`` (packed row, id, text) with the digest of each set, in the order without frequencies."""
    schema = StructType([*rows.schema.fields[:2], StructField("_node", LongType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = []
            for _, data, offsets in blocks(batch.column(2)):
                words, bounds = word_hashes(data, offsets, lower=True)
                nodes += [node_of(words[a:b], n) for a, b in zip(bounds, bounds[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(nodes, pa.int64())], names=["_row", "_id", "_node"])

    return rows.mapInArrow(run, schema)


def matching(rows: DataFrame, n: int) -> DataFrame:
    """One text for each node (node, text) among those found by document id: the one with that set."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, keep = batch.column(0).to_pylist(), []
            for row, data, offsets in blocks(batch.column(1)):
                words, bounds = word_hashes(data, offsets, lower=True)
                for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    keep.append(node_of(words[a:b], n) == nodes[row + k])
            yield batch.filter(pa.array(keep, pa.bool_()))

    return rows.mapInArrow(run, "node long, text string")
