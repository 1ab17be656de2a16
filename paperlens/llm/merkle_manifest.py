"""A Merkle tree over the rows of a table, with a proof for each row and replacements folded to the root.

Leaves are digests of rows. In each part (a value of one column) they stand in order; every ``arity``
consecutive nodes are hashed into their parent until one is left, and the parts' last nodes, in the order
of the parts, form a tree of their own above. A parent keeps, for each of its children, a copy of its hash
state from just before that child went in. Folding a replaced leaf takes that copy up again and feeds it
the replacement and the siblings to the right: nothing to the left is hashed again.

Trees grow by blocks of ``arity ** height`` consecutive nodes, one group of Spark each, so that no part
however large is one task: the blocks' last nodes are the leaves of the next layer. On the way down each
block hands its nodes their siblings, kept as what is left and right of them; a task that folds through
the layers above makes the states from these once for its block. Only digests are shuffled, never texts.

Rows are numbered without a sort in one task: range partitions by part and order are stored, and each row
counts from the start of its range. Ties of the order column stand by leaf; a null part or order stands
first. Equal rows have equal leaves and a place each. An empty table has an empty manifest; other columns
play no part.
"""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, remove

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY, HEIGHT = 2, 10

NODES = "_part string, _place long, _size long, _node string"
PATHS = "_part string, _place long, _left array<string>, _right array<string>, _subroot string, _root string"


def leaf(*values: Column) -> Column:
    """SHA-256 of the values, each as its number of bytes, a colon and its text; a null is a dash."""
    def shown(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(shown, values)), 256)


def part_key(column: Column) -> Column:
    """A text without nulls that orders as the column does, the null first."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


class Block:
    """The tree above some consecutive nodes, with the states before each child slot."""

    def __init__(self, nodes: list[str], levels: int, arity: int = ARITY):
        self.arity, self.levels, self.states = arity, [nodes], []
        for _ in range(levels):
            parents, states = [], []
            for k, node in enumerate(self.levels[-1]):
                if k % arity == 0:
                    state = sha256()
                states.append(state.copy())
                state.update(node.encode())
                if k % arity == arity - 1 or k == len(self.levels[-1]) - 1:
                    parents.append(state.hexdigest())
            self.states.append(states)
            self.levels.append(parents)

    def siblings(self, k: int) -> tuple[list[str], list[str]]:
        """What stands left and right of node ``k`` and of each of its parents, level by level."""
        left, right = [], []
        for nodes in self.levels[:-1]:
            first = k - k % self.arity
            left.append("".join(nodes[first:k]))
            right.append("".join(nodes[k + 1: first + self.arity]))
            k //= self.arity
        return left, right

    def fold(self, k: int, node: str) -> str:
        """The block's last node with ``node`` in place ``k``."""
        for nodes, states in zip(self.levels, self.states):
            state = states[k].copy()
            first = k - k % self.arity
            state.update("".join([node, *nodes[k + 1: first + self.arity]]).encode())
            node = state.hexdigest()
            k //= self.arity
        return node


def levels_of(size: int, arity: int, height: int) -> int:
    """Levels of a block in a layer of ``size`` nodes: all, or as many as it takes to have one left."""
    levels = 0
    while levels < height and size > arity ** levels:
        levels += 1
    return levels


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """``_place`` of each row in its ``_part`` by ``order``, from 0, and ``_size`` of the part."""
    ranges = materialize(
        rows.repartitionByRange("_part", *order).withColumn("_range", F.spark_partition_id()), "manifest-ranges")
    part = Window.partitionBy("_part")
    before = part.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.groupBy("_part", "_range").agg(F.count("*").alias("_rows")).select(
        "_part", "_range",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"), F.sum("_rows").over(part).alias("_size"))
    within = Window.partitionBy("_part", "_range").orderBy(*order)
    return ranges.withColumn("_row", F.row_number().over(within)).join(starts, ["_part", "_range"]).withColumn(
        "_place", F.col("_start") + F.col("_row") - 1).drop("_range", "_start", "_row")


def _in_blocks(nodes: DataFrame, width: int) -> DataFrame:
    return nodes.withColumn("_block", F.expr(f"_place div {width}"))


def layers(leaves: DataFrame, arity: int, height: int) -> list[DataFrame]:
    """The nodes that blocks leave over, layer by layer, up to one for each part."""
    width = arity ** height

    def grown(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_place")
        size = int(pdf["_size"].iloc[0])
        block = Block(pdf["_node"].tolist(), levels_of(size, arity, height), arity)
        return pd.DataFrame({
            "_part": [pdf["_part"].iloc[0]], "_place": [int(pdf["_block"].iloc[0])],
            "_size": [-(-size // width)], "_node": [block.levels[-1][0]]})

    out = [leaves.select("_part", "_place", "_size", "_node")]
    size = leaves.agg(F.max("_size")).first()[0] or 0
    while True:
        blocks = _in_blocks(out[-1], width).groupBy("_part", "_block").applyInPandas(grown, NODES)
        out.append(materialize(blocks, "manifest-nodes"))
        size = -(-size // width)
        if size <= 1:
            return out


def _handed_down(nodes: DataFrame, above: DataFrame, arity: int, height: int) -> DataFrame:
    """Paths of ``nodes`` from those of their blocks."""

    def handed(pdf: pd.DataFrame, path: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_place")
        block = Block(pdf["_node"].tolist(), levels_of(int(pdf["_size"].iloc[0]), arity, height), arity)
        up = path.iloc[0]
        rows = []
        for k, place in enumerate(pdf["_place"].tolist()):
            left, right = block.siblings(k)
            rows.append((up["_part"], place, left + list(up["_left"]), right + list(up["_right"]),
                         up["_subroot"], up["_root"]))
        return pd.DataFrame(rows, columns=["_part", "_place", "_left", "_right", "_subroot", "_root"])

    blocks = _in_blocks(nodes, arity ** height).groupBy("_part", "_block")
    return blocks.cogroup(above.groupBy("_part", "_place")).applyInPandas(handed, PATHS)


def paths_down(grown: list[DataFrame], top: DataFrame, arity: int, height: int) -> DataFrame:
    """Paths of the blocks of the lowest layer, from those of the parts' last nodes."""
    paths = top
    for nodes in reversed(grown[1:-1]):
        paths = _handed_down(nodes, paths, arity, height)
    return paths


def manifest(rows: DataFrame, arity: int = ARITY, height: int = HEIGHT, keep_proof: bool = True) -> DataFrame:
    """Manifest of ``rows`` (key, _part, _node, _folded): the leaf and what is folded in its place.

    Returns (key, part, place, leaf, subroot, root, proof, proof_sha256, folded_root): the proof is the
    list of siblings from the leaf up, left to right; without ``keep_proof`` it is null and only its digest is made.
    """
    key = rows.schema["key"].dataType.simpleString()
    leaves = numbered(rows, "key", "_node", "_folded")
    grown = layers(leaves, arity, height)
    # The parts are the leaves of the tree on top, in their order.
    tops = numbered(grown[-1].select(F.lit("").alias("_part"), F.col("_part").alias("_name"), "_node"), "_name")
    upper = layers(tops, arity, height)
    root = upper[-1].select(
        "_part", F.lit(0).cast("long").alias("_place"), F.array().cast("array<string>").alias("_left"),
        F.array().cast("array<string>").alias("_right"), F.lit("").alias("_subroot"), F.col("_node").alias("_root"))
    of_parts = _handed_down(upper[0], paths_down(upper, root, arity, height), arity, height)
    named = of_parts.drop("_part", "_subroot").join(
        tops.select("_place", F.col("_name").alias("_part"), F.col("_node").alias("_subroot")), "_place")
    top = named.select("_part", F.lit(0).cast("long").alias("_place"), "_left", "_right", "_subroot", "_root")
    paths = materialize(paths_down(grown, top, arity, height), "manifest-paths")
    for table in [*grown[1:], *upper[1:]]:
        remove(table)

    def folded(pdf: pd.DataFrame, path: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_place")
        block = Block(pdf["_node"].tolist(), levels_of(int(pdf["_size"].iloc[0]), arity, height), arity)
        up = path.iloc[0]
        # The states before this block's slots in the layers above, made once for all its leaves.
        above = [(sha256(left.encode()), right) for left, right in zip(up["_left"], up["_right"])]
        proof_above = "".join(left + right for left, right in zip(up["_left"], up["_right"]))
        digests, roots, proofs = [], [], []
        for k, replaced in enumerate(pdf["_folded"].tolist()):
            left, right = block.siblings(k)
            proof = "".join(a + b for a, b in zip(left, right)) + proof_above
            node = block.fold(k, replaced)
            for state, behind in above:
                state = state.copy()
                state.update((node + behind).encode())
                node = state.hexdigest()
            digests.append(sha256(proof.encode()).hexdigest())
            roots.append(node)
            proofs.append([proof[i: i + 64] for i in range(0, len(proof), 64)] if keep_proof else None)
        return pd.DataFrame({
            "key": pdf["key"], "part": pdf["_part"], "place": pdf["_place"], "leaf": pdf["_node"],
            "subroot": up["_subroot"], "root": up["_root"], "proof": proofs, "proof_sha256": digests,
            "folded_root": roots})

    blocks = _in_blocks(leaves, arity ** height).groupBy("_part", "_block")
    return blocks.cogroup(paths.groupBy("_part", "_place")).applyInPandas(
        folded, f"key {key}, part string, place long, leaf string, subroot string, root string, "
                "proof array<string>, proof_sha256 string, folded_root string")


def documents_manifest(docs: DataFrame, replaced: dict[str, Column], when: Column, **options) -> DataFrame:
    """Manifest of documents by language and id; where ``when`` holds, the leaf of the ``replaced`` fields is folded.

    ``key`` is the id, ``part`` the language with a mark in front (empty for the null).
    """
    plain = leaf(*[F.col(c) for c in FIELDS])
    other = leaf(*[replaced.get(c, F.col(c)) for c in FIELDS])
    rows = docs.select(
        F.col("doc_id").alias("key"), part_key(F.col("lang")).alias("_part"), plain.alias("_node"),
        F.when(when, other).alias("_other"))
    return manifest(rows.select("key", "_part", "_node", F.coalesce("_other", "_node").alias("_folded")), **options)
