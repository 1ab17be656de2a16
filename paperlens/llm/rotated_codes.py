"""Approximate nearest neighbours by inner product, from randomly rotated one-bit codes.

Vectors are rotated by one random orthogonal matrix and reduced to the signs of their components. From
the packed signs, the length of a vector and the inner product of its direction with its own code, the
inner product with a rotated query is estimated without bias, and an error bound holds with a chosen
confidence. In each block only vectors whose upper bound reaches the k-th best lower bound are ranked
again by the original components. Blocks of queries meet blocks of codes; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SEED = 31
# Bits of a code for each number of a vector: error bounds shrink with the root of the length.
CODE_BITS = 8
# Rows that are packed together at most, whatever the size of the batches they come in.
PACKED_ROWS = 16_384
OUT = "query_id long, vec_id long, score double"


def rotation(dims: int) -> np.ndarray:
    """Orthonormal columns that turn a vector, padded with zeros to CODE_BITS for each number, at random."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).normal(size=(CODE_BITS * dims, dims)))
    return (q * np.sign(np.diag(r))).astype(np.float32)


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed signs, lengths, inner product of each direction with its code) of rows of numbers."""
    turn = rotation(vectors.shape[1])
    lengths = np.linalg.norm(vectors, axis=1)
    rotated = (vectors / lengths[:, None]).astype(np.float32) @ turn.T
    own = np.abs(rotated).sum(1) / np.sqrt(len(turn))
    return np.packbits(rotated > 0, axis=1), lengths.astype(np.float32), own.astype(np.float32)


def signs_of(codes: np.ndarray, bits: int) -> np.ndarray:
    return np.unpackbits(codes, axis=1, count=bits).astype(np.float32) * 2 - 1


def estimates(rotated: np.ndarray, signs: np.ndarray, lengths: np.ndarray, own: np.ndarray, confidence: float):
    """(lower, upper) bounds on the inner products of rotated query rows with coded vectors."""
    bits = rotated.shape[1]
    estimate = (rotated @ signs.T) * (lengths / (own * np.sqrt(bits)))
    spread = lengths * np.sqrt(np.maximum(1 - own * own, 0)) / own / np.sqrt(max(bits - 1, 1)) * confidence
    width = np.linalg.norm(rotated, axis=1)[:, None] * spread[None, :]
    return estimate - width, estimate + width


def exact(queries: np.ndarray, vectors: np.ndarray, q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products of pairs of rows in double precision, summed from the first component on."""
    out = np.zeros(len(q))
    for one, two in zip(np.ascontiguousarray(queries.T), np.ascontiguousarray(vectors.T)):
        out += one[q] * two[v]
    return out


def block_search(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, codes: np.ndarray,
                 lengths: np.ndarray, own: np.ndarray, k: int, confidence: float):
    """(query ids, vector ids, scores): the k best of a block for each query, ties to the smaller id."""
    found = []
    turn = rotation(queries.shape[1])
    signs = signs_of(codes, len(turn))
    for a in range(0, len(queries), 128):
        asked, some = query_ids[a: a + 128], queries[a: a + 128]
        low, high = estimates(some.astype(np.float32) @ turn.T, signs, lengths, own, confidence)
        itself = asked[:, None] == ids[None, :]
        low[itself] = high[itself] = -np.inf
        floor = np.full(len(asked), -np.inf)
        if low.shape[1] > k:
            floor = np.partition(low, low.shape[1] - k, axis=1)[:, low.shape[1] - k]
        q, v = np.nonzero((high >= floor[:, None]) & ~itself)
        score = exact(some, vectors, q, v)
        order = np.lexsort((ids[v], -score, q))
        q, v, score = q[order], v[order], score[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        found.append((asked[q[rank < k]], ids[v[rank < k]], score[rank < k]))
    return tuple(map(np.concatenate, zip(*found))) if found else (np.zeros(0, np.int64),) * 3


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """vec_id, vector as doubles; without null ids and vectors that are null, empty, zero or not finite throughout."""
    v = F.col(vector_column).cast("array<double>")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), v.alias("vector"))
    return rows.filter(F.col("vec_id").isNotNull() & (F.size("vector") > 0) & finite & F.exists("vector", lambda x: x != 0))


def packed_blocks(rows: DataFrame, blocks: int, with_codes: bool) -> DataFrame:
    """block, ids, vectors and, if asked for, codes, lengths, own: one row of packed arrays for each part of a block.

    A vector's block is a hash of its id. A task packs what it holds, PACKED_ROWS rows at a time, so that
    many vectors with one id bring more packed rows and not larger ones.
    """
    fields = "block int, dims int, ids binary, vectors binary" + ", codes binary, lengths binary, own binary" * with_codes

    kinds = pa.schema([(n, pa.binary() if t == "binary" else pa.int32()) for n, t in (f.split() for f in fields.split(", "))])

    def packed(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches).combine_chunks()
        block, ids = rows.column(0).to_numpy(), rows.column(1).to_numpy()
        lists = rows.column(2).combine_chunks()
        sizes, starts = np.diff(lists.offsets.to_numpy()), lists.offsets.to_numpy()[:-1]
        values = lists.values.to_numpy()
        for b in np.unique(block):
            for dims in np.unique(sizes[block == b]):
                own_rows = np.flatnonzero((block == b) & (sizes == dims))
                matrix = values[starts[own_rows][:, None] + np.arange(dims)]
                out = {"block": [int(b)], "dims": [int(dims)], "ids": [ids[own_rows].astype("<i8").tobytes()], "vectors": [matrix.tobytes()]}
                if with_codes:
                    codes, lengths, own = encode(matrix)
                    out |= {"codes": [codes.tobytes()], "lengths": [lengths.tobytes()], "own": [own.tobytes()]}
                yield pa.RecordBatch.from_pydict(out, kinds)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= PACKED_ROWS:
                yield from packed(held)
                held = []
        if held:
            yield from packed(held)

    block = F.pmod(F.xxhash64("vec_id", F.lit(SEED)), F.lit(blocks)).cast("int")
    dealt = rows.select(block.alias("block"), "vec_id", "vector").repartition(blocks, "block")
    return dealt.mapInArrow(run, fields)


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, confidence: float = 4.0, block_rows: int = 8192,
           id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """The k vectors of largest inner product for each query: query_id, rank, vec_id, score.

    Both tables have an id and an array of numbers. Every usable vector is coded and is a candidate for
    every query of the same length but the one with its own id. ``confidence`` is the half width of the
    bounds in standard deviations of the estimate: a true neighbour is missed only where its estimate is
    off by more. Scores are the inner products of the original components in double precision; fewer
    than k candidates give fewer rows; an empty table gives none. Vectors with an equal id are ranked
    each. Other columns are ignored.
    """
    base, asked = usable(vectors, id_column, vector_column), usable(queries, id_column, vector_column)
    n_blocks = max(-(-base.count() // block_rows), 1)
    q_blocks = max(-(-asked.count() // block_rows), 1)
    codes = packed_blocks(base, n_blocks, True).withColumnRenamed("block", "code_block")
    query_rows = packed_blocks(asked, q_blocks, False).select("block", F.col("dims").alias("q_dims"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"))
    # Every block of codes goes to every block of queries: the stated queries against all rows, in blocks.
    every = codes.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
    pairs = every.join(query_rows, (every["block"] == query_rows["block"]) & (every["dims"] == query_rows["q_dims"]))
    pairs = pairs.select("dims", "ids", "vectors", "codes", "lengths", "own", "q_ids", "q_vectors")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                dims, raw = batch.column(0)[row].as_py(), [batch.column(c)[row].as_buffer() for c in range(1, 8)]
                ids, matrix = np.frombuffer(raw[0], "<i8"), np.frombuffer(raw[1]).reshape(-1, dims)
                packed = np.frombuffer(raw[2], np.uint8).reshape(len(ids), -1)
                lengths, own = np.frombuffer(raw[3], np.float32), np.frombuffer(raw[4], np.float32)
                q_ids, q = np.frombuffer(raw[5], "<i8"), np.frombuffer(raw[6]).reshape(-1, dims)
                asked_ids, near, score = block_search(q_ids, q, ids, matrix, packed, lengths, own, k, confidence)
                yield pa.RecordBatch.from_arrays([pa.array(asked_ids, pa.int64()), pa.array(near, pa.int64()), pa.array(score, pa.float64())],
                                                 names=["query_id", "vec_id", "score"])

    # A block of queries and one of codes are a task of their own.
    found = pairs.repartition(n_blocks * q_blocks, F.xxhash64("ids"), F.xxhash64("q_ids")).mapInArrow(run, OUT)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
