"""Token ids in files of 64-bit words: Simple-8b with escapes and block offsets.

A word holds a selector in its top four bits and as many ids as the selector says in the other sixty.
Ids are coded in blocks of ``BLOCK_IDS``; each block starts on a word of its own, so that all blocks of
a file are coded and decoded in step with array operations, and any block can be read alone. An id of
sixty bits or more is an escape: its word is all ones and the id stands in a list beside the words.

File, all little-endian: magic ``S8BTOK01``; seven unsigned 64-bit counts (ids in a block, documents,
ids, blocks, words, escapes, 1 if the documents have null ids); document ids (int64); null marks (one
byte each, only with nulls); the end of each document in ids; the end of each block in words; the end
of each block in escapes; the words; the escapes.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ..session import work_dir
from .pieces import PieceTable
from .textblocks import blocks

MAGIC = b"S8BTOK01"
BLOCK_IDS = 256
BLOCKS_AT_ONCE = 256
# Tasks that read files back, at most; with more files each reads several.
READERS = 20_000
# Fixed values of the code: ids in a word and bits of each, by selector.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
PAYLOAD = np.uint64((1 << 60) - 1)
SMALL_WIDTHS = np.repeat(np.arange(17, dtype=np.uint8), [1, *(1 << k for k in range(16))])


def widths(ids: np.ndarray) -> np.ndarray:
    """Bits that each id needs."""
    if len(ids) and ids.max() < 1 << 16:
        return SMALL_WIDTHS[ids]
    out, rest = np.zeros(len(ids), np.uint8), ids.copy()
    for step in (32, 16, 8, 4, 2, 1):
        large = rest >= np.uint64(1 << step)
        out[large] += step
        rest[large] >>= np.uint64(step)
    return out + (rest > 0)


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words, end of each block in words, escapes, end of each block in escapes)."""
    ids = np.asarray(ids, np.uint64)
    span = BLOCKS_AT_ONCE * BLOCK_IDS
    some = [pack_some(ids[k: k + span]) for k in range(0, max(len(ids), 1), span)]
    words, word_ends, escapes, escape_ends = zip(*some)
    joined = []
    for items, ends in ((words, word_ends), (escapes, escape_ends)):
        sizes = np.array(list(map(len, items)))
        before = np.cumsum(sizes) - sizes
        joined += [np.concatenate(items), np.concatenate([e + b for e, b in zip(ends, before)])]
    return tuple(joined)


def pack_some(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``pack`` for as many blocks as fit a processor's cache."""
    count = -(-len(ids) // BLOCK_IDS)
    reach = BLOCK_IDS + int(COUNTS[0])
    cells = np.zeros(count * BLOCK_IDS + int(COUNTS[0]), np.uint64)
    cells[: len(ids)] = ids
    escaped = np.flatnonzero(cells >= PAYLOAD)
    escapes = cells[escaped]
    escape_ends = np.cumsum(np.bincount(escaped // BLOCK_IDS, minlength=count))
    cells[escaped] = PAYLOAD
    # The selector with the most ids that fit, at every position: what is past a block's end counts as zeros.
    need = np.zeros((count, reach), np.uint8)
    need[:, :BLOCK_IDS] = widths(cells[: count * BLOCK_IDS]).reshape(count, BLOCK_IDS)
    best = np.full((count, BLOCK_IDS), 15, np.uint8)
    most, covered = need, 1
    for selector in range(14, -1, -1):
        while covered < COUNTS[selector]:
            step = min(covered, int(COUNTS[selector]) - covered)
            most[:, : reach - step] = np.maximum(most[:, : reach - step], most[:, step:])
            covered += step
        fits = most[:, :BLOCK_IDS] <= BITS[selector]
        if not fits.any():
            break  # more ids of fewer bits cannot fit either
        best[fits] = selector
    # All blocks walk from word to word in step.
    sizes = np.full(count, BLOCK_IDS)
    if count:
        sizes[-1] = len(ids) - (count - 1) * BLOCK_IDS
    active, at, lanes, starts, selectors = np.arange(count), np.zeros(count, np.int64), [], [], []
    while len(active):
        chosen = best[active, at[active]]
        lanes.append(active)
        starts.append(at[active])
        selectors.append(chosen)
        at[active] += COUNTS[chosen]
        active = active[at[active] < sizes[active]]
    if not count:
        nothing = np.zeros(0, np.uint64)
        return nothing, np.zeros(0, np.int64), nothing, np.zeros(0, np.int64)
    lane, start, selector = map(np.concatenate, (lanes, starts, selectors))
    order = np.argsort(lane, kind="stable")
    lane, start, selector = lane[order], start[order], selector[order]
    words = selector.astype(np.uint64) << np.uint64(60)
    origin, block_end = lane * BLOCK_IDS + start, (lane + 1) * BLOCK_IDS
    for s in np.unique(selector):
        if BITS[s]:
            own = np.flatnonzero(selector == s)
            total = words[own]
            for k in range(COUNTS[s]):
                inside = origin[own] + k < block_end[own]
                total |= (cells[origin[own] + k] * inside) << np.uint64(k * BITS[s])
            words[own] = total
    return words, np.cumsum(np.bincount(lane, minlength=count)), escapes, escape_ends


def unpack(words: np.ndarray, word_ends: np.ndarray, escapes: np.ndarray, n_ids: int) -> np.ndarray:
    """The ids of consecutive blocks; ``n_ids`` of them, all blocks but the last one full."""
    count = len(word_ends)
    reach = BLOCK_IDS + int(COUNTS[0])
    grid = np.zeros(count * reach, np.uint64)
    if not count:
        return grid
    selector = (words >> np.uint64(60)).astype(np.int64)
    sizes = COUNTS[selector]
    before = np.cumsum(sizes) - sizes
    firsts = np.concatenate([[0], word_ends[:-1]])
    lane = np.repeat(np.arange(count), np.diff(np.concatenate([[0], word_ends])))
    at = before - before[firsts][lane] + lane * reach
    payload = words & PAYLOAD
    for s in np.unique(selector):
        if BITS[s]:
            own = np.flatnonzero(selector == s)
            mask = np.uint64((1 << int(BITS[s])) - 1)
            for k in range(COUNTS[s]):
                grid[at[own] + k] = (payload[own] >> np.uint64(k * BITS[s])) & mask
    out = grid.reshape(count, reach)[:, :BLOCK_IDS].ravel()[:n_ids]
    if len(escapes):
        out[out == PAYLOAD] = escapes
    return out


def to_bytes(doc_ids: list, ends: np.ndarray, ids: np.ndarray) -> bytes:
    """A file of documents (int ids or None) whose token ids end at ``ends``."""
    words, word_ends, escapes, escape_ends = pack(ids)
    nulls = np.array([d is None for d in doc_ids], np.uint8)
    head = [BLOCK_IDS, len(doc_ids), len(ids), len(word_ends), len(words), len(escapes), int(nulls.any())]
    parts = [np.array(head, "<u8"), np.array([d or 0 for d in doc_ids], "<i8")]
    parts += [nulls] * int(nulls.any())
    parts += [ends.astype("<u8"), word_ends.astype("<u8"), escape_ends.astype("<u8"), words.astype("<u8"), escapes.astype("<u8")]
    return MAGIC + b"".join(p.tobytes() for p in parts)


def from_bytes(raw: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """(document ids, end of each document in ids, ids) of a file."""
    if raw[:8] != MAGIC:
        raise ValueError("not a file of packed token ids")
    block, docs, n_ids, n_blocks, n_words, n_escapes, with_nulls = map(int, np.frombuffer(raw, "<u8", 7, 8))
    if block != BLOCK_IDS:
        raise ValueError(f"blocks of {block} ids; this reader takes {BLOCK_IDS}")
    at = 64

    def take(kind: str, n: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(raw, kind, n, at)
        at += out.nbytes
        return out

    doc_ids = take("<i8", docs).tolist()
    if with_nulls:
        doc_ids = [None if null else d for d, null in zip(doc_ids, take("u1", docs))]
    ends, word_ends = take("<u8", docs).astype(np.int64), take("<u8", n_blocks).astype(np.int64)
    take("<u8", n_blocks)
    words = take("<u8", n_words)
    return doc_ids, ends, unpack(words, word_ends, take("<u8", n_escapes), n_ids)


def byte_alphabet() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: printable bytes are their own."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(0x100 + k) for k, b in enumerate(rest)}


@cache
def piece_table(path: str) -> PieceTable:
    """Encodes pieces with the model of a tokenizer file; one for each worker process.

    The added tokens of the file are ids of their own wherever a text holds them, as in the library.
    """
    tokenizer = Tokenizer.from_file(path)
    model, letters = tokenizer.model, byte_alphabet()
    added = {t.content: id_ for id_, t in tokenizer.get_added_tokens_decoder().items()}
    for t in tokenizer.get_added_tokens_decoder().values():
        if t.lstrip or t.rstrip or t.single_word or t.normalized:
            raise ValueError(f"added token {t.content!r} is matched by more than its characters")

    def encode(pieces: list[str]) -> list[list[int]]:
        return [[added[p]] if p in added else [t.id for t in model.tokenize(p.encode().decode("latin-1").translate(letters))]
                for p in pieces]

    return PieceTable(encode, whole=tuple(added))


def store_of(folder: str):
    """(file system, path) of a folder given as a path or as the address of any store Arrow knows."""
    return fs.FileSystem.from_uri(folder) if ":/" in folder else (fs.LocalFileSystem(), folder)


def write_tokens(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 0, file_ids: int = 4_000_000) -> DataFrame:
    """Encode all texts and write them to ``folder`` in ascending doc_id order; returns the list of files.

    Only files on the returned list count: a task that is run again writes new files under new names.
    Order over the list is (part, number). A file is closed at the first document that brings it to
    ``file_ids`` ids, which bounds the memory of a task to that and one document. A null text counts as
    empty and has the end id only; null ids come first; rows with the same id stand side by side, ordered
    by text; other columns are ignored. An empty table gives an empty list.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, part, number = piece_table(tokenizer_path), TaskContext.get().partitionId(), 0
        store, path = store_of(folder)
        doc_ids, lists, total = [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal doc_ids, lists, total, number
            name = f"tokens-{part:06d}-{number:04d}-{uuid.uuid4().hex[:8]}.s8b"
            ends = np.cumsum(list(map(len, lists)))
            raw = to_bytes(doc_ids, ends, np.concatenate(lists))
            with store.open_output_stream(f"{path}/{name}") as out:
                out.write(raw)
            row = {"part": [part], "number": [number], "name": [name], "n_docs": [len(doc_ids)], "n_ids": [total], "n_bytes": [len(raw)]}
            doc_ids, lists, total, number = [], [], 0, number + 1
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            keys = batch.column(0).to_pylist()
            for row, data, offsets in blocks(batch.column(1)):
                ids, bounds = table.encoded(data, offsets)
                for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    doc_ids.append(keys[row + k])
                    lists.append(np.append(ids[a:b], np.uint32(end_id)))
                    total += int(b - a) + 1
                    if total >= file_ids:
                        yield close()
        if lists:
            yield close()

    store, path = store_of(folder)
    store.create_dir(path, recursive=True)
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(run, "part long, number long, name string, n_docs long, n_ids long, n_bytes long")


def read_tokens(files: DataFrame, folder: str, per_document: Callable[[np.ndarray], dict] | None = None,
                columns: str = "ids array<long>") -> DataFrame:
    """One row for each document of the listed files: doc_id, start, n_tokens and what is asked for.

    ``start`` counts the ids of all documents before it. ``per_document`` turns the ids of a document
    into the values of ``columns``; by default it gives the ids. The list of files is counted at once.
    """
    names = [c.strip().split()[0] for c in columns.split(",")]
    per_document = per_document or (lambda ids: {"ids": ids.tolist()})
    # One row for each file of millions of ids: the window is over the list of files only.
    order = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    listed = files.select("name", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).alias("start"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = store_of(folder)
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with store.open_input_stream(f"{path}/{name}") as source:
                    doc_ids, ends, ids = from_bytes(source.read())
                begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                values = [per_document(ids[a:b]) for a, b in zip(begins, ends)]
                out = {"doc_id": pa.array(doc_ids, pa.int64()), "start": begins + start, "n_tokens": ends - begins}
                out |= {n: [v[n] for v in values] for n in names}
                yield pa.RecordBatch.from_pydict(out)

    # After the window all files are in one partition: they are dealt out in turn, as many tasks as files (several
    # files to a task beyond READERS). A number that is given is not merged again, however small the list.
    tasks = min(max(files.count(), 1), READERS)
    return listed.repartition(tasks).mapInArrow(run, f"doc_id long, start long, n_tokens long, {columns}")


def token_report(spark: SparkSession, docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Write all documents as token files, read the files back: position, length and checksum of each.

    ``ids_crc32`` is the unsigned crc32 of the document's ids as little-endian unsigned 32-bit integers.
    """
    folder = work_dir(spark, "tokens")
    files_path = work_dir(spark, "token-files")
    write_tokens(docs, folder, tokenizer_path).write.parquet(files_path)

    def crc(ids: np.ndarray) -> dict:
        return {"ids_crc32": zlib.crc32(ids.astype("<u4").tobytes())}

    return read_tokens(spark.read.parquet(files_path), folder, crc, "ids_crc32 long")
