"""Byte-level BPE encoding and decoding by backtracking over longest matches.

A text is split into pieces; each distinct piece is encoded once per worker. Its bytes are mapped to
Latin-1 characters, an Aho-Corasick automaton over all tokens gives the longest token that starts at
each byte, and the encoder walks from match to match. Two neighbours are accepted when their own merge
gives back the same two tokens, which is remembered for each pair; else the next shorter token is
tried, and a position from which nothing fits is marked and left for good. No position is tried with
a token twice, so the time is linear in the bytes, and the ids are those of the merges in rank order.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .pieces import PieceTable
from .textblocks import blocks, ragged

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class ByteBpe:
    """Encoder and decoder for a file of ranks (base64 token and rank on each line)."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.automaton = ahocorasick.Automaton()
        for token, rank in self.ranks.items():
            self.automaton.add_word(token.decode("latin-1"), (len(token), rank))
        self.automaton.make_automaton()
        self.shorter: dict[int, int | None] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        lengths = np.zeros(max(self.tokens, default=-1) + 1, np.int64)
        for rank, token in self.tokens.items():
            lengths[rank] = len(token)
        self.lengths = lengths
        self.offsets = np.cumsum(lengths) - lengths
        self.bytes = np.frombuffer(b"".join(self.tokens[r] for r in sorted(self.tokens)), np.uint8)

    def merged(self, text: bytes) -> list[int]:
        """Ids by merging, again and again, the neighbours of lowest rank: the definition."""
        parts = [text[i: i + 1] for i in range(len(text))]
        while len(parts) > 1:
            ranks = [self.ranks.get(a + b, 1 << 60) for a, b in zip(parts, parts[1:])]
            least = min(ranks)
            if least == 1 << 60:
                break
            at = ranks.index(least)
            parts[at: at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges keep the border between two tokens that stand side by side."""
        key = (left, right)
        fits = self.fits.get(key)
        if fits is None:
            if len(self.fits) > 1_000_000:
                self.fits.clear()
            fits = self.fits[key] = self.merged(self.tokens[left] + self.tokens[right]) == [left, right]
        return fits

    def prefix(self, token: int) -> int | None:
        """The longest other token with which this one begins."""
        if token not in self.shorter:
            text = self.tokens[token]
            found = (self.ranks.get(text[:n]) for n in range(len(text) - 1, 0, -1))
            self.shorter[token] = next((r for r in found if r is not None), None)
        return self.shorter[token]

    def piece(self, text: bytes) -> list[int]:
        """Ids of one piece."""
        if text in self.ranks:
            return [self.ranks[text]]
        size = len(text)
        longest, width = [0] * size, [0] * size
        for end, (length, rank) in self.automaton.iter(text.decode("latin-1")):
            start = end - length + 1
            if length > width[start]:
                width[start], longest[start] = length, rank
        dead = bytearray(size + 1)
        out: list[int] = []
        at, token = 0, longest[0] if size else None
        while at < size:
            end = at + len(self.tokens[token])
            if not dead[end] and (not out or self.compatible(out[-1], token)):
                out.append(token)
                at = end
                token = longest[at] if at < size else None
                continue
            shorter = self.prefix(token)
            if shorter is not None:
                token = shorter
                continue
            dead[at] = 1
            token = out.pop()
            at -= len(self.tokens[token])
        return out

    def encode_pieces(self, pieces: list[str]) -> list[list[int]]:
        return [self.piece(p.encode()) for p in pieces]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the tokens, one after the other."""
        return self.bytes[ragged(self.offsets[ids], self.lengths[ids])]


@cache
def encoder(path: str) -> tuple[ByteBpe, PieceTable]:
    """One encoder for each worker process and file."""
    bpe = ByteBpe(path)
    return bpe, PieceTable(bpe.encode_pieces)


def encode_documents(docs: DataFrame, ranks_path: str, id_column: str = "doc_id",
                     text_column: str = "text", keep_ids: bool = False, also: tuple[str, ...] = ()) -> DataFrame:
    """One row for each row of ``docs``: id, n_tokens and digests of the ids and of the decoded bytes.

    ``ids_sha256`` is over the ids as little-endian unsigned 32-bit integers, ``decoded_sha256`` over
    the bytes that decoding the ids gives back. ``keep_ids`` adds the ids themselves, ``also`` names columns that come along. ``ranks_path``
    must exist on every executor. A null text counts as empty: no ids, digests of nothing. Repeated
    rows are encoded each; a null id stays null; other columns are ignored.
    """
    schema = SCHEMA.replace("doc_id long", f"`{id_column}` {docs.schema[id_column].dataType.simpleString()}")
    schema += ", ids array<int>" if keep_ids else ""
    schema += "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in also)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, table = encoder(ranks_path)
        for batch in batches:
            for row, data, offsets in blocks(batch.column(1)):
                ids, bounds = table.encoded(data, offsets)
                decoded = bpe.decode(ids)
                ends = np.concatenate([[0], np.cumsum(bpe.lengths[ids])])[bounds]
                raw, count = ids.astype("<u4"), len(offsets) - 1
                columns = [
                    batch.column(0).slice(row, count),
                    pa.array(np.diff(bounds), pa.int64()),
                    pa.array([hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(bounds, bounds[1:])]),
                    pa.array([hashlib.sha256(decoded[a:b]).hexdigest() for a, b in zip(ends, ends[1:])]),
                ]
                names = [id_column, "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                columns += [batch.column(k).slice(row, count) for k in range(2, 2 + len(also))]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, *also])

    return docs.select(id_column, text_column, *also).mapInArrow(run, schema)
