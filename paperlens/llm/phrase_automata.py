"""Substring deduplication with automata of recurring phrases.

A window is ``WINDOW`` consecutive words. Each window owns one phrase of ``PHRASE`` words, that of least
hash, so equal windows own equal phrases. Phrases that recur in the corpus are confirmed by counting;
the first document that holds one is its origin. Origins are dealt into shards; the phrases of a shard
are compiled into one Aho-Corasick automaton over word numbers, and every document with a recurring
phrase streams through the automata of its shards, which locate each occurrence. A window at a located
phrase that an origin holds earlier is removed at once; what no origin holds is compared over all shards.

Copies of a whole document are set aside first: all their windows start earlier in the first copy.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import heavy_keys
from ..session import materialize, remove
from .textblocks import blocks, gram_hashes, word_hashes

WINDOW = 20
PHRASE = 8
# A shard has about so many origins, and a part of it so many documents and words that stream.
SHARD_DOCUMENTS, SHARD_WORDS = 1000, 1_000_000
FIRST = -(1 << 63)
NOTHING = hashlib.sha256(b"").hexdigest()


def owners(words: np.ndarray) -> np.ndarray:
    """The position of the phrase that each window owns: the leftmost of least hash."""
    phrases = gram_hashes(words, PHRASE)
    span = WINDOW - PHRASE + 1
    if len(phrases) < span:
        return np.zeros(0, np.int64)
    return np.lib.stride_tricks.sliding_window_view(phrases, span).argmin(1) + np.arange(len(phrases) - span + 1)


def digest(words: np.ndarray) -> np.int64:
    return np.int64(np.uint64(xxhash.xxh3_64_intdigest(words.tobytes())))


def described(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, node (a digest of the words), whole_sha256, and the owned phrases with positions."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in blocks(batch.column(1)):
                words, bounds = word_hashes(data, offsets)
                raw, size, node, whole, phrases, positions = data.tobytes(), [], [], [], [], []
                for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    own = words[a:b]
                    at = np.unique(owners(own))
                    size.append(int(b - a))
                    node.append(digest(own))
                    whole.append(hashlib.sha256(b" ".join(raw[offsets[k]: offsets[k + 1]].split())).hexdigest())
                    phrases.append(gram_hashes(own, PHRASE)[at].view(np.int64))
                    positions.append(at.astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(row, len(size)), pa.array(size, pa.int64()), pa.array(node, pa.int64()), pa.array(whole, pa.string()),
                    pa.array(phrases, pa.list_(pa.int64())), pa.array(positions, pa.list_(pa.int32())),
                ], names=["doc_id", "n_words", "node", "whole_sha256", "phrases", "positions"])

    fields = f"doc_id {kind}, n_words long, node long, whole_sha256 string, phrases array<long>, positions array<int>"
    return docs.select("doc_id", "text").mapInArrow(run, fields)


def routes(firsts: DataFrame, shards: int, hot: list[int]) -> DataFrame:
    """shard, node, doc, at: the shards of each document, and the positions of the phrases it is the origin of.

    Rows of ``hot`` phrases, a few that very many documents hold, stay where they are and meet their origins there.
    """
    found = firsts.select("node", "doc", F.explode(F.arrays_zip("phrases", "positions")).alias("p"))
    found = found.select("node", "doc", F.col("p.phrases").alias("phrase"), F.col("p.positions").alias("position"))
    origins = found.groupBy("phrase").agg(F.count("*").alias("times"), F.min("doc").alias("origin")).filter("times > 1").drop("times")
    if hot:
        apart = F.col("phrase").isin(hot)
        met = found.filter(~apart).join(origins.filter(~apart), "phrase").unionByName(
            found.filter(apart).join(F.broadcast(origins.filter(apart)), "phrase"))
    else:
        met = found.join(origins, "phrase")
    shard = F.pmod(F.xxhash64("origin"), F.lit(shards)).cast("int")
    own = F.when(F.col("origin") == F.col("doc"), F.col("position"))
    return met.groupBy(shard.alias("shard"), "node", "doc").agg(F.sort_array(F.collect_set(own)).alias("at"))


def located(parts: DataFrame) -> DataFrame:
    """node, doc, removed, open, hashes: decided and undecided windows of each document of a part of a shard.

    A part holds all origins of its shard and some of the documents (``streamed``).
    """

    def run(part: pd.DataFrame) -> pd.DataFrame:
        data = pa.array(part.text, pa.string())
        all_words, all_bounds = [], [0]
        for _, raw, offsets in blocks(data):
            words, bounds = word_hashes(raw, offsets)
            all_words.append(words)
            all_bounds.extend((bounds[1:] + all_bounds[-1]).tolist())
        words = np.concatenate(all_words)
        numbers = np.unique(words, return_inverse=True)[1]
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        docs, nodes = part["doc"].to_numpy(), part.node.to_numpy()
        held, held_doc, held_node, held_at = [], [], [], []
        for k, at in enumerate(part["at"]):
            a, b = all_bounds[k], all_bounds[k + 1]
            for p in at:
                automaton.add_word(tuple(numbers[a + p: a + p + PHRASE].tolist()), int(docs[k]))
            if len(at):
                windows = gram_hashes(words[a:b], WINDOW)
                held.append(windows)
                held_doc.append(np.full(len(windows), docs[k]))
                held_node.append(np.full(len(windows), nodes[k]))
                held_at.append(np.arange(len(windows)))
        if not len(automaton):
            return pd.DataFrame({"node": [], "doc": [], "removed": [], "open": [], "hashes": []})
        automaton.make_automaton()
        # The earliest place of each window among the origins.
        held, held_doc, held_node, held_at = map(np.concatenate, (held, held_doc, held_node, held_at))
        order = np.lexsort((held_at, held_node, held_doc, held))
        order = order[np.concatenate([[True], held[order][1:] != held[order][:-1]])]
        held, held_doc, held_node, held_at = held[order], held_doc[order], held_node[order], held_at[order]
        out = []
        for k in np.flatnonzero(part.streamed.to_numpy(bool)):
            a, b = all_bounds[k], all_bounds[k + 1]
            own = words[a:b]
            origin_at = np.full(len(own), FIRST)
            hit = np.zeros(len(own), bool)
            for end, origin in automaton.iter(tuple(numbers[a:b].tolist())):
                hit[end - PHRASE + 1], origin_at[end - PHRASE + 1] = True, origin
            owner = owners(own)
            starts = np.flatnonzero(hit[owner])
            windows = gram_hashes(own, WINDOW)[starts]
            near = np.minimum(np.searchsorted(held, windows), len(held) - 1)
            same = held[near] == windows
            before = (held_doc[near] < docs[k]) | ((held_doc[near] == docs[k]) & (
                (held_node[near] < nodes[k]) | ((held_node[near] == nodes[k]) & (held_at[near] < starts))))
            gone = same & before
            # Of its own phrases no other document is earlier, and among equal windows here the first stays;
            # documents that share an id are told apart over all shards.
            mine = same & (held_doc[near] == docs[k]) & (held_node[near] == nodes[k]) & (origin_at[owner[starts]] == docs[k])
            left = ~gone & ~mine
            out.append((nodes[k], docs[k], starts[gone].astype(np.int32), starts[left].astype(np.int32), windows[left].view(np.int64)))
        return pd.DataFrame(out, columns=["node", "doc", "removed", "open", "hashes"])

    return parts.groupBy("shard", "part").applyInPandas(run, "node long, doc long, removed array<int>, open array<int>, hashes array<long>")


def cut(rows: DataFrame) -> DataFrame:
    """node, n_removed, kept_sha256 from node, text and the starts of the removed windows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, kept = [], []
            for text, starts in zip(batch.column(1), batch.column(2)):
                words = (text.as_py() or "").encode().split()
                edges = np.zeros(len(words) + 1, np.int64)
                at = np.unique(starts.values.to_numpy())
                np.add.at(edges, at, 1)
                np.add.at(edges, at + WINDOW, -1)
                covered = np.cumsum(edges[:-1]) > 0
                removed.append(int(covered.sum()))
                kept.append(hashlib.sha256(b" ".join(w for w, c in zip(words, covered.tolist()) if not c)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                                             names=["node", "n_removed", "kept_sha256"])

    return rows.select("node", "text", "starts").mapInArrow(run, "node long, n_removed long, kept_sha256 string")


def order_key(doc_id: Column) -> Column:
    """Null ids come before all others."""
    return F.coalesce(doc_id.cast("long"), F.lit(FIRST))


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 for every document.

    Words are runs without the six ASCII spaces. A word is removed when a window of 20 words over it also
    starts earlier: in a document of smaller doc_id, or earlier in the same one. Null ids count as the
    smallest; rows that share an id are ordered by a digest of their words, and rows that are equal in
    id and words have equal results, those of one of them. Fewer than 20 words, or a null text, lose
    nothing. Other columns are ignored; an empty table gives no rows. Windows are compared as 64-bit hashes.
    """
    docs = docs.select("doc_id", "text")
    every = materialize(described(docs), "phrases")
    keyed = every.withColumn("doc", order_key(F.col("doc_id")))
    classes = keyed.filter(F.col("n_words") >= WINDOW).groupBy("node").agg(
        F.min("doc").alias("doc"), F.max("n_words").alias("n_words"))
    firsts = keyed.filter(F.col("n_words") >= WINDOW).join(classes, ["node", "doc"], "left_semi")
    firsts = firsts.select("node", "doc", "phrases", "positions").dropDuplicates(["node"])
    size = classes.agg(F.count("*").alias("documents"), F.coalesce(F.sum("n_words"), F.lit(0)).alias("words")).first()
    shards = max(1, -(-size["documents"] // SHARD_DOCUMENTS), -(-size["words"] // SHARD_WORDS))
    hot = heavy_keys(every.select(F.explode("phrases").alias("phrase")), "phrase")
    routed = materialize(routes(firsts, shards, hot), "phrase-routes")

    # The texts that stream: those of the first copies that have a recurring phrase.
    wanted = routed.select("node", "doc").distinct()
    # Each is moved once: rows of one id lie together when the ones that are equal in their words are made one.
    one_blank = F.trim(F.regexp_replace("text", "[ \\t-\\r]+", " "))
    texts = docs.withColumn("doc", order_key(F.col("doc_id"))).join(wanted, "doc").withColumn("words", F.xxhash64(one_blank))
    texts = texts.dropDuplicates(["doc", "node", "words"]).select("node", "text")
    texts = materialize(same_words(texts), "phrase-texts")

    # A shard with many documents has many parts; its origins go to each of them.
    load = routed.join(classes.select("node", "n_words"), "node").groupBy("shard").agg(F.ceil(F.greatest(
        F.count("*") / (2 * SHARD_DOCUMENTS), F.sum("n_words") / (2 * SHARD_WORDS))).cast("int").alias("parts"))
    rows = routed.join(load, "shard").withColumn("home", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    part = F.when(F.size("at") > 0, F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array("home"))
    rows = rows.withColumn("part", F.explode(part)).withColumn("streamed", F.col("part") == F.col("home"))
    rows = rows.select("shard", "part", "node", "doc", "at", "streamed").join(texts, "node")
    found = materialize(located(rows), "phrase-windows")
    remove(routed)

    undecided = found.select("node", "doc", F.explode(F.arrays_zip("open", "hashes")).alias("w"))
    undecided = undecided.select("node", "doc", F.col("w.open").alias("start"), F.col("w.hashes").alias("hash"))
    earliest = undecided.groupBy("hash").agg(F.count("*").alias("times"), F.min(F.struct("doc", "node", "start")).alias("first")).filter("times > 1")
    later = undecided.join(earliest.drop("times"), "hash").filter(F.struct("doc", "node", "start") != F.col("first"))
    starts = found.select("node", F.col("removed").alias("starts")).unionByName(later.select("node", F.array("start").alias("starts")))
    starts = starts.filter(F.size("starts") > 0).groupBy("node").agg(F.flatten(F.collect_list("starts")).alias("starts"))
    results = cut(starts.join(texts, "node"))

    out = keyed.select("doc_id", "doc", "n_words", "node", "whole_sha256").join(classes.select("node", F.col("doc").alias("first")), "node", "left")
    out = out.join(results, "node", "left")
    copy = (F.col("n_words") >= WINDOW) & (F.col("doc") > F.col("first"))
    short = F.col("n_words") < WINDOW
    return out.select(
        "doc_id", "n_words",
        F.when(copy, F.col("n_words")).when(short, F.lit(0)).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(NOTHING)).when(short, F.col("whole_sha256")).otherwise(F.coalesce("kept_sha256", "whole_sha256")).alias("kept_sha256"))


def same_words(rows: DataFrame) -> DataFrame:
    """The texts, among those found by document id, that have the words of their node."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, keep = batch.column(0).to_pylist(), []
            for row, data, offsets in blocks(batch.column(1)):
                words, bounds = word_hashes(data, offsets)
                keep += [digest(words[a:b]) == nodes[row + k] for k, (a, b) in enumerate(zip(bounds, bounds[1:]))]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return rows.mapInArrow(run, "node long, text string")
