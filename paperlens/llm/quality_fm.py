"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

A document is a sparse vector: its distinct words hashed into ``2 ** WORD_BITS`` places and scaled to
length one, and one place for each bin of a structure statistic or a metadata value. The score adds
a linear term and all pairwise interactions of low rank; with the sum-of-squares identity,
sum over pairs <v_i, v_j> x_i x_j = 1/2 sum over factors [(sum v x)^2 - sum (v x)^2], that is linear
in the number of places used.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .textblocks import blocks, row_of, span_hashes, word_hashes

WORD_BITS = 15
BINS = 12
# Upper ends of the bins of each statistic.
EDGES = {
    "symbols": [0.001, 0.003, 0.01, 0.03, 0.06, 0.1, 0.2, 0.4],
    "capitals": [0.01, 0.03, 0.05, 0.08, 0.15, 0.3, 0.6, 0.9],
    "digits": [0.001, 0.005, 0.01, 0.03, 0.06, 0.1, 0.2, 0.4],
    "exclamations": [0.001, 0.003, 0.01, 0.03, 0.06, 0.1, 0.2, 0.4],
    "stops": [0.001, 0.003, 0.006, 0.01, 0.015, 0.02, 0.03, 0.05],
    "letters": [0.4, 0.5, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85],
    "word_length": [2, 3, 3.5, 4, 4.5, 5, 6, 7, 8, 10],
    "words": [1, 5, 10, 20, 50, 100, 200, 500, 1000, 5000],
    "distinct_words": [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9],
    "words_per_line": [1, 2, 4, 8, 16, 32, 64, 128, 512],
    "repeated_lines": [0, 0.05, 0.1, 0.2, 0.3, 0.5, 0.7, 0.9],
}
CLASSES = np.zeros(256, np.uint8)
for _k, _chars in enumerate((b"#*$%&|<>", bytes(range(65, 91)), b"0123456789", b"!", b".,;:?", bytes(range(97, 123))), 1):
    CLASSES[list(_chars)] = _k
STATISTICS_AT = 1 << WORD_BITS
N_CHARS_BINS = 40


def size_of(metadata: int) -> int:
    return STATISTICS_AT + BINS * len(EDGES) + N_CHARS_BINS * metadata


def statistics(data: np.ndarray, offsets: np.ndarray, words: np.ndarray, distinct: np.ndarray) -> dict[str, np.ndarray]:
    """Structure statistics of each row."""
    rows = len(offsets) - 1
    kinds = CLASSES[data]
    counts = np.zeros((rows, 7))
    for kind in range(1, 7):
        at = np.flatnonzero(kinds == kind)
        counts[:, kind] = np.diff(np.searchsorted(at, offsets))
    size = np.maximum(np.diff(offsets), 1)
    # Lines: spans between line feeds that hold something.
    breaks = np.flatnonzero(data == 10)
    edges = np.unique(np.concatenate([offsets, breaks, breaks + 1]))
    starts, ends = edges[:-1], edges[1:]
    full = ~((ends - starts == 1) & (data[np.minimum(starts, max(len(data) - 1, 0))] == 10)) if len(data) else np.zeros(0, bool)
    starts, ends = starts[full], ends[full]
    owner = np.searchsorted(offsets, starts, "right") - 1
    hashes = span_hashes(data.astype(np.uint64) + np.uint64(1), starts, ends) if len(starts) else np.zeros(0, np.uint64)
    order = np.lexsort((hashes, owner))
    again = np.zeros(len(order), bool)
    again[1:] = (hashes[order][1:] == hashes[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    lines = np.bincount(owner, minlength=rows)
    repeats = np.bincount(owner[order][again], minlength=rows)
    alphabetic = counts[:, 2] + counts[:, 6]
    return {
        "symbols": counts[:, 1] / size, "capitals": counts[:, 2] / np.maximum(alphabetic, 1), "digits": counts[:, 3] / size,
        "exclamations": counts[:, 4] / size, "stops": counts[:, 5] / size, "letters": alphabetic / size,
        "word_length": size / np.maximum(words, 1), "words": words, "distinct_words": distinct / np.maximum(words, 1),
        "words_per_line": words / np.maximum(lines, 1), "repeated_lines": repeats / np.maximum(lines, 1),
    }


def values(row: np.ndarray, place: np.ndarray, rows: int) -> np.ndarray:
    """Value of every used place: words of a row have length one together, each bin has the value one."""
    word = place < STATISTICS_AT
    distinct = np.bincount(row[word], minlength=rows)
    return np.where(word, 1 / np.sqrt(np.maximum(distinct, 1))[row], 1.0)


def features(data: np.ndarray, offsets: np.ndarray, n_chars: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, value) of every used place, by row."""
    rows = len(offsets) - 1
    hashes, bounds = word_hashes(data, offsets, lower=True)
    owner = row_of(bounds)
    place = (hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    used = np.unique((owner << WORD_BITS) | place)
    word_row, word_place = used >> WORD_BITS, used & (STATISTICS_AT - 1)
    distinct = np.bincount(word_row, minlength=rows)
    value = values(word_row, word_place, rows)
    all_rows = np.arange(rows)
    parts = [(word_row, word_place, value)]
    for k, (name, stat) in enumerate(statistics(data, offsets, np.diff(bounds), distinct).items()):
        parts.append((all_rows, STATISTICS_AT + BINS * k + np.searchsorted(EDGES[name], stat), np.ones(rows)))
    if n_chars is not None:
        base = STATISTICS_AT + BINS * len(EDGES)
        known = ~np.isnan(n_chars)
        bins = np.clip(np.log2(np.maximum(np.where(known, n_chars, 0), 0) + 1).astype(np.int64) + 1, 1, N_CHARS_BINS - 1)
        parts.append((all_rows, base + np.where(known, bins, 0), np.ones(rows)))
    row, place, value = map(np.concatenate, zip(*parts))
    order = np.argsort(row, kind="stable")
    return row[order], place[order], value[order]


def batch_features(batch: pa.RecordBatch, text_column: str, metadata: bool):
    """(first row, rows, row, place, value) for blocks of a batch."""
    text = batch.column(batch.schema.get_field_index(text_column))
    chars = None
    if metadata:
        column = batch.column(batch.schema.get_field_index("n_chars"))
        chars = column.cast(pa.float64()).to_numpy(zero_copy_only=False)
    for first, data, offsets in blocks(text):
        count = len(offsets) - 1
        yield first, count, *features(data, offsets, None if chars is None else chars[first: first + count])


@dataclass
class Model:
    """Bias, linear weights and factors; ``metadata`` says whether ``n_chars`` is an input."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray
    metadata: bool

    def margins(self, rows: int, row: np.ndarray, place: np.ndarray, value: np.ndarray) -> np.ndarray:
        bounds = np.searchsorted(row, np.arange(rows))
        if not len(row):
            return np.full(rows, self.bias)
        linear = np.add.reduceat(self.weights[place] * value, bounds)
        terms = self.factors[place] * value[:, None]
        sums = np.add.reduceat(terms, bounds)
        squares = np.add.reduceat(terms * terms, bounds)
        return self.bias + linear + 0.5 * (sums * sums - squares).sum(1)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit_arrays(labels: np.ndarray, row: np.ndarray, place: np.ndarray, value: np.ndarray, metadata: bool,
               rank: int = 8, epochs: int = 6, rate: float = 0.1, batch: int = 64, decay: float = 1e-5) -> Model:
    """Fit by AdaGrad on the logistic loss; deterministic. No rows: a score of one half."""
    rng = np.random.default_rng(7)
    size = size_of(metadata)
    share = (labels.sum() + 1) / (len(labels) + 2)
    model = Model(float(np.log(share / (1 - share))), np.zeros(size), rng.normal(0, 0.01, (size, rank)), metadata)
    seen_w, seen_v, seen_b = np.full(size, 1e-6), np.full((size, rank), 1e-6), 1e-6
    bounds = np.searchsorted(row, np.arange(len(labels) + 1))
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for k in range(0, len(order), batch):
            chosen = order[k: k + batch]
            lengths = bounds[chosen + 1] - bounds[chosen]
            at = np.concatenate([np.arange(bounds[c], bounds[c + 1]) for c in chosen])
            own, p, x = np.repeat(np.arange(len(chosen)), lengths), place[at], value[at]
            terms = model.factors[p] * x[:, None]
            sums = np.add.reduceat(terms, np.cumsum(lengths) - lengths)
            linear = np.bincount(own, model.weights[p] * x, len(chosen))
            pairs = 0.5 * ((sums * sums).sum(1) - np.bincount(own, (terms * terms).sum(1), len(chosen)))
            error = sigmoid(model.bias + linear + pairs) - labels[chosen]
            used, at_used = np.unique(p, return_inverse=True)
            step_w = np.bincount(at_used, error[own] * x) + decay * model.weights[used]
            each_v = (error[own] * x)[:, None] * (sums[own] - terms)
            step_v = decay * model.factors[used]
            np.add.at(step_v, at_used, each_v)
            seen_w[used] += step_w**2
            seen_v[used] += step_v**2
            seen_b += error.sum() ** 2
            model.weights[used] -= rate * step_w / np.sqrt(seen_w[used])
            model.factors[used] -= rate * step_v / np.sqrt(seen_v[used])
            model.bias -= rate * error.sum() / np.sqrt(seen_b)
    return Model(model.bias, model.weights.astype(np.float32), model.factors.astype(np.float32), metadata)


def held_out(doc_id: Column) -> Column:
    """Rows kept from learning: the crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def label_sample(labels: DataFrame, label: str, fit_rows: int) -> DataFrame:
    """At most ``fit_rows`` labelled ids to learn from: those of least hash, one label for each id."""
    usable = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    one = usable.groupBy("doc_id").agg(F.min(label).alias("_label"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", fit_rows: int = 6000, metadata: bool = True) -> Model:
    """Learn from at most ``fit_rows`` labelled documents that are not held out.

    The sampled ids are at most ``fit_rows``, so they are broadcast; features are made in the tasks, and
    the places of at most ``fit_rows`` vectors, each no longer than the feature space, reach the driver.
    Their values follow from the number of words in a row.
    """
    sample = F.broadcast(label_sample(labels, label, fit_rows))
    columns = ["text", "n_chars"] if metadata else ["text"]
    rows = docs.select("doc_id", *columns).join(sample, "doc_id")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, count, row, place, _ in batch_features(batch, "text", metadata):
                ends = np.searchsorted(row, np.arange(count + 1))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, count), batch.column(batch.num_columns - 1).slice(first, count),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(place, pa.int32())),
                ], names=["doc_id", "label", "place"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    label_kind = labels.schema[label].dataType.simpleString()
    made = rows.mapInArrow(run, f"doc_id {kind}, label {label_kind}, place array<int>")
    # The place lists break ties, so that the sample does not depend on the order of the rows.
    found = made.orderBy(F.xxhash64("doc_id"), "doc_id", "place").limit(fit_rows).toArrow()
    places = found.column("place").combine_chunks()
    wanted = found.column("label").to_numpy().astype(float)
    lengths = np.diff(places.offsets.to_numpy()) if len(places) else np.zeros(0, np.int64)
    place = places.values.to_numpy() if len(places) else np.zeros(0, np.int32)
    row = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    return fit_arrays(wanted, row, place, values(row, place, len(lengths)), metadata)


def with_score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with a column ``score`` between 0 and 1; all rows and other columns stay as they are.

    A null text is scored as an empty one, a null ``n_chars`` as unknown. A column already called
    ``name`` is replaced.
    """
    rows = docs.drop(name)
    schema = StructType([*rows.schema.fields, StructField(name, DoubleType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for first, count, row, place, value in batch_features(batch, "text", model.metadata):
                out[first: first + count] = sigmoid(model.margins(count, row, place, value))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=[*batch.schema.names, name])

    return rows.mapInArrow(run, schema)


def quality_report(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from ``threshold`` on) for every document."""
    columns = ["doc_id", "text", "n_chars"] if model.metadata else ["doc_id", "text"]
    scored = with_score(docs.select(*columns), model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, with their columns as they are."""
    name = "_score"
    while name in docs.columns:
        name += "_"
    return with_score(docs, model, name).filter(F.col(name) >= threshold).drop(name)
