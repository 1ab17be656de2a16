"""Toxicity by maximum-scoring segments.

Each token has a log-odds between toxic and clean labelled texts, with an informative Dirichlet prior
from the counts of all documents. A token whose log-odds is significant gains it; a token that is more
frequent in clean texts loses its log-odds, and every other token a small loss. One linear scan of a
document finds all maximal scoring segments, and the extreme-value distribution of segment scores in
clean texts says how likely each is by chance. The segments of a document are joined to one p-value, and
that to a probability.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .quality_fm import held_out, label_sample
from .textblocks import BYTE_VALUES, LOWER, SPACE, blocks, row_of, span_hashes, word_bounds

BITS = 20
STEMS = (5,)
SIZE = 1 << BITS
PRIOR_TOKENS = 1000.0
# Tokens end at white space and at ASCII punctuation.
BREAKS = SPACE.copy()
BREAKS[[b for b in range(33, 127) if not chr(b).isalnum()]] = True


def token_places(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash places of each token: itself and its stems; index of each row's first token); A-Z count as a-z.

    A stem is the first ``STEMS`` bytes of a longer token: inflected forms share what their stem tells.
    """
    starts, ends, rows = word_bounds(data, offsets, BREAKS)
    values = BYTE_VALUES[LOWER[data]]
    cuts = [ends] + [np.where(ends - starts > n, starts + n, ends) for n in STEMS]
    hashes = np.array([span_hashes(values, starts, cut) for cut in cuts], np.uint64).reshape(len(cuts), len(starts))
    hashes[1:] ^= np.where(np.array(cuts[1:]) < ends, np.uint64(1 << 63 | 0x5BD1), np.uint64(0))
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64), rows


@dataclass
class Model:
    """Gains and losses of the places that have their own, loss of all others, and the extreme-value parameters."""

    places: np.ndarray
    scores: np.ndarray
    loss: float
    rate: float
    scale: float
    prior: float

    def table(self) -> np.ndarray:
        out = np.full(SIZE, -self.loss, np.float32)
        out[self.places] = self.scores
        return out


def segments(at: list[int], gains: list[float], losses: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first token, token after the last, score), in linear time.

    ``at`` and ``gains`` are the tokens with a gain, in order; ``losses`` is what the tokens between each and
    the one before lose together. A segment is maximal when no part of it, and no longer segment it lies in, scores higher.
    """
    found: list[list[float]] = []  # left, right, total before it, total after it, index of a lower start before it
    total = 0.0
    for position, gain, lost in zip(at, gains, losses):
        total -= lost
        left, before = position, total
        total += gain
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= before:
                j = found[j][4]
            if j < 0 or found[j][3] >= total:
                found.append([left, position + 1, before, total, j])
                break
            left, before = found[j][0], found[j][2]
            del found[j:]
    return [(int(a), int(b), after - before) for a, b, before, after, _ in found]


def log_odds(toxic: np.ndarray, clean: np.ndarray, all_counts: np.ndarray, totals: tuple[float, float, float]) -> np.ndarray:
    """Log-odds of each place between toxic and clean, with a prior of PRIOR_TOKENS spread as in all documents."""
    prior = PRIOR_TOKENS * (all_counts + 1) / (totals[2] + SIZE)
    a, b = toxic + prior, clean + prior
    return np.log(a / (totals[0] + PRIOR_TOKENS - a)) - np.log(b / (totals[1] + PRIOR_TOKENS - b))


def evidence(toxic: np.ndarray, clean: np.ndarray, share: float) -> np.ndarray:
    """Chernoff bound, in nats, against that many toxic occurrences when ``share`` of all are toxic by chance."""
    total = np.maximum(toxic + clean, 1)
    part = np.clip(toxic / total, 1e-12, 1 - 1e-12)
    divergence = part * np.log(part / share) + (1 - part) * np.log((1 - part) / (1 - share))
    return np.where(part > share, total * divergence, 0.0)


def decay_rate(scores: np.ndarray, shares: np.ndarray, loss: float) -> float:
    """The positive root of sum over tokens share * exp(rate * score) = 1 in clean texts."""
    rest = 1 - shares.sum()

    def excess(rate: float) -> float:
        return float(shares @ np.exp(rate * scores) + rest * np.exp(-rate * loss) - 1)

    low, high = 1e-6, 1.0
    while excess(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return low


def counted(rows: DataFrame, marked: np.ndarray | None) -> DataFrame:
    """place, toxic, clean, seen: documents with each place, added up within each task before the shuffle.

    A place counts once in a document, so that one long text cannot make a word toxic. ``rows`` has
    text and label; with ``marked`` only these places are counted, and a last one,
    ``SIZE``, takes the other tokens.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((3, SIZE + 1), np.int64)
        for batch in batches:
            labels = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
            for first, data, offsets in blocks(batch.column(0)):
                places, bounds = token_places(data, offsets)
                if marked is not None:
                    places = np.where(marked[places], places, SIZE)
                once = np.unique(row_of(bounds) * (SIZE + 1) + places)  # the rows repeat for each line of places
                places = once % (SIZE + 1)
                kind = labels[first: first + len(offsets) - 1][once // (SIZE + 1)]
                for k, own in enumerate((kind == 1, kind == 0, slice(None))):
                    np.add.at(counts[k], places[own], 1)
        used = np.flatnonzero(counts[2])
        yield pa.RecordBatch.from_arrays([pa.array(used), *[pa.array(c[used]) for c in counts]],
                                         names=["place", "toxic", "clean", "seen"])

    tasks = rows.mapInArrow(run, "place long, toxic long, clean long, seen long")
    return tasks.groupBy("place").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.sum("seen").alias("seen"))


def scanned(data: np.ndarray, offsets: np.ndarray, table: np.ndarray):
    """(row, tokens of the row, segments) for every row that holds a gain.

    A token gains by itself or by a stem, whichever gains more; without a gain it loses by itself alone.
    """
    places, bounds = token_places(data, offsets)
    best = table[places].max(axis=0)
    scores = np.where(best > 0, best, table[places[0]]).astype(np.float64)
    lost = np.cumsum(np.maximum(-scores, 0.0))
    hits = np.flatnonzero(scores > 0)
    owner = np.searchsorted(bounds, hits, "right") - 1
    for row in np.unique(owner):
        own = hits[owner == row] if len(hits) < 64 else hits[np.searchsorted(owner, row): np.searchsorted(owner, row, "right")]
        yield int(row), int(bounds[row + 1] - bounds[row]), segments(
            (own - bounds[row]).tolist(), scores[own].tolist(), np.diff(lost[own], prepend=lost[own[0]]).tolist())


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", fit_rows: int = 20_000, least: int = 3,
        loss: float = 0.05) -> Model:
    """Learn token scores and the extreme-value parameters.

    Labelled counts come from at most ``fit_rows`` documents that are not held out; the prior counts
    all documents. A place gains when ``least`` toxic documents have it and chance would give less than
    one such place among all that were tried; it loses its log-odds when ``least`` labelled documents have
    it and that is below ``-loss``. Counts have at most 2 ** BITS places, whatever the input.
    """
    sample = F.broadcast(label_sample(labels, label, fit_rows))
    labelled = docs.select("doc_id", "text").join(sample, "doc_id").select("text", "_label")
    found = counted(labelled, None).toArrow().to_pandas()
    toxic, clean = np.zeros(SIZE), np.zeros(SIZE)
    toxic[found.place], clean[found.place] = found.toxic, found.clean
    marked = toxic + clean >= least
    every = counted(docs.select("text", F.lit(None).cast("int").alias("_label")), marked).toArrow().to_pandas()
    seen = np.zeros(SIZE + 1)
    seen[every.place] = every.seen
    totals = (toxic.sum(), clean.sum(), seen.sum())
    odds = log_odds(toxic, clean, seen[:SIZE], totals)
    share = np.clip(totals[0] / max(totals[0] + totals[1], 1), 1e-6, 1 - 1e-6)
    tried = max(int((toxic > 0).sum()), 1)
    gain = (toxic >= least) & (odds > 0) & (evidence(toxic, clean, share) > np.log(tried))
    places = np.flatnonzero(gain | (marked & (odds < -loss)))
    smooth = (clean[places] + PRIOR_TOKENS * (seen[places] + 1) / (seen.sum() + SIZE)) / (clean.sum() + PRIOR_TOKENS)
    rate = decay_rate(odds[places], smooth, loss) if gain.any() else 1.0
    model = Model(places, odds[places], loss, rate, 0.0, 0.5)
    best = best_scores(labelled, model)
    # Gumbel location in clean texts by maximum likelihood: a text of n tokens has scale * n chances.
    chances = best.filter("_label = 0").select(F.count("*"), F.sum(F.col("tokens") * F.exp(-rate * F.col("best")))).first()
    known = best.agg(F.avg("_label"), F.count("*")).first()
    model.scale = (chances[0] or 1) / max(chances[1] or 1.0, 1e-9)
    model.prior = ((known[0] or 0.0) * known[1] + 1) / (known[1] + 2)
    return model


def best_scores(rows: DataFrame, model: Model) -> DataFrame:
    """_label, tokens and the highest segment score of each row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.table()
        for batch in batches:
            for first, data, offsets in blocks(batch.column(0)):
                count = len(offsets) - 1
                best = np.zeros(count)
                for row, _, found in scanned(data, offsets, table):
                    best[row] = max(s for _, _, s in found)
                tokens = np.diff(word_bounds(data, offsets, BREAKS)[2])
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(first, count), pa.array(tokens), pa.array(best)],
                                                 names=["_label", "tokens", "best"])

    kind = rows.schema["_label"].dataType.simpleString()
    return rows.mapInArrow(run, f"_label {kind}, tokens long, best double")


def chance(scores: list[float], tokens: int, model: Model) -> float:
    """Probability that a clean text of this length has segments this high.

    The r highest normalised scores add up to a sum whose tail is exp(-t) t^(r-1) / (r! (r-1)!); the best
    r of all is taken, and paid for by a factor of 2^r. Scores come in falling order, so that once the sum
    is not above r, where the tail says nothing, it never is again.
    """
    sums = np.cumsum(model.rate * np.sort(scores)[::-1] - np.log(max(model.scale * tokens, 1e-12)))
    r = np.arange(1, len(sums) + 1)
    sums, r = sums[sums > r], r[sums > r]
    product = np.cumsum(np.log(r) + np.log(np.maximum(r - 1, 1)))
    tails = -sums + (r - 1) * np.log(sums) - product
    # For small x the chance 1 - exp(-x) is x itself.
    chances = np.where(tails > -30, np.log(-np.expm1(-np.exp(np.maximum(tails, -30)))), tails)
    return float(np.exp(np.clip((chances + r * np.log(2.0)).min(initial=0.0), -690.0, 0.0)))


def probability(p: float, prior: float) -> float:
    """Posterior of a toxic text: the bound -e p ln p on the Bayes factor of a p-value."""
    against = -np.e * p * np.log(p) if p < 1 / np.e else 1.0 + np.e * p
    odds = prior / (1 - prior) / against
    return float(odds / (1 + odds))


def with_toxicity(docs: DataFrame, model: Model, passages: bool = True, alpha: float = 0.05) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and, if asked for, every significant passage.

    ``passages`` is array<struct<start, end, score, p>>: code points, end exclusive; a passage counts when
    its own p-value is below ``alpha``. A text without any scoring token, so also an empty or null one,
    has the p-value 1. All rows and other columns stay; columns of these names are replaced.
    """
    rows = docs.drop("score", "passages")
    added = "score double" + ", passages array<struct<start:long,end:long,score:double,p:double>>" * passages
    schema = StructType([*rows.schema.fields, *StructType.fromDDL(added).fields])
    text_at = rows.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.table()
        for batch in batches:
            out = np.full(batch.num_rows, probability(1.0, model.prior))
            lists: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for first, data, offsets in blocks(batch.column(text_at)):
                starts, ends, bounds = word_bounds(data, offsets, BREAKS) if passages else (None, None, None)
                for row, tokens, found in scanned(data, offsets, table):
                    out[first + row] = probability(chance([s for _, _, s in found], tokens, model), model.prior)
                    if passages:
                        text = data[offsets[row]: offsets[row + 1]]
                        heads = np.concatenate([[0], np.cumsum((text & 0xC0) != 0x80)])
                        for a, b, s in found:
                            p = -np.expm1(-model.scale * tokens * np.exp(-model.rate * s))
                            if p < alpha:
                                begin, end = starts[bounds[row] + a] - offsets[row], ends[bounds[row] + b - 1] - offsets[row]
                                lists[first + row].append({"start": int(heads[begin]), "end": int(heads[end]), "score": s, "p": float(p)})
            columns, names = [*batch.columns, pa.array(out)], [*batch.schema.names, "score"]
            if passages:
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("p", pa.float64())]))
                columns, names = [*columns, pa.array(lists, kind)], [*names, "passages"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, schema)


def toxicity_report(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from ``threshold`` on) and passages for every document."""
    scored = with_toxicity(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"), "passages")
