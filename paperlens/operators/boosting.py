"""Boosted trees for many settings at once: each setting is a task of its own, over all labelled rows.

Where features may be split follows from exact counts of their values. Rows are sorted, so that a fit does not
depend on how they lie, and stored as joint bins: features of few bins share a byte. Every setting's task is sent
these bytes and holds 45 more for a row; the driver sees only cuts, row counts of partitions and trees.

Trees grow level by level on sums of gradients per node and joint bin, and a node's larger child is what its
smaller one leaves. Gradients are rounded to multiples of a power of two, so that these sums are exact.
Settings that differ only in their number of trees share one fit, whose first trees are the smaller ensemble.
Scoring: rows of any table walk all trees of all models in one pass, and the sums at the end of each
ensemble are their scores.

Models are ``TreeModel``s: a row goes left where its feature is below the split, a missing one right.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import FEATURE_COLS
from ..functions.scores import sigmoid
from ..session import store
from .cumulative import running_sums, store_ranges
from .trees import TreeModel, flat_trees, leaf_weights

SEED = 42
BINS = 64
# Joint bins of features that share a histogram.
PACK_BINS = 128
# Rows that a fit works on at a time, and rows sent together.
FIT_BLOCK = 1 << 17
SENT_BLOCK = 1024

DEFAULT_TREES = {
    "n_estimators": 300, "max_depth": 6, "learning_rate": 0.05, "subsample": 0.8, "colsample_bytree": 0.8,
    "min_child_weight": 1, "gamma": 0.0, "reg_alpha": 0.0, "reg_lambda": 1.0,
}

TREES = """fit int, tree int, left_children array<int>, right_children array<int>, split_indices array<int>,
    split_conditions array<float>, base_weights array<float>, gains array<float>"""


@dataclass
class Rows:
    """Labelled rows at hand: features, labels, weights."""

    x: np.ndarray
    y: np.ndarray
    weight: np.ndarray


def bounded_rows(df: DataFrame, label: str, features: list[str], pos_weight: float, rows: int) -> Rows:
    """At most about ``rows`` rows, the same ones each time, on the driver: for trials, no fit of this package takes them."""
    spread = F.xxhash64(label, *features)
    size = df.count()
    if size > rows:
        share = int(rows / size * (1 << 30))
        df = df.filter(F.pmod(spread, F.lit(1 << 30)) < share)
    columns = [F.col(f).cast("double").alias(f) for f in features]
    pdf = df.select(*columns, F.col(label).cast("double").alias("_y")).toPandas()
    values = pdf.to_numpy(np.float64)
    values = values[np.lexsort(values.T[::-1])]
    y = values[:, -1]
    return Rows(values[:, :-1], y, np.where(y == 1, pos_weight, 1.0))


def cut_points(column: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Where a feature may be split: its values, or evenly filled bins where it has many."""
    values = np.unique(column[np.isfinite(column)])
    if len(values) > bins:
        values = np.unique(np.quantile(column[np.isfinite(column)], np.arange(1, bins) / bins, method="higher"))
    # The stored split is a float: rows are placed by what is stored.
    return np.unique(values.astype(np.float32))


def shrunk(gradient: np.ndarray, alpha: float) -> np.ndarray:
    return np.sign(gradient) * np.maximum(np.abs(gradient) - alpha, 0.0)


@dataclass
class Packs:
    """How rows become joint bins."""

    # By feature: where it may be split, and the bins its rows may be in.
    cuts: list[np.ndarray]
    held: list[np.ndarray]
    # Features that share a joint bin, and how many joint bins they have.
    packs: list[list[int]]
    widths: list[int]


def packs_of(cuts: list[np.ndarray], held: list[np.ndarray]) -> Packs:
    packs: list[list[int]] = []
    widths: list[int] = []
    for f in sorted(range(len(cuts)), key=lambda f: len(held[f])):
        if packs and widths[-1] * len(held[f]) <= PACK_BINS:
            packs[-1].append(f)
            widths[-1] *= len(held[f])
        else:
            packs.append([f])
            widths.append(len(held[f]))
    return Packs(cuts, held, packs, widths)


def bins_of(column: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Bin k: the row is below cut k and not below the one before; missing values lie above all cuts."""
    return np.where(np.isnan(column), len(cuts), np.searchsorted(cuts.astype(np.float64), column, "right"))


def joint_bins(packs: Packs, x: np.ndarray) -> np.ndarray:
    """Joint bin of every pack (packs by rows)."""
    joint = np.zeros((len(packs.packs), len(x)), np.min_scalar_type(max(packs.widths) - 1))
    for pack, out in zip(packs.packs, joint):
        number = np.zeros(len(x), np.int64)
        for f in pack:
            number = number * len(packs.held[f]) + np.searchsorted(packs.held[f], bins_of(x[:, f], packs.cuts[f]))
        out[:] = number
    return joint


@dataclass
class Binned:
    """Rows as joint bins of features that share a histogram: the features' own follow from it."""

    cuts: list[np.ndarray]
    # A row's joint bin of each pack (packs by rows).
    joint: np.ndarray
    # By pack: which joint bins lie left of which split, one column for each split of its features.
    left_of: list[np.ndarray]
    # Feature and cut of every split, and its place among the columns of all packs.
    feature: np.ndarray
    cut: np.ndarray
    place: np.ndarray


def splits_of(packs: Packs, joint: np.ndarray) -> Binned:
    left_of, splits = [], []
    for pack, width in zip(packs.packs, packs.widths):
        own, rest = [], np.arange(width)
        for f in reversed(pack):
            own.append((f, packs.held[f][rest % len(packs.held[f])]))
            rest = rest // len(packs.held[f])
        left_of.append(np.concatenate(
            [bins[:, None] <= np.arange(len(packs.cuts[f])) for f, bins in own], axis=1).astype(np.float64))
        splits += [(f, k) for f, _ in own for k in range(len(packs.cuts[f]))]
    feature, cut = np.array(splits, np.int64).reshape(-1, 2).T
    place = np.lexsort((cut, feature))
    return Binned(packs.cuts, joint, left_of, feature[place], cut[place], place)


def binned(x: np.ndarray) -> Binned:
    """Rows at hand as joint bins."""
    cuts = [cut_points(x[:, f]) for f in range(x.shape[1])]
    packs = packs_of(cuts, [np.unique(bins_of(x[:, f], c)) for f, c in enumerate(cuts)])
    return splits_of(packs, joint_bins(packs, x))


def histograms(rows: Binned, at: np.ndarray, nodes: int, number: np.ndarray, g: np.ndarray, h: np.ndarray) -> list[np.ndarray]:
    """Sums of ``g`` and ``h`` by node and joint bin of each pack, over the rows ``at`` in nodes ``number``."""
    made, g, h = [], g[at], h[at]
    for joint, left_of in zip(rows.joint, rows.left_of):
        width = len(left_of)
        cells = number * width
        cells += joint[at]
        made.append(np.stack([np.bincount(cells, w, nodes * width).reshape(nodes, width) for w in (g, h)], axis=1))
    return made


def blocks_of(n: int) -> list[slice]:
    return [slice(k, min(k + FIT_BLOCK, n)) for k in range(0, n, FIT_BLOCK)]


def grow(rows: Binned, g: np.ndarray, h: np.ndarray, drawn: np.ndarray, columns: np.ndarray,
         setting: dict) -> tuple[dict, np.ndarray, np.ndarray]:
    """One tree over the drawn rows, the leaf of each row, and the nodes' values.

    Sums of ``g`` and ``h`` are exact (see ``exact_unit``), so of two children only the one of fewer rows
    is counted, and the other is what is left of their parent. Rows are gone through block by block.
    """
    alpha, ridge, least = setting["reg_alpha"], setting["reg_lambda"], setting["min_child_weight"]
    left, right, feature, split, gains = [-1], [-1], [0], [0.0], [0.0]
    usable = np.flatnonzero(np.isin(rows.feature, columns))
    n = len(g)
    at, level, blocks = np.zeros(n, np.int32), [0], blocks_of(n)
    # Where the columns of each pack begin, and a row's joint bins among those of all packs.
    begin = np.concatenate([[0], np.cumsum([part.shape[1] for part in rows.left_of])])
    flat, width = rows.joint.ravel(), max(len(part) for part in rows.left_of)
    sums = [(sum(g[b][drawn[b]].sum() for b in blocks), sum(h[b][drawn[b]].sum() for b in blocks))]
    held = counts = None
    for depth in range(setting["max_depth"] if len(usable) else 0):
        if held is not None:
            # Children come in pairs, in the order of their parents.
            first = level[0]
            counts = counts[first:].reshape(-1, 2)
            side = (counts[:, 1] < counts[:, 0]).astype(np.int64)
            pairs = np.arange(len(side))
            number = np.full(len(left), -1)
            number[first + 2 * pairs + side] = pairs
        fewer = None
        for b in blocks:
            mine = np.flatnonzero(drawn[b]) + b.start
            if held is None:
                made = histograms(rows, mine, 1, np.zeros(len(mine), np.int64), g, h)
            else:
                node = number[at[mine]]
                counted = np.flatnonzero(node >= 0)
                made = histograms(rows, mine[counted], len(pairs), node[counted], g, h)
            fewer = made if fewer is None else [whole + part for whole, part in zip(fewer, made)]
        if held is None:
            held = fewer
        else:
            for k, (parent, part) in enumerate(zip(held, fewer)):
                both = np.empty((len(pairs), 2, *part.shape[1:]))
                both[pairs, side], both[pairs, 1 - side] = part, parent[was_split] - part
                held[k] = both.reshape(-1, *part.shape[1:])
        left_sums = np.concatenate([h_ @ left_of for h_, left_of in zip(held, rows.left_of)], axis=2)[:, :, rows.place[usable]]
        gl, hl = left_sums[:, 0], left_sums[:, 1]
        total = np.array([sums[k] for k in level])
        gt, ht = total[:, 0][:, None], total[:, 1][:, None]
        gr, hr = gt - gl, ht - hl

        def worth(a, b):
            return shrunk(a, alpha) ** 2 / np.maximum(b + ridge, 1e-12)

        gain = 0.5 * (worth(gl, hl) + worth(gr, hr) - worth(gt, ht)) - setting["gamma"]
        gain = np.where((hl >= least) & (hr >= least), gain, -np.inf)
        best = gain.argmax(axis=1)
        following, was_split, packs, sides = [], [], [], []
        for k, node in enumerate(level):
            value, chosen = gain[k, best[k]], usable[best[k]]
            if not value > 1e-6:
                continue
            was_split.append(k)
            left[node], right[node] = len(left), len(left) + 1
            feature[node], gains[node] = int(rows.feature[chosen]), float(value)
            split[node] = float(rows.cuts[feature[node]][rows.cut[chosen]])
            pack = int(np.searchsorted(begin, rows.place[chosen], "right")) - 1
            packs.append(pack)
            sides.append(rows.left_of[pack][:, rows.place[chosen] - begin[pack]])
            for a, b in ((gl[k, best[k]], hl[k, best[k]]), (gr[k, best[k]], hr[k, best[k]])):
                following.append(len(left))
                left.append(-1), right.append(-1), feature.append(0), split.append(0.0), gains.append(0.0)
                sums.append((float(a), float(b)))
        if not following:
            break
        # Rows of a node that was split go on to one of its children by its pack's bin, the others stay.
        onward = np.repeat(np.arange(len(left), dtype=np.int32)[:, None], width, axis=1)
        reads = np.zeros(len(left), np.int64)
        for k, pack, side_of in zip(was_split, packs, sides):
            node = level[k]
            reads[node] = pack * n
            onward[node, : len(side_of)] = np.where(side_of, left[node], right[node])
        onward, counts = onward.ravel(), np.zeros(len(left), np.int64)
        last = depth + 1 == setting["max_depth"]
        for b in blocks:
            here = at[b]
            bins = flat.take(reads.take(here) + np.arange(b.start, b.stop))
            at[b] = onward.take(here.astype(np.int64) * width + bins)
            if not last:
                counts += np.bincount(at[b][drawn[b]], minlength=len(left))
        level = following
    total = np.array(sums)
    weight = -setting["learning_rate"] * shrunk(total[:, 0], alpha) / np.maximum(total[:, 1] + ridge, 1e-12)
    weight = weight.astype(np.float32)
    tree = {"left_children": left, "right_children": right, "split_indices": feature, "split_conditions": split,
            "base_weights": weight.tolist(), "gains": gains}
    return tree, at, weight.astype(np.float64)


def exact_unit(weight: np.ndarray) -> float:
    """A power of two: sums of its multiples are exact in any order, for rows of these weights."""
    return float(2.0 ** (np.ceil(np.log2(max(weight.sum(), 1.0))) - 51))


def boosted(bins: Binned, y: np.ndarray, weight: np.ndarray, setting: dict, seed: int) -> list[dict]:
    """All trees of one setting. The value of a node that is split is kept but never used."""
    random = np.random.default_rng(seed)
    unit, features, n = exact_unit(weight), len(bins.cuts), len(y)
    margin, g, h, drawn, trees = np.zeros(n), np.empty(n), np.empty(n), np.empty(n, bool), []
    taken = max(1, int(setting["colsample_bytree"] * features))
    for _ in range(setting["n_estimators"]):
        for b in blocks_of(n):
            p = 1.0 / (1.0 + np.exp(-margin[b]))
            g[b] = np.rint(weight[b] * (p - y[b]) / unit) * unit
            h[b] = np.rint(np.maximum(weight[b] * p * (1 - p), 1e-16) / unit) * unit
            drawn[b] = random.random(len(p)) < setting["subsample"]
        columns = np.sort(random.choice(features, taken, replace=False))
        tree, at, value = grow(bins, g, h, drawn, columns, setting)
        for b in blocks_of(n):
            margin[b] += value.take(at[b])
        trees.append(tree)
    return trees


def fit(rows: Rows, setting: dict, seed: int = SEED) -> list[dict]:
    """All trees of one setting over rows at hand."""
    return boosted(binned(rows.x), rows.y, rows.weight, setting, seed)


def shared_fits(settings: list[dict]) -> tuple[list[dict], list[tuple[int, int]]]:
    """Fits to make, and for each setting its fit and how many of the trees it has."""
    fits: dict[tuple, int] = {}
    made, uses = [], []
    for setting in settings:
        rest = tuple(sorted((k, v) for k, v in setting.items() if k != "n_estimators"))
        number = fits.setdefault(rest, len(made))
        if number == len(made):
            made.append(dict(setting))
        made[number]["n_estimators"] = max(made[number]["n_estimators"], setting["n_estimators"])
        uses.append((number, setting["n_estimators"]))
    return made, uses


def tree_frame(number: int, trees: list[dict]) -> pd.DataFrame:
    frame = pd.DataFrame(trees)
    frame.insert(0, "tree", range(len(trees)))
    frame.insert(0, "fit", number)
    return frame


def fit_many(spark: SparkSession, rows: Rows, settings: list[dict], seed: int = SEED) -> DataFrame:
    """Trees of every setting over rows at hand, a task for each: (fit, tree, node lists)."""
    shared = spark.sparkContext.broadcast(rows)
    settings = [DEFAULT_TREES | s for s in settings]

    def fitted(batches):
        for batch in batches:
            for number in batch["id"].tolist():
                yield tree_frame(number, fit(shared.value, settings[number], seed))

    return spark.range(0, len(settings), 1, len(settings)).mapInPandas(fitted, TREES)


def table_packs(plain: DataFrame, features: list[str]) -> Packs:
    """What ``binned`` makes of rows at hand, from exact counts of the values of all rows of a table.

    Values are counted map-side, the counts stored in ranges and summed up; no task sees all values of a
    feature. Only the values where a feature may be split reach the driver, at most ``BINS`` of each.
    """
    names = [str(k) for k in range(len(features))]
    long = plain.select(*[F.col(f).alias(k) for f, k in zip(features, names)]).unpivot([], names, "feature", "value")
    counts = long.groupBy("feature", "value").agg(F.count("*").alias("n")).withColumn("one", F.lit(1).cast("long"))
    ranges = store_ranges(counts, "value", ("feature",))
    finite = F.abs("value") < float("inf")  # NaN is above it
    ranked = running_sums(ranges.filter(finite), "value", ["n", "one"], ("feature",))

    def ranks_below(count: Column) -> Column:
        """How many of the ranks ceil(k / BINS * (all_n - 1)), k from 1 on, lie below ``count``."""
        k = F.floor((count - 1) * BINS / F.greatest(F.col("all_n") - 1, F.lit(1)))
        return F.least(F.greatest(k, F.lit(0)), F.lit(BINS - 1))

    chosen = (F.col("all_one") <= BINS) | (ranks_below(F.col("cum_n")) > ranks_below(F.col("cum_n") - F.col("n")))
    picked = ranked.filter(chosen).select("feature", "value", (F.col("all_one") <= BINS).alias("every"))
    found = picked.unionByName(ranges.filter(~finite).select("feature", "value", F.lit(True).alias("every"))).collect()
    cuts, held = [], []
    for k in names:
        values = np.array([r["value"] for r in found if r["feature"] == k], np.float64)
        own = np.unique(values[np.isfinite(values)].astype(np.float32))
        every = all(r["every"] for r in found if r["feature"] == k)
        cuts.append(own)
        held.append(np.unique(bins_of(values, own)) if every else np.arange(len(own) + 1))
    return packs_of(cuts, held)


def fit_table(train: DataFrame, label: str, features: list[str], pos_weight: float, settings: list[dict],
              seed: int = SEED) -> DataFrame:
    """Trees of every setting over all rows of ``train``, a task for each setting: (fit, tree, node lists)."""
    settings = [DEFAULT_TREES | s for s in settings]
    missing = F.lit(float("nan"))
    plain = train.select(*[F.coalesce(F.col(f).cast("double"), missing).alias(f"_{k}") for k, f in enumerate(features)],
                         F.coalesce(F.col(label).cast("double"), missing).alias("_y"))
    columns = plain.columns[:-1]
    packs = table_packs(plain, columns)

    def coded(batches):
        part, start = TaskContext.get().partitionId(), 0
        for batch in batches:
            x, y = batch[columns].to_numpy(np.float64), batch["_y"].to_numpy(np.float64)
            joint, begins = joint_bins(packs, x), range(0, len(y), SENT_BLOCK)
            yield pd.DataFrame({
                "part": part, "start": [start + k for k in begins], "size": [len(y[k : k + SENT_BLOCK]) for k in begins],
                "bins": [joint[:, k : k + SENT_BLOCK].tobytes() for k in begins],
                "labels": [y[k : k + SENT_BLOCK].tobytes() for k in begins]})
            start += len(y)

    # Equal rows may lie in any order: the last key only lets a range end among them.
    ordered = plain.withColumn("_tie", F.monotonically_increasing_id()).orderBy(*plain.columns, "_tie").drop("_tie")
    blocks = store(ordered.mapInPandas(coded, "part int, start long, size long, bins binary, labels binary"), "fit-rows")
    sizes = dict(sorted(map(tuple, blocks.groupBy("part").agg(F.sum("size")).collect())))
    offsets = dict(zip(sizes, np.cumsum([0, *sizes.values()]).tolist()))
    rows = sum(sizes.values())

    def fitted(batches):
        joint: dict[int, np.ndarray] = {}
        labels: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, part, start, size, bins, y in zip(*[batch[c] for c in ("fit", "part", "start", "size", "bins", "labels")]):
                if number not in joint:
                    joint[number] = np.empty((len(packs.packs), rows), np.min_scalar_type(max(packs.widths) - 1))
                    labels[number] = np.empty(rows)
                begin = offsets[part] + start
                joint[number][:, begin : begin + size] = np.frombuffer(bins, joint[number].dtype).reshape(-1, size)
                labels[number][begin : begin + size] = np.frombuffer(y, np.float64)
        for number in list(joint):
            y = labels.pop(number)
            bins = splits_of(packs, joint.pop(number))
            yield tree_frame(number, boosted(bins, y, np.where(y == 1, pos_weight, 1.0), settings[number], seed))

    sent = blocks.withColumn("fit", F.explode(F.sequence(F.lit(0), F.lit(len(settings) - 1))))
    return sent.repartitionById(len(settings), "fit").mapInPandas(fitted, TREES)


def collected(trees: DataFrame, features: list[str] = FEATURE_COLS) -> list[TreeModel]:
    """The models of a table of trees; their size is checked. A sort by Spark would make the trees twice."""
    models: dict[int, list[dict]] = {}
    for row in sorted(trees.collect(), key=lambda row: (row["fit"], row["tree"])):
        models.setdefault(row["fit"], []).append(row.asDict())
    return [TreeModel(models[k], feature_cols=list(features)) for k in sorted(models)]


def first_trees(model: TreeModel, n: int) -> TreeModel:
    """The ensemble that the first ``n`` trees are."""
    return replace(model, trees=model.trees[:n])


def ensemble_scores(df: DataFrame, models: list[TreeModel], uses: list[tuple[int, int]]) -> Column:
    """Array of the scores of the ensembles ``uses`` lists as (model, number of its first trees).

    All models have the feature columns of the first; trees that several ensembles share are walked once.
    """
    features = [F.col(c).cast("double") for c in models[0].feature_cols]
    firsts = np.concatenate([[0], np.cumsum([len(m.trees) for m in models])])
    forest = TreeModel([t for m in models for t in m.trees], feature_cols=models[0].feature_cols)
    shared = df.sparkSession.sparkContext.broadcast(flat_trees(forest, len(features)))
    begin = np.array([firsts[m] for m, _ in uses])
    end = np.array([firsts[m] + n for m, n in uses])
    base = [float(np.log(models[m].base_score / (1 - models[m].base_score))) for m, _ in uses]

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def margins(*columns: pd.Series) -> pd.Series:
        out = []
        for weights in leaf_weights(shared.value, columns):
            upto = np.concatenate([np.zeros((len(weights), 1)), weights.cumsum(axis=1)], axis=1)
            out.extend(upto[:, end] - upto[:, begin] + base)
        return pd.Series(out)

    return F.transform(margins(*features), sigmoid)


def score_ensembles(df: DataFrame, models: list[TreeModel], uses: list[tuple[int, int]]) -> DataFrame:
    """Each row once for every ensemble, with ``model`` (its place in ``uses``) and ``score``."""
    scored = df.withColumn("_scores", ensemble_scores(df, models, uses))
    return scored.select(*df.columns, F.posexplode("_scores").alias("model", "score"))


def train_gbt(train: DataFrame, pos_weight: float, label: str = "label", params: dict | None = None,
              features: list[str] = FEATURE_COLS, seed: int = SEED) -> TreeModel:
    """One fit over all rows with the published settings, or those of ``params``."""
    return collected(fit_table(train, label, features, pos_weight, [params or {}], seed), features)[0]


def importance(model: TreeModel) -> dict[str, float]:
    """Mean gain of the splits on each feature, as a share of the sum over features."""
    gain, count = np.zeros(len(model.feature_cols)), np.zeros(len(model.feature_cols))
    for tree in model.trees:
        for lower, feature, value in zip(tree["left_children"], tree["split_indices"], tree["gains"]):
            if lower >= 0:
                gain[feature] += value
                count[feature] += 1
    mean = gain / np.maximum(count, 1)
    return {f: float(v) for f, v in zip(model.feature_cols, mean / (mean.sum() or 1.0))}
