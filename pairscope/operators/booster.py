"""M6: a second-order gradient-boosted tree classifier, grown from Spark aggregates.

Rows are cut into bins once.  Each level of a tree needs the sums of gradients
and Hessians per (node, feature, bin); tasks add up their rows and pass on one
row per used cell, Spark adds these, and the driver, which sees sums only,
picks the split of every node: gain with L1 and L2 penalties, a Hessian bound
for children, columns drawn per tree and per level, rows drawn per tree, and
bottom-up pruning by ``gamma``.  Gradients are rounded to multiples of 2^-30 and added
as integers, so trees do not depend on how rows are dealt to tasks.

Boosting state lives in tables of the shared folder: the binned rows with
their margins, and the trees, written every ``save_every`` rounds.  A run that
stopped is continued from the last of them and gives the same trees.  Between
two saves a training set of at most ``task_rows`` rows (the balanced sample of
the job is bounded by a parameter) is boosted within one task, since a Spark
job per level would only wait; a larger one level by level.  Both use the same
functions on the same sums, so the trees are equal.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: One unit of an integer gradient or Hessian is 2^-30.
UNIT = float(1 << 30)
#: A split has to gain more than this.
LEAST_GAIN = 1e-6
#: Depth of the percentile sketch that bin edges come from.
SKETCH = 100_000


@dataclass(frozen=True)
class BoosterParams:
    """Fixed values of the reference's configuration; below them, how the work is cut."""

    max_iter: int = 2000
    max_depth: int = 7
    step_size: float = 0.01
    gamma: float = 0.03
    l2: float = 1.0
    l1: float = 1.0
    subsample: float = 0.75
    columns_per_tree: float = 0.9
    columns_per_level: float = 0.9
    min_child_weight: float = 0.8
    max_delta_step: float = 0.0
    scale_pos_weight: float = 1.0
    seed: int = 123
    max_bins: int = 256
    save_every: int = 100
    task_rows: int = 200_000

    def with_iterations(self, n: int) -> BoosterParams:
        return replace(self, max_iter=n)

    def same_trees(self) -> dict:
        """The values that decide what a tree looks like."""
        return {k: v for k, v in asdict(self).items() if k not in ("max_iter", "save_every", "task_rows")}


@dataclass
class Tree:
    """A complete binary tree of ``2^(depth+1) - 1`` nodes; node i has the children 2i + 1 (bin <= split) and 2i + 2."""

    feature: np.ndarray    # -1: a leaf (or below one)
    split: np.ndarray      # last bin that goes left
    gain: np.ndarray
    value: np.ndarray      # of leaves; 0 elsewhere


# ------------------------------------------------------------ sums to splits
def soft(g: np.ndarray, l1: float) -> np.ndarray:
    """``g`` moved towards 0 by ``l1``."""
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


def leaf_weight(g: np.ndarray, h: np.ndarray, p: BoosterParams) -> np.ndarray:
    """The best value of a leaf with gradient sum ``g`` and Hessian sum ``h`` (before the step size)."""
    w = np.where((h >= p.min_child_weight) & (h > 0), -soft(g, p.l1) / (np.maximum(h, 1e-300) + p.l2), 0.0)
    return np.clip(w, -p.max_delta_step, p.max_delta_step) if p.max_delta_step > 0 else w


def leaf_gain(g: np.ndarray, h: np.ndarray, p: BoosterParams) -> np.ndarray:
    """How much that value lowers twice the penalised loss."""
    w = leaf_weight(g, h, p)
    return -(2 * g * w + (h + p.l2) * w * w + 2 * p.l1 * np.abs(w))


def split_gains(g: np.ndarray, h: np.ndarray, n_cuts: np.ndarray, p: BoosterParams):
    """Gain of a split after each bin, 0 where it is not allowed, and the sums (g, h left, g, h right).

    ``g`` and ``h`` are integer sums, nodes x features x bins.
    """
    gl, hl = g.cumsum(axis=2), h.cumsum(axis=2)
    gt, ht = gl[:, :1, -1:], hl[:, :1, -1:]          # every feature adds up to the node's sums
    gr, hr = gt - gl, ht - hl
    fl = [v / UNIT for v in (gl, hl, gr, hr)]
    gain = leaf_gain(fl[0], fl[1], p) + leaf_gain(fl[2], fl[3], p) - leaf_gain(gt / UNIT, ht / UNIT, p)
    gain[(fl[1] < p.min_child_weight) | (fl[3] < p.min_child_weight)] = 0.0
    gain[:, np.arange(gain.shape[2])[None, :] >= n_cuts[:, None]] = 0.0
    return gain, (gl, hl, gr, hr)


def best_splits(g: np.ndarray, h: np.ndarray, columns: np.ndarray, n_cuts: np.ndarray, p: BoosterParams):
    """Per node: feature (-1: none), last bin on the left, gain, and the (left, right) sums of ``g`` and ``h``.

    Of equal gains the lowest feature and bin wins.
    """
    gain, sums = split_gains(g, h, n_cuts, p)
    gain[:, np.setdiff1d(np.arange(gain.shape[1]), columns)] = 0.0
    flat = gain.reshape(len(gain), -1)
    best = flat.argmax(axis=1)
    rows = np.arange(len(gain))
    most = flat[rows, best]
    feature, split = np.divmod(best, gain.shape[2])
    return np.where(most > LEAST_GAIN, feature, -1), split, most, [v[rows, feature, split] for v in sums]


def drawn_columns(n: int, tree: int, level: int, p: BoosterParams) -> np.ndarray:
    """Columns that a level of a tree may split: a draw of the tree's draw."""
    own = np.sort(np.random.default_rng([p.seed, tree]).permutation(n)[: max(1, int(p.columns_per_tree * n))])
    order = np.random.default_rng([p.seed, tree, level + 1]).permutation(len(own))
    return np.sort(own[order[: max(1, int(p.columns_per_level * len(own)))]])


Histograms = Callable[[Tree, list[int]], tuple[np.ndarray, np.ndarray]]


def grow(tree: int, sums: Histograms, n_cuts: np.ndarray, p: BoosterParams) -> Tree:
    """One tree; ``sums`` gives the integer sums of the rows in some nodes of the tree so far."""
    inner, nodes = 2 ** p.max_depth - 1, 2 ** (p.max_depth + 1) - 1
    out = Tree(np.full(inner, -1, np.int16), np.zeros(inner, np.int16), np.zeros(inner), np.zeros(nodes))
    total = np.zeros((nodes, 2), np.int64)
    active = [0]
    for level in range(p.max_depth):
        if not active:
            break
        g, h = sums(out, active)
        if level == 0:
            total[0] = g[0, 0].sum(), h[0, 0].sum()
        feature, split, gain, (gl, hl, gr, hr) = best_splits(g, h, drawn_columns(len(n_cuts), tree, level, p), n_cuts, p)
        below = []
        for i, node in enumerate(active):
            if feature[i] >= 0:
                out.feature[node], out.split[node], out.gain[node] = feature[i], split[i], gain[i]
                total[2 * node + 1], total[2 * node + 2] = (gl[i], hl[i]), (gr[i], hr[i])
                below += [2 * node + 1, 2 * node + 2]
        active = below
    leaf = lambda i: i >= inner or out.feature[i] < 0
    for node in range(inner - 1, -1, -1):              # children come after their parents
        if not leaf(node) and leaf(2 * node + 1) and leaf(2 * node + 2) and out.gain[node] < p.gamma:
            out.feature[node], out.split[node], out.gain[node] = -1, 0, 0.0
    reached = [0]
    while reached:
        node = reached.pop()
        if leaf(node):
            g, h = total[node] / UNIT
            out.value[node] = p.step_size * float(leaf_weight(np.array(g), np.array(h), p))
        else:
            reached += [2 * node + 1, 2 * node + 2]
    return out


# ------------------------------------------------------------------- rows
def places(bins: np.ndarray, tree: Tree) -> np.ndarray:
    """Node of each row (rows x features of bins) in the tree as far as it is grown."""
    node = np.zeros(len(bins), np.int64)
    rows = np.arange(len(bins))
    while len(rows):
        at = node[rows]
        open_ = at < len(tree.feature)
        rows, at = rows[open_], at[open_]
        f = tree.feature[at]
        rows, at, f = rows[f >= 0], at[f >= 0], f[f >= 0]
        node[rows] = 2 * at + 1 + (bins[rows, f] > tree.split[at])
    return node


def advance(bins: np.ndarray, margin: np.ndarray, trees: list[Tree]) -> np.ndarray:
    """Margins after some more trees, added one by one."""
    for t in trees:
        margin = margin + t.value[places(bins, t)]
    return margin


def gradients(margin: np.ndarray, label: np.ndarray, p: BoosterParams) -> tuple[np.ndarray, np.ndarray]:
    """Integer gradients and Hessians of the log-loss."""
    prob = 1.0 / (1.0 + np.exp(-margin))
    weight = np.where(label == 1, p.scale_pos_weight, 1.0)
    g, h = (prob - label) * weight, np.maximum(prob * (1 - prob), 1e-16) * weight
    return np.rint(g * UNIT).astype(np.int64), np.maximum(np.rint(h * UNIT).astype(np.int64), 1)


def drawn_rows(key: np.ndarray, tree: int, p: BoosterParams) -> np.ndarray:
    """Which rows a tree is grown from: a draw by the row's key, the tree and the seed."""
    x = key.view(np.uint64) ^ np.uint64((tree * 0x9E3779B97F4A7C15 + p.seed * 0xD6E8FEB86659FD93) % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    x ^= x >> np.uint64(31)
    return (x >> np.uint64(11)) / float(1 << 53) < p.subsample


def cell_sums(bins: np.ndarray, node: np.ndarray, g: np.ndarray, h: np.ndarray, active: list[int], width: int):
    """Integer sums of ``g`` and ``h`` per (active node, feature, bin); exact below 2^23 rows at a time."""
    features = bins.shape[1]
    slot = np.full(int(max(active)) + 1, -1, np.int64)
    slot[active] = np.arange(len(active))
    own = np.where(node < len(slot), slot[np.minimum(node, len(slot) - 1)], -1)
    mine = own >= 0
    key = ((own[mine, None] * features + np.arange(features)) * width + bins[mine]).ravel()
    shape, size = (len(active), features, width), len(active) * features * width
    return tuple(np.bincount(key, np.repeat(v[mine], features), size).astype(np.int64).reshape(shape) for v in (g, h))


def boost_rows(bins: np.ndarray, label: np.ndarray, key: np.ndarray, margin: np.ndarray, first: int, rounds: int,
               n_cuts: np.ndarray, p: BoosterParams) -> list[Tree]:
    """The trees ``first`` .. ``first + rounds - 1`` of rows in arrays."""
    width, out = int(n_cuts.max(initial=0)) + 1, []
    for tree in range(first, first + rounds):
        take = drawn_rows(key, tree, p)
        g, h = gradients(margin, label, p)
        own, g, h = bins[take], g[take], h[take]
        out.append(grow(tree, lambda t, active: cell_sums(own, places(own, t), g, h, active, width), n_cuts, p))
        margin = advance(bins, margin, out[-1:])
    return out


# ------------------------------------------------------------- Spark sums
def _arrays(batch: pa.RecordBatch, features: int):
    bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(batch.num_rows, features)
    return (bins, *(batch.column(c).to_numpy(zero_copy_only=False) for c in ("label", "key", "margin")))


def spark_sums(state: DataFrame, pending: list[Tree], tree: int, n_cuts: np.ndarray, p: BoosterParams) -> Histograms:
    """Sums over the stored rows, their margins brought forward by the trees since they were stored."""
    features, width = len(n_cuts), int(n_cuts.max(initial=0)) + 1

    def sums(partial: Tree, active: list[int]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                bins, label, key, margin = _arrays(batch, features)
                take = drawn_rows(key, tree, p)
                bins, label, margin = bins[take], label[take], margin[take]
                g, h = gradients(advance(bins, margin, pending), label, p)
                found = cell_sums(bins, places(bins, partial), g, h, active, width)
                total = found if total is None else tuple(a + b for a, b in zip(total, found))
            if total is not None:
                cell = np.flatnonzero(total[1].ravel())
                yield pa.RecordBatch.from_arrays([pa.array(cell), *(pa.array(v.ravel()[cell]) for v in total)], names=["cell", "g", "h"])

        shape = (len(active), features, width)
        g, h = np.zeros(shape, np.int64), np.zeros(shape, np.int64)
        rows = (state.mapInArrow(run, "cell long, g long, h long").groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
                .toArrow())                               # nodes x features x bins rows at most
        cell = rows.column("cell").to_numpy()
        g.ravel()[cell], h.ravel()[cell] = rows.column("g").to_numpy(), rows.column("h").to_numpy()
        return g, h

    return sums


def boost_spark(state: DataFrame, first: int, rounds: int, n_cuts: np.ndarray, p: BoosterParams) -> list[Tree]:
    """The trees ``first`` .. ``first + rounds - 1`` of stored rows, one Spark aggregate per level."""
    out: list[Tree] = []
    for tree in range(first, first + rounds):
        out.append(grow(tree, spark_sums(state, out, tree, n_cuts, p), n_cuts, p))
    return out


def split_table(data: DataFrame, features: list[str], label: str, key: list[str], p: BoosterParams = BoosterParams()) -> DataFrame:
    """What the first split is chosen from: (feature, cut, g_left, h_left, g_right, h_right, gain) over all rows.

    One row per cut of each feature, fewer than ``max_bins`` of them.
    """
    data = data.where(F.col(label).isNotNull())
    model = Booster(features, bin_edges(data, features, p), [])
    n_cuts = np.array([len(c) for c in model.cuts])
    root = Tree(np.full(1, -1, np.int16), np.zeros(1, np.int16), np.zeros(1), np.zeros(3))
    sums = spark_sums(binned(data, model, key, label), [], 0, n_cuts, replace(p, subsample=1.0))(root, [0])
    gain, sides = split_gains(*sums, n_cuts, p)
    rows = [(name, float(cut), *(float(v[0, f, b] / UNIT) for v in sides), float(gain[0, f, b]))
            for f, name in enumerate(features) for b, cut in enumerate(model.cuts[f])]
    return data.sparkSession.createDataFrame(rows, "feature string, cut double, g_left double, h_left double, "
                                                   "g_right double, h_right double, gain double")


TREES = "round int, feature array<int>, split array<int>, gain array<double>, value array<double>"


def boost_in_task(state: DataFrame, first: int, rounds: int, n_cuts: np.ndarray, p: BoosterParams) -> list[Tree]:
    """The same trees, grown by one task over all stored rows (a bounded number)."""
    features = len(n_cuts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [_arrays(b, features) for b in batches]
        if parts:
            bins, label, key, margin = (np.concatenate(v) for v in zip(*parts))
            trees = boost_rows(bins, label, key, margin, first, rounds, n_cuts, p)
            yield pa.RecordBatch.from_pylist(_tree_rows(first, trees), _tree_schema())

    return _trees(state.repartition(1).mapInArrow(run, TREES).collect())


def _tree_schema() -> pa.Schema:
    ints, doubles = pa.list_(pa.int32()), pa.list_(pa.float64())
    return pa.schema([("round", pa.int32()), ("feature", ints), ("split", ints), ("gain", doubles), ("value", doubles)])


def _tree_rows(first: int, trees: list[Tree]) -> list[dict]:
    return [{"round": first + i, "feature": t.feature.tolist(), "split": t.split.tolist(), "gain": t.gain.tolist(),
             "value": t.value.tolist()} for i, t in enumerate(trees)]


def _trees(rows: list) -> list[Tree]:
    return [Tree(np.array(r["feature"], np.int16), np.array(r["split"], np.int16), np.array(r["gain"]), np.array(r["value"]))
            for r in sorted(rows, key=lambda r: r["round"])]


# ------------------------------------------------------------------- model
@dataclass
class Booster:
    """Trees over named features; ``cuts[f][b]`` is the value from which on a row lies beyond bin ``b``."""

    features: list[str]
    cuts: list[np.ndarray]
    trees: list[Tree]

    def first(self, k: int) -> Booster:
        """M7: the model of the first ``k`` trees."""
        if not 0 < k <= len(self.trees):
            raise ValueError(f"the model has {len(self.trees)} trees")
        return replace(self, trees=self.trees[:k])

    def bins(self, x: np.ndarray) -> np.ndarray:
        """Bin numbers of raw values (rows x features); a missing value lies beyond all cuts."""
        out = np.zeros(x.shape, np.uint8)
        for f, cuts in enumerate(self.cuts):
            out[:, f] = np.where(np.isnan(x[:, f]), len(cuts), np.searchsorted(cuts, x[:, f], side="right"))
        return out

    def staged_margins(self, x: np.ndarray, rounds: list[int]) -> np.ndarray:
        """Margins of raw values after each of ``rounds`` (ascending) trees."""
        bins, margin, done, out = self.bins(x), np.zeros(len(x)), 0, []
        for k in rounds:
            margin, done = advance(bins, margin, self.trees[done:k]), k
            out.append(margin)
        return np.stack(out, axis=1) if out else np.zeros((len(x), 0))


def bin_edges(data: DataFrame, features: list[str], p: BoosterParams) -> list[np.ndarray]:
    """Midpoints between the distinct values of a percentile sketch, fewer than ``max_bins`` a feature.

    A feature of fewer values is cut between all of them.
    """
    shares = ", ".join(str(i / (p.max_bins - 1)) for i in range(p.max_bins))
    row = data.select(*[F.expr(f"percentile_approx(cast(`{c}` as double), array({shares}), {SKETCH})").alias(c) for c in features]).first()
    out = []
    for c in features:
        v = np.unique(np.array(row[c] or [], np.float64))
        v = v[np.isfinite(v)]
        out.append((v[1:] + v[:-1]) / 2)
    return out


def binned(data: DataFrame, model: Booster, key: list[str], label: str) -> DataFrame:
    """(key, label, bins, margin) of every row: XXH64 of its key columns, one byte per feature."""
    columns = [F.col(c).cast("double") for c in model.features]

    @F.pandas_udf("binary")
    def pack(*values):
        import pandas as pd
        x = model.bins(np.column_stack([v.to_numpy(np.float64) for v in values]))
        return pd.Series([r.tobytes() for r in x], dtype=object)

    ids = [F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in key]
    return data.select(F.xxhash64(*ids).alias("key"), F.col(label).cast("double").alias("label"), pack(*columns).alias("bins"),
                       F.lit(0.0).alias("margin"))


def moved_on(state: DataFrame, trees: list[Tree], features: int) -> DataFrame:
    """The stored rows with their margins after ``trees``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, _, _, margin = _arrays(batch, features)
            yield batch.set_column(batch.schema.get_field_index("margin"), "margin", pa.array(advance(bins, margin, trees)))
    return state.mapInArrow(run, state.schema)


# ---------------------------------------------------------------- training
class Progress:
    """The saved state of a run: ``progress`` names the rounds done and the table of rows after them."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def last(self) -> dict | None:
        try:
            rows = self.spark.read.schema("rounds int, state string, model string, params string").json(f"{self.path}/progress").collect()
        except AnalysisException:
            return None
        found = max(rows, key=lambda r: r.rounds, default=None)
        return found.asDict() if found else None

    def save(self, rounds: int, state: str, model: Booster, p: BoosterParams) -> dict:
        """Written last, after the rows and trees it names."""
        about = json.dumps({"features": model.features, "cuts": [c.tolist() for c in model.cuts]})
        row = {"rounds": rounds, "state": state, "model": about, "params": json.dumps(p.same_trees())}
        self.spark.createDataFrame([row], "rounds int, state string, model string, params string").write.mode("append").json(f"{self.path}/progress")
        return row

    def add_trees(self, first: int, trees: list[Tree]) -> None:
        write_trees(self.spark, trees, f"{self.path}/trees", "append", first)

    def trees(self, rounds: int) -> list[Tree]:
        """The trees of the rounds done; a run that stopped while saving may have left later ones or repeated some."""
        return _trees(self.spark.read.schema(TREES).parquet(f"{self.path}/trees").where(F.col("round") < rounds)
                      .dropDuplicates(["round"]).collect()) if rounds else []


def write_trees(spark: SparkSession, trees: list[Tree], path: str, mode: str, first: int = 0) -> None:
    spark.createDataFrame(_tree_rows(first, trees), TREES).coalesce(1).write.mode(mode).parquet(path)


def train(data: DataFrame, features: list[str], label: str, key: list[str], p: BoosterParams = BoosterParams(),
          path: str | None = None, stop_after: int | None = None, in_task: bool | None = None) -> Booster:
    """Boost ``p.max_iter`` rounds over ``data``; a run with the same ``path`` continues where the last one stopped.

    ``stop_after`` ends the run at the first save at or after that many rounds
    (a killed job does the same).  ``in_task`` decides how rounds are computed;
    None goes by the number of rows.  Rows with a null label are passed over; no
    rows, or equal labels, give trees that say little: a single leaf each.
    """
    spark = data.sparkSession
    progress = Progress(spark, path or scratch_path(spark, "booster"))
    at = progress.last()
    if at is None:
        data = data.where(F.col(label).isNotNull())
        model = Booster(features, bin_edges(data, features, p), [])
        state = f"{progress.path}/state-{0:06d}"
        binned(data, model, key, label).write.mode("overwrite").parquet(state)
        at = progress.save(0, state, model, p)
    elif json.loads(at["params"]) != p.same_trees():
        raise ValueError(f"{progress.path} holds a run with other parameters: {at['params']}")
    about = json.loads(at["model"])
    model = Booster(about["features"], [np.array(c) for c in about["cuts"]], progress.trees(at["rounds"]))
    n_cuts = np.array([len(c) for c in model.cuts])
    state, done = spark.read.parquet(at["state"]), at["rounds"]
    if in_task is None:
        in_task = state.count() <= p.task_rows
    boost = boost_in_task if in_task else boost_spark
    while done < p.max_iter and (stop_after is None or done < stop_after):
        rounds = min(p.save_every, p.max_iter - done)
        trees = boost(state, done, rounds, n_cuts, p)
        if not trees:
            break                                           # no rows
        progress.add_trees(done, trees)
        model.trees += trees
        done += rounds
        if done < p.max_iter:
            table = f"{progress.path}/state-{done:06d}"
            moved_on(state, trees, len(n_cuts)).write.mode("overwrite").parquet(table)
            progress.save(done, table, model, p)
            state = spark.read.parquet(table)
    return model


# ----------------------------------------------------------------- scoring
def score_column(model: Booster):
    """The probability of the positive class, from the feature columns (M8)."""
    rounds = [len(model.trees)]

    @F.pandas_udf("double")
    def probability(*values):
        import pandas as pd
        x = np.column_stack([v.to_numpy(np.float64) for v in values])
        margin = model.staged_margins(x, rounds)[:, 0]     # trees x nodes numbers, sent with the function
        return pd.Series(1.0 / (1.0 + np.exp(-margin)))

    return probability(*[F.col(c).cast("double") for c in model.features])


def staged_scores(df: DataFrame, model: Booster, every: int, keep: list[str]) -> DataFrame:
    """One row per row of ``df`` and checkpoint: ``keep``, rounds, score.  Every tree is walked once."""
    total = len(model.trees)
    rounds = sorted({*range(every, total + 1, every), total})

    @F.pandas_udf("array<double>")
    def stages(*values):
        import pandas as pd
        margin = model.staged_margins(np.column_stack([v.to_numpy(np.float64) for v in values]), rounds)
        return pd.Series(list(1.0 / (1.0 + np.exp(-margin))))

    at = F.array(*[F.lit(k) for k in rounds])
    return (df.select(*keep, stages(*[F.col(c).cast("double") for c in model.features]).alias("stages"))
            .select(*keep, F.posexplode("stages").alias("pos", "score"))
            .select(*keep, at[F.col("pos")].alias("rounds"), "score"))


def save(model: Booster, spark: SparkSession, path: str) -> str:
    """M9: features and cuts, and one row per tree."""
    spark.createDataFrame([(i, f, c.tolist()) for i, (f, c) in enumerate(zip(model.features, model.cuts))],
                          "number int, feature string, cuts array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/features")
    write_trees(spark, model.trees, f"{path}/trees", "overwrite")
    return path


def load(spark: SparkSession, path: str) -> Booster:
    """M9."""
    rows = sorted(spark.read.parquet(f"{path}/features").collect(), key=lambda r: r.number)
    return Booster([r.feature for r in rows], [np.array(r.cuts) for r in rows],
                   _trees(spark.read.schema(TREES).parquet(f"{path}/trees").collect()))
