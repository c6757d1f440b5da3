"""Second-order boosted trees: gradient and hessian histograms, L1 and L2 terms, optional tree dropout.

(Chen & Guestrin, "XGBoost", KDD 2016; dropout: Vinayak & Gilad-Bachrach, "DART", 2015.)

* **Bins.**  Per feature, the distinct values where they are few, else a quantile grid;
  a value's bin is the number of cuts at or below it.  Rows are stored once as
  (label, margin, slots): a slot is a bin of a feature, and the bin that holds zero is left
  out, so a one-hot block of any width costs one slot a row.
* **Levels.**  All nodes of a level are found by one job: tasks add up gradients and
  hessians by (node, slot), the sums of a (node, block of features) meet in one group, which
  returns its best split.  The driver gets a row a node and block, never a histogram.
* **Splits.**  ``gain = s(L) + s(R) - s(all)`` with ``s(G, H) = T(G)^2 / (H + lambda)`` and
  ``T`` the soft threshold by ``alpha``; both children need a hessian of
  ``min_child_weight``; ties go to the first feature, then the lowest cut.  A leaf
  is ``-eta * T(G) / (H + lambda)``.
* **Margins** of the trees so far are stored with the rows every ``REFRESH`` rounds, so a
  job walks through few trees; a lost executor rereads them.
* **Dropout** (``booster="dart"``): each round leaves out every earlier tree with probability
  ``rate_drop``; the new tree gets the weight ``1 / (k + eta)`` and the ``k`` left-out ones are
  scaled by ``k / (k + eta)``.  The default booster has none, whatever ``rate_drop`` says.

Tasks' sums are added in task order, so a fit is the same for the same partitions.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.functions.names import qcol
from tabprep.session import drop_stored, store

MAX_BINS, BLOCK_SLOTS, REFRESH, MIN_GAIN = 64, 4096, 10, 1e-6
TIE = 1e-9  # gains as near as this are equal: the order of additions does not decide


@dataclass
class BoostParams:
    eta: float = 0.3
    max_depth: int = 6
    num_round: int = 100
    min_child_weight: float = 1.0
    alpha: float = 0.0
    reg_lambda: float = 1.0
    booster: str = "gbtree"
    rate_drop: float = 0.0
    base_score: float = 0.5
    max_bins: int = MAX_BINS
    seed: int = 42


@dataclass
class Tree:
    """Nodes in order; a leaf has feature -1.  ``bin`` and below (``value`` below ``cut``) goes to ``left``, else to ``left + 1``."""
    feature: list = field(default_factory=lambda: [-1])
    bin: list = field(default_factory=lambda: [0])
    cut: list = field(default_factory=lambda: [0.0])
    left: list = field(default_factory=lambda: [0])
    value: list = field(default_factory=lambda: [0.0])

    def add(self) -> int:
        for x, v in ((self.feature, -1), (self.bin, 0), (self.cut, 0.0), (self.left, 0), (self.value, 0.0)):
            x.append(v)
        return len(self.feature) - 1

    def leaf_of(self, n: int, goes_right) -> np.ndarray:
        """The leaf of each of n rows; ``goes_right(node)`` tells for rows at their nodes."""
        at, feature, left = np.zeros(n, np.int64), np.array(self.feature), np.array(self.left)
        while True:
            inner = np.flatnonzero(feature[at] >= 0)
            if not len(inner):
                return at
            at[inner] = left[at[inner]] + goes_right(inner, at[inner])


def soft(g, alpha: float):
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)


def best_split(g: np.ndarray, h: np.ndarray, total_g: float, total_h: float, p: BoostParams):
    """(gain, bin, g, h of the left side) of one feature's histogram; gain -inf if no cut is allowed."""
    if len(g) < 2:
        return -np.inf, 0, 0.0, 0.0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = total_g - gl, total_h - hl
    score = lambda a, b: soft(a, p.alpha) ** 2 / (b + p.reg_lambda)
    ok = (hl >= p.min_child_weight) & (hr >= p.min_child_weight)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(ok, score(gl, hl) + score(gr, hr) - score(total_g, total_h), -np.inf)
    top = gain.max()
    if top == -np.inf:
        return -np.inf, 0, 0.0, 0.0
    b = int(np.flatnonzero(gain >= top - TIE * (1 + abs(top)))[0])
    return float(gain[b]), b, float(gl[b]), float(hl[b])


class _Bins:
    """Cuts and slots of every feature."""

    def __init__(self, cuts: list[np.ndarray]):
        self.cuts = cuts
        size = np.array([len(c) + 1 for c in cuts], np.int64)
        self.offset = np.append(0, np.cumsum(size))
        self.zero = np.array([np.searchsorted(c, 0.0, side="right") for c in cuts], np.int64)
        self.feature = np.repeat(np.arange(len(cuts)), size)
        blocks, first = [], 0  # features in runs of about BLOCK_SLOTS slots
        for f in range(len(cuts)):
            if self.offset[f + 1] - self.offset[first] > BLOCK_SLOTS and f > first:
                blocks.append((first, f))
                first = f
        self.blocks = [*blocks, (first, len(cuts))]


def _entries(features: str) -> Column:
    """(index, value) of the values other than zero."""
    pairs = F.transform(vector_to_array(F.col(features)), lambda x, i: F.struct(i.alias("i"), x.alias("x")))
    return F.filter(pairs, lambda e: e["x"] != 0)


def find_bins(df: DataFrame, features: str, max_bins: int) -> _Bins:
    """Cuts at the distinct values of a feature where these are few, else at its quantiles."""
    first = df.select(F.size(vector_to_array(F.col(features))).alias("n")).first()
    if first is None:
        raise ValueError("cannot train on an empty table")
    width, rows = first["n"], df.count()
    long = df.select(F.explode(_entries(features)).alias("e")).select("e.i", "e.x")
    probs = [j / max_bins for j in range(max_bins + 1)]
    seen = {r["i"]: r for r in long.groupBy("i").agg(
        F.count("x").alias("n"), F.approx_count_distinct("x", 0.02).alias("d"),
        F.percentile_approx("x", probs, 20 * max_bins).alias("q")).collect()}  # a row a feature
    few = [i for i, r in seen.items() if r["d"] <= max_bins]
    values = {i: set(r["q"]) for i, r in seen.items()}
    if few:  # about max_bins rows a feature
        wanted = long.where(F.col("i").isin(few)) if len(few) <= 1000 else long.join(
            F.broadcast(df.sparkSession.createDataFrame([(i,) for i in few], "i int")), "i")
        for i in few:
            values[i] = set()
        for r in wanted.distinct().collect():
            values[r["i"]].add(r["x"])
    cuts = []
    for i in range(width):
        mine = values.get(i, set()) | ({0.0} if i not in seen or seen[i]["n"] < rows else set())
        cuts.append(np.array(sorted(mine)[1:], float))
    return _Bins(cuts)


@dataclass
class BoostedTrees:
    """A fitted model; ``trees`` are in the order of their rounds, with their weights."""
    task: str
    base: float
    trees: list
    weights: list
    params: BoostParams

    def margin(self, features: Column) -> Column:
        """The sum of the trees' leaves; only the features that the trees use leave the JVM."""
        used = sorted({f for t in self.trees for f in t.feature if f >= 0})
        place = {f: k for k, f in enumerate(used)}
        trees, weights, base = self.trees, self.weights, self.base

        @F.pandas_udf("double")
        def walk(rows: pd.Series) -> pd.Series:
            x = np.stack(rows.to_numpy()) if len(rows) else np.zeros((0, len(used)))
            out = np.full(len(x), base)
            for t, w in zip(trees, weights):
                column, cut = np.array([place.get(f, 0) for f in t.feature]), np.array(t.cut)
                leaf = t.leaf_of(len(x), lambda row, node: x[row, column[node]] >= cut[node])
                out += w * np.array(t.value)[leaf]
            return pd.Series(out)

        if not used:
            return F.lit(base + sum(w * t.value[0] for t, w in zip(trees, weights)))
        dense = vector_to_array(features)
        wanted = F.array(*[dense[f] for f in used]) if len(used) <= 500 else \
            F.transform(F.array(*[F.lit(f + 1) for f in used]), lambda i: F.element_at(dense, i))
        return walk(wanted)

    def predict(self, features: Column) -> Column:
        """Probability of class 1, or the predicted value."""
        m = self.margin(features)
        return 1 / (1 + F.exp(-m)) if self.task == "classification" else m

    def write(self) -> "_Writer":
        return _Writer(self)

    def table(self, spark) -> DataFrame:
        """One row a tree: round, weight and nodes as JSON."""
        head = {"task": self.task, "base": self.base, "params": asdict(self.params)}
        rows = [(-1, 1.0, json.dumps(head))] + [(i, float(w), json.dumps(asdict(t))) for i, (t, w) in enumerate(zip(self.trees, self.weights))]
        return spark.createDataFrame(rows, "round int, weight double, content string")

    @staticmethod
    def load(spark, path: str) -> "BoostedTrees":
        rows = sorted(spark.read.parquet(path).collect())  # a row a tree
        head = json.loads(rows[0]["content"])
        return BoostedTrees(head["task"], head["base"], [Tree(**json.loads(r["content"])) for r in rows[1:]],
                            [r["weight"] for r in rows[1:]], BoostParams(**head["params"]))


@dataclass
class _Writer:
    model: BoostedTrees
    mode: str = "error"

    def overwrite(self) -> "_Writer":
        return _Writer(self.model, "overwrite")

    def save(self, path: str) -> None:
        from pyspark.sql import SparkSession

        self.model.table(SparkSession.getActiveSession()).coalesce(1).write.mode(self.mode).parquet(path)


def _margins(slots: np.ndarray, row: np.ndarray, n: int, bins: _Bins, trees: list[Tree], factors: list[float], leaf_of_last: bool):
    """(sum of factor * leaf over the trees, the last tree's leaf of each row) of rows given as slots."""
    used = sorted({f for t in trees for f in t.feature if f >= 0})
    place = np.full(len(bins.cuts), -1)
    place[used] = np.arange(len(used))
    feature = bins.feature[slots]
    mine = place[feature] >= 0
    value = np.tile(bins.zero[used], (n, 1))
    value[row[mine], place[feature[mine]]] = slots[mine] - bins.offset[feature[mine]]
    total, leaf = np.zeros(n), np.zeros(n, np.int64)
    for t, w in zip(trees, factors):
        column, cut = place[np.array(t.feature)], np.array(t.bin)
        leaf = t.leaf_of(n, lambda r, node: value[r, column[node]] > cut[node])
        total += w * np.array(t.value)[leaf]
    return total, leaf


def _batch(batch: pa.RecordBatch):
    slots = batch.column(2)
    size = np.diff(slots.offsets.to_numpy())
    return (batch.column(0).to_numpy(), batch.column(1).to_numpy(), slots.flatten().to_numpy(zero_copy_only=False).astype(np.int64),
            np.repeat(np.arange(batch.num_rows), size))


_SPLIT = "node int, gain double, feature int, bin int, gl double, hl double, g double, h double"


def _level(rows: DataFrame, bins: _Bins, p: BoostParams, task: str, recent: list, tree: Tree, nodes: list[int]) -> dict[int, tuple]:
    """node -> (gain, feature, bin, left g, left h, all g, all h): the best split of each open node.

    ``recent`` are (tree, factor) whose leaves the stored margins lack.
    """
    shared = rows.sparkSession.sparkContext.broadcast((bins, recent, tree, nodes))
    n_slots = int(bins.offset[-1])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, recent, tree, nodes = shared.value
        index = np.full(len(tree.feature), -1)
        index[nodes] = np.arange(len(nodes))
        g, h = np.zeros((len(nodes), n_slots)), np.zeros((len(nodes), n_slots))
        total = np.zeros((len(nodes), 2))
        for batch in batches:
            y, margin, slots, row = _batch(batch)
            more, leaf = _margins(slots, row, len(y), bins, [*[t for t, _ in recent], tree], [*[w for _, w in recent], 0.0], True)
            gradient, hessian = derivatives(y, margin + more, task)
            at = index[leaf]
            live = at >= 0
            for k, x in enumerate((gradient, hessian)):
                total[:, k] += np.bincount(at[live], x[live], len(nodes))
            keep = at[row] >= 0
            key = at[row[keep]] * n_slots + slots[keep]
            for out, x in ((g, gradient), (h, hessian)):
                out += np.bincount(key, x[row[keep]], len(nodes) * n_slots).reshape(out.shape)
        part = TaskContext.get().partitionId()
        for k, node in enumerate(nodes):
            if not total[k, 1]:
                continue
            for b, (lo, hi) in enumerate(bins.blocks):
                cut = slice(bins.offset[lo], bins.offset[hi])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x], kind) for x, kind in ((node, pa.int32()), (b, pa.int32()), (part, pa.int32()), (g[k, cut], pa.list_(pa.float64())),
                     (h[k, cut], pa.list_(pa.float64())), (total[k, 0], pa.float64()), (total[k, 1], pa.float64()))],
                    ["node", "block", "part", "g", "h", "tg", "th"])

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        bins = shared.value[0]
        pdf = pdf.sort_values("part")
        g, h = np.sum(np.stack(pdf["g"].to_numpy()), axis=0), np.sum(np.stack(pdf["h"].to_numpy()), axis=0)
        total_g, total_h = float(pdf["tg"].sum()), float(pdf["th"].sum())
        lo, hi = bins.blocks[int(pdf["block"].iloc[0])]
        best = (-np.inf, lo, 0, 0.0, 0.0)
        for f in range(lo, hi):
            at = slice(bins.offset[f] - bins.offset[lo], bins.offset[f + 1] - bins.offset[lo])
            fg, fh, z = g[at].copy(), h[at].copy(), bins.zero[f]
            fg[z], fh[z] = total_g - (fg.sum() - fg[z]), total_h - (fh.sum() - fh[z])
            gain, b, gl, hl = best_split(fg, fh, total_g, total_h, p)
            if better(gain, best[0]):
                best = (gain, f, b, gl, hl)
        return pd.DataFrame([(int(pdf["node"].iloc[0]), *best, total_g, total_h)], columns=[c.split()[0] for c in _SPLIT.split(", ")])

    found = rows.mapInArrow(sums, "node int, block int, part int, g array<double>, h array<double>, tg double, th double") \
        .groupBy("node", "block").applyInPandas(choose, _SPLIT).collect()  # a row a node and block of features
    out: dict[int, tuple] = {}
    for r in sorted(found, key=lambda r: (r["node"], r["feature"])):
        if r["node"] not in out or better(r["gain"], out[r["node"]][0]):
            out[r["node"]] = tuple(r)[1:]
    return out


def better(gain: float, than: float) -> bool:
    return gain > than if than == -np.inf else gain > than + TIE * (1 + abs(than))


def derivatives(y: np.ndarray, margin: np.ndarray, task: str) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and hessian of the loss by the margin."""
    if task == "classification":
        prob = 1 / (1 + np.exp(-margin))
        return prob - y, np.maximum(prob * (1 - prob), 1e-16)
    return margin - y, np.ones(len(y))


def _grow(rows: DataFrame, bins: _Bins, p: BoostParams, task: str, recent: list) -> Tree:
    tree, open_ = Tree(), [0]
    leaf = lambda g, h: float(-p.eta * soft(np.float64(g), p.alpha) / (h + p.reg_lambda))
    for depth in range(max(1, p.max_depth)):
        splits, later = _level(rows, bins, p, task, recent, tree, open_), []
        for node in open_:
            if node not in splits:
                continue
            gain, f, b, gl, hl, g, h = splits[node]
            if depth == 0:
                tree.value[0] = leaf(g, h)
            if gain <= MIN_GAIN or p.max_depth < 1:
                continue
            left, right = tree.add(), tree.add()
            tree.feature[node], tree.bin[node], tree.cut[node], tree.left[node] = f, b, float(bins.cuts[f][b]), left
            tree.value[left], tree.value[right] = leaf(gl, hl), leaf(g - gl, h - hl)
            later += [left, right]
        open_ = later
        if not open_:
            break
    return tree


def _refreshed(rows: DataFrame, bins: _Bins, recent: list) -> DataFrame:
    """Rows with the leaves of ``recent`` added to their margins, stored."""
    shared = rows.sparkSession.sparkContext.broadcast((bins, recent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, recent = shared.value
        for batch in batches:
            y, margin, slots, row = _batch(batch)
            more, _ = _margins(slots, row, len(y), bins, [t for t, _ in recent], [w for _, w in recent], False)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(margin + more), batch.column(2)], batch.schema.names)

    return store(rows.mapInArrow(run, "y double, margin double, slots array<int>"), "boost-rows")


def fit(df: DataFrame, task: str, params: BoostParams, features: str = "features", label: str = "label") -> BoostedTrees:
    """Boosted trees of ``df``; labels of a classification are 0 and 1."""
    p = params
    if p.booster not in ("gbtree", "dart"):
        raise ValueError(f"unknown booster {p.booster!r}")
    bins = find_bins(df, features, p.max_bins)
    base = float(np.log(p.base_score / (1 - p.base_score))) if task == "classification" else p.base_score
    shared = df.sparkSession.sparkContext.broadcast(bins)

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = shared.value
        for batch in batches:
            e = batch.column(1)
            f, x = (a.to_numpy(zero_copy_only=False) for a in e.flatten().flatten())
            size, bin_ = np.diff(e.offsets.to_numpy()), np.empty(len(f), np.int64)
            order = np.argsort(f, kind="stable")
            kinds, first = np.unique(f[order], return_index=True)
            for k, lo, hi in zip(kinds, first, np.append(first[1:], len(f))):
                bin_[order[lo:hi]] = np.searchsorted(bins.cuts[k], x[order[lo:hi]], side="right")
            keep = bin_ != bins.zero[f]
            row = np.repeat(np.arange(len(size)), size)[keep]
            ends = np.append(0, np.cumsum(np.bincount(row, minlength=len(size)))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(len(size), base)),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array((bins.offset[f] + bin_)[keep].astype(np.int32)))], ["y", "margin", "slots"])

    rows = store(df.select(qcol(label).cast("double").alias("y"), _entries(features).alias("e")).mapInArrow(
        slots, "y double, margin double, slots array<int>"), "boost-rows")
    trees, weights, recent, rng = [], [], [], np.random.default_rng(p.seed)
    for _ in range(p.num_round):
        dropped = np.flatnonzero(rng.random(len(trees)) < p.rate_drop) if p.booster == "dart" else []
        tree = _grow(rows, bins, p, task, [*recent, *[(trees[i], -weights[i]) for i in dropped]])
        k = len(dropped)
        trees.append(tree)
        weights.append(1 / (k + p.eta) if k else 1.0)
        recent.append((tree, weights[-1]))
        for i in dropped:
            new = weights[i] * k / (k + p.eta)
            recent.append((trees[i], new - weights[i]))
            weights[i] = new
        if len(recent) >= REFRESH:
            last, rows, recent = rows, _refreshed(rows, bins, recent), []
            drop_stored(last)
    drop_stored(rows)
    return BoostedTrees(task, base, trees, weights, p)


__all__ = ["BoostParams", "BoostedTrees", "fit"]
