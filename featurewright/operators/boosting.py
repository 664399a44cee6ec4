"""Histogram gradient boosting on the cluster.

One model of joint multiclass boosting (softmax over all classes, one tree per
class and round) and one of best-first regression trees, both grown from
gradient / hessian histograms per (class, node, feature, bin).

* Features are binned once against cut points; rows are packed into blocks of
  bins, label, weight and margins, written to the shared folder.
* A histogram is one job: every task adds up its blocks and emits one partial
  histogram, partials are added in groups, and at most ``FAN`` of them reach the
  driver.  Their size is that of the model (nodes x features x bins), not of the data.
* Only the smaller child of a split is counted; its sibling is the parent minus it.
* Best-first growth does not need a job a split: all splits that would be made as
  far as gains are known are evaluated together, until the choice no longer changes.
  The trees are those of one split at a time.
* Gradients are added as whole numbers of a fixed step, so sums do not depend on
  the order of tasks and a repeated or retried fit gives the same trees.
* Margins of finished rounds are stored with the blocks every ``REFRESH`` rounds;
  jobs apply the trees since.  A lost executor costs its tasks of one job.

Rows without a label or with a null or not positive weight take no part in a fit.
Null and NaN features are a bin of their own; each split sends them to the better side.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurewright.session import remove_path, scratch_path

BLOCK_ROWS, FAN, REFRESH = 1 << 16, 32, 10
#: Blocks of one Arrow batch: what a Python worker holds at once, however long its partition is.
BATCH_BLOCKS = 4


@dataclass(frozen=True)
class BoostConfig:
    """``max_leaves`` None grows level by level to ``max_depth``; with it, best-first by gain."""

    objective: str = "softprob"  # or "squared"
    num_class: int = 1
    rounds: int = 100
    eta: float = 0.3
    max_depth: int | None = 3
    max_leaves: int | None = None
    reg_lambda: float = 1.0
    min_child_weight: float = 1.0
    min_child_rows: int = 1
    max_bins: int = 64


#: The reference's settings: depth 3, step 0.3, 100 rounds; 32 leaves, 100 rounds.
SOFTMAX = BoostConfig(num_class=5)
LEAFWISE = BoostConfig("squared", eta=0.1, max_depth=None, max_leaves=32, reg_lambda=0.0, min_child_weight=1e-3,
                       min_child_rows=20, max_bins=255)


@dataclass
class Tree:
    """Nodes in lists; ``feature`` -1 marks a leaf.  Left holds bins up to ``bin``: values below ``threshold``."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    threshold: list[float] = field(default_factory=lambda: [0.0])
    missing_left: list[bool] = field(default_factory=lambda: [False])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def leaves(self) -> int:
        return sum(f < 0 for f in self.feature)

    def depth(self, node: int = 0) -> int:
        return 0 if self.feature[node] < 0 else 1 + max(self.depth(self.left[node]), self.depth(self.right[node]))

    def _walk(self, n: int, left_of) -> np.ndarray:
        feature, left, right = np.array(self.feature), np.array(self.left), np.array(self.right)
        at = np.zeros(n, np.int64)
        open_ = np.arange(n) if feature[0] >= 0 else np.arange(0)
        while len(open_):
            node = at[open_]
            at[open_] = np.where(left_of(feature[node], node, open_), left[node], right[node])
            open_ = open_[feature[at[open_]] >= 0]
        return at

    def node_of_bins(self, bins: np.ndarray, missing: int) -> np.ndarray:
        """The leaf of each row; ``bins`` is (features, rows)."""
        cut, side = np.array(self.bin), np.array(self.missing_left)

        def left_of(f, node, rows):
            b = bins[f, rows]
            return np.where(b == missing, side[node], b <= cut[node])

        return self._walk(bins.shape[1], left_of)

    def node_of_values(self, values: np.ndarray) -> np.ndarray:
        """The leaf of each row of raw features, (rows, features)."""
        cut, side = np.array(self.threshold), np.array(self.missing_left)

        def left_of(f, node, rows):
            v = values[rows, f]
            return np.where(np.isnan(v), side[node], v < cut[node])

        return self._walk(len(values), left_of)


@dataclass
class BoostModel:
    config: BoostConfig
    features: list[str]
    cuts: list[list[float]]
    base: list[float]
    rounds: list[list[Tree]]

    def margins(self, values: np.ndarray) -> np.ndarray:
        out = np.tile(np.array(self.base), (len(values), 1))
        for trees in self.rounds:
            for k, t in enumerate(trees):
                out[:, k] += np.array(t.value)[t.node_of_values(values)]
        return out

    def score(self, df: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
        """Keep columns with ``prediction``; softmax models add ``raw_scores`` and ``probabilities``."""
        model = self

        @F.pandas_udf("array<double>")
        def margin(x: pd.DataFrame) -> pd.Series:
            return pd.Series(list(model.margins(x.to_numpy(dtype="float64", na_value=np.nan))))

        cols = list(keep) if keep is not None else list(df.columns)
        raw = margin(F.struct(*[F.col(f).cast("double").alias(f"f{i}") for i, f in enumerate(self.features)]))
        out = df.select(*cols, raw.alias("raw_scores"))
        if self.config.objective == "squared":
            return out.select(*cols, F.element_at("raw_scores", 1).alias("prediction"))
        top = F.array_max("raw_scores")
        powers = F.transform("raw_scores", lambda m: F.exp(m - top))
        total = F.aggregate(powers, F.lit(0.0), lambda a, p: a + p)
        return out.select(*cols, (F.array_position("raw_scores", top) - 1).cast("double").alias("prediction"), "raw_scores",
                          F.transform(powers, lambda p: p / total).alias("probabilities"))

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> BoostModel:
        d = json.loads(text)
        return BoostModel(BoostConfig(**d["config"]), d["features"], d["cuts"], d["base"], [[Tree(**t) for t in r] for r in d["rounds"]])


def cut_points(df: DataFrame, features: Sequence[str], max_bins: int) -> list[list[float]]:
    """Up to ``max_bins`` - 1 rising cuts per feature from approximate quantiles (driver: features x bins numbers)."""
    probabilities = [i / max_bins for i in range(1, max_bins)]
    found = df.select(*[F.col(f).cast("double").alias(f) for f in features]).approxQuantile(list(features), probabilities, 1 / (4 * max_bins))
    return [sorted({v for v in q if v is not None and math.isfinite(v)}) for q in found]


def binned(values: np.ndarray, cuts: Sequence[float], missing: int) -> np.ndarray:
    """Bin b holds cuts[b - 1] <= value < cuts[b]; NaN goes to the bin ``missing``."""
    return np.where(np.isnan(values), missing, np.searchsorted(np.asarray(cuts, float), values, side="right"))


def gradients(objective: str, margins: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, classes) first and second derivatives of the loss."""
    if objective == "squared":
        return (margins - label[:, None]) * weight[:, None], np.broadcast_to(weight[:, None], margins.shape)
    p = np.exp(margins - margins.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    hot = label[:, None].astype(np.int64) == np.arange(margins.shape[1])
    return (p - hot) * weight[:, None], 2 * p * (1 - p) * weight[:, None]


# --- blocks of rows -------------------------------------------------------------

_BLOCK = "bins binary, label binary, weight binary, margins binary"


def _pack(cuts: list[list[float]], missing: int, base: list[float], dtype):
    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, BLOCK_ROWS):
                part = b.slice(lo, BLOCK_ROWS).to_pandas()
                label, weight = part.iloc[:, 0].to_numpy(float), part.iloc[:, 1].to_numpy(float)
                bins = np.array([binned(part.iloc[:, j + 2].to_numpy(float), c, missing) for j, c in enumerate(cuts)], dtype).reshape(len(cuts), -1)
                margins = np.tile(np.array(base, float), (len(part), 1))
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (bins, label, weight, margins)], ["bins", "label", "weight", "margins"])

    return run


def _blocks(batches, features: int, classes: int, dtype):
    for b in batches:
        for i in range(b.num_rows):
            row = b.slice(i, 1).to_pylist()[0]
            label = np.frombuffer(row["label"])
            yield row, np.frombuffer(row["bins"], dtype).reshape(features, len(label)), label, np.frombuffer(row["weight"]), np.frombuffer(row["margins"]).reshape(-1, classes)


@contextmanager
def _few_blocks(spark):
    """While a job on the blocks runs, its Arrow batches are of ``BATCH_BLOCKS`` rows; by default a task's blocks would all be in one."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(BATCH_BLOCKS))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _advanced(bins: np.ndarray, margins: np.ndarray, rounds: list[list[Tree]], missing: int) -> np.ndarray:
    out = margins.copy()
    for trees in rounds:
        for k, t in enumerate(trees):
            out[:, k] += np.array(t.value)[t.node_of_bins(bins, missing)]
    return out


class Trainer:
    """State of one fit: the stored blocks, the trees since they were stored, and the step of the whole numbers."""

    def __init__(self, df: DataFrame, features: Sequence[str], label: str, config: BoostConfig, weight: str | None = None,
                 cuts: list[list[float]] | None = None):
        self.spark, self.config, self.features = df.sparkSession, config, list(features)
        w = F.col(weight).cast("double") if weight else F.lit(1.0)
        rows = df.select(F.col(label).cast("double").alias("y"), w.alias("w"), *[F.col(f).cast("double").alias(f"f{i}") for i, f in enumerate(features)])
        rows = rows.where("y IS NOT NULL AND NOT isnan(y) AND w > 0 AND w < double('inf')")
        if config.objective == "softprob":
            bad = rows.where((F.col("y") < 0) | (F.col("y") >= config.num_class) | (F.col("y") != F.floor("y"))).limit(1).collect()
            if bad:
                raise ValueError(f"label {bad[0]['y']} is not a class from 0 to {config.num_class - 1}")
        stats = rows.agg(F.count("*").alias("n"), F.max("w").alias("w"), F.min("y").alias("lo"), F.max("y").alias("hi"),
                         F.try_divide(F.sum(F.col("y") * F.col("w")), F.sum("w")).alias("mean")).first()
        if not stats["n"]:
            raise ValueError("no row has a label and a positive weight")
        self.cuts = cuts if cuts is not None else cut_points(rows.toDF("y", "w", *self.features), self.features, config.max_bins)
        self.missing = max((len(c) for c in self.cuts), default=0) + 1
        self.dtype = np.uint8 if self.missing < 256 else np.uint16
        squared = config.objective == "squared"
        self.classes = 1 if squared else config.num_class
        self.base = [float(stats["mean"])] if squared else [0.0] * self.classes
        largest = max(abs(stats["lo"] - stats["mean"]), abs(stats["hi"] - stats["mean"]), 1.0) if squared else 2.0
        # whole numbers of 2^-shift: sums over all rows stay below 2^62, with room for margins that grow
        self.shift = 52 - math.ceil(math.log2(stats["n"])) - math.ceil(math.log2(largest * stats["w"]))
        self.path = scratch_path(self.spark, "boost-blocks")
        rows.mapInArrow(_pack(self.cuts, self.missing, self.base, self.dtype), _BLOCK).write.parquet(self.path)
        self._opened()
        self.pending: list[list[Tree]] = []
        self.jobs = 0

    def histograms(self, trees: list[Tree], wanted: list[list[int]]) -> list[np.ndarray]:
        """Per class an array (nodes wanted, features, bins and missing, (gradient, hessian, rows)) of whole numbers."""
        shape = [(len(w), len(self.cuts), self.missing + 1, 3) for w in wanted]
        config, missing, shift, dtype, pending, classes = self.config, self.missing, self.shift, self.dtype, self.pending, self.classes
        features = len(self.cuts)
        self.jobs += 1

        def run(batches):
            total = [np.zeros(s, np.int64) for s in shape]
            for _, bins, label, weight, stored in _blocks(batches, features, classes, dtype):
                g, h = gradients(config.objective, _advanced(bins, stored, pending, missing), label, weight)
                for k, nodes in enumerate(wanted):
                    if not nodes:
                        continue
                    slot = np.full(len(trees[k].feature), -1)
                    slot[nodes] = np.arange(len(nodes))
                    slot = slot[trees[k].node_of_bins(bins, missing)]
                    rows = np.flatnonzero(slot >= 0)
                    gi, hi = np.rint(np.ldexp(g[rows, k], shift)), np.rint(np.ldexp(h[rows, k], shift))
                    for f in range(features):
                        at = slot[rows] * (missing + 1) + bins[f, rows]
                        for c, x in enumerate((gi, hi, None)):  # sums of a block are exact in doubles
                            total[k][:, f, :, c] += np.bincount(at, x, len(nodes) * (missing + 1)).astype(np.int64).reshape(len(nodes), -1)
            blob = b"".join(t.tobytes() for t in total)
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([blob], pa.binary())], ["part", "total"])

        def add(t: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(x, np.int64) for x in t.column("total").to_pylist())
            return pa.table({"total": pa.array([total.tobytes()], pa.binary())})

        partial = self.blocks.mapInArrow(run, "part int, total binary")
        if self.parts > FAN:
            partial = partial.groupBy(F.pmod("part", F.lit(FAN)).alias("shard")).applyInArrow(add, "total binary")
        with _few_blocks(self.spark):
            parts = partial.select("total").collect()
        found = sum(np.frombuffer(r["total"], np.int64) for r in parts)
        ends = np.cumsum([math.prod(s) for s in shape])
        return [x.reshape(s) for x, s in zip(np.split(found, ends[:-1]), shape)]

    def best_split(self, hist: np.ndarray, sums: np.ndarray) -> tuple[float, int, int, bool] | None:
        """(gain, feature, bin, missing goes left) of a node's histogram; ties to the first feature, bin and right."""
        c = self.config
        if hist.shape[0] == 0 or hist.shape[1] < 3:
            return None
        g_all, h_all, _ = self._real(sums)
        through = np.cumsum(hist[:, :-1], axis=1)[:, :-1]  # (features, cuts, 3)
        left = np.stack([through, through + hist[:, -1:, :]], axis=2)
        right = sums - left
        gl, hl, nl = self._real(left)
        gr, hr, nr = self._real(right)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = gl**2 / (hl + c.reg_lambda) + gr**2 / (hr + c.reg_lambda) - g_all**2 / (h_all + c.reg_lambda)
        rows = max(c.min_child_rows, 1)
        allowed = (hl >= c.min_child_weight) & (hr >= c.min_child_weight) & (nl >= rows) & (nr >= rows)
        gain = np.where(allowed, gain, -np.inf)
        f, b, side = np.unravel_index(int(np.argmax(gain)), gain.shape)
        return (float(gain[f, b, side]), int(f), int(b), bool(side)) if gain[f, b, side] > 1e-6 else None

    def _real(self, sums: np.ndarray):
        return np.ldexp(sums[..., 0].astype(float), -self.shift), np.ldexp(sums[..., 1].astype(float), -self.shift), sums[..., 2]

    def grow(self) -> list[Tree]:
        """One round: a tree per class, all classes in the same jobs."""
        growing = [_Growing(self) for _ in range(self.classes)]
        while any(wanted := [g.wanted() for g in growing]):
            for g, hist in zip(growing, self.histograms([g.tree for g in growing], wanted)):
                g.take(hist)
        trees = [g.finished() for g in growing]
        self.pending.append(trees)
        if len(self.pending) >= REFRESH:
            self._store()
        return trees

    def _store(self) -> None:
        pending, missing, features, classes, dtype = self.pending, self.missing, len(self.cuts), self.classes, self.dtype

        def run(batches):
            for row, bins, _, _, stored in _blocks(batches, features, classes, dtype):
                row["margins"] = _advanced(bins, stored, pending, missing).tobytes()
                yield pa.RecordBatch.from_pylist([row], schema=pa.schema([(n, pa.binary()) for n in ("bins", "label", "weight", "margins")]))

        old, self.path = self.path, scratch_path(self.spark, "boost-blocks")
        with _few_blocks(self.spark):
            self.blocks.mapInArrow(run, _BLOCK).write.parquet(self.path)
        self._opened()
        remove_path(self.spark, old)
        self.pending = []

    def _opened(self) -> None:
        self.blocks = self.spark.read.schema(_BLOCK).parquet(self.path)
        self.parts = self.blocks.rdd.getNumPartitions()

    def fit(self) -> BoostModel:
        try:
            rounds = [self.grow() for _ in range(self.config.rounds)]
        finally:
            remove_path(self.spark, self.path)
        return BoostModel(self.config, self.features, self.cuts, self.base, rounds)


class _Growing:
    """A tree in growth.  Splits are tried ahead; ``_chosen`` says which of them the growth order makes."""

    def __init__(self, trainer: Trainer):
        self.t, self.tree = trainer, Tree()
        self.hist: dict[int, np.ndarray] = {}
        self.sums: dict[int, np.ndarray] = {}
        self.split: dict[int, tuple | None] = {}
        self.level = {0: 0}
        self.asked: list[tuple[int, int | None]] = [(0, None)]  # (node to count, its sibling)
        self.parent: dict[int, int] = {}

    def wanted(self) -> list[int]:
        return [n for n, _ in self.asked]

    def take(self, found: np.ndarray) -> None:
        for (node, sibling), hist in zip(self.asked, found):
            self._known(node, hist)
            if sibling is not None:
                self._known(sibling, self.hist[self.parent[node]] - hist)
        self.asked = []
        while True:  # splits whose children need no histogram are made at once
            new = [n for n in self._chosen() if self.tree.feature[n] < 0]
            for n in new:
                self._open(n)
            if not new or self.asked:
                return

    def _known(self, node: int, hist: np.ndarray) -> None:
        self.hist[node] = hist
        self.sums[node] = hist[0].sum(axis=0) if len(hist) else np.zeros(3, np.int64)
        self.split[node] = self.t.best_split(hist, self.sums[node]) if self._may_split(node) else None

    def _may_split(self, node: int) -> bool:
        limit = self.t.config.max_depth
        return limit is None or self.level[node] < limit

    def _open(self, node: int) -> None:
        """Make the node's split and ask for the smaller child's histogram, if it can be split further."""
        tree, (gain, f, b, side) = self.tree, self.split[node]
        tree.feature[node], tree.bin[node], tree.threshold[node], tree.missing_left[node], tree.gain[node] = f, b, self.t.cuts[f][b], side, gain
        tree.left[node], tree.right[node] = len(tree.feature), len(tree.feature) + 1
        hist = self.hist[node]
        left = hist[f, :b + 1].sum(axis=0) + (hist[f, -1] if side else 0)
        for child, sums in ((tree.left[node], left), (tree.right[node], self.sums[node] - left)):
            for name, value in (("feature", -1), ("bin", 0), ("threshold", 0.0), ("missing_left", False), ("left", -1), ("right", -1), ("value", 0.0), ("gain", 0.0)):
                getattr(tree, name).append(value)
            self.level[child], self.parent[child], self.sums[child] = self.level[node] + 1, node, sums
        a, b2 = tree.left[node], tree.right[node]
        if self._may_split(a):
            self.asked.append((a, b2) if self.sums[a][2] <= self.sums[b2][2] else (b2, a))
        else:
            self.split[a] = self.split[b2] = None

    def _chosen(self) -> list[int]:
        """The splits in growth order, as far as they are known: best gain first, of ties the older node."""
        c = self.t.config
        limit = c.max_leaves - 1 if c.max_leaves else math.inf
        out, frontier = [], [0]
        while frontier and len(out) < limit:
            able = [n for n in frontier if self.split.get(n)]
            if not able:
                break
            node = max(able, key=lambda n: (self.split[n][0], -n))
            frontier.remove(node)
            out.append(node)
            if self.tree.feature[node] >= 0:
                frontier += [self.tree.left[node], self.tree.right[node]]
        return out

    def finished(self) -> Tree:
        """The tree of the chosen splits alone, with leaf values."""
        chosen, c, out = set(self._chosen()), self.t.config, Tree([], [], [], [], [], [], [], [])

        def copy(node: int) -> int:
            at, src = len(out.feature), self.tree
            inner = node in chosen
            g, h, _ = self.t._real(self.sums[node])
            leaf = 0.0 if inner or h + c.reg_lambda == 0 else float(-g / (h + c.reg_lambda) * c.eta)
            for name, value in (("feature", src.feature[node] if inner else -1), ("bin", src.bin[node] if inner else 0),
                                ("threshold", src.threshold[node] if inner else 0.0), ("missing_left", bool(inner and src.missing_left[node])),
                                ("left", -1), ("right", -1), ("value", leaf), ("gain", src.gain[node] if inner else 0.0)):
                getattr(out, name).append(value)
            if inner:
                out.left[at] = copy(src.left[node])
                out.right[at] = copy(src.right[node])
            return at

        copy(0)
        return out


def train_softmax(df: DataFrame, features: Sequence[str], label: str, config: BoostConfig = SOFTMAX, weight: str | None = None,
                  cuts: list[list[float]] | None = None) -> BoostModel:
    """Joint multiclass boosting; labels are whole numbers from 0 to num_class - 1."""
    return Trainer(df, features, label, config, weight, cuts).fit()


def train_leafwise(df: DataFrame, features: Sequence[str], label: str, config: BoostConfig = LEAFWISE, weight: str | None = None,
                   cuts: list[list[float]] | None = None) -> BoostModel:
    """Boosted regression with best-first trees."""
    return Trainer(df, features, label, config, weight, cuts).fit()


def root_histogram(df: DataFrame, features: Sequence[str], label: str, config: BoostConfig, cuts: list[list[float]]) -> DataFrame:
    """Class, feature, bin (the last: missing), gradient and hessian sums, rows: what the first split is chosen from."""
    t = Trainer(df, features, label, config, cuts=cuts)
    try:
        found = t.histograms([Tree()] * t.classes, [[0]] * t.classes)
    finally:
        remove_path(t.spark, t.path)
    rows = [(k, t.features[f], b, float(np.ldexp(float(hist[0, f, b, 0]), -t.shift)), float(np.ldexp(float(hist[0, f, b, 1]), -t.shift)), int(hist[0, f, b, 2]))
            for k, hist in enumerate(found) for f in range(len(t.cuts)) for b in range(t.missing + 1) if hist[0, f, b, 2]]
    return t.spark.createDataFrame(rows, "class int, feature string, bin int, gradient double, hessian double, n bigint")


def log_loss(scored: DataFrame, label: str, probabilities: str = "probabilities") -> DataFrame:
    """One row: mean of -log of the probability of the actual class."""
    p = F.element_at(F.col(probabilities), (F.col(label) + 1).cast("int"))
    return scored.agg(F.avg(-F.log(F.greatest(p, F.lit(1e-15)))).alias("log_loss"))
