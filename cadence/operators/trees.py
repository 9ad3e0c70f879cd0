"""Boosted trees and forests of many rows (M-2, M-3): MLlib's algorithms on binned
blocks of rows.

MLlib walks row by row through boxed structures, about a microsecond for every
row, tree and level, which is most of a fit from some 100,000 rows on. Here a task
holds its rows as arrays of bins (one byte a value, MLlib's own candidate splits)
and counts them into the bins of all open nodes at once. The driver, or for
forests the reducers, get one histogram per node and task, never rows.

The steps are MLlib's: candidate splits (``RandomForest.findSplits``), feature
subsets per node, row samples of a boosted round (the same random numbers for the
same tasks), gains, leaf rules and pruning, so a boosted model equals MLlib's up to
the order of sums. Rows of a forest's tree are drawn by NumPy's Poisson generator,
seeded by seed, tree and block, in place of MLlib's: the same distribution, other
draws. Results are ordinary MLlib models, built by MLlib's loader.
"""

from __future__ import annotations

import functools
import json
import math
import os
import pickle
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassificationModel, GBTClassifier, RandomForestClassificationModel, RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.ml.util import DefaultParamsWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.session import ensure_checkpoint_dir

#: Rows of a block; a task works through its blocks one by one.
BLOCK_ROWS = 250_000
#: Rows counted at once, so that their keys stay in the processor's cache.
CHUNK = 32_768
#: Rounds between two checkpoints of the margins (MLlib's ``checkpointInterval``).
LINEAGE = 10
#: Partitions whose histograms the driver adds up itself.
DIRECT = 64

_LOW = (1 << 64) - 1


# --- MLlib's random numbers

def _signed(x: int) -> int:
    x &= _LOW
    return x - (1 << 64) if x >> 63 else x


def _murmur(data: bytes, h: int) -> int:
    """MurmurHash3 of whole words."""
    for i in range(0, len(data), 4):
        k = int.from_bytes(data[i:i + 4], "little") * 0xCC9E2D51 & 0xFFFFFFFF
        k = ((k << 15 | k >> 17) & 0xFFFFFFFF) * 0x1B873593 & 0xFFFFFFFF
        h ^= k
        h = ((h << 13 | h >> 19) & 0xFFFFFFFF) * 5 + 0xE6546B64 & 0xFFFFFFFF
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
    return h ^ h >> 16


def hash_seed(seed: int) -> int:
    """First state of ``XORShiftRandom``."""
    data = (seed & _LOW).to_bytes(8, "big")
    low = _murmur(data, 0x3C074A61)
    return _murmur(data, low) << 32 | low


def _step(x):
    """``XORShiftRandom``'s next state, of one number or an array."""
    x = x ^ (x << 21 & _LOW if isinstance(x, int) else x << np.uint64(21))
    x = x ^ (x >> 35 if isinstance(x, int) else x >> np.uint64(35))
    return x ^ (x << 4 & _LOW if isinstance(x, int) else x << np.uint64(4))


def _times(matrix: np.ndarray, x: np.ndarray) -> np.ndarray:
    """A linear map of 64-bit words (its 64 columns), applied to an array."""
    out = np.zeros_like(x)
    for b in range(64):
        out ^= np.where(x >> np.uint64(b) & np.uint64(1), matrix[b], np.uint64(0))
    return out


@functools.cache
def _leap(power: int) -> np.ndarray:
    """The generator is linear: columns of its map of 2 ** power steps."""
    if not power:
        return _step(np.uint64(1) << np.arange(64, dtype=np.uint64))
    return _times(_leap(power - 1), _leap(power - 1))


@functools.cache
def _tables(power: int) -> np.ndarray:
    """The same map as eight tables, one for each byte of a state."""
    return np.stack([_times(_leap(power), np.arange(256, dtype=np.uint64) << np.uint64(8 * i)) for i in range(8)])


def _leapt(power: int, x: np.ndarray) -> np.ndarray:
    out = np.zeros_like(x)
    for i, table in enumerate(_tables(power)):
        out ^= table[(x >> np.uint64(8 * i) & np.uint64(255)).astype(np.intp)]
    return out


def uniforms(seed: int, first: int, n: int) -> np.ndarray:
    """Doubles ``first`` to ``first + n`` of ``XORShiftRandom(seed)``, two steps
    each, from lanes that start 2 ** 5 doubles apart."""
    lane, state = 5, np.array([hash_seed(seed)], np.uint64)
    for power in range((2 * first).bit_length()):
        if 2 * first >> power & 1:
            state = _leapt(power, state)
    lanes, power = -(-n >> lane), lane + 1
    while len(state) < lanes:
        state, power = np.concatenate([state, _leapt(power, state)]), power + 1
    state, out = state[:lanes], np.empty((1 << lane, lanes))
    low, high = np.uint64((1 << 26) - 1), np.uint64((1 << 27) - 1)
    for i in range(1 << lane):
        state = _step(state)
        head = (state & low) << np.uint64(27)
        state = _step(state)
        out[i] = (head + (state & high)) * 2.0 ** -53
    return out.T.ravel()[:n]


class _JavaRandom:
    def __init__(self, seed: int):
        self.x = (seed ^ 0x5DEECE66D) & ((1 << 48) - 1)

    def _next(self) -> int:
        self.x = (self.x * 0x5DEECE66D + 0xB) & ((1 << 48) - 1)
        y = self.x >> 16
        return y - (1 << 32) if y >> 31 else y

    def long(self) -> int:
        return _signed((self._next() << 32) + self._next())


def feature_subset(seed: int, n: int, k: int) -> list[int]:
    """``SamplingUtils.reservoirSampleAndCount`` of n features."""
    out, x = list(range(k)), hash_seed(seed)
    for i in range(k, n):
        x = _step(x)
        head = (x & ((1 << 26) - 1)) << 27
        x = _step(x)
        at = int((head + (x & ((1 << 27) - 1))) * 2.0 ** -53 * (i + 1))
        if at < k:
            out[at] = i
    return out


# --- rows as blocks of bins

def candidate_splits(est, train: DataFrame) -> list[np.ndarray]:
    """MLlib's thresholds of each feature for this estimator and these rows."""
    jvm = train.sparkSession.sparkContext._jvm
    est._transfer_params_to_java()
    utils, impl = jvm.org.apache.spark.ml.util, jvm.org.apache.spark.ml.tree.impl
    instances = getattr(getattr(utils, "DatasetUtils$"), "MODULE$").extractInstances(est._java_obj, train._jdf, jvm.scala.Option.apply(2))
    strategy = jvm.org.apache.spark.mllib.tree.configuration.Strategy.defaultStrategy("Classification")
    strategy.setMaxBins(est.getMaxBins())
    metadata = getattr(getattr(impl, "DecisionTreeMetadata$"), "MODULE$").buildMetadata(instances, strategy, 1, "all")
    found = getattr(getattr(impl, "RandomForest$"), "MODULE$").findSplits(instances, metadata, est.getSeed())
    return [np.array([s.threshold() for s in one], float) for one in found]


def blocks(est, train: DataFrame, points: list[np.ndarray], by_row: bool) -> RDD:
    """``(task, first row, doubled bins, is positive)`` per block of a task's rows;
    bins by row or by feature."""
    width = len(points)

    def go(batches: Iterator) -> Iterator:
        import pyarrow as pa

        first, held, n = 0, [], 0

        def block():
            bins, positive = (np.concatenate(a) for a in zip(*held, strict=True))
            bins = bins if by_row else np.ascontiguousarray(bins.T)
            return pa.RecordBatch.from_arrays([pa.array([pickle.dumps((first, bins, positive), 5)], pa.binary())], ["block"])

        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            bins = np.empty(x.shape, np.uint8)
            for f, cuts in enumerate(points):
                bins[:, f] = 2 * np.searchsorted(cuts, x[:, f])
            held.append((bins, batch.column(1).to_numpy(zero_copy_only=False) > 0))
            n += len(bins)
            if n >= BLOCK_ROWS:
                yield block()
                first, held, n = first + n, [], 0
        if n:
            yield block()

    rows = train.select(vector_to_array(est.getFeaturesCol()).alias("x"), F.col(est.getLabelCol()).cast("double").alias("y"))
    return rows.mapInArrow(go, "block binary").rdd.mapPartitionsWithIndex(
        lambda task, found: ((task, *pickle.loads(r[0])) for r in found))


def walk(bins: np.ndarray, at: np.ndarray, feature: np.ndarray, cut: np.ndarray, levels: int) -> np.ndarray:
    """Nodes (1: root, children 2i and 2i + 1) after ``levels`` steps of rows, whose
    bin of feature f is at ``at + f`` (by row) or ``at + f * len`` in ``bins``."""
    node = np.ones(len(at), np.int64)
    for _ in range(levels):
        f = feature[node]
        right = bins[at + np.maximum(f, 0)] > cut[node]
        node = np.where(f < 0, node, 2 * node + right)
    return node


# --- trees

class Tree:
    """A tree that grows by levels: arrays over nodes 1, 2, 3, ..., by which rows
    are placed, and the facts of each node."""

    def __init__(self, depth: int):
        self.feature = np.full(2 << depth, -1, np.int64)
        self.cut = np.zeros(2 << depth, np.int64)
        self.value = np.zeros(2 << depth)
        self.facts: dict[int, dict] = {}
        self.open = [1]

    def split(self, node: int, feature: int, place: int, threshold: float, gain: float) -> None:
        self.feature[node], self.cut[node] = feature, 2 * place
        self.facts[node] |= {"gain": gain, "threshold": threshold}

    def pruned(self) -> set[int]:
        """Inner nodes of the final tree: siblings that are leaves and predict the
        same are their parent's (MLlib prunes them)."""
        inner = {n for n in self.facts if self.feature[n] >= 0}
        for n in sorted(inner, reverse=True):
            if not {2 * n, 2 * n + 1} & inner and self.facts[2 * n]["prediction"] == self.facts[2 * n + 1]["prediction"]:
                inner.discard(n)
        return inner

    def rows(self, th: int) -> list[tuple]:
        """The node rows of MLlib's model files, ids in preorder."""
        inner, out = self.pruned(), []

        def add(n: int) -> int:
            f, i = self.facts[n], len(out)
            leaf = n not in inner
            out.append(None)
            left, right = (-1, -1) if leaf else (add(2 * n), add(2 * n + 1))
            cut = (-1, [], -1) if leaf else (int(self.feature[n]), [float(f["threshold"])], -1)
            out[i] = (th, (i, float(f["prediction"]), float(f["impurity"]), [float(x) for x in f["stats"]], int(f["raw"]),
                           -1.0 if leaf else float(f["gain"]), left, right, cut))
            return i

        add(1)
        return out


_NODES = ("treeID int, nodeData struct<id:int,prediction:double,impurity:double,impurityStats:array<double>,rawCount:bigint,"
          "gain:double,leftChild:int,rightChild:int,split:struct<featureIndex:int,leftCategoriesOrThreshold:array<double>,numCategories:int>>")


def _model(est, train: DataFrame, loader, trees: list[Tree], weights: list[float], width: int):
    """MLlib's model of these trees, through its files and loader."""
    spark = train.sparkSession
    sc = spark.sparkContext
    boosted = loader is GBTClassificationModel
    one = (DecisionTreeRegressor if boosted else DecisionTreeClassifier)()
    one._set(**{p.name: v for p, v in est.extractParamMap().items() if one.hasParam(p.name) and p.name != "impurity"})

    def meta(what, name: str, more: dict) -> str:
        said = json.loads(DefaultParamsWriter._get_metadata_to_save(what, sc))
        said["paramMap"].pop("leafCol", None)
        return json.dumps(said | {"class": f"org.apache.spark.ml.{name}"} | more)

    kind = "regression.DecisionTreeRegressionModel" if boosted else "classification.DecisionTreeClassificationModel"
    more = {"numFeatures": width} | ({} if boosted else {"numClasses": 2})
    path = os.path.join(ensure_checkpoint_dir(spark), f"trees-{uuid.uuid4().hex}")
    whole = meta(est, f"classification.{loader.__name__}", more | {"numTrees": len(trees)})
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    each = meta(one, kind, more)
    spark.createDataFrame([(i, each, float(w)) for i, w in enumerate(weights)], "_1 int, _2 string, _3 double").write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame([r for i, t in enumerate(trees) for r in t.rows(i)], _NODES).write.parquet(f"{path}/data")
    model = loader.load(path)
    _delete(sc, path)
    return model


def _delete(sc, path: str) -> None:
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


def supported(est, train: DataFrame) -> bool:
    """Numeric features, two classes and MLlib's defaults of what is not built here."""
    attrs = train.schema[est.getFeaturesCol()].metadata.get("ml_attr", {}).get("attrs", {})
    plain = not set(attrs) - {"numeric"} and est.getMinInfoGain() == 0 and est.getMinWeightFractionPerNode() == 0 and est.getMaxBins() <= 128
    if isinstance(est, GBTClassifier):
        return plain and not est.isSet("validationIndicatorCol") and not est.isSet("thresholds")
    return plain and isinstance(est, RandomForestClassifier) and est.getImpurity() == "gini" and not est.isSet("thresholds") \
        and (est.getBootstrap() or est.getSubsamplingRate() == 1.0)


def fit_trees(est, train: DataFrame, class_weights: tuple[float, float]):
    """MLlib's model of ``est`` on these rows, each weighted by its class."""
    if isinstance(est, GBTClassifier):
        return boost([(est, train, class_weights)])[0]
    return _forest(est, train, class_weights)


# --- boosted trees

def _residuals(positive: np.ndarray, margin: np.ndarray | None) -> np.ndarray:
    """What a round's tree is fitted to: labels -1 and 1 at first, later the
    negative gradient of the log loss."""
    y = np.where(positive, 1.0, -1.0)
    return y if margin is None else 4.0 * y / (1.0 + np.exp(2.0 * y * margin))


@dataclass
class _Round:
    """What tasks need of a chain's round."""
    tree: Tree
    seed: int
    rate: float
    weights: tuple[float, float]
    size: int
    step: float
    depth: int
    nodes: list[int]

    def begun(self, task: int, first: int, positive: np.ndarray, margin: np.ndarray | None, later: int = 0):
        """Which rows a round draws, and its weighted residuals."""
        n = len(positive)
        drawn = np.ones(n, bool) if self.rate >= 1.0 else uniforms(_signed(self.seed + later + task + 1), first, n) < self.rate
        return drawn, self.weighted(positive) * _residuals(positive, margin)

    def weighted(self, positive: np.ndarray) -> np.ndarray:
        return np.where(positive, self.weights[1], self.weights[0])


def _started(block, rounds: dict[int, _Round]):
    """The state of a block: its margins, the squares of the last round, and the
    drawn rows and weighted residuals of the next."""
    chain, task, first, bins, positive = block
    return chain, task, first, bins, positive, None, None, *rounds[chain].begun(task, first, positive, None)


def _advance(state, rounds: dict[int, _Round]):
    """The state after a round: its margins with the tree's, and the weighted squares
    of the round's residuals in the nodes of the tree."""
    chain, task, first, bins, positive, margin, _, drawn, wr = state
    now = rounds.get(chain)
    if now is None:
        return state
    n = len(positive)
    node = walk(bins.ravel(), np.arange(n), now.tree.feature * n, now.tree.cut, now.depth)
    squares = np.bincount(node, drawn * (wr * wr / now.weighted(positive)), len(now.tree.value))
    value = now.tree.value[node] * now.step
    margin = value if margin is None else margin + value
    return chain, task, first, bins, positive, margin, squares, *now.begun(task, first, positive, margin, 1)


def _count(state, rounds: dict[int, _Round], level: int):
    """By chain: rows of each class and weighted residuals in every bin of every
    feature of the open nodes of a level; weighted squares of the nodes; squares of
    the last round."""
    chain, _, _, bins, positive, _, squares, drawn, wr = state
    now = rounds.get(chain)
    if now is None:
        return {}
    (width, n), k, size = bins.shape, len(now.nodes), now.size
    slot = np.full(len(now.tree.feature), k, np.int64)  # what is in no open node, or not drawn, goes to one more
    slot[now.nodes] = np.arange(k)
    node = slot[walk(bins.ravel(), np.arange(n), now.tree.feature * n, now.tree.cut, level)]
    node[~drawn] = k
    base, length = node * size + positive, (k + 1) * size
    counts, sums = np.zeros((width, length), np.int64), np.zeros((width, length))
    key = np.empty(CHUNK, np.int64)
    for i in range(0, n, CHUNK):
        b, v = base[i:i + CHUNK], wr[i:i + CHUNK]
        for f in range(width):
            at = np.add(b, bins[f, i:i + CHUNK], out=key[:len(b)])
            counts[f] += np.bincount(at, minlength=length)
            sums[f] += np.bincount(at, v, length)
    sq = np.bincount(node, wr * wr / now.weighted(positive), k + 1)[:k]
    return {chain: (counts[:, :k * size], sums[:, :k * size], sq, squares)}


def _added(a: dict, b: dict) -> dict:
    both = {c: tuple(x if x is None else x + y for x, y in zip(a[c], b[c], strict=True)) for c in a.keys() & b.keys()}
    return a | b | both


def _total(rdd: RDD) -> dict:
    """The sums of arrays by chain over all blocks; by a tree of tasks if there are many."""
    parts = rdd.mapPartitions(lambda found: iter([functools.reduce(_added, found, {})]))
    return parts.treeReduce(_added, 2) if rdd.getNumPartitions() > DIRECT else functools.reduce(_added, parts.collect(), {})


def _variance(w, s, q):
    return (q - s * s / w) / w if w > 0 else 0.0


class _Chain:
    """One boosted model on its way."""

    def __init__(self, est: GBTClassifier, train: DataFrame, weights: tuple[float, float]):
        self.est, self.train, self.weights = est, train, weights
        self.points = candidate_splits(est, train)
        self.places = np.array([len(p) for p in self.points])
        self.size = 2 * (max(1, *self.places) + 1)  # of both classes
        self.per_node = _features_per_node(est.getFeatureSubsetStrategy(), len(self.points), 1)
        self.depth, self.trees = est.getMaxDepth(), []

    def begin(self, m: int) -> None:
        self.trees.append(Tree(self.depth))
        self.seed, self.taken = self.est.getSeed() + m, [1]
        self.random = _JavaRandom(self.seed)

    def now(self) -> _Round:
        return _Round(self.trees[-1], self.seed, self.est.getSubsamplingRate(), self.weights, self.size,
                      self.est.getStepSize() if len(self.trees) > 1 else 1.0, self.depth, sorted(self.taken))

    def subset(self):
        n = len(self.points)
        return feature_subset(self.random.long(), n, self.per_node) if self.per_node < n else range(n)

    def grow(self, level: int, counts: np.ndarray, sums: np.ndarray, sq: np.ndarray) -> None:
        nodes, shape = sorted(self.taken), (len(self.points), len(self.taken), self.size // 2, 2)
        self.taken = _grow(self.trees[-1], nodes, self.taken, counts.reshape(shape), sums.reshape(shape).sum(3), sq, self.weights,
                           self.places, self.points, level, self.depth, self.est.getMinInstancesPerNode(), self.subset)

    def model(self):
        weights = [1.0] + [self.est.getStepSize()] * (len(self.trees) - 1)
        return _model(self.est, self.train, GBTClassificationModel, self.trees, weights, len(self.points))


def boost(fits: list[tuple[GBTClassifier, DataFrame, tuple[float, float]]]) -> list:
    """Boosted models of these (estimator, rows, class weights). All grow together:
    one job counts a level of every chain, so that their number does not add to
    the jobs, which follow each other."""
    with ThreadPoolExecutor(len(fits)) as ex:
        chains = list(ex.map(lambda f: _Chain(*f), fits))
    spark = chains[0].train.sparkSession
    sc = spark.sparkContext
    ensure_checkpoint_dir(spark)
    rows = [blocks(c.est, c.train, c.points, by_row=False).map(lambda b, i=i: (i, *b)) for i, c in enumerate(chains)]
    source = sc.union(rows) if len(rows) > 1 else rows[0]
    for c in chains:
        c.begin(0)
    source = source.coalesce(min(source.getNumPartitions(), sc.defaultParallelism))
    state = source.map(lambda b, r={i: c.now() for i, c in enumerate(chains)}: _started(b, r)).persist(StorageLevel.MEMORY_AND_DISK)
    older = saved = None
    for m in range(max(c.est.getMaxIter() for c in chains)):
        going = [i for i, c in enumerate(chains) if m < c.est.getMaxIter()]
        for i in going if m else ():
            chains[i].begin(m)
        for level in range(max(chains[i].depth for i in going)):
            rounds = {i: chains[i].now() for i in going if chains[i].taken and level < chains[i].depth}
            if not rounds:
                break
            for i, (counts, sums, sq, squares) in _total(state.map(lambda b, r=rounds, lv=level: _count(b, r, lv))).items():
                if level == 0 and m:
                    _last_level(chains[i].trees[-2], squares, chains[i].depth)
                chains[i].grow(level, counts, sums, sq)
        if older:
            older.unpersist()
        rounds = {i: chains[i].now() for i in going}
        older, state = state, state.map(lambda b, r=rounds: _advance(b, r))
        state.persist(StorageLevel.MEMORY_AND_DISK)  # computed by the next round's first job
        if m % LINEAGE == LINEAGE - 1:  # a chain of rounds would be sent with every task
            state.checkpoint()
            state.count()
            if saved:
                _delete(sc, saved)
            saved = state.getCheckpointFile()
    for i, (squares,) in _total(state.map(lambda b: {b[0]: (b[6],)})).items():
        _last_level(chains[i].trees[-1], squares, chains[i].depth)
    older.unpersist()
    state.unpersist()
    if saved:
        _delete(sc, saved)
    with ThreadPoolExecutor(len(chains)) as ex:
        return list(ex.map(_Chain.model, chains))


def _features_per_node(strategy: str, n: int, trees: int) -> int:
    """MLlib's ``featureSubsetStrategy``."""
    if strategy == "auto":
        strategy = "all" if trees == 1 else "sqrt"
    named = {"all": n, "sqrt": math.ceil(math.sqrt(n)), "log2": max(1, math.ceil(math.log2(n))), "onethird": math.ceil(n / 3.0)}
    if strategy in named:
        return named[strategy]
    if strategy.isdigit() and int(strategy) > 0:
        return min(int(strategy), n)
    return math.ceil(float(strategy) * n)


def _last_level(tree: Tree, squares: np.ndarray, depth: int) -> None:
    for node, f in tree.facts.items():
        if node >> depth and f["stats"][2] is None:
            w, s, _ = f["stats"]
            f["stats"] = (w, s, squares[node])
            f["impurity"] = _variance(w, s, squares[node])


def _grow(tree: Tree, nodes, taken, counts, sums, sq, weights, places, points, level: int, depth: int, least: int, subset: Callable) -> list[int]:
    """Splits the open nodes of a level, in MLlib's order; gives those of the next."""
    w = counts @ np.array(weights)
    raw = counts.sum(3)
    left = [x.cumsum(2)[:, :, :-1] for x in (w, sums, raw)]
    total = [x[0].sum(1) for x in (w, sums, raw)]
    right = [t[None, :, None] - x for t, x in zip(total, left, strict=True)]
    with np.errstate(all="ignore"):
        gain = (left[1] ** 2 / left[0] + right[1] ** 2 / right[0] - (total[1] ** 2 / total[0])[None, :, None]) / total[0][None, :, None]
    ok = (left[2] >= least) & (right[2] >= least) & (np.arange(gain.shape[2]) < places[:, None, None]) & (gain >= 0)
    gain = np.where(ok, gain, -np.inf)
    later: list[int] = []
    for node in taken:
        i = nodes.index(node)
        stats = (total[0][i], total[1][i], sq[i])
        known = tree.facts.setdefault(node, {"prediction": stats[1] / stats[0] if stats[0] else 0.0, "raw": total[2][i]})
        known |= {"stats": stats, "impurity": _variance(*stats)}
        tree.value[node] = known["prediction"]
        if node > 1 and abs(known["impurity"]) < np.finfo(float).eps:
            continue
        features = subset()
        best = [gain[f, i].argmax() for f in features]
        values = [gain[f, i, s] for f, s in zip(features, best, strict=True)]
        j = int(np.argmax(values))
        if not values[j] > 0:
            continue
        f, s = features[j], int(best[j])
        tree.split(node, f, s, points[f][s], values[j])
        for child, side in ((2 * node, left), (2 * node + 1, right)):
            cw, cs, cn = (x[f, i, s] for x in side)
            tree.facts[child] = {"prediction": cs / cw, "raw": cn, "stats": (cw, cs, None), "impurity": 0.0}
            tree.value[child] = cs / cw
        later += [2 * node, 2 * node + 1]
    return later[::-1] if level + 1 < depth else []


# --- forests

@functools.cache
def _poisson(rate: float) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the counts 0, 1, 2, ... among the 32-bit words, and the count by a
    word's upper half (255: its lower half decides)."""
    p = rate ** np.arange(40.0) * math.exp(-rate) / np.array([math.factorial(k) for k in range(40)], float)
    ends = np.minimum(np.round(p.cumsum() * 2.0 ** 32), 2.0 ** 32 - 1).astype(np.uint64)
    first = np.arange(1 << 16, dtype=np.uint64) << np.uint64(16)
    low, high = (np.searchsorted(ends, x, "right") for x in (first, first | np.uint64(0xFFFF)))
    return ends, np.where(low == high, low, 255).astype(np.uint8)


def _drawn(rate: float | None, seed: int, tree: int, task: int, first: int, n: int) -> np.ndarray:
    """How often each row of a block is in a tree."""
    if rate is None:
        return np.ones(n, np.uint8)
    ends, table = _poisson(rate)
    words = np.random.default_rng([seed & _LOW, tree, task, first]).integers(0, 1 << 32, n, np.uint32)
    out = table[words >> np.uint32(16)]
    open_ = np.flatnonzero(out == 255)
    out[open_] = np.searchsorted(ends, words[open_].astype(np.uint64), "right")
    return out


def _forest_counts(found: Iterator, level: int, grown: list, rate: float | None, seed: int, size: int) -> Iterator:
    """Per tree: drawn rows of each class in every bin of the features of its open nodes."""
    out: dict[int, np.ndarray] = {}
    for task, first, bins, positive in found:
        n, width = bins.shape
        flat, place = bins.ravel(), np.arange(n) * width
        for th, feature, cut, nodes, features in grown:
            drawn = _drawn(rate, seed, th, task, first, n)
            at = np.flatnonzero(drawn)
            slot = np.full(len(feature), -1, np.int64)
            slot[nodes] = np.arange(len(nodes))
            k = features.shape[1]
            if th not in out:
                out[th] = np.zeros(len(nodes) * k * size, np.int64)
            for i in range(0, len(at), CHUNK):
                rows = at[i:i + CHUNK]
                start = place[rows]
                node = slot[walk(flat, start, feature, cut, level)]
                some = node >= 0
                if not some.all():
                    rows, start, node = rows[some], start[some], node[some]
                times, base = drawn[rows].astype(float), node * (k * size) + positive[rows]
                key = np.concatenate([base + j * size + flat[start + features[node, j]] for j in range(k)])
                out[th] += np.bincount(key, np.tile(times, k), len(out[th])).astype(np.int64)
    return iter(out.items())


def _gini(w0, w1):
    w = w0 + w1
    with np.errstate(all="ignore"):
        return np.where(w > 0, 1.0 - (w0 / w) ** 2 - (w1 / w) ** 2, 0.0)


def _best(counts: np.ndarray, features: np.ndarray, weights, places: np.ndarray, size: int, least: int):
    """Per node: column of its best feature, place, gain, rows of each class left and in all."""
    k = features.shape[1]
    c = counts.reshape(-1, k, size // 2, 2)
    left, total = c.cumsum(2)[:, :, :-1], c[:, 0].sum(1)
    right = total[:, None, None] - left
    lw, rw, tw = left * np.array(weights), right * np.array(weights), total * np.array(weights)
    share = lw.sum(3) / np.maximum(tw.sum(1), 1e-300)[:, None, None]
    gain = _gini(*tw.T)[:, None, None] - share * _gini(lw[..., 0], lw[..., 1]) - (1 - share) * _gini(rw[..., 0], rw[..., 1])
    ok = (left.sum(3) >= least) & (right.sum(3) >= least) & (np.arange(gain.shape[2]) < places[features][:, :, None]) & (gain >= 0)
    gain = np.where(ok, gain, -np.inf).reshape(len(c), -1)
    at = gain.argmax(1)
    j, s = np.divmod(at, size // 2 - 1)
    i = np.arange(len(c))
    return j, s, gain[i, at], left[i, j, s], total


def _forest(est: RandomForestClassifier, train: DataFrame, weights: tuple[float, float]):
    points = candidate_splits(est, train)
    width, depth, seed, n_trees = len(points), est.getMaxDepth(), est.getSeed(), est.getNumTrees()
    per_node = _features_per_node(est.getFeatureSubsetStrategy(), width, n_trees)
    rate, least = est.getSubsamplingRate() if est.getBootstrap() else None, est.getMinInstancesPerNode()
    places = np.array([len(p) for p in points])
    size = 2 * (max(1, *places) + 1)  # of both classes
    sc = train.sparkSession.sparkContext
    rows = blocks(est, train, points, by_row=True).persist(StorageLevel.MEMORY_AND_DISK)
    trees, rng = [Tree(depth) for _ in range(n_trees)], _JavaRandom(seed)

    def known(tree: Tree, node: int, counts: np.ndarray) -> None:
        stats = counts * np.array(weights)
        tree.facts[node] = {"stats": stats, "raw": counts.sum(), "impurity": float(_gini(*stats)), "prediction": float(stats[1] > stats[0])}

    for level in range(depth):
        grown = [(th, t.feature, t.cut, np.array(t.open), np.array(
            [feature_subset(rng.long(), width, per_node) if per_node < width else range(width) for _ in t.open])) for th, t in enumerate(trees) if t.open]
        if not grown:
            break
        sent = sc.broadcast(grown)
        subsets = sc.broadcast({g[0]: g[4] for g in grown})
        found = (rows.mapPartitions(lambda b, lv=level, g=sent: _forest_counts(b, lv, g.value, rate, seed, size))
                 .reduceByKey(np.add, rows.getNumPartitions())
                 .map(lambda x, s=subsets: (x[0], _best(x[1], s.value[x[0]], weights, places, size, least))).collect())
        for th, (j, s, gain, left, total) in found:
            tree, later = trees[th], []
            features = next(g[4] for g in grown if g[0] == th) if n_trees == 1 else subsets.value[th]
            for i, node in enumerate(tree.open):
                if node == 1:
                    known(tree, 1, total[i])
                if not gain[i] > 0:
                    continue
                f = int(features[i, j[i]])
                tree.split(node, f, int(s[i]), points[f][s[i]], gain[i])
                for child, counts in ((2 * node, left[i]), (2 * node + 1, total[i] - left[i])):
                    known(tree, child, counts)
                    if abs(tree.facts[child]["impurity"]) >= np.finfo(float).eps:
                        later.append(child)
            tree.open = later[::-1]
        for t in {th for th, *_ in grown} - {th for th, _ in found}:
            trees[t].open = []
        sent.destroy()
        subsets.destroy()
    for tree in trees:
        if 1 not in tree.facts:  # no row was drawn
            known(tree, 1, np.zeros(2))
    rows.unpersist()
    return _model(est, train, RandomForestClassificationModel, trees, [1.0] * n_trees, width)
