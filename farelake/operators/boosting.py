"""Gradient boosting on histograms: leaf-wise trees with an L2 term on leaf values, the models of all folds side by side.

Rows are quantile bins (:class:`farelake.operators.forest.Bins`). A pass adds up, for the nodes asked for, the row count,
gradient and second derivative of the log-loss by feature and bin and finds the best split of each node. The splits are
played through in order of gain; where that meets nodes whose children are not known yet, one pass brings those of all of
them, so a tree needs about as many passes as it is deep and comes out as if split one leaf at a time.

A model that learns no more than ``PART_ROWS`` rows has them all in one task, which makes the passes of all rounds over them:
one job for all models. There a node carries its own rows, and of two children the larger has the sums of their parent less
those of the smaller. A larger model holds its rows in parts of about ``PASS_ROWS``, one block a part with their labels and raw scores,
and a pass is a job for the nodes of all models at once. The sums of the parts of a model meet on the executors; the driver
gets the best split of each node alone, so what it holds does not depend on rows, features or parts. Trees are added to the
scores on the fly; every ``WRITE_EVERY`` rounds the blocks are written with new scores. Rows lie in the order of a digest of
their unit and parts are added in order, so that sums do not depend on the layout.

A split must leave ``min_leaf`` rows on both sides and gain more than nothing. Ties go to the first feature and lowest bin.
A model is its trees: at most ``rounds`` times ``leaves`` nodes, which is what a scoring job sends to its tasks.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from farelake import config as C
from farelake.operators.forest import Bins, matrix, points
from farelake.session import drop_dir, materialise, run_dir, ship

PART_ROWS, PASS_ROWS = 1 << 22, 1 << 17
WRITE_EVERY = 10
MEET = 64  # tasks in which the sums of the parts meet, at most
_BITS = 64  # leaves of a tree that is scored by bits


class Tree:
    """Inner nodes have a feature; rows whose bin is at most ``bin`` go left."""

    def __init__(self, feature=(-1,), bin=(0,), left=(0,), right=(0,), value=(0.0,)):
        self.feature, self.bin, self.left, self.right = (np.array(v, dtype=np.int32) for v in (feature, bin, left, right))
        self.value = np.array(value, dtype=float)
        self._open = None

    def __getstate__(self):
        return {**self.__dict__, "_open": None}

    def _masks(self):
        """The leaves from left to right, and for each feature that splits: by bin, the bits of the leaves that it leaves open."""
        leaves, under, stack = [], {}, [(0, False)]
        while stack:
            at, known = stack.pop()
            if self.feature[at] < 0:
                under[at] = (len(leaves), len(leaves) + 1)
                leaves.append(at)
            elif known:
                under[at] = (under[self.left[at]][0], under[self.right[at]][1])
            else:
                stack += [(at, True), (self.right[at], False), (self.left[at], False)]
        if len(leaves) > _BITS:
            return leaves, None
        masks: dict = {}
        for at in under:
            if self.feature[at] >= 0:
                mask = masks.setdefault(int(self.feature[at]), np.full(256, (1 << len(leaves)) - 1, np.uint64))
                for side, bins in ((self.left[at], slice(self.bin[at] + 1, None)), (self.right[at], slice(None, self.bin[at] + 1))):
                    first, end = under[side]
                    mask[bins] &= np.uint64(~(((1 << (end - first)) - 1) << first) & ((1 << _BITS) - 1))
        return leaves, masks

    def leaf(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every row; ``x`` is read by column.

        A row's bin of a feature closes the leaves on the other side of the feature's splits, by a look into a table of bits;
        the first leaf that is still open is its own.
        """
        if self._open is None:
            leaves, masks = self._masks()
            self._open = (np.array(leaves, np.int32), masks)
        leaves, masks = self._open
        if masks is None:
            return self._walked(x)
        if not masks:
            return np.zeros(len(x), dtype=np.int32)
        still = None
        for feature, mask in masks.items():
            found = mask.take(x[:, feature])
            still = found if still is None else np.bitwise_and(still, found, out=still)
        still &= ~still + np.uint64(1)
        return leaves.take((still.astype(float).view(np.int64) >> 52) - 1023)

    def _walked(self, x: np.ndarray) -> np.ndarray:
        node, stack = np.zeros(len(x), dtype=np.int32), [(0, np.arange(len(x)))]
        while stack:
            at, rows = stack.pop()
            if self.feature[at] < 0 or not len(rows):
                node[rows] = at
                continue
            goes_left = x[:, self.feature[at]].take(rows) <= self.bin[at]
            stack += [(self.left[at], rows[goes_left]), (self.right[at], rows[~goes_left])]
        return node

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self.value[self.leaf(x)]


# ---- one tree ------------------------------------------------------------------------------------


def sums_by_bin(x, gradient, second, slot: np.ndarray, slots: int) -> np.ndarray:
    """Rows, gradient and second derivative by (slot, feature, bin); rows of slot -1 are left out."""
    some = np.flatnonzero(slot >= 0)
    base, gradient, second = slot[some].astype(np.int64) * 256, gradient[some], second[some]
    out = np.empty((slots, x.shape[1], 256, 3))
    for feature in range(x.shape[1]):
        at = base + x[:, feature].take(some)
        for i, weights in enumerate((None, gradient, second)):
            out[:, feature, :, i] = np.bincount(at, weights, slots * 256).reshape(slots, 256)
    return out


def sums_of_rows(x, gradient, second, rows) -> np.ndarray:
    """Rows, gradient and second derivative by (feature, bin) of ``rows``."""
    gradient, second, out = gradient[rows], second[rows], np.empty((x.shape[1], 256, 3))
    for feature in range(x.shape[1]):
        at = x[:, feature][rows].astype(np.intp)
        for i, weights in enumerate((None, gradient, second)):
            out[feature, :, i] = np.bincount(at, weights, 256)
    return out


def best_split(sums: np.ndarray, min_leaf: int, l2: float):
    """``(gain, feature, bin, left sums, right sums)`` of a node; nothing if no split gains."""
    left = np.cumsum(sums, axis=1)
    total = left[:, -1:]
    right = total - left

    def worth(s):
        return s[..., 1] ** 2 / (s[..., 2] + l2)

    gain = worth(left) + worth(right) - worth(total)
    gain[(left[..., 0] < min_leaf) | (right[..., 0] < min_leaf)] = 0
    at = int(np.argmax(gain))
    if gain.flat[at] <= 1e-12:
        return None
    feature, bin = divmod(at, sums.shape[1])
    return float(gain.flat[at]), feature, bin, left[feature, bin], right[feature, bin]


class _Growing:
    """A tree whose splits are known as far as they were asked for."""

    def __init__(self, leaves: int, min_leaf: int, l2: float, rate: float):
        self.leaves, self.min_leaf, self.l2, self.rate = leaves, min_leaf, l2, rate
        self.sums, self.split, self.children = {0: None}, {}, {}
        self.wanted = [0]

    def learn(self, found: dict) -> None:
        """Takes the sums and the best split of the wanted nodes and wants those that the next splits need."""
        for place, node in enumerate(self.wanted):
            sums, self.split[node] = found[place]
            if self.sums[node] is None:
                self.sums[node] = sums
        self.wanted = []
        _, met = self._play()
        for node in met:
            left, right = len(self.sums), len(self.sums) + 1
            self.children[node] = (left, right)
            self.sums[left], self.sums[right] = self.split[node][3:]
            for child in (left, right):
                if self.sums[child][0] >= 2 * self.min_leaf:
                    self.wanted.append(child)
                else:
                    self.split[child] = None

    def _play(self):
        """The splits in order of gain, and those among them whose children are not known."""
        heap = [(-self.split[0][0], 0)] if self.split.get(0) else []
        chosen, unknown = [], []
        while heap and len(chosen) < self.leaves - 1:
            _, node = heapq.heappop(heap)
            chosen.append(node)
            if node not in self.children:
                unknown.append(node)
                continue
            for child in self.children[node]:
                if self.split.get(child):
                    heapq.heappush(heap, (-self.split[child][0], child))
        return chosen, unknown

    def tree(self, final: bool) -> Tree:
        """The tree as known, or cut down to the splits chosen."""
        inner = set(self._play()[0]) if final else set(self.children)
        columns = []
        for node in range(len(self.sums)):
            _, gradient, second = self.sums[node] if self.sums[node] is not None else (0, 0.0, 0.0)
            left, right = self.children.get(node, (0, 0))
            _, feature, bin = self.split[node][:3] if node in inner else (0, -1, 0)
            columns.append((feature, bin, left, right, -self.rate * gradient / (second + self.l2) if second + self.l2 else 0.0))
        return Tree(*zip(*columns))


def grow_whole(x: np.ndarray, y: np.ndarray, start: float, grid: C.ModelGrid) -> tuple[list, list]:
    """The trees of a model whose rows are all here, and the number of passes that each took."""
    raw, trees, passes = np.full(len(y), start), [], []
    for _ in range(grid.gbt_rounds):
        p = 1 / (1 + np.exp(-raw))
        gradient, second = p - y, p * (1 - p)
        growing = _Growing(grid.gbt_leaves, grid.gbt_min_leaf, grid.gbt_l2, grid.gbt_step)
        rows, sums = {0: slice(None)}, {0: sums_of_rows(x, gradient, second, slice(None))}
        passes.append(0)
        while growing.wanted:
            own = [sums[node] for node in growing.wanted]
            growing.learn({i: (s[0].sum(axis=0), best_split(s, grid.gbt_min_leaf, grid.gbt_l2)) for i, s in enumerate(own)})
            passes[-1] += 1
            for node, children in growing.children.items():
                if node not in rows:
                    continue
                _, feature, bin = growing.split[node][:3]
                here, of_node = rows.pop(node), sums.pop(node)
                left = x[:, feature][here] <= bin
                for child, side in zip(children, (left, ~left)):
                    inside = np.flatnonzero(side)
                    rows[child] = inside if isinstance(here, slice) else here[inside]
                asked = [child for child in children if child in growing.wanted]
                if asked:
                    small, large = sorted(children, key=lambda c: len(rows[c]))
                    sums[small] = sums_of_rows(x, gradient, second, rows[small])
                    if large in asked:
                        rest = of_node - sums[small]
                        rest[rest[..., 0] == 0] = 0  # no rounding where there are no rows
                        sums[large] = rest
        tree = growing.tree(True)
        trees.append(tree)
        stack = [(0, 0)]  # nodes, and the leaf of the tree that they lie under
        while stack:
            node, leaf = stack.pop()
            if node in rows:
                raw[rows[node]] += tree.value[leaf]
            else:
                stack += [(child, child if tree.feature[leaf] >= 0 and leaf == node else leaf) for child in growing.children[node]]
    return trees, passes


# ---- all folds -----------------------------------------------------------------------------------


@dataclass
class Boosted:
    """The models of the folds ``left_out`` (-1: of all rows), each with its first score and its trees."""

    bins: Bins
    left_out: list
    start: np.ndarray
    trees: list
    passes: int

    def scores(self, df: DataFrame, out: str = "puntajes") -> DataFrame:
        """``df`` with an array of the probability of label 1 by each model."""
        sent = df.sparkSession.sparkContext.broadcast((self.start, self.trees))

        def run(batches):
            start, trees = sent.value
            for batch in batches:
                x = np.asfortranarray(matrix(batch.column("_bins")))
                raw = np.tile(start, (batch.num_rows, 1))
                if len(x):
                    for k, of_model in enumerate(trees):
                        for tree in of_model:
                            raw[:, k] += tree(x)
                p = 1 / (1 + np.exp(-raw))
                columns = [batch.column(c) for c in batch.schema.names[:-1]]
                names = [*batch.schema.names[:-1], out]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(list(p), pa.list_(pa.float64()))], names)

        binned = self.bins.rows(df, *[F.col(c) for c in df.columns])
        return binned.mapInArrow(run, StructType([*df.schema.fields, StructField(out, ArrayType(DoubleType()))]))

    def own_scores(self, binned: DataFrame, fold: str, out: str) -> DataFrame:
        """``binned`` (rows of :meth:`Bins.rows`) with the probability by the model that has not seen the row's fold."""
        sent = binned.sparkSession.sparkContext.broadcast((self.left_out, self.start, self.trees))
        kept = [f for f in binned.schema.fields if f.name != "_bins"]

        def run(batches):
            left_out, start, trees = sent.value
            for batch in batches:
                x, folds = matrix(batch.column("_bins")), batch.column(fold).to_numpy()
                raw = np.full(len(x), np.nan)
                for k in range(len(left_out)):
                    own = np.flatnonzero(folds == left_out[k])
                    if len(own):
                        part = np.asfortranarray(x[own])
                        raw[own] = sum((tree(part) for tree in trees[k]), np.full(len(own), start[k]))
                columns = [batch.column(f.name) for f in kept]
                names = [*[f.name for f in kept], out]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(1 / (1 + np.exp(-raw)), pa.float64())], names)

        return binned.mapInArrow(run, StructType([*kept, StructField(out, DoubleType())]))


def fit(
    df: DataFrame, numeric: Sequence[str], label: str, unit: str, profile: str, left_out: Sequence[int],
    grid: C.ModelGrid = C.ModelGrid(),
) -> Boosted:
    """Models that learn all rows of ``df`` but those of one fold each (-1 leaves out none). Rows without a label are not learnt."""
    ship(df.sparkSession)
    sc = df.sparkSession.sparkContext
    bins, models = Bins.of(df, numeric, profile), list(left_out)
    units = materialise(points(df.filter(F.col(label).isNotNull()), bins, label, unit))
    counts = [units.filter(F.col("fold") != k).agg(F.count("y").alias("n"), F.sum("y").alias("s")) for k in models]
    found = [c.first() for c in counts]
    start = np.array([np.log((r.s or 0) + 1e-9) - np.log(r.n - (r.s or 0) + 1e-9) for r in found])

    most = max((r.n for r in found), default=0)
    parts = 1 if most <= PART_ROWS else ceil(most / min(PART_ROWS, PASS_ROWS))
    learns = bool(found) and all(r.n for r in found)
    dealt = _dealt(units, models, parts).rdd.map(lambda r: (r.model * parts + r.part, r))
    first = start.tolist()

    def block(rows):
        own = {}
        for at, row in rows:
            own.setdefault(at, []).append(row)
        for at, pieces in own.items():
            y, digest, x = (b"".join(bytes(p[c]) for p in pieces) for c in ("y", "digest", "x"))
            y, digest = np.frombuffer(y, np.uint8), np.frombuffer(digest, np.int64)
            order = np.argsort(digest, kind="stable")
            x, k = np.frombuffer(x, np.uint8).reshape(len(y), -1)[order], at // parts
            yield k, at % parts, np.asfortranarray(x), y[order].astype(float), np.full(len(y), first[k])

    def with_trees(block, recent):
        k, part, x, y, raw = block
        return k, part, x, y, raw + sum((t(x) for t in recent[k]), np.zeros(len(x)))

    blocks = dealt.partitionBy(max(1, len(models) * parts), int).mapPartitions(block)
    trees, recent, passes, written = [[] for _ in models], [[] for _ in models], 0, None
    if parts == 1:
        each = []
        for k, trees[k], took in blocks.map(lambda b: (b[0], *grow_whole(b[2], b[3], first[b[0]], grid))).collect() if learns else []:
            each.append(took)
        return Boosted(bins, models, start, trees, sum(map(max, zip(*each))))
    blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)

    def splits(growing):
        """By model and place among its wanted nodes: the node's sums and best split."""
        asked = {k: (g.tree(False), g.wanted) for k, g in enumerate(growing) if g.wanted}
        min_leaf, l2 = grid.gbt_min_leaf, grid.gbt_l2

        def sums(held, recent=[list(r) for r in recent], asked=asked):
            for one in held:
                if one[0] not in asked:
                    continue
                k, part, x, y, raw = with_trees(one, recent)
                tree, wanted = asked[k]
                p = 1 / (1 + np.exp(-raw))
                slots = np.full(len(tree.feature), -1)
                slots[wanted] = np.arange(len(wanted))
                for place, own in enumerate(sums_by_bin(x, p - y, p * (1 - p), slots[tree.leaf(x)], len(wanted))):
                    yield (k, place), (part, own)

        def best(node):
            key, of_parts = node
            total = reduce(np.add, (own for _, own in sorted(of_parts, key=lambda p: p[0])))
            return key, (total[0].sum(axis=0), best_split(total, min_leaf, l2))

        by_part = blocks.mapPartitions(sums)
        nodes = by_part.groupByKey(min(len(asked) * parts, MEET))
        out = [{} for _ in growing]
        for (k, place), split in nodes.map(best).collect():
            out[k][place] = split
        return out

    for done in range(grid.gbt_rounds if learns else 0):
        growing = [_Growing(grid.gbt_leaves, grid.gbt_min_leaf, grid.gbt_l2, grid.gbt_step) for _ in models]
        while any(g.wanted for g in growing):
            new, passes = splits(growing), passes + 1
            for k, g in enumerate(growing):
                if g.wanted:
                    g.learn(new[k])
        for k, g in enumerate(growing):
            trees[k].append(g.tree(True))
            recent[k].append(trees[k][-1])
        if (done + 1) % WRITE_EVERY == 0:
            path, old = run_dir(df.sparkSession, "boosting"), blocks
            blocks.map(lambda b, recent=recent: with_trees(b, recent)).saveAsPickleFile(path)
            blocks = sc.pickleFile(path).persist(StorageLevel.MEMORY_AND_DISK)
            old.unpersist()
            if written:
                drop_dir(df.sparkSession, written)
            recent, written = [[] for _ in models], path
    blocks.unpersist()
    if written:
        drop_dir(df.sparkSession, written)
    return Boosted(bins, models, start, trees, passes)


def _dealt(units: DataFrame, models: Sequence[int], parts: int) -> DataFrame:
    """The rows that each model learns, in pieces of its parts."""

    def run(batches):
        for batch in batches:
            x, y = matrix(batch.column("x")), batch.column("y").to_numpy().astype(np.uint8)
            fold = np.array([-2 if v is None else v for v in batch.column("fold").to_pylist()])
            digest, part = batch.column("digest").to_numpy(), batch.column("part").to_numpy()
            rows = []
            for k, left_out in enumerate(models):
                for p in np.unique(part):
                    at = np.flatnonzero((fold != left_out) & (part == p))
                    if len(at):
                        rows.append((k, int(p), y[at].tobytes(), digest[at].tobytes(), x[at].tobytes()))
            kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 3]
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["model", "part", "y", "digest", "x"])

    digest = F.xxhash64("id")
    rows = units.select("y", "fold", "x", digest.alias("digest"), F.pmod(F.shiftright(digest, 20), F.lit(parts)).alias("part"))
    return rows.mapInArrow(run, "model int, part int, y binary, digest binary, x binary")


def cross_validate(
    df: DataFrame, numeric: Sequence[str], name: str, label: str, unit: str, profile: str, folds: int = C.FOLDS,
    grid: C.ModelGrid = C.ModelGrid(), val_only: bool = False,
) -> DataFrame:
    """Long scores ``modelo, fold, split, unit, label, puntaje`` of the models that leave out one fold each.

    With ``val_only`` a unit is scored by the model that has left it out and no other.
    """
    fitted = fit(df, numeric, label, unit, profile, range(folds), grid)
    if val_only:
        known = df.filter(F.col("fold").isin(*range(folds)))
        own = fitted.own_scores(fitted.bins.rows(known, F.col(unit), F.col(label), F.col("fold")), "fold", "puntaje")
        return own.select(F.lit(name).alias("modelo"), "fold", F.lit("val").alias("split"), unit, label, "puntaje")
    every = fitted.scores(df.select(unit, label, F.col("fold").alias("_own"), *numeric, profile))
    split = F.when(F.col("fold") == F.col("_own"), "val").otherwise("train").alias("split")
    long = every.select("*", F.posexplode("puntajes").alias("fold", "puntaje"))
    return long.select(F.lit(name).alias("modelo"), "fold", split, unit, label, "puntaje")
