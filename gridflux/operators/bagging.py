"""Forests that keep out-of-bag predictions and may have several targets.

Features are cut into bins at exact percentiles.  A row's weight in a tree's bootstrap
sample is a Poisson draw by a hash of its key, the tree and the seed, so each task
knows it without a table of draws, and a row with weight 0 is out of the tree's bag.
Rows of equal bins fall into the same leaves, so where they make up few different ones
(``WHOLE``), tasks add up weights and targets of each tree by these, and each tree grows
in one task from the sums.  The work per row is then that of its draws alone.  Else
trees grow level by level: tasks add up weights and targets by node, feature and bin,
the histograms of a node meet in one of as many groups as there are shuffle partitions
(a pass takes no more nodes than a task can hold), and the split with
the largest fall of the targets' summed variances is kept.  Only splits reach the
driver; the trees, a few numbers a node, are broadcast.

A node takes a share of the features at random (by seed, tree and node); it is a leaf
where no cut of these leaves ``leaf`` rows by weight on both sides and lowers the
variance, at ``depth``, or below twice ``leaf``.  Rows that lack a target don't learn.
Missing features count as the least value.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridflux.operators.ranks import percentiles
from gridflux.operators.staging import fixed

BINS, CELLS, TASK_ROWS = 64, 4 << 20, 10_000  # bins of a feature; numbers in a task's histograms; its rows
WHOLE, CHUNK = 1 << 16, 1 << 17  # different rows of bins of which a task grows a tree; rows predicted at once
_GOLD, _A, _B = 0x9E3779B97F4A7C15, np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Distribution function of Poisson draws with mean 1, up to where it is 1 in double precision.
_POISSON = np.cumsum(np.exp(-1.0) / np.cumprod(np.concatenate(([1.0], np.arange(1.0, 20)))))


def uniform(key: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """A number of [0, 1) for each key: splitmix64 of key, tree and seed."""
    step = lambda n: np.uint64(n * _GOLD % (1 << 64))
    x = key.astype(np.int64).view(np.uint64) + step(tree + 1)
    for more in (seed, tree):
        x = (x ^ (x >> np.uint64(30))) * _A
        x = (x ^ (x >> np.uint64(27))) * _B
        x = (x ^ (x >> np.uint64(31))) + step(more)
    return (x >> np.uint64(11)).astype(np.float64) / 2.0**53


def weights(key: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """Times that each row is in a tree's bootstrap sample."""
    return np.searchsorted(_POISSON, uniform(key, tree, seed), side="right")


@dataclass
class Tree:
    """Nodes in the order of levels: a split's feature (-1: leaf), last bin to the left and
    first child; the targets' means.  Trees of one task hold arrays instead of lists."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    child: list[int] = field(default_factory=lambda: [0])
    value: list[list[float]] = field(default_factory=lambda: [[]])

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """Node of each row."""
        feature, cut, child = (np.array(x, np.int64) for x in (self.feature, self.cut, self.child))
        at, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        while len(rows):
            f = feature[at[rows]]
            rows, f = rows[f >= 0], f[f >= 0]
            here = at[rows]
            at[rows] = child[here] + (bins[rows, f] > cut[here])
        return at


@dataclass
class Forest:
    features: list[str]
    targets: list[str]
    edges: list[np.ndarray]
    seed: int
    trees: list[Tree]


def cut_points(df: DataFrame, features: list[str], bins: int) -> list[np.ndarray]:
    """Upper ends of the bins of each feature but the last: percentiles without repeats."""
    found = percentiles(df, {f: F.col(f) for f in features}, [k / bins for k in range(1, bins)])
    return [np.unique(np.array(found[f])) if found[f] else np.zeros(0) for f in features]


def binned(batch: pa.RecordBatch, first: int, edges: list[np.ndarray]) -> np.ndarray:
    columns = [batch.column(first + k).to_numpy(zero_copy_only=False).astype(np.float64) for k in range(len(edges))]
    return np.column_stack([np.searchsorted(e, np.where(np.isnan(x), -np.inf, x), side="left") for e, x in zip(edges, columns, strict=True)]) if edges else np.zeros((batch.num_rows, 0), np.int64)


def numberable(edges: list[np.ndarray]) -> bool:
    """Whether all rows of bins have numbers of 62 bits."""
    return math.prod(len(e) + 1 for e in edges) < 1 << 62


def numbers(bins: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Each row of bins as one number."""
    out = np.zeros(len(bins), np.int64)
    for k, e in enumerate(edges):
        out = out * (len(e) + 1) + bins[:, k]
    return out


def of_numbers(found: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    bins = np.zeros((len(found), len(edges)), np.int64)
    for k in range(len(edges) - 1, -1, -1):
        found, bins[:, k] = np.divmod(found, len(edges[k]) + 1)
    return bins


def chosen(seed: int, tree: int, node: int, n: int, share: float) -> np.ndarray:
    """Features that a node may split by, in order."""
    return np.sort(np.random.default_rng([seed, tree, node]).permutation(n)[: max(1, int(share * n))])


def best_splits(hist: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of the feature, last bin to the left, gain) for each node, of histograms (node,
    feature, bin, weight and sums); -1 if there is none.  Of equal gains the first feature
    and bin."""
    left = np.cumsum(hist, axis=2)[:, :, :-1]
    whole = hist.sum(axis=2, keepdims=True)
    right = whole - left
    fits = (left[..., 0] >= leaf) & (right[..., 0] >= leaf)
    safe = lambda x: (x[..., 1:] ** 2).sum(axis=-1) / np.maximum(x[..., 0], 1)
    gain = np.where(fits, safe(left) + safe(right) - safe(whole), -1.0).reshape(len(hist), -1)
    if not gain.size:
        return np.full(len(hist), -1), np.zeros(len(hist), np.int64), np.zeros(len(hist))
    # Sums of tasks are added in no fixed order: gains that differ by rounding are equal.
    top = gain.max(axis=1)
    first = np.argmax(gain >= (top - 1e-9 * np.maximum(np.abs(top), 1e-300))[:, None], axis=1)
    scale = safe(whole).reshape(len(hist), -1).max(axis=1, initial=0.0)
    none = top <= 1e-12 * np.maximum(scale, 1e-300)
    place, cut = np.divmod(first, hist.shape[2] - 1)
    return np.where(none, -1, place), np.where(none, 0, cut), np.where(none, 0.0, top)


def best_split(hist: np.ndarray, features: np.ndarray, leaf: int) -> tuple[int, int, float]:
    """(feature, last bin to the left, gain) of one node."""
    place, cut, gain = (x[0] for x in best_splits(hist[None], leaf))
    return int(features[place]) if place >= 0 else -1, int(cut), float(gain)


def grown(bins: np.ndarray, sums: np.ndarray, seed: int, tree: int, width: int, depth: int, leaf: int, share: float) -> Tree:
    """A tree of different rows of bins and their sums (weight and weighted targets)."""
    (_, n_features), k = bins.shape, sums.shape[1]
    n_picks = min(n_features, max(1, int(share * n_features)))
    features, cuts, children, values = [], [], [], []
    at, open_nodes, first = np.zeros(len(bins), np.int64), 1, 0  # place of each row among the level's nodes
    for level in range(depth + 1):
        whole = np.stack([np.bincount(at, sums[:, c], minlength=open_nodes) for c in range(k)], axis=1)
        feature, cut, child = np.full(open_nodes, -1), np.zeros(open_nodes, np.int64), np.zeros(open_nodes, np.int64)
        some = np.flatnonzero(whole[:, 0] >= 2 * leaf) if level < depth and n_picks else np.zeros(0, np.int64)
        picks = np.array([chosen(seed, tree, first + n, n_features, share) for n in some.tolist()], np.int64).reshape(len(some), n_picks)
        size = max(1, CELLS // max(1, n_picks * width * k))
        order = np.argsort(at, kind="stable")
        ends = np.searchsorted(at[order], np.arange(open_nodes + 1))
        for i in range(0, len(some), size):  # nodes whose histograms a task can hold
            part, own = some[i : i + size], picks[i : i + size]
            rows = order[ends[part[0]] : ends[part[-1] + 1]]
            to = np.full(open_nodes, -1)
            to[part] = np.arange(len(part))
            rows = rows[to[at[rows]] >= 0]
            node = to[at[rows]]
            hist = np.empty((len(part), own.shape[1], width, k))
            for f in range(own.shape[1]):
                cell = node * width + bins[rows, own[node, f]]
                for c in range(k):
                    hist[:, f, :, c] = np.bincount(cell, sums[rows, c], minlength=len(part) * width).reshape(len(part), width)
            place, cut[part], _ = best_splits(hist, leaf)
            feature[part] = np.where(place >= 0, own[np.arange(len(part)), place], -1)
        split = feature >= 0
        after = first + open_nodes
        child[split] = after + 2 * np.arange(split.sum())
        features.append(feature)
        cuts.append(cut)
        children.append(child)
        values.append(whole[:, 1:] / np.maximum(whole[:, :1], 1))
        going = split[at]
        bins, sums, at = bins[going], sums[going], at[going]
        at = child[at] - after + (bins[np.arange(len(at)), feature[at]] > cut[at])
        first, open_nodes = after, 2 * int(split.sum())
        if not open_nodes:
            break
    return Tree(*(np.concatenate(x) for x in (features, cuts, children)), np.concatenate(values))


SPLITS = "tree int, node int, feature int, cut int, whole array<double>, left array<double>"


def fit(df: DataFrame, key: str, features: list[str], targets: list[str], trees: int = 500, depth: int = 12, leaf: int = 2, share: float = 0.33, bins: int = BINS, seed: int = 0) -> Forest:
    """A forest of ``targets`` jointly; ``key`` is a whole number that names a row."""
    complete = df.dropna(subset=targets).select(F.col(key).cast("long").alias("key"), *(F.col(f).cast("double").alias(f) for f in features), *(F.col(t).cast("double").alias(t) for t in targets))
    rows = fixed(complete)
    edges = cut_points(rows, features, bins)
    model = Forest(features, targets, edges, seed, [Tree() for _ in range(trees)])
    if _whole_trees(rows, model, depth, leaf, share):
        return model
    rows = rows.coalesce(1 + rows.count() // TASK_ROWS)  # each task walks all trees, so few rows are few tasks
    width, k = max((len(e) + 1 for e in edges), default=1), 1 + len(targets)
    spark, open_nodes = df.sparkSession, [(t, 0) for t in range(trees)]
    per_node = max(1, int(share * len(features))) * width * k
    for level in range(depth + 1):
        following: list[tuple[int, int]] = []
        size = max(1, CELLS // per_node)
        for i in range(0, len(open_nodes), size):  # nodes whose histograms a task can hold
            part = open_nodes[i : i + size]
            for r in _splits(spark, rows, model, part, width, leaf, share, level == depth):
                tree = model.trees[r["tree"]]
                node, whole, left = r["node"], np.array(r["whole"]), np.array(r["left"])
                tree.value[node] = (whole[1:] / max(whole[0], 1)).tolist()
                if r["feature"] < 0:
                    continue
                tree.feature[node], tree.cut[node], tree.child[node] = r["feature"], r["cut"], len(tree.feature)
                for side in (left, whole - left):
                    following.append((r["tree"], len(tree.feature)))
                    tree.feature.append(-1)
                    tree.cut.append(0)
                    tree.child.append(0)
                    tree.value.append((side[1:] / max(side[0], 1)).tolist())
        open_nodes = following
        if not open_nodes:
            break
    return model


def _whole_trees(rows: DataFrame, model: Forest, depth: int, leaf: int, share: float) -> bool:
    """Fills in all trees, each grown by one task; False if the different rows of bins are
    too many, or none."""
    edges, seed, trees, n_features, k = model.edges, model.seed, len(model.trees), len(model.features), 1 + len(model.targets)
    if not numberable(edges):
        return False

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = numbers(binned(batch, 1, edges), edges)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found), *(batch.column(1 + n_features + t) for t in range(k - 1))], names=["key", "bins", *(f"y{t}" for t in range(k - 1))])

    numbered = rows.mapInArrow(number, ", ".join(["key long", "bins long", *(f"y{t} double" for t in range(k - 1))]))
    counts = numbered.groupBy("bins").count().limit(WHOLE + 1).collect()
    if not 0 < len(counts) <= WHOLE:
        return False
    counts = np.array(sorted((r["bins"], r["count"]) for r in counts), np.int64)
    shared = rows.sparkSession.sparkContext.broadcast(counts)
    width = max((len(e) + 1 for e in edges), default=1)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows with the place of their bins, and a part, so that frequent bins are several tasks'."""
        known, n = shared.value.T
        for batch in batches:
            place = np.searchsorted(known, batch.column(1).to_numpy())
            part = uniform(batch.column(0).to_numpy(), 0, -1) * (1 + n[place] // TASK_ROWS)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(place), pa.array(part.astype(np.int64)), *batch.columns[2:]], names=["key", "place", "part", *(f"y{t}" for t in range(k - 1))])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = list(batches)
        if not own:
            return
        column = lambda c: np.concatenate([b.column(c).to_numpy() for b in own])
        key, y = column(0), [column(3 + t) for t in range(k - 1)]
        places, at = np.unique(column(1), return_inverse=True)
        for tree in range(trees):
            w = weights(key, tree, seed)
            sums = np.stack([np.bincount(at, w * c, minlength=len(places)) for c in (1.0, *y)], axis=1)
            some = np.flatnonzero(sums[:, 0] > 0)
            if len(some):
                yield pa.RecordBatch.from_arrays([pa.array([tree], pa.int32()), pa.array([places[some].astype(np.int32).tobytes()], pa.binary()), pa.array([sums[some].tobytes()], pa.binary())], names=["tree", "places", "sums"])

    def grow(group: pa.Table) -> pa.Table:
        known = shared.value[:, 0]
        sums = np.zeros((len(known), k))
        for places, blob in zip(group.column("places"), group.column("sums"), strict=True):
            sums[np.frombuffer(places.as_py(), np.int32)] += np.frombuffer(blob.as_py(), np.float64).reshape(-1, k)
        some = np.flatnonzero(sums[:, 0] > 0)
        number = group.column("tree")[0].as_py()
        tree = grown(of_numbers(known[some], edges), sums[some], seed, number, width, depth, leaf, share)
        blobs = [x.astype(np.int32).tobytes() for x in (tree.feature, tree.cut, tree.child)] + [tree.value.tobytes()]
        return pa.table({"tree": pa.array([number], pa.int32())} | {n: pa.array([b], pa.binary()) for n, b in zip(("feature", "cut", "child", "value"), blobs, strict=True)})

    schema = ", ".join(["key long", "place long", "part long", *(f"y{t} double" for t in range(k - 1))])
    dealt = numbered.mapInArrow(deal, schema).repartition(int(1 + counts[:, 1].sum() // TASK_ROWS), "place", "part")
    sums = dealt.mapInArrow(add_up, "tree int, places binary, sums binary")
    for r in sums.groupBy("tree").applyInArrow(grow, "tree int, feature binary, cut binary, child binary, value binary").collect():  # some 16 bytes a node
        model.trees[r["tree"]] = Tree(*(np.frombuffer(r[c], np.int32) for c in ("feature", "cut", "child")), np.frombuffer(r["value"], np.float64).reshape(-1, k - 1))
    return True


def _splits(spark, rows: DataFrame, model: Forest, nodes: list[tuple[int, int]], width: int, leaf: int, share: float, last: bool) -> list:
    """The best split of each node, in order."""
    of_tree: dict[int, list[int]] = {}
    for tree, node in nodes:
        of_tree.setdefault(tree, []).append(node)
    shared = spark.sparkContext.broadcast((model, of_tree))
    n_features, n_targets = len(model.features), len(model.targets)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, of_tree = shared.value
        picks = {(t, n): chosen(model.seed, t, n, n_features, share) for t, own in of_tree.items() for n in own}
        hists: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            bins = binned(batch, 1, model.edges)
            key = batch.column(0).to_numpy()
            y = np.column_stack([np.ones(len(key)), *(batch.column(1 + n_features + t).to_numpy() for t in range(n_targets))])
            for tree, own in of_tree.items():
                w = weights(key, tree, model.seed)
                at = model.trees[tree].leaves(bins)
                place = np.full(len(model.trees[tree].feature), -1)
                place[own] = np.arange(len(own))
                some = np.flatnonzero((w > 0) & (place[at] >= 0))
                at, weighted = place[at[some]], w[some, None] * y[some]
                feats = np.stack([picks[tree, n] for n in own])  # (nodes, features)
                total = np.stack([
                    np.bincount((at * width + bins[some, feats[at, f]]), weighted[:, c], minlength=len(own) * width).reshape(len(own), width)
                    for f in range(feats.shape[1]) for c in range(1 + n_targets)
                ]).reshape(feats.shape[1], 1 + n_targets, len(own), width)
                for j, n in enumerate(own):
                    hist = np.moveaxis(total[:, :, j], 1, 2)
                    hists[tree, n] = hists[tree, n] + hist if (tree, n) in hists else hist
        found = [(t, n, h.tobytes()) for (t, n), h in hists.items() if h.any()]
        columns = list(zip(*found, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.int32(), pa.binary()), strict=True)], names=["tree", "node", "hist"])

    def choose(group: pa.Table) -> pa.Table:
        """The splits of some nodes: histograms of a node from all tasks are added up."""
        model = shared.value[0]
        names = list(zip(group.column("tree").to_pylist(), group.column("node").to_pylist(), strict=True))
        sums: dict[tuple[int, int], np.ndarray] = {}
        for name, blob in zip(names, group.column("hist"), strict=True):
            hist = np.frombuffer(blob.as_py(), np.float64)
            sums[name] = sums[name] + hist if name in sums else hist
        out = []
        for (tree, node), hist in sums.items():
            picks = chosen(model.seed, tree, node, n_features, share)
            hist = hist.reshape(len(picks), width, 1 + n_targets)
            whole = hist[0].sum(axis=0)
            feature, cut, _ = (-1, 0, 0.0) if last or whole[0] < 2 * leaf else best_split(hist, picks, leaf)
            left = hist[int(np.flatnonzero(picks == feature)[0]), : cut + 1].sum(axis=0) if feature >= 0 else np.zeros(1 + n_targets)
            out.append((tree, node, feature, cut, whole.tolist(), left.tolist()))
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64()))
        fields = [x.split()[0] for x in SPLITS.split(", ")]
        return pa.table({n: pa.array(v, k) for n, v, k in zip(fields, zip(*out, strict=True), kinds, strict=True)})

    groups = int(spark.conf.get("spark.sql.shuffle.partitions"))
    deal = F.pmod(F.xxhash64("tree", "node"), F.lit(groups)).alias("deal")
    got = rows.mapInArrow(gather, "tree int, node int, hist binary").groupBy(deal).applyInArrow(choose, SPLITS).collect()  # a row a node
    return sorted(got, key=lambda r: (r["tree"], r["node"]))


def _larger(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of ``CHUNK`` rows or somewhat more, but for the last."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= CHUNK:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def predict(model: Forest, df: DataFrame, key: str, keep: list[str], out_of_bag: bool = False) -> DataFrame:
    """``keep`` and ``<target>_pred`` for each target: means over all trees, or over those
    whose sample doesn't hold the row (null if each does), with their number ``n_trees``."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    n_keep, names = len(keep), [f"{t}_pred" for t in model.targets]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in _larger(batches):
            row_key, bins = batch.column(n_keep).to_numpy(), binned(batch, n_keep + 1, m.edges)
            if numberable(m.edges):  # each different row of bins walks the trees once
                found, at = np.unique(numbers(bins, m.edges), return_inverse=True)
                bins = of_numbers(found, m.edges)
            else:
                at = np.arange(len(bins))
            total, n = np.zeros((len(row_key), len(names))), np.zeros(len(row_key), np.int64)
            each, n_each = np.zeros((len(bins), len(names))), 0
            for t, tree in enumerate(m.trees):
                if not len(tree.value[0]):
                    continue
                value = np.asarray(tree.value)[tree.leaves(bins)]
                if out_of_bag:
                    use = weights(row_key, t, m.seed) == 0
                    total[use] += value[at[use]]
                    n += use
                else:
                    each += value
                    n_each += 1
            if not out_of_bag:
                total, n = each[at], np.full(len(row_key), n_each)
            mean = total / np.maximum(n, 1)[:, None]
            preds = [pa.array(mean[:, k], pa.float64(), mask=n == 0) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in range(n_keep)), *preds, pa.array(n)], names=[*keep, *names, "n_trees"])

    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), *(f"`{n}` double" for n in names), "n_trees long"])
    return df.select(*keep, F.col(key).cast("long").alias("_key"), *(F.col(f).cast("double").alias(f) for f in model.features)).mapInArrow(run, schema)


def out_of_bag(model: Forest, df: DataFrame, key: str) -> DataFrame:
    """(key, <target>_obs, <target>_pred, n_trees) of the rows that the forest learned from:
    what residuals of smearing are taken from."""
    complete = df.dropna(subset=model.targets)
    keep = complete.select("*", *(F.col(t).cast("double").alias(f"{t}_obs") for t in model.targets))
    return predict(model, keep, key, [key, *(f"{t}_obs" for t in model.targets)], out_of_bag=True)
