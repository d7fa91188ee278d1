"""A random forest grown over distinct inputs with their numbers of rows.

A tree's bootstrap draws each row a Poisson(1) number of times, so of n equal rows a Poisson(n)
number is drawn: one draw per distinct input and label serves all rows behind it, and the work of
a tree does not grow with the rows that repeat an input. Trees share nothing; each task grows some
of them over the packed inputs, level by level, in numpy. The rules are those of MLlib's forest:
bins, gini, a random subset of slots per node, least rows per leaf, and leaves of one prediction
merged. The trees are read back as MLlib's model.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.durable import shared_folder
from tidemark.llm.shipping import ship

#: Nodes whose histograms a task holds at a time.
NODES_AT_ONCE = 8_192

_NODES = (
    "tree int, id int, none double, ones double, gain double, left int, right int, slot int,"
    " threshold double, categories int"
)


@dataclass(frozen=True)
class Growth:
    """What all trees share: levels of each category, how many numbers, and the estimator's settings."""

    levels: tuple[int, ...]
    numbers: int
    seed: int
    least_rows: int
    max_depth: int
    max_bins: int

    @property
    def slots(self) -> int:
        return sum(self.levels) + self.numbers


@dataclass(frozen=True)
class _Inputs:
    """Distinct binned inputs: a code per feature, and the rows of either label."""

    codes: list[np.ndarray]
    widths: list[int]
    points: list[np.ndarray | None]
    none: np.ndarray
    ones: np.ndarray


def _bin_points(values: np.ndarray, rows: np.ndarray, bins: int) -> np.ndarray:
    """Thresholds between values: all of them, or those nearest to even shares of the rows."""
    distinct, at = np.unique(values, return_inverse=True)
    last = np.arange(len(distinct) - 1)
    if len(distinct) > bins:
        upto = np.cumsum(np.bincount(at, weights=rows))
        targets = upto[-1] * np.arange(1, bins) / bins
        above = np.clip(np.searchsorted(upto, targets), 1, len(distinct) - 1)
        nearer = np.abs(upto[above - 1] - targets) < np.abs(upto[above] - targets)
        last = np.unique(np.where(nearer, above - 1, above))
        last = last[last < len(distinct) - 1]
    return (distinct[last] + distinct[last + 1]) / 2


def _inputs(table: pa.Table, how: Growth) -> _Inputs:
    """The table's lines binned, and equal ones joined in an order that rests on them alone."""
    # Columns: an index per category, a value per number, the label, the number of rows.
    *features, label, rows = (c.to_numpy() for c in table.columns)
    codes, widths, points = [], [], []
    for i, values in enumerate(features):
        if i < len(how.levels):
            codes.append(values.astype(np.int64))
            widths.append(how.levels[i])
            points.append(None)
        else:
            cuts = _bin_points(values, rows, how.max_bins)
            codes.append(np.searchsorted(cuts, values))
            widths.append(len(cuts) + 1)
            points.append(cuts)
    order = np.lexsort(codes)
    codes = [c[order] for c in codes]
    new = np.concatenate([[True], np.any([c[1:] != c[:-1] for c in codes], axis=0)])
    starts = np.flatnonzero(new)
    ones = np.where(label > 0, rows, 0)[order]
    return _Inputs(
        [c[starts] for c in codes], widths, points,
        np.add.reduceat(rows[order] - ones, starts), np.add.reduceat(ones, starts),
    )


def _best_splits(
    codes: Sequence[np.ndarray], inputs: _Inputs, node: np.ndarray, none: np.ndarray, ones: np.ndarray,
    nodes: int, how: Growth, rng: np.random.Generator,
) -> tuple[np.ndarray, np.ndarray]:
    """Feature (-1: no split) and bin of the best split of each node, over its drawn slots."""
    chosen = np.zeros((nodes, how.slots), dtype=bool)
    subset = math.ceil(math.sqrt(how.slots))
    drawn = np.argpartition(rng.random((nodes, how.slots)), subset - 1, axis=1)[:, :subset]
    np.put_along_axis(chosen, drawn, True, axis=1)
    all_none = np.bincount(node, none, nodes)[:, None]
    all_ones = np.bincount(node, ones, nodes)[:, None]
    parent = all_none * all_ones / (all_none + all_ones)
    # Half the gini gain times the rows; a gain within rounding is none.
    best, feature, cut = parent[:, 0] * 1e-12, np.full(nodes, -1), np.zeros(nodes, dtype=np.int64)
    slot = 0
    for i, width in enumerate(inputs.widths):
        cell = node * width + codes[i]
        a = np.bincount(cell, none, nodes * width).reshape(nodes, width)
        b = np.bincount(cell, ones, nodes * width).reshape(nodes, width)
        if inputs.points[i] is None:
            mine = chosen[:, slot:slot + width]
            slot += width
        else:
            mine = chosen[:, slot:slot + 1]
            slot += 1
            a, b = np.cumsum(a, axis=1)[:, :-1], np.cumsum(b, axis=1)[:, :-1]
        if not a.shape[1]:
            continue
        n, m = a + b, (all_none - a) + (all_ones - b)
        sound = mine & (n >= how.least_rows) & (m >= how.least_rows)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = parent - a * b / n - (all_none - a) * (all_ones - b) / m
        gain = np.where(sound, gain, -np.inf)
        top = np.argmax(gain, axis=1)
        value = gain[np.arange(nodes), top]
        better = value > best
        best = np.where(better, value, best)
        feature = np.where(better, i, feature)
        cut = np.where(better, top, cut)
    return feature, cut


def _level_splits(codes, inputs, node, none, ones, nodes, how, rng) -> tuple[np.ndarray, np.ndarray]:
    """``_best_splits`` of a level, some nodes at a time."""
    if nodes <= NODES_AT_ONCE:
        return _best_splits(codes, inputs, node, none, ones, nodes, how, rng)
    order = np.argsort(node, kind="stable")
    edges = [*range(0, nodes, NODES_AT_ONCE), nodes]
    cuts = np.searchsorted(node[order], edges)
    parts = []
    for low, high, start, end in zip(edges, edges[1:], cuts, cuts[1:]):
        own = order[start:end]
        parts.append(
            _best_splits([c[own] for c in codes], inputs, node[own] - low, none[own], ones[own],
                         high - low, how, rng)
        )
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


@dataclass
class _Level:
    """Nodes of one depth; the children of a split node are the next level's, two by two."""

    none: np.ndarray
    ones: np.ndarray
    feature: np.ndarray
    cut: np.ndarray


def grown_tree(inputs: _Inputs, tree: int, how: Growth) -> list[_Level]:
    """The levels of one tree, before leaves are merged."""
    rng = np.random.default_rng([how.seed, tree])
    none, ones = (rng.poisson(x).astype(np.float64) for x in (inputs.none, inputs.ones))
    at = np.flatnonzero(none + ones)
    none, ones, node, nodes = none[at], ones[at], np.zeros(len(at), dtype=np.int64), 1
    levels: list[_Level] = []
    while nodes:
        a, b = np.bincount(node, none, nodes), np.bincount(node, ones, nodes)
        level = _Level(a, b, np.full(nodes, -1), np.zeros(nodes, dtype=np.int64))
        levels.append(level)
        open_ = (a > 0) & (b > 0) & (a + b >= 2 * how.least_rows) & (len(levels) <= how.max_depth)
        if not open_.any():
            break
        keep = open_[node]
        at, none, ones = at[keep], none[keep], ones[keep]
        node = (np.cumsum(open_) - 1)[node[keep]]
        codes = [c[at] for c in inputs.codes]
        feature, cut = _level_splits(codes, inputs, node, none, ones, int(open_.sum()), how, rng)
        level.feature[open_], level.cut[open_] = feature, cut
        own, bound = feature[node], cut[node]
        right = np.zeros(len(node), dtype=np.int64)
        for i, points in enumerate(inputs.points):
            mine = own == i
            code = codes[i][mine]
            right[mine] = code == bound[mine] if points is None else code > bound[mine]
        split = feature >= 0
        keep = split[node]
        node = 2 * (np.cumsum(split) - 1)[node[keep]] + right[keep]
        at, none, ones, nodes = at[keep], none[keep], ones[keep], 2 * int(split.sum())
    return levels


def merged(levels: list[_Level]) -> None:
    """Two leaves of one node that predict the same label become one leaf, from the bottom up."""
    for level, below in zip(levels[-2::-1], levels[::-1]):
        splits = np.flatnonzero(level.feature >= 0)
        leaf, label = below.feature.reshape(-1, 2) < 0, (below.ones > below.none).reshape(-1, 2)
        one = leaf.all(axis=1) & (label[:, 0] == label[:, 1])
        level.feature[splits[one]] = -1
        # The children of the nodes that stay split.
        for name in ("none", "ones", "feature", "cut"):
            setattr(below, name, getattr(below, name).reshape(-1, 2)[~one].ravel())


def _gini(none: np.ndarray, ones: np.ndarray) -> np.ndarray:
    n = np.maximum(none + ones, 1)
    return 2 * (none / n) * (ones / n)


def _node_batch(levels: list[_Level], tree: int, inputs: _Inputs, how: Growth) -> pa.RecordBatch:
    """The nodes of a tree from the root downwards, as ``_NODES``."""
    starts = np.cumsum([0, *[len(x.none) for x in levels]])
    none, ones, feature, cut = (
        np.concatenate([getattr(x, k) for x in levels]) for k in ("none", "ones", "feature", "cut")
    )
    split = feature >= 0
    left = np.full(len(none), -1)
    for depth, level in enumerate(levels):
        own = starts[depth] + np.flatnonzero(level.feature >= 0)
        left[own] = starts[depth + 1] + 2 * np.arange(len(own))
    right = np.where(split, left + 1, -1)
    gain = np.full(len(none), -1.0)
    n, gini = none + ones, _gini(none, ones)
    l, r = left[split], right[split]
    gain[split] = gini[split] - (n[l] * gini[l] + n[r] * gini[r]) / n[split]
    first = np.cumsum([0, *how.levels])
    slot, threshold = np.full(len(none), -1), np.zeros(len(none))
    categories = np.full(len(none), -1)
    for i, points in enumerate(inputs.points):
        mine = feature == i
        if points is None:
            slot[mine], categories[mine] = first[i] + cut[mine], 2  # left: without the level
        elif len(points):
            slot[mine] = first[-1] + i - len(how.levels)
            threshold[mine] = points[cut[mine]]
    whole = lambda x: pa.array(x, pa.int32())
    columns = [
        whole(np.full(len(none), tree)), whole(np.arange(len(none))), pa.array(none), pa.array(ones),
        pa.array(gain), whole(left), whole(right), whole(slot), pa.array(threshold), whole(categories),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in _NODES.split(",")])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's lines as one compressed value."""
    found = [b for b in batches if b.num_rows]
    if found:
        sink = pa.BufferOutputStream()
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        with pa.ipc.new_stream(sink, found[0].schema, options=options) as out:
            for batch in found:
                out.write_batch(batch)
        packed = pa.array([sink.getvalue().to_pybytes()], pa.binary())
        yield pa.RecordBatch.from_arrays([packed], names=["lines"])


def _grower(trees: int, batches: int, how: Growth):
    """A task's function: reads the packed inputs once and grows every so-manieth tree."""

    def grow(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, tables = None, []
        for batch in found:
            for line in batch.to_pylist():
                first = line["id"]
                tables.append(pa.ipc.open_stream(line["lines"]).read_all())
        if first is None:
            return
        inputs = _inputs(pa.concat_tables(tables), how)
        del tables
        for tree in range(first, trees, batches):
            levels = grown_tree(inputs, tree, how)
            merged(levels)
            yield _node_batch(levels, tree, inputs, how)

    return grow


def grown_nodes(lines: DataFrame, trees: int, how: Growth) -> DataFrame:
    """``_NODES`` of all trees.

    ``lines`` are distinct inputs: an index per category, a value per number, label and number of
    rows, in this order. They are broadcast packed, so their number must be bounded.
    """
    spark = lines.sparkSession
    ship(spark)
    packed = lines.mapInArrow(_packed, "lines binary")
    batches = min(trees, 2 * spark.sparkContext.defaultParallelism)
    each = spark.range(0, batches, 1, batches).crossJoin(F.broadcast(packed))
    return each.mapInArrow(_grower(trees, batches, how), _NODES)


def _metadata(stage: RandomForestClassifier, kind: str, left_out: Sequence[str] = (), **more) -> str:
    def named(params) -> dict:
        return {p.name: v for p, v in params.items() if p.name not in left_out}

    return json.dumps(
        {
            "class": f"org.apache.spark.ml.classification.{kind}", "timestamp": int(time.time() * 1000),
            "uid": f"{kind}_{uuid.uuid4().hex[:12]}", "paramMap": named(stage._paramMap),
            "defaultParamMap": named(stage._defaultParamMap), **more,
        }
    )


#: Parameters of a forest that its trees do not have.
_OF_FORESTS = ("numTrees", "bootstrap", "featureSubsetStrategy", "subsamplingRate")


def forest_model(nodes: DataFrame, stage: RandomForestClassifier, slots: int) -> RandomForestClassificationModel:
    """The trees in ``nodes`` as the model that ``stage`` would fit, written in its form and read."""
    spark = nodes.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/tidemark-forest-{uuid.uuid4().hex}"
    none, ones = F.col("none"), F.col("ones")
    leaf = F.col("slot") < 0
    size = F.greatest(none + ones, F.lit(1.0))
    at: Column = F.when(leaf, F.array().cast("array<double>")).otherwise(
        F.array(F.when(F.col("categories") < 0, F.col("threshold")).otherwise(F.lit(0.0)))
    )
    nodes.select(
        F.col("tree").alias("treeID"),
        F.struct(
            "id", (ones > none).cast("double").alias("prediction"),
            (2 * (none / size) * (ones / size)).alias("impurity"),
            F.array(none, ones).alias("impurityStats"),
            (none + ones).cast("bigint").alias("rawCount"), "gain",
            F.col("left").alias("leftChild"), F.col("right").alias("rightChild"),
            F.struct(
                F.col("slot").alias("featureIndex"), at.alias("leftCategoriesOrThreshold"),
                F.col("categories").alias("numCategories"),
            ).alias("split"),
        ).alias("nodeData"),
    ).write.parquet(f"{path}/data")
    trees = stage.getNumTrees()
    version = {"sparkVersion": spark.version}
    spark.createDataFrame(
        [
            (i, _metadata(stage, "DecisionTreeClassificationModel", _OF_FORESTS, **version), 1.0)
            for i in range(trees)
        ],
        "_1 int, _2 string, _3 double",
    ).coalesce(1).write.parquet(f"{path}/treesMetadata")
    text = _metadata(
        stage, "RandomForestClassificationModel", numFeatures=slots, numClasses=2, numTrees=trees, **version
    )
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    return RandomForestClassificationModel.load(path)
