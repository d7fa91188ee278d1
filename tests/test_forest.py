"""The forest over distinct inputs against MLlib's over rows, and against plain versions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from tests.conftest import rows
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tidemark.operators import forest, model
from tidemark.operators.metrics import threshold_free_metrics

FEATURES = ["country", "age", "new_user"]
HOW = forest.Growth((3,), 1, 42, 12, 30, 32)


def table(n: int, seed: int = 1) -> pa.Table:
    rng = np.random.default_rng(seed)
    return pa.table({
        "level": rng.integers(0, 3, n).astype(float), "value": rng.integers(0, 40, n) / 4,
        "label": rng.integers(0, 2, n).astype(float), "rows": rng.integers(1, 50, n),
    })


@pytest.fixture(scope="module")
def visits(spark):
    """6,000 rows of some 130 inputs; the label hangs on age and country."""
    chance = F.when(F.col("age") > 40, 0.9).otherwise(0.1) - F.when(F.col("country") == "B", 0.1).otherwise(0.0)
    return spark.range(6000).selectExpr(
        "id as row_id", "elt(1 + id % 3, 'A', 'B', 'C') as country",
        "cast(13 + (id * 7) % 43 as int) as age", "cast(id % 2 as int) as new_user",
    ).withColumn(
        "converted", (F.pmod(F.xxhash64("row_id"), F.lit(1000)) < chance * 1000).cast("int")
    )


def test_forest_over_inputs_agrees_with_mllib(visits, monkeypatch, tmp_path):
    seen, made = [], forest.grown_nodes

    def seeing(lines, *more):
        seen.append((lines.count(), lines.agg(F.sum("tm_rows")).first()[0]))
        return made(lines, *more)

    monkeypatch.setattr(forest, "grown_nodes", seeing)
    scores = []
    for least in (0, 10**9):
        monkeypatch.setattr(model, "GROUPED_FROM", least)
        fitted = model.build_model_pipeline(FEATURES, model.FOREST, trees=20).fit(visits)
        scores.append((fitted, model.score_rows(fitted, visits).withColumn("label", F.col("converted"))))
    inputs = visits.select(*FEATURES, "converted").distinct().count()
    assert seen == [(inputs, 6000)] and inputs < 600
    mine, theirs = (threshold_free_metrics(s).first() for _, s in scores)
    for name in ("roc_auc", "average_precision"):
        assert mine[name] == pytest.approx(theirs[name], abs=0.02) and mine[name] > 0.8
    assert mine["brier_score"] == pytest.approx(theirs["brier_score"], abs=0.005)
    fitted, scored = scores[0]
    grown = fitted.stages[-1]
    assert grown.getNumTrees == len(grown.trees) == 20 and grown.numFeatures == 5
    assert len({t.toDebugString.split("\n", 1)[1] for t in grown.trees}) > 3
    fitted.save(str(tmp_path / "saved"))
    again = model.score_rows(PipelineModel.load(str(tmp_path / "saved")), visits)
    assert rows(again.select("row_id", "score")) == rows(scored.select("row_id", "score"))


def test_too_many_inputs_are_left_to_mllib(visits, monkeypatch):
    monkeypatch.setattr(model, "GROUPED_FROM", 0)
    monkeypatch.setattr(model, "MOST_INPUTS", 10)
    monkeypatch.setattr(forest, "grown_nodes", None)
    assert model.build_model_pipeline(FEATURES, model.FOREST, trees=2).fit(visits).stages[-1].getNumTrees == 2


def test_trees_do_not_depend_on_how_lines_lie(spark):
    lines = table(300)
    mixed = lines.take(np.random.default_rng(2).permutation(300))
    # A line of many rows is as good as two that share them.
    halves = pa.concat_tables([
        lines.set_column(3, "rows", pa.array(part)) for part in (lines["rows"].to_numpy() - 1, np.ones(300, int))
    ])
    trees = [[
        [x.tolist() for x in (level.none, level.ones, level.feature, level.cut)]
        for level in forest.grown_tree(forest._inputs(t, HOW), 3, HOW)
    ] for t in (lines, mixed, halves)]
    assert trees[0] == trees[1] == trees[2]


def test_bootstrap_counts_rows():
    """Root counts over the trees: those of drawing each row with replacement."""
    inputs = forest._inputs(table(300), HOW)
    total = inputs.none.sum() + inputs.ones.sum()
    drawn = [
        float((level.none + level.ones)[0])
        for level in (forest.grown_tree(inputs, t, HOW)[0] for t in range(200))
    ]
    assert np.mean(drawn) == pytest.approx(total, abs=5 * np.sqrt(total / 200))
    assert np.var(drawn) == pytest.approx(total, rel=0.5)


@pytest.mark.parametrize("at_once", [2, 1000])
def test_best_splits_against_all_splits(monkeypatch, at_once):
    how = forest.Growth((1,), 1, 42, 12, 30, 32)  # two slots, of which a node draws two
    lines = table(400)
    inputs = forest._inputs(lines.set_column(0, "level", pa.array(np.zeros(400))), how)
    rng = np.random.default_rng(5)
    node, (none, ones) = rng.integers(0, 5, len(inputs.none)), (inputs.none * 1.0, inputs.ones * 1.0)
    monkeypatch.setattr(forest, "NODES_AT_ONCE", at_once)
    feature, cut = forest._level_splits(inputs.codes, inputs, node, none, ones, 5, how, rng)
    assert (feature == 1).all()

    def loss(mask):
        a, b = none[mask].sum(), ones[mask].sum()
        return 2 * a * b / (a + b) if a + b >= 12 else np.inf

    for k in range(5):
        losses = [
            loss((node == k) & (inputs.codes[1] <= c)) + loss((node == k) & (inputs.codes[1] > c))
            for c in range(inputs.widths[1] - 1)
        ]
        assert losses[cut[k]] == pytest.approx(min(losses))


def test_leaves_and_depth():
    inputs = forest._inputs(table(2000, 4), HOW)
    for depth in (3, 30):
        how = forest.Growth((3,), 1, 42, 12, depth, 32)
        levels = forest.grown_tree(inputs, 0, how)
        assert 1 < len(levels) <= depth + 1
        forest.merged(levels)
        nodes = pa.Table.from_batches([forest._node_batch(levels, 0, inputs, how)]).to_pandas()
        leaf = nodes[nodes.left < 0]
        assert (leaf.none + leaf.ones).min() >= 12 and list(nodes.id) == [*range(len(nodes))]
        inner = nodes[nodes.left >= 0]
        assert (inner.gain > 0).all() and set(inner.slot) <= {0, 1, 2, 3}
        assert sorted([*inner.left, *inner.right]) == list(nodes.id[1:])
        left, right = nodes.loc[inner.left], nodes.loc[inner.right]
        assert (left.none.to_numpy() + right.none.to_numpy() == inner.none.to_numpy()).all()
        both = (left.left.to_numpy() < 0) & (right.left.to_numpy() < 0)
        same = (left.ones > left.none).to_numpy() == (right.ones > right.none).to_numpy()
        assert not (both & same).any()


def test_bins():
    few, rows_ = np.array([3.0, 1.0, 2.0]), np.array([1, 5, 1])
    assert list(forest._bin_points(few, rows_, 32)) == [1.5, 2.5]
    many = np.arange(1000.0)
    points = forest._bin_points(many, np.ones(1000), 32)
    assert len(points) == 31 and np.abs(np.diff(points) - 1000 / 32).max() <= 1.5
    # One value with most rows takes no more than its share of the points.
    assert len(forest._bin_points(many, np.where(many == 500, 10**6, 1), 32)) >= 1
    assert not len(forest._bin_points(np.array([7.0]), np.array([3]), 32))
