from __future__ import annotations

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.errors import ContractError
from tidemark.operators.capacity import TIE_DOMAIN, select_top_k
from tidemark.operators.metrics import (
    average_precision,
    calibration_error,
    confusion,
    evaluate,
    ranking_at_budget,
    roc_auc,
)
from tidemark.operators.prefix import running_totals, split_points
from tidemark.operators.ranking import boundary_value
from tidemark.operators.scores import profile_scores, score_histogram, threshold_sweep
from tidemark.operators.thresholds import Policy, choose_thresholds, select_threshold


def scored(spark, labels, scores):
    return spark.createDataFrame(
        [(i, label, score) for i, (label, score) in enumerate(zip(labels, scores))],
        "row_id long, label int, score double",
    )


@pytest.fixture(scope="module")
def sample(spark):
    """3,000 rows with ties, a block of a third of all rows, and its Python twin."""
    rng = random.Random(5)
    data = [
        (i, int(rng.random() < 0.3), 0.25 if i % 3 == 0 else round(rng.random(), 3))
        for i in range(3000)
    ]
    frame = spark.createDataFrame(data, "row_id long, label int, score double").repartition(5)
    return frame, data


def test_dearer_misses_never_raise_the_threshold(spark):
    frame = scored(spark, [0, 0, 0, 0, 1, 1], [0.05, 0.10, 0.25, 0.40, 0.35, 0.80])
    low, high = (
        select_threshold(frame, false_negative_cost=c).first()["threshold"] for c in (10.0, 1.0)
    )
    assert low <= high


def brute_choice(data, policy):
    n, positives = len(data), sum(d[1] for d in data)
    best = None
    for t in sorted({d[2] for d in data}) + [math.nextafter(max(d[2] for d in data), math.inf)]:
        sel = [d for d in data if d[2] >= t]
        tp = sum(d[1] for d in sel)
        if policy.max_selection_fraction is not None and len(sel) > math.floor(
            n * policy.max_selection_fraction
        ):
            continue
        cost = (
            (len(sel) - tp) * policy.false_positive_cost
            + (positives - tp) * policy.false_negative_cost
        ) / n * 1000
        if best is None or (cost, -t) < best[0]:
            best = ((cost, -t), len(sel))
    return (-best[0][1], best[1])


def test_policies_against_brute_force(sample):
    frame, data = sample
    policies = [Policy(1.0, c, f) for c in (1.0, 2.5, 4.0) for f in (None, 0.001, 0.1, 0.5)]
    profile = profile_scores(frame, rows_per_bucket=50)
    got = {
        r["policy_id"]: (r["threshold"], r["selected_rows"])
        for r in choose_thresholds(frame, policies, profile=profile).collect()
    }
    assert got == {i: brute_choice(data, p) for i, p in enumerate(policies)}


def test_a_tie_that_does_not_fit_under_the_ceiling(spark):
    """Nine rows, at most a third of them: two of 0.7 fit, the three of 0.6 do not."""
    data = list(zip(range(9), [1, 0, 1, 1, 0, 0, 1, 0, 0], [0.7, 0.7, 0.6, 0.6, 0.6, 0.2, 0.2, 0.1, 0.0]))
    frame = spark.createDataFrame(data, "row_id long, label int, score double")
    policy = Policy(1.0, 6.0, 1 / 3)
    got = select_threshold(
        frame, false_negative_cost=6.0, max_selection_fraction=policy.max_selection_fraction
    ).first()
    assert (got["threshold"], got["selected_rows"]) == brute_choice(data, policy) == (0.7, 2)
    assert (got["max_selected_rows"], got["policy_unused_capacity_rows"]) == (3, 1)
    assert got["next_infeasible_tie_rows"] == 3 and got["capacity_binding"]
    # All rows are tied and half of them may be taken: none is.
    level = frame.withColumn("score", F.lit(0.4))
    got = select_threshold(level, max_selection_fraction=0.5).first()
    assert (got["threshold"], got["selected_rows"]) == (math.nextafter(0.4, 1.0), 0)


@pytest.mark.parametrize("kwargs", [
    {"false_positive_cost": -1.0}, {"false_negative_cost": float("nan")},
    {"false_positive_cost": 0.0, "false_negative_cost": 0.0}, {"max_selection_fraction": 0.0},
])
def test_bad_policies(spark, kwargs):
    with pytest.raises(ContractError):
        select_threshold(scored(spark, [0, 1], [0.1, 0.2]), **kwargs)


@pytest.mark.parametrize("labels, values", [
    ([0, 2], [0.1, 0.2]), ([0, None], [0.1, 0.2]), ([0, 1], [0.1, float("nan")]),
    ([0, 1], [0.1, 1.2]), ([0, 1], [None, 0.2]), ([], []),
])
def test_bad_scores(spark, labels, values):
    with pytest.raises(ContractError, match="count="):
        roc_auc(scored(spark, labels, values))


def test_metrics_fixtures(spark):
    four = scored(spark, [0, 0, 1, 1], [0.1, 0.7, 0.4, 0.9])
    got = evaluate(four, 0.5).first()
    assert [got[c] for c in (
        "true_negatives", "false_positives", "false_negatives", "true_positives"
    )] == [1, 1, 1, 1]
    tied = ranking_at_budget(
        scored(spark, [1, 0, 1, 0], [0.9, 0.8, 0.8, 0.1]), budget_fraction=0.5
    ).first()
    assert tied["budget_boundary_tie_rows"] == 2
    assert tied["budget_selected_from_boundary_tie"] == 1
    assert tied["budget_selected_positives"] == 1
    five = ranking_at_budget(
        scored(spark, [0, 1, 0, 1, 0], [0.1, 0.9, 0.2, 0.8, 0.3]), budget_fraction=0.4
    ).first()
    assert (five["precision_at_budget"], five["recall_at_budget"], five["lift_at_budget"]) == (
        1.0, 1.0, 2.5
    )
    none = confusion(scored(spark, [0, 0], [0.1, 0.2]), 0.5).first()
    assert (none["precision"], none["recall"], none["f1"]) == (0.0, 0.0, 0.0)
    assert roc_auc(scored(spark, [0, 0], [0.1, 0.2])).first()[0] is None
    last = calibration_error(scored(spark, [1, 1], [1.0, 1.0])).first()[0]
    assert last == 0.0


def test_metrics_against_brute_force(sample):
    frame, data = sample
    pos = [d for d in data if d[1]]
    neg = [d for d in data if not d[1]]
    wins = sum((p[2] > n[2]) + 0.5 * (p[2] == n[2]) for p in pos for n in neg)
    got = evaluate(frame, 0.5, budget_fraction=0.2).first()
    assert got["roc_auc"] == pytest.approx(wins / len(pos) / len(neg), abs=1e-12)
    ap, seen, hit = 0.0, 0, 0
    for s in sorted({d[2] for d in data}, reverse=True):
        block = [d for d in data if d[2] == s]
        seen += len(block)
        hit += sum(d[1] for d in block)
        ap += sum(d[1] for d in block) / len(pos) * hit / seen
    assert got["average_precision"] == pytest.approx(ap, abs=1e-12)
    top = sorted(data, key=lambda d: (-d[2], d[0]))[:600]
    assert got["budget_selected_positives"] == sum(d[1] for d in top)
    assert average_precision(frame.repartition(13)).first()[0] == pytest.approx(ap, abs=1e-12)


def test_budget_through_the_hot_block(sample):
    """The boundary falls into the block that holds a third of all rows."""
    frame, data = sample
    fraction = (sum(d[2] > 0.25 for d in data) + 400) / len(data)
    got = ranking_at_budget(
        frame, budget_fraction=fraction,
        profile=profile_scores(frame, order="row_id", rows_per_bucket=40),
    ).first()
    k = math.ceil(len(data) * fraction)
    top = sorted(data, key=lambda d: (-d[2], d[0]))[:k]
    assert got["budget_boundary_score"] == 0.25
    assert got["budget_selected_positives"] == sum(d[1] for d in top)


def test_budget_needs_an_order_column(spark):
    with pytest.raises(ContractError, match="row_id"):
        ranking_at_budget(scored(spark, [0, 1], [0.1, 0.2]).drop("row_id"))


@pytest.mark.parametrize("rows_per_bucket", [10, 100, 10**6])
def test_running_totals_equal_a_plain_sort(sample, rows_per_bucket):
    frame, data = sample
    profile = profile_scores(frame, rows_per_bucket=rows_per_bucket)
    got = {
        r["score"]: (r["cum_pos"], r["cum_n"], r["all_n"])
        for r in threshold_sweep(frame, profile=profile).collect()
    }
    for s in {d[2] for d in data}:
        at = [d for d in data if d[2] >= s]
        assert got[s] == (sum(d[1] for d in at), len(at), len(data))


def test_running_totals_keep_runs_apart(sample):
    frame, data = sample
    both = frame.withColumn("run", F.col("row_id") % 2)
    points = profile_scores(both, rows_per_bucket=100).score_points
    got = running_totals(
        score_histogram(both, ["run"]), ["run"], "score", ["n"], points
    ).groupBy("run").agg(F.max("cum_n"), F.max("all_n"))
    assert rows(got) == [(0, 1500, 1500), (1, 1500, 1500)]


def test_split_points_take_quantiles():
    quantiles = [i / 100 for i in range(100)]
    assert split_points(quantiles, 1600, 50) == [quantiles[int(i * 100 / 32)] for i in range(1, 32)]
    assert split_points(quantiles, 10**6, 100) == quantiles
    assert split_points(None, 10) == []


@pytest.fixture(scope="module")
def crowded(spark):
    """99 % of the rows between two quantiles of the others, with a value that a third share."""
    frame = spark.range(20_000).selectExpr(
        "id as row_id", "0 as label",
        "case when id % 100 = 0 then id / 20000D when id % 3 = 0 then 0.5D"
        " else 0.5D + id * 1e-12D end as score",
    )
    return frame.repartition(5).cache()


def test_balanced_points_split_a_crowded_gap(crowded):
    from tidemark.operators.prefix import QUANTILES, with_bucket

    points = profile_scores(crowded, rows_per_bucket=15).score_points
    assert 20_000 > QUANTILES * 15
    lines = with_bucket(crowded, "score", points, "b").groupBy("b").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("score").alias("values")
    ).collect()
    assert max(r["n"] for r in lines if r["values"] > 1) <= 4 * 15
    assert max(r["n"] for r in lines) > 6000 and len(points) < 10_000
    got = threshold_sweep(crowded, profile=profile_scores(crowded, rows_per_bucket=15))
    assert rows(got) == rows(threshold_sweep(crowded))


@pytest.mark.parametrize("descending", [False, True])
def test_boundary_value_in_a_crowded_gap(crowded, descending):
    order = sorted((r["score"] for r in crowded.select("score").collect()), reverse=descending)
    for k in (1, 150, 9000, 15_000, 20_000):
        got = boundary_value(crowded, "score", k, descending=descending, rows_per_bucket=10)
        assert got.value == order[k - 1] and got.ties == order.count(got.value)
        assert got.before == sum(s > got.value if descending else s < got.value for s in order)


def test_boundary_value(sample):
    frame, data = sample
    order = sorted((d[2] for d in data), reverse=True)
    for k in (1, 7, 1500, 2400, 3000):
        for size in (20, 10**6):
            got = boundary_value(frame, "score", k, descending=True, rows_per_bucket=size)
            assert got.value == order[k - 1]
            assert got.before == sum(s > got.value for s in order)
    assert boundary_value(frame, "score", 3001) is None


# Capacity --------------------------------------------------------------------------------


def batch(spark, scores, keys):
    return spark.createDataFrame(list(zip(keys, scores)), "key string, score double")


def brute_top(scores, keys, k, floor=None):
    order = sorted(
        (i for i in range(len(keys)) if floor is None or scores[i] >= floor),
        key=lambda i: (
            -scores[i], hashlib.sha256((TIE_DOMAIN + keys[i]).encode()).hexdigest(), keys[i]
        ),
    )
    return {keys[i] for i in order[:k]}


def chosen(frame):
    return {r["key"] for r in frame.where("selected").collect()}


@pytest.mark.parametrize("k", [0, 1, 2, 4, 5, 10**100])
def test_capacity_fixture(spark, k):
    scores, keys = [0.8, 0.9, 0.8, 0.8, 0.1], list("bazcd")
    got = select_top_k(batch(spark, scores, keys), capacity=k)
    assert got.count() == 5 and chosen(got) == brute_top(scores, keys, k)


@pytest.mark.parametrize("floor", [None, 0.0, 0.5, 1.0])
@pytest.mark.parametrize("k", [1, 40, 333, 990])
def test_capacity_against_brute_force(spark, k, floor):
    rng = random.Random(3)
    scores = [0.0 if i % 3 == 0 else round(rng.random(), 1) for i in range(1000)]
    keys = [f"key-{i}-é" for i in range(1000)]
    frame = batch(spark, scores, keys).repartition(7, "key")
    got = select_top_k(frame, capacity=k, minimum_score=floor, rows_per_bucket=30)
    assert chosen(got) == brute_top(scores, keys, k, floor)


def test_capacities_nest_and_negative_zero_ties(spark):
    scores = [0.0, -0.0] * 20
    keys = [f"k{i}" for i in range(40)]
    picks = [chosen(select_top_k(batch(spark, scores, keys), capacity=k)) for k in (5, 6, 20)]
    assert picks[0] < picks[1] < picks[2]
    assert picks[2] == brute_top([0.0] * 40, keys, 20)
    assert select_top_k(batch(spark, [], []), capacity=3).count() == 0


@pytest.mark.parametrize("scores, keys", [
    ([0.5, float("nan")], ["a", "b"]), ([0.5, 1.5], ["a", "b"]), ([0.5, None], ["a", "b"]),
    ([0.5, 0.4], ["a", "a"]), ([0.5, 0.4], ["a", " b"]), ([0.5, 0.4], ["a", ""]),
    ([0.5, 0.4], ["a", None]),
])
def test_bad_batches_fail_even_without_capacity(spark, scores, keys):
    with pytest.raises(ContractError, match="count="):
        select_top_k(batch(spark, scores, keys), capacity=0)


@pytest.mark.parametrize("kwargs", [
    {"capacity": -1}, {"capacity": True}, {"capacity": 1.5},
    {"capacity": 1, "minimum_score": 1.5}, {"capacity": 1, "minimum_score": True},
    {"capacity": 1, "minimum_score": float("nan")},
])
def test_bad_capacity_arguments(spark, kwargs):
    with pytest.raises(ContractError):
        select_top_k(batch(spark, [0.5], ["a"]), **kwargs)


def test_other_columns_do_not_change_the_selection(spark):
    plain = batch(spark, [0.8, 0.8, 0.2], ["a", "b", "c"])
    noisy = plain.withColumn("label", F.rand(1))
    assert chosen(select_top_k(plain, capacity=1)) == chosen(select_top_k(noisy, capacity=1))


def test_a_null_run_is_a_run(spark):
    """Rows whose run column is null keep their metric next to the other runs."""
    from tidemark.operators.metrics import roc_auc

    rows = [(s, i, i % 2, 0.1 * i) for s in (1, None) for i in range(6)]
    frame = spark.createDataFrame(rows, "seed int, row_id int, label int, score double")
    got = {r["seed"]: r["roc_auc"] for r in roc_auc(frame, ["seed"]).collect()}
    assert set(got) == {1, None} and got[1] == got[None]


def test_a_run_without_validation_rows_raises(spark):
    from tidemark.operators.thresholds import Policy
    from tidemark.plans.policies import policy_runs

    rows = [
        (seed, split, i, i % 2, 0.1 * i)
        for seed in (1, 2) for split in ("validation", "test") for i in range(6)
        if (seed, split) != (2, "validation")
    ]
    frame = spark.createDataFrame(
        rows, "seed int, split string, row_id int, label int, score double"
    )
    with pytest.raises(Exception, match="no validation rows"):
        policy_runs(frame, [Policy()]).collect()
    assert policy_runs(frame.where("seed = 1"), [Policy()]).count() > 0


def test_bootstrap_multiplies_rows_after_the_shuffle(spark):
    """Rows are dealt to buckets before they multiply, and the sums of replicates stay there."""
    from tidemark.operators.bootstrap import resampled_cells

    frame = spark.range(100).selectExpr("id % 2 as label", "id / 100 as score")
    cells = threshold_sweep(frame)
    plan = resampled_cells(cells, 100, samples=20, seed=1)._jdf.queryExecution()
    text = plan.executedPlan().toString()
    first = text[: text.index("Exchange")]
    # Both explosions, of positions and of blocks, and the sums lie above the first exchange.
    assert first.count("Generate") == 2 and first.count("HashAggregate") == 2


def test_budget_ranking_of_a_null_run(spark):
    """Ties of a null run are cut like those of any other."""
    frame = spark.range(200).selectExpr(
        "if(id < 100, null, 1) as seed", "id % 100 as row_id", "cast(id % 5 = 0 as int) as label", "0.5D as score"
    )
    got = ranking_at_budget(frame, budget_fraction=0.05, runs=["seed"]).collect()
    assert sorted((str(r["seed"]), r["budget_selected_positives"], r["recall_at_budget"]) for r in got) == [
        ("1", 1, 0.05), ("None", 1, 0.05),
    ]
