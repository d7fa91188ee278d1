"""Shapes of physical plans: what is shuffled, and that no Python runs per row."""

from __future__ import annotations

import pytest

from tests.conftest import pattern_frames
from tidemark.operators import bootstrap, metrics, pit, scores, splits, stress, thresholds
from tidemark.operators.events import event_tables


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """The pattern tables and a score table as Parquet, as on a cluster."""
    folder = tmp_path_factory.mktemp("tables")
    frames = pattern_frames(spark, 20)
    for frame, name in zip(frames, "sre"):
        frame.write.parquet(f"{folder}/{name}")
    spark.sql(
        "select id as row_id, cast(id as string) as key, cast(id % 3 = 0 as int) as label,"
        " (id % 997) / 1000D as score, 'unused' as note from range(5000)"
    ).write.parquet(f"{folder}/scores")
    inputs = event_tables(*[spark.read.parquet(f"{folder}/{n}") for n in "sre"], validate=False)
    return inputs, spark.read.parquet(f"{folder}/scores")


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def lazy_plans(tables):
    inputs, frame = tables
    profile = scores.profile_scores(frame, order="row_id")
    return {
        "features": pit.point_in_time_features(inputs),
        "sweep": scores.threshold_sweep(frame, profile=profile),
        "metrics": metrics.threshold_free_metrics(frame, profile=profile),
        "thresholds": thresholds.choose_thresholds(
            frame, [thresholds.Policy()], profile=profile
        ),
        "split": splits.stratified_split(frame, [1, 2], label="label"),
        "bootstrap": bootstrap.bootstrap_interval(frame, samples=20, profile=profile),
        "permuted": stress.permuted_labels(frame, seed=1, label="label"),
    }


def test_no_python_and_no_cross_join(tables):
    for name, frame in lazy_plans(tables).items():
        text = plan(frame)
        for word in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas",
                     "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert word not in text, (name, word)


def test_unused_columns_are_not_read(tables):
    assert "note" not in plan(scores.threshold_sweep(tables[1]))
    assert "row_id" not in plan(scores.threshold_sweep(tables[1]))


def test_rows_are_never_gathered_in_one_task(tables):
    """A single-partition exchange only carries bucket totals, run rows or the final row."""
    for name in ("features", "split", "permuted"):
        assert "SinglePartition" not in plan(lazy_plans(tables)[name]), name
    text = plan(lazy_plans(tables)["sweep"])
    # The one gathering is below the window over bucket totals.
    assert text.count("SinglePartition") == 1
    before = text.split("SinglePartition")[1]
    assert "_bucket" in before.split("HashAggregate")[1]


def test_the_histogram_is_built_once(tables):
    """Bucket totals and the rows themselves share the shuffle by score."""
    frame = scores.threshold_sweep(tables[1], profile=scores.profile_scores(tables[1]))
    frame.collect()
    final = plan(frame).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final
    # The other branch reads no file of its own.
    assert final.count("FileScan") == 1
    assert "ShuffledHashJoin" in final


def test_events_and_requests_are_not_joined(tables):
    """They meet in one window by session; the only join adds the session columns."""
    assert plan(pit.point_in_time_features(tables[0])).count("Join") == 1


def test_split_does_not_shuffle_the_rows(tables):
    """Rows meet the cuts by broadcast: above the row scan there is no exchange."""
    text = plan(splits.stratified_split(tables[1], [1], label="label"))
    top = text.split("BroadcastExchange")[0]
    assert "Exchange hashpartitioning" not in top


def test_reused_work_is_written_to_the_named_folder(spark, tables):
    from tidemark.durable import durable

    before = spark.conf.get("spark.checkpoint.dir")
    kept = durable(tables[1].groupBy("label").count())
    assert spark.sparkContext.getCheckpointDir().startswith(("file:" + before, before))
    assert "Scan ExistingRDD" in plan(kept)


def test_verification_makes_the_features_once(spark, event_frames, monkeypatch):
    """The gates of a report share one table of features; poison and single rows make their own."""
    from tidemark.operators.events import event_tables
    from tidemark.plans import verification

    made, plain = [], verification.point_in_time_features
    monkeypatch.setattr(verification, "point_in_time_features", lambda t: made.append(t) or plain(t))
    report = verification.verification_report(event_tables(*event_frames)).first()
    assert len(made) == 3
    assert report["future_poison_invariance"] and report["batch_single_request_exact_parity"]
    assert report["spark_sql_exact_parity"] and report["output_rows"] == 1
