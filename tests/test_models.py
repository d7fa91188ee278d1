from __future__ import annotations

import json
import random
import shutil

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.errors import ContractError
from tidemark.operators import bootstrap
from tidemark.operators.combine import multiset_delta
from tidemark.operators.bootstrap import bootstrap_interval, brier_sum
from tidemark.operators.metrics import evaluate
from tidemark.operators.scores import threshold_sweep
from tidemark.operators.capacity import select_top_k
from tidemark.operators.model import (
    FOREST,
    FeatureContract,
    build_model_pipeline,
    champion,
    loss_gradient,
    preprocess_parameters,
    score_rows,
)
from tidemark.operators.selection import ranked_values, value_counts
from tidemark.operators.splits import (
    grouped_split,
    profile_diagnostics,
    profile_overlap,
    profile_split,
    stratified_split,
)
from tidemark.operators.stress import corrupted_inputs, permuted_labels, random_scores
from tidemark.plans import policies as grid
from tidemark.plans.audit import corruption_metrics, run_realism_audit
from tidemark.plans.decision import run_decision_optimization
from tidemark.plans.training import run_training
from tidemark.schemas import FEATURES
from tidemark.sources.manifest import read_checked, write_checked
from tidemark.sources.readers import load_conversions, read_csv
from tidemark.sources.writers import write_csv, write_json_report, write_report_tables

ACQUISITION = FEATURES["acquisition"]


@pytest.fixture(scope="module")
def conversions(spark, tmp_path_factory):
    """1,200 rows in which pages drive the outcome and one profile holds a third of them."""
    rng = random.Random(1)
    data = []
    for i in range(1200):
        hot = i % 3 == 0
        pages = rng.randint(1, 20)
        data.append((
            i, "US" if hot else rng.choice(["US", "UK", "DE"]),
            30 if hot else rng.randint(18, 60), 1 if hot else rng.randint(0, 1),
            "Ads" if hot else rng.choice(["Ads", "Seo"]), pages,
            int(rng.random() < (0.8 if pages > 15 else 0.05)),
        ))
    path = str(tmp_path_factory.mktemp("conversions"))
    spark.createDataFrame(
        data, "row_id long, country string, age int, new_user int, source string,"
        " total_pages_visited int, converted int",
    ).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


# Splits ----------------------------------------------------------------------------------


def test_stratified_split_is_exact_and_stable(conversions):
    split = stratified_split(conversions, [7, 8]).cache()
    positives = conversions.where("converted = 1").count()
    for seed in (7, 8):
        got = {
            r["split"]: (r["n"], r["p"])
            for r in split.where(F.col("seed") == seed).groupBy("split").agg(
                F.count(F.lit(1)).alias("n"), F.sum("converted").alias("p")
            ).collect()
        }
        assert [got[s][0] for s in ("train", "validation", "test")] == [720, 240, 240]
        assert abs(got["test"][1] - positives / 5) <= 1
        assert abs(got["validation"][1] - positives / 5) <= 1
    again = stratified_split(conversions.repartition(11), [8, 7])
    assert rows(split.select("seed", "row_id", "split")) == rows(
        again.select("seed", "row_id", "split")
    )
    assert split.where("seed = 7").select("row_id", "split").exceptAll(
        split.where("seed = 8").select("row_id", "split")
    ).count() > 0
    with pytest.raises(ContractError):
        stratified_split(conversions.where("converted = 0"), 1)


@pytest.mark.parametrize("make", [profile_split, grouped_split])
def test_no_profile_crosses_a_split(conversions, make):
    nulls = conversions.withColumn("country", F.when(F.col("row_id") % 50 != 0, F.col("country")))
    split = make(nulls, [3, 4], features=ACQUISITION).cache()
    assert split.count() == 2400
    assert split.groupBy("seed").agg(F.count_distinct("split")).first()[1] == 3
    overlap = profile_overlap(split, ACQUISITION)
    assert overlap.agg(F.sum("crossing_profiles")).first()[0] == 0


def test_profile_diagnostics(spark):
    frame = spark.createDataFrame(
        [("a", 1), ("a", 0), ("a", 0), ("b", 1), (None, 1), (None, 1)],
        "country string, converted int",
    )
    got = profile_diagnostics(frame, ["country"]).first().asDict()
    assert got == {
        "unique_profiles": 3, "rows_in_repeated_profiles": 5,
        "repeated_profile_fraction": 5 / 6, "profiles_with_both_labels": 1,
        "rows_in_profiles_with_both_labels": 3,
    }


# Model -----------------------------------------------------------------------------------


def test_preprocess_parameters(spark):
    frame = spark.createDataFrame(
        [("b", 1.0), ("a", 2.0), ("a", 3.0), ("b", 10.0), (None, None)],
        "country string, age double",
    )
    mode, age = preprocess_parameters(frame, ["country", "age"]).orderBy("position").collect()
    assert mode["mode"] == "a" and mode["levels"] == ["a", "b"]
    filled = [1.0, 2.0, 3.0, 10.0, 2.5]
    mean = sum(filled) / 5
    assert age["median"] == 2.5 and age["mean"] == pytest.approx(mean)
    assert age["deviation"] == pytest.approx((sum((v - mean) ** 2 for v in filled) / 5) ** 0.5)


@pytest.mark.parametrize("limit", [3, 40, 10_000])
def test_ranked_values_against_sorting(spark, limit):
    """Ranks of two features at once; most values of one crowd in a gap of its quantiles."""
    rng = random.Random(9)
    crowded = [1.0 + rng.randrange(900) * 2.0**-50 for _ in range(3000)] + [-1e300, 0.0, 1e300]
    other = [float(rng.randrange(50)) for _ in crowded]
    frame = spark.createDataFrame(
        [(a, b if i % 7 else None) for i, (a, b) in enumerate(zip(crowded, other))], "a double, b double"
    ).repartition(5)
    ordered = {0: sorted(crowded), 1: sorted(b for i, b in enumerate(other) if i % 7)}
    targets = [(p, k) for p in (0, 1) for k in (1, 2, 777, 1500, len(ordered[p]))]
    counts = value_counts(frame, ["a", "b"], [])
    got = ranked_values(counts, targets, values_per_task=limit)
    assert got == [ordered[p][k - 1] for p, k in targets]
    with pytest.raises(ContractError, match="count=1"):
        ranked_values(counts, [(0, 1), (1, 3003)], values_per_task=limit)
    assert ranked_values(counts, []) == []


def test_parameters_of_odd_tables(spark):
    features = ["country", "age"]
    empty = spark.createDataFrame([], "country string, age double")
    assert [r["rows"] for r in preprocess_parameters(empty, features).collect()] == [0, 0]
    nulls = spark.createDataFrame([(None, None)] * 3, "country string, age double")
    got = preprocess_parameters(nulls, features).orderBy("position").collect()
    assert [(r["rows"], r["mode"], r["median"]) for r in got] == [(3, None, None)] * 2


def test_pipeline_contract_reload_and_extra_columns(spark, conversions, tmp_path):
    features = FEATURES["in_session"]
    fitted = build_model_pipeline(features).fit(conversions)
    plain = conversions.limit(200)
    request = plain.withColumns({
        "country": F.when(F.col("row_id") % 4 == 0, F.lit("Atlantis")).otherwise(F.col("country")),
        "source": F.when(F.col("row_id") % 5 != 0, F.col("source")),
        "age": F.when(F.col("row_id") % 6 != 0, F.col("age")),
    })
    scored = score_rows(fitted, request, keep=["row_id"])
    poisoned = request.withColumns({
        "converted": F.lit(1 - F.col("converted")), "probability": F.lit("x"),
        "features": F.lit(3), "outcome": F.rand(3),
    }).select(*reversed([*request.columns, "probability", "features", "outcome"]))
    assert rows(scored) == rows(score_rows(fitted, poisoned, keep=["row_id"]))
    fitted.write().overwrite().save(str(tmp_path / "model"))
    reloaded = PipelineModel.load(str(tmp_path / "model"))
    assert rows(scored) == rows(score_rows(reloaded, request, keep=["row_id"]))
    keyed = lambda f: select_top_k(
        f.withColumn("key", F.concat(F.lit("k"), "row_id")), capacity=20
    ).where("selected").select("key")
    assert rows(keyed(scored)) == rows(keyed(score_rows(fitted, poisoned, keep=["row_id"])))
    with pytest.raises(Exception, match="age is out of range"):
        score_rows(fitted, plain.withColumn("age", F.lit(5))).collect()


def test_logistic_fit_is_at_the_optimum(conversions):
    """Gradient of the penalized log loss at the fitted weights."""
    fitted = build_model_pipeline(FEATURES["in_session"]).fit(conversions)
    model = fitted.stages[-1]
    data = fitted.transform(conversions).select("tm_features", "tm_probability", "converted")
    gradient = list(model.coefficients)
    bias = 0.0
    for r in data.collect():
        residual = r["tm_probability"][1] - r["converted"]
        bias += residual
        for i, x in enumerate(r["tm_features"].toArray()):
            gradient[i] += residual * x
    assert max(abs(g) for g in [bias, *gradient]) < 0.5


def test_gradient_per_slot(spark, conversions):
    """The aggregate against sums over dense vectors, at weights that are not the optimum."""
    fitted = build_model_pipeline(FEATURES["in_session"]).fit(conversions)
    moved = conversions.withColumn("converted", (F.col("row_id") % 2).cast("int"))
    got = {(r[0], r[1]): r[2] for r in loss_gradient(fitted, moved).collect()}
    data = fitted.transform(moved).select("tm_features", "tm_probability", "converted").collect()
    want = np.array(fitted.stages[-1].coefficients)
    for r in data:
        want = want + (r["tm_probability"][1] - r["converted"]) * r["tm_features"].toArray()
    slots = [("country", c) for c in ("DE", "UK", "US")] + [("source", c) for c in ("Ads", "Seo")]
    slots += [(n, None) for n in ("age", "new_user", "total_pages_visited")]
    assert [got.pop(s) for s in slots] == pytest.approx((want / len(data)).tolist(), abs=1e-9)
    bias = sum(r["tm_probability"][1] - r["converted"] for r in data) / len(data)
    assert got == {("intercept", None): pytest.approx(bias, abs=1e-9)}
    assert max(abs(r[2]) for r in loss_gradient(fitted, conversions).collect()) < 5e-5
    with pytest.raises(ContractError):
        loss_gradient(build_model_pipeline(["age"], FOREST, trees=2).fit(conversions), conversions)


def test_bad_pipelines(conversions):
    for features, name in (((), "logistic_regression"), (("age", "age"), "logistic_regression"),
                           (("shoe",), "logistic_regression"), (("age",), "oracle")):
        with pytest.raises(ContractError):
            build_model_pipeline(features, name)
    with pytest.raises(ContractError, match="training rows"):
        build_model_pipeline(("age",)).fit(conversions.limit(0))
    assert FeatureContract(["age"]).transform(conversions).columns[-1] == "age"


def test_champion(spark):
    costs = spark.createDataFrame(
        [("a", "x", 2.0), ("a", "y", 1.0), ("b", "y", 1.0), ("b", "x", 1.0)],
        "scenario string, model string, expected_cost_per_1000 double",
    )
    assert rows(champion(costs)) == [("a", "y"), ("b", "x")]


# Stress ----------------------------------------------------------------------------------


def test_corruption_shares_and_ranges(spark):
    frame = spark.range(20_000).selectExpr(
        "id as row_id", "'US' as country", "30 as age", "0 as new_user", "'Ads' as source",
        "2 as total_pages_visited",
    )
    got = corrupted_inputs(frame, "in_session", seed=1).groupBy("variant").agg(
        F.avg(F.col("country").isNull().cast("int")).alias("gap"),
        F.avg((F.col("source") == "__UNSEEN__").cast("int")).alias("unseen"),
        F.stddev("age").alias("age"), F.min("total_pages_visited").alias("low"),
        F.count(F.lit(1)).alias("n"),
    )
    by = {r["variant"]: r for r in got.collect()}
    assert len(by) == 4 and all(r["n"] == 20_000 for r in by.values())
    assert by["five_percent_cells_missing"]["gap"] == pytest.approx(0.05, abs=0.01)
    assert by["five_percent_unseen_categories"]["unseen"] == pytest.approx(0.05, abs=0.01)
    assert by["age_measurement_noise_sd_3"]["age"] == pytest.approx(3.0, abs=0.1)
    assert by["page_count_measurement_noise_sd_2"]["low"] == 1
    assert corrupted_inputs(frame, "acquisition", seed=1).select("variant").distinct().count() == 3


def test_permutation_keeps_counts_and_breaks_the_link(conversions):
    got = permuted_labels(conversions, seed=5)
    total = got.agg(
        F.count(F.lit(1)), F.sum("converted") - F.sum("permuted_label"),
        F.corr("converted", "permuted_label"),
    ).first()
    assert total[0] == 1200 and total[1] == 0 and abs(total[2]) < 0.15
    assert rows(got) == rows(permuted_labels(conversions.repartition(9), seed=5))
    noisy = random_scores(conversions, 0.2, seed=5).agg(F.stddev("score"), F.avg("score")).first()
    assert noisy[0] == pytest.approx(1e-4, rel=0.1) and noisy[1] == pytest.approx(0.2, abs=1e-4)


@pytest.mark.parametrize("size, spread", [(4000, 10), (4000, 2), (4000, 10_000), (50, 7)])
def test_replicates_draw_as_many_rows(spark, monkeypatch, size, spread):
    """Each replicate has as many rows as the table, spread as draws with replacement are."""
    monkeypatch.setattr(bootstrap, "LEAST_BUCKETS", 9)  # tied blocks reach over several buckets
    frame = spark.range(size).selectExpr(
        "cast(id % 3 = 0 as int) as label", f"pmod(xxhash64(id), {spread}) / {spread}D as score"
    )
    cells = threshold_sweep(frame)
    sums = bootstrap.resampled_cells(cells, size, samples=60, seed=1)
    swept = bootstrap.replicate_sweep(sums, 60).toPandas()
    wanted = cells.toPandas().set_index("score")
    for _, own in swept.groupby("replicate"):
        own = own.sort_values("score", ascending=False)
        assert own["n"].sum() == size == own["all_n"].iloc[0] and own["all_pos"].nunique() == 1
        assert (own["cum_n"] == own["n"].cumsum()).all() and (own["cum_pos"] == own["pos"].cumsum()).all()
        assert own["pos"].sum() == own["all_pos"].iloc[0] and own["score"].is_unique
    # A cell of n rows has n draws on average, with the variance of a binomial count.
    mean = swept.groupby("score")["n"].sum().reindex(wanted.index, fill_value=0) / 60
    error = np.sqrt(wanted["n"] * (1 - wanted["n"] / size) / 60)
    assert (abs(mean - wanted["n"]) <= 5 * error + 1e-9).all()
    draws = swept["n"].pow(2).sum() / 60
    assert draws == pytest.approx((wanted["n"] ** 2 + wanted["n"] * (1 - wanted["n"] / size)).sum(), rel=0.05)


def test_bootstrap_covers_the_estimate(spark):
    frame = spark.range(4000).selectExpr(
        "id as key", "cast(pmod(xxhash64(id), 10) < id % 10 as int) as label",
        "(id % 10) / 10D as score",
    )
    for r in bootstrap_interval(frame, ["roc_auc", "brier_score"], samples=40).collect():
        assert r["lower_95"] < r["estimate"] < r["upper_95"] and r["resamples"] == 40
    own = bootstrap_interval(frame, {"mine": brier_sum}, samples=20).first()
    assert own["metric"] == "mine"
    with pytest.raises(ContractError):
        bootstrap_interval(frame, samples=19)
    with pytest.raises(Exception, match="too few valid"):
        bootstrap_interval(frame.withColumn("label", F.lit(1)), samples=20).collect()


# Policies --------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def scored(conversions):
    return stratified_split(conversions, [1, 2]).select(
        "seed", "split", "row_id", F.col("converted").alias("label"),
        (F.col("total_pages_visited") / 20.0).alias("score"),
    )


def test_test_rows_cannot_move_the_threshold(scored):
    policies = grid.policy_grid([4.0], [0.05])
    flipped = scored.withColumns({
        "label": F.when(F.col("split") == "test", 1 - F.col("label")).otherwise(F.col("label")),
        "score": F.when(F.col("split") == "test", 1 - F.col("score")).otherwise(F.col("score")),
    })
    frozen = [rows(grid.frozen_thresholds(f, policies, ["seed"])) for f in (scored, flipped)]
    assert frozen[0] == frozen[1]
    judged = [grid.policy_runs(f, policies) for f in (scored, flipped)]
    cost = [rows(j.select("seed", "policy_id", "role", "expected_cost_per_1000")) for j in judged]
    assert cost[0] != cost[1]


def test_infeasible_comparisons_are_null(spark):
    data = [
        (1, s, i, label, score)
        for s, labels, values in (
            ("validation", (0, 0, 0, 1), (0.9, 0.8, 0.7, 0.6)),
            ("test", (0, 0, 1, 1), (0.9, 0.8, 0.1, 0.1)),
        )
        for i, (label, score) in enumerate(zip(labels, values))
    ]
    frame = spark.createDataFrame(
        data, "seed int, split string, row_id long, label int, score double"
    )
    policies = grid.policy_grid([4.0], [0.25])
    comparison = grid.policy_comparison(grid.policy_runs(frame, policies))
    bound = comparison.where("ceiling is not null").first()
    assert bound["theoretical_threshold"] == 0.2 and bound["theoretical_selection_rate"] == 0.5
    assert bound["theoretical_exceeded"] and not bound["vs_theoretical_feasible"]
    lines = {
        r["name"]: r["mean"]
        for r in grid.policy_benchmark(comparison, policies, ceiling=0.25)
        .where("section = 'ceiling_sensitivity'").collect()
    }
    assert lines["relative_modeled_loss_reduction_vs_theoretical_threshold"] is None
    assert lines["raw_descriptive_relative_change_vs_theoretical_threshold"] is not None
    with pytest.raises(ContractError, match="not among"):
        grid.policy_benchmark(comparison, policies, ceiling=0.5)
    assert grid.policy_summary(comparison).count() == 2 * len(grid.SUMMARY_FIELDS)


@pytest.mark.parametrize("costs, ceilings", [
    ([], []), ([0.0], []), ([float("inf")], []), ([4.0], [0.0]), ([4.0], [1.5]),
    ([4.0, 4.0000001], []), ([4.0], [0.05, 0.0501]),
])
def test_bad_grids(costs, ceilings):
    with pytest.raises(ContractError):
        grid.policy_grid(costs, ceilings)


def test_primary_cost():
    assert grid.primary_cost([1.0, 4.0]) == 4.0 and grid.primary_cost([2.0, 3.0]) == 2.0


# Whole plans -----------------------------------------------------------------------------


def test_decision_training_and_audit(conversions, tmp_path):
    report = run_decision_optimization(
        conversions, seeds=[7], false_negative_costs=[4.0], ceilings=[0.05],
        scenarios=["in_session"],
    )
    assert report.runs.count() == 2 * 2 * 3
    assert report.splits.count() == 6 and report.primary_cost == 4.0
    assert report.benchmark().count() == 16
    names = write_report_tables(report, str(tmp_path / "decision"))
    assert "summary" in names and "scored" in names
    trained = run_training(conversions, scenarios=["in_session"], trees=3)
    assert trained.metrics.count() == 4 and trained.champions.count() == 1
    assert FOREST in {r["model"] for r in trained.metrics.collect()}
    audited = run_realism_audit(conversions, seeds=[42], bootstrap_samples=20)
    by = {(r["experiment"], r["scenario"]): r for r in audited.metrics.collect()}
    assert len(by) == 8
    pages = by["pages_only_logistic_regression", "in_session"]["average_precision"]
    control = by["permuted_training_labels_acquisition", "acquisition"]["average_precision"]
    constant = by["training_prevalence_constant", "none"]
    assert pages > 0.5 > control and constant["roc_auc"] == 0.5
    assert audited.bootstrap.count() == 6 and audited.corruption.count() == 7
    assert audited.summary.count() == 12


# Sources and sinks -----------------------------------------------------------------------


def test_csv_round_trip_and_header_checks(spark, conversions, tmp_path):
    path = str(tmp_path / "csv")
    write_csv(conversions.drop("row_id").repartition(3), path)
    table, quality = load_conversions(spark, path)
    assert table.count() == quality.first()["output_rows"] == 1200
    bad = tmp_path / "bad.csv"
    bad.write_text("country,age,age\nUS,1,2\n")
    with pytest.raises(ContractError, match="duplicate column names; count=2"):
        read_csv(spark, str(bad))
    mixed = tmp_path / "mixed"
    mixed.mkdir()
    (mixed / "a.csv").write_text("country,age\nUS,1\n")
    (mixed / "b.csv").write_text("age,country\n1,US\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(mixed)).collect()
    missing = tmp_path / "missing.csv"
    missing.write_text("country,age\nNA,1\n ,nan\n")
    assert [tuple(r) for r in read_csv(spark, str(missing)).collect()] == [(None, "1"), (" ", None)]


@pytest.mark.parametrize("form", ["parquet", "csv", "json"])
def test_manifest_finds_torn_and_changed_tables(spark, tmp_path, form):
    table = spark.createDataFrame(
        [(i, None if i % 5 == 0 else "" if i % 5 == 1 else f'a "{i}",\nb', i / 3) for i in range(50)] * 2,
        "row_id long, note string, x double",
    ).repartition(4)
    path = str(tmp_path / "table")
    write_checked(table, path, form=form)
    back = read_checked(spark, path)
    assert back.schema == table.schema and multiset_delta(table, back, table.columns).first() == (0, 0)
    files = sorted((tmp_path / "table" / "data").glob("part-*"))
    # A file twice, a file gone, a file in place of another.
    extra = files[0].with_name("part-99999-copy" + "".join(files[0].suffixes))
    shutil.copy(files[0], extra)
    with pytest.raises(ContractError, match="count=1"):
        read_checked(spark, path)
    extra.unlink()
    kept = files[1].read_bytes()
    files[1].unlink()
    with pytest.raises(ContractError, match="count=1"):
        read_checked(spark, path)
    files[1].write_bytes(files[0].read_bytes())
    for crc in files[1].parent.glob(".*.crc"):
        crc.unlink()
    with pytest.raises(ContractError, match="count=1"):
        read_checked(spark, path)
    files[1].write_bytes(kept)
    assert read_checked(spark, path).count() == 100
    with pytest.raises(ContractError, match="no manifest"):
        read_checked(spark, str(tmp_path / "none"))


def test_manifest_of_odd_tables(spark, tmp_path):
    empty = spark.createDataFrame([], "a int, b string")
    for form in ("parquet", "csv", "json"):
        path = str(tmp_path / f"empty-{form}")
        write_checked(empty, path, form=form)
        assert read_checked(spark, path).collect() == []
    parts = spark.createDataFrame([(1, "x"), (2, None), (2, "y")], "a int, b string")
    write_checked(parts, str(tmp_path / "parts"), partition_by=("b",))
    assert rows(read_checked(spark, str(tmp_path / "parts"))) == rows(parts)
    # An empty text cannot be the name of a partition, and the sink says so.
    with pytest.raises(ContractError, match="do not hold the table"):
        write_checked(parts.fillna(""), str(tmp_path / "lost"), partition_by=("b",))


def test_json_report_has_sorted_keys(spark, tmp_path):
    path = tmp_path / "report"
    write_json_report(spark.sql("select 2 as b, cast(null as int) as c, true as a"), str(path))
    text = "".join(p.read_text() for p in path.glob("part-*"))
    assert list(json.loads(text)) == ["a", "b", "c"] and text.endswith("\n")


def test_a_profile_alone_in_its_stratum_reaches_every_split(spark):
    """Over fifty seeds a single large profile is test, and validation, about a fifth of them."""
    rows = [("large", 30, 0, "Ads", i % 2) for i in range(90)]
    rows += [(f"c{i}", 20 + i, 1, "Seo", 0) for i in range(10)]
    frame = spark.createDataFrame(
        rows, "country string, age int, new_user int, source string, converted int"
    )
    split = grouped_split(frame, list(range(50)), features=ACQUISITION)
    found = split.where("country = 'large'").groupBy("seed").agg(
        F.min("split").alias("low"), F.max("split").alias("high"), F.count(F.lit(1)).alias("n")
    ).collect()
    assert len(found) == 50 and all(r["low"] == r["high"] and r["n"] == 90 for r in found)
    names = [r["low"] for r in found]
    assert 3 <= names.count("test") <= 19 and 3 <= names.count("validation") <= 19


@pytest.mark.parametrize("spread", [10_000, 3])
def test_known_metrics_are_those_of_the_sweep(spark, monkeypatch, spread):
    """The sums by bucket give what aggregates over the sweep of all replicates give."""
    monkeypatch.setattr(bootstrap, "LEAST_BUCKETS", 9)  # tied blocks reach over several buckets
    frame = spark.range(90).selectExpr(
        "cast(id % 3 = 0 as int) as label", f"pmod(xxhash64(id), {spread}) / {spread}D as score"
    )
    cells = threshold_sweep(frame)
    known = bootstrap.known_sums(cells, 90, samples=20, seed=3).orderBy("replicate")
    sums = bootstrap.resampled_cells(cells, 90, samples=20, seed=3)
    swept = bootstrap.replicate_sweep(sums, 20).groupBy("replicate").agg(
        F.max("all_pos"), F.max("all_n"), *[m().alias(name) for name, m in bootstrap.METRICS.items()]
    ).orderBy("replicate")
    made = known.select(
        "replicate", "all_pos", "all_n", *[F.expr(bootstrap._FROM_SUMS[m]) for m in bootstrap.METRICS]
    )
    for got, want in zip(made.collect(), swept.collect(), strict=True):
        assert tuple(got) == pytest.approx(tuple(want))


def test_fits_read_little(spark, conversions, monkeypatch):
    """A logistic fit passes over distinct inputs with their rows, a forest keeps its nodes."""
    from tidemark.operators import model as fitting

    assert fitting._estimator(FOREST, 10, "converted", 2).getCacheNodeIds()
    seen, made = [], fitting._estimator

    class Seeing:
        def __init__(self, inner):
            self.inner = inner

        def fit(self, vectors):
            seen.append((vectors.count(), vectors.agg(F.sum("tm_rows")).first()[0]))
            return self.inner.fit(vectors)

    monkeypatch.setattr(fitting, "_estimator", lambda *a: Seeing(made(*a)))
    once = conversions.select("age", "converted").distinct()
    thrice = once.crossJoin(spark.range(3)).drop("id")
    one, three = (build_model_pipeline(["age"]).fit(f) for f in (once, thrice))
    n = once.count()
    assert seen == [(n, n), (n, 3 * n)]
    assert list(one.stages[1].getOrDefault("means")) == pytest.approx(three.stages[1].getOrDefault("means"))


def test_corrupted_rows_are_scored_once(conversions):
    """The passes over the variants read written scores, and neither draw nor score again."""
    fitted = build_model_pipeline(ACQUISITION).fit(conversions)
    got = corruption_metrics(fitted, conversions, "acquisition", seed=42)
    plan = got._jdf.queryExecution().toString()
    assert "tm_" not in plan and "sha2(" not in plan and "FileScan parquet" in plan
    variants = corrupted_inputs(
        conversions.select("row_id", F.col("converted").alias("label"), *ACQUISITION), "acquisition", seed=42
    )
    scored = score_rows(fitted, variants, keep=["variant", "row_id", "label"])
    assert rows(got) == rows(evaluate(scored, 0.5, runs=["variant"]))
