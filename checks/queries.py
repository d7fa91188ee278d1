"""One query per operator, each over the whole driver tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import lru_cache, reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.durable import durable, shared_folder, written
from tidemark.operators import bootstrap, capacity, conversion, events, metrics, model, pit
from tidemark.operators import pit_output, planning, scores, scoring, splits, stress, thresholds
from tidemark.operators.combine import multiset_delta
from tidemark.plans import audit, decision, policies, training, verification
from tidemark.sources import driver_tables as tables
from tidemark.sources import manifest, readers, writers

SEEDS = policies.DEFAULT_SEEDS
ACQUISITION = schemas.FEATURES["acquisition"]
IN_SESSION = schemas.FEATURES["in_session"]
REPLICATES = 200
DIGITS = 7

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def rounded(frame: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Doubles rounded, since the order of a sum shows in the last digits."""
    return frame.select(
        *[
            F.round(f.name, digits).alias(f.name) if isinstance(f.dataType, T.DoubleType)
            else F.col(f.name)
            for f in frame.schema
        ]
    )


def event_inputs(spark: SparkSession, folder: str, *, validate: bool = False) -> events.EventTables:
    """The driver tables as event tables. The contract has its own queries."""
    return events.event_tables(
        tables.sessions(spark, folder), tables.score_requests(spark, folder),
        tables.page_events(spark, folder), validate=validate,
    )


def per_scenario(make: Callable[[str], DataFrame]) -> DataFrame:
    """The rows of every scenario; columns that one does not have are null in it."""
    parts = [make(s).withColumn("scenario", F.lit(s)) for s in schemas.FEATURES]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


# Sources and sinks -----------------------------------------------------------------------


def _new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/tidemark-sink-{uuid.uuid4().hex}"


def _checked(rows: DataFrame, **options) -> tuple[DataFrame, str]:
    """``rows`` written with a manifest and read back, and the folder."""
    path = _new_folder(rows.sparkSession)
    manifest.write_checked(rows, path, **options)
    return manifest.read_checked(rows.sparkSession, path), path


@query
def csv_round_trip(spark, folder):
    """The CSV sink, its manifest, and the CSV source with its header check and contract."""
    rows = tables.conversions(spark, folder)
    _, path = _checked(rows, form="csv")
    table, _ = readers.load_conversions(spark, f"{path}/data", keep=("row_id",))
    return table.withColumn("row_id", F.col("row_id").cast("long"))


@query
def table_round_trip(spark, folder):
    """The table sink with partitions, read back after its files have been checked."""
    rows = written(pit.point_in_time_features(event_inputs(spark, folder)))  # read twice
    return _checked(rows, partition_by=("source",))[0]


@query
def json_round_trip(spark, folder):
    return _checked(tables.conversions(spark, folder), form="json")[0]


@query
def report_round_trip(spark, folder):
    """A one-row report as sorted JSON, read back."""
    report = conversion.conversion_quality(tables.conversions(spark, folder))
    path = _new_folder(spark)
    writers.write_json_report(report, path)
    return spark.read.schema(report.schema).json(path).select(*report.columns)


@query
def report_tables_round_trip(spark, folder):
    """All tables of a training report written, and the one of its splits read back."""
    report = _report("training", spark.sparkContext.applicationId, folder)
    path = _new_folder(spark)
    writers.write_report_tables(report, path)
    return rounded(spark.read.parquet(f"{path}/splits"))


# Point-in-time features ------------------------------------------------------------------


@query
def pit_features(spark, folder):
    return pit.point_in_time_features(event_inputs(spark, folder))


@query
def pit_features_sql(spark, folder):
    return pit.sql_features(spark, event_inputs(spark, folder))


@query
def pit_model_features(spark, folder):
    """Distinct model inputs with their frequency: no keys and no audit times."""
    features = pit.model_features(pit.point_in_time_features(event_inputs(spark, folder)))
    return features.groupBy(*features.columns).agg(F.count(F.lit(1)).alias("rows"))


@query
def pit_audit(spark, folder):
    return pit.pit_audit(event_inputs(spark, folder))


@query
def pit_canonical_features(spark, folder):
    """Engine output with doubles and NaN for null, brought back to the contract."""
    features = pit.point_in_time_features(event_inputs(spark, folder))
    as_engine = features.withColumns(
        {
            c: F.coalesce(F.col(c).cast("double"), F.lit(float("nan")))
            for c in schemas.NULLABLE_FEATURES
        }
    )
    return pit_output.canonical_features(as_engine, validate=False)


@query
def pit_output_violations(spark, folder):
    """Counters over a copy of the features with one fault per residue of the user id."""
    features = pit.point_in_time_features(event_inputs(spark, folder))
    user = F.col("user_id").cast("bigint") % 13
    pages, seen = F.col("pages_observed_at_score_time"), F.col("feature_max_event_at_us")
    faults = features.withColumns(
        {
            "country": F.when(user == 0, F.lit(" ")).otherwise(F.col("country")),
            "age": F.when(user == 1, 12).otherwise(F.col("age")),
            "new_user": F.when(user == 2, 2).otherwise(F.col("new_user")),
            "seconds_since_session_start": F.when(user == 3, -1).otherwise(
                F.col("seconds_since_session_start")
            ),
            "unique_page_categories_observed": F.when(user == 4, pages + 1)
            .when(user == 5, 0).otherwise(F.col("unique_page_categories_observed")),
            "feature_max_event_at_us": F.when(user == 6, F.col("score_at_us")).otherwise(seen),
            "seconds_since_last_page_view": F.when(user == 7, F.lit(None))
            .when(user == 8, -1)
            .otherwise(F.col("seconds_since_last_page_view")),
            "score_id": F.when(user == 9, F.col("session_id")).otherwise(F.col("score_id")),
        }
    )
    return pit_output.feature_violations(faults).select("position", "rule", "violations")


@query
def pit_poison_delta(spark, folder):
    return verification.poison_delta(event_inputs(spark, folder))


@query
def pit_single_delta(spark, folder):
    return verification.single_delta(event_inputs(spark, folder))


@query
def session_uniformity(spark, folder):
    inputs = event_inputs(spark, folder)
    parts = [
        verification.rows_per_session(inputs.sessions, child).withColumn("child", F.lit(name))
        for name, child in (("score_requests", inputs.requests), ("page_events", inputs.events))
    ]
    return parts[0].unionByName(parts[1])


@query
def pit_verification_report(spark, folder):
    return verification.verification_report(event_inputs(spark, folder)).drop(
        "spark_sql_timezone"
    )


@query
def event_contract_report(spark, folder):
    return events.event_report(event_inputs(spark, folder))


@query
def event_contract_violations(spark, folder):
    """Counters over copies of the tables with one fault per residue of a number."""
    sessions = tables.sessions(spark, folder)
    requests = tables.score_requests(spark, folder)
    page_events = tables.page_events(spark, folder)
    user = F.col("user_id").cast("bigint") % 17
    sessions = sessions.withColumns(
        {
            "country": F.when(user == 0, F.lit("\t ")).otherwise(F.col("country")),
            "source": F.when(user == 1, F.lit(None)).otherwise(F.col("source")),
            "age": F.when(user == 2, 101).when(user == 3, 12).otherwise(F.col("age")),
            "new_user": F.when(user == 4, 2).otherwise(F.col("new_user")),
        }
    ).where(user != 5)
    hour = F.element_at(F.split("score_id", "#"), -1)
    requests = requests.withColumns(
        {
            "score_id": F.when(hour == "12", F.concat("session_id", F.lit("#6"))).otherwise(
                F.col("score_id")
            ),
            "score_at": F.when(
                hour == "1", F.col("score_at") - F.make_dt_interval(hours=F.lit(2))
            ).otherwise(F.col("score_at")),
        }
    )
    number = F.col("event_id").cast("bigint") % 19
    page_events = page_events.withColumns(
        {
            "page_category": F.when(number == 0, F.lit("")).otherwise(F.col("page_category")),
            "available_at": F.when(
                number == 1, F.col("event_at") - F.make_dt_interval(secs=F.lit(1))
            ).when(number == 2, F.lit(None)).otherwise(F.col("available_at")),
            "event_at": F.when(
                number == 3, F.col("event_at") - F.make_dt_interval(days=F.lit(1))
            ).otherwise(F.col("event_at")),
            "event_id": F.when(number == 4, F.lit(None)).when(
                number == 5, F.lit("repeated")
            ).otherwise(F.col("event_id")),
        }
    )
    return events.event_violations(sessions, requests, page_events).select(
        "position", "table", "rule", "violations"
    )


# Conversion table ------------------------------------------------------------------------


def _raw_conversions(spark, folder):
    """A raw copy: padded text, ages and pages out of range by residues of the row number."""
    rows = tables.conversions(spark, folder)
    row = F.col("row_id")
    return rows.withColumns(
        {
            "country": F.concat(F.lit(" "), F.col("country"), F.lit("\t")),
            "age": F.when(row % 23 == 0, 111).otherwise(F.col("age")),
            "total_pages_visited": F.when(row % 29 == 0, 0).otherwise(
                F.col("total_pages_visited")
            ),
        }
    )


@query
def conversion_quality(spark, folder):
    return conversion.conversion_quality(_raw_conversions(spark, folder))


@query
def clean_conversions(spark, folder):
    return conversion.clean_conversions(_raw_conversions(spark, folder), keep=("row_id",))


@query
def conversion_violations(spark, folder):
    rows = tables.conversions(spark, folder)
    row = F.col("row_id") % 31
    text = F.col("age").cast("string")
    faults = rows.withColumns(
        {
            "age": F.when(row == 0, F.lit("old")).when(row == 1, F.concat(text, F.lit(".5")))
            .when(row == 2, F.lit("Infinity")).when(row == 3, F.lit(None)).otherwise(text),
            "new_user": F.when(row == 4, 2).otherwise(F.col("new_user")),
            "converted": F.when(row == 5, F.lit(float("nan"))).otherwise(
                F.col("converted").cast("double")
            ),
            "source": F.when(row == 6, F.lit(" \t")).otherwise(F.col("source")),
        }
    )
    return conversion.conversion_violations(faults).select("position", "rule", "violations")


@query
def scoring_contract_violations(spark, folder):
    rows = tables.conversions(spark, folder).drop("converted")
    row = F.col("row_id") % 37
    text = F.col("age").cast("string")
    faults = rows.withColumns(
        {
            "age": F.when(row == 0, F.lit("old")).when(row == 1, F.concat(text, F.lit(".5")))
            .when(row == 2, F.lit("Infinity")).when(row == 3, F.lit(None))
            .when(row == 4, F.lit("12")).otherwise(text),
            "new_user": F.when(row == 5, 2).otherwise(F.col("new_user")),
            "total_pages_visited": F.when(row == 6, 0.0).when(row == 7, 1.5).when(
                row == 8, F.lit(float("nan"))
            ).otherwise(F.col("total_pages_visited").cast("double")),
            "source": F.when(row == 9, F.lit(None)).otherwise(F.col("source")),
        }
    )
    return per_scenario(
        lambda scenario: scoring.scoring_violations(faults, scenario).select(
            "position", "rule", "violations"
        )
    )


@query
def scoring_features(spark, folder):
    rows = tables.conversions(spark, folder)
    row = F.col("row_id") % 41
    request = rows.withColumns(
        {
            "source": F.when(row == 0, F.lit(" ")).otherwise(
                F.concat(F.lit("  "), F.col("source"))
            ),
            "age": F.when(row == 1, F.lit(None)).otherwise(F.col("age")),
        }
    )
    return per_scenario(
        lambda scenario: scoring.prepare_features(request, scenario, keep=("row_id",))
    )


@query
def descriptive_rates(spark, folder):
    return rounded(metrics.descriptive_rates(tables.conversions(spark, folder)))


@query
def enrollment_plan(spark, folder):
    rows = tables.conversions(spark, folder)
    return rounded(
        planning.plan_enrollment(
            rows, ["country", "source"], unit="age", outcome="converted", relative_lift=-0.1
        ).unionByName(
            planning.plan_enrollment(
                rows, ["country", "source"], unit="row_id", outcome="converted", relative_lift=0.1
            )
        )
    )


# Splits ----------------------------------------------------------------------------------


@query
def profile_diagnostics(spark, folder):
    rows = tables.conversions(spark, folder)
    parts = [
        splits.profile_diagnostics(rows, features).withColumn("scenario", F.lit(name))
        for name, features in schemas.FEATURES.items()
    ]
    return rounded(parts[0].unionByName(parts[1]))


@query
def stratified_split(spark, folder):
    return splits.stratified_split(tables.conversions(spark, folder), SEEDS).select(
        "seed", "row_id", "split"
    )


@query
def profile_split(spark, folder):
    return splits.profile_split(
        tables.conversions(spark, folder), SEEDS, features=ACQUISITION
    ).select("seed", "row_id", "split")


@query
def grouped_split(spark, folder):
    return splits.grouped_split(
        tables.conversions(spark, folder), SEEDS, features=ACQUISITION
    ).select("seed", "row_id", "split")


@query
def split_profile_overlap(spark, folder):
    rows = tables.conversions(spark, folder)
    parts = [
        splits.profile_overlap(
            make(rows, SEEDS, features=ACQUISITION), ACQUISITION
        ).withColumn("strategy", F.lit(name))
        for name, make in (("profile", splits.profile_split), ("grouped", splits.grouped_split))
    ]
    return parts[0].unionByName(parts[1])


@query
def split_summary(spark, folder):
    return rounded(
        splits.split_summary(splits.stratified_split(tables.conversions(spark, folder), SEEDS))
    )


# Scores ----------------------------------------------------------------------------------


def _both(spark, folder, make) -> DataFrame:
    """The same operator over the fine and over the tied scores."""
    parts = [
        make(source(spark, folder)).withColumn("scores", F.lit(name))
        for name, source in (("fine", tables.fine_scores), ("tied", tables.tied_scores))
    ]
    return rounded(parts[0].unionByName(parts[1]))


@query
def score_violations(spark, folder):
    rows = tables.fine_scores(spark, folder)
    row = F.col("row_id") % 43
    faults = rows.withColumns(
        {
            "label": F.when(row == 0, 2).when(row == 1, F.lit(None)).otherwise(F.col("label")),
            "score": F.when(row == 2, F.lit(float("nan"))).when(row == 3, 1.5).when(
                row == 4, F.lit(None)
            ).otherwise(F.col("score")),
        }
    )
    return scores.score_violations(faults).select("position", "rule", "violations")


@query
def confusion_cost(spark, folder):
    return _both(spark, folder, lambda rows: metrics.confusion(rows, 0.5))


@query
def brier_bias(spark, folder):
    return _both(spark, folder, metrics.brier_and_bias)


@query
def ece(spark, folder):
    return _both(spark, folder, metrics.calibration_error)


@query
def roc_auc(spark, folder):
    return _both(spark, folder, metrics.roc_auc)


@query
def average_precision(spark, folder):
    return _both(spark, folder, metrics.average_precision)


@query
def budget_ranking(spark, folder):
    return _both(spark, folder, metrics.ranking_at_budget)


@query
def evaluate_metrics(spark, folder):
    return _both(spark, folder, lambda rows: metrics.evaluate(rows, 0.5))


@query
def curve_points(spark, folder):
    return rounded(metrics.curve_points(tables.fine_scores(spark, folder)))


@query
def threshold_candidates(spark, folder):
    return rounded(thresholds.candidate_thresholds(tables.fine_scores(spark, folder)))


@query
def threshold_choice(spark, folder):
    return _both(
        spark, folder, lambda rows: thresholds.select_threshold(rows, false_negative_cost=4.0)
    )


@query
def threshold_choice_ceiling(spark, folder):
    return _both(
        spark, folder,
        lambda rows: thresholds.choose_thresholds(
            rows,
            [thresholds.Policy(1.0, c, f) for c in (4.0, 10.0) for f in (0.001, 0.05, 0.5)],
        ),
    )


def _policy_runs(spark, folder) -> DataFrame:
    split = splits.stratified_split(tables.fine_scores(spark, folder), SEEDS, label="label")
    scored = durable(split.select("seed", "split", "row_id", "label", "score"))
    return policies.policy_runs(scored, policies.policy_grid())


@query
def policy_grid(spark, folder):
    return rounded(_policy_runs(spark, folder))


@query
def policy_compare(spark, folder):
    return rounded(policies.policy_comparison(_policy_runs(spark, folder)))


@query
def policy_summary(spark, folder):
    return rounded(
        policies.policy_summary(policies.policy_comparison(_policy_runs(spark, folder)))
    )


@query
def policy_diagnostics(spark, folder):
    return policies.ceiling_diagnostics(policies.policy_comparison(_policy_runs(spark, folder)))


@query
def policy_benchmark(spark, folder):
    return rounded(
        policies.policy_benchmark(
            policies.policy_comparison(_policy_runs(spark, folder)), policies.policy_grid()
        )
    )


# Capacity --------------------------------------------------------------------------------


@query
def top_k(spark, folder):
    return capacity.select_top_k(tables.tied_scores(spark, folder), capacity=1000).select(
        "key", "selected"
    )


@query
def top_k_floor(spark, folder):
    return capacity.select_top_k(
        tables.tied_scores(spark, folder), capacity=5000, minimum_score=0.9
    ).select("key", "selected")


@query
def top_k_violations(spark, folder):
    rows = tables.tied_scores(spark, folder)
    row = F.col("row_id") % 47
    faults = rows.withColumns(
        {
            "key": F.when(row == 0, F.lit("")).when(row == 1, F.concat("key", F.lit(" ")))
            .when(row == 2, F.lit(None)).when(row == 3, F.lit("same")).otherwise(F.col("key")),
            "score": F.when(row == 4, F.lit(float("nan"))).when(row == 5, -0.5).otherwise(
                F.col("score")
            ),
        }
    )
    return capacity.capacity_violations(faults).select("position", "rule", "violations")


# Robustness ------------------------------------------------------------------------------


@query
def bootstrap_interval(spark, folder):
    return _both(
        spark, folder,
        lambda rows: bootstrap.bootstrap_interval(
            rows, list(bootstrap.METRICS), samples=REPLICATES
        ),
    )


@query
def corrupted_inputs(spark, folder):
    rows = tables.conversions(spark, folder).drop("converted")
    return per_scenario(lambda scenario: stress.corrupted_inputs(rows, scenario, seed=42))


@query
def permuted_labels(spark, folder):
    return stress.permuted_labels(tables.conversions(spark, folder), seed=42).select(
        "row_id", "permuted_label"
    )


@query
def baseline_metrics(spark, folder):
    """Constant and random baselines: threshold on validation, metrics on test."""
    split = durable(splits.stratified_split(tables.conversions(spark, folder), 42))
    prevalence = split.where("split = 'train'").agg(F.avg("converted")).first()[0]
    scored = audit.baseline_scores(split, seed=42, prevalence=prevalence)
    return rounded(audit.frozen_metrics(durable(scored), ["experiment"]), 6)


# Model -----------------------------------------------------------------------------------


def _with_gaps(spark, folder):
    """Feature rows with missing cells by residues of the row number."""
    row = F.col("row_id")
    rows = tables.conversions(spark, folder)
    return rows.withColumns(
        {
            "country": F.when(row % 7 != 0, F.col("country")),
            "age": F.when(row % 5 != 0, F.col("age")),
            "total_pages_visited": F.when(row % 3 != 0, F.col("total_pages_visited")),
        }
    )


@query
def impute_scale_params(spark, folder):
    rows = model.FeatureContract(IN_SESSION).transform(_with_gaps(spark, folder))
    return rounded(model.preprocess_parameters(rows, IN_SESSION).drop("levels"))


@query
def one_hot_encoded(spark, folder):
    """Rows whose slot vector is checked level by level; every fifth source is unseen."""
    rows = tables.conversions(spark, folder)
    fitted = model.build_model_pipeline(("source",)).fit(rows)
    request = rows.select(
        "row_id",
        F.when(F.col("row_id") % 5 == 0, F.lit("__UNSEEN__")).otherwise(F.col("source")).alias(
            "source"
        ),
    )
    slots = fitted.transform(request)
    # The five segments in the order of their slots.
    levels = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
    vector = vector_to_array("tm_source_slots")
    return slots.select(
        "row_id",
        *[vector[i].cast("int").alias(f"is_{level.lower()}") for i, level in enumerate(levels)],
    )


def _fitted(split, scenario):
    """A logistic model over the training rows of ``split``."""
    features = schemas.features_of(scenario)
    return model.build_model_pipeline(features).fit(split.where("split = 'train'"))


@query
def model_scores(spark, folder):
    split = durable(splits.stratified_split(tables.conversions(spark, folder), 42))
    test = split.where("split = 'test'")
    return rounded(
        per_scenario(
            lambda scenario: model.score_rows(
                _fitted(split, scenario), test, keep=["row_id", "converted"]
            )
        ), 6,
    )


@query
def model_optimality(spark, folder):
    """Each slot of the fitted weights with the size of its gradient, which is 0 at the optimum."""
    split = durable(splits.stratified_split(tables.conversions(spark, folder), 42))
    train = split.where("split = 'train'")
    found = per_scenario(lambda s: model.loss_gradient(_fitted(split, s), train))
    return found.select(
        "scenario", "feature", "level", F.round(F.abs("gradient"), 4).alias("gradient")
    )


@query
def reload_parity(spark, folder):
    """Scores of fitted models before they are saved and after, as multisets."""
    split = durable(splits.stratified_split(tables.conversions(spark, folder), 42))
    test = split.where("split = 'test'")

    def delta(scenario):
        fitted = _fitted(split, scenario)
        before, after = (
            model.score_rows(m, test, keep=["row_id"]) for m in (fitted, model.saved(spark, fitted))
        )
        return multiset_delta(before, after, ["row_id", "score"])

    return per_scenario(delta)


@query
def capacity_handoff(spark, folder):
    """Selections from a fitted model and its saved form, with outcomes poisoned in the latter."""
    split = durable(splits.stratified_split(tables.conversions(spark, folder), 42))
    test = split.where("split = 'test'")
    poisoned = test.withColumns(
        {"converted": 1 - F.col("converted"), "outcome": F.col("row_id"), "features": F.lit("x")}
    )

    def chosen(fitted, rows):
        scored = model.score_rows(fitted, rows, keep=["row_id"])
        keyed = scored.withColumn("key", F.concat(F.lit("r"), F.col("row_id").cast("string")))
        return capacity.select_top_k(keyed, capacity=200).where("selected").select("key", "score")

    def delta(scenario):
        fitted = _fitted(split, scenario)
        return multiset_delta(
            chosen(fitted, test), chosen(model.saved(spark, fitted), poisoned), ["key", "score"]
        )

    return per_scenario(delta)


# Reports: one query per table of a full run -----------------------------------------------


@lru_cache(maxsize=8)
def _report(kind: str, application: str, folder: str):
    """A run is made once per application and folder; its tables lie in the shared folder."""
    runs = {
        "training": training.run_training,
        "decision": decision.run_decision_optimization,
        "audit": audit.run_realism_audit,
    }
    return runs[kind](tables.conversions(SparkSession.active(), folder))


def _checked_quality(rows: DataFrame) -> DataFrame:
    conversion.clean_conversions(rows, keep=("row_id",))  # raises as the report does
    return conversion.conversion_quality(rows)


def _clean(rows: DataFrame) -> DataFrame:
    return conversion.clean_conversions(rows, keep=("row_id",))


#: Tables of a report that rest on no model: they are made without the rest of the run.
_PLAIN: dict[tuple[str, str], Callable[[DataFrame], DataFrame]] = {
    ("training", "splits"): lambda rows: splits.split_summary(training.training_rows(rows)),
    ("decision", "quality"): _checked_quality,
    ("decision", "splits"): lambda rows: decision.strategy_summary(decision.decision_rows(rows)),
    ("audit", "quality"): _checked_quality,
    ("audit", "profiles"): lambda rows: audit.scenario_diagnostics(_clean(rows)),
    ("audit", "splits"): lambda rows: audit.strategy_summary(*audit.audit_rows(_clean(rows))),
}


def _report_table(kind: str, name: str) -> Query:
    plain = _PLAIN.get((kind, name))

    def table(spark, folder):
        if plain is not None:
            return rounded(plain(tables.conversions(spark, folder)))
        report = _report(kind, spark.sparkContext.applicationId, folder)
        return rounded(getattr(report, name))

    table.__name__ = f"{kind}_{name}"
    return query(table)


for _kind, _names in (
    ("training", ("splits", "choices", "metrics", "champions", "curves")),
    ("decision", ("quality", "splits", "runs", "comparison", "summary", "diagnostics")),
    ("audit", ("quality", "profiles", "splits", "metrics", "summary", "bootstrap", "corruption")),
):
    for _name in _names:
        _report_table(_kind, _name)


@query
def corruption_metrics(spark, folder):
    split = durable(splits.stratified_split(tables.conversions(spark, folder), 42))
    test = split.where("split = 'test'")
    return rounded(
        per_scenario(
            lambda scenario: audit.corruption_metrics(
                _fitted(split, scenario), test, scenario, seed=42
            )
        ), 6,
    )
