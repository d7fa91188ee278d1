"""Model pipeline: contract, imputation, one-hot, scaling, estimator.

All fitted values come from training rows. The row work is column expressions and MLlib's own
stages; there is no Python per row.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (
    LogisticRegression,
    LogisticRegressionModel,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.durable import shared_folder, written
from tidemark.errors import ContractError
from tidemark.operators import forest
from tidemark.operators.conversion import require_sound_features
from tidemark.operators.scoring import guarded_features
from tidemark.operators.selection import ranked_values, value_counts

LOGISTIC, FOREST = "logistic_regression", "random_forest"
MODEL_NAMES = (LOGISTIC, FOREST)

# The estimators' settings.
INVERSE_REGULARIZATION = 1.0
MAX_ITERATIONS = 1000
TREES = 180
MIN_LEAF_ROWS = 12
MAX_DEPTH = 30
MODEL_SEED = 42
# Node statistics per pass: more memory, fewer passes over the data.
FOREST_MEMORY_MB = 1024
# A forest's tasks: no more than the cluster runs at once, unless one would hold too many rows. Each
# sends the statistics of all nodes.
LEAST_FOREST_ROWS, MOST_FOREST_ROWS = 10_000, 500_000
# From so many rows on, a forest is grown over the distinct inputs, unless these are too many for a
# task; otherwise MLlib grows it over single rows.
GROUPED_FROM, MOST_INPUTS = 50_000, 2_000_000


class FeatureContract(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Projects to the model's features and fails on an impossible value, in fit and in predict.

    Columns that are no features pass through unread.
    """

    featureNames = Param(
        Params._dummy(), "featureNames", "features in training order",
        TypeConverters.toListString,
    )

    def __init__(self, features: Sequence[str] = ()) -> None:
        super().__init__()
        self._set(featureNames=list(features))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        features = self.getOrDefault(self.featureNames)
        keep = [c for c in dataset.columns if c not in features]
        return guarded_features(dataset, features, keep)


_PARAMETERS = (
    "position int, feature string, rows long, mode string, levels array<string>, median double,"
    " mean double, deviation double"
)


def preprocess_parameters(
    frame: DataFrame, features: Sequence[str], *, weight: str | None = None
) -> DataFrame:
    """One row per feature: mode and levels of a category, or median, mean and deviation.

    The mode's ties go to the smallest value; the median is exact; mean and population deviation
    are those after imputation. All come from one table of value counts, which ``frame`` is read
    once for; the medians of all features are searched for together. One row per feature reaches
    the driver, with its levels, which become the slots of the model. A line of ``frame`` stands for
    as many rows as its column ``weight`` says, or for one.
    """
    counts = written(value_counts(frame, features, schemas.CATEGORICAL, weight=weight))
    category, number, rows = F.col("category"), F.col("number"), F.col("rows")
    has = category.isNotNull() | number.isNotNull()
    least = F.min(F.when(category.isNotNull(), F.struct(-rows, category.alias("mode"))))
    sums = counts.groupBy("position").agg(
        F.sum(rows).alias("rows"), F.sum(F.when(has, rows).otherwise(0)).alias("present"),
        least["mode"].alias("mode"), F.sort_array(F.collect_list(category)).alias("levels"),
        F.sum(rows * number).alias("total"),
    )
    found = {r["position"]: r for r in sums.collect()}
    means = {p: r["total"] / r["present"] for p, r in found.items() if r["total"] is not None}
    squares, medians = {}, {}
    if means:
        at = F.create_map(*[F.lit(x) for pair in means.items() for x in pair])[F.col("position")]
        spread = counts.where(number.isNotNull()).groupBy("position").agg(
            F.sum(rows * (number - at) * (number - at)).alias("squares")
        )
        squares = {r["position"]: r["squares"] for r in spread.collect()}
        # The two middle rows, which are one where the rows are odd in number.
        middle = [(p, k) for p in means for k in ((found[p]["present"] + 1) // 2, found[p]["present"] // 2 + 1)]
        values = ranked_values(counts, middle)
        medians = {p: (values[2 * i] + values[2 * i + 1]) / 2 for i, p in enumerate(means)}

    def line(position: int, name: str) -> tuple:
        r = found.get(position)
        if r is None:
            return position, name, 0, None, None, None, None, None
        if name in schemas.CATEGORICAL:
            return position, name, r["rows"], r["mode"], r["levels"], None, None, None
        if position not in means:
            return position, name, r["rows"], None, None, None, None, None
        share, gap = (r["rows"] - r["present"]) / r["rows"], medians[position] - means[position]
        inside = squares[position] / r["present"]
        deviation = math.sqrt((1 - share) * inside + share * (1 - share) * gap * gap)
        return position, name, r["rows"], None, None, medians[position], means[position] + share * gap, deviation

    return frame.sparkSession.createDataFrame(
        [line(i, name) for i, name in enumerate(features)], _PARAMETERS
    )


def _fit_preprocess(
    rows: DataFrame, features: Sequence[str], weight: str | None
) -> tuple[PreprocessModel, list, int]:
    """The fitted values, the indexers built from the same counts, and the number of rows."""
    fitted = preprocess_parameters(rows, features, weight=weight).collect()
    if not fitted[0]["rows"]:
        raise ContractError("the model needs training rows")
    text = [r for r in fitted if r["feature"] in schemas.CATEGORICAL]
    number = [r for r in fitted if r["feature"] not in schemas.CATEGORICAL]
    empty = [r for r in text if r["mode"] is None] + [r for r in number if r["median"] is None]
    if empty:
        raise ContractError(f"training features without a value; count={len(empty)}")
    model = PreprocessModel(
        [r["feature"] for r in text],
        [r["mode"] for r in text],
        [r["feature"] for r in number],
        [r["median"] for r in number],
        [r["mean"] for r in number],
        # A constant feature is centered and left unscaled.
        [r["deviation"] or 1.0 for r in number],
    )
    indexers = [
        StringIndexerModel.from_labels(
            r["levels"], f"tm_{r['feature']}", f"tm_{r['feature']}_index", "keep"
        )
        for r in text
    ]
    return model, indexers, fitted[0]["rows"]


class PreprocessModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``tm_<feature>``: imputed categories, imputed and standardized numbers."""

    categories = Param(Params._dummy(), "categories", "", TypeConverters.toListString)
    modes = Param(Params._dummy(), "modes", "", TypeConverters.toListString)
    numbers = Param(Params._dummy(), "numbers", "", TypeConverters.toListString)
    medians = Param(Params._dummy(), "medians", "", TypeConverters.toListFloat)
    means = Param(Params._dummy(), "means", "", TypeConverters.toListFloat)
    deviations = Param(Params._dummy(), "deviations", "", TypeConverters.toListFloat)

    def __init__(
        self, categories=(), modes=(), numbers=(), medians=(), means=(), deviations=()
    ) -> None:
        super().__init__()
        self._set(
            categories=list(categories), modes=list(modes), numbers=list(numbers),
            medians=list(medians), means=list(means), deviations=list(deviations),
        )

    def _transform(self, dataset: DataFrame) -> DataFrame:
        get = self.getOrDefault
        added = {
            f"tm_{name}": F.coalesce(F.col(name), F.lit(mode))
            for name, mode in zip(get(self.categories), get(self.modes))
        }
        numeric = zip(
            get(self.numbers), get(self.medians), get(self.means), get(self.deviations)
        )
        for name, median, mean, deviation in numeric:
            filled = F.coalesce(F.col(name), F.lit(median))
            added[f"tm_{name}"] = (filled - F.lit(mean)) / F.lit(deviation)
        return dataset.withColumns(added)


def one_hot(names: Sequence[str]) -> OneHotEncoder:
    """Every level its own slot, an unseen level all zeros.

    The indexer puts unseen levels last, and the encoder drops the last slot.
    """
    return OneHotEncoder(
        inputCols=[f"tm_{n}_index" for n in names], outputCols=[f"tm_{n}_slots" for n in names],
        dropLast=True,
    )


#: How many equal training rows a line stands for.
_ROWS = "tm_rows"


def _estimator(model_name: str, train_rows: int, label: str, trees: int):
    columns = dict(
        featuresCol="tm_features", labelCol=label, predictionCol="tm_prediction",
        probabilityCol="tm_probability", rawPredictionCol="tm_raw",
    )
    if model_name == LOGISTIC:
        # The penalty is on the sum of losses; MLlib's is on their mean.
        return LogisticRegression(
            regParam=1.0 / (INVERSE_REGULARIZATION * train_rows), elasticNetParam=0.0,
            standardization=False, maxIter=MAX_ITERATIONS, tol=1e-6, family="binomial",
            weightCol=_ROWS, **columns,
        )
    return RandomForestClassifier(
        numTrees=trees, minInstancesPerNode=MIN_LEAF_ROWS, maxDepth=MAX_DEPTH,
        featureSubsetStrategy="sqrt", seed=MODEL_SEED, maxMemoryInMB=FOREST_MEMORY_MB,
        # Rows keep their node in each tree; otherwise every level walks them down from the root.
        cacheNodeIds=True, **columns,
    )


def _spread(vectors: DataFrame, rows: int) -> DataFrame:
    """``vectors`` in as many partitions as a forest of ``rows`` rows should have, at least."""
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    wanted = max(min(cores, rows // LEAST_FOREST_ROWS), math.ceil(rows / MOST_FOREST_ROWS))
    return vectors.repartition(wanted) if wanted > vectors.rdd.getNumPartitions() else vectors


def _grown(
    lines: DataFrame, estimator: RandomForestClassifier, levels: Sequence[int], numbers: int
) -> RandomForestClassificationModel:
    """The forest that ``estimator`` describes, grown over coded lines with their number of rows."""
    how = forest.Growth(
        tuple(levels), numbers, estimator.getSeed(), estimator.getMinInstancesPerNode(),
        estimator.getMaxDepth(), estimator.getMaxBins(),
    )
    nodes = forest.grown_nodes(lines, estimator.getNumTrees(), how)
    return forest.forest_model(nodes, estimator, how.slots)


class ConversionEstimator(Estimator):
    """The whole pipeline. ``fit`` gives a ``PipelineModel`` that can be saved and loaded."""

    def __init__(
        self, features: Sequence[str], model_name: str, label: str, trees: int = TREES
    ) -> None:
        super().__init__()
        self.features, self.model_name, self.label = list(features), model_name, label
        self.trees = trees

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        contract = FeatureContract(self.features)
        rows = contract.transform(
            dataset.select(*self.features, F.col(self.label).cast("double").alias(self.label))
        )
        # Equal rows are one line with their number: the many passes of a fit read distinct inputs.
        lines = written(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias(_ROWS)))
        preprocess, indexers, train_rows = _fit_preprocess(lines, self.features, _ROWS)
        names = [f for f in self.features if f in schemas.CATEGORICAL]
        numbers = [f for f in self.features if f not in schemas.CATEGORICAL]
        assembler = VectorAssembler(
            inputCols=[*[f"tm_{n}_slots" for n in names], *[f"tm_{n}" for n in numbers]],
            outputCol="tm_features",
        )
        encoders = [*indexers, *([one_hot(names)] if names else []), assembler]
        prepared = preprocess.transform(lines)
        encode = Pipeline(stages=encoders).fit(prepared)
        estimator = _estimator(self.model_name, train_rows, self.label, self.trees)
        if self.model_name == LOGISTIC:
            model = estimator.fit(encode.transform(prepared).select("tm_features", self.label, _ROWS))
        elif train_rows >= GROUPED_FROM and lines.count() <= MOST_INPUTS:
            # Rows of one input are drawn together, by their number.
            coded = encode.transform(prepared).select(
                *[f"tm_{n}_index" for n in names], *[f"tm_{n}" for n in numbers], self.label, _ROWS
            )
            model = _grown(coded, estimator, [len(i.labels) for i in indexers], len(numbers))
        else:
            vectors = encode.transform(preprocess.transform(rows)).select("tm_features", self.label)
            model = estimator.fit(_spread(vectors, train_rows))
        return PipelineModel([contract, preprocess, *encode.stages, model])


def fit_all(
    jobs: Sequence[tuple[ConversionEstimator, DataFrame]], *, parallelism: int = 4
) -> list[PipelineModel]:
    """Fit several pipelines; a few at a time, so that small fits fill the cluster."""
    if not jobs:
        return []
    spark = jobs[0][1].sparkSession
    fit = inheritable_thread_target(spark)(lambda job: job[0].fit(job[1]))
    with ThreadPool(min(parallelism, len(jobs))) as pool:
        return pool.map(fit, jobs, chunksize=1)


def build_model_pipeline(
    features: Sequence[str], model_name: str = LOGISTIC, *, label: str = "converted",
    trees: int = TREES,
) -> ConversionEstimator:
    """An unfitted pipeline over ``features``; ``trees`` is for the forest only."""
    require_sound_features(tuple(features))
    if model_name not in MODEL_NAMES:
        raise ContractError(f"unknown model {model_name!r}; known: {', '.join(MODEL_NAMES)}")
    return ConversionEstimator(features, model_name, label, trees)


def score_rows(
    model: PipelineModel, frame: DataFrame, *, keep: Sequence[str] | None = None
) -> DataFrame:
    """``keep`` (all columns by default) plus ``score``, the probability of label 1."""
    keep = frame.columns if keep is None else list(keep)
    scored = model.transform(frame)
    return scored.select(*keep, vector_to_array("tm_probability")[1].alias("score"))


def saved(spark: SparkSession, model: PipelineModel) -> PipelineModel:
    """The model as read back from a copy in the shared folder."""
    path = f"{shared_folder(spark).rstrip('/')}/tidemark-model-{uuid.uuid4().hex}"
    model.save(path)
    return PipelineModel.load(path)


def champion(costs: DataFrame) -> DataFrame:
    """The model with the least validation cost, ties to the first name; per scenario.

    ``costs`` has scenario, model and expected_cost_per_1000.
    """
    return costs.groupBy("scenario").agg(
        F.min(F.struct("expected_cost_per_1000", "model"))["model"].alias(
            "champion_by_validation_cost"
        )
    )


def loss_gradient(model: PipelineModel, train: DataFrame, *, label: str = "converted") -> DataFrame:
    """``feature, level, gradient``: how far a fitted logistic model is from the optimum.

    The gradient is that of the mean penalised loss over the training rows, by the weight of each
    slot: a level of a category, a number (``level`` null) or the intercept. At the optimum it is
    0. Each row adds to the slots that it has, so a row counts once per feature whatever the
    number of levels; the penalty is added to the sums, of which there is one per slot.
    """
    contract, prepared, last = model.stages[0], model.stages[1], model.stages[-1]
    if not isinstance(last, LogisticRegressionModel):
        raise ContractError("only a logistic model has a gradient")
    features = contract.getOrDefault(contract.featureNames)
    names = [f for f in features if f in schemas.CATEGORICAL]
    numbers = [f for f in features if f not in schemas.CATEGORICAL]
    levels = {s.getInputCol(): s.labels for s in model.stages if isinstance(s, StringIndexerModel)}
    slots = [(n, level) for n in names for level in levels[f"tm_{n}"]] + [(n, None) for n in numbers]
    weights = [*zip(slots, last.coefficients.toArray().tolist(), strict=True), (("intercept", None), 0.0)]
    penalty = train.sparkSession.createDataFrame(
        [(*slot, weight) for slot, weight in weights], "feature string, level string, weight double"
    )

    def cell(name: str, level: Column, value: Column) -> Column:
        return F.struct(F.lit(name).alias("feature"), level.alias("level"), value.alias("x"))

    nothing = F.lit(None).cast("string")
    cells = [
        *[cell(n, F.col(f"tm_{n}"), F.lit(1.0)) for n in names],
        *[cell(n, nothing, F.col(f"tm_{n}")) for n in numbers],
        cell("intercept", nothing, F.lit(1.0)),
    ]
    miss = vector_to_array("tm_probability")[1] - F.col(label).cast("double")
    rows = model.transform(train).select(miss.alias("miss"), F.inline(F.array(*cells)))
    sums = rows.groupBy("feature", "level").agg(
        F.sum(F.col("miss") * F.col("x")).alias("s"), F.count(F.lit(1)).alias("n")
    )
    size = F.max(F.when(F.col("feature") == "intercept", F.col("n"))).over(Window.partitionBy())
    # One row per slot from here on.
    return sums.withColumn("n", size).join(
        penalty.withColumnsRenamed({"feature": "f", "level": "l"}),
        (F.col("feature") == F.col("f")) & F.col("level").eqNullSafe(F.col("l")),
    ).select(
        "feature", "level",
        ((F.col("s") + F.col("weight") / F.lit(INVERSE_REGULARIZATION)) / F.col("n")).alias("gradient"),
    )
