"""Spark ML building blocks: preprocessing, estimators, scoring and importances.

A fitted model is one PipelineModel from raw feature columns to a probability, so training and serving cannot differ.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.operators.explore import long_form
from tenura.operators.ordered import exact_quantiles
from tenura.operators.perceptron import Perceptron, fit_perceptron
from tenura.schemas import CATEGORICAL_FEATURES
from tenura.session import checkpointed, even_task_count

LABEL, WEIGHT, FEATURES = "is_churn", "class_weight", "features"
LOGISTIC, BOOSTED, PERCEPTRON, FOREST = "logistic_regression", "boosted_trees", "mlp", "random_forest"
# Above so many rows, rows are dealt evenly for fits of trees, and a forest counts the nodes of a group in so many MB a task.
DEALT_ROWS, GROUP_MB = 50_000, 1


def split_columns(features: Sequence[str]) -> tuple[list[str], list[str]]:
    """Categorical and numeric features, each in the given order."""
    categorical = [f for f in features if f in CATEGORICAL_FEATURES]
    return categorical, [f for f in features if f not in CATEGORICAL_FEATURES]


def fill_values(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Per feature the value that replaces NULL: exact median of numerics, most frequent level of categoricals.

    Equally frequent levels resolve to the smallest one, by number where they are numbers.
    """
    categorical, numeric = split_columns(features)
    parts = []
    if numeric:
        values = long_form(df, numeric)
        medians = exact_quantiles(values, "value", [0.5], keys=["column"])
        parts.append(medians.select(
            F.col("column").alias("feature"), F.lit("median").alias("strategy"), F.col("quantiles")[0].alias("number"),
            F.lit(None).cast("string").alias("level"),
        ))
    if categorical:
        entries = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("level")) for c in categorical]
        counts = (
            df.select(F.inline(F.array(*entries))).where(F.col("level").isNotNull())
            .groupBy("feature", "level").agg(F.count(F.lit(1)).alias("n"))
        )
        first = F.min(F.struct((-F.col("n")).alias("n"), F.col("level").try_cast("double").alias("number"), "level"))
        parts.append(counts.groupBy("feature").agg(first.alias("first")).select(
            "feature", F.lit("most_frequent").alias("strategy"), F.lit(None).cast("double").alias("number"),
            F.col("first.level").alias("level"),
        ))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def preprocessing_stages(df: DataFrame, features: Sequence[str]) -> list:
    """Pipeline stages from raw columns to one vector: imputation, standardised numerics, one-hot categoricals.

    The fill values, one per feature, become part of the pipeline. An unseen level encodes as all zeros.
    """
    categorical, numeric = split_columns(features)
    fills = {row["feature"]: row for row in fill_values(df, features).collect()}

    def number(name: str) -> str:
        fill = fills[name]["number"] if name in fills else 0.0
        return f"coalesce(cast({name} as double), {float(fill)!r}D) as _num_{name}"

    def level(name: str) -> str:
        fill = str(fills[name]["level"] if name in fills else "").replace("\\", "\\\\").replace("'", "\\'")
        return f"coalesce(cast({name} as string), '{fill}') as _cat_{name}"

    filled = ", ".join([number(c) for c in numeric] + [level(c) for c in categorical])
    stages: list = [SQLTransformer(statement=f"select *, {filled} from __THIS__")]
    inputs = []
    if numeric:
        stages.append(VectorAssembler(inputCols=[f"_num_{c}" for c in numeric], outputCol="_numbers"))
        stages.append(StandardScaler(inputCol="_numbers", outputCol="_scaled", withMean=True, withStd=True))
        inputs.append("_scaled")
    if categorical:
        stages.append(StringIndexer(
            inputCols=[f"_cat_{c}" for c in categorical], outputCols=[f"_idx_{c}" for c in categorical], handleInvalid="keep"
        ))
        stages.append(OneHotEncoder(
            inputCols=[f"_idx_{c}" for c in categorical], outputCols=[f"_hot_{c}" for c in categorical]
        ))
        inputs += [f"_hot_{c}" for c in categorical]
    stages.append(VectorAssembler(inputCols=inputs, outputCol=FEATURES))
    return stages


def slot_names(model: PipelineModel, features: Sequence[str]) -> dict[str, list[str]]:
    """Vector slots of each raw feature, in vector order: the name itself, or ``feature_level`` per level."""
    categorical, numeric = split_columns(features)
    slots = {c: [c] for c in numeric}
    indexer = next((s for s in model.stages if type(s).__name__ == "StringIndexerModel"), None)
    for name, levels in zip(categorical, indexer.labelsArray if indexer else []):
        slots[name] = [f"{name}_{level}" for level in levels]
    return slots


def weights_by_class(counts: Mapping[int, int], balanced: bool = True) -> dict[int, float]:
    """Balanced class weights n / (classes * n_class), or 1 for each class."""
    total = sum(counts.values())
    return {label: (total / (len(counts) * n) if balanced and n else 1.0) for label, n in counts.items()}


def class_counts(df: DataFrame, label: str = LABEL) -> dict[int, int]:
    rows = df.groupBy(F.col(label).cast("int").alias("label")).count().collect()
    return {row["label"]: row["count"] for row in rows}


def with_class_weight(df: DataFrame, weights: Mapping[int, float]) -> DataFrame:
    expression = F.when(F.col(LABEL) == 1, weights.get(1, 1.0)).otherwise(weights.get(0, 1.0))
    return df.withColumn(WEIGHT, expression)


def resampled_by_weight(df: DataFrame, key: str, weight: str = WEIGHT, seed: int = 42) -> DataFrame:
    """Repeat each row about ``weight`` times (whole part always, fraction by seeded hash of the key).

    The stand-in for sample weights where an estimator has none.
    """
    unit = F.pmod(F.xxhash64(F.lit(seed), F.col(key).cast("string")), F.lit(1 << 30)) / float(1 << 30)
    copies = (F.floor(weight) + (unit < F.col(weight) - F.floor(weight)).cast("int")).cast("int")
    return df.withColumn("_copies", copies).where("_copies > 0").withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))
    ).drop("_copies", "_copy")


def logistic_regression(rows: int, weighted: bool, c: float = 1.0, max_iter: int = 2000) -> LogisticRegression:
    """L2-penalised regression; an inverse strength ``c`` on summed losses is 1 / (c * rows) on mean losses."""
    return LogisticRegression(
        featuresCol=FEATURES, labelCol=LABEL, maxIter=max_iter, regParam=1.0 / (c * max(rows, 1)), elasticNetParam=0.0,
        standardization=False, **({"weightCol": WEIGHT} if weighted else {}),
    )


def boosted_trees(
    weighted: bool, rounds: int = 300, depth: int = 6, rate: float = 0.1, row_share: float = 0.8,
    column_share: float = 0.8, seed: int = 42, **extra,
) -> GBTClassifier:
    share = "all" if column_share >= 1.0 else str(column_share)
    return GBTClassifier(
        featuresCol=FEATURES, labelCol=LABEL, maxIter=rounds, maxDepth=depth, stepSize=rate, subsamplingRate=row_share,
        featureSubsetStrategy=share, seed=seed, checkpointInterval=10, **({"weightCol": WEIGHT} if weighted else {}), **extra,
    )


def random_forest(weighted: bool, trees: int = 400, seed: int = 42, **extra) -> RandomForestClassifier:
    return RandomForestClassifier(
        featuresCol=FEATURES, labelCol=LABEL, numTrees=trees, seed=seed, **({"weightCol": WEIGHT} if weighted else {}), **extra
    )


def dealt(vectors: DataFrame, key: str, rows: int) -> DataFrame:
    """Rows for a fit of trees, which passes over them level by level: whole rounds of equal tasks for all cores.

    Adaptive plans leave a task or two more than cores, and each pass then waits for a second round of them. Spark draws
    rows by task and place; equal rows are dealt to equal places, so the draws no longer depend on how the rows came. A
    repeated or missing key is spread by its features. At most ``DEALT_ROWS`` rows stay as they came.
    """
    if rows <= DEALT_ROWS:
        return vectors
    tasks = even_task_count(vectors.sparkSession, rows)
    return vectors.repartition(tasks, key, FEATURES).sortWithinPartitions(key, F.xxhash64(FEATURES), LABEL)


@dataclass(frozen=True)
class Prepared:
    """Fitted preprocessing and the training vectors it gives, written once for any number of estimators."""

    head: PipelineModel
    vectors: DataFrame
    counts: Mapping[int, int]
    features: Sequence[str]
    key: str


def prepare(train: DataFrame, features: Sequence[str], key: str = "msno") -> Prepared:
    labelled = train.withColumn(LABEL, F.col(LABEL).cast("double"))
    head = Pipeline(stages=preprocessing_stages(train, features)).fit(labelled)
    vectors = checkpointed(head.transform(labelled).select(key, LABEL, FEATURES))
    return Prepared(head, vectors, class_counts(vectors), features, key)


def fit(
    train: DataFrame, features: Sequence[str], kind: str, balanced: bool = True, key: str = "msno", seed: int = 42, **params
) -> PipelineModel:
    """Fit preprocessing and one classifier on raw features and return them as one pipeline."""
    return fit_prepared(prepare(train, features, key), kind, balanced, seed, **params)


def fit_prepared(prepared: Prepared, kind: str, balanced: bool = True, seed: int = 42, **params) -> PipelineModel:
    """Fit one classifier on prepared vectors; the pipeline starts from raw features all the same."""
    counts, key = prepared.counts, prepared.key
    rows = sum(counts.values())
    if kind == BOOSTED and balanced:
        # Boosting weighs positives by the negatives per positive.
        weights = {0: 1.0, 1: counts.get(0, 0) / max(counts.get(1, 0), 1)}
    else:
        weights = weights_by_class(counts, balanced)
    vectors = with_class_weight(prepared.vectors, weights)
    if kind == LOGISTIC:
        estimator = logistic_regression(rows, balanced, **params)
    elif kind == BOOSTED:
        vectors, estimator = dealt(vectors, key, rows), boosted_trees(balanced, seed=seed, **params)
    elif kind == FOREST:
        # Counts of fewer nodes stay in a core's cache; a row passes each tree once a level either way.
        memory = {"maxMemoryInMB": GROUP_MB} if rows > DEALT_ROWS else {}
        vectors, estimator = dealt(vectors, key, rows), random_forest(balanced, seed=seed, **{**memory, **params})
    elif kind == PERCEPTRON:
        inputs = sum(len(s) for s in slot_names(prepared.head, prepared.features).values())
        arrays = vectors.withColumn("_x", vector_to_array(FEATURES))
        stage, _ = fit_perceptron(arrays, key, LABEL, WEIGHT, "_x", inputs, Perceptron(seed=seed, **params), FEATURES)
        return PipelineModel(stages=[*prepared.head.stages, stage])
    else:
        raise ValueError(f"unknown model kind: {kind}")
    return PipelineModel(stages=[*prepared.head.stages, estimator.fit(vectors)])


def with_probability(model: PipelineModel, df: DataFrame, into: str = "probability") -> DataFrame:
    """Add the probability of class 1 and nothing else."""
    scored = model.transform(df.withColumn("_row", F.struct(*[F.col(c) for c in df.columns])))
    return scored.select("_row.*", vector_to_array(F.col("probability"))[1].alias(into))


def slot_importances(spark: SparkSession, model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """Impurity importance of every vector slot of a tree model, largest first."""
    names = [slot for slots in slot_names(model, features).values() for slot in slots]
    rows = list(zip(names, (float(v) for v in model.stages[-1].featureImportances.toArray())))
    return spark.createDataFrame(rows, "feature string, model_importance double").orderBy(
        F.col("model_importance").desc(), "feature"
    )
