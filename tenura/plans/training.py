"""Training plans: splits, model comparison, imbalance strategies, feature selection, tuning and model cards."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, LogisticRegressionModel, RandomForestClassificationModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.functions.labels import case_columns
from tenura.operators import attributions, boosting, errors, explore, fairness, modeling, trees
from tenura.operators.monitoring import roc_auc
from tenura.operators.ordered import hash_positions
from tenura.operators.resampling import smote
from tenura.operators.sampling import train_validation_split
from tenura.plans.concurrent import side_by_side
from tenura.session import checkpointed

SMOTE, CLASS_WEIGHT = "smote", "class_weight_balanced"
METRICS = ["precision_churn", "recall_churn", "f1_churn", "roc_auc"]


@dataclass(frozen=True)
class Split:
    """Training and validation rows of one labelled feature table."""

    train: DataFrame
    validation: DataFrame


def split_features(features: DataFrame, validation: float = 0.2, seed: int = 42) -> Split:
    """A stratified split. The features and then the split are written once, since each is read many times."""
    marked = checkpointed(train_validation_split(checkpointed(features), "msno", "is_churn", validation, seed))
    return Split(
        marked.where(F.col("split") == "train").drop("split"),
        marked.where(F.col("split") == "validation").drop("split"),
    )


def evaluate(model: PipelineModel, validation: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Precision, recall, F1, AUC and support of class 1 on validation rows."""
    scored = checkpointed(modeling.with_probability(model, validation).select("is_churn", "probability"))
    area = roc_auc(scored, "is_churn", "probability").select("roc_auc").scalar()
    return errors.classification_metrics(case_columns(scored, "is_churn", "probability", threshold)).withColumn("roc_auc", area)


def compare_models(
    split: Split, features: Sequence[str], kinds: Mapping[str, Mapping] | Sequence[str], threshold: float = 0.5,
    balanced: bool = True, at_once: int = 3,
) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """Fit several model kinds on one split; their metrics by AUC, best first and marked, and the models.

    Fits run side by side, at most ``at_once`` at a time. A kind whose fit fails has NULL metrics and its error; it is
    never the best. Only if all fail is there no table but the first error.
    """
    spark = split.train.sparkSession
    settings = dict(kinds) if isinstance(kinds, Mapping) else {k: {} for k in kinds}
    prepared = modeling.prepare(split.train, features)

    def fitted(kind: str) -> tuple[PipelineModel, list]:
        model = modeling.fit_prepared(prepared, kind, balanced, **settings[kind])
        metrics = evaluate(model, split.validation, threshold).first()
        return model, [metrics[name] for name in METRICS]

    found = side_by_side(spark, {kind: partial(fitted, kind) for kind in settings}, at_once)
    done = {kind: outcome.value for kind, outcome in found.items() if outcome.error is None}
    if settings and not done:
        raise next(iter(found.values())).error
    best = max(done, key=lambda kind: done[kind][1][-1] if done[kind][1][-1] is not None else -1.0) if done else None
    rows = [
        (kind, *(done[kind][1] if kind in done else [None] * len(METRICS)), str(found[kind].error)[:500] if kind not in done else None)
        for kind in settings
    ]
    schema = "model string, " + ", ".join(f"{name} double" for name in METRICS) + ", error string"
    table = spark.createDataFrame(rows, schema).withColumn("best", F.col("model") == F.lit(best))
    return table.orderBy(F.col("roc_auc").desc(), "model"), {kind: model for kind, (model, _) in done.items()}


def fit_with_smote(
    train: DataFrame, features: Sequence[str], ratio: float = 0.5, neighbours: int = 5, seed: int = 42, max_iter: int = 2000
) -> PipelineModel:
    """Logistic regression on training vectors with synthetic minority rows and no class weights."""
    labelled = train.withColumn("is_churn", F.col("is_churn").cast("double"))
    prepared = Pipeline(stages=modeling.preprocessing_stages(train, features)).fit(labelled)
    vectors = checkpointed(prepared.transform(labelled).select(
        "msno", "is_churn", vector_to_array(modeling.FEATURES).alias("x")
    ))
    enlarged = checkpointed(smote(vectors, "msno", "x", "is_churn", ratio, neighbours, seed=seed))
    estimator = modeling.logistic_regression(enlarged.count(), weighted=False, max_iter=max_iter)
    fitted = estimator.fit(enlarged.select("is_churn", array_to_vector("x").alias(modeling.FEATURES)))
    return PipelineModel(stages=[*prepared.stages, fitted])


def choose_strategy(metrics: Mapping[str, Mapping[str, float]]) -> str:
    """The strategy with the higher (F1, recall); a tie goes to synthetic rows."""
    key = {name: (values["f1_churn"], values["recall_churn"]) for name, values in metrics.items()}
    return SMOTE if key[SMOTE] >= key[CLASS_WEIGHT] else CLASS_WEIGHT


def compare_imbalance(split: Split, features: Sequence[str], threshold: float = 0.5, seed: int = 42) -> DataFrame:
    """Synthetic rows against class weights, by F1, with the chosen strategy marked."""
    spark = split.train.sparkSession
    work = {
        SMOTE: lambda: evaluate(fit_with_smote(split.train, features, seed=seed), split.validation, threshold).first().asDict(),
        CLASS_WEIGHT: lambda: evaluate(
            modeling.fit(split.train, features, modeling.LOGISTIC, balanced=True, seed=seed), split.validation, threshold).first().asDict(),
    }
    found = side_by_side(spark, work)
    for outcome in found.values():
        if outcome.error is not None:
            raise outcome.error  # a choice needs both
    measured = {name: outcome.value for name, outcome in found.items()}
    chosen = choose_strategy(measured)
    rows = [(name, *[m[c] for c in METRICS], m["support_churn"], name == chosen) for name, m in measured.items()]
    schema = "strategy string, " + ", ".join(f"{c} double" for c in METRICS) + ", support_churn bigint, chosen boolean"
    return spark.createDataFrame(rows, schema).orderBy(F.col("f1_churn").desc(), "strategy")


def linear_terms(model: PipelineModel, df: DataFrame, features: Sequence[str], keep: Sequence, into: str) -> DataFrame:
    """Columns of a frame and the terms that its raw features add to a logistic model's margin, as an array.

    A term is the sum over its feature's slots, taken row by row, so equal rows have equal terms.
    """
    beta = model.stages[-1].coefficients.toArray()
    ends = np.cumsum([len(s) for s in modeling.slot_names(model, features).values()])
    groups = [slice(start, end) for start, end in zip([0, *ends[:-1]], ends)]
    order = [list(modeling.slot_names(model, features)).index(f) for f in features]
    encoded = PipelineModel(stages=model.stages[:-1]).transform(df).select(*keep, vector_to_array(modeling.FEATURES).alias(into))

    def run(batches):
        for batch in batches:
            moved = attributions.array_rows(batch.column(batch.num_columns - 1), len(beta)) * beta
            terms = np.stack([moved[:, groups[i]].sum(axis=1) for i in order], axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], attributions.row_arrays(terms)], names=batch.schema.names)

    return encoded.mapInArrow(run, encoded.schema)


def model_score(model: PipelineModel, features: Sequence[str]) -> Callable[[DataFrame], DataFrame]:
    """The score of a model for ``sampling_shapley``; a logistic one says what each raw feature adds to its margin."""
    def score(df: DataFrame) -> DataFrame:
        return modeling.with_probability(model, df)

    if not isinstance(model.stages[-1], LogisticRegressionModel):
        return score
    return attributions.AdditiveScore(
        score, lambda df, key, into: linear_terms(model, df, features, [key], into), float(model.stages[-1].intercept))


def permutation_importance(
    score: Callable[[DataFrame], DataFrame], validation: DataFrame, features: Sequence[str], label: str = "is_churn",
    key: str = "msno", repeats: int = 8, seed: int = 42,
) -> DataFrame:
    """AUC lost when one raw column is shuffled among the rows: mean and standard deviation over repeats.

    Rows are numbered in two hash orders; equal numbers pair a row with its donor. All features and repeats are scored
    in one job and share one grouped AUC. ``score`` adds ``probability`` to a frame with the raw features.
    """
    features = list(features)
    rows = checkpointed(validation.select(key, F.col(label).cast("int").alias("label"), F.struct(*features).alias("own")))
    based = hash_positions(rows, key, f"{seed}:base", "_position")
    donors = None
    for repeat in range(repeats):
        numbered = hash_positions(rows.select(key, F.col("own").alias("donor")), key, f"{seed}:{repeat}", "_position")
        part = numbered.select("_position", "donor", F.lit(repeat).alias("repeat"))
        donors = part if donors is None else donors.unionByName(part)
    paired = based.join(donors, "_position").select(key, "label", "own", "donor", "repeat")
    shuffled = paired.withColumn("shuffled", F.explode(F.array(*[F.lit(f) for f in features]))).select(
        key, "label", "repeat", "shuffled",
        *[F.when(F.col("shuffled") == f, F.col(f"donor.{f}")).otherwise(F.col(f"own.{f}")).alias(f) for f in features],
    )
    areas = roc_auc(score(shuffled), "label", "probability", ["shuffled", "repeat"])
    whole = roc_auc(score(rows.select(key, "label", "own.*")), "label", "probability").select("roc_auc").scalar()
    lost = whole - F.col("roc_auc")
    return (
        areas.groupBy(F.col("shuffled").alias("feature"))
        .agg(F.avg(lost).alias("perm_importance_mean"), F.stddev_pop(lost).alias("perm_importance_std"))
        .orderBy(F.col("perm_importance_mean").desc(), "feature")
    )


def model_permutation_importance(
    model: PipelineModel, validation: DataFrame, features: Sequence[str], label: str = "is_churn", key: str = "msno", repeats: int = 8,
    seed: int = 42,
) -> DataFrame:
    """``permutation_importance`` of a linear model or tree ensemble by differences of scores, with the same draws.

    Rows are encoded once, for a linear model as one term per feature. A row meets its donor's values once a repeat; a
    linear margin then changes by one term, an ensemble only in the trees that ask for a feature's slots. Other models are
    scored in full. AUC depends on the order of
    scores only, so margins serve as well as probabilities.
    """
    fitted, slots = model.stages[-1], modeling.slot_names(model, features)
    names, widths = list(slots), [len(s) for s in slots.values()]
    ends = np.cumsum(widths)
    groups = [list(range(end - width, end)) for end, width in zip(ends, widths)]
    if isinstance(fitted, LogisticRegressionModel):
        def swapped(own: np.ndarray, other: np.ndarray) -> np.ndarray:
            return own.sum(axis=1)[:, None] + (other - own)
    elif isinstance(fitted, (GBTClassificationModel, RandomForestClassificationModel)):
        walk = trees.Walk(trees.ensemble_nodes(fitted))

        def swapped(own: np.ndarray, other: np.ndarray) -> np.ndarray:
            return walk.swapped(own, other, groups)
    else:
        return permutation_importance(lambda df: modeling.with_probability(model, df), validation, features, label, key, repeats, seed)
    keep = [F.col(key).alias("k"), F.col(label).cast("int").alias("label")]
    if isinstance(fitted, LogisticRegressionModel):
        width, rows = len(names), checkpointed(linear_terms(model, validation, names, keep, "own"))
    else:
        encoded = PipelineModel(stages=model.stages[:-1]).transform(validation)
        width, rows = int(ends[-1]), checkpointed(encoded.select(*keep, vector_to_array(modeling.FEATURES).alias("own")))

    def scored(batches):
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                own, other = (
                    batch.column(i).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width) for i in (2, 3))
                found = swapped(own, other)
                for j in range(found.shape[1]):
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0), batch.column(1), pa.array(np.full(len(own), j, np.int32)), pa.array(np.round(found[:, j], 12))],
                        names=["label", "repeat", "shuffled", "margin"])

    based = hash_positions(rows, "k", f"{seed}:base", "_position")
    donors = None
    for repeat in range(repeats):
        part = hash_positions(rows.select("k", F.col("own").alias("donor")), "k", f"{seed}:{repeat}", "_position").select(
            "_position", "donor", F.lit(repeat).alias("repeat"))
        donors = part if donors is None else donors.unionByName(part)
    paired = based.join(donors, "_position").select("label", "repeat", "own", "donor")
    # The unshuffled rows are one more group: each row is its own donor.
    paired = paired.unionByName(rows.select("label", F.lit(-1).alias("repeat"), "own", F.col("own").alias("donor")))
    margins = paired.mapInArrow(scored, "label int, repeat int, shuffled int, margin double")
    areas = checkpointed(roc_auc(margins, "label", "margin", ["shuffled", "repeat"]))
    whole = areas.where("repeat = -1").agg(F.max("roc_auc")).first()[0]
    lost = F.lit(whole).cast("double") - F.col("roc_auc")
    name = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("shuffled") + 1)
    return (
        areas.where("repeat >= 0").groupBy(name.alias("feature"))
        .agg(F.avg(lost).alias("perm_importance_mean"), F.stddev_pop(lost).alias("perm_importance_std"))
        .orderBy(F.col("perm_importance_mean").desc(), "feature")
    )


def correlation_filter(
    ordered: Sequence[str], correlations: Mapping[tuple[str, str], float | None], threshold: float = 0.9
) -> tuple[list[str], list[str]]:
    """Keep names in order unless one already kept correlates with them at ``threshold`` or more; (kept, dropped)."""
    kept: list[str] = []
    dropped: list[str] = []
    for name in ordered:
        close = any(abs(correlations.get((name, k)) or 0.0) >= threshold for k in kept)
        (dropped if close else kept).append(name)
    return kept, dropped


def select_features(
    importances: DataFrame, train: DataFrame, minimum: int = 8, importance_threshold: float = 0.0,
    correlation_threshold: float = 0.9,
) -> DataFrame:
    """One row per feature: kept, dropped_correlation or dropped_importance, with the position of kept ones.

    Features above the importance threshold stay, at least ``minimum`` of them; then correlated numerics go, least
    important first, even below the minimum. Non-numeric features come first, then numeric ones. The importance table
    has one row per feature and the correlation matrix one per pair, so both fit the driver.
    """
    ranked = [(r["feature"], r["perm_importance_mean"]) for r in importances.orderBy(
        F.col("perm_importance_mean").desc(), "feature").collect()]
    names = [name for name, _ in ranked]
    chosen = [name for name, value in ranked if value > importance_threshold]
    if len(chosen) < minimum:
        chosen = names[:minimum]
    categorical, numeric = modeling.split_columns(chosen)
    matrix = explore.correlation_matrix(train, numeric).collect() if len(numeric) > 1 else []
    correlations = {(r["column_a"], r["column_b"]): r["correlation"] for r in matrix}
    kept, dropped = correlation_filter(numeric, correlations, correlation_threshold)
    selected = categorical + kept
    status = {name: "dropped_importance" for name in names}
    status.update({name: "dropped_correlation" for name in dropped})
    status.update({name: "kept" for name in selected})
    rows = [(n, v, status[n], selected.index(n) + 1 if n in selected else None) for n, v in ranked]
    return train.sparkSession.createDataFrame(
        rows, "feature string, perm_importance_mean double, status string, position int")


def draw_parameters(trial: int, seed: int = 42, rounds: tuple[int, int] = (100, 1000)) -> dict:
    """Boosting parameters of one random-search trial: the part of the search space that Spark's trees have."""
    draw = random.Random(f"{seed}:{trial}")
    low, high = math.log(0.01), math.log(0.3)
    return {
        "rounds": draw.randint(*rounds),
        "depth": draw.randint(3, 10),
        "rate": math.exp(draw.uniform(low, high)),
        "row_share": draw.uniform(0.5, 1.0),
        "column_share": draw.uniform(0.5, 1.0),
        "minInstancesPerNode": draw.randint(1, 10),
        # Spark's gain is impurity per node, so its scale is far below that of a summed loss.
        "minInfoGain": math.exp(draw.uniform(math.log(1e-6), math.log(1e-2))),
    }


def tune_boosted_trees(
    split: Split, features: Sequence[str], trials: int = 30, seed: int = 42, baseline_auc: float | None = None,
    balanced: bool = True, rounds: tuple[int, int] = (100, 1000),
) -> DataFrame:
    """Random search for the highest validation AUC; one row per trial, the best first. Preprocessing is fitted once."""
    spark = split.train.sparkSession
    rows = []
    prepared = modeling.prepare(split.train, features)
    for trial in range(trials):
        params = draw_parameters(trial, seed, rounds)
        model = modeling.fit_prepared(prepared, modeling.BOOSTED, balanced, seed, **params)
        area = evaluate(model, split.validation).first()["roc_auc"]
        rows.append((trial, {k: float(v) for k, v in params.items()}, area))
    table = spark.createDataFrame(rows, "trial int, params map<string,double>, roc_auc double")
    reference = F.lit(baseline_auc).cast("double")
    return table.withColumn("improvement", F.col("roc_auc") - reference).orderBy(F.col("roc_auc").desc(), "trial")


def linear_model_attributions(
    model: PipelineModel, rows: DataFrame, background: DataFrame, features: Sequence[str], key: str = "msno"
) -> DataFrame:
    """Attributions of a logistic model's margin per raw feature: coefficient * (x - background mean), slots summed."""
    head = PipelineModel(stages=model.stages[:-1])
    mean = head.transform(background).agg(Summarizer.mean(F.col(modeling.FEATURES)).alias("m")).first()["m"].toArray()
    slots = modeling.slot_names(model, features)
    names = [slot for members in slots.values() for slot in members]
    vectors = head.transform(rows).select(key, vector_to_array(modeling.FEATURES).alias("x"))
    per_slot = attributions.linear_attributions(vectors, key, "x", model.stages[-1].coefficients.toArray(), mean, names)
    return per_slot.withColumn("attributions", attributions.sum_to_features("attributions", slots))


def tree_model_attributions(model: PipelineModel, rows: DataFrame, features: Sequence[str], key: str = "msno") -> DataFrame:
    """Exact attributions of a tree ensemble per raw feature, with its base and prediction: (key, base, prediction, attributions).

    Boosted trees are explained on the log-odds, a forest on the probability; see ``trees.path_attributions``.
    """
    tables = trees.path_table(trees.ensemble_nodes(model.stages[-1]))
    slots = modeling.slot_names(model, features)
    vectors = PipelineModel(stages=model.stages[:-1]).transform(rows).select(key, vector_to_array(modeling.FEATURES).alias("x"))
    return trees.path_attributions(vectors, key, "x", tables, list(slots.values()), list(slots))


def model_attributions(
    model: PipelineModel, rows: DataFrame, background: DataFrame, features: Sequence[str], key: str = "msno", permutations: int = 8,
    seed: int = 42,
) -> DataFrame:
    """(key, attributions) of whatever kind of model: exact for linear models and trees, sampled Shapley values for others."""
    fitted = model.stages[-1]
    if isinstance(fitted, LogisticRegressionModel):
        return linear_model_attributions(model, rows, background, features, key)
    if isinstance(fitted, (GBTClassificationModel, RandomForestClassificationModel)):
        return tree_model_attributions(model, rows, features, key).select(key, "attributions")
    sampled = attributions.sampling_shapley(
        rows, background, key, features, lambda df: modeling.with_probability(model, df), permutations, seed)
    return sampled.select(key, "attributions")


def model_card(
    model_name: str, features: DataFrame, selected: Sequence[str], metrics: DataFrame, scored: DataFrame,
    stamp: str = "feature_created_at", threshold: float = 0.5,
) -> DataFrame:
    """Facts of a model card as rows of (section, name, value)."""

    def row(section: str, name, value):
        return F.struct(F.lit(section).alias("section"), F.lit(name).alias("name") if isinstance(name, str) else name.alias("name"),
                        value.cast("string").alias("value"))

    facts = features.agg(F.count(F.lit(1)).alias("n")).select(F.inline(F.array(
        row("training_data", "rows", F.col("n")), row("model", "name", F.lit(model_name)))))
    if stamp in features.columns:
        days = fairness.training_date_range(features, stamp)
        facts = facts.unionByName(days.select(F.inline(F.array(
            row("training_data", "first_day", F.col("first_day")), row("training_data", "last_day", F.col("last_day"))))))
    kinds = dict(features.dtypes)
    facts = facts.unionByName(features.sparkSession.createDataFrame(
        [("feature", name, kinds[name]) for name in selected], "section string, name string, value string"))
    facts = facts.unionByName(metrics.select(F.inline(F.array(
        *[row("metric", name, F.format_string("%.4f", name)) for name in METRICS]))))
    for group in ("gender", "age_band"):
        table = fairness.group_fairness(scored, group, probability="probability", threshold=threshold)
        facts = facts.unionByName(table.select(F.inline(F.array(
            row(f"fairness_{group}", F.concat(F.col(group), F.lit(" sample_size")), F.col("sample_size")),
            row(f"fairness_{group}", F.concat(F.col(group), F.lit(" churn_rate")), F.format_string("%.4f", "churn_rate")),
            row(f"fairness_{group}", F.concat(F.col(group), F.lit(" predicted_churn_rate")),
                F.format_string("%.4f", "predicted_churn_rate")),
        ))))
        gap = fairness.fairness_gap(table)
        facts = facts.unionByName(gap.select(F.inline(F.array(
            row(f"fairness_{group}", "gap", F.format_string("%.4f", "fairness_gap"))))))
    return facts
