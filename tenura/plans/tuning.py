"""Hyper-parameter search by successive halving, on the features and the strategy that earlier steps chose."""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.operators import modeling, trees
from tenura.operators.boosting import Boosted, Boosting, BoostingRun, parameters, with_boosted_probability
from tenura.operators.monitoring import roc_auc
from tenura.operators.resampling import smote
from tenura.plans.training import CLASS_WEIGHT, SMOTE, Split
from tenura.session import checkpointed

# Parts of a trial's own rounds after which the best ``1 / KEEP`` of the trials go on.
SHARES = (1 / 27, 1 / 9, 1 / 3, 1.0)
KEEP = 3


def draw_settings(trial: int, seed: int = 42, rounds: tuple[int, int] = (100, 1000)) -> Boosting:
    """The nine parameters of one trial."""
    draw = random.Random(f"{seed}:{trial}")

    def scaled(low: float, high: float) -> float:
        return math.exp(draw.uniform(math.log(low), math.log(high)))

    return Boosting(
        rounds=draw.randint(*rounds), depth=draw.randint(3, 10), rate=scaled(0.01, 0.3), row_share=draw.uniform(0.5, 1.0),
        column_share=draw.uniform(0.5, 1.0), least_child=float(draw.randint(1, 10)), gamma=draw.uniform(0.0, 5.0),
        alpha=scaled(1e-8, 10.0), penalty=scaled(1e-8, 10.0),
    )


def stored_choices(selection: DataFrame, strategies: DataFrame) -> tuple[list[str], str]:
    """The kept features in order and the chosen strategy, from the tables that those steps left."""
    kept = [r["feature"] for r in selection.where("status = 'kept'").orderBy("position").collect()]
    chosen = [r["strategy"] for r in strategies.where("chosen").collect()]
    if not kept or len(chosen) != 1:
        raise ValueError("no kept features or no single chosen strategy")
    return kept, chosen[0]


@dataclass(frozen=True)
class Inputs:
    """Training and validation vectors ``rows`` (key, label, x, train), the pipeline that made them, and the weight of class 1."""

    rows: DataFrame
    head: PipelineModel
    features: Sequence[str]
    positive_weight: float


def training_inputs(split: Split, features: Sequence[str], strategy: str = CLASS_WEIGHT, seed: int = 42) -> Inputs:
    """Vectors under a strategy: class 1 weighs the rows of class 0 per row of class 1, or gets synthetic training rows."""
    prepared = modeling.prepare(split.train, features)

    def plain(df: DataFrame, train: bool) -> DataFrame:
        return df.select(
            F.col("msno").cast("string").alias("key"), F.col(modeling.LABEL).cast("double").alias("label"),
            vector_to_array(modeling.FEATURES).alias("x")).withColumn("train", F.lit(train))

    made = plain(prepared.vectors, True)
    weight = 1.0
    if strategy == SMOTE:
        made = smote(made.drop("train"), "key", "x", "label", seed=seed).select("key", "label", "x", F.lit(True).alias("train"))
    elif strategy == CLASS_WEIGHT:
        weight = prepared.counts.get(0, 0) / max(prepared.counts.get(1, 0), 1)
    else:
        raise ValueError(f"unknown strategy: {strategy}")
    asked = plain(prepared.head.transform(split.validation.withColumn(modeling.LABEL, F.col(modeling.LABEL).cast("double"))), False)
    return Inputs(checkpointed(made.unionByName(asked)), prepared.head, list(features), weight)


def fit_boosted(inputs: Inputs, how: Boosting, seed: int = 42, patience: int | None = None) -> tuple[Boosted, BoostingRun]:
    """One penalised model, and the run with its losses."""
    run = BoostingRun(inputs.rows, [how], "key", "label", "x", "train", inputs.positive_weight, seed, patience)
    run.advance({0: how.rounds})
    return run.model(0), run


def boosted_probability(inputs: Inputs, model: Boosted, df: DataFrame) -> DataFrame:
    """(msno, probability) of raw rows."""
    vectors = inputs.head.transform(df).select("msno", vector_to_array(modeling.FEATURES).alias("x"))
    return with_boosted_probability(vectors, model, "x").select("msno", "probability")


def boosted_attributions(inputs: Inputs, model: Boosted, df: DataFrame) -> DataFrame:
    """(msno, base, prediction, attributions) of raw rows on the log-odds, exact."""
    slots = modeling.slot_names(inputs.head, inputs.features)
    vectors = inputs.head.transform(df).select("msno", vector_to_array(modeling.FEATURES).alias("x"))
    tables = trees.path_table(model.nodes(df.sparkSession))
    return trees.path_attributions(vectors, "msno", "x", tables, list(slots.values()), list(slots))


@dataclass(frozen=True)
class Search:
    """``trials`` has a row per trial, the best first; ``history`` one per trial and measured round; ``best`` the model."""

    trials: DataFrame
    history: DataFrame
    best: Boosted


def halving_search(
    inputs: Inputs, trials: int = 30, seed: int = 42, baseline_auc: float | None = None, rounds: tuple[int, int] = (100, 1000),
    patience: int | None = 30, shares: Sequence[float] = SHARES, keep: int = KEEP,
) -> Search:
    """Search for the highest validation AUC. All trials grow in the same jobs.

    At each rung a trial grows, from the trees it has, to a part of its own rounds; the best third by AUC goes on, and
    a trial ranks by what it reached last. A trial whose validation loss has not fallen for ``patience`` rounds stops
    and keeps its trees up to the best round. ``shares=(1.0,)`` runs every trial in full.
    """
    spark = inputs.rows.sparkSession
    settings = [draw_settings(t, seed, rounds) for t in range(trials)]
    run = BoostingRun(inputs.rows, settings, "key", "label", "x", "train", inputs.positive_weight, seed, patience)
    live, reached, areas = list(range(trials)), [0] * trials, [None] * trials
    for rung, share in enumerate(shares, 1):
        run.advance({t: max(1, math.ceil(settings[t].rounds * share)) for t in live})
        for r in roc_auc(run.scores(live), "label", "probability", ["trial"]).collect():
            areas[r["trial"]] = r["roc_auc"]
        for t in live:
            reached[t] = rung
        live = sorted(live, key=lambda t: (-(areas[t] if areas[t] is not None else -1.0), t))
        if rung < len(shares):
            live = live[: -(-len(live) // keep)]
    rows = [
        (t, parameters(settings[t]), reached[t], len(run.trees[t]), run.best[t][1] if patience is not None else len(run.trees[t]), areas[t])
        for t in range(trials)
    ]
    schema = "trial int, params map<string,double>, rung int, rounds int, best_round int, roc_auc double"
    table = spark.createDataFrame(rows, schema).withColumn("improvement", F.col("roc_auc") - F.lit(baseline_auc).cast("double"))
    history = spark.createDataFrame(sorted(run.losses), "trial int, round int, train_loss double, validation_loss double")
    ordered = table.orderBy(F.col("rung").desc(), F.col("roc_auc").desc(), "trial")
    return Search(ordered, history, run.model(live[0]))
