"""Model bundles: a fitted pipeline with the input columns, version and metrics it was saved with."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tenura.operators.modeling import with_probability


@dataclass(frozen=True)
class ModelBundle:
    """What serving needs of a model. ``input_types`` names the raw columns in order, with their types."""

    model: PipelineModel
    input_types: Mapping[str, str]
    version: str
    metrics: Mapping[str, float]

    @property
    def input_columns(self) -> list[str]:
        return list(self.input_types)


def bundle(model: PipelineModel, train: DataFrame, features: Sequence[str], version: str, metrics: Mapping[str, float]) -> ModelBundle:
    """A checked bundle; its contract is the layout of the training rows."""
    kinds = dict(train.dtypes)
    missing = [f for f in features if f not in kinds]
    if missing:
        raise ValueError(f"the training rows lack input columns: {missing}")
    made = ModelBundle(model, {f: kinds[f] for f in features}, version, dict(metrics))
    _check(train.sparkSession, made)
    return made


def _check(spark: SparkSession, made: ModelBundle) -> None:
    """The model must score a frame that has exactly the contract's columns."""
    if not made.input_types or not made.version:
        raise ValueError("a bundle needs input columns and a version")
    layout = ", ".join(f"`{name}` {kind}" for name, kind in made.input_types.items())
    try:
        with_probability(made.model, spark.createDataFrame([], layout)).schema  # noqa: B018 - analysis only
    except (AnalysisException, ValueError, IndexError) as error:
        raise ValueError(f"the model does not fit its input columns {made.input_columns}") from error


def save_bundle(made: ModelBundle, path: str, spark: SparkSession) -> None:
    """Write model and contract below ``path`` with Spark's writers, so any file system it knows will do."""
    made.model.write().overwrite().save(f"{path}/model")
    contract = {"input_types": dict(made.input_types), "version": made.version, "metrics": dict(made.metrics)}
    row = spark.range(1).select(F.lit(json.dumps(contract)).alias("contract"))
    row.write.mode("overwrite").parquet(f"{path}/contract")


def load_bundle(spark: SparkSession, path: str) -> ModelBundle:
    """Read a bundle and check it; an incomplete contract or one that the model does not fit is an error."""
    contract = json.loads(spark.read.parquet(f"{path}/contract").first()["contract"])
    missing = sorted({"input_types", "version", "metrics"} - set(contract))
    if missing:
        raise ValueError(f"the bundle's contract lacks {missing}")
    made = ModelBundle(
        PipelineModel.load(f"{path}/model"), contract["input_types"], contract["version"], contract["metrics"]
    )
    _check(spark, made)
    return made


def checked_inputs(features: DataFrame, made: ModelBundle) -> DataFrame:
    """``features`` if it has all input columns in the contract's types; extra columns and another order are fine."""
    kinds = dict(features.dtypes)
    wrong = [f"{c}: expected {k}, actual {kinds.get(c, 'none')}" for c, k in made.input_types.items() if kinds.get(c) != k]
    if wrong:
        raise ValueError(f"the feature table breaks the model's contract: {wrong}")
    return features
