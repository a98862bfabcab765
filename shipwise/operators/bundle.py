"""A saved scorer: model, dictionary and column lists under one version, for orders that come later.

The model's features are dictionary codes, so new orders can be scored only
with the dictionary the model was trained with. A bundle keeps them together:

    path/version=<id>/model        the fitted MLlib pipeline
    path/version=<id>/dictionary   (column_name, value, code), Parquet
    path/version=<id>/columns      text columns and features in order, JSON

``columns`` is written last, and a version without it is not complete. The
dictionary is fitted on the training rows alone; a value it does not know gets
``unseen_code`` and is counted (``features.unseen_counts``).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..session import materialize
from ..sources.files import path_exists
from . import features as fe

UNSEEN = -1
_COLUMNS = "text_columns array<string>, features array<string>, has_model boolean, written timestamp"


@dataclass
class Bundle:
    dictionary: DataFrame  # landed
    text_columns: list[str]
    features: list[str]
    model: PipelineModel | None = None


def derived(orders: DataFrame) -> DataFrame:
    """Date parts and column drops of the feature step; text columns are still text."""
    return fe.drop_non_features(fe.add_date_features(orders))


def fit_encoding(train: DataFrame) -> Bundle:
    """The dictionary of every text column that is left after the feature step, and the feature order."""
    frame = derived(train)
    text = [c for c in C.CATEGORICAL_COLS if c in frame.columns]
    text += [c for c in fe.text_columns(frame) if c not in text]
    return Bundle(materialize(fe.fit_dictionary(frame, text)), text, fe.feature_columns(frame))


def encode(orders: DataFrame, bundle: Bundle) -> DataFrame:
    """Orders as the model's features, next to every column that is not one. Columns that the orders
    lack are missing values: ``nan`` text, null numbers."""
    frame = derived(orders)
    for c in bundle.features:
        if c not in frame.columns:
            frame = frame.withColumn(c, F.lit(None).cast("string" if c in bundle.text_columns else "double"))
    return fe.apply_dictionary(frame, bundle.dictionary, bundle.text_columns, unseen_code=UNSEEN)


def unseen(orders: DataFrame, bundle: Bundle) -> DataFrame:
    """(column_name, n_unseen, n_rows): how many values of new orders the dictionary does not know."""
    return fe.unseen_counts(encode(orders, bundle), bundle.text_columns, UNSEEN)


def score(orders: DataFrame, bundle: Bundle, key: str = "row_key", out_col: str = "risk_score") -> DataFrame:
    """The orders with the model's risk. Scores come back by key: encoding drops columns."""
    from .model import score as model_score

    if bundle.model is None:
        raise ValueError("the bundle has no model")
    risk = model_score(bundle.model, encode(orders, bundle), out_col).select(key, out_col)
    return orders.join(risk, key)


def save(bundle: Bundle, path: str) -> str:
    """Writes a new version and returns its name; earlier versions stay."""
    spark = bundle.dictionary.sparkSession
    version = uuid.uuid4().hex
    folder = f"{path.rstrip('/')}/version={version}"
    bundle.dictionary.write.parquet(f"{folder}/dictionary")
    if bundle.model is not None:
        bundle.model.write().save(f"{folder}/model")
    row = spark.range(1).select(
        F.array(*map(F.lit, bundle.text_columns)).cast("array<string>").alias("text_columns"),
        F.array(*map(F.lit, bundle.features)).cast("array<string>").alias("features"),
        F.lit(bundle.model is not None).alias("has_model"), F.current_timestamp().alias("written"))
    row.coalesce(1).write.json(f"{folder}/columns")
    return version


def load(spark: SparkSession, path: str, version: str | None = None) -> Bundle:
    """The named version, else the complete one written last."""
    if version is None:
        if not path_exists(spark, path):
            raise FileNotFoundError(path)
        done = (spark.read.schema(_COLUMNS).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(path)
                .select("written", F.regexp_extract(F.col("_metadata.file_path"), "version=([^/]+)/", 1).alias("version")))
        last = done.orderBy(F.desc("written"), "version").first()
        if last is None:
            raise FileNotFoundError(f"no complete version in {path}")
        version = last["version"]
    folder = f"{path.rstrip('/')}/version={version}"
    row = spark.read.schema(_COLUMNS).json(f"{folder}/columns").first()
    model = PipelineModel.load(f"{folder}/model") if row["has_model"] else None
    return Bundle(spark.read.parquet(f"{folder}/dictionary"), list(row["text_columns"]), list(row["features"]), model)


def fit_model(train: DataFrame, params: dict | None = None) -> Bundle:
    """Dictionary and model of the training rows (raw order columns)."""
    from .model import train as model_train

    bundle = fit_encoding(train)
    bundle.model = model_train(materialize(encode(train, bundle)), bundle.features, params)
    return bundle
