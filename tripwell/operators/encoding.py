"""Category indexes, one-hot vectors and the feature pipeline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Columns that are indexed, and columns that are scaled.
CATEGORY_COLUMNS = ("VendorID", "RatecodeID", "payment_type", "store_and_fwd_flag")
SCALED_COLUMNS = ("trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
                  "improvement_surcharge", "congestion_surcharge", "airport_fee", "passenger_count")


def indexer(columns: Sequence[str]) -> StringIndexer:
    """Index by falling frequency; null and unseen values share one extra index. One scan fits all columns."""
    return StringIndexer(inputCols=list(columns), outputCols=[f"{c}_idx" for c in columns], handleInvalid="keep")


def encoder(columns: Sequence[str]) -> OneHotEncoder:
    return OneHotEncoder(inputCols=[f"{c}_idx" for c in columns], outputCols=[f"{c}_ohe" for c in columns],
                         dropLast=False)


def string_index(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return indexer(columns).fit(df).transform(df)


def one_hot_encode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return Pipeline(stages=[indexer(columns), encoder(columns)]).fit(df).transform(df)


def vector_assemble(df: DataFrame, columns: Sequence[str], output: str = "features",
                    handle_invalid: str = "skip") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=output,
                           handleInvalid=handle_invalid).transform(df)


def vector_scale(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    """Assemble and standardise with the sample deviation."""
    assembled = vector_assemble(df, columns, "_raw")
    scaler = StandardScaler(inputCol="_raw", outputCol=output, withStd=True, withMean=True)
    return scaler.fit(assembled).transform(assembled).drop("_raw")


def vector_columns(df: DataFrame, vector: str, names: Sequence[str]) -> DataFrame:
    """Spread a vector over named double columns."""
    return (df.withColumn("_array", vector_to_array(vector))
            .withColumns({n: F.get("_array", F.lit(i)) for i, n in enumerate(names)})
            .drop("_array", vector))


def feature_pipeline(df: DataFrame, categories: Sequence[str] = CATEGORY_COLUMNS,
                     numbers: Sequence[str] = SCALED_COLUMNS) -> tuple[PipelineModel, DataFrame]:
    """Indexers, encoders, assembler and scaler fitted as one pipeline.

    Returns the model and the table with ``<c>_ohe`` and ``scaled_features``;
    the intermediate indexes and the raw vector are dropped.
    """
    stages = [indexer(categories), encoder(categories),
              VectorAssembler(inputCols=list(numbers), outputCol="numerical_features",
                              handleInvalid="skip"),
              StandardScaler(inputCol="numerical_features", outputCol="scaled_features",
                             withStd=True, withMean=True)]
    model = Pipeline(stages=stages).fit(df)
    out = model.transform(df).drop(*[f"{c}_idx" for c in categories], "numerical_features")
    return model, out
