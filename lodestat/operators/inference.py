"""Batch scoring with a user's model."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCH = 32


def classify_batches(df: DataFrame, col: str, model: Callable, names: dict[int, str], batch: int = BATCH, threshold: float = 0.5) -> DataFrame:
    """Adds ``score`` and ``predicted`` from a model that maps a batch to class-one probabilities.

    ``col`` is text, an array or a vector; the model sees at most ``batch`` rows at a time.
    """
    if df.schema[col].dataType.typeName() == "vectorudt" or "Vector" in type(df.schema[col].dataType).__name__:
        df = df.withColumn(col, vector_to_array(col))
    is_text = df.schema[col].dataType.typeName() == "string"

    @F.pandas_udf("double")
    def run(s: pd.Series) -> pd.Series:
        parts = []
        for i in range(0, len(s), batch):
            rows = s.iloc[i: i + batch]
            parts.append(np.asarray(model(list(rows) if is_text else np.stack(rows.to_numpy())), dtype=float))
        return pd.Series(np.concatenate(parts) if parts else np.array([], dtype=float))

    label = F.when(F.col("score") >= threshold, F.lit(names[1])).otherwise(F.lit(names[0]))
    return df.withColumn("score", run(col)).withColumn("predicted", label)
