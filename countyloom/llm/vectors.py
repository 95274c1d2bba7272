"""What the operators on embeddings share: which vectors take part, and names of equal ones."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def takes_part(vector: Column) -> Column:
    """False for null, empty and zero vectors and for those with null or non-finite components."""
    value = lambda x: x.cast("double")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(value(x)) & (F.abs(value(x)) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: value(x) != 0), F.lit(False))


def usable(table: DataFrame) -> DataFrame:
    """vec_id, vector, dim and `same`, a 64-bit name of the vector's value; rows without an id or that take no part are left out."""
    kept = table.where(F.col("vec_id").isNotNull() & takes_part(F.col("embedding")))
    plain = F.transform("embedding", lambda x: x + F.lit(0).cast("float"))  # a negative zero is a zero
    return kept.select("vec_id", plain.alias("vector"), F.size("embedding").alias("dim")).withColumn("same", F.xxhash64("dim", "vector"))


def matrix(vectors: pd.Series, dim: int) -> np.ndarray:
    return np.stack(vectors.to_list()).astype(np.float64) if len(vectors) else np.empty((0, dim))
