"""Vector columns as NumPy matrices, for the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def doubles(column: str) -> Column:
    return F.col(column).cast("array<double>")


def finite(column: str) -> Column:
    """Whether the vector is there and every component is there and finite
    (never null itself; NaN compares greater than any number in Spark)."""
    inside = F.forall(doubles(column), lambda x: F.abs(x) < F.lit(float("inf")))
    return F.coalesce(inside, F.lit(False))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """The rows of a list column that all have ``width`` components, none null."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def whole_numbers(x: np.ndarray, scale: int, most: int) -> np.ndarray:
    """floor(scale * x) as 64-bit integers; a value beyond ``most`` could not
    be squared and summed in 64 bits and is an error."""
    out = np.floor(x * scale)
    if out.size and max(out.max(), -out.min()) > most:
        raise ValueError(f"a component beyond {most / scale:g} has no exact squared distance in 64 bits")
    return out.astype(np.int64)


def largest_whole(width: int) -> int:
    """The largest whole number whose squared differences over ``width``
    components still add up within 62 bits."""
    return int((2.0**62 / max(1, width)) ** 0.5) // 2
