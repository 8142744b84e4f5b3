"""Vectorized UDFs registered for SQL. Arrow batches, not rows."""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql.functions import pandas_udf


@pandas_udf("string")
def geo_json(country: pd.Series, state: pd.Series, city: pd.Series) -> pd.Series:
    """{"country":..,"state":..,"city":..} when a location is known, else '{}'. Every
    distinct value is quoted once."""
    def quoted(values: pd.Series) -> np.ndarray:
        codes, distinct = pd.factorize(values)
        return np.array([json.dumps(v) for v in distinct] + ["null"], dtype=object)[codes]  # missing: code -1, the last

    text = '{"country":' + quoted(country) + ',"state":' + quoted(state) + ',"city":' + quoted(city) + "}"
    return pd.Series(np.where(country.isna(), "{}", text), dtype="object")


def register_udfs(spark: SparkSession) -> None:
    spark.udf.register("geo_json", geo_json)
