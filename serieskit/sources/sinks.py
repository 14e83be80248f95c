"""Result writers."""

from __future__ import annotations

import json
from dataclasses import asdict, is_dataclass

from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession, functions as F

from serieskit.functions.scalars import finite


def _finite_columns(df: DataFrame) -> DataFrame:
    floating = [name for name, kind in df.dtypes if kind in ("double", "float")]
    return df.withColumns({name: finite(F.col(name)) for name in floating}) if floating else df


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def in_order(df: DataFrame) -> DataFrame:
    """Rows sorted over all files by the columns that name them: texts, dates and whole numbers, from the left."""
    named = [name for name, kind in df.dtypes if kind in ("string", "date", "boolean", "int", "bigint") or kind.startswith("timestamp")]
    return df.orderBy(*[F.col(f"`{name}`") for name in named]) if named else df


def write_csv(df: DataFrame, path: str) -> None:
    in_order(df).write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines; NaN and infinities as null, dates and timestamps as text."""
    timed = [name for name, kind in df.dtypes if kind.startswith(("timestamp", "date"))]
    plain = _finite_columns(df).withColumns({name: F.col(name).cast("string") for name in timed})
    plain.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_model(spark: SparkSession, stages: dict, parameters: dict, path: str) -> None:
    """Fitted stages in their own folders beside one row of parameters."""
    for name, model in stages.items():
        model.write().overwrite().save(f"{path}/{name}")
    values = {k: asdict(v) if is_dataclass(v) else v for k, v in parameters.items()}
    row = [(json.dumps(values, default=str, sort_keys=True),)]
    spark.createDataFrame(row, "parameters string").coalesce(1).write.mode("overwrite").text(f"{path}/parameters")


def read_model(path: str) -> object:
    """A fitted stage that ``write_model`` has saved, whatever its class."""
    return DefaultParamsReader.loadParamsInstance(path, SparkSession.getActiveSession())


def key_values(row: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """A one-row frame as rows of (check, value), values as text."""
    columns = columns or row.columns
    pairs = ", ".join(f"'{c}', cast(`{c}` as string)" for c in columns)
    return row.select(F.expr(f"stack({len(columns)}, {pairs}) as (check, value)"))
