"""Opening a published library as named relations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from curveloom.schema import TABLES


def read_tables(spark: SparkSession, paths: dict[str, str], register: bool = True) -> dict[str, DataFrame]:
    """Open Parquet tables by name and register each as a temporary view for ``spark.sql``."""
    opened = {name: spark.read.parquet(path) for name, path in paths.items()}
    if register:
        for name, df in opened.items():
            df.createOrReplaceTempView(name)
    return opened


def open_library(spark: SparkSession, root: str, tables: list[str] | None = None) -> dict[str, DataFrame]:
    """Open the declared tables below ``root``; their names become views."""
    return read_tables(spark, {name: f"{root}/{name}" for name in tables or TABLES})
