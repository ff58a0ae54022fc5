"""Small literal tables that Spark knows the size of."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T


def literal_frame(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A local relation: its size is in the plan, so joins with it are broadcast without a hint."""
    schema = T.DataType.fromDDL(ddl)
    columns = {name: [row[i] for row in rows] for i, name in enumerate(schema.fieldNames())}
    return spark.createDataFrame(pa.table(columns), schema)
