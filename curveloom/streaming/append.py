"""Bounded-batch loading: new wide files are melted and appended a few at a time.

A file is taken in exactly once, also after a lost executor or a restart: the stream's checkpoint
remembers the files it has read and the Parquet sink commits whole batches.
"""

from __future__ import annotations

from pyspark.sql import SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from curveloom.functions.axis import measure_columns
from curveloom.functions.text import make_curve_id, normalise_id
from curveloom.operators.reshape import melt_points


def append_batches(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    columns: list[str],
    id_column: str,
    prefix: list[str],
    files_per_batch: int = 64,
) -> StreamingQuery:
    """Start a run that appends the points of all files not read yet, then stops."""
    from pyspark.sql import functions as F

    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    wide = (
        spark.readStream.schema(schema)
        .option("header", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(source)
        .withColumn("_id", normalise_id(F.col(id_column)))
        .where("_id IS NOT NULL")
        .withColumn("curve_id", make_curve_id(*[F.lit(p) for p in prefix], "_id"))
    )
    points = melt_points(wide, list(measure_columns(columns)), text=True)
    return (
        points.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .option("compression", "zstd")
        .trigger(availableNow=True)
        .outputMode("append")
        .start()
    )
