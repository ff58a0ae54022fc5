"""Reading the given tables and writing intermediate ones where every executor can read them."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only for an unset local session."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def stored(df: DataFrame, what: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read again.

    This cuts the lineage: an executor that is lost later costs no recomputation of ``df``.  The
    files stay until the folder is cleaned, or until ``discard``.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a table made by ``stored`` that nothing will read again."""
    spark = df.sparkSession
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for folder in folders:
        if "/llm-" not in folder:
            raise ValueError(f"not an intermediate table: {folder}")
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: caches that one operator keeps in its worker; the next map of another operator empties them
HELD: list[dict] = []
#: bytes of text that a map over texts turns into Python values at once (one text may be longer)
SLICE_BYTES = 4 << 20


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", keep: bool = False) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in pieces of about ``SLICE_BYTES`` of ``column``; freed memory goes back at the end.

    Workers serve one operator after another; unless ``keep``, the caches of others are emptied first.
    """
    for cache in [] if keep else HELD:
        cache.clear()
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_pylist()
        first, held = 0, 0
        for at, size in enumerate(sizes):
            held += size
            if held >= SLICE_BYTES:
                yield batch.slice(first, at + 1 - first)
                first, held = at + 1, 0
        if first < batch.num_rows or not batch.num_rows:
            yield batch.slice(first)
    pa.default_memory_pool().release_unused()
