"""Readers of wide and tidy tables and of file facts."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import urlparse

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from curveloom.schema import TABLES


def read_wide_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A wide source table with every column as text."""
    return spark.read.csv(path, header=True, inferSchema=False, quote='"', escape='"', multiLine=False)


def read_typed_csv(spark: SparkSession, path: str | list[str], table: str) -> DataFrame:
    """A tidy CSV with the declared types; versions and ids stay text.

    The file may list its columns in any order and omit nullable ones.
    """
    spec = TABLES[table]
    text = read_wide_csv(spark, path)
    present = [f for f in spec.schema if f.name in text.columns]
    return text.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in present])


MANIFEST_ENTRY = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("url", "sha256")]
    + [T.StructField("bytes", T.LongType())]
    + [T.StructField(n, T.StringType()) for n in ("retrieved_at", "version", "peril", "kind", "note")]
)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a JSON object keyed by file name, sorted by name."""
    text = spark.read.text(path, wholetext=True)
    parsed = text.select(F.from_json("value", T.MapType(T.StringType(), MANIFEST_ENTRY)).alias("files"))
    rows = parsed.select(F.explode("files").alias("source_file", "entry"))
    return rows.select("source_file", "entry.*").orderBy("source_file")


def _below(path: Column, root: str) -> Column:
    """Path of a file relative to ``root``; its base name when ``root`` is the file itself."""
    inner = urlparse(root).path.rstrip("/") if "://" in root or root.startswith("file:") else root.rstrip("/")
    start = F.locate(inner + "/", path)
    inside = F.substr(path, start + len(inner) + 1)
    return F.when(start > 0, inside).otherwise(F.element_at(F.split(path, "/"), -1))


#: files up to this size are handed to a task whole; larger ones are read in blocks
WHOLE_BYTES = 64 << 20
BLOCK_BYTES = 1 << 20
_LOCATION = re.compile(r"([a-z0-9]+):(?://([^/]*))?(/.*)", re.DOTALL)


def _block_digest(path: str) -> str | None:
    """SHA-256 of one file, read in blocks; None if Arrow does not know its file system."""
    scheme, host, inner = _LOCATION.fullmatch(path).groups()
    try:
        store, root = fs.FileSystem.from_uri(f"{'s3' if scheme == 's3a' else scheme}://{host or ''}/")
    except (pa.ArrowException, OSError):
        return None
    digest = hashlib.sha256()
    with store.open_input_stream(root.rstrip("/") + inner, compression=None) as stream:
        while block := stream.read(BLOCK_BYTES):
            digest.update(block)
    return digest.hexdigest()


def _block_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests = pa.array([_block_digest(p) for p in batch.column("path").to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([*batch.columns, digests], ["path", "bytes", "sha256"])


def file_digests(spark: SparkSession, path: str, whole: int = WHOLE_BYTES) -> DataFrame:
    """(source_file, bytes, sha256) of every file below ``path``; source_file is relative to it.

    Files of up to ``whole`` bytes are read by Spark from any file system it knows.  A larger file is
    hashed in blocks by one task, whatever its size, through Arrow's file systems; where Arrow has none
    for it, sha256 is NULL.  For such stores ``whole`` may be up to 2 GiB, Spark's own limit.  Spark's scans
    pass over empty files, so these have no row.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    size = F.col("length").alias("bytes")
    # the size test reaches the scan: contents of larger files are never read there
    small = files.where(F.col("length") <= whole).select("path", size, F.sha2("content", 256).alias("sha256"))
    large = files.where(F.col("length") > whole).select("path", size).mapInArrow(
        _block_digests, "path string, bytes long, sha256 string"
    )
    return small.union(large).select(_below(F.col("path"), path).alias("source_file"), "bytes", "sha256")


def file_row_counts(spark: SparkSession, path: str) -> DataFrame:
    """(path, source_file, n_rows): physical lines of every text file below ``path``, relative to it."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    counts = lines.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.select("path", _below(F.url_decode("path"), path).alias("source_file"), "n_rows")
