"""Writers: clustered Parquet, declared tables, exports and external databases."""

from __future__ import annotations

import tempfile
import uuid
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession, functions as F

from curveloom.schema import TABLES, TableSpec, conform, undeclared_columns


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors see: the cluster's ``spark.checkpoint.dir``.

    A local session without one gets a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir is not set; name a folder that every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    return spark.sparkContext.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back, so later steps do not recompute it."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def _fingerprint(df: DataFrame) -> DataFrame:
    """Row count and an order-free hash of all rows."""
    digest = F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))
    return df.agg(F.count(F.lit(1)).alias("n_rows"), digest.alias("digest"))


def rewrite_check(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: row counts before and after a physical rewrite, and whether the rows are the same."""
    b = _fingerprint(before).select(F.struct("n_rows", "digest")).scalar()
    a = _fingerprint(after.select(*before.columns))
    return a.withColumn("b", b).select(
        F.col("b.n_rows").alias("n_before"),
        F.col("n_rows").alias("n_after"),
        (F.col("b.n_rows").eqNullSafe(F.col("n_rows")) & F.col("b.digest").eqNullSafe(F.col("digest"))).alias("same"),
    )


def write_clustered(
    df: DataFrame,
    path: str,
    keys: list[str],
    files: int | None = None,
    row_group_bytes: int = 8 << 20,
    salt: str | None = None,
    expected_rows: int | None = None,
) -> None:
    """Parquet whose files and row groups hold narrow key ranges, so lookups skip the rest.

    Fails when the written row count differs from ``expected_rows``, or from a count of ``df`` when
    that is not given (free for Parquet input, a second run for a computed table).  Range bounds come from a sample, and a key with very
    many rows stays in one range; ``salt`` names a further column that splits such a key.
    """
    bounds = [*keys, salt] if salt and salt not in keys else keys
    ranged = df.repartitionByRange(files, *bounds) if files else df.repartitionByRange(*bounds)
    (
        ranged.sortWithinPartitions(*bounds)
        .write.mode("errorifexists")
        .option("compression", "zstd")
        .option("parquet.block.size", row_group_bytes)
        .parquet(path)
    )
    before = df.count() if expected_rows is None else expected_rows
    after = df.sparkSession.read.parquet(path).count()
    if before != after:
        raise ValueError(f"{path}: rewrite changed the row count ({before} -> {after})")


def write_tables(
    tables: dict[str, DataFrame],
    root: str,
    max_records_per_file: int | None = None,
    files: dict[str, int] | None = None,
) -> None:
    """One zstd Parquet folder per declared table, laid out by its cluster key.

    ``files`` sets the number of key ranges of a table (aim at some hundred megabytes each); the
    default is the session's shuffle partitions.
    """
    for name, df in tables.items():
        spec = TABLES[name]
        undeclared_columns(df, spec)
        ranges = [files[name]] if files and name in files else []
        out = conform(df, spec).repartitionByRange(*ranges, *spec.cluster_by).sortWithinPartitions(*spec.cluster_by)
        writer = out.write.mode("overwrite").option("compression", "zstd")
        if max_records_per_file:
            writer = writer.option("maxRecordsPerFile", max_records_per_file)
        writer.parquet(f"{root}/{name}")


def save_bucketed(tables: dict[str, DataFrame], database: str, buckets: int) -> None:
    """Save the per-curve tables to the catalog bucketed by curve id.

    Joins between them (points with curves, attributes or applicability) then need no shuffle.
    """
    for name, df in tables.items():
        spec = TABLES[name]
        if "curve_id" not in spec.pk:
            raise ValueError(f"{name} is not keyed by curve_id")
        undeclared_columns(df, spec)
        order = ["curve_id"] + [c for c in spec.pk if c != "curve_id"]
        (
            conform(df, spec)
            .repartition(buckets, "curve_id")
            .write.mode("overwrite")
            .format("parquet")
            .option("compression", "zstd")
            .bucketBy(buckets, "curve_id")
            .sortBy(*order)
            .saveAsTable(f"{database}.{name}")
        )


def write_by_peril(df: DataFrame, path: str) -> None:
    """A table partitioned by peril, so a per-peril slice reads only its folder."""
    df.write.mode("errorifexists").partitionBy("peril").option("compression", "zstd").parquet(path)


def jdbc_writer(df: DataFrame, url: str, table: str, batch_rows: int = 5000, **options: str):
    """Configured appender of one table to an external database."""
    return (
        df.write.format("jdbc")
        .mode("append")
        .option("url", url)
        .option("dbtable", table)
        .option("batchsize", batch_rows)
        .options(**options)
    )


def publish_jdbc(
    tables: dict[str, DataFrame], url: str, batch_rows: int = 5000, connections: int = 8, **options: str
) -> None:
    """Append every declared table to an external database; tables not given are skipped.

    ``connections`` bounds the load on the database; the shuffle before it keeps the work that
    computes a table on all executors.
    """
    if urlparse(url).scheme != "jdbc":
        raise ValueError(f"not a JDBC url: {url}")
    for name, spec in TABLES.items():
        if name in tables:
            out = conform(tables[name], spec).repartition(connections)
            jdbc_writer(out, url, name, batch_rows, **options).save()


def export_rows(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Result rows as CSV (RFC-style quoting, header) or JSON lines."""
    writer = df.write.mode("errorifexists")
    if fmt == "csv":
        writer.csv(path, header=True, quote='"', escape='"', nullValue="", emptyValue="")
    elif fmt == "json":
        writer.option("ignoreNullFields", "false").json(path)
    else:
        raise ValueError(f"unknown export format {fmt!r}")


def point_rows(points: DataFrame, curves: DataFrame) -> DataFrame:
    """Published points with the provenance columns an export carries."""
    facts = curves.select(
        "curve_id", "version", "source_table", "source_agency", "damage_type",
        F.coalesce("defect_flag", F.lit("")).alias("defect_flag"),
        F.coalesce("defect_verified", F.lit("")).alias("defect_verified"),
    )
    return points.join(facts, "curve_id")


def create_table_sql(spec: TableSpec, database: str | None = None) -> str:
    columns = ", ".join(
        f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in spec.schema
    )
    name = f"{database}.{spec.name}" if database else spec.name
    doc = spec.doc.replace("'", "\\'")
    return f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet COMMENT '{doc}'"


def create_tables(spark: SparkSession, database: str | None = None) -> None:
    """Create the declared tables in the session catalog."""
    for spec in TABLES.values():
        spark.sql(create_table_sql(spec, database))
