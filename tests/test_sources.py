from __future__ import annotations

import hashlib
import json

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from curveloom.functions.literal import literal_frame
from curveloom.schema import TABLES, conform
from curveloom.sources import readers, writers
from curveloom.sources.catalog import open_library
from curveloom.sources.manifest import by_name, manifest_check, sources_for
from curveloom.streaming.append import append_batches


@pytest.fixture
def folder(tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for name, text in (("same.csv", "a\n1\n"), ("altered.csv", "a\n2\n"), ("unlisted.csv", "a\n3"), ("big.bin", "x" * 3_000_000)):
        (raw / name).write_text(text)
    return raw


def sha(path):
    return hashlib.sha256(path.read_bytes()).hexdigest()


@pytest.mark.parametrize("root", ["{}", "file://{}", "{}/"])
def test_digests_are_keyed_by_relative_path(spark, folder, root):
    (folder / "a").mkdir()
    (folder / "a" / "same.csv").write_text("other")
    rows = readers.file_digests(spark, root.format(folder)).collect()
    files = [p for p in folder.rglob("*") if p.is_file()]
    assert {r["source_file"]: (r["bytes"], r["sha256"]) for r in rows} == {str(p.relative_to(folder)): (p.stat().st_size, sha(p)) for p in files}
    digests = readers.file_digests(spark, str(folder))
    assert {r["status"] for r in manifest_check(digests, digests).collect()} == {"ok"} and digests.count() == len(files)
    assert [r["source_file"] for r in readers.file_digests(spark, str(folder / "same.csv")).collect()] == ["same.csv"]


def test_large_files_are_hashed_in_blocks(spark, folder):
    (folder / "odd #1 name%20.bin").write_bytes(bytes(range(256)) * 9_000)
    (folder / "packed.gz").write_bytes(b"not really")
    whole = readers.file_digests(spark, str(folder))
    blocks = readers.file_digests(spark, f"file://{folder}", whole=3)
    assert sorted(map(tuple, blocks.collect())) == sorted(map(tuple, whole.collect()))
    assert {r["sha256"] for r in blocks.collect()} == {sha(p) for p in folder.iterdir()}
    assert readers._block_digest("viewfs://store/file") is None
    unread = blocks.withColumn("sha256", F.expr("IF(source_file = 'same.csv', NULL, sha256)"))
    assert {r["source_file"] for r in manifest_check(whole, unread).where("status = 'not hashed'").collect()} == {"same.csv"}


def test_line_counts_keep_equal_names_apart(spark, folder):
    (folder / "sub").mkdir()
    (folder / "sub" / "same.csv").write_text("1\n2\n3\n")
    rows = readers.file_row_counts(spark, str(folder)).collect()
    assert sorted((r["source_file"], r["n_rows"]) for r in rows) == [
        ("altered.csv", 2), ("big.bin", 1), ("same.csv", 2), ("sub/same.csv", 3), ("unlisted.csv", 2)]


def test_manifest(spark, folder, tmp_path):
    entry = {"url": "u", "bytes": 4, "retrieved_at": "2026-01-01T00:00:00", "version": "4.0", "peril": "fl", "kind": "data"}
    listed = {"same.csv": {**entry, "sha256": sha(folder / "same.csv"), "note": None}, "altered.csv": {**entry, "sha256": "0"}, "gone.csv": {**entry, "sha256": "1"}, "big.bin": {**entry, "sha256": sha(folder / "big.bin")}}
    (tmp_path / "manifest.json").write_text(json.dumps(listed, indent=2))
    manifest = readers.read_manifest(spark, str(tmp_path / "manifest.json"))
    assert [r["source_file"] for r in manifest.collect()] == sorted(listed)
    assert manifest.first()["version"] == "4.0"
    digests, counts = readers.file_digests(spark, str(folder)), readers.file_row_counts(spark, str(folder)).drop("path")
    expected = literal_frame(spark, [("same.csv", 4, 3), ("altered.csv", 5, None)], "source_file string, expected_bytes bigint, expected_rows bigint")
    got = {r["source_file"]: (r["status"], r["size_ok"], r["rows_ok"]) for r in manifest_check(manifest, digests, expected, counts).collect()}
    assert got == {"same.csv": ("ok", True, False), "altered.csv": ("differs", False, True), "gone.csv": ("missing", True, True),
                   "unlisted.csv": ("not in manifest", True, True), "big.bin": ("ok", True, True)}
    assert manifest_check(manifest, digests, expected).where("NOT size_ok").count() == 1
    provenance = conform(manifest, TABLES["provenance"])
    assert provenance.columns == TABLES["provenance"].columns and provenance.count() == 4


def test_sources_for(spark):
    sources = literal_frame(spark, [("a", "fl"), ("b", "hu"), ("c", "all")], "source_file string, peril string")
    assert {r["source_file"] for r in sources_for(sources, ["fl"], ["fl", "hu"]).collect()} == {"a", "c"}
    assert by_name(sources, "b").count() == 1
    with pytest.raises(ValueError, match="unknown peril"):
        sources_for(sources, ["eq"], ["fl", "hu"])


def points(spark, curves=400):
    return spark.range(curves * 10).selectExpr(f"concat('c', lpad(CAST(id % {curves} AS string), 4, '0')) AS curve_id",
                                               f"CAST(id DIV {curves} AS double) AS x", "CAST(id AS double) AS y")


def test_clustered_layout_narrows_lookups(spark, tmp_path):
    path = str(tmp_path / "clustered")
    writers.write_clustered(points(spark), path, ["curve_id", "x"], files=4, expected_rows=4000)
    ranges = []
    for file in sorted((tmp_path / "clustered").glob("*.parquet")):
        meta = pq.ParquetFile(file).metadata
        assert meta.row_group(0).column(0).compression == "ZSTD"
        for i in range(meta.num_row_groups):
            stats = meta.row_group(i).column(0).statistics
            ranges.append((stats.min, stats.max))
    assert len(ranges) == 4 and sum(low <= "c0123" <= high for low, high in ranges) <= 2
    back = spark.read.parquet(path)
    assert tuple(writers.rewrite_check(points(spark), back).first()) == (4000, 4000, True)
    assert writers.rewrite_check(points(spark), back.where("curve_id != 'c0001'")).first()["same"] is False
    changed = back.selectExpr("curve_id", "x", "IF(curve_id = 'c0001' AND x = 0, -1.0, y) AS y")
    assert writers.rewrite_check(points(spark), changed).first()["same"] is False
    with pytest.raises(ValueError, match="row count"):
        writers.write_clustered(points(spark), str(tmp_path / "short"), ["curve_id"], expected_rows=3999)


def test_hot_key_is_split_by_a_salt(spark, tmp_path):
    rows = spark.range(6000).selectExpr("IF(id < 5000, 'hot', CAST(id AS string)) AS curve_id", "CAST(id AS double) AS x", "1.0D AS y")
    writers.write_clustered(rows, str(tmp_path / "hot"), ["curve_id"], files=6, salt="x")
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in (tmp_path / "hot").glob("*.parquet")]
    assert sum(sizes) == 6000 and max(sizes) < 2500


def test_write_and_open_tables(spark, tmp_path):
    attributes = literal_frame(spark, [("a", "k", "v")], "curve_id string, key string, value string")
    writers.write_tables({"curve_points": points(spark), "curve_attributes": attributes}, str(tmp_path), max_records_per_file=1000)
    opened = open_library(spark, str(tmp_path), ["curve_points", "curve_attributes"])
    assert opened["curve_points"].count() == 4000
    assert spark.sql("SELECT count(*) AS n FROM curve_points p LEFT JOIN curve_attributes a USING (curve_id)").first()["n"] == 4000
    assert max(pq.ParquetFile(f).metadata.num_rows for f in (tmp_path / "curve_points").glob("*.parquet")) <= 1000
    with pytest.raises(ValueError, match="not declared"):
        writers.write_tables({"curve_points": points(spark).selectExpr("*", "1 AS z")}, str(tmp_path))


def test_partition_by_peril(spark, tmp_path):
    curves = literal_frame(spark, [("a", "fl"), ("b", "hu")], "curve_id string, peril string")
    writers.write_by_peril(curves, str(tmp_path / "curves"))
    assert sorted(p.name for p in (tmp_path / "curves").iterdir() if p.is_dir()) == ["peril=fl", "peril=hu"]


def test_export_quotes(spark, tmp_path):
    rows = literal_frame(spark, [('8d @ 6"/12", mixed', None, 1.5)], "label string, flag string, y double")
    writers.export_rows(rows, str(tmp_path / "csv"), "csv")
    text = next((tmp_path / "csv").glob("*.csv")).read_text()
    assert text == 'label,flag,y\n"8d @ 6""/12"", mixed",,1.5\n'
    assert readers.read_wide_csv(spark, str(tmp_path / "csv")).first()["label"] == '8d @ 6"/12", mixed'
    writers.export_rows(rows, str(tmp_path / "json"), "json")
    assert json.loads(next((tmp_path / "json").glob("*.json")).read_text()) == {"label": '8d @ 6"/12", mixed', "flag": None, "y": 1.5}
    with pytest.raises(ValueError):
        writers.export_rows(rows, str(tmp_path / "x"), "xml")


def test_append_takes_each_file_once(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "1.csv").write_text("id,p0,p1\n1,5,NULL\n2.0,6,7\n")
    (source / "2.csv").write_text("id,p0,p1\n3,8,9\n,1,1\n")

    def load():
        append_batches(spark, str(source), str(tmp_path / "out"), str(tmp_path / "state"), ["id", "p0", "p1"], "id", ["fl", "4.0"], 1).awaitTermination()
        return sorted((tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()), key=repr)

    first = load()
    assert len(first) == 6 and ("fl-4.0-1", 1.0, None) in first and ("fl-4.0-2", 1.0, 7.0) in first
    assert load() == first
    (source / "3.csv").write_text("id,p0,p1\n4,1,2\n")
    assert len(load()) == 8


def test_create_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS lib")
    writers.create_tables(spark, "lib")
    writers.create_tables(spark, "lib")
    made = {r["tableName"] for r in spark.sql("SHOW TABLES IN lib").collect() if not r["isTemporary"]}
    assert made == set(TABLES)
    assert spark.table("lib.curve_points").dtypes == [("curve_id", "string"), ("x", "double"), ("y", "double")]
    assert "curve_id string NOT NULL" in writers.create_table_sql(TABLES["curves"])


def test_jdbc_refuses_other_urls(spark):
    """The append itself needs an external database and is not run here."""
    with pytest.raises(ValueError, match="not a JDBC url"):
        writers.publish_jdbc({}, "postgresql://host/db")
    assert writers.jdbc_writer(points(spark), "jdbc:postgresql://host/db", "curve_points") is not None


def test_shared_folder_comes_from_the_session(spark):
    assert writers.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
