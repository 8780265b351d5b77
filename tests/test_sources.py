"""Readers and writers."""

import pytest

from nestmetrics.sources import files, sinks


def test_csv_with_quotes_and_line_breaks(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_text('listing_id,comments\n1,"Great, ""really""\nwould return"\n2,\n')
    got = [tuple(r) for r in files.read_csv(spark, str(path), "listing_id long, comments string", multi_line=True).collect()]
    assert got == [(1, 'Great, "really"\nwould return'), (2, None)]


def test_gzip_csv_is_dealt_out(spark, tmp_path):
    path = str(tmp_path / "gz")
    spark.range(100).coalesce(1).write.csv(path, header=True, compression="gzip")
    df = files.read_csv(spark, path, "id long", rebalance=True)
    assert df.count() == 100 and "Rebalance" in df._jdf.queryExecution().optimizedPlan().toString()


def test_optional_table_and_pruned_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    assert files.read_parquet_optional(spark, path) is None
    sinks.write_parquet(spark.range(3).selectExpr("id", "id * 2 AS twice", "'x' AS c"), path)
    df = files.read_parquet_optional(spark, path, ["twice"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert df.columns == ["twice"] and "ReadSchema: struct<twice:bigint>" in plan


def test_partition_pruning_after_partitioned_write(spark, tmp_path):
    path = str(tmp_path / "cal")
    sinks.write_partitioned(spark.range(90).selectExpr("id", "id % 3 AS month"), path, "month")
    df = spark.read.parquet(path).where("month = 1")
    assert df.count() == 30 and "PartitionFilters: [isnotnull(month" in df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frames = [
            sinks.write_bucketed(spark.range(200).selectExpr("id AS k", f"id * {i} AS v{i}"), f"bucketed_{i}", str(tmp_path / f"b{i}"), "k", 4)
            for i in (2, 3)
        ]
        joined = frames[0].join(frames[1], "k")
        assert joined.count() == 200
        assert "Exchange" not in joined._jdf.queryExecution().sparkPlan().toString()
        joined.collect()
        assert "Exchange hashpartitioning" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_overwriting_replaces_rows(spark, tmp_path):
    path = str(tmp_path / "o")
    sinks.write_parquet(spark.range(5), path)
    sinks.write_parquet(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2


def test_report_is_one_file_and_export_is_many(spark, tmp_path):
    df = spark.range(100).repartition(5)
    sinks.write_report(df, str(tmp_path / "r"))
    sinks.write_export(df, str(tmp_path / "e"))
    assert len(list((tmp_path / "r").glob("*.csv"))) == 1 and len(list((tmp_path / "e").glob("*.csv"))) == 5


def test_reports_are_empty_when_absent(spark, tmp_path):
    sinks.write_report(spark.createDataFrame([("a, b", 1)], "finding string, n int"), str(tmp_path / "one"))
    schema = "finding string, n int"
    got = files.read_reports(spark, str(tmp_path), ["one", "two"], {"one": schema, "two": schema})
    assert [tuple(r) for r in got["one"].collect()] == [("a, b", 1)] and got["two"].collect() == []


def test_fallback_order(spark, tmp_path):
    keyed = spark.createDataFrame([(20240105, 9.0)], "date_key int, price double")
    sinks.write_parquet(keyed, str(tmp_path / "fact"))
    sources = [str(tmp_path / "missing"), "missing_table", str(tmp_path / "fact")]
    row = files.scan_with_fallback(spark, sources, ["date", "available", "price"]).first()
    assert (str(row.date), row.available, row.price) == ("2024-01-05", None, 9.0)
    with pytest.raises(FileNotFoundError):
        files.scan_with_fallback(spark, sources[:2], ["date"])


def test_manifest(spark, tmp_path):
    (tmp_path / "listings.csv.gz").write_bytes(b"x" * 1_500_000)
    (tmp_path / "old").mkdir()
    (tmp_path / "old" / "listings.csv.gz").write_bytes(b"x")  # another file of that name
    registry = spark.createDataFrame(
        [("listings", "https://example.org/l", "listings.csv.gz"), ("calendar", "https://example.org/c", "calendar.csv.gz")],
        "file_key string, source_url string, local_name string",
    )
    manifest = files.ingest_manifest(spark, str(tmp_path), registry, "town")
    got = {r.file_key: (r.file_size_mb, r.status) for r in manifest.collect()}
    assert got == {"listings": (1.43, "skipped_existing"), "calendar": (0.0, "failed")}
    assert tuple(files.manifest_summary(manifest).first()) == (1, 2)
