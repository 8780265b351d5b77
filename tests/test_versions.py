"""Versioned folders and the star schema that is replaced as a whole."""

import os
import time

import pytest
from pyspark.sql import functions as F

from nestmetrics.plans import enrich, warehouse
from nestmetrics.sources import versions


def tables(spark, n):
    enriched = enrich.enrich_listings(spark.range(n).selectExpr("id", "id % 3 AS host_id", "'A' AS neighbourhood_cleansed"))
    calendar = spark.range(n).selectExpr("id AS listing_id", "DATE'2024-01-01' AS date", "true AS available", "1D AS price")
    reviews = spark.range(n).selectExpr("id", "id AS listing_id", "DATE'2024-01-02' AS date")
    areas = spark.createDataFrame([("A",)], "neighbourhood string")
    return enriched, calendar, reviews, areas


def counts(star):
    return {r.table_name: r.row_count for r in warehouse.row_counts(star).collect()}


def test_a_reload_that_fails_leaves_the_old_star_whole(spark, tmp_path):
    root = str(tmp_path / "star")
    warehouse.build_star(spark, root, *tables(spark, 5))
    before = counts(warehouse.open_star(spark, root))
    assert before["dim_listing"] == before["fact_reviews"] == 5
    enriched, calendar, reviews, areas = tables(spark, 9)
    broken = reviews.withColumn("date", F.raise_error(F.lit("source went away")).cast("date"))
    with pytest.raises(Exception, match="source went away"):
        warehouse.build_star(spark, root, enriched, calendar, broken, areas)
    # Six of the seven new tables lie there; none of them is seen.
    unfinished = [f for f in os.listdir(root) if f.startswith("load-") and not os.path.exists(f"{root}/{f}/fact_reviews/_SUCCESS")]
    assert len(unfinished) == 1 and os.path.exists(f"{root}/{unfinished[0]}/fact_calendar/_SUCCESS")
    assert counts(warehouse.open_star(spark, root)) == before
    assert [v.number for v in versions.published(spark, root)] == [1]


def test_readers_keep_the_version_they_resolved(spark, tmp_path):
    root = str(tmp_path / "star")
    warehouse.build_star(spark, root, *tables(spark, 4))
    early = warehouse.open_star(spark, root)
    written = warehouse.build_star(spark, root, *tables(spark, 6))
    assert counts(early)["dim_listing"] == 4
    assert counts(warehouse.open_star(spark, root)) == counts(written)
    assert counts(warehouse.open_star(spark, root, version=1))["dim_listing"] == 4
    with pytest.raises(FileNotFoundError):
        versions.resolve(spark, root, 3)


def test_old_versions_and_abandoned_loads_are_reclaimed(spark, tmp_path):
    root = str(tmp_path / "v")
    loads = []
    for i in range(4):
        loads.append(versions.begin(root))
        spark.range(i).write.parquet(f"{loads[-1]}/t")
        assert versions.publish(spark, root, loads[-1]) == versions.Version(i + 1, loads[-1])
    abandoned, running = versions.begin(root), versions.begin(root)
    for folder in (abandoned, running):
        spark.range(1).write.parquet(f"{folder}/t")
    long_ago = time.time() - 2 * 86400
    os.utime(abandoned, (long_ago, long_ago))
    assert versions.reclaim(spark, root, keep=2) == sorted([loads[0], loads[1], abandoned])
    assert [v.folder for v in versions.published(spark, root)] == loads[2:]
    assert os.path.exists(running) and spark.read.parquet(f"{versions.resolve(spark, root).folder}/t").count() == 3
    assert versions.reclaim(spark, root, keep=2) == []


def test_a_number_that_another_load_took_is_passed_over(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "v")
    first, second = versions.begin(root), versions.begin(root)
    versions.publish(spark, root, first)
    seen = iter([[]])
    listing = versions._numbers
    # The second load looks before the first one's record is there.
    monkeypatch.setattr(versions, "_numbers", lambda *a: next(seen, listing(*a)))
    assert versions.publish(spark, root, second) == versions.Version(2, second)
    assert not [f for f in os.listdir(f"{root}/published") if f.startswith("draft")]


def test_nothing_published_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        warehouse.open_star(spark, str(tmp_path / "none"))
    with pytest.raises(ValueError):
        versions.reclaim(spark, str(tmp_path / "none"), keep=0)
