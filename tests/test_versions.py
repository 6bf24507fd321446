"""Readers and writers of a published table."""

import os

import pytest
from pyspark.sql import functions as F

from gaugeline.sources import versions


def numbers(df):
    return sorted(r[0] for r in df.select("a").collect())


def test_versions_replace_each_other_and_old_ones_go(spark, tmp_path):
    root = str(tmp_path / "t")
    with pytest.raises(ValueError):
        versions.read_version(spark, root)
    for n in range(1, 6):
        assert versions.publish(spark.range(n).select(F.col("id").alias("a")), root, keep=2) == n
    assert versions.versions(spark, root) == [4, 5] and len([f for f in os.listdir(root) if f.startswith("data-")]) == 2
    assert numbers(versions.read_version(spark, root)) == [0, 1, 2, 3, 4] and numbers(versions.read_version(spark, root, 4)) == [0, 1, 2, 3]
    with pytest.raises(ValueError):
        versions.read_version(spark, root, 1)


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    root = str(tmp_path / "t")
    versions.publish(spark.range(3).select(F.col("id").alias("a")), root)
    with pytest.raises(Exception, match="no more"):
        versions.publish(spark.range(3).select(F.raise_error(F.lit("no more")).alias("a")), root)
    assert numbers(versions.read_version(spark, root)) == [0, 1, 2] and len([f for f in os.listdir(root) if f.startswith("data-")]) == 1


def test_a_table_is_computed_from_itself_while_it_is_read(spark, tmp_path):
    root = str(tmp_path / "t")
    versions.publish(spark.range(3).select(F.col("id").alias("a")), root)
    begun = versions.read_version(spark, root)
    versions.publish(begun.select((F.col("a") * 10).alias("a")), root)
    assert numbers(begun) == [0, 1, 2] and numbers(versions.read_version(spark, root)) == [0, 10, 20]


def test_the_slower_writer_is_refused_or_tries_again(spark, tmp_path):
    root = str(tmp_path / "t")
    versions.publish(spark.range(2).select(F.col("id").alias("a")), root)
    versions.publish(spark.range(3).select(F.col("id").alias("a")), root)
    with pytest.raises(versions.WriteConflict):
        versions.publish(spark.range(9).select(F.col("id").alias("a")), root, after=1)
    tried = []

    def change(df):
        if not tried:  # another writer comes first
            versions.publish(spark.range(5).select(F.col("id").alias("a")), root)
        tried.append(df)
        return df.select((F.col("a") + 100).alias("a"))

    assert versions.update(spark, root, change) == 4 and len(tried) == 2
    assert numbers(versions.read_version(spark, root)) == [100, 101, 102, 103, 104]


def test_partitions_schema_and_upsert(spark, rows, tmp_path):
    root = str(tmp_path / "t")
    versions.publish(spark.createDataFrame([(1, "x", 5), (2, "y", 6)], "a int, p string, n int"), root, partition_by=["p"])
    source = spark.createDataFrame([(2, 60), (3, 70)], "a int, n int")
    versions.upsert_into(spark, root, source, ["a"], ["n"], insert_defaults={"p": "new"}, partition_by=["p"])
    assert rows(versions.read_version(spark, root), "a", "p", "n") == [(1, "x", 5), (2, "y", 60), (3, "new", 70)]
    empty = versions.read_version(spark, root).limit(0)
    versions.publish(empty, root)
    assert versions.read_version(spark, root).count() == 0 and versions.read_version(spark, root).columns == empty.columns
