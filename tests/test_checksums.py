"""Checksum-tree and multiset differences against collections of rows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from strata.operators import checksums

SCHEMA = "k int, `odd name` string, d double"


def counted(frame, names):
    return {tuple(row[n] for n in names): row.surplus for row in frame.collect()}


def brute(left, right):
    found = Counter(left)
    found.subtract(right)
    return {row: n for row, n in found.items() if n}


@pytest.mark.parametrize("keys", [None, ["k"]])
@pytest.mark.parametrize("leaves", [1, 16, 100, 4096])
def test_repeated_changed_missing_and_null_rows(rows, keys, leaves):
    left = [(i, f"t{i % 7}", i / 2) for i in range(400)] + [(1, "t1", 0.5)] * 3 + [(None, None, None)] * 2 + [(None, "x", 0.0)]
    right = [(i, f"t{i % 7}" if i % 90 else "new", i / 2) for i in range(5, 410)] + [(1, "t1", 0.5)] * 5 + [(None, None, None)]
    frames = rows(left, SCHEMA), rows(right, SCHEMA).select("d", "odd name", "k")
    for made in (checksums.tree_diff(*frames, keys, leaves), checksums.signed_diff(*frames)):
        assert counted(made, ["k", "odd name", "d"]) == brute(left, right)


def test_order_and_partitions_do_not_matter(spark, rows):
    frame = spark.range(10_000).selectExpr("CAST(id % 500 AS INT) AS k", "CAST(id AS STRING) AS t")
    moved = frame.repartition(7, "t").sort("t")
    sums = [sorted(map(tuple, checksums.leaf_sums(f).collect())) for f in (frame, moved)]
    assert sums[0] == sums[1] and sum(row[1] for row in sums[0]) == 10_000
    assert checksums.tree_diff(frame, moved).isEmpty()
    less = frame.where("id <> 77" if "id" in frame.columns else "t <> '77'")
    levels = checksums.differing_nodes(*(checksums.leaf_sums(f, ["k"]) for f in (frame, less)))
    assert [level.width for level in levels] == [1, 16, 256, 4096] and all(len(level.differing) == 1 for level in levels)


def exchanged_rows(spark, work):
    """Rows written to exchanges by the jobs of ``work``."""
    store = spark.sparkContext._jsc.sc().statusStore()
    before = {s.stageId() for s in stages(store)}
    work()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    return sum(s.shuffleWriteRecords() for s in stages(store) if s.stageId() not in before)


def stages(store):
    listed = store.stageList(None, False, False, getattr(store, "stageList$default$4")(), getattr(store, "stageList$default$5")())
    return [listed.apply(i) for i in range(listed.size())]


def test_equal_tables_move_no_rows_and_differing_ones_few(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 200_000, 1, 4).selectExpr("id AS k", "CAST(id * 3 AS STRING) AS t").write.parquet(path)
    left = spark.read.parquet(path)
    equal = exchanged_rows(spark, lambda: checksums.tree_diff(left, left.select("t", "k"), leaves=256).collect())
    changed = left.withColumn("t", F.when(F.col("k") == 5, "other").otherwise(F.col("t")))
    found = []
    few = exchanged_rows(spark, lambda: found.extend(checksums.tree_diff(left, changed, ["k"], leaves=256).collect()))
    assert sorted((r.k, r.t, r.surplus) for r in found) == [(5, "15", 1), (5, "other", -1)]
    assert equal <= 2 * 4 * 256 * 8 and few < 10 * 200_000 / 256 + 2 * 4 * 256 * 8


def test_plan_of_the_sums_is_one_pass_with_partial_sums(spark):
    plan = checksums.leaf_sums(spark.range(10))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_sum" in plan and "hashpartitioning(leaf" in plan
