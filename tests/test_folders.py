"""Many delimited files in one job: headers found by place, values by their own header."""

import pytest
from pyspark.sql import functions as F

from strata.functions.naming import folder_name
from strata.operators.contracts import Contract
from strata.sources.folders import Landed, by_header, check_headers, dataset_columns, land_lines


def named(name, path):
    return F.regexp_replace(name, r"[0-9]*\.txt$", "")


def land(folder, **files):
    folder.mkdir(exist_ok=True)
    for name, text in files.items():
        (folder / f"{name}.txt").write_text(text)
    return str(folder)


def rows_of(frame, *columns):
    return sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=str)


def test_every_file_has_its_own_header(spark, tmp_path):
    folder = land(
        tmp_path / "in", a1="K\t V \n1\t x \n2\t\n", a2="v\tk\nY\t3\n", b="only\n", c='\n \nk\tk\n"q\tr"\tsecond\n',
        d="k\tv\tw\n5\n6\ta\tb\tc\n", skipped="k\n9\n", empty="")
    landed = land_lines(spark, folder, named, ignored=["skipped.txt"])
    found = by_header(landed, {"a1.txt": Contract.of("k v", "k v"), "a2.txt": Contract.of("k v", "k"), "d.txt": Contract.of("k v w", "z")})
    assert rows_of(found, "dataset", "k", "v", "w", "only", "_expected_schema_valid", "_non_null_key_valid") == [
        ("a", "1", "x", None, None, True, True), ("a", "2", None, None, None, True, False), ("a", "3", "Y", None, None, False, True),
        ("c", "q\tr", None, None, None, False, False), ("d", "5", None, None, None, True, False), ("d", "6", "a", "b", None, True, False)]
    assert rows_of(dataset_columns(landed.headers), "dataset", "names") == [
        ("a", ["k", "v"]), ("b", ["only"]), ("c", ["k"]), ("d", ["k", "v", "w"])]
    assert found.where("dataset = 'a' AND v = 'Y'").first()._source_file == "a2.txt"


def test_a_file_of_many_blocks_has_one_header(spark, tmp_path):
    folder = land(tmp_path / "in", big="k\tv\n" + "".join(f"{i}\tvalue {i}\n" for i in range(20_000)), small="v\tk\nx\t-1\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    reader = spark.newSession()
    assert reader.conf.get("spark.sql.files.maxPartitionBytes") == before
    split = spark.newSession()
    split.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    original = spark.__class__.newSession
    try:
        spark.__class__.newSession = lambda self: with_small_splits(original(self))
        landed = land_lines(spark, folder, named)
    finally:
        spark.__class__.newSession = original
    assert landed.headers.count() == 2
    assert by_header(landed).agg(F.count("*"), F.sum(F.col("k").cast("long"))).first()[:] == (20_001, sum(range(20_000)) - 1)


def with_small_splits(session):
    session.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    return session


def jobs_of(spark, group, work):
    spark.sparkContext.setJobGroup(group, group)
    try:
        work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_jobs_do_not_grow_with_files(spark, tmp_path):
    few = land(tmp_path / "few", **{f"t{i}": f"k\tv\n{i}\tx\n" for i in range(3)})
    many = land(tmp_path / "many", **{f"t{i}": f"{'k' if i % 2 else 'v'}\t{'v' if i % 2 else 'k'}\n{i}\t{i}\n" for i in range(1500)})
    counts = []
    for folder, n in ((few, 3), (many, 1500)):
        def work(folder=folder, n=n):
            landed = land_lines(spark, folder, named)
            rows = by_header(landed)
            assert rows.count() == n and rows.where("k = v").count() == (n if n > 3 else 0)
        counts.append(jobs_of(spark, f"files-{n}", work))
    # A listing of more than 32 folders may itself be a job; a file must not be.
    assert counts[1] <= counts[0] + 2


def test_small_header_tables_are_broadcast_and_rows_not_shuffled(spark, tmp_path):
    folder = land(tmp_path / "in", a="k\n1\n", b="k\n2\n")
    plan = by_header(land_lines(spark, folder, named))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_no_files_and_missing_headers(spark, tmp_path):
    landed = land_lines(spark, land(tmp_path / "none"), lambda name, path: folder_name(path))
    assert by_header(landed).isEmpty() and dataset_columns(landed.headers).isEmpty()
    two = land_lines(spark, land(tmp_path / "in", a="k\n1\n"), named)
    with pytest.raises(ValueError, match="no single header in .*a.txt"):
        check_headers(Landed(two.lines, two.headers.union(two.headers), "\t"))
    with pytest.raises(ValueError, match="no single header in .*a.txt"):
        check_headers(Landed(two.lines, two.headers.limit(0), "\t"))
