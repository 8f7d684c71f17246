"""Reading landed text, finding files, parsing listings, ingesting snapshots."""

import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from strata.functions.naming import SnapshotName
from strata.operators.quality import Expectation
from strata.operators.snapshots import explode_list, explode_records, flag_payload, is_json, latest_snapshot, record_fields
from strata.session import scratch_path, scratch_root, written
from strata.sources.delimited import add_lineage, scan_delimited
from strata.sources.listing import discover_files, empty_listings, listing_rows, page_links, listing_rows_of_files
from strata.streaming.snapshots import identify, ingest_available, snapshot_stream


def test_scan_delimited(spark, tmp_path):
    path = tmp_path / "t.txt"
    path.write_text(" Code \tTEXT  \tN\n 01 \t a b \t 7\n02\t\t\n")
    frame = scan_delimited(spark, str(path))
    assert frame.columns == ["code", "text", "n"]
    assert [tuple(r) for r in frame.collect()] == [("01", "a b", "7"), ("02", None, None)]
    row = add_lineage(frame).first()
    assert row._source_file == "t.txt" and row._source_path.endswith(str(path)) and row._bronze_refreshed_at_utc


def test_discover_files(spark, tmp_path):
    for name, text in {"pr.b": "22", "pr.a": "1", "pr.txt": "x"}.items():
        (tmp_path / name).write_text(text)
    (tmp_path / "folder").mkdir()
    (tmp_path / "folder" / "inner").write_text("333")
    found = discover_files(spark, str(tmp_path), ["pr.txt"]).orderBy("file_name").collect()
    assert [(r.file_name, r.size_bytes) for r in found] == [("pr.a", 1), ("pr.b", 2)]
    deep = discover_files(spark, str(tmp_path), recursive=True)
    assert {r.file_name for r in deep.collect()} == {"pr.a", "pr.b", "pr.txt", "inner"}


LISTING = """
<html><pre><A HREF="/pub/">[To Parent Directory]</A><br>
 9/3/2025  8:30 AM        12345 <A HREF="/pub/pr/pr.class">pr.class</A><br>
10/12/2025 11:05 PM          7 <a href="pr.new"> pr.new </a><br>
 9/4/2025  8:30 am        99 <A HREF="/pub/pr/pr.class2">pr.class</A><br>
 9/4/2025  8:30 AM        &lt;dir&gt; <A HREF="/pub/pr/sub/">sub</A><br></pre></html>
"""


def test_listing_rows(rows):
    pages = rows([(1, LISTING), (2, "nothing"), (3, None)], "page_id int, html string")
    found = listing_rows(pages, "https://files.example.org/pub/pr/").orderBy("file_name").collect()
    assert [tuple(r) for r in found] == [
        (1, "pr.class", "https://files.example.org/pub/pr/pr.class2", "9/4/2025  8:30 am", 99),
        (1, "pr.new", "https://files.example.org/pub/pr/pr.new", "10/12/2025 11:05 PM", 7),
    ]
    assert sorted(r.page_id for r in empty_listings(pages).collect()) == [2, 3]


def test_page_links(rows):
    pages = rows([(1, "http://e.org/d/p?x", '<a href="q">Q</a> <A href="/r">R</A> <a href="s">Q</a>')],
                 "page_id int, url string, html string")
    found = page_links(pages).orderBy("file_name").collect()
    assert [tuple(r) for r in found] == [(1, "Q", "http://e.org/d/s"), (1, "R", "http://e.org/r")]


BODY = "data array<struct<`Nation ID`: string, Year: bigint>>"
GOOD = '{"data": [{"Nation ID": "n", "Year": 1, "more": 2}, {"Year": 2}], "page": {}}'
BODIES = [("good", GOOD), ("cut", '{"data": [{"Year": 1}, {"Ye'), ("empty", '{"data": []}'), ("none", '{"page": 1}'),
          ("null", '{"data": null}'), ("text", "not json"), ("missing", None)]


def test_payload_flags(rows):
    frame = rows(BODIES, "name string, raw_json string")
    flagged = flag_payload(frame, BODY).withColumn("json", is_json(F.col("raw_json")))
    got = {r.name: (r.payload_schema_valid, r.population_data_not_empty, r.json) for r in flagged.collect()}
    assert got == {
        "good": (True, True, True), "cut": (False, None, False), "empty": (True, False, True),
        "none": (False, None, True), "null": (False, None, True), "text": (False, None, False),
        "missing": (False, None, False),
    }


def test_explode_keeps_or_drops_snapshots_without_records(rows):
    frame = rows(BODIES, "name string, raw_json string")
    columns = record_fields({"Nation ID": "nation_id", "Year": "year"})
    outer = explode_records(frame, BODY).select("name", *columns).collect()
    assert {(r.name, r.nation_id, r.year) for r in outer if r.year} == {("good", "n", 1), ("good", None, 2)}
    assert sorted(r.name for r in outer if not r.year) == ["cut", "empty", "missing", "none", "null", "text"]
    inner = explode_records(frame, BODY, keep_empty=False).select("name", *columns)
    listed = explode_list(frame, "struct<`Nation ID`: string, Year: bigint>").select("name", *columns)
    for kept in (inner, listed):
        assert sorted((r.name, r.year) for r in kept.collect()) == [("good", 1), ("good", 2)]


def test_latest_snapshot_keeps_ties_and_drops_unknown_times(rows, spark):
    frame = rows([("a", 1, "d1"), ("b", 3, "d2"), ("c", 3, "d2"), ("d", None, None)], "n string, at int, day string")
    assert sorted(r.n for r in latest_snapshot(frame, "at").collect()) == ["b", "c"]
    assert sorted(r.n for r in latest_snapshot(frame, "at", partition="day").collect()) == ["b", "c"]
    assert latest_snapshot(frame.where("at > 9"), "at").isEmpty()


NAMING = SnapshotName("s__fetched_", "_UTC.json")
RULES = [Expectation("timed", "fetched_at_utc IS NOT NULL", "fail"), Expectation("long", "length(raw_json) > 2")]


def ingest(spark, root, max_files=1000):
    files = identify(snapshot_stream(spark, f"{root}/landing", "s__*.json", max_files=max_files), NAMING)
    kept = files.select("source_file", "fetched_at_utc", "fetched_on", "raw_json")
    return {o.name: (o.checked, o.violations)
            for o in ingest_available(kept, f"{root}/raw", f"{root}/checkpoint", RULES, partition_by=["fetched_on"])}


def land(root, name, text):
    os.makedirs(f"{root}/landing", exist_ok=True)
    with open(f"{root}/landing/{name}", "x") as file:
        file.write(text)


def test_each_file_is_ingested_once(spark, tmp_path):
    for day in (1, 2, 3):
        land(tmp_path, f"s__fetched_2025-01-0{day}__00_00_00_UTC.json", "{}" if day == 1 else '{"a": 1}')
    land(tmp_path, "unrelated.json", "x")
    assert ingest(spark, tmp_path, max_files=1) == {"timed": (3, 0), "long": (3, 1)}
    assert ingest(spark, tmp_path) == {"timed": (0, 0), "long": (0, 0)}
    land(tmp_path, "s__fetched_2025-01-04__00_00_00_UTC.json", '{"b": 2}')
    assert ingest(spark, tmp_path) == {"timed": (1, 0), "long": (1, 0)}
    raw = spark.read.parquet(f"{tmp_path}/raw")
    assert raw.count() == 4 and raw.select("source_file").distinct().count() == 4
    newest = latest_snapshot(raw, partition="fetched_on").collect()
    assert [r.raw_json for r in newest] == ['{"b": 2}']


def test_rule_counts_cover_more_batches_than_spark_reports(spark, tmp_path):
    for day in range(1, 6):
        land(tmp_path, f"s__fetched_2025-02-0{day}__00_00_00_UTC.json", "{}")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        assert ingest(spark, tmp_path, max_files=1) == {"timed": (5, 0), "long": (5, 5)}
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def test_a_failing_rule_stops_the_stream_and_commits_nothing(spark, tmp_path):
    land(tmp_path, "s__fetched_2025-01-01__00_00_00_UTC.json", '{"a": 1}')
    ingest(spark, tmp_path)
    land(tmp_path, "s__fetched_whenever_UTC.json", '{"a": 1}')
    for _ in range(2):
        with pytest.raises(StreamingQueryException, match="expectation violated: timed"):
            ingest(spark, tmp_path)
    assert spark.read.parquet(f"{tmp_path}/raw").count() == 1


def test_scratch_folder_follows_the_session(spark, tmp_path):
    named = spark.conf.get("spark.checkpoint.dir", "")
    root = scratch_root(spark)
    assert root == named.rstrip("/") if named else os.path.isdir(root)
    assert scratch_path(spark, "x").startswith(root) and scratch_path(spark, "x") != scratch_path(spark, "x")
    assert written(spark.range(3), "three").count() == 3


def test_a_listing_in_pieces_uses_many_tasks_and_the_last_name_wins(spark, tmp_path):
    row = '1/{day}/2024  9:05 AM       {size} <A HREF="/d/f{n}.txt">f{n}.txt</A><br>'
    page = "<html><pre>" + "".join(row.format(day=1, size=n, n=n) for n in range(3000)) + "no row here<br>"
    page += "".join(row.format(day=2, size=10 * n, n=n) for n in range(0, 3000, 7)) + row.format(day=3, size=1, n=3).replace("<br>", "</pre>")
    (tmp_path / "page.html").write_text(page)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        found = listing_rows_of_files(spark, str(tmp_path), "http://e.org/")
        assert spark.read.option("lineSep", "<br>").text(str(tmp_path)).rdd.getNumPartitions() > 4
        rows = {r.file_name: (r.source_last_modified[:4], r.source_size_bytes) for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    wanted = {f"f{n}.txt": ("1/2/", 10 * n) if n % 7 == 0 else ("1/1/", n) for n in range(3000)} | {"f3.txt": ("1/3/", 1)}
    assert rows == wanted and found.first().source_url.startswith("http://e.org/d/f")
