"""A landing folder followed through several runs of its source."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from strata.operators.enrich import AmbiguousLookup
from strata.operators.manifest import content_hash
from strata.operators.quality import GateError
from strata.plans import mirror as plan
from strata.plans.mirror import EmptyListing, Mirror, changed_listing, compare_listing, read_manifest, record_run


def listing(files):
    rows = "".join(f' 1/{day}/2026  8:30 AM   {len(text)} <A HREF="/pub/{name}">{name}</A><br>'
                   for name, (day, text) in files.items())
    return f"<html><pre>{rows}</pre></html>"


@pytest.fixture
def mirror(spark, tmp_path):
    spark.sql("CREATE SCHEMA IF NOT EXISTS control")
    spark.sql("DROP VIEW IF EXISTS control.mirror_manifest")
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "unlisted").write_text("x")
    return Mirror("https://files.example.org/pub/", str(tmp_path / "landing"), str(tmp_path / "state"),
                  "control.mirror_manifest")


SINCE = datetime.now(timezone.utc) - timedelta(minutes=5)


def test_a_run_that_dies_before_the_manifest_keeps_its_events(spark, rows, mirror, monkeypatch):
    whole = plan.publish

    def dies(df, location, *rest):
        if location.endswith("/manifest"):
            raise OSError("gone")
        return whole(df, location, *rest)

    monkeypatch.setattr(plan, "publish", dies)
    with pytest.raises(OSError, match="gone"):
        run(spark, rows, mirror, 2, {"a": (1, "aaa")})
    monkeypatch.setattr(plan, "publish", whole)
    assert read_manifest(spark, mirror).isEmpty()
    run(spark, rows, mirror, 2, {"a": (1, "aaa")})
    events = spark.read.parquet(f"{mirror.log}/*").collect()
    assert [(e.file_name, e.event_type) for e in events] == [("a", "new")]
    assert [r.file_name for r in read_manifest(spark, mirror).collect()] == ["a"]


def run(spark, rows, mirror, day, files, fetch=True):
    """One run of the caller: compare, fetch, drop, record; the actions by file."""
    at = F.lit(datetime(2026, 1, day))
    compared = compare_listing(spark, mirror, rows([(1, listing(files))], "page_id int, html string"), at)
    actions = {r.file_name: r.action for r in compared.collect()}
    for name, action in actions.items():
        path = f"{mirror.folder}/{name}"
        if action in ("new", "changed") and fetch:
            with open(path, "w") as file:
                file.write(files[name][1])
    record_run(spark, mirror, compared, at, f"run-{day}", SINCE)
    return actions


def test_runs(spark, rows, mirror):
    one = {"a": (1, "aaa"), "b": (1, "bb")}
    assert run(spark, rows, mirror, 2, one) == {"a": "new", "b": "new"}
    assert run(spark, rows, mirror, 3, one) == {"a": "unchanged", "b": "unchanged"}
    assert run(spark, rows, mirror, 4, {"a": (4, "aaaa"), "c": (4, "c")}) == {"a": "changed", "b": "removed", "c": "new"}
    assert run(spark, rows, mirror, 5, {"a": (4, "aaaa"), "b": (1, "bb")}) == {
        "a": "unchanged", "b": "changed", "c": "removed"}
    state = {r.file_name: r for r in read_manifest(spark, mirror).collect()}
    assert {n: r.status for n, r in state.items()} == {"a": "active", "b": "active", "c": "removed"}
    assert (state["b"].first_seen_at.day, state["b"].last_downloaded_at.day) == (2, 5)
    assert state["a"].source_url == "https://files.example.org/pub/a"
    assert state["a"].content_sha256 == spark.range(1).select(content_hash(F.lit("aaaa"))).first()[0]
    events = spark.read.parquet(f"{mirror.log}/*").groupBy("event_type").count().collect()
    assert {r.event_type: r["count"] for r in events} == {"new": 3, "changed": 2, "removed": 2}


def test_a_file_that_did_not_arrive_stops_the_run(spark, rows, mirror):
    with pytest.raises(GateError, match="fetched_size_matches_listing=1"):
        run(spark, rows, mirror, 2, {"a": (1, "aaa")}, fetch=False)
    assert read_manifest(spark, mirror).isEmpty()


def test_a_file_listed_twice_is_an_error(spark, rows, mirror):
    pages = [(1, listing({"a": (1, "x")})), (2, listing({"a": (2, "y"), "b": (1, "z")}))]
    with pytest.raises(AmbiguousLookup):
        compare_listing(spark, mirror, rows(pages, "page_id int, html string"), F.current_timestamp())


def test_empty_listing(spark, rows, mirror):
    with pytest.raises(EmptyListing):
        compare_listing(spark, mirror, rows([(1, "<html></html>")], "page_id int, html string"), F.current_timestamp())


def test_changed_listing(rows):
    page = rows([(1, "x"), (2, "y")], "page_id int, html string")
    stored = page.where("page_id = 1").select("page_id", content_hash(F.col("html")).alias("content_sha256"))
    assert [r.page_id for r in changed_listing(page, stored).collect()] == [2]
