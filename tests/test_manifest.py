"""Reconciling a manifest with a listing, transition by transition."""

import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from strata.operators import manifest

RUN = datetime(2026, 1, 2)
OLD, OLDER = datetime(2026, 1, 1), datetime(2025, 1, 1)
STATE = ("file_name string, source_last_modified string, source_size_bytes bigint, status string, "
         "first_seen_at timestamp_ntz, last_seen_at timestamp_ntz, last_downloaded_at timestamp_ntz, "
         "removed_at timestamp_ntz, content_sha256 string")


def known(name, modified="m", size=5, status="active"):
    return (name, modified, size, status, OLDER, OLD, OLDER, OLD if status == "removed" else None, f"hash of {name}")


@pytest.fixture
def reconciled(rows):
    before = rows([
        known("same"), known("time"), known("size"), known("no copy"), known("short copy"), known("gone"),
        known("returned", status="removed"), known("still gone", status="removed"),
    ], STATE)
    listed = [(n, "m", 5, f"u/{n}") for n in ("same", "no copy", "short copy", "returned", "brand new")]
    listed += [("time", "m2", 5, "u/time"), ("size", "m", 6, "u/size")]
    listing = rows(listed, "file_name string, source_last_modified string, source_size_bytes bigint, source_url string")
    local = rows([(n, 5) for n in ("same", "time", "size", "returned")] + [("short copy", 4)],
                 "file_name string, local_size_bytes bigint")
    return manifest.reconcile(before, listing, local, F.lit(RUN).cast("timestamp_ntz"))


def test_actions_and_next_state(reconciled):
    got = {r.file_name: r for r in reconciled.collect()}
    assert {n: r.action for n, r in got.items()} == {
        "same": "unchanged", "time": "changed", "size": "changed", "no copy": "changed", "short copy": "changed",
        "gone": "removed", "returned": "changed", "still gone": "absent", "brand new": "new",
    }
    assert (got["same"].first_seen_at, got["same"].last_seen_at, got["same"].last_downloaded_at) == (OLDER, RUN, OLDER)
    assert (got["returned"].first_seen_at, got["returned"].status, got["returned"].removed_at) == (OLDER, "active", None)
    assert (got["gone"].status, got["gone"].removed_at, got["gone"].last_seen_at) == ("removed", RUN, OLD)
    assert (got["still gone"].status, got["still gone"].removed_at) == ("removed", OLD)
    assert (got["brand new"].first_seen_at, got["brand new"].last_downloaded_at) == (RUN, RUN)
    assert (got["size"].source_size_bytes, got["size"].source_url) == (6, "u/size")
    assert (got["gone"].source_url, got["gone"].content_sha256) == (None, "hash of gone")


def test_events_and_summary(reconciled):
    events = manifest.change_events(reconciled, F.lit(RUN).cast("timestamp_ntz")).collect()
    assert {(r.event_type, r.file_name) for r in events} == {
        ("changed", "time"), ("changed", "size"), ("changed", "no copy"), ("changed", "short copy"),
        ("changed", "returned"), ("removed", "gone"), ("new", "brand new"),
    }
    assert {r.observed_at for r in events} == {RUN}
    assert manifest.change_summary(reconciled).first().asDict() == {
        "new": 1, "changed": 5, "unchanged": 1, "removed": 1, "downloads": 6}


def test_a_second_run_on_the_next_state_changes_nothing(rows, reconciled):
    again = reconciled.drop("action")
    active = again.where("status = 'active'")
    listing = active.select("file_name", "source_last_modified", "source_size_bytes")
    local = active.select("file_name", F.col("source_size_bytes").alias("local_size_bytes"))
    summary = manifest.change_summary(manifest.reconcile(again, listing, local, F.lit(RUN).cast("timestamp_ntz")))
    assert summary.first().asDict() == {"new": 0, "changed": 0, "unchanged": 7, "removed": 0, "downloads": 0}


def test_fetched_files_are_measured_and_hashed(rows, reconciled):
    contents = rows([("time", b"12345"), ("size", b"12345"), ("same", b"12345")], "file_name string, content binary")
    checked = {r.file_name: r for r in manifest.check_fetched(reconciled, contents).collect()}
    assert "same" not in checked
    assert {n: r.size_matches for n, r in checked.items()} == {
        "time": True, "size": False, "no copy": False, "short copy": False, "returned": False, "brand new": False}
    assert checked["time"].content_sha256 == hashlib.sha256(b"12345").hexdigest()


def test_content_changes(rows):
    stored = rows([("a", hashlib.sha256(b"x").hexdigest()), ("b", "other"), ("d", None)],
                  "file_name string, content_sha256 string")
    incoming = rows([("a", "x"), ("b", "x"), ("c", "x"), ("d", "x")], "file_name string, content string")
    found = manifest.content_changes(incoming, stored).collect()
    assert {(r.file_name, r.content_sha256) for r in found} == {(n, hashlib.sha256(b"x").hexdigest()) for n in "bcd"}
