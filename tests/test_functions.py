"""Column functions against their plain Python counterparts."""

from datetime import datetime, timezone
from urllib.parse import urljoin

from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.measures import gap, gap_or_zero
from strata.functions.naming import SnapshotName, base_name, folder_name
from strata.functions.text import is_present, normalize_name, table_cell, table_row
from strata.functions.urls import absolute_url

HREFS = [
    "a.txt", "/a/b.txt", "../up.txt", "../../../far.txt", "./here", "x/./y/../z", "https://other.org/p?q=1",
    "//cdn.org/lib.js", "?page=2", "#top", "", "mailto:me@example.org", "sub/", "a//b", "..", ".", "file?x=../y",
]
BASES = [
    "https://files.example.org/pub/time/", "https://files.example.org/pub/time/index.html?x=1#f",
    "http://example.org", "http://example.org:8080/one",
]


def test_absolute_url_agrees_with_the_standard_library(rows):
    pairs = [(href, base) for href in HREFS for base in BASES]
    found = rows(pairs, "href string, base string").select("href", "base", absolute_url(F.col("href"), F.col("base")).alias("u"))
    got = {(r.href, r.base): r.u for r in found.collect()}
    assert got == {(href, base): urljoin(base, href) for href, base in pairs}


def test_normalize_name(rows):
    names = {"pr.data.0.Current": "bls_pr_data_0_current", "__A  b--C!": "bls_a_b_c", "é": "bls_", "9": "bls_9"}
    found = rows([(n,) for n in names], "n string").select("n", normalize_name(F.col("n"), "bls_").alias("t"))
    assert {r.n: r.t for r in found.collect()} == names


def test_is_present(rows):
    found = rows([("x",), (" ",), ("",), (None,), ("\t",)], "v string").select(is_present(F.col("v")).alias("p"))
    assert [r.p for r in found.collect()] == [True, False, False, False, True]


def test_snapshot_name(rows):
    naming = SnapshotName("population__fetched_", "_UTC.json")
    paths = ["file:/x/population__fetched_2025-01-15__14_30_00_UTC.json", "file:/x/other.json"]
    name = base_name(F.col("path"))
    first, second = (
        rows([(p,) for p in paths], "path string")
        .select(name.alias("name"), naming.fetched_text(name).alias("text"),
                F.unix_seconds(naming.fetched_at(name)).alias("at"))
        .collect()
    )
    assert first.name == "population__fetched_2025-01-15__14_30_00_UTC.json"
    assert first.text == "2025-01-15__14_30_00"
    assert first.at == int(datetime(2025, 1, 15, 14, 30, tzinfo=timezone.utc).timestamp())
    assert second.at is None
    folder = rows([("file:/x/day=2025-01-15/part-0",)], "path string").select(folder_name(F.col("path"))).first()[0]
    assert folder == "2025-01-15"


def cell(value):
    if value is None:
        return ""
    text = str(value).replace("\\", "\\\\").replace("|", "\\|")
    return text.replace("\r\n", "<br>").replace("\n", "<br>").replace("\r", "<br>")


def test_text_cells(rows):
    texts = ["plain", None, "a|b", "back\\slash\\|", "one\r\ntwo\nthree\rfour\r\n\n", ""]
    found = rows([(t,) for t in texts], "t string").select(table_cell(F.col("t")).alias("c")).collect()
    assert [r.c for r in found] == [cell(t) for t in texts]


def test_number_cells(rows):
    numbers = [0.0, 1.5, 322069808.0, 4158441.040908095, -123456789.125, 0.00012345, 0.001, 1e15, 12345678.9, None]
    found = rows([(n,) for n in numbers], "n double").select(table_cell(F.col("n"), T.DoubleType()).alias("c")).collect()
    assert [r.c for r in found] == [cell(n) for n in numbers]


def test_table_row(rows):
    frame = rows([(1, None, True, "a|b")], "n int, gap string, flag boolean, `odd.name` string")
    assert frame.select(table_row(frame.schema)).first()[0] == "| 1 |  | True | a\\|b |"


def test_gaps(rows):
    frame = rows([(1.0, 3.0), (None, None), (1.0, None)], "a double, b double")
    found = frame.select(gap(F.col("a"), F.col("b"), 3).alias("g"), gap_or_zero(F.col("a"), F.col("b")).alias("z"))
    assert [tuple(r) for r in found.collect()] == [(2.0, 2.0), (None, 0.0), (None, None)]
