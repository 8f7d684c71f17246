"""Outcomes that outlive the driver: the quality log and the counts of micro-batches."""

import os
import subprocess
import sys
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from strata.functions.naming import SnapshotName
from strata.operators import publish, quality, quality_log
from strata.operators.quality import Expectation, RuleOutcome
from strata.operators.snapshots import latest_snapshot
from strata.streaming import snapshots as streams

NAMING = SnapshotName("s__fetched_", "_UTC.json")
RULES = [Expectation("timed", "fetched_at_utc IS NOT NULL", "fail"), Expectation("long", "length(raw_json) > 2")]


def test_open_and_closed_gates_are_logged_before_readers_see_a_version(spark, rows, tmp_path):
    spark.sql("CREATE SCHEMA IF NOT EXISTS logged")
    log, place = str(tmp_path / "log"), str(tmp_path / "t")
    rules = [Expectation("filled", "n IS NOT NULL", "fail"), Expectation("large", "n > 1")]
    first = publish.publish(rows([(1,), (2,)], "n int"), place, rules, "logged.t", log=log)
    with pytest.raises(quality.GateError):
        publish.publish(rows([(3,), (None,)], "n int"), place, rules, "logged.t", log=log)
    publish.publish(rows([], "n int"), place, rules, "logged.t", log=log)
    found = quality_log.trend(quality_log.entries(spark, log)).orderBy("rule", "run")
    assert [tuple(r) for r in found.select("rule", "run", "checked", "violations", "gate_open", "share", "change").collect()] == [
        ("filled", 1, 2, 0, True, 0.0, None), ("filled", 2, 2, 1, False, 0.5, 0.5), ("filled", 3, 0, 0, True, None, None),
        ("large", 1, 2, 1, True, 0.5, None), ("large", 2, 2, 1, False, 0.5, 0.0), ("large", 3, 0, 0, True, None, None)]
    assert found.first().version == first.path.rsplit("/", 1)[-1] and found.first().dataset == "logged.t"
    last = {r.rule: r for r in quality_log.last_failure(quality_log.entries(spark, log)).collect()}
    assert [(last[n].runs, last[n].failed_runs, last[n].last_run, last[n].last_gate_open, last[n].runs_since) for n in ("filled", "large")] == [
        (3, 1, 2, False, 1), (3, 2, 2, False, 1)]


def test_a_log_that_cannot_be_written_keeps_the_view_where_it_was(spark, rows, tmp_path):
    spark.sql("CREATE SCHEMA IF NOT EXISTS logged")
    rules = [Expectation("filled", "n IS NOT NULL", "fail")]
    publish.publish(rows([(1,)], "n int"), str(tmp_path / "t"), rules, "logged.kept")
    (tmp_path / "file").write_text("in the way")
    with pytest.raises(Exception):
        publish.publish(rows([(2,)], "n int"), str(tmp_path / "t"), rules, "logged.kept", log=str(tmp_path / "file"))
    assert [r.n for r in spark.table("logged.kept").collect()] == [1]


def test_publishers_record_side_by_side(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor
    log = str(tmp_path / "log")
    with ThreadPoolExecutor(max_workers=8) as pool:
        done = [pool.submit(quality_log.record, spark, log, f"d{i}", "v", [RuleOutcome("r", "warn", i, 0)]) for i in range(24)]
        for one in done:
            one.result()
    assert sorted((r.dataset, r.checked) for r in quality_log.entries(spark, log).collect()) == sorted((f"d{i}", i) for i in range(24))


def test_recording_again_changes_nothing_and_rules_never_violated_have_no_last(spark, tmp_path):
    log, at = str(tmp_path / "log"), datetime(2025, 1, 1, tzinfo=timezone.utc)
    for hours in (0, 1):
        quality_log.record(spark, log, "d", "v1", [RuleOutcome("r", "warn", 5, 0)], at + timedelta(hours=hours))
    entry, = quality_log.entries(spark, log).collect()
    assert entry.recorded_at.replace(tzinfo=timezone.utc).hour == at.hour and entry.checked == 5
    last = quality_log.last_failure(quality_log.entries(spark, log)).first()
    assert (last.runs, last.failed_runs, last.last_run, last.runs_since) == (1, 0, None, None)


def land(root, *days, text="{}"):
    os.makedirs(f"{root}/landing", exist_ok=True)
    for day in days:
        with open(f"{root}/landing/s__fetched_{day}__00_00_00_UTC.json", "x") as file:
            file.write(text)


def stream(spark, root):
    files = streams.identify(streams.snapshot_stream(spark, f"{root}/landing", "s__*.json", max_files=1), NAMING)
    return files.select("source_file", "fetched_at_utc", "fetched_on", "raw_json")


def ingest(spark, root):
    return streams.ingest_available(stream(spark, root), f"{root}/raw", f"{root}/checkpoint", RULES, partition_by=["fetched_on"],
                                    log=f"{root}/log", dataset="raw")


def state(spark, root):
    totals = {r.rule: (r.checked, r.violations) for r in streams.rule_totals(spark, f"{root}/raw").collect()}
    stored = spark.read.parquet(f"{root}/raw").groupBy("source_file").count().orderBy("source_file").collect()
    logged = quality_log.entries(spark, f"{root}/log").groupBy("rule").agg(F.sum("checked"), F.sum("violations")).orderBy("rule").collect()
    return totals, [tuple(r) for r in stored], [tuple(r) for r in logged], streams.newest_ingested(spark, f"{root}/raw")


@pytest.mark.parametrize("dies_after", ["rows", "counts", "log"])
def test_a_run_that_dies_anywhere_leaves_the_same_totals_after_restart(spark, tmp_path, monkeypatch, dies_after):
    days = ["2025-01-01", "2025-01-02", "2025-01-03"]
    quiet, hurt = tmp_path / "quiet", tmp_path / "hurt"
    for root in (quiet, hurt):
        land(root, *days)
    ingest(spark, quiet)

    real_rows, real_record = streams.small_frame, streams.record
    calls = []

    def at_second_batch(work, before):
        def run(*args, **kwargs):
            calls.append(1)
            if len(calls) == 2 and before:
                raise RuntimeError("the driver is gone")
            made = work(*args, **kwargs)
            if len(calls) == 2:
                raise RuntimeError("the driver is gone")
            return made
        return run

    if dies_after == "rows":  # rows are there, counts are not
        monkeypatch.setattr(streams, "small_frame", at_second_batch(real_rows, True))
    else:  # counts are there, the log is not, or both are and the batch is not committed
        monkeypatch.setattr(streams, "record", at_second_batch(real_record, dies_after == "counts"))
    with pytest.raises(StreamingQueryException, match="the driver is gone"):
        ingest(spark, hurt)
    monkeypatch.undo()
    ingest(spark, hurt)
    totals, stored, _, newest = state(spark, hurt)
    assert totals == {"timed": (3, 0), "long": (3, 3)} == state(spark, quiet)[0]
    assert [n for _, n in stored] == [1, 1, 1] and newest == "2025-01-03" == state(spark, quiet)[3]


KILLED = """
import os, sys
sys.path.insert(0, {home!r})
from strata.session import build_session
from strata.streaming import snapshots as streams
from tests.test_quality_log import ingest
spark = build_session("killed", master="local[2]")
real = streams.write_batch
def write_and_die(*args):
    real(*args)
    os.kill(os.getpid(), 9)
streams.write_batch = write_and_die
ingest(spark, {root!r})
"""


def test_totals_after_the_process_was_killed(spark, tmp_path):
    land(tmp_path, "2025-03-01", "2025-03-02")
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    killed = subprocess.run([sys.executable, "-c", KILLED.format(home=home, root=str(tmp_path))], cwd=home, timeout=240)
    assert killed.returncode == -9
    assert state_of_totals(spark, tmp_path) == {"timed": (1, 0), "long": (1, 1)}
    ingest(spark, tmp_path)
    totals, stored, logged, newest = state(spark, tmp_path)
    assert totals == {"timed": (2, 0), "long": (2, 2)} and [n for _, n in stored] == [1, 1]
    assert logged == [("long", 2, 2), ("timed", 2, 0)] and newest == "2025-03-02"


def state_of_totals(spark, root):
    return {r.rule: (r.checked, r.violations) for r in streams.rule_totals(spark, f"{root}/raw").collect()}


def test_a_stopped_batch_is_logged_as_closed(spark, tmp_path):
    land(tmp_path, "2025-01-01", "whenever")
    with pytest.raises(StreamingQueryException, match="expectation violated: timed"):
        ingest(spark, tmp_path)
    closed = quality_log.entries(spark, f"{tmp_path}/log").where("not gate_open")
    assert [(r.rule, r.violations) for r in closed.orderBy("rule").collect()] == [("long", 1), ("timed", 1)]


def test_nothing_ingested_yet(spark, tmp_path):
    assert streams.rule_totals(spark, f"{tmp_path}/raw").isEmpty() and streams.newest_ingested(spark, f"{tmp_path}/raw") is None
    assert streams.read_ingested(spark, f"{tmp_path}/raw", spark.range(1).schema).isEmpty()


def files_opened(frame):
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "AdaptiveSparkPlan" in plan.nodeName() else plan
    leaves, total = plan.collectLeaves(), 0
    for i in range(leaves.size()):
        metric = leaves.apply(i).metrics().get("numFiles")
        total += metric.get().value() if metric.isDefined() else 0
    return total


def test_a_known_newest_snapshot_opens_its_own_files_only(spark, rows, tmp_path):
    opened = []
    for n in (5, 60):
        data = rows([(f"2025-{1 + i // 28:02d}-{1 + i % 28:02d}", i) for i in range(n)], "day string, at int")
        data.repartition(1).write.partitionBy("day").parquet(str(tmp_path / f"t{n}"))
        stored = spark.read.parquet(str(tmp_path / f"t{n}"))
        mark = f"2025-{1 + (n - 1) // 28:02d}-{1 + (n - 1) % 28:02d}"
        newest = latest_snapshot(stored, "at", partition="day", newest_partition=mark)
        assert [r.at for r in newest.collect()] == [n - 1]
        opened.append(files_opened(stored.where(F.col("day") == mark)))
    assert opened[0] == opened[1] == 1
