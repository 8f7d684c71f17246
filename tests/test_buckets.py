"""State kept in buckets: yearly values, manifests, and moments that merge."""

import math
import os
import random
import statistics

import pytest
from pyspark.sql import functions as F

from strata.operators import manifest, moments, rollup, yearly_state
from strata.operators.buckets import BucketedTable, replaced

OBS = "series_id string, year int, period string, value decimal(18,3)"
PERIODS = ["Q01", "Q02", "Q03", "Q04", "Q05", "S01", None]


def random_obs(seed, count=300):
    from decimal import Decimal
    pick = random.Random(seed)
    return [(pick.choice([None, "a", "b", "c", "d e"]), pick.choice([None, 2001, 2002, 2003]), pick.choice(PERIODS),
             pick.choice([None, Decimal(pick.randint(-500, 500)) / 4])) for _ in range(count)]


def as_rows(frame):
    return sorted(map(str, frame.select(
        "series_id", "year", "quarter_count", "_quarterly_sum", "_q05_count", "_q05_value", "_unexpected_period_count").collect()))


@pytest.mark.parametrize("parts", [1, 4])
def test_state_after_increments_equals_the_rollup_over_everything(spark, rows, tmp_path, parts):
    data = random_obs(parts)
    state = yearly_state.YearlyState(spark, str(tmp_path / "state"), buckets=3)
    for number in range(parts):
        assert state.add(number + 1, rows(data[number::parts], OBS))
        assert not state.add(number + 1, rows(data, OBS))
    assert as_rows(state.rollup()) == as_rows(rollup.yearly_rollup(rows(data, OBS)))


def test_corrections_and_withdrawals_of_old_periods(spark, rows, tmp_path):
    from decimal import Decimal as D
    state = yearly_state.YearlyState(spark, str(tmp_path / "state"), buckets=4)
    state.add(1, rows([("a", 1990, "Q01", D(1)), ("a", 1990, "Q02", D(2)), ("a", 1990, "Q05", D(9)), ("b", 1990, "Q05", D(7))], OBS))
    state.add(2, rows([("a", 2020, "Q01", D(5))], OBS))
    state.add(3, rows([("a", 1990, "Q02", D(4)), ("b", 1990, "Q05", D(3))], OBS), corrections=True)
    state.withdraw(4, rows([("a", 1990, "Q01", None), ("b", 1999, "Q01", None)], OBS).drop("value"))
    state.add(5, rows([("b", 1990, "Q05", D(8))], OBS))
    now = [("a", 1990, "Q02", D(4)), ("a", 1990, "Q05", D(9)), ("a", 2020, "Q01", D(5)), ("b", 1990, "Q05", D(3)), ("b", 1990, "Q05", D(8))]
    assert as_rows(state.rollup()) == as_rows(rollup.yearly_rollup(rows(now, OBS)))
    assert state.rollup(version=1).where("series_id = 'a'").first()._quarterly_sum == D(3)


def test_merging_is_associative(rows):
    parts = [yearly_state.cells_of(rows(random_obs(n, 60), OBS), n) for n in (1, 2, 3)]
    for merge in (yearly_state.added, yearly_state.corrected):
        left, right = merge(merge(parts[0], parts[1]), parts[2]), merge(parts[0], merge(parts[1], parts[2]))
        assert sorted(map(str, left.collect())) == sorted(map(str, right.collect()))


def files_below(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names}


def test_an_update_reads_and_writes_touched_buckets_only(spark, rows, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), ("k",), "k int, v string", 8)
    table.update(1, rows([(i, "old") for i in range(200)], "k int, v string"), replaced(["k"]))
    before, files = table.folders(), files_below(tmp_path)
    changed = rows([(5, "new"), (1000, "new")], "k int, v string")
    touched, old = table.read_touched(changed, before)
    assert len(touched) <= 2 and {os.path.basename(os.path.dirname(f)) for f in old.inputFiles()} <= {f"bucket={b}" for b in touched}
    table.update(2, changed, replaced(["k"]))
    after = table.folders()
    assert {b for b in after if after[b] != before.get(b)} == set(touched)
    assert files.items() <= files_below(tmp_path).items()
    assert {r.k: r.v for r in table.read().collect()} == {i: "old" for i in range(200)} | {5: "new", 1000: "new"}
    assert table.read(version=1).where("v = 'new'").isEmpty()


def test_an_update_that_dies_leaves_the_version_and_can_be_repeated(spark, rows, tmp_path, monkeypatch):
    from strata.operators import buckets
    table = BucketedTable(spark, str(tmp_path / "t"), ("k",), "k int, v string", 4)
    table.update(1, rows([(1, "old")], "k int, v string"), replaced(["k"]))
    real = buckets.small_frame
    monkeypatch.setattr(buckets, "small_frame", lambda *a: (_ for _ in ()).throw(RuntimeError("gone")))
    with pytest.raises(RuntimeError, match="gone"):
        table.update(2, rows([(1, "new")], "k int, v string"), replaced(["k"]))
    monkeypatch.setattr(buckets, "small_frame", real)
    assert (table.version(), table.read().first().v) == (1, "old")
    os.makedirs(tmp_path / "t" / "versions" / "000000000009")  # a list that was begun and never finished
    assert table.version() == 1
    assert table.update(2, rows([(1, "new")], "k int, v string"), replaced(["k"])) and table.read().first().v == "new"


LISTING, LOCAL = "file_name string, source_last_modified string, source_size_bytes bigint", "file_name string, local_size_bytes bigint"


def test_a_manifest_of_buckets(spark, rows, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "m"), ("file_name",), manifest.MANIFEST, 8)
    names = [f"f{i}" for i in range(60)]

    def run(number, listed):
        listing = rows([(n, m, 1) for n, m in listed.items()], LISTING)
        at = F.lit(f"2025-01-{number:02d}").cast("timestamp")
        return {r.file_name: r.action for r in
                manifest.update_manifest(table, listing, rows([(n, 1) for n in names], LOCAL), at, number).collect()}

    full = dict.fromkeys(names, "t1")
    assert run(1, full) == dict.fromkeys(names, "new")
    before = files_below(tmp_path)
    assert run(2, full) == {} and files_below(tmp_path) == before and table.version() == 1
    less = {n: m for n, m in full.items() if n != "f7"}
    lists = table.folders()
    assert run(3, less) == {"f7": "removed"}
    assert sum(lists[b] != f for b, f in table.folders().items()) == 1
    gone = table.read().where("file_name = 'f7'").first()
    assert gone.status == "removed" and gone.removed_at.day == 3 and gone.first_seen_at.day == 1
    assert run(4, less) == {} and run(5, full) == {"f7": "changed"}
    back = table.read().where("file_name = 'f7'").first()
    assert back.status == "active" and back.removed_at is None and back.first_seen_at.day == 1 and table.read().count() == 60


def test_any_union_of_ranges_equals_the_statistics_of_the_rows(spark, rows):
    pick = random.Random(5)
    data = [(g, y, 3.2e8 + pick.gauss(0, 4e6)) for g in ("a", "b") for y in range(12) for _ in range(40)] + [("c", 1, 5.0), ("c", 2, None), ("d", 3, None)]
    stored = moments.moments(rows(data, "g string, y int, population double"), ["g", "y"])
    for years in ([1], [2, 5, 7], list(range(12))):
        found = {r.g: r for r in moments.mean_and_deviation(moments.merged(stored.where(F.col("y").isin(years)), ["g"])).collect()}
        wanted = {g: [v for h, y, v in data if h == g and y in years and v is not None] for g in "abcd"}
        assert set(found) == {g for g, values in wanted.items() if values}
        for g, row in found.items():
            assert row.n == len(wanted[g]) and math.isclose(row.mean_population, statistics.fmean(wanted[g]), rel_tol=1e-12)
            if row.n > 1:
                assert math.isclose(row.stddev_population, statistics.stdev(wanted[g]), rel_tol=1e-12)
            else:
                assert row.stddev_population is None
    assert moments.merged(stored.where("y > 99"), ["g"]).isEmpty() and moments.merged(stored.where("y > 99")).isEmpty()


def test_a_key_that_came_before_is_flagged_and_the_input_read_once(spark, rows, tmp_path):
    from strata.operators.key_index import KeyIndex
    index = KeyIndex(spark, str(tmp_path / "index"), buckets=4)
    schema = "k string, n int, payload string"
    reads = spark.sparkContext.accumulator(0)

    def counted(data):
        import pyspark.sql.types as T

        def pass_on(batches):
            for batch in batches:
                reads.add(batch.num_rows)
                yield batch
        return rows(data, schema).mapInArrow(pass_on, T.StructType.fromDDL(schema))

    def flags(data, number):
        return sorted((r.payload, r._natural_key_unique) for r in index.flag_increment(counted(data), ["k", "n"], number).collect())

    first = [("a", 1, "p"), ("a", 1, "q"), ("a", 2, "r"), (None, 1, "s"), ("", None, "t"), (None, None, "u")]
    assert flags(first, 1) == [("p", False), ("q", False), ("r", True), ("s", True), ("t", True), ("u", True)]
    second = [("a", 2, "v"), (None, 1, "w"), ("b", 1, "x"), ("", 1, "y"), (None, None, "z")]
    assert flags(second, 2) == [("v", False), ("w", False), ("x", True), ("y", True), ("z", False)]
    assert reads.value == len(first) + len(second)
    assert flags(second, 2) == [("v", False), ("w", False), ("x", True), ("y", True), ("z", False)]
    assert sorted(r.n for r in index.repeated().collect()) == [2, 2, 2, 2]
    assert flags([], 3) == [] and flags([("b", 1, "late")], 4) == [("late", False)]
