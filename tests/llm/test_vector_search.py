"""Exact top-k and hard negatives against plain loops over all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import exact_topk, hard_negatives, vectors

SCHEMA = "vec_id long, embedding array<double>, label int, v string, score int, `_query` int"


def table(spark, rows):
    """Rows of (vec_id, embedding, label), with columns whose names clash with those used inside."""
    return spark.createDataFrame([(*row, "x", 1, 2) for row in rows], SCHEMA).repartition(3)


def usable(embedding):
    return embedding is not None and all(x is not None and math.isfinite(x) for x in embedding)


def integers(embedding, scale):
    return [math.floor(scale * x) for x in embedding]


def dot(a, b):
    return min(max(sum(x * y for x, y in zip(a, b)), -2 ** 63), 2 ** 63 - 1)


def odd_rows(seed, count=150, width=6):
    pick = random.Random(seed)
    rows = [(i, [round(pick.uniform(-1, 1), 2) for _ in range(width)], pick.randint(0, 3)) for i in range(count)]
    rows += [(count + i, rows[3][1], rows[3][2] + i % 2) for i in range(40)]  # copies: ties
    rows += [(500, [0.0] * width, 1), (501, [], 1), (502, None, 1), (503, [1.0, None], 1), (504, [float("nan")] * width, 2),
             (505, [float("inf")] + [0.0] * 5, 0), (None, [1.0] * width, 1), (506, [1.0, 1.0], 0), (507, [0.3] * width, None),
             (10, rows[11][1], 2), (10, rows[12][1], 0), (20, rows[20][1], rows[20][2]), (508, [0.5] * 9, 2)]
    return rows


def brute_top(rows, k, scale, every):
    usable_rows = [(i, integers(e, scale)) for i, e, _ in rows if i is not None and usable(e)]
    found = []
    for query, q in usable_rows:
        if query % every == 0:
            best = sorted((-dot(q, v), i) for i, v in usable_rows if i != query)[:k]
            found += [(query, rank, i, -score) for rank, (score, i) in enumerate(best, 1)]
    return sorted(found)


def brute_hard(rows, every, k=5, scale=256, percent=80):
    usable_rows = [(i, integers(e, scale), label) for i, e, label in rows if None not in (i, label) and usable(e)]
    found = []
    for anchor, a, label in usable_rows:
        if anchor % every:
            continue
        scored = sorted((-dot(a, v), i, other) for i, v, other in usable_rows if i != anchor)
        for p, positive, _ in [s for s in scored if s[2] == label][:k]:
            fit = [(i, -n) for n, i, other in scored if other != label and percent * -p <= 100 * -n <= 100 * -p][:k]
            found += [(anchor, positive, rank, i, -p, n) for rank, (i, n) in enumerate(fit, 1)]
    return sorted(found)


@pytest.mark.parametrize("k, scale", [(10, 1024), (1, 1), (500, 8)])
def test_top_k_of_odd_rows(spark, k, scale):
    rows = odd_rows(k)
    found = exact_topk.top_k(table(spark, rows), F.col("vec_id") % 5 == 0, k, scale)
    assert sorted(map(tuple, found.select("query_id", "rank", "vec_id", "score").collect())) == brute_top(rows, k, scale, 5)


def test_top_k_refines_wide_ranges_and_huge_scores(spark):
    pick = random.Random(1)
    rows = [(i, [pick.uniform(-1, 1) * 10 ** pick.choice([0, 3, 6, 9]) for _ in range(4)], 0) for i in range(300)]
    found = exact_topk.top_k(table(spark, rows), F.col("vec_id") % 10 == 0, 10, 1024)
    assert sorted(map(tuple, found.select("query_id", "rank", "vec_id", "score").collect())) == brute_top(rows, 10, 1024, 10)


def test_top_k_in_several_waves(spark, monkeypatch):
    rows = odd_rows(4)
    inner = vectors.waves
    monkeypatch.setattr(exact_topk, "waves", lambda queries: inner(queries, numbers=700))
    found = exact_topk.top_k(table(spark, rows), F.col("vec_id") % 5 == 0, 10, 1024)
    assert sorted(map(tuple, found.select("query_id", "rank", "vec_id", "score").collect())) == brute_top(rows, 10, 1024, 5)


def test_top_k_counts_no_score_twice_when_it_refines(spark):
    # Bins of 601 from -153602 on: 254 to 854 is refined, and the five scores beyond it must not count again.
    scores = [-153600, *range(300, 400), *range(860, 865)]
    rows = [(0, [1.0], 0)] + [(i, [float(score)], 0) for i, score in enumerate(scores, 1)]
    found = exact_topk.top_k(table(spark, rows), F.col("vec_id") == 0, 10, 1)
    assert sorted(map(tuple, found.collect())) == brute_top(rows, 10, 1, 10_000)


def test_top_k_of_scores_below_64_bits(spark):
    rows = [(0, [1e10], 0)] + [(i, [-1e9 * i], 0) for i in range(1, 13)]
    found = exact_topk.top_k(table(spark, rows), F.col("vec_id") == 0, 10, 1024)
    assert sorted(map(tuple, found.collect())) == brute_top(rows, 10, 1024, 10_000)


@pytest.mark.parametrize("seed", [0, 1])
def test_hard_negatives_of_odd_rows(spark, seed, monkeypatch):
    rows = odd_rows(seed)
    if seed:
        inner = vectors.waves
        monkeypatch.setattr(hard_negatives, "waves", lambda queries: inner(queries, numbers=900))
    found = hard_negatives.mine(table(spark, rows), F.col("vec_id") % 5 == 0, F.col("label"))
    assert sorted(map(tuple, found.collect())) == brute_hard(rows, 5)


def test_empty_tables(spark):
    nothing = table(spark, []).limit(0)
    assert exact_topk.top_k(nothing, F.col("vec_id") % 5 == 0).count() == 0
    assert hard_negatives.mine(nothing, F.col("vec_id") % 5 == 0, F.col("label")).count() == 0
    only_null = table(spark, [(0, None, 1), (5, [None], 1)])
    assert exact_topk.top_k(only_null, F.col("vec_id") % 5 == 0).count() == 0
    assert hard_negatives.mine(only_null, F.col("vec_id") % 5 == 0, F.col("label")).count() == 0


def test_bounds_hold_every_score_and_pass_over_distant_rows():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(4, 16)) * 200
    rows = np.floor(np.repeat(centres, 50, axis=0) + rng.normal(size=(200, 16)) * 10)
    rows[::37] = 0
    norms = np.sqrt((rows * rows).sum(axis=1))
    angles = hard_negatives.angles_to(rows, norms, centres / np.linalg.norm(centres, axis=1, keepdims=True))
    low, high = hard_negatives.pair_bounds(angles, norms, angles, norms)
    scores = vectors.products(rows, rows)
    assert (low <= scores).all() and (scores <= high).all()
    assert (high < 0.8 * scores.max(axis=1)[:, None]).mean() > 0.5
    anchors = hard_negatives.Anchors(np.arange(200), np.zeros(200, int), rows, angles, norms, None, None, True)
    for start in range(0, 200, 50):
        block = slice(start, start + 50)
        least, most = hard_negatives.block_bounds(anchors, slice(0, 200), angles[block], norms[block])
        assert (least <= scores[:, block].min(axis=1)).all() and (scores[:, block].max(axis=1) <= most).all()


def test_least_score():
    score = np.array([0, 1, 4, 5, 99, 100, 101, 2 ** 62])
    assert hard_negatives.least_score(score, 80).tolist() == [-(-int(s) * 80 // 100) for s in score]
