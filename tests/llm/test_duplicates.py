"""Line dedup, n-gram join and embedding dedup against brute force."""

import random

import numpy as np
import pytest

from strata.llm import embedding_dedup, line_dedup, ngram_join
from tests.llm import brute
from tests.llm.conftest import EDGE_TEXTS


def near_copies(seed, groups=6, size=8, words=60):
    """Texts in groups that share most of their words, a passage that all share, copies and strangers."""
    rng = random.Random(seed)
    new = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passage, out = new(12), []
    for _ in range(groups):
        base = new(words)
        for _ in range(size):
            text = list(base)
            for _ in range(rng.randrange(0, 4)):
                text[rng.randrange(words)] = new(1)[0]
            out.append(" ".join(text + (passage if rng.random() < 0.5 else [])))
        out.append(" ".join(base))
        out.append(" ".join(base).upper())
    out += [" ".join(new(rng.randrange(1, 40)) + passage) for _ in range(20)]
    rng.shuffle(out)
    return out


def test_documents_join_like_brute_force(docs):
    texts = [*near_copies(1), *EDGE_TEXTS, "a b c", "A b C", "a b d"]
    frame = docs(texts, extra=True)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join_documents(frame, tile=3).collect()}
    assert found == brute.join_documents(dict(enumerate(texts)))
    kept = ngram_join.keep_one_of_each(frame)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == [k for k, (_, c) in sorted(found.items()) if k == c]


def test_documents_without_or_with_repeated_ids(docs, spark):
    rows = [(None, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (2, "q r s t u v"), (3, "q r s t u v"), (4, "other")]
    found = sorted(((r.doc_id, r.component_id) for r in ngram_join.join_documents(docs(rows)).collect()), key=str)
    assert found == [(1, 1), (2, 1), (2, 1), (3, 1), (4, 4), (None, None)]
    assert ngram_join.join_documents(docs([]).limit(0)).collect() == []


def test_one_row_stays_of_rows_that_repeat_an_id_and_a_text(docs):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (5, "A b c d e f"), (7, "a b c d e f"), (7, "q r s t u v"), (7, "q r s t u v"),
            (9, "q r s t u v"), (8, "other"), (None, "other"), (None, "other"), (6, " "), (6, " ")]
    kept = ngram_join.keep_one_of_each(docs(rows, extra=True).repartition(3))
    assert kept.columns == docs(rows, extra=True).columns
    found = sorted(((r.doc_id or 0, r.text.lower()) for r in kept.collect()))
    assert found == [(0, "other"), (0, "other"), (5, "a b c d e f"), (6, " "), (6, " "), (7, "q r s t u v"), (8, "other")]


def test_order_filters_never_reject_a_link():
    rng = np.random.default_rng(3)
    classes = (rng.random(ngram_join.SKETCH) < 0.3).astype(np.uint8)
    for _ in range(300):
        n = int(rng.integers(5, 200))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.93], rng.integers(0, 2**63, max(1, n // 20)).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 80 * (len(a) + len(b) - both):
            orders = [ngram_join.ordered_prefixes(x, classes, 80) for x in (a, b)]
            assert ngram_join.may_link(len(a), len(b), *orders, 80)


def line_texts():
    texts = near_copies(5, groups=4, size=5, words=30)
    rng = random.Random(9)
    many = ["\n".join(rng.sample(texts, 4) + ["short line", "  padded\tand  spaced ", ""]) for _ in range(12)]
    return [*many, *EDGE_TEXTS, "a b c d e f g h\na b c d e f g h\r"]


def test_lines_are_removed_like_brute_force(docs):
    texts = line_texts()
    wanted = brute.removed_lines(dict(enumerate(texts)))
    found = line_dedup.report_removed(docs(texts, extra=True)).collect()
    assert {(r.doc_id, n) for r in found for n in r.removed} == wanted
    assert {r.doc_id: r.n_lines for r in found} == {i: len(t.split("\n")) if t is not None else 0 for i, t in enumerate(texts)}


def test_lines_beyond_the_packed_sizes_are_removed_alike(docs, monkeypatch):
    monkeypatch.setattr(line_dedup, "_MOST_N", 7)
    monkeypatch.setattr(line_dedup, "_MOST_AT", 1)
    texts = line_texts()
    found = line_dedup.report_removed(docs(texts)).collect()
    assert {(r.doc_id, n) for r in found for n in r.removed} == brute.removed_lines(dict(enumerate(texts)))


def test_tokens_in_rows_are_the_tokens_in_arrays(docs):
    lines = line_dedup.lines_of(line_dedup.documents_only(docs(line_texts())))
    hashed = lines.select(line_dedup.word_hashes(line_dedup.words_of("line")).alias("h"))
    arrays = [t for r in hashed.select(line_dedup.token_numbers("h").alias("t")).collect() for t in r.t]
    assert sorted(arrays) == sorted(r.token for r in line_dedup.token_rows(lines).collect())


def test_text_without_the_removed_lines(docs):
    texts = line_texts()
    frame = docs(texts, extra=True)
    wanted = brute.removed_lines(dict(enumerate(texts)))
    out = line_dedup.remove_repeated_lines(frame)
    assert out.columns == frame.columns
    found = {r.doc_id: r.text for r in out.collect()}
    for i, text in enumerate(texts):
        lines = (text or "").split("\n")
        left = [line for n, line in enumerate(lines) if (i, n) not in wanted]
        had, has = any(x.strip(" \t\x0b\f\r") for x in lines), any(x.strip(" \t\x0b\f\r") for x in left)
        if had and not has:
            assert i not in found
        else:
            assert found[i] == (None if text is None else "\n".join(left))


def test_lines_of_rows_without_doc_id_and_empty_tables(docs):
    rows = [(None, "same line"), (None, "same line"), (3, "same line"), (3, "same line"), (4, "same line")]
    found = line_dedup.remove_repeated_lines(docs(rows)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in found) == [(False, 3), (False, 3), (True, 0), (True, 0)]
    assert line_dedup.report_removed(docs([]).limit(0)).collect() == []


def test_vectors_link_like_brute_force(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16))
    vectors = np.concatenate([c + rng.normal(scale=0.12, size=(25, 16)) for c in centres]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(1000 + i, vectors[7].tolist()) for i in range(40)] + [(2000, (vectors[7] * 3).tolist())]
    odd = [(3000, None), (3001, [0.0] * 16), (3002, [float("nan")] + [1.0] * 15), (3003, [float("inf")] * 16),
           (3004, [None] + [1.0] * 15), (3005, []), (3006, vectors[0, :8].tolist()), (None, vectors[0].tolist())]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").repartition(5)
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in
             embedding_dedup.link_vectors(frame, block=32, tile=2).collect()}
    ids = [i for i, _ in rows]
    at = np.array([v for _, v in rows], np.float32).astype(float)
    at /= np.sqrt((at * at).sum(axis=1, keepdims=True))
    near = at @ at.T >= 0.95
    np.fill_diagonal(near, False)
    assert near.any()
    component = brute.smallest_reachable(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(near)) if a < b])
    for i, key in enumerate(ids):
        assert found[key] == (near[i].sum(), component[key], component[key] == key)
    for key, _ in odd[:-1]:
        assert found[key] == (0, key, True)
    assert found[None] == (0, None, False)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embedding_dedup.link_vectors(empty).collect() == []


def test_a_text_of_very_many_lines_loses_its_repeated_ones(docs):
    own = [f"line number {i} says that {7 * i} is not {13 * i} or {i % 5}" if i % 3 else "" for i in range(40_000)]
    text = "\n".join([*own, "the same words come here once more", "", "the same words come here once more"])
    found = {r.doc_id: r.text for r in line_dedup.remove_repeated_lines(docs([text, "the same words come here once more\nand new ones"])).collect()}
    assert found == {0: "\n".join([*own, "the same words come here once more", ""]), 1: "and new ones"}


def test_sets_of_lines_go_only_where_they_take_part(docs, spark):
    """What meets at the earlier lines: one set for each pair, and one for each earlier line, not those of all lines."""
    first = " ".join(f"w{i}" for i in range(30))
    texts = [first, *[first.replace("w29", f"v{k}") for k in range(6)], first + " end"]
    frame = line_dedup.documents_only(docs(texts))
    pairs = spark.createDataFrame([(k, 0, 0, 0) for k in range(1, 8)] + [(7, 0, 6, 0)],
                                  "doc_id long, line_no int, early_doc long, early_line int")
    levels = line_dedup.rarity_levels(line_dedup.lines_of(frame))
    exchanged = []

    class Sets:
        """Keeps what ``verified`` writes, to count it."""
        def __call__(self, df, label):
            out = line_dedup_written(df, label)
            if label.endswith("-sets"):
                exchanged.append({(r.doc_id, r.later, r.earlier) for r in out.select("doc_id", "later", "earlier").collect()})
            return out

    line_dedup_written, line_dedup.written = line_dedup.written, Sets()
    try:
        found = line_dedup.verified(pairs, frame, levels, 80, "t")
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert {(r.doc_id, r.line_no) for r in found.collect()} == {(k, 0) for k in range(1, 8)}
    finally:
        line_dedup.written = line_dedup_written
    assert exchanged == [{(0, False, True), *[(k, True, False) for k in range(1, 6)], (6, True, True), (7, True, False)}]
    assert "BroadcastHashJoin [doc_id" in plan  # pairs come to the sets of their later lines, which are not dealt out for that


@pytest.mark.parametrize("beside", [1, 4])
def test_levels_are_those_of_counted_buckets(docs, monkeypatch, beside):
    lines = line_dedup.lines_of(line_dedup.documents_only(docs(line_texts())))
    monkeypatch.setattr(line_dedup, "BUCKETS", 16)
    monkeypatch.setattr(line_dedup, "BESIDE", beside)
    counts = [0] * 16
    for row in line_dedup.token_rows(lines).collect():
        counts[row.token & 15] += 1
    usual = sorted(counts)[7:9]
    noise = sum(usual) / 2 + 2 * (sum(usual) / 2) ** 0.5 + 2
    levels = line_dedup.rarity_levels(lines)
    assert [level > 0 for level in levels] == [n > noise for n in counts]


@pytest.mark.parametrize("white", ["\t", "\x0b", "\f", "\r", "  "])
def test_words_between_any_white_space(docs, white):
    line = f"a b{white}c d"
    found = line_dedup.lines_of(line_dedup.documents_only(docs([line, " " + line, line + " "])))
    assert [r.w for r in found.select(line_dedup.words_of("line").alias("w")).collect()] == [list("abcd")] * 3
