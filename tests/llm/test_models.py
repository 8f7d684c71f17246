"""Language ID, language model, toxicity and quality on small made-up corpora."""

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.llm import common, language_id, lm, quality, toxicity
from tests.llm.conftest import EDGE_TEXTS

ALPHABETS = {"aa": ["ka", "to", "mi", "ra"], "bb": ["strö", "chen", "gau", "pf"], "cc": ["日", "本", "語", "の"]}


def sentences(lang, rng, n):
    return [" ".join("".join(rng.choices(ALPHABETS[lang], k=rng.randrange(1, 4))) for _ in range(rng.randrange(5, 40))) for _ in range(n)]


def test_languages_are_told_apart(docs, spark):
    rng = random.Random(1)
    rows = [(lang, text) for lang in ALPHABETS for text in sentences(lang, rng, 30)] + [(None, "kato mira"), ("aa", None)]
    profiles = language_id.learn_profiles(spark.createDataFrame(rows, "lang string, text string"))
    assert profiles.languages == ["aa", "bb", "cc"]
    texts = [t for lang in ALPHABETS for t in sentences(lang, rng, 10)]
    frame = docs([*texts, *EDGE_TEXTS, "123 !!", "KATO MIRA"], extra=True)
    found = {r.doc_id: r for r in language_id.identify(frame, profiles).collect()}
    assert [found[i].lang_pred for i in range(30)] == ["aa"] * 10 + ["bb"] * 10 + ["cc"] * 10
    assert [found[30 + i].lang_pred for i in (0, 1, 2)] == ["und"] * 3 and found[39].lang_pred == "und"
    assert found[40].lang_pred == "aa" and all(0 <= r.score <= 1 for r in found.values())
    kept = language_id.keep_identified(frame, profiles)
    assert kept.columns == frame.columns and kept.count() == sum(r.lang_pred != "und" for r in found.values())
    nothing = language_id.learn_profiles(spark.createDataFrame([], "lang string, text string"))
    assert {r.lang_pred for r in language_id.identify(frame, nothing).collect()} == {"und"}


def plain_distance(text, profile, top):
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    counts = Counter()
    marked = "_" + "_".join(words) + "_"
    for n in (1, 2, 3):
        for i in range(len(marked) - n + 1):
            gram = marked[i:i + n]
            if not (gram == "_" or (n == 3 and gram[1] == "_")):
                counts[gram] += 1
    key = lambda g: sum((1 if c == "_" else ord(c)) << 21 * (len(g) - 1 - i) for i, c in enumerate(g))
    ranked = sorted(counts, key=lambda g: (-counts[g], key(g)))[:top]
    place = {g: i for i, g in enumerate(profile)}
    return sum(abs(i - place[key(g)]) if key(g) in place else top for i, g in enumerate(ranked)), len(ranked)


def test_distance_is_the_out_of_place_sum():
    rng = random.Random(3)
    profile = language_id.ranked(language_id.gram_codes(" ".join(sentences("aa", rng, 20)))).tolist()
    profiles = language_id.Profiles({"aa": profile})
    for text in sentences("aa", rng, 10) + sentences("bb", rng, 5):
        distance, grams = plain_distance(text, profile, language_id.TOP)
        assert profiles.best(text)[1] == pytest.approx(1 - distance / (language_id.TOP * grams))


def test_language_model_counts_exactly_and_learns_context(docs, monkeypatch):
    monkeypatch.setattr(lm, "HEAD", 30)
    monkeypatch.setattr(lm, "MODEL_WORDS", 20)
    rng = random.Random(2)
    chain = {0: "a b c d", 1: "e f g h"}
    texts = [" ".join((chain[i % 2] + f" r{rng.randrange(40)}") for _ in range(40)) for i in range(120)]
    train, test = texts[:100], [*texts[100:], *EDGE_TEXTS, "A b never"]
    scored = {r.doc_id: r for r in lm.score_with_model(docs(test, extra=True), docs(train)).collect()}
    tokens = lambda text: [*((text or "").encode().lower().split()), b"\n"]
    counts = Counter(t for text in train for t in tokens(text))
    total, types = sum(counts.values()), len(counts)
    for i, text in enumerate(test):
        found, row = tokens(text), scored[i]
        assert (row.n_tokens, row.n_known, row.train_tokens) == (len(found), sum(counts[t] > 0 for t in found), total)
        assert row.base_score == pytest.approx(sum(math.log10((counts[t] + 1) / (total + types + 1)) for t in found))
    assert sum(scored[i].score for i in range(20)) > sum(scored[i].base_score for i in range(20)) + 100
    empty = lm.score_with_model(docs(["x y"]), docs([]).limit(0)).collect()
    assert empty[0].n_known == 0 and empty[0].train_tokens == 0 and math.isfinite(empty[0].score)


def test_every_training_position_is_a_target(docs):
    texts = [*(f"a b c w{i}" for i in range(50)), *EDGE_TEXTS]
    frame = docs(texts).repartition(3)
    counts = lm.count_words(frame)
    total = sum(len((text or "").encode().split()) + 1 for text in texts)
    assert lm.train(frame, lm.learn_vocabulary(counts)).positions == total


def test_words_of_a_slice_are_the_words_of_each_text():
    texts = [*EDGE_TEXTS, "", None, "  A\x0bb\tÀÉ \x1c\u2003x a ", "\n", "z"]
    names, codes, starts = lm.tokens_of(pa.array(texts, pa.string()))
    plain = [[*(text or "").encode().lower().split(), b"\n"] for text in texts]
    assert [names[int(c)].as_py() for c in codes] == [word for words in plain for word in words]
    assert starts.tolist() == np.cumsum([0, *map(len, plain)])[:-1].tolist() and len(set(names.to_pylist())) == len(names)
    words = [b"", b"a", b"xyz", b"wxyz", "ß→".encode()]
    assert lm.word_classes(pa.array(words, pa.binary()), 211).tolist() == [lm.word_class(word, 211) for word in words]


def test_sums_of_runs_and_of_exponentials_beyond_the_range():
    random = np.random.default_rng(1)
    for most in (3, 40, 5000):
        rows, values = random.integers(0, most, 900), random.normal(size=(900, 4)).astype(np.float32)
        order = np.argsort(rows, kind="stable")
        cuts = np.unique(rows[order], return_index=True)[1]
        plain = np.stack([values[rows == row].sum(axis=0) for row in np.unique(rows)])
        assert np.allclose(lm.run_sums(values, order, cuts), plain, atol=1e-4)
    scores = np.array([[0, 1], [500, 499], [-500, -501], [-90, 3]], np.float32)
    assert np.allclose(lm.log_sums(scores * lm.BITS), np.logaddexp(scores[:, 0], scores[:, 1]))
    left, right = random.normal(size=(2, 700, 3)).astype(np.float32)
    assert np.allclose(lm.products(left, right), left.T @ right, atol=1e-3)


def test_model_probabilities_sum_to_one():
    unigram = np.array([0.5, 0.3, 0.15, 0.05])
    model = lm.LogBilinear(lm.LogBilinear.fresh(unigram))
    near, far = np.repeat(2, 4), np.repeat(4, 4)
    assert np.exp(model.log_probabilities(near, far, np.arange(4))).sum() == pytest.approx(1, abs=1e-5)


def test_every_repeated_word_has_a_row_beyond_the_least_number(docs, monkeypatch):
    monkeypatch.setattr(lm, "MODEL_WORDS", 20)
    monkeypatch.setattr(lm, "HEAD", 30)
    rng = random.Random(4)
    texts = [" ".join(f"{'xyz'[k % 3]}{k} next{k}" for k in rng.choices(range(60), k=60)) + f" once{i}" for i in range(100)]
    frame = docs(texts)
    words = lm.learn_vocabulary(lm.count_words(frame))
    assert set(words.rows) == {b"\n", *(w for k in range(60) for w in (b"%c%d" % (b"xyz"[k % 3], k), b"next%d" % k))}
    model = lm.train(frame, words)
    _, rows, starts = lm.Reader(words).read(texts[:10])
    near, far = lm.contexts(rows, starts, len(words.unigram))
    follows = np.isin(rows, [words.rows[b"next%d" % k] for k in range(60)])
    logs = model.log_probabilities(near, far, rows)
    assert logs[follows].mean() > np.log(words.unigram[rows[follows]]).mean() + 1
    everything = np.arange(len(words.unigram))
    every = model.log_probabilities(np.full(len(everything), near[5]), np.full(len(everything), far[5]), everything)
    assert np.exp(every).sum() == pytest.approx(1, abs=1e-4)
    scored = {r.doc_id: r for r in lm.score_with_model(docs(["x0 next0 once3", "x0 next0 never"]), frame).collect()}
    assert (scored[0].n_known, scored[1].n_known) == (4, 3) and scored[0].score > scored[1].score


def toxic_corpus(rng, n):
    rows = []
    for i in range(n):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(5, 60))]
        label = int(rng.random() < 0.25)
        if label:
            words.insert(rng.randrange(len(words)), rng.choice(["awful", "Nasty!", "grumpf" + rng.choice("abcdefgh")]))
        rows.append((i, " ".join(words), label))
    return rows


def test_toxic_texts_and_spans(docs, spark):
    rows = toxic_corpus(random.Random(5), 500)
    train = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5]
    labels = spark.createDataFrame([(i, y) for i, _, y in train] + [(None, 1), (3, None)], "doc_id long, label int")
    frame = docs([(i, t) for i, t, _ in rows])
    model = toxicity.learn_tagger(frame, labels)
    found = {r.doc_id: r for r in toxicity.score_toxicity(frame, model).collect()}
    held = [r for r in rows if not zlib.crc32(str(r[0]).encode()) % 5]
    right = sum((found[i].score >= 0.5) == bool(y) for i, _, y in held)
    assert right >= 0.97 * len(held)
    text = "w1 w2 Nasty! w3"
    odd = toxicity.score_toxicity(docs([text, *EDGE_TEXTS], extra=True), model).orderBy("doc_id").collect()
    assert [text[s.start:s.end] for s in odd[0].spans] == ["Nasty!"]
    assert all(r.score < 0.5 and not r.spans for r in odd[1:]) and len(odd) == 1 + len(EDGE_TEXTS)
    one_class = toxicity.learn_tagger(frame, labels.where("label = 0"))
    assert {r.score for r in toxicity.score_toxicity(frame.limit(3), one_class).collect()} == {0.0}


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    move = np.exp(rng.normal(size=(2, 2)))
    lengths = np.array([4, 1, 3])
    starts = np.cumsum(lengths) - lengths
    score = rng.normal(size=8)
    odds = toxicity.marginal_odds(score, starts, lengths, move)
    for start, n in zip(starts, lengths):
        weight = np.zeros((n, 2))
        for path in np.ndindex(*[2] * n):
            w = np.exp(sum(score[start + t] for t in range(n) if path[t])) * np.prod([move[a, b] for a, b in zip(path, path[1:])])
            for t in range(n):
                weight[t, path[t]] += w
        assert np.allclose(odds[start:start + n], weight[:, 1] / weight[:, 0])


def test_slopes_equal_finite_differences_of_the_likelihood():
    rng = np.random.default_rng(5)
    lengths = np.array([4, 1, 0, 6])
    starts = np.cumsum(lengths) - lengths
    score, gold = rng.normal(size=11), rng.integers(0, 2, 11).astype(float)
    log_move, edges = rng.normal(size=(2, 2)), rng.normal(size=2)

    def likelihood(score, log_move, edges):
        total = 0.0
        for start, n in zip(starts, lengths):
            if not n:
                continue
            def path(tags):
                own = sum(t * score[start + i] for i, t in enumerate(tags)) + tags[0] * edges[0] + tags[-1] * edges[1]
                return own + sum(log_move[a, b] for a, b in zip(tags, tags[1:]))
            every = [path(tags) for tags in itertools.product([0, 1], repeat=int(n))]
            total += path([int(g) for g in gold[start:start + n]]) - np.log(np.exp(every).sum())
        return total

    by_token, by_move = toxicity.slopes(
        toxicity.with_edges(score, starts, lengths, edges), gold, starts, lengths, np.exp(log_move))
    some = lengths > 0
    by_edge = [by_token[starts[some]].sum(), by_token[(starts + lengths - 1)[some]].sum()]
    h = 1e-6
    for values, got in ((score, by_token), (log_move, by_move), (edges, by_edge)):
        for at in np.ndindex(values.shape):
            kept = values[at]
            values[at] = kept + h
            more = likelihood(score, log_move, edges)
            values[at] = kept - h
            less = likelihood(score, log_move, edges)
            values[at] = kept
            assert abs((more - less) / (2 * h) - np.asarray(got)[at]) < 1e-6


def test_cues_beyond_the_first_hundreds_are_weighed():
    texts = [{f"bad{i:03d}x"} for i in range(600) for _ in range(3)] + [{"fine"}] * 1800
    labels = np.array([1] * 1800 + [0] * 1800)
    found = toxicity.toxic_cues(texts, labels)
    assert all(any(cue in found for cue in toxicity.cues(f"bad{i:03d}x")) for i in range(600))


def test_labelled_texts_without_words_give_a_score(docs, spark):
    labels = spark.createDataFrame([(0, 0), (1, 1)], "doc_id long, label int")
    model = toxicity.learn_tagger(docs([" ", ""]), labels)
    assert all(0 <= r["score"] <= 1 for r in toxicity.score_toxicity(docs([" ", "", "a b"]), model).collect())


def test_a_doc_id_in_very_many_rows_teaches_once(docs, spark):
    texts = ["you vile thing"] * 3 + ["a fine day"] * 3
    rows = docs(texts)
    many = rows.unionByName(spark.range(500).select(F.lit(0).cast("long").alias("doc_id"), F.lit("you vile thing again").alias("text")))
    labels = spark.createDataFrame([(i, int(i < 3)) for i in range(6)] * 4, "doc_id long, label int")
    model = toxicity.learn_tagger(many.select("doc_id", "text"), labels)
    got = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(rows, model).collect()}
    assert min(got[i] for i in range(3)) > max(got[i] for i in range(3, 6))


def test_quality_is_learned_from_statistics(docs, spark):
    rng = random.Random(8)
    good = [" ".join(f"word{rng.randrange(300)}" for _ in range(rng.randrange(20, 200))) + "." for _ in range(150)]
    bad = ["*** ".join(rng.choices(["BUY", "NOW", "$$$", "!!!"], k=rng.randrange(20, 200))) for _ in range(60)]
    texts = good + bad
    labels = spark.createDataFrame(
        [(i, int(i < 150)) for i in range(0, 210) if i % 5] + [(1, None), (None, 1)], "doc_id long, label int")
    found = {r.doc_id: r.score for r in quality.score_quality(docs([*texts, *EDGE_TEXTS]), labels).collect()}
    assert sum((found[i] >= 0.5) == (i < 150) for i in range(0, 210, 5)) >= 41
    assert all(0 <= s <= 1 for s in found.values()) and len(found) == 210 + len(EDGE_TEXTS)
    one = quality.score_quality(docs(texts[:3], extra=True), labels.where("label = 1")).collect()
    assert {r.score for r in one} == {1.0}
    assert quality.score_quality(docs([]).limit(0), labels.limit(0)).collect() == []


def test_discriminant_equals_the_normal_densities():
    rng = np.random.default_rng(2)
    at = {0: rng.normal(size=(80, 3)), 1: rng.normal(1.0, 0.5, size=(200, 3))}
    counts = np.array([80.0, 200.0])
    model = quality.Discriminant(counts, np.stack([at[c].sum(axis=0) for c in (0, 1)]), np.stack([at[c].T @ at[c] for c in (0, 1)]), 0, 0)
    x = rng.normal(size=(5, 3))
    logs = []
    for c in (0, 1):
        mean, cov = at[c].mean(axis=0), np.cov(at[c].T, bias=True)
        d = x - mean
        logs.append(np.log(counts[c]) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d))
    assert np.allclose(model.scores(x), 1 / (1 + np.exp(logs[0] - logs[1])), atol=1e-6)


def test_held_out_folds_follow_the_checksum(spark):
    from strata.llm.common import remainder
    rows = spark.range(50).select("id", remainder(F.col("id"), 7).alias("m")).collect()
    assert all(r.m == zlib.crc32(str(r.id).encode()) % 7 for r in rows)


def test_language_passes_free_what_other_passes_keep(docs, monkeypatch):
    frame = docs(["some words"]).withColumn("lang", F.lit("en"))
    passes, gone = [], []
    real = type(frame).mapInArrow
    monkeypatch.setattr(type(frame), "mapInArrow", lambda self, run, schema: passes.append(run) or real(self, run, schema))
    language_id.identify(frame, language_id.learn_profiles(frame))
    monkeypatch.setitem(common._REMEMBERED, "tokens", lambda: gone.append("tokens"))
    monkeypatch.setattr(common, "give_back", lambda: gone.append("given back"))
    for run in passes:
        assert len(list(run(iter([pa.RecordBatch.from_pydict({"text": ["some words"], "lang": ["en"]})])))) == 1
    assert len(passes) == 2 and gone == ["tokens", "given back"] * 2
