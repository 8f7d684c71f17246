"""The pipeline, stage by stage and as a whole, against brute force."""

import random

import pyarrow as pa
import pytest

import corpus_pipeline
from strata.llm import language_id
from strata.llm.common import BATCH_BYTES, tidy
from tests.llm import brute
from tests.llm.test_search_and_tokens import ids_of


def corpus():
    rng = random.Random(12)
    lists = {"en": "the of and with house tree river moon stone bird".split(), "xx": "zork blap grun klee vost drim plok snee".split()}
    new = lambda lang, n: " ".join(rng.choice(lists[lang]) + rng.choice("abcdefgh") + rng.choice("klmnop") for _ in range(n))
    items = [(f"q{i}", new("en", 14)) for i in range(4)]
    rows, shared = [], new("en", 60)
    for i in range(40):
        lang = "en" if i % 2 else "xx"
        lines = [new(lang, rng.randrange(8, 60)) for _ in range(3)]
        if i % 5 == 0:
            lines.insert(1, shared)
        if i % 7 == 0:
            lines.append(items[i % 4][1].upper() + " end")
        rows.append((i, "\n".join(lines), lang if i % 3 else None, "src", 0))
    rows += [(50, rows[3][1], "en", "src", 0), (51, rows[4][1] + " more", "xx", "src", 0), (52, None, "en", "src", 0),
             (53, "", None, "src", 0), (54, "12 34 !!", "en", "src", 0), (55, "a\n\nb", "en", "src", 0)]
    near = rows[9][1].split()
    near[5], near[30] = "changedx", "changedy"
    rows.append((56, " ".join(near), "en", "src", 0))
    return rows, items


def expected(rows, items, spark):
    texts = {r[0]: r[1] for r in rows}
    profiles = language_id.learn_profiles(spark.createDataFrame([(r[2], r[1]) for r in rows], "lang string, text string"))
    one = {k: t for k, t in texts.items() if profiles.best(t)[0] != "und"}
    gone = brute.removed_lines(one)
    two = {}
    for k, text in one.items():
        left = [line for n, line in enumerate(text.split("\n")) if (k, n) not in gone]
        if any(line.strip() for line in left):
            two[k] = "\n".join(left)
    three = {k: two[k] for k, (_, c) in brute.join_documents(two).items() if c == k}
    four = {k: three[k] for k, v in brute.contamination(three, items).items() if not v[1]}
    return [one, two, three, four]


def test_every_stage_and_the_whole(spark, tmp_path):
    rows, items = corpus()
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, columns).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    wanted = expected(rows, items, spark)
    for number, ((name, stage), texts) in enumerate(zip(corpus_pipeline.STAGES, wanted)):
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / f"stage-{number}"))
        docs = spark.read.parquet(str(tmp_path / f"stage-{number}"))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        assert {r.doc_id: r.text for r in docs.collect()} == texts, name
    assert len(rows) > len(wanted[0]) > len(wanted[1]) >= len(wanted[2]) > len(wanted[3]) > 10
    covered = {k: 0 for k in wanted[3]}
    for piece in corpus_pipeline.run(spark, str(tmp_path)).collect():
        covered[piece.doc_id] += piece.length
    assert covered == {k: len(ids_of(t)) for k, t in wanted[3].items()}


def test_a_text_in_a_script_not_learned_goes_with_the_first_stage(spark):
    rows = [(1, "the house by the river", "en"), (2, "日本語の文章", None), (3, "a house", None), (4, "日本 the", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted(r.doc_id for r in corpus_pipeline.identified(spark, docs, "").collect()) == [1, 3, 4]


def test_an_empty_table_gives_no_pieces(spark, tmp_path):
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], columns).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("stage", [0, 2, 3, 4])
def test_stages_send_small_batches_to_workers(spark, tmp_path, stage):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.createDataFrame([(i, f"the house {i}", "en") for i in range(3)], "doc_id long, text string, lang string")
    spark.createDataFrame([("a", "one two three")], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    try:
        spark.conf.unset(name)
        corpus_pipeline.STAGES[stage][1](spark, docs, str(tmp_path))

        @tidy
        def measure(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.nbytes], pa.int64()), pa.array([pa.default_memory_pool().backend_name])], ["n", "pool"])

        long = spark.range(0, 6000, 1, 1).selectExpr("repeat('x', 5000) AS text")
        made = long.mapInArrow(measure, "n long, pool string").collect()
        assert sum(row["n"] for row in made) >= 30_000_000 and max(row["n"] for row in made) < 1.5 * BATCH_BYTES
        assert {row["pool"] for row in made} == {"system"}
        spark.conf.set(name, "5000000b")
        corpus_pipeline.STAGES[stage][1](spark, docs, str(tmp_path))
        assert spark.conf.get(name) == "5000000b"
    finally:
        spark.conf.unset(name)
