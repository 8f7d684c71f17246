"""The text operators as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (
    conversation_repair, decontaminate, embedding_dedup, exact_topk, hard_negatives, language_id, line_dedup, lm, ngram_join, packing,
    quality, token_store, toxicity,
)
from strata.llm.common import remainder, ship, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return run(spark, sf_dir)

        QUERIES[name] = shipped
        if oracle:
            ORACLES[name] = oracle
        return run
    return register


def held_out(modulus: int, fold: int):
    return F.coalesce(remainder(F.col("doc_id"), modulus) == fold, F.lit(False)).alias("held_out")


LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"regexp_extract_all(" + LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATE_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce({WORDS.format('text')}, []) AS w FROM documents),
i AS (SELECT item_id, {WORDS.format('text')} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, unnest(list_transform(range(1, greatest(len(w) - 8, 2)), lambda p: w[p : p + 9])) AS win
  FROM i WHERE len(w) > 0),
sizes AS (SELECT DISTINCT len(win) AS n FROM windows),
places AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS p, w FROM d, sizes WHERE len(w) >= n),
hits AS (
  SELECT doc_id, p, places.n AS n, item_id FROM places JOIN windows ON windows.win = w[p : p + places.n - 1]),
hit_words AS (
  SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n, sha256(string_agg(item, ',' ORDER BY item)) AS h
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hit_words.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(hit_items.n, 0) AS BIGINT) AS n_items, coalesce(h, sha256('')) AS items_sha256,
  coalesce(hit_words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words ON hit_words.doc_id = d.doc_id LEFT JOIN hit_items ON hit_items.doc_id = d.doc_id
"""


LINE_SQL = r"""
WITH numbered AS (
  SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no,
    unnest(string_split(text, chr(10))) AS line FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
lines AS (
  SELECT doc_id, line_no, regexp_extract_all(line, '[^ \t\x0B\f\r]+') AS w FROM numbered
  WHERE regexp_matches(line, '[^ \t\x0B\f\r]')),
tokens AS (
  SELECT doc_id, line_no, list_distinct(list_transform(range(1, greatest(len(w) - 3, 2)), lambda p: w[p : p + 4])) AS t FROM lines),
flat AS (SELECT doc_id, line_no, len(t) AS n, unnest(t) AS token FROM tokens),
removed AS (
  SELECT DISTINCT doc_id, line_no FROM (
    SELECT y.doc_id, y.line_no, x.doc_id AS d, x.line_no AS l, count(*) AS i, any_value(x.n + y.n) AS n
    FROM flat x JOIN flat y ON x.token = y.token AND (x.doc_id < y.doc_id OR (x.doc_id = y.doc_id AND x.line_no < y.line_no))
    GROUP BY 1, 2, 3, 4) WHERE 100 * i >= 80 * (n - i))
SELECT d.doc_id, CAST(coalesce(len(string_split(any_value(text), chr(10))), 0) AS INTEGER) AS n_lines,
  CAST(count(line_no) AS INTEGER) AS n_removed, sha256(coalesce(string_agg(CAST(line_no AS VARCHAR), ',' ORDER BY line_no), '')) AS removed_sha256
FROM documents d LEFT JOIN removed r ON r.doc_id = d.doc_id GROUP BY d.doc_id
"""


@query("op1_line_dedup", LINE_SQL)
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.report_removed(table(spark, sf_dir, "documents"))
    numbers = F.array_join(F.col("removed").cast("array<string>"), ",")
    return found.select(
        "doc_id", "n_lines", F.size("removed").alias("n_removed"), F.sha2(numbers.cast("binary"), 256).alias("removed_sha256"))


@query("op2_decontaminate", DECONTAMINATE_SQL)
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda total, span: total + span["end"] - span["start"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array("hit_items"), ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"))


@query("op3_embedding_dedup")
def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.link_vectors(table(spark, sf_dir, "embeddings"))


@query("op4_ngram_join")
def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_documents(table(spark, sf_dir, "documents"))


@query("op5_token_store")
def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    store = token_store.write_store(docs)
    read = token_store.read_keys(spark, store, token_store.all_keys(docs), digest=True)
    return read.select("doc_id", "start", "n_tokens", "ids_crc32")


@query("op6_language_id")
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    profiles = language_id.learn_profiles(docs.where(remainder(F.col("doc_id"), 4) != 2))
    return language_id.identify(docs.select("doc_id", "text"), profiles).select(
        "doc_id", held_out(4, 2), "lang_pred", "score")


@query("op7_packing")
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query("op8_lm_scoring")
def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = lm.score_with_model(docs, docs.where(remainder(F.col("doc_id"), 7) != 2))
    return scored.select("doc_id", held_out(7, 2), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def labelled(spark: SparkSession, sf_dir: str, column: str) -> DataFrame:
    """Labels to learn from: those of documents outside the held-out fifth."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col(column).alias("label"))
    return labels.where(remainder(F.col("doc_id"), 5) != 0)


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn_tagger(docs, labelled(spark, sf_dir, "toxic"))
    return toxicity.score_toxicity(docs, model).select(
        "doc_id", held_out(5, 0), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op10_quality")
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.score_quality(table(spark, sf_dir, "documents"), labelled(spark, sf_dir, "quality"))
    return scored.select("doc_id", held_out(5, 0), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


#: The edits before and of a turn: from state, initials, state after, cost, lines inserted; what a turn needs and becomes.
REPAIR_SQL = r"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
kinds AS (
  SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, len(k) + 1), lambda i: ascii(k[i])::BIGINT)),
    lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))),
    4294967295) % 20 AS kind FROM keyed),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM kinds),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS p,
    left(role, 1) AS initial, NOT regexp_matches(text, '[^ \t\n\x0B\f\r]') AS is_blank,
    NOT regexp_matches(text, '[.!?][ \t\n\x0B\f\r]*$') AS is_cut FROM damaged),
seen AS (
  SELECT *, NOT is_blank AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 AS is_repeat,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY p) || initial AS pair FROM placed),
turns AS (
  SELECT *, is_blank OR is_repeat AS gone, NOT is_blank AND NOT is_repeat AND is_cut AS cut FROM seen),
counts AS (
  SELECT c.conv_id, count(p) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (WHERE is_blank) AS blank, count(*) FILTER (WHERE is_repeat) AS duplicate, count(*) FILTER (WHERE cut) AS truncated,
    count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN turns t ON t.conv_id IS NOT DISTINCT FROM c.conv_id GROUP BY c.conv_id),
put(state, inserted, target, cost, lines) AS (VALUES
  (0, '', 0, 0, []::VARCHAR[]), (0, 'I', 2, 5, ['user:']), (0, 'II', 3, 10, ['user:', 'assistant:']),
  (1, '', 1, 0, []), (1, 'I', 2, 5, ['user:']), (1, 'II', 3, 10, ['user:', 'assistant:']),
  (2, '', 2, 0, []), (2, 'I', 3, 5, ['assistant:']), (3, '', 3, 0, []), (3, 'I', 2, 5, ['user:'])),
edit(state, letter, needs, target, cost, role) AS (VALUES
  (0, 'D', '', 0, 2, ''), (1, 'D', '', 1, 2, ''), (2, 'D', '', 2, 2, ''), (3, 'D', '', 3, 2, ''),
  (0, 'K', 's', 1, 0, ''), (0, 'K', 'u', 2, 0, ''), (1, 'K', 'u', 2, 0, ''), (2, 'K', 'a', 3, 0, ''), (3, 'K', 'u', 2, 0, ''),
  (0, 'R', '', 2, 1, 'user'), (1, 'R', '', 2, 1, 'user'), (2, 'R', '', 3, 1, 'assistant'), (3, 'R', '', 2, 1, 'user')),
moves AS (
  SELECT p.state, e.target, letter, needs, role AS made, p.cost + e.cost AS cost, inserted || letter AS initials, lines
  FROM put p JOIN edit e ON e.state = p.target),
steps AS (
  SELECT conv_id, 0::BIGINT AS p, 0 AS state, {'cost': 0::BIGINT, 'audit': '', 'body': []::VARCHAR[]} AS best FROM counts
  UNION ALL
  SELECT s.conv_id, any_value(t.p), m.target, min({'cost': best.cost + m.cost + CASE WHEN cut AND letter <> 'D' THEN 5 ELSE 0 END,
    'audit': best.audit || initials, 'body': list_concat(list_concat(best.body, lines), CASE letter WHEN 'D' THEN []::VARCHAR[]
      WHEN 'K' THEN [role || ':' || text] ELSE [made || ':' || text] END)})
  FROM steps s JOIN turns t ON t.conv_id IS NOT DISTINCT FROM s.conv_id AND t.p = s.p + 1
    JOIN moves m ON m.state = s.state AND (letter = 'D' OR (NOT gone AND (letter = 'R' OR needs = initial)))
  GROUP BY s.conv_id, m.target),
whole AS (
  SELECT c.conv_id, min({'cost': best.cost + p.cost, 'audit': best.audit || inserted, 'body': list_concat(best.body, lines)}) AS best
  FROM counts c JOIN steps s ON s.conv_id IS NOT DISTINCT FROM c.conv_id AND s.p = c.n
    JOIN put p ON p.state = s.state AND (p.target = 3 OR (p.target = 0 AND inserted = '')) GROUP BY c.conv_id)
SELECT c.conv_id, CAST(gaps AS BIGINT) AS gaps, blank, duplicate, truncated, illegal, CAST(best.cost AS BIGINT) AS cost, best.audit AS audit,
  sha256(array_to_string(best.body, chr(10))) AS repaired_sha256
FROM counts c JOIN whole w ON w.conv_id IS NOT DISTINCT FROM c.conv_id
"""


def damaged(conversations):
    """Conversations with faults put in by the checksum of ``conv_id:turn``, each row with its number of copies."""
    def named(column: str):
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(named("conv_id"), F.lit(":"), named("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(named("text"), ".!?", "")).otherwise(named("text"))
    return conversations.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(named("role")).alias("role"), text.alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


@query("op11_conversation_repair", REPAIR_SQL)
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = conversation_repair.turns_of(damaged(table(spark, sf_dir, "conversations")), F.col("copies"))
    return conversation_repair.report(conversation_repair.repaired_pieces(turns))


def integer_vectors(scale: int, more: str = "", where: str = "") -> str:
    finite = "list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))"
    return (f"v AS (SELECT vec_id{more}, list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS v FROM embeddings "
            f"WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len({finite}) = 0{where})")


TOP_SQL = f"""
WITH {integer_vectors(1024)},
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scores)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 10
"""


@query("op12_exact_topk", TOP_SQL)
def op12_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10, scale=1024)


NEGATIVES_SQL = f"""
WITH {integer_vectors(256, ", CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label", " AND label IS NOT NULL")},
scores AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM v a JOIN v r ON r.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS r FROM scores WHERE same) WHERE r <= 5),
fitting AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS r
  FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT same
    AND 80 * positive_score <= 100 * score AND score <= positive_score)
SELECT anchor_id, positive_id, CAST(r AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM fitting WHERE r <= 5
"""


@query("op13_hard_negatives", NEGATIVES_SQL)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)
