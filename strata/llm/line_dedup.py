"""Line dedup: exact set-similarity join of lines by prefix, position and length filters, in built-in expressions.

Lines are cut at line feeds; their tokens are the different runs of five words (words lie between ASCII white
space; a line of fewer words is one token). A line is removed if an earlier line, by (doc_id, line number),
of any document has a Jaccard similarity of 0.8 or more with it, whether or not that earlier one stays.

Null and empty texts have no lines; lines without words are never removed. Rows without doc_id are left as
they are. Rows that repeat a doc_id count as one document read again: they keep the same line numbers. Very
long lines are compared whole. Only doc_id and text are read.

Tokens are 64-bit numbers. They are ordered by rarity: a fixed-size table holds how frequent the tokens of each
hash bucket are over all lines; rare buckets come first, then the number decides. Any such order is exact. Equal sets are one line first. A prefix token's lines are compared with the earliest of them only;
lines that this leaves undecided are then compared with every earlier line of the token.
"""

from __future__ import annotations

import json
import math
import statistics

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import documents_only, free_name
from strata.session import written

SHINGLE, PERCENT = 5, 80
#: Buckets of the rarity table, and lines that may be broadcast (16 bytes each) to pick them out of the texts.
BUCKETS, BROADCAST_LINES = 1 << 17, 400_000
#: Neighbouring buckets that are counted side by side, in one row: a task then has few enough groups for Spark's fast table of them.
BESIDE = 4
_WHITE = " \t\x0b\f\r"
_BITS = (1 << 56) - 1
#: Bits for a line's size and a token's place in it, beside 31 for the line's number. Larger ones meet no filter before they are verified.
_N_BITS, _AT_BITS = 18, 14
_MOST_N, _MOST_AT = (1 << _N_BITS) - 1, (1 << _AT_BITS) - 1


def lines_of(docs: DataFrame) -> DataFrame:
    """``(doc_id, line_no, line)`` for lines with words."""
    cut = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(
        "doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    return cut.where(has_words(F.col("line")))


def has_words(line: Column) -> Column:
    return F.ltrim(line, F.lit(_WHITE)) != ""


def words_of(line: str) -> Column:
    """Words of a line; one without other white space than single blanks between words is cut the short way."""
    text = F.col(line)
    odd = text.contains("  ") | text.startswith(" ") | text.endswith(" ")
    for white in _WHITE[1:]:
        odd = odd | text.contains(white)  # bytes are compared; a pattern would be tried at every letter
    slow = F.split(F.btrim(text, F.lit(_WHITE)), r"[ \t\x0B\f\r]+")
    return F.when(odd, slow).otherwise(F.split(text, " "))


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda word: F.xxhash64(word))


def token_at(hashes: Column, first: Column, i: Column) -> Column:
    """Number of the token whose first word is the ``i``-th; words that are not there change no number."""
    return F.xxhash64(first, *[F.get(hashes, i + k) for k in range(1, SHINGLE)])


def first_words(hashes: str) -> Column:
    """Hashes of the words at which a token begins."""
    h = F.col(hashes)
    return F.slice(h, F.lit(1), F.greatest(F.size(h) - SHINGLE + 1, F.lit(1)))


def token_rows(lines: DataFrame) -> DataFrame:
    """A row ``token`` for every token of every line, repeated ones included: no array of them is made.

    What is exploded is an expression: of a plain column Spark would first ask the size, and so hash all words twice.
    """
    hashed = lines.select(word_hashes(words_of("line")).alias("hashes"))
    runs = hashed.select("hashes", F.posexplode(first_words("hashes")).alias("i", "first"))
    return runs.select(token_at(F.col("hashes"), F.col("first"), F.col("i")).alias("token"))


def token_numbers(hashes: str) -> Column:
    """The same numbers as an array, given the hashes of a line's words."""
    return F.transform(first_words(hashes), lambda first, i: token_at(F.col(hashes), first, i))


def rarity_levels(lines: DataFrame) -> list[int]:
    """A level for each bucket of token numbers: 0 unless its tokens are frequent in all lines, more the more frequent.

    Frequent is a bucket that stands out of the rare tokens in it by twice their standard deviation, so what
    goes unnoticed grows with the square root of the corpus only.
    """
    counts = [0] * BUCKETS
    bucket = F.col("token").bitwiseAND(F.lit(BUCKETS - 1)).cast("int")
    one = lambda k: F.when(bucket.bitwiseAND(F.lit(BESIDE - 1)) == k, F.lit(1)).otherwise(F.lit(0))
    counted = token_rows(lines).groupBy(F.shiftright(bucket, BESIDE.bit_length() - 1).alias("row")).agg(
        *[F.sum(one(k)).alias(f"n{k}") for k in range(BESIDE)])
    for row, *beside in counted.collect():
        counts[BESIDE * row:BESIDE * (row + 1)] = beside
    usual = statistics.median(counts)
    noise = usual + 2 * math.sqrt(usual) + 2
    return [min(127, int(1 + 4 * math.log2(count / noise))) if count > noise else 0 for count in counts]


def ordered_tokens(hashes: str, levels: list[int]) -> Column:
    """The different tokens of a line, given its words' hashes, as numbers that sort rarest first."""
    table = F.from_json(F.lit(json.dumps([level << 56 for level in levels])), "array<bigint>")
    level = lambda token: F.get(table, token.bitwiseAND(F.lit(BUCKETS - 1)).cast("int"))
    keys = F.transform(token_numbers(hashes), lambda token: F.coalesce(level(token), F.lit(0).cast("long")).bitwiseOR(
        token.bitwiseAND(F.lit(_BITS))))  # never null, so that they are sorted as plain numbers
    return F.sort_array(F.array_distinct(keys))


def measured_lines(lines: DataFrame, levels: list[int], *also: str) -> DataFrame:
    """``(doc_id, line_no, tokens)`` with the ordered tokens of every line, and the columns ``also``."""
    hashed = lines.select("doc_id", "line_no", *also, word_hashes(words_of("line")).alias("hashes"))
    return hashed.select("doc_id", "line_no", *also, ordered_tokens("hashes", levels).alias("tokens"))


def packed(line_no: str, n: str, at: str) -> Column:
    """A line's number, number of tokens and place of one of them in one long, in this order; sizes stop at their limits."""
    limit = lambda name, most: F.least(F.col(name).cast("long"), F.lit(most))
    return F.shiftleft(F.col(line_no).cast("long"), _N_BITS + _AT_BITS).bitwiseOR(
        F.shiftleft(limit(n, _MOST_N), _AT_BITS)).bitwiseOR(limit(at, _MOST_AT))


def unpacked(place: Column, line_no: str, n: str, at: str) -> list[Column]:
    return [F.shiftright(place, _N_BITS + _AT_BITS).cast("int").alias(line_no),
            F.shiftright(place, _AT_BITS).bitwiseAND(F.lit(_MOST_N)).cast("int").alias(n),
            place.bitwiseAND(F.lit(_MOST_AT)).cast("int").alias(at)]


def least_overlap(n: str, m: str, percent: int) -> Column:
    return F.ceil(F.lit(percent) * (F.col(n) + F.col(m)) / (100 + percent))


def close_enough(percent: int) -> Column:
    """Length and position filter for rows (n, at) and (m, place) of one token; a size at its limit passes."""
    need = least_overlap("n", "m", percent)
    rest = F.least(F.col("n") - F.col("at"), F.col("m") - F.col("place"))
    unknown = (F.greatest("n", "m") >= _MOST_N) | (F.greatest("at", "place") >= _MOST_AT)
    return unknown | ((F.least("n", "m") >= need) & (rest >= need))


def verified(pairs: DataFrame, docs: DataFrame, levels: list[int], percent: int, label: str) -> DataFrame:
    """``(doc_id, line_no)`` of the later lines among ``pairs`` whose sets are similar enough.

    Few pairs are broadcast to the sets of their later lines, which then meet the earlier ones in one exchange; a set
    goes only where its line takes part.
    """
    early, late = ["early_doc", "early_line"], ["doc_id", "line_no"]
    sides = pairs.select(*late, F.lit(True).alias("is_late")).unionByName(
        pairs.select(*[F.col(e).alias(n) for e, n in zip(early, late)], F.lit(False).alias("is_late")))
    wanted = written(sides.groupBy(*late).agg(
        F.max("is_late").alias("later"), F.max(~F.col("is_late")).alias("earlier")), f"{label}-wanted")
    few = lambda rows: F.broadcast(rows) if rows.count() <= BROADCAST_LINES else rows
    sets = written(measured_lines(lines_of(docs).join(few(wanted), late), levels, "later", "earlier"), f"{label}-sets")
    both = sets.where("later").drop("later", "earlier").join(few(pairs), late).join(
        sets.where("earlier").select(*[F.col(n).alias(e) for e, n in zip(early, late)], F.col("tokens").alias("others")), early)
    shared = F.size(F.array_intersect("tokens", "others"))
    return both.where(100 * shared >= percent * (F.size("tokens") + F.size("others") - shared)).select(*late).distinct()


def kept_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, line_no)`` of the lines that have no similar earlier line."""
    docs = documents_only(docs)
    lines = lines_of(docs)
    levels = rarity_levels(lines)
    measured = measured_lines(lines, levels)
    n = F.size("tokens")
    length = (n - F.ceil(F.lit(percent) * n / 100) + 1).cast("int")
    first = F.min(F.struct("doc_id", "line_no", "n", "prefix")).alias("first")
    different = measured.select(
        F.xxhash64("tokens").alias("a"), F.hash("tokens").alias("b"), "doc_id", "line_no", n.cast("long").alias("n"),
        F.slice("tokens", F.lit(1), length).alias("prefix")).groupBy("a", "b").agg(first).select("first.*")
    rows = different.select("doc_id", "line_no", "n", F.posexplode("prefix").alias("at", "token")).select(
        "token", "doc_id", packed("line_no", "n", "at").alias("place"))
    order = Window.partitionBy("token").orderBy("doc_id", "place")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)  # no struct here: it would be shuffled beside its parts
    rows = rows.select(
        "token", "doc_id", *unpacked(F.col("place"), "line_no", "n", "at"),
        F.first("doc_id").over(upto).alias("early_doc"), F.first("place").over(upto).alias("early_place"),
        F.row_number().over(order).alias("rank"), F.lead("doc_id").over(order).isNotNull().alias("more"))
    met = F.col("more") | (F.col("rank") > 1)
    buckets = written(rows.where((F.col("at") == 0) | met).select(
        F.when(met, F.col("token")).alias("token"), "doc_id", "line_no", "n", "at", "rank", "more",
        "early_doc", *unpacked(F.col("early_place"), "early_line", "m", "place")), "line-buckets")
    pair = ["doc_id", "line_no", "early_doc", "early_line"]
    tried = written(buckets.where((F.col("rank") > 1) & close_enough(percent)).select(*pair).distinct(), "line-star")
    removed = written(verified(tried, docs, levels, percent, "line-star"), "line-removed")
    shared = buckets.where("rank > 2 OR (rank = 2 AND more)")  # the first line was compared, two lines have no other pair
    earlier = shared.select(
        "token", F.col("doc_id").alias("early_doc"), F.col("line_no").alias("early_line"), F.col("n").alias("m"),
        F.col("at").alias("place"), F.col("rank").alias("early_rank"))
    open_ = shared.where("rank > 2").select("token", "doc_id", "line_no", "n", "at", "rank").join(
        removed, ["doc_id", "line_no"], "left_anti")
    more = open_.join(earlier, "token").where(
        (F.col("early_rank") < F.col("rank")) & close_enough(percent)).select(*pair).distinct().join(tried, pair, "left_anti")
    also = verified(written(more, "line-between"), docs, levels, percent, "line-between")
    return buckets.where("at = 0").select("doc_id", "line_no").join(
        removed.unionByName(also), ["doc_id", "line_no"], "left_anti")


def kept_by_document(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, kept)`` with the sorted numbers of the lines that stay, for documents that keep any."""
    return kept_lines(docs, percent).groupBy("doc_id").agg(F.sort_array(F.collect_list("line_no")).alias("kept"))


def numbers_with_words(text: str) -> Column:
    """Numbers of the lines of a text that have words."""
    numbered = F.transform(F.split(text, "\n", -1), lambda line, i: F.when(has_words(line), i))
    return F.filter(numbered, lambda i: i.isNotNull())


def report_removed(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_lines, removed)`` for every row of ``docs``; texts are read but not shuffled."""
    rows = documents_only(docs)
    numbered = rows.select(
        "doc_id", F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).alias("n_lines"),
        F.coalesce(numbers_with_words("text"), F.array().cast("array<int>")).alias("with_words"))
    joined = numbered.join(written(kept_by_document(rows, percent), "line-kept"), "doc_id", "left")
    kept = F.coalesce("kept", F.array().cast("array<int>"))
    removed = F.when(F.col("doc_id").isNotNull(), F.array_except("with_words", kept)).otherwise(F.array().cast("array<int>"))
    return joined.select("doc_id", "n_lines", removed.alias("removed"))


def remove_repeated_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents with the removed lines cut out of ``text`` (and ``n_chars``, if there is such a column, counted anew).

    A document that had lines with words and keeps none of them goes; others stay, those without
    words and those without doc_id as they are.
    """
    kept = written(kept_by_document(docs, percent), "line-kept")
    key, lines = free_name(docs.columns, "strata_doc"), free_name(docs.columns, "strata_kept")
    joined = docs.join(kept.select(F.col("doc_id").alias(key), F.col("kept").alias(lines)),
                       F.col("doc_id").cast("long") == F.col(key), "left")
    # By hash and by place, each a column of its own first: a text may have very many lines.
    parts, places = free_name([*docs.columns, key, lines], "strata_parts"), free_name([*docs.columns, key, lines], "strata_places")
    joined = joined.withColumn(parts, F.split("text", "\n", -1))
    gone = F.array_except(numbers_with_words("text"), F.col(lines))
    joined = joined.withColumn(places, F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), gone))
    left = F.array_join(F.transform(places, lambda i: F.get(parts, i)), "\n")
    alone = F.col("doc_id").isNull() | F.col("text").isNull() | ~F.col("text").rlike(r"[^ \t\x0B\f\r\n]")
    stay = joined.where(alone | F.col(lines).isNotNull())
    text = F.when(alone, F.col("text")).otherwise(left)
    out = stay.withColumn("text", text).select(*docs.columns)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out
