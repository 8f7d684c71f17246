"""Exact Jaccard join of documents on word shingles, by prefix filters under several global token orders.

A null or empty text, or one without words, has no shingles and links with nothing; a text of fewer
words than a shingle is one shingle. Rows without doc_id are returned without component. Rows that
repeat a doc_id are one node of the graph. Equal sets are one class, so copies cost nothing. Ties in an
order cannot occur but between equal tokens. Only doc_id and text are read.

How it works. A shingle is a 64-bit number. Its frequency class comes from a fixed-size sketch over all
documents, and an order sorts shingles by frequency class, then by a number of that order, so that common
passages come last; any such order is exact, whatever the sketch says. Two sets of similarity t share a
shingle among the first ``n - ceil(t n) + 1`` of each, under every order.

1. Under the first order, rows of one prefix shingle are compared with the smallest document of it only (length
   and position filter), which is linear; candidates are filtered by the other orders and verified.
2. Components of these links are formed. Pairs of one prefix shingle that are still in different
   components are then compared in tiles of bounded size, filtered and verified likewise. Pairs
   within a component need no look: no link between components is lost.

So only links that connect are found: components are exact, but neither all pairs that link nor their number are known.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import arrow_pass, components, documents_only, free_name, let_go, lists, remembers, slices, tidy
from strata.session import written

WORDS, PERCENT = 5, 80
#: Counters of the frequency sketch, and how many of them travel together.
SKETCH, CHUNK = 1 << 21, 1 << 13
#: Rows of one prefix shingle that are compared in one task; ids that may be broadcast.
TILE, BROADCAST_IDS = 2048, 1_000_000
_M = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5], np.uint64)


def mix(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    value = (value ^ (value >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return value ^ (value >> np.uint64(31))


class WordNumbers(dict):
    """64-bit numbers of words; forgotten when too many are held."""

    def __missing__(self, word: bytes) -> int:
        import xxhash
        if len(self) > 100_000:
            self.clear()
        number = xxhash.xxh64_intdigest(word)
        if len(word) <= 64:
            self[word] = number
        return number


_NUMBERS = WordNumbers()
remembers("words", _NUMBERS.clear)


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Numbers of all shingles of a whole text, repeated ones included."""
    found = text.encode().lower().split() if text else []
    if not found:
        return np.empty(0, np.uint64)
    numbers = np.fromiter(map(_NUMBERS.__getitem__, found), np.uint64, len(found))
    size = min(words, len(found))
    total = np.zeros(len(numbers) - size + 1, np.uint64)
    for i in range(size):
        total += mix(numbers[i:len(numbers) - size + 1 + i] * np.uint64(2 * size + 1)) * _M[i % 5] * np.uint64(2 * (i // 5) + 1)
    return mix(total)


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1 if n else 0


def least_overlap(n, m, percent: int):
    """Shingles that sets of these sizes must share: the smallest i with 100 i >= percent (n + m - i)."""
    return -(-percent * (n + m) // (100 + percent))


SKETCHED = T.StructType([
    T.StructField("chunk", T.IntegerType()), T.StructField("salt", T.IntegerType()), T.StructField("counts", T.BinaryType())])


def frequency_classes(docs: DataFrame, words: int) -> np.ndarray:
    """A class for each counter of the sketch: 0 for what is not frequent, more the more frequent.

    Frequent is a counter that stands out of the rare shingles that share it by twice their standard deviation, so
    what goes unnoticed grows with the square root of the corpus only. Counted over all documents; a task hands on its counters once, and they are added in two steps so
    that no step meets more than a part of the tasks.
    """
    @tidy
    def run(batches):
        let_go("words")
        counts = np.zeros(SKETCH, np.int64)
        for batch in batches:
            for part in slices(batch):
                found = [shingles(text, words) for text in part.column("text").to_pylist()]
                if found:
                    counts += np.bincount((np.concatenate(found) & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH)
        salt = TaskContext.get().partitionId() % 64
        counts = np.minimum(counts, 65_535).astype("<i4")
        pieces = [row.tobytes() for row in counts.reshape(-1, CHUNK)] if counts.any() else []
        yield pa.RecordBatch.from_arrays([
            pa.array(range(len(pieces)), pa.int32()), pa.array([salt] * len(pieces), pa.int32()), pa.array(pieces, pa.binary())],
            SKETCHED.names)

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(row, "<i4").astype(np.int64) for row in table["counts"].to_pylist())
        total = np.minimum(total, 2**31 - 1).astype("<i4")
        return pa.table([table["chunk"][:1], table["salt"][:1], pa.array([total.tobytes()], pa.binary())], SKETCHED.names)

    parts = docs.select("text").mapInArrow(run, SKETCHED)
    once = parts.groupBy("chunk", "salt").applyInArrow(add, SKETCHED)
    counts = np.zeros((SKETCH // CHUNK, CHUNK))
    for row in once.groupBy("chunk").applyInArrow(add, SKETCHED).collect():
        counts[row["chunk"]] = np.frombuffer(row["counts"], "<i4")
    usual = float(np.median(counts))
    noise = usual + 2 * np.sqrt(usual) + 2
    level = np.where(counts > noise, 1 + 4 * np.log2(np.maximum(counts, 1) / noise), 0)
    return np.minimum(level, 255).astype(np.uint8).ravel()


def ordered_prefixes(found: np.ndarray, classes: np.ndarray, percent: int) -> list[np.ndarray]:
    """The first shingles of a set under each order, as sortable numbers: class above, order number below."""
    length = prefix_length(len(found), percent)
    level = classes[(found & np.uint64(SKETCH - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(56)
    out = []
    for order in (0, 0x5851F42D4C957F2D):
        key = level | (mix(found ^ np.uint64(order)) >> np.uint64(8))
        if length < len(key):
            key = np.partition(key, length - 1)[:length]
        out.append(np.sort(key))
    return out


MEASURED = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n", T.LongType()),
    T.StructField("print_a", T.LongType()), T.StructField("print_b", T.LongType()),
    T.StructField("first", T.ArrayType(T.LongType())), T.StructField("second", T.ArrayType(T.LongType())),
])


def measure(docs: DataFrame, classes: np.ndarray, words: int, percent: int) -> DataFrame:
    """Size, fingerprint and both prefixes of every document's shingle set."""
    shared = docs.sparkSession.sparkContext.broadcast(classes)

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text in part.column("text").to_pylist():
            found = np.unique(shingles(text, words))
            with np.errstate(over="ignore"):
                prints = found.sum(), mix(found ^ np.uint64(0x1234567)).sum()
            rows.append((len(found), prints, *(ordered_prefixes(found, shared.value, percent) if len(found) else [found, found])))
        sized = lambda at: lists(
            np.cumsum([0, *[len(row[at]) for row in rows]]), pa.array(np.concatenate([row[at] for row in rows]).view(np.int64)))
        prints = np.array([row[1] for row in rows], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([
            part.column("doc_id"), pa.array([row[0] for row in rows], pa.int64()), pa.array(prints[:, 0]), pa.array(prints[:, 1]),
            sized(2), sized(3)], MEASURED.names)

    return arrow_pass(docs, MEASURED, work, setup=lambda: let_go("words"))


BUCKETS = T.StructType([
    T.StructField("token", T.LongType()), T.StructField("doc", T.LongType()), T.StructField("n", T.LongType()),
    T.StructField("at", T.LongType()), T.StructField("centre", T.LongType()), T.StructField("near", T.BooleanType())])


def star(prefixes: DataFrame, percent: int) -> DataFrame:
    """Rows of prefix shingles that two or more documents have, each beside the smallest of those documents.

    ``near`` says that length and position allow the pair. Rows stream through in order, one centre is held.
    """
    rows = prefixes.select(F.col("doc_id").alias("doc"), "n", F.posexplode("first").alias("at", "token")).select(
        "token", "doc", "n", F.col("at").cast("long").alias("at"))
    ordered = rows.repartition("token").sortWithinPartitions("token", "doc")

    @tidy
    def run(batches):
        held, shown = None, False
        for batch in batches:
            at = np.stack([column.to_numpy() for column in batch.columns])
            if held is not None:
                at = np.hstack([held, at])
            first = np.concatenate([[True], at[0, 1:] != at[0, :-1]])
            start = np.maximum.accumulate(np.where(first, np.arange(at.shape[1]), 0))
            size = np.bincount(start, minlength=at.shape[1])[start]
            keep = size > 1
            if shown:
                keep[0] = False
            centre = at[:, start]
            need = least_overlap(at[2], centre[2], percent)
            near = ~first & (1 + np.minimum(at[2] - at[3] - 1, centre[2] - centre[3] - 1) >= need)
            near &= (np.minimum(at[2], centre[2]) >= need) & (at[1] != centre[1])
            last = int(start[-1])
            shown = bool(size[-1] > 1 or (shown and last == 0))
            held = at[:, last:last + 1]
            if keep.any():
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(row[keep]) for row in at], pa.array(centre[1][keep]), pa.array(near[keep])], BUCKETS.names)

    return ordered.mapInArrow(run, BUCKETS)


PAIRS = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def between_components(buckets: DataFrame, found: DataFrame, percent: int, tile: int) -> DataFrame:
    """Candidate pairs of one prefix shingle whose documents are in different components so far."""
    placed = buckets.select("token", "doc", "n", "at").join(
        found.select(F.col("id").alias("doc"), F.col("component_id").alias("c")), "doc", "left")
    placed = placed.withColumn("c", F.coalesce("c", "doc"))
    mixed = placed.groupBy("token").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.count("*").alias("rows"))
    mixed = mixed.where("low <> high").select("token", F.ceil(F.col("rows") / tile).alias("sides"))
    rows = placed.join(mixed, "token").withColumn("side", F.pmod(F.xxhash64("doc"), F.col("sides")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("sides") - 1)))
    rows = rows.select(
        "token", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "n", "doc", "at", "c", "side")
    ordered = rows.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j", "n")

    @tidy
    def run(batches):
        held = np.empty((8, 0), np.int64)
        for batch in batches:
            at = np.hstack([held, np.stack([column.to_numpy() for column in batch.columns])])
            change = np.flatnonzero((at[:3, 1:] != at[:3, :-1]).any(axis=0)) + 1
            cut = int(change[-1]) if len(change) else 0
            held = at[:, cut:]
            if cut and (made := compared(at[:, :cut], percent)) is not None:
                yield made
        if held.shape[1] and (made := compared(held, percent)) is not None:
            yield made

    return ordered.mapInArrow(run, PAIRS).distinct()


def compared(at: np.ndarray, percent: int) -> pa.RecordBatch | None:
    """Pairs of whole groups, sorted by size: a row meets those behind it while their sizes are close enough."""
    change = np.flatnonzero((at[:3, 1:] != at[:3, :-1]).any(axis=0)) + 1
    ends = np.append(change, at.shape[1])
    end = ends[np.searchsorted(ends, np.arange(at.shape[1]), side="right")]
    n, doc, pos, comp, side = at[3:8]
    one = at[1] == at[2]
    active, found, step = np.arange(at.shape[1]), [], 1
    while True:
        active = active[active + step < end[active]]
        other = active + step
        need = least_overlap(n[active], n[other], percent)
        close = n[active] >= need
        active, other, need = active[close], other[close], need[close]
        if not len(active):
            break
        pick = (comp[active] != comp[other]) & (one[active] | (side[active] != side[other]))
        pick &= 1 + np.minimum(n[active] - pos[active] - 1, n[other] - pos[other] - 1) >= need
        if pick.any():
            a, b = doc[active[pick]], doc[other[pick]]
            found.append(np.stack([np.minimum(a, b), np.maximum(a, b)]))
        step += 1
    if not found:
        return None
    pairs = np.unique(np.hstack(found), axis=1)
    return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], PAIRS.names)


def may_link(n: int, m: int, a: list[np.ndarray], b: list[np.ndarray], percent: int) -> bool:
    """What the prefixes of all orders allow: a shared shingle under each, and not too many that the other lacks."""
    need = least_overlap(n, m, percent)
    for left, right in zip(a, b):
        shared = len(np.intersect1d(left, right, assume_unique=True))
        if not shared:
            return False
        if np.searchsorted(left, right[-1], side="right") - shared > n - need:
            return False
        if np.searchsorted(right, left[-1], side="right") - shared > m - need:
            return False
    return True


def only(rows: DataFrame, pairs: DataFrame, label: str) -> DataFrame:
    """The rows whose doc_id is in a pair; the ids are counted first and broadcast if they are few."""
    wanted = written(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), label)
    return rows.join(F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted, "doc_id", "left_semi")


def verified(pairs: DataFrame, measured: DataFrame, docs: DataFrame, words: int, percent: int, label: str) -> DataFrame:
    """The pairs that link: filtered by the prefixes of every order, then counted on the whole sets."""
    sides = lambda s: measured.select(F.col("doc_id").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("n", "first", "second")])

    @tidy
    def allowed(batches):
        for batch in batches:
            keep = []
            get = lambda name: [np.asarray(x.values).view(np.uint64) for x in batch.column(name)]
            for n, m, fa, sa, fb, sb in zip(batch.column("n_a").to_pylist(), batch.column("n_b").to_pylist(),
                                            get("first_a"), get("second_a"), get("first_b"), get("second_b")):
                keep.append(may_link(n, m, [fa, sa], [fb, sb], percent))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    measured = only(measured, pairs, f"{label}-asked")
    left = written(pairs.join(sides("a"), "a").join(sides("b"), "b").mapInArrow(allowed, PAIRS).distinct(), f"{label}-allowed")
    chosen = only(docs, left, f"{label}-wanted")

    def sets(part: pa.RecordBatch) -> pa.RecordBatch:
        found = [np.unique(shingles(text, words)).tobytes() for text in part.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found, pa.binary())], ["doc_id", "tokens"])

    whole = written(arrow_pass(chosen, T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("tokens", T.BinaryType())]), sets), f"{label}-sets")

    @tidy
    def linked(batches):
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("tokens_a"), batch.column("tokens_b")):
                x, y = (np.frombuffer(side.as_buffer(), np.uint64) for side in (a, b))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both) and both > 0)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    tokens = lambda s: whole.select(F.col("doc_id").alias(s), F.col("tokens").alias(f"tokens_{s}"))
    return left.join(tokens("a"), "a").join(tokens("b"), "b").mapInArrow(linked, PAIRS)


def join_documents(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, tile: int = TILE) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of ``docs``."""
    docs = documents_only(docs)
    measured = written(measure(docs, frequency_classes(docs, words), words, percent), "ngram-measured")
    prints = ["n", "print_a", "print_b"]
    known = measured.where("doc_id IS NOT NULL AND n > 0")
    members = known.select("doc_id", *prints)
    classes = written(members.groupBy(*prints).agg(F.min("doc_id").alias("class")), "ngram-classes")
    heads = known.join(classes.select(F.col("class").alias("doc_id")), "doc_id", "left_semi")
    buckets = written(star(heads.select("doc_id", "n", "first"), percent), "ngram-buckets")
    tried = written(buckets.where("near").select(F.col("centre").alias("a"), F.col("doc").alias("b")).distinct(), "ngram-star")
    links = written(verified(tried, measured, docs, words, percent, "ngram-star"), "ngram-links")
    first = components(links, "ngram-components")
    more = between_components(buckets, first, percent, tile).join(tried, ["a", "b"], "left_anti")
    rest = verified(written(more, "ngram-between"), measured, docs, words, percent, "ngram-between")
    same_id = members.groupBy("doc_id").agg(F.countDistinct(*prints).alias("k")).where("k > 1").select("doc_id")
    own = members.join(same_id, "doc_id").join(classes, prints).select(F.col("doc_id").alias("a"), F.col("class").alias("b"))
    found = components(links.unionByName(rest).unionByName(own), "ngram-components")
    placed = classes.join(found.select(F.col("id").alias("class"), "component_id"), "class", "left")
    placed = placed.select(*prints, F.coalesce("component_id", "class").alias("component_id"))
    return measured.select("doc_id", *prints).join(placed, prints, "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def keep_one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The documents, with their own columns, of which no smaller doc_id is in the same component.

    Documents without doc_id or shingles stay. Rows that repeat a doc_id are compared each for itself, so of those with
    a text (or shingle set) one stays, and a row of its own stays whatever the others hold; only then are
    the rows numbered in doc_id order and written first.
    """
    key = free_name(docs.columns, "strata_key")
    other = free_name([*docs.columns, key], "strata_other")
    ids = docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("rows"))
    if ids.where("rows > 1").isEmpty():
        rows = docs.withColumn(key, F.col("doc_id").cast("long"))
    else:
        number = F.when(F.col("doc_id").isNotNull(), F.monotonically_increasing_id())
        rows = written(docs.orderBy("doc_id", "text").withColumn(key, number), "ngram-rows")
    found = join_documents(rows.select(F.col(key).alias("doc_id"), "text"), words, percent)
    dropped = found.where("component_id <> doc_id").select(F.col("doc_id").alias(other))
    return rows.join(dropped, F.col(key) == F.col(other), "left_anti").drop(key)
