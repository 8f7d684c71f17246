"""Language model scores: exact unigram counts and a log-bilinear model trained by noise contrast.

Tokens are lower-cased (A-Z) words and one end token a document. Null and empty texts have the end
token alone. A null doc_id is carried along. Without training text every token is unseen (N = V = 0). Counts
cover every training token; only doc_id and text are read. Rows that repeat are scored and
counted each time.

The model's rows are all words from a count on that grows with the square root of the training tokens
(``least_count``), so the rows and the share of the tokens they cover both grow with the corpus; each is told apart as
context and as target. Rarer words share classes, whose number grows with the words counted, and have their unigram
share of the class. Rows lie in groups of equal frequency, p(row) = p(group) p(row | group), both from the vectors.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import documents_only, lists, slices
from strata.session import written

#: Words that tasks hold in memory with their counts; the rest is looked up by a join.
HEAD = 60_000
#: Least words the neural model tells apart, least classes of other words (by their last three bytes), vector size.
MODEL_WORDS, CLASSES, DIMENSIONS = 1600, 200, 24
#: Root of the training tokens for one more occurrence that a model word needs; tokens that make a training task;
#: rows of the model that are averaged together.
ROOT, TASK_TOKENS, BLOCK = 100, 500_000, 256
#: Share of the positions of every training document that a round uses (all of them), rounds, noise words a batch.
POSITIONS, ROUNDS, NOISE, BATCH = 1.0, 1, 96, 2048
END = b"\n"
_FLUSH = 150_000

WORD_COUNTS = T.StructType([T.StructField("word", T.BinaryType()), T.StructField("c", T.LongType())])


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words between ASCII white space of all texts, A-Z lower-cased, and how many each text has."""
    cut = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, ends = cut.flatten(), np.append(0, np.cumsum(pc.list_value_length(cut).to_numpy(zero_copy_only=False)))
    full = pc.greater(pc.binary_length(words), 0)  # white space at either end of a text leaves an empty word
    before = np.append(0, np.cumsum(full.to_numpy(zero_copy_only=False)))
    return (words if before[-1] == len(words) else words.filter(full)), np.diff(before[ends])


def tokens_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different tokens of all texts, the end token last, every position's place among them, and where each text starts."""
    words, sizes = words_of(texts)
    coded = words.dictionary_encode()
    names = pa.concat_arrays([coded.dictionary.cast(pa.binary()), pa.array([END], pa.binary())])
    starts = np.append(0, np.cumsum(sizes + 1))[:-1].astype(np.int64)
    codes, inside = np.full(len(words) + len(sizes), len(names) - 1), np.ones(len(words) + len(sizes), bool)
    inside[starts + sizes] = False
    codes[inside] = coded.indices.to_numpy(zero_copy_only=False)
    return names, codes, starts


def word_class(word: bytes, classes: int = CLASSES) -> int:
    return zlib.crc32(word[-3:]) % classes


def word_classes(words: pa.Array, classes: int) -> np.ndarray:
    """``word_class`` of many words."""
    coded = pc.binary_slice(words, -3).dictionary_encode()
    found = np.array([word_class(end, classes) for end in coded.dictionary.to_pylist()], np.int64)
    return found[coded.indices.to_numpy(zero_copy_only=False)]


def least_count(total: int) -> int:
    """Occurrences from which on a word has a row of its own."""
    return max(2, math.isqrt(total) // ROOT)


def count_words(docs: DataFrame) -> DataFrame:
    """``(word, c)`` over all of ``docs``, the end token as a line feed; tasks add up before the exchange."""
    def run(batches):
        held, waiting = [], 0
        for batch in batches:
            for part in slices(batch):
                names, codes, _ = tokens_of(part.column("text"))
                held.append(pa.table([names, pa.array(np.bincount(codes, minlength=len(names)), pa.int64())], WORD_COUNTS.names))
                waiting += len(names)
                if waiting > 5 * _FLUSH:
                    held = [added_up(held)]
                    waiting = held[0].num_rows
                    if waiting > 3 * _FLUSH:
                        yield from held.pop().to_batches()
                        waiting = 0
        if held:
            yield from added_up(held).to_batches()

    return documents_only(docs).mapInArrow(run, WORD_COUNTS).groupBy("word").agg(F.sum("c").alias("c"))


def added_up(counted: list[pa.Table]) -> pa.Table:
    """One row a word."""
    whole = pa.concat_tables(counted).group_by("word", use_threads=False).aggregate([("c", "sum")])
    return pa.table([whole["word"], whole["c_sum"]], WORD_COUNTS.names)


@dataclass
class Vocabulary:
    """What every task needs to know: head counts, model words, class totals, N and V."""

    head: dict[bytes, int]
    rows: dict[bytes, int]
    unigram: np.ndarray
    group: np.ndarray
    class_counts: np.ndarray
    class_types: np.ndarray
    total: int
    types: int

    @cached_property
    def listed(self) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The head words and the end token, which is no text's word, with their rows and counts, -1 where there is none."""
        words = [*self.head, *([] if END in self.head else [END])]
        rows, counts = [self.rows.get(word, -1) for word in words], [self.head.get(word, -1) for word in words]
        return pa.array(words, pa.binary()), np.array(rows, np.int64), np.array(counts, np.int64)


def learn_vocabulary(counts: DataFrame) -> Vocabulary:
    """Totals of the written ``counts``, its model words and at least its ``HEAD`` most frequent words."""
    total, types = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    modelled = max(MODEL_WORDS, counts.where(F.col("c") >= least_count(total)).count())
    top = counts.orderBy(F.desc("c"), "word").limit(max(HEAD, modelled)).collect()
    head = {bytes(row["word"]): row["c"] for row in top}
    words = list(head)[:modelled]
    if END not in words:
        words = [END, *words[:modelled - 1]]
    rows = {word: i for i, word in enumerate(words)}
    classes = max(CLASSES, math.isqrt(types))
    listed = counts.sparkSession.createDataFrame(pa.table({"word": pa.array(words, pa.binary())}))
    tail = counts.join(F.broadcast(listed), "word", "left_anti")
    grouped = tail.select(class_column(classes).alias("k"), "c")
    class_counts, class_types = np.zeros(classes), np.zeros(classes)
    for row in grouped.groupBy("k").agg(F.sum("c").alias("c"), F.count("*").alias("t")).collect():
        class_counts[row["k"]], class_types[row["k"]] = row["c"], row["t"]
    unigram = np.array([*[head.get(word, 0) for word in words], *class_counts], np.float64) + 1
    unigram /= unigram.sum()
    return Vocabulary(head, rows, unigram, frequency_groups(unigram), class_counts, class_types, total, types)


def frequency_groups(unigram: np.ndarray) -> np.ndarray:
    """The group of each row: runs of rows of about equal frequency, about the root of the rows many."""
    before = np.cumsum(unigram) - unigram
    return np.unique((before * math.isqrt(len(unigram))).astype(np.int64), return_inverse=True)[1]


def class_column(classes: int):
    """``word_class`` as an expression."""
    return (F.crc32(F.expr("substring(word, greatest(octet_length(word) - 2, 1), 3)")) % classes).cast("int")


class LogBilinear:
    """p(row | two rows before) from bilinear scores: (a * r[w1] + b * r[w2]) . q[w] + bias[w].

    The same form, with vectors of their own, tells groups; scores of rows are normalised within their group.
    """

    def __init__(self, tables: list[np.ndarray], group: np.ndarray | None = None):
        self.context, self.output, self.mixing, self.groups = tables
        self.vectors, self.bias = self.output[:, :-1], self.output[:, -1]
        self.group = np.zeros(len(self.output), np.int64) if group is None else group
        self.edges = np.searchsorted(self.group, np.arange(len(self.groups) + 1))
        #: Positions it was trained on, repeated rounds included.
        self.positions = 0

    @staticmethod
    def fresh(unigram: np.ndarray, group: np.ndarray | None = None, dimensions: int = DIMENSIONS, seed: int = 7) -> list[np.ndarray]:
        random = np.random.default_rng(seed)
        size = len(unigram)
        context = random.normal(0, 0.3, (size + 1, dimensions))
        shares = [unigram, np.ones(1) if group is None else np.bincount(group, unigram)]
        rows, groups = [np.hstack([random.normal(0, 0.05, (len(x), dimensions)), np.log(x)[:, None]]) for x in shares]
        mixing = np.array([[1.0] * dimensions, [0.7] * dimensions])
        return [table.astype(np.float32) for table in (context, rows, mixing, groups)]

    def predicted(self, near: np.ndarray, far: np.ndarray) -> np.ndarray:
        return self.mixing[0] * self.context.take(near, axis=0) + self.mixing[1] * self.context.take(far, axis=0)

    def log_probabilities(self, near: np.ndarray, far: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Normalised natural log-probabilities."""
        out = np.empty(len(rows))
        for i in range(0, len(rows), 100_000):
            cut = slice(i, i + 100_000)
            out[cut] = self._log_probabilities(near[cut], far[cut], rows[cut])
        return out

    def _log_probabilities(self, near: np.ndarray, far: np.ndarray, rows: np.ndarray) -> np.ndarray:
        size = len(self.context)
        keys, at = np.unique(near.astype(np.int64) * size + far, return_inverse=True)
        ahead = with_ones(self.predicted(keys // size, keys % size))
        whole, groups = np.empty(len(keys), np.float32), self.groups.T * BITS
        for i in range(0, len(keys), 1024):
            whole[i:i + 1024] = log_sums(ahead[i:i + 1024] @ groups)
        order = np.argsort(self.group[rows] * len(rows) + np.arange(len(rows)))  # by group, so that each is one slice
        at, rows = at[order], rows[order]
        ahead, group = ahead.take(at, axis=0), self.group[rows]
        found = np.einsum("ij,ij->i", ahead, self.groups.take(group, axis=0)) - whole[at]
        own = np.einsum("ij,ij->i", ahead, self.output.take(rows, axis=0))
        ends = np.searchsorted(group, np.arange(len(self.groups) + 1))
        for g in np.flatnonzero((np.diff(ends) > 0) & (np.diff(self.edges) > 1)):
            output = self.output[self.edges[g]:self.edges[g + 1]].T * BITS
            step = max(1, 250_000 // output.shape[1])
            for i in range(ends[g], ends[g + 1], step):
                cut = slice(i, min(i + step, ends[g + 1]))
                found[cut] += own[cut] - log_sums(ahead[cut] @ output)
        out = np.empty(len(rows))
        out[order] = found
        return out


def with_ones(vectors: np.ndarray) -> np.ndarray:
    """The vectors with a last component 1, which a bias is multiplied by."""
    out = np.ones((len(vectors), vectors.shape[1] + 1), np.float32)
    out[:, :-1] = vectors
    return out


#: Scores are multiplied by this before their exponentials are summed, as powers of two are faster.
BITS = np.float32(np.log2(np.e))


def log_sums(bits: np.ndarray) -> np.ndarray:
    """log of the sum of 2 ** x over each row; rows whose powers leave the range are shifted by their maximum."""
    ones = np.ones(bits.shape[1], bits.dtype)
    with np.errstate(over="ignore"):
        sums = np.exp2(bits) @ ones
    odd = np.flatnonzero(~((sums > 1e-25) & (sums < 1e25)))
    sums[odd] = 1
    out = np.log(sums)
    if len(odd):
        most = bits[odd].max(axis=1)
        out[odd] = most / BITS + np.log(np.exp2(bits[odd] - most[:, None]) @ ones)
    return out


def contexts(rows: np.ndarray, starts: np.ndarray, begin: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows one and two before each position; ``begin`` before the first of a document."""
    near = np.concatenate([[begin], rows[:-1]])
    far = np.concatenate([[begin, begin], rows[:-2]])[:len(rows)]
    near[starts] = begin
    far[starts] = begin
    second = starts + 1
    far[second[second < len(rows)]] = begin
    return near, far


class Reader:
    """Rows of the model's tables, and head counts, for texts."""

    def __init__(self, words: Vocabulary):
        self.classes, self.modelled = len(words.class_counts), len(words.rows)
        self.names, self.rows, self.counts = words.listed

    def look_up(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Rows of different words, a model word's or its class's, and their counts, -1 outside the head."""
        place = pc.fill_null(pc.index_in(words, value_set=self.names), -1).to_numpy(zero_copy_only=False)
        rows = np.where(place < 0, -1, self.rows[place])
        other = np.flatnonzero(rows < 0)
        rows[other] = self.modelled + word_classes(words.take(pa.array(other)), self.classes)
        return rows, np.where(place < 0, -1, self.counts[place])

    def read(self, texts: pa.Array | list[str | None]) -> tuple[tuple[pa.Array, np.ndarray, np.ndarray], np.ndarray, np.ndarray]:
        """Different tokens with their counts and every position's place among them, all rows, and where each text starts in them."""
        names, codes, starts = tokens_of(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        rows, counts = self.look_up(names)
        return (names, counts, codes), rows[codes], starts


def run_sums(rows: np.ndarray, order: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Sums of runs of rows in their order, given where each run begins; the many short ones are added row by row, all at once."""
    if 4 * len(cuts) < len(order):
        return np.add.reduceat(rows.take(order, axis=0), cuts, axis=0)
    out = rows.take(order.take(cuts), axis=0)
    sizes = np.diff(np.append(cuts, len(order)))
    for k in (1, 2):
        longer = np.flatnonzero(sizes > k)
        out[longer] += rows.take(order.take(cuts.take(longer) + k), axis=0)
    longer = np.flatnonzero(sizes > 3)
    if len(longer):
        rest = sizes.take(longer) - 3
        ends = np.cumsum(rest)
        at = np.arange(ends[-1]) + np.repeat(cuts.take(longer) + 3 - ends + rest, rest)
        out[longer] += np.add.reduceat(rows.take(order.take(at), axis=0), ends - rest, axis=0)
    return out


def products(left: np.ndarray, right: np.ndarray, step: int = 256) -> np.ndarray:
    """``left.T @ right`` for long and narrow ones, in short runs, which is faster and rounds less."""
    out = left[:step].T @ right[:step]
    for i in range(step, len(left), step):
        out += left[i:i + step].T @ right[i:i + step]
    return out


class Trainer:
    """Noise-contrastive steps (AdaGrad) on a task's own documents."""

    RATE = 0.15

    def __init__(self, tables: list[np.ndarray], unigram: np.ndarray, group: np.ndarray, seed: int):
        self.tables = [t.astype(np.float32).copy() for t in tables]
        self.grown = [np.full(t.shape, 0.1, np.float32) for t in tables]
        self.touched = [np.zeros(len(t), bool) for t in tables]
        self.group = group
        shares = {1: unigram, 3: np.bincount(group, unigram)}
        self.cumulative = {table: np.cumsum(share) for table, share in shares.items()}
        self.expected = {table: np.log(NOISE * share).astype(np.float32) for table, share in shares.items()}
        self.random = np.random.default_rng(seed)
        self.seen = 0

    def add(self, table: int, rows: np.ndarray, slope: np.ndarray) -> None:
        bits = len(rows).bit_length()
        keys = np.sort((rows << bits) + np.arange(len(rows)))
        order, ordered = keys & ((1 << bits) - 1), keys >> bits
        cuts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        where, total = ordered.take(cuts), run_sums(slope, order, cuts)
        grown = self.grown[table].take(where, axis=0) + total ** 2
        self.grown[table][where] = grown
        total *= self.RATE
        total /= np.sqrt(grown, out=grown)
        total += self.tables[table].take(where, axis=0)
        self.tables[table][where] = total
        self.touched[table][where] = True

    def tell(self, table: int, rows: np.ndarray, ahead: np.ndarray) -> np.ndarray:
        """Tell ``rows`` of an output table from ``NOISE`` of its rows drawn once for the batch; the slope of ``ahead``.

        The last component of ``ahead`` is 1. A logistic of x is half of 1 + tanh(x / 2), whose 1 is summed apart.
        """
        output, cumulative, expected = self.tables[table], self.cumulative[table], self.expected[table]
        noise = np.searchsorted(cumulative, self.random.random(NOISE) * cumulative[-1])
        noise = np.minimum(noise, len(output) - 1)
        own_rows, drawn_rows = output.take(rows, axis=0), output.take(noise, axis=0)
        score = np.einsum("ij,ij->i", ahead, own_rows) - expected.take(rows)
        miss = 1 / (1 + np.exp(np.clip(score, -30, 30)))
        halves = drawn_rows / 2
        halves[:, -1] -= expected.take(noise) / 2
        curved = ahead @ halves.T
        np.tanh(curved, out=curved)
        slope = np.empty((len(rows) + NOISE, ahead.shape[1]), np.float32)
        np.multiply(miss[:, None], ahead, out=slope[:len(rows)])
        np.multiply(products(ahead, curved).T + ahead.sum(axis=0), np.float32(-0.5), out=slope[len(rows):])
        self.add(table, np.concatenate([rows, noise]), slope)
        against = drawn_rows[:, :-1] * np.float32(-0.5)
        turn = curved @ against
        turn += against.sum(axis=0)
        turn += miss[:, None] * own_rows[:, :-1]
        return turn

    def step(self, near: np.ndarray, far: np.ndarray, rows: np.ndarray) -> None:
        """Rows are told from noise of all rows, so their scores hold within any group; groups from noise of all groups."""
        context, _, mixing, _ = self.tables
        from_near, from_far = context.take(near, axis=0), context.take(far, axis=0)
        ahead = with_ones(mixing[0] * from_near + mixing[1] * from_far)
        slope = self.tell(1, rows, ahead)
        slope += self.tell(3, self.group.take(rows), ahead)
        turn = np.stack([np.einsum("ij,ij->j", slope, from_near), np.einsum("ij,ij->j", slope, from_far)])
        both = np.empty((2 * len(rows), slope.shape[1]), np.float32)
        np.multiply(slope, mixing[0], out=both[:len(rows)])
        np.multiply(slope, mixing[1], out=both[len(rows):])
        self.add(0, np.concatenate([near, far]), both)
        self.grown[2] += turn ** 2
        self.tables[2] += 0.1 * self.RATE * turn / np.sqrt(self.grown[2])
        self.touched[2][:] = True
        self.seen += len(rows)

    def blocks(self):
        """``TRAINED`` rows of what the task changed."""
        for t, table in enumerate(self.tables):
            rows = np.flatnonzero(self.touched[t])
            for part in np.split(rows, np.flatnonzero(np.diff(rows // BLOCK)) + 1):
                if len(part):
                    yield t, int(part[0] // BLOCK), self.seen, part.astype("<i4").tobytes(), table[part].astype("<f4").tobytes()


TRAINED = T.StructType([
    T.StructField("t", T.IntegerType()), T.StructField("block", T.IntegerType()), T.StructField("n", T.LongType()),
    T.StructField("rows", T.BinaryType()), T.StructField("vectors", T.BinaryType())])
TRAINED_TYPES = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]


def averaged(block: pa.Table) -> pa.Table:
    """The mean of each row over the tasks that changed it, weighted by their positions."""
    held, total = {}, 0
    for n, rows, vectors in zip(block["n"].to_pylist(), block["rows"].to_pylist(), block["vectors"].to_pylist()):
        rows = np.frombuffer(rows, "<i4")
        vectors = np.frombuffer(vectors, "<f4").reshape(len(rows), -1)
        if not held:
            low = int(rows[0]) // BLOCK * BLOCK
            held = {"sum": np.zeros((BLOCK, vectors.shape[1])), "n": np.zeros(BLOCK)}
        held["sum"][rows - low] += n * vectors.astype(np.float64)
        held["n"][rows - low] += n
        total += n
    at = np.flatnonzero(held["n"])
    means = (held["sum"][at] / held["n"][at][:, None]).astype("<f4")
    return pa.table([
        block["t"][:1], block["block"][:1], pa.array([total], pa.int64()), pa.array([(at + low).astype("<i4").tobytes()], pa.binary()),
        pa.array([means.tobytes()], pa.binary())], TRAINED.names)


def train(docs: DataFrame, words: Vocabulary, rounds: int = ROUNDS) -> LogBilinear:
    """Rounds of local training and averaging.

    In a round every task starts from the shared tables and learns from every position of
    every document it reads; the rows that tasks changed are then averaged, weighted by positions, in blocks.
    Tasks read ``TASK_TOKENS`` tokens or more. What is averaged grows with the number of tasks, so with the corpus; what
    the driver gets is one model.
    """
    spark = docs.sparkSession
    tables, positions = LogBilinear.fresh(words.unigram, words.group), 0
    shared_words = spark.sparkContext.broadcast(words)
    for turn in range(rounds):
        start = spark.sparkContext.broadcast(tables)

        def run(batches, turn=turn, start=start):
            vocabulary = shared_words.value
            reader = Reader(vocabulary)
            trainer = Trainer(start.value, vocabulary.unigram, vocabulary.group, 11 + turn)
            begin = len(trainer.tables[1])
            for batch in batches:
                for part in slices(batch):
                    _, rows, starts = reader.read(part.column("text"))
                    near, far = contexts(rows, starts, begin)
                    used = np.flatnonzero(trainer.random.random(len(rows)) < POSITIONS)
                    trainer.random.shuffle(used)
                    for i in range(0, len(used), BATCH):
                        pick = used[i:i + BATCH]
                        trainer.step(near[pick], far[pick], rows[pick])
            made = list(trainer.blocks())
            for i in range(0, len(made), 100):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(zip(*made[i:i + 100]), TRAINED_TYPES)], TRAINED.names)

        tasks = documents_only(docs).coalesce(-(-words.total // TASK_TOKENS) or 1)
        means = tasks.mapInArrow(run, TRAINED).groupBy("t", "block").applyInArrow(averaged, TRAINED).collect()
        tables = [table.copy() for table in tables]
        for row in means:
            rows = np.frombuffer(row["rows"], "<i4")
            tables[row["t"]][rows] = np.frombuffer(row["vectors"], "<f4").reshape(len(rows), -1)
        positions += max((row["n"] for row in means if row["t"] == 2), default=0)
        start.unpersist()
    model = LogBilinear(tables, words.group)
    model.positions = positions
    return model


SCORED = T.StructType([
    T.StructField("doc_key", T.LongType()), T.StructField("doc_id", T.LongType()),
    T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
    T.StructField("base_log", T.DoubleType()), T.StructField("model_log", T.DoubleType()),
    T.StructField("rare", T.ArrayType(T.BinaryType())), T.StructField("times", T.ArrayType(T.LongType())),
])


def score_documents(docs: DataFrame, counts: DataFrame, words: Vocabulary, model: LogBilinear) -> DataFrame:
    """``(doc_id, n_tokens, n_known, train_tokens, base_score, score)`` for every document.

    One pass reads the texts, adds up everything that head counts and the model tell, and hands on
    the distinct rare words of each document; these meet their counts by key. A word outside the head is
    rare, so no key of that join is frequent, and ``counts`` has a row a word, so its partitions are hashed, not sorted.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((words, model))

    def run(batches):
        from pyspark import TaskContext
        vocabulary, field = shared.value
        reader = Reader(vocabulary)
        model_words = len(vocabulary.rows)
        begin = len(vocabulary.unigram)
        floor = np.log10(vocabulary.total + vocabulary.types + 1)
        class_floor = np.log10(vocabulary.class_counts + vocabulary.class_types + 1)
        serial = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch, limit=2_000_000):
                (names, counts, codes), rows, starts = reader.read(part.column("text"))
                near, far = contexts(rows, starts, begin)
                logs = field.log_probabilities(near, far, rows) / np.log(10)
                in_head, gain = counts >= 0, np.log10(np.maximum(counts, 0) + 1.0)
                in_head, gain = in_head[codes], np.where(in_head, gain, 0)[codes]
                other = np.flatnonzero(rows >= model_words)
                logs[other] += gain[other] - class_floor[rows[other] - model_words]
                sizes = np.diff(np.append(starts, len(rows)))
                rare = np.flatnonzero(~in_head)
                pairs, times = np.unique(np.repeat(np.arange(len(starts)), sizes)[rare] * len(names) + codes[rare], return_counts=True)
                edges = np.searchsorted(pairs, np.arange(len(starts) + 1) * len(names))
                yield pa.RecordBatch.from_arrays([
                    pa.array(serial + np.arange(len(starts)), pa.int64()), part.column("doc_id"),
                    pa.array(sizes, pa.int64()), pa.array(np.add.reduceat(in_head.astype(np.int64), starts), pa.int64()),
                    pa.array(np.add.reduceat(gain, starts) - sizes * floor, pa.float64()),
                    pa.array(np.add.reduceat(logs, starts), pa.float64()),
                    lists(edges, names.take(pa.array(pairs % len(names)))),
                    lists(edges, pa.array(times, pa.int64()))], SCORED.names)
                serial += len(starts)

    passed = written(documents_only(docs).mapInArrow(run, SCORED), "lm-pass")
    pairs = passed.select("doc_key", F.explode(F.arrays_zip("rare", "times")).alias("x")).select(
        "doc_key", F.col("x.rare").alias("word"), F.col("x.times").alias("n"))
    found = pairs.join(counts.hint("shuffle_hash"), "word").groupBy("doc_key").agg(
        F.sum("n").alias("more"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("gain"))
    joined = passed.drop("rare", "times").join(found, "doc_key", "left")
    gain = F.coalesce("gain", F.lit(0.0))
    return joined.select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(words.total).cast("long").alias("train_tokens"), (F.col("base_log") + gain).alias("base_score"),
        (F.col("model_log") + gain).alias("score"))


def score_with_model(docs: DataFrame, training: DataFrame) -> DataFrame:
    """Learn from ``training`` and score ``docs``."""
    counts = written(count_words(training), "lm-counts")
    words = learn_vocabulary(counts)
    return score_documents(docs, counts, words, train(training, words))
