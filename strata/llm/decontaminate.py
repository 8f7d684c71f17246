"""Benchmark decontamination: word windows of test items found in documents by Wu-Manber search.

Nulls: a null text has no words; a null item text has no windows; a null item id counts as the
item "". Empty texts and tables give no hits. Repeated items or windows count once. Very long texts
are searched whole, in lanes. Other columns of the documents are kept unless a result has
their name.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import let_go, lists, slices, tidy

WINDOW = 10
#: Benchmark text compiled and broadcast at a time; a larger benchmark is searched in several blocks.
BLOCK_BYTES = 8_000_000
#: Positions that one lane of the search covers, and rows of the shift table.
LANE, TABLE = 192, 1 << 18

#: Lower-cases A-Z, keeps 0-9, a-z and every byte of a character beyond ASCII, blanks the rest.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

RESULT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("hit_spans", T.ArrayType(T.StructType([
        T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
    T.StructField("hit_items", T.ArrayType(T.StringType())),
])


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(WORD_BYTES).split() if text else []


class WindowTable:
    """Wu-Manber tables over word numbers for different patterns of one length.

    A block is the last two words of a window (one word for patterns of one word). The shift table says
    how far the window may move without missing a pattern that holds the block; where
    it says zero, the suffix bucket of the block lists the patterns to compare. A bucket is sorted
    by a hash of whole windows, so that one in which very many patterns end alike offers few of them.
    """

    def __init__(self, patterns: np.ndarray):
        self.length = patterns.shape[1]
        self.block = min(2, self.length)
        self.shift = np.full(TABLE, self.length - self.block + 1, np.int32)
        ids = patterns.reshape(-1)
        last = np.arange(len(patterns)) * self.length + self.length - 1
        for back in range(self.length - self.block + 1):
            np.minimum.at(self.shift, self.slot(ids, last - back), back)
        keys = self.key(ids, last)
        self.order = np.argsort(keys, kind="stable").astype(np.int32)
        self.keys, self.patterns = keys[self.order], patterns

    def slot(self, ids: np.ndarray, end: np.ndarray) -> np.ndarray:
        mixed = ids[end].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        if self.block == 2:
            mixed ^= (ids[end - 1].astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
        return (mixed >> np.uint64(40)).astype(np.int64) & (TABLE - 1)

    def key(self, ids: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Suffix bucket, then a hash of the whole window, of windows that end at ``end``."""
        mixed = np.zeros(len(end), np.uint64)
        for back in range(self.length):
            mixed = (mixed ^ ids[end - back].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        return self.slot(ids, end).astype(np.uint64) << np.uint64(46) | mixed >> np.uint64(18)

    def search(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(last position, pattern) of every occurrence in ``ids``."""
        starts = np.arange(self.length - 1, len(ids), LANE)
        ends = np.minimum(starts + LANE, len(ids))
        at, found = starts, []
        while len(at):
            step = self.shift[self.slot(ids, at)]
            if (stops := at[step == 0]).size:
                found.append(stops)
            at = at + np.maximum(step, 1)
            alive = at < ends
            at, ends = at[alive], ends[alive]
        stops = np.concatenate(found) if found else np.empty(0, np.int64)
        hits = [self.confirm(ids, stops[i:i + 20_000]) for i in range(0, len(stops), 20_000)]
        return tuple(np.concatenate(part) for part in zip(*hits)) if hits else (stops, stops)

    def confirm(self, ids: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = self.key(ids, stops)
        first = np.searchsorted(self.keys, keys)
        sizes = np.searchsorted(self.keys, keys, side="right") - first
        held = np.cumsum(sizes) - sizes
        at = np.repeat(stops, sizes)
        pattern = self.order[np.arange(len(at)) - np.repeat(held, sizes) + np.repeat(first, sizes)]
        for back in range(self.length):
            same = ids[at - back] == self.patterns[pattern, self.length - 1 - back]
            at, pattern = at[same], pattern[same]
        return at, pattern


class Matcher:
    """Windows of one block of items, compiled; kept small enough to broadcast."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int = WINDOW):
        self.number: dict[bytes, int] = {}
        self.names = sorted({item or "" for item, _ in items})
        place = {name: i for i, name in enumerate(self.names)}
        windows, owners = defaultdict(list), defaultdict(list)
        for item, text in items:
            ids = np.array([self.number.setdefault(word, len(self.number) + 1) for word in words_of(text)], np.int32)
            if size := min(window, len(ids)):
                windows[size].append(sliding_window_view(ids, size))
                owners[size].append(np.full(len(ids) - size + 1, place[item or ""], np.int32))
        self.tables, self.owners = [], []
        for size, found in windows.items():
            rows = np.ascontiguousarray(np.concatenate(found)).view(np.dtype((np.void, 4 * size))).reshape(-1)
            different, which = np.unique(rows, return_inverse=True)
            pairs = np.unique(which.astype(np.int64) * len(self.names) + np.concatenate(owners[size]))
            first = np.searchsorted(pairs, np.arange(len(different) + 1) * len(self.names))
            self.tables.append(WindowTable(different.view(np.int32).reshape(-1, size)))
            self.owners.append((first, (pairs % len(self.names)).astype(np.int32)))

    def scan(self, texts: list[str | None]) -> list[tuple[int, list[tuple[int, int]], set[str]]]:
        """Per text: number of words, hit stretches as (start, end), items found."""
        get = self.number.get
        ids: list[int] = []
        counts, starts = [], []
        for text in texts:
            found = words_of(text)
            starts.append(len(ids))
            counts.append(len(found))
            ids.extend([get(word, 0) for word in found])
            ids.append(0)
        flat, begin = np.array(ids, np.int32), np.array(starts)
        edges, named = np.zeros(len(flat) + 1, np.int32), defaultdict(set)
        for table, (first, owner) in zip(self.tables, self.owners):
            last, pattern = table.search(flat)
            np.add.at(edges, last - table.length + 1, 1)
            np.add.at(edges, last + 1, -1)
            document = np.searchsorted(begin, last, side="right") - 1
            for doc, which in np.unique(np.stack([document, pattern]), axis=1).T.tolist():
                named[doc].update(owner[first[which]:first[which + 1]].tolist())
        hit = np.flatnonzero(np.diff(np.concatenate([[0], np.cumsum(edges[:-1]) > 0, [0]]).astype(np.int8)))
        spans: dict[int, list] = defaultdict(list)
        for start, end in hit.reshape(-1, 2).tolist():
            doc = int(np.searchsorted(begin, start, side="right")) - 1
            spans[doc].append((start - starts[doc], end - starts[doc]))
        return [(counts[i], spans.get(i, []), {self.names[k] for k in named.get(i, ())}) for i in range(len(texts))]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def find_contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW,
                       block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``n_words``, ``hit_spans`` (word offsets, end exclusive) and ``hit_items``.

    ``items`` has ``item_id`` and ``text``. Items are measured first, and compiled and broadcast in
    blocks of about ``block_bytes`` of text; each block is one more narrow pass over the same
    rows, so documents are never shuffled.
    """
    spark = docs.sparkSession
    items = items.select(F.col("item_id").cast("string").alias("item"), "text").distinct()
    measured = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-measured // block_bytes))
    kept = [name for name in docs.columns if name.lower() not in {f.name for f in RESULT}]
    found = docs.select(*kept, *[F.lit(None).cast(field.dataType).alias(field.name) for field in RESULT])
    for block in range(blocks):
        chosen = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)
        tables = spark.sparkContext.broadcast(Matcher([tuple(row) for row in chosen.collect()], window))

        @tidy
        def run(batches, tables=tables):
            let_go("items")
            matcher = tables.value
            for batch in batches:
                for part in slices(batch):
                    yield searched(part, matcher)

        found = found.mapInArrow(run, found.schema)
    return found


def searched(part: pa.RecordBatch, matcher: Matcher) -> pa.RecordBatch:
    columns = {name: part.column(name) for name in part.schema.names}
    results = matcher.scan(columns["text"].to_pylist())
    before_spans, before_items = columns["hit_spans"].to_pylist(), columns["hit_items"].to_pylist()
    spans = [merged([(s["start"], s["end"]) for s in old or []] + new) for old, (_, new, _) in zip(before_spans, results)]
    items = [sorted({*(old or []), *new}) for old, (_, _, new) in zip(before_items, results)]
    flat = [span for one in spans for span in one]
    pairs = pa.StructArray.from_arrays(
        [pa.array([s for s, _ in flat], pa.int32()), pa.array([e for _, e in flat], pa.int32())], ["start", "end"])
    columns["n_words"] = pa.array([count for count, _, _ in results], pa.int64())
    columns["hit_spans"] = lists(np.cumsum([0, *map(len, spans)]), pairs)
    columns["hit_items"] = pa.array(items, pa.list_(pa.string()))
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def remove_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents, with their own columns, in which no window of any item occurs."""
    inner = docs.select(F.struct(*docs.columns).alias("row"), F.col("text").alias("text"))
    return find_contamination(inner, items, window).where(F.size("hit_items") == 0).select("row.*")
