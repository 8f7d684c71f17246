"""Token ids in binary shards, read by key through a minimal perfect hash index.

Layout below one folder: ``payload/*.bin`` holds raw little-endian ids (two bytes each while the
vocabulary allows), documents in ascending doc_id order, each closed by the end id; ``directory`` (Parquet)
names shard, file and place of every document; ``index`` (Parquet) holds the hash index in parts.

Null texts are encoded as empty ones. Null doc_ids come first and are a key like any other. Rows
that repeat a doc_id are stored one after another and told apart by ``ordinal``. An empty table gives
an empty store. Only doc_id and text are read.
"""

from __future__ import annotations

import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import documents_only, slices
from strata.llm.tokens import encoder
from strata.session import scratch_path

DOCS_PER_SHARD = 16_384
KEYS_PER_PART = 65_536

DIRECTORY = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("ordinal", T.IntegerType()),
    T.StructField("shard", T.IntegerType()),
    T.StructField("file", T.StringType()),
    T.StructField("first", T.LongType()),
    T.StructField("n_tokens", T.LongType()),
])


@dataclass(frozen=True)
class Store:
    path: str
    width: int
    parts: int


def mix(value: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit numbers."""
    value = value.astype(np.uint64)
    value = (value ^ (value >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    value = (value ^ (value >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return value ^ (value >> np.uint64(31))


def key_hash(doc_id: np.ndarray, null: np.ndarray, ordinal: np.ndarray) -> np.ndarray:
    """Distinct for distinct doc_ids of ordinal 0; other clashes are the index's to resolve."""
    step = ordinal.astype(np.uint64) * np.uint64(2) + null.astype(np.uint64)
    return mix(mix(doc_id.astype(np.int64).view(np.uint64)) + step * np.uint64(0x9E3779B97F4A7C15))


class PerfectHash:
    """Distinct 64-bit keys to 0..n-1: bit levels with ranks, about three bits a key.

    A key is placed in the first level where no other key left has its position; its number
    is the rank of that bit. Keys left after the last level (equal hashes) are listed.
    """

    GAMMA, LEVELS = 2, 24

    def __init__(self, keys: np.ndarray):
        self.bits, self.sizes = [], []
        rest = keys
        while len(rest) and len(self.sizes) < self.LEVELS:
            size = max(64, self.GAMMA * len(rest))
            at = self.place(rest, len(self.sizes), size)
            counts = np.bincount(at, minlength=size)
            self.bits.append(counts == 1)
            self.sizes.append(size)
            rest = rest[counts[at] != 1]
        self.left = np.sort(rest)
        self.ranks = np.cumsum(np.concatenate([[False], *self.bits]))
        self.starts = np.cumsum([0, *self.sizes])

    @staticmethod
    def place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys ^ np.uint64((level + 1) * 0x632BE59BD9B4E019 & (2**64 - 1))) % np.uint64(size)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of the keys; -1 for one that is in no level (a key never indexed may get any number)."""
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            at = self.place(keys[open_], level, size)
            hit = self.bits[level][at]
            out[open_[hit]] = self.ranks[self.starts[level] + at[hit]]
            open_ = open_[~hit]
        if len(open_) and len(self.left):
            slot = np.minimum(np.searchsorted(self.left, keys[open_]), len(self.left) - 1)
            known = self.left[slot] == keys[open_]
            out[open_[known]] = self.ranks[-1] + slot[known]
        return out

    def dump(self) -> bytes:
        head = np.array([len(self.sizes), len(self.left), *self.sizes], "<i8").tobytes()
        return head + self.left.astype("<u8").tobytes() + np.packbits(
            np.concatenate([np.zeros(0, bool), *self.bits])).tobytes()

    @classmethod
    def load(cls, raw: bytes) -> PerfectHash:
        self = cls.__new__(cls)
        levels, left = np.frombuffer(raw, "<i8", 2)
        self.sizes = np.frombuffer(raw, "<i8", levels, 16).tolist()
        at = 16 + 8 * int(levels)
        self.left = np.frombuffer(raw, "<u8", left, at)
        flat = np.unpackbits(np.frombuffer(raw, np.uint8, offset=at + 8 * int(left)), count=sum(self.sizes)).astype(bool)
        self.starts = np.cumsum([0, *self.sizes])
        self.bits = [flat[a:b] for a, b in zip(self.starts, self.starts[1:])]
        self.ranks = np.cumsum(np.concatenate([[False], flat]))
        return self


def key_arrays(table: pa.Table) -> np.ndarray:
    ids = table["doc_id"].combine_chunks()
    null = np.asarray(ids.is_null())
    return key_hash(np.asarray(ids.fill_null(0)), null, table["ordinal"].to_numpy())


INDEX = T.StructType([
    T.StructField("part", T.LongType()), T.StructField("n_keys", T.LongType()),
    T.StructField("hash", T.BinaryType()), T.StructField("fingerprints", T.BinaryType()),
    T.StructField("shards", T.BinaryType()), T.StructField("firsts", T.BinaryType()),
    T.StructField("lengths", T.BinaryType()),
])


def build_part(table: pa.Table) -> pa.Table:
    """Index of one part: slots in hash order with fingerprint, shard, place and length."""
    keys = key_arrays(table)
    if len(np.unique(keys)) < len(keys):
        raise ValueError("two keys have one 64-bit hash; choose another mix")
    hashed = PerfectHash(keys)
    slot = hashed(keys)
    columns = {}
    for name, values, kind in (("fingerprints", mix(keys) >> np.uint64(32), "<u4"), ("shards", table["shard"], "<u4"),
                               ("firsts", table["first"], "<u8"), ("lengths", table["n_tokens"], "<u8")):
        stored = np.empty(len(keys), kind)
        stored[slot] = np.asarray(values)
        columns[name] = [stored.tobytes()]
    return pa.table({"part": table["part"][:1], "n_keys": [len(keys)], "hash": [hashed.dump()], **columns})


FOUND = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("ordinal", T.IntegerType()),
    T.StructField("shard", T.IntegerType()), T.StructField("first", T.LongType()),
    T.StructField("n_tokens", T.LongType()),
])


def look_up(keys: pa.Table, index: pa.Table) -> pa.Table:
    """Places of the keys of one part; keys whose fingerprint differs are not in the store."""
    empty = pa.table({"doc_id": pa.array([], pa.int64()), "ordinal": pa.array([], pa.int32()), "shard": pa.array([], pa.int32()),
                      "first": pa.array([], pa.int64()), "n_tokens": pa.array([], pa.int64())})
    if not keys.num_rows or not index.num_rows:
        return empty
    row = index.to_pylist()[0]
    hashed = key_arrays(keys)
    slot = PerfectHash.load(row["hash"])(hashed)
    stored = {n: np.frombuffer(row[n], k) for n, k in (("fingerprints", "<u4"), ("shards", "<u4"), ("firsts", "<u8"), ("lengths", "<u8"))}
    safe = np.maximum(slot, 0)
    known = (slot >= 0) & (stored["fingerprints"][safe] == (mix(hashed) >> np.uint64(32)))
    safe = safe[known]
    mask = pa.array(known)
    return pa.table({
        "doc_id": keys["doc_id"].filter(mask), "ordinal": keys["ordinal"].filter(mask),
        "shard": pa.array(stored["shards"][safe].astype(np.int32)), "first": pa.array(stored["firsts"][safe].astype(np.int64)),
        "n_tokens": pa.array(stored["lengths"][safe].astype(np.int64))})


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def write_store(docs: DataFrame, path: str | None = None, tokenizer: str | None = None, end: int = 0,
                vocabulary: int = 50_257, docs_per_shard: int = DOCS_PER_SHARD) -> Store:
    """Encode ``docs`` into shards in doc_id order and index them.

    Texts are range-partitioned by doc_id once and encoded where they arrive. A task writes a file of
    its own name and reports it; the directory lists only files of tasks that ended, so a task run
    again leaves at worst an unused file.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "token-store")
    rows = documents_only(docs)
    total = rows.count()
    width = 2 if vocabulary <= 1 << 16 else 4
    shards, parts = max(1, -(-total // docs_per_shard)), max(1, -(-total // KEYS_PER_PART))
    ordered = rows.repartitionByRange(shards, "doc_id").sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))

    def run(batches):
        shard = TaskContext.get().partitionId()
        name = f"shard-{shard:07d}-{uuid.uuid4().hex}.bin"
        target, root = filesystem(f"{path}/payload")
        target.create_dir(root, recursive=True)
        encode = encoder(tokenizer, end).encode
        first, last, ordinal, out = 0, (), 0, None
        for batch in batches:
            for part in slices(batch, limit=2_000_000):
                if out is None:
                    out = target.open_output_stream(f"{root}/{name}")
                ids, starts = encode(part.column("text").to_pylist())
                out.write(ids.astype(f"<u{width}").tobytes())
                ordinals = []
                for doc in part.column("doc_id").to_pylist():
                    ordinal = ordinal + 1 if last == (doc,) else 0
                    last = (doc,)
                    ordinals.append(ordinal)
                sizes = np.diff(starts)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array(ordinals, pa.int32()), pa.array([shard] * len(sizes), pa.int32()),
                    pa.array([name] * len(sizes)), pa.array(first + starts[:-1]), pa.array(sizes)], DIRECTORY.names)
                first += int(starts[-1])
        if out is not None:
            out.close()

    ordered.mapInArrow(run, DIRECTORY).write.parquet(f"{path}/directory")
    directory = spark.read.schema(DIRECTORY).parquet(f"{path}/directory")
    keyed = directory.withColumn("part", part_of(parts))
    keyed.groupBy("part").applyInArrow(build_part, INDEX).write.parquet(f"{path}/index")
    return Store(path, width, parts)


def part_of(parts: int):
    return F.pmod(F.xxhash64("doc_id", "ordinal"), F.lit(parts).cast("long"))


def read_shards(spark: SparkSession, store: Store) -> DataFrame:
    """``shard``, its ``file``, and ``before``: the ids of all shards before it. One row a shard."""
    sums = spark.read.schema(DIRECTORY).parquet(f"{store.path}/directory").groupBy("shard", "file").agg(
        F.sum("n_tokens").alias("held"))
    upto = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("shard", "file", F.coalesce(F.sum("held").over(upto), F.lit(0)).alias("before"))


PAYLOAD = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("ordinal", T.IntegerType()),
    T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()),
])


def read_keys(spark: SparkSession, store: Store, keys: DataFrame, digest: bool = False) -> DataFrame:
    """Documents asked for by ``keys(doc_id, ordinal)``: their place among all ids, and their ids.

    ``ids`` holds little-endian 32-bit ids, or with ``digest`` only their unsigned crc32 as
    ``ids_crc32``. Every key costs one look-up in the index part it belongs to; the places found are
    sorted by shard, so files are read forward. Keys that are not stored give no row.
    """
    index = spark.read.schema(INDEX).parquet(f"{store.path}/index")
    places = keys.select("doc_id", "ordinal").withColumn("part", part_of(store.parts)).groupBy("part").cogroup(
        index.groupBy("part")).applyInArrow(look_up, FOUND)
    located = places.join(read_shards(spark, store), "shard").select(
        "doc_id", "ordinal", "shard", "file", "first", "n_tokens", (F.col("before") + F.col("first")).alias("start"))
    spread = located.repartition("shard", F.floor(F.col("first") / F.lit(1 << 22)))
    width, path = store.width, store.path
    last = T.StructField("ids_crc32", T.LongType()) if digest else PAYLOAD["ids"]
    schema = T.StructType([*PAYLOAD.fields[:-1], last])

    def run(batches):
        source, root = filesystem(f"{path}/payload")
        opened, name = None, None
        for batch in batches:
            made = []
            for row in batch.to_pylist():
                if row["file"] != name:
                    if opened:
                        opened.close()
                    name = row["file"]
                    opened = source.open_input_file(f"{root}/{name}")
                raw = opened.read_at(row["n_tokens"] * width, row["first"] * width)
                ids = np.frombuffer(raw, f"<u{width}").astype("<u4").tobytes()
                made.append((row["doc_id"], row["ordinal"], row["start"], row["n_tokens"], zlib.crc32(ids) if digest else ids))
                if not digest and len(made) == 256:
                    yield payload(made, schema)
                    made = []
            if made:
                yield payload(made, schema)
        if opened:
            opened.close()

    return spread.sortWithinPartitions("shard", "first").mapInArrow(run, schema)


def payload(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary() if schema.names[-1] == "ids" else pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], schema.names)


def all_keys(docs: DataFrame) -> DataFrame:
    """Every (doc_id, ordinal) that a store of ``docs`` has."""
    counted = docs.groupBy(F.col("doc_id").cast("long").alias("doc_id")).count()
    return counted.select("doc_id", F.explode(F.sequence(F.lit(0), (F.col("count") - 1).cast("int"))).alias("ordinal"))
