"""Near-duplicate embeddings by epsilon grid order: sort by grid cells, join intervals, skip distant blocks.

Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do vectors of
different lengths with each other. Rows without vec_id are returned without links or component. Equal
vectors are one vector with a count, so copies cost nothing; repeated vec_ids count as vectors each. An
empty table gives an empty result. Only vec_id and embedding are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import components
from strata.session import written

COSINE = 0.95
#: Vectors of a block, blocks of a tile's side, vectors compared at once, principal dimensions of the grid.
BLOCK, TILE, LEAF, GRID = 1024, 6, 256, 4


def usable(vector: str) -> F.Column:
    parts = F.col(vector)
    fine = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return parts.isNotNull() & fine & F.exists(parts, lambda x: x != 0)


def classes_of(vectors: DataFrame) -> DataFrame:
    """Different usable vectors: ``class_id`` (smallest vec_id), ``copies``, ``v``."""
    rows = vectors.where(F.col("vec_id").isNotNull() & usable("v"))
    return rows.groupBy("v").agg(F.min("vec_id").alias("class_id"), F.count("*").alias("copies"))


def unit(batch) -> np.ndarray:
    """Rows of the batch's vectors, scaled to length one in double precision."""
    flat = np.asarray(batch.column("v").combine_chunks().flatten() if isinstance(batch, pa.Table) else batch.column("v").flatten())
    at = flat.astype(np.float64).reshape(batch.num_rows, -1)
    at = at / np.abs(at).max(axis=1, keepdims=True)
    return at / np.sqrt((at * at).sum(axis=1, keepdims=True))


def principal(classes: DataFrame, width: int, grid: int) -> np.ndarray:
    """The leading principal directions, from sums that tasks reduce before they are added up."""
    def run(batches):
        total = np.zeros((width + 1, width + 1))
        for batch in batches:
            at = np.hstack([np.ones((batch.num_rows, 1)), unit(batch)])
            total += at.T @ at
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size), pa.int32()), pa.array(total.ravel())], ["k", "v"])

    total = np.zeros((width + 1) ** 2)
    for row in classes.select("v").mapInArrow(run, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).collect():
        total[row["k"]] = row["v"]
    total = total.reshape(width + 1, width + 1)
    count = max(total[0, 0], 1.0)
    spread = total[1:, 1:] / count - np.outer(total[0, 1:], total[0, 1:]) / count ** 2
    return np.linalg.eigh(spread)[1][:, ::-1][:, :grid]


BLOCKS = T.StructType([
    T.StructField("block", T.LongType()), T.StructField("n", T.IntegerType()),
    T.StructField("low", T.ArrayType(T.DoubleType())), T.StructField("high", T.ArrayType(T.DoubleType())),
    T.StructField("ids", T.BinaryType()), T.StructField("copies", T.BinaryType()), T.StructField("data", T.BinaryType()),
])


def blocks_of(classes: DataFrame, axes: np.ndarray, epsilon: float, block: int, total: int) -> DataFrame:
    """The vectors in epsilon grid order, cut into blocks with the box that bounds each."""
    grid = axes.shape[1]
    cells = ", ".join(f"c{i} int" for i in range(grid))
    def place(batches):
        for batch in batches:
            at = unit(batch) @ axes
            cell = np.floor(at / epsilon).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(c) for c in cell.T], pa.array(at[:, 0].copy())],
                [*batch.schema.names, *[f"c{i}" for i in range(grid)], "first"])

    kind = classes.schema["v"].dataType.simpleString()
    placed = classes.select("class_id", "copies", "v").mapInArrow(
        place, f"class_id long, copies long, v {kind}, {cells}, first double")
    order = [*[f"c{i}" for i in range(grid)], "first", "class_id"]
    ordered = placed.repartitionByRange(max(1, -(-total // (8 * block))), *order).sortWithinPartitions(*order)

    def cut(batches):
        from pyspark import TaskContext
        base, serial, held = TaskContext.get().partitionId() << 32, 0, []
        def make(table):
            at = unit(table)
            seen = at @ axes
            return pa.RecordBatch.from_arrays([
                pa.array([base + serial]), pa.array([table.num_rows], pa.int32()), pa.array([seen.min(axis=0).tolist()]),
                pa.array([seen.max(axis=0).tolist()]), pa.array([table["class_id"].to_numpy().tobytes()]),
                pa.array([table["copies"].to_numpy().tobytes()]), pa.array([at.tobytes()])], BLOCKS.names)
        rows = 0
        for batch in batches:
            held.append(batch.select(["class_id", "copies", "v"]))
            rows += batch.num_rows
            while rows >= block:
                table = pa.Table.from_batches(held)
                yield make(table.slice(0, block))
                serial += 1
                held, rows = table.slice(block).to_batches(), rows - block
        if rows:
            yield make(pa.Table.from_batches(held))

    return ordered.mapInArrow(cut, BLOCKS)


def near_boxes(blocks: DataFrame, epsilon: float) -> DataFrame:
    """Pairs of blocks (a at most b) whose boxes are within epsilon, found by the cells of the first dimension."""
    boxes = blocks.select("block", "low", "high")
    cell = lambda name: F.floor(F.col(name)[0] / epsilon)
    left = boxes.select(*[F.col(n).alias(f"a_{n}") for n in boxes.columns], F.explode(F.sequence(cell("low"), cell("high"))).alias("cell"))
    right = boxes.select(*[F.col(n).alias(f"b_{n}") for n in boxes.columns], F.explode(F.sequence(cell("low") - 1, cell("high") + 1)).alias("cell"))
    gap = F.aggregate(
        F.zip_with(F.zip_with("b_low", "a_high", lambda x, y: x - y), F.zip_with("a_low", "b_high", lambda x, y: x - y), lambda x, y: F.greatest(x, y)),
        F.lit(0.0), lambda total, g: total + F.pow(F.greatest(g, F.lit(0.0)), 2))
    pairs = left.join(right, "cell").where((F.col("a_block") <= F.col("b_block")) & (gap <= epsilon ** 2 + 1e-9))
    return pairs.select(F.col("a_block").alias("a"), F.col("b_block").alias("b")).distinct()


class Intervals:
    """Recursive join of two sorted runs of vectors, skipping runs whose boxes are too far apart."""

    def __init__(self, axes: np.ndarray, epsilon: float, cosine: float):
        self.axes, self.reach, self.cosine = axes, epsilon ** 2 + 1e-9, cosine
        self.links: dict[int, int] = {}
        self.edges: set[tuple[int, int]] = set()

    def far(self, a: np.ndarray, b: np.ndarray) -> bool:
        gap = np.maximum(np.maximum(b.min(axis=0) - a.max(axis=0), a.min(axis=0) - b.max(axis=0)), 0)
        return float(gap @ gap) > self.reach

    def join(self, a: dict, b: dict, same: bool) -> None:
        if self.far(a["seen"], b["seen"]):
            return
        n, m = len(a["ids"]), len(b["ids"])
        if n <= LEAF and m <= LEAF:
            self.leaf(a, b, same)
        elif same:
            low, high = halves(a)
            self.join(low, low, True)
            self.join(low, high, False)
            self.join(high, high, True)
        elif n >= m:
            for half in halves(a):
                self.join(half, b, False)
        else:
            for half in halves(b):
                self.join(a, half, False)

    def leaf(self, a: dict, b: dict, same: bool) -> None:
        near = a["at"] @ b["at"].T >= self.cosine
        if same:
            np.fill_diagonal(near, False)
        if not near.any():
            return
        self.count(a["ids"], near @ b["copies"])
        if not same:
            self.count(b["ids"], a["copies"] @ near)
        left, right = a["ids"].copy(), b["ids"].copy()
        far = np.iinfo(np.int64).max
        while True:  # the smallest id around, until it is the same for every linked pair
            new_right = np.minimum(right, np.where(near, left[:, None], far).min(axis=0))
            new_left = np.minimum(left, np.where(near, new_right[None, :], far).min(axis=1))
            if same:
                new_right = new_left = np.minimum(new_left, new_right)
            if (new_left == left).all() and (new_right == right).all():
                break
            left, right = new_left, new_right
        for ids, lowest in ((a["ids"], left), (b["ids"], right)):
            moved = ids != lowest
            self.edges.update(zip(ids[moved].tolist(), lowest[moved].tolist()))

    def count(self, ids: np.ndarray, more: np.ndarray) -> None:
        for i in np.flatnonzero(more):
            self.links[int(ids[i])] = self.links.get(int(ids[i]), 0) + int(more[i])


def halves(run: dict) -> list[dict]:
    middle = len(run["ids"]) // 2
    return [{k: v[s] for k, v in run.items()} for s in (slice(None, middle), slice(middle, None))]


JOINED = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def join_blocks(blocks: DataFrame, pairs: DataFrame, axes: np.ndarray, epsilon: float, cosine: float, tile: int) -> DataFrame:
    """Partial link counts ``('n', id, count)`` and connecting edges ``('e', id, smaller id)``.

    Blocks are numbered in order and their pairs dealt to square tiles, so a task holds two times
    ``tile`` blocks and a block travels once per tile and not once per pair.
    """
    numbers = blocks.select("block").withColumn("at", F.row_number().over(Window.orderBy("block")) - 1)
    at = lambda side: numbers.select(F.col("block").alias(side), F.floor(F.col("at") / tile).alias(f"t{side}"))
    dealt = written(pairs.join(at("a"), "a").join(at("b"), "b"), "ego-pairs")
    wanted = dealt.select("ta", "tb", F.explode(F.array("a", "b")).alias("block")).distinct()
    sent = wanted.join(blocks, "block").select(
        F.col("ta").alias("ua"), F.col("tb").alias("ub"), "block", "ids", "copies", "data")

    def run(key, left, right):
        if not left.num_rows:
            return empty_joined()
        runs = {}
        for row in left.to_pylist():
            ids = np.frombuffer(row["ids"], np.int64)
            data = np.frombuffer(row["data"], np.float64).reshape(len(ids), -1)
            runs[row["block"]] = {"ids": ids, "copies": np.frombuffer(row["copies"], np.int64).astype(np.float64),
                                  "at": data, "seen": data @ axes}
        work = Intervals(axes, epsilon, cosine)
        for a, b in zip(right["a"].to_pylist(), right["b"].to_pylist()):
            work.join(runs[a], runs[b], a == b)
        rows = [("n", k, v) for k, v in work.links.items()] + [("e", a, b) for a, b in work.edges]
        return pa.table([pa.array(list(c), k) for c, k in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64()))],
                        JOINED.names) if rows else empty_joined()

    return sent.groupBy("ua", "ub").cogroup(dealt.groupBy("ta", "tb")).applyInArrow(run, JOINED)


def empty_joined() -> pa.Table:
    return pa.table({"kind": pa.array([], pa.string()), "a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})


def link_vectors(vectors: DataFrame, cosine: float = COSINE, block: int = BLOCK, tile: int = TILE, grid: int = GRID) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``vectors(vec_id, embedding)``."""
    spark = vectors.sparkSession
    kind = vectors.schema["embedding"].dataType
    if not isinstance(kind.elementType, (T.FloatType, T.DoubleType)):
        vectors = vectors.withColumn("embedding", F.col("embedding").cast("array<double>"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v"))
    classes = written(classes_of(rows), "ego-classes")
    epsilon = float(np.sqrt(max(0.0, 2 - 2 * cosine))) + 1e-9
    joined = spark.createDataFrame([], JOINED)
    for width, total in classes.groupBy(F.size("v")).count().collect():
        own = classes.where(F.size("v") == width)
        axes = principal(own, width, min(grid, width))
        blocks = written(blocks_of(own, axes, epsilon, block, total), "ego-blocks")
        joined = joined.unionByName(join_blocks(blocks, near_boxes(blocks, epsilon), axes, epsilon, cosine, tile))
    joined = written(joined, "ego-joined")
    found = components(joined.where("kind = 'e'").select("a", "b"), "ego-components")
    counted = joined.where("kind = 'n'").groupBy(F.col("a").alias("class_id")).agg(F.sum("b").alias("others"))
    known = classes.join(counted, "class_id", "left").join(found.withColumnRenamed("id", "class_id"), "class_id", "left")
    known = known.select(
        "v", "class_id", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component_id", "class_id").alias("component_id"))
    good = rows.where(F.col("vec_id").isNotNull() & usable("v")).join(known, "v")
    rest = rows.where(F.col("vec_id").isNull() | ~F.coalesce(usable("v"), F.lit(False)))
    out = good.select("vec_id", "n_links", "component_id").unionByName(
        rest.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
