"""What several text operators share: bounded slices, row-wise Arrow passes, folds, components."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import strata
from strata.session import written

#: Text bytes handled at a time in a Python worker; a single longer text is a slice of its own.
SLICE_BYTES = 4_000_000
#: Bytes of rows that a stage of the pipeline sends to a Python worker at a time, and what Spark takes if nobody says.
BATCH_BYTES, SPARK_BATCH = 8_000_000, "67108864b"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Only a local master needs none of it: its workers share the driver's machine and path. What the driver finds, installed
    or on its path, says nothing about other machines. The registered queries and the pipeline call this; whoever
    calls an operator from elsewhere on a cluster calls it first, or has the package installed there.
    """
    home = Path(strata.__file__).resolve().parents[1]
    context = spark.sparkContext
    if context.master == "local" or context.master.startswith("local[") or context.applicationId in _SHIPPED:
        return
    archive = Path(tempfile.mkdtemp(prefix="strata-"), "strata-package.zip")  # Spark serves it from here to the executors
    with zipfile.ZipFile(archive, "w") as packed:
        for source in sorted((home / "strata").rglob("*.py")):
            packed.write(source, source.relative_to(home))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


#: What this worker process remembers from one task to the next, by owner: how to forget it.
_REMEMBERED: dict[str, Callable[[], None]] = {}


def remembers(owner: str, forget: Callable[[], None]) -> None:
    """Say how to free what ``owner`` keeps between tasks."""
    _REMEMBERED[owner] = forget


def let_go(owner: str) -> None:
    """Free what all others keep: a worker process serves one kind of pass after another, and their caches would add up."""
    for name, forget in _REMEMBERED.items():
        if name != owner:
            forget()


def give_back() -> None:
    """Hand memory that is freed but held by Arrow and by the C library back to the system, as far as they can."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def small_batches(spark: SparkSession) -> None:
    """From now on Spark hands rows to the session's Python workers in Arrow batches of about ``BATCH_BYTES``, unless the
    session names another size: a worker holds two batches and the executor builds a third beside it."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) == SPARK_BATCH:
        spark.conf.set(name, str(BATCH_BYTES))


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` for a task that gives back at its end what it no longer uses: worker processes stay when their pass is
    over, beside the joins of the next stage. Arrow takes its memory from the C library, which keeps less of what is freed."""
    @functools.wraps(run)
    def whole(batches):
        pa.set_memory_pool(pa.system_memory_pool())
        try:
            yield from run(batches)
        finally:
            give_back()
    return whole


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of the key written as text, modulo ``modulus``; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % modulus


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts have about ``limit`` bytes together."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes + 64, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(int(np.searchsorted(ends, before + limit, side="right")), start + 1)
        yield batch.slice(start, stop - start)
        start = stop


def arrow_pass(df: DataFrame, schema: T.StructType, work: Callable[[pa.RecordBatch], pa.RecordBatch | None],
               text: str = "text", setup: Callable[[], None] | None = None) -> DataFrame:
    """Rows of ``work`` for every bounded slice of ``df``, in one pass without an exchange."""
    @tidy
    def run(batches):
        if setup:
            setup()
        for batch in batches:
            for part in slices(batch, text):
                made = work(part)
                if made is not None and made.num_rows:
                    yield made
    return df.mapInArrow(run, schema)


def lists(offsets: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def documents_only(docs: DataFrame) -> DataFrame:
    """The two columns the operators read; others, whatever their names, stay out of the way."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def free_name(taken: list[str], wish: str) -> str:
    """``wish``, or a longer name if a column has it already (names ignore case)."""
    used = {name.lower() for name in taken}
    while wish.lower() in used:
        wish += "_"
    return wish


def components(links: DataFrame, label: str = "components", most_rounds: int = 60) -> DataFrame:
    """``(id, component_id)`` for every id in ``links(a, b)``; the component is its smallest id.

    Alternating star contraction: a round points every neighbour above a node, then every
    neighbour below it, at the smallest id around. A round is two aggregates with partial
    merging and two joins whose hot keys AQE can split; its result is written to the shared
    folder, so the lineage stays short and nothing but two numbers reaches the driver.
    """
    edges = written(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        f"{label}-links",
    )
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        new = written(small.where("u <> v").distinct(), label)
        old_sum, new_sum = (
            frame.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first() for frame in (edges, new))
        edges = new
        if tuple(old_sum) == tuple(new_sum):
            break
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    found = edges.select(F.col("u").alias("id"), F.col("v").alias("component_id"))
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component_id"))
    return found.unionByName(roots).distinct()
