"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

ROWS_PER_FILE = 100_000
BROADCAST = 10_000  # numbers that any session broadcasts
MARK_BITS = 1 << 24  # size of a bitmap of numbers at most, whatever the input
ROWS_AT_ONCE = 1_000  # of a batch, whose texts a task holds as Python objects


_written: ContextVar[list | None] = ContextVar("written", default=None)


@contextmanager
def written() -> Iterator[list[str]]:
    """The paths of the tables that ``stored`` writes meanwhile; of those within another ``written``, it has them alone."""
    paths: list[str] = []
    token = _written.set(paths)
    try:
        yield paths
    finally:
        _written.reset(token)


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables that ``stored`` has written and that nothing reads any more."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def finished(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """What ``make`` returns, ``stored``; the tables that it wrote on the way are deleted, also when it fails."""
    paths: list[str] = []
    try:
        with written() as paths:
            found = make()
        return stored(found, name)
    finally:
        discard(spark, paths)


def stored(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if (paths := _written.get()) is not None:
        paths.append(path)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bitmap_test(keys: DataFrame, column: str, n: int) -> Column:
    """Whether a bitmap of bounded size, which tasks hold, has the bit of ``column``: it has for all ``n`` numbers in the
    column of that name of ``keys``, and by chance for others. So the rest of a large table need not move to be joined with many keys.
    """
    size = min(1 << (8 * n).bit_length(), MARK_BITS)
    at = f"pmod(xxhash64({column}), {size})"
    bit = F.expr(f"shiftleft(1L, cast({at} & 63 as int))")
    words = (keys.select(F.expr(f"shiftright({at}, 6)").alias("word"), bit.alias("bits"))
             .groupBy("word").agg(F.bit_or("bits").alias("bits")))
    every = keys.sparkSession.range(max(size >> 6, 1)).select(F.col("id").alias("word")).join(words, "word", "left")
    row = every.agg(F.sort_array(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0)).alias("bits")))).alias("all"))
    bitmap = stored(row.select(F.col("all.bits").alias("bits")), "bitmap")
    return F.get(bitmap.scalar(), F.expr(f"cast(shiftright({at}, 6) as int)")).bitwiseAND(bit) != 0


def possible(df: DataFrame, column: str, keys: DataFrame, n: int) -> DataFrame:
    """The rows of ``df`` that a join with the ``n`` numbers of ``keys`` may need, so that others don't move."""
    return df.where(bitmap_test(keys, column, n)) if n > BROADCAST else df


def narrowed(df: DataFrame, rows: int, per_file: int = ROWS_PER_FILE) -> DataFrame:
    """``df`` of about ``rows`` rows in tasks that have something to do, without a shuffle."""
    return df.coalesce(8 + rows // per_file)


def dealt(df: DataFrame, rows: int, per_task: int = ROWS_PER_FILE) -> DataFrame:
    """``df`` of ``rows`` rows in tasks of about ``per_task``, at most as many as it has: up to so many rows are one
    task's, and what groups or joins them needs no exchange.
    """
    return df.coalesce(1 + rows // per_task)


def kept(df: DataFrame, name: str, per_task: int = ROWS_PER_FILE) -> tuple[DataFrame, int]:
    """``stored``, dealt by its number of rows; and that number."""
    back = stored(df, name)
    n = back.count()
    return dealt(back, n, per_task), n


def pieces(batches: Iterator[pa.RecordBatch], rows: int = ROWS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``rows`` rows, without a copy: a worker keeps the memory of its largest step."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def give_back() -> None:
    """Memory that this Python worker has freed goes back to the system: its allocators keep it, for no one else's use."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim:
        trim(0)


def lean(run: Callable) -> Callable:
    """``run`` for ``mapInArrow``, whose worker gives memory back between batches and at the end: workers are reused."""
    @wraps(run)
    def own(batches):
        def given():
            for batch in batches:
                yield batch
                del batch
                give_back()

        yield from run(given())
        give_back()

    return own


def fold(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; NULL for a NULL id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with columns c0, c1, ...: no column of the caller clashes with an operator's own."""
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of an edge list ``(a, b)`` of longs: ``(node, component)``.

    Alternating large-star and small-star steps (Kiveris et al. 2014): each
    step is one aggregate (minimum neighbour, combined before the shuffle)
    and one join; every round is written to the shared folder. Ends when every
    component is a star around its smallest node. Self loops and repeated edges
    are allowed; nodes without an edge to another node are not returned.
    """
    cur, n = kept(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .distinct(), name)
    open_nodes = _state(cur)
    while open_nodes:
        both = cur.select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # large star: neighbours above the node move to the smallest of the neighbourhood
        large = (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        # small star: the node and its smaller neighbours move to the smallest one
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))).where("a <> b"))
        cur, n = kept(dealt(small, n).distinct(), name)
        open_nodes = _state(cur)
    top = cur.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return dealt(top.unionByName(cur.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()), n)


def _state(edges: DataFrame) -> int:
    """How many nodes keep the edges from being stars.

    Edges run from ``a`` to a smaller ``b``. They are stars when every ``a`` has one edge and is no one's ``b``.
    """
    ends = edges.select(F.inline(F.array(*[F.struct(F.col(c).alias("node"), F.lit(up).alias("up")) for c, up in (("a", 1), ("b", 0))])))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.min("up").alias("least"))
    return nodes.agg(F.count_if((F.col("up") > 1) | ((F.col("up") == 1) & (F.col("least") == 0)))).first()[0]
