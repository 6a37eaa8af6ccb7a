"""Helpers that the operators share: tables, cut lineage, connected components, vocabularies."""

from __future__ import annotations

import base64
import contextlib
import ctypes
import functools
import os
import tempfile
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words, as a character class body for Java and Python patterns.
SPACE = r"\x20\x09-\x0D"


#: Rows of an Arrow batch. A row may hold a whole text, so Spark's default of 10,000 rows is too many.
BATCH_ROWS = 1000


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package, once per application, unless PYTHONPATH names its folder already."""
    root, app = Path(__file__).resolve().parents[2], spark.sparkContext.applicationId
    if app in _shipped or str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    name = Path(tempfile.mkdtemp(prefix="llm-package-")) / "kilnmark.zip"
    with zipfile.ZipFile(name, "w") as out:
        for file in sorted((root / "kilnmark").rglob("*.py")):
            out.write(file, file.relative_to(root))
    spark.sparkContext.addPyFile(str(name))  # Spark sends it to every executor
    _shipped.add(app)


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch size to ``BATCH_ROWS`` rows; a smaller one stays. Ships the package too."""
    ship_package(spark)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for mapInArrow, giving the task's memory back at its end: workers wait idle for a minute."""
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):
                pass  # another C library: the memory stays with the worker

    return wrapped


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a local session without one gets its own."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    base = os.path.join(tempfile.gettempdir(), f"llm-shared-{os.getpid()}")
    spark.conf.set("spark.checkpoint.dir", base)
    return base


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Actions inside drop their shuffle files when they end: for plans that run once and leave a table."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def durable(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: a lost executor costs no recomputation.

    The shuffle files behind it go with the write. Without that they stay until the driver collects
    garbage, and the steps of an operator add up on disk.
    """
    path = fresh_path(df.sparkSession, label)
    with freed_shuffles(df.sparkSession):
        df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_in = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove tables that ``durable`` stored, once all that is read from them is stored itself."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_in)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def first_per_key(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The least ``value`` per key; combined before the shuffle, so a busy key costs one row per task."""
    return df.groupBy(*keys).agg(F.min(value).alias(value))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Smallest reachable id of every id that stands in an edge: columns ``id``, ``component_id``.

    Each round links every node to the least label among its neighbours and then jumps
    to that label's label (minimum-label propagation with pointer jumping on a shrinking
    edge list): edges are rewritten between labels, so long chains close in a logarithmic
    number of rounds and edges inside a finished component vanish. Rounds are cut
    with tables in the shared folder; only a count reaches the driver.
    """
    live = durable(edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
                   .where("a < b").distinct(), "edges")
    steps = []
    while not live.isEmpty():
        # Every node that has a smaller neighbour hangs itself below its least one: a forest, no cycles.
        parent = durable(live.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("up")), "parents")
        while True:  # pointer jumping until each node names its root
            above = parent.select(F.col("id").alias("up"), F.col("up").alias("top"))
            jumped = durable(parent.join(above, "up", "left")
                             .select("id", F.coalesce("top", "up").alias("up"),
                                     F.col("top").isNotNull().alias("moved")), "parents")
            done = jumped.where("moved").isEmpty()
            discard(parent)
            parent = jumped
            if done:
                break
        steps.append(parent)
        low, high = (parent.select(F.col("id").alias(c), F.col("up").alias(f"{c}_up")) for c in "ab")
        moved = (live.join(low, "a", "left").join(high, "b", "left")
                 .select(F.coalesce("a_up", "a").alias("x"), F.coalesce("b_up", "b").alias("y")))
        rest = durable(moved.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
                       .distinct(), "edges")
        discard(live)
        live = rest
    nodes = edges.select(F.explode(F.array(a, b)).alias("id")).distinct().withColumn("component_id", F.col("id"))
    for parent in steps:
        up = parent.select(F.col("id").alias("component_id"), "up")
        nodes = nodes.join(up, "component_id", "left").select("id", F.coalesce("up", "component_id").alias("component_id"))
    found = durable(nodes, "components")
    discard(live, *steps)
    return found


@functools.lru_cache(maxsize=4)
def encoding(path: str, pattern: str):
    """A byte-level encoder of a rank file; one per Python worker."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser over a uint64 array."""
    spare = x >> np.uint64(30)  # two arrays for all steps: new ones cost more than the sums
    x = x ^ spare
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= np.right_shift(x, np.uint64(27), out=spare)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= np.right_shift(x, np.uint64(31), out=spare)
    return x


def empty_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with ``columns``, which filters and projections above cannot pull apart.

    A filter that is pushed through a projection repeats the expression behind the column,
    inside lambdas even per element. A generator of one row is a border for the optimizer.
    """
    return df.drop(*columns).select("*", F.inline(F.array(F.struct(*(c.alias(k) for k, c in columns.items())))))


#: Slots of one bucket, so that a slot within it takes two bytes.
BUCKET_SLOTS = 1 << 16
#: Buckets whose bits the driver gets at once, half a megabyte at most: its heap grows by what comes in one piece.
BUCKETS_AT_ONCE = 64


def pack_slots(slots: np.ndarray) -> pa.RecordBatch:
    """Slot numbers as rows (bucket, slots): two bytes for each slot."""
    slots = np.sort(slots.astype(np.uint64))
    bucket = (slots >> np.uint64(16)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    cuts = np.append(first, len(slots))
    short = (slots & np.uint64(0xFFFF)).astype("<u2")
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[first], pa.int32()),
         pa.array([short[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())], ["bucket", "slots"])


def flag_slots(packed: DataFrame, bits: int, least: int, times_mean: float = 0.0) -> np.ndarray:
    """A packed bit for each of 2^``bits`` slots: does it stand in ``packed`` often enough?

    Often enough is ``least`` times, and more than ``times_mean`` times the mean of its
    bucket. All rows count. Buckets are cut by hash values and so are even; a task adds up
    one bucket after the other in bounded memory. The result has the same size for any
    corpus and is all that the driver gets, compressed and ``BUCKETS_AT_ONCE`` buckets at a time.
    """
    def flagged(bucket, count):
        enough = count >= max(least, times_mean * count.mean())
        return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([zlib.compress(np.packbits(enough).tobytes(), 1)], pa.binary())],
                                          ["bucket", "bits"])

    def add(batches):
        held, count = None, None  # of one bucket: few rows may put all buckets into one task
        for batch in batches:
            for bucket, data in zip(batch.column("bucket").to_pylist(), batch.column("slots").to_pylist()):
                if bucket != held:
                    if held is not None:
                        yield flagged(held, count)
                    held, count = bucket, np.zeros(BUCKET_SLOTS, np.uint32)
                slots, many = np.unique(np.frombuffer(data, "<u2"), return_counts=True)
                count[slots] += many.astype(np.uint32)
        if held is not None:
            yield flagged(held, count)

    flags = durable(packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(released(add), "bucket int, bits binary"), "flags")
    out = np.zeros((1 << (bits - 16), BUCKET_SLOTS // 8), np.uint8)
    # Few files hold all buckets, and the iterator fetches a partition as a whole.
    for row in flags.repartition(-(-len(out) // BUCKETS_AT_ONCE)).toLocalIterator():
        out[row.bucket] = np.frombuffer(zlib.decompress(row.bits), np.uint8)
    discard(flags)
    return out.reshape(-1)


def is_flagged(flags: np.ndarray, slots: np.ndarray) -> np.ndarray:
    at = slots.astype(np.int64)
    return ((flags[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).astype(bool)


#: Inputs of the rolling hashes: a value per byte, and an odd factor per position.
FACTOR = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_powers: dict[bool, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first ``n`` powers of the factor, or of its inverse, modulo 2^64."""
    if inverse not in _powers or len(_powers[inverse]) < n:
        steps = np.full(max(n, 1 << 16), _INVERSE if inverse else FACTOR)
        steps[0] = 1
        _powers[inverse] = np.multiply.accumulate(steps)
    return _powers[inverse][:n]


def running_sums(data: np.ndarray) -> np.ndarray:
    """Sums of byte value times power; a difference times the inverse power at its start is a hash of the bytes between."""
    return np.concatenate([[np.uint64(0)], np.cumsum(BYTE_VALUES[data] * powers(len(data)))])
