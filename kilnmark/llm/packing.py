"""Packing by non-negative least squares over a histogram of piece lengths.

Documents are cut into full windows and a remainder. Shallow combinations of two or three
lengths that fill a window exactly are enumerated; coordinate descent solves for repeat counts
that use up the histogram, counts are rounded down, and what is left is packed greedily,
longest first. The plan depends on the histogram alone (at most ``window`` counts),
whatever the number of documents; pieces meet it by their rank among pieces of their length.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kilnmark.llm.bpe import encode_documents
from kilnmark.llm.common import released, durable, table

WINDOW, STOP_ID = 2048, 1
#: The least length of a triple is a multiple of this; the other two are free.
TRIPLE_STEP = 8
BUCKETS = 64


def combinations(window: int, step: int = TRIPLE_STEP) -> np.ndarray:
    """Lengths of two or three pieces that fill ``window`` exactly; 0 stands for no third piece."""
    pairs = [(window - b, b, 0) for b in range(1, window // 2 + 1)]
    triples = [(window - b - c, b, c) for c in range(step, window // 3 + 1, step)
               for b in range(c, (window - c) // 2 + 1)]
    return np.array(pairs + triples, dtype=np.int64).reshape(-1, 3)


def solve(histogram: np.ndarray, combos: np.ndarray, sweeps: int = 4) -> np.ndarray:
    """Repeat counts x >= 0 that bring A x close to ``histogram`` in the least-squares sense.

    Coordinate descent: each step sets one x to its best value with the others fixed,
    bounded by 0. Combinations with a length that does not occur are left at 0.
    """
    left = histogram.astype(float).tolist()
    x = np.zeros(len(combos))
    useful = np.flatnonzero(((histogram[combos] > 0) | (combos == 0)).all(axis=1))
    columns = [(int(k), [int(v) for v in combos[k] if v]) for k in useful]
    for _ in range(sweeps):
        for k, lengths in columns:
            # The entry of A is the number of times the length stands in the combination.
            many = Counter(lengths)
            best = x[k] + sum(m * left[v] for v, m in many.items()) / sum(m * m for m in many.values())
            move = max(best, 0.0) - x[k]
            if move:
                x[k] += move
                for v, m in many.items():
                    left[v] -= m * move
    return x


def plan_sequences(histogram: dict[int, int], window: int = WINDOW) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, repeats): uses every counted piece exactly once."""
    counts = np.zeros(window + 1, dtype=np.int64)
    for length, n in histogram.items():
        counts[length] += n
    plan = [((window,), int(counts[window]))] if counts[window] else []
    counts[window] = 0
    combos = combinations(window)
    x = solve(counts, combos)
    for k in np.argsort(-x, kind="stable"):
        lengths = [int(v) for v in combos[k] if v]
        repeats = int(x[k])
        if not repeats:
            break
        repeats = min(repeats, *(int(counts[v]) // m for v, m in Counter(lengths).items()))
        if repeats > 0:
            plan.append((tuple(lengths), repeats))
            for v in lengths:
                counts[v] -= repeats
    # What rounding left: longest first, filled with the longest that still fit; a filling is repeated
    # until one of its lengths runs out, so there are at most ``window`` rounds.
    while counts.any():
        room, lengths, free = window, [], counts.copy()
        while True:
            fits = np.flatnonzero(free[:room + 1])
            if not len(fits):
                break
            v = int(fits[-1])
            take = int(min(free[v], room // v))
            lengths += [v] * take
            free[v] -= take
            room -= v * take
        many = Counter(lengths)
        repeats = min(int(counts[v]) // m for v, m in many.items())
        plan.append((tuple(lengths), repeats))
        for v, m in many.items():
            counts[v] -= m * repeats
    return plan


def cut_pieces(coded: DataFrame, window: int = WINDOW, stop_id: int = STOP_ID, keep_ids: bool = False) -> DataFrame:
    """Full windows and the remainder of every document's ids with ``stop_id`` behind them."""
    fields = [coded.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in
                                        ("start", "length", "ids_crc32", "doc_tokens"))]
    if keep_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))

    def run(batches):
        for batch in batches:
            docs, lists = batch.column("doc_id"), batch.column("ids")
            at, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            row, start, length, crc, total, ids = [], [], [], [], [], []
            for k in range(batch.num_rows):
                own = np.append(flat[at[k]:at[k + 1]], stop_id).astype("<u4")
                for s in range(0, len(own), window):
                    piece = own[s:s + window]
                    row.append(k), start.append(s), length.append(len(piece)), total.append(len(own))
                    crc.append(zlib.crc32(piece.tobytes()))
                    if keep_ids:
                        ids.append(piece.astype("<i4"))
            cols = [docs.take(pa.array(row, pa.int64())), *(pa.array(v, pa.int64()) for v in (start, length, crc, total))]
            if keep_ids:
                cols.append(pa.array(ids, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(cols, [f.name for f in fields])

    return coded.select("doc_id", "ids").mapInArrow(released(run), T.StructType(fields))


def place_pieces(pieces: DataFrame, window: int = WINDOW, buckets: int = BUCKETS) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; read twice, so it should be stored.

    The rank of a piece among those of its length comes from counts per (length, bucket) and
    a number inside the bucket, so a length that a third of all pieces share is dealt out
    over the buckets. An empty table gives no rows. Repeated rows get places of their own.
    """
    spark = pieces.sparkSession
    dealt = pieces.withColumn("__b", F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)).cast("int"))
    counts = durable(dealt.groupBy("length", "__b").count(), "piece-counts")
    # At most ``window`` rows reach the driver.
    plan = plan_sequences({r.length: r.n for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}, window)
    slots, first, taken = [], 0, Counter()
    for lengths, repeats in plan:
        offset = 0
        for v in lengths:
            slots.append((v, taken[v], taken[v] + repeats, first, offset))
            taken[v] += repeats
            offset += v
        first += repeats
    places = spark.createDataFrame(slots, "length bigint, lo bigint, hi bigint, base bigint, offset bigint")
    before = Window.partitionBy("length").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select("length", "__b", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("shift"))
    own = F.row_number().over(Window.partitionBy("length", "__b").orderBy("doc_id", "start"))
    # Both lookups are bounded: window x buckets rows, and three slots per combination.
    ranked = (dealt.withColumn("rank", own - 1).join(F.broadcast(shift), ["length", "__b"])
              .withColumn("rank", F.col("rank") + F.col("shift")).drop("shift", "__b"))
    hit = (ranked["length"] == places["length"]) & (ranked["rank"] >= places["lo"]) & (ranked["rank"] < places["hi"])
    return (ranked.join(F.broadcast(places), hit).drop(places["length"])
            .withColumn("sequence_id", F.col("base") + F.col("rank") - F.col("lo"))
            .drop("rank", "lo", "hi", "base"))


def assemble(placed: DataFrame) -> DataFrame:
    """One row per sequence with its ids in order; needs pieces that kept their ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "start", "ids")))
    return (placed.groupBy("sequence_id").agg(parts.alias("parts"))
            .select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"),
                    F.transform("parts", lambda p: F.struct(p["doc_id"], p["start"], p["offset"])).alias("pieces")))


def pack_documents(docs: DataFrame, path: str, pattern: str, window: int = WINDOW, stop_id: int = STOP_ID,
                   keep_ids: bool = False) -> DataFrame:
    """Encode, cut and place all documents; null text is empty and still has its stop id.

    Extra columns are dropped. One row per piece.
    """
    coded = encode_documents(docs.select("doc_id", "text"), path, pattern)
    return place_pieces(durable(cut_pieces(coded, window, stop_id, keep_ids), "pieces"), window)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    placed = pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                            public_tokenizers.PATTERN)
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
