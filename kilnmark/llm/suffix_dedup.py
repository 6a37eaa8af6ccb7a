"""Removal of repeated byte strings by winnowing and hash equality, in place of a radix sort of suffixes.

Suffixes are told apart only through ``THRESHOLD`` bytes, in passes that begin with the coarsest
digit; after each pass what stands alone is dropped, and what is equal at the end is
exactly the repeated windows. Sorting every suffix of a corpus would move it fifty times over, so
the suffixes of a window are represented by its anchor: the position with the least hash of
``GRAM`` bytes in it. Equal windows have equal anchors at equal places. The digits are

1. the slot of the anchor's hash (28 bits), counted over all documents,
2. the whole hash of the anchor, found in two documents or more,
3. the 64-bit hashes of the windows around it, compared group by group.

The first two passes leave flags of a fixed size. They may let a lone suffix through but never hold
a repeated one back, so the result is exact unless two hashes collide.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilnmark.llm.common import (released, BYTE_VALUES, FACTOR, durable, empty_text, flag_slots, is_flagged, mix, pack_slots, powers,
                                 running_sums, table)

THRESHOLD, GRAM = 50, 24
#: Windows that can share an anchor, and the bytes that they reach over.
SPAN = THRESHOLD - GRAM + 1
CONTEXT = SPAN - 1 + THRESHOLD
SLOT_BITS = 28
#: Rows of one group that are compared in memory; larger groups are compared window by window in a shuffle.
GROUP_ROWS = 50_000
#: Rounds in which windows are shuffled and compared: each has its share of them on disk, and reads the texts once.
ROUNDS = 2


def _anchors(buffer: np.ndarray, ends: np.ndarray):
    """Anchors of all windows inside documents that lie one behind the other in ``buffer``.

    Returns document index, position, hash, and the first and last window that the anchor stands for.
    """
    none = np.zeros(0, np.int64)
    if len(buffer) < THRESHOLD:
        return none, none, none.view(np.uint64), none, none
    sums = running_sums(buffer)
    grams = sums[GRAM:] - sums[:-GRAM]
    grams *= powers(len(buffer), inverse=True)[:len(grams)]
    grams = mix(grams)
    # The least hash among SPAN neighbours, by doubling.
    least, have = grams, 1
    while have < SPAN:
        step = min(have, SPAN - have)
        least, have = np.minimum(least[:-step], least[step:]), have + step
    # An anchor, the leftmost of equal ones, gives way when the windows leave it behind or a smaller hash comes in.
    leaves = grams[:len(least)] == least
    fresh = np.ones(len(least), bool)
    np.not_equal(least[1:], least[:-1], out=fresh[1:])
    fresh[1:] |= leaves[:-1]
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(least)) - 1
    value = least[first]
    at = first + SPAN - 1  # of those that came in
    left = leaves[last]
    at[left] = last[left]
    came = np.zeros(len(first), bool)
    came[1:] = value[1:] < value[:-1]
    inner = np.flatnonzero(~left & ~came)
    at[inner] = first[inner] + (grams[first[inner][:, None] + np.arange(SPAN)] == value[inner][:, None]).argmax(axis=1)
    # A window that lies in one document lies in that of its anchor.
    doc = np.searchsorted(ends, at, side="right")
    first = np.maximum(first, np.concatenate([[0], ends[:-1]])[doc])
    last = np.minimum(last, ends[doc] - THRESHOLD)
    whole = first <= last
    return tuple(x[whole] for x in (doc, at, value, first, last))


def _slices(batches, size: int = 1 << 19):
    """(doc ids, text ids, bytes, ends) of about ``size`` bytes; a text that this task has met under a smaller id is left out."""
    seen: dict[bytes, int] = {}
    for batch in batches:
        docs, tids, texts, total = [], [], [], 0
        for doc, tid, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "tid", "text"))):
            data = text.encode()
            mark = hashlib.blake2b(data, digest_size=16).digest()
            if doc >= seen.get(mark, doc + 1):
                continue
            seen[mark] = doc
            docs.append(doc), tids.append(tid), texts.append(data)
            total += len(data)
            if total >= size:
                yield _joined(docs, tids, texts)
                docs, tids, texts, total = [], [], [], 0
        if docs:
            yield _joined(docs, tids, texts)


def _joined(docs, tids, texts):
    return np.array(docs, np.int64), np.array(tids, np.int64), np.frombuffer(b"".join(texts), np.uint8), np.cumsum(
        [len(t) for t in texts])


def _high(keys: np.ndarray) -> np.ndarray:
    return keys >> np.uint64(64 - SLOT_BITS)


def _low(keys: np.ndarray) -> np.ndarray:
    return keys & np.uint64((1 << SLOT_BITS) - 1)


def _middle(keys: np.ndarray) -> np.ndarray:
    """Bits that neither flags use; the highest ones of a least hash are mostly 0."""
    return (keys >> np.uint64(SLOT_BITS)) & np.uint64((1 << (64 - 2 * SLOT_BITS)) - 1)


def coarse_flags(docs: DataFrame) -> np.ndarray:
    """Pass 1: slots of anchor hashes that two documents or more hold."""
    def run(batches):
        held, many = [], 0
        for _, _, buffer, ends in _slices(batches):
            doc, _, keys, _, _ = _anchors(buffer, ends)
            # Once per document and slot.
            both = np.sort((doc.astype(np.uint64) << np.uint64(SLOT_BITS)) | _high(keys))
            held.append(both[np.diff(both, prepend=~both[:1]) != 0] & np.uint64((1 << SLOT_BITS) - 1))
            many += len(held[-1])
            if many > 1 << 21:
                yield pack_slots(np.concatenate(held))
                held, many = [], 0
        if many:
            yield pack_slots(np.concatenate(held))

    return flag_slots(docs.mapInArrow(released(run), "bucket int, slots binary"), SLOT_BITS, 2)


def fine_flags(docs: DataFrame, coarse: Broadcast) -> np.ndarray:
    """Pass 2: other bits of the anchor hashes that two documents or more share as a whole."""
    def run(batches):
        for ids, _, buffer, ends in _slices(batches):
            doc, _, keys, _, _ = _anchors(buffer, ends)
            hit = is_flagged(coarse.value, _high(keys))
            keys, owner = keys[hit], ids[doc[hit]]
            order = np.lexsort((owner, keys))
            keys, owner = keys[order], owner[order]
            # Least and largest document of each key here: a row or two instead of one for each document.
            first = np.concatenate([[True], keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, bool)
            start = np.flatnonzero(first)
            stop = np.append(start[1:], len(keys)) - 1 if len(start) else start
            yield pa.RecordBatch.from_arrays([pa.array(keys[start].view(np.int64)), pa.array(owner[start]), pa.array(owner[stop])],
                                             ["key", "lo", "hi"])

    def pack(batches):
        held, many = [], 0  # long runs, so that a row of a bucket holds many slots
        for batch in batches:
            held.append(_low(batch.column("key").to_numpy().view(np.uint64)))
            many += len(held[-1])
            if many > 1 << 21:
                yield pack_slots(np.concatenate(held))
                held, many = [], 0
        if many:
            yield pack_slots(np.concatenate(held))

    keys = (docs.mapInArrow(released(run), "key long, lo long, hi long").groupBy("key").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
            .where("lo < hi").select("key"))
    return flag_slots(keys.mapInArrow(released(pack), "bucket int, slots binary"), SLOT_BITS, 1)


#: Which bytes of a context belong to the windows from o1 to o2.
_INSIDE = ((np.arange(CONTEXT) >= np.arange(SPAN)[:, None, None])
           & (np.arange(CONTEXT) < np.arange(SPAN)[None, :, None] + THRESHOLD)).astype(np.uint8)


def _digests(keys: np.ndarray, o1: np.ndarray, o2: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each anchor with its context."""
    words = matrix.view("<u4").astype(np.uint64)
    words *= FACTOR
    words ^= words >> np.uint64(32)
    words *= powers(words.shape[1] + 1)[1:]
    return mix(words.sum(axis=1, dtype=np.uint64) + mix(keys + (o1 * 64 + o2).astype(np.uint64)))


def _repeats(doc: np.ndarray, digest: np.ndarray) -> np.ndarray:
    """Which rows have the digest of a row of a smaller document."""
    order = np.lexsort((doc, digest))
    digest, doc = digest[order], doc[order]
    first = np.ones(len(order), bool)
    first[1:] = digest[1:] != digest[:-1]
    out = np.zeros(len(order), bool)
    out[order] = doc > doc[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))] if len(order) else False
    return out


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of a byte matrix as a binary column."""
    offsets = np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(rows.tobytes())])


_ROWS = "key long, doc long, tid long, at long, o1 int, o2 int, context binary"


def contexts(docs: DataFrame, one: Broadcast, two: Broadcast, turn: int = 0, rounds: int = 1) -> DataFrame:
    """Anchors that passed the coarse flags (one) and the fine ones (two), with the bytes of their windows.

    Of ``rounds`` shares of the hashes, the one of number ``turn``: all anchors of a hash come in the same round.

    Where equal contexts meet within a task's batch, only the least document goes on; for the others it
    is settled that they repeat it: rows with o1 = -1 carry such a stretch (at, length o2).
    """
    def run(batches):
        for ids, tids, buffer, ends in _slices(batches):
            doc, at, keys, w1, w2 = _anchors(buffer, ends)
            hit = is_flagged(one.value, _high(keys)) & is_flagged(two.value, _low(keys)) & (_middle(keys) % np.uint64(rounds) == turn)
            doc, at, keys, w1, w2 = (x[hit] for x in (doc, at, keys, w1, w2))
            begin = np.concatenate([[0], ends[:-1]])[doc]
            o1, o2 = w1 - (at - SPAN + 1), w2 - (at - SPAN + 1)
            padded = np.concatenate([np.zeros(SPAN, np.uint8), buffer, np.zeros(CONTEXT, np.uint8)])
            matrix = np.lib.stride_tricks.sliding_window_view(padded, CONTEXT)[at + 1] * _INSIDE[o1, o2]
            owner = ids[doc]
            done = _repeats(owner, _digests(keys, o1, o2, matrix))
            go = ~done
            tid = tids[doc]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[go].view(np.int64)), pa.array(owner[go]), pa.array(tid[go]), pa.array((at - begin)[go]),
                 pa.array(o1[go].astype(np.int32)), pa.array(o2[go].astype(np.int32)), _binary(matrix[go])],
                ["key", "doc", "tid", "at", "o1", "o2", "context"])
            n = int(done.sum())
            yield pa.RecordBatch.from_arrays(
                [pa.array(mix(owner[done].view(np.uint64) + at[done].astype(np.uint64)).view(np.int64)), pa.array(owner[done]),
                 pa.array(tid[done]), pa.array((w1 - begin)[done]), pa.array(np.full(n, -1, np.int32)),
                 pa.array((w2 - w1 + THRESHOLD)[done].astype(np.int32)), pa.array([b""] * n, pa.binary())],
                ["key", "doc", "tid", "at", "o1", "o2", "context"])

    return docs.mapInArrow(released(run), _ROWS)


def _windows(keys, at, o1, o2, matrix):
    """Row, hash and start of every window that the rows stand for."""
    sums = np.zeros((len(matrix), CONTEXT + 1), np.uint64)
    np.cumsum(BYTE_VALUES[matrix] * powers(CONTEXT), axis=1, out=sums[:, 1:])
    hashes = mix((sums[:, THRESHOLD:] - sums[:, :SPAN]) * powers(SPAN, inverse=True) + keys[:, None])
    offset = np.arange(SPAN)
    row, o = np.nonzero((offset >= o1[:, None]) & (offset <= o2[:, None]))
    return row, hashes[row, o], at[row] - SPAN + 1 + o


def compare(rows: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Pass 3: (h, doc, tid, start, end) of the stretches that a smaller document holds too.

    Groups of more than ``group_rows`` rows leave their windows as they are, with the hash h for a
    later shuffle; elsewhere h is null.
    """
    def emit(doc, tid, start, end, h=None):
        return pa.RecordBatch.from_arrays(
            [pa.nulls(len(doc), pa.int64()) if h is None else pa.array(h.view(np.int64)), pa.array(doc), pa.array(tid),
             pa.array(start), pa.array(end)], ["h", "doc", "tid", "start", "end"])

    def whole(done, key, doc, tid, at, o1, o2, matrix):
        """Of equal contexts only the least document's goes on; the others repeat all of it."""
        start = at[done] - SPAN + 1
        return emit(doc[done], tid[done], start + o1[done], start + o2[done] + THRESHOLD)

    def settle(*rows):
        key, doc, tid, at, o1, o2, matrix = rows
        done = _repeats(doc, _digests(key, o1, o2, matrix))
        yield whole(done, *rows)
        key = key[~done]
        # An anchor that is left alone has nobody to share a window with.
        shared = np.zeros(len(key), bool)
        shared[1:] |= key[1:] == key[:-1]
        shared[:-1] |= key[1:] == key[:-1]
        key, doc, tid, at, o1, o2, matrix = (x[~done][shared] for x in rows)
        if len(key) == 0:
            return
        row, h, start = _windows(key, at, o1, o2, matrix)
        order = np.lexsort((doc[row], h))
        row, h, start = row[order], h[order], start[order]
        first = np.concatenate([[True], h[1:] != h[:-1]])
        least = doc[row][np.maximum.accumulate(np.where(first, np.arange(len(h)), 0))]
        hit = doc[row] > least
        row, start = row[hit], start[hit]
        # Windows of one anchor overlap, so what is hit is one stretch.
        low, high = np.full(len(key), np.iinfo(np.int64).max), np.full(len(key), -1)
        np.minimum.at(low, row, start), np.maximum.at(high, row, start)
        some = high >= 0
        yield emit(doc[some], tid[some], low[some], high[some] + THRESHOLD)

    def leave(*rows):
        key, doc, tid, at, o1, o2, matrix = rows
        done = _repeats(doc, _digests(key, o1, o2, matrix))
        yield whole(done, *rows)
        key, doc, tid, at, o1, o2, matrix = (x[~done] for x in rows)
        row, h, start = _windows(key, at, o1, o2, matrix)
        yield emit(doc[row], tid[row], start, start + THRESHOLD, h)

    def run(batches):
        held, open_key = None, None  # open_key: a group that has grown too large
        for batch in batches:
            for k in range(0, batch.num_rows, 4096):
                part = batch.slice(k, 4096)
                cols = [part.column(c).to_numpy() for c in ("key", "doc", "tid", "at", "o1", "o2")]
                ready = cols[4] == -1
                if ready.any():
                    yield emit(*(cols[c][ready] for c in (1, 2, 3)), cols[3][ready] + cols[5][ready])
                todo = np.flatnonzero(~ready)
                if not len(todo):
                    continue
                data = part.column("context").take(pa.array(todo)).combine_chunks() if hasattr(part.column("context"), "chunks") \
                    else part.column("context").take(pa.array(todo))
                matrix = np.frombuffer(data.buffers()[2], np.uint8)[:len(todo) * CONTEXT].reshape(-1, CONTEXT)
                now = [c[todo] for c in cols] + [matrix]
                now[0] = now[0].view(np.uint64)
                if held is not None:
                    now = [np.concatenate([a, b]) for a, b in zip(held, now)]
                change = np.flatnonzero(now[0] != now[0][-1])
                cut = change[-1] + 1 if len(change) else 0  # the last key may go on
                ready, held = [x[:cut] for x in now], [x[cut:] for x in now]
                if open_key is not None and len(ready[0]):
                    old = ready[0] == open_key
                    if old.any():
                        yield from leave(*(x[old] for x in ready))
                        ready = [x[~old] for x in ready]
                    if held[0][0] != open_key:
                        open_key = None
                yield from settle(*ready)
                if len(held[0]) > group_rows or (open_key is not None and held[0][0] == open_key):
                    open_key = held[0][0]
                    yield from leave(*held)
                    held = None
        if held is not None:
            if open_key is not None and held[0][0] == open_key:
                yield from leave(*held)
            else:
                yield from settle(*held)

    sorted_rows = rows.repartition("key").sortWithinPartitions("key")
    return sorted_rows.mapInArrow(released(run), "h long, doc long, tid long, start long, end long")


def repeated_stretches(docs: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(doc, tid, spans): stretches of each text, as arrays of (start, end), that a smaller document holds."""
    usable = docs.where("doc_id is not null").where(F.octet_length("text") >= THRESHOLD)
    sc = docs.sparkSession.sparkContext
    # Each goes out once, and the driver keeps no copy of its own.
    one = sc.broadcast(coarse_flags(usable))
    two = sc.broadcast(fine_flags(usable, one))
    # Round by round: the contexts of a round are on disk while they are compared, and gone when its result is stored.
    found = None
    for turn in range(ROUNDS):
        some = durable(compare(contexts(usable, one, two, turn, ROUNDS), group_rows), "repeats")
        found = some if found is None else found.unionByName(some)
    one.destroy(), two.destroy()
    left = found.where("h is not null")
    least = left.groupBy("h").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most").select("h", "least")
    late = left.join(least, "h").where("doc > least").select("doc", "tid", "start", "end")
    every = found.where("h is null").select("doc", "tid", "start", "end").union(late)
    return every.groupBy("doc", "tid").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def _merged(removed: pa.Array, sizes: np.ndarray) -> list[list[tuple[int, int]]]:
    """The maximal runs of each row's spans, in order; ``sizes`` are the bytes of the rows' texts."""
    if isinstance(removed, pa.ChunkedArray):
        removed = removed.combine_chunks()
    many = removed.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    spans = removed.flatten()
    doc = np.repeat(np.arange(len(many)), many)
    base = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]  # all texts one behind the other, with a gap between them
    start, end = (spans.field(c).to_numpy(zero_copy_only=False) + base[doc] for c in ("start", "end"))
    order = np.argsort(start)
    start, end, doc = start[order], np.maximum.accumulate(end[order]), doc[order]
    first = np.ones(len(start), bool)
    first[1:] = start[1:] > end[:-1]
    at = np.flatnonzero(first)
    owner = doc[at]
    out = list(zip((start[at] - base[owner]).tolist(), (end[np.append(at[1:], len(start)) - 1] - base[owner]).tolist())) if len(at) else []
    cuts = np.searchsorted(owner, np.arange(len(many) + 1)).tolist()
    return [out[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def dedup(docs: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Every row of ``docs`` with ``removed`` (array of (start, end) in bytes, in any order; they may overlap).

    A null text is empty. Rows with a null doc_id lose nothing and take nothing from others. Rows
    that repeat a doc_id take nothing from each other. Of equal texts, all but those of the
    least doc_id are removed as a whole if they reach the threshold; that needs their digests only.
    All other columns stay as they are; only one named ``removed`` is replaced. An empty table gives no row.
    """
    known = (docs.withColumn("text", empty_text()).withColumn("__tid", F.xxhash64("text"))
             .withColumn("__digest", F.md5(F.col("text").cast("binary"))))
    spans = repeated_stretches(known.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("__tid").alias("tid"), "text"), group_rows)
    # Copies need only their id and digest here; groups of one stay out of the lookup.
    copies = (known.where("doc_id is not null").where(F.octet_length("text") >= THRESHOLD)
              .groupBy("__digest").agg(F.min("doc_id").alias("__least"), F.max("doc_id").alias("__most")).where("__least < __most"))
    late = durable(known.select("doc_id", F.col("__tid").alias("tid"), "__digest").join(copies.select("__digest", "__least"), "__digest")
                   .where("doc_id > __least").select("doc_id", "tid").distinct(), "copies")
    whole = late.select(F.col("doc_id").alias("doc"), "tid", F.lit(True).alias("copy"))
    lookup = spans.join(whole, ["doc", "tid"], "full").select(
        F.col("doc").alias("__doc"), F.col("tid").alias("__own"), F.col("spans").alias("__spans"), F.col("copy").alias("__copy"))
    joined = known.drop("__digest").join(lookup, (F.col("doc_id") == F.col("__doc")) & (F.col("__tid") == F.col("__own")), "left")
    all_of_it = F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.octet_length("text").cast("bigint").alias("end")))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return (joined.withColumn("removed", F.when(F.col("__copy"), all_of_it).otherwise(F.coalesce("__spans", none)))
            .drop("__doc", "__own", "__tid", "__spans", "__copy"))


def digest_kept(cut: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the digest of what remains."""
    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 128):
                part = batch.slice(k, 128)
                size, gone, many, digest = [], [], [], []
                texts = [text.encode() for text in part.column("text").to_pylist()]
                for data, merged in zip(texts, _merged(part.column("removed"), np.array([len(t) for t in texts], np.int64))):
                    left, at = hashlib.sha256(), 0
                    for a, b in merged:
                        left.update(data[at:a])
                        at = b
                    left.update(data[at:])
                    size.append(len(data)), many.append(len(merged)), digest.append(left.hexdigest())
                    gone.append(sum(b - a for a, b in merged))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(x, pa.int64()) for x in (size, gone, many)), pa.array(digest)],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return cut.select("doc_id", "text", "removed").mapInArrow(
        released(run), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def cut_texts(cut: DataFrame) -> DataFrame:
    """``cut`` with the remaining text in ``text``; a character that lost any of its bytes goes as a whole."""
    schema = cut.drop("removed").schema

    def run(batches):
        for batch in batches:
            texts = []
            whole = [text.encode() for text in batch.column("text").to_pylist()]
            for data, spans in zip(whole, _merged(batch.column("removed"), np.array([len(t) for t in whole], np.int64))):
                at, left = 0, []
                for a, b in spans:
                    left.append(data[at:a])
                    at = b
                left.append(data[at:])
                # A cut may fall inside a character; its other bytes are no text by themselves.
                texts.append("".join(x.decode(errors="ignore") for x in left))
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if f.name == "text" else batch.column(f.name)
                                              for f in schema], [f.name for f in schema])

    return cut.mapInArrow(released(run), schema)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_kept(dedup(table(spark, sf_dir, "documents").select("doc_id", "text")))
