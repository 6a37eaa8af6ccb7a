"""Exact Jaccard self-join of word n-gram sets by vertical partitioning.

N-grams are 64-bit hashes, and their global order is (frequent or not, hash). Documents are candidates if they share
an n-gram of their prefixes in the global order, which every pair over the threshold does, and if exact bounds by size,
position and sketch let them pass. The hash range is cut into fragments: the partial overlap of a pair is counted
in each fragment separately and summed per pair, until no pair at hand can reach the threshold any more.

Documents with equal sets form a class and are compared once. No table of pairs is stored for large groups: what
candidates connect is a cluster, a cluster is cut into salted blocks, and each two blocks meet in a task of
their own (a cell), which holds the sets of both, counts all overlaps and gives one row per member: how many rows it
links with there, and the least member that its links reach. Work grows with the square of a cluster, stored
rows with its members times its blocks. N-grams that many documents share come last in the order, so they
stand in a prefix only where a document holds little else; their groups are cut into blocks in the same way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kilnmark.llm.common import (FACTOR, components, discard, durable, flag_slots, is_flagged, mix, pack_slots, powers, released,
                                 running_sums, table)

WORDS = 5
#: A link needs DEN * overlap >= NUM * (size + size), which is a Jaccard similarity of 0.8 or more.
NUM, DEN = 4, 9
FRAGMENTS = 8
#: Slots that count how many documents hold an n-gram; n-grams above LOW of the hash range are not counted.
SLOT_BITS, LOW = 24, 0.35
#: A slot is frequent from MIN_FREQUENT documents and four times the mean of its bucket's slots.
MIN_FREQUENT = 16
#: Bits of the filter for the documents whose sets are needed.
NEEDED_BITS = 23
#: Members of a block, of a frequent key's group or of a cluster.
BLOCK = 512
#: N-grams of all sets in a block of a cluster, on average.
BLOCK_GRAMS = 1 << 20
#: Words of 64 bits in the parity sketch of a set: bit k is the parity of its n-grams in the k-th fine fragment.
SKETCH = [f"p{k}" for k in range(8)]
#: All that tells two sets apart without their n-grams; sets of more n-grams than the sketch has bits have a wide one too.
BOUNDS = [*SKETCH, "wide"]


def _word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word of ASCII-lower-cased bytes."""
    data = np.frombuffer(text, np.uint8)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    sums = running_sums(data)
    return mix((sums[end] - sums[start]) * powers(len(data) + 1, inverse=True)[start]
               ^ (end - start).astype(np.uint64)), start


def gram_sets(texts: list[str | None], width: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each text; a text with fewer words has one, without words none."""
    data = [(t or "").encode().lower() for t in texts]
    ends = np.cumsum([len(d) + 1 for d in data])
    words, start = _word_hashes(b" ".join(data) + b" ")
    cuts = np.searchsorted(start, ends)
    grams = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for j in range(width):
        grams = grams * np.uint64(0xFF51AFD7ED558CCD) + words[j:len(words) - width + 1 + j]
    grams = mix(grams)
    at = 0
    for cut in cuts:
        own = words[at:cut]
        if len(own) >= width:
            yield np.unique(grams[at:cut - width + 1])
        elif len(own):
            one = np.array([len(own)], np.uint64)
            for w in own:
                one = mix(one * np.uint64(0xFF51AFD7ED558CCD) + w)
            yield one
        else:
            yield own
        at = cut


def _sets(batches, width: int) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    for batch in batches:
        for k in range(0, batch.num_rows, 128):
            part = batch.slice(k, 128)
            yield part.column("doc_id"), list(gram_sets(part.column("text").to_pylist(), width))


def _print(grams: np.ndarray) -> tuple[int, int, int]:
    """Size and two sums over a set; equal for equal sets."""
    return len(grams), int(grams.sum(dtype=np.uint64).astype(np.int64)), int(
        mix(grams ^ FACTOR).sum(dtype=np.uint64).astype(np.int64))


def _sketch(grams: np.ndarray) -> np.ndarray:
    bits = 64 * len(SKETCH)
    return _parities(grams, bits).view(np.int64)


def _parities(grams: np.ndarray, bits: int) -> np.ndarray:
    return np.packbits(np.bincount((grams % np.uint64(bits)).astype(np.int64), minlength=bits).astype(np.uint8) & 1)


def _wide(grams: np.ndarray) -> bytes:
    """A sketch with at least as many bits as n-grams, a power of two; empty where the narrow one has enough."""
    return _parities(grams, 1 << (len(grams) - 1).bit_length()).tobytes() if len(grams) > 64 * len(SKETCH) else b""


def _folded(sketch: bytes, size: int) -> np.ndarray:
    """The sketch of the same set with ``size`` bytes: its halves are added bit by bit."""
    row = np.frombuffer(sketch, np.uint64)
    while len(row) * 8 > size:
        row = row[:len(row) // 2] ^ row[len(row) // 2:]
    return row


def _wide_near(wide: list[bytes], n: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The bound of ``_near`` for the pairs (a, b) of positions, by wide sketches folded to the smaller of the two."""
    size = np.array([len(w) for w in wide], np.int64)
    low = np.minimum(size[a], size[b])
    fits = np.ones(len(a), bool)
    for length in np.unique(low[low > 0]):
        pairs = np.flatnonzero(low == length)
        rows, at = np.unique(np.concatenate([a[pairs], b[pairs]]), return_inverse=True)
        folded = np.stack([_folded(wide[r], length) for r in rows])
        x, y, step = at[:len(pairs)], at[len(pairs):], max(1, (1 << 22) // int(length))
        for k in range(0, len(pairs), step):
            differ = np.bitwise_count(folded[x[k:k + step]] ^ folded[y[k:k + step]]).sum(axis=1, dtype=np.int64)
            p = pairs[k:k + step]
            fits[p] = DEN * differ <= (DEN - 2 * NUM) * (n[a[p]] + n[b[p]])
    return fits


def _near(n: str, p: str, other_n: str, q: str) -> Column:
    """An exact bound: sketches differ in no more bits than sets in n-grams, and links in a ninth of both sizes."""
    differ = " + ".join(f"bit_count({x.replace('p', p)} ^ {x.replace('p', q)})" for x in SKETCH)
    return F.expr(f"{DEN} * ({differ}) <= ({DEN} - 2 * {NUM}) * ({n} + {other_n})")


def _renamed(letter: str) -> list[Column]:
    return [F.col(x).alias(x.replace("p", letter)) for x in SKETCH]


def _fresh_sets(batches, width: int):
    """Like _sets, but a set that this task has met already is left out."""
    seen = set()
    for ids, sets in _sets(batches, width):
        keep = []
        for k, s in enumerate(sets):
            if len(s) and (p := _print(s)) not in seen:
                seen.add(p)
                keep.append(k)
        yield ids.take(pa.array(keep, pa.int64())).to_pylist(), [sets[k] for k in keep]


def describe(docs: DataFrame, width: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, the two sums that tell sets apart, and the parity sketches, for every row."""
    def run(batches):
        for ids, sets in _sets(batches, width):
            rows = [_print(s) for s in sets]
            sketches = np.array([_sketch(s) for s in sets], np.int64).reshape(-1, len(SKETCH))
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array([r[k] for r in rows], pa.int64()) for k in range(3)),
                 *(pa.array(np.ascontiguousarray(sketches[:, k])) for k in range(len(SKETCH))),
                 pa.array([_wide(s) for s in sets], pa.binary())], ["doc_id", "n_shingles", "s1", "s2", *BOUNDS])

    return docs.mapInArrow(released(run), "doc_id long, n_shingles long, s1 long, s2 long, " + ", ".join(f"{x} long" for x in SKETCH) + ", wide binary")


def frequent_slots(docs: DataFrame, width: int = WORDS) -> np.ndarray:
    """A bit per slot of the low hash range: do many documents hold n-grams of the slot?

    The counts cover all documents. The bits shape the global order only, so they cannot
    change a result.
    """
    step = np.uint64(int(LOW * 2.0**64) >> SLOT_BITS)

    def slots(batches):
        for batch in batches:
            grams = [s for _, sets in _fresh_sets([batch], width) for s in sets]
            slot = np.concatenate(grams) // step if grams else np.zeros(0, np.uint64)
            yield pack_slots(slot[slot < np.uint64(1 << SLOT_BITS)])

    return flag_slots(docs.mapInArrow(released(slots), "bucket int, slots binary"), SLOT_BITS, MIN_FREQUENT, 4)


def prefixes(docs: DataFrame, shared: Broadcast, hot: bool, width: int = WORDS) -> DataFrame:
    """(key, doc, n, pos) for the n-grams in the prefix of each set; hot: those frequent, or not counted, else the others."""
    step = np.uint64(int(LOW * 2.0**64) >> SLOT_BITS)
    names = ["key", "doc", "n", "pos"]

    def run(batches):
        bits = shared.value
        for ids, sets in _fresh_sets(batches, width):
            columns = [[] for _ in names]
            for doc, s in zip(ids, sets):
                slot = s // step
                counted = slot < np.uint64(1 << SLOT_BITS)
                frequent = counted & is_flagged(bits, np.where(counted, slot, np.uint64(0)))
                # Pairs over the threshold miss at most a fifth of either set.
                n = len(s)
                first = np.concatenate([np.flatnonzero(~frequent), np.flatnonzero(frequent)])[:n - (4 * n + 4) // 5 + 1]
                pos = np.flatnonzero((frequent | ~counted)[first] == hot)
                own = [s[first[pos]].view(np.int64), np.full(len(pos), doc, np.int64), np.full(len(pos), n, np.int64), pos]
                for column, values in zip(columns, own):
                    column.append(values)
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in columns], names)

    return docs.mapInArrow(released(run), ", ".join(f"{x} long" for x in names))


def _may_link(n: np.ndarray, pos: np.ndarray, other_n: np.ndarray, other_pos: np.ndarray) -> np.ndarray:
    """Can two documents link if this is the first n-gram of the order that they share?

    Nothing before it is shared, so what lies behind must do. Every link passes at its first shared
    n-gram, which stands in both prefixes.
    """
    return DEN * np.minimum(n - pos, other_n - other_pos) >= NUM * (n + other_n)


def _cold_pairs(rows: DataFrame) -> DataFrame:
    """Pairs of documents that share a rare key. Its group is bounded by the count of its slot."""
    def run(batches):
        held = None
        for batch in batches:
            now = [batch.column(c).to_numpy() for c in ("key", "doc", "n", "pos")]
            now = now if held is None else [np.concatenate([h, x]) for h, x in zip(held, now)]
            if not len(now[0]):
                continue
            last = np.searchsorted(now[0], now[0][-1])  # the last key may go on in the next batch
            held = [x[last:] for x in now]
            yield from pairs(*(x[:last] for x in now))
        if held is not None:
            yield from pairs(*held)

    def pairs(key, doc, n, pos):
        # Rows i and i + d are a pair as long as they share the key, for one distance d after the other.
        d, at = 1, np.arange(len(key) - 1)
        while len(at):
            at = at[at + d < len(key)]
            at = at[key[at] == key[at + d]]
            a, b = at, at + d
            fits = _may_link(n[a], pos[a], n[b], pos[b]) & (doc[a] != doc[b])
            if fits.any():
                x, y = doc[a[fits]], doc[b[fits]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])
            d += 1

    dealt = rows.repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(released(run), "a long, b long").distinct()


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct nodes of the edges (a, b), and for each the least node that it reaches."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y, label = at[:len(a)], at[len(a):], np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        now = label.copy()
        for side in (x, y, label[x], label[y]):
            np.minimum.at(now, side, low)
        now = now[now]
        if (now == label).all():
            return nodes, nodes[label]
        label = now


def needed_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(doc, grams), the sorted sets of the documents in ``wanted`` (column doc) and of a few more, one row for each id.

    A filter of fixed size (2^NEEDED_BITS bits), whatever the number of documents, tells which texts to read as sets.
    """
    mask = (1 << NEEDED_BITS) - 1

    def slots(batches):
        for batch in batches:
            yield pack_slots(batch.column("slot").to_numpy())

    asked = wanted.select(F.xxhash64("doc").bitwiseAND(F.lit(mask)).alias("slot"))
    held = docs.sparkSession.sparkContext.broadcast(
        flag_slots(asked.mapInArrow(released(slots), "bucket int, slots binary"), NEEDED_BITS, 1))

    def run(batches):
        for batch in batches:
            batch = batch.take(pa.array(np.flatnonzero(is_flagged(held.value, batch.column("slot").to_numpy()))))
            for k in range(0, batch.num_rows, 128):
                part = batch.slice(k, 128)
                sets = [s.view(np.int64) for s in gram_sets(part.column("text").to_pylist(), width)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sets, pa.list_(pa.int64()))], ["doc", "grams"])

    marked = docs.select("doc_id", "text", F.xxhash64("doc_id").bitwiseAND(F.lit(mask)).alias("slot"))
    return marked.mapInArrow(released(run), "doc long, grams array<bigint>").dropDuplicates(["doc"])


def _partial_overlap(gram: np.ndarray, member: np.ndarray, many: int, left: int) -> np.ndarray:
    """How many n-grams each two of ``many`` members share in one fragment; n-grams sorted, members ascending within one.

    With ``left`` the first so many members meet the others only. Common n-grams are counted by a product of matrices, the rest one by one.
    """
    out = np.zeros((many, many), np.int32)
    run = np.cumsum(np.diff(gram, prepend=gram[:1]) != 0)
    df = np.bincount(run)
    wide = df >= max(8, many // 16)
    if wide.any():
        column, here = np.cumsum(wide) - 1, wide[run]
        c, m = column[run[here]], member[here]
        for first in range(0, int(c[-1]) + 1, 4096):
            lo, hi = np.searchsorted(c, [first, first + 4096])
            holds = np.zeros((many, min(4096, int(c[-1]) + 1 - first)), np.float32)
            holds[m[lo:hi], c[lo:hi] - first] = 1
            if left:
                out[:left, left:] += (holds[:left] @ holds[left:].T).astype(np.int32)
            else:
                out += (holds @ holds.T).astype(np.int32)
    here = ((df > 1) & ~wide)[run]
    r, m = run[here], member[here].astype(np.int64)
    d, at, met = 1, np.arange(len(r) - 1), []
    while len(at):
        at = at[at + d < len(r)]
        at = at[r[at] == r[at + d]]
        met.append(m[at] * many + m[at + d])
        d += 1
    if met:
        out += np.bincount(np.concatenate(met), minlength=many * many).reshape(many, many).astype(np.int32)
    return out


def _cell_links(sets: list[np.ndarray], n: np.ndarray, left: int) -> tuple[np.ndarray, np.ndarray]:
    """The linked pairs of members, as two arrays of positions, fragment by fragment; ``left`` as above."""
    many = len(sets)
    grams, member = np.concatenate(sets), np.repeat(np.arange(many), n)
    order = np.argsort(grams, kind="stable")
    grams, member = grams[order], member[order]
    need = NUM * (n[:, None] + n[None, :])
    alive = np.triu(DEN * np.minimum(n[:, None], n[None, :]) >= need, 1)
    if left:
        alive[:left, :left] = alive[left:, left:] = False
    total, rest = np.zeros((many, many), np.int32), n.copy()
    cuts = np.searchsorted(grams, np.arange(1, FRAGMENTS).astype(np.uint64) << np.uint64(61))
    for lo, hi in zip([0, *cuts], [*cuts, len(grams)]):
        if not alive.any():
            break
        if hi > lo:
            total += _partial_overlap(grams[lo:hi], member[lo:hi], many, left)
            rest -= np.bincount(member[lo:hi], minlength=many)
        alive &= DEN * (total + np.minimum(rest[:, None], rest[None, :])) >= need
    return np.nonzero(alive)


def _cells(docs: DataFrame, members: DataFrame, width: int, whole: bool, block: int, block_grams: int) -> DataFrame:
    """Meet the members (doc, cluster, n, rows) of each cluster, block by block.

    Gives (a, b, more) per member and cell: member ``b`` links with ``more`` rows there, and ``a`` is the least member that
    its links there reach. ``whole``: (a, b, 1) for every linked pair instead.
    """
    size = members.groupBy("cluster").agg(F.greatest(F.ceil(F.count(F.lit(1)) / block), F.ceil(F.sum("n") / block_grams))
                                          .cast("bigint").alias("blocks"))
    # Stored first: both sides come from a shuffle then, and a busy cluster can be split.
    cut = durable(members.join(durable(size, "ngram-blocks"), "cluster")
                  .withColumn("own", F.pmod(F.xxhash64("doc"), F.col("blocks"))), "ngram-members")
    met = (needed_sets(docs, cut, width).join(cut, "doc")
           .withColumn("with", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))))
    dealt = (met.select("cluster", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), "own", "doc", "n", "rows", "grams")
             .repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "own"))

    def run(batches):
        held, last, out, waiting = [], None, [], 0
        for batch in batches:
            key = np.stack([batch.column(k).to_numpy() for k in range(3)])
            cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
                if hi == lo:
                    continue
                now = tuple(key[:, lo])
                if now != last and held:
                    out.append(cell(held))
                    waiting += len(out[-1][0])
                    held = []
                last = now
                held.append(batch.slice(lo, hi - lo))
            if waiting > 10_000:
                yield flat(out)
                out, waiting = [], 0
        if held:
            out.append(cell(held))
        if out:
            yield flat(out)

    def flat(out):
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in zip(*out)], ["a", "b", "more"])

    def cell(parts):
        i, j, own, doc, n, rows = (np.concatenate([p.column(k).to_numpy() for p in parts]) for k in range(1, 7))
        sets = [s.values.to_numpy().view(np.uint64) for p in parts for s in p.column(7)]
        left = int((own == i[0]).sum()) if i[0] < j[0] else 0
        none = np.zeros(0, np.int64)
        if len(doc) < 2 or left == len(doc) or (i[0] < j[0] and not left):
            return none, none, none
        a, b = _cell_links(sets, n, left)
        if whole:
            return np.minimum(doc[a], doc[b]), np.maximum(doc[a], doc[b]), np.ones(len(a), np.int64)
        more = np.bincount(a, rows[b], len(doc)) + np.bincount(b, rows[a], len(doc))
        nodes, least = _stars(doc[a], doc[b])
        at = np.argsort(doc)
        return least, nodes, more[at[np.searchsorted(doc, nodes, sorter=at)]].astype(np.int64)

    found = durable(dealt.mapInArrow(released(run), "a long, b long, more long"), "ngram-links")
    discard(cut)
    return found


def _to_reps(pairs: DataFrame, rep_of: DataFrame) -> DataFrame:
    """Pairs between class representatives, each once, without those inside a class or too far apart by their sketches."""
    def side(name: str, letter: str) -> DataFrame:
        return rep_of.select(F.col("doc_id").alias(name), F.col("rep").alias(f"r{name}"), F.col("n_shingles").alias(f"n{name}"),
                             *_renamed(letter), F.col("wide").alias(f"w{name}"))

    named = pairs.join(side("a", "u"), "a").join(side("b", "w"), "b").where("ra <> rb").where(_near("na", "u", "nb", "w"))

    def run(batches):
        for batch in batches:
            k = batch.num_rows
            n = np.concatenate([batch.column(c).to_numpy() for c in ("na", "nb")])
            wide = batch.column("wa").to_pylist() + batch.column("wb").to_pylist()
            fits = pa.array(np.flatnonzero(_wide_near(wide, n, np.arange(k), np.arange(k, 2 * k))))
            yield pa.RecordBatch.from_arrays([batch.column(c).take(fits) for c in "ab"], ["a", "b"])

    sized = named.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"), "na", "nb", "wa", "wb")
    return sized.mapInArrow(released(run), "a long, b long").distinct()


def _hot_pairs(hot: DataFrame, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) that connect all representatives that share a frequent key and may link by their sizes, positions and sketches.

    ``hot`` has (key, doc, n, pos and the sketches). The members of a key are dealt over blocks, and every two
    blocks (i, j) meet, so a task holds at most two blocks. Not the pairs come out, but for each member the
    least one that they connect it with.
    """
    many = durable(hot.groupBy("key").agg(F.count(F.lit(1)).alias("many")).where("many > 1"), "ngram-groups")
    blocks = F.ceil(F.col("many") / block).cast("bigint")
    salted = hot.join(many, "key").withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("doc", "key"), F.col("blocks")))
    met = salted.withColumn("with", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    dealt = (met.select("key", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), "own", "doc", "n", "pos",
                        *BOUNDS)
             .repartition("key", "i", "j").sortWithinPartitions("key", "i", "j"))

    def run(batches):
        held, held_wide = None, []
        for batch in batches:
            now = np.stack([c.to_numpy() for c in batch.columns[:-1]])
            now = now if held is None else np.concatenate([held, now], axis=1)
            wide = held_wide + batch.column("wide").to_pylist()
            if not now.shape[1]:
                continue
            differs = np.flatnonzero((now[:3, 1:] != now[:3, :-1]).any(axis=0))
            last = int(differs[-1]) + 1 if len(differs) else 0  # the last group may go on in the next batch
            held, held_wide = now[:, last:], wide[last:]
            yield from pairs(now[:, :last], wide[:last])
        if held is not None:
            yield from pairs(held, held_wide)

    def pairs(rows, wide):
        if rows.shape[1] < 2:
            return
        i, j, own, doc, n, pos = rows[1:7]
        sketch = np.ascontiguousarray(rows[7:].T).view(np.uint64)
        group = np.cumsum(np.concatenate([[0], (rows[:3, 1:] != rows[:3, :-1]).any(axis=0)]))
        found, d, at = [], 1, np.arange(rows.shape[1] - 1)
        while len(at):
            at = at[at + d < len(group)]
            at = at[group[at] == group[at + d]]
            a, b = at, at + d
            fits = ((i[a] == j[a]) | (own[a] != own[b])) & (doc[a] != doc[b]) & _may_link(n[a], pos[a], n[b], pos[b])
            a, b = a[fits], b[fits]
            d += 1
            if not len(a):
                continue
            differ = np.bitwise_count(sketch[a] ^ sketch[b]).sum(axis=1, dtype=np.int64)
            near = DEN * differ <= (DEN - 2 * NUM) * (n[a] + n[b])
            a, b = a[near], b[near]
            near = _wide_near(wide, n, a, b)
            found.append(np.stack([doc[a[near]], doc[b[near]]]))
            if sum(x.shape[1] for x in found) > 1 << 20:
                found = [np.stack(_stars(*np.concatenate(found, axis=1)))]
        if found:
            nodes, least = _stars(*np.concatenate(found, axis=1))
            apart = nodes != least
            yield pa.RecordBatch.from_arrays([pa.array(least[apart]), pa.array(nodes[apart])], ["a", "b"])

    return dealt.mapInArrow(released(run), "a long, b long")


def _classes(docs: DataFrame, width: int, whole: bool) -> tuple[DataFrame, DataFrame]:
    """Every row with its size and its class (rep, null without one), and what ``_cells`` finds among the classes."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    info = durable(describe(docs, width), "ngram-info")
    linked = docs.where("doc_id is not null")
    same = ["n_shingles", "s1", "s2"]
    reps = info.where("n_shingles > 0 and doc_id is not null").groupBy(*same).agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("rows"))
    # Stored first, so that both sides of the join come from a shuffle and a busy class can be split.
    reps = durable(reps, "ngram-reps")
    known = durable(info.join(reps, same, "left").withColumn("rep", F.when(F.col("doc_id").isNotNull(), F.col("rep"))), "ngram-classes")
    discard(info, reps)
    rep_of = known.where("rep is not null").select("doc_id", "rep", "n_shingles", *BOUNDS).distinct()
    flags = linked.sparkSession.sparkContext.broadcast(frequent_slots(linked, width))
    cold = durable(_to_reps(_cold_pairs(prefixes(linked, flags, False, width)), rep_of), "ngram-cold")
    rows = durable(prefixes(linked, flags, True, width), "ngram-prefixes")
    flags.destroy()
    hot = durable(rows.join(rep_of.withColumnRenamed("doc_id", "doc"), "doc")
                  .select("key", F.col("rep").alias("doc"), "n", "pos", *BOUNDS).distinct(), "ngram-hot")
    discard(rows)
    edges = durable(cold.union(_hot_pairs(hot)).distinct(), "ngram-candidates")
    discard(cold, hot)
    sizes = known.where("rep is not null").groupBy(F.col("rep").alias("doc")).agg(F.max("n_shingles").alias("n"), F.max("rows").alias("rows"))
    members = components(edges).join(sizes.withColumnRenamed("doc", "id"), "id")
    found = _cells(linked, members.select(F.col("id").alias("doc"), F.col("component_id").alias("cluster"), "n", "rows"), width, whole, BLOCK,
                   BLOCK_GRAMS)
    discard(edges)
    return known, found


def ngram_links(docs: DataFrame, width: int = WORDS) -> DataFrame:
    """Every linked pair (a, b) of class representatives, each once, a < b: all pairs, the square of a group of edited copies.

    The documents of a class have equal sets and link with each other and with all of a linked class; ``class_id`` of
    ``ngram_components`` names the representative of each document.
    """
    return _classes(docs, width, True)[1].select("a", "b")


def ngram_components(docs: DataFrame, width: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, class_id, component_id and n_links for every row of ``docs`` (doc_id long, text).

    ``n_links`` is the number of other rows that the row links with. Null or wordless texts have an empty set and are
    alone. Rows without a doc_id have null class and component and link with nothing. Rows that repeat a doc_id share
    its component; their link counts are exact if their texts are equal. Extra columns are dropped.
    """
    known, found = _classes(docs, width, False)
    # Documents of a class hang below its representative; an id that repeats may join classes.
    below = known.where("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b")).distinct()
    label = components(found.select("a", "b").union(below))
    more = durable(found.groupBy(F.col("b").alias("rep")).agg(F.sum("more").alias("more")), "ngram-many")
    return (known.join(more, "rep", "left").join(label.withColumnRenamed("id", "doc_id"), "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("rep", "doc_id").alias("class_id"),
                    F.coalesce("component_id", "doc_id").alias("component_id"),
                    F.when(F.col("rep").isNotNull(), F.col("rows") - 1 + F.coalesce("more", F.lit(0))).otherwise(F.lit(0)).alias("n_links")))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"))
