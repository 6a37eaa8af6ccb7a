"""Byte-level BPE over whole texts by overlapping chunks, and decoding.

A short text is encoded where it lies. A long one is cut into chunks that overlap; every
chunk is pre-tokenised by itself, in parallel. The pattern looks only forward, so once two
neighbours share a boundary inside their overlap they agree from there on. Chunk 0 is
right from its start, and so by induction is every chunk that resynchronises with its
predecessor: the text between two such points is a piece that can be encoded
alone. A text with a border that does not resynchronise (a run without boundary that is longer
than the overlap) is encoded whole in one task instead.
"""

from __future__ import annotations

import functools
import heapq
import hashlib
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kilnmark.llm.common import released, empty_text, encoding, table

CHUNK, OVERLAP = 65536, 1024


@functools.lru_cache(maxsize=2)
def encoding_of_json(path: str, pattern: str):
    """The encoder of a byte-level vocabulary in JSON form, whose ids are also its merge ranks."""
    import tiktoken

    spelled = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in spelled]
    byte_of = {chr(b): b for b in spelled} | {chr(256 + k): b for k, b in enumerate(rest)}
    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    special = {x["content"]: x["id"] for x in model["added_tokens"]}
    if any(x[flag] for x in model["added_tokens"] for flag in ("lstrip", "rstrip", "single_word")):
        raise ValueError(f"{path} has added tokens that look at the text around them")
    ranks = {bytes(byte_of[c] for c in token): k for token, k in model["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding("json", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)


def encoder(path: str, pattern: str):
    return (encoding_of_json if path.endswith(".json") else encoding)(path, pattern)


#: A run of white space that is longer is not given to the pattern matcher, which gives up on about a million characters.
LONGEST_RUN = 100_000
#: How a pattern ends that takes a run of white space as one piece, without its last character if a word follows.
_RUN_RULE = r"\s+(?!\S)|\s+"


def encode_text(enc, text: str) -> list[int]:
    """The ids of a text; it is cut at the spelling of added tokens, and their ids stand between the parts.

    The outcome of the pattern for a run of white space is known, so a very long run is cut out and its
    bytes are merged as the one piece that they are: all of it at the end of the text or before an added
    token, all but the last character before anything else.
    """
    ids, at = [], 0
    for start, end in _long_runs(text) if enc._pat_str.endswith(_RUN_RULE) else ():
        if end < len(text) and not text.startswith(tuple(enc.special_tokens_set), end):
            end -= 1
        ids += _encode_part(enc, text[at:start])
        ids += _merge_run(enc, text[start:end])
        at = end
    return ids + _encode_part(enc, text[at:]) if at else _encode_part(enc, text)


def _encode_part(enc, text: str) -> list[int]:
    return enc.encode(text, allowed_special="all") if enc.special_tokens_set else enc.encode_ordinary(text)


def _long_runs(text: str) -> Iterator[tuple[int, int]]:
    if len(text) <= LONGEST_RUN:
        return
    import regex

    for m in regex.finditer(r"\p{White_Space}++", text):
        if m.end() - m.start() > LONGEST_RUN:
            yield m.span()


def _merge_run(enc, run: str) -> list[int]:
    """The byte pairs of one piece, merged by rank: least rank first, leftmost first.

    A heap of candidate pairs over a linked list of parts, so a piece of n bytes takes n log n steps.
    """
    data, ranks = run.encode(), enc._mergeable_ranks
    n = len(data)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    stop = list(range(1, n + 1))  # where the part that starts here ends; 0 once it is part of another

    def rank(a: int) -> int | None:
        b = after[a]
        return ranks.get(data[a:stop[b]]) if b < n else None

    heap = [(r, a, a + 2) for a in range(n - 1) if (r := rank(a)) is not None]
    heapq.heapify(heap)
    while heap:
        r, a, end = heapq.heappop(heap)
        b = after[a]
        if not stop[a] or b >= n or stop[b] != end or rank(a) != r:
            continue  # one of the two has been merged meanwhile
        stop[a], stop[b], after[a] = end, 0, after[b]
        if after[b] < n:
            before[after[b]] = a
        for c in (before[a], a):
            if c >= 0 and (r := rank(c)) is not None:
                heapq.heappush(heap, (r, c, stop[after[c]]))
    return [ranks[data[a:stop[a]]] for a in range(n) if stop[a]]


def _ids(batches: list[list[int]]) -> pa.Array:
    return pa.array(batches, pa.list_(pa.int32()))


def _rows(batch: pa.RecordBatch, step: int = 256) -> Iterator[pa.RecordBatch]:
    for k in range(0, batch.num_rows, step):
        yield batch.slice(k, step)


def encode_documents(docs: DataFrame, path: str, pattern: str, text: str = "text", chunk: int = CHUNK,
                     overlap: int = OVERLAP) -> DataFrame:
    """``docs`` without ``text`` and with ``ids`` (array of int); null text encodes as empty.

    Every row comes back once, repeated rows as often as they stand there. Other columns
    pass through; a column of the name ``ids`` is replaced. The added tokens of a JSON vocabulary are
    found inside a text, as the tokenizers library does; a rank file has none.
    """
    rest = [c for c in docs.columns if c not in (text, "ids")]
    rows = docs.select(*rest, empty_text(text).alias("__text"))
    out = T.StructType([*(rows.schema[c] for c in rest), T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def whole(batches):
        enc = encoder(path, pattern)
        for batch in batches:
            for part in _rows(batch):
                ids = [encode_text(enc, x) for x in part.column("__text").to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in rest), _ids(ids)], [*rest, "ids"])

    short = rows.where(F.length("__text") <= chunk).mapInArrow(released(whole), out)
    return short.unionByName(_encode_long(rows.where(F.length("__text") > chunk), rest, path, pattern, chunk, overlap))


def _encode_long(rows: DataFrame, rest: list[str], path: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    # A text is known by its digest: equal texts are cut and encoded once and joined back to all their rows.
    keyed = rows.withColumn("__key", F.sha2("__text", 256))
    texts = keyed.select("__key", "__text").groupBy("__key").agg(F.first("__text").alias("__text"))
    n = F.ceil(F.length("__text") / chunk).cast("int")
    cut = (texts.select("__key", "__text", F.explode(F.sequence(F.lit(0), n - 1)).alias("no"), n.alias("n"))
           .select("__key", "no", "n", F.expr(f"substring(__text, no * {chunk} + 1, {chunk + overlap})").alias("part"))
           .repartition("__key", "no"))

    def borders(batches):
        import regex

        find = regex.compile(pattern).finditer
        added = sorted(encoder(path, pattern).special_tokens_set, key=len, reverse=True)
        cut_at = regex.compile("|".join(map(regex.escape, added))).finditer if added else None
        longest = max(map(len, added), default=0)

        def pieces(x):
            """Start and end of every piece; no piece reaches over an added token, which is one itself."""
            at = 0
            for m in cut_at(x) if cut_at else ():
                yield from ((at + p.start(), at + p.end()) for p in find(x[at:m.start()]))
                yield m.span()
                at = m.end()
            yield from ((at + p.start(), at + p.end()) for p in find(x[at:]))

        for batch in batches:
            for part in _rows(batch, 64):
                heads, tails = [], []
                for x, no, last in zip(part.column("part").to_pylist(), part.column("no").to_pylist(),
                                       part.column("n").to_pylist()):
                    # A match that reaches the end of the chunk, or looks at it, may be longer in the text, and
                    # one that reaches into the last characters may meet an added token that the chunk cuts.
                    sure = len(x) - 1 - longest
                    starts = [a for a, b in pieces(x) if b < sure or no == last - 1]
                    heads.append([s for s in starts if s <= overlap])
                    tails.append([s - chunk for s in starts if s >= chunk])
                ints = pa.list_(pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(heads, ints), pa.array(tails, ints)],
                    ["__key", "no", "n", "part", "head", "tail"])

    marked = cut.mapInArrow(released(borders), "__key string, no int, n int, part string, head array<int>, tail array<int>")
    order = Window.partitionBy("__key").orderBy("no")
    everything = Window.partitionBy("__key")
    # Where this chunk starts to count, and where the next one takes over.
    joint = F.array_min(F.array_intersect("tail", F.lead("head").over(order)))
    stitched = (marked.withColumn("till", joint)
                .withColumn("begin", F.when(F.col("no") == 0, 0).otherwise(F.lag("till").over(order)))
                .withColumn("sync", F.min((F.col("begin").isNotNull()).cast("int")).over(everything)))
    piece = F.expr(f"substring(part, begin + 1, if(no = n - 1, length(part), {chunk} + till) - begin)")
    broken = F.expr(f"substring(part, 1, {chunk})")
    synced = stitched.where("sync = 1").select("__key", "no", piece.alias("piece"))
    # A text that does not resynchronise is put together again and encoded whole.
    joined = (stitched.where("sync = 0").groupBy("__key")
              .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("no", broken.alias("part")))),
                                            lambda x: x["part"]), "").alias("piece"))
              .select("__key", F.lit(0).alias("no"), "piece"))

    def encode(batches):
        enc = encoder(path, pattern)
        for batch in batches:
            for part in _rows(batch, 64):
                ids = [encode_text(enc, x) for x in part.column("piece").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("__key"), part.column("no"), _ids(ids)], ["__key", "no", "ids"])

    coded = synced.unionByName(joined).repartition("__key", "no").mapInArrow(released(encode), "__key string, no int, ids array<int>")
    whole = coded.groupBy("__key").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("no", "ids"))),
                                                             lambda x: x["ids"])).alias("ids"))
    return keyed.select(*rest, "__key").join(whole, "__key").select(*rest, "ids")


def decode_ids(ids: list[int], path: str, pattern: str) -> bytes:
    """The concatenated raw bytes of the ids."""
    return encoder(path, pattern).decode_bytes(ids)


def digest_ids(coded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the bytes that they decode to."""

    def run(batches):
        enc = encoder(path, pattern)
        for batch in batches:
            for part in _rows(batch):
                lists = part.column("ids").to_pylist()
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array([len(x) for x in lists], pa.int64()),
                    pa.array([hashlib.sha256(" ".join(map(str, x)).encode()).hexdigest() for x in lists]),
                    pa.array([hashlib.sha256(enc.decode_bytes(x)).hexdigest() for x in lists])],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return coded.select("doc_id", "ids").mapInArrow(
        released(run), T.StructType([coded.schema["doc_id"], T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digest_ids(encode_documents(docs, path, pattern), path, pattern)
