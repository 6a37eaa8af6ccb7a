import tracemalloc
import zlib
from collections import defaultdict
from types import SimpleNamespace

import numpy as np
import public_tokenizers as P
import pyarrow as pa
from tokenizers import Tokenizer

from kilnmark.llm import bpe, common, htmltext, langid, ngram_join, packing, quality, suffix_dedup

TEXTS = "doc_id long, text string"


def test_chunked_encoding_equals_whole(spark):
    path = P.path("byte_bpe_50k.tiktoken")
    texts = {1: "a" * 5000 + " b\n\n\n c", 2: "x  \n" * 900, 3: None, 4: "", 5: "Où est-ce, l'été? 😀 " * 80, 6: " " * 700}
    rows = [(k, t) for k, t in texts.items()] + [(2, texts[2])]
    got = bpe.encode_documents(spark.createDataFrame(rows, TEXTS), path, P.PATTERN, chunk=300, overlap=40).collect()
    enc = bpe.encoder(path, P.PATTERN)
    assert sorted(r.doc_id for r in got) == [1, 2, 2, 3, 4, 5, 6]
    assert all(r.ids == enc.encode_ordinary(texts[r.doc_id] or "") for r in got)
    assert all(bpe.decode_ids(r.ids, path, P.PATTERN).decode() == (texts[r.doc_id] or "") for r in got)


def test_packing(spark):
    path = P.path("byte_bpe_50k.json")
    texts = {k: "word and more " * (k * 7 % 400) for k in range(40)} | {40: None, 41: "été 😀"}
    placed = packing.pack_documents(spark.createDataFrame(list(texts.items()), TEXTS), path, P.PATTERN, window=256,
                                    keep_ids=True).toPandas()
    tok = Tokenizer.from_file(path)
    for k, own in placed.sort_values("start").groupby("doc_id"):
        ids = [*tok.encode(texts[k] or "", add_special_tokens=False).ids, 1]
        assert np.concatenate(list(own.ids)).tolist() == ids
        assert list(own.start) == [0, *np.cumsum(own.length)[:-1]]
        assert all(zlib.crc32(np.array(x, "<u4").tobytes()) == c for x, c in zip(own.ids, own.ids_crc32))
    for _, own in placed.sort_values("offset").groupby("sequence_id"):
        assert list(own.offset) == [0, *np.cumsum(own.length)[:-1]] and own.length.sum() <= 256
    assert placed.length.sum() / 256 / placed.sequence_id.nunique() > 0.8


def test_added_tokens_inside_texts(spark):
    path, end = P.path("byte_bpe_50k.json"), "<|endoftext|>"
    texts = {1: f"a {end} b", 2: end, 3: f"x..{end}{end}   {end}\n\n y", 4: f"<|endof {end[:-1]} text|>",
             5: "".join(f"word{k}  .{' ' * (k % 5)}{end}" for k in range(200)), 6: f"{'a b ' * 300}{end}" * 3}
    tok = Tokenizer.from_file(path)
    for chunk in (bpe.CHUNK, 97, 100):
        got = bpe.encode_documents(spark.createDataFrame(list(texts.items()), TEXTS), path, P.PATTERN, chunk=chunk, overlap=40)
        assert {r.doc_id: r.ids for r in got.collect()} == {k: tok.encode(t, add_special_tokens=False).ids for k, t in texts.items()}


def test_empty_tables(spark):
    none = spark.createDataFrame([], TEXTS)
    assert packing.pack_documents(none, P.path("byte_bpe_50k.json"), P.PATTERN).count() == 0
    assert ngram_join.ngram_components(none).count() == 0
    assert suffix_dedup.digest_kept(suffix_dedup.dedup(none)).count() == 0
    assert quality.judge(none).count() == 0
    told = langid.predict(none, langid.train(spark.createDataFrame([], TEXTS + ", lang string")))
    assert told.count() == 0


def test_quality_edges(spark):
    rows = [(1, None), (2, ""), (3, "one two three four five " * 4), (4, " ".join(f"word{k}" for k in range(30)))]
    got = {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows, TEXTS)).collect()}
    assert (got[1].n_words, got[1].base_failed, got[1].kept) == (0, True, False)
    assert (got[3].n_words, got[3].n_repeat_words) == (20, 20)
    assert got[4].n_repeat_words == 0 and got[4].kept


def _components(sets):
    up = {k: k for k in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {k: root(k) for k in sets}


def test_ngram_join_against_brute_force(spark, rng):
    words = [f"w{k}" for k in range(400)]
    rows, base = [], [[rng.choice(words) for _ in range(60)] for _ in range(4)]
    for k in range(120):
        text = list(rng.choice(base))
        for _ in range(rng.randrange(4)):
            text[rng.randrange(60)] = rng.choice(words)
        rows.append((k, " ".join(text)))
    rows += [(200, None), (201, " \n"), (202, "A b"), (203, "a B"), (204, "a b c d e"), (205, rows[0][1].upper())]
    sets = {}
    for k, t in rows:
        w = (t or "").lower().split()
        sets[k] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    got = {r.doc_id: r for r in ngram_join.ngram_components(spark.createDataFrame(rows, TEXTS)).collect()}
    want = _components(sets)
    assert {k: r.component_id for k, r in got.items()} == want
    assert {k: r.n_shingles for k, r in got.items()} == {k: len(s) for k, s in sets.items()}


def test_ngram_join_yields_every_link(spark, rng, monkeypatch):
    # Edited copies of one text: all n-grams are frequent, and many members of the one component do not link.
    base, rows = [f"w{k}" for k in range(150)], []
    for k in range(90):
        text = list(base)
        for j in range(rng.randrange(6)):
            text[rng.randrange(150)] = f"x{k}_{j}"
        rows.append((k, " ".join(text)))
    rows += [(300 + k, rows[k][1].upper()) for k in range(5)] + [(400, None), (401, None), (None, rows[0][1])]
    sets = {k: {tuple(w[i:i + 5]) for i in range(len(w) - 4)} for k, t in rows if k is not None for w in [(t or "").lower().split()]}
    links = {(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    docs = spark.createDataFrame(rows, TEXTS)
    monkeypatch.setattr(ngram_join._hot_pairs, "__defaults__", (16,))  # several blocks for a key
    got = ngram_join.ngram_components(docs).collect()
    of = {r.doc_id: r.class_id for r in got if r.doc_id is not None}
    pairs = [(r.a, r.b) for r in ngram_join.ngram_links(docs).collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(min(of[a], of[b]), max(of[a], of[b])) for a, b in links if of[a] != of[b]}
    assert {(r.doc_id, r.n_links) for r in got} == {(None, 0)} | {(k, sum(k in x for x in links)) for k in sets}
    assert len(pairs) < 90 * 89 / 2 and len({r.component_id for r in got if r.doc_id is not None and r.doc_id < 400}) < 90


def test_suffix_dedup_against_brute_force(spark, rng, sha):
    base = ["".join(rng.choice("abé ") for _ in range(90)) for _ in range(5)] + ["a" * 120, "ab" * 70]
    rows = [(i, "".join(rng.choice(base) if rng.random() < 0.5 else "".join(rng.choice("abé ") for _ in range(rng.randrange(40)))
                        for _ in range(rng.randrange(5)))) for i in range(40)]
    rows += [(100, None), (101, ""), (102, rows[3][1]), (103, "x" * 49), (104, "x" * 50), (105, "x" * 51)]
    least = defaultdict(lambda: 1 << 60)
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - 49):
            least[b[i:i + 50]] = min(least[b[i:i + 50]], d)
    docs = spark.createDataFrame(rows, TEXTS).repartition(4)
    for group_rows in (50_000, 2):
        got = {r.doc_id: r for r in suffix_dedup.digest_kept(suffix_dedup.dedup(docs, group_rows)).collect()}
        for d, t in rows:
            b = (t or "").encode()
            mark = bytearray(len(b))
            for i in range(len(b) - 49):
                if least[b[i:i + 50]] < d:
                    mark[i:i + 50] = b"\1" * 50
            kept = bytes(c for c, m in zip(b, mark) if not m)
            assert (got[d].n_removed, got[d].kept_sha256) == (sum(mark), sha(kept)), d


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", "text")
    net = langid.train(docs)
    told = langid.predict(docs.withColumn("held", langid.held_out()), net).where("held").toPandas()
    assert (told.lang == told.lang_pred).mean() > 0.97
    odd = langid.predict(spark.createDataFrame([(1, None), (2, ""), (3, "123 !?")], TEXTS), net).collect()
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in odd)


def test_html():
    page = ("<html><head><title>T</title></head><body><nav><a href=x>Home</a></nav><div id=content><h1>Title here</h1><div>"
            "<p>First &amp; long paragraph of text that goes on, and on, and on.</p><p>Second one with <a href=z>a link</a> in it,"
            " long enough.<p>Short.</div></div><div class='comments'><p>A reader's comment that goes on and on.</p></div>"
            "<script>var t='</p>';</script><form>Name</form><footer>End</footer></body></html>")
    assert htmltext.main_text(page) == ("Title here\nFirst & long paragraph of text that goes on, and on, and on.\n"
                                        "Second one with a link in it, long enough.\nShort.")
    assert [htmltext.main_text(x) for x in ("plain  text", "<p>a</p>", "<body></body>", "")] == ["plain text", "a", "", ""]


def test_html_marked_parts_that_hold_the_article():
    text = "<p>" + "A long paragraph of the article that goes on and on. " * 4 + "</p>"
    want = ("A long paragraph of the article that goes on and on. " * 4).strip()
    pages = [f"<body><form id=f><label>Name</label><input><article>{text}</article><button>Go</button></form></body>",
             f"<body><div class='layout no-sidebar'><article>{text}</article></div></body>",
             f"<body><section title='A hidden gem'>{text}</section></body>",
             f"<body><div class=sidebar><article>{text}</article></div><p>Short.</p></body>",
             f"<body><form>{text}<select><option>One</select></form></body>"]
    assert [want in htmltext.main_text(x) for x in pages] == [True] * 5
    assert not any(x in htmltext.main_text(pages[0]) + htmltext.main_text(pages[4]) for x in ("Name", "Go", "One"))
    # Marked parts beside an article go as before, also if they hold articles themselves.
    beside = f"<body><article>{text}</article><div class=comments><article>A reader's word.</article></div><div hidden>No</div></body>"
    assert htmltext.main_text(beside) == want


def test_anchors_are_the_least_hashes(rng):
    """Every window's anchor, the leftmost of equal hashes, and runs that end with the document."""
    def plain(buffer, ends):
        sums = suffix_dedup.running_sums(buffer)
        n = len(buffer) - suffix_dedup.GRAM + 1
        grams = suffix_dedup.mix((sums[suffix_dedup.GRAM:] - sums[:-suffix_dedup.GRAM]) * suffix_dedup.powers(len(buffer), inverse=True)[:n])
        out, begin = [], 0
        for d, end in enumerate(ends):
            for w in range(begin, end - suffix_dedup.THRESHOLD + 1):
                at = w + int(np.argmin(grams[w:w + suffix_dedup.SPAN]))
                if out and out[-1][:2] == [d, at]:
                    out[-1][4] = w
                else:
                    out.append([d, at, int(grams[at]), w, w])
            begin = end
        return out

    for letters in (1, 2, 3, 26):
        for period in (1, 7, 10**6):
            ends = np.cumsum([60, 0, 49, 50, 200, 300])
            buffer = np.resize(np.array([rng.randrange(97, 97 + letters) for _ in range(min(period, 659))], np.uint8), 659)
            got = [list(map(int, row)) for row in zip(*suffix_dedup._anchors(buffer, ends))]
            assert got == plain(buffer, ends)


def test_anchors_stay_small():
    """Arrays as long as the text are few: the work is bound by memory."""
    buffer = np.random.default_rng(0).integers(97, 123, 1 << 18).astype(np.uint8)
    ends = np.cumsum(np.full(256, 1024))
    suffix_dedup._anchors(buffer, ends)
    tracemalloc.start()
    try:
        suffix_dedup._anchors(buffer, ends)
        assert tracemalloc.get_traced_memory()[1] < 50 * len(buffer)
    finally:
        tracemalloc.stop()


def test_flags_hold_one_bucket_at_a_time(monkeypatch):
    """Few rows come in one task, which must not hold a count of each slot."""
    batch = common.pack_slots(np.tile(np.arange(0, 1 << 25, 4096, dtype=np.uint64), 2))

    class Rows:
        repartition = sortWithinPartitions = lambda self, *_: self

        def mapInArrow(self, run, _):
            self.run = run
            return self

        def toLocalIterator(self):
            for found in self.run(batch.slice(k, 1) for k in range(batch.num_rows)):
                yield from (SimpleNamespace(**r) for r in found.to_pylist())

    monkeypatch.setattr(common, "durable", lambda rows, _: rows)
    monkeypatch.setattr(common, "discard", lambda *_: None)
    tracemalloc.start()
    try:
        flags = common.flag_slots(Rows(), 25, 2)
        assert tracemalloc.get_traced_memory()[1] < 30e6
    finally:
        tracemalloc.stop()
    assert np.flatnonzero(np.unpackbits(flags)).tolist() == list(range(0, 1 << 25, 4096))


def test_flags_reach_the_driver_in_small_pieces(spark, monkeypatch):
    """The driver's heap grows by what comes in one piece, and a file may hold every bucket."""
    wanted = np.random.default_rng(4).random(1 << 24) < 0.5

    def dense(batches):
        yield common.pack_slots(np.flatnonzero(wanted))

    pieces, rows = [], type(spark.range(1))
    fetch = rows.toLocalIterator

    def watched(self, *args):
        pieces.extend(self.rdd.mapPartitions(lambda part: [sum(len(r.bits) for r in part)]).collect())
        return fetch(self, *args)

    monkeypatch.setattr(rows, "toLocalIterator", watched)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        flags = common.flag_slots(spark.range(0, 1, 1, 1).mapInArrow(dense, "bucket int, slots binary"), 24, 1)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert np.array_equal(np.unpackbits(flags).astype(bool), wanted)
    assert sum(pieces) > 2e6 and max(pieces) < 1e6


def test_spans_of_a_batch_are_merged_by_row(rng):
    sizes = [rng.randrange(1, 300) for _ in range(50)]
    spans = [[tuple(sorted(rng.randrange(size + 1) for _ in "ab")) for _ in range(rng.randrange(6))] for size in sizes]
    column = pa.array([[{"start": a, "end": b} for a, b in row] for row in spans], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
    for row, size, got in zip(spans, sizes, suffix_dedup._merged(column, np.array(sizes)), strict=True):
        runs = []
        for a, b in sorted(row):
            if runs and a <= runs[-1][1]:
                runs[-1] = (runs[-1][0], max(runs[-1][1], b))
            else:
                runs.append((a, b))
        assert got == runs
    assert suffix_dedup._merged(column.slice(3, 2), np.array(sizes[3:5])) == suffix_dedup._merged(column, np.array(sizes))[3:5]
    assert suffix_dedup._merged(column.slice(0, 0), np.array([], np.int64)) == []
