"""Inputs that operators have stumbled over: extreme vectors, clashing columns, repeated ids, endless white space."""

import hashlib
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from kilnmark.llm import bpe, cover_tree, htmltext, langid, packing, suffix_dedup


def links_of(rows):
    """Linked ids of each id by plain cosine, after a scaling that keeps squares within range."""
    units = {}
    for vec_id, v in rows:
        x = np.array(v, np.float64)
        x = x / np.abs(x).max()
        units[vec_id] = x / np.linalg.norm(x)
    return {a: sum(b != a and float(units[a] @ units[b]) >= 0.9 for b in units) for a in units}


def test_tiny_and_huge_vectors(spark):
    """Their squares vanish or overflow; they are compared all the same, and nobody loses a link to them."""
    rng = np.random.default_rng(2)
    centers = rng.normal(size=(6, 3))
    rows = [(i, [float(x) for x in centers[rng.integers(6)] + rng.normal(size=3) * 0.2]) for i in range(200)]
    rows += [(300, [1e-170, 0.0, 1e-170]), (301, [1e200, 0.0, 1e200]), (302, [1e200, 0.0, 1.01e200]), (303, [5e-324, 0.0, 5e-324]),
             (304, [1.7e308, 0.0, -1.7e308]), (305, [1e-300, 1e300, 0.0])]
    got = {r.vec_id: r.n_links for r in cover_tree.near_duplicates(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>"), block=20).collect()}
    assert got == links_of(rows)
    assert got[300] >= 3 and got[301] == got[300]


def test_dedup_keeps_columns(spark):
    names = ["spans", "copy", "tid", "doc", "at", "start", "end", "h", "least", "key"]
    shared = "one passage of well over fifty bytes that two documents share, "
    docs = spark.createDataFrame([(1, shared + "a"), (2, "b " + shared), (2, "b " + shared), (None, shared), (4, None), (5, "")], "doc_id long, text string")
    for n in names:
        docs = docs.withColumn(n, F.lit(f"my {n}"))
    got = suffix_dedup.dedup(docs.withColumn("removed", F.lit(1)))
    assert set(got.columns) == {"doc_id", "text", "removed", *names}
    rows = got.collect()
    assert len(rows) == 6 and all(r[n] == f"my {n}" for r in rows for n in names)
    assert sorted((r.doc_id or 0, bool(r.removed)) for r in rows) == [(0, False), (1, False), (2, True), (2, True), (4, False), (5, False)]
    assert suffix_dedup.dedup(docs.where("false")).count() == 0


def test_language_net_learns_from_rows_of_one_id(spark):
    """All rows bear one id, or all are equal: the sample is still drawn from them."""
    words = {"en": ["the", "house", "green"], "de": ["das", "haus", "grün"]}
    rng = random.Random(1)
    rows = [(1, lang, " ".join(rng.choices(words[lang], k=12))) for _ in range(400) for lang in words]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    assert zlib.crc32(b"1") % 5
    assert langid.train(docs, sample_rows=40).labels == ["de", "en"]
    equal = spark.createDataFrame([(1, "en", "the same text")] * 800, "doc_id long, lang string, text string")
    assert langid.train(equal, sample_rows=40).labels == ["en"]


@pytest.mark.parametrize("alphabet", [" ", " \n", "\n\t ", " 　", "\r\n"])
def test_white_space_is_merged_as_the_engine_does(alphabet):
    enc = bpe.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    rng = random.Random(3)
    for n in (1, 2, 3, 17, 100, 3000):
        run = "".join(rng.choices(alphabet, k=n))
        assert bpe._merge_run(enc, run) == list(enc._encode_single_piece(run))


@pytest.mark.parametrize("vocabulary", ["byte_bpe_50k.tiktoken", "byte_bpe_50k.json"])
def test_long_runs_are_cut_as_the_pattern_would(monkeypatch, vocabulary):
    enc = bpe.encoder(public_tokenizers.path(vocabulary), public_tokenizers.PATTERN)
    rng = random.Random(4)
    monkeypatch.setattr(bpe, "LONGEST_RUN", 50)
    parts = [" " * 51, " " * 50, "\n" * 70, " \n\t" * 40, "word", "1", "é", "...", "　" * 60, "\x1c" * 60, "<|endoftext|>", "'s"]
    for _ in range(400):
        text = "".join(rng.choices(parts, k=rng.randrange(1, 9)))
        assert bpe.encode_text(enc, text) == bpe._encode_part(enc, text), text


def endless(tmp_path, spark):
    texts = [" " * 2_000_000, "a" + " " * 2_000_000 + "b", "\n " * 700_000 + "end", "plain text", "plain text", "", None, "é" * 70_000, "word " * 30_000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "no id")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    return rows


def test_bpe_query_with_endless_white_space(spark, tmp_path):
    rows = endless(tmp_path, spark)
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.op3_bpe(spark, str(tmp_path)).collect()}
    enc = bpe.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    for doc_id, text in rows:
        n, ids, decoded = got[doc_id]
        assert decoded == hashlib.sha256((text or "").encode()).hexdigest()
        if len(text or "") < 900_000:
            plain = enc.encode_ordinary(text or "")
            assert (n, ids) == (len(plain), hashlib.sha256(" ".join(map(str, plain)).encode()).hexdigest())
    # No merge joins spaces in this vocabulary, so each is a token; the last one goes with the word behind it.
    assert got[0][0] == 2_000_000 and got[1][0] == 2_000_001


def test_packing_query_with_endless_white_space(spark, tmp_path):
    rows = endless(tmp_path, spark)
    enc = bpe.encoder(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    pieces = {}
    for r in packing.op1_packing(spark, str(tmp_path)).collect():
        pieces.setdefault(r.doc_id, []).append(r)
    for doc_id, text in rows:
        own = sorted(pieces[doc_id], key=lambda r: r.start)
        ids = [*bpe.encode_text(enc, text or ""), 1]
        assert own[0].start == 0 and own[0].doc_tokens == len(ids) == sum(r.length for r in own)
        for r in own:
            data = struct.pack(f"<{r.length}I", *ids[r.start:r.start + r.length])
            assert r.ids_crc32 == zlib.crc32(data) and 0 <= r.offset <= 2048 - r.length


# --- pages ------------------------------------------------------------------------

SENTENCE = "A sentence of the article that is long enough to count. "
WORD_OF_READERS = "A reader writes a very long comment about this article here. "


def test_pages_whose_names_mark_other_parts():
    """Names are split at hyphens and underscores; readers' comments never win by their length."""
    body = f"<p>{SENTENCE * 5}</p><p>{SENTENCE * 4}</p>"
    want = (SENTENCE * 5).strip() + "\n" + (SENTENCE * 4).strip()
    many = "".join(f"<p>{WORD_OF_READERS * 4}</p>" for _ in range(12))
    pages = [f"<body><div class=post>{body}</div><div class='comments-area'>{many}</div></body>",
             f"<body><div class=post>{body}</div><section id=disqus_thread>{many}</section></body>",
             f"<body><article>{body}</article><ol class='comment-list'><li><article class='comment-body'>{many}</article></ol></body>",
             f"<body><article>{body}</article><div class='site-footer'><p>{WORD_OF_READERS * 2}</p></div><div class='cookie-banner'><p>{WORD_OF_READERS}</p></div></body>",
             f"<body><div class='has-sidebar comments-open'><article>{body}</article><div class='left_sidebar'><p>{WORD_OF_READERS * 4}</p></div></div></body>",
             f"<body><div class='elementor-widget'><div class='widget-text-header'>{body}</div></div></body>"]
    assert [htmltext.main_text(p) for p in pages] == [want] * len(pages)
    # A page with next to nothing but comments keeps them.
    assert WORD_OF_READERS.strip() in htmltext.main_text(f"<body><div class=comments>{many}</div></body>")


def test_text_behind_the_body_and_headers_of_articles():
    body = f"<p>{SENTENCE * 5}</p>"
    early = f"<body><div><p>Menu</p></div></body><div>{body}<p>{SENTENCE * 2}</p></div></html>"
    assert (SENTENCE * 5).strip() in htmltext.main_text(early) and htmltext.main_text(early).endswith(SENTENCE.strip())
    page = f"<body><header>Site</header><article><header><h1>Headline</h1><p>Standfirst of it.</p></header>{body}<footer>Tags</footer></article>"
    assert htmltext.main_text(page) == "Headline\nStandfirst of it.\n" + (SENTENCE * 5).strip()


@pytest.mark.parametrize("page", ["<div>" * 60_000 + "</b>" * 60_000, '<a "' * 250_000, "<a " * 300_000, "<!--" * 200_000, "<div class='" * 80_000,
                                  "<p>" + "<b>" * 50_000 + "<hr>" * 50_000, "<table><td><p>" + "<b>" * 50_000 + "</p>" * 50_000])
def test_markup_of_any_shape_takes_linear_time(page):
    import time

    began = time.process_time()
    htmltext.main_text(page)
    assert time.process_time() - began < 15


def random_page(rng, depth=0):
    out = []
    for _ in range(rng.randrange(1, 5)):
        tag = rng.choice(["div", "p", "section", "a", "span", "ul", "li", "nav", "h2", "article", "b"])
        inner = random_page(rng, depth + 1) if depth < 4 and rng.random() < 0.6 else SENTENCE * rng.randrange(3) + rng.choice(["x", "&amp;", "é  é", ""])
        close = f"</{tag}>" if rng.random() < 0.9 else ""
        out.append(f"<{tag}>{inner}{close}{rng.choice(['', '</b>', '</body>', ' tail '])}")
    return "".join(out)


def plain_totals(node):
    """The density rule stated anew, by recursion: characters, tags, those in links, and each node's sum of child densities."""
    chars = sum(len(p.strip()) for p in node.parts if isinstance(p, str))
    tags = link_tags = 0
    link_chars = chars if node.in_link else 0
    for child in node.parts:
        if not isinstance(child, str) and not child.dropped:
            c, t, lc, lt = plain_totals(child)
            chars, tags, link_chars, link_tags = chars + c, tags + t + 1, link_chars + lc, link_tags + lt + (child.tag == "a")
    return chars, tags, link_chars, link_tags


def test_densities_against_the_rule():
    import math

    rng = random.Random(8)
    for _ in range(150):
        nodes = htmltext._tree(f"<body>{random_page(rng)}</body>")
        body = next(n for n in nodes if n.tag == "body")
        htmltext._drop_others(nodes, body)
        htmltext._measure(nodes, body)
        c0, _, lc0, _ = plain_totals(body)
        for node in nodes:
            if node.dropped:
                continue
            expected = 0.0
            for child in (n for n in node.parts if not isinstance(n, str) and not n.dropped):
                c, t, lc, lt = plain_totals(child)
                if c:
                    t, lc1, lt = max(t, 1), max(lc, 1), max(lt, 1)
                    log = math.log(math.log(c / max(c - lc, 1) * lc1 + lc0 / max(c0, 1) * c + math.e))
                    expected += c / t * math.log(max(c / lc1 * t / lt, 1.0)) / max(log, 1e-9)
            assert math.isclose(node.total, expected, rel_tol=1e-9, abs_tol=1e-9)


def test_extract_edges(spark):
    rows = [(1, None, "k"), (2, "", "k"), (3, f"<p>{SENTENCE}</p>", None), (3, f"<p>{SENTENCE}</p>", None), (None, "plain", "k")]
    pages = spark.createDataFrame(rows, "page_id long, html string, url string").withColumns({"text": F.lit("clash"), "tag": F.lit("t")})
    got = htmltext.extract(pages)
    assert set(got.columns) == {"page_id", "url", "tag", "text", "n_chars"}
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got.collect()) == sorted(
        [(1, "", 0), (2, "", 0), (3, SENTENCE.strip(), len(SENTENCE) - 1), (3, SENTENCE.strip(), len(SENTENCE) - 1), (0, "plain", 5)])
    assert htmltext.extract(pages.where("false")).count() == 0
