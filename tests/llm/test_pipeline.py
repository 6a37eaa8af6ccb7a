"""The stages and the whole pipeline against plain versions, on rows of every awkward kind."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from kilnmark.llm import langid, quality

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_language_without_a_net_keeps_what_has_a_letter(spark):
    rows = [(1, "Some clean text.", None, "web", 16), (2, "123 !?", None, "web", 6), (3, None, None, "web", 0), (4, "été", None, "web", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.language(spark, docs, "").collect()
    assert sorted(tuple(r) for r in kept) == sorted(x for x in map(tuple, rows) if x[0] in (1, 4))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(12)
    words = [f"{a}{b}" for a in ("stone", "river", "light", "green", "paper", "cloud", "north", "field") for b in ("", "s", "ed", "ing", "er")]
    said = [f"{a} {b}" for a in ("the", "and", "with", "from") for b in words]
    fresh = lambda n: " ".join(rng.choice(said) for _ in range(n))
    passage = "this passage of well over fifty bytes stands in many of the documents of the test"
    texts = [fresh(40) for _ in range(14)]
    texts += [f"{fresh(30)} {passage} {fresh(20)}" for _ in range(6)]
    texts += [texts[0], texts[0].upper(), texts[3] + " the end", texts[15], None, "", "  \n ", "a b", "12 34 " * 20, "same words again " * 20,
              "é" + fresh(25) + " ü", fresh(3000)]
    out = [(k, t, rng.choice(["en", None]), rng.choice(["web", None]), len(t or "")) for k, t in enumerate(texts)]
    # Repeated rows, one id with two texts, no id, ties in all but the id.
    return [*out, out[2], (5, fresh(30), "en", "web", 1), (None, texts[1], "en", "web", 2), (None, None, None, None, None), (99, texts[7], *out[7][2:])]


def frame(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def plain(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


def tuples(df):
    return plain([tuple(r) for r in df.select(*corpus_pipeline.COLUMNS).collect()])


def shingles(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def least_of_groups(rows):
    """One row of each group of near duplicates, and all rows without an id."""
    ids = [r for r in set(rows) if r[0] is not None]
    up = {r[0]: r[0] for r in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    sets = [(r[0], shingles(r[1])) for r in ids]
    for a, x in sets:
        for b, y in sets:
            if a < b and x and 100 * len(x & y) >= 80 * len(x | y):
                low, high = sorted((root(a), root(b)))
                up[high] = low
    kept = [plain([r for r in ids if r[0] == k])[0] for k in up if root(k) == k]
    return plain([*kept, *(r for r in rows if r[0] is None)])


def without_repeats(rows):
    """The text of each row without the bytes of 50-byte strings that start in a row of smaller id."""
    first = {}
    for r in rows:
        data = (r[1] or "").encode()
        if r[0] is not None:
            for k in range(len(data) - 49):
                first[data[k:k + 50]] = min(first.get(data[k:k + 50], r[0]), r[0])
    out = []
    for r in rows:
        data = (r[1] or "").encode()
        gone = np.zeros(len(data), bool)
        for k in range(len(data) - 49):
            if r[0] is not None and first[data[k:k + 50]] < r[0]:
                gone[k:k + 50] = True
        left = b"".join(bytes([b]) for b, g in zip(data, gone) if not g).decode(errors="ignore")
        out.append((r[0], left, r[2], r[3], len(left)))
    return plain(out)


def packed(rows, pieces, window=2048):
    """Are ``pieces`` the ids of ``rows``, each in one place, in sequences without gaps?"""
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted((r[0] is not None, r[0] or 0, zlib.crc32(np.array([*tok.encode(r[1] or "", add_special_tokens=False).ids, 1], "<u4").tobytes()))
                  for r in rows if r[0] is not None)
    own, sequences = {}, {}
    for p in pieces:
        if p.doc_id is not None:
            own.setdefault(p.doc_id, []).append(p)
        sequences.setdefault(p.sequence_id, []).append(p)
    assert {k for _, k, _ in want} == set(own)
    tokens = {r[0]: len(tok.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in rows}
    for k, parts in own.items():
        parts.sort(key=lambda p: p.start)
        assert [p.start for p in parts] == [0, *np.cumsum([p.length for p in parts])[:-1]]
        assert sum(p.length for p in parts) == tokens[k] == parts[0].doc_tokens
    for parts in sequences.values():
        parts.sort(key=lambda p: p.offset)
        assert [p.offset for p in parts] == [0, *np.cumsum([p.length for p in parts])[:-1]]
        assert sum(p.length for p in parts) <= window


def test_quality_stage(spark, rows):
    docs = frame(spark, rows).withColumn("kept", F.lit("clash")).withColumn("n_words", F.lit(-1))
    got = tuples(corpus_pipeline.quality_rules(spark, docs, ""))
    judged = {(r.doc_id, r.text): r.kept for r in quality.judge(frame(spark, rows)).collect()}
    assert got == plain([r for r in rows if judged[r[0], r[1]]])
    words = lambda t: len((t or "").split())
    assert not [r for r in got if words(r[1]) < 10]
    assert {k for k in range(20)} <= {r[0] for r in got}


def test_near_duplicate_stage(spark, rows):
    docs = frame(spark, rows).withColumn("component_id", F.lit("clash")).withColumn("rep", F.lit("clash"))
    assert tuples(corpus_pipeline.near_duplicates(spark, docs, "")) == least_of_groups(rows)


def test_repeated_string_stage(spark, rows):
    distinct = list({r[0]: r for r in rows if r[0] is not None}.values()) + [r for r in rows if r[0] is None]
    docs = frame(spark, distinct).withColumn("removed", F.lit("clash"))
    assert tuples(corpus_pipeline.repeated_strings(spark, docs, "")) == without_repeats(distinct)


def test_stages_on_an_empty_table(spark, rows):
    docs = frame(spark, rows[:1]).where("false")
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, "")
        assert got.count() == 0, name
        assert name == "pack" or got.columns == corpus_pipeline.COLUMNS


def test_whole_run(spark, rows, tmp_path):
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    judged = {(r.doc_id, r.text): r.kept for r in quality.judge(frame(spark, rows)).collect()}
    left = [r for r in rows if judged[r[0], r[1]]]
    net = langid.train(frame(spark, left).select("doc_id", "lang", "text"))
    told = {(r.doc_id, r.text): r.lang_pred != "und" and r.score >= 0.4 for r in langid.predict(frame(spark, left), net).collect()}
    left = [r for r in left if told[r[0], r[1]]]
    left = without_repeats(least_of_groups(left))
    packed(left, corpus_pipeline.run(spark, str(tmp_path)).collect())
