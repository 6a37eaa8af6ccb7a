"""The manifest, the audit and the secret scan against plain Python, on rows with every kind of trouble."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from kilnmark.llm import divergence, merkle, secret_scan

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def frame(spark, rows, tmp_path):
    """Rows as the ``documents`` table of a folder, with further columns whose names clash with inner ones."""
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("rank", "key", "path", "leaf", "term", "secrets", "size"):
        docs = docs.withColumn(name, F.lit("clash"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def troubled(n=70):
    rows = [(i, f"Text {i} AbC é{'x' * (i % 7)}", ["en", "de", None][i % 3], ["s1", "s1", None, "é", "t"][i % 5], i) for i in range(n)]
    rows += rows[:3] * 2 + [(None, "No id", "en", "s1", 1), (None, None, None, None, None), (7000, "", "en", "alone", 0),
                            (7001, "Long " + "Word " * 60_000, "de", "t", None), (-5, "A", "de", "t", 3)]
    return rows


def plain_manifest(rows):
    def leaf(row, low=False):
        doc_id, text, lang, source, n_chars = row
        if low and text is not None:
            text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))

    def build(nodes, proofs):
        """Digest of a list of (digest, members); every member learns (left, right) at each level."""
        while len(nodes) > 1:
            above = []
            for a in range(0, len(nodes), 16):
                run = nodes[a:a + 16]
                for k, (_, members) in enumerate(run):
                    for m in members:
                        proofs[m].append(("".join(d for d, _ in run[:k]), "".join(d for d, _ in run[k + 1:])))
                above.append((h(*(d for d, _ in run)), [m for _, members in run for m in members]))
            nodes = above
        return nodes[0]

    proofs, groups = defaultdict(list), defaultdict(list)
    for k, row in enumerate(rows):
        groups[row[3]].append((row[0] is not None, row[0], leaf(row), k))
    tops, subroot = [], {}
    for source in sorted(groups, key=lambda s: (s is not None, (s or "").encode())):
        members = sorted(groups[source], key=lambda x: (x[0], x[1] or 0, x[2]))
        digest, own = build([(x[2], [x[3]]) for x in members], proofs)
        subroot.update(dict.fromkeys(own, digest))
        tops.append((digest, own))
    root = build(tops, proofs)[0] if tops else None
    for k, row in enumerate(rows):
        low = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
        acc = leaf(row, low)
        for a, b in proofs[k]:
            acc = h(a, acc, b)
        yield (row[0], leaf(row), subroot[k], root, h(*(a + b for a, b in proofs[k])), acc, acc == root)


def canonical(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("rows", [troubled(1400), [], [(1, "A", None, None, 1)], [(None, None, None, "s", None)] * 40],
                         ids=["three levels", "empty", "one", "equal rows"])
def test_manifest(spark, tmp_path, rows):
    got = merkle.op11_merkle_manifest(spark, frame(spark, rows, tmp_path))
    assert canonical(got.collect()) == canonical(plain_manifest(rows))


def test_manifest_ranks_a_hot_group_in_parts(spark):
    """Ranks are gapless within a key however its rows were cut over partitions."""
    rows = spark.range(20_000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("key"),
                                      (F.col("id") * 7919 % 5000).alias("value"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = merkle.ranked(rows, ["value"], "test")
        assert got.where("key = 'hot'").select(F.spark_partition_id()).distinct().count() >= 1
        found = defaultdict(list)
        for r in got.collect():
            found[r["key"]].append((r["rank"], r["value"], r["size"]))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for key, ranks in found.items():
        ranks.sort()
        assert [r for r, _, _ in ranks] == list(range(len(ranks))), key
        assert [v for _, v, _ in ranks] == sorted(v for _, v, _ in ranks)
        assert {n for _, _, n in ranks} == {len(ranks)}


def test_manifest_finds_a_changed_row(spark):
    docs = spark.createDataFrame(troubled(), SCHEMA)
    made = merkle.manifest(docs, changed={"n_chars": F.when(F.col("doc_id") == 13, F.lit(99)).otherwise(F.col("n_chars"))})
    wrong = made.where(merkle.fold(F.col("other_leaf"), F.col("path")) != F.col("root")).select("doc_id").collect()
    assert [r.doc_id for r in wrong] == [13]
    plain = merkle.manifest(docs).select("other_leaf", (merkle.fold(F.col("leaf"), F.col("path")) == F.col("root")).alias("ok")).distinct().collect()
    assert [tuple(r) for r in plain] == [(None, True)]


# --- audit -------------------------------------------------------------------

def plain_audit(rows, least=10):
    words, inside, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source, _ in rows:
        lang, source = lang or "", source or ""
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        groups.add((lang, source))
        words[lang, source].update(terms)
        inside[lang].update(set(terms))
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, n in inside[lang].items() if n >= least)
        sources = sorted(s for g, s in groups if g == lang)
        whole = Counter()
        for s in sources:
            whole.update({t: words[lang, s][t] for t in kept})

        def p(count, term):
            return 1 + 10**9 * (count[term] + 2) // (sum(count[t] for t in kept) + 2 * len(kept))

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        for s in sources:
            mine = words[lang, s]
            pairs = [(o, sum(f(p(mine, t), p(words[lang, o], t)) for t in kept)) for o in sources if o != s]
            led = [(t, f(p(mine, t), p(whole, t))) for t in kept if mine[t] and p(mine, t) > p(whole, t)]
            for part, values, most in (("pair", pairs, None), ("term", led, 10)):
                for k, (item, value) in enumerate(sorted(values, key=lambda x: (-x[1], x[0].encode()))[:most]):
                    yield lang, s, part, item, value, k + 1


def audited(rng, n=260):
    vocabulary = ["Haus", "MAUS", "élan", "straße", "a", "b", "zz", "word", "ÀB", "日本", "x1y", "ß"] + [f"t{c}" for c in "abcdefghij"]
    rows = []
    for i in range(n):
        source = f"s{rng.randrange(9)}" if i % 3 else "hot"
        text = rng.choice([" ", "\n", ".", "1"]).join(rng.choices(vocabulary[rng.randrange(4):], k=rng.randrange(1, 40)))
        rows.append((i, text, rng.choice(["en", "de", None]), source, 1))
    rows += rows[:2] * 3 + [(1, None, "en", "bare", 1), (2, "", "en", "bare two", 1), (3, "so rare", "fr", "only", 1), (4, "", "fr", None, 1),
                            (5, "haus " * 300_000, "de", "long", 1), (6, "one two", None, None, None), (7, "x" * 2_000_000, "de", "long", 1)]
    return rows


@pytest.mark.parametrize("blocks", [(64, 2048), (2, 3), (3, 1)])
def test_audit(spark, rng, blocks):
    rows = audited(rng)
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"term": F.lit("clash"), "n": F.lit(1), "block": F.lit(2)})
    got = divergence.audit(docs, groups=blocks[0], terms=blocks[1])
    assert canonical(got.collect()) == canonical(plain_audit(rows))


def test_audit_query(spark, rng, tmp_path):
    rows = audited(rng, 60)
    assert canonical(divergence.op12_source_divergence(spark, frame(spark, rows, tmp_path)).collect()) == canonical(plain_audit(rows))


def test_audit_of_nothing(spark, tmp_path):
    assert divergence.op12_source_divergence(spark, frame(spark, [], tmp_path)).collect() == []


def test_audit_ties_and_salted_languages(spark, monkeypatch):
    """Sources alike in every term tie at 0 and rank by name; the way without a broadcast gives the same."""
    rows = [(i, "same words here", "en", s, 1) for i in range(12) for s in ("b", "a", "ä", "B")]
    monkeypatch.setattr(divergence, "FEW_LANGUAGES", 0)
    got = divergence.audit(spark.createDataFrame(rows, SCHEMA)).collect()
    assert canonical(got) == canonical(plain_audit(rows))
    assert [r.item for r in sorted(got, key=lambda r: r["rank"]) if r.source == "a"] == ["B", "b", "ä"]


def test_counts_flush_and_stretch(spark, monkeypatch):
    data = ("wort " * 9 + "é" * 40 + "1") * 30
    monkeypatch.setattr(divergence, "_STRETCH", 16)
    assert b"".join(divergence.stretches(data.encode())) == data.encode()
    found = [t for piece in divergence.stretches(data.encode()) for t in re.findall(rb"[a-z\x80-\xff]+", piece)]
    assert found == re.findall(rb"[a-z\x80-\xff]+", data.encode())


def test_probability_is_exact():
    import numpy as np
    for count, total, terms in [(0, 0, 1), (7, 9, 3), (10**14, 3 * 10**14 + 7, 10**6), (10**15, 10**15, 1), (3, 10**15 - 1, 12345)]:
        got = divergence.probability(np.array([count]), np.array([total]), terms)[0]
        assert got == 1 + 10**9 * (count + 2) // (total + 2 * terms)


# --- secrets -------------------------------------------------------------------

def plain_spans(text):
    """The patterns as they are stated, then every window's entropy from its counts anew."""
    base = [("assign", *m.span()) for m in re.finditer(
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        text) if len(m[2]) >= 6]
    base += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    base += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    spans = list(base)
    for one in secret_scan.CLASSES:
        found = []
        for m in re.finditer(f"[{one.characters}]+", text):
            if any(re.search(p, m[0]) for p in secret_scan.ALLOWED):
                continue
            marked = set()
            for i in range(len(m[0]) - one.width + 1):
                window = m[0][i:i + one.width]
                bits = -sum(n / one.width * math.log2(n / one.width) for n in Counter(window).values())
                if bits >= one.bits - 1e-9 and re.search("[0-9]", window) and re.search("[A-Za-z]", window):
                    marked.update(range(m.start() + i, m.start() + i + one.width))
            for at in sorted(marked):
                if found and found[-1][2] == at:
                    found[-1] = (one.kind, found[-1][1], at + 1)
                else:
                    found.append((one.kind, at, at + 1))
        spans += [s for s in found if not any(a <= s[1] and s[2] <= b for _, a, b in spans)]
    order = {k: i for i, k in enumerate([*secret_scan.LEAST, *(c.kind for c in secret_scan.CLASSES)])}
    return sorted(base, key=lambda s: (s[1], order[s[0]])), sorted(spans, key=lambda s: (s[1], order[s[0]], s[2]))


def texts(rng):
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    parts = ["password", "PassWD", "secret", "token", "API_KEY", "apikey", "ſecret", " ", "  ", ":", "=", '"', "'", "é日", "\n", "AKIA", "AKIAAKIA",
             "AKIA" + "Z9" * 9, "0123456789abcdef" * 2, "abcdef", "9f" * 11, "9f" * 12, "word ", "hier ", "a" * 40, "1" * 30, "example", "."]

    def random_part():
        return "".join(rng.choices(rng.choice([letters, "0123456789abcdef", "0123456789abcdefABCDEF", letters[:-2], "ab12"]), k=rng.randrange(1, 70)))

    out = ["".join(rng.choice([random_part(), rng.choice(parts), rng.choice(parts)]) for _ in range(rng.randrange(1, 14))) for _ in range(400)]
    out += ["token=token:abcdefgh", "token=secret=longvalue123", "", None, "secret" + " " * 200_000 + "= abcdefgh", "prose only, nothing here",
            "123e4567-e89b-12d3-a456-426614174000", "da39a3ee5e6b4b0d3255bfef95601890afd80709", "wort " * 100_000 + "AKIA" + "Q7" * 10,
            "".join(rng.choices(letters, k=5000)), "é" * 1000 + "".join(rng.choices("0123456789ABCDEF", k=64))]
    return out


def test_secret_scan(spark, rng, tmp_path):
    rows = [(i, t, None, "s", None) for i, t in enumerate(texts(rng))]
    rows += [(None, "token: 1234567", None, None, None), rows[3], rows[3]]
    got = secret_scan.op13_secret_scan(spark, frame(spark, rows, tmp_path))

    def say(spans):
        return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)

    expected = []
    for doc_id, text, *_ in rows:
        base, spans = plain_spans(text or "")
        many = Counter(k for k, _, _ in base)
        expected.append((doc_id, many["assign"], many["access"], many["hex"], h(say(base)), say(spans)))
    assert canonical(got.collect()) == canonical(expected)
    kinds = Counter(s.split(":")[0] for r in expected for s in r[5].split(",") if s)
    assert set(kinds) == {*secret_scan.LEAST, *(c.kind for c in secret_scan.CLASSES)}


def test_secret_scan_of_nothing(spark, tmp_path):
    assert secret_scan.op13_secret_scan(spark, frame(spark, [], tmp_path)).collect() == []


def test_secret_columns(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "token=abcdef", "y")], "a long, text string, kind string").withColumn("secrets", F.lit(0))
    got = secret_scan.scan(docs)
    assert got.columns == ["a", "text", "kind", "secrets"]
    assert [(r.a, r.kind, [tuple(s) for s in r.secrets]) for r in got.orderBy("a").collect()] == [(1, "x", []), (2, "y", [("assign", 0, 12)])]
