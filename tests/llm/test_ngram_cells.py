"""The join of n-gram sets where clusters take several blocks and sets outgrow the narrow sketch."""

import numpy as np

from kilnmark.llm import ngram_join


def test_cells_of_blocks_against_brute_force(spark, rng, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    monkeypatch.setattr(ngram_join, "BLOCK_GRAMS", 8000)
    rows, k = [], 0
    for size, copies, edits in ((150, 50, 7), (700, 24, 30), (1300, 6, 40)):
        base = [f"w{size}_{j}" for j in range(size)]
        for _ in range(copies):
            text = list(base)
            for j in range(rng.randrange(edits)):
                text[rng.randrange(size)] = f"x{k}_{j}"
            rows.append((k, " ".join(text)))
            k += 1
    # Long texts that share a passage and nothing else, copies, a row without an id.
    passage = " ".join(f"p{j}" for j in range(80))
    rows += [(k + j, passage + " " + " ".join(f"u{j}_{i}" for i in range(600 + 10 * j))) for j in range(20)]
    rows += [(500 + j, rows[60][1]) for j in range(4)] + [(None, rows[60][1]), (600, None), (601, "")]
    sets = {d: {tuple(w[i:i + 5]) for i in range(len(w) - 4)} for d, t in rows if d is not None for w in [(t or "").split()]}
    linked = {a: [b for b in sets if b != a and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])] for a in sets}
    least = {}
    for a in sorted(sets):
        todo = [] if a in least else [a]
        while todo:
            x = todo.pop()
            if x not in least:
                least[x] = a
                todo += linked[x]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in ngram_join.ngram_components(docs).collect() if r.doc_id is not None}
    assert got == {a: (len(sets[a]), least[a], len(linked[a])) for a in sets}


def test_wide_sketches_never_part_a_link():
    draw = np.random.default_rng(3)
    for n in (513, 1000, 1024, 1025, 4096, 9000):
        base = np.unique(draw.integers(0, 2**64 - 1, n, dtype=np.uint64))
        for share in (0.8, 0.82, 0.9, 1.0):
            other = base[:int(np.ceil(n * share))]
            sets = [base, other]
            fits = ngram_join._wide_near([ngram_join._wide(s) for s in sets], np.array([len(s) for s in sets]), np.array([0]), np.array([1]))
            assert fits[0]
        apart = np.unique(draw.integers(0, 2**64 - 1, n, dtype=np.uint64))
        assert not ngram_join._wide_near([ngram_join._wide(base), ngram_join._wide(apart)], np.array([n, n]), np.array([0]), np.array([1]))[0]
