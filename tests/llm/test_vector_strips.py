"""Vectors that no tree can prune: every row meets every other one, and the disk holds a round of them at a time."""

import collections
import os
import threading
import time

import numpy as np

from kilnmark.llm import cover_tree


def shuffled_bytes(spark, stop, peak):
    """The most bytes of shuffle files at a time, into ``peak``."""
    folders = list(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    while not stop.is_set():
        now = 0
        for folder, _, names in (x for f in folders for x in os.walk(f)):
            for name in names:
                if name.startswith("shuffle_"):
                    try:
                        now += os.path.getsize(os.path.join(folder, name))
                    except OSError:
                        pass  # removed meanwhile
        peak.append(now)
        time.sleep(0.02)


def test_disk_of_unclustered_vectors(spark, monkeypatch):
    monkeypatch.setattr(cover_tree, "ROUND_BYTES", 1 << 20, raising=False)
    monkeypatch.setattr(cover_tree, "STRIPS", 6, raising=False)
    rng = np.random.default_rng(4)
    v = rng.normal(size=(4000, 32))
    v[rng.choice(4000, 300, replace=False)] = v[rng.integers(0, 20, 300)] + rng.normal(size=(300, 32)) * 0.2
    rows = [(i, x) for i, x in enumerate(v.tolist())]
    stop, peak = threading.Event(), []
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    watch = threading.Thread(target=shuffled_bytes, args=(spark, stop, peak))
    watch.start()
    try:
        got = {r.vec_id: r for r in cover_tree.near_duplicates(table, block=40).collect()}
    finally:
        stop.set()
        watch.join()
    units = v / np.linalg.norm(v, axis=1, keepdims=True)
    linked = units @ units.T >= 0.9
    assert [got[i].n_links for i in range(4000)] == (linked.sum(axis=1) - 1).tolist()
    label = np.arange(4000)
    for _ in range(50):
        label = np.where(linked, label[None, :], 4000).min(axis=1)
    assert [got[i].component_id for i in range(4000)] == label.tolist() and linked.sum() > 5000
    assert max(peak) - min(peak) < 10 * v.nbytes


def test_links_of_large_components(spark, monkeypatch):
    """Counts and edges of many rounds are summed meanwhile, and nothing gets lost by that."""
    monkeypatch.setattr(cover_tree, "ROUND_BYTES", 1)
    monkeypatch.setattr(cover_tree, "LINKS", 1)
    monkeypatch.setattr(cover_tree, "STRIPS", 4)
    summed, links = [], cover_tree._summed
    monkeypatch.setattr(cover_tree, "_summed", lambda found: summed.append(links(found)) or summed[-1])
    rng = np.random.default_rng(8)
    v = (rng.normal(size=(3, 6))[rng.integers(0, 3, 300)] + rng.normal(size=(300, 6)) * 0.25).astype(np.float32)
    v = np.concatenate([v, v[:30]])
    ids = rng.permutation(330)
    table = spark.createDataFrame(list(zip(ids.tolist(), v.tolist())), "vec_id long, embedding array<float>")
    got = {r.vec_id: r for r in cover_tree.near_duplicates(table, block=20).collect()}
    units = cover_tree.unit(v.astype(np.float64))
    linked = units @ units.T >= 0.9
    label = ids
    for _ in range(330):
        label = np.where(linked, label[None, :], 330).min(axis=1)
    assert [got[i].n_links for i in ids.tolist()] == (linked.sum(axis=1) - 1).tolist()
    assert [got[i].component_id for i in ids.tolist()] == label.tolist() and [got[i].kept for i in ids.tolist()] == (ids == label).tolist()
    assert summed


def test_rounds_hold_each_pair_of_leaves_once():
    rng = np.random.default_rng(5)
    v = cover_tree.unit(rng.normal(size=(3000, 4)))
    nodes = cover_tree.fit_tree(v[:400], 3000, 30)
    leaf = cover_tree.nearest_leaf(nodes)(v)
    strip = (np.arange(3000) * 31) // 100 % 31  # every leaf in several strips
    slots = [(a, b, n) for (a, b), n in sorted(collections.Counter(zip(leaf.tolist(), strip.tolist())).items())]
    radius = {k: float(np.arccos(np.clip(v[leaf == k] @ nodes[k].center, -1, 1)).max()) for k in set(leaf.tolist())}
    reach = float(np.arccos(0.9))
    a, b = cover_tree.leaf_pairs(nodes, cover_tree.cover(nodes, radius), reach)
    pairs = set(zip(a.tolist(), b.tolist()))
    assert len(pairs) == len(a)
    left, right = np.nonzero(v @ v.T >= 0.9)
    assert {(min(x, y), max(x, y)) for x, y in zip(leaf[left].tolist(), leaf[right].tolist())} <= pairs
    assert len(pairs) < len(radius) * (len(radius) + 1) / 2
    found, seen, strips = list(cover_tree.rounds(slots, (a, b), 10, 6000)), set(), 31
    held = {(s, leaf_): n for leaf_, s, n in slots}
    for cells in found:
        size = sum(held[s, leaf_] for s, leaf_, _ in cells)
        assert size * 10 <= 6000 or len({c for _, _, c in cells}) == 1
        assert not seen & {c for _, _, c in cells}
        seen |= {c for _, _, c in cells}
    # All strips of one leaf meet all strips of the other.
    of = {}
    for leaf_, s, _ in slots:
        of.setdefault(leaf_, []).append(s)
    need = {(s, x, min(s, t) * strips + max(s, t)) for x, y in zip(a.tolist(), b.tolist()) for s in of[x] for t in of[y]}
    need |= {(t, y, min(s, t) * strips + max(s, t)) for x, y in zip(a.tolist(), b.tolist()) for s in of[x] for t in of[y]}
    assert need == {x for cells in found for x in cells}


def test_blocks_of_near_rows():
    rng = np.random.default_rng(6)
    v = cover_tree.unit(np.concatenate([rng.normal(size=(500, 6)), np.ones((40, 6)), -np.ones((40, 6))]))
    found = list(cover_tree.cut(v, 30))
    assert sorted(np.concatenate([rows for _, rows, _ in found]).tolist()) == list(range(580))
    for axis, rows, angle in found:
        assert len(rows) <= 30 and np.allclose(np.cos(angle), v[rows] @ axis)
    assert [len(x[1]) for x in cover_tree.cut(np.array([[1.0, 0.0], [-1.0, 0.0]]), 4)] == [2]
