import numpy as np
from pyspark.sql import functions as F

from kilnmark.llm import chat, cover_tree


def test_pairs_against_brute_force(spark):
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(8, 3))
    rows = [(i, [float(x) for x in centers[rng.integers(8)] + rng.normal(size=3) * 0.2]) for i in range(200)]
    rows += [(300, None), (301, []), (302, [0.0] * 3), (303, [1.0, None, 0.0]), (304, [float("nan"), 1.0, 1.0]),
             (305, [float("inf"), 1.0, 1.0]), (306, rows[0][1]), (307, [2 * x for x in rows[0][1]])]
    got = {r.vec_id: r for r in cover_tree.near_duplicates(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>"), block=20).collect()}
    ok = [r for r in rows if r[0] < 300 or r[0] > 305]
    units = np.array([r[1] for r in ok])
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    linked = units @ units.T >= 0.9
    assert [got[r[0]].n_links for r in ok] == (linked.sum(axis=1) - 1).tolist()
    label = np.arange(len(ok))
    for _ in range(len(ok)):
        label = np.where(linked, label[None, :], len(ok)).min(axis=1)
    assert [got[r[0]].component_id for r in ok] == [ok[k][0] for k in label]
    assert all(got[k].n_links == 0 and got[k].component_id == k and got[k].kept for k in range(300, 306))


def test_chat_round_trip_and_parts(spark):
    hard = "a<|turn|>\\<|\\\\<\\|end|><"
    rows = [(1, 0, "user", hard), (1, 1, "assistant", "ok" + hard), (2, 0, None, None), (None, 0, "assistant", "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat.format_chat(turns.withColumn("parts", chat.text_part(F.col("text"))))
    back = {r.conv_id: [tuple(x) for x in r.back] for r in made.select("conv_id", chat.read_chat(F.col("formatted")).alias("back")).collect()}
    assert back == {1: [("user", hard), ("assistant", "ok" + hard)], 2: [("", "")], None: [("assistant", "x")]}
    parts = [("text", "see ", None, None), ("image", None, "i.png", 2), ("audio", None, "s.wav", None), None, ("odd", "raw", None, None)]
    mixed = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "user", None)],
                                  f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    row = chat.format_chat(mixed).first()
    assert "see <|image:0|><|audio:1|>raw" in row.formatted
    assert [(a.turn_index, a.n, a.type, a.ref, a.tokens) for a in row.attachments] == [(0, 0, "image", "i.png", 512), (0, 1, "audio", "s.wav", 50)]
    assert row.attachment_tokens == 562
