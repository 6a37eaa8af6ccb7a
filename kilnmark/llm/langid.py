"""Language identification by a small convolutional network over bytes.

Filters of several widths run over windows of fixed length, each keeps its largest answer
(max pooling), and a softmax layer names the language. On bytes a convolution is a sum of
table rows, so numpy needs no matrix of one-hot bytes. The net learns on a bounded sample;
prediction covers the whole of every text, window by window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kilnmark.llm.common import released, table

WIDTHS, FILTERS, LENGTH = (2, 3, 4), 16, 128
#: Bounds of the training sample: rows, and windows per row.
SAMPLE_ROWS, SAMPLE_WINDOWS = 4000, 3
UNKNOWN = "und"


def held_out(doc_id: str = "doc_id") -> Column:
    """The fold that training never sees; a null id counts as held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(True))


def windows_of(data: bytes, length: int = LENGTH) -> np.ndarray:
    """All bytes in rows of ``length``; the last row is filled with 0."""
    rows = -(-len(data) // length)
    return np.frombuffer(data.ljust(rows * length, b"\0"), np.uint8).reshape(rows, length)


class ByteNet:
    def __init__(self, labels: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.labels = labels
        self.tables = [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.out = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(labels))).astype(np.float32)
        self.out_bias = np.zeros(len(labels), np.float32)

    def pooled(self, rows: np.ndarray, where: bool = False):
        """Largest answer of each filter, and where it stands if asked for."""
        tops, places = [], []
        for t, b, w in zip(self.tables, self.bias, WIDTHS):
            n = rows.shape[1] - w + 1
            answer = t[0][rows[:, :n]]
            for j in range(1, w):
                answer += t[j][rows[:, j:n + j]]
            if where:
                at = answer.argmax(axis=1)
                places.append(at)
                top = np.take_along_axis(answer, at[:, None], 1)[:, 0]
            else:
                top = answer.max(axis=1)
            tops.append(np.maximum(top + b, 0))
        return np.concatenate(tops, axis=1), places

    def probabilities(self, rows: np.ndarray, step: int = 256) -> np.ndarray:
        parts = []
        for k in range(0, len(rows), step):
            z = self.pooled(rows[k:k + step])[0] @ self.out + self.out_bias
            e = np.exp(z - z.max(axis=1, keepdims=True))
            parts.append(e / e.sum(axis=1, keepdims=True))
        return np.concatenate(parts) if parts else np.zeros((0, len(self.labels)), np.float32)

    def fit(self, rows: np.ndarray, target: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 0.01,
            seed: int = 11) -> ByteNet:
        """Adam on the cross entropy; languages weigh alike whatever their number of windows."""
        rng = np.random.default_rng(seed)
        many = np.bincount(target, minlength=len(self.labels))
        weight = (len(target) / (np.maximum(many, 1) * (many > 0).sum())).astype(np.float32)
        params = [*self.tables, *self.bias, self.out, self.out_bias]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        turn, k3 = 0, len(WIDTHS)
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for s in range(0, len(order), batch):
                x, y = rows[order[s:s + batch]], target[order[s:s + batch]]
                h, places = self.pooled(x, where=True)
                z = h @ self.out + self.out_bias
                e = np.exp(z - z.max(axis=1, keepdims=True))
                p = e / e.sum(axis=1, keepdims=True)
                p[np.arange(len(y)), y] -= 1
                p *= (weight[y] / len(y))[:, None]
                back = (p @ self.out.T) * (h > 0)
                grads = [np.zeros_like(q) for q in self.tables]
                for i, w in enumerate(WIDTHS):
                    g = back[:, i * FILTERS:(i + 1) * FILTERS]
                    for j in range(w):
                        seen = np.take_along_axis(x, places[i] + j, 1)
                        np.add.at(grads[i][j], (seen, np.arange(FILTERS)), g)
                grads += [back[:, i * FILTERS:(i + 1) * FILTERS].sum(axis=0) for i in range(k3)]
                grads += [h.T @ p, p.sum(axis=0)]
                turn += 1
                for q, g, m, v in zip(params, grads, first, second):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    q -= rate * (m / (1 - 0.9 ** turn)) / (np.sqrt(v / (1 - 0.999 ** turn)) + 1e-8)
        return self


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_windows: int = SAMPLE_WINDOWS) -> ByteNet | None:
    """Learn from text and lang of at most ``sample_rows`` rows outside the held-out fold.

    The rows are those of least hash of their id and text, and each gives
    ``sample_windows`` stretches spread over its whole text, cut before anything leaves the
    executors. Rows that repeat teach once. Null lang, null text and texts without a letter teach
    nothing; None if no row is left.

    A count first tells below which hash four times the wanted rows lie, so that a task does
    not send its own ``sample_rows`` rows to the driver whatever the number of tasks. Where too few
    different rows lie below it, as among very many equal ones, the bound is left out.
    """
    span = LENGTH
    usable = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    share = min(1.0, 4 * sample_rows / max(1, usable.count()))
    bound = min(2**63 - 1, int(share * 2.0**64) - 2**63)
    starts = F.transform(F.sequence(F.lit(0), F.lit(sample_windows - 1)), lambda k: (
        F.greatest(F.length("text") - span, F.lit(0)) * k / max(sample_windows - 1, 1)).cast("int") + 1)
    parts = F.array_distinct(F.transform(starts, lambda s: F.substring(F.col("text"), s, F.lit(span))))
    hashed = usable.select(F.xxhash64("doc_id", "text").alias("h"), "lang", parts.alias("parts"))

    def least(rows: DataFrame) -> list:
        return rows.distinct().orderBy("h", "lang", "parts").limit(sample_rows).collect()

    chosen = least(hashed.where(F.col("h") <= bound))
    if share < 1 and len(chosen) < sample_rows:
        chosen = least(hashed)
    pairs = [(windows_of(p.encode()[:LENGTH])[0], r.lang) for r in chosen for p in r.parts if p]
    if not pairs:
        return None
    labels = sorted({lang for _, lang in pairs})
    target = np.array([labels.index(lang) for _, lang in pairs])
    return ByteNet(labels).fit(np.stack([x for x, _ in pairs]), target)


def predict(docs: DataFrame, net: ByteNet | None) -> DataFrame:
    """Adds ``lang_pred`` and ``score`` to every row; a column of either name is replaced.

    The score is the mean probability of the named language over all windows of the
    text. Null text, text without a letter, and any text without a net give ``und`` and 0.
    """
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])

    def run(batches):
        import regex

        letter = regex.compile(r"\p{L}").search
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                part = batch.slice(k, 64)
                names, scores = [], []
                texts = part.column("text").to_pylist()
                for text in texts:
                    if net is None or not text or not letter(text):
                        names.append(UNKNOWN), scores.append(0.0)
                        continue
                    mean = net.probabilities(windows_of(text.encode())).mean(axis=0, dtype=np.float64)
                    best = int(mean.argmax())
                    names.append(net.labels[best]), scores.append(min(1.0, float(mean[best])))
                cols = [*(part.column(c) for c in kept), pa.array(names, pa.string()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(cols, [*kept, "lang_pred", "score"])

    return docs.select(*kept).mapInArrow(released(run), schema)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = train(docs.select("doc_id", "lang", "text"))
    told = predict(docs.select("doc_id", held_out().alias("held_out"), "text"), net)
    return told.select("doc_id", "held_out", "lang_pred", "score")
